"""Toxicity grades by cumulative-link ordinal regression on sparse words and stems.

P(grade > j) = sigmoid(score - threshold j): one weight per feature serves all
thresholds, which are ordered by construction. The model is small: a bounded number
of features chosen from a bounded sample of labelled rows. Every document is graded
from its whole text in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farevalue.llm.common import fresh_name, select_text, slices, stored, take_over

LETTERS = re.compile(r"[^\W\d_]+")

# The labelled rows that a model is fitted on (those with the smallest hash of the id),
# and the number of features it may have.
SAMPLE_ROWS = 20_000
MOST_FEATURES = 4_000

# A feature is in this many labelled documents at least, and its share differs between
# the classes by this many standard errors; a stem has so many letters.
LEAST_DOCUMENTS = 3
LEAST_STRENGTH = 4.0
STEM = 5

# Grades: 0 for harmless, and toxic documents in so many classes of growing severity.
TOXIC_GRADES = 3

# A document is rejected when its expected severity is at least this.
REJECT_AT = 0.35

STEPS, RATE, PENALTY = 400, 0.05, 1e-4


def text_features(text: str) -> set[str]:
    """The distinct lower-case words of ``text``, and ``^stem`` of the longer ones."""
    words = set(LETTERS.findall(text.lower()))
    return words | {"^" + w[:STEM] for w in words if len(w) > STEM}


@dataclass(frozen=True)
class Model:
    """Weights by feature and ordered thresholds; no thresholds means always grade 0."""

    weights: dict[str, float]
    thresholds: tuple[float, ...]

    def score(self, text: str) -> float:
        return sum(map(self.weights.__getitem__, text_features(text) & self.weights.keys()))

    def beyond(self, score: float) -> list[float]:
        """P(grade > j) for each threshold j."""
        return [1 / (1 + np.exp(min(max(t - score, -700), 700))) for t in self.thresholds]


def fit_ordinal(
    rows: np.ndarray, columns: np.ndarray, grades: np.ndarray, features: int
) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds of maximal penalised likelihood, by Adam on all rows.

    ``rows`` and ``columns`` list the features present; ``grades`` run from 0 to some
    highest one, each of which occurs. Deterministic.
    """
    top = int(grades.max())
    n = len(grades)
    share = np.array([(grades > j).mean() for j in range(top)])
    first = -np.log(share / (1 - share))
    # Thresholds are the first one and the logarithms of the steps to the others.
    steps = np.log(np.maximum(np.diff(first), 1e-2))
    parameters = np.concatenate([np.zeros(features), first[:1], steps])
    momentum, power = np.zeros_like(parameters), np.zeros_like(parameters)
    edge = np.arange(n)
    for step in range(1, STEPS + 1):
        weights = parameters[:features]
        widths = np.exp(parameters[features + 1 :])
        thresholds = parameters[features] + np.concatenate([[0.0], np.cumsum(widths)])
        score = np.bincount(rows, weights=weights[columns], minlength=n)
        over = 1 / (1 + np.exp(-np.clip(score[:, None] - thresholds, -60, 60)))
        bounds = np.hstack([np.ones((n, 1)), over, np.zeros((n, 1))])
        slope = np.hstack([np.zeros((n, 1)), over * (1 - over), np.zeros((n, 1))])
        chance = np.maximum(bounds[edge, grades] - bounds[edge, grades + 1], 1e-12)
        by_score = -(slope[edge, grades] - slope[edge, grades + 1]) / chance / n
        by_threshold = np.zeros(top)
        np.add.at(by_threshold, grades[grades > 0] - 1, (slope[edge, grades] / chance)[grades > 0] / n)
        np.add.at(by_threshold, grades[grades < top], -(slope[edge, grades + 1] / chance)[grades < top] / n)
        gradient = np.concatenate(
            [
                np.bincount(columns, weights=by_score[rows], minlength=features)
                + PENALTY * weights,
                [by_threshold.sum()],
                widths * np.cumsum(by_threshold[:0:-1])[::-1] if top > 1 else [],
            ]
        )
        momentum = 0.9 * momentum + 0.1 * gradient
        power = 0.999 * power + 0.001 * gradient**2
        parameters = parameters - RATE * (momentum / (1 - 0.9**step)) / (
            np.sqrt(power / (1 - 0.999**step)) + 1e-8
        )
    widths = np.exp(parameters[features + 1 :])
    return parameters[:features], parameters[features] + np.concatenate([[0.0], np.cumsum(widths)])


def severity_grades(toxic: np.ndarray, hits: np.ndarray) -> np.ndarray:
    """Grades from the labels: toxic rows in classes of equal size by ``hits``.

    ``hits`` counts features that the labels show to be toxic. Equal counts share a
    grade, so there may be fewer grades.
    """
    grades = np.zeros(len(toxic), dtype=np.int64)
    counts = hits[toxic]
    if len(counts):
        cuts = np.unique(np.quantile(counts, [i / TOXIC_GRADES for i in range(1, TOXIC_GRADES)]))
        grades[toxic] = 1 + np.searchsorted(cuts, counts, side="left")
    return np.unique(grades, return_inverse=True)[1] if (grades == 0).any() else grades


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    label_column: str = "toxic",
    sample_rows: int = SAMPLE_ROWS,
    most_features: int = MOST_FEATURES,
) -> Model:
    """Fit a model to at most ``sample_rows`` labelled documents.

    Rows without label, id or text are not used; of rows that share an id the least text is. An id
    with several labels is toxic if one of them says so. Without both classes in the sample,
    or any telling feature, the model grades everything 0. Features are chosen by how far their share differs
    between the classes, from counts that Spark makes; the driver gets the chosen ones
    and where they occur in the sample.
    """
    marked = labels.select(
        F.col(f"`{id_column}`").cast("long").alias("doc_id"),
        (F.col(f"`{label_column}`") > 0).alias("toxic"),
    ).dropna()
    sampled = (
        marked.groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )
    listed = [(r["doc_id"], r["toxic"]) for r in sampled.collect()]
    positive = sum(t for _, t in listed)
    if not positive or positive == len(listed):
        return Model({}, ())
    spark = docs.sparkSession
    chosen = F.broadcast(spark.createDataFrame(listed, "doc_id long, toxic boolean"))
    texts = stored(
        select_text(docs, id_column, text_column)
        .dropna()
        .join(chosen, "doc_id")
        .groupBy("doc_id")
        .agg(F.min("text").alias("text"), F.first("toxic").alias("toxic")),
        "labelled",
    )

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("toxicity")
        for batch in slices(batches, "text"):
            found = [list(text_features(t)) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.string()))],
                names=["doc_id", "toxic", "features"],
            )

    rows = texts.mapInArrow(present, "doc_id long, toxic boolean, features array<string>")
    counted = (
        rows.select("toxic", F.explode("features").alias("feature"))
        .groupBy("feature")
        .agg(F.sum(F.col("toxic").cast("long")).alias("in_toxic"), F.count("*").alias("in_all"))
        .filter(F.col("in_all") >= LEAST_DOCUMENTS)
    )
    share = F.col("in_toxic") / positive
    other = (F.col("in_all") - F.col("in_toxic")) / (len(listed) - positive)
    spread = F.sqrt(F.col("in_all") / len(listed) * (1 / positive + 1 / (len(listed) - positive)))
    best = (
        counted.withColumn("strength", (share - other) / spread)
        .filter(F.abs("strength") >= LEAST_STRENGTH)
        .orderBy(F.abs("strength").desc(), "feature")
        .limit(most_features)
        .collect()
    )
    if not best:
        return Model({}, ())
    names = {r["feature"]: n for n, r in enumerate(best)}
    telling = {r["feature"] for r in best if r["in_toxic"] > 0.8 * r["in_all"]}
    shared = spark.sparkContext.broadcast(names)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("toxicity")
        known = shared.value
        for batch in slices(batches, "text"):
            found = [
                sorted(known[f] for f in text_features(t) & known.keys())
                for t in batch.column("text").to_pylist()
            ]
            yield pa.record_batch(
                [batch.column("doc_id"), batch.column("toxic"), pa.array(found, pa.list_(pa.int32()))],
                names=["doc_id", "toxic", "features"],
            )

    data = texts.mapInArrow(locate, "doc_id long, toxic boolean, features array<int>").collect()
    data.sort(key=lambda r: (r["doc_id"], r["features"]))
    toxic = np.array([r["toxic"] for r in data], dtype=bool)
    if not toxic.any() or toxic.all():
        return Model({}, ())
    tells = {names[f] for f in telling}
    hits = np.array([sum(f in tells for f in r["features"]) for r in data])
    sizes = [len(r["features"]) for r in data]
    places = np.repeat(np.arange(len(data)), sizes)
    columns = np.fromiter((f for r in data for f in r["features"]), dtype=np.int64, count=sum(sizes))
    weights, thresholds = fit_ordinal(places, columns, severity_grades(toxic, hits), len(names))
    ordered = sorted(names, key=names.__getitem__)
    return Model(
        dict(zip(ordered, weights.tolist(), strict=True)), tuple(thresholds.tolist())
    )


def grade(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """Add ``grade`` (most likely), ``expected_severity`` and ``toxic`` to ``docs``.

    A null or empty text has the grade of a text without known features. All rows and
    columns are kept; a column of ``docs`` that has one of the three names already
    makes the new one get an underscore behind it.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("struct<grade: int, expected_severity: double>")
    def graded(texts: pa.Array) -> pa.Array:
        take_over("toxicity")
        known = shared.value
        grades, expected = [], []
        for text in texts:  # one text at a time becomes a Python string
            beyond = known.beyond(known.score(text.as_py() or ""))
            chances = -np.diff([1.0, *beyond, 0.0])
            grades.append(int(np.argmax(chances)))
            expected.append(float(sum(beyond)))
        return pa.StructArray.from_arrays(
            [pa.array(grades, pa.int32()), pa.array(expected, pa.float64())],
            names=["grade", "expected_severity"],
        )

    held = fresh_name(docs, "graded")
    names = [fresh_name(docs, n) for n in ("grade", "expected_severity", "toxic")]
    return docs.withColumn(held, graded(F.col(f"`{text_column}`").cast("string"))).select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.col(held)["grade"].alias(names[0]),
        F.col(held)["expected_severity"].alias(names[1]),
        (F.col(held)["expected_severity"] >= REJECT_AT).alias(names[2]),
    )


def keep_harmless(docs: DataFrame, model: Model, text_column: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not rejected, with its columns."""
    graded = grade(docs, model, text_column)
    return graded.filter(~F.col(f"`{graded.columns[-1]}`")).select(
        *(F.col(f"`{c}`") for c in docs.columns)
    )
