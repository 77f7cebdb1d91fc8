"""The text operators applied in turn to a corpus of documents.

Every stage works on all that the one before it kept. Stages that change the text also
set ``n_chars`` where the table has it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farevalue.llm import jaccard, packing, repeats, secrets, toxicity
from farevalue.llm.common import stored

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

# Words whose ids a worker remembers; workers of the earlier stages hold memory already.
WORDS = 200_000


def count_chars(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents whose expected severity is too high; needs ``labels``."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.keep_harmless(docs, model)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest id of each near-duplicate group: five words, 80 percent."""
    return jaccard.keep_one(docs, n=5, percent=80)


def remove_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut words of passages that stand earlier in the corpus; the rest keeps its layout."""
    names = {c: f"carried_{n}" for n, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    given = docs.select("doc_id", "text", *(F.col(f"`{c}`").alias(n) for c, n in names.items()))
    kept = repeats.remove_repeats(given, carry=tuple(names.values()), layout=True)
    names |= {"doc_id": "doc_id", "text": "kept"}
    return count_chars(kept.select(*(F.col(names[c]).alias(c) for c in docs.columns)))


def hide_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the text by a mark."""
    return count_chars(secrets.redact_secrets(docs))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into training sequences; one row per piece, with its token ids."""
    return packing.pack(docs, TOKENIZER, memory=WORDS, keep_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", keep_one_of_each),
    ("substring dedup", remove_passages),
    ("secret scans", hide_secrets),
    ("best-fit packing", pack_documents),
]

# SQL cannot express the fitted grades, the tests of randomness or the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each starts from the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    *first, (_, last) = STAGES
    for name, stage in first:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return last(spark, docs, sf_dir)
