"""Secret scans: fixed patterns, and a battery of randomness tests over all tokens.

The battery takes every long token, infers its encoding from its characters, and
tests the hypothesis that it is random in that alphabet: chi-squared uniformity, runs
above and below the middle, serial correlation, and the share of letters that are frequent
in prose, combined by Fisher's method. No token is left out before the tests. Over
all documents the tokens that are *not* random are then found with control of the
false-discovery rate, weighted by length because short tokens cannot show much.

What remains may still be an ordinary long word, which few characters cannot tell from a
random one. So a second control bounds the share of false reports: its hypothesis is that a
token is made as the corpus's own short words are, by the pairs of their characters counted
over all documents, and its spread grows with the length. Only tokens that reject this too
are reported. Both controls need only counts in a fixed number of bins.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farevalue.llm.common import select_text, slices, stored, take_over

# Fixed patterns, in the order in which equal starts are listed.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "random")

# Tokens that the battery tests: long runs of the characters of base64 and its URL form,
# whatever stands around them. An equals sign belongs to a token as padding at its end only
# (base32 has up to six); before or inside a stretch it parts a name from a value.
LEAST_TOKEN = 20
TOKEN = re.compile(r"[A-Za-z0-9+/_-]{20,}(?:={1,6}(?![A-Za-z0-9+/_=-]))?")

# What stands between slashes is tested by itself too: a slash may be a digit of base64 or
# part the key from the rest of a path.
PART = re.compile(r"[A-Za-z0-9+_-]{20,}={0,6}")

# Alphabets by name, narrowest first: a token has the first that holds all its characters.
# The last holds every character of a token.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "HEX": "0123456789ABCDEF",
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "UPPER": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base36": "0123456789abcdefghijklmnopqrstuvwxyz",
    "BASE36": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "letters": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base62": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789",
    "base64": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/",
    "base64url": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_",
    "mixed": "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_",
}

# Letters that make up most of the text of European languages.
FREQUENT = frozenset("etaoinsrETAOINSR")

# Share of truly random tokens among those that the control discards, bins of -log10 p
# (the last takes everything beyond) and bands of length, each twice the one before.
DISCOVERY_RATE = 0.05
BINS, BIN_WIDTH = 600, 0.05
BANDS = 16

# The first bin that may be discarded: p of at most 0.01. Weights only choose among these, so
# whatever else there is, few random tokens of any length are lost: about two in a hundred, as
# runs and serial correlation go together, which Fisher's method does not know.
LEAST_BIN = 40


# Characters as the second control sees them: letters without case, one class of digits, and
# everything else, which parts words.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
CLASSES = len(LETTERS) + 1
CODES = np.full(256, CLASSES, dtype=np.uint8)
CODES[np.frombuffer(LETTERS.encode(), np.uint8)] = range(len(LETTERS))
CODES[np.frombuffer(LETTERS.upper().encode(), np.uint8)] = range(len(LETTERS))
CODES[np.frombuffer(b"0123456789", np.uint8)] = len(LETTERS)

# Words that are counted beside those of the corpus, so that the smallest corpus has some.
PRIOR = """
The first line of a table names its columns, and each row below gives one record with a date such as 2024 or 1999.
Please read the whole document before you change the settings, because some options depend on others; version 12 of
the server keeps all files in the folder user data, while older releases store them under local share. When a service
starts it looks for the address and port 8080 in its configuration, opens the connection, writes a message to the log
and waits for requests from clients. Questions about the installation, the interface or the license can be sent to the
public mailing list, where people usually answer within 24 hours.
"""

# Share of ordinary tokens among those reported, pairs of a stretch by which the spread of
# ordinary text is measured, and bins of the distance from it in standard deviations.
REPORT_RATE = 0.05
STRETCH = 16
FAR_BINS, FAR_WIDTH = 100, 0.25


def _normal_tail(z: float) -> float:
    return 0.5 * math.erfc(z / math.sqrt(2))


def _chi2_tail(x: float, degrees: int) -> float:
    """Upper tail of chi-squared by the cube-root normal approximation."""
    if x <= 0:
        return 1.0
    spread = 2 / (9 * degrees)
    return _normal_tail(((x / degrees) ** (1 / 3) - 1 + spread) / math.sqrt(spread))


def alphabet_of(token: str) -> str:
    """The narrowest alphabet of ``token``."""
    body = set(token.rstrip("="))
    return next(name for name, letters in ALPHABETS.items() if body <= set(letters))


def encoding_of(token: str) -> str | None:
    """The narrowest alphabet of ``token``; None unless it mixes letters and digits."""
    if not any(c.isdigit() for c in token) or not any(c.isalpha() for c in token):
        return None
    return alphabet_of(token)


def prose(token: str, letters: str) -> float:
    """p-value of so many frequent letters among all letters if ``token`` is random."""
    n = sum(map(str.isalpha, token))
    if not n:
        return 1.0
    share = sum(c in FREQUENT for c in letters) / sum(map(str.isalpha, letters))
    seen = sum(c in FREQUENT for c in token)
    return _normal_tail((seen - 0.5 - n * share) / math.sqrt(n * share * (1 - share)))


def battery(token: str, encoding: str) -> tuple[float, float, float, float]:
    """p-values of uniformity, runs, serial correlation and prose if ``token`` is random."""
    letters = ALPHABETS[encoding]
    values = np.array([letters.index(c) for c in token.rstrip("=")], dtype=float)
    n, size = len(values), len(letters)
    counts = np.bincount(values.astype(int), minlength=size)
    uniform = _chi2_tail(float(((counts - n / size) ** 2).sum() * size / n), size - 1)
    high = values >= size / 2
    above = int(high.sum())
    below = n - above
    if above and below:
        expected = 1 + 2 * above * below / n
        spread = (expected - 1) * (expected - 2) / max(n - 1, 1)
        seen = 1 + int((high[1:] != high[:-1]).sum())
        runs = 2 * _normal_tail(abs(seen - expected) / math.sqrt(spread)) if spread > 0 else 1.0
    else:
        runs = 2.0 ** (1 - n)
    centred = values - values.mean()
    power = float((centred**2).sum())
    serial = float(size) ** (1 - n)  # all are equal
    if power:
        correlation = float((centred[1:] * centred[:-1]).sum()) / power
        serial = 2 * _normal_tail(abs(correlation + 1 / n) * math.sqrt(n))
    return uniform, runs, serial, prose(token, letters)


def combined(token: str, encoding: str) -> float:
    """Fisher's combination of the battery, as a p-value of being random."""
    half = -sum(math.log(max(p, 1e-300)) for p in battery(token, encoding))
    # The tail of chi-squared with eight degrees has a closed form.
    return min(1.0, math.exp(-half) * (1 + half + half**2 / 2 + half**3 / 6))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the fixed patterns, sorted."""
    found = []
    lower = text.lower()
    if any(k in lower for k in KEYWORDS):
        found += [
            (m.start(), 0, m.end())
            for m in ASSIGN.finditer(text)
            if len(m.group(2)) >= LEAST_ASSIGN
        ]
    if "AKIA" in text:
        found += [
            (m.start(), 1, m.end())
            for m in ACCESS.finditer(text)
            if m.end() - m.start() >= LEAST_ACCESS
        ]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def candidates(text: str, start: int, end: int) -> list[tuple[int, int, str]]:
    """A stretch of token characters and the long parts between its slashes, each to be tested."""
    whole = text[start:end]
    parts = [m for m in PART.finditer(whole) if m.group() != whole] if "/" in whole else []
    return [(start, end, whole), *((start + m.start(), start + m.end(), m.group()) for m in parts)]


def judged_tokens(text: str, known: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, str]]:
    """``(start, end, what is tested)`` of tokens and of the parts between their slashes.

    Of a token that the sorted ``known`` spans overlap, what they leave is tested: stretches
    of ``LEAST_TOKEN`` characters by themselves, shorter ones together, however short that
    is. A short stretch before an assignment is judged with the name that it begins.
    """
    at = 0  # of the known spans, those before end before the token
    reached = 0  # end of what the passed spans cover
    for m in TOKEN.finditer(text):
        start, end = m.span()
        free, names, place = [], [], max(start, reached)
        while at < len(known) and known[at][0] < end:
            if known[at][0] > place:
                free.append((place, known[at][0]))
                if known[at][1] == 0:
                    names.append(free[-1])
            reached = max(reached, known[at][2])
            place = max(place, reached)
            at += 1
        if place < end:
            free.append((place, end))
        tests = []
        for s, e in free:
            if e - s >= LEAST_TOKEN:
                tests += candidates(text, s, e)
        short = [(s, e) for s, e in free if e - s < LEAST_TOKEN and text[s:e].strip("+/=_-")]
        rest = "".join(text[s:e] for s, e in short if (s, e) not in names)
        tests += [(s, e, m.group() if (s, e) in names else rest) for s, e in short]
        yield from tests


def battery_bin(judged: str) -> tuple[int, int]:
    """Bin of the battery's p-value, and band of length."""
    depth = -math.log10(max(combined(judged, alphabet_of(judged)), 1e-300))
    return min(BINS - 1, int(depth / BIN_WIDTH)), min(BANDS - 1, int(math.log2(len(judged))))


def tested_tokens(text: str, known: list[tuple[int, int, int]]) -> list[tuple[int, int, int, int]]:
    """``(start, end, bin, band)`` of what ``judged_tokens`` finds."""
    return [(s, e, *battery_bin(judged)) for s, e, judged in judged_tokens(text, known)]


def codes_of(text: str) -> np.ndarray:
    return CODES[np.frombuffer(text.encode(), dtype=np.uint8)]


def ordinary_codes(text: str) -> np.ndarray:
    """The short words of ``text``, joined: what the tested tokens leave of it."""
    codes = codes_of(TOKEN.sub(" ", text))
    return codes[codes < CLASSES]


def pairs_of(codes: np.ndarray) -> np.ndarray:
    """Numbers of the neighbouring characters of a word."""
    left, right = codes[:-1].astype(np.int64), codes[1:]
    return (left * CLASSES + right)[(left < CLASSES) & (right < CLASSES)]


def count_pairs(docs: DataFrame, text_column: str = "text") -> np.ndarray:
    """How often each pair stands in the short words of all rows; the driver gets one count a pair."""
    kinds = CLASSES * CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("secrets")
        counts = np.zeros(kinds, dtype=np.int64)
        for batch in batches:
            for part in slices([batch], "text"):
                for text in filter(None, part.column("text").to_pylist()):
                    counts += np.bincount(pairs_of(ordinary_codes(text)), minlength=kinds)
        yield pa.record_batch([pa.array(np.arange(kinds)), pa.array(counts)], names=["pair", "n"])

    texts = docs.select(F.col(f"`{text_column}`").cast("string").alias("text"))
    counted = texts.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = np.bincount(pairs_of(ordinary_codes(PRIOR)), minlength=kinds)
    for row in counted.collect():
        counts[row["pair"]] += row["n"]
    return counts


def likeness(counts: np.ndarray) -> np.ndarray:
    """For each pair, hundredths of the log ratio of the second character behind the first in
    ordinary words to the same in a random token of letters and digits."""
    table = counts.reshape(CLASSES, CLASSES) + 0.5
    chance = np.full(CLASSES, 1 / 36)
    chance[-1] = 10 / 36
    return np.rint(100 * np.log(table / table.sum(axis=1, keepdims=True) / chance)).astype(np.int64).ravel()


def stretch_sums(text: str, like: np.ndarray) -> tuple[int, int, int]:
    """Number, sum and sum of squares of the likeness of the stretches of ordinary text."""
    scores = like[pairs_of(ordinary_codes(text))]
    sums = scores[: len(scores) // STRETCH * STRETCH].reshape(-1, STRETCH).sum(axis=1)
    return len(sums), int(sums.sum()), int((sums * sums).sum())


def token_likeness(judged: str, like: np.ndarray) -> tuple[int, int]:
    """Sum of the likeness of a token, and its number of pairs."""
    pairs = pairs_of(codes_of(judged))
    return int(like[pairs].sum()), len(pairs)


SPANS = pa.list_(
    pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())])
)
TESTED_FIELDS = ("start", "end", "bin", "band", "likeness", "pairs")
TESTED = pa.list_(pa.struct([(f, pa.int64() if f == "likeness" else pa.int32()) for f in TESTED_FIELDS]))


def scan(
    docs: DataFrame, like: np.ndarray, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """``doc_id``, the ``base`` spans, the ``tested`` tokens and the ``ordinary`` stretches of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_over("secrets")
        for batch in slices(batches, "text"):
            base, tested, ordinary = [], [], []
            for text in batch.column(1).to_pylist():
                text = text or ""
                known = base_spans(text)
                base.append([dict(zip(("start", "kind", "end"), s, strict=True)) for s in known])
                tested.append([
                    dict(zip(TESTED_FIELDS, (s, e, *battery_bin(j), *token_likeness(j, like)), strict=True))
                    for s, e, j in judged_tokens(text, known)
                ])
                ordinary.append(stretch_sums(text, like))
            yield pa.record_batch(
                [
                    batch.column(0),
                    pa.array(base, SPANS),
                    pa.array(tested, TESTED),
                    *(pa.array([o[k] for o in ordinary], pa.int64()) for k in range(3)),
                ],
                names=["doc_id", "base", "tested", "stretches", "total", "squares"],
            )

    return select_text(docs, id_column, text_column).mapInArrow(
        run,
        "doc_id long, base array<struct<start: int, kind: int, end: int>>, tested array<struct<"
        "start: int, end: int, bin: int, band: int, likeness: long, pairs: int>>, "
        "stretches long, total long, squares long",
    )


def discard_bins(counts: dict[tuple[int, int], int], rate: float = DISCOVERY_RATE) -> list[int]:
    """For each band of length, the first bin whose tokens are not random.

    ``counts`` has the number of tokens by band and bin over all documents. This is the
    step-up rule on p-values weighted by length, with weights that average to one over
    the tokens; a bin's largest p-value stands for all of it, which only discards less.
    A p-value before ``LEAST_BIN`` is never significant, however much its token weighs.
    """
    total = sum(counts.values())
    if not total:
        return [BINS] * BANDS
    mean = sum(n * 2**band for (band, _), n in counts.items()) / total
    levels = sorted(
        (10 ** (-b * BIN_WIDTH) * mean / 2**band, band, b, n)
        for (band, b), n in counts.items()
        if b >= LEAST_BIN
    )
    seen, level = 0, -1.0
    for weighted, _, _, n in levels:
        seen += n
        if weighted <= rate * seen / total:
            level = weighted
    first = [BINS] * BANDS
    for weighted, band, b, _ in levels:
        if weighted <= level:
            first[band] = min(first[band], b)
    return first


def count_bins(found: DataFrame) -> dict[tuple[int, int], int]:
    """Number of tested tokens by band and bin, at most BANDS * BINS counts."""
    tokens = found.select(F.explode("tested").alias("t"))
    rows = tokens.groupBy("t.band", "t.bin").count().collect()
    return {(r["band"], r["bin"]): r["count"] for r in rows}


def ordinary_pair(found: DataFrame, like: np.ndarray) -> tuple[float, float]:
    """Mean and variance of the likeness of a pair of ordinary text, over all rows."""
    exact = [F.sum(F.col(c).cast("decimal(38,0)")) for c in ("stretches", "total", "squares")]
    own = stretch_sums(PRIOR, like)
    n, total, squares = (int(a or 0) + b for a, b in zip(found.agg(*exact).first(), own, strict=True))
    mean = total / n
    return mean / STRETCH, max((squares / n - mean * mean) / STRETCH, 1.0)


def report_bin(counts: dict[int, int], rate: float = REPORT_RATE) -> int:
    """The first bin of distance whose tokens are no ordinary words, by the step-up rule.

    ``counts`` has the number of tokens by bin; a bin's largest p-value stands for all of it.
    """
    total, seen, first = sum(counts.values()), 0, FAR_BINS
    for b in sorted(counts, reverse=True):
        seen += counts[b]
        if _normal_tail(b * FAR_WIDTH) <= rate * seen / total:
            first = b
    return first


def far_bin(likeness: Column, pairs: Column, mean: float, variance: float) -> Column:
    """How far below ordinary text of as many pairs a token is; without pairs, not at all."""
    distance = (pairs * mean - likeness) / F.sqrt(F.greatest(pairs, F.lit(1)) * variance)
    return F.least(F.greatest(F.floor(distance / FAR_WIDTH), F.lit(0)), F.lit(FAR_BINS - 1)).cast("int")


def controls(found: DataFrame, like: np.ndarray) -> tuple[Callable[[Column], Column], tuple]:
    """Whether to report a token of ``tested``, as a function of columns and as plain numbers."""
    bins = discard_bins(count_bins(found))
    mean, variance = ordinary_pair(found, like)
    first = F.array(*map(F.lit, bins))

    def kept(t: Column) -> Column:
        return t["bin"] < F.get(first, t["band"])

    tokens = found.select(F.explode(F.filter("tested", kept)).alias("t"))
    far = far_bin(F.col("t.likeness"), F.col("t.pairs"), mean, variance)
    level = report_bin({r["far"]: r["count"] for r in tokens.groupBy(far.alias("far")).count().collect()})

    def reported(t: Column) -> Column:
        return kept(t) & (far_bin(t["likeness"], t["pairs"], mean, variance) >= level)

    return reported, (bins, level, mean, variance)


def find_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id`` and ``spans`` (start, kind, end in code points) of every row.

    Kinds are numbers into ``KINDS``. A null or empty text has no spans; repeated rows
    and null ids are scanned like others, and each token counts once for every row
    that holds it. Spans may overlap: a value and the hex run in it, or a token and a part
    between its slashes that is random by itself. The texts are read twice, for the pairs of
    ordinary words and for the tests; the driver gets numbers of pairs and of bins only.
    """
    like = likeness(count_pairs(docs, text_column))
    found = stored(scan(docs, like, id_column, text_column), "secrets")
    reported, _ = controls(found, like)
    random = F.transform(
        F.filter("tested", reported),
        lambda t: F.struct(t["start"].alias("start"), F.lit(3).alias("kind"), t["end"].alias("end")),
    )
    return found.select("doc_id", F.array_sort(F.concat("base", random)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of the spans in turn, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    parts = F.transform(
        spans,
        lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string")
        ),
    )
    return F.array_join(parts, ",")


def redact(text: str, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with every stretch that spans cover replaced by ``mark``."""
    parts, at = [], 0
    for start, end in sorted(spans):
        if start >= at:
            parts += [text[at:start], mark]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def redact_secrets(docs: DataFrame, text_column: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in the text replaced by ``mark``; nothing else changes.

    The texts are read three times, for the pairs of ordinary words, for the controls over all
    rows and for the replacement, and never shuffled. A null text stays null.
    """
    like = likeness(count_pairs(docs, text_column))
    numbered = docs.select(F.lit(0).alias("doc_id"), F.col(f"`{text_column}`").alias("text"))
    _, (bins, level, mean, variance) = controls(stored(scan(numbered, like).drop("base"), "tested"), like)

    def is_reported(judged: str) -> bool:
        b, band = battery_bin(judged)
        if b >= bins[band]:
            return False
        total, pairs = token_likeness(judged, like)
        distance = (pairs * mean - total) / math.sqrt(max(pairs, 1) * variance)
        return min(max(math.floor(distance / FAR_WIDTH), 0), FAR_BINS - 1) >= level

    @F.arrow_udf("string")
    def redacted(texts: pa.Array) -> pa.Array:
        take_over("secrets")
        out = []
        for value in texts:  # one text at a time becomes a Python string
            text = value.as_py()
            if text is not None:
                base = base_spans(text)
                spans = [(s, e) for s, _, e in base]
                spans += [(s, e) for s, e, judged in judged_tokens(text, base) if is_reported(judged)]
                text = redact(text, spans, mark) if spans else text
            out.append(text)
        return pa.array(out, pa.string())

    return docs.withColumn(text_column, redacted(F.col(f"`{text_column}`").cast("string")))
