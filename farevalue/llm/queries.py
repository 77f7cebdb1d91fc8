"""Registered queries of the text operators, with SQL where SQL can express them."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from farevalue.llm import (
    bpe,
    conversations,
    embeddings,
    fingerprints,
    jaccard,
    licenses,
    packing,
    repeats,
    resampling,
    secrets,
    sharding,
    toxicity,
    warc,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def warc_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    records = warc.round_trip(table(spark, folder, "pages"), warc.archive_folder(spark))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


WARC_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
m AS (SELECT page_id, strlen(html) AS payload_bytes, sha256(html) AS payload_digest,
  CASE WHEN strlen(html) >= 100 THEN min(page_id) OVER (PARTITION BY html) END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN first_id < page_id THEN first_id END AS refers_to
FROM m
"""


def best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(
        table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json")
    )
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    encoded = bpe.encode(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)
    decoded = bpe.decode(encoded, ranks, public_tokenizers.PATTERN)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


REPEATS_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(words) - 18)) AS pos, words FROM w WHERE len(words) >= 20),
g AS (SELECT doc_id, pos, sha256(array_to_string(words[pos:pos + 19], ' ')) AS h FROM p),
f AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) AS n FROM g),
x AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM f WHERE n > 1),
k AS (SELECT doc_id, list(pos) AS gone FROM x GROUP BY doc_id),
z AS (SELECT w.doc_id, words, len(words) AS n, coalesce(len(gone), 0) AS r, coalesce(gone, []) AS gone
  FROM w LEFT JOIN k ON k.doc_id = w.doc_id),
t AS (SELECT doc_id, words[i] AS word, i FROM (
  SELECT doc_id, words, unnest(range(1, len(words) + 1)) AS i FROM w)),
s AS (SELECT t.doc_id, string_agg(word, ' ' ORDER BY i) AS kept FROM t
  LEFT JOIN x ON x.doc_id = t.doc_id AND x.pos = t.i WHERE x.pos IS NULL GROUP BY t.doc_id)
SELECT z.doc_id, n AS n_words, r AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM z LEFT JOIN s ON s.doc_id = z.doc_id
"""


def jaccard_components(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"), n=3, percent=90)


JACCARD_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words]
    ELSE list_distinct([words[i:i + 2] FOR i IN range(1, len(words) - 1)]) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS size FROM s),
e AS (SELECT doc_id, hash(x) AS h, x FROM (SELECT doc_id, unnest(shingles) AS x FROM s)),
o AS (SELECT a.doc_id AS one, b.doc_id AS two, count(*) AS shared
  FROM e a JOIN e b ON a.h = b.h AND a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT one, two FROM o JOIN n p ON p.doc_id = one JOIN n q ON q.doc_id = two
  WHERE 100 * shared >= 90 * (p.size + q.size - shared)),
b AS (SELECT one AS x, two AS y FROM l UNION ALL SELECT two, one FROM l),
r AS (SELECT doc_id AS x, doc_id AS y FROM documents UNION
  SELECT r.x, b.y FROM r JOIN b ON b.x = r.y)
SELECT n.doc_id, n.size AS n_shingles, c.y AS component_id
FROM n JOIN (SELECT x, min(y) AS y FROM r GROUP BY x) c ON c.x = n.doc_id
"""


FINGERPRINT_ROWS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_chars", pa.int64()),
        ("edited_sha256", pa.string()),
        ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()),
        ("near_edited", pa.float64()),
        ("near_next", pa.float64()),
    ]
)


def edited_row(doc_id: int | None, text: str, following: str) -> tuple:
    """A row of ``FINGERPRINT_ROWS``: the last half is replaced by the next text's start."""
    half = len(text) // 2
    edited = (text[: len(text) - half] + following[:half]).encode()
    own, changed = fingerprints.digest(text.encode()), fingerprints.digest(edited)
    return (
        doc_id,
        len(text),
        hashlib.sha256(edited).hexdigest(),
        own,
        changed,
        fingerprints.likeness(own, changed),
        fingerprints.likeness(own, fingerprints.digest(following.encode())),
    )


def quartile_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.map_with_next(
        table(spark, folder, "documents"),
        edited_row,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
        FINGERPRINT_ROWS,
    )


def secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = secrets.find_secrets(table(spark, folder, "documents"))
    base = F.filter("spans", lambda s: s["kind"] < 3)

    def of_kind(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long")

    return found.select(
        "doc_id",
        of_kind(0).alias("n_assign"),
        of_kind(1).alias("n_access"),
        of_kind(2).alias("n_hex"),
        F.sha2(secrets.span_text(base), 256).alias("base_sha256"),
        secrets.span_text(F.col("spans")).alias("spans"),
    )


def toxicity_grades(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = toxicity.fit(docs, table(spark, folder, "labels"))
    return toxicity.grade(docs, model).select("doc_id", "toxic", "grade", "expected_severity")


def license_scan(spark: SparkSession, folder: str) -> DataFrame:
    counted, findings = licenses.scan(table(spark, folder, "documents"))
    first = F.col("exact")
    per_document = findings.groupBy("doc_id", "key").agg(
        F.sum(first.cast("long")).alias("n_base"),
        F.min(F.when(first, F.col("at"))).cast("long").alias("first_word"),
        F.max(F.when(first, F.col("at"))).cast("long").alias("last_word"),
        F.array_join(F.array_sort(F.collect_set(F.when(first, F.col("label")))), ",").alias("base"),
        F.array_join(F.array_sort(F.collect_set("label")), ",").alias("all"),
        F.max("score").alias("score"),
    )
    return counted.join(per_document, ["doc_id", "key"], "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0)).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base", F.lit("")).alias("base_labels"),
        F.coalesce("all", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def embedding_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.deduplicate(table(spark, folder, "embeddings"))


def importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    drawn = resampling.resample(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repair_damaged(table(spark, folder, "conversations"))


def byte_shards(spark: SparkSession, folder: str) -> DataFrame:
    rows = sharding.reshard_documents(table(spark, folder, "documents"))
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_repeats": substring_dedup,
    "op2_jaccard": jaccard_components,
    "op3_warc": warc_round_trip,
    "op4_fingerprints": quartile_fingerprints,
    "op5_secrets": secret_scan,
    "op6_packing": best_fit_packing,
    "op7_toxicity": toxicity_grades,
    "op8_licenses": license_scan,
    "op9_byte_bpe": byte_bpe,
    "op10_embeddings": embedding_duplicates,
    "op11_resampling": importance_resampling,
    "op12_repair": conversation_repair,
    "op13_sharding": byte_shards,
}

ORACLES: dict[str, str] = {"op1_repeats": REPEATS_SQL, "op2_jaccard": JACCARD_SQL, "op3_warc": WARC_SQL}
