"""WARC archives: write records and an index, then read chosen records by byte range.

Each task writes archives of bounded size, one gzip member per record, and returns a
row per record with its file, offset and length. That index is a table of its own;
readers choose index rows first, and each task merges the sorted byte ranges of a
file that lie close together into one read.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterable, Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from farevalue.llm.common import SLICE_BYTES, slices
from farevalue.session import scratch_path

# Payloads of fewer bytes are never written as revisits.
SMALLEST_REVISIT = 100

# Bytes after which a task starts another archive, the gap that is read over rather
# than split, and the most that one read may take (a larger record is one read).
ARCHIVE_BYTES = 256 * 1024**2
READ_GAP = 64 * 1024
READ_BYTES = 32 * 1024**2

DATE = "1970-01-01T00:00:00Z"  # pages carry no fetch time; a fixed one keeps archives repeatable
# Characters of a URL that stay as they are; the percent sign does not, so reading undoes it.
URL_SAFE = ":/?#[]@!$&'()*+,;=~"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

INDEX = (
    "page_id long, url string, file string, offset long, length long, "
    "payload_digest string, payload_bytes long"
)
RECORD = (
    "page_id long, url string, record_type string, payload binary, payload_bytes long, "
    "payload_digest string, refers_to long"
)


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder given as a path or URI."""
    return pafs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


def record_name(page_id: int | None) -> str:
    return f"<urn:page:{'none' if page_id is None else page_id}>"


def page_of(name: str) -> int | None:
    found = name.rsplit(":", 1)[1].rstrip(">")
    return None if found == "none" else int(found)


def make_record(
    page_id: int | None,
    url: str | None,
    payload: bytes,
    digest: str,
    size: int,
    refers_to: int | None,
) -> bytes:
    """One gzip member with one record; a revisit has no block."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_name(page_id)}",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=URL_SAFE)}")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: {record_name(refers_to)}")
        lines.append(f"WARC-Profile: {PROFILE}")
        payload = b""
    lines.append("Content-Type: text/html")
    lines.append(f"Content-Length: {len(payload)}")
    head = "\r\n".join([*lines, "", ""]).encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + payload + b"\r\n\r\n") + packer.flush()


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Headers, by name in lower case, and block of one gzip member."""
    data = zlib.decompress(raw, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    if not version.startswith("WARC/"):
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    headers = {k.lower(): v for k, v in (line.split(": ", 1) for line in lines)}
    size = int(headers["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record does not end where its length says")
    return headers, rest[:size]


def choose_types(pages: DataFrame, smallest: int = SMALLEST_REVISIT) -> DataFrame:
    """``page_id, url, payload, payload_digest, payload_bytes, refers_to`` of every page.

    The smallest page id of equal payloads is the response and the others refer to it.
    Payloads below ``smallest`` bytes and rows without an id never refer. Only digests
    that occur under several ids are joined back, so a payload that a third of the
    pages share costs one counted row per task before the join.
    """
    named = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"),
    )
    marked = named.withColumn("payload_digest", F.sha2("payload", 256)).withColumn(
        "payload_bytes", F.octet_length("payload").cast("long")
    )
    first = (
        marked.filter(F.col("payload_bytes") >= smallest)
        .groupBy("payload_digest")
        .agg(F.min("page_id").alias("first_id"), F.max("page_id").alias("last_id"))
        .filter("first_id < last_id")
        .drop("last_id")
    )
    joined = marked.join(first, "payload_digest", "left")
    revisit = F.col("page_id") > F.col("first_id")
    return joined.select(
        "page_id", "url", "payload", "payload_digest", "payload_bytes",
        F.when(revisit, F.col("first_id")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write one record per row of ``choose_types``; return the index.

    The index is stored below ``folder`` before it is returned. A task that is run
    again writes files of new names, and only the rows of the attempt that Spark
    commits reach the index, so records of lost attempts are never read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        out, path, offset = None, "", 0
        for batch in slices(batches, "payload"):
            rows = []
            for page in batch.to_pylist():
                if out is None or offset >= ARCHIVE_BYTES:
                    if out is not None:
                        out.close()
                    files.create_dir(root, recursive=True)
                    path, offset = f"{uuid.uuid4().hex}.warc.gz", 0
                    out = files.open_output_stream(f"{root}/{path}", compression=None)
                raw = make_record(
                    page["page_id"], page["url"], page["payload"], page["payload_digest"],
                    page["payload_bytes"], page["refers_to"],
                )
                out.write(raw)
                rows.append(
                    (page["page_id"], page["url"], path, offset, len(raw),
                     page["payload_digest"], page["payload_bytes"])
                )
                offset += len(raw)
            yield to_batch(rows, INDEX)
        if out is not None:
            out.close()

    spark = pages.sparkSession
    index = pages.mapInArrow(run, INDEX)
    index.write.parquet(f"{folder}/index")
    return spark.read.schema(index.schema).parquet(f"{folder}/index")


ARROW_TYPES = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}


def to_batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [()] * len(names)
    return pa.record_batch(
        [pa.array(list(c), ARROW_TYPES[k]) for c, k in zip(columns, kinds, strict=True)],
        names=list(names),
    )


def merge_ranges(
    rows: list[tuple[int, int]], gap: int = READ_GAP, most: int = READ_BYTES
) -> Iterator[tuple[int, int, int]]:
    """``(start, end, number of rows)`` of the reads for rows of sorted offsets and lengths."""
    start = end = None
    number = 0
    for offset, length in rows:
        if number and (offset - end > gap or max(end, offset + length) - start > most):
            yield start, end, number
            number = 0
        if not number:
            start, end = offset, offset
        end = max(end, offset + length)
        number += 1
    if number:
        yield start, end, number


def portions(records: Iterable[tuple], most: int = SLICE_BYTES) -> Iterator[list[tuple]]:
    """Rows of ``RECORD`` in lists that end where their payloads reach ``most`` bytes."""
    rows, size = [], 0
    for row in records:
        rows.append(row)
        size += len(row[3] or b"")
        if size >= most:
            yield rows
            rows, size = [], 0
    if rows:
        yield rows


def read_archives(index: DataFrame, folder: str) -> DataFrame:
    """Read the records of ``index``, any choice of its rows, with merged range reads.

    Rows are cut into ranges of a file and offset before they are dealt out, so one
    large archive is read by several tasks. Records leave in batches of some
    ``SLICE_BYTES`` of payload, or one longer record, however well they were packed. A payload that
    does not fit its digest is an error.
    """
    block = F.floor(F.col("offset") / READ_BYTES).alias("block")
    chosen = index.select("file", "offset", "length", block)
    total = index.agg(F.sum("length")).first()[0] or 0
    parts = max(1, -(-total // READ_BYTES))  # by bytes of archive, which index rows do not show
    dealt = chosen.repartition(parts, "file", "block")
    dealt = dealt.sortWithinPartitions("file", "offset").drop("block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        for batch in batches:
            wanted = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            at = 0
            while at < len(wanted):
                name = wanted[at][0]
                to = next((i for i in range(at, len(wanted)) if wanted[i][0] != name), len(wanted))
                with files.open_input_file(f"{root}/{name}") as source:
                    spans = [(o, n) for _, o, n in wanted[at:to]]
                    done = 0
                    for start, end, number in merge_ranges(spans):
                        source.seek(start)
                        raw = source.read(end - start)
                        records = (
                            read_row(raw[o - start : o - start + n])
                            for o, n in spans[done : done + number]
                        )
                        done += number
                        for rows in portions(records):
                            yield to_batch(rows, RECORD)
                at = to

    return dealt.mapInArrow(run, RECORD)


def read_row(raw: bytes) -> tuple:
    """The columns of ``RECORD`` from the bytes of one record; a revisit has no payload."""
    headers, payload = parse_record(raw)
    kind = headers["warc-type"]
    digest = headers["warc-payload-digest"].removeprefix("sha256:")
    size = int(headers["x-payload-length"])
    if kind == "response" and (
        size != len(payload) or hashlib.sha256(payload).hexdigest() != digest
    ):
        raise ValueError(f"payload of {headers['warc-record-id']} does not fit its digest")
    refers = headers.get("warc-refers-to")
    url = headers.get("warc-target-uri")
    return (
        page_of(headers["warc-record-id"]),
        None if url is None else unquote(url),
        kind,
        payload if kind == "response" else None,
        size,
        digest,
        None if refers is None else page_of(refers),
    )


def archive_folder(spark: SparkSession) -> str:
    """A new folder for archives below the shared scratch folder."""
    return scratch_path(spark, "warc")


def round_trip(pages: DataFrame, folder: str) -> DataFrame:
    """Archive ``page_id, url, html`` and read every record back.

    A null page is an empty payload, a null url has no target, and a null page id is a
    response named ``none``. Rows that repeat a page id and payload are responses each.
    Other columns are ignored; an empty table gives an empty result.
    """
    index = write_archives(choose_types(pages), folder)
    return read_archives(index, folder)
