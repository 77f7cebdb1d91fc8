"""Readers with explicit schemas."""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

from farevalue.contracts import ENVELOPE, SERVING
from farevalue.sources.versions import Versions, quoted

# The column with the text of a line that does not fit the declared schema.
REJECTED = "rejected_line"


def read_envelopes(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Read raw fare envelopes.

    JSON lines are the default because such files split into many tasks. A
    ``multi_line`` file (one JSON array) is read by one task, so large input in
    that form should come as many files. A malformed line has its text in ``REJECTED``,
    which is null for the others.
    """
    schema = StructType([*ENVELOPE.schema, StructField(REJECTED, StringType())])
    reader = spark.read.schema(schema).option("multiLine", multi_line)
    reader = reader.option("columnNameOfCorruptRecord", REJECTED)
    return _found(path, lambda: reader.json(path))


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Read Parquet; a path that is not there raises ``FileNotFoundError``.

    The check is Spark's own, so it holds for remote file systems too.
    """
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _found(path, lambda: reader.parquet(path))


def read_buckets(spark: SparkSession, path: str, schema: StructType, key: str, buckets: int) -> DataFrame:
    """Read what ``overwrite_buckets`` wrote, as an external table that knows its buckets."""
    name = f"farevalue_{hashlib.md5(path.encode()).hexdigest()}"
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY (`{key}`) INTO {buckets} BUCKETS LOCATION {quoted(path)}"
        )
    return spark.table(name)


def read_serving(spark: SparkSession, path: str) -> DataFrame:
    """Read the published table as its newest finished run left it; folders are months."""
    versions = Versions(spark, path, period=SERVING.columns[-1])
    return versions.read(StructType(SERVING.schema[:-1]))


def _found(path: str, load) -> DataFrame:
    try:
        return load()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"Source path does not exist: {path}") from error
        raise
