"""Parquet and document sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter


def overwrite(df: DataFrame, path: str) -> None:
    """Replace the table at ``path``."""
    df.write.mode("overwrite").parquet(path)


def overwrite_buckets(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """Replace the table at ``path`` by one that is bucketed and sorted by ``key``; rows that come
    dealt by it leave one file per bucket."""
    writer = df.write.mode("overwrite").format("parquet").option("compression", "zstd")
    save_buckets(df.sparkSession, writer, path, key, buckets)


def save_buckets(spark, writer: DataFrameWriter, path: str, key: str, buckets: int) -> None:
    name = f"farevalue_{uuid.uuid4().hex}"
    writer.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")  # external: the files stay


def overwrite_partitions(
    df: DataFrame,
    path: str,
    by: str,
    only_present: bool = False,
    rebalance: bool = True,
) -> None:
    """Replace a table that has one folder per value of ``by``.

    ``only_present`` replaces only the partitions found in ``df`` and keeps the
    others. ``rebalance`` shuffles by ``by`` so that small values do not leave a
    file per task, while AQE cuts a value that outgrows the advisory partition
    size over several tasks. Input that is already clustered by ``by`` saves that
    shuffle with ``rebalance=False``.
    """
    if rebalance:
        df = df.hint("rebalance", by)
    mode = "dynamic" if only_present else "static"
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(by)
        .parquet(path)
    )


def overwrite_ranges(df: DataFrame, path: str, by: str, order: tuple[str, ...]) -> None:
    """Replace a table that has one folder per value of ``by`` and whose rows are
    range-partitioned and sorted by ``by`` and ``order``."""
    ranged = df.repartitionByRange(by, *order).sortWithinPartitions(by, *order)
    ranged.write.mode("overwrite").partitionBy(by).parquet(path)


def write_documents(documents: DataFrame, path: str) -> None:
    """Write search documents as JSON lines."""
    documents.write.mode("overwrite").json(path, ignoreNullFields=False)
