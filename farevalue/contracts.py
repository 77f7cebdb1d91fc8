"""Declared table schemas, and the checks that need only a schema."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructType


def literal_rows(spark: SparkSession, schema: StructType, rows: Sequence[Sequence]) -> DataFrame:
    """Return ``rows`` as a frame that needs no Python worker and has a known, tiny size."""
    structs = [
        F.struct(*(F.lit(value).cast(f.dataType).alias(f.name) for f, value in zip(schema, row)))
        for row in rows
    ]
    row_type = ", ".join(f"`{f.name}`: {f.dataType.simpleString()}" for f in schema)
    return spark.range(0, 1, 1, 1).select(
        F.inline(F.array(*structs).cast(f"array<struct<{row_type}>>"))
    )


@dataclass(frozen=True)
class Drift:
    """One difference between a contract and the schema of a frame."""

    kind: str  # "missing", "mismatch" or "unexpected"
    column: str
    expected: str | None
    actual: str | None


@dataclass(frozen=True)
class Contract:
    """Column names and types a table must have, its key and its time interval."""

    name: str
    ddl: str
    key: str | None = None
    interval: tuple[str, str] | None = None

    @cached_property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)  # parsed by Spark: needs a running session

    @property
    def columns(self) -> list[str]:
        return self.schema.names

    def type_of(self, column: str) -> DataType:
        return self.schema[column].dataType

    def is_text(self, column: str) -> bool:
        return isinstance(self.type_of(column), StringType)

    def empty(self, spark: SparkSession) -> DataFrame:
        return literal_rows(spark, self.schema, [])

    def drift(self, df: DataFrame) -> list[Drift]:
        """Compare the schema of ``df`` by type text; reads no data."""
        found = dict(df.dtypes)
        drifts = []
        for field in self.schema:
            wanted, given = field.dataType.simpleString(), found.pop(field.name, None)
            if given is None:
                drifts.append(Drift("missing", field.name, wanted, None))
            elif given != wanted:
                drifts.append(Drift("mismatch", field.name, wanted, given))
        return drifts + [Drift("unexpected", *extra) for extra in _extras(found)]

    def pad(self, df: DataFrame) -> DataFrame:
        """Add the columns that ``df`` lacks as typed nulls, in one projection."""
        absent = [f for f in self.schema.fields if f.name not in df.columns]
        return df.withColumns({f.name: F.lit(None).cast(f.dataType) for f in absent})

    def conform(self, df: DataFrame) -> DataFrame:
        """Select the contract columns, in order, with the contract types."""
        return df.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema))


def _extras(columns: dict[str, str]) -> list[tuple[str, None, str]]:
    return [(name, None, kind) for name, kind in sorted(columns.items())]


def union_all(contract: Contract, spark: SparkSession, *frames: DataFrame) -> DataFrame:
    """Union by name; without any frame, an empty one with the contract's schema."""
    if not frames:
        return contract.empty(spark)
    result = frames[0]
    for frame in frames[1:]:
        result = result.unionByName(frame)
    return result


# The layouts of the input and of every table the job writes.

ENVELOPE = Contract(
    "envelope",
    """
    origin string, destination string, departure_date string, ingest_ts string,
    response struct<itineraries: array<struct<
        ignav_id: string, id: string, cabin_class: string,
        price: struct<amount: double, currency: string>,
        outbound: struct<
            carrier: string,
            segments: array<struct<departure_time_utc: string, arrival_time_utc: string>>>>>>
    """,
)

BRONZE_CASH = Contract(
    "bronze_cash",
    """
    flight_id string, origin_airport string, destination_airport string, airline string,
    departure_datetime string, arrival_datetime string, cabin_class string,
    cash_price double, currency string, ingestion_timestamp string, ingestion_date date
    """,
    key="flight_id",
)

SILVER_CASH = Contract(
    "silver_cash",
    BRONZE_CASH.ddl
    + ", departure_ts timestamp, arrival_ts timestamp, flight_duration_minutes double",
    key="flight_id",
)

AWARD = Contract(
    "bronze_award",
    """
    flight_id string, origin_airport string, destination_airport string,
    departure_datetime string, arrival_datetime string, airline string, cabin_class string,
    points_required bigint, program string, award_type string, ingestion_timestamp string
    """,
    key="flight_id",
)

GOLD = Contract(
    "gold",
    """
    flight_id string, origin_airport string, destination_airport string, airline string,
    departure_datetime string, arrival_datetime string, cash_price double, currency string,
    points_required bigint, cpp_cents_per_point double, cabin_class string, program string,
    award_type string, ingestion_timestamp string
    """,
    key="flight_id",
    interval=("departure_datetime", "arrival_datetime"),
)

SERVING = Contract(
    "serving",
    """
    flight_id string, origin_airport string, destination_airport string, airline string,
    departure_datetime timestamp, arrival_datetime timestamp, cash_price double,
    currency string, points_required bigint, cpp_cents_per_point double, cabin_class string,
    program string, award_type string, ingestion_timestamp timestamp, departure_month date
    """,
    key="flight_id",
)

FLAGS = Contract(
    "quality_flags",
    """
    run_id string not null, flight_id string, check_name string not null,
    severity string not null, field_name string, message string not null,
    observed_value string, detected_at timestamp not null
    """,
)

METRICS = Contract(
    "quality_metrics",
    """
    run_id string not null, metric_name string not null, field_name string not null,
    metric_value double not null, threshold double not null, status string not null,
    total_records bigint not null, failed_records bigint not null,
    measured_at timestamp not null
    """,
)
