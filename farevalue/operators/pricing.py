"""Itineraries priced in loyalty points by rule tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from farevalue.contracts import AWARD, literal_rows
from farevalue.functions.money import whole_points
from farevalue.functions.text import first_filled

# The rule tables and the constants of an award row.
BASE_POINTS = 8000.0
DEFAULT_TIER = "MEDIUM_HAUL"
ROUTE_TIERS = [
    ("LAX", "SFO", "SHORT_HAUL"),
    ("LAX", "JFK", "MEDIUM_HAUL"),
    ("SFO", "JFK", "MEDIUM_HAUL"),
]
TIER_MULTIPLIERS = [("SHORT_HAUL", 1.0), ("MEDIUM_HAUL", 2.0)]
CABIN_MULTIPLIERS = [("economy", 1.0)]
AIRLINE_MULTIPLIERS = [
    ("Delta", 1.2),
    ("American Airlines", 1.1),
    ("United", 1.0),
    ("Alaska Airlines", 1.0),
    ("Frontier", 0.9),
]
DEFAULT_CABIN = "economy"
PROGRAM = "synthetic_generic"
AWARD_TYPE = "points"
LOAD_TIME_CANDIDATES = ("ingestion_timestamp", "ingest_ts", "ingestion_date")

PointsFunction = Callable[[Column, Column, Column, Column], Column]


@dataclass(frozen=True)
class RateCard:
    """Rule tables as DataFrames; a key may occur once per table (``check_rates``).

    The joins carry no broadcast hint. Catalyst broadcasts a table whose size it
    knows to be below ``spark.sql.autoBroadcastJoinThreshold`` and shuffles a
    larger one, so a grown rule table is slower but still works.
    """

    routes: DataFrame  # origin, destination, tier
    tiers: DataFrame  # tier, multiplier
    cabins: DataFrame  # cabin, multiplier
    airlines: DataFrame  # airline, multiplier
    default_tier: str = DEFAULT_TIER
    base_points: float = BASE_POINTS

    @staticmethod
    def standard(spark: SparkSession) -> RateCard:
        def table(ddl: str, rows: list[tuple]) -> DataFrame:
            return literal_rows(spark, StructType.fromDDL(ddl), rows)

        return RateCard(
            routes=table(RATE_TABLES["routes"], ROUTE_TIERS),
            tiers=table(RATE_TABLES["tiers"], TIER_MULTIPLIERS),
            cabins=table(RATE_TABLES["cabins"], CABIN_MULTIPLIERS),
            airlines=table(RATE_TABLES["airlines"], AIRLINE_MULTIPLIERS),
        )


RATE_TABLES = {
    "routes": "origin string, destination string, tier string",
    "tiers": "tier string, multiplier double",
    "cabins": "cabin string, multiplier double",
    "airlines": "airline string, multiplier double",
}


def read_rates(
    spark: SparkSession, folder: str, default_tier: str = DEFAULT_TIER, base_points: float = BASE_POINTS
) -> RateCard:
    """Rule tables from ``routes.csv``, ``tiers.csv``, ``cabins.csv`` and ``airlines.csv``.

    A number that cannot be read fails the job rather than becoming null.
    """
    tables = {
        name: spark.read.schema(ddl).csv(f"{folder}/{name}.csv", header=True, mode="FAILFAST")
        for name, ddl in RATE_TABLES.items()
    }
    return RateCard(**tables, default_tier=default_tier, base_points=base_points)


def check_rates(rates: RateCard) -> None:
    """Raise ``ValueError`` if a rule table repeats a key, which would multiply rows."""
    keyed = {
        "routes": (rates.routes, ["origin", "destination"]),
        "tiers": (rates.tiers, ["tier"]),
        "cabins": (rates.cabins, ["cabin"]),
        "airlines": (rates.airlines, ["airline"]),
    }
    for name, (table, keys) in keyed.items():
        repeated = table.groupBy(*keys).count().where("count > 1").select(*keys).first()
        if repeated is not None:
            raise ValueError(f"Rule table {name} repeats the key {tuple(repeated)}.")


def look_up(
    df: DataFrame,
    table: DataFrame,
    keys: Mapping[str, str],
    value: str,
    into: str,
    default: Column | None = None,
    error: str | None = None,
) -> DataFrame:
    """Add column ``into`` from ``table[value]``, matched on ``{df column: table column}``.

    A key that is null or not listed gets ``default``. Without a default it is an
    error, raised by the value itself so that no pruning can skip the check. With ``error``
    the value is null instead, and a column of that name has the text of the error.
    """
    names = {there: f"__key_{i}" for i, there in enumerate(keys.values())}
    side = table.select(
        *(F.col(there).alias(name) for there, name in names.items()),
        F.col(value).alias("__value"),
    )
    match = [F.col(here) == F.col(names[there]) for here, there in keys.items()]
    failure = None
    if default is None:
        shown = F.concat_ws(", ", *(F.coalesce(F.col(k).cast("string"), F.lit("null")) for k in keys))
        message = F.concat(F.lit(f"No {value} is listed for {', '.join(keys)} = "), shown)
        failure = F.when(F.col("__value").isNull(), message)
        raised = F.lit(None) if error else F.raise_error(message)
        default = raised.cast(table.schema[value].dataType)
    found = F.when(F.col("__value").isNull(), default).otherwise(F.col("__value"))
    columns = {into: found} if error is None else {into: found, error: failure}
    joined = df.join(side, match, "left").withColumns(columns)
    return joined.drop("__value", *names.values())


def add_points(df: DataFrame, rates: RateCard, cabin: str = "cabin_class") -> DataFrame:
    """Add ``points_required`` from the rule tables."""
    one = F.lit(1.0)
    lookups = [
        (
            rates.routes,
            {"origin_airport": "origin", "destination_airport": "destination"},
            "tier",
            "__tier",
            F.lit(rates.default_tier),
        ),
        (rates.tiers, {"__tier": "tier"}, "multiplier", "__route_rate", None),
        (rates.cabins, {cabin: "cabin"}, "multiplier", "__cabin_rate", one),
        (rates.airlines, {"airline": "airline"}, "multiplier", "__airline_rate", one),
    ]
    priced = df
    for table, keys, value, into, default in lookups:
        priced = look_up(priced, table, keys, value, into, default)
    factors = ["__route_rate", "__cabin_rate", "__airline_rate"]
    points = whole_points(rates.base_points, *(F.col(name) for name in factors))
    return priced.withColumn("points_required", points).drop("__tier", *factors)


def price_awards(
    flights: DataFrame,
    rates: RateCard | None = None,
    points: PointsFunction | None = None,
    cabin: str | None = None,
    program: str = PROGRAM,
    award_type: str = AWARD_TYPE,
    loaded_at: str | None = None,
) -> DataFrame:
    """One award row per flight.

    ``points`` replaces the rule tables by a function of the columns (origin,
    destination, airline, cabin) that returns a column; its value is cut to a
    whole number. ``cabin`` and ``loaded_at`` replace the flight's own cabin and
    load time by constants. A flight without an id is priced and keeps its null.
    """
    source_cabin = F.col("cabin_class") if "cabin_class" in flights.columns else F.lit(DEFAULT_CABIN)
    source_time = first_filled(flights, LOAD_TIME_CANDIDATES)
    rows = flights.select(
        "flight_id",
        "origin_airport",
        "destination_airport",
        "departure_datetime",
        "arrival_datetime",
        "airline",
        (source_cabin if cabin is None else F.lit(cabin)).alias("cabin_class"),
        (source_time if loaded_at is None else F.lit(loaded_at)).alias("ingestion_timestamp"),
    )
    if points is not None:
        inputs = ("origin_airport", "destination_airport", "airline", "cabin_class")
        rows = rows.withColumn("points_required", points(*(F.col(c) for c in inputs)))
    else:
        rows = add_points(rows, rates or RateCard.standard(flights.sparkSession))
    rows = rows.withColumns({"program": F.lit(program), "award_type": F.lit(award_type)})
    return AWARD.conform(rows)
