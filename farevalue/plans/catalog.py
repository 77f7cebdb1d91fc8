"""The registered queries: each runs operators over whole tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from datetime import date, datetime, timezone
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType

from farevalue.contracts import AWARD, BRONZE_CASH, ENVELOPE, GOLD, SERVING, SILVER_CASH
from farevalue.functions.text import first_filled
from farevalue.functions.time import utc_iso_text
from farevalue.operators import publish, quality, search
from farevalue.operators.enrich import add_flight_times
from farevalue.operators.flatten import flatten_flown_fares, flatten_fares
from farevalue.operators.pricing import LOAD_TIME_CANDIDATES, RateCard, look_up, price_awards
from farevalue.operators.valuation import (
    MISSED,
    TRACKED,
    count_joinable,
    find_hot,
    frequent_ids,
    value_fares,
)
from farevalue.plans import oracle as sql
from farevalue.plans.medallion import STEPS, Layout, read_layer, run_job
from farevalue.plans.star_schema import (
    cash_fares,
    envelopes,
    line_flight_id,
    single_fare_envelopes,
    table,
)
from farevalue.session import join_by_bucket, scratch_path
from farevalue.sources.files import contents
from farevalue.sources.readers import read_buckets, read_serving, read_table
from farevalue.sources.writers import overwrite, overwrite_buckets, overwrite_partitions

RUN = quality.Run("run-1", datetime(2026, 7, 1, tzinfo=timezone.utc))
LOADED_AT = "2026-07-01T00:00:00+00:00"
SEARCH_DAY = date(1996, 7, 6)


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


CATALOG: dict[str, Query] = {}


def registered(oracle: str | None):
    def add(function):
        CATALOG[function.__name__] = Query(function, oracle)
        return function

    return add


def _as_text(df: DataFrame) -> DataFrame:
    """Times and days as ISO text, which every engine prints alike."""
    plain = {}
    for field in df.schema.fields:
        if isinstance(field.dataType, TimestampType):
            plain[field.name] = utc_iso_text(F.col(field.name))
        elif isinstance(field.dataType, DateType):
            plain[field.name] = F.col(field.name).cast("string")
    return df.withColumns(plain)


_SHARED: dict[tuple[str, ...], object] = {}

# Bytes of order lines per bucket of a table that is stored by flight: one task sorts both sides of a
# bucket at once.
BUCKET_BYTES = 8 * 1024**2


def _once(spark: SparkSession, sf_dir: str, label: str, make: Callable[[], object]):
    """What several queries start from, made once per session and folder."""
    key = (spark.sparkContext.applicationId, sf_dir, label)
    if key not in _SHARED:
        _SHARED[key] = make()
    return _SHARED[key]


def _bucketed(df: DataFrame, label: str, buckets: int) -> DataFrame:
    """``df`` as a table stored by flight; without buckets, as a plain one."""
    spark, path = df.sparkSession, scratch_path(df.sparkSession, label)
    if not buckets:
        overwrite(df, path)
        return read_table(spark, path)
    overwrite_buckets(df, path, "flight_id", buckets)
    return read_buckets(spark, path, df.schema, "flight_id", buckets)


def _dealt_fares(
    spark: SparkSession,
    sf_dir: str,
    by: Callable[[Column], Column] = lambda flight_id: flight_id,
    change: Callable[[DataFrame], DataFrame] = lambda cash: cash,
) -> list[tuple[DataFrame, int]]:
    """Stored cash fares as parts that share no flight, with the buckets of each.

    Rows are dealt to buckets by flight, which is the one shuffle of all that joins or groups by it.
    Flights that alone would outgrow a bucket make a second part without buckets, where AQE can
    cut them; a sketch of the order lines finds them. ``by`` makes the flight of a fare from the
    one of its order line, and ``change`` makes the fare.
    """
    join_by_bucket(spark)
    lines = table(spark, sf_dir, "lineitem")
    size = contents(spark, f"{sf_dir}/lineitem.parquet").size
    buckets = max(spark.sparkContext.defaultParallelism, size // BUCKET_BYTES)
    rows = lines.count()
    least = max(rows // buckets, int(rows * MISSED) // TRACKED, 1)
    flight = by(line_flight_id()).alias("flight_id")
    heavy = _stored(frequent_ids(lines.select(flight), least).select(F.col("flight_id").alias("heavy")), "heavy")
    if heavy.isEmpty():
        chosen = [(lines, buckets)]
    else:
        is_heavy = by(line_flight_id()) == F.col("heavy")
        usual = lines.join(F.broadcast(heavy), is_heavy, "left_anti")
        chosen = [(usual, buckets), (lines.join(F.broadcast(heavy), is_heavy, "left_semi"), 0)]
    return [
        (_bucketed(change(cash_fares(spark, sf_dir, some, dealt, by)), "cash", dealt), dealt)
        for some, dealt in chosen
    ]


def cash_parts(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, int]]:
    """Stored cash fares, which the job has before it makes gold; see ``_dealt_fares``."""
    return _once(spark, sf_dir, "cash", lambda: _dealt_fares(spark, sf_dir))


def fare_parts(spark: SparkSession, sf_dir: str) -> list[tuple[DataFrame, DataFrame, int]]:
    """Stored cash fares with their stored award prices, and the buckets of both."""

    def price() -> list[tuple[DataFrame, DataFrame, int]]:
        return [
            (cash, _bucketed(price_awards(cash), "awards", buckets), buckets)
            for cash, buckets in cash_parts(spark, sf_dir)
        ]

    join_by_bucket(spark)
    return _once(spark, sf_dir, "awards", price)


def gold_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """Gold from stored cash and awards, stored itself: what the job does."""

    def value() -> list[DataFrame]:
        return [
            _bucketed(value_fares(cash, awards), "gold", buckets)
            for cash, awards, buckets in fare_parts(spark, sf_dir)
        ]

    join_by_bucket(spark)
    return _once(spark, sf_dir, "gold", value)


def _together(parts: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def valued_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold, not stored."""
    return _together(value_fares(cash, awards) for cash, awards, _ in fare_parts(spark, sf_dir))


def gold_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _together(gold_parts(spark, sf_dir))


def published(spark: SparkSession, sf_dir: str) -> str:
    """The folder of a serving table with its documents and facets, published once a session."""

    def publish_once() -> str:
        path = scratch_path(spark, "serving")
        publish.publish_parts(spark, gold_parts(spark, sf_dir), path)
        return path

    return _once(spark, sf_dir, "serving", publish_once)


def _stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table, for operators that read their input more than once."""
    path = scratch_path(df.sparkSession, label)
    overwrite(df, path)
    return read_table(df.sparkSession, path)


def served_fares(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = gold_parts(spark, sf_dir)
    return _together(publish.latest_per_key(publish.serving_rows(part)) for part in parts)


def nested_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes taken through JSON text and the declared read schema."""
    text = envelopes(spark, sf_dir).select(F.to_json(F.struct("*")).alias("line"))
    return text.select(F.from_json("line", ENVELOPE.schema).alias("e")).select("e.*")


# Nested source and typed times


@registered(
    f"""WITH {sql.ORDER_LEGS} SELECT flight_id, origin AS origin_airport,
 destination AS destination_airport, airline, dep AS departure_datetime, arr AS arrival_datetime,
 'economy' AS cabin_class, price AS cash_price, 'USD' AS currency,
 ingest_ts AS ingestion_timestamp, day AS ingestion_date FROM fares"""
)
def flatten_itineraries(spark, sf_dir):
    return _as_text(flatten_fares(nested_envelopes(spark, sf_dir)))


@registered(
    f"""WITH {sql.ORDER_LEGS} SELECT flight_id, origin, destination, airline,
 dep AS departure_date, arr AS arrival_dt, price, 'USD' AS currency, ingest_ts
 FROM fares WHERE dep IS NOT NULL"""
)
def flatten_skip_empty(spark, sf_dir):
    return flatten_flown_fares(nested_envelopes(spark, sf_dir))


@registered(
    f"""WITH {sql.ORDER_LEGS} SELECT day AS ingestion_date, cast(count(*) AS bigint) AS fares,
 min(price) AS lowest_price, max(price) AS highest_price FROM fares GROUP BY 1"""
)
def ingestion_day(spark, sf_dir):
    path = scratch_path(spark, "bronze-cash")
    fares = flatten_fares(nested_envelopes(spark, sf_dir))
    overwrite_partitions(fares, path, "ingestion_date")
    stored = read_table(spark, path).groupBy("ingestion_date").agg(
        F.count(F.lit(1)).alias("fares"),
        F.min("cash_price").alias("lowest_price"),
        F.max("cash_price").alias("highest_price"),
    )
    return _as_text(stored)


@registered(
    f"""WITH {sql.CASH}, t AS (SELECT *, try_cast(departure_datetime AS timestamp) AS d,
 try_cast(arrival_datetime AS timestamp) AS a FROM cash)
SELECT flight_id, departure_datetime, arrival_datetime, strftime(d, '{sql.ISO}') AS departure_ts,
 strftime(a, '{sql.ISO}') AS arrival_ts, (epoch(a) - epoch(d)) / 60 AS flight_duration_minutes FROM t"""
)
def silver_duration(spark, sf_dir):
    silver = add_flight_times(cash_fares(spark, sf_dir))
    return _as_text(
        silver.select(
            "flight_id",
            "departure_datetime",
            "arrival_datetime",
            "departure_ts",
            "arrival_ts",
            "flight_duration_minutes",
        )
    )


# Pricing


@registered(f"WITH {sql.CASH},{sql.award()} SELECT * FROM award")
def award_points(spark, sf_dir):
    return price_awards(cash_fares(spark, sf_dir))


@registered(
    f"""WITH {sql.CASH},{sql.award(cabin="'economy'", program="award", loaded=f"'{LOADED_AT}'")}
SELECT * FROM award"""
)
def award_program_variant(spark, sf_dir):
    return price_awards(
        cash_fares(spark, sf_dir), cabin="economy", program="award", loaded_at=LOADED_AT
    )


@registered(
    f"""WITH {sql.CASH}, given AS (SELECT * EXCLUDE (ingestion_timestamp),
 CASE WHEN currency = ' ' THEN '' WHEN airline IS NOT NULL THEN ingestion_timestamp END AS ingestion_timestamp,
 CASE WHEN cabin_class = 'business' THEN concat(ingestion_timestamp, '+1') END AS ingest_ts,
 substr(ingestion_timestamp, 1, 10) AS ingestion_date FROM cash)
SELECT flight_id, cash_price, coalesce(nullif(ingestion_timestamp, ''), nullif(ingest_ts, ''),
 ingestion_date) AS load_time FROM given"""
)
def award_load_time(spark, sf_dir):
    cash = cash_fares(spark, sf_dir)
    loaded = F.col("ingestion_timestamp")
    given = cash.withColumns(
        {
            "ingestion_timestamp": F.when(F.col("currency") == " ", "").when(
                F.col("airline").isNotNull(), loaded
            ),
            "ingest_ts": F.when(
                F.col("cabin_class") == "business", F.concat(loaded, F.lit("+1"))
            ),
            "ingestion_date": loaded.try_cast("date"),
        }
    )
    load_time = first_filled(given, LOAD_TIME_CANDIDATES).alias("load_time")
    return given.select("flight_id", "cash_price", load_time)


@registered(
    f"""WITH {sql.CASH},{sql.award(points='''cast(CASE WHEN origin_airport = destination_airport
 THEN 5000.0 WHEN cabin_class = 'business' THEN 40000.75 ELSE 12000.25 END - 0.5 AS decimal(20, 2))''')}
SELECT * REPLACE (cast(trunc(points_required) AS bigint) AS points_required) FROM award"""
)
def award_custom_points(spark, sf_dir):
    def flat_rate(origin, destination, airline, cabin):
        rate = F.when(origin == destination, 5000.0).when(cabin == "business", 40000.75)
        return rate.otherwise(12000.25) - 0.5

    return price_awards(cash_fares(spark, sf_dir), points=flat_rate)


# Valuation


@registered(f"{sql.GOLD_TABLES} SELECT * FROM gold")
def gold_cpp(spark, sf_dir):
    return valued_fares(spark, sf_dir)


@registered(
    f"""WITH {sql.CASH} SELECT CASE WHEN flight_id IS NULL OR origin_airport IS NULL
 OR destination_airport IS NULL OR airline IS NULL OR departure_datetime IS NULL
 OR arrival_datetime IS NULL THEN 'dropped' ELSE 'kept' END AS outcome,
 cast(count(*) AS bigint) AS records FROM cash GROUP BY 1"""
)
def gold_null_keys_dropped(spark, sf_dir):
    return count_joinable(cash_fares(spark, sf_dir))


@registered(
    f"""WITH {sql.CASH},{sql.award('a1')},{sql.award('a2', cabin="'economy'", program='award')},
both_awards AS (SELECT * FROM a1 UNION ALL SELECT * FROM a2),{sql.gold('both_awards')}
SELECT * FROM gold"""
)
def gold_two_programs(spark, sf_dir):
    """Every fare meets two award rows, so every key multiplies."""
    join_by_bucket(spark)
    valued = []
    for cash, _ in cash_parts(spark, sf_dir):
        awards = price_awards(cash).unionByName(price_awards(cash, cabin="economy", program="award"))
        valued.append(value_fares(cash, awards))
    return _together(valued)


def _repeated_id(flight_id: Column) -> Column:
    order = F.substring_index(F.substr(flight_id, F.lit(2)), "-", 1).cast("bigint")
    return F.concat(F.lit("R"), F.floor(order / 16).cast("string"))


def _repeated(cash: DataFrame) -> DataFrame:
    """The lines of 16 orders as copies of one flight."""
    return cash.withColumns(
        {
            "flight_id": _repeated_id(F.col("flight_id")),
            "origin_airport": F.lit("LAX"),
            "destination_airport": F.lit("JFK"),
            "departure_datetime": F.lit("2026-07-01T10:00:00Z"),
            "arrival_datetime": F.lit("2026-07-01T18:00:00Z"),
        }
    )


@registered(
    f"""WITH {sql.CASH.replace("cash AS (", "single AS (", 1)}, cash AS (SELECT * REPLACE (
 concat('R', cast(cast(string_split(substr(flight_id, 2), '-')[1] AS bigint) // 16 AS string)) AS flight_id,
 'LAX' AS origin_airport, 'JFK' AS destination_airport,
 '2026-07-01T10:00:00Z' AS departure_datetime, '2026-07-01T18:00:00Z' AS arrival_datetime) FROM single),
{sql.award()},{sql.gold()}
SELECT flight_id, airline, cabin_class, cast(count(*) AS bigint) AS fares,
 min(cpp_cents_per_point) AS lowest_cpp, max(cpp_cents_per_point) AS highest_cpp
 FROM gold GROUP BY ALL"""
)
def gold_repeated_flights(spark, sf_dir):
    """Many copies of each flight on both sides; the busier ones are joined in pieces."""
    valued = []
    for cash, buckets in _dealt_fares(spark, sf_dir, _repeated_id, _repeated):
        awards = _bucketed(price_awards(cash), "awards", buckets)
        hot = _bucketed(find_hot(cash, awards, pairs=1000), "hot", buckets)
        # Ids that one task can repeat are not shuffled again after the join.
        far = hot.where("far")
        valued.append(value_fares(cash, awards, None if far.isEmpty() else far, hot.where("NOT far")))
    return _together(valued).groupBy("flight_id", "airline", "cabin_class").agg(
        F.count(F.lit(1)).alias("fares"),
        F.min("cpp_cents_per_point").alias("lowest_cpp"),
        F.max("cpp_cents_per_point").alias("highest_cpp"),
    )


_STRICT_TIERS = """given AS (SELECT *, CASE airline WHEN 'Frontier' THEN 'ULTRA_HAUL' WHEN 'Delta' THEN 'SHORT_HAUL'
  WHEN 'United' THEN NULL ELSE 'MEDIUM_HAUL' END AS tier FROM cash)"""


@registered(
    f"""WITH {sql.CASH}, {_STRICT_TIERS}
SELECT flight_id, tier, CASE tier WHEN 'SHORT_HAUL' THEN cast(1 AS double) WHEN 'MEDIUM_HAUL' THEN 2.0 END AS multiplier,
 CASE WHEN coalesce(tier, '') NOT IN ('SHORT_HAUL', 'MEDIUM_HAUL') THEN concat(
   'No multiplier is listed for tier = ', coalesce(tier, 'null')) END AS error FROM given"""
)
def strict_tier(spark, sf_dir):
    """Listed tiers with their multiplier; for the others the error that pricing would raise."""
    tier = (
        F.when(F.col("airline") == "Frontier", "ULTRA_HAUL")
        .when(F.col("airline") == "Delta", "SHORT_HAUL")
        .when(F.col("airline") == "United", None)
        .otherwise("MEDIUM_HAUL")
    )
    given = cash_fares(spark, sf_dir).select("flight_id", tier.alias("tier"))
    tiers = RateCard.standard(spark).tiers
    return look_up(given, tiers, {"tier": "tier"}, "multiplier", "multiplier", error="error")


# Quality


def _flag_rows(flags: DataFrame) -> DataFrame:
    return flags.drop("run_id", "detected_at")


def _drifted(cash: DataFrame) -> DataFrame:
    """Cash fares that fit the gold contract badly: absent, mistyped and extra columns."""
    return cash.drop("currency").withColumns(
        {
            "points_required": F.round(F.col("cash_price")).cast("bigint").cast("string"),
            "unexpected_field": F.lit("extra"),
        }
    )


_ABSENT = ("currency", "cpp_cents_per_point", "program", "award_type")
_DRIFTED = """drifted AS (SELECT * EXCLUDE (currency),
 cast(cast(round(cash_price) AS bigint) AS string) AS points_required FROM cash)"""
_SCHEMA_ROWS = " UNION ALL ".join(
    [
        f"""SELECT cast(NULL AS string) AS flight_id, 'SCHEMA_MISSING_COLUMN' AS check_name, 'error' AS severity,
 '{name}' AS field_name, 'Required column ''{name}'' is missing.' AS message,
 cast(NULL AS string) AS observed_value"""
        for name in _ABSENT
    ]
    + [
        """SELECT NULL, 'SCHEMA_TYPE_MISMATCH', 'error', 'points_required',
 'Expected bigint but received string.', 'string'""",
        """SELECT NULL, 'SCHEMA_UNEXPECTED_COLUMN', 'warning', 'unexpected_field',
 'Unexpected column ''unexpected_field'' was found.', 'string'""",
    ]
)
_RATE_FLAG_COUNTS = """SELECT 'NULL_RATE_THRESHOLD_EXCEEDED' AS check_name, 'warning' AS severity,
 field_name FROM rates WHERE metric_value > threshold"""


def _counted(source: str) -> str:
    return f"""SELECT check_name, severity, field_name, cast(count(*) AS bigint) AS flags
 FROM ({source}) GROUP BY ALL"""


def _all_flags(source: str) -> str:
    branches = [sql.missing_flags(source), sql.duplicate_flags(source), sql.interval_flags(source)]
    return " UNION ALL ".join(f"SELECT check_name, severity, field_name FROM ({b})" for b in branches)


def _count_flags(flags: DataFrame) -> DataFrame:
    return flags.groupBy("check_name", "severity", "field_name").agg(
        F.count(F.lit(1)).alias("flags")
    )


@registered(f"{sql.GOLD_TABLES} {sql.missing_flags('gold')}")
def q_missing_required(spark, sf_dir):
    flags = quality.row_flags(gold_fares(spark, sf_dir), GOLD, RUN)
    return _flag_rows(flags.where(F.col("check_name") == quality.MISSING_FIELD[0]))


@registered(f"{sql.GOLD_TABLES} {sql.duplicate_flags('gold')}")
def q_duplicate_ids(spark, sf_dir):
    return _flag_rows(quality.duplicate_flags(gold_fares(spark, sf_dir), GOLD, RUN))


@registered(f"{sql.GOLD_TABLES} {sql.interval_flags('gold')}")
def q_invalid_times(spark, sf_dir):
    flags = quality.row_flags(gold_fares(spark, sf_dir), GOLD, RUN)
    return _flag_rows(flags.where(F.col("check_name") == quality.INVALID_TIMES[0]))


@registered(
    f"""WITH {sql.CASH}, {_DRIFTED}, found AS (
 SELECT check_name, severity, field_name FROM ({_SCHEMA_ROWS})
 UNION ALL SELECT check_name, severity, field_name FROM ({sql.missing_flags('drifted', _ABSENT)})
 UNION ALL SELECT check_name, severity, field_name FROM ({sql.duplicate_flags('drifted')})
 UNION ALL SELECT check_name, severity, field_name FROM ({sql.interval_flags('drifted')})),
rates AS ({sql.null_rates('drifted', 0.05, _ABSENT)})
{_counted(f'SELECT * FROM found UNION ALL {_RATE_FLAG_COUNTS}')}"""
)
def q_schema_drift(spark, sf_dir):
    drifted = _stored(_drifted(cash_fares(spark, sf_dir)), "drifted")
    return _count_flags(quality.validate(drifted, GOLD, RUN.run_id, at=RUN.at).flags)


@registered(_SCHEMA_ROWS)
def q_schema_flags(spark, sf_dir):
    """The flags of the schema alone, with their texts."""
    return _flag_rows(quality.schema_flags(_drifted(cash_fares(spark, sf_dir)), GOLD, RUN))


@registered(
    f"""{sql.GOLD_TABLES}, rates AS ({sql.null_rates('gold', 0.05)})
SELECT *, CASE WHEN metric_value > threshold THEN 'failed' ELSE 'passed' END AS status FROM rates"""
)
def q_null_rate(spark, sf_dir):
    counts = quality.count_empty(gold_fares(spark, sf_dir), GOLD)
    metrics = quality.rate_metrics(counts, GOLD, RUN)
    return metrics.drop("run_id", "measured_at")


@registered(
    f"""WITH {sql.CASH}, {_DRIFTED}, rates AS ({sql.null_rates('drifted', 0.1, _ABSENT)})
SELECT cast(NULL AS string) AS flight_id, 'NULL_RATE_THRESHOLD_EXCEEDED' AS check_name,
 'warning' AS severity, field_name, 'Field null rate exceeded its configured threshold.' AS message,
 metric_value AS rate, threshold FROM rates WHERE metric_value > threshold"""
)
def q_null_rate_flags(spark, sf_dir):
    """The rate and threshold are read back from the text, as numbers."""
    padded = GOLD.pad(_drifted(cash_fares(spark, sf_dir)))
    counts = quality.count_empty(padded, GOLD)
    flags = _flag_rows(
        quality.rate_flags(quality.rate_metrics(counts, GOLD, RUN, threshold=0.1))
    )
    parts = F.split("observed_value", ", ")
    return flags.withColumns(
        {
            "rate": F.substring_index(parts[0], "=", -1).cast("double"),
            "threshold": F.substring_index(parts[1], "=", -1).cast("double"),
        }
    ).drop("observed_value")


@registered(
    f"""{sql.GOLD_TABLES}, rates AS ({sql.null_rates('gold', 0.05)})
{_counted(f"{_all_flags('gold')} UNION ALL {_RATE_FLAG_COUNTS}")}"""
)
def q_validate_all(spark, sf_dir):
    return _count_flags(quality.validate(gold_fares(spark, sf_dir), GOLD, RUN.run_id).flags)


def _every_flag(source: str) -> str:
    return " UNION ALL ".join(
        [sql.missing_flags(source), sql.duplicate_flags(source), sql.interval_flags(source)]
    )


@registered(
    f"""{sql.GOLD_TABLES}, rates AS ({sql.null_rates('gold', 0.05)}),
found AS (SELECT flight_id, check_name, severity, field_name, message, observed_value, NULL AS rate
  FROM ({_every_flag('gold')})
 UNION ALL SELECT NULL, 'NULL_RATE_THRESHOLD_EXCEEDED', 'warning', field_name,
  'Field null rate exceeded its configured threshold.', NULL, metric_value FROM rates
  WHERE metric_value > threshold)
SELECT 'run-1' AS run_id, *, '2026-07-01T00:00:00+00:00' AS detected_at FROM found"""
)
def q_validate_table(spark, sf_dir):
    """All columns of all flags of a stored table, as written; the rate is read from its text."""
    source, results = scratch_path(spark, "gold"), scratch_path(spark, "quality")
    overwrite(valued_fares(spark, sf_dir), source)
    quality.validate_table(spark, source, results, run_id=RUN.run_id, at=RUN.at)
    flags = quality.read_flags(spark, results)
    is_rate = F.col("check_name") == quality.NULL_RATE_EXCEEDED[0]
    rate = F.substring_index(F.substring_index("observed_value", ",", 1), "=", -1)
    return _as_text(
        flags.withColumns(
            {
                "rate": F.when(is_rate, rate.cast("double")),
                "observed_value": F.when(~is_rate, F.col("observed_value")),
            }
        )
    )


@registered(
    f"""{sql.GOLD_TABLES}, rates AS ({sql.null_rates('gold', 0.05)})
SELECT 'run-1' AS run_id, *, CASE WHEN metric_value > threshold THEN 'failed' ELSE 'passed' END AS status,
 '2026-07-01T00:00:00+00:00' AS measured_at FROM rates"""
)
def q_validate_table_metrics(spark, sf_dir):
    """All columns of the metrics that a validation of a stored table writes."""
    source, results = scratch_path(spark, "gold"), scratch_path(spark, "quality")
    overwrite(valued_fares(spark, sf_dir), source)
    quality.validate_table(spark, source, results, run_id=RUN.run_id, at=RUN.at)
    return _as_text(quality.read_metrics(spark, results))


# Serving


@registered(f"{sql.SERVED_TABLES} SELECT {sql.SERVED_TEXT} FROM served")
def latest_per_flight(spark, sf_dir):
    return _as_text(served_fares(spark, sf_dir))


@registered(
    f"""{sql.SERVED_TABLES} SELECT {sql.SERVED_TEXT} FROM served WHERE origin_airport = 'LAX'
 AND destination_airport = 'JFK' ORDER BY {sql.BY_CPP} LIMIT 100"""
)
def search_by_cpp(spark, sf_dir):
    fares = served_fares(spark, sf_dir)
    return _as_text(search.search(fares, origin="LAX", destination="JFK", cabin="All"))


@registered(
    f"""{sql.SERVED_TABLES} SELECT {sql.SERVED_TEXT} FROM served WHERE airline = 'Delta'
 AND cabin_class = 'business' ORDER BY {sql.BY_PRICE} LIMIT 25"""
)
def search_by_price(spark, sf_dir):
    fares = served_fares(spark, sf_dir)
    found = search.search(
        fares, airline="Delta", cabin="business", origin="", sort_by="cash_price", size=25
    )
    return _as_text(found)


@registered(
    f"""{sql.SERVED_TABLES} SELECT {sql.SERVED_TEXT} FROM served
 WHERE cast(departure_datetime AS date) = DATE '{SEARCH_DAY}' ORDER BY {sql.BY_CPP} LIMIT 100"""
)
def search_day(spark, sf_dir):
    return _as_text(search.search(served_fares(spark, sf_dir), departure_date=SEARCH_DAY))


@registered(
    f"{sql.SERVED_TABLES} SELECT {sql.SERVED_TEXT} FROM served WHERE destination_airport = 'SFO'"
)
def search_all_matches(spark, sf_dir):
    return _as_text(search.search(served_fares(spark, sf_dir), destination="SFO", size=None))


@registered(
    f"""{sql.SERVED_TABLES} SELECT cast(count(*) AS bigint) AS matches FROM served
 WHERE origin_airport = 'SFO' AND airline = 'United'"""
)
def search_count(spark, sf_dir):
    return search.count_matches(served_fares(spark, sf_dir), origin="SFO", airline="United")


def _facet_sql(facets: dict[str, str], source: str, limit: int | None = None) -> str:
    counts = " UNION ALL ".join(
        f"""SELECT '{facet}' AS facet, {column} AS value, cast(count(*) AS bigint) AS records
 FROM {source} WHERE {column} IS NOT NULL GROUP BY 2"""
        for facet, column in facets.items()
    )
    if limit is None:
        return f"SELECT facet, value FROM ({counts})"
    return f"""SELECT * FROM ({counts})
 QUALIFY row_number() OVER (PARTITION BY facet ORDER BY records DESC, value) <= {limit}"""


@registered(f"{sql.SERVED_TABLES} {_facet_sql(search.FACETS, 'served', 100)}")
def facet_top_terms(spark, sf_dir):
    return search.facet_terms(served_fares(spark, sf_dir))


_BUSY_FACETS = {"departures": "departure_datetime", "arrivals": "arrival_datetime"}


@registered(f"WITH {sql.CASH} {_facet_sql(_BUSY_FACETS, 'cash', 100)}")
def facet_top_departures(spark, sf_dir):
    """Facets with far more values than are returned."""
    return search.facet_terms(cash_fares(spark, sf_dir), _BUSY_FACETS)


@registered(f"{sql.SERVED_TABLES} {_facet_sql(search.FACETS, 'served')}")
def facet_distinct(spark, sf_dir):
    return search.facet_values(served_fares(spark, sf_dir))


@registered(
    f"""{sql.SERVED_TABLES} SELECT
 (SELECT string_agg(DISTINCT origin_airport, '|' ORDER BY origin_airport) FROM served) AS origins,
 (SELECT string_agg(DISTINCT destination_airport, '|' ORDER BY destination_airport) FROM served) AS destinations,
 (SELECT string_agg(DISTINCT cabin_class, '|' ORDER BY cabin_class) FROM served) AS cabins,
 (SELECT string_agg(DISTINCT airline, '|' ORDER BY airline) FROM served) AS airlines"""
)
def filter_options(spark, sf_dir):
    options = search.filter_options(served_fares(spark, sf_dir))
    return options.select(*(F.array_join(name, "|").alias(name) for name in search.FACETS))


@registered(f"{sql.SERVED_TABLES} {_facet_sql(search.FACETS, 'served', 100)}")
def facet_terms_stored(spark, sf_dir):
    """The terms from the counts written at publish time; reads no fare."""
    stored = publish.read_facets(spark, published(spark, sf_dir))
    return search.top_terms(search.summed_facets(stored))


@registered(
    f"""{sql.SERVED_TABLES} SELECT 'all' AS selection, cast(count(*) AS bigint) AS matches FROM served
 UNION ALL SELECT 'from SFO', count(*) FROM served WHERE origin_airport = 'SFO'
 UNION ALL SELECT 'Delta', count(*) FROM served WHERE airline = 'Delta'
 UNION ALL SELECT 'unlisted', 0"""
)
def match_counts_stored(spark, sf_dir):
    """Numbers of matches from the stored counts."""
    stored = publish.read_facets(spark, published(spark, sf_dir))
    asked = {
        "all": (None, None),
        "from SFO": ("origins", "SFO"),
        "Delta": ("airlines", "Delta"),
        "unlisted": ("airlines", "Nobody"),
    }
    counts = [
        search.summed_matches(stored, facet, value).select(F.lit(name).alias("selection"), "matches")
        for name, (facet, value) in asked.items()
    ]
    return reduce(DataFrame.unionByName, counts)


@registered(
    f"""{sql.SERVED_TABLES} SELECT origin_airport AS "Origin", destination_airport AS "Destination",
 strftime(departure_datetime, '%Y-%m-%d %H:%M UTC') AS "Departure",
 strftime(arrival_datetime, '%Y-%m-%d %H:%M UTC') AS "Arrival", airline AS "Airline",
 cabin_class AS "Cabin", concat(currency, ' ', format('{{:,.2f}}', cash_price)) AS "Cash price",
 points_required AS "Points",
 CASE WHEN cpp_cents_per_point IS NULL THEN 'Not available'
   ELSE concat(format('{{:.2f}}', cpp_cents_per_point), ' cents') END AS "CPP",
 program AS "Award program" FROM served"""
)
def display_rows(spark, sf_dir):
    return search.display_rows(served_fares(spark, sf_dir))


@registered(
    f"""{sql.SERVED_TABLES} SELECT 'flight_redemptions' AS "_index", flight_id AS "_id",
 {sql.SERVED_TEXT} FROM served"""
)
def search_documents(spark, sf_dir):
    """Documents as publishing wrote them, with the fields read back out of their JSON."""
    documents = publish.read_documents(spark, published(spark, sf_dir))
    layout = _as_text(SERVING.empty(spark)).schema
    fields = F.from_json("_source", layout).alias("source")
    return documents.select("_index", "_id", fields).select("_index", "_id", "source.*")


# The whole job


def raw_layout(spark: SparkSession, sf_dir: str) -> Layout:
    """A new layout whose raw folder holds the cash fares as JSON lines."""
    # The days of the test tables hold a few hundred rows each, so a period is a year.
    layout = Layout(scratch_path(spark, "raw"), scratch_path(spark, "tables"), period="year")
    raw = single_fare_envelopes(cash_fares(spark, sf_dir))
    write_raw(raw, layout.raw)
    return layout


# Lines of a raw file: a gzip file is read by one task, so each file stays small.
RAW_FILE_ROWS = 200_000


def write_raw(envelopes: DataFrame, path: str) -> None:
    """Write envelopes as JSON lines, compressed: as plain text they take many times the tables."""
    envelopes.write.option("compression", "gzip").option("maxRecordsPerFile", RAW_FILE_ROWS).json(path)


@registered(
    f"""WITH {sql.CASH},{sql.award()},{sql.gold()},{sql.SERVED},
rates AS ({sql.null_rates('gold', 0.05)}),
found AS (SELECT check_name FROM ({_all_flags('gold')})
 UNION ALL SELECT check_name FROM ({_RATE_FLAG_COUNTS}))
SELECT 'bronze/cash' AS layer, cast(count(*) AS bigint) AS records FROM cash
UNION ALL SELECT 'silver/cash', count(*) FROM cash
UNION ALL SELECT 'bronze/award', count(*) FROM award
UNION ALL SELECT 'gold', count(*) FROM gold
UNION ALL SELECT concat('quality/flags ', check_name), count(*) FROM found GROUP BY check_name
UNION ALL SELECT concat('quality/metrics ', CASE WHEN metric_value > threshold THEN 'failed'
  ELSE 'passed' END), count(*) FROM rates GROUP BY 1
UNION ALL SELECT 'serving', count(*) FROM served"""
)
def medallion_end_to_end(spark, sf_dir):
    """Raw JSON lines through all steps of the job; records per written table."""
    layout = raw_layout(spark, sf_dir)
    for result in run_job(spark, layout):
        if result.error is not None:
            raise result.error
    flags = quality.read_flags(spark, layout.quality)
    metrics = quality.read_metrics(spark, layout.quality)
    layers = [
        _layer_count("bronze/cash", read_layer(spark, layout.bronze_cash, BRONZE_CASH)),
        _layer_count("silver/cash", read_layer(spark, layout.silver_cash, SILVER_CASH)),
        _layer_count("bronze/award", read_layer(spark, layout.bronze_award, AWARD)),
        _layer_count("gold", read_layer(spark, layout.gold, GOLD)),
        _layer_count("quality/flags ", flags, "check_name"),
        _layer_count("quality/metrics ", metrics, "status"),
        _layer_count("serving", read_serving(spark, layout.serving)),
    ]
    return reduce(DataFrame.unionByName, layers)


@registered(f"WITH {sql.CASH},{sql.award()},{sql.gold()} SELECT * FROM gold")
def gold_day_wise(spark, sf_dir):
    """Gold of two loads: everything, with the last four months of wrong prices, and these months
    again with the right ones."""
    layout = Layout(
        scratch_path(spark, "raw"), scratch_path(spark, "tables"), keep_other_days=True, period="year"
    )
    cash = _together(part for part, _ in cash_parts(spark, sf_dir))
    late = F.col("ingestion_timestamp") >= "1998-05-01"
    wrong = F.when(late, F.lit(1.0)).otherwise(F.col("cash_price"))
    for fares, folder in ((cash.withColumn("cash_price", wrong), "first"), (cash.where(late), "second")):
        write_raw(single_fare_envelopes(fares), f"{layout.raw}/{folder}")
        for result in run_job(spark, replace(layout, raw=f"{layout.raw}/{folder}"), STEPS[:4]):
            if result.error is not None:
                raise result.error
    return read_layer(spark, layout.gold, GOLD)


def _layer_count(layer: str, df: DataFrame, by: str | None = None) -> DataFrame:
    records = F.count(F.lit(1)).alias("records")
    if by is None:
        return df.agg(records).select(F.lit(layer).alias("layer"), "records")
    counted = df.groupBy(by).agg(records)
    return counted.select(F.concat(F.lit(layer), F.col(by)).alias("layer"), "records")


def best_redemptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 100 fares with the most cents per point."""
    return search.search(served_fares(spark, sf_dir))
