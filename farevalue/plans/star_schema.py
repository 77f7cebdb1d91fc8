"""Cash fares and raw envelopes derived from the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _picked(selector: Column, values: list[str], otherwise: str | None = None) -> Column:
    """``values[selector]``; ``otherwise`` past their end."""
    found = F.get(F.array(*(F.lit(value) for value in values)), selector.cast("int"))
    return found if otherwise is None else F.coalesce(found, F.lit(otherwise))


def _day(column: str) -> Column:
    return F.col(column).cast("date").cast("string")


def _arrival_hour() -> Column:
    return (8 + F.col("l_quantity") % 16).cast("int")


def _leg_times(day: Column, hour: Column) -> tuple[Column, Column]:
    """Departure and arrival of an order line, as text."""
    departure = F.concat(day, F.lit("T10:00:00Z"))
    clock = F.lpad(hour.cast("string"), 2, "0")
    return departure, F.concat(day, F.lit("T"), clock, F.lit(":30:00Z"))


# Bits of the parts of ``code`` below the day of shipping, and their values for text that is not a
# time, and for null.
HOUR_BITS, ORIGIN_BITS, DESTINATION_BITS, AIRLINE_BITS = 6, 2, 2, 3
NO_TIME, NO_HOUR = 62, 63
LEAST_HOUR = -16
NO_DAY = 2**40

AIRLINES = ["Delta", "American Airlines", "United", "Alaska Airlines", "Frontier", "Other Air"]


def _with_bits(code: Column, value: Column, bits: int = 1) -> Column:
    return F.shiftleft(code, bits).bitwiseOR(value.cast("bigint"))


def _place(selector: Column, known: int) -> Column:
    """The place of a value in a list of ``known`` ones; all others share the place after them."""
    return F.when((selector >= 0) & (selector < known), selector).otherwise(known)


def _line_numbers(lines: DataFrame) -> DataFrame:
    """What a fare takes from its order line, in as few columns as possible: these rows are
    shuffled per join. ``code`` holds the day of shipping, the hour of arrival, business and a
    blank currency in its bits."""
    day = F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint")
    hour = F.coalesce(_arrival_hour() - LEAST_HOUR, F.lit(NO_HOUR))
    code = F.coalesce(day, F.lit(NO_DAY))
    code = _with_bits(code, F.when(F.col("l_quantity") == 50, NO_TIME).otherwise(hour), HOUR_BITS)
    code = _with_bits(code, F.when(F.col("l_returnflag") == "R", 1).otherwise(0))
    code = _with_bits(code, F.when(F.col("l_tax") == 0, 1).otherwise(0))
    keys = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return lines.select(*keys, code.alias("code"))


def line_flight_id() -> Column:
    """The flight of an order line."""
    order, line = F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")
    return F.concat(F.lit("F"), order, F.lit("-"), line)


def _fare_numbers(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """Order lines joined with all that a fare takes from other tables, still in numbers.

    Each join adds bits to ``code`` and drops its key. Orders meet their customers first, so
    that lines, the longest table, are shuffled once for orders and customers."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", _place(F.col("c_nationkey") % 3, 2).alias("destination")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("ordered")
    )
    ordered = orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).drop("o_custkey", "c_custkey")
    parts = table(spark, sf_dir, "part").select(
        "p_partkey", _place(F.col("p_size") % 7, len(AIRLINES)).alias("airline")
    )
    suppliers = table(spark, sf_dir, "supplier").select(
        "s_suppkey", _place(F.col("s_nationkey") % 3, 2).alias("origin")
    )

    def added(rows: DataFrame, name: str, bits: int, *keys: str) -> DataFrame:
        return rows.withColumn("code", _with_bits(F.col("code"), F.col(name), bits)).drop(name, *keys)

    rows = _line_numbers(lines).join(parts, F.col("l_partkey") == F.col("p_partkey"))
    rows = added(rows, "airline", AIRLINE_BITS, "l_partkey", "p_partkey")
    rows = rows.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
    rows = added(rows, "origin", ORIGIN_BITS, "l_suppkey", "s_suppkey")
    rows = rows.join(ordered, F.col("l_orderkey") == F.col("o_orderkey"))
    return added(rows, "destination", DESTINATION_BITS, "o_orderkey")


def cash_fares(
    spark: SparkSession,
    sf_dir: str,
    lines: DataFrame | None = None,
    buckets: int = 0,
    by: Callable[[Column], Column] = lambda flight_id: flight_id,
) -> DataFrame:
    """One fare per order line, with planted faults: null airlines, blank currencies,
    unreadable arrivals, arrivals before departure, repeated ids, and cabins, airlines
    and routes that the rule tables do not list.

    ``lines`` are the order lines, all of them if not given. With ``buckets`` the rows are dealt
    by their id, or what ``by`` makes of it, while they are still numbers: as text they take
    about twice the bytes.
    """
    lines = table(spark, sf_dir, "lineitem") if lines is None else lines
    rows = _fare_numbers(spark, sf_dir, lines)
    if buckets:
        rows = rows.repartition(buckets, by(line_flight_id()))

    def bits(width: int, above: int) -> Column:
        return F.shiftright("code", above).bitwiseAND(F.lit(2**width - 1))

    destination, origin = bits(DESTINATION_BITS, 0), bits(ORIGIN_BITS, DESTINATION_BITS)
    above = DESTINATION_BITS + ORIGIN_BITS
    airline, untaxed, business = bits(AIRLINE_BITS, above), bits(1, above + 3), bits(1, above + 4)
    hour, day = bits(HOUR_BITS, above + 5), F.shiftright("code", above + 5 + HOUR_BITS)
    shipped = F.date_from_unix_date(F.when(day != NO_DAY, day).cast("int")).cast("string")
    known_hour = F.when(hour != NO_HOUR, (hour + LEAST_HOUR).cast("int"))
    departure, arrival = _leg_times(shipped, known_hour)
    return rows.select(
        line_flight_id().alias("flight_id"),
        _picked(origin, ["LAX", "SFO"], "JFK").alias("origin_airport"),
        _picked(destination, ["JFK", "SFO"], "LAX").alias("destination_airport"),
        _picked(airline, AIRLINES).alias("airline"),
        departure.alias("departure_datetime"),
        F.when(hour == NO_TIME, "not-a-time").otherwise(arrival).alias("arrival_datetime"),
        F.when(business == 1, "business").otherwise("economy").alias("cabin_class"),
        F.col("l_extendedprice").alias("cash_price"),
        F.when(untaxed == 1, " ").otherwise("USD").alias("currency"),
        F.concat(F.col("ordered").cast("string"), F.lit("T00:00:00+00:00")).alias("ingestion_timestamp"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One nested envelope per order, with an empty segment list for an order without
    lines.

    The segments are the first and the last line of the order, found by ``min`` and
    ``max``. Those aggregate before the shuffle and keep two numbers per order, where
    a list of all lines would put a hot order into one task's memory. A number holds
    line, day and hour as decimal digits, so that it sorts like the three.
    """
    day = F.unix_date(F.col("l_shipdate").cast("date"))
    leg = F.col("l_linenumber").cast("bigint") * 10_000_000 + day * 100 + _arrival_hour()
    ends = (
        table(spark, sf_dir, "lineitem")
        .groupBy(F.col("l_orderkey").alias("k"))
        .agg(F.min(leg).alias("first"), F.max(leg).alias("last"))
    )

    def segment(name: str) -> Column:
        hour = F.col(name) % 100
        day = F.date_from_unix_date(F.expr(f"{name} div 100 % 100000").cast("int"))
        departure, arrival = _leg_times(day.cast("string"), hour)
        return F.struct(
            departure.alias("departure_time_utc"), arrival.alias("arrival_time_utc")
        )

    segments = (
        F.when(F.col("first").isNull(), F.array().cast(_SEGMENTS))
        .when(F.col("first") == F.col("last"), F.array(segment("first")))
        .otherwise(F.array(segment("first"), segment("last")))
    )
    orders = table(spark, sf_dir, "orders")
    fare = F.struct(
        F.col("o_orderkey").cast("string").alias("ignav_id"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.lit("economy").alias("cabin_class"),
        F.struct(F.col("o_totalprice").alias("amount"), F.lit("USD").alias("currency")).alias(
            "price"
        ),
        F.struct(F.col("o_orderpriority").alias("carrier"), segments.alias("segments")).alias(
            "outbound"
        ),
    )
    return orders.join(ends, F.col("o_orderkey") == F.col("k"), "left").select(
        _picked(F.col("o_custkey") % 3, ["LAX", "SFO"], "JFK").alias("origin"),
        F.lit("JFK").alias("destination"),
        _day("o_orderdate").alias("departure_date"),
        F.concat(_day("o_orderdate"), F.lit("T00:00:00+00:00")).alias("ingest_ts"),
        F.struct(F.array(fare).alias("itineraries")).alias("response"),
    )


_SEGMENTS = "array<struct<departure_time_utc: string, arrival_time_utc: string>>"


def single_fare_envelopes(fares: DataFrame) -> DataFrame:
    """One envelope per cash fare, with a single segment; needs no grouping."""
    segment = F.struct(
        F.col("departure_datetime").alias("departure_time_utc"),
        F.col("arrival_datetime").alias("arrival_time_utc"),
    )
    fare = F.struct(
        F.col("flight_id").alias("ignav_id"),
        "cabin_class",
        F.struct(F.col("cash_price").alias("amount"), "currency").alias("price"),
        F.struct(F.col("airline").alias("carrier"), F.array(segment).alias("segments")).alias(
            "outbound"
        ),
    )
    return fares.select(
        F.col("origin_airport").alias("origin"),
        F.col("destination_airport").alias("destination"),
        F.col("ingestion_timestamp").alias("ingest_ts"),
        F.struct(F.array(fare).alias("itineraries")).alias("response"),
    )
