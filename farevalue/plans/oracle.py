"""SQL for the results of the registered queries, written for DuckDB and
independent of the operators."""

from __future__ import annotations

CASH = """
cash AS (SELECT concat('F', cast(l_orderkey AS string), '-', cast(l_linenumber AS string)) AS flight_id,
 CASE s_nationkey % 3 WHEN 0 THEN 'LAX' WHEN 1 THEN 'SFO' ELSE 'JFK' END AS origin_airport,
 CASE c_nationkey % 3 WHEN 0 THEN 'JFK' WHEN 1 THEN 'SFO' ELSE 'LAX' END AS destination_airport,
 CASE p_size % 7 WHEN 0 THEN 'Delta' WHEN 1 THEN 'American Airlines' WHEN 2 THEN 'United'
   WHEN 3 THEN 'Alaska Airlines' WHEN 4 THEN 'Frontier' WHEN 5 THEN 'Other Air' END AS airline,
 concat(cast(cast(l_shipdate AS date) AS string), 'T10:00:00Z') AS departure_datetime,
 CASE WHEN l_quantity = 50 THEN 'not-a-time'
   ELSE concat(cast(cast(l_shipdate AS date) AS string), 'T',
     lpad(cast(cast(8 + l_quantity % 16 AS int) AS string), 2, '0'), ':30:00Z') END AS arrival_datetime,
 CASE l_returnflag WHEN 'R' THEN 'business' ELSE 'economy' END AS cabin_class,
 l_extendedprice AS cash_price,
 CASE WHEN l_tax = 0 THEN ' ' ELSE 'USD' END AS currency,
 concat(cast(cast(o_orderdate AS date) AS string), 'T00:00:00+00:00') AS ingestion_timestamp
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
 JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey)"""

POINTS = """cast(round_even(cast(8000 AS double)
   * CASE WHEN origin_airport = 'LAX' AND destination_airport = 'SFO' THEN 1.0 ELSE 2.0 END
   * CASE airline WHEN 'Delta' THEN 1.2 WHEN 'American Airlines' THEN 1.1 WHEN 'Frontier' THEN 0.9
       ELSE 1.0 END, 0) AS bigint)"""


def award(name: str = "award", cabin: str = "cabin_class", program: str = "synthetic_generic",
          loaded: str = "ingestion_timestamp", points: str = POINTS, source: str = "cash") -> str:
    return f"""
{name} AS (SELECT flight_id, origin_airport, destination_airport, departure_datetime, arrival_datetime,
 airline, {cabin} AS cabin_class, {points} AS points_required, '{program}' AS program,
 'points' AS award_type, {loaded} AS ingestion_timestamp FROM {source})"""


# Spark rounds the shortest decimal text of a double half up; so does this.
CPP = """CASE WHEN points_required > 0 THEN cast(round(cast(cast(
   cash_price * 100 / points_required AS string) AS decimal(38, 20)), 2) AS double) END"""


def gold(awards: str = "award") -> str:
    return f"""
gold AS (SELECT c.flight_id, c.origin_airport, c.destination_airport, c.airline, c.departure_datetime,
 c.arrival_datetime, cash_price, currency, points_required, {CPP} AS cpp_cents_per_point,
 a.cabin_class, program, award_type, c.ingestion_timestamp
FROM cash c JOIN {awards} a ON c.flight_id = a.flight_id AND c.origin_airport = a.origin_airport
 AND c.destination_airport = a.destination_airport AND c.airline = a.airline
 AND c.departure_datetime = a.departure_datetime AND c.arrival_datetime = a.arrival_datetime)"""


GOLD_TABLES = f"WITH {CASH},{award()},{gold()}"

SERVED = """
typed AS (SELECT flight_id, origin_airport, destination_airport, airline,
 try_cast(departure_datetime AS timestamp) AS departure_datetime,
 try_cast(arrival_datetime AS timestamp) AS arrival_datetime, cash_price, currency, points_required,
 cpp_cents_per_point, cabin_class, program, award_type,
 try_cast(ingestion_timestamp AS timestamp) AS ingestion_timestamp,
 cast(date_trunc('month', try_cast(departure_datetime AS timestamp)) AS date) AS departure_month FROM gold),
served AS (SELECT * FROM typed QUALIFY row_number() OVER (PARTITION BY flight_id
 ORDER BY ingestion_timestamp DESC NULLS LAST, origin_airport NULLS LAST, destination_airport NULLS LAST,
 airline NULLS LAST, departure_datetime NULLS LAST, arrival_datetime NULLS LAST, cash_price NULLS LAST,
 currency NULLS LAST, points_required NULLS LAST, cpp_cents_per_point NULLS LAST,
 cabin_class NULLS LAST, program NULLS LAST, award_type NULLS LAST) = 1)"""

SERVED_TABLES = f"{GOLD_TABLES},{SERVED}"

ISO = "%Y-%m-%dT%H:%M:%S+00:00"
SERVED_TEXT = f"""flight_id, origin_airport, destination_airport, airline,
 strftime(departure_datetime, '{ISO}') AS departure_datetime,
 strftime(arrival_datetime, '{ISO}') AS arrival_datetime, cash_price, currency, points_required,
 cpp_cents_per_point, cabin_class, program, award_type,
 strftime(ingestion_timestamp, '{ISO}') AS ingestion_timestamp,
 cast(departure_month AS string) AS departure_month"""

BY_CPP = "cpp_cents_per_point DESC NULLS LAST, flight_id"
BY_PRICE = "cash_price ASC NULLS LAST, flight_id"

ORDER_LEGS = """
legs AS (SELECT l_orderkey AS k, l_linenumber AS n,
 concat(cast(cast(l_shipdate AS date) AS string), 'T10:00:00Z') AS dep,
 concat(cast(cast(l_shipdate AS date) AS string), 'T',
   lpad(cast(cast(8 + l_quantity % 16 AS int) AS string), 2, '0'), ':30:00Z') AS arr FROM lineitem),
ends AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY n, dep, arr) AS a,
 row_number() OVER (PARTITION BY k ORDER BY n DESC, dep DESC, arr DESC) AS z FROM legs),
fares AS (SELECT cast(o_orderkey AS string) AS flight_id,
 CASE o_custkey % 3 WHEN 0 THEN 'LAX' WHEN 1 THEN 'SFO' ELSE 'JFK' END AS origin,
 'JFK' AS destination, o_orderpriority AS airline, f.dep AS dep, g.arr AS arr, o_totalprice AS price,
 concat(cast(cast(o_orderdate AS date) AS string), 'T00:00:00+00:00') AS ingest_ts,
 cast(cast(o_orderdate AS date) AS string) AS day
FROM orders LEFT JOIN ends f ON f.k = o_orderkey AND f.a = 1
 LEFT JOIN ends g ON g.k = o_orderkey AND g.z = 1)"""

TIMES_INVALID = """departure_datetime IS NOT NULL AND arrival_datetime IS NOT NULL
 AND (try_cast(departure_datetime AS timestamp) IS NULL OR try_cast(arrival_datetime AS timestamp) IS NULL
   OR try_cast(arrival_datetime AS timestamp) <= try_cast(departure_datetime AS timestamp))"""

TEXT_FIELDS = (
    "flight_id", "origin_airport", "destination_airport", "airline", "departure_datetime",
    "arrival_datetime", "currency", "cabin_class", "program", "award_type", "ingestion_timestamp",
)
NUMBER_FIELDS = ("cash_price", "points_required", "cpp_cents_per_point")


def is_empty(field: str) -> str:
    return f"({field} IS NULL OR trim({field}) = '')" if field in TEXT_FIELDS else f"({field} IS NULL)"


def missing_flags(source: str, absent: tuple[str, ...] = ()) -> str:
    """One branch per field; an absent column counts as null in every row."""
    return " UNION ALL ".join(
        f"""SELECT flight_id, 'MISSING_REQUIRED_FIELD' AS check_name, 'error' AS severity,
 '{field}' AS field_name, 'Required field ''{field}'' is empty.' AS message,
 {'NULL' if field in absent else f'cast({field} AS string)'} AS observed_value
 FROM {source} WHERE {'true' if field in absent else is_empty(field)}"""
        for field in TEXT_FIELDS + NUMBER_FIELDS
    )


def duplicate_flags(source: str) -> str:
    return f"""SELECT flight_id, 'DUPLICATE_FLIGHT_ID' AS check_name, 'error' AS severity,
 'flight_id' AS field_name, 'Flight ID occurs more than once in the gold dataset.' AS message,
 cast(count(*) AS string) AS observed_value
 FROM {source} WHERE flight_id IS NOT NULL GROUP BY flight_id HAVING count(*) > 1"""


def interval_flags(source: str) -> str:
    return f"""SELECT flight_id, 'INVALID_FLIGHT_TIMES' AS check_name, 'error' AS severity,
 'departure_datetime,arrival_datetime' AS field_name,
 'Arrival must be a valid timestamp after departure.' AS message,
 concat(departure_datetime, ' -> ', arrival_datetime) AS observed_value
 FROM {source} WHERE {TIMES_INVALID}"""


def null_rates(source: str, threshold: float, absent: tuple[str, ...] = ()) -> str:
    return " UNION ALL ".join(
        f"""SELECT 'null_rate' AS metric_name, '{field}' AS field_name, cast(count(*) AS bigint) AS total_records,
 cast(count(*) FILTER ({'true' if field in absent else is_empty(field)}) AS bigint) AS failed_records,
 CASE WHEN count(*) = 0 THEN 0.0 ELSE count(*) FILTER ({'true' if field in absent else is_empty(field)})
   / count(*) END AS metric_value,
 cast({threshold} AS double) AS threshold FROM {source}"""
        for field in TEXT_FIELDS + NUMBER_FIELDS
    )
