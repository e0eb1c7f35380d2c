"""Raw feeds derived from the test tables.

Each feed is one SELECT over one test table, in SQL that both Spark and DuckDB run, so
that the two sides of a check start from the same rows. They exercise every branch of
the cleaning rules; their size follows the table's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recordloom.session import pin_session
from recordloom.sources import read_table


def _pick(key: str, *values: str | None) -> str:
    branches = " ".join(f"WHEN {i} THEN {'NULL' if v is None else repr(v)}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {branches} END"


def _zip(key: str) -> str:
    return _pick(
        key, "N/A", " na ", "anonymous", "10001", "00501", "100010001", "10001-1234", "10001x1234", "1234", " 1001",
        "99999", None,
    )


def _borough(key: str) -> str:
    return _pick(
        key, "MANHATTAN", "new york county", " Bronx ", "THE BRONX", "brooklyn", "Kings County", "QUEENS", "Queen",
        "Staten Island", "RICHMOND COUNTY", "Jersey", "", None,
    )


REQUESTS = f"""
SELECT
  CASE WHEN event_id % 10 = 9 THEN event_id - 1 ELSE event_id END AS unique_key,
  CASE WHEN event_id % 101 = 0 THEN NULL ELSE ts END AS created_date,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE ts + INTERVAL '1' HOUR END AS closed_date,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE event_type END AS agency,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE 'Dept ' || event_type END AS agency_name,
  CASE WHEN event_id % 20 = 0 THEN 'Other' ELSE 'Illegal Parking' END AS complaint_type,
  {_pick("user_id", None, "", "Blocked", "Hydrant", "Double")} AS descriptor,
  {_pick("user_id", None, "Street", "Lot")} AS location_type,
  {_pick("event_id", "open", " Open ", "CLOSED", "closed ", None)} AS status,
  {_zip("event_id")} AS incident_zip,
  {_borough("event_id")} AS borough,
  CAST(user_id AS string) || ' Main St' AS incident_address,
  'Main St' AS street_name,
  'First Av' AS cross_street_1,
  CAST(NULL AS string) AS cross_street_2,
  CAST(40 + (event_id * 53 % 1103) / CAST(1000 AS double) AS double) AS latitude,
  CAST(-74.5 + (event_id * 37 % 1201) / CAST(1000 AS double) AS double) AS longitude,
  {_pick("event_id", "PHONE", "ONLINE", "MOBILE", None)} AS open_data_channel_type,
  props AS resolution_description,
  event_id AS source_row
FROM events
"""

CRASHES = f"""
SELECT
  l_orderkey AS collision_id,
  l_shipdate AS crash_date,
  CASE WHEN l_partkey % 37 = 0 THEN NULL
       ELSE CAST(l_partkey % 24 AS string) || ':' || lpad(CAST(l_suppkey % 60 AS string), 2, '0') END AS crash_time,
  {_borough("l_suppkey")} AS borough,
  {_zip("l_partkey")} AS zip_code,
  CAST(CASE l_linenumber WHEN 6 THEN NULL WHEN 7 THEN CAST(0 AS double)
       ELSE 40 + (l_partkey * 53 % 1103) / CAST(1000 AS double) END AS DECIMAL(38,9)) AS latitude,
  CAST(CASE l_linenumber WHEN 7 THEN CAST(0 AS double)
       ELSE -74.5 + (l_partkey * 37 % 1201) / CAST(1000 AS double) END AS DECIMAL(38,9)) AS longitude,
  'Main St' AS on_street_name,
  l_returnflag AS off_street_name,
  CAST(l_linestatus AS string) AS cross_street_name,
  CAST(l_linenumber - 1 AS bigint) AS number_of_persons_injured,
  CAST(l_linenumber % 2 AS bigint) AS number_of_persons_killed,
  {_pick("l_partkey", None, "", "Unspecified", " Glare ", "Glare", "Speed")} AS contributing_factor_vehicle_1,
  {_pick("l_suppkey", None, " ", "Sedan", "SEDAN", "Bus")} AS vehicle_type_code1,
  CAST(l_orderkey AS string) || '-' || CAST(l_linenumber AS string) || '-' || CAST(l_partkey AS string)
    || '-' || CAST(l_suppkey AS string) || '-' || CAST(CAST(round(l_extendedprice * 100) AS bigint) AS string) AS source_row
FROM lineitem
"""


def _degrees(thousandths: str, sign: str = "") -> str:
    whole = f"CAST(CAST(floor(({thousandths}) / 1000) AS bigint) AS string)"
    return f"'{sign}' || {whole} || '.' || lpad(CAST(({thousandths}) % 1000 AS string), 3, '0')"


def _corner(east: str, north: str) -> str:
    return f"{_degrees(f'west - {east}', '-')} || ' ' || {_degrees(f'south + {north}')}"


def _ring(*corners: tuple[str, str]) -> str:
    return " || ', ' || ".join(_corner(e, n) for e, n in (*corners, corners[0]))


_FULL = (("0", "0"), ("side", "0"), ("side", "side"), ("0", "side"))
_HOLE = (("quarter", "quarter"), ("3 * quarter", "quarter"), ("3 * quarter", "3 * quarter"), ("quarter", "3 * quarter"))
_LOWER = (("0", "0"), ("side", "0"), ("0", "side"))
_UPPER = (("side", "side"), ("side", "quarter"), ("quarter", "side"))
_DIAMOND = (("2 * quarter", "0"), ("0", "2 * quarter"), ("2 * quarter", "side"), ("side", "2 * quarter"))

# One polygon per supplier: 528 places in the area of the points, then further areas to the
# north and west, so that more suppliers mean a wider map and not a denser one. Neighbours
# overlap where the side is longer than the spacing of 0.05 degrees. Every seventh has the
# sentinel code, and two share each other code.
REGIONS = f"""
SELECT zip_code, borough, CASE k % 4
  WHEN 0 THEN 'POLYGON((' || {_ring(*_FULL)} || '))'
  WHEN 1 THEN 'POLYGON((' || {_ring(*_FULL)} || '),(' || {_ring(*_HOLE)} || '))'
  WHEN 2 THEN 'MULTIPOLYGON(((' || {_ring(*_LOWER)} || ')),((' || {_ring(*_UPPER)} || ')))'
  ELSE 'POLYGON((' || {_ring(*_DIAMOND)} || '))' END AS geom_wkt
FROM (
  SELECT k,
    CASE WHEN k % 7 = 0 THEN '99999' ELSE CAST(10000 + CAST(floor(k / 2) AS bigint) AS string) END AS zip_code,
    {_pick("k", "Manhattan", "Bronx", "Brooklyn", "Queens", "Staten Island")} AS borough,
    74500 - (place % 24) * 50 + 1300 * (CAST(floor(area / 30) AS bigint) % 80) AS west,
    40000 + CAST(floor(place / 24) AS bigint) * 50 + 1250 * (area % 30) AS south,
    32 + 8 * (k % 5) AS side,
    8 + 2 * (k % 5) AS quarter
  FROM (
    SELECT s_suppkey AS k, (s_suppkey * 197) % 528 AS place, CAST(floor(s_suppkey / 528) AS bigint) AS area
    FROM supplier
  ) AS placed
) AS sized
"""


# The same feed with what the plain one lacks: keys that are NULL, one key with a third of all rows, members with
# white space around them, and the member that missing vehicles look up.
CRASHES_ODD = (
    CRASHES.replace("l_orderkey AS collision_id", "CASE WHEN l_orderkey % 50 = 0 THEN NULL WHEN l_orderkey % 3 = 0 THEN 3 ELSE l_orderkey END AS collision_id")
    .replace('AS contributing_factor_vehicle_1', '|| CASE WHEN l_partkey % 11 = 0 THEN chr(9) ELSE chr(10) END AS contributing_factor_vehicle_1')
    .replace(
        f"{_pick('l_suppkey', None, ' ', 'Sedan', 'SEDAN', 'Bus')} AS vehicle_type_code1",
        f"CASE WHEN l_suppkey % 7 = 3 THEN chr(9) || 'Van' || chr(13) || chr(10) WHEN l_suppkey % 7 = 4 THEN 'UNKNOWN' "
        f"ELSE {_pick('l_suppkey', None, ' ', 'Sedan', 'SEDAN', 'Bus')} END AS vehicle_type_code1",
    )
)

# Vertices on each side of a dense polygon, of which every second one is drawn in.
_TEETH = 59


def _fine(units: str, sign: str = "") -> str:
    whole = f"CAST(CAST(floor(({units}) / 100000) AS bigint) AS string)"
    return f"'{sign}', {whole}, '.', lpad(CAST(({units}) % 100000 AS string), 5, '0')"


def _dense_ring() -> str:
    """A square whose sides are saws of teeth of several depths, in steps of ``s``."""
    last = _TEETH + 1
    side = [(i, (0, 3, 1, 5)[i % 4] if 5 < i < last - 5 else 0) for i in range(last)]
    corners = [*side, *[(last - d, i) for i, d in side], *[(last - i, last - d) for i, d in side], *[(d, last - i) for i, d in side]]
    points = [f"concat({_fine(f'west - {e} * s', '-')}, ' ', {_fine(f'south + {n} * s')})" for e, n in [*corners, corners[0]]]
    return f"concat_ws(', ', {', '.join(points)})"


# One polygon of 240 vertices per supplier, placed like the plain ones.
REGIONS_DENSE = f"""
SELECT zip_code, borough, concat('POLYGON((', {_dense_ring()}, '))') AS geom_wkt
FROM (
  SELECT CAST(10000 + k AS string) AS zip_code,
    {_pick("k", "Manhattan", "Bronx", "Brooklyn", "Queens", "Staten Island")} AS borough,
    7450000 - (place % 24) * 5000 + 130000 * (CAST(floor(area / 30) AS bigint) % 80) AS west,
    4000000 + CAST(floor(place / 24) AS bigint) * 5000 + 125000 * (area % 30) AS south,
    55 + 10 * (k % 5) AS s
  FROM (
    SELECT s_suppkey AS k, (s_suppkey * 197) % 528 AS place, CAST(floor(s_suppkey / 528) AS bigint) AS area
    FROM supplier
  ) AS placed
) AS sized
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_table(pin_session(spark), f"{sf_dir}/{name}.parquet")


def _feed(spark: SparkSession, sf_dir: str, sql: str, name: str) -> DataFrame:
    return spark.sql(sql.replace(f"FROM {name}", f"FROM {{{name}}}"), **{name: table(spark, sf_dir, name)})


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, REQUESTS, "events")


def crashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, CRASHES, "lineitem")


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, REGIONS, "supplier")


def crashes_odd(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, CRASHES_ODD, "lineitem")


def regions_dense(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _feed(spark, sf_dir, REGIONS_DENSE, "supplier")
