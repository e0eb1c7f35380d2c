"""The queries once more as SQL for DuckDB, written independently of the operators.

Shared steps are common table expressions; a query names the ones it ends on and gets
those they build on.
"""

from __future__ import annotations

import re

from .feeds import CRASHES, CRASHES_ODD, REGIONS, REGIONS_DENSE, REQUESTS

# The declared checks, one line per table and kind.
CHECKS = """
raw_requests unique unique_key
raw_requests not_null unique_key
raw_crashes not_null collision_id
stg_requests unique complaint_id
stg_requests not_null complaint_id created_date
stg_crashes unique collision_id
stg_crashes not_null collision_id
date unique date_key full_date
date not_null date_key full_date
geography unique geo_key
geography not_null geo_key
agency unique agency_key
agency not_null agency_key
channel unique channel_key
channel not_null channel_key
complaint unique complaint_key
complaint not_null complaint_key
status unique status_key status
status not_null status_key status
factor unique factor_key factor_desc
factor not_null factor_key factor_desc
crash_time unique crash_time_key hour
crash_time not_null crash_time_key hour
vehicle unique vehicle_type_key vehicle_type_desc
vehicle not_null vehicle_type_key vehicle_type_desc
fact_requests unique fact_illegal_parking_key
fact_requests not_null fact_illegal_parking_key complaint_id date_key complaint_key complaint_count
fact_requests relationships date_key=date geo_key=geography complaint_key=complaint agency_key=agency channel_key=channel status_key=status
fact_requests accepted_values complaint_count=1
fact_crashes unique fact_mvc_key collision_id date_key geo_key crash_time_key factor_key vehicle_type_key
fact_crashes not_null fact_mvc_key collision_id date_key geo_key crash_time_key factor_key vehicle_type_key
fact_crashes relationships date_key=date geo_key=geography crash_time_key=crash_time factor_key=factor vehicle_type_key=vehicle
"""

SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"


def _token(c: str) -> str:
    return f"upper(trim(CAST({c} AS varchar), {SPACE}))"


def _zip(c: str) -> str:
    return (
        f"CASE WHEN {_token(c)} IN ('N/A', 'NA') THEN NULL WHEN {_token(c)} = 'ANONYMOUS' THEN 'Anonymous' "
        f"WHEN length({c}) IN (5, 9) OR regexp_full_match({c}, '[0-9]{{5}}-[0-9]{{4}}') THEN {c} END"
    )


def _borough(c: str, default: str = "NULL") -> str:
    return (
        f"CASE WHEN {_token(c)} IN ('MANHATTAN', 'NEW YORK COUNTY') THEN 'Manhattan' "
        f"WHEN {_token(c)} IN ('BRONX', 'THE BRONX') THEN 'Bronx' "
        f"WHEN {_token(c)} IN ('BROOKLYN', 'KINGS COUNTY') THEN 'Brooklyn' "
        f"WHEN {_token(c)} IN ('QUEENS', 'QUEEN', 'QUEENS COUNTY') THEN 'Queens' "
        f"WHEN {_token(c)} IN ('STATEN ISLAND', 'RICHMOND COUNTY') THEN 'Staten Island' ELSE {default} END"
    )


def _key(*fields: str) -> str:
    parts = [f"coalesce(CAST({f} AS varchar), '_dbt_utils_surrogate_key_null_')" for f in fields]
    return f"md5({" || '-' || ".join(parts)})"


def _nonzero(c: str) -> str:
    return f"CASE WHEN {c} <> 0 THEN CAST({c} AS DECIMAL(38,9)) END"


def _holiday(d: str) -> str:
    """Counted by occurrence of the weekday within the month, not by day ranges."""
    m, n, w = f"month({d})", f"day({d})", f"dayofweek({d})"
    nth = f"((day({d}) - 1) // 7 + 1)"
    last = f"month({d} + INTERVAL 7 DAY) <> month({d})"
    return (
        f"(strftime({d}, '%m-%d') IN ('01-01', '06-19', '07-04', '11-11', '12-25') "
        f"OR ({m} IN (1, 2) AND {w} = 1 AND {nth} = 3) OR ({m} = 5 AND {w} = 1 AND {last}) "
        f"OR ({m} = 9 AND {w} = 1 AND {nth} = 1) OR ({m} = 10 AND {w} = 1 AND {nth} = 2) "
        f"OR ({m} = 11 AND {w} = 4 AND {nth} = 4))"
    )


def _calendar(d: str) -> str:
    return (
        f"CAST(year({d}) AS bigint) AS year, CAST(month({d}) AS bigint) AS month, monthname({d}) AS month_name, "
        f"CAST(day({d}) AS bigint) AS day_of_month, CAST(dayofweek({d}) + 1 AS bigint) AS day_of_week, "
        f"dayname({d}) AS day_name, dayofweek({d}) IN (0, 6) AS is_weekend, {_holiday(d)} AS is_holiday"
    )


def _stamp(date: str, clock: str) -> str:
    return f"strptime(strftime({date}, '%Y-%m-%d') || ' ' || {clock}, '%Y-%m-%d %H:%M')"


def _turn(p: str = "p", e: str = "e") -> str:
    return f"(({e}.x2 - {e}.x1) * ({p}.y - {e}.y1) - ({p}.x - {e}.x1) * ({e}.y2 - {e}.y1))"


_CROSSES = (
    f"(e.y1 > p.y) <> (e.y2 > p.y) AND (CASE WHEN e.y2 > e.y1 THEN {_turn()} > 0 ELSE {_turn()} < 0 END)"
)
_ON_EDGE = (
    f"{_turn()} = 0 AND p.x BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
    "AND p.y BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2)"
)

CTES: dict[str, str] = {
    "req_raw": REQUESTS,
    "cra_raw": CRASHES,
    "region": f"SELECT row_number() OVER () AS rid, * FROM ({REGIONS}) AS r",
    "req": f"""
        SELECT CAST(cross_street_1 AS varchar) AS cross_street_1, cross_street_2, resolution_description, source_row,
          CAST(unique_key AS varchar) AS complaint_id, created_date, closed_date, agency, agency_name, complaint_type,
          descriptor, location_type, {_token('status')} AS status, {_zip('incident_zip')} AS incident_zip,
          {_borough('borough', "'UNKNOWN or CITYWIDE'")} AS borough, incident_address, street_name,
          CAST(latitude AS DECIMAL(38,9)) AS latitude, CAST(longitude AS DECIMAL(38,9)) AS longitude,
          open_data_channel_type AS method_of_submission
        FROM req_raw
        WHERE unique_key IS NOT NULL AND created_date >= TIMESTAMP '2020-01-01' AND complaint_type = 'Illegal Parking'
        QUALIFY row_number() OVER (PARTITION BY unique_key ORDER BY created_date DESC, source_row) = 1""",
    "cra_clean": f"""
        SELECT * REPLACE (CAST(collision_id AS varchar) AS collision_id, {_stamp('crash_date', 'crash_time')} AS crash_date,
          {_zip('zip_code')} AS zip_code, {_borough('borough')} AS borough,
          {_nonzero('latitude')} AS latitude, {_nonzero('longitude')} AS longitude)
        FROM (SELECT * FROM cra_raw QUALIFY row_number() OVER (
          PARTITION BY collision_id
          ORDER BY crash_date DESC, {_stamp('crash_date', 'crash_time')} DESC NULLS LAST, source_row) = 1) AS latest""",
    # Geometry: every distinct point against every edge.
    "ring": r"SELECT rid, unnest(regexp_extract_all(geom_wkt, '\(([^()]+)\)', 1)) AS ring FROM region",
    "corner": "SELECT rid, string_split(ring, ',') AS v FROM ring",
    "edge": """
        SELECT rid, CAST(split_part(trim(v[i]), ' ', 1) AS double) AS x1, CAST(split_part(trim(v[i]), ' ', 2) AS double) AS y1,
          CAST(split_part(trim(v[i + 1]), ' ', 1) AS double) AS x2, CAST(split_part(trim(v[i + 1]), ' ', 2) AS double) AS y2
        FROM (SELECT rid, v, unnest(range(1, len(v))) AS i FROM corner) AS s""",
    "spot_cra": f"""
        SELECT source_row, CAST(longitude AS double) AS x, CAST(latitude AS double) AS y FROM cra_raw
        WHERE longitude <> 0 AND latitude <> 0""",
    "spot_req": """
        SELECT source_row, CAST(CAST(longitude AS DECIMAL(38,9)) AS double) AS x,
          CAST(CAST(latitude AS DECIMAL(38,9)) AS double) AS y FROM req_raw""",
    "spot": "SELECT DISTINCT x, y FROM (SELECT x, y FROM spot_cra UNION ALL SELECT x, y FROM spot_req) AS u",
    "within": f"""
        SELECT p.x, p.y, e.rid FROM spot AS p, edge AS e GROUP BY p.x, p.y, e.rid
        HAVING count(*) FILTER ({_CROSSES}) % 2 = 1 AND NOT bool_or({_ON_EDGE})""",
    "outside": "SELECT * FROM spot ANTI JOIN within USING (x, y)",
    "leg": """
        SELECT p.x, p.y, e.rid, (e.x1 - p.x) * cos(radians(p.y)) AS ax, e.y1 - p.y AS ay,
          (e.x2 - e.x1) * cos(radians(p.y)) AS dx, e.y2 - e.y1 AS dy FROM outside AS p, edge AS e""",
    "foot": "SELECT x, y, rid, ax, ay, dx, dy, greatest(0, least(1, -(ax * dx + ay * dy) / (dx * dx + dy * dy))) AS t FROM leg",
    "gap": """
        SELECT x, y, rid, round(sqrt(min((ax + t * dx) * (ax + t * dx) + (ay + t * dy) * (ay + t * dy))), 9) AS far
        FROM foot GROUP BY x, y, rid""",
    "closest": """
        SELECT x, y, zip_code AS derived_zip, borough AS derived_borough FROM gap JOIN region USING (rid)
        QUALIFY row_number() OVER (PARTITION BY x, y ORDER BY far, zip_code, borough) = 1""",
    "holder": "SELECT x, y, zip_code AS derived_zip, borough AS derived_borough FROM within JOIN region USING (rid)",
    "place": "SELECT * FROM holder UNION ALL SELECT * FROM closest",
    "cra": """
        SELECT c.* EXCLUDE (zip_code, borough), nullif(coalesce(c.zip_code, p.derived_zip), '99999') AS zip_code,
          coalesce(c.borough, p.derived_borough, 'UNKNOWN or CITYWIDE') AS borough
        FROM cra_clean AS c LEFT JOIN place AS p ON (c.zip_code IS NULL OR c.borough IS NULL)
          AND c.collision_id IS NOT NULL AND CAST(c.longitude AS double) = p.x AND CAST(c.latitude AS double) = p.y""",
    # Dimensions.
    "day": """
        SELECT CAST(created_date AS date) AS full_date FROM req UNION
        SELECT CAST(crash_date AS date) FROM cra_clean WHERE crash_date IS NOT NULL""",
    "d_date": f"SELECT {_key('full_date')} AS date_key, full_date, {_calendar('full_date')} FROM day",
    "bucket": """
        SELECT replace(borough, 'UNKNOWN or CITYWIDE', 'UNKNOWN') AS borough, coalesce(incident_zip, 'UNKNOWN') AS zip_code FROM req
        UNION SELECT replace(borough, 'UNKNOWN or CITYWIDE', 'UNKNOWN'), coalesce(zip_code, 'UNKNOWN') FROM cra""",
    "d_geo": f"SELECT {_key('borough', 'zip_code')} AS geo_key, borough, zip_code FROM bucket",
    "d_geo_raw": f"""
        SELECT DISTINCT {_key("coalesce(borough, 'UNKNOWN')", "coalesce(zip_code, 'UNKNOWN')")} AS geo_key,
          coalesce(borough, 'UNKNOWN') AS borough, coalesce(zip_code, 'UNKNOWN') AS zip_code FROM cra_clean""",
    "d_agency": f"SELECT DISTINCT {_key('agency', 'agency_name')} AS agency_key, agency, agency_name FROM req",
    "d_channel": f"SELECT DISTINCT {_key('method_of_submission')} AS channel_key, method_of_submission FROM req",
    "d_complaint": f"""
        SELECT DISTINCT {_key('complaint_type', 'descriptor', 'location_type')} AS complaint_key, complaint_type,
          descriptor, location_type FROM req""",
    "d_status": f"SELECT DISTINCT {_key('status')} AS status_key, status FROM req WHERE status IS NOT NULL",
    "factor": f"""
        SELECT DISTINCT trim(contributing_factor_vehicle_1, {SPACE}) AS factor_desc FROM cra_clean
        WHERE trim(contributing_factor_vehicle_1, {SPACE}) <> ''""",
    "d_factor": f"SELECT {_key('factor_desc')} AS factor_key, factor_desc FROM factor",
    "vehicle": f"""
        SELECT DISTINCT trim(vehicle_type_code1, {SPACE}) AS vehicle_type_desc FROM cra_clean
        WHERE trim(vehicle_type_code1, {SPACE}) <> ''""",
    "d_vehicle": f"SELECT {_key('vehicle_type_desc')} AS vehicle_type_key, vehicle_type_desc FROM vehicle",
    "hours": "SELECT DISTINCT CAST(hour(crash_date) AS bigint) AS hour FROM cra_clean WHERE crash_date IS NOT NULL",
    "d_time": f"""
        SELECT {_key('hour')} AS crash_time_key, hour,
          ['Night', 'Morning', 'Afternoon', 'Evening'][hour // 6 + 1] AS time_band FROM hours""",
    # Facts.
    "f_req": f"""
        SELECT {_key('c.complaint_id')} AS fact_illegal_parking_key, c.complaint_id, d.date_key, g.geo_key,
          p.complaint_key, a.agency_key, h.channel_key, s.status_key, CAST(1 AS bigint) AS complaint_count
        FROM req AS c
        LEFT JOIN d_date AS d ON CAST(c.created_date AS date) = d.full_date
        LEFT JOIN d_geo AS g ON coalesce(c.incident_zip, 'UNKNOWN') = g.zip_code
          AND replace(c.borough, 'UNKNOWN or CITYWIDE', 'UNKNOWN') = g.borough
        LEFT JOIN d_complaint AS p ON c.complaint_type = p.complaint_type
          AND coalesce(c.descriptor, '') = coalesce(p.descriptor, '')
          AND coalesce(c.location_type, '') = coalesce(p.location_type, '')
        LEFT JOIN d_agency AS a ON c.agency = a.agency AND coalesce(c.agency_name, '') = coalesce(a.agency_name, '')
        LEFT JOIN d_channel AS h ON c.method_of_submission = h.method_of_submission
        LEFT JOIN d_status AS s ON c.status = s.status""",
    "f_cra": f"""
        SELECT {_key('c.collision_id')} AS fact_mvc_key, c.collision_id, d.date_key, g.geo_key, t.crash_time_key,
          f.factor_key, v.vehicle_type_key, CAST(1 AS bigint) AS crash_count, c.number_of_persons_injured,
          c.number_of_persons_killed
        FROM cra AS c
        LEFT JOIN d_date AS d ON CAST(c.crash_date AS date) = d.full_date
        LEFT JOIN d_geo AS g ON coalesce(c.zip_code, 'UNKNOWN') = g.zip_code
          AND replace(c.borough, 'UNKNOWN or CITYWIDE', 'UNKNOWN') = g.borough
        LEFT JOIN d_time AS t ON hour(c.crash_date) = t.hour
        LEFT JOIN d_factor AS f ON coalesce(trim(c.contributing_factor_vehicle_1, {SPACE}), 'Unspecified') = f.factor_desc
        LEFT JOIN d_vehicle AS v ON coalesce(trim(c.vehicle_type_code1, {SPACE}), 'UNKNOWN') = v.vehicle_type_desc""",
}


def _mentions(sql: str) -> list[str]:
    return [name for name in CTES if re.search(rf"\b(FROM|JOIN|,)\s+{name}\b", sql)]


def with_steps(final: str, instead: dict[str, str] | None = None) -> str:
    """``final`` preceded by the common table expressions it needs, in dependency order, some of them ``instead`` of the usual."""
    needed: dict[str, str] = {}
    steps_of = CTES | (instead or {})

    def add(sql: str) -> None:
        for name in _mentions(sql):
            if name not in needed:
                add(steps_of[name])
                needed[name] = steps_of[name]

    add(final)
    steps = ", ".join(f"{name} AS MATERIALIZED ({sql})" for name, sql in needed.items())
    return f"WITH {steps} {final}" if steps else final


_TABLES = {
    "raw_requests": "req_raw", "raw_crashes": "cra_raw", "stg_requests": "req", "stg_crashes": "cra", "date": "d_date",
    "geography": "d_geo", "agency": "d_agency", "channel": "d_channel", "complaint": "d_complaint",
    "status": "d_status", "factor": "d_factor", "crash_time": "d_time", "vehicle": "d_vehicle",
    "fact_requests": "f_req", "fact_crashes": "f_cra",
}


def _check(table: str, column: str, kind: str, parent: str | None, accepted: tuple) -> str:
    t = _TABLES[table]
    failures = {
        "not_null": f"SELECT count(*) FROM {t} WHERE {column} IS NULL",
        "unique": f"SELECT count(*) FROM (SELECT {column} FROM {t} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) AS x",
        "relationships": f"SELECT count(*) FROM {t} WHERE {column} IS NOT NULL AND {column} NOT IN "
        f"(SELECT {column} FROM {_TABLES.get(parent, t)} WHERE {column} IS NOT NULL)",
        "accepted_values": f"SELECT count(DISTINCT {column}) FROM {t} WHERE {column} NOT IN ({', '.join(map(str, accepted))})",
    }[kind]
    return (
        f"SELECT '{table}' AS table_name, '{column}' AS column_name, '{kind}' AS check_name, "
        f"CAST(({failures}) AS bigint) AS failures"
    )


_PLAIN: dict[str, str] = {
    "seed_scan_typed": "SELECT zip_code, borough, geom_wkt FROM region",
    "sink_roundtrip": "SELECT * FROM orders",
    "star_except_clean": f"""
        SELECT * EXCLUDE (unique_key, status, incident_zip, borough), CAST(unique_key AS varchar) AS complaint_id,
          {_token('status')} AS status, {_zip('incident_zip')} AS incident_zip,
          {_borough('borough', "'UNKNOWN or CITYWIDE'")} AS borough FROM req_raw""",
    "rename_cast": """
        SELECT source_row, CAST(unique_key AS varchar) AS complaint_id, open_data_channel_type AS method_of_submission
        FROM req_raw""",
    "cast_timestamp_date": "SELECT o_orderkey, CAST(o_orderdate AS timestamp) AS ordered_at, CAST(o_orderdate AS date) AS ordered_on FROM orders",
    "cast_decimal": """
        SELECT l_orderkey, l_linenumber, CAST(l_extendedprice AS DECIMAL(38,9)) AS price,
          CAST(l_discount AS DECIMAL(38,9)) AS discount FROM lineitem""",
    "clean_zip": f"SELECT source_row, {_zip('incident_zip')} AS incident_zip FROM req_raw",
    "clean_region": f"""
        SELECT source_row, {_borough('borough', "'UNKNOWN or CITYWIDE'")} AS borough,
          {_borough('borough')} AS borough_or_null FROM req_raw""",
    "null_zero": f"SELECT source_row, {_nonzero('latitude')} AS latitude, {_nonzero('longitude')} AS longitude FROM cra_raw",
    "compose_timestamp": f"SELECT source_row, {_stamp('crash_date', 'crash_time')} AS crash_date FROM cra_raw",
    "surrogate_key": f"SELECT source_row, {_key('agency', 'descriptor', 'CAST(closed_date AS date)')} AS key FROM req_raw",
    "filter_scope": """
        SELECT o_orderkey, o_custkey, o_orderdate, o_orderstatus FROM orders
        WHERE o_custkey IS NOT NULL AND CAST(o_orderdate AS date) >= DATE '1997-01-01' AND o_orderstatus = 'F'""",
    "enrich_gate": f"""
        SELECT source_row FROM cra_raw WHERE ({_zip('zip_code')} IS NULL OR {_borough('borough')} IS NULL)
          AND latitude <> 0 AND longitude <> 0""",
    "dedup_keep_latest": """
        SELECT * FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1""",
    "union_distinct_dates": """
        SELECT CAST(o_orderdate AS date) AS full_date FROM orders UNION SELECT CAST(l_shipdate AS date) FROM lineitem""",
    "stg_requests": "SELECT * FROM req",
    "stg_crashes": "SELECT * FROM cra",
    "dim_date": "SELECT * FROM d_date",
    "dim_region": "SELECT * FROM d_geo",
    "dim_agency": "SELECT * FROM d_agency",
    "dim_channel": "SELECT * FROM d_channel",
    "dim_complaint": "SELECT * FROM d_complaint",
    "dim_status": "SELECT * FROM d_status",
    "dim_factor": "SELECT * FROM d_factor",
    "dim_vehicle": "SELECT * FROM d_vehicle",
    "dim_time_band": "SELECT * FROM d_time",
    "lookup_date": f"""
        SELECT o_orderkey, CASE WHEN CAST(o_orderdate AS date) IN (SELECT CAST(l_shipdate AS date) FROM lineitem)
          THEN {_key('CAST(o_orderdate AS date)')} END AS date_key FROM orders""",
    "lookup_region_unknown": """
        SELECT c.complaint_id, g.geo_key FROM req AS c LEFT JOIN d_geo_raw AS g
          ON coalesce(c.incident_zip, 'UNKNOWN') = g.zip_code
          AND CASE c.borough WHEN 'UNKNOWN or CITYWIDE' THEN 'UNKNOWN' ELSE c.borough END = g.borough""",
    "lookup_null_as_blank": """
        SELECT c.complaint_id, p.complaint_key FROM req AS c LEFT JOIN d_complaint AS p
          ON c.complaint_type = p.complaint_type AND coalesce(c.descriptor, '') = coalesce(p.descriptor, '')
          AND coalesce(c.location_type, '') = coalesce(p.location_type, '')""",
    "lookup_strict_null": """
        SELECT c.complaint_id, h.channel_key, s.status_key FROM req AS c
        LEFT JOIN d_channel AS h ON c.method_of_submission = h.method_of_submission
        LEFT JOIN d_status AS s ON c.status = s.status""",
    "lookup_hour": f"""
        SELECT collision_id, CASE WHEN crash_date IS NOT NULL THEN {_key('hour(crash_date)')} END AS crash_time_key
        FROM cra_clean""",
    "lookup_trim_default": f"""
        SELECT c.collision_id, f.factor_key, v.vehicle_type_key FROM cra_clean AS c
        LEFT JOIN d_factor AS f ON coalesce(trim(c.contributing_factor_vehicle_1, {SPACE}), 'Unspecified') = f.factor_desc
        LEFT JOIN d_vehicle AS v ON coalesce(trim(c.vehicle_type_code1, {SPACE}), 'UNKNOWN') = v.vehicle_type_desc""",
    "fact_requests": "SELECT * FROM f_req",
    "fact_crashes": "SELECT * FROM f_cra",
    "wkt_edges": "SELECT zip_code, borough, x1, y1, x2, y2 FROM edge JOIN region USING (rid)",
    "cross_regions": """
        SELECT c.cx, c.cy, r.derived_zip, r.derived_borough, r.xmin, r.xmax, r.ymin, r.ymax
        FROM (SELECT DISTINCT CAST(floor(x * 64) AS bigint) AS cx, CAST(floor(y * 64) AS bigint) AS cy FROM spot_cra) AS c,
          (SELECT zip_code AS derived_zip, borough AS derived_borough, min(x1) AS xmin, max(x1) AS xmax, min(y1) AS ymin,
             max(y1) AS ymax FROM edge JOIN region USING (rid) GROUP BY rid, zip_code, borough) AS r
        WHERE r.xmin <= (c.cx + 1) / 64.0 AND r.xmax >= c.cx / 64.0 AND r.ymin <= (c.cy + 1) / 64.0 AND r.ymax >= c.cy / 64.0""",
    "point_in_region": "SELECT source_row, derived_zip, derived_borough FROM spot_cra JOIN holder USING (x, y)",
    "anti_unmatched": "SELECT source_row FROM spot_cra JOIN outside USING (x, y)",
    "nearest_region": "SELECT source_row, derived_zip, derived_borough FROM spot_cra JOIN closest USING (x, y)",
    "region_lookup_union": "SELECT source_row, derived_zip, derived_borough FROM spot_cra JOIN place USING (x, y)",
    "region_enrich": f"""
        SELECT c.source_row, c.longitude, c.latitude, nullif(coalesce(c.zip_code, p.derived_zip), '99999') AS zip_code,
          coalesce(c.borough, p.derived_borough, 'UNKNOWN or CITYWIDE') AS borough
        FROM (SELECT source_row, {_zip('zip_code')} AS zip_code, {_borough('borough')} AS borough,
                {_nonzero('longitude')} AS longitude, {_nonzero('latitude')} AS latitude FROM cra_raw) AS c
        LEFT JOIN place AS p ON (c.zip_code IS NULL OR c.borough IS NULL)
          AND CAST(c.longitude AS double) = p.x AND CAST(c.latitude AS double) = p.y""",
    "star_except_enrich": f"""
        SELECT r.* EXCLUDE (incident_zip, borough, latitude, longitude), CAST(r.latitude AS DECIMAL(38,9)) AS latitude,
          CAST(r.longitude AS DECIMAL(38,9)) AS longitude,
          nullif(coalesce({_zip('r.incident_zip')}, p.derived_zip), '99999') AS zip_code,
          coalesce({_borough('r.borough')}, p.derived_borough, 'UNKNOWN or CITYWIDE') AS borough
        FROM req_raw AS r
        LEFT JOIN spot_req AS s ON r.source_row = s.source_row AND ({_zip('r.incident_zip')} IS NULL OR {_borough('r.borough')} IS NULL)
        LEFT JOIN (SELECT * FROM place QUALIFY row_number() OVER (PARTITION BY x, y ORDER BY derived_zip, derived_borough) = 1) AS p
          ON s.x = p.x AND s.y = p.y""",
    "dq_unique": "SELECT unique_key, count(*) AS n_rows FROM req_raw WHERE unique_key IS NOT NULL GROUP BY 1 HAVING count(*) > 1",
    "dq_not_null": "SELECT source_row, created_date FROM req_raw WHERE created_date IS NULL",
    "dq_relationships": """
        SELECT o_orderkey, count(*) AS n_rows FROM orders WHERE o_orderkey IS NOT NULL
          AND o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY 1""",
    "dq_accepted_values": "SELECT l_linenumber, count(*) AS n_rows FROM lineitem WHERE l_linenumber NOT IN (1, 2, 3) GROUP BY 1",
    "dq_report": " UNION ALL ".join(
        _check(table, column, kind, other if kind == "relationships" else None, (int(other),) if kind == "accepted_values" else ())
        for table, kind, *columns in map(str.split, CHECKS.strip().splitlines())
        for column, _, other in [c.partition("=") for c in columns]
    ),
    "latest_order_holidays": f"""
        SELECT {_holiday('day')} AS is_holiday, count(*) AS n_orders, count(DISTINCT day) AS n_days
        FROM (SELECT CAST(o_orderdate AS date) AS day FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'
          QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) = 1) AS latest
        GROUP BY 1""",
}

_PLAIN["region_enrich_split"] = _PLAIN["region_enrich"]
_PLAIN["dedup_keep_latest_wide"] = _PLAIN["dedup_keep_latest"]

ORACLE: dict[str, str] = {name: with_steps(sql) for name, sql in _PLAIN.items()}

_ODD = {"cra_raw": CRASHES_ODD}
# The requests' points are left out, so that every edge meets a few thousand points only.
_DENSE = {"region": CTES["region"].replace(REGIONS, REGIONS_DENSE), "spot": "SELECT DISTINCT x, y FROM spot_cra"}
ORACLE |= {f"{name}_odd": with_steps(_PLAIN[name], _ODD) for name in ("stg_crashes", "lookup_trim_default")}
ORACLE |= {f"{name}_dense": with_steps(_PLAIN[name], _DENSE) for name in ("point_in_region", "nearest_region")}
