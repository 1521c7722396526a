"""DuckDB SQL for each query with a determined result.

The SQL states every rule on its own and in the plainest form: the weather of a
flight by pairing observations, the airport lookup by its OR condition, splits by
one global row number, the tree level by level over raw rows.
"""

from __future__ import annotations

from aerolag.schemas import ATTRIBUTES, LABEL

BASE = """
flights AS MATERIALIZED (
  SELECT DATE '2024-01-01' + CAST((year(o_orderdate) * 372 + month(o_orderdate) * 31
           + day(o_orderdate)) % 30 AS INTEGER) AS FL_DATE,
    p_brand AS OP_CARRIER,
    CAST(l_orderkey % 7000 AS INTEGER) AS OP_CARRIER_FL_NUM,
    concat('A', l_suppkey * 13 % (SELECT max(user_id) + 1 FROM events)) AS ORIGIN,
    concat('A', o_custkey % (SELECT max(user_id) + 1 FROM events)) AS DEST,
    CAST((l_orderkey * 37 + l_linenumber * 101) % 24 * 100 + l_partkey % 60 AS INTEGER) AS CRS_DEP_TIME,
    CASE WHEN l_orderkey % 50 <> 0 THEN (l_quantity - 25) * 3 END AS DEP_DELAY,
    CAST((l_orderkey * 53 + l_linenumber * 11) % 24 * 100 + l_suppkey % 60 AS INTEGER) AS CRS_ARR_TIME,
    CAST((l_orderkey * 53 + l_linenumber * 11) % 24 * 100 + l_partkey % 60 AS INTEGER) AS ARR_TIME,
    CASE WHEN l_orderkey % 50 <> 0 THEN (l_quantity - 25) * 3 + l_partkey % 21 - 10 END AS ARR_DELAY,
    CAST(l_returnflag = 'R' AS INTEGER) AS CANCELLED,
    CAST(l_linestatus = 'F' AS INTEGER) AS DIVERTED,
    CAST(l_partkey % 120 + 60 AS DOUBLE) AS ACTUAL_ELAPSED_TIME,
    CAST(l_partkey % 120 + 40 AS DOUBLE) AS AIR_TIME,
    CAST(l_linenumber + 3 AS DOUBLE) AS TAXI_IN,
    CAST(l_suppkey % 17 + 5 AS DOUBLE) AS TAXI_OUT,
    l_extendedprice AS DISTANCE,
    round(l_tax * 100) AS WEATHER_DELAY,
    round(l_discount * 100) AS NAS_DELAY,
    CAST(l_linenumber AS DOUBLE) AS SECURITY_DELAY,
    CASE WHEN l_quantity > 25 THEN l_quantity - 25 END AS LATE_AIRCRAFT_DELAY,
    CASE WHEN l_quantity > 40 THEN l_quantity END AS CARRIER_DELAY
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey),
flights_raw AS (
  SELECT ORIGIN, DEST,
    CASE WHEN CRS_DEP_TIME % 97 = 0 THEN 'None' WHEN CRS_DEP_TIME % 89 = 0 THEN ''
         ELSE OP_CARRIER END AS OP_CARRIER,
    CASE WHEN DEP_DELAY IS NULL THEN 'NULL' WHEN DEP_DELAY = 0 THEN NULL
         ELSE CAST(CAST(DEP_DELAY * 3 AS DECIMAL(9,1)) AS VARCHAR) END AS DEP_DELAY,
    CASE WHEN CAST(ARR_DELAY AS INTEGER) % 7 = 0 THEN 'NaN'
         ELSE CAST(CAST(ARR_DELAY AS DECIMAL(9,1)) AS VARCHAR) END AS ARR_DELAY,
    CAST(CRS_DEP_TIME AS VARCHAR) AS CRS_DEP_TIME,
    CAST(CAST(DISTANCE AS DECIMAL(12,2)) AS VARCHAR) AS DISTANCE
  FROM flights),
airports_stations AS (
  SELECT DISTINCT concat('A', user_id) AS ORIGIN, concat('S', user_id) AS STATION
  FROM events WHERE user_id % 20 <> 0),
stations AS (
  SELECT DISTINCT concat('S', user_id) AS STATION, CAST(18 + user_id * 7 % 37 AS DOUBLE) AS LAT,
    CAST(-(60 + user_id * 11 % 75) AS DOUBLE) AS LON
  FROM events),
weather AS (
  SELECT concat('S', user_id) AS STATION_ID, CAST(ts AS DATE) AS OBS_DATE,
    CASE event_type WHEN 'click' THEN 'PRCP' WHEN 'view' THEN 'SNOW' WHEN 'purchase' THEN 'WDF2'
         WHEN 'signup' THEN 'TMAX' ELSE 'WT18' END AS ELEMENT,
    CAST(floor(value / 20) AS DOUBLE) AS DATA_VALUE
  FROM events),
carriers AS (
  SELECT DISTINCT p_brand AS OP_CARRIER,
    CASE WHEN length(p_brand) = 7 THEN 'ULCC' WHEN p_brand < 'Brand#14' THEN 'LCC'
         WHEN p_brand < 'Brand#18' THEN '2' WHEN p_brand < 'Brand#22' THEN '3'
         ELSE 'Normal' END AS CATEGORY
  FROM part WHERE p_brand <> 'Brand#9'),
airports AS (
  SELECT DISTINCT user_id AS ident,
    CASE WHEN user_id % 3 <> 2 THEN concat('A', user_id) END AS local_code,
    CASE WHEN user_id % 3 = 1 THEN concat('X', user_id) ELSE concat('A', user_id) END AS iata_code,
    concat('name ', user_id) AS name, concat('US-', user_id % 7) AS local_region,
    concat('city ', user_id % 13) AS municipality
  FROM events WHERE user_id % 11 <> 0),
geo AS (
  SELECT b.ORIGIN AS AIRPORT_CODE, b.STATION, s.LAT AS LATITUDE, -s.LON AS LONGITUDE
  FROM airports_stations b LEFT JOIN stations s ON b.STATION = s.STATION),
areas AS MATERIALIZED (
  SELECT AIRPORT_CODE, STATION, coalesce(AREA_NAME, STATION) AS AREA,
    CASE AREA_NAME WHEN 'NE' THEN 1 WHEN 'MNE' THEN 2 WHEN 'MNW' THEN 3 WHEN 'NW' THEN 4
      WHEN 'SE' THEN 5 WHEN 'MSE' THEN 6 WHEN 'MSW' THEN 7 WHEN 'SW' THEN 8 END AS AREA_CODE
  FROM (SELECT *, CASE
      WHEN LONGITUDE < 80 THEN CASE WHEN LATITUDE < 37 THEN 'SE' WHEN LATITUDE <> 50 THEN 'NE' END
      WHEN LATITUDE >= 50 THEN CASE WHEN LATITUDE > 50 AND LONGITUDE > 125 THEN 'NW' END
      WHEN LONGITUDE < 95 THEN CASE WHEN LATITUDE < 37 THEN 'MSE' ELSE 'MNE' END
      WHEN LONGITUDE < 110 THEN CASE WHEN LATITUDE < 37 THEN 'MSW' ELSE 'MNW' END
      WHEN LONGITUDE < 125 THEN CASE WHEN LATITUDE < 37 THEN 'SW' ELSE 'NW' END
      WHEN LONGITUDE > 125 AND LATITUDE < 37 THEN 'SW' END AS AREA_NAME FROM geo))"""


def delay_code(column: str) -> str:
    return f"""CASE WHEN {column} IS NULL THEN 5 WHEN {column} > 60 THEN 9 WHEN {column} > 30 THEN 8
      WHEN {column} > 15 THEN 7 WHEN {column} > 5 THEN 6 WHEN {column} >= -5 THEN 5
      WHEN {column} >= -15 THEN 4 WHEN {column} >= -30 THEN 3 WHEN {column} >= -60 THEN 2
      ELSE 1 END"""


def delay_label(column: str) -> str:
    return f"""CASE {delay_code(column)} WHEN 1 THEN '60+min early' WHEN 2 THEN '30~60min early'
      WHEN 3 THEN '15~30min early' WHEN 4 THEN '5~15min early' WHEN 5 THEN 'On Time'
      WHEN 6 THEN '5~15min late' WHEN 7 THEN '15~30min late' WHEN 8 THEN '30~60min late'
      ELSE '60+min late' END"""


def schedule_code(column: str) -> str:
    return f"""CASE WHEN {column} BETWEEN 600 AND 799 THEN 2
      WHEN {column} BETWEEN 800 AND 1799 THEN 3 ELSE 1 END"""


def schedule_label(column: str) -> str:
    return f"""CASE {schedule_code(column)} WHEN 1 THEN 'Busy' WHEN 2 THEN 'Least Busy'
      ELSE 'Most Busy' END"""


KEYS = """FL_DATE, OP_CARRIER, OP_CARRIER_FL_NUM, CRS_DEP_TIME, DEP_DELAY, CRS_ARR_TIME,
    ARR_DELAY, DIVERTED, CANCELLED, ORIG_STATION, ORIG_AREA, ORIG_AREA_CODE, DEST_STATION,
    DEST_AREA, DEST_AREA_CODE"""


def paired(status: bool) -> str:
    """Flights joined with every pair of observations, then grouped."""
    keys = KEYS if status else KEYS.replace("DIVERTED, CANCELLED, ", "")

    def label(column: str) -> str:
        return f"""CASE WHEN list_contains({column}, 'SNWD') OR list_contains({column}, 'SNOW')
        THEN 'Snow' WHEN list_contains({column}, 'PRCP') THEN 'Rain'
        WHEN list_contains({column}, 'WDF2') OR list_contains({column}, 'WDF5') THEN 'Wind'
        ELSE 'Sunny' END"""

    def element(side: str) -> str:
        return f"CASE WHEN {side}.counts THEN {side}.ELEMENT ELSE 'SUNNY' END"

    return f"""
observed AS MATERIALIZED (
  SELECT *, regexp_matches(ELEMENT, '(PRCP|SNOW|SNWD|^WD+|^WS+)') AS counts,
    DATA_VALUE <> 0 AND counts AS qualifies FROM weather),
located AS MATERIALIZED (
  SELECT f.*, o.STATION AS ORIG_STATION, o.AREA AS ORIG_AREA, o.AREA_CODE AS ORIG_AREA_CODE,
    d.STATION AS DEST_STATION, d.AREA AS DEST_AREA, d.AREA_CODE AS DEST_AREA_CODE
  FROM flights f JOIN areas o ON f.ORIGIN = o.AIRPORT_CODE JOIN areas d ON f.DEST = d.AIRPORT_CODE),
listed AS MATERIALIZED (
  SELECT {keys},
    list_sort(list_distinct(list({element('ow')}))) AS ORIG_WEATHERS,
    list_sort(list_distinct(list({element('dw')}))) AS DEST_WEATHERS,
    histogram({element('ow')}) AS ORIG_TIMES, histogram({element('dw')}) AS DEST_TIMES
  FROM located f
  JOIN observed ow ON f.ORIG_STATION = ow.STATION_ID AND f.FL_DATE = ow.OBS_DATE
  JOIN observed dw ON f.DEST_STATION = dw.STATION_ID AND f.FL_DATE = dw.OBS_DATE
  WHERE ow.qualifies OR dw.qualifies
  GROUP BY ALL),
met AS (
  SELECT l.*, {label('ORIG_WEATHERS')} AS ORIG_LABEL, {label('DEST_WEATHERS')} AS DEST_LABEL,
    c.CATEGORY
  FROM listed l LEFT JOIN carriers c ON l.OP_CARRIER = c.OP_CARRIER)"""


def weather_code(column: str) -> str:
    return f"CASE {column} WHEN 'Rain' THEN 1 WHEN 'Snow' THEN 2 WHEN 'Wind' THEN 3 ELSE 4 END"


CARRIER_CODE = """CASE WHEN CATEGORY IN ('ULCC', '1') THEN 1 WHEN CATEGORY IN ('LCC', '2') THEN 2
  WHEN CATEGORY IN ('Normal', '3') THEN 3 END"""
CARRIER_LABEL = "CASE CATEGORY WHEN '1' THEN 'ULCC' WHEN '2' THEN 'LCC' WHEN '3' THEN 'Normal' ELSE CATEGORY END"

FEATURES = f"""{paired(False)},
features AS (
  SELECT {CARRIER_CODE} AS CARRIER_TYPE,
    coalesce(CAST(ORIG_AREA_CODE AS VARCHAR), ORIG_STATION) AS ORIG_AREA,
    coalesce(CAST(DEST_AREA_CODE AS VARCHAR), DEST_STATION) AS DEST_AREA,
    {delay_code('DEP_DELAY')} AS DEP_DELAY_CAT,
    {schedule_code('CRS_DEP_TIME')} AS ORIG_SCHEDULE,
    {schedule_code('CRS_ARR_TIME')} AS DEST_SCHEDULE,
    {weather_code('ORIG_LABEL')} AS ORIG_WEATHER,
    {weather_code('DEST_LABEL')} AS DEST_WEATHER,
    {delay_code('ARR_DELAY')} AS ARR_DELAY_CAT,
    year(FL_DATE) AS FL_YEAR
  FROM met),
training AS MATERIALIZED (
  SELECT coalesce(CARRIER_TYPE, 0) AS CARRIER_TYPE,
    coalesce(TRY_CAST(ORIG_AREA AS INTEGER), 0) AS ORIG_AREA,
    coalesce(TRY_CAST(DEST_AREA AS INTEGER), 0) AS DEST_AREA,
    DEP_DELAY_CAT, ORIG_SCHEDULE, DEST_SCHEDULE, ORIG_WEATHER, DEST_WEATHER, ARR_DELAY_CAT
  FROM features)"""

COLUMNS = ", ".join([*ATTRIBUTES, LABEL])


def base(select: str) -> str:
    return f"WITH {BASE}\n{select}"


# Over flights dated as their orders.
CALENDAR = BASE.replace(
    "SELECT DATE '2024-01-01' + CAST((year(o_orderdate) * 372 + month(o_orderdate) * 31\n"
    "           + day(o_orderdate)) % 30 AS INTEGER) AS FL_DATE",
    "SELECT CAST(o_orderdate AS DATE) AS FL_DATE",
)


def calendar(select: str) -> str:
    return f"WITH {CALENDAR}\n{select}"


def over_met(select: str, status: bool = False) -> str:
    return f"WITH {BASE},{paired(status)}\n{select}"


def over_features(select: str) -> str:
    return f"WITH {BASE},{FEATURES}\n{select}"


def entropies(rows: str, group: str) -> str:
    """Entropy of the label per group, as -sum(p log2 p); a row stands for ``copies`` rows."""
    return f"""(SELECT {group}, CAST(sum(n) AS BIGINT) AS n,
      -sum(n / total * log2(n / total)) AS h,
      min_by(y, (-n, y)) AS mode
    FROM (SELECT {group}, y, sum(copies) AS n, sum(sum(copies)) OVER (PARTITION BY {group}) AS total
          FROM {rows} GROUP BY {group}, y) GROUP BY {group})"""


def stacked(rows: str) -> str:
    """Rows repeated per attribute that their node has not used yet."""
    parts = [
        f"SELECT node_id, {index} AS attr, {name} AS v, {LABEL} AS y, copies FROM {rows} "
        f"WHERE NOT list_contains(used, {index})"
        for index, name in enumerate(ATTRIBUTES)
    ]
    return "(" + " UNION ALL ".join(parts) + ")"


def gains(rows: str) -> str:
    """H(label), H(label | attribute) per node and unused attribute."""
    return f"""(SELECT node_id, attr, any_value(w.h) AS h_y,
      sum(p.n * p.h) / any_value(w.n) AS h_y_x
    FROM {entropies(stacked(rows), 'node_id, attr, v')} p
    JOIN {entropies(f'(SELECT node_id, {LABEL} AS y, copies FROM {rows})', 'node_id')} w USING (node_id)
    GROUP BY node_id, attr)"""


def value_at(attr: str) -> str:
    cases = " ".join(f"WHEN {i} THEN {name}" for i, name in enumerate(ATTRIBUTES))
    return f"CASE {attr} {cases} END"


def tree_levels() -> str:
    """Rows and nodes of every level, by the stop rules of the training job."""
    parts = [
        """
rows0 AS MATERIALIZED (SELECT *, 'root' AS node_id, CAST([] AS INTEGER[]) AS used
  FROM (SELECT *, count(*) AS copies FROM training GROUP BY ALL))"""
    ]
    for level in range(len(ATTRIBUTES) + 1):
        parts.append(
            f"""
nodes{level} AS MATERIALIZED (
  SELECT w.node_id, w.n, w.h, w.mode, b.attr AS best,
    b.attr IS NULL OR round(w.h, 10) < 1 OR w.n < 100 OR {level} >= 4 AS is_leaf
  FROM {entropies(f'(SELECT node_id, {LABEL} AS y, copies FROM rows{level})', 'node_id')} w
  LEFT JOIN (SELECT node_id, min_by(attr, (round(h_y_x, 10), attr)) AS attr
             FROM {gains(f'rows{level}')} GROUP BY node_id) b USING (node_id)),
rows{level + 1} AS MATERIALIZED (
  SELECT r.* EXCLUDE (node_id, used),
    concat(r.node_id, '#', coalesce(CAST({value_at('best')} AS VARCHAR), '?')) AS node_id, list_append(used, best) AS used
  FROM rows{level} r JOIN nodes{level} n USING (node_id) WHERE NOT is_leaf)"""
        )
    union = " UNION ALL ".join(
        f"SELECT *, {level} AS level FROM nodes{level}" for level in range(len(ATTRIBUTES) + 1)
    )
    parts.append(f"\nnodes AS MATERIALIZED ({union})")
    return ",".join(parts)


def over_tree(select: str) -> str:
    return f"WITH {BASE},{FEATURES},{tree_levels()}\n{select}"


def reached() -> str:
    """Every row in every level with the leaf it ends in."""
    union = " UNION ALL ".join(
        f"SELECT {COLUMNS}, node_id, copies FROM rows{level}" for level in range(len(ATTRIBUTES) + 1)
    )
    return f"(SELECT r.*, n.mode FROM ({union}) r JOIN nodes n USING (node_id) WHERE n.is_leaf)"


def missing(column: str) -> str:
    return f"""{column} IS NULL OR {column} = '' OR {column} LIKE '%None%'
      OR {column} LIKE '%NULL%' OR coalesce(isnan(TRY_CAST({column} AS DOUBLE)), false)"""


def cleaned(column: str) -> str:
    return f"CASE WHEN {missing(column)} THEN '0' ELSE {column} END"


def as_int(text: str) -> str:
    return f"CAST(trunc(TRY_CAST({text} AS DOUBLE)) AS INTEGER)"


RAW_COLUMNS = ["ORIGIN", "DEST", "OP_CARRIER", "DEP_DELAY", "ARR_DELAY", "CRS_DEP_TIME", "DISTANCE"]
RAW_INTEGERS = ["DEP_DELAY", "ARR_DELAY", "CRS_DEP_TIME", "DISTANCE"]


def audit(column: str) -> str:
    nan = f"coalesce(isnan(TRY_CAST({column} AS DOUBLE)), false)"
    return f"""count(*) FILTER (WHERE {nan}) AS {column}_nan,
      count(*) FILTER (WHERE {column} IS NULL OR {nan}) AS {column}_missing"""


def scaled(column: str) -> str:
    return f"""round(({column} - avg({column}) OVER ()) / stddev_pop({column}) OVER (), 6) AS {column}"""


def coded(column: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {column}) - 1 AS INTEGER) AS {column}_code"


def times(end: str) -> str:
    """How often each code is in the pairwise list, as text."""
    entries = f"list_sort(map_entries({end}_TIMES))"
    return f"array_to_string(list_transform({entries}, lambda e: e.key || ':' || e.value), ',') AS {end}_WEATHERS"


TEXT_DATE = "* REPLACE (strftime(FL_DATE, '%Y-%m-%d') AS FL_DATE)"
NETWORK = "ORIG_AREA, DEST_AREA, ORIG_LABEL AS ORIG_WEATHER, DEST_LABEL AS DEST_WEATHER"
RAW_KEYS = """OP_CARRIER, OP_CARRIER_FL_NUM, CRS_DEP_TIME, DEP_DELAY, CRS_ARR_TIME, ARR_DELAY"""
FIT = """fit AS (SELECT regr_slope(ARR_DELAY, DEP_DELAY) AS slope,
    regr_intercept(ARR_DELAY, DEP_DELAY) AS intercept FROM flights),
scored AS (SELECT ARR_DELAY AS label, intercept + slope * DEP_DELAY AS prediction
  FROM flights, fit WHERE ARR_DELAY IS NOT NULL AND DEP_DELAY IS NOT NULL)"""

SQL: dict[str, str] = {
    "scan_flights": base(f"SELECT {TEXT_DATE} FROM flights"),
    "project_flights": base(
        f"SELECT strftime(FL_DATE, '%Y-%m-%d') AS FL_DATE, {RAW_KEYS}, ORIGIN, DEST FROM flights"
    ),
    "tree_input": over_features("SELECT *, 'root' AS node_id FROM training"),
    "clean_missing": base(
        "SELECT " + ", ".join(f"{cleaned(c)} AS {c}" for c in RAW_COLUMNS) + " FROM flights_raw"
    ),
    "clean_cast": base(
        "SELECT * FROM (SELECT "
        + ", ".join(
            f"{as_int(cleaned(c)) if c in RAW_INTEGERS else cleaned(c)} AS {c}" for c in RAW_COLUMNS
        )
        + " FROM flights_raw) WHERE DEP_DELAY <= 150"
    ),
    "null_audit": base("SELECT " + ", ".join(audit(c) for c in RAW_COLUMNS) + " FROM flights_raw"),
    "outlier_filter": base(
        "SELECT ORIGIN, OP_CARRIER, DEP_DELAY FROM flights_raw "
        "WHERE TRY_CAST(DEP_DELAY AS DOUBLE) <= 30"
    ),
    "delay_class": base(
        f"""SELECT DEP_DELAY, {delay_code('DEP_DELAY')} AS DEP_DELAY_CAT,
  {delay_label('DEP_DELAY')} AS DEP_DELAY_LABEL, ARR_DELAY, {delay_code('ARR_DELAY')} AS ARR_DELAY_CAT,
  {delay_label('ARR_DELAY')} AS ARR_DELAY_LABEL FROM flights"""
    ),
    "schedule_class": base(
        f"""SELECT CRS_DEP_TIME, {schedule_code('CRS_DEP_TIME')} AS ORIG_SCHEDULE,
  {schedule_label('CRS_DEP_TIME')} AS ORIG_SCHEDULE_LABEL FROM flights"""
    ),
    "area_bucket": base("SELECT AIRPORT_CODE, STATION, AREA FROM areas"),
    "area_bucket_int": base("SELECT AIRPORT_CODE, STATION, AREA_CODE FROM areas"),
    "flight_datekey": calendar(
        "SELECT strftime(FL_DATE, '%Y%m%d') AS DATE_KEY, count(*) AS n FROM flights GROUP BY 1"
    ),
    "month_day": calendar(
        """SELECT ORIGIN, DEST, OP_CARRIER, ARR_DELAY, CAST(month(FL_DATE) AS INTEGER) AS MONTH,
  CAST(day(FL_DATE) AS INTEGER) AS DAY FROM flights"""
    ),
    "flights_by_year": calendar(
        """SELECT OP_CARRIER, ORIGIN, DEST, ARR_DELAY, CAST(year(FL_DATE) AS INTEGER) AS YEAR FROM flights"""
    ),
    "random_split": base(
        """SELECT CASE WHEN ('0x' || substr(md5(concat_ws('|', '5', OP_CARRIER, OP_CARRIER_FL_NUM, ORIGIN, DEST,
  CRS_DEP_TIME)), 1, 8))::BIGINT % 100 < 25 THEN 'test' ELSE 'train' END AS split, count(*) AS n
FROM flights GROUP BY 1"""
    ),
    "delay_extremes": base(
        """SELECT max(DEP_DELAY * 3) FILTER (WHERE DEP_DELAY <> 0) AS dep_max,
  min(DEP_DELAY * 3) FILTER (WHERE DEP_DELAY <> 0) AS dep_min,
  max(ARR_DELAY) FILTER (WHERE ARR_DELAY % 7 <> 0) AS arr_max,
  min(ARR_DELAY) FILTER (WHERE ARR_DELAY % 7 <> 0) AS arr_min FROM flights"""
    ),
    "airport_delay": base(
        """SELECT ORIGIN, count(*) AS conFlight, round(avg(DEP_DELAY), 6) AS delay
FROM flights GROUP BY ORIGIN"""
    ),
    "top_delay_airports": base(
        """SELECT ORIGIN, count(*) AS conFlight, round(avg(DEP_DELAY), 6) AS delay
FROM flights GROUP BY ORIGIN ORDER BY avg(DEP_DELAY) DESC NULLS LAST, ORIGIN LIMIT 10"""
    ),
    "flights_from_origin": base("SELECT count(*) AS n FROM flights WHERE ORIGIN = 'A0'"),
    "carrier_month_delay": calendar(
        """SELECT OP_CARRIER, CAST(month(FL_DATE) AS INTEGER) AS Month,
  round(avg(DEP_DELAY), 6) AS avgDelay FROM flights WHERE DEP_DELAY > 0 GROUP BY 1, 2"""
    ),
    "origin_carrier_month": calendar(
        """SELECT OP_CARRIER, CAST(month(FL_DATE) AS INTEGER) AS Month,
  round(avg(DEP_DELAY), 6) AS avgDelay FROM flights
WHERE DEP_DELAY > 0 AND ORIGIN = 'A0' GROUP BY 1, 2"""
    ),
    "carrier_month_pivot": calendar(
        "SELECT CAST(month(FL_DATE) AS INTEGER) AS Month, "
        + ", ".join(
            f"""round(avg(DEP_DELAY) FILTER (WHERE OP_CARRIER = '{c}'), 6) AS "{c}" """
            for c in ("Brand#1", "Brand#10", "Brand#2")
        )
        + "FROM flights WHERE DEP_DELAY > 0 GROUP BY 1"
    ),
    "delay_causes": base(
        """SELECT sum(WEATHER_DELAY) AS Weather, sum(NAS_DELAY) AS NAS, sum(SECURITY_DELAY) AS Security,
  sum(LATE_AIRCRAFT_DELAY) AS lateAircraft, sum(CARRIER_DELAY) AS Carrier FROM flights"""
    ),
    "carriers_distinct": base("SELECT DISTINCT OP_CARRIER FROM flights"),
    "airport_codes": base("SELECT ORIGIN FROM flights UNION SELECT DEST FROM flights"),
    "airport_lookup_or": base(
        """SELECT c.ORIGIN, p.local_region AS STATE, p.municipality AS CITY, p.local_code AS LOCAL,
  p.iata_code AS IATA, p.ident AS IDENT, p.name AS NAME
FROM (SELECT ORIGIN FROM flights UNION SELECT DEST FROM flights) c
LEFT JOIN airports p ON c.ORIGIN = p.local_code OR c.ORIGIN = p.iata_code"""
    ),
    "weather_at_airports": base(
        """SELECT STATION_ID, strftime(OBS_DATE, '%Y-%m-%d') AS OBS_DATE, ELEMENT, DATA_VALUE,
  b.ORIGIN AS AIRPORT_CODE
FROM weather w LEFT JOIN airports_stations b ON w.STATION_ID = b.STATION WHERE b.ORIGIN IS NOT NULL"""
    ),
    "station_geo": base("SELECT * FROM geo"),
    "geo_extremes": base(
        """SELECT max(LATITUDE) AS lat_max, min(LATITUDE) AS lat_min, max(LONGITUDE) AS lon_max,
  min(LONGITUDE) AS lon_min FROM geo"""
    ),
    "flight_areas": base(
        """SELECT strftime(FL_DATE, '%Y-%m-%d') AS FL_DATE, OP_CARRIER, OP_CARRIER_FL_NUM, f.ORIGIN, f.DEST,
  o.STATION AS ORIG_STATION, o.AREA AS ORIG_AREA, o.AREA_CODE AS ORIG_AREA_CODE,
  d.STATION AS DEST_STATION, d.AREA AS DEST_AREA, d.AREA_CODE AS DEST_AREA_CODE
FROM flights f LEFT JOIN areas o ON f.ORIGIN = o.AIRPORT_CODE
LEFT JOIN areas d ON f.DEST = d.AIRPORT_CODE"""
    ),
    "carrier_type": base(
        f"""SELECT f.OP_CARRIER, OP_CARRIER_FL_NUM, CATEGORY AS CARRIER_TYPE,
  {CARRIER_CODE} AS CARRIER_TYPE_CODE
FROM flights f LEFT JOIN carriers c ON f.OP_CARRIER = c.OP_CARRIER"""
    ),
    "weather_class": over_met(
        """SELECT ORIG_LABEL AS ORIG_WEATHER, DEST_LABEL AS DEST_WEATHER, count(*) AS n
FROM met GROUP BY ALL"""
    ),
    "weather_lists": over_met(
        f"""SELECT strftime(FL_DATE, '%Y-%m-%d') AS FL_DATE, {RAW_KEYS},
  ORIG_STATION, ORIG_AREA, DEST_STATION, DEST_AREA,
  {times('ORIG')}, {times('DEST')} FROM met"""
    ),
    "features_int": over_features(f"SELECT {COLUMNS} FROM features"),
    "features_str": over_met(
        f"""SELECT {CARRIER_LABEL} AS CARRIER_TYPE, ORIG_AREA, DEST_AREA,
  {delay_label('DEP_DELAY')} AS DEP_DELAY_CAT, {schedule_label('CRS_DEP_TIME')} AS ORIG_SCHEDULE,
  {schedule_label('CRS_ARR_TIME')} AS DEST_SCHEDULE, ORIG_LABEL AS ORIG_WEATHER,
  DEST_LABEL AS DEST_WEATHER, {delay_label('ARR_DELAY')} AS ARR_DELAY_CAT FROM met"""
    ),
    "features_by_year": over_features(
        f"SELECT {COLUMNS}, CAST(FL_YEAR AS INTEGER) AS YEAR FROM features"
    ),
    "features_nn": over_met(
        f"SELECT strftime(FL_DATE, '%Y-%m-%d') AS FL_DATE, {RAW_KEYS}, {NETWORK} FROM met"
    ),
    "features_nn_status": over_met(
        f"""SELECT strftime(FL_DATE, '%Y-%m-%d') AS FL_DATE, {RAW_KEYS}, DIVERTED, CANCELLED,
  {NETWORK} FROM met""",
        status=True,
    ),
    "split_90_10": over_features(
        f"""SELECT {COLUMNS},
  CASE WHEN (place - 1) % 10 < 9 AND place <= total // 10 * 10 THEN 'train' ELSE 'test' END AS split
FROM (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', {COLUMNS}))) AS place,
        count(*) OVER () AS total FROM training)"""
    ),
    "label_entropy": over_features(
        f"""SELECT n, round(h, 6) AS entropy
FROM {entropies(f"(SELECT 'root' AS node_id, {LABEL} AS y, 1 AS copies FROM training)", 'node_id')}"""
    ),
    "information_gain": over_features(
        f"""SELECT attr, round(h_y, 6) AS h_y, round(h_y_x, 6) AS h_y_x, round(h_y - h_y_x, 6) AS gain
FROM {gains("(SELECT *, 1 AS copies, 'root' AS node_id, CAST([] AS INTEGER[]) AS used FROM training)")}"""
    ),
    "best_split_root": over_features(
        f"""SELECT attr, round(h_y - h_y_x, 6) AS gain
FROM {gains("(SELECT *, 1 AS copies, 'root' AS node_id, CAST([] AS INTEGER[]) AS used FROM training)")}
ORDER BY round(h_y - h_y_x, 10) DESC, attr LIMIT 1"""
    ),
    "node_mode": over_features(
        f"""SELECT DEP_DELAY_CAT, ORIG_WEATHER, {LABEL} AS mode, n
FROM (SELECT DEP_DELAY_CAT, ORIG_WEATHER, {LABEL}, count(*) AS n FROM training GROUP BY ALL)
QUALIFY row_number() OVER (PARTITION BY DEP_DELAY_CAT, ORIG_WEATHER ORDER BY n DESC, {LABEL}) = 1"""
    ),
    "tree_level_stats": over_tree(
        f"""SELECT node_id, attr, v AS value, y AS label, CAST(sum(copies) AS BIGINT) AS n
FROM (SELECT * FROM {stacked('rows1')}
      UNION ALL SELECT node_id, -1, 0, {LABEL}, copies FROM rows1) GROUP BY node_id, attr, v, y"""
    ),
    "tree_nodes": over_tree(
        """SELECT node_id,
  CASE WHEN level > 0 THEN array_to_string(string_split(node_id, '#')[:level], '#') END AS parent_id,
  level, CASE WHEN NOT is_leaf THEN best END AS split_attr,
  TRY_CAST(string_split(node_id, '#')[-1] AS INTEGER) AS split_value,
  n, round(h, 6) AS h_y, is_leaf, mode AS prediction
FROM nodes"""
    ),
    "tree_score": over_tree(f"SELECT {COLUMNS}, node_id, mode AS prediction FROM {reached()}, range(copies)"),
    "tree_text": over_tree(
        "SELECT node_id, concat(repeat('|---', level), node_id) AS line FROM nodes"
    ),
    "confusion_matrix": over_tree(
        f"""SELECT {LABEL} AS label, mode AS prediction, CAST(sum(copies) AS BIGINT) AS n FROM {reached()} GROUP BY {LABEL}, mode"""
    ),
    "tree_accuracy": over_tree(
        f"""SELECT round(sum(n) FILTER (WHERE label = prediction) / sum(n), 6) AS accuracy
FROM (SELECT {LABEL} AS label, mode AS prediction, CAST(sum(copies) AS BIGINT) AS n FROM {reached()} GROUP BY {LABEL}, mode)"""
    ),
    "label_encode": base(
        "SELECT OP_CARRIER, ORIGIN, DEST, "
        + ", ".join(coded(c) for c in ("OP_CARRIER", "ORIGIN", "DEST"))
        + " FROM flights"
    ),
    "one_hot": base(
        f"""SELECT {CARRIER_LABEL} AS CARRIER_TYPE,
  concat(CAST({CARRIER_LABEL} = 'Normal' AS INTEGER), CAST({CARRIER_LABEL} = 'ULCC' AS INTEGER)) AS dummies
FROM flights f JOIN carriers c ON f.OP_CARRIER = c.OP_CARRIER"""
    ),
    "standardize": base(
        "SELECT "
        + ", ".join(scaled(c) for c in ("CRS_DEP_TIME", "DEP_DELAY", "ARR_DELAY"))
        + " FROM flights"
    ),
    "linreg_simple": f"WITH {BASE}, {FIT} SELECT round(slope, 6) AS slope, round(intercept, 6) AS intercept FROM fit",
    "pred_actual": f"WITH {BASE}, {FIT} SELECT label, round(prediction, 6) AS prediction FROM scored",
    "regression_metrics": f"""WITH {BASE}, {FIT}
SELECT round(avg(abs(label - prediction)), 6) AS mae, round(avg((label - prediction) ** 2), 6) AS mse,
  round(sqrt(avg((label - prediction) ** 2)), 6) AS rmse,
  round(1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)), 6) AS r2 FROM scored""",
}
SQL["features_int_shuffled"] = SQL["features_int"]
SQL["tree_score_shuffled"] = SQL["tree_score"]


def code(column: str) -> str:
    """Place of a value among the distinct ones in order, as a number; -1 without a value."""
    return f"CAST(CASE WHEN {column} IS NULL THEN -1 ELSE dense_rank() OVER (ORDER BY {column} NULLS LAST) - 1 END AS DOUBLE)"


def number(column: str) -> str:
    return f"coalesce(CAST({column} AS DOUBLE), 0.0)"


def in_share(columns: list[str], percent: int, seed: int) -> str:
    """Whether the hash of a row's cells is in a share of all rows."""
    cells = ", ".join(columns)
    return f"('0x' || substr(md5(concat_ws('|', '{seed}', {cells})), 1, 8))::BIGINT % 100 < {percent}"


REGRESSION_CODES = ["OP_CARRIER", "ORIGIN", "DEST"]
REGRESSION_INTEGERS = ["CRS_ARR_TIME", "DIVERTED", "CANCELLED", "ARR_DELAY", "DISTANCE", "DEP_DELAY"]
REGRESSION_COLUMNS = [
    *REGRESSION_CODES, "CRS_ARR_TIME", "DIVERTED", "CANCELLED", "ARR_DELAY", "DISTANCE",
    "ACTUAL_ELAPSED_TIME", "AIR_TIME", "TAXI_IN", "TAXI_OUT", "DEP_DELAY",
]


def regression_cell(column: str) -> str:
    if column in REGRESSION_CODES:
        return f"{code(column)} AS {column}"
    return f"{number(f'trunc({column})' if column in REGRESSION_INTEGERS else column)} AS {column}"


REGRESSION = f"""{BASE},
cells AS (SELECT {', '.join(map(regression_cell, REGRESSION_COLUMNS))} FROM flights),
matrix AS MATERIALIZED (
  SELECT *, CASE WHEN {in_share(REGRESSION_COLUMNS, 25, 5)} THEN 'test' ELSE 'train' END AS split FROM cells)"""
SQL["regression_matrix"] = f"WITH {REGRESSION} SELECT * FROM matrix"


def elimination(features: list[str], label: str) -> str:
    """Normal equations of the standardised training rows, solved column by column.

    A pivot near zero belongs to a column that the ones before it determine; its coefficient is 0.
    """
    names = [*features, label]
    scaled = ", ".join(
        f"({c} - avg({c}) OVER ()) / coalesce(nullif(stddev_pop({c}) OVER (), 0), 1) AS {c}" for c in names
    )
    pairs = " UNION ALL ".join(
        f"SELECT {i} AS i, {j} AS j, avg({a} * {b}) AS v FROM scaled"
        for i, a in enumerate(features)
        for j, b in enumerate(names)
    )
    steps = [f"scaled AS MATERIALIZED (SELECT {scaled} FROM matrix WHERE split = 'train')", f"m0 AS MATERIALIZED ({pairs})"]
    for p in range(len(features)):
        steps.append(f"""m{p + 1} AS MATERIALIZED (
  SELECT m.i, m.j, CASE WHEN abs(d.v) < 1e-9 THEN CASE WHEN m.i = {p} OR m.j = {p} THEN 0 ELSE m.v END
    WHEN m.i = {p} THEN m.v / d.v ELSE m.v - c.v * r.v / d.v END AS v
  FROM m{p} m JOIN m{p} r ON r.i = {p} AND r.j = m.j JOIN m{p} c ON c.i = m.i AND c.j = {p}
  JOIN m{p} d ON d.i = {p} AND d.j = {p})""")
    slope = lambda i: f"(SELECT v FROM m{len(features)} WHERE i = {i} AND j = {len(features)})"
    parts = [
        f"coalesce((t.{c} - (SELECT avg({c}) FROM matrix WHERE split = 'train'))"
        f" / (SELECT nullif(stddev_pop({c}), 0) FROM matrix WHERE split = 'train') * {slope(i)}, 0)"
        for i, c in enumerate(features)
    ]
    level = f"(SELECT avg({label}) FROM matrix WHERE split = 'train')"
    spread = f"(SELECT stddev_pop({label}) FROM matrix WHERE split = 'train')"
    steps.append(f"""scored AS (SELECT {label} AS label, {level} + {spread} * ({' + '.join(parts)}) AS prediction
  FROM matrix t WHERE split = 'test')""")
    return ",\n".join(steps)


MEASURES = """SELECT round(avg(abs(label - prediction)), 6) AS mae, round(avg((label - prediction) ** 2), 6) AS mse,
  round(sqrt(avg((label - prediction) ** 2)), 6) AS rmse,
  round(1 - avg((label - prediction) ** 2) / var_pop(label), 6) AS r2 FROM scored"""
SQL["linear_regression"] = f"WITH {REGRESSION}, {elimination(REGRESSION_COLUMNS[:-1], 'DEP_DELAY')} {MEASURES}"

NETWORK_CELLS = {
    "OP_CARRIER": code("OP_CARRIER"), "OP_CARRIER_FL_NUM": number("OP_CARRIER_FL_NUM"),
    "CRS_DEP_TIME": number("CRS_DEP_TIME"), "DEP_DELAY": number("DEP_DELAY"), "CRS_ARR_TIME": number("CRS_ARR_TIME"),
    "DIVERTED": number("DIVERTED"), "CANCELLED": number("CANCELLED"), "ORIG_AREA": code("ORIG_AREA"),
    "DEST_AREA": code("DEST_AREA"), "ORIG_WEATHER": code("ORIG_LABEL"), "DEST_WEATHER": code("DEST_LABEL"),
    "MONTH": number("month(FL_DATE)"), "label": f"CAST({delay_code('ARR_DELAY')} - 1 AS DOUBLE)",
}
NETWORK_ROWS = f"SELECT {', '.join(f'{cell} AS {name}' for name, cell in NETWORK_CELLS.items())} FROM met"
SQL["network_matrix"] = over_met(
    f"SELECT *, count(*) AS n FROM ({NETWORK_ROWS}) GROUP BY ALL", status=True
)
SQL["network_folds"] = over_met(
    f"""SELECT CASE WHEN {in_share(list(NETWORK_CELLS), 30, 0)} THEN 'test'
  WHEN {in_share(list(NETWORK_CELLS), 20, 2)} THEN 'validation' ELSE 'train' END AS fold, count(*) AS n
FROM ({NETWORK_ROWS}) GROUP BY 1""",
    status=True,
)

VALUES = {c: f"dense_rank() OVER (ORDER BY {c}) - 1" for c in REGRESSION_CODES}
SQL["one_hot_sparse"] = base(
    f"""SELECT OP_CARRIER, ORIGIN, DEST, CAST(a + b + c AS INTEGER) AS size, concat_ws(',',
    CASE WHEN x > 0 THEN x - 1 END, CASE WHEN y > 0 THEN y - 1 + a END, CASE WHEN z > 0 THEN z - 1 + a + b END) AS places
  FROM (SELECT OP_CARRIER, ORIGIN, DEST, {VALUES['OP_CARRIER']} AS x, {VALUES['ORIGIN']} AS y, {VALUES['DEST']} AS z FROM flights),
    (SELECT count(DISTINCT OP_CARRIER) - 1 AS a, count(DISTINCT ORIGIN) - 1 AS b, count(DISTINCT DEST) - 1 AS c FROM flights)"""
)
REQUEST = ["MONTH", "DAY", "OP_CARRIER", "ORIGIN", "DEST"]
REQUESTS = "SELECT CAST(month(FL_DATE) AS INTEGER) AS MONTH, CAST(day(FL_DATE) AS INTEGER) AS DAY, OP_CARRIER, ORIGIN, DEST, ARR_DELAY FROM flights"
REQUEST_CELLS = [*REQUEST, "coalesce(CAST(ARR_DELAY AS VARCHAR), '')"]
SQL["request_split"] = calendar(
    f"""SELECT CASE WHEN {in_share(REQUEST_CELLS, 30, 0)} THEN 'test' ELSE 'train' END AS split,
  count(*) AS n, sum(ARR_DELAY) AS delay FROM ({REQUESTS}) GROUP BY 1"""
)


def variance_tree(depth: int, cuts: int = 256, min_leaf: int = 20) -> str:
    """Levels of a regression tree: thresholds at equal ranks of the distinct values of each node."""
    cells = ", ".join(
        f"{code(c)} AS x{i}" if c in REGRESSION_CODES else f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(REQUEST)
    )
    parts = [
        f"""
rows0 AS MATERIALIZED (
  SELECT x0, x1, x2, x3, x4, 1::BIGINT AS node, count(*) AS n, sum(y) AS s, sum(y * y) AS ss, list(y) AS ys
  FROM (SELECT {cells}, coalesce(ARR_DELAY, 0) AS y FROM ({REQUESTS})) GROUP BY ALL)"""
    ]
    for level in range(depth):
        stack = " UNION ALL ".join(f"SELECT node, {i} AS f, x{i} AS v, n, s FROM rows{level}" for i in range(len(REQUEST)))
        value = " ".join(f"WHEN {i} THEN x{i}" for i in range(len(REQUEST)))
        parts.append(
            f"""
values{level} AS MATERIALIZED (SELECT node, f, v, sum(n) AS n, sum(s) AS s FROM ({stack}) GROUP BY ALL),
tried{level} AS (
  SELECT *, all_n - left_n AS right_n, all_s - left_s AS right_s
  FROM (SELECT node, f, v, sum(n) OVER upto AS left_n, sum(s) OVER upto AS left_s, sum(n) OVER grp AS all_n,
          sum(s) OVER grp AS all_s, row_number() OVER upto AS rank, count(*) OVER grp AS d
        FROM values{level} WINDOW grp AS (PARTITION BY node, f),
          upto AS (PARTITION BY node, f ORDER BY v ROWS UNBOUNDED PRECEDING))
  WHERE rank * {cuts} // d > (rank - 1) * {cuts} // d),
splits{level} AS MATERIALIZED (
  SELECT node, max({{'g': gain, 'f': -f, 'v': -v}}) AS best
  FROM (SELECT *, round((left_s * left_s / left_n + right_s * right_s / right_n - all_s * all_s / all_n) / all_n, 9) AS gain
        FROM tried{level} WHERE left_n >= {min_leaf} AND right_n >= {min_leaf})
  WHERE gain > 1e-9 GROUP BY node),
rows{level + 1} AS MATERIALIZED (
  SELECT r.* REPLACE (2 * node + CAST(CASE -best.f {value} END > -best.v AS BIGINT) AS node)
  FROM rows{level} r JOIN splits{level} USING (node))"""
        )
    parts.append(
        f"splits{depth} AS (SELECT CAST(NULL AS BIGINT) AS node, CAST(NULL AS STRUCT(g DOUBLE, f INTEGER, v DOUBLE)) AS best LIMIT 0)"
    )
    names = " ".join(f"WHEN {i} THEN '{c}'" for i, c in enumerate(REQUEST))
    told = " UNION ALL ".join(
        f"""SELECT node AS node_id, {level} AS level, CAST(sum(n) AS BIGINT) AS n, sum(s) / sum(n) AS mean,
  CASE -any_value(best.f) {names} END AS feature, -any_value(best.v) AS threshold, sum(ss) AS ss
FROM rows{level} LEFT JOIN splits{level} USING (node) GROUP BY node"""
        for level in range(depth + 1)
    )
    parts.append(f"told AS MATERIALIZED ({told})")
    # The rows that have stopped at any level; whoever joins them keeps those of leaves.
    held = " UNION ALL ".join(f"SELECT node, ys FROM rows{level}" for level in range(depth + 1))
    parts.append(f"rows{depth}_all AS ({held})")
    return ",".join(parts)


SQL["regression_tree_nodes"] = f"""WITH {CALENDAR},{variance_tree(3)}
SELECT node_id, level, n, round(mean, 6) AS prediction, feature, threshold FROM told"""
SQL["regression_tree_score"] = f"""WITH {CALENDAR},{variance_tree(3)},
leaves AS (
  SELECT node AS node_id, y - mean AS miss, y
  FROM (SELECT node, unnest(ys) AS y FROM rows3_all) JOIN told ON node = node_id AND feature IS NULL)
SELECT round(avg(abs(miss)), 6) AS mae, round(avg(miss * miss), 6) AS mse, round(sqrt(avg(miss * miss)), 6) AS rmse,
  round(1 - avg(miss * miss) / var_pop(y), 6) AS r2 FROM leaves"""
SQL["years_rewritten"] = calendar(
    """SELECT CAST(year(FL_DATE) AS INTEGER) AS YEAR, count(*) AS rows, count(*) AS found FROM flights GROUP BY 1"""
)
SQL["explored_at_once"] = calendar(
    """SELECT ORIGIN, OP_CARRIER, Month, count(*) AS conFlight, round(avg(DEP_DELAY), 6) AS delay,
  round(avg(DEP_DELAY) FILTER (WHERE DEP_DELAY > 0), 6) AS avgDelay, sum(WEATHER_DELAY) AS Weather,
  sum(NAS_DELAY) AS NAS, sum(SECURITY_DELAY) AS Security, sum(LATE_AIRCRAFT_DELAY) AS lateAircraft,
  sum(CARRIER_DELAY) AS Carrier,
  CASE WHEN ORIGIN IS NOT NULL THEN 'airports' WHEN OP_CARRIER IS NOT NULL THEN 'carriers' ELSE 'causes' END AS part
FROM (SELECT *, CAST(month(FL_DATE) AS INTEGER) AS Month FROM flights)
GROUP BY GROUPING SETS ((ORIGIN), (OP_CARRIER, Month), ())"""
)
SQL["features_int_laid_out"] = SQL["features_int"]
