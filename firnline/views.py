"""The given tables seen as station readings, daily weather, lake logs and so on.

One SQL text per view serves Spark and the DuckDB check alike; only views are shared,
the operators on top are written separately on both sides. Numbers are put on dyadic
steps (1/64 and the like), so sums are exact in double precision and do not depend on
the order in which partitions are added up.
"""

READINGS = """
SELECT CAST(user_id % 6 + 1 AS INTEGER) AS station_id,
       CASE event_type WHEN 'click' THEN 'LT' WHEN 'view' THEN 'LF' WHEN 'error' THEN 'HS'
                       WHEN 'purchase' THEN 'N' ELSE 'GS' END AS sensor,
       CAST(date_trunc('hour', ts) AS @ntz) AS ts,
       CASE event_type WHEN 'click' THEN q / 4 - 31 WHEN 'view' THEN q - 8 WHEN 'error' THEN 2 * q - 5
                       WHEN 'purchase' THEN q / 8 - 1 ELSE q - 4 END AS value,
       event_id
FROM (SELECT event_id, ts, user_id, event_type, floor(value * 64) / 64 AS q FROM {events}) e
"""

# the same readings spread over a hydrological year, one step every twelve hours
SEASON_READINGS = """
SELECT station_id, sensor,
       CAST(CAST('2023-10-01 00:00:00' AS @ntz) + (ts - CAST('2024-01-01 00:00:00' AS @ntz)) * 12 AS @ntz) AS ts,
       value, event_id
FROM {readings} r
"""

SPRING = """
SELECT CASE user_id % 3 WHEN 0 THEN 'lower' WHEN 1 THEN 'upper' ELSE 'spring' END AS site,
       ts, q / 16 AS wt, 40 + q / 8 AS slt, q / 32 AS wd
FROM (SELECT ts, user_id, floor(value * 64) / 64 AS q FROM {events}) e
"""

DAILY = """
SELECT CAST(o_custkey % 6 + 1 AS INTEGER) AS station_id, CAST(o_orderdate AS DATE) AS date,
       CAST(max(CASE WHEN o_orderpriority <> '5-LOW' THEN floor(o_totalprice / 1000) / 4 END) AS DOUBLE) AS hs,
       CAST(min(CASE WHEN o_orderpriority <> '1-URGENT' THEN floor(o_totalprice / 4000) / 4 - 12 END) AS DOUBLE) AS lt,
       CAST(max(floor(o_totalprice / 5000)) AS DOUBLE) AS lf,
       CAST(sum(CASE WHEN o_custkey % 6 <> 1 THEN floor(o_totalprice / 25000) / 4 END) AS DOUBLE) AS n,
       CAST(max(floor(o_totalprice / 20000)) AS DOUBLE) AS gs,
       CAST(NULL AS DOUBLE) AS sd
FROM {orders} o
GROUP BY 1, 2
"""

MONTHLY = """
SELECT station_id, CAST(last_day(date) AS @ntz) AS period, avg(lt) AS lt, avg(lf) AS lf, avg(hs) AS hs,
       sum(n) AS n, CAST(NULL AS DOUBLE) AS sd, sum(gs) AS gs
FROM {daily} d
GROUP BY 1, 2
"""

PROCESSED = """
SELECT station_id, 'daily' AS rule, CAST(date AS @ntz) AS period, lt, lf, hs, n, sd, gs FROM {daily} d
UNION ALL
SELECT station_id, 'monthly' AS rule, period, lt, lf, hs, n, sd, gs FROM {monthly} m
"""

LAKE_DEPTH = """
SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'Limo' ELSE 'Parom' END AS lake, CAST(l_shipdate AS DATE) AS date,
       avg(l_quantity) / 5 AS wd
FROM {lineitem} l
GROUP BY 1, 2
"""

LAKE_CALC = """
SELECT CASE WHEN l_suppkey % 2 = 0 THEN 'Limo' ELSE 'Parom' END AS lake, CAST(l_shipdate AS DATE) AS date,
       CAST(max(CASE WHEN l_returnflag = 'R' THEN floor(l_extendedprice / 4) END) AS DOUBLE) AS area_glatt,
       CAST(max(floor(l_extendedprice * 1.25)) AS DOUBLE) AS vol_calc,
       CAST(max(CASE WHEN l_linestatus = 'F' THEN floor(l_extendedprice) END) AS DOUBLE) AS volume,
       CASE WHEN min(l_linenumber) < 4 THEN floor(avg(l_quantity)) / 2 END AS wd
FROM {lineitem} l
GROUP BY 1, 2
"""

ISOTOPES = """
SELECT CASE label % 4 WHEN 0 THEN 'Lavarella' WHEN 1 THEN 'Pederü' WHEN 2 THEN 'LimoseeNord' ELSE 'LimoseeSüd' END AS site,
       vec_id AS sample, CAST(DATE '2019-01-01' + CAST(vec_id % 3650 AS INTEGER) AS DATE) AS date,
       CAST(embedding[@one] AS DOUBLE) * 10 - 12 AS d18o, abs(CAST(embedding[@two] AS DOUBLE)) AS d18o_sd,
       CAST(embedding[@three] AS DOUBLE) * 80 - 86 AS d2h, abs(CAST(embedding[@four] AS DOUBLE)) AS d2h_sd
FROM {embeddings} v
"""

CONDUCTIVITY = """
SELECT l_orderkey, CASE WHEN l_returnflag = 'R' THEN 150 + l_quantity / 2 ELSE 320 + l_quantity END AS slt
FROM {lineitem} l
"""

# portal files as (file name, DATE, VALUE) records
PORTAL = """
SELECT concat(CASE user_id % 6 WHEN 0 THEN 'Piz La Ila' WHEN 1 THEN 'Rossalm' WHEN 2 THEN 'Piz Pisciadu'
                               WHEN 3 THEN 'Wolkenstein' WHEN 4 THEN 'St. Martin' ELSE 'St. Veit' END,
              '_', CASE event_type WHEN 'click' THEN 'LT' WHEN 'view' THEN 'LF' WHEN 'error' THEN 'HS'
                                   WHEN 'purchase' THEN 'N' ELSE 'GS' END,
              '_from_20240101_to_20240131.json') AS file_name,
       concat(substr(CAST(CAST(date_trunc('hour', ts) AS @ntz) AS VARCHAR(32)), 1, 10), 'T',
              substr(CAST(CAST(date_trunc('hour', ts) AS @ntz) AS VARCHAR(32)), 12, 8), 'CET') AS DATE,
       floor(value * 64) / 64 AS VALUE
FROM {events} e
"""

# historic export lines
HISTORIC = """
SELECT concat(lpad(CAST(day(o_orderdate) AS VARCHAR(2)), 2, '0'), '/', lpad(CAST(month(o_orderdate) AS VARCHAR(2)), 2, '0'), '/',
              CAST(year(o_orderdate) AS VARCHAR(4)), '@tab', '00:00:00', '@tab',
              CASE o_orderpriority WHEN '1-URGENT' THEN '---'
                   ELSE replace(CAST(floor(o_totalprice / 1000) / 4 AS VARCHAR(20)), '.', ',') END, '@tab',
              CASE o_orderpriority WHEN '1-URGENT' THEN '255 (255)' WHEN '2-HIGH' THEN '80 (Ersatzwert)' ELSE '40 (Gut)' END) AS value,
       concat('73500MS_', CASE o_custkey % 3 WHEN 0 THEN 'Wolkenstein' WHEN 1 THEN 'Rossalm' ELSE 'St.Martin' END, '_',
              CASE WHEN o_orderstatus = 'F' THEN 'HS' WHEN o_orderstatus = 'O' THEN 'LT' ELSE 'N' END, '_',
              CASE WHEN o_orderkey % 2 = 0 THEN 'Day' ELSE 'Month' END, '.csv') AS file_name
FROM {orders} o
"""

# paths of portal files; two overlapping listings by order status
FILES = """
SELECT DISTINCT concat('WeatherData/', CASE o_custkey % 4 WHEN 0 THEN 'Rossalm' WHEN 1 THEN 'Wolkenstein'
                                          WHEN 2 THEN 'Processed' ELSE 'St. Veit' END,
              '/', CASE o_custkey % 4 WHEN 0 THEN 'Rossalm' WHEN 1 THEN 'Wolkenstein' WHEN 2 THEN 'Rossalm' ELSE 'St. Veit' END,
              '_', CASE o_orderpriority WHEN '1-URGENT' THEN 'LT' WHEN '2-HIGH' THEN 'HS' ELSE 'N' END, '_from_',
              CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS VARCHAR(8)), '.json') AS path,
       o_orderstatus AS status
FROM {orders} o
"""

DOCUMENTS = """
SELECT concat('{{"', s_name, '": {{"coords": [', CAST(s_suppkey AS VARCHAR(20)), '.5, ', CAST(s_nationkey AS VARCHAR(20)),
              '.25], "scode": "C', CAST(s_suppkey AS VARCHAR(20)), '", "alt": ', CAST(s_nationkey * 100 AS VARCHAR(20)), '}}}}') AS value
FROM {supplier} s
"""

VIEWS = {
    "readings": READINGS, "season_readings": SEASON_READINGS, "spring": SPRING, "daily": DAILY, "monthly": MONTHLY,
    "processed": PROCESSED, "lake_depth": LAKE_DEPTH, "lake_calc": LAKE_CALC, "isotopes": ISOTOPES,
    "conductivity": CONDUCTIVITY, "portal": PORTAL, "historic": HISTORIC, "files": FILES, "documents_json": DOCUMENTS,
}
NEEDS = {"season_readings": ["readings"], "monthly": ["daily"], "processed": ["daily", "monthly"]}
TABLES = ("events", "orders", "lineitem", "embeddings", "supplier")


def _text(sql, ntz, base):
    for word, i in (("@one", 0), ("@two", 1), ("@three", 2), ("@four", 3)):
        sql = sql.replace(word, str(i + base))
    return sql.replace("@ntz", ntz).replace("@tab", "\t")


def load(spark, sf_dir, name):
    """A table or view as a DataFrame."""
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = _text(VIEWS[name], "TIMESTAMP_NTZ", 0)
    used = [t for t in (*TABLES, *VIEWS) if "{" + t + "}" in sql]
    return spark.sql(sql, **{t: load(spark, sf_dir, t) for t in used})


def load_stream(spark, sf_dir, name):
    """A view over the events as a stream of their files."""
    schema = load(spark, sf_dir, "events").schema
    sql = _text(VIEWS[name], "TIMESTAMP_NTZ", 0)
    if "{readings}" in sql:
        return spark.sql(sql, readings=load_stream(spark, sf_dir, "readings"))
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    return spark.sql(sql, events=events)


def duck_views(*names):
    """The views as WITH entries for DuckDB."""
    out = []

    def add(name):
        for n in NEEDS.get(name, []):
            add(n)
        if name not in [x for x, _ in out]:
            sql = _text(VIEWS[name], "TIMESTAMP", 1)
            for t in (*TABLES, *VIEWS):
                sql = sql.replace("{" + t + "}", t)
            out.append((name, sql.replace("{{", "{").replace("}}", "}")))

    for n in names:
        add(n)
    return ",\n".join(f"{n} AS ({sql})" for n, sql in out)
