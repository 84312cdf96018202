"""Queries of the operators on time, snapshots and schemas, each with its DuckDB oracle."""

from __future__ import annotations

from pyspark.sql import functions as F

from relcast.operators.crosswalk import entries_on, id_crosswalk, id_crosswalk_history
from relcast.operators.intervals import asof_join, presence_intervals
from relcast.operators.releases import PERIOD
from relcast.operators.rollups import suppressed_rollup
from relcast.operators.sketches import STANDARD_ERROR, approx_distinct, update_sketches
from relcast.operators.snapshots import snapshot_diff
from relcast.queries import fixtures as fx
from relcast.queries.registry import PRIORITY_TYPES, query, t
from relcast.session import scratch_path
from relcast.sources.catalog import DATASET_EXTRA, extra, extra_fields, flatten_open_catalog, read_open_catalog
from relcast.sources.csv import FILE_PATH, scan_csv
from relcast.sources.files import list_releases
from relcast.sources.infer import NA_VALUES, infer_types, scan_csv_inferred

# =========================================================== joins on time

_MONTH = "CAST(date_trunc('month', o_orderdate) AS DATE)"


def _facilities(spark, sf):
    """Orders as facility tables: the priority stands for the type, months for releases."""
    orders = t(spark, sf, "orders")
    return {ftype: orders.where(F.col("o_orderpriority") == priority).select(
        F.col("o_custkey").alias("npi"), F.concat(F.lit("C"), (F.col("o_custkey") % 7).cast("string")).alias("ccn"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("state"), F.trunc("o_orderdate", "month").alias(PERIOD))
        for priority, ftype in PRIORITY_TYPES.items()}


_FACILITIES_SQL = f"""
f AS (SELECT lower(substr(o_orderpriority, 3)) AS facility_type, o_custkey AS npi, 'C' || CAST(o_custkey % 7 AS VARCHAR) AS other_id,
             CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS state, {_MONTH} AS d FROM orders)"""


@query("crosswalk_on_date", f"""
WITH {_FACILITIES_SQL},
x AS (SELECT facility_type, npi, other_id, min(d) AS s, max(d) AS e, first(state ORDER BY d, state NULLS LAST) AS st FROM f GROUP BY ALL),
r AS (SELECT l_orderkey AS claim, l_linenumber AS line, o_custkey AS npi, CAST(l_shipdate AS DATE) + 200 * (l_linenumber % 3) AS service_date FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
SELECT claim, line, r.npi, service_date, facility_type, other_id, st AS other_id_state, s AS other_id_dt_s, e AS other_id_dt_e
FROM r LEFT JOIN x ON x.npi = r.npi AND service_date BETWEEN s AND e
""")
def q_crosswalk_on_date(spark, sf):
    lines = t(spark, sf, "lineitem").join(t(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    claims = lines.select(F.col("l_orderkey").alias("claim"), F.col("l_linenumber").alias("line"), F.col("o_custkey").alias("npi"),
                          F.date_add(F.to_date("l_shipdate"), 200 * (F.col("l_linenumber") % 3)).alias("service_date"))
    found = entries_on(claims, id_crosswalk(_facilities(spark, sf)), "service_date")
    return found.select("claim", "line", "npi", "service_date", "facility_type", "other_id", "other_id_state", "other_id_dt_s", "other_id_dt_e")


@query("order_as_of", """
WITH r AS (SELECT o_custkey, o_orderdate AS last_date, max(o_orderkey) AS last_key, max_by(o_totalprice, o_orderkey) AS last_price
           FROM orders WHERE o_orderstatus = 'F' GROUP BY o_custkey, o_orderdate),
e AS (SELECT o_orderkey, CASE WHEN o_orderkey % 41 = 0 THEN NULL ELSE o_custkey END AS o_custkey, o_orderdate FROM orders)
SELECT e.o_orderkey, e.o_custkey, e.o_orderdate, CASE WHEN near THEN last_date END AS last_date, CASE WHEN near THEN last_key END AS last_key, CASE WHEN near THEN last_price END AS last_price
FROM (SELECT e.*, r.last_date, r.last_key, r.last_price, date_diff('day', r.last_date, e.o_orderdate) <= 500 AS near
      FROM e ASOF LEFT JOIN r ON r.o_custkey = e.o_custkey AND e.o_orderdate >= r.last_date) e
""")
def q_order_as_of(spark, sf):
    orders = t(spark, sf, "orders")
    left = orders.select("o_orderkey", F.when(F.col("o_orderkey") % 41 != 0, F.col("o_custkey")).alias("o_custkey"), "o_orderdate")
    right = orders.where(F.col("o_orderstatus") == "F").select(
        "o_custkey", F.col("o_orderdate").alias("last_date"), F.col("o_orderkey").alias("last_key"), F.col("o_totalprice").alias("last_price"))
    return asof_join(left, right, ["o_custkey"], "o_orderdate", "last_date", tolerance=500)


_RUNS_SQL = """
SELECT {keys}, {state}, min(d) AS first_period, max(d) AS last_period, count(*) AS n_periods, max(d) = any_value(newest) AS is_current
FROM (SELECT *, rank - row_number() OVER (PARTITION BY {keys}, {state} ORDER BY rank) AS run
      FROM (SELECT {keys}, d, min({state}) AS {state} FROM {rows} GROUP BY {keys}, d) JOIN {calendar})
GROUP BY {keys}, {state}, run
"""


@query("presence_intervals", f"""
WITH r AS (SELECT o_custkey, o_orderstatus, {_MONTH} AS d FROM orders),
c AS (SELECT d, row_number() OVER (ORDER BY d) AS rank, max(d) OVER () AS newest FROM (SELECT DISTINCT d FROM r))
""" + _RUNS_SQL.format(keys="o_custkey", state="o_orderstatus", rows="r", calendar="c USING (d)"))
def q_presence_intervals(spark, sf):
    rows = t(spark, sf, "orders").select("o_custkey", "o_orderstatus", F.trunc("o_orderdate", "month").alias("d"))
    return presence_intervals(rows, ["o_custkey"], "d", ["o_orderstatus"])


@query("crosswalk_history", f"""
WITH {_FACILITIES_SQL},
c AS (SELECT facility_type AS ct, d, row_number() OVER (PARTITION BY facility_type ORDER BY d) AS rank, max(d) OVER (PARTITION BY facility_type) AS newest
      FROM (SELECT DISTINCT facility_type, d FROM f)),
runs AS ({_RUNS_SQL.format(keys="facility_type, npi, other_id", state="state", rows="f", calendar="c ON c.d = f.d AND ct = facility_type").replace("GROUP BY facility_type, npi, other_id, d) JOIN c", "GROUP BY ALL) f JOIN c").replace("SELECT *, rank", "SELECT f.*, rank, newest, rank")})
SELECT npi, other_id, facility_type, state AS other_id_state, first_period AS other_id_dt_s, last_period AS other_id_dt_e, is_current,
       concat_ws('^', other_id, '06', coalesce(state, ''), 'MEDICARE', 'CCN', CAST(first_period AS VARCHAR), CAST(last_period AS VARCHAR)) AS other_id_token
FROM runs
""")
def q_crosswalk_history(spark, sf):
    found = id_crosswalk_history(_facilities(spark, sf))
    return found.select("npi", "other_id", "facility_type", "other_id_state", "other_id_dt_s", "other_id_dt_e", "is_current", "other_id_token")


# =========================================================== snapshots, totals, sketches

_SNAPSHOT = "o_orderkey, o_custkey, o_totalprice, o_orderpriority"


@query("snapshot_changes", f"""
WITH b AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 17 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 29 <> 0 THEN o_orderpriority END AS o_orderpriority
           FROM orders, range(1 + CASE WHEN o_orderkey % 19 = 0 THEN 2 ELSE 0 END) r(k) WHERE o_orderkey % 13 <> 0),
a AS (SELECT {_SNAPSHOT} FROM orders, range(1 + CASE WHEN o_orderkey % 23 = 0 THEN 1 ELSE 0 END) r(k) WHERE o_orderkey % 11 <> 0),
d AS (SELECT *, 1 AS s FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, -1 FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)),
g AS (SELECT {_SNAPSHOT}, s, count(*) AS copies FROM d GROUP BY ALL)
SELECT {_SNAPSHOT}, copies, CASE WHEN count(DISTINCT s) OVER (PARTITION BY o_orderkey) = 2 THEN CASE WHEN s = 1 THEN 'new' ELSE 'old' END WHEN s = 1 THEN 'added' ELSE 'removed' END AS change
FROM g
""")
def q_snapshot_changes(spark, sf):
    orders = t(spark, sf, "orders")
    k = F.col("o_orderkey")
    times = lambda df, n: df.withColumn("_k", F.explode(F.sequence(F.lit(1), n))).drop("_k")
    before = times(orders.where(k % 13 != 0), F.when(k % 19 == 0, F.lit(3)).otherwise(F.lit(1))).select(
        k, "o_custkey", F.when(k % 17 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.when(k % 29 != 0, F.col("o_orderpriority")).alias("o_orderpriority"))
    after = times(orders.where(k % 11 != 0), F.when(k % 23 == 0, F.lit(2)).otherwise(F.lit(1))).select(k, "o_custkey", "o_totalprice", "o_orderpriority")
    return snapshot_diff(before, after, ["o_orderkey"])


@query("suppressed_rollup", """
WITH c AS (SELECT n_regionkey AS region, CASE WHEN n_nationkey % 9 <> 4 THEN n_name END AS nation, c_mktsegment AS segment, c_acctbal AS bal FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE c_custkey % 3 <> n_nationkey % 4),
g3 AS (SELECT region, nation, segment, count(*) AS n, round(sum(bal), 2) AS balance FROM c GROUP BY ALL),
g2 AS (SELECT region, nation, count(*) AS n, round(sum(bal), 2) AS balance FROM c GROUP BY ALL),
g1 AS (SELECT region, count(*) AS n, round(sum(bal), 2) AS balance FROM c GROUP BY ALL),
g0 AS (SELECT count(*) AS n, round(sum(bal), 2) AS balance FROM c),
s0 AS (SELECT *, CASE WHEN n < 11 THEN 'small' END AS h FROM g0),
s1 AS (SELECT g.*, CASE WHEN g.n < 11 THEN 'small' WHEN (CASE WHEN p.h IS NULL THEN g.k = 1 ELSE g.k = 0 END) AND g.rn = 1 THEN 'complement' END AS h
       FROM (SELECT *, count(*) FILTER (n < 11) OVER () AS k, row_number() OVER (PARTITION BY n < 11 ORDER BY n, region NULLS FIRST) AS rn FROM g1) g, s0 p),
s2 AS (SELECT g.*, CASE WHEN g.n < 11 THEN 'small' WHEN (CASE WHEN p.h IS NULL THEN g.k = 1 ELSE g.k = 0 END) AND g.rn = 1 THEN 'complement' END AS h
       FROM (SELECT *, count(*) FILTER (n < 11) OVER (PARTITION BY region) AS k, row_number() OVER (PARTITION BY region, n < 11 ORDER BY n, nation NULLS FIRST) AS rn FROM g2) g
       JOIN s1 p ON p.region IS NOT DISTINCT FROM g.region),
s3 AS (SELECT g.*, CASE WHEN g.n < 11 THEN 'small' WHEN (CASE WHEN p.h IS NULL THEN g.k = 1 ELSE g.k = 0 END) AND g.rn = 1 THEN 'complement' END AS h
       FROM (SELECT *, count(*) FILTER (n < 11) OVER (PARTITION BY region, nation) AS k, row_number() OVER (PARTITION BY region, nation, n < 11 ORDER BY n, segment NULLS FIRST) AS rn FROM g3) g
       JOIN s2 p ON p.region IS NOT DISTINCT FROM g.region AND p.nation IS NOT DISTINCT FROM g.nation),
u AS (SELECT NULL::INTEGER AS region, NULL::VARCHAR AS nation, NULL::VARCHAR AS segment, 0 AS level, n, balance, h FROM s0 UNION ALL SELECT region, NULL, NULL, 1, n, balance, h FROM s1
      UNION ALL SELECT region, nation, NULL, 2, n, balance, h FROM s2 UNION ALL SELECT region, nation, segment, 3, n, balance, h FROM s3)
SELECT region, nation, segment, level, CASE WHEN h IS NULL THEN n END AS n, CASE WHEN h IS NULL THEN balance END AS balance, h AS suppressed FROM u
""")
def q_suppressed_rollup(spark, sf):
    rows = t(spark, sf, "customer").join(t(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).where(F.col("c_custkey") % 3 != F.col("n_nationkey") % 4)
    rows = rows.select(F.col("n_regionkey").alias("region"), F.when(F.col("n_nationkey") % 9 != 4, F.col("n_name")).alias("nation"),
                       F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("bal"))
    return suppressed_rollup(rows, ["region", "nation", "segment"], {"balance": F.round(F.sum("bal"), 2)})


@query("approx_distinct", """
SELECT 'o_custkey' AS "column", count(DISTINCT year(o_orderdate))::INTEGER AS n_periods, count(*) AS n_rows, count(DISTINCT o_custkey) AS n_exact, true AS within FROM orders
UNION ALL SELECT 'o_totalprice', count(DISTINCT year(o_orderdate))::INTEGER, count(*), count(DISTINCT o_totalprice), true FROM orders
""")
def q_approx_distinct(spark, sf):
    """Sketches per year, the last year's loaded again; unions against the exact counts, within four standard errors."""
    orders = t(spark, sf, "orders").withColumn(PERIOD, F.trunc("o_orderdate", "year"))
    target, columns = scratch_path(spark, "approx_distinct"), ["o_custkey", "o_totalprice"]
    newest = orders.agg(F.max(PERIOD)).first()[0]
    stale = orders.where(F.col(PERIOD) == F.lit(newest)).withColumn("o_custkey", -F.col("o_orderkey"))
    update_sketches(orders.where(F.col(PERIOD) < F.lit(newest)).unionByName(stale), target, columns)
    update_sketches(orders.where(F.col(PERIOD) == F.lit(newest)), target, columns)
    exact = orders.agg(*[F.count_distinct(c).alias(c) for c in columns]).select(
        F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_exact")) for c in columns])))
    found = approx_distinct(spark, target, columns).join(exact, "column")
    close = F.abs(F.col("n_distinct") - F.col("n_exact")) <= 4 * STANDARD_ERROR * F.col("n_exact") + 1
    return found.select("column", F.col("n_periods").cast("int").alias("n_periods"), "n_rows", "n_exact", close.alias("within"))


# =========================================================== types and date formats from the data

@query("infer_types", """
SELECT c.col AS "column", c.type, c.format, c.n AS n_values FROM (
  SELECT 'order_key' AS col, CASE WHEN max(o_orderkey) <= 2147483647 THEN 'int' ELSE 'bigint' END AS type, NULL AS format, count(*) AS n FROM r
  UNION ALL SELECT 'custkey', 'int', NULL, count(*) FILTER (o_orderkey % 11 <> 0) FROM r
  UNION ALL SELECT 'total_price', 'string', NULL, count(*) FROM r
  UNION ALL SELECT 'order_date', 'date', 'M/d/yyyy', count(*) FROM r
  UNION ALL SELECT 'order_status', 'string', NULL, count(*) FROM r
  UNION ALL SELECT 'order_priority', 'string', NULL, count(*) FROM r
  UNION ALL SELECT 'clerk_note', 'string', NULL, count(*) FILTER (year(o_orderdate) >= 1998) FROM r) c
""".replace(" FROM r", " FROM (SELECT o_orderkey, o_orderdate FROM orders UNION ALL SELECT o_orderkey, o_orderdate FROM orders WHERE year(o_orderdate) % 2 = 1) r"))
def q_infer_types(spark, sf):
    """Both header vintages and all releases of the order files, in one pass."""
    raw = scan_csv(spark, list_releases(spark, fx.order_releases(spark, sf), ("*.csv",)), fx.ORDERS_SPEC.renames).drop(FILE_PATH)
    return infer_types(raw, na_values=(*NA_VALUES, fx.ORDER_MARKER)).select("column", "type", "format", "n_values")


_DATES_SQL = "CAST(o_orderdate AS DATE)"


@query("csv_scan_inferred", f"""
SELECT CAST(o_orderkey AS INTEGER) AS o_orderkey, CASE WHEN o_orderkey % 10 <> 0 THEN CAST(o_custkey AS DOUBLE) / 2 END AS half, {_DATES_SQL} AS iso, {_DATES_SQL} AS day_first, {_DATES_SQL} AS month_first,
       {_DATES_SQL} AS short, lpad(CAST(o_orderkey % 1000 AS VARCHAR), 6, '0') AS code, o_orderkey % 2 = 0 AS even
FROM orders
""")
def q_csv_scan_inferred(spark, sf):
    """Files per year whose date columns have a format each, elected from their values."""
    folder = fx.dated_orders(spark, sf)
    return scan_csv_inferred(spark, list_releases(spark, folder, ("dated_*.csv",))).drop(FILE_PATH)


# =========================================================== catalogue fields outside the schema

@query("catalog_extra", """
SELECT 'b' || conv_id AS bureau, role AS format, text AS title, conv_id AS identifier, CAST(conv_id AS VARCHAR) AS second_keyword, CASE WHEN conv_id % 3 = 0 THEN 'Name ' || conv_id END AS contact,
       CASE WHEN conv_id % 3 = 0 THEN conv_id / 4 END AS score, turn, CASE WHEN turn % 2 = 0 THEN strlen(text) END AS bytes
FROM conversations
""")
def q_catalog_extra(spark, sf):
    flat = flatten_open_catalog(read_open_catalog(spark, fx.open_catalog_json(spark, sf), multi_line=False))
    return flat.select(
        F.col("bureauCode").alias("bureau"), "format", "title", extra("identifier", "bigint", DATASET_EXTRA).alias("identifier"), extra("keyword[1]", "string", DATASET_EXTRA).alias("second_keyword"),
        extra("contactPoint.fn", "string", DATASET_EXTRA).alias("contact"), extra("contactPoint.rating.score", "double", DATASET_EXTRA).alias("score"),
        extra("turn", "bigint").alias("turn"), extra("byteSize", "bigint").alias("bytes"))


@query("catalog_extra_fields", """
SELECT 'dataset' AS level, 'identifier' AS field, 'BIGINT' AS type, count(*) AS n FROM conversations UNION ALL SELECT 'dataset', 'keyword', 'ARRAY<STRING>', count(*) FROM conversations
UNION ALL SELECT 'dataset', 'contactPoint', 'OBJECT', count(*) FROM conversations WHERE conv_id % 3 = 0 UNION ALL SELECT 'distribution', 'turn', 'BIGINT', count(*) FROM conversations
UNION ALL SELECT 'distribution', 'byteSize', 'BIGINT', count(*) FROM conversations WHERE turn % 2 = 0
""")
def q_catalog_extra_fields(spark, sf):
    flat = flatten_open_catalog(read_open_catalog(spark, fx.open_catalog_json(spark, sf), multi_line=False))
    return extra_fields(flat).withColumn("type", F.regexp_replace("type", "^OBJECT<.*", "OBJECT"))
