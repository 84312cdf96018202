"""Named queries: one per operator / job of the survey inventory, each with its DuckDB oracle.

Every query reads the driver's tables (or release files Spark writes from
them, see :mod:`relcast.queries.fixtures`) and returns a lazy DataFrame. The
oracle SQL states the expected clean result directly from the tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relcast.functions.filedates import title_file_name, url_file_name
from relcast.functions.headers import normalise_header, rename_legacy
from relcast.functions.identifiers import remap_ccn
from relcast.functions.parsing import (
    lenient_double,
    null_if,
    pad_id,
    parse_date_any,
    parse_double,
    parse_int,
)
from relcast.operators.categories import (
    apply_corrections,
    best_correction,
    corrections,
    resolve_chains,
    typo_candidates,
    vocab,
)
from relcast.operators.crosswalk import id_crosswalk
from relcast.operators.dedupe import distinct_rows, drop_marked_rows, explode_ids, latest_per_key
from relcast.operators.feeds import tag_feeds
from relcast.operators.releases import (
    PERIOD,
    latest_release,
    loaded_periods,
    missing_downloads,
    pending_files,
    with_provenance,
)
from relcast.operators.typed import apply_types
from relcast.plans.docs import column_docs
from relcast.plans.jobs import (
    clean_categories,
    discover,
    ingest_latest,
    ingest_periods,
    ingest_reference,
    ingest_snapshots,
    prepare,
    release_selection,
)
from relcast.plans.load import append_snapshots, replace_periods, write_full
from relcast.queries import fixtures as fx
from relcast.queries.oracle_sql import (
    ccn_remap_sql,
    dirty_word_sql,
    soundex_sql,
    synthetic_ccn_sql,
)
from relcast.session import materialise, scratch_path
from relcast.sources.catalog import flatten_catalog, read_catalog
from relcast.sources.csv import scan_csv, scan_csv_typed
from relcast.sources.files import list_releases, read_table
from relcast.spec import DateRule, SuffixTyping, TableSpec
from relcast.specs.downloads import DOWNLOADS
from relcast.specs.snapshots import GEO_DOUBLE_SUFFIXES, GEO_STRINGS

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql.strip()
        return fn

    return register


def t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return fx.table(spark, sf, name)


# Shared SQL pieces over the orders release fixture.
_YEAR = "year(o_orderdate)"
_CUST = "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_custkey END"
_NOTE = f"CASE WHEN {_YEAR} >= 1998 THEN 'note ' || CAST(o_orderkey % 7 AS VARCHAR) END"


def _order_file_sql(release: str) -> str:
    return (f"'ord_ry' || CAST({release} AS VARCHAR) || '_p01_dy' || CAST(y AS VARCHAR) || '_' "
            "|| CASE WHEN y >= 2000 THEN 'PROV' ELSE 'prov' END || '.csv'")


_ORDER_FILES_SQL = """
    WITH yrs AS (SELECT DISTINCT year(o_orderdate) AS y FROM orders),
    f AS (SELECT y, 2021 AS r FROM yrs UNION ALL SELECT y, 2020 AS r FROM yrs WHERE y % 2 = 1)
"""

# =========================================================== scans

@query("csv_scan", """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority
FROM orders
""")
def q_csv_scan(spark, sf):
    folder = fx.orders_csv_single(spark, sf)
    raw = scan_csv(spark, list_releases(spark, folder, ("orders_*.csv",)))
    spec = TableSpec(name="orders_csv", types={"o_orderkey": "bigint", "o_custkey": "bigint", "o_totalprice": "double",
                                               "o_orderdate": "date"},
                     date_formats={"o_orderdate": ("yyyy-MM-dd",)}, strip_money=False)
    return apply_types(raw, spec).drop("_file_path")


@query("csv_scan_latin1", "SELECT conv_id, turn, role, text FROM conversations")
def q_csv_scan_latin1(spark, sf):
    folder = fx.conversations_latin1(spark, sf)
    raw = scan_csv(spark, list_releases(spark, folder, ("conv_*.csv",)), encoding="ISO-8859-1", multi_line=True)
    spec = TableSpec(name="conv", types={"conv_id": "bigint", "turn": "bigint"}, strip_money=False)
    return apply_types(raw, spec).drop("_file_path")


@query("csv_scan_typed", "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def q_csv_scan_typed(spark, sf):
    folder = fx.part_csv(spark, sf)
    return scan_csv_typed(spark, list_releases(spark, folder, ("part_*.csv",)), fx.PART_SCHEMA).drop("_file_path")


# =========================================================== headers

@query("header_normalise", """
SELECT o_orderkey AS order_key, o_custkey AS custkey, o_orderstatus AS orderstatus, o_totalprice AS total_price,
       CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS order_priority_code
FROM orders
""")
def q_header_normalise(spark, sf):
    raw = t(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate"), "o_orderpriority"
    ).toDF("Order Key", "Cust.Key", "Order-Status", "Total Price", "Order Date", "Order Priority (Code)")
    return normalise_header(raw)


@query("legacy_rename", """
SELECT o_orderkey AS order_key, o_custkey AS custkey, o_totalprice AS total_price, o_orderstatus AS order_status,
       o_orderpriority AS order_priority
FROM orders
""")
def q_legacy_rename(spark, sf):
    raw = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority") \
        .toDF("ORDER KEY", "CUST KEY", "TOTL CHRG", "ORDER STATUS", "ORDR PRTY")
    df = normalise_header(raw, {"cust_key": "custkey", "totl_chrg": "total_price"})
    return rename_legacy(df, {"ordr_prty": "order_priority"})


@query("union_by_name", f"""
SELECT o_orderkey AS order_key, {_CUST} AS custkey, o_totalprice AS total_price, o_orderstatus AS order_status,
       CAST(o_orderdate AS DATE) AS order_date, o_orderpriority AS order_priority, {_NOTE} AS clerk_note
FROM orders
""")
def q_union_by_name(spark, sf):
    folder = fx.order_releases(spark, sf)
    files = list_releases(spark, folder, ("*ry2021*_prov.csv", "*ry2021*_PROV.csv"))
    df = apply_types(scan_csv(spark, files, fx.ORDERS_SPEC.renames), fx.ORDERS_SPEC)
    return df.select("order_key", "custkey", "total_price", "order_status", "order_date", "order_priority", "clerk_note")


# =========================================================== discovery

@query("list_releases", _ORDER_FILES_SQL + f"""
SELECT {_order_file_sql('r')} AS file_name, make_date(y, 12, 31) AS data_date, make_date(r, 12, 31) AS release_date,
       CASE WHEN y >= 2000 THEN 1 ELSE 0 END AS glob_rank
FROM f
""")
def q_list_releases(spark, sf):
    folder = fx.order_releases(spark, sf)
    files = discover(spark, fx.ORDERS_SPEC, folder)
    return files.select("file_name", "data_date", "release_date", "glob_rank")


@query("latest_release", _ORDER_FILES_SQL + f"""
SELECT make_date(y, 12, 31) AS data_date, {_order_file_sql('max(r)')} AS file_name, make_date(max(r), 12, 31) AS release_date
FROM f GROUP BY y
""")
def q_latest_release(spark, sf):
    folder = fx.order_releases(spark, sf)
    return latest_release(discover(spark, fx.ORDERS_SPEC, folder)).select("data_date", "file_name", "release_date")


@query("provenance", f"""
SELECT o_orderkey AS order_key, o_totalprice AS total_price, make_date({_YEAR}, 12, 31) AS _input_file_date,
       'ord_ry2021_p01_dy' || CAST({_YEAR} AS VARCHAR) || '_'
       || CASE WHEN {_YEAR} >= 2000 THEN 'PROV' ELSE 'prov' END || '.csv' AS _source_file_name
FROM orders
UNION ALL
SELECT o_orderkey, 0.0, make_date({_YEAR}, 12, 31), 'ord_ry2020_p01_dy' || CAST({_YEAR} AS VARCHAR) || '_'
       || CASE WHEN {_YEAR} >= 2000 THEN 'PROV' ELSE 'prov' END || '.csv'
FROM orders WHERE {_YEAR} % 2 = 1
""")
def q_provenance(spark, sf):
    folder = fx.order_releases(spark, sf)
    files = discover(spark, fx.ORDERS_SPEC, folder)
    typed = apply_types(scan_csv(spark, files, fx.ORDERS_SPEC.renames), fx.ORDERS_SPEC)
    return with_provenance(typed, fx.ORDERS_SPEC.file_date).select("order_key", "total_price", PERIOD, "_source_file_name")


def _loaded_orders(spark: SparkSession, sf: str) -> str:
    """A period table holding the periods of the older header vintage (the already-loaded state)."""

    def build(target: str) -> None:
        folder = fx.order_releases(spark, sf)
        files = latest_release(discover(spark, fx.ORDERS_SPEC, folder)).where(
            F.year("data_date") < fx.NEW_VINTAGE_FROM)
        replace_periods(prepare(spark, fx.ORDERS_SPEC, files), target)

    return fx.cached(spark, sf, "loaded_orders", build)


@query("pending_files", _ORDER_FILES_SQL + f"""
SELECT {_order_file_sql('r')} AS file_name, make_date(y, 12, 31) AS data_date FROM f WHERE y >= 1998
""")
def q_pending_files(spark, sf):
    folder = fx.order_releases(spark, sf)
    loaded = loaded_periods(spark, _loaded_orders(spark, sf))
    files = discover(spark, fx.ORDERS_SPEC, folder)
    return pending_files(files, loaded).select("file_name", "data_date")


@query("loaded_periods", """
SELECT DISTINCT make_date(year(o_orderdate), 12, 31) AS _input_file_date FROM orders WHERE year(o_orderdate) < 1998
""")
def q_loaded_periods(spark, sf):
    return loaded_periods(spark, _loaded_orders(spark, sf))


# =========================================================== load modes (K1-K4)

_PERIOD_AGG_SQL = f"""
SELECT make_date({_YEAR}, 12, 31) AS _input_file_date, count(*) AS n_rows,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_cents, count({_CUST}) AS n_custkey,
       count({_NOTE}) AS n_notes
FROM orders GROUP BY 1
"""


def _period_agg(df: DataFrame) -> DataFrame:
    return df.groupBy(PERIOD).agg(
        F.count("*").alias("n_rows"),
        F.sum(F.round(F.col("total_price") * 100).cast("bigint")).alias("total_cents"),
        F.count("custkey").alias("n_custkey"),
        F.count("clerk_note").alias("n_notes"),
    )


@query("period_replace", f"""
SELECT make_date({_YEAR}, 12, 31) AS _input_file_date, count(*) AS n_rows,
       CASE WHEN {_YEAR} % 2 = 1 THEN 0 ELSE CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) END AS total_cents
FROM orders GROUP BY {_YEAR}
""")
def q_period_replace(spark, sf):
    folder = fx.order_releases(spark, sf)
    target = scratch_path(spark, "period_replace")
    files = discover(spark, fx.ORDERS_SPEC, folder)
    replace_periods(prepare(spark, fx.ORDERS_SPEC, latest_release(files)), target)
    # Restate every period that has an older release: only those periods are rewritten.
    restated = files.where(F.col("release_date") < F.lit("2021-12-31").cast("date"))
    replace_periods(prepare(spark, fx.ORDERS_SPEC, restated), target)
    return read_table(spark, target).groupBy(PERIOD).agg(
        F.count("*").alias("n_rows"), F.sum(F.round(F.col("total_price") * 100).cast("bigint")).alias("total_cents"))


@query("snapshot_append", _PERIOD_AGG_SQL)
def q_snapshot_append(spark, sf):
    folder = fx.order_releases(spark, sf)
    target = scratch_path(spark, "snapshot_append")
    files = latest_release(discover(spark, fx.ORDERS_SPEC, folder))
    first = files.where(F.year("data_date") < fx.NEW_VINTAGE_FROM)
    append_snapshots(prepare(spark, fx.ORDERS_SPEC, first), target)
    for _ in range(2):  # second round finds nothing pending: appending is idempotent
        pending = materialise(pending_files(files, loaded_periods(spark, target)), "pending")
        if not pending.isEmpty():
            append_snapshots(prepare(spark, fx.ORDERS_SPEC, pending), target)
    return _period_agg(read_table(spark, target))


@query("schema_evolution", f"""
SELECT make_date({_YEAR}, 12, 31) AS _input_file_date, count(*) AS n_rows, count({_NOTE}) AS n_notes,
       bool_and(({_NOTE}) IS NULL) = ({_YEAR} < 1998) AS note_missing_before
FROM orders GROUP BY {_YEAR}
""")
def q_schema_evolution(spark, sf):
    folder = fx.order_releases(spark, sf)
    target = scratch_path(spark, "schema_evolution")
    files = latest_release(discover(spark, fx.ORDERS_SPEC, folder))
    old = prepare(spark, fx.ORDERS_SPEC, files.where(F.year("data_date") < fx.NEW_VINTAGE_FROM))
    assert "clerk_note" not in old.columns
    append_snapshots(old, target)
    append_snapshots(prepare(spark, fx.ORDERS_SPEC, files.where(F.year("data_date") >= fx.NEW_VINTAGE_FROM)), target)
    merged = read_table(spark, target)
    per = merged.groupBy(PERIOD).agg(
        F.count("*").alias("n_rows"), F.count("clerk_note").alias("n_notes"),
        F.bool_and(F.col("clerk_note").isNull()).alias("_all_null"))
    return per.select(PERIOD, "n_rows", "n_notes",
                      (F.col("_all_null") == (F.year(PERIOD) < fx.NEW_VINTAGE_FROM)).alias("note_missing_before"))


@query("full_replace", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders")
def q_full_replace(spark, sf):
    orders = t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    target = scratch_path(spark, "full_replace")
    # The table holds another state, partitioned; the partition "X" is not in the new data.
    stale = orders.where(F.col("o_orderstatus") == "F").withColumn("o_totalprice", F.lit(-1.0))
    write_full(stale.unionByName(stale.withColumn("o_orderstatus", F.lit("X"))), target, partition_by="o_orderstatus")
    write_full(orders, target, partition_by="o_orderstatus")
    return read_table(spark, target)


# =========================================================== typing

@query("money_parse", """
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
       CASE WHEN l_linenumber = 7 THEN NULL ELSE l_extendedprice END AS extendedprice,
       CAST(trunc(l_quantity + l_discount) AS INTEGER) AS quantity
FROM lineitem
""")
def q_money_parse(spark, sf):
    li = t(spark, sf, "lineitem")
    price_txt = F.when(F.col("l_linenumber") == 7, F.lit("n/a")).otherwise(
        F.concat(F.lit("$"), F.format_number("l_extendedprice", 2)))
    qty_txt = F.concat((F.col("l_quantity") + F.col("l_discount")).cast("string"), F.lit("%"))
    return li.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                     parse_double(price_txt).alias("extendedprice"), parse_int(qty_txt).alias("quantity"))


@query("suppression_null", """
SELECT event_id, CASE WHEN user_id % 10 IN (0, 1, 2) THEN NULL ELSE value END AS value,
       CASE WHEN user_id % 10 = 3 THEN NULL ELSE event_type END AS event_type
FROM events
""")
def q_suppression_null(spark, sf):
    ev = t(spark, sf, "events")
    bucket = F.col("user_id") % 10
    value_txt = (F.when(bucket == 0, F.lit("*")).when(bucket == 1, F.lit("NA")).when(bucket == 2, F.lit("N/A"))
                 .otherwise(F.col("value").cast("string")))
    type_txt = F.when(bucket == 3, F.lit("*")).otherwise(F.col("event_type"))
    markers = ("*", "NA", "N/A")
    return ev.select("event_id", lenient_double(null_if(value_txt, markers)).alias("value"),
                     null_if(type_txt, markers).alias("event_type"))


@query("suffix_typing", """
SELECT CAST(event_id AS INTEGER) AS event_id, event_type AS bene_geo_lvl,
       CASE WHEN user_id % 10 = 0 THEN NULL ELSE value END AS value_amt,
       value * 100 AS value_pct,
       CASE WHEN user_id % 10 = 1 THEN NULL ELSE CAST(user_id AS INTEGER) END AS user_cnt,
       CAST(year(ts) AS INTEGER) AS evt_year,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k_rate,
       CAST(ts AS DATE) AS event_date
FROM events
""")
def q_suffix_typing(spark, sf):
    ev = t(spark, sf, "events")
    bucket = F.col("user_id") % 10
    raw = ev.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type").alias("bene_geo_lvl"),
        F.when(bucket == 0, F.lit("*")).otherwise(F.col("value").cast("string")).alias("value_amt"),
        (F.col("value") * 100).cast("string").alias("value_pct"),
        F.when(bucket == 1, F.lit("NA")).otherwise(F.col("user_id").cast("string")).alias("user_cnt"),
        F.year("ts").cast("string").alias("evt_year"),
        F.get_json_object("props", "$.k").alias("k_rate"),
        F.date_format("ts", "MM/dd/yyyy").alias("event_date"),
    )
    spec = TableSpec(
        name="geo_like",
        suffix_typing=SuffixTyping(strings=GEO_STRINGS, double_suffixes=GEO_DOUBLE_SUFFIXES, default="int"),
        date_rules=(DateRule("suffix", "_date", ("MM/dd/yyyy",)),),
        markers=("*", "NA"),
        strip_money=False,
    )
    return apply_types(raw, spec)


@query("typed_columns", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_typed_columns(spark, sf):
    cu = t(spark, sf, "customer")
    raw = cu.select(
        F.col("c_custkey").cast("string").alias("c_custkey"), "c_name",
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.concat(F.lit("$"), F.format_number("c_acctbal", 2)).alias("c_acctbal"), "c_mktsegment",
    )
    spec = TableSpec(name="customer_typed", types={"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"})
    return apply_types(raw, spec)


DATE_FORMATS = ("MM/dd/yyyy", "M/d/yyyy", "MM/dd/yy", "yyyy-MM-dd")


@query("date_parse", """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 13 <> 0 THEN CAST(o_orderdate AS DATE) END AS order_date
FROM orders
""")
def q_date_parse(spark, sf):
    od = t(spark, sf, "orders")
    k = F.col("o_orderkey")
    txt = (F.when(k % 13 == 0, F.lit("TBD"))
           .when(k % 4 == 0, F.date_format("o_orderdate", "MM/dd/yyyy"))
           .when(k % 4 == 1, F.date_format("o_orderdate", "M/d/yyyy"))
           .when(k % 4 == 2, F.date_format("o_orderdate", "MM/dd/yy"))
           .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")))
    return od.select("o_orderkey", parse_date_any(txt, DATE_FORMATS).alias("order_date"))


@query("pad_identifier", "SELECT c_custkey, lpad(CAST(c_custkey AS VARCHAR), 6, '0') AS rndrng_prvdr_ccn FROM customer")
def q_pad_identifier(spark, sf):
    cu = t(spark, sf, "customer")
    return cu.select("c_custkey", pad_id(F.col("c_custkey").cast("string"), 6).alias("rndrng_prvdr_ccn"))


_LI_CCN_SQL = ("CASE WHEN l_linenumber = 1 AND l_orderkey % 5 = 0 THEN NULL "
               "WHEN l_linenumber = 2 AND l_orderkey % 5 = 0 THEN 'AB' "
               f"ELSE {synthetic_ccn_sql('l_suppkey % 60', 'l_orderkey + l_linenumber')} END")


@query("ccn_remap", f"""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ccn, {ccn_remap_sql('ccn')} AS ccn_remapped
FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_LI_CCN_SQL} AS ccn FROM lineitem)
""")
def q_ccn_remap(spark, sf):
    li = t(spark, sf, "lineitem")
    five = F.col("l_orderkey") % 5 == 0
    ccn = (F.when((F.col("l_linenumber") == 1) & five, F.lit(None))
           .when((F.col("l_linenumber") == 2) & five, F.lit("AB"))
           .otherwise(fx.synthetic_ccn(F.col("l_suppkey") % 60, F.col("l_orderkey") + F.col("l_linenumber"))))
    df = li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", ccn.alias("ccn"))
    return df.withColumn("ccn_remapped", remap_ccn("ccn"))


# =========================================================== filters, dedupe, lists

@query("malformed_filter", """
SELECT o_orderkey AS order_key, o_orderpriority || ' 17" wide, light, or ultralight' AS descr,
       CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE CAST(o_custkey AS INTEGER) END AS tot_suplrs
FROM orders WHERE o_orderkey % 17 <> 0
""")
def q_malformed_filter(spark, sf):
    folder = fx.broken_rows_csv(spark, sf)
    raw = scan_csv(spark, list_releases(spark, folder, ("*_prvhpr.csv",)))
    kept = drop_marked_rows(raw, "tot_suplrs", fx.BROKEN_MARKER)
    spec = TableSpec(name="dme_like", types={"order_key": "bigint", "tot_suplrs": "int"})
    return apply_types(kept, spec).drop("_file_path")


@query("explode_ids", """
SELECT DISTINCT p_partkey, w AS word
FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part WHERE p_partkey % 10 <> 0)
WHERE w <> ''
""")
def q_explode_ids(spark, sf):
    pa = t(spark, sf, "part")
    ids = (F.when(F.col("p_partkey") % 10 == 0, F.lit(None))
           .when(F.col("p_partkey") % 3 == 0, F.regexp_replace("p_name", " ", "  "))
           .otherwise(F.col("p_name")))
    df = pa.select("p_partkey", ids.alias("ids"))
    return distinct_rows(explode_ids(df, "ids", "word").select("p_partkey", "word"))


@query("distinct_rows", "SELECT DISTINCT l_orderkey, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def q_distinct_rows(spark, sf):
    return distinct_rows(t(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus"))


@query("latest_per_key", """
SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1
""")
def q_latest_per_key(spark, sf):
    ev = t(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest_per_key(ev, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", "value")


# =========================================================== categories

def dirty_word(name: str, key: str):
    n, k = F.col(name), F.col(key)
    rest = lambda start: F.substring(n, start, 1 << 20)
    return (F.when(k % 23 == 0, F.lit(None).cast("string"))
            .when(k % 17 == 0, F.concat(F.substring(n, 1, 2), rest(4)))
            .when(k % 17 == 1, F.concat(F.substring(n, 1, 1), F.substring(n, 3, 1), F.substring(n, 2, 1), rest(4)))
            .when(k % 17 == 2, F.concat(F.substring(n, 1, 4), rest(4)))
            .otherwise(n))


def _records(spark, sf) -> DataFrame:
    return t(spark, sf, "part").select(F.col("p_partkey").alias("npi"), dirty_word("p_name", "p_partkey").alias("specialty"))


_VOCAB_SQL = f"""
    rec AS (SELECT p_partkey AS npi, {dirty_word_sql('p_name', 'p_partkey')} AS specialty FROM part),
    vocab AS (SELECT specialty AS word, count(npi) AS n FROM rec WHERE specialty IS NOT NULL GROUP BY specialty),
    keyed AS (SELECT word, n, {soundex_sql('word')} AS pkey FROM vocab),
    cand AS (SELECT a.word AS a, b.word AS b, a.n AS n_a, b.n AS n_b FROM keyed a JOIN keyed b
             ON a.pkey = b.pkey AND a.n > b.n AND damerau_levenshtein(a.word, b.word) < 3),
    best AS (SELECT b, a FROM (SELECT b, a, row_number() OVER (PARTITION BY b ORDER BY n_a DESC, a) AS rn FROM cand)
             WHERE rn = 1),
    chain AS (SELECT b, a FROM best UNION ALL SELECT c.b, best.a FROM chain c JOIN best ON c.a = best.b),
    fixes AS (SELECT b AS word, a AS correction FROM chain WHERE a NOT IN (SELECT b FROM best))
"""


@query("vocab_counts", f"WITH {_VOCAB_SQL} SELECT word, n FROM vocab")
def q_vocab_counts(spark, sf):
    return vocab(_records(spark, sf), "specialty", "npi")


@query("typo_candidates", f"WITH {_VOCAB_SQL} SELECT a, b, n_a, n_b FROM cand")
def q_typo_candidates(spark, sf):
    return typo_candidates(vocab(_records(spark, sf), "specialty", "npi"))


@query("typo_corrections", f"WITH RECURSIVE {_VOCAB_SQL} SELECT word, correction FROM fixes")
def q_typo_corrections(spark, sf):
    fixes = resolve_chains(best_correction(typo_candidates(vocab(_records(spark, sf), "specialty", "npi"))))
    return fixes.select(F.col("b").alias("word"), F.col("a").alias("correction"))


@query("apply_corrections", f"""
WITH RECURSIVE {_VOCAB_SQL}
SELECT rec.npi, coalesce(fixes.correction, rec.specialty) AS specialty FROM rec LEFT JOIN fixes ON rec.specialty = fixes.word
""")
def q_apply_corrections(spark, sf):
    rec = _records(spark, sf)
    return apply_corrections(rec, "specialty", corrections(rec, "specialty", "npi"))


def _optout_records(spark, sf) -> DataFrame:
    """Two monthly files of (npi, specialty, dates); some npis appear twice in a month with an older update."""
    pa = t(spark, sf, "part")
    month = F.make_date(F.lit(2024), (F.col("p_size") % 2 + 1).cast("int"), F.lit(1))
    base = pa.select(
        F.col("p_partkey").alias("npi"), dirty_word("p_name", "p_partkey").alias("specialty"),
        F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")).alias("last_updated"),
        F.lit("2026-01-01").cast("date").alias("optout_end_date"), month.alias(PERIOD))
    older = pa.where(F.col("p_partkey") % 5 == 0).select(
        F.col("p_partkey").alias("npi"), F.concat(F.lit("OLD "), F.col("p_name")).alias("specialty"),
        F.lit("2023-06-01").cast("date").alias("last_updated"),
        F.lit(None).cast("date").alias("optout_end_date"), month.alias(PERIOD))
    return base.unionByName(older)


@query("clean_categories", f"""
WITH RECURSIVE
    rec AS (SELECT p_partkey AS npi, {dirty_word_sql('p_name', 'p_partkey')} AS specialty,
                   DATE '2024-01-01' + CAST(p_size AS INTEGER) AS last_updated,
                   make_date(2024, CAST(p_size % 2 + 1 AS INTEGER), 1) AS _input_file_date FROM part),
    vocab AS (SELECT specialty AS word, count(npi) AS n FROM rec WHERE specialty IS NOT NULL GROUP BY specialty),
    keyed AS (SELECT word, n, {soundex_sql('word')} AS pkey FROM vocab),
    cand AS (SELECT a.word AS a, b.word AS b, a.n AS n_a, b.n AS n_b FROM keyed a JOIN keyed b
             ON a.pkey = b.pkey AND a.n > b.n AND damerau_levenshtein(a.word, b.word) < 3),
    best AS (SELECT b, a FROM (SELECT b, a, row_number() OVER (PARTITION BY b ORDER BY n_a DESC, a) AS rn FROM cand)
             WHERE rn = 1),
    chain AS (SELECT b, a FROM best UNION ALL SELECT c.b, best.a FROM chain c JOIN best ON c.a = best.b),
    fixes AS (SELECT b AS word, a AS correction FROM chain WHERE a NOT IN (SELECT b FROM best))
SELECT rec.npi, coalesce(fixes.correction, rec.specialty) AS specialty, rec.last_updated,
       DATE '2026-01-01' AS optout_end_date, rec._input_file_date
FROM rec LEFT JOIN fixes ON rec.specialty = fixes.word
""")
def q_clean_categories(spark, sf):
    rec = _optout_records(spark, sf)
    return clean_categories(rec, "specialty", "npi", ["last_updated", "optout_end_date"])


def _long_records(spark, sf) -> DataFrame:
    """Long category strings (over 32 characters) with the same typo generator."""
    pa = t(spark, sf, "part").withColumn("_long", F.concat_ws(" ", "p_name", "p_type", F.lit("of the standard catalogue")))
    return pa.select(F.col("p_partkey").alias("npi"), dirty_word("_long", "p_partkey").alias("specialty"))


@query("typo_candidates_long", f"""
WITH rec AS (SELECT p_partkey AS npi, {dirty_word_sql("(p_name || ' ' || p_type || ' of the standard catalogue')", 'p_partkey')} AS specialty FROM part),
    vocab AS (SELECT specialty AS word, count(npi) AS n FROM rec WHERE specialty IS NOT NULL GROUP BY specialty),
    keyed AS (SELECT word, n, {soundex_sql('word')} AS pkey FROM vocab)
SELECT a.word AS a, b.word AS b, a.n AS n_a, b.n AS n_b FROM keyed a JOIN keyed b
  ON a.pkey = b.pkey AND a.n > b.n AND damerau_levenshtein(a.word, b.word) < 3
""")
def q_typo_candidates_long(spark, sf):
    """Candidate search on long words."""
    return typo_candidates(vocab(_long_records(spark, sf), "specialty", "npi"))


_STEM_SQL = "'certified registered ' || left(md5(CAST(o_custkey AS VARCHAR)), 10)"


@query("typo_candidates_prefix", f"""
WITH rec AS (SELECT o_orderkey AS npi, CASE WHEN o_orderkey % 19 = 0 THEN left({_STEM_SQL}, 30) WHEN o_orderkey % 19 = 1 THEN {_STEM_SQL} || 'x'
                    WHEN o_orderkey % 19 = 2 THEN left({_STEM_SQL}, 22) || substr({_STEM_SQL}, 24, 1) || substr({_STEM_SQL}, 23, 1) || substr({_STEM_SQL}, 25) ELSE {_STEM_SQL} END AS specialty FROM orders),
    keyed AS (SELECT specialty AS word, count(npi) AS n, {soundex_sql('specialty')} AS pkey FROM rec GROUP BY specialty)
SELECT a.word AS a, b.word AS b, a.n AS n_a, b.n AS n_b FROM keyed a JOIN keyed b
  ON a.pkey = b.pkey AND a.n > b.n AND levenshtein(a.word, b.word) <= 4 AND damerau_levenshtein(a.word, b.word) < 3
""")
def q_typo_candidates_prefix(spark, sf):
    """Candidate search in a vocabulary whose words all share their first 21 characters."""
    k = F.col("o_orderkey")
    stem = F.concat(F.lit("certified registered "), F.left(F.md5(F.col("o_custkey").cast("string").cast("binary")), F.lit(10)))
    swapped = F.concat(F.substring(stem, 1, 22), F.substring(stem, 24, 1), F.substring(stem, 23, 1), F.substring(stem, 25, 100))
    word = F.when(k % 19 == 0, F.substring(stem, 1, 30)).when(k % 19 == 1, F.concat(stem, F.lit("x"))).when(k % 19 == 2, swapped).otherwise(stem)
    return typo_candidates(vocab(t(spark, sf, "orders").select(k.alias("npi"), word.alias("specialty")), "specialty", "npi"))


# =========================================================== crosswalk

# Order priorities standing in for the facility-type tables.
PRIORITY_TYPES = {"1-URGENT": "urgent", "2-HIGH": "high", "3-MEDIUM": "medium", "4-NOT SPECIFIED": "not specified",
                  "5-LOW": "low"}


@query("id_crosswalk", """
WITH tt AS (SELECT lower(substr(o_orderpriority, 3)) AS facility_type, o_custkey AS npi,
                   o_orderstatus || CAST(o_custkey % 7 AS VARCHAR) AS other_id,
                   CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE 'ST' || CAST(o_orderkey % 4 AS VARCHAR) END AS state,
                   CAST(o_orderdate AS DATE) AS d
            FROM orders),
g AS (SELECT facility_type, npi, other_id, min(d) AS other_id_dt_s, max(d) AS other_id_dt_e,
             first(state ORDER BY d, state NULLS LAST) AS other_id_state
      FROM tt GROUP BY facility_type, npi, other_id)
SELECT npi,
       concat_ws('^', other_id, '06', coalesce(other_id_state, ''), 'MEDICARE', 'CCN', CAST(other_id_dt_s AS VARCHAR),
                 CAST(other_id_dt_e AS VARCHAR)) AS other_id_token,
       other_id, '06' AS other_id_type_code, other_id_state, 'MEDICARE' AS other_id_issuer, 'CCN' AS other_id_type_desc,
       other_id_dt_s, other_id_dt_e, facility_type
FROM g
""")
def q_id_crosswalk(spark, sf):
    orders = t(spark, sf, "orders")
    tables = {}
    for priority, ftype in PRIORITY_TYPES.items():
        tables[ftype] = orders.where(F.col("o_orderpriority") == priority).select(
            F.col("o_custkey").alias("npi"),
            F.concat(F.col("o_orderstatus"), (F.col("o_custkey") % 7).cast("string")).alias("ccn"),
            F.when(F.col("o_orderkey") % 9 == 0, F.lit(None)).otherwise(
                F.concat(F.lit("ST"), (F.col("o_orderkey") % 4).cast("string"))).alias("state"),
            F.to_date("o_orderdate").alias(PERIOD))
    return id_crosswalk(tables)


# =========================================================== catalogue and release selection

_CATALOG_SQL = """
SELECT 'public' AS accessLevel, 'b' || CAST(conv_id AS VARCHAR) AS bureauCode,
       CASE WHEN conv_id % 3 = 0 THEN 'R/P1W' ELSE '' END AS accrualPeriodicity, '' AS describedBy,
       'conversation ' || CAST(conv_id AS VARCHAR) AS description, role AS format,
       'https://data.example.org/c/' || CAST(conv_id AS VARCHAR) || '/conv' || CAST(conv_id AS VARCHAR) || '_turn_'
           || CAST(turn AS VARCHAR) || '.csv' AS downloadURL,
       '' AS accessURL,
       CASE WHEN role = 'assistant' THEN 'text/csv' WHEN role = 'user' THEN 'application/json' ELSE '' END AS mediaType,
       text AS title, CAST(turn AS VARCHAR) AS modified, '' AS temporal
FROM conversations WHERE conv_id % 10 <> 0
"""


@query("catalog_flatten", _CATALOG_SQL)
def q_catalog_flatten(spark, sf):
    return flatten_catalog(read_catalog(spark, fx.catalog_json(spark, sf), multi_line=False))


# Feed phrases used against the documents table.
DOC_FEEDS = {"alpha": "the", "beta": "worth", "gamma": "ation", "delta": "@"}


@query("catalog_select", """
SELECT doc_id, f.feed FROM documents
JOIN (VALUES ('alpha', 'the'), ('beta', 'worth'), ('gamma', 'ation'), ('delta', '@')) f(feed, phrase)
  ON contains(text, f.phrase)
WHERE lang = 'en'
""")
def q_catalog_select(spark, sf):
    docs = t(spark, sf, "documents").where(F.col("lang") == "en").select("doc_id", "text")
    return tag_feeds(docs, DOC_FEEDS, text_col="text").select("doc_id", "feed")


_WORD_CLASS = r"[^\p{L}\p{Nd}\p{Mn}\p{Mc}\p{Me}\p{Pc}]+"


@query("release_names", f"""
SELECT page_id, regexp_extract(url, '[^/]*$') AS url_name,
       regexp_replace(lower(regexp_extract(html, '<title>(.*?)</title>', 1)), '{_WORD_CLASS}', '', 'g') || '.csv' AS title_name
FROM pages
""")
def q_release_names(spark, sf):
    pg = t(spark, sf, "pages")
    title = F.regexp_extract("html", "<title>(.*?)</title>", 1)
    return pg.select("page_id", url_file_name("url").alias("url_name"), title_file_name(title).alias("title_name"))


@query("missing_releases", """
SELECT page_id, regexp_extract(url, '[^/]*$') AS file_name FROM pages p
WHERE NOT EXISTS (SELECT 1 FROM pages q WHERE q.url LIKE 'https://%'
                  AND regexp_extract(q.url, '[^/]*$') = regexp_extract(p.url, '[^/]*$'))
""")
def q_missing_releases(spark, sf):
    pg = t(spark, sf, "pages")
    wanted = pg.select("page_id", url_file_name("url").alias("file_name"))
    # Files already fetched: those published over https.
    present = pg.where(F.col("url").startswith("https://")).select(url_file_name("url").alias("file_name"))
    return missing_downloads(wanted, present, "file_name")


_PHRASES_SQL = """
  (0, 'mupphy', 'Medicare Physician & Other Practitioners - by'), (1, 'mupdpr', 'Medicare Part D Prescribers - by'),
  (2, 'mupdme', 'Medicare Durable Medical Equipment, Devices & Supplies - by'), (3, 'reval', 'Revalidation Reassignment List'),
  (4, 'reval', 'Revalidation Clinic Group Practice Reassignment'), (5, 'optout', 'Opt Out Affidavits'),
  (6, 'mupohp', 'Medicare Outpatient Hospitals - by'), (7, 'muppac', 'Medicare Post-Acute Care and Hospice - by'),
  (8, 'mupihp', 'Medicare Inpatient Hospitals - by'), (9, 'geovariation', 'Medicare Geographic Variation'),
  (10, 'covid19nursinghomes', 'COVID-19 Nursing Home Data'), (11, 'orderandreferring', 'Order and Referring'),
  (12, 'pendingilt', 'Pending Initial Logging'), (13, 'otpp', 'Opioid Treatment Program Providers'),
  (14, 'betos', 'Restructured BETOS Classification System'), (15, 'pc_hospital', 'Hospital Enrollments'),
  (16, 'pc_hospice', 'Hospice Enrollments'), (17, 'pc_homehealth', 'Home Health Agency Enrollments'),
  (18, 'pc_fqhc', 'Federally Qualified Health Center Enrollments'), (19, 'pc_ruralhealthclinic', 'Rural Health Clinic Enrollments'),
  (20, 'pc_snf', 'Skilled Nursing Facility Enrollments'), (21, 'pc_provider', 'Medicare Fee-For-Service Public Provider Enrollment'),
  (22, 'pc_hospital_owner', 'Hospital All Owners'), (23, 'pc_hospice_owner', 'Hospice All Owners'),
  (24, 'pc_homehealth_owner', 'Home Health Agency All Owners'), (25, 'pc_fqhc_owner', 'Federally Qualified Health Center All Owners'),
  (26, 'pc_ruralhealthclinic_owner', 'Rural Health Clinic All Owners'), (27, 'pc_snf_owner', 'Skilled Nursing Facility All Owners')
"""


@query("release_selection", f"""
WITH feeds(k, folder, phrase) AS (VALUES {_PHRASES_SQL}),
cat AS (SELECT c.downloadURL, CAST(c.modified AS INTEGER) AS turn, f.k, f.folder,
               'New: ' || f.phrase || ' Part ' || CAST(CAST(c.modified AS INTEGER) // 2 AS VARCHAR) AS title
        FROM ({_CATALOG_SQL}) c JOIN feeds f
          ON f.k = (CAST(regexp_extract(c.description, '[0-9]+') AS BIGINT) + CAST(c.modified AS BIGINT)) % 28
        WHERE c.mediaType = 'text/csv'),
named AS (SELECT folder, downloadURL, title, turn,
            CASE WHEN k = 10 THEN 'covid19_nursing_home_data_2024-01-05.csv' WHEN k = 14 THEN 'rbcs_2023_taxonomy.csv'
                 WHEN k IN (3, 4) THEN regexp_replace(lower(title), '[^a-z0-9_]', '', 'g') || '.csv'
                 ELSE regexp_extract(downloadURL, '[^/]*$') END AS file_name
          FROM cat)
SELECT folder, file_name, min(downloadURL) AS downloadURL FROM named
WHERE NOT (folder = 'mupphy' AND turn <= 1) GROUP BY folder, file_name
""")
def q_release_selection(spark, sf):
    """The declared feed table over catalogue rows whose titles name the feeds in turn."""
    cat = flatten_catalog(read_catalog(spark, fx.catalog_json(spark, sf), multi_line=False))
    number = F.regexp_extract("description", "[0-9]+", 0).cast("long") + F.col("modified").cast("long")
    phrases = F.array(*[F.lit(d.phrase) for d in DOWNLOADS])
    title = F.concat(F.lit("New: "), F.element_at(phrases, (number % len(DOWNLOADS) + 1).cast("int")), F.lit(" Part "),
                     F.floor(F.col("modified").cast("int") / 2).cast("string"))
    conv = t(spark, sf, "conversations")
    # Files already fetched: the first two turns of every conversation, in one folder.
    present = conv.where(F.col("turn") <= 1).select(
        F.lit("mupphy").alias("folder"),
        F.concat(F.lit("conv"), F.col("conv_id").cast("string"), F.lit("_turn_"), F.col("turn").cast("string"),
                 F.lit(".csv")).alias("file_name"))
    plan = release_selection(cat.withColumns({"title": title, "modified": F.lit("")}), DOWNLOADS, present, as_of="2024-01-05")
    return plan.select("folder", "file_name", "downloadURL")


# =========================================================== end-to-end jobs

@query("ingest_periods", _PERIOD_AGG_SQL)
def q_ingest_periods(spark, sf):
    folder = fx.order_releases(spark, sf)
    table = ingest_periods(spark, fx.ORDERS_SPEC, folder, scratch_path(spark, "ingest_periods"))
    return _period_agg(table)


_SEGMENT_DATE_SQL = ("CASE c_mktsegment WHEN 'AUTOMOBILE' THEN DATE '2024-01-05' WHEN 'BUILDING' THEN DATE '2024-02-05' "
                     "WHEN 'FURNITURE' THEN DATE '2024-03-05' WHEN 'HOUSEHOLD' THEN DATE '2024-04-05' "
                     "ELSE DATE '2022-11-30' END")
_CUST_CCN_SQL = ("CASE WHEN c_custkey % 29 = 0 THEN NULL WHEN c_custkey % 31 = 0 THEN 'AB' "
                 f"ELSE {synthetic_ccn_sql('c_nationkey', 'c_custkey')} END")


@query("ingest_snapshots", f"""
SELECT npi, ccn, state, acct_bal, enroll_date, legal_name, {ccn_remap_sql('ccn')} AS ccn_remapped, _input_file_date
FROM (SELECT c_custkey AS npi, {_CUST_CCN_SQL} AS ccn, 'S' || CAST(c_nationkey AS VARCHAR) AS state,
             c_acctbal AS acct_bal,
             make_date(2020, CAST(c_custkey % 12 + 1 AS INTEGER), CAST(c_custkey % 28 + 1 AS INTEGER)) AS enroll_date,
             c_name || ' Société' AS legal_name, {_SEGMENT_DATE_SQL} AS _input_file_date
      FROM customer)
""")
def q_ingest_snapshots(spark, sf):
    spec = fx.ENROLMENT_SPEC
    folder = fx.enrolment_snapshots(spark, sf)
    target = scratch_path(spark, "ingest_snapshots")
    # The table already holds the earliest periods ...
    early = discover(spark, spec, folder).where(F.col("data_date") < F.lit("2024-02-01").cast("date"))
    append_snapshots(prepare(spark, spec, early), target)
    # ... and the job adds only the pending ones (twice: the second run is a no-op).
    ingest_snapshots(spark, spec, folder, target)
    table = ingest_snapshots(spark, spec, folder, target)
    return table.select("npi", "ccn", "state", "acct_bal", "enroll_date", "legal_name", "ccn_remapped", PERIOD)


@query("latest_snapshot", """
SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS event_day, CAST(ts AS DATE) AS _input_file_date
FROM events WHERE CAST(ts AS DATE) = (SELECT max(CAST(ts AS DATE)) FROM events)
""")
def q_latest_snapshot(spark, sf):
    folder = fx.event_snapshots(spark, sf)
    table = ingest_latest(spark, fx.EVENTS_SPEC, folder, scratch_path(spark, "latest_snapshot"))
    return table.select("event_id", "user_id", "event_type", "value", "event_day", PERIOD)


_TAXONOMY_SQL = """
SELECT p_partkey AS hcpcs_cd, p_brand AS rbcs_id, p_type AS rbcs_cat_desc, p_name AS rbcs_family_desc,
       CASE WHEN p_partkey % 13 = 0 THEN NULL
            ELSE make_date(CAST(2010 + p_partkey % 10 AS INTEGER), CAST(p_partkey % 12 + 1 AS INTEGER),
                           CAST(p_partkey % 28 + 1 AS INTEGER)) END AS hcpcs_cd_add_dt,
       CAST(NULL AS DATE) AS hcpcs_cd_end_dt, p_retailprice AS rbcs_price,
       make_date(CAST(2019 + p_size % 5 AS INTEGER), 12, 31) AS _input_file_date
FROM part
"""


@query("ingest_reference", _TAXONOMY_SQL)
def q_ingest_reference(spark, sf):
    folder = fx.taxonomy_files(spark, sf)
    return ingest_reference(spark, fx.TAXONOMY_SPEC, folder, scratch_path(spark, "ingest_reference"))


@query("table_docs", """
SELECT * FROM (VALUES
  ('hcpcs_cd', 'bigint', 'service code'), ('rbcs_id', 'string', NULL), ('rbcs_cat_desc', 'string', 'category'),
  ('rbcs_family_desc', 'string', NULL), ('hcpcs_cd_add_dt', 'date', 'date the code was added'),
  ('hcpcs_cd_end_dt', 'date', NULL), ('rbcs_price', 'double', NULL), ('_input_file_date', 'date', NULL),
  ('<table>', '', 'Service-code taxonomy per year')
) AS v(col_name, data_type, comment)
WHERE (SELECT count(*) FROM part) > 0
""")
def q_table_docs(spark, sf):
    spec = fx.TAXONOMY_SPEC
    folder = fx.taxonomy_files(spark, sf)
    path = scratch_path(spark, "table_docs")
    name = "taxonomy_" + path.rsplit("-", 1)[-1]
    ingest_reference(spark, spec, folder, path, table_name=name)
    cols = column_docs(spark, name).select("col_name", "data_type", "comment")
    table_comment = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Comment'").select(
        F.lit("<table>").alias("col_name"), F.lit("").alias("data_type"), F.col("data_type").alias("comment"))
    return cols.unionByName(table_comment)


# =========================================================== streaming (ST)

@query("stream_snapshots", _PERIOD_AGG_SQL)
def q_stream_snapshots(spark, sf):
    """File-source stream over the whole folder, stale releases included, in small batches;
    a second run with the same checkpoint finds nothing new."""
    from relcast.streaming.file_ingest import stream_ingest

    folder = fx.order_releases(spark, sf)
    target = scratch_path(spark, "stream_snapshots")
    for _ in range(2):
        q = stream_ingest(spark, fx.ORDERS_SPEC, folder, target, max_files=6)
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return _period_agg(read_table(spark, target))


# The queries of further operators register themselves.
from relcast.queries import analysis  # noqa: E402, F401
