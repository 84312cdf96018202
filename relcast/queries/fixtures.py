"""Release-file fixtures derived from the driver's tables.

The queries need raw releases (messy CSV with drifting headers, catalogue
JSON, dated file names). These are written by Spark from the given parquet
tables into the session's shared scratch folder, once per session and data
directory, and then read back by the operators under test — so the work of
every query grows with the tables.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relcast.session import scratch_path
from relcast.spec import DateRule, TableSpec

_LOCK = threading.RLock()
_CACHE: dict[tuple, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def cached(spark: SparkSession, sf_dir: str, key: str, build) -> str:
    """Build a fixture folder once per (application, data dir, key)."""
    k = (spark.sparkContext.applicationId, sf_dir, key)
    with _LOCK:
        path = _CACHE.get(k)
        if path is None or not _exists(spark, path):
            path = scratch_path(spark, key)
            build(path)
            _CACHE[k] = path
        return path


def write_named_csv(spark: SparkSession, df: DataFrame, folder: str, name_col: str, encoding: str = "UTF-8") -> None:
    """One CSV file per value of ``name_col``, named by that value, with a header line.

    Spark writes one partition folder per name (rows of a name go to one task),
    then each part file is renamed into ``folder`` through the Hadoop file system.
    """
    tmp = f"{folder}/_staging_{uuid.uuid4().hex[:8]}"
    (df.repartition(name_col).write.partitionBy(name_col)
     .option("header", "true").option("escape", '"').option("quoteAll", "false")
     .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
     .option("encoding", encoding).csv(tmp))
    jvm = spark.sparkContext._jvm
    Path = jvm.org.apache.hadoop.fs.Path
    fs = Path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(Path(tmp)):
        part_dir = status.getPath()
        if not status.isDirectory() or "=" not in part_dir.getName():
            continue
        name = part_dir.getName().split("=", 1)[1]
        parts = [s.getPath() for s in fs.listStatus(part_dir) if s.getPath().getName().startswith("part-")]
        if len(parts) != 1:
            raise RuntimeError(f"expected one part file for {name}, got {len(parts)}")
        fs.rename(parts[0], Path(f"{folder}/{name}"))
    fs.delete(Path(tmp), True)


#: Rows of a staged file where nothing asks for one file per name.
STAGED_ROWS = 50_000


def dealt_name(df: DataFrame, stem: Column, *keys: str) -> Column:
    """``<stem>_<k>.csv``: names are dealt out over a number of files that grows with the rows, so Spark writes and reads them in parallel."""
    parts = max(1, -(-df.count() // STAGED_ROWS))
    return F.concat(stem, F.lit("_"), F.pmod(F.xxhash64(*keys), F.lit(parts)).cast("string"), F.lit(".csv"))


# ---------------------------------------------------------------- orders releases

ORDER_MARKER = "*"
NEW_VINTAGE_FROM = 1998
UPPER_SUFFIX_FROM = 2000
CURRENT_RELEASE = 2021
STALE_RELEASE = 2020

ORDERS_SPEC = TableSpec(
    name="orders_releases",
    globs=("*_prov.csv", "*_PROV.csv"),
    file_date="data_year",
    release="release_year",
    load="period",
    renames={"cust_key": "custkey", "totl_chrg": "total_price"},
    types={"order_key": "bigint", "custkey": "bigint", "total_price": "double", "order_date": "date"},
    date_formats={"order_date": ("MM/dd/yyyy",)},
    markers=(ORDER_MARKER,),
    source_name=True,
)


def order_file_name(year: Column, release: int) -> Column:
    suffix = F.when(year >= UPPER_SUFFIX_FROM, F.lit("PROV")).otherwise(F.lit("prov"))
    return F.concat(F.lit(f"ord_ry{release}_p01_dy"), year.cast("string"), F.lit("_"), suffix, F.lit(".csv"))


def _order_rows(orders: DataFrame, release: int, stale: bool) -> tuple[DataFrame, DataFrame]:
    year = F.year("o_orderdate")
    money = F.format_number("o_totalprice", 2)
    cust = F.when(F.col("o_orderkey") % 11 == 0, F.lit(ORDER_MARKER)).otherwise(F.col("o_custkey").cast("string"))
    total_new = F.lit("0") if stale else F.concat(F.lit("$"), money)
    total_old = F.lit("0") if stale else money
    src = orders if not stale else orders.where(year % 2 == 1)
    base = src.withColumn("_y", year).withColumn("_file", order_file_name(year, release))
    old = base.where(F.col("_y") < NEW_VINTAGE_FROM).select(
        F.col("o_orderkey").cast("string").alias("ORDER KEY"),
        cust.alias("CUST KEY"),
        total_old.alias("TOTL CHRG"),
        F.col("o_orderstatus").alias("ORDER STATUS"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("ORDER DATE"),
        F.col("o_orderpriority").alias("ORDER PRIORITY"),
        "_file",
    )
    new = base.where(F.col("_y") >= NEW_VINTAGE_FROM).select(
        F.col("o_orderkey").cast("string").alias("Order Key"),
        F.date_format("o_orderdate", "MM/dd/yyyy").alias("Order Date"),
        cust.alias("Cust-Key"),
        total_new.alias("Total Price$"),
        F.col("o_orderstatus").alias("Order Status"),
        F.col("o_orderpriority").alias("Order Priority"),
        F.concat(F.lit("note "), (F.col("o_orderkey") % 7).cast("string")).alias("Clerk Note"),
        "_file",
    )
    return old, new


def order_releases(spark: SparkSession, sf_dir: str) -> str:
    """Orders by year as release files: two header vintages, money text, a
    suppression marker, a renamed column, and for odd years an older stale
    release (all totals 0) that release selection must skip."""

    def build(folder: str) -> None:
        orders = table(spark, sf_dir, "orders")
        for release, stale in ((CURRENT_RELEASE, False), (STALE_RELEASE, True)):
            for part in _order_rows(orders, release, stale):
                write_named_csv(spark, part, folder, "_file")

    return cached(spark, sf_dir, "order_releases", build)


# ---------------------------------------------------------------- daily event snapshots

EVENTS_SPEC = TableSpec(
    name="event_snapshots",
    globs=("events_snapshot_*.csv",),
    file_date="last_token_iso",
    load="latest",
    types={"event_id": "bigint", "user_id": "bigint", "value": "double", "event_day": "date"},
    date_formats={"event_day": ("MM/dd/yy",)},
)


def event_snapshots(spark: SparkSession, sf_dir: str) -> str:
    def build(folder: str) -> None:
        ev = table(spark, sf_dir, "events")
        day = F.to_date("ts")
        rows = ev.select(
            F.col("event_id").cast("string").alias("Event ID"),
            F.col("user_id").cast("string").alias("User ID"),
            F.col("event_type").alias("Event Type"),
            F.col("value").cast("string").alias("Value"),
            F.date_format(day, "MM/dd/yy").alias("Event Day"),
            F.concat(F.lit("events_snapshot_"), F.date_format(day, "yyyy-MM-dd"), F.lit(".csv")).alias("_file"),
        )
        write_named_csv(spark, rows, folder, "_file")

    return cached(spark, sf_dir, "event_snapshots", build)


# ---------------------------------------------------------------- plain table dumps

def orders_csv_single(spark: SparkSession, sf_dir: str) -> str:
    """All orders in one header vintage (for the plain scan)."""

    def build(folder: str) -> None:
        orders = table(spark, sf_dir, "orders")
        rows = orders.select(
            F.col("o_orderkey").cast("string").alias("O OrderKey"),
            F.col("o_custkey").cast("string").alias("O CustKey"),
            F.col("o_orderstatus").alias("O OrderStatus"),
            F.col("o_totalprice").cast("string").alias("O TotalPrice"),
            F.date_format("o_orderdate", "yyyy-MM-dd").alias("O OrderDate"),
            F.col("o_orderpriority").alias("O OrderPriority"),
            dealt_name(orders, F.concat(F.lit("orders_"), F.year("o_orderdate").cast("string")), "o_orderkey").alias("_file"),
        )
        write_named_csv(spark, rows, folder, "_file")

    return cached(spark, sf_dir, "orders_csv", build)


def dated_orders(spark: SparkSession, sf_dir: str) -> str:
    """Orders with the same date in several notations, padded codes and blanks (for type inference)."""

    def build(folder: str) -> None:
        orders = table(spark, sf_dir, "orders")
        key, day = F.col("o_orderkey"), F.col("o_orderdate")
        rows = orders.select(
            key.cast("string").alias("O OrderKey"),
            F.when(key % 10 != 0, (F.col("o_custkey") / 2).cast("string")).otherwise(F.when(key % 20 == 0, F.lit("NA"))).alias("Half"),
            F.date_format(day, "yyyy-MM-dd").alias("Iso"),
            F.date_format(day, "d/M/yyyy").alias("Day First"),
            F.when(key % 2 == 0, F.date_format(day, "MM/dd/yyyy")).otherwise(F.date_format(day, "M/d/yyyy")).alias("Month First"),
            F.date_format(day, "M/d/yy").alias("Short"),
            F.lpad((key % 1000).cast("string"), 6, "0").alias("Code"),
            F.when(key % 2 == 0, F.lit("True")).otherwise(F.lit("False")).alias("Even"),
            dealt_name(orders, F.concat(F.lit("dated_"), F.year(day).cast("string")), "o_orderkey").alias("_file"),
        )
        write_named_csv(spark, rows, folder, "_file")

    return cached(spark, sf_dir, "dated_orders", build)


def conversations_latin1(spark: SparkSession, sf_dir: str) -> str:
    """Conversations (multi-line accented text) as ISO-8859-1 CSV, files by role."""

    def build(folder: str) -> None:
        conv = table(spark, sf_dir, "conversations")
        rows = conv.select(
            F.col("conv_id").cast("string").alias("Conv Id"),
            F.col("turn").cast("string").alias("Turn"),
            F.col("role").alias("Role"),
            F.col("text").alias("Text"),
            dealt_name(conv, F.concat(F.lit("conv_"), F.col("role")), "conv_id", "turn").alias("_file"),
        )
        write_named_csv(spark, rows, folder, "_file", encoding="ISO-8859-1")

    return cached(spark, sf_dir, "conversations_latin1", build)


PART_SCHEMA = "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double"


def part_csv(spark: SparkSession, sf_dir: str) -> str:
    def build(folder: str) -> None:
        part = table(spark, sf_dir, "part")
        rows = part.select(
            *[F.col(c).cast("string").alias(c.upper()) for c in ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")],
            dealt_name(part, F.concat(F.lit("part_"), F.col("p_type")), "p_partkey").alias("_file"),
        )
        write_named_csv(spark, rows, folder, "_file")

    return cached(spark, sf_dir, "part_csv", build)


# ---------------------------------------------------------------- enrolment snapshots

# Letter codes cycled through when making legacy-style CCNs.
CCN_CODES = ("M", "R", "Z", "S", "T", "U", "W", "Y", "TA", "SA", "TB", "SB", "TC", "SC", "SD", "TE", "SE",
             "TF", "TG", "TH", "TJ", "TK", "X", "1")
SEGMENT_FILES = {
    "AUTOMOBILE": "pc_cust_2024.01.05.csv",
    "BUILDING": "pc_cust_2024.02.05.csv",
    "FURNITURE": "pc_cust_2024.03.05.csv",
    "HOUSEHOLD": "pc_cust_2024.04.05.csv",
    "MACHINERY": "pc_cust_current.csv",
}

ENROLMENT_SPEC = TableSpec(
    name="enrolment_snapshots",
    globs=("pc_cust_*.csv",),
    file_date="last10_dotted",
    load="append",
    types={"npi": "bigint", "acct_bal": "double"},
    date_rules=(DateRule("suffix", "_date", ("MM/dd/yyyy",)),),
    ccn_column="ccn",
    encoding="ISO-8859-1",
)


def synthetic_ccn(state_num: Column, key: Column) -> Column:
    """Legacy-style CCN: two-digit state, a letter code picked by key, digits; some too short."""
    codes = F.array(*[F.lit(c) for c in CCN_CODES])
    code = F.element_at(codes, (key % len(CCN_CODES) + 1).cast("int"))
    return F.concat(F.lpad(state_num.cast("string"), 2, "0"), code, F.lpad((key % 1000).cast("string"), 4, "0"))


def enrolment_snapshots(spark: SparkSession, sf_dir: str) -> str:
    def build(folder: str) -> None:
        cust = table(spark, sf_dir, "customer")
        file_map = F.create_map(*[F.lit(x) for kv in SEGMENT_FILES.items() for x in kv])
        ccn = synthetic_ccn(F.col("c_nationkey"), F.col("c_custkey"))
        ccn = F.when(F.col("c_custkey") % 29 == 0, F.lit(None)).when(F.col("c_custkey") % 31 == 0, F.lit("AB")).otherwise(ccn)
        rows = cust.select(
            F.col("c_custkey").cast("string").alias("NPI"),
            ccn.alias("CCN"),
            F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("State"),
            F.format_number("c_acctbal", 2).alias("Acct Bal"),
            F.date_format(F.make_date(F.lit(2020), (F.col("c_custkey") % 12 + 1).cast("int"), (F.col("c_custkey") % 28 + 1).cast("int")), "MM/dd/yyyy").alias("Enroll Date"),
            F.concat(F.col("c_name"), F.lit(" Société")).alias("Legal Name"),
            F.element_at(file_map, F.col("c_mktsegment")).alias("_file"),
        )
        write_named_csv(spark, rows, folder, "_file", encoding="ISO-8859-1")

    return cached(spark, sf_dir, "enrolment_snapshots", build)


# ---------------------------------------------------------------- reference taxonomy

TAXONOMY_SPEC = TableSpec(
    name="taxonomy",
    globs=("rbcs_*_taxonomy.csv",),
    file_date="token2_year",
    load="full",
    types={"hcpcs_cd": "bigint", "rbcs_price": "double"},
    date_rules=(DateRule("suffix", "_dt", ("MM/dd/yyyy", "M/d/yyyy")),),
    table_comment="Service-code taxonomy per year",
    column_comments={"hcpcs_cd": "service code", "rbcs_cat_desc": "category", "hcpcs_cd_add_dt": "date the code was added"},
)


def taxonomy_files(spark: SparkSession, sf_dir: str) -> str:
    def build(folder: str) -> None:
        part = table(spark, sf_dir, "part")
        year = (F.lit(2019) + F.col("p_size") % 5).cast("string")
        add_dt = F.make_date(F.lit(2010) + F.col("p_partkey") % 10, (F.col("p_partkey") % 12 + 1).cast("int"), (F.col("p_partkey") % 28 + 1).cast("int"))
        add_txt = F.when(F.col("p_partkey") % 13 == 0, F.lit("TBD")).when(
            F.col("p_partkey") % 2 == 0, F.date_format(add_dt, "M/d/yyyy")).otherwise(F.date_format(add_dt, "MM/dd/yyyy"))
        rows = part.select(
            F.col("p_partkey").cast("string").alias("HCPCS_Cd"),
            F.col("p_brand").alias("RBCS_ID"),
            F.col("p_type").alias("RBCS_Cat_Desc"),
            F.col("p_name").alias("RBCS_Family_Desc"),
            add_txt.alias("HCPCS_Cd_Add_Dt"),
            F.lit(None).cast("string").alias("HCPCS_Cd_End_Dt"),
            F.col("p_retailprice").cast("string").alias("RBCS Price"),
            F.concat(F.lit("rbcs_"), year, F.lit("_taxonomy.csv")).alias("_file"),
        )
        write_named_csv(spark, rows, folder, "_file")

    return cached(spark, sf_dir, "taxonomy_files", build)


# ---------------------------------------------------------------- broken-row feed

BROKEN_MARKER = ' or ultralightweight wheelchair"'


def broken_rows_csv(spark: SparkSession, sf_dir: str) -> str:
    def build(folder: str) -> None:
        orders = table(spark, sf_dir, "orders")
        tot = (F.when(F.col("o_orderkey") % 17 == 0, F.lit(BROKEN_MARKER))
               .when(F.col("o_orderkey") % 19 == 0, F.lit(None))
               .otherwise(F.col("o_custkey").cast("string")))
        rows = orders.select(
            F.col("o_orderkey").cast("string").alias("Order_Key"),
            F.concat(F.col("o_orderpriority"), F.lit(' 17" wide, light, or ultralight')).alias("Descr"),
            tot.alias("Tot_Suplrs"),
            F.concat(F.lit("mup_dme_ry2021_dy"), F.year("o_orderdate").cast("string"), F.lit("_prvhpr.csv")).alias("_file"),
        )
        write_named_csv(spark, rows, folder, "_file")

    return cached(spark, sf_dir, "broken_rows", build)


# ---------------------------------------------------------------- catalogue JSON

def catalog_json(spark: SparkSession, sf_dir: str) -> str:
    """One catalogue document per conversation: the conversation is a dataset,
    each turn a distribution. Null fields are omitted from the JSON (absent keys),
    and every tenth conversation has no distributions."""

    def build(folder: str) -> None:
        conv = table(spark, sf_dir, "conversations")
        dist = F.struct(
            F.col("role").alias("format"),
            F.concat(F.lit("https://data.example.org/c/"), F.col("conv_id").cast("string"), F.lit("/conv"),
                     F.col("conv_id").cast("string"), F.lit("_turn_"), F.col("turn").cast("string"),
                     F.lit(".csv")).alias("downloadURL"),
            F.when(F.col("role") == "assistant", F.lit("text/csv")).when(F.col("role") == "user", F.lit("application/json")).alias("mediaType"),
            F.col("text").alias("title"),
            F.col("turn").cast("string").alias("modified"),
        )
        ds = conv.groupBy("conv_id").agg(F.collect_list(dist).alias("distribution"), F.count("*").alias("n"))
        doc = ds.select(
            F.struct(
                F.lit("public").alias("accessLevel"),
                F.concat(F.lit("b"), F.col("conv_id").cast("string")).alias("bureauCode"),
                F.when(F.col("conv_id") % 3 == 0, F.lit("R/P1W")).alias("accrualPeriodicity"),
                F.concat(F.lit("conversation "), F.col("conv_id").cast("string")).alias("description"),
                F.filter("distribution", lambda x: F.col("conv_id") % 10 != 0).alias("distribution"),
            ).alias("d")
        ).select(F.array("d").alias("dataset"))
        doc.write.json(folder)

    return cached(spark, sf_dir, "catalog_json", build)


def open_catalog_json(spark: SparkSession, sf_dir: str) -> str:
    """A catalogue document per conversation with fields that no schema declares: numbers, lists and objects, some absent, one of two types."""

    def build(folder: str) -> None:
        conv = table(spark, sf_dir, "conversations")
        key = F.col("conv_id")
        dist = F.struct(
            F.col("role").alias("format"), F.col("text").alias("title"), F.col("turn").alias("turn"),
            F.when(F.col("turn") % 2 == 0, F.octet_length("text")).alias("byteSize"),
        )
        ds = conv.groupBy("conv_id").agg(F.sort_array(F.collect_list(dist)).alias("distribution"))
        doc = ds.select(F.struct(
            F.concat(F.lit("b"), key.cast("string")).alias("bureauCode"), key.alias("identifier"),
            F.array(F.lit("k"), key.cast("string")).alias("keyword"),
            F.when(key % 3 == 0, F.struct(F.concat(F.lit("Name "), key.cast("string")).alias("fn"), F.struct((key / 4).alias("score")).alias("rating"))).alias("contactPoint"),
            F.col("distribution"),
        ).alias("d")).select(F.array("d").alias("dataset"))
        doc.write.json(folder)

    return cached(spark, sf_dir, "open_catalog_json", build)
