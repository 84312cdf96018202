"""Physical-plan checks: the plans the operators are meant to produce."""

import os

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as entry
from relcast.functions.parsing import parse_int

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_provenance_is_a_projection(spark):
    p = plan(entry.queries()["provenance"](spark, SF))
    assert "Join" not in p and "Exchange" not in p


def test_latest_per_key_aggregates_map_side(spark):
    p = plan(entry.queries()["latest_per_key"](spark, SF))
    assert "Window" not in p
    assert p.count("Aggregate") >= 2 and "partial_max(" in p


def test_crosswalk_pushes_filters_and_prunes(spark):
    df = entry.queries()["id_crosswalk"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(o_orderpriority), EqualTo(o_orderpriority,1-URGENT)]" in p
    assert "o_totalprice" not in p  # unused column pruned from the scan
    assert p.count("Exchange hashpartitioning") == 1


def test_candidate_search_is_an_equi_join(spark):
    p = plan(entry.queries()["typo_candidates"](spark, SF))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_candidate_index_is_never_broadcast(spark, tmp_folder):
    """A vocabulary whose index is far larger than the planner's estimate."""
    from relcast.operators.categories import typo_candidates

    words = spark.range(20_000).select(F.concat(F.lit("category number "), F.col("id").cast("string"), F.lit(" of the list")).alias("word"), (F.col("id") + 1).alias("n"))
    words.write.parquet(f"{tmp_folder}/v")
    p = plan(typo_candidates(spark.read.parquet(f"{tmp_folder}/v")))
    assert "SortMergeJoin" in p and "Broadcast" not in p


def test_loaded_periods_open_no_data_file(spark):
    p = plan(entry.queries()["loaded_periods"](spark, SF))
    assert "FileScan binaryFile" in p and "FileScan parquet" not in p
    assert "ReadSchema: struct<>" in p  # names only


def test_feed_selection_needs_no_join(spark):
    p = plan(entry.queries()["catalog_select"](spark, SF))
    assert "Join" not in p


def test_period_write_has_no_shuffle(spark, tmp_folder):
    from relcast.plans.jobs import discover, prepare
    from relcast.operators.releases import latest_release
    from relcast.queries import fixtures as fx

    folder = fx.order_releases(spark, SF)
    df = prepare(spark, fx.ORDERS_SPEC, latest_release(discover(spark, fx.ORDERS_SPEC, folder)))
    assert "Exchange" not in plan(df)


def test_csv_scan_prunes_columns(spark):
    df = entry.queries()["union_by_name"](spark, SF).select("order_key")
    p = plan(df)
    assert "ReadSchema: struct<order_key:string>" in p or "struct<order_key:string>" in p


@settings(max_examples=60, deadline=None)
@given(st.lists(st.from_regex(r"\A[ +\-]?[0-9]{0,12}(\.[0-9]{0,3})?(e[0-9])? ?\Z", fullmatch=True), min_size=1, max_size=20))
def test_int_rule_equals_non_ansi_cast(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    ours = [r[0] for r in df.select(parse_int("v")).collect()]
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        theirs = [r[0] for r in df.select(F.col("v").cast("int")).collect()]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")
    assert ours == theirs
