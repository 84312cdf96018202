import datetime as dt

from relcast.plans.load import replace_periods, write_full
from relcast.sources.files import read_table


def test_replace_periods_touches_only_incoming(spark, tmp_folder):
    target = f"{tmp_folder}/t"
    d1, d2 = dt.date(2023, 12, 31), dt.date(2024, 12, 31)
    replace_periods(spark.createDataFrame([(1, d1), (2, d2)], "v int, _input_file_date date"), target)
    new = spark.createDataFrame([(3, "x", d2)], "v int, extra string, _input_file_date date")
    replace_periods(new, target)
    replace_periods(new, target)  # twice = once
    rows = sorted((r.v, r.extra, r._input_file_date) for r in read_table(spark, target).collect())
    assert rows == [(1, None, d1), (3, "x", d2)]


def test_full_replace(spark, tmp_folder):
    target = f"{tmp_folder}/f"
    write_full(spark.createDataFrame([(1,)], "v int"), target)
    write_full(spark.createDataFrame([(2,)], "v int"), target)
    assert [r.v for r in read_table(spark, target).collect()] == [2]


def test_catalog_table_period_replace_with_new_column(spark):
    import uuid

    name = "relcast_t_" + uuid.uuid4().hex[:8]
    d1, d2 = dt.date(2023, 12, 31), dt.date(2024, 12, 31)
    replace_periods(spark.createDataFrame([(1, "a", d1), (2, "b", d2)], "v int, s string, _input_file_date date"), name)
    # columns in another order, plus a new one: aligned by name, the new column added
    new = spark.createDataFrame([("x", d2, 3, 9.5)], "s string, _input_file_date date, v int, extra double")
    replace_periods(new, name)
    replace_periods(new, name)
    rows = sorted((r.v, r.s, r.extra, r._input_file_date) for r in spark.table(name).collect())
    assert rows == [(1, "a", None, d1), (3, "x", 9.5, d2)]
    spark.sql(f"DROP TABLE {name}")


def test_full_replace_drops_partitions(spark, tmp_folder):
    target = f"{tmp_folder}/p"
    write_full(spark.createDataFrame([(1, "a"), (2, "b")], "v int, k string"), target, partition_by="k")
    write_full(spark.createDataFrame([(3, "b")], "v int, k string"), target, partition_by="k")
    assert [(r.v, r.k) for r in read_table(spark, target).collect()] == [(3, "b")]


def test_replaced_period_without_rows_is_emptied(spark, tmp_folder):
    import uuid

    d1, d2 = dt.date(2023, 12, 31), dt.date(2024, 12, 31)
    rows = spark.createDataFrame([(1, d1), (2, d2)], "v int, _input_file_date date")
    none = rows.where("false")
    periods = spark.createDataFrame([(d2,)], "_input_file_date date")
    name = "relcast_e_" + uuid.uuid4().hex[:8]
    for target in (f"{tmp_folder}/e", name):
        replace_periods(rows, target, periods=rows.select("_input_file_date"))
        replace_periods(none, target, periods=periods)
        assert [r.v for r in read_table(spark, target).collect()] == [1]
    spark.sql(f"DROP TABLE {name}")


def test_schema_beside_the_table(spark, tmp_folder):
    import pytest

    from relcast.sources.files import partition_keys, saved_schema

    target, d = f"{tmp_folder}/s", dt.date(2024, 12, 31)
    replace_periods(spark.createDataFrame([(1, d)], "v int, _input_file_date date"), target)
    assert saved_schema(spark, target).fieldNames() == ["v", "_input_file_date"]
    replace_periods(spark.createDataFrame([("x", dt.date(2023, 12, 31))], "w string, _input_file_date date"), target)
    assert set(saved_schema(spark, target).fieldNames()) == {"v", "w", "_input_file_date"}
    assert {r[0].year for r in partition_keys(spark, target, ["_input_file_date"]).collect()} == {2023, 2024}
    with pytest.raises(ValueError, match="column v"):
        replace_periods(spark.createDataFrame([("x", d)], "v string, _input_file_date date"), target)


def test_scratch_needs_shared_storage_on_a_cluster():
    from relcast.session import _single_machine

    assert _single_machine("local") and _single_machine("local[8]") and _single_machine("local[*]")
    assert not _single_machine("local-cluster[3,2,1024]") and not _single_machine("yarn") and not _single_machine("spark://h:7077")
