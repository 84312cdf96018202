"""Multi-line CSV in splits, type inference and date elections against plain versions."""

import csv
import datetime as dt
import io
import random
from collections import Counter

import pytest
from pyspark.sql import types as T

from relcast.sources import infer
from relcast.sources.csv import FILE_PATH, _read, scan_csv
from relcast.sources.multiline import ends_inside, records


def write_csv(path, rng, n, encoding="utf-8", newline="\n"):
    texts = ["plain", "", "two\nlines", 'a "quoted" word', "comma, inside", "\n\n\n", "über é", "x" * 300, 'ends with "', '"', "many\n" * 40, " spaced ", "1\r\n2"]
    out = io.StringIO(newline="")
    writer = csv.writer(out, lineterminator=newline)
    writer.writerow(["Id", "First Text", "Second"])
    for i in range(n):
        writer.writerow([i, rng.choice(texts), rng.choice(texts)])
    path.write_bytes(out.getvalue().encode(encoding))


@pytest.fixture()
def small_splits(spark):
    """Splits of some 2 KB, so that small files have many borders."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


SCHEMA = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "first_text", "second")])


@pytest.mark.parametrize("encoding,newline", [("utf-8", "\n"), ("ISO-8859-1", "\n"), ("utf-8", "\r\n")])
def test_splits_give_the_rows_of_a_single_task(spark, tmp_path, small_splits, encoding, newline):
    for k, n in enumerate((400, 1, 0, 60)):
        write_csv(tmp_path / f"f{k}.csv", random.Random(k), n, encoding, newline)
    paths = sorted(str(p) for p in tmp_path.iterdir())
    got = scan_csv(spark, paths, encoding=encoding, multi_line=True)
    assert got.columns == ["id", "first_text", "second", FILE_PATH] and got.rdd.getNumPartitions() > 10
    want = _read(spark, SCHEMA, paths, encoding, multi_line=True)
    assert Counter(tuple(r)[:3] for r in got.collect()) == Counter(map(tuple, want.collect()))
    assert {r[FILE_PATH].rsplit("/", 1)[1] for r in got.collect()} == {"f0.csv", "f1.csv", "f3.csv"}


def test_a_record_over_many_splits_and_an_open_end(spark, tmp_path, small_splits):
    long = "\n".join(f"line {i}" for i in range(2000))
    (tmp_path / "a.csv").write_text(f'id,t\n1,"{long}"\n2,"x"\n')
    (tmp_path / "b.csv").write_text('id,t\n1,"never closed\n2,y\n')
    (tmp_path / "c.csv").write_text('id,t\n\n1,17" wide\n2,"17"" wide",\n3,"a"b,"c\nd"\n')
    got = {(r[FILE_PATH].rsplit("/", 1)[1], r.id): r.t for r in scan_csv(spark, [str(tmp_path / f) for f in ("a.csv", "b.csv", "c.csv")], multi_line=True).collect()}
    assert got[("a.csv", "1")] == long and got[("a.csv", "2")] == "x"
    assert got[("b.csv", "1")].startswith("never closed") and ("b.csv", "2") not in got
    assert got[("c.csv", "1")] == '17" wide' and got[("c.csv", "2")] == '17" wide' and ("c.csv", "3") in got


def test_line_states():
    assert not ends_inside(b'a,b"c,d', False) and ends_inside(b'a,"b', False) and not ends_inside(b'a,"b""c"', False)
    assert ends_inside(b'"a""', False) and not ends_inside(b'x",y', True) and ends_inside(b'x","y', True) and ends_inside(b"x", True) and ends_inside(b'""', True)


def test_line_states_match_the_csv_module():
    rng = random.Random(4)
    for _ in range(2000):
        fields = ["".join(rng.choice('ab",\n') for _ in range(rng.randint(0, 6))) for _ in range(3)]
        out = io.StringIO(newline="")
        csv.writer(out, lineterminator="\n").writerow(fields)
        inside = False
        lines = out.getvalue()[:-1].split("\n")
        for k, line in enumerate(lines):
            inside = ends_inside(line.encode(), inside)
            assert inside == (k < len(lines) - 1)


def test_moved_splits_are_noticed(spark, tmp_path, small_splits):
    write_csv(tmp_path / "f.csv", random.Random(1), 200)
    frame = records(spark, [str(tmp_path / "f.csv")])
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000b")
    with pytest.raises(Exception, match="MovedSplits"):
        frame.count()


# ----------------------------------------------------------------- inference

def inferred(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "v string").repartition(3)
    r = infer.infer_types(df, **options).first()
    return r["type"], r["format"]


@pytest.mark.parametrize("values,kind", [
    ([None, "", " ", "NA", "NaN"], None), (["1", "-2", "+3", None], "int"), (["1", "2147483648"], "bigint"), (["1", "9223372036854775808"], "decimal(38,0)"),
    (["1", "2.5"], "double"), (["1e3", ".5", "7."], "double"), (["9223372036854775808", "1.5"], "double"), (["1" * 39, "1"], "double"), (["True", "false"], "boolean"),
    (["True", "1"], "string"), (["007", "8"], "string"), (["0", "-0", "0.5"], "double"), (["1", "x"], "string"), (["$1"], "string"), (["1 2"], "string"),
    (["2020-01-05", "1"], "string"), (["2020-01-05", "x"], "string"),
])
def test_types(spark, values, kind):
    assert inferred(spark, values) == (kind, None)


@pytest.mark.parametrize("values,fmt", [
    (["1/5/2020", "01/31/2020"], "M/d/yyyy"), (["1/5/2020", "31/01/2020", None], "d/M/yyyy"), (["2020-1-5", "2020-01-31"], "yyyy-M-d"),
    (["1/5/20", "1/31/99"], "M/d/yy"), (["5-Jan-2020"], "d-MMM-yyyy"), (["Jan 5, 2020", "Dec 31, 2019"], "MMM d, yyyy"), (["1/1/2020", "2/2/2020"], "M/d/yyyy"),
])
def test_date_elections(spark, values, fmt):
    assert inferred(spark, values) == ("date", fmt)


def test_date_formats_are_tried_on_texts_of_their_shape(spark):
    """A shape matches all that the format reads, and few texts of other formats (their failed parses cost most)."""
    from pyspark.sql import functions as F

    from relcast.functions.parsing import date_shape, guessed_date

    rng = random.Random(6)
    parts = ["1", "01", "001", "12", "13", "31", "32", "0", "95", "1995", "995", "12020", "0000001", "2020", "Jan", "jan", "MAY", "January", "Sept", "march", "x", "1a"]
    texts = {"1/2/-2020", "1/2/--2020", "Jan 5, 2020", "May 05, 2020", "+2020/1/2", "1/2/+2020"}
    for _ in range(20_000):
        texts.add(rng.choice(parts) + rng.choice("-/ ") + rng.choice(parts) + rng.choice(["-", "/", ", ", " ", "--", ","]) + rng.choice(["1995", "95", "5", "005", "31", "0000"]))
    df = spark.createDataFrame([(x,) for x in sorted(texts)], "v string").repartition(4)
    formats = (*infer.DATE_FORMATS, "MM/dd/yyyy", "dd-MM-yy")
    counts = [F.count_if(test).alias(f"{kind}{i}") for i, f in enumerate(formats) for kind, test in (
        ("read", guessed_date(F.col("v"), f).isNotNull()), ("missed", guessed_date(F.col("v"), f).isNotNull() & ~F.col("v").rlike(date_shape(f))), ("tried", F.col("v").rlike(date_shape(f))))]
    got = df.agg(*counts).first()
    for i, f in enumerate(formats):
        assert got[f"read{i}"] > 0 and got[f"missed{i}"] == 0 and got[f"tried{i}"] < len(texts) / 50, (f, got)
    assert date_shape("yyyy-DDD") is None and date_shape("yyyy'x'") is None


def test_ties_fail_unless_declared(spark):
    df = spark.createDataFrame([("1/5/2020", "2/3/2020"), ("3/4/2020", "2/30/2020")], "d string, e string")
    types = infer.infer_types(df)
    assert {r["column"]: r["type"] for r in types.collect()} == {"d": "date", "e": "string"}
    with pytest.raises(infer.AmbiguousDates, match="d: M/d/yyyy, d/M/yyyy"):
        infer.elected(types)
    chosen = infer.elected(types, {"d": ("date", "d/M/yyyy")})
    assert sorted(r.d for r in infer.typed_as(df, chosen).collect()) == [dt.date(2020, 4, 3), dt.date(2020, 5, 1)]


def test_types_do_not_depend_on_the_order_of_files(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Id,Amount,Day,Code\n1,2,1/5/2020,07\n2,,1/6/2020,08\n")
    (tmp_path / "b.csv").write_text("Id,Amount,Day,New\n3000000000,2.5,1/31/2020,true\n")
    (tmp_path / "c.csv").write_text("Day,Id\n12/31/1999,NA\n")
    orders = (["a", "b", "c"], ["c", "b", "a"], ["b", "c", "a"])
    found = []
    for names in orders:
        df = infer.scan_csv_inferred(spark, [str(tmp_path / f"{n}.csv") for n in names])
        found.append((sorted((f.name, f.dataType.simpleString()) for f in df.schema), sorted(df.select("id", "amount", "day", "code", "new").collect(), key=str)))
    assert found[0] == found[1] == found[2]
    assert dict(found[0][0]) == {"id": "bigint", "amount": "double", "day": "date", "code": "string", "new": "boolean", FILE_PATH: "string"}
    assert {r.day for r in found[0][1]} == {dt.date(2020, 1, 5), dt.date(2020, 1, 6), dt.date(2020, 1, 31), dt.date(1999, 12, 31)}


def test_types_are_joined_in_a_lattice():
    types = [None, "boolean", "int", "bigint", "decimal(38,0)", "double", "date", "string"]
    for a in types:
        assert infer.join_types(a, a) == a and infer.join_types(a, None) == a and infer.join_types("string", a) == "string"
        for b in types:
            ab = infer.join_types(a, b)
            assert ab == infer.join_types(b, a)
            for c in types:
                assert infer.join_types(ab, c) == infer.join_types(a, infer.join_types(b, c))
    known = {"a": ("int", None), "d": ("date", "M/d/yyyy"), "e": ("date", "M/d/yyyy"), "n": (None, None)}
    new = {"a": ("double", None), "d": ("date", "d/M/yyyy"), "e": ("date", "M/d/yyyy"), "n": ("date", "yyyy-M-d"), "z": ("int", None)}
    assert infer.widened(known, new) == {"a": ("double", None), "d": ("string", None), "e": ("date", "M/d/yyyy"), "n": ("date", "yyyy-M-d"), "z": ("int", None)}


def test_inference_is_one_pass(spark):
    df = spark.createDataFrame([("1", "x")], "a string, b string")
    plan = infer.infer_types(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert infer.infer_types(df.where("false")).count() == 0


def test_a_feed_without_declared_types(spark, tmp_path):
    from relcast.plans.jobs import inferred_types, ingest_inferred
    from relcast.spec import TableSpec

    (tmp_path / "src").mkdir()
    (tmp_path / "src" / "x_2023.csv").write_text("Code,Rate,Since,Until\n01,1.5,1/31/2020,1/2/2020\n02,*,2/1/2020,3/4/2020\n")
    (tmp_path / "src" / "x_2024.csv").write_text("Code,Rate,Since,Seats\n03,7,12/1/2021,12\n")
    spec = TableSpec(name="x", globs=("x_*.csv",), file_date="last4_year", markers=("*",))
    assert {r["column"]: r["type"] for r in inferred_types(spark, spec, str(tmp_path / "src")).collect()} == {"code": "string", "rate": "double", "since": "date", "until": "date", "seats": "int"}
    with pytest.raises(infer.AmbiguousDates, match="until"):
        ingest_inferred(spark, spec, str(tmp_path / "src"), str(tmp_path / "t"))
    spec = TableSpec(name="x", globs=("x_*.csv",), file_date="last4_year", markers=("*",), date_formats={"until": ("d/M/yyyy",)}, types={"seats": "bigint"})
    table = ingest_inferred(spark, spec, str(tmp_path / "src"), str(tmp_path / "t"))
    assert dict(table.dtypes) == {"code": "string", "rate": "double", "since": "date", "until": "date", "seats": "bigint", "_input_file_date": "date"}
    got = {(r.code, r.rate, r.since, r.until, r.seats, r._input_file_date.year) for r in table.collect()}
    d = dt.date
    assert got == {("01", 1.5, d(2020, 1, 31), d(2020, 2, 1), None, 2023), ("02", None, d(2020, 2, 1), d(2020, 4, 3), None, 2023), ("03", 7.0, d(2021, 12, 1), None, 12, 2024)}


def test_cli_infers_types(tmp_path, capsys, spark):
    from relcast.__main__ import main

    (tmp_path / "a.csv").write_text("Id,Day,None\n1,1/2/2020,\n2,31/1/2020,\n")
    assert main(["infer", str(tmp_path), "*.csv"]) == 0
    lines = [line.split("\t") for line in capsys.readouterr().out.splitlines() if "\t" in line]
    assert lines == [["id", "int", "-", "2"], ["day", "date", "d/M/yyyy", "2"], ["none", "-", "-", "0"]]
