import json
import os

from pyspark.sql import functions as F

from relcast.sources.catalog import flatten_catalog, read_catalog
from relcast.sources.csv import scan_csv
from relcast.sources.files import list_releases


def write(path, text, encoding="utf-8"):
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_two_header_orders_align_by_name(spark, tmp_folder):
    write(os.path.join(tmp_folder, "a.csv"), "A,B\n1,2\n")
    write(os.path.join(tmp_folder, "b.csv"), "B,A,C\n3,4,5\n")
    df = scan_csv(spark, list_releases(spark, tmp_folder, ("*.csv",)))
    rows = sorted((r.a, r.b, r.c) for r in df.collect())
    assert rows == [("1", "2", None), ("4", "3", "5")]


def test_quoted_text_row_kept_and_null_marker_column_kept(spark, tmp_folder):
    from relcast.operators.dedupe import drop_marked_rows

    text = ('HCPCS,Descr,Tot_Suplrs\n'
            'K0056,"Seat height less than 17"" or equal or greater than 21"" for a high strength, lightweight, '
            'or ultralightweight wheelchair",5\n'
            'K0001,plain,\n'
            'K0002,broken," or ultralightweight wheelchair"""\n')
    write(os.path.join(tmp_folder, "dme.csv"), text)
    df = scan_csv(spark, [f"file:{tmp_folder}/dme.csv"])
    kept = drop_marked_rows(df, "tot_suplrs", ' or ultralightweight wheelchair"')
    rows = {r.hcpcs: r for r in kept.collect()}
    assert set(rows) == {"K0056", "K0001"}
    assert '17"' in rows["K0056"].descr and rows["K0056"].tot_suplrs == "5"
    assert rows["K0001"].tot_suplrs is None


def test_latin1(spark, tmp_folder):
    write(os.path.join(tmp_folder, "p.csv"), "Name,City\nJosé,Québec\n", encoding="latin-1")
    df = scan_csv(spark, [f"file:{tmp_folder}/p.csv"], encoding="ISO-8859-1")
    assert [(r.name, r.city) for r in df.collect()] == [("José", "Québec")]


def test_catalog_flatten(spark, tmp_folder):
    doc = {"dataset": [
        {"accessLevel": "public", "description": "none", "distribution": []},
        {"accessLevel": "public", "bureauCode": ["009:38"], "distribution": [{"title": "one", "downloadURL": "u1"}]},
        {"description": "three", "distribution": [
            {"title": "t", "mediaType": "text/csv"}, {"title": "t", "mediaType": "text/csv"}, {"format": "API"}]},
    ]}
    write(os.path.join(tmp_folder, "data.json"), json.dumps(doc))
    flat = flatten_catalog(read_catalog(spark, os.path.join(tmp_folder, "data.json")))
    rows = flat.collect()
    assert len(rows) == 4
    one = [r for r in rows if r.title == "one"][0]
    assert one.mediaType == "" and one.accessURL == "" and one.downloadURL == "u1"
    assert json.loads(one.bureauCode) == ["009:38"]
    assert flat.where(F.col("mediaType") == "text/csv").count() == 2


def test_names_with_spaces_percent_and_plus_keep_provenance(spark, tmp_folder):
    from relcast.operators.releases import with_provenance

    write(os.path.join(tmp_folder, "a b%20c+d_2013.csv"), 'A,"B, x"\n1,2\n')
    files = list_releases(spark, tmp_folder, ("*.csv",))
    rows = with_provenance(scan_csv(spark, files), "last4_year").collect()
    assert [(r.a, r.b_x, r._source_file_name) for r in rows] == [("1", "2", "a b%20c+d_2013.csv")]


def test_hadoop_header_fallback(spark, tmp_folder, monkeypatch):
    """Where Arrow cannot open a file, its first line comes through the Hadoop file system."""
    from relcast.sources import csv as source

    write(os.path.join(tmp_folder, "h.csv"), '\ufeffA,"B, x","C ""q"""\n1,2,3\n')
    write(os.path.join(tmp_folder, "e.csv"), "")
    files = list_releases(spark, tmp_folder, ("*.csv",))
    direct = source.header_groups(files)

    def fails(path, encoding):
        raise OSError("no client for this file system")

    monkeypatch.setattr(source, "_first_line", fails)
    assert source.header_groups(files) == direct
    assert {h for h in direct if h} == {("A", "B, x", 'C "q"')}


def test_arrow_locations():
    from relcast.sources.csv import arrow_location

    assert arrow_location("s3a://b/a b%.csv") == ("uri", "s3://b/a%20b%25.csv")
    assert arrow_location("s3n://b/x") == ("uri", "s3://b/x")
    assert arrow_location("gs://b/x") == ("uri", "gs://b/x")
    assert arrow_location("hdfs://host:8020/x") == ("uri", "hdfs://host:8020/x")
    assert arrow_location("abfss://c@a.dfs.core.windows.net/x")[1].startswith("abfs://")
    assert arrow_location("dbfs:/x/y.csv") == ("local", "/dbfs/x/y.csv")
    assert arrow_location("file:/x/y.csv") == arrow_location("file:///x/y.csv") == ("local", "/x/y.csv")


def test_first_line_reads_no_further(tmp_folder):
    from relcast.sources import csv as source

    path = os.path.join(tmp_folder, "big.csv")
    with open(path, "wb") as f:
        f.write(b"A,B\n" + b"x" * (1 << 20))
    assert source._first_line(f"file:{path}", "UTF-8") == ["A", "B"]
    with open(path, "wb") as f:
        f.write(b"x" * (source.MAX_HEADER_BYTES + (1 << 17)))
    try:
        source._first_line(f"file:{path}", "UTF-8")
        raise AssertionError("a file without a line end has no header")
    except ValueError:
        pass


def test_declared_schema_follows_the_header(spark, tmp_folder):
    from relcast.sources.csv import scan_csv_typed

    write(os.path.join(tmp_folder, "a.csv"), "A,B\n1,x\n")
    write(os.path.join(tmp_folder, "b.csv"), "B,Other,A\ny,z,2\n")
    write(os.path.join(tmp_folder, "c.csv"), "B\nw\n")
    rows = scan_csv_typed(spark, [f"{tmp_folder}/*.csv"], "A int, B string").collect()
    assert sorted((r.A is None, r.A or 0, r.B) for r in rows) == [(False, 1, "x"), (False, 2, "y"), (True, 0, "w")]


def test_empty_and_header_only_files_add_no_rows(spark, tmp_folder):
    write(os.path.join(tmp_folder, "a.csv"), "A,B\n1,2\n")
    write(os.path.join(tmp_folder, "empty.csv"), "")
    write(os.path.join(tmp_folder, "head.csv"), "A,B\r\n")
    df = scan_csv(spark, list_releases(spark, tmp_folder, ("*.csv",)))
    assert [(r.a, r.b) for r in df.collect()] == [("1", "2")]
