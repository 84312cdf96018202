import datetime as dt

from relcast.functions.identifiers import join_token, remap_ccn


def test_ccn_cases(spark):
    cases = {"33S125": "330125", "45TA12": "452012", "12M345": "121345", "01W123": "012123", "05Y321": "053321",
             "10SD99": "103099", "330125XX": "330125", "AB": "AB", None: ""}
    df = spark.createDataFrame([(k,) for k in cases], "c string")
    got = {r[0]: r[1] for r in df.select("c", remap_ccn("c")).collect()}
    assert got == cases


def test_token_keeps_null_slot(spark):
    df = spark.createDataFrame([("a", None, dt.date(2024, 1, 2))], "x string, y string, d date")
    assert df.select(join_token("x", "y", "d")).first()[0] == "a^^2024-01-02"
