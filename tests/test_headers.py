import pytest

from relcast.functions.headers import HeaderError, normalise_header, normalise_name, rename_legacy, resolve_header


def test_normalise_name():
    assert normalise_name("Rndrng_Prvdr_Last_Org_Name") == "rndrng_prvdr_last_org_name"
    assert normalise_name("Total Price ($)") == "total_price_"
    assert normalise_name("Cust-Key") == "custkey"


def test_normalise_is_idempotent():
    raw = ["A b", "C.d (x)", "e_F"]
    once = resolve_header(raw)
    assert resolve_header(once) == once


def test_collisions_fail():
    with pytest.raises(HeaderError):
        resolve_header(["NPI", "npi"])
    with pytest.raises(HeaderError):
        resolve_header(["old name", "new_name"], {"old_name": "new_name"})


def test_positional_rename_handles_dots(spark):
    df = spark.createDataFrame([(1, 2)], "`a.b` int, `C D` int")
    assert normalise_header(df).columns == ["ab", "c_d"]


def test_rename_legacy_both_present(spark):
    df = spark.createDataFrame([(1, 2)], "old int, new int")
    with pytest.raises(HeaderError):
        rename_legacy(df, {"old": "new"})
    assert rename_legacy(df.select("old"), {"old": "new"}).columns == ["new"]
