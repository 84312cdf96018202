"""Every declared feed spec is well formed."""

from pyspark.sql import functions as F

from relcast.functions.filedates import file_date, release_date
from relcast.specs import FEEDS, source_folder
from relcast.specs.utilisation import CC_LEGACY, CC_V2_PCT, DEMO_COUNTS

KINDS = {"int", "bigint", "double", "date", "date_strict", "string"}


def test_feed_count_and_folders():
    assert len(FEEDS) == 38
    assert source_folder("mupdme_geo") == "mupdme" and source_folder("pc_hospice_owner") == "pc_hospice_owner"


def test_specs_are_well_formed(spark):
    df = spark.createDataFrame([("/x/name_2024.csv",)], "path string")
    for name, spec in FEEDS.items():
        assert spec.name == name
        assert spec.globs and spec.load in {"period", "append", "latest", "full"}
        assert set(spec.types.values()) <= KINDS, name
        df.select(file_date("path", spec.file_date), release_date("path", spec.release)).collect()
        for rule in spec.date_rules:
            assert rule.formats and rule.how in {"suffix", "contains", "exact"}
        for col, fmts in spec.date_formats.items():
            assert spec.types.get(col, "").startswith("date") and fmts
        for old, new in spec.renames.items():
            assert old != new


def test_shared_groups():
    assert len(DEMO_COUNTS) == 14 and len(CC_V2_PCT) == 25 and len(CC_LEGACY) == 16
    assert set(CC_LEGACY.values()) <= set(CC_V2_PCT)
    for name in ("mupphy_prvdr", "mupihp_prvdr", "mupdpr_prvdr", "mupdme_prvdr", "mupdme_sup"):
        assert all(FEEDS[name].types[c] == "int" for c in DEMO_COUNTS), name
