import datetime as dt

from pyspark.sql import functions as F

from relcast.operators.categories import corrections, apply_corrections, vocab, typo_candidates
from relcast.operators.crosswalk import id_crosswalk
from relcast.operators.dedupe import explode_ids, latest_per_key
from relcast.operators.releases import latest_release, pending_files, with_file_dates


def test_id_list_explode(spark):
    df = spark.createDataFrame([("111 222", "x"), ("111  222", "y"), (None, "z"), ("333", "w"), ("333", "w")],
                               "npi string, name string")
    out = explode_ids(df, "npi", "npi").dropDuplicates()
    assert sorted((r.npi, r.name) for r in out.collect()) == [
        ("111", "x"), ("111", "y"), ("222", "x"), ("222", "y"), ("333", "w")]


def test_latest_per_npi(spark):
    d = dt.date
    rows = [
        ("1", "a", d(2024, 1, 1), d(2025, 1, 1)),
        ("1", "b", d(2024, 2, 1), d(2025, 1, 1)),   # later update wins
        ("2", "c", d(2024, 2, 1), d(2025, 1, 1)),
        ("2", "d", d(2024, 2, 1), d(2026, 1, 1)),   # tie → later end date
        ("3", "e", None, d(2026, 1, 1)),
        ("3", "f", d(2020, 1, 1), None),            # null update sorts last
        (None, "g", d(2020, 1, 1), None),
        (None, "h", d(2021, 1, 1), None),           # null npi is one key
    ]
    df = spark.createDataFrame(rows, "npi string, specialty string, last_updated date, optout_end_date date")
    out = latest_per_key(df, ["npi"], ["last_updated", "optout_end_date"])
    assert sorted((r.npi or "", r.specialty) for r in out.collect()) == [("", "h"), ("1", "b"), ("2", "d"), ("3", "f")]


def test_spelling_fixture(spark):
    rows = ([("CARDIOLOGY", i) for i in range(50)] + [("CARDIOLGY", 100 + i) for i in range(2)]
            + [("CARDOLGY", 200)] + [("UROLOGY", 300 + i) for i in range(9)] + [(None, 400)])
    df = spark.createDataFrame(rows, "specialty string, npi int")
    fixed = apply_corrections(df, "specialty", corrections(df, "specialty", "npi"))
    got = {r.specialty for r in fixed.collect()}
    assert got == {"CARDIOLOGY", "UROLOGY", None}


def test_corrections_point_to_more_frequent_words_and_are_idempotent(spark):
    words = ["hot rod", "hot red", "hot rdo", "ht rod", "old rod", "old red", "cold rod", "bold rod"]
    rows = [(w, i * 10 + j) for i, w in enumerate(words) for j in range(len(words) - i)]
    df = spark.createDataFrame(rows, "w string, k int")
    counts = {r.word: r.n for r in vocab(df, "w", "k").collect()}
    m = corrections(df, "w", "k")
    for r in m.collect():
        assert counts[r.a] > counts[r.b]
    once = apply_corrections(df, "w", m)
    twice = apply_corrections(once, "w", corrections(once, "w", "k"))
    assert sorted(once.collect()) == sorted(twice.collect())
    cands = typo_candidates(vocab(df, "w", "k"))
    assert cands.where("a = b").count() == 0


def test_release_pick(spark):
    files = spark.createDataFrame(
        [("/x/mup_r19_p08_v10_d13_prvhpr.csv", 0), ("/x/mup_r20_p08_v10_d13_prvhpr.csv", 0),
         ("/x/mup_r19_p08_v10_d14_prvhpr.csv", 0)], "path string, glob_rank int")
    files = with_file_dates(files, "data_year", "release_year")
    pick = {r.data_date.year: r.path.split("/")[-1] for r in latest_release(files).collect()}
    assert pick == {2013: "mup_r20_p08_v10_d13_prvhpr.csv", 2014: "mup_r19_p08_v10_d14_prvhpr.csv"}


def test_file_date_rules(spark):
    from relcast.functions.filedates import file_date

    cases = [
        ("/a/medicare_geographic_variation_2022.csv", "last4_year", dt.date(2022, 12, 31)),
        ("/a/rbcs_2023_taxonomy.csv", "token2_year", dt.date(2023, 12, 31)),
        ("/a/optout_March2024.csv", "month_year", dt.date(2024, 3, 1)),
        ("/a/otpp_providers_01052024.csv", "last_token_day", dt.date(2024, 1, 5)),
        ("/a/otpp_providers_20231204.csv", "last_token_day", dt.date(2023, 12, 4)),
        ("/a/revalidationreassignmentlist20240105.csv", "last8_day", dt.date(2024, 1, 5)),
        ("/a/covid19_nursing_home_data_2024-01-07.csv", "last_token_iso", dt.date(2024, 1, 7)),
        ("/a/hospital_2024.01.05.csv", "last10_dotted", dt.date(2024, 1, 5)),
        ("/a/hospital_enrollments.csv", "last10_dotted", dt.date(2022, 11, 30)),
        ("/a/mup_dme_r19_p08_v10_d13_prvhpr.csv", "data_year", dt.date(2013, 12, 31)),
        ("/a/MUP_PAC_R2022_P04_V10_D2021_Geo.csv", "stem_year_slice", None),
        ("/a/MUP_PAC_R2022_P04_V10_D20212.csv", "stem_year_slice", dt.date(2021, 12, 31)),
    ]
    df = spark.createDataFrame([(p, r) for p, r, _ in cases], "path string, rule string")
    for (p, rule, want) in cases:
        got = df.where(F.col("path") == p).select(file_date("path", rule)).first()[0]
        assert got == want, (p, rule, got)


def test_pending_files(spark):
    files = spark.createDataFrame([("a", dt.date(2024, 1, 1)), ("b", dt.date(2024, 2, 1))], "path string, data_date date")
    loaded = spark.createDataFrame([(dt.date(2024, 1, 1),)], "_input_file_date date")
    assert [r.path for r in pending_files(files, loaded).collect()] == ["b"]


def test_crosswalk_fixture(spark):
    d = dt.date
    rows = [("1", "330125", None, d(2024, 1, 1)), ("1", "330125", "NY", d(2024, 2, 1)), ("1", "330125", "NJ", d(2024, 3, 1))]
    df = spark.createDataFrame(rows, "npi string, ccn string, state string, _input_file_date date")
    out = id_crosswalk({"hospital": df}).collect()
    assert len(out) == 1
    r = out[0]
    assert (r.other_id_dt_s, r.other_id_dt_e) == (d(2024, 1, 1), d(2024, 3, 1))
    assert r.other_id_state is None  # earliest period has no state
    assert r.other_id_token == "330125^06^^MEDICARE^CCN^2024-01-01^2024-03-01"


def test_download_names_and_owner_date_rule(spark):
    from relcast.operators.feeds import release_file_names
    from relcast.operators.typed import type_of
    from relcast.specs import FEEDS
    from relcast.specs.utilisation import DME_DOWNLOAD_RENAMES

    messy = next(iter(DME_DOWNLOAD_RENAMES))
    df = spark.createDataFrame([(f"https://x/y/{messy}", "T"), ("https://x/y/plain.csv", "Revalidation List!")],
                               "downloadURL string, title string")
    names = [r.file_name for r in release_file_names(df, "url", DME_DOWNLOAD_RENAMES).collect()]
    assert names == [DME_DOWNLOAD_RENAMES[messy], "plain.csv"]
    titles = [r.file_name for r in release_file_names(df, "title").collect()]
    assert titles == ["t.csv", "revalidationlist.csv"]
    owner = FEEDS["pc_hospice_owner"]
    assert type_of("association_date_owner", owner)[0] == "date_strict"
    assert type_of("owner_name", owner)[0] == "string"
    assert type_of("bene_cc_ph_asthma_v2_pct", FEEDS["muppac_geo"])[0] == "double"


def test_latest_snapshot_keeps_only_newest_date(spark):
    from relcast.operators.releases import latest_snapshot

    d = dt.date
    df = spark.createDataFrame([(1, d(2024, 1, 1)), (2, d(2024, 1, 2)), (3, d(2024, 1, 2)), (4, None)], "v int, day date")
    assert sorted(r.v for r in latest_snapshot(df, "day").collect()) == [2, 3]


def test_names_that_do_not_parse_fail_with_the_name(spark):
    import pytest

    files = spark.createDataFrame([("/x/mup_r20_d13_prov.csv", 0), ("/x/mup_2020_Prov_Svc.csv", 0)], "path string, glob_rank int")
    for release in ("release_year", "none"):
        dated = with_file_dates(files, "data_year", release)
        with pytest.raises(Exception, match="mup_2020_Prov_Svc.csv"):
            latest_release(dated).collect()


def test_latest_per_key_with_expressions_and_nulls(spark):
    from pyspark.sql import functions as F

    rows = [(1, 5, "a"), (1, None, "b"), (1, 5, "c"), (None, 1, "d"), (None, 2, "e")]
    df = spark.createDataFrame(rows, "k int, v int, s string")
    by_name = sorted((r.k or 0, r.v, r.s) for r in latest_per_key(df, ["k"], ["v"]).collect())
    by_expr = sorted((r.k or 0, r.v, r.s) for r in latest_per_key(df, ["k"], [F.col("v") + 1]).collect())
    assert by_name == [(0, 2, "e"), (1, 5, "c")] and by_expr == [(0, 2, "e"), (1, 5, "c")]
    assert latest_per_key(df, ["k"], ["v"]).columns == ["k", "v", "s"]


def test_chains_close_whatever_their_length(spark):
    from relcast.operators.categories import resolve_chains

    best = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(200)], "b string, a string")
    assert {r.a for r in resolve_chains(best).collect()} == {"w200"}
