"""Feed specs end to end on small hand-written releases shaped like the published files."""

import datetime as dt
import os

from pyspark.sql import functions as F

from relcast.specs import run_crosswalk, run_feed


def write(folder, name, text, encoding="utf-8"):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w", encoding=encoding, newline="") as f:
        f.write(text)


def test_dme_referring_service_feed(spark, tmp_folder):
    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    header = "Rfrg_NPI,Rfrg_Prvdr_Last_Name,BETOS_CD,HCPCS_CD,HCPCS_Desc,Tot_Suplrs,Avg_Suplr_Sbmtd_Chrg\n"
    write(f"{src}/mupdme", "mup_dme_r19_p08_v10_d13_prvhpr.csv",
          header + '1,SMITH,D1,K0001,chair,"1,200",$10.50\n')
    write(f"{src}/mupdme", "mup_dme_r20_p08_v10_d13_prvhpr.csv",
          header + '1,SMITH,D1,K0001,chair,3,$11.00\n'
          '2,DOE,D1,K0056,"Seat height less than 17"" or ultralightweight wheelchair",*,12%\n')
    write(f"{src}/mupdme", "mup_dme_r21_p08_v10_d14_prvhpr.csv",
          "Rfrg_NPI,Rfrg_Prvdr_Last_Name_Org,RBCS_ID,HCPCS_CD,Tot_Suplrs,Avg_Suplr_Sbmtd_Chrg,Rfrg_Prvdr_RUCA_CAT\n"
          "3,ROE,D2,E0100,7,1.25,urban\n")
    df = run_feed(spark, "mupdme", src, out)
    rows = {(r.rfrg_npi, r._input_file_date.year): r for r in df.collect()}
    assert set(rows) == {("1", 2013), ("2", 2013), ("3", 2014)}  # the r20 release wins for 2013
    assert rows[("1", 2013)].tot_suplrs == 3 and rows[("1", 2013)].avg_suplr_sbmtd_chrg == 11.0
    assert rows[("2", 2013)].tot_suplrs is None and '17"' in rows[("2", 2013)].hcpcs_desc
    assert rows[("2", 2013)].rfrg_prvdr_last_name_org == "DOE" and rows[("2", 2013)].rbcs_id == "D1"
    assert rows[("3", 2014)].rfrg_prvdr_ruca_cat == "urban" and rows[("1", 2013)].rfrg_prvdr_ruca_cat is None
    assert rows[("3", 2014)]._source_file_name == "mup_dme_r21_p08_v10_d14_prvhpr.csv"


def test_geovariation_suffix_typing_and_append(spark, tmp_folder):
    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    write(f"{src}/geovariation", "medicare_geographic_variation_2021.csv",
          "BENE_GEO_LVL,BENE_GEO_DESC,BENES_EVER_MA_CNT,TOT_MDCR_PYMT_AMT,MA_PRTCPTN_RATE\nState,AL,*,10.5,NA\n")
    first = run_feed(spark, "geovariation", src, out).collect()
    assert len(first) == 1 and first[0].benes_ma_cnt is None and first[0].tot_mdcr_pymt_amt == 10.5
    write(f"{src}/geovariation", "medicare_geographic_variation_2022.csv",
          "BENE_GEO_LVL,BENE_GEO_DESC,BENES_MA_CNT,TOT_MDCR_PYMT_AMT,MA_PRTCPTN_RATE\nState,AK,12,1.5,0.25\n")
    rows = run_feed(spark, "geovariation", src, out).collect()
    assert sorted((r.bene_geo_desc, r.benes_ma_cnt, r.ma_prtcptn_rate) for r in rows) == [
        ("AK", 12, 0.25), ("AL", None, None)]
    assert len(run_feed(spark, "geovariation", src, out).collect()) == 2  # re-run adds nothing


def test_otpp_ids_and_dates(spark, tmp_folder):
    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    head = "NPI,PROVIDER NAME,ADDRESS LINE 1,ADDRESS LINE 2,CITY,STATE,ZIP,MEDICARE ID EFFECTIVE DATE,PHONE\n"
    write(f"{src}/otpp", "otp_providers_01052024.csv",
          head + '111 222,A,1 Main,,X,NY,1,1/2/2024,5\n111  222,A,1 Main,,X,NY,1,1/2/2024,5\n,B,2 Main,,Y,NJ,2,TBD,6\n')
    write(f"{src}/otpp", "otp_providers_20231204.csv", head + "333,C,3 Main,,Z,CT,3,12/4/2023,7\n")
    rows = run_feed(spark, "otpp", src, out).collect()
    got = sorted((r.npi, r.medicare_id_effective_date, r._input_file_date) for r in rows)
    assert got == [("111", dt.date(2024, 1, 2), dt.date(2024, 1, 5)), ("222", dt.date(2024, 1, 2), dt.date(2024, 1, 5)),
                   ("333", dt.date(2023, 12, 4), dt.date(2023, 12, 4))]


def test_pending_by_date_and_file(spark, tmp_folder):
    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    write(f"{src}/pendingilt", "pending_20240105_physicians.csv", "NPI,LAST NAME,FIRST NAME\n1,A,B\n")
    assert len(run_feed(spark, "pendingilt", src, out).collect()) == 1
    write(f"{src}/pendingilt", "pending_20240105_nonphysicians.csv", "NPI,LAST NAME,FIRST NAME\n2,C,D\n")
    rows = run_feed(spark, "pendingilt", src, out).collect()
    assert sorted(r.npi for r in rows) == ["1", "2"]


def test_facilities_and_crosswalk(spark, tmp_folder):
    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    head = "ENROLLMENT ID,NPI,CCN,STATE,INCORPORATION DATE\n"
    for t in ("hospital", "snf", "homehealth", "fqhc", "hospice", "ruralhealthclinic"):
        write(f"{src}/pc_{t}", f"{t}_enrollments_2024.01.05.csv", head + "e1,10,33S125,NY,01/02/2020\n",
              encoding="latin-1")
        write(f"{src}/pc_{t}", f"{t}_enrollments.csv", head + "e1,10,33S125,,2020-01-02\n", encoding="latin-1")
        rows = run_feed(spark, f"pc_{t}", src, out).collect()
        assert {(r.ccn_remapped, r.incorporation_date) for r in rows} == {("330125", dt.date(2020, 1, 2))}
    xw = run_crosswalk(spark, out).collect()
    assert len(xw) == 6
    r = [x for x in xw if x.facility_type == "hospital"][0]
    assert (r.other_id_dt_s, r.other_id_dt_e) == (dt.date(2022, 11, 30), dt.date(2024, 1, 5))
    assert r.other_id_state is None and r.other_id_token == "33S125^06^^MEDICARE^CCN^2022-11-30^2024-01-05"


def test_optout_cleaning(spark, tmp_folder):
    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    head = "NPI,Specialty,Optout Effective Date,Optout End Date,Last updated\n"
    rows = [f"{i},CARDIOLOGY,01/01/2020,01/01/2022,01/01/2021" for i in range(6)]
    rows += ["100,CARDIOLGY,01/01/2020,01/01/2022,01/01/2021", "101,UROLOGY,01/01/2020,01/01/2022,01/01/2021",
             "101,UROLGY,01/01/2019,01/01/2021,01/01/2019"]
    write(f"{src}/optout", "optout_March2024.csv", head + "\n".join(rows) + "\n")
    df = run_feed(spark, "optout", src, out)
    got = {(r.npi, r.specialty) for r in df.collect()}
    assert ("100", "CARDIOLOGY") in got and ("101", "UROLOGY") in got and len(got) == 8
    assert df.select(F.min("_input_file_date")).first()[0] == dt.date(2024, 3, 1)


def test_run_feed_registers_documented_table(spark, tmp_folder):
    import uuid

    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    write(f"{src}/reval", "revalidationreassignmentlist20240105.csv",
          "Group Enrollment ID,Individual Enrollment ID,Group Due Date,Individual Total Employer Associations\n"
          "g1,i1,01/31/2024,3\n")
    name = "reval_" + uuid.uuid4().hex[:8]
    rows = run_feed(spark, "reval", src, out, register_as=name).collect()
    assert rows[0].group_due_date == dt.date(2024, 1, 31) and rows[0].individual_total_employer_associations == 3
    info = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    assert info["Comment"].startswith("Periodic snapshot list") and "_input_file_date: period of the release" in info["Comment"]
    assert spark.table(name).count() == 1


def test_empty_restatement_empties_its_period(spark, tmp_folder):
    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    head = "Rfrg_NPI,HCPCS_CD,Tot_Suplrs\n"
    write(f"{src}/mupdme", "mup_dme_r19_p08_v10_d13_prvhpr.csv", head + "1,K0001,5\n")
    write(f"{src}/mupdme", "mup_dme_r19_p08_v10_d14_prvhpr.csv", head + "2,K0001,5\n")
    assert run_feed(spark, "mupdme", src, out).count() == 2
    write(f"{src}/mupdme", "mup_dme_r20_p08_v10_d13_prvhpr.csv", head)
    assert [r.rfrg_npi for r in run_feed(spark, "mupdme", src, out).collect()] == ["2"]


def test_undated_snapshot_fails_with_its_name(spark, tmp_folder):
    import pytest

    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    write(f"{src}/orderandreferring", "order_latest_list.csv", "NPI,LAST_NAME\n1,A\n")
    with pytest.raises(Exception, match="order_latest_list.csv"):
        run_feed(spark, "orderandreferring", src, out)


def test_documented_feeds(spark, tmp_folder):
    import uuid

    from relcast.specs.documentation import DOCUMENTATION

    src, out = f"{tmp_folder}/src", f"{tmp_folder}/out"
    assert set(DOCUMENTATION) == {"betos", "geovariation", "orderandreferring", "otpp", "pendingilt"}
    write(f"{src}/orderandreferring", "OrderReferring_20240105.csv", "NPI,LAST_NAME,FIRST_NAME,PARTB,DME,HHA,PMD,HOSPICE\n1,A,B,Y,Y,N,N,Y\n")
    name = "orderref_" + uuid.uuid4().hex[:8]
    run_feed(spark, "orderandreferring", src, out, register_as=name)
    comments = {r.col_name: r.comment for r in spark.sql(f"DESCRIBE TABLE {name}").collect()}
    assert all(comments[c] == t for c, t in DOCUMENTATION["orderandreferring"][1].items() if c != "_input_file_date")


# File names that follow each naming rule, by (period rule, release rule).
def feed_file(spec) -> str:
    glob = spec.globs[0]
    tail = glob.lstrip("*").replace("*", "") or ".csv"
    tail = tail if tail.endswith(".csv") else tail + ".csv"
    rule = spec.file_date
    if rule == "data_year":
        return "mup_x_ry21_p05_v10_dy20" + tail
    if rule == "stem_year_slice":
        return "PY2021" + glob.strip("*").replace(".csv", "") + "_2020x.csv"
    return {
        "last4_year": "name_2020.csv", "token2_year": "rbcs_2020_taxonomy.csv", "month_year": "optout_March2020.csv",
        "token2_day": "list_20200105_x.csv", "last_token_day": "otp_01052020.csv", "last8_day": "revalidationreassignmentlist20200105.csv",
        "last_token_iso": "covid_2020-01-05.csv", "last10_dotted": "enrol_2020.01.05.csv",
    }[rule]


def test_every_feed_runs_on_a_small_file(spark, tmp_folder):
    from relcast.operators.typed import type_of
    from relcast.specs import FEEDS, source_folder

    assert len(FEEDS) == 38
    for name, spec in FEEDS.items():
        src, out = f"{tmp_folder}/{name}/src", f"{tmp_folder}/{name}/out"
        columns = ["npi", *spec.types, *(spec.pads or ()), *(spec.output or ())]
        columns += [c for c in ("some_date", "start_date_x", "hcpcs_cd_add_dt", "ccn", "specialty") if c not in columns]
        columns = [c for c in dict.fromkeys(columns) if c not in spec.renames]
        sample = {"int": '"1,234"' if spec.strip_money else "1234", "bigint": "1234", "double": "12.5", "string": "text", "date": None, "date_strict": None}
        values = []
        for c in columns:
            kind, formats = type_of(c, spec)
            day = (formats or ("",))[0].replace("MM", "01").replace("dd", "05").replace("yyyy", "2020").replace("yy", "20").replace("M", "1").replace("d", "5")
            values.append(day if kind.startswith("date") else sample[kind])
        write(f"{src}/{source_folder(name)}", feed_file(spec), ",".join(columns) + "\n" + ",".join(values) + "\n", spec.encoding)
        rows = run_feed(spark, name, src, out).collect()
        assert len(rows) == 1, name
        row = rows[0].asDict()
        assert row["_input_file_date"].year == 2020, name
        for c in row:
            kind, _ = type_of(c, spec)
            if kind in ("int", "bigint") and c in spec.types:
                assert row[c] == 1234, (name, c)
            if kind == "double" and c in spec.types:
                assert row[c] == 12.5, (name, c)
            if kind.startswith("date") and c in columns:
                assert row[c] == dt.date(2020, 1, 5), (name, c)


def test_download_plan(spark, tmp_folder):
    from relcast.operators.feeds import plan_downloads
    from relcast.specs import FEEDS, source_folder
    from relcast.specs.downloads import DOWNLOADS, present_files, run_release_selection

    assert len(DOWNLOADS) == 28 and {d.folder for d in DOWNLOADS} == {source_folder(f) for f in FEEDS}
    dme = "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20Data%202015.csv"
    rows = [
        ("Hospice All Owners : 2024-01-05", "text/csv", "https://x/own.csv", "2024-01-05"),
        ("Medicare Durable Medical Equipment, Devices & Supplies - by Referring Provider", "text/csv", f"https://x/{dme}", ""),
        ("Revalidation Reassignment List : 2024-01", "text/csv", "https://x/abc", ""),
        ("COVID-19 Nursing Home Data", "text/csv", "https://x/old.csv", "2023-12-01"), ("COVID-19 Nursing Home Data", "text/csv", "https://x/new.csv", "2024-01-01"),
        ("Opt Out Affidavits", "application/json", "https://x/o.json", ""), ("Opt Out Affidavits", "text/csv", "https://x/OptOut_March2024.csv", ""),
    ]
    catalog = spark.createDataFrame(rows, "title string, mediaType string, downloadURL string, modified string")
    got = {(r.folder, r.file_name): r.downloadURL for r in run_release_selection(spark, catalog, f"{tmp_folder}/none", dt.date(2024, 1, 9)).collect()}
    assert got == {
        ("pc_hospice_owner", "own.csv"): "https://x/own.csv", ("mupdme", "mup_dme_r19_p08_v10_d15_prvr.csv"): f"https://x/{dme}",
        ("reval", "revalidationreassignmentlist202401.csv"): "https://x/abc",
        ("covid19nursinghomes", "covid19_nursing_home_data_2024-01-09.csv"): "https://x/new.csv", ("optout", "OptOut_March2024.csv"): "https://x/OptOut_March2024.csv",
    }
    write(f"{tmp_folder}/src/pc_hospice_owner", "own.csv", "A\n")
    left = plan_downloads(catalog, DOWNLOADS, present_files(spark, f"{tmp_folder}/src"), "2024-01-09")
    assert {r.folder for r in left.collect()} == {f for f, _ in got} - {"pc_hospice_owner"}
