"""Specs of the snapshot feeds (job C2: only periods not loaded yet are read and appended)
and of the newest-only, reference and category feeds (C7, C6, C3)."""

from __future__ import annotations

from relcast.spec import DateRule, SuffixTyping, TableSpec

# Date formats accepted where the published feeds leave the format to a guessing parser.
GUESSED_DATE_FORMATS = ("MM/dd/yyyy", "M/d/yyyy", "yyyy-MM-dd", "MM/dd/yy", "M/d/yy", "yyyyMMdd")

# Double suffixes, string columns and renames of the geographic-variation feed.
GEO_DOUBLE_SUFFIXES = ("_amt", "_pcc", "_pymt", "_per_1000_benes", "_pct", "_per_user", "_pc", "_pu", "_avg_age",
                       "_rate", "_scre")
GEO_STRINGS = ("bene_geo_lvl", "bene_geo_desc", "bene_geo_cd", "bene_age_lvl")
GEO_RENAMES = {
    "benes_ever_ma_cnt": "benes_ma_cnt",
    "ever_ma_prtcptn_rate": "ma_prtcptn_rate",
    "asc_events_per_1000_benes": "asc_evnts_per_1000_benes",
    "hh_cvrd_stays_per_1000_benes": "hh_episodes_per_1000_benes",
}

# Typed columns of the nursing-home weekly feed.
COVID_INTS = (
    "residents_weekly_confirmed_covid19", "residents_total_confirmed_covid19", "residents_weekly_all_deaths",
    "residents_total_all_deaths", "residents_weekly_covid19_deaths", "residents_total_covid19_deaths",
    "number_of_all_beds", "total_number_of_occupied_beds", "residents_hospitalizations_with_confirmed_covid19",
    "residents_hospitalizations_with_confirmed_covid19_and_up_to_date_with_vaccines",
    "staff_weekly_confirmed_covid19", "staff_total_confirmed_covid19",
    "number_of_residents_who_are_up_to_date_on_covid19_vaccinations_14_days_or_more_before_positive_test",
    "number_of_residents_staying_in_this_facility_for_at_least_1_day_this_week",
    "number_of_all_healthcare_personnel_eligible_to_work_in_this_facility_for_at_least_1_day_this_week",
    "number_of_residents_staying_in_this_facility_for_at_least_1_day_this_week_up_to_date_with_covid19_vaccines",
    "number_of_healthcare_personnel_eligible_to_work_in_this_facility_for_at_least_1_day_this_week_up_to_date_with_covid19_vaccines",
)
COVID_DOUBLES = (
    "weekly_resident_confirmed_covid19_cases_per_1000_residents",
    "weekly_resident_covid19_deaths_per_1000_residents",
    "total_resident_confirmed_covid19_cases_per_1000_residents",
    "total_resident_covid19_deaths_per_1000_residents",
    "recent_percentage_of_current_residents_up_to_date_with_covid19_vaccines",
    "percentage_of_current_residents_up_to_date_with_covid19_vaccines",
    "recent_percentage_of_current_healthcare_personnel_up_to_date_with_covid19_vaccines",
    "percentage_of_current_healthcare_personnel_up_to_date_with_covid19_vaccines",
)

# Facility types of the enrolment and ownership feeds.
FACILITY_TYPES = ("hospital", "snf", "homehealth", "fqhc", "hospice", "ruralhealthclinic")
# Output columns of the opioid-treatment-program feed.
OTPP_COLUMNS = ("npi", "provider_name", "address_line_1", "address_line_2", "city", "state", "zip",
                "medicare_id_effective_date", "phone")

SNAPSHOT_SPECS = {
    "orderandreferring": TableSpec(name="orderandreferring", globs=("*.csv",), file_date="token2_day", load="append"),
    # Two files (physicians, non-physicians) share a date: pending is keyed by date and file name.
    "pendingilt": TableSpec(name="pendingilt", globs=("*.csv",), file_date="token2_day", load="append",
                            source_name=True, pending_on=("_input_file_date", "_source_file_name")),
    "otpp": TableSpec(name="otpp", globs=("*.csv",), file_date="last_token_day", load="append",
                      types={"medicare_id_effective_date": "date"},
                      date_formats={"medicare_id_effective_date": ("M/d/yyyy",)},
                      id_list_column="npi", output=OTPP_COLUMNS, dedupe=True),
    "reval": TableSpec(name="reval", globs=("revalidationreassignmentlist*.csv",), file_date="last8_day",
                       load="append", strip_money=False,
                       types={"group_reassignments_and_physician_assistants": "int",
                              "individual_total_employer_associations": "int"},
                       date_rules=(DateRule("suffix", "_date", ("MM/dd/yyyy",)),)),
    "geovariation": TableSpec(name="geovariation", globs=("*.csv",), file_date="last4_year", load="append",
                              renames=GEO_RENAMES, strip_money=False, markers=("*", "NA"),
                              suffix_typing=SuffixTyping(GEO_STRINGS, GEO_DOUBLE_SUFFIXES, "int")),
    "pc_provider": TableSpec(name="pc_provider", globs=("*",), file_date="last10_dotted", load="append",
                             encoding="ISO-8859-1"),
}
for _t in FACILITY_TYPES:
    SNAPSHOT_SPECS[f"pc_{_t}"] = TableSpec(
        name=f"pc_{_t}", globs=("*",), file_date="last10_dotted", load="append", encoding="ISO-8859-1",
        date_rules=(DateRule("suffix", "_date", GUESSED_DATE_FORMATS, strict=True),), ccn_column="ccn")
    SNAPSHOT_SPECS[f"pc_{_t}_owner"] = TableSpec(
        name=f"pc_{_t}_owner", globs=("*",), file_date="last10_dotted", load="append", encoding="ISO-8859-1",
        date_rules=(DateRule("contains", "_date_", GUESSED_DATE_FORMATS, strict=True),))

LATEST_SPECS = {
    "covid19nursinghomes": TableSpec(
        name="covid19nursinghomes", globs=("*.csv",), file_date="last_token_iso", load="latest", strip_money=False,
        types={**{c: "int" for c in COVID_INTS}, **{c: "double" for c in COVID_DOUBLES}, "week_ending": "date"},
        date_formats={"week_ending": ("MM/dd/yy",)}),
}

REFERENCE_SPECS = {
    "betos": TableSpec(name="betos", globs=("*",), file_date="token2_year", load="full",
                       date_rules=(DateRule("suffix", "_dt", ("MM/dd/yyyy", "M/d/yyyy")),)),
}

CATEGORY_SPECS = {
    "optout": TableSpec(
        name="optout", globs=("*",), file_date="month_year", load="full",
        types={"optout_effective_date": "date_strict", "optout_end_date": "date_strict", "last_updated": "date_strict"},
        date_formats={c: GUESSED_DATE_FORMATS for c in ("optout_effective_date", "optout_end_date", "last_updated")}),
}
