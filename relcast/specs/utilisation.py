"""Specs of the yearly utilisation feeds (job C1: newest release per data year, period replace).

File names carry the data year as ``_d[y]NN_`` and the release year as
``_r[y]NN_`` (the post-acute feed slices them from the stem instead).
"""

from __future__ import annotations

from relcast.spec import TableSpec

# Column groups and per-table typed column names, as published by the feeds.
DEMO_COUNTS = (
    "bene_age_lt_65_cnt", "bene_age_65_74_cnt", "bene_age_75_84_cnt", "bene_age_gt_84_cnt", "bene_feml_cnt",
    "bene_male_cnt", "bene_race_wht_cnt", "bene_race_black_cnt", "bene_race_api_cnt", "bene_race_hspnc_cnt",
    "bene_race_natind_cnt", "bene_race_othr_cnt", "bene_dual_cnt", "bene_ndual_cnt",
)

CC_V2_PCT = (
    "bene_cc_bh_adhd_othcd_v1_pct", "bene_cc_bh_alcohol_drug_v1_pct", "bene_cc_bh_tobacco_v1_pct",
    "bene_cc_bh_alz_nonalzdem_v2_pct", "bene_cc_bh_anxiety_v1_pct", "bene_cc_bh_bipolar_v1_pct",
    "bene_cc_bh_mood_v2_pct", "bene_cc_bh_depress_v1_pct", "bene_cc_bh_pd_v1_pct", "bene_cc_bh_ptsd_v1_pct",
    "bene_cc_bh_schizo_othpsy_v1_pct", "bene_cc_ph_asthma_v2_pct", "bene_cc_ph_afib_v2_pct",
    "bene_cc_ph_cancer6_v2_pct", "bene_cc_ph_ckd_v2_pct", "bene_cc_ph_copd_v2_pct", "bene_cc_ph_diabetes_v2_pct",
    "bene_cc_ph_hf_nonihd_v2_pct", "bene_cc_ph_hyperlipidemia_v2_pct", "bene_cc_ph_hypertension_v2_pct",
    "bene_cc_ph_ischemicheart_v2_pct", "bene_cc_ph_osteoporosis_v2_pct", "bene_cc_ph_parkinson_v2_pct",
    "bene_cc_ph_arthritis_v2_pct", "bene_cc_ph_stroke_tia_v2_pct",
)

CC_LEGACY = {
    "bene_cc_asthma_pct": "bene_cc_ph_asthma_v2_pct",
    "bene_cc_af_pct": "bene_cc_ph_afib_v2_pct",
    "bene_cc_cncr_pct": "bene_cc_ph_cancer6_v2_pct",
    "bene_cc_ckd_pct": "bene_cc_ph_ckd_v2_pct",
    "bene_cc_copd_pct": "bene_cc_ph_copd_v2_pct",
    "bene_cc_dbts_pct": "bene_cc_ph_diabetes_v2_pct",
    "bene_cc_chf_pct": "bene_cc_ph_hf_nonihd_v2_pct",
    "bene_cc_hyplpdma_pct": "bene_cc_ph_hyperlipidemia_v2_pct",
    "bene_cc_hyprtnsn_pct": "bene_cc_ph_hypertension_v2_pct",
    "bene_cc_ihd_pct": "bene_cc_ph_ischemicheart_v2_pct",
    "bene_cc_opo_pct": "bene_cc_ph_osteoporosis_v2_pct",
    "bene_cc_strok_pct": "bene_cc_ph_stroke_tia_v2_pct",
    "bene_cc_alzhmr_pct": "bene_cc_bh_alz_nonalzdem_v2_pct",
    "bene_cc_dprssn_pct": "bene_cc_bh_depress_v1_pct",
    "bene_cc_raoa_pct": "bene_cc_ph_arthritis_v2_pct",
    "bene_cc_sz_pct": "bene_cc_bh_schizo_othpsy_v1_pct",
}

MUPPHY_INTS = (
    "tot_benes", "tot_bene_day_srvcs",
)

MUPPHY_DOUBLES = (
    "avg_sbmtd_chrg", "tot_srvcs", "avg_mdcr_alowd_amt", "avg_mdcr_pymt_amt", "avg_mdcr_stdzd_amt",
)

MUPPHY_PRVDR_INTS = (
    "tot_hcpcs_cds", "tot_benes", "drug_tot_benes", "drug_tot_hcpcs_cds", "med_tot_benes", "med_tot_hcpcs_cds",
) + DEMO_COUNTS

MUPPHY_PRVDR_DOUBLES = (
    "tot_srvcs", "drug_tot_srvcs", "med_tot_srvcs", "tot_sbmtd_chrg", "tot_mdcr_alowd_amt", "tot_mdcr_pymt_amt",
    "tot_mdcr_stdzd_amt", "drug_sbmtd_chrg", "drug_mdcr_alowd_amt", "drug_mdcr_pymt_amt", "drug_mdcr_stdzd_amt",
    "med_sbmtd_chrg", "med_mdcr_alowd_amt", "med_mdcr_pymt_amt", "med_mdcr_stdzd_amt", "bene_avg_age",
    "bene_avg_risk_scre",
) + CC_V2_PCT

MUPPHY_GEO_INTS = (
    "tot_benes", "tot_bene_day_srvcs", "tot_rndrng_prvdrs",
)

MUPPHY_GEO_DOUBLES = (
    "avg_sbmtd_chrg", "tot_srvcs", "avg_mdcr_alowd_amt", "avg_mdcr_pymt_amt", "avg_mdcr_stdzd_amt",
)

MUPIHP_INTS = (
    "tot_dschrgs",
)

MUPIHP_DOUBLES = (
    "avg_submtd_cvrd_chrg", "avg_tot_pymt_amt", "avg_mdcr_pymt_amt",
)

MUPIHP_PRVDR_INTS = (
    "tot_dschrgs", "tot_benes", "tot_cvrd_days", "tot_days",
) + DEMO_COUNTS

MUPIHP_PRVDR_DOUBLES = (
    "bene_avg_age", "tot_submtd_cvrd_chrg", "tot_pymt_amt", "tot_mdcr_pymt_amt", "avg_tot_sbmtd_chrgs",
    "avg_mdcr_alowd_amt", "avg_mdcr_pymt_amt", "avg_mdcr_outlier_amt", "bene_avg_risk_scre",
) + CC_V2_PCT

MUPIHP_GEO_INTS = (
    "tot_dschrgs",
)

MUPIHP_GEO_DOUBLES = (
    "avg_submtd_cvrd_chrg", "avg_tot_pymt_amt", "avg_mdcr_pymt_amt",
)

MUPPAC_GEO_INTS = (
    "bene_dstnct_cnt", "tot_espd_stay_cnt", "tot_srvc_days",
)

MUPPAC_GEO_DOUBLES = (
    "tot_chrg_amt", "tot_alowd_amt", "tot_mdcr_pymt_amt", "tot_mdcr_stdzd_pymt_amt", "tot_outlier_pymt_amt",
    "bene_dual_pct", "bene_rrl_pct", "bene_avg_age", "bene_male_pct", "bene_feml_pct", "bene_race_wht_pct",
    "bene_race_black_pct", "bene_race_api_pct", "bene_race_hspnc_pct", "bene_race_natind_pct", "bene_race_unk_pct",
    "bene_race_othr_pct", "bene_avg_risk_scre", "bene_avg_cc_cnt", "bene_cc_af_pct", "bene_cc_alzhmr_pct",
    "bene_cc_asthma_pct", "bene_cc_cncr_pct", "bene_cc_chf_pct", "bene_cc_ckd_pct", "bene_cc_copd_pct",
    "bene_cc_dprssn_pct", "bene_cc_dbts_pct", "bene_cc_hyplpdma_pct", "bene_cc_hyprtnsn_pct", "bene_cc_ihd_pct",
    "bene_cc_opo_pct", "bene_cc_raoa_pct", "bene_cc_sz_pct", "bene_cc_strok_pct", "prmry_dx_infctn_pct",
    "prmry_dx_neobld_pct", "prmry_dx_endonutrmet_pct", "prmry_dx_mntbehneudis_pct", "prmry_dx_nervsystm_pct",
    "prmry_dx_entsys_pct", "prmry_dx_circsystm_pct", "prmry_dx_rspsystm_pct", "prmry_dx_digsystm_pct",
    "prmry_dx_sknmussystm_pct", "prmry_dx_gusystm_pct", "prmry_dx_prgpericong_pct", "prmry_dx_sxilldef_pct",
    "prmry_dx_injpois_pct", "prmry_dx_hlthsrv_pct", "nrsng_visits_cnt", "msw_visits_cnt", "aide_visits_cnt",
    "tot_nrsng_mnts", "tot_pt_mnts", "indvdl_pt_mnts", "cncrnt_grp_pt_mnts", "cotrt_pt_mnts", "tot_ot_mnts",
    "indvdl_ot_mnts", "cncrnt_grp_ot_mnts", "cotrt_ot_mnts", "tot_slp_mnts", "indvdl_slp_mnts",
    "cncrnt_grp_slp_mnts", "cotrt_slp_mnts", "hospc_rhc_days_pct", "tot_hh_lupa_epsds_cnt",
)

MUPDPR_INTS = (
    "tot_clms", "tot_day_suply", "tot_benes", "ge65_tot_clms", "ge65_tot_day_suply", "ge65_tot_benes",
)

MUPDPR_DOUBLES = (
    "tot_30day_fills", "tot_drug_cst", "ge65_tot_30day_fills", "ge65_tot_drug_cst",
)

MUPDPR_PRVDR_INTS = (
    "tot_clms", "tot_day_suply", "tot_benes", "ge65_tot_clms", "ge65_tot_day_suply", "ge65_tot_benes",
    "brnd_tot_clms", "gnrc_tot_clms", "othr_tot_clms", "mapd_tot_clms", "pdp_tot_clms", "lis_tot_clms",
    "nonlis_tot_clms", "opioid_tot_clms", "opioid_tot_suply", "opioid_tot_benes", "opioid_la_tot_clms",
    "opioid_la_tot_suply", "opioid_la_tot_benes", "antbtc_tot_clms", "antbtc_tot_benes", "antpsyct_ge65_tot_clms",
    "antpsyct_ge65_tot_benes",
) + DEMO_COUNTS

MUPDPR_PRVDR_DOUBLES = (
    "tot_30day_fills", "tot_drug_cst", "ge65_tot_30day_fills", "ge65_tot_drug_cst", "brnd_tot_drug_cst",
    "gnrc_tot_drug_cst", "othr_tot_drug_cst", "mapd_tot_drug_cst", "pdp_tot_drug_cst", "lis_drug_cst",
    "nonlis_tot_cst", "opioid_tot_drug_cst", "opioid_prscrbr_rate", "opioid_la_tot_drug_cst",
    "opioid_la_prscrbr_rate", "antbtc_tot_drug_cst", "antpsyct_ge65_tot_drug_cst", "bene_avg_age",
    "bene_avg_risk_scre",
)

MUPDPR_GEO_INTS = (
    "tot_prscrbrs", "tot_clms", "tot_benes", "ge65_tot_clms", "ge65_tot_benes",
)

MUPDPR_GEO_DOUBLES = (
    "tot_30day_fills", "tot_drug_cst", "ge65_tot_30day_fills", "ge65_tot_drug_cst", "lis_bene_cst_shr",
    "nonlis_bene_cst_shr",
)

MUPOHP_INTS = (
    "bene_cnt", "capc_srvcs", "outlier_srvcs",
)

MUPOHP_DOUBLES = (
    "avg_tot_sbmtd_chrgs", "avg_mdcr_alowd_amt", "avg_mdcr_pymt_amt", "avg_mdcr_stdzd_amt", "avg_mdcr_outlier_amt",
)

MUPOHP_GEO_INTS = (
    "bene_cnt", "capc_srvcs", "outlier_srvcs",
)

MUPOHP_GEO_DOUBLES = (
    "avg_tot_sbmtd_chrgs", "avg_mdcr_alowd_amt", "avg_mdcr_pymt_amt", "avg_mdcr_outlier_amt",
)

MUPDME_INTS = (
    "tot_suplrs", "tot_suplr_benes", "tot_suplr_clms", "tot_suplr_srvcs",
)

MUPDME_DOUBLES = (
    "avg_suplr_sbmtd_chrg", "avg_suplr_mdcr_alowd_amt", "avg_suplr_mdcr_pymt_amt", "avg_suplr_mdcr_stdzd_amt",
)

MUPDME_PRVDR_INTS = (
    "tot_suplrs", "tot_suplr_benes", "tot_suplr_clms", "tot_suplr_srvcs", "tot_suplr_hcpcs_cds", "dme_tot_suplrs",
    "dme_tot_suplr_hcpcs_cds", "dme_tot_suplr_benes", "dme_tot_suplr_clms", "dme_tot_suplr_srvcs",
    "pos_tot_suplrs", "pos_tot_suplr_hcpcs_cds", "pos_tot_suplr_benes", "pos_tot_suplr_clms",
    "pos_tot_suplr_srvcs", "drug_tot_suplrs", "drug_tot_suplr_hcpcs_cds", "drug_tot_suplr_benes",
    "drug_tot_suplr_clms", "drug_tot_suplr_srvcs",
) + DEMO_COUNTS

MUPDME_PRVDR_DOUBLES = (
    "suplr_sbmtd_chrgs", "suplr_mdcr_alowd_amt", "suplr_mdcr_pymt_amt", "suplr_mdcr_stdzd_pymt_amt",
    "dme_suplr_sbmtd_chrgs", "dme_suplr_mdcr_alowd_amt", "dme_suplr_mdcr_pymt_amt",
    "dme_suplr_mdcr_stdzd_pymt_amt", "pos_suplr_sbmtd_chrgs", "pos_suplr_mdcr_alowd_amt",
    "pos_suplr_mdcr_pymt_amt", "pos_suplr_mdcr_stdzd_pymt_amt", "drug_suplr_sbmtd_chrgs",
    "drug_suplr_mdcr_alowd_amt", "drug_suplr_mdcr_pymt_amt", "drug_suplr_mdcr_stdzd_pymt_amt", "bene_avg_age",
    "bene_avg_risk_scre",
) + CC_V2_PCT

MUPDME_GEO_INTS = (
    "tot_suplrs", "tot_suplr_benes", "tot_suplr_clms", "tot_suplr_srvcs", "tot_rfrg_prvdrs",
)

# The source runs the first two names together; they are two columns.
MUPDME_GEO_DOUBLES = (
    "avg_suplr_mdcr_alowd_amt", "avg_suplr_mdcr_pymt_amt", "avg_suplr_sbmtd_chrg", "avg_suplr_mdcr_stdzd_amt",
)

MUPDME_SUPHPR_INTS = (
    "tot_suplrs", "tot_suplr_benes", "tot_suplr_clms", "tot_suplr_srvcs",
)

MUPDME_SUPHPR_DOUBLES = (
    "avg_suplr_sbmtd_chrg", "avg_suplr_mdcr_alowd_amt", "avg_suplr_mdcr_pymt_amt", "avg_suplr_mdcr_stdzd_amt",
)

MUPDME_SUP_INTS = (
    "tot_suplrs", "tot_suplr_benes", "tot_suplr_clms", "tot_suplr_srvcs", "tot_suplr_hcpcs_cds", "dme_tot_suplrs",
    "dme_tot_suplr_hcpcs_cds", "dme_tot_suplr_benes", "dme_tot_suplr_clms", "dme_tot_suplr_srvcs",
    "pos_tot_suplrs", "pos_tot_suplr_hcpcs_cds", "pos_tot_suplr_benes", "pos_tot_suplr_clms",
    "pos_tot_suplr_srvcs", "drug_tot_suplrs", "drug_tot_suplr_hcpcs_cds", "drug_tot_suplr_benes",
    "drug_tot_suplr_clms", "drug_tot_suplr_srvcs",
) + DEMO_COUNTS

MUPDME_SUP_DOUBLES = (
    "suplr_sbmtd_chrgs", "suplr_mdcr_alowd_amt", "suplr_mdcr_pymt_amt", "suplr_mdcr_stdzd_pymt_amt",
    "dme_suplr_sbmtd_chrgs", "dme_suplr_mdcr_alowd_amt", "dme_suplr_mdcr_pymt_amt",
    "dme_suplr_mdcr_stdzd_pymt_amt", "pos_suplr_sbmtd_chrgs", "pos_suplr_mdcr_alowd_amt",
    "pos_suplr_mdcr_pymt_amt", "pos_suplr_mdcr_stdzd_pymt_amt", "drug_suplr_sbmtd_chrgs",
    "drug_suplr_mdcr_alowd_amt", "drug_suplr_mdcr_pymt_amt", "drug_suplr_mdcr_stdzd_pymt_amt", "bene_avg_age",
    "bene_avg_risk_scre",
) + CC_V2_PCT

# Legacy renames of the durable-equipment feeds.
DME_MAIN_LEGACY = {
    "rfrg_prvdr_last_name": "rfrg_prvdr_last_name_org",
    "rfrg_crdntls": "rfrg_prvdr_crdntls",
    "rfrg_ent_cd": "rfrg_prvdr_ent_cd",
    "betos_lvl": "rbcs_lvl",
    "betos_cd": "rbcs_id",
    "betos_desc": "rbcs_desc",
    "rfrg_prvdr_type": "rfrg_prvdr_spclty_desc",
    "rfrg_prvdr_type_flag": "rfrg_prvdr_spclty_srce",
}
DME_PROVIDER_LEGACY = {
    "rfrg_prvdr_last_name": "rfrg_prvdr_last_name_org",
    "rfrg_prvdr_gnder": "rfrg_prvdr_gndr",
    "pos_tot_suplr_suplrs": "pos_tot_suplrs",
    "drug_tot_suplr_suplrs": "drug_tot_suplrs",
    "drug_tot_suplr_sbmtd_chrgs": "drug_suplr_sbmtd_chrgs",
    **CC_LEGACY,
    "rfrg_prvdr_type": "rfrg_prvdr_spclty_desc",
    "rfrg_prvdr_type_flag": "rfrg_prvdr_spclty_srce",
}
DME_BETOS_LEGACY = {"betos_lvl": "rbcs_lvl", "betos_cd": "rbcs_id", "betos_desc": "rbcs_desc"}
# Marker text left in a column by rows broken on a quoted wheelchair description.
DME_BROKEN_ROW_MARKER = ' or ultralightweight wheelchair"'

# Ruling on the written lists: the post-acute feed's 16 legacy chronic-condition
# columns are renamed before typing, so their new names are typed as double too.
MUPPAC_GEO_DOUBLES_EFFECTIVE = MUPPAC_GEO_DOUBLES + tuple(CC_LEGACY[c] for c in CC_LEGACY if c in MUPPAC_GEO_DOUBLES)


def _types(ints, doubles) -> dict[str, str]:
    out = {c: "int" for c in ints}
    out.update({c: "double" for c in doubles})
    return out


def _spec(name, globs, ints, doubles, renames=None, release="release_year", file_date="data_year", **kw) -> TableSpec:
    return TableSpec(name=name, globs=tuple(globs), file_date=file_date, release=release, load="period",
                     renames=dict(renames or {}), types=_types(ints, doubles), source_name=True, **kw)


UTILISATION_SPECS = {
    s.name: s for s in (
        _spec("mupphy", ["*_Prov_Svc*"], MUPPHY_INTS, MUPPHY_DOUBLES),
        _spec("mupphy_prvdr", ["*_Prov.csv"], MUPPHY_PRVDR_INTS, MUPPHY_PRVDR_DOUBLES, CC_LEGACY),
        _spec("mupphy_geo", ["*_Geo.csv"], MUPPHY_GEO_INTS, MUPPHY_GEO_DOUBLES),
        _spec("mupihp", ["*_PRVSVC*", "*_PrvSvc*"], MUPIHP_INTS, MUPIHP_DOUBLES),
        _spec("mupihp_prvdr", ["*_PRV.*", "*_Prv.*"], MUPIHP_PRVDR_INTS, MUPIHP_PRVDR_DOUBLES, CC_LEGACY,
              pads={"rndrng_prvdr_ccn": 6}),
        _spec("mupihp_geo", ["*_GEO.*", "*_Geo.*"], MUPIHP_GEO_INTS, MUPIHP_GEO_DOUBLES),
        _spec("muppac_geo", ["*"], MUPPAC_GEO_INTS, MUPPAC_GEO_DOUBLES_EFFECTIVE, CC_LEGACY,
              release="stem_prefix_year", file_date="stem_year_slice", markers=("N/A",)),
        _spec("mupdpr", ["*_NPIBN*"], MUPDPR_INTS, MUPDPR_DOUBLES),
        _spec("mupdpr_prvdr", ["*_NPI.csv"], MUPDPR_PRVDR_INTS, MUPDPR_PRVDR_DOUBLES),
        _spec("mupdpr_geo", ["*_Geo*"], MUPDPR_GEO_INTS, MUPDPR_GEO_DOUBLES),
        _spec("mupohp", ["*_Prov_Svc*"], MUPOHP_INTS, MUPOHP_DOUBLES),
        _spec("mupohp_geo", ["*_Geo*"], MUPOHP_GEO_INTS, MUPOHP_GEO_DOUBLES),
        _spec("mupdme", ["*_prvhpr*", "*_rfrhpr*"], MUPDME_INTS, MUPDME_DOUBLES, DME_MAIN_LEGACY,
              malformed={"tot_suplrs": DME_BROKEN_ROW_MARKER}),
        _spec("mupdme_prvdr", ["*_prvr.csv", "*_Prov.csv", "*_rfrr.csv"], MUPDME_PRVDR_INTS, MUPDME_PRVDR_DOUBLES,
              DME_PROVIDER_LEGACY),
        _spec("mupdme_geo", ["*_geo*"], MUPDME_GEO_INTS, MUPDME_GEO_DOUBLES, DME_BETOS_LEGACY,
              malformed={"tot_rfrg_prvdrs": DME_BROKEN_ROW_MARKER}),
        _spec("mupdme_suphpr", ["*_suphpr*"], MUPDME_SUPHPR_INTS, MUPDME_SUPHPR_DOUBLES, DME_BETOS_LEGACY,
              malformed={"tot_suplr_benes": DME_BROKEN_ROW_MARKER}),
        _spec("mupdme_sup", ["*_supr*"], MUPDME_SUP_INTS, MUPDME_SUP_DOUBLES, DME_PROVIDER_LEGACY),
    )
}

# Download names of durable-equipment files whose published name carries no release code.
DME_DOWNLOAD_RENAMES = {
    "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20and%20Service%20Data%202013.csv": "mup_dme_r19_p08_v10_d13_prvhpr.csv",
    "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20and%20Service%20Data%202014_0.csv": "mup_dme_r19_p08_v10_d14_prvhpr.csv",
    "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20and%20Service%20Data%202015_0.csv": "mup_dme_r19_p08_v10_d15_prvhpr.csv",
    "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20and%20Service%20Data%202016.csv": "mup_dme_r19_p08_v10_d16_prvhpr.csv",
    "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20and%20Service%20Data%202017.csv": "mup_dme_r19_p08_v10_d17_prvhpr.csv",
    "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20Data%202015.csv": "mup_dme_r19_p08_v10_d15_prvr.csv",
    "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20Data%202016.csv": "mup_dme_r19_p08_v10_d16_prvr.csv",
    "Medicare%20Durable%20Medical%20Equipment%2C%20Devices%20%26%20Supplies%20-%20by%20Referring%20Provider%20Data%202017.csv": "mup_dme_r19_p08_v10_d17_prvr.csv",
}
