"""Descriptions of the documented feeds, shown as table and column comments (K5)."""

from __future__ import annotations

PERIOD_TEXT = "period of the release file that a row was read from"

#: feed -> (text of the table, texts of its columns)
DOCUMENTATION: dict[str, tuple[str, dict[str, str]]] = {
    "betos": (
        "Taxonomy of Part B service codes: every code has a category, a subcategory and a family, "
        "so that services can be added up in clinical groups. One release a year.",
        {
            "hcpcs_cd": "service code that is classified",
            "rbcs_id": "full taxonomy key: category, subcategory, family and major-procedure flag, six characters",
            "rbcs_cat": "category, the first character of the key",
            "rbcs_cat_desc": "name of the category",
            "rbcs_cat_subcat": "category and subcategory, the first two characters of the key",
            "rbcs_subcat_desc": "name of the subcategory",
            "rbcs_famnumb": "family, characters three to five of the key",
            "rbcs_family_desc": "name of the family",
            "rbcs_major_ind": "last character of the key: whether the service is a major procedure",
            "hcpcs_cd_add_dt": "first day on which the service code is valid",
            "hcpcs_cd_end_dt": "last day on which the service code is valid",
            "rbcs_assignment_eff_dt": "first day on which this classification of the code applies",
            "_input_file_date": PERIOD_TEXT,
        },
    ),
    "geovariation": (
        "Use, spending and quality of care in Original Medicare by nation, state and county, one release a year. "
        "Standardised amounts leave out regional differences in payment rates.",
        {"_input_file_date": PERIOD_TEXT},
    ),
    "orderandreferring": (
        "Practitioners who may order items and refer patients in Medicare, with what each is entitled to. "
        "Every release is a full list.",
        {
            "npi": "national provider identifier",
            "last_name": "family name of the practitioner",
            "first_name": "given name of the practitioner",
            "partb": "whether Part B services may be ordered",
            "dme": "whether durable medical equipment may be ordered",
            "hha": "whether patients may be referred to home health agencies",
            "pmd": "whether power mobility devices may be ordered",
            "hospice": "whether patients may be referred to hospices",
            "_input_file_date": PERIOD_TEXT,
        },
    ),
    "otpp": (
        "Providers that are enrolled for opioid treatment programmes, one row per provider identifier. Weekly lists.",
        {
            "npi": "national provider identifier; lists of several are split into rows",
            "provider_name": "name under which the provider is enrolled",
            "address_line_1": "street address",
            "address_line_2": "street address, continued",
            "city": "city",
            "state": "state, abbreviated",
            "zip": "postal code",
            "medicare_id_effective_date": "day from which the enrolment is valid",
            "phone": "telephone number",
            "_input_file_date": PERIOD_TEXT,
        },
    ),
    "pendingilt": (
        "Initial enrolment applications that a contractor has not yet reviewed, physicians and others in "
        "separate files of the same day. Weekly lists.",
        {
            "npi": "national provider identifier of the applicant",
            "last_name": "family name of the applicant",
            "first_name": "given name of the applicant",
            "_input_file_date": PERIOD_TEXT,
            "_source_file_name": "release file, which tells physicians from others",
        },
    ),
}
