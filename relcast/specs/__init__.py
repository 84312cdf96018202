"""Declarative specs of every published feed and a runner that loads a feed by name.

``run_feed(spark, name, source_root, target_root)`` reads release files from
``<source_root>/<folder>`` and writes the table to ``<target_root>/<name>``
with the load mode of the feed's job (period replace, snapshot append,
newest-only, full replace with corrections).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from relcast.plans import jobs
from relcast.specs.documentation import DOCUMENTATION, PERIOD_TEXT
from relcast.specs.snapshots import (
    CATEGORY_SPECS,
    FACILITY_TYPES,
    LATEST_SPECS,
    REFERENCE_SPECS,
    SNAPSHOT_SPECS,
)
from relcast.specs.utilisation import UTILISATION_SPECS

JOBS = {
    "period": jobs.ingest_periods,
    "append": jobs.ingest_snapshots,
    "latest": jobs.ingest_latest,
    "full": jobs.ingest_reference,
}

FEEDS = {**UTILISATION_SPECS, **SNAPSHOT_SPECS, **LATEST_SPECS, **REFERENCE_SPECS, **CATEGORY_SPECS}


def source_folder(name: str) -> str:
    """Release folder of a feed: utilisation sub-levels share their family's folder;
    hospice owner files are routed to the owner feed's own folder."""
    if name in UTILISATION_SPECS:
        return name.split("_", 1)[0]
    return name


# Short descriptions used as table comments when a feed is registered in the catalog.
DESCRIPTIONS = {
    "utilisation": "Yearly utilisation and payment summary; one period per data year, newest release wins.",
    "snapshot": "Periodic snapshot list; one period per published file date, periods appended as they appear.",
    "latest": "Newest weekly file only.",
    "reference": "Reference classification per year.",
    "category": "Monthly list; latest row per npi per month, category spelling corrected.",
}


def _describe(name: str) -> str:
    if name in UTILISATION_SPECS:
        return DESCRIPTIONS["utilisation"]
    if name in CATEGORY_SPECS:
        return DESCRIPTIONS["category"]
    if name in LATEST_SPECS:
        return DESCRIPTIONS["latest"]
    if name in REFERENCE_SPECS:
        return DESCRIPTIONS["reference"]
    return DESCRIPTIONS["snapshot"]


def run_feed(spark: SparkSession, name: str, source_root: str, target_root: str,
             register_as: str | None = None) -> DataFrame:
    """Load one feed; with ``register_as`` the folder is also exposed as a documented catalog table."""
    spec = FEEDS[name]
    folder = f"{source_root.rstrip('/')}/{source_folder(name)}"
    target = f"{target_root.rstrip('/')}/{name}"
    if name in CATEGORY_SPECS:
        out = jobs.ingest_categories(spark, spec, folder, target)
    else:
        out = JOBS[spec.load](spark, spec, folder, target)
    if register_as:
        from relcast.plans.docs import document, register_table

        register_table(spark, register_as, target)
        text, columns = DOCUMENTATION.get(name, (_describe(name), {"_input_file_date": PERIOD_TEXT}))
        document(spark, register_as, spec.table_comment or text, {**columns, **spec.column_comments})
    return out


def run_crosswalk(spark: SparkSession, target_root: str, use_remapped: bool = False) -> DataFrame:
    """C4 over the six enrolled-facility tables (raw CCN by default, or the remapped one)."""
    root = target_root.rstrip("/")
    out = jobs.build_crosswalk(spark, {t: f"{root}/pc_{t}" for t in FACILITY_TYPES},
                               id_col="ccn_remapped" if use_remapped else "ccn")
    jobs.write_full(out, f"{root}/otherid_ccn_se")
    return out
