"""Which catalogue titles belong to which feed, and the download plan over them."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relcast.functions.filedates import name_of
from relcast.operators.feeds import Download, plan_downloads
from relcast.session import hadoop_path
from relcast.specs.utilisation import DME_DOWNLOAD_RENAMES

# Download names of geographic-variation files whose published name carries no single year.
GEO_DOWNLOAD_RENAMES = {
    "2014-2022%20Medicare%20FFS%20Geographic%20Variation%20Public%20Use%20File.csv": "medicare_geographic_variation_2022.csv",
    "Geographic%20Variation%20Public%20Use%20File%20State%20County.csv": "medicare_geographic_variation_2021.csv",
}

# Title phrases of the published feeds and the folder each is kept in.
DOWNLOADS = (
    Download("mupphy", "Medicare Physician & Other Practitioners - by"),
    Download("mupdpr", "Medicare Part D Prescribers - by"),
    Download("mupdme", "Medicare Durable Medical Equipment, Devices & Supplies - by", renames=DME_DOWNLOAD_RENAMES),
    Download("reval", "Revalidation Reassignment List", by_title=True),
    Download("reval", "Revalidation Clinic Group Practice Reassignment", by_title=True),
    Download("optout", "Opt Out Affidavits"),
    Download("mupohp", "Medicare Outpatient Hospitals - by"),
    Download("muppac", "Medicare Post-Acute Care and Hospice - by"),
    Download("mupihp", "Medicare Inpatient Hospitals - by"),
    Download("geovariation", "Medicare Geographic Variation", renames=GEO_DOWNLOAD_RENAMES),
    Download("covid19nursinghomes", "COVID-19 Nursing Home Data", fixed="covid19_nursing_home_data_{date}.csv"),
    Download("orderandreferring", "Order and Referring"),
    Download("pendingilt", "Pending Initial Logging"),
    Download("otpp", "Opioid Treatment Program Providers"),
    Download("betos", "Restructured BETOS Classification System", fixed="rbcs_2023_taxonomy.csv"),
    Download("pc_hospital", "Hospital Enrollments"),
    Download("pc_hospice", "Hospice Enrollments"),
    Download("pc_homehealth", "Home Health Agency Enrollments"),
    Download("pc_fqhc", "Federally Qualified Health Center Enrollments"),
    Download("pc_ruralhealthclinic", "Rural Health Clinic Enrollments"),
    Download("pc_snf", "Skilled Nursing Facility Enrollments"),
    Download("pc_provider", "Medicare Fee-For-Service Public Provider Enrollment"),
    Download("pc_hospital_owner", "Hospital All Owners"),
    # Owner files of hospices belong to the owner feed, not to the home-health facilities.
    Download("pc_hospice_owner", "Hospice All Owners"),
    Download("pc_homehealth_owner", "Home Health Agency All Owners"),
    Download("pc_fqhc_owner", "Federally Qualified Health Center All Owners"),
    Download("pc_ruralhealthclinic_owner", "Rural Health Clinic All Owners"),
    Download("pc_snf_owner", "Skilled Nursing Facility All Owners"),
)


def present_files(spark: SparkSession, source_root: str) -> DataFrame:
    """(folder, file_name) of every file below ``<source_root>/<folder>/``."""
    fs, path = hadoop_path(spark, source_root)
    if not fs.exists(path):
        return spark.createDataFrame([], "folder string, file_name string")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source_root).select("path")
    return files.select(F.element_at(F.split("path", "/"), -2).alias("folder"), name_of("path").alias("file_name"))


def run_release_selection(spark: SparkSession, catalog: DataFrame, source_root: str, as_of: dt.date | None = None) -> DataFrame:
    """The files that are still to be fetched into ``source_root``, for all feeds at once."""
    return plan_downloads(catalog, DOWNLOADS, present_files(spark, source_root), (as_of or dt.date.today()).isoformat())
