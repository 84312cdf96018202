"""Release selection over file listings (T16, G3, G4, G7, J1, J4) and provenance.

Listings and loaded periods stay distributed: they are joined like any other
table, and the planner decides by their size. Every naming rule is a Column
over the path, so provenance is a projection of the scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from relcast.functions.filedates import file_date, name_of, release_date
from relcast.sources.csv import FILE_PATH
from relcast.sources.files import partition_keys

PERIOD = "_input_file_date"
SOURCE_NAME = "_source_file_name"


def _required(value: Column, path, what: str) -> Column:
    """``value``, or an error that names the file."""
    return F.coalesce(value, F.raise_error(F.concat(F.lit(f"no {what} in the file name: "), name_of(path))).cast("date"))


def period_of(path, date_rule: str) -> Column:
    """The period of a release file; fails, with the name, on one that does not parse."""
    return _required(file_date(path, date_rule), path, "period")


def with_file_dates(listing: DataFrame, date_rule: str, release_rule: str = "none") -> DataFrame:
    """Adds ``data_date`` and ``release_date`` parsed from each file name.

    A name that does not follow its rule fails the job: dropped or undated
    files would leave periods out, or load them again on every run.
    """
    release = release_date("path", release_rule)
    if release_rule != "none":
        release = _required(release, "path", "release")
    return listing.withColumns({"data_date": period_of("path", date_rule), "release_date": release})


def latest_release(files: DataFrame) -> DataFrame:
    """Per data date the file with the greatest release date; ties go to the
    earlier glob, then the smaller path (one row per period)."""
    w = Window.partitionBy("data_date").orderBy(
        F.col("release_date").desc_nulls_last(), F.col("glob_rank").asc(), F.col("path").asc()
    )
    return files.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def latest_snapshot(df: DataFrame, date_col: str) -> DataFrame:
    """Rows of the newest date only (a one-row aggregate joined back by equality)."""
    newest = df.agg(F.max(date_col).alias("_newest"))
    return df.join(F.broadcast(newest), F.col(date_col) == F.col("_newest"), "inner").drop("_newest")


def loaded_periods(spark: SparkSession, target: str, columns: Sequence[str] = (PERIOD,)) -> DataFrame:
    """Distinct periods (or period and file) already in a table, from its partition folders alone."""
    return partition_keys(spark, target, columns)


def pending_files(files: DataFrame, loaded: DataFrame | None, on: Sequence[str] = ("data_date",),
                  loaded_on: Sequence[str] = (PERIOD,)) -> DataFrame:
    """Files whose key (period, optionally file name) is not loaded yet."""
    if loaded is None:
        return files
    keys = loaded.select(*[F.col(l).alias(o) for o, l in zip(on, loaded_on)]).distinct()
    return files.join(keys, list(on), "left_anti")


def missing_downloads(wanted: DataFrame, present: DataFrame, on: str | Sequence[str] = "file_name") -> DataFrame:
    """Wanted files that are not present yet, by name (or folder and name)."""
    on = [on] if isinstance(on, str) else list(on)
    return wanted.join(present.select(*on).distinct(), on, "left_anti")


def with_provenance(df: DataFrame, date_rule: str, source_name: bool = True) -> DataFrame:
    """Period date (and file name) of each row, projected from the scan's own file path."""
    columns = {PERIOD: period_of(FILE_PATH, date_rule)}
    if source_name:
        columns[SOURCE_NAME] = name_of(FILE_PATH)
    return df.withColumns(columns).drop(FILE_PATH)
