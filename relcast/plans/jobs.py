"""Composite jobs (C1-C7): one declarative plan per run instead of a loop of per-file jobs."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from relcast.operators.categories import apply_corrections, corrections
from relcast.operators.crosswalk import id_crosswalk
from relcast.operators.dedupe import drop_marked_rows, explode_ids, latest_per_key
from relcast.operators.feeds import Download, plan_downloads
from relcast.operators.releases import (
    PERIOD,
    SOURCE_NAME,
    latest_release,
    loaded_periods,
    pending_files,
    with_file_dates,
    with_provenance,
)
from relcast.operators.typed import apply_types
from relcast.plans.docs import document, register_table
from relcast.plans.load import append_snapshots, replace_periods, write_full
from relcast.session import materialise
from relcast.sources.csv import FILE_PATH, scan_csv
from relcast.sources.files import list_releases, read_table, table_exists
from relcast.sources.infer import NA_VALUES, elected, infer_types, typed_as
from relcast.spec import TableSpec


def discover(spark: SparkSession, spec: TableSpec, folder: str) -> DataFrame:
    """S6 + T16: files of a feed with their period (and release) dates."""
    return with_file_dates(list_releases(spark, folder, spec.globs), spec.file_date, spec.release)


def prepare(spark: SparkSession, spec: TableSpec, files: DataFrame) -> DataFrame:
    """Scan → broken-row filter → typing → id explode → provenance → projection/dedupe."""
    raw = scan_csv(spark, files, spec.renames, spec.encoding, spec.multi_line)
    for column, marker in spec.malformed.items():
        if column in raw.columns:
            raw = drop_marked_rows(raw, column, marker)
    typed = apply_types(raw, spec)
    if spec.id_list_column:
        typed = explode_ids(typed, spec.id_list_column, spec.id_list_column)
    out = with_provenance(typed, spec.file_date, spec.source_name)
    if spec.output:
        out = out.select(*spec.output, PERIOD)
    if spec.dedupe:
        out = out.dropDuplicates()
    return out


def ingest_periods(spark: SparkSession, spec: TableSpec, folder: str, target: str) -> DataFrame:
    """Newest release per period, each period replaced in the target (emptied, if that release has no rows)."""
    files = discover(spark, spec, folder)
    if spec.release != "none":
        files = latest_release(files)
    files = materialise(files, f"files-{spec.name}")
    replace_periods(prepare(spark, spec, files), target, periods=files.select(F.col("data_date").alias(PERIOD)))
    return read_table(spark, target)


#: Column of a file listing for each key column of a table.
FILE_KEYS = {PERIOD: "data_date", SOURCE_NAME: "file_name"}


def pending(spark: SparkSession, spec: TableSpec, files: DataFrame, target: str) -> DataFrame:
    """J1 for a feed: the files whose key is not in the target yet."""
    if not table_exists(spark, target):
        return files
    return pending_files(files, loaded_periods(spark, target, spec.pending_on), on=tuple(FILE_KEYS[k] for k in spec.pending_on),
                         loaded_on=spec.pending_on)


def ingest_snapshots(spark: SparkSession, spec: TableSpec, folder: str, target: str) -> DataFrame:
    """Only files whose period is not loaded yet are read and added."""
    files = materialise(pending(spark, spec, discover(spark, spec, folder), target), f"files-{spec.name}")
    if not files.isEmpty():
        append_snapshots(prepare(spark, spec, files), target, tuple(spec.pending_on))
    return read_table(spark, target)


def ingest_latest(spark: SparkSession, spec: TableSpec, folder: str, target: str) -> DataFrame:
    """The newest file only, whole table replaced."""
    files = discover(spark, spec, folder)
    newest = files.orderBy(F.col("data_date").desc_nulls_last(), F.col("path").desc()).limit(1)
    write_full(prepare(spark, spec, newest), target)
    return read_table(spark, target)


def ingest_reference(spark: SparkSession, spec: TableSpec, folder: str, target: str,
                     table_name: str | None = None) -> DataFrame:
    """All files of a reference feed, whole table replaced, then documented."""
    files = discover(spark, spec, folder)
    write_full(prepare(spark, spec, files), target)
    if table_name:
        register_table(spark, table_name, target)
        document(spark, table_name, spec.table_comment, spec.column_comments)
    return read_table(spark, target)


def inferred_types(spark: SparkSession, spec: TableSpec, folder: str) -> DataFrame:
    """S3/T9 as a tool: (column, type, format, rivals, n_values) over all files of a feed, to write a spec from."""
    return infer_types(_inferable(spark, spec, folder)[0].drop(FILE_PATH), na_values=(*NA_VALUES, *spec.markers))


def _inferable(spark: SparkSession, spec: TableSpec, folder: str) -> tuple[DataFrame, dict]:
    raw = scan_csv(spark, discover(spark, spec, folder), spec.renames, spec.encoding, spec.multi_line)
    for column, marker in spec.malformed.items():
        if column in raw.columns:
            raw = drop_marked_rows(raw, column, marker)
    declared = {c: (kind, None) for c, kind in spec.types.items() if kind != "date"}
    return raw, declared | {c: ("date", formats[0]) for c, formats in spec.date_formats.items()}


def ingest_inferred(spark: SparkSession, spec: TableSpec, folder: str, target: str) -> DataFrame:
    """A feed without declared types: all files, the types that hold all of their values, whole table replaced.

    Types and date formats that the spec declares are kept. Fails on a date
    column whose values fit several formats; declare its format then.
    """
    raw, declared = _inferable(spark, spec, folder)
    na_values = (*NA_VALUES, *spec.markers)
    types = elected(infer_types(raw.drop(FILE_PATH), na_values=na_values), {c: t for c, t in declared.items() if c in raw.columns})
    write_full(with_provenance(typed_as(raw, types, na_values), spec.file_date, spec.source_name), target)
    return read_table(spark, target)


def ingest_categories(spark: SparkSession, spec: TableSpec, folder: str, target: str, word: str = "specialty",
                      key: str = "npi", order: Sequence[str] = ("last_updated", "optout_end_date")) -> DataFrame:
    """C3 end to end: all monthly files, latest row per key, corrected categories, whole table replaced."""
    files = discover(spark, spec, folder)
    write_full(clean_categories(prepare(spark, spec, files), word, key, list(order)), target)
    return read_table(spark, target)


def ingest_catalog(spark: SparkSession, catalog_path: str, target: str) -> DataFrame:
    """S4 + K1: the release catalogue flattened into one row per distribution."""
    from relcast.sources.catalog import flatten_catalog, read_catalog

    write_full(flatten_catalog(read_catalog(spark, catalog_path)), target)
    return read_table(spark, target)


def clean_categories(df: DataFrame, word: str, key: str, order: Sequence[str | Column],
                     period: str = PERIOD) -> DataFrame:
    """Latest row per (period, key), then frequency-guided spelling correction of ``word``.

    The de-duplicated rows feed both the vocabulary and the final replacement;
    they are written to the shared scratch folder once instead of repeating the
    scan and the per-key shuffle.
    """
    latest = materialise(latest_per_key(df, [period, key], order), "latest-rows")
    mapping = corrections(latest, word, key)
    return apply_corrections(latest, word, mapping)


def build_crosswalk(spark: SparkSession, targets: Mapping[str, str], id_col: str = "ccn") -> DataFrame:
    """C4: crosswalk over the facility tables (by facility type)."""
    return id_crosswalk({t: read_table(spark, p) for t, p in targets.items()}, id_col=id_col)


def release_selection(catalog: DataFrame, feeds: Sequence[Download], present: DataFrame, as_of: str = "") -> DataFrame:
    """Which catalogue distributions still need fetching, into which folder, under which file name."""
    return plan_downloads(catalog, feeds, present, as_of)
