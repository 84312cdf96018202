"""Sinks and load modes (K1-K4) on partitioned parquet.

* full replace: overwrite the whole table, whatever its partitions.
* period replace / snapshot append: dynamic partition overwrite on
  ``_input_file_date`` — only the periods of the incoming files are rewritten,
  the others stay. A period whose new release has no rows becomes empty.
  Re-running a load is idempotent.
* schema evolution: the table's schema is kept beside the data and grows with
  new columns; older periods read null for them.

Concurrent writers to one table are not coordinated (no transaction log).
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relcast.session import hadoop_path
from relcast.sources.files import is_path, merged_schema, partition_keys, save_schema, table_exists

PERIOD = "_input_file_date"


def write_full(df: DataFrame, target: str, partition_by: str | None = None) -> None:
    """K1: replace the whole table, partitions that the new data lacks included."""
    w = df.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partition_by:
        w = w.partitionBy(partition_by)
    if is_path(target):
        w.parquet(target)
        save_schema(df.sparkSession, target, df.schema)
    else:
        w.format("parquet").saveAsTable(target)


def replace_periods(df: DataFrame, target: str, period_col: str | tuple[str, ...] = PERIOD, periods: DataFrame | None = None) -> None:
    """K3: rewrite the periods present in ``df``; other periods untouched.

    ``periods`` (columns named like ``period_col``) are the periods of the
    incoming files: those that turn out to have no rows are emptied too.

    No shuffle before the write: a release file holds one period, so each scan
    split already carries a single period and its task writes its own files.
    (Clustering by period would put a whole period — possibly a third of all
    rows — into one task.)
    """
    keys = [period_col] if isinstance(period_col, str) else list(period_col)
    spark = df.sparkSession
    there = table_exists(spark, target)
    # Partitions that the load is to replace, with the files they have now.
    before = _partition_files(spark, target, keys, periods) if there and periods is not None else {}
    if is_path(target):
        save_schema(spark, target, merged_schema(spark, target, df.schema))
        (df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(target))
    elif not there:
        df.write.format("parquet").partitionBy(*keys).saveAsTable(target)
    else:
        # K4: columns new in this load are added to the table first (older periods read null).
        existing = {f.name for f in spark.table(target).schema}
        added = [f for f in df.schema if f.name not in existing]
        if added:
            spec = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
            spark.sql(f"ALTER TABLE {target} ADD COLUMNS ({spec})")
        # insertInto is positional: align to the table's column order first.
        cols = spark.table(target).columns
        aligned = df.select(*[F.col(c) if c in df.columns else F.lit(None).alias(c) for c in cols])
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        aligned.write.insertInto(target, overwrite=True)
    # A partition whose files are still those from before got no rows in this load.
    for values, (folder, files) in before.items():
        fs, path = hadoop_path(spark, folder)
        if fs.exists(path) and {s.getPath().getName() for s in fs.listStatus(path)} == files:
            if is_path(target):
                fs.delete(path, True)
            else:
                spec = ", ".join(f"`{k}` = '" + str(v).replace("'", "''") + "'" for k, v in zip(keys, values))
                spark.sql(f"ALTER TABLE {target} DROP IF EXISTS PARTITION ({spec})")
                fs.delete(path, True)


def _partition_files(spark: SparkSession, target: str, keys: list[str], periods: DataFrame) -> dict[tuple, tuple[str, set[str]]]:
    """Folder and file names of the target's partitions that are among ``periods`` (one entry per period of a load)."""
    root = target.rstrip("/")
    if not is_path(target):
        row = spark.sql(f"DESCRIBE TABLE EXTENDED {target}").where("col_name = 'Location'").first()
        root = row["data_type"].rstrip("/")
    out = {}
    for row in periods.select(*keys).distinct().join(partition_keys(spark, target, keys), keys).collect():
        folder = "/".join([root, *(f"{k}={quote(str(row[k]), safe=_PLAIN)}" for k in keys)])
        fs, path = hadoop_path(spark, folder)
        if fs.exists(path):
            out[tuple(row)] = (folder, {s.getPath().getName() for s in fs.listStatus(path)})
    return out


#: Characters that partition folder names keep as they are.
_PLAIN = " !$&()+,-.;<>@_`|~"


def append_snapshots(df: DataFrame, target: str, period_col: str | tuple[str, ...] = PERIOD) -> None:
    """K2: add new snapshot periods (the caller passes only pending files' rows).

    Written as a dynamic partition overwrite, so a retried or repeated run of
    the same periods replaces instead of duplicating. Feeds that publish
    several files per date are keyed (and partitioned) by date and file name,
    so a late second file of a date does not replace the first.
    """
    replace_periods(df, target, period_col)
