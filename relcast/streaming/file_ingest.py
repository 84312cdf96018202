"""Incremental ingest as a Structured Streaming query over a release folder.

The stream's source is the folder listing (``binaryFile``, contents pruned).
Its checkpoint, kept beside the table, remembers which files were seen. Each
micro-batch is a list of new files; ``foreachBatch`` runs the batch job of the
feed's load mode on them. Loads are idempotent, so a batch replayed after a
failure rewrites the same partitions instead of duplicating rows.

Run with ``trigger(availableNow=True)`` from a scheduler, or continuously.
The newest release of every period is the stream's state, kept by Spark with
the checkpoint: a newer release replaces the period, an older one that arrives
late is ignored, in the same batch, a later one or after a restart. The table is
not read back. Release dates carry a watermark: what is older than the newest
release seen by more than LATE_AFTER is ignored too, and the state of such
periods is dropped, so the state is bounded by that time and not by the feed's
age.
"""

from __future__ import annotations

import datetime as dt
import re
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from relcast.functions.filedates import name_of, release_date
from relcast.operators.releases import PERIOD, SOURCE_NAME, with_file_dates
from relcast.plans.jobs import pending, prepare
from relcast.plans.load import append_snapshots, replace_periods
from relcast.session import hadoop_path, materialise, release
from relcast.sources.files import is_path, read_table, table_exists
from relcast.spec import TableSpec

# The state function runs in Python workers; it travels by value, so executors need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: How long after the newest release seen an older one may still be the first of its period.
LATE_AFTER = "3653 days"

#: Load modes that can be streamed; the others need all files of a feed at once.
STREAMED_LOADS = ("period", "append")

BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def glob_regex(glob: str) -> str:
    """File-name glob (``*``, ``?``) as an anchored regular expression."""
    out = []
    for ch in glob:
        out.append(".*" if ch == "*" else "." if ch == "?" else re.escape(ch))
    return "^" + "".join(out) + "$"


def new_files_stream(spark: SparkSession, folder: str, globs, max_files: int | None = None) -> DataFrame:
    """Streaming listing of ``folder``: path, file_name, length, glob_rank (first matching glob)."""
    reader = spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    listing = reader.load(folder).select("path", "length")
    name = name_of("path")
    rank = F.lit(None).cast("int")
    for i, g in reversed(list(enumerate(globs))):
        rank = F.when(name.rlike(glob_regex(g)), F.lit(i)).otherwise(rank)
    return listing.select("path", name.alias("file_name"), "length", rank.alias("glob_rank")).where(
        F.col("glob_rank").isNotNull())


_CHOSEN = "path string, file_name string, length long, glob_rank int, data_date date, release_date date, first boolean"


def _keep_newest(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The file to load of one period, if any. The state is the newest release so far, as a day number."""
    if state.hasTimedOut:  # the watermark has passed it: whatever is older would be late
        state.remove()
        return
    files = pd.concat(list(batches), ignore_index=True)
    best = files.sort_values(["release_date", "glob_rank", "path"], ascending=[False, True, True]).iloc[[0]]
    release, first = best["release_date"].iloc[0], not state.exists
    newest = max(release.toordinal(), -1 if first else state.get[0])
    state.update((newest,))
    passed = dt.datetime.combine(dt.date.fromordinal(newest), dt.time(), dt.timezone.utc)
    state.setTimeoutTimestamp(max(int(passed.timestamp() * 1000), state.getCurrentWatermarkMs()) + 1)
    if newest == release.toordinal():
        yield best.assign(data_date=key[0], first=first)[["path", "file_name", "length", "glob_rank", "data_date", "release_date", "first"]]


def newest_releases(files: DataFrame, late_after: str = LATE_AFTER) -> DataFrame:
    """Of a stream of dated files those to load: per period and batch the newest, if no newer one was seen before.

    ``first`` marks the periods that the stream has no state of.
    """
    timed = files.withColumn("release_time", F.to_timestamp("release_date")).withWatermark("release_time", late_after)
    return timed.groupBy("data_date").applyInPandasWithState(_keep_newest, _CHOSEN, "newest long", "append", GroupStateTimeout.EventTimeTimeout)


def skip_older_releases(files: DataFrame, target: str, spec: TableSpec) -> DataFrame:
    """Drop files whose release is older than the one that a batch job has loaded for their period.

    For periods that the stream sees for the first time in a table that was
    there before it: their release is read from ``_source_file_name``.
    """
    spark = files.sparkSession
    if files.isEmpty() or not table_exists(spark, target):
        return files
    loaded = read_table(spark, target)
    if SOURCE_NAME not in loaded.columns:
        return files
    wanted = files.select(F.col("data_date").alias(PERIOD)).distinct()
    current = (loaded.select(PERIOD, SOURCE_NAME).join(wanted, PERIOD, "left_semi").distinct()
               .select(F.col(PERIOD).alias("data_date"), release_date(SOURCE_NAME, spec.release).alias("_loaded"))
               .groupBy("data_date").agg(F.max("_loaded").alias("_loaded")))
    joined = files.join(current, "data_date", "left")
    return joined.where(F.col("_loaded").isNull() | (F.col("release_date") >= F.col("_loaded"))).drop("_loaded")


def default_checkpoint(target: str) -> str:
    """Beside the table, so that every run for a table finds the files it has seen."""
    if not is_path(target):
        raise ValueError("name a checkpoint folder for a catalog table")
    return f"{target.rstrip('/')}_stream_checkpoint"


def _has_run(spark: SparkSession, checkpoint: str) -> bool:
    """Whether a stream has committed a batch there."""
    fs, path = hadoop_path(spark, f"{checkpoint.rstrip('/')}/commits")
    return fs.exists(path) and len(fs.listStatus(path)) > 0


def stream_ingest(spark: SparkSession, spec: TableSpec, folder: str, target: str, checkpoint: str | None = None,
                  available_now: bool = True, max_files: int | None = None, late_after: str = LATE_AFTER) -> StreamingQuery:
    """Start the incremental ingest of a feed; returns the running query.

    Feeds that replace the whole table (newest file only, reference, corrected
    categories) are refused: a batch of new files is not the whole feed.
    """
    if spec.load not in STREAMED_LOADS:
        raise ValueError(f"feed {spec.name} is loaded as {spec.load!r}; only {' and '.join(STREAMED_LOADS)} can be streamed")

    checkpoint = checkpoint or default_checkpoint(target)

    follows_releases = spec.load == "period" and spec.release != "none"
    # only a table that was there before the stream's first run can hold releases that its state does not know
    unknown = follows_releases and table_exists(spark, target) and not _has_run(spark, checkpoint)

    def load_batch(files: DataFrame, epoch_id: int) -> None:
        session = files.sparkSession
        chosen = materialise(files, f"stream-{spec.name}")
        held = [chosen]
        if spec.load == "append":
            chosen = pending(session, spec, chosen, target)
        elif unknown:
            chosen = chosen.where(~F.col("first")).unionByName(skip_older_releases(chosen.where("first"), target, spec))
        if spec.load == "append" or unknown:
            chosen = materialise(chosen, f"stream-{spec.name}")
            held.append(chosen)
        if not chosen.isEmpty():
            rows = prepare(session, spec, chosen)
            if spec.load == "append":
                append_snapshots(rows, target, tuple(spec.pending_on))
            else:
                replace_periods(rows, target, periods=chosen.select(F.col("data_date").alias(PERIOD)))
        for scratch in held:
            release(scratch)

    files = with_file_dates(new_files_stream(spark, folder, spec.globs, max_files), spec.file_date, spec.release)
    if follows_releases:
        files = newest_releases(files, late_after)
    writer = files.writeStream.foreachBatch(load_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()
