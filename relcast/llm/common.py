"""Shared helpers of the training-data operators: table access, written
intermediates, word rules and the connected-components job."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relcast.session import materialise, release

#: Words are runs of anything but ASCII white space.
WORD_RE = r"[^\x20\x09-\x0D]+"
#: Bytes of one Arrow batch sent to a Python worker, so that very long texts
#: cannot add up to more than this (a single longer text is its own batch).
ARROW_BATCH_BYTES = 4 << 20
_ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bound_batches(spark: SparkSession) -> None:
    """Bounds the bytes of the Arrow batches that Spark sends to Python."""
    spark.conf.set(_ARROW_BYTES, str(ARROW_BATCH_BYTES))


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, Iterable]], schema: T.StructType) -> DataFrame:
    """``fn`` maps one Arrow batch to the columns of its result.

    The result is ``df`` mapped batch by batch, with no shuffle.
    """
    bound_batches(df.sparkSession)
    arrow = _arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = fn(batch)
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read again.

    Cuts the lineage: a lost executor costs a re-read of the files only. The
    planner also sees the true size on disk, so it broadcasts a table only
    when its files are under the session's threshold.
    """
    return materialise(df, name)


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (names are compared without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def ascii_lower(col) -> F.Column:
    """Lower-cases A-Z only."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable over undirected ``edges``.

    Alternates the two star steps of Kiveris et al. until the edges are stars:
    every node links to the smallest node of its component. Only nodes that
    have an edge are returned. Each round writes its edges to the shared
    scratch folder; rounds grow with the logarithm of the longest chain. No
    edge list reaches the driver, only a count and a checksum per round. Null
    nodes and self-links are ignored.
    """
    lo, hi = F.least(F.col(a), F.col(b)), F.greatest(F.col(a), F.col(b))
    pairs = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    current = written(pairs.select(hi.alias("a"), lo.alias("b")).distinct(), "cc")
    mark = _checksum(current)
    while mark[0]:
        # small star: a node's smaller neighbours link to the smallest of them
        least = current.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        small = (current.join(least, F.col("a") == F.col("k"))
                 .select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
                 .distinct())
        small = written(small, "cc")
        # large star: a node's larger neighbours link to the smallest it knows
        least = small.groupBy(F.col("a").alias("k")).agg(F.min("b").alias("m"))
        large = (small.join(least, F.col("b") == F.col("k"), "left")
                 .select("a", F.coalesce("m", "b").alias("b")).distinct())
        after = written(large, "cc")
        release(current)
        release(small)
        current, before = after, mark
        mark = _checksum(current)
        if mark == before:
            break
    roots = current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(roots)


def _checksum(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]
