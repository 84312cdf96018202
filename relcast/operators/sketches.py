"""Approximate distinct counts that are kept beside a table, a mergeable sketch per period.

A load makes the sketch of the periods that it writes; a period that is loaded
again replaces its one sketch. Distinct counts over any periods are then unions
of sketches, and the table is not read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relcast.operators.releases import PERIOD
from relcast.plans.load import replace_periods
from relcast.sources.files import read_table, table_exists

#: Logarithm of a sketch's cells (16 KiB a sketch at most).
LOG_CELLS = 14
#: Relative standard error of a union of sketches: 1.04 / sqrt(2 ** LOG_CELLS).
STANDARD_ERROR = 1.04 / 2 ** (LOG_CELLS / 2)


def sketch_table(target: str) -> str:
    """Where the sketches of a table lie: beside it."""
    return f"{target.rstrip('/')}_sketches"


def period_sketches(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, sketch, n_rows, period): a sketch per column and period. Nulls are not counted."""
    sketches = rows.groupBy(PERIOD).agg(F.count("*").alias("n_rows"), *[F.hll_sketch_agg(F.col(f"`{c}`").cast("string"), LOG_CELLS).alias(f"s{i}") for i, c in enumerate(columns)])
    return sketches.select("n_rows", PERIOD, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)]))
                           ).select("column", "sketch", "n_rows", PERIOD)


def update_sketches(rows: DataFrame, target: str, columns: Sequence[str], periods: DataFrame | None = None) -> None:
    """Replaces the sketches of the periods of ``rows`` (or ``periods``, some of which may have no rows) beside the table ``target``."""
    replace_periods(period_sketches(rows, columns), sketch_table(target), periods=periods)


def approx_distinct(spark: SparkSession, target: str, columns: Sequence[str], first=None, last=None) -> DataFrame:
    """(column, n_distinct, n_rows, n_periods) over the periods from ``first`` to ``last``, from the sketches alone."""
    where = sketch_table(target)
    if not table_exists(spark, where):
        raise FileNotFoundError(f"no sketches beside {target}")
    kept = read_table(spark, where).where(F.col("column").isin(*columns))
    if first is not None:
        kept = kept.where(F.col(PERIOD) >= F.lit(first))
    if last is not None:
        kept = kept.where(F.col(PERIOD) <= F.lit(last))
    return kept.groupBy("column").agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"), F.sum("n_rows").alias("n_rows"), F.count("*").alias("n_periods"))
