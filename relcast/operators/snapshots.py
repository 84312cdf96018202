"""Multiset difference of two snapshots of a table (X): what was added, removed and changed.

Rows of the older snapshot count -1, those of the newer +1. One aggregation over
all columns adds them up, map-side first, so equal rows cancel out before they
are shuffled twice or compared. Only the rows that differ are looked at again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from relcast.functions.common import free_name


def snapshot_diff(before: DataFrame, after: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Every row that stands more often in one of the two: its columns, ``change`` and ``copies``.

    ``copies`` is by how many, ``change`` is ``added`` (more in ``after``) or
    ``removed``. With ``keys``, rows of a key that has both are ``old`` and
    ``new`` instead: the key's row changed. Nulls are equal to each other, also
    in keys; a column that one side lacks is null there.
    """
    names = [*before.columns, *[c for c in after.columns if c not in before.columns]]
    sign, net = free_name(names, "sign"), free_name(names, "net")
    signed = before.withColumn(sign, F.lit(-1)).unionByName(after.withColumn(sign, F.lit(1)), allowMissingColumns=True)
    columns = [F.col(f"`{c}`") for c in names]
    left = signed.groupBy(*columns).agg(F.sum(sign).alias(net)).where(F.col(net) != 0)
    gained = F.col(net) > 0
    change = F.when(gained, F.lit("added")).otherwise(F.lit("removed"))
    if keys:
        same_key = Window.partitionBy(*[F.col(f"`{k}`") for k in keys])
        both = F.bool_or(gained).over(same_key) & F.bool_or(~gained).over(same_key)
        change = F.when(both & gained, F.lit("new")).when(both, F.lit("old")).otherwise(change)
    return left.select(*columns, change.alias("change"), F.abs(net).alias("copies"))


def apply_diff(before: DataFrame, diff: DataFrame) -> DataFrame:
    """``before`` with a difference applied: the snapshot that it was made against. Fails if a removed row is not there as often."""
    names = before.columns
    columns = [F.col(f"`{c}`") for c in names]
    sign = F.when(F.col("change").isin("added", "new"), F.col("copies")).otherwise(-F.col("copies"))
    net = free_name([*names, "change", "copies"], "net")
    counted = before.groupBy(*columns).agg(F.count("*").alias(net)).unionByName(diff.select(*columns, sign.alias(net)))
    counted = counted.groupBy(*columns).agg(F.sum(net).alias(net)).where(F.col(net) != 0)
    times = F.when(F.col(net) < 0, F.raise_error(F.lit("the difference removes a row that is not there")).cast("long")).otherwise(F.col(net))
    return counted.withColumn(net, F.explode(F.sequence(F.lit(1).cast("long"), times))).select(*columns)
