"""Row-level clean-up: latest row per key (G5), exact duplicates (G6), id lists (A1), broken rows.

``latest_per_key`` is an aggregation, not a window: each map task keeps one
candidate per key before the shuffle (partial aggregation), so a key holding
a large share of all rows never lands whole in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcast.functions.common import as_col
from relcast.functions.text import split_ids


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], descending: bool = True) -> DataFrame:
    """One row per key: the greatest ``order`` (nulls last when descending).

    Ties on ``order`` are broken by the remaining columns, so the result does
    not depend on row order. A null key counts as one key.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    # max over a struct treats null as smallest: "desc nulls last" for free. Order columns that
    # are columns of the table come first under their own names, so a row is carried once.
    named = [o for o in order if isinstance(o, str) and o in rest]
    if len(named) == len(order):
        ranked = [*dict.fromkeys(named), *[c for c in rest if c not in named]]
        row = F.struct(*[F.col(f"`{c}`") for c in ranked])
    else:
        row = F.struct(*[as_col(o).alias(f"_o{i}") for i, o in enumerate(order)], *[F.col(f"`{c}`") for c in rest])
    pick = F.max(row) if descending else F.min(row)
    out = df.groupBy(*keys).agg(pick.alias("_row"))
    return out.select(*keys, *[F.col(f"_row.`{c}`").alias(c) for c in rest]).select(*[F.col(f"`{c}`") for c in df.columns])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicate removal over all columns (hash aggregate with map-side combine)."""
    return df.dropDuplicates()


def explode_ids(df: DataFrame, list_col: str, id_name: str = "npi", sep: str = " ") -> DataFrame:
    """One row per id in a separated list column; empty pieces and null lists give no row."""
    others = [F.col(f"`{c}`") for c in df.columns if c not in (list_col,)]
    return df.select(F.explode(split_ids(list_col, sep)).alias(id_name), *others)


def drop_marked_rows(df: DataFrame, column: str, marker: str) -> DataFrame:
    """remove rows whose column equals a broken-row marker; nulls are kept."""
    return df.where(~F.col(f"`{column}`").eqNullSafe(F.lit(marker)))
