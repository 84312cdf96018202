"""Multi-level totals with small-cell suppression.

All levels come from one ``rollup``. Cells of fewer than ``least`` rows are
suppressed. That alone does not hide them, since a total less its published
parts gives what is missing; so further cells are suppressed level by level from
the top until every sum that holds a suppressed cell holds two:

* where a total is published, none or at least two of its parts are suppressed;
* where a total is suppressed, at least one of its parts is.

The sums form a tree (a cell is a part of one total, and the total of its own
parts), so with two unknowns in every sum that has any, no cell can be derived.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relcast.functions.common import free_name
from relcast.session import materialise, release

#: Fixed value: cells of fewer rows are not published.
LEAST = 11


def suppressed_rollup(df: DataFrame, dims: Sequence[str], measures: Mapping[str, Column] | None = None, least: int = LEAST) -> DataFrame:
    """Per cell of every level: ``dims`` (null above their level), ``level``, ``n``, the measures, ``suppressed``.

    ``level`` is the number of dimensions that the cell is broken down by.
    ``suppressed`` is null for published cells, ``small`` for those below
    ``least`` rows and ``complement`` for those that protect them; ``n`` and
    the measures of both are null. A null in a dimension is a value of its own.
    Of several parts that could protect another the smallest is taken, ties by
    the dimension's value, nulls first.
    """
    dims, measures = list(dims), dict(measures or {})
    names = [*dims, *measures, "level", "n", "suppressed"]
    flag, one, found = (free_name(names, x) for x in ("hidden", "part", "pick"))
    level = F.lit(len(dims)) - F.bit_count(F.grouping_id())
    cells = df.rollup(*[F.col(f"`{d}`") for d in dims]).agg(F.count("*").alias("n"), level.cast("int").alias("level"), *[c.alias(m) for m, c in measures.items()])
    cells = materialise(cells, "rollup")
    done = None
    upper = None
    for depth in range(len(dims) + 1):
        part = cells.where(F.col("level") == depth)
        small = F.col("n") < least
        if depth == 0:
            judged = part.withColumn(flag, F.when(small, F.lit("small")))
        else:
            shared = dims[:depth - 1]
            same = lambda left, right: _all([left[f"`{d}`"].eqNullSafe(right[f"_{i}"]) for i, d in enumerate(shared)])
            value = F.col(f"`{dims[depth - 1]}`")
            # per total: how many parts are small, and the smallest of the others
            sums = part.groupBy(*[F.col(f"`{d}`") for d in shared]).agg(
                F.count(F.when(small, F.lit(1))).alias(one), F.min(F.when(~small, F.struct("n", value.isNotNull().alias("known"), value.alias("value")))).alias(found))
            sums = sums.select(*[F.col(f"`{d}`").alias(f"_{i}") for i, d in enumerate(shared)], one, found)
            totals = upper.select(*[F.col(f"`{d}`").alias(f"_{i}") for i, d in enumerate(shared)], F.col(flag).isNotNull().alias("_above"))
            part = part.join(totals, same(part, totals))
            part = part.drop(*[f"_{i}" for i in range(len(shared))])
            part = part.join(sums, same(part, sums)).drop(*[f"_{i}" for i in range(len(shared))])
            short = F.when(F.col("_above"), F.col(one) == 0).otherwise(F.col(one) == 1)
            picked = short & (F.col("n") == F.col(f"{found}.n")) & value.eqNullSafe(F.col(f"{found}.value"))
            judged = part.withColumn(flag, F.when(small, F.lit("small")).when(picked, F.lit("complement"))).drop(one, found, "_above")
        upper = materialise(judged, "rollup-level")
        done = upper if done is None else done.unionByName(upper)
    release(cells)
    shown = F.col(flag).isNull()
    return done.select(*[F.col(f"`{d}`") for d in dims], "level", F.when(shown, F.col("n")).alias("n"),
                       *[F.when(shown, F.col(f"`{m}`")).alias(m) for m in measures], F.col(flag).alias("suppressed"))


def _all(conditions: Sequence[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out
