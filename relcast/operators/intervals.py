"""Joins on time: entries valid on a row's date, the last entry before it, and presence intervals.

None of them compares every row with every entry of its key. The interval join
is an equi-join on time cells: an interval lies in at most two cells of the level
that fits its length, and a date is looked up once per level in use, so a long
interval is not written out day by day and a key with a large share of all rows
is spread over its cells. The as-of join orders rows within cells and hands the
last entry of a cell on to the later ones. Presence intervals see one row per id
and release, however often the id occurs in it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from relcast.functions.common import free_name
from relcast.session import materialise


@dataclass(frozen=True)
class Grid:
    """Cells of ``days`` days, and of ``growth`` times as many on each further one of ``levels`` levels."""

    days: int = 32
    growth: int = 8
    levels: int = 4

    def widths(self) -> list[int]:
        return [self.days * self.growth ** k for k in range(self.levels)]


GRID = Grid()


def _day(c: Column) -> Column:
    return F.unix_date(c.cast("date"))


def interval_join(rows: DataFrame, intervals: DataFrame, keys: Sequence[str], at: str, start: str, end: str,
                  how: str = "inner", grid: Grid = GRID) -> DataFrame:
    """Rows with every interval of their keys that holds their date: ``start <= at <= end``.

    Columns are those of ``rows``, then those of ``intervals`` without the
    keys. A null ``start`` or ``end`` is an open end; an interval that ends
    before it starts holds nothing. Null keys and dates match nothing.
    ``how="left"`` keeps rows without an interval, with nulls.
    """
    keys, others = list(keys), [c for c in intervals.columns if c not in keys]
    _no_clash(rows, others)
    if how == "left":
        number = free_name([*rows.columns, *others], "number")
        held = materialise(rows.withColumn(number, F.monotonically_increasing_id()), "interval-rows")
        found = materialise(interval_join(held, intervals, keys, at, start, end, grid=grid), "interval-found")
        bare = held.join(found.select(number).distinct(), number, "left_anti")
        return found.unionByName(bare, allowMissingColumns=True).select(*rows.columns, *others)
    if how != "inner":
        raise ValueError("an interval join is inner or left")

    names = [*rows.columns, *others]
    level, cell = free_name(names, "level"), free_name(names, "cell")
    first, last, widths = _day(F.col(start)), _day(F.col(end)), grid.widths()
    length = last - first + 1
    fits = F.coalesce(*[F.when(length <= w, F.lit(k)) for k, w in enumerate(widths)], F.lit(grid.levels))
    width = F.element_at(F.array(*[F.lit(w) for w in widths], F.lit(None).cast("int")), F.col(level) + 1)
    spread = F.when(F.col(level) < grid.levels, F.sequence(F.floor(first / width), F.floor(last / width))).otherwise(F.array(F.lit(0).cast("long")))
    valid = F.coalesce(F.col(start).cast("date") <= F.col(end).cast("date"), F.lit(True))
    placed = intervals.where(valid).withColumn(level, fits)
    # at most levels + 1 numbers: the levels that any interval has
    used = sorted(r[0] for r in placed.select(level).distinct().collect())
    placed = placed.withColumn(cell, F.explode(spread))
    renamed = {k: free_name([*names, level, cell], f"interval_{k}") for k in keys}
    placed = placed.withColumnsRenamed(renamed | {level: f"{level}_", cell: f"{cell}_"})
    if not used:
        return rows.join(placed.drop(f"{level}_", f"{cell}_", *renamed.values()), F.lit(False))
    day = _day(F.col(at))
    cells = F.array(*[F.struct(F.lit(k).alias("level"), (F.floor(day / widths[k]) if k < grid.levels else F.lit(0).cast("long")).alias("cell")) for k in used])
    probe = rows.where(F.col(at).isNotNull()).select("*", F.inline(cells).alias(level, cell))
    on = [F.col(f"`{k}`") == F.col(f"`{renamed[k]}`") for k in keys] + [F.col(level) == F.col(f"{level}_"), F.col(cell) == F.col(f"{cell}_")]
    date = F.col(f"`{at}`").cast("date")
    holds = F.coalesce(F.col(f"`{start}`").cast("date") <= date, F.lit(True)) & F.coalesce(date <= F.col(f"`{end}`").cast("date"), F.lit(True))
    joined = probe.join(placed, on, "inner").where(holds)
    return joined.select(*[F.col(f"`{c}`") for c in names])


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], at: str, right_at: str, days: int = 32,
              tolerance: int | None = None) -> DataFrame:
    """Every row of ``left`` with the last row of ``right`` of its keys at or before its time; nulls where there is none.

    Columns are those of ``left``, then those of ``right`` without the keys. Of
    several right rows at one time, that with the greatest other columns
    counts. Null keys and times match nothing. ``tolerance`` bounds the age of
    the match in days. A task holds the rows of a key within ``days`` days.
    """
    keys, others = list(keys), [c for c in right.columns if c not in keys]
    _no_clash(left, others)
    named = lambda cols: [F.col(f"`{c}`").alias(c) for c in cols]
    key, known = F.struct(*named(keys)), F.lit(True)
    for k in keys:
        known = known & F.col(f"`{k}`").isNotNull()
    cell = lambda c: F.floor(_day(F.col(f"`{c}`")) / days)
    points = left.select(key.alias("key"), cell(at).alias("cell"), F.col(f"`{at}`").alias("t"), F.struct(*named(left.columns)).alias("l"),
                         (known & F.col(f"`{at}`").isNotNull()).alias("may"))
    value = F.struct(*named([right_at, *[c for c in others if c != right_at]]))
    marks = right.where(known & F.col(f"`{right_at}`").isNotNull()).select(key.alias("key"), cell(right_at).alias("cell"), F.col(f"`{right_at}`").alias("t"), value.alias("r"))
    rows = points.unionByName(marks, allowMissingColumns=True)
    # within a cell: right rows first where times agree, the greatest of them last
    order = Window.partitionBy("key", "cell").orderBy("t", F.col("l").isNotNull(), "r").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    within = rows.withColumn("here", F.last("r", ignorenulls=True).over(order)).where(F.col("l").isNotNull())
    # from earlier cells: one row per key and cell
    earlier = Window.partitionBy("key").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    tops = rows.groupBy("key", "cell").agg(F.max("r").alias("top")).select(F.col("key").alias("k"), F.col("cell").alias("c"), F.last("top", ignorenulls=True).over(earlier).alias("before"))
    found = within.join(tops.where(F.col("before").isNotNull()), (F.col("key") == F.col("k")) & (F.col("cell") == F.col("c")), "left")
    found = found.select("l", "t", "may", F.coalesce("here", "before").alias("m"))
    matched = F.col("may")
    if tolerance is not None:
        matched = matched & (F.datediff(F.col("t"), F.col(f"m.`{right_at}`")) <= tolerance)
    found = found.withColumn("m", F.when(matched, F.col("m")))
    return found.select(*[F.col(f"l.`{c}`").alias(c) for c in left.columns], *[F.col(f"m.`{c}`").alias(c) for c in others])


def _no_clash(rows: DataFrame, others: Sequence[str]) -> None:
    clash = {c.lower() for c in rows.columns} & {c.lower() for c in others}
    if clash:
        raise ValueError(f"columns on both sides: {sorted(clash)}")


def presence_intervals(df: DataFrame, keys: Sequence[str], period: str, attributes: Sequence[str] = (),
                       calendar: DataFrame | None = None) -> DataFrame:
    """Per key, the runs of consecutive releases in which it is present with equal attributes.

    Columns: keys, attributes, ``first_period``, ``last_period``,
    ``n_periods``, ``is_current`` (the run reaches the newest release). The
    release calendar is ``calendar`` (its column ``period``) or all periods of
    ``df``. A key that has several attribute values in one release counts with
    the smallest, nulls last. A null key is a key; rows without a period, or
    with one outside the calendar, are not present anywhere.
    """
    keys, attributes = list(keys), list(attributes)
    rows = df.where(F.col(period).isNotNull())
    none = [F.col(f"`{a}`").isNull().alias(f"none{i}") for i, a in enumerate(attributes)]
    state = F.struct(*[x for i, a in enumerate(attributes) for x in (none[i], F.col(f"`{a}`").alias(f"a{i}"))]) if attributes else F.lit(0)
    seen = rows.groupBy(*keys, F.col(period).alias("_period")).agg(F.min(state).alias("_state"))
    dates = (rows if calendar is None else calendar).select(F.col(period).alias("_p")).where(F.col("_p").isNotNull()).distinct()
    # one row per release: a list as short as the calendar
    ranks = materialise(dates.select("_p", F.row_number().over(Window.orderBy("_p")).alias("_rank"), F.max("_p").over(Window.partitionBy()).alias("_newest")), "calendar")
    placed = seen.join(ranks, F.col("_period") == F.col("_p"))
    run = F.col("_rank") - F.row_number().over(Window.partitionBy(*keys, "_state").orderBy("_rank"))
    runs = placed.withColumn("_run", run).groupBy(*keys, "_state", "_run").agg(
        F.min("_period").alias("first_period"), F.max("_period").alias("last_period"), F.count("*").alias("n_periods"), F.max("_newest").alias("_newest"))
    return runs.select(*[F.col(f"`{k}`") for k in keys], *[F.col(f"_state.a{i}").alias(a) for i, a in enumerate(attributes)],
                       "first_period", "last_period", "n_periods", (F.col("last_period") == F.col("_newest")).alias("is_current"))
