"""Snapshot differences, suppressed totals and distinct sketches against plain versions."""

import datetime as dt
import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from relcast.operators.releases import PERIOD
from relcast.operators.rollups import suppressed_rollup
from relcast.operators.sketches import STANDARD_ERROR, approx_distinct, sketch_table, update_sketches
from relcast.operators.snapshots import apply_diff, snapshot_diff
from relcast.sources.files import read_table


def snapshots(spark):
    rng = random.Random(1)
    row = lambda: (rng.choice([None, 1, 2, 3, 4, 5]), rng.choice([None, "a", "b"]), rng.choice([1.5, None]))
    before = [row() for _ in range(60)] + [(9, "x", 1.0)] * 40
    after = before[:30] + [row() for _ in range(30)] + [(9, "x", 1.0)] * 39 + [(9, "y", 1.0)]
    frame = lambda rows: spark.createDataFrame(rows, "k int, v string, net double").repartition(3)
    return before, after, frame(before), frame(after)


def test_differences_count_duplicates_and_nulls(spark):
    before, after, b, a = snapshots(spark)
    gained, lost = Counter(after) - Counter(before), Counter(before) - Counter(after)
    got = Counter({(r.k, r.v, r.net, r.change): r.copies for r in snapshot_diff(b, a).collect()})
    assert got == Counter({(*r, "added"): n for r, n in gained.items()}) + Counter({(*r, "removed"): n for r, n in lost.items()})
    both = {r[0] for r in gained} & {r[0] for r in lost}
    keyed = Counter({(r.k, r.v, r.net, r.change): r.copies for r in snapshot_diff(b, a, ["k"]).collect()})
    assert keyed == Counter({(*r, "new" if r[0] in both else "added"): n for r, n in gained.items()}) + Counter({(*r, "old" if r[0] in both else "removed"): n for r, n in lost.items()})
    assert snapshot_diff(b, b.repartition(2)).count() == 0 and snapshot_diff(b.where("false"), a.where("false")).count() == 0


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_a_difference_can_be_applied(spark, keys):
    _, after, b, a = snapshots(spark)
    diff = snapshot_diff(b, a, keys)
    assert Counter(map(tuple, apply_diff(b, diff).collect())) == Counter(after)
    with pytest.raises(Exception, match="not there"):
        apply_diff(b.where("k = 1"), diff).collect()


def test_differences_of_other_columns(spark):
    b = spark.createDataFrame([(1, "a")], "k int, old string")
    a = spark.createDataFrame([(1, "n")], "k int, fresh string")
    assert {tuple(r) for r in snapshot_diff(b, a, ["k"]).collect()} == {(1, "a", None, "old", 1), (1, None, "n", "new", 1)}


def test_rows_cancel_out_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 3 AS k", "id % 2 AS v")
    plan = snapshot_diff(df, df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_sum" in plan


# ------------------------------------------------------------------- totals

def counts(rng, sizes):
    rows = []
    for cell in itertools.product(*[[None, *map(str, range(n))] for n in sizes]):
        rows += [(*cell, 1.0)] * rng.choice([0, 0, 1, 3, 7, 10, 11, 12, 25, 60])
    return rows


def derivable(cells, n_dims):
    """The suppressed cells that the published ones determine (least squares on the sums)."""
    hidden = sorted((c for c, x in cells.items() if x["suppressed"]), key=str)
    if not hidden:
        return []
    at = {c: i for i, c in enumerate(hidden)}
    sums = []
    for c in cells:
        if len(c) < n_dims:
            parts = [d for d in cells if len(d) == len(c) + 1 and d[:len(c)] == c]
            row = np.zeros(len(hidden))
            for d in parts:
                if d in at:
                    row[at[d]] += 1
            if c in at:
                row[at[c]] -= 1
            sums.append(row)
    m = np.array(sums)
    _, s, vt = np.linalg.svd(m)
    rank = int((s > 1e-9).sum())
    free = vt[rank:]  # what can be added to the unknowns without changing any sum
    return [c for c in hidden if not len(free) or np.abs(free[:, at[c]]).max() < 1e-9]


@pytest.mark.parametrize("seed", range(4))
def test_suppressed_cells_cannot_be_derived(spark, seed):
    rng = random.Random(seed)
    dims, rows = ["a", "n", "hidden"], counts(rng, (3, 2, 3))
    df = spark.createDataFrame(rows, "a string, n string, hidden string, x double").withColumnsRenamed({"n": "part"}).repartition(3)
    dims = ["a", "part", "hidden"]
    got = suppressed_rollup(df, dims, {"x": F.sum("x")}).collect()
    cells = {tuple(r[d] for d in dims)[:r.level]: r.asDict() for r in got}
    want = Counter(c[:k] for c in (r[:3] for r in rows) for k in range(4))
    assert set(cells) == set(want) and len(got) == len(cells)
    for c, n in want.items():
        r = cells[c]
        if r["suppressed"]:
            assert r["n"] is None and r["x"] is None and (r["suppressed"] == "small") == (n < 11)
        else:
            assert r["n"] == n and r["x"] == n and n >= 11
    assert derivable(cells, 3) == []
    # the test itself notices: without the complements some cell can be derived
    if any(r["suppressed"] == "complement" for r in cells.values()):
        bare = {c: r | {"suppressed": r["suppressed"] if r["suppressed"] == "small" else None} for c, r in cells.items()}
        assert derivable(bare, 3)


def test_totals_of_few_and_no_rows(spark):
    df = spark.createDataFrame([("a", 1.0)] * 5, "d string, x double")
    assert {(r.level, r.n, r.suppressed) for r in suppressed_rollup(df, ["d"]).collect()} == {(0, None, "small"), (1, None, "small")}
    assert suppressed_rollup(df.where("false"), ["d"]).where("n > 0").count() == 0


# ----------------------------------------------------------------- sketches

def test_sketches_are_united_and_replaced(spark, tmp_folder):
    target = f"{tmp_folder}/t"
    d = lambda m: dt.date(2024, m, 1)
    rows = lambda m, lo, hi: spark.range(lo, hi).selectExpr("id AS npi", "id % 10 AS g", f"date'{d(m)}' AS {PERIOD}")
    update_sketches(rows(1, 0, 20_000).unionByName(rows(2, 10_000, 30_000)), target, ["npi", "g"])
    update_sketches(rows(3, 900_000, 950_000), target, ["npi", "g"])
    update_sketches(rows(3, 30_000, 40_000), target, ["npi", "g"])  # loaded again: its sketch is replaced
    for first, last, exact, periods in ((None, None, 40_000, 3), (d(1), d(2), 30_000, 2), (d(2), None, 30_000, 2), (d(3), d(3), 10_000, 1)):
        got = {r["column"]: r for r in approx_distinct(spark, target, ["npi", "g"], first, last).collect()}
        assert abs(got["npi"].n_distinct - exact) <= 4 * STANDARD_ERROR * exact and got["npi"].n_periods == periods
        assert got["g"].n_distinct == 10
    assert read_table(spark, sketch_table(target)).count() == 6
    gone = spark.createDataFrame([(d(3),)], f"{PERIOD} date")
    update_sketches(rows(3, 0, 0), target, ["npi", "g"], periods=gone)  # a release without rows
    assert {r["column"]: r.n_periods for r in approx_distinct(spark, target, ["npi"]).collect()} == {"npi": 2}
    with pytest.raises(FileNotFoundError):
        approx_distinct(spark, f"{tmp_folder}/none", ["npi"])
