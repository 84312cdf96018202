"""Joins on time and presence intervals against plain versions."""

import datetime as dt
import random
from collections import Counter

import pytest

from relcast.operators.crosswalk import entries_on, id_crosswalk, id_crosswalk_history
from relcast.operators.intervals import Grid, asof_join, interval_join, presence_intervals

DAY0 = dt.date(2000, 1, 1)


def day(n):
    return None if n is None else DAY0 + dt.timedelta(days=n)


def cases(rng, n_rows=300, n_entries=120):
    """A hot key, long, short, open and reversed intervals, nulls, repeated rows."""
    key = lambda: None if rng.random() < 0.05 else "hot" if rng.random() < 0.4 else f"k{rng.randint(0, 9)}"
    rows = [(i, key(), day(rng.choice([None, rng.randint(-400, 4000), rng.randint(0, 60)]))) for i in range(n_rows)]
    rows += rows[:3]
    entries = []
    for i in range(n_entries):
        s = rng.choice([None, rng.randint(-500, 4000)])
        e = rng.choice([None, (s or 0) + rng.choice([0, 1, 31, 32, 33, 255, 256, 257, 3000, 20_000, -1])])
        entries.append((key(), f"e{i}", day(s), day(e)))
    return rows, entries


def plain_interval_join(rows, entries, how):
    out = Counter()
    for i, k, d in rows:
        hits = [(name, s, e) for ek, name, s, e in entries if k is not None and ek == k and d is not None and (s is None or s <= d) and (e is None or d <= e)
                and not (s is not None and e is not None and e < s)]
        for hit in hits or ([(None, None, None)] if how == "left" else []):
            out[(i, k, d, *hit)] += 1
    return out


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("grid", [Grid(), Grid(days=1, growth=2, levels=3), Grid(days=100_000, levels=1)])
def test_interval_join(spark, how, grid):
    rows, entries = cases(random.Random(3))
    left = spark.createDataFrame(rows, "i int, k string, d date").repartition(3)
    right = spark.createDataFrame(entries, "k string, name string, s date, e date")
    got = interval_join(left, right, ["k"], "d", "s", "e", how, grid)
    assert got.columns == ["i", "k", "d", "name", "s", "e"]
    assert Counter(map(tuple, got.collect())) == plain_interval_join(rows, entries, how)
    assert interval_join(left.where("false"), right, ["k"], "d", "s", "e", how).count() == 0
    none = interval_join(left, right.where("false"), ["k"], "d", "s", "e", how)
    assert none.columns == got.columns and none.count() == (len(rows) if how == "left" else 0)


def test_interval_join_is_an_equi_join_on_cells(spark):
    left = spark.range(1000).selectExpr("id", "id % 3 AS k", "date_add(date'2020-01-01', cast(id AS int)) AS d")
    right = spark.range(100).selectExpr("id % 3 AS k", "id AS cell", "date_add(date'2020-01-01', cast(id AS int)) AS s", "date_add(date'2023-01-01', cast(id AS int)) AS e")
    joined = interval_join(left, right, ["k"], "d", "s", "e")
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "level" in plan and joined.columns == ["id", "k", "d", "cell", "s", "e"]
    with pytest.raises(ValueError):
        interval_join(left, right.withColumnRenamed("cell", "ID"), ["k"], "d", "s", "e")


def plain_asof(rows, entries, tolerance):
    out = Counter()
    for i, k, d in rows:
        before = [(s, name, x) for ek, name, s, x in entries if k is not None and ek == k and d is not None and s is not None and s <= d]
        best = max(before, default=None)
        if best and tolerance is not None and (d - best[0]).days > tolerance:
            best = None
        out[(i, k, d, *(best or (None, None, None)))] += 1
    return out


@pytest.mark.parametrize("days", [1, 32, 5000])
@pytest.mark.parametrize("tolerance", [None, 40])
def test_asof_join(spark, days, tolerance):
    rng = random.Random(5)
    rows, entries = cases(rng)
    entries = [(k, n, s, rng.randint(0, 9)) for k, n, s, _ in entries] + [(k, "tie" + n, s, 1) for k, n, s, _ in entries[:40]]
    left = spark.createDataFrame(rows, "i int, k string, d date").repartition(3)
    right = spark.createDataFrame(entries, "k string, name string, s date, x int").repartition(2)
    got = asof_join(left, right.select("k", "s", "name", "x"), ["k"], "d", "s", days, tolerance)
    assert got.columns == ["i", "k", "d", "s", "name", "x"]
    assert Counter(map(tuple, got.collect())) == plain_asof(rows, entries, tolerance)
    assert asof_join(left.where("false"), right, ["k"], "d", "s").count() == 0
    assert asof_join(left, right.where("false"), ["k"], "d", "s").where("s IS NULL").count() == len(rows)


def test_asof_join_with_times_and_helper_like_names(spark):
    left = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 12), "a"), (1, dt.datetime(2020, 1, 1, 11), "b"), (1, dt.datetime(2021, 1, 1), "c")], "cell int, t timestamp, l string")
    right = spark.createDataFrame([(1, dt.datetime(2020, 1, 1, 12), 1), (1, dt.datetime(2020, 1, 1, 11, 30), 2)], "cell int, r timestamp, key int")
    got = {r.l: (r.r, r.key) for r in asof_join(left, right, ["cell"], "t", "r").collect()}
    assert got == {"a": (dt.datetime(2020, 1, 1, 12), 1), "b": (None, None), "c": (dt.datetime(2020, 1, 1, 12), 1)}


def plain_presence(rows, calendar):
    dates = sorted(calendar)
    state = {}
    for k, d, a in rows:
        if d in calendar:
            worth = (a is None, a or "")
            state[k, d] = min(state.get((k, d), worth), worth)
    out = Counter()
    for k in {k for k, _ in state}:
        run = None
        for d in [*dates, None]:
            here = state.get((k, d))
            if run and (here is None or here != run[0]):
                out[(k, None if run[0][0] else run[0][1], run[1], run[2], run[3], run[2] == dates[-1])] += 1
                run = None
            if here is not None:
                run = (here, run[1] if run else d, d, run[3] + 1 if run else 1)
    return out


def test_presence_intervals(spark):
    rng = random.Random(9)
    dates = [day(30 * i) for i in range(12)]
    rows = [("everywhere", d, "s") for d in dates for _ in range(20)]
    rows += [(rng.choice([None, "a", "b", "c", "d"]), rng.choice([*dates, None]), rng.choice(["x", "x", "y", None])) for _ in range(120)]
    df = spark.createDataFrame(rows, "npi string, period date, state string").repartition(3)
    known = [r for r in rows if r[1] is not None]
    got = presence_intervals(df, ["npi"], "period", ["state"])
    assert got.columns == ["npi", "state", "first_period", "last_period", "n_periods", "is_current"]
    assert Counter(map(tuple, got.collect())) == plain_presence(known, set(dates))
    # a calendar with a release in which nobody was seen, and without one that was
    other = {*dates[:5], *dates[6:], day(75)}
    calendar = spark.createDataFrame([(d,) for d in other], "period date")
    assert Counter(map(tuple, presence_intervals(df, ["npi"], "period", ["state"], calendar).collect())) == plain_presence(known, other)
    bare = presence_intervals(df, ["npi"], "period")
    assert Counter(map(tuple, bare.collect())) == Counter({(k[0], *k[2:]): n for k, n in plain_presence([(k, d, "") for k, d, _ in known], set(dates)).items()})
    assert presence_intervals(df.where("false"), ["npi"], "period").count() == 0


def test_presence_of_an_id_is_one_row_per_release(spark):
    """Rows are counted away before the window: partial aggregation stands below the only shuffle by key."""
    df = spark.range(1000).selectExpr("1 AS npi", "date_add(date'2020-01-01', cast(id % 5 AS int)) AS d")
    plan = presence_intervals(df, ["npi"], "d")._jdf.queryExecution().executedPlan().toString()
    assert "partial_min" in plan[plan.index("Window ["):] and "Range" in plan


def test_crosswalk_history_and_lookup(spark):
    d = lambda m: dt.date(2024, m, 1)
    rows = [("1", "A", "TX", d(1)), ("1", "A", "TX", d(2)), ("1", "A", "TX", d(4)), ("1", "A", "CA", d(5)), ("2", "B", None, d(3)), ("2", "B", None, d(5)), ("3", "C", "NY", d(5))]
    df = spark.createDataFrame(rows, "npi string, ccn string, state string, _input_file_date date")
    history = id_crosswalk_history({"hospital": df, "snf": df.where("npi = '2'")})
    got = {(r.npi, r.facility_type, r.other_id_state, r.other_id_dt_s, r.other_id_dt_e, r.is_current) for r in history.collect()}
    # of the snf releases (March and May) npi 2 missed none
    assert got == {("1", "hospital", "TX", d(1), d(2), False), ("1", "hospital", "TX", d(4), d(4), False), ("1", "hospital", "CA", d(5), d(5), True),
                   ("2", "hospital", None, d(3), d(3), False), ("2", "hospital", None, d(5), d(5), True), ("3", "hospital", "NY", d(5), d(5), True),
                   ("2", "snf", None, d(3), d(5), True)}
    claims = spark.createDataFrame([(1, "1", d(3)), (2, "1", d(4)), (3, "9", d(4)), (4, None, d(4)), (5, "2", d(4))], "claim int, npi string, on date")
    found = Counter((r.claim, r.other_id) for r in entries_on(claims, history, "on").collect())
    assert found == Counter([(1, None), (2, "A"), (3, None), (4, None), (5, "B")])
    plain = Counter((r.claim, r.other_id) for r in entries_on(claims, id_crosswalk({"hospital": df}), "on").collect())
    assert plain == Counter([(1, "A"), (2, "A"), (3, None), (4, None), (5, "B")])
