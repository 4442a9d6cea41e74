"""Sliced neighbours equal plain per-ship windows, whatever the slice length."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fairlead.operators import sequence

START = dt.datetime(2024, 1, 1)


def make(spark, seed, ships=6, rows=120, hot=400):
    """Random pings, one ship holding most of them, with equal times and gaps."""
    rnd = random.Random(seed)
    data, n = [], 0
    for ship in range(ships):
        t = 0
        for _ in range(hot if ship == 0 else rnd.randint(0, rows // 4)):
            t += rnd.choice([0, 1, 5, 60, 4000, 90000])
            data.append((ship, START + dt.timedelta(seconds=t), n, rnd.choice(["a", "b", None])))
            n += 1
    rnd.shuffle(data)
    return spark.createDataFrame(data, "mmsi long, dt_pos_utc timestamp_ntz, event_id long, v string")


@pytest.mark.parametrize("seconds", [1, 600, 7200, 10**9])
def test_neighbours_equal_plain_window(spark, seconds):
    df = make(spark, seconds).cache()
    w = Window.partitionBy("mmsi").orderBy("dt_pos_utc", "event_id")
    want = df.withColumns(
        {"p1": F.lag("v", 1).over(w), "p2": F.lag("event_id", 2).over(w), "n1": F.lead("v").over(w), "n3": F.lead("event_id", 3).over(w)}
    )
    got = sequence.neighbours(
        df, ["dt_pos_utc", "event_id"], back={"p1": ("v", 1), "p2": ("event_id", 2)},
        ahead={"n1": ("v", 1), "n3": ("event_id", 3)}, slice_seconds=seconds,
    )
    assert sorted(map(str, got.select(want.columns).collect())) == sorted(map(str, want.collect()))


@pytest.mark.parametrize("seconds", [1, 7200, 10**9])
def test_first_of_runs(spark, seconds):
    df = make(spark, 5).cache()
    got = sequence.first_of_runs(df, "v", ["dt_pos_utc", "event_id"], slice_seconds=seconds)
    want = []
    rows = sorted(df.collect(), key=lambda r: (r.mmsi, r.dt_pos_utc, r.event_id))
    for before, row in zip([None, *rows], rows):
        if before is None or before.mmsi != row.mmsi or row.v is None or before.v != row.v:
            want.append(row.event_id)
    assert sorted(r.event_id for r in got.collect()) == sorted(want)


def test_chained_calls_read_the_pings_once(spark, tmp_path):
    path = str(tmp_path / "p")
    make(spark, 1).write.parquet(path)
    df = spark.read.parquet(path)
    for name in ("p", "q", "s"):
        df = sequence.neighbours(df, ["dt_pos_utc", "event_id"], back={name: ("v", 1)}, slice_seconds=3600)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == 1 and "Union" not in plan


def test_ties_do_not_depend_on_partitioning_or_slices(spark):
    rnd = random.Random(5)
    rows = [(s, START + dt.timedelta(hours=rnd.randrange(30)), rnd.choice("abc"), rnd.random()) for s in range(4) for _ in range(120)]
    results = []
    for seconds, parts in ((3600, 1), (20000, 5), (10**7, 3)):
        rnd.shuffle(rows)
        df = spark.createDataFrame(rows, "mmsi long, dt_pos_utc timestamp_ntz, v string, x double").repartition(parts)
        got = sequence.neighbours(df, ["dt_pos_utc"], back={"b": ("v", 2)}, ahead={"a": ("x", 1)}, slice_seconds=seconds)
        results.append(sorted(map(str, got.collect())))
    assert results[0] == results[1] == results[2]


def test_rows_hashed_by_ship_are_still_split(spark):
    rows = make(spark, 3, hot=2000)
    joined = rows.hint("merge").join(rows.select("mmsi").distinct().hint("merge"), "mmsi")
    df = sequence.neighbours(joined, ["dt_pos_utc", "event_id"], back={"p": ("v", 1)}, slice_seconds=3600)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_slice" in plan and plan.count("REPARTITION_BY_COL") == 1


def test_top_per_key_is_cut_before_the_shuffle(spark):
    df = make(spark, 2)
    plan = sequence.earliest_per_key(df, ["mmsi"], ["dt_pos_utc"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_rank_keeps_ties(spark):
    rows = [(1, START, 1), (1, START, 2), (1, START + dt.timedelta(1), 3)]
    df = spark.createDataFrame(rows, "mmsi long, dt_pos_utc timestamp_ntz, event_id long")
    assert {r.event_id for r in sequence.first_by_rank(df, "mmsi", "dt_pos_utc").collect()} == {1, 2}


def test_slice_length_is_checked():
    with pytest.raises(ValueError):
        sequence.time_slice(seconds=0)


CROWDED = "mmsi long, dt_pos_utc timestamp_ntz, event_id long, v string"


def crowded(spark, seed, ties):
    """One ship with nine in ten pings, all of them in one hour; with ties, in two instants of it."""
    rnd = random.Random(seed)
    rows = [(1, START + dt.timedelta(seconds=rnd.randrange(2) if ties else rnd.random() * 3600), k, rnd.choice("ab")) for k in range(9000)]
    rows += [(rnd.randrange(2, 40), START + dt.timedelta(seconds=rnd.randrange(86400)), 9000 + k, rnd.choice("ab")) for k in range(1000)]
    rows += [(None, START, 10000, "a"), (2, None, 10001, "b")]
    rnd.shuffle(rows)
    return spark.createDataFrame(rows, CROWDED).repartition(5)


@pytest.mark.parametrize("ties", [False, True])
@pytest.mark.parametrize("tiebreak", [[], ["event_id"]])
def test_overfull_slices_are_cut_to_the_target(spark, ties, tiebreak):
    df = crowded(spark, 8, ties)
    slicing = sequence.Slicing(3600, target=300)
    sliced = sequence.with_slices(df, ["dt_pos_utc", *tiebreak], slicing)
    assert sliced.columns == [*df.columns, "_slice"]
    rows = sliced.collect()
    assert len(rows) == 10002
    sizes = {}
    for r in rows:
        if r.mmsi is not None and r.dt_pos_utc is not None:
            sizes.setdefault((r.mmsi, r._slice), []).append((r.dt_pos_utc, r.event_id))
    assert max(map(len, sizes.values())) <= 300 and len([k for k in sizes if k[0] == 1]) >= 30
    # parts follow each other
    spans = sorted((k[1], min(v), max(v)) for k, v in sizes.items() if k[0] == 1)
    assert all(a[2] < b[1] for a, b in zip(spans, spans[1:]))


def test_the_number_of_cuts_is_bounded(spark):
    sliced = sequence.with_slices(crowded(spark, 9, False), ["dt_pos_utc"], sequence.Slicing(3600, target=1, most=10))
    assert 5 <= sliced.filter("mmsi = 1").select("_slice").distinct().count() <= 25


def test_cut_slices_do_not_change_neighbours(spark):
    df = crowded(spark, 10, True)
    results = []
    for slicing in (10**7, sequence.Slicing(10**7, 500), sequence.Slicing(3600, 64)):
        got = sequence.neighbours(df, ["dt_pos_utc"], back={"b": ("v", 2)}, ahead={"a": ("event_id", 1)}, slice_seconds=slicing)
        results.append(sorted(map(str, got.collect())))
    assert results[0] == results[1] == results[2]
    assert sequence.with_slices(df.limit(0), ["dt_pos_utc"], sequence.EVEN).count() == 0


def test_a_row_meets_short_lists_of_cuts_only(spark):
    """One slice of 9,000 rows, some 190 cuts: a row that carries all cuts of its slice, or all in blocks of
    their root, is too wide for tables of millions of rows."""
    df = crowded(spark, 11, False)
    slicing = sequence.Slicing(3600, target=2)
    plan = sequence.with_slices(df, ["dt_pos_utc"], slicing)
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("LeftOuter") == sequence.LEVELS
    rows = [r for r in plan.collect() if r.mmsi == 1]
    assert len({r._slice for r in rows}) >= 180
    order = sorted(rows, key=lambda r: (r.dt_pos_utc, r.event_id))
    assert [r._slice for r in order] == sorted(r._slice for r in rows)
