"""Counters against plain loops, with one key holding most rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from secflow.operators.threshold import fire_chain, fire_marks, running, threshold_fire, threshold_members

SCHEMA = "key string, ts timestamp, event string, n long, seconds long"


def _hits(spark, seed=1, rows=600):
    rng = random.Random(seed)
    base = dt.datetime(2024, 1, 1)
    rules = {"hot": (3, 40), "b": (1, 5), "c": (5, 400), "d": (2, 0)}
    data = []
    for i in range(rows):
        key = "hot" if rng.random() < 0.7 else rng.choice("bcd")
        n, seconds = rules[key]
        data.append((key, base + dt.timedelta(seconds=rng.randrange(rows * 4)), f"e{i:05d}", n, seconds))
    return data, spark.createDataFrame(data, SCHEMA).repartition(4)


def _by_key(data):
    keys = {}
    for row in sorted(data, key=lambda r: (r[0], r[1], r[2])):
        keys.setdefault(row[0], []).append(row)
    return keys


def _loop(data, mode):
    fired = set()
    for rows in _by_key(data).values():
        queue = []
        for key, ts, event, n, seconds in rows:
            if mode != "cumulative":
                queue = [t for t in queue if (ts - t).total_seconds() <= seconds]
            queue.append(ts)
            if len(queue) >= n:
                fired.add(event)
                if mode != "windowed":
                    queue = []
    return fired


@pytest.mark.parametrize("mode", ["cumulative", "windowed", "windowed_reset"])
def test_modes_equal_loops(spark, mode):
    data, hits = _hits(spark)
    got = {r.event for r in threshold_fire(hits, "key", "ts", "event", mode=mode).collect()}
    assert got == _loop(data, mode)


@pytest.mark.parametrize("mode", ["cumulative", "windowed", "windowed_reset"])
def test_counts_below_one_never_fire(spark, mode):
    data = [(f"k{n}", dt.datetime(2024, 1, 1, 0, 0, k), f"e{k}", n, 60) for n in (0, -1, None) for k in range(4)]
    assert threshold_fire(spark.createDataFrame(data, SCHEMA), "key", "ts", "event", mode=mode).count() == 0


def test_unknown_mode(spark):
    with pytest.raises(ValueError):
        threshold_fire(_hits(spark)[1], "key", "ts", "event", mode="other")


def test_running_numbers_maxima_and_last(spark):
    data, hits = _hits(spark, seed=2)
    rows = hits.withColumn("v", F.conv(F.substring("event", 2, 9), 10, 10).cast("int")).withColumn("odd", F.col("v") % 7 == 1)
    got = {r.event: r for r in running(
        rows, ["key"], ["ts", "event"], maxima={"top": "v"}, last_where={"at": "odd"}).collect()}
    for key_rows in _by_key(data).values():
        top, at = -1, 0
        for i, row in enumerate(key_rows, 1):
            v = int(row[2][1:])
            top, at = max(top, v), (i if v % 7 == 1 else at)
            assert (got[row[2]].rn, got[row[2]].top, got[row[2]].at) == (i, top, at)


def test_members_are_complete_buckets_only(spark):
    data, hits = _hits(spark, seed=3)
    members = threshold_members(running(hits, ["key"], ["ts", "event"]), "key").collect()
    sizes = {}
    for m in members:
        sizes.setdefault((m.key, m.bucket), []).append(m.event)
    for (key, bucket), events in sizes.items():
        rows = _by_key(data)[key]
        n = rows[0][3]
        assert sorted(events) == sorted(r[2] for r in rows[bucket * n:(bucket + 1) * n])
    assert len(members) == sum(len(r) // r[0][3] * r[0][3] for r in _by_key(data).values())


@pytest.mark.parametrize("block, span", [(1, 1), (1, 16), (7, 3), (64, 2), (10_000, 256)])
@pytest.mark.parametrize("seed", [1, 2])
def test_chain_equals_loop_for_any_floors(spark, block, span, seed):
    """Floors need not grow with the position, and rows without one never fire."""
    rng = random.Random(seed)
    data = []
    for key, size in (("hot", 300), ("b", 40), ("none", 5)):
        for pos in range(1, size + 1):
            able = key != "none" and rng.random() < 0.7
            data.append((key, pos, max(1, pos - rng.randrange(25)) if able else None))
    frame = spark.createDataFrame(data, "key string, pos long, floor long")
    got = {(r.key, r.pos): (r.fired, r.fire_seq) for r in fire_chain(frame, "key", "pos", "floor", block, span).collect()}
    state = {}
    for key, pos, floor in data:
        last, count = state.get(key, (0, 0))
        fires = floor is not None and last < floor
        assert got[(key, pos)] == (fires, count)
        if fires:
            state[key] = (pos, count + 1)


def test_marks_keep_every_hit(spark):
    data, hits = _hits(spark, seed=4, rows=100)
    for mode in ("cumulative", "windowed", "windowed_reset"):
        assert fire_marks(hits, "key", "ts", "event", mode=mode).count() == len(data)
