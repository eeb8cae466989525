"""Counting within a time limit, with reset on fire.

The three modes need an occurrence number per key, and a key may hold a third of all rows. So
nothing here gathers a key in one task: rows are range-sorted by (key, order), which splits a hot
key over many partitions; the sorted rows are checkpointed, which fixes their places; and an
occurrence number is the place inside the partition plus the count of earlier partitions.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from secflow.plans.physical import broadcast_if_bounded, checkpointed

_PARTITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits
_BLOCK = 65_536  # rows per block of the reset chain
_SPAN = 256  # blocks per span


def running(
    df: DataFrame, keys: list[str], order: list[str], number: str = "rn",
    maxima: dict[str, str] | None = None, last_where: dict[str, str] | None = None,
) -> DataFrame:
    """Number the rows of each key in order, and carry running values along.

    ``maxima`` (output name -> column) are running maxima; ``last_where`` (output name -> boolean
    column) give the number of the latest row that satisfies the column, the row itself included,
    or 0. ``order`` must be unique within a key for the numbers to be reproducible.
    """
    maxima, last_where = maxima or {}, last_where or {}
    # the hash shuffle settles the rows, so that the sampling of the range sort does not run the
    # plan above it a second time
    settled = df.repartition(*keys, *order)
    placed = checkpointed(settled.sort(*keys, *order).withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", _PARTITION_BITS))
    # one row per (key, partition): at most the partitions plus the keys, whatever the row count
    runs = placed.groupBy(*keys, "_part").agg(
        F.min("_place").alias("_first"), F.count("*").alias("_n"),
        *[F.max(c).alias(f"_max_{o}") for o, c in maxima.items()],
        *[F.max(F.when(F.col(c), F.col("_place"))).alias(f"_at_{o}") for o, c in last_where.items()])
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counted = runs.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    base = F.col("_before") - F.col("_first") + 1
    offsets = counted.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], F.col("_part").alias("_run_part"), base.alias("_base"),
        *[F.max(f"_max_{o}").over(before).alias(f"_before_{o}") for o in maxima],
        *[F.max(F.col(f"_at_{o}") + base).over(before).alias(f"_before_{o}") for o in last_where])
    same = F.col("_part") == F.col("_run_part")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    result = placed.join(broadcast_if_bounded(offsets), same)
    result = result.withColumn(number, F.col("_place") + F.col("_base"))
    local = Window.partitionBy(*keys, "_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, 0)
    for o, c in maxima.items():
        result = result.withColumn(o, F.greatest(F.max(c).over(local), F.col(f"_before_{o}")))
    for o, c in last_where.items():
        here = F.max(F.when(F.col(c), F.col(number))).over(local)
        result = result.withColumn(o, F.coalesce(F.greatest(here, F.col(f"_before_{o}")), F.lit(0)))
    return result.select(*df.columns, number, *maxima, *last_where)


def fire_marks(
    hits: DataFrame, key: str, ts: str, event: str, n: str = "n", seconds: str = "seconds", mode: str = "cumulative"
) -> DataFrame:
    """Hits with their number ``rn`` and whether their key's counter fires there (``fired``).

    Ties in time are ordered by event id. ``cumulative``: every n-th hit, whatever the time between.
    ``windowed``: the last n hits lie within ``seconds``, without reset. ``windowed_reset``: as
    windowed, and a fire clears the counter.
    """
    rows = running(hits, [key], [ts, event])
    if mode == "cumulative":
        return rows.withColumn("fired", F.coalesce((F.col("rn") % F.nullif(F.col(n), F.lit(0)) == 0) & (F.col(n) >= 1), F.lit(False)))
    marked = _within_limit(rows, key, ts, n, seconds)
    if mode == "windowed":
        return marked.withColumnRenamed("_within", "fired")
    if mode != "windowed_reset":
        raise ValueError(f"unknown threshold mode {mode!r}")
    floor = F.when(F.col("_within"), F.col("rn") - F.col(n) + 1)
    chained = fire_chain(marked.withColumn("_floor", floor), key, "rn", "_floor")
    return chained.select(*hits.columns, "rn", "fired")


def threshold_fire(
    hits: DataFrame, key: str, ts: str, event: str, n: str = "n", seconds: str = "seconds", mode: str = "cumulative"
) -> DataFrame:
    """Hits at which their key's counter fires, with their number."""
    return fire_marks(hits, key, ts, event, n, seconds, mode).where("fired").drop("fired")


def threshold_members(numbered: DataFrame, key: str, n: str = "n") -> DataFrame:
    """Hits that belong to a completed cumulative bucket, with the bucket's number."""
    totals = numbered.groupBy(key).agg(F.max("rn").alias("_total"))
    rows = numbered.join(broadcast_if_bounded(totals), key)
    bucket = F.floor((F.col("rn") - 1) / F.col(n))
    return (
        rows.where(bucket < F.floor(F.col("_total") / F.col(n)))
        .withColumn("bucket", bucket).drop("_total"))


def _within_limit(rows: DataFrame, key: str, ts: str, n: str, seconds: str) -> DataFrame:
    """Mark rows whose n-th last hit is within the limit: an equi-join on a unique number, no frames."""
    earlier = rows.select(F.col(key).alias("_ekey"), F.col("rn").alias("_ern"), F.col(ts).alias("_ets"))
    target = F.col("rn") - F.col(n) + 1
    joined = rows.join(earlier, (F.col(key) == F.col("_ekey")) & (target == F.col("_ern")), "left")
    gap = F.unix_micros(F.col(ts)) - F.unix_micros("_ets")
    # a count below one, or none, never fires in any mode
    within = F.coalesce((gap <= F.col(seconds).cast("long") * 1_000_000) & (F.col(n) >= 1), F.lit(False))
    return joined.withColumn("_within", within).drop("_ekey", "_ern", "_ets")


# --- reset chain -------------------------------------------------------------------------------
#
# A row fires when the last fire of its key lies before the row's floor: last < floor(row). That one
# rule covers resets of every kind here. The chain is sequential, so it runs block-wise: each block
# is reduced to a step function "last fire on entry -> last fire and fires on exit", the small
# functions are applied along each key, and the blocks are then replayed with known entries.


def _next_fires(pos: np.ndarray, floor: np.ndarray) -> np.ndarray:
    """For every row, the index of the next row of the block that fires if this one did."""
    size = len(pos)
    if np.all(np.diff(floor) >= 0):
        nxt = np.searchsorted(floor, pos, side="right")
        return np.maximum(nxt, np.arange(1, size + 1))
    nxt = np.full(size, size)
    stack_floor: list[int] = []
    stack_row: list[int] = []
    for i in range(size - 1, -1, -1):
        low, high = 0, len(stack_floor)
        while low < high:  # floors fall from bottom to top; find the topmost above pos[i]
            mid = (low + high) // 2
            if stack_floor[mid] > pos[i]:
                low = mid + 1
            else:
                high = mid
        if low:
            nxt[i] = stack_row[low - 1]
        while stack_floor and stack_floor[-1] <= floor[i]:
            stack_floor.pop()
            stack_row.pop()
        stack_floor.append(int(floor[i]))
        stack_row.append(i)
    return nxt


def _block_steps(pos: np.ndarray, floor: np.ndarray) -> tuple[list[int], list[int], list[int]]:
    """Step function of a block: entries below bounds[i] (and not below bounds[i-1]) leave with
    lasts[i] after counts[i] fires; entries from bounds[-1] on leave unchanged."""
    nxt = _next_fires(pos, floor)
    size = len(pos)
    last = np.append(pos, 0)
    count = np.append(np.ones(size, dtype=np.int64), 0)
    for i in range(size - 1, -1, -1):
        j = nxt[i]
        if j < size:
            last[i], count[i] = last[j], count[i] + count[j]
    peaks = np.maximum.accumulate(floor)
    records = np.flatnonzero(np.append(True, peaks[1:] > peaks[:-1]))
    # an entry is always before the block, so records past its first row decide nothing
    enough = np.searchsorted(peaks[records], pos[0], side="left") + 1
    records = records[:enough]
    return peaks[records].tolist(), last[records].tolist(), count[records].tolist()


def _applied(step: tuple, last: int, fires: int) -> tuple[int, int]:
    """Last fire and fire count after a block, given those before it."""
    bounds, lasts, counts = step
    i = bisect_right(bounds, last)
    return (int(lasts[i]), fires + int(counts[i])) if i < len(bounds) else (last, fires)


def _composed(steps: list[tuple], start: int) -> tuple[list[int], list[int], list[int]]:
    """Step function of consecutive blocks, for entries before position ``start``."""
    bounds, lasts, counts = [], [], []
    peak = -1  # entries below it have met a block that fires
    for i, step in enumerate(steps):
        for bound, last, count in zip(*step):
            if bound <= peak:
                continue
            state = int(last), int(count)
            for later in steps[i + 1:]:
                state = _applied(later, *state)
            bounds.append(int(bound))
            lasts.append(state[0])
            counts.append(state[1])
            peak = int(bound)
        if peak >= start:
            break
    return bounds, lasts, counts


def _steps_of(pdf: pd.DataFrame) -> list[tuple]:
    return [tuple(list(x) for x in row) for row in zip(pdf["bounds"], pdf["lasts"], pdf["counts"])]


def fire_chain(df: DataFrame, key: str, pos: str, floor: str, block: int = _BLOCK, span: int = _SPAN) -> DataFrame:
    """Add ``fired`` and ``fire_seq`` (fires of the key before the row).

    ``pos`` numbers the rows of a key from 1 without gaps; ``floor`` is NULL for rows that cannot
    fire and otherwise at most ``pos``. Blocks of ``block`` rows are summarised on their own, spans
    of ``span`` blocks likewise; only the spans of a key are walked one after another.
    """
    df = checkpointed(df)  # read by the steps below
    key_type = df.schema[key].dataType.simpleString()
    step_type = "bounds array<long>, lasts array<long>, counts array<long>"
    blocks = df.withColumn("_block", F.floor((F.col(pos) - 1) / block))

    def summarise(ids, pdf):
        pdf = pdf.dropna(subset=["_f"]).sort_values("_p")
        if pdf.empty:
            bounds, lasts, counts = [], [], []
        else:
            bounds, lasts, counts = _block_steps(pdf["_p"].to_numpy(np.int64), pdf["_f"].to_numpy(np.int64))
        return pd.DataFrame({
            "_key": [ids[0]], "_block": [ids[1]], "bounds": [bounds], "lasts": [lasts], "counts": [counts]})

    steps = blocks.select(
        F.col(key).alias("_key"), "_block", F.col(pos).cast("long").alias("_p"), F.col(floor).cast("long").alias("_f"),
    ).groupBy("_key", "_block").applyInPandas(summarise, f"_key {key_type}, _block long, {step_type}")
    steps = checkpointed(steps.withColumn("_span", F.floor(F.col("_block") / span)))

    def compose(ids, pdf):
        steps_ = _steps_of(pdf.sort_values("_block"))
        bounds, lasts, counts = _composed(steps_, int(ids[1]) * span * block + 1)
        return pd.DataFrame({
            "_key": [ids[0]], "_span": [ids[1]], "bounds": [bounds], "lasts": [lasts], "counts": [counts]})

    spans = steps.groupBy("_key", "_span").applyInPandas(compose, f"_key {key_type}, _span long, {step_type}")

    def span_entries(batches):
        # spans of a key arrive together and in order; only two numbers are carried along
        current, last, fires = object(), 0, 0
        for pdf in batches:
            out_last, out_fires = [], []
            for k, step in zip(pdf["_key"], _steps_of(pdf)):
                if k != current:
                    current, last, fires = k, 0, 0
                out_last.append(last)
                out_fires.append(fires)
                last, fires = _applied(step, last, fires)
            yield pd.DataFrame({"_skey": pdf["_key"], "_sspan": pdf["_span"], "_last": out_last, "_fires": out_fires})

    span_entry = (
        spans.repartition("_key").sortWithinPartitions("_key", "_span")
        .mapInPandas(span_entries, f"_skey {key_type}, _sspan long, _last long, _fires long"))

    def block_entries(ids, pdf):
        pdf = pdf.sort_values("_block")
        last, fires = int(pdf["_last"].iloc[0]), int(pdf["_fires"].iloc[0])
        out_last, out_fires = [], []
        for step in _steps_of(pdf):
            out_last.append(last)
            out_fires.append(fires)
            last, fires = _applied(step, last, fires)
        return pd.DataFrame({"_ekey": ids[0], "_eblock": pdf["_block"], "_last": out_last, "_fires": out_fires})

    entry = (
        steps.join(span_entry, (F.col("_key") == F.col("_skey")) & (F.col("_span") == F.col("_sspan")))
        .drop("_skey", "_sspan").groupBy("_key", "_span")
        .applyInPandas(block_entries, f"_ekey {key_type}, _eblock long, _last long, _fires long"))

    rows = blocks.join(
        entry, (F.col(key) == F.col("_ekey")) & (F.col("_block") == F.col("_eblock"))).drop("_ekey", "_eblock")
    packed = rows.select(
        F.col(key).alias("_key"), "_block", "_last", "_fires", F.col(pos).cast("long").alias("_p"),
        F.col(floor).cast("long").alias("_f"))

    def replay(ids, pdf):
        pdf = pdf.sort_values("_p", ignore_index=True)
        fired = np.zeros(len(pdf), dtype=bool)
        able = np.flatnonzero(pdf["_f"].notna().to_numpy())
        if len(able):
            p = pdf["_p"].to_numpy(np.int64)[able]
            f = pdf["_f"].to_numpy(np.float64)[able].astype(np.int64)
            nxt = _next_fires(p, f)
            peaks = np.maximum.accumulate(f)
            i = int(np.searchsorted(peaks, int(pdf["_last"].iloc[0]), side="right"))
            while i < len(p):
                fired[able[i]] = True
                i = int(nxt[i])
        before = np.concatenate(([0], np.cumsum(fired)[:-1])) + int(pdf["_fires"].iloc[0])
        return pd.DataFrame({"_key": ids[0], "_p": pdf["_p"], "fired": fired, "fire_seq": before})

    replayed = packed.groupBy("_key", "_block").applyInPandas(
        replay, f"_key {key_type}, _p long, fired boolean, fire_seq long")
    return df.join(
        replayed.withColumnsRenamed({"_key": "_rkey", "_p": "_rp"}),
        (F.col(key) == F.col("_rkey")) & (F.col(pos) == F.col("_rp")),
    ).select(*df.columns, "fired", "fire_seq")
