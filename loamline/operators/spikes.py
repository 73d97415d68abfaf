"""Implausible readings per source: impossible values, short spikes and stuck runs."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loamline.session import broadcast_within, cut_lineage

IMPOSSIBLE, SPIKE, STUCK, SKETCH = "impossible", "spike", "stuck", "sketch"


@dataclass(frozen=True)
class Measure:
    """What is physically possible for a measure and how it varies.

    low, high: bounds of the possible. ratio: the measure varies in proportion to its level, so deviations are taken between
    logarithms (of at least ``floor``).
    """

    low: float
    high: float
    ratio: bool
    floor: float = 0.1


#: Physical bounds of ambient air.
AIR_QUALITY = {
    "pm2_5": Measure(0.0, 5000.0, True),
    "pm10": Measure(0.0, 5000.0, True),
    "temp_c": Measure(-60.0, 60.0, False),
    "humidity_pct": Measure(0.0, 100.0, False),
}

NEIGHBOURS = 7  # readings on either side that give the local level; the median of 7 bears 3 spikes
LEAST_NEIGHBOURS = 3
REACH = 256  # a reading further away than so many readings of its measure is no neighbour
LONGEST_SPIKE = 3
SKETCH_BASE = 1.02  # bucket widths of the sketch: quantiles are right to 1 %
SKETCH_FLOOR = 1e-3
LEAST_RESIDUALS = 40  # a part of the day with fewer has the fence of the whole day
WHOLE_DAY = -1
DECIMALS = 6  # readings that differ less are equal, as far as a source's resolution goes


def _windows(x: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value the NEIGHBOURS before and those after it; NaN where there is none within REACH."""
    n, k = len(x), NEIGHBOURS
    values = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(k, np.nan), x, np.full(k, np.nan)]), k)
    places = np.lib.stride_tricks.sliding_window_view(np.concatenate([np.full(k, -(10**9)), place, np.full(k, 10**10)]), k)
    before, after = values[:n], values[k + 1 : k + 1 + n]
    far_before, far_after = places[:n, 0] < place - REACH, places[k + 1 : k + 1 + n, -1] > place + REACH
    if far_before.any():
        before = np.where(places[:n] < (place - REACH)[:, None], np.nan, before)
    if far_after.any():
        after = np.where(places[k + 1 : k + 1 + n] > (place + REACH)[:, None], np.nan, after)
    return before, after


def _medians(windows: np.ndarray) -> np.ndarray:
    """Medians of the values that each window holds; NaN where it holds fewer than LEAST_NEIGHBOURS."""
    out = np.median(windows, axis=1)
    for i in np.flatnonzero(np.isnan(out)):
        held = windows[i][~np.isnan(windows[i])]
        out[i] = np.median(held) if len(held) >= LEAST_NEIGHBOURS else np.nan
    return out


def _spread(before: np.ndarray, after: np.ndarray) -> np.ndarray:
    """Interquartile range of the neighbours on both sides."""
    both = np.sort(np.hstack([before, after]), axis=1)  # missing ones come last
    held = (~np.isnan(both)).sum(axis=1) - 1
    at = np.arange(len(both))
    return both[at, np.ceil(0.75 * held).astype(np.int64)] - both[at, np.floor(0.25 * held).astype(np.int64)]


def _short(x: np.ndarray, place: np.ndarray, before: np.ndarray, after: np.ndarray, far: np.ndarray, sign: np.ndarray) -> np.ndarray:
    """Whether the stretch around each value that stays beyond half of its deviation has at most LONGEST_SPIKE values.

    Beyond: of the level on its side. Told from the value itself, so that the source's fence need not be known.
    """
    n, k = len(x), LONGEST_SPIKE
    padded = np.concatenate([np.full(k, np.nan), x, np.full(k, np.nan)])
    places = np.concatenate([np.full(k, -(10**9)), place, np.full(k, 10**10)])
    length = np.ones(n, dtype=np.int64)
    for way, level in ((-1, before), (1, after)):
        on = np.ones(n, dtype=bool)
        for step in range(1, k + 1):
            at = k + way * step
            on &= (sign * (padded[at : at + n] - level) > far / 2) & (np.abs(places[at : at + n] - place) <= REACH)
            length += on
    return length <= k


def _run_lengths(start: np.ndarray) -> np.ndarray:
    """Length of the run that each position belongs to; start: where a run begins."""
    run = np.cumsum(start) - 1
    return np.bincount(run)[run]


def _buckets(rest: np.ndarray) -> np.ndarray:
    """Logarithmic bucket of each residual, with its sign; 0 for those under SKETCH_FLOOR."""
    size = np.abs(rest)
    bucket = np.ceil(np.log(np.maximum(size, SKETCH_FLOOR) / SKETCH_FLOOR) / np.log(SKETCH_BASE)).astype(np.int64)
    return np.where(rest < 0, -bucket, bucket)


class _Found:
    """Columns of one block's result: a row for each kind, measure and context, its readings or buckets in arrays."""

    def __init__(self) -> None:
        self.kind, self.measure, self.context, self.ids, self.far, self.gap, self.buckets, self.counts = [], [], [], [], [], [], [], []

    def add(self, kind, measure, context, ids, far, gap, buckets, counts) -> None:  # noqa: ANN001
        for column, value in (
            (self.kind, kind), (self.measure, measure), (self.context, context), (self.ids, ids), (self.far, far), (self.gap, gap), (self.buckets, buckets), (self.counts, counts)
        ):
            column.append(value)

    def table(self, source: int) -> pa.Table:
        n = len(self.kind)
        return pa.table(
            [
                pa.array(self.kind, pa.string()), pa.array([source] * n, pa.int64()), pa.array(self.measure, pa.string()),
                pa.array(self.context, pa.int32()), pa.array(self.ids, pa.list_(pa.int64())), pa.array(self.far, pa.list_(pa.float64())), pa.array(self.gap, pa.list_(pa.float64())),
                pa.array(self.buckets, pa.list_(pa.int32())), pa.array(self.counts, pa.list_(pa.int64())),
            ],
            names=["kind", "_s", "measure", "_context", "_id", "far", "gap", "buckets", "counts"],
        )


def _block(rows: pa.Table, measures: dict[str, Measure], min_run: int) -> pa.Table:
    """Candidates and sketches of one block of one source; halo rows give context only."""
    out = _Found()
    at_all, ids_all = rows.column("_m").to_numpy(), rows.column("_id").to_numpy()
    order = np.lexsort((ids_all, at_all))
    at_all, ids_all = at_all[order], ids_all[order]
    own_all = ~rows.column("_halo").to_numpy(zero_copy_only=False)[order]
    context_all = rows.column("_context").to_numpy()[order]
    for name, about in measures.items():
        held = rows.column(name).to_numpy(zero_copy_only=False).astype(float)[order]
        kept = ~np.isnan(held)
        if not kept.any():
            continue
        value, ids, at, own, context = held[kept], ids_all[kept], at_all[kept], own_all[kept], context_all[kept]
        # a reading sent twice is one reading: same instant, same value
        fresh = np.r_[True, (value[1:] != value[:-1]) | (at[1:] != at[:-1])]
        one = np.cumsum(fresh) - 1
        single = value[fresh]
        stuck = _run_lengths(np.r_[True, single[1:] != single[:-1]]) >= min_run
        sane = (single >= about.low) & (single <= about.high)
        level = (lambda v: np.log(np.clip(v, about.floor, about.high))) if about.ratio else (lambda v: np.clip(v, about.low, about.high))  # noqa: B023
        x = level(single)
        usable = np.flatnonzero(sane & ~stuck)  # impossible and stuck values say nothing of the level around them
        spike, far, gap = np.zeros(len(x), dtype=bool), np.zeros(len(x)), np.zeros(len(x))
        if len(usable):
            v = x[usable]
            wide_before, wide_after = _windows(v, usable)
            before, after = _medians(wide_before), _medians(wide_after)
            up, down = np.minimum(v - before, v - after), np.minimum(before - v, after - v)
            size = np.fmax(np.fmax(up, down), 0.0)
            sign = np.where(up > 0, 1, np.where(down > 0, -1, 0))
            hit = np.flatnonzero((size > 0) & _short(v, usable, before, after, size, sign))
            hit = hit[size[hit] > _spread(wide_before[hit], wide_after[hit])]
            spike[usable[hit]] = True
            far[usable[hit]] = (sign * size)[hit]
            near = np.where(sign > 0, np.maximum(before, after), np.minimum(before, after))[hit]
            gap[usable[hit]] = np.abs(single[usable[hit]] - (np.exp(near) if about.ratio else near))
            # sketches: counts of the residuals by signed logarithmic bucket, per hour context; with the least change seen
            rest = v - (before + after) / 2
            use = np.isfinite(rest) & own[fresh][usable]
            if use.any():
                steps = np.abs(np.diff(single[usable]))
                steps = steps[steps > 0.5 * 10.0**-DECIMALS]
                least = [float(steps.min())] if len(steps) else []
                shift = 1 << 20
                keys, counts = np.unique(context[fresh][usable][use].astype(np.int64) * 2 * shift + _buckets(rest[use]) + shift, return_counts=True)
                for hour in np.unique(keys // (2 * shift)):
                    mine = keys // (2 * shift) == hour
                    out.add(SKETCH, name, int(hour), None, least, None, (keys[mine] % (2 * shift) - shift).tolist(), counts[mine].tolist())
        for kind, marked in ((SPIKE, spike), (STUCK, stuck)):
            hit = marked[one] & own
            for hour in np.unique(context[hit]):
                mine = hit & (context == hour)
                what = (far[one][mine], gap[one][mine]) if kind == SPIKE else (None, None)
                out.add(kind, name, int(hour), ids[mine], *what, None, None)
    return out.table(rows.column("_s")[0].as_py() if rows.num_rows else 0)


_OUT = "kind string, _s long, measure string, _context int, _id array<long>, far array<double>, gap array<double>, buckets array<int>, counts array<long>"
_PARTS = 60  # parts of a slot in which readings are told apart when halos are measured
_SLOTS = (3600, 60, 1)  # seconds; a finer one where a slot holds more than a block


def _slots(base: DataFrame, names: list[str], rows_per_block: int, earliest: int) -> tuple[DataFrame, int]:
    """Slots of the sources' time lines with their rows and, for each measure, a lower bound of its distinct readings.

    Instants are asked for in the aggregate only: a filter would be pushed below the projection that parses them.
    """
    placed = F.col("_m") >= earliest
    for seconds in _SLOTS:
        slot = seconds * 1_000_000
        part = f"cast(pmod(_m, {slot}) div {slot // _PARTS} as int)"
        held = [F.bit_count(F.coalesce(F.bit_or(F.when(placed & F.col(n).isNotNull() & ~F.isnan(n), F.expr(f"shiftleft(1L, {part})"))), F.lit(0).cast("long"))).cast("long").alias(f"_n_{n}") for n in names]
        counted = cut_lineage(base.groupBy("_s", F.expr(f"_m div {slot}").alias("_slot")).agg(F.count_if(placed).alias("_c"), *held).where(F.col("_c") > 0))
        if seconds == _SLOTS[-1] or counted.where(F.col("_c") > rows_per_block).isEmpty():
            break
    return counted, slot


def _halos(slots: DataFrame, names: list[str], need: int) -> DataFrame:
    """``(_s, _slot, _block, _mask)``: blocks that see a slot as context, and the measures that they see (bits).

    A block that holds readings of a measure sees the ``need`` readings of it before and after the block, however far away
    they lie; a block that holds none sees none. Block ends and slots meet on their running count of readings in steps of
    ``need``, so a slot meets at most ``need`` blocks on either side, whatever the source's size.
    """
    counts = F.explode(F.array(*[F.struct(F.lit(bit).alias("bit"), F.col(f"_n_{n}").alias("c")) for bit, n in enumerate(names)]))
    held = slots.select("_s", "_slot", "_own", counts.alias("h")).select("_s", "_slot", "_own", "h.bit", "h.c").where(F.col("c") > 0)
    upto = F.sum("c").over(Window.partitionBy("_s", "bit").orderBy("_slot").rowsBetween(Window.unboundedPreceding, 0))
    held = held.withColumn("z", upto).withColumn("a", F.col("z") - F.col("c"))
    blocks = held.groupBy("_s", "bit", F.col("_own").alias("_block")).agg(F.min("a").alias("a"), F.max("z").alias("z"))
    step = lambda x: F.floor(x / need)
    # left halos: a slot's end meets the begin of later blocks; right ones: with signs turned, its begin the end of earlier ones
    sides = lambda left, right: F.explode(F.array(F.struct(F.lit("left").alias("side"), left.alias("e")), F.struct(F.lit("right").alias("side"), right.alias("e"))))
    ends = held.withColumn("x", sides(F.col("z"), -F.col("a"))).select("_s", "_slot", "_own", "bit", "x.side", "x.e")
    ends = ends.withColumn("k", F.explode(F.array(step(F.col("e")), step(F.col("e")) + 1)))
    begins = blocks.withColumn("x", sides(F.col("a"), -F.col("z"))).select("_s", "_block", "bit", "x.side", F.col("x.e").alias("b"), step(F.col("x.e")).alias("k"))
    met = ends.join(begins, ["_s", "bit", "side", "k"]).where((F.col("b") >= F.col("e")) & (F.col("b") - F.col("e") < need) & (F.col("_block") != F.col("_own")))
    return met.groupBy("_s", "_slot", "_block").agg(F.bit_or(F.expr("shiftleft(1, bit)")).alias("_mask"))


def flag_implausible(
    readings: DataFrame,
    source: str,
    row_id: str,
    micros: Column,
    measures: dict[str, Measure] = AIR_QUALITY,
    *,
    fence: float = 3.0,
    min_run: int = 15,
    hours_per_context: int = 6,
    rows_per_block: int = 20_000,
    not_before: str = "2021-01-01T00:00:00Z",
) -> DataFrame:
    """``(row_id, measure, reason)`` for every value that cannot be right, given what its source usually shows.

    impossible: outside the measure's physical bounds. stuck: a run of at least ``min_run`` equal successive readings (zero
    variance). spike: for at most three readings, off the medians of the readings before and after, on the same side of both,
    by more than (a) the outer fence of the source's residuals in that part of the day, Q3 + ``fence`` x IQR upwards and
    Q1 - ``fence`` x IQR downwards, (b) the interquartile range of these neighbours themselves and (c) ``fence`` steps of the
    source's resolution, its least change between readings. Readings beyond half of a deviation belong to it. Nothing else
    decides: a quiet source is judged by its own small spread, a restless one by its large one.

    Null and NaN values are skipped in every rule. A reading whose instant is null or before ``not_before`` has no place in the
    order: only the bounds apply to it. Rows sent twice (same source, instant and value) count once as context and are all
    flagged. Null sources or ids give no rows; an empty table gives none. Other columns are ignored, whatever their names.

    Plan: each source's time line is cut into blocks of about ``rows_per_block`` readings by a running count over its slots,
    so a source with a third of all rows becomes many groups. A block also sees REACH + ``min_run`` readings of each of its
    measures on either side, which is all that a verdict can depend on: the result is the same for every ``rows_per_block``.
    Each block gives candidates and signed log-bucket quantile sketches of its residuals, merged across blocks by adding counts.
    """
    names = list(measures)
    earliest = int(readings.sparkSession.range(1).select(F.unix_micros(F.lit(not_before).cast("timestamp")).alias("x")).first()["x"])
    base = readings.select(
        F.col(source).cast("long").alias("_s"), F.col(row_id).cast("long").alias("_id"), micros.alias("_m"),
        *[F.col(n).cast("double").alias(n) for n in names],
    ).where(F.col("_s").isNotNull() & F.col("_id").isNotNull())
    beyond = [
        F.when(F.col(n).isNotNull() & ~F.isnan(n) & ((F.col(n) < m.low) | (F.col(n) > m.high)), F.lit(n)) for n, m in measures.items()
    ]
    impossible = base.select(F.col("_id"), F.explode(F.array_compact(F.array(*beyond))).alias("measure")).withColumn(
        "reason", F.lit(IMPOSSIBLE)
    )

    # sources with more than one block: their slots, with a running count, give the blocks' borders
    counts = base.groupBy("_s").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_block).select("_s")
    large = broadcast_within(cut_lineage(counts))
    slots, slot = _slots(base.join(large, "_s", "left_semi"), names, rows_per_block, earliest)
    before = Window.partitionBy("_s").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    slots = slots.withColumn("_own", F.floor(F.coalesce(F.sum("_c").over(before), F.lit(0)) / rows_per_block))
    halos = _halos(slots, names, REACH + min_run)
    every = (1 << len(names)) - 1
    seen = slots.select("_s", "_slot", F.col("_own").alias("_block"), F.lit(every).alias("_mask"), F.lit(False).alias("_halo")).union(
        halos.select("_s", "_slot", "_block", "_mask", F.lit(True))
    )
    seen = broadcast_within(cut_lineage(seen.groupBy("_s", "_slot").agg(F.collect_list(F.struct("_block", "_mask", "_halo")).alias("_to"))))
    # no filter on the instant here: it is parsed once, in this projection, and rows without a place go to no block
    placed = base.withColumn("_slot", F.expr(f"_m div {slot}")).join(seen, ["_s", "_slot"], "left")
    alone = F.array(F.struct(F.lit(-1).cast("long").alias("_block"), F.lit(every).alias("_mask"), F.lit(False).alias("_halo")))
    rows = placed.select(
        "_s", "_id", "_m", *names, F.expr(f"cast(pmod(_m div 3600000000, 24) div {hours_per_context} as int)").alias("_context"),
        F.explode(F.when(F.col("_m") >= earliest, F.coalesce("_to", alone))).alias("_at"),
    ).select(
        "_s", "_id", "_m", "_context", F.col("_at._block").alias("_block"), F.col("_at._halo").alias("_halo"),
        *[F.when(F.expr(f"_at._mask & {1 << bit}") != 0, F.col(n)).alias(n) for bit, n in enumerate(names)],
    )
    rows = rows.where(~F.col("_halo") | F.coalesce(*names).isNotNull())
    found = rows.groupBy("_s", "_block").applyInArrow(lambda block: _block(block, measures, min_run), _OUT)
    found = cut_lineage(found)  # candidates and sketches only, a small part of the readings

    k = ["_s", "measure"]
    merged = (
        found.where(F.col("kind") == SKETCH)
        .select(*k, F.explode(F.array("_context", F.lit(WHOLE_DAY))).alias("_context"), F.get("far", 0).alias("far"), F.arrays_zip("buckets", "counts").alias("z"))
        .select(*k, "_context", "far", F.explode("z").alias("z"))
        .groupBy(*k, "_context", F.col("z.buckets").alias("bucket"))
        .agg(F.sum("z.counts").alias("n"), F.min("far").alias("step"))
    )
    each = Window.partitionBy(*k, "_context")
    merged = merged.withColumn("upto", F.sum("n").over(each.orderBy("bucket"))).withColumn("total", F.sum("n").over(each))
    quartile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("total"), F.col("bucket")))
    size = lambda b: F.signum(b) * SKETCH_FLOOR * F.pow(F.lit(SKETCH_BASE), F.abs(b))
    sketches = merged.groupBy(*k, "_context").agg(F.max("total").alias("total"), quartile(0.25).alias("b1"), quartile(0.75).alias("b3"), F.min("step").alias("step"))
    day = Window.partitionBy(*k)
    own = lambda c: F.coalesce(F.when(F.col("total") >= LEAST_RESIDUALS, F.col(c)), F.max(F.when(F.col("_context") == WHOLE_DAY, F.col(c))).over(day))
    fences = sketches.select(*k, "_context", size(own("b1")).alias("q1"), size(own("b3")).alias("q3"), F.min("step").over(day).alias("step"))
    limit = F.when(F.col("far") > 0, F.col("q3")).otherwise(-F.col("q1")) + fence * (F.col("q3") - F.col("q1"))
    spikes = (
        found.where(F.col("kind") == SPIKE).join(fences, [*k, "_context"]).withColumn("z", F.explode(F.arrays_zip("_id", "far", "gap")))
        .select("measure", "q1", "q3", "step", "z.*").where((F.abs("far") > limit) & (F.col("gap") > fence * F.coalesce("step", F.lit(0.0))))
        .select("_id", "measure", F.lit(SPIKE).alias("reason"))
    )
    stuck = found.where(F.col("kind") == STUCK).select(F.explode("_id").alias("_id"), "measure", F.lit(STUCK).alias("reason"))
    return impossible.unionByName(spikes).unionByName(stuck).withColumnRenamed("_id", row_id)
