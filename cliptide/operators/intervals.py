"""Windows over recordings, boundary clusters, atomic intervals, gaps, overlaps and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliptide.functions.rounding import milliseconds, round3

CLUSTER_GAP = 0.15
STAB_BUCKET = 30.0


def window_bounds(duration: Column, length: float = 30.0, overlap: float = 5.0) -> Column:
    """Array of (start, end): windows at a fixed stride, the last one right-aligned; a short recording is one window."""
    if length <= 0 or not 0 <= overlap < length:
        raise ValueError("length must be positive and overlap in [0, length)")
    stride, w = F.lit(float(length - overlap)), F.lit(float(length))
    n = F.greatest(F.lit(0), F.ceil((duration - w - F.lit(1e-6)) / stride)).cast("int")
    regular = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda k: round3(k * stride))).otherwise(F.expr("cast(array() as array<double>)"))
    tail = round3(F.greatest(F.lit(0.0), duration - w))
    last = F.try_element_at(regular, F.lit(-1))
    starts = F.when(last.isNull() | (F.abs(last - tail) > 1e-3), F.concat(regular, F.array(tail))).otherwise(regular)
    many = F.transform(starts, lambda s: F.struct(s.alias("start"), round3(F.least(duration, s + w)).alias("end")))
    one = F.array(F.struct(F.lit(0.0).alias("start"), round3(duration).alias("end")))
    return F.when(duration <= w, one).otherwise(many)


def analysis_windows(sources: DataFrame, length: float = 30.0, overlap: float = 5.0, limit: int | None = None) -> DataFrame:
    """One row per window of sources (dataset, clip_uid, duration_sec)."""
    if limit is not None:
        sources = sources.orderBy("clip_uid").limit(limit)
    rows = sources.select("*", F.posexplode(window_bounds(F.col("duration_sec"), length, overlap)).alias("window_index", "_w"))
    return rows.select(
        *sources.columns,
        "window_index",
        F.format_string("%s_long__%s__win%04d", "dataset", "clip_uid", "window_index").alias("episode_id"),
        F.col("_w.start").alias("window_start_sec"),
        F.col("_w.end").alias("window_end_sec"),
        round3(F.col("_w.end") - F.col("_w.start")).alias("window_duration_sec"),
        F.lit(float(overlap)).alias("overlap_sec"),
    )


def boundaries(candidates: DataFrame, clips: DataFrame, gap: float = CLUSTER_GAP) -> DataFrame:
    """clip_uid, idx, sec: starts, ends, 0 and the duration, chained into clusters and replaced by cluster means.

    Means are taken over whole milliseconds, so they don't depend on the order of the sum; repeats count.
    """
    ends = candidates.select("clip_uid", F.explode(F.array("start_sec", "end_sec")).alias("v")).unionByName(clips.select("clip_uid", F.explode(F.array(F.lit(0.0), "duration_sec")).alias("v")))
    by = Window.partitionBy("clip_uid").orderBy("v")
    fresh = F.coalesce((F.col("v") - F.lag("v").over(by) > F.lit(gap)).cast("int"), F.lit(1))
    groups = ends.withColumn("_new", fresh).withColumn("idx", F.sum("_new").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    means = groups.groupBy("clip_uid", "idx").agg(round3(F.sum(milliseconds(F.col("v"))) / F.count(F.lit(1)) / F.lit(1000.0)).alias("mean"))
    last = F.max("idx").over(Window.partitionBy("clip_uid"))
    fixed = means.withColumn("_last", last).join(clips.select("clip_uid", round3(F.col("duration_sec")).alias("_d")), "clip_uid")
    return fixed.select("clip_uid", "idx", F.when(F.col("idx") == F.col("_last"), F.col("_d")).when(F.col("idx") == 1, F.lit(0.0)).otherwise(F.col("mean")).alias("sec"))


def atoms(bounds: DataFrame) -> DataFrame:
    """Intervals between consecutive boundaries."""
    by = Window.partitionBy("clip_uid").orderBy("idx")
    rows = bounds.select("clip_uid", F.col("sec").alias("start_sec"), F.lead("sec").over(by).alias("end_sec"))
    return rows.where(F.col("end_sec") - F.col("start_sec") > 1e-4)


def stab(points: DataFrame, intervals: DataFrame, bucket: float = STAB_BUCKET) -> DataFrame:
    """points (clip_uid, mid) left-joined with the intervals (clip_uid, start_sec, end_sec) that hold them.

    Intervals are laid into time buckets, so a long clip is no quadratic join; a point lies in one bucket and
    meets an interval once. Interval columns come in as struct `hit`, null where none holds the point.
    """
    b = F.lit(float(bucket))
    number = lambda x: F.floor(x / b).cast("long")
    right = intervals.select(F.col("clip_uid").alias("_clip"), F.struct(*intervals.columns).alias("hit"), F.explode(F.sequence(number(F.col("start_sec")), number(F.col("end_sec")))).alias("_b"))
    left = points.withColumn("_pb", number(F.col("mid")))
    on = (F.col("clip_uid") == F.col("_clip")) & (F.col("_pb") == F.col("_b")) & (F.col("hit.start_sec") <= F.col("mid")) & (F.col("mid") < F.col("hit.end_sec"))
    return left.join(right, on, "left").drop("_clip", "_b", "_pb")


def contained(rows: DataFrame, *keys: str) -> DataFrame:
    """rows with `duplicate`: an earlier row of the same keys (by start, end, pos) covers this one."""
    by = Window.partitionBy(*keys).orderBy("start_sec", "end_sec", "pos").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("duplicate", F.coalesce(F.max("end_sec").over(by) >= F.col("end_sec"), F.lit(False)))


def closed_gaps(rows: DataFrame, key: str, tolerance: float = 0.2) -> DataFrame:
    """rows whose small gaps to their neighbours are split at the middle; `gap_repaired` marks the right row of a pair."""
    by = Window.partitionBy(key).orderBy("start_sec", "end_sec", "pos")
    before, after = F.lag("end_sec").over(by), F.lead("start_sec").over(by)
    left, right = F.col("start_sec") - before, after - F.col("end_sec")
    near = lambda gap: F.coalesce((gap > 0) & (gap <= F.lit(tolerance)), F.lit(False))
    return rows.withColumns(
        {
            "_s": F.when(near(left), round3((F.col("start_sec") + before) / F.lit(2.0))).otherwise(F.col("start_sec")),
            "_e": F.when(near(right), round3((after + F.col("end_sec")) / F.lit(2.0))).otherwise(F.col("end_sec")),
            "gap_repaired": near(left),
        }
    ).select(*[F.col({"start_sec": "_s", "end_sec": "_e"}.get(c, c)).alias(c) for c in [*rows.columns, "gap_repaired"]])


def gap_flags(rows: DataFrame, key: str, tolerance: float = 0.2, most: float = 1.0) -> DataFrame:
    """rows in list order (pos) with `order_flag`: overlapping_segments, large_temporal_gap or null."""
    by = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)
    before = F.greatest(F.max("end_sec").over(by), F.lit(0.0))
    first = F.row_number().over(Window.partitionBy(key).orderBy("pos")) == 1
    flag = F.when(first, F.lit(None).cast("string")).when(F.col("start_sec") < before - F.lit(tolerance), "overlapping_segments").when(F.col("start_sec") - before > F.lit(most), "large_temporal_gap")
    return rows.withColumn("order_flag", flag)


def coverage(rows: DataFrame, key: str, duration: str) -> DataFrame:
    """key, covered_sec and coverage_ratio (4 decimals) of the union of intervals clipped to [0, duration]."""
    clipped = rows.where("end_sec > start_sec").select(key, F.col(duration).alias("_d"), F.greatest(F.lit(0.0), F.col("start_sec")).alias("s"), F.least(F.col(duration), F.col("end_sec")).alias("e")).where("e > s")
    before = F.max("e").over(Window.partitionBy(key).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, -1))
    islands = clipped.withColumn("_new", F.coalesce((F.col("s") > before).cast("int"), F.lit(1)))
    islands = islands.withColumn("_i", F.sum("_new").over(Window.partitionBy(key).orderBy("s", "e").rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy(key, "_i").agg(F.min("s").alias("s"), F.max("e").alias("e"), F.first("_d").alias("_d"))
    total = spans.groupBy(key).agg((F.sum(milliseconds(F.col("e")) - milliseconds(F.col("s"))) / F.lit(1000.0)).alias("covered_sec"), F.first("_d").alias("_d"))
    ratio = F.when(F.col("_d") > 0, F.least(F.lit(1.0), F.col("covered_sec") / F.col("_d"))).otherwise(F.lit(0.0))
    return total.select(key, "covered_sec", (F.rint(ratio * F.lit(10000.0)) / F.lit(10000.0)).alias("coverage_ratio"))


def interactions(rows: DataFrame, key: str, pause: float = 1.5) -> DataFrame:
    """Neighbouring rows of one (action, object) merged while the pause between them is short, renumbered from 0.

    Rows with end < start take part with their start as end in the running maximum. fine_action and quality_flags are
    carried where rows have them: the first row's action, and all flags in order.
    """
    more = [c for c in ("fine_action", "quality_flags") if c in rows.columns]
    order = ["start_sec", "end_sec", "pos"]
    by = Window.partitionBy(key).orderBy(*order)
    changed = ~(F.col("action").eqNullSafe(F.lag("action").over(by)) & F.col("object").eqNullSafe(F.lag("object").over(by)))
    runs = rows.withColumn("_c", changed.cast("int")).withColumn("_run", F.sum("_c").over(by.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy(key, "_run").orderBy(*order)
    before = F.max(F.greatest("start_sec", "end_sec")).over(inside.rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.withColumn("_n", F.coalesce((F.col("start_sec") - before > F.lit(pause)).cast("int"), F.lit(1)))
    runs = runs.withColumn("_island", F.sum("_n").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    first = F.struct(*order)
    merged = runs.groupBy(key, "_run", "_island").agg(
        F.min(first).alias("_first"),
        F.max("end_sec").alias("end_sec"),
        F.first("action").alias("action"),
        F.first("object").alias("object"),
        F.count(F.lit(1)).alias("merged_rows"),
        F.array_sort(F.collect_list(F.struct(*order, "instruction", *more))).alias("_all"),
    ).withColumn("instructions", F.transform("_all", lambda x: x["instruction"]))
    number = F.row_number().over(Window.partitionBy(key).orderBy("_first")) - 1
    kept = {"fine_action": F.get("_all", 0)["fine_action"], "quality_flags": F.array_distinct(F.flatten(F.transform("_all", lambda x: x["quality_flags"])))} if more else {}
    return merged.select(key, number.alias("subtask_id"), F.col("_first.start_sec").alias("start_sec"), "end_sec", "action", "object", "merged_rows", "instructions", *[kept[c].alias(c) for c in more])
