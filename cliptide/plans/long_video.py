"""Prepare and finalize: sources to windows, and annotations to a published timeline."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliptide.functions.rounding import milliseconds
from cliptide.functions.text import distinct_neighbours, long_caption, representatives
from cliptide.operators import annotations as ann
from cliptide.operators.intervals import analysis_windows
from cliptide.operators.stitch import timeline

Export = Callable[[DataFrame], DataFrame]
Keep = Callable[[DataFrame, str], DataFrame]


def prepare(sources: DataFrame, export: Export, length: float = 30.0, overlap: float = 5.0, limit: int | None = None) -> DataFrame:
    """All windows of the sources, exported; `export` adds exported_duration_sec, export_ok and export_error."""
    rows = analysis_windows(sources, length, overlap, limit)
    return export(rows.withColumns({"start_sec": F.col("window_start_sec"), "duration_sec": F.col("window_duration_sec"), "source_duration_sec": F.col("duration_sec")}))


def stale(known: DataFrame, active: DataFrame) -> DataFrame:
    """Generated episodes (episode_id, generated) that are not active any more; others are nobody's to delete."""
    return known.where("generated").join(active.select("episode_id"), "episode_id", "left_anti")


def summaries(sources: DataFrame, windows: DataFrame, reports: DataFrame, segments: DataFrame) -> DataFrame:
    """One caption row per source: from the windows' sentences, else from the segments' labels, in order of time."""
    ordered = lambda key, value: F.transform(F.array_sort(F.collect_list(F.struct(key, value))), lambda x: x[value])
    said = reports.join(windows.select("episode_id", "clip_uid", "window_start_sec"), "episode_id").withColumn("s", F.coalesce("video_level_instruction", F.lit(""))).groupBy("clip_uid").agg(ordered("window_start_sec", "s").alias("w"))
    cut = segments.groupBy("clip_uid").agg(ordered("start_sec", "label").alias("l"), F.count(F.lit(1)).alias("segment_count"), F.count_if("training_eligible").alias("training_segment_count"))
    none = F.expr("cast(array() as array<string>)")
    rows = sources.join(said, "clip_uid", "left").join(cut, "clip_uid", "left")
    rows = rows.withColumns({"window_captions": distinct_neighbours(F.coalesce("w", none)), "segment_captions": distinct_neighbours(F.coalesce("l", none))})
    rows = rows.withColumn("_in", F.when(F.size("window_captions") > 0, F.col("window_captions")).otherwise(F.col("segment_captions"))).withColumn("representative_captions", representatives(F.col("_in")))
    n, t = F.coalesce("segment_count", F.lit(0)), F.coalesce("training_segment_count", F.lit(0))
    return rows.select(
        "clip_uid", F.col("duration_sec").alias("source_duration_sec"), long_caption(F.col("representative_captions")).alias("long_video_caption"), "representative_captions", "segment_captions", "window_captions",
        F.when(F.size("window_captions") > 0, "derived_from_qwen_window_captions").otherwise("derived_from_qwen_segment_labels").alias("summary_caption_source"), n.alias("segment_count"), t.alias("training_segment_count"), (n - t).alias("review_segment_count"),
    )


def decisions(segments: DataFrame) -> DataFrame:
    """The review template: one pending row per segment."""
    null = lambda t: F.lit(None).cast(t)
    return segments.select("segment_id", F.lit("pending").alias("review_status"), null("boolean").alias("boundary_correct"), null("boolean").alias("label_correct"), null("double").alias("corrected_start_sec"), null("double").alias("corrected_end_sec"), null("string").alias("corrected_label"), F.lit("").alias("reviewer_notes"))


def totals(segments: DataFrame) -> dict:
    """Counts and shares of a timeline, and its counters by action and flag."""
    ms = milliseconds(F.col("duration_sec"))
    part = lambda c: F.coalesce(F.sum(F.when(c, ms)), F.lit(0))
    r = segments.agg(F.count(F.lit(1)).alias("n"), F.count_if("training_eligible").alias("t"), F.coalesce(F.sum(ms), F.lit(0)).alias("ms"), F.coalesce(F.sum(milliseconds(F.col("uncovered_duration_sec"))), F.lit(0)).alias("u"), part(F.col("action") == "idle").alias("i")).first()
    share = lambda x: round(x / r.ms, 4) if r.ms else 0.0
    actions = {a.action: a for a in segments.groupBy("action").agg(F.count(F.lit(1)).alias("n"), F.sum(ms).alias("ms")).collect()}
    flags = {f.flag: f["n"] for f in segments.select(F.explode("quality_flags").alias("flag")).groupBy("flag").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {
        "final_segments": r.n, "training_segments": r.t, "timeline_duration_sec": r.ms / 1000, "uncovered_duration_sec": r.u / 1000, "uncovered_ratio": share(r.u), "idle_ratio": share(r.i),
        "action_counts": {k: a["n"] for k, a in actions.items()}, "action_duration_sec": {k: a.ms / 1000 for k, a in actions.items()}, "quality_flag_counts": flags,
    }


def finalize(sources: DataFrame, windows: DataFrame, subtasks: DataFrame, reports: DataFrame, export: Export, least: float = 3.0, allow_incomplete: bool = False, keep: Keep = lambda df, name: df.persist()) -> dict[str, DataFrame | dict]:
    """The tables of a finished run; pending windows raise unless allowed, unknown annotations do not.

    subtasks: rows of annotate() or of a read annotation table. keep(df, name) holds the exported timeline, by a written
    table on a cluster, so that every segment is cut once.
    """
    for name in ("start", "end"):
        if f"{name}_time_sec" not in subtasks.columns:
            subtasks = subtasks.withColumnRenamed(f"{name}_sec", f"{name}_time_sec")
    expected = windows.where("export_ok").select("episode_id")
    todo = ann.pending(expected, reports)
    if not allow_incomplete and (n := todo.count()):
        raise RuntimeError(f"{n} windows are not annotated yet")
    found = ann.candidates(subtasks, windows, sources).withColumn("pos", F.col("pos") if "pos" in subtasks.columns else F.lit(0))
    segments = keep(export(timeline(found, sources, least)), "timeline")
    return {"candidates": found, "timeline": segments, "training": ann.training_rows(segments), "review": ann.training_rows(segments, False), "summaries": summaries(sources, windows, reports, segments), "decisions": decisions(segments), "pending": todo, "unknown": ann.unknown_episodes(reports, windows).select("episode_id"), "summary": totals(segments)}
