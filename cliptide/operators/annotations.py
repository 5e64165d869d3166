"""Mapping, repair, validation, review gates and statistics of annotations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cliptide.functions import labels
from cliptide.functions.rounding import milliseconds, round3
from cliptide.functions.text import content_words, joined_clauses, named_actions, word_overlap

from .intervals import closed_gaps, contained, coverage, gap_flags, interactions
from .stitch import EDGE

# Flags that ask for another attempt, and flags that make an annotation invalid.
RETRY = ("vlm_parse_failure", "missing_video_level_instruction", "empty_subtasks", "overlapping_segments", "idle_only_episode", "low_temporal_coverage", "other_dominant")
HARD = ("invalid_action", "missing_object", "empty_instruction", "invalid_time_range", "overlapping_segments", "missing_video_level_instruction", "empty_subtasks")
ALLOWED = ("same_interaction_merged", "action_synonym_mapped")


def candidates(subtasks: DataFrame, windows: DataFrame, sources: DataFrame) -> DataFrame:
    """Subtasks on window time as candidates on source time; subtasks of windows not exported are left out.

    A window whose source is missing raises. subtasks: episode_id, subtask_id, start_time_sec, end_time_sec, training_eligible, quality_flags and labels.
    """
    rows = subtasks.join(windows.where("export_ok").select("episode_id", "clip_uid", "window_start_sec", "window_end_sec", "window_duration_sec", "overlap_sec"), "episode_id")
    rows = rows.join(sources.select("clip_uid", F.col("duration_sec").alias("_source"), F.lit(True).alias("_known")), "clip_uid", "left")
    lost = F.raise_error(F.concat(F.lit("no source for window "), "episode_id")).cast("double")
    rows = rows.withColumn("_source", F.when(F.col("_known"), F.col("_source")).otherwise(lost)).drop("_known")
    d, w, o = F.col("window_duration_sec"), F.col("window_start_sec"), F.col("overlap_sec")
    local = lambda c: F.greatest(F.lit(0.0), F.least(d, F.coalesce(F.col(c), F.lit(0.0))))
    source = lambda x: F.greatest(F.lit(0.0), F.least(F.col("_source"), w + x))
    rows = rows.withColumns({"_s": local("start_time_sec"), "_e": local("end_time_sec")}).where("_e > _s")
    edge = ((F.col("_s") <= o / F.lit(2.0)) & (w > 0)) | ((F.col("_e") >= d - o / F.lit(2.0)) & (F.col("window_end_sec") < F.col("_source")))
    flags = F.array_distinct(F.concat(F.coalesce("quality_flags", F.expr("cast(array() as array<string>)")), F.when(edge, F.array(F.lit(EDGE))).otherwise(F.expr("cast(array() as array<string>)"))))
    out = rows.withColumn("_flags", flags)
    extra = [c for c in ("action", "fine_action", "object", "instruction", "pos") if c in subtasks.columns]
    return out.select(
        F.format_string("%s__qseg%03d", "episode_id", "subtask_id").alias("candidate_id"), "episode_id", "clip_uid", *extra,
        round3(F.col("_s")).alias("local_start_sec"), round3(F.col("_e")).alias("local_end_sec"), round3(source(F.col("_s"))).alias("start_sec"), round3(source(F.col("_e"))).alias("end_sec"),
        (F.coalesce("training_eligible", F.lit(True)) & (F.size("_flags") == 0)).alias("training_eligible"), F.col("_flags").alias("quality_flags"), round3(F.least(F.col("_s"), d - F.col("_e"))).alias("edge_margin_sec"),
    )


def unknown_episodes(annotations: DataFrame, windows: DataFrame) -> DataFrame:
    """Annotations of no exported window; repeats are kept."""
    return annotations.join(windows.where("export_ok").select("episode_id"), "episode_id", "left_anti")


def normalise(subtasks: DataFrame) -> DataFrame:
    """Raw subtasks (episode_id, pos, duration_sec, start, end, action, fine_action, object, instruction) in clean form."""
    raw_s, raw_e = labels.lenient_double(F.col("start")), labels.lenient_double(F.col("end"))
    s, e = labels.clamp(raw_s, F.col("duration_sec")), labels.clamp(raw_e, F.col("duration_sec"))
    excused = labels.inferred(F.col("action"), F.col("fine_action"))
    flag = labels.action_flag(F.col("action"))
    return subtasks.select(
        "episode_id", "pos", "duration_sec", round3(s).alias("start_sec"), round3(e).alias("end_sec"), labels.action(F.col("action")).alias("action"), labels.fine_action(F.col("action"), F.col("fine_action")).alias("fine_action"),
        labels.object_name(F.col("object")).alias("object"), F.trim(F.coalesce("instruction", F.lit(""))).alias("instruction"),
        F.array_compact(F.array(F.when(~excused, flag))).alias("quality_flags"),
        F.array_compact(F.array(F.when((s != raw_s) | (e != raw_e), F.lit("time_clamped")), F.when(excused, F.lit("coarse_action_inferred")).otherwise(flag))).alias("repair_flags"),
    )


def repair(subtasks: DataFrame, fps: float = 1.0, tolerance: float = 0.2, pause: float = 1.5) -> DataFrame:
    """Subtasks normalised, sorted, freed of contained duplicates, with small gaps closed and interactions merged.

    A row keeps its first fine action and all its flags; a row without flags is eligible for training.
    """
    rows = contained(normalise(subtasks), "episode_id", "action", "object").where("not duplicate").drop("duplicate")
    merged = interactions(closed_gaps(rows, "episode_id", tolerance), "episode_id", pause)
    frame = lambda c: labels.frame_index(F.col(c), F.lit(fps))
    return merged.select(
        "episode_id", "subtask_id", "start_sec", "end_sec", frame("start_sec").alias("start_frame"), frame("end_sec").alias("end_frame"), "action", "fine_action", "object",
        joined_clauses(F.col("instructions")).alias("instruction"), "quality_flags", (F.size("quality_flags") == 0).alias("training_eligible"), "merged_rows",
    )


def repair_flags(subtasks: DataFrame, tolerance: float = 0.2, pause: float = 1.5) -> DataFrame:
    """episode_id and repair_flags of episodes with subtasks: what repair() had to change, each flag once.

    Flags of single rows come in list order, then those of the steps in the order of the steps. A row with `broken` was
    no object; it counts as invalid_subtask_type and takes part in nothing else.
    """
    if "broken" not in subtasks.columns:
        subtasks = subtasks.withColumn("broken", F.lit(False))
    rows = normalise(subtasks.where("not broken"))
    broken = subtasks.where("broken").select("episode_id", "pos", F.array(F.lit("invalid_subtask_type")).alias("repair_flags"))
    listed = rows.select("episode_id", "pos", "repair_flags").unionByName(broken)
    own = listed.groupBy("episode_id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "repair_flags"))), lambda x: x["repair_flags"])).alias("own"))
    span = F.struct("start_sec", "end_sec")
    unsorted = rows.withColumn("late", span < F.lag(span).over(Window.partitionBy("episode_id").orderBy("pos")))
    marked = contained(unsorted, "episode_id", "action", "object")
    closed = closed_gaps(marked.where("not duplicate").drop("duplicate"), "episode_id", tolerance)
    merged = interactions(closed, "episode_id", pause)
    some = lambda df, test, name: df.groupBy("episode_id").agg(F.bool_or(F.coalesce(test, F.lit(False))).alias(name))
    steps = {
        "subtasks_sorted": some(unsorted, F.col("late"), "subtasks_sorted"),
        "contained_duplicate_removed": some(marked, F.col("duplicate"), "contained_duplicate_removed"),
        "small_gap_repaired": some(closed, F.col("gap_repaired"), "small_gap_repaired"),
        "same_interaction_merged": some(merged, F.col("merged_rows") > 1, "same_interaction_merged"),
    }
    for step in steps.values():
        own = own.join(step, "episode_id", "left")
    found = F.array_compact(F.array(*[F.when(F.col(name), F.lit(name)) for name in steps]))
    return own.select("episode_id", F.array_distinct(F.concat("own", found)).alias("repair_flags"))


def row_flags(rows: DataFrame, least: float = 3.0) -> DataFrame:
    """rows in list order with `flags`: what each subtask breaks, in the order of the checks."""
    rows = gap_flags(rows, "episode_id")
    when = lambda c, name: F.when(c, F.lit(name))
    s, e = F.col("start_sec"), F.col("end_sec")
    return rows.withColumn(
        "flags",
        F.array_compact(F.array(
            when(~F.coalesce(F.col("action"), F.lit("")).isin(*labels.ACTIONS), "invalid_action"),
            when(labels.object_required(F.coalesce(F.col("action"), F.lit(""))) & (F.coalesce("object", F.lit("")) == ""), "missing_object"),
            when(F.trim(F.coalesce("instruction", F.lit(""))) == "", "empty_instruction"),
            when((s < 0) | (e > F.col("duration_sec") + 1e-6) | (e <= s), "invalid_time_range"),
            when(F.greatest(F.lit(0.0), e - s) < F.lit(least), "too_short_segment"),
            F.col("order_flag"),
        )),
    ).drop("order_flag")


def validate(episodes: DataFrame, rows: DataFrame, least: float = 3.0, rate: float = 30.0, gap: float = 1.0, other: float = 0.3, covered: float = 0.7) -> DataFrame:
    """Per episode (episode_id, duration_sec, video_level_instruction): its flags (sorted), retry reasons and validity."""
    checked = row_flags(rows.join(episodes.select("episode_id", "duration_sec"), "episode_id") if "duration_sec" not in rows.columns else rows, least)
    vague = (F.col("action") == "other") & F.lower(F.trim(F.coalesce("fine_action", F.lit("")))).isin(*labels.VAGUE_ACTIONS)
    facts = checked.groupBy("episode_id").agg(
        F.count(F.lit(1)).alias("n"), F.bool_and(F.col("action") == "idle").alias("idle"), F.count_if(vague).alias("vague"),
        F.min_by("start_sec", "pos").alias("first"), F.max_by("end_sec", "pos").alias("last"), F.array_distinct(F.flatten(F.collect_list("flags"))).alias("row_flags"),
    )
    part = coverage(checked, "episode_id", "duration_sec")
    all_rows = episodes.join(facts, "episode_id", "left").join(part, "episode_id", "left")
    n, d = F.coalesce("n", F.lit(0)), F.col("duration_sec")
    some = n > 0
    when = lambda c, name: F.when(F.coalesce(c, F.lit(False)), F.lit(name))
    own = F.array_compact(F.array(
        when(F.trim(F.coalesce("video_level_instruction", F.lit(""))) == "", "missing_video_level_instruction"),
        when(~some, "empty_subtasks"),
        when(some & (n > F.greatest(F.lit(1), F.floor(F.lit(rate) * d / F.lit(60.0)))), "too_many_segments"),
        when(some & F.col("idle"), "idle_only_episode"),
        when(some & (F.col("vague") / n > F.lit(other)), "other_dominant"),
        when(some & ((F.greatest(F.lit(0.0), F.col("first")) > F.lit(gap)) | (F.greatest(F.lit(0.0), d - F.col("last")) > F.lit(gap))), "large_temporal_gap"),
        when(some & (F.coalesce("coverage_ratio", F.lit(0.0)) < F.lit(covered)), "low_temporal_coverage"),
    ))
    out = all_rows.select("episode_id", F.coalesce("coverage_ratio", F.lit(0.0)).alias("coverage_ratio"), F.array_sort(F.array_distinct(F.concat(F.coalesce("row_flags", F.expr("cast(array() as array<string>)")), own))).alias("quality_flags"))
    out = out.withColumn("retry_reasons", F.filter("quality_flags", lambda x: x.isin(*RETRY)))
    hard = F.exists("quality_flags", lambda x: x.isin(*HARD))
    return out.withColumn("valid", (F.size("retry_reasons") == 0) & ~hard)


def review_reasons(annotations: DataFrame, validations: DataFrame, references: DataFrame | None = None, allowed: tuple[str, ...] = ALLOWED) -> DataFrame:
    """annotations (episode_id, episode_quality_flags, ineligible array<int>) with review_reasons in their fixed order."""
    rows = annotations.join(validations.select("episode_id", "valid", "retry_reasons", F.col("quality_flags").alias("_vf"), F.lit(True).alias("_v")), "episode_id", "left")
    none = F.expr("cast(array() as array<string>)")
    label = lambda name, xs: F.transform(xs, lambda x: F.concat(F.lit(f"{name}:"), x))
    ok = [F.lit(a) for a in allowed]
    retry = F.coalesce("retry_reasons", none)
    invalid = F.when(F.coalesce("valid", F.lit(False)), none).when(F.size(retry) > 0, label("validation", retry)).otherwise(F.array(F.lit("validation:invalid")))
    flags = F.array_sort(F.array_except(F.array_union(F.coalesce("_vf", none), F.coalesce("episode_quality_flags", none)), F.array(*ok) if ok else none))
    reasons = [F.when(F.col("_v").isNull(), F.array(F.lit("missing_validation"))).otherwise(F.concat(invalid, label("flag", flags)))]
    reasons.append(F.when(F.size("ineligible") > 0, F.array(F.concat(F.lit("ineligible_subtasks:"), F.array_join(F.transform("ineligible", lambda x: x.cast("string")), ",")))).otherwise(none))
    if references is not None:
        rows = rows.join(references.select("episode_id", F.col("flags").alias("_rf"), F.lit(True).alias("_r")), "episode_id", "left")
        reasons.append(F.when(F.col("_r").isNull(), F.array(F.lit("missing_reference_evaluation"))).otherwise(label("reference", F.filter(F.coalesce("_rf", none), lambda x: ~x.isin(*allowed)))))
    return rows.withColumn("review_reasons", F.array_distinct(F.concat(*reasons))).drop("valid", "retry_reasons", "_vf", "_v", "_rf", "_r")


def evaluate_references(rows: DataFrame, low: float = 0.1) -> DataFrame:
    """rows (predicted text, reference text, predicted_actions) with Jaccard, named actions and flags."""
    p, r = content_words(F.col("predicted")), content_words(F.col("reference"))
    overlap = word_overlap(p, r)
    rows = rows.withColumns({"_j": overlap, "reference_actions": named_actions(F.col("reference"))})
    flags = F.array_compact(F.array(F.when((F.coalesce("reference", F.lit("")) != "") & (F.col("_j") < F.lit(low)), F.lit("low_reference_overlap")), F.when((F.size("reference_actions") > 0) & ~F.arrays_overlap("predicted_actions", "reference_actions"), F.lit("reference_action_mismatch"))))
    return rows.withColumn("lexical_jaccard", F.rint(F.col("_j") * F.lit(10000.0)) / F.lit(10000.0)).withColumn("flags", flags).drop("_j")


def action_totals(rows: DataFrame) -> DataFrame:
    """Count, total and average duration of each action."""
    ms = F.sum(milliseconds(F.col("end_sec")) - milliseconds(F.col("start_sec")))
    return rows.groupBy("action").agg(F.count(F.lit(1)).alias("n"), (ms / F.lit(1000.0)).alias("total_sec"), round3(ms / F.count(F.lit(1)) / F.lit(1000.0)).alias("average_sec"))


def training_rows(rows: DataFrame, training: bool = True) -> DataFrame:
    """Rows fit for training, or all others: together they are the input."""
    good = F.coalesce(F.col("training_eligible") & F.col("export_ok"), F.lit(False))
    return rows.where(good if training else ~good)


def diverse(rows: DataFrame, count: int, group: str = "scenario", order: tuple[str, ...] = ("selection_score", "clip_uid")) -> DataFrame:
    """`count` rows: the best of each group first, then the best of the rest."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(*order))
    return rows.withColumn("_again", rank > 1).orderBy("_again", *order).limit(count).drop("_again")


def page(rows: DataFrame, order: list[str], offset: int = 0, limit: int = 0) -> DataFrame:
    """Rows after offset, limit of them; a limit of 0 is all."""
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")
    rows = rows.orderBy(*order).offset(offset)
    return rows.limit(limit) if limit else rows


def pending(expected: DataFrame, done: DataFrame, failed: DataFrame | None = None, retry_failed: bool = False) -> DataFrame:
    """Expected episodes still to do: those not done, or with retry_failed those that failed before."""
    left = expected.join(done.select("episode_id").distinct(), "episode_id", "left_anti")
    return expected.join(failed.select("episode_id").distinct(), "episode_id", "left_semi") if retry_failed and failed is not None else left


def manifest_errors(rows: DataFrame, least: float = 3.0, most: float = 3600.0) -> DataFrame:
    """rows (row_index, source_clip_path, container_sec, source_start_sec, source_end_sec, clip_uid) with `error`, null if sound.

    The first sound row of a clip_uid is kept, later ones are duplicates.
    """
    start = F.coalesce("source_start_sec", F.lit(0.0))
    end = F.coalesce("source_end_sec", "container_sec")
    duration = round3(end - start)
    c = F.col("container_sec")
    error: Column = (
        F.when(F.trim(F.coalesce("source_clip_path", F.lit(""))) == "", "missing_path")
        .when(c.isNull() | (c <= 0), "probe_failed")
        .when((start < 0) | (end <= start), "invalid_range")
        .when(end > c + 0.5, "beyond_container")
        .when(~duration.between(least, most), "duration_outside")
    )
    rows = rows.withColumns({"duration_sec": duration, "error": error})
    nth = F.row_number().over(Window.partitionBy("clip_uid", F.col("error").isNull()).orderBy("row_index"))
    return rows.withColumn("error", F.when(F.col("error").isNull() & (nth > 1), "duplicate_clip_uid").otherwise(F.col("error")))


def multiview(cameras: DataFrame, spread: float = 0.5, least: float = 3.0) -> DataFrame:
    """Per episode of cameras (episode_id, duration_sec, time_offset_sec): usable duration, spread and error flags."""
    usable = F.col("duration_sec") - F.greatest(F.lit(0.0), F.coalesce("time_offset_sec", F.lit(0.0)))
    out = cameras.groupBy("episode_id").agg(round3(F.min(usable)).alias("usable_sec"), round3(F.max(usable) - F.min(usable)).alias("spread_sec"), F.count(F.lit(1)).alias("cameras"))
    return out.withColumn("error", F.when(F.col("usable_sec") < least, "video_too_short").when((F.col("cameras") > 1) & (F.col("spread_sec") > spread), "multi_view_duration_mismatch"))
