"""Command line: the adapters, window preparation, validation, statistics, review and timeline over JSON-lines files."""

from __future__ import annotations

import argparse
import json
import subprocess

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliptide.operators import annotations as ann
from cliptide.sources import manifests
from cliptide.sources.files import make_folder, read_jsonl, write_document, write_jsonl
from cliptide.sources.media import export

from . import long_video

SOURCE = "clip_uid string, video_uid string, dataset string, source_clip_path string, duration_sec double, source_seek_offset_sec double"
MANIFEST = "source_clip_path string, dataset string, clip_uid string, video_uid string, source_start_sec double, source_end_sec double, task_hint string, scenario string"
WINDOW = "episode_id string, clip_uid string, window_index int, window_start_sec double, window_end_sec double, window_duration_sec double, overlap_sec double, export_ok boolean"
SUBTASK = "struct<subtask_id int, start_time_sec double, end_time_sec double, action string, fine_action string, object string, instruction string, training_eligible boolean, quality_flags array<string>>"
ANNOTATION = f"episode_id string, duration_sec double, video_level_instruction string, episode_quality_flags array<string>, subtasks array<{SUBTASK}>"
REPORT = "episode_id string, valid boolean, quality_flags array<string>, retry_reasons array<string>, coverage_ratio double"


def ffmpeg(command: list[str]) -> int:
    return subprocess.run(command, capture_output=True).returncode


def flat(annotations: DataFrame) -> DataFrame:
    """Subtasks of annotation rows, one each, in list order."""
    return annotations.select("episode_id", "duration_sec", F.posexplode("subtasks").alias("pos", "s")).select("episode_id", "duration_sec", "pos", "s.*", F.col("s.start_time_sec").alias("start_sec"), F.col("s.end_time_sec").alias("end_sec"))


def kept(spark: SparkSession, folder: str):
    """A keep() that writes tables below folder and reads them back: media are probed and cut once."""

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        return spark.read.parquet(f"{folder}/{name}.parquet")

    return keep


def _prepare(spark: SparkSession, a: argparse.Namespace) -> None:
    rows = read_jsonl(spark, a.manifest, MANIFEST)
    rows = rows.withColumn("row_index", F.monotonically_increasing_id())  # in file order; names a row in errors
    sources = manifests.load_manifest(rows, least=a.min_duration, most=a.max_duration, keep=kept(spark, f"{a.output}/_kept"))
    make_folder(spark, f"{a.output}/windows")
    write_jsonl(sources, f"{a.output}/source_videos")
    sources = read_jsonl(spark, f"{a.output}/source_videos", SOURCE)
    cut = lambda df: export(df.withColumn("target", F.concat(F.lit(f"{a.output}/windows/"), "episode_id", F.lit(".mp4"))), "window", ffmpeg)
    write_jsonl(long_video.prepare(sources, cut, a.window, a.overlap, a.num_videos), f"{a.output}/analysis_windows")


def _finalize(spark: SparkSession, a: argparse.Namespace) -> None:
    sources, windows = read_jsonl(spark, f"{a.work}/source_videos", SOURCE), read_jsonl(spark, f"{a.work}/analysis_windows", WINDOW)
    notes = read_jsonl(spark, a.annotations or f"{a.work}/annotations", ANNOTATION)
    make_folder(spark, f"{a.work}/segments")
    paths = sources.select("clip_uid", "source_clip_path", "source_seek_offset_sec")
    cut = lambda df: export(df.join(paths, "clip_uid").withColumn("target", F.concat(F.lit(f"{a.work}/segments/"), "segment_id", F.lit(".mp4"))), "segment", ffmpeg, crf=23)
    out = long_video.finalize(sources, windows, flat(notes), notes, cut, a.least, a.allow_incomplete, kept(spark, f"{a.work}/_kept"))
    for name, value in out.items():
        if isinstance(value, DataFrame):
            write_jsonl(value, f"{a.work}/{name}")
    write_document(spark, out["summary"], f"{a.work}/timeline_summary.json")


def _status(spark: SparkSession, a: argparse.Namespace) -> None:
    expected = read_jsonl(spark, f"{a.work}/analysis_windows", WINDOW).where("export_ok").select("episode_id")
    done = read_jsonl(spark, f"{a.work}/annotations", ANNOTATION)
    left = ann.pending(expected, done)
    n = expected.count()
    m = left.count()
    print(json.dumps({"expected": n, "completed": n - m, "pending": m, "pending_ids": [r[0] for r in left.orderBy("episode_id").limit(100).collect()]}))


def _validate(spark: SparkSession, a: argparse.Namespace) -> None:
    notes = read_jsonl(spark, a.annotations, ANNOTATION)
    write_jsonl(ann.validate(notes.select("episode_id", "duration_sec", "video_level_instruction"), flat(notes)), a.output)


def _stats(spark: SparkSession, a: argparse.Namespace) -> None:
    write_jsonl(ann.action_totals(flat(read_jsonl(spark, a.annotations, ANNOTATION))), a.output)


def _review(spark: SparkSession, a: argparse.Namespace) -> None:
    notes = read_jsonl(spark, a.annotations, ANNOTATION)
    bad = F.transform(F.filter("subtasks", lambda s: ~F.coalesce(s["training_eligible"], F.lit(False))), lambda s: s["subtask_id"])
    allowed = (*ann.ALLOWED, *a.allow_flag)
    rows = ann.review_reasons(notes.withColumn("ineligible", bad), read_jsonl(spark, a.validation, REPORT), allowed=allowed)
    write_jsonl(rows.where("size(review_reasons) = 0"), f"{a.output}/accepted_annotations")
    write_jsonl(rows.where("size(review_reasons) > 0"), f"{a.output}/review_queue")


def _adapter(name: str):
    def run(spark: SparkSession, a: argparse.Namespace) -> None:
        make = {"raw": manifests.raw_trajectories, "v2": manifests.episode_files_v2, "v3": manifests.episode_index_v3}[name]
        more = {"camera": a.camera, "outcome": a.outcome} if name == "raw" else {"camera_key": a.camera}
        rows, counts = make(spark, a.root, dataset=a.dataset, offset=a.offset, limit=a.limit, least=a.min_duration, most=a.max_duration, **more)
        write_jsonl(rows, a.output)
        write_document(spark, counts, f"{a.output}.summary.json")

    return run


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="cliptide", description=__doc__)
    sub = top.add_subparsers(dest="command", required=True)

    def add(name: str, run, *options: tuple) -> None:
        p = sub.add_parser(name)
        for flag, settings in options:
            p.add_argument(flag, **settings)
        p.set_defaults(run=run)

    need, text = {"required": True}, lambda d=None: {"default": d}
    number = lambda d, t=float: {"type": t, "default": d}
    span = (("--min-duration", number(3.0)), ("--max-duration", number(3600.0)))
    add("prepare", _prepare, ("--manifest", need), ("--output", need), ("--window", number(30.0)), ("--overlap", number(5.0)), ("--num-videos", number(None, int)), *span)
    add("finalize", _finalize, ("--work", need), ("--annotations", text()), ("--least", number(3.0)), ("--allow-incomplete", {"action": "store_true"}))
    add("status", _status, ("--work", need))
    add("validate", _validate, ("--annotations", need), ("--output", need))
    add("stats", _stats, ("--annotations", need), ("--output", need))
    add("review", _review, ("--annotations", need), ("--validation", need), ("--output", need), ("--allow-flag", {"action": "append", "default": []}))
    for name in ("raw", "v2", "v3"):
        more = (("--outcome", text("success")),) if name == "raw" else ()
        add(f"manifest-{name}", _adapter(name), ("--root", need), ("--output", need), ("--dataset", need), ("--camera", need), ("--offset", number(0, int)), ("--limit", number(0, int)), *span, *more)
    return top


def main(args: list[str] | None = None) -> None:
    a = parser().parse_args(args)
    a.run(SparkSession.builder.getOrCreate(), a)


if __name__ == "__main__":
    main()
