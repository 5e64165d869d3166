"""Labels, text, repair, sources, annotation rounds, reports and the command line on small fixtures."""

import json
import os

import pytest
from pyspark.sql import functions as F

from cliptide.functions import labels, text
from cliptide.operators import annotations as ann
from cliptide.plans import annotate, cli, long_video, reports
from cliptide.sources import files, manifests, media


def value(spark, column, **inputs):
    schema = ", ".join(f"{k} {t}" for k, (_, t) in inputs.items()) or "x int"
    row = tuple(v for v, _ in inputs.values()) or (1,)
    return spark.createDataFrame([row], schema).select(column.alias("v")).first().v


def test_labels(spark):
    s = lambda f, x: value(spark, f(F.col("x")), x=(x, "string"))
    assert s(labels.token, "  Pick-UP  now\t") == "pick up now" and s(labels.token, None) == ""
    assert [s(labels.action, x) for x in ("Fold", "pick-up", "take off", "TAKE_OFF", "juggle", None)] == ["fold", "move", "detach", "detach", "other", "other"]
    assert [s(labels.action_flag, x) for x in ("fold", "walk", "juggle")] == [None, "action_synonym_mapped", "out_of_vocabulary_action"]
    assert [s(labels.object_name, x) for x in (None, " ", "N/A", " cup ")] == [None, None, None, "cup"]
    assert [s(labels.safe_identifier, x) for x in ("robot/actionnet", "episode 1", "..a..", "a_b.c-d")] == ["robot-actionnet", "episode-1", "a", "a_b.c-d"]
    assert len(s(labels.safe_identifier, "///")) == 16
    assert s(labels.adapter_identifier, "-é a/b_") == "é-a-b_"
    assert [s(labels.lenient_double, x) for x in ("1.5", "x", None, "NaN")] == [1.5, 0, 0, 0]
    times = value(spark, labels.sample_times(F.col("d")), d=(0.2, "double"))
    assert times == [0.1] and len(value(spark, labels.sample_times(F.col("d")), d=(500.0, "double"))) == 128
    bins = [value(spark, labels.duration_bin(F.col("d")), d=(d, "double")) for d in (0.49, 0.5, 1.0, 2.0, 5.0, 10.0)]
    assert bins == ["<0.5", "0.5-1", "1-2", "2-5", "5-10", ">=10"]
    assert value(spark, labels.frame_index(F.col("a"), F.lit(1.0)), a=(2.5, "double")) == 2
    columns, rows, tile = labels.tile_grid(F.col("n"))
    assert [value(spark, c, n=(3, "int")) for c in (columns, rows, tile)] == [2, 2, 224]
    assert value(spark, labels.camera_path(F.col("p"), F.lit("/e")), p=("a.mp4", "string")) == "/e/a.mp4"


def test_text(spark):
    join = lambda a, b: value(spark, text.joined_sentences(F.col("a"), F.col("b")), a=(a, "string"), b=(b, "string"))
    assert [join("Go.", "go"), join("", "Go."), join("Go..", "Stop it."), join("Go", "")] == ["Go.", "Go.", "Go. Then stop it.", "Go."]
    fold = lambda xs: value(spark, text.joined_clauses(F.col("a")), a=(xs, "array<string>"))
    assert [fold(["Pick it.", "pick it.", "Turn it"]), fold(["", "Go."]), fold([]), fold(["One"])] == ["Pick it, then turn it", "Go.", "", "One"]
    tidy = lambda xs: value(spark, text.distinct_neighbours(F.col("a")), a=(xs, "array<string>"))
    assert tidy(["Open  it.", "open IT", "Then review uncovered activity.", "", None, "Close", "Open it"]) == ["Open it.", "Close.", "Open it."]
    tell = lambda n: value(spark, text.long_caption(text.representatives(F.col("a"))), a=([f"c{k}." for k in range(n)], "array<string>"))
    assert [tell(0), tell(1), tell(2), tell(3)] == [text.NO_CAPTION, "c0.", "First, c0; then, c1.", "First, c0; then, c1; finally, c2."]
    picks = list(dict.fromkeys(round(i * 19 / 7) for i in range(8)))
    assert value(spark, text.representatives(F.col("a")), a=([str(k) for k in range(20)], "array<string>")) == [str(k) for k in picks]
    assert value(spark, text.content_words(F.col("a")), a=("The camera wearer picks a CUP, cup 12", "string")) == ["picks", "cup", "12"]
    assert value(spark, text.named_actions(F.col("a")), a=("Picked; reopens, twisted", "string")) == ["move", "rotate"]
    assert value(spark, text.word_overlap(F.lit([]).cast("array<string>"), F.lit([]).cast("array<string>"))) == 0
    read = lambda x: value(spark, text.model_object(F.col("a")), a=(x, "string"))
    assert json.loads(read('```json\n{"a": 1}\n```')) == {"a": 1} and json.loads(read('so {"a": {"b": 2}} end')) == {"a": {"b": 2}}
    assert [read(x) for x in ("[1]", "none", "{broken", "7", "", None)] == [None] * 6
    prompt = text.retry_prompt(F.lit("P"), F.array(F.lit("x"), F.lit("y")), F.lit("r" * 20_000), F.lit(True))
    assert value(spark, prompt).startswith("P\nYour last answer was refused for: x, y.") and value(spark, prompt).count("r" * 12000) == 1


def test_repair(spark):
    rows = [("e", 0, 20.0, "-1", "4", "pick", "", "cup", "Pick it."), ("e", 1, 20.0, "4.1", "8", "grab", "", "cup", "Then carry it"), ("e", 2, 20.0, "1", "2", "move", "", "cup", "Inside"), ("e", 3, 20.0, "12", "99", "juggle", "spin", None, "Spin")]
    df = spark.createDataFrame(rows, "episode_id string, pos int, duration_sec double, start string, end string, action string, fine_action string, object string, instruction string")
    flags = {r.pos: (r.quality_flags, r.repair_flags) for r in ann.normalise(df).collect()}
    assert flags[0] == (["action_synonym_mapped"], ["time_clamped", "action_synonym_mapped"]) and flags[3] == ([], ["time_clamped", "coarse_action_inferred"])
    out = ann.repair(df, fps=2.0).orderBy("subtask_id").collect()
    assert [(r.start_sec, r.end_sec, r.action, r.object, r.instruction, r.end_frame) for r in out] == [(0.0, 8.0, "move", "cup", "Pick it, then then carry it", 16), (12.0, 20.0, "other", None, "Spin", 40)]


def test_validate_and_review(spark):
    eps = spark.createDataFrame([("a", 10.0, "Do."), ("b", 10.0, ""), ("c", 10.0, "Do."), ("d", 10.0, "Do.")], "episode_id string, duration_sec double, video_level_instruction string")
    rows = spark.createDataFrame([("a", 0, 0.0, 10.0, "move", "move", "cup", "Go."), ("c", 0, 0.0, 2.0, "idle", "idle", None, "Wait."), ("d", 0, 0.0, 6.0, "move", "move", "", ""), ("d", 1, 3.0, 10.0, "cut", "cut", "x", "Cut.")], "episode_id string, pos int, start_sec double, end_sec double, action string, fine_action string, object string, instruction string")
    out = {r.episode_id: r for r in ann.validate(eps, rows).collect()}
    assert out["a"].valid and out["a"].quality_flags == [] and out["a"].coverage_ratio == 1
    assert out["b"].quality_flags == ["empty_subtasks", "missing_video_level_instruction"] and not out["b"].valid and out["b"].coverage_ratio == 0
    assert out["c"].retry_reasons == ["idle_only_episode", "low_temporal_coverage"] and "large_temporal_gap" in out["c"].quality_flags
    assert {"missing_object", "empty_instruction", "overlapping_segments"} <= set(out["d"].quality_flags)
    notes = spark.createDataFrame([("a", ["same_interaction_merged"], []), ("b", [], [2, 5]), ("z", ["time_clamped"], [])], "episode_id string, episode_quality_flags array<string>, ineligible array<int>")
    refs = spark.createDataFrame([("a", ["low_reference_overlap"])], "episode_id string, flags array<string>")
    plain = {r.episode_id: r.review_reasons for r in ann.review_reasons(notes, ann.validate(eps, rows)).collect()}
    assert plain["a"] == [] and plain["z"] == ["missing_validation"]
    assert plain["b"] == ["validation:empty_subtasks", "validation:missing_video_level_instruction", "flag:empty_subtasks", "flag:missing_video_level_instruction", "ineligible_subtasks:2,5"]
    with_refs = {r.episode_id: r.review_reasons for r in ann.review_reasons(notes, ann.validate(eps, rows), refs).collect()}
    assert with_refs["a"] == ["reference:low_reference_overlap"] and with_refs["z"][-1] == "missing_reference_evaluation"


def test_candidate_fixture(spark):
    sources = spark.createDataFrame([("clip", 100.0)], "clip_uid string, duration_sec double")
    windows = spark.createDataFrame([("w", "clip", 50.0, 80.0, 30.0, 5.0, True), ("u", "clip", 0.0, 30.0, 30.0, 5.0, False)], "episode_id string, clip_uid string, window_start_sec double, window_end_sec double, window_duration_sec double, overlap_sec double, export_ok boolean")
    subtasks = spark.createDataFrame([("w", 0, 3.0, 10.0, "move", True, []), ("w", 1, 1.0, 9.0, "move", True, []), ("w", 2, 9.0, 9.0, "move", True, []), ("u", 0, 1.0, 2.0, "move", True, [])], "episode_id string, subtask_id int, start_time_sec double, end_time_sec double, action string, training_eligible boolean, quality_flags array<string>")
    out = {r.candidate_id: r for r in ann.candidates(subtasks, windows, sources).collect()}
    assert set(out) == {"w__qseg000", "w__qseg001"}
    assert (out["w__qseg000"].start_sec, out["w__qseg000"].end_sec, out["w__qseg000"].training_eligible) == (53.0, 60.0, True)
    assert out["w__qseg001"].quality_flags == ["analysis_window_edge"] and not out["w__qseg001"].training_eligible
    assert [r[0] for r in ann.unknown_episodes(subtasks.select("episode_id").distinct(), windows).collect()] == ["u"]


def keeper(spark, tmp_path):
    def keep(df, name):
        path = f"{tmp_path}/{name}"
        df.write.mode("overwrite").parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    return keep


class Stubborn:
    """Fails once for one episode, never answers another, talks rubbish to a third."""

    def annotate(self, request):
        good = json.dumps({"video_level_instruction": "Do.", "subtasks": [{"start_time_sec": 0, "end_time_sec": 10, "action": "move", "object": "cup", "instruction": "Go."}, 7]})
        e, again = request["episode_id"], "was refused for" in request["prompt"]
        if e == "down" or e == "once" and not again:
            raise RuntimeError("no answer")
        if e == "idle":
            return {"text": json.dumps({"video_level_instruction": "Do.", "subtasks": [{"start_time_sec": 0, "end_time_sec": 10, "action": "idle", "instruction": "Wait."}]}), "model": "m"}
        return {"text": "rubbish" if e == "mad" else f"Here: {good}", "model": "m"}


def test_annotation_rounds(spark, tmp_path):
    rows = [(e, 10.0, "P", None, [2.5, 7.5]) for e in ("fine", "once", "down", "mad", "idle")]
    eps = spark.createDataFrame(rows, "episode_id string, duration_sec double, prompt string, task_hint string, times array<double>")
    subtasks, report, errors = annotate.annotate(eps, Stubborn(), keeper(spark, tmp_path))
    got = {r.episode_id: (r.valid, r.retry_count) for r in report.collect()}
    assert got == {"fine": (True, 0), "once": (True, 1), "idle": (False, 2)}
    assert {r.episode_id: r.quality_flags for r in errors.collect()} == {"down": ["backend_failure"], "mad": ["vlm_parse_failure"]}
    assert subtasks.where("episode_id = 'fine'").count() == 1
    done, bad = report.select("episode_id"), errors.select("episode_id")
    assert {r[0] for r in annotate.batch(eps, done, bad, resume=True).select("episode_id").collect()} == {"down", "mad"}
    assert {r[0] for r in annotate.batch(eps, done, bad, retry_failed=True).select("episode_id").collect()} == {"down", "mad"}
    assert annotate.replaced(done, done.limit(1)).count() == 3


def test_mock_backend(spark, tmp_path):
    eps = spark.createDataFrame([("e", 6.0, "P", None, [1.5, 4.5])], "episode_id string, duration_sec double, prompt string, task_hint string, times array<double>")
    subtasks, report, errors = annotate.annotate(eps, "mock", keeper(spark, tmp_path))
    assert [(r.start_sec, r.end_sec, r.action) for r in subtasks.collect()] == [(0.0, 6.0, "move")] and report.first().valid and errors.count() == 0


def test_files(spark, tmp_path):
    assert files.read_jsonl(spark, f"{tmp_path}/none", "a int").count() == 0
    (tmp_path / "x.jsonl").write_text('{"a": 1}\n\n{"a": 2}\n')
    assert files.read_jsonl(spark, f"{tmp_path}/x.jsonl", "a int").count() == 2
    (tmp_path / "bad.jsonl").write_text('{"a": 1}\n{oops\n')
    with pytest.raises(Exception):
        files.read_jsonl(spark, f"{tmp_path}/bad.jsonl", "a int").collect()
    for name, body in (("e1", '{"episode_id": "one"}'), ("e2", "{broken"), ("e 3", "{}")):
        (tmp_path / "eps" / name).mkdir(parents=True)
        (tmp_path / "eps" / name / "metadata.json").write_text(body)
    assert {r.episode_id for r in files.episodes(spark, f"{tmp_path}/eps").collect()} == {"one", "e2", "e 3"}
    with pytest.raises(ValueError):
        files.require_unique(spark.createDataFrame([("a",), ("a",)], "k string"), "k")
    files.write_document(spark, {"a": 1}, f"file://{tmp_path}/d.json")
    assert files.read_value(spark, f"file://{tmp_path}/d.json") == {"a": 1}


MAN = "row_index long, source_clip_path string, dataset string, clip_uid string, source_start_sec double, source_end_sec double, task_hint string"


def test_generic_manifest(spark):
    ok = lambda p: True
    load = lambda rows, seconds, **k: manifests.load_manifest(spark.createDataFrame(rows, MAN), lambda p: seconds, ok, **k).collect()
    r = load([(0, "/v.mp4", "robot/actionnet", "episode 1", None, None, None)], 12.5)[0]
    assert (r.dataset, r.clip_uid, r.duration_sec, r.narration_used, r.task_hint) == ("robot-actionnet", "episode-1", 12.5, False, None)
    with pytest.raises(ValueError, match=r"outside \[3.0, 30.0\]"):
        load([(0, "/v.mp4", None, "a", None, None, None)], 2.9, most=30.0)
    r = load([(0, "/v.mp4", None, None, 101.25, 114.75, None)], 500.0)[0]
    assert (r.duration_sec, r.source_seek_offset_sec, r.clip_video_end_sec) == (13.5, 101.25, 114.75) and r.clip_uid.startswith("generic_mp4-v-")
    with pytest.raises(ValueError, match="duplicate_clip_uid"):
        load([(0, "/v.mp4", None, "a", None, None, None), (1, "/v.mp4", None, "a", None, None, None)], 10.0)
    with pytest.raises(ValueError, match="empty"):
        load([], 10.0)


def test_catalogue(spark):
    clips = spark.createDataFrame([(f"c{k}", f"v{k % 3}", "/c.mp4", k != 4, 0.0, 10.0 + k) for k in range(9)], "clip_uid string, video_uid string, source_clip_path string, found boolean, video_start_sec double, video_end_sec double")
    videos = spark.createDataFrame([(0, "v0", ["old"]), (1, "v0", ["cook"]), (2, "v1", ["wash"])], "pos int, video_uid string, scenarios array<string>")
    got = manifests.catalogue(clips, videos, 3).collect()
    assert {r.scenario for r in got} == {"cook", "wash", "unknown"} and len(got) == 3
    with pytest.raises(RuntimeError):
        manifests.catalogue(clips, videos, 9)


def test_v3_and_v2_layouts(spark, tmp_path):
    root = tmp_path / "v3"
    (root / "meta" / "episodes" / "chunk-000").mkdir(parents=True)
    (root / "meta" / "info.json").write_text(json.dumps({"features": {"cam": {"dtype": "video"}}}))
    schema = "episode_index long, `videos/cam/chunk_index` long, `videos/cam/file_index` long, `videos/cam/from_timestamp` double, `videos/cam/to_timestamp` double, tasks array<string>"
    spark.createDataFrame([(7, 0, 2, 101.25, 114.75, ["do it"]), (8, 0, 3, 0.0, 1.0, [])], schema).toPandas().to_parquet(root / "meta/episodes/chunk-000/file-000.parquet")
    video = root / "videos/cam/chunk-000/file-002.mp4"
    video.parent.mkdir(parents=True)
    video.write_bytes(b"x")
    rows, counts = manifests.episode_index_v3(spark, str(root), "d", "cam")
    r = rows.first()
    assert (r.clip_uid, r.source_start_sec, r.source_end_sec, r.task_hint, r.reference_caption, r.narration_used) == ("d-episode-000007", 101.25, 114.75, None, "do it", False)
    assert counts["prepared"] == 1 and counts["skipped_duration"] == 1
    with pytest.raises(ValueError):
        manifests.episode_index_v3(spark, str(root), "d", "other")
    root = tmp_path / "v2"
    (root / "meta").mkdir(parents=True)
    (root / "meta/info.json").write_text(json.dumps({"codebase_version": "v2.1", "fps": 50, "chunks_size": 1000, "video_path": "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"}))
    (root / "meta/episodes.jsonl").write_text('{"episode_index": 1083, "length": 312, "tasks": ["t"]}\n{"episode_index": 2, "length": 312, "tasks": []}\n')
    video = root / "videos/chunk-001/cam/episode_001083.mp4"
    video.parent.mkdir(parents=True)
    video.write_bytes(b"x")
    rows, counts = manifests.episode_files_v2(spark, str(root), "d", "cam")
    r = rows.first()
    assert "chunk-001" in r.source_clip_path and r.duration_sec_reference == 6.24 and r.task_hint is None and counts == {"prepared": 1, "missing_video": 1}


def test_raw_trajectories(spark, tmp_path):
    for outcome, ok, serial in (("success", True, "11"), ("failure", False, "22")):
        folder = tmp_path / outcome / "day" / "run"
        (folder / "recordings/MP4").mkdir(parents=True)
        (folder / f"recordings/MP4/{serial}.mp4").write_bytes(b"x")
        (folder / "metadata_1.json").write_text(json.dumps({"uuid": f"u+{outcome}", "current_task": "pour", "success": ok, "wrist_cam_serial": serial, "ext1_cam_serial": serial, "ext2_cam_serial": "9"}))
    rows, counts = manifests.raw_trajectories(spark, str(tmp_path), probe=lambda p: 4.184)
    r = rows.first()
    assert (r.clip_uid, r.duration_sec_reference, r.task_hint, r.reference_caption) == ("droid-raw-u-success", 4.184, None, "pour") and r.source_clip_path.endswith("/11.mp4")
    assert counts == {"prepared": 1, "metadata_scanned": 1}
    rows, counts = manifests.raw_trajectories(spark, str(tmp_path), camera="ext1", probe=lambda p: 2.999)
    assert rows.count() == 0 and counts["skipped_duration"] == 1
    assert manifests.raw_trajectories(spark, str(tmp_path), outcome="all", camera="ext2", probe=lambda p: 5.0)[1]["missing_video"] == 2
    with pytest.raises(ValueError):
        manifests.raw_trajectories(spark, str(tmp_path), camera="top")


def test_stamps_and_segments(spark):
    index = spark.createDataFrame([("a", 1.7e9, 1.7e9 + 10, 2, 301), ("b", 1.7e18, 1.7e18 + 1e10, 2, 301), ("c", None, None, 0, 300), ("d", 5.0, 5.0, 9, 0)], "path string, first_stamp double, last_stamp double, stamps int, frames int")
    got = {r.path: r.fps for r in manifests.stamped_trajectories(index, 20.0).collect()}
    assert got == {"a": 30.0, "b": 30.0, "c": 20.0}
    segs = spark.createDataFrame([(0, "s1", "/a.mp4", True, None, "ref"), (1, "s2", None, True, "d", None), (2, "s3", "/gone.mp4", True, "d", None), (3, "s4", "/d.mp4", False, "d", None)], "pos int, subtask_id string, processed_subtask string, export_ok boolean, dataset string, reference_caption string")
    r = manifests.segment_episodes(segs, is_file=lambda p: p == "/a.mp4").collect()
    assert [(x.episode_id, x.source, x.task_hint, x.cameras[0].path) for x in r] == [("s1", "ego4d_v2", None, "/a.mp4")]


def test_exports(spark):
    rows = spark.createDataFrame([("/s.mp4", 101.25, 5.5, 8.0, "/t1"), ("/s.mp4", 0.0, 0.0, 8.0, "/t2"), ("/bad.mp4", 0.0, 0.0, 8.0, "/t3")], "source_clip_path string, source_seek_offset_sec double, start_sec double, duration_sec double, target string")
    out = {r.target: r for r in media.export(rows, "window", lambda c: int("/bad.mp4" in c), lambda p: 8.0 if p == "/t1" else 8.36).collect()}
    assert [out[t].export_error for t in ("/t1", "/t2", "/t3")] == [None, "duration_mismatch", "ffmpeg_failed"] and out["/t1"].export_ok
    assert "106.750" in media.cut_command("/s.mp4", 106.75, 8.0, "/t", 24)
    assert value(spark, media.parse_rate(F.col("r")), r=("30000/1001", "string")) == 30000 / 1001 and value(spark, media.parse_rate(F.col("r")), r=("1/0", "string")) is None


def test_prepare_to_finalize(spark, tmp_path):
    sources = spark.createDataFrame([("clip", "d", 70.0)], "clip_uid string, dataset string, duration_sec double")
    good = lambda df: df.withColumns({"export_ok": F.lit(True), "exported_duration_sec": F.col("duration_sec")})
    windows = long_video.prepare(sources, good).drop("start_sec", "duration_sec")
    assert [r.window_start_sec for r in windows.orderBy("window_index").collect()] == [0.0, 25.0, 40.0]
    eps = windows.select("episode_id", F.col("window_duration_sec").alias("duration_sec"), F.lit("P").alias("prompt"), F.lit("Sweep the floor.").alias("task_hint"), labels.sample_times(F.col("window_duration_sec")).alias("times"))
    subtasks, report, _ = annotate.annotate(eps, "mock", keeper(spark, tmp_path))
    out = long_video.finalize(sources, windows, subtasks, report, good)
    assert out["summary"]["timeline_duration_sec"] == 70 and out["pending"].count() == 0 and out["unknown"].count() == 0
    assert out["training"].count() + out["review"].count() == out["timeline"].count() == out["decisions"].count()
    assert out["summaries"].first().long_video_caption == "Sweep the floor."
    with pytest.raises(RuntimeError):
        long_video.finalize(sources, windows, subtasks, report.limit(0), good)
    known = spark.createDataFrame([("old", True), ("mine", False), (eps.first().episode_id, True)], "episode_id string, generated boolean")
    assert [r.episode_id for r in long_video.stale(known, eps).collect()] == ["old"]


def test_frames_and_prompt(spark):
    def read(path, seconds):
        if seconds > 5:
            raise OSError("no frame")
        return b"jpeg"

    eps = spark.createDataFrame([("e", "/v.mp4", [1.0, 6.0], [1.5, 6.5])], "episode_id string, path string, times array<double>, source_times array<double>")
    out = media.frames(eps, read, lambda e, k: f"/tmp/{e}_{k}.jpg", lambda p, b: None).orderBy("sample_index").collect()
    assert [(r.image_path, r.error) for r in out] == [("/tmp/e_0.jpg", None), (None, "frame_sampling_failure")]
    said = value(spark, text.user_prompt(F.lit("e"), F.lit(6.0), F.lit(None).cast("string"), F.lit([0.5, 1.5]).cast("array<double>")))
    assert "Episode e, 6.000 seconds" in said and '"time_sec":1.5' in said and "none" in said


def test_settings(spark, tmp_path):
    from cliptide.plans import settings

    (tmp_path / "c.json").write_text(json.dumps({"validation": {"continuity_tolerance_sec": 0.25}, "backend": {"type": "mock"}}))
    s = settings.load(f"{tmp_path}/c.json")
    assert s.validation.continuity_tolerance_sec == 0.25 and s.segmentation.min_subtask_duration_sec == 3.0 and s.backend.type == "mock"
    assert settings.load_text(settings.snapshot(s)) == s
    for bad in ('{"validation": {"oops": 1}}', '{"sampling": {"fps": 0}}', '{"backend": {"type": "other"}}', "[1]"):
        with pytest.raises(ValueError):
            settings.load_text(bad)
    runs = spark.createDataFrame([("e", "t1", 1), ("e", "t2", 2), ("f", "t1", 3)], "episode_id string, run_ts string, v int")
    assert {r.episode_id: r.v for r in settings.latest(runs).collect()} == {"e": 2, "f": 3}


def test_reports(spark):
    rows = spark.createDataFrame([("c<1>", 0.0, 0.01, 10.0, "move", 'a "b"', ["x"]), ("c<1>", 5.0, 10.0, 10.0, "cut", None, [])], "clip_uid string, start_sec double, end_sec double, source_duration_sec double, action string, label string, quality_flags array<string>")
    page = reports.pages(rows).first().page
    assert "c&lt;1&gt;" in page and "width:0.500%" in page and "left:50.000%" in page and "&quot;b&quot;" in page
    line = reports.markdown(spark.createDataFrame([("e|1", "a\nb", "p", ["r1", "r2"])], "episode_id string, reference string, predicted string, review_reasons array<string>")).first().line
    assert "e\\|1" in line and "a b" in line and "r1, r2" in line and "\n" not in line
    assert "<script>" not in reports.stats_page({"a": "<script>"}) and "%3C" not in reports.index(["a"])


def test_command_line(spark, tmp_path, monkeypatch):
    note = {"episode_id": "e", "duration_sec": 10.0, "video_level_instruction": "Do.", "episode_quality_flags": [], "subtasks": [{"subtask_id": 0, "start_time_sec": 0.0, "end_time_sec": 10.0, "action": "move", "fine_action": "move", "object": "cup", "instruction": "Go.", "training_eligible": True, "quality_flags": []}]}
    (tmp_path / "a.jsonl").write_text(json.dumps(note) + "\n")
    cli.main(["validate", "--annotations", f"{tmp_path}/a.jsonl", "--output", f"{tmp_path}/v"])
    cli.main(["stats", "--annotations", f"{tmp_path}/a.jsonl", "--output", f"{tmp_path}/s"])
    cli.main(["review", "--annotations", f"{tmp_path}/a.jsonl", "--validation", f"{tmp_path}/v", "--output", f"{tmp_path}/r"])
    assert spark.read.json(f"{tmp_path}/v").first().valid and spark.read.json(f"{tmp_path}/s").first().n == 1
    assert spark.read.json(f"{tmp_path}/r/accepted_annotations").count() == 1
    monkeypatch.setattr(cli, "ffmpeg", lambda c: 0)
    with pytest.raises(SystemExit):
        cli.main(["prepare"])
    assert os.path.exists(tmp_path / "a.jsonl")
