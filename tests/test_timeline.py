"""Set-based operators against plain sequential loops on seeded random rows, and the survey's fixtures."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cliptide.functions.rounding import round3
from cliptide.operators import intervals, stitch
from cliptide.plans import long_video

CAND = "clip_uid string, candidate_id string, episode_id string, pos long, start_sec double, end_sec double, action string, fine_action string, object string, instruction string, training_eligible boolean, quality_flags array<string>, edge_margin_sec double"


def cand(i, s, e, action="move", fine=None, obj="cup", flags=(), eligible=None, clip="clip", margin=1.0, text="Do it."):
    return (clip, f"c{i}", f"ep{i}", i, float(s), float(e), action, fine or action, obj, text, (not flags) if eligible is None else eligible, list(flags), margin)


def test_rounding_is_pythons(spark):
    r = random.Random(1)
    xs = [r.randrange(0, 3_000_000) / 1000 + 0.0005 for _ in range(5000)] + [r.uniform(0, 4000) for _ in range(5000)] + [0.0005, 0.0015, 2.5, 0.0]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", round3(F.col("x")).alias("y")).collect()
    assert all(g.y == round(g.x, 3) for g in got)


def windows_plain(d, w, o):
    if d <= w:
        return [(0.0, round(d, 3))]
    out, k, stride = [], 0, w - o
    while k * stride + w < d - 1e-6:
        out.append(round(k * stride, 3))
        k += 1
    tail = round(max(0.0, d - w), 3)
    if not out or abs(out[-1] - tail) > 1e-3:
        out.append(tail)
    return [(s, round(min(d, s + w), 3)) for s in out]


def test_windows(spark):
    r = random.Random(2)
    ds = [480.0, 12.5, 30.0, 30.0005, 55.0, 55.0004, 80.0] + [round(r.uniform(1, 900), 3) for _ in range(300)]
    for w, o in ((30.0, 5.0), (10.0, 0.0), (7.5, 2.5)):
        rows = spark.createDataFrame([(d,) for d in ds], "d double").select("d", intervals.window_bounds(F.col("d"), w, o).alias("w")).collect()
        for x in rows:
            assert [tuple(v) for v in x.w] == windows_plain(x.d, w, o)
    with pytest.raises(ValueError):
        intervals.window_bounds(F.lit(1.0), 5.0, 5.0)


def random_candidates(seed, n_clips=25):
    r = random.Random(seed)
    rows, i = [], 0
    for c in range(n_clips):
        for _ in range(r.randrange(0, 40)):
            s = round(r.uniform(0, 95), 3)
            e = round(min(100.0, s + r.choice([0, 0.05, 0.15, 1, 2.5, 8, 30]) * r.uniform(0.5, 1.5)), 3)
            rows.append(cand(i, s, e, r.choice(["move", "other", "idle", "cut"]), r.choice([None, "peel"]), r.choice(["cup", None, "Lid  x"]), r.choice([(), (), ("analysis_window_edge",), ("x", "analysis_window_edge"), ("y",)]), clip=f"clip{c:02d}", margin=round(r.uniform(0, 5), 3), text=r.choice(["Go.", "go", "Lift it. ", ""])))
            i += 1
    return rows


def key_plain(r):
    return ((r["fine_action"] or r["action"] or "other").strip().lower(), " ".join((r["object"] or "").lower().split()))


def stitch_plain(duration, cands):
    """The timeline before the minimum, by loops over one clip."""
    live = [c for c in cands if c["end_sec"] > c["start_sec"]]
    groups = []
    for v in sorted([0.0, duration] + [c[k] for c in live for k in ("start_sec", "end_sec")]):
        if groups and not v - groups[-1][-1] > 0.15:
            groups[-1].append(v)
        else:
            groups.append([v])
    b = [round(sum(round(v * 1000) for v in g) / len(g) / 1000, 3) for g in groups]
    b[0], b[-1] = 0.0, duration
    out = []
    for s, e in zip(b, b[1:]):
        if e - s <= 1e-4:
            continue
        on = [c for c in live if c["start_sec"] <= (s + e) / 2 < c["end_sec"]]
        row = {"start_sec": s, "end_sec": e, "action": "other", "fine_action": "other", "object": None, "instruction": stitch.FILLER_TEXT, "training_eligible": False, "quality_flags": ["uncovered_by_qwen"], "candidate_ids": [], "source_episode_ids": [], "label_source": "coverage_filler"}
        if on:
            best = max(on, key=lambda c: (c["training_eligible"], stitch.EDGE not in c["quality_flags"], c["edge_margin_sec"], c["end_sec"] - c["start_sec"], c["candidate_id"]))
            same = [c for c in on if key_plain(c) == key_plain(best)]
            every = all(stitch.EDGE in c["quality_flags"] for c in same)
            flags = list(dict.fromkeys(f for c in same for f in c["quality_flags"] if f != stitch.EDGE or every))
            row |= {k: best[k] for k in ("action", "fine_action", "object", "instruction")} | {"training_eligible": best["training_eligible"] and not flags, "quality_flags": flags, "candidate_ids": sorted(c["candidate_id"] for c in same), "source_episode_ids": sorted(c["episode_id"] for c in same), "label_source": "qwen_visual_only"}
        last = out[-1] if out else None
        if last and key_plain(last) == key_plain(row) and last["label_source"] == row["label_source"]:
            last["end_sec"] = row["end_sec"]
            last["training_eligible"] &= row["training_eligible"]
            last["quality_flags"] = list(dict.fromkeys(last["quality_flags"] + row["quality_flags"]))
            for k in ("candidate_ids", "source_episode_ids"):
                last[k] = sorted(set(last[k] + row[k]))
        else:
            out.append(row)
    return out


def by_clip(rows):
    """Rows by clip, in order of start."""
    out = {}
    for r in sorted(rows, key=lambda r: (r["clip_uid"], r["start_sec"])):
        out.setdefault(r["clip_uid"], []).append(r)
    return out


def shortest_first(rows, least):
    """The minimum length by rescanning all rows each time; a row is a list of the rows it was made of."""
    size = lambda g: round(g["end"] - g["start"], 3)
    kind = lambda r: key_plain(r)
    groups = [{"start": r["start_sec"], "end": r["end_sec"], "kind": kind(r), "text": r["instruction"] or "", "of": [r]} for r in rows]
    while len(groups) > 1 and any(size(g) < least for g in groups):
        i = min(range(len(groups)), key=lambda k: (size(groups[k]), k))
        near = [k for k in (i - 1, i + 1) if 0 <= k < len(groups)]
        j = min(near, key=lambda k: (groups[k]["kind"] != groups[i]["kind"], size(groups[k]), k))
        a, b = groups[min(i, j)], groups[max(i, j)]
        same = a["kind"] == b["kind"]
        groups[min(i, j) : max(i, j) + 1] = [{"start": a["start"], "end": b["end"], "kind": a["kind"] if same else ("compound", ""), "text": stitch.joined(a["text"], b["text"]), "of": a["of"] + b["of"]}]
    out = []
    for g in groups:
        first, mixed = g["of"][0], len({kind(r) for r in g["of"]}) > 1
        bare = sum(round(1000 * r["end_sec"]) - round(1000 * r["start_sec"]) for r in g["of"] if "uncovered_by_qwen" in r["quality_flags"])
        out.append(first | {"end_sec": g["end"], "action": "other" if mixed else first["action"], "instruction": g["text"] if len(g["of"]) > 1 else first["instruction"], "candidate_ids": sorted({c for r in g["of"] for c in r["candidate_ids"]}), "uncovered_duration_sec": bare / 1000, "label_source": stitch.MERGED if mixed else first["label_source"]})
    return out


def test_timeline_equals_plain_loops(spark):
    rows = random_candidates(4)
    clips = sorted({r[0] for r in rows})
    df = spark.createDataFrame(rows, CAND)
    sources = spark.createDataFrame([(c, "d/s", 100.0) for c in clips], "clip_uid string, dataset string, duration_sec double")
    names = [c.split()[0] for c in CAND.split(", ")]
    plain = {c: stitch_plain(100.0, [dict(zip(names, r)) for r in rows if r[0] == c]) for c in clips}
    fields = ("start_sec", "end_sec", "action", "fine_action", "object", "instruction", "training_eligible", "quality_flags", "candidate_ids", "source_episode_ids", "label_source")
    got = by_clip(r.asDict() for r in stitch.merge_neighbours(stitch.resolve(df, sources)).collect())
    for c in clips:
        assert [{k: r[k] for k in fields} for r in got[c]] == [{k: r[k] for k in fields} for r in plain[c]]
    final = by_clip(r.asDict() for r in stitch.timeline(df, sources, 3.0).collect())
    for c in clips:
        want = shortest_first(plain[c], 3.0)
        assert [(r["start_sec"], r["end_sec"], r["action"], r["label"], r["candidate_ids"], r["uncovered_duration_sec"], r["label_source"]) for r in final[c]] == [(r["start_sec"], r["end_sec"], r["action"], r["instruction"], r["candidate_ids"], r["uncovered_duration_sec"], r["label_source"]) for r in want]
        assert final[c][0]["start_sec"] == 0 and final[c][-1]["end_sec"] == 100 and all(r["duration_sec"] >= 3 for r in final[c])
        assert final[c][0]["segment_id"] == f"d-s__{c}__seg0000"
        assert all(not r["quality_flags"] for r in final[c] if r["training_eligible"])


@pytest.fixture(scope="module")
def one(spark):
    def run(duration, rows, least=1.0):
        sources = spark.createDataFrame([("clip", "actionnet", duration)], "clip_uid string, dataset string, duration_sec double")
        return [r.asDict() for r in stitch.timeline(spark.createDataFrame(rows, CAND), sources, least).orderBy("start_sec").collect()]

    return run


def test_fixture_overlap_of_one_meaning(one):
    out = one(20.0, [cand(0, 0, 8), cand(1, 5, 12), cand(2, 12, 20, "open", obj="drawer")])
    assert [(r["start_sec"], r["end_sec"], r["action"]) for r in out] == [(0, 12, "move"), (12, 20, "open")]
    assert out[0]["candidate_ids"] == ["c0", "c1"] and out[0]["segment_id"] == "actionnet__clip__seg0000"


def test_fixture_gaps(one):
    out = one(20.0, [cand(0, 3, 8, "wipe", obj="table")])
    assert out[0]["start_sec"] == 0 and out[-1]["end_sec"] == 20
    gaps = [r for r in out if "uncovered_by_qwen" in r["quality_flags"]]
    assert len(gaps) == 2 and not any(r["training_eligible"] for r in gaps) and sum(r["uncovered_duration_sec"] for r in out) == 15


def test_fixture_open_fine_action(one):
    out = one(10.0, [cand(0, 0, 6, "other", "peel", "vegetable"), cand(1, 6, 10, "other", "wash", "vegetable")])
    assert [r["training_eligible"] for r in out] == [True, True]


def test_fixture_minimum(one):
    out = one(10.0, [cand(0, 0, 4), cand(1, 4, 5.5, "open", obj="drawer"), cand(2, 5.5, 10, "close", obj="drawer")], 3.0)
    merged = [r for r in out if "merged_for_min_duration" in r["quality_flags"]]
    assert len(merged) == 1 and not merged[0]["training_eligible"] and all(r["duration_sec"] >= 3 for r in out)
    with pytest.raises(Exception, match="shorter"):
        one(2.0, [cand(0, 0, 2)], 3.0)


def test_interval_operators_equal_loops(spark):
    r = random.Random(7)
    rows, plain = [], {}
    for ep in range(60):
        own = []
        for p in range(r.randrange(1, 15)):
            s = round(r.uniform(0, 40), 2)
            own.append((f"e{ep:02d}", p, s, round(s + r.choice([0.5, 1, 2, 5, 10]), 2), r.choice("ab"), r.choice(["x", None]), f"t{p}", 50.0))
        rows += own
        plain[f"e{ep:02d}"] = own
    df = spark.createDataFrame(rows, "episode_id string, pos int, start_sec double, end_sec double, action string, object string, instruction string, duration_sec double")
    cover = {x.episode_id: x.coverage_ratio for x in intervals.coverage(df, "episode_id", "duration_sec").collect()}
    dup = {(x.episode_id, x.pos): x.duplicate for x in intervals.contained(df, "episode_id", "action", "object").collect()}
    flag = {(x.episode_id, x.pos): x.order_flag for x in intervals.gap_flags(df, "episode_id").collect()}
    merged = intervals.interactions(df, "episode_id", 1.5).collect()
    for ep, own in plain.items():
        spans = []
        for s, e in sorted((x[2], min(50.0, x[3])) for x in own):
            if spans and s <= spans[-1][1]:
                spans[-1][1] = max(spans[-1][1], e)
            else:
                spans.append([s, e])
        assert cover[ep] == round(min(1, sum(round(e * 1000) - round(s * 1000) for s, e in spans) / 1000 / 50), 4)
        kept = []
        for x in sorted(own, key=lambda x: (x[2], x[3], x[1])):
            inside = any(x[2] >= k[2] and x[3] <= k[3] and x[4:6] == k[4:6] for k in kept)
            assert dup[ep, x[1]] == inside
            if not inside:
                kept.append(x)
        before = None
        for x in own:
            want = None if before is None else "overlapping_segments" if x[2] < before - 0.2 else "large_temporal_gap" if x[2] - before > 1 else None
            assert flag[ep, x[1]] == want
            before = max(before or 0.0, x[3])
        rows_ = []
        for x in sorted(own, key=lambda x: (x[2], x[3], x[1])):
            if rows_ and rows_[-1][2:] == list(x[4:6]) and x[2] - rows_[-1][1] <= 1.5:
                rows_[-1][1] = max(rows_[-1][1], x[3])
            else:
                rows_.append([x[2], x[3], *x[4:6]])
        got = sorted((m.subtask_id, m.start_sec, m.end_sec, m.action, m.object) for m in merged if m.episode_id == ep)
        assert [list(g[1:]) for g in got] == rows_


def test_summary_fixture(spark):
    sources = spark.createDataFrame([("clip", 10.0)], "clip_uid string, duration_sec double")
    windows = spark.createDataFrame([("w0", "clip", 0.0)], "episode_id string, clip_uid string, window_start_sec double")
    reports = spark.createDataFrame([("w0", "Fold the shirt.")], "episode_id string, video_level_instruction string")
    segments = spark.createDataFrame([("clip", 0.0, "a", True), ("clip", 3.0, "b", False), ("clip", 6.0, "c", True)], "clip_uid string, start_sec double, label string, training_eligible boolean")
    r = long_video.summaries(sources, windows, reports, segments).first()
    assert (r.long_video_caption, r.segment_count, r.training_segment_count, r.summary_caption_source) == ("Fold the shirt.", 3, 2, "derived_from_qwen_window_captions")
    assert math.isclose(r.source_duration_sec, 10.0)
