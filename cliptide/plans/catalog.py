"""The library's operators as queries over the driver's tables, each with the same query in DuckDB's SQL.

Clips are users of `events`, whose month is read as 2592 seconds; an event is a candidate that starts at its time and
lasts `value` seconds. Slices of 100 seconds of a clip are episodes with annotations.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliptide.functions import labels, text
from cliptide.functions.rounding import milliseconds, round3
from cliptide.operators import annotations as ann
from cliptide.operators import intervals, stitch

CLIP_SECONDS = 2592.0
EPISODE_SECONDS = 100.0
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def _query(sql: str | None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r3(x: str) -> str:
    """round3 of a column as SQL."""
    p, split = f"({x}*1000::DOUBLE)", f"({x}*134217729::DOUBLE)"
    high = f"({split}-({split}-{x}))"
    error = f"(({high}*1000::DOUBLE-{p})+({x}-{high})*1000::DOUBLE)"
    return f"(CASE WHEN {p}-floor({p})=0.5 AND {error}>0 THEN ceil({p}) WHEN {p}-floor({p})=0.5 AND {error}<0 THEN floor({p}) ELSE round_even({p},0) END/1000::DOUBLE)"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events")
    return e.select(
        F.col("user_id").cast("string").alias("clip_uid"),
        F.col("event_id").alias("pos"),
        "event_type",
        "value",
        F.get_json_object("props", "$.k").cast("int").alias("k"),
        (F.expr("timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts)") / F.lit(1e9)).alias("s"),
    )


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    action = F.expr("CASE event_type WHEN 'click' THEN 'press' WHEN 'view' THEN 'idle' WHEN 'purchase' THEN 'move' WHEN 'signup' THEN 'open' ELSE 'other' END")
    rows = events(spark, sf_dir).withColumns({"action": action, "e": F.least(F.lit(CLIP_SECONDS), F.col("s") + F.col("value"))})
    flags = F.when(F.col("k") % 7 == 0, F.array(F.lit(stitch.EDGE))).otherwise(F.expr("cast(array() as array<string>)"))
    rows = rows.select(
        "clip_uid", "pos", F.concat(F.lit("e"), F.col("pos").cast("string")).alias("candidate_id"), F.concat_ws("_", "clip_uid", F.floor(F.col("s") / EPISODE_SECONDS).cast("string")).alias("episode_id"),
        round3(F.col("s")).alias("start_sec"), round3(F.col("e")).alias("end_sec"), "action", F.when(F.col("k") % 3 == 0, "tap").otherwise(F.col("action")).alias("fine_action"),
        F.when(F.col("k") % 5 != 0, F.concat(F.lit("obj"), (F.col("k") % 5).cast("string"))).alias("object"), F.when(F.col("k") % 11 == 0, "").otherwise(F.concat_ws(" ", "action", F.lit("it."))).alias("instruction"),
        ((F.col("event_type") != "error") & (F.col("k") % 7 != 0)).alias("training_eligible"), flags.alias("quality_flags"), round3(F.col("value") / F.lit(2.0)).alias("edge_margin_sec"), "k",
    )
    return rows.where("end_sec > start_sec")


def clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select("clip_uid").distinct().select("clip_uid", F.lit("events").alias("dataset"), F.lit(CLIP_SECONDS).alias("duration_sec"))


def episode_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subtasks on episode time; ends are clipped to the episode."""
    c = candidates(spark, sf_dir)
    base = F.floor(F.col("start_sec") / EPISODE_SECONDS) * F.lit(EPISODE_SECONDS)
    local = c.withColumns({"ls": F.col("start_sec") - base, "le": F.least(F.lit(EPISODE_SECONDS), F.col("end_sec") - base), "episode_id": F.concat_ws("_", "clip_uid", F.floor(F.col("start_sec") / EPISODE_SECONDS).cast("string"))})
    return local.select("episode_id", "pos", F.lit(EPISODE_SECONDS).alias("duration_sec"), round3(F.col("ls")).alias("start_sec"), round3(F.col("le")).alias("end_sec"), "action", "fine_action", "object", "instruction", "training_eligible", "quality_flags", "k")


_EV = """ev AS (SELECT CAST(user_id AS VARCHAR) AS clip_uid, event_id AS pos, event_type, value, CAST(json_extract_string(props,'$.k') AS INT) AS k, (epoch_us(ts)-1704067200000000)/1e9::DOUBLE AS s FROM events)"""
_C0 = """c0 AS (SELECT *, CASE event_type WHEN 'click' THEN 'press' WHEN 'view' THEN 'idle' WHEN 'purchase' THEN 'move' WHEN 'signup' THEN 'open' ELSE 'other' END AS action, least(2592::DOUBLE, s+value) AS e, value/2::DOUBLE AS half FROM ev)"""
_CANDS = f"""{_EV}, {_C0}, c1 AS (SELECT clip_uid, pos, 'e'||pos AS candidate_id, {r3('s')} AS start_sec, {r3('e')} AS end_sec, action, CASE WHEN k%3=0 THEN 'tap' ELSE action END AS fine_action, CASE WHEN k%5<>0 THEN 'obj'||(k%5) END AS object, CASE WHEN k%11=0 THEN '' ELSE action||' it.' END AS instruction, event_type<>'error' AND k%7<>0 AS training_eligible, k%7=0 AS on_edge, {r3('half')} AS edge_margin_sec, k FROM c0), cands AS (SELECT * FROM c1 WHERE end_sec>start_sec), clips AS (SELECT DISTINCT clip_uid, 2592::DOUBLE AS duration_sec FROM ev)"""
_EPS = f"""{_CANDS}, l0 AS (SELECT *, clip_uid||'_'||CAST(floor(start_sec/100) AS BIGINT) AS episode_id, start_sec-floor(start_sec/100)*100::DOUBLE AS ls, least(100::DOUBLE, end_sec-floor(start_sec/100)*100::DOUBLE) AS le FROM cands), eps AS (SELECT episode_id, pos, {r3('ls')} AS start_sec, {r3('le')} AS end_sec, action, fine_action, object, instruction, training_eligible, on_edge, k FROM l0)"""
_BOUNDS = f"""{_CANDS}, bv AS (SELECT clip_uid, start_sec AS v FROM cands UNION ALL SELECT clip_uid, end_sec FROM cands UNION ALL SELECT clip_uid, 0::DOUBLE FROM clips UNION ALL SELECT clip_uid, duration_sec FROM clips), bn AS (SELECT *, CASE WHEN v-lag(v) OVER (PARTITION BY clip_uid ORDER BY v)<=0.15::DOUBLE THEN 0 ELSE 1 END AS fresh FROM bv), bg AS (SELECT *, sum(fresh) OVER (PARTITION BY clip_uid ORDER BY v ROWS UNBOUNDED PRECEDING) AS idx FROM bn), bm AS (SELECT clip_uid, idx, sum(CAST(round_even(v*1000::DOUBLE,0) AS BIGINT))::DOUBLE/count(*)/1000::DOUBLE AS m FROM bg GROUP BY ALL), bounds AS (SELECT clip_uid, CAST(idx AS BIGINT) AS idx, CASE WHEN idx=max(idx) OVER (PARTITION BY clip_uid) THEN 2592::DOUBLE WHEN idx=1 THEN 0::DOUBLE ELSE {r3('m')} END AS sec FROM bm)"""
_ATOMS = f"""{_BOUNDS}, ato AS (SELECT clip_uid, sec AS start_sec, lead(sec) OVER (PARTITION BY clip_uid ORDER BY idx) AS end_sec FROM bounds), atoms AS (SELECT *, (start_sec+end_sec)/2::DOUBLE AS mid FROM ato WHERE end_sec-start_sec>1e-4), hits AS (SELECT a.clip_uid, a.start_sec, a.end_sec, c.candidate_id, c.action, c.fine_action, c.object, c.instruction, c.training_eligible AS el, c.on_edge, c.pos, lower(trim(coalesce(nullif(c.fine_action,''),c.action,'other'))) AS ka, lower(coalesce(c.object,'')) AS ko, row_number() OVER (PARTITION BY a.clip_uid, a.start_sec ORDER BY c.training_eligible DESC NULLS LAST, NOT c.on_edge DESC, c.edge_margin_sec DESC, c.end_sec-c.start_sec DESC, c.candidate_id DESC) AS rn FROM atoms a LEFT JOIN cands c ON c.clip_uid=a.clip_uid AND c.start_sec<=a.mid AND a.mid<c.end_sec), best AS (SELECT * FROM hits WHERE rn=1), same AS (SELECT b.clip_uid, b.start_sec, list_sort(list(h.candidate_id)) AS ids, bool_and(h.on_edge) AS all_edge FROM best b JOIN hits h ON h.clip_uid=b.clip_uid AND h.start_sec=b.start_sec AND h.ka=b.ka AND h.ko=b.ko AND h.candidate_id IS NOT NULL GROUP BY ALL), res AS (SELECT b.clip_uid, b.start_sec, b.end_sec, coalesce(b.action,'other') AS action, coalesce(b.fine_action,'other') AS fine_action, b.object, coalesce(b.instruction,'Review uncovered activity.') AS instruction, b.candidate_id, coalesce(b.el AND NOT s.all_edge, false) AS training_eligible, CASE WHEN b.candidate_id IS NULL THEN 'uncovered_by_qwen' WHEN s.all_edge THEN 'analysis_window_edge' ELSE '' END AS flag, coalesce(s.ids, []) AS ids, CASE WHEN b.candidate_id IS NULL THEN 'coverage_filler' ELSE 'qwen_visual_only' END AS label_source, coalesce(b.ka,'other') AS ka, CASE WHEN b.candidate_id IS NULL THEN '' ELSE b.ko END AS ko FROM best b LEFT JOIN same s ON s.clip_uid=b.clip_uid AND s.start_sec=b.start_sec)"""


@_query("""WITH d AS (SELECT CAST(user_id AS VARCHAR) AS clip_uid, max(value)::DOUBLE+max((epoch_us(ts)-1704067200000000)/1e9::DOUBLE)/10::DOUBLE AS raw FROM events GROUP BY 1), s AS (SELECT clip_uid, """ + r3("raw") + """ AS d FROM d), n AS (SELECT *, greatest(0, CAST(ceil((d-30::DOUBLE-1e-6::DOUBLE)/25::DOUBLE) AS INT)) AS n, greatest(0::DOUBLE, d-30::DOUBLE) AS tr FROM s), t AS (SELECT *, """ + r3("tr") + """ AS tail FROM n), g AS (SELECT clip_uid, d, i AS window_index, i*25::DOUBLE AS ws FROM t, generate_series(0, n-1) AS q(i) WHERE d>30 UNION ALL SELECT clip_uid, d, n, tail FROM t WHERE d>30 AND (n=0 OR abs((n-1)*25::DOUBLE-tail)>1e-3) UNION ALL SELECT clip_uid, d, 0, 0::DOUBLE FROM t WHERE d<=30), h AS (SELECT *, CASE WHEN d<=30 THEN d ELSE least(d, ws+30::DOUBLE) END AS we, we-ws AS wd FROM g) SELECT clip_uid, CAST(window_index AS INT) AS window_index, printf('events_long__%s__win%04d', clip_uid, window_index) AS episode_id, """ + r3("ws") + """ AS window_start_sec, """ + r3("we") + """ AS window_end_sec, """ + r3("wd") + """ AS window_duration_sec FROM h""")
def analysis_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = events(spark, sf_dir).groupBy("clip_uid").agg((F.max("value").cast("double") + F.max("s") / F.lit(10.0)).alias("raw"))
    rows = intervals.analysis_windows(sources.select("clip_uid", F.lit("events").alias("dataset"), round3(F.col("raw")).alias("duration_sec")))
    return rows.select("clip_uid", "window_index", "episode_id", "window_start_sec", "window_end_sec", "window_duration_sec")


_WIN = f"""{_CANDS}, w0 AS (SELECT *, CAST(floor(start_sec/25) AS INT) AS wi FROM cands), wa AS (SELECT *, least(wi*25::DOUBLE, 2562::DOUBLE) AS ws FROM w0), w1 AS (SELECT *, clip_uid||'_'||wi AS episode_id, start_sec-ws AS a, least(30::DOUBLE, end_sec-ws) AS b FROM wa WHERE wi%5<>4), w2 AS (SELECT *, greatest(0::DOUBLE,least(2592::DOUBLE, ws+a)) AS ga, greatest(0::DOUBLE,least(2592::DOUBLE, ws+b)) AS gb, (a<=2.5 AND ws>0) OR (b>=27.5 AND ws+30<2592) AS edge, least(a, 30::DOUBLE-b) AS mg FROM w1 WHERE b>a)"""


def _windowed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Subtasks in 30 s windows of stride 25, the last one right-aligned, the windows (every fifth not exported) and the sources."""
    rows = candidates(spark, sf_dir).withColumn("wi", F.floor(F.col("start_sec") / 25).cast("int"))
    rows = rows.withColumn("episode_id", F.concat_ws("_", "clip_uid", F.col("wi").cast("string")))
    start = F.least(F.col("wi") * F.lit(25.0), F.lit(CLIP_SECONDS - 30.0))
    subtasks = rows.select("episode_id", F.col("pos").cast("int").alias("subtask_id"), (F.col("start_sec") - start).alias("start_time_sec"), (F.col("end_sec") - start).alias("end_time_sec"), "action", "fine_action", "object", "instruction", (F.col("action") != "other").alias("training_eligible"), F.expr("cast(array() as array<string>)").alias("quality_flags"))
    windows = rows.select("clip_uid", "episode_id", "wi").distinct().select("clip_uid", "episode_id", F.col("wi").alias("window_index"), start.alias("window_start_sec"), (start + 30.0).alias("window_end_sec"), F.lit(30.0).alias("window_duration_sec"), F.lit(5.0).alias("overlap_sec"), (F.col("wi") % 5 != 4).alias("export_ok"))
    return subtasks, windows, clips(spark, sf_dir)


@_query(f"""WITH {_WIN} SELECT printf('%s__qseg%03d', episode_id, CAST(pos AS INT)) AS candidate_id, episode_id, clip_uid, action, {r3('a')} AS local_start_sec, {r3('b')} AS local_end_sec, {r3('ga')} AS start_sec, {r3('gb')} AS end_sec, action<>'other' AND NOT edge AS training_eligible, CASE WHEN edge THEN 'analysis_window_edge' ELSE '' END AS flags, {r3('mg')} AS edge_margin_sec FROM w2""")
def window_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ann.candidates(*_windowed(spark, sf_dir))
    return rows.select("candidate_id", "episode_id", "clip_uid", "action", "local_start_sec", "local_end_sec", "start_sec", "end_sec", "training_eligible", F.array_join("quality_flags", ",").alias("flags"), "edge_margin_sec")


@_query(f"""WITH {_CANDS}, w0 AS (SELECT clip_uid||'_'||CAST(floor(start_sec/25) AS INT) AS episode_id, CAST(floor(start_sec/25) AS INT) AS wi FROM cands) SELECT episode_id, count(*) AS n FROM w0 WHERE wi%5=4 GROUP BY 1""")
def unknown_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    subtasks, windows, _ = _windowed(spark, sf_dir)
    return ann.unknown_episodes(subtasks, windows).groupBy("episode_id").agg(F.count(F.lit(1)).alias("n"))


@_query(f"""WITH {_CANDS}, w0 AS (SELECT DISTINCT clip_uid, CAST(floor(start_sec/25) AS INT) AS wi FROM cands), w1 AS (SELECT *, clip_uid||'_'||wi AS episode_id FROM w0) SELECT count(*) AS expected, count(*) FILTER (wi%3<>0) AS completed, count(*) FILTER (wi%3=0) AS pending, min(CASE WHEN wi%3=0 THEN episode_id END) AS first_pending FROM w1 WHERE wi%5<>4""")
def status_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, windows, _ = _windowed(spark, sf_dir)
    expected = windows.where("export_ok").select("episode_id")
    done = windows.where("window_index % 3 <> 0").select("episode_id")
    marked = expected.join(done.withColumn("done", F.lit(True)), "episode_id", "left")
    return marked.agg(F.count(F.lit(1)).alias("expected"), F.count_if("done").alias("completed"), F.count_if(F.col("done").isNull()).alias("pending"), F.min(F.when(F.col("done").isNull(), F.col("episode_id"))).alias("first_pending"))


@_query(f"""WITH {_CANDS}, w0 AS (SELECT DISTINCT clip_uid||'_'||CAST(floor(start_sec/25) AS INT) AS episode_id, CAST(floor(start_sec/25) AS INT) AS wi FROM cands) SELECT episode_id, 'pending' AS run FROM w0 WHERE wi%3<>0 UNION ALL SELECT episode_id, 'retry' FROM w0 WHERE wi%4=0""")
def resume_pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, windows, _ = _windowed(spark, sf_dir)
    w = windows.select("episode_id", F.col("window_index").alias("wi"))
    done, failed = w.where("wi % 3 = 0"), w.where("wi % 4 = 0")
    return ann.pending(w, done).select("episode_id", F.lit("pending").alias("run")).unionByName(ann.pending(w, done, failed, True).select("episode_id", F.lit("retry").alias("run")))


@_query(f"WITH {_BOUNDS} SELECT clip_uid, idx, sec FROM bounds")
def boundary_coalesce(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.boundaries(candidates(spark, sf_dir), clips(spark, sf_dir))


@_query(f"WITH {_ATOMS} SELECT clip_uid, start_sec, end_sec, action, object, candidate_id, training_eligible, label_source FROM res")
def atomic_resolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stitch.resolve(candidates(spark, sf_dir), clips(spark, sf_dir))
    return rows.select("clip_uid", "start_sec", "end_sec", "action", "object", "candidate_id", "training_eligible", "label_source")


@_query(f"""WITH {_ATOMS}, mn AS (SELECT *, CASE WHEN ka=lag(ka) OVER w AND ko=lag(ko) OVER w AND label_source=lag(label_source) OVER w THEN 0 ELSE 1 END AS fresh FROM res WINDOW w AS (PARTITION BY clip_uid ORDER BY start_sec)), mi AS (SELECT *, sum(fresh) OVER (PARTITION BY clip_uid ORDER BY start_sec ROWS UNBOUNDED PRECEDING) AS i FROM mn) SELECT clip_uid, min(start_sec) AS start_sec, max(end_sec) AS end_sec, arg_min(action, start_sec) AS action, arg_min(instruction, start_sec) AS instruction, bool_and(training_eligible) AS training_eligible, coalesce(string_agg(DISTINCT nullif(flag,''), ',' ORDER BY nullif(flag,'')),'') AS flags, array_to_string(list_sort(list_distinct(flatten(list(ids)))), ',') AS candidate_ids, arg_min(label_source, start_sec) AS label_source FROM mi GROUP BY clip_uid, i""")
def atomic_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stitch.merge_neighbours(stitch.resolve(candidates(spark, sf_dir), clips(spark, sf_dir)))
    return rows.select("clip_uid", "start_sec", "end_sec", "action", "instruction", "training_eligible", F.array_join(F.array_sort("quality_flags"), ",").alias("flags"), F.array_join("candidate_ids", ",").alias("candidate_ids"), "label_source")


@_query(None)
def final_timeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The minimum-length fixpoint is sequential; tests hold it against a plain loop."""
    return stitch.timeline(candidates(spark, sf_dir), clips(spark, sf_dir))


@_query(f"""WITH {_EPS} SELECT episode_id, pos, coalesce(max(end_sec) OVER (PARTITION BY episode_id, action, object ORDER BY start_sec, end_sec, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)>=end_sec, false) AS duplicate FROM eps""")
def contained_dups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.contained(episode_rows(spark, sf_dir), "episode_id", "action", "object").select("episode_id", "pos", "duplicate")


@_query(f"""WITH {_EPS}, g AS (SELECT *, lag(end_sec) OVER w AS b, lead(start_sec) OVER w AS a FROM eps WINDOW w AS (PARTITION BY episode_id ORDER BY start_sec, end_sec, pos)), h AS (SELECT *, coalesce(start_sec-b>0 AND start_sec-b<=1.5::DOUBLE,false) AS l, coalesce(a-end_sec>0 AND a-end_sec<=1.5::DOUBLE,false) AS r, (start_sec+b)/2::DOUBLE AS ms, (a+end_sec)/2::DOUBLE AS me FROM g) SELECT episode_id, pos, CASE WHEN l THEN {r3('ms')} ELSE start_sec END AS start_sec, CASE WHEN r THEN {r3('me')} ELSE end_sec END AS end_sec, l AS gap_repaired FROM h""")
def gap_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.closed_gaps(episode_rows(spark, sf_dir), "episode_id", 1.5).select("episode_id", "pos", "start_sec", "end_sec", "gap_repaired")


@_query(f"""WITH {_EPS}, a AS (SELECT *, CASE WHEN action IS NOT DISTINCT FROM lag(action) OVER w AND object IS NOT DISTINCT FROM lag(object) OVER w THEN 0 ELSE 1 END AS ch FROM eps WINDOW w AS (PARTITION BY episode_id ORDER BY start_sec, end_sec, pos)), b AS (SELECT *, sum(ch) OVER (PARTITION BY episode_id ORDER BY start_sec, end_sec, pos ROWS UNBOUNDED PRECEDING) AS run FROM a), c AS (SELECT *, CASE WHEN start_sec-max(end_sec) OVER (PARTITION BY episode_id, run ORDER BY start_sec, end_sec, pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)<=5::DOUBLE THEN 0 ELSE 1 END AS br FROM b), d AS (SELECT *, sum(br) OVER (PARTITION BY episode_id, run ORDER BY start_sec, end_sec, pos ROWS UNBOUNDED PRECEDING) AS isl FROM c), m AS (SELECT episode_id, run, isl, min(start_sec) AS start_sec, max(end_sec) AS end_sec, min(action) AS action, min(object) AS object, count(*) AS merged_rows FROM d GROUP BY ALL) SELECT episode_id, CAST(row_number() OVER (PARTITION BY episode_id ORDER BY run, isl)-1 AS INT) AS subtask_id, start_sec, end_sec, action, object, merged_rows FROM m""")
def interaction_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.interactions(episode_rows(spark, sf_dir), "episode_id", 5.0).select("episode_id", F.col("subtask_id").cast("int").alias("subtask_id"), "start_sec", "end_sec", "action", "object", "merged_rows")


_FLAGS = f"""{_EPS}, o AS (SELECT *, greatest(0::DOUBLE, max(end_sec) OVER (PARTITION BY episode_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) AS pe, row_number() OVER (PARTITION BY episode_id ORDER BY pos) AS rn FROM eps), fl AS (SELECT *, list_filter([CASE WHEN action NOT IN ('transit','idle','other') AND object IS NULL THEN 'missing_object' END, CASE WHEN instruction='' THEN 'empty_instruction' END, CASE WHEN start_sec<0 OR end_sec>100.000001 OR end_sec<=start_sec THEN 'invalid_time_range' END, CASE WHEN greatest(0::DOUBLE,end_sec-start_sec)<3::DOUBLE THEN 'too_short_segment' END, CASE WHEN rn=1 THEN NULL WHEN start_sec<pe-0.2::DOUBLE THEN 'overlapping_segments' WHEN start_sec-pe>1::DOUBLE THEN 'large_temporal_gap' END], lambda x: x IS NOT NULL) AS flags FROM o)"""


@_query(f"WITH {_FLAGS} SELECT episode_id, pos, array_to_string(flags, ',') AS flags FROM fl")
def overlap_gap_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.row_flags(episode_rows(spark, sf_dir)).select("episode_id", "pos", F.array_join("flags", ",").alias("flags"))


_COVER = """cv AS (SELECT episode_id, greatest(0::DOUBLE,start_sec) AS s, least(100::DOUBLE,end_sec) AS e FROM eps WHERE end_sec>start_sec), cn AS (SELECT *, CASE WHEN s<=max(e) OVER (PARTITION BY episode_id ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM cv), ci AS (SELECT *, sum(fresh) OVER (PARTITION BY episode_id ORDER BY s, e ROWS UNBOUNDED PRECEDING) AS i FROM cn), cs AS (SELECT episode_id, i, min(s) AS s, max(e) AS e FROM ci GROUP BY ALL), cover AS (SELECT episode_id, sum(CAST(round_even(e*1000::DOUBLE,0) AS BIGINT)-CAST(round_even(s*1000::DOUBLE,0) AS BIGINT))::DOUBLE/1000::DOUBLE AS covered_sec FROM cs GROUP BY 1)"""


@_query(f"WITH {_EPS}, {_COVER} SELECT episode_id, covered_sec, round_even(least(1::DOUBLE, covered_sec/100::DOUBLE)*10000::DOUBLE,0)/10000::DOUBLE AS coverage_ratio FROM cover")
def coverage_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intervals.coverage(episode_rows(spark, sf_dir), "episode_id", "duration_sec")


_VALID = f"""{_FLAGS}, {_COVER}, rf AS (SELECT episode_id, list_distinct(flatten(list(flags))) AS rowf, count(*) AS n, bool_and(action='idle') AS idle, count(*) FILTER (action='other' AND fine_action IN ('','other','unknown','n/a')) AS vague, arg_min(start_sec,pos) AS f, arg_max(end_sec,pos) AS l FROM fl GROUP BY 1), ef AS (SELECT rf.episode_id, round_even(least(1::DOUBLE, coalesce(covered_sec,0)/100::DOUBLE)*10000::DOUBLE,0)/10000::DOUBLE AS coverage_ratio, list_sort(list_distinct(list_concat(rowf, list_filter([CASE WHEN CAST(split_part(rf.episode_id,'_',1) AS INT)%9=0 THEN 'missing_video_level_instruction' END, CASE WHEN n>50 THEN 'too_many_segments' END, CASE WHEN idle THEN 'idle_only_episode' END, CASE WHEN vague/n::DOUBLE>0.3::DOUBLE THEN 'other_dominant' END, CASE WHEN f>1 OR 100-l>1 THEN 'large_temporal_gap' END, CASE WHEN round_even(least(1::DOUBLE, coalesce(covered_sec,0)/100::DOUBLE)*10000::DOUBLE,0)/10000::DOUBLE<0.7::DOUBLE THEN 'low_temporal_coverage' END], lambda x: x IS NOT NULL)))) AS flags FROM rf LEFT JOIN cover USING (episode_id)), ev2 AS (SELECT *, list_filter(flags, lambda x: x IN ('vlm_parse_failure','missing_video_level_instruction','empty_subtasks','overlapping_segments','idle_only_episode','low_temporal_coverage','other_dominant')) AS retry FROM ef), valid AS (SELECT *, len(retry)=0 AND len(list_filter(flags, lambda x: x IN ('invalid_action','missing_object','empty_instruction','invalid_time_range','overlapping_segments','missing_video_level_instruction','empty_subtasks')))=0 AS ok FROM ev2)"""


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = episode_rows(spark, sf_dir)
    clip = F.split("episode_id", "_")[0].cast("int")
    eps = rows.select("episode_id").distinct().select("episode_id", F.lit(EPISODE_SECONDS).alias("duration_sec"), F.when(clip % 9 != 0, "Do it.").alias("video_level_instruction"))
    return ann.validate(eps, rows)


@_query(f"WITH {_VALID} SELECT episode_id, coverage_ratio, array_to_string(flags, ',') AS quality_flags, array_to_string(retry, ',') AS retry_reasons, ok AS valid FROM valid")
def episode_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _validated(spark, sf_dir).select("episode_id", "coverage_ratio", F.array_join("quality_flags", ",").alias("quality_flags"), F.array_join("retry_reasons", ",").alias("retry_reasons"), "valid")


_REASONS = f"""{_VALID}, an AS (SELECT episode_id, list_sort(list(pos) FILTER (NOT training_eligible)) AS bad, bool_or(k%13=0) AS own FROM eps GROUP BY 1), rv AS (SELECT an.episode_id, CASE WHEN CAST(split_part(an.episode_id,'_',1) AS INT)%7=0 THEN ['missing_validation'] ELSE list_concat(CASE WHEN ok THEN [] WHEN len(retry)>0 THEN list_transform(retry, lambda x: 'validation:'||x) ELSE ['validation:invalid'] END, list_transform(list_sort(list_distinct(list_concat(flags, CASE WHEN own THEN ['time_clamped','same_interaction_merged'] ELSE [] END))), lambda x: 'flag:'||x)) END AS base, bad FROM an JOIN valid USING (episode_id)), reasons AS (SELECT episode_id, list_concat(list_filter(base, lambda x: x<>'flag:same_interaction_merged'), CASE WHEN len(bad)>0 THEN ['ineligible_subtasks:'||array_to_string(bad, ',')] ELSE [] END) AS reasons FROM rv)"""


def _reviewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = F.when(F.bool_or(F.col("k") % 13 == 0), F.array(F.lit("time_clamped"), F.lit("same_interaction_merged"))).otherwise(F.expr("cast(array() as array<string>)"))
    bad = F.array_sort(F.collect_list(F.when(~F.col("training_eligible"), F.col("pos"))))
    notes = episode_rows(spark, sf_dir).groupBy("episode_id").agg(own.alias("episode_quality_flags"), bad.alias("ineligible"))
    return ann.review_reasons(notes, _validated(spark, sf_dir).where(F.split("episode_id", "_")[0].cast("int") % 7 != 0))


@_query(f"WITH {_REASONS} SELECT episode_id, array_to_string(reasons, ';') AS review_reasons, len(reasons)=0 AS accepted FROM reasons")
def review_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _reviewed(spark, sf_dir).select("episode_id", F.array_join("review_reasons", ";").alias("review_reasons"), (F.size("review_reasons") == 0).alias("accepted"))


@_query(f"WITH {_REASONS}, x AS (SELECT unnest(reasons) AS reason FROM reasons) SELECT split_part(reason, ':', 1)||CASE WHEN reason LIKE 'ineligible%' OR reason NOT LIKE '%:%' THEN '' ELSE ':'||split_part(reason, ':', 2) END AS reason, count(*) AS n FROM x GROUP BY 1")
def reason_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    reason = F.explode("review_reasons").alias("r")
    kind = F.when(F.col("r").startswith("ineligible"), F.substring_index("r", ":", 1)).otherwise(F.col("r"))
    return _reviewed(spark, sf_dir).select(reason).select(kind.alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


_MS = "sum(CAST(round_even(end_sec*1000::DOUBLE,0) AS BIGINT)-CAST(round_even(start_sec*1000::DOUBLE,0) AS BIGINT))::DOUBLE"


@_query(f"WITH {_CANDS}, t AS (SELECT action, count(*) AS n, {_MS}/1000::DOUBLE AS total_sec, {_MS}/count(*)/1000::DOUBLE AS av FROM cands GROUP BY 1) SELECT action, n, total_sec, {r3('av')} AS average_sec FROM t")
def action_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.action_totals(candidates(spark, sf_dir))


@_query(f"WITH {_CANDS}, d AS (SELECT end_sec-start_sec AS d FROM cands) SELECT CASE WHEN d<0.5 THEN '<0.5' WHEN d<1 THEN '0.5-1' WHEN d<2 THEN '1-2' WHEN d<5 THEN '2-5' WHEN d<10 THEN '5-10' ELSE '>=10' END AS bin, count(*) AS n FROM d GROUP BY 1")
def duration_hist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return candidates(spark, sf_dir).groupBy(labels.duration_bin(F.col("end_sec") - F.col("start_sec")).alias("bin")).agg(F.count(F.lit(1)).alias("n"))


@_query(f"WITH {_FLAGS}, x AS (SELECT episode_id, unnest(flags) AS flag FROM fl) SELECT flag, count(*) AS n, count(DISTINCT episode_id) AS episodes FROM x GROUP BY 1")
def flag_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = ann.row_flags(episode_rows(spark, sf_dir)).select("episode_id", F.explode("flags").alias("flag"))
    return rows.groupBy("flag", "episode_id").agg(F.count(F.lit(1)).alias("c")).groupBy("flag").agg(F.sum("c").alias("n"), F.count(F.lit(1)).alias("episodes"))


@_query(f"WITH {_EPS}, n AS (SELECT episode_id, count(*) AS subtasks FROM eps GROUP BY 1) SELECT subtasks, count(*) AS episodes FROM n GROUP BY 1")
def subtasks_dist(spark: SparkSession, sf_dir: str) -> DataFrame:
    return episode_rows(spark, sf_dir).groupBy("episode_id").agg(F.count(F.lit(1)).alias("subtasks")).groupBy("subtasks").agg(F.count(F.lit(1)).alias("episodes"))


@_query(f"WITH {_ATOMS}, m AS (SELECT *, CAST(round_even(end_sec*1000::DOUBLE,0) AS BIGINT)-CAST(round_even(start_sec*1000::DOUBLE,0) AS BIGINT) AS ms FROM res) SELECT clip_uid, count(*) AS segments, count(*) FILTER (training_eligible) AS training, sum(ms)::DOUBLE/1000::DOUBLE AS timeline_sec, round_even(sum(ms) FILTER (label_source='coverage_filler')::DOUBLE/sum(ms)*10000::DOUBLE,0)/10000::DOUBLE AS uncovered_ratio, round_even(coalesce(sum(ms) FILTER (action='idle'),0)::DOUBLE/sum(ms)*10000::DOUBLE,0)/10000::DOUBLE AS idle_ratio FROM m GROUP BY 1")
def timeline_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stitch.resolve(candidates(spark, sf_dir), clips(spark, sf_dir)).withColumn("ms", milliseconds(F.col("end_sec")) - milliseconds(F.col("start_sec")))
    part = lambda c: F.rint(F.sum(F.when(c, F.col("ms")).otherwise(0)).cast("double") / F.sum("ms") * F.lit(10000.0)) / F.lit(10000.0)
    return rows.groupBy("clip_uid").agg(F.count(F.lit(1)).alias("segments"), F.count_if("training_eligible").alias("training"), (F.sum("ms") / F.lit(1000.0)).alias("timeline_sec"), part(F.col("label_source") == stitch.FILLER).alias("uncovered_ratio"), part(F.col("action") == "idle").alias("idle_ratio"))


@_query(f"WITH {_CANDS}, s AS (SELECT candidate_id AS clip_uid, action||coalesce(object,'') AS scenario, sha1('42:'||candidate_id) AS score FROM cands WHERE end_sec-start_sec BETWEEN 3 AND 300), r AS (SELECT *, row_number() OVER (PARTITION BY scenario ORDER BY score, clip_uid)>1 AS again FROM s) SELECT clip_uid, scenario, score FROM r ORDER BY again, score, clip_uid LIMIT 40")
def diverse_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir).where((F.col("end_sec") - F.col("start_sec")).between(3, 300))
    rows = rows.select(F.col("candidate_id").alias("clip_uid"), F.concat("action", F.coalesce("object", F.lit(""))).alias("scenario"), labels.selection_score(42, F.col("candidate_id")).alias("score"))
    return ann.diverse(rows, 40, order=("score", "clip_uid"))


@_query("SELECT conv_id, turn, role FROM conversations ORDER BY conv_id, turn LIMIT 50 OFFSET 17")
def offset_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.page(_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role"), ["conv_id", "turn"], 17, 50)


_STOP = "'a','an','and','the','to','from','in','on','at','with','of','it','his','her','their','both','camera','wearer','person','then','into'"


def _words(x: str) -> str:
    return f"list_distinct(list_filter(regexp_extract_all(lower(coalesce({x},'')), '[a-z0-9]+'), lambda w: len(w)>1 AND w NOT IN ({_STOP})))"


_REF = f"""rw AS (SELECT d.doc_id, {_words('d.text')} AS p, {_words('b.text')} AS r, coalesce(b.text,'') AS reference FROM documents d CROSS JOIN (SELECT max(item_id)+1 AS m FROM benchmark) LEFT JOIN benchmark b ON b.item_id=((d.doc_id%m)+m)%m), rj AS (SELECT *, CASE WHEN len(list_distinct(list_concat(p,r)))=0 THEN 0::DOUBLE ELSE len(list_intersect(p,r))::DOUBLE/len(list_distinct(list_concat(p,r))) END AS j FROM rw)"""


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document beside the benchmark item of its number, counted round the whole benchmark; none where it is missing."""
    b = _table(spark, sf_dir, "benchmark").select((F.col("item_id")).alias("item"), F.col("text").alias("reference"))
    number = F.pmod(F.col("doc_id"), b.select(F.max("item") + 1).scalar())
    d = _table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("predicted"), number.alias("item"))
    return ann.evaluate_references(d.join(b, "item", "left").withColumn("reference", F.coalesce("reference", F.lit(""))).withColumn("predicted_actions", F.array(F.lit("move"))))


@_query(f"WITH {_REF} SELECT doc_id, round_even(j*10000::DOUBLE,0)/10000::DOUBLE AS lexical_jaccard, reference<>'' AND j<0.1::DOUBLE AS low_overlap FROM rj")
def reference_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _references(spark, sf_dir).select("doc_id", "lexical_jaccard", F.array_contains("flags", "low_reference_overlap").alias("low_overlap"))


@_query(f"WITH {_REF} SELECT count(*) AS episodes, count(*) FILTER (reference<>'') AS with_reference, count(*) FILTER (j<0.1::DOUBLE) AS low_overlap, sum(CAST(round_even(j*10000::DOUBLE,0) AS BIGINT))::DOUBLE/count(*)/10000::DOUBLE AS mean_jaccard FROM rj")
def reference_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = F.sum(F.rint(F.col("lexical_jaccard") * F.lit(10000.0)).cast("long"))
    return _references(spark, sf_dir).agg(F.count(F.lit(1)).alias("episodes"), F.count_if(F.col("reference") != "").alias("with_reference"), F.count_if(F.array_contains("flags", "low_reference_overlap")).alias("low_overlap"), (total / F.count(F.lit(1)) / F.lit(10000.0)).alias("mean_jaccard"))


_ACTIONS_SQL = ", ".join(f"CASE WHEN regexp_matches(t, '(^|[^a-z0-9_])({'|'.join(forms.split())})($|[^a-z0-9_])') THEN '{a}' END" for a, forms in text.VERBS.items())


@_query(f"WITH a AS (SELECT p_partkey, lower(p_name||' '||CASE p_partkey%6 WHEN 0 THEN 'picked and folded it' WHEN 1 THEN 'then mixes, turned' WHEN 2 THEN 'unfolds.' WHEN 3 THEN 'reopened' WHEN 4 THEN 'Closed-tap walk' ELSE '' END) AS t FROM part) SELECT p_partkey, array_to_string(list_filter([{_ACTIONS_SQL}], lambda x: x IS NOT NULL), ',') AS actions FROM a")
def reference_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = F.expr("p_name || ' ' || CASE p_partkey % 6 WHEN 0 THEN 'picked and folded it' WHEN 1 THEN 'then mixes, turned' WHEN 2 THEN 'unfolds.' WHEN 3 THEN 'reopened' WHEN 4 THEN 'Closed-tap walk' ELSE '' END")
    return _table(spark, sf_dir, "part").select("p_partkey", F.array_join(text.named_actions(said), ",").alias("actions"))


@_query(f"WITH {_CANDS}, x AS (SELECT action, training_eligible AND pos%10<>3 AS training FROM cands) SELECT training, action, count(*) AS n FROM x GROUP BY ALL")
def train_review_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = candidates(spark, sf_dir).withColumn("export_ok", F.col("pos") % 10 != 3)
    parts = [ann.training_rows(rows, t).select(F.lit(t).alias("training"), "action") for t in (True, False)]
    return parts[0].unionByName(parts[1]).groupBy("training", "action").agg(F.count(F.lit(1)).alias("n"))


_CAPTIONS = """c0 AS (SELECT conv_id, turn, CASE turn%4 WHEN 0 THEN 'Open  the door.' WHEN 1 THEN 'open the DOOR' WHEN 2 THEN 'then review uncovered activity.' ELSE 'Take item '||turn||'; ' END AS raw FROM conversations UNION ALL SELECT conv_id, 1000+i, 'Step '||(conv_id%3)||' '||i FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id%5=0), generate_series(0,11) AS q(i)), c1 AS (SELECT conv_id, turn, regexp_replace(regexp_replace(trim(regexp_replace(raw,'\\s+',' ','g')),'(then\\s+)?review uncovered activity\\.?','','gi'),'\\s+',' ','g') AS t FROM c0), c2 AS (SELECT conv_id, turn, trim(t,' ;.')||'.' AS c FROM c1 WHERE trim(t,' ;.')<>''), c3 AS (SELECT *, lag(lower(c)) OVER (PARTITION BY conv_id ORDER BY turn) AS b FROM c2), c4 AS (SELECT conv_id, list(c ORDER BY turn) AS cs FROM c3 WHERE b IS NULL OR b<>lower(c) GROUP BY 1), c5 AS (SELECT conv_id, cs, CASE WHEN len(cs)<=8 THEN cs ELSE list_transform(list_sort(list_distinct(list_transform(range(0,8), lambda i: CAST(round_even(i*(len(cs)-1)/7::DOUBLE,0) AS INT)))), lambda i: cs[i+1]) END AS rs FROM c4), c6 AS (SELECT conv_id, len(cs) AS n_captions, list_transform(rs, lambda c: rtrim(c,'.')) AS v FROM c5)"""


@_query(f"WITH {_CAPTIONS} SELECT conv_id, n_captions, CASE len(v) WHEN 1 THEN v[1]||'.' WHEN 2 THEN 'First, '||v[1]||'; then, '||v[2]||'.' ELSE 'First, '||v[1]||'; then, '||array_to_string(v[2:len(v)-1],'; then, ')||'; finally, '||v[len(v)]||'.' END AS caption FROM c6")
def video_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations")
    raw = F.expr("CASE turn % 4 WHEN 0 THEN 'Open  the door.' WHEN 1 THEN 'open the DOOR' WHEN 2 THEN 'then review uncovered activity.' ELSE 'Take item ' || turn || '; ' END")
    more = turns.where("conv_id % 5 = 0").select("conv_id").distinct().select("conv_id", F.explode(F.sequence(F.lit(0), F.lit(11))).alias("i"))
    said = turns.select("conv_id", "turn", raw.alias("raw")).unionByName(more.select("conv_id", (F.col("i") + 1000).cast("long").alias("turn"), F.format_string("Step %d %d", F.col("conv_id") % 3, F.col("i")).alias("raw")))
    listed = said.groupBy("conv_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("turn", "raw"))), lambda x: x["raw"]).alias("all"))
    kept = listed.withColumn("captions", text.distinct_neighbours(F.col("all"))).withColumn("chosen", text.representatives(F.col("captions")))
    return kept.where(F.size("captions") > 0).select("conv_id", F.size("captions").cast("long").alias("n_captions"), text.long_caption(F.col("chosen")).alias("caption"))


_RAW = "CASE p_partkey%9 WHEN 0 THEN 'Pick-Up' WHEN 1 THEN ' move ' WHEN 2 THEN 'take  off' WHEN 3 THEN 'juggle' WHEN 4 THEN NULL WHEN 5 THEN 'Reposition Gripper' WHEN 6 THEN 'n/a' WHEN 7 THEN 'TURN' ELSE p_name END"
_FINE = "CASE p_partkey%4 WHEN 0 THEN 'Unknown' WHEN 1 THEN '' WHEN 2 THEN 'Spin-it' ELSE 'other' END"
_OBJ = "CASE p_partkey%5 WHEN 0 THEN ' N/A ' WHEN 1 THEN 'None' WHEN 2 THEN '' WHEN 3 THEN NULL ELSE ' '||p_name||' ' END"
_TOK = lambda x: f"trim(regexp_replace(lower(replace(coalesce({x},''),'-',' ')),'\\s+',' ','g'))"
_ALIAS_SQL = ", ".join(f"'{k}': '{v}'" for k, v in labels.ALIASES.items())
_VOCAB_SQL = ",".join(f"'{a}'" for a in labels.ACTIONS)


@_query(f"WITH a AS (SELECT p_partkey, {_RAW} AS raw, {_FINE} AS fine, {_OBJ} AS obj FROM part), b AS (SELECT *, {_TOK('raw')} AS t, {_TOK('fine')} AS f FROM a), c AS (SELECT *, coalesce(MAP {{{_ALIAS_SQL}}}[t], MAP {{{_ALIAS_SQL}}}[replace(t,' ','_')]) AS al FROM b), d AS (SELECT *, CASE WHEN t IN ({_VOCAB_SQL}) THEN t ELSE coalesce(al,'other') END AS action, CASE WHEN t IN ({_VOCAB_SQL}) THEN NULL WHEN al IS NOT NULL THEN 'action_synonym_mapped' ELSE 'out_of_vocabulary_action' END AS flag FROM c), e AS (SELECT *, CASE WHEN f IN ('','unknown','n/a') THEN CASE WHEN t='' THEN action ELSE t END ELSE f END AS fine_action FROM d) SELECT p_partkey, t AS token, action, flag, fine_action, coalesce(flag='out_of_vocabulary_action',false) AND fine_action NOT IN ('','other','unknown','n/a') AS inferred, CASE WHEN lower(trim(obj)) IN ('','null','none','n/a','unknown') THEN NULL ELSE trim(obj) END AS object, action NOT IN ('transit','idle','other') AS object_required FROM e")
def normalize_action(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _table(spark, sf_dir, "part").select("p_partkey", F.expr(_RAW).alias("raw"), F.expr(_FINE).alias("fine"), F.expr(_OBJ).alias("obj"))
    raw, fine = F.col("raw"), F.col("fine")
    return p.select("p_partkey", labels.token(raw).alias("token"), labels.action(raw).alias("action"), labels.action_flag(raw).alias("flag"), labels.fine_action(raw, fine).alias("fine_action"), labels.inferred(raw, fine).alias("inferred"), labels.object_name(F.col("obj")).alias("object"), labels.object_required(labels.action(raw)).alias("object_required"))


@_query("SELECT page_id, coalesce(nullif(trim(regexp_replace(url,'[^A-Za-z0-9_.-]+','-','g'),'-.'),''),substr(sha1(url),1,16)) AS safe_id, trim(regexp_replace(url,'[^\\p{L}\\p{N}_-]','-','g'),'-') AS adapter_id, sha1('42:'||url) AS score, 'd-'||regexp_replace(list_last(string_split(url,'/')),'(.)\\.[^.]*$','\\1')||'-'||substr(sha1(url),1,8) AS clip_uid FROM pages")
def safe_identifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    u = F.col("url")
    return _table(spark, sf_dir, "pages").select("page_id", labels.safe_identifier(u).alias("safe_id"), labels.adapter_identifier(u).alias("adapter_id"), labels.selection_score(42, u).alias("score"), labels.default_clip_uid(F.lit("d"), u).alias("clip_uid"))


@_query("WITH a AS (SELECT event_id, value::DOUBLE AS d, CASE WHEN event_id%2=0 THEN -0.4::DOUBLE ELSE 1.5::DOUBLE END AS off, greatest(1, least(128, CAST(ceil(value::DOUBLE*2) AS INT))) AS n FROM events), b AS (SELECT *, CASE WHEN n=1 THEN [d/2] ELSE list_transform(range(0,n), lambda i: least((i+0.5::DOUBLE)*d/n, greatest(0::DOUBLE, d-0.001::DOUBLE))) END AS ts FROM a) SELECT event_id, n, ts[1] AS first_sec, ts[n] AS last_sec, greatest(0::DOUBLE, ts[1]+off) AS first_camera_sec FROM b")
def sample_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _table(spark, sf_dir, "events").select("event_id", F.col("value").cast("double").alias("d"), F.when(F.col("event_id") % 2 == 0, F.lit(-0.4)).otherwise(F.lit(1.5)).alias("off"))
    t = e.withColumn("ts", labels.sample_times(F.col("d")))
    return t.select("event_id", F.size("ts").alias("n"), F.get("ts", F.lit(0)).alias("first_sec"), F.try_element_at("ts", F.lit(-1)).alias("last_sec"), F.get(labels.camera_times(F.col("ts"), F.col("off")), F.lit(0)).alias("first_camera_sec"))


@_query("SELECT event_id, CASE event_id%6 WHEN 3 THEN false WHEN 4 THEN false ELSE true END AS is_object, CASE event_id%6 WHEN 3 THEN NULL WHEN 4 THEN NULL ELSE CAST(json_extract_string(props,'$.k') AS INT) END AS k, CASE event_id%6 WHEN 5 THEN 0::DOUBLE ELSE value::DOUBLE END AS number FROM events")
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    reply = F.expr("CASE event_id % 6 WHEN 0 THEN props WHEN 1 THEN '```json\n' || props || '\n```' WHEN 2 THEN 'Sure: ' || props || ' done' WHEN 3 THEN '[1, 2]' WHEN 4 THEN 'nothing {' ELSE '  ```' || props || '```' END")
    e = _table(spark, sf_dir, "events").withColumn("o", text.model_object(reply))
    number = labels.lenient_double(F.when(F.col("event_id") % 6 == 5, F.lit("oops")).otherwise(F.col("value").cast("string")))
    return e.select("event_id", F.col("o").isNotNull().alias("is_object"), F.get_json_object("o", "$.k").cast("int").alias("k"), number.alias("number"))


@_query("WITH a AS (SELECT event_id AS i, 'u'||(event_id%997) AS uid, CASE WHEN event_id%50=0 THEN ' ' ELSE '/v.mp4' END AS path, CASE WHEN event_id%41=0 THEN NULL ELSE value::DOUBLE END AS c, CASE event_id%7 WHEN 0 THEN -1::DOUBLE WHEN 1 THEN 2.5::DOUBLE END AS st, CASE event_id%9 WHEN 0 THEN value::DOUBLE+1 WHEN 1 THEN 2::DOUBLE END AS en FROM events), b AS (SELECT *, coalesce(st,0::DOUBLE) AS s, coalesce(en,c) AS e, coalesce(en,c)-coalesce(st,0::DOUBLE) AS raw FROM a), d AS (SELECT *, " + r3("raw") + " AS duration_sec FROM b), x AS (SELECT *, CASE WHEN trim(path)='' THEN 'missing_path' WHEN c IS NULL OR c<=0 THEN 'probe_failed' WHEN s<0 OR e<=s THEN 'invalid_range' WHEN e>c+0.5 THEN 'beyond_container' WHEN NOT duration_sec BETWEEN 3 AND 300 THEN 'duration_outside' END AS err FROM d) SELECT i AS row_index, CASE WHEN err IS NULL AND row_number() OVER (PARTITION BY uid, err IS NULL ORDER BY i)>1 THEN 'duplicate_clip_uid' ELSE err END AS error, duration_sec FROM x")
def manifest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value").cast("double")
    i = F.col("event_id")
    rows = _table(spark, sf_dir, "events").select(
        i.alias("row_index"), F.concat(F.lit("u"), (i % 997).cast("string")).alias("clip_uid"), F.when(i % 50 == 0, " ").otherwise("/v.mp4").alias("source_clip_path"), F.when(i % 41 != 0, v).alias("container_sec"),
        F.when(i % 7 == 0, F.lit(-1.0)).when(i % 7 == 1, F.lit(2.5)).alias("source_start_sec"), F.when(i % 9 == 0, v + 1.0).when(i % 9 == 1, F.lit(2.0)).alias("source_end_sec"),
    )
    return ann.manifest_errors(rows, 3.0, 300.0).select("row_index", "error", "duration_sec")


@_query("WITH a AS (SELECT event_id//3 AS ep, value::DOUBLE-greatest(0::DOUBLE, CASE WHEN event_id%4=0 THEN 0.3::DOUBLE WHEN event_id%4=1 THEN -2::DOUBLE ELSE 0::DOUBLE END) AS u FROM events), b AS (SELECT ep, min(u) AS lo, max(u)-min(u) AS sp, count(*) AS cameras FROM a GROUP BY 1), c AS (SELECT ep, " + r3("lo") + " AS usable_sec, " + r3("sp") + " AS spread_sec, cameras FROM b) SELECT ep AS episode_id, usable_sec, spread_sec, cameras, CASE WHEN usable_sec<3 THEN 'video_too_short' WHEN cameras>1 AND spread_sec>0.5 THEN 'multi_view_duration_mismatch' END AS error FROM c")
def multiview_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    rows = _table(spark, sf_dir, "events").select(F.floor(i / 3).cast("long").alias("episode_id"), F.col("value").cast("double").alias("duration_sec"), F.when(i % 4 == 0, F.lit(0.3)).when(i % 4 == 1, F.lit(-2.0)).otherwise(F.lit(0.0)).alias("time_offset_sec"))
    return ann.multiview(rows)


@_query("WITH a AS (SELECT event_id, CASE event_id%4 WHEN 0 THEN 1.7e9::DOUBLE WHEN 1 THEN 1.7e12::DOUBLE WHEN 2 THEN 1.7e15::DOUBLE ELSE 1.7e18::DOUBLE END AS t0, value::DOUBLE AS v, CASE event_id%4 WHEN 0 THEN 1::DOUBLE WHEN 1 THEN 1e3::DOUBLE WHEN 2 THEN 1e6::DOUBLE ELSE 1e9::DOUBLE END AS u, CAST(10+event_id%500 AS INT) AS n FROM events), b AS (SELECT *, t0+v*u AS t1 FROM a), c AS (SELECT *, (t1-t0)/CASE WHEN greatest(abs(t0),abs(t1))>1e17 THEN 1e9::DOUBLE WHEN greatest(abs(t0),abs(t1))>1e14 THEN 1e6::DOUBLE WHEN greatest(abs(t0),abs(t1))>1e11 THEN 1e3::DOUBLE ELSE 1::DOUBLE END AS el FROM b), d AS (SELECT *, CASE WHEN t1>t0 AND el>0 THEN (n-1)/el END AS f FROM c), e AS (SELECT *, CASE WHEN f BETWEEN 0.5 AND 240 THEN f ELSE 30::DOUBLE END AS fps FROM d) SELECT event_id, round_even(n/fps*1000::DOUBLE,0)/1000::DOUBLE AS duration_sec, round_even(fps*1000::DOUBLE,0)/1000::DOUBLE AS fps FROM e")
def fps_infer(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("event_id")
    pick = lambda *xs: F.when(i % 4 == 0, xs[0]).when(i % 4 == 1, xs[1]).when(i % 4 == 2, xs[2]).otherwise(xs[3])
    first = pick(*[F.lit(x) for x in (1.7e9, 1.7e12, 1.7e15, 1.7e18)])
    last = first + F.col("value").cast("double") * pick(*[F.lit(x) for x in (1.0, 1e3, 1e6, 1e9)])
    duration, fps = labels.inferred_timing(first, last, F.lit(2), (F.lit(10) + i % 500).cast("int"), 30.0)
    part = lambda x: F.rint(x * F.lit(1000.0)) / F.lit(1000.0)
    return _table(spark, sf_dir, "events").select("event_id", part(duration).alias("duration_sec"), part(fps).alias("fps"))


@_query("WITH a AS (SELECT p_partkey, CASE p_partkey%4 WHEN 0 THEN 'Open it.' WHEN 1 THEN '' WHEN 2 THEN ' Close the lid.. ' ELSE p_name END AS l, CASE p_partkey%5 WHEN 0 THEN 'open it' WHEN 1 THEN '' WHEN 2 THEN 'Close the lid.' WHEN 3 THEN p_name||'.' ELSE ' Turn it. ' END AS r FROM part), b AS (SELECT p_partkey, rtrim(trim(l),'.') AS l, trim(r) AS r FROM a) SELECT p_partkey, CASE WHEN l='' THEN r WHEN r='' OR lower(l)=lower(rtrim(r,'.')) THEN l||'.' ELSE l||'. Then '||lower(substr(r,1,1))||substr(r,2) END AS joined FROM b")
def instruction_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = F.expr("CASE p_partkey % 4 WHEN 0 THEN 'Open it.' WHEN 1 THEN '' WHEN 2 THEN ' Close the lid.. ' ELSE p_name END")
    right = F.expr("CASE p_partkey % 5 WHEN 0 THEN 'open it' WHEN 1 THEN '' WHEN 2 THEN 'Close the lid.' WHEN 3 THEN p_name || '.' ELSE ' Turn it. ' END")
    return _table(spark, sf_dir, "part").select("p_partkey", text.joined_sentences(left, right).alias("joined"))


@_query(f"WITH a AS (SELECT event_id, value::DOUBLE-20::DOUBLE AS v FROM events), b AS (SELECT event_id, least(100::DOUBLE, greatest(0::DOUBLE, v)) AS c, v FROM a), c AS (SELECT event_id, {r3('c')} AS sec, c<>v AS clamped FROM b) SELECT event_id, sec, clamped, greatest(0, CAST(round_even(sec*29.97::DOUBLE,0) AS INT)) AS frame FROM c")
def frame_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("value").cast("double") - F.lit(20.0)
    c = labels.clamp(v, F.lit(100.0))
    rows = _table(spark, sf_dir, "events").select("event_id", round3(c).alias("sec"), (c != v).alias("clamped"))
    return rows.withColumn("frame", labels.frame_index(F.col("sec"), F.lit(29.97)))
