"""Annotation in rounds: ask a backend for all pending episodes, read the replies, check them, and ask again for the rest."""

from __future__ import annotations

import base64
import json
import os
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cliptide.functions.labels import ACTIONS
from cliptide.functions.rounding import round3
from cliptide.functions.text import model_object, retry_prompt
from cliptide.operators import annotations as ann

REPLY = "episode_id string, text string, model string, error string"


#: What a backend is handed of an episode, as far as the episode has it.
REQUEST = ("episode_id", "system", "prompt", "task_hint", "times", "images", "camera_roles", "metadata")


class Backend(Protocol):
    """Answers one request (REQUEST) with {text, model}; must be picklable."""

    def annotate(self, request: dict) -> dict: ...


def reply_schema() -> dict:
    """The JSON schema that a reply must follow."""
    number, words = {"type": "number", "minimum": 0}, {"type": "string", "minLength": 1}
    subtask = {"start_time_sec": number, "end_time_sec": number, "action": {"type": "string", "enum": list(ACTIONS)}, "fine_action": words, "object": {"type": ["string", "null"]}, "instruction": words}
    item = {"type": "object", "required": [k for k in subtask if k != "object"], "properties": subtask}
    top = {"video_level_instruction": words, "subtasks": {"type": "array", "minItems": 1, "items": item}}
    return {"type": "object", "required": list(top), "properties": top}


def mock_reply(times: Column, task_hint: Column) -> Column:
    """A fixed reply: one move from 0 to half a step beyond the last sample."""
    last = F.coalesce(F.array_max(times), F.lit(1.0))
    end = round3(F.greatest(F.lit(0.5), F.when(F.size(times) > 1, last + (F.get(times, 1) - F.get(times, 0)) / F.lit(2.0)).otherwise(last)))
    task = F.coalesce(F.nullif(task_hint, F.lit("")), F.lit("Move the visible object."))
    subtask = F.struct(F.lit(0.0).alias("start_time_sec"), end.alias("end_time_sec"), F.lit("move").alias("action"), F.lit("visible object").alias("object"), task.alias("instruction"))
    return F.to_json(F.struct(task.alias("video_level_instruction"), F.array(subtask).alias("subtasks")))


class HttpBackend:
    """A chat-completions service; the key is read from the named variable on the worker, never put into the plan."""

    def __init__(self, url: str, model: str, key_variable: str, timeout: float = 300.0, temperature: float = 0.1, tokens: int = 1024):
        if key_variable not in os.environ:
            raise ValueError(f"{key_variable} is not set")
        self.url, self.model, self.key_variable, self.timeout, self.temperature, self.tokens = url, model, key_variable, timeout, temperature, tokens

    def annotate(self, request: dict) -> dict:
        content = [{"type": "text", "text": request["prompt"]}]
        for path in request.get("images") or []:
            with open(path, "rb") as f:
                content.append({"type": "image_url", "image_url": {"url": "data:image/jpeg;base64," + base64.b64encode(f.read()).decode()}})
        body = {
            "model": self.model, "temperature": self.temperature, "max_tokens": self.tokens, "messages": [{"role": "system", "content": request.get("system", "")}, {"role": "user", "content": content}],
            "response_format": {"type": "json_schema", "json_schema": {"name": "timed_subtasks", "strict": True, "schema": reply_schema()}},
        }
        call = urllib.request.Request(self.url.rstrip("/") + "/chat/completions", json.dumps(body).encode(), {"Content-Type": "application/json", "Authorization": f"Bearer {os.environ.get(self.key_variable, '')}"})
        try:
            with urllib.request.urlopen(call, timeout=self.timeout) as answer:
                got = json.loads(answer.read())
            return {"text": got["choices"][0]["message"]["content"], "model": str(got.get("model") or self.model)}
        except (urllib.error.URLError, TimeoutError, ValueError, KeyError) as error:
            raise RuntimeError(f"request failed: {error}") from error


def local_model(load: Callable[[], Callable[[dict], str]], name: str) -> Callable[[], Backend]:
    """A backend around a vision model that `load` makes; it is loaded once per worker process."""
    held: dict[str, Callable[[dict], str]] = {}

    class Local:
        def annotate(self, request: dict) -> dict:
            if name not in held:
                held[name] = load()
            return {"text": held[name](request), "model": name}

    return Local


def ask(pending: DataFrame, backend: Backend | str) -> DataFrame:
    """Replies to pending (REQUEST: episode_id, prompt and what else there is); a failure is a row with its error."""
    if backend == "mock":
        return pending.select("episode_id", mock_reply(F.col("times"), F.col("task_hint")).alias("text"), F.lit("mock-v0.1").alias("model"), F.lit(None).cast("string").alias("error"))

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for r in pdf.to_dict("records"):
                try:
                    got = backend.annotate(r)
                    out.append((r["episode_id"], got["text"], got["model"], None))
                except Exception as error:  # noqa: BLE001  a backend may fail in any way; the row says how
                    out.append((r["episode_id"], None, None, repr(error)))
            yield pd.DataFrame(out, columns=["episode_id", "text", "model", "error"])

    known = [c for c in REQUEST if c in pending.columns]
    return pending.select(*known).mapInPandas(run, REPLY)


def subtasks_of(replies: DataFrame) -> DataFrame:
    """Raw subtasks of parsed replies (episode_id, duration_sec, object); `broken` marks entries that are no objects."""
    top = F.from_json("object", "struct<video_level_instruction string, subtasks array<string>>")
    rows = replies.select("episode_id", "duration_sec", F.posexplode(F.coalesce(top["subtasks"], F.expr("cast(array() as array<string>)"))).alias("pos", "one"))
    one = F.from_json("one", "struct<start_time_sec string, end_time_sec string, action string, fine_action string, object string, instruction string>")
    rows = rows.withColumns({"o": one, "broken": ~F.coalesce(F.startswith(F.ltrim("one"), F.lit("{")), F.lit(False))})
    return rows.select("episode_id", "duration_sec", "pos", F.col("o.start_time_sec").alias("start"), F.col("o.end_time_sec").alias("end"), "o.action", "o.fine_action", "o.object", "o.instruction", "broken")


def judged(replies: DataFrame, tolerance: float = 0.2, pause: float = 1.5) -> tuple[DataFrame, DataFrame]:
    """(subtasks, report) of replies (episode_id, duration_sec, text): repaired rows, and flags, reasons and validity."""
    parsed = replies.withColumn("object", model_object(F.col("text")))
    raw = subtasks_of(parsed.where("object is not null"))
    rows = ann.repair(raw.where("not broken"), tolerance=tolerance, pause=pause)
    rows = rows.join(replies.select("episode_id", "duration_sec"), "episode_id").withColumn("pos", F.col("subtask_id"))
    said = F.try_variant_get(F.try_parse_json("object"), "$.video_level_instruction", "string")
    episodes = parsed.select("episode_id", "duration_sec", said.alias("video_level_instruction"), F.col("object").isNull().alias("unread"))
    report = ann.validate(episodes, rows).join(episodes.select("episode_id", "unread", "video_level_instruction"), "episode_id")
    report = report.join(ann.repair_flags(raw, tolerance, pause), "episode_id", "left")
    lost = F.array(F.lit("vlm_parse_failure"))
    flags = F.when(F.col("unread"), lost).otherwise(F.array_union("quality_flags", F.coalesce("repair_flags", F.expr("cast(array() as array<string>)"))))
    return rows, report.select("episode_id", "video_level_instruction", "coverage_ratio", flags.alias("quality_flags"), F.when(F.col("unread"), lost).otherwise(F.col("retry_reasons")).alias("retry_reasons"), (F.col("valid") & ~F.col("unread")).alias("valid"))


def annotate(episodes: DataFrame, backend: Backend | str, keep: Callable[[DataFrame, str], DataFrame], retries: int = 2) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(subtasks, reports, errors) of episodes (episode_id, duration_sec, prompt, task_hint, times).

    keep(df, name) writes a table and reads it back, so each round's replies are asked for once and survive lost
    executors. An episode whose reply gives reasons is asked again; the last reply is kept even if invalid, unless it
    can't be read or has no subtasks: that is an error row.
    """
    pending, done, failed = episodes.withColumns({"_base": F.col("prompt"), "_last": F.lit(None).cast("string")}), [], []
    for turn in range(retries + 1):
        replies = keep(ask(pending, backend).join(pending.select("episode_id", "duration_sec"), "episode_id"), f"replies_{turn}")
        rows, report = judged(replies.where("error is null"))
        rows, report = keep(rows, f"subtasks_{turn}"), keep(report, f"report_{turn}")
        broken = replies.where("error is not null").select("episode_id", F.array(F.lit("backend_failure")).alias("retry_reasons"), "error")
        again = report.where("size(retry_reasons) > 0").select("episode_id", "retry_reasons", F.lit(None).cast("string").alias("error")).unionByName(broken)
        if turn == retries:
            unread = F.array_contains("retry_reasons", "vlm_parse_failure") | F.array_contains("retry_reasons", "empty_subtasks") | F.array_contains("retry_reasons", "missing_video_level_instruction") | F.array_contains("retry_reasons", "backend_failure")
            names = F.when(F.exists("retry_reasons", lambda r: r.isin("vlm_parse_failure", "backend_failure")), F.col("retry_reasons")).otherwise(F.array(F.lit("schema_failure")))
            failed.append(again.where(unread).select("episode_id", F.coalesce("error", F.lit("the reply is not usable")).alias("error"), names.alias("quality_flags")))
            again = again.where(unread)
        good = report.join(again.select("episode_id"), "episode_id", "left_anti").withColumn("retry_count", F.lit(turn))
        done.append((rows.join(good.select("episode_id"), "episode_id", "left_semi"), good))
        if turn == retries or not again.limit(1).count():
            break
        texts = replies.select("episode_id", F.col("text").alias("_new"))
        pending = pending.join(again.select("episode_id", "retry_reasons"), "episode_id").join(texts, "episode_id", "left").withColumn("_last", F.col("_new"))
        pending = keep(pending.withColumn("prompt", retry_prompt(F.col("_base"), F.col("retry_reasons"), F.col("_last"), F.lit(turn + 1 >= 2))).drop("retry_reasons", "_new"), f"pending_{turn}")
    subtasks, reports = done[0]
    for r, p in done[1:]:
        subtasks, reports = subtasks.unionByName(r), reports.unionByName(p)
    errors = failed[0] if failed else episodes.sparkSession.createDataFrame([], "episode_id string, error string, quality_flags array<string>")
    return subtasks, reports, errors


def batch(episodes: DataFrame, state: DataFrame, errors: DataFrame, resume: bool = False, retry_failed: bool = False) -> DataFrame:
    """The episodes of a restarted batch: without resume all of them, else those not annotated yet, or those that failed."""
    rows = episodes
    if retry_failed:
        rows = rows.join(errors.select("episode_id").distinct(), "episode_id", "left_semi")
    if resume:
        rows = rows.join(state.select("episode_id").distinct(), "episode_id", "left_anti")
    return rows


def replaced(old: DataFrame, new: DataFrame) -> DataFrame:
    """The state after a batch: new rows, and old ones of other episodes."""
    return old.join(new.select("episode_id").distinct(), "episode_id", "left_anti").unionByName(new, allowMissingColumns=True)
