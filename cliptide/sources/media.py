"""Media effects at the edge: probing and cutting files, with the program that does it passed in."""

from __future__ import annotations

import json
import os
import subprocess
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EXPORT_TOLERANCE = {"window": 0.35, "segment": 0.4}


def probe_duration(path: str) -> float | None:
    """Seconds of a media file to three decimals; None where it can't be probed."""
    try:
        done = subprocess.run(["ffprobe", "-v", "error", "-show_entries", "format=duration", "-of", "json", path], capture_output=True, text=True, timeout=120)
        return round(float(json.loads(done.stdout)["format"]["duration"]), 3) if done.returncode == 0 else None
    except (OSError, ValueError, KeyError, subprocess.SubprocessError):
        return None


def with_durations(df: DataFrame, path: str = "source_clip_path", probe: Callable[[str], float | None] = probe_duration, exists: Callable[[str], bool] = os.path.isfile) -> DataFrame:
    """df with found (boolean) and container_sec; each distinct path is probed once."""

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            found = [bool(exists(p)) for p in pdf["p"]]
            seconds = [probe(p) if f else None for p, f in zip(pdf["p"], found)]
            yield pd.DataFrame({"p": pdf["p"], "found": found, "container_sec": pd.array(seconds, "Float64").astype(object)})

    once = df.where(F.col(path).isNotNull()).select(F.col(path).alias("p")).distinct().mapInPandas(run, "p string, found boolean, container_sec double")
    return df.join(once.withColumnRenamed("p", path), path, "left").withColumn("found", F.coalesce("found", F.lit(False)))


def parse_rate(text: Column) -> Column:
    """Frames a second of a rational like 30000/1001; null where it is none or its divisor is 0."""
    parts = F.split(text, "/")
    return F.try_divide(parts[0].try_cast("double"), F.coalesce(F.get(parts, 1).try_cast("double"), F.lit(1.0)))


def frame_count(reported: Column, duration: Column, fps: Column) -> Column:
    """The reported frames, else duration times rate, rounded."""
    return F.coalesce(reported, F.rint(duration * fps).cast("int"))


# How published clips are encoded.
QUIET = "-hide_banner -loglevel error -y"
ENCODING = "-map 0:v:0 -an -vf scale=960:-2 -c:v libx264 -preset veryfast -pix_fmt yuv420p -movflags +faststart"


def cut_command(source: str, seek: float, seconds: float, target: str, crf: int) -> list[str]:
    """The command that cuts `seconds` from `seek` on out of a file."""
    return ["ffmpeg", *QUIET.split(), "-ss", f"{seek:.3f}", "-i", source, "-t", f"{seconds:.3f}", *ENCODING.split(), "-crf", str(crf), target]


def frames(episodes: DataFrame, read: Callable[[str, float], bytes], folder: Callable[[str, int], str], write: Callable[[str, bytes], None]) -> DataFrame:
    """The sample manifest of episodes (episode_id, path, times, source_times): each frame read, written and listed.

    read(path, seconds) gives the encoded picture and raises where it can't; the row then says frame_sampling_failure.
    """

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for r in pdf.itertuples():
                target, error = folder(r.episode_id, r.sample_index), None
                try:
                    write(target, read(r.path, r.source_sec))
                except Exception:  # noqa: BLE001  any reader's failure is the episode's
                    target, error = None, "frame_sampling_failure"
                out.append((r.episode_id, r.sample_index, r.original_time_sec, target, error))
            yield pd.DataFrame(out, columns=["episode_id", "sample_index", "original_time_sec", "image_path", "error"])

    rows = episodes.select("episode_id", "path", F.posexplode(F.arrays_zip("times", "source_times")).alias("sample_index", "t")).select("episode_id", "path", "sample_index", F.col("t.times").alias("original_time_sec"), F.col("t.source_times").alias("source_sec"))
    return rows.mapInPandas(run, "episode_id string, sample_index int, original_time_sec double, image_path string, error string")


def export(df: DataFrame, kind: str, run_command: Callable[[list[str]], int], probe: Callable[[str], float | None] = probe_duration, crf: int = 24) -> DataFrame:
    """df (source_clip_path, source_seek_offset_sec, start_sec, duration_sec, target) with exported_duration_sec, export_ok, export_error.

    An export is good when the file's length is within the kind's tolerance of what was asked for.
    """
    tolerance = EXPORT_TOLERANCE[kind]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            out = []
            for r in pdf.itertuples():
                seek = (r.source_seek_offset_sec or 0.0) + r.start_sec
                if run_command(cut_command(r.source_clip_path, seek, r.duration_sec, r.target, crf)):
                    out.append((r.target, None, False, "ffmpeg_failed"))
                    continue
                seconds = probe(r.target)
                good = seconds is not None and abs(seconds - r.duration_sec) <= tolerance
                out.append((r.target, seconds, good, None if good else "duration_mismatch"))
            frame = pd.DataFrame(out, columns=["target", "exported_duration_sec", "export_ok", "export_error"])
            frame["exported_duration_sec"] = frame["exported_duration_sec"].astype(object).where(frame["exported_duration_sec"].notna(), None)
            yield frame

    done = df.select("source_clip_path", "source_seek_offset_sec", "start_sec", "duration_sec", "target").repartition("target").mapInPandas(run, "target string, exported_duration_sec double, export_ok boolean, export_error string")
    return df.join(done, "target", "left")
