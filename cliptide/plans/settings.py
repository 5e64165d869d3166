"""Typed settings of a run, read from JSON or YAML, checked at once and written beside the run's results."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field, fields, is_dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Backend:
    type: str = "mock"
    model: str | None = None
    base_url: str | None = None
    api_key_env: str | None = None
    max_retries: int = 2
    temperature: float = 0.1
    max_new_tokens: int = 1024
    timeout_sec: float = 300.0

    def __post_init__(self):
        if self.type not in ("mock", "http", "local") or self.max_retries < 0 or self.timeout_sec <= 0:
            raise ValueError("bad backend settings")


@dataclass(frozen=True)
class Sampling:
    fps: float = 2.0
    max_frames: int = 128
    resize_long_side: int = 448

    def __post_init__(self):
        if self.fps <= 0 or self.max_frames < 1 or self.resize_long_side < 1:
            raise ValueError("bad sampling settings")


@dataclass(frozen=True)
class Segmentation:
    min_subtask_duration_sec: float = 3.0
    max_subtasks_per_minute: float = 30.0
    sustained_pause_sec: float = 1.5


@dataclass(frozen=True)
class Validation:
    continuity_tolerance_sec: float = 0.2
    max_uncovered_gap_sec: float = 1.0
    max_multiview_duration_diff_sec: float = 0.5
    minimum_video_duration_sec: float = 3.0
    reject_idle_only: bool = True
    warn_other_ratio: float = 0.3
    minimum_coverage_ratio: float = 0.7


@dataclass(frozen=True)
class Settings:
    backend: Backend = field(default_factory=Backend)
    sampling: Sampling = field(default_factory=Sampling)
    segmentation: Segmentation = field(default_factory=Segmentation)
    validation: Validation = field(default_factory=Validation)
    prompt_version: str = "v1"


def _make(kind, value):
    if not isinstance(value, dict):
        raise ValueError(f"{kind.__name__} needs a mapping")
    known = {f.name: f for f in fields(kind)}
    if extra := set(value) - set(known):
        raise ValueError(f"unknown settings: {sorted(extra)}")
    default = kind()
    parts = {k: _make(type(getattr(default, k)), v) if is_dataclass(getattr(default, k)) else v for k, v in value.items()}
    return kind(**parts)


def load_text(text: str) -> Settings:
    try:
        value = json.loads(text)
    except ValueError:
        import yaml  # optional: settings may be JSON alone

        value = yaml.safe_load(text)
    return _make(Settings, value or {})


def load(path: str) -> Settings:
    with open(path) as f:
        return load_text(f.read())


def snapshot(settings: Settings) -> str:
    return json.dumps(asdict(settings), indent=2)


def latest(runs: DataFrame, key: str = "episode_id", stamp: str = "run_ts") -> DataFrame:
    """The last run of each key; earlier runs stay in the table as its history."""
    last = runs.groupBy(key).agg(F.max(stamp).alias("_last"))
    return runs.join(last, key).where(F.col(stamp) == F.col("_last")).drop("_last")
