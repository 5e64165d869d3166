"""Normalisation of action labels, objects, identifiers and times."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .rounding import round3

# The closed vocabulary of coarse actions, its aliases, and the labels that need no object.
ACTIONS = ("move", "fold", "pour", "unfold", "push", "wipe", "pull", "stir", "rotate", "cut", "open", "press", "close", "attach", "detach", "transit", "idle", "other")
ALIASES = {
    "pick": "move", "pick up": "move", "pick_up": "move", "pickup": "move", "place": "move", "carry": "move", "relocate": "move", "grab": "move", "grasp": "move", "release": "move",
    "insert": "attach", "install": "attach", "connect": "attach",
    "remove": "detach", "disconnect": "detach", "take off": "detach", "take_off": "detach",
    "turn": "rotate", "twist": "rotate",
    "walk": "transit", "reach": "transit", "reposition gripper": "transit", "reposition_gripper": "transit",
}
NO_OBJECT_NEEDED = ("transit", "idle", "other")
EMPTY_OBJECTS = ("", "null", "none", "n/a", "unknown")
VAGUE_ACTIONS = ("", "other", "unknown", "n/a")


def token(x: Column) -> Column:
    """Lower case, hyphens as blanks, white space squeezed; null is empty."""
    return F.trim(F.regexp_replace(F.lower(F.replace(F.coalesce(x.cast("string"), F.lit("")), F.lit("-"), F.lit(" "))), r"\s+", " "))


def _alias(x: Column) -> Column:
    table = F.create_map(*[F.lit(v) for pair in ALIASES.items() for v in pair])
    return F.coalesce(F.try_element_at(table, x), F.try_element_at(table, F.replace(x, F.lit(" "), F.lit("_"))))


def action(x: Column) -> Column:
    """The vocabulary's action for a raw label; other where there is none."""
    t = token(x)
    return F.when(t.isin(*ACTIONS), t).otherwise(F.coalesce(_alias(t), F.lit("other")))


def action_flag(x: Column) -> Column:
    """Null for a vocabulary label, else which lossy mapping action() made."""
    t = token(x)
    return F.when(t.isin(*ACTIONS), F.lit(None).cast("string")).when(_alias(t).isNotNull(), F.lit("action_synonym_mapped")).otherwise(F.lit("out_of_vocabulary_action"))


def fine_action(raw: Column, fine: Column) -> Column:
    """The fine label; a blank or unknown one falls back to the raw label and then to the coarse action."""
    f = token(fine)
    return F.when(f.isin("", "unknown", "n/a"), F.coalesce(F.nullif(token(raw), F.lit("")), action(raw))).otherwise(f)


def inferred(raw: Column, fine: Column) -> Column:
    """True where an unknown coarse label is excused by a specific fine one."""
    return F.coalesce(action_flag(raw) == "out_of_vocabulary_action", F.lit(False)) & ~fine_action(raw, fine).isin(*VAGUE_ACTIONS)


def object_name(x: Column) -> Column:
    t = F.trim(x)
    return F.when(t.isNull() | F.lower(t).isin(*EMPTY_OBJECTS), F.lit(None).cast("string")).otherwise(t)


def object_required(coarse: Column) -> Column:
    return ~coarse.isin(*NO_OBJECT_NEEDED)


def lenient_double(x: Column) -> Column:
    """A number where x reads as one, else 0; NaN counts as 0."""
    return F.nanvl(F.coalesce(x.try_cast("double"), F.lit(0.0)), F.lit(0.0))


def clamp(x: Column, top: Column) -> Column:
    return F.least(top, F.greatest(F.lit(0.0), F.nanvl(x, F.lit(0.0))))


def frame_index(seconds: Column, fps: Column) -> Column:
    return F.greatest(F.lit(0), F.rint(seconds * fps).cast("int"))


def safe_identifier(x: Column) -> Column:
    """Runs of other characters than letters, digits, _ . - become -, the ends are stripped; else a hash of x."""
    kept = F.regexp_replace(x, r"[^A-Za-z0-9_.-]+", "-")
    kept = F.regexp_replace(F.regexp_replace(kept, r"^[-.]+", ""), r"[-.]+$", "")
    return F.coalesce(F.nullif(kept, F.lit("")), F.substring(F.sha1(x), 1, 16))


def adapter_identifier(x: Column) -> Column:
    """Each character but letters, digits, _ and - becomes -; hyphens at the ends are stripped."""
    return F.regexp_replace(F.regexp_replace(x, r"[^\p{L}\p{N}_-]", "-"), r"^-+|-+$", "")


def default_clip_uid(dataset: Column, path: Column) -> Column:
    stem = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"(?<=.)\.[^.]*$", "")
    return F.concat(dataset, F.lit("-"), stem, F.lit("-"), F.substring(F.sha1(path), 1, 8))


def selection_score(seed: int, clip_uid: Column) -> Column:
    return F.sha1(F.concat(F.lit(f"{seed}:"), clip_uid))


def semantic_action(fine: Column, coarse: Column) -> Column:
    return F.lower(F.trim(F.coalesce(F.nullif(fine, F.lit("")), F.nullif(coarse, F.lit("")), F.lit("other"))))


def semantic_object(x: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(F.coalesce(x, F.lit(""))), r"\s+", " "))


def duration_bin(x: Column) -> Column:
    return F.when(x < 0.5, "<0.5").when(x < 1, "0.5-1").when(x < 2, "1-2").when(x < 5, "2-5").when(x < 10, "5-10").otherwise(">=10")


def sample_times(duration: Column, fps: float = 2.0, most: int = 128) -> Column:
    """Centres of equal slices of a recording, at most `most`, none beyond its end less a millisecond."""
    n = F.greatest(F.lit(1), F.least(F.ceil(duration * F.lit(float(fps))).cast("int"), F.lit(most)))
    many = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.least((i + F.lit(0.5)) * duration / n, F.greatest(F.lit(0.0), duration - F.lit(0.001))))
    return F.when(n == 1, F.array(duration / F.lit(2.0))).otherwise(many)


def camera_times(times: Column, offset: Column) -> Column:
    return F.transform(times, lambda t: F.greatest(F.lit(0.0), t + offset))


def camera_path(path: Column, folder: Column) -> Column:
    return F.when(F.startswith(path, F.lit("/")), path).otherwise(F.concat_ws("/", folder, path))


def inferred_timing(first: Column, last: Column, n_stamps: Column, frames: Column, fallback: float) -> tuple[Column, Column]:
    """(duration, fps) from first and last time stamps of unknown unit; beyond 0.5 to 240 frames a second the fallback."""
    size = F.greatest(F.abs(first), F.abs(last))
    unit = F.when(size > 1e17, 1e9).when(size > 1e14, 1e6).when(size > 1e11, 1e3).otherwise(1.0)
    elapsed = (last - first) / unit
    fps = F.when((n_stamps >= 2) & (last > first) & (elapsed > 0), (frames - 1) / F.nullif(elapsed, F.lit(0.0)))
    good = F.coalesce(fps.between(0.5, 240.0), F.lit(False))
    used = F.when(good, fps).otherwise(F.lit(float(fallback)))
    return frames / used, used


def tile_grid(cameras: Column, long_side: int = 448) -> tuple[Column, Column, Column]:
    """(columns, rows, tile size) of the picture that shows all cameras at once."""
    columns = F.when(cameras == 1, 1).otherwise(2)
    rows = F.ceil(cameras / columns).cast("int")
    return columns, rows, F.greatest(F.lit(128), F.floor(F.lit(long_side) / F.greatest(columns, rows)).cast("int"))


def segment_duration(start: Column, end: Column) -> Column:
    return round3(end - start)
