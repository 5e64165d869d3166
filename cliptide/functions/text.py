"""Instruction joins, captions, word overlap and model replies."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that say nothing about an action, and the verb forms that name one.
STOP_WORDS = ("a", "an", "and", "the", "to", "from", "in", "on", "at", "with", "of", "it", "his", "her", "their", "both", "camera", "wearer", "person", "then", "into")
VERBS = {
    "move": "pick picks picked take takes took put puts place places move moves carry carries grab grabs hold holds",
    "fold": "fold folds folded",
    "pour": "pour pours poured",
    "unfold": "unfold unfolds unfolded",
    "push": "push pushes pushed",
    "wipe": "wipe wipes wiped clean cleans cleaned",
    "pull": "pull pulls pulled",
    "stir": "stir stirs stirred mix mixes mixed",
    "rotate": "rotate rotates rotated turn turns turned twist twists twisted",
    "cut": "cut cuts cutting",
    "open": "open opens opened",
    "press": "press presses pressed tap taps tapped",
    "close": "close closes closed",
    "attach": "attach attaches attached insert inserts inserted connect connects connected",
    "detach": "detach detaches detached remove removes removed disconnect disconnects disconnected",
    "transit": "walk walks walked reach reaches reached",
}
# Fixed values of the output: the caption where there is none, and how many captions a summary tells.
NO_CAPTION = "No reliable visible-action summary is available; review the uncovered timeline."
MOST_CAPTIONS = 8
PREVIOUS_REPLY = 12000


def _lower_first(x: Column) -> Column:
    return F.concat(F.lower(F.substring(x, 1, 1)), F.substring(x, 2, 2147483647))


def _stripped(x: Column, end: str = "") -> Column:
    return F.trim(x) if not end else F.regexp_replace(F.trim(x), rf"[{end}]+$", "")


def joined_sentences(left: Column, right: Column) -> Column:
    """Timeline join: "L. Then r…"; an equal right side adds nothing."""
    l, r = _stripped(left, "."), F.trim(right)
    same = (r == "") | (F.lower(l) == F.lower(F.regexp_replace(r, r"\.+$", "")))
    return F.when(l == "", r).when(same, F.concat(l, F.lit("."))).otherwise(F.concat(l, F.lit(". Then "), _lower_first(r)))


def joined_clauses(parts: Column) -> Column:
    """Repair join of an array of instructions: "L, then r…", each compared with all that came before."""

    def step(left: Column, right: Column) -> Column:
        l, r = F.trim(left), F.trim(right)
        return F.when((r == "") | (F.lower(r) == F.lower(l)), left).when(l == "", r).otherwise(F.concat(F.regexp_replace(l, r"\.+$", ""), F.lit(", then "), _lower_first(r)))

    return F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.coalesce(F.get(parts, 0), F.lit("")), step)


def clean_caption(x: Column) -> Column:
    """White space squeezed, the filler sentence dropped, one full stop at the end; empty where nothing is left."""
    t = F.regexp_replace(F.trim(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " ")), r"(?i)(?:then\s+)?review uncovered activity\.?", "")
    t = F.regexp_replace(F.regexp_replace(t, r"\s+", " "), r"^[ ;.]+|[ ;.]+$", "")
    return F.when(t == "", t).otherwise(F.concat(t, F.lit(".")))


def distinct_neighbours(captions: Column) -> Column:
    """Cleaned captions without empty ones and without one that equals the caption kept before it."""
    clean = F.filter(F.transform(captions, clean_caption), lambda c: c != "")
    same = lambda a, b: F.lower(a) == F.lower(b)
    return F.aggregate(clean, F.expr("cast(array() as array<string>)"), lambda kept, c: F.when((F.size(kept) > 0) & F.coalesce(same(F.try_element_at(kept, F.lit(-1)), c), F.lit(False)), kept).otherwise(F.concat(kept, F.array(c))))


def representatives(captions: Column, most: int = MOST_CAPTIONS) -> Column:
    """At most `most` captions at even steps, the first and last among them."""
    picks = F.array_distinct(F.transform(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: F.rint(i * (F.size(captions) - 1) / F.lit(float(most - 1))).cast("int")))
    return F.when(F.size(captions) <= most, captions).otherwise(F.transform(picks, lambda i: F.get(captions, i)))


def long_caption(captions: Column) -> Column:
    """One sentence that tells the representative captions in order."""
    bare = F.transform(captions, lambda c: F.regexp_replace(c, r"\.+$", ""))
    n = F.size(bare)
    middle = F.array_join(F.slice(bare, 2, F.greatest(n - 2, F.lit(0))), "; then, ")
    last = F.try_element_at(bare, F.lit(-1))
    first = F.get(bare, 0)
    return F.when(n == 0, F.lit(NO_CAPTION)).when(n == 1, F.concat(first, F.lit("."))).when(n == 2, F.concat(F.lit("First, "), first, F.lit("; then, "), last, F.lit("."))).otherwise(F.concat(F.lit("First, "), first, F.lit("; then, "), middle, F.lit("; finally, "), last, F.lit(".")))


def content_words(x: Column) -> Column:
    """Distinct lower-case words of two letters or more without stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit("([a-z0-9]+)"))
    return F.array_distinct(F.filter(found, lambda w: (F.char_length(w) > 1) & ~w.isin(*STOP_WORDS)))


def word_overlap(a: Column, b: Column) -> Column:
    """Jaccard similarity of two word sets; 0 where both are empty."""
    return F.coalesce(F.try_divide(F.size(F.array_intersect(a, b)).cast("double"), F.size(F.array_union(a, b))), F.lit(0.0))


def named_actions(x: Column) -> Column:
    """Actions whose verb forms occur as words of x, in vocabulary order."""
    low = F.lower(F.coalesce(x, F.lit("")))
    tests = [F.when(low.rlike(rf"(?U)\b({'|'.join(forms.split())})\b"), F.lit(a)) for a, forms in VERBS.items()]
    return F.array_compact(F.array(*tests))


def model_object(reply: Column) -> Column:
    """The JSON object in a model's reply as text: fences are cut, else the span of its outer braces; null if none."""
    t = F.trim(reply)
    fenced = F.regexp_replace(F.regexp_replace(t, r"(?i)^```(?:json)?\s*", ""), r"\s*```$", "")
    t = F.when(F.startswith(t, F.lit("```")), fenced).otherwise(t)
    first = F.instr(t, "{")
    last = F.char_length(t) - F.instr(F.reverse(t), "}") + 1
    span = F.when((first > 0) & (F.instr(t, "}") > 0) & (last > first), F.substring(t, first, last - first + 1))
    whole = F.try_parse_json(t)
    parsed = F.when(whole.isNotNull(), whole).otherwise(F.try_parse_json(span))
    return F.when(F.schema_of_variant(parsed).startswith("OBJECT"), F.to_json(parsed))


def user_prompt(episode_id: Column, duration: Column, task_hint: Column, times: Column) -> Column:
    """What a backend is asked for one episode: its length, hint and sample times, and the shape of the reply."""
    shape = '{"video_level_instruction": "...", "subtasks": [{"start_time_sec": 0.0, "end_time_sec": 1.0, "action": "...", "fine_action": "...", "object": "... or null", "instruction": "..."}]}'
    samples = F.to_json(F.transform(times, lambda t, i: F.struct(i.alias("sample_index"), t.alias("time_sec"))))
    return F.concat(
        F.lit("Episode "), episode_id, F.lit(", "), F.format_string("%.3f", duration), F.lit(" seconds. Task hint: "), F.coalesce(F.nullif(task_hint, F.lit("")), F.lit("none")), F.lit(".\nSamples: "), samples,
        F.lit(f"\nAnswer with one JSON object of this shape and nothing else:\n{shape}\nActions: {', '.join((*VERBS, 'idle', 'other'))}. Where none fits, use other and name the visible act in fine_action.\n"),
    )


def retry_prompt(base: Column, errors: Column, previous: Column, simplify: Column) -> Column:
    """The prompt of another attempt: the base, what to correct, the last reply cut short, and a plea for brevity."""
    fix = F.when(F.size(errors) > 0, F.concat(F.lit("\nYour last answer was refused for: "), F.array_join(errors, ", "), F.lit(". Answer again with the whole JSON object.\n"))).otherwise("")
    last = F.when(F.coalesce(previous, F.lit("")) != "", F.concat(F.lit("Last answer:\n"), F.left(previous, F.lit(PREVIOUS_REPLY)))).otherwise("")
    brief = F.when(simplify, F.lit("\nThis is the last attempt: only the required keys, as few subtasks as the pictures justify.\n")).otherwise("")
    return F.concat(base, fix, last, brief)
