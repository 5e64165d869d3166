"""Rule bitmask ledger over document text, in built-in expressions only.

Each rule is evaluated once per document; its verdict is one bit of `failure_bits`, beside the measurements. Policies
are versioned bit masks over that ledger, so a new policy or an ablation never reads a text again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE

WINDOW = 5


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value evaluated once a row, however often body names it inside lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def window_hashes(words: Column, n: int = WINDOW) -> Column:
    """64-bit hashes of all n-word windows in order; empty below n words."""
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    return _let(hashes, lambda a: F.when(F.size(a) >= n, F.transform(F.sequence(F.lit(0), F.size(a) - n), lambda i: F.xxhash64(*[F.get(a, i + k) for k in range(n)]))).otherwise(F.expr("cast(array() as array<bigint>)")))


def covered_words(windows: Column, n: int = WINDOW) -> Column:
    """Words inside windows whose hash occurs twice or more; most texts have none and skip the sort."""

    def marked(win: Column) -> Column:
        pairs = F.sort_array(F.transform(win, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            same = lambda x, k: (F.get(p, k - 1)["h"] == x["h"]) | (F.get(p, k + 1)["h"] == x["h"])
            return F.sort_array(F.transform(F.filter(p, lambda x, k: F.coalesce(same(x, k), (F.get(p, k - 1)["h"] == x["h"]), (F.get(p, k + 1)["h"] == x["h"]), F.lit(False))), lambda x: x["i"]))

        reach = lambda s: F.aggregate(F.transform(s, lambda x, k: F.least(F.lit(n), F.coalesce(F.get(s, k + 1) - x, F.lit(n)))), F.lit(0), lambda t, x: t + x)
        return _let(_let(pairs, starts), reach)

    return _let(windows, lambda w: F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(marked(w))).cast("long")


@dataclass(frozen=True)
class Rule:
    name: str
    fails: Callable[[], Column]


@dataclass(frozen=True)
class Policy:
    """A version and the names of the rules whose failure rejects a document."""

    version: str
    rules: tuple[str, ...]


#: A rule's place in this tuple is its bit for good; new rules are appended.
RULES: tuple[Rule, ...] = (
    Rule("few_words", lambda: F.col("n_words") < 10),
    Rule("repeated_windows", lambda: 100 * F.col("n_repeat_words") > 20 * F.col("n_words")),
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("duplicate_lines", lambda: 100 * F.col("n_dup_lines") > 50 * F.col("n_lines")),
    Rule("shouting", lambda: 2 * F.col("n_shouted") > F.col("n_words")),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 25 * F.col("n_words"))),
    Rule("stutter", lambda: 100 * F.col("n_stutter") > 30 * F.col("n_words")),
)
POLICIES: tuple[Policy, ...] = (
    Policy("v1", ("few_words", "repeated_windows")),
    Policy("v2", ("few_words", "repeated_windows", "symbols", "duplicate_lines", "shouting", "word_length", "stutter")),
)


def measure(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_stutter and n_shouted (all long).

    A null or empty text has no words and zero everywhere. Columns of docs with these names are replaced.
    """
    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{SPACE}]"))
    docs = docs.withColumns({"_words": words_of(t), "_lines": lines, "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long")})
    return docs.withColumns(
        {
            "n_words": F.size("_words").cast("long"),
            "word_chars": F.char_length(F.array_join("_words", "")).cast("long"),
            "n_lines": F.size("_lines").cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "n_repeat_words": covered_words(window_hashes(F.col("_words"))),
            "n_stutter": _let(F.col("_words"), lambda w: F.size(F.filter(w, lambda x, i: F.coalesce(x == F.get(w, i - 1), F.lit(False))))).cast("long"),
            "n_shouted": F.regexp_count(t, F.lit(r"(?<![^\x20\x09-\x0D])\p{Lu}{2,}[^\x20\x09-\x0D\p{Ll}]*!!")).cast("long"),
        }
    ).drop("_words", "_lines")


def ledger(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text") -> DataFrame:
    """The measurements and failure_bits (long): bit k is set where rules[k] fails."""
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(rule.fails(), F.lit(1 << k).cast("long")).otherwise(F.lit(0).cast("long")))
    return measure(docs, text).withColumn("failure_bits", bits)


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    names = [r.name for r in rules]
    return sum(1 << names.index(n) for n in policy.rules)


def kept(policy: Policy, rules: Sequence[Rule] = RULES) -> Column:
    return F.col("failure_bits").bitwiseAND(F.lit(mask(policy, rules)).cast("long")) == 0


def ablations(ledger_df: DataFrame, policies: Sequence[Policy] = POLICIES, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per policy and rule: documents rejected, those that only this rule rejects, and those kept without it.

    Documents are first counted per distinct bit pattern, so at most 2 ** len(rules) rows are shuffled per task.
    """
    patterns = ledger_df.groupBy("failure_bits").agg(F.count(F.lit(1)).alias("n"))
    names = [r.name for r in rules]
    asked = F.array(*[F.struct(F.lit(p.version).alias("policy"), F.lit(n).alias("rule"), F.lit(mask(p, rules)).cast("long").alias("mask"), F.lit(1 << names.index(n)).cast("long").alias("bit")) for p in policies for n in p.rules])
    x = patterns.withColumn("a", F.explode(asked)).select("failure_bits", "n", "a.*")
    hit = x["failure_bits"].bitwiseAND(x["mask"])
    count = lambda c: F.sum(F.when(c, F.col("n")).otherwise(0))
    return x.groupBy("policy", "rule").agg(count(hit != 0).alias("rejected"), count(hit == F.col("bit")).alias("only_this_rule"), count(hit.bitwiseAND(F.bitwise_not("bit")) == 0).alias("kept_without"), F.bit_or(hit).alias("seen_bits"))
