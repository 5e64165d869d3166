"""Mixing domains to target weights by soft membership, in built-in expressions only.

A multinomial classifier over hashed words, trained on a labelled table, gives each document domain posteriors.
Document rates r >= min_rate are then fitted so that the expected tokens of each domain, the sum over documents of
rate * tokens * posterior, match the targets: projected gradient descent on the squared error, in the metric of the
inverse Gram matrix, under which one full step is never too long. A round is one aggregation to as many numbers as
there are domains; rates are an expression over the rounds' residuals, so nothing per document is kept between rounds.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import staged
from .quality import words_of

BUCKETS = 512
#: The classifier is trained on at most so many labelled documents, those of the lowest id hash.
TRAIN_DOCS = 4096
#: Words of evidence beyond which a posterior gets no sharper.
EVIDENCE = 40.0
ROUNDS, TOLERANCE = 40, 1e-6


def _array(values) -> Column:
    """An array of constants, parsed once."""
    return F.expr("array(" + ",".join(f"{float(v)!r}D" for v in values) + ")")


def letter_words(text: Column) -> Column:
    """Runs of letters in lower case: marks and table rules say nothing of a domain."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}]+"), "")


def bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(BUCKETS)).cast("int") + 1


def labelled_documents(docs: DataFrame, labels: DataFrame, domain: str, bound: int = TRAIN_DOCS) -> DataFrame:
    """doc_id, text and domain of the documents that the label table names, at most `bound` of them by id hash."""
    ids = labels.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    ids = ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col(domain).alias("domain"))
    return rows.join(F.broadcast(ids), "doc_id", "left_semi")  # at most `bound` ids


def train(labelled: DataFrame, domains: list[str]) -> np.ndarray:
    """log P(bucket | domain) by add-one counts over labelled (text, domain); a row a domain, and the log prior last."""
    rows = staged(labelled.where(F.col("domain").isin(domains)).select("text", "domain"), "labelled")
    counts = np.ones((len(domains), BUCKETS))
    docs = np.ones(len(domains))
    words = rows.select("domain", F.explode(letter_words(F.col("text"))).alias("w")).groupBy("domain", bucket(F.col("w")).alias("b")).agg(F.count(F.lit(1)).alias("n"))
    for r in words.collect():  # at most domains * BUCKETS rows
        counts[domains.index(r.domain), r.b - 1] += r.n
    for r in rows.groupBy("domain").agg(F.count(F.lit(1)).alias("n")).collect():
        docs[domains.index(r.domain)] += r.n
    return np.column_stack([np.log(counts / counts.sum(axis=1, keepdims=True)), np.log(docs / docs.sum())])


def posteriors(docs: DataFrame, model: np.ndarray) -> DataFrame:
    """docs with tokens (words, double) and p (array of posteriors); a text without words gets the prior."""
    docs = docs.withColumn("_b", F.transform(letter_words(F.col("text")), bucket))
    n = F.size("_b")

    def likelihood(c: int) -> Column:
        held = _array(model[c, :-1])
        return F.aggregate("_b", F.lit(0.0), lambda t, b: t + F.get(held, b - 1))

    docs = docs.withColumns({"tokens": F.size(words_of(F.col("text"))).cast("double"), **{f"_l{c}": likelihood(c) for c in range(len(model))}})
    logs = F.array(*[F.lit(float(model[c, -1])) + F.col(f"_l{c}") * F.least(F.lit(1.0), F.lit(EVIDENCE) / F.greatest(n, F.lit(1))) for c in range(len(model))])
    docs = docs.withColumn("_logs", logs).withColumn("_e", F.transform("_logs", lambda x: F.exp(x - F.array_max("_logs"))))
    docs = docs.withColumn("_sum", F.aggregate("_e", F.lit(0.0), lambda t, x: t + x))
    return docs.withColumn("p", F.transform("_e", lambda x: x / F.col("_sum"))).drop("_b", "_logs", "_e", "_sum", *[f"_l{c}" for c in range(len(model))])


def rate(steps: list[np.ndarray], least: float, most: float) -> Column:
    """The rate after the given steps: r <- clip(r - tokens * (p . step)), from 1."""
    start = F.lit(float(min(max(1.0, least), most)))
    if not steps:
        return start
    held = F.array(*[_array(s) for s in steps])
    dot = lambda s: sum((F.get("p", c) * F.get(s, c) for c in range(1, len(steps[0]))), F.get("p", 0) * F.get(s, 0))
    return F.aggregate(held, start, lambda r, s: F.greatest(F.lit(float(least)), F.least(F.lit(float(most)), r - F.col("tokens") * dot(s))))


def fit(members: DataFrame, targets: np.ndarray, least: float = 0.0, most: float = 100.0, rounds: int = ROUNDS) -> list[np.ndarray]:
    """Steps whose rate() makes the expected domain tokens of members (tokens, p) meet the targets as nearly as they can.

    Documents in the millions have tiny Gram steps each, so the sums are taken in doubles by Spark and only
    domains ** 2 numbers reach the driver.
    """
    k = len(targets)
    pick = lambda c: F.get("p", c)
    sums = members.agg(*[F.sum(F.col("tokens") * F.col("tokens") * pick(a) * pick(b)) for a in range(k) for b in range(a + 1)]).first()
    gram = np.zeros((k, k))
    it = iter(sums)
    for a in range(k):
        for b in range(a + 1):
            gram[a, b] = gram[b, a] = next(it) or 0.0
    if not gram.any():  # no tokens at all: nothing can be fitted
        return []
    inverse = np.linalg.pinv(gram + np.eye(k) * gram.trace() * 1e-12)
    steps: list[np.ndarray] = []
    scale = max(float(np.abs(targets).max()), 1e-300)
    for _ in range(rounds):
        now = members.withColumn("r", rate(steps, least, most)).agg(*[F.sum(F.col("r") * F.col("tokens") * pick(c)) for c in range(k)])
        residual = np.array([v or 0.0 for v in now.first()]) - targets
        if np.abs(residual).max() <= TOLERANCE * scale:
            break
        steps.append(inverse @ residual)
    return steps


def mix(docs: DataFrame, labelled: DataFrame, weights: dict[str, float], total: float | None = None, least: float = 0.0, most: float = 100.0, keep_all: bool = False, carry: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, tokens, p (posteriors in the order of weights) and rate of every row of docs (doc_id, text), and its columns `carry`.

    labelled: doc_id, text, domain. Targets are weights / their sum, times total (the table's tokens by default). With
    keep_all no document is thinned: rates start at 1 and the total is the least that lets every domain keep its tokens.
    A null or empty text has no tokens, the prior as posteriors and the starting rate; null ids and repeated rows are
    kept; other columns are ignored. Where the targets are out of reach the nearest totals (in the Gram metric) are met;
    an empty table gives an empty result. Rows are never joined or shuffled.
    """
    domains = list(weights)
    model = train(labelled, domains)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), *carry)
    members = staged(posteriors(rows, model).select("doc_id", "tokens", "p", *carry), "members")
    share = np.array([weights[d] for d in domains], float)
    share /= share.sum()
    have = np.array([v or 0.0 for v in members.agg(*[F.sum(F.col("tokens") * F.get("p", c)) for c in range(len(domains))]).first()])
    if keep_all:
        least, total = max(least, 1.0), float((have / share).max())
    targets = share * (have.sum() if total is None else total)
    return members.withColumn("rate", rate(fit(members, targets, least, most), least, most))


def copies(rate_column: Column, *by: str) -> Column:
    """Whole copies that a rate stands for: its floor, and one more with the rest as chance, drawn by the hash of `by`."""
    draw = F.pmod(F.xxhash64(*by), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return (F.floor(rate_column) + (draw < rate_column - F.floor(rate_column)).cast("int")).cast("int")
