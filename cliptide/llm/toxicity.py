"""Toxicity by a support vector machine over a gap-weighted subsequence kernel with Nyström landmarks.

The kernel of two tokens sums their common subsequences of three letters, each letter at most GAP places after the one
before, weighted by DECAY to the power of the span. Its features are explicit (43 ** 3), so the trained machine, which
is a weighted sum of kernels with landmarks, folds into one weight per subsequence, and a whole text is scored by a
few array look-ups per letter. Marks inside a token are dropped and spelled-out letters are joined before scoring.

The machine is trained on labelled sentences: a sentence's Nyström features are those of its strongest token under the
machine (maximum pooling). A toxic document has at least one toxic sentence, its strongest; all sentences of a clean one
are clean. Which token carries a sentence is latent, so witnesses and machine are found in turn, from a first guess: the
tokens that occur in many contexts of toxic documents and hardly in others. Every toxic sentence is learned together
with copies in which its witness has an inserted or doubled letter, and these copies take part in the calibration too.
"""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import only

GAP, DECAY = 3, 0.6
#: a to z, sixteen classes of other letters (so accents of either case fall together), and a token's two ends.
LETTERS = 43
OTHER, END, DROP, SPACE = 26, 42, 43, 44
_SPELLED = "abcdefghijklmnopqrstuvwxyz0123456789ABCDEF|"
#: Bounds of what is trained on: labelled documents of each class (lowest id hash first), words, landmarks.
TOXIC_DOCS, CLEAN_DOCS, CLEAN_TOKENS = 1500, 3000, 100_000
MAX_POSITIVE, MAX_LANDMARKS = 128, 512
#: Rounds of witnesses and machine, copies with an inserted letter a witness, what share of its weight they have, and that of rare witnesses.
TURNS, VARIANTS, VARIANT_TRUST, RARE_TRUST = 3, 24, 1.0, 0.1
MIN_LOG_ODDS = 2.5
CHUNK = 1 << 20
#: Ordinary words, clean whatever the labelled sentences are: the tables' prose is invented and holds few real words.
_ORDINARY = "about above after again along around because before below between brown calm cloud clone close closer closest clothes crash cream crown crush dawn discuss discussing distance down drown drum early earth empathetic evening forest garden green ground gust heart house ideal idea idiom idol journey lake later letter little looser lose losing lost meadow mention moment month moral more morning mountain mourn motion movie music night noon number often other path pathology patient patriotic pattern people person place poetic quiet reason river rural school scan scuba sculpture season second small something south stone story street student studio studying stupendous summer sympathetic thrash together track train trace travel under walking warning water weather where winter wonder word worth worthwhile worthy yesterday".split()


def _classes() -> np.ndarray:
    to = np.full(256, DROP, np.int8)
    to[[9, 10, 11, 12, 13, 32]] = SPACE
    for k in range(26):
        to[97 + k] = to[65 + k] = k
    to[128:192] = OTHER + np.arange(64) % 16  # last bytes of a character; its first byte is dropped
    return to


_CLASS = _classes()


def norms(lengths: np.ndarray) -> np.ndarray:
    """Root of the kernel of a token with itself if none of its subsequences repeats: never above the true root."""
    total = np.zeros(len(lengths))
    for a in range(1, GAP + 1):
        for b in range(1, GAP + 1):
            total += np.maximum(0, lengths - a - b) * DECAY ** (2 * (a + b + 1))
    return np.sqrt(np.maximum(total, DECAY**6))


def tokens_of(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(letters, starts, lengths) of the tokens of a text: letters in a row, each token between two END marks."""
    c = _CLASS[np.frombuffer(data, np.uint8)]
    c = c[c != DROP]
    gaps = np.flatnonzero(c == SPACE)
    starts, ends = np.concatenate([[0], gaps + 1]), np.concatenate([gaps, [len(c)]])
    lengths = ends - starts
    lengths = lengths[lengths > 0]
    letters = c[c != SPACE]
    if len(lengths):  # a run of three or more single letters is one spelled-out token
        single = lengths == 1
        head = ~(single & np.concatenate([[False], single[:-1]]))
        group = np.cumsum(head) - 1
        head |= (np.bincount(group) < 3)[group]
        starts = (np.cumsum(lengths) - lengths)[head]
        lengths = np.diff(np.append(starts, len(letters)))
    out = np.full(len(letters) + 2 * len(lengths), END, np.int32)
    out[np.arange(len(letters)) + 2 * np.repeat(np.arange(len(lengths)), lengths) + 1] = letters
    lengths = lengths + 2
    return out, np.cumsum(lengths) - lengths, lengths


def token_sums(letters: np.ndarray, starts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Per token the sum of weights over its weighted subsequences; weights has one number a subsequence."""
    n = len(letters)
    owner = np.repeat(np.arange(len(starts), dtype=np.int32), np.diff(np.append(starts, n)))
    found = np.zeros(n, np.float32)
    code = letters.astype(np.int32)
    first = code * (LETTERS * LETTERS)
    pair = [first[: n - a] + code[a:] * LETTERS for a in range(1, GAP + 1)]
    inside = {g: owner[: n - g] == owner[g:] for g in range(2, 2 * GAP + 1) if g < n}
    for a in range(1, GAP + 1):
        for b in range(1, GAP + 1):
            g = a + b
            if g < n:
                got = weights[pair[a - 1][: n - g] + code[g:]] * np.float32(DECAY ** (g + 1))
                found[: n - g] += np.where(inside[g], got, np.float32(0))
    return np.add.reduceat(found, starts) if n else np.zeros(0, np.float32)


def codes(token: str) -> np.ndarray:
    """Classes of a token as _words() spells it."""
    return np.array([END, *map(_SPELLED.index, token), END], np.int32)


def subsequences(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct subsequences of one token and their summed weights."""
    letters, n = letters.astype(np.int64), len(letters)
    spans = [(a, b, n - a - b) for a in range(1, GAP + 1) for b in range(1, GAP + 1) if n > a + b]
    at = [(letters[:m] * LETTERS + letters[a : a + m]) * LETTERS + letters[a + b : a + b + m] for a, b, m in spans]
    if not at:
        return np.zeros(0, np.int64), np.zeros(0)
    if n > 2000:
        dense = np.zeros(LETTERS**3)
        for (a, b, _), part in zip(spans, at):
            dense += np.bincount(part, minlength=LETTERS**3) * DECAY ** (a + b + 1)
        own = np.flatnonzero(dense)
        return own, dense[own]
    own, place = np.unique(np.concatenate(at), return_inverse=True)
    return own, np.bincount(place, np.concatenate([np.full(m, DECAY ** (a + b + 1)) for a, b, m in spans]))


def sparse_features(token: str) -> tuple[np.ndarray, np.ndarray]:
    """The subsequences of one token and their weights, of length 1 as a vector."""
    at, value = subsequences(codes(token))
    return at, value / np.sqrt(value @ value) if len(value) else value


def features(token: str) -> np.ndarray:
    """The normalised feature vector of one token."""
    out = np.zeros(LETTERS**3)
    at, value = sparse_features(token)
    out[at] = value
    return out


class Landmarks:
    """Tokens whose kernels with others are taken; only their own subsequences are held."""

    def __init__(self, tokens: list[str]):
        parts = [sparse_features(t) for t in tokens]
        self.columns = np.unique(np.concatenate([at for at, _ in parts]))
        self.rows = np.zeros((len(tokens), len(self.columns)))
        for k, (at, value) in enumerate(parts):
            self.rows[k, np.searchsorted(self.columns, at)] = value

    def kernel(self, token: str) -> np.ndarray:
        at, value = sparse_features(token)
        place = np.minimum(np.searchsorted(self.columns, at), len(self.columns) - 1)
        known = self.columns[place] == at
        return self.rows[:, place[known]] @ value[known]

    def folded(self, weights: np.ndarray) -> np.ndarray:
        """One weight a subsequence for a weighted sum of the landmarks' kernels."""
        out = np.zeros(LETTERS**3)
        out[self.columns] = self.rows.T @ weights
        return out


_SENTENCE = re.compile(rb"[.!?\n]+(?=[\t-\r ]|\Z)")
_WHOLE_WORD = re.compile(rb"[A-Za-z]{2}[^\t-\r ]*[\t-\r ]+")


def parts(data: bytes, size: int = 0) -> Iterator[bytes]:
    """data in parts of about `size` bytes, each ending behind a word of two letters or more.

    So no token is cut, and no run of single letters that spell out a word; a part grows until there is such a word.
    """
    size, at = size or CHUNK, 0
    while at < len(data):
        end, seen = min(len(data), at + size), at
        while end < len(data):
            last = None
            for last in _WHOLE_WORD.finditer(data, max(at, end - 4096, seen), end):
                pass
            if last is not None and last.end() < end:
                end = last.end()
                break
            seen, end = max(at, end - 4096), min(len(data), end + max(4096, size // 4))
        yield data[at:end]
        at = end


@dataclass
class Model:
    weights: np.ndarray  # one float32 a subsequence
    bias: float
    slope: float
    offset: float

    def strongest(self, text: str | None) -> float:
        """The largest decision value of a token of the whole text; the bias where there is no token."""
        best = self.bias
        for data in parts((text or "").encode("utf-8", "surrogatepass")):
            letters, starts, lengths = tokens_of(data)
            if len(lengths):
                best = max(best, self._best(letters, starts, lengths, best - self.bias) + self.bias)
        return best

    def witnesses(self, text: str | None) -> Iterator[tuple[str, float]]:
        """The strongest token of each sentence and its value."""
        for data in parts((text or "").encode("utf-8", "surrogatepass")):
            for sentence in _SENTENCE.split(data):
                letters, starts, lengths = tokens_of(sentence)
                if len(lengths):
                    value = token_sums(letters, starts, self.weights) / norms(lengths)
                    k = int(np.argmax(value))
                    token = "".join(map(_SPELLED.__getitem__, letters[starts[k] + 1 : starts[k] + lengths[k] - 1].tolist()))
                    yield token, float(value[k]) + self.bias

    def _best(self, letters: np.ndarray, starts: np.ndarray, lengths: np.ndarray, floor: float) -> float:
        """The largest normalised sum above floor: from the largest bound down, until no bound beats the best."""
        bound = token_sums(letters, starts, self.weights) / norms(lengths)
        while True:
            k = int(np.argmax(bound))
            if bound[k] <= floor:
                return floor
            at, value = subsequences(letters[starts[k] : starts[k] + lengths[k]])
            got = float(self.weights[at].astype(float) @ value / np.sqrt(value @ value)) if len(value) else 0.0
            floor, bound[k] = max(floor, got), -np.inf

    def score(self, value: float) -> float:
        z = self.slope * value + self.offset
        return 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))


def _labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels to learn from: known labels outside the held-out fold, a bounded number of each class."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.where(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    ids = known.where("toxic = 1").orderBy(*order).limit(TOXIC_DOCS).unionByName(known.where("toxic = 0").orderBy(*order).limit(CLEAN_DOCS))
    rows = docs.join(F.broadcast(ids), "doc_id")  # at most TOXIC_DOCS + CLEAN_DOCS ids
    return rows.groupBy("doc_id", "toxic").agg(F.max("text").alias("text")).select("doc_id", "text", "toxic")  # repeats count once


def held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0


def _words(data: bytes) -> list[str]:
    letters, starts, lengths = tokens_of(data)
    text = "".join(map(_SPELLED.__getitem__, letters.tolist()))
    return [text[s + 1 : s + n - 1] for s, n in zip(starts.tolist(), lengths.tolist())]


def _token_table(sample: DataFrame) -> DataFrame:
    """token, and in how many different contexts (token before and after) of each class it occurs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, toxic in zip(b.column(0), b.column(1).to_pylist()):
                w = ["", *_words((text.as_py() or "").encode("utf-8", "surrogatepass")), ""]
                rows = sorted({(w[k], f"{w[k - 1]} {w[k + 1]}") for k in range(1, len(w) - 1) if len(w[k]) > 2})
                cols = [pa.array([t for t, _ in rows], pa.string()), pa.array([c for _, c in rows], pa.string()), pa.array([toxic] * len(rows), pa.int32())]
                yield pa.RecordBatch.from_arrays(cols, ["token", "context", "toxic"])

    rows = sample.select("text", "toxic").mapInArrow(run, "token string, context string, toxic int")
    rows = rows.select("token", F.xxhash64("context").alias("context"), "toxic").distinct()
    return rows.groupBy("token").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean"))


def variants(token: str, r: random.Random, n: int = VARIANTS) -> list[str]:
    """The token with a letter inserted or doubled somewhere inside."""
    out = []
    for _ in range(n):
        k = r.randrange(1, len(token))
        out.append(token[:k] + (r.choice("abcdefghijklmnopqrstuvwxyz") if r.random() < 0.8 else token[k - 1]) + token[k:])
    return out


def fit_machine(x: np.ndarray, y: np.ndarray, trust: np.ndarray, cost: float = 60.0, rounds: int = 40) -> tuple[np.ndarray, float]:
    """Linear support vector machine with squared hinge loss by Newton steps; classes weigh alike, rows by trust."""
    weight = cost * trust * np.where(y > 0, len(y) / max(1, (y > 0).sum()), len(y) / max(1, (y < 0).sum())) / 2
    xb = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(xb.shape[1])
    ridge = np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for turn in range(rounds):
        active = y * (xb @ w) < 1
        a = xb[active] * weight[active, None]
        new = np.linalg.solve(ridge + a.T @ xb[active], a.T @ y[active])
        step = new - w
        if np.abs(step).max() < 1e-9:
            break
        w = w + step if turn < 5 else w + 0.5 * step
    return w[:-1], float(w[-1])


def fit_slope(value: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Logistic calibration of decision values, by Newton steps with a small ridge; y as Platt's smoothed targets."""
    pos, neg = (y > 0.5).sum(), (y < 0.5).sum()
    target = np.where(y > 0.5, (pos + 1) / (pos + 2), 1 / (neg + 2))
    x = np.stack([value, np.ones(len(value))], axis=1)
    w = np.array([1.0, 0.0])
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - target)) + np.array([1e-3, 1e-6]) * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(hess + 1e-9 * np.eye(2), grad)
        w -= np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-8:
            break
    return float(max(w[0], 1e-3)), float(w[1])


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns from (doc_id, text) and labels (doc_id, toxic); without usable labels every score is the smoothed prior."""
    from .common import staged

    sample = staged(_labelled(only(docs, doc_id="long", text="string"), labels), "sample")
    sizes = {r.toxic: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = sizes.get(1, 0), sizes.get(0, 0)
    total = {r.toxic: r["n"] for r in labels.where(~held_out()).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect() if r.toxic in (0, 1)}
    prior = (total.get(1, 0) + 0.5) / (sum(total.values()) + 1)
    flat = Model(np.zeros(LETTERS**3, np.float32), 0.0, 1.0, math.log(prior / (1 - prior)))
    if not n1 or not n0:
        return flat
    table = staged(_token_table(sample), "tokens")
    odds = F.log((F.col("toxic") + 0.5) / F.lit(n1 + 1.0)) - F.log((F.col("clean") + 0.5) / F.lit(n0 + 1.0))
    strong = table.where((F.col("toxic") >= max(3, n1 // 70)) & (odds > MIN_LOG_ODDS))
    guess = strong.orderBy(F.desc("toxic"), "token").limit(MAX_POSITIVE).collect()
    positive = [r.token for r in guess]
    common = {r.token for r in guess if 8 * r.toxic >= guess[0].toxic}  # far rarer ones are no words that people bend
    if not positive:
        return flat
    clean = [r.token for r in table.where(odds < 1).orderBy(F.xxhash64("token"), "token").limit(CLEAN_TOKENS).collect()]
    r = random.Random(5)
    joined = np.concatenate([codes(t) for t in clean]) if clean else np.zeros(0, np.int64)
    lengths = np.array([len(t) + 2 for t in clean], np.int64)
    starts = np.cumsum(lengths) - lengths

    def decide(weights: np.ndarray, bias: float) -> np.ndarray:
        return token_sums(joined, starts, weights.astype(np.float32)) / norms(lengths) + bias

    near = np.max([decide(features(t), 0.0) for t in positive[:32]], axis=0) if clean else np.zeros(0)
    hard = [clean[int(k)] for k in np.argsort(-near, kind="stable")[:1000]]
    landmarks = Landmarks(positive + hard[: max(0, MAX_LANDMARKS - len(positive))])
    values, vectors = np.linalg.eigh(landmarks.rows @ landmarks.rows.T)
    root = vectors / np.sqrt(np.maximum(values, 1e-8)) @ vectors.T
    known: dict[str, np.ndarray] = {}

    def mapped(token: str) -> np.ndarray:
        if token not in known:
            known[token] = root @ landmarks.kernel(token)
        return known[token]

    toxic = dict.fromkeys(positive, 1)  # witness -> toxic sentences
    negative = dict.fromkeys([*[t for t in _ORDINARY if t not in toxic], *hard, *clean[:: max(1, len(clean) // 1000)]])
    for turn in range(TURNS):
        made = {t: variants(t, r) for t in toxic if t in common}
        x = np.array([mapped(t) for t in [*toxic, *[v for vs in made.values() for v in vs], *negative]])
        y = np.array([1.0] * (len(x) - len(negative)) + [-1.0] * len(negative))
        share = {t: math.sqrt(n) * (1.0 if t in common else RARE_TRUST) for t, n in toxic.items()}
        trust = np.array([*share.values(), *[share[t] * VARIANT_TRUST / len(vs) for t, vs in made.items() for _ in vs], *[1.0] * len(negative)])
        w, bias = fit_machine(x, y, trust)
        model = Model(landmarks.folded(root @ w).astype(np.float32), bias, 1.0, 0.0)
        if turn + 1 < TURNS:
            found = staged(_witnesses(sample, model), "witnesses")
            rows = found.where("toxic = 1").orderBy(F.desc("n"), "token").limit(MAX_POSITIVE).collect()
            toxic = dict.fromkeys(positive, 1) | {t.token: t["n"] for t in rows if t["n"] >= max(3, n1 // 70) and t.token in positive}
            negative |= dict.fromkeys(t.token for t in found.where("toxic = 0").orderBy(F.desc("value"), "token").limit(1000).collect() if t.token not in toxic)
            worst = np.argsort(-decide(model.weights.astype(float), bias), kind="stable")[:600] if clean else []
            negative |= dict.fromkeys(clean[int(k)] for k in worst if clean[int(k)] not in toxic)
    values = strongest(sample.select("doc_id", "text", "toxic"), model).select("toxic", "value").collect()  # the bounded sample
    v, t = np.array([a.value for a in values]), np.array([a.toxic for a in values], float)
    share = total[1] / (total[0] + total[1])
    weight = np.where(t > 0.5, share / (n1 / (n1 + n0)), (1 - share) / (n0 / (n1 + n0)))
    bent = np.array([float(mapped(q) @ w) + bias for p in toxic for q in made.get(p, [])])  # toxic sentences with a bent witness
    v, t = np.append(v, bent), np.append(t, np.ones(len(bent)))
    weight = np.append(weight, np.full(len(bent), weight[: len(values)][t[: len(values)] > 0.5].sum() / max(1, len(bent))))
    model.slope, model.offset = fit_slope(v, t, weight)
    return model


def _witnesses(sample: DataFrame, model: Model) -> DataFrame:
    """token, toxic, n (sentences that it carries) and its value: of a toxic document its strongest sentence alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple[str, int, float]] = []
            for text, toxic in zip(b.column(0), b.column(1).to_pylist()):
                found = [(t, toxic, x) for t, x in model.witnesses(text.as_py()) if len(t) > 2]
                rows += [max(found, key=lambda f: f[2])] if toxic and found else found
            cols = list(zip(*rows)) or [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.float64())], ["token", "toxic", "value"])

    rows = sample.select("text", "toxic").mapInArrow(run, "token string, toxic int, value double")
    return rows.groupBy("token", "toxic").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("value"))


def strongest(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id (and toxic, if there) with the decision value of the strongest token."""
    more = ["toxic"] if "toxic" in docs.columns else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            values = [model.strongest(t.as_py()) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(values, pa.float64()), pa.array([model.score(x) for x in values], pa.float64()), *b.columns[2:]], ["doc_id", "value", "score", *more])

    return docs.select("doc_id", "text", *more).mapInArrow(run, "doc_id long, value double, score double" + ", toxic int" * len(more))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of docs (doc_id, text); other columns are ignored.

    Null and empty texts get the score of a text without tokens; equal texts get equal scores; null ids are kept and
    count as not held out.
    """
    scored = strongest(only(docs, doc_id="long", text="string"), train(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
