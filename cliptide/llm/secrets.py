"""Secret scan: fixed patterns plus a likelihood ratio of two character Markov models.

One model is trained on random strings, one on ordinary words and identifiers; a token whose characters the first
explains far better than the second is a secret even where no pattern names it.
"""

from __future__ import annotations

import random
import re
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only

#: The base patterns. Order is the order of kinds at one start.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
KINDS = ("assign", "access", "hex", "markov")

ALPHABET = string.ascii_letters + string.digits + "+/_=-"
START = len(ALPHABET)
#: What the models are shown: shorter strings can't reach MIN_RATIO.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{8,}")
SAMPLE_DOCS = 4096
MIN_RATIO = 18.0
MIN_RATIO_PER_CHAR = 0.8
_CODE = {c: k for k, c in enumerate(ALPHABET)}
#: Ordinary identifiers beside those found in the sample.
_ORDINARY = "user_name get_value max_length created_at page-header nav-item index.html README utf-8 http https www example com org net content_type base64 sha256 2024-01-01 1234567890 0000000000000000 ---------------- ================ ________________ application/json text/html".split()


def merged(spans: list[tuple[int, int, int]]) -> list[list[int]]:
    """[start, end] of sorted spans, overlapping ones as one."""
    out: list[list[int]] = []
    for s, _, e in spans:
        if out and s < out[-1][1]:
            out[-1][1] = max(e, out[-1][1])
        else:
            out.append([s, e])
    return out


def replaced(text: str, spans: list[list[int]], mark: str) -> str:
    """text with each of the merged spans replaced by mark."""
    ends = [0, *[e for _, e in spans]]
    return mark.join([*[text[a:s] for a, (s, _) in zip(ends, spans)], text[ends[-1] :]])

#: Words that identifiers are made of.
_PARTS = "abstract account active admin alert answer app array attribute backup batch begin block body border branch buffer button call card category channel chart child clear clock cloud collection column comment common component connection container context cookie count current dashboard database debug delete detail dialog directory document download duration editor email enable entity error example export factory fetch file first form frame generate graph handler header helper history hook image index initial insert integer internal item json label last length library link listener local lock logger manager margin match member menu method module name next normal number observer open order package panel parser path payment permission picture point position prefix price private product project protocol proxy query random reader reference register remote render request resource result review root rule scale schema screen search secure sender server session setup share singleton source start static step store string submit suffix support symbol system target template test theme throttle time token total track transfer trigger unit upload user valid variable version view watch width worker write".split()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base matches, in code points."""
    out = []
    low = text.lower()
    if any(n in low for n in _NAMES):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _pairs(s: str) -> list[tuple[int, int]]:
    codes = [START, *[_CODE[c] for c in s if c in _CODE]]
    return list(zip(codes, codes[1:]))


def random_strings(n: int = 3000, seed: int = 7) -> list[str]:
    r = random.Random(seed)
    kinds = ("0123456789abcdef", string.ascii_letters + string.digits, string.ascii_letters + string.digits + "+/", string.ascii_uppercase + string.digits)
    return ["".join(r.choices(kinds[k % len(kinds)], k=r.randint(16, 48))) for k in range(n)]


def labelled_sample(docs: DataFrame, bound: int = SAMPLE_DOCS) -> DataFrame:
    """label (1 secret, 0 ordinary) and transition counts (a, b, n) from the `bound` documents of the lowest id hash."""
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, START + 1, START + 1), np.int64)
        for b in batches:
            for t in b.column(0):
                text = t.as_py() or ""
                spans = base_spans(text)
                for s, _, e in spans:
                    for m in TOKEN.finditer(text[s:e]):
                        for a, c in _pairs(m[0]):
                            counts[1, a, c] += 1
                text = replaced(text, merged(spans), " ")
                for w in re.findall(r"[A-Za-z0-9+/_=-]{4,}", text):
                    for a, c in _pairs(w):
                        counts[0, a, c] += 1
        label, a, c = np.nonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(label.astype("i4")), pa.array(a.astype("i4")), pa.array(c.astype("i4")), pa.array(counts[label, a, c])], ["label", "a", "b", "n"])

    rows = docs.join(F.broadcast(ids), "doc_id", "left_semi").select("text")  # at most `bound` ids
    return rows.mapInArrow(run, "label int, a int, b int, n long").groupBy("label", "a", "b").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, bound: int = SAMPLE_DOCS) -> np.ndarray:
    """Log-likelihood ratios of transitions, random over ordinary; START is the row of first characters."""
    counts = np.full((2, START + 1, START + 1), 0.5)
    for r in labelled_sample(only(docs, doc_id="long", text="string"), bound).collect():  # at most 2 * 68 * 68 rows
        counts[r.label, r.a, r.b] += r.n
    for s in random_strings():
        for a, b in _pairs(s):
            counts[1, a, b] += 1
    for s in [*_ORDINARY, *ordinary_strings()]:
        for a, b in _pairs(s):
            counts[0, a, b] += 1
    logs = np.log(counts / counts.sum(axis=2, keepdims=True))
    return logs[1] - logs[0]


def ordinary_strings(n: int = 1500, seed: int = 11) -> list[str]:
    """Numbers, dates, numbered names and identifiers in all usual cases, which are no secrets however odd they look."""
    r = random.Random(seed)
    digits = lambda k: "".join(r.choices(string.digits, k=k))
    made = [digits(r.randint(4, 19)) for _ in range(n)]
    made += [f"{r.randint(1970, 2039)}-{r.randint(1, 12):02}-{r.randint(1, 28):02}" for _ in range(n)]
    for k in range(6 * n):
        words = r.choices(_PARTS, k=r.randint(2, 5))
        camel = "".join(w.capitalize() for w in words)
        made.append((camel, camel[0].lower() + camel[1:], "_".join(words), "-".join(words), "/".join(words), "_".join(words).upper(), "-".join(words).upper())[k % 7])
    return made + [f"{r.choice(_ORDINARY)}{r.choice('_-')}{digits(r.randint(1, 4))}{r.choice('_-')}{r.choice(_ORDINARY)}" for _ in range(n)]


class Scanner:
    """Finds all spans of a text with a trained ratio table."""

    def __init__(self, ratios: np.ndarray):
        self.ratios = ratios.tolist()
        self.known: dict[str, bool] = {}

    def secret(self, token: str) -> bool:
        got = self.known.get(token)
        if got is None:
            total, last = 0.0, START
            for c in token:
                code = _CODE[c]
                total += self.ratios[last][code]
                last = code
            got = total >= MIN_RATIO and total >= MIN_RATIO_PER_CHAR * len(token)
            if len(self.known) < 100_000 and len(token) < 200:
                self.known[token] = got
        return got

    def spans(self, text: str | None) -> list[tuple[int, int, int]]:
        if not text:
            return []
        base = base_spans(text)
        more, taken, k = [], merged(base), 0
        for m in TOKEN.finditer(text):
            while k < len(taken) and taken[k][1] <= m.start():
                k += 1
            if (k == len(taken) or taken[k][0] >= m.end()) and self.secret(m[0]):
                more.append((m.start(), 3, m.end()))
        return sorted(base + more)


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def find_secrets(docs: DataFrame, ratios: np.ndarray) -> DataFrame:
    """doc_id and secrets: array of (kind, start, end), code points, end exclusive, by start and then kind.

    Null and empty texts have none; null ids and repeated rows are kept; other columns are ignored; an empty table
    gives an empty result. Spans of the Markov models never overlap those of the patterns.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(ratios)
        for b in batches:
            found = [[{"kind": KINDS[k], "start": s, "end": e} for s, k, e in scan.spans(t.as_py())] for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, _SPANS)], ["doc_id", "secrets"])

    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, secrets array<struct<kind:string,start:bigint,end:bigint>>")


def redact(docs: DataFrame, ratios: np.ndarray, mark: str = "[SECRET]") -> DataFrame:
    """docs with every secret of `text` replaced by mark; rows and columns stay, a null text stays null.

    Overlapping secrets take one mark; an empty table gives an empty result.
    """

    at = docs.columns.index("text")
    plain = docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # names with dots don't pass through mapInArrow

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner(ratios)
        for b in batches:
            out = []
            for t in b.column(at):
                text = t.as_py()
                if spans := merged(scan.spans(text)):
                    text = replaced(text, spans, mark)
                out.append(text)
            yield b.set_column(at, b.schema.field(at), pa.array(out, b.schema.field(at).type))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
