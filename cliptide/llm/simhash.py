"""SimHash fingerprints and a binary-trie self-join over them.

The trie of all distinct fingerprints is walked from the root by pairs of nodes at once: a pair carries the bits in
which its two prefixes differ, expands to its children's pairs, and is pruned as soon as it exceeds the error budget of
its depth. Fingerprints are rotated, one trie a rotation, so that the budget of the leading bits may be smaller than
that of all: of two errors in 64 bits at most one lies in the first half or at most one in the second, so two rotations
with one error allowed in the first half lose no link at two errors. A pair of nodes with one leaf each is settled at
once. No pair of documents within a group of copies is ever made: the trie holds distinct fingerprints.

near_duplicates() links fingerprints at a Hamming distance. near_copies() walks tries with a wider budget over sketches of
five-word shingles, several fingerprint words a text, for candidates, and compares their shingles exactly. Neither its node
pairs nor its candidates are written, as n variants of a text are n * n candidates: subtries are walked in memory, a task
gives a minimum spanning forest of what it finds, and all texts of a tree are compared with each other in cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hot_keys, only, scratch, spread_join, staged

BITS = 64
#: Errors allowed within the first so many bits of a rotated fingerprint: for two errors, and for candidates of copies (of
#: these subtrie_self_join() takes the last alone, beside one error in LEAD bits, which allows more).
TWO_ERRORS = {6: 1, 12: 1, 16: 1, 20: 1, 24: 1, 32: 1, 40: 2, 48: 2, 56: 2, 64: 2}
CANDIDATES = {6: 1, 12: 1, 16: 1, 20: 1, 24: 2, 32: 4, 40: 7, 48: 9, 56: 11, 64: 13}
#: A near copy: five words a shingle, Jaccard similarity of four fifths; its sketch has WORDS words, each turned four ways.
SHINGLE, LEAST, WORDS, TURNS = 5, (4, 5), 4, (0, 16, 32, 48)
#: Distinct texts up to which so many leading bits of a sketch may hold the one error of CANDIDATES; more texts: LEAD bits.
FEW, LEAD = {1024: 0, 16384: 12}, 16
#: Rows that a task gathers before it walks their subtries, pairs of leaves compared at once, and the most salts of a subtrie.
ROWS, AT_ONCE, SPREAD = 1 << 18, 1 << 21, 64
#: Differing bits of all words of two sketches, of 64 * WORDS, beyond which they are no candidates: copies at the threshold
#: differ in 39 on average (48 where four shingles meet five), strangers in 128.
FAR = 72
#: Sides at least, texts a side, and shingles that a task keeps, where many pairs are compared.
CELLS, SIDE, HELD = 8, 4096, 1 << 22
#: Texts a side, sides at most, texts and shingles compared at once, where all texts of a group are compared.
GROUP_SIDE, GROUP_SIDES, BLOCK, COLUMNS = 64, 32, 128, 1 << 14
#: At this depth leaves that are alone in their node are dropped from the trie.
SPARSE = 24
#: Depths at which the node pairs are written; between them a walk goes on in one plan.
WRITTEN = (12, 16, 20, 24)


def digests(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of the shingles of the whole text in order, repeats included; a shorter text is one shingle."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()  # bytes.lower() touches A-Z alone
    words = data.split()  # bytes.split() separates at \t \n \v \f \r and space alone
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return np.array([digest(b" ".join(words), 42)] if words else [], np.uint64)
    joined = b" ".join(words)
    ends, at = [], -1
    for w in map(len, words):
        at += w + 1
        ends.append(at)
    begins = [0, *[e + 1 for e in ends]]
    return np.fromiter((digest(joined[b:e], 42) for b, e in zip(begins, ends[shingle - 1 :])), np.uint64, len(words) - shingle + 1)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half of the hashes."""
    votes = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), 65536):  # bounded memory for very long texts
        part = hashes[k : k + 65536].astype(">u8").view(np.uint8).reshape(-1, 8)
        votes += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > len(hashes)).tobytes(), "big")


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Unsigned 64-bit SimHash of the whole text; 0 for a text without words."""
    return majority(digests(text, shingle))


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id and fp (the fingerprint as a signed long) of every row. Null and empty texts have fp 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, fp long")


def turned(column, bits: int):
    return F.shiftleft(column, bits).bitwiseOR(F.shiftrightunsigned(column, BITS - bits)) if bits else F.col(column)


def trie_self_join(leaves: DataFrame, allowed: dict[int, int]) -> DataFrame:
    """Pairs (a, b), a < b, of ids whose codes stay within `allowed` in some trie; leaves: r (the trie), code, id.

    allowed: depth -> errors in that many leading bits. Where several ids share a code, the least of them stands for
    all and is paired with each. The result is staged.
    """
    spark = leaves.sparkSession

    def prefix(depth: int):
        return F.lit(0).cast("long") if depth == 0 else F.col("code") if depth == BITS else F.shiftrightunsigned("code", BITS - depth)

    def counted(depth: int, *by):
        one = F.min(F.struct("code", "id")).alias("one")
        return leaves.groupBy("r", *by, prefix(depth).alias("p")).agg(F.count(F.lit(1)).alias("n"), one)

    depths, budget = sorted(allowed), max(allowed.values())
    apart = "na = 1 and nb = 1 and a != b"  # a pair of single leaves is settled: its ids are compared, and it passes on
    with scratch(spark) as kept:
        leaves = staged(leaves.select("r", "code", "id").distinct(), "leaves")
        root = counted(0).where("n > 1")
        pairs = root.select("r", F.col("p").alias("a"), F.col("n").alias("na"), F.col("one").alias("x"), F.col("p").alias("b"), F.col("n").alias("nb"), F.col("one").alias("y"), F.lit(0).alias("errors"))
        for up, depth in zip([0, *depths], depths):
            if up == SPARSE:
                many = leaves.groupBy("r", prefix(up).alias("p")).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                leaves = staged(leaves.withColumn("p", prefix(up)).join(many, ["r", "p"], "left_semi").drop("p"), "leaves")
            node = F.struct("p", "n", "one")
            kids = counted(depth, prefix(up).alias("up")).groupBy("r", "up").agg(F.collect_list(node).alias("kids"), F.sum("n").alias("n")).where("n > 1")  # at most 2 ** (depth - up) a node
            side = lambda name: kids.select(F.col("r").alias(f"r{name}"), F.col("up").alias(f"u{name}"), F.col("kids").alias(f"k{name}"))  # noqa: B023, E731
            alone = lambda x: F.array(F.struct(F.shiftrightunsigned(f"{x}.code", BITS - depth).alias("p") if depth < BITS else F.col(f"{x}.code").alias("p"), F.lit(1).cast("long").alias("n"), F.col(x).alias("one")))  # noqa: B023, E731
            wide = pairs.join(side("a"), (F.col("r") == F.col("ra")) & (F.col("a") == F.col("ua")), "left")
            wide = wide.join(side("b"), (F.col("r") == F.col("rb")) & (F.col("b") == F.col("ub")), "left")
            wide = wide.withColumns({"ka": F.coalesce("ka", alone("x")), "kb": F.coalesce("kb", alone("y"))})
            e = f"errors + bit_count((s.p ^ t.p) & {(1 << (depth - up)) - 1}L)"
            # a node paired with itself gives each pair of children once; a child with itself where it has two leaves
            fresh = "(a != b or s.p < t.p or (s.p = t.p and s.n > 1))"
            both = f"explode(flatten(transform(ka, s -> transform(filter(kb, t -> {fresh} and (({apart}) or {e} <= {allowed[depth]})), t -> struct(s.p as a, s.n as na, s.one as x, t.p as b, t.n as nb, t.one as y, {e} as errors))))) as m"
            pairs = wide.select("r", F.expr(both)).select("r", "m.*").where(f"not ({apart}) or bit_count(x.code ^ y.code) <= {budget}")
            if depth in WRITTEN:
                pairs = staged(pairs, "pairs")
        found = pairs.where(f"a != b and bit_count(x.code ^ y.code) <= {budget}").select(F.least("x.id", "y.id").alias("a"), F.greatest("x.id", "y.id").alias("b"))
        alike = counted(BITS).where("n > 1").select("r", F.col("p").alias("code"), F.col("one.id").alias("a"))
        alike = leaves.join(alike, ["r", "code"]).where("id != a").select("a", F.col("id").alias("b"))
        out = staged(alike.unionByName(found).distinct(), "found")
        kept.append(out)
    return out


def walked(sub: np.ndarray, code: np.ndarray, ident: np.ndarray, own: np.ndarray, lead: int, most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of the pairs in the subtries of subtrie_self_join(); sub holds trie, half, half's bits and salt from left to right."""
    order = np.lexsort((ident, code, sub))
    sub, code, own = sub[order], code[order], own[order]
    fresh = np.ones(len(sub), bool)
    fresh[1:] = (sub[1:] != sub[:-1]) | (code[1:] != code[:-1])
    first = np.flatnonzero(fresh)
    half = (sub // (SPREAD << LEAD)) & 1
    same = np.flatnonzero(~fresh & own & (half == 0))
    yield order[first[np.cumsum(fresh)[same] - 1]], order[same]
    sub, code, order, own, half = (x[first] for x in (sub, code, order, own, half))
    width = lead // 2
    bits = (code >> np.uint64(BITS - lead)).astype(np.int64) if lead else np.zeros(len(code), np.int64)
    spot = (sub << width) | np.where(half == 0, bits & ((1 << width) - 1), bits >> width)  # ascends, as code does within sub
    node, begin = np.unique(spot, return_index=True)
    end = np.append(begin[1:], len(spot))
    at = np.repeat(np.arange(len(node)), end - begin)  # the node of each leaf

    def compared(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Leaf x beside the leaves from low up to high."""
        upto = np.cumsum(high - low)
        k = 0
        while k < len(x):
            stop = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + AT_ONCE, "right")))
            n = high[k:stop] - low[k:stop]
            left = np.repeat(x[k:stop], n)
            right = np.arange(len(left)) + np.repeat(low[k:stop] - np.cumsum(n) + n, n)
            near = np.bitwise_count(code[left] ^ code[right]) <= most
            yield order[left[near]], order[right[near]]
            k = stop

    x = np.flatnonzero(own & (half == 0))
    yield from compared(x, x + 1, end[at[x]])
    for bit in range(width):
        other = node ^ (1 << bit)
        place = np.minimum(np.searchsorted(node, other), len(node) - 1)
        there = (other > node) & (node[place] == other)
        x = np.flatnonzero(own & there[at])
        yield from compared(x, begin[place[at[x]]], end[place[at[x]]])


def subtries(leaves: DataFrame, n: int, lead: int) -> DataFrame:
    """sub, code, id, own and further columns of the leaves (r, code, id and those) in the subtries of subtrie_self_join()."""
    width, more = lead // 2, [c for c in leaves.columns if c not in ("r", "code", "id")]
    high = lambda bits: F.shiftrightunsigned("code", BITS - bits) if bits else F.lit(0).cast("long")
    parts = [F.struct(F.lit(0).alias("h"), high(width).alias("p"))]
    if width:
        parts.append(F.struct(F.lit(1).alias("h"), high(lead).bitwiseAND(F.lit((1 << width) - 1)).alias("p")))
    rows = leaves.select("code", "id", *more, "r", F.explode(F.array(*parts)).alias("x"))
    rows = rows.select("code", "id", *more, (((F.col("r") * 2 + F.col("x.h")).cast("long") * (1 << LEAD)) + F.col("x.p")).alias("sub"))
    usual = max(4096, 4 * n // (1 << width))
    hot = rows.groupBy("sub").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > usual)
    hot = hot.select("sub", F.least(F.lit(SPREAD), F.ceil(F.col("n") / F.lit(usual))).cast("int").alias("salts"))
    rows = rows.join(F.broadcast(hot), "sub", "left").withColumn("salts", F.coalesce("salts", F.lit(1)))
    rows = rows.select("sub", "code", "id", *more, "salts", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("s"))
    own = F.pmod(F.xxhash64("id"), F.col("salts")) == F.col("s")
    rows = rows.select((F.col("sub") * SPREAD + F.col("s")).alias("sub"), "code", "id", own.alias("own"), *more)
    return rows.repartition("sub").sortWithinPartitions("sub")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """The columns of the batches, ordered by the first, in pieces of ROWS rows or more that end where its value does."""
    held, enough = None, ROWS
    for batch in batches:
        new = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        held = [*map(list, zip(new))] if held is None else [[*h, x] for h, x in zip(held, new)]
        if sum(map(len, held[0])) >= enough:
            rows = [np.concatenate(h) for h in held]
            cut = int(np.searchsorted(rows[0], rows[0][-1]))  # the last subtrie may go on
            if cut:
                yield [x[:cut] for x in rows]
            held = [[x[cut:]] for x in rows]
            enough = max(ROWS, 2 * len(held[0][0]))
    if held is not None:
        yield [np.concatenate(h) for h in held]


def subtrie_self_join(leaves: DataFrame, n: int, lead: int, most: int) -> DataFrame:
    """Pairs (a, b), a < b, of ids whose codes differ in at most one of `lead` leading bits and in at most `most` of all.

    leaves: r (the trie), code, id, without repeats; n: how many ids there are. One error leaves a half of the leading
    bits untouched, so a trie is cut into the subtries below the first half and, its halves swapped, below the second:
    a leaf is sent to two tasks, whatever the errors allowed. There nodes at depth `lead` are paired with themselves
    and with the nodes one bit away, and their leaves compared; no node pair leaves the task. Subtries far above the
    mean are dealt over salts by the lesser leaf. Ids that share a code are paired with the least of them, which stands
    for all. The result is staged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for sub, code, ident, own in gathered(batches):
            for x, y in walked(sub, code.view(np.uint64), ident, own, lead, most):
                a, b = ident[x], ident[y]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    return staged(subtries(leaves, n, lead).mapInArrow(run, "a long, b long").distinct(), "found")


def spanning(u: np.ndarray, v: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the edges (u, v) of a minimum spanning forest over n nodes, earlier edges being lighter, and its roots.

    Boruvka's rounds: each tree takes its lightest edge to another tree.
    """
    root, live, taken = np.arange(n), np.arange(len(u)), []
    while True:
        live = live[root[u[live]] != root[v[live]]]
        if not len(live):
            return np.concatenate([*taken, live]), root
        best = np.full(n, len(u))
        for end in (u, v):
            first = np.full(n, len(u))
            first[root[end[live[::-1]]]] = live[::-1]  # the last one assigned stays
            best = np.minimum(best, first)
        tree = np.flatnonzero(best < len(u))
        edge = best[tree]
        taken.append(np.unique(edge))
        up = np.arange(n)
        up[tree] = root[u[edge]] + root[v[edge]] - tree
        both = (up[up] == np.arange(n)) & (up > np.arange(n))  # two trees that took the same edge
        up[both] = np.flatnonzero(both)
        while (up[up] != up).any():
            up = up[up]
        root = up[root]


def lightest(a: np.ndarray, b: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The edges (a, b) of a minimum spanning forest by (far, a, b)."""
    order = np.lexsort((b, a, far))
    ids, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    kept = order[spanning(place[: len(a)][order], place[len(a) :][order], len(ids))[0]]
    return a[kept], b[kept], far[kept]


def subtrie_forest(leaves: DataFrame, n: int, lead: int, most: int, far: int) -> DataFrame:
    """Of the pairs of subtrie_self_join() that differ in at most `far` bits of all words, as many as join the same ids.

    Returns (a, b, far), the bits in which all words differ.

    leaves: r, code, id and the words of the id's sketch, one a column. A task keeps a minimum spanning forest of its
    pairs by the bits in which their words differ, so it gives fewer pairs than it has ids, however many it finds, and
    every id's nearest pair there is among them. Equal codes are pairs whatever the other words. The result is staged.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3
        for sub, code, ident, own, *words in gathered(batches):
            waiting, size = [], 0
            for x, y in walked(sub, code.view(np.uint64), ident, own, lead, most):
                apart = sum(np.bitwise_count((w[x] ^ w[y]).view(np.uint64)).astype(np.int64) for w in words)
                near = (apart <= far) | (code[x] == code[y])
                a, b = ident[x[near]], ident[y[near]]
                waiting.append((np.minimum(a, b), np.maximum(a, b), apart[near]))
                size += len(a)
                if size > AT_ONCE:
                    kept = lightest(*(np.concatenate(c) for c in zip(kept, *waiting)))
                    waiting, size = [], 0
            kept = lightest(*(np.concatenate(c) for c in zip(kept, *waiting)))
        yield pa.RecordBatch.from_arrays([pa.array(k) for k in kept], ["a", "b", "far"])

    return staged(subtries(leaves, n, lead).mapInArrow(run, "a long, b long, far long").distinct(), "found")


def components(links: DataFrame) -> DataFrame:
    """node and root of the nodes of links (a, b): root is the least node that links reach.

    Large-star and small-star rounds in turn until no edge changes; their number grows with the logarithm of a
    component's size, not with its radius. Each round writes one table. The result is staged.
    """
    spark = links.sparkSession
    previous = None
    with scratch(spark) as kept:
        edges = staged(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
        while True:
            state = edges.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("h")).first()
            if state == previous:
                break
            previous = state
            both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
            least = large.groupBy("u").agg(F.min("v").alias("m"))
            small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
            edges = staged(small.distinct(), "edges")
        roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        out = staged(roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct()), "components")
        kept.append(out)
    return out


def labelled(reps: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """key and the smallest label of the component of every row of reps (key, label); links name keys."""
    spark = reps.sparkSession
    if not links.limit(1).count():
        return reps.select(key, "label")
    with scratch(spark) as kept:
        member = components(links)
        lowest = member.join(reps.select(F.col(key).alias("node"), "label"), "node").groupBy("root").agg(F.min("label").alias("lowest"))
        moved = member.join(lowest, "root").select(F.col("node").alias(key), "lowest")
        out = staged(reps.join(moved, key, "left").select(key, F.coalesce("lowest", "label").alias("label")), "labels")
        kept.append(out)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """doc_id, fp (signed long) and component_id of every row of docs (doc_id, text): fingerprints link at two errors.

    component_id is the smallest doc_id among all documents reachable over links, itself included. Null ids keep their
    rows and take the component of their fingerprint; repeated rows and equal texts share a fingerprint and so a
    component. An empty table gives an empty result. Other columns are ignored.
    """
    prints = staged(fingerprints(docs, shingle).withColumn("row", F.monotonically_increasing_id()), "prints")
    reps = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("label"), F.count(F.lit(1)).alias("n")), "reps")
    with scratch(docs.sparkSession) as kept:
        tries = F.explode(F.array(*[F.struct(F.lit(k).alias("r"), turned("fp", t).alias("code"), F.col("fp").alias("id")) for k, t in enumerate((0, BITS // 2))]))
        links = trie_self_join(reps.select(tries.alias("x")).select("x.*"), TWO_ERRORS)
        found = labelled(reps, links, "fp")
        if hasattr(found, "staged_path"):
            kept.append(found)
    hot = hot_keys(reps, "fp", "n")
    return spread_join(prints, found, "fp", hot, F.col("row")).select("doc_id", "fp", F.col("label").alias("component_id"))


_MIX = np.uint64(0x9E3779B97F4A7C15)


def sketch(shingles: np.ndarray, words: int = WORDS) -> list[int]:
    """`words` fingerprints of a set of hashes, each by a mixing of its own."""
    out = []
    for k in range(words):
        out.append(majority(shingles))
        shingles = shingles * _MIX + np.uint64(k)
        shingles = (shingles ^ (shingles >> np.uint64(32))) * _MIX
        shingles ^= shingles >> np.uint64(29)
    return out


def sketches(docs: DataFrame) -> DataFrame:
    """row, doc_id, id (names the set of shingles), n (its size) and words of every row of docs (row, doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, sizes, words = [], [], []
            for t in b.column(2):
                found = np.unique(digests(t.as_py(), SHINGLE))
                ids.append(xxhash.xxh64_intdigest(found.tobytes(), 42) - 2**63)
                sizes.append(len(found))
                words.append(np.array(sketch(found), np.uint64).view(np.int64).tolist() if len(found) else [])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(words, pa.list_(pa.int64()))], ["row", "doc_id", "id", "n", "words"])

    return docs.mapInArrow(run, "row long, doc_id long, id long, n long, words array<long>")


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether the Jaccard similarity of two shingle sets reaches the threshold, in whole numbers."""
    both = len(np.intersect1d(a, b, assume_unique=True))
    return LEAST[1] * both >= LEAST[0] * (len(a) + len(b) - both)


def checked(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose texts (id, text) are similar.

    Few pairs are joined with their texts. Where a text is in many pairs, ids are dealt to k sides, each two sides meet
    in one cell, and a text is sent once to each of its k cells instead of once a pair.
    """
    many = texts.count()
    sides = max(CELLS, -(-many // SIDE))
    return in_cells(pairs, texts, sides) if pairs.count() > sides * many else beside(pairs, texts)


def in_cells(pairs: DataFrame, texts: DataFrame, sides: int) -> DataFrame:
    """checked() by cells of two sides; a cell holds its texts, and pairs follow them."""
    side = lambda key: F.pmod(F.xxhash64(key), F.lit(sides)).cast("int")
    cell = lambda x, y: F.least(x, y) * sides + F.greatest(x, y)
    places = F.transform(F.sequence(F.lit(0), F.lit(sides - 1)), lambda x: cell(side("id"), x))
    rows = texts.select(F.explode(places).alias("cell"), F.lit(None).cast("long").alias("b"), F.col("id").alias("a"), "text")
    rows = rows.unionByName(pairs.select(cell(side("a"), side("b")).alias("cell"), "b", "a", F.lit(None).cast("string").alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own, held, size = None, {}, {}, 0

        def known(key: int) -> np.ndarray:
            nonlocal size
            if key not in held:
                if size > HELD:
                    held.clear()
                    size = 0
                held[key] = np.unique(digests(own[key], SHINGLE))
                size += len(held[key])
            return held[key]

        for batch in batches:
            good = []
            for place, b, a, text in zip(*(c.to_pylist() for c in batch.columns)):
                if place != at:
                    at, own, held, size = place, {}, {}, 0
                if b is None:
                    own[a] = text
                elif similar(known(a), known(b)):
                    good.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([g[k] for g in good], pa.int64()) for k in (0, 1)], ["a", "b"])

    ordered = rows.select("cell", "b", "a", "text").repartition("cell").sortWithinPartitions("cell", F.col("b").isNotNull(), "a")
    return ordered.mapInArrow(run, "a long, b long")


def beside(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """checked() by a join of both texts to each pair."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}  # a few sets, as a node may be in many pairs

        def known(key: int, text: pa.Scalar) -> np.ndarray:
            if key not in held:
                if len(held) > 64:
                    held.pop(next(iter(held)))
                held[key] = np.unique(digests(text.as_py(), SHINGLE))
            return held[key]

        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3))
            good = [similar(known(a, s), known(b, t)) for a, b, s, t in rows]
            yield batch.filter(pa.array(good, pa.bool_())).select(["a", "b"])

    both = pairs
    for key, other, name in (("a", "b", "s"), ("b", "a", "t")):
        hot = hot_keys(pairs.groupBy(key).agg(F.count(F.lit(1)).alias("n")), key, "n")
        both = spread_join(both, texts.select(F.col("id").alias(key), F.col("text").alias(name)), key, hot, F.col(other), "inner")
    return both.select("a", "b", "s", "t").mapInArrow(run, "a long, b long")


def shared(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many hashes each set on the left has in common with each on the right."""
    x, y = np.concatenate(left), np.concatenate(right)
    common = np.intersect1d(x, y)
    ends = []
    for own, sets in ((x, left), (y, right)):
        at = np.minimum(np.searchsorted(common, own), max(len(common) - 1, 0))
        here = common[at] == own if len(common) else np.zeros(len(own), bool)
        ends.append((np.repeat(np.arange(len(sets)), [len(s) for s in sets])[here], at[here], len(sets)))
    out = np.zeros((len(left), len(right)), np.int64)
    for k in range(0, len(common), COLUMNS):
        parts = []
        for row, at, n in ends:
            part = np.zeros((n, min(COLUMNS, len(common) - k)), np.float32)  # sums of up to COLUMNS ones are exact
            here = (at >= k) & (at < k + COLUMNS)
            part[row[here], at[here] - k] = 1
            parts.append(part)
        out += (parts[0] @ parts[1].T).astype(np.int64)
    return out


def linked(sets: list[np.ndarray], side: np.ndarray, part: np.ndarray) -> list[tuple[int, int]]:
    """Pairs of places of similar sets that join all sets which similar sets join; part names sets joined before.

    Sets of the two sides are compared with each other, those of one side alone with themselves. Sets that are joined
    need no comparison.
    """
    root = np.unique(part, return_inverse=True)[1]
    size = np.array([len(s) for s in sets])
    places = [np.flatnonzero(side == s) for s in np.unique(side)]
    blocks = [[p[k : k + BLOCK] for k in range(0, len(p), BLOCK)] for p in places]
    pairs = [(x, y) for x in blocks[0] for y in blocks[1]] if len(blocks) > 1 else [(x, y) for k, y in enumerate(blocks[0]) for x in blocks[0][: k + 1]]
    out = []
    for x, y in pairs:
        main = np.bincount(np.concatenate([root[x], root[y]])).argmax()
        for p, q in ((x[root[x] != main], y), (x[root[x] == main], y[root[y] != main])):
            if not len(p) or not len(q):
                continue
            both = shared([sets[i] for i in p], [sets[i] for i in q])
            i, j = np.nonzero(LEAST[1] * both >= LEAST[0] * (size[p][:, None] + size[q][None, :] - both))
            i, j = p[i], q[j]
            taken, joined = spanning(root[i], root[j], len(sets))
            out += zip(i[taken].tolist(), j[taken].tolist())
            root = joined[root]
    return out


def grouped(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) of similar texts that join all texts of a group which similar texts of it join.

    rows: root (the group), n (its texts), id, part (names texts joined before), text. Every two texts of a group that
    are not joined yet are compared. A group is dealt to at most GROUP_SIDES sides, each two sides meet in one cell, and
    a text is sent once to each of its cells; a cell gives fewer pairs than it has texts, however many are similar.
    """
    sides = F.least(F.lit(GROUP_SIDES), F.ceil(F.col("n") / F.lit(GROUP_SIDE))).cast("int")
    rows = rows.withColumn("k", sides).withColumn("side", F.pmod(F.xxhash64("id"), F.col("k")).cast("int"))
    cell = F.expr("explode(transform(sequence(0, k - 1), x -> least(side, x) * k + greatest(side, x)))").alias("cell")
    rows = rows.select("root", cell, "side", "id", "part", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found(ids: list, sides: list, parts: list, sets: list) -> pa.RecordBatch:
            good = linked(sets, np.array(sides), np.array(parts))
            return pa.RecordBatch.from_arrays([pa.array([ids[g[k]] for g in good], pa.int64()) for k in (0, 1)], ["a", "b"])

        at, own = None, ([], [], [], [])
        for batch in batches:
            for root, cell, side, ident, part, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (root, cell) != at:
                    if at is not None:
                        yield found(*own)
                    at, own = (root, cell), ([], [], [], [])
                for held, x in zip(own, (ident, side, part, np.unique(digests(text, SHINGLE)))):
                    held.append(x)
        if at is not None:
            yield found(*own)

    return rows.repartition("root", "cell").sortWithinPartitions("root", "cell", "id").mapInArrow(run, "a long, b long")


def near_copies(docs: DataFrame) -> DataFrame:
    """row, doc_id and component of every row of docs (row, doc_id, text): the lowest row that links of copies reach.

    Texts are linked where their sets of five-word shingles have a Jaccard similarity of 0.8 or more; candidates come
    from the tries of their sketches, within FAR bits of all words, and no link is made by an estimate. Texts that
    candidates join are a group; the nearest pair of each is compared first, and where that leaves texts of a group
    apart, all its pairs. row tells the rows of docs apart.
    component has (no_id, doc_id, row): the smallest doc_id leads, a null id comes last, and equal ids are ordered by
    row. Texts without words are copies of each other. Repeated rows are copies; an empty table gives an empty result;
    other columns are ignored.
    """
    docs = only(docs, row="long", doc_id="long", text="string")
    prints = staged(sketches(docs), "sketches")
    with scratch(docs.sparkSession) as kept:
        label = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "row")).alias("label")
        reps = staged(prints.groupBy("id").agg(label, F.count(F.lit(1)).alias("rows"), F.first("n").alias("n"), F.first("words").alias("words")), "sets")
        whole = [F.get("words", F.lit(k)).alias(f"w{k}") for k in range(WORDS)]
        word = reps.select("id", *whole, F.posexplode("words").alias("w", "word"))
        tries = F.explode(F.array(*[F.struct((F.col("w") * len(TURNS) + k).alias("r"), turned("word", t).alias("code")) for k, t in enumerate(TURNS)]))
        total = reps.count()
        lead = next((bits for few, bits in FEW.items() if total <= few), LEAD)
        leaves = word.select("id", *[f"w{k}" for k in range(WORDS)], tries.alias("x")).select("x.*", "id", *[f"w{k}" for k in range(WORDS)])
        pairs = subtrie_forest(leaves, total, lead, CANDIDATES[BITS], FAR)
        state = reps.select("id", "label")
        if pairs.limit(1).count():
            member = components(pairs).select(F.col("node").alias("id"), "root")
            chosen = reps.join(member, "id", "left_semi").select(F.col("label.row").alias("row"), "id")
            texts = staged(docs.join(chosen, "row").select("id", "text"), "texts")
            end = lambda k: reps.select(F.col("id").alias(k), F.col("n").alias(f"n{k}"))
            size = F.lit(LEAST[1]) * F.least("na", "nb") >= F.lit(LEAST[0]) * F.greatest("na", "nb")
            near = F.min(F.struct("far", "a", "b")).alias("x")  # each id's nearest pair: no more pairs than ids
            near = pairs.groupBy("a").agg(near).select("x.*").unionByName(pairs.groupBy("b").agg(near).select("x.*"))
            near = staged(near.select("a", "b").distinct(), "nearest")
            links = staged(checked(near.join(end("a"), "a").join(end("b"), "b").where(size).select("a", "b"), texts), "links")
            state = labelled(reps, links, "id")
            # a group of two has no other pair; in larger ones texts that are still apart may be joined by others
            parts = staged(member.join(state.select("id", F.col("label.row").alias("part")), "id"), "parts")
            open_ = parts.groupBy("root").agg(F.count(F.lit(1)).alias("n"), (F.min("part") != F.max("part")).alias("apart"))
            open_ = staged(open_.where("apart and n > 2").select("root", "n"), "open")
            if open_.limit(1).count():
                rows = spread_join(parts, open_, "root", hot_keys(open_, "root", "n"), F.col("id"), "inner")
                links = links.unionByName(staged(grouped(rows.join(texts, "id")), "grouped"))
                state = labelled(reps, links, "id")
        out = staged(state, "states")
        many = hot_keys(reps, "id", "rows")
        kept.append(out)
    return spread_join(prints.select("row", "doc_id", "id"), out, "id", many, F.col("row")).select("row", "doc_id", F.col("label").alias("component"))
