"""Bulk-synchronous best-fit packing of token pieces into fixed-length sequences.

Pieces of one length are interchangeable, and so are gaps of one size, so both sides are kept as runs: (length, first
rank, pieces) and (size, first sequence, sequences). Sizes are cut into half-octave ranges. In a round every run of
pieces asks for the range of its successor, the smallest gap that holds it; each range is swept by a task of its own,
from the longest pieces down, where a piece takes the smallest gap left; conflicts go to the longer length and within a
run to the lower rank. Gaps are updated, pieces left over ask again, and when no gap holds any piece, as many sequences
are opened as the tokens left need at least, each by one of the longest pieces. Rounds are Spark joins of two bounded
tables whatever the number of pieces is; pieces themselves are only ranked and joined to their places.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, hot_keys, only, salt, staged
from .tokens import packed_ids, vocabulary_path

CAPACITY = 4096
END_ID = 1
#: Longest run of places that one plan row holds, so that plans unfold evenly.
PLAN_ROWS = 4096
#: Kinds of rows of a round: pieces left, gaps, and places given.
LEFT, GAP, PLACED = 0, 1, 2
STATE = "kind int, size long, lo long, n long, base long, offset long"


def cut(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Pieces (doc_id, piece, start, length, ids_crc32) of every row of docs (doc_id, text).

    Null and empty texts are one piece, the end id; null ids and repeated rows are kept; other columns are ignored; an
    empty table has no pieces.
    """
    path = path or vocabulary_path()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: list[tuple] = []
            for doc, text in zip(b.column(0).to_pylist(), b.column(1)):
                ids = packed_ids(text.as_py(), path) + END_ID.to_bytes(4, "little")
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))], names)

    return only(docs, doc_id="long", text="string").mapInArrow(run, "doc_id long, piece int, start long, length long, ids_crc32 long")


def sweep(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    """One range: its pieces, longest first, into its gaps, smallest that holds them first; rows as STATE.

    A placed row puts n pieces of that length, from rank lo on, at that offset of n sequences in a row from base on.
    """
    out: list[tuple[int, int, int, int, int, int]] = []
    sizes: list[int] = []
    runs: dict[int, list[tuple[int, int]]] = defaultdict(list)

    def give(size: int, base: int, n: int) -> None:
        if size and n:
            if not runs[size]:
                insort(sizes, size)
            runs[size].append((base, n))

    gaps = rows[rows["kind"] == GAP].sort_values(["size", "base"])
    for size, base, n in zip(gaps["size"].tolist(), gaps["base"].tolist(), gaps["n"].tolist()):
        give(size, base, n)
    pieces = rows[rows["kind"] == LEFT].sort_values(["size", "lo"], ascending=[False, True])
    for length, rank, left in zip(pieces["size"].tolist(), pieces["lo"].tolist(), pieces["n"].tolist()):
        while left and (k := bisect_left(sizes, length)) < len(sizes):
            size = sizes[k]
            base, n = runs[size].pop()
            if not runs[size]:
                sizes.pop(k)
            each = size // length
            full = min(n, left // each)
            if full:
                out += [(PLACED, length, rank + j * full, full, base, capacity - size + j * length) for j in range(each)]
                rank, left = rank + each * full, left - each * full
                give(size - each * length, base, full)
            if full < n and left:  # fewer than one sequence takes
                out += [(PLACED, length, rank + j, 1, base + full, capacity - size + j * length) for j in range(left)]
                give(size - left * length, base + full, 1)
                full, rank, left = full + 1, rank + left, 0
            give(size, base + full, n - full)
        if left:
            out.append((LEFT, length, rank, left, 0, 0))
    out += [(GAP, size, 0, n, base, 0) for size in sizes for base, n in runs[size]]
    return pd.DataFrame(out, columns=["kind", "size", "lo", "n", "base", "offset"])


def places(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Placed rows for lengths (length, n): every piece of every length, by rank, gets a sequence and an offset."""
    band = F.floor(F.log2("size") * 2).cast("int")
    null = F.lit(0).cast("long")
    state = lengths.select(F.lit(LEFT).alias("kind"), F.col("length").cast("long").alias("size"), null.alias("lo"), F.col("n").cast("long").alias("n"), null.alias("base"), null.alias("offset"))
    given, opened = [], 0
    while True:
        facts = state.groupBy("kind", band.alias("band")).agg(F.min("size").alias("low"), F.max("size").alias("top"), F.sum("n").alias("n"), F.sum(F.col("size") * F.col("n")).alias("tokens")).collect()  # two kinds by 2 * log2(capacity) ranges
        left, tops = {f.band: f for f in facts if f.kind == LEFT}, {f.band: f.top for f in facts if f.kind == GAP}
        if not left:
            break
        after = {b: min((g for g in tops if g > b), default=None) for b in left}
        if any(f.low <= tops.get(b, 0) or after[b] is not None for b, f in left.items()):
            goal = F.lit(None).cast("int")
            for b in left:
                goal = F.when((band == b) & (F.col("size") <= tops.get(b, 0)), b).when(band == b, F.lit(after[b]).cast("int")).otherwise(goal)
            asked = state.withColumn("goal", F.when(F.col("kind") == GAP, band).otherwise(goal))
            swept = asked.where("goal is not null").groupBy("goal").applyInPandas(lambda pdf: sweep(pdf, capacity), STATE)
            state = swept.unionByName(asked.where("goal is null").drop("goal"))
        else:  # no gap holds any piece: open sequences by the longest pieces
            need = -(-sum(f.tokens for f in left.values()) // capacity)
            longer = F.lit(0)
            for b in left:
                longer = F.when(band == b, sum(f.n for c, f in left.items() if c > b)).otherwise(longer)
            before = longer + F.sum("n").over(Window.partitionBy(band).orderBy(F.desc("size"))) - F.col("n")
            ranked = state.where(F.col("kind") == LEFT).withColumn("before", before)
            ranked = ranked.withColumn("took", F.greatest(F.lit(0), F.least(F.col("n"), F.lit(need) - F.col("before"))))
            base = F.lit(opened) + F.col("before")
            row = lambda kind, size, lo, n, base, offset: F.struct(F.lit(kind).alias("kind"), size.cast("long").alias("size"), lo.cast("long").alias("lo"), n.cast("long").alias("n"), base.cast("long").alias("base"), offset.cast("long").alias("offset"))
            size, lo, took = F.col("size"), F.col("lo"), F.col("took")
            cut_ = F.explode(F.array(row(PLACED, size, lo, took, base, null), row(GAP, F.lit(capacity) - size, null, took, base, null), row(LEFT, size, lo + took, F.col("n") - took, null, null)))
            state = state.where(F.col("kind") == GAP).unionByName(ranked.select(cut_.alias("r")).select("r.*").where("n > 0 and size > 0"))
            opened += need
        state = staged(state, "round")
        given.append(state.where(F.col("kind") == PLACED))
        state = state.where(F.col("kind") != PLACED)
    out = state.where("false") if not given else given[0]
    for rows in given[1:]:
        out = out.unionByName(rows)
    return out.select(F.col("size").alias("length"), "lo", "n", "base", "offset")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces with sequence_id and offset (long): no two pieces overlap, every sequence is gapless from 0.

    pieces needs length (1 to capacity). Repeated rows are packed each by itself; null ids are kept; an empty table
    gives an empty result.
    """
    rows = staged(pieces.withColumn("_row", F.monotonically_increasing_id()), "pieces")  # written, so a row keeps its number
    lengths = rows.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    hot = hot_keys(lengths, "length", "n")
    dealt = rows.withColumn("_salt", F.when(F.col("length").isin(hot), salt(SALTS, "_row")).otherwise(F.lit(0)))
    runs = staged(dealt.groupBy("length", "_salt").agg(F.count(F.lit(1)).alias("n")), "runs")
    before = runs.withColumn("_before", F.sum("n").over(Window.partitionBy("length").orderBy("_salt")) - F.col("n")).drop("n")
    ranked = dealt.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row")) - 1)
    ranked = ranked.join(before.hint("merge"), ["length", "_salt"]).withColumn("_rank", (F.col("_rank") + F.col("_before")).cast("long")).drop("_salt", "_before")
    found = places(runs.groupBy("length").agg(F.sum("n").alias("n")), capacity)
    part = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(PLAN_ROWS).cast("long")))
    found = found.withColumn("a", part).select("length", (F.col("lo") + F.col("a")).alias("lo"), F.least(F.col("n") - F.col("a"), F.lit(PLAN_ROWS)).alias("n"), (F.col("base") + F.col("a")).alias("base"), "offset")
    # the places unfold to one row a piece, which Spark's size estimate of the plan doesn't show: never broadcast them
    unfolded = found.repartition("length", "lo").withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
    unfolded = unfolded.select("length", (F.col("lo") + F.col("k")).alias("_rank"), (F.col("base") + F.col("k")).alias("sequence_id"), "offset")
    return ranked.join(unfolded.hint("merge"), ["length", "_rank"]).select(*[F.col(f"`{c}`") for c in pieces.columns], "sequence_id", "offset")


def pack_documents(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None) -> DataFrame:
    """Cuts and packs every row of docs (doc_id, text), as cut() and pack() say; other columns are ignored."""
    return pack(cut(docs, capacity, path), capacity)
