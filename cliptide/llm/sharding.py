"""Balanced label propagation: documents move to their neighbours' shards under capacity quotas.

Links join the documents of a group (equal texts here), and optional edges join groups. A group's documents are
interchangeable, so the state is how many of them lie in each shard: at most `shards` rows a group, never a pair of
documents, however large a group is. A round joins that state with the edges, lets every (group, shard) row ask for
the group's strongest shard that still takes documents in, thins the requests to flows under which no shard exceeds its capacity, and
writes the new state. Documents without links settle last and make all shards equal; the fewer there are, the less
room there is to gather a group that is larger than a shard's free part.
"""

from __future__ import annotations

from itertools import accumulate

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SALTS, hot_keys, salt, spread_join, staged

SHARDS = 24
ROUNDS = 8
BUCKET_ROWS = 50_000


def _uniform(*cols) -> Column:
    """A stable draw in [0, 1)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 30)) / F.lit(float(1 << 30))


def flows(asked: np.ndarray, load: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """Most of the asked moves (from, to) under which no shard ends above its capacity (or above its load, if that is higher)."""
    x = asked.astype(float)
    limit = np.maximum(capacity, load)
    for _ in range(500):
        after = load - x.sum(axis=1) + x.sum(axis=0)
        over = np.maximum(0, after - limit)
        if over.max(initial=0) < 0.5:
            break
        into = x.sum(axis=0)
        x *= (1 - over / np.maximum(into, 1e-9)).clip(0, 1)
    return x


def propagate(state: DataFrame, capacity: list[int], edges: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """state (grp, shard, n) after label propagation; edges (a, b, weight), if any, link groups in both directions."""
    shards, cap = len(capacity), np.array(capacity)
    shut = np.zeros(shards, bool)  # full shards that nothing leaves: asking for them again would be in vain
    for turn in range(rounds):
        load = np.zeros(shards)
        for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # one row a shard
            load[r.shard] = r.n
        votes = state
        if edges is not None:
            both = edges.select("a", "b", "weight").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "weight"))
            heard = both.join(state.withColumnRenamed("grp", "b"), "b").select(F.col("a").alias("grp"), "shard", (F.col("n") * F.col("weight")).cast("long").alias("n"))
            votes = state.unionByName(heard).groupBy("grp", "shard").agg(F.sum("n").alias("n"))
        room = [s for s in range(shards) if not shut[s]]
        # ties: any fixed choice within a group; over edges both ends must choose alike, or they would change places
        tie = F.xxhash64("grp", "shard") if edges is None else F.xxhash64("shard", F.lit(turn))
        rank = F.struct(F.col("n"), tie.alias("h"), F.col("shard").alias("to"))
        best = votes.where(F.col("shard").isin(room)).groupBy("grp").agg(F.max(rank).alias("best"))
        asks = state.join(best, "grp", "left").select("grp", "shard", "n", F.col("best.to").alias("to"), F.col("best.n").alias("v"), F.col("best.h").alias("h"))
        if edges is not None:
            asks = asks.join(votes.select("grp", "shard", F.col("n").alias("own")), ["grp", "shard"])
        else:
            asks = asks.withColumn("own", F.col("n"))
        wants = F.col("to").isNotNull() & (F.col("to") != F.col("shard")) & ((F.col("v") > F.col("own")) | ((F.col("v") == F.col("own")) & (F.col("h") > tie)))
        asks = staged(asks.select("grp", "shard", "n", F.when(wants, F.col("to")).alias("to")), "asks")
        asked = np.zeros((shards, shards))
        for r in asks.where("to is not null").groupBy("shard", "to").agg(F.sum("n").alias("n")).collect():  # shards ** 2 rows
            asked[r["shard"], r["to"]] = r["n"]
        if not asked.any():
            break
        given = flows(asked, load, cap)
        share = np.divide(given, asked, out=np.zeros_like(given), where=asked > 0)
        refused = (asked.sum(axis=0) > 0) & (given.sum(axis=0) < 0.1 * asked.sum(axis=0))
        if not share.any() and not (refused & ~shut).any():
            break
        shut |= refused
        rate = F.element_at(F.array(*[F.lit(float(v)) for v in share.ravel()]), F.col("shard") * shards + F.coalesce("to", F.lit(0)) + 1)
        moved = F.when(F.col("to").isNull(), F.lit(0)).otherwise(F.least(F.col("n"), F.floor(F.col("n") * rate + _uniform("grp", "shard", F.lit(turn)))))
        split = asks.withColumn("m", moved.cast("long")).select("grp", F.explode(F.array(F.struct("shard", (F.col("n") - F.col("m")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("m").alias("n")))).alias("x")).select("grp", "x.*")
        state = staged(split.where("n > 0").groupBy("grp", "shard").agg(F.sum("n").alias("n")), "state")
    return state


def _ranked(df: DataFrame, keys: list[str], order: list[str], buckets: int, n: str | None = None) -> DataFrame:
    """df with _at: how many units (rows, or the sum of n) of its keys come before a row; buckets keep tasks bounded."""
    size = F.lit(1).cast("long") if n is None else F.col(n)
    df = staged(df.withColumn("_bucket", salt(buckets, *order, F.lit(len(keys)))), "bucketed")  # a draw of its own for each use
    sums = df.groupBy(*keys, "_bucket").agg(F.sum(size).alias("_n"))
    before = sums.withColumn("_before", F.sum("_n").over(Window.partitionBy(*keys).orderBy("_bucket")) - F.col("_n")).drop("_n") if keys else None
    if before is None:
        rows = sorted((r["_bucket"], r["_n"]) for r in sums.collect())  # one number a bucket
        starts = dict(zip([b for b, _ in rows], accumulate([0, *[x for _, x in rows]])))
        if not starts:
            return df.withColumn("_at", F.lit(0).cast("long")).drop("_bucket")
        before = df.sparkSession.createDataFrame([(int(b), int(s)) for b, s in starts.items()], "_bucket int, _before long")
    inside = F.sum(size).over(Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)) - size
    return df.withColumn("_in", inside).join(before, [*keys, "_bucket"]).withColumn("_at", F.col("_in") + F.col("_before")).drop("_in", "_before", "_bucket")


def settle(state: DataFrame, capacity: list[int]) -> tuple[DataFrame, list[int]]:
    """state with no shard above its capacity, by exact ranks, and how much room each shard has left."""
    load = [0] * len(capacity)
    for r in state.groupBy("shard").agg(F.sum("n").alias("n")).collect():
        load[r["shard"]] = r["n"]
    excess = [max(0, a - c) for a, c in zip(load, capacity)]
    room = [max(0, c - a) for a, c in zip(load, capacity)]
    if any(excess):
        starts = [0, *accumulate(excess)]
        cut = F.element_at(F.array(*[F.lit(e) for e in excess]), F.col("shard") + 1)
        ranked = _ranked(state, ["shard"], ["n", "grp"], SALTS, "n")
        out = F.greatest(F.lit(0), F.least(F.col("n"), cut - F.col("_at")))
        ranked = staged(ranked.withColumns({"out": out, "lo": F.element_at(F.array(*[F.lit(s) for s in starts]), F.col("shard") + 1) + F.col("_at")}), "excess")
        parts, at = [], 0
        for s, r in enumerate(room):  # released units, in rank order, fill the rooms in order
            parts.append(F.struct(F.lit(s).alias("shard"), F.greatest(F.lit(0), F.least(F.col("lo") + F.col("out"), F.lit(at + r)) - F.greatest(F.col("lo"), F.lit(at))).cast("long").alias("n")))
            at += r
        back = ranked.where("out > 0").select("grp", F.explode(F.array(*parts)).alias("x")).select("grp", "x.shard", "x.n")
        state = staged(ranked.select("grp", "shard", (F.col("n") - F.col("out")).cast("long").alias("n")).unionByName(back).where("n > 0").groupBy("grp", "shard").agg(F.sum("n").alias("n")), "settled")
        left, total = [], sum(excess)
        for r in room:
            used = min(r, total)
            total -= used
            left.append(r - used)
        room = left
    return state, room


def shard_documents(docs: DataFrame, shards: int = SHARDS, edges: DataFrame | None = None, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of docs (doc_id, text); shard sizes differ by one row at most.

    Equal texts are linked; edges (a, b, weight) may link further groups, named by md5 of the text. Null and empty
    texts count as equal. A group larger than a shard fills several. Null ids and repeated rows are placed each by
    itself; other columns are ignored; an empty table gives an empty result.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.unhex(F.md5(text)).alias("grp"))
    rows = staged(rows, "rows")
    groups = staged(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "groups")
    if edges is not None:
        ends = edges.select(F.col("a").alias("grp")).unionByName(edges.select(F.col("b").alias("grp"))).distinct()
        groups = staged(rows.join(ends.unionByName(groups.select("grp")).distinct(), "grp", "left_semi").groupBy("grp").agg(F.count(F.lit(1)).alias("_n")), "linked")
    total = rows.count()
    quota = [total // shards + (s < total % shards) for s in range(shards)]
    hot = hot_keys(groups, "grp", "_n")
    rows = staged(spread_join(rows, groups, "grp", hot, F.col("doc_id")), "sized")
    linked, free = rows.where("_n is not null").drop("_n"), rows.where("_n is null").drop("_n")
    start = linked.groupBy("grp", salt(shards, "doc_id", "text_crc32").alias("shard")).agg(F.count(F.lit(1)).alias("n"))
    state, room = settle(propagate(staged(start, "start"), quota, edges, rounds), quota)
    # a group's documents take its shards by rank
    cold = F.when(F.col("grp").isin(hot), salt(SALTS, "doc_id", F.lit(1))).otherwise(F.lit(0)) if hot else F.lit(0)
    linked = staged(linked.withColumn("_s", cold), "linked_rows")
    first = linked.groupBy("grp", "_s").agg(F.count(F.lit(1)).alias("c"))
    first = first.withColumn("_first", F.sum("c").over(Window.partitionBy("grp").orderBy("_s")) - F.col("c")).drop("c")
    linked = linked.join(first, ["grp", "_s"]).withColumn("_r", F.row_number().over(Window.partitionBy("grp", "_s").orderBy("doc_id")) - 1 + F.col("_first"))
    over = Window.partitionBy("grp").orderBy("shard")
    places = state.withColumn("hi", F.sum("n").over(over)).withColumn("lo", F.col("hi") - F.col("n"))
    places = places.withColumn("_s", F.explode(F.when(F.col("grp").isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))) if hot else F.array(F.lit(0))))
    places = places.select(F.col("grp").alias("g"), F.col("_s").alias("s"), "lo", "hi", "shard")
    placed = linked.join(places, (F.col("g") == F.col("grp")) & (F.col("s") == F.col("_s")) & (F.col("_r") >= F.col("lo")) & (F.col("_r") < F.col("hi"))).select("doc_id", "size", "text_crc32", "shard")
    # documents without links fill what room is left, in one distributed ranking
    buckets = max(16 * SALTS, -(-total // BUCKET_ROWS))
    ranked = _ranked(free, [], ["doc_id", "text_crc32"], buckets)
    ends = list(accumulate(room))
    shard = F.lit(shards - 1)
    for s in reversed(range(shards - 1)):
        shard = F.when(F.col("_at") < ends[s], F.lit(s)).otherwise(shard)
    filled = ranked.select("doc_id", "size", "text_crc32", shard.alias("shard"))
    out = _ranked(placed.unionByName(filled), ["shard"], ["doc_id", "text_crc32"], max(SALTS // 2, -(-total // (shards * BUCKET_ROWS))))
    return out.select("doc_id", "size", "text_crc32", "shard", F.col("_at").alias("slot"))
