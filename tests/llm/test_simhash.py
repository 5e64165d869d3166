import random
import re

import xxhash
from pyspark.sql import functions as F

from cliptide.llm import common, queries, simhash

from .conftest import rows_of


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows, budget=2):
    low = {}
    for d, f in rows:
        if d is not None:
            low[f] = min(d, low.get(f, d))
        low.setdefault(f, d)
    fps = list(low)
    up = {f: f for f in fps}

    def root(f):
        while up[f] != f:
            f = up[f]
        return f

    for i, a in enumerate(fps):
        for b in fps[:i]:
            if bin(a ^ b).count("1") <= budget:
                up[root(a)] = root(b)
    best = {}
    for f in fps:
        if low[f] is not None:
            best[root(f)] = min(low[f], best.get(root(f), low[f]))
    return [(d, f"{f:016x}", best.get(root(f))) for d, f in rows]


def key(x):
    return tuple((v is not None, v) for v in x)


def test_query_equals_brute_force(spark, docs, empty):
    got = [tuple(r) for r in queries.op4_simhash(spark, docs).select("doc_id", "fingerprint", "component_id").collect()]
    want = plain_components([(d, plain_fingerprint(t)) for d, t in rows_of(spark, docs)])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert queries.op4_simhash(spark, empty).count() == 0


def test_spark_hash_is_the_same(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("aé b c"))).first()[0] % 2**64 == xxhash.xxh64_intdigest("aé b c".encode(), 42)


def signed(x):
    return x - 2**64 if x >= 2**63 else x


def join(spark, fps, turns, allowed):
    rows = [(k, signed((f << t | f >> 64 - t) % 2**64), signed(f)) for f in fps for k, t in enumerate(turns)]
    return simhash.trie_self_join(spark.createDataFrame(rows, "r int, code long, id long"), allowed).collect()


def test_trie_join_finds_each_pair_once(spark):
    r = random.Random(5)
    fps = {r.getrandbits(64) for _ in range(150)}
    for f in list(fps)[:60]:  # dense neighbourhoods and chains
        for _ in range(6):
            f ^= 1 << r.randrange(64)
            fps.add(f)
    common = r.getrandbits(40) << 24  # one prefix holds half of all
    fps |= {common | r.getrandbits(24) for _ in range(len(fps))}
    fps = sorted(fps)
    got = [frozenset((x.a, x.b)) for x in join(spark, fps, (0, 32), simhash.TWO_ERRORS)]
    want = {frozenset((signed(a), signed(b))) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 2}
    assert len(got) == len(set(got)) and set(got) == want
    # a wider budget: what stays below it at every depth is found, and nothing beyond it
    got = {frozenset((x.a, x.b)) for x in join(spark, fps, (0, 16, 32, 48), simhash.CANDIDATES)}
    turned = lambda x, t: (x << t | x >> 64 - t) % 2**64
    fits = lambda x: any(all((turned(x, t) >> 64 - d).bit_count() <= e for d, e in simhash.CANDIDATES.items()) for t in (0, 16, 32, 48))
    pairs = {frozenset((signed(a), signed(b))): a ^ b for i, a in enumerate(fps) for b in fps[:i]}
    assert {p for p, x in pairs.items() if fits(x)} <= got <= {p for p, x in pairs.items() if x.bit_count() <= 13}


def test_ids_of_one_code_are_joined_by_the_least(spark):
    rows = spark.createDataFrame([(0, 5, 1), (0, 5, 2), (0, 5, 3), (0, 4, 9), (0, -1, 7)], "r int, code long, id long")
    assert sorted((x.a, x.b) for x in simhash.trie_self_join(rows, simhash.TWO_ERRORS).collect()) == [(1, 2), (1, 3), (1, 9)]


def test_components_of_chains_stars_and_rings(spark):
    r = random.Random(3)
    chain = list(range(0, 3000))
    names = chain[:]
    r.shuffle(names)
    links = [(names[k], names[k + 1]) for k in range(2999)] + [(5000, k) for k in range(5001, 5400)] + [(6000 + k, 6000 + (k + 1) % 50) for k in range(50)]
    got = {x.node: x.root for x in simhash.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(3000)} | {k: 5000 for k in range(5000, 5400)} | {k: 6000 for k in range(6000, 6050)}


def test_rows_without_ids_are_spread(spark):
    docs = spark.range(60_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("the same words again").alias("text"))
    out = simhash.near_duplicates(docs)
    assert out.where("component_id is null").count() == 60_000
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1 or out.rdd.getNumPartitions() == 1


def test_staged_tables_go(spark, docs):
    before = len(common._made)
    pairs = join(spark, [1, 2, 3, 1 << 40], (0, 32), simhash.TWO_ERRORS)
    assert len(pairs) == 5 and len(common._made) == before + 1  # the result alone stays
