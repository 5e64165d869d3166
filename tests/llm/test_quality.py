import re
from collections import Counter

import duckdb

from cliptide.llm import quality, queries

from .conftest import rows_of


def plain(text):
    t = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", t)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {j for i, w in enumerate(windows) if seen[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, rep = len(words), len(covered)
    return n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), rep, n < 10 or 100 * rep > 20 * n


def test_query_equals_brute_force(spark, docs, empty):
    got = Counter(tuple(r)[:7] for r in queries.op7_quality(spark, docs).collect())
    assert got == Counter((d, *plain(t)) for d, t in rows_of(spark, docs))
    rows = queries.op7_quality(spark, docs).collect()
    assert all(not r.kept for r in rows if r.base_failed)
    assert queries.op7_quality(spark, empty).count() == 0


def test_ablations_by_bits(spark, docs):
    rows = quality.ledger(spark.read.parquet(f"{docs}/documents.parquet").select("doc_id", "text")).select("failure_bits")
    bits = [r[0] for r in rows.collect()]
    for r in quality.ablations(rows).collect():
        policy = next(p for p in quality.POLICIES if p.version == r.policy)
        m, bit = quality.mask(policy), 1 << [x.name for x in quality.RULES].index(r.rule)
        assert r.rejected == sum(b & m != 0 for b in bits)
        assert r.only_this_rule == sum(b & m == bit for b in bits)
        assert r.kept_without == sum(b & m & ~bit == 0 for b in bits)


def test_clean_rows_stay_and_junk_goes(spark):
    path = "/root/testdata/sf0.01"
    rows = queries.op7_quality(spark, path).select("doc_id", "n_words", "kept").toPandas()
    c = duckdb.connect()
    quality_of = dict(c.execute(f"select doc_id, quality from '{path}/labels.parquet'").fetchall())
    rows["quality"] = rows.doc_id.map(quality_of)
    good, bad = rows[rows.quality == 1], rows[rows.quality == 0]
    assert good.kept.mean() > 0.9 and bad.kept.mean() < 0.4
