import re
import struct
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cliptide.llm.common import staged
from cliptide.llm.tokens import packed_ids, vocabulary_path

from .test_near_copies import plain_components
from .test_packing import check_places
from .test_quality import plain
from .test_secrets import PATTERNS



@pytest.fixture(scope="module")
def path(spark, docs, tmp_path_factory):
    """The hard rows with clashing columns, and labels."""
    out = str(tmp_path_factory.mktemp("pipe"))
    df = spark.read.parquet(f"{docs}/documents.parquet").withColumns({"a.b": F.col("label"), "_row": F.lit(1), "_0": F.lit(2), "row": F.lit(3), "_at": F.lit(4)})
    df.write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(k, 1, 0) for k in range(0, 200, 2)], "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    return out


@pytest.fixture(scope="module")
def steps(spark, path):
    out = [spark.read.parquet(f"{path}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(staged(stage(spark, out[-1], path)))
    return out


def test_documents_keep_their_columns(steps):
    for df in steps[1:-1]:
        assert df.dtypes == steps[0].dtypes


def test_quality_and_copies(steps):
    start, good, single = ([tuple(r) for r in df.collect()] for df in steps[:3])
    assert all(not plain(r[1])[-1] for r in good)
    assert not Counter(good) - Counter(start)
    rows = sorted(good, key=lambda r: (r[0] is None, r[0] or 0))
    groups, want = {}, []
    for r, c in zip(rows, plain_components([(k, r[1]) for k, r in enumerate(rows)])):
        if c not in groups:
            groups[c] = want.append(r)
    assert Counter(single) == Counter(want)


def test_secrets_go_and_rows_stay(steps):
    before, after = steps[2].collect(), steps[3].collect()
    assert Counter(r.doc_id for r in before) == Counter(r.doc_id for r in after)
    for r in after:
        assert r.n_chars == len(r.text or "")
        for name, p, good in PATTERNS[1:]:
            assert not any(good(m) for m in p.finditer(r.text or ""))
    clean = {r.doc_id: r.text for r in before if not re.search(r"[0-9a-f]{24}|AKIA|(?i:pass|token|key|secret)", r.text or "")}
    same = [r.text == clean[r.doc_id] for r in after if r.doc_id in clean]
    assert all(same)


def test_mixing_only_repeats(steps):
    before, after = Counter(tuple(r) for r in steps[3].collect()), Counter(tuple(r) for r in steps[4].collect())
    assert not before - after and set(before) == set(after)
    assert all(n <= corpus_pipeline.MOST_COPIES * before[r] for r, n in after.items())


def test_packing_holds_every_document(steps):
    want = Counter()
    for r in steps[4].collect():
        ids = packed_ids(r.text, vocabulary_path()) + struct.pack("<I", 1)
        for k, at in enumerate(range(0, len(ids), 4 * 4096)):
            part = ids[at : at + 4 * 4096]
            want[(r.doc_id, k, at // 4, len(part) // 4, zlib.crc32(part))] += 1
    rows = steps[5].collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    check_places(rows)


def test_run_and_empty(spark, path, empty, steps, tmp_path):
    assert corpus_pipeline.run(spark, path).count() == steps[5].count()
    spark.read.parquet(f"{empty}/documents.parquet").write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{path}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_clean_documents_survive(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, sf).collect()}
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 1").collect()}
    assert len(good & kept) > 0.9 * len(good)
