import random
import struct
import zlib
from collections import Counter, defaultdict

import pandas as pd
from tokenizers import Tokenizer

from cliptide.llm import packing, queries
from cliptide.llm.tokens import packed_ids, vocabulary_path

from .conftest import rows_of


def library():
    t = Tokenizer.from_file(vocabulary_path())
    t.encode_special_tokens = True
    return t


def test_query_equals_library_and_is_gapless(spark, docs, empty):
    lib, want = library(), Counter()
    for d, t in rows_of(spark, docs):
        ids = [*lib.encode(t or "", add_special_tokens=False).ids, 1]
        for k, at in enumerate(range(0, len(ids), 4096)):
            part = ids[at : at + 4096]
            want[(d, k, at, len(part), zlib.crc32(struct.pack(f"<{len(part)}I", *part)))] += 1
    rows = queries.op10_packing(spark, docs).collect()
    assert Counter(tuple(r)[:5] for r in rows) == want
    filled = check_places(rows)
    total = sum(filled.values())
    assert len(filled) <= -(-total // 4096) + 1
    assert queries.op10_packing(spark, empty).count() == 0


def check_places(rows):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    filled = {}
    for s, parts in by.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096
        filled[s] = at
    return filled


def plain_bfd(lengths, capacity):
    gaps = []
    for n in sorted(lengths, reverse=True):
        fit = [g for g in gaps if g >= n]
        if fit:
            gaps.remove(min(fit))
            gaps.append(min(fit) - n)
        else:
            gaps.append(capacity - n)
    return len(gaps)


def test_rounds_against_best_fit_decreasing(spark):
    r = random.Random(2)
    cases = [
        (64, [min(64, int(r.paretovariate(0.7))) for _ in range(1500)]),
        (500, [r.randint(1, 500) for _ in range(1200)]),
        (4096, [min(4096, 1 + int(r.lognormvariate(5, 1.3))) for _ in range(2500)]),
        (100, [r.choice((34, 33, 50, 49, 17)) for _ in range(900)]),
        (100, [35] * 700 + [r.randint(1, 100) for _ in range(400)]),
        (7, [7, 1]),
    ]
    for capacity, lengths in cases:
        counts = Counter(lengths)
        plan = packing.places(spark.createDataFrame(sorted(counts.items()), "length long, n long"), capacity).collect()
        ranks, fill = defaultdict(list), defaultdict(list)
        for p in plan:
            ranks[p.length] += range(p.lo, p.lo + p.n)
            for k in range(p.n):
                fill[p.base + k].append((p.offset, p.length))
        assert all(sorted(ranks[x]) == list(range(n)) for x, n in counts.items())
        for parts in fill.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        best = plain_bfd(lengths, capacity)
        assert len(fill) <= best + max(1, 3 * best // 100), (capacity, len(fill), best)


def test_one_range_is_plain_best_fit():
    gaps = [(10, 0, 3), (12, 5, 2), (15, 9, 1)]
    rows = [(packing.GAP, size, 0, n, base, 0) for size, base, n in gaps] + [(packing.LEFT, 11, 0, 2, 0, 0), (packing.LEFT, 5, 4, 7, 0, 0)]
    out = packing.sweep(pd.DataFrame(rows, columns=["kind", "size", "lo", "n", "base", "offset"]), 20)
    got = sorted(tuple(map(int, x)) for x in out[out["kind"] == packing.PLACED].itertuples(index=False))
    # both 11s go to the 12s; the 5s fill the 10s two by two, then the 15
    assert [x for x in got if x[1] == 11] == [(packing.PLACED, 11, 0, 2, 5, 8)]
    assert sum(x[3] for x in got if x[1] == 5) == 7 and {b for x in got if x[1] == 5 for b in range(x[4], x[4] + x[3])} == {0, 1, 2, 9}
    assert not (out["kind"] == packing.LEFT).any()


def test_hot_lengths_and_rows_without_ids(spark):
    rows = [(None if i % 3 else i, 0, 700 if i % 3 else 1 + i % 900, i) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, piece int, length long, `a.b` int")
    got = packing.pack(df).collect()
    assert Counter((r.doc_id, r.length, r["a.b"]) for r in got) == Counter((a, c, d) for a, _, c, d in rows)
    check_places(got)


def test_cached_words_equal_the_library():
    lib, path = library(), vocabulary_path()
    r = random.Random(9)
    letters = "ab cA'stredvmlÉéİΣσßñ́̀ \t\n\x1c\x85\xa0​12<|>ndoxtf.,ǅ가각ᄀ　ﬁ½²😀"
    for _ in range(4000):
        x = "".join(r.choice(letters) for _ in range(r.randint(0, 30)))
        ids = lib.encode(x, add_special_tokens=False).ids
        assert packed_ids(x, path) == struct.pack(f"<{len(ids)}I", *ids)
