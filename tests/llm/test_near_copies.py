import random

import numpy as np

import corpus_pipeline
from cliptide.llm import simhash


def plain_shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def plain_components(rows):
    sets = [plain_shingles(t) for _, t in rows]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if 5 * len(a & b) >= 4 * len(a | b):
                up[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def copies(n=30):
    """Texts of 100 words and copies of them in which three words differ, some copied again: distances above two bits."""
    r = random.Random(8)
    out = []
    for _ in range(n):
        words = [f"w{r.randrange(4000)}" for _ in range(100)]
        out.append(" ".join(words))
        for _ in range(r.randrange(4)):
            words = list(words)
            for k in r.sample(range(100), r.choice((1, 2, 2, 4, 8))):
                words[k] = f"x{r.randrange(4000)}"
            out.append(" ".join(words))
    r.shuffle(out)
    return list(enumerate(out))


def test_components_equal_brute_force(spark):
    rows = copies()
    df = spark.createDataFrame([(i, i, t) for i, t in rows], "row long, doc_id long, text string").repartition(5)
    got = {x.row: x.component.row for x in simhash.near_copies(df).collect()}
    want, low = plain_components(rows), {}
    for (i, _), c in zip(rows, want):
        low[c] = min(i, low.get(c, i))
    assert got == {i: low[c] for (i, _), c in zip(rows, want)}
    assert 30 <= len(set(got.values())) < len(rows)


def test_stage_drops_real_near_copies(spark):
    r = random.Random(4)
    words = [f"w{r.randrange(4000)}" for _ in range(100)]
    near = words[:40] + ["other"] + words[41:80] + ["another"] + words[81:]
    rows = [(0, " ".join(words)), (1, " ".join(near)), (2, " ".join(r.sample(words, 100)))]
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(x.doc_id for x in left.collect()) == [0, 2]


def test_stage_keeps_one_row_of_each_component(spark):
    r = random.Random(6)
    x, y, z = (" ".join(f"w{r.randrange(4000)}" for _ in range(60)) for _ in range(3))
    rows = [(5, x), (5, y), (3, y), (7, z), (7, z), (None, z), (None, x), (None, x + " end")]
    left = corpus_pipeline.near_duplicates(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted((d.doc_id, d.text) for d in left.collect()) == sorted([(5, x), (3, y), (7, z)])


def test_recall_on_the_documents_table(spark):
    """Against every pair of texts that share a rare shingle, compared exactly."""
    texts = sorted({r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect() if r.text and r.text.split()})
    sets = [plain_shingles(t) for t in texts]
    holders = {}
    for k, s in enumerate(sets):
        for x in s:
            holders.setdefault(x, []).append(k)
    links = set()
    for own in holders.values():
        if 1 < len(own) <= 100:
            links |= {(a, b) for i, b in enumerate(own) for a in own[:i]}
    links = {(a, b) for a, b in links if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    df = spark.createDataFrame([(k, k, t) for k, t in enumerate(texts)], "row long, doc_id long, text string")
    found = {x.row: x.component.row for x in simhash.near_copies(df).collect()}
    assert links and sum(found[a] == found[b] for a, b in links) >= 0.9 * len(links)


def test_no_node_pairs_are_written(spark, monkeypatch):
    """What is written on the way is less than the leaves of the tries, which the node pairs outnumber."""
    r = random.Random(12)
    rows = [(k, k, " ".join(f"w{r.randrange(4000)}" for _ in range(12))) for k in range(3000)]
    written = []

    def staged(df, name="table", plain=simhash.staged):
        out = plain(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(simhash, "staged", staged)
    found = simhash.near_copies(spark.createDataFrame(rows, "row long, doc_id long, text string")).collect()
    assert len(found) == 3000 and sum(written) < 3000 * simhash.WORDS * len(simhash.TURNS)


def test_subtries_equal_brute_force(spark, monkeypatch):
    """Every pair within one error of the leading bits, also where subtries are dealt over salts and cut at any row."""
    monkeypatch.setattr(simhash, "ROWS", 64)
    r = random.Random(1)
    codes = [r.getrandbits(64) >> r.choice((0, 0, 16)) for _ in range(200)]
    codes += [c ^ sum(1 << b for b in r.sample(range(64), r.choice((0, 1, 2, 9, 13, 14)))) for c in r.choices(codes, k=400)]
    codes += [r.getrandbits(40) & r.getrandbits(40) for _ in range(4200)]
    least = {c: i for i, c in reversed(list(enumerate(codes)))}
    rows = [(0, c - (c >> 63 << 64), i) for i, c in enumerate(codes)]
    leaves = spark.createDataFrame(rows, "r int, code long, id long")
    ids = sorted(least.values())
    near = {(i, j) for k, i in enumerate(ids) for j in ids[k + 1 :] if (codes[i] ^ codes[j]).bit_count() <= 9}
    alike = {(least[c], i) for i, c in enumerate(codes) if least[c] != i}
    for lead in (0, 12, 16):
        want = {(i, j) for i, j in near if not lead or ((codes[i] ^ codes[j]) >> 64 - lead).bit_count() <= 1}
        got = [(x.a, x.b) for x in simhash.subtrie_self_join(leaves, 600, lead, 9).collect()]
        assert len(got) == len(set(got)) and set(got) == want | alike


def test_many_pairs_are_compared_in_cells(spark):
    """Both ways of comparing give the pairs that brute force gives, and cells send a text once a side."""
    r = random.Random(3)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(w if r.random() > 0.03 else "x" + w for w in base) for _ in range(40)] + [None, "one two"]
    sets = [plain_shingles(t or "") for t in texts]
    pairs = [(a, b) for b in range(len(texts)) for a in range(b)]
    want = {(a, b) for a, b in pairs if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])}
    df = spark.createDataFrame(pairs, "a long, b long"), spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    assert 0 < len(want) < len(pairs) and len(pairs) > simhash.CELLS * len(texts)
    assert "Join" not in simhash.checked(*df)._jdf.queryExecution().optimizedPlan().toString()
    for found in (simhash.checked(*df), simhash.beside(*df)):
        assert {(x.a, x.b) for x in found.collect()} == want


def joined(n, pairs):
    """The least node that pairs reach from each of n nodes."""
    up = list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for a, b in pairs:
        x, y = sorted((root(a), root(b)))
        up[y] = x
    return [root(i) for i in range(n)]


def test_many_variants_give_few_pairs(spark, monkeypatch):
    """400 variants of one text, some nearer than others: what is written grows with them, and components are exact."""
    r = random.Random(21)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join(w if r.random() > 0.02 * (k % 3 + 1) else f"x{r.randrange(5)}{w}" for w in base) for k in range(400)]
    written = []

    def staged(df, name="table", plain=simhash.staged):
        out = plain(df, name)
        written.append(out.count())
        return out

    monkeypatch.setattr(simhash, "staged", staged)
    df = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "row long, doc_id long, text string")
    got = [x.component.row for x in sorted(simhash.near_copies(df).collect())]
    sets = [plain_shingles(t) for t in texts]
    links = [(a, b) for b in range(400) for a in range(b) if 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b])]
    assert len(links) > 8 * 400 and 1 < len(set(got)) < 400
    assert got == joined(400, links)
    assert max(written) < 8 * 400


def test_forest_joins_what_all_pairs_join(spark, monkeypatch):
    monkeypatch.setattr(simhash, "ROWS", 64)
    monkeypatch.setattr(simhash, "AT_ONCE", 128)
    r = random.Random(2)
    flip = lambda c, n: c ^ sum(1 << b for b in r.sample(range(64), n))
    signed = lambda c: c - (c >> 63 << 64)
    words = [[r.getrandbits(64) for _ in range(4)] for _ in range(10)]
    words += [[flip(c, r.choice((2, 4, 9, 13, 20, 30))) for c in w] for w in r.choices(words, k=300)]
    rows = [(k, signed(w[k]), i, *map(signed, w)) for i, w in enumerate(words) for k in range(4)]
    leaves = spark.createDataFrame(rows, "r int, code long, id long, w0 long, w1 long, w2 long, w3 long")
    ids = range(len(words))
    bits = lambda a, b: [(x ^ y).bit_count() for x, y in zip(words[a], words[b])]
    want = [(a, b) for b in ids for a in range(b) if min(d := bits(a, b)) <= 13 and sum(d) <= 72]
    got = [(x.a, x.b) for x in simhash.subtrie_forest(leaves, len(words), 0, 13, 72).collect()]
    assert set(got) <= set(want) and len(want) > 2 * len(words)
    assert joined(len(words), got) == joined(len(words), want)


def test_cells_join_what_brute_force_joins(monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK", 16)
    monkeypatch.setattr(simhash, "COLUMNS", 32)
    r = random.Random(5)
    base = [r.getrandbits(64) for _ in range(80)]
    sets = [np.unique(np.array([x if r.random() > p else r.choice((x ^ 1, x ^ 2)) for x in base], np.uint64)) for p in r.choices((0.05, 0.1, 0.15, 0.2), k=70)]
    sets += [np.zeros(0, np.uint64), np.array([3], np.uint64), np.array([3], np.uint64)]
    n = len(sets)
    both = lambda a, b: len(set(sets[a].tolist()) & set(sets[b].tolist()))
    like = {(a, b) for b in range(n) for a in range(b) if 5 * both(a, b) >= 4 * (len(sets[a]) + len(sets[b]) - both(a, b))}
    assert simhash.shared(sets, sets).tolist() == [[both(a, b) for b in range(n)] for a in range(n)]
    for side in (np.zeros(n, int), np.arange(n) % 2):
        for part in (np.arange(n), np.arange(n) // 8):
            before = [(a, a + 1) for a in range(n - 1) if part[a] == part[a + 1]]
            want = [(a, b) for a, b in like if not side.any() or side[a] != side[b]]
            got = simhash.linked(sets, side, part)
            assert {tuple(sorted(p)) for p in got} <= set(want) and len(got) < n
            assert joined(n, before + got) == joined(n, before + want)
            assert len(set(joined(n, want))) > 3
