import zlib

import numpy as np
import pytest

from cliptide.llm import queries, toxicity

from .conftest import rows_of

PATH = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def model(spark):
    return toxicity.train(spark.read.parquet(f"{PATH}/documents.parquet"), spark.read.parquet(f"{PATH}/labels.parquet"))


def kernel(a, b):
    """The kernel of two tokens by its definition, normalised."""

    def parts(t):
        t, out = f"<{t}>", {}
        for i in range(len(t)):
            for j in range(i + 1, min(len(t), i + 4)):
                for k in range(j + 1, min(len(t), j + 4)):
                    u = t[i] + t[j] + t[k]
                    out[u] = out.get(u, 0) + toxicity.DECAY ** (k - i + 1)
        return out

    x, y = parts(a), parts(b)
    own = lambda z: np.sqrt(sum(v * v for v in z.values()))
    return sum(v * y.get(u, 0) for u, v in x.items()) / own(x) / own(y)


def test_features_give_the_kernel():
    for a, b in (("idiot", "idiot"), ("idiot", "idxiot"), ("clown", "brown"), ("abcabcabc", "abc"), ("ab", "ab"), ("a", "ab")):
        assert abs(toxicity.features(a) @ toxicity.features(b) - kernel(a, b)) < 1e-9


def test_text_sums_equal_single_tokens():
    r = np.random.default_rng(0)
    w = r.normal(size=toxicity.LETTERS**3).astype(np.float32)
    text = "One two, thr-ee fo'ur x y z é façade ÉTÉ a b"
    letters, starts, lengths = toxicity.tokens_of(text.encode())
    words = toxicity._words(text.encode())
    assert words[:4] == ["one", "two", "three", "four"] and "xyz" not in words  # é stands beside it: one run of letters
    sums = toxicity.token_sums(letters, starts, w)
    best = []
    for s, t in zip(sums, words):
        at, value = toxicity.subsequences(toxicity.codes(t))
        assert abs(s - w[at] @ value) < 1e-3
        assert toxicity.norms(np.array([len(t) + 2]))[0] <= np.sqrt(value @ value) + 1e-9
        best.append(w @ toxicity.features(t))
    model = toxicity.Model(w, 0.25, 1.0, 0.0)
    assert abs(model.strongest(text) - (max(0.0, max(best)) + 0.25)) < 1e-4
    assert toxicity._words(b"so i d i o t there") == ["so", "idiot", "there"]
    assert toxicity._words(b"a b cd") == ["a", "b", "cd"]
    assert len(sums) == len(words)


def test_held_out_labels_are_told_apart(spark):
    rows = queries.op9_toxicity(spark, PATH).join(spark.read.parquet(f"{PATH}/labels.parquet"), "doc_id").toPandas()
    assert (rows.held_out == [zlib.crc32(str(d).encode()) % 5 == 0 for d in rows.doc_id]).all()
    held = rows[rows.held_out]
    rank = held.score.rank()
    n1, n0 = (held.toxic == 1).sum(), (held.toxic == 0).sum()
    assert (rank[held.toxic == 1].sum() - n1 * (n1 + 1) / 2) / (n1 * n0) > 0.92
    assert held[held.toxic == 0].predicted.mean() < 0.03
    assert held[held.toxic == 1].predicted.mean() > 0.75
    assert ((rows.score >= 0) & (rows.score <= 1)).all() and ((rows.score >= 0.5) == (rows.predicted == 1)).all()


def test_gaps_and_insertions_are_tolerated(model):
    score = lambda t: model.score(model.strongest(t))
    clean = "The and attion to thanedble the, anea. Eriner thanea"
    assert score(clean) < 0.2 and score("") < 0.2 and score(None) < 0.2
    assert score("the house by the river is green and quiet this morning") < 0.5
    for insult in ("idiot", "i d i o t", "i.d.i.o.t", "IDIOT!!", "i-di-ot", "clown", "stupid"):
        assert score(f"{clean} {insult} {clean}") > 0.5, insult
    inserted = [w[:k] + c + w[k:] for w in ("worthless", "pathetic", "disgusting", "stupid", "idiot") for k in range(1, len(w)) for c in "xzqeo"]
    assert np.mean([score(f"{clean} {w} {clean}") >= 0.5 for w in inserted]) > 0.8


def test_score_does_not_depend_on_cuts(model):
    words = "green house i d i o t by the m.o.r.o.n river é ü stuuupid a b c x-y d ".split(" ") * 40
    for size in (1, 7, 64, 500, 4096):
        for text in (" ".join(words), " ".join("idiot"), "i d i o t " * 300, "x" * 5000 + " i d i o t " + "word " * 50):
            data = text.encode()
            cut = list(toxicity.parts(data, size))
            assert b"".join(cut) == data
            assert [t for part in cut for t in toxicity._words(part)] == toxicity._words(data), (size, text[:30])


def test_query_equals_plain_kernel_machine(spark, docs, model):
    """Every token of every text by its dense feature vector, without bounds, parts or shared sums."""
    known = {}
    for r in toxicity.strongest(spark.read.parquet(f"{docs}/documents.parquet").where("length(text) < 2000 or text is null"), model).collect():
        known.setdefault(r.doc_id, []).append(r.value)
    dense = {}
    for d, t in rows_of(spark, docs):
        if t is None or len(t) < 2000:
            tokens = toxicity._words((t or "").encode())
            for w in tokens:
                if w not in dense:
                    dense[w] = float(toxicity.features(w) @ model.weights.astype(float))
            want = model.bias + max([0.0, *[dense[w] for w in tokens]])
            assert any(abs(v - want) < 1e-3 for v in known[d]), (d, t)


def test_long_texts_are_read_whole(model):
    text = "green house " * 200_000
    assert model.strongest(text + "idiot") == model.strongest("green house idiot")
    assert model.strongest("x" * 3_000_000) <= model.strongest("idiot")


def test_hard_rows(spark, docs, empty, tmp_path):
    labels = spark.createDataFrame([(k, k % 2, 1) for k in range(60)] + [(None, 1, 0), (3, None, 0)], "doc_id long, toxic int, quality int")
    for path, n in ((docs, None), (empty, 0)):
        df = spark.read.parquet(f"{path}/documents.parquet")
        for known in (labels, labels.limit(0)):
            rows = toxicity.score(df, known).collect()
            assert len(rows) == (df.count() if n is None else n)
            assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in rows)
