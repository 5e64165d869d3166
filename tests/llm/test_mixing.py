import numpy as np
from pyspark.sql import functions as F

from cliptide.llm import mixing, queries

PATH = "/root/testdata/sf0.01"


def plain_fit(tokens, p, targets, least, most, rounds):
    a = (tokens[:, None] * p).T
    gram = a @ a.T
    inverse = np.linalg.pinv(gram + np.eye(len(targets)) * gram.trace() * 1e-12)
    r = np.full(len(tokens), min(max(1.0, least), most))
    for _ in range(rounds):
        residual = a @ r - targets
        if np.abs(residual).max() <= mixing.TOLERANCE * np.abs(targets).max():
            break
        r = np.clip(r - a.T @ (inverse @ residual), least, most)
    return r


def members(spark, n=400, seed=3):
    r = np.random.default_rng(seed)
    tokens = r.integers(0, 2000, n).astype(float)
    p = r.dirichlet([0.1, 0.1, 0.1], n)
    rows = [(k, float(t), [float(x) for x in q]) for k, (t, q) in enumerate(zip(tokens, p))]
    return spark.createDataFrame(rows, "doc_id long, tokens double, p array<double>"), tokens, p


def test_fit_equals_numpy(spark):
    df, tokens, p = members(spark)
    have = (tokens[:, None] * p).sum(0)
    for share, least, most in (([0.2, 0.3, 0.5], 0.0, 100.0), ([0.02, 0.08, 0.9], 0.0, 3.0), ([0.5, 0.3, 0.2], 1.0, 1.2)):
        targets = np.array(share) * have.sum()
        steps = mixing.fit(df, targets, least, most, rounds=25)
        got = {r.doc_id: r.rate for r in df.withColumn("rate", mixing.rate(steps, least, most)).collect()}
        want = plain_fit(tokens, p, targets, least, most, 25)
        assert np.allclose([got[k] for k in range(len(tokens))], want, rtol=1e-6, atol=1e-9)
        assert (want >= least).all() and (want <= most).all()


def test_query_meets_its_targets(spark):
    rows = queries.op2_mixing(spark, PATH).toPandas()
    assert len(rows) == spark.read.parquet(f"{PATH}/documents.parquet").count()
    domains = list(queries.TARGETS)
    p = rows[[f"p_{d}" for d in domains]].to_numpy()
    assert np.allclose(p.sum(1), 1) and (rows.rate >= 0).all()
    got = (rows.rate.to_numpy() * rows.tokens.to_numpy()) @ p
    want = np.array([queries.TARGETS[d] for d in domains]) * rows.tokens.sum()
    assert np.abs(got / want - 1).max() < 1e-4
    lang = dict(spark.read.parquet(f"{PATH}/documents.parquet").select("doc_id", "lang").collect())
    assert np.mean([domains[k] == lang[d] for d, k in zip(rows.doc_id, p.argmax(1))]) > 0.97


def test_keep_all_thins_nothing(spark):
    docs = spark.read.parquet(f"{PATH}/documents.parquet")
    labelled = mixing.labelled_documents(docs, spark.read.parquet(f"{PATH}/labels.parquet"), "lang")
    rows = mixing.mix(docs, labelled, {"en": 0.6, "de": 0.2, "fr": 0.2}, most=4, keep_all=True)
    low, high = rows.agg(F.min("rate"), F.max("rate")).first()
    assert 1 <= low and high <= 4


def test_copies_average_to_the_rate(spark):
    rows = spark.range(20_000).select("id", F.lit(1.3).alias("rate"))
    c = rows.select(mixing.copies(F.col("rate"), "id").alias("c"))
    assert c.agg(F.min("c"), F.max("c")).first()[:] == (1, 2)
    assert abs(c.agg(F.avg("c")).first()[0] - 1.3) < 0.02


def test_hard_rows(spark, docs, empty):
    labels = spark.createDataFrame([(k,) for k in range(100)] + [(None,)], "doc_id long")
    for path in (docs, empty):
        df = spark.read.parquet(f"{path}/documents.parquet")
        for known in (labels, labels.limit(0)):
            rows = mixing.mix(df, mixing.labelled_documents(df, known, "lang"), {"en": 1.0, "de": 1.0}).collect()
            assert len(rows) == df.count()
            assert all(r.rate >= 0 and np.isfinite(r.rate) and abs(sum(r.p) - 1) < 1e-9 for r in rows)
