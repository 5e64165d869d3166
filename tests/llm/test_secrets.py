import hashlib
import random
import re
import string
import time
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from cliptide.llm import queries, secrets

from .conftest import rows_of

PATTERNS = [
    ("assign", re.compile(r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""), lambda m: len(m[2]) >= 6),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    ("hex", re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
]


def plain(text):
    found = [(m.start(), k, name, m.end()) for k, (name, p, good) in enumerate(PATTERNS) for m in p.finditer(text or "") if good(m)]
    said = ",".join(f"{name}:{s}:{e}" for s, _, name, e in sorted(found))
    return *(sum(x[2] == name for x in found) for name, _, _ in PATTERNS), hashlib.sha256(said.encode()).hexdigest(), said


def test_query_equals_brute_force(spark, docs, empty):
    for path in (docs, "/root/testdata/sf0.01"):
        rows = queries.op6_secrets(spark, path).collect()
        assert Counter(tuple(r)[:5] for r in rows) == Counter((d, *plain(t)[:4]) for d, t in rows_of(spark, path))
        want = {(d, *plain(t)[4].split(",")) for d, t in rows_of(spark, path)}
        for r in rows:
            base = [s for s in r.spans.split(",") if not s.startswith("markov")]
            assert (r.doc_id, *(base or [""])) in want
    assert queries.op6_secrets(spark, empty).count() == 0


def test_models_tell_random_strings_from_ordinary_tokens(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scan = secrets.Scanner(secrets.train(docs))
    assert np.mean([scan.secret(s) for s in secrets.random_strings(400, seed=99)]) > 0.97  # 16 characters or more, digits or not
    r = random.Random(4)
    assert np.mean([scan.secret("".join(r.choices(string.ascii_letters, k=20))) for _ in range(300)]) > 0.97
    ordinary = ["get_user_name_by_id_2", "therthinshshthtionst2", "2024-01-01-000000000", "1234567890123456", "version_10_of_the_house", "https-www-example-com-page-2", "________________1", "image_large_0001_final", "getUserNameFromSession", "MAX_RETRY_COUNT", "internationalization", "AbstractFactoryBean"]
    assert not any(scan.secret(s) for s in ordinary)


def test_clean_documents_have_no_model_spans(spark):
    rows = queries.op6_secrets(spark, "/root/testdata/sf0.01").where(F.col("spans").contains("markov")).count()
    assert rows < 10


def test_redact_keeps_rows_and_columns(spark, docs):
    df = spark.read.parquet(f"{docs}/documents.parquet")
    out = secrets.redact(df, secrets.train(df))
    assert out.schema == df.schema and out.count() == df.count()
    left = out.where(F.col("text").rlike("[0-9a-f]{24}|AKIA[A-Z0-9]{16}|hunter2")).count()
    assert left == 0
    assert out.where("text is null").count() == df.where("text is null").count()


def test_model_spans_equal_brute_force(spark, docs):
    table = spark.read.parquet(f"{docs}/documents.parquet")
    ratios = secrets.train(table)
    scan = secrets.Scanner(ratios)
    text = " ".join([*secrets.random_strings(60, seed=3), "token = 'abcdefgh1234'", "plain words here", "user_name_list"] * 2)
    base = secrets.base_spans(text)
    want = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{8,}", text):
        total, last = 0.0, secrets.START
        for c in m[0]:
            total, last = total + ratios[last, secrets._CODE[c]], secrets._CODE[c]
        if total >= max(secrets.MIN_RATIO, secrets.MIN_RATIO_PER_CHAR * len(m[0])) and all(m.end() <= s or e <= m.start() for s, _, e in base):
            want.append((m.start(), 3, m.end()))
    assert len(want) > 50 and scan.spans(text) == sorted(base + want)


def test_overlapping_spans_leave_the_rest_alone():
    text = "token = " + "0123456789abcdef" * 2 + " ordinary words follow here and there"
    spans = secrets.merged(secrets.base_spans(text))
    assert spans == [[0, 40]] and secrets.replaced(text, spans, "*") == "* ordinary words follow here and there"


def test_many_keys_in_one_text_take_linear_time():
    r = random.Random(2)
    text = " ".join("".join(r.choices("0123456789abcdef", k=32)) + " " + "".join(r.choices(string.ascii_letters, k=24)) for _ in range(100_000))
    began = time.time()
    spans = secrets.Scanner(np.full((secrets.START + 1, secrets.START + 1), 2.0)).spans(text)
    assert len(spans) == 200_000 and len(secrets.replaced(text, secrets.merged(spans), "")) == 199_999 and time.time() - began < 30
