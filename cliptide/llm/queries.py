"""One thin query per operator: the operator over its whole table, then the digest columns of its contract."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import extraction, media, mixing, packing, quality, secrets, sharding, simhash, toxicity, warc
from .common import table


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives, folder = warc.archive(table(spark, sf_dir, "pages"))
    return warc.read_archives(archives, folder).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


#: Target shares of expected tokens by language.
TARGETS = {"de": 0.25, "en": 0.4, "es": 0.15, "fr": 0.2}


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rows = mixing.mix(docs, mixing.labelled_documents(docs, table(spark, sf_dir, "labels"), "lang"), TARGETS)
    return rows.select("doc_id", "tokens", *[F.get("p", k).alias(f"p_{d}") for k, d in enumerate(TARGETS)], "rate")


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op5_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.media_columns(table(spark, sf_dir, "documents"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.train(docs))
    of = lambda *kinds: F.filter("secrets", lambda s: s["kind"].isin(*kinds))
    count = lambda kind: F.size(of(kind)).cast("long")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(secrets.span_text(of("assign", "access", "hex")), 256).alias("base_sha256"),
        secrets.span_text(F.col("secrets")).alias("spans"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    v1, v2 = quality.POLICIES
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~quality.kept(v1)).alias("base_failed"), quality.kept(v2).alias("kept"), "failure_bits")


def op8_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.extract(table(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_warc, op2_mixing, op3_sharding, op4_simhash, op5_media, op6_secrets, op7_quality, op8_extraction, op9_toxicity, op10_packing)}
#: SQL for the queries that it can express whole; the others hash, train, iterate or write files.
ORACLE_SQL: dict[str, str] = {
    "op1_warc": """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS h FROM pages),
     f AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS low FROM p),
     g AS (SELECT *, CASE WHEN strlen(h) >= 100 AND page_id > low THEN low END AS refers_to FROM f)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha256(h) AS payload_digest,
       CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url
FROM g""",
    "op7_quality": r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
     w AS (SELECT *, list_filter(string_split_regex(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws,
                  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
     u AS (SELECT rid, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
     v AS (SELECT rid, i, word, lag(word) OVER q AS before,
                  word || ' ' || lead(word, 1) OVER q || ' ' || lead(word, 2) OVER q || ' ' || lead(word, 3) OVER q || ' ' || lead(word, 4) OVER q AS win
           FROM u WINDOW q AS (PARTITION BY rid ORDER BY i)),
     c AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, win) AS n FROM v WHERE win IS NOT NULL),
     k AS (SELECT DISTINCT rid, i + k AS j FROM c, generate_series(0, 4) AS g(k) WHERE n > 1),
     rep AS (SELECT rid, count(*) AS n FROM k GROUP BY 1),
     st AS (SELECT rid, count(*) AS n FROM v WHERE word = before GROUP BY 1),
     m AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
                  CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
                  CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines, len(ls) AS n_lines,
                  coalesce(rep.n, 0) AS n_repeat_words, coalesce(st.n, 0) AS n_stutter,
                  len(list_filter(ws, lambda x: regexp_matches(x, '^\p{Lu}{2,}[^\p{Ll}]*!!'))) AS n_shouted
           FROM w LEFT JOIN rep USING (rid) LEFT JOIN st USING (rid)),
     b AS (SELECT *, CAST((n_words < 10)::INT + 2 * (100 * n_repeat_words > 20 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
                     + 8 * (100 * n_dup_lines > 50 * n_lines)::INT + 16 * (2 * n_shouted > n_words)::INT
                     + 32 * (word_chars < 2 * n_words OR word_chars > 25 * n_words)::INT + 64 * (100 * n_stutter > 30 * n_words)::INT AS BIGINT) AS failure_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failure_bits & 3) <> 0 AS base_failed, failure_bits = 0 AS kept, failure_bits FROM b""",
}
