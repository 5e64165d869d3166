"""JSON-lines tables, JSON documents and episode folders."""

from __future__ import annotations

import json

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path (glob allowed) names anything, asked of the store that holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return found is not None and len(found) > 0


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Rows of a JSON-lines file; a missing file is empty, blank lines are skipped, a malformed line raises."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_document(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", True)
    return (reader.schema(schema) if schema else reader).json(path)


def read_value(spark: SparkSession, path: str) -> dict:
    """A small JSON document as a Python value; a missing one raises."""
    try:
        return json.loads(spark.read.text(path, wholetext=True).first()[0])
    except AnalysisException as error:
        raise FileNotFoundError(path) from error


def write_jsonl(df: DataFrame, path: str) -> int:
    """Writes df as one JSON-lines part, atomically by the output committer; returns the rows written."""
    df.coalesce(1).write.mode("overwrite").json(path)
    return df.sparkSession.read.text(path).count()


def write_document(spark: SparkSession, value: dict, path: str) -> None:
    """A pretty JSON document of a driver-side value."""
    fs = spark._jvm.org.apache.hadoop.fs
    p = fs.Path(path)
    out = p.getFileSystem(spark._jsc.hadoopConfiguration()).create(p, True)
    out.write((json.dumps(value, indent=2, ensure_ascii=False) + "\n").encode())
    out.close()


def episodes(spark: SparkSession, root: str) -> DataFrame:
    """episode_dir, episode_id and document of every */metadata.json; the id falls back to the folder's name."""
    glob = f"{root}/*/metadata.json"
    if not exists(spark, glob):
        return spark.createDataFrame([], "episode_dir string, episode_id string, document string")
    rows = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("p"), F.col("value").alias("document"))
    folder = F.regexp_replace("p", "/metadata\\.json$", "")
    found = F.expr("try_variant_get(try_parse_json(document), '$.episode_id', 'string')")
    name = F.expr("url_decode(element_at(split(p, '/'), -2))")
    return rows.select(folder.alias("episode_dir"), F.coalesce(F.nullif(found, F.lit("")), name).alias("episode_id"), "document").orderBy("episode_dir")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def require_unique(df: DataFrame, key: str) -> None:
    bad = [str(r[0]) for r in duplicates(df, key).orderBy(key).limit(20).collect()]
    if bad:
        raise ValueError(f"duplicate {key}: {', '.join(bad)}")
