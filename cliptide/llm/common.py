"""Shared helpers: staged tables, stable salts and joins that survive one hot key."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Characters that separate words, as a Java and Python class body.
SPACE = r"\x20\x09-\x0D"
#: A key is hot when it holds more than this share of all rows; so at most 1 / HOT_SHARE keys are.
HOT_SHARE = 1 / 500
SALTS = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A new folder name below spark.checkpoint.dir, which driver and executors share.

    Where the setting is missing a local session (tests) gets a temporary folder; a cluster is refused, as a
    machine-local folder would be seen by one machine only.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        import tempfile

        root = spark.conf.get("spark.cliptide.localdir", None)
        if not root:
            root = "file://" + tempfile.mkdtemp(prefix="cliptide-")
            spark.conf.set("spark.cliptide.localdir", root)
    return f"{root.rstrip('/')}/cliptide-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str = "table") -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage is cut and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    _made.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


#: Paths of the staged tables, in order, as scratch() needs them.
_made: list[str] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[list[DataFrame]]:
    """Deletes the tables staged inside, but those put into the list it gives: they must not read the others any more."""
    at, kept = len(_made), []
    try:
        yield kept
    finally:
        stay = {df.staged_path for df in kept}
        for path in _made[at:]:
            if path not in stay:
                p = spark._jvm.org.apache.hadoop.fs.Path(path.rsplit("/", 1)[0])  # each table has a folder of its own
                p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
        _made[at:] = [p for p in _made[at:] if p in stay]


def salt(n: int, *cols: str | Column) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def hot_keys(counts: DataFrame, key: str, n: str) -> list:
    """Keys that hold more than HOT_SHARE of the rows that counts (key, n) describes: at most 1 / HOT_SHARE of them."""
    total = counts.agg(F.sum(n)).first()[0] or 0
    return [r[0] for r in counts.where(F.col(n) > max(total * HOT_SHARE, 64)).select(key).collect()]


def spread_join(big: DataFrame, small: DataFrame, key: str, hot: list, by: Column, how: str = "left") -> DataFrame:
    """big joined with small, whose key is unique; rows of hot keys are dealt over SALTS tasks by the column by."""
    if not hot:
        return big.join(small, key, how)
    is_hot = F.col(key).isin(hot)
    salts = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    left = big.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(by), F.lit(SALTS)).cast("int")).otherwise(F.lit(0)))
    return left.join(small.withColumn("_salt", F.explode(salts)), [key, "_salt"], how).drop("_salt")


def only(df: DataFrame, **types: str) -> DataFrame:
    """Just the named columns, by their exact names, cast; extra and clashing columns are left behind."""
    return df.select(*[named(c).cast(t).alias(c) for c, t in types.items()])


def named(column: str) -> Column:
    """The column of exactly that name, dots and back-ticks included."""
    return F.col("`" + column.replace("`", "``") + "`")
