"""What the corpus operators share: lineage cuts, skew-proof lookups, text primitives."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of the text contracts: blank and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A word of the text contracts, as a Java regular expression.
WORD = r"[^\x20\x09-\x0D]+"
#: Keys that `lookup` resolves by broadcast. A key that isn't among the K most frequent holds at most 1/K of the rows.
HOT_KEYS = 1024


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir, which all executors see. Where that is unset, a temporary one serves a local
    master; a cluster, whose executors wouldn't see it, is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and sc.master.split("[")[0] != "local":
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors see")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tessella-checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage by a checkpoint, for narrow tables; Spark clears it when it's out of use."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """Cut the lineage by a Parquet table in the shared folder, for wide tables; it stays until that folder is cleared."""
    path = f"{shared_dir(df.sparkSession)}/tables/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def ascii_lower(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def lookup(rows: DataFrame, keyed: DataFrame, key: str, weight: str, spread: Column) -> DataFrame:
    """Left-join `rows` to `keyed` (one row a key, already cut) on `key`, whatever the skew.

    The HOT_KEYS keys of the largest `weight` (how many rows hold them) are broadcast: a fixed number of rows.
    Rows of such a key skip the shuffle join: they get a salt from `spread` that no row of `keyed` has, so they are dealt
    out evenly. No other key can hold more than 1/HOT_KEYS of the rows.
    """
    values = [c for c in keyed.columns if c != key]
    hot = keyed.orderBy(F.desc(weight), F.col(key)).limit(HOT_KEYS).select(F.col(key), F.struct(*values).alias("_hot"))
    marked = rows.join(F.broadcast(hot), key, "left").withColumn("_salt", F.when(F.col("_hot").isNull(), F.lit(0)).otherwise(1 + F.pmod(spread, F.lit(4096))).cast("int"))
    cold = keyed.select(F.col(key), F.struct(*values).alias("_cold"), F.lit(0).alias("_salt"))
    joined = marked.join(cold, [key, "_salt"], "left")
    found = F.coalesce(F.col("_hot"), F.col("_cold"))
    return joined.select(*rows.columns, *(found[v].alias(v) for v in values))
