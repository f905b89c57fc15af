"""Content-addressed blobs: files named by the SHA-256 of their content."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


#: SHA-256 of nothing.
EMPTY = hashlib.sha256(b"").hexdigest()


def read_blobs(spark: SparkSession, folder: str) -> DataFrame:
    """(source_sha256, content, size); a file whose name isn't its hash is an error."""
    b = spark.read.format("binaryFile").load(folder)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    good = F.assert_true(name == F.sha2("content", 256), F.concat(F.lit("wrong content: "), name))
    out = b.select(name.alias("source_sha256"), "content", F.col("length").alias("size"), good.isNull().alias("_ok")).where("_ok").drop("_ok")
    # Spark reads no splits of an empty file, so the empty blob is looked for by name
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, EMPTY)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        out = out.union(spark.createDataFrame([(EMPTY, bytearray(), 0)], "source_sha256 string, content binary, size bigint"))
    return out


def attach(resources: DataFrame, blobs: DataFrame) -> DataFrame:
    """resources with their content; sizes must agree."""
    b = blobs.select("source_sha256", "content", F.col("size").alias("_size"))
    return resources.join(b, "source_sha256", "left").withColumn("content", F.when(F.col("size") == F.col("_size"), F.col("content"))).drop("_size")


def distinct_blobs(contents: DataFrame) -> DataFrame:
    """(source_sha256, size, content), one row a blob: contents are hashed where they are, and only one of each is kept."""
    hashed = contents.select(F.sha2("content", 256).alias("source_sha256"), F.length("content").cast("bigint").alias("size"), "content")
    return hashed.dropDuplicates(["source_sha256"])


def count_bytes(resources: DataFrame) -> DataFrame:
    """unique_blobs and unique_bytes."""
    return resources.groupBy("source_sha256").agg(F.max("size").alias("size")).agg(F.count(F.lit(1)).alias("unique_blobs"), F.coalesce(F.sum("size"), F.lit(0)).cast("bigint").alias("unique_bytes"))
