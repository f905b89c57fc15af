"""The queue's operators on streams: pairs validated as they arrive, and imports that are safe to repeat.

Nothing here is event-time: the engine's own queue has no watermark, window or late data, only one batch in flight.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.functions import validation as V
from tessella.operators.queue import upsert


def validated(pairs: DataFrame, glossary: dict | None = None) -> DataFrame:
    """A stream (or table) of id, source, target with findings and status."""
    found = pairs.withColumn("findings", V.findings(F.col("source"), F.col("target"), glossary))
    return found.withColumn("status", V.status(F.col("source"), F.col("target"), F.col("findings")))


def import_into(path: str, checkpoint: str, stream: DataFrame):
    """Replaces the units at `path` (Parquet generations) batch by batch. A batch id that was applied is passed over, so a
    restart after a crash applies each batch once. Of rows that repeat an id in a batch the greatest counts. Without a
    generation there are no units to replace, and an empty one is made."""
    from tessella.plans.publish import Versions

    versions = Versions(path)

    def apply(batch: DataFrame, batch_id: int) -> None:
        now = versions.current()
        if now and (now / "batch_id").exists() and int((now / "batch_id").read_text()) >= batch_id:
            return
        spark = batch.sparkSession
        units = spark.read.parquet(str(now / "units")) if now else spark.createDataFrame([], batch.schema)
        one = batch.select(*units.columns).groupBy(F.col("id").alias("_of")).agg(F.max(F.struct(*units.columns)).alias("_row")).select("_row.*")
        versions.publish({"units": upsert(units, one)}, {"batch_id": str(batch_id).encode()})

    return stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
