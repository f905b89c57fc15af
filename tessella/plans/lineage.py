"""Cutting a plan's lineage at a table in the shared folder."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def cut(df: DataFrame) -> DataFrame:
    """df from a checkpoint in spark.checkpoint.dir. Where that is unset, a temporary folder serves a local master; a cluster,
    whose executors wouldn't see it, is an error."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        folder = sc.getConf().get("spark.checkpoint.dir")
        if not folder and not sc.master.split("[")[0] == "local":
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors see")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="tessella-checkpoint-"))
    return df.checkpoint(eager=True)
