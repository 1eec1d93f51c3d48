"""Session helpers."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage with a checkpoint in the folder that spark.checkpoint.dir names; a temporary one only where it is unset and Spark runs in one process."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and sc.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="checkpoints-"))
    return df.checkpoint(eager=True)
