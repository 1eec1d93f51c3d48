"""An extension: folding a stream of decisions into the current state."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagloom.operators import store


def fold_decisions(stream: DataFrame, path: str, checkpoint: str, scope: str = "brand") -> StreamingQuery:
    """Keeps the latest row of each key of a scope (revoked ones included) in versions below `path`.

    A version is written beside the older ones, so a lost executor or a repeated micro-batch leaves no half state.
    """
    keys = ["rule_key"] if scope == "brand" else ["site", "rule_key"]

    def fold(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        rows = batch.where(F.col("scope") == scope)
        if epoch:
            rows = rows.unionByName(spark.read.parquet(f"{path}/version={epoch - 1}"))
        rest = [c for c in rows.columns if c not in keys]
        state = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "log_id").alias("r")).select(*keys, "r.*")
        state.write.mode("overwrite").parquet(f"{path}/version={epoch}")

    return stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).start()


def current_state(versions: DataFrame) -> DataFrame:
    return store.latest(versions, "brand")
