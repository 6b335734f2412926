"""Incremental harvest: snapshots arrive as files, the latest state per item is kept."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from dishframe.operators.dedupe import latest_wins


def accumulate(
    spark: SparkSession, incoming: str, schema: str, keys: Sequence[str], order: Sequence[str], target: str, checkpoint: str
) -> None:
    """Fold every waiting file into the table at `target`, each batch as one new version folder.

    A batch that is run again rewrites its own version from the one before, so a restart
    neither loses nor doubles a snapshot. `checkpoint` is the stream's own folder beside the target:
    both must be where a restarted driver finds them.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        previous = f"{target}/version={batch_id - 1}"
        seen = batch if batch_id == 0 else batch.unionByName(spark.read.schema(batch.schema).json(previous))
        latest_wins(seen, keys, order).write.mode("overwrite").json(f"{target}/version={batch_id}")

    query = (
        spark.readStream.schema(schema)
        .json(incoming)
        .writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
