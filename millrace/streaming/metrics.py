"""Running per-model request metrics over a stream of requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.routing import request_metrics
from millrace.sources.versions import publish, read_latest


def write_running_metrics(log: DataFrame, table_path: str, checkpoint: str, keep: int = 3, **trigger) -> StreamingQuery:
    """Keep the metrics of everything seen so far in `table_path`, read by `read_running_metrics`.

    State is one row per model. Each batch is a version of the table under its own number: readers see the last
    complete one at any time, also while a batch is written or has failed, and a batch that is retried changes
    nothing once it is there. The latest `keep` versions stay for readers that have begun.
    """
    return (
        request_metrics(log)
        .writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: publish(batch, table_path, batch_id, keep))
        .trigger(**(trigger or {"availableNow": True}))
        .start()
    )


def read_running_metrics(spark: SparkSession, table_path: str) -> DataFrame | None:
    """The metrics as of the last complete batch; None before the first."""
    return read_latest(spark, table_path)
