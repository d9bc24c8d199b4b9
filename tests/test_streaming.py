"""The table that a stream keeps, read while it changes."""

import os

import pytest

from millrace.sources.versions import publish, read_latest, versions
from millrace.streaming.metrics import read_running_metrics, write_running_metrics

SCHEMA = "model string, latency_ms double, is_err boolean"


def metrics(spark, table):
    return sorted((r.model, r.requests, r.errors) for r in read_running_metrics(spark, table).collect())


def test_readers_see_complete_batches(spark, fresh_dir):
    source, table, checkpoint = (f"{fresh_dir}/{n}" for n in ("in", "out", "checkpoint"))

    def arrive(rows):
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(source)
        log = spark.readStream.schema(SCHEMA).parquet(source)
        write_running_metrics(log, table, checkpoint).awaitTermination()

    assert read_running_metrics(spark, table) is None
    arrive([("a", 1.0, False), ("a", 2.0, True)])
    assert metrics(spark, table) == [("a", 2, 1)]
    begun = read_running_metrics(spark, table)
    arrive([("b", 1.0, False)])
    assert metrics(spark, table) == [("a", 2, 1), ("b", 1, 0)]
    # A reader that began before goes on with its version.
    assert begun.count() == 1
    for k in range(4):
        arrive([("c", 1.0, k % 2 == 0)])
    assert metrics(spark, table)[-1] == ("c", 4, 2)
    assert len(versions(spark, table)) == 3 and len([n for n in os.listdir(table) if n.startswith("batch=")]) == 3


def test_repeated_and_failed_batches(spark, fresh_dir):
    table = f"{fresh_dir}/t"
    one, two = spark.range(1), spark.range(2)
    assert publish(one, table, 0) and not publish(two, table, 0) and read_latest(spark, table).count() == 1
    # A batch that died while it was written has no mark: the version before it is read, and the retry replaces it.
    two.write.parquet(f"{table}/batch=1")
    assert read_latest(spark, table).count() == 1
    with pytest.raises(Exception):
        publish(two.selectExpr("assert_true(id < 1)", "id"), table, 1)
    assert read_latest(spark, table).count() == 1
    assert publish(spark.range(3), table, 1) and read_latest(spark, table).count() == 3
    assert not publish(two, table, 0) and versions(spark, table) == [0, 1]
