"""A small table that is replaced again and again, as numbered versions.

Layout: `batch=<number>` folders of Parquet files, and `_complete/<number>` marks. A version counts once its mark is
there. Marks are created, never changed, so nothing depends on renames or on overwriting what is being read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.sources.scratch import folder


def _child(spark: SparkSession, path: str, *names: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join([path.rstrip("/"), *names]))


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete versions, ascending."""
    marks, files = folder(spark, f"{path.rstrip('/')}/_complete")
    if not files.exists(marks):
        return []
    names = [s.getPath().getName() for s in files.listStatus(marks)]
    return sorted(int(n) for n in names if n.isdigit())


def publish(rows: DataFrame, path: str, number: int, keep: int = 3) -> bool:
    """Write version `number`; false, and nothing is written, if it or a later one is complete.

    What a failed attempt left of the version is replaced. Of older versions all but the latest `keep - 1` go.
    """
    spark = rows.sparkSession
    before = versions(spark, path)
    if before and before[-1] >= number:
        return False
    rows.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")
    _, files = folder(spark, path)
    files.create(_child(spark, path, "_complete", str(number)), False).close()
    for old in before[: max(0, len(before) - max(keep, 1) + 1)]:
        # The mark first: a version without its mark is never read.
        files.delete(_child(spark, path, "_complete", str(old)), False)
        files.delete(_child(spark, path, f"batch={old}"), True)
    return True


def read_latest(spark: SparkSession, path: str) -> DataFrame | None:
    """The latest complete version; None if there is none."""
    complete = versions(spark, path)
    return spark.read.parquet(f"{path.rstrip('/')}/batch={complete[-1]}") if complete else None
