"""Tables written part-way through a job, so that later stages survive lost executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SETTING = "spark.checkpoint.dir"
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that `spark.checkpoint.dir` names.

    Without the setting a temporary folder is used, on a local master only: on a cluster the executors
    would each write to a disk the others cannot read.
    """
    base = spark.conf.get(_SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {_SETTING} to a folder all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def made_paths(since: int = 0) -> list[str]:
    """Paths given out in this process so far, from number `since` on."""
    return _made[since:]


def remove_unread(spark: SparkSession, paths: list[str], readers: DataFrame) -> list[str]:
    """Delete scratch folders, but those that `readers` reads; gives the ones that stay."""
    read, kept = readers.inputFiles(), []
    for path in paths:
        if any(f"/{path.rsplit('/', 1)[1]}/" in f for f in read):
            kept.append(path)
        else:
            place, files = folder(spark, path)
            files.delete(place, True)
    return kept


def written_table(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once and read it back; later stages scan only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows of a table that may be broadcast; a larger one is joined by a shuffle.
_FEW = 200_000


def small_side(df: DataFrame, name: str) -> DataFrame:
    """Written and counted, so that the texts it meets stay where they are if it is as small as it should be."""
    written = written_table(df, name)
    return F.broadcast(written) if written.limit(_FEW + 1).count() <= _FEW else written


def folder(spark: SparkSession, path: str):
    """Hadoop path and file system of a folder, for listing, marking and renaming by the driver."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())
