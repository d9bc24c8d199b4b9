"""JSON Lines sinks and source for examples."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.draws import DRAW_RANGE
from millrace.operators.formats import EXAMPLE_COLUMNS, EXAMPLE_SCHEMA
from millrace.sources.scratch import folder

SPLITS = ("eval", "train")


def _without_empty_fields(examples: DataFrame, *extra: str) -> DataFrame:
    # The JSON writer leaves out nulls.
    fields = [F.nullif(F.col(c), F.lit("")).alias(c) for c in EXAMPLE_COLUMNS]
    return examples.select(*fields, *extra)


def write_jsonl(examples: DataFrame, path: str) -> None:
    """One JSON object per line, empty fields omitted; a folder of part files."""
    _without_empty_fields(examples).write.json(path)


def write_splits(examples: DataFrame, path: str, order: Sequence[str], mode: str = "errorifexists") -> None:
    """Write `split=eval` and `split=train` folders in one job, rows in `order` across the part files of a folder.

    `order` begins with a uniform draw from [0, 2^32): its range is dealt into equal parts, so nothing is sampled
    and `examples` are computed once. The output appears as a whole: it is written beside `path` and renamed
    at the end, also with both folders where a split has no rows. A write that dies leaves `path` as it was.
    """
    if mode not in ("errorifexists", "overwrite"):
        raise ValueError(f"mode {mode!r}")
    spark = examples.sparkSession
    if mode == "errorifexists" and folder_exists(spark, path):
        raise FileExistsError(path)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    part = F.floor(F.col(order[0]) * F.lit(n) / F.lit(float(DRAW_RANGE))).cast("int")
    ordered = examples.repartitionById(n, part).sortWithinPartitions("split", *order)
    beside = f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    _without_empty_fields(ordered, "split").write.partitionBy("split").json(f"{beside}-new")
    _, files = folder(spark, path)
    for split in SPLITS:
        files.mkdirs(folder(spark, f"{beside}-new/split={split}")[0])
    if mode == "overwrite" and folder_exists(spark, path):
        _renamed(spark, path, f"{beside}-old")
    _renamed(spark, f"{beside}-new", path)
    files.delete(folder(spark, f"{beside}-old")[0], True)


def _renamed(spark: SparkSession, source: str, target: str) -> None:
    place, files = folder(spark, target)
    # A rename onto a folder that has come up meanwhile would move into it.
    if files.exists(place) or not files.rename(folder(spark, source)[0], place):
        raise FileExistsError(target)


def folder_exists(spark: SparkSession, path: str) -> bool:
    place, files = folder(spark, path)
    return files.exists(place)


def read_jsonl(spark: SparkSession, path: str) -> DataFrame:
    """Read examples; blank lines are skipped, a malformed line raises."""
    return spark.read.schema(EXAMPLE_SCHEMA).option("mode", "FAILFAST").json(path)


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """One split of what `write_splits` wrote; empty where that split has no rows."""
    reader = spark.read.schema(f"{EXAMPLE_SCHEMA}, split STRING").option("mode", "FAILFAST")
    return reader.json(path).where(F.col("split") == split).drop("split")
