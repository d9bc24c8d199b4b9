"""What several operators share: words of a text, table reading, size-checked broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.let import bind

WHITE = " \t\n\x0b\x0c\r"
WHITE_RUN = r"[\x20\x09-\x0D]+"

#: Rows of a table that may be broadcast; larger ones are joined by a shuffle.
BROADCAST_ROWS = 200_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Runs of characters other than ASCII white space; none for NULL."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE))
    empty = F.array().cast("array<string>")
    return bind(trimmed, lambda t: F.when(t == "", empty).otherwise(F.split(t, WHITE_RUN, -1)))


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a narrow table for broadcast if it has at most `rows` rows; else leave the join to a shuffle.

    Counts the table, so it should be a written one.
    """
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
