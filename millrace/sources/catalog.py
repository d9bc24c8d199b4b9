"""The source catalog: repositories and articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REPO_SCHEMA = "url STRING, dir STRING, path STRING, weight DOUBLE"
ARTICLE_SCHEMA = "url STRING, path STRING, type STRING"


def read_sources(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Repositories and articles of catalog files (JSON documents); unknown keys are ignored."""
    schema = f"repos ARRAY<STRUCT<{REPO_SCHEMA}>>, articles ARRAY<STRUCT<{ARTICLE_SCHEMA}>>"
    files = spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)
    return files.select(F.inline("repos")).fillna("").fillna(0.0), files.select(F.inline("articles")).fillna("")


def source_catalog(repos: DataFrame) -> DataFrame:
    """Add `is_local` (a `dir` is given) and `effective_weight` (0 or absent reads as 1)."""
    weight = F.coalesce("weight", F.lit(0.0))
    return repos.withColumns(
        {
            "is_local": F.coalesce("dir", F.lit("")) != "",
            "effective_weight": F.when(weight == 0, F.lit(1.0)).otherwise(weight),
        }
    )
