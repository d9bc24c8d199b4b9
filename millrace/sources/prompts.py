"""Evaluation prompts from prompt files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PROMPT_FILE_SCHEMA = (
    "category STRING, weight DOUBLE, "
    "prompts ARRAY<STRUCT<id: STRING, category: STRING, description: STRING, prompt: STRING, weight: DOUBLE>>"
)


def read_prompt_files(spark: SparkSession, path: str) -> DataFrame:
    """Prompt files as JSON documents, one per file, with their `file` path."""
    reader = spark.read.schema(PROMPT_FILE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST")
    return reader.json(path).withColumn("file", F.col("_metadata.file_path"))


def load_prompts(files: DataFrame) -> DataFrame:
    """One row per prompt; the file's category always wins, its weight where the prompt has none."""
    each = files.select("file", "category", "weight", F.posexplode("prompts").alias("position", "p"))
    own = F.coalesce("p.weight", F.lit(0.0))
    return each.select(
        "file",
        F.col("position").cast("bigint").alias("position"),
        F.coalesce("p.id", F.lit("")).alias("id"),
        "category",
        F.coalesce("p.description", F.lit("")).alias("description"),
        F.coalesce("p.prompt", F.lit("")).alias("prompt"),
        F.when(own == 0, F.coalesce("weight", F.lit(0.0))).otherwise(own).alias("weight"),
    )
