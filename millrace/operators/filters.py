"""Filters on units. The cheap ones run before the one that shuffles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.text import head_contains, line_count
from millrace.operators.extract import MARKER_WINDOW
from millrace.sources.files import path_order

# What marks a unit as machine-written.
UNIT_MARKERS = ("DO NOT EDIT", "Code generated", "go:generate")


def drop_generated_units(units: DataFrame) -> DataFrame:
    return units.where(~head_contains(F.col("body"), UNIT_MARKERS, MARKER_WINDOW))


def min_lines(units: DataFrame, n: int) -> DataFrame:
    return units.where(line_count(F.col("body")) >= n)


def min_file_lines(files: DataFrame, n: int = 20) -> DataFrame:
    """Files (`path`, `src`) of at least `n` lines; runs in the scan's stage, before anything is extracted."""
    return files.where(line_count(F.col("src")) >= n)


def input_order() -> list[Column]:
    """The order in which units are met: tree walk, then line."""
    return [path_order(F.col("file_path")), F.col("line_number")]


def exact_dedup(units: DataFrame, order: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first unit, in input order, of those with equal bodies.

    Filtering on rank 1 makes Spark keep one row per body and map task before the shuffle, so a body
    that fills a third of the input arrives as one row per task.
    """
    same_body = Window.partitionBy(F.sha2("body", 256)).orderBy(*(order or input_order()))
    return units.withColumn("_rank", F.row_number().over(same_body)).where("_rank = 1").drop("_rank")


def filter_all(units: DataFrame, n: int = 3, order: Sequence[Column] | None = None) -> DataFrame:
    """Generated, short, duplicate: in this order, so that the dedup shuffle sees the least rows."""
    return exact_dedup(min_lines(drop_generated_units(units), n), order)
