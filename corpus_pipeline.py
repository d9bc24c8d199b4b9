"""The corpus pipeline: documents in, encoded training blocks out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's `docs`. All but the last return the columns of `documents`:

1. `quality_rules`: documents that fail the base rules, or whose host fails as a whole, go.
2. `near_dedup`: of each group of near copies the document with the smallest id stays.
3. `private_surrogates`: personal data and secrets are replaced; `n_chars` is counted anew.
4. `source_mix`: blocks drawn to the target weights become the documents; ids are slot numbers.
5. `piece_encoding`: blocks become piece ids.

A stage's result is written before the next stage is called: what a stage needed in the scratch folder is removed when a later
one begins on documents that do not read it.

Defined results of the odd cases (NULLs, empty texts, repeated rows, empty tables) are those of the operators.
"""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from millrace.llm.mix import mixed_documents
from millrace.llm.near import near_filter
from millrace.llm.pieces import Pieces, encoded
from millrace.llm.private import private_filter
from millrace.llm.quality import quality_filter
from millrace.llm.queries import PIECE_MODEL
from millrace.llm.words import table
from millrace.sources.scratch import made_paths, remove_unread, written_table

#: The key of the surrogates: a secret of whoever runs the pipeline.
SURROGATE_KEY = os.environ.get("SURROGATE_KEY", "corpus")

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_filter(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_filter(docs)


def private_surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return private_filter(docs, SURROGATE_KEY)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs)


def piece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return encoded(docs, Pieces.read(PIECE_MODEL))


_left: dict[int, list[str]] = {}


def _tidy(number: int, stage: Stage) -> Stage:
    """The stage, after it has removed what earlier stages left."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        for earlier in [k for k in _left if k < number]:
            _left[earlier] = remove_unread(spark, _left[earlier], docs)
        before = len(made_paths())
        result = stage(spark, docs, sf_dir)
        _left.setdefault(number, []).extend(made_paths(before))
        return result

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    (stage.__name__, _tidy(k, stage))
    for k, stage in enumerate((quality_rules, near_dedup, private_surrogates, source_mix, piece_encoding))
]

#: The stages hash, draw and fold beyond what SQL expresses; tests compare them with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, written = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES[:-1]:
        before = len(made_paths())
        result = stage(spark, docs, sf_dir)
        docs = written_table(result, f"pipeline-{name}")
        written = remove_unread(spark, written, docs) + [p for p in made_paths(before) if f"/pipeline-{name}-" in p]
    return STAGES[-1][1](spark, docs, sf_dir)
