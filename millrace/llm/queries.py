"""The registered queries of the corpus operators, over whole tables with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import fingerprints, leaks, licences, mix, near, pieces, private, quality, repairs, repeats, toxicity, urls, whitening
from millrace.llm.words import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f

#: A public SentencePiece model; its path is a parameter, the file is not part of the library.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")

#: The key of the surrogates: a secret of whoever runs the query.
SURROGATE_KEY = os.environ.get("SURROGATE_KEY", "corpus")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


@query
def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_components(table(spark, sf_dir, "documents"))


@query
def op7_private_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), SURROGATE_KEY)


#: `host/path` rules of the URL query.
URL_RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)


@query
def op9_url_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(URL_RULES), "rule string, verdict string")
    return urls.url_verdicts(table(spark, sf_dir, "pages"), rules)


@query
def op10_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.taken_words(table(spark, sf_dir, "documents"))


@query
def op4_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents"))


@query
def op6_phrase_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.neighbours_compared(table(spark, sf_dir, "documents"))


@query
def op8_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences.licence_scan(table(spark, sf_dir, "documents"))
    lines = F.array_join(F.transform("found", lambda x: F.concat_ws(":", x["line"].cast("string"), x["licence"])), ",")
    return found.select("doc_id", "n_found", "licence", lines.alias("lines"), F.get("found", F.lit(0))["dice"].alias("dice"))


@query
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(toxicity.training_rows(docs, table(spark, sf_dir, "labels")))
    return toxicity.scored(docs, model)


@query
def op3_piece_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(table(spark, sf_dir, "documents"), pieces.Pieces.read(PIECE_MODEL))


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repairs.repair_digests(repairs.damaged(table(spark, sf_dir, "conversations")))


@query
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query
def op13_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.leak_digests(leaks.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
