"""Scores, judge answers, chat answers, run summaries and the comparison of two runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsontext import parse_whole

# Score weights, the margin of a verdict, and the judged criteria.
COMPILES_SCORE = 0.4
VET_SCORE = 0.3
MARGIN = 0.05
CRITERIA = ("correctness", "idiom", "simplicity", "completeness")


def score_results(results: DataFrame) -> DataFrame:
    """Add `score` from the `compiles` and `vet_clean` flags."""
    score = F.when(F.col("compiles"), F.lit(COMPILES_SCORE)).otherwise(F.lit(0.0)) + F.when(
        F.col("vet_clean"), F.lit(VET_SCORE)
    ).otherwise(F.lit(0.0))
    return results.withColumn("score", score)


def _rate(flag: str) -> Column:
    return F.avg(F.coalesce(F.col(flag), F.lit(False)).cast("int"))


def eval_summary(results: DataFrame, *by: str) -> DataFrame:
    """Totals and rates of scored results, overall or per `by` columns."""
    return results.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_prompts"),
        F.avg("score").alias("avg_score"),
        _rate("compiles").alias("compile_rate"),
        _rate("vet_clean").alias("vet_rate"),
    )


def eval_compare(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """One verdict per candidate row (`prompt_id`, `score`, `position`) whose prompt the baseline has.

    Of repeated baseline prompts the last one, by `position`, counts. Sorting a verdict's rows by
    `position` gives its list in candidate order.
    """
    base = baseline.groupBy("prompt_id").agg(F.max_by("score", "position").alias("baseline_score"))
    joined = candidate.select("prompt_id", "position", "score").join(base, "prompt_id")
    verdict = (
        F.when(F.col("score") > F.col("baseline_score") + MARGIN, "improved")
        .when(F.col("score") < F.col("baseline_score") - MARGIN, "regressed")
        .otherwise("unchanged")
    )
    return joined.withColumn("verdict", verdict)


def compare_summary(baseline: DataFrame, candidate: DataFrame) -> DataFrame:
    """One row: score delta of the two runs and the number of prompts per verdict."""
    verdicts = eval_compare(baseline, candidate).agg(
        *[F.count_if(F.col("verdict") == v).alias(v) for v in ("improved", "regressed", "unchanged")]
    )
    delta = candidate.agg(F.avg("score")).scalar() - baseline.agg(F.avg("score")).scalar()
    return verdicts.select(delta.alias("score_delta"), "improved", "regressed", "unchanged")


def weighted_score(results: DataFrame, weights: DataFrame) -> DataFrame:
    """One row: mean score of each category, averaged by the `weight` of the category.

    Weights are scaled to the categories that have results; categories without a weight do not count.
    """
    means = results.groupBy("category").agg(F.avg("score").alias("mean"))
    weighed = means.join(weights.select("category", "weight"), "category")
    return weighed.agg(
        F.count(F.lit(1)).alias("categories"), (F.sum(F.col("weight") * F.col("mean")) / F.sum("weight")).alias("weighted_score")
    )


def judge_agreement(results: DataFrame, *by: str) -> DataFrame:
    """Correlation of the automated `score` with `judge_avg`, overall or per `by` columns."""
    return results.groupBy(*by).agg(F.count(F.lit(1)).alias("judged"), F.corr("score", "judge_avg").alias("agreement"))


def parse_judge(responses: DataFrame) -> DataFrame:
    """Add the four criteria and `ok` from the judge's JSON in `response`.

    Absent or null criteria are 0; any other text than one JSON object with integers is not ok. Key
    case does not matter, and the value `null` is ok.
    """
    text = F.col("response")
    for name in CRITERIA:
        text = F.regexp_replace(text, rf'(?i)"{name}"(\s*:)', f'"{name}"$1')
    parsed = responses.withColumn("_p", parse_whole(text, ", ".join(f"{c} BIGINT" for c in CRITERIA)))
    ok = F.coalesce(F.col("_p.ok"), F.lit(False))
    scores = {
        c: F.when(ok, F.coalesce(F.col(f"_p.value.{c}"), F.lit(0).cast("bigint"))) for c in CRITERIA
    }
    return parsed.withColumns({**scores, "ok": ok}).drop("_p")


def judge_average(scores: DataFrame) -> DataFrame:
    """Add `judge_avg`, the mean of the four criteria; missing ones count as 0."""
    total = sum((F.coalesce(F.col(c), F.lit(0)) for c in CRITERIA[1:]), F.coalesce(F.col(CRITERIA[0]), F.lit(0)))
    return scores.withColumn("judge_avg", total / F.lit(4.0))


def parse_chat_response(responses: DataFrame) -> DataFrame:
    """Add `content` (first choice) or `error` from the `status` and JSON `body` of chat answers."""
    parsed = responses.withColumn(
        "_p",
        parse_whole(F.col("body"), "choices ARRAY<STRUCT<message STRUCT<role STRING, content STRING>>>"),
    )
    choices = F.col("_p.value.choices")
    error = (
        F.when(F.col("status") != 200, F.concat(F.lit("answer with status "), F.col("status"), F.lit(": "), F.col("body")))
        .when(~F.coalesce(F.col("_p.ok"), F.lit(False)), F.lit("answer is not readable"))
        .when(F.coalesce(F.size(choices), F.lit(0)) <= 0, F.lit("answer has no choice"))
    )
    content = F.coalesce(F.get(choices, F.lit(0))["message"]["content"], F.lit(""))
    return parsed.withColumn("error", error).withColumn(
        "content", F.when(F.col("error").isNull(), content)
    ).drop("_p")
