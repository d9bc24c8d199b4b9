"""Which model a logged request is served by, and per-model request metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.jsontext import parse_whole
from millrace.sources.scratch import small_side, written_table


class Route(NamedTuple):
    """One rule. A path makes it a path rule, else a model a model rule, else `default` counts."""

    target: str
    path: str = ""
    model: str = ""
    default: bool = False


def _matches(rule: Route, model: Column, path: Column) -> Column | None:
    if rule.path:
        return path.startswith(rule.path)
    if rule.model.endswith("*"):
        return model.startswith(rule.model[:-1])
    if rule.model:
        return model == rule.model
    return F.lit(True) if rule.default else None


def resolve_model(rules: Sequence[Route], aliases: Mapping[str, str], model: Column, path: Column) -> Column:
    """First matching rule's model; an unknown alias gives '', no match the requested model.

    A rule list from a configuration becomes one CASE expression: no join, no shuffle.
    """
    chosen = None
    for rule in rules:
        condition = _matches(rule, model, path)
        if condition is None:
            continue
        value = F.lit(aliases.get(rule.target, ""))
        chosen = F.when(condition, value) if chosen is None else chosen.when(condition, value)
    return model if chosen is None else chosen.otherwise(model)


def route_requests(requests: DataFrame, rules: Sequence[Route], aliases: Mapping[str, str]) -> DataFrame:
    """Add `resolved` to requests (`requested`, `path`)."""
    return requests.withColumn("resolved", resolve_model(rules, aliases, F.col("requested"), F.col("path")))


def _search_path(place: int, n: int) -> list[int]:
    """Places in front of `place` that a binary search among `n` visits on its way there."""
    low, high, visited = 0, n - 1, []
    while (middle := (low + high) // 2) != place:
        if middle < place:
            visited.append(middle)
            low = middle + 1
        else:
            high = middle - 1
    return visited


def best_prefix_rules(texts: DataFrame, patterns: DataFrame) -> DataFrame:
    """`text, rule`: the least `rule` among the patterns (`pattern`, `rule`) that a text begins with, NULL if none does.

    All patterns that fit are beginnings of the longest one, so that one knows the answer. Its length is found by binary search
    over the distinct lengths: a pattern leaves marks of itself at the lengths where the search must go on to longer ones.
    One join per step, so a text is probed log2(lengths) times, whatever the number of rules.
    """
    spark = texts.sparkSession
    least = written_table(patterns.groupBy("pattern").agg(F.min("rule").alias("rule")), "patterns")
    lengths = sorted(r.n for r in least.select(F.length("pattern").alias("n")).distinct().collect())
    if not lengths:
        return texts.withColumn("rule", F.lit(None).cast(patterns.schema["rule"].dataType))
    marks = [(lengths[i], lengths[j]) for i in range(len(lengths)) for j in _search_path(i, len(lengths))]
    marked = least.join(F.broadcast(spark.createDataFrame(marks, "n int, mark int")), F.length("pattern") == F.col("n"))
    nodes = least.select(F.col("pattern").alias("node")).union(marked.select(F.expr("left(pattern, mark)"))).distinct()
    held = F.array(*map(F.lit, lengths))
    shorter = nodes.select("node", F.explode(F.filter(held, lambda n: n <= F.length("node"))).alias("n"))
    fits = shorter.select("node", F.expr("left(node, n)").alias("pattern")).join(least, "pattern")
    best = nodes.join(fits.groupBy("node").agg(F.min("rule").alias("best")), "node", "left").select("node", "best")
    best = small_side(best, "prefixes")
    state = texts.select("text", F.lit(0).alias("low"), F.lit(len(lengths) - 1).alias("high"), F.lit(None).cast(patterns.schema["rule"].dataType).alias("rule"))
    for _ in range(len(lengths).bit_length()):
        probed = state.withColumn("middle", F.expr("CAST((low + high) DIV 2 AS INT)")).withColumn("n", F.get(held, "middle"))
        probed = probed.withColumn("probe", F.when((F.col("low") <= F.col("high")) & (F.length("text") >= F.col("n")), F.expr("left(text, n)")))
        met = probed.join(best, F.col("probe") == F.col("node"), "left")
        there = F.col("node").isNotNull()
        state = met.select(
            "text",
            F.when(there, F.col("middle") + 1).otherwise(F.col("low")).alias("low"),
            F.when(there, F.col("high")).otherwise(F.col("middle") - 1).alias("high"),
            F.when(there, F.col("best")).otherwise(F.col("rule")).alias("rule"),
        )
    return state.select("text", "rule")


def route_requests_by_table(requests: DataFrame, rules: DataFrame, aliases: DataFrame) -> DataFrame:
    """The same for rules kept as a table of any size (`rule_no`, `path`, `model`, `is_default`, `target`).

    Routing depends on path and model alone, so only their distinct values are matched: names by an equi-join, beginnings by
    `best_prefix_rules`. The first of the rules found for a pair of them wins; never are rules multiplied with requests.
    """
    kind = (
        F.when(F.col("path") != "", "path").when(F.col("model").endswith("*"), "prefix")
        .when(F.col("model") != "", "model").when(F.col("is_default"), "default")
    )
    pattern = (
        F.when(F.col("path") != "", F.col("path"))
        .when(F.col("model").endswith("*"), F.expr("left(model, length(model) - 1)"))
        .otherwise(F.col("model"))
    )
    served = aliases.select(F.col("alias").alias("_alias"), F.col("model").alias("_served"))
    typed = rules.select("rule_no", "target", kind.alias("kind"), pattern.alias("pattern")).where("kind IS NOT NULL")
    typed = typed.join(served, F.col("target") == F.col("_alias"), "left").select(
        "kind", "pattern", F.struct("rule_no", F.coalesce("_served", F.lit("")).alias("served")).alias("rule")
    )
    typed = written_table(typed, "rules")

    def of(which: str) -> DataFrame:
        return typed.where(F.col("kind") == which).drop("kind")

    pairs = written_table(requests.select("requested", "path").distinct(), "routed-pairs")
    by_path = best_prefix_rules(pairs.select(F.col("path").alias("text")).distinct(), of("path"))
    by_prefix = best_prefix_rules(pairs.select(F.col("requested").alias("text")).distinct(), of("prefix"))
    by_name = of("model").groupBy(F.col("pattern").alias("requested")).agg(F.min("rule").alias("_by_name"))
    default = of("default").agg(F.min("rule")).scalar()
    matched = (
        pairs.join(by_path.select(F.col("text").alias("path"), F.col("rule").alias("_by_path")), "path", "left")
        .join(by_prefix.select(F.col("text").alias("requested"), F.col("rule").alias("_by_prefix")), "requested", "left")
        .join(by_name, "requested", "left")
        # Of structs the least rule number comes first.
        .select("requested", "path", F.least("_by_path", "_by_prefix", "_by_name", default)["served"].alias("_served"))
    )
    matched = matched.select(F.struct("requested", "path").alias("_pair"), F.coalesce("_served", "requested").alias("resolved"))
    keyed = requests.withColumn("_pair", F.struct("requested", "path"))
    return keyed.join(matched, "_pair", "left").drop("_pair")


def route_log_model(log: DataFrame, rules: Sequence[Route], aliases: Mapping[str, str]) -> DataFrame:
    """Add `model`: the resolved model where `body` is a JSON object with a string `model`, else ''."""
    parsed = log.withColumn("_p", parse_whole(F.col("body"), "model VARIANT"))
    requested = F.col("_p.value.model")
    is_text = F.col("_p.ok") & (F.schema_of_variant(requested) == "STRING")
    resolved = resolve_model(rules, aliases, F.try_variant_get(requested, "$", "string"), F.col("path"))
    return parsed.withColumn("model", F.when(is_text, resolved).otherwise("")).drop("_p")


def request_metrics(log: DataFrame) -> DataFrame:
    """Per `model`: requests, errors, and latency percentiles from a bounded sketch."""
    return log.groupBy("model").agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if("is_err").alias("errors"),
        F.percentile_approx("latency_ms", [0.5, 0.95, 0.99]).alias("latency_ms"),
    )
