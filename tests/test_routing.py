"""Routing, request logs and metrics."""

import random

import pytest

from millrace.operators import routing
from millrace.operators.routing import Route
from millrace.streaming.metrics import read_running_metrics, write_running_metrics

ALIASES = {"writer": "code-tuned", "clerk": "fill-small"}


def resolve(spark, rules, aliases, requests):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(requests)], "id int, requested string, path string")
    plain = routing.route_requests(frame, rules, aliases).orderBy("id").collect()
    rule_rows = [(i, r.path, r.model, r.default, r.target) for i, r in enumerate(rules)]
    by_table = routing.route_requests_by_table(
        frame,
        spark.createDataFrame(rule_rows, "rule_no int, path string, model string, is_default boolean, target string"),
        spark.createDataFrame(list(aliases.items()), "alias string, model string"),
    ).orderBy("id").collect()
    assert [r.resolved for r in plain] == [r.resolved for r in by_table]
    return [r.resolved for r in plain]


def test_by_model(spark):
    rules = [Route("clerk", model="tiny"), Route("writer", model="big-*"), Route("clerk", default=True)]
    requests = [("big-one", "/ask"), ("tiny", "/ask"), ("tiny-2", "/ask"), ("big", "/ask")]
    assert resolve(spark, rules, ALIASES, requests) == ["code-tuned", "fill-small", "fill-small", "fill-small"]


def test_by_path(spark):
    rules = [Route("writer", path="/fill"), Route("clerk", path="/f")]
    requests = [("m", "/fill"), ("m", "/filling/now"), ("m", "/form"), ("m", "/ask")]
    assert resolve(spark, rules, ALIASES, requests) == ["code-tuned", "code-tuned", "fill-small", "m"]


def test_first_match_unknown_alias_and_no_match(spark):
    rules = [
        Route("ghost", model="a"), Route("clerk", path="/p", model="b", default=True), Route("writer", model="a*"),
        Route("clerk", model="*x*"), Route("clerk"), Route("writer", model="é*"),
    ]
    requests = [("a", "/q"), ("ab", "/q"), ("b", "/q"), ("b", "/pp"), ("*xy", "/q"), ("", "/q"), ("éa", ""), ("A", "/q")]
    assert resolve(spark, rules, ALIASES, requests) == ["", "code-tuned", "b", "fill-small", "fill-small", "", "code-tuned", "A"]
    everything = [Route("writer", model="*")]
    assert resolve(spark, everything, ALIASES, [("", "/"), ("x", "/")]) == ["code-tuned", "code-tuned"]


def test_no_rules(spark):
    assert resolve(spark, [Route("clerk")], ALIASES, [("m", "/")]) == ["m"]


def test_many_rules_of_many_lengths(spark):
    """Ten thousand beginnings of 200 lengths: eight probes per text, and the rules that a plain search finds."""
    draw = random.Random(3)
    long = ["".join(draw.choice("ab") for _ in range(400)) for _ in range(60)]
    patterns = [(draw.choice(long)[: draw.randrange(1, 401, 2)], n) for n in draw.sample(range(10**6), 10_000)]
    texts = [w[: draw.randrange(0, 401)] + draw.choice(["", "c", "ab"]) for w in long for _ in range(10)] + ["", "zzz", None]
    out = routing.best_prefix_rules(
        spark.createDataFrame([(t,) for t in texts], "text string").distinct(), spark.createDataFrame(patterns, "pattern string, rule int")
    )
    want = {t: min((n for p, n in patterns if t is not None and t.startswith(p)), default=None) for t in texts}
    assert {r.text: r.rule for r in out.collect()} == want
    assert len({len(p) for p, _ in patterns}) == 200 and out._jdf.queryExecution().executedPlan().toString().count("Join") <= 2 * 8


def test_log_bodies(spark):
    rules = [Route("writer", default=True)]
    bodies = [
        ('{"model":"test","messages":[{"role":"user","content":"hi"}]}', "code-tuned"), ('{"model":5}', ""),
        ('{"model":null}', ""), ("{}", ""), ("no", ""), ("[]", ""), ("null", ""), ('{"model":"a"} {"model":"b"}', ""),
        ('{"Model":"a"}', ""), ('{"model":{"model":"a"}}', ""), ('{"model":"a","model":7}', ""), (None, ""), ('{"model":""}', "code-tuned"),
    ]
    frame = spark.createDataFrame([(i, b, "/ask") for i, (b, _) in enumerate(bodies)], "id int, body string, path string")
    rows = routing.route_log_model(frame, rules, ALIASES).orderBy("id").collect()
    assert [r.model for r in rows] == [m for _, m in bodies]


def log_of(df):
    return df.selectExpr("concat('m', id % 3) AS model", "CAST(id AS DOUBLE) AS latency_ms", "id % 10 = 0 AS is_err")


def test_metrics(spark):
    rows = {r.model: r for r in routing.request_metrics(log_of(spark.range(3000))).collect()}
    assert {m: (r.requests, r.errors) for m, r in rows.items()} == {f"m{i}": (1000, 100) for i in range(3)}
    assert rows["m0"].latency_ms == pytest.approx([1500, 2850, 2970], abs=10)


def test_running_metrics_over_two_runs(spark, fresh_dir):
    spark.range(0, 1000).write.parquet(fresh_dir + "/in/a")
    stream = log_of(spark.readStream.schema("id bigint").parquet(fresh_dir + "/in/*"))
    for n in (1000, 2500):
        if n == 2500:
            spark.range(1000, 2500).write.parquet(fresh_dir + "/in/b")
        write_running_metrics(stream, fresh_dir + "/out", fresh_dir + "/ck").awaitTermination()
        got = read_running_metrics(spark, fresh_dir + "/out").drop("latency_ms").collect()
        want = routing.request_metrics(log_of(spark.range(n))).drop("latency_ms").collect()
        assert sorted(got) == sorted(want)
