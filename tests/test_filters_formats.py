"""Filters and formats."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluate, filters, formats
from millrace.operators.sampling import with_draws


def frame(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def test_generated_units(spark):
    rows = [
        ("stamp", "// Code generated from a schema.\nfunc A() {}"),
        ("warning", "// Made by a tool: DO NOT EDIT\nfunc A() {}"),
        ("plain", "// A is written by hand.\nfunc A() {}"),
        ("directive", "//go:generate stringer\nfunc A() {}"),
    ]
    kept = filters.drop_generated_units(frame(spark, rows, "name string, body string")).collect()
    assert [r.name for r in kept] == ["plain"]


LOOP = "func Loop() {\n\tfor i := range 3 {\n\t\tprintln(i)\n\t}\n}"


def test_min_lines(spark):
    rows = [("func L() {}",), (LOOP,)]
    assert [r.body for r in filters.min_lines(frame(spark, rows, "body string"), 3).collect()] == [rows[1][0]]


def test_dedup_keeps_the_first_in_walk_order(spark):
    rows = [("a.go", 1, "x"), ("a/b.go", 9, "x"), ("a/b.go", 10, "y"), ("a/b.go", 2, "y")]
    units = frame(spark, rows, "file_path string, line_number bigint, body string")
    kept = sorted((r.body, r.file_path, r.line_number) for r in filters.exact_dedup(units).collect())
    assert kept == [("x", "a/b.go", 9), ("y", "a/b.go", 2)]
    again = filters.exact_dedup(filters.exact_dedup(units))
    assert sorted((r.body, r.file_path, r.line_number) for r in again.collect()) == kept


def test_dedup_of_a_hot_body(spark):
    units = spark.range(20_000).selectExpr(
        "'f/' || id AS file_path", "id AS line_number", "IF(id % 3 = 0, 'hot', CAST(id AS string)) AS body"
    )
    kept = filters.exact_dedup(units.repartition(8))
    assert kept.count() == 20_000 - 6_667 + 1
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_filter_chain(spark):
    rows = [
        ("made", "// Code generated from a schema.\n" + LOOP), ("tiny", "func Tiny() {}"), ("loop", LOOP), ("loop", LOOP),
        ("other", LOOP.replace("Loop", "Other")),
    ]
    units = frame(spark, [(n, b, "f.go", i) for i, (n, b) in enumerate(rows)],
                  "name string, body string, file_path string, line_number int")
    assert sorted(r.name for r in filters.filter_all(units, 3).collect()) == ["loop", "other"]


def test_fim_parts_rebuild_the_body(spark):
    bodies = ["func Twice(n int) int {\n\treturn 2 * n\n}", "1234567890", "née sœur 😀 x", "short", "ééééé", "😀😀😀"]
    units = frame(spark, [(i, b, "f.go") for i, b in enumerate(bodies * 20)], "id int, body string, file_path string")
    drawn = with_draws(units, 42, ("id",))
    rows = formats.format_fim(drawn, F.col("cut_draw")).collect()
    assert {r.body for r in rows} == set(bodies) - {"short"}
    for r in rows:
        head, rest = r.text.removeprefix("<|fim_prefix|>").split("<|fim_suffix|>")
        tail, middle = rest.split("<|fim_middle|>")
        n = len(r.body)
        assert head + middle + tail == r.body and r.category == "fim" and r.source == "f.go"
        assert n // 4 <= len(head) < n * 3 // 4 and len(middle) == (n - len(head)) // 2
    again = formats.format_fim(with_draws(units.repartition(5), 42, ("id",)), F.col("cut_draw")).collect()
    assert {(r.id, r.text) for r in rows} == {(r.id, r.text) for r in again}
    assert len({r.text for r in rows if r.body == bodies[0]}) > 3


def test_instructions(spark):
    rows = [("Twice doubles n.", "func Twice(n int) int", "x", "f"), ("", "func Twice(n int) int", "x", "f")]
    out = formats.format_instruction(frame(spark, rows, "doc string, signature string, body string, file_path string"))
    assert [r.instruction for r in out.collect()] == [
        "Twice doubles n.\n\nSignature: func Twice(n int) int",
        "Implement the Go function: func Twice(n int) int",
    ]


def test_prose_pairs(spark):
    sections = frame(spark, [("t", "prose", ["c1", "c2"])], "title string, prose string, code_blocks array<string>")
    rows = formats.prose_pairs(sections).collect()
    assert [(r.block_no, r.category, r.instruction, r.output) for r in rows] == [
        (0, "prose_to_code", "prose", "c1"), (0, "code_to_prose", "Explain this Go code:\n\nc1", "prose"),
        (1, "prose_to_code", "prose", "c2"), (1, "code_to_prose", "Explain this Go code:\n\nc2", "prose"),
    ]


def test_rendered_text(spark):
    rows = [("t", "i", "o"), ("", "i", "o"), (None, None, "o")]
    out = formats.render_training_text(frame(spark, rows, "text string, instruction string, output string"))
    assert [r.rendered for r in out.collect()] == [
        "t", "### Instruction:\ni\n\n### Response:\no", "### Instruction:\n\n\n### Response:\no"
    ]


def test_compare(spark):
    base = frame(spark, [("a", 0.1, 0), ("a", 0.4, 1), ("b", 0.7, 2), ("z", 0.2, 3)],
                 "prompt_id string, score double, position long")
    cand = frame(spark, [("a", 0.7, 0), ("b", 0.7, 1), ("b", 0.1, 2), ("new", 0.9, 3)],
                 "prompt_id string, score double, position long")
    rows = evaluate.eval_compare(base, cand).orderBy("position").collect()
    assert [(r.prompt_id, r.verdict) for r in rows] == [("a", "improved"), ("b", "unchanged"), ("b", "regressed")]
    r = evaluate.compare_summary(base, cand).first()
    assert (r.improved, r.unchanged, r.regressed) == (1, 1, 1)
    assert r.score_delta == pytest.approx(0.6 - 0.35)


def test_scores_and_summary(spark):
    rows = [(True, True), (True, False), (False, False), (None, True)]
    scored = evaluate.score_results(frame(spark, rows, "compiles boolean, vet_clean boolean"))
    assert [r.score for r in scored.collect()] == [0.7, 0.4, 0.0, 0.3]
    s = evaluate.eval_summary(scored).first()
    assert (s.total_prompts, s.compile_rate, s.vet_rate) == (4, 0.5, 0.5) and s.avg_score == pytest.approx(0.35)


JUDGED = [
    ('{"correctness": 4, "idiom": 5, "simplicity": 4, "completeness": 3}', (4, 5, 4, 3)),
    ("not json", None), ("", None), ("[]", None), ("5", None), ('"x"', None), ("null", (0, 0, 0, 0)),
    ("{}", (0, 0, 0, 0)), (' {"IDIOM" : 2, "x": {"idiom": [9]}}\n', (0, 2, 0, 0)), ('{"idiom": null}', (0, 0, 0, 0)),
    ('{"idiom": "2"}', None), ('{"idiom": 2.0}', None), ('{"idiom": 2} x', None), ('{"idiom": 2}{"idiom": 3}', None),
    ('{"idiom": 2}, {"idiom": 3}', None), ('{"idiom": 1, "idiom": 3}', (0, 3, 0, 0)), ('{"idiom": true}', None),
    ('{"idiom": -7}', (0, -7, 0, 0)), ('{"idiom": 99999999999999999999}', None), ('{"idiom": 2', None),
    ('{"idiom": 2}] [{"idiom": 3}', None), ('{"idiom": 2}, "z": {}', None), (None, None),
]


def test_judge_answers(spark):
    rows = [(i, r) for i, (r, _) in enumerate(JUDGED)]
    parsed = evaluate.parse_judge(frame(spark, rows, "id int, response string"))
    for r in parsed.collect():
        want = JUDGED[r.id][1]
        got = (r.correctness, r.idiom, r.simplicity, r.completeness) if r.ok else None
        assert got == want, JUDGED[r.id]
    assert evaluate.judge_average(parsed.where("id = 0")).first().judge_avg == 4.0


def test_chat_answers(spark):
    rows = [
        (0, 200, '{"choices":[{"message":{"role":"assistant","content":"hé\\n"}},{"message":{"content":"b"}}]}'),
        (1, 500, "busy"), (2, 200, "no"), (3, 200, '{"choices":[]}'), (4, 200, "{}"), (5, 200, '{"choices":[{}]}'),
        (6, 200, '{"choices":[{"message":{"content":"x"}}]} trailing'),
    ]
    out = evaluate.parse_chat_response(frame(spark, rows, "id int, status int, body string")).orderBy("id").collect()
    assert [r.content for r in out] == ["hé\n", None, None, None, None, "", None]
    assert [r.error for r in out] == [
        None, "answer with status 500: busy", "answer is not readable", "answer has no choice", "answer has no choice", None,
        "answer is not readable",
    ]


def test_requests_and_judge_prompts(spark):
    import json

    row = formats.chat_request(frame(spark, [('say "hi"\n<é>',)], "prompt string"), "m").first()
    body = json.loads(row.request)
    assert body["model"] == "m" and [m["role"] for m in body["messages"]] == ["system", "user"]
    assert body["messages"][1]["content"] == 'say "hi"\n<é>'
    text = formats.judge_prompt(frame(spark, [("P %s", "R")], "prompt string, response string")).first().judge_prompt
    assert text.endswith("Original prompt: P %s\n\nCode to evaluate:\nR") and '"completeness": N}' in text
