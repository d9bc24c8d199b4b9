"""Sampling, splits, sinks, the build, scratch tables."""

import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from millrace.operators import evaluate, sampling
from millrace.plans import build
from millrace.sources import catalog, files, jsonl, prompts, scratch


def drawn(spark, n, seed=42):
    return sampling.with_draws(spark.range(n).withColumnRenamed("id", "k"), seed, ("k",))


@pytest.mark.parametrize("n, split, want", [
    (0, 0.1, 0), (1, 0.1, 0), (2, 0.1, 1), (3, 0.9, 2), (10, 0.1, 1), (19, 0.1, 1), (1000, 0.1, 100), (5000, 0.29, 1450),
    (7, 1.0, 6), (100_000, 0.001, 100), (5, 0.0, 1),
])
def test_exact_split(spark, n, split, want):
    labelled = sampling.train_eval_split(drawn(spark, n), ("k",), split)
    rows = labelled.select("k", "shuffle_draw", "split").collect()
    ranked = sorted(rows, key=lambda r: (r.shuffle_draw, r.k))
    assert len(rows) == n and [r.split for r in ranked] == ["eval"] * want + ["train"] * (n - want)


def test_split_with_tied_draws(spark):
    tied = spark.range(100).selectExpr("id AS k", "CAST(7 AS BIGINT) AS shuffle_draw")
    rows = sampling.train_eval_split(tied, ("k",), 0.25).collect()
    assert sorted(r.k for r in rows if r.split == "eval") == list(range(25))


def test_draws_depend_on_key_and_seed_only(spark):
    def values(df):
        return {r.k: (r.mode_draw, r.cut_draw, r.shuffle_draw) for r in df.collect()}

    one = values(drawn(spark, 500))
    eight = values(sampling.with_draws(spark.range(0, 500, 1, 8).withColumnRenamed("id", "k"), 42, ("k",)))
    assert one == eight and one != values(drawn(spark, 500, seed=43))
    assert all(0 <= v < 2**32 for t in one.values() for v in t)
    share = sum(r.f for r in drawn(spark, 20_000).select(sampling.is_fim(0.4).cast("int").alias("f")).collect()) / 20_000
    assert abs(share - 0.4) < 0.02
    for ratio, want in ((0.0, 0), (1.0, 300)):
        assert drawn(spark, 300).where(sampling.is_fim(ratio)).count() == want


def test_shuffle_is_a_total_order(spark):
    rows = sampling.seeded_shuffle(drawn(spark, 3000), ("k",)).collect()
    keys = [(r.shuffle_draw, r.k) for r in rows]
    assert keys == sorted(keys) and sorted(r.k for r in rows) == list(range(3000))


def test_validation_sample(spark):
    rows = sampling.validation_sample(spark.range(50).toDF("k"), ("k",)).orderBy("k").collect()
    assert [(r.k, r.split) for r in rows] == [(i, "train" if i < 8 else "eval") for i in range(10)]
    assert {r.split for r in sampling.validation_sample(spark.range(5).toDF("k"), ("k",)).collect()} == {"train"}


MAIN = """package main

import "os"

// Lookup reads a setting or gives the fallback.
func Lookup(name, fallback string) string {
	if v, ok := os.LookupEnv(name); ok {
		return v
	}
	return fallback
}

// Clamp keeps n within bounds.
func Clamp(n, low, high int) int {
	n = max(n, low)
	return min(n, high)
}
"""


def write_tree(root, tree):
    for name, text in tree.items():
        path = os.path.join(root, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)


def test_build_from_dir(spark, fresh_dir):
    write_tree(fresh_dir + "/in", {"main.go": MAIN, "copy.go": MAIN})
    out = fresh_dir + "/out"
    options = build.BuildOptions(min_lines=2, fim_ratio=0.5, seed=42)
    counts = build.build_from_dir(spark, fresh_dir + "/in", out, options).first()
    assert (counts.total, counts.train, counts.eval) == (2, 1, 1) and counts.fim + counts.instr == 2
    for split in ("train", "eval"):
        (line,) = [l for f in glob.glob(f"{out}/split={split}/*.json") for l in open(f)]
        example = json.loads(line)
        assert set(example) in ({"text", "source", "category"}, {"instruction", "output", "source", "category"})
        assert example["source"] == "copy.go"
        assert [r.asDict() for r in jsonl.read_split(spark, out, split).collect()] == [
            {c: example.get(c) for c in ("text", "instruction", "output", "source", "category")}
        ]


def test_vendor_is_skipped(spark, fresh_dir):
    body = "package p\n\n// F does it.\nfunc F%d() int {\n\tx := 1\n\treturn x\n}\n"
    write_tree(fresh_dir, {"vendor/pkg/vendor.go": body % 1, "main.go": body % 2})
    files_ = files.scan_code_files(spark, fresh_dir)
    examples = build.build_dataset(files_, build.BuildOptions(min_lines=2, fim_ratio=0.0)).collect()
    assert [(e.source, e.category, e.split) for e in examples] == [("main.go", "instruction", "train")]
    assert examples[0].instruction == "F does it.\n\nSignature: func F2() int"


def test_empty_build(spark, fresh_dir):
    write_tree(fresh_dir + "/in", {"doc.go": "package p\n"})
    counts = build.build_from_dir(spark, fresh_dir + "/in", fresh_dir + "/out").first()
    assert counts.asDict() == {"total": 0, "train": 0, "eval": 0, "fim": 0, "instr": 0}
    assert jsonl.read_split(spark, fresh_dir + "/out", "train").count() == 0


def test_build_does_not_depend_on_partitions(spark):
    tree = [(f"d{i % 7}/f{i}.go", MAIN.replace("Lookup(", f"Lookup{i}(").replace("Clamp(", f"Clamp{i % 40}(")) for i in range(200)]
    frame = spark.createDataFrame(tree, "path string, src string")
    results = []
    for n in (1, 8):
        rows = build.build_dataset(frame.repartition(n)).drop("shuffle_draw").collect()
        results.append(sorted(map(tuple, rows)))
    assert results[0] == results[1] and len(results[0]) == 240
    assert sum(r[-1] == "eval" for r in results[0]) == 24


def test_shuffled_order_on_disk(spark, fresh_dir):
    examples = drawn(spark, 2000).selectExpr(
        "'' AS text", "CAST(k AS STRING) AS instruction", "'<&>' AS output", "'s' AS source", "'c' AS category",
        "k", "shuffle_draw",
    )
    labelled = sampling.train_eval_split(examples, ("k",))
    jsonl.write_splits(labelled, fresh_dir + "/o", ("shuffle_draw", "k"))
    want = {s: [r.instruction for r in labelled.where(F.col("split") == s).orderBy("shuffle_draw", "k").collect()]
            for s in ("train", "eval")}
    for s, ids in want.items():
        lines = [json.loads(l) for f in sorted(glob.glob(f"{fresh_dir}/o/split={s}/*.json")) for l in open(f)]
        assert [l["instruction"] for l in lines] == ids
        assert all("text" not in l and l["output"] == "<&>" for l in lines)


def test_jsonl_reader(spark, fresh_dir):
    with open(fresh_dir + "/a.jsonl", "w") as f:
        f.write('{"text": "x", "other": 1}\n\n   \n {"instruction": "i", "output": "\\u003co\\u003e"} \n')
    rows = jsonl.read_jsonl(spark, fresh_dir).collect()
    assert [(r.text, r.instruction, r.output) for r in rows] == [("x", None, None), (None, "i", "<o>")]
    with open(fresh_dir + "/b.jsonl", "w") as f:
        f.write('{"text": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        jsonl.read_jsonl(spark, fresh_dir).collect()


def test_empty_jsonl(spark, fresh_dir):
    empty = spark.createDataFrame([], "text string, instruction string, output string, source string, category string")
    jsonl.write_jsonl(empty, fresh_dir + "/e")
    assert jsonl.read_jsonl(spark, fresh_dir + "/e").count() == 0


def test_scratch_follows_the_setting(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, _name, _default):
            return self.value

    class Session:
        sparkContext = Context()

    session = Session()
    session.conf = Conf("hdfs://shared/ck/")
    assert scratch.scratch_path(session, "t").startswith("hdfs://shared/ck/t-")
    session.conf = Conf(None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.scratch_path(session, "t")
    frame = spark.range(10).toDF("a")
    assert scratch.written_table(frame, "t").count() == 10


def test_catalog(spark):
    repos = spark.createDataFrame(
        [("https://h/a", None, "src/", 1.5), ("https://h/b", None, None, None), (None, "/local", None, 2.0), ("u", "", "", 0.0)],
        catalog.REPO_SCHEMA,
    )
    rows = catalog.source_catalog(repos).collect()
    assert [r.effective_weight for r in rows] == [1.5, 1.0, 2.0, 1.0]
    assert [r.is_local for r in rows] == [False, False, True, False]


def test_sources_file(spark, fresh_dir):
    text = {
        "repos": [{"url": "https://h/a", "path": "src/", "weight": 1.5, "branch": "x"}, {"dir": "/local"}],
        "articles": [{"url": "https://h/blog/", "type": "blog_index", "weight": 2}, {"path": "l.txt", "type": "url_list"}],
        "other": 1,
    }
    with open(fresh_dir + "/sources.json", "w") as f:
        json.dump(text, f, indent=1)
    repos, articles = catalog.read_sources(spark, fresh_dir)
    assert [tuple(r) for r in repos.collect()] == [("https://h/a", "", "src/", 1.5), ("", "/local", "", 0.0)]
    assert [tuple(r) for r in articles.collect()] == [("https://h/blog/", "", "blog_index"), ("", "l.txt", "url_list")]


def test_prompts(spark, fresh_dir):
    documents = {
        "a.json": {"category": "errors", "weight": 0.2, "extra": 1, "prompts": [
            {"id": "wrap", "category": "own", "prompt": "Wrap.\nIt."}, {"id": "is", "prompt": "Is.", "weight": 0.5}]},
        "b.json": {"category": "idiom", "prompts": [{"id": "x", "description": "d", "prompt": "X."}]},
    }
    for name, text in documents.items():
        with open(f"{fresh_dir}/{name}", "w") as f:
            json.dump(text, f, indent=2)
    rows = prompts.load_prompts(prompts.read_prompt_files(spark, fresh_dir)).orderBy("file", "position").collect()
    assert [(r.id, r.category, r.weight, r.prompt, r.description) for r in rows] == [
        ("wrap", "errors", 0.2, "Wrap.\nIt.", ""), ("is", "errors", 0.5, "Is.", ""), ("x", "idiom", 0.0, "X.", "d"),
    ]


def test_url_list(spark, fresh_dir):
    with open(fresh_dir + "/l.txt", "w") as f:
        f.write("# c\n\n  https://a.example/x  \n\t\n#https://no\nhttps://b.example/#f\n")
    assert [r.url for r in files.url_list(spark, fresh_dir + "/l.txt").collect()] == ["https://a.example/x", "https://b.example/#f"]


def test_markdown(spark, fresh_dir):
    write_tree(fresh_dir, {"README.md": "# A\n", "docs/x.md": "b", "docs/vendor/y.md": "c", "empty.md": "", "n.txt": "t"})
    rows = files.scan_markdown(spark, fresh_dir).collect()
    assert sorted((r.path, r.content) for r in rows) == [("README.md", "# A\n"), ("docs/vendor/y.md", "c"), ("docs/x.md", "b")]


def test_both_splits_are_written_and_an_old_build_is_kept(spark, fresh_dir):
    write_tree(fresh_dir + "/in", {"main.go": MAIN})
    build.build_from_dir(spark, fresh_dir + "/in", fresh_dir + "/out")
    assert all(os.path.isdir(f"{fresh_dir}/out/split={s}") for s in jsonl.SPLITS)
    with pytest.raises(FileExistsError):
        build.build_from_dir(spark, fresh_dir + "/in", fresh_dir + "/out")
    counts = build.build_from_dir(spark, fresh_dir + "/in", fresh_dir + "/out", mode="overwrite").first()
    assert sum(jsonl.read_split(spark, fresh_dir + "/out", s).count() for s in jsonl.SPLITS) == counts.total


def test_equal_paths_of_two_trees_split_exactly(spark):
    tree = [("a.go", MAIN.replace("Lookup(", f"Lookup{i}(").replace("Clamp(", f"Clamp{i}(")) for i in range(50)]
    rows = build.build_dataset(spark.createDataFrame(tree, "path string, src string")).collect()
    assert len(rows) == 100 and sum(r.split == "eval" for r in rows) == 10


def test_draws_tell_key_parts_apart(spark):
    rows = [("a|1", "2"), ("a", "1|2"), ("a", None), (None, "a"), ("a\\", "1"), ("a", "\\1"), ("a", "\\N")]
    drawn = sampling.with_draws(spark.createDataFrame(rows, "a string, b string"), 42, ("a", "b"))
    assert drawn.select("mode_draw", "cut_draw").distinct().count() == len(rows)


def test_strata_are_split_exactly(spark):
    rows = [(i, None if i % 3 == 0 else "x" if i % 3 == 1 else f"y{i % 6}") for i in range(500)] + [(1000, "alone"), (1001, "two"), (1002, "two")]
    drawn = sampling.with_draws(spark.createDataFrame(rows, "id long, c string"), 42, ("id",))
    got = sampling.stratified_split(drawn, ("id",), "c").collect()
    assert len(got) == len(rows)
    for c in {r.c for r in got}:
        ordered = [r.split for r in sorted((r for r in got if r.c == c), key=lambda r: (r.shuffle_draw, r.id))]
        n_eval = max(0, min(len(ordered) - 1, max(1, len(ordered) // 10)))
        assert ordered == ["eval"] * n_eval + ["train"] * (len(ordered) - n_eval)
    assert sampling.stratified_split(drawn.limit(0), ("id",), "c").count() == 0


def test_copies_follow_the_weights(spark):
    weights = spark.createDataFrame([("a", 1.5), ("a", 2.0), ("b", 3.2), ("c", 0.1), ("d", None), (None, 9.0)], "o string, effective_weight double")
    rows = spark.createDataFrame([(o,) for o in ("a", "b", "c", "d", "e", None)], "o string")
    copies = {r.o: r["count"] for r in sampling.oversample(rows, weights, "o").groupBy("o").count().collect()}
    assert copies == {"a": 2, "b": 4, "c": 1, "d": 1, "e": 1, None: 1}


def test_weighted_score_scales_the_weights(spark):
    results = spark.createDataFrame([("a", 0.4), ("a", 0.6), ("b", 1.0), ("z", 0.0)], "category string, score double")
    weights = spark.createDataFrame([("a", 0.15), ("b", 0.05), ("unused", 0.8)], "category string, weight double")
    row = evaluate.weighted_score(results, weights).first()
    assert row.categories == 2 and abs(row.weighted_score - 0.625) < 1e-12


PAGE = "<h2>Readers</h2><p>Wrap {n} readers:</p><pre>r{n} := bufio.NewReader(f)\nuse(r{n})</pre><p>and go on.</p>"


def test_build_from_sources(spark, fresh_dir):
    """Repositories, articles and weights of one catalog; no block, body or copy is on both sides."""
    body = "// Get{n} reads.\nfunc Get{n}(a int) int {{\n\tb := a + {n}\n\treturn b\n}}\n"
    for repo, numbers in (("one/src", range(40)), ("two", range(30, 60))):
        write_tree(f"{fresh_dir}/{repo}", {f"p{n}/f.go": "package p\n\n" + body.format(n=n) for n in numbers})
    write_tree(f"{fresh_dir}/two", {"vendor/v.go": "package v\n\n" + body.format(n=99), "two.md": "x", "bad.go": "package p\n" + body.format(n=77) + "{"})
    write_tree(f"{fresh_dir}/two/vendored", {"v.go": "package v\n\n" + body.format(n=98)})
    write_tree(f"{fresh_dir}/vendor/three", {"t.go": "package t\n\n" + body.format(n=97)})
    text = {
        "repos": [
            {"dir": f"{fresh_dir}/one", "path": "src", "weight": 2.5}, {"url": "https://h/two", "dir": f"{fresh_dir}/two/"},
            {"url": "https://h/clone"}, {"dir": f"{fresh_dir}/none"}, {"dir": f"{fresh_dir}/two/vendored", "weight": 3}, {"dir": f"{fresh_dir}/vendor/three"},
        ],
        "articles": [{"url": f"http://a.example/{n}", "type": "single_page"} for n in range(30)] + [{"url": "http://a.example/gone", "type": "single_page"}],
    }
    with open(fresh_dir + "/sources.json", "w") as f:
        json.dump(text, f)
    # Two pages with the same block.
    pages = spark.createDataFrame([(f"http://a.example/{n}", PAGE.format(n=max(n, 1))) for n in range(30)], "url string, html string")
    none = [spark.createDataFrame([], t) for t in ("path string, pos long, url string", "url string, body string", "repo_url string, pos long, content string")]
    with pytest.warns(UserWarning, match="no folder of repository"):
        counts = build.build_from_sources(spark, fresh_dir + "/sources.json", fresh_dir + "/out", pages, *none).first()
    rows = {s: jsonl.read_split(spark, fresh_dir + "/out", s).collect() for s in jsonl.SPLITS}
    assert counts.total == sum(map(len, rows.values())) and counts.eval == len(rows["eval"]) and counts.fim > 0 and counts.instr > 60

    def blocks(split):
        out = set()
        for r in rows[split]:
            if r.category == "prose_to_code":
                out.add((r.instruction, r.output))
            elif r.category == "code_to_prose":
                out.add((r.output, r.instruction.removeprefix("Explain this Go code:\n\n")))
            else:
                out.add(r.text or r.output)
        return out

    assert not blocks("train") & blocks("eval")
    pairs = [b for s in jsonl.SPLITS for b in blocks(s) if isinstance(b, tuple)]
    assert len(pairs) == 29 and sum(isinstance(b, tuple) for b in blocks("eval")) == 2
    # 40 bodies of the first repository, 20 more of the second, one each of two others; the first has 3 copies of each in train.
    assert len([b for s in jsonl.SPLITS for b in blocks(s) if not isinstance(b, tuple)]) == 62
    copies = {}
    for r in rows["train"]:
        if r.category in ("fim", "instruction"):
            copies.setdefault(r.source.removeprefix(fresh_dir).split("/")[1], []).append(r.text or r.output)
    assert {len(v) / len(set(v)) for v in (copies["one"],)} == {3.0} and sum("Get98" in x for x in copies.get("two", [])) in (0, 3)


def test_groups_stay_together_and_are_counted(spark):
    rows = spark.range(3000).selectExpr("id", "concat('g', id % 700) AS g", "IF(id % 700 < 200, 'a', NULL) AS c")
    got = sampling.grouped_split(rows, "g", "c", 42, 0.1).collect()
    sides: dict = {}
    for r in got:
        sides.setdefault((r.c, r.g), set()).add(r.split)
    assert len(got) == 3000 and all(len(s) == 1 for s in sides.values())
    assert sum(s == {"eval"} for (c, _), s in sides.items() if c == "a") == 20 and sum(s == {"eval"} for (c, _), s in sides.items() if c is None) == 50


def test_split_ranks_rows_of_one_draw_only(spark):
    """All rows in one bucket, a third of them with one draw."""
    crowded = spark.range(3000).selectExpr("id AS k", "IF(id % 3 = 0, 70000L, 65536L + id) AS shuffle_draw", "'s' AS c")
    ranked = sorted((70000 if k % 3 == 0 else 65536 + k, k) for k in range(3000))
    for split in (0.1, 0.5, 0.9):
        want = {k for _, k in ranked[: int(3000 * split)]}
        assert {r.k for r in sampling.train_eval_split(crowded, ("k",), split).collect() if r.split == "eval"} == want
        assert {r.k for r in sampling.stratified_split(crowded, ("k",), "c", split).collect() if r.split == "eval"} == want


def test_a_write_that_fails_leaves_what_was_there(spark, fresh_dir):
    def examples(n, bad="false"):
        rows = drawn(spark, n).selectExpr("k", "shuffle_draw", f"IF({bad}, raise_error('no'), 'x' || k) AS text")
        return rows.selectExpr("*", "'' AS instruction", "'' AS output", "'' AS source", "'fim' AS category", "IF(k % 10 = 0, 'eval', 'train') AS split")

    out = f"{fresh_dir}/out"
    with pytest.raises(Exception, match="no"):
        jsonl.write_splits(examples(50, "k = 49"), out, ("shuffle_draw", "k"))
    assert not os.path.exists(out)
    jsonl.write_splits(examples(50), out, ("shuffle_draw", "k"))
    with pytest.raises(Exception, match="no"):
        jsonl.write_splits(examples(70, "k = 3"), out, ("shuffle_draw", "k"), "overwrite")
    assert [jsonl.read_split(spark, out, s).count() for s in jsonl.SPLITS] == [5, 45]
    with pytest.raises(FileExistsError):
        jsonl.write_splits(examples(5), out, ("shuffle_draw", "k"))
    jsonl.write_splits(examples(1), out, ("shuffle_draw", "k"), "overwrite")
    assert [jsonl.read_split(spark, out, s).count() for s in jsonl.SPLITS] == [1, 0] and os.path.isdir(f"{out}/split=train")
