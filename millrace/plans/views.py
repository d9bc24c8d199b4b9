"""Inputs for the registered queries, derived row by row from the given tables.

The expressions are plain SQL that Spark and DuckDB read alike, so both sides of a check start from the
same rows. Nothing here selects a part of a table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators.routing import Route

SEED = 42


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Rules over the requests of `events`: one of each kind (path, exact model, model prefix, default), two that
# both fit some requests, and one whose alias nobody serves.
ROUTES = (
    Route(target="audit", model="other"),
    Route(target="batch", model="team-1*"),
    Route(target="inline", path="/fi"),
    Route(target="nobody", model="thinker"),
    Route(target="batch", model="team-*"),
    Route(target="desk", default=True),
)
ALIASES = {
    "audit": "ledger-3",
    "batch": "night-7",
    "desk": "counter-2",
    "inline": "cursor-1",
}

# documents as units. German bodies open with a marker; Spanish ones hold one near byte 512.
UNIT_BODY = (
    "CASE lang WHEN 'de' THEN 'Code generated from ' || source || chr(10) || text "
    "WHEN 'es' THEN substr(text, 1, 490) || ' DO NOT EDIT ' || substr(text, 491) ELSE text END"
)
UNITS = {
    "doc_id": "doc_id",
    "file_path": "source || '/' || doc_id || '.txt'",
    "line_number": "CAST(1 AS BIGINT)",
    "doc": "CASE WHEN contains(text, chr(10)) THEN split_part(text, chr(10), 1) ELSE '' END",
    "signature": "split_part(text, chr(10), 1)",
    "body": UNIT_BODY,
}

# documents as Go source files: generated ones, vendored ones, other extensions, raw strings that hold
# whole texts, block comments, directives, repeated functions, brackets that don't match.
_GO_LINES = (
    "package \x00source\x00",
    "",
    "import (",
    '\t"fmt"',
    '\ttext "strings" // trims',
    ")",
    "",
    'import "os"',
    "",
    "// Text\x00doc_id\x00 returns one text in \x00lang\x00.",
    "//",
    "// It is kept whole.",
    "//go:noinline",
    "func Text\x00doc_id\x00() string {",
    "\treturn `\x00replace(text, chr(96), chr(39))\x00`",
    "}",
    "",
    "/* Title of a record",
    "   in \x00lang\x00. */",
    "// \x00split_part(text, chr(10), 1)\x00",
    "func (r *Record) Title(prefix string) string { // never empty",
    '\tif prefix == "" {',
    "\t\treturn fmt.Sprint(\x00n_chars\x00)",
    "\t}",
    "\treturn text.TrimSpace(prefix)",
    "}",
    "",
    "func init() {",
    '\tregister("\x00lang\x00")',
    "}",
    "",
    "func (Record) Len() int { return os.Getpagesize() }",
    "",
    "func Hash(",
    "\tname string,",
    ") uint64 {",
    "\treturn \x00n_chars\x00",
    "}",
    "",
)


def _go_source() -> str:
    parts = []
    for i, piece in enumerate("\n".join(_GO_LINES).split("\x00")):
        if i % 2:
            parts.append(piece)
            continue
        for j, line in enumerate(piece.split("\n")):
            if j:
                parts.append("chr(10)")
            tabs = len(line) - len(line.lstrip("\t"))
            parts += ["chr(9)"] * tabs
            if line.lstrip("\t"):
                parts.append(f"'{line.lstrip(chr(9))}'")
    header = "CASE WHEN lang = 'de' THEN '// Code generated from ' || source || '. DO NOT EDIT.' || chr(10) ELSE '' END"
    # Some files don't parse: a bracket stays open, or the wrong one closes it.
    broken = "CASE n_chars % 11 WHEN 0 THEN 'var open = []int{' WHEN 1 THEN 'var size = (1]' ELSE '' END"
    return " || ".join([header, *parts, broken])


SOURCE_FILES = {
    "path": "source || CASE WHEN lang = 'es' THEN '/vendor' ELSE '' END || '/doc' || doc_id || "
    "CASE WHEN n_chars < 100 THEN '.txt' ELSE '.go' END",
    "src": _go_source(),
}

# pages as articles with code blocks and a second section.
ARTICLE_HTML = (
    "replace(html, '<p><b>', '<h2 class=\"n\">Notes on <i>' || replace(url, '&', '&amp;') || '</i></h2>"
    "<p title=\"a > b\">Intro &lt;one&gt;<pre><code>if a &lt; b {' || chr(10) || chr(9) || 'fetch(&quot;' || "
    "replace(url, '&', '&amp;') || '&quot;)' || chr(10) || '}</code></pre><p>Then:</p>"
    "<pre>' || length(html) || '</pre><h3>Rest</h3><p><b>')"
)

# pages with links of every form.
LINKED_HTML = (
    "replace(html, '</ul>', '<li><A class=x HREF=\"' || replace(url, '&', '&amp;') || '\">self</a>"
    "<a href=\"?page=2&amp;x=1\">q</a><a href=#end>f</a><a title=\"href=/no\" href=''/a/./b/../' || page_id || "
    "'/''>d</a><a href=\"mailto:x@y.example\">m</a><a href=\"//other.example/z\">o</a><a href=\"/The\">again</a>"
    "</ul>')"
)

# pages as article sources of every type.
SOURCE_TYPE = (
    "CASE WHEN md5(url) < '3' THEN 'single_page' WHEN md5(url) < '6' THEN 'url_list' WHEN md5(url) < '9' THEN "
    "'blog_index' WHEN md5(url) < 'b' THEN 'markdown_repo' WHEN md5(url) < 'e' THEN 'sitemap' ELSE 'feed' END"
)

# events as logged requests.
REQUESTS = {
    "event_id": "event_id",
    "requested": "CASE event_type WHEN 'click' THEN 'team-' || user_id WHEN 'view' THEN 'thinker' "
    "WHEN 'signup' THEN 'drafter' WHEN 'purchase' THEN 'other' ELSE '' END",
    "path": "CASE WHEN user_id % 3 = 0 THEN '/fill' ELSE '/ask' END",
    "latency_ms": "value",
    "is_err": "event_type = 'error'",
    "body": "CASE event_type WHEN 'click' THEN '{\"model\":\"team-' || user_id || '\",\"props\":' || props || '}' "
    "WHEN 'view' THEN '{\"model\": \"thinker\"} ' WHEN 'signup' THEN '{\"model\":' || user_id || '}' "
    "WHEN 'purchase' THEN '{\"model\":\"team-1\"} ' || props ELSE 'no json ' || props END",
}

JUDGE_RESPONSE = (
    "CASE doc_id % 8 WHEN 0 THEN 'not json' WHEN 1 THEN '{\"correctness\": ' || quality || '}' "
    "WHEN 2 THEN '{\"correctness\": \"4\"}' WHEN 3 THEN '{\"idiom\": 4.5}' "
    "WHEN 4 THEN '{\"simplicity\": ' || toxic || '} done' WHEN 5 THEN '{\"completeness\": null, \"other\": [1]}' "
    "ELSE '{\"correctness\": ' || (quality + 3) || ', \"idiom\": ' || (toxic + 2) || ', \"simplicity\": ' || "
    "(doc_id % 5) || ', \"completeness\": 5}' END"
)


def _select(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{expression} AS {name}" for name, expression in columns.items()])


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "documents"), UNITS)


def source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "documents"), SOURCE_FILES)


def articles(spark: SparkSession, sf_dir: str, *others: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", *others, F.expr(ARTICLE_HTML).alias("html"))


def linked_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", "url", F.expr(LINKED_HTML).alias("html"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), REQUESTS)


def judge_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", "quality", F.expr(JUDGE_RESPONSE).alias("response"))


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents as evaluation results."""
    labels = table(spark, sf_dir, "labels")
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return documents.join(labels, "doc_id").select(
        F.col("doc_id").cast("string").alias("prompt_id"),
        F.col("doc_id").alias("position"),
        F.col("lang").alias("category"),
        (F.col("quality") == 1).alias("compiles"),
        (F.col("toxic") == 0).alias("vet_clean"),
        (F.col("n_chars") > 500).alias("long"),
    )
