"""Code files to units."""

import os

import pytest
from millrace.operators.extract import code_units, drop_generated_files
from millrace.sources.files import path_order, scan_code_files, select_code_files
from pyspark.sql import functions as F

QUEUE = """package queue

import (
	"errors"
	"sync"
)

// Push adds an item at the end and fails
// once the queue has been closed.
func (q *Queue) Push(item any) error {
	if q.closed {
		return errors.New("closed")
	}
	q.items = append(q.items, item)
	return nil
}

// WithRoom makes a queue for n items.
func WithRoom(n int) *Queue {
	return &Queue{items: make([]any, 0, n)}
}
"""

TRICKY = r'''// Copyright notice.

// Package tricky holds
// hard cases.
package tricky

import "os"
import str "strings"
import (
	// "commented/out"
	_ "embed" // blank
	`raw/path`
)

const text = `
func notOne() {
}
`

/*
func norThis() {
}
*/

var f = func() {}

//go:noinline
// Raw keeps its literal.
//
//	indented
//
//
// Last.
func Raw() string {
	const quote = '"' // a quote
	s := "not a comment: // and ` + "`" + r` back tick"
	return s + `
}
func fake() {
` + "\\"
}

func external(x int) int

func one() { return }

func (List[T]) generic(
	a int,
) (
	int,
) {
	if a > 0 { // }
		return 1
	}
	return 0
}

func Map[K comparable, V any](m map[K]V) {} // trailing

/* Block doc
   of two lines. */
func Last(s struct{}, u string) interface{} { // see http://example.com/{}
	return nil
}
'''.replace('` + "`" + r`', "`")


def units(spark, *files, **options):
    return [r.asDict() for r in code_units(spark.createDataFrame(files, "path string, src string"), **options)
            .orderBy(path_order(F.col("file_path")), "line_number").collect()]


def test_functions_and_methods(spark):
    push, with_room = units(spark, ("queue.go", QUEUE))
    assert (push["name"], push["receiver"], push["package"]) == ("Push", "*Queue", "queue")
    assert push["doc"] == "Push adds an item at the end and fails\nonce the queue has been closed."
    assert push["signature"] == "func (q *Queue) Push(item any) error"
    assert push["imports"] == ["errors", "sync"] and push["line_number"] == 10
    assert push["body"].startswith("// Push adds") and push["body"].endswith("\treturn nil\n}")
    assert (with_room["name"], with_room["receiver"], with_room["line_number"]) == ("WithRoom", "", 19)
    assert with_room["body"] == (
        "// WithRoom makes a queue for n items.\n"
        "func WithRoom(n int) *Queue {\n\treturn &Queue{items: make([]any, 0, n)}\n}"
    )


def test_signature_from_body_is_the_doc_line(spark):
    push, _ = units(spark, ("queue.go", QUEUE), signature_from_body=True)
    assert push["signature"] == "// Push adds an item at the end and fails"


def test_other_layouts(spark):
    odd = "\ufeffpackage p\nfunc A() {\n  if x {\n  }\n  }\nvar y = 1\n\nfunc B() {\n}\n/* closed\nfunc C() {\n}\n*/"
    assert [u["body"] for u in units(spark, ("o.go", odd))] == ["func A() {\n  if x {\n  }\n  }", "func B() {\n}"]


BROKEN = [
    "func A() {\n", "func A() {\n}\n}\n", "func A() {\n\tx := (1]\n}\n", "var s = `open\nfunc A() {\n}\n", 'var s = "open\nfunc A() {\n}\n',
    "var c = 'x\nfunc A() {\n}\n", "func A() {\n}\n/* open", "func A() {\n}\n/*/", "func A() {\n}\nvar x = ({)}\n", "func A() {\n}" + "}{",
]
WHOLE = [
    "func A() {\n\tx := a / b // ` \" ' {\n}\n", "func A() {\n\t_ = '{' + '\\'' + \"}\\\"\" + `((`\n}\n", "func A() {\n}\n/* { **/", "func A() {\n}\n/**/",
    "var x = " + "[" * 40 + "({})" + "]" * 40 + "\nfunc A() {\n}\n", "func A() {\n" + "\tif x {\n" * 30 + "\t}\n" * 30 + "}\n",
]


def test_files_that_do_not_parse_give_no_units(spark):
    files = [(f"b{i}.go", "package p\n" + text) for i, text in enumerate(BROKEN)]
    files += [("n1.go", "import \"os\"\npackage p\nfunc A() {\n}\n"), ("n2.go", "// package p\nfunc A() {\n}\n"), ("n3.go", None), ("n4.go", "")]
    assert units(spark, *files) == []
    whole = [(f"w{i}.go", "/* c */ // d\n\npackage p; " + text) for i, text in enumerate(WHOLE)]
    whole = [(p, s.replace("; ", "\n", 1)) for p, s in whole]
    assert [(u["file_path"], u["name"]) for u in units(spark, *whole)] == [(p, "A") for p, _ in whole]


def test_deep_brackets(spark):
    n = 20_000
    files = [("deep.go", "package p\nvar x = " + "(" * n + ")" * n + "\nfunc A() {\n}\n"), ("open.go", "package p\nvar x = " + "(" * n + "\nfunc A() {\n}\n")]
    assert [u["file_path"] for u in units(spark, *files)] == ["deep.go"]


def test_every_character_is_kept(spark):
    odd = "\x01\x02\x03\x04\x05\x06\x061"
    text = f"package p\n\nimport \"a{odd}\"\n\n// A {odd}.\nfunc A() string {{\n\treturn `{odd}\n{odd}`\n}}\n"
    one, two = units(spark, ("a.go", text), ("b.go", text.replace("\x02\x03", "\x03\x02")))
    assert one["body"] == text[text.index("// A") : -1] and one["doc"] == f"A {odd}." and one["imports"] == [f"a{odd}"]
    assert one["body"] != two["body"] and one["line_number"] == 6


def test_literals_comments_and_layouts(spark):
    found = {u["name"]: u for u in units(spark, ("t.go", TRICKY))}
    assert list(found) == ["Raw", "external", "one", "generic", "Map", "Last"]
    raw = found["Raw"]
    assert raw["package"] == "tricky" and raw["imports"] == ["os", "strings", "embed", "raw/path"]
    assert raw["doc"] == "Raw keeps its literal.\n\n\tindented\n\nLast."
    assert raw["body"].startswith("//go:noinline\n// Raw") and raw["body"].endswith('func fake() {\n` + "\\\\"\n}')
    assert TRICKY.split("\n")[raw["line_number"] - 1] == "func Raw() string {"
    assert found["external"]["body"] == "func external(x int) int"
    assert found["one"]["body"] == found["one"]["signature"] == "func one() { return }"
    assert found["generic"]["receiver"] == "List[T]" and found["generic"]["body"].endswith("\treturn 0\n}")
    assert found["generic"]["signature"] == "func (List[T]) generic("
    assert found["Map"]["body"] == "func Map[K comparable, V any](m map[K]V) {}"
    last = found["Last"]
    assert last["doc"] == "Block doc\n   of two lines."
    assert last["signature"] == "func Last(s struct{}, u string) interface{}"
    assert last["body"].endswith("return nil\n}")


def test_long_literals_do_not_overflow_the_matcher(spark):
    src = 'package p\n\nfunc F() string {\n\treturn "' + r"\x00" * 200_000 + '"\n}\n'
    comment = "package p\n\n" + "// line\n" * 30_000 + "func F() {\n}\n"
    assert [u["name"] for u in units(spark, ("a.go", src), ("b.go", comment))] == ["F", "F"]


def test_carriage_returns_and_plain_text(spark):
    assert units(spark, ("s.go", QUEUE.replace("\n", "\r\n")))[0]["body"] == units(spark, ("s.go", QUEUE))[0]["body"]
    assert units(spark, ("s.go", "func x() {\n}\n")) == []


def test_generated_files(spark):
    rows = [
        ("made.go", "// Code generated from a schema; DO NOT EDIT.\npackage m\n\nfunc M() {}\n"),
        ("late.go", "package p\n//" + "x" * 495 + "DO NOT EDIT\n"),
        ("edge.go", "package p\n//" + "x" * 489 + "DO NOT EDIT\n"),
        ("wide.go", "package p\n//" + "é" * 245 + "DO NOT EDIT\n"),
    ]
    kept = drop_generated_files(spark.createDataFrame(rows, "path string, src string"))
    assert sorted(r.path for r in kept.collect()) == ["late.go", "wide.go"]


def test_scan(spark, fresh_dir):
    import os

    tree = {
        "main.go": "package main\n", "a.go": "x\n", "a/b.go": "y\n", "a/b c+%.go": "w\n", "a/b_test.go": "z\n",
        "vendor/pkg/v.go": "v\n", "a/vendor/v.go": "v\n", "vendors/k.go": "k\n", "go.mod": "m\n", "x.go.txt": "t\n",
    }
    for name, text in tree.items():
        path = os.path.join(fresh_dir, name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(text)
    rows = scan_code_files(spark, fresh_dir).orderBy(path_order(F.col("path"))).collect()
    assert [r.path for r in rows] == ["a/b c+%.go", "a/b.go", "a/b_test.go", "a.go", "main.go", "vendors/k.go"]
    assert {r.path: r.src for r in rows} == {r.path: tree[r.path] for r in rows}
    landed = spark.createDataFrame(list(tree.items()), "path string, src string")
    assert {r.path for r in select_code_files(landed).collect()} == {r.path for r in rows}


def test_paths_from_any_root(spark, fresh_dir):
    root = f"{fresh_dir}/vendor/proj/code"
    for name in ("a.go", "x/b.go"):
        os.makedirs(os.path.dirname(f"{root}/{name}"), exist_ok=True)
        with open(f"{root}/{name}", "w") as f:
            f.write("package p\n")
    doubled = root.replace("/proj/", "//proj/")
    for r in (root, root + "/", f"{root}/x/..", f"{root}/./", doubled, f"file://{root}", f"{fresh_dir}/vendor/p*/code"):
        assert sorted(x.path for x in scan_code_files(spark, r).collect()) == ["a.go", "x/b.go"], r
    with pytest.raises(FileNotFoundError):
        scan_code_files(spark, f"{root}/none")


def test_many_functions_of_one_file(spark):
    """Line numbers and what the file says of its units take time in proportion to the file."""
    n = 50_000
    src = 'package p\n\nimport "fmt"\n\n' + "".join(f"// F{i} is.\nfunc F{i}() {{\n\tfmt.Println(`a\nb`)\n}}\n" for i in range(n))
    found = units(spark, ("a.go", src))
    assert len(found) == n and found[-1]["line_number"] == 5 + 5 * (n - 1) + 1 and found[-1]["imports"] == ["fmt"]
