"""Benchmark passages against a plain search, and against SQL (tests/llm/test_llm.py)."""

import hashlib
import re

from conftest import SF_DIR

from millrace.llm import leaks


def plain_words(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def plain(docs, items, window=10):
    out = []
    for i, text in docs:
        words, hit, named = plain_words(text), set(), set()
        for name, item in items:
            w = plain_words(item)
            size = min(window, len(w))
            for k in range(len(w) - size + 1 if w else 0):
                for p in range(len(words) - size + 1):
                    if words[p : p + size] == w[k : k + size]:
                        hit |= set(range(p, p + size))
                        named |= {str(name)} if name is not None else set()
        out.append((i, len(words), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [
    (10, "The quick brown fox jumps over the lazy dog and runs away home"), (9, "Ünïcode wörds"), (9, "ünïcode WÖRDS"), (3, None), (4, ""), (5, "?!"),
    (None, "no name here"), (11, "quick brown fox jumps over the lazy dog and runs AWAY"), (12, "a b a b a b a b a b a b"), (13, "x"),
]
DOCS = [
    (1, "He said: THE quick, brown fox jumps -- over the lazy dog and runs away home!"), (2, None), (3, ""), (4, "€ ünïcode wörds ünïcode wörds"), (4, "€ ünïcode wörds ünïcode wörds"),
    (None, "no name here"), (6, "the quick brown fox jumps over the lazy cat and runs away home"), (7, "a b " * 40), (8, "xx x-y 7x x"),
    (9, "filler " * 20_000 + "Quick brown fox jumps over the lazy dog and runs"), (10, "ÜNÏCODE wörds éa"),
]
_DOC, _ITEM = "doc_id bigint, text string, _data string, window int", "item_id bigint, text string, words string, item int"


def frames(spark):
    return spark.createDataFrame([(*d, "x", 1) for d in DOCS], _DOC), spark.createDataFrame([(*d, "x", 1) for d in ITEMS], _ITEM)


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


def test_equal_to_a_plain_search_at_any_number_of_automata(spark):
    docs, items = frames(spark)
    for limit in (leaks.MAX_WINDOWS, 3):
        got = leaks.leak_digests(leaks.leaks(docs, items, limit=limit)).collect()
        assert order(map(tuple, got)) == order(plain(DOCS, ITEMS))


def test_spans_are_places_of_the_original_text(spark):
    docs, items = frames(spark)
    texts = {i: t for i, t in DOCS}
    for r in leaks.leaks(docs, items).collect():
        cut = [texts[r.doc_id][s.start : s.end] for s in r.spans]
        assert sum(len(plain_words(c)) for c in cut) == r.n_hit
        if r.doc_id == 1:
            assert cut == ["THE quick, brown fox jumps -- over the lazy dog and runs away home"]
        if r.doc_id == 10:
            assert not cut  # only A-Z is lower-cased


def test_given_tables_and_empty_tables(spark):
    docs, items = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("documents", "benchmark"))
    got = leaks.leak_digests(leaks.leaks(docs, items)).collect()
    rows = [tuple(r) for r in docs.orderBy("doc_id").limit(20).select("doc_id", "text").collect()]
    kept = {r[0] for r in rows}
    assert order(tuple(r) for r in got if r.doc_id in kept) == order(plain(rows, [tuple(r) for r in items.select("item_id", "text").collect()]))
    assert any(r.contaminated for r in got) and len(got) == docs.count()
    assert leaks.leaks(docs.limit(0), items).count() == 0
    assert leaks.leaks(docs, items.limit(0)).where("n_hit > 0 OR size(item_ids) > 0").count() == 0
