"""Corpus operators: SQL, plain versions, and odd inputs."""

import hashlib
import math
import os
import random
import re
import time
import zlib

import pytest
import sentencepiece
from check import database, difference
from conftest import SF_DIR

from corpus_pipeline import STAGES
from millrace.llm import fingerprints, licences, mix, near, pieces, private, quality, repeats, toxicity, urls
from millrace.llm.oracle import ORACLE
from millrace.llm.queries import PIECE_MODEL, QUERIES, URL_RULES

ODD = [
    (1, "one two three\nfour five six", "s", "x"), (1, "one two three\nfour five six", "s", "x"), (2, None, None, None),
    (None, "mail a.b@c.example.org now", "s", "x"), (4, "", "t", "x"), (5, "long " * 30_000, "t", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, "doc_id bigint, text string, source string, rank string")


@pytest.fixture(scope="module")
def documents(spark):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_same_rows_as_sql(spark, name):
    got = QUERIES[name](spark, SF_DIR).toPandas()
    assert difference(got, database(SF_DIR).execute(ORACLE[name]).df()) is None


def test_odd_and_empty_tables(spark, odd):
    table = pieces.Pieces.read(PIECE_MODEL)
    model = toxicity.Model(weights={"long": 1.0})
    for f in (
        quality.quality_verdicts, quality.quality_filter, repeats.without_repeats, near.near_components, near.near_filter,
        fingerprints.neighbours_compared, lambda d: private.private_filter(d, "k"), licences.licence_scan, mix.taken_words,
        lambda d: toxicity.scored(d, model), lambda d: pieces.encoded(d, table, limit=50),
    ):
        n = f(odd).count()
        assert n == len(ODD) or f in (quality.quality_filter, near.near_filter)
        assert f(odd.limit(0)).count() == 0
    assert mix.mixed_documents(odd).columns == odd.columns and mix.mixed_documents(odd.limit(0)).count() == 0


def test_hosts_are_shrunk_before_they_are_judged(spark):
    good, bad = " ".join(f"w{i}" for i in range(80)), "x"
    rows = [(i, good, f"h{i % 40}") for i in range(2000)] + [(9000 + i, bad if i % 10 else good, "junk") for i in range(300)]
    rows += [(9999, bad, "small"), (9998, good, "small"), (9997, good, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = {r.doc_id: r for r in quality.quality_verdicts(docs).collect()}
    assert out[9000].host_rejected and not out[9000].base_failed and not out[9000].kept
    assert out[9998].kept and out[9997].kept and out[5].kept and not out[9999].kept


def test_near_components_equal_all_pairs(spark, documents):
    got = {r.doc_id: r for r in near.near_components(spark.createDataFrame(list(documents.items()), "doc_id bigint, text string")).collect()}
    sets = {}
    for i, t in documents.items():
        w = near.near_words(t)
        sets[i] = set(zip(*[w[k:] for k in range(5)])) if len(w) >= 5 else {tuple(w)} if w else set()
    root = {i: i for i in sets}
    for i in sorted(sets):
        for j in sorted(sets):
            both = len(sets[i] & sets[j]) if j < i else 0
            if both and 100 * both >= 85 * len(sets[i] | sets[j]):
                lo, hi = sorted((root[i], root[j]))
                root = {k: lo if v == hi else v for k, v in root.items()}
    assert {i: (r.component_id, r.n_shingles) for i, r in got.items()} == {i: (root[i], len(sets[i])) for i in sets}


def test_a_chain_of_near_copies_is_one_component(spark):
    """Neighbours are linked, ends are not, and blocks have to find the links the centre does not have."""
    base = [f"w{i}" for i in range(400)]
    rows = [(k, " ".join([*(f"v{k}_{i}" if i < 4 * k else w for i, w in enumerate(base))])) for k in range(40)]
    rows += [(100 + k, " ".join(f"v{min(k, 39)}_{i}" if i < 4 * k else w for i, w in enumerate(base))) for k in range(3)]
    got = near.near_components(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    sets = {i: set(zip(*[t.split()[k:] for k in range(5)])) for i, t in rows}
    root = {i: i for i in sets}
    for i in sets:
        for j in sets:
            if i != j and 100 * len(sets[i] & sets[j]) >= 85 * len(sets[i] | sets[j]):
                lo, hi = sorted((root[i], root[j]))
                root = {k: lo if v == hi else v for k, v in root.items()}
    assert {r.doc_id: r.component_id for r in got} == root


def test_repeats_equal_a_plain_version(spark, documents):
    first, words = {}, {i: (t or "").encode().split() for i, t in sorted(documents.items())}
    for i, w in words.items():
        for g in zip(*[w[k:] for k in range(13)]):
            first.setdefault(g, i)
    got = {r.doc_id: r for r in repeats.without_repeats(spark.createDataFrame(list(documents.items()), "doc_id bigint, text string")).collect()}
    for i, w in words.items():
        gone = {p + k for p, g in enumerate(zip(*[w[k:] for k in range(13)])) if first[g] < i for k in range(13)}
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        assert (got[i].n_removed, got[i].kept_sha256) == (len(gone), hashlib.sha256(kept).hexdigest())


def test_fingerprints_follow_the_texts(spark, documents):
    got = {r.doc_id: r for r in fingerprints.neighbours_compared(spark.createDataFrame(list(documents.items()), "doc_id bigint, text string")).collect()}
    ids = sorted(documents)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        t, n = documents[i], len(documents[i])
        edited = t[: n - n // 2] + documents[after][: n // 2]
        assert got[i].fingerprint == fingerprints.fingerprint(t) and got[i].edited_fingerprint == fingerprints.fingerprint(edited)
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()


def plain_sketch(text):
    """Phrases kept as byte strings, hashed one by one: the smallest of the distinct 32-bit values."""
    phrases, grown = set(), b""
    for c in text.encode():
        grown += bytes([c])
        if grown not in phrases:
            phrases.add(grown)
            grown = b""
    values = set()
    for phrase in phrases:
        x = 0
        for c in phrase:
            x = (x * 1000003 + c + 1) % 2**60
        x = (x ^ (x >> 32)) * 0xD6E8FEB86659FD93 % 2**64
        x = (x ^ (x >> 29)) * 0x9FB21C651E98DF25 % 2**64
        values.add((x ^ (x >> 32)) >> 32)
    return sorted(values)[: fingerprints.SIZE]


def test_fingerprints_equal_a_plain_parse(spark, documents):
    texts = {**dict(sorted(documents.items())[:60]), 10**6: "", 10**6 + 1: "aaaaaaaa" * 40, 10**6 + 2: "aaaaaaaa" * 40, 10**6 + 3: "é中😀" * 7}
    got = {r.doc_id: r for r in fingerprints.neighbours_compared(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()}

    def alike(a, b):
        union = sorted(set(a) | set(b))[: fingerprints.SIZE]
        return sum(x in a and x in b for x in union) / len(union) if a and b else float(a == b)

    ids = sorted(texts)
    for i, after in zip(ids, ids[1:] + ids[:1]):
        text, n = texts[i], len(texts[i])
        own, other = plain_sketch(text), plain_sketch(text[: n - n // 2] + texts[after][: n // 2])
        assert got[i].fingerprint == "".join(f"{x:08x}" for x in own) and got[i].edited_fingerprint == "".join(f"{x:08x}" for x in other)
        assert got[i].n_chars == n and got[i].near_edited == pytest.approx(alike(own, other))
        assert got[i].near_next == pytest.approx(alike(own, plain_sketch(texts[after])))


def test_surrogates_are_distinct_coreferent_and_formatted(spark):
    text = "Mrs. Anna Smith +1 (017) 555-7713 and +1 017 555 7713, 4111 1111 1111 1111, n@x.org N@X.ORG"
    rows = [(i, f"p{i}@q.org {text}") for i in range(60)]
    out = private.replaced(spark.createDataFrame(rows, "doc_id bigint, text string"), "k").collect()
    assert len({r.text.split()[0] for r in out}) == 60 and all(r.text.split()[0].endswith(".org") for r in out)
    one = out[0].text
    assert "Smith" not in one and one.split("Mrs. ")[1].split()[0] in private.NAMES["f", "latin"]
    digits = ["".join(c for c in x if c.isdigit()) for x in (one.split("+")[1], one.split("+")[2].split(",")[0])]
    assert digits[0] == digits[1] and digits[0][0] == "1"
    assert one.split()[-1] == one.split()[-2].upper() and not any(x in one for x in ("555", "4111", "n@x", "Smith"))


def test_pieces_equal_the_library_and_round_trip(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    texts = {**documents, -1: "  two  spaces \n\t中\U0001f600é ", -2: "x" * 200, -3: ""}
    table = pieces.Pieces.read(PIECE_MODEL)
    got = pieces.encoded(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string"), table, limit=5000).collect()
    assert all(list(r.ids) == library.encode(texts[r.doc_id]) and r.round_trip for r in got)


def test_near_filter_passes_columns_of_any_name(spark):
    rows = spark.createDataFrame([(1, "a b c", "x", 1), (2, "a b c", "y", 2), (3, None, "z", 3)], "doc_id bigint, text string, _dropped string, cls int")
    assert sorted(map(tuple, near.near_filter(rows).collect())) == [(1, "a b c", "x", 1), (3, None, "z", 3)]


def test_long_words_take_little_time():
    """A megabyte without a space; the library agrees on what is long enough to be hard."""
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    encoder = pieces.Encoder(pieces.Pieces.read(PIECE_MODEL), {})
    draw = random.Random(2)
    for text in ("ab" * 3000, "".join(draw.choice("etaoinshr") for _ in range(20_000)), "中文" * 500 + "x"):
        assert encoder.encode(text) == library.encode(text)
    start = time.monotonic()
    assert len(encoder.encode("".join(draw.choice("etaoinshrdlu") for _ in range(1 << 20)))) > 100_000
    assert time.monotonic() - start < 60


def test_words_are_merged_by_halves_and_texts_read_back_at_once(documents, monkeypatch):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    encoder = pieces.Encoder(pieces.Pieces.read(PIECE_MODEL), {}, limit=500)
    draw, whole = random.Random(5), []
    letters = ["a", "aa", "e", "é", "ing", "tion", "ss", "\u4e2d", "\U0001f600", "\u0301", ",", ".", "--", "9"]
    texts = [*documents.values(), "", "\u2581x\u2581", " \n\n  a"]
    texts += [" ".join("".join(draw.choice(letters) for _ in range(draw.randrange(1, 12))) for _ in range(40)) for _ in range(150)]
    merge = encoder._merged_short
    monkeypatch.setattr(encoder, "_merged_short", lambda word: whole.append(word) or merge(word))
    ids, begins = encoder.encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == [library.encode(t) for t in texts]
    assert encoder.decode_all(ids, begins) == [encoder.decode(library.encode(t)) for t in texts]
    words = {w for t in texts if t for w in encoder.find("\u2581" + t.replace(" ", "\u2581")) if pieces._WHOLE <= len(w) <= pieces._SHORT}
    assert len(words.intersection(whole)) < len(words) / 2
    assert [x for a, b in pieces._together(["ab" * 10**6, "", "c"]) for x in range(a, b)] == [0, 1, 2] and not list(pieces._together([]))


def test_unigram_lattice_equals_the_plain_recursion(spark):
    scores = {"▁": -3.0, "a": -2.0, "b": -2.5, "c": -4.0, "ab": -3.1, "bc": -3.0, "▁a": -3.5, "abc": -5.9, "ca": -3.3}
    ids = {p: 300 + i for i, p in enumerate(scores)}
    table = pieces.Pieces.of(ids, scores, tuple(range(256)), tuple([""] * 300 + list(scores)), "unigram")
    words = ["▁abcab", "▁cabé", "abc", "▁", "ccabca"]
    got = pieces.encoded_words(spark.createDataFrame([(w,) for w in words], "word string"), table).collect()
    plain = pieces.Encoder(table, {})
    assert {r.word: tuple(r.ids) for r in got} == {w: plain.folded(w) for w in words}


def test_cascade_is_exact_and_agrees_with_the_join(spark):
    rows = [(i, f"https://h{i}.example.org/p{i % 7}/x") for i in range(3000)] + [(-1, None), (-2, "x.org/a"), (-3, "a://H5.EXAMPLE.org/p5/")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string")
    rules = [(f"h{i}.example.org/p{i % 7}/", "block" if i % 3 else "allow") for i in range(0, 3000, 5)] + [("org/p3", "block")]
    rules = spark.createDataFrame(rules, "rule string, verdict string")
    cascade = {r.page_id: r for r in urls.url_verdicts(pages, rules).collect()}
    joined = {r.page_id: r for r in urls.url_verdicts(pages, rules, max_words=0).collect()}
    assert cascade == joined and cascade[-1].verdict == "allow" and cascade[-3].rule == "h5.example.org/p5/"
    assert urls.url_verdicts(pages, rules.limit(0)).where("verdict = 'block'").count() == 0 and len(URL_RULES) == 5
    assert urls.url_verdicts(pages.limit(0), rules).count() == 0


def test_cascade_of_rules_of_many_shapes(spark):
    """200 path lengths and 6 label counts: a plain loop's answers, and no join in the plan."""
    draw = random.Random(5)
    hosts = [".".join(f"{draw.choice('abc')}{k}" for k in range(n, 0, -1)) for n in range(1, 7) for _ in range(12)]
    deep = "/" + "".join(draw.choice("xy/") for _ in range(220))
    rules = {f"{draw.choice(hosts)}{deep[:m]}": draw.choice(("block", "allow")) for m in range(1, 201)}
    rules |= {f"{h}/": draw.choice(("block", "allow")) for h in hosts[::5]}
    rows = [(i, f"s://{draw.choice(hosts)}{deep[: draw.randrange(220)]}?q") for i in range(600)] + [(-1, None), (-2, "s://a1"), (-3, "s://" + "a." * 900 + "a1/x")]
    made = spark.createDataFrame(list(rules.items()), "rule string, verdict string")
    out = urls.url_verdicts(spark.createDataFrame(rows, "page_id bigint, url string"), made)
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()
    for r in out.collect():
        fits = [k for k in rules if (r.host == k.split("/")[0] or r.host.endswith("." + k.split("/")[0])) and r.path.startswith(k[k.index("/") :])]
        best = max(fits, key=lambda k: (len(k), k.count(".", 0, k.index("/"))), default=None)
        assert (r.rule, r.verdict) == (best, rules.get(best, "allow"))


def test_mix_meets_targets(spark):
    d = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mix.taken_words(d).join(d.select("doc_id", "source"), "doc_id").toPandas()
    assert (rows.taken <= 3 * rows["size"]).all()
    by = rows.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), size=("size", "sum"))
    assert by.target.sum() == pytest.approx(by["size"].sum()) and ((by.taken - by.target).abs() <= 2 * mix.BLOCK).all()
    again = mix.taken_words(d.repartition(5)).toPandas().sort_values("doc_id")
    assert again.taken.tolist() == rows.sort_values("doc_id").taken.tolist()


def test_toxicity_on_held_out_documents(spark):
    large = os.path.join(os.path.dirname(SF_DIR), "sf0.1")
    docs, labels = spark.read.parquet(f"{large}/documents.parquet"), spark.read.parquet(f"{large}/labels.parquet")
    model = toxicity.fit(toxicity.training_rows(docs, labels))
    x = toxicity.scored(docs, model).join(labels, "doc_id").where("held_out").toPandas()
    assert (x.predicted == x.toxic).mean() > 0.96 and (x[x.toxic == 0].predicted).mean() < 0.01


def test_toxicity_does_not_rise_with_length(spark):
    """Scores of the plain formula; clean sentences stay clean in any number, and one bad sentence is found among them."""
    model = toxicity.Model(-5.0, {"day": 0.1, "vile": 14.0, "vil*": 1.0})
    score = model.scorer()
    texts = ["fine day. " * n for n in (1, 1000, 100_000)] + ["fine day. " * 500 + "So vile! " + "Fine day. " * 500, "", None, "1. 2. 3"]
    for text in texts:
        bags = [set(w) for s in re.split(r"[.!?\n]", text or "") if (w := re.findall(r"[^\W\d_]+", s.lower()))]
        clean = 1.0
        for bag in bags:
            z = model.bias - math.log(len(bags)) + sum(model.weights.get(f, 0) for f in {f for w in bag for f in toxicity.features_of(w)})
            clean *= 1 - 1 / (1 + math.exp(-z))
        value, n, found = score(text)
        assert value == pytest.approx(1 - clean, abs=1e-9) and n == len(bags) and [text[x["start"] : x["end"]] for x in found] == [" So vile"] * ("vile" in (text or ""))
        assert value < 0.01 or "vile" in text
    untrained = toxicity.Model().scorer()
    assert untrained("A clean one. " * 400)[0] < 0.01


def test_toxicity_without_labels_of_both_kinds(spark):
    docs = spark.createDataFrame([(i, "vile day" if i % 2 else "fine day") for i in range(1, 40)] * 2, "doc_id bigint, text string")
    for rows in ([], [(i, 0) for i in range(40)], [(i, 1) for i in range(40)], [(i, None) for i in range(40)]):
        model = toxicity.fit(toxicity.training_rows(docs, spark.createDataFrame(rows, "doc_id bigint, toxic int")))
        assert model == toxicity.Model()
        out = toxicity.scored(docs, model).collect()
        assert len(out) == 78 and not any(r.predicted for r in out)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 3, "doc_id bigint, toxic int")
    rows = toxicity.training_rows(docs, labels)
    assert rows.count() == len({i for i in range(1, 40) if zlib.crc32(str(i).encode()) % 5})
    assert all(r.predicted == r.doc_id % 2 for r in toxicity.scored(docs, toxicity.fit(rows)).collect())


def test_pipeline_stages(spark, fresh_dir):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    for name, stage in STAGES:
        stage(spark, docs, SF_DIR).write.parquet(f"{fresh_dir}/{name}")
        docs = spark.read.parquet(f"{fresh_dir}/{name}")
        assert docs.count() > 0 and (docs.columns == columns or name == STAGES[-1][0])


def test_pipeline_stages_on_odd_and_empty_documents(spark, fresh_dir):
    """NULLs, empty texts, repeated rows and an empty table pass through every stage, each on its own input."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = docs.limit(3).union(docs.limit(3)).collect()
    blank = tuple(None for _ in docs.columns)
    at = docs.columns.index("text")
    rows += [blank, (*rows[0][:at], "", *rows[0][at + 1 :]), (*rows[0][:at], None, *rows[0][at + 1 :])]
    odd = spark.createDataFrame([tuple(r) for r in rows], docs.schema)
    for kind, given in (("odd", odd), ("none", odd.limit(0))):
        for name, stage in STAGES:
            stage(spark, given, SF_DIR).write.parquet(f"{fresh_dir}/{kind}-{name}")
            out = spark.read.parquet(f"{fresh_dir}/{kind}-{name}")
            assert out.columns == docs.columns or name == STAGES[-1][0]
            assert (out.count() == 0) == (kind == "none")
            if name in ("private_surrogates", "piece_encoding"):
                assert out.count() == given.count()
