"""Near-duplicate units against all pairs, and in one hot bucket."""

import random
import re

from pyspark.sql import functions as F

from conftest import SF_DIR
from millrace.operators import neardup
from millrace.sources import scratch


def shingles(body):
    words = re.findall(r"[^\x20\x09-\x0D]+", body)
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def near(a, b, percent=80):
    return bool(a) and bool(b) and 100 * len(a & b) >= percent * len(a | b)


def kept(spark, rows, **options):
    units = spark.createDataFrame(rows, "file_path string, line_number bigint, body string")
    return {r.file_path for r in neardup.near_dedup(units, **options).collect()}


def all_pairs(rows):
    """First unit, in order, of each component of all near pairs."""
    sets, root = [shingles(b) for _, _, b in rows], list(range(len(rows)))
    for j in range(len(rows)):
        for i in range(j):
            if root[i] != root[j] and (rows[i][2] == rows[j][2] or near(sets[i], sets[j])):
                low, high = sorted((root[i], root[j]))
                root = [low if r == high else r for r in root]
    return {rows[i][0] for i in set(root)}


def test_documents_like_all_pairs(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    rows = [(f"d{r.doc_id:06}.go", 1, r.text) for r in docs]
    assert kept(spark, rows) == all_pairs(rows)


def changed(words, places):
    return " ".join(f"{w}_" if i in places else w for i, w in enumerate(words))


def test_groups_chains_short_and_empty_units(spark):
    draw = random.Random(4)
    base = [f"t{draw.randrange(10**6)}" for _ in range(300)]
    rows = [(f"a{k:03}.go", 1, changed(base, {k})) for k in range(120)]  # one hot bucket of near copies
    rows += [(f"b{k:02}.go", 1, changed([f"u{w}" for w in base], set(range(4 * k)))) for k in range(12)]  # a chain
    rows += [("c1.go", 1, "only four words here"), ("c2.go", 1, "only  four words\there"), ("c3.go", 1, "only four words"), ("c4.go", 1, "")]
    rows += [("c5.go", 1, " \n"), ("c6.go", 1, None), ("c7.go", 1, "")]
    got = kept(spark, rows)
    assert {p for p in got if p[0] == "a"} == {"a000.go"} and {p for p in got if p[0] == "b"} == {"b00.go"}
    assert {p for p in got if p[0] == "c"} == {"c1.go", "c3.go", "c4.go", "c5.go", "c6.go"}
    assert kept(spark, []) == set()


def test_no_two_kept_units_of_a_bucket_are_near(spark):
    """Units that are alike, but mostly below the limit: many leaders in one bucket, several rounds."""
    draw = random.Random(8)
    base = [f"t{i}" for i in range(200)]
    rows = [(f"f{k:03}.go", 1, changed(base, set(draw.sample(range(200), draw.choice([3, 12, 14]))))) for k in range(150)]
    got, sets = kept(spark, rows), {p: shingles(b) for p, _, b in rows}
    units = spark.createDataFrame([(i, b) for i, (_, _, b) in enumerate(rows)], "unit long, body string")
    signed = neardup.buckets(units.select("unit", neardup.shingle_set(F.col("body")).alias("hashes"))).collect()
    by = {}
    for r in signed:
        by.setdefault(r.bucket, set()).add(rows[r.unit][0])
    assert 1 < len(got) < len(rows) and max(map(len, by.values())) > neardup.LEADERS
    pairs = {(a, b) for m in by.values() for a in m for b in m if a < b}
    alike: dict = {p: set() for p in sets}
    for a, b in pairs:
        if near(sets[a], sets[b]):
            assert not {a, b} <= got
            alike[a].add(b)
            alike[b].add(a)
    for p in sets.keys() - got:
        reached = {p}
        while more := {b for a in reached for b in alike[a]} - reached:
            reached |= more
        assert min(reached) < p and min(reached) in got


def test_unlike_units_of_a_bucket_take_few_rounds_and_no_sets(spark):
    """Units that share a passage, but are not near: no round for each 32 of them, and their sets are not compared."""
    draw = random.Random(9)
    base = [f"t{i}" for i in range(170)]
    rows = [(f"g{k:03}.go", 1, " ".join(base + [f"o{draw.randrange(10**6)}" for _ in range(35)])) for k in range(300)]
    since = len(scratch.made_paths())
    assert kept(spark, rows) == {p for p, _, _ in rows}
    made = [p.rsplit("/", 1)[1] for p in scratch.made_paths(since)]
    assert sum(p.startswith("near-left") for p in made) <= 3
    units = spark.createDataFrame([(i, b) for i, (_, _, b) in enumerate(rows)], "unit long, body string")
    members = neardup.sharing(neardup.signatures(units.select("unit", neardup.shingle_set(F.col("body")).alias("hashes"))))
    assert members.groupBy("bucket").count().agg(F.max("count")).first()[0] > 3 * neardup.LEADERS
    heads = members.withColumn("rank", F.lit(1))
    assert neardup.candidates(heads, members, 80).count() == 0


def test_near_pairs_pass_the_parities(spark):
    """Sets of 5 to 5,000 elements at the limit: as many elements apart as it allows, or one more."""
    sets, want = [], set()
    for k, n in enumerate([5, 9, 90, 900, 5000]):
        both = list(range(k * 10**7, k * 10**7 + 64 * n, 64))
        apart = (len(both) + 3) // 4
        for more in (0, 1):
            unit = 4 * k + 2 * more
            least = apart if more else len(both) // 4
            sets += [(unit, [7 * h for h in both]), (unit + 1, [7 * h for h in both] + [-1 - 11 * i for i in range(least)])]
            if 100 * len(both) >= 80 * (len(both) + least):
                want.add((unit, unit + 1))
    signed = neardup.signatures(spark.createDataFrame(sets, "unit long, hashes array<long>"))
    members = signed.drop("buckets").withColumn("bucket", F.col("unit") - F.col("unit") % 2)
    pairs = neardup.candidates(members.withColumn("rank", F.lit(1)), members, 80)
    assert want and want <= {(r.head, r.unit) for r in pairs.collect()}


def test_components_of_a_long_chain(spark):
    edges = spark.range(1, 400).selectExpr("id * 7 % 400 AS head", "(id * 7 + 7) % 400 AS unit")
    found = {r.unit: r.first for r in neardup.components(edges, "head", "unit").collect()}
    assert set(found.values()) == {0} and len(found) == 399
