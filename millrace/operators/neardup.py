"""Near-duplicate units: MinHash buckets, confirmed links, the first of each group stays. No Python in the tasks.

A unit's set are the hashes of its 5-word shingles; two units are near if their sets' Jaccard similarity reaches a limit.
`BANDS * ROWS` minima of the set make a bucket per band. Work inside a bucket is linear in its units: they are taken
in input order, each joins the first leader it is near to, or else becomes a leader. Rounds do this for all buckets at once, with one
leader each at first, so a bucket of near copies, however large, is done after one comparison per unit; what is left meets
`LEADERS` times as many units as the bucket's last round had leaders, `MOST` at most. So no two kept units that share a bucket are
near, and links connect each dropped one with an earlier kept one.

Units of a bucket are compared by their parities first: `PARITIES * 64` bits that each element of a set turns over. Bits that differ
are at most as many as elements that differ, so a pair beyond the limit there is not near; it is dropped in the join that makes
it. Sets, which are larger than the texts, are made again for the units that share a bucket, and moved for the other pairs only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.operators.filters import exact_dedup, input_order
from millrace.sources.scratch import small_side, written_table

SHINGLE_WORDS = 5
BANDS, ROWS = 16, 4
#: Modulus of the hash family `(a * x + b) % PRIME`: products stay below 2^62.
PRIME = 2**31 - 1
LEADERS = 32
#: Up to 1,000 units of a bucket are found before the shuffle (`spark.sql.optimizer.windowGroupLimitThreshold`).
MOST = 1000
PARITIES = 16
_PARITY = [f"p{k}" for k in range(PARITIES)]


def coefficients() -> list[tuple[int, int]]:
    """`a` and `b` of each hash function, from the SHA-256 of its number."""
    digests = [hashlib.sha256(f"minimum {k}".encode()).hexdigest() for k in range(BANDS * ROWS)]
    return [(int(d[:12], 16) % (PRIME - 1) + 1, int(d[12:24], 16) % PRIME) for d in digests]


def shingle_set(text: Column) -> Column:
    """Distinct 60-bit hashes of the shingles; a text of fewer words is one shingle, one without words has none."""

    def shingles(words: Column) -> Column:
        several = F.transform(
            F.sequence(F.lit(1), F.size(words) - SHINGLE_WORDS + 1),
            lambda i: F.array_join(F.slice(words, i, SHINGLE_WORDS), " "),
        )
        return F.when(F.size(words) < SHINGLE_WORDS, F.array(F.array_join(words, " "))).otherwise(several)

    def hashed(trimmed: Column) -> Column:
        texts = bind(F.split(trimmed, r"[\x20\x09-\x0D]+", -1), shingles)
        hashes = F.transform(texts, lambda s: F.conv(F.substring(F.sha2(s, 256), 1, 15), 16, 10).cast("bigint"))
        return F.when(trimmed != "", F.array_distinct(hashes)).otherwise(F.array().cast("array<bigint>"))

    return bind(F.btrim(text, F.lit(" \t\n\x0b\x0c\r")), hashed)


def signatures(sets: DataFrame) -> DataFrame:
    """`unit, n, buckets, p0, ...` of each unit (`unit`, `hashes`) with a set: its size, a bucket of each band, its parities.

    They are plain aggregates over exploded hashes: compiled code, and partial results leave one row per unit to shuffle.
    """
    # An inner explode would be given a filter on the array's size, which makes the array twice.
    hashes = sets.select("unit", F.explode_outer("hashes").alias("hash")).where("hash IS NOT NULL")
    x, word = F.col("hash") % PRIME, F.shiftright("hash", 6).bitwiseAND(F.lit(PARITIES - 1))
    minima = [F.min((x * a + b) % PRIME).alias(f"m{k}") for k, (a, b) in enumerate(coefficients())]
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("hash").bitwiseAND(F.lit(63)).cast("int"))
    parities = [F.bit_xor(F.when(word == k, bit).otherwise(F.lit(0).cast("bigint"))).alias(p) for k, p in enumerate(_PARITY)]
    signed = hashes.groupBy("unit").agg(F.count(F.lit(1)).alias("n"), *minima, *parities)
    bands = [F.xxhash64(F.lit(k), *(f"m{k * ROWS + r}" for r in range(ROWS))) for k in range(BANDS)]
    return signed.select("unit", "n", F.array(*bands).alias("buckets"), *_PARITY)


def buckets(sets: DataFrame) -> DataFrame:
    """`bucket, unit, n` of each band of each unit (`unit`, `hashes`); `n` is the size of the set."""
    return signatures(sets).select("unit", "n", F.explode("buckets").alias("bucket"))


def sharing(signed: DataFrame) -> DataFrame:
    """`bucket, unit, n, p0, ...` of the buckets that several units share."""
    every = signed.select("unit", F.explode("buckets").alias("bucket"))
    shared = every.groupBy("bucket").agg(F.count(F.lit(1)).alias("units")).where("units > 1")
    return every.join(shared.select("bucket"), "bucket", "left_semi").join(signed.drop("buckets"), "unit")


def candidates(heads: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Pairs of a bucket, with the columns of `members` and `rank` and `head` of an earlier unit, that may be near."""
    first = heads.select("bucket", "rank", F.col("unit").alias("head"), F.col("n").alias("n_head"), *(F.col(p).alias(f"h{p}") for p in _PARITY))
    # Sets of too different a size can't be near, nor those with more elements in one of them alone than the limit leaves.
    alike = 100 * F.least("n", "n_head") >= percent * F.greatest("n", "n_head")
    apart = sum((F.bit_count(F.col(p).bitwiseXOR(F.col(f"h{p}"))) for p in _PARITY), F.lit(0))
    close = (100 + percent) * apart <= (100 - percent) * (F.col("n") + F.col("n_head"))
    return members.join(first, "bucket").where((F.col("head") < F.col("unit")) & alike & close)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The `head, unit` pairs whose sets are near."""
    pairs = written_table(pairs.select("head", "unit").distinct(), "near-candidates")
    units = pairs.select(F.explode(F.array("head", "unit")).alias("unit")).distinct()
    some = sets.join(small_side(units, "near-ids"), "unit", "left_semi")
    head = some.select(F.col("unit").alias("head"), F.col("hashes").alias("_a"))
    both = pairs.join(head, "head").join(some.withColumnRenamed("hashes", "_b"), "unit")
    shared = F.size(F.array_intersect("_a", "_b"))
    return both.where(100 * shared >= percent * (F.size("_a") + F.size("_b") - shared)).select("head", "unit")


def _leaders(heads: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The heads that join no earlier leader."""
    later = heads.select("bucket", "unit", "n", *_PARITY, F.col("rank").alias("later"))
    pairs = written_table(candidates(heads, later, percent).select("bucket", "rank", "head", "later", "unit"), "near-pairs")
    among = pairs.join(confirmed(pairs, sets, percent), ["head", "unit"])
    # In the order of the later one: what is said of the earlier one is final.
    among = among.groupBy("bucket").agg(F.array_sort(F.collect_list(F.struct("later", "rank"))).alias("pairs"))

    def step(joined: Column, p: Column) -> Column:
        known = F.array_contains(joined, p["later"]) | F.array_contains(joined, p["rank"])
        return F.when(known, joined).otherwise(F.concat(joined, F.array(p["later"])))

    joined = F.aggregate("pairs", F.array().cast("array<int>"), step)
    return heads.join(among.select("bucket", F.explode(joined).alias("rank")), ["bucket", "rank"], "left_anti")


def _round(members: DataFrame, sets: DataFrame, most: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """Links (`head, unit`) of the first units of each bucket with the others, and the members that are left."""
    rank = F.row_number().over(Window.partitionBy("bucket").orderBy("unit"))
    heads = members.withColumn("rank", rank).where((F.col("rank") <= most) & (F.col("rank") <= F.col("heads"))).drop("heads")
    leaders = heads = written_table(heads, "near-heads")
    if most > 1:
        leaders = written_table(_leaders(heads, sets, percent), "near-leaders")
    pairs = written_table(candidates(leaders, members, percent).select("bucket", "head", "unit"), "near-pairs")
    near = written_table(confirmed(pairs, sets, percent), "near-pairs")
    first = pairs.join(near, ["head", "unit"]).groupBy("bucket", "unit").agg(F.min("head").alias("head"))
    first = written_table(first, "near-links")
    done = first.select("bucket", "unit").unionByName(heads.select("bucket", "unit"))
    heads = leaders.groupBy("bucket").agg((F.count(F.lit(1)) * LEADERS).alias("heads"))
    left = members.drop("heads").join(done, ["bucket", "unit"], "left_anti").join(heads, "bucket")
    return first.select("head", "unit").distinct(), written_table(left, "near-left")


def links(members: DataFrame, sets: DataFrame, percent: int = 80) -> list[DataFrame]:
    """`head, unit` tables of all rounds over the members of shared buckets."""
    members, found, most = members.withColumn("heads", F.lit(1).cast("bigint")), [], 1
    while not members.isEmpty():
        edges, members = _round(members, sets, most, percent)
        found.append(edges)
        most = min(most * LEADERS, MOST)
    return found


def components(edges: DataFrame, high: str, low: str) -> DataFrame:
    """`unit, first` of every unit that is connected to a smaller one, from edges of any order; alternating stars.

    A unit's neighbours are never gathered: each star is a minimum and a join, which Spark splits where a unit is hot.
    """
    ends = edges.select(F.greatest(high, low).alias("a"), F.least(high, low).alias("b")).where("a <> b").distinct()
    state, before = written_table(ends, "near-stars"), None
    while True:
        both = state.unionByName(state.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m"))
        wide = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.least("m", "a").alias("b")).distinct()
        wide = written_table(wide, "near-stars")
        least = wide.groupBy("a").agg(F.min("b").alias("m"))
        narrow = wide.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        state = written_table(narrow.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "near-stars")
        after = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if after == before:
            return state.select(F.col("a").alias("unit"), F.col("b").alias("first"))
        before = after


def near_dedup(units: DataFrame, order: Sequence[Column] | None = None, percent: int = 80) -> DataFrame:
    """Keep, in input order, the first of units whose bodies are equal or linked as near copies.

    Units without words are no near copies of anything. Equal bodies go first, so that they are compared once.
    """
    columns = units.columns
    first = exact_dedup(units, order).sort(*(order or input_order())).withColumn("_unit", F.monotonically_increasing_id())
    first = written_table(first, "near-units")
    sets = first.select(F.col("_unit").alias("unit"), shingle_set(F.col("body")).alias("hashes"))
    members = written_table(sharing(written_table(signatures(sets), "near-signatures")), "near-members")
    compared = small_side(members.select(F.col("unit").alias("_unit")).distinct(), "near-compared")
    again = first.join(compared, "_unit", "left_semi")
    sets = written_table(again.select(F.col("_unit").alias("unit"), shingle_set(F.col("body")).alias("hashes")), "near-sets")
    found = links(members, sets, percent)
    if not found:
        return first.select(columns)
    edges = found[0]
    for more in found[1:]:
        edges = edges.unionByName(more)
    dropped = components(edges, "head", "unit").select(F.col("unit").alias("_unit"))
    return first.join(dropped, "_unit", "left_anti").select(columns)
