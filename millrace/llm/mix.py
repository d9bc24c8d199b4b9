"""Mixing sources to target weights: blocks of words drawn by source, placed in shards by seeded hashes.

1. Sources by code point (NULL last) weigh 5, 2, 1, repeating. Together they get as many words as there are;
   a target stops at `REPEATS` times its source and what is cut off is shared anew by weight, down
   to one water level: `target = min(3 * size, level * weight)`.
2. A source's documents, in a hashed order, form one run of words, packed into blocks of `BLOCK` words. The
   offsets come from two levels of running sums (hash buckets of a source, as many as its size asks for, then inside a
   bucket), so a source with a third of all rows is no single task.
3. Each source draws whole passes over its blocks and a part of the last one, as many slots as its target needs.
   A slot's shard is a seeded hash: given the totals, the counts per shard are a multinomial draw with
   the target weights, without the noise that drawing the totals as well would add to them.
4. A slot finds its block through a pseudorandom permutation of the source's block numbers, another one for each pass
   (a keyed Feistel network walked back into the range), and blocks join slots by number. No block, hence
   no document, is taken more than `REPEATS` times.

Everything depends on keys and seeds only, so reruns and recomputed tasks agree.

Defined results: NULL and empty texts have size 0 and nothing is taken of them; NULL ids are ids like others;
rows with equal id and text are separate documents that share one place in the order, so what is taken of the one
or of the other is not told apart (the rows as a set agree between runs); an empty table gives an
empty result. Other columns are not read, except by `mixed_documents`, which returns their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.llm.words import small_side
from millrace.sources.scratch import written_table

WEIGHTS = (5, 2, 1)
REPEATS = 3
BLOCK = 64
SHARD_SLOTS = 4096
#: Words of a hash bucket, on average: what one window partition reads besides its last document.
BUCKET_WORDS = 1 << 16
SEED = 17
_WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, keep: list[str], doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """`_id, _source, _size, _order, _tie` and the `keep` columns of each row."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    # The order spreads over the hash range, whatever the ids look like.
    return docs.select(
        F.col(doc_id).alias("_id"),
        F.col(source).alias("_source"),
        F.regexp_count(body, F.lit(_WORD)).cast("bigint").alias("_size"),
        F.xxhash64(F.col(doc_id).cast("string"), F.lit(SEED)).alias("_order"),
        F.xxhash64(body).alias("_tie"),
        *[F.col(c).alias(f"_kept_{c}") for c in keep],
    )


def targets(sized: DataFrame) -> DataFrame:
    """One row per source: size, target, number of blocks and slots, and where its slots begin. Written once."""
    per_source = sized.groupBy("_source").agg(F.sum("_size").alias("source_size"))
    # One row per source from here on; the running sums below never see documents.
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    place = F.row_number().over(by_name) - 1
    s = per_source.withColumn("rank", place)
    s = s.withColumn("weight", F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("rank") % len(WEIGHTS) + 1).cast("int")))
    s = s.withColumn("cap", REPEATS * F.col("source_size")).withColumn("fills_at", F.col("cap") / F.col("weight"))
    filling = Window.orderBy("fills_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum("source_size").over(everything)
    left_words = total - F.coalesce(F.sum("cap").over(filling), F.lit(0))
    left_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0))
    s = s.withColumn("level", left_words / left_weight)
    # The first source, in the order in which they fill up, that is not full at the level left for it and all later ones.
    open_level = F.when(F.col("fills_at") >= F.col("level"), F.struct("fills_at", "rank", "level"))
    s = s.withColumn("level", F.min(open_level).over(everything)["level"])
    target = F.coalesce(F.least(F.col("cap").cast("double"), F.col("level") * F.col("weight")), F.lit(0.0))
    s = s.withColumn("target", F.when(F.col("source_size") == 0, 0.0).otherwise(target))
    s = s.withColumn("blocks", F.ceil(F.col("source_size") / F.lit(BLOCK)))
    slots = F.when(F.col("source_size") == 0, 0).otherwise(F.round(F.col("target") * F.col("blocks") / F.col("source_size")))
    s = s.withColumn("slots", F.least(slots.cast("bigint"), REPEATS * F.col("blocks")))
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    s = s.withColumn("first_slot", F.coalesce(F.sum("slots").over(before), F.lit(0)))
    s = s.withColumn("all_slots", F.sum("slots").over(everything))
    return written_table(s.select("_source", "rank", "source_size", "target", "blocks", "slots", "first_slot", "all_slots"), "mix-targets")


def placed(sized: DataFrame, sources: DataFrame) -> DataFrame:
    """`sized` with its source's columns and `_offset`, the words of the source that come before the document."""
    known = small_side(sources.withColumnRenamed("_source", "_named"))
    rows = sized.join(known, F.col("_source").eqNullSafe(F.col("_named"))).drop("_named")
    buckets = F.greatest(F.lit(1), F.ceil(F.col("source_size") / F.lit(BUCKET_WORDS))).cast("bigint")
    rows = rows.withColumn("_bucket", F.pmod("_order", buckets))
    bucket_sizes = rows.groupBy("rank", "_bucket").agg(F.sum("_size").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = bucket_sizes.select("rank", "_bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("rank", "_bucket").orderBy("_order", "_id", "_size", "_tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("_before", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    return rows.join(starts, ["rank", "_bucket"]).withColumn("_offset", F.col("_start") + F.col("_before")).drop("_start", "_before")


def pieces(rows: DataFrame) -> DataFrame:
    """One row per document and block it reaches into: `block`, `_from` (0-based word of the document), `_n` words."""
    first, last = F.floor(F.col("_offset") / BLOCK), F.floor((F.col("_offset") + F.col("_size") - 1) / BLOCK)
    cut = rows.where("_size > 0").withColumn("block", F.explode(F.sequence(first, last)))
    start = F.greatest(F.col("block") * BLOCK, F.col("_offset"))
    end = F.least((F.col("block") + 1) * BLOCK, F.col("_offset") + F.col("_size"))
    return cut.withColumn("_from", start - F.col("_offset")).withColumn("_n", end - start)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def permuted(i: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """`i` below `n` to its place in the permutation `key` of 0..n-1, elementwise."""
    x, n = i.astype(np.uint64), n.astype(np.uint64)
    bits = np.ceil(np.log2(np.maximum(n, 2).astype(np.float64)) / 2).astype(np.uint64) + np.uint64(1)
    mask = (np.uint64(1) << bits) - np.uint64(1)
    todo = np.arange(len(x))
    while len(todo):
        left, right = x[todo] >> bits[todo], x[todo] & mask[todo]
        for r in range(4):
            left, right = right, left ^ (_mix64(right + key[todo] * np.uint64(4) + np.uint64(r)) & mask[todo])
        x[todo] = (left << bits[todo]) | right
        todo = todo[x[todo] >= n[todo]]
    return x.astype(np.int64)


def _find_blocks(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for f in frames:
        rank, slot, n = (f[c].to_numpy(np.int64) for c in ("rank", "slot", "blocks"))
        passes = slot // np.maximum(n, 1)
        with np.errstate(over="ignore"):
            key = _mix64((rank * REPEATS + passes).astype(np.uint64) + np.uint64(SEED))
            block = permuted(slot % np.maximum(n, 1), n, key)
        yield pd.DataFrame({"rank": rank, "block": block, "number": f["first_slot"] + slot, "all_slots": f["all_slots"]})


def slots(sources: DataFrame) -> DataFrame:
    """`rank, block, number, shard`: every slot of the mix; `number` runs over all sources."""
    step = 1 << 15
    spans = sources.where("slots > 0").select(
        "rank", "blocks", "slots", "first_slot", "all_slots",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slots") - 1, F.lit(step).cast("bigint"))).alias("lo"),
    )
    # The spans of a large source go to many tasks before they are unfolded; a number, as they are too small to be left apart.
    spans = spans.repartition(int(sources.sparkSession.conf.get("spark.sql.shuffle.partitions")), "rank", "lo")
    each = spans.withColumn("slot", F.explode(F.sequence("lo", F.least(F.col("lo") + step, F.col("slots")) - 1)))
    schema = "rank int, block bigint, number bigint, all_slots bigint"
    found = each.select("rank", "slot", "blocks", "first_slot", "all_slots").mapInPandas(_find_blocks, schema)
    shards = F.ceil(F.col("all_slots") / F.lit(SHARD_SLOTS))
    return found.withColumn("shard", F.pmod(F.xxhash64("number", F.lit(SEED)), shards)).drop("all_slots")


def taken_words(docs: DataFrame, **columns: str) -> DataFrame:
    """`doc_id, size, source_size, target, taken` of each row."""
    sized = written_table(sizes(docs, [], **columns), "mix-sizes")
    sources = targets(sized)
    # Rows have no key of their own; their place in the order is one, and it is written with them.
    rows = written_table(placed(sized, sources), "mix-placed")
    used = slots(sources).groupBy("rank", "block").agg(F.count(F.lit(1)).alias("times"))
    # Unfolded spans are far more rows than their source's statistics say: never to be broadcast.
    cut = pieces(rows).select("rank", "_offset", "block", "_n").join(used.hint("merge"), ["rank", "block"])
    taken = cut.groupBy("rank", "_offset").agg(F.sum(F.col("_n") * F.col("times")).alias("taken"))
    # Of the rows at one offset only the one with words takes any.
    result = rows.join(taken, ["rank", "_offset"], "left")
    got = F.when(F.col("_size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("bigint")
    return result.select(
        F.col("_id").alias(columns.get("doc_id", "doc_id")), F.col("_size").alias("size"), "source_size", "target", got.alias("taken")
    )


def mixed_blocks(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix itself: `number, shard, source, block, doc_ids, text`, one row per slot.

    A block's text is the text of its words with the white space that follows each; documents are parted by an empty line.
    """
    # Targets need sizes only; texts move twice, to their place in the source and to their blocks.
    sources = targets(written_table(sizes(docs, [], doc_id, source, text), "mix-sizes"))
    rows = placed(sizes(docs, [text], doc_id, source, text), sources).where("_size > 0")
    tokens = F.regexp_extract_all(F.col(f"_kept_{text}"), F.lit(_WORD + r"[\x20\x09-\x0D]*"), F.lit(0))
    begin, end = F.col("_offset"), F.col("_offset") + F.col("_size")

    def part(t: Column, b: Column) -> Column:
        start, stop = F.greatest(b * BLOCK, begin) - begin, F.least((b + 1) * BLOCK, end) - begin
        words = F.slice(t, (start + 1).cast("int"), (stop - start).cast("int"))
        return F.struct(b.alias("block"), F.array_join(words, "").alias("t"))

    # A text is cut into words once, before its parts become rows.
    numbers = F.sequence(F.floor(begin / BLOCK), F.floor((end - 1) / BLOCK))
    parts = bind(tokens, lambda t: F.transform(numbers, lambda b: part(t, b)))
    cut = rows.select("rank", "_offset", "_id", F.explode(parts).alias("x"))
    cut = cut.select("rank", "x.block", F.struct("_offset", "_id", "x.t").alias("p"))
    blocks = cut.groupBy("rank", "block").agg(F.sort_array(F.collect_list("p")).alias("p"))
    blocks = blocks.select("rank", "block", F.col("p._id").alias("doc_ids"), F.array_join("p.t", "\n\n").alias("text"))
    named = small_side(sources.select("rank", F.col("_source").alias("source")))
    return slots(sources).hint("merge").join(blocks, ["rank", "block"]).join(named, "rank").drop("rank")


def mixed_documents(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The mix as documents with the columns of `docs`: id is the slot number, columns other than source and length are NULL."""
    mixed = mixed_blocks(docs, doc_id, source, text)
    made = {doc_id: F.col("number"), source: F.col("source"), text: F.col("text"), "n_chars": F.length("text")}
    return mixed.select(
        *[made.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in docs.schema.fields]
    )
