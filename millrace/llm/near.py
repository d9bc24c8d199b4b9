"""Near-duplicate documents by b-bit MinHash.

1. Each text is hashed once (Arrow batches, no shuffle): distinct word 5-shingles, 128 minima, of each
   only two low bits (after mixing) packed into four 64-bit words; 25 band keys of five minima each. A
   pair at the threshold 0.85 escapes all bands with probability (1 - 0.85^5)^25 = 4e-7.
2. Equal texts form a class; the rest works on one representative per class, the smallest doc_id.
3. A band bucket does not list its pairs. Its most central member (the one whose buckets are largest in
   sum) is compared with the others. Where that leaves members of one bucket in different components,
   the members outside the centre's component are compared with the bucket in blocks of signatures and
   shingle hashes; a task sees two blocks at a time, and only links that join components leave it.
4. The estimate from bit counts, corrected for chance agreement of two bits (E = J + (1 - J) / 4), drops
   pairs more than five standard errors below the threshold, and sizes drop those that cannot reach it.
   All others are confirmed on the full shingle sets.
5. Components by minimum labels with pointer jumping, each round written to the shared folder.

Broadcasts are size-checked (`small_side`); beyond the bound the joins shuffle. Joins on hot classes,
buckets and centres are plain equi-joins that adaptive execution may split.

Defined results: NULL or word-less texts have no shingles and link with nothing. Texts of fewer than
five words have one shingle, the whole sequence. Rows that share a doc_id count as one document, which is
linked if any of its texts is. A row without doc_id takes the component of equal or near texts but
lends its id to none; its component is NULL, and it is kept, when no such text has an id.
An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.words import small_side
from millrace.sources.scratch import written_table

SHINGLE = 5
HASHES, BANDS, ROWS = 128, 25, 5
#: Share of agreeing packed minima below which a pair cannot be at the threshold (five standard errors).
SLACK = 0.185
BLOCK = 128

_rng = np.random.default_rng(20240607)
_FACTORS = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_WORD_FACTORS = _rng.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BAND_FACTORS = _rng.integers(0, 2**63, (BANDS, ROWS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hash of each word seen; forgets all when it has grown to `limit` words."""

    def __init__(self, limit: int = 400_000):
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x9FB21C651E98DF25)
    return h ^ (h >> np.uint64(32))


def near_words(text: str | None) -> list[bytes]:
    """Words with A-Z lower-cased; a byte string splits on ASCII white space exactly."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], hashes: WordHashes) -> np.ndarray:
    """Distinct 64-bit shingle hashes."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    k = min(SHINGLE, len(words))
    n = len(words) - k + 1
    rolled = np.full(n, np.uint64(k))
    for i in range(k):
        rolled += mix(h[i : i + n] + np.uint64(i)) * _WORD_FACTORS[i]
    return np.unique(mix(rolled))


def minima(shingles: np.ndarray) -> np.ndarray:
    least = np.full(HASHES, np.uint64(2**64 - 1))
    for i in range(0, len(shingles), 2048):
        least = np.minimum(least, (shingles[i : i + 2048, None] * _FACTORS).min(axis=0))
    return least


def packed(least: np.ndarray) -> np.ndarray:
    """Two bits of each minimum as two bit planes of 128 bits: four 64-bit words."""
    bits = mix(least) & np.uint64(3)
    planes = np.concatenate([bits & np.uint64(1), bits >> np.uint64(1)]).astype(np.uint8)
    return np.packbits(planes).view(">u8").astype(np.uint64)


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = mix(least[: BANDS * ROWS]).reshape(BANDS, ROWS)
    return mix((rows * _BAND_FACTORS).sum(axis=1, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


_SIGNED = pa.schema(
    [("doc_id", pa.int64()), ("n", pa.int64()), ("cls", pa.string())]
    + [(f"s{i}", pa.int64()) for i in range(4)]
    + [("bands", pa.list_(pa.int64()))]
)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        out: dict[str, list] = {name: [] for name in _SIGNED.names}
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            words = near_words(text.as_py())
            shingles = shingle_hashes(words, hashes)
            out["doc_id"].append(doc_id)
            out["n"].append(len(shingles))
            if not len(shingles):
                for name in _SIGNED.names[2:]:
                    out[name].append(None)
                continue
            least = minima(shingles)
            out["cls"].append(xxhash.xxh3_128_hexdigest(b" ".join(words)))
            for i, s in enumerate(packed(least).view(np.int64).tolist()):
                out[f"s{i}"].append(s)
            out["bands"].append(band_keys(least).view(np.int64).tolist())
        yield pa.record_batch([pa.array(out[f.name], f.type) for f in _SIGNED], schema=_SIGNED)


def signatures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n, cls, s0..s3, bands` of each row; all but the first two NULL where there are no shingles."""
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id bigint, n bigint, cls string, s0 bigint, s1 bigint, s2 bigint, s3 bigint, bands array<bigint>"
    return narrow.mapInArrow(_sign, schema)


def estimate(a: str, b: str) -> Column:
    """Similarity from the packed signatures of the structs `a` and `b`, corrected for chance agreement."""
    differ = [F.bit_count(F.expr(f"({a}.s{i} ^ {b}.s{i}) | ({a}.s{i + 2} ^ {b}.s{i + 2})")) for i in (0, 1)]
    agree = 1 - (differ[0] + differ[1]) / F.lit(float(HASHES))
    return (agree - 0.25) / 0.75


def plausible(threshold: int) -> Column:
    """Pairs that sizes and the estimate leave: columns `ca`, `cb` are structs with `n` and the signature."""
    fits = 100 * F.least("ca.n", "cb.n") >= threshold * F.greatest("ca.n", "cb.n")
    return fits & (estimate("ca", "cb") >= threshold / 100 - SLACK)


def _shingle_arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        arrays = [shingle_hashes(near_words(t.as_py()), hashes).view(np.int64) for t in batch.column(1)]
        yield pa.record_batch([batch.column(0), pa.array(arrays, pa.list_(pa.int64()))], names=["rep", "shingles"])


def common(x: list[np.ndarray], y: list[np.ndarray], columns: int = 8192) -> np.ndarray:
    """Sizes of all intersections of the sets `x` with the sets `y`, as products of incidence matrices, in strips."""
    values, place = np.unique(np.concatenate([*x, *y]), return_inverse=True)
    row = np.repeat(np.arange(len(x) + len(y)), [len(a) for a in (*x, *y)])
    order = np.argsort(place, kind="stable")
    place, row = place[order], row[order]
    total = np.zeros((len(x), len(y)), np.float64)
    for lo in range(0, len(values), columns):
        i, j = np.searchsorted(place, [lo, lo + columns])
        strip = np.zeros((len(x) + len(y), columns), np.float32)
        strip[row[i:j], place[i:j] - lo] = 1
        total += strip[: len(x)] @ strip[len(x) :].T
    return total.astype(np.int64)


_BLOCK_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def _compare_blocks(threshold: int):
    """Of two blocks of a bucket, enough links to join the components that they link."""
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def arrays(block: list[dict]) -> list[np.ndarray]:
            return [np.array([x[k] for x in block], np.int64) for k in ("rep", "label", "n", "s0", "s1", "s2", "s3", "bands")]

        for batch in batches:
            a, b = [], []
            for r in range(batch.num_rows):
                bucket, left, right = (batch.column(c)[r].as_py() for c in range(3))
                x, y = arrays(left), arrays(right)
                differ = sum(
                    np.bitwise_count((x[3 + i][:, None] ^ y[3 + i]) | (x[5 + i][:, None] ^ y[5 + i])).astype(np.int32)
                    for i in (0, 1)
                )
                near = ((1 - differ / HASHES) - 0.25) / 0.75 >= threshold / 100 - SLACK
                n, m = x[2][:, None], y[2][None, :]
                near &= (100 * np.minimum(n, m) >= threshold * np.maximum(n, m)) & (x[1][:, None] != y[1])
                # A pair that meets in several bands is compared in the first of them.
                band = int(np.flatnonzero(x[7][0] == bucket)[0])
                near &= ~(x[7][:, None, :band] == y[7][None, :, :band]).any(axis=2)
                i, j = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                if not len(i):
                    continue
                both = common([np.array(left[k]["shingles"], np.int64) for k in i], [np.array(right[k]["shingles"], np.int64) for k in j])
                linked = near[np.ix_(i, j)] & (100 * both >= threshold * (n[i] + m[:, j] - both))
                root: dict[int, int] = {}

                def of(label: int) -> int:
                    while (up := root.get(label, label)) != label:
                        label = up
                    return label

                for p, q in zip(*np.nonzero(linked)):
                    u, v = of(int(x[1][i[p]])), of(int(y[1][j[q]]))
                    if u != v:
                        root[max(u, v)] = min(u, v)
                        a.append(min(x[0][i[p]], y[0][j[q]]))
                        b.append(max(x[0][i[p]], y[0][j[q]]))
            yield pa.record_batch([pa.array(a, pa.int64()), pa.array(b, pa.int64())], schema=_BLOCK_LINKS)

    return compare


_LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("links", pa.bool_())])


def _confirm(threshold: int):
    def shingles(text: str | None) -> set:
        w = near_words(text)
        return set(zip(*[w[i:] for i in range(SHINGLE)])) if len(w) >= SHINGLE else {tuple(w)} if w else set()

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, last_set = None, set()
        for batch in batches:
            a, b, ta, tb = (batch.column(i) for i in range(4))
            links = []
            for i in range(batch.num_rows):
                text = ta[i].as_py()
                if text != last:
                    last, last_set = text, shingles(text)
                other = shingles(tb[i].as_py())
                both = len(last_set & other)
                links.append(100 * both >= threshold * (len(last_set) + len(other) - both) and both > 0)
            yield pa.record_batch([a, b, pa.array(links, pa.bool_())], schema=_LINK)

    return confirm


def components(edges: DataFrame) -> DataFrame:
    """`v, label`: the smallest id reachable over the undirected `a, b` edges. Written each round."""
    both = edges.select("a", "b").union(edges.select(F.col("b"), F.col("a"))).distinct()
    both = written_table(both, "near-edges")
    labels = written_table(both.groupBy(F.col("a").alias("v")).agg(F.least("v", F.min("b")).alias("label")), "near-labels")
    while True:
        near = both.join(labels.select(F.col("v").alias("b"), "label"), "b").groupBy(F.col("a").alias("v"))
        lower = near.agg(F.min("label").alias("lower"))
        stepped = labels.join(lower, "v").select("v", F.col("label").alias("was"), F.least("label", "lower").alias("to"))
        jumped = stepped.join(labels.select(F.col("v").alias("to"), F.col("label").alias("beyond")), "to").select(
            "v", F.least("to", "beyond").alias("label"), "was"
        )
        jumped = written_table(jumped, "near-labels")
        changed = not jumped.where("label <> was").isEmpty()
        labels = jumped.select("v", "label")
        if not changed:
            return labels


def near_links(docs: DataFrame, classes: DataFrame, threshold: int, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Confirmed links `a, b` between class representatives, enough of them to give the components."""
    members = classes.select("rep", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = written_table(members.join(sizes, "bucket"), "near-shared")
    central = shared.groupBy("rep").agg(F.sum("size").alias("weight"))
    weighed = shared.select("bucket", "rep").join(central, "rep")
    centres = weighed.groupBy("bucket").agg(F.max(F.struct("weight", (-F.col("rep")).alias("m"))).alias("c"))
    centres = written_table(centres.select("bucket", (-F.col("c.m")).alias("centre")), "near-centres")
    star = shared.join(centres, "bucket").where("rep <> centre")
    pairs = star.select(F.least("rep", "centre").alias("a"), F.greatest("rep", "centre").alias("b")).distinct()

    cells = classes.select("rep", "n", "s0", "s1", "s2", "s3")
    side = lambda x: cells.select(F.col("rep").alias(x), F.struct("n", "s0", "s1", "s2", "s3").alias(f"c{x}"))
    pairs = pairs.join(side("a"), "a").join(side("b"), "b").where(plausible(threshold)).select("a", "b").distinct()
    pairs = written_table(pairs, "near-pairs")

    # The texts that any comparison can need, read once.
    wanted = written_table(shared.select(F.col("rep").alias("id")).distinct(), "near-wanted")
    plain = docs.select(F.col(doc_id).cast("bigint").alias("id"), F.col(text).cast("string").alias("t"))
    texts = written_table(plain.join(small_side(wanted), "id", "left_semi").distinct(), "near-texts")

    def confirmed(candidates: DataFrame) -> DataFrame:
        left = texts.select(F.col("id").alias("a"), F.col("t").alias("ta"))
        right = texts.select(F.col("id").alias("b"), F.col("t").alias("tb"))
        joined = candidates.join(right, "b").join(left, "a").select("a", "b", "ta", "tb")
        return joined.mapInArrow(_confirm(threshold), "a bigint, b bigint, links boolean").where("links").select("a", "b")

    links = written_table(confirmed(pairs), "near-links")

    # Buckets that still lie in several components: whoever is outside the centre's is compared with the rest.
    labels = components(links)
    label = lambda x: labels.select(F.col("v").alias(x), F.col("label").alias(f"{x}_label"))
    placed = (
        shared.join(centres, "bucket")
        .where("rep <> centre AND size > 2")
        .join(label("rep"), "rep", "left")
        .join(label("centre"), "centre", "left")
    )
    placed = placed.withColumn("label", F.coalesce("rep_label", "rep"))
    placed = placed.withColumn("apart", F.col("label") != F.coalesce("centre_label", "centre"))
    placed = written_table(placed.select("bucket", "rep", "size", "label", "apart"), "near-placed")
    split = placed.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo <> hi")
    open_members = written_table(placed.join(split.select("bucket"), "bucket"), "near-open")
    who = written_table(open_members.select("rep").distinct(), "near-who")
    sets = texts.withColumnRenamed("id", "rep").join(small_side(who), "rep", "left_semi")
    sets = written_table(sets.mapInArrow(_shingle_arrays, "rep bigint, shingles array<bigint>"), "near-sets")
    cell = F.struct("rep", "label", "n", "s0", "s1", "s2", "s3", "bands", "shingles").alias("cell")
    known = open_members.join(classes.select("rep", "n", "s0", "s1", "s2", "s3", "bands"), "rep").join(sets, "rep")
    blocks = (
        known.withColumn("block", F.pmod(F.xxhash64("rep"), F.ceil(F.col("size") / F.lit(BLOCK))))
        .groupBy("bucket", "apart", "block")
        .agg(F.collect_list(cell).alias("cells"))
    )
    blocks = written_table(blocks, "near-blocks")
    left = blocks.where("apart").select("bucket", F.col("block").alias("lb"), F.col("cells").alias("left"))
    right = blocks.select("bucket", F.col("block").alias("rb"), "apart", F.col("cells").alias("right"))
    met = left.join(right, "bucket").where("NOT apart OR lb <= rb").select("bucket", "left", "right")
    more = met.mapInArrow(_compare_blocks(threshold), "a bigint, b bigint")
    return links.union(written_table(more.distinct(), "near-more"))


def near_components(docs: DataFrame, threshold: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_shingles, component_id, kept` of each row; links at 100 * intersection >= threshold * union."""
    signed = written_table(signatures(docs, doc_id, text), "near-signed")
    same = [F.first(c).alias(c) for c in ("n", "s0", "s1", "s2", "s3", "bands")]
    classes = signed.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("rep"), *same)
    classes = written_table(classes, "near-classes")
    links = near_links(docs, classes.where("rep IS NOT NULL"), threshold, doc_id, text)
    labels = components(written_table(links, "near-links"))
    of_class = classes.select("cls", "rep").join(labels.select(F.col("v").alias("rep"), "label"), "rep", "left")
    rows = signed.select("doc_id", "n", "cls").join(of_class, "cls", "left")
    component = F.when(F.col("n") > 0, F.coalesce("label", "rep")).otherwise(F.col("doc_id"))
    rows = rows.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))
    return rows.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))


def near_filter(docs: DataFrame, threshold: int = 85, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each group of near copies stays, with its own columns: the one with the smallest id."""
    found = near_components(docs, threshold, doc_id, text)
    out = written_table(found.where("NOT kept").select(F.col("doc_id").alias("_dropped")).distinct(), "near-dropped")
    side = small_side(out)
    return docs.join(side, docs[doc_id].cast("bigint") == side["_dropped"], "left_anti")
