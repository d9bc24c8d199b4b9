"""Repeated passages by compaction of a De Bruijn graph of words.

Edges of the graph are windows of `WINDOW` words, its nodes the words two neighbouring windows share. An edge's
source is the document with the smallest id in which it starts; an edge of any other document is repeated. Along a
document, consecutive repeated edges with one source are a path without branches and compact into one
span with source coordinates. Words under such spans are removed.

1. Documents are dealt into chunks of some megabytes of text (one shuffle, used again in step 3). A chunk keeps the
   first document of each of its edges and sends edges, as packed 64-bit hashes, to buckets by hash.
   An edge is sent once per chunk however often it occurs there, so a hot passage is no hot task.
2. A bucket finds, for each edge of a chunk, whether a document of another chunk has it earlier.
3. Chunks join what the buckets found, mark edges, compact spans and hash the words that are left.
4. Spans join the text of their source documents, which must contain every window of them word by word.
   Hash collisions can only mark too much, never too little, so this finds them all; documents with a
   refuted span are computed again with other hashes until every span is confirmed.

Defined results: NULL and empty texts have no words, remove nothing and keep the hash of the empty string. Rows that
share an id are one document as far as sources go, so they remove nothing from one another. Rows
without id come after all others and are no source. Repeated rows repeat their result. An empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.near import WordHashes, mix
from millrace.llm.words import small_side
from millrace.sources.scratch import written_table

WINDOW = 13
CHUNK_BYTES = 8 << 20
#: Edges that a bucket holds, about.
BUCKET_EDGES = 1 << 19
#: Stands for a missing id: after all others.
LAST = 2**63 - 1

_EDGES = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("edges", pa.binary())])
_FOUND = pa.schema([("chunk", pa.int64()), ("bucket", pa.int64()), ("earlier", pa.binary()), ("sources", pa.binary())])
_SPAN = pa.struct([("start", pa.int64()), ("n", pa.int64()), ("source", pa.int64()), ("text", pa.string())])
_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("spans", pa.list_(_SPAN))]
)
_RESULT_DDL = (
    "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, "
    "spans array<struct<start: bigint, n: bigint, source: bigint, text: string>>"
)


def _planes(values: np.ndarray) -> bytes:
    """Bytes of 64-bit numbers, most significant ones of all first: sorted or small numbers then compress."""
    return values.astype(">u8").view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(">u8").ravel().astype(np.uint64)


def edge_hashes(words: list[bytes], hashes: WordHashes, factors: np.ndarray) -> np.ndarray:
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    rolled = h[:n] * factors[0]
    for i in range(1, WINDOW):
        rolled += h[i : i + n] * factors[i]
    return mix(rolled)


class _Chunk:
    """Words and edges of one chunk; documents in ascending order of id."""

    def __init__(self, table: pa.Table, seed: int):
        factors = np.random.default_rng(seed).integers(0, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        ids = table.column("doc_id").to_pylist()
        texts = table.column("text")
        order = sorted(range(len(ids)), key=lambda i: LAST if ids[i] is None else ids[i])
        self.ids = [ids[i] for i in order]
        self.keys = np.array([LAST if i is None else i for i in self.ids], np.int64)
        self.words = [(texts[i].as_py() or "").encode("utf-8", "surrogatepass").split() for i in order]
        seen = WordHashes()
        each = [edge_hashes(w, seen, factors) for w in self.words]
        self.counts = [len(e) for e in each]
        owners = np.repeat(self.keys, self.counts)
        edges = np.concatenate(each) if each else np.empty(0, np.uint64)
        # First occurrences come from the smallest id, as documents are in that order.
        self.edges, first, self.place = np.unique(edges, return_index=True, return_inverse=True)
        self.sources = owners[first]


def _send(seed: int, bits: int):
    def send(table: pa.Table) -> pa.Table:
        chunk = _Chunk(table, seed)
        number = table.column("chunk")[0].as_py()
        top = (chunk.edges >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(chunk.edges), np.int64)
        buckets, starts = np.unique(top, return_index=True)
        ends = [*starts[1:], len(top)]
        blobs = [_planes(chunk.edges[s:e]) + _planes(chunk.sources[s:e]) for s, e in zip(starts, ends)]
        return pa.table([pa.array(buckets), pa.array([number] * len(blobs), pa.int64()), pa.array(blobs, pa.binary())], schema=_EDGES)

    return send


def _find(table: pa.Table) -> pa.Table:
    """Of one bucket: the smallest source of each edge, told to the chunks that have a larger one."""
    chunks = table.column("chunk").to_pylist()
    halves = [(b[: len(b) // 2], b[len(b) // 2 :]) for b in (x.as_py() for x in table.column("edges"))]
    edges = [_unplanes(e) for e, _ in halves]
    sources = [_unplanes(s).astype(np.int64) for _, s in halves]
    _, place = np.unique(np.concatenate(edges), return_inverse=True)
    every = np.concatenate(sources)
    least = np.full(place.max() + 1, LAST)
    np.minimum.at(least, place, every)
    best, at, rows = least[place], 0, []
    for chunk, own in zip(chunks, sources):
        b = best[at : at + len(own)]
        at += len(own)
        earlier = b < own
        rows.append((chunk, np.packbits(earlier).tobytes(), _planes(b[earlier])))
    bucket = table.column("bucket")[0].as_py()
    return pa.table(
        [
            pa.array([r[0] for r in rows], pa.int64()),
            pa.array([bucket] * len(rows), pa.int64()),
            pa.array([r[1] for r in rows], pa.binary()),
            pa.array([r[2] for r in rows], pa.binary()),
        ],
        schema=_FOUND,
    )


def _mark(seed: int, bits: int):
    def spans_of(words: list[bytes], first: np.ndarray, key: int) -> tuple[np.ndarray, list[dict]]:
        """Removed words, and the compacted paths: runs of repeated edges with one source."""
        repeated = first < key
        covered = np.zeros(len(words) + 1, np.int32)
        at = np.flatnonzero(repeated)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + WINDOW, -1)
        if not len(at):
            return np.zeros(len(words), bool), []
        cuts = np.flatnonzero((np.diff(at) != 1) | (np.diff(first[at]) != 0)) + 1
        spans = []
        for run in np.split(at, cuts):
            s, e = int(run[0]), int(run[-1]) + WINDOW
            text = b" ".join(words[s:e]).decode("utf-8", "surrogatepass")
            spans.append({"start": s, "n": e - s, "source": int(first[s]), "text": text})
        return np.cumsum(covered[:-1]) > 0, spans

    def mark(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return _RESULT.empty_table()
        chunk = _Chunk(docs, seed)
        sources = chunk.sources.copy()
        if found.num_rows:
            top = (chunk.edges >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(chunk.edges), np.int64)
            for bucket, earlier, known in zip(*(found.column(c) for c in ("bucket", "earlier", "sources"))):
                lo, hi = np.searchsorted(top, [bucket.as_py(), bucket.as_py() + 1])
                flags = np.unpackbits(np.frombuffer(earlier.as_py(), np.uint8), count=hi - lo).astype(bool)
                sources[lo:hi][flags] = _unplanes(known.as_py()).astype(np.int64)
        first, at = sources[chunk.place], 0
        out: dict[str, list] = {name: [] for name in _RESULT.names}
        for doc_id, key, words, n in zip(chunk.ids, chunk.keys, chunk.words, chunk.counts):
            removed, spans = spans_of(words, first[at : at + n], key) if n else (np.zeros(len(words), bool), [])
            at += n
            kept = [w for w, r in zip(words, removed.tolist()) if not r] if spans else words
            row = (doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest(), spans)
            for name, value in zip(_RESULT.names, row):
                out[name].append(value)
        return pa.table([pa.array(out[f.name], f.type) for f in _RESULT], schema=_RESULT)

    return mark


def _check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ids of documents with a window that its source does not have."""
    windows = lambda text: zip(*[(w := text.encode("utf-8", "surrogatepass").split())[i:] for i in range(WINDOW)])
    last, known = None, set()
    for batch in batches:
        refuted = []
        for doc_id, span, source in zip(*(batch.column(i) for i in range(3))):
            text = source.as_py() or ""
            if text != last:
                last, known = text, set(windows(text))
            if not known.issuperset(windows(span.as_py())):
                refuted.append(doc_id.as_py())
        yield pa.record_batch([pa.array(refuted, pa.int64())], names=["doc_id"])


def _marked(docs: DataFrame, seed: int, total_bytes: int) -> DataFrame:
    chunks = max(1, -(-total_bytes // CHUNK_BYTES))
    bits = max(0, int(np.ceil(np.log2(max(1, total_bytes / 6 / BUCKET_EDGES)))))
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks))).repartition(partitions, "chunk")
    edges = dealt.groupBy("chunk").applyInArrow(_send(seed, bits), "bucket bigint, chunk bigint, edges binary")
    found = edges.groupBy("bucket").applyInArrow(_find, "chunk bigint, bucket bigint, earlier binary, sources binary")
    marked = dealt.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(_mark(seed, bits), _RESULT_DDL)
    return written_table(marked, "repeats-marked")


def _refuted(docs: DataFrame, marked: DataFrame) -> DataFrame:
    spans = marked.select("doc_id", F.explode("spans").alias("s")).select("doc_id", "s.source", "s.text")
    wanted = written_table(spans.select(F.col("source").alias("_source")).distinct(), "repeats-sources")
    sources = docs.join(small_side(wanted), docs["doc_id"] == F.col("_source"), "left_semi")
    # Rows that share an id are checked as one text.
    sources = sources.groupBy(F.col("doc_id").alias("source")).agg(F.array_join(F.collect_set("text"), " ").alias("source_text"))
    joined = spans.join(sources, "source").select(F.coalesce("doc_id", F.lit(LAST)).alias("doc_id"), "text", "source_text")
    return joined.mapInArrow(_check, "doc_id bigint").distinct()


def repeated_spans(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, n_words, n_removed, kept_sha256, spans` of each row; spans have start, length, source and text."""
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    total = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    key = F.coalesce("doc_id", F.lit(LAST))
    seed, settled = 1, None
    while True:
        marked = _marked(plain, seed, total)
        if settled is not None:
            marked = settled.unionByName(marked.join(redo, key == F.col("_redo"), "left_semi"))
        redo = written_table(_refuted(plain, marked).withColumnRenamed("doc_id", "_redo"), "repeats-refuted")
        if redo.isEmpty():
            return marked
        settled, seed = marked.join(redo, key == F.col("_redo"), "left_anti"), seed + 1


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    return repeated_spans(docs, doc_id, text).drop("spans")
