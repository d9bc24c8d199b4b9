"""Lempel-Ziv fingerprints: a text's dictionary phrases, hashed, kept as the smallest hashes.

A text is parsed once over its bytes: the phrase grows while it is known, and the first unknown one enters the
dictionary. The phrases of similar texts overlap like their compressed forms, and the overlap is estimated from the
`SIZE` smallest hashes of each phrase set (bottom-k sketches): the share that both sets have among
the smallest hashes of their union.

Each document is also compared with its neighbour in ascending order of id, and with itself after its last half has
been replaced by the neighbour's beginning. Documents are dealt by ranges of ids whose bounds are
quantiles, one per partition; the first document of each range also goes to the range before it, so no
document waits for another partition, and no task sees more than its rows one after the other. Half of the
parse serves both the text and its edited form.

Defined results: NULL counts as empty. The fingerprint of an empty text is empty; two empty ones are alike (1), an empty
one is unlike all others (0). Rows of equal id stand in the order of a hash of their texts, equal rows in any; rows
without id come last. The neighbour of the last document is the first, of a single one itself. An empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from millrace.llm.near import mix

SIZE = 128
#: Rows that leave a task together.
OUT_ROWS = 500
_LAST = 2**63 - 1
_MASK = 2**60 - 1

_RESULT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)
_DDL = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)


class Phrases:
    """The dictionary of a parse as a trie, and the hash of each phrase."""

    __slots__ = ("children", "hashes", "at")

    def __init__(self, other: Phrases | None = None):
        self.children: dict[int, int] = dict(other.children) if other else {}
        self.hashes: list[int] = list(other.hashes) if other else [0]
        self.at = other.at if other else 0

    def parse(self, data: bytes) -> Phrases:
        """Go on with the parse; `at` is the phrase that is still growing, 0 for none."""
        children, hashes, at = self.children, self.hashes, self.at
        get = children.get
        for c in data:
            step = at << 8 | c
            at = get(step, 0)
            if not at:
                children[step] = len(hashes)
                hashes.append((hashes[step >> 8] * 1000003 + c + 1) & _MASK)
        self.at = at
        return self


def sketch(phrases: Phrases) -> np.ndarray:
    """The smallest hashes, ascending, 32 bits each."""
    hashed = mix(np.array(phrases.hashes[1:], np.uint64)) >> np.uint64(32)
    if len(hashed) > 4 * SIZE:
        hashed = np.partition(hashed, 2 * SIZE)[: 2 * SIZE]
    return np.unique(hashed)[:SIZE].astype(np.uint32)


def written(smallest: np.ndarray) -> str:
    return smallest.astype(">u4").tobytes().hex()


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = np.union1d(a, b)[:SIZE]
    return float(np.isin(union, np.intersect1d(a, b, assume_unique=True), assume_unique=True).sum() / len(union))


def fingerprint(text: str | None) -> str:
    return written(sketch(Phrases().parse((text or "").encode("utf-8", "surrogatepass"))))


class _Parsed:
    """A document, parsed; the state at its middle is kept until its neighbour is known."""

    def __init__(self, doc_id: int | None, text: str):
        self.doc_id, self.text = doc_id, text
        self.middle = len(text) - len(text) // 2
        self.half = Phrases().parse(text[: self.middle].encode("utf-8", "surrogatepass"))
        self.sketch = sketch(Phrases(self.half).parse(text[self.middle :].encode("utf-8", "surrogatepass")))

    def row(self, neighbour: _Parsed) -> tuple:
        beginning = neighbour.text[: len(self.text) // 2]
        edited = (self.text[: self.middle] + beginning).encode("utf-8", "surrogatepass")
        other = sketch(self.half.parse(beginning.encode("utf-8", "surrogatepass")))
        return (
            self.doc_id, len(self.text), hashlib.sha256(edited).hexdigest(), written(self.sketch), written(other),
            likeness(self.sketch, other), likeness(self.sketch, neighbour.sketch),
        )


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def out(rows: list[tuple]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), _RESULT)], schema=_RESULT)

    before, rows = None, []
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            parsed = _Parsed(doc_id, text.as_py() or "")
            if before is not None:
                rows.append(before.row(parsed))
                if len(rows) == OUT_ROWS:
                    yield out(rows)
                    rows = []
            before = parsed
    # The last row of a partition is the first one of the next range: it has been a neighbour only.
    if rows:
        yield out(rows)


def neighbours_compared(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited form, and their likeness, one row per document."""
    spark = docs.sparkSession
    partitions = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    plain = plain.select("doc_id", "text", F.coalesce("doc_id", F.lit(_LAST)).alias("_key"), F.xxhash64("text").alias("_tie"))
    shares = [i / partitions for i in range(1, partitions)]
    bounds = np.unique(np.array(plain.approxQuantile("_key", shares, 0.1 / partitions) or [], np.float64)) if shares else np.array([])

    @pandas_udf("int")
    def range_of(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, key.to_numpy(np.float64), side="right").astype(np.int32))

    ranged = plain.withColumn("_range", range_of("_key"))
    # One row per range, as many as there are partitions.
    firsts = sorted(ranged.select("_range", "_key", "_tie").groupBy("_range").agg(F.min(F.struct("_key", "_tie"))).collect())
    heads = [(before[0], *after[1]) for before, after in zip(firsts, firsts[1:] + firsts[:1])]
    heads = spark.createDataFrame(heads, "_to int, _key bigint, _tie bigint")
    tails = plain.join(F.broadcast(heads), ["_key", "_tie"]).dropDuplicates(["_key", "_tie", "_to"])
    columns = ["doc_id", "text", "_key", "_tie"]
    rows = ranged.select("_range", F.lit(0).alias("_last"), *columns).union(
        tails.select(F.col("_to").alias("_range"), F.lit(1).alias("_last"), *columns)
    )
    rows = rows.repartitionById(partitions, F.col("_range")).sortWithinPartitions("_range", "_last", "_key", "_tie")
    return rows.select("doc_id", "text").mapInArrow(_compare, _DDL)
