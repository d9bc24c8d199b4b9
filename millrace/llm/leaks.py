"""Benchmark decontamination: where do documents hold passages of test questions and answers?

Texts are normalised to words: `A-Z` in lower case, runs of ASCII letters and digits and of all characters beyond ASCII.
A window is `WINDOW` consecutive words of an item; an item of fewer words, but not none, is one window. Spark makes
the distinct windows; one Aho-Corasick automaton over them, with a space on both sides, then reads each normalised
document once. It runs on UTF-8 bytes, so a match ends at a word whose place in the original text is known: words inside
any occurrence of a window are hit, and runs of hit words come back as spans of the original characters.

The pass is narrow: no shuffle, no row leaves its partition. What is sent to the tasks is bounded: an automaton holds
at most `MAX_WINDOWS` windows. A larger benchmark is dealt into several automata by the windows' hash; each reads
the written output of the one before, which carries the hits found so far, so results are the same at any number.

Defined results: NULL and empty texts have no words and no hits; items without words have no windows. Windows of an item
without an id mark words, but name no item. Items of equal text are all named; of repeated ids each is named once. Repeated
document rows are judged each on its own, an empty benchmark hits nothing, an empty table gives an empty result. Very long texts are
one row in one task, in time linear in their length and hits. Only the id and text columns are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.sources.scratch import written_table

WINDOW = 10
#: Windows in one automaton: about 60 bytes and as many nodes each, some 150 MB in a task.
MAX_WINDOWS = 50_000

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORD = rb"0123456789abcdefghijklmnopqrstuvwxyz"
#: Bytes of normalised texts: letters in lower case, everything ASCII that is in no word a space.
_PLAIN = bytes(b if b >= 128 or b in _WORD else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def normal_words(text: Column) -> Column:
    """Words of the normalised text, as a column; none for NULL."""
    plain = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.regexp_extract_all(plain, F.lit(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), F.lit(0))


def item_windows(items: DataFrame, window: int = WINDOW, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """`window, n_words, items`: the distinct windows and the ids, as strings, of the items that hold them."""
    worded = items.select(F.col(item_id).cast("string").alias("item"), normal_words(F.col(text)).alias("words")).where(F.size("words") > 0)
    size = F.least(F.size("words"), F.lit(window))
    cut = worded.select("item", size.alias("n_words"), F.posexplode(F.transform(
        F.sequence(F.lit(1), F.size("words") - size + 1),
        lambda at: F.array_join(F.slice("words", at, size), " "),
    )).alias("at", "window"))
    return cut.groupBy("window", "n_words").agg(F.sort_array(F.collect_set("item")).alias("items"))


def _automaton(windows: list[tuple[str, int, list[str]]]):
    import ahocorasick

    found = ahocorasick.Automaton()
    for text, n, items in windows:
        # One character for each byte: lengths and places are those of the UTF-8 text.
        found.add_word(f" {text} ".encode().decode("latin-1"), (n, items))
    found.make_automaton()
    return found


class _Scanner:
    """Built once in a worker for one list of windows; `of` keeps the latest."""

    held: tuple[str, _Scanner] | None = None

    def __init__(self, windows: list[tuple[str, int, list[str]]]):
        self.automaton = _automaton(windows) if windows else None

    @staticmethod
    def of(key: str, windows: list[tuple[str, int, list[str]]]) -> _Scanner:
        if _Scanner.held is None or _Scanner.held[0] != key:
            _Scanner.held = (key, _Scanner(windows))
        return _Scanner.held[1]

    def hits(self, words: list[bytes]) -> tuple[np.ndarray, set[str]]:
        """First and last number of the words in each occurrence (two columns), and the items that occur."""
        if self.automaton is None or not words:
            return np.empty((0, 2), np.int64), set()
        joined = b" ".join((b"", *words, b"")).decode("latin-1")
        ends, sizes, items = [], [], set()
        for end, (n, named) in self.automaton.iter(joined):
            ends.append(end)
            sizes.append(n)
            items.update(named)
        if not ends:
            return np.empty((0, 2), np.int64), items
        # The space behind word k lies at the length of k + 1 words and as many spaces.
        last = np.searchsorted(np.cumsum([len(w) + 1 for w in words]), np.array(ends))
        return np.stack([last - np.array(sizes) + 1, last], axis=1), items


def merged_runs(runs: np.ndarray) -> np.ndarray:
    """Overlapping and touching runs (first and last number, two columns) as one."""
    if not len(runs):
        return runs
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(runs[:, 1])
    start = np.r_[True, runs[1:, 0] > reach[:-1] + 1]
    return np.stack([runs[start, 0], reach[np.r_[start[1:], True]]], axis=1)


def _spans(data: bytes, runs: np.ndarray) -> list[dict[str, int]]:
    """Runs of words as start and end (exclusive) in characters of the original text."""
    raw = np.frombuffer(data, np.uint8)
    inside = np.frombuffer(data.translate(_PLAIN), np.uint8) != 32
    edge = np.diff(np.r_[False, inside, False].astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    before = np.r_[0, np.cumsum((raw & 0xC0) != 0x80)]
    return [{"start": int(before[starts[a]]), "end": int(before[ends[b]])} for a, b in runs]


_CARRIED = pa.schema([("_id", pa.int64()), ("_data", pa.binary()), ("_runs", pa.list_(pa.int64())), ("_items", pa.list_(pa.string()))])
_FOUND = "doc_id bigint, n_words bigint, n_hit bigint, spans array<struct<start:bigint,end:bigint>>, item_ids array<string>"
_SPAN = pa.struct([("start", pa.int64()), ("end", pa.int64())])
_RESULT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("spans", pa.list_(_SPAN)), ("item_ids", pa.list_(pa.string()))])
#: Texts in one Arrow batch that is sent on.
_BATCH = 100


def _scan(windows: list[tuple[str, int, list[str]]], last: bool):
    key = hashlib.sha256(repr(windows).encode()).hexdigest()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _Scanner.of(key, windows)
        for whole in batches:
            for at in range(0, whole.num_rows, _BATCH):
                batch = whole.slice(at, _BATCH)
                rows = []
                for i, data, runs, items in zip(*(c.to_pylist() for c in batch.columns)):
                    words = data.translate(_PLAIN).split()
                    new, named = scanner.hits(words)
                    if runs:
                        new = np.concatenate([np.array(runs, np.int64).reshape(-1, 2), new])
                    new, items = merged_runs(new), sorted(named.union(items)) if named else items
                    if last:
                        n = int((new[:, 1] - new[:, 0] + 1).sum())
                        rows.append({"doc_id": i, "n_words": len(words), "n_hit": n, "spans": _spans(data, new) if n else [], "item_ids": items})
                    else:
                        rows.append({"_id": i, "_data": data, "_runs": new.ravel().tolist(), "_items": items})
                yield pa.RecordBatch.from_pylist(rows, schema=_RESULT if last else _CARRIED)

    return scan


def leaks(
    docs: DataFrame, items: DataFrame, window: int = WINDOW, limit: int = MAX_WINDOWS,
    doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """`doc_id, n_words, n_hit, spans, item_ids` of each row of `docs`; `item_ids` in the order of strings."""
    table = written_table(item_windows(items, window, item_id, item_text), "leak-windows")
    parts = max(1, -(-table.count() // limit))
    part = F.pmod(F.xxhash64("window"), F.lit(parts))
    none = F.array()
    carried = docs.select(
        F.col(doc_id).cast("bigint").alias("_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary").alias("_data"),
        none.cast("array<bigint>").alias("_runs"), none.cast("array<string>").alias("_items"),
    )
    for p in range(parts):
        # At most `limit` windows, give or take the hash.
        windows = [(r.window, r.n_words, r["items"]) for r in table.where(part == p).sort("window").collect()]
        if p < parts - 1:
            carried = written_table(carried.mapInArrow(_scan(windows, False), "_id bigint, _data binary, _runs array<bigint>, _items array<string>"), "leak-hits")
    return carried.mapInArrow(_scan(windows, True), _FOUND)


def leak_digests(found: DataFrame) -> DataFrame:
    """`leaks` with its items as count and hash."""
    digest = bind(F.array_join("item_ids", ","), lambda x: F.sha2(x, 256))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("bigint").alias("n_items"), digest.alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
