"""SentencePiece encoding by a relational lattice, and decoding.

1. Texts become words: a space is written as `▁` (one is put in front), and a word is a run of `▁` with what
   follows. No piece of the model reaches over the edge of a word (checked when the model is read).
2. The most frequent words, at most `MAX_WORDS`, are encoded relationally: substrings of bounded length are exploded and
   equi-joined to the piece table, the edges are grouped by word, and a higher-order aggregate folds the lattice:
   the Viterbi recursion for a unigram model; for a BPE model the merge order, since there the best sum
   of scores is not the encoding: each step removes the inner boundary of the best edge that spans two segments.
3. Texts look their words up; words beyond the bound are folded in the task by the same rule.

Words would be looked up by a join if that could be afforded: it moves every text twice (README). Both folds
are tested against each other and against the library.

A character without a piece becomes its UTF-8 byte pieces. Defined results: NULL counts as empty, and an empty text
has no pieces. Decoding gives back every text that has no `▁` itself (that one returns as a space, as in the library).
Rows are independent: repeated rows repeat their result; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain, repeat
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.let import bind
from millrace.sources.scratch import written_table

SPACE = "▁"
#: Words whose encodings are sent to every task (about 100 MB there).
MAX_WORDS = 1 << 19
#: Piece tables larger than this are refused: the table is broadcast.
MAX_PIECES = 1 << 20
#: Boundaries of a word are the bits of one number; longer words are folded in the task.
MAX_CHARS = 62


@dataclass(frozen=True)
class Pieces:
    """A model's table: ids and scores by piece, ids of the 256 byte pieces, texts by id."""

    ids: dict[str, int]
    scores: dict[str, float]
    bytes_at: tuple[int, ...]
    texts: tuple[str, ...]
    kind: str = "bpe"
    splits_lines: bool = True

    @staticmethod
    def read(path: str, kind: str = "bpe") -> Pieces:
        """From a model file on the driver; the tokenizer is read, never trained."""
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        everything = range(model.get_piece_size())
        plain = [i for i in everything if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i))]
        ids = {model.id_to_piece(i): i for i in plain}
        at = tuple(model.piece_to_id(f"<0x{b:02X}>") for b in range(256))
        return Pieces.of(ids, {p: model.get_score(i) for p, i in ids.items()}, at, tuple(model.id_to_piece(i) for i in everything), kind)

    @staticmethod
    def of(ids: dict, scores: dict, bytes_at: tuple, texts: tuple, kind: str) -> Pieces:
        if len(ids) > MAX_PIECES:
            raise ValueError(f"at most {MAX_PIECES} pieces, not {len(ids)}")
        if any(SPACE in p.lstrip(SPACE) for p in ids):
            raise ValueError("a piece reaches over the edge of a word")
        return Pieces(ids, scores, bytes_at, texts, kind, not any("\n" in p for p in ids))

    @property
    def longest(self) -> int:
        return max(map(len, self.ids))

    def pattern(self) -> str:
        """Words of an escaped text; a line feed without a piece is a word of its own."""
        return rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+" if self.splits_lines else rf"{SPACE}*[^{SPACE}]+|{SPACE}+"


def escaped(text: Column) -> Column:
    """The text as the model sees it."""
    plain = F.coalesce(text, F.lit(""))
    return F.when(plain == "", "").otherwise(F.concat(F.lit(SPACE), F.replace(plain, F.lit(" "), F.lit(SPACE))))


def frequent_words(docs: DataFrame, pieces: Pieces, limit: int = MAX_WORDS, text: str = "text") -> DataFrame:
    """`word`, at most `limit` of the most frequent ones: all whose count lies above a bound."""
    # An inner explode would be given a filter on the array's size, which makes the array twice.
    every = docs.select(F.explode_outer(F.regexp_extract_all(escaped(F.col(text)), F.lit(pieces.pattern()), F.lit(0))).alias("word"))
    counts = written_table(every.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.length("word") <= MAX_CHARS), "piece-words")
    # Eight steps for each power of two: a few hundred rows, whatever the corpus.
    step = F.floor(F.log2("n") * 8)
    histogram = counts.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("step")).collect()
    total, bound = 0, None
    for row in histogram:
        total += row["words"]
        if total > limit:
            break
        bound = row["step"]
    return counts.where(step >= bound).select("word") if bound is not None else counts.where("false").select("word")


def lattice(words: DataFrame, table: DataFrame, longest: int) -> DataFrame:
    """`word, edges`: all pieces in each word, as structs of start and end (in characters), id and score."""
    n = F.length("word")
    starts = words.select("word", F.explode(F.sequence(F.lit(0), n - 1)).alias("s"))
    cut = starts.select("word", "s", F.explode(F.sequence(F.col("s") + 1, F.least(n, F.col("s") + longest))).alias("e"))
    parts = cut.select("word", "s", "e", F.substr("word", F.col("s") + 1, F.col("e") - F.col("s")).alias("piece"))
    edges = parts.join(F.broadcast(table), "piece")
    return edges.groupBy("word").agg(F.collect_list(F.struct("s", "e", "id", "score")).alias("edges"))


def _bit(i: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), i)


def merged_boundaries(n: Column, edges: Column) -> Column:
    """Starts of the segments of a word as bits, after all merges of a BPE model."""
    def spans_two(mask: Column, x: Column) -> Column:
        inner = mask.bitwiseAND(_bit(x["e"]) - _bit(x["s"] + 1))
        starts = mask.bitwiseAND(_bit(x["s"])) != 0
        ends = (x["e"] == n) | (mask.bitwiseAND(_bit(x["e"])) != 0)
        return starts & ends & (F.bit_count(inner) == 1)

    def step(mask: Column, _: Column) -> Column:
        able = F.transform(
            F.filter(edges, lambda x: spans_two(mask, x)),
            lambda x: F.struct(x["score"].alias("score"), (-x["s"]).alias("left"), mask.bitwiseAND(_bit(x["e"]) - _bit(x["s"] + 1)).alias("inner")),
        )
        return mask - F.coalesce(F.array_max(able)["inner"], F.lit(0).cast("bigint"))

    return F.aggregate(F.sequence(F.lit(1), n), _bit(n) - F.lit(1).cast("bigint"), step)


def viterbi_boundaries(n: Column, edges: Column, unknown: float) -> Column:
    """Starts of the segments of the best path of a unigram model as bits; a character may stand without a piece."""
    best = F.array(F.struct(F.lit(0.0).alias("score"), F.lit(0).cast("bigint").alias("mask")))

    def at(done: Column, e: Column) -> Column:
        ways = F.transform(
            F.filter(edges, lambda x: x["e"] == e),
            lambda x: bind(F.get(done, x["s"]), lambda d: F.struct((d["score"] + x["score"]).alias("score"), d["mask"].bitwiseOR(_bit(x["s"])).alias("mask"))),
        )
        alone = bind(F.get(done, e - 1), lambda d: F.struct((d["score"] + unknown).alias("score"), d["mask"].bitwiseOR(_bit(e - 1)).alias("mask")))
        return F.concat(done, F.array(F.array_max(F.concat(ways, F.array(alone)))))

    return F.aggregate(F.sequence(F.lit(1), n), best, at, lambda done: F.get(done, n)["mask"])


def _segments(n: Column, mask: Column) -> Column:
    starts = F.filter(F.sequence(F.lit(0), n - 1), lambda i: mask.bitwiseAND(_bit(i)) != 0)
    return bind(starts, lambda s: F.transform(s, lambda x, k: F.struct(x.alias("s"), F.coalesce(F.get(s, k + 1), n).alias("e"))))


def _byte_ids(c: Column, bytes_at: tuple[int, ...]) -> Column:
    table = F.array(*map(F.lit, bytes_at))
    octets = F.regexp_extract_all(F.hex(F.encode(c, "UTF-8")), F.lit("[0-9A-F]{2}"), F.lit(0))
    return F.transform(octets, lambda h: F.get(table, F.conv(h, 16, 10).cast("int")))


def encoded_words(words: DataFrame, pieces: Pieces) -> DataFrame:
    """`word, ids` of words of at most `MAX_CHARS` characters, by the lattice."""
    spark = words.sparkSession
    table = spark.createDataFrame([(p, i, pieces.scores[p]) for p, i in pieces.ids.items()], "piece string, id int, score double")
    held = written_table(lattice(words, table, pieces.longest), "piece-lattice")
    # A word of characters without pieces has no edge; it is there all the same.
    every = words.join(held, "word", "left") if not words.isEmpty() else held
    none = F.array().cast(held.schema["edges"].dataType)
    every = every.select("word", F.length("word").alias("n"), F.coalesce("edges", none).alias("edges"))
    n, edges = F.col("n"), F.col("edges")
    if pieces.kind == "bpe":
        # Bound to names: an expression used inside a lambda would else run for each element.
        mask = bind(F.filter(edges, lambda x: x["e"] - x["s"] > 1), lambda wide: merged_boundaries(n, wide))
    else:
        mask = viterbi_boundaries(n, edges, min(pieces.scores.values(), default=0.0) - 10)
    word = F.col("word")

    def ids_of(x: Column) -> Column:
        known = F.get(F.filter("edges", lambda y: (y["s"] == x["s"]) & (y["e"] == x["e"])), F.lit(0))["id"]
        return F.when(known.isNotNull(), F.array(known)).otherwise(_byte_ids(F.substr(word, x["s"] + 1, x["e"] - x["s"]), pieces.bytes_at))

    ids = bind(mask, lambda m: F.flatten(F.transform(_segments(n, m), ids_of)))
    return every.select("word", ids.alias("ids"))


#: Words up to this length are merged by scanning their pairs, longer ones with a heap.
_SHORT = 40
#: Words from this length on are merged by halves.
_WHOLE = 6
_NONE = float("-inf")


class _Known(dict):
    """Encodings by word: those given stay, others are folded when they are met and forgotten when they are many."""

    def __init__(self, given: dict[str, tuple[int, ...]], fold: Callable[[str], tuple[int, ...]], limit: int):
        super().__init__(given)
        self.fold, self.limit = fold, limit
        self.rare: list[str] = []

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self.rare) >= self.limit:
            for w in self.rare:
                self.pop(w, None)
            self.rare.clear()
        self.rare.append(word)
        found = self[word] = self.fold(word)
        return found


class _Made(dict):
    """What `make` gives for a key, remembered until there are many."""

    def __init__(self, make: Callable, limit: int):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        made = self[key] = self.make(key)
        return made


class Encoder:
    """Word by word: known encodings first, the same folds for other words; forgets those when they are many."""

    def __init__(self, pieces: Pieces, known: dict[str, tuple[int, ...]], limit: int = 200_000):
        self.pieces, self.known = pieces, _Known(known, self.folded, limit // 4)
        self.find = re.compile(pieces.pattern()).findall
        self.halves, self.apart = _Made(self._merged_short, limit // 2), _Made(self._stay_apart, limit // 4)
        octets = {i: bytes([b]) for b, i in enumerate(pieces.bytes_at)}
        self.two = {p: score for p, score in pieces.scores.items() if len(p) == 2}
        self.data = [octets.get(i) or t.encode("utf-8", "surrogatepass") for i, t in enumerate(pieces.texts)]
        self.octets = pa.array(self.data, pa.binary())

    held: tuple[str, Encoder] | None = None

    @staticmethod
    def of(key: str, pieces: Pieces, packed: bytes) -> Encoder:
        """Built once in a worker for one dictionary; the latest is kept."""
        if Encoder.held is None or Encoder.held[0] != key:
            if Encoder.held is not None:
                # It refers to itself, so it would stay for a while.
                Encoder.held[1].known.clear()
                Encoder.held[1].forget()
            Encoder.held = None
            table = pa.ipc.open_stream(packed).read_all()
            known = {w: tuple(i) for w, i in zip(table.column("word").to_pylist(), table.column("ids").to_pylist())}
            del table
            Encoder.held = (key, Encoder(pieces, known))
        return Encoder.held[1]

    def forget(self) -> None:
        """What can be made again."""
        self.halves.clear()
        self.apart.clear()

    def folded(self, word: str) -> tuple[int, ...]:
        parts = self.merged(word) if self.pieces.kind == "bpe" else self.best_path(word)
        found = tuple(map(self.pieces.ids.get, parts))
        if None not in found:
            return found
        octets = self.pieces.bytes_at
        return tuple(chain.from_iterable([i] if i is not None else [octets[b] for b in p.encode("utf-8", "surrogatepass")] for p, i in zip(parts, found)))

    def merged(self, word: str) -> list[str]:
        """Segments after all merges, best score first, of equal ones the leftmost."""
        if len(word) > _SHORT:
            return self._merged_long(word)
        if len(word) < _WHOLE:
            return self._merged_short(word)
        # Beginnings and ends of words come again more often than words. They are cut where two characters are least like a piece.
        third = len(word) // 3
        pairs = list(map(self.two.get, map(add, word[third:], word[third + 1 : len(word) - third + 1]), repeat(_NONE)))
        cut = third + 1 + pairs.index(min(pairs))
        left, right = self.halves[word[:cut]], self.halves[word[cut:]]
        return left + right if self.apart[left[-1], right[0]] else self._merged_short(word)

    def _stay_apart(self, two: tuple[str, str]) -> bool:
        """Whether no merge reaches over the edge of two neighbouring segments, each the last or first of its half.

        Until a merge reaches over it, the segments of both halves are merged as if they stood alone. The first one that did
        would join parts of these two segments, and would be the best one in their text alone too.
        """
        return self._merged_short(two[0] + two[1]) == list(two)

    def _merged_short(self, word: str) -> list[str]:
        parts, score = list(word), self.pieces.scores.get
        pairs = list(map(self.two.get, map(add, word, word[1:]), repeat(_NONE)))
        while pairs and (best := max(pairs)) > _NONE:
            i = pairs.index(best)
            del pairs[i]
            part = parts[i] = parts[i] + parts.pop(i + 1)
            if i:
                pairs[i - 1] = score(parts[i - 1] + part, _NONE)
            if i < len(pairs):
                pairs[i] = score(part + parts[i + 1], _NONE)
        return parts

    def _merged_long(self, word: str) -> list[str]:
        """With a heap: n log n in the word's length."""
        scores = self.pieces.scores
        parts, after, before = list(word), list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        heap: list[tuple[float, int, str, str]] = []

        def offer(left: int) -> None:
            if left >= 0 and after[left] < len(parts):
                a, b = parts[left], parts[after[left]]
                if (score := scores.get(a + b)) is not None:
                    heapq.heappush(heap, (-score, left, a, b))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            # What either side was merged with meanwhile has been offered anew.
            if parts[i] != a or j >= len(parts) or parts[j] != b:
                continue
            parts[i], parts[j] = a + b, ""
            after[i] = after[j]
            if after[i] < len(parts):
                before[after[i]] = i
            offer(before[i])
            offer(i)
        return [p for p in parts if p]

    def best_path(self, word: str) -> list[str]:
        scores, unknown = self.pieces.scores, min(self.pieces.scores.values(), default=0.0) - 10
        best: list[tuple[float, int]] = [(0.0, 0)]
        for e in range(1, len(word) + 1):
            ways = [(best[e - 1][0] + unknown, e - 1)]
            ways += [(best[s][0] + scores[word[s:e]], s) for s in range(max(0, e - self.pieces.longest), e) if word[s:e] in scores]
            best.append(max(ways))
        parts, e = [], len(word)
        while e:
            parts.append(word[best[e][1] : e])
            e = best[e][1]
        return parts[::-1]

    def encode(self, text: str) -> list[int]:
        return self._ids(text).tolist()

    def _ids(self, text: str) -> np.ndarray:
        # Looked up and joined without a step of Python for each word.
        words = self.find(SPACE + text.replace(" ", SPACE)) if text else []
        return np.fromiter(chain.from_iterable(map(self.known.__getitem__, words)), np.int32)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts one after the other, and where each text's begin (with the end of the last)."""
        ids = [np.zeros(0, np.int32), *map(self._ids, texts)]
        return np.concatenate(ids), np.cumsum(list(map(len, ids)))

    def decode(self, ids: list[int]) -> str:
        """Runs of byte pieces are read as UTF-8; the space put in front is taken away."""
        return self._read(b"".join(map(self.data.__getitem__, ids)))

    def decode_all(self, ids: np.ndarray, begins: np.ndarray) -> list[str]:
        """The same for texts one after the other."""
        if not len(ids):
            return [""] * (len(begins) - 1)
        _, ends, octets = self.octets.take(pa.array(ids)).buffers()
        at, data = np.frombuffer(ends, np.int32)[begins].tolist(), memoryview(octets)
        return [self._read(data[a:b]) for a, b in zip(at, at[1:])]

    @staticmethod
    def _read(data: bytes | memoryview) -> str:
        return str(data, "utf-8", "replace").replace(SPACE, " ")[1:]


def _packed(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


_ENCODED = pa.schema([("doc_id", pa.int64()), ("n_pieces", pa.int64()), ("ids", pa.list_(pa.int32())), ("round_trip", pa.bool_())])
#: Texts are met together up to so many, and so many characters; a longer one by itself.
_BATCH, _CHARS = 200, 1 << 20


def _together(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of at most `_CHARS` characters, or of a single text."""
    first, chars = 0, 0
    for at, text in enumerate(texts):
        if at > first and chars + len(text) > _CHARS:
            yield first, at
            first, chars = at, 0
        chars += len(text)
    if texts:
        yield first, len(texts)


def encoded(docs: DataFrame, pieces: Pieces, doc_id: str = "doc_id", text: str = "text", limit: int = MAX_WORDS) -> DataFrame:
    """`doc_id, n_pieces, ids, round_trip` of each row; `round_trip`: decoding gives the text back."""
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    words = written_table(encoded_words(frequent_words(plain, pieces, limit), pieces), "piece-ids")
    # The driver passes on compressed columns, some 10 MB at most; tasks make the dictionary.
    sent = docs.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, pieces, _packed(words.toArrow())))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder.of(*sent.value)
        for batch in batches:
            for at in range(0, batch.num_rows, _BATCH):
                part = batch.slice(at, _BATCH)
                every = [t or "" for t in part.column(1).to_pylist()]
                for a, b in _together(every):
                    ids, begins = encoder.encode_all(texts := every[a:b])
                    back = [x == t for x, t in zip(encoder.decode_all(ids, begins), texts)]
                    lists = pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(ids))
                    yield pa.record_batch([part.column(0).slice(a, b - a), pa.array(np.diff(begins), pa.int64()), lists, pa.array(back, pa.bool_())], schema=_ENCODED)

    return plain.mapInArrow(encode, "doc_id bigint, n_pieces bigint, ids array<int>, round_trip boolean")


def decoded(rows: DataFrame, pieces: Pieces, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """`doc_id, text` of encoded rows."""
    sent = rows.sparkSession.sparkContext.broadcast(pieces)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(sent.value, {})
        for batch in batches:
            texts = [encoder.decode(i or []) for i in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])

    return rows.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(ids).alias("ids")).mapInArrow(decode, "doc_id bigint, text string")
