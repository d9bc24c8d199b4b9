"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's probability is logistic in its distinct words and beginnings of words (stems are inflected); a document's is the noisy-or of its sentences,
`1 - prod(1 - p)`. The bias is the document's: a sentence's prior odds are the document's divided by its number of sentences, so the
score does not rise with length alone, however long a clean text is. Only documents are labelled, so the words' weights are fitted to
document labels through the noisy-or (full-batch Adam on the exact gradient). The weights then score all documents, and locate the
sentences that made the score.

Fitting uses a sample of at most `MAX_TRAIN` labelled documents (the smallest hashes of the id; a documented bound).
Spark counts its features by label and keeps the `max_words` that tell labels apart best (chi-square), of those in
`least_docs` documents or more; only their numbers in the sentences of the sample come to the driver, equal sentences of a
document as one with a count. Scoring is one pass in Arrow batches without a shuffle; the model it carries holds `max_words` weights at most.

Defined results: NULL and empty texts have no sentence and score 0. Very long texts are read whole. Without labelled documents of both
kinds nothing can be learned: all weights are 0 and the bias is low. Of several labels of one id the largest counts, of several texts the
last by code points; of equally telling features the first by name is kept.
Scores are functions of the text, so repeated rows score alike; other columns are not read.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.sources.scratch import written_table

MAX_TRAIN = 12_000
#: Features that are learned from by default; more change little (README).
MAX_WORDS = 1_000
STEPS = 300
#: Features in fewer training documents than this are not learned from by default.
LEAST_DOCS = 4
THRESHOLD = 0.5
_START_BIAS = -6.0
_DECAY = 1e-4
#: Lengths of the beginnings of longer words that are features, too.
STEMS = range(3, 9)

_sentences = re.compile(r"[^.!?\n]+").finditer
_words = re.compile(r"[^\W\d_]+").findall


def features_of(word: str) -> list[str]:
    return [word, *[f"{word[:k]}*" for k in STEMS if k < len(word)]]


class _Known(dict):
    """The model's features of each word met; forgets all when it has met `limit` words."""

    def __init__(self, held: dict, limit: int = 200_000):
        self.held, self.limit = held, limit

    def __missing__(self, word: str) -> tuple:
        if len(self) >= self.limit:
            self.clear()
        found = self[word] = tuple(self.held[f] for f in features_of(word) if f in self.held)
        return found


@dataclass(frozen=True)
class Model:
    bias: float = _START_BIAS
    weights: dict[str, float] = field(default_factory=dict)

    def scorer(self) -> Callable[[str | None], tuple[float, int, list[dict]]]:
        """Of a text: noisy-or, number of sentences, and the offending sentences by position (in characters)."""
        known = _Known({f: (f, w) for f, w in self.weights.items()})
        chance = lambda z: 1 / (1 + math.exp(-max(-60.0, min(60.0, z))))

        def score(text: str | None) -> tuple[float, int, list[dict]]:
            plain, evidence = 0, []
            for m in _sentences(text or ""):
                words = _words(m[0].lower())
                if hits := {x for w in words for x in known[w]}:
                    evidence.append((m.start(), m.end(), math.fsum(w for _, w in hits)))
                else:
                    plain += bool(words)
            n, found = plain + len(evidence), []
            prior = self.bias - math.log(max(n, 1))
            clean = plain * math.log1p(-chance(prior))
            for start, end, z in evidence:
                p = chance(prior + z)
                clean += math.log1p(-min(p, 1 - 1e-12))
                if p >= THRESHOLD:
                    found.append({"start": start, "end": end, "score": p})
            return -math.expm1(clean), n, found

        return score


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents and toxic documents of each feature, summed by batch."""
    for batch in batches:
        seen, toxic = Counter(), Counter()
        for label, text in zip(batch.column(0).to_pylist(), batch.column(1)):
            found = {f for w in set(_words((text.as_py() or "").lower())) for f in features_of(w)}
            seen.update(found)
            if label > 0:
                toxic.update(found)
        names = list(seen)
        columns = [pa.array(names, pa.string()), pa.array([seen[f] for f in names], pa.int64()), pa.array([toxic[f] for f in names], pa.int64())]
        yield pa.record_batch(columns, names=["feature", "n", "t"])


def _numbered(names: list[str]):
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Numbers of the features in each sentence of the training documents, and how many sentences have them."""
        known = _Known({f: i for i, f in enumerate(names)})
        for batch in batches:
            rows, counts = [], []
            for text in batch.column(1):
                each = (_words(m[0].lower()) for m in _sentences(text.as_py() or ""))
                alike = sorted(Counter(tuple(sorted({x for w in words for x in known[w]})) for words in each if words).items())
                rows.append([list(x) for x, _ in alike])
                counts.append([n for _, n in alike])
            columns = [batch.column(0), pa.array(rows, pa.list_(pa.list_(pa.int32()))), pa.array(counts, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["toxic", "sentences", "counts"])

    return number


def remainder(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5))


def training_rows(docs: DataFrame, labels: DataFrame, limit: int = MAX_TRAIN) -> DataFrame:
    """`toxic, text` of at most `limit` labelled documents that are not held out, one row an id."""
    known = labels.where(F.col("toxic").isNotNull() & (remainder(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    # The ids are bounded by `limit`, so they are sent to the texts.
    sample = known.orderBy(F.xxhash64(F.col("doc_id").cast("string"), F.lit(7)), "doc_id").limit(limit)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
    return rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"), F.max("text").alias("text")).drop("doc_id")


def telling_features(rows: DataFrame, n: int, t: int, max_words: int = MAX_WORDS, least_docs: int = LEAST_DOCS) -> list[str]:
    """Features whose documents differ most in label, by the chi-square statistic, among `n` documents with `t` toxic ones."""
    counts = rows.mapInArrow(_count, "feature string, n bigint, t bigint").groupBy("feature").agg(F.sum("n").alias("n"), F.sum("t").alias("t"))
    expected = F.col("n") * F.lit(t / n)
    gain = F.pow(F.col("t") - expected, F.lit(2)) / F.greatest(expected * F.lit(1 - t / n) * (1 - F.col("n") / F.lit(n)), F.lit(1e-9))
    best = counts.where(F.col("n") >= least_docs).orderBy(F.round(gain, 6).desc(), "feature").limit(max_words)
    return [r["feature"] for r in best.select("feature").collect()]


def fit(rows: DataFrame, max_words: int = MAX_WORDS, least_docs: int = LEAST_DOCS) -> Model:
    """Fit to `toxic, text` rows, whose number is bounded by the caller."""
    rows = written_table(rows, "toxicity-sample")
    sums = rows.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("toxic") > 0).alias("t")).first()
    if not 0 < sums["t"] < sums["n"]:
        return Model()
    words = telling_features(rows, sums["n"], sums["t"], max_words, least_docs)
    featured = rows.mapInArrow(_numbered(words), "toxic int, sentences array<array<int>>, counts array<bigint>").toArrow()
    columns = (featured.column(name).to_pylist() for name in ("toxic", "sentences", "counts"))
    documents = sorted((int(label > 0), sentences, counts) for label, sentences, counts in zip(*columns))
    y = np.array([label for label, _, _ in documents], np.float64)
    many = np.array([n for _, _, counts in documents for n in counts], np.float64)
    owner, sentence, word = [], [], []
    for d, (_, sentences, _) in enumerate(documents):
        for s in sentences:
            word += s
            sentence += [len(owner)] * len(s)
            owner.append(d)
    owner, sentence, word = (np.array(x, np.int64) for x in (owner, sentence, word))
    length = np.log(np.maximum(np.bincount(owner, many, len(y)), 1))[owner]
    w, moments, rate = np.append(np.zeros(len(words)), _START_BIAS), np.zeros((2, len(words) + 1)), 0.1
    for step in range(1, STEPS + 1):
        z = w[-1] - length + np.bincount(sentence, w[word], len(owner))
        # -log(1 - p) of a sentence is softplus(z); a document's is their sum.
        total = np.bincount(owner, many * np.logaddexp(0, z), len(y))
        slope = np.where(y > 0, -1 / np.expm1(np.clip(total, 1e-9, 700)), 1.0) / len(y)
        by_sentence = slope[owner] * many / (1 + np.exp(-z))
        gradient = np.append(np.bincount(word, by_sentence[sentence], len(words)) + _DECAY * w[:-1], by_sentence.sum())
        moments[0] = 0.9 * moments[0] + 0.1 * gradient
        moments[1] = 0.999 * moments[1] + 0.001 * gradient**2
        w -= rate * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.999**step)) + 1e-9)
    return Model(float(w[-1]), {x: float(v) for x, v in zip(words, w) if abs(v) > 1e-3})


_SCORED = pa.schema(
    [("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()), ("predicted", pa.int32()), ("n_sentences", pa.int64())]
    + [("offending", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))]
)
_SCORED_DDL = (
    "doc_id bigint, held_out boolean, score double, predicted int, n_sentences bigint, "
    "offending array<struct<start: bigint, end: bigint, score: double>>"
)


def _score(model: Model):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = model.scorer()
        for batch in batches:
            out: dict[str, list] = {name: [] for name in _SCORED.names}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                value, n, found = of(text.as_py())
                held = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0
                for name, x in zip(_SCORED.names, (doc_id, held, value, int(value >= THRESHOLD), n, found)):
                    out[name].append(x)
            yield pa.record_batch([pa.array(out[f.name], f.type) for f in _SCORED], schema=_SCORED)

    return score


def scored(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`doc_id, held_out, score, predicted, n_sentences, offending` of each row; spans count characters from 0."""
    plain = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return plain.mapInArrow(_score(model), _SCORED_DDL)
