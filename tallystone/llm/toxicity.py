"""Toxicity by multiple-instance learning: sentences are scored, a document is toxic if any sentence is.

A sentence's probability is logistic in the weights of its distinct words and of their beginnings; a document's is the noisy-or of its
sentences. Weights (hashed words) are learned from document labels alone by gradient descent on the noisy-or's log loss
with an L1 penalty, on a bounded sample of labelled documents. Sentences above the level are returned as spans.

Learning reads rows whose crc32(doc_id as text) mod 3 is not 1, `sample` of them and `fit_bytes` of text at most, taken by
a hash of the id; all rows are scored, whole.

Defined results: a null or empty text has no sentence and scores 0; without labels every weight is 0; several labels of
one document count as one (the largest); a null id is in fold 0 and never learned from; repeated rows get equal scores;
an empty table gives an empty result; other columns pass through, whatever their names, and those with the names of new
columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallystone.llm.common import extended, fold, HELD_OUT, quoted, spread

SAMPLE, FIT_BYTES, SEED = 5000, 64 << 20, 23
SPACE = 1 << 18
ROUNDS, RATE, SPARSE = 150, 0.15, 5e-5
START, RARE = -6.0, 3
STEMS = (4, 5, 6, 7)
LEVEL = 0.7
SENTENCE = regex.compile(r"[^.!?\n]+")
NEW = ("held_out", "score", "predicted", "offending")


def places_of(word: str) -> list[int]:
    """The weights of a word: its own, and those of its beginnings, which inflected forms share. Punctuation around it
    and case don't count."""
    bare = word.strip("\"'()[]{}<>,;:*#$%&|_-").lower()
    parts = [bare, *(f"{bare[:n]}-" for n in STEMS if len(bare) > n)] if bare else []
    return [xxhash.xxh3_64_intdigest(p) % SPACE for p in parts]


class Features(dict):
    """places_of by word; bounded."""

    def __missing__(self, word: str) -> list[int]:
        if len(self) >= 300_000:
            self.clear()
        places = self[word] = places_of(word)
        return places


def sentences(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in SENTENCE.finditer(text) if not m.group().isspace()]


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))


class Scorer(dict):
    """A word -> the sum of its weights (kept, bounded); a sentence sums its distinct words and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def __reduce__(self):
        return Scorer, (self.weights, self.bias)

    def __missing__(self, word: str) -> float:
        if len(self) >= 300_000:
            self.clear()
        value = self[word] = float(sum(self.weights[i] for i in places_of(word)))
        return value

    def sentence_scores(self, text: str | None) -> tuple[list[tuple[int, int]], np.ndarray]:
        spans = sentences(text) if text else []
        return spans, _sigmoid(np.array([self.bias + sum(map(self.__getitem__, set(text[a:b].split()))) for a, b in spans]))


def noisy_or(p: np.ndarray) -> float:
    return float(1.0 - np.exp(np.log1p(-np.minimum(p, 1 - 1e-12)).sum()))


def learn(texts: list[str], labels: list[int]) -> Scorer:
    """Adam on the noisy-or's log loss; the L1 step keeps words that tell nothing at 0."""
    weights, bias = np.zeros(SPACE), START
    flat, sizes, of, y = [], [], [], []
    in_docs, known = np.zeros(SPACE, np.int32), Features()
    for text, label in zip(texts, labels, strict=True):
        held = [[i for w in set(text[a:b].split()) for i in known[w]] for a, b in sentences(text)]
        held = [b for b in held if b]
        if held:
            own = np.fromiter((x for b in held for x in b), np.int32)
            in_docs[np.unique(own)] += 1
            flat.append(own)
            sizes += map(len, held)
            of.append(len(held))
            y.append(label)
    if not y or len(set(y)) < 2:
        return Scorer(weights, bias)
    every = np.concatenate(flat)
    places, word = np.unique(every, return_inverse=True)
    told = in_docs[places] >= RARE  # a word of fewer documents tells nothing
    begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    first = np.concatenate(([0], np.cumsum(of)[:-1]))
    word, told = word.astype(np.int32), told.copy()
    sentence = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    del every, flat
    doc = np.repeat(np.arange(len(of)), of)
    y = np.array(y, float)
    w, b, m, v = np.zeros(len(places)), bias, np.zeros(len(places) + 1), np.zeros(len(places) + 1)
    for step in range(1, ROUNDS + 1):
        p = np.minimum(_sigmoid(b + np.add.reduceat(w[word], begin)), 1 - 1e-9)
        whole = np.clip(-np.expm1(np.add.reduceat(np.log1p(-p), first)), 1e-9, 1 - 1e-9)
        slope = np.where(y > 0, -(1 - whole) / whole, 1.0)[doc] * p / len(y)
        g = np.append(np.bincount(word, slope[sentence], len(places)), slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        rate = RATE / (np.sqrt(v[:-1] / (1 - 0.99**step)) + 1e-8)
        w = w - move[:-1]
        w = np.where(told, np.sign(w) * np.maximum(np.abs(w) - SPARSE * rate, 0), 0)
        b = min(b - float(move[-1]) * 0.2, -2.0)
    weights[places] = w
    return Scorer(weights, float(b))


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, sample: int = SAMPLE, fit_bytes: int = FIT_BYTES) -> Scorer:
    """labels: doc_id, toxic. Labelled rows come to the driver in the order of a hash of their ids: at most `sample`, and
    no more than hold `fit_bytes` of text together."""
    known = labels.where("doc_id is not null and toxic is not null").where(fold(F.col("doc_id")) != HELD_OUT).groupBy("doc_id").agg(F.max("toxic").alias("y"))
    chosen = known.withColumn("place", spread(F.col("doc_id").cast("long"), SEED)).orderBy("place", "doc_id").limit(sample)
    texts = docs.select(docs[quoted(id_col)].alias("id"), docs[quoted(text_col)].alias("t")).where(F.col("t").isNotNull())
    held = texts.join(F.broadcast(chosen), F.col("id") == F.col("doc_id")).groupBy("doc_id", "place").agg(F.min("t").alias("t"), F.max("y").alias("y"))
    upto = Window.orderBy("place", "doc_id").rowsBetween(Window.unboundedPreceding, 0)  # over `sample` rows at most
    got = held.withColumn("upto", F.sum(F.octet_length("t")).over(upto)).where(F.col("upto") <= fit_bytes).orderBy("doc_id").collect()
    return learn([r["t"] for r in got], [int(r["y"] > 0) for r in got])


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", level: float = LEVEL, **options) -> DataFrame:
    """docs with held_out, score, predicted and offending: (first, end, score) of sentences at or above the level, in
    characters; where the document reaches the level by several sentences only, the highest of them."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, **options))
    span = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]))
    kind = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
    at = f"c{docs.columns.index(text_col)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            scores, found = [], []
            for text in batch.column(at):
                spans, p = held.value.sentence_scores(text.as_py())
                whole = noisy_or(p)
                above = np.flatnonzero(p >= level).tolist() or ([int(np.argmax(p))] if whole >= level else [])
                scores.append(whole)
                found.append([{"first": spans[i][0], "end": spans[i][1], "score": float(p[i])} for i in above])
            yield batch, [pa.array(scores, pa.float64()), pa.array([int(s >= level) for s in scores], pa.int32()), pa.array(found, kind)]

    made = extended(docs, run, [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("offending", span)])
    kept = [c for c in docs.columns if c not in NEW]
    return made.select(*(made[quoted(c)] for c in kept), (fold(made[quoted(id_col)]) == HELD_OUT).alias("held_out"), "score", "predicted", "offending")
