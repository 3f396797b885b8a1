"""Quality rules: statistics of each document, two fixed rules, and an isolation forest on the statistics.

Statistics are counted over whole texts. The forest is grown on every document labelled good: random splits of random
statistics, anywhere between the least and the largest value of all labelled rows (so that a statistic which is constant
among good rows can still set others apart), and a document is the more anomalous the shorter its mean path. Where cuts
fall does not depend on the rows, so all trees are drawn first, the executors count the good rows in each leaf, and a node
with fewer than two becomes a leaf. The threshold is calibrated on every labelled row, good ones as the forest without
them sees them (one row less in each node on their path): the score with the best balance of bad documents found and good
ones kept, among those that keep at least `keep` of the good ones. No row is sampled; the driver gets counts of leaves and
of bins of scores, which don't grow with the rows. A document that fails a base rule isn't kept whatever the forest says.
Without labels the forest keeps all.

Defined results: a null or empty text has no words and fails the base rule; several labels of one document count as one
(the smallest); null ids have no label; repeated rows get equal verdicts; an empty table gives an empty result; other
columns pass through, whatever their names, and those with the names of new columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.llm.common import discard, extended, materialize, quoted, WHITE
from tallystone.llm.words import hashed, windows

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_digits", "n_marks")
MIN_WORDS, MAX_REPEAT = 50, 50
TREES, DEPTH, SEED = 100, 12, 31
#: Bins of scores whose totals the driver gets.
BINS = 1 << 16
KEEP = 0.99
#: With fewer good rows the forest is calibrated on those that it was grown on.
FEW = 40
NEW = (*COUNTS, "base_failed", "anomaly", "kept")


def _kinds(chars: str) -> np.ndarray:
    return np.array([c < 128 and chr(c) in chars for c in range(256)])


_IS = {name: _kinds(chars) for name, chars in (("white", WHITE), ("symbols", SYMBOLS), ("upper", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"), ("digits", "0123456789"), ("marks", ".,;:!?"))}
_FIRST_BYTE = np.array([not 0x80 <= c < 0xC0 for c in range(256)])


def counts(text: bytes | None) -> tuple[int, ...]:
    """The COUNTS of a text in UTF-8."""
    if not text:
        return (0,) * len(COUNTS)
    byte = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = hashed([text])[0]
    seen, dup, lines = set(), 0, 0
    for line in text.split(b"\n"):
        if line.strip():
            lines += 1
            dup += line in seen
            seen.add(line)
    threes = windows(words, 3)
    repeat = 0
    if len(threes):
        ordered = np.sort(threes)
        twice = ordered[1:][ordered[1:] == ordered[:-1]]
        if len(twice):
            twice = np.unique(twice)
            place = np.minimum(np.searchsorted(twice, threes), len(twice) - 1)
            edge = np.zeros(len(words) + 1, np.int64)
            at = np.flatnonzero(twice[place] == threes)
            edge[at] += 1
            edge[at + 3] -= 1
            repeat = int((np.cumsum(edge)[:-1] > 0).sum())
    white = int(byte[_IS["white"]].sum())
    return (len(words), int(byte[_FIRST_BYTE].sum()) - white, int(byte[_IS["symbols"]].sum()), dup, repeat, lines, *(int(byte[_IS[k]].sum()) for k in ("upper", "digits", "marks")))


def with_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """docs without the text, with the COUNTS."""
    at = f"c{docs.columns.index(text_col)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        for batch in batches:
            got = np.array([counts(t) for t in batch.column(at).cast(pa.binary()).to_pylist()], np.int64).reshape(-1, len(COUNTS))
            yield batch, [pa.array(got[:, i]) for i in range(len(COUNTS))]

    return extended(docs, run, [T.StructField(n, T.LongType()) for n in COUNTS], without=(text_col,))


def rules(c: np.ndarray) -> np.ndarray:
    """The forest's statistics from the COUNTS: the mean word's length, and shares as logarithms."""
    words, chars, symbols, dup, repeat, lines, upper, digits, marks = c.astype(float).T
    w, k, n = np.maximum(words, 1), np.maximum(chars, 1), np.maximum(lines, 1)
    return np.stack([np.minimum(chars / w, 40), np.log1p(100 * symbols / k), np.log1p(100 * dup / n), np.log1p(100 * repeat / w), np.log1p(100 * upper / k), np.log1p(100 * digits / k), np.log1p(10 * marks / w)], axis=1)


def drawn(low: np.ndarray, high: np.ndarray, trees: int = TREES, depth: int = DEPTH, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """The feature and the cut of each inner node of full trees (a node's children: 2k + 1 and 2k + 2). Cuts fall anywhere
    in a node's box, so that the space where no good row lies is cut off early."""
    rng, open_ = np.random.default_rng(seed), np.flatnonzero(high > low)
    if not len(open_):
        return np.zeros((trees, 0), np.int8), np.zeros((trees, 0))
    feature, cut = np.empty((trees, (1 << depth) - 1), np.int8), np.empty((trees, (1 << depth) - 1))
    for t in range(trees):
        least, most = low[None, :], high[None, :]
        for level in range(depth):
            n = 1 << level
            nodes, f = np.arange(n), open_[rng.integers(0, len(open_), n)]
            at = rng.uniform(least[nodes, f], most[nodes, f])
            feature[t, n - 1 : 2 * n - 1], cut[t, n - 1 : 2 * n - 1] = f, at
            least, most = np.repeat(least, 2, axis=0), np.repeat(most, 2, axis=0)
            most[2 * nodes, f] = least[2 * nodes + 1, f] = at
    return feature, cut


def leaves(x: np.ndarray, feature: np.ndarray, cut: np.ndarray) -> Iterator[np.ndarray]:
    """For each full tree the leaf of each row, from 0."""
    inner, rows = feature.shape[1], np.arange(len(x))
    for f, c in zip(feature, cut, strict=True):
        node = np.zeros(len(x), np.int64)
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, f[node]] > c[node])
        yield node - inner


class Forest:
    """Isolation trees as flat arrays: feature (-1 at a leaf), cut, left child (right: the next), length at the leaf.

    held: the rows in each leaf of each full tree; left_out: as if there were so many fewer in each node, which is what
    a row on a node's path sees when it is left out.
    """

    def __init__(self, feature: np.ndarray, cut: np.ndarray, held: np.ndarray, left_out: int = 0):
        self.size, self.depth = int(held[0].sum()), (feature.shape[1] + 1).bit_length() - 1
        self.trees = [self._pruned(f, c, h, left_out) for f, c, h in zip(feature, cut, held, strict=True)]
        self.threshold = np.inf

    @staticmethod
    def _mean_path(n):
        """The mean path of an unsuccessful search in a binary tree of n rows."""
        m = np.maximum(n, 3)
        return np.where(np.less(n, 2), 0.0, np.where(np.equal(n, 2), 1.0, 2 * (np.log(m - 1) + 0.5772156649) - 2 * (m - 1) / m))

    def _pruned(self, feature: np.ndarray, cut: np.ndarray, held: np.ndarray, left_out: int):
        levels = [held]
        while len(levels[0]) > 1:
            levels.insert(0, levels[0].reshape(-1, 2).sum(axis=1))
        count = np.concatenate(levels) - left_out
        inner = np.zeros(len(count), bool)
        inner[: len(feature)] = count[: len(feature)] >= 2
        there = np.zeros(len(count), bool)
        there[0] = True
        for level in range(self.depth):
            k = np.arange((1 << level) - 1, (2 << level) - 1)
            there[2 * k + 1] = there[2 * k + 2] = there[k] & inner[k]
        node, new = np.flatnonzero(there), np.cumsum(there) - 1
        split = inner[node]
        child = np.zeros(len(node), np.int32)
        child[split] = new[2 * node[split] + 1]
        kind, at = np.full(len(node), -1, np.int8), np.zeros(len(node))
        kind[split], at[split] = feature[node[split]], cut[node[split]]
        depth = np.frexp((node + 1).astype(float))[1] - 1
        return kind, at, child, np.where(split, 0.0, depth + self._mean_path(count[node]))

    def score(self, x: np.ndarray) -> np.ndarray:
        """2^(-mean path / expected path): near 1 for anomalies."""
        total = np.zeros(len(x))
        rows = np.arange(len(x))
        for feature, cut, child, length in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                f = feature[node]
                inner = f >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(f, 0)] > cut[node]
                node = np.where(inner, child[node] + right, node)
            total += length[node]
        return 2.0 ** (-total / len(self.trees) / max(self._mean_path(self.size), 1e-9))


def _judged(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The statistics of the rows that pass the base rules, and which are good."""
    c = np.stack([np.asarray(batch.column(n)) for n in COUNTS], axis=1).reshape(-1, len(COUNTS))
    passed = ~base_failed(c)
    return rules(c[passed]), np.asarray(batch.column("quality"))[passed] > 0


def _bounds(rows: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """How many rows are good, and the least and the largest value of each statistic of all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, good = _judged(batch)
            if len(x):
                n = x.shape[1]
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, good.sum())), pa.array(x.min(0)), pa.array(x.max(0))], names=["f", "good", "low", "high"])

    got = rows.mapInArrow(run, "f int, good long, low double, high double").groupBy("f").agg(F.sum("good").alias("good"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("f").collect()
    return (got[0]["good"] if got else 0), np.array([r["low"] for r in got]), np.array([r["high"] for r in got])


def _held(rows: DataFrame, feature: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The good rows in each leaf of each tree."""
    n = feature.shape[1] + 1
    sent = rows.sparkSession.sparkContext.broadcast((feature, cut))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(feature) * n, np.int64)
        for batch in batches:
            x, good = _judged(batch)
            for t, leaf in enumerate(leaves(x[good], *sent.value)):
                total[t * n : (t + 1) * n] += np.bincount(leaf, minlength=n)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["leaf", "n"])

    got = rows.mapInArrow(run, "leaf int, n long").groupBy("leaf").agg(F.sum("n").alias("n")).toArrow()  # a row a leaf
    total = np.zeros(len(feature) * n, np.int64)
    total[got.column("leaf").to_numpy()] = got.column("n").to_numpy()
    return total.reshape(-1, n)


def best_threshold(scored: DataFrame, keep: float) -> float:
    """The threshold between scores with the best balance, keeping at least `keep` of the good. scored: score, good (0, 1)."""
    levels = materialize(scored.groupBy("score").agg(F.sum("good").alias("g"), F.sum(1 - F.col("good")).alias("b")).withColumn("bin", F.floor(F.col("score") * BINS).cast("int")))
    bins = levels.groupBy("bin").agg(F.sum("g").alias("g"), F.sum("b").alias("b")).orderBy("bin").collect()
    g, b = (np.cumsum([r[c] for r in bins], dtype=np.int64) for c in "gb")
    if not bins or not g[-1] or not b[-1]:
        return np.inf
    before = [(r["bin"], int(x) - r["g"], int(y) - r["b"]) for r, x, y in zip(bins, g, b, strict=True)]
    before = levels.sparkSession.createDataFrame(before, "bin int, g0 long, b0 long")
    upto = Window.partitionBy("bin").orderBy("score").rowsBetween(Window.unboundedPreceding, 0)
    counted = levels.withColumns({"g": F.sum("g").over(upto), "b": F.sum("b").over(upto)}).join(F.broadcast(before), "bin")
    counted = counted.select("score", (F.col("g") + F.col("g0")).alias("g"), (F.col("b") + F.col("b0")).alias("b"))
    balance = F.col("g") * int(b[-1]) - F.col("b") * int(g[-1])
    best = counted.where(F.col("g") / int(g[-1]) >= keep).agg(F.max_by("score", F.struct(balance, -F.col("score"))).alias("at")).first()["at"]
    above = levels.where(F.col("score") > best).agg(F.min("score").alias("at")).first()["at"]
    discard(levels)
    return best if above is None else (best + above) / 2


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, keep: float = KEEP) -> Forest | None:
    """labels: doc_id, quality. All labelled documents take part."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("_id")).agg(F.min("quality").alias("quality"))
    counted = with_counts(docs.select(docs[quoted(id_col)].alias("_doc"), docs[quoted(text_col)].alias("text")))
    rows = counted.join(known, F.col("_doc") == F.col("_id")).groupBy("_id").agg(F.min("quality").cast("long").alias("quality"), *(F.min(n).alias(n) for n in COUNTS))
    rows = materialize(rows.drop("_id"))
    n, low, high = _bounds(rows)
    if not n:
        return None
    feature, cut = drawn(low, high)
    held = _held(rows, feature, cut)
    forest = Forest(feature, cut, held)
    both = rows.sparkSession.sparkContext.broadcast((forest, Forest(feature, cut, held, left_out=1) if n >= FEW else forest))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, good = _judged(batch)
            score = np.concatenate([both.value[1].score(x[good]), both.value[0].score(x[~good])])
            yield pa.RecordBatch.from_arrays([pa.array(score), pa.array(np.sort(~good) ^ True).cast(pa.int64())], names=["score", "good"])

    forest.threshold = best_threshold(rows.mapInArrow(run, "score double, good long"), keep)
    discard(rows)
    return forest


def base_failed(c: np.ndarray) -> np.ndarray:
    words, repeat = c[:, 0], c[:, 4]
    return (words < MIN_WORDS) | (100 * repeat > MAX_REPEAT * words)


def judge(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """docs without the text, with the COUNTS, base_failed, anomaly (0 to 1) and kept."""
    counted = with_counts(docs, text_col)
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, **options))
    at = [f"c{counted.columns.index(n)}" for n in COUNTS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        forest = held.value
        for batch in batches:
            c = np.stack([np.asarray(batch.column(n)) for n in at], axis=1).reshape(-1, len(COUNTS))
            failed = base_failed(c)
            score = forest.score(rules(c)) if forest else np.zeros(len(c))
            kept = ~failed & (score <= (forest.threshold if forest else np.inf))
            yield batch, [pa.array(failed), pa.array(score), pa.array(kept)]

    return extended(counted, run, [T.StructField("base_failed", T.BooleanType()), T.StructField("anomaly", T.DoubleType()), T.StructField("kept", T.BooleanType())])
