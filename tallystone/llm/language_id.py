"""Language identification with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn by a hash of its code point, so every letter of every script has one of
its own. An n-gram's vector binds its letters' vectors, each rotated by its place (rotate, multiply); a text's vector
bundles (adds) those of all its n-grams; a language's prototype bundles its labelled texts, each scaled to one length, so
that a long one of few words doesn't outweigh the others. A text has the language whose
prototype's cosine is largest. As bundling adds, a text's dot product with a prototype is the sum over its n-grams of the
n-gram's dot product with it; each Python worker keeps those of the n-grams that it has met (a bounded number; others are
computed again), which gives the same numbers without a vector for each text. The text's norm is that of orthogonal
n-grams, sqrt(dimensions * sum of squared counts); it scales all cosines of a text alike.

The fit bundles, on the executors, a bounded sample of labelled texts of each language: `sample` rows, or an equal share
of `total` rows if there are very many languages. Rows are chosen by a hash of id and text. What comes to the driver is a
vector a language. No language is left out; all texts are predicted whole.

Defined results: a null text or one without a letter is `und` with score 0, as is any text when nothing was learned; a
null language teaches nothing; a null id is in fold 0; null and repeated ids change nothing in the bounds of the fit;
repeated rows get equal predictions; ties go to the language first in alphabetical order; an empty table gives an empty
result; other columns pass through, whatever their names, and those with the names of new columns are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallystone.llm.common import claim, extended, fold, HELD_OUT, mix64, quoted, small_batches

DIMENSIONS, ORDER = 2048, 3
SAMPLE, TOTAL, SEED = 1500, 60_000, 11
SHARP = 25.0
UNKNOWN = "und"
NEW = ("held_out", "lang_pred", "score")
#: Numbers that a worker keeps of n-grams (n-grams times languages); n-grams whose vectors are made at once; bits of a code point.
KEPT, AT_ONCE, BITS = 1 << 22, 1024, np.uint64(21)
_ALPHA: list[np.ndarray] = []


def _is_letter(points: np.ndarray) -> np.ndarray:
    if not _ALPHA:
        _ALPHA.append(np.array([chr(i).isalpha() for i in range(1 << 16)]))
    found = _ALPHA[0][np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        found[i] = chr(points[i]).isalpha()
    return found


def codes(text: str | None) -> np.ndarray:
    """The n-grams of a text in lower case, code points side by side; what is no letter parts words (0), runs of it count
    once. A text without letters has none."""
    points = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _is_letter(points)
    if not letter.any():
        return np.empty(0, np.uint64)
    place = np.zeros(len(points) + 2, np.uint64)
    place[1:-1] = np.where(letter, points, 0)
    keep = np.ones(len(place), bool)
    keep[1:] = (place[1:] != 0) | (place[:-1] != 0)
    place = place[keep]
    out = np.zeros(len(place) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        out = (out << BITS) | place[i : len(place) - ORDER + 1 + i]
    return out


def letter_bits(points: np.ndarray, seed: int = SEED) -> np.ndarray:
    """A row of random bits for each code point; 1 stands for -1."""
    words = DIMENSIONS // 64
    with np.errstate(over="ignore"):
        drawn = mix64(mix64(points.astype(np.uint64) + np.uint64(seed << 32))[:, None] + np.arange(1, words + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return np.unpackbits(drawn.view(np.uint8), axis=1)


def vectors(grams: np.ndarray) -> np.ndarray:
    """The bound vector of each n-gram, as float32 of +1 and -1."""
    bound = np.zeros((len(grams), DIMENSIONS), np.uint8)
    for i in range(ORDER):
        letters, at = np.unique((grams >> BITS * np.uint64(ORDER - 1 - i)) & np.uint64((1 << int(BITS)) - 1), return_inverse=True)
        bound ^= np.roll(letter_bits(letters), ORDER - 1 - i, axis=1)[at]
    return 1.0 - 2.0 * bound.astype(np.float32)


def bundle(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The sum of the n-grams' vectors, each as often as it counts."""
    total = np.zeros(DIMENSIONS)
    for a in range(0, len(grams), AT_ONCE):
        total += counts[a : a + AT_ONCE].astype(np.float64) @ vectors(grams[a : a + AT_ONCE])
    return total


class Profiles:
    """Unit prototypes of the languages; a worker's known n-grams and their dot products with them."""

    def __init__(self, langs: list[str], bundles: np.ndarray):
        self.langs = langs
        norm = np.linalg.norm(bundles, axis=1, keepdims=True)
        self.prototypes = (bundles / np.where(norm > 0, norm, 1)).astype(np.float32)
        self.forget()

    def forget(self) -> None:
        self.known, self.dots = np.empty(0, np.uint64), np.empty((0, len(self.langs)), np.float32)

    def learn(self, grams: np.ndarray) -> None:
        """Makes sorted, distinct n-grams known."""
        place = np.minimum(np.searchsorted(self.known, grams), max(len(self.known) - 1, 0))
        new = grams[self.known[place] != grams] if len(self.known) else grams
        if not len(new):
            return
        if (len(self.known) + len(new)) * len(self.langs) > KEPT:
            self.forget()
            new = grams
        dots = np.concatenate([vectors(new[a : a + AT_ONCE]) @ self.prototypes.T for a in range(0, len(new), AT_ONCE)])
        at = np.searchsorted(self.known, new)
        self.known, self.dots = np.insert(self.known, at, new), np.insert(self.dots, at, dots, axis=0)

    def cosines(self, text: str | None) -> np.ndarray | None:
        """The text's cosine with each prototype; null without letters."""
        own = codes(text)
        if not len(own) or not self.langs:
            return None
        own.sort()
        begin = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        count, grams = np.diff(np.append(begin, len(own))).astype(np.float64), own[begin]
        dots, most = np.zeros(len(self.langs)), max(1, KEPT // len(self.langs))
        for a in range(0, len(grams), most):
            part = grams[a : a + most]
            self.learn(part)
            dots += count[a : a + most] @ self.dots[np.searchsorted(self.known, part)]
        return dots / np.sqrt(DIMENSIONS * (count**2).sum())

    def predict(self, text: str | None) -> tuple[str, float]:
        cosine = self.cosines(text)
        if cosine is None:
            return UNKNOWN, 0.0
        weight = np.exp(SHARP * (cosine - cosine.max()))
        best = int(np.argmax(cosine))
        return self.langs[best], float(weight[best] / weight.sum() * np.clip(cosine[best] / 0.25, 0.0, 1.0))


def sampled(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int, total: int) -> DataFrame:
    """(lang, text): for each language a bounded number of rows, none of them held out."""
    one, text, lang = docs[quoted(id_col)], docs[quoted(text_col)], docs[quoted(lang_col)]
    known = docs.where(lang.isNotNull() & text.isNotNull() & (fold(one) != HELD_OUT)).select(lang.cast("string").alias("lang"), text.alias("text"), F.xxhash64(F.lit(SEED), one, text).alias("place"))
    different = known.groupBy("lang").agg(F.approx_count_distinct("place").alias("n"))
    most = F.greatest(F.lit(1), F.least(F.lit(sample), F.floor(F.lit(total) / F.count("*").over(Window.partitionBy()))))  # a row a language
    wanted = different.select("lang", most.alias("most"), (2.0 * most / F.col("n")).alias("share"))
    thin = known.join(F.broadcast(wanted), "lang").where(F.pmod("place", F.lit(1 << 32)) < F.col("share") * float(1 << 32))
    first = F.row_number().over(Window.partitionBy("lang").orderBy("place"))
    return thin.withColumn("nth", first).where(F.col("nth") <= sample).where(F.col("nth") <= F.col("most")).select("lang", "text")


def fit(docs: DataFrame, id_col: str, text_col: str, lang_col: str, sample: int = SAMPLE, total: int = TOTAL) -> Profiles:
    """Prototypes of all languages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}

        def made(lang: str) -> pa.RecordBatch:
            codes_, weights = (np.concatenate(x) for x in zip(*held.pop(lang), strict=True))
            grams, place = np.unique(codes_, return_inverse=True)
            total = bundle(grams, np.bincount(place, weights, len(grams)))
            return pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([total.tolist()], pa.list_(pa.float64()))], names=["lang", "bundle"])

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text"), strict=True):
                grams, counts = np.unique(codes(text.as_py()), return_counts=True)
                held.setdefault(lang, []).append((grams, counts / max(1.0, np.sqrt((counts.astype(float) ** 2).sum()))))
                if sum(len(g) for g, _ in held[lang]) > 1 << 21 or len(held) > 64:
                    yield made(lang)
        for lang in list(held):
            yield made(lang)

    small_batches(docs.sparkSession)
    rows = sampled(docs, id_col, text_col, lang_col, sample, total).mapInArrow(run, "lang string, bundle array<double>").collect()
    langs = sorted({r["lang"] for r in rows})
    at, bundles = {x: i for i, x in enumerate(langs)}, np.zeros((len(langs), DIMENSIONS))
    for r in rows:
        bundles[at[r["lang"]]] += r["bundle"]
    return Profiles(langs, bundles)


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """docs with held_out, lang_pred and score (0 to 1)."""
    held = docs.sparkSession.sparkContext.broadcast(fit(docs, id_col, text_col, lang_col, **options))
    at = f"c{docs.columns.index(text_col)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        profiles = held.value
        claim("language", profiles.forget)
        for batch in batches:
            got = [profiles.predict(t.as_py()) for t in batch.column(at)]
            yield batch, [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())]

    found = extended(docs, run, [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    kept = [c for c in docs.columns if c not in NEW]
    return found.select(*(found[quoted(c)] for c in kept), (fold(found[quoted(id_col)]) == HELD_OUT).alias("held_out"), "lang_pred", "score")
