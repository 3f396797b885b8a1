"""BPE encoding and decoding by forced boundaries.

A pair of bytes that stands inside no vocabulary token can't be bridged by any merge, so a cut between the two is
certain. Texts are first cut at the added special tokens and at the pre-tokenizer's boundaries (certain as well, and
dependent on context, so they come first), then at every forced pair; each fragment is merged on its own and the ids
are concatenated. Fragments repeat, so their ids are kept in a bounded cache.

Ids equal those of the tokenizers library for byte-level BPE files without normalizer, prefix space and dropout
(others are refused). Decoding concatenates the bytes of the tokens and reads them as UTF-8, with U+FFFD for what is
no UTF-8.

Defined results: a null text counts as empty and has no ids; whole texts are encoded, however long; rows may repeat;
an empty table gives an empty result; other columns pass through, whatever their names, and those with the names of new columns are replaced.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import sys
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallystone.llm.common import claim, release, extended

#: The byte-level pre-tokenizer's pattern.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
CACHE = 400_000
#: Marks that stand behind words; below this letter no Unicode version changes what a letter is.
MARKS, SETTLED = ".,;:!?", "\u0250"
#: Fragments above this length are merged with a heap. Ids fit in 20 bits; NONE is above all ranks.
LONG, MASK, NONE = 64, (1 << 20) - 1, 1 << 60
NEW = ("n_tokens", "ids", "ids_sha256", "decoded_text", "decoded_sha256")


def byte_letters() -> dict[str, int]:
    """The letter that byte-level vocabularies write for each byte: printable Latin-1 itself, others from U+0100 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """A byte-level BPE file: ranks of merges, ids, forced boundaries and special tokens."""

    def __init__(self, data: bytes, cache: int = CACHE):
        self.cache = cache
        held = json.loads(data)
        model, pre = held["model"], held.get("pre_tokenizer") or {}
        if held.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True) or model.get("dropout") or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE file")
        letters = byte_letters()
        raw = lambda token: bytes(letters[c] for c in token)
        self.ids = {raw(t): i for t, i in model["vocab"].items() if all(c in letters for c in t)}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        if max(self.ids.values()) > MASK:
            raise ValueError("too many tokens")
        ids = model["vocab"]
        #: two ids in one number -> the merge's rank and the id that it makes, in one number
        self.joined = {ids[a] << 20 | ids[b]: i << 20 | ids[a + b] for i, (a, b) in reversed(list(enumerate(pairs)))}
        self.single = [self.ids[bytes([b])] for b in range(256)]
        self.tokens = {i: t for t, i in self.ids.items()}
        self.special = {t["content"]: t["id"] for t in held.get("added_tokens", [])}
        if any(t.get("single_word") or t.get("lstrip") or t.get("rstrip") for t in held.get("added_tokens", [])):
            raise ValueError("added tokens that take in their surroundings aren't supported")
        self.tokens |= {i: t.encode() for t, i in self.special.items()}
        self.bridged = {(t[i], t[i + 1]) for t in self.ids for i in range(len(t) - 1)}
        self.piece = regex.compile(PATTERN)
        ordered = sorted(self.special, key=len, reverse=True)
        self.mark = regex.compile("(" + "|".join(map(regex.escape, ordered)) + ")") if ordered else None
        self.fragments = Fragments(self)
        self.pieces = Pieces(self)
        self.spaced = Spaced(self)
        self.spelled = np.array([self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)], object)

    def cuts(self, data: bytes) -> list[bytes]:
        """The fragments between forced boundaries."""
        bridged = self.bridged
        at = [i for i, pair in enumerate(zip(data, data[1:], strict=False), 1) if pair not in bridged]
        return [data[a:b] for a, b in zip([0, *at], [*at, len(data)], strict=True)] if at else [data]

    def fragments_of(self, data: bytes) -> bytes:
        """Ids of a piece: of its fragments one after another."""
        parts = self.cuts(data)
        return self.fragments[data] if len(parts) == 1 else b"".join(map(self.fragments.__getitem__, parts))

    def merge(self, data: bytes) -> list[int]:
        """Merges of lowest rank first, leftmost among equals, until none applies."""
        if len(data) > LONG:
            return self._merge_long(data)
        parts = [self.single[b] for b in data]
        known = self.joined.get
        ranked = [known(a << 20 | b, NONE) for a, b in zip(parts, parts[1:], strict=False)]
        while ranked and (best := min(ranked)) != NONE:
            i = ranked.index(best)
            parts[i : i + 2] = [best & MASK]
            del ranked[i]
            if i < len(ranked):
                ranked[i] = known(parts[i] << 20 | parts[i + 1], NONE)
            if i:
                ranked[i - 1] = known(parts[i - 1] << 20 | parts[i], NONE)
        return parts

    def _merge_long(self, data: bytes) -> list[int]:
        """The same with a heap over a linked list, for fragments of any length."""
        parts, n = [self.single[b] for b in data], len(data)
        left, right = list(range(-1, n - 1)), list(range(1, n + 1))
        known, heap = self.joined.get, []
        for i in range(n - 1):
            if (value := known(parts[i] << 20 | parts[i + 1], NONE)) != NONE:
                heap.append((value >> 20, i, value, parts[i], parts[i + 1]))
        heapq.heapify(heap)
        while heap:
            _, i, value, a, b = heapq.heappop(heap)
            j = right[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = value & MASK, -1
            right[i] = k = right[j]
            if k < n:
                left[k] = i
                if (value := known(parts[i] << 20 | parts[k], NONE)) != NONE:
                    heapq.heappush(heap, (value >> 20, i, value, parts[i], parts[k]))
            if (h := left[i]) >= 0 and (value := known(parts[h] << 20 | parts[i], NONE)) != NONE:
                heapq.heappush(heap, (value >> 20, h, value, parts[h], parts[i]))
        return [p for p in parts if p >= 0]

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if self.mark is None or not any(s in text for s in self.special):
            return self.plain(text)
        return b"".join(self.special[part].to_bytes(4, "little") if part in self.special else self.plain(part) for part in self.mark.split(text))

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens. A single space is a certain cut: the pattern joins it to what follows,
        and never looks back. Where a space is beside other white space, the pattern goes over the whole text."""
        first, *rest = text.split(" ")
        found = list(map(self.spaced.__getitem__, rest))
        if None in found:
            return b"".join(map(self.pieces.__getitem__, self.piece.findall(text)))
        return b"".join(map(self.pieces.__getitem__, self.piece.findall(first))) + b"".join(found)

    def decode(self, ids: bytes) -> bytes:
        return b"".join(self.spelled[np.frombuffer(ids, "<u4")].tolist())


class _Bounded(dict):
    """Kept ids in two generations: when the younger is full it becomes the older one, so that frequent keys stay."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.older = vocabulary, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None and (value := self.made(key)) is None:
            return None
        if len(key) <= 64:
            if 2 * len(self) >= self.vocabulary.cache:
                self.older = dict(self)
                self.clear()
            self[key] = value
        return value


class Fragments(_Bounded):
    def made(self, fragment: bytes) -> bytes:
        return _packed(self.vocabulary.merge(fragment))


class Pieces(_Bounded):
    def made(self, piece: str) -> bytes:
        return self.vocabulary.fragments_of(piece.encode())


class Spaced(_Bounded):
    """What follows a space, up to the next -> ids, with the space; None where the space's cut isn't certain. A word of
    letters, and marks behind it, are pieces of the pattern as they are."""

    def made(self, word: str) -> bytes | None:
        if not word or word[0].isspace():
            return None
        v = self.vocabulary
        bare = word.rstrip(MARKS)
        if bare and bare.isalpha() and max(bare) < SETTLED:
            ids = v.fragments_of(f" {bare}".encode())
            return ids + v.pieces[word[len(bare) :]] if len(bare) < len(word) else ids
        return b"".join(map(v.pieces.__getitem__, v.piece.findall(f" {word}")))


def _packed(ids: list[int]) -> bytes:
    """Little-endian unsigned 32-bit integers."""
    held = array("I", ids)
    if sys.byteorder != "little":
        held.byteswap()
    return held.tobytes()


_READY: dict[str, Vocabulary] = {}


def ready(data: bytes, cache: int) -> Vocabulary:
    """One a Python worker."""
    key = f"{cache} {hashlib.sha256(data).hexdigest()}"
    if key not in _READY:
        _READY.clear()
        _READY[key] = Vocabulary(data, cache)
    return _READY[key]


def encode_decode(docs: DataFrame, vocabulary_path: str, text_col: str = "text", outputs: tuple[str, ...] = NEW, cache: int = CACHE) -> DataFrame:
    """docs with those of n_tokens, ids, ids_sha256, decoded_text and decoded_sha256 that are asked for.

    cache: how many fragments, pieces and words each Python worker keeps the ids of, which bounds its memory.
    The vocabulary file is read on the driver and broadcast: its size is that of the file, whatever the corpus.
    """
    with open(vocabulary_path, "rb") as f:
        held = docs.sparkSession.sparkContext.broadcast(f.read())
    kinds = {"n_tokens": T.LongType(), "ids": T.ArrayType(T.IntegerType()), "ids_sha256": T.StringType(), "decoded_text": T.StringType(), "decoded_sha256": T.StringType()}
    wants_text = bool({"decoded_text", "decoded_sha256"} & set(outputs))
    at = f"c{docs.columns.index(text_col)}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[pa.Array]]]:
        claim("bpe", _READY.clear)
        v = ready(held.value, cache)
        for batch in batches:
            out = {n: [] for n in outputs}
            for text in batch.column(at):
                ids = v.encode(text.as_py() or "")
                decoded = v.decode(ids) if wants_text else b""
                if wants_text:
                    try:
                        decoded.decode()
                    except UnicodeDecodeError:
                        decoded = decoded.decode(errors="replace").encode()
                for n in outputs:
                    if n == "n_tokens":
                        out[n].append(len(ids) // 4)
                    elif n == "ids":
                        out[n].append(np.frombuffer(ids, "<i4"))
                    elif n == "ids_sha256":
                        out[n].append(hashlib.sha256(ids).hexdigest())
                    elif n == "decoded_text":
                        out[n].append(decoded.decode())
                    else:
                        out[n].append(hashlib.sha256(decoded).hexdigest())
            made = {"n_tokens": pa.int64(), "ids": pa.list_(pa.int32())}
            yield batch, [pa.array(out[n], made.get(n, pa.string())) for n in outputs]
        release()

    return extended(docs, run, [T.StructField(n, kinds[n]) for n in outputs])
