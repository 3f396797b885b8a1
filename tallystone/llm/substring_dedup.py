"""Substring dedup: Rabin-Karp hashes of every window of 13 words, counted in Spark, merged into removal intervals.

Every word of every whole text starts a window (but the last twelve of a text). Each chunk of documents sends the
distinct hashes of its windows; who holds a hash answers the chunks after the first that has it. Chunks are ranges
of doc_id in order, so "in an earlier chunk" means "in a document with a smaller id"; inside a chunk the ids decide.
Windows so found cover words, and runs of covered words are the maximal removal intervals.

Windows are equal when a 64-bit hash and 24 bits of a second, independent one are: n windows hold about n^2 / 2^89 pairs
that differ and are taken for equal, less than one in 100 TB of text (1.5e13 windows).

Defined results: a null or empty text has no words; a text under 13 words loses none; rows with the same doc_id never
dedup each other, as neither id is smaller; a null doc_id counts as larger than all others; ids must be integers, or text
that reads as one (an error else); an empty table gives an empty result; other columns pass through, whatever their
names, and those with the names of new columns are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tallystone.llm import blocks
from tallystone.llm.common import quoted, unnamed
from tallystone.llm.words import hashed, OTHER, runs, windows

WINDOW = 13
CHUNK_BYTES = 4 << 20
NEW = ("n_words", "n_removed", "removed", "kept_text", "kept_sha256")


def _starts(table: pa.Table, id_col: str, text_col: str, width: int):
    """Where each text's words begin (and the end), place, hash, check and row of each window, ids; windows never cross rows."""
    ends, place, hashes, checks, row, words, rows = [np.zeros(1, np.int64)], [], [], [], [], 0, 0
    for texts in runs(blocks.texts_of(table.column(text_col))):
        held, own = hashed(texts)
        made = windows(held, width)
        of = np.repeat(np.arange(len(texts)), np.diff(own))[: len(made)]
        at = np.arange(len(made))
        inside = at + width <= own[1:][of]
        place.append(at[inside] + words)
        hashes.append(made[inside])
        checks.append((windows(held, width, OTHER)[inside] >> np.uint64(64 - 8 * blocks.CHECK)).astype(np.uint32))
        row.append(of[inside] + rows)
        ends.append(own[1:] + words)
        words, rows = words + len(held), rows + len(texts)
    return np.concatenate(ends), np.concatenate(place), np.concatenate(hashes), np.concatenate(checks), np.concatenate(row), blocks.ids_of(table.column(id_col))


def _new(hashes: np.ndarray, checks: np.ndarray) -> np.ndarray:
    """Where another window begins, of windows in order."""
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (checks[1:] != checks[:-1])
    return new


def _first_later(hashes: np.ndarray, chunk: np.ndarray, checks: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chunks after the first that has a window, with its check; chunks from n on hold null ids, which are all alike."""
    begin = np.flatnonzero(_new(hashes, checks))
    first = np.repeat(chunk[begin], np.diff(np.append(begin, len(hashes))))
    later = (chunk > first) & (first < n)
    return chunk[later], hashes[later], checks[later]


def _among(hashes: np.ndarray, checks: np.ndarray, seen: np.ndarray, seen_checks: np.ndarray) -> np.ndarray:
    """Which windows are among the seen ones (sorted by hash; several may have one hash)."""
    found = np.zeros(len(hashes), bool)
    place = np.searchsorted(seen, hashes)
    while True:
        place_ = np.minimum(place, max(len(seen) - 1, 0))
        same = (place < len(seen)) & (seen[place_] == hashes) if len(seen) else found
        if not same.any():
            return found
        found |= same & (seen_checks[place_] == checks)
        place = place + 1


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WINDOW, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """docs with n_words, n_removed, removed (maximal intervals of words, end excluded) and kept_text."""
    docs = docs.select(*(docs[quoted(c)] for c in docs.columns if c not in NEW))
    names, (docs, named) = docs.columns, unnamed(docs)
    id_col, text_col = named[id_col], named[text_col]
    chunks = blocks.plan(docs, id_col, text_col, chunk_bytes)
    span = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("end", T.LongType())]))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("removed", span), T.StructField("kept_text", T.StringType()), T.StructField("kept_sha256", T.StringType())])

    def send(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        _, _, hashes, checks, _, _ = _starts(table, id_col, text_col, width)
        order = np.lexsort((checks, hashes))
        hashes, checks = hashes[order], checks[order]
        new = _new(hashes, checks)
        return hashes[new], checks[new]

    def finish(chunk: int, table: pa.Table | None, seen: np.ndarray, seen_checks: np.ndarray) -> pa.Table:
        ends, at, hashes, checks, row, ids = _starts(table, id_col, text_col, width)
        again = _among(hashes, checks, seen, seen_checks)
        order = np.lexsort((ids[row], checks, hashes))
        sorted_id = ids[row][order]
        first = _new(hashes[order], checks[order])
        least = sorted_id[np.flatnonzero(first)][np.cumsum(first) - 1] if len(order) else sorted_id
        again[order] |= sorted_id > least
        edge = np.zeros(ends[-1] + 1, np.int64)
        np.add.at(edge, at[again], 1)
        np.add.at(edge, at[again] + width, -1)
        cover = np.cumsum(edge)[:-1] > 0
        out = {"n_words": [], "n_removed": [], "removed": [], "kept_text": [], "kept_sha256": []}
        for a, b, text in zip(ends[:-1].tolist(), ends[1:].tolist(), blocks.texts_of(table.column(text_col)), strict=True):
            mask, own, spans = cover[a:b], (text or b"").split(), []
            if gone := int(mask.sum()):
                turns = np.flatnonzero(np.diff(np.concatenate(([0], mask.view(np.int8), [0]))))
                spans = [{"first": int(x), "end": int(y)} for x, y in turns.reshape(-1, 2)]
                own = [own[i] for i in np.flatnonzero(~mask).tolist()]
            kept = b" ".join(own)
            for name, value in zip(out, (b - a, gone, spans, kept, hashlib.sha256(kept).hexdigest()), strict=True):
                out[name].append(value)
        kinds = [pa.int64(), pa.int64(), pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())])), pa.binary(), pa.string()]
        for (name, values), kind in zip(out.items(), kinds, strict=True):
            column = pa.array(values, kind)
            table = table.append_column(name, column.cast(pa.string()) if name == "kept_text" else column)
        return table

    rows = blocks.blocks(docs, id_col, chunks)
    return blocks.exchange(rows, chunks.parts, send, lambda h, c, k: _first_later(h, c, k, chunks.n), finish, schema).toDF(*names, *NEW)
