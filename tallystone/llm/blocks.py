"""Rows in compressed blocks by chunk, and exchanges of packed 64-bit hashes between chunks.

A chunk is a range of ids that holds some megabytes of text. Rows travel as zstd-compressed Arrow blocks, and the
hashes of a chunk travel sorted and delta-coded, so that a shuffle of one hash per word costs about six bytes a word.
Each hash is sent once a chunk, so a passage that a third of all documents share is sent once a chunk and no more.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystone.llm.common import claim, quoted, release, small_batches

LAST = np.iinfo(np.int64).max
#: Rows are dealt to chunks when so many bytes are there.
PACK_BYTES = 12 << 20
BLOCKS = "chunk int, block binary"
HASHES = "part int, chunk int, hashes binary, checks binary"
#: Bytes of a check, a second hash of what a hash stands for.
CHECK = 3


class Chunks:
    """Deals ids to chunks in the order of the ids: floor(n * an estimate of the share of bytes up to an id).

    Null ids come after all others, dealt in turn to `nulls` chunks of their own, numbered from n.
    """

    def __init__(self, n: int, knots: np.ndarray, upto: np.ndarray, nulls: int):
        self.n, self.knots, self.upto, self.nulls = n, knots, upto, nulls

    @property
    def parts(self) -> int:
        """Ranges of the hash space: each holds the hashes of a few chunks, so that there are fewer, larger packets."""
        return max(12, -(-(self.n + self.nulls) // 2))

    def of(self, ids: np.ndarray) -> np.ndarray:
        i = place(self.knots, ids)
        low, high = self.knots[i].astype(np.float64), self.knots[np.minimum(i + 1, len(self.knots) - 1)].astype(np.float64)
        inside = np.clip((ids - low) / np.maximum(high - low, 1.0), 0.0, 1.0)
        share = (self.upto[i] + inside * (self.upto[np.minimum(i + 1, len(self.upto) - 1)] - self.upto[i])) / max(self.upto[-1], 1.0)
        dealt = np.minimum((share * self.n).astype(np.int32), self.n - 1)
        null = np.flatnonzero(ids == LAST)
        dealt[null] = self.n + np.arange(len(null)) % max(self.nulls, 1)
        return dealt


def place(knots: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The interval of each id: knots[i] <= id < knots[i + 1], ids beyond the ends in the first or last."""
    return np.clip(np.searchsorted(knots, ids, "right") - 1, 0, max(len(knots) - 2, 0))


def id_of(docs: DataFrame, id_col: str) -> Column:
    return docs[quoted(id_col)].cast("long")


def plan(docs: DataFrame, id_col: str, text_col: str, chunk_bytes: int, knots: int = 512, rounds: int = 4) -> Chunks:
    """Chunks of nearly equal bytes. One pass gives the bytes and quantiles of the ids, another the bytes between
    quantiles, so that long texts side by side make short ranges; intervals that hold more than a chunk are cut further."""
    size = F.octet_length(docs[quoted(text_col)].cast("binary")) + 64
    slim = docs.select(id_of(docs, id_col).alias("i"), F.coalesce(size, F.lit(64)).cast("long").alias("w"))
    known = slim.where(F.col("i").isNotNull())
    at = F.percentile_approx("i", [i / knots for i in range(knots + 1)], 20 * knots)
    got = slim.agg(F.coalesce(F.sum(F.when(F.col("i").isNotNull(), F.col("w"))), F.lit(0)).alias("size"), F.coalesce(F.sum(F.when(F.col("i").isNull(), F.col("w"))), F.lit(0)).alias("null"), at.alias("at")).first()
    n, nulls = max(1, -(-got["size"] // chunk_bytes)), -(-got["null"] // chunk_bytes)
    if n == 1:
        return Chunks(1, np.zeros(1, np.int64), np.zeros(2), nulls)
    ends = np.array(sorted(set(got["at"])), np.int64)
    own = _bytes_between(known, ends)
    for _ in range(rounds):
        heavy = np.flatnonzero((own > chunk_bytes) & (np.diff(ends) > 1)) if len(ends) > 1 else []
        if not len(heavy):
            break
        ends = np.union1d(ends, _cuts(known, ends, heavy))
        own = _bytes_between(known, ends)
    return Chunks(n, ends, np.concatenate(([0.0], np.cumsum(own, dtype=np.float64))), nulls)


def _bytes_between(known: DataFrame, ends: np.ndarray) -> np.ndarray:
    """The bytes of each interval between neighbouring ends."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(max(len(ends) - 1, 1))
        for batch in batches:
            total += np.bincount(place(ends, batch.column("i").to_numpy()), batch.column("w").to_numpy().astype(float), len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some].astype(np.int64))], names=["at", "w"])

    own = np.zeros(max(len(ends) - 1, 1))
    for r in known.mapInArrow(run, "at int, w long").groupBy("at").agg(F.sum("w").alias("w")).collect():  # a row an interval
        own[r["at"]] = r["w"]
    return own


def _cuts(known: DataFrame, ends: np.ndarray, heavy: np.ndarray, parts: int = 64) -> np.ndarray:
    """Quantiles of the ids inside heavy intervals."""
    wanted = np.zeros(max(len(ends) - 1, 1), bool)
    wanted[heavy] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("i").to_numpy()
            at = place(ends, ids)
            keep = wanted[at]
            yield pa.RecordBatch.from_arrays([pa.array(at[keep].astype(np.int32)), pa.array(ids[keep])], names=["at", "i"])

    found = known.mapInArrow(run, "at int, i long").groupBy("at").agg(F.percentile_approx("i", [i / parts for i in range(1, parts)], 20 * parts).alias("cuts")).collect()
    return np.array(sorted({c for r in found for c in r["cuts"]}), np.int64)


def ids_of(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Null ids come after all others."""
    return np.asarray(pc.fill_null(column.cast(pa.int64()), LAST), np.int64)


def blocks(docs: DataFrame, id_col: str, chunks: Chunks) -> DataFrame:
    """(chunk, block) rows that hold all columns of docs."""

    def pack(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows_ = pa.Table.from_batches(held).combine_chunks()
        dealt = chunks.of(ids_of(rows_.column(id_col)))
        order = np.argsort(dealt, kind="stable")
        names, made = [], []
        for rows in np.split(order, np.flatnonzero(np.diff(dealt[order])) + 1):
            out = pa.BufferOutputStream()
            with pa.ipc.new_stream(out, rows_.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
                to.write_table(rows_.take(pa.array(rows)))
            names.append(int(dealt[rows[0]]))
            made.append(out.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(made, pa.binary())], names=["chunk", "block"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                size += batch.nbytes
            if size >= PACK_BYTES:
                yield pack(held)
                held, size = [], 0
                release()
        if held:
            yield pack(held)
        held = []
        release()

    small_batches(docs.sparkSession)
    return docs.mapInArrow(run, BLOCKS)


def opened(table: pa.Table) -> pa.Table | None:
    """The rows of a chunk from its blocks."""
    parts = [pa.ipc.open_stream(b.as_buffer()).read_all() for b in table.column("block")]
    return pa.concat_tables(parts).combine_chunks() if parts else None


def texts_of(column: pa.ChunkedArray) -> list[bytes | None]:
    return column.cast(pa.binary()).to_pylist()


def packed(hashes: np.ndarray, low: int = 0) -> bytes:
    """Sorted uint64 values as a first value and deltas of as few bytes as the largest needs; their `low` last bits are 0."""
    steps = np.diff(hashes) >> np.uint64(low)
    width = max(1, (int(steps.max()).bit_length() + 7) // 8) if len(steps) else 1
    return struct.pack("<BQ", width, int(hashes[0])) + steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpacked(data: bytes, low: int = 0) -> np.ndarray:
    width, first = struct.unpack_from("<BQ", data)
    steps = np.frombuffer(data, np.uint8, offset=9).reshape(-1, width)
    full = np.zeros((len(steps) + 1, 8), np.uint8)
    full[1:, :width] = steps
    values = full.reshape(-1).view("<u8").astype(np.uint64) << np.uint64(low)
    values[0] = first
    return np.cumsum(values, dtype=np.uint64)


def packed_checks(checks: np.ndarray) -> bytes:
    return checks.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :CHECK].tobytes()


def unpacked_checks(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // CHECK, 4), np.uint8)
    wide[:, :CHECK] = np.frombuffer(data, np.uint8).reshape(-1, CHECK)
    return wide.reshape(-1).view("<u4").astype(np.uint32)


def by_part(hashes: np.ndarray, chunk: int, parts: int, low: int = 0, checks: np.ndarray | None = None) -> pa.Table:
    """The sorted hashes of a chunk, cut into equal ranges of the hash space. Work and rows grow with the hashes, not with
    the number of parts: empty ranges cost nothing."""
    part = ((hashes >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    ends = np.flatnonzero(np.diff(part, append=parts)) + 1
    rows = [(int(part[a]), chunk, packed(hashes[a:b], low), None if checks is None else packed_checks(checks[a:b])) for a, b in zip([0, *ends[:-1].tolist()], ends.tolist(), strict=False)]
    kinds = (("part", pa.int32()), ("chunk", pa.int32()), ("hashes", pa.binary()), ("checks", pa.binary()))
    return pa.table({name: pa.array([r[i] for r in rows], kind) for i, (name, kind) in enumerate(kinds)})


def exchange(
    rows: DataFrame,
    parts: int,
    send: Callable[[pa.Table], np.ndarray | tuple[np.ndarray, np.ndarray]],
    answer: Callable[..., tuple[np.ndarray, np.ndarray, np.ndarray]],
    finish: Callable[[int, pa.Table, np.ndarray, np.ndarray], pa.Table],
    schema: str | T.StructType,
    low: int = 0,
    opened: Callable[[pa.Table], pa.Table | None] = opened,
) -> DataFrame:
    """Each chunk sends sorted hashes; who holds a range of the hash space answers; each chunk finishes with its answers.

    answer(hashes, chunks): for sorted hashes and the chunks they come from, the (chunk, hash, count) that go back. If send
    gives (hashes, checks), sorted together, what has one hash and another check is kept apart: answer(hashes, chunks, checks).
    finish(chunk, rows, hashes, counts): hashes sorted, their `low` last bits 0. opened: a chunk's rows from those of
    `rows` (by default blocks). Both sides of the last step read the same shuffle of the rows.
    """

    def first(key: tuple[pa.Scalar, ...], held: pa.Table) -> pa.Table:
        claim("blocks", lambda: None)
        sent = send(opened(held))
        hashes, checks = sent if isinstance(sent, tuple) else (sent, None)
        out = by_part(hashes, key[0].as_py(), parts, low, checks)
        release()
        return out

    def middle(key: tuple[pa.Scalar, ...], held: pa.Table) -> pa.Table:
        held = held.sort_by("chunk")
        got = [unpacked(x, low) for x in held.column("hashes").to_pylist()]
        chunk = np.repeat(held.column("chunk").to_numpy().astype(np.int32), [len(x) for x in got])
        hashes = np.concatenate(got)
        del got
        if held.column("checks").null_count:
            order = np.argsort(hashes, kind="stable")  # chunks stay in order
            to, back, count = answer(hashes[order], chunk[order])
        else:
            checks = np.concatenate([unpacked_checks(x) for x in held.column("checks").to_pylist()])
            order = np.lexsort((checks, hashes))
            to, back, count = answer(hashes[order], chunk[order], checks[order])
            del checks
        del hashes, chunk, order
        order = np.argsort(to, kind="stable")
        to, back, count = to[order], back[order], count[order]
        ends = np.flatnonzero(np.diff(to)) + 1
        rows = [(int(to[r[0]]), packed(back[r], low), count[r].astype("<u4").tobytes()) for r in np.split(np.arange(len(to)), ends) if len(r)]
        release()
        return pa.table({"chunk": pa.array([r[0] for r in rows], pa.int32()), "hashes": pa.array([r[1] for r in rows], pa.binary()), "counts": pa.array([r[2] for r in rows], pa.binary())})

    def last(key: tuple[pa.Scalar, ...], held: pa.Table, answers: pa.Table) -> pa.Table:
        claim("blocks", lambda: None)
        got = [(unpacked(h, low), np.frombuffer(c, "<u4")) for h, c in zip(answers.column("hashes").to_pylist(), answers.column("counts").to_pylist(), strict=True)]
        hashes = np.concatenate([x[0] for x in got]) if got else np.empty(0, np.uint64)
        counts = np.concatenate([x[1] for x in got]) if got else np.empty(0, np.uint32)
        order = np.argsort(hashes, kind="stable")
        out = finish(key[0].as_py(), opened(held), hashes[order], counts[order])
        release()
        return out

    sent = rows.groupBy("chunk").applyInArrow(first, HASHES)
    answers = sent.groupBy("part").applyInArrow(middle, "chunk int, hashes binary, counts binary")
    return rows.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(last, schema)
