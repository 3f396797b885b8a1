"""N-gram Jaccard join by PartEnum signatures: exact links between shingle sets, and their components.

Sets r and s with Jaccard at least 3/4 differ in at most (|r| + |s|) / 7 shingles. Sizes are cut into bands that are
powers of two; a set whose partners may lie above its band signs for the next band too, so that each pair meets in a band.
A band cuts the shingle domain, by a hash, into groups of three partitions, and a signature is the hash of what a set
holds in two of a group's three partitions: all subsets of two are enumerated. A shingle in which two sets differ spoils
two of the three signatures of its group, a second one in the group the third. So k differences spoil at most
min(2k, k + groups) signatures, and the number of groups (0.65 times the band's largest k, and 3) leaves some over.

Signatures are counted over all documents (packed, one shuffle). Of its f signatures a set shares at least f - spoiled
with each partner, so two partners share one of the spoiled + 1 rarest of both; others are not looked at, nor are those
that no other set has. Most documents then have none left and drop out: what they share with others is too little. A set
with f <= spoiled (a small one, whose shingles fall together) looks at all its signatures and signs each shingle alone
beside. Candidates are the documents that meet in a signature that both look at; nothing else makes pairs.

Candidates with equal sets are linked at once, one for all. Then each candidate is compared with one other (a star: the
smallest it meets), which joins large groups of near copies with a pair a document; then again across components, and at
last all that meet and are still in different components: pair by pair in signatures of up to 100 documents, and above
that block by block, with matrix products, so that no pair is a row. Comparisons are exact on the sets (48 bits of each
shingle's hash). Before a pair's sets travel, their sketches do, a twelfth of the size at most: the parities of the
shingles in each of 2^k cells. A shingle in one set alone changes one parity, so sets differ in as many shingles as
parities at least, and a pair that differs in too many is no link; all others are compared. Joins on a signature or a set send the heaviest keys to all tasks (`lookup`), so that one which a third
of all documents share stays where its rows are.

Defined results: a null or empty text has an empty set and links with nothing; rows that share a doc_id are one
document, whose links are pooled; a null doc_id links with nothing and its component_id is null; ids must be integers,
or text that reads as one (an error else); an empty table gives an empty result; other columns don't take part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.llm import blocks
from tallystone.llm.common import discard, lookup, materialize, mix64, quoted, temporary, unnamed
from tallystone.llm.words import BASE, hashed, runs, windows

WIDTH, SHARE = 5, (3, 4)
CHUNK_BYTES = 4 << 20
#: Groups of three partitions for each 20 differences of a band, and beside.
GROUPS_OF_20, GROUPS_MORE = 13, 3
#: Bits of a signature beyond those that number the bytes of the corpus.
SPARE_BITS = 11
#: Keys that more documents share are compared blockwise; documents of a block; columns of a matrix.
HOT, BLOCK, COLUMNS = 100, 512, 8192
#: So many ids are sent to all tasks, more are joined by a shuffle.
FEW = 2_000_000
NODES = "chunk int, doc_id long, n_shingles long, twin long, repeated boolean, mark binary, keys array<struct<key:long,far:int>>, sketch binary, hashes binary"


def shingle_sets(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct shingle hashes of each text, one text after another, and the ends of the texts' sets (from 0).
    Texts are lower-cased (A-Z); a text with fewer words is one shingle."""
    flat, sizes = [], []
    for run in runs(texts):
        single, ends = hashed(run, lower=True)
        every, parts = windows(single, width), []
        for a, b in zip(ends[:-1].tolist(), ends[1:].tolist(), strict=True):
            if b - a >= width:
                part = every[a : b - width + 1]
                part.sort()
            else:
                part = windows(single[a:b], b - a) if b > a else every[:0]
            parts.append(part)
        own = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        made = np.concatenate(parts) if parts else every[:0]
        new = np.ones(len(made), bool)
        new[1:] = (made[1:] != made[:-1]) | (own[1:] != own[:-1])
        flat.append(made[new])
        sizes.append(np.bincount(own[new], minlength=len(parts)))
    return np.concatenate(flat), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int64)


def _band(size: np.ndarray) -> np.ndarray:
    """The power of two at or above each size."""
    return np.frexp((size - 1).astype(np.float64))[1].astype(np.int64)


def _most(total: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The largest difference of two sets with `total` elements together that are similar enough."""
    return total * (share[1] - share[0]) // (share[1] + share[0])


def signatures(flat: np.ndarray, ends: np.ndarray, rows: np.ndarray, share: tuple[int, int] = SHARE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, int]]:
    """(row of each signature, signatures, for each row how many of the rarest are to be looked at, how many of them one
    difference spoils at most), for the rows' own bands, the next ones, and single shingles of sets that need them."""
    (p, q), every = share, np.diff(ends)
    rows = rows[every[rows] > 0]
    top = np.left_shift(1, _band(every[rows]))
    for step in (0, 1):
        signing = rows if not step else rows[every[rows] * q // p > top]
        if not len(signing):
            continue
        size = every[signing]
        band = _band(size) + step
        most = _most(size + np.minimum(1 << band, size * q // p), share)
        groups = _most(2 << band, share) * GROUPS_OF_20 // 20 + GROUPS_MORE
        parts = 3 * groups
        base = np.cumsum(parts) - parts
        own = np.repeat(np.arange(len(signing)), size)
        held = flat[np.arange(len(own)) + np.repeat(ends[signing] - (np.cumsum(size) - size), size)]
        tag = band.astype(np.uint64)
        with np.errstate(over="ignore"):
            place = ((mix64(held + (tag * np.uint64(4) + np.uint64(1))[own] * BASE) >> np.uint64(32)) * parts.astype(np.uint64)[own]) >> np.uint64(32)
            slot = base[own] + place.astype(np.int64)
            value, total = mix64(held), int(parts.sum())
            low = np.bincount(slot, (value & np.uint64(0xFFFFFFFF)).astype(np.float64), total).astype(np.uint64)
            held_in = (low + (np.bincount(slot, (value >> np.uint64(32)).astype(np.float64), total).astype(np.uint64) << np.uint64(32))).reshape(-1, 3)
            filled = (np.bincount(slot, minlength=total) > 0).reshape(-1, 3)
            of = np.repeat(np.arange(len(signing)), groups)
            number = (np.arange(len(of)) - (base // 3)[of]).astype(np.uint64) * np.uint64(4) + (tag[of] << np.uint64(48))
            made, some = np.empty(held_in.shape, np.uint64), np.empty(held_in.shape, bool)
            for left_out in range(3):
                a, b = (left_out + 1) % 3, (left_out + 2) % 3
                made[:, left_out] = mix64(held_in[:, a] + mix64(held_in[:, b] + mix64(number + np.uint64(left_out))))
                some[:, left_out] = filled[:, a] | filled[:, b]
        row = np.repeat(of, 3)[some.reshape(-1)]
        count = np.bincount(row, minlength=len(signing))
        spoiled = np.minimum(2 * most, most + groups)
        look = np.zeros(len(every), np.int64)
        look[signing] = np.minimum(spoiled + 1, count)
        yield signing[row], made.reshape(-1)[some.reshape(-1)], look, 2
        weak = count <= spoiled
        if weak.any():
            alone = weak[own]
            look = np.zeros(len(every), np.int64)
            look[signing] = np.where(weak, most + 1, 0)
            with np.errstate(over="ignore"):
                yield signing[own[alone]], mix64(held[alone] + (tag * np.uint64(4) + np.uint64(3))[own[alone]] * BASE), look, 1


def _of_chunk(table: pa.Table, width: int):
    """Ids, sets and their ends, a mark of each set (equal sets have equal marks), the first row with the same set (rows
    in order of ids), and whether the row's id is there more than once."""
    ids = blocks.ids_of(table.column("doc_id"))
    flat, ends = shingle_sets(blocks.texts_of(table.column("text")), width)
    size = np.diff(ends)
    marks = np.zeros((len(ids), 3), np.uint64)
    some = np.flatnonzero(size)
    if len(some):
        with np.errstate(over="ignore"):
            marks[some, 0] = np.add.reduceat(mix64(flat + BASE), ends[some])
            marks[some, 1] = np.add.reduceat(mix64(flat ^ BASE), ends[some])
        marks[:, 2] = size
    twin, known, seen, repeated = np.arange(len(ids)), {}, {}, np.zeros(len(ids), bool)
    for i in np.argsort(ids, kind="stable").tolist():
        if size[i] and ids[i] != blocks.LAST:
            twin[i] = known.setdefault(marks[i].tobytes(), i)
        if (first := seen.setdefault(int(ids[i]), i)) != i:
            repeated[[first, i]] = True
    return ids, flat, ends, marks, twin, repeated


def _count(hashes: np.ndarray, chunk: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))
    count = np.diff(np.append(begin, len(hashes)))
    rows = np.repeat(count, count)
    keep = rows > 1
    hashes, chunk, rows = hashes[keep], chunk[keep], rows[keep]
    once = np.ones(len(hashes), bool)
    once[1:] = (hashes[1:] != hashes[:-1]) | (chunk[1:] != chunk[:-1])
    return chunk[once], hashes[once], rows[once].astype(np.uint32)


def looked_at(flat: np.ndarray, ends: np.ndarray, rows: np.ndarray, known: np.ndarray, counts: np.ndarray, share: tuple[int, int], cut: Callable = np.array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signature, least difference from any partner) of the signatures to look at that others have too, by rows.
    known: signatures of several documents, sorted, with their counts; cut: what is left of a signature there."""
    out = [(np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64))]
    for row, made, look, spoils in signatures(flat, ends, rows, share) if len(known) else ():
        made = cut(made)
        place = np.minimum(np.searchsorted(known, made), len(known) - 1)
        shared = known[place] == made
        alone = np.bincount(row[~shared], minlength=len(look))
        more = look - alone
        chosen = np.flatnonzero(shared & (more[row] > 0))
        at, key, count = row[chosen], made[chosen], counts[place[chosen]]
        order = np.lexsort((key, count, at))
        at, key = at[order], key[order]
        first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1]))) if len(at) else at
        rank = np.arange(len(at)) - np.repeat(first, np.diff(np.append(first, len(at))))
        keep = rank < more[at]
        out.append((at[keep], key[keep], -(-alone // spoils)[at[keep]]))
    at, key, far = (np.concatenate(x) for x in zip(*out, strict=True))
    order = np.argsort(at, kind="stable")
    return at[order], key[order], far[order]


def parities(hashes: np.ndarray) -> bytes:
    """The parities of the hashes' numbers in as many cells as the power of two from twice as many on, at least 64."""
    cells = max(64, 2 << int(_band(np.array([len(hashes)]))[0]))
    place = (hashes >> np.uint64(16) & np.uint64(cells - 1)).astype(np.int64)
    return np.packbits(np.bincount(place, minlength=cells).astype(np.uint8) & 1, bitorder="little").tobytes()


def differ(x: bytes, y: bytes) -> int:
    """A number of hashes in which two sets differ at least, from their parities; the longer are folded to the shorter."""
    one, two = (np.frombuffer(v, np.uint64) for v in (x, y))
    size = min(len(one), len(two))
    one, two = (np.bitwise_xor.reduce(v.reshape(-1, size), axis=0) for v in (one, two))
    return int(np.bitwise_count(one ^ two).sum())


def nodes(docs: DataFrame, id_col: str, text_col: str, width: int, share: tuple[int, int], chunk_bytes: int) -> tuple[DataFrame, int]:
    """A row for each document: its set's size, the smallest document of its chunk with the same set, and, where it
    may link with others, the signatures to look at, the set and its mark; and the number of ranges of signatures."""
    slim = docs.select(blocks.id_of(docs, id_col).alias("doc_id"), docs[quoted(text_col)].alias("text"))
    chunks = blocks.plan(slim, "doc_id", "text", chunk_bytes)

    # fewer bits only let some signatures look like others', which can add candidates and never loses a link
    low = np.uint64(64 - min(64, max(40, (chunks.n * chunk_bytes).bit_length() + SPARE_BITS)))

    def cut(made: np.ndarray) -> np.ndarray:
        return made >> low << low

    def signing(ids: np.ndarray, twin: np.ndarray) -> np.ndarray:
        return np.flatnonzero((twin == np.arange(len(ids))) & (ids != blocks.LAST))

    def send(table: pa.Table) -> np.ndarray:
        ids, flat, ends, _, twin, _ = _of_chunk(table, width)
        made = [s for _, s, _, _ in signatures(flat, ends, signing(ids, twin), share)]
        out = cut(np.concatenate(made)) if made else np.empty(0, np.uint64)
        out.sort()
        return out

    def finish(chunk: int, table: pa.Table, known: np.ndarray, counts: np.ndarray) -> pa.Table:
        ids, flat, ends, marks, twin, repeated = _of_chunk(table, width)
        at, key, far = looked_at(flat, ends, signing(ids, twin), known, counts, share, cut)
        many = np.bincount(at, minlength=len(ids))
        held, mark, sketch = [None] * len(ids), [None] * len(ids), [None] * len(ids)
        for i in np.flatnonzero(many).tolist():
            sketch[i] = parities(flat[ends[i] : ends[i + 1]])
            held[i] = flat[ends[i] : ends[i + 1]].astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()
            mark[i] = marks[i].tobytes()
        pairs = pa.StructArray.from_arrays([pa.array(key.view(np.int64)), pa.array(far.astype(np.int32))], ["key", "far"])
        null = ids == blocks.LAST
        return pa.table({
            "chunk": pa.array(np.full(len(ids), chunk), pa.int32()),
            "doc_id": pa.array(ids, pa.int64(), mask=null),
            "n_shingles": pa.array(np.diff(ends)),
            "twin": pa.array(ids[twin], pa.int64(), mask=null),
            "repeated": pa.array(repeated & ~null),
            "mark": pa.array(mark, pa.binary()),
            "keys": pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(many))), pa.int32()), pairs),
            "sketch": pa.array(sketch, pa.binary()),
            "hashes": pa.array(held, pa.binary()),
        })

    return blocks.exchange(blocks.blocks(slim, "doc_id", chunks), chunks.parts, send, _count, finish, NODES, int(low)), chunks.parts


def met(at: DataFrame, parts: int) -> DataFrame:
    """at (chunk, doc_id, n, keys) with only those keys that another document looks at too: most keys that a document
    looks at are shared with documents that look at others."""

    def keys_of(table: pa.Table) -> np.ndarray:
        return table.column("keys").combine_chunks().flatten().field("key").to_numpy().view(np.uint64)

    def finish(chunk: int, table: pa.Table, known: np.ndarray, counts: np.ndarray) -> pa.Table:
        own = keys_of(table)
        table = table.combine_chunks()
        column = table.column("keys").combine_chunks()
        many = np.asarray(column.value_lengths())
        keep = known[np.minimum(np.searchsorted(known, own), len(known) - 1)] == own if len(known) else np.zeros(len(own), bool)
        left = np.bincount(np.repeat(np.arange(len(many)), many)[keep], minlength=len(many))
        keys = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(left))), pa.int32()), column.flatten().filter(pa.array(keep)))
        return table.set_column(table.schema.get_field_index("keys"), "keys", keys)

    found = blocks.exchange(at, parts, lambda table: np.sort(keys_of(table)), _count, finish, at.schema, opened=lambda table: table)
    return found.where(F.size("keys") > 0)


def _full(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) // 6, 8), np.uint8)
    wide[:, 2:] = np.frombuffer(data, np.uint8).reshape(-1, 6)  # the high bytes, which deal hashes to parts
    return wide.reshape(-1).view("<u8").astype(np.uint64)


def _beside(pairs: DataFrame, facts: DataFrame) -> DataFrame:
    """(a, b, x, y): pairs with the fact of each. A document in many pairs is met by 64 copies of its fact."""
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("b"), F.lit(64)).cast("int"))
    left = salted.select("a", "salt").distinct().join(facts.toDF("a", "x").hint("shuffle_merge"), "a")
    both = salted.join(left.hint("shuffle_merge"), ["a", "salt"]).select("a", "b", "x").join(facts.toDF("b", "y").hint("shuffle_merge"), "b")
    return both.select("a", "b", "x", "y")


def _similar(pairs: DataFrame, meets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Of pairs (a, b) those whose sets are similar enough: first by the sketches, which rule out most others."""
    p, q = share

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            (m, x), (n, y) = (batch.column(c).flatten() for c in "xy")
            most = _most(m.to_numpy() + n.to_numpy(), share).tolist()
            keep = [differ(v, w) <= k for v, w, k in zip(x.to_pylist(), y.to_pylist(), most, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last = [], (None, None)
            for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
                x, y = x.as_py(), y.as_py()
                if last[0] != x:
                    last = (x, _full(x))
                other = _full(y)
                merged = np.concatenate((last[1], other))
                merged.sort()
                inside = int((merged[1:] == merged[:-1]).sum())
                keep.append(q * inside >= p * (len(merged) - inside))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = materialize(_beside(pairs, meets.select("doc_id", F.struct("n_shingles", "sketch"))).mapInArrow(likely, "a long, b long"))
    found = materialize(_beside(left, meets.select("doc_id", "hashes")).mapInArrow(run, "a long, b long"))
    discard(left)
    return found


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of the edges reaches. Labels move along links and then jump to
    their label's label, so rounds grow with the logarithm of a path; each round is written to the shared folder."""
    two = materialize(edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v"))))
    held = materialize(two.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("root")).withColumnRenamed("u", "node"))
    while True:
        labels = held.select("node", "root")
        seen = two.join(labels.hint("shuffle_merge"), two.v == labels.node).groupBy("u").agg(F.min("root").alias("near"))
        moved = labels.join(seen, labels.node == seen.u).select("node", "root", F.least("root", "near").alias("next"))
        target = labels.select(F.col("node").alias("next"), F.col("root").alias("beyond"))
        jumped = materialize(moved.join(target, "next", "left").select("node", F.least("next", F.coalesce("beyond", "next")).alias("root"), (F.col("next") < F.col("root")).alias("changed")))
        discard(held)
        held = jumped
        if not jumped.where("changed").limit(1).count():
            discard(two)
            return jumped.select("node", "root")


def _meeting(at: DataFrame, roots: DataFrame | None) -> DataFrame:
    """(key, doc_id, n, far, root, docs, first) for the keys whose documents are in different components so far: docs are
    the documents of the key, first its smallest (of the smallest component). at: doc_id, n, key, far."""
    if roots is None:
        placed = at.withColumn("root", F.col("doc_id"))
    else:
        placed = at.join(roots.withColumnRenamed("node", "doc_id").hint("shuffle_merge"), "doc_id", "left").withColumn("root", F.coalesce("root", "doc_id"))
    placed = materialize(placed.select("doc_id", "n", "root", "key", "far"))
    by_key = placed.groupBy("key").agg(F.count("*").alias("docs"), F.max("root").alias("high"), F.min(F.struct("root", "doc_id", "n", "far")).alias("first"))
    open_ = materialize(by_key.where(F.col("first.root") < F.col("high")).drop("high"))
    found = materialize(lookup(placed, open_, "key", "docs"))
    discard(placed, open_)
    return found


def _may_link(na, nb, fa, fb, share: tuple[int, int]):
    """Whether two sets can be similar by their sizes and by the signatures that they share with none."""
    p, q = share
    return (F.greatest(na, nb) * p <= F.least(na, nb) * q) & (F.greatest(fa, fb) * (q + p) <= (na + nb) * (q - p))


def _stars(meeting: DataFrame, share: tuple[int, int]) -> DataFrame:
    """For each document one pair: of the documents of other components that lead one of its keys (the smallest there),
    with the one that leads most of them."""
    fits = (F.col("root") != F.col("first.root")) & _may_link(F.col("n"), F.col("first.n"), F.col("far"), F.col("first.far"), share)
    often = meeting.where(fits).groupBy(F.col("doc_id").alias("d"), F.col("first.doc_id").alias("e")).count()
    return often.groupBy("d").agg(F.max_by("e", F.struct("count", -F.col("e"))).alias("e")).select(F.least("d", "e").alias("a"), F.greatest("d", "e").alias("b")).distinct()


def _all_pairs(meeting: DataFrame, share: tuple[int, int]) -> DataFrame:
    """All pairs of documents of different components that meet in a key of a bounded number of documents."""
    one = meeting.select("key", *(F.col(c).alias(f"{c}_a") for c in ("doc_id", "root", "n", "far")))
    two = meeting.select("key", *(F.col(c).alias(f"{c}_b") for c in ("doc_id", "root", "n", "far")))
    fits = F.expr("doc_id_a < doc_id_b and root_a <> root_b") & _may_link(F.col("n_a"), F.col("n_b"), F.col("far_a"), F.col("far_b"), share)
    return one.join(two.hint("shuffle_merge"), "key").where(fits).select(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b")).distinct()


def _same(tables: pa.Table, here: np.ndarray, there: np.ndarray, share: tuple[int, int]) -> list[tuple[int, int]]:
    """Links between rows `here` and rows `there` of different roots, as many as join their components."""
    sets = [_full(x) for x in tables.column("hashes").to_pylist()]
    ids, roots = tables.column("doc_id").to_numpy(), tables.column("root").to_numpy()
    size = np.array([len(x) for x in sets])
    row = np.repeat(np.arange(len(sets)), size)
    value, place, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    order = np.argsort(place, kind="stable")
    order = order[count[place[order]] > 1]
    row, place = row[order], place[order]
    common = np.zeros((len(here), len(there)), np.float32)
    at = {side: np.full(len(sets), -1) for side in "ht"}
    at["h"][here], at["t"][there] = np.arange(len(here)), np.arange(len(there))
    for low in range(0, len(value), COLUMNS):
        a, b = np.searchsorted(place, (low, low + COLUMNS))
        if a < b:
            one, two = np.zeros((len(here), COLUMNS), np.float32), np.zeros((len(there), COLUMNS), np.float32)
            for matrix, side in ((one, "h"), (two, "t")):
                own = at[side][row[a:b]]
                matrix[own[own >= 0], place[a:b][own >= 0] - low] = 1
            common += one @ two.T
    p, q = share
    common = common.astype(np.int64)
    total = size[here][:, None] + size[there][None, :]
    linked = (q * common >= p * (total - common)) & (roots[here][:, None] != roots[there][None, :])
    parent: dict[int, int] = {}

    def top(x: int) -> int:
        while (y := parent.get(x, x)) != x:
            x = y
        return x

    found = []
    for i, j in np.argwhere(linked).tolist():
        x, y = here[i], there[j]
        one, two = top(int(roots[x])), top(int(roots[y]))
        if one != two:
            parent[max(one, two)] = min(one, two)
            found.append((int(min(ids[x], ids[y])), int(max(ids[x], ids[y]))))
    return found


def _blockwise(meeting: DataFrame, sets: DataFrame, share: tuple[int, int]) -> DataFrame:
    """Links between components among documents that meet in keys of very many documents: documents that such keys
    connect make a group, the group is cut into blocks, and each two blocks are compared by matrix products."""
    edges = meeting.select(F.col("first.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct()
    group = components(edges).select(F.col("node").alias("doc_id"), F.col("root").alias("group"))
    members = materialize(meeting.select("doc_id", "root").distinct().join(group.hint("shuffle_merge"), "doc_id"))
    sizes = materialize(members.groupBy("group").agg(F.count("*").alias("docs")))
    placed = lookup(members, sizes, "group", "docs").withColumn("n", F.ceil(F.col("docs") / BLOCK).cast("int")).withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("n")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n") - 1))).select("group", "block", "doc_id", "root", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
    full = dealt.join(sets.hint("shuffle_merge"), "doc_id").select("group", "i", "j", "block", "doc_id", "root", "hashes")

    def compare(key: tuple[pa.Scalar, ...], held: pa.Table) -> pa.Table:
        block, i, j = held.column("block").to_numpy(), key[1].as_py(), key[2].as_py()
        found = _same(held, np.flatnonzero(block == i), np.flatnonzero(block == j), share)
        return pa.table({"a": pa.array([x for x, _ in found], pa.int64()), "b": pa.array([y for _, y in found], pa.int64())})

    return full.groupBy("group", "i", "j").applyInArrow(compare, "a long, b long")


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH, share: tuple[int, int] = SHARE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(chunk, doc_id, n_shingles, component_id) for each row of docs."""
    held, parts = nodes(docs, id_col, text_col, width, share, chunk_bytes)
    held = materialize(held)
    meets = held.where("mark is not null")
    equal = materialize(meets.groupBy("mark").agg(F.min("doc_id").alias("least"), F.count("*").alias("docs")))
    copies = materialize(lookup(meets.select("mark", "doc_id"), equal, "mark", "docs").where("least < doc_id").select(F.col("least").alias("a"), F.col("doc_id").alias("b")))
    ids_of_one = held.where("repeated and twin <> doc_id").select(F.col("twin").alias("a"), F.col("doc_id").alias("b"))
    links = copies.unionByName(ids_of_one)
    alone = equal.select("mark", F.col("least").alias("doc_id"))
    at = meets.join(alone.hint("shuffle_merge"), ["mark", "doc_id"], "left_semi").select("chunk", "doc_id", F.col("n_shingles").alias("n"), "keys")
    at = materialize(met(at, parts))
    each = at.select("doc_id", "n", F.explode("keys").alias("k")).select("doc_id", "n", "k.key", "k.far")
    roots, again = None, each.where(F.pmod(F.shiftright("key", 40), F.lit(8)) == 0)
    for then in (each, None):
        meeting = _meeting(again, roots)
        found = _similar(_stars(meeting, share), meets, share)
        if found.limit(1).count():
            links = links.unionByName(found)
            roots = components(links)
        if then is None:  # keys whose documents are in one component stay so
            again = meeting.select("doc_id", "n", "key", "far")
        else:
            again = then
            discard(meeting)
    meeting = _meeting(again, roots)
    rest = [_similar(_all_pairs(meeting.where(F.col("docs") <= HOT), share), meets, share)]
    if meeting.where(F.col("docs") > HOT).limit(1).count():
        rest.append(materialize(_blockwise(meeting.where(F.col("docs") > HOT), meets.select("doc_id", "hashes"), share)))
    for more in rest:
        if more.limit(1).count():
            links = links.unionByName(more)
            roots = None
    roots = roots if roots is not None else components(links)
    found = roots.withColumnRenamed("node", "twin")
    return held.select("chunk", "doc_id", "n_shingles", "twin").join(found.hint("shuffle_merge"), "twin", "left").select("chunk", "doc_id", "n_shingles", F.coalesce("root", "twin").alias("component_id"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk_bytes: int = CHUNK_BYTES, **options) -> DataFrame:
    """docs without the documents whose component has a smaller one, and without further rows of a kept doc_id.

    Rows with a null doc_id or without words stay.
    """
    with temporary() as keep:  # of the join only the ids that go are needed
        joined = materialize(join(docs, id_col, text_col, chunk_bytes=chunk_bytes, **options).drop("chunk"))
        gone = keep(materialize(joined.where("component_id < doc_id").select("doc_id").distinct()))
        again = keep(materialize(joined.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")))
    plain, at = unnamed(docs)
    own = plain[at[id_col]].cast("long")
    gone = F.broadcast(gone) if gone.count() <= FEW else gone.hint("shuffle_merge")  # 8 bytes a row
    kept = plain.join(gone, own == gone["doc_id"], "left_anti")
    if again.limit(1).count():
        repeated = kept.join(again, own == again["doc_id"], "left_semi").dropDuplicates([at[id_col]])
        kept = kept.join(again, own == again["doc_id"], "left_anti").unionByName(repeated)
    return kept.toDF(*docs.columns)
