"""Sharding by a k-d tree, in DataFrame functions only.

Each document is a point of metadata, numbers in [0, 1] made of its text alone (so that equal texts share a shard): its
size (logarithm of its bytes), its script (bytes a character) and its words (white space a character). A node of the tree
is split at the weighted median (weights: sizes) of the dimension with the widest weighted spread, measured in the
dimension's spread over the whole table, until the leaves reach the target bytes: a node due l leaves gives the lower
half of them (rounded down) the like share of its bytes. Medians are exact to the last bit of the split key: rounds of
histograms with 4,096 bins a node, summed up by Spark; a row a node comes back to the driver. Below the dimension's value
the key holds the CRC-32, so documents with equal values can be parted but equal texts never are.

Slots: rows are counted by shard and hash bucket, counts are summed up, and rows numbered inside their bucket.

Defined results: a null text has size 1 (0 bytes) and CRC-32 0; equal texts share a shard; a group of equal texts larger
than a shard makes that shard larger; fewer texts than shards leave shards empty; rows with the same doc_id get slots
of their own; an empty table gives an empty result; other columns don't take part.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.llm.common import materialize, quoted

BINS = 12  # bits of a histogram's bins
VALUE_BITS, TIE_BITS = 28, 32
#: Hash buckets of a shard, and of all shards together (their counts are sent to all tasks).
BUCKETS, ALL_BUCKETS = 4096, 1 << 18
DIMENSIONS = ("by_size", "by_script", "by_words")
WHITE = " \t\n\v\f\r"


@dataclass
class Split:
    """A node (the number of its first shard) due `leaves` shards: rows whose key along `dimension` is above `end` go to
    the upper ones, from node + leaves // 2 on."""

    node: int
    leaves: int
    dimension: str
    total: int
    end: int = 0


def points(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, size, text_crc32 and the dimensions in [0, 1]."""
    text = F.coalesce(docs[quoted(text_col)], F.lit(""))
    raw = text.cast("binary")
    size = F.octet_length(raw).cast("long") + 1
    made = docs.select(docs[quoted(id_col)].cast("long").alias("doc_id"), size.alias("size"), F.crc32(raw).alias("text_crc32"), F.char_length(text).alias("chars"), F.char_length(F.translate(text, WHITE, "")).alias("dark"))
    inside = lambda c: F.greatest(F.lit(0.0), F.least(F.lit(1.0), c))
    return made.select(
        "doc_id",
        "size",
        "text_crc32",
        (F.log2("size") / 31.0).alias("by_size"),
        inside((F.col("size") / (F.col("chars") + 1) - 1) / 3).alias("by_script"),
        inside((F.col("chars") - F.col("dark")) / (F.col("chars") + 1)).alias("by_words"),
    )


def split_key(dimension: Column) -> Column:
    """An integer of 60 bits: the value in [0, 1], then the CRC-32 that parts equal values."""
    value = F.least(F.lit((1 << VALUE_BITS) - 1), F.floor(F.least(F.greatest(dimension, F.lit(0.0)), F.lit(1.0)) * float(1 << VALUE_BITS)).cast("long"))
    return F.shiftleft(value, TIE_BITS) + F.col("text_crc32")


def _at(rows: DataFrame, splits: list[Split], **values: list[int]) -> DataFrame:
    """Rows of the split nodes with the key along the node's dimension, and further numbers of the node. What is sent to
    all tasks is a row a node, at most as many as shards."""
    facts = ", ".join(str((s.node, DIMENSIONS.index(s.dimension), *map(int, own))) for s, own in zip(splits, zip(*values.values(), strict=True), strict=True))
    wide = ", ".join(f"CAST({v} AS BIGINT) AS {v}" for v in values)
    sent = rows.sparkSession.sql(f"SELECT node, dimension, {wide} FROM VALUES {facts} AS t(node, dimension, {', '.join(values)})")
    along = F.lit(None).cast("double")
    for i, name in enumerate(DIMENSIONS):
        along = F.when(F.col("dimension") == i, F.col(name)).otherwise(along)
    return rows.join(F.broadcast(sent), "node").withColumn("key", split_key(along))


def _spreads(rows: DataFrame) -> dict[int, tuple[int, dict[str, float]]]:
    """Each node's bytes, and its weighted standard deviation along each dimension."""
    w = F.sum(F.col("size").cast("double"))
    moments = [f(F.col(d)).alias(f"{d}{i}") for d in DIMENSIONS for i, f in enumerate((lambda x: F.sum(F.col("size") * x) / w, lambda x: F.sum(F.col("size") * x * x) / w))]
    found = rows.groupBy("node").agg(F.sum("size").alias("total"), *moments).collect()  # a row a node
    return {r["node"]: (r["total"], {d: max(0.0, r[f"{d}1"] - r[f"{d}0"] ** 2) ** 0.5 for d in DIMENSIONS}) for r in found}


def widest(own: dict[str, float], whole: dict[str, float]) -> str:
    """The dimension along which a node is widest, in units of the whole table's spread; at the root all are 1, and the
    wider one as it is wins."""
    return max(DIMENSIONS, key=lambda d: (round(own[d] / whole[d], 9) if whole[d] > 1e-9 else 0.0, own[d], d))


def _medians(rows: DataFrame, splits: list[Split]) -> None:
    """Sets the end of each split: the largest key of its lower shards, found 12 bits at a time."""
    aim = {s.node: -(-s.total * (s.leaves // 2) // s.leaves) for s in splits}
    prefix, before, passed = ({s.node: 0 for s in splits} for _ in range(3))
    for shift in range(VALUE_BITS + TIE_BITS - BINS, -1, -BINS):
        nodes = [s.node for s in splits]
        keyed = _at(rows, splits, prefix=[prefix[n] for n in nodes], due=[aim[n] - before[n] for n in nodes])
        inside = keyed.where(F.shiftright("key", shift + BINS) == F.col("prefix"))
        bins = inside.groupBy("node", "due", F.shiftright("key", shift).alias("bin")).agg(F.sum("size").alias("w"))
        upto = bins.withColumn("upto", F.sum("w").over(Window.partitionBy("node").orderBy("bin")))
        reached = upto.where(F.col("upto") >= F.col("due")).groupBy("node").agg(F.min(F.struct("bin", "w", "upto")).alias("at"))
        for r in reached.collect():  # a row a node
            prefix[r["node"]], passed[r["node"]] = r["at"]["bin"], r["at"]["w"]
            before[r["node"]] += r["at"]["upto"] - r["at"]["w"]
    for s in splits:  # the key at which the aim is passed goes to the side that comes closer to it
        n = s.node
        s.end = prefix[n] if before[n] + passed[n] - aim[n] <= aim[n] - before[n] else prefix[n] - 1


def grown(rows: DataFrame, shards: int | None, target_bytes: int | None) -> tuple[DataFrame, list[Split], int]:
    """Rows with their leaf as `node`, all splits of the tree, and the number of shards."""
    rows, tree, whole = rows.withColumn("node", F.lit(0)), [], {}
    due: dict[int, int] = {}
    level = 0
    while True:
        spreads = _spreads(rows)
        if not due:
            total, whole = spreads.get(0, (0, {}))
            due = {0: shards or max(1, -(-total // target_bytes))}
            count = due[0]
        splits = [Split(n, due[n], widest(sd, whole), w) for n, (w, sd) in sorted(spreads.items()) if due[n] > 1]
        due = {k: v for n, leaves in due.items() for k, v in ((n, max(1, leaves // 2)), (n + leaves // 2, leaves - leaves // 2)) if v and (leaves > 1 or k == n)}
        if not splits:
            return rows, tree, count
        _medians(rows, splits)
        tree += splits
        apart = _at(rows, splits, end=[s.end for s in splits], upper=[s.leaves // 2 for s in splits])
        moved = apart.withColumn("node", (F.col("node") + F.when(F.col("key") > F.col("end"), F.col("upper")).otherwise(0)).cast("int")).select(*rows.columns)
        done = [n for n in spreads if n not in {s.node for s in splits}]
        rows = moved.unionByName(rows.where(F.col("node").isin(done))) if done else moved
        level += 1
        if level % 4 == 0 or done:
            rows = materialize(rows)


def shards(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int | None = 8, target_bytes: int | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) for each row; so many shards of nearly equal bytes, or,
    with shards=None, as many as hold the target bytes each."""
    rows, _, count = grown(materialize(points(docs, id_col, text_col)), shards, target_bytes)
    buckets = max(1, min(BUCKETS, ALL_BUCKETS // count))
    placed = rows.select("doc_id", "size", "text_crc32", F.col("node").cast("int").alias("shard"), F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(buckets)).cast("int").alias("bucket"))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("offset"))
    inner = Window.partitionBy("shard", "bucket").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("place", F.row_number().over(inner)).join(F.broadcast(offsets), ["shard", "bucket"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("offset") + F.col("place") - 1).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
