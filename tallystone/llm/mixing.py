"""Mixing sources to target weights by Poisson replication, in DataFrame functions.

Each source gets a mean repetition rate: target share times the epochs' rows, over the source's rows. A document's
count comes from inverting the Poisson distribution of that mean at a number in [0, 1) that md5 draws from the seed and
the doc_id; the document is exploded into so many copies, and all copies are shuffled globally by an md5 key (ranges of
the key are partitions, sorted inside).

A rate above 64 is cut into equal pieces of at most 64: a Poisson variable is the sum of independent ones, so each piece
is inverted at a number of its own and the counts are added. So a source of one row can have any rate.

Target weights: as given, or proportional to rows^temperature.

Defined results: a null source is a source of its own; a null doc_id draws as the text "null"; rows with the same doc_id
draw the same count; null, empty and long texts pass through unread; an empty table gives an empty result; other columns
pass through, whatever their names, and those with the names of new columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystone.llm.common import lookup, materialize, quoted

NEW = ("rate", "n_copies", "copy", "shuffle_key")
#: The largest mean that is inverted at once. Rows of sources with a larger rate than MANY are exploded in two steps with
#: a shuffle between, by runs of copies, as a generator holds all copies of a row at once.
PIECE, MANY, RUN = 64, 128, 256
#: So many sources are sent to all tasks (some 100 bytes to 1.5 KB each); more are joined by `lookup`.
FEW = 5000
TEMPERATURE, EPOCHS, SEED = 0.5, 1.0, 17


def drawn(seed: int, *parts: Column) -> Column:
    """The first 52 bits of an md5 as a long."""
    text = F.concat_ws(":", F.lit(str(seed)), *(p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long")


def distribution(mean: Column) -> Column:
    """P(X <= k) of a Poisson variable for k = 0, 1, ... until what is left can't be drawn."""
    last = (mean + 12 * F.sqrt(mean) + 24).cast("int")
    begin = F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("c"))

    def step(state: Column, k: Column) -> Column:
        p = state["p"] * mean / k
        return F.struct(p.alias("p"), F.concat(state["c"], F.array(F.element_at(state["c"], -1) + p)).alias("c"))

    return F.aggregate(F.sequence(F.lit(1), last), begin, step)["c"]


def rates(sources: DataFrame, temperature: float, epochs: float, weights: dict[str, float] | None) -> DataFrame:
    """(source, n, rate, pieces, upto) for each source. sources: a row a document."""
    counts = sources.groupBy("source").agg(F.count("*").alias("n"))
    if weights is None:
        weighted = counts.withColumn("w", F.pow(F.col("n").cast("double"), F.lit(temperature)))
    else:
        given = sources.sparkSession.createDataFrame([(_name(k), float(v)) for k, v in weights.items()], "source string, w double")
        weighted = counts.join(given, "source", "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
    whole = F.broadcast(weighted.agg(F.sum("w").alias("ws"), F.sum("n").alias("ns")))
    rate = F.when(F.col("ws") > 0, F.col("w") / F.col("ws") * F.col("ns") * F.lit(epochs) / F.col("n")).otherwise(F.lit(0.0))
    known = weighted.join(whole).select("source", "n", rate.alias("rate")).withColumn("pieces", F.greatest(F.lit(1), F.ceil(F.col("rate") / PIECE)).cast("int"))
    return known.withColumn("upto", distribution(F.col("rate") / F.col("pieces")))


def _name(source: str | None) -> str:
    return "n" if source is None else f"s{source}"


def _counted(rated: DataFrame, seed: int) -> DataFrame:
    """(row, id, rate, n_copies) of rows that are drawn at least once."""
    numbers = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda i: drawn(seed, F.col("id"), i) / F.lit(float(1 << 52)))
    count = F.aggregate(numbers, F.lit(0).cast("long"), lambda held, u: held + F.size(F.filter("upto", lambda c: c <= u)))
    return rated.select("row", "id", F.round("rate", 6).alias("rate"), count.alias("n_copies")).where("n_copies > 0")


def _copies(runs: DataFrame, length: int) -> DataFrame:
    """A row for each copy of a run: copies run * length and on. A generator holds the copies of a row at once."""
    first = F.col("run") * F.lit(length)
    return runs.withColumn("copy", F.explode(F.sequence(first, F.least(F.col("n_copies") - 1, first + F.lit(length - 1)))))


def mix(docs: DataFrame, source_col: str = "source", id_col: str = "doc_id", temperature: float = TEMPERATURE, epochs: float = EPOCHS, weights: dict[str, float] | None = None, seed: int = SEED) -> DataFrame:
    """A row for each copy of each document, with rate, n_copies, copy (from 0) and shuffle_key, in the order of shuffle_key."""
    kept = [c for c in docs.columns if c not in NEW]
    own = F.struct(*(docs[quoted(c)] for c in kept)).alias("row")
    source = F.coalesce(F.concat(F.lit("s"), docs[quoted(source_col)].cast("string")), F.lit("n")).alias("source")
    rows = docs.select(own, F.coalesce(docs[quoted(id_col)].cast("string"), F.lit("null")).alias("id"), source)
    facts = materialize(rates(docs.select(source), temperature, epochs, weights))
    sent = facts.agg(F.count("*").alias("sources"), F.coalesce(F.max("rate"), F.lit(0.0)).alias("rate")).first()
    rated = lambda some: rows.join(F.broadcast(some), "source") if sent["sources"] <= FEW else lookup(rows, some, "source", "n")
    copies = _copies(_counted(rated(facts.where(F.col("rate") <= MANY)), seed).withColumn("run", F.lit(0).cast("long")), 1 << 40)
    if sent["rate"] > MANY:
        runs = _counted(rated(facts.where(F.col("rate") > MANY)), seed).withColumn("run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n_copies") - 1) / RUN))))
        copies = copies.unionByName(_copies(runs.repartition("id", "run"), RUN))
    shuffled = copies.withColumn("shuffle_key", drawn(seed + 1, F.col("id"), F.col("copy")))
    # the key is uniform, so equal ranges of it are equal partitions: no sampling pass
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = shuffled.repartitionById(parts, F.shiftright(F.shiftright("shuffle_key", 20) * parts, 32).cast("int"))
    return dealt.sortWithinPartitions("shuffle_key").select(*(F.col("row")[c].alias(c) for c in kept), "rate", "n_copies", "copy", "shuffle_key")
