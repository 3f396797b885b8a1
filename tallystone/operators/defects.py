"""Defects put into clean feeds, and the manifest that tells them: which statement gets one and which of its lines, both by
a hash, so that a run can be repeated and each defect, account and format is drawn on its own."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

STATEMENT = ("as_of", "account_id")
SHARE = 0.25


def drawn(*parts) -> Column:
    """A number in [0, 1) from the md5 of the parts."""
    text = F.concat_ws(":", *(F.lit(str(p)) if not isinstance(p, Column) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def _hit(seed: int, kind: str, fmt: str, target: str, candidate: Column, share: float) -> Column:
    """Whether this line is the one of its statement that gets the defect."""
    key = F.struct(F.md5(F.concat_ws(":", F.lit(str(seed)), F.lit(kind), F.col(target))).alias("h"), F.col(target).alias("t"))
    first = F.min(F.when(candidate, key)).over(Window.partitionBy(*STATEMENT))
    return candidate & (first == key) & (drawn(seed, kind, fmt, F.col("account_id"), F.col("as_of")) < share)


def _told(flag: str, kind: str, detail: Column, target: str) -> Column:
    return F.when(F.col(flag), F.struct(F.lit(kind).alias("defect"), F.col(target).alias("target_id"), detail.alias("detail")))


def holdings(rows: DataFrame, seed: int, fmt: str, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """(rows, manifest): a cost basis lost, an ISIN's check digit raised by one, a price five days old; manifest: as_of,
    account_id, defect, target_id, detail."""
    there = {"_lost": ("MISSING_COST_BASIS", F.col("cost_basis").isNotNull()), "_typo": ("MISTYPED_ISIN", F.col("security_scheme") == "ISIN"), "_old": ("STALE_PRICE", F.col("price_as_of").isNotNull())}
    marked = rows.select("*", *(_hit(seed, kind, fmt, "security_id", c, share).alias(name) for name, (kind, c) in there.items()))
    mistyped = F.concat(F.expr("substr(security_id, 1, length(security_id) - 1)"), ((F.substring("security_id", -1, 1).cast("int") + 1) % 10).cast("string"))
    stale = F.date_sub("price_as_of", 5)
    arrow = lambda a, b: F.concat(a.cast("string"), F.lit(" -> "), b.cast("string"))
    made = [
        _told("_lost", "MISSING_COST_BASIS", F.concat(F.lit("cost_basis "), arrow(F.col("cost_basis"), F.lit("None"))), "security_id"), _told("_typo", "MISTYPED_ISIN", arrow(F.col("security_id"), mistyped), "security_id"),
        _told("_old", "STALE_PRICE", F.concat(F.lit("price_as_of "), arrow(F.col("price_as_of"), stale)), "security_id"),
    ]
    manifest = marked.select(*STATEMENT, F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("x")).select(*STATEMENT, "x.*")
    bad = {"security_id": F.when(F.col("_typo"), mistyped).otherwise(F.col("security_id")), "price_as_of": F.when(F.col("_old"), stale).otherwise(F.col("price_as_of")), "cost_basis": F.when(~F.col("_lost"), F.col("cost_basis"))}
    return marked.select(*(bad.get(c, F.col(c)).alias(c) for c in rows.columns)), manifest


def cash(rows: DataFrame, seed: int, share: float = SHARE) -> tuple[DataFrame, DataFrame]:
    """(rows, manifest): an entry twice, one dropped, one settled a day later. Balances stay, so that they tell."""
    kinds = {"_twice": "DUPLICATE_TRANSACTION", "_gone": "DROPPED_TRANSACTION", "_late": "SETTLEMENT_SHIFT"}
    marked = rows.select("*", *(_hit(seed, kind, "camt.053", "transaction_id", F.lit(True), share).alias(name) for name, kind in kinds.items()))
    later = F.date_add("settlement_date", 1)
    entry = lambda what: F.concat(F.lit(f"entry {what} ("), F.col("type"), F.lit(", "), F.col("amount").cast("string"), F.lit(")"))
    made = [
        _told("_twice", kinds["_twice"], entry("duplicated"), "transaction_id"), _told("_gone", kinds["_gone"], entry("dropped"), "transaction_id"),
        _told("_late", kinds["_late"], F.concat(F.lit("settlement_date "), F.col("settlement_date").cast("string"), F.lit(" -> "), later.cast("string")), "transaction_id"),
    ]
    manifest = marked.select(*STATEMENT, F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("x")).select(*STATEMENT, "x.*")
    copies = 1 + F.col("_twice").cast("int") - F.col("_gone").cast("int")
    kept = marked.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1), copies)))
    return kept.select(*(F.when(F.col("_late"), later).otherwise(F.col(c)).alias(c) if c == "settlement_date" else F.col(c) for c in rows.columns)), manifest
