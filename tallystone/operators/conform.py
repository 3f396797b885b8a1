"""Conformed positions and cash from raw feeds."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.functions.money import prorated, signed

#: The preferred delivery comes first.
FORMATS = ("semt.002", "MT535")


def chosen_delivery(holdings: DataFrame) -> DataFrame:
    """Rows of the preferred format that delivered for an account and day: the whole delivery, never row by row."""
    rank = F.when(F.col("source_format") == FORMATS[0], 1).otherwise(2)
    best = F.min(rank).over(Window.partitionBy("as_of", "account_id"))
    return holdings.withColumn("_rank", rank).withColumn("_best", best).where("_rank = _best").drop("_rank", "_best")


def deduped(holdings: DataFrame) -> DataFrame:
    """One row for each (as_of, account, scheme, security): that of the first file."""
    first = F.row_number().over(Window.partitionBy("as_of", "account_id", "security_scheme", "security_id").orderBy("file_path"))
    return chosen_delivery(holdings).withColumn("_n", first).where("_n = 1").drop("_n")


def enriched(holdings: DataFrame, master: DataFrame) -> DataFrame:
    """Names and classes from the securities master, which knows ISINs; what is missing stays visible, with the feed's name."""
    known = master.select("security_id", F.lit("ISIN").alias("security_scheme"), "mapped", "name", "ticker", "asset_class")
    status = F.when(F.col("mapped").isNull(), "NOT_IN_MASTER").when(~F.col("mapped"), "UNKNOWN").otherwise("MAPPED")
    joined = deduped(holdings).join(known, ["security_scheme", "security_id"], "left")
    return joined.withColumn("security_name", F.coalesce("name", "security_name", "security_id")).withColumn("asset_class", F.coalesce("asset_class", F.lit("Unknown"))).withColumn("instrument_status", status)


def position_owners(positions: DataFrame, owners: DataFrame) -> DataFrame:
    return positions.join(owners, "account_id").withColumn("owned_value", prorated(F.col("market_value"), F.col("ownership_pct")))


def collapsed(entries: DataFrame, *more: Column) -> DataFrame:
    """One row for each transaction; whether its copies disagree (a column's least and greatest differ). more: further
    aggregates over a transaction's copies."""
    same = ("type", "trade_date", "settlement_date", "amount", "currency", "description")
    disagrees = F.lit(False)
    for c in same:
        disagrees = disagrees | (F.coalesce(F.min(c) != F.max(c), F.lit(False)))
    rows = entries.groupBy("as_of", "account_id", "transaction_id").agg(
        F.max("type").alias("type"), F.min("trade_date").alias("trade_date"), F.min("settlement_date").alias("settlement_date"), F.max("amount").alias("amount"), F.max("currency").alias("currency"),
        F.count("*").alias("source_row_count"), disagrees.alias("source_disagrees"), *more,
    )
    return rows.withColumn("signed_amount", signed(F.col("amount"), F.col("type")).cast("decimal(24,2)"))


def cash_owners(rows: DataFrame, amount: str, owners: DataFrame) -> DataFrame:
    return rows.join(owners, "account_id").withColumn("owned_amount", prorated(F.col(amount), F.col("ownership_pct")))


def pivoted(balances: DataFrame) -> DataFrame:
    side = lambda kind: F.max(F.when(F.col("balance_type") == kind, F.col("amount")))
    return balances.groupBy("as_of", "account_id").agg(side("OPENING").alias("opening"), side("CLOSING").alias("closing"), F.max("currency").alias("currency"))
