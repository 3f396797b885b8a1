"""The securities master: whose securities are held, their ISINs, and one entry for each."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.functions import identifiers

HOME = "US"
#: Columns of a mapping that an entry takes over.
FACTS = ("figi", "name", "security_type", "market_sector", "ticker", "exchange_code")


def universe(rows: DataFrame, domiciles: DataFrame) -> DataFrame:
    """(cusip, isin) of every security in the filings, each once; those of foreign issuers have no derivable ISIN and are left
    out. domiciles: cusip, country, of issuers that aren't at home; a curated list, sent to all tasks up to its checked size."""
    held = rows.select(F.upper(F.trim("cusip")).alias("cusip")).distinct().where(~identifiers.is_foreign(F.col("cusip")))
    known = held.join(domiciles.select(F.upper(F.trim("cusip")).alias("cusip"), "country"), "cusip", "left")
    return known.select("cusip", identifiers.isin_from_cusip(F.col("cusip"), F.coalesce("country", F.lit(HOME))).alias("isin"))


def assembled(isins: DataFrame, found: DataFrame) -> DataFrame:
    """One entry for each ISIN: mapped with the first match's facts, or unmapped without any. found: isin, place, FACTS."""
    first = found.groupBy("isin").agg(F.min_by(F.struct(*FACTS), "place").alias("x"))
    rows = isins.select("isin").where("isin IS NOT NULL").distinct().join(first, "isin", "left")
    return rows.select("isin", F.col("x").isNotNull().alias("mapped"), *(F.col(f"x.{f}").alias(f) for f in FACTS))
