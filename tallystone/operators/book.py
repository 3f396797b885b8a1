"""The book behind the feeds: positions from reported holdings, cost bases, and the days of a calendar on which cash moves."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MONEY = "decimal(24,2)"
#: The share of positions without a cost basis, and the day of the month from which money is withdrawn.
WITHOUT_COST, WITHDRAWN_FROM = 0.2, 18


def seeded(*parts: Column | str) -> Column:
    """A number in [0, 1) from the first eight bytes of the parts' SHA-256."""
    text = F.concat_ws(":", *(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.conv(F.substring(F.sha2(text, 256), 1, 13), 16, 10).cast("long") / F.lit(float(1 << 52))


def positions(rows: DataFrame, divisor: int) -> DataFrame:
    """(account_id, cusip, quantity, price, market_value, cost_basis) from reported shares and values: a part of the shares,
    rounded half up, at the reported price in cents. A position that rounds to nothing is an error. rows: account_id, cusip,
    shares, value."""
    held = F.round(F.col("shares") / F.lit(divisor), 0).cast("decimal(24,6)")
    none = F.raise_error(F.concat(F.lit("nothing is left of "), F.col("cusip"))).cast("decimal(24,6)")
    sized = rows.withColumn("quantity", F.when(held > 0, held).otherwise(none)).withColumn("price", F.round(F.col("value") / F.col("shares"), 2).cast(MONEY))
    valued = sized.withColumn("market_value", (F.col("quantity") * F.col("price")).cast(MONEY))
    return valued.select("account_id", "cusip", "quantity", "price", "market_value", cost_basis(F.col("account_id"), F.col("cusip"), F.col("market_value")).alias("cost_basis"))


def cost_basis(account: Column, cusip: Column, market_value: Column) -> Column:
    """Null for some, else 70 % to 110 % of the market value, the same in each run."""
    share = F.floor(70 + 40 * seeded("cost", account, cusip)).cast("decimal(9,0)")
    return F.when(seeded("known", account, cusip) >= WITHOUT_COST, (market_value * share / 100).cast(MONEY))


def cash_calendar(days: DataFrame) -> DataFrame:
    """(day, business, contribution, withdrawal, quarter_end): money comes in on a month's first business day and goes out on
    its first business day on or after the 18th. days: day; windows run over months of the calendar."""
    business = F.weekday("day") < 5
    month = Window.partitionBy(F.trunc("day", "month"))
    first = lambda when: F.min(F.when(when, F.col("day"))).over(month)
    return days.select(
        "day", business.alias("business"), F.coalesce(F.col("day") == first(business), F.lit(False)).alias("contribution"),
        F.coalesce(F.col("day") == first(business & (F.dayofmonth("day") >= WITHDRAWN_FROM)), F.lit(False)).alias("withdrawal"), ((F.last_day("day") == F.col("day")) & (F.month("day") % 3 == 0)).alias("quarter_end"),
    )
