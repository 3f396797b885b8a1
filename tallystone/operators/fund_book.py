"""The book of a private fund over ten quarters: capital calls, distributions, and statements whose balance feeds the next
quarter's unrealized gain. The recurrence is an `aggregate` over the quarters of one row, so funds never meet."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MONEY = "decimal(24,2)"
#: Quarters and shares of commitment called; quarters, shares of called capital and kinds distributed; the
#: yearly fee; each quarter's unrealized gain as a share of the account.
CALLS = ((1, "0.15"), (2, "0.20"), (4, "0.15"), (6, "0.10"))
DISTRIBUTIONS = ((7, "0.05", "RETURN_OF_CAPITAL"), (9, "0.08", "CAPITAL_GAIN"))
FEE = "0.02"
GAINS = ("0", "0", "0.015", "0.020", "0.010", "0.035", "-0.010", "0.040", "0.025", "0.050")


def _money(value: Column) -> Column:
    return value.cast(MONEY)


def _part(value: Column, share: str) -> Column:
    """A share of an amount, rounded half up to cents."""
    return _money(value * F.lit(share).cast("decimal(5,4)"))


def quarter_end(vintage: Column, quarter: Column) -> Column:
    """The last day of a quarter, counted from 1 in the vintage year."""
    return F.last_day(F.add_months(F.make_date(vintage, F.lit(1), F.lit(1)), quarter * 3 - 1))


def notices(funds: DataFrame) -> DataFrame:
    """(fund_id, kind, number, notice_date, due_date, amount, cumulative, remaining_commitment, source, recallable) of all calls
    and distributions. funds: fund_id, total_commitment, vintage_year."""
    c, zero = F.col("total_commitment"), F.lit(0).cast(MONEY)
    made, called = [], zero
    none = lambda kind: F.lit(None).cast(kind)
    row = lambda kind, i, q, amount, total, left, source, again: F.struct(
        F.lit(kind).alias("kind"), F.lit(i).alias("number"), quarter_end(F.col("vintage_year"), F.lit(q)).alias("notice_date"), amount.alias("amount"), total.alias("cumulative"), left.alias("remaining_commitment"), source.alias("source"), again.alias("recallable")
    )
    for i, (q, share) in enumerate(CALLS, 1):
        amount = _part(c, share)
        called = _money(called + amount)
        made.append(row("capital_call", i, q, amount, called, _money(c - called), none("string"), none("boolean")))
    paid = zero
    for i, (q, share, source) in enumerate(DISTRIBUTIONS, 1):
        amount = _part(called, share)
        paid = _money(paid + amount)
        made.append(row("distribution", i, q, amount, paid, none(MONEY), F.lit(source), F.lit(source == "RETURN_OF_CAPITAL")))
    rows = funds.select("fund_id", F.explode(F.array(*made)).alias("x")).select("fund_id", "x.*")
    return rows.withColumn("due_date", F.when(F.col("kind") == "capital_call", F.date_add("notice_date", 14)))


def statements(funds: DataFrame) -> DataFrame:
    """(fund_id, period_end, beginning_balance, contributions, distributions, management_fees, realized_gain_loss,
    unrealized_gain_loss, ending_balance, total_commitment, unfunded_commitment): ten quarters of each fund."""
    c = F.col("total_commitment")
    whole = sum((_part(c, s) for _, s in CALLS), F.lit(0).cast(MONEY))
    zero = F.lit(0).cast(MONEY)
    at = lambda table, q: {k: v for k, *v in table}.get(q)
    quarters = []
    for q, gain in enumerate(GAINS, 1):
        call, paid = at(CALLS, q), at(DISTRIBUTIONS, q)
        distributed = _part(_money(whole), paid[0]) if paid else zero
        quarters.append(F.struct(F.lit(q).alias("q"), (_part(c, call[0]) if call else zero).alias("contributions"), distributed.alias("distributions"), (distributed if paid and paid[1] == "CAPITAL_GAIN" else zero).alias("realized"), F.lit(gain).cast("decimal(6,4)").alias("gain")))
    line = f"struct<q:int,beginning:{MONEY},contributions:{MONEY},distributions:{MONEY},fees:{MONEY},realized:{MONEY},unrealized:{MONEY},ending:{MONEY},called:{MONEY}>"
    start = F.struct(zero.alias("balance"), zero.alias("called"), F.array().cast(f"array<{line}>").alias("lines"))
    fee = _money(c * F.lit(FEE).cast("decimal(5,4)") / 4)

    def step(s: Column, x: Column) -> Column:
        called = _money(s["called"] + x["contributions"])
        fees = F.when(called > 0, fee).otherwise(zero)
        before = _money(s["balance"] + x["contributions"] - x["distributions"] - fees)
        unrealized = _money(before * x["gain"])
        ending = _money(before + x["realized"] + unrealized)
        one = F.struct(x["q"].alias("q"), s["balance"].alias("beginning"), x["contributions"].alias("contributions"), x["distributions"].alias("distributions"), fees.alias("fees"), x["realized"].alias("realized"), unrealized.alias("unrealized"), ending.alias("ending"), called.alias("called"))
        return F.struct(ending.alias("balance"), called.alias("called"), F.concat(s["lines"], F.array(one.cast(line))).alias("lines"))

    rows = funds.withColumn("fee", fee).select("fund_id", "vintage_year", "total_commitment", F.explode(F.aggregate(F.array(*quarters), start, step)["lines"]).alias("x"))
    return rows.select(
        "fund_id", quarter_end(F.col("vintage_year"), F.col("x.q")).alias("period_end"), F.col("x.beginning").alias("beginning_balance"), "x.contributions", "x.distributions", F.col("x.fees").alias("management_fees"), F.col("x.realized").alias("realized_gain_loss"),
        F.col("x.unrealized").alias("unrealized_gain_loss"), F.col("x.ending").alias("ending_balance"), "total_commitment", _money(F.col("total_commitment") - F.col("x.called")).alias("unfunded_commitment"),
    )
