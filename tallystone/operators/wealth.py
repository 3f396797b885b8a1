"""Report tables: daily wealth, allocation, income, holdings, returns."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.functions.money import EXTERNAL, INCOME, ratio, to_usd

MONEY = "decimal(24,2)"


def _usd(rows: DataFrame, fx: DataFrame, amount: str, currency: str = "currency") -> DataFrame:
    """Rates are a row a calendar day: small enough to send everywhere, whatever the data."""
    return rows.join(F.broadcast(fx.select("as_of", "rate")), "as_of").withColumn("usd", to_usd(F.col(amount), F.col(currency), F.col("rate")))


def by_client_day(rows: DataFrame, fx: DataFrame, amount: str, name: str) -> DataFrame:
    return _usd(rows, fx, amount).groupBy("client_id", "as_of").agg(F.sum("usd").cast(MONEY).alias(name))


def alternatives(marks: DataFrame, owners: DataFrame, fx: DataFrame) -> DataFrame:
    """(client_id, fund_id, statement_date, nav_usd): each owner's part of a fund's confirmed marks, in dollars of the mark's
    day. marks: fund_id, account_id, currency, statement_date, nav; of several marks on a day the greatest counts."""
    known = marks.where(F.col("nav").isNotNull()).groupBy("fund_id", "account_id", "currency", "statement_date").agg(F.max("nav").alias("nav"))
    rated = known.join(F.broadcast(fx.select(F.col("as_of").alias("statement_date"), "rate")), "statement_date")
    owned = rated.join(owners.select("account_id", "client_id", "ownership_pct"), "account_id")
    usd = to_usd(F.col("nav"), F.col("currency"), F.col("rate")) * F.col("ownership_pct")
    return owned.select("client_id", "fund_id", "statement_date", usd.cast(MONEY).alias("nav_usd"))


def _changes(points: DataFrame) -> DataFrame:
    """(client_id, as_of, change): by how much a client's marks change on a day."""
    before = F.coalesce(F.lag("nav_usd").over(Window.partitionBy("client_id", "fund_id").orderBy("statement_date")), F.lit(0).cast(MONEY))
    return points.withColumn("change", F.col("nav_usd") - before).groupBy("client_id", F.col("statement_date").alias("as_of")).agg(F.sum("change").alias("change"))


def alternatives_daily(points: DataFrame, days: DataFrame) -> DataFrame:
    """(client_id, as_of, alts_usd) for the clients' days: each fund's marks carried forward, summed over the client's funds.

    A sum of carried marks is the running sum of their changes, so there is no grid of funds and days: a fund's marks become
    changes, changes are summed by client and day, and one window a client runs over its days (bounded by the calendar).
    Marks of before the first day count from it on; 0 before a client's first mark.
    """
    change = _changes(points)
    asked = days.select("client_id", "as_of").distinct().withColumn("change", F.lit(0).cast(MONEY)).withColumn("asked", F.lit(True))
    every = asked.unionByName(change.withColumn("asked", F.lit(False))).groupBy("client_id", "as_of").agg(F.sum("change").alias("change"), F.max("asked").alias("asked"))
    upto = Window.partitionBy("client_id").orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)
    return every.withColumn("alts_usd", F.sum("change").over(upto).cast(MONEY)).where("asked").select("client_id", "as_of", "alts_usd")


def daily(positions: DataFrame, cash: DataFrame, alts: DataFrame, fx: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Client-day wealth. Positions drive; a client-day without cash has 0, one without a verdict is taken to reconcile.

    alts: the points of `alternatives`, carried forward to the days of the positions.
    """
    p, c = by_client_day(positions, fx, "owned_value", "positions_usd"), by_client_day(cash, fx, "owned_amount", "cash_usd")
    keys = ["client_id", "as_of"]
    change = _changes(alts)
    ok = verdicts.groupBy(*keys).agg(F.every("conformed_consistent").alias("ok"))
    # changes on days without positions are kept for the running sum, then go
    rows = p.join(change, keys, "full").join(c, keys, "left").join(ok, keys, "left")
    upto = Window.partitionBy("client_id").orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("alts_usd", F.coalesce(F.sum("change").over(upto), F.lit(0)).cast(MONEY)).where(F.col("positions_usd").isNotNull())
    rows = rows.join(F.broadcast(fx), "as_of").withColumn("cash_usd", F.coalesce("cash_usd", F.lit(0).cast(MONEY)))
    total = (F.col("positions_usd") + F.col("cash_usd") + F.col("alts_usd")).cast(MONEY)
    return rows.select(*keys, "positions_usd", "cash_usd", "alts_usd", total.alias("total_wealth_usd"), F.col("rate").alias("fx_rate_used"), F.col("rate_date").alias("fx_rate_date"), F.coalesce("ok", F.lit(True)).alias("books_reconcile"))


def allocation(positions: DataFrame, cash: DataFrame, alts: DataFrame, fx: DataFrame) -> DataFrame:
    """Value and weight of each class a client and day; cash and alternatives (where there are any) are classes.

    A client-day's classes are held in one row (they are few), so that its alternatives come from a running sum beside them
    and the positions are read once.
    """
    keys = ["client_id", "as_of"]
    held = _usd(positions, fx, "owned_value").groupBy(*keys, "asset_class").agg(F.sum("usd").cast(MONEY).alias("value_usd"))
    days = held.groupBy(*keys).agg(F.collect_list(F.struct("asset_class", "value_usd")).alias("classes")).join(_changes(alts), keys, "full")
    upto = Window.partitionBy("client_id").orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)
    days = days.withColumn("alts_usd", F.sum("change").over(upto).cast(MONEY)).where(F.col("classes").isNotNull())
    funds = F.when(F.col("alts_usd") > 0, F.array(F.struct(F.lit("Alternatives").alias("asset_class"), F.col("alts_usd").alias("value_usd"))))
    every = days.select(*keys, F.explode(F.when(funds.isNull(), F.col("classes")).otherwise(F.concat("classes", funds))).alias("x")).select(*keys, "x.*")
    money = by_client_day(cash, fx, "owned_amount", "value_usd").withColumn("asset_class", F.lit("Cash"))
    rows = every.unionByName(money)
    whole = F.sum("value_usd").over(Window.partitionBy(*keys))
    return rows.withColumn("weight", ratio(F.col("value_usd"), whole))


def income(moves: DataFrame, fx: DataFrame) -> DataFrame:
    rows = _usd(moves.where(F.col("type").isin(*INCOME)), fx, "owned_amount")
    return rows.groupBy("client_id", F.trunc("as_of", "month").alias("month"), "type").agg(F.sum("usd").cast(MONEY).alias("income_usd"), F.count("*").alias("movements"))


def top_holdings(positions: DataFrame, fx: DataFrame, k: int = 10) -> DataFrame:
    """The k largest securities of each client and their names; positions: those of one day, the latest."""
    now = _usd(positions, fx, "owned_value")
    rows = now.groupBy("client_id", "as_of", "security_id").agg(F.max("security_name").alias("security_name"), F.max("asset_class").alias("asset_class"), F.sum("usd").cast(MONEY).alias("owned_usd"))
    own = Window.partitionBy("client_id")
    ranked = rows.withColumn("weight", ratio(F.col("owned_usd"), F.sum("owned_usd").over(own))).withColumn("rank", F.row_number().over(own.orderBy(F.desc("owned_usd"), "security_id")))
    return ranked.where(F.col("rank") <= k)


def flows(moves: DataFrame, fx: DataFrame) -> DataFrame:
    return by_client_day(moves.where(F.col("type").isin(*EXTERNAL)).drop("owned_amount").withColumnRenamed("owned_signed", "owned_amount"), fx, "owned_amount", "external_flow_usd")


def performance(wealth: DataFrame, moved: DataFrame) -> DataFrame:
    """Daily time-weighted return and its chained index, which starts at 1."""
    rows = wealth.select("client_id", "as_of", "total_wealth_usd").join(moved, ["client_id", "as_of"], "left").withColumn("external_flow_usd", F.coalesce("external_flow_usd", F.lit(0).cast(MONEY)))
    by = Window.partitionBy("client_id").orderBy("as_of")
    before = F.lag("total_wealth_usd").over(by)
    rows = rows.withColumn("r", F.try_divide((F.col("total_wealth_usd") - F.col("external_flow_usd")).cast("double"), before.cast("double")) - 1)
    grown = F.when(F.col("r") > -1, F.ln(1 + F.col("r"))).otherwise(F.lit(0.0))
    index = F.exp(F.sum(grown).over(by.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.select("client_id", "as_of", "total_wealth_usd", "external_flow_usd", F.round("r", 6).alias("daily_twr_return"), F.round(index, 4).alias("twr_index"))


def endpoints(perf: DataFrame) -> DataFrame:
    return perf.groupBy("client_id").agg(*_ends())


def _ends() -> list:
    return [F.min("as_of").alias("inception_date"), F.max("as_of").alias("as_of"), F.min_by("total_wealth_usd", "as_of").alias("wealth_begin_usd"), F.max_by("total_wealth_usd", "as_of").alias("wealth_end_usd")]


#: A day number to count from, so that products of flows and days stay small.
EPOCH = "2000-01-01"


def dietz(perf: DataFrame) -> DataFrame:
    """Modified Dietz: flows after the first day, each weighted by the share of days left.

    One aggregate by client: the weighted flow is (last day * sum of flows - sum of flow * day) / days, and the first day's
    flow is taken off again.
    """
    return _dietz(perf.groupBy("client_id").agg(*_ends(), *_flow_sums()))


def _flow_sums() -> list:
    day, flow = F.datediff("as_of", F.lit(EPOCH).cast("date")), F.col("external_flow_usd")
    return [F.sum(flow).alias("flows"), F.sum(flow * day).alias("flow_days"), F.min_by(flow, "as_of").alias("first_flow")]


def _dietz(sums: DataFrame, *more: str) -> DataFrame:
    at = lambda c: F.datediff(c, F.lit(EPOCH).cast("date"))
    net = (F.col("flows") - F.col("first_flow")).cast(MONEY)
    later_days = F.col("flow_days") - F.col("first_flow") * at("inception_date")
    weighted = F.try_divide((net * at("as_of") - later_days).cast("double"), F.datediff("as_of", "inception_date").cast("double"))
    gain = (F.col("wealth_end_usd") - F.col("wealth_begin_usd") - net).cast("double")
    base = F.col("wealth_begin_usd").cast("double") + F.coalesce(weighted, F.lit(0.0))
    return sums.select("client_id", "inception_date", "as_of", "wealth_begin_usd", "wealth_end_usd", net.alias("net_external_flow_usd"), F.round(F.try_divide(gain, base), 6).alias("dietz_return"), *more)


#: The bracket in which a yearly return is sought, and how often it is halved.
LOW, HIGH, ROUNDS = -0.9999, 10.0, 200


def xirr(perf: DataFrame, low: float = LOW, high: float = HIGH, rounds: int = ROUNDS) -> DataFrame:
    """(client_id, irr, npv_near_zero): money-weighted yearly return, see `rates_of_return`."""
    found = rates_of_return(perf, low, high, rounds)
    near = F.abs(F.aggregate("cash", F.lit(0.0), lambda s, x: s + x["c"] / F.pow(1 + F.col("irr"), x["t"]))) < 1.0
    return found.select("client_id", F.round("irr", 8).alias("irr"), F.when(F.col("irr").isNotNull(), near).alias("npv_near_zero"))


def rates_of_return(perf: DataFrame, low: float = LOW, high: float = HIGH, rounds: int = ROUNDS) -> DataFrame:
    """(client_id, irr, cash): money-weighted yearly return by bisection inside one expression; null without a change of sign
    in the bracket or on a single day. A client's days are gathered in an array: a row a day, bounded by the calendar; its
    first and last element are the ends. cash: (t, c), years from the first day and money in (+) or out."""
    return _irr(perf.groupBy("client_id").agg(_days()), low, high, rounds)


def _days():
    day = F.struct("as_of", F.col("external_flow_usd").cast("double").alias("flow"), F.col("total_wealth_usd").cast("double").alias("w"))
    return F.array_sort(F.collect_list(day)).alias("days")


def _irr(held: DataFrame, low: float = LOW, high: float = HIGH, rounds: int = ROUNDS, *more: str) -> DataFrame:
    held = held.withColumn("first", F.get("days", F.lit(0))).withColumn("last", F.element_at("days", -1))

    def paid(x):
        at_first, at_last = x["as_of"] == F.col("first.as_of"), x["as_of"] == F.col("last.as_of")
        money = F.when(at_first, -x["w"]).otherwise(-x["flow"]) + F.when(at_last, x["w"]).otherwise(F.lit(0.0))
        return F.struct((F.datediff(x["as_of"], F.col("first.as_of")) / F.lit(365.0)).alias("t"), money.alias("c"))

    held = held.withColumn("cash", F.filter(F.transform("days", paid), lambda x: x["c"] != 0))

    def npv(rate):
        return F.aggregate("cash", F.lit(0.0), lambda s, x: s + x["c"] / F.pow(1 + rate, x["t"]))

    held = held.withColumn("at_low", npv(F.lit(low))).withColumn("at_high", npv(F.lit(high)))

    def halve(s, _):
        mid = (s["lo"] + s["hi"]) / 2
        same = F.signum(npv(mid)) == F.signum(F.col("at_low"))
        return F.struct(F.when(same, mid).otherwise(s["lo"]).alias("lo"), F.when(same, s["hi"]).otherwise(mid).alias("hi"))

    found = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), F.struct(F.lit(low).alias("lo"), F.lit(high).alias("hi")), halve, lambda s: (s["lo"] + s["hi"]) / 2)
    ok = (F.col("first.as_of") < F.col("last.as_of")) & (F.signum("at_low") * F.signum("at_high") < 0)
    return held.select("client_id", F.when(ok, found).alias("irr"), "cash", *more)


def summary(perf: DataFrame) -> DataFrame:
    """All returns of a client since its first day in one row: chained, Modified Dietz, money-weighted; one aggregate."""
    sums = perf.groupBy("client_id").agg(*_ends(), *_flow_sums(), (F.max_by("twr_index", "as_of") - 1).alias("twr_since_inception"), _days())
    told = _dietz(sums, "twr_since_inception", "days").withColumnRenamed("dietz_return", "dietz_since_inception")
    kept = [c for c in told.columns if c not in ("client_id", "days")]
    return _irr(told, LOW, HIGH, ROUNDS, *kept).select("client_id", *kept, F.round("irr", 8).alias("irr_since_inception_annualized"))
