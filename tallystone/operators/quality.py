"""Reconciliation findings, cash integrity and continuity, and the daily quality metrics."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.functions.money import signed
from tallystone.operators.conform import collapsed, pivoted

#: The grain of a holding, the compared fields, the names of findings, metrics and their dimensions.
GRAIN = ("as_of", "account_id", "security_scheme", "security_id")
FIELDS = ("security_name", "quantity", "price_amount", "price_as_of", "market_value")
MISSING = ("MISSING_IN_SEMT002", "MISSING_IN_MT535")


def findings(one: DataFrame, two: DataFrame) -> DataFrame:
    """A row for each security that one feed lacks and for each field on which both disagree: one join, then an explode.

    one: the custody statements' holdings, two: the SWIFT statements'.
    """
    side = lambda df, p: df.select(*GRAIN, F.lit(True).alias(f"{p}_there"), *(F.col(f).alias(f"{p}_{f}") for f in FIELDS))
    return _judged(side(one, "a").join(side(two, "b"), list(GRAIN), "full"))


def findings_of_feeds(feeds: DataFrame, first: str = "semt.002") -> DataFrame:
    """The same from the rows of both feeds together, which needs no join: a grain's rows meet in one aggregate. A feed has
    a grain once (of several, the greatest values are compared)."""
    own = F.col("source_format") == first
    sides = [F.max(F.when(is_, F.struct(F.lit(True).alias("there"), *FIELDS))).alias(p) for p, is_ in (("a", own), ("b", ~own))]
    rows = feeds.groupBy(*GRAIN).agg(*sides)
    return _judged(rows.select(*GRAIN, *(F.col(f"{p}.{f}").alias(f"{p}_{f}") for p in "ab" for f in ("there", *FIELDS))))


def _judged(both: DataFrame) -> DataFrame:
    made = [F.when(F.col(f"{gone}_there").isNull(), _finding(name, "presence", F.lit("ABSENT" if gone == "a" else "PRESENT"), F.lit("PRESENT" if gone == "a" else "ABSENT"))) for gone, name in zip("ab", MISSING, strict=True)]
    for f in FIELDS:
        differs = F.col("a_there") & F.col("b_there") & ~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}"))
        made.append(F.when(differs, _finding("FIELD_MISMATCH", f, F.col(f"a_{f}"), F.col(f"b_{f}"))))
    return both.select(*GRAIN, F.explode(F.filter(F.array(*made), lambda x: x.isNotNull())).alias("x")).select(*GRAIN, "x.*")


def _finding(kind, field, a, b):
    return F.struct(F.lit(kind).alias("finding"), F.lit(field).alias("field"), a.cast("string").alias("semt002_value"), b.cast("string").alias("mt535_value"))


def integrity(balances: DataFrame, entries: DataFrame) -> DataFrame:
    """Opening plus movements against closing, with raw and with conformed movements, in one pass over the entries."""
    keys = ["as_of", "account_id"]
    moved = collapsed(entries, F.sum(signed(F.col("amount"), F.col("type"))).alias("raw_amount")).groupBy(*keys)
    sums = moved.agg(F.sum("raw_amount").cast("decimal(24,2)").alias("movements_raw"), F.sum("signed_amount").cast("decimal(24,2)").alias("movements_conformed"))
    rows = pivoted(balances).join(sums, keys, "left").na.fill(0, ["movements_raw", "movements_conformed"])
    delta = lambda c: (F.col("opening") + F.col(c) - F.col("closing")).cast("decimal(24,2)")
    rows = rows.withColumn("delta_raw", delta("movements_raw")).withColumn("delta_conformed", delta("movements_conformed"))
    return rows.withColumn("raw_consistent", F.col("delta_raw") == 0).withColumn("conformed_consistent", F.col("delta_conformed") == 0)


def continuity(balances: DataFrame) -> DataFrame:
    """Each opening against the account's previous closing; unknown on its first day."""
    before = F.lag("closing").over(Window.partitionBy("account_id").orderBy("as_of"))
    rows = pivoted(balances).withColumn("prev_closing", before)
    return rows.select("as_of", "account_id", "opening", "prev_closing", (F.col("opening") - F.col("prev_closing")).cast("decimal(24,2)").alias("delta"), (F.col("opening") == F.col("prev_closing")).alias("continuous"))


def metrics(delivered: DataFrame, positions: DataFrame, found: DataFrame, cash: DataFrame, chain: DataFrame, run_date: str, expected: int | None = None, at_most: int = 3) -> DataFrame:
    """(as_of, dimension, metric, value, passed, detail): seven series over the days with deliveries, and how far the last
    one is behind run_date. One wide row a day, unpivoted.

    delivered: statement_date, status, a row a file. expected: files a day; by default all that were delivered that day.
    Continuity has no row on days with nothing to compare; counts have no verdict.
    """
    days = delivered.groupBy(F.col("statement_date").alias("as_of")).agg(F.count_if(F.col("status") == "PARSED").alias("parsed"), F.count("*").alias("files"))
    days = days.withColumn("due", F.col("files") if expected is None else F.lit(expected).cast("long"))
    n = positions.groupBy("as_of").agg(F.count("*").alias("n"))
    f = found.groupBy("as_of").agg(F.count("*").alias("found"))
    c = cash.groupBy("as_of").agg(F.count("*").alias("total"), F.count_if("conformed_consistent").alias("ok"))
    k = chain.where("continuous IS NOT NULL").groupBy("as_of").agg(F.count("*").alias("checked"), F.count_if("continuous").alias("kept"))
    wide = days.join(n, "as_of", "left").join(f, "as_of", "left").join(c, "as_of", "left").join(k, "as_of", "left")
    some = lambda name: F.coalesce(F.col(name), F.lit(0))
    share = lambda part, of: F.try_divide(part.cast("double"), F.col(of).cast("double"))
    text = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    breaks, torn = some("total") - some("ok"), some("checked") - some("kept")

    def row(dimension, metric, value, passed, detail, day=F.col("as_of")):
        return F.struct(day.alias("as_of"), F.lit(dimension).alias("dimension"), F.lit(metric).alias("metric"), value.cast("decimal(14,6)").alias("value"), passed.cast("boolean").alias("passed"), detail.alias("detail"))

    compared, none = F.col("checked").isNotNull(), F.lit(None)
    made = F.array(
        row("completeness", "files_landed_rate", share(some("parsed"), "due"), some("parsed") == F.col("due"), text(some("parsed"), " of ", F.col("due"), " expected files parsed")),
        row("accuracy", "holdings_cross_format_match_rate", 1 - share(some("found"), "n"), some("found") == 0, text(some("found"), " cross-format findings across ", some("n"), " positions")),
        row("accuracy", "cash_conformed_consistency_rate", share(some("ok"), "total"), breaks == 0, text(some("ok"), " of ", some("total"), " account-days consistent")),
        F.when(compared, row("accuracy", "cash_day_over_day_continuity_rate", share(some("kept"), "checked"), torn == 0, text(some("kept"), " of ", some("checked"), " accounts continuous from the prior day"))),
        row("exceptions", "holdings_findings_count", some("found"), none, text(some("found"), " cross-format findings")),
        row("exceptions", "cash_integrity_breaks_count", breaks, none, text(breaks, " account-days with a missing movement")),
        F.when(compared, row("exceptions", "cash_continuity_breaks_count", torn, none, text(torn, " accounts broke day-over-day continuity"))),
    )
    run, last = F.lit(run_date).cast("date"), F.max("as_of").over(Window.partitionBy())  # over a row a day
    behind = F.datediff(run, F.col("last"))
    fresh = F.when(F.col("as_of") == F.col("last"), row("freshness", "bronze_days_behind", behind, behind <= at_most, text("bronze last landed ", F.col("last")), run))
    every = wide.withColumn("last", last).select(F.explode(F.filter(F.concat(made, F.array(fresh)), lambda x: x.isNotNull())).alias("x"))
    return every.select("x.*")
