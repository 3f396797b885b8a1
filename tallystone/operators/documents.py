"""Private-fund documents: consistency, cross-document validation, routing, roll-up, evaluation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallystone.functions.money import to_usd

#: The confidence that passes without review, and the cap on inconsistent documents.
THRESHOLD, CAP = 0.85, 0.5


def judged(docs: DataFrame) -> DataFrame:
    """docs with self_consistent, confidence, cross_document_valid, validation_notes and routing.

    A statement is consistent if its seven amounts are there and beginning + contributions - distributions - fees +
    realized + unrealized = ending; a call if it has amount, cumulative and remaining commitment.
    """
    flow = F.col("doc_type").isin("capital_call", "distribution")
    net = F.col("beginning") + F.col("contributions") - F.col("distributions") - F.col("management_fees") + F.col("realized") + F.col("unrealized")
    balanced = F.coalesce(net.cast("decimal(24,2)") == F.col("ending"), F.lit(False))  # a missing part is null
    filled = F.col("amount").isNotNull() & F.col("cumulative").isNotNull()
    own = F.when(F.col("doc_type") == "capital_call", filled & F.col("remaining_commitment").isNotNull()).when(F.col("doc_type") == "distribution", filled).when(F.col("doc_type") == "capital_account_statement", balanced).otherwise(False)
    group = Window.partitionBy("fund_id", "doc_type")
    by = group.orderBy(F.coalesce("sequence_number", F.lit(0)), "doc_date", "document")
    whole = F.col("amount").isNotNull() & F.col("cumulative").isNotNull()
    running = F.sum(F.when(whole, F.col("amount"))).over(by.rowsBetween(Window.unboundedPreceding, 0)).cast("decimal(24,2)")
    rows = docs.withColumn("self_consistent", own).withColumn("place", F.row_number().over(by)).withColumn("running", running)
    rows = rows.withColumn("prior_ending", F.last("ending", ignorenulls=True).over(by.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.withColumn("gap", F.max(~F.col("sequence_number").eqNullSafe(F.col("place"))).over(group))
    notes = [
        F.when(flow & F.col("gap"), "sequence has a gap"),
        F.when(flow & ~whole, "amount or cumulative missing"),
        F.when(flow & whole & (F.col("running") != F.col("cumulative")), "running total differs"),
        F.when((F.col("doc_type") == "capital_account_statement") & F.col("prior_ending").isNotNull() & (F.col("beginning") != F.col("prior_ending")), "beginning differs from prior ending"),
        F.when(~flow & (F.col("doc_type") != "capital_account_statement"), "unknown document type"),
    ]
    rows = rows.withColumn("validation_notes", F.nullif(F.concat_ws("; ", *notes), F.lit("")))
    rows = rows.withColumn("confidence", F.when(F.col("self_consistent"), F.col("self_reported")).otherwise(F.least("self_reported", F.lit(CAP))))
    rows = rows.withColumn("cross_document_valid", F.col("validation_notes").isNull())
    auto = F.col("self_consistent") & F.col("cross_document_valid") & (F.col("confidence") >= THRESHOLD)
    return rows.withColumn("routing", F.when(auto, "auto_accept").otherwise("needs_review")).drop("place", "running", "prior_ending", "gap")


def confirmed(docs: DataFrame, decisions: DataFrame) -> DataFrame:
    """A decision's value, else that of an accepted extraction, else null."""
    rows = docs.join(decisions.withColumnRenamed("status", "reviewed_status"), ["fund_id", "document"], "left")
    value = F.when(F.col("reviewed_status").isNotNull(), F.col("final_amount")).when(F.col("routing") == "auto_accept", F.col("amount"))
    return rows.withColumn("confirmed_amount", value)


def rolled_up(rows: DataFrame) -> DataFrame:
    """One row for each fund from its confirmed documents: latest cumulative figures, commitment, first date, multiple.

    as_of, NAV and commitments are the latest statement's. Without one, as_of is null, NAV 0, and the latest call tells
    the commitment: called and remaining.
    """
    known = rows.where(F.col("confirmed_amount").isNotNull())
    order = F.struct("sequence_number", "doc_date", "document")
    latest = lambda kind, c: F.max_by(F.when(F.col("doc_type") == kind, F.col(c)), F.when(F.col("doc_type") == kind, order))
    pending = rows.groupBy("fund_id").agg(F.count_if((F.col("routing") == "needs_review") & F.col("reviewed_status").isNull()).alias("pending_review_documents"))
    stated = F.col("as_of").isNotNull()
    sums = known.groupBy("fund_id").agg(
        latest("capital_account_statement", "doc_date").alias("as_of"), latest("capital_account_statement", "total_commitment").alias("stated_commitment"),
        latest("capital_account_statement", "unfunded_commitment").alias("stated_unfunded"), F.coalesce(latest("capital_call", "remaining_commitment"), F.lit(0).cast("decimal(24,2)")).alias("remaining"),
        F.min("doc_date").alias("inception_date"), F.coalesce(latest("capital_call", "cumulative"), F.lit(0).cast("decimal(24,2)")).alias("total_called"),
        F.coalesce(latest("distribution", "cumulative"), F.lit(0).cast("decimal(24,2)")).alias("total_distributed"), F.coalesce(latest("capital_account_statement", "ending"), F.lit(0).cast("decimal(24,2)")).alias("current_nav"),
    )
    moic = F.try_divide((F.col("total_distributed") + F.col("current_nav")).cast("double"), F.col("total_called").cast("double"))
    rows = pending.join(sums, "fund_id").withColumn("moic", F.round(moic, 6))
    implied = (F.col("total_called") + F.col("remaining")).cast("decimal(24,2)")
    rows = rows.withColumn("total_commitment", F.when(stated, F.col("stated_commitment")).otherwise(implied))
    return rows.withColumn("unfunded_commitment", F.when(stated, F.col("stated_unfunded")).otherwise(F.col("remaining"))).drop("stated_commitment", "stated_unfunded", "remaining")


def nav_by_day(statements: DataFrame, days: DataFrame) -> DataFrame:
    """(as_of, nav): marks carried forward for each fund to the asked days, then summed; 0 before a fund's first mark.

    days: as_of. A sum of carried marks is the running sum of their changes, so no fund meets any day but its marks'. The
    last window runs over one row a day of the calendar.
    """
    marks = statements.where(F.col("ending").isNotNull()).groupBy("fund_id", F.col("doc_date").alias("as_of")).agg(F.max("ending").alias("nav"))
    before = F.coalesce(F.lag("nav").over(Window.partitionBy("fund_id").orderBy("as_of")), F.lit(0).cast("decimal(24,2)"))
    change = marks.withColumn("change", F.col("nav") - before).groupBy("as_of").agg(F.sum("change").alias("change"))
    grid = change.join(days.select("as_of").distinct().withColumn("asked", F.lit(True)), "as_of", "full")
    upto = Window.orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)
    return grid.withColumn("nav", F.coalesce(F.sum("change").over(upto), F.lit(0)).cast("decimal(24,2)")).where("asked").select("as_of", "nav")


def marks(confirmed_docs: DataFrame, accounts: DataFrame) -> DataFrame:
    """(fund_id, account_id, currency, statement_date, nav) of confirmed statements. accounts: account_id, currency; a fund
    belongs to the account of its id."""
    rows = confirmed_docs.where((F.col("doc_type") == "capital_account_statement") & F.col("confirmed_amount").isNotNull())
    rows = rows.select("fund_id", F.col("fund_id").alias("account_id"), F.col("doc_date").alias("statement_date"), F.col("ending").alias("nav"))
    return rows.join(accounts.select("account_id", "currency"), "account_id").select("fund_id", "account_id", "currency", "statement_date", "nav")


#: Columns of a roll-up in the fund's currency, and their names in dollars.
IN_DOLLARS = {"total_commitment": "total_commitment_usd", "total_called": "called_to_date_usd", "total_distributed": "distributed_to_date_usd", "unfunded_commitment": "unfunded_commitment_usd", "current_nav": "current_nav_usd"}


def holdings(funds: DataFrame, owners: DataFrame, fx: DataFrame) -> DataFrame:
    """A row for each client and fund: its part of the roll-up in dollars, at the rate of the statement's day or, without
    one, of the fund's first document. Ratios and counts are every owner's alike. funds: a roll-up with account_id, currency."""
    at = lambda day, name: F.broadcast(fx.select(F.col("as_of").alias(day), F.col("rate").alias(name)))
    rated = funds.join(at("as_of", "_stated"), "as_of", "left").join(at("inception_date", "_begun"), "inception_date", "left").withColumn("rate", F.coalesce("_stated", "_begun"))
    owned = rated.join(owners.select("account_id", "client_id", "client_name", "ownership_pct"), "account_id")
    usd = lambda c: (to_usd(F.col(c), F.col("currency"), F.col("rate")) * F.col("ownership_pct")).cast("decimal(24,2)")
    return owned.select("client_id", "client_name", "fund_id", "fund_name", "account_id", "currency", "inception_date", "as_of", *(usd(c).alias(name) for c, name in IN_DOLLARS.items()), "moic", "pending_review_documents")


def evaluated(docs: DataFrame, truth: DataFrame) -> DataFrame:
    """(doc_type, documents, extracted, exact, field_accuracy): extracted against all true fields of a document.

    truth: document, doc_type and fields; null where a document's type has no such field. A true field that is missing or
    differs is a mismatch; documents without an extraction are counted, but not scored.
    """
    fields = [f for f in truth.columns if f not in ("fund_id", "document", "doc_type")]
    found = docs.select("document", *(F.col(f).alias(f"found_{f}") if f in docs.columns else F.lit(None).alias(f"found_{f}") for f in fields), F.lit(True).alias("there"))
    asked = [F.col(f).isNotNull().cast("int") for f in fields]
    hits = [F.coalesce(F.col(f) == F.col(f"found_{f}"), F.lit(False)).cast("int") for f in fields]
    rows = truth.join(found, "document", "left").select("doc_type", F.coalesce("there", F.lit(False)).alias("there"), sum(asked, F.lit(0)).alias("asked"), sum(hits, F.lit(0)).alias("hits"))
    told = lambda c: F.sum(F.when(F.col("there"), F.col(c)))
    return rows.groupBy("doc_type").agg(
        F.count("*").alias("documents"), F.count_if("there").alias("extracted"), F.count_if(F.col("there") & (F.col("hits") == F.col("asked"))).alias("exact"),
        F.round(F.try_divide(told("hits").cast("double"), told("asked").cast("double")), 6).alias("field_accuracy"),
    )
