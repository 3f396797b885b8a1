"""File registry, restatements, review queue, tenants, point-in-time lookups."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystone.operators.serving import checked_broadcast, clients_of


def diff(old: DataFrame, new: DataFrame) -> DataFrame:
    """new with status: new, restated (other digest) or unchanged."""
    before = old.select("file_path", F.col("sha256").alias("_sha"))
    status = F.when(F.col("_sha").isNull(), "new").when(F.col("_sha") != F.col("sha256"), "restated").otherwise("unchanged")
    return new.join(before, "file_path", "left").withColumn("status", status).drop("_sha")


def superseded(held: DataFrame, arrived: DataFrame) -> DataFrame:
    """held without the files that arrived again, and those that arrived."""
    return held.join(arrived.select("file_path"), "file_path", "left_anti").unionByName(arrived.select(*held.columns))


def merged_queue(queue: DataFrame, fresh: DataFrame) -> DataFrame:
    """Pending items are refreshed or, when they vanished, marked stale; decided ones stay; new ones are pending."""
    old = queue.select("fund_id", "document", F.col("status").alias("_status"), F.col("amount").alias("_amount"))
    new = fresh.select("fund_id", "document", F.col("amount"), F.lit(True).alias("_fresh"))
    both = old.join(new, ["fund_id", "document"], "full")
    decided = F.col("_status").isNotNull() & (F.col("_status") != "pending")
    return both.select(
        "fund_id", "document", F.coalesce("_status", F.lit("pending")).alias("status"),
        F.when(decided | F.col("_fresh").isNull(), F.col("_amount")).otherwise(F.col("amount")).alias("amount"),
        (F.col("_fresh").isNull() & (F.col("_status") == "pending")).alias("stale"),
    )


def decide(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pending items take their decision; a second decision is refused and shows as a conflict."""
    rows = queue.join(decisions.select("fund_id", "document", F.col("status").alias("_to"), "final_amount"), ["fund_id", "document"], "left")
    may = F.col("_to").isNotNull() & (F.col("status") == "pending")
    taken = F.when(F.col("_to") == "approved", F.col("amount")).otherwise(F.col("final_amount"))
    return rows.select("fund_id", "document", F.when(may, F.col("_to")).otherwise(F.col("status")).alias("status"), F.when(may, taken).alias("final_amount"), (F.col("_to").isNotNull() & ~may).alias("conflict"))


def audited(queue: DataFrame, decisions: DataFrame) -> DataFrame:
    """(fund_id, document, action, status_before, status_after, extracted_amount, final_amount) to be appended to the audit:
    a row for each decision that was taken. An approval takes over what was extracted; refused ones leave no row."""
    rows = queue.where("status = 'pending'").select("fund_id", "document", F.col("status").alias("status_before"), F.col("amount").alias("extracted_amount"))
    taken = rows.join(decisions.select("fund_id", "document", F.col("status").alias("status_after"), F.col("final_amount").alias("_given")), ["fund_id", "document"])
    approved = F.col("status_after") == "approved"
    return taken.select("fund_id", "document", F.when(approved, "approve").otherwise("correct").alias("action"), "status_before", "status_after", "extracted_amount", F.when(approved, F.col("extracted_amount")).otherwise(F.col("_given")).alias("final_amount"))


def review_source(judged: DataFrame, extractions: DataFrame) -> DataFrame:
    """What a reviewer is shown: documents that need a review, with the fields that were extracted. extractions: fund_id,
    document, fields_json."""
    waiting = judged.where("routing = 'needs_review'")
    return waiting.join(extractions.select("fund_id", "document", "fields_json"), ["fund_id", "document"]).select("fund_id", "document", "doc_type", "sequence_number", "period_end", "fields_json", F.col("confidence").cast("decimal(5,4)").alias("confidence"), "validation_notes")


def latest_before(asked: DataFrame, facts: DataFrame, key: str, at: str, when: str, value: str) -> DataFrame:
    """As-of lookup: the value of the latest fact of the key on or before the asked day."""
    from pyspark.sql.window import Window

    both = asked.select(key, F.col(at).alias("_t"), F.lit(1).alias("_asks"), F.lit(None).cast(facts.schema[value].dataType).alias(value))
    both = both.unionByName(facts.select(key, F.col(when).alias("_t"), F.lit(0).alias("_asks"), value))
    by = Window.partitionBy(key).orderBy("_t", "_asks", value).rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn("_v", F.last(value, ignorenulls=True).over(by)).where("_asks = 1").select(key, F.col("_t").alias(at), F.col("_v").alias(value))


def information_table(rows: DataFrame) -> DataFrame:
    """Shares and value by filing and CUSIP, without options and debt; rows of several managers add up, issuer and class are
    those of the first line. Largest values first in each filing."""
    held = rows.where((F.col("kind") == "SH") & F.col("put_call").isNull())
    first = F.min_by(F.struct("issuer", "title_of_class"), F.struct("line", "issuer", "title_of_class")).alias("first")
    sums = held.groupBy("accession", "cusip").agg(first, F.sum("shares").cast("decimal(24,2)").alias("shares"), F.sum("value").cast("decimal(24,2)").alias("value"))
    return sums.select("accession", "cusip", "first.issuer", "first.title_of_class", "shares", "value").orderBy("accession", F.desc("value"), "cusip")


def of_tenant(rows: DataFrame, tenants: DataFrame, tenant: int) -> DataFrame:
    """Rows of the tenant's clients; tenants: client_id, tenant_id. An unknown tenant is an error."""
    return rows.join(checked_broadcast(clients_of(tenants, tenant)), "client_id", "left_semi")


def unclaimed(rows: DataFrame, tenants: DataFrame) -> DataFrame:
    """Clients of rows whom no tenant has."""
    return rows.select("client_id").distinct().join(checked_broadcast(tenants.select("client_id")), "client_id", "left_anti")


def freshness(rows: DataFrame, run_date: str, at_most: int = 3) -> DataFrame:
    latest = rows.agg(F.max("as_of").alias("latest"))
    age = F.datediff(F.lit(run_date).cast("date"), "latest")
    return latest.select("latest", age.cast("long").alias("age_days"), F.coalesce(age <= at_most, F.lit(True)).alias("passed"))
