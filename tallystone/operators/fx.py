"""Exchange rates: one row for each calendar day, carried forward from the last publication."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def fill_forward(published: DataFrame, days: DataFrame) -> DataFrame:
    """(as_of, rate, rate_date). days: day. Rates of before the first day seed it; a day with none before it is an error.

    The calendar is a few thousand rows, so the unpartitioned window is bounded by it and not by the data.
    """
    first = days.agg(F.min("day").alias("first"))
    seed = published.join(F.broadcast(first)).where("day < first").agg(F.max_by(F.struct("rate", "day"), "day").alias("seed"))
    known = days.join(F.broadcast(published.withColumnRenamed("day", "rate_date")), F.col("day") == F.col("rate_date"), "left")
    upto = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    last = F.last(F.when(F.col("rate").isNotNull(), F.struct("rate", F.col("rate_date").alias("day"))), ignorenulls=True).over(upto)
    filled = known.withColumn("last", last).join(F.broadcast(seed)).select(F.col("day").alias("as_of"), F.coalesce("last", "seed").alias("last"))
    checked = F.when(F.col("last").isNull(), F.raise_error(F.lit("no rate on or before the first day")).cast("decimal(12,6)")).otherwise(F.col("last.rate"))
    return filled.select("as_of", checked.alias("rate"), F.col("last.day").alias("rate_date"))
