"""Arriving files as a stream: each micro-batch supersedes what it brings again, and replays give the same table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.operators.registry import superseded


def newest(batch: DataFrame, order: str) -> DataFrame:
    """One row for each file_path: the newest, and of several as new the one with the greatest digest."""
    rest = [c for c in batch.columns if c != "file_path"]
    return batch.groupBy("file_path").agg(F.max(F.struct(F.col(order).alias("_at"), F.col("sha256").alias("_sha"), *rest)).alias("x")).select("file_path", *(F.col(f"x.{c}").alias(c) for c in rest)).select(*batch.columns)


def ingest(spark: SparkSession, source: str, schema, target: str, checkpoint: str, by: str = "statement_date", order: str = "landed_at") -> None:
    """Read what has arrived at `source` (Parquet) and stop. The target is partitioned by a file's day, which is part of its
    path; a micro-batch reads and writes only the days that it brings. New partitions are written beside the old ones and
    moved in at the end, so a batch that is run again finds what it found before or its own rows, and writes the same."""

    def take(batch: DataFrame, number: int) -> None:
        arrived = newest(batch, order)
        days = [r[0] for r in arrived.select(by).distinct().collect()]  # a calendar: it doesn't grow with the rows
        out = arrived
        if _there(spark, target):
            out = superseded(spark.read.schema(batch.schema).parquet(target).where(F.col(by).isin(days)).select(*batch.columns), arrived)
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(by).parquet(target)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _there(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)
