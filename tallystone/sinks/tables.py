"""Tables as targets: typed creation, appends, rebuilds, restatements, comments, tenant reloads, decision files."""

from __future__ import annotations

import contextlib
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A schema's name can't be a parameter of a statement, so its shape is checked.
SAFE_TENANT = re.compile(r"[a-z][a-z0-9_]*")
#: What a serving table may hold; another type stops the export.
SERVED = (T.StringType, T.BooleanType, T.IntegerType, T.LongType, T.DoubleType, T.DecimalType, T.DateType, T.TimestampType)


def ensure(spark: SparkSession, name: str, columns: str, comment: str, by: str | None = None) -> None:
    """Create the table unless it is there; columns is DDL, `by` a column to partition by."""
    placed = f" PARTITIONED BY ({by})" if by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{placed} COMMENT '{_quoted(comment)}'")


def append(rows: DataFrame, name: str) -> None:
    """Rows by name, in the types of the target; a column that the target lacks or misses stops it."""
    target = rows.sparkSession.table(name).schema
    if set(target.names) != set(rows.columns):
        raise ValueError(f"{name} has {sorted(target.names)}, the rows {sorted(rows.columns)}")
    rows.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in target.fields)).write.insertInto(name)


def land(rows: dict[str, DataFrame], registry: str, files: DataFrame) -> None:
    """Append the rows of each table and the registry last, so that a run that dies is done again from the files."""
    for name, part in rows.items():
        append(part, name)
    append(files, registry)


def rebuild(rows: DataFrame, name: str, comment: str | None = None) -> None:
    """Replace the whole table; no rows give an empty table with these columns."""
    rows.write.mode("overwrite").saveAsTable(name)
    if comment:
        rows.sparkSession.sql(f"COMMENT ON TABLE {name} IS '{_quoted(comment)}'")


@contextlib.contextmanager
def _only_touched(spark: SparkSession) -> Iterator[None]:
    """An overwrite replaces the partitions it writes to and no others."""
    mode = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(mode)
    spark.conf.set(mode, "dynamic")
    try:
        yield
    finally:
        spark.conf.set(mode, before)


def supersede(spark: SparkSession, name: str, arrived: DataFrame, by: str = "statement_date") -> None:
    """Take the rows of files that arrive again out of a table that is partitioned by day.

    Only days that hold such files are read and rewritten; a day of which nothing is left is dropped. The days are a
    calendar: they don't grow with the rows.
    """
    held = spark.table(name)
    again = arrived.select("file_path").distinct()
    days = [r[0] for r in held.join(again, "file_path", "left_semi").select(by).distinct().collect()]
    if not days:
        return
    kept = held.where(F.col(by).isin(days)).join(again, "file_path", "left_anti").select(*held.columns)
    left = {r[0] for r in kept.select(by).distinct().collect()}
    if left:
        with _only_touched(spark):  # written beside the old files, moved in at the end
            kept.write.insertInto(name, overwrite=True)
    for day in days:
        if day not in left:
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({by} = '{day}')")


def comment_columns(spark: SparkSession, name: str, comments: dict[str, str]) -> int:
    """Set the comments of columns that have another one; how many were set."""
    now = {f.name: f.metadata.get("comment") for f in spark.table(name).schema.fields}
    changed = [c for c, text in comments.items() if now[c] != text]
    for c in changed:
        spark.sql(f"ALTER TABLE {name} ALTER COLUMN `{c}` COMMENT '{_quoted(comments[c])}'")
    return len(changed)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def schema_of(tenant: str) -> str:
    if not SAFE_TENANT.fullmatch(tenant):
        raise ValueError(f"not a tenant id: {tenant!r}")
    return f"tenant_{tenant}"


def claimed_once(tenants: DataFrame) -> DataFrame:
    """(client_id, tenant_id), where a client of two tenants stops the query."""
    one = tenants.groupBy("client_id").agg(F.min("tenant_id").alias("low"), F.max("tenant_id").alias("high"))
    return one.select("client_id", F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(F.raise_error(F.concat(F.lit("client of two tenants: "), F.col("client_id").cast("string")))).alias("tenant_id"))


def servable(rows: DataFrame) -> DataFrame:
    """The rows, if all their types can be served."""
    if strange := [f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields if not isinstance(f.dataType, SERVED)]:
        raise TypeError(f"no serving type for {', '.join(strange)}")
    return rows


def reload(rows: DataFrame, url: str, table: str, properties: dict[str, str] | None = None, connections: int = 8) -> None:
    """Truncate a serving table and load it by column names, over a bounded number of connections."""
    servable(rows).coalesce(connections).write.option("truncate", True).mode("overwrite").jdbc(url, table, properties=properties or {})


def mirrored(held: DataFrame, index: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(documents to fetch, held rows that stay): a document is fetched when its digest is not the one held."""
    key = ["fund_id", "document"]
    fetch = index.join(held.select(*key, "sha256"), [*key, "sha256"], "left_anti")
    return fetch, held.join(fetch.select(*key), key, "left_anti")


def write_decisions(decisions: DataFrame, path: str) -> None:
    """One file for each decision, below a folder for each fund; `final_fields` is JSON text and stays an object."""
    flat = ("fund_id", "document", "doc_type", "sequence_number", "period_end", "status", "decided_at")
    rest = F.to_json(F.struct(*(F.col(c).cast("string" if c in ("period_end", "decided_at") else decisions.schema[c].dataType).alias(c) for c in flat)))
    text = F.concat(F.regexp_replace(rest, r"\}$", ""), F.lit(',"final_fields":'), F.coalesce("final_fields", F.lit("null")), F.lit("}"))
    decisions.select(F.col("fund_id").alias("fund"), text.alias("value")).write.mode("append").option("maxRecordsPerFile", 1).partitionBy("fund").text(path)


def marked_synced(queue: DataFrame, landed: DataFrame) -> DataFrame:
    """The queue with synced_at set for what has landed."""
    done = landed.select("fund_id", "document").distinct().withColumn("_done", F.lit(True))
    at = F.when(F.col("_done") & F.col("synced_at").isNull(), F.current_timestamp()).otherwise(F.col("synced_at"))
    return queue.join(done, ["fund_id", "document"], "left").withColumn("synced_at", at).select(*queue.columns)


def write_rates(rates: DataFrame, path: str, provider: str, base: str = "EUR", quote: str = "USD") -> None:
    """A rates file with where it comes from: (day, rate) as published, one a day, which a single row holds."""
    days = F.sort_array(F.collect_list(F.struct(F.col("day").cast("string").alias("key"), F.col("rate").cast("string").alias("value"))))
    source = F.struct(F.lit(provider).alias("provider"), F.lit(base).alias("base"), F.lit(quote).alias("quote"), F.min("day").cast("string").alias("first"), F.max("day").cast("string").alias("last"), F.count("*").alias("days"))
    rates.agg(F.to_json(F.struct(source.alias("source"), F.map_from_entries(days).alias("rates"))).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def write_manifest(manifest: DataFrame, path: str, landing: str) -> None:
    """What was put into the feeds, as JSON lines by day, never below the folder that is ingested."""
    if f"{path.rstrip('/')}/".startswith(f"{landing.rstrip('/')}/"):
        raise ValueError(f"{path} is below the landing folder {landing}")
    manifest.write.mode("overwrite").partitionBy("as_of").json(path)


def write_master(entries: DataFrame, path: str, provider: str) -> None:
    """A securities master as one JSON file with where it comes from: entries in the order of their ISINs. A row an ISIN of
    the universe, which a single row holds."""
    rows = F.array_sort(F.collect_list(F.struct("isin", *(c for c in entries.columns if c != "isin"))))
    source = F.struct(F.lit(provider).alias("provider"), F.count("*").alias("entries"), F.count_if("mapped").alias("mapped"))
    entries.agg(F.to_json(F.struct(source.alias("source"), rows.alias("entries")), {"ignoreNullFields": "false"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def typed(spark: SparkSession, name: str, kinds: str) -> DataFrame:
    """A table's columns in the order and of the types that a reader expects (DDL); another type, or a column that is missing,
    stops the query rather than being read as something else."""
    wanted = T.StructType.fromDDL(kinds)
    held = {f.name: f.dataType for f in spark.table(name).schema.fields}
    if wrong := [f"{f.name} is {held[f.name].simpleString() if f.name in held else 'missing'}, not {f.dataType.simpleString()}" for f in wanted.fields if held.get(f.name) != f.dataType]:
        raise TypeError(f"{name}: {'; '.join(wrong)}")
    return servable(spark.table(name).select(*wanted.names))


def reload_all(rows: dict[str, DataFrame], url: str, properties: dict[str, str] | None = None, connections: int = 8) -> None:
    """Truncate serving tables and load them by column names, all in one transaction: rows go to tables beside them first, then
    one connection replaces the contents, so that readers see all of the old state or all of the new."""
    beside = {name: f"{name}_staged" for name in rows}
    for name, part in rows.items():
        servable(part).coalesce(connections).write.mode("overwrite").jdbc(url, beside[name], properties=properties or {})
    spark = next(iter(rows.values())).sparkSession
    connection = spark.sparkContext._jvm.java.sql.DriverManager.getConnection(url)
    try:
        connection.setAutoCommit(False)
        statement = connection.createStatement()
        for name, part in rows.items():
            columns = ", ".join(f'"{c}"' for c in part.columns)
            statement.executeUpdate(f"DELETE FROM {name}")
            statement.executeUpdate(f"INSERT INTO {name} ({columns}) SELECT {columns} FROM {beside[name]}")
        connection.commit()
        for name in beside.values():
            statement.executeUpdate(f"DROP TABLE {name}")
        connection.commit()
    except Exception:
        connection.rollback()
        raise
    finally:
        connection.close()
