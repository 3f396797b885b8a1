"""Files as tables: landing folders, filings, reference data, document records. Spark lists and reads them in parallel, and
a file's bytes are only read where a query needs its text or digest. What can't be read is a row with an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The wire format of a landed file by its suffix.
SUFFIXES = {".semt002.xml": "semt.002", ".mt535.txt": "MT535", ".camt053.xml": "camt.053"}
#: The type of a fund document by the beginning of its name.
PREFIXES = {"capital_call_": "capital_call", "distribution_": "distribution", "capital_account_": "capital_account_statement"}
#: Fixed value: rates before this day are not needed.
FIRST_RATE = "2024-01-01"
#: The bytes a PDF begins with.
PDF = b"%PDF"

_TABLE = "STRUCT<infoTable: ARRAY<STRUCT<nameOfIssuer: STRING, titleOfClass: STRING, cusip: STRING, value: STRING, shrsOrPrnAmt: STRUCT<sshPrnamt: STRING, sshPrnamtType: STRING>, putCall: STRING>>>"
_FILING = "cik long, filer string, accession string, filing_date date, period date"
_MASTER = "securities array<struct<isin: string, mapped: boolean, figi: string, name: string, security_type: string, market_sector: string, ticker: string, exchange_code: string>>"
_EXTRACTION = "document string, doc_type string, model string, prompt_version string, fields string, self_reported_confidence double, self_consistent boolean, confidence double"
_DECISION = "fund_id string, document string, doc_type string, sequence_number int, period_end string, status string, final_fields string, decided_at string"


def _by(mapping: dict[str, str], test) -> Column:
    found = F.lit(None).cast("string")
    for part, name in mapping.items():
        found = F.when(test(part), name).otherwise(found)
    return found


def found(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """(file_path, file_name, folder, size_bytes, sha256, content, text) of the files below root; text is null unless UTF-8."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)
    parts = F.split("path", "/")
    return read.select(
        F.col("path").alias("file_path"), F.element_at(parts, -1).alias("file_name"), F.element_at(parts, -2).alias("folder"), F.col("length").alias("size_bytes"),
        F.sha2("content", 256).alias("sha256"), "content", F.try_validate_utf8(F.col("content").cast("string")).alias("text"),
    )


def landing(spark: SparkSession, root: str) -> DataFrame:
    """Every file of the `date=YYYY-MM-DD` folders with its format; an unknown suffix or a text that isn't UTF-8 is a FAILED row."""
    files = found(spark, root, "*").where(F.col("folder").startswith("date="))
    kind = _by(SUFFIXES, lambda s: F.col("file_name").endswith(s))
    error = F.when(kind.isNull(), "unrecognised filename").when(F.col("text").isNull(), "not UTF-8 text")
    day = F.expr("try_to_date(substr(folder, 6))").alias("statement_date")
    return files.select("file_path", "file_name", kind.alias("format"), day, "size_bytes", "sha256", F.when(error.isNotNull(), "FAILED").otherwise("LANDED").alias("status"), error.alias("error"), "text")


def filings(spark: SparkSession, root: str) -> DataFrame:
    """Filings of the store `cik=N/accession=N/filing.json`, without those still being written (`.partial`)."""
    read = spark.read.schema(_FILING).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "filing.json").json(root)
    return read.where(~F.col("_metadata.file_path").contains(".partial/"))


def information_tables(spark: SparkSession, root: str) -> DataFrame:
    """One row for each line of the information tables beside the filings, whatever their namespace prefixes.

    A text that isn't an information table, or a line without CUSIP, stops the query: holdings must not go missing unseen.
    """
    files = found(spark, root, "*.xml").where(~F.col("file_path").contains(".partial/"))
    plain = F.regexp_replace("text", r"(</?)[A-Za-z_][\w.\-]*:", "$1")
    lines = F.from_xml(plain, F.lit(_TABLE))["infoTable"]
    lines = F.when(F.col("text").contains("infoTable") & lines.isNotNull(), lines).otherwise(F.raise_error(F.concat(F.lit("not an information table: "), F.col("file_path"))))
    number = lambda c: F.coalesce(F.trim(c).cast("decimal(24,2)"), F.lit(0).cast("decimal(24,2)"))
    rows = files.select("file_path", F.regexp_extract("folder", "accession=(.*)", 1).alias("accession"), F.posexplode(lines).alias("line", "i"))
    cusip = F.upper(F.trim("i.cusip"))
    return rows.select(
        "accession", F.when(F.coalesce(cusip, F.lit("")) != "", cusip).otherwise(F.raise_error(F.concat(F.lit("a line without cusip: "), F.col("file_path")))).alias("cusip"),
        F.trim("i.nameOfIssuer").alias("issuer"), F.trim("i.titleOfClass").alias("title_of_class"), number(F.col("i.shrsOrPrnAmt.sshPrnamt")).alias("shares"), number(F.col("i.value")).alias("value"),
        F.coalesce(F.trim("i.shrsOrPrnAmt.sshPrnamtType"), F.lit("SH")).alias("kind"), F.trim("i.putCall").alias("put_call"), "line",
    )


def master(spark: SparkSession, path: str) -> DataFrame:
    """The securities of a master file: one row for each ISIN."""
    return spark.read.schema(_MASTER).option("multiLine", True).option("mode", "FAILFAST").json(path).select(F.inline("securities"))


def rates_json(spark: SparkSession, path: str) -> DataFrame:
    """(day, rate) of a rates file."""
    read = spark.read.schema("rates map<string, string>").option("multiLine", True).option("mode", "FAILFAST").json(path)
    return read.select(F.explode("rates").alias("day", "rate")).select(F.to_date("day").alias("day"), F.col("rate").cast("decimal(12,6)").alias("rate"))


def rates_csv(spark: SparkSession, path: str, currency: str = "USD", first: str = FIRST_RATE) -> DataFrame:
    """(day, rate) of a history with one column for each currency; empty and N/A cells were not published."""
    read = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True).option("ignoreTrailingWhiteSpace", True).csv(path)
    told = F.nullif(F.nullif(F.col(currency), F.lit("N/A")), F.lit(""))
    return read.select(F.to_date("Date").alias("day"), told.cast("decimal(12,6)").alias("rate")).where(F.col("rate").isNotNull() & (F.col("day") >= F.lit(first).cast("date")))


def documents(spark: SparkSession, root: str) -> DataFrame:
    """Fund documents below `<fund>/`: type by the name's beginning (null: unknown), size and digest."""
    kind = _by(PREFIXES, lambda p: F.col("file_name").startswith(p))
    return found(spark, root, "*.pdf").select("file_path", "file_name", F.col("folder").alias("fund_id"), kind.alias("doc_type"), "size_bytes", "sha256", F.lit("LANDED").alias("status"))


def document_bodies(spark: SparkSession, root: str, wanted: DataFrame) -> DataFrame:
    """Bytes of the wanted (fund_id, document) files; what isn't a PDF stops the query."""
    files = found(spark, root, "*.pdf").select(F.col("folder").alias("fund_id"), F.col("file_name").alias("document"), "size_bytes", "sha256", "content")
    body = F.when(F.substring("content", 1, len(PDF)) == F.lit(PDF), F.col("content")).otherwise(F.raise_error(F.concat(F.lit("not a PDF: "), F.col("document"))))
    return files.join(wanted.select("fund_id", "document").distinct(), ["fund_id", "document"], "left_semi").withColumn("content", body)


def _records(spark: SparkSession, root: str, glob: str, schema: str, key: str) -> DataFrame:
    files = found(spark, root, glob).withColumn("r", F.from_json("text", schema))
    return files.withColumn("error", F.when(F.coalesce(F.col(f"r.{key}"), F.lit("")) == "", "not a record"))


def extractions(spark: SparkSession, root: str, glob: str = "*.extracted.json") -> DataFrame:
    """One extraction result for each file; its fields stay JSON text, as they differ by type."""
    rows = _records(spark, root, glob, _EXTRACTION, "document")
    kept = ("document", "doc_type", "model", "prompt_version", "self_reported_confidence", "self_consistent", "confidence")
    return rows.select("file_path", F.col("folder").alias("fund_id"), *(f"r.{c}" for c in kept), F.col("r.fields").alias("fields_json"), "sha256", "error")


def review_decisions(spark: SparkSession, root: str, glob: str = "*.decision.json") -> DataFrame:
    """One reviewer's decision for each file."""
    rows = _records(spark, root, glob, _DECISION, "document")
    kept = ("fund_id", "document", "doc_type", "sequence_number", "period_end", "status")
    return rows.select("file_path", *(f"r.{c}" for c in kept), F.col("r.final_fields").alias("final_fields_json"), F.expr("try_cast(r.decided_at AS TIMESTAMP)").alias("decided_at"), "sha256", "error")


def undecided_synced(spark: SparkSession, url: str, table: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Decided rows of a review queue that are still to be synced; the database does the filtering."""
    return spark.read.jdbc(url, table, properties=properties or {}).where("status <> 'pending' AND synced_at IS NULL")
