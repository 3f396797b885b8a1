"""The wealth model on the star-schema test tables: the same relations for Spark and for the checking SQL.

Integer rules alone decide what is perturbed, so both engines see the same rows. Some relations are stated twice, as SQL
for the check and as DataFrames for Spark.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events", "documents")
SPARK = {
    "spine": "SELECT explode(sequence(DATE '1995-01-01', DATE '2001-12-31')) AS day",
    "diff": lambda a, b: f"datediff({a}, {b})",
    "add": lambda d, n: f"date_add({d}, {n})",
    "weekday": lambda d: f"weekday({d})",
    "bytes": "octet_length(text)",
    "sha": "sha2(text, 256)",
}
DUCK = {
    "spine": "SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31', INTERVAL 1 DAY)) AS DATE) AS day",
    "diff": lambda a, b: f"date_diff('day', {b}, {a})",
    "add": lambda d, n: f"CAST({d} + CAST({n} AS INTEGER) AS DATE)",
    "weekday": lambda d: f"(isodow({d}) - 1)",
    "bytes": "octet_length(encode(text))",
    "sha": "sha256(text)",
}


def relations(q: dict) -> dict[str, str]:
    """Name -> SELECT, each using those above it."""
    return {
        "days": q["spine"],
        "fx_published": f"SELECT day, CAST(CAST(1050 + {q['diff']('day', "DATE '1995-01-01'")} % 50 AS DOUBLE) / 1000 AS DECIMAL(12,6)) AS rate FROM days WHERE {q['weekday']('day')} < 5 UNION ALL SELECT DATE '1994-12-30', CAST(1.049 AS DECIMAL(12,6))",
        "accounts": "SELECT c_custkey AS account_id, CASE WHEN c_custkey % 5 = 1 THEN 'EUR' ELSE 'USD' END AS currency, c_nationkey AS nation FROM customer",
        "clients": "SELECT n_nationkey AS client_id, n_name AS client_name, n_regionkey AS tenant_id FROM nation",
        "edges": """
            SELECT concat('C', n_nationkey) AS owner_id, concat('E', n_nationkey) AS owned_id, CAST(CASE WHEN n_nationkey % 3 = 0 THEN 0.7 ELSE 1 END AS DECIMAL(9,6)) AS pct FROM nation
            UNION ALL SELECT concat('C', (n_nationkey + 2) % 25), concat('E', n_nationkey), CAST(0.3 AS DECIMAL(9,6)) FROM nation WHERE n_nationkey % 3 = 0
            UNION ALL SELECT concat('E', c_nationkey), concat('A', c_custkey), CAST(CASE WHEN c_custkey % 4 = 0 THEN 0.6 ELSE 1 END AS DECIMAL(9,6)) FROM customer
            UNION ALL SELECT concat('E', (c_nationkey + 1) % 25), concat('A', c_custkey), CAST(0.4 AS DECIMAL(9,6)) FROM customer WHERE c_custkey % 4 = 0""",
        "owners": """
            SELECT a.account_id, c.client_id, c.client_name, CAST(CASE WHEN a.account_id % 4 = 0 THEN 0.6 ELSE 1 END AS DECIMAL(9,6)) AS ownership_pct FROM accounts a JOIN clients c ON c.client_id = a.nation
            UNION ALL SELECT a.account_id, c.client_id, c.client_name, CAST(0.4 AS DECIMAL(9,6)) FROM accounts a JOIN clients c ON c.client_id = (a.nation + 1) % 25 WHERE a.account_id % 4 = 0""",
        "base_holdings": """
            SELECT CAST(o.o_orderdate AS DATE) AS as_of, o.o_custkey AS account_id, l.l_partkey AS part, CAST(SUM(CAST(l.l_quantity AS DECIMAL(18,6))) AS DECIMAL(24,6)) AS quantity, CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(24,2)) AS market_value
            FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey GROUP BY CAST(o.o_orderdate AS DATE), o.o_custkey, l.l_partkey""",
        "feed_a": """
            SELECT as_of, account_id, CASE WHEN part % 67 = 0 THEN 'CUSIP' ELSE 'ISIN' END AS security_scheme, CASE WHEN part % 67 = 0 THEN concat('C', lpad(CAST(part AS STRING), 8, '0')) ELSE concat('XS', lpad(CAST(part AS STRING), 9, '0'), part % 10) END AS security_id,
                concat('Part ', part) AS security_name, quantity, CAST(part % 1000 AS DECIMAL(24,6)) AS price_amount, as_of AS price_as_of, market_value, CAST(NULL AS DECIMAL(24,2)) AS cost_basis, 'semt.002' AS source_format, concat('semt/', account_id, '/', as_of) AS file_path
            FROM base_holdings WHERE (part + account_id) % 37 <> 0""",
        "feed_b": f"""
            SELECT as_of, account_id, 'ISIN' AS security_scheme, concat('XS', lpad(CAST(CASE WHEN part % 53 = 0 THEN part + 1000000 ELSE part END AS STRING), 9, '0'), part % 10) AS security_id,
                concat(CASE WHEN part % 59 = 0 THEN 'PART ' ELSE 'Part ' END, part) AS security_name, CASE WHEN part % 43 = 0 THEN CAST(quantity + 1 AS DECIMAL(24,6)) ELSE quantity END AS quantity, CAST(part % 1000 + CASE WHEN part % 61 = 0 THEN 0.25 ELSE 0 END AS DECIMAL(24,6)) AS price_amount,
                CASE WHEN part % 47 = 0 THEN {q['add']('as_of', '-5')} ELSE as_of END AS price_as_of, market_value, CASE WHEN part % 5 = 0 THEN CAST(NULL AS DECIMAL(24,2)) ELSE market_value END AS cost_basis, 'MT535' AS source_format, concat('mt535/', account_id, '/', as_of) AS file_path
            FROM base_holdings WHERE (part + account_id) % 41 <> 0""",
        "holdings": """
            SELECT * FROM feed_a WHERE account_id % 6 <> 2 UNION ALL SELECT * FROM feed_b
            UNION ALL SELECT * REPLACE (concat(file_path, '-again') AS file_path) FROM feed_b WHERE account_id % 6 = 2""",
        "master": "SELECT concat('XS', lpad(CAST(p_partkey AS STRING), 9, '0'), p_partkey % 10) AS security_id, p_partkey % 7 <> 0 AS mapped, CASE WHEN p_partkey % 7 <> 0 THEN p_name END AS name, CASE WHEN p_partkey % 7 <> 0 THEN p_brand END AS ticker, CASE WHEN p_partkey % 7 <> 0 THEN split_part(p_type, ' ', 1) END AS asset_class FROM part WHERE p_partkey % 13 <> 0",
        "clean_entries": f"""
            SELECT CAST(o_orderdate AS DATE) AS as_of, o_custkey AS account_id, concat('T', o_orderkey) AS transaction_id, o_orderkey AS k,
                CASE o_orderkey % 7 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' WHEN 2 THEN 'DIVIDEND' WHEN 3 THEN 'INTEREST' WHEN 4 THEN 'FEE' WHEN 5 THEN 'TRANSFER_IN' ELSE 'TRANSFER_OUT' END AS type,
                CAST(o_orderdate AS DATE) AS trade_date, {q['add']('CAST(o_orderdate AS DATE)', '2')} AS settlement_date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(24,2)) AS amount, CASE WHEN o_custkey % 5 = 1 THEN 'EUR' ELSE 'USD' END AS currency, o_orderpriority AS description
            FROM orders""",
        "entries": f"""
            SELECT as_of, account_id, transaction_id, type, trade_date, settlement_date, amount, currency, description, concat('camt/', as_of) AS file_path FROM clean_entries WHERE k % 23 <> 0
            UNION ALL SELECT as_of, account_id, transaction_id, type, trade_date, CASE WHEN k % 38 = 0 THEN {q['add']('settlement_date', '1')} ELSE settlement_date END, amount, currency, description, concat('camt/', as_of, '-again') FROM clean_entries WHERE k % 19 = 0 AND k % 23 <> 0""",
        "deliveries": """
            SELECT DISTINCT as_of AS statement_date, file_path, source_format, CASE WHEN account_id % 19 = 5 AND source_format = 'MT535' THEN 'FAILED' ELSE 'PARSED' END AS status FROM holdings
            UNION ALL SELECT DISTINCT as_of, file_path, 'camt.053', 'PARSED' FROM entries UNION ALL SELECT DATE '2001-12-29', 'camt/late', 'camt.053', 'PARSED'""",
        "net": "SELECT as_of, account_id, currency, SUM(CASE WHEN type IN ('BUY', 'FEE', 'TRANSFER_OUT') THEN -amount ELSE amount END) AS net FROM clean_entries GROUP BY as_of, account_id, currency",
        "ledger": "SELECT as_of, account_id, currency, CAST(net AS DECIMAL(24,2)) AS net, CAST(SUM(net) OVER (PARTITION BY account_id ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) + 1000000 AS DECIMAL(24,2)) AS closing FROM net",
        "balances": """
            SELECT as_of, account_id, 'OPENING' AS balance_type, CAST(closing - net + CASE WHEN account_id % 31 = 3 THEN 1 ELSE 0 END AS DECIMAL(24,2)) AS amount, currency FROM ledger
            UNION ALL SELECT as_of, account_id, 'CLOSING', closing, currency FROM ledger""",
        "fund_rows": """
            SELECT o_custkey AS fund_id, concat('D', o_orderkey) AS document, o_orderkey AS k, CASE o_orderkey % 3 WHEN 0 THEN 'capital_call' WHEN 1 THEN 'distribution' ELSE 'capital_account_statement' END AS doc_type,
                CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey, o_orderkey % 3 ORDER BY o_orderdate, o_orderkey) AS INT) AS seq, CAST(o_orderdate AS DATE) AS doc_date, CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DECIMAL(24,2)) AS amount,
                CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) OVER (PARTITION BY o_custkey, o_orderkey % 3 ORDER BY o_orderdate, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS DECIMAL(24,2)) AS total
            FROM orders""",
        "fund_parts": """
            SELECT *, CASE WHEN doc_type = 'capital_account_statement' THEN CAST(amount + (k % 6) * 7 + (k % 5) * 10 - (k % 4) * 3 + (k % 3) * 2 AS DECIMAL(24,2)) END AS contributions,
                CASE WHEN doc_type = 'capital_account_statement' THEN CAST((k % 6) * 7 AS DECIMAL(24,2)) END AS distributions, CASE WHEN doc_type = 'capital_account_statement' THEN CAST((k % 5) * 10 AS DECIMAL(24,2)) END AS management_fees,
                CASE WHEN doc_type = 'capital_account_statement' THEN CAST((k % 4) * 3 AS DECIMAL(24,2)) END AS realized, CASE WHEN doc_type = 'capital_account_statement' THEN CAST((k % 3) * -2 AS DECIMAL(24,2)) END AS unrealized,
                CASE WHEN doc_type = 'capital_call' THEN CAST(100000000 - total AS DECIMAL(24,2)) END AS remaining_commitment, CASE WHEN doc_type = 'capital_account_statement' THEN CAST(100000000 AS DECIMAL(24,2)) END AS total_commitment,
                CASE WHEN doc_type = 'capital_account_statement' THEN CAST(100000000 - total AS DECIMAL(24,2)) END AS unfunded_commitment
            FROM fund_rows""",
        "fund_docs": """
            SELECT fund_id, document, k, doc_type, CASE WHEN k % 31 = 0 THEN seq + 1 ELSE seq END AS sequence_number, doc_date, CASE WHEN k % 37 = 0 THEN NULL ELSE amount END AS amount, CASE WHEN k % 29 = 0 THEN CAST(total + 1000 AS DECIMAL(24,2)) ELSE total END AS cumulative,
                CAST(total - amount AS DECIMAL(24,2)) AS beginning, CASE WHEN k % 41 = 0 THEN CAST(total + 500 AS DECIMAL(24,2)) ELSE total END AS ending, CAST(1 - CAST(k % 10 AS DOUBLE) / 20 AS DOUBLE) AS self_reported,
                CASE WHEN k % 37 = 0 THEN NULL ELSE contributions END AS contributions, distributions, management_fees, realized, unrealized, remaining_commitment, total_commitment, unfunded_commitment
            FROM fund_parts""",
        "registry_old": f"SELECT doc_id AS file_path, {q['sha']} AS sha256, CAST({q['bytes']} AS BIGINT) AS size_bytes FROM documents WHERE doc_id % 17 <> 0",
        "registry_new": f"SELECT doc_id AS file_path, CASE WHEN doc_id % 11 = 0 THEN concat({q['sha']}, '-2') ELSE {q['sha']} END AS sha256, CAST({q['bytes']} AS BIGINT) AS size_bytes FROM documents",
        "filings": "SELECT o_custkey AS cik, o_orderkey AS accession, CAST(o_orderdate AS DATE) AS filing_date FROM orders",
        "filing_rows": "SELECT l_orderkey AS accession, concat(CASE WHEN l_partkey % 9 = 0 THEN 'G' ELSE '0' END, lpad(CAST(l_partkey AS STRING), 8, '0')) AS cusip, concat('Issuer ', l_partkey, '-', l_linenumber) AS issuer, CASE WHEN l_linenumber % 2 = 0 THEN 'COM' ELSE 'CL A' END AS title_of_class, l_linenumber AS line, CAST(l_quantity AS DECIMAL(18,2)) AS shares, CAST(l_extendedprice AS DECIMAL(18,2)) AS value, CASE WHEN l_linenumber = 3 THEN 'PRN' ELSE 'SH' END AS kind, CASE WHEN l_partkey % 10 = 1 THEN 'Put' END AS put_call FROM lineitem",
        "domiciles": "SELECT DISTINCT cusip, 'CA' AS country FROM filing_rows WHERE CAST(substr(cusip, 2, 8) AS INT) % 23 = 0",
        "commitments": "SELECT c_custkey AS fund_id, CAST(1000000 + c_custkey * CAST(12345.67 AS DECIMAL(9,2)) AS DECIMAL(24,2)) AS total_commitment, CAST(1995 + c_custkey % 5 AS INT) AS vintage_year FROM customer",
        "decisions": "SELECT fund_id, document, CASE WHEN k % 2 = 0 THEN 'approved' ELSE 'corrected' END AS status, CASE WHEN k % 2 = 0 THEN amount ELSE CAST(amount + 1 AS DECIMAL(24,2)) END AS final_amount FROM fund_docs WHERE k % 5 = 0",
    }


def with_clause(q: dict, used: str) -> str:
    """WITH for those relations that the text needs."""
    every = relations(q)
    need, todo = set(), [used]
    while todo:
        text = todo.pop()
        for name, body in every.items():
            if name not in need and re.search(rf"\b{name}\b", text):
                need.add(name)
                todo.append(body)
    return ", ".join(f"{n} AS ({b})" for n, b in every.items() if n in need)


# The feeds, the ledger and the register of files for Spark are made by DataFrame functions, and for the checking SQL by the
# texts above: what either makes checks the other.

FEED = ("as_of", "account_id", "security_scheme", "security_id", "security_name", "quantity", "price_amount", "price_as_of", "market_value", "cost_basis", "source_format", "file_path")


def _base_holdings(m: Model) -> DataFrame:
    lines = m.table("lineitem").select("l_orderkey", F.col("l_partkey").alias("part"), F.col("l_quantity").cast("decimal(18,6)").alias("quantity"), F.col("l_extendedprice").cast("decimal(18,2)").alias("value"))
    orders = m.table("orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("as_of"), F.col("o_custkey").alias("account_id"))
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).groupBy("as_of", "account_id", "part").agg(F.sum("quantity").cast("decimal(24,6)").alias("quantity"), F.sum("value").cast("decimal(24,2)").alias("market_value"))


def _copies(m: Model) -> DataFrame:
    """All rows of both feeds, and the second delivery of some files: one pass over the lines, exploded into its copies."""
    part, account = F.col("part"), F.col("account_id")
    isin = lambda n: F.concat(F.lit("XS"), F.lpad(n.cast("string"), 9, "0"), (part % 10).cast("string"))
    cusip = part % 67 == 0
    path = lambda kind, end="": F.concat(F.lit(kind), account.cast("string"), F.lit("/"), F.col("as_of").cast("string"), F.lit(end))
    price = (part % 1000).cast("decimal(24,6)")
    a = F.struct(
        F.lit("a").alias("copy"), F.when(cusip, "CUSIP").otherwise("ISIN").alias("security_scheme"), F.when(cusip, F.concat(F.lit("C"), F.lpad(part.cast("string"), 8, "0"))).otherwise(isin(part)).alias("security_id"), F.concat(F.lit("Part "), part.cast("string")).alias("security_name"),
        F.col("quantity").alias("quantity"), price.alias("price_amount"), F.col("as_of").alias("price_as_of"), F.lit(None).cast("decimal(24,2)").alias("cost_basis"), F.lit("semt.002").alias("source_format"), path("semt/").alias("file_path"),
    )
    of_b = lambda copy, end: F.struct(
        F.lit(copy).alias("copy"), F.lit("ISIN").alias("security_scheme"), isin(F.when(part % 53 == 0, part + 1000000).otherwise(part)).alias("security_id"), F.concat(F.when(part % 59 == 0, "PART ").otherwise("Part "), part.cast("string")).alias("security_name"),
        F.when(part % 43 == 0, F.col("quantity") + 1).otherwise(F.col("quantity")).cast("decimal(24,6)").alias("quantity"), F.when(part % 61 == 0, price + F.lit(0.25).cast("decimal(24,6)")).otherwise(price).cast("decimal(24,6)").alias("price_amount"),
        F.when(part % 47 == 0, F.date_sub("as_of", 5)).otherwise(F.col("as_of")).alias("price_as_of"), F.when(part % 5 != 0, F.col("market_value")).alias("cost_basis"), F.lit("MT535").alias("source_format"), path("mt535/", end).alias("file_path"),
    )
    in_b = (part + account) % 41 != 0
    made = F.array(F.when((part + account) % 37 != 0, a), F.when(in_b, of_b("b", "")), F.when(in_b & (account % 6 == 2), of_b("again", "-again")))
    rows = _base_holdings(m).select("as_of", "account_id", "market_value", F.explode(F.filter(made, lambda x: x.isNotNull())).alias("x"))
    return rows.select("as_of", "account_id", "market_value", "x.*")


def _holdings(m: Model) -> DataFrame:
    return _copies(m).where((F.col("copy") != "a") | (F.col("account_id") % 6 != 2)).select(*FEED)


def _balances(m: Model) -> DataFrame:
    out = F.col("o_orderkey") % 7
    paid = F.col("o_totalprice").cast("decimal(18,2)").cast("decimal(24,2)")
    moved = F.when(out.isin(0, 4, 6), -paid).otherwise(paid)
    day = m.table("orders").groupBy(F.col("o_orderdate").cast("date").alias("as_of"), F.col("o_custkey").alias("account_id")).agg(F.sum(moved).alias("net"))
    upto = Window.partitionBy("account_id").orderBy("as_of").rowsBetween(Window.unboundedPreceding, 0)
    closing = (F.sum("net").over(upto) + 1000000).cast("decimal(24,2)")
    ledger = day.withColumn("closing", closing).withColumn("net", F.col("net").cast("decimal(24,2)"))
    wrong = F.when(F.col("account_id") % 31 == 3, 1).otherwise(0)
    sides = F.array(F.struct(F.lit("OPENING").alias("balance_type"), (F.col("closing") - F.col("net") + wrong).cast("decimal(24,2)").alias("amount")), F.struct(F.lit("CLOSING").alias("balance_type"), F.col("closing").alias("amount")))
    currency = F.when(F.col("account_id") % 5 == 1, "EUR").otherwise("USD").alias("currency")
    return ledger.select("as_of", "account_id", currency, F.explode(sides).alias("b")).select("as_of", "account_id", "b.balance_type", "b.amount", "currency")


def _entries(m: Model) -> DataFrame:
    """Entries without the dropped ones, some of them twice and some of those with another settlement day."""
    rows = m["clean_entries"].where(F.col("k") % 23 != 0)
    again = F.col("k") % 19 == 0
    later = F.when(F.col("k") % 38 == 0, F.date_add("settlement_date", 1)).otherwise(F.col("settlement_date"))
    path = F.concat(F.lit("camt/"), F.col("as_of").cast("string"))
    one = F.struct(F.col("settlement_date").alias("settlement_date"), path.alias("file_path"))
    two = F.struct(later.alias("settlement_date"), F.concat(path, F.lit("-again")).alias("file_path"))
    return rows.select("as_of", "account_id", "transaction_id", "type", "trade_date", "amount", "currency", "description", F.explode(F.when(again, F.array(one, two)).otherwise(F.array(one))).alias("x")).select("as_of", "account_id", "transaction_id", "type", "trade_date", "x.settlement_date", "amount", "currency", "description", "x.file_path")


def _deliveries(m: Model) -> DataFrame:
    failed = (F.col("account_id") % 19 == 5) & (F.col("source_format") == "MT535")
    held = _holdings(m).select(F.col("as_of").alias("statement_date"), "file_path", "source_format", F.when(failed, "FAILED").otherwise("PARSED").alias("status")).distinct()
    cash = _entries(m).select(F.col("as_of").alias("statement_date"), "file_path", F.lit("camt.053").alias("source_format"), F.lit("PARSED").alias("status")).distinct()
    late = m.spark.sql("SELECT DATE '2001-12-29' AS statement_date, 'camt/late' AS file_path, 'camt.053' AS source_format, 'PARSED' AS status")
    return held.unionByName(cash).unionByName(late)


FRAMES: dict[str, Callable[[Model], DataFrame]] = {
    "base_holdings": _base_holdings,
    "feed_a": lambda m: _copies(m).where("copy = 'a'").select(*FEED),
    "feed_b": lambda m: _copies(m).where("copy = 'b'").select(*FEED),
    "feeds": lambda m: _copies(m).where("copy <> 'again'").select("copy", *FEED),
    "holdings": _holdings,
    "balances": _balances,
    "entries": _entries,
    "deliveries": _deliveries,
}


class Model:
    """The relations as lazy DataFrames over one folder of tables."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def __getitem__(self, name: str) -> DataFrame:
        if name in FRAMES:
            return FRAMES[name](self)
        body = f"SELECT * FROM {name}"
        text = f"WITH {with_clause(SPARK, body)} {body}"
        used = {t: self.table(t) for t in TABLES if re.search(rf"(FROM|JOIN)\s+{t}\b", text)}
        for t in used:
            text = re.sub(rf"(FROM|JOIN)\s+{t}\b", rf"\1 {{{t}}}", text)
        return self.spark.sql(text, **used)
