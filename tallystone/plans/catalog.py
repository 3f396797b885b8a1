"""The registry: each query in DataFrame operators, and the SQL that checks it.

Both sides begin at the same relations (tallystone.sources.model); SQL says what a query means, without its operators.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystone.functions import identifiers, labels
from tallystone.functions.money import quantized, signed, tolerant_decimal
from tallystone.operators import book, conform, defects, documents, fund_book, fx, master, ownership, quality, registry, serving, wealth
from tallystone.sources import feeds
from tallystone.sources.model import DUCK, Model, with_clause

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}
#: Fixed value: the day on which the fixture is looked at.
RUN_DATE = "2001-12-31"


def query(sql: str | None = None):
    def add(f: Callable[[Model], DataFrame]):
        _QUERIES[f.__name__] = lambda spark, sf_dir: f(Model(spark, sf_dir))
        if sql:
            _SQL[f.__name__] = sql
        return f

    return add


# SQL pieces that several checks share; each is a named relation
PIECES = {
    "fx": "SELECT d.day AS as_of, p.rate, p.day AS rate_date FROM days d ASOF JOIN fx_published p ON p.day <= d.day",
    "delivery": "SELECT h.* FROM holdings h JOIN (SELECT as_of, account_id, min(CASE source_format WHEN 'semt.002' THEN 1 ELSE 2 END) AS best FROM holdings GROUP BY as_of, account_id) USING (as_of, account_id) WHERE (CASE source_format WHEN 'semt.002' THEN 1 ELSE 2 END) = best",
    "dedup": "SELECT * EXCLUDE (n) FROM (SELECT *, row_number() OVER (PARTITION BY as_of, account_id, security_scheme, security_id ORDER BY file_path) AS n FROM delivery) WHERE n = 1",
    "positions": "SELECT d.as_of, d.account_id, d.security_scheme, d.security_id, d.quantity, d.market_value, coalesce(m.name, d.security_name) AS security_name, coalesce(m.asset_class, 'Unknown') AS asset_class, CASE WHEN m.mapped IS NULL THEN 'NOT_IN_MASTER' WHEN NOT m.mapped THEN 'UNKNOWN' ELSE 'MAPPED' END AS instrument_status, a.currency FROM dedup d LEFT JOIN master m ON d.security_scheme = 'ISIN' AND m.security_id = d.security_id JOIN accounts a ON a.account_id = d.account_id",
    "pos_owned": "SELECT p.*, o.client_id, o.ownership_pct, CAST(p.market_value * o.ownership_pct AS DECIMAL(24,2)) AS owned_value FROM positions p JOIN owners o ON o.account_id = p.account_id",
    "cash": "SELECT as_of, account_id, transaction_id, max(type) AS type, min(trade_date) AS trade_date, min(settlement_date) AS settlement_date, max(amount) AS amount, max(currency) AS currency, count(*) AS source_row_count, count(DISTINCT type) > 1 OR count(DISTINCT trade_date) > 1 OR count(DISTINCT settlement_date) > 1 OR count(DISTINCT amount) > 1 OR count(DISTINCT currency) > 1 OR count(DISTINCT description) > 1 AS source_disagrees FROM entries GROUP BY as_of, account_id, transaction_id",
    "cash_s": "SELECT *, CAST(CASE WHEN type IN ('BUY', 'FEE', 'TRANSFER_OUT') THEN -amount ELSE amount END AS DECIMAL(24,2)) AS signed_amount FROM cash",
    "cash_owned": "SELECT c.*, o.client_id, o.ownership_pct, CAST(c.amount * o.ownership_pct AS DECIMAL(24,2)) AS owned_amount, CAST(c.signed_amount * o.ownership_pct AS DECIMAL(24,2)) AS owned_signed FROM cash_s c JOIN owners o ON o.account_id = c.account_id",
    "closing_owned": "SELECT b.as_of, b.account_id, b.currency, o.client_id, CAST(b.amount * o.ownership_pct AS DECIMAL(24,2)) AS owned_amount FROM balances b JOIN owners o ON o.account_id = b.account_id WHERE b.balance_type = 'CLOSING'",
    "bal": "SELECT as_of, account_id, max(CASE WHEN balance_type = 'OPENING' THEN amount END) AS opening, max(CASE WHEN balance_type = 'CLOSING' THEN amount END) AS closing, max(currency) AS currency FROM balances GROUP BY as_of, account_id",
    "found": """
        SELECT as_of, account_id, security_scheme, security_id, 'MISSING_IN_MT535' AS finding, 'presence' AS field, 'PRESENT' AS semt002_value, 'ABSENT' AS mt535_value FROM feed_a ANTI JOIN feed_b USING (as_of, account_id, security_scheme, security_id)
        UNION ALL SELECT as_of, account_id, security_scheme, security_id, 'MISSING_IN_SEMT002', 'presence', 'ABSENT', 'PRESENT' FROM feed_b ANTI JOIN feed_a USING (as_of, account_id, security_scheme, security_id)"""
    + "".join(f" UNION ALL SELECT a.as_of, a.account_id, a.security_scheme, a.security_id, 'FIELD_MISMATCH', '{f}', CAST(a.{f} AS VARCHAR), CAST(b.{f} AS VARCHAR) FROM feed_a a JOIN feed_b b USING (as_of, account_id, security_scheme, security_id) WHERE a.{f} IS DISTINCT FROM b.{f}" for f in quality.FIELDS),
    "integ": """
        SELECT *, delta_raw = 0 AS raw_consistent, delta_conformed = 0 AS conformed_consistent FROM (
            SELECT b.as_of, b.account_id, b.opening, b.closing, b.currency, CAST(coalesce(r.m, 0) AS DECIMAL(24,2)) AS movements_raw, CAST(coalesce(c.m, 0) AS DECIMAL(24,2)) AS movements_conformed, CAST(b.opening + coalesce(r.m, 0) - b.closing AS DECIMAL(24,2)) AS delta_raw, CAST(b.opening + coalesce(c.m, 0) - b.closing AS DECIMAL(24,2)) AS delta_conformed
            FROM bal b LEFT JOIN (SELECT as_of, account_id, sum(CASE WHEN type IN ('BUY', 'FEE', 'TRANSFER_OUT') THEN -amount ELSE amount END) AS m FROM entries GROUP BY as_of, account_id) r USING (as_of, account_id) LEFT JOIN (SELECT as_of, account_id, sum(signed_amount) AS m FROM cash_s GROUP BY as_of, account_id) c USING (as_of, account_id))""",
    "contin": "SELECT as_of, account_id, opening, prev_closing, CAST(opening - prev_closing AS DECIMAL(24,2)) AS delta, opening = prev_closing AS continuous FROM (SELECT *, lag(closing) OVER (PARTITION BY account_id ORDER BY as_of) AS prev_closing FROM bal)",
    "metric_days": """
        SELECT d.as_of, parsed, files, coalesce(n, 0) AS n, coalesce(found_n, 0) AS found_n, coalesce(total, 0) AS total, coalesce(ok, 0) AS ok, checked, kept FROM (SELECT statement_date AS as_of, count_if(status = 'PARSED') AS parsed, count(*) AS files FROM deliveries GROUP BY statement_date) d
        LEFT JOIN (SELECT as_of, count(*) AS n FROM positions GROUP BY as_of) USING (as_of) LEFT JOIN (SELECT as_of, count(*) AS found_n FROM found GROUP BY as_of) USING (as_of)
        LEFT JOIN (SELECT as_of, count(*) AS total, count_if(conformed_consistent) AS ok FROM integ GROUP BY as_of) USING (as_of) LEFT JOIN (SELECT as_of, count(*) AS checked, count_if(continuous) AS kept FROM contin WHERE continuous IS NOT NULL GROUP BY as_of) USING (as_of)""",
    "dq": f"""
        SELECT as_of, dimension, metric, CAST(value AS DECIMAL(14,6)) AS value, passed, detail FROM (
            SELECT as_of, 'completeness' AS dimension, 'files_landed_rate' AS metric, CAST(parsed AS DOUBLE) / files AS value, parsed = files AS passed, concat(parsed, ' of ', files, ' expected files parsed') AS detail FROM metric_days
            UNION ALL SELECT as_of, 'accuracy', 'holdings_cross_format_match_rate', 1 - CAST(found_n AS DOUBLE) / nullif(n, 0), found_n = 0, concat(found_n, ' cross-format findings across ', n, ' positions') FROM metric_days
            UNION ALL SELECT as_of, 'accuracy', 'cash_conformed_consistency_rate', CAST(ok AS DOUBLE) / nullif(total, 0), total = ok, concat(ok, ' of ', total, ' account-days consistent') FROM metric_days
            UNION ALL SELECT as_of, 'accuracy', 'cash_day_over_day_continuity_rate', CAST(kept AS DOUBLE) / checked, kept = checked, concat(kept, ' of ', checked, ' accounts continuous from the prior day') FROM metric_days WHERE checked IS NOT NULL
            UNION ALL SELECT as_of, 'exceptions', 'holdings_findings_count', found_n, NULL, concat(found_n, ' cross-format findings') FROM metric_days
            UNION ALL SELECT as_of, 'exceptions', 'cash_integrity_breaks_count', total - ok, NULL, concat(total - ok, ' account-days with a missing movement') FROM metric_days
            UNION ALL SELECT as_of, 'exceptions', 'cash_continuity_breaks_count', checked - kept, NULL, concat(checked - kept, ' accounts broke day-over-day continuity') FROM metric_days WHERE checked IS NOT NULL
            UNION ALL SELECT DATE '{RUN_DATE}', 'freshness', 'bronze_days_behind', date_diff('day', max(statement_date), DATE '{RUN_DATE}'), date_diff('day', max(statement_date), DATE '{RUN_DATE}') <= 3, concat('bronze last landed ', max(statement_date)) FROM deliveries)""",
    "pos_usd": "SELECT p.*, CASE WHEN p.currency = 'USD' THEN CAST(p.owned_value AS DECIMAL(28,8)) ELSE CAST(p.owned_value * f.rate AS DECIMAL(28,8)) END AS usd FROM pos_owned p JOIN fx f ON f.as_of = p.as_of",
    "closing_usd": "SELECT p.*, CASE WHEN p.currency = 'USD' THEN CAST(p.owned_amount AS DECIMAL(28,8)) ELSE CAST(p.owned_amount * f.rate AS DECIMAL(28,8)) END AS usd FROM closing_owned p JOIN fx f ON f.as_of = p.as_of",
    "moves_usd": "SELECT p.*, CASE WHEN p.currency = 'USD' THEN CAST(p.owned_amount AS DECIMAL(28,8)) ELSE CAST(p.owned_amount * f.rate AS DECIMAL(28,8)) END AS usd, CASE WHEN p.currency = 'USD' THEN CAST(p.owned_signed AS DECIMAL(28,8)) ELSE CAST(p.owned_signed * f.rate AS DECIMAL(28,8)) END AS usd_signed FROM cash_owned p JOIN fx f ON f.as_of = p.as_of",
    "alts_points": "SELECT o.client_id, d.fund_id, d.doc_date AS statement_date, CAST(CASE WHEN a.currency = 'USD' THEN CAST(d.nav AS DECIMAL(28,8)) ELSE CAST(d.nav * f.rate AS DECIMAL(28,8)) END * o.ownership_pct AS DECIMAL(24,2)) AS nav_usd FROM (SELECT fund_id, doc_date, max(ending) AS nav FROM doc_final WHERE doc_type = 'capital_account_statement' AND confirmed_amount IS NOT NULL AND ending IS NOT NULL GROUP BY fund_id, doc_date) d JOIN accounts a ON a.account_id = d.fund_id JOIN owners o ON o.account_id = d.fund_id JOIN fx f ON f.as_of = d.doc_date",
    "alts_daily": "SELECT g.client_id, g.as_of, CAST(sum(coalesce(p.nav_usd, 0)) AS DECIMAL(24,2)) AS alts_usd FROM (SELECT w.client_id, w.as_of, f.fund_id FROM (SELECT DISTINCT client_id, as_of FROM pos_usd) w JOIN (SELECT DISTINCT client_id, fund_id FROM alts_points) f ON f.client_id = w.client_id) g ASOF LEFT JOIN alts_points p ON p.client_id = g.client_id AND p.fund_id = g.fund_id AND p.statement_date <= g.as_of GROUP BY g.client_id, g.as_of",
    "wealth": """
        SELECT client_id, p.as_of, positions_usd, coalesce(cash_usd, 0.00) AS cash_usd, coalesce(alts_usd, CAST(0 AS DECIMAL(24,2))) AS alts_usd, CAST(positions_usd + coalesce(cash_usd, 0) + coalesce(alts_usd, 0) AS DECIMAL(24,2)) AS total_wealth_usd, f.rate AS fx_rate_used, f.rate_date AS fx_rate_date, coalesce(ok, true) AS books_reconcile
        FROM (SELECT client_id, as_of, CAST(sum(usd) AS DECIMAL(24,2)) AS positions_usd FROM pos_usd GROUP BY client_id, as_of) p LEFT JOIN (SELECT client_id, as_of, CAST(sum(usd) AS DECIMAL(24,2)) AS cash_usd FROM closing_usd GROUP BY client_id, as_of) c USING (client_id, as_of) LEFT JOIN alts_daily USING (client_id, as_of)
        LEFT JOIN (SELECT o.client_id, i.as_of, bool_and(conformed_consistent) AS ok FROM integ i JOIN owners o ON o.account_id = i.account_id GROUP BY o.client_id, i.as_of) q USING (client_id, as_of) JOIN fx f ON f.as_of = p.as_of""",
    "flow": "SELECT client_id, as_of, CAST(sum(usd_signed) AS DECIMAL(24,2)) AS external_flow_usd FROM moves_usd WHERE type IN ('TRANSFER_IN', 'TRANSFER_OUT') GROUP BY client_id, as_of",
    "perf_raw": "SELECT *, CAST(total_wealth_usd - external_flow_usd AS DOUBLE) / nullif(CAST(before AS DOUBLE), 0) - 1 AS r FROM (SELECT w.client_id, w.as_of, total_wealth_usd, coalesce(external_flow_usd, CAST(0 AS DECIMAL(24,2))) AS external_flow_usd, lag(total_wealth_usd) OVER (PARTITION BY w.client_id ORDER BY w.as_of) AS before FROM wealth w LEFT JOIN flow USING (client_id, as_of))",
    "ends": "SELECT client_id, min(as_of) AS inception_date, max(as_of) AS as_of, arg_min(total_wealth_usd, as_of) AS wealth_begin_usd, arg_max(total_wealth_usd, as_of) AS wealth_end_usd FROM perf_raw GROUP BY client_id",
    "dietz_row": "SELECT client_id, inception_date, as_of, wealth_begin_usd, wealth_end_usd, net_external_flow_usd, round(CAST(wealth_end_usd - wealth_begin_usd - net_external_flow_usd AS DOUBLE) / nullif(CAST(wealth_begin_usd AS DOUBLE) + coalesce(CAST(weighted AS DOUBLE), 0), 0), 6) AS dietz_return FROM (SELECT e.*, CAST(coalesce(n, 0) AS DECIMAL(24,2)) AS net_external_flow_usd, weighted FROM ends e LEFT JOIN (SELECT p.client_id, sum(p.external_flow_usd) AS n, sum(CAST(CAST(p.external_flow_usd AS DOUBLE) * (CAST(date_diff('day', p.as_of, e.as_of) AS DOUBLE) / date_diff('day', e.inception_date, e.as_of)) AS DECIMAL(28,8))) AS weighted FROM perf_raw p JOIN ends e ON e.client_id = p.client_id AND p.as_of > e.inception_date GROUP BY p.client_id) USING (client_id))",
    "doc_steps": """
        SELECT *, row_number() OVER w AS place, sum(CASE WHEN amount IS NOT NULL AND cumulative IS NOT NULL THEN amount END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running, last_value(ending IGNORE NULLS) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior
        FROM fund_docs WINDOW w AS (PARTITION BY fund_id, doc_type ORDER BY sequence_number, doc_date, document)""",
    "doc_judged": """
        SELECT *, self_consistent AND validation_notes IS NULL AND confidence >= 0.85 AS auto FROM (SELECT *, CASE WHEN self_consistent THEN self_reported ELSE least(self_reported, 0.5) END AS confidence FROM (
            SELECT *, CASE WHEN doc_type = 'capital_account_statement' THEN coalesce(CAST(beginning + amount AS DECIMAL(24,2)) = ending, false) ELSE amount IS NOT NULL AND cumulative IS NOT NULL END AS self_consistent,
                nullif(concat_ws('; ', CASE WHEN doc_type <> 'capital_account_statement' AND bool_or(sequence_number <> place) OVER (PARTITION BY fund_id, doc_type) THEN 'sequence has a gap' END,
                    CASE WHEN doc_type <> 'capital_account_statement' AND (amount IS NULL OR cumulative IS NULL) THEN 'amount or cumulative missing' END, CASE WHEN doc_type <> 'capital_account_statement' AND amount IS NOT NULL AND cumulative IS NOT NULL AND running <> cumulative THEN 'running total differs' END,
                    CASE WHEN doc_type = 'capital_account_statement' AND prior IS NOT NULL AND beginning <> prior THEN 'beginning differs from prior ending' END), '') AS validation_notes FROM doc_steps))""",
    "doc_final": "SELECT j.*, d.status AS reviewed_status, CASE WHEN d.status IS NOT NULL THEN d.final_amount WHEN j.auto THEN j.amount END AS confirmed_amount FROM doc_judged j LEFT JOIN decisions d ON d.fund_id = j.fund_id AND d.document = j.document",
    "queue_old": "SELECT fund_id, document, CASE k % 4 WHEN 0 THEN 'approved' ELSE 'pending' END AS status, amount FROM fund_docs WHERE k % 2 = 0",
    "queue_new": "SELECT fund_id, document, CAST(amount + 5 AS DECIMAL(24,2)) AS amount FROM fund_docs WHERE k % 3 = 0",
}


def _sql(text: str) -> str:
    """The text with the relations that it needs, each after those that it uses."""
    irr = bool(re.search(r"\birr\b", text))
    own: dict[str, str] = {}

    def need(body: str) -> None:
        for name, inner in PIECES.items():
            if name not in own and re.search(rf"\b{name}\b", body):
                need(inner)
                own.setdefault(name, inner)

    need(f"{text} {_IRR}" if irr else text)
    pieces = ", ".join(f"{n} AS ({b})" for n, b in own.items())
    base = with_clause(DUCK, f"{text} {pieces}")
    parts = ", ".join(x for x in (base, pieces, _IRR if irr else "") if x)
    return f"WITH {'RECURSIVE ' if irr else ''}{parts} {text}" if parts else text


# --- shared DataFrames -------------------------------------------------------------------------------------------


def _rates(m: Model) -> DataFrame:
    return fx.fill_forward(m["fx_published"], m["days"])


def _on(rows: DataFrame, day) -> DataFrame:
    return rows if day is None else rows.where(F.col("as_of") == F.lit(day))


def _latest(m: Model):
    """The last day with holdings: one value, by which all inputs are then pruned."""
    return m["holdings"].agg(F.max("as_of")).first()[0]


def _positions(m: Model, day=None) -> DataFrame:
    return conform.enriched(_on(m["holdings"], day), m["master"]).join(m["accounts"].select("account_id", "currency"), "account_id")


def _pos_owned(m: Model, day=None) -> DataFrame:
    return conform.position_owners(_positions(m, day), m["owners"])


def _closing(m: Model, day=None) -> DataFrame:
    return conform.cash_owners(_on(m["balances"], day).where("balance_type = 'CLOSING'"), "amount", m["owners"])


def _moves(m: Model) -> DataFrame:
    owned = conform.cash_owners(conform.collapsed(m["entries"]), "amount", m["owners"])
    return owned.withColumn("owned_signed", (F.col("signed_amount") * F.col("ownership_pct")).cast("decimal(24,2)"))


def _integrity(m: Model, day=None) -> DataFrame:
    return quality.integrity(_on(m["balances"], day), _on(m["entries"], day))


def _alts(m: Model) -> DataFrame:
    return wealth.alternatives(documents.marks(_confirmed(m), m["accounts"]), m["owners"], _rates(m))


def _wealth(m: Model, day=None) -> DataFrame:
    verdicts = _integrity(m, day).select("as_of", "account_id", "conformed_consistent").join(m["owners"], "account_id")
    return wealth.daily(_pos_owned(m, day), _closing(m, day), _alts(m), _rates(m), verdicts)


def _performance(m: Model) -> DataFrame:
    return wealth.performance(_wealth(m), wealth.flows(_moves(m), _rates(m)))


def _found(m: Model) -> DataFrame:
    return quality.findings_of_feeds(m["feeds"])


def _metrics(m: Model) -> DataFrame:
    return quality.metrics(m["deliveries"], _positions(m), _found(m), _integrity(m), quality.continuity(m["balances"]), RUN_DATE)


def _judged(m: Model) -> DataFrame:
    return documents.judged(m["fund_docs"])


def _confirmed(m: Model) -> DataFrame:
    return documents.confirmed(_judged(m), m["decisions"])


def _queue(m: Model) -> DataFrame:
    old = m["fund_docs"].where("k % 2 = 0").select("fund_id", "document", F.when(F.col("k") % 4 == 0, "approved").otherwise("pending").alias("status"), "amount")
    new = m["fund_docs"].where("k % 3 = 0").select("fund_id", "document", (F.col("amount") + 5).cast("decimal(24,2)").alias("amount"))
    return registry.merged_queue(old, new)


# --- wealth and reports ------------------------------------------------------------------------------------------


@query("SELECT * FROM wealth")
def wealth_daily(m):
    return _wealth(m)


@query("SELECT client_id, as_of, books_reconcile FROM wealth WHERE NOT books_reconcile")
def books_reconcile(m):
    return _wealth(m).where(~F.col("books_reconcile")).select("client_id", "as_of", "books_reconcile")


@query("SELECT client_id, as_of, total_wealth_usd FROM wealth WHERE as_of = (SELECT max(as_of) FROM wealth)")
def wealth_latest(m):
    return _wealth(m, _latest(m)).select("client_id", "as_of", "total_wealth_usd")


@query("SELECT as_of, rate, rate_date FROM fx")
def fx_fill_forward(m):
    return _rates(m)


_ALLOCATION = """SELECT client_id, as_of, asset_class, value_usd, CAST(CAST(value_usd AS DOUBLE) / nullif(CAST(sum(value_usd) OVER (PARTITION BY client_id, as_of) AS DOUBLE), 0) AS DECIMAL(9,6)) AS weight FROM (
    SELECT client_id, as_of, asset_class, CAST(sum(usd) AS DECIMAL(24,2)) AS value_usd FROM (SELECT client_id, as_of, asset_class, usd FROM pos_usd UNION ALL SELECT client_id, as_of, 'Cash', usd FROM closing_usd) GROUP BY client_id, as_of, asset_class UNION ALL SELECT client_id, as_of, 'Alternatives', alts_usd FROM alts_daily WHERE alts_usd > 0)"""


@query(_ALLOCATION)
def asset_allocation(m):
    return wealth.allocation(_pos_owned(m), _closing(m), _alts(m), _rates(m))


@query(f"SELECT * FROM ({_ALLOCATION}) WHERE as_of = (SELECT max(as_of) FROM ({_ALLOCATION}))")
def allocation_latest(m):
    day = _latest(m)
    return wealth.allocation(_pos_owned(m, day), _closing(m, day), _alts(m), _rates(m))


_INCOME = "SELECT client_id, CAST(date_trunc('month', as_of) AS DATE) AS month, type, CAST(sum(usd) AS DECIMAL(24,2)) AS income_usd, count(*) AS movements FROM moves_usd WHERE type IN ('DIVIDEND', 'INTEREST') GROUP BY client_id, date_trunc('month', as_of), type"


@query(_INCOME)
def income_monthly(m):
    return wealth.income(_moves(m), _rates(m))


@query(f"SELECT month, CAST(coalesce(sum(CASE WHEN type = 'DIVIDEND' THEN income_usd END), 0) AS DECIMAL(34,2)) AS dividend, CAST(coalesce(sum(CASE WHEN type = 'INTEREST' THEN income_usd END), 0) AS DECIMAL(34,2)) AS interest FROM ({_INCOME}) GROUP BY month")
def income_pivot(m):
    wide = wealth.income(_moves(m), _rates(m)).groupBy("month").pivot("type", ["DIVIDEND", "INTEREST"]).agg(F.sum("income_usd").cast("decimal(34,2)")).na.fill(0)
    return wide.select("month", F.col("DIVIDEND").alias("dividend"), F.col("INTEREST").alias("interest"))


@query("SELECT client_id, as_of, security_id, security_name, asset_class, owned_usd, weight, CAST(rank AS INTEGER) AS rank FROM (SELECT *, CAST(CAST(owned_usd AS DOUBLE) / nullif(CAST(sum(owned_usd) OVER (PARTITION BY client_id) AS DOUBLE), 0) AS DECIMAL(9,6)) AS weight, row_number() OVER (PARTITION BY client_id ORDER BY owned_usd DESC, security_id) AS rank FROM (SELECT client_id, as_of, security_id, max(security_name) AS security_name, max(asset_class) AS asset_class, CAST(sum(usd) AS DECIMAL(24,2)) AS owned_usd FROM pos_usd WHERE as_of = (SELECT max(as_of) FROM positions) GROUP BY client_id, as_of, security_id)) WHERE rank <= 10")
def top_holdings(m):
    return wealth.top_holdings(_pos_owned(m, _latest(m)), _rates(m))


@query("SELECT client_id, as_of, external_flow_usd FROM flow")
def flows_daily(m):
    return wealth.flows(_moves(m), _rates(m))


@query("SELECT client_id, as_of, total_wealth_usd, external_flow_usd, round(r, 6) AS daily_twr_return, round(exp(sum(CASE WHEN r > -1 THEN ln(1 + r) ELSE 0 END) OVER (PARTITION BY client_id ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 4) AS twr_index FROM perf_raw")
def twr_chain(m):
    return _performance(m)


@query("SELECT * FROM ends")
def performance_bounds(m):
    return wealth.endpoints(_performance(m))


@query("SELECT * FROM dietz_row")
def dietz(m):
    return wealth.dietz(_performance(m))


_IRR = """
    flows AS (SELECT p.client_id, list({'t': CAST(date_diff('day', e.inception_date, p.as_of) AS DOUBLE) / 365.0, 'c': CASE WHEN p.as_of = e.inception_date THEN -CAST(total_wealth_usd AS DOUBLE) ELSE -CAST(external_flow_usd AS DOUBLE) END + CASE WHEN p.as_of = e.as_of THEN CAST(total_wealth_usd AS DOUBLE) ELSE 0 END} ORDER BY p.as_of) AS every, min(e.inception_date) < max(e.as_of) AS several FROM perf_raw p JOIN ends e USING (client_id) GROUP BY p.client_id),
    begun AS (SELECT client_id, several, list_filter(every, lambda x: x.c <> 0) AS cash FROM flows),
    ranged AS (SELECT *, sign(list_sum(list_transform(cash, lambda x: x.c / pow(1 - 0.9999, x.t)))) AS low, sign(list_sum(list_transform(cash, lambda x: x.c / pow(11.0, x.t)))) AS high FROM begun),
    halves(client_id, cash, low, lo, hi, n) AS (SELECT client_id, cash, low, CAST(-0.9999 AS DOUBLE), CAST(10.0 AS DOUBLE), 0 FROM ranged WHERE several AND low * high < 0
        UNION ALL SELECT client_id, cash, low, CASE WHEN at_mid = low THEN mid ELSE lo END, CASE WHEN at_mid = low THEN hi ELSE mid END, n + 1 FROM (SELECT *, sign(list_sum(list_transform(cash, lambda x: x.c / pow(1 + mid, x.t)))) AS at_mid FROM (SELECT *, (lo + hi) / 2 AS mid FROM halves WHERE n < 200))),
    irr AS (SELECT b.client_id, (h.lo + h.hi) / 2 AS irr, b.cash FROM begun b LEFT JOIN halves h ON h.client_id = b.client_id AND h.n = 200)"""


@query("SELECT client_id, round(irr, 8) AS irr, CASE WHEN irr IS NOT NULL THEN abs(list_sum(list_transform(cash, lambda x: x.c / pow(1 + irr, x.t)))) < 1 END AS npv_near_zero FROM irr")
def xirr(m):
    return wealth.xirr(_performance(m))


@query("SELECT d.*, twr_since_inception, round(irr, 8) AS irr_since_inception_annualized FROM (SELECT * RENAME (dietz_return AS dietz_since_inception) FROM dietz_row) d JOIN (SELECT client_id, arg_max(twr, as_of) - 1 AS twr_since_inception FROM (SELECT client_id, as_of, round(exp(sum(CASE WHEN r > -1 THEN ln(1 + r) ELSE 0 END) OVER (PARTITION BY client_id ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 4) AS twr FROM perf_raw) GROUP BY client_id) USING (client_id) LEFT JOIN irr USING (client_id)")
def performance_summary(m):
    """Every return of a client since its first day, in one row."""
    return wealth.summary(_performance(m))


@query("SELECT currency, count(*) AS accounts FROM (SELECT CASE WHEN account_id % 50 = 7 THEN 'CHF' ELSE currency END AS currency FROM accounts) WHERE currency NOT IN ('USD', 'EUR') GROUP BY currency")
def unknown_currency_guard(m):
    """Currencies that would stop the conversion, on accounts of which some are made to hold one."""
    held = m["accounts"].withColumn("currency", F.when(F.col("account_id") % 50 == 7, "CHF").otherwise(F.col("currency")))
    return held.where(~F.col("currency").isin("USD", "EUR")).groupBy("currency").agg(F.count("*").alias("accounts"))


@query("SELECT client_id, as_of, total_wealth_usd, external_flow_usd FROM perf_raw WHERE as_of BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND external_flow_usd <> 0")
def flow_markers(m):
    """Days with an external flow in a range of dates, as a chart of returns marks them."""
    return _performance(m).where("as_of BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' AND external_flow_usd <> 0").select("client_id", "as_of", "total_wealth_usd", "external_flow_usd")


# --- ownership ---------------------------------------------------------------------------------------------------

_EFFECTIVE = "SELECT e2.owned_id AS account, e1.owner_id AS client, CAST(sum(CAST(e1.pct * e2.pct AS DECIMAL(18,12))) AS DECIMAL(9,6)) AS ownership_pct FROM edges e1 JOIN edges e2 ON e2.owner_id = e1.owned_id WHERE e1.owner_id LIKE 'C%' AND e2.owned_id LIKE 'A%' GROUP BY e2.owned_id, e1.owner_id"


@query(_EFFECTIVE)
def ownership_effective(m):
    return ownership.effective(m["edges"])


@query(f"SELECT client, count(*) AS accounts, CAST(sum(ownership_pct) AS DECIMAL(19,6)) AS total_pct FROM ({_EFFECTIVE}) WHERE ownership_pct <> 0 GROUP BY client")
def ownership_reverse(m):
    return ownership.effective(m["edges"]).where("ownership_pct <> 0").groupBy("client").agg(F.count("*").alias("accounts"), F.sum("ownership_pct").cast("decimal(19,6)").alias("total_pct"))


_TORN = "(SELECT * FROM edges WHERE pct <> 0.3)"


@query(f"SELECT 'incomplete' AS problem, owned_id AS node FROM {_TORN} GROUP BY owned_id HAVING sum(pct) <> 1 UNION ALL SELECT 'fraction', owned_id FROM {_TORN} WHERE NOT (pct > 0 AND pct <= 1) UNION ALL SELECT 'cycle', owned_id FROM {_TORN} WHERE owner_id = owned_id")
def ownership_problems(m):
    """The invariants on a graph that lacks some edges."""
    node = lambda rows, kind, letter, c: rows.select(F.concat(F.lit(letter), c).alias("node"), F.lit(kind).alias("kind"))
    known = node(m["clients"], "client", "C", "client_id").unionByName(node(m["clients"], "entity", "E", "client_id")).unionByName(node(m["accounts"], "account", "A", "account_id"))
    return ownership.problems(m["edges"].where("pct <> 0.3"), known)


@query("SELECT account_id, client_id, ownership_pct, count(*) OVER (PARTITION BY account_id) AS owner_count, count(*) OVER (PARTITION BY account_id) > 1 AS is_shared FROM owners")
def ownership_shared(m):
    return ownership.shared(m["owners"])


@query("SELECT a.account_id, a.client_id, string_agg(CAST(b.client_id AS VARCHAR), ',' ORDER BY b.client_id) AS others FROM owners a JOIN owners b ON b.account_id = a.account_id AND b.client_id <> a.client_id GROUP BY a.account_id, a.client_id")
def co_owners(m):
    return ownership.co_owners(m["owners"])


# --- positions and cash ------------------------------------------------------------------------------------------


@query("SELECT as_of, account_id, source_format, count(*) AS n FROM delivery GROUP BY as_of, account_id, source_format")
def positions_delivery_choice(m):
    return conform.chosen_delivery(m["holdings"]).groupBy("as_of", "account_id", "source_format").agg(F.count("*").alias("n"))


@query("SELECT as_of, account_id, security_id, quantity, market_value, file_path FROM dedup")
def positions_dedupe(m):
    return conform.deduped(m["holdings"]).select("as_of", "account_id", "security_id", "quantity", "market_value", "file_path")


@query("SELECT as_of, account_id, security_id, security_name, asset_class, instrument_status, quantity, market_value FROM positions")
def positions_enriched(m):
    return _positions(m).select("as_of", "account_id", "security_id", "security_name", "asset_class", "instrument_status", "quantity", "market_value")


@query("SELECT instrument_status, asset_class, count(*) AS n FROM positions GROUP BY instrument_status, asset_class")
def positions_status_counts(m):
    return _positions(m).groupBy("instrument_status", "asset_class").agg(F.count("*").alias("n"))


@query("SELECT count(*) AS positions, count(DISTINCT as_of) AS days, count(DISTINCT account_id) AS accounts, count_if(instrument_status <> 'MAPPED') AS unmapped FROM positions")
def positions_dashboard(m):
    return _positions(m).agg(F.count("*").alias("positions"), F.countDistinct("as_of").alias("days"), F.countDistinct("account_id").alias("accounts"), F.count_if(F.col("instrument_status") != "MAPPED").alias("unmapped"))


@query("SELECT as_of, account_id, security_id, client_id, ownership_pct, owned_value FROM pos_owned")
def positions_prorated(m):
    return _pos_owned(m).select("as_of", "account_id", "security_id", "client_id", "ownership_pct", "owned_value")


@query("SELECT * FROM cash_s")
def cash_collapse(m):
    return conform.collapsed(m["entries"])


@query("SELECT type, CAST(sum(CASE WHEN type IN ('BUY', 'FEE', 'TRANSFER_OUT') THEN -amount ELSE amount END) AS DECIMAL(34,2)) AS net, count(*) AS n FROM entries GROUP BY type")
def cash_signed(m):
    return m["entries"].groupBy("type").agg(F.sum(signed(F.col("amount"), F.col("type"))).cast("decimal(34,2)").alias("net"), F.count("*").alias("n"))


@query("SELECT * FROM bal")
def cash_balance_pivot(m):
    return conform.pivoted(m["balances"])


@query("SELECT as_of, account_id, transaction_id, client_id, owned_amount FROM cash_owned")
def cash_prorated(m):
    return _moves(m).select("as_of", "account_id", "transaction_id", "client_id", "owned_amount")


# --- quality -----------------------------------------------------------------------------------------------------


@query("SELECT * FROM found")
def recon_findings(m):
    return _found(m)


@query("SELECT finding, field, count(*) AS n FROM found GROUP BY finding, field")
def recon_summary(m):
    return _found(m).groupBy("finding", "field").agg(F.count("*").alias("n"))


@query("SELECT * FROM integ")
def cash_integrity(m):
    return _integrity(m)


@query("SELECT count(*) AS account_days, count_if(NOT raw_consistent) AS raw_breaks, count_if(NOT conformed_consistent) AS conformed_breaks, count_if(NOT raw_consistent AND conformed_consistent) AS vindicated FROM integ")
def cash_scorecard(m):
    bad, clean = ~F.col("raw_consistent"), F.col("conformed_consistent")
    return _integrity(m).agg(F.count("*").alias("account_days"), F.count_if(bad).alias("raw_breaks"), F.count_if(~clean).alias("conformed_breaks"), F.count_if(bad & clean).alias("vindicated"))


@query("SELECT * FROM contin")
def cash_continuity(m):
    return quality.continuity(m["balances"])


@query("SELECT * FROM dq")
def dq_metrics(m):
    return _metrics(m)


@query("SELECT dimension, metric, count_if(passed) AS passed_days, count(*) AS days, round(CAST(count_if(passed) AS DOUBLE) / count(*), 6) AS attainment FROM dq WHERE passed IS NOT NULL GROUP BY dimension, metric")
def dq_sla(m):
    """How often each series that has a verdict passed."""
    return _metrics(m).where("passed IS NOT NULL").groupBy("dimension", "metric").agg(F.count_if("passed").alias("passed_days"), F.count("*").alias("days"), F.round(F.count_if("passed") / F.count("*"), 6).alias("attainment"))


@query("SELECT metric, max(as_of) AS as_of, max_by(value, as_of) AS value FROM dq WHERE value IS NOT NULL GROUP BY metric")
def dq_latest(m):
    """The newest value of each metric."""
    return _metrics(m).where("value IS NOT NULL").groupBy("metric").agg(F.max("as_of").alias("as_of"), F.max_by("value", "as_of").alias("value"))


@query("SELECT as_of, max(CASE WHEN metric = 'holdings_cross_format_match_rate' THEN value END) AS holdings_cross_format_match_rate, max(CASE WHEN metric = 'cash_conformed_consistency_rate' THEN value END) AS cash_conformed_consistency_rate, max(CASE WHEN metric = 'cash_day_over_day_continuity_rate' THEN value END) AS cash_day_over_day_continuity_rate, max(CASE WHEN metric = 'files_landed_rate' THEN value END) AS files_landed_rate FROM dq WHERE dimension <> 'freshness' GROUP BY as_of")
def dq_pivot(m):
    """The rates of a day side by side."""
    rates = ["holdings_cross_format_match_rate", "cash_conformed_consistency_rate", "cash_day_over_day_continuity_rate", "files_landed_rate"]
    return _metrics(m).where("dimension <> 'freshness'").groupBy("as_of").pivot("metric", rates).agg(F.max("value"))


@query(f"SELECT max(as_of) AS latest, date_diff('day', max(as_of), DATE '{RUN_DATE}') AS age_days, date_diff('day', max(as_of), DATE '{RUN_DATE}') <= 3 AS passed FROM base_holdings")
def freshness(m):
    return registry.freshness(m["base_holdings"], RUN_DATE)


# --- documents ---------------------------------------------------------------------------------------------------


@query("SELECT document, self_consistent, confidence FROM doc_judged")
def doc_self_consistency(m):
    return _judged(m).select("document", "self_consistent", "confidence")


def _notes(kind: str):
    return lambda m: _judged(m).where(F.col("doc_type") == kind).select("fund_id", "document", "sequence_number", "cross_document_valid", "validation_notes")


for _name, _kind in (("doc_call_validation", "capital_call"), ("doc_distribution_validation", "distribution"), ("doc_statement_chain", "capital_account_statement")):
    _f = _notes(_kind)
    _f.__name__ = _name
    query(f"SELECT fund_id, document, sequence_number, validation_notes IS NULL AS cross_document_valid, validation_notes FROM doc_judged WHERE doc_type = '{_kind}'")(_f)


@query("SELECT doc_type, CASE WHEN auto THEN 'auto_accept' ELSE 'needs_review' END AS routing, count(*) AS n, round(avg(confidence), 2) AS confidence FROM doc_judged GROUP BY doc_type, auto")
def doc_routing(m):
    return _judged(m).groupBy("doc_type", "routing").agg(F.count("*").alias("n"), F.round(F.avg(F.col("confidence").cast("decimal(20,12)")), 2).cast("double").alias("confidence"))


@query("SELECT fund_id, document, reviewed_status, confirmed_amount FROM doc_final")
def doc_confirmed_fields(m):
    return _confirmed(m).select("fund_id", "document", "reviewed_status", "confirmed_amount")


@query("SELECT doc_type, count(*) AS documents, count_if(hits = 2) AS exact, round(CAST(sum(hits) AS DOUBLE) / (count(*) * 2.0), 6) AS field_accuracy FROM (SELECT d.doc_type, CAST(coalesce(d.amount = t.amount, false) AS INTEGER) + CAST(coalesce(d.cumulative = t.total, false) AS INTEGER) AS hits FROM fund_docs d JOIN fund_rows t ON t.document = d.document) GROUP BY doc_type")
def doc_eval(m):
    truth = m["fund_rows"].select("document", "doc_type", "amount", F.col("total").alias("cumulative"))
    return documents.evaluated(m["fund_docs"], truth).drop("extracted")


_TRUE = "SELECT document, doc_type, seq AS sequence_number, doc_date, amount, total AS cumulative, CASE WHEN doc_type = 'capital_account_statement' THEN CAST(total - amount AS DECIMAL(24,2)) END AS beginning, CASE WHEN doc_type = 'capital_account_statement' THEN total END AS ending, contributions, distributions, management_fees, realized, unrealized, remaining_commitment, total_commitment, unfunded_commitment FROM fund_parts"
_SCORED = ("sequence_number", "doc_date", "amount", "cumulative", "beginning", "ending", "contributions", "distributions", "management_fees", "realized", "unrealized", "remaining_commitment", "total_commitment", "unfunded_commitment")


@query(f"SELECT doc_type, count(*) AS documents, count(found) AS extracted, count_if(found IS NOT NULL AND hits = asked) AS exact, round(CAST(sum(hits) FILTER (found IS NOT NULL) AS DOUBLE) / sum(asked) FILTER (found IS NOT NULL), 6) AS field_accuracy FROM (SELECT t.doc_type, d.document AS found, {' + '.join(f'CAST(t.{f} IS NOT NULL AS INTEGER)' for f in _SCORED)} AS asked, {' + '.join(f'CAST(coalesce(t.{f} = d.{f}, false) AS INTEGER)' for f in _SCORED)} AS hits FROM ({_TRUE}) t LEFT JOIN (SELECT * FROM fund_docs WHERE k % 43 <> 0) d ON d.document = t.document) GROUP BY doc_type")
def doc_eval_fields(m):
    """All fields of the truth; some documents have lost their extraction."""
    truth = m["fund_parts"].withColumnsRenamed({"seq": "sequence_number", "total": "cumulative"})
    of_statement = lambda value: F.when(F.col("doc_type") == "capital_account_statement", value)
    truth = truth.withColumn("beginning", of_statement((F.col("cumulative") - F.col("amount")).cast("decimal(24,2)"))).withColumn("ending", of_statement(F.col("cumulative")))
    return documents.evaluated(m["fund_docs"].where("k % 43 <> 0"), truth.select("document", "doc_type", *_SCORED))


_LATEST = "arg_max({c}, (sequence_number, doc_date, document)) FILTER (doc_type = '{t}')"
_ROLL = f"""SELECT fund_id, pending_review_documents, inception_date, total_called, total_distributed, current_nav, round(CAST(total_distributed + current_nav AS DOUBLE) / nullif(CAST(total_called AS DOUBLE), 0), 6) AS moic FROM (SELECT fund_id, count_if(NOT auto AND reviewed_status IS NULL) AS pending_review_documents FROM doc_final GROUP BY fund_id)
    JOIN (SELECT fund_id, min(doc_date) AS inception_date, CAST(coalesce({_LATEST.format(c='cumulative', t='capital_call')}, 0) AS DECIMAL(24,2)) AS total_called, CAST(coalesce({_LATEST.format(c='cumulative', t='distribution')}, 0) AS DECIMAL(24,2)) AS total_distributed, CAST(coalesce({_LATEST.format(c='ending', t='capital_account_statement')}, 0) AS DECIMAL(24,2)) AS current_nav FROM doc_final WHERE confirmed_amount IS NOT NULL GROUP BY fund_id) USING (fund_id)"""


@query(_ROLL)
def fund_rollup(m):
    return documents.rolled_up(_confirmed(m)).drop("as_of", "total_commitment", "unfunded_commitment")


@query(f"""SELECT fund_id, as_of, CASE WHEN as_of IS NULL THEN CAST(called + remaining AS DECIMAL(24,2)) ELSE stated END AS total_commitment, CASE WHEN as_of IS NULL THEN remaining ELSE unfunded END AS unfunded_commitment FROM (
    SELECT fund_id, {_LATEST.format(c='doc_date', t='capital_account_statement')} AS as_of, {_LATEST.format(c='total_commitment', t='capital_account_statement')} AS stated, {_LATEST.format(c='unfunded_commitment', t='capital_account_statement')} AS unfunded,
        coalesce({_LATEST.format(c='cumulative', t='capital_call')}, 0) AS called, CAST(coalesce({_LATEST.format(c='remaining_commitment', t='capital_call')}, 0) AS DECIMAL(24,2)) AS remaining FROM doc_final WHERE confirmed_amount IS NOT NULL GROUP BY fund_id)""")
def fund_commitment(m):
    """What fund_rollup's SQL lacks: the statement's date and the commitments, implied by calls where there is none."""
    return documents.rolled_up(_confirmed(m)).select("fund_id", "as_of", "total_commitment", "unfunded_commitment")


_COMMITTED = f"""SELECT fund_id, as_of, CASE WHEN as_of IS NULL THEN CAST(called + remaining AS DECIMAL(24,2)) ELSE stated END AS total_commitment, CASE WHEN as_of IS NULL THEN remaining ELSE unfunded END AS unfunded_commitment FROM (
    SELECT fund_id, {_LATEST.format(c='doc_date', t='capital_account_statement')} AS as_of, {_LATEST.format(c='total_commitment', t='capital_account_statement')} AS stated, {_LATEST.format(c='unfunded_commitment', t='capital_account_statement')} AS unfunded,
        coalesce({_LATEST.format(c='cumulative', t='capital_call')}, 0) AS called, CAST(coalesce({_LATEST.format(c='remaining_commitment', t='capital_call')}, 0) AS DECIMAL(24,2)) AS remaining FROM doc_final WHERE confirmed_amount IS NOT NULL GROUP BY fund_id)"""
_OWNED_USD = "CAST(CASE WHEN a.currency = 'USD' THEN CAST(r.{c} AS DECIMAL(28,8)) ELSE CAST(r.{c} * coalesce(f1.rate, f2.rate) AS DECIMAL(28,8)) END * o.ownership_pct AS DECIMAL(24,2)) AS {name}"


def _funds(m: Model) -> DataFrame:
    rows = documents.rolled_up(_confirmed(m)).withColumn("account_id", F.col("fund_id")).withColumn("fund_name", F.concat(F.lit("Fund "), F.col("fund_id").cast("string")))
    return rows.join(m["accounts"].select("account_id", "currency"), "account_id")


@query(f"""SELECT o.client_id, o.client_name, r.fund_id, concat('Fund ', r.fund_id) AS fund_name, a.account_id, a.currency, r.inception_date, r.as_of, {', '.join(_OWNED_USD.format(c=c, name=n) for c, n in documents.IN_DOLLARS.items())}, r.moic, r.pending_review_documents
    FROM (SELECT * FROM ({_ROLL}) JOIN ({_COMMITTED}) USING (fund_id)) r JOIN owners o ON o.account_id = r.fund_id JOIN accounts a ON a.account_id = r.fund_id LEFT JOIN fx f1 ON f1.as_of = r.as_of LEFT JOIN fx f2 ON f2.as_of = r.inception_date""")
def alts_holdings(m):
    return documents.holdings(_funds(m), m["owners"], _rates(m))


@query("SELECT * FROM alts_daily")
def alts_daily(m):
    """Each client's marks carried forward to its days."""
    return wealth.alternatives_daily(_alts(m), _pos_owned(m))


@query("SELECT g.as_of, CAST(sum(coalesce(nav, 0)) AS DECIMAL(24,2)) AS nav FROM (SELECT day AS as_of FROM days WHERE day >= DATE '1995-06-01' AND extract(day FROM day) = 1) g CROSS JOIN (SELECT DISTINCT fund_id FROM fund_docs WHERE doc_type = 'capital_account_statement') f ASOF LEFT JOIN (SELECT fund_id, doc_date, max(ending) AS nav FROM fund_docs WHERE doc_type = 'capital_account_statement' AND ending IS NOT NULL GROUP BY fund_id, doc_date) s ON s.fund_id = f.fund_id AND s.doc_date <= g.as_of GROUP BY g.as_of")
def nav_forward_fill(m):
    asked = m["days"].where((F.col("day") >= "1995-06-01") & (F.dayofmonth("day") == 1)).select(F.col("day").alias("as_of"))
    return documents.nav_by_day(m["fund_docs"].where("doc_type = 'capital_account_statement'"), asked)


@query("SELECT document, CASE WHEN regexp_matches(t, '^-?[0-9]+(\\.[0-9]+)?$') THEN CAST(t AS DECIMAL(24,2)) END AS value FROM (SELECT document, CASE WHEN k % 7 = 0 THEN 'n/a' ELSE CAST(total AS VARCHAR) END AS t FROM fund_rows)")
def tolerant_amounts(m):
    text = F.when(F.col("k") % 7 == 0, "n/a").otherwise(F.concat(F.lit(" $"), F.format_number("total", 2)))
    return m["fund_rows"].select("document", tolerant_decimal(text).alias("value"))


# --- registry, filings, serving ----------------------------------------------------------------------------------


@query("SELECT n.file_path, n.size_bytes, n.sha256, CASE WHEN o.sha256 IS NULL THEN 'new' WHEN o.sha256 <> n.sha256 THEN 'restated' ELSE 'unchanged' END AS status FROM registry_new n LEFT JOIN registry_old o ON o.file_path = n.file_path")
def registry_diff(m):
    return registry.diff(m["registry_old"], m["registry_new"])


@query("SELECT file_path, sha256, size_bytes FROM registry_old WHERE file_path NOT IN (SELECT file_path FROM registry_new WHERE file_path % 11 = 0 OR file_path % 17 = 0) UNION ALL SELECT file_path, sha256, size_bytes FROM registry_new WHERE file_path % 11 = 0 OR file_path % 17 = 0")
def registry_supersede(m):
    arrived = registry.diff(m["registry_old"], m["registry_new"]).where("status <> 'unchanged'").drop("status")
    return registry.superseded(m["registry_old"], arrived)


@query("SELECT status, count(*) AS files, min(size_bytes) AS least, max(size_bytes) AS most FROM (SELECT n.size_bytes, CASE WHEN o.sha256 IS NULL THEN 'new' WHEN o.sha256 <> n.sha256 THEN 'restated' ELSE 'unchanged' END AS status FROM registry_new n LEFT JOIN registry_old o ON o.file_path = n.file_path) GROUP BY status")
def registry_summary(m):
    return registry.diff(m["registry_old"], m["registry_new"]).groupBy("status").agg(F.count("*").alias("files"), F.min("size_bytes").alias("least"), F.max("size_bytes").alias("most"))


@query("SELECT a.account_id AS cik, DATE '1998-06-30' AS as_of, max(f.accession) FILTER (f.filing_date = l.d) AS accession FROM accounts a LEFT JOIN (SELECT cik, max(filing_date) AS d FROM filings WHERE filing_date <= DATE '1998-06-30' GROUP BY cik) l ON l.cik = a.account_id LEFT JOIN filings f ON f.cik = a.account_id GROUP BY a.account_id")
def filing_as_of(m):
    asked = m["accounts"].select(F.col("account_id").alias("cik"), F.lit("1998-06-30").cast("date").alias("as_of"))
    return registry.latest_before(asked, m["filings"], "cik", "as_of", "filing_date", "accession")


_HELD = "SELECT accession, cusip, arg_min(issuer, (line, issuer, title_of_class)) AS issuer, arg_min(title_of_class, (line, issuer, title_of_class)) AS title_of_class, CAST(sum(shares) AS DECIMAL(24,2)) AS shares, CAST(sum(value) AS DECIMAL(24,2)) AS value FROM filing_rows WHERE kind = 'SH' AND put_call IS NULL GROUP BY accession, cusip"


@query(_HELD)
def table_13f_aggregate(m):
    return registry.information_table(m["filing_rows"])


_DIGITS = "list_reduce(list_transform(generate_series(1, length({d})), lambda i: CASE WHEN i % 2 = {p} THEN (CASE WHEN CAST(substr({d}, length({d}) - i + 1, 1) AS INTEGER) > 4 THEN 2 * CAST(substr({d}, length({d}) - i + 1, 1) AS INTEGER) - 9 ELSE 2 * CAST(substr({d}, length({d}) - i + 1, 1) AS INTEGER) END) ELSE CAST(substr({d}, length({d}) - i + 1, 1) AS INTEGER) END), lambda x, y: x + y)"
_WIDE = "array_to_string(list_transform(string_split({t}, ''), lambda c: CASE WHEN c >= 'A' THEN CAST(ascii(c) - 55 AS VARCHAR) ELSE c END), '')"
_ISIN = f"SELECT cusip, d, CASE WHEN cusip NOT LIKE 'G%' THEN 'US' || cusip || CAST((10 - {_DIGITS.format(d='d', p=1)} % 10) % 10 AS VARCHAR) END AS isin FROM (SELECT cusip, {_WIDE.format(t="('US' || cusip)")} AS d FROM (SELECT DISTINCT cusip FROM filing_rows))"


@query(f"SELECT cusip, isin FROM ({_ISIN})")
def isin_derive(m):
    return m["filing_rows"].select("cusip").distinct().select("cusip", identifiers.isin_from_cusip(F.col("cusip")).alias("isin"))


@query(f"SELECT text, {_DIGITS.format(d='w', p=0)} % 10 = 0 AS valid FROM (SELECT text, {_WIDE.format(t='text')} AS w FROM (SELECT 'US' || cusip || CAST(CAST(substr(cusip, 9, 1) AS INTEGER) AS VARCHAR) AS text FROM (SELECT DISTINCT cusip FROM filing_rows)))")
def isin_checksum(m):
    text = F.concat(F.lit("US"), F.col("cusip"), F.substring("cusip", 9, 1))
    return m["filing_rows"].select("cusip").distinct().select(text.alias("text")).select("text", identifiers.isin_valid(F.col("text")).alias("valid"))


@query("SELECT DISTINCT cusip FROM filing_rows WHERE cusip NOT LIKE 'G%'")
def universe_domestic(m):
    return m["filing_rows"].where(~identifiers.is_foreign(F.col("cusip"))).select("cusip").distinct()


def _dollars(rows: DataFrame) -> DataFrame:
    return rows.withColumn("currency", F.lit("USD"))


_PARSED = "SELECT file_path, 'PARSED' AS status, as_of, CAST(account_id AS VARCHAR) AS account_id, security_scheme, security_id, security_name, quantity, price_amount, 'USD' AS price_ccy, price_as_of, market_value, 'USD' AS market_value_ccy, cost_basis FROM {feed}"
_PARSED_COLUMNS = ("file_path", "status", "as_of", "account_id", "security_scheme", "security_id", "security_name", "quantity", "price_amount", "price_ccy", "price_as_of", "market_value", "market_value_ccy", "cost_basis")


@query(_PARSED.format(feed="feed_a"))
def semt_parse(m):
    return feeds.parse_holdings_xml(feeds.holdings_xml(_dollars(m["feed_a"]))).select(*_PARSED_COLUMNS)


@query(_PARSED.format(feed="feed_b"))
def mt535_parse(m):
    return feeds.parse_holdings_swift(feeds.holdings_swift(_dollars(m["feed_b"]))).select(*_PARSED_COLUMNS)


@query("SELECT as_of, CAST(account_id AS VARCHAR) AS account_id, transaction_id, type, trade_date, settlement_date, amount, currency, CASE WHEN type IN ('BUY', 'FEE', 'TRANSFER_OUT') THEN 'DBIT' ELSE 'CRDT' END AS credit_debit, description FROM clean_entries")
def camt_parse_entries(m):
    return feeds.parse_cash_entries(feeds.cash_xml(m["clean_entries"], m["balances"])).drop("file_path", "status", "error", "statement_id")


@query("SELECT as_of, CAST(account_id AS VARCHAR) AS account_id, balance_type, amount, currency FROM balances")
def camt_parse_balances(m):
    return feeds.parse_cash_balances(feeds.cash_xml(m["clean_entries"], m["balances"])).drop("file_path", "status", "error", "statement_id")


@query("SELECT CASE WHEN account_id % 7 = 0 THEN 'FAILED' ELSE 'PARSED' END AS status, count(*) AS files FROM (SELECT DISTINCT as_of, account_id FROM feed_a) GROUP BY account_id % 7 = 0")
def parse_failures(m):
    cut = F.when(F.split("file_path", "/")[1].cast("long") % 7 == 0, F.expr("substr(text, 1, 30)")).otherwise(F.col("text"))
    files = feeds.holdings_xml(_dollars(m["feed_a"])).withColumn("text", cut)
    return feeds.parse_holdings_xml(files).groupBy("status").agg(F.countDistinct("file_path").alias("files"))


_QUEUE = "SELECT fund_id, document, coalesce(o.status, 'pending') AS status, CASE WHEN (o.status IS NOT NULL AND o.status <> 'pending') OR n.document IS NULL THEN o.amount ELSE n.amount END AS amount, coalesce(n.document IS NULL AND o.status = 'pending', false) AS stale FROM queue_old o FULL JOIN queue_new n USING (fund_id, document)"


@query(_QUEUE)
def review_queue_merge(m):
    return _queue(m)


@query(f"SELECT fund_id, count(*) AS pending FROM ({_QUEUE}) WHERE status = 'pending' AND NOT stale GROUP BY fund_id")
def review_pending(m):
    return _queue(m).where("status = 'pending' AND NOT stale").groupBy("fund_id").agg(F.count("*").alias("pending"))


@query(f"SELECT q.fund_id, q.document, CASE WHEN d.status IS NOT NULL AND q.status = 'pending' THEN d.status ELSE q.status END AS status, CASE WHEN d.status IS NOT NULL AND q.status = 'pending' THEN (CASE WHEN d.status = 'approved' THEN q.amount ELSE d.final_amount END) END AS final_amount, d.status IS NOT NULL AND q.status <> 'pending' AS conflict FROM ({_QUEUE}) q LEFT JOIN decisions d ON d.fund_id = q.fund_id AND d.document = q.document")
def review_decide(m):
    return registry.decide(_queue(m), m["decisions"])


@query("SELECT client_id, as_of, total_wealth_usd FROM wealth WHERE client_id IN (SELECT client_id FROM clients WHERE tenant_id = 2)")
def tenant_projection(m):
    return registry.of_tenant(_wealth(m), m["clients"], 2).select("client_id", "as_of", "total_wealth_usd")


@query("SELECT DISTINCT client_id FROM wealth WHERE client_id NOT IN (SELECT client_id FROM clients WHERE tenant_id <> 3)")
def clients_unclaimed(m):
    """Clients with wealth whom no tenant claims, where one tenant is left out."""
    return registry.unclaimed(_wealth(m), m["clients"].where("tenant_id <> 3"))


@query("SELECT event_type, count(*) AS n, CAST(sum(CAST(json_extract_string(props, '$.k') AS INTEGER)) AS BIGINT) AS total FROM events GROUP BY event_type")
def events_json(m):
    return m.table("events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").cast("int")).alias("total"))


# --- the securities master ---------------------------------------------------------------------------------------

_UNIVERSE = f"SELECT cusip, concat(country, cusip, CAST((10 - {_DIGITS.format(d='d', p=1)} % 10) % 10 AS VARCHAR)) AS isin FROM (SELECT cusip, country, {_WIDE.format(t='(country || cusip)')} AS d FROM (SELECT u.cusip, coalesce(d.country, 'US') AS country FROM (SELECT DISTINCT cusip FROM filing_rows WHERE cusip NOT LIKE 'G%') u LEFT JOIN domiciles d ON d.cusip = u.cusip))"


@query(_UNIVERSE)
def master_universe(m):
    """The ISIN of every security in the filings whose issuer's country is known."""
    return master.universe(m["filing_rows"], m["domiciles"])


@query(f"SELECT isin, k % 7 <> 0 AS mapped, CASE WHEN k % 7 <> 0 THEN concat('BBG', lpad(CAST(k AS VARCHAR), 9, '0')) END AS figi, CASE WHEN k % 7 <> 0 THEN concat('Name ', k) END AS name, CASE WHEN k % 7 <> 0 THEN 'Common Stock' END AS security_type, CASE WHEN k % 7 <> 0 THEN 'Equity' END AS market_sector, CASE WHEN k % 7 <> 0 THEN concat('T', k) END AS ticker, CASE WHEN k % 7 <> 0 THEN 'US' END AS exchange_code FROM (SELECT isin, CAST(substr(cusip, 2, 8) AS BIGINT) AS k FROM ({_UNIVERSE}))")
def master_entries(m):
    """An entry for each ISIN; some have two matches, of which the first counts, and some none."""
    isins = master.universe(m["filing_rows"], m["domiciles"])
    k = F.substring("cusip", 2, 8).cast("long")
    match = lambda place, end: F.struct(F.lit(place).alias("place"), F.concat(F.lit("BBG"), F.lpad(k.cast("string"), 9, "0"), F.lit(end)).alias("figi"), F.concat(F.lit("Name "), k.cast("string"), F.lit(end)).alias("name"), F.lit("Common Stock").alias("security_type"), F.lit("Equity").alias("market_sector"), F.concat(F.lit("T"), k.cast("string")).alias("ticker"), F.lit("US").alias("exchange_code"))
    found = isins.where(k % 7 != 0).select("isin", F.explode(F.array(match(1, "-2"), match(0, ""))).alias("x")).select("isin", "x.*")
    return master.assembled(isins, found)


@query("SELECT scheme, value, CASE scheme WHEN 'ISIN' THEN regexp_full_match(upper(trim(value)), '[A-Z]{2}[A-Z0-9]{9}[0-9]') WHEN 'CUSIP' THEN regexp_full_match(upper(trim(value)), '[A-Z0-9]{9}') WHEN 'SEDOL' THEN regexp_full_match(upper(trim(value)), '[A-Z0-9]{7}') WHEN 'TICKER' THEN regexp_full_match(upper(trim(value)), '[A-Z0-9.-]{1,12}') WHEN 'FIGI' THEN regexp_full_match(upper(trim(value)), '[A-Z0-9]{12}') ELSE false END AS well_formed FROM (SELECT DISTINCT CASE l_linenumber WHEN 1 THEN 'ISIN' WHEN 2 THEN 'CUSIP' WHEN 3 THEN 'SEDOL' WHEN 4 THEN 'TICKER' WHEN 5 THEN 'FIGI' ELSE 'WKN' END AS scheme, CASE l_linenumber WHEN 1 THEN concat(' us', lpad(CAST(l_partkey AS VARCHAR), 10, '0')) WHEN 2 THEN concat('G', l_partkey) ELSE concat('BBG', lpad(CAST(l_partkey AS VARCHAR), 9, 'x')) END AS value FROM lineitem)")
def identifier_shapes(m):
    n, k = F.col("l_linenumber"), F.col("l_partkey").cast("string")
    scheme = F.coalesce(F.when(n == 1, "ISIN").when(n == 2, "CUSIP").when(n == 3, "SEDOL").when(n == 4, "TICKER").when(n == 5, "FIGI"), F.lit("WKN"))
    value = F.when(n == 1, F.concat(F.lit(" us"), F.lpad(k, 10, "0"))).when(n == 2, F.concat(F.lit("G"), k)).otherwise(F.concat(F.lit("BBG"), F.lpad(k, 9, "x")))
    return m.table("lineitem").select(scheme.alias("scheme"), value.alias("value")).distinct().withColumn("well_formed", identifiers.well_formed(F.col("scheme"), F.col("value")))


# --- fund books, defects, deliveries -----------------------------------------------------------------------------

_CALLED = "CASE q {} ELSE 0 END".format(" ".join(f"WHEN {q} THEN CAST(c * {s} AS DECIMAL(24,2))" for q, s in fund_book.CALLS))
_WHOLE = " + ".join(f"CAST(c * {s} AS DECIMAL(24,2))" for _, s in fund_book.CALLS)
_GAIN = "CASE q {} END".format(" ".join(f"WHEN {q} THEN CAST({g} AS DECIMAL(6,4))" for q, g in enumerate(fund_book.GAINS, 1)))
_QUARTER = "CAST(last_day(make_date(vintage, 1, 1) + to_months(q * 3 - 1)) AS DATE)"
_BOOK = f"""WITH RECURSIVE funds AS (SELECT c_custkey AS fund_id, CAST(1000000 + c_custkey * CAST(12345.67 AS DECIMAL(9,2)) AS DECIMAL(24,2)) AS c, 1995 + c_custkey % 5 AS vintage FROM customer),
    grid AS (SELECT fund_id, c, vintage, q, CAST({_CALLED} AS DECIMAL(24,2)) AS contributions, CAST(CASE q WHEN 7 THEN CAST(({_WHOLE}) * 0.05 AS DECIMAL(24,2)) WHEN 9 THEN CAST(({_WHOLE}) * 0.08 AS DECIMAL(24,2)) ELSE 0 END AS DECIMAL(24,2)) AS distributions, {_GAIN} AS gain, CAST(CAST(c * 0.02 AS DECIMAL(28,6)) / 4 AS DECIMAL(24,2)) AS fees FROM funds, (SELECT CAST(unnest(range(1, 11)) AS INTEGER) AS q) WHERE true),
    moved AS (SELECT *, CASE WHEN q = 9 THEN distributions ELSE CAST(0 AS DECIMAL(24,2)) END AS realized, CAST(sum(contributions) OVER (PARTITION BY fund_id ORDER BY q) AS DECIMAL(24,2)) AS called FROM grid),
    book(fund_id, q, beginning, unrealized, ending) AS (SELECT fund_id, 0, CAST(0 AS DECIMAL(24,2)), CAST(0 AS DECIMAL(24,2)), CAST(0 AS DECIMAL(24,2)) FROM funds UNION ALL
        SELECT fund_id, q, beginning, unrealized, CAST(before + realized + unrealized AS DECIMAL(24,2)) FROM (SELECT fund_id, q, beginning, before, realized, CAST(before * gain AS DECIMAL(24,2)) AS unrealized FROM (SELECT b.fund_id, m.q, b.ending AS beginning, CAST(b.ending + m.contributions - m.distributions - m.fees AS DECIMAL(24,2)) AS before, m.realized, m.gain FROM book b JOIN moved m ON m.fund_id = b.fund_id AND m.q = b.q + 1)))"""


@query(f"{_BOOK} SELECT m.fund_id, {_QUARTER.replace('q *', 'm.q *')} AS period_end, b.beginning AS beginning_balance, m.contributions, m.distributions, m.fees AS management_fees, m.realized AS realized_gain_loss, b.unrealized AS unrealized_gain_loss, b.ending AS ending_balance, m.c AS total_commitment, CAST(m.c - m.called AS DECIMAL(24,2)) AS unfunded_commitment FROM moved m JOIN book b ON b.fund_id = m.fund_id AND b.q = m.q")
def fund_book_statements(m):
    return fund_book.statements(m["commitments"])


@query(f"""{_BOOK} SELECT fund_id, 'capital_call' AS kind, CAST(row_number() OVER (PARTITION BY fund_id ORDER BY q) AS INTEGER) AS number, {_QUARTER} AS notice_date, CAST({_QUARTER} + 14 AS DATE) AS due_date, contributions AS amount, called AS cumulative, CAST(c - called AS DECIMAL(24,2)) AS remaining_commitment, CAST(NULL AS VARCHAR) AS source, CAST(NULL AS BOOLEAN) AS recallable FROM moved WHERE contributions > 0
    UNION ALL SELECT fund_id, 'distribution', CAST(row_number() OVER (PARTITION BY fund_id ORDER BY q) AS INTEGER), {_QUARTER}, NULL, distributions, CAST(sum(distributions) OVER (PARTITION BY fund_id ORDER BY q) AS DECIMAL(24,2)), NULL, CASE q WHEN 7 THEN 'RETURN_OF_CAPITAL' ELSE 'CAPITAL_GAIN' END, q = 7 FROM moved WHERE distributions > 0""")
def fund_book_notices(m):
    return fund_book.notices(m["commitments"])


SEED = 7
_HIT = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY defect, as_of, account_id ORDER BY md5(concat('{seed}:', defect, ':', {target})), {target}) AS nth FROM ({rows})) WHERE nth = 1 AND CAST('0x' || substr(md5(concat('{seed}:', defect, ':{fmt}:', account_id, ':', as_of)), 1, 13) AS BIGINT) / 4503599627370496.0 < 0.25"
_BAD_HOLDINGS = _HIT.format(seed=SEED, target="security_id", fmt="MT535", rows="SELECT f.*, defect FROM feed_b f, (SELECT unnest(['MISSING_COST_BASIS', 'MISTYPED_ISIN', 'STALE_PRICE']) AS defect) WHERE defect <> 'MISSING_COST_BASIS' OR cost_basis IS NOT NULL")
_BAD_CASH = _HIT.format(seed=SEED, target="transaction_id", fmt="camt.053", rows="SELECT e.*, defect FROM clean_entries e, (SELECT unnest(['DUPLICATE_TRANSACTION', 'DROPPED_TRANSACTION', 'SETTLEMENT_SHIFT']) AS defect) WHERE true")


@query(f"SELECT as_of, account_id, defect, security_id AS target_id, CASE defect WHEN 'MISSING_COST_BASIS' THEN concat('cost_basis ', cost_basis, ' -> None') WHEN 'MISTYPED_ISIN' THEN concat(security_id, ' -> ', substr(security_id, 1, 11), (CAST(substr(security_id, 12, 1) AS INTEGER) + 1) % 10) ELSE concat('price_as_of ', price_as_of, ' -> ', CAST(price_as_of - 5 AS DATE)) END AS detail FROM ({_BAD_HOLDINGS})")
def defects_holdings(m):
    """The manifest of defects in SWIFT statements."""
    return defects.holdings(m["feed_b"], SEED, "MT535")[1]


@query(f"SELECT as_of, account_id, defect, transaction_id AS target_id, CASE defect WHEN 'SETTLEMENT_SHIFT' THEN concat('settlement_date ', settlement_date, ' -> ', CAST(settlement_date + 1 AS DATE)) WHEN 'DROPPED_TRANSACTION' THEN concat('entry dropped (', type, ', ', amount, ')') ELSE concat('entry duplicated (', type, ', ', amount, ')') END AS detail FROM ({_BAD_CASH})")
def defects_cash(m):
    return defects.cash(m["clean_entries"], SEED)[1]


@query(f"SELECT e.as_of, e.account_id, count(*) + coalesce(max(more), 0) - coalesce(max(less), 0) AS entries FROM clean_entries e LEFT JOIN (SELECT as_of, account_id, count_if(defect = 'DUPLICATE_TRANSACTION') AS more, count_if(defect = 'DROPPED_TRANSACTION') AS less FROM ({_BAD_CASH}) GROUP BY ALL) USING (as_of, account_id) GROUP BY e.as_of, e.account_id HAVING count(*) + coalesce(max(more), 0) - coalesce(max(less), 0) > 0")
def defects_cash_effect(m):
    """Entries a statement after duplicates and drops."""
    return defects.cash(m["clean_entries"], SEED)[0].groupBy("as_of", "account_id").agg(F.count("*").alias("entries"))


@query("SELECT format, files, files AS parsed FROM (SELECT 'semt.002' AS format, count(DISTINCT file_path) AS files FROM feed_a WHERE as_of < DATE '1996-01-01' UNION ALL SELECT 'MT535', count(DISTINCT file_path) FROM feed_b WHERE as_of < DATE '1996-01-01' UNION ALL SELECT 'camt.053', count(DISTINCT as_of) FROM balances WHERE as_of < DATE '1996-01-01')")
def day_delivery(m):
    """The files of a year's days with defects in them, rendered and read again: a statement for each account and format, and one of cash a day."""
    year = lambda rows: rows.where("as_of < DATE '1996-01-01'")
    bad = lambda feed, fmt: _dollars(defects.holdings(year(m[feed]), SEED, fmt)[0])
    read = [
        feeds.parse_holdings_xml(feeds.holdings_xml(bad("feed_a", "semt.002"))).select(F.lit("semt.002").alias("format"), "file_path", "status"), feeds.parse_holdings_swift(feeds.holdings_swift(bad("feed_b", "MT535"))).select(F.lit("MT535").alias("format"), "file_path", "status"),
        feeds.parse_cash_entries(feeds.cash_xml(defects.cash(year(m["clean_entries"]), SEED)[0], year(m["balances"]))).select(F.lit("camt.053").alias("format"), "file_path", "status"),
    ]
    every = read[0].unionByName(read[1]).unionByName(read[2])
    return every.groupBy("format").agg(F.countDistinct("file_path").alias("files"), F.countDistinct(F.when(F.col("status") == "PARSED", F.col("file_path"))).alias("parsed"))


def _share(name: str) -> str:
    return f"CAST('0x' || substr(sha256(concat('{name}:', accession, ':', cusip)), 1, 13) AS BIGINT) / 4503599627370496.0"


@query(f"SELECT account_id, cusip, quantity, price, market_value, CASE WHEN known >= 0.2 THEN CAST(market_value * CAST(floor(70 + 40 * cost) AS DECIMAL(9,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(24,2)) END AS cost_basis FROM (SELECT *, CAST(quantity * price AS DECIMAL(24,2)) AS market_value FROM (SELECT accession AS account_id, cusip, CAST((CAST(shares AS BIGINT) + 1) // 2 AS DECIMAL(24,6)) AS quantity, CAST(CAST((2 * CAST(value * 100 AS BIGINT) + CAST(shares AS BIGINT)) // (2 * CAST(shares AS BIGINT)) AS DOUBLE) / 100 AS DECIMAL(24,2)) AS price, {_share('known')} AS known, {_share('cost')} AS cost FROM ({_HELD})))")
def book_positions(m):
    """Half of the reported shares of each filing as an account's positions, with a cost basis for most."""
    return book.positions(registry.information_table(m["filing_rows"]).withColumnRenamed("accession", "account_id"), 2)


@query("SELECT day, isodow(day) < 6 AS business, coalesce(day = min(CASE WHEN isodow(day) < 6 THEN day END) OVER (PARTITION BY date_trunc('month', day)), false) AS contribution, coalesce(day = min(CASE WHEN isodow(day) < 6 AND extract(day FROM day) >= 18 THEN day END) OVER (PARTITION BY date_trunc('month', day)), false) AS withdrawal, day = last_day(day) AND extract(month FROM day) % 3 = 0 AS quarter_end FROM days")
def cash_calendar(m):
    return book.cash_calendar(m["days"])


@query("SELECT f.fund_id, f.document, sha256(f.document) AS sha256 FROM fund_docs f JOIN doc_judged j ON j.fund_id = f.fund_id AND j.document = f.document WHERE NOT j.auto")
def review_documents(m):
    """The files that reviewers need to see: those of documents that wait for a review."""
    held = m["fund_docs"].select("fund_id", F.col("document").alias("file_name"), F.sha2("document", 256).alias("sha256"))
    waiting = _judged(m).where("routing = 'needs_review'").select(F.col("fund_id").alias("f"), "document")
    return held.join(waiting, (F.col("fund_id") == F.col("f")) & (F.col("file_name") == F.col("document"))).select("fund_id", "document", "sha256")


# --- display and serving -----------------------------------------------------------------------------------------


@query("SELECT o_orderkey AS k, CAST(v AS DECIMAL(18,2)) AS half_up, CAST(round_even(CAST(v AS DOUBLE), 2) AS DECIMAL(18,2)) AS half_even FROM (SELECT o_orderkey, CAST(CAST(o_orderkey AS DECIMAL(15,0)) * CAST(0.125 AS DECIMAL(4,3)) AS DECIMAL(18,3)) AS v FROM orders)")
def rounding_rules(m):
    value = (F.col("o_orderkey").cast("decimal(15,0)") * F.lit("0.125").cast("decimal(4,3)")).cast("decimal(18,3)")
    return m.table("orders").select(F.col("o_orderkey").alias("k"), quantized(value).cast("decimal(18,2)").alias("half_up"), quantized(value, half_even=True).cast("decimal(18,2)").alias("half_even"))


@query("SELECT o_orderkey AS k, concat(CASE WHEN v < 0 THEN '-$' ELSE '$' END, format('{:,}', CAST(abs(v) AS BIGINT))) AS money, concat(CAST(o_orderkey % 1000 / CAST(800 AS DOUBLE) * 100 AS DECIMAL(10,1)), '%') AS share, concat(CAST(o_orderkey % 64 / 16.0 AS DECIMAL(10,2)), 'x') AS multiple, strftime(CAST(o_orderdate AS DATE), '%d %b %Y') AS day, strftime(CAST(o_orderdate AS DATE), '%b %Y') AS month FROM (SELECT *, round(CASE WHEN o_orderkey % 3 = 0 THEN -1 ELSE 1 END * CAST(o_totalprice AS DECIMAL(18,2)), 0) AS v FROM orders)")
def display_labels(m):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    amount = F.when(k % 3 == 0, -1).otherwise(1) * F.col("o_totalprice").cast("decimal(18,2)")
    return m.table("orders").select(k.alias("k"), labels.money(amount).alias("money"), labels.percent((k % 1000) / 800.0).alias("share"), labels.multiple((k % 64) / 16.0).alias("multiple"), labels.long_date(day).alias("day"), labels.month(day).alias("month"))


@query("SELECT source_format AS format, status, count(*) AS files, min(statement_date) AS first_day, max(statement_date) AS last_day FROM deliveries GROUP BY source_format, status")
def registry_formats(m):
    found = m["deliveries"].groupBy(F.col("source_format").alias("format"), "status").agg(F.count("*").alias("files"), F.min("statement_date").alias("first_day"), F.max("statement_date").alias("last_day"))
    return serving.ordered(found, "format", "status")


@query("SELECT (SELECT count(*) FROM balances) AS balances, (SELECT count(*) FROM cash) AS transactions, (SELECT count(*) FROM balances b JOIN owners o ON o.account_id = b.account_id) AS balance_owner_rows, (SELECT count(*) FROM cash_owned) AS txn_owner_rows, (SELECT count(DISTINCT currency) FROM balances) AS currencies")
def cash_dashboard(m):
    """Counts of the cash tables side by side; each is one row, so their cross join is one."""
    owned = conform.cash_owners(m["balances"], "amount", m["owners"])
    moved = conform.collapsed(m["entries"])
    of = lambda rows, name: rows.agg(F.count("*").alias(name))
    return m["balances"].agg(F.count("*").alias("balances"), F.countDistinct("currency").alias("currencies")).crossJoin(of(moved, "transactions")).crossJoin(of(owned, "balance_owner_rows")).crossJoin(of(_moves(m), "txn_owner_rows"))


@query("SELECT fund_id, document, doc_type, sequence_number, doc_date AS period_end, concat('{\"amount\":', CASE WHEN amount IS NULL THEN 'null' ELSE concat('\"', amount, '\"') END, '}') AS fields_json, CAST(confidence AS DECIMAL(5,4)) AS confidence, validation_notes FROM doc_judged WHERE NOT auto")
def review_source(m):
    fields = F.to_json(F.struct(F.col("amount").cast("string").alias("amount")), {"ignoreNullFields": "false"})
    return registry.review_source(_judged(m).withColumn("period_end", F.col("doc_date")), m["fund_docs"].select("fund_id", "document", fields.alias("fields_json")))


@query(f"SELECT q.fund_id, q.document, CASE d.status WHEN 'approved' THEN 'approve' ELSE 'correct' END AS action, q.status AS status_before, d.status AS status_after, q.amount AS extracted_amount, CASE d.status WHEN 'approved' THEN q.amount ELSE d.final_amount END AS final_amount FROM ({_QUEUE}) q JOIN decisions d ON d.fund_id = q.fund_id AND d.document = q.document WHERE q.status = 'pending'")
def review_audit(m):
    return registry.audited(_queue(m), m["decisions"])


@query(f"SELECT q.fund_id, q.document, q.status, q.amount, f.doc_date AS loaded_at FROM ({_QUEUE}) q JOIN fund_docs f ON f.fund_id = q.fund_id AND f.document = q.document WHERE q.status = 'pending'")
def review_queue_pending(m):
    """The queue's pending items, newest first."""
    items = _queue(m).join(m["fund_docs"].select("fund_id", "document", F.col("doc_date").alias("loaded_at")), ["fund_id", "document"])
    return serving.queue(items.select("fund_id", "document", "status", "amount", "loaded_at"), "pending")


@query("SELECT * FROM dq WHERE metric <> 'bronze_days_behind'")
def serve_metrics(m):
    return serving.ordered(_metrics(m).where("metric <> 'bronze_days_behind'"), "dimension", "metric", "as_of")


@query(f"SELECT * FROM ({_ALLOCATION}) WHERE client_id = 3 AND as_of = (SELECT max(as_of) FROM pos_owned WHERE client_id = 3)")
def serve_allocation(m):
    """A client's classes on its latest day, largest first. Its accounts and its day prune all inputs."""
    own = m["owners"].where("client_id = 3").select("account_id")
    day = m["holdings"].join(own, "account_id", "left_semi").agg(F.max("as_of")).first()[0]
    return serving.of_client(wealth.allocation(_pos_owned(m, day), _closing(m, day), _alts(m), _rates(m)).where(F.col("as_of") == F.lit(day)), 3, "-weight", "asset_class")


@query("SELECT client_id, as_of, total_wealth_usd, external_flow_usd, round(r, 6) AS daily_twr_return, round(exp(sum(CASE WHEN r > -1 THEN ln(1 + r) ELSE 0 END) OVER (PARTITION BY client_id ORDER BY as_of ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 4) AS twr_index FROM perf_raw WHERE client_id = 3")
def serve_performance(m):
    return serving.of_client(_performance(m), 3, "as_of")


@query(f"SELECT o.client_id, concat('Fund ', r.fund_id) AS fund_name, r.inception_date, r.moic, r.pending_review_documents FROM ({_ROLL}) r JOIN owners o ON o.account_id = r.fund_id WHERE o.client_id = 3")
def serve_alternatives(m):
    """A client's funds by name."""
    return serving.of_client(documents.holdings(_funds(m), m["owners"], _rates(m)), 3, "fund_name").select("client_id", "fund_name", "inception_date", "moic", "pending_review_documents")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: _sql(text) for name, text in _SQL.items()}

