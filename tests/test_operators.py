"""Operators on small rows: invariants, edge cases and plans."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystone.functions import identifiers, labels
from tallystone.functions.money import quantized, to_usd, tolerant_decimal
from tallystone.operators import book, defects, documents, fund_book, fx, master, ownership, quality, registry, serving, wealth
from tallystone.plans import catalog
from tallystone.sources import feeds
from tallystone.sources.model import Model
from tallystone.streaming.arrivals import ingest


def test_isin_check_digits(spark):
    rows = spark.createDataFrame([("US0378331005", True), ("US0378331004", False), ("US5949181045", True), ("nonsense", False)], "isin string, want boolean")
    assert rows.where(identifiers.isin_valid(F.col("isin")) != F.col("want")).count() == 0
    made = spark.createDataFrame([("037833100",), ("G1151C101",)], "cusip string").select(identifiers.isin_from_cusip(F.col("cusip")).alias("i")).collect()
    assert [r["i"] for r in made] == ["US0378331005", None]


def test_unknown_currency_stops(spark):
    rows = spark.createDataFrame([(Decimal("1.00"), "CHF", Decimal("1.1"))], "a decimal(24,2), c string, r decimal(12,6)")
    with pytest.raises(Exception, match="no conversion"):
        rows.select(to_usd(F.col("a"), F.col("c"), F.col("r"))).collect()


def test_tolerant_amounts(spark):
    rows = spark.createDataFrame([("$1,234.50",), ("n/a",), (None,), ("",)], "t string").select(tolerant_decimal(F.col("t")).alias("v")).collect()
    assert [r["v"] for r in rows] == [Decimal("1234.50"), None, None, None]


def test_rates_fill_gaps_and_refuse_a_missing_start(spark):
    published = spark.createDataFrame([(dt.date(2026, 7, 1), Decimal("1.0873")), (dt.date(2026, 7, 3), Decimal("1.0899"))], "day date, rate decimal(12,6)")
    days = spark.createDataFrame([(dt.date(2026, 7, d),) for d in (2, 3, 4, 5)], "day date")
    got = {r["as_of"].day: (r["rate"], r["rate_date"].day) for r in fx.fill_forward(published, days).collect()}
    assert got == {2: (Decimal("1.087300"), 1), 3: (Decimal("1.089900"), 3), 4: (Decimal("1.089900"), 3), 5: (Decimal("1.089900"), 3)}
    with pytest.raises(Exception, match="no rate"):
        fx.fill_forward(published, spark.createDataFrame([(dt.date(2026, 6, 1),)], "day date")).collect()


def test_ownership_sums_over_paths(spark):
    edges = spark.createDataFrame([("C1", "E1", Decimal("0.7")), ("C2", "E1", Decimal("0.3")), ("C1", "E2", Decimal("1")), ("E1", "A1", Decimal("0.6")), ("E2", "A1", Decimal("0.4"))], "owner_id string, owned_id string, pct decimal(9,6)")
    got = {r["client"]: r["ownership_pct"] for r in ownership.effective(edges).collect()}
    assert got == {"C1": Decimal("0.820000"), "C2": Decimal("0.180000")}
    assert ownership.problems(edges).count() == 0
    assert ownership.problems(edges.where("owner_id <> 'C2'")).collect()[0]["problem"] == "incomplete"


def test_ownership_through_stacked_entities(spark):
    schema = "owner_id string, owned_id string, pct decimal(9,6)"
    edge = lambda a, b, p: (a, b, Decimal(p))
    rows = [edge("C1", "E1", "1"), edge("E1", "E2", "0.5"), edge("C2", "E2", "0.5"), edge("E2", "E3", "1"), edge("E3", "A1", "0.6"), edge("E1", "A1", "0.4"), edge("C2", "A2", "1")]
    edges = spark.createDataFrame(rows, schema)
    got = {(r["account"], r["client"]): r["ownership_pct"] for r in ownership.effective(edges).collect()}
    assert got == {("A1", "C1"): Decimal("0.700000"), ("A1", "C2"): Decimal("0.300000"), ("A2", "C2"): Decimal("1.000000")}
    known = spark.createDataFrame([("C1", "client"), ("E1", "entity"), ("E2", "entity"), ("E3", "entity"), ("A1", "account"), ("A3", "account")], "node string, kind string")
    found = {tuple(r) for r in ownership.problems(edges, known).collect()}
    assert found == {("unknown owner", "C2"), ("unknown owned", "A2"), ("unowned", "A3")}
    looped = spark.createDataFrame([edge("C1", "E1", "0.5"), edge("E2", "E1", "0.5"), edge("E1", "E2", "1"), edge("E2", "E3", "1"), edge("E3", "A1", "1")], schema)
    assert {tuple(r) for r in ownership.problems(looped).collect()} == {("cycle", "E1"), ("cycle", "E2")}
    with pytest.raises(ValueError, match="cycle"):
        ownership.effective(looped)


def test_single_day_has_no_money_weighted_return(spark):
    day = lambda c, d, w, f: (c, dt.date(2025, 1, 1) + dt.timedelta(days=d), Decimal(w), Decimal(f))
    perf = spark.createDataFrame([day(1, 0, 100, 0), day(1, 365, 110, 0), day(2, 0, 100, 0)], "client_id int, as_of date, total_wealth_usd decimal(24,2), external_flow_usd decimal(24,2)")
    got = {r["client_id"]: r["irr"] for r in wealth.xirr(perf).collect()}
    assert got[1] == pytest.approx(0.1, abs=1e-7) and got[2] is None


def test_findings_join_the_feeds_once(spark):
    m = Model(spark, "/root/testdata/sf0.001")
    plan = quality.findings(m["feed_a"], m["feed_b"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1
    one, two = quality.findings(m["feed_a"], m["feed_b"]), quality.findings_of_feeds(m["feeds"])
    assert one.count() == two.count() > 0 and one.exceptAll(two.select(*one.columns)).count() == 0


@pytest.mark.parametrize("name", ["wealth_daily", "dietz", "xirr", "dq_metrics", "recon_findings"])
def test_lines_are_read_once_a_use(spark, name):
    """Neither returns nor feeds compute their input again: a scan of the lines for positions, and in metrics one for findings and one for the register of files."""
    plan = catalog.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("l_partkey") > 0 and len(re.findall(r"Relation \[[^\]]*l_partkey", plan)) <= {"dq_metrics": 3}.get(name, 1)


def test_marks_are_carried_forward_by_fund_and_then_summed(spark):
    d = lambda n: dt.date(2026, 7, n)
    points = spark.createDataFrame([(1, 10, d(1), Decimal(100)), (1, 10, d(5), Decimal(130)), (1, 11, d(3), Decimal(7)), (2, 10, d(9), Decimal(5))], "client_id int, fund_id int, statement_date date, nav_usd decimal(24,2)")
    days = spark.createDataFrame([(c, d(n)) for c in (1, 2, 3) for n in (2, 3, 4, 6)], "client_id int, as_of date")
    got = {(r["client_id"], r["as_of"].day): r["alts_usd"] for r in wealth.alternatives_daily(points, days).collect()}
    assert got == {(1, 2): 100, (1, 3): 107, (1, 4): 107, (1, 6): 137} | {(c, n): 0 for c in (2, 3) for n in (2, 3, 4, 6)}


def test_metrics_have_a_row_for_each_delivered_day(spark):
    d = dt.date(2026, 7, 1)
    delivered = spark.createDataFrame([(d, "PARSED"), (d, "FAILED")], "statement_date date, status string")
    none = lambda columns: spark.createDataFrame([], columns)
    rows = quality.metrics(delivered, none("as_of date"), none("as_of date"), none("as_of date, conformed_consistent boolean"), none("as_of date, continuous boolean"), "2026-07-03", expected=11).collect()
    got = {r["metric"]: (r["dimension"], r["value"], r["passed"], r["detail"]) for r in rows}
    assert len(got) == len(rows) == 6  # continuity has nothing to compare
    assert got["files_landed_rate"] == ("completeness", Decimal("0.090909"), False, "1 of 11 expected files parsed")
    assert got["holdings_cross_format_match_rate"][1:] == (None, True, "0 cross-format findings across 0 positions")
    assert got["cash_integrity_breaks_count"][1:3] == (Decimal(0), None) and got["bronze_days_behind"][1:3] == (Decimal(2), True)


def test_every_order_is_a_fund_document_and_a_filing(spark):
    m = Model(spark, "/root/testdata/sf0.001")
    orders = m.table("orders").select("o_orderkey")
    assert orders.count() == 1500
    for name, key in (("fund_rows", "k"), ("fund_docs", "k"), ("filings", "accession")):
        made = m[name].select(F.col(key).alias("o_orderkey"))
        assert made.count() == 1500 and orders.exceptAll(made).count() == 0


def _paper(document, kind, number, day, **values):
    money = ("amount", "cumulative", "beginning", "contributions", "distributions", "management_fees", "realized", "unrealized", "ending", "remaining_commitment", "total_commitment", "unfunded_commitment")
    return (values.pop("fund", 1), document, kind, number, dt.date(2026, 1, day), 0.9, *(Decimal(values[m]) if m in values else None for m in money))


_PAPER = "fund_id long, document string, doc_type string, sequence_number int, doc_date date, self_reported double, " + ", ".join(
    f"{m} decimal(24,2)" for m in ("amount", "cumulative", "beginning", "contributions", "distributions", "management_fees", "realized", "unrealized", "ending", "remaining_commitment", "total_commitment", "unfunded_commitment")
)


def test_statements_need_all_their_parts(spark):
    parts = dict(beginning=100, contributions=50, distributions=20, management_fees=3, realized=4, unrealized=-1, ending=130)  # noqa: C408
    told = "capital_account_statement"
    rows = [_paper("whole", told, 1, 1, amount=30, **parts), _paper("wrong", told, 2, 2, amount=30, **(parts | {"management_fees": 5})), _paper("short", told, 3, 3, amount=30, **{k: v for k, v in parts.items() if k != "realized"})]
    rows += [_paper("call", "capital_call", 1, 1, amount=5, cumulative=5, remaining_commitment=95), _paper("bare", "capital_call", 2, 2, amount=5, cumulative=10), _paper("paid", "distribution", 1, 1, amount=5, cumulative=5)]
    got = {r["document"]: r["self_consistent"] for r in documents.judged(spark.createDataFrame(rows, _PAPER)).collect()}
    assert got == {"whole": True, "wrong": False, "short": False, "call": True, "bare": False, "paid": True}


def test_commitments_come_from_statements_or_calls(spark):
    rows = [_paper("c1", "capital_call", 1, 1, amount=5, cumulative=5, remaining_commitment=95), _paper("s1", "capital_account_statement", 1, 9, amount=1, ending=7, total_commitment=120, unfunded_commitment=115)]
    rows += [_paper("c2", "capital_call", 1, 1, fund=2, amount=5, cumulative=5, remaining_commitment=95), _paper("c3", "capital_call", 2, 2, fund=2, amount=10, cumulative=15, remaining_commitment=85)]
    known = spark.createDataFrame(rows, _PAPER).withColumn("routing", F.lit("auto_accept")).withColumn("confirmed_amount", F.col("amount")).withColumn("reviewed_status", F.lit(None).cast("string"))
    got = {r["fund_id"]: (r["as_of"], r["total_commitment"], r["unfunded_commitment"]) for r in documents.rolled_up(known).collect()}
    assert got == {1: (dt.date(2026, 1, 9), Decimal(120), Decimal(115)), 2: (None, Decimal(100), Decimal(85))}


def test_evaluation_scores_all_fields_and_counts_lost_documents(spark):
    truth = spark.createDataFrame([("a", "t", Decimal(1), 1, "x"), ("b", "t", Decimal(2), 2, "y"), ("c", "t", Decimal(3), 3, None)], "document string, doc_type string, amount decimal(24,2), number int, purpose string")
    docs = spark.createDataFrame([("a", Decimal(1), 1, "x"), ("b", Decimal(2), 9, None)], "document string, amount decimal(24,2), number int, purpose string")
    assert [tuple(r) for r in documents.evaluated(docs, truth).collect()] == [("t", 3, 2, 1, 0.666667)]


SEMT = f"""<?xml version="1.0" encoding="UTF-8"?>
<Document xmlns="{feeds.HOLDINGS_NS}">
  <SctiesBalCtdyRpt>
    <StmtGnlDtls><StmtId>H-1</StmtId><StmtDtTm><Dt>2026-07-01</Dt></StmtDtTm></StmtGnlDtls>
    <SfkpgAcct><Id>ACC-1</Id><Nm>Main &amp; Sons</Nm><AcctSvcr><AnyBIC>BANKUS33</AnyBIC></AcctSvcr><BaseCcy>USD</BaseCcy></SfkpgAcct>
    <BalForAcct>
      <FinInstrmId><ISIN>us0378331005</ISIN><Desc>Apple</Desc></FinInstrmId><AggtBal><Unit>220</Unit></AggtBal>
      <PricDtls><Val Ccy="USD">210.5</Val><Dt>2026-06-30</Dt></PricDtls><AcctBaseCcyAmts><HldgVal><Amt Ccy="USD">46310.00</Amt></HldgVal></AcctBaseCcyAmts>
    </BalForAcct>
    <BalForAcct><FinInstrmId><OthrId><Id>037833100</Id><Tp>CUSIP</Tp></OthrId><Desc>Bare</Desc></FinInstrmId><AggtBal><Unit>1.25</Unit></AggtBal></BalForAcct>
  </SctiesBalCtdyRpt>
</Document>"""

MT = """:16R:GENL
:20C::SEME//M-1
:23G:NEWM
:98A::STAT//20260701
:97A::SAFE//ACC-1
:16S:GENL
:16R:FIN
:35B:ISIN US0378331005
Apple
 Inc
:93B::AGGR//UNIT/220,
:90B::MRKT//ACTU/USD210,5
:98A::PRIC//20260630
:19A::HOLD//USD46310,00
:70E::HOLD//COST/USD40000,
:16S:FIN
:16R:FIN
:35B:ISIN US5949181045
Bare
:93B::AGGR//UNIT/1,25
:16S:FIN
"""

CAMT = f"""<Document xmlns="{feeds.CASH_NS}"><BkToCstmrStmt><GrpHdr><MsgId>x</MsgId></GrpHdr>
<Stmt><Id>C-1</Id><Acct><Id><Othr><Id>ACC-1</Id></Othr></Id><Ccy>EUR</Ccy></Acct>
  <Bal><Tp><CdOrPrtry><Cd>OPBD</Cd></CdOrPrtry></Tp><Amt Ccy="EUR">10.00</Amt><CdtDbtInd>CRDT</CdtDbtInd><Dt><Dt>2026-06-30</Dt></Dt></Bal>
  <Bal><Tp><CdOrPrtry><Cd>CLBD</Cd></CdOrPrtry></Tp><Amt Ccy="EUR">7.50</Amt><CdtDbtInd>CRDT</CdtDbtInd><Dt><Dt>2026-07-01</Dt></Dt></Bal>
  <Ntry><NtryRef>T1</NtryRef><Amt Ccy="EUR">2.50</Amt><CdtDbtInd>DBIT</CdtDbtInd><Sts><Cd>BOOK</Cd></Sts><BookgDt><Dt>2026-07-01</Dt></BookgDt><ValDt><Dt>2026-07-03</Dt></ValDt><BkTxCd><Prtry><Cd>FEE</Cd></Prtry></BkTxCd></Ntry>
</Stmt>
<Stmt><Id>C-2</Id><Acct><Id><Othr><Id>ACC-2</Id></Othr></Id></Acct><Bal><Tp><CdOrPrtry><Cd>OPBD</Cd></CdOrPrtry></Tp><Amt Ccy="USD">1</Amt><Dt><Dt>2026-07-02</Dt></Dt></Bal></Stmt>
</BkToCstmrStmt></Document>"""


def _one(spark, text):
    return spark.createDataFrame([("f", text)], "file_path string, text string")


def test_hand_written_statements_parse_with_all_fields(spark):
    d = dt.date
    rows = feeds.parse_holdings_xml(_one(spark, SEMT)).orderBy("security_scheme").collect()
    assert [r["status"] for r in rows] == ["PARSED"] * 2 and rows[0]["security_id"] == "037833100" and rows[0]["quantity"] == Decimal("1.25") and rows[0]["market_value"] is None and rows[0]["price_as_of"] is None
    got = rows[1].asDict()
    want = {"statement_id": "H-1", "as_of": d(2026, 7, 1), "account_id": "ACC-1", "account_name": "Main & Sons", "custodian_bic": "BANKUS33", "base_currency": "USD", "security_scheme": "ISIN", "security_id": "US0378331005", "security_name": "Apple"}
    assert want.items() <= got.items() and (got["price_amount"], got["price_ccy"], got["price_as_of"], got["market_value"], got["market_value_ccy"], got["cost_basis"]) == (Decimal("210.5"), "USD", d(2026, 6, 30), Decimal(46310), "USD", None)
    rows = feeds.parse_holdings_swift(_one(spark, MT.replace("\n", "\r\n"))).orderBy("security_id").collect()
    got = rows[0].asDict()
    assert (got["status"], got["statement_id"], got["account_id"], got["security_name"], got["quantity"], got["price_amount"], got["price_as_of"], got["market_value"], got["cost_basis"]) == ("PARSED", "M-1", "ACC-1", "Apple Inc", 220, Decimal("210.5"), d(2026, 6, 30), 46310, 40000)
    assert (rows[1]["quantity"], rows[1]["price_amount"], rows[1]["cost_basis"], rows[1]["as_of"]) == (Decimal("1.25"), None, None, d(2026, 7, 1))
    entries = {r["account_id"]: r for r in feeds.parse_cash_entries(_one(spark, CAMT)).collect()}
    assert (entries["ACC-1"]["type"], entries["ACC-1"]["settlement_date"], entries["ACC-1"]["as_of"], entries["ACC-1"]["credit_debit"]) == ("FEE", d(2026, 7, 3), d(2026, 7, 1), "DBIT")
    assert entries["ACC-2"]["transaction_id"] is None and entries["ACC-2"]["as_of"] == d(2026, 7, 2)  # no closing balance: the last one's day
    assert {(r["account_id"], r["balance_type"], r["amount"]) for r in feeds.parse_cash_balances(_one(spark, CAMT)).collect()} == {("ACC-1", "OPENING", 10), ("ACC-1", "CLOSING", Decimal("7.5")), ("ACC-2", "OPENING", 1)}


BAD = [
    (SEMT, "<Unit>220</Unit>", "<Unit>five</Unit>", "'five' is not a number in BalForAcct[0]"), (SEMT, "<Desc>Bare</Desc>", "", "missing Desc in BalForAcct[1]"), (SEMT, "<Tp>CUSIP</Tp>", "<Tp>WKN</Tp>", "unknown identifier scheme 'WKN'"),
    (SEMT, '<Val Ccy="USD">', "<Val>", "missing Ccy attribute in BalForAcct[0] price"), (SEMT, "<Dt>2026-07-01</Dt>", "<Dt>01.07.2026</Dt>", "is not an ISO date in StmtDtTm"), (SEMT, "<Id>ACC-1</Id>", "", "missing Id in SfkpgAcct"), (SEMT, "us0378331005", "US03", "is not shaped like a ISIN"),
    (SEMT, "semt.002", "semt.003", "unexpected root element"), (SEMT, "</SctiesBalCtdyRpt>\n</Document>", "", "not well-formed"),
    (MT, "220,", "22O,", "is not a SWIFT number in FIN[0]"), (MT, "USD210,5", "210,5", "is not a currency and an amount in FIN[0] price"), (MT, "ISIN US0378331005", "/XX/037833100", "no ISIN"), (MT, "\nBare", "", "missing description line in FIN[1]"), (MT, "20260701", "20261301", "is not a date in GENL"),
    (MT, ":97A::SAFE//ACC-1\n", "", "missing :97A::SAFE"), (MT, ":16S:GENL", "", "nested block"), (MT, ":16R:GENL\n", "lost\n:16R:GENL\n", "content outside any block"), (MT, ":16S:FIN\n:16R:FIN", ":16S:FOO\n:16R:FIN", "ends as FOO"), (MT, ":93B::AGGR//UNIT/1,25\n:16S:FIN\n", "", "unclosed block"),
    (CAMT, "<Cd>OPBD</Cd>", "<Cd>XXXX</Cd>", "unknown balance code 'XXXX' in Bal[0] of Stmt[0]"), (CAMT, "<Cd>FEE</Cd>", "<Cd>GIFT</Cd>", "unknown transaction code 'GIFT' in Ntry[0] of Stmt[0]"), (CAMT, "<NtryRef>T1</NtryRef>", "", "missing NtryRef"), (CAMT, "<Dt>2026-07-03</Dt>", "<Dt>soon</Dt>", "value date"),
    (CAMT, "<Id>C-2</Id>", "", "missing Id in Stmt[1]"),
]


def test_a_bad_field_fails_the_file_and_is_named(spark):
    """Each case breaks one place of a good file; all files of a format are parsed together."""
    for text, parsers in ((SEMT, [feeds.parse_holdings_xml]), (MT, [feeds.parse_holdings_swift]), (CAMT, [feeds.parse_cash_entries, feeds.parse_cash_balances])):
        cases = [(old, new, said) for of, old, new, said in BAD if of is text]
        assert all(old in text for old, _, _ in cases)
        files = spark.createDataFrame([(str(i), text.replace(old, new, 1)) for i, (old, new, _) in enumerate(cases)] + [("good", text)], "file_path string, text string")
        for parse in parsers:
            rows = parse(files).collect()
            bad = {r["file_path"]: r for r in rows if r["status"] == "FAILED"}
            assert len(bad) == len(cases) and len(rows) == len(cases) + 2 + (parse is feeds.parse_cash_balances)
            for i, (_, _, said) in enumerate(cases):
                assert bad[str(i)]["as_of"] is None and said in bad[str(i)]["error"], (said, bad[str(i)]["error"])


def test_rendered_values_are_escaped(spark):
    row = spark.createDataFrame([(dt.date(2026, 7, 1), "A<1", "ISIN", "US0378331005", 'x & <y> "z"', Decimal(1), None, None, None, "USD")], "as_of date, account_id string, security_scheme string, security_id string, security_name string, quantity decimal(24,6), price_amount decimal(24,6), price_as_of date, market_value decimal(24,2), currency string")
    got = feeds.parse_holdings_xml(feeds.holdings_xml(row)).collect()[0]
    assert (got["status"], got["account_id"], got["security_name"], got["price_amount"], got["market_value"]) == ("PARSED", "A<1", 'x & <y> "z"', None, None)


def test_truncated_files_fail_as_rows(spark):
    files = spark.createDataFrame([("a", "<Document"), ("b", ""), ("c", None)], "file_path string, text string")
    assert {r["status"] for r in feeds.parse_holdings_xml(files).collect()} == {"FAILED"}
    assert {r["status"] for r in feeds.parse_holdings_swift(files).collect()} == {"FAILED"}
    assert [r["status"] for r in feeds.parse_cash_entries(files).collect()] == [r["status"] for r in feeds.parse_cash_balances(files).collect()] == ["FAILED"] * 3


def test_a_second_decision_is_a_conflict(spark):
    queue = spark.createDataFrame([(1, "d", "approved", Decimal(1))], "fund_id long, document string, status string, amount decimal(24,2)")
    decisions = spark.createDataFrame([(1, "d", "corrected", Decimal(2))], "fund_id long, document string, status string, final_amount decimal(24,2)")
    assert registry.decide(queue, decisions).collect()[0]["conflict"]


def test_streamed_arrivals_supersede(spark, tmp_path):
    schema = "file_path string, statement_date date, sha256 string, landed_at long"
    day = lambda n: dt.date(2026, 7, n)
    batches = [[("a", day(1), "1", 1), ("b", day(1), "2", 1), ("x", day(3), "9", 1)], [("b", day(1), "older", 2), ("b", day(1), "newer", 3), ("c", day(2), "4", 2)]]
    out, before = tmp_path / "out", {}
    for rows in batches:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        ingest(spark, str(tmp_path / "in"), schema, str(out), str(tmp_path / "checkpoint"))
        untouched = {p.name for p in (out / "statement_date=2026-07-03").glob("*.parquet")}
        assert not before or untouched == before  # a day that brings nothing is not written again
        before = untouched
    got = {r["file_path"]: r["sha256"] for r in spark.read.parquet(str(out)).collect()}
    assert got == {"a": "1", "b": "newer", "c": "4", "x": "9"}


def test_labels(spark):
    row = spark.createDataFrame([(Decimal("41091835.83"), Decimal("-5.40"), 0.0265687243, 1.44, dt.date(2026, 7, 7))], "a decimal(24,2), b decimal(24,2), c double, d double, e date")
    c = F.col
    got = row.select(labels.money(c("a")), labels.money(c("b")), labels.percent(c("c"), 2), labels.percent(F.lit(0.2)), labels.percent(F.lit(0.6), 0), labels.multiple(c("d")), labels.multiple(F.lit(0)), labels.long_date(c("e")), labels.month(c("e")), labels.money(F.lit(None).cast("decimal(24,2)")))
    assert list(got.collect()[0]) == ["$41,091,836", "-$5", "2.66%", "20.0%", "60%", "1.44x", "0.00x", "07 Jul 2026", "Jul 2026", None]
    halves = spark.createDataFrame([(Decimal("0.125"),), (Decimal("-0.125"),), (Decimal("0.135"),)], "x decimal(9,3)")
    assert [tuple(map(str, r)) for r in halves.select(quantized(c("x")), quantized(c("x"), half_even=True)).collect()] == [("0.13", "0.12"), ("-0.13", "-0.12"), ("0.14", "0.14")]


def test_shapes_and_foreign_codes(spark):
    rows = [("ISIN", " us0378331005 ", True), ("ISIN", "US03783310", False), ("CUSIP", "037833100", True), ("SEDOL", "B0YBKJ7", True), ("TICKER", "BRK.B", True), ("TICKER", "TOO LONG", False), ("FIGI", "BBG000B9XRY4", True), ("WKN", "716460", False), ("ISIN", None, None)]
    frame = spark.createDataFrame(rows, "scheme string, value string, want boolean")
    assert [r["got"] for r in frame.select(identifiers.well_formed(F.col("scheme"), F.col("value")).alias("got")).collect()] == [r[2] for r in rows]
    codes = spark.createDataFrame([("136375102", "CA")], "cusip string, country string")
    assert codes.select(identifiers.isin_required(F.col("cusip"), F.col("country")).alias("i")).collect()[0]["i"] == "CA1363751027"
    with pytest.raises(Exception, match="foreign issuer"):
        spark.createDataFrame([("H1467J104",)], "cusip string").select(identifiers.isin_required(F.col("cusip"))).collect()


def test_every_isin_has_one_entry(spark):
    filings = spark.createDataFrame([("037833100",), (" 037833100",), ("136375102",), ("H1467J104",)], "cusip string")
    isins = master.universe(filings, spark.createDataFrame([("136375102", "CA")], "cusip string, country string"))
    assert {r["isin"] for r in isins.collect()} == {"US0378331005", "CA1363751027"}
    found = spark.createDataFrame([("US0378331005", 1, "B", "b", None, None, None, None), ("US0378331005", 0, "A", "a", None, None, None, None)], "isin string, place int, figi string, name string, security_type string, market_sector string, ticker string, exchange_code string")
    assert {(r["isin"], r["mapped"], r["figi"]) for r in master.assembled(isins, found).collect()} == {("US0378331005", True, "A"), ("CA1363751027", False, None)}


def test_fund_book_balances_roll_forward(spark):
    funds = spark.createDataFrame([(1, Decimal("1000001.99"), 2024)], "fund_id long, total_commitment decimal(24,2), vintage_year int")
    rows = sorted(fund_book.statements(funds).collect(), key=lambda r: r["period_end"])
    assert [r["period_end"] for r in rows][:5] == [dt.date(2024, 3, 31), dt.date(2024, 6, 30), dt.date(2024, 9, 30), dt.date(2024, 12, 31), dt.date(2025, 3, 31)] and len(rows) == 10
    before, cent = Decimal(0), Decimal("0.01")
    for r, gain in zip(rows, fund_book.GAINS, strict=True):
        held = before + r["contributions"] - r["distributions"] - r["management_fees"]
        assert r["beginning_balance"] == before and r["unrealized_gain_loss"] == (held * Decimal(gain)).quantize(cent, "ROUND_HALF_UP")
        assert r["ending_balance"] == held + r["realized_gain_loss"] + r["unrealized_gain_loss"]
        before = r["ending_balance"]
    told = {(r["kind"], r["number"]): r for r in fund_book.notices(funds).collect()}
    assert sum(r["contributions"] for r in rows) == told["capital_call", 4]["cumulative"] and rows[-1]["unfunded_commitment"] == told["capital_call", 4]["remaining_commitment"]
    assert [told["distribution", i]["recallable"] for i in (1, 2)] == [True, False] and rows[8]["realized_gain_loss"] == rows[8]["distributions"] > 0


def test_defects_are_told_and_nothing_else_changes(spark):
    m = Model(spark, "/root/testdata/sf0.001")
    clean = m["feed_b"]
    bad, manifest = defects.holdings(clean, 3, "MT535")
    told = manifest.collect()
    kinds = {r["defect"] for r in told}
    statements = clean.select("as_of", "account_id").distinct().count()
    assert kinds == {"MISSING_COST_BASIS", "MISTYPED_ISIN", "STALE_PRICE"} and all(0.15 * statements < sum(r["defect"] == k for r in told) < 0.35 * statements for k in kinds)
    assert bad.count() == clean.count() and bad.exceptAll(clean).count() <= len(told)
    typed = {r["target_id"]: r["detail"] for r in told if r["defect"] == "MISTYPED_ISIN"}
    assert all(d == f"{t} -> {t[:-1]}{(int(t[-1]) + 1) % 10}" for t, d in typed.items())
    cash, manifest = defects.cash(m["clean_entries"], 3)
    count = manifest.groupBy("defect").count().collect()
    by = {r["defect"]: r["count"] for r in count}
    assert cash.count() == m["clean_entries"].count() + by["DUPLICATE_TRANSACTION"] - by["DROPPED_TRANSACTION"]


def test_serving_rows(spark):
    tenants = spark.createDataFrame([(1, 10), (2, 20)], "client_id int, tenant_id int")
    rows = spark.createDataFrame([(1, "b", 2), (1, "a", 1), (2, "c", 3)], "client_id int, name string, rank int")
    assert [r["name"] for r in serving.of_client(rows, 1, "-rank").collect()] == ["b", "a"]
    assert [r["name"] for r in registry.of_tenant(rows, tenants, 20).collect()] == ["c"]
    with pytest.raises(LookupError, match="tenant 30"):
        registry.of_tenant(rows, tenants, 30)
    assert registry.unclaimed(rows, tenants.where("tenant_id = 10")).collect()[0]["client_id"] == 2
    assert serving.checked_broadcast(rows, 2).join(tenants, "client_id").count() == 3  # too many: joined by a shuffle
    with pytest.raises(LookupError, match="queue item"):
        serving.one(rows, F.col("rank") == 9, "queue item 9")


def test_audit_has_the_decisions_that_were_taken(spark):
    queue = spark.createDataFrame([(1, "p", "pending", Decimal(5)), (1, "q", "pending", Decimal(6)), (1, "d", "approved", Decimal(7))], "fund_id long, document string, status string, amount decimal(24,2)")
    decisions = spark.createDataFrame([(1, "p", "approved", None), (1, "q", "corrected", Decimal(9)), (1, "d", "corrected", Decimal(2))], "fund_id long, document string, status string, final_amount decimal(24,2)")
    assert {(r["document"], r["action"], r["final_amount"]) for r in registry.audited(queue, decisions).collect()} == {("p", "approve", 5), ("q", "correct", 9)}


def test_a_position_of_nothing_is_an_error(spark):
    rows = spark.createDataFrame([(1, "c", Decimal(1), Decimal("10.01")), (1, "d", Decimal(7), Decimal(70))], "account_id int, cusip string, shares decimal(24,2), value decimal(24,2)")
    got = {r["cusip"]: (r["quantity"], r["price"], r["market_value"]) for r in book.positions(rows, 2).collect()}
    assert got == {"c": (1, Decimal("10.01"), Decimal("10.01")), "d": (4, 10, 40)}
    with pytest.raises(Exception, match="nothing is left of c"):
        book.positions(rows, 3).collect()


def test_days_on_which_cash_moves(spark):
    days = spark.sql("SELECT explode(sequence(DATE '2026-08-01', DATE '2026-09-30')) AS day")
    got = {k: [r["day"].isoformat() for r in book.cash_calendar(days).where(k).orderBy("day").collect()] for k in ("contribution", "withdrawal", "quarter_end")}
    assert got == {"contribution": ["2026-08-03", "2026-09-01"], "withdrawal": ["2026-08-18", "2026-09-18"], "quarter_end": ["2026-09-30"]}
