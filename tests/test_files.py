"""File sources and table sinks on small folders and tables."""

import datetime as dt
import hashlib
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallystone.operators import registry
from tallystone.sinks import tables
from tallystone.sources import feeds, files


def put(root, name, data):
    path = root / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(data if isinstance(data, bytes) else data.encode())
    return path


def test_landing_routes_by_suffix(spark, tmp_path):
    text = f'<Document xmlns="{feeds.HOLDINGS_NS}"><SctiesBalCtdyRpt><StmtGnlDtls><StmtId>S1</StmtId><StmtDtTm><Dt>2026-07-01</Dt></StmtDtTm></StmtGnlDtls><SfkpgAcct><Id>7</Id></SfkpgAcct></SctiesBalCtdyRpt></Document>'
    put(tmp_path, "date=2026-07-01/a.semt002.xml", text)
    put(tmp_path, "date=2026-07-02/b.mt535.txt", b"\xff\xfe")
    put(tmp_path, "date=2026-07-02/c.csv", "x")
    put(tmp_path, "other/d.camt053.xml", "x")
    got = {r["file_name"]: r for r in files.landing(spark, str(tmp_path)).collect()}
    assert set(got) == {"a.semt002.xml", "b.mt535.txt", "c.csv"}
    assert got["a.semt002.xml"]["sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert got["a.semt002.xml"]["statement_date"] == dt.date(2026, 7, 1) and got["a.semt002.xml"]["format"] == "semt.002"
    assert [got[n]["error"] for n in ("a.semt002.xml", "b.mt535.txt", "c.csv")] == [None, "not UTF-8 text", "unrecognised filename"]
    landed = files.landing(spark, str(tmp_path)).where("format = 'semt.002' AND status = 'LANDED'")
    assert feeds.parse_holdings_xml(landed).collect()[0]["account_id"] == "7"


LINE = "<{p}infoTable><{p}nameOfIssuer>ACME</{p}nameOfIssuer><{p}titleOfClass>COM</{p}titleOfClass><{p}cusip>{c}</{p}cusip><{p}value>{v}</{p}value><{p}shrsOrPrnAmt><{p}sshPrnamt>10</{p}sshPrnamt><{p}sshPrnamtType>{k}</{p}sshPrnamtType></{p}shrsOrPrnAmt>{o}</{p}infoTable>"


@pytest.mark.parametrize("prefix", ["", "ns1:"])
def test_filings_and_information_tables(spark, tmp_path, prefix):
    lines = "".join(LINE.format(p=prefix, c=c, v=v, k=k, o=o) for c, v, k, o in (("037833100", 5, "SH", ""), ("037833100", 6, "SH", ""), ("037833100", 7, "PRN", ""), ("5949181ab", 8, "SH", f"<{prefix}putCall>Put</{prefix}putCall>")))
    space = ' xmlns:ns1="urn:x"' if prefix else ' xmlns="urn:x"'
    for folder in ("accession=1", "accession=2.partial"):
        put(tmp_path, f"cik=9/{folder}/information_table.xml", f'<?xml version="1.0"?>\n<{prefix}informationTable{space}>{lines}</{prefix}informationTable>')
        put(tmp_path, f"cik=9/{folder}/filing.json", json.dumps({"cik": 9, "filer": "F", "accession": "1", "filing_date": "2026-05-01", "period": "2026-03-31"}, indent=2))
    kept = files.filings(spark, str(tmp_path)).collect()
    assert [(r["cik"], r["filing_date"]) for r in kept] == [(9, dt.date(2026, 5, 1))]
    rows = files.information_tables(spark, str(tmp_path))
    assert rows.count() == 4
    held = registry.information_table(rows).collect()
    assert [(r["accession"], r["cusip"], r["shares"], r["value"]) for r in held] == [("1", "037833100", Decimal("20.00"), Decimal("11.00"))]


def test_a_line_without_cusip_stops(spark, tmp_path):
    put(tmp_path, "cik=9/accession=1/t.xml", f"<informationTable>{LINE.format(p='', c=' ', v=1, k='SH', o='')}</informationTable>")
    with pytest.raises(Exception, match="without cusip"):
        files.information_tables(spark, str(tmp_path)).collect()


def test_reference_data(spark, tmp_path):
    held = put(tmp_path, "master.json", json.dumps({"source": {}, "securities": [{"isin": "US1", "mapped": True, "name": "A"}, {"isin": "US2", "mapped": False}]}, indent=2))
    assert [(r["isin"], r["mapped"], r["name"]) for r in files.master(spark, str(held)).orderBy("isin").collect()] == [("US1", True, "A"), ("US2", False, None)]
    told = put(tmp_path, "rates.csv", "Date,USD,JPY,\n2026-07-02,1.0873,170,\n2026-07-01,N/A,171,\n2026-06-30,,1,\n1998-01-01,1.2,1,\n")
    rates = files.rates_csv(spark, str(told))
    assert [tuple(r) for r in rates.collect()] == [(dt.date(2026, 7, 2), Decimal("1.087300"))]
    tables.write_rates(rates, str(tmp_path / "rates"), "a bank")
    assert files.rates_json(spark, str(tmp_path / "rates")).collect() == rates.collect()
    source = json.loads(next((tmp_path / "rates").glob("part-*")).read_text())["source"]
    assert source == {"provider": "a bank", "base": "EUR", "quote": "USD", "first": "2026-07-02", "last": "2026-07-02", "days": 1}


def test_documents_and_records(spark, tmp_path):
    put(tmp_path, "raw/F1/capital_call_01.pdf", b"%PDF-1.7 x")
    put(tmp_path, "raw/F1/letter.pdf", b"no")
    docs = files.documents(spark, str(tmp_path / "raw"))
    assert {(r["fund_id"], r["file_name"], r["doc_type"]) for r in docs.collect()} == {("F1", "capital_call_01.pdf", "capital_call"), ("F1", "letter.pdf", None)}
    wanted = docs.select("fund_id", F.col("file_name").alias("document"))
    assert files.document_bodies(spark, str(tmp_path / "raw"), wanted.where("document LIKE 'cap%'")).collect()[0]["content"] == b"%PDF-1.7 x"
    with pytest.raises(Exception, match="not a PDF"):
        files.document_bodies(spark, str(tmp_path / "raw"), wanted).collect()
    put(tmp_path, "ext/F1/a.extracted.json", json.dumps({"document": "a", "doc_type": "distribution", "model": "m", "prompt_version": "1", "fields": {"amount": "5"}, "confidence": 0.9, "self_consistent": True, "self_reported_confidence": 1.0}, indent=2))
    put(tmp_path, "ext/F1/b.extracted.json", "{")
    got = {r["document"]: r for r in files.extractions(spark, str(tmp_path / "ext")).collect()}
    assert json.loads(got["a"]["fields_json"]) == {"amount": "5"} and got["a"]["error"] is None and got[None]["error"] == "not a record"


def test_decisions_go_out_and_come_back(spark, tmp_path):
    rows = [("F1", "a", "distribution", 1, None, "approved", '{"amount": "5"}', dt.datetime(2026, 7, 1, 9)), ("F2", "b", "capital_call", 2, dt.date(2026, 6, 30), "corrected", '{"x": null}', dt.datetime(2026, 7, 2, 9))]
    out = spark.createDataFrame(rows, "fund_id string, document string, doc_type string, sequence_number int, period_end date, status string, final_fields string, decided_at timestamp")
    tables.write_decisions(out, str(tmp_path / "reviewed"))
    back = {r["document"]: r for r in files.review_decisions(spark, str(tmp_path / "reviewed"), "part-*").collect()}
    assert {k: (v["fund_id"], v["status"], v["period_end"], json.loads(v["final_fields_json"]), v["decided_at"], v["error"]) for k, v in back.items()} == {
        "a": ("F1", "approved", None, {"amount": "5"}, dt.datetime(2026, 7, 1, 9), None), "b": ("F2", "corrected", "2026-06-30", {"x": None}, dt.datetime(2026, 7, 2, 9), None)}
    queue = out.select("fund_id", "document").withColumn("synced_at", F.lit(None).cast("timestamp"))
    assert tables.marked_synced(queue, out.limit(1)).where("synced_at IS NULL").count() == 1


@pytest.fixture
def place(spark, tmp_path):
    spark.sql(f"CREATE DATABASE ledger LOCATION '{tmp_path}/ledger'")
    yield "ledger"
    spark.sql("DROP DATABASE ledger CASCADE")


def test_tables_are_created_filled_superseded(spark, place):
    name, days = f"{place}.holdings", (dt.date(2026, 7, 1), dt.date(2026, 7, 2))
    for _ in range(2):
        tables.ensure(spark, name, "file_path string, quantity decimal(24,6), statement_date date", "what arrived; it's raw", "statement_date")
    rows = spark.createDataFrame([(days[0], "a", "1.5"), (days[0], "b", "2"), (days[1], "c", "3")], "statement_date date, file_path string, quantity string")
    tables.land({name: rows}, name, rows.where("file_path = 'c'"))
    assert spark.table(name).count() == 4
    with pytest.raises(ValueError, match="the rows"):
        tables.append(rows.drop("quantity"), name)
    again = spark.createDataFrame([("a",), ("c",), ("new",)], "file_path string")
    tables.supersede(spark, name, again)
    assert [tuple(r) for r in spark.table(name).collect()] == [("b", Decimal("2.000000"), days[0])]
    tables.supersede(spark, name, again.where("file_path = 'new'"))
    assert tables.comment_columns(spark, name, {"file_path": "where it's from", "quantity": "units"}) == 2
    assert tables.comment_columns(spark, name, {"file_path": "where it's from", "quantity": "units"}) == 0
    tables.rebuild(spark.table(name).where("false"), f"{place}.empty", "none yet")
    assert spark.table(f"{place}.empty").columns == spark.table(name).columns


def test_tenants_and_serving_tables(spark):
    assert tables.schema_of("firm_1") == "tenant_firm_1"
    for bad in ("", "1x", "a;drop", "a\n"):
        with pytest.raises(ValueError):
            tables.schema_of(bad)
    tenants = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "client_id int, tenant_id string")
    assert tables.claimed_once(tenants).count() == 2
    with pytest.raises(Exception, match="two tenants"):
        tables.claimed_once(tenants.unionByName(spark.createDataFrame([(2, "a")], tenants.schema))).collect()
    with pytest.raises(TypeError, match="no serving type"):
        tables.servable(tenants.groupBy("tenant_id").agg(F.collect_list("client_id").alias("all")))


def test_serving_tables_reload_over_jdbc(spark):
    url = "jdbc:derby:memory:serving;create=true"
    queue = spark.createDataFrame([(1, "pending"), (2, "approved")], "ID int, STATUS string").withColumn("SYNCED_AT", F.lit(None).cast("timestamp"))
    kinds = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "createTableColumnTypes": "STATUS VARCHAR(20)"}
    for _ in range(2):
        tables.reload(queue, url, "queue", kinds)
    assert spark.read.jdbc(url, "queue", properties=kinds).count() == 2
    found = files.undecided_synced(spark, url, "queue", kinds)
    assert [r["ID"] for r in found.collect()] == [2]
    assert "PushedFilters: [*IsNotNull(STATUS)" in found._jdf.queryExecution().executedPlan().toString()


def test_documents_are_mirrored_by_digest(spark):
    schema = "fund_id string, document string, sha256 string"
    held = spark.createDataFrame([("F", "a", "1"), ("F", "b", "1")], schema)
    fetch, stay = tables.mirrored(held, spark.createDataFrame([("F", "a", "1"), ("F", "b", "2"), ("F", "c", "1")], schema))
    assert {r["document"] for r in fetch.collect()} == {"b", "c"} and [r["document"] for r in stay.collect()] == ["a"]


def test_manifests_and_master_files(spark, tmp_path):
    manifest = spark.createDataFrame([(dt.date(2026, 7, 1), 1, "STALE_PRICE", "X", "a -> b")], "as_of date, account_id int, defect string, target_id string, detail string")
    with pytest.raises(ValueError, match="below the landing folder"):
        tables.write_manifest(manifest, str(tmp_path / "landing/manifest"), str(tmp_path / "landing"))
    tables.write_manifest(manifest, str(tmp_path / "landing-manifest"), str(tmp_path / "landing"))
    assert spark.read.json(str(tmp_path / "landing-manifest")).collect()[0]["defect"] == "STALE_PRICE"
    entries = spark.createDataFrame([("US2", True, "F"), ("US1", False, None)], "isin string, mapped boolean, figi string")
    tables.write_master(entries, str(tmp_path / "master"), "test")
    got = json.loads(spark.read.text(str(tmp_path / "master")).collect()[0]["value"])
    assert got == {"source": {"provider": "test", "entries": 2, "mapped": 1}, "entries": [{"isin": "US1", "mapped": False, "figi": None}, {"isin": "US2", "mapped": True, "figi": "F"}]}


def test_serving_tables_are_replaced_together(spark):
    url = "jdbc:derby:memory:together;create=true"
    kinds = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    one = lambda n: spark.createDataFrame([(i, float(i)) for i in range(n)], "ID int, V double")
    for name in ("left_side", "right_side"):
        one(3).write.jdbc(url, name, properties=kinds)
    tables.reload_all({"left_side": one(5), "right_side": one(7)}, url, kinds)
    count = lambda name: spark.read.jdbc(url, name, properties=kinds).count()
    assert (count("left_side"), count("right_side")) == (5, 7)
    with pytest.raises(Exception, match="(?i)missing_side"):
        tables.reload_all({"left_side": one(1), "missing_side": one(1)}, url, kinds)
    assert (count("left_side"), count("right_side")) == (5, 7)  # rolled back


def test_typed_reads_stop_at_another_type(spark):
    spark.sql("DROP TABLE IF EXISTS typed_rows")
    tables.rebuild(spark.createDataFrame([(1, Decimal("1.5"))], "a int, b decimal(24,2)"), "typed_rows")
    assert tables.typed(spark, "typed_rows", "b decimal(24,2), a int").columns == ["b", "a"]
    with pytest.raises(TypeError, match="a is int, not bigint; c is missing"):
        tables.typed(spark, "typed_rows", "a bigint, c string")
    spark.sql("DROP TABLE typed_rows")
