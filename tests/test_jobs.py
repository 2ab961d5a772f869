from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lodestack.functions.text import suffix_ticker
from lodestack.operators import forms
from lodestack.plans import jobs
from lodestack.plans.state import State
from lodestack.sources import landed

def NOW():
    return F.lit("2026-01-05 12:00:00").cast("timestamp")



@pytest.fixture
def state(spark, tmp_path):
    return State(spark, "file://" + str(tmp_path / "state"))


def words(spark, filing, rows):
    head = [(t, x, 10.0) for t, x in (("Owner", 60.0), ("Asset", 105.0), ("Transaction", 262.0), ("Date", 330.0), ("Notification", 385.0), ("Amount", 450.0))]
    return spark.createDataFrame([(filing, 0, *w) for w in head + rows], forms.WORD_SCHEMA)


def test_from_index_to_report(spark, state):
    terms = spark.createDataFrame([("A1", "Ann Able", "house", date(2015, 1, 3), None, "CA", "1", "D")], "bioguide_id string, full_name string, chamber string, start_date date, end_date date, state string, district string, party string")
    jobs.sync_people(state, terms, NOW())
    jobs.sync_people(state, terms, NOW())
    jobs.sync_committees(state, spark.createDataFrame([("house", "HSAG", "Farming")], "chamber string, thomas_id string, name string"), spark.createDataFrame([("HSAG", "A1", "majority", 1, "Chair"), ("HSAG", "ZZ", "x", 2, None)], "thomas_id string, bioguide_id string, party string, rank int, title string"), NOW())
    assert state.read("politicians").count() == state.read("politician_terms").count() == state.read("committee_memberships").count() == 1

    index = spark.createDataFrame([("house:1", "Hon. Ann Able", "P", date(2026, 1, 2)), ("house:1", "Hon. Ann Able", "P", date(2026, 1, 2)), ("house:2", "Nobody Known", "P", None)], "filing_id string, filer_name string, filing_type string, filed_date date")
    assert jobs.logged(state, "house", lambda: jobs.ingest_index(state, index, NOW()), datetime(2026, 1, 5)) == 2
    assert jobs.ingest_index(state, index, NOW()) == 0
    assert [r.filing_id for r in jobs.pending_reports(state, 1).collect()] == ["house:1"]

    row = [("Apple", 106.0, 30.0), ("(AAPL)", 140.0, 30.0), ("[ST]", 180.0, 30.0), ("P", 262.0, 30.0), ("1/2/2026", 331.0, 30.0), ("1/3/2026", 386.0, 30.0), ("$1,001", 451.0, 30.0), ("-", 480.0, 30.0), ("$15,000", 490.0, 30.0)]
    scan = spark.createDataFrame([("house:2", 0, "cover", 1.0, 1.0)], forms.WORD_SCHEMA)
    jobs.parse_trade_forms(state, words(spark, "house:1", row).unionByName(scan), NOW())
    got = {r.filing_id: (r.format, r.parse_status) for r in state.read("filings").collect()}
    assert got == {"house:1": ("electronic", "parsed"), "house:2": ("scanned", "paper_deferred")}

    done = spark.createDataFrame([("house:2", 0, "PFIZER (PFE)", "purchase", "high"), ("house:2", 1, "X", None, "low")], "filing_id string, row_index int, asset_description_raw string, tx_type string, confidence string")
    done = done.withColumns({c: F.lit(None).cast("string") for c in ("review", "note", "owner")}).withColumns({"ticker": suffix_ticker("asset_description_raw")})
    assert jobs.import_transcribed(state, done, "batch.csv", NOW()) == 1 and jobs.import_transcribed(state, done, "batch.csv", NOW()) == 0
    assert state.read("transaction_provenance").count() == 1

    jobs.link_filers(state, NOW())
    jobs.link_filers(state, NOW())
    assert {r.filing_id: r.bioguide_id for r in state.read("filings").collect()} == {"house:1": "A1", "house:2": None}
    companies = spark.createDataFrame([("0000000001", "AAPL", "Apple Inc."), ("0000000002", "PFE", "Pfizer Inc.")], "cik string, ticker string, title string")
    none = spark.createDataFrame([], "match_type string, match_value string, ticker string, cik string")
    jobs.link_trades(state, companies, none, NOW())
    jobs.link_trades(state, companies, none, NOW())
    assert state.read("transactions").filter("instrument_id is null").count() == 0
    assert state.read("instruments").count() == state.read("ticker_map").count() == 2
    jobs.sync_industries(state, spark.createDataFrame([("0000000001", "3571", "Computers")], "cik string, sic string, sic_description string"), NOW())
    assert sorted(str(r.sic) for r in state.read("instruments").collect()) == ["3571", "None"] and state.read("instruments").filter("sic_synced_at is null").count() == 0
    jobs.follow_amendments(state)

    lines = [r.line for r in jobs.message_lines(state, index).orderBy("filing_id").collect()]
    assert lines[0] == "Ann Able (D-CA) [Farming (Chair)]: BUY AAPL $1,001-$15,000 [self]"
    report = jobs.quality_report(state, F.lit("2026-02-01").cast("date"))
    assert "Transactions: 2" in report and "house: parse success 100.0% (2/2, 0 pending)" in report and "Open dq_issues: 2" in report
    assert jobs.is_silent(state, F.current_timestamp()) is False


def test_html_reports_and_community(spark, state):
    results = spark.createDataFrame([("senate:a", "S One", True, date(2026, 1, 2)), ("senate:b", "S Two", False, date(2026, 1, 2)), ("senate:c", "S Three", True, date(2026, 1, 2))], "filing_id string, filer_name string, is_electronic boolean, filed_date date")
    assert jobs.ingest_search(state, results, NOW(), live=False) == 3
    cells = "".join(f"<td>{c}</td>" for c in ("1", "01/02/2026", "Spouse", "--", "Thing", "Stock", "Sale (Full)", "$1,001 - $15,000", "--"))
    pages = spark.createDataFrame([("senate:a", f"<table><tbody><tr>{cells}</tr></tbody></table>"), ("senate:c", "<p>no table</p>")], "filing_id string, html string")
    jobs.parse_html_reports(state, pages, NOW())
    assert {r.filing_id: r.parse_status for r in state.read("filings").collect()} == {"senate:a": "parsed", "senate:b": "paper_deferred", "senate:c": "failed"}
    assert [r.issue_type for r in state.read("dq_issues").collect()] == ["ptr_parse_failed"]
    assert {r.first_seen_precision_s for r in state.read("filings").collect()} == {86_400}

    rows = spark.createDataFrame([("senate:a", "x"), ("senate:a", "x"), ("senate:z", "y")], "external_filing_id string, asset_description string")
    for c, t in (("source", "string"), ("chamber", "string"), ("filer_name", "string"), ("ticker", "string"), ("asset_type", "string"), ("tx_type", "string"), ("owner", "string"), ("tx_date", "date"), ("disclosure_date", "date"), ("amount_min", "double"), ("amount_max", "double")):
        rows = rows.withColumn(c, F.lit("senate" if c in ("source", "chamber") else None).cast(t))
    assert jobs.import_community(state, rows) == 2 and jobs.import_community(state, rows) == 0
    assert jobs.rematch_community(state).first().match_rate == 0.5


def test_failed_runs_are_logged(state):
    def fail():
        raise ValueError("no")

    with pytest.raises(ValueError):
        jobs.logged(state, "senate", fail, datetime(2026, 1, 1))
    r = state.read("scrape_runs").first()
    assert (r.status, r.error_message) == ("failed", "no")
    assert jobs.is_silent(state, NOW())


def test_backfill_and_storage(spark, state):
    t = spark.createDataFrame([("t", "f", 0, "d", "purchase", True)], "transaction_id string, filing_id string, row_index int, asset_description_raw string, tx_type string, is_current boolean")
    state.append("transactions", t)
    parsed = spark.createDataFrame([("f", 0, "ABC", "OP", "i", "call", 5.0, date(2026, 1, 1))], "filing_id string, row_index int, ticker string, asset_type string, source_transaction_id string, option_type string, strike double, expiry date")
    jobs.backfill_fields(state, parsed)
    r = state.read("transactions").first()
    assert (r.ticker, r.option_type, r.strike) == ("ABC", "call", 5.0)
    got = jobs.check_storage(state, spark.createDataFrame([("b", 5)], "bucket string, bytes long"), NOW()).first()
    assert not got.exceeded and state.read("storage_usage").first().total_bytes == 5
    assert landed.candidate_years(spark.createDataFrame([(2020,)], "year int")).orderBy("attempt").first().try_year == 2020
