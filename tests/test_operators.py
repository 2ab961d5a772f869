import random
from datetime import date, datetime

from pyspark.sql import Row
from pyspark.sql import functions as F

from lodestack.operators import forms, ingest, linking, quality, reports, versions
from lodestack.plans import schemas
from lodestack.sources import landed
from lodestack.streaming import first_seen


def test_new_keys_keep_the_first_of_each(spark):
    fetched = spark.createDataFrame([("a", 1), ("b", 2), ("a", 3), ("c", 4)], "k string, n int")
    known = spark.createDataFrame([("b",)], "k string")
    got = ingest.new_keys(fetched, known, "k", "n").collect()
    assert sorted((r.k, r.n) for r in got) == [("a", 1), ("c", 4)]


def test_drain_stops_when_nothing_moves():
    left = [5]

    def step():
        left[0] = max(2, left[0] - 2)

    assert ingest.drain(lambda: left[0], step) == 3


def test_upsert_keeps_created(spark):
    old = spark.createDataFrame([(1, "x", "then"), (2, "y", "then")], "k int, v string, created string")
    new = spark.createDataFrame([(2, None, "now"), (3, "z", "now")], "k int, v string, created string")
    got = {r.k: (r.v, r.created) for r in ingest.upsert(old, new, "k", keep=("created",)).collect()}
    assert got == {1: ("x", "then"), 2: (None, "then"), 3: ("z", "now")}


def test_amendments(spark):
    filings = spark.createDataFrame([("f1", date(2020, 1, 1), datetime(2020, 1, 2), None), ("f2", date(2020, 2, 1), datetime(2020, 2, 2), None), ("f3", None, datetime(2020, 3, 1), None)], "filing_id string, filed_date date, first_seen_at timestamp, supersedes_filing_id string")
    rows = spark.createDataFrame([("f1", 0, "s1", True), ("f2", 0, "s1", True), ("f2", 1, "s1", True), ("f3", 0, "s2", True), ("f3", 1, None, True)], "filing_id string, row_index int, source_transaction_id string, is_current boolean")
    changed, linked = versions.link_amendments(filings, rows)
    assert {(r.filing_id, r.row_index): r.is_current for r in changed.collect()} == {("f1", 0): False, ("f2", 0): False, ("f2", 1): True, ("f3", 0): True, ("f3", 1): True}
    assert {r.filing_id: r.supersedes_filing_id for r in linked.collect()} == {"f1": None, "f2": "f1", "f3": None}


def test_people_links(spark):
    filings = spark.createDataFrame([("1", "house", "Hon. Nancy Pelosi", date(2020, 1, 1)), ("2", "house", "John Smith", date(2020, 1, 1)), ("3", "house", "Zzyx Qwerty", date(2020, 1, 1)), ("4", "house", "Odd Name", date(2020, 1, 1)), ("5", "house", "Nancy Pelosi", date(1980, 1, 1))], "filing_id string, chamber string, filer_name string, as_of date")
    people = spark.createDataFrame([("P", "Nancy Pelosi"), ("Q", "Nancy Peloso"), ("A", "John A Smith"), ("B", "John B Smith")], "bioguide_id string, full_name string")
    terms = people.select("bioguide_id", F.lit("house").alias("chamber"), F.lit("2000-01-01").cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    fixed = spark.createDataFrame([("house", "odd name", "X")], "chamber string, filer_name string, bioguide_id string")
    got = {r.filing_id: (r.bioguide_id, r.method) for r in linking.link_people(filings, terms, people, fixed).collect()}
    assert got == {"1": ("P", "fuzzy"), "2": (None, "ambiguous"), "3": (None, "unmatched"), "4": ("X", "override"), "5": (None, "unmatched")}


def test_security_links(spark):
    rows = spark.createDataFrame([("1", "aapl", "x"), ("2", None, "EA - Electronic Arts Inc"), ("3", None, "Invesco QQQ [OT]"), ("4", "ZZZZ", "x"), ("5", None, "Weird Fund")], "row_id string, ticker string, description string")
    companies = spark.createDataFrame([("1", "AAPL", "Apple Inc."), ("2", "EA", "Electronic Arts Inc."), ("3", "IVZ", "Invesco Ltd.")], "cik string, ticker string, title string")
    fixed = spark.createDataFrame([("ticker", "ZZZZ", "AAPL", "1"), ("description", "Weird Fund", None, None)], "match_type string, match_value string, ticker string, cik string")
    got = {r.row_id: (r.ticker, r.cik, r.method) for r in linking.link_securities(rows, companies, fixed).collect()}
    assert got == {"1": ("AAPL", "1", "ticker"), "2": ("EA", "2", "fuzzy"), "3": (None, None, "unmatched"), "4": ("AAPL", "1", "override"), "5": (None, None, "override")}


def test_quality_metrics_and_report(spark):
    t = schemas.empty(spark, "transactions")
    m = quality.metrics(t, schemas.empty(spark, "filings"), schemas.empty(spark, "dq_issues"), F.lit("2026-01-01").cast("date")).first()
    assert m["total_transactions"] == 0 and m["duplicate_groups"] == 0 and m["open_dq_issues"] == 0
    text = reports.quality_report(Row(total_transactions=1000, ticker_linked=800, late_filings=30, late_filing_eligible=300, scanned_or_paper_filings=5, classified_filings=150, duplicate_groups=0, broken_amendment_groups=0, implausible_values=0, open_dq_issues=1), [Row(chamber="house", parsed=90, failed=10, pending=1)])
    for line in ("  house: parse success 90.0% (90/100, 1 pending)", "Paper/scanned filings: 5/150 (3.3%)", "Ticker-linked: 800/1000 (80.0%)", "Late filings (>45d): 30/300 (10.0%)"):
        assert line in text
    assert "Late" not in reports.quality_report(Row(**{**m.asDict()}), [])


def test_extraction_check(spark):
    rows = [("a", " ", 1), *(("b", f"x{i}", 1) for i in range(25)), *(("c", "x", 1) for _ in range(3)), ("d", "x", 1)]
    df = spark.createDataFrame(rows, "filing string, description string, n int")
    got = {r.filing: (r.ok, r.needs_review, r.reasons) for r in quality.extraction_check(df, "filing", "description", ["description"]).collect()}
    assert got["a"][0] is False and got["b"][1] and got["c"][2] == "repeated row" and got["d"] == (True, False, "")


def test_lines_of_people_and_trades(spark):
    df = spark.createDataFrame([("Doe", "Jane Doe", "D", "CA", ["A", "B", "C", "D", "E"]), ("Doe", None, None, None, None), ("Doe", "Jane Doe", None, None, [])], "f string, n string, p string, s string, c array<string>")
    got = [r.x for r in df.select(reports.filer_line(*(F.col(c) for c in "fnpsc")).alias("x")).collect()]
    assert got == ["Jane Doe (D-CA) [A, B, C, +2 more]", "Doe", "Jane Doe"]
    df = spark.createDataFrame([("purchase", "AAPL", "Apple", 1001.0, 15000.0, "self"), ("sale_partial", "AAPL", "Apple", None, None, None)], "k string, t string, d string, lo double, hi double, o string")
    got = [r.x for r in df.select(reports.trade_line(*(F.col(c) for c in ("k", "t", "d", "lo", "hi", "o"))).alias("x")).collect()]
    assert got == ["BUY AAPL $1,001-$15,000 [self]", "SELL (partial) AAPL"]


def test_budget_is_strict(spark):
    df = spark.createDataFrame([("a", 100), ("a", 100), ("b", 201)], "bucket string, n long")
    got = {r.bucket: (r.warn, r.exceeded) for r in reports.storage_budget(df, "bucket", "n", 200).collect()}
    assert got == {"a": (True, False), "b": (True, True)}


def words(spark, rows):
    return spark.createDataFrame([("f", *r) for r in rows], forms.WORD_SCHEMA)


HEADER = [(0, t, x, 10.0) for t, x in (("Owner", 60.0), ("Asset", 105.0), ("Transaction", 262.0), ("Date", 330.0), ("Notification", 385.0), ("Amount", 450.0), ("Cap.", 527.0))]


def test_trade_form_annotations_pages_and_footer(spark):
    rows = [
        *HEADER, (0, "SP", 61.0, 30.0), (0, "Fund", 106.0, 30.0), (0, "[OP]", 130.0, 30.0), (0, "P", 263.0, 31.0), (0, "1/2/2020", 331.0, 30.0), (0, "1/3/2020", 386.0, 30.0), (0, "$1,001", 451.0, 30.0), (0, "-", 480.0, 30.0),
        (0, "FILINg", 106.0, 50.0), (0, "Status:", 140.0, 50.0), (0, "DESCRIPTION:", 106.0, 60.0), (0, "call", 180.0, 60.0), (0, "options", 200.0, 60.0), (0, "strike", 106.0, 70.0), (0, "price", 140.0, 70.0), (0, "$320", 170.0, 70.0), (0, "expires", 200.0, 70.0), (0, "06/18/2026", 240.0, 70.0),
        (0, "For the complete list of asset type abbreviations", 60.0, 90.0), (0, "P", 263.0, 100.0),
        *((1, t, x, y) for _, t, x, y in HEADER), (1, "X", 263.0, 20.0), (1, "Second", 106.0, 30.0), (1, "s", 263.0, 30.0), (1, "(partial)", 280.0, 30.0), (1, "2000135564", 20.0, 30.0),
    ]
    a, b = sorted(forms.trade_form(words(spark, rows)).collect(), key=lambda r: r.row_index)
    assert (a.owner, a.asset_description_raw, a.asset_type, a.option_type, a.strike, str(a.expiry), a.tx_type, str(a.tx_date), a.amount_min, a.amount_max) == ("spouse", "Fund [OP]", "OP", "call", 320.0, "2026-06-18", "purchase", "2020-01-02", 1001.0, None)
    assert (b.owner, b.tx_type, b.source_transaction_id, b.tx_date) == ("self", "sale_partial", "2000135564", None)


def test_forms_without_words_or_header(spark):
    assert forms.trade_form(words(spark, [])).count() == 0
    scattered = [(0, t, x, 20.0 * i) for i, (_, t, x, _) in enumerate(HEADER)]
    assert forms.is_electronic(words(spark, scattered)).first().electronic is False
    facts = forms.report_facts(words(spark, [(0, "Filing", 1.0, 1.0), (0, "Year:", 9.0, 1.0), (0, "2024", 20.0, 1.0), (0, "S\x00\x00", 1.0, 20.0), (0, "A:", 9.0, 20.0)])).first()
    assert (facts.report_year, facts.has_schedule_a) == (2024, True)


def test_landed_files(spark, tmp_path):
    (tmp_path / "people.yaml").write_text("""
- id: {bioguide: C1}
  name: {first: A, last: B, official_full: A. B}
  terms: [{type: rep, start: '2005-01-03', end: '2011-01-03', state: MO, district: 0, party: Democrat}, {type: sen, start: '2019-01-03', state: MO}, {type: rep, start: '2001-01-03', end: '2005-01-03'}]
- id: {}
  name: {first: X}
  terms: [{type: rep, start: '2019-01-03'}]
""")
    terms = landed.people_terms(spark, str(tmp_path / "people.yaml"))
    assert sorted((r.chamber, r.district) for r in terms.collect() if r.bioguide_id == "C1") == [("house", "0"), ("senate", None)]
    assert landed.people(terms).first().chamber == "senate"
    (tmp_path / "c.yaml").write_text("- {type: house, name: Farm, thomas_id: HSAG}\n- {type: joint, name: J}\n")
    (tmp_path / "m.yaml").write_text("HSAG: [{name: R, bioguide: R1, rank: 1, title: Chair}, {name: N}]\nOTHER: [{bioguide: Z}]\n")
    known = landed.committees(spark, str(tmp_path / "c.yaml"))
    assert [r.bioguide_id for r in landed.memberships(spark, str(tmp_path / "m.yaml"), known).collect()] == ["R1"]
    (tmp_path / "sec.json").write_text('{"0": {"cik_str": 320193, "ticker": "aapl", "title": "Apple Inc."}, "1": {"cik_str": null, "ticker": "X", "title": "Y"}}')
    assert [tuple(r) for r in landed.companies(spark, str(tmp_path / "sec.json")).collect()] == [("0000320193", "AAPL", "Apple Inc.", 0)]
    (tmp_path / "o.csv").write_text("match_type,match_value,ticker,cik,reason\nticker,ZZZZ,AAPL,1,a\nticker,ZZZZ,MSFT,2,b\ndescription,Fund,,,none\n")
    assert {r.match_value: (r.ticker, r.cik) for r in landed.overrides(spark, str(tmp_path / "o.csv")).collect()} == {"ZZZZ": ("MSFT", "2"), "Fund": (None, None)}
    (tmp_path / "page.json").write_text('{"result": "ok", "data": [["RICHARD ", "B", "o", "<a href=\\"/search/view/paper/0632f542-7ac2-46e4-bd9c-603e3673f0cd/\\">Periodic Transaction Report for 09/16/2026 (Amendment 2)</a>", "09/17/2026"], ["A", "C", "o", "<a href=\\"/search/view/ptr/0632f542-7ac2-46e4-bd9c-603e3673f0ce/\\">Annual Report for CY 2020</a>", "09/17/2026"], ["a", "b", "c", "no link", "x"]]}')
    assert [(r.filer_name, r.is_electronic, r.amendment) for r in landed.search_results(spark, str(tmp_path / "page.json")).collect()] == [("RICHARD B", False, "Amendment 2")]
    (tmp_path / "house.json").write_text('[{"transaction_date": "09/08/2026", "disclosure_date": "9/17/2026", "ticker": "--", "asset_description": "F\\u0000 S", "amount": "$1,001 - $15,000", "representative": "R", "filing_id": "20035471"}]')
    r = landed.house_feed(spark, str(tmp_path / "house.json")).first()
    assert (r.external_filing_id, str(r.disclosure_date), r.ticker, r.asset_description, r.amount_max) == ("house:20035471", "2026-09-17", None, "F S", 15000.0)


def test_xml_index_in_archives(spark, tmp_path):
    import zipfile

    xml = "<FinancialDisclosure><Member><Prefix>Hon.</Prefix><Last>Alford</Last><First>Mark</First><Suffix/><FilingType>P</FilingType><StateDst>MO04</StateDst><Year>2026</Year><FilingDate>3/31/2026</FilingDate><DocID>20034201</DocID></Member><Member><Last>X</Last><DocID> </DocID></Member></FinancialDisclosure>"
    with zipfile.ZipFile(tmp_path / "2026FD.zip", "w") as z:
        z.writestr("2026FD.txt", "x")
        z.writestr("2026FD.xml", xml)
    folder = landed.unzip_indexes(spark, str(tmp_path / "*.zip"), str(tmp_path / "xml"))
    assert [(r.filing_id, r.filer_name, r.year, str(r.filed_date)) for r in landed.filing_index(spark, folder).collect()] == [("house:20034201", "Hon. Mark Alford", 2026, "2026-03-31")]


def test_stream_ingests_each_key_once(spark, tmp_path):
    src, state, mark = (str(tmp_path / x) for x in ("in", "state", "mark"))
    for part in ([("b", 3), ("a", 1), ("b", 2)], [("a", 0), ("c", 4)]):
        spark.createDataFrame(part, "k string, n int").coalesce(1).write.mode("append").parquet(src)
        first_seen.ingest_available(first_seen.read_events(spark, src, "k string, n int"), state, mark, "k", "n")
    assert sorted((r.k, r.n) for r in spark.read.parquet(state).collect()) == [("a", 1), ("b", 2), ("c", 4)]


def test_rules_of_tables(spark):
    bad = spark.createDataFrame([("p", "x", "moon")], "bioguide_id string, full_name string, chamber string")
    got = schemas.violations({"politicians": bad}).collect()
    assert [(r.table, r.n) for r in got] == [("politicians", 1)]


def test_float_text_is_the_shortest(spark):
    values = [0.0, 1001.0, 1001.21, 1001.24, 12345678.0, 12345678.5, 123456789.125, 9999999999999998.0, 1e16, 1.5e18, 0.0001, 1.5e-7, -50000000.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r[0] for r in df.select(versions.float_text(F.col("x"))).collect()] == [repr(v) for v in values]


def test_overrides_look_companies_up(spark):
    companies = spark.createDataFrame([("0000000009", "AA", "Alpha", 0), ("0000000001", "AA", "Alpha again", 1), ("0000000005", "BB", "Beta", 2)], "cik string, ticker string, title string, position int")
    rows = spark.createDataFrame([(1, "AA", "x"), (2, "ZZ", "x"), (3, None, " some fund "), (4, "QQ", "x"), (5, "NO", "Beta"), (6, None, None)], "row_id int, ticker string, description string")
    fixed = spark.createDataFrame([("ticker", "ZZ", "bb", None), ("description", "some fund", "NEW", "77"), ("ticker", "QQ", "OLD", None), ("ticker", "NO", None, "5")], "match_type string, match_value string, ticker string, cik string")
    got = {r.row_id: (r.ticker, r.cik, r.method) for r in linking.link_securities(rows, companies, fixed).collect()}
    assert got[1] == ("AA", "0000000001", "ticker") and got[2] == ("BB", "0000000005", "override") and got[3] == ("NEW", "0000000077", "override")
    assert got[4] == ("OLD", "0000000000", "override") and got[5] == (None, None, "override") and got[6][2] == "unmatched"


def test_similar_companies_lose_no_pair(spark):
    """The rarest trigrams find every best match that comparing all with all finds, of texts with many repeated runs."""
    from lodestack.functions.similarity import common_length

    random.seed(5)
    titles = ["".join(random.choice("aab ") for _ in range(random.randint(1, 24))).strip() or "a" for _ in range(150)]
    texts = []
    for t in titles + titles:
        letters = list(t)
        for _ in range(random.randint(0, 4)):
            k = random.randrange(len(letters) + 1)
            letters[k : k + random.randint(0, 1)] = random.choice(["", "a", "b"])
        texts.append("".join(letters))
    companies = spark.createDataFrame([(f"{k:03}", t) for k, t in enumerate(titles)], "cik string, title string")
    descriptions = spark.createDataFrame([(t,) for t in texts], "description string")
    got = {r.description: r.score for r in linking.similar_companies(descriptions, companies).collect()}
    prepared = spark.createDataFrame([(t,) for t in {*titles, *texts}], "t string").select("t", linking.sim.sorted_tokens(linking.company_name("t")))
    plain = dict(map(tuple, prepared.collect()))
    score = lambda a, b: round(200 * common_length(a, b) / (len(a) + len(b)), 4) if a and b else 0.0
    want = {t: max(score(plain[t], plain[c]) for c in titles) for t in set(texts)}
    assert got == {t: s for t, s in want.items() if s >= 90}
    assert 20 < sum(s < 100 for s in got.values())


def test_lines_of_words(spark):
    """Bands begin at their first word; words without a place are apart."""
    data = [("f", 0, "b", 2.0, 1.0), ("f", 0, "a", 1.0, 4.0), ("f", 0, "c", 0.0, 4.5), ("f", 0, "d", 0.0, 7.5), ("f", 0, "e", 0.0, 7.6), ("f", 0, "x", 0.0, None), ("g", 1, "y", 0.0, None)]
    rows = forms.lines_of(spark.createDataFrame(data, forms.WORD_SCHEMA)).collect()
    assert sorted((r.filing_id, r.line, "".join(w.text for w in r.words)) for r in rows) == [("f", -1, "x"), ("f", 0, "ab"), ("f", 1, "cd"), ("f", 2, "e"), ("g", -1, "y")]
