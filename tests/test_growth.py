"""Work that grows with the tables: what must not be held whole, and results on groups of any size."""

from pyspark.sql import functions as F

from lodestack.operators import quality
from lodestack.plans.state import State


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def small_state(spark, tmp_path) -> State:
    state = State(spark, "file://" + str(tmp_path / "state"))
    ids = spark.range(50).select(F.col("id").cast("string").alias("filing_id"))
    state.append("filings", ids.withColumns({"chamber": F.lit("house"), "filer_name": F.lit("A"), "filing_type": F.lit("P"), "format": F.lit("unknown"), "parse_status": F.lit("pending"), "source": F.lit("official")}))
    state.append("transactions", ids.withColumns({"transaction_id": F.col("filing_id"), "row_index": F.lit(0), "asset_description_raw": F.lit("A"), "tx_type": F.lit("purchase"), "is_current": F.lit(True)}))
    return state


def test_the_metrics_broadcast_no_filings(spark, tmp_path):
    state = small_state(spark, tmp_path)
    m = quality.metrics(state.read("transactions"), state.read("filings"), state.read("dq_issues"), F.lit("2024-01-01").cast("date"))
    assert "BroadcastHashJoin" not in plan_of(m) and m.first()["total_transactions"] == 50


def test_staged_rows_are_not_broadcast(spark, tmp_path):
    state = small_state(spark, tmp_path)
    few = state.staged("few", spark.range(5).select(F.col("id").cast("string").alias("filing_id")))
    pages = spark.range(50).select(F.col("id").cast("string").alias("filing_id"))
    for joined, n in ((pages.join(few, "filing_id", "left_semi"), 5), (pages.join(state.read("filings").select("filing_id").distinct(), "filing_id"), 50)):
        assert "BroadcastHashJoin" not in plan_of(joined) and joined.count() == n


def test_live_messages_have_every_line_of_a_long_filing(spark, tmp_path):
    import duckdb

    import __spark_entry__ as entry

    folder = str(tmp_path / "tables")
    spark.read.parquet("/root/testdata/sf0.001/orders.parquet").filter("o_orderkey in (0, 2)").coalesce(1).write.parquet(f"{folder}/orders.parquet")
    line = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").orderBy("l_orderkey", "l_partkey").limit(20)
    line.withColumn("l_orderkey", F.lit(2).cast("long")).withColumn("l_partkey", F.monotonically_increasing_id()).coalesce(1).write.parquet(f"{folder}/lineitem.parquet")
    rows = sorted(tuple(r) for r in entry.queries()["live_messages"](spark, folder).collect())
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet/*.parquet')")
    assert len(rows) == 20 and rows == sorted(con.execute(entry.oracle_sql()["live_messages"]).fetchall())


def test_pages_of_words_give_the_lines_of_word_rows_without_a_shuffle(spark):
    from lodestack.operators import forms

    words = [("f", 0, t, x, y) for t, x, y in (("b", 20.0, 12.9), ("a", 10.0, 10.0), ("c", 5.0, 13.5), ("", 7.0, None), ("d", 5.0, 13.0), ("e", 5.0, 13.0), ("g", None, 30.0))] + [("g", 1, "z", 1.0, 1.0), ("h", 0, "n", 1.0, None)]
    rows = spark.createDataFrame(words, forms.WORD_SCHEMA)
    pages = rows.groupBy("filing_id", "page").agg(F.collect_list(F.struct("text", "x0", "top")).alias("words")).localCheckpoint()
    pages = pages.unionByName(spark.createDataFrame([("empty", 0, []), ("none", 0, None)], "filing_id string, page int, words array<struct<text:string,x0:double,top:double>>"))
    shown = lambda lines: {(r.filing_id, r.page, r.line): [w.text for w in r.words] for r in lines.collect()}
    expected = {("f", 0, -1): [""], ("f", 0, 0): ["d", "e", "a", "b"], ("f", 0, 1): ["c"], ("f", 0, 2): ["g"], ("g", 1, 0): ["z"], ("h", 0, -1): ["n"]}
    assert shown(forms.lines_of(pages)) == shown(forms.lines_of(rows)) == expected
    assert "Exchange" not in plan_of(forms.lines_of(pages))


def test_plain_pages_are_read_without_the_library_parser(monkeypatch):
    from lodestack.sources import html_tables

    plain, odd = "<p>x<table class='t'><caption>C<tr><TD>a &amp; b</td><td> c<tr><td>d", "<table><!-- <td> --><tr><td>a<br/>b<td>c"
    assert html_tables.first_table(odd) == [["a b", "c"]]
    monkeypatch.setattr(html_tables.FirstTable, "feed", lambda *_: 1 / 0)
    assert html_tables.first_table(plain) == [["a & b", "c"], ["d"]]


def test_admission_takes_no_task_per_block(spark, tmp_path):
    from lodestack.operators import admission

    queue = spark.range(400).select(F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("bucket"), F.col("id").cast("string").alias("key"), (F.col("id") % 7).alias("bytes"), (400 - F.col("id")).alias("place"))
    used = spark.createDataFrame([("a", 5)], "bucket string, total_bytes long")
    folder = str(tmp_path / "admission")
    got = {(r.bucket, r.key): r.admitted for r in admission.admit(queue, used, 300, folder, rows=10).collect()}
    expected, taken = {}, {"a": 5, "b": 0}
    for r in sorted(queue.collect(), key=lambda r: (r.bucket, r.place, r.key)):
        expected[r.bucket, r.key] = taken[r.bucket] + r.bytes <= 300
        taken[r.bucket] += r.bytes * expected[r.bucket, r.key]
    assert got == expected and set(got.values()) == {True, False}
    assert len(list((tmp_path / "admission" / "blocks").rglob("*.parquet"))) == 1


def test_parts_are_the_ntiles(spark, tmp_path):
    from pyspark.sql import Window

    from lodestack import catalog_landed

    for n in (0, 4, 101):
        rows = spark.range(n).select((F.col("id") * 7 % 1000).alias("k"))
        parts = catalog_landed._in_parts(spark, rows, "k", 6, str(tmp_path / str(n)))
        assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, rows.withColumn("part", F.ntile(6).over(Window.orderBy("k"))).collect()))


def test_parsed_reports_are_joined_without_broadcasts(spark, sf):
    import __spark_entry__ as entry

    assert "BroadcastHashJoin" not in plan_of(entry.queries()["reports_parsed"](spark, sf))


def test_a_replacement_computes_its_rows_once_and_an_empty_one_empties_the_table(spark, tmp_path):
    state, seen = small_state(spark, tmp_path), spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    schema = state.read("filings").schema
    ids = spark.range(50).select(F.col("id").cast("string").alias("filing_id"))
    rows = ids.withColumns({f.name: F.lit("B" if f.dataType.simpleString() == "string" else None).cast(f.dataType) for f in schema if f.name != "filing_id"}).mapInArrow(counted, "filing_id string, " + ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema if f.name != "filing_id"))
    assert state.replace("filings", rows.withColumn("chamber", F.lit("house"))).filter("filer_name = 'B'").count() == 50 and seen.value == 50
    assert state.replace("filings", state.staged("none", state.read("filings").filter("false"))).count() == 0 == state.read("filings").count()


def test_amendments_followed_again_rewrite_nothing(spark, tmp_path):
    from lodestack.plans import jobs

    state = small_state(spark, tmp_path)
    ids = spark.range(100, 104).select(F.col("id").cast("string").alias("filing_id"))
    state.append("filings", ids.withColumns({"chamber": F.lit("house"), "filer_name": F.lit("A"), "filed_date": F.lit("2024-01-01").cast("date"), "filing_type": F.lit("P"), "format": F.lit("unknown"), "parse_status": F.lit("pending"), "source": F.lit("official")}))
    state.append("transactions", ids.withColumns({"transaction_id": F.col("filing_id"), "row_index": F.lit(0), "asset_description_raw": F.lit("A"), "tx_type": F.lit("purchase"), "is_current": F.lit(True), "source_transaction_id": F.lit("s")}))
    files = lambda: {t: sorted(state.read(t).inputFiles()) for t in ("filings", "transactions")}
    jobs.follow_amendments(state)
    before = files()
    jobs.follow_amendments(state)
    assert files() == before
    assert {r[0] for r in state.read("transactions").filter("not is_current").select("filing_id").collect()} == {"100", "101", "102"}
    assert [tuple(r) for r in state.read("filings").filter("supersedes_filing_id is not null").select("filing_id", "supersedes_filing_id").collect()] == [("103", "100")]


def test_transcribed_rows_are_computed_once(spark, tmp_path):
    from lodestack.plans import jobs

    state, seen = small_state(spark, tmp_path), spark.sparkContext.accumulator(0)
    state.append("filings", state.read("filings").withColumns({"filing_id": F.concat(F.lit("x"), "filing_id"), "parse_status": F.lit("paper_deferred")}))

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(50).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("filing_id"), F.lit(0).alias("row_index"), F.lit("A").alias("asset_description_raw"), F.when(F.col("id") % 2 == 0, "purchase").alias("tx_type"), *(F.lit("c").alias(c) for c in ("confidence", "review", "note")))
    rows = rows.mapInArrow(counted, rows.schema)
    now = F.lit("2024-01-01").cast("timestamp")
    assert jobs.import_transcribed(state, rows, "f.csv", now) == 50 and seen.value == 50
    assert state.read("transactions").count() == 75 and state.read("dq_issues").count() == 25 == state.read("transaction_provenance").count()
    assert jobs.import_transcribed(state, rows, "f.csv", now) == 0 and state.read("transactions").count() == 75


def test_a_long_queue_is_cut_by_ranges_without_a_single_task_sort(spark, tmp_path):
    from lodestack.operators import ingest

    rows = spark.range(1000).select((F.col("id") * 7 % 1000).cast("string").alias("k"), (F.col("id") % 3).alias("tier"))
    flagged = rows.filter("tier = 1").select("k")
    number = iter(range(100))

    def stage(df):
        path = f"file://{tmp_path}/{next(number)}"
        df.write.parquet(path)
        return spark.read.parquet(path)

    for limit in (0, 1, 499, 667, 999, 1000, 5000):
        for last in (True, False):
            plain = ingest.flagged_first(rows, flagged, "k", limit, "tier", "k", last=last)
            cut = ingest.flagged_first(rows, flagged, "k", limit, "tier", "k", last=last, stage=stage, few=-1)
            assert cut.columns == plain.columns and sorted(map(tuple, cut.collect())) == sorted(map(tuple, plain.collect()))
    cut = ingest.flagged_first(rows, flagged, "k", 900, "tier", "k", stage=stage, few=10)
    assert cut.count() == 900 and "TakeOrderedAndProject(limit=900" not in plan_of(cut)


def test_a_trade_text_is_asked_for_once(spark, tmp_path, monkeypatch):
    from lodestack.operators import linking
    from lodestack.plans import jobs

    state, asked, ask = small_state(spark, tmp_path), [], linking.link_securities
    monkeypatch.setattr(linking, "link_securities", lambda rows, *a: (asked.append(rows.count()), ask(rows, *a))[1])
    companies = spark.createDataFrame([("0000000001", "T", "Zzqx", 1)], "cik string, ticker string, title string, position long")
    none = spark.createDataFrame([], "match_type string, match_value string, ticker string, cik string")
    jobs.link_trades(state, companies, none, F.lit("2024-01-01").cast("timestamp"), 40)
    assert asked == [1] and state.read("dq_issues").count() == 40 and state.read("transactions").filter("instrument_id is null").count() == 50


def test_terms_with_a_given_last_day_start_no_job_over_the_facts(spark):
    from datetime import date

    from lodestack.operators import linking

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    facts = spark.createDataFrame([(1, date(2020, 1, 1)), (1, date(2019, 1, 1)), (2, date(2020, 5, 5))], "k int, as_of date").mapInArrow(counted, "k int, as_of date")
    terms = spark.createDataFrame([(1, date(2019, 6, 1), None), (2, date(2020, 5, 5), date(2020, 5, 5))], "k int, start_date date, end_date date")
    got = linking.active_terms(facts, terms, "k", "as_of", last=date(2021, 1, 1))
    assert seen.value == 0
    assert sorted((r.k, r.as_of) for r in got.collect()) == [(1, date(2020, 1, 1)), (2, date(2020, 5, 5))]


def test_community_rows_are_stored_compressed_and_those_without_a_filing_stay(spark, tmp_path):
    from lodestack.plans import jobs

    state = small_state(spark, tmp_path)
    feed = "source string, chamber string, external_filing_id string, filer_name string, tx_date date, ticker string, asset_description string, tx_type string, owner string, amount_min double, amount_max double"
    rows = spark.createDataFrame([("s", "house", i, "A", None, t, "d", "purchase", None, 1.0, None) for i, t in (("7", "a"), ("7", "a"), ("7", "b"), ("new", "a"), (None, "a"))], feed)
    assert [jobs.import_community(state, rows) for _ in range(2)] == [4, 0]
    state.append("filings", state.read("filings").limit(1).withColumn("filing_id", F.lit("new")))
    jobs.rematch_community(state)
    stored = state.read("community_transactions")
    assert sorted((str(r[0]), str(r[1])) for r in stored.select("external_filing_id", "matched_filing_id").collect()) == [("7", "7"), ("7", "7"), ("None", "None"), ("new", "new")]
    assert all(".zstd." in f for f in stored.inputFiles()) and stored.filter("length(dedup_key) = 64").count() == 4


def silences(spark, folder, kind, batches, **options):
    from lodestack.streaming import first_seen, keyed

    for rows in batches:
        spark.createDataFrame(rows, f"key {kind}, at timestamp").coalesce(1).write.mode("append").parquet(f"{folder}/in")
    told = keyed.silent_keys(first_seen.read_events(spark, f"{folder}/in", f"key {kind}, at timestamp", files=1), **options)
    keyed.run_available(told, "append", keyed.batch_files(f"{folder}/out"), f"{folder}/checkpoint")
    return sorted(((str(r.key), r.last_at) for r in spark.read.schema(f"key {kind}, last_at timestamp").parquet(f"{folder}/out").collect()))


def test_silent_keys_of_one_state_are_told_apart(spark, tmp_path):
    from datetime import datetime, timedelta

    day = lambda x: datetime(2024, 1, 1) + timedelta(days=x)
    big = 2**60 + 1
    batches = [[(1, day(0)), (big, day(0)), (None, day(0)), (3, day(0)), (3, day(2.5))], [(1, day(0.5)), (1, day(2.9)), (None, day(3)), (big, day(2.6))], [(3, day(3.5)), (4, day(9))]]
    expected = sorted([(str(k), day(d)) for k, d in ((1, 0.5), (1, 2.9), (big, 0), (big, 2.6), (None, 0), (None, 3), (3, 0), (3, 3.5))])
    for n in (1, 1024):
        # the second batch's rows are not late, as its watermark for late rows is that before the first
        assert silences(spark, tmp_path / f"long-{n}", "long", batches, buckets=n) == expected
    strings = [[(None if k is None else str(k), at) for k, at in rows] for rows in batches]
    assert silences(spark, tmp_path / "string", "string", strings, buckets=1) == expected


def test_many_silent_keys_share_few_groups(spark, tmp_path):
    from datetime import datetime

    rows = [(k, datetime(2024, 1, 1 + 3 * d)) for d in range(2) for k in range(3000)]
    got = silences(spark, tmp_path, "long", [rows[:3000], rows[3000:]])
    assert len(got) == 3000 == len(set(got))
    groups = spark.read.format("statestore").load(f"{tmp_path}/checkpoint").count()
    assert 0 < groups <= 1024


def test_the_job_of_reports_broadcasts_nothing_in_any_of_its_steps(spark, sf):
    import __spark_entry__ as entry

    store = spark._jsparkSession.sharedState().statusStore()
    steps = lambda: [store.executionsList().apply(i) for i in range(store.executionsList().size())]
    before = {x.executionId() for x in steps()}
    assert entry.queries()["reports_parsed"](spark, sf).count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    plans = [x.physicalPlanDescription() for x in steps() if x.executionId() not in before]
    assert len(plans) > 10 and any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)


def test_the_first_of_a_queue_are_told_without_a_shuffle_of_its_rows(spark):
    from lodestack.operators import ingest

    queue = spark.range(3000).select((F.col("id") * 7 % 3000).cast("string").alias("k"), (F.col("id") % 3 == 0).cast("int").alias("_flag")).localCheckpoint()
    ordered = sorted((r._flag, r.k) for r in queue.collect())
    for limit in (0, 1, 1999, 2000, 2001, 2500, 3000, 9000):
        taken = ingest.first_of_queue(queue, "k", limit, few=10)
        assert sorted((r._flag, r.k) for r in queue.filter(taken).collect()) == ordered[:limit]
        assert "Exchange" not in plan_of(queue.filter(taken)) and queue.filter(~taken).count() == max(0, 3000 - limit)
    assert ingest.nth_key(spark.range(50_000).select(F.format_string("%06d", "id").alias("k")), "k", 20_001, 50_000, few=100) == "020000"


def test_linked_trades_meet_their_rows_and_issues_without_a_second_join(spark, tmp_path):
    from lodestack.plans import jobs

    state = small_state(spark, tmp_path)
    companies = spark.createDataFrame([("0000000001", "T", "Zzqx", 1)], "cik string, ticker string, title string, position long")
    none = spark.createDataFrame([], "match_type string, match_value string, ticker string, cik string")
    state.append("transactions", state.read("transactions").filter("filing_id < '3'").withColumns({"transaction_id": F.concat(F.lit("t"), "transaction_id"), "ticker": F.lit("T")}))
    n = state.read("transactions").count()
    store = spark._jsparkSession.sharedState().statusStore()
    steps = lambda: [store.executionsList().apply(i) for i in range(store.executionsList().size())]
    before = {x.executionId() for x in steps()}
    jobs.link_trades(state, companies, none, F.lit("2024-01-01").cast("timestamp"), 60)
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    writes = [x.physicalPlanDescription() for x in steps() if x.executionId() not in before]
    written = [p for p in writes if "InsertIntoHadoopFsRelationCommand" in p and any(f"/state/{t}," in p for t in ("transactions", "dq_issues"))]
    assert len(written) == 2 and not any("Join" in p or "Exchange" in p for p in written)
    for _ in range(2):
        jobs.link_trades(state, companies, none, F.lit("2024-01-02").cast("timestamp"), 60)
    t, issues = state.read("transactions"), state.read("dq_issues")
    assert t.count() == n == t.select("transaction_id").distinct().count() and t.filter("instrument_id is not null").count() == n - 50
    assert issues.count() == 50 == issues.select("transaction_id").distinct().count()


def test_trades_of_forms_are_cut_from_whole_filings_in_one_pass(spark):
    from lodestack.operators import forms

    head = [(t, x, 10.0) for t, x in (("Owner", 60.0), ("Asset", 105.0), ("Transaction", 262.0), ("Date", 330.0), ("Notification", 385.0), ("Amount", 450.0), ("Cap.", 527.0))]
    row = lambda y, name: [(name, 106.0, y), ("P", 263.0, y), ("1/2/2020", 331.0, y), ("$5", 451.0, y), ("-", 470.0, y)]
    pages = []
    for f in range(40):
        # a record goes on over pages, the header of the first page holds for all, and pages of many filings share a batch
        pages += [(f"f{f}", 0, head + row(30.0, f"A{f}")), (f"f{f}", 1, [("more", 106.0, 5.0), ("$9", 451.0, 5.0), *row(30.0, "B")]), (f"f{f}", 2, [("Description:", 106.0, 5.0), ("aside", 106.0, 20.0)] if f % 2 else None)]
    pages += [("bare", 0, []), ("scan", 0, [("cover", 1.0, 1.0)])]
    df = spark.createDataFrame(pages, "filing_id string, page int, words array<struct<text:string,x0:double,top:double>>")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    try:
        read = forms.read_trades(df).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    got = sorted((r.filing_id, r.row_index, r.asset_description_raw, r.amount_min, r.amount_max) for r in read if r.electronic)
    assert got == sorted(x for f in range(40) for x in ((f"f{f}", 0, f"A{f} more", 5.0, 9.0), (f"f{f}", 1, "B", 5.0, None)))
    assert [(r.filing_id, r.row_index, r.owner) for r in read if not r.electronic] == [("scan", None, None)]
    assert plan_of(forms.trade_form(df)).count("Exchange ") == 1


def test_regular_tables_are_cut_without_the_builder(spark, monkeypatch):
    import pyarrow as pa
    import pyarrow.compute as pc

    from lodestack.sources import html_tables

    page = "<html><body class='x'><p>a</p><table id=\"t\"><thead><tr><th>#</th></tr></thead>\n<tbody><tr><td> a &amp; b </td><td></td>\n</tr><tr></tr></tbody><tbody><tr class='y'><td>\xa0c&nbsp;</td></tr></tbody></table><script>"
    odd = ["<table><tbody><tr><td>a<td>b</td></tr></tbody></table>", "<title><tr></title><table><tbody><tr><td>a</td></tr></tbody></table>", "<p>none", "", None]
    cut = lambda: sorted((r.k, r.row_index, r.cells) for r in html_tables.table_cells(spark.createDataFrame([(i, p) for i, p in enumerate([page, *odd])], "k int, p string"), "k", "p").collect())
    assert cut() == [(0, 0, ["a & b", ""]), (0, 1, []), (0, 2, ["c"]), (1, 0, ["a", "b"]), (2, 0, ["a"])]
    # the regular page needs no builder
    monkeypatch.setattr(html_tables, "first_table", lambda _: 1 / 0)
    one = pa.array([page])
    n, cells = html_tables._regular_cells(one)
    assert pc.match_substring_regex(one, html_tables.REGULAR).to_pylist() == [True]
    assert n.tolist() == [3] and cells.to_pylist() == [["a & b", ""], [], ["c"]]


def test_saved_reports_rewrite_their_filings_once(spark, tmp_path):
    from lodestack.plans import jobs

    state = small_state(spark, tmp_path)
    state.replace("filings", state.read("filings").withColumn("raw_object_key", F.lit("k")))
    written, replace = [], State.replace
    words = spark.createDataFrame([("1", 0, "cover", 1.0, 1.0)], "filing_id string, page int, text string, x0 double, top double")
    state.replace = lambda table, rows: (written.append(table), replace(state, table, rows))[1]
    jobs.parse_trade_forms(state, words, F.lit("2024-01-01").cast("timestamp"))
    assert sorted(written) == ["filings", "transactions"] and state.read("filings").filter("parse_status = 'paper_deferred' and format = 'scanned'").count() == 50
    assert state.read("dq_issues").count() == 0 and state.read("transactions").count() == 50


def test_community_rows_move_once_and_are_rewritten_part_by_part(spark, tmp_path):
    from lodestack.operators import versions
    from lodestack.plans import jobs

    state = small_state(spark, tmp_path)
    feed = "source string, chamber string, external_filing_id string, filer_name string, tx_date date, ticker string, asset_description string, tx_type string, owner string, amount_min double, amount_max double"
    rows = spark.createDataFrame([(s, "house", i, "A", None, str(t), "d", "purchase", None, 1.0, None) for s in ("s", "r", None) for i in ("7", "new", None, "8") for t in (1, 2, 2, 3)], feed)
    key = F.sha2(F.concat_ws("|", F.coalesce("external_filing_id", F.lit("")), "ticker"), 256)
    stored = rows.filter("ticker = '3'").select("source", "external_filing_id", F.unhex(key).alias("_key"))
    met = versions.import_covered(stored, rows, state.read("filings"), "source", F.unhex(key), "external_filing_id", "filing_id")
    assert plan_of(met).count("Exchange hashpartitioning") == 1 and "Join" not in plan_of(met)
    assert met.count() == 24 and met.filter("matched_id is not null").count() == 12 == met.filter("matched_id = external_filing_id").count()

    assert [jobs.import_community(state, rows) for _ in range(2)] == [36, 0]
    state.append("filings", state.read("filings").limit(1).withColumn("filing_id", F.lit("new")))
    odd = state.read("community_transactions").limit(1).withColumns({"dedup_key": F.lit("No hash"), "external_filing_id": F.lit("new"), "matched_filing_id": F.lit(None).cast("string")})
    state.append("community_transactions", odd)
    before = {tuple(r) for r in state.read("community_transactions").drop("matched_filing_id").collect()}
    written, put = [], State.replace_part
    state.replace_part = lambda table, part, rows: (written.append(part), put(state, table, part, rows))[1]
    jobs.rematch_community(state)
    after = state.read("community_transactions")
    assert len(written) > 1 and written == state.parts("community_transactions")
    assert {tuple(r) for r in after.drop("matched_filing_id").collect()} == before and after.count() == 37
    assert after.filter("matched_filing_id is null").count() == 9 == after.filter("external_filing_id is null").count()
