"""Odd cases of landed files, stored objects, admission, streams with state and tables in partitions."""

import hashlib
import random
from datetime import date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from lodestack.operators import admission, linking
from lodestack.plans import partitions
from lodestack.sources import landed, objects
from lodestack.sources.entries import keyed_entries, list_entries
from lodestack.sources.html_tables import first_table, table_cells
from lodestack.streaming import first_seen, keyed


@pytest.mark.parametrize(
    "page, rows",
    [
        ("<table><tr><td>1<td>2<tr><td>3</table>", [["1", "2"], ["3"]]),
        ("<table><thead><tr><td>h</thead><tr><td>1</td><td>2", [["1", "2"]]),
        # a nested table belongs to its cell, and its rows are rows of the page
        ("<table><tr><td>a<table><tr><td>x<th>y</table>b<td>9</table>", [["a x y b", "x", "9"], ["x"]]),
        ("<table><thead><tr><th><table><tr><td>n</table></thead><tbody><tr><td>k</table>", [["n"], ["k"]]),
        # a table outside of a cell ends the one before it
        ("<table><tr><td>1</table><table><tr><td>2</table>", [["1"]]),
        ("<table><tr><table><tr><td>2", [[]]),
        # text between the parts stands before the table
        ("<table><tr><td>a <table>lost <tr><td>b</td></tr> gone</table> c</table>", [["a lost gone b c", "b"], ["b"]]),
        ("lost <table>lost<tr>lost<td>1</td>lost</tr></table>", [["1"]]),
        # ends of what is not open mean nothing
        ("<table><tr><td/>x<td>y</tbody>z<tr><td>1</th></td></td><td>2</tfoot>3</table>4", [["x", "y"], ["1", "2 3"]]),
        ("<table><caption>c<p>d</tr></caption><colgroup><col><tr><td>1</table>", [["1"]]),
        ("<table><caption>c<tr><td>1</table>", [["1"]]),
        ("<TABLE><TBODY><TR><TD>A &amp; B&nbsp;<BR> <b>C</b> D<!-- x --></TD></TR></TBODY></TABLE>", [["A & B C D"]]),
        ("<td>1<tr><td>2", []), ("<p>no table", []), ("", []), (None, []),
    ],
)
def test_first_table(page, rows):
    assert first_table(page) == rows


def test_table_cells_of_odd_pages(spark):
    pages = spark.createDataFrame([(1, "<table><tr><td>é<td>" + "x" * 100_000 + "<tr>"), (2, None), (3, ""), (1, "<table><tr><td>again")], "k long, html string").withColumnRenamed("k", "a.b")
    got = sorted((r[0], r[1], r[2]) for r in table_cells(pages, "a.b", "html").collect())
    assert got == [(1, 0, ["again"]), (1, 0, ["é", "x" * 100_000]), (1, 1, [])]
    assert not table_cells(pages.limit(0), "a.b", "html").collect()


# --- YAML


@pytest.fixture
def small_splits(spark):
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "512")
    yield
    spark.conf.set(name, before)


def test_people_of_one_large_file(spark, tmp_path, small_splits):
    people = [f"- id:\n    bioguide: P{i}\n  name:\n    first: Ann\n    last: 'O''Neil - {i}'\n  terms:\n  - type: rep\n    start: '2015-01-03'\n    party: 'a: b'\n  - type: sen\n    start: '2019-01-03'\n    end: '2025-01-03'\n" for i in range(200)]
    (tmp_path / "p.yaml").write_text("---\n# people\n" + "".join(people))
    entries = list_entries(spark, str(tmp_path / "p.yaml"))
    assert entries.count() == 200 and entries.rdd.getNumPartitions() > 10
    got = landed.people_terms(spark, str(tmp_path / "p.yaml"))
    assert {(r.bioguide_id, r.full_name, r.chamber) for r in got.collect()} == {(f"P{i}", f"Ann O'Neil - {i}", c) for i in range(200) for c in ("house", "senate")}


def test_memberships_of_one_large_file(spark, tmp_path, small_splits):
    rng = random.Random(1)
    want, text = set(), ""
    for c in range(40):
        if c % 5 == 1:
            text += f"I{c}: [{{bioguide: B1, rank: 1}}, {{name: x}}]\nJ{c}:\n  [{{bioguide: B2}}]\n"
            want |= {(f"I{c}", "B1", 1), (f"J{c}", "B2", None)}
        text += f"C{c:02}:\n"
        for m in range(rng.choice([1, 2, 30])):
            text += f"- name: 'A: {m}'\n  rank: {m}\n  bioguide: B{m}\n"
            want.add((f"C{c:02}", f"B{m}", m))
    (tmp_path / "m.yaml").write_text(text)
    (tmp_path / "n.yaml").write_text("D:\n- bioguide: X\n- title: no id\n")
    rows = keyed_entries(spark, str(tmp_path))
    assert rows.rdd.getNumPartitions() >= 1
    known = spark.createDataFrame([(k,) for k in {k for k, _, _ in want} | {"D"}], "thomas_id string")
    got = landed.memberships(spark, str(tmp_path), known)
    assert {(r.thomas_id, r.bioguide_id, r["rank"]) for r in got.collect()} == want | {("D", "X", None)}


# --- objects


def test_copies_are_checked_and_failures_collected(spark, tmp_path):
    here, there = (tmp_path / x for x in ("here", "there"))
    rows = [("a/1.pdf", b"one"), ("a/2.pdf", b""), ("b/3", b"x" * 3_000_000), ("b/4", b"four")]
    done = objects.put_objects(spark.createDataFrame(rows, "key string, content binary"), f"file://{here}").collect()
    assert {(r.key, r.outcome, r.sha256) for r in done} == {(k, "copied", hashlib.sha256(c).hexdigest()) for k, c in rows}
    listed = objects.listing(spark, f"file://{here}")
    assert {(r.key, r.bytes) for r in listed.collect()} == {(k, len(c)) for k, c in rows if c}  # Spark passes over files of zero bytes
    assert "content:" not in listed._jdf.queryExecution().executedPlan().toString()
    entries = [(k, hashlib.sha256(c).hexdigest()) for k, c in rows[:3]] + [("b/4", "0" * 64), ("none", None)]
    df = spark.createDataFrame(entries, "key string, sha256 string")
    first = {r.key: r for r in objects.copy_objects(df.unionByName(df), f"file://{here}", f"file://{there}").collect()}
    assert {k: r.outcome for k, r in first.items()} == {"a/1.pdf": "copied", "a/2.pdf": "copied", "b/3": "copied", "b/4": "failed", "none": "failed"}
    assert "digest" in first["b/4"].error and not (there / "b/4").exists()
    (there / "a/1.pdf").write_bytes(b"spoilt")
    again = {r.key: r.outcome for r in objects.copy_objects(df, f"file://{here}", f"file://{there}").collect()}
    assert again["a/1.pdf"] == "copied" and again["b/3"] == "present" and (there / "a/1.pdf").read_bytes() == b"one"
    assert not [p for p in there.rglob("*attempt*")]
    assert bytes(objects.read_object(spark, f"file://{here}", "a/1.pdf").first().content) == b"one"


def test_dumps_are_dated(spark, tmp_path):
    path = objects.dump(spark.range(3), f"file://{tmp_path}", "2026-01-09")
    assert path.endswith("/backup_20260109.json.gz") and spark.read.json(path).count() == 3


# --- admission


def test_admission_walks_in_order(spark, tmp_path):
    rng = random.Random(3)
    rows = [(b, f"k{i}", rng.choice([0, 1, 5, 50, 300]), i // 3) for b in ("x", "y", None) for i in range(200)]
    queue = spark.createDataFrame(rows, "bucket string, key string, bytes long, place long").repartition(5)
    used = spark.createDataFrame([("x", 100), ("z", 5)], "bucket string, total_bytes long")
    for ceiling, block in ((1000, 7), (1000, 10_000), (50, 20), (10**9, 20)):
        want = set()
        for b in ("x", "y", None):
            mine = sorted((p, k, s) for x, k, s, p in rows if x == b)
            fits = admission.walk(np.asarray([s for _, _, s in mine]), 100 if b == "x" else 0, ceiling)
            want |= {(b, k, s, bool(f)) for (_, k, s), f in zip(mine, fits)}
        if b is None:
            queue_, want = queue.filter("bucket is not null"), {w for w in want if w[0] is not None}
        got = admission.admit(queue_, used, ceiling, f"file://{tmp_path}/{ceiling}-{block}", block)
        assert {tuple(r) for r in got.collect()} == want
    assert not admission.admit(queue.limit(0), used, 10, f"file://{tmp_path}/none").collect()


# --- streams


def test_totals_go_on_from_a_checkpoint_and_take_recounts(spark, tmp_path):
    def land(rows):
        spark.createDataFrame(rows, "bucket string, kind string, seq long, bytes long, objects long").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = first_seen.read_events(spark, f"{tmp_path}/in", "bucket string, kind string, seq long, bytes long, objects long", files=1)
        keyed.run_available(keyed.running_totals(stream), "update", keyed.batch_files(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
        return {r.bucket: (r.total_bytes, r.object_count) for r in keyed.latest_totals(spark.read.parquet(f"{tmp_path}/out")).collect()}

    land([("a", "add", 1, 10, 1), ("a", "add", 2, 5, 1), ("b", "add", 3, 7, 1)])
    assert run() == {"a": (15, 2), "b": (7, 1)}
    land([("a", "add", 4, 1, 1), ("a", "set", 5, 100, 9), ("a", "add", 6, 2, 1), ("a", "set", 3, 1, 1)])
    assert run() == {"a": (102, 10), "b": (7, 1)}
    land([("a", "add", 7, 3, 1)])
    assert run() == {"a": (105, 11), "b": (7, 1)}
    assert run() == {"a": (105, 11), "b": (7, 1)}


def test_silence_is_told_once_and_a_return_starts_anew(spark, tmp_path):
    start = datetime(2024, 1, 1)

    def land(*rows):
        spark.createDataFrame([(k, start + timedelta(hours=h)) for k, h in rows], "key string, at timestamp").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")

    def run():
        stream = first_seen.read_events(spark, f"{tmp_path}/in", "key string, at timestamp", files=1)
        keyed.run_available(keyed.silent_keys(stream), "append", keyed.batch_files(f"{tmp_path}/out"), f"{tmp_path}/checkpoint")
        told = spark.read.schema("key string, last_at timestamp").parquet(f"{tmp_path}/out").collect()
        return sorted((r.key, (r.last_at - start).total_seconds() / 3600) for r in told)

    land(("a", 0), ("b", 0), ("a", 20))
    assert run() == []
    land(("a", 44), ("b", 1))  # a is heard just in time; b's row is behind the watermark
    assert run() == [("b", 0.0)]
    land(("a", 60), ("b", 61))
    assert run() == [("b", 0.0)]
    land(("c", 100), ("b", 62))
    assert run() == [("a", 60.0), ("b", 0.0), ("b", 62.0)]


# --- partitions


def test_years_are_rewritten_alone(spark, tmp_path):
    now = F.lit("2024-01-01").cast("timestamp")
    rows = [("f1", "A", "P", date(2020, 5, 1), 2020), ("f2", "B", "P", date(2021, 5, 1), 2021), ("f2", "B", "P", date(2021, 4, 1), 2021), ("f3", "C", "P", None, 2021)]
    index = spark.createDataFrame(rows, "filing_id string, filer_name string, filing_type string, filed_date date, year int")
    folder = f"{tmp_path}/filings"
    partitions.backfill_years(spark, folder, index, "house", [2020, 2021], now)
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("year=2020/*.parquet")}
    late = spark.createDataFrame([("f9", "Z", "P", date(2021, 9, 9), 2021)], index.schema)
    partitions.backfill_years(spark, folder, index.unionByName(late), "house", [2021], F.lit("2025-01-01").cast("timestamp"))
    partitions.backfill_years(spark, folder, late, "senate", [2021], now)
    assert before == {p: p.stat().st_mtime_ns for p in tmp_path.rglob("chamber=house/year=2020/*.parquet")}
    got = {(r.chamber, r.filing_id): (r.year, str(r.first_seen_at)[:10], r.first_seen_precision_s) for r in partitions.stored(spark, folder, partitions.FILINGS).collect()}
    assert got == {
        ("house", "f1"): (2020, "2020-05-01", 86_400), ("house", "f2"): (2021, "2021-04-01", 86_400), ("house", "f3"): (2021, "2024-01-01", 315_360_000),
        ("house", "f9"): (2021, "2021-09-09", 86_400), ("senate", "f9"): (2021, "2021-09-09", 86_400),
    }


def test_refill_reads_by_the_predicate_and_fills_options_together(spark, tmp_path):
    schema = "filing_id string, row_index int, source_transaction_id string, asset_type string, option_type string, strike double, expiry date, year int"
    rows = [("a", 0, None, None, None, None, None, 1), ("a", 1, "s", "ST", None, None, None, 1), ("b", 0, "s", "OP", None, None, None, 2), ("c", 0, "s", "ST", None, None, None, 3), ("d", 0, None, "ST", None, None, None, 4)]
    folder = f"{tmp_path}/t"
    partitions.rewrite(spark.createDataFrame(rows, schema), folder, "year")
    plan = partitions.affected(partitions.stored(spark, folder, schema), "year")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(Or(IsNull(source_transaction_id)" in plan
    parsed = spark.createDataFrame([("a", 0, "n", "OP", "call", 2.0, date(2021, 1, 1)), ("a", 1, "n", "OP", "call", 2.0, None), ("b", 0, "n", "ST", "put", 3.0, None), ("c", 0, "n", "OP", "put", 1.0, None)], schema.rsplit(",", 1)[0])
    assert partitions.refill(spark, folder, schema, parsed, "year") == [1, 2, 4]
    got = {(r.filing_id, r.row_index): (r.source_transaction_id, r.asset_type, r.option_type, r.strike) for r in partitions.stored(spark, folder, schema).collect()}
    assert got == {("a", 0): ("n", "OP", "call", 2.0), ("a", 1): ("s", "ST", None, None), ("b", 0): ("s", "OP", "put", 3.0), ("c", 0): ("s", "ST", None, None), ("d", 0): (None, "ST", None, None)}
    assert partitions.refill(spark, f"{tmp_path}/none", schema, parsed, "year") == []


# --- intervals


def test_terms_meet_facts_once_whatever_the_buckets(spark):
    rng = random.Random(5)
    day = lambda n: date(2000, 1, 1) + timedelta(days=n)
    facts = [(i, rng.choice("ab"), day(rng.randint(0, 3000)) if i else None) for i in range(120)]
    terms = [(f"t{i}", rng.choice("abc"), day(b := rng.randint(-400, 3000)), day(b + rng.randint(-5, 900)) if i % 4 else None) for i in range(60)]
    f, t = spark.createDataFrame(facts, "id long, key string, as_of date"), spark.createDataFrame(terms, "term string, key string, start_date date, end_date date")
    want = {(i, n) for i, k, d in facts for n, c, b, e in terms if k == c and d and b <= d and (e is None or d <= e)}
    for days in (1, 180, 10_000):
        got = [(r.id, r.term) for r in linking.active_terms(f, t, "key", "as_of", days=days).collect()]
        assert len(got) == len(want) and set(got) == want
    assert not linking.active_terms(f.limit(0), t, "key", "as_of").collect()
    closed = [x for x in terms if x[3] and x[2] <= x[3]]
    both = {(a[0], b[0]) for a in closed for b in closed if a[1] == b[1] and a[2] <= b[3] and b[2] <= a[3]}
    got = [(r.term, r.other_term) for r in linking.overlapping_terms(t.filter("end_date is not null"), t.filter("end_date is not null"), "key", days=30).collect()]
    assert len(got) == len(both) and set(got) == both
