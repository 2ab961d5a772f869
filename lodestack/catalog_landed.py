"""Further queries of the catalogue: landed files, stored objects, streams with state and partitioned tables.

As in ``catalog``, the tables stand in for the engine's own, and each query has SQL for the same rows.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .catalog import _landing, _lit_ts, _report_row, query, table
from .functions import dates
from .operators import admission, ingest, linking
from .plans import jobs, partitions
from .plans.state import State
from .sources import landed, objects
from .streaming import first_seen, keyed

_NOTED = "l_linenumber % 3 = 0"
_ORDERED = "PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber, l_quantity, l_shipdate, l_extendedprice"


# ---------------------------------------------------------------- landed files


@query(f"""
SELECT l_orderkey AS filing_id, CAST(rn - 1 + noted AS INTEGER) AS row_index, CASE l_returnflag WHEN 'A' THEN 'spouse' WHEN 'R' THEN 'child' END AS owner, CASE WHEN l_linenumber <> 1 THEN 'T' || l_partkey END AS ticker,
 CASE WHEN l_linestatus = 'O' THEN 'purchase' ELSE 'sale_partial' END AS tx_type, CAST(l_quantity AS DOUBLE) AS amount_min, CAST(l_quantity + 1 AS DOUBLE) AS amount_max, CAST(l_shipdate AS DATE) AS tx_date
FROM (SELECT *, row_number() OVER ({_ORDERED}) AS rn, coalesce(sum(CASE WHEN {_NOTED} THEN 2 ELSE 0 END) OVER ({_ORDERED} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS noted FROM lineitem)
""")
def html_report_trees(spark, d):
    """Reports whose pages leave out end tags and bodies, and have a table in some rows' last cell; its two rows count for the row index."""
    bare = F.regexp_replace(_report_row(), "</(td|tr)>", "")
    row = F.when(F.expr(_NOTED), F.concat(bare, F.lit("<table><thead><tr><th>a note</th></thead><tr><td>more"), F.lit("</table>"))).otherwise(bare)
    placed = F.struct("l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_shipdate", "l_extendedprice", row.alias("html"))
    lines = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("filing_id")).agg(F.sort_array(F.collect_list(placed)).alias("x"))
    head = F.lit("<p>A report<table class='x'><caption>Trades<thead><tr><th>#<th>Date")
    pages = lines.select("filing_id", F.concat(head, F.lit("<tbody>"), F.array_join("x.html", ""), F.lit("</table><table><tr><td>another")).alias("html"))
    return landed.report_rows(pages).select("filing_id", "row_index", "owner", "ticker", "tx_type", "amount_min", "amount_max", "tx_date")


@query("SELECT 'C' || c_custkey AS thomas_id, CASE WHEN c_custkey % 3 = 0 THEN 'house' WHEN c_custkey % 3 = 1 THEN 'senate' ELSE 'joint' END AS chamber, c_name || ': a \"group\"' AS name FROM customer WHERE c_custkey % 5 <> 0")
def committees_file(spark, d):
    """Committees landed as YAML lists, read back by entries; those of another kind, or without a name, are dropped."""
    key = F.col("c_custkey")
    kind = F.when(key % 5 == 0, F.when(key % 2 == 0, "other").otherwise("house")).when(key % 3 == 0, "house").when(key % 3 == 1, "senate").otherwise("joint")
    name = F.when((key % 5 == 0) & (key % 2 == 1), "").otherwise(F.concat(F.lit("\n  name: '"), "c_name", F.lit(": a \"group\"'")))
    entry = F.concat(F.lit("- type: "), kind, F.lit("\n  thomas_id: C"), key.cast("string"), name, F.lit("\n  subcommittees:\n  - name: Inner\n    thomas_id: '01'"))
    folder = _landing(spark, "committees")
    table(spark, d, "customer").select(entry.alias("value")).write.text(folder)
    return landed.committees(spark, folder)


@query("""
SELECT 'N' || c_nationkey AS thomas_id, 'P' || c_custkey AS bioguide_id, CASE WHEN c_custkey % 2 = 0 THEN 'majority' ELSE 'minority' END AS party, CAST(c_custkey AS INTEGER) AS rank, CASE WHEN c_custkey % 7 = 0 THEN 'Chair' END AS title
FROM customer WHERE c_nationkey % 2 = 0 AND c_custkey % 11 <> 0
""")
def memberships_file(spark, d):
    """Members of committees landed as a YAML mapping from committees to lists, read back by entries; unknown committees and members without id are dropped."""
    key = F.col("c_custkey")
    who = F.when(key % 11 == 0, "name: Nobody").otherwise(F.concat(F.lit("bioguide: P"), key.cast("string")))
    member = F.concat(F.lit("- "), who, F.lit("\n  party: "), F.when(key % 2 == 0, "majority").otherwise("minority"), F.lit("\n  rank: "), key.cast("string"), F.when(key % 7 == 0, "\n  title: Chair").otherwise(""))
    lists = table(spark, d, "customer").groupBy("c_nationkey", F.pmod(F.xxhash64(key), F.lit(64)).alias("part")).agg(F.array_join(F.collect_list(member), "\n").alias("text"))
    folder = _landing(spark, "memberships")
    lists.select(F.concat(F.lit("N"), F.col("c_nationkey").cast("string"), F.lit(":\n"), "text").alias("value")).write.text(folder)
    known = table(spark, d, "nation").filter("n_nationkey % 2 = 0").select(F.concat(F.lit("N"), F.col("n_nationkey").cast("string")).alias("thomas_id"))
    return landed.memberships(spark, folder, known)


@query("""
SELECT 'senate_feed' AS source, 'senate' AS chamber, CASE WHEN o_orderkey % 4 <> 0 THEN 'senate:' || lpad(lower(to_hex(o_orderkey)), 8, '0') || '-0000-4000-8000-000000000000' END AS external_filing_id, 'Customer ' || o_custkey AS filer_name, CAST(o_orderdate AS DATE) AS tx_date, NULL::DATE AS disclosure_date,
 CASE WHEN o_orderkey % 3 = 0 THEN 50000000.0::DOUBLE ELSE 1001.0::DOUBLE END AS amount_min, CASE WHEN o_orderkey % 3 <> 0 THEN 15000.0::DOUBLE END AS amount_max FROM orders
""")
def senate_feed_file(spark, d):
    """A community feed landed as JSON arrays of at most some hundred entries, read back; the filing is the report that the link names."""
    key = F.col("o_orderkey")
    uuid = F.concat(F.lpad(F.upper(F.hex(key)), 8, "0"), F.lit("-0000-4000-8000-000000000000"))
    link = F.when(key % 4 == 0, "https://example.org/search/view/none/").otherwise(F.concat(F.lit("https://example.org/search/view/ptr/"), uuid, F.lit("/")))
    amount = F.when(key % 3 == 0, "Over $50,000,000").otherwise("$1,001 - $15,000")
    entry = F.struct(F.date_format("o_orderdate", "MM/dd/yyyy").alias("transaction_date"), F.concat(F.lit(" Customer "), F.col("o_custkey").cast("string")).alias("senator"), amount.alias("amount"), link.alias("ptr_link"), F.lit("An asset").alias("asset_description"))
    folder = _landing(spark, "senate-feed")
    pages = table(spark, d, "orders").groupBy(F.floor(key / 200)).agg(F.to_json(F.collect_list(entry)).alias("value"))
    pages.select("value").write.text(folder)
    rows = landed.feed_of(pages=spark.read.text(folder), chamber="senate")
    return rows.select("source", "chamber", "external_filing_id", "filer_name", "tx_date", "disclosure_date", "amount_min", "amount_max")


@query("SELECT lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS cik, CASE WHEN c_custkey % 4 <> 0 THEN CAST(1000 + c_nationkey AS VARCHAR) END AS sic, CASE WHEN c_custkey % 4 <> 0 THEN c_mktsegment END AS sic_description FROM customer")
def industry_documents(spark, d):
    """Submission documents landed as JSON, a line each, read back; empty codes are null."""
    code = lambda c: F.when(F.col("c_custkey") % 4 == 0, "").otherwise(c)
    doc = F.struct(F.col("c_custkey").cast("string").alias("cik"), code((F.col("c_nationkey") + 1000).cast("string")).alias("sic"), code(F.col("c_mktsegment")).alias("sicDescription"), F.array(F.lit("x")).alias("tickers"))
    folder = _landing(spark, "industries")
    table(spark, d, "customer").select(F.to_json(doc).alias("value")).write.text(folder)
    return landed.industry_codes(spark, folder, lines=True)


@query("""
SELECT o_orderkey AS filing_id, 'Some Company' AS asset_description_raw, CASE WHEN o_orderkey % 2 = 0 THEN 'call' ELSE 'put' END AS option_type, CAST(1000 + o_orderkey % 100 AS DOUBLE) + 0.5 AS strike, CAST(o_orderdate AS DATE) AS expiry FROM orders
""")
def option_cells(spark, d):
    """The option's type, price and last day in a report's asset cell, and the asset without them."""
    key = F.col("o_orderkey")
    price = F.concat(F.lit("1,0"), F.lpad((key % 100).cast("string"), 2, "0"), F.lit(".50"))
    cell = F.concat(F.lit(" Some Company Option Type: "), F.when(key % 2 == 0, "Call").otherwise("PUT"), F.lit("\nStrike price: $"), price, F.lit(" Expires: "), F.date_format("o_orderdate", "yyyy-MM-dd"))
    cells = [F.lit(""), F.lit("01/02/2020"), F.lit("Self"), F.lit("--"), cell, F.lit("Stock Option"), F.lit("Purchase"), F.lit("$1 - $2"), F.lit("")]
    html = F.concat(F.lit("<table><tr>"), *(F.concat(F.lit("<td>"), c) for c in cells))
    return landed.report_rows(table(spark, d, "orders").select(key.alias("filing_id"), html.alias("html"))).select("filing_id", "asset_description_raw", "option_type", "strike", "expiry")


# ---------------------------------------------------------------- stored objects


def _stored(spark, d, folder: str) -> DataFrame:
    """An object per customer below ``folder``."""
    c = table(spark, d, "customer")
    key = F.concat(F.lit("house/"), (F.col("c_custkey") % 7 + 2012).cast("string"), F.lit("/"), F.col("c_custkey").cast("string"), F.when(F.col("c_custkey") % 2 == 0, ".pdf").otherwise(".HTML"))
    done = objects.put_objects(c.select(key.alias("key"), F.encode("c_name", "utf-8").alias("content")), folder)
    done.write.mode("overwrite").parquet(f"{folder}-written")
    return spark.read.parquet(f"{folder}-written")


_KEY = "'house/' || (c_custkey % 7 + 2012) || '/' || c_custkey || CASE WHEN c_custkey % 2 = 0 THEN '.pdf' ELSE '.HTML' END"


@query(f"SELECT {_KEY} AS key, strlen(c_name) AS bytes, CASE WHEN c_custkey % 2 = 0 THEN 'application/pdf' ELSE 'text/html' END AS content_type FROM customer")
def object_listing(spark, d):
    """Keys and sizes of stored files, from the file system alone."""
    folder = _landing(spark, "objects")
    _stored(spark, d, folder)
    return objects.listing(spark, folder).select("key", "bytes", "content_type")


@query(f"""
SELECT {_KEY} AS key, CASE WHEN c_custkey % 10 = 0 THEN 'failed' WHEN c_custkey % 3 = 0 THEN 'present' ELSE 'copied' END AS outcome, CASE WHEN c_custkey % 10 <> 0 THEN strlen(c_name) END AS bytes, CASE WHEN c_custkey % 10 <> 0 THEN sha256(c_name) END AS sha256,
 c_custkey % 10 <> 0 AS there FROM customer
UNION ALL SELECT 'house/none.pdf', 'failed', NULL, NULL, false
""")
def objects_copied(spark, d):
    """Objects copied with their digests checked: some are there already, some have another digest than was noted, one is missing at the source."""
    here, there = _landing(spark, "source"), _landing(spark, "target")
    made = _stored(spark, d, here)
    number = F.regexp_extract("key", r"/(\d+)\.", 1).cast("long")
    noted = made.select("key", F.when(number % 10 == 0, F.sha2(F.lit("other"), 256)).otherwise(F.col("sha256")).alias("sha256"))
    ready = noted.filter((number % 3 == 0) & (number % 10 != 0))
    objects.copy_objects(ready, here, there).write.mode("overwrite").parquet(f"{there}-first")
    asked = noted.unionByName(spark.createDataFrame([("house/none.pdf", None)], "key string, sha256 string"))
    objects.copy_objects(asked, here, there).write.mode("overwrite").parquet(f"{there}-second")
    now = objects.listing(spark, there).select("key", F.lit(True).alias("there"))
    return spark.read.parquet(f"{there}-second").join(now, "key", "left").select("key", "outcome", "bytes", "sha256", F.coalesce("there", F.lit(False)).alias("there"))


@query(f"SELECT {_KEY} AS key, CASE WHEN c_custkey % 6 = 0 THEN 'failed' ELSE 'copied' END AS outcome FROM customer WHERE c_custkey % 3 = 0")
def objects_rederived(spark, d):
    """Objects that are missing, made anew from their rows; a row without content fails."""
    folder, c = _landing(spark, "objects"), table(spark, d, "customer")
    made = _stored(spark, d, folder)
    number = F.regexp_extract("key", r"/(\d+)\.", 1).cast("long")
    kept = _landing(spark, "kept")
    objects.copy_objects(made.filter(number % 3 != 0).select("key", "sha256"), folder, kept).write.mode("overwrite").parquet(f"{kept}-copied")
    contents = made.select("key", number.alias("c_custkey")).join(c, "c_custkey").select("key", F.when(F.col("c_custkey") % 6 != 0, F.encode("c_name", "utf-8")).alias("content"))
    return objects.rederive(made, contents, spark, kept).select("key", "outcome")


@query("""
WITH RECURSIVE o AS (SELECT o_orderpriority AS bucket, o_orderkey, CAST(round(o_totalprice) AS BIGINT) AS bytes, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate, CAST(o_orderkey AS VARCHAR)) AS i FROM orders),
c AS (SELECT max(bytes) * 20 AS ceiling FROM o),
g AS (SELECT b.bucket, 0::BIGINT AS i, CAST(length(b.bucket) * 1000 AS BIGINT) AS used, NULL::BIGINT AS o_orderkey, false AS admitted FROM (SELECT DISTINCT bucket FROM o) b
  UNION ALL SELECT o.bucket, o.i, g.used + CASE WHEN g.used + o.bytes <= ceiling THEN o.bytes ELSE 0 END, o.o_orderkey, g.used + o.bytes <= ceiling FROM g JOIN o ON o.bucket = g.bucket AND o.i = g.i + 1, c)
SELECT o.bucket, CAST(o.o_orderkey AS VARCHAR) AS key, o.bytes, g.admitted FROM o JOIN g ON g.bucket = o.bucket AND g.i = o.i
""")
def budget_admission(spark, d):
    """A queue of objects per bucket admitted in order under a ceiling; what does not fit is refused and takes nothing."""
    o = table(spark, d, "orders")
    queue = o.select(F.col("o_orderpriority").alias("bucket"), F.col("o_orderkey").cast("string").alias("key"), F.round("o_totalprice").cast("long").alias("bytes"), F.unix_micros(F.col("o_orderdate").cast("timestamp")).alias("place"))
    used = o.select(F.col("o_orderpriority").alias("bucket")).distinct().withColumn("total_bytes", F.length("bucket").cast("long") * 1000)
    ceiling = queue.agg(F.max("bytes")).first()[0] * 20
    # blocks of a thousand, so that these tables have whole, refused and walked ones
    return admission.admit(queue, used, ceiling, _landing(spark, "admission"), rows=1000)


# ---------------------------------------------------------------- streams with state


_POLLS = [date(2024, 1, 5 * k) for k in range(1, 7)] + [date(2024, 2, 12), date(2024, 2, 25)]


def _late(key):
    """Days by which an event arrives late: most at once, some within the look-back, some beyond it."""
    return F.when(key % 10 == 0, 9).when(key % 10 == 1, 24).otherwise(0)


@query(f"""
WITH e AS (SELECT event_id, ts, CAST(ts AS DATE) + CASE event_id % 10 WHEN 0 THEN 9 WHEN 1 THEN 24 ELSE 0 END AS arrived FROM events),
p AS (SELECT CAST(unnest(['{"', '".join(map(str, _POLLS))}']) AS DATE) AS day),
s AS (SELECT event_id, ts, day, false AS raw FROM e JOIN p ON arrived <= day AND CAST(ts AS DATE) >= day - {dates.LOOK_BACK_DAYS} AND CAST(ts AS DATE) <= day
  UNION ALL SELECT event_id, ts, min(day), true FROM e JOIN p ON arrived <= day WHERE event_id % 10 = 1 GROUP BY event_id, ts),
m AS (SELECT day, max(max(ts)) OVER (ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING) - INTERVAL {dates.LOOK_BACK_DAYS} DAY AS mark FROM s GROUP BY day)
SELECT event_id, count(DISTINCT 1) AS n_seen FROM s JOIN m ON s.day = m.day WHERE mark IS NULL OR ts > mark GROUP BY event_id
""")
def stream_look_back(spark, d):
    """Polls of the last fourteen days as a stream: an event that several polls see comes out once, one that arrives later than the look-back is dropped."""
    folder, e = _landing(spark, "look-back"), table(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    arrived = F.date_add(F.to_date("ts"), _late(F.col("event_id")))
    for k, day in enumerate(_POLLS):
        today, before = F.lit(day).cast("date"), F.lit(_POLLS[k - 1] if k else date(1970, 1, 1)).cast("date")
        polled = e.filter((arrived <= today) & (F.to_date("ts") >= dates.look_back_start(today)) & (F.to_date("ts") <= today))
        raw = e.filter((F.col("event_id") % 10 == 1) & (arrived <= today) & (arrived > before))
        polled.unionByName(raw).distinct().coalesce(1).write.mode("append").parquet(f"{folder}/landing")
    stream = first_seen.read_events(spark, f"{folder}/landing", "event_id long, ts timestamp", files=1)
    first = first_seen.first_sights(stream, ["event_id"], "ts")
    keyed.run_available(first, "append", keyed.batch_files(f"{folder}/out"), f"{folder}/checkpoint")
    return spark.read.parquet(f"{folder}/out").groupBy("event_id").agg(F.count("*").alias("n_seen"))


def _in_parts(spark, rows: DataFrame, key: str, n: int, folder: str) -> DataFrame:
    """``rows`` with ``part``: the ntile of n in the order of ``key``, of ranges that are counted apart, as a window without partitions is one task."""
    rows.repartitionByRange(key).sortWithinPartitions(key).withColumn("_at", F.monotonically_increasing_id()).write.parquet(folder)
    stored = spark.read.parquet(folder).withColumn("_range", F.shiftright("_at", 33))
    counts = sorted((r["_range"], r["count"]) for r in stored.groupBy("_range").count().collect())
    before = [(r, sum(c for q, c in counts if q < r)) for r, _ in counts]
    size, more = divmod(sum(c for _, c in counts), n)
    place = F.col("_before") + F.col("_at").bitwiseAND((1 << 33) - 1)
    longer = more * (size + 1)
    part = F.when(place < longer, F.floor(place / (size + 1))).otherwise(more + F.floor((place - longer) / max(size, 1))) + 1
    return stored.join(F.broadcast(spark.createDataFrame(before, "_range long, _before long")), "_range").withColumn("part", part.cast("int")).drop("_range", "_at", "_before")


@query("""
WITH e AS (SELECT event_type AS bucket, event_id, CAST(round(value) AS BIGINT) AS bytes, ntile(6) OVER (ORDER BY event_id) AS part FROM events),
r AS (SELECT bucket, CAST(sum(bytes) + 1000 AS BIGINT) AS bytes, CAST(count(*) + 1 AS BIGINT) AS objects FROM e WHERE part <= 4 GROUP BY bucket)
SELECT r.bucket, CAST(r.bytes + sum(e.bytes) AS BIGINT) AS total_bytes, CAST(r.objects + count(*) AS BIGINT) AS object_count FROM r JOIN e ON e.bucket = r.bucket AND e.part > 4 GROUP BY r.bucket, r.bytes, r.objects
""")
def stream_totals(spark, d):
    """Bytes in use as a stream over six parts of the events: a run of three, a new start from its checkpoint, and a recount that overwrites the totals after four."""
    folder = _landing(spark, "totals")
    e = _in_parts(spark, table(spark, d, "events").select("event_id", "event_type", "value"), "event_id", 6, f"{folder}/ranged")
    adds = e.select("part", F.col("event_type").alias("bucket"), F.lit("add").alias("kind"), F.col("event_id").alias("seq"), F.round("value").cast("long").alias("bytes"), F.lit(1).cast("long").alias("objects"))
    recount = adds.filter("part <= 4").groupBy("bucket").agg((F.sum("bytes") + 1000).alias("bytes"), (F.count("*") + 1).alias("objects"), F.max("seq").alias("seq"))
    recount = recount.select(F.lit(4).alias("part"), "bucket", F.lit("set").alias("kind"), "seq", "bytes", "objects")
    landing = adds.unionByName(recount)
    landing.write.partitionBy("part").parquet(f"{folder}/parts")
    for first, last in ((1, 3), (4, 6)):
        for part in range(first, last + 1):
            spark.read.parquet(f"{folder}/parts/part={part}").coalesce(1).write.mode("append").parquet(f"{folder}/landing")
        stream = first_seen.read_events(spark, f"{folder}/landing", "bucket string, kind string, seq long, bytes long, objects long", files=1)
        keyed.run_available(keyed.running_totals(stream), "update", keyed.batch_files(f"{folder}/out"), f"{folder}/checkpoint")
    return keyed.latest_totals(spark.read.parquet(f"{folder}/out"))


@query("""
WITH e AS (SELECT user_id, epoch_us(ts) // 1000 AS ms FROM events), g AS (SELECT user_id, ms, lead(ms) OVER (PARTITION BY user_id ORDER BY ms) AS next FROM e), m AS (SELECT max(ms) - 3600000 AS mark FROM e)
SELECT user_id, make_timestamp(ms * 1000) AS last_at FROM g, m WHERE coalesce(next - ms > 86400000, ms + 86400000 < mark)
""")
def stream_silence(spark, d):
    """Each time a user says nothing for a day, from a stream in six parts; one who returns is heard again."""
    folder = _landing(spark, "silence")
    e = table(spark, d, "events").select(F.col("user_id").alias("key"), F.col("ts").cast("timestamp").alias("at"), F.floor(F.dayofmonth("ts") / 5).cast("int").alias("part"))
    e.write.partitionBy("part").parquet(f"{folder}/parts")  # so that the events are read once, by all tasks
    parts = spark.read.schema("key long, at timestamp, part int").parquet(f"{folder}/parts")
    for part in range(7):
        parts.filter(F.col("part") == part).drop("part").coalesce(1).write.mode("append").parquet(f"{folder}/landing")
    stream = first_seen.read_events(spark, f"{folder}/landing", "key long, at timestamp", files=1)
    keyed.run_available(keyed.silent_keys(stream), "append", keyed.batch_files(f"{folder}/out"), f"{folder}/checkpoint")
    return spark.read.schema("key long, last_at timestamp").parquet(f"{folder}/out").select(F.col("key").alias("user_id"), F.col("last_at").cast("timestamp_ntz").alias("last_at"))


# ---------------------------------------------------------------- tables in partitions


def _files_of(spark, folder: str, by: str) -> DataFrame:
    return spark.read.parquet(folder).select(by, F.col("_metadata.file_name").alias("file")).distinct()


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) FILTER (WHERE o_orderkey % 4 <> 0 OR year(o_orderdate) IN (1996, 1999)) AS n_filings, count(*) FILTER (WHERE o_orderkey % 4 <> 0) AS n_first, year(o_orderdate) NOT IN (1996, 1999) AS same_files FROM orders GROUP BY year(o_orderdate)
""")
def year_refilled(spark, d):
    """A backfill of all years, then of two again with late filings: known filings keep their stamp, and the files of other years stay."""
    folder = f"{_landing(spark, 'years')}/filings"
    o = table(spark, d, "orders").select(F.col("o_orderkey"), F.col("o_orderkey").cast("string").alias("filing_id"), F.lit("A filer").alias("filer_name"), F.lit("P").alias("filing_type"), F.to_date("o_orderdate").alias("filed_date"), F.year("o_orderdate").alias("year"))
    early = o.filter("o_orderkey % 4 <> 0").drop("o_orderkey")
    partitions.backfill_since(spark, folder, early.drop("year"), "house", date(1990, 1, 1), _lit_ts("2024-01-01 00:00:00"))
    before = _files_of(spark, folder, "year").groupBy("year").agg(F.sort_array(F.collect_list("file")).alias("b"))
    before.write.parquet(f"{folder}-before")
    known = spark.read.parquet(folder).select("filing_id", F.col("first_seen_at").alias("stamp"))
    known.write.parquet(f"{folder}-known")
    partitions.backfill_years(spark, folder, o.drop("o_orderkey"), "house", [1996, 1999], _lit_ts("2024-02-01 00:00:00"))
    after = _files_of(spark, folder, "year").groupBy("year").agg(F.sort_array(F.collect_list("file")).alias("a"))
    same = spark.read.parquet(f"{folder}-before").join(after, "year").select("year", (F.col("a") == F.col("b")).alias("same_files"))
    rows = spark.read.parquet(folder).join(spark.read.parquet(f"{folder}-known"), "filing_id", "left")
    counts = rows.groupBy("year").agg(F.count("*").alias("n_filings"), F.count_if(F.col("stamp") == F.col("first_seen_at")).alias("n_first"))
    return counts.join(same, "year").select("year", "n_filings", "n_first", "same_files")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS filing_id, CASE WHEN touched AND o_orderkey % 3 = 0 THEN 'NEW' WHEN o_orderkey % 3 = 0 AND lacking THEN NULL ELSE 'OLD' END AS source_transaction_id, CASE WHEN touched AND lacking THEN 'call' WHEN lacking THEN NULL ELSE 'put' END AS option_type, NOT touched AS same_file FROM
 (SELECT *, year(o_orderdate) IN (1996, 1999) AND o_orderkey % 3 = 0 AS lacking, year(o_orderdate) IN (1996, 1999) AS inside, year(o_orderdate) IN (1996, 1999) AS touched FROM orders) WHERE inside
UNION ALL SELECT CAST(o_orderkey AS VARCHAR), 'OLD', 'put', true FROM orders WHERE year(o_orderdate) NOT IN (1996, 1999)
""")
def partial_refill(spark, d):
    """Fields that trades lack filled from a new parse: only years with such trades are rewritten."""
    folder = f"{_landing(spark, 'refill')}/trades"
    lacks = F.year("o_orderdate").isin(1996, 1999) & (F.col("o_orderkey") % 3 == 0)
    trades = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("filing_id"), F.lit(0).alias("row_index"), F.when(~lacks, "OLD").alias("source_transaction_id"), F.lit("OP").alias("asset_type"), F.when(~lacks, "put").alias("option_type"),
        F.lit(1.0).alias("strike"), F.lit("2020-01-01").cast("date").alias("expiry"), F.year("o_orderdate").alias("year"),
    )
    partitions.rewrite(trades, folder, "year")
    files = lambda: spark.read.schema(trades.schema).parquet(folder).select("filing_id", F.col("_metadata.file_name").alias("file"))
    files().write.parquet(f"{folder}-before")
    parsed = trades.select("filing_id", "row_index", F.lit("NEW").alias("source_transaction_id"), F.lit("OP").alias("asset_type"), F.lit("call").alias("option_type"), F.lit(2.0).alias("strike"), F.lit("2021-01-01").cast("date").alias("expiry"))
    partitions.refill(spark, folder, trades.schema.simpleString()[7:-1].replace(":", " "), parsed, "year")
    before = spark.read.parquet(f"{folder}-before").withColumnRenamed("file", "old")
    same = files().join(before, "filing_id").select("filing_id", (F.col("file") == F.col("old")).alias("same_file"))
    return spark.read.schema(trades.schema).parquet(folder).join(same, "filing_id").select("filing_id", "source_transaction_id", "option_type", "same_file")


# ---------------------------------------------------------------- intervals


@query("""
WITH t AS (SELECT o_custkey, o_orderkey, CAST(o_orderdate AS DATE) AS b, CAST(o_orderdate AS DATE) + CAST(o_orderkey % 400 AS INTEGER) AS e FROM orders)
SELECT x.o_orderkey, y.o_orderkey AS other_o_orderkey FROM t x JOIN t y ON x.o_custkey = y.o_custkey AND x.o_orderkey < y.o_orderkey AND x.b <= y.e AND y.b <= x.e
""")
def overlapping_terms(spark, d):
    """Pairs of a customer's intervals that share a day, each once."""
    t = table(spark, d, "orders").select("o_custkey", "o_orderkey", F.to_date("o_orderdate").alias("start_date"), F.date_add(F.to_date("o_orderdate"), (F.col("o_orderkey") % 400).cast("int")).alias("end_date"))
    return linking.overlapping_terms(t, t, "o_custkey").filter("o_orderkey < other_o_orderkey").select("o_orderkey", "other_o_orderkey")



# ---------------------------------------------------------------- reports and backlogs


@query("""
WITH f AS (SELECT CAST(o_orderkey AS VARCHAR) AS filing_id, CAST(o_orderdate AS DATE) AS filed, o_orderkey % 3 AS k, o_orderkey % 5 = 0 AS scan, o_orderkey % 7 = 0 AS open FROM orders),
t AS (SELECT CAST(l_orderkey AS VARCHAR) AS filing_id, l_linenumber, l_quantity, CAST(l_shipdate AS DATE) AS traded, CASE WHEN l_linenumber % 2 = 1 THEN CAST(l_shipdate AS DATE) + 50 END AS told FROM lineitem),
a AS (SELECT count(*) AS n, count(*) FILTER (WHERE l_linenumber = 1) AS linked, count(*) FILTER (WHERE date_diff('day', traded, coalesce(told, filed)) > 45) AS late, count(*) FILTER (WHERE traded > DATE '2000-01-01') AS odd FROM t JOIN f ON t.filing_id = f.filing_id),
g AS (SELECT count(*) AS twins FROM (SELECT 1 FROM t GROUP BY filing_id, traded, l_quantity HAVING count(*) > 1)),
s AS (SELECT count(*) AS files, count(*) FILTER (WHERE k = 1) AS parsed, count(*) FILTER (WHERE k = 0) AS failed, count(*) FILTER (WHERE k = 2) AS pending, count(*) FILTER (WHERE scan) AS scans, count(*) FILTER (WHERE open) AS open FROM f)
SELECT unnest(range(1, 13)) AS place, unnest(['Daily data-quality report', '', 'Transactions: ' || n, '  house: parse success ' || format('{:.1f}', 100.0 * parsed / (parsed + failed)) || '% (' || parsed || '/' || (parsed + failed) || ', ' || pending || ' pending)',
 'Paper/scanned filings: ' || scans || '/' || files || ' (' || format('{:.1f}', 100.0 * scans / files) || '%)', 'Ticker-linked: ' || linked || '/' || n || ' (' || format('{:.1f}', 100.0 * linked / n) || '%)', 'Late filings (>45d): ' || late || '/' || n || ' (' || format('{:.1f}', 100.0 * late / n) || '%)',
 '', 'Duplicate transaction groups: ' || twins, 'Broken amendment links: 0', 'Implausible values: ' || odd, 'Open dq_issues: ' || open]) AS line FROM a, g, s
""")
def quality_report_text(spark, d):
    """The daily report over stored trades, a row per line; trades without a notification date are late by their filing's day."""
    state, o, line = State(spark, _landing(spark, "state")), table(spark, d, "orders"), table(spark, d, "lineitem")
    key = F.col("o_orderkey")
    state.append("filings", o.select(
        key.cast("string").alias("filing_id"), F.lit("house").alias("chamber"), F.lit("A filer").alias("filer_name"), F.lit("P").alias("filing_type"), F.to_date("o_orderdate").alias("filed_date"), _lit_ts("2024-01-01 00:00:00").alias("first_seen_at"), F.lit(300).alias("first_seen_precision_s"),
        F.when(key % 5 == 0, "scanned").otherwise("electronic").alias("format"), F.when(key % 3 == 0, "failed").when(key % 3 == 1, "parsed").otherwise("pending").alias("parse_status"), F.lit("official").alias("source"),
    ))
    traded = F.to_date("l_shipdate")
    state.append("transactions", line.select(
        F.monotonically_increasing_id().cast("string").alias("transaction_id"), F.col("l_orderkey").cast("string").alias("filing_id"), F.col("l_linenumber").alias("row_index"), F.lit("An asset").alias("asset_description_raw"), F.when(F.col("l_linenumber") == 1, "T").alias("ticker"), F.lit("purchase").alias("tx_type"),
        traded.alias("tx_date"), F.when(F.col("l_linenumber") % 2 == 1, F.date_add(traded, 50)).alias("notification_date"), F.col("l_quantity").cast("double").alias("amount_min"), F.lit(True).alias("is_current"),
    ))
    state.append("dq_issues", o.filter(key % 7 == 0).select(key.cast("string").alias("filing_id"), key.cast("string").alias("issue_id"), F.lit("any").alias("issue_type"), _lit_ts("2024-01-01 00:00:00").alias("created_at")))
    text = jobs.quality_report(state, F.lit("2000-01-01").cast("date"))
    return spark.createDataFrame(list(enumerate(text.split("\n"), 1)), "place long, line string")


@query("SELECT 'house:' || o_orderkey AS filing_id, CASE WHEN o_orderkey % 6 <> 0 THEN 'k/house:' || o_orderkey END AS raw_object_key, CASE WHEN o_orderkey % 6 = 0 THEN 'no answer' END AS details FROM orders")
def backlog_drained(spark, d):
    """The archive queue taken in quarters until only reports that cannot be fetched are left; each of these has one issue."""
    state, o = State(spark, _landing(spark, "state")), table(spark, d, "orders")
    state.append("filings", o.select(
        F.concat(F.lit("house:"), F.col("o_orderkey").cast("string")).alias("filing_id"), F.lit("house").alias("chamber"), F.lit("A filer").alias("filer_name"), F.col("o_orderstatus").alias("filing_type"), _lit_ts("2024-01-01 00:00:00").alias("first_seen_at"), F.lit(300).alias("first_seen_precision_s"),
        F.lit("unknown").alias("format"), F.lit("pending").alias("parse_status"), F.lit("official").alias("source"),
    ))
    batch = o.count() // 4 + 1
    number = F.substring_index("filing_id", ":", -1).cast("long")

    def step() -> None:
        queue = jobs.pending_reports(state, batch)
        fetched = queue.select("filing_id", F.concat(F.lit("k/"), "filing_id").alias("key"), F.lit(1).cast("long").alias("bytes"), F.sha2("filing_id", 256).alias("sha256"), F.when(number % 6 == 0, "no answer").alias("error"), number.alias("place"))
        jobs.archive_batch(state, fetched, "raw", 1 << 40, _lit_ts("2024-02-01 00:00:00"))

    ingest.drain(lambda: state.read("filings").filter("raw_object_key is null").count(), step)
    return state.read("filings").select("filing_id", "raw_object_key").join(state.read("dq_issues").select("filing_id", "details"), "filing_id", "left")


@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def table_dumped(spark, d):
    """A dated, compressed copy of a table as JSON lines, made twice and read back."""
    rows, folder = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), _landing(spark, "dumps")
    for _ in range(2):
        path = objects.dump(rows, folder, "2024-02-01")
    return spark.read.schema(rows.schema).json(path)
