"""Amendments, content keys and coverage between sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def amended_ids(rows: DataFrame, id_col: str, filing_col: str) -> DataFrame:
    """Ids that more than one filing has."""
    return rows.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(F.count_distinct(filing_col).alias("n_filings")).filter("n_filings > 1")


def resolve_currency(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``is_current`` on the newest row of each group alone; ``oldest`` holds the oldest row's last order column."""
    w = Window.partitionBy(*group)
    newest = F.row_number().over(w.orderBy(*(F.col(c).desc_nulls_last() for c in order)))
    oldest = F.first(order[-1]).over(w.orderBy(*(F.col(c).asc_nulls_first() for c in order)))
    return rows.withColumns({"is_current": newest == 1, "oldest": oldest})


def amendment_marks(filings: DataFrame, rows: DataFrame) -> DataFrame:
    """(filing_id, row_index, is_current, _current, _oldest, _heir) of the rows of filings whose id more than one filing has.

    ``_current`` tells the newest filing's row, ``_oldest`` is the oldest filing, and ``_heir`` that the newest one is another and has no predecessor
    yet. Rows move twice, without the columns that no rule asks for: to their filing's dates and to their id.
    """
    dates = filings.select("filing_id", F.coalesce("filed_date", F.to_date(F.lit("0001-01-01"))).alias("_filed"), F.col("first_seen_at").alias("_seen"), F.col("supersedes_filing_id").isNull().alias("_free"))
    named = rows.filter(F.col("source_transaction_id").isNotNull()).select("filing_id", "row_index", "source_transaction_id", "is_current")
    placed = named.join(dates, "filing_id", "left").withColumn("_place", F.when(F.col("_free").isNotNull(), F.struct("_filed", "_seen", "filing_id", "row_index")))
    placed = placed.select("source_transaction_id", "is_current", "_free", "_place", F.col("filing_id").alias("_filing"))
    w = Window.partitionBy("source_transaction_id")
    marks = placed.withColumns({
        "_current": F.row_number().over(w.orderBy(F.col("_place").desc_nulls_last())) == 1,
        "_oldest": F.min("_place").over(w)["filing_id"],
        "_amended": F.min("_filing").over(w) != F.max("_filing").over(w),
    }).filter("_amended and _place is not null")
    heir = F.col("_free") & F.col("_current") & (F.col("_filing") != F.col("_oldest"))
    return marks.select("_place.filing_id", "_place.row_index", "is_current", "_current", "_oldest", heir.alias("_heir"))


def with_currency(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """``rows`` with ``is_current`` as ``marks`` (filing_id, row_index, _current) have it; others keep theirs."""
    changed = rows.join(marks.select("filing_id", "row_index", "_current"), ["filing_id", "row_index"], "left")
    return changed.withColumn("is_current", F.coalesce("_current", "is_current")).select(*rows.columns)


def with_heirs(filings: DataFrame, marks: DataFrame) -> DataFrame:
    """``filings`` with the predecessor of those that ``marks`` (filing_id, _oldest, _heir) tell as heirs."""
    heirs = marks.filter("_heir").groupBy("filing_id").agg(F.min("_oldest").alias("_oldest"))
    return filings.join(heirs, "filing_id", "left").withColumn("supersedes_filing_id", F.coalesce("supersedes_filing_id", "_oldest")).select(*filings.columns)


def link_amendments(filings: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with is_current, filings with supersedes_filing_id) after amendments are followed.

    Of an id in several filings only the newest filing's row stays current. The newest filing
    supersedes the oldest, unless it has a predecessor already.
    """
    marks = amendment_marks(filings, rows)
    return with_currency(rows, marks), with_heirs(filings, marks)


def content_key(*parts: Column) -> Column:
    """The hash of the parts' texts with bars between; nulls count as empty."""
    return F.sha2(F.concat_ws("|", *(F.coalesce(p.cast("string"), F.lit("")) for p in parts)), 256)


def float_text(x: Column) -> Column:
    """The shortest text that reads back as the same double: "1001.0", "1001.21", "12345678.5", "1e+16"."""
    x = x.cast("double")
    short = x.cast("string")
    digits = F.regexp_replace(short.try_cast("decimal(38,20)").cast("string"), "0+$", "")
    plain = F.when(F.endswith(digits, F.lit(".")), F.concat(digits, F.lit("0"))).otherwise(digits)
    power = F.split_part(short, F.lit("E"), F.lit(2))
    signed = F.concat(F.when(F.startswith(power, F.lit("-")), "-").otherwise("+"), F.lpad(F.replace(power, F.lit("-"), F.lit("")), 2, "0"))
    scientific = F.concat(F.regexp_replace(F.split_part(short, F.lit("E"), F.lit(1)), r"\.0$", ""), F.lit("e"), signed)
    return F.when(~F.contains(short, F.lit("E")), short).when((F.abs(x) >= 1e-4) & (F.abs(x) < 1e16), plain).otherwise(scientific)


def coverage(external: DataFrame, known: DataFrame, external_id: str, known_id: str) -> DataFrame:
    """External rows with ``matched_id``: the known id they meet, or null."""
    ids = known.select(F.col(known_id).alias("matched_id")).distinct()
    return external.join(ids, external[external_id] == ids["matched_id"], "left")


def survivorship(matched: DataFrame, source: str, external_id: str) -> DataFrame:
    """Per source, how many different external ids are matched, and how many are not."""
    distinct = matched.filter(F.col(external_id).isNotNull()).select(source, external_id, "matched_id").distinct()
    counts = distinct.groupBy(source).agg(F.count_if(F.col("matched_id").isNotNull()).alias("matched"), F.count_if(F.col("matched_id").isNull()).alias("unmatched"))
    return counts.withColumn("match_rate", F.try_divide(F.col("matched").cast("double"), F.col("matched") + F.col("unmatched")))


def rematch(rows: DataFrame, known: DataFrame, external_id: str, known_id: str) -> DataFrame:
    """Unmatched rows that are known by now get their match; ``newly`` tells which."""
    ids = known.select(F.col(known_id).alias("_now")).distinct()
    joined = rows.join(ids, rows[external_id] == ids["_now"], "left")
    newly = F.col("matched_id").isNull() & F.col("_now").isNotNull()
    return joined.withColumns({"newly": newly, "matched_id": F.coalesce("matched_id", "_now")}).select(*rows.columns, "newly")


def import_by_content(stored: DataFrame, incoming: DataFrame, keys: list[str], *order: Column | str) -> DataFrame:
    """Incoming rows whose keys are neither stored nor earlier in the batch."""
    from .ingest import first_per_key

    return first_per_key(incoming.join(stored.select(*keys).distinct(), keys, "left_anti"), keys, *order)


def import_covered(stored: DataFrame, incoming: DataFrame, known: DataFrame, source: str, key: Column, external_id: str, known_id: str) -> DataFrame:
    """``import_by_content`` with the ``coverage`` of its rows, by one shuffle: rows, stored keys and known ids meet by the external id.

    ``stored`` has the source, the external id and the hash (``_key``, bytes) of its rows. ``key``, a hash of columns of ``incoming``, the external id among them,
    is taken after the shuffle, as hashes do not compress; rows without an external id are dealt out by theirs.
    """
    near = F.coalesce(F.col(external_id), F.hex("_key")).alias("_near")
    rows = incoming.select("*", F.coalesce(F.col(external_id), F.hex(key)).alias("_near"), F.lit(2).alias("_kind"))
    old = stored.select(near, source, "_key", F.lit(1).alias("_kind"))
    ids = known.select(F.col(known_id).alias("_near"), F.col(known_id).alias("_id"), F.lit(0).alias("_kind"))
    met = rows.unionByName(old, allowMissingColumns=True).unionByName(ids, allowMissingColumns=True).repartition("_near")
    met = met.withColumn("_key", F.coalesce("_key", F.when(F.col("_kind") == 2, key)))
    first = F.row_number().over(Window.partitionBy("_near", source, "_key").orderBy("_kind"))
    met = met.withColumn("_first", first).filter("_kind = 0 or _kind = 2 and _first = 1")
    met = met.withColumn("_id", F.max("_id").over(Window.partitionBy("_near"))).filter("_kind = 2")
    # an id that only stands for a missing one meets nothing
    return met.withColumn("matched_id", F.when(F.col(external_id).isNotNull(), F.col("_id"))).drop("_near", "_kind", "_first", "_id")
