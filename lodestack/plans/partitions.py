"""Tables in partitions that jobs rewrite one by one.

A job writes whole partitions, and only those that it changes: dynamic overwrite stages their files and
puts them in place when the job commits. Files of other partitions keep their names, so jobs on different years may run
at the same time, and a job that failed or ran twice is run again for its own partitions alone.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..operators import ingest


def rewrite(rows: DataFrame, folder: str, *by: str) -> None:
    """Put ``rows`` in the place of their partitions; others stay."""
    rows.repartition(*by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(folder)


def stored(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """The table at ``folder``, empty before its first write."""
    try:
        return spark.read.schema(schema).parquet(folder)
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], schema)


FILINGS = "filing_id string, filer_name string, filing_type string, filed_date date, first_seen_at timestamp, first_seen_precision_s int, chamber string, year int"


def backfill_years(spark: SparkSession, folder: str, index: DataFrame, chamber: str, years: list[int], now: Column) -> None:
    """Add the filings of ``index`` (filing_id, filer_name, filing_type, filed_date, year) that are not stored yet, for the given index years.

    Known filings keep their row and its stamp. Only the partitions of these years are read and written.
    """
    mine = stored(spark, folder, FILINGS).filter((F.col("chamber") == chamber) & F.col("year").isin(years))
    fresh = ingest.new_keys(index.filter(F.col("year").isin(years)), mine, "filing_id", "filed_date", "filer_name")
    seen = dates.first_seen(F.col("filed_date"), now, F.lit(False))
    rows = fresh.select("filing_id", "filer_name", "filing_type", "filed_date", seen["first_seen_at"].alias("first_seen_at"), seen["precision_s"].alias("first_seen_precision_s"), F.lit(chamber).alias("chamber"), F.col("year").cast("int").alias("year"))
    rewrite(mine.select(*rows.columns).unionByName(rows), folder, "chamber", "year")


def backfill_since(spark: SparkSession, folder: str, results: DataFrame, chamber: str, start: date, now: Column) -> None:
    """As ``backfill_years``, for results (filing_id, filer_name, filing_type, filed_date) filed on or after a day; those without a date belong to year 0."""
    dated = results.filter(F.col("filed_date").isNull() | (F.col("filed_date") >= F.lit(start))).withColumn("year", F.coalesce(F.year("filed_date"), F.lit(0)))
    years = sorted(r.year for r in dated.select("year").distinct().collect())
    if years:
        backfill_years(spark, folder, dated, chamber, years, now)


def needs_refill() -> Column:
    """Whether a stored trade lacks a field that a later parser fills."""
    return F.col("source_transaction_id").isNull() | ((F.col("asset_type") == "OP") & F.col("option_type").isNull()) | F.col("asset_type").isNull()


def affected(trades: DataFrame, by: str, key: str = "filing_id") -> DataFrame:
    """(by, key) of the filings with a trade to refill: the test reaches the scan of the files."""
    return trades.filter(needs_refill()).select(by, key).distinct()


def refill(spark: SparkSession, folder: str, schema: str, parsed: DataFrame, by: str) -> list:
    """Fill fields of stored trades from a new parse (filing_id, row_index, fields), in the partitions that need it; returns these.

    A field is filled where it is null. An option's fields come together, for rows whose asset type is an option's after that.
    Rows that lack nothing, and rows without a counterpart in the parse, stay as they are.
    """
    trades = stored(spark, folder, schema)
    todo = affected(trades, by)
    parts = sorted(r[0] for r in todo.select(by).distinct().collect())  # a row per partition
    if not parts:
        return []
    mine = trades.filter(F.col(by).isin(parts))
    wanted = parsed.join(todo.select("filing_id").distinct(), "filing_id", "left_semi")
    names = {c: f"_{c}" for c in ("source_transaction_id", "asset_type", "option_type", "strike", "expiry")}
    new = wanted.select("filing_id", "row_index", *(F.col(c).alias(n) for c, n in names.items()), F.lit(True).alias("_found")).dropDuplicates(["filing_id", "row_index"])
    rows = mine.join(new, ["filing_id", "row_index"], "left").withColumn("_open", F.col("_found").isNotNull() & needs_refill())
    kind = F.coalesce("asset_type", F.when(F.col("_open"), F.col("_asset_type")))
    option = F.col("_open") & (kind == "OP") & F.col("option_type").isNull() & F.col("_option_type").isNotNull()
    value = {c: F.coalesce(c, F.when(F.col("_open"), F.col(names[c]))) for c in ("source_transaction_id", "asset_type")}
    value |= {c: F.when(option, F.col(names[c])).otherwise(F.col(c)) for c in ("option_type", "strike", "expiry")}
    rewrite(rows.select(*(value[c].alias(c) if c in value else F.col(c) for c in mine.columns)), folder, by)
    return parts
