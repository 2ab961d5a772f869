"""Data-quality metrics, plausibility and checks of extractions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import LATE_AFTER_DAYS

# Limits beyond which an extraction is looked at by a person.
REVIEW_ROWS, REVIEW_REPEATS, DENSITY_PAGES, DENSITY_ROWS = 20, 3, 4, 4.0


def implausible_flags(low: Column, high: Column, traded: Column, notified: Column, strike: Column, as_of: Column) -> dict[str, Column]:
    """The five signs of an implausible row; a comparison with null is no sign."""
    flag = lambda c: F.coalesce(c, F.lit(False))
    return {
        "range_inverted": flag(low > high),
        "negative_amount": flag(low < 0) | flag(high < 0),
        "notified_before_traded": flag(notified < traded),
        "traded_in_future": flag(traded > as_of),
        "strike_not_positive": flag(strike <= 0),
    }


def implausible(*args: Column) -> Column:
    flags = list(implausible_flags(*args).values())
    out = flags[0]
    for f in flags[1:]:
        out = out | f
    return out


def duplicate_groups(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Groups of more than one row with equal keys; nulls are equal."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def broken_groups(rows: DataFrame, keys: list[str], current: str) -> DataFrame:
    """Groups without exactly one current row."""
    return rows.groupBy(*keys).agg(F.sum(F.when(F.col(current), 1).otherwise(0)).alias("n_current")).filter("n_current <> 1")


def status_table(rows: DataFrame, by: str, status: str, values: list[str]) -> DataFrame:
    """Counts per status as columns, zero where there are none, and the share of the first among the first two."""
    done, failed = values[0], values[1]
    wide = rows.groupBy(by).pivot(status, values).agg(F.count(F.lit(1))).na.fill(0)
    return wide.withColumn("success_rate", F.try_divide(F.col(done).cast("double"), F.col(done) + F.col(failed)))


def late_share(rows: DataFrame, by: list[str], later: Column, earlier: Column) -> DataFrame:
    """Per group, rows with both dates, those late, and their share."""
    days = F.datediff(later, earlier)
    out = rows.groupBy(*by).agg(F.count_if(days > LATE_AFTER_DAYS).alias("n_late"), F.count_if(days.isNotNull()).alias("n_eligible"))
    return out.withColumn("late_share", F.try_divide(F.col("n_late").cast("double"), "n_eligible"))


def metrics(transactions: DataFrame, filings: DataFrame, issues: DataFrame, as_of: Column) -> DataFrame:
    """One row with all metrics of the data set: one pass over the joined rows, one each for groups, statuses and issues."""
    t = transactions.join(filings.select("filing_id", "filed_date"), "filing_id")
    late = F.datediff(F.coalesce("notification_date", "filed_date"), "tx_date")
    odd = implausible(*(F.col(c) for c in ("amount_min", "amount_max", "tx_date", "notification_date", "strike")), as_of)
    totals = t.agg(
        F.count("*").alias("total_transactions"),
        F.count_if(F.col("ticker").isNotNull()).alias("ticker_linked"),
        F.count_if(late > LATE_AFTER_DAYS).alias("late_filings"),
        F.count_if(late.isNotNull()).alias("late_filing_eligible"),
        F.count_if(odd).alias("implausible_values"),
    )
    twins = duplicate_groups(transactions, ["filing_id", "owner", "asset_description_raw", "tx_type", "tx_date", "amount_min", "amount_max"]).agg(F.count("*").alias("duplicate_groups"))
    versions = transactions.filter(F.col("source_transaction_id").isNotNull())
    broken = broken_groups(versions, ["source_transaction_id"], "is_current").agg(F.count("*").alias("broken_amendment_groups"))
    kinds = filings.agg(F.count_if(F.col("format").isin("paper", "scanned")).alias("scanned_or_paper_filings"), F.count_if(F.col("format") != "unknown").alias("classified_filings"))
    opened = issues.agg(F.count_if(F.col("resolved_at").isNull()).alias("open_dq_issues"))
    out = totals
    for one in (twins, broken, kinds, opened):
        # single rows on both sides
        out = out.join(F.broadcast(one), F.lit(True))
    return out


def extraction_check(rows: DataFrame, filing: str, description: str, same: list[str], reported: Column | None = None, pages: Column | None = None) -> DataFrame:
    """Per filing: n_rows, n_blank, most_repeated, ok, needs_review and the reasons.

    Only a blank description makes an extraction wrong. ``reported`` and ``pages`` are
    constants of a filing, given as columns of ``rows``.
    """
    blank = F.coalesce(F.trim(description) == "", F.lit(True))
    groups = rows.withColumns({"_blank": blank.cast("long"), "_reported": reported if reported is not None else F.lit(None).cast("long"), "_pages": pages if pages is not None else F.lit(None).cast("long")})
    groups = groups.groupBy(filing, *same).agg(F.count("*").alias("_n"), F.sum("_blank").alias("_b"), F.max("_reported").alias("_reported"), F.max("_pages").alias("_pages"))
    per = groups.groupBy(filing).agg(F.sum("_n").alias("n_rows"), F.sum("_b").alias("n_blank"), F.max("_n").alias("most_repeated"), F.max("_reported").alias("_reported"), F.max("_pages").alias("_pages"))
    reasons = F.array_compact(
        F.array(
            F.when(F.col("n_blank") > 0, "blank description"),
            F.when(F.col("n_rows") > REVIEW_ROWS, "many rows"),
            F.when(F.col("most_repeated") >= REVIEW_REPEATS, "repeated row"),
            F.when(F.col("_reported") != F.col("n_rows"), "row count differs"),
            F.when((F.col("_pages") >= DENSITY_PAGES) & (F.col("n_rows") / F.col("_pages") < DENSITY_ROWS), "few rows per page"),
        )
    )
    return per.select(filing, "n_rows", "n_blank", "most_repeated", (F.col("n_blank") == 0).alias("ok"), (F.size(reasons) > 0).alias("needs_review"), F.array_join(reasons, "; ").alias("reasons"))
