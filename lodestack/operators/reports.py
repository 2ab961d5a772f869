"""Rendered lines, storage budgets, silence and copy plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from ..functions.money import amount_text
from ..functions.text import code_name

# How trades are called, and how much of a list is shown.
TRADE_LABELS = {"purchase": "BUY", "sale_full": "SELL", "sale_partial": "SELL (partial)", "exchange": "EXCHANGE"}
SHOWN_LINES, SHOWN_COMMITTEES = 15, 3
#: Bytes that a store may hold, and the share at which to warn.
BUDGET_BYTES, WARN_SHARE = 9 * 1024**3, 0.8


def trade_line(tx_type: Column, ticker: Column, description: Column, low: Column, high: Column, owner: Column) -> Column:
    """ "BUY AAPL $1,001-$15,000 [self]"; parts that are missing are left out."""
    amount = amount_text(low, high)
    label = F.coalesce(code_name(tx_type, TRADE_LABELS), tx_type)
    return F.concat_ws(" ", label, F.coalesce(ticker, description), F.nullif(amount, F.lit("")), F.when(F.coalesce(owner, F.lit("")) != "", F.concat(F.lit("["), owner, F.lit("]"))))


def filer_line(filer: Column, full_name: Column, party: Column, state: Column, committees: Column) -> Column:
    """ "Jane Doe (D-CA) [A, B, C, +2 more]" for a linked person, else the filer's own name."""
    place = F.concat_ws("-", F.nullif(party, F.lit("")), F.nullif(state, F.lit("")))
    who = F.when(place == "", full_name).otherwise(F.concat(full_name, F.lit(" ("), place, F.lit(")")))
    shown = first_and_more(committees, SHOWN_COMMITTEES)
    return F.when(full_name.isNull(), filer).when(F.coalesce(F.size(committees), F.lit(0)) > 0, F.concat(who, F.lit(" ["), shown, F.lit("]"))).otherwise(who)


def first_and_more(items: Column, n: int) -> Column:
    """The first ``n`` items, and how many more there are."""
    more = F.concat(F.lit("+"), (F.size(items) - n).cast("string"), F.lit(" more"))
    return F.array_join(F.when(F.size(items) > n, F.concat(F.slice(items, 1, n), F.array(more))).otherwise(items), ", ")


def member_lists(members: DataFrame, groups: DataFrame, member: str, group: str, label: Column) -> DataFrame:
    """Per member the sorted labels of its groups."""
    return members.join(groups, group).groupBy(member).agg(F.array_sort(F.collect_list(label)).alias("labels"))


def cap_and_remainder(rows: DataFrame, by: str, n: int | None, *order: Column | str) -> DataFrame:
    """The first ``n`` rows of each group, each with the number of rows left out of its group; all rows with None."""
    w = Window.partitionBy(by)
    if n is None:
        return rows.withColumns({"rank": F.row_number().over(w.orderBy(*order)), "remainder": F.lit(0).cast("long")})
    ranked = rows.withColumns({"rank": F.row_number().over(w.orderBy(*order)), "remainder": F.greatest(F.count("*").over(w) - n, F.lit(0))})
    return ranked.filter(F.col("rank") <= n)


# The titles of the daily report's lines, with the metrics that they show.
REPORT_TITLE = "Daily data-quality report"
SHARE_TITLES = (("Paper/scanned filings", "scanned_or_paper_filings", "classified_filings"), ("Ticker-linked", "ticker_linked", "total_transactions"), ("Late filings (>45d)", "late_filings", "late_filing_eligible"))
COUNT_TITLES = (("Duplicate transaction groups", "duplicate_groups"), ("Broken amendment links", "broken_amendment_groups"), ("Implausible values", "implausible_values"), ("Open dq_issues", "open_dq_issues"))


def quality_report(metrics: Row, chambers: list[Row]) -> str:
    """The daily report of one row of metrics and a row per chamber; lines with nothing to divide by are left out."""
    m = metrics.asDict()

    def share(a: str, b: str) -> str:
        return f"{m[a]}/{m[b]} ({m[a] / m[b]:.1%})"

    lines = [REPORT_TITLE, "", f"Transactions: {m['total_transactions']}"]
    for c in chambers:
        done = c["parsed"] + c["failed"]
        rate = f"{c['parsed'] / done:.1%}" if done else "n/a"
        lines.append(f"  {c['chamber']}: parse success {rate} ({c['parsed']}/{done}, {c['pending']} pending)")
    for title, a, b in SHARE_TITLES:
        if m[b]:
            lines.append(f"{title}: {share(a, b)}")
    lines += ["", *(f"{title}: {m[k]}" for title, k in COUNT_TITLES)]
    return "\n".join(lines)


def storage_budget(objects: DataFrame, bucket: str, size: str, ceiling: int = BUDGET_BYTES) -> DataFrame:
    """Per bucket its bytes and objects, the share of the ceiling, and whether to warn or stop."""
    use = objects.groupBy(bucket).agg(F.sum(size).alias("total_bytes"), F.count("*").alias("object_count"))
    share = F.col("total_bytes") / F.lit(ceiling)
    return use.withColumns({"fraction": share, "warn": share >= WARN_SHARE, "exceeded": F.col("total_bytes") > ceiling})


def copy_plan(source: DataFrame, target: DataFrame, key: str, digest: str) -> DataFrame:
    """Objects to copy: those whose key is missing at the target, or there with another digest."""
    there = target.select(key, F.col(digest).alias("_there"))
    plan = source.join(there, key, "left")
    action = F.when(F.col("_there").isNull(), "copy").when(F.col("_there") != F.col(digest), "replace")
    return plan.withColumn("action", action).filter(F.col("action").isNotNull()).drop("_there")


def missing_objects(source: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """Objects to derive anew: those whose key is missing, whatever the content."""
    return source.join(target.select(key).distinct(), key, "left_anti")
