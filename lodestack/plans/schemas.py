"""The tables of the engine's own state, as Spark DDL, and their rules as queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = {
    "politicians": "bioguide_id string not null, full_name string not null, chamber string not null, party string, state string, district string, created_at timestamp, updated_at timestamp",
    "politician_terms": "term_id string not null, bioguide_id string not null, chamber string not null, state string, district string, party string, start_date date not null, end_date date, created_at timestamp",
    "politician_overrides": "override_id string not null, chamber string not null, filer_name string not null, bioguide_id string not null, reason string",
    "committees": "thomas_id string not null, chamber string not null, name string not null, created_at timestamp, updated_at timestamp",
    "committee_memberships": "membership_id string not null, thomas_id string not null, bioguide_id string not null, party string, rank int, title string",
    "instruments": "instrument_id string not null, primary_ticker string, cik string, name string, asset_class string, sic string, sic_description string, sic_synced_at timestamp",
    "ticker_map": "ticker_map_id string not null, instrument_id string not null, ticker string not null, valid_from date not null, valid_to date, source string not null",
    "filings": "filing_id string not null, chamber string not null, filer_name string not null, bioguide_id string, filing_type string not null, filed_date date, first_seen_at timestamp not null, first_seen_precision_s int not null, format string not null, parse_status string not null, source string not null, raw_object_key string, raw_sha256 string, supersedes_filing_id string, created_at timestamp",
    "transactions": "transaction_id string not null, filing_id string not null, row_index int not null, owner string, asset_description_raw string not null, asset_type string, ticker string, cik string, instrument_id string, option_type string, strike double, expiry date, underlying_ticker string, tx_type string not null, tx_date date, notification_date date, amount_min double, amount_max double, filing_delay_days int, is_current boolean not null, source_transaction_id string",
    "holdings": "holding_id string not null, filing_id string not null, row_index int not null, report_year int, owner string, asset_description_raw string not null, ticker string, asset_type string, value_raw string, value_min double, value_max double, income_type string, income_raw string",
    "transaction_provenance": "transaction_id string not null, method string not null, confidence string, review string, note string, source_file string",
    "scrape_runs": "run_id string not null, chamber string not null, scheduled_at timestamp, started_at timestamp not null, finished_at timestamp, status string not null, new_filings_count int not null, error_message string",
    "dq_issues": "issue_id string not null, filing_id string, transaction_id string, issue_type string not null, details string, created_at timestamp not null, resolved_at timestamp",
    "community_transactions": "community_transaction_id string not null, source string not null, chamber string not null, dedup_key string not null, external_filing_id string, matched_filing_id string, filer_name string, ticker string, asset_description string, asset_type string, tx_type string, owner string, tx_date date, disclosure_date date, amount_min double, amount_max double",
    "storage_usage": "bucket string not null, total_bytes bigint not null, object_count int not null, updated_at timestamp not null",
}

UNIQUE = {
    "transactions": ["filing_id", "row_index"],
    "holdings": ["filing_id", "row_index"],
    "community_transactions": ["source", "dedup_key"],
    "politician_overrides": ["chamber", "filer_name"],
}
PARENTS = {
    "politician_terms": {"bioguide_id": "politicians"},
    "politician_overrides": {"bioguide_id": "politicians"},
    "committee_memberships": {"thomas_id": "committees", "bioguide_id": "politicians"},
    "transactions": {"filing_id": "filings"},
    "holdings": {"filing_id": "filings"},
    "transaction_provenance": {"transaction_id": "transactions"},
}
ALLOWED = {
    ("politicians", "chamber"): ["house", "senate"],
    ("filings", "format"): ["electronic", "paper", "scanned", "unknown"],
    ("filings", "parse_status"): ["pending", "parsed", "paper_deferred", "failed"],
    ("transactions", "owner"): ["self", "spouse", "joint", "child"],
    ("transactions", "option_type"): ["call", "put"],
    ("transactions", "tx_type"): ["purchase", "sale_full", "sale_partial", "exchange"],
    ("scrape_runs", "status"): ["running", "success", "failed"],
}


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])


def violations(tables: dict[str, DataFrame]) -> DataFrame | None:
    """(table, rule, n) of every broken rule among the given tables; None if there is no rule to check."""
    found: list[DataFrame] = []

    def add(table: str, rule: str, bad: DataFrame) -> None:
        found.append(bad.agg(F.count("*").alias("n")).filter("n > 0").select(F.lit(table).alias("table"), F.lit(rule).alias("rule"), "n"))

    for (table, column), values in ALLOWED.items():
        if table in tables:
            add(table, f"{column} is known", tables[table].filter(F.col(column).isNotNull() & ~F.col(column).isin(values)))
    for table, keys in UNIQUE.items():
        if table in tables:
            add(table, f"{', '.join(keys)} are unique", tables[table].groupBy(*keys).agg(F.count("*").alias("k")).filter("k > 1"))
    for table, parents in PARENTS.items():
        for key, parent in parents.items():
            if table in tables and parent in tables:
                add(table, f"{key} is in {parent}", tables[table].filter(F.col(key).isNotNull()).join(tables[parent].select(key), key, "left_anti"))
    out = None
    for one in found:
        out = one if out is None else out.unionByName(one)
    return out
