"""Readers of landed files: indexes, search pages, people, companies, community feeds and tables.

Every reader has an explicit schema. Files are read by Spark; the few formats without a Spark
reader (YAML, ZIP, HTML tables) are parsed a file at a time inside tasks.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import form_date, iso_date, strict_form_date, unread_date
from ..functions.money import amount_range, band_range
from ..functions.text import (
    OWNER_NAMES, TERM_CHAMBERS, TRADE_NAMES, bare, before_option_details, clean_text, code_name, dash_to_null, filer_name, option_cell, report_uuid, ticker_in_name, zero_padded,
)
from .entries import keyed_entries, list_entries, parsed_entries
from .html_tables import table_cells

MEMBER = "Prefix string, Last string, First string, Suffix string, FilingType string, StateDst string, Year string, FilingDate string, DocID string"
#: Terms that ended before this day are left out.
FIRST_TERM_END = "2011-01-01"


# --- indexes and search pages


def unzip_indexes(spark: SparkSession, archives: str, folder: str) -> str:
    """Write the first XML file of each archive below ``folder``, which all executors share; returns ``folder``."""

    def texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for content in batch["content"]:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    name = next((n for n in z.namelist() if n.lower().endswith(".xml")), None)
                    if name:
                        # one line per file, for the text writer
                        out.append(" ".join(z.read(name).decode("utf-8-sig").split()))
            yield pd.DataFrame({"value": out}, dtype=object)

    spark.read.format("binaryFile").load(archives).select("content").mapInPandas(texts, "value string").write.mode("overwrite").text(folder)
    return folder


def filing_index(spark: SparkSession, path: str) -> DataFrame:
    """Filings of XML indexes: one row per member element with a document id."""
    rows = spark.read.format("xml").option("rowTag", "Member").schema(MEMBER).load(path)
    return index_rows(rows)


def index_rows(rows: DataFrame) -> DataFrame:
    t = {c: bare(F.coalesce(c, F.lit(""))) for c in ("Prefix", "Last", "First", "Suffix", "FilingType", "StateDst", "Year", "FilingDate", "DocID")}
    return rows.select(
        F.concat(F.lit("house:"), t["DocID"]).alias("filing_id"), t["DocID"].alias("doc_id"), filer_name(t["Prefix"], t["First"], t["Last"], t["Suffix"]).alias("filer_name"),
        t["FilingType"].alias("filing_type"), t["StateDst"].alias("state_district"), F.coalesce(t["Year"].try_cast("int"), F.lit(0)).alias("year"), strict_form_date(t["FilingDate"]).alias("filed_date"),
    ).filter("doc_id <> ''")


def document_path(filing_type: Column, year: Column, doc_id: Column) -> Column:
    """Where a document lies below the site's root: trade reports apart from others."""
    return F.concat_ws("/", F.when(filing_type == "P", "ptr-pdfs").otherwise("financial-pdfs"), year.cast("string"), F.concat(doc_id, F.lit(".pdf")))


def candidate_years(rows: DataFrame, year: str = "year") -> DataFrame:
    """Each row three times, with the years to try in order: its own, the one before, the one after."""
    return rows.select("*", F.posexplode(F.array(F.col(year), F.col(year) - 1, F.col(year) + 1)).alias("attempt", "try_year"))


def search_results(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Reports of landed search pages {"result": "ok", "data": [[first, last, office, link, date], ...]}, a file each or a line each."""
    pages = spark.read.schema("result string, data array<array<string>>").option("multiLine", not lines).json(path)
    checked = pages.select(F.when(F.col("result") == "ok", F.col("data")).otherwise(F.raise_error("a search page without result")).alias("data"))
    return search_rows(checked.select(F.explode("data").alias("r")))


# Fixed value: the links that name a trade report.
REPORT_LINK = r'<a href="/search/view/(ptr|paper)/([0-9a-f-]{36})/"[^>]*>Periodic Transaction Report for \d{2}/\d{2}/\d{4}(?:\s*\((Amendment \d+)\))?</a>'


def search_rows(rows: DataFrame) -> DataFrame:
    """Rows whose link has a trade report's title; others are dropped. A date that is none stops the job."""
    link = F.get("r", F.lit(3))
    kind = F.regexp_extract(link, REPORT_LINK, 1)
    return rows.filter(F.coalesce(kind, F.lit("")) != "").select(
        F.concat(F.lit("senate:"), F.regexp_extract(link, REPORT_LINK, 2)).alias("filing_id"), filer_name(F.get("r", F.lit(0)), F.get("r", F.lit(1))).alias("filer_name"), (kind == "ptr").alias("is_electronic"),
        F.regexp_extract(link, REPORT_LINK, 3).alias("amendment"), strict_form_date(bare(F.get("r", F.lit(4)))).alias("filed_date"),
    )


# --- people, committees


def _person(entry):
    name, key = entry.get("name") or {}, (entry.get("id") or {}).get("bioguide")
    full = name.get("official_full") or " ".join(x for x in (name.get("first"), name.get("last")) if x)
    for term in entry.get("terms") or []:
        text = lambda k: None if term.get(k) is None else str(term[k])  # noqa: B023, E731
        yield key, full, text("type"), text("start"), text("end"), text("state"), text("district"), text("party")


def people_terms(spark: SparkSession, path: str) -> DataFrame:
    """One row per term that was not over before the first day kept."""
    schema = "bioguide_id string, full_name string, kind string, start_text string, end_text string, state string, district string, party string"
    rows = parsed_entries(list_entries(spark, path), _person, schema)
    terms = rows.select("bioguide_id", "full_name", code_name(F.col("kind"), TERM_CHAMBERS).alias("chamber"), iso_date("start_text").alias("start_date"), iso_date("end_text").alias("end_date"), "state", "district", "party")
    return terms.filter(F.col("bioguide_id").isNotNull() & F.col("chamber").isNotNull() & (F.col("end_date").isNull() | (F.col("end_date") >= F.lit(FIRST_TERM_END).cast("date"))))


def people(terms: DataFrame) -> DataFrame:
    """One row per person with the attributes of the last term."""
    last = F.max_by(F.struct("full_name", "chamber", "party", "state", "district"), F.struct("start_date", F.coalesce("end_date", F.lit("9999-12-31").cast("date"))))
    return terms.groupBy("bioguide_id").agg(last.alias("t")).select("bioguide_id", "t.*")


def committees(spark: SparkSession, path: str) -> DataFrame:
    rows = parsed_entries(list_entries(spark, path), lambda x: [(x.get("type"), x.get("thomas_id"), x.get("name"))], "chamber string, thomas_id string, name string")
    return rows.filter(F.col("chamber").isin("house", "senate", "joint") & F.col("thomas_id").isNotNull() & F.col("name").isNotNull())


def memberships(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """Members of known committees; members without id are dropped."""
    schema = "thomas_id string, bioguide_id string, party string, rank int, title string"

    def parse(entry, key):
        for committee, members in ({key: [entry]} if key is not None else entry).items():
            for m in members or []:
                yield committee, m.get("bioguide"), m.get("party"), m.get("rank"), m.get("title")

    rows = parsed_entries(keyed_entries(spark, path), parse, schema)
    return rows.filter(F.col("bioguide_id").isNotNull()).join(known.select("thomas_id").distinct(), "thomas_id", "left_semi")


# --- companies


def companies(spark: SparkSession, path: str) -> DataFrame:
    """(cik, ticker, title) of a JSON object whose values are companies; incomplete ones are dropped."""
    return company_rows(spark.read.text(path, wholetext=True))


def company_rows(texts: DataFrame) -> DataFrame:
    """(cik, ticker, title, position): the last of several companies with a ticker is the one that counts."""
    rows = texts.select(F.posexplode(F.map_entries(F.from_json("value", "map<string,struct<cik_str:bigint,ticker:string,title:string>>"))).alias("position", "e")).select("position", "e.value.*")
    rows = rows.filter("cik_str is not null and coalesce(ticker, '') <> '' and coalesce(title, '') <> ''")
    return rows.select(zero_padded(F.col("cik_str").cast("string")).alias("cik"), F.upper("ticker").alias("ticker"), "title", "position")


def industry_codes(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """(cik, sic, sic_description) of landed submission documents, a file each or a line each; empty codes are null."""
    rows = spark.read.schema("cik string, sic string, sicDescription string").option("multiLine", not lines).json(path)
    return rows.select(zero_padded(F.col("cik")).alias("cik"), F.nullif("sic", F.lit("")).alias("sic"), F.nullif("sicDescription", F.lit("")).alias("sic_description"))


def enrich_industries(instruments: DataFrame, codes: DataFrame, now: Column, batch: int = 200) -> DataFrame:
    """The next ``batch`` instruments never tried, with their codes where there are any, marked as tried."""
    todo = instruments.filter("sic_synced_at is null and cik is not null").orderBy("instrument_id").limit(batch)
    found = codes.select("cik", F.col("sic").alias("_s"), F.col("sic_description").alias("_d"))
    rows = todo.join(found, "cik", "left").withColumns({"sic": F.coalesce("_s", "sic"), "sic_description": F.coalesce("_d", "sic_description"), "sic_synced_at": now})
    return rows.select(*instruments.columns)


# --- community feeds


HOUSE_FEED = "transaction_date string, disclosure_date string, ticker string, asset_description string, asset_type string, type string, amount string, representative string, owner string, filing_id string"
SENATE_FEED = "transaction_date string, owner string, ticker string, asset_description string, asset_type string, type string, amount string, senator string, ptr_link string"


def _feed(rows: DataFrame, source: str, chamber: str, filing: Column, filer: str, disclosed: Column) -> DataFrame:
    bounds = amount_range(F.coalesce(clean_text("amount"), F.lit("")))
    return rows.select(
        F.lit(source).alias("source"), F.lit(chamber).alias("chamber"), filing.alias("external_filing_id"), clean_text(filer).alias("filer_name"), clean_text("ticker").alias("ticker"),
        clean_text("asset_description").alias("asset_description"), clean_text("asset_type").alias("asset_type"), clean_text("type").alias("tx_type"), clean_text("owner").alias("owner"),
        form_date(clean_text("transaction_date")).alias("tx_date"), disclosed.alias("disclosure_date"), bounds["low"].alias("amount_min"), bounds["high"].alias("amount_max"),
    )


def house_feed(spark: SparkSession, path: str) -> DataFrame:
    return _house_rows(spark.read.schema(HOUSE_FEED).option("multiLine", True).json(path))


def senate_feed(spark: SparkSession, path: str) -> DataFrame:
    return _senate_rows(spark.read.schema(SENATE_FEED).option("multiLine", True).json(path))


def feed_of(pages: DataFrame, chamber: str) -> DataFrame:
    """A community feed landed as lines (value), each a JSON array of entries: as splittable as any text."""
    entry, rows = (HOUSE_FEED, _house_rows) if chamber == "house" else (SENATE_FEED, _senate_rows)
    return rows(pages.select(F.explode(F.from_json("value", f"array<struct<{entry.replace(' string', ':string')}>>")).alias("e")).select("e.*"))


def _house_rows(rows: DataFrame) -> DataFrame:
    filing = F.concat(F.lit("house:"), clean_text("filing_id"))
    return _feed(rows, "house_feed", "house", filing, "representative", form_date(clean_text("disclosure_date")))


def _senate_rows(rows: DataFrame) -> DataFrame:
    filing = F.concat(F.lit("senate:"), F.lower(report_uuid("ptr_link")))
    return _feed(rows, "senate_feed", "senate", filing, "senator", F.lit(None).cast("date"))


# --- tables of people's work


def overrides(spark: SparkSession, path: str) -> DataFrame:
    """(match_type, match_value, ticker, cik): blanks are null; of repeated keys the last line counts."""
    rows = spark.read.schema("match_type string, match_value string, ticker string, cik string, reason string").option("header", True).csv(path)
    blank = lambda c: F.nullif(bare(F.coalesce(c, F.lit(""))), F.lit(""))
    rows = rows.select(bare("match_type").alias("match_type"), bare("match_value").alias("match_value"), blank("ticker").alias("ticker"), blank("cik").alias("cik"), F.monotonically_increasing_id().alias("_line"))
    last = rows.groupBy("match_type", "match_value").agg(F.max_by(F.struct("ticker", "cik"), "_line").alias("o"))
    return last.select("match_type", "match_value", "o.ticker", "o.cik")


TRANSCRIBED = "doc_id string, page string, row string, owner string, asset_name string, ticker string, tx_type string, tx_date string, notification_date string, amount_band string, k_flag string, confidence string, review string, note string"


def transcribed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(rows with an asset, filings without any): normalised rows of transcribed reports."""
    rows = transcribed_rows(spark.read.schema(TRANSCRIBED).option("header", True).csv(path))
    filled = rows.filter("asset_description_raw <> ''")
    return filled, rows.select("filing_id").distinct().join(filled.select("filing_id").distinct(), "filing_id", "left_anti")


def transcribed_rows(rows: DataFrame) -> DataFrame:
    b = lambda c: F.nullif(bare(F.coalesce(c, F.lit(""))), F.lit(""))
    only = lambda c, *names: F.when(b(c).isin(*names), b(c))
    bounds = band_range(F.upper(b("amount_band")))
    return rows.select(
        F.concat(F.lit("house:"), bare("doc_id")).alias("filing_id"), b("row").try_cast("int").alias("row_index"), only("owner", "self", "spouse", "joint", "child").alias("owner"),
        F.coalesce(b("asset_name"), F.lit("")).alias("asset_description_raw"), F.coalesce(F.upper(b("ticker")), ticker_in_name("asset_name")).alias("ticker"),
        only("tx_type", "purchase", "sale_full", "sale_partial", "exchange").alias("tx_type"), iso_date("tx_date").alias("tx_date"), iso_date("notification_date").alias("notification_date"),
        bounds["low"].alias("amount_min"), bounds["high"].alias("amount_max"), b("confidence").alias("confidence"), b("review").alias("review"), b("note").alias("note"),
    )


# --- HTML reports


def report_rows(pages: DataFrame, key: str = "filing_id", html: str = "html", every_page: bool = False) -> DataFrame:
    """Trades of HTML reports. Rows of fewer than nine cells are dropped, but count for row_index.

    With ``every_page`` each page has one row more, without ``row_index`` and all else.
    """
    rows = table_cells(pages, key, html, every_page).filter((F.size("cells") >= 9) | F.col("row_index").isNull())
    # cells have no white space at their ends; each is taken from the list once
    rows = rows.select(key, "row_index", *(F.get("cells", F.lit(i)).alias(f"_{i}") for i in range(9)))
    c = [F.col(f"_{i}") for i in range(9)]
    option, bounds = option_cell(c[4]), amount_range(c[7])
    # what an option's cell has is looked for where its mark is
    low = F.lower(c[4])
    with_option = lambda x: F.when(F.contains(low, F.lit("option")) & F.contains(low, F.lit("strike price:")), x)
    known = lambda x: F.when((x != "") & (x != "--"), x)
    return rows.select(
        key, "row_index", form_date(c[1]).alias("tx_date"), code_name(F.lower(c[2]), OWNER_NAMES).alias("owner"), known(c[3]).alias("ticker"), before_option_details(c[4]).alias("asset_description_raw"),
        known(c[5]).alias("asset_type"), code_name(F.lower(c[6]), TRADE_NAMES).alias("tx_type"), bounds["low"].alias("amount_min"), bounds["high"].alias("amount_max"),
        with_option(option["option_type"]).alias("option_type"), with_option(option["strike"]).alias("strike"), with_option(option["expiry"]).alias("expiry"), F.lit(None).cast("date").alias("notification_date"), unread_date(c[1]).alias("unread_date"),
    )
