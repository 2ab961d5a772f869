"""Column expressions for names, tickers, codes and other short texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Words that are no part of a person's name.
NAME_TITLES = ["hon", "honorable", "mr", "mrs", "ms", "dr", "jr", "sr", "ii", "iii", "iv"]
# Words and patterns that are no part of a company's name.
COMPANY_NOISE = r"\b(inc|incorporated|corp|corporation|co|company|ltd|plc|llc|lp|class\s+[a-c]|common\s+stock|ordinary\s+shares)\b\.?"
EXCHANGE_MENTION = r"\b(NYSEARCA|NASDAQ|NYSE|CBOE|OTC)\s*:\s*[A-Z]{1,5}\b"
# The codes of reports.
OWNER_CODES = {"SP": "spouse", "JT": "joint", "DC": "child"}
OWNER_NAMES = {"self": "self", "spouse": "spouse", "joint": "joint", "dependent child": "child"}
TRADE_CODES = {"P": "purchase", "S": "sale_full", "E": "exchange"}
TRADE_NAMES = {"purchase": "purchase", "sale (full)": "sale_full", "sale (partial)": "sale_partial", "exchange": "exchange"}
TERM_CHAMBERS = {"rep": "house", "sen": "senate"}


def bare(x: Column | str) -> Column:
    """Without white space at both ends, by Unicode's notion of white space."""
    return F.regexp_replace(x, r"(?U)^\s+|\s+$", "")


def single_spaced(x: Column | str) -> Column:
    return bare(F.regexp_replace(x, r"(?U)\s+", " "))


def code_name(x: Column, table: dict[str, str]) -> Column:
    """The name of a code, null if it has none."""
    return F.element_at(F.create_map(*(F.lit(v) for pair in table.items() for v in pair)), x)


def person_name(x: Column | str) -> Column:
    """Lower case, without titles, stops, commas and extra spaces."""
    words = F.split(single_spaced(F.regexp_replace(F.lower(x), "[.,]", " ")), " ")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(NAME_TITLES)), " ")


def ticker(x: Column | str) -> Column:
    return F.upper(bare(x))


def company_name(x: Column | str) -> Column:
    """Lower case, without bracketed types, a leading ticker, exchange mentions, legal forms and stops."""
    for pattern in (r"\[[^\]]*\]", r"^[A-Z]{1,5}(?U:\s)*-(?U:\s)*", "(?i)" + EXCHANGE_MENTION, "(?i)" + COMPANY_NOISE, "[.,:()]"):
        x = F.regexp_replace(x, pattern, " ")
    return F.lower(single_spaced(x))


def dash_to_null(x: Column | str) -> Column:
    """Stripped, with empty texts and double dashes as null."""
    text = bare(x)
    return F.when((text == "") | (text == "--"), F.lit(None)).otherwise(text)


def clean_text(x: Column | str) -> Column:
    """As ``dash_to_null``, without NUL characters."""
    x = F.col(x) if isinstance(x, str) else x
    return dash_to_null(F.replace(x.cast("string"), F.lit("\x00"), F.lit("")))


# The marks and patterns of the sources' texts.
_OPTION_MARK = "Option Type:"
_TICKER_AND_TYPE = r"\(([A-Za-z0-9.\-/]{1,15})\)\s*\[([A-Za-z]{1,4})\]\s*$"
_TYPE_ALONE = r"\[([A-Za-z]{1,4})\]\s*$"
_TICKER_ALONE = r"\(([A-Za-z0-9.\-/]{1,15})\)\s*$"
_TICKER_IN_NAME = r"\(([A-Z][A-Z.\-]{0,5})\)\s*$"
_REPORT_ID = r"([0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12})"
_OPTION_TEXT = r"(?is)(call|put)s?\s+options?.*?strike\s+price\s*\$([\d,]+(?:\.\d+)?).*?expires?\s*(\d{2}/\d{2}/\d{4})"
_OPTION_LOOSE = r"(?i)\b(calls?|puts?)\b"
_OPTION_CELL = r"(?i)Option Type:\s*(Call|Put)\s*Strike price:\s*\$([\d,.]+)\s*Expires:\s*(\d{4}-\d{2}-\d{2})"


def before_option_details(x: Column | str) -> Column:
    return bare(F.substring_index(x, _OPTION_MARK, 1))


def _found(x, pattern: str, group: int = 1) -> Column:
    got = F.regexp_extract(x, pattern, group)
    return F.when(got != "", got)


def suffix_ticker(x: Column | str) -> Column:
    """The ticker in parentheses at the end, before a bracketed type or alone."""
    return F.upper(F.coalesce(_found(x, _TICKER_AND_TYPE), F.when(_found(x, _TYPE_ALONE).isNull(), _found(x, _TICKER_ALONE))))


def suffix_type(x: Column | str) -> Column:
    return F.upper(F.coalesce(_found(x, _TICKER_AND_TYPE, 2), _found(x, _TYPE_ALONE)))


def ticker_in_name(x: Column | str) -> Column:
    return _found(F.upper(x), _TICKER_IN_NAME)


def report_uuid(link: Column | str) -> Column:
    return _found(link, _REPORT_ID)


def option_details(x: Column | str) -> Column:
    """struct(option_type, strike, expiry) from a description; of an informal one only the type."""
    full = _found(x, _OPTION_TEXT)
    loose = F.regexp_replace(F.lower(_found(x, _OPTION_LOOSE)), "s$", "")
    strike = F.replace(_found(x, _OPTION_TEXT, 2), F.lit(","), F.lit("")).cast("double")
    expiry = F.to_date(_found(x, _OPTION_TEXT, 3), "MM/dd/yyyy")
    return F.struct(F.coalesce(F.lower(full), loose).alias("option_type"), strike.alias("strike"), expiry.alias("expiry"))


def option_cell(x: Column | str) -> Column:
    """struct(option_type, strike, expiry) from a report's asset cell."""
    from .money import number

    return F.struct(F.lower(_found(x, _OPTION_CELL)).alias("option_type"), number(_found(x, _OPTION_CELL, 2)).alias("strike"), F.try_to_date(_found(x, _OPTION_CELL, 3), "yyyy-MM-dd").alias("expiry"))


def series_tier(filing_id: Column | str) -> Column:
    """How readable a document's series is, from the digits after the first colon."""
    number = F.regexp_replace(filing_id, "^[^:]*:", "")
    return F.when(number.rlike(r"^20\d{6}$"), "clean").when(number.rlike(r"^[89]\d{6}$"), "risky").otherwise("unknown")


def filer_name(*parts: Column) -> Column:
    """The parts that are not empty, with single spaces between."""
    return F.concat_ws(" ", *(F.nullif(bare(p), F.lit("")) for p in parts))


def content_type(key: Column) -> Column:
    end = F.lower(F.substring_index(key, ".", -1))
    return F.coalesce(code_name(end, {"pdf": "application/pdf", "html": "text/html", "xml": "application/xml", "gz": "application/gzip", "zip": "application/zip"}), F.lit("application/octet-stream"))


def zero_padded(x: Column, width: int = 10) -> Column:
    """Zeros in front up to ``width``; longer texts stay whole."""
    return F.when(F.length(x) >= width, x).otherwise(F.lpad(x, width, "0"))
