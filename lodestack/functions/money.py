"""Amounts of money and their ranges."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import bare

# The letters of a form's amount columns.
AMOUNT_BANDS = {
    "A": "$1,001 - $15,000",
    "B": "$15,001 - $50,000",
    "C": "$50,001 - $100,000",
    "D": "$100,001 - $250,000",
    "E": "$250,001 - $500,000",
    "F": "$500,001 - $1,000,000",
    "G": "$1,000,001 - $5,000,000",
    "H": "$5,000,001 - $25,000,000",
    "I": "$25,000,001 - $50,000,000",
    "J": "Over $50,000,000",
}


def number(x: Column) -> Column:
    """The number after dollar signs and commas are dropped, null if there is none."""
    pattern = r"^[+-]?(\d+\.?\d*|\.\d+)$"
    # most texts have no other white space than blanks; only the rest is stripped by an expression
    plain, digits = F.trim(F.translate(x, "$,", "")), bare(F.translate(x, "$,", ""))
    return F.when(plain.rlike(pattern), plain.try_cast("double")).when(digits.rlike(pattern), digits.try_cast("double"))


def amount_range(x: Column | str) -> Column:
    """struct(low, high): both bounds of "$a - $b", only the lower one of "Over $a", else nulls."""
    text = F.col(x) if isinstance(x, str) else x
    over = F.lower(text).rlike(r"(?U)^\s*over")
    after = F.when(F.contains(text, F.lit("$")), F.substring(text, F.instr(text, "$") + 1, F.length(text)))
    halves = F.split(text, "-", 2)
    low = F.when(over, number(after)).when(F.size(halves) == 2, number(halves[0]))
    high = F.when(~over & (F.size(halves) == 2), number(F.get(halves, F.lit(1))))
    return F.struct(low.alias("low"), high.alias("high"))


def band_range(letter: Column) -> Column:
    from .text import code_name

    return amount_range(code_name(letter, AMOUNT_BANDS))


def whole_dollars(x: Column) -> Column:
    return F.concat(F.lit("$"), F.format_number(x, 0))


def amount_text(low: Column, high: Column) -> Column:
    """ "$1,001-$15,000", empty if a bound is missing."""
    return F.when(low.isNull() | high.isNull(), F.lit("")).otherwise(F.concat(whole_dollars(low), F.lit("-"), whole_dollars(high)))
