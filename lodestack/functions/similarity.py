"""Token-sorted similarity of short texts, and the rules that decide on a match.

The score is 100 * 2 * LCS / (length a + length b) of the texts with their words sorted: the
normalised insertion and deletion distance. Both forms give the same numbers; the vectorised
one is for large joins, the native one for expressions that must stay in the JVM.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import single_spaced

# Thresholds of the decisions.
PERSON_REVIEW, PERSON_SURE, PERSON_MARGIN, SECURITY_REVIEW = 80.0, 92.0, 5.0, 90.0


def sorted_tokens(x: Column | str) -> Column:
    return F.array_join(F.array_sort(F.split(single_spaced(x), " ")), " ")


def native_score(a: Column, b: Column) -> Column:
    """The score as a Spark expression; 0 if a text is empty."""

    def row(previous: Column, i: Column) -> Column:
        def cell(done: Column, j: Column) -> Column:
            same = F.substring(a, i, F.lit(1)) == F.substring(b, j, F.lit(1))
            best = F.when(same, F.element_at(previous, j) + 1).otherwise(F.greatest(F.element_at(previous, j + 1), F.element_at(done, j)))
            return F.concat(done, F.array(best))

        return F.aggregate(F.sequence(F.lit(1), F.length(b)), F.array(F.lit(0)), cell)

    start = F.transform(F.sequence(F.lit(0), F.length(b)), lambda _: F.lit(0))
    common = F.aggregate(F.sequence(F.lit(1), F.length(a)), start, row, lambda r: F.element_at(r, -1))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(F.round(200.0 * common / (F.length(a) + F.length(b)), 4))


def common_length(a: str, b: str) -> int:
    """The longest common subsequence, one machine word operation per character: the set bits of a row are its steps."""
    places: dict[str, int] = {}
    for k, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = (row + hit | row - hit) & full
    return len(a) - row.bit_count()


def _scores(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([round(200.0 * common_length(x, y) / (len(x) + len(y)), 4) if x and y else 0.0 for x, y in zip(a, b, strict=True)])


def score(a: Column, b: Column) -> Column:
    """The score by an Arrow-batched function."""
    return F.pandas_udf(_scores, "double")(a, b)


def lengths_allow(a: Column, b: Column, threshold: float) -> Column:
    """Whether texts of these lengths can reach ``threshold`` at all."""
    return 200.0 * F.least(F.length(a), F.length(b)) >= threshold * (F.length(a) + F.length(b))


def person_decision(best: Column, second: Column) -> Column:
    """unmatched, ambiguous or fuzzy, from the two best scores."""
    close = (best < PERSON_SURE) & (best - F.coalesce(second, F.lit(0.0)) < PERSON_MARGIN)
    return F.when(best.isNull() | (best < PERSON_REVIEW), "unmatched").when(close, "ambiguous").otherwise("fuzzy")
