"""Who filed, and what was traded: overrides first, then exact, then similar names."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import similarity as sim
from ..functions.text import company_name, person_name, ticker


def _bucket(day: Column, days: int) -> Column:
    return F.floor(F.datediff(day, F.lit("1970-01-01").cast("date")) / days).cast("int")


def active_terms(facts: DataFrame, terms: DataFrame, key: str, as_of: str, begin: str = "start_date", end: str = "end_date", days: int = 180, last: date | None = None) -> DataFrame:
    """Facts with the terms of their key that hold on their day; both ends count, an open end always holds.

    Time is cut into buckets of ``days``. A fact is in the bucket of its day and a term in each that it
    touches, so they meet by an equality on (key, bucket) and at most once; a key with most facts is spread over
    its buckets. Open ends are taken to the last day of any fact, which one aggregate over ``facts`` gives. Where these come
    from a join, ``last``, a day that no fact is after, saves computing them twice.
    """
    last = last or facts.agg(F.max(as_of)).first()[0]
    other = [c for c in terms.columns if c != key]
    held = terms.select(key, *(F.col(c).alias(f"_t_{c}") for c in other))
    first, over = F.col(f"_t_{begin}"), F.least(F.coalesce(f"_t_{end}", F.lit(last).cast("date")), F.lit(last).cast("date"))
    held = held.filter(first <= over).withColumn("_bucket", F.explode(F.sequence(_bucket(first, days), _bucket(over, days))))
    met = facts.withColumn("_bucket", _bucket(F.col(as_of), days)).join(held, [key, "_bucket"])
    holds = (first <= F.col(as_of)) & (F.col(f"_t_{end}").isNull() | (F.col(f"_t_{end}") >= F.col(as_of)))
    return met.filter(holds).select(*facts.columns, *(F.col(f"_t_{c}").alias(c) for c in other))


def overlapping_terms(left: DataFrame, right: DataFrame, key: str, begin: str = "start_date", end: str = "end_date", days: int = 180) -> DataFrame:
    """Pairs of intervals of a key that share a day, the columns of ``right`` with the prefix ``other_``.

    Both sides are cut into buckets. A pair meets in each bucket that both touch; it counts in the one where the later of the two begins.
    Intervals must have both ends.
    """

    def cut(df: DataFrame) -> DataFrame:
        return df.filter(F.col(begin) <= F.col(end)).withColumn("_bucket", F.explode(F.sequence(_bucket(F.col(begin), days), _bucket(F.col(end), days))))

    other = cut(right).select(key, "_bucket", *(F.col(c).alias(f"other_{c}") for c in right.columns if c != key))
    later = F.greatest(F.col(begin), F.col(f"other_{begin}"))
    met = cut(left).join(other, [key, "_bucket"]).filter((later <= F.least(F.col(end), F.col(f"other_{end}"))) & (F.col("_bucket") == _bucket(later, days)))
    return met.drop("_bucket")


def two_best(scored: DataFrame, key: str | list[str], score_col: str, *ties: str) -> DataFrame:
    """The best row of each key, with ``second``: the next best score."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(F.col(score_col).desc(), *ties)
    return scored.withColumns({"_rank": F.row_number().over(w), "second": F.lead(score_col).over(w)}).filter("_rank = 1").drop("_rank")


def link_people(filings: DataFrame, terms: DataFrame, people: DataFrame, overrides: DataFrame) -> DataFrame:
    """(filing_id, bioguide_id, method, score) for every filing.

    ``filings``: filing_id, chamber, filer_name, as_of. ``terms``: bioguide_id, chamber,
    start_date, end_date. ``people``: bioguide_id, full_name. ``overrides``: chamber,
    filer_name, bioguide_id. Names are scored once per different name and candidate.
    """
    named = filings.withColumn("_name", person_name("filer_name"))
    fixed = overrides.select("chamber", person_name("filer_name").alias("_name"), F.col("bioguide_id").alias("_fixed")).dropDuplicates(["chamber", "_name"])
    named = named.join(F.broadcast(fixed), ["chamber", "_name"], "left")  # kept by hand, so few
    # filings of a day and chamber have the same candidates, and many filings the same name: neither is joined per filing
    asked = named.filter(F.col("_fixed").isNull()).select("chamber", "_name", "as_of").distinct()
    candidates = active_terms(asked.select("chamber", "as_of").distinct(), terms.select("chamber", "bioguide_id", "start_date", "end_date"), "chamber", "as_of").select("chamber", "as_of", "bioguide_id").distinct()
    pairs = asked.join(candidates, ["chamber", "as_of"])
    known = people.select("bioguide_id", person_name("full_name").alias("_full"))
    names = pairs.select("_name", "bioguide_id").distinct().join(known, "bioguide_id")
    scores = names.withColumn("score", sim.score(sim.sorted_tokens("_name"), sim.sorted_tokens("_full"))).select("_name", "bioguide_id", "score")
    best = two_best(pairs.join(scores, ["_name", "bioguide_id"]), ["chamber", "_name", "as_of"], "score", "bioguide_id")
    best = best.select("chamber", "_name", "as_of", F.col("bioguide_id").alias("_found"), "score", "second")
    out = named.join(best, ["chamber", "_name", "as_of"], "left")
    method = F.when(F.col("_fixed").isNotNull(), "override").otherwise(sim.person_decision(F.col("score"), F.col("second")))
    out = out.withColumn("method", method)
    chosen = F.when(F.col("method") == "override", F.col("_fixed")).when(F.col("method") == "fuzzy", F.col("_found"))
    return out.select("filing_id", chosen.alias("bioguide_id"), "method", F.when(F.col("method") == "override", F.lit(100.0)).otherwise(F.coalesce("score", F.lit(0.0))).alias("score"))


def trigrams(x: Column) -> Column:
    """The runs of three letters of a text, repeated ones numbered; a shorter text is one."""
    runs = F.transform(F.sequence(F.lit(1), F.greatest(F.length(x) - 2, F.lit(1))), lambda i: F.substring(x, i, F.lit(3)))
    return F.transform(runs, lambda g, k: F.struct(g.alias("gram"), F.size(F.filter(F.slice(runs, F.lit(1), k), lambda h: h == g)).alias("nth")))


def _needed(x: Column, threshold: float) -> Column:
    """How many trigrams of a text, whichever they are, include one of every text that scores ``threshold`` or more.

    Each letter that only this text has spoils three of its trigrams, one that only the other has two. A score
    of t allows r = 2 (100 - t) / t such letters per common one, so at most 3 r / (1 + r) trigrams per letter are spoiled.
    """
    r = 2 * (100 - threshold) / threshold
    return F.floor(F.length(x) * (3 * r / (1 + r)) + 1e-6) + 1


def similar_companies(descriptions: DataFrame, companies: DataFrame, threshold: float = sim.SECURITY_REVIEW) -> DataFrame:
    """(description, cik, ticker, score): the best company at or above ``threshold``, 90 at least, for every different description.

    Of equal scores the first row of ``companies`` by ``position`` counts, so of a company with several tickers the one listed first.
    A description meets the companies that have one of its rarest trigrams, as many as leave no pair at the
    threshold out, and a length that allows it. Trigrams that most companies have join nothing but short texts.
    """
    if threshold < 90:
        raise ValueError("below 90 texts may match without a common trigram")
    place = F.col("position").cast("long") if "position" in companies.columns else F.lit(0).cast("long")
    d = descriptions.select("description").distinct().withColumn("_d", sim.sorted_tokens(company_name("description"))).filter("_d <> ''")
    named = F.upper("ticker") if "ticker" in companies.columns else F.lit(None).cast("string")
    # rows of equal names score alike: the first stands for them
    c = companies.select(sim.sorted_tokens(company_name("title")).alias("_c"), F.struct(place.alias("position"), "cik", named.alias("ticker")).alias("row")).filter("_c <> ''").groupBy("_c").agg(F.min("row").alias("row"))
    right = c.select("_c", F.explode(trigrams(F.col("_c"))).alias("_g"))
    left = d.select("_d").distinct().select("_d", F.explode(trigrams(F.col("_d"))).alias("_g"))
    left = left.join(right.groupBy("_g").agg(F.count("*").alias("_n")), "_g", "left")
    rarest = Window.partitionBy("_d").orderBy(F.col("_n").asc_nulls_first(), "_g")
    left = left.withColumn("_rank", F.row_number().over(rarest)).filter((F.col("_rank") <= _needed(F.col("_d"), threshold)) & F.col("_n").isNotNull())
    near = left.join(right, "_g").filter(sim.lengths_allow(F.col("_d"), F.col("_c"), threshold)).select("_d", "_c").distinct()
    scored = near.withColumn("score", sim.score(F.col("_d"), F.col("_c"))).filter(F.col("score") >= threshold).join(c, "_c")
    best = two_best(scored, "_d", "score", "row").select("_d", "row.cik", "row.ticker", "score")
    return d.join(best, "_d").select("description", "cik", "ticker", "score")


def link_securities(rows: DataFrame, companies: DataFrame, overrides: DataFrame) -> DataFrame:
    """(row_id, ticker, cik, method) of every row of (row_id, ticker, description).

    In order: an override of the ticker, the company with the ticker, an override of the
    description, the most similar company. An override names a company by its ticker; where no
    company has it, the override's own number counts, padded. One without ticker stops the search
    and leaves the row unlinked. Of companies with the same ticker the last by ``position`` counts.
    """

    def fixed(kind: str, key: str, mark: str) -> DataFrame:
        """(key, mark_t, mark_c) of one kind of override, its company looked up."""
        o = overrides.filter(F.col("match_type") == kind).select(F.col("match_value").alias(key), ticker("ticker").alias("_t"), "cik").dropDuplicates([key])
        return o.join(exact, "_t", "left").select(key, F.col("_t").alias(f"{mark}t"), F.when(F.col("_t").isNotNull(), F.coalesce("_xc", F.lpad(F.coalesce("cik", F.lit("")), 10, "0"))).alias(f"{mark}c"), F.lit(True).alias(mark))

    last = F.max_by("cik", "position") if "position" in companies.columns else F.max("cik")
    exact = companies.groupBy(ticker("ticker").alias("_t")).agg(last.alias("_xc"))
    by_ticker, by_text = fixed("ticker", "_own", "_o"), fixed("description", "_text", "_d")
    r = rows.withColumns({"_t": ticker("ticker"), "_own": ticker("ticker"), "_text": F.trim("description")})
    r = r.join(by_ticker, "_own", "left").join(exact, "_t", "left").join(by_text, "_text", "left")
    open_rows = r.filter("_o is null and _xc is null and _d is null")
    fuzzy = similar_companies(open_rows, companies).withColumnsRenamed({"cik": "_fc", "ticker": "_ft"}).drop("score")
    r = r.join(fuzzy, "description", "left")
    method = F.when(F.col("_o"), "override").when(F.col("_xc").isNotNull(), "ticker").when(F.col("_d"), "override").when(F.col("_fc").isNotNull(), "fuzzy").otherwise("unmatched")
    return r.select(
        "row_id",
        F.when(F.col("_o"), F.col("_ot")).when(F.col("_xc").isNotNull(), F.col("_t")).when(F.col("_d"), F.col("_dt")).otherwise(F.col("_ft")).alias("ticker"),
        F.when(F.col("_o"), F.col("_oc")).when(F.col("_xc").isNotNull(), F.col("_xc")).when(F.col("_d"), F.col("_dc")).otherwise(F.col("_fc")).alias("cik"),
        method.alias("method"),
    )
