import pytest
from pyspark.sql import functions as F

from lodestack.functions import dates, money, similarity, text


def one(spark, column, *values, kind="string"):
    names = [f"v{i}" for i in range(len(values))]
    df = spark.createDataFrame([values], ", ".join(f"{n} {kind}" for n in names))
    return df.select(column(*(F.col(n) for n in names)).alias("r")).first()["r"]


@pytest.mark.parametrize("raw, low, high", [
    ("$1,001 - $15,000", 1001, 15000), ("Over $50,000,000", 50_000_000, None), ("over 5", None, None), ("$15,001 -", 15001, None), ("None", None, None), ("", None, None),
    ("Spouse/DC Over $1,000,000", None, None), ("-$5 - $10", None, None), (None, None, None), ("$5d - $nan", None, None),
])
def test_amount_range(spark, raw, low, high):
    r = one(spark, money.amount_range, raw)
    assert (r["low"], r["high"]) == (low, high)


def test_bands_and_text(spark):
    assert tuple(one(spark, money.band_range, "J")) == (50_000_000, None)
    assert tuple(one(spark, money.band_range, "Q")) == (None, None)
    assert one(spark, money.amount_text, 1001.0, 15000.0, kind="double") == "$1,001-$15,000"
    assert one(spark, money.amount_text, 1001.0, None, kind="double") == ""


@pytest.mark.parametrize("raw, name", [("Hon. Nancy Pelosi", "nancy pelosi"), ("Smith Jr., John", "smith john"), ("  JANE \u00a0 Doe  ", "jane doe"), ("", "")])
def test_person_name(spark, raw, name):
    assert one(spark, text.person_name, raw) == name


@pytest.mark.parametrize("raw, name", [("Apple Inc.", "apple"), ("Electronic Arts Inc.", "electronic arts"), ("EA - Electronic Arts Inc", "electronic arts"), ("Invesco QQQ [OT]", "invesco qqq"), ("Fund NYSEARCA: DIA [OT]", "fund")])
def test_company_name(spark, raw, name):
    assert one(spark, text.company_name, raw) == name


@pytest.mark.parametrize("raw, ticker, kind", [
    ("Netflix, Inc. - Common Stock (NFLX) [ST]", "NFLX", "ST"), ("US Treasury (91282CJR3)) [GS]", None, "GS"), ("Actavis plc ordinary shares (ACT)", "ACT", None), ("Chubb (Cb) [sT]", "CB", "ST"), ("nothing", None, None),
])
def test_suffixes(spark, raw, ticker, kind):
    assert one(spark, text.suffix_ticker, raw) == ticker
    assert one(spark, text.suffix_type, raw) == kind


def test_options(spark):
    r = one(spark, text.option_details, "Purchased 5 call options;\nstrike price $320 expires 06/18/2026")
    assert (r["option_type"], r["strike"], str(r["expiry"])) == ("call", 320.0, "2026-06-18")
    assert tuple(one(spark, text.option_details, "sold puts at $3")) == ("put", None, None)
    r = one(spark, text.option_cell, "Co Option Type: Call Strike price: $75.00 Expires: 2026-08-21")
    assert (r["option_type"], r["strike"], str(r["expiry"])) == ("call", 75.0, "2026-08-21")
    assert one(spark, text.before_option_details, "Williams Companies Option Type: Call") == "Williams Companies"


@pytest.mark.parametrize("raw, tier", [("house:20016829", "clean"), ("9107579", "risky"), ("house:8218645", "risky"), ("123", "unknown"), ("200168290", "unknown"), ("71234567", "unknown")])
def test_series(spark, raw, tier):
    assert one(spark, text.series_tier, raw) == tier


def test_small_texts(spark):
    assert one(spark, text.dash_to_null, " -- ") is None
    assert one(spark, text.clean_text, "F\x00\x00 S: New") == "F S: New"
    assert one(spark, text.zero_padded, "320193") == "0000320193"
    assert one(spark, text.zero_padded, "12345678901") == "12345678901"
    assert one(spark, text.ticker_in_name, "Intuitive Surgical Inc New (isrg)") == "ISRG"
    assert one(spark, text.filer_name, "Hon.", "", "Mark", "Alford") == "Hon. Mark Alford"
    assert one(spark, text.content_type, "a/b.PDF") == "application/pdf"


@pytest.mark.parametrize("raw, day", [("4/15/2026", "2026-04-15"), ("04/15/2026", "2026-04-15"), ("13/1/2026", None), ("", None), (None, None)])
def test_form_date(spark, raw, day):
    got = one(spark, dates.form_date, raw)
    assert (got and str(got)) == day


def test_silence_and_stamps(spark):
    ts = lambda x: F.lit(x).cast("timestamp")
    now = ts("2026-01-02 00:00:00")
    rows = spark.range(1).select(*(dates.silent(ts(x) if x else F.lit(None).cast("timestamp"), now).alias(f"c{i}") for i, x in enumerate([None, "2026-01-01 23:00:00", "2025-12-31 23:00:00", "2026-01-01 00:00:00"])))
    assert tuple(rows.first()) == (True, False, True, False)
    r = spark.range(1).select(dates.first_seen(F.lit("2026-01-01").cast("date"), now, F.lit(False)).alias("r"), dates.first_seen(F.lit(None).cast("date"), now, F.lit(False)).alias("s"), dates.backup_key(F.lit("2026-01-09").cast("date")).alias("k")).first()
    assert (str(r["r"]["first_seen_at"]), r["r"]["precision_s"], r["s"]["precision_s"]) == ("2026-01-01 00:00:00", 86_400, 315_360_000)
    assert "20260109" in r["k"]


@pytest.mark.parametrize("a, b, score", [("john smith", "john a smith", 90.9091), ("nancy pelosi", "nancy peloso", 91.6667), ("qwerty zzyx", "mcconnell mitch", 15.3846), ("invesco qqq", "invesco", 77.7778), ("", "x", 0.0)])
def test_scores_agree(spark, a, b, score):
    sort = similarity.sorted_tokens
    native = one(spark, lambda x, y: similarity.native_score(sort(x), sort(y)), a, b)
    vectorised = one(spark, lambda x, y: similarity.score(sort(x), sort(y)), a, b)
    assert native == pytest.approx(score, abs=1e-4)
    assert vectorised == pytest.approx(score, abs=1e-4)


@pytest.mark.parametrize("best, second, verdict", [(None, None, "unmatched"), (79.0, None, "unmatched"), (90.9, 90.9, "ambiguous"), (91.0, 80.0, "fuzzy"), (100.0, 91.7, "fuzzy")])
def test_person_decision(spark, best, second, verdict):
    assert one(spark, similarity.person_decision, best, second, kind="double") == verdict
