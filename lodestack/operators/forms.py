"""Trades and holdings from the positioned words of forms.

A page is a set of words with their places. Words are put into lines page by page, in Arrow batches inside
tasks. Trades are cut from the pages of whole filings in the same way, many filings at a time; holdings are windows and
aggregates over lines, within one filing at a time.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import form_date, unread_date
from ..functions.money import amount_range
from ..functions.text import OWNER_CODES, TRADE_CODES, code_name, option_details, suffix_ticker, suffix_type

# Tolerances in points, the columns of the current form, and marks of its lines.
LINE_TOLERANCE, COLUMN_MARGIN = 3.0, 3.0
DEFAULT_COLUMNS = {"id": 55.0, "owner": 100.0, "asset": 260.0, "kind": 325.0, "traded": 380.0, "notified": 445.0, "amount": 524.0}
AMOUNT_WIDTH = DEFAULT_COLUMNS["amount"] - DEFAULT_COLUMNS["notified"]
FOOTER = "For the complete list of asset type abbreviations"
LABELS = {"f": "filing", "s": "subholding", "d": "description", "l": "location"}
WORD_SCHEMA = "filing_id string, page int, text string, x0 double, top double"


def pages_of(words: DataFrame) -> DataFrame:
    """(filing_id, page, words): words as rows put together by page; one shuffle by filing serves all that follows."""
    return words.repartition("filing_id").groupBy("filing_id", "page").agg(F.collect_list(F.struct("text", F.col("x0").cast("double").alias("x0"), F.col("top").cast("double").alias("top"))).alias("words"))


def _line_numbers(page: np.ndarray, top: np.ndarray) -> np.ndarray:
    """The line of each word, in order of page and place: a word lower than the tolerance below the line's first begins the next one."""
    new = np.r_[True, (page[1:] != page[:-1]) | (top[1:] != top[:-1])]
    at, out, last, begin, line = np.flatnonzero(new), [], -1, 0.0, -1
    for p, t in zip(page[at].tolist(), top[at].tolist()):
        if p != last:
            last, begin, line = p, -np.inf, -1
        if t - begin > LINE_TOLERANCE:
            begin, line = t, line + 1
        out.append(line)
    return np.repeat(out, np.diff(np.r_[at, len(page)]))


class _Words:
    """The words of a list of pages, in order of page, line and place: ``flat`` has them as given, the other arrays in that order."""

    def __init__(self, lists: pa.Array):
        page = np.repeat(np.arange(len(lists)), pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False))
        self.flat = flat = lists.flatten()
        number = lambda c: pc.fill_null(flat.field(c), -np.inf).to_numpy(zero_copy_only=False)
        text, x0, top = flat.field("text"), number("x0"), np.nan_to_num(number("top"), nan=np.inf, neginf=-np.inf, posinf=np.inf)
        order = np.lexsort((top, page))
        line = np.empty(len(page), np.int32)
        line[order] = _line_numbers(page[order], top[order]) if len(page) else 0
        order = np.lexsort((x0, line, page))
        same = lambda a: a[order][1:] == a[order][:-1]
        if (same(x0) & same(line) & same(page)).any():
            order = np.lexsort((pc.rank(text.cast(pa.binary()), "ascending", null_placement="at_start", tiebreaker="dense").to_numpy(), x0, line, page))
        self.begins = np.flatnonzero(np.r_[len(page) > 0, ~(same(line) & same(page))][: len(page)])  # of the lines
        self.order, self.page, self.line = order, page[order], line[order]


def _cut(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The lines of a batch of pages (filing_id, page, words)."""
    w = _Words(batch.column(2))
    words = pa.StructArray.from_arrays([w.flat.field(c).take(pa.array(w.order)) for c in ("x0", "text")], ["x0", "text"])
    ends, at = pa.array(np.r_[w.begins, len(w.order)].astype(np.int32)), pa.array(w.page[w.begins])
    return pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(1).take(at), pa.array(w.line[w.begins], pa.int32()), pa.ListArray.from_arrays(ends, words)], ["filing_id", "page", "line", "words"])


def lines_of(words: DataFrame) -> DataFrame:
    """(filing_id, page, line, words): lines are bands of words no lower than a tolerance below the band's first word.

    Words come as rows, or as pages (filing_id, page, words) with an array of their words, which need no shuffle here. Words without a place are in line -1.
    """
    pages = words if "words" in words.columns else pages_of(words)
    given = pages.select("filing_id", F.col("page").cast("int").alias("page"), F.col("words").cast("array<struct<text:string,x0:double,top:double>>").alias("words"))
    kind = words.schema["filing_id"].dataType.simpleString()
    return given.mapInArrow(lambda batches: map(_cut, batches), f"filing_id {kind}, page int, line int, words array<struct<x0:double,text:string>>")


def _lines(given: DataFrame) -> DataFrame:
    """Lines of words, or what ``lines_of`` gave already: a job that reads lines more than once writes them first."""
    return given if "line" in given.columns else lines_of(given)


def _text(words: Column) -> Column:
    return F.array_join(words["text"], " ")


def _x(words: Column, name: str, last: bool = True) -> Column:
    found = F.transform(F.filter(words, lambda w: F.lower(w["text"]) == name), lambda w: w["x0"])
    return F.get(F.reverse(found) if last else found, F.lit(0))


def _header(w: Column) -> Column:
    """The right ends of a form's columns if the words are its header row, else null; lines that lack a name of the header are not searched."""
    low = F.lower(_text(w))
    named = F.contains(low, F.lit("notification")) & F.contains(low, F.lit("transaction")) & F.contains(low, F.lit("owner"))
    x = {n: _x(w, n) for n in ("owner", "asset", "transaction", "notification", "amount", "cap.")}
    dates = F.filter(w, lambda v: (F.lower(v["text"]) == "date") & (v["x0"] > x["transaction"]) & (v["x0"] < x["notification"]))
    date = F.get(dates, F.lit(0))["x0"]
    m = COLUMN_MARGIN
    ends = {"id": F.lit(DEFAULT_COLUMNS["id"]), "owner": x["asset"] - m, "asset": x["transaction"] - m, "kind": date - m, "traded": x["notification"] - m, "notified": x["amount"] - m, "amount": F.coalesce(x["cap."] - m, x["amount"] + AMOUNT_WIDTH)}
    found = x["owner"].isNotNull() & x["asset"].isNotNull() & x["transaction"].isNotNull() & date.isNotNull() & x["notification"].isNotNull() & x["amount"].isNotNull()
    return F.when(named, F.when(found, F.struct(*(e.alias(k) for k, e in ends.items()))))


def _zone(words: Column, low: Column | None, high: Column) -> Column:
    inside = lambda w: (w["x0"] < high) & (w["x0"] >= low) if low is not None else w["x0"] < high
    return F.transform(F.filter(words, inside), lambda w: w["text"])


# Marks of a line's words: what its text is searched for, as none of it has a space.
_MARKS = ("owner", "asset", "notification", "amount", "cap.", "gains", "$200?")
_LINE_END = r"(\r\n|[\n\r\x{85}\x{2028}\x{2029}])?$"
#: What a trade is read from: its id, owner, codes and dates, and its joined texts.
RECORD = "struct<i:string,o:string,k:string,p:boolean,d:string,n:string,a:string,m:string,t:string>"


def _cased(words: pa.Array, plain, whole) -> pa.Array:
    """Upper or lower case; words with letters beyond ASCII may become longer."""
    odd = pc.invert(pc.string_is_ascii(words))
    done = plain(words)
    return pc.replace_with_mask(done, odd, pa.array([whole(w) for w in words.filter(odd).to_pylist()], words.type)) if pc.any(odd).as_py() else done


def _ends_of(at: dict[str, np.ndarray]) -> np.ndarray:
    """The right ends of a form's columns from the places of its header's names."""
    m = COLUMN_MARGIN
    last = np.where(np.isnan(at["cap."]), at["amount"] + AMOUNT_WIDTH, at["cap."] - m)
    return np.stack([np.full(len(last), DEFAULT_COLUMNS["id"]), at["asset"] - m, at["transaction"] - m, at["date"] - m, at["notification"] - m, at["amount"] - m, last], axis=1)


def _read(batch: pa.RecordBatch) -> pa.RecordBatch:
    """(filing_id, electronic, trades) of the filings in a batch of their pages (filing_id, place, page, words); ``place`` is 1 where a filing begins.

    What a word tells by itself is found once for each different word of the batch, all else by its number.
    """
    w = _Words(batch.column(3))
    coded = w.flat.field("text").dictionary_encode()
    vocabulary = coded.dictionary
    code = pc.fill_null(coded.indices, -1).to_numpy(zero_copy_only=False)[w.order]
    low = _cased(vocabulary, pc.utf8_lower, str.lower)
    flag = lambda a: np.r_[pc.fill_null(a, False).to_numpy(zero_copy_only=False).astype(bool), False]  # noqa: E731  (the last for no text)
    is_word = lambda *xs: flag(pc.is_in(low, pa.array(xs)))
    is_text = code >= 0

    raw = w.flat.field("x0")
    x = raw.to_numpy(zero_copy_only=False).astype(float)
    x[np.isnan(x) & ~raw.is_null().to_numpy(zero_copy_only=False)] = np.inf  # no number is above all numbers; only a missing place is none
    x = x[w.order]

    # lines and filings
    n = len(w.begins)
    line_of = np.repeat(np.arange(n), np.diff(np.r_[w.begins, len(code)]))
    filing_of_row = np.cumsum(batch.column(1).to_numpy() == 1) - 1
    row = w.page[w.begins]
    filing = filing_of_row[row]
    numbers = pc.fill_null(batch.column(2).cast(pa.int64()), -(2**40)).to_numpy()
    page = np.cumsum(np.r_[False, (filing_of_row[1:] != filing_of_row[:-1]) | (numbers[1:] != numbers[:-1])])[row] if n else row

    def last_in(lines: int, of: np.ndarray, where: np.ndarray) -> np.ndarray:
        """The last word of each line, or what else ``of`` numbers, among those of a mask; -1 if there is none."""
        out, at = np.full(lines, -1), np.flatnonzero(where)
        out[of[at]] = at  # of equal places the last one stays
        return out

    # the first header of each filing sets its columns
    at = {}
    for name in ("owner", "asset", "transaction", "notification", "amount", "cap."):
        found = last_in(n, line_of, is_word(name)[code])
        at[name] = np.where(found >= 0, x[found] if len(x) else np.nan, np.nan)
    dates = np.flatnonzero(is_word("date")[code] & (x > at["transaction"][line_of]) & (x < at["notification"][line_of]))[::-1]
    at["date"] = np.full(n, np.nan)
    at["date"][line_of[dates]] = x[dates]
    heads = np.flatnonzero(~np.isnan(np.stack([v for k, v in at.items() if k != "cap."])).any(axis=0))[::-1]
    n_filings = int(filing_of_row[-1]) + 1 if len(filing_of_row) else 0
    columns, electronic = np.tile(np.array(list(DEFAULT_COLUMNS.values())), (n_filings, 1)), np.zeros(n_filings, bool)
    columns[filing[heads]], electronic[filing[heads]] = _ends_of({k: v[heads] for k, v in at.items()}), True

    # header lines are dropped, and a page from its footer on
    bits = sum(flag(pc.match_substring(low, m)).astype(np.int32) << k for k, m in enumerate(_MARKS)) | flag(pc.match_substring(vocabulary, FOOTER.split()[-1])).astype(np.int32) << len(_MARKS)
    bits = np.bitwise_or.reduceat(bits[code], w.begins) if n else np.zeros(0, np.int32)
    has = lambda a, b: (bits >> _MARKS.index(a) & 1 & bits >> _MARKS.index(b)).astype(bool)
    alive = ~(has("owner", "asset") | has("notification", "amount") | has("cap.", "gains") | has("$200?", "$200?"))
    ends = np.r_[w.begins, len(code)]
    footers = [k for k in np.flatnonzero(alive & (bits >> len(_MARKS) & 1).astype(bool)) if FOOTER in " ".join(t for t in vocabulary.take(pa.array([c for c in code[ends[k] : ends[k + 1]] if c >= 0], pa.int64())).to_pylist())]
    over = np.full(int(page[-1]) + 1 if n else 0, n)
    for k in reversed(footers):
        over[page[k]] = k
    alive &= np.arange(n) < over[page]

    # a line with a trade code opens a record, a label sets what the lines after it are
    right = columns[filing][line_of]
    zone = lambda k: (x < right[:, k]) & (x >= right[:, k - 1] if k else True)
    in_code = zone(3)
    is_code = in_code & flag(pc.match_substring_regex(vocabulary, "^[PSEpse]" + _LINE_END))[code] & alive[line_of]
    opens = np.zeros(n, bool)
    opens[line_of[is_code]] = True
    nul = flag(pc.match_substring(vocabulary, "\x00"))
    stripped = pc.utf8_rtrim(low, ":")
    initial = pc.utf8_slice_codeunits(low, 0, 1)
    other = [v for v in LABELS.values() if v != "description"]
    says = np.where(nul, np.where(flag(pc.equal(initial, "d")), 2, np.where(flag(pc.is_in(initial, pa.array(list(LABELS)))), 3, 0)), np.where(flag(pc.equal(stripped, "description")), 2, np.where(flag(pc.is_in(stripped, pa.array(other))), 3, 0)))
    mode = np.where(opens, 1, says[code[w.begins]] if n else 0)
    since = np.maximum.accumulate(np.where(alive & (mode > 0), np.arange(n), 0)) if n else row
    mode = mode[since] if n else mode
    opener = np.flatnonzero(opens)
    record = np.cumsum(opens) - 1
    held = alive & (record >= 0)
    held[held] = filing[opener][record[held]] == filing[held]
    record = np.where(held & (mode < 3), record, -1)

    # the fields of the opening lines, and the texts of all lines of a record
    n_records = len(opener)
    of = record[line_of]
    opening = opens[line_of]
    upper = _cased(vocabulary, pc.utf8_upper, str.upper)

    def last_word(where: np.ndarray, words: pa.Array = vocabulary) -> pa.Array:
        k = last_in(n_records, of, where & opening)
        c = np.where(k >= 0, code[k] if len(code) else -1, -1)
        return words.take(pa.array(c, pa.int64(), mask=c < 0))

    def joined(where: np.ndarray) -> pa.Array:
        k = np.flatnonzero(where & is_text & (of >= 0))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(np.searchsorted(of[k], np.arange(n_records + 1)), pa.int32()), vocabulary.take(pa.array(code[k], pa.int64()))), " ")

    is_date = flag(pc.match_substring_regex(vocabulary, "^[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}" + _LINE_END))[code]
    part = last_in(n_records, of, in_code & is_word("(partial)")[code] & opening) >= 0
    in_text = (mode == 2)[line_of] & ~nul[code] & ~flag(pc.equal(stripped, "description"))[code]
    fields = {
        "i": last_word(zone(0)), "o": last_word(zone(1) & flag(pc.is_in(upper, pa.array(list(OWNER_CODES))))[code], upper), "k": last_word(is_code, upper), "p": pa.array(part),
        "d": last_word(zone(4) & is_date), "n": last_word(zone(5) & is_date), "a": joined((mode == 1)[line_of] & zone(2)), "m": joined((mode == 1)[line_of] & zone(6)), "t": joined(in_text),
    }
    trades = pa.ListArray.from_arrays(pa.array(np.searchsorted(filing[opener], np.arange(n_filings + 1)), pa.int32()), pa.StructArray.from_arrays(list(fields.values()), list(fields)))
    shown = np.unique(filing)  # a filing without a word tells nothing
    first = np.flatnonzero(batch.column(1).to_numpy() == 1)[shown] if n else shown
    return pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(first, pa.int64())), pa.array(electronic[shown]), trades.take(pa.array(shown, pa.int64()))], ["filing_id", "electronic", "trades"])


def _whole_filings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches of pages, cut where a filing begins."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        begins = np.flatnonzero(batch.column(1).to_numpy() == 1)
        if len(begins) and (held or begins[-1]):
            yield pa.concat_batches([*held, batch.slice(0, begins[-1])])
            held = []
        held.append(batch.slice(begins[-1]) if len(begins) else batch)
    if held:
        yield pa.concat_batches(held)


def read_trades(words: DataFrame) -> DataFrame:
    """``trade_form`` with ``electronic``, whether the filing has the form's header row; a filing with words but no trade has one row without ``row_index``."""
    pages = words if "words" in words.columns else pages_of(words)
    place = F.row_number().over(Window.partitionBy("filing_id").orderBy("page"))  # brings a filing's pages together, in order
    given = pages.select("filing_id", place.alias("place"), F.col("page").cast("int").alias("page"), F.col("words").cast("array<struct<text:string,x0:double,top:double>>").alias("words"))
    kind = words.schema["filing_id"].dataType.simpleString()
    read = given.mapInArrow(lambda batches: map(_read, _whole_filings(batches)), f"filing_id {kind}, electronic boolean, trades array<{RECORD}>")
    g = read.select("filing_id", "electronic", F.posexplode_outer("trades").alias("row_index", "x")).select("filing_id", "electronic", F.col("row_index").cast("long").alias("row_index"), "x.*")
    trade = code_name(F.col("k"), TRADE_CODES)
    kind = suffix_type("a")
    option = F.when(kind == "OP", option_details("t"))
    return g.select(
        "filing_id", "electronic", "row_index", F.when(F.col("row_index").isNotNull(), F.coalesce(code_name(F.col("o"), OWNER_CODES), F.lit("self"))).alias("owner"), F.trim("a").alias("asset_description_raw"), suffix_ticker("a").alias("ticker"), kind.alias("asset_type"),
        option["option_type"].alias("option_type"), option["strike"].alias("strike"), option["expiry"].alias("expiry"),
        F.when((trade == "sale_full") & F.col("p"), "sale_partial").otherwise(trade).alias("tx_type"), form_date("d").alias("tx_date"), form_date("n").alias("notification_date"),
        amount_range("m")["low"].alias("amount_min"), amount_range("m")["high"].alias("amount_max"), F.col("i").alias("source_transaction_id"), unread_date("d", "n").alias("unread_date"),
    )


def trade_form(words: DataFrame) -> DataFrame:
    """One row per trade of every filing: filing_id, row_index, owner, description, ticker, type, option, trade, dates, amounts, id, and a date that is none.

    A line with a trade code in the code column opens a record. After it, lines extend its
    description and amount until a label line; a description label collects option text, other
    labels are skipped. Header lines repeat and are dropped, and so is a page from its footer on.
    """
    return read_trades(words).filter(F.col("row_index").isNotNull()).drop("electronic")


def is_electronic(words: DataFrame) -> DataFrame:
    """(filing_id, electronic): whether the filing has the form's header row."""
    return _lines(words).groupBy("filing_id").agg(has_header(F.col("words")).alias("electronic"))


def has_header(words: Column) -> Column:
    """Whether one of a filing's lines is the header row; an aggregate."""
    return F.max(_header(words).isNotNull())


def _schedule(words: Column) -> Column:
    """The letter of a schedule's heading, null for other lines."""
    first, second = F.get(words, F.lit(0))["text"], F.get(words, F.lit(1))["text"]
    heading = (F.lower(first) == "schedule") | first.rlike("^[Ss]\x00+$")
    return F.when(heading & F.endswith(second, F.lit(":")), F.lower(F.rtrim(second, F.lit(":"))))


def holdings_form(words: DataFrame) -> DataFrame:
    """One row per asset of Schedule A: filing_id, row_index, owner, description, ticker, type, value and its bounds, income."""
    doc = Window.partitionBy("filing_id").orderBy("page", "line").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("filing_id").orderBy("page", "line").rowsBetween(Window.unboundedPreceding, -1)
    w = F.col("words")
    rows = _lines(words).withColumns({"line_text": _text(w), "_heading": _schedule(w)})
    # from the first heading of Schedule A to the next heading of another schedule
    rows = rows.withColumn("_in", F.last("_heading", ignorenulls=True).over(doc))
    rows = rows.withColumn("_a", F.coalesce(F.max((F.col("_heading") == "a").cast("int")).over(before), F.lit(0)))
    rows = rows.withColumn("_ended", F.max(F.coalesce(((F.col("_heading") != "a") & (F.col("_a") == 1)).cast("int"), F.lit(0))).over(doc)).filter("_in = 'a' and _ended = 0 and _heading is null")
    incomes = F.transform(F.filter(w, lambda v: F.lower(v["text"]) == "income"), lambda v: v["x0"])
    head = F.when((F.lower(w[0]["text"]) == "asset") & _x(w, "owner", False).isNotNull() & _x(w, "value", False).isNotNull() & _x(w, "tx.", False).isNotNull() & (F.size(incomes) >= 2),
                  F.struct(*((x - COLUMN_MARGIN).alias(n) for n, x in (("owner", _x(w, "owner", False)), ("value", _x(w, "value", False)), ("kind", F.get(incomes, F.lit(0))), ("income", F.get(incomes, F.lit(1))), ("tx", _x(w, "tx.", False))))))
    rows = rows.withColumn("_head", head).withColumn("c", F.last("_head", ignorenulls=True).over(doc))
    low = F.lower("line_text")
    rows = rows.filter(F.col("_head").isNull() & F.col("c").isNotNull() & ~(low.startswith("type(s)") | low.startswith("http") | F.col("line_text").startswith("*")))
    first = w[0]["text"]
    rows = rows.withColumn("_note", F.contains(first, F.lit("\x00")) | first.rlike(r"(?i)^(description|location|subholding|comments|filing)\b"))
    cut = lambda a, b: _zone(w, F.col(f"c.{a}") if a else None, F.col(f"c.{b}"))
    rows = rows.select("filing_id", "page", "line", "_note", cut("", "owner").alias("asset"), cut("owner", "value").alias("own"), cut("value", "kind").alias("value"), cut("kind", "income").alias("kind"), cut("income", "tx").alias("income"))
    rows = rows.filter("_note or size(asset) + size(own) + size(value) + size(kind) + size(income) > 0")
    v0 = F.lower(F.get("value", F.lit(0)))
    band = v0.isin("none", "undetermined", "over", "spouse/dc") | (v0.rlike(r"^\$[\d,]+$") & (F.get("value", F.lit(1)) == "-"))
    gathered = rows.withColumns({"_band": F.coalesce(band, F.lit(False)), "_code": F.coalesce(F.upper(F.get("own", F.lit(0))).isin(*OWNER_CODES), F.lit(False))})
    docs = gathered.groupBy("filing_id").agg(F.sort_array(F.collect_list(F.struct("page", "line", "_note", "_band", "_code", "own", "asset", "value", "kind", "income"))).alias("lines"))
    # whether a line opens a row depends on the row before it: a fold over the filing's lines
    kind = "struct<row:int,note:boolean,wrapped:boolean,out:array<int>>"

    def step(acc: Column, x: Column) -> Column:
        opens = ~x["_note"] & ((acc["row"] < 0) | (x["_band"] & ~acc["wrapped"]) | (x["_code"] & ~acc["note"]))
        note = x["_note"] | (acc["note"] & ~opens)
        row = acc["row"] + opens.cast("int")
        held = ~note & (F.size(x["value"]) > 0)
        wrapped = F.when(held, F.coalesce(F.endswith(F.element_at(x["value"], -1), F.lit("-")), F.lit(False))).otherwise(acc["wrapped"] & ~opens)
        return F.struct(row.alias("row"), note.alias("note"), wrapped.alias("wrapped"), F.concat(acc["out"], F.array(F.when(note, F.lit(-1)).otherwise(row))).alias("out"))

    start = F.struct(F.lit(-1).alias("row"), F.lit(False).alias("note"), F.lit(False).alias("wrapped"), F.array().alias("out")).cast(kind)
    placed = docs.select("filing_id", F.explode(F.arrays_zip("lines", F.aggregate("lines", start, step)["out"].alias("row"))).alias("z"))
    placed = placed.select("filing_id", F.col("z.row").alias("row_index"), F.col("z.lines").alias("x")).filter("row_index >= 0").select("filing_id", "row_index", "x.*")
    joined = lambda c: F.trim(F.array_join(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("page", "line", c))), lambda x: x[c])), " "))
    owner = F.max_by(F.when(F.col("_code"), F.upper(F.get("own", F.lit(0)))), F.when(F.col("_code"), F.struct("page", "line")))
    g = placed.groupBy("filing_id", "row_index").agg(joined("asset").alias("a"), joined("value").alias("v"), joined("kind").alias("k"), joined("income").alias("n"), owner.alias("o"))
    return g.select(
        "filing_id", "row_index", F.coalesce(code_name(F.col("o"), OWNER_CODES), F.lit("self")).alias("owner"), F.col("a").alias("asset_description_raw"), suffix_ticker("a").alias("ticker"), suffix_type("a").alias("asset_type"),
        F.col("v").alias("value_raw"), amount_range("v")["low"].alias("value_min"), amount_range("v")["high"].alias("value_max"), F.nullif("k", F.lit("")).alias("income_type"), F.nullif("n", F.lit("")).alias("income_raw"),
    )


def report_facts(words: DataFrame) -> DataFrame:
    """(filing_id, report_year, has_schedule_a) of every filing; the year is read from the first page."""
    w = F.col("words")
    rows = _lines(words).withColumns({"_t": F.transform(w, lambda v: F.lower(v["text"])), "_s": _schedule(w)})
    year = F.when((F.col("page") == 0) & (F.get("_t", F.lit(0)) == "filing") & (F.get("_t", F.lit(1)) == "year:") & F.get("_t", F.lit(2)).rlike(r"^\d+$"), F.get("_t", F.lit(2)).try_cast("int"))
    return rows.groupBy("filing_id").agg(F.min_by(year, F.when(year.isNotNull(), F.struct("page", "line"))).alias("report_year"), F.coalesce(F.max(F.col("_s") == "a"), F.lit(False)).alias("has_schedule_a"))
