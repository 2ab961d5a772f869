"""Benchmark decontamination by a generalised suffix automaton over the test items' words.

Texts are normalised to words of digits, letters and characters beyond ASCII, A-Z in lower
case. One automaton holds all substrings of all items. A document's words are streamed
through it, and at each word the length of the longest match that ends there is known: from
``window`` words on, the last ``window`` words occur in an item. An item of fewer words is one
window of its own, found on the chain of suffix links. Words that no item has reset the
match, so only stretches of known words long enough for a window are walked.

Automata are built in tasks, from items dealt to about ``max_words`` words each, written to the
shared folder and broadcast one at a time, so an automaton's size depends on that parameter
alone. A larger benchmark has several automata, which pass over the documents one after another,
their findings added up. An item longer than ``max_words`` is cut into parts that overlap by a
window less a word, so that no window is lost.

Defined results: null and empty texts have no words. Null item ids hit but are not listed;
repeated items, and items whose ids have the same text, count once. Every document row gives one
row, also with null or repeated ids of any type. Empty tables give an empty result, or no hits.
Texts of any length are streamed whole, about two MB of texts at a time. Other columns of either
table are ignored, or come back as they are, whatever their names.
"""

from __future__ import annotations

import gc
import pickle
import re
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .bpe import text_slices
from .shared import as_struct, fields_of, materialize, quoted
from .shingles import word_hashes

_WORD_BYTES = {*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)}
_NOT_WORD = np.asarray([b not in _WORD_BYTES for b in range(256)])
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


class SuffixAutomaton:
    """All substrings of the sequences added to it."""

    def __init__(self):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.next) - 1

    def _target(self, p: int, c: int) -> int:
        """The state for what ``p`` and ``c`` spell, split off if its state also holds longer strings."""
        q = self.next[p][c]
        if self.length[q] == self.length[p] + 1:
            return q
        part = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = part
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = part
            p = self.link[p]
        return part

    def add(self, sequence: list[int]) -> None:
        last = 0
        for c in sequence:
            if c in self.next[last]:
                last = self._target(last, c)
                continue
            new, p = self._state(self.length[last] + 1, 0, {}), last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = self.link[p]
            if p >= 0:
                self.link[new] = self._target(p, c)
            last = new


class ItemMatcher:
    """An automaton of items with what is needed to name the items whose windows occur."""

    def __init__(self, window: int):
        self.window, self.automaton = window, SuffixAutomaton()
        self.vocabulary: dict[int, int] = {}
        self.items: list[tuple[object, list[int]]] = []
        self.words = 0

    def add(self, item_id, hashes: list[int]) -> None:
        words = [self.vocabulary.setdefault(h, len(self.vocabulary)) for h in hashes]
        if words:
            self.items.append((item_id, words))
            self.automaton.add(words)
            self.words += len(words)

    def finish(self) -> ItemMatcher:
        a, window = self.automaton, self.window
        n = len(a.next)
        self.window_state = [-1] * n
        order = sorted(range(n), key=a.length.__getitem__)
        for s in order:
            if a.length[s] >= window:
                self.window_state[s] = s if a.length[a.link[s]] < window else self.window_state[a.link[s]]
        found: dict[int, set[int]] = {}
        self.short: dict[int, list[tuple[int, int]]] = {}
        for k, (_, words) in enumerate(self.items):
            s, length = 0, 0
            for c in words:
                s, length = a.next[s][c], length + 1
                if length >= window:
                    found.setdefault(self.window_state[s], set()).add(k)
            if length < window:
                while a.length[a.link[s]] >= length:
                    s = a.link[s]
                self.short.setdefault(s, []).append((length, k))
        self.items_at = {s: tuple(x) for s, x in found.items()}
        # the nearest state on the chain of suffix links, itself first, that a short item ends in
        self.short_state = [-1] * n
        for s in order:
            self.short_state[s] = s if s in self.short else (self.short_state[a.link[s]] if a.link[s] >= 0 else -1)
        self.least = min([window, *(len(w) for _, w in self.items)])
        hashes = np.fromiter(self.vocabulary.keys(), np.uint64, len(self.vocabulary))
        by = np.argsort(hashes)
        self.hashes, self.word_ids = hashes[by], np.fromiter(self.vocabulary.values(), np.int64, len(by))[by]
        self.ids = [x for x, _ in self.items]
        del self.vocabulary, self.items
        return self

    def known(self, hashes: np.ndarray) -> np.ndarray:
        """The item word of each hash, -1 if there is none."""
        if not len(self.hashes) or not len(hashes):
            return np.full(len(hashes), -1, np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.word_ids[at], -1)

    def walk(self, words: list[int], begin: int, spans: list[list[int]], items: set[int]) -> None:
        """Stream ``words``, the first of which is word ``begin`` of its text; spans are [first, past the last], merged."""
        follow, link, length = self.automaton.next, self.automaton.link, self.automaton.length
        window, s, m = self.window, 0, 0

        def hit(first: int, end: int) -> None:
            while spans and spans[-1][1] >= first:
                first = min(first, spans.pop()[0])
            spans.append([first, end])

        for i, c in enumerate(words, begin + 1):
            while s and c not in follow[s]:
                s = link[s]
                m = length[s]
            if c in follow[s]:
                s = follow[s][c]
                m += 1
            if m >= window:
                hit(i - window, i)
                items.update(self.items_at[self.window_state[s]])
            t = self.short_state[s]
            while t >= 0:
                for n, k in self.short[t]:
                    if n <= m:
                        hit(i - n, i)
                        items.add(k)
                t = self.short_state[link[t]] if link[t] >= 0 else -1


def _matches(texts: pa.Array, matcher: ItemMatcher) -> tuple[list[int], list[list[list[int]]], list[set[int]]]:
    """Of each text the number of words, the spans of hit words and the places of the items that occur."""
    hashes, ends = word_hashes(texts, _NOT_WORD)
    begins = np.concatenate([[0], ends[:-1]])
    words = matcher.known(hashes)
    # stretches of known words within one text
    inside = np.concatenate([[False], words >= 0, [False]])
    stops = np.zeros(len(words) + 1, bool)
    stops[ends] = True
    first = np.flatnonzero(inside[1:-1] & (~inside[:-2] | stops[:-1]))
    last = np.flatnonzero(inside[1:-1] & (~inside[2:] | stops[1:])) + 1
    long = last - first >= matcher.least
    text_of = np.searchsorted(ends, first[long], side="right")
    spans: list[list[list[int]]] = [[] for _ in range(len(texts))]
    items: list[set[int]] = [set() for _ in range(len(texts))]
    for a, b, k in zip(first[long].tolist(), last[long].tolist(), text_of.tolist(), strict=True):
        matcher.walk(words[a:b].tolist(), a - int(begins[k]), spans[k], items[k])
    return (ends - begins).tolist(), spans, items


_SPANS = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))


def _scan(batches, broadcast, text_col: str | None, earlier: bool, max_coverage: float | None):
    """Batches of (text or row, further columns); after an ``earlier`` automaton the last two columns have its findings.

    Appends n_words, spans and items; with ``max_coverage`` instead returns the rows below it without their spans.
    """
    matcher: ItemMatcher = broadcast.value
    for batch in batches:
        column = batch.column(0)
        whole = column if text_col is None else pc.struct_field(column, [column.type.get_field_index(text_col)])
        n_words: list[int] = []
        all_spans: list[list[list[int]]] = []
        all_items: list[list[str]] = []
        for _, texts in text_slices(whole, 2 << 20):
            n, spans, items = _matches(texts, matcher)
            n_words += n
            all_spans += spans
            all_items += [sorted({str(matcher.ids[k]) for k in x if matcher.ids[k] is not None}) for x in items]
        kept = list(batch.columns)
        if earlier:
            before, items_before = kept[-2:]
            kept = kept[:-3]
            for k in np.flatnonzero(np.asarray(pc.list_value_length(before))).tolist():
                all_spans[k] = _merged([[x["first"], x["end"]] for x in before[k].as_py()] + all_spans[k])
                all_items[k] = sorted({*items_before[k].as_py(), *all_items[k]})
        if max_coverage is None:
            found = [pa.array(n_words, pa.int64()), pa.array([[{"first": a, "end": b} for a, b in x] for x in all_spans], _SPANS), pa.array(all_items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*kept, *found], [*batch.schema.names[: len(kept)], "n_words", "spans", "items"])
            continue
        hit = [k for k, x in enumerate(all_spans) if x]
        clean = [without_spans(whole[k].as_py(), all_spans[k]) for k in hit]
        keep = np.ones(len(n_words), bool)
        keep[hit] = [sum(b - a for a, b in all_spans[k]) <= max_coverage * n_words[k] for k in hit]
        if hit:
            change = np.zeros(len(n_words), bool)
            change[hit] = True
            whole = pc.replace_with_mask(whole, pa.array(change), pa.array(clean, whole.type))
        fields = column.type
        column = pa.StructArray.from_arrays([whole if f.name == text_col else pc.struct_field(column, [k]) for k, f in enumerate(fields)], fields=list(fields))
        yield pa.RecordBatch.from_arrays([column], ["row"]).filter(pa.array(keep))
        del whole, column, fields
    gc.collect()
    pa.default_memory_pool().release_unused()


def _merged(spans: list[list[int]]) -> list[list[int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _build(batches, window: int, max_words: int):
    """Pickled matchers of the items of a task, each of at most about ``max_words`` words."""
    current = ItemMatcher(window)
    for batch in batches:
        for item_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            hashes, _ = word_hashes(pa.array([text or ""], pa.large_string()), _NOT_WORD)
            size = max(max_words, window)
            for at in range(0, max(1, len(hashes) - window + 1), size):
                part = hashes[at : at + size + window - 1].tolist()
                if current.words and current.words + len(part) > max_words:
                    yield pa.RecordBatch.from_pydict({"matcher": [pickle.dumps(current.finish())]}, schema=pa.schema([("matcher", pa.binary())]))
                    current = ItemMatcher(window)
                current.add(item_id, part)
    if current.words:
        yield pa.RecordBatch.from_pydict({"matcher": [pickle.dumps(current.finish())]}, schema=pa.schema([("matcher", pa.binary())]))


def matchers(benchmark: DataFrame, window: int, max_words: int, item_col: str = "item_id", text_col: str = "text"):
    """Automata over the items, one after another on the driver, each of at most about ``max_words`` words."""
    items = benchmark.select(F.col(quoted(item_col)).alias("i"), F.col(quoted(text_col)).alias("t"))
    words = F.size(F.split(F.coalesce("t", F.lit("")), r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"))
    tasks = max(1, -(-(items.agg(F.sum(words)).first()[0] or 0) // max_words))
    dealt = items.coalesce(1) if tasks == 1 else items.repartition(tasks, F.xxhash64("i", "t"))
    built = materialize(dealt.mapInArrow(partial(_build, window=window, max_words=max_words), "matcher binary"), "decontamination-automata")
    some = False
    for row in built.toLocalIterator():
        some = True
        yield pickle.loads(row["matcher"])
    if not some:
        yield ItemMatcher(window).finish()


_FOUND = [
    StructField("n_words", LongType()),
    StructField("spans", ArrayType(StructType([StructField("first", LongType()), StructField("end", LongType())]))),
    StructField("items", ArrayType(StringType())),
]


def _passes(rows: DataFrame, benchmark: DataFrame, window: int, max_words: int, item_col: str, text_col: str | None, max_coverage: float | None) -> DataFrame:
    """All automata over ``rows``, one pass each; the last one removes spans if there is a ``max_coverage``."""
    spark = rows.sparkSession
    fields, found, last = rows.schema.fields, rows, None
    automata = matchers(benchmark, window, max_words, item_col)
    matcher = next(automata)
    while matcher is not None:
        following = next(automata, None)
        shared, earlier = spark.sparkContext.broadcast(matcher), last is not None
        final = following is None and max_coverage is not None
        work = partial(_scan, broadcast=shared, text_col=text_col, earlier=earlier, max_coverage=max_coverage if final else None)
        found = found.mapInArrow(work, StructType(fields if final else [*fields, *_FOUND]))
        if following is not None:
            found = materialize(found, "decontamination")
            shared.destroy()
        last, matcher = shared, following
    return found


def contamination(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_words: int = 200_000, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """(id, n_words, spans, items) of every row: hit stretches of words [first, end), and the ids of items with occurring windows."""
    rows = docs.select(F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text"), F.col(quoted(id_col)).alias("id"))
    found = _passes(rows, benchmark, window, max_words, item_col, None, None)
    return found.select(F.col("id").alias(id_col), "n_words", "spans", "items")


def hit_words(spans="spans"):
    """How many words the spans cover."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["first"])


def without_spans(text: str, spans: list[list[int]]) -> str:
    """``text`` without the stretches of words, and with one blank where several then meet."""
    words = [m.span() for m in _WORD.finditer(text)]
    parts, at = [], 0
    for first, end in spans:
        parts.append(text[at : words[first][0]])
        at = words[end - 1][1]
    parts.append(text[at:])
    return re.sub(r"[ \t]{2,}", " ", "".join(parts)).strip()


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, max_words: int = 200_000, text_col: str = "text", item_col: str = "item_id"
) -> DataFrame:
    """The documents with hit spans removed; those of which more than ``max_coverage`` of the words are hit are dropped.

    Documents without a hit come back as they are, with their own columns. Rows pass through
    Python once per automaton, as one struct with one copy of the text.
    """
    rows = docs.select(as_struct(docs.columns, "row"))
    return _passes(rows, benchmark, window, max_words, item_col, text_col, max_coverage).select(*fields_of("row", docs.columns))
