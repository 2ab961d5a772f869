"""Packing documents into sequences by an order-preserving dynamic programme.

Documents stay in order; a window may end at a document's end, at a sentence's end, or, in a
stretch without any for more than a window, at a forced cut. The programme chooses the cuts
that minimise padding plus penalties for documents that are cut (truncated there and carried
on in the next sequence):

    cost[i] = penalty[i] + min over j of cost[j] + window_cost + pad(S[i] - S[j]),  S[i] - S[j] <= W

with S the ids before a boundary, and pad(n) = W - n, or 0 where n is a power of two. The
first kind of transition is the minimum of cost[j] + S[j] over a sliding window, held in a
monotone queue; those of a power of two are looked up. Each boundary costs constant time.

A task packs its rows in the order of their ids, in blocks of about ``block`` ids; a block's
last sequence is carried into the next block, so memory is bounded and only a task's end can
leave a short sequence. No shuffle is needed.

Defined results: a null or empty text is the end id alone. Rows may repeat and ids may be
null (these come first) and of any type; each row is a document of its own. An empty table
gives no pieces. A text of any length is packed whole, over as many sequences as it takes; in
memory are one batch of rows and one block. Other input columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from .bpe import PieceEncoder, text_slices
from .shared import quoted

SENTENCE_PENALTY, FORCED_PENALTY, WINDOW_COST = 8, 64, 4


def choose_cuts(ends: np.ndarray, penalties: np.ndarray, window: int, window_cost: int = WINDOW_COST) -> list[int]:
    """Places among ``ends`` (ascending ids up to each boundary, gaps at most ``window``) at which sequences end; the last is always one."""
    S = np.concatenate([[0], ends]).astype(np.int64)
    n = len(S)
    hops: list[tuple[np.ndarray, np.ndarray]] = []
    power = 1
    while power <= window:
        j = np.searchsorted(S, S - power)
        i = np.flatnonzero((S >= power) & (S[np.minimum(j, n - 1)] == S - power))
        hops.append((i, j[i]))
        power *= 2
    at, source = np.concatenate([x for x, _ in hops]), np.concatenate([y for _, y in hops])
    order = np.argsort(at, kind="stable")
    hop_at, hop_from = [*at[order].tolist(), n], source[order].tolist()
    s, fixed = S.tolist(), [0, *(penalties + window_cost).tolist()]
    cost, back, key = [0] * n, [0] * n, [0] * n
    # the queue as a list, of which ``head`` tells what has left the window
    queue, head, end = [0], 0, 0
    hop, next_hop = 0, hop_at[0]
    for i in range(1, n):
        here = s[i]
        low = here - window
        while s[queue[head]] < low:
            head += 1
        j = queue[head]
        best = key[j] - low
        while next_hop == i:
            k = hop_from[hop]
            hop += 1
            next_hop = hop_at[hop]
            if cost[k] < best:
                best, j = cost[k], k
        cost[i] = c = best + fixed[i]
        back[i] = j
        key[i] = c = c + here
        while end >= head and key[queue[end]] >= c:
            del queue[end]
            end -= 1
        queue.append(i)
        end += 1
        if head > 4096:
            del queue[:head]
            end -= head
            head = 0
    cuts, i = [], n - 1
    while i:
        cuts.append(i - 1)
        i = back[i]
    return cuts[::-1]


def boundaries(ids: np.ndarray, doc_ends: np.ndarray, sentence_end: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Where sequences may end within a block of ids, and what each such cut costs."""
    marks = np.flatnonzero(sentence_end[ids]) + 1
    all_ends = np.union1d(marks, doc_ends)
    gaps = np.diff(np.concatenate([[0], all_ends]))
    wide = np.flatnonzero(gaps > window)
    forced = [np.arange(all_ends[k] - gaps[k] + window, all_ends[k], window) for k in wide]
    ends = np.union1d(all_ends, np.concatenate(forced)) if forced else all_ends
    penalties = np.full(len(ends), FORCED_PENALTY, np.int64)
    penalties[np.searchsorted(ends, marks)] = SENTENCE_PENALTY
    penalties[np.searchsorted(ends, doc_ends)] = 0
    return ends.astype(np.int64), penalties


def sentence_table(library, end_id: int) -> np.ndarray:
    """For every token id, whether its text ends a sentence."""
    table = np.zeros(max(library.get_vocab_size(), end_id + 1), bool)
    for token, i in library.get_vocab().items():
        table[i] = token[-1:] in {".", "!", "?", "Ċ"}
    table[end_id] = False
    return table


class _Block:
    """Documents' ids that wait for their cuts."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.docs: list[tuple] = []  # (id, ids of the document, its ids before this block)
        self.size = 0

    def add(self, doc_id, ids: np.ndarray, total: int, before: int) -> None:
        self.parts.append(ids)
        self.docs.append((doc_id, total, before))
        self.size += len(ids)


def _pack(block: _Block, sentence_end: np.ndarray, window: int, last: bool, sequence: int):
    """Pieces of all sequences but, unless ``last``, the last one; the block that is left; the next sequence's number."""
    ids = np.concatenate(block.parts)
    ends_of = np.cumsum([len(x) for x in block.parts])
    ends, penalties = boundaries(ids, ends_of, sentence_end, window)
    stops = [int(ends[k]) for k in choose_cuts(ends, penalties, window)]
    if not last:
        stops.pop()
    rows, begin, doc = [], 0, 0
    for stop in stops:
        at = begin
        length = stop - begin
        padding = 0 if length & (length - 1) == 0 else window - length
        while at < stop:
            if at >= ends_of[doc]:
                doc += 1
                continue
            to = min(stop, int(ends_of[doc]))
            doc_id, total, before = block.docs[doc]
            start = before + at - (int(ends_of[doc - 1]) if doc else 0)
            rows.append((doc_id, start, to - at, total, sequence, at - begin, length, padding, ids[at:to].astype("<u4").tobytes()))
            at = to
        sequence += 1
        begin = stop
    rest = _Block()
    for k, part in enumerate(block.parts):
        first = int(ends_of[k]) - len(part)
        if ends_of[k] > begin:
            skip = max(0, begin - first)
            doc_id, total, before = block.docs[k]
            rest.add(doc_id, part[skip:].copy(), total, before + skip)
    return rows, rest, sequence


def _pack_rows(batches, tokenizer_path: str, end_id: int, window: int, block: int, schema: pa.Schema):
    from pyspark import TaskContext

    encoder = PieceEncoder.of_worker(tokenizer_path)
    sentence_end = sentence_table(encoder.library, end_id)
    sequence, waiting = TaskContext.get().partitionId() << 36, _Block()

    def out(rows):
        return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    for batch in batches:
        names = batch.column(0).to_pylist()
        for at, texts in text_slices(batch.column(1), 4 << 20):
            flat, ends = encoder.encode_slice(texts)
            for k, part in enumerate(np.split(flat, ends[:-1])):
                waiting.add(names[at + k], np.append(part, end_id).astype(np.int32), len(part) + 1, 0)
                if waiting.size >= block:
                    rows, waiting, sequence = _pack(waiting, sentence_end, window, False, sequence)
                    if rows:
                        yield out(rows)
    if waiting.size:
        yield out(_pack(waiting, sentence_end, window, True, sequence)[0])
    encoder.release()


def pack_documents(
    docs: DataFrame, tokenizer_path: str, window: int = 2048, end_id: int = 1, block: int = 1 << 18, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per piece of a document in a sequence.

    Columns: id, start (ids of the document before the piece), length, doc_tokens, sequence_id,
    offset (ids of the sequence before the piece), sequence_tokens, padding (of the sequence),
    ids (little-endian unsigned 32-bit integers).
    """
    rows = docs.select(F.col(quoted(id_col)).alias("i"), F.col(quoted(text_col)).alias("t")).sortWithinPartitions(F.col("i").asc_nulls_first(), "t")
    longs = "start", "length", "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padding"
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), *(StructField(x, LongType()) for x in longs), StructField("ids", BinaryType())])
    work = partial(_pack_rows, tokenizer_path=tokenizer_path, end_id=end_id, window=window, block=max(block, 2 * window), schema=to_arrow_schema(schema))
    return rows.mapInArrow(work, schema)
