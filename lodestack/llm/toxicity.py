"""Toxicity scores by a factorization machine over hashed terms.

A text's terms are its words (A-Z in lower case) and their first four, five and six bytes,
hashed to buckets; a term counts once however often it occurs. The score is

    sigmoid(w0 + sum w_i + sum over pairs i < j of <v_i, v_j>)

so that terms harmless alone may count together, such as an insult and the mention of a group,
which a sum of weights misses. The sum over pairs takes time in proportion to the terms.

The machine is fitted on at most ``max_rows`` labelled rows, chosen by the hash of their id
(a documented bound of the documents themselves, however often an id repeats; every text is
scored). Buckets are selected by their chi-squared
statistic over these rows, counted in Spark, at most ``max_terms`` of them; to these come such of the
``pair_terms`` most frequent others as are toxic in pairs, though not by themselves. The rows' selected
terms then come to the driver, where the weights are fitted by Adam. The model's size depends
on parameters only.

Defined results: a null or empty text gets the score of a text without terms. Repeated labels
of an id count as toxic if one does; null labels are left out. Without labels every score is
0.5; with labels of one kind it is near that kind. Rows may repeat and ids may be null. An id
that more than ``max_rows`` rows share is not learned from. An empty table of documents gives no
rows and a model without terms. Texts of any length are scored whole, a few MB at a time. Other
input columns are ignored, or come back as they are, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .bpe import text_slices
from .decontamination import _NOT_WORD
from .shared import as_struct, fields_of, materialize, quoted
from .shingles import prefix_hashes

PREFIXES = (4, 5, 6)


def term_buckets(texts: pa.Array, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of every word and word beginning."""
    hashes, ends = prefix_hashes(texts, PREFIXES, _NOT_WORD)
    text = np.repeat(np.arange(len(texts)), np.diff(np.concatenate([[0], ends])))
    return np.tile(text, len(hashes)), (np.concatenate(hashes) >> np.uint64(64 - bits)).astype(np.int64)


@dataclass
class FactorizationMachine:
    """``slot`` maps a bucket to its place among the weights, or to -1."""

    bits: int
    slot: np.ndarray
    w0: float
    w: np.ndarray
    v: np.ndarray

    def terms(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (text, place) of the terms with weights, texts ascending."""
        text, bucket = term_buckets(texts, self.bits)
        place = self.slot[bucket]
        known = place >= 0
        pairs = np.unique(text[known] * max(1, len(self.w)) + place[known])
        return pairs // max(1, len(self.w)), pairs % max(1, len(self.w))

    def logits(self, n: int, text: np.ndarray, place: np.ndarray) -> np.ndarray:
        out = np.full(n, self.w0)
        if len(text):
            first = np.flatnonzero(np.concatenate([[True], text[1:] != text[:-1]]))
            v = self.v[place]
            pairs = 0.5 * (np.add.reduceat(v, first) ** 2 - np.add.reduceat(v * v, first)).sum(1)
            out[text[first]] += np.add.reduceat(self.w[place], first) + pairs
        return out

    def scores(self, texts: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(len(texts), *self.terms(texts)), -40, 40)))


def _count_terms(batches, bits: int):
    seen, toxic = np.zeros(1 << bits, np.int64), np.zeros(1 << bits, np.int64)
    for batch in batches:
        labels = np.asarray(batch.column(1))
        for at, texts in text_slices(batch.column(0)):
            text, bucket = term_buckets(texts, bits)
            pairs = np.unique((text << bits) + bucket)
            text, bucket = pairs >> bits, pairs & ((1 << bits) - 1)
            seen += np.bincount(bucket, minlength=1 << bits)
            toxic += np.bincount(bucket[labels[at + text] == 1], minlength=1 << bits)
    some = np.flatnonzero(seen)
    for k in range(0, len(some), 50_000):
        part = some[k : k + 50_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(seen[part]), pa.array(toxic[part])], ["bucket", "seen", "toxic"])


def _selected_terms(batches, model: FactorizationMachine):
    for batch in batches:
        for at, texts in text_slices(batch.column(0)):
            text, place = model.terms(texts)
            ends = np.searchsorted(text, np.arange(len(texts) + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column(1).slice(at, len(texts)), pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32)))], ["label", "places"])


def gradients(model: FactorizationMachine, y: np.ndarray, text: np.ndarray, place: np.ndarray, decay: float) -> tuple[float, np.ndarray, np.ndarray]:
    """Of the mean log loss of texts with labels ``y`` and terms (text, place), plus ``decay`` / 2 times the squares of all weights."""
    g = (1 / (1 + np.exp(-np.clip(model.logits(len(y), text, place), -40, 40))) - y) / len(y)
    v = model.v[place]
    sums = np.stack([np.bincount(text, v[:, f], len(y)) for f in range(v.shape[1])], 1)
    pull = g[text][:, None] * (sums[text] - v)
    gv = decay * model.v + np.stack([np.bincount(place, pull[:, f], len(model.w)) for f in range(v.shape[1])], 1)
    return float(g.sum()), np.bincount(place, g[text], len(model.w)) + decay * model.w, gv


def _fit(model: FactorizationMachine, rows: list[tuple[int, np.ndarray]], factors: int, epochs: int, seed: int, decay: float = 1e-4, rate: float = 0.05, size: int = 256) -> None:
    """Adam over batches of ``size`` rows."""
    rng = np.random.default_rng(seed)
    model.v = rng.normal(0, 0.01, (len(model.w), factors))
    bias = np.asarray([model.w0])
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in (bias, model.w, model.v)]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(rows), size):
            part = [rows[i] for i in order[k : k + size]]
            text, place = np.repeat(np.arange(len(part)), [len(p) for _, p in part]), np.concatenate([p for _, p in part])
            g0, gw, gv = gradients(model, np.asarray([label for label, _ in part], float), text, place, decay)
            t += 1
            for x, grad, (m, s) in zip((bias, model.w, model.v), (np.asarray([g0]), gw, gv), moments, strict=True):
                m += 0.1 * (grad - m)
                s += 0.001 * (grad * grad - s)
                x -= rate * (m / (1 - 0.9**t)) / (np.sqrt(s / (1 - 0.999**t)) + 1e-8)
            model.w0 = float(bias[0])


def train_toxicity(
    docs: DataFrame, labels: DataFrame, bits: int = 18, max_terms: int = 4096, pair_terms: int = 1024, max_rows: int = 20_000, factors: int = 4, epochs: int = 8, seed: int = 7,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
) -> FactorizationMachine:
    """Fit a machine on at most ``max_rows`` labelled documents."""
    model = FactorizationMachine(bits, np.full(1 << bits, -1, np.int64), 0.0, np.zeros(0), np.zeros((0, factors)))
    known = labels.filter(F.col(quoted(id_col)).isNotNull() & F.col(quoted(label_col)).isNotNull()).groupBy(F.col(quoted(id_col)).alias("i")).agg(F.max(F.col(quoted(label_col)).cast("int")).alias("y"))
    texts = docs.select(F.col(quoted(id_col)).alias("i"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("t"))
    there = known.join(texts.groupBy("i").agg(F.count("*").alias("n")), "i").filter(F.col("n") <= max_rows)
    first = there.orderBy(F.xxhash64("i"), "i").limit(max_rows).toArrow()
    first = first.filter(pc.less_equal(pc.cumulative_sum(first["n"]), max_rows))
    chosen = docs.sparkSession.createDataFrame(first, there.schema)
    # at most ``max_rows`` texts, read from all documents once
    rows = materialize(texts.join(F.broadcast(chosen), "i").select("t", "y"), "toxicity-rows")
    counts = rows.mapInArrow(partial(_count_terms, bits=bits), "bucket long, seen long, toxic long").groupBy("bucket").agg(F.sum("seen").alias("n"), F.sum("toxic").alias("k"))
    total = pc.sum(first["n"]).as_py() or 0
    positive = pc.sum(first.filter(pc.equal(first["y"], 1))["n"]).as_py() or 0
    model.w0 = float(np.log((positive + 1) / (total - positive + 1)))
    if not 0 < positive < total:
        return model
    share = positive / total
    chi = (F.col("k") - F.col("n") * share) ** 2 / (F.col("n") * share * (1 - share) * (1 - F.col("n") / (total + 1)) + 1e-9)
    ranked = materialize(counts.filter("n >= 3").select("bucket", "n", chi.alias("chi")), "toxicity-terms")
    strong = [x["bucket"] for x in ranked.filter("chi > 16").orderBy(F.desc("chi"), "bucket").limit(max_terms).collect()]
    weak = [x["bucket"] for x in ranked.filter("chi <= 16").orderBy(F.desc("n"), "bucket").limit(pair_terms).collect()]
    buckets = np.asarray(strong + weak, np.int64)
    if not len(buckets):
        return model
    model.slot[buckets] = np.arange(len(buckets))
    model.w = np.zeros(len(buckets))
    table = rows.mapInArrow(partial(_selected_terms, model=model), "label int, places array<int>").toArrow().combine_chunks()
    label, places = np.asarray(table["label"].combine_chunks()), table["places"].combine_chunks()
    parts = np.split(np.asarray(places.flatten()), np.cumsum(np.asarray(places.value_lengths()))[:-1])
    # rows arrive in any order; the fit takes them in one
    data = [(int(label[i]), parts[i]) for i in sorted(range(len(label)), key=lambda i: (label[i], parts[i].tobytes()))]
    kept = np.concatenate([np.arange(len(strong)), len(strong) + paired_terms([(y, p[p >= len(strong)] - len(strong)) for y, p in data], len(weak))])
    place = np.full(len(buckets), -1)
    place[kept] = np.arange(len(kept))
    model.slot[buckets] = place
    model.w = np.zeros(len(kept))
    model.v = np.zeros((len(kept), factors))
    if len(kept):
        _fit(model, [(y, place[p][place[p] >= 0]) for y, p in data], factors, epochs, seed)
    return model


def paired_terms(rows: list[tuple[int, np.ndarray]], terms: int, least: float = 30.0) -> np.ndarray:
    """The terms (of 0 up to ``terms``) that are toxic beside another one far more often than either is alone.

    ``least`` is the chi-squared statistic of a pair's toxic rows against the larger of its terms' shares.
    """
    if not terms:
        return np.zeros(0, np.int64)
    both, toxic = np.zeros((terms, terms), np.float32), np.zeros((terms, terms), np.float32)
    for at in range(0, len(rows), 1000):
        part = rows[at : at + 1000]
        x = np.zeros((len(part), terms), np.float32)
        for k, (_, p) in enumerate(part):
            x[k, p] = 1
        both += x.T @ x
        bad = x[[k for k, (y, _) in enumerate(part) if y == 1]]
        toxic += bad.T @ bad
    own = (np.diag(toxic) + 1) / (np.diag(both) + 2)
    share = np.maximum(own[:, None], own[None, :])
    chi = np.where((both >= 5) & (toxic > both * share), (toxic - both * share) ** 2 / np.maximum(both * share * (1 - share), 1e-9), 0)
    np.fill_diagonal(chi, 0)
    return np.flatnonzero((chi > least).any(1))


def _score(batches, broadcast, id_col: str):
    model = broadcast.value
    for batch in batches:
        out = np.zeros(batch.num_rows)
        for at, texts in text_slices(batch.column(1), 2 << 20):
            out[at : at + len(texts)] = model.scores(texts)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out)], [id_col, "score"])


def _keep_below(batches, broadcast, text_at: int, threshold: float):
    model = broadcast.value
    for batch in batches:
        keep = np.zeros(batch.num_rows, bool)
        for at, texts in text_slices(pc.struct_field(batch.column(0), [text_at]), 2 << 20):
            keep[at : at + len(texts)] = model.scores(texts) < threshold
        yield batch.filter(pa.array(keep))


def toxicity_scores(docs: DataFrame, model: FactorizationMachine, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, score) of every row."""
    work = partial(_score, broadcast=docs.sparkSession.sparkContext.broadcast(model), id_col=id_col)
    schema = StructType([StructField(id_col, docs.schema[id_col].dataType), StructField("score", DoubleType())])
    return docs.select(F.col(quoted(id_col)), F.col(quoted(text_col))).mapInArrow(work, schema)


def drop_toxic(docs: DataFrame, model: FactorizationMachine, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows that score below ``threshold``, with their own columns."""
    work = partial(_keep_below, broadcast=docs.sparkSession.sparkContext.broadcast(model), text_at=docs.columns.index(text_col), threshold=threshold)
    rows = docs.select(as_struct(docs.columns, "row"))
    return rows.mapInArrow(work, rows.schema).select(*fields_of("row", docs.columns))


def held_out(id_col: str = "doc_id"):
    """Whether a row's label is kept from training: crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(F.col(quoted(id_col)).cast("string").cast("binary")) % 5 == 0, F.lit(False))
