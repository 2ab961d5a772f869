"""Approximate nearest neighbours over balanced posting lists.

*Index.* Centroids are fitted on a bounded sample of the distinct vectors (``SAMPLE`` rows, chosen by
hash) by halving it again and again: each half gets the same number of vectors, those nearer to one
of two means, until a part would make a list of about ``list_size`` vectors; steps of means under a penalty
for full lists then settle the parts. The centroids are searched by a graph in memory: each is tied to its nearest
centroids, both ways, and to a few far ones. A search starts at a few spread centroids, opens the
best unopened ones and everything within the wanted ratio of the best distance, and ends when
nothing is left to open. The graph's size is bounded by ``MOST_LISTS`` and it travels in the
tasks' closure.

*Lists.* Every vector is indexed. It goes to its nearest list, and as a boundary vector also to other
lists whose centroid is at most ``1 + boundary`` times as far, up to ``COPIES`` in all.

*Search.* A query reads every list whose centroid is at most ``1 + reach`` times as far as the nearest,
without a limit on their number. Vectors of a list meet its queries in blocks of at most ``BLOCK``
vectors and ``QUERIES`` queries, so a list of any size takes several tasks. Each block returns the
best few of each query, in double precision.

*Copies.* Equal vectors are one row of the index, with the least ids that can matter: with ``k``
neighbours wanted, ``k + 1``, since one id may be the query's own. Ranking ids within a vector
starts in each task before the shuffle, and queries with equal vectors are searched once. A vector that
a third of all rows have thus costs no more than any other. The rows of equal queries are grouped before they
meet their answer, in groups salted so that none grows with the table.

Vectors of different lengths have no distance: each length has lists of its own.

Defined results: vectors that are null, empty, zero or hold null or non-finite components take no part,
nor do rows without id. Rows that repeat id and vector count once; an id with several vectors is a candidate
by each, and a query with each. Only the query's own row is left out of its answer. Ties go to the
smaller id. An empty table gives no rows. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, FloatType, IntegerType, StructField, StructType

from .shared import integral_id, materialize, quoted

SAMPLE = 65_536
MOST_LISTS = 4_096
COPIES = 3
BLOCK, QUERIES = 20_000, 2_000
#: Rows of equal queries that are kept together, on average, when a vector has very many.
GROUPED = 4_096
#: Vector lengths that get a graph, those with the most rows; others have one list each, cut into blocks like any.
LENGTHS = 64


def matrices(lists: pa.Array):
    """For each length of the list array's members: (their places, matrix of doubles)."""
    lengths = np.asarray(pc.list_value_length(lists))
    for dim in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == dim)
        yield at, np.asarray(lists.take(pa.array(at)).flatten().cast(pa.float64())).reshape(-1, dim)


def squared_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """All squared distances between the rows of two matrices, up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * (a @ b.T), 0)


def halves(x: np.ndarray, rng: np.random.Generator, turns: int = 6) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``x`` in two halves of equal size around two means."""
    means = x[rng.choice(len(x), 2, replace=False)]
    for _ in range(turns):
        lean = x @ (means[0] - means[1])
        order = np.argsort(-lean, kind="stable")
        first, second = order[: len(x) // 2], order[len(x) // 2 :]
        means = np.stack([x[first].mean(axis=0), x[second].mean(axis=0)])
    return first, second


def balanced_centroids(x: np.ndarray, lists: int, seed: int = 7, turns: int = 8, weight: float = 0.1) -> np.ndarray:
    """Means of at least ``lists`` (a power of two above it) groups of ``x`` of about equal size.

    Groups of equal size are settled in ``turns`` steps in which a vector goes to the nearest mean, full groups being held farther away.
    """
    rng = np.random.default_rng(seed)
    groups = [np.arange(len(x))]
    while len(groups) < lists and min(map(len, groups)) >= 4:
        groups = [g[h] for g in groups for h in halves(x[g], rng)]
    means = np.stack([x[g].mean(axis=0) for g in groups])
    usual = len(x) / len(means)
    sizes = np.full(len(means), usual)
    for _ in range(turns):
        own = np.empty(len(x), np.int64)
        for at in range(0, len(x), 4096):
            d = squared_distances(x[at : at + 4096], means)
            own[at : at + 4096] = np.argmin(d + weight * d.min(axis=1).mean() * (sizes / usual - 1), axis=1)
        counts = np.bincount(own, minlength=len(means))
        sizes = (sizes + counts) / 2
        order, met = np.argsort(own, kind="stable"), np.flatnonzero(counts)
        means[met] = np.add.reduceat(x[order], np.searchsorted(own[order], met)) / counts[met, None]
    return means


class CentroidGraph:
    """Centroids of one vector length, searched by walking from neighbour to neighbour."""

    def __init__(self, centroids: np.ndarray, degree: int = 16, far: int = 4, starts: int = 8, seed: int = 7):
        self.centroids = centroids
        n = len(centroids)
        rng = np.random.default_rng(seed)
        near: list[set[int]] = [set() for _ in range(n)]
        for at in range(0, n, 512):
            d = squared_distances(centroids[at : at + 512], centroids)
            for i, row in enumerate(np.argsort(d, axis=1, kind="stable")[:, : degree + 1].tolist(), at):
                for j in [*row, *rng.integers(0, n, far).tolist()]:
                    if i != j:
                        near[i].add(j)
                        near[j].add(i)
        width = max(1, max(map(len, near)))
        self.edges = np.full((n, width), -1, np.int32)
        for i, row in enumerate(near):
            self.edges[i, : len(row)] = sorted(row)
        self.starts = np.unique(np.linspace(0, n - 1, min(n, starts)).astype(np.int64))

    def search(self, x: np.ndarray, ratio: float, beam: int = 8) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, centroid, distance) of all centroids found within ``ratio`` times each row's nearest distance."""
        n, c = len(x), len(self.centroids)
        found = np.full((n, c), np.inf)
        opened = np.zeros((n, c), bool)
        found[:, self.starts] = np.sqrt(squared_distances(x, self.centroids[self.starts]))
        while True:
            best = found.min(axis=1)
            wide = np.partition(found, min(beam, c) - 1, axis=1)[:, min(beam, c) - 1]
            limit = np.where(np.isfinite(wide), np.maximum(wide, best * ratio), np.inf)
            rows, cols = np.nonzero(np.isfinite(found) & ~opened & (found <= limit[:, None]))
            if not len(rows):
                break
            opened[rows, cols] = True
            ends = self.edges[cols]
            starts = np.broadcast_to(rows[:, None], ends.shape)[ends >= 0]
            pairs = np.unique(starts * c + ends[ends >= 0])
            rows, cols = pairs // c, pairs % c
            new = np.isinf(found[rows, cols])
            rows, cols = rows[new], cols[new]
            for at in range(0, len(rows), 65_536):
                r, k = rows[at : at + 65_536], cols[at : at + 65_536]
                found[r, k] = np.sqrt(((x[r] - self.centroids[k]) ** 2).sum(axis=1))
        rows, cols = np.nonzero(found <= found.min(axis=1)[:, None] * ratio)
        return rows, cols, found[rows, cols]


def _nearest_lists(rows: np.ndarray, cols: np.ndarray, distance: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((cols, distance, rows))
    rows, cols = rows[order], cols[order]
    few = np.arange(len(rows)) - np.searchsorted(rows, rows) < most
    return rows[few], cols[few]


def _listed(batches, graphs: dict[int, CentroidGraph], ratio: float, copies: int | None):
    """Rows (key..., v) with the lists of v: boundary copies where ``copies`` is given, else all lists within the ratio."""
    for batch in batches:
        for at in range(0, batch.num_rows, 512):
            part = batch.slice(at, 512)
            lists: list = [None] * part.num_rows
            for places, x in matrices(part.column("v")):
                graph = graphs.get(x.shape[1])
                if graph is None:
                    for p in places.tolist():
                        lists[p] = [0]
                    continue
                rows, cols, distance = graph.search(x, ratio)
                if copies:
                    rows, cols = _nearest_lists(rows, cols, distance, copies)
                for p, own in zip(places.tolist(), np.split(cols, np.searchsorted(rows, np.arange(1, len(x)))), strict=True):
                    lists[p] = own.tolist()
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], [*part.schema.names, "lists"])


def with_lists(rows: DataFrame, graphs: dict[int, CentroidGraph], ratio: float, copies: int | None = None) -> DataFrame:
    return rows.mapInArrow(partial(_listed, graphs=graphs, ratio=ratio, copies=copies), StructType([*rows.schema, StructField("lists", ArrayType(IntegerType()))]))


def _block_answers(table: pa.Table, most: int) -> pa.Table:
    """The ``most`` nearest vectors (query, node, distance) of each query of a block, ties by the vectors' least ids."""
    table = table.combine_chunks()
    asks = np.asarray(table["asks"])
    empty = pa.table({"query": pa.array([], pa.int64()), "node": pa.array([], pa.int64()), "distance": pa.array([], pa.float64()), "least": pa.array([], pa.int64())})
    ours, theirs = table.filter(pa.array(asks)), table.filter(pa.array(~asks))
    if not ours.num_rows or not theirs.num_rows:
        return empty
    theirs = theirs.sort_by("least")
    q, x = (np.asarray(t["v"].combine_chunks().flatten().cast(pa.float64())).reshape(t.num_rows, -1) for t in (ours, theirs))
    query, node, least = np.asarray(ours["node"]), np.asarray(theirs["node"]), np.asarray(theirs["least"])
    squares = (x * x).sum(1)
    out = []
    for at in range(0, len(q), 256):
        part = q[at : at + 256]
        d = squared_distances(part, x)
        if len(x) > most:
            edge = np.partition(d, most - 1, axis=1)[:, most - 1]
        else:
            edge = d.max(axis=1)
        # rounding may order near ties wrongly: all within its reach are measured exactly
        slack = 1e-12 * x.shape[1] * ((part * part).sum(1) + squares.max())
        rows, cols = np.nonzero(d <= (edge + slack)[:, None])
        exact = np.sqrt(((part[rows] - x[cols]) ** 2).sum(axis=1))
        order = np.lexsort((least[cols], exact, rows))
        rows, cols, exact = rows[order], cols[order], exact[order]
        few = np.arange(len(rows)) - np.searchsorted(rows, rows) < most
        out.append(pa.table({"query": query[at + rows[few]], "node": node[cols[few]], "distance": exact[few], "least": least[cols[few]]}))
    return pa.concat_tables(out)


def distinct_vectors(rows: DataFrame, k: int) -> DataFrame:
    """(v, ids) of the distinct vectors of (id, v), with the ``k + 1`` least ids of each."""
    ranked = rows.withColumn("r", F.dense_rank().over(Window.partitionBy("v").orderBy("id"))).filter(F.col("r") <= k + 1)
    return ranked.groupBy("v").agg(F.sort_array(F.collect_set("id")).alias("ids"))


def fit_graphs(nodes: DataFrame, list_size: int) -> dict[int, CentroidGraph]:
    """A graph for each vector length with enough rows in ``nodes`` (v) for several lists, fitted on about ``SAMPLE`` rows at most."""
    counts = nodes.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("n")).filter(F.col("n") > 2 * list_size)
    lists = {r.dim: min(MOST_LISTS, -(-r.n // list_size)) for r in counts.orderBy(F.desc("n"), "dim").limit(LENGTHS).collect()}
    if not lists:
        return {}
    share = SAMPLE / nodes.count()
    chosen = nodes if share >= 1 else nodes.filter(F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    sample = chosen.filter(F.size("v").isin(list(lists))).select("v").orderBy(F.xxhash64("v"), "v").limit(SAMPLE + SAMPLE // 8).toArrow()
    groups = matrices(sample["v"].combine_chunks())
    return {x.shape[1]: CentroidGraph(balanced_centroids(x, lists[x.shape[1]])) for _, x in groups if len(x) >= 16}


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v) of the rows with an id and a vector that has a direction."""
    rows = df.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(vector_col)).alias("v"))
    if not isinstance(rows.schema["v"].dataType.elementType, (FloatType, DoubleType)):
        rows = rows.withColumn("v", F.col("v").cast("array<double>"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))


def nearest_neighbours(
    vectors: DataFrame, queries: DataFrame, k: int = 10, list_size: int = 256, boundary: float = 0.03, reach: float = 0.175, id_col: str = "vec_id", vector_col: str = "embedding"
) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest found rows of ``vectors`` for every row of ``queries``, nearest first."""
    for df in (vectors, queries):
        integral_id(df, id_col, "nearest neighbours")
    base = distinct_vectors(_usable(vectors, id_col, vector_col), k)
    nodes = materialize(base.select(F.monotonically_increasing_id().alias("node"), "ids", F.col("ids")[0].alias("least"), "v"), "neighbours-nodes")
    asked = materialize(_usable(queries, id_col, vector_col).distinct(), "neighbours-asked")
    # the ids of equal queries, in groups that stay small however many there are
    salts = max(1, -(-asked.count() // GROUPED))
    askers = materialize(asked.groupBy("v", F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")).agg(F.collect_list("id").alias("askers")), "neighbours-askers")
    wanted = materialize(askers.select("v").distinct().select(F.monotonically_increasing_id().alias("node"), "v"), "neighbours-queries")

    graphs = fit_graphs(nodes, list_size)
    lists = materialize(with_lists(nodes.select("node", "least", "v"), graphs, 1 + boundary, COPIES), "neighbours-lists")
    asks = materialize(with_lists(wanted, graphs, 1 + reach), "neighbours-asks")
    near = materialize(search_lists(lists, asks, k + 1), "neighbours-near")

    # the least k + 1 ids of each query: one of them may be its own
    named = near.join(nodes.select("node", "ids"), "node").select("query", F.explode(F.transform("ids", lambda i: F.struct(F.col("distance").alias("score"), i.alias("id")))).alias("x"))
    found = named.groupBy(F.col("query").alias("node")).agg(F.slice(F.array_sort(F.collect_list("x")), 1, k + 1).alias("found"))
    answers = askers.join(wanted.join(found, "node"), "v").select(F.explode("askers").alias("query_id"), "found")
    others = F.filter("found", lambda x: (x["id"] != F.col("query_id")) | (x["score"] > 0))
    ranked = answers.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("place", "x"))
    return ranked.select("query_id", (F.col("place") + 1).cast("int").alias("rank"), F.col("x.id").alias(id_col), F.col("x.score").alias("score"))


def search_lists(lists: DataFrame, asks: DataFrame, most: int) -> DataFrame:
    """(query, node, distance): the ``most`` nearest vectors of each query in its lists.

    ``lists`` has (node, least, v, lists) and ``asks`` (node, v, lists). Every list is cut into blocks of
    vectors and blocks of queries; a pair of such blocks is a group.
    """
    held = lists.select("node", "least", "v", F.size("v").alias("dim"), F.explode("lists").alias("list"))
    read = asks.select("node", "v", F.size("v").alias("dim"), F.explode("lists").alias("list"))
    keys = ["dim", "list"]
    parts = held.groupBy(keys).agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"))
    turns = read.groupBy(keys).agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("turns"))
    # a row per list, at most MOST_LISTS for each vector length
    cuts = materialize(parts.join(turns, keys), "neighbours-blocks")
    part, turn = (F.pmod(F.xxhash64("node"), F.col(c)).cast("int") for c in ("parts", "turns"))
    every = {c: F.explode(F.sequence(F.lit(0), F.col(c) - 1)) for c in ("parts", "turns")}
    left = held.join(cuts, keys).select(*keys, part.alias("part"), every["turns"].alias("turn"), F.lit(False).alias("asks"), "node", "least", "v")
    right = read.join(cuts, keys).select(*keys, every["parts"].alias("part"), turn.alias("turn"), F.lit(True).alias("asks"), "node", F.lit(None).cast("long").alias("least"), "v")

    def work(table: pa.Table) -> pa.Table:
        return _block_answers(table, most)

    near = left.unionByName(right).groupBy(*keys, "part", "turn").applyInArrow(work, "query long, node long, distance double, least long")
    near = near.dropDuplicates(["query", "node"])
    best = Window.partitionBy("query").orderBy("distance", "least", "node")
    return near.withColumn("r", F.row_number().over(best)).filter(F.col("r") <= most).select("query", "node", "distance")
