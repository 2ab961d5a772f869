"""MinHash near-duplicates with tensored banding.

Instead of ``tables`` independent bands, two collections of ``side`` bands of ``rows``
minhashes each are drawn; a table's key joins one band of either collection. ``side ** 2``
tables thus cost ``2 * side * rows`` minhashes, the square root of what independent tables
need. With 20 bands of 4 a pair of similarity s shares a table with probability
(1 - (1 - s**4)**20)**2: 0.999 at 0.75 and 0.9999 at 0.8.

1. Texts with equal shingle sets become one node, counted before they are shuffled.
2. A band value that no second node has cannot be part of a shared table, so only shared
   values of both collections are paired into table keys.
3. Every node is compared with the most popular node that it shares a table with, which for a
   group of copies is near their original: a row per node, however large the tables. Links
   are confirmed on full shingle sets of the texts. An original that very many nodes are compared
   with is dealt to several tasks.
4. Where nodes that share a table are still apart, the nodes of such tables meet in full: the
   groups that these tables connect form a family, which is dealt to blocks of about
   ``BLOCK_SHINGLES`` shingles, and each pair of blocks is compared exactly by an inverted index
   over its shingles. A task holds two blocks and returns a spanning set of links, never all
   pairs. Of a family of more than one block only nodes take part that can have a link to
   another group at all: at least the threshold's share of their shingles must occur in another
   group of the family. This is counted per shingle, in rows that grow with the texts and not
   with their pairs, and leaves out texts that share no more than boilerplate.

A group that step 3 has joined needs no further rows, so copies cost rows in proportion to
their number; step 4 costs a row per block for each node that is left in an open family.
Components come from alternating stars. Nothing but counts reaches the driver.

Defined results: null and empty texts have no shingles, link with nothing and are kept. A row
without id links with nothing: its component is null and it is kept. Ids may be of any type that
has an order. Rows with equal ids and texts give equal rows; of equal ids with several texts each
row has the component of its own text, and filtering keeps a row for each. An empty table gives
an empty result. Texts of any length are compared whole; memory grows with the longest text and
its shingles. Other input columns are ignored, or come back as they are, whatever their names.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from .bpe import text_slices
from .components import connected_components
from .shared import as_struct, fields_of, materialize, quoted
from .shingles import coefficients, mixed, shingle_sets

SIDE, ROWS = 20, 4
BLOCK_SHINGLES = 600_000
FOLLOWERS = 256


def minhashes(sets: list[np.ndarray], count: int) -> np.ndarray:
    """``count`` minhashes (32 bits) of every set; all must have members."""
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *(len(s) for s in sets[:-1])])
    c = coefficients(2 * count, 37)
    out = np.empty((count, len(sets)), np.uint32)
    with np.errstate(over="ignore"):
        for k in range(count):
            out[k] = np.minimum.reduceat(x * np.uint32(c[2 * k] >> np.uint64(32) | np.uint64(1)) + np.uint32(c[2 * k + 1] >> np.uint64(32)), starts)
    return out


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _signatures(batches, width: int, side: int, rows: int):
    count = 2 * side * rows
    salt = coefficients(count + 2 * side, 41)
    for batch in batches:
        for at, texts in text_slices(batch.column(1), 1 << 20):
            sets = shingle_sets(texts, width)
            n = np.asarray([len(s) for s in sets], np.int64)
            full = np.flatnonzero(n)
            node = np.zeros(len(sets), np.uint64)
            bands = np.zeros((len(sets), 2 * side), np.uint64)
            if len(full):
                some = [sets[i] for i in full]
                with np.errstate(over="ignore"):
                    total = np.add.reduceat(mixed(np.concatenate(some) ^ salt[0]), np.cumsum([0, *(len(s) for s in some[:-1])]))
                    node[full] = mixed(total + n[full].astype(np.uint64) * salt[1])
                    mins = minhashes(some, count).astype(np.uint64)
                    parts = mixed(mins + salt[:count, None])
                    for k in range(2 * side):
                        bands[full, k] = mixed(np.sum(parts[k * rows : (k + 1) * rows] * salt[count - rows : count, None], axis=0, dtype=np.uint64) ^ salt[count + k])
            flat = pa.array(_signed(bands).reshape(-1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(at, len(texts)), pa.array(n), pa.array(_signed(node)), pa.ListArray.from_arrays(np.arange(len(sets) + 1, dtype=np.int32) * 2 * side, flat)],
                ["id", "n_shingles", "node", "bands"],
            )


def shingle_signatures(docs: DataFrame, width: int = 5, side: int = SIDE, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, node, bands) of every row; ``node`` is the hash of the whole set."""
    schema = StructType([StructField("id", docs.schema[id_col].dataType), StructField("n_shingles", LongType()), StructField("node", LongType()), StructField("bands", ArrayType(LongType()))])
    return docs.select(F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("t")).mapInArrow(partial(_signatures, width=width, side=side, rows=rows), schema)


def shared_tables(nodes: DataFrame, side: int = SIDE) -> DataFrame:
    """(key, node, popular) for all tensored tables whose bands other nodes have; ``popular`` adds up how many have them."""
    bands = nodes.select("node", F.posexplode("bands").alias("place", "value"))
    shared = bands.groupBy("value").agg(F.count("*").alias("n")).filter("n > 1")
    sides = bands.join(shared, "value").groupBy("node").agg(
        F.collect_list(F.when(F.col("place") < side, F.col("value"))).alias("left"),
        F.collect_list(F.when(F.col("place") >= side, F.col("value"))).alias("right"),
        F.sum("n").alias("popular"),
    )
    sides = materialize(sides, "near-dup-bands")
    rows = sides.select("node", "popular", F.explode("left").alias("l"), "right").select("node", "popular", "l", F.explode("right").alias("r"))
    return rows.select(F.xxhash64("l", "r").alias("key"), "node", "popular")


def _confirmed(batches, width: int, percent: int):
    for batch in batches:
        a, b = (np.asarray(batch.column(k)) for k in (0, 1))
        texts_a, texts_b = batch.column(2), batch.column(3)
        keep = np.zeros(len(a), bool)
        new = np.concatenate([[True], a[1:] != a[:-1]]) if len(a) else np.zeros(0, bool)
        run = np.cumsum(new) - 1
        left: list[np.ndarray] = []
        for _, part in text_slices(texts_a.filter(pa.array(new)), 1 << 20):
            left += shingle_sets(part, width)
        for at, part in text_slices(texts_b, 1 << 20):
            for k, y in enumerate(shingle_sets(part, width), at):
                x = left[run[k]]
                if min(len(x), len(y)) * 100 < percent * max(len(x), len(y)):
                    continue
                where = np.searchsorted(x, y)
                both = int(np.count_nonzero(x[np.minimum(where, len(x) - 1)] == y))
                keep[k] = 100 * both >= percent * (len(x) + len(y) - both)
        at = pa.array(keep)
        yield pa.RecordBatch.from_arrays([batch.column(0).filter(at), batch.column(1).filter(at)], ["a", "b"])


def confirm_links(pairs: DataFrame, texts: DataFrame, width: int = 5, percent: int = 75) -> DataFrame:
    """The pairs (a, b) of nodes whose texts' full sets have a similarity of ``percent`` or more.

    A node ``a`` with more than ``FOLLOWERS`` partners is dealt to as many tasks as that takes.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("tasks"))
    left = texts.select(F.col("node").alias("a"), F.col("t").alias("ta")).join(counts, "a").select("a", "ta", F.explode(F.sequence(F.lit(0), F.col("tasks") - 1)).alias("task"))
    right = pairs.join(texts.select(F.col("node").alias("b"), F.col("t").alias("tb")), "b").join(counts, "a").select("a", "b", "tb", F.pmod(F.xxhash64("b"), F.col("tasks")).cast("int").alias("task"))
    both = right.join(left, ["a", "task"])
    return both.select("a", "b", "ta", "tb").sortWithinPartitions("a").mapInArrow(partial(_confirmed, width=width, percent=percent), "a long, b long")


def _block_links(table: pa.Table, width: int, percent: int) -> pa.Table:
    """Links between texts of two blocks (or of one) that are in different groups so far, enough to join all that belong together."""
    table = table.combine_chunks().sort_by("node")
    node, root, block = (np.asarray(table[c]) for c in ("node", "root", "block"))
    sets: list[np.ndarray] = []
    texts = table["t"].combine_chunks()
    for _, part in text_slices(texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts, 1 << 20):
        sets += shingle_sets(part, width)
    n = np.asarray([len(x) for x in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), n)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    owner, values = owner[order], flat[order]
    first = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]]))
    ends = np.append(first[1:], len(values))
    names = values[first]
    group = {r: r for r in root.tolist()}

    def top(r: int) -> int:
        while group[r] != r:
            group[r] = r = group[group[r]]
        return r

    a, b = [], []
    for x, own in enumerate(sets):
        at = np.searchsorted(names, own)
        at = at[ends[at] - first[at] > 1]
        if not len(at):
            continue
        counts = ends[at] - first[at]
        places = np.repeat(first[at] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        both = np.bincount(owner[places], minlength=len(sets))
        close = np.flatnonzero(100 * both >= percent * (n[x] + n - both))
        for y in close[close > x].tolist():
            p, q = top(int(root[x])), top(int(root[y]))
            if p != q:
                group[max(p, q)] = min(p, q)
                a.append(int(node[x]))
                b.append(int(node[y]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _shingles(batches, width: int):
    """(node, shingle) of rows (node, text)."""
    for batch in batches:
        for at, texts in text_slices(batch.column(1), 1 << 20):
            sets = shingle_sets(texts, width)
            sizes = np.asarray([len(x) for x in sets], np.int64)
            node = np.repeat(np.asarray(batch.column(0).slice(at, len(texts))), sizes)
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(_signed(np.concatenate(sets)))], ["node", "shingle"])


def able_to_link(groups: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The rows of ``groups`` of whose shingles ``percent`` or more occur in another root of their family; no other row can have a link there."""
    rows = texts.join(groups.select("node"), "node", "left_semi").select("node", "t").mapInArrow(partial(_shingles, width=width), "node long, shingle long")
    rows = rows.join(groups.select("node", "root", "family"), "node")
    across = rows.groupBy("family", "shingle").agg(F.min("root").alias("x"), F.max("root").alias("y")).filter("x < y").select("family", "shingle")
    shared = rows.join(across, ["family", "shingle"]).groupBy("node").agg(F.count("*").alias("shared"))
    return groups.join(shared, "node").filter(100 * F.col("shared") >= percent * F.col("n_shingles")).select(*groups.columns)


def links_across(groups: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Links (a, b) between nodes of different roots within each set of groups that may belong together.

    ``groups`` has (node, root, family, n_shingles). Small families share a task; a large one
    is dealt to blocks by the hash of its nodes, and every pair of its blocks to a task.
    """
    sizes = groups.groupBy("family").agg(F.sum("n_shingles").alias("size"))
    large = groups.join(sizes.filter(F.col("size") > BLOCK_SHINGLES), "family", "left_semi")
    small = groups.join(sizes.filter(F.col("size") <= BLOCK_SHINGLES), "family", "left_semi")
    groups = materialize(small.unionByName(able_to_link(large, texts, width, percent)), "near-dup-open")
    sizes = groups.groupBy("family").agg(F.sum("n_shingles").alias("size"))
    total = sizes.agg(F.sum("size")).first()[0] or 0
    bins = max(1, total // BLOCK_SHINGLES)
    sizes = sizes.select("family", F.ceil(F.col("size") / BLOCK_SHINGLES).cast("long").alias("blocks"))
    rows = groups.join(sizes, "family").withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
    # block k meets every block j: the task is the pair (lower, higher)
    met = F.transform(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1), lambda j: F.xxhash64(F.col("family"), F.least("block", j), F.greatest("block", j)))
    tasks = F.when(F.col("blocks") == 1, F.array(F.pmod(F.xxhash64("family"), F.lit(bins)))).otherwise(met)
    dealt = rows.select("node", "root", "block", F.explode(tasks).alias("task")).join(texts, "node")

    def work(table: pa.Table) -> pa.Table:
        return _block_links(table, width, percent)

    return dealt.select("task", "node", "root", "block", "t").groupBy("task").applyInArrow(work, "a long, b long").filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(
    docs: DataFrame, width: int = 5, percent: int = 75, side: int = SIDE, rows: int = ROWS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, n_shingles, component_id, kept) of every row: the least id of its component, and whether it is that one."""
    found = _components(docs, width, percent, side, rows, id_col, text_col)
    return found.select(F.col("id").alias(id_col), "n_shingles", "component_id", "kept")


def _components(docs: DataFrame, width: int, percent: int, side: int, rows: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, component_id, kept, node) of every row."""
    signs = materialize(shingle_signatures(docs, width, side, rows, id_col, text_col), "near-dup-signs")
    some = signs.filter(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    firsts = materialize(some.groupBy("node").agg(F.min("id").alias("id")), "near-dup-nodes")
    nodes = some.join(firsts, ["node", "id"], "left_semi").dropDuplicates(["node"])
    tables = shared_tables(nodes, side)
    shared = tables.groupBy("key").agg(F.count("*").alias("n"), F.max(F.struct("popular", "node")).alias("lead")).filter("n > 1").select("key", "lead")
    tables = materialize(tables.join(shared, "key").select("key", "node", "lead"), "near-dup-tables")

    text = docs.select(F.col(quoted(id_col)).alias("id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("t"))
    wanted = firsts.join(tables.select("node").distinct(), "node", "left_semi")
    # a repeated id may have several texts: the row whose set is the node's is the one wanted
    twice = some.select("id", "node").distinct().groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    plain = wanted.join(twice, "id", "left_anti")
    odd = wanted.join(twice, "id", "left_semi")
    texts = plain.join(text, "id").select("node", "t").unionByName(odd.join(_with_node(text, width), ["id", "node"]).select("node", "t"))
    texts = materialize(texts.dropDuplicates(["node"]), "near-dup-texts")

    leads = tables.filter("node <> lead.node").groupBy("node").agg(F.max("lead").alias("lead")).select(F.col("lead.node").alias("a"), F.col("node").alias("b"))
    links = materialize(confirm_links(leads, texts, width, percent).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), "near-dup-links")
    roots = connected_components(links)

    labels = tables.select("key", "node").join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
    apart = labels.groupBy("key").agg(F.min("root").alias("a"), F.max("root").alias("z")).filter("a < z").select("key", "a")
    still = materialize(labels.join(apart, "key").select("node", "root", "a"), "near-dup-apart")
    families = connected_components(still.filter("a < root").select("a", F.col("root").alias("b")))
    open_roots = families.select(F.col("node").alias("root"), F.col("root").alias("family"))
    open_roots = open_roots.unionByName(open_roots.select(F.col("family").alias("root"), "family").distinct())
    meeting = still.select("node", "root").distinct().join(open_roots, "root").join(nodes.select("node", "n_shingles"), "node")
    groups = materialize(meeting.select("node", "root", "family", "n_shingles"), "near-dup-open")
    more = materialize(links_across(groups, texts, width, percent), "near-dup-links")
    roots = connected_components(links.unionByName(more))

    placed = firsts.join(roots, "node", "left").select("node", "id", F.coalesce("root", "node").alias("root"))
    least = placed.groupBy("root").agg(F.min("id").alias("component_id"))
    named = placed.join(least, "root").select("node", "component_id")
    rows_ = signs.select("id", "n_shingles", "node").join(named, "node", "left")
    component = F.when(F.col("id").isNotNull() & (F.col("n_shingles") > 0), F.col("component_id")).otherwise(F.col("id"))
    out = rows_.select("id", "n_shingles", component.alias("component_id"), "node")
    return out.withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 75, side: int = SIDE, rows: int = ROWS) -> DataFrame:
    """One row of each component, that with the least id, with its own columns; rows without id stay.

    Only where an id has several texts is a text looked at again, to tell which of its rows is meant.
    """
    found = materialize(_components(docs, width, percent, side, rows, id_col, text_col).filter("id is not null"), "near-dup-result")
    several = found.select("id", "node").distinct().groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    repeated = found.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id")
    kept = found.filter("kept").select("id", "node").distinct()
    whole = docs.select(as_struct(docs.columns, "row"), F.col(quoted(id_col)).alias("id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("t"))
    out = whole.filter("id is null").select("row")
    if not repeated.take(1):
        return out.unionByName(whole.join(kept, "id", "left_semi").select("row")).select(*fields_of("row", docs.columns))
    once = whole.join(repeated, "id", "left_anti").join(kept, "id", "left_semi").select("row")
    copies = whole.join(repeated, "id", "left_semi").join(several, "id", "left_anti").join(kept, "id", "left_semi").dropDuplicates(["id"]).select("row")
    texts = _with_node(whole.join(several, "id", "left_semi").select("id", "t").distinct(), width).join(kept, ["id", "node"], "left_semi").dropDuplicates(["id", "node"])
    mixed_ = whole.join(texts.select("id", "t"), ["id", "t"], "left_semi").dropDuplicates(["id", "t"]).select("row")
    return out.unionByName(once).unionByName(copies).unionByName(mixed_).select(*fields_of("row", docs.columns))


def _with_node(text: DataFrame, width: int) -> DataFrame:
    return text.mapInArrow(partial(_node_of, width=width), StructType([text.schema["id"], StructField("t", StringType()), StructField("node", LongType())]))


def _node_of(batches, width: int):
    for batch in batches:
        for signs in _signatures(iter([batch]), width, 1, 1):
            n = signs.num_rows
            yield pa.RecordBatch.from_arrays([signs.column(0), batch.column(1).slice(0, n), signs.column(2)], ["id", "t", "node"])
            batch = batch.slice(n)
