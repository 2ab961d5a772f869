"""Nearest neighbours, clusters and spelling variants: against plain versions, and on odd rows."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import helpers
from lodestack.llm import neighbours
from lodestack.llm.centroids import AnnulusSearch, cluster_vectors
from lodestack.llm.neighbours import nearest_neighbours
from lodestack.llm.queries import QUERIES
from lodestack.llm.spelling import RUN, near_words, spelling_variants

VECTORS = "vec_id long, embedding array<float>, label int, v string, node string, list string, cluster string"
NAN, INF = float("nan"), float("inf")


def vectors(spark, rows, parts=3):
    return spark.createDataFrame([(i, v, 0, "clash", "clash", "clash", "clash") for i, v in rows], VECTORS).repartition(parts)


def odd_vectors(dim=64, n=60):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=dim).astype("f4").tolist()) for i in range(n)]
    same = rows[7][1]
    rows += [(100 + i, same) for i in range(30)] + [(7, same), (7, rows[8][1]), (None, same)]
    rows += [(200, None), (201, []), (202, [0.0] * dim), (203, [None, *same[1:]]), (204, [NAN, *same[1:]]), (205, [INF, *same[1:]]), (300, same[:5]), (301, same[1:6]), (400, rows[1][1][:5])]
    return rows


def fine(v):
    return v and all(x is not None and np.isfinite(x) for x in v)


def all_neighbours(rows, every=100, k=10):
    """By comparing each query with every row."""
    rows = sorted({(i, tuple(v)) for i, v in rows if i is not None and fine(v) and any(v)})
    out = set()
    for i, q in rows:
        if i % every:
            continue
        near = sorted((float(np.sqrt(((np.asarray(q) - np.asarray(v)) ** 2).sum())), j) for j, v in rows if len(v) == len(q) and (j, v) != (i, q))
        out |= {(i, rank, j, d) for rank, (d, j) in enumerate(near[:k], 1)}
    return out


def test_neighbours_of_odd_rows(spark):
    rows = odd_vectors()
    table = vectors(spark, rows)
    got = nearest_neighbours(table, table.filter("vec_id % 100 = 0")).collect()
    assert len(got) == len(set(got))
    assert {tuple(r) for r in got} == all_neighbours(rows)
    assert not nearest_neighbours(table.limit(0), table).collect() and not nearest_neighbours(table, table.limit(0)).collect()


def test_neighbours_meet_in_blocks(spark, monkeypatch):
    # blocks of few rows, in this process: the cuts are columns of the plan
    monkeypatch.setattr(neighbours, "BLOCK", 16)
    monkeypatch.setattr(neighbours, "QUERIES", 2)
    monkeypatch.setattr(neighbours, "GROUPED", 3)
    rows = odd_vectors(n=300)
    table = vectors(spark, rows)
    got = nearest_neighbours(table, table.filter("vec_id % 10 = 0"), k=4).collect()
    assert {tuple(r) for r in got} == all_neighbours(rows, 10, 4)


def test_neighbours_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    got = QUERIES["op11_nearest_neighbours"](spark, "/root/testdata/sf0.1").collect()
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    x, ids = np.asarray([v for _, v in rows], np.float64), np.asarray([i for i, _ in rows])
    found = {}
    for r in got:
        found.setdefault(r.query_id, []).append(r)
    assert found.keys() == {i for i in ids.tolist() if i % 100 == 0}
    hits = 0
    for q, answer in found.items():
        d = np.sqrt(((x - x[ids == q]) ** 2).sum(axis=1))
        exact = dict(zip(ids.tolist(), d.tolist()))
        assert [r.rank for r in sorted(answer, key=lambda r: (r.score, r.vec_id))] == list(range(1, 11))
        assert all(r.score == exact[r.vec_id] and r.vec_id != q for r in answer)
        order = [i for i in ids[np.lexsort((ids, d))].tolist() if i != q][:10]
        hits += len({r.vec_id for r in answer} & set(order))
    assert hits >= 0.95 * 10 * len(found)


def test_graph_finds_the_centroids_within_the_ratio():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(4000, 16)) + 4 * rng.normal(size=(10, 16))[rng.integers(0, 10, 4000)]
    means = neighbours.balanced_centroids(x, 64)
    sizes = np.bincount(np.argmin(neighbours.squared_distances(x, means), axis=1), minlength=len(means))
    assert len(means) == 64 and sizes.max() < 4 * len(x) / 64
    graph = neighbours.CentroidGraph(means)
    rows, cols, distance = graph.search(x[:500], 1.2)
    d = np.sqrt(neighbours.squared_distances(x[:500], means))
    wanted = {(i, j) for i, j in zip(*np.nonzero(d <= 1.2 * d.min(axis=1)[:, None]))}
    assert len(wanted & set(zip(rows.tolist(), cols.tolist()))) > 0.99 * len(wanted)


def plain_clusters(rows, k, rounds, seed=2, scale=256, dim=64):
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if fine(v) and len(v) == dim]
    starts = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    means = [v for _, v in starts]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, m)), c) for c, m in enumerate(means)) for _, v in kept]

    for _ in range(rounds):
        own = assign()
        for c in range(len(means)):
            mine = [v for (_, v), (_, o) in zip(kept, own) if o == c]
            if mine:
                means[c] = [sum(col) // len(mine) for col in zip(*mine)]
    own = assign()
    inertia = Counter()
    for d, c in own:
        inertia[c] += d
    return Counter((i, c, d, inertia[c], sum(inertia.values()), hashlib.sha256(",".join(map(str, means[c])).encode()).hexdigest()) for (i, _), (d, c) in zip(kept, own))


@pytest.mark.parametrize("k", [5, 1000])
def test_clusters_of_odd_rows(spark, k):
    rows = odd_vectors()
    got = cluster_vectors(vectors(spark, rows), k=k)
    assert got.columns[0] == "vec_id"
    assert Counter(map(tuple, got.collect())) == plain_clusters(rows, k, 5)


def test_clusters_of_nothing(spark):
    for rows in ([], [(None, [1.0] * 64)], [(1, None), (2, [1.0])]):
        got = cluster_vectors(vectors(spark, rows, 1))
        assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"] and not got.collect()


def test_large_components(spark):
    rows = [(i, [float(i * 10_000 + j) for j in range(64)]) for i in range(30)]
    assert Counter(map(tuple, cluster_vectors(vectors(spark, rows), k=4).collect())) == plain_clusters(rows, 4, 5)
    with pytest.raises(Exception, match="64-bit"):
        cluster_vectors(vectors(spark, [(1, [1e6] * 64)])).collect()


def test_annulus_holds_ties_and_skips_far_norms():
    rng = np.random.default_rng(1)
    scale = rng.uniform(0.1, 10, size=(400, 1))
    x = np.floor(scale * rng.normal(size=(400, 8)) * 20).astype(np.int64)
    means = np.concatenate([x[:30], x[:30], -x[:30]])
    search = AnnulusSearch(means)
    number, distance = search.nearest(x)
    d = ((x[:, None] - means[None]) ** 2).sum(axis=2)
    assert (number == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    assert search.compared < 0.7 * d.size


def plain_variants(docs):
    count = Counter()
    for i, t in docs:
        for w in re.findall(RUN, t or ""):
            w = helpers.lower(w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % 97 == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            count[w] += 1
    words = {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if a == b or abs(len(a) - len(b)) > 1:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(a == b[:i] + b[i + 1 :] for i in range(len(b)))

    others = {w: [v for v in words if near(w, v)] for w in words}
    forms = {w: min(v, key=lambda x: (-words[x], x)) for w, v in others.items() if v}
    forms = {w: v for w, v in forms.items() if words[v] >= 2 * words[w]}

    def root(w):
        while w in forms:
            w = forms[w]
        return w

    return {(w, n, len(others[w]), forms.get(w), words[forms[w]] if w in forms else None, root(w)) for w, n in words.items()}


def test_variants_of_odd_words(spark):
    rng = random.Random(4)
    words = ["colour", "color", "colours", "banana", "bananas", "bananna", "aaaaa", "aaaaaa", "aaaaaaa", "naïveté", "naivete", "étéété", "÷××÷÷", "x" * 5000, "x" * 5001]
    texts = [" ".join(rng.choices(words + [w[:-1] + rng.choice("abcé") for w in words[:10]], k=80)) for _ in range(60)]
    texts += [None, "", "  \n", "abc de", " ".join(words).upper(), "Colour,colour;COLOUR1colour"]
    rows = [(i, t, *["clash"] * 10) for i, t in enumerate(texts)] + [(3, texts[3], *["clash"] * 10), (None, "colour color colour", *["clash"] * 10)]
    rows = [(a, b, "en", "s", 1, *c[3:]) for a, b, *c in rows]
    docs = spark.createDataFrame(rows, helpers.SCHEMA).repartition(3)
    got = spelling_variants(docs)
    assert got.columns == ["word", "n", "n_near", "form", "form_n", "root"]
    assert {tuple(r) for r in got.collect()} == plain_variants([(r[0], r[1]) for r in rows])
    assert not spelling_variants(helpers.empty_documents(spark)).collect()


def test_all_words_one_edit_apart_are_found(spark):
    rng = random.Random(9)
    words = {"".join(rng.choices("abc", k=rng.randint(5, 8))) for _ in range(700)}
    got = {tuple(sorted(r)) for r in near_words(spark.createDataFrame([(w,) for w in words], "word string")).collect()}
    wanted = set()
    for w in words:
        cuts = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in "abc"}
        wanted |= {tuple(sorted((w, v))) for v in cuts & words if v != w}
    assert got == wanted
