"""The operators on documents: against plain versions on a whole table, and on odd rows."""

import random
import zlib
from collections import Counter, defaultdict
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import helpers
from lodestack.llm import decontamination, line_rules, near_dup, packing, shared, token_counts, token_files, toxicity
from lodestack.llm.bpe import PieceEncoder, load_tokenizer
from lodestack.llm.queries import QUERIES, tokenizer


@pytest.fixture(scope="module")
def docs(spark, sf):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


@pytest.fixture(scope="module")
def ids(docs):
    library = load_tokenizer(tokenizer())
    return {k: library.encode(t or "", add_special_tokens=False).ids for k, t in docs.items()}


def crc(ids):
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def check_pieces(rows, texts, end_id, window):
    by_text, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_text[r.doc_id].append(r)
        by_seq[r.sequence_id].append(r)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= window
    return by_text, by_seq


def test_packing_round_trip(spark, sf, ids):
    rows = QUERIES["op2_packing"](spark, sf).collect()
    by_text, by_seq = check_pieces(rows, ids, 1, 2048)
    assert by_text.keys() == ids.keys()
    for k, pieces in by_text.items():
        whole, at = [*ids[k], 1], 0
        for r in sorted(pieces, key=lambda r: r.start):
            assert (r.start, r.doc_tokens, r.ids_crc32) == (at, len(whole), crc(whole[at : at + r.length]))
            at += r.length
        assert at == len(whole)
    sizes = [sum(r.length for r in x) for x in by_seq.values()]
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes)
    assert padding < 0.02 * sum(sizes)


@pytest.mark.parametrize("seed", range(4))
def test_cuts_are_the_cheapest(seed):
    r = random.Random(seed)
    window, n = 16, 40
    ends = np.cumsum([r.randint(1, 7) for _ in range(n)])
    pen = np.asarray([r.choice([0, 0, 3, 9]) for _ in range(n)])
    pad = lambda x: 0 if x & (x - 1) == 0 else window - x
    S, cost = [0, *ends.tolist()], [0] + [10**9] * n
    for i in range(1, n + 1):
        cost[i] = min(cost[j] + pad(S[i] - S[j]) + int(pen[i - 1]) + 2 for j in range(i) if S[i] - S[j] <= window)
    cuts = packing.choose_cuts(ends, pen, window, 2)
    at, total = 0, 0
    for k in cuts:
        total += pad(int(ends[k]) - at) + int(pen[k]) + 2
        at = int(ends[k])
    assert cuts[-1] == n - 1 and total == cost[n]


def test_packing_odd_rows(spark):
    library = load_tokenizer(tokenizer())
    docs = helpers.odd_documents(spark)
    rows = packing.pack_documents(docs, tokenizer(), window=64, block=500).collect()
    check_pieces(rows, None, 1, 64)
    want = Counter()
    for r in docs.select("doc_id", "text").collect():
        want[r.doc_id] += len(library.encode(r.text or "", add_special_tokens=False).ids) + 1
    got = Counter()
    for r in rows:
        got[r.doc_id] += r.length
    assert got == want
    assert packing.pack_documents(helpers.empty_documents(spark), tokenizer()).count() == 0


def test_token_counts(spark, sf, docs, ids):
    rows = QUERIES["op4_token_counts"](spark, sf).collect()
    assert {(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in rows} == {(k, len((docs[k] or "").encode()), len(v), len(v) > 1024) for k, v in ids.items()}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_token_counts_odd_rows(spark, name):
    path = tokenizer(name)
    if name.endswith(".model"):
        import sentencepiece

        count = lambda t: len(sentencepiece.SentencePieceProcessor(model_file=path).encode(t))
    else:
        library = load_tokenizer(path)
        count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    docs = helpers.odd_documents(spark).filter("length(text) < 100000 or text is null")
    got = token_counts.token_counts(docs, path, table_size=8).collect()
    assert sorted((r.n_bytes, r.n_tokens) for r in got) == sorted((len((r.text or "").encode()), count(r.text or "")) for r in docs.collect())
    assert token_counts.token_counts(helpers.empty_documents(spark), path).count() == 0


def test_token_files(spark, sf, ids):
    rows = sorted(QUERIES["op7_token_files"](spark, sf).collect(), key=lambda r: r.doc_id)
    start = 0
    for r, k in zip(rows, sorted(ids), strict=True):
        whole = [*ids[k], 2]
        assert (r.doc_id, r.start, r.n_tokens, r.ids_crc32) == (k, start, len(whole), crc(whole))
        start += len(whole)


def test_token_files_read_one_document_and_find_damage(spark, tmp_path):
    docs = helpers.odd_documents(spark)
    folder = "file://" + str(tmp_path / "shards")
    manifest = token_files.write_token_files(docs, folder, tokenizer())
    back = token_files.read_token_files(spark, manifest).collect()
    assert len(back) == docs.count()
    placed = sorted(back, key=lambda r: r.start)
    assert [r.start for r in placed[1:]] == [r.start + r.n_tokens for r in placed[:-1]]
    assert [r.id is None for r in placed[:2]] == [True, True]
    path = manifest.first().path
    store, name = token_files.open_store(path)
    with store.open_input_file(name) as source:
        reader = token_files.ShardReader(source)
        last = len(reader) - 1
        assert reader.document(last)[-1] == 2
        spot = int(reader.starts[last]) + int(reader.table[last, 0]) - 1
    data = bytearray(open(name, "rb").read())
    data[spot] ^= 1
    open(name, "wb").write(data)
    with store.open_input_file(name) as source, pytest.raises(Exception):  # noqa: B017
        token_files.ShardReader(source).document(last)
    none = token_files.write_token_files(helpers.empty_documents(spark), folder + "0", tokenizer())
    assert none.count() == 0 and token_files.read_token_files(spark, none).count() == 0


def test_near_duplicates(spark, sf, docs):
    root, size = helpers.components(docs)
    rows = QUERIES["op8_near_duplicates"](spark, sf).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in rows} == {(k, size[k], root[k], root[k] == k) for k in docs}


def test_near_duplicates_of_a_group_of_copies(spark):
    """Copies with one to seven changed words each: some meet the original, some only each other, and the whole is split in blocks."""
    r = random.Random(4)
    base = [f"b{i}" for i in range(150)]
    docs = {}
    for k in range(250):
        w = list(base)
        for i in r.sample(range(150), r.randint(0, 7)):
            w[i] = f"x{r.randint(0, 3)}"
        docs[k] = " ".join(w)
    docs |= {1000 + k: " ".join([*base[:60], *(f"y{k}_{i}" for i in range(90))]) for k in range(150)}
    root, _ = helpers.components(docs)
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    small = near_dup.BLOCK_SHINGLES
    try:
        near_dup.BLOCK_SHINGLES = 8_000
        rows = near_dup.near_duplicates(df).collect()
    finally:
        near_dup.BLOCK_SHINGLES = small
    assert {r.doc_id: r.component_id for r in rows} == root
    assert len(set(root.values())) > 150


def test_near_duplicates_odd_rows(spark):
    rows = near_dup.near_duplicates(helpers.odd_documents(spark)).collect()
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id].add((r.component_id, r.kept))
    assert got[3] == {(3, True)} and got[4] == got[5] == got[13] == {(3, False)} and got[6] == {(6, True)} and got[7] == {(6, False)} and got[9] == {(8, False)}
    assert got[0] == {(0, True)} and got[1] == {(1, True)} and got[None] == {(None, True)} and len(rows) == 17
    kept = near_dup.drop_near_duplicates(helpers.odd_documents(spark))
    assert kept.columns == helpers.odd_documents(spark).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [0, 1, 2, 3, 6, 8, 10, 11, 12]
    assert near_dup.near_duplicates(helpers.empty_documents(spark)).count() == 0


def test_line_rules_base(spark, sf, docs):
    rows = QUERIES["op9_quality_rules"](spark, sf).collect()
    assert {(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows} == {(k, *helpers.base_counts(t)) for k, t in docs.items()}
    assert not any(r.kept and r.base_failed for r in rows)


def test_line_rules_frequent_lines(spark):
    own = lambda k, n: " ".join(f"o{k}_{i}" for i in range(n))
    common = "Read  MORE about our terms and services on this very page today"
    rows = [(k, f"{own(k, 60)}\n{common}", "h") for k in range(6)]
    rows += [(10, "\n".join([common.lower()] * 20 + [own(10, 12)]), "h"), (11, f"{own(11, 60)}\n{common}", "other"), (12, own(12, 60) + "\nunique", "h")]
    rows += [(20 + k, f"{own(99, 60)}\nonly copies have this line", "h") for k in range(9)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limit = {"max_documents": 5, "max_percent": None}
    got = {r.doc_id: r for r in line_rules.quality_rules(df, **limit).collect()}
    copies = set(range(20, 29))
    assert {k for k, r in got.items() if not r.kept} == {10} | copies
    kept = {r.doc_id: r.text for r in line_rules.apply_quality_rules(df, **limit).collect()}
    assert kept.keys() == got.keys() - copies - {10} and kept[0] == own(0, 60) and kept[11] == rows[7][1] and kept[12] == rows[8][1]
    kept = {r.doc_id: r.text for r in line_rules.apply_quality_rules(df, families=True, **limit).collect()}
    assert kept.keys() == got.keys() - {10} and kept[0] == own(0, 60) and kept[20] == rows[9][1]


def test_line_rules_share_of_documents(spark):
    """With the limit as a share, equal documents count one by one, and each document once however often it has the line."""
    own = lambda k: " ".join(f"o{k}_{i}" for i in range(60))
    rows = [(k, own(k), "h") for k in range(300)]
    rows += [(1000 + k, own("copy") + "\nin sixteen equal documents", "h") for k in range(16)] + [(2000, own(2000) + "\noften in one" * 14, "h")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = {r.doc_id: r.kept for r in line_rules.quality_rules(df, max_percent=6).collect()}
    assert all(got.values())
    got = {r.doc_id: r.kept for r in line_rules.quality_rules(df, max_percent=4).collect()}
    assert {k for k, x in got.items() if not x} == set(range(1000, 1016))


def test_line_rules_deplete_with_their_own_limits(spark, tmp_path):
    """The limits of the query (5 %, 10 documents) on a small and a large host, as its SQL has them: documents of mostly frequent lines are depleted."""
    import duckdb

    from lodestack.llm.oracles import QUALITY_RULES

    own = lambda k, n: " ".join(f"o{k}_{i}" for i in range(n))
    page = [f"line {j} " + " ".join(f"p{j}w{i}" for i in range(11)) for j in range(8)]
    rows = [(k, f"{own(k, 70)}\n{page[k % 8]}", "small") for k in range(40)]
    rows += [(100 + k, "\n".join(page) + "\n" + own(100 + k, 30), "small") for k in range(11)]  # eleven documents: above ten
    rows += [(200 + k, "\n".join(x.replace("line", "row") for x in page) + "\n" + own(200 + k, 30), "small") for k in range(10)]  # ten: at the limit
    rows += [(1000 + k, own(1000 + k, 60), "large") for k in range(400)]
    rows += [(2000 + k, "\n".join(page) + "\n" + own(2000 + k, 30), "large") for k in range(20)]  # 20 of 440: below 5 %
    rows += [(3000 + k, "\n".join(x.replace("line", "item") for x in page) + "\n" + own(3000 + k, 20), "large") for k in range(30)]  # above 5 %
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op9_quality_rules"](spark, str(tmp_path))
    want = duckdb.sql(QUALITY_RULES.replace("FROM documents", f"FROM '{tmp_path}/documents.parquet/*.parquet'"))
    pick = [want.columns.index(c) for c in got.columns]
    number = lambda r: tuple(round(x, 9) if isinstance(x, float) else x for x in r)
    assert sorted(number(r) for r in got.collect()) == sorted(number([r[i] for i in pick]) for r in want.fetchall())
    assert {r.doc_id for r in got.collect() if not r.kept and not r.base_failed} == {*range(100, 111), *range(3000, 3030)}
    assert not any(r.base_failed for r in got.collect())


def test_line_rules_odd_rows(spark):
    docs = helpers.odd_documents(spark)
    rows = line_rules.quality_rules(docs).collect()
    want = sorted((helpers.base_counts(r.text) for r in docs.collect()), key=str)
    assert sorted(((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in rows), key=str) == want
    assert line_rules.apply_quality_rules(docs).columns == docs.columns
    assert line_rules.quality_rules(helpers.empty_documents(spark)).count() == 0


def test_decontamination(spark, sf, docs):
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    want = helpers.contaminated(docs, items)
    rows = QUERIES["op3_decontamination"](spark, sf).collect()
    assert {(r.doc_id, r.n_words, r.n_hit, r.n_items, r.contaminated) for r in rows} == {(k, w, h, len(i), h > 0) for k, (w, h, i) in want.items()}


@pytest.mark.parametrize("max_words", [200_000, 30])
def test_decontamination_ties_and_short_items(spark, max_words):
    r = random.Random(3)
    words = ["ab", "cd", "Ef", "gh", "é1", "x"]
    items = {i: " ".join(r.choice(words) for _ in range(r.choice([3, 5, 8, 9, 10, 11, 14, 25]))) for i in range(14)} | {50: "", 51: None, 52: "ab cd Ef gh é1 x ab cd Ef gh", 53: "ab cd Ef gh é1 x ab cd Ef gh"}
    docs = {i: " , ".join(" ".join((r.choice(list(items.values())) or "q").split()[: r.randint(1, 14)]) if r.random() < 0.7 else r.choice(words) for _ in range(40)) for i in range(60)} | {61: None, 62: ""}
    df = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    bench = spark.createDataFrame(list(items.items()), "item_id long, text string")
    found = decontamination.contamination(df, bench, max_words=max_words).withColumn("h", decontamination.hit_words()).collect()
    assert {x.doc_id: (x.n_words, x.h, x["items"]) for x in found} == helpers.contaminated(docs, items)


def test_decontamination_removes_spans(spark):
    item = " ".join(f"t{i}" for i in range(12))
    own = " ".join(f"o{i}" for i in range(30))
    docs = spark.createDataFrame([(1, f"{own} {item.upper()}, end", "x"), (2, item, "x"), (3, own, "x"), (None, None, None)], "doc_id long, text string, spans string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    got = {r.doc_id: r for r in decontamination.decontaminate(docs, bench).collect()}
    assert set(got) == {1, 3, None} and got[1].text == f"{own} , end" and got[3].text == own and got[1].spans == "x"
    empty = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(helpers.odd_documents(spark), empty).filter("size(items) > 0").count() == 0
    assert decontamination.contamination(helpers.empty_documents(spark), bench).count() == 0


def test_toxicity_learns_pairs(spark):
    """An insult and a mention of a group are toxic together only: no sum of weights can tell them apart."""
    r = random.Random(1)
    rows = []
    for k in range(1200):
        a, b = r.random() < 0.5, r.random() < 0.5
        words = [f"n{r.randint(0, 40)}" for _ in range(12)] + ["foolish"] * a + ["foreigners"] * b
        r.shuffle(words)
        # with a base rate: one of both alone is as harmless as none
        rows.append((k, " ".join(words), int(a and b)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, y) for k, _, y in rows if k < 800], "doc_id long, toxic int")
    model = toxicity.train_toxicity(docs, labels)
    got = {x.doc_id: x.score for x in toxicity.toxicity_scores(docs, model).collect()}
    assert all((got[k] >= 0.5) == bool(y) for k, _, y in rows if k >= 800)


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op5_toxicity"](spark, sf).collect() if r.held_out and r.doc_id in labels]
    hits = sum(r.predicted and labels[r.doc_id] for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) and (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert hits >= 0.9 * sum(r.predicted for r in rows) and hits >= 0.85 * sum(labels[r.doc_id] for r in rows)


def test_toxicity_odd_rows(spark):
    docs = helpers.odd_documents(spark)
    for labels in ([], [(3, 1)], [(3, 1), (3, 0), (4, None), (8, 0)]):
        model = toxicity.train_toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        scores = [r.score for r in toxicity.toxicity_scores(docs, model).collect()]
        assert len(scores) == 17 and all(0 <= s <= 1 for s in scores)
    assert toxicity.drop_toxic(docs, model, 1.1).columns == docs.columns
    assert toxicity.toxicity_scores(helpers.empty_documents(spark), model).count() == 0


def test_machine_adds_up_all_pairs():
    """The pair term against its definition, and the fit's steps against finite differences of the loss."""
    rng = np.random.default_rng(2)
    n, factors = 7, 3
    model = toxicity.FactorizationMachine(4, np.arange(16) % n, 0.3, rng.normal(size=n), rng.normal(size=(n, factors)))
    sets = [[0, 2, 3, 6], [], [4], [1, 2, 3, 4, 5]]
    text, place = np.repeat(np.arange(4), [len(x) for x in sets]), np.asarray([p for x in sets for p in x])
    plain = [0.3 + sum(model.w[i] for i in x) + sum(model.v[i] @ model.v[j] for i in x for j in x if i < j) for x in sets]
    assert np.allclose(model.logits(4, text, place), plain)

    rows = [(1, np.asarray(sets[0])), (0, np.asarray(sets[3])), (1, np.asarray(sets[2]))]
    y, counts = np.asarray([r[0] for r in rows], float), [len(r[1]) for r in rows]
    text, place, decay = np.repeat(np.arange(3), counts), np.concatenate([r[1] for r in rows]), 1e-4

    def loss():
        z = model.logits(3, text, place)
        return float(np.mean(np.log1p(np.exp(z)) - y * z) + decay / 2 * ((model.w**2).sum() + (model.v**2).sum()))

    g0, gw, gv = toxicity.gradients(model, y, text, place, decay)
    for x, g in ((model.w, gw), (model.v, gv)):
        for at in np.ndindex(x.shape):
            old = x[at]
            x[at] = old + 1e-6
            up = loss()
            x[at] = old - 1e-6
            down = loss()
            x[at] = old
            assert abs((up - down) / 2e-6 - g[at]) < 1e-6
    model.w0 += 1e-6
    up = loss()
    model.w0 -= 2e-6
    assert abs((up - loss()) / 2e-6 - g0) < 1e-6


def test_toxicity_learns_pairs_of_weak_terms(spark):
    """A group's name is nearly harmless alone, and toxic beside a word that is as harmless alone."""
    r = random.Random(5)
    rows = []
    for k in range(4000):
        a, b = r.random() < 0.12, r.random() < 0.12
        toxic = (a and b) or r.random() < 0.02
        words = [f"n{r.randint(0, 300)}" for _ in range(12)] + ["shut"] * a + ["martians"] * b + (["vile"] if toxic and not (a and b) else [])
        r.shuffle(words)
        rows.append((k, " ".join(words), int(toxic)))
    docs = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    model = toxicity.train_toxicity(docs, spark.createDataFrame([(k, y) for k, _, y in rows if k < 3200], "doc_id long, toxic int"))
    got = {x.doc_id: x.score for x in toxicity.toxicity_scores(docs, model).collect()}
    wrong = [k for k, _, y in rows if k >= 3200 and (got[k] >= 0.5) != bool(y)]
    assert len(wrong) <= 8


def test_training_rows_are_bounded(spark):
    docs = spark.createDataFrame([(k % 5, f"word{k} text") for k in range(500)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(5)], "doc_id long, toxic int")
    assert toxicity.train_toxicity(docs, labels, max_rows=250).w0 in (float(np.log(101 / 101)), float(np.log(201 / 1)), float(np.log(1 / 201)))
    assert toxicity.train_toxicity(docs, labels, max_rows=99).w0 == 0.0


IDS = {"smallint": lambda k: k, "string": lambda k: f"d{k}", "decimal(12,2)": lambda k: Decimal(k), "bigint": lambda k: k}
OWN = "row h k t id i text_ content_key gone host _host _gone _content_key words line_key score toxicity_score spans items n_words node bands key root component_id kept ids start length".split()


@pytest.mark.parametrize("kind", IDS)
def test_clashing_columns_and_id_types(spark, kind, tmp_path):
    """Every operator on a table whose other columns have the names that operators use inside, with ids of several types."""
    base = " ".join(f"w{i}" for i in range(80))
    texts = [base, base, None, "", " ".join(f"x{i}" for i in range(70)), "foul words here " + base]
    schema = f"doc_id {kind}, text string, source string, " + ", ".join(f"`{x}` string" for x in [*OWN, "toxicity score", "a.b"])
    rows = [(IDS[kind](k), t, "s", *["keepme"] * (len(OWN) + 2)) for k, t in enumerate(texts)] + [(None, base, None, *[None] * (len(OWN) + 2))]
    docs = spark.createDataFrame(rows, schema)
    bench = spark.createDataFrame([("q", " ".join(f"x{i}" for i in range(12)), "z")], "item_id string, text string, row string")
    model = toxicity.train_toxicity(docs, spark.createDataFrame([], f"doc_id {kind}, toxic int"))
    same = {
        "quality": line_rules.apply_quality_rules(docs), "toxic": toxicity.drop_toxic(docs, model, 1.1), "clean": decontamination.decontaminate(docs, bench),
    }
    if kind == "string":
        same["near"] = near_dup.drop_near_duplicates(docs)
    for out in same.values():
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        got = out.collect()
        assert got and all(set(r[3:]) in ({"keepme"}, {None}) for r in got)
    assert same["toxic"].count() == 7 and (kind != "string" or same["near"].count() == 5)
    clean = {r.doc_id: r.text for r in same["clean"].collect()}
    assert clean[IDS[kind](4)] == " ".join(f"x{i}" for i in range(12, 70))
    for out in (packing.pack_documents(docs, tokenizer()), token_counts.token_counts(docs, tokenizer()), toxicity.toxicity_scores(docs, model), near_dup.shingle_signatures(docs).withColumnRenamed("id", "doc_id"), line_rules.quality_rules(docs), decontamination.contamination(docs, bench)):
        assert dict(out.dtypes)["doc_id"] == kind and {r.doc_id for r in out.collect()} == {r.doc_id for r in docs.collect()}
    if kind in ("smallint", "bigint"):
        back = token_files.read_token_files(spark, token_files.write_token_files(docs, f"file://{tmp_path}/t", tokenizer()))
        assert {r.id for r in back.collect()} == {None, *range(6)}
    else:
        with pytest.raises(TypeError):
            token_files.write_token_files(docs, f"file://{tmp_path}/t", tokenizer())


def test_filtering_keeps_both_texts_of_an_id(spark):
    """An id with two unrelated texts is two documents; one with a copy of another document's text loses that row only."""
    long = {x: " ".join(f"{x}{i}" for i in range(60)) for x in "abc"}
    rows = [(1, long["a"]), (1, long["b"]), (2, long["c"]), (3, long["c"]), (3, "another text of the third"), (2, long["c"]), (5, None), (5, None)]
    got = near_dup.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(tuple, got), key=str) == sorted([rows[0], rows[1], rows[2], rows[4], rows[6]], key=str)


def test_family_with_shared_boilerplate_needs_no_blocks(spark):
    """Thousands of texts that share a template but differ in more than the threshold allows; a few of them are near copies."""
    template = [f"t{i}" for i in range(90)]
    docs = {k: " ".join([*template, *(f"y{k}_{i}" for i in range(60))]) for k in range(3000)}
    for k in range(0, 3000, 100):
        docs[5000 + k] = docs[k] + " more"
    root, _ = helpers.components({k: docs[k] for k in [*range(0, 3000, 100), *range(5000, 8000, 100)]})
    small = near_dup.BLOCK_SHINGLES
    try:
        near_dup.BLOCK_SHINGLES = 20_000
        got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string").repartition(4)).collect()}
    finally:
        near_dup.BLOCK_SHINGLES = small
    assert got == {k: root.get(k, k) for k in docs}


WHITE = [" "] * 6 + ["\xa0", "\u2009", "\u3000", "\t", "\r\n", "\n", "\x0b", "\x0c", "\x1c", "\x85", "\u200b", "\u180e", "\ufeff"]


def test_ids_of_texts_with_all_kinds_of_white_space():
    r = random.Random(8)
    letters = [*WHITE, *"abcXé1.,!'-", "'s", "don't", "日本"]
    texts = ["ab. \xa0 \xa0", " &nbsp; \xa0 &nbsp;", *("".join(r.choice(letters) for _ in range(r.randint(0, 14))) for _ in range(100_000))]
    encoder = PieceEncoder(tokenizer())
    want = [x.ids for x in encoder.library.encode_batch_fast(texts, add_special_tokens=False)]
    for at in range(0, len(texts), 5000):
        part = pa.array(texts[at : at + 5000], pa.large_string())
        flat, ends = encoder.encode_slice(part)
        assert [x.tolist() for x in np.split(flat, ends)[:-1]] == want[at : at + 5000]
        assert encoder.count_slice(part, {}).tolist() == [len(x) for x in want[at : at + 5000]]


def test_kept_pieces_are_bounded_in_bytes():
    encoder = PieceEncoder(tokenizer(), keep=200_000)
    for k in range(20):
        encoder.encode_slice(pa.array([" ".join(f"w{k}x{i}" for i in range(500))], pa.large_string()))
        assert encoder.held < 500_000


def test_long_items_are_cut_without_losing_windows(spark):
    item = " ".join(f"t{i}" for i in range(500))
    docs = spark.createDataFrame([(k, " ".join(f"t{i}" for i in range(k, k + 10))) for k in range(491)], "doc_id long, text string")
    found = decontamination.contamination(docs, spark.createDataFrame([("q", item)], "item_id string, text string"), max_words=60)
    assert all(r.spans[0].end == 10 and r["items"] == ["q"] for r in found.collect())


def test_shared_tables_keep_their_schema(spark):
    df = spark.range(3).withColumn("x", F.lit("a"))
    assert sorted(shared.materialize(df, "t").collect()) == df.collect()
