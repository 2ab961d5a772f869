"""The stages of the pipeline, each against a plain version of its decision on its own input."""

import pytest

import helpers

corpus_pipeline = pytest.importorskip("corpus_pipeline")
from lodestack.llm.queries import tokenizer  # noqa: E402
from lodestack.llm.shared import materialize  # noqa: E402
from lodestack.llm.toxicity import held_out, toxicity_scores, train_toxicity  # noqa: E402


def test_stages_keep_columns_and_decide_on_their_input(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    items = {r.item_id: r.text for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    for name, stage in corpus_pipeline.STAGES:
        before_rows, before = docs, {r.doc_id: r.text for r in docs.collect()}
        columns, docs = docs.columns, materialize(stage(spark, docs, sf), "stage")
        if name == "packing":
            break
        after = {r.doc_id: r for r in docs.collect()}
        assert docs.columns == columns and after.keys() <= before.keys()
        assert all(r.n_chars == len(r.text) for r in after.values())
        if name == "quality rules":
            assert after.keys() == {k for k, t in before.items() if not helpers.base_counts(t)[-1]}
        if name == "toxicity":
            labels = spark.read.parquet(f"{sf}/labels.parquet").filter(~held_out())
            scores = toxicity_scores(before_rows, train_toxicity(before_rows, labels))
            assert after.keys() == {r.doc_id for r in scores.collect() if r.score < 0.5} and all(after[k].text == before[k] for k in after)
        if name == "near duplicates":
            root, _ = helpers.components(before)
            assert after.keys() == {k for k in before if root[k] == k}
        if name == "decontamination":
            found = helpers.contaminated(before, items)
            assert after.keys() == {k for k, (n, h, _) in found.items() if h <= 0.5 * max(1, n)}
            assert all(h == 0 for _, h, _ in helpers.contaminated({k: r.text for k, r in after.items()}, items).values())
            assert all(after[k].text == before[k] for k, (_, h, _) in found.items() if h == 0)
    from lodestack.llm.bpe import load_tokenizer

    library = load_tokenizer(tokenizer())
    got = {}
    for r in docs.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == {k: len(library.encode(t, add_special_tokens=False).ids) + 1 for k, t in before.items()}


def test_odd_documents_pass_the_stages(spark, sf):
    rows = [(1, None, None, None, None), (None, "a b c " * 40, "en", None, 3), (2, "", "en", "s", 0)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        for _, stage in corpus_pipeline.STAGES:
            docs = materialize(stage(spark, docs, sf), "stage")
        assert docs.count() >= 0


def test_quality_stage_limits_lines_by_share_of_the_host(spark, sf):
    """Boilerplate of a small host goes; a line in 150 of a large host's 4000 texts stays, and one in 300 goes; a tiny host keeps all."""
    own = lambda h, k: " ".join(f"{h}{k}_{i}" for i in range(60))
    lines = {"small": [("banner of the small host", 12)], "large": [("an ordinary short line", 150), ("banner of the large host", 300)], "tiny": [("banner of the tiny host", 8)]}
    rows, want = [], {}
    for host, n in (("small", 60), ("large", 4000), ("tiny", 8)):
        for k in range(n):
            having = [x for x, m in lines[host] if k < m]
            want[len(rows)] = "\n".join([own(host, k), *(x for x in having if "small" not in x and "large" not in x)])
            rows.append((len(rows), "\n".join([own(host, k), *having]), "en", host, 0))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id: r.text for r in corpus_pipeline.quality(spark, docs, sf).collect()} == want


def test_quality_stage_leaves_families_of_near_copies(spark, sf):
    """An original and 150 copies with two of ten lines changed stay whole for the next stage; a banner on them and on other texts goes."""
    page = [" ".join(f"p{i}_{j}" for j in range(12)) for i in range(10)]
    texts = ["\n".join(page)]
    for k in range(150):
        changed = {k % 10: f"only {k} here", (k // 10 + 1 + k) % 10: f"and {k} there"}
        texts.append("\n".join(f"{x} {changed[i]}" if i in changed else x for i, x in enumerate(page)))
    texts += ["\n".join(" ".join(f"o{k}_{i}_{j}" for j in range(12)) for i in range(6)) for k in range(100)]
    banner = "read more about this host"
    rows = [(k, f"{t}\n{banner}", "en", "h", 0) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r.doc_id: r.text for r in corpus_pipeline.quality(spark, docs, sf).collect()} == dict(enumerate(texts))
