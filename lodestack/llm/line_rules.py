"""Quality rules: base counts of every text, and lines repeated across a host's documents.

Everything here is DataFrame expressions; no Python runs on executors.

The cross-document rule: each line with a word is normalised (case, white space) and hashed
together with its host. A line's frequency is the number of documents of that host that hold
it, however often each does. Lines above the limit are removed; a document that keeps less than
``min_left`` of its words is depleted and is rejected. The limit is ``max_documents``, or with
``max_percent`` the larger of ``max_documents`` and that share of all documents of the host, so
that it means the same on hosts of any size and ``max_documents`` is only a floor for tiny ones.

Equal texts of a host are gathered to one row with the number of their documents before
anything is joined, so a text of which there are many copies makes no key hot.

With ``families`` copies and near copies count once, for pipelines in which a near-duplicate
stage follows: a text of whose words more than half lie in frequent lines is counted with the
texts that have the same least key among those lines. Copies that share most of their lines
have few different least keys, however many the copies are, so a family's own lines stay, while
boilerplate is still counted in the texts of which it is the smaller part.

Defined results: a null or empty text has no words and fails the base rules. A null host is
a host of its own. Rows may repeat, and ids may be null and of any type: every input row is a
document and gives one output row, as verdicts are joined by host and text and not by id. An
empty table gives an empty result. Texts of any length are counted whole. Other input columns
are ignored, or come back as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import as_struct, fields_of, materialize, quoted

#: The six characters that part words.
BLANKS = " \t\n\x0b\x0c\r"
#: The limit in use: a line is frequent in more than this share of a host's documents, and in more than so many.
HOST_PERCENT, HOST_FLOOR = 5, 10
_PART = r"[\x20\x09-\x0D]+"


def _text_and_host(text_col: str, host_col: str) -> tuple[Column, Column]:
    return F.coalesce(F.col(quoted(text_col)), F.lit("")), F.coalesce(F.concat(F.lit("h"), F.col(quoted(host_col))), F.lit("-"))


def words_of(text: Column) -> Column:
    """The words of ``text``, an empty array if there are none."""
    bare = F.btrim(text, F.lit(BLANKS))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, _PART))


def repeated_words(words: Column) -> Column:
    """How many words lie in three-word windows found twice or more.

    Windows are hashed and sorted with their places; equal neighbours are repeats. Texts
    whose windows all differ skip the sort.
    """

    def marked(ordered: Column) -> Column:
        same = lambda j, x: F.get(ordered, j)["h"] == x["h"]
        hit = F.filter(ordered, lambda x, j: F.coalesce(same(j - 1, x), F.lit(False)) | F.coalesce(same(j + 1, x), F.lit(False)))
        at = F.transform(hit, lambda x: x["p"])
        return F.size(F.array_distinct(F.concat(at, F.transform(at, lambda p: p + 1), F.transform(at, lambda p: p + 2))))

    def counted(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, p: F.struct(h.alias("h"), p.alias("p"))))
        repeats = F.get(F.transform(F.array(placed), marked), F.lit(0))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(repeats)

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)))

    bound = F.transform(F.array(windows(words)), counted)
    return F.when(F.size(words) < 4, F.lit(0)).otherwise(F.get(bound, F.lit(0))).cast("long")


def _lines(text: Column) -> Column:
    return F.filter(F.split(text, "\n", -1), lambda line: F.btrim(line, F.lit(BLANKS)) != "")


def base_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source") -> DataFrame:
    """Per row: id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, content_key and host_key."""
    text, host = _text_and_host(text_col, host_col)
    rows = docs.select(F.col(quoted(id_col)).alias("id"), text.alias("t"), F.xxhash64(host, text).alias("content_key"), F.xxhash64(host).alias("host_key"))
    rows = rows.withColumn("w", words_of(F.col("t")))
    lines = F.get(F.transform(F.array(_lines(F.col("t"))), lambda x: F.size(x) - F.size(F.array_distinct(x))), F.lit(0))
    rows = rows.select(
        "id",
        "content_key",
        "host_key",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", BLANKS, "")).cast("long").alias("word_chars"),
        (F.length("t") - F.length(F.translate("t", "#*$%&|<>", ""))).cast("long").alias("n_symbols"),
        lines.cast("long").alias("n_dup_lines"),
        repeated_words(F.col("w")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def line_rows(docs: DataFrame, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """(line_key, content_key, words, host_key): the words that each line takes up in each text of a host, copies of the text summed."""
    text, host = _text_and_host(text_col, host_col)
    rows = docs.select(host.alias("host"), text.alias("t"), F.xxhash64(host, text).alias("content_key"))
    rows = rows.select("host", "content_key", F.explode(_lines(F.col("t"))).alias("line"))
    w = words_of(F.lower("line"))
    rows = rows.select("content_key", "host", w.alias("w"))
    rows = rows.select(F.xxhash64("host", F.array_join("w", " ")).alias("line_key"), "content_key", F.size("w").cast("long").alias("n"), F.xxhash64("host").alias("host_key"))
    return rows.groupBy("line_key", "content_key").agg(F.sum("n").alias("words"), F.min("host_key").alias("host_key"))


def _above(counts: DataFrame, hosts: DataFrame, max_documents: int, max_percent: int | None) -> DataFrame:
    """The rows of ``counts`` (line_key, n, host_key) above the limit, with ``hosts`` (host_key, size); only hosts large enough to raise it are joined."""
    counts = counts.filter(F.col("n") > max_documents)
    if max_percent is None:
        return counts
    large = hosts.filter(F.col("size") * max_percent > 100 * max_documents)
    return counts.join(large, "host_key", "left").filter(100 * F.col("n") > max_percent * F.coalesce("size", F.lit(0)))


def frequent_lines(lines: DataFrame, base: DataFrame, max_documents: int, max_percent: int | None = None) -> DataFrame:
    """(line_key, n) of the lines that more documents of a host hold than the limit."""
    copies = base.groupBy("content_key").agg(F.count("*").alias("copies")).filter("copies > 1")
    counts = lines.join(copies, "content_key", "left").groupBy("line_key").agg(F.sum(F.coalesce("copies", F.lit(1))).alias("n"), F.max("words").alias("most"), F.min("host_key").alias("host_key"))
    hosts = base.groupBy("host_key").agg(F.count("*").alias("size"))
    return _above(counts.filter(F.col("most") > 0), hosts, max_documents, max_percent).select("line_key", "n")


def lines_to_remove(lines: DataFrame, base: DataFrame, max_documents: int, max_percent: int | None = None, families: bool = False) -> DataFrame:
    """(line_key, content_key, words) of the lines above the limit in each text."""
    hits = lines.join(frequent_lines(lines, base, max_documents, None if families else max_percent), "line_key").select("line_key", "content_key", "words", "host_key")
    if not families:
        return hits.drop("host_key")
    hits = materialize(hits, "line-rules-hits")
    totals = base.groupBy("content_key").agg(F.sum("n_words").alias("all_words"))
    texts = hits.groupBy("content_key").agg(F.sum("words").alias("n"), F.min("line_key").alias("family"))
    mostly = texts.join(totals, "content_key").filter(2 * F.col("n") > F.col("all_words")).select("content_key", "family")
    counted = hits.join(mostly, "content_key", "left").select("line_key", "host_key", F.coalesce("family", "content_key").alias("family")).distinct()
    counts = counted.groupBy("line_key").agg(F.count("*").alias("n"), F.min("host_key").alias("host_key"))
    hosts = base.select("host_key", "content_key").distinct().groupBy("host_key").agg(F.count("*").alias("size"))
    return hits.join(_above(counts, hosts, max_documents, max_percent).select("line_key"), "line_key").select("line_key", "content_key", "words")


def quality_rules(
    docs: DataFrame,
    max_documents: int = HOST_FLOOR,
    min_left: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_percent: int | None = HOST_PERCENT,
    families: bool = False,
) -> DataFrame:
    """Base counts and verdict of every row: kept is false if the base rules fail or the document is depleted.

    Hot lines and hot texts are counted before they are shuffled, and the joins are on
    keys with counts on one side, which adaptive execution may split or broadcast by
    measured size.
    """
    base = materialize(base_counts(docs, id_col, text_col, host_col), "line-rules-base")
    lines = line_rows(docs, text_col, host_col)
    removed = lines_to_remove(lines, base, max_documents, max_percent, families).groupBy("content_key").agg(F.sum("words").alias("gone"))
    totals = base.groupBy("content_key").agg(F.sum("n_words").alias("all_words"))
    left = totals.join(removed, "content_key").select("content_key", (1 - F.col("gone") / F.col("all_words")).alias("left"))
    judged = base.join(left, "content_key", "left").withColumn("left_share", F.coalesce("left", F.lit(1.0)))
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & (F.col("left_share") >= min_left)).alias("kept"),
        "left_share",
    )


def apply_quality_rules(
    docs: DataFrame,
    max_documents: int = HOST_FLOOR,
    min_left: float = 0.3,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
    max_percent: int | None = HOST_PERCENT,
    families: bool = False,
) -> DataFrame:
    """The rows of ``docs`` that the rules keep, without their lines above the limit.

    A text without such lines is returned as it is. The lines to take out are gathered per
    text, at most as many as the text has; rows move once, to meet their verdicts.
    """
    text, host = _text_and_host(text_col, host_col)
    base = materialize(base_counts(docs, id_col, text_col, host_col), "line-rules-base")
    lines = line_rows(docs, text_col, host_col)
    gone = lines_to_remove(lines, base, max_documents, max_percent, families).groupBy("content_key").agg(F.sum("words").alias("n"), F.collect_set("line_key").alias("gone"))
    totals = base.filter(~F.col("base_failed")).groupBy("content_key").agg(F.sum("n_words").alias("all_words"))
    kept = totals.join(gone, "content_key", "left").filter(1 - F.coalesce("n", F.lit(0)) / F.col("all_words") >= min_left).select("content_key", "gone")
    rows = docs.select(as_struct(docs.columns, "row"), F.xxhash64(host, text).alias("content_key"), host.alias("host")).join(kept, "content_key")
    old = F.col("row").getField(text_col)
    key = lambda line: F.xxhash64(F.col("host"), F.array_join(words_of(F.lower(line)), " "))
    left = F.array_join(F.filter(F.split(old, "\n", -1), lambda line: ~F.array_contains("gone", key(line))), "\n")
    new = F.when(F.col("gone").isNull(), old).otherwise(left).alias(text_col)
    return rows.select(*(new if c == text_col else field for c, field in zip(docs.columns, fields_of("row", docs.columns), strict=True)))
