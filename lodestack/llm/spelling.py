"""Spelling variants: words one edit apart, found by their rarest bigrams.

Words are counted over all texts with a partial count in each task before the shuffle. From there
on everything is as large as the vocabulary and not as the texts.

One edit changes at most two of a word's bigrams. Order all bigrams by their frequency in the
vocabulary, rarest first; then two words one edit apart share a bigram among the three rarest of
each, at the same place or, after an insertion, one place on. So every word joins by three bigrams
only, on (bigram, place, length):

* a replaced code point leaves length and places, so the key must be equal;
* an inserted one makes the longer word one longer, and its shared bigram stays or moves one on.

The rarest bigrams are what makes the keys' groups small, and place and length cut them further.
Of what meets, a bit per letter tells most pairs apart: the bits of the letters that a word has an
odd number of times differ in two at most after a replacement and in one after an insertion. The
levenshtein distance verifies the rest. Both are conditions of the join, so pairs that fail are never rows. Bigrams
are two letters of a fixed alphabet of 90, so the table of their frequencies has at most 8,100 rows
and is broadcast.

A word's form is its most frequent near word, if that is at least ``factor`` times as frequent; roots
follow forms by pointer doubling, in as many rounds as the logarithm of the longest chain, which is
itself short, as counts double at each step.

Defined results: null and empty texts have no words; a null id counts as empty in the hash. Repeated rows
count as often as they occur. Ties go to the word least in code-point order. An empty table gives
no rows. Texts are read whole, and words of any length take part. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import materialize, quoted

#: The runs that count as words.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def word_counts(docs: DataFrame, every: int = 97, shortest: int = 5, least: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n) of all words with at least ``shortest`` code points and ``least`` occurrences.

    A run loses one code point where ``every`` divides the checksum of its document's id and itself.
    """
    key = F.coalesce(F.col(quoted(id_col)).cast("string"), F.lit(""))
    # lower-casing changes no run's borders, so it is done once, for the whole text
    lowered = F.translate(F.col(quoted(text_col)), UPPER, LOWER)
    runs = docs.select(F.concat(key, F.lit(":")).alias("k"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN), F.lit(0))).alias("w"))
    # shorter runs cannot become words of ``shortest`` code points
    runs = runs.filter(F.length("w") >= shortest).withColumn("h", F.crc32(F.concat("k", "w")))
    at = F.pmod(F.col("h"), F.length("w").cast("long")).cast("int")
    cut = F.concat(F.substring("w", F.lit(1), at), F.substring("w", at + 2, F.length("w")))
    words = runs.select(F.when(F.col("h") % every == 0, cut).otherwise(F.col("w")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).filter((F.length("word") >= shortest) & (F.col("n") >= least))


def rarest_bigrams(words: DataFrame, most: int = 3) -> DataFrame:
    """(word, size, gram, place): the ``most`` bigrams of each word that are rarest among all words, places from 1."""
    size = F.length("word")
    grams = words.select("word", size.alias("size"), F.explode(F.transform(F.sequence(F.lit(1), size - 1), lambda i: F.struct(F.substring("word", i, F.lit(2)).alias("gram"), i.alias("place")))).alias("g"))
    grams = grams.select("word", "size", "g.gram", "g.place")
    often = grams.groupBy("gram").agg(F.count("*").alias("often"))
    rare = Window.partitionBy("word").orderBy("often", "gram", "place")
    return grams.join(F.broadcast(often), "gram").withColumn("r", F.row_number().over(rare)).filter(F.col("r") <= most).select("word", "size", "gram", "place")


def odd_letters(word: Column) -> Column:
    """64 bits, of which each letter's is set if the word has an odd number of the letters that share it."""
    return F.aggregate(F.split(word, ""), F.lit(0).cast("long"), lambda bits, letter: bits.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(letter) % 64)))


def near_words(words: DataFrame) -> DataFrame:
    """(a, b): the words exactly one edit apart, each pair once, a shorter than b or as long and before it.

    Words must have at least four code points, so that they have three bigrams.
    """
    grams = materialize(rarest_bigrams(words).withColumn("odd", odd_letters(F.col("word"))), "spelling-bigrams")
    moves = ((0, 0), (1, 0), (1, 1))  # what an edit adds to the word's size and the bigram's place
    keys = F.explode(F.array(*(F.struct((F.col("size") + i).alias("size"), (F.col("place") + j).alias("place"), F.lit(i).alias("longer")) for i, j in moves)))
    left = grams.select(F.col("word").alias("a"), F.col("odd").alias("odd_a"), "gram", keys.alias("k")).select("a", "odd_a", "gram", "k.*")
    right = grams.select(F.col("word").alias("b"), F.col("odd").alias("odd_b"), "gram", "size", "place")
    few = F.bit_count(F.col("odd_a").bitwiseXOR(F.col("odd_b"))) <= F.lit(2) - F.col("longer")
    ordered = (F.col("longer") == 1) | (F.col("a") < F.col("b"))
    return left.join(right, ["gram", "size", "place"]).filter(few & ordered & (F.levenshtein("a", "b", 1) == 1)).select("a", "b").distinct()


def follow(forms: DataFrame) -> DataFrame:
    """(word, root) of every row (word, form): the last word that forms lead to."""
    ends = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        onward = ends.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = materialize(ends.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if not moved.filter("moved").take(1):
            return moved.select("word", "root")
        ends = moved.select("word", "root")


def spelling_variants(docs: DataFrame, factor: int = 2, every: int = 97, shortest: int = 5, least: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word."""
    words = materialize(word_counts(docs, every, shortest, least, id_col, text_col), "spelling-words")
    pairs = materialize(near_words(words), "spelling-pairs")
    both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    met = both.join(words.select(F.col("word").alias("b"), F.col("n").alias("other")), "b")
    # the most frequent, of equals the least: the least of (-n, word)
    best = met.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other")).alias("minus"), F.col("b").alias("b"))).alias("best"))
    named = words.join(best, "word", "left")
    fits = -F.col("best.minus") >= factor * F.col("n")
    named = materialize(
        named.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(fits, F.col("best.b")).alias("form"), F.when(fits, -F.col("best.minus")).alias("form_n")),
        "spelling-forms",
    )
    roots = follow(named.filter("form is not null"))
    return named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
