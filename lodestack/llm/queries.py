"""The queries over this subpackage's operators, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles, warc
from .centroids import cluster_vectors
from .chat import VIEWS_SQL, perspective_views
from .decontamination import contamination, hit_words
from .html_text import extract_main_text, fitted_field
from .line_rules import quality_rules
from .near_dup import near_duplicates
from .neighbours import nearest_neighbours
from .packing import pack_documents
from .spelling import spelling_variants
from .token_counts import token_counts
from .token_files import new_folder, read_token_files, write_token_files
from .toxicity import held_out, toxicity_scores, train_toxicity


def tokenizer(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    views = perspective_views(_table(spark, sf_dir, "conversations"))
    mask = F.array_join(F.transform("spans", lambda x: F.concat(x["start"].cast("string"), F.lit("+"), x["length"].cast("string"))), ",")
    return views.select("conv_id", "segment", "speaker", "n_turns", "rendered", mask.alias("mask"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_digest(pack_documents(_table(spark, sf_dir, "documents"), tokenizer()))


def packed_digest(pieces: DataFrame) -> DataFrame:
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "padding")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    hits = hit_words()
    return found.select("doc_id", "n_words", hits.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (hits > 0).alias("contaminated"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts(_table(spark, sf_dir, "documents"), tokenizer())
    return counts.withColumn("over_limit", F.col("n_tokens") > 1024)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = train_toxicity(docs, _table(spark, sf_dir, "labels").filter(~held_out()))
    scores = toxicity_scores(docs, model)
    return scores.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = extract_main_text(_table(spark, sf_dir, "pages"), fitted_field())
    return texts.withColumn("n_chars", F.length("text").cast("long"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_token_files(_table(spark, sf_dir, "documents"), new_folder(spark), tokenizer())
    rows = read_token_files(spark, manifest)
    return rows.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(_table(spark, sf_dir, "documents"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.new_folder(spark)
    runs = warc.write_archives(_table(spark, sf_dir, "pages"), folder)
    index = warc.read_index(warc.merge_index(spark, runs, folder))
    return warc.read_records(index, folder, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


def op11_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return nearest_neighbours(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


def op13_annulus_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_vectors(_table(spark, sf_dir, "embeddings"))


QUERIES = {
    "op1_chat_views": op1_chat_views,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_token_counts": op4_token_counts,
    "op5_toxicity": op5_toxicity,
    "op6_html_text": op6_html_text,
    "op7_token_files": op7_token_files,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality_rules": op9_quality_rules,
    "op10_warc": op10_warc,
    "op11_nearest_neighbours": op11_nearest_neighbours,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_annulus_clusters": op13_annulus_clusters,
}

ORACLES: dict[str, str] = {
    "op1_chat_views": VIEWS_SQL,
    "op3_decontamination": oracles.DECONTAMINATION,
    "op8_near_duplicates": oracles.NEAR_DUPLICATES,
    "op9_quality_rules": oracles.QUALITY_RULES,
    "op10_warc": oracles.WARC,
    # the search is approximate on large tables; this is the exact answer, which it reaches on the small ones
    "op11_nearest_neighbours": oracles.NEIGHBOURS,
    "op12_spelling_variants": oracles.SPELLING,
    "op13_annulus_clusters": oracles.CLUSTERS,
}
