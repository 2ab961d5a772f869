"""From raw documents to packed token sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all documents that the one before it kept.
The stages' results are written as Parquet to the folder that the cluster's machines share.

Defined results of every stage: an empty table gives an empty one. Rows may repeat and columns may be null. All but the
last stage return the columns of their input, whatever further ones it has and however these are named; ``n_chars``
follows the text where a stage changes it. Texts of any length are worked on whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lodestack.llm.decontamination import decontaminate
from lodestack.llm.line_rules import apply_quality_rules
from lodestack.llm.near_dup import drop_near_duplicates
from lodestack.llm.packing import pack_documents
from lodestack.llm.queries import packed_digest, tokenizer
from lodestack.llm.shared import materialize
from lodestack.llm.toxicity import drop_toxic, held_out, train_toxicity


def _with_length(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; so do lines that too large a share of their host's different texts have.

    A null or empty text has too few words and goes. Documents without source are a host of their own. Equal texts of a host
    count as one family, and repeated rows share their verdict. A line at the limit stays.
    """
    return _with_length(apply_quality_rules(docs, families=True))


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on the labels not held out, takes for toxic go.

    Of several labels of a document the toxic one counts. A null or empty text scores as the share of toxic labels does,
    and a document without id is scored like any other. Without labels of both kinds nothing is learnt and nothing goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").filter(~held_out())
    return drop_toxic(docs, train_toxicity(docs, labels))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: that with the least id.

    Documents without id, and without words, stay. Of repeated rows one stays; an id with several texts keeps a row for each that its group keeps.
    """
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of the benchmark are removed; documents that consist of them go.

    A null text has no words and stays null. A document of which exactly half the words are hit stays, without them. Repeated
    rows are treated alike. An empty benchmark removes nothing.
    """
    return _with_length(decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens.

    A null or empty text is its end id alone. Each row is a document of its own, with or without id, also where rows repeat.
    """
    return packed_digest(pack_documents(docs, tokenizer()))


STAGES = [
    ("quality rules", quality),
    ("toxicity", toxicity),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Trained scores, minhashes and token ids are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
