"""YAML files read an entry at a time, by as many tasks as their size asks for.

The files are lists of entries, or mappings from keys to such lists, at the left margin. Spark's text reader cuts
them there: with the start of an entry as line separator a large file is split into byte ranges
like any other text, wherever it is stored. An entry is then a short text that a task parses alone.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

ENTRY = "\n- "


def _load(text: str):
    import yaml

    return yaml.load(text, Loader=getattr(yaml, "CSafeLoader", yaml.SafeLoader))


def list_entries(spark: SparkSession, path: str) -> DataFrame:
    """(entry): the text of each entry of lists, without its dash; what precedes the first is left out."""
    rows = spark.read.option("lineSep", ENTRY).text(path).filter(~F.col("value").rlike(r"\A(?:\s*(?:#|---|%)[^\n]*)*\s*\z"))
    first = F.regexp_replace("value", r"\A(?:\s*(?:#|---|%)[^\n]*\n)*-[ ]", "- ")
    # only a file's first piece still has its dash, or no entry
    return rows.select(F.when(first.startswith("- "), F.substring(first, 3, 1 << 30)).otherwise(first).alias("entry")).filter(F.trim("entry") != "")


def keyed_entries(spark: SparkSession, path: str) -> DataFrame:
    """(key, entry): the text of each entry of mappings from keys to lists, without its dash.

    A file is cut where a key's list begins, so a piece has the list of one key and then, as its last line, the next
    key. The key of a piece is thus in the piece before it: within a split by a window over the split,
    and for a split's first piece by one over the last pieces of the splits, a row each. Keys with lists on their
    own line stand between a list and the next key; they come as one entry, a mapping, without key.
    """
    place = F.monotonically_increasing_id()
    pieces = spark.read.option("lineSep", f":{ENTRY}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("split"), place.alias("row")).alias("place"))
    ends = pieces.groupBy("file", "place.split").agg(F.max("place").alias("last"), F.min("place").alias("first"), F.max_by(F.substring_index("value", "\n", -1), "place").alias("end"))
    splits = Window.partitionBy("file").orderBy("split")
    ends = ends.select("file", "split", "first", F.lag("end").over(splits).alias("carried"), (F.lead("split").over(splits).isNull()).alias("final"), "last")
    inside = Window.partitionBy("file", "place.split").orderBy("place")
    rows = pieces.withColumn("before", F.lag(F.substring_index("value", "\n", -1)).over(inside)).withColumn("split", F.col("place.split")).join(ends, ["file", "split"])
    key = F.when(F.col("place") == F.col("first"), F.col("carried")).otherwise(F.col("before"))
    # of what follows the list, all but a last piece's is followed by the next key
    begins = F.when(key.isNull(), F.concat(F.lit("\n"), "value")).otherwise(F.col("value"))
    rest = F.regexp_extract(begins, r"\n([^\s\-#][\s\S]*)\z", 1)
    over = F.col("final") & (F.col("place") == F.col("last"))
    rows = rows.select(
        F.trim(key).alias("key"), "value", rest.alias("rest"), over.alias("over")
    )
    lists = F.when(F.col("rest") == "", F.col("value")).otherwise(F.expr("left(value, length(value) - length(rest) - 1)"))
    others = F.when(F.col("over"), F.col("rest")).otherwise(F.regexp_replace("rest", r"(?:\A|\n)[^\n]*\z", ""))
    listed = rows.filter("key is not null").select("key", F.explode(F.split(lists, ENTRY)).alias("entry"))
    inline = rows.select(F.lit(None).cast("string").alias("key"), F.regexp_replace(others, "\n", "\n  ").alias("entry"))
    return listed.unionByName(inline).filter(F.trim("entry") != "")


def parsed_entries(entries: DataFrame, parse: Callable[..., Iterable[tuple]], schema: str) -> DataFrame:
    """Rows of ``parse(entry, *other columns)`` for each entry that is a mapping; an entry that is no YAML stops the job."""
    kept = [c for c in entries.columns if c != "entry"]
    frame = entries.sparkSession.createDataFrame([], schema)
    kinds = to_arrow_schema(frame.schema)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                lines = r["entry"].split("\n")
                data = _load("\n".join(["- " + lines[0], *lines[1:]]))
                if data and isinstance(data[0], dict):
                    out += parse(data[0], *(r[c] for c in kept))
            yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], f.type) for i, f in enumerate(kinds)], schema=kinds)

    return entries.mapInArrow(rows, frame.schema)
