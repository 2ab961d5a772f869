"""Admission of a queue of objects under a ceiling of bytes.

An object that does not fit is refused and takes nothing, so smaller ones behind it may still come in: what is
admitted depends on all decisions before it, and no running sum gives it. Two levels keep that order
without one long task. The queue is ranged into blocks of about ``ROWS`` objects, each with its sum and
its smallest object. Blocks are then decided in order with the bytes used so far: a block that fits as
a whole comes in, one whose smallest object does not fit stays out, and only the others are
walked object by object, one task each. The driver sees a row per block.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROWS = 100_000


def walk(sizes: np.ndarray, used: int, ceiling: int) -> np.ndarray:
    """Which of a queue's objects come in, one after the other."""
    out = np.zeros(len(sizes), bool)
    for i, size in enumerate(sizes.tolist()):
        if used + size <= ceiling:
            used += size
            out[i] = True
    return out


def admit(queue: DataFrame, used: DataFrame, ceiling: int, folder: str, rows: int = ROWS) -> DataFrame:
    """(bucket, key, bytes, admitted) of every object of ``queue`` (bucket, key, bytes, place), in the order of ``place`` and key within each bucket.

    ``used`` has (bucket, total_bytes); a bucket without a row has nothing. ``folder`` takes the blocks
    and the decisions. Objects of zero bytes come in while the bucket is not over its ceiling.
    """
    spark = queue.sparkSession
    # a task ranges ROWS objects at least, and cuts them into its blocks: tasks and files do not grow with the number of blocks
    tasks = max(1, -(-queue.count() // max(rows, ROWS)))
    ranged = queue.select("bucket", "key", "bytes", "place").repartitionByRange(tasks, "bucket", "place", "key").sortWithinPartitions("bucket", "place", "key")
    at = F.monotonically_increasing_id()  # the task in the upper bits, the place within it in the lower 33
    numbered = ranged.withColumn("at", at)
    block = F.shiftleft(F.shiftright("at", 33), 33) + F.floor(F.col("at").bitwiseAND((1 << 33) - 1) / rows)
    numbered.select("bucket", "key", "bytes", "place", block.cast("long").alias("block")).write.mode("overwrite").parquet(f"{folder}/blocks")
    stored = spark.read.schema("bucket string, key string, bytes long, place long, block long").parquet(f"{folder}/blocks")
    taken = {r.bucket: r.total_bytes or 0 for r in used.select("bucket", "total_bytes").collect()}
    whole, mixed = [], []
    sums = stored.groupBy("bucket", "block").agg(F.sum("bytes").alias("total"), F.min("bytes").alias("least")).orderBy("bucket", "block")
    for b in sums.collect():
        at = taken.get(b.bucket, 0)
        if at + b.total <= ceiling or at + b.least > ceiling:
            fits = at + b.total <= ceiling
            whole.append((b.bucket, b.block, fits))
            taken[b.bucket] = at + (b.total if fits else 0)
            continue
        path = f"{folder}/walked/{len(mixed)}"
        queue_of = stored.filter((F.col("block") == b.block) & F.col("bucket").eqNullSafe(b.bucket)).orderBy("place", "key").coalesce(1)
        queue_of.mapInArrow(_walker(at, ceiling), "bucket string, key string, bytes long, admitted boolean").write.mode("overwrite").parquet(path)
        mixed.append(spark.read.schema("bucket string, key string, bytes long, admitted boolean").parquet(path))
        taken[b.bucket] = at + (mixed[-1].filter("admitted").agg(F.sum("bytes")).first()[0] or 0)
    decided = stored.join(spark.createDataFrame(whole, "bucket string, block long, admitted boolean"), ["bucket", "block"]).select("bucket", "key", "bytes", "admitted")
    for part in mixed:
        decided = decided.unionByName(part)
    return decided


def _walker(used: int, ceiling: int):
    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = used
        for batch in batches:
            sizes = np.asarray(batch.column(2))
            fits = walk(sizes, at, ceiling)
            at += int(sizes[fits].sum())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(2), pa.array(fits)], ["bucket", "key", "bytes", "admitted"])

    return decide
