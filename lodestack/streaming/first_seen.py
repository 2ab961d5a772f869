"""First sights of a polled feed as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ingest import first_per_key


def first_sights(events: DataFrame, key: list[str], time: str, look_back: str = "14 days") -> DataFrame:
    """The first row of each key; a key seen again within the look-back of late data is dropped.

    State older than the look-back is forgotten, so it is bounded by the feed's rate. A row counts as too late by the watermark that
    the micro-batch before it began with, as Spark's late filter does.
    """
    return events.withWatermark(time, look_back).dropDuplicatesWithinWatermark(key)


def ingest_available(events: DataFrame, state_path: str, checkpoint: str, key: str, *order: str) -> None:
    """Append the rows of keys that the state has not seen, for all input available now; of a batch's rows with a key the first by ``order``.

    Each micro-batch is anti-joined with the state and appended; a batch that runs again after
    a failure finds its own keys there and adds nothing.
    """

    def append(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        fresh = first_per_key(batch, [key], *order)
        try:
            known = spark.read.parquet(state_path).select(key)
        except Exception as error:  # the first batch finds no state yet
            if "PATH_NOT_FOUND" not in str(error):
                raise
        else:
            fresh = fresh.join(known, key, "left_anti")
        fresh.write.mode("append").parquet(state_path)

    query = events.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def read_events(spark: SparkSession, folder: str, schema, files: int = 16) -> DataFrame:
    """Landed files as a stream, the oldest first, ``files`` in a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
