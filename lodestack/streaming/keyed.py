"""Streams with a state per key: running totals that a recount may overwrite, and keys that fell silent."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

TOTALS = "bucket string, total_bytes long, object_count long"


def run_available(rows: DataFrame, mode: str, sink, checkpoint: str) -> None:
    """Hand each micro-batch of the input available now to ``sink(batch, id)``; a run with the same checkpoint goes on from there."""
    rows.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def batch_files(folder: str):
    """A sink that keeps each micro-batch below ``folder``; one that runs again takes the place of its first try."""

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")

    return write


def running_totals(events: DataFrame) -> DataFrame:
    """(bucket, total_bytes, object_count) after each micro-batch, of the buckets that it changed; for the update mode.

    ``events`` has (bucket, kind, seq, bytes, objects). An ``add`` counts up. A ``set`` is a recount: it takes the place of
    all that came before it, by ``seq`` within its micro-batch. The state is a row per bucket.
    """

    def step(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total, objects = state.get if state.exists else (0, 0)
        after, kept = None, []  # the last recount's place, and three numbers of each row that counts up after it
        for rows in chunks:
            recounts = rows[rows.kind == "set"]
            if len(recounts):
                last = recounts.sort_values("seq").tail(1)
                if after is None or last.seq.iloc[0] > after:
                    after, total, objects = int(last.seq.iloc[0]), int(last.bytes.iloc[0]), int(last.objects.iloc[0])
            kept.append(rows.loc[rows.kind == "add", ["seq", "bytes", "objects"]])
        for added in kept:
            counted = added if after is None else added[added.seq > after]
            total, objects = total + int(counted.bytes.sum()), objects + int(counted.objects.sum())
        state.update((total, objects))
        yield pd.DataFrame({"bucket": [key[0]], "total_bytes": [total], "object_count": [objects]})

    return events.groupBy("bucket").applyInPandasWithState(step, TOTALS, "total_bytes long, object_count long", "update", GroupStateTimeout.NoTimeout)


def latest_totals(batches: DataFrame) -> DataFrame:
    """The last row of each bucket of what ``batch_files`` kept of ``running_totals``."""
    last = batches.groupBy("bucket").agg(F.max_by(F.struct("total_bytes", "object_count"), "batch").alias("t"))
    return last.select("bucket", "t.total_bytes", "t.object_count")


def silent_keys(events: DataFrame, hours: int = 24, delay: str = "1 hour", buckets: int = 1024) -> DataFrame:
    """(key, last_at) of each key of ``events`` (key, at) that said nothing for more than ``hours``, once for each silence.

    A silence is told as soon as the watermark, ``delay`` behind the latest event, has passed its length, or when the key returns
    before that. The state holds the keys heard since; a key that was told of is forgotten and starts anew. Rows behind the watermark are dropped.

    Keys, strings or whole numbers, share a state by their hash, as a group costs Python far more than a row. A task holds the keys of one
    of the ``buckets`` at a time; their number belongs to the checkpoint.
    """
    limit = hours * 3_600_000

    def step(bucket: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = dict(zip(*state.get)) if state.exists else {}
        mark, told, heard = state.getCurrentWatermarkMs(), [], []
        if not state.hasTimedOut:
            for chunk in chunks:
                keys = [None] * len(chunk) if bucket[0] < 0 else chunk["key"].tolist()
                heard += zip(chunk["ms"].tolist(), keys)
        for at, key in sorted(heard, key=lambda x: x[0]):
            before = last.get(key, at)
            if at - before > limit:
                told.append((key, before))
            last[key] = max(before, at)
        told += [(key, at) for key, at in last.items() if at + limit < mark]
        last = {key: at for key, at in last.items() if at + limit >= mark}
        if last:
            state.update((list(last.keys()), list(last.values())))
            state.setTimeoutTimestamp(max(min(last.values()) + limit, mark + 1))
        elif state.exists:
            state.remove()
        if told:
            yield pd.DataFrame({"key": pd.Series([key for key, _ in told], dtype=object), "last_ms": [at for _, at in told]})

    # a null key has a bucket of its own, as pandas makes floats of whole numbers beside it
    bucket = F.when(F.col("key").isNull(), -1).otherwise(F.pmod(F.xxhash64("key"), F.lit(buckets))).cast("int")
    rows = events.select("key", "at", F.unix_millis("at").alias("ms"), bucket.alias("bucket")).withWatermark("at", delay)
    kind = events.schema["key"].dataType.simpleString()
    told = rows.groupBy("bucket").applyInPandasWithState(step, f"key {kind}, last_ms long", f"keys array<{kind}>, last array<long>", "append", GroupStateTimeout.EventTimeTimeout)
    return told.select("key", F.timestamp_millis("last_ms").alias("last_at"))
