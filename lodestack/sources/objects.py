"""Stored objects: listings without their content, dated dumps, and copies that are verified.

Copies are made in tasks. A copy is written under a name of the attempt, read back and compared, and then moved to
its key, so that a key has a whole object or none, whatever attempts failed or ran twice. What went
wrong with a key is its row in the result; it does not end the job.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.text import content_type

CHUNK = 1 << 20
#: Files of a listing's Arrow batch.
LISTED = 10_000
OUTCOME = "key string, outcome string, bytes long, sha256 string, error string"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)


def key_of(path: Column, folder: str) -> Column:
    """The part of a file's path below ``folder``."""
    base = folder.split(":", 1)[-1].lstrip("/").rstrip("/") + "/"
    return F.substring_index(path, base, -1)


def _entries(folders: DataFrame, root: str, inside: bool) -> DataFrame:
    """(key, bytes, modified) of what lies directly in each of ``folders`` (folder, below ``root``): folders, or files that Spark's file scan would find."""

    def entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(root)
        base, kind = base.rstrip("/"), fs.FileType.Directory if inside else fs.FileType.File
        for folder in (x for batch in batches for x in batch.column("folder").to_pylist()):
            found = store.get_file_info(fs.FileSelector(f"{base}/{folder}".rstrip("/")))
            found = [x for x in found if x.type == kind and (inside or x.size) and not _hidden(x.base_name)]
            for i in range(0, len(found), LISTED):
                part = found[i : i + LISTED]
                keys = [x.path[len(base) + 1 :] for x in part]
                modified = [x.mtime_ns // 1000 for x in part]
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([x.size or 0 for x in part], pa.int64()), pa.array(modified, pa.timestamp("us", "UTC"))], ["key", "bytes", "modified"])

    return folders.mapInArrow(entries, "key string, bytes long, modified timestamp")


def _hidden(name: str) -> bool:
    return name.startswith(".") or name.startswith("_") and "=" not in name or name.endswith("._COPYING_")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """(key, bytes, modified, content_type) of the files below ``folder``; no file is opened. As in Spark's file scan, files of zero bytes and hidden ones are left out.

    Folders are listed in tasks, so that only their names pass through the driver and no file's.
    """
    root, level, folders = folder.rstrip("/"), [""], []
    spread = lambda names: spark.createDataFrame([(x,) for x in names], "folder string").repartition(min(len(names), 1000))
    while level:
        folders += level
        level = [r.key for r in _entries(spread(level), root, True).select("key").collect()]
    files = _entries(spread(folders), root, False)
    return files.select("key", "bytes", "modified", content_type(F.col("key")).alias("content_type"))


def objects(spark: SparkSession, folder: str) -> DataFrame:
    """(key, bytes, sha256, modified) of the files below ``folder``, read for their digests."""
    files = _files(spark, folder)
    return files.select(key_of(F.col("path"), folder).alias("key"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), F.col("modificationTime").alias("modified"))


def read_object(spark: SparkSession, folder: str, key: str) -> DataFrame:
    """(key, content) of one object, found by its path without a listing."""
    return spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{key}").select(F.lit(key).alias("key"), "content")


def dump(df: DataFrame, folder: str, day: str) -> str:
    """A dated, compressed copy of a table as JSON lines; returns where it lies. One that is made again takes the place of the first."""
    name = df.sparkSession.range(1).select(dates.backup_key(F.lit(day).cast("date")).alias("k")).first()["k"]
    path = f"{folder.rstrip('/')}/{name}"
    df.write.mode("overwrite").option("compression", "gzip").json(path)
    return path


def _digest(store: fs.FileSystem, path: str) -> tuple[int, str]:
    size, digest = 0, hashlib.sha256()
    with store.open_input_stream(path) as stream:
        while chunk := stream.read(CHUNK):
            size += len(chunk)
            digest.update(chunk)
    return size, digest.hexdigest()


def _place(store: fs.FileSystem, path: str, chunks: Iterator[bytes], expected: str | None, made: set[str]) -> tuple[int, str]:
    """Write ``chunks`` beside ``path``, check what can be read back, and move it there; ``made`` are the folders made by now."""
    attempt, written, parent = f"{path}.attempt-{uuid.uuid4().hex}", hashlib.sha256(), path.rsplit("/", 1)[0]
    if parent not in made:
        store.create_dir(parent, recursive=True)
        made.add(parent)
    try:
        with store.open_output_stream(attempt) as stream:
            for chunk in chunks:
                written.update(chunk)
                stream.write(chunk)
        size, digest = _digest(store, attempt)
        if digest != written.hexdigest() or expected not in (None, digest):
            raise OSError(f"the content's digest is {digest}, not {expected or written.hexdigest()}")
        store.move(attempt, path)
    except BaseException:
        if store.get_file_info(attempt).type != fs.FileType.NotFound:
            store.delete_file(attempt)
        raise
    return size, digest


def _outcomes(batches: Iterator[pa.RecordBatch], one) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in OUTCOME.split(", ")]
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            try:
                rows.append((row["key"], *one(row), None))
            except Exception as error:
                rows.append((row["key"], "failed", None, None, f"{type(error).__name__}: {error}"[:500]))
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64() if i == 2 else pa.string()) for i in range(5)], names)


def copy_objects(entries: DataFrame, source: str, target: str, tasks: int = 64) -> DataFrame:
    """(key, outcome, bytes, sha256, error) of every entry (key, sha256): ``copied``, ``present`` or ``failed``.

    An entry with a digest is present where the target's object has that digest; one without, where there is any object.
    What is copied must have the entry's digest. Objects are streamed in chunks, whatever their size.
    """

    def copies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, base = fs.FileSystem.from_uri(source)
        there, goal = fs.FileSystem.from_uri(target)
        made: set[str] = set()

        def one(row):
            path = f"{goal.rstrip('/')}/{row['key']}"
            if there.get_file_info(path).type == fs.FileType.File:
                size, digest = _digest(there, path)
                if row["sha256"] in (None, digest):
                    return "present", size, digest
            with here.open_input_stream(f"{base.rstrip('/')}/{row['key']}") as stream:
                return "copied", *_place(there, path, iter(lambda: stream.read(CHUNK), b""), row["sha256"], made)

        yield from _outcomes(batches, one)

    # a key's copies must not race: each key is one row of one task
    return entries.select("key", "sha256").dropDuplicates(["key"]).repartition(tasks, "key").mapInArrow(copies, OUTCOME)


def put_objects(contents: DataFrame, target: str, tasks: int = 64) -> DataFrame:
    """(key, outcome, bytes, sha256, error) of every row (key, content), stored: ``copied`` or ``failed``. Rows are dealt to ``tasks``, however few files they come from."""

    def puts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        there, goal = fs.FileSystem.from_uri(target)
        made: set[str] = set()
        yield from _outcomes(batches, lambda row: ("copied", *_place(there, f"{goal.rstrip('/')}/{row['key']}", iter([row["content"]]), None, made)))

    return contents.select("key", F.col("content").cast("binary").alias("content")).repartition(tasks, "key").mapInArrow(puts, OUTCOME)


def rederive(entries: DataFrame, contents: DataFrame, spark: SparkSession, target: str) -> DataFrame:
    """As ``put_objects``, for the keys of ``entries`` that the target lacks, from ``contents`` (key, content) made anew; a key without content fails."""
    missing = entries.select("key").distinct().join(listing(spark, target).select("key"), "key", "left_anti")
    rows = missing.join(contents, "key", "left")
    none = rows.filter("content is null").select("key", F.lit("failed").alias("outcome"), F.lit(None).cast("long").alias("bytes"), F.lit(None).cast("string").alias("sha256"), F.lit("no content").alias("error"))
    return put_objects(rows.filter("content is not null"), target).unionByName(none)
