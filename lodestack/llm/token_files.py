"""Token ids in binary shards: one independent zstandard frame per document, with a seek table.

A shard is a file in the seekable zstandard format. Each document's ids (little-endian, two
bytes if the vocabulary allows it, else four) are one frame. A skippable frame holds the
shard's document index, compressed: id type, ids and token counts. The last skippable frame
is the seek table: compressed size, decompressed size and the low 32 bits of the frame's
XXH64 for every frame, then the number of frames, a descriptor and the format's mark. A
reader gets the tail of the file, and then only the frames of the documents it wants; each
frame's checksum is compared.

Shards hold ranges of the sort column in ascending order; a task writes its shard under a
name of its attempt and renames it, so a task that runs again replaces the same bytes.

Defined results: a null text is empty, with the end id alone. Null ids come first. Rows may
repeat; each is a document of its own, ties in order of text. An empty table gives no shards. A
text of any length is one frame. The format keeps ids as 64-bit integers; ids of a type that
does not fit are an error before anything is written. Other input columns are ignored.
"""

from __future__ import annotations

import struct
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import PieceEncoder, text_slices
from .shared import integral_id, materialize, quoted, shared_folder

# Fixed values of the seekable zstandard format.
SKIPPABLE_INDEX = 0x184D2A50
SKIPPABLE_SEEK = 0x184D2A5E
SEEK_MARK = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

_MANIFEST = "shard int, path string, width int, documents long, tokens long, bytes long"


class ShardWriter:
    """Writes documents' ids, frame after frame, into an open binary stream."""

    def __init__(self, stream, width: int, level: int = 3):
        self.stream, self.width = stream, width
        self.frames: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []
        self.counts: list[int] = []
        self.size = 0
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=False)

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        raw = ids.astype(f"<u{self.width}").tobytes()
        frame = self.zstd.compress(raw)
        self._write(frame)
        self.frames.append((len(frame), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.ids.append(doc_id)
        self.counts.append(len(ids))

    def finish(self) -> None:
        known = np.asarray([x is not None for x in self.ids], np.uint8)
        ids = np.asarray([x or 0 for x in self.ids], "<i8")
        index = self.zstd.compress(struct.pack("<BQ", self.width, len(ids)) + known.tobytes() + ids.tobytes() + np.asarray(self.counts, "<u8").tobytes())
        self._write(struct.pack("<II", SKIPPABLE_INDEX, len(index)) + index)
        table = np.asarray([*self.frames, (len(index) + 8, 0, 0)], "<u4").tobytes()
        footer = struct.pack("<IBI", len(self.frames) + 1, CHECKSUM_FLAG, SEEK_MARK)
        self._write(struct.pack("<II", SKIPPABLE_SEEK, len(table) + len(footer)) + table + footer)


class ShardReader:
    """Reads a shard's tail at once, and frames only as they are asked for."""

    def __init__(self, source):
        self.source = source
        size = source.size()
        frames, flag, mark = struct.unpack("<IBI", source.read_at(9, size - 9))
        if mark != SEEK_MARK or not flag & CHECKSUM_FLAG:
            raise ValueError("not a shard with a seek table and checksums")
        table = np.frombuffer(source.read_at(12 * frames, size - 9 - 12 * frames), "<u4").reshape(-1, 3)
        self.table, self.starts = table[:-1], np.concatenate([[0], np.cumsum(table[:, 0].astype(np.int64))])
        raw = zstandard.ZstdDecompressor().decompress(source.read_at(int(table[-1, 0]) - 8, int(self.starts[-2]) + 8))
        self.width, n = struct.unpack_from("<BQ", raw)
        known = np.frombuffer(raw, np.uint8, n, 9)
        self.counts = np.frombuffer(raw, "<u8", n, 9 + 9 * n).astype(np.int64)
        self.ids = [int(x) if k else None for x, k in zip(np.frombuffer(raw, "<i8", n, 9 + n), known, strict=True)]
        self.zstd = zstandard.ZstdDecompressor()

    def __len__(self) -> int:
        return len(self.ids)

    def _decoded(self, k: int, frame: bytes) -> np.ndarray:
        raw = self.zstd.decompress(frame, max_output_size=int(self.table[k, 1]) or 1)
        if len(raw) != self.table[k, 1] or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.table[k, 2]:
            raise ValueError(f"frame {k} is damaged")
        return np.frombuffer(raw, f"<u{self.width}")

    def document(self, k: int) -> np.ndarray:
        """The ids of the shard's document number ``k``; no other frame is read."""
        return self._decoded(k, self.source.read_at(int(self.table[k, 0]), int(self.starts[k])))

    def documents(self, block: int = 4 << 20):
        """All documents in order, from reads of about ``block`` bytes."""
        k = 0
        while k < len(self):
            to = max(k + 1, int(np.searchsorted(self.starts[: len(self) + 1], self.starts[k] + block, side="right")) - 1)
            data = self.source.read_at(int(self.starts[to] - self.starts[k]), int(self.starts[k]))
            for j in range(k, to):
                at = int(self.starts[j] - self.starts[k])
                yield j, self._decoded(j, data[at : at + int(self.table[j, 0])])
            k = to


def open_store(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path)


def _write_shards(batches, folder: str, tokenizer_path: str, end_id: int, width: int):
    from pyspark import TaskContext

    task = TaskContext.get()
    shard, encoder = task.partitionId(), PieceEncoder.of_worker(tokenizer_path)
    store, root = open_store(folder)
    name = f"{root}/part-{shard:06d}.tokens"
    writer, stream, tokens = None, None, 0
    for batch in batches:
        ids = batch.column(0).to_pylist()
        for at, texts in text_slices(batch.column(1)):
            if writer is None:
                store.create_dir(root, recursive=True)
                stream = store.open_output_stream(f"{name}.{task.taskAttemptId()}")
                writer = ShardWriter(stream, width)
            flat, ends = encoder.encode_slice(texts)
            for k, part in enumerate(np.split(flat, ends[:-1])):
                writer.add(ids[at + k], np.append(part, end_id))
                tokens += len(part) + 1
    encoder.release()
    if writer is not None:
        writer.finish()
        stream.close()
        store.move(f"{name}.{task.taskAttemptId()}", name)
        rows = {"shard": [shard], "path": [f"{folder}/part-{shard:06d}.tokens"], "width": [width], "documents": [len(writer.ids)], "tokens": [tokens], "bytes": [writer.size]}
        yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([("shard", pa.int32()), ("path", pa.string()), ("width", pa.int32()), *((x, pa.int64()) for x in ("documents", "tokens", "bytes"))]))


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write all documents in ascending id order below ``folder``; returns the manifest, one row per shard.

    The one shuffle moves texts by range of id, and of the text's hash where ids are equal. ``folder`` must be one that all executors share.
    """
    from .bpe import load_tokenizer

    width = 2 if max(load_tokenizer(tokenizer_path).get_vocab_size() - 1, end_id) < 1 << 16 else 4
    integral_id(docs, id_col, "token files")
    rows = docs.select(F.col(quoted(id_col)).cast("long").alias("i"), F.col(quoted(text_col)).alias("t"))
    # rows without id, or of one id, are dealt by their text's hash
    rows = rows.withColumn("h", F.xxhash64("t")).repartitionByRange(F.col("i").asc_nulls_first(), "h").sortWithinPartitions(F.col("i").asc_nulls_first(), "h", "t").select("i", "t")
    work = partial(_write_shards, folder=folder, tokenizer_path=tokenizer_path, end_id=end_id, width=width)
    return materialize(rows.mapInArrow(work, _MANIFEST), "token-manifest")


def _read_shards(batches):
    schema = pa.schema([("shard", pa.int32()), ("position", pa.int64()), ("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    for batch in batches:
        for shard, path, before in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            store, file = open_store(path)
            with store.open_input_file(file) as source:
                reader = ShardReader(source)
                starts = before + np.cumsum(reader.counts) - reader.counts
                rows, size = [], 0
                for k, ids in reader.documents():
                    rows.append((shard, k, reader.ids[k], int(starts[k]), len(ids), ids.astype("<u4").tobytes()))
                    size += len(rows[-1][-1])
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_token_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """(shard, position, id, start, n_tokens, ids): every document read back, its ids as little-endian unsigned 32-bit integers.

    ``start`` counts the ids of all documents before it in all shards; the manifest's few
    columns, a row per shard, are added up for that.
    """
    shards = max(1, manifest.count())
    before = F.sum("tokens").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    placed = manifest.select("shard", "path", F.coalesce(before, F.lit(0)).alias("before"))
    return placed.repartitionByRange(shards, "shard").mapInArrow(_read_shards, "shard int, position long, id long, start long, n_tokens long, ids binary")


def new_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "token-files")
