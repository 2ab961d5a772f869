"""WARC archives of pages, and their capture index by an external merge of sorted runs.

Writing: pages with equal payloads are found by digest; the one with the largest id is a
response, the others revisit it. Each task writes archives of gzip members, one per record,
and to each a run: its index lines sorted by URL key, time and id, with a sparse table of every
``SPARSE``-th key and its place in the file at the end.

Merging: runs are merged k ways by a tree of losers, one comparison per level for each line.
More than ``fan_in`` runs are first merged in groups, a task each, into longer runs. The last
pass deals the keys out by range: each task reads only its range of every run, found by the
runs' sparse tables, and writes one part; the parts in order are the capture histories of all
URLs. Lines are streamed, so a task holds one buffer per run.

Files carry a task's attempt in their name until they are complete and are then renamed, so a
task that runs again writes the same file anew. They lie in the folder given, which all
executors must share.

Defined results: a null html is an empty payload, a null URL an empty one. A null id is never
a response that others revisit, and its record is a response. Rows with equal ids and payloads
give a record each, of the same type. An empty table gives no archives and an empty index.
Ids are 64-bit integers; other types are an error before anything is written. Pages of any
length are one record each, whole. Other input columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import struct
import zlib
from bisect import bisect_left
from collections.abc import Iterator
from datetime import UTC, datetime, timedelta
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .shared import integral_id, materialize, quoted, shared_folder
from .token_files import open_store

SPARSE = 256
FAN_IN = 64
LINES_PER_PART = 500_000
FIRST_CAPTURE = datetime(2024, 1, 1, tzinfo=UTC)

_RUN = "number long, path string, lines long"
_RUN_SCHEMA = pa.schema([("number", pa.int64()), ("path", pa.string()), ("lines", pa.int64())])


def url_key(url: str) -> str:
    """The URL in sort-friendly order: host labels reversed, then path and query, without scheme, user, default port and fragment."""
    m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)([^#]*)", url)
    if not m:
        return re.sub(r"\s", "%20", url.split("#")[0])
    host = m[1].rpartition("@")[2].lower().removesuffix(":80").removesuffix(":443").removeprefix("www.")
    return re.sub(r"\s", "%20", ",".join(reversed(host.split("."))) + ")" + (m[2] or "/"))


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_bytes(page_id, url: str, payload: bytes, digest: str, refers_to, when: datetime) -> bytes:
    """One gzip member with a response, or a revisit that has the response's HTTP headers but no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {when:%Y-%m-%dT%H:%M:%SZ}",
        "WARC-Target-URI: " + re.sub(r"[\x00-\x20]", lambda m: f"%{ord(m[0]):02X}", url),
        f"WARC-Payload-Digest: sha1:{digest}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:x-page:{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]  # noqa: F541
    z = zlib.compressobj(4, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n") + z.flush()


def parse_record(member: bytes) -> dict:
    """What a record says: type, page_id, refers_to, url, digest, payload_bytes, payload (None for a revisit)."""
    raw = zlib.decompress(member, 31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: int(m[1]) if (m := re.fullmatch(r"<urn:x-page:(-?\d+)>", x or "")) else None
    response = fields["WARC-Type"] == "response"
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    return {
        "record_type": fields["WARC-Type"], "page_id": number(fields["WARC-Record-ID"]), "refers_to": number(fields.get("WARC-Refers-To")), "url": fields["WARC-Target-URI"],
        "digest": base32_sha1(payload) if response else fields["WARC-Payload-Digest"].removeprefix("sha1:"), "payload_bytes": len(payload) if response else size, "payload": payload if response else None,
    }


class SharedFile:
    """A file that gets its name when it is complete."""

    def __init__(self, folder: str, name: str):
        from pyspark import TaskContext

        self.store, root = open_store(folder)
        self.store.create_dir(root, recursive=True)
        task = TaskContext.get()
        self.name, self.path = f"{root}/{name}", f"{folder}/{name}"
        self.part = f"{self.name}.{task.taskAttemptId() if task else 0}"
        self.stream, self.size = self.store.open_output_stream(self.part), 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def finish(self) -> str:
        self.stream.close()
        self.store.move(self.part, self.name)
        return self.path


def write_run(folder: str, name: str, lines: Iterator[str]) -> tuple[str, int]:
    """Write sorted lines, then the sparse table and its size; returns the path and the number of lines."""
    file, table, n, buffer, held = SharedFile(folder, name), [], 0, [], 0
    for line in lines:
        if n % SPARSE == 0:
            table.append((line, file.size + held))
        buffer.append(data := line.encode() + b"\n")
        held += len(data)
        n += 1
        if held > 1 << 20:
            file.write(b"".join(buffer))
            buffer, held = [], 0
    file.write(b"".join(buffer))
    end = file.size
    tail = json.dumps(table).encode()
    file.write(tail)
    file.write(struct.pack("<QQ", end, len(tail)))
    return file.finish(), n


def read_run(path: str, low: str | None = None, high: str | None = None, block: int = 1 << 16) -> Iterator[str]:
    """The run's lines from ``low`` on, below ``high``; only the blocks that may have them are read."""
    store, name = open_store(path)
    with store.open_input_file(name) as source:
        at, end = _place(source, low)
        rest = b""
        while at < end or rest:
            data = rest + source.read_at(min(block, end - at), at)
            at = min(end, at + block)
            lines = data.split(b"\n")
            rest = lines.pop()
            for raw in lines:
                line = raw.decode()
                if high is not None and line >= high:
                    return
                if low is None or line >= low:
                    yield line


def _place(source, low: str | None) -> tuple[int, int]:
    """Where reading of a run begins for lines from ``low`` on, and where its lines end. The sparse table goes when this returns: a merge has many runs open."""
    end, tail = struct.unpack("<QQ", source.read_at(16, source.size() - 16))
    if low is None:
        return 0, end
    table = json.loads(source.read_at(tail, end))
    k = bisect_left(table, low, key=lambda entry: entry[0])
    return (table[k - 1][1] if k else 0), end


def sparse_keys(path: str) -> list[str]:
    store, name = open_store(path)
    with store.open_input_file(name) as source:
        size = source.size()
        end, tail = struct.unpack("<QQ", source.read_at(16, size - 16))
        return [line for line, _ in json.loads(source.read_at(tail, end))]


def merge_by_losers(sources: list[Iterator[str]]) -> Iterator[str]:
    """All lines of sorted sources in order, by a tree that keeps at each node the loser of its match."""
    k = len(sources)
    heads = [next(s, None) for s in sources]

    def before(a: int, b: int) -> bool:
        """Whether source a's line goes before source b's; ended sources go last, ties by number."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        return x < y or x == y and a < b

    losers = [0] * max(1, k)  # the winner of all is at 0

    def play(node: int) -> int:
        if node >= k:
            return node - k
        a, b = play(2 * node), play(2 * node + 1)
        winner, losers[node] = (a, b) if before(a, b) else (b, a)
        return winner

    if not k:
        return
    losers[0] = play(1) if k > 1 else 0
    while heads[losers[0]] is not None:
        winner = losers[0]
        yield heads[winner]
        heads[winner] = next(sources[winner], None)
        node = (winner + k) // 2
        while node:
            if before(losers[node], winner):
                winner, losers[node] = losers[node], winner
            node //= 2
        losers[0] = winner


def _write_archives(batches, folder: str, archive_bytes: int, run_lines: int):
    from pyspark import TaskContext

    number = first = TaskContext.get().partitionId() << 20
    file, lines = None, []

    def run() -> pa.RecordBatch:
        path, n = write_run(f"{folder}/runs", f"run-{number:012d}", iter(sorted(lines)))
        lines.clear()
        return pa.RecordBatch.from_pylist([{"number": number, "path": path, "lines": n}], schema=_RUN_SCHEMA)

    for batch in batches:
        for page_id, url, html, refers_to, seconds in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            file = file or SharedFile(folder, archive_name(number))
            payload, url = (html or "").encode(), url or ""
            digest = base32_sha1(payload)
            when = FIRST_CAPTURE + timedelta(seconds=seconds)
            record = record_bytes(page_id, url, payload, digest, refers_to, when)
            entry = {"id": page_id, "url": url, "digest": digest, "type": "response" if refers_to is None else "revisit", "file": number, "offset": file.size, "length": len(record)}
            lines.append(f"{url_key(url)} {when:%Y%m%d%H%M%S} {json.dumps(entry)}")
            file.write(record)
            if file.size >= archive_bytes or len(lines) >= run_lines:
                file.finish()
                yield run()
                file, number = None, number + 1
    if file:
        file.finish()
        yield run()
    assert number < first + (1 << 20)


def archive_name(number: int) -> str:
    return f"pages-{number:012d}.warc.gz"


def write_archives(
    pages: DataFrame, folder: str, min_revisit_bytes: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", seconds_col: str | None = None,
    archive_bytes: int = 1 << 30, run_lines: int = 500_000,
) -> DataFrame:
    """Write the pages' records and sorted index runs; returns the runs' manifest.

    A capture's time is ``seconds_col`` after the first capture, or the id modulo a year.
    Ids and digests are written once to find equal payloads; html moves once, by id. A task
    begins another archive and run at ``archive_bytes`` or ``run_lines``.
    """
    integral_id(pages, id_col, "archives")
    html = F.coalesce(F.col(quoted(html_col)), F.lit(""))
    page = F.col(quoted(id_col)).cast("long")
    seconds = F.col(quoted(seconds_col)) if seconds_col else F.pmod(F.coalesce(page, F.lit(0)), F.lit(31_536_000))
    digest = F.sha1(F.encode(html, "UTF-8")).alias("d")
    rows = pages.select(page.alias("i"), F.col(quoted(url_col)).alias("u"), F.col(quoted(html_col)).alias("h"), digest, seconds.cast("long").alias("s"))
    facts = materialize(pages.filter(page.isNotNull() & (F.octet_length(html) >= min_revisit_bytes)).select(page.alias("i"), digest), "warc-digests").distinct()
    kept = facts.groupBy("d").agg(F.max("i").alias("r"))
    revisits = facts.join(kept, "d").filter("i <> r")
    marked = rows.join(revisits, ["i", "d"], "left").select("i", "u", "h", "r", "s")
    return materialize(marked.mapInArrow(partial(_write_archives, folder=folder, archive_bytes=archive_bytes, run_lines=run_lines), _RUN), "warc-runs")


def _merge_groups(batches, folder: str, level: int):
    for batch in batches:
        for group, paths in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            path, n = write_run(folder, f"run-{level}-{group:06d}", merge_by_losers([read_run(p) for p in sorted(paths)]))
            yield pa.RecordBatch.from_pylist([{"number": group, "path": path, "lines": n}], schema=_RUN_SCHEMA)


def _keys_of(batches):
    for batch in batches:
        for path in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_pydict({"key": sparse_keys(path)}, schema=pa.schema([("key", pa.string())]))


def _merge_ranges(batches, folder: str, paths: list[str]):
    for batch in batches:
        for number, low, high in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            path, n = write_run(folder, f"part-{number:06d}", merge_by_losers([read_run(p, low, high) for p in paths]))
            yield pa.RecordBatch.from_pylist([{"number": number, "path": path, "lines": n}], schema=_RUN_SCHEMA)


def merge_index(spark: SparkSession, runs: DataFrame, folder: str, fan_in: int = FAN_IN, lines_per_part: int = LINES_PER_PART) -> DataFrame:
    """Merge all runs into parts of one global order; returns the parts' manifest (number, path, lines).

    At most ``fan_in`` run paths, and one boundary per part, come to the driver.
    """
    count, lines = runs.agg(F.count("*"), F.coalesce(F.sum("lines"), F.lit(0))).first()
    level = 0
    while count > fan_in:
        groups = -(-count // fan_in)
        placed = runs.withColumn("g", F.row_number().over(Window.orderBy("number")) % groups)  # a row per run
        grouped = placed.groupBy("g").agg(F.collect_list("path").alias("paths")).repartitionByRange(groups, "g")
        runs = materialize(grouped.mapInArrow(partial(_merge_groups, folder=f"{folder}/merged", level=level), _RUN), "warc-runs")
        count, level = runs.count(), level + 1
    paths = [r["path"] for r in runs.orderBy("number").collect()]
    parts = max(1, -(-lines // lines_per_part))
    bounds = []
    if parts > 1:
        keys = runs.select("path").repartitionByRange(max(1, count), "path").mapInArrow(_keys_of, "key string")
        dealt = keys.repartitionByRange(parts, "key").groupBy(F.spark_partition_id().alias("p")).agg(F.min("key").alias("key")).orderBy("key")
        bounds = [r["key"] for r in dealt.collect()][1:]
    ranges = [(k, low, high) for k, (low, high) in enumerate(zip([None, *bounds], [*bounds, None], strict=True))]
    todo = spark.createDataFrame(ranges if paths else [], "number long, low string, high string").repartitionByRange(len(ranges), "number")
    return materialize(todo.mapInArrow(partial(_merge_ranges, folder=f"{folder}/index", paths=paths), _RUN), "warc-index")


_ENTRY = pa.schema([("part", pa.int64()), ("line", pa.int64()), ("url_key", pa.string()), ("captured", pa.string()), ("url", pa.string()), ("page_id", pa.int64()), ("digest", pa.string()), ("record_type", pa.string()), ("file", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])


def _entries(batches):
    for batch in batches:
        for number, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            rows = []
            for k, line in enumerate(read_run(path)):
                key, when, rest = line.split(" ", 2)
                e = json.loads(rest)
                rows.append((number, k, key, when, e["url"], e["id"], e["digest"], e["type"], e["file"], e["offset"], e["length"]))
                if len(rows) == 10_000:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _ENTRY, strict=True)], schema=_ENTRY)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _ENTRY, strict=True)], schema=_ENTRY)


def read_index(parts: DataFrame) -> DataFrame:
    """The index's entries; (part, line) is their place in the global order."""
    types = {"int64": "long", "string": "string"}
    return parts.select("number", "path").repartitionByRange(max(1, parts.count()), "number").mapInArrow(_entries, ", ".join(f"{f.name} {types[str(f.type)]}" for f in _ENTRY))


_RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _read_records(batches, folder: str, with_payload: bool):
    source, opened = None, None
    for batch in batches:
        rows, size = [], 0
        for file, offset, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if file != opened:
                store, root = open_store(folder)
                source, opened = store.open_input_file(f"{root}/{archive_name(file)}"), file
            r = parse_record(source.read_at(length, offset))
            rows.append((r["page_id"], r["url"], r["record_type"], r["refers_to"], r["digest"], r["payload_bytes"], r["payload"] if with_payload else None))
            size += len(rows[-1][-1] or b"") + 200
            if size > 4 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _RECORD, strict=True)], schema=_RECORD)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _RECORD, strict=True)], schema=_RECORD)


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The archived records of the index's entries, each file read in the order of its offsets."""
    places = index.select("file", "offset", "length").repartitionByRange("file", "offset").sortWithinPartitions("file", "offset")
    return places.mapInArrow(partial(_read_records, folder=folder, with_payload=with_payload), "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def new_folder(spark: SparkSession) -> str:
    return shared_folder(spark, "warc")
