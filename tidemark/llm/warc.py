"""Op 8: WARC archives with a splittable reader.

Writing: each task of :func:`write` writes one ``.warc.gz`` file, a gzip member per record. Equal payloads are
stored once: the record of the largest id is a ``response``, the others are ``revisit`` records that refer to it.

Reading: :func:`read` deals byte ranges of the files to tasks. A task scans its range for the gzip magic,
takes a candidate for a member only if it inflates to a WARC version line and a header block of any length, and
owns the records that start inside its range, reading on beyond it for the last one. Every record has one owner
whatever the split size, and a task holds one record at a time.

Archives are reached with ``pyarrow.fs``, so any folder that all executors share will do. Every attempt of a task
writes a file of its own and moves nothing; the attempts whose results reach the driver are listed in a manifest, written
last, and only listed files are read. Attempts that failed, or ran beside another, leave files that nobody reads, which
are removed with the manifest's writing.

Payloads of revisits are not written, so they are dropped as soon as they are found: where the repeated payloads are few
their digests are sent to all tasks and no payload moves; else rows without payloads are joined, and each distinct payload
moves once.

Cases: a null payload is empty; a null id is written as an empty header; of tied ids, rows that share id and payload are
each a response; an empty table writes no file and reads as an empty table; other columns are ignored. A very long payload
is held whole by the task that writes or reads it, one at a time.
"""

from __future__ import annotations

import base64
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import cut

#: Bytes of a range that one task reads, and of one read call.
SPLIT_BYTES = 8 << 20
READ_BYTES = 1 << 20
MAX_TASKS = 20_000
#: Repeated payloads up to which their digests are sent to all tasks.
BROADCAST_REPEATS = 200_000
MANIFEST, UNFINISHED = "manifest.jsonl", "_unfinished"
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/"
DATE = "2024-01-01T00:00:00Z"

RECORDS = T.StructType(
    [
        T.StructField("file", T.StringType()),
        T.StructField("offset", T.LongType()),
        T.StructField("record_id", T.StringType()),
        T.StructField("record_type", T.StringType()),
        T.StructField("uri", T.StringType()),
        T.StructField("refers_to", T.StringType()),
        T.StructField("payload_digest", T.StringType()),
        T.StructField("payload_bytes", T.LongType()),
        T.StructField("payload", T.BinaryType()),
    ]
)


def sha1_base32(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(record_id: str, uri: str | None, payload: bytes | None, digest: str, size: int, refers_to: str | None = None) -> bytes:
    """One WARC record: a response with the payload, or a revisit of another record without it. Digest and size are those of
    the payload in both."""
    line = (uri or "").replace("\r", "%0D").replace("\n", "%0A")
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {DATE}", f"WARC-Target-URI: {line}"]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <{refers_to}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict | None:
    """The record of an inflated member, or None if it isn't one."""
    head, gap, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not gap or not lines[0].startswith("WARC/"):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    if not fields.get("content-length", "").isdigit():
        return None
    block = rest[: int(fields["content-length"])]
    http, gap, body = block.partition(b"\r\n\r\n") if fields.get("content-type", "").startswith("application/http") else (b"", b"", block)
    kind = fields.get("warc-type", "")
    told = next((x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")), b"")
    return {
        "record_id": fields.get("warc-record-id", "").strip("<>"),
        "record_type": kind,
        "uri": fields.get("warc-target-uri"),
        "refers_to": fields["warc-refers-to"].strip("<>") if "warc-refers-to" in fields else None,
        # A response is measured; a revisit has its payload elsewhere and only tells of it.
        "payload_digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") if kind == "revisit" else sha1_base32(body),
        "payload_bytes": int(told) if kind == "revisit" and told.strip().isdigit() else len(body),
        "payload": None if kind == "revisit" else body,
    }


def record_id(page_id: int | None) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def revisits(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html", min_bytes: int = 0) -> DataFrame:
    """(id, uri, payload binary, refers_to, sha1 binary, size): refers_to is the largest id of an equal payload of
    ``min_bytes`` or more, null for that row itself; the payload of a row that refers to another is null. Equality is by
    SHA-256; tasks pre-aggregate, so no group meets in one place."""
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "utf-8"), F.lit(b""))
    rows = pages.select(F.col(id_col).alias("id"), F.col(uri_col).cast("string").alias("uri"), payload.alias("payload"))
    rows = rows.select("*", F.unhex(F.sha2("payload", 256)).alias("key"), F.unhex(F.sha1("payload")).alias("sha1"), F.octet_length("payload").cast("bigint").alias("size"))
    repeats = rows.where(F.col("size") >= min_bytes).groupBy("key").agg(F.max("id").alias("last"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    repeats = cut(repeats, "warc-repeats")
    refers = F.when(F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to")
    if repeats.count() <= BROADCAST_REPEATS:
        found = rows.join(F.broadcast(repeats), "key", "left").select("id", "uri", "payload", refers, "sha1", "size")
        return found.withColumn("payload", F.when(F.col("refers_to").isNull(), F.col("payload")))
    told = rows.drop("payload").join(repeats, "key", "left").select("key", "id", "uri", refers, "sha1", "size")
    bodies = rows.groupBy("key").agg(F.any_value("payload").alias("payload"))
    full = told.where("refers_to IS NULL").join(bodies, "key")
    return full.unionByName(told.where("refers_to IS NOT NULL").withColumn("payload", F.lit(None).cast("binary"))).select("id", "uri", "payload", "refers_to", "sha1", "size")


def write(rows: DataFrame, path: str) -> None:
    """Write ``revisits``' rows as archives below ``path``, one file a task that has rows, and their manifest."""
    run_name = uuid.uuid4().hex

    def run(batches):
        import pyspark

        fs, folder = pafs.FileSystem.from_uri(path)
        name = f"part-{run_name}-{pyspark.TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}.warc.gz"
        out, size, n = None, 0, 0
        for batch in batches:
            for r in batch.to_pylist():
                if out is None:
                    out = fs.open_output_stream(f"{folder}/{name}", compression=None)
                packer = zlib.compressobj(6, zlib.DEFLATED, 31)
                refers = None if r["refers_to"] is None else record_id(r["refers_to"])
                member = packer.compress(record(record_id(r["id"]), r["uri"], r["payload"], base64.b32encode(r["sha1"]).decode(), r["size"], refers)) + packer.flush()
                out.write(member)
                size, n = size + len(member), n + 1
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([size], pa.int64()), pa.array([n], pa.int64())], names=["file", "bytes", "records"])

    fs, folder = pafs.FileSystem.from_uri(path)
    fs.create_dir(folder, recursive=True)
    fs.open_output_stream(f"{folder}/{UNFINISHED}").close()
    # One row a task: the attempts that counted.
    won = sorted((r.asDict() for r in rows.mapInArrow(run, "file string, bytes bigint, records bigint").collect()), key=lambda r: r["file"])
    with fs.open_output_stream(f"{folder}/{MANIFEST}") as out:
        out.write("".join(json.dumps(r) + "\n" for r in won).encode())
    fs.delete_file(f"{folder}/{UNFINISHED}")
    names = {r["file"] for r in won}
    for f in fs.get_file_info(pafs.FileSelector(folder)):
        if f.base_name.startswith(f"part-{run_name}-") and f.base_name not in names:
            fs.delete_file(f.path)


def archives(path: str) -> list[tuple[str, int]]:
    """(file, bytes) of the archives below ``path``: those of the manifest, or all of a folder that has none."""
    fs, folder = pafs.FileSystem.from_uri(path)
    files = [f for f in fs.get_file_info(pafs.FileSelector(folder, recursive=True)) if f.is_file]
    names = {f.base_name for f in files}
    if UNFINISHED in names and MANIFEST not in names:
        raise ValueError(f"the archives of {path} have not been written to their end")
    if MANIFEST in names:
        with fs.open_input_stream(f"{folder}/{MANIFEST}") as told:
            return [(f"{folder}/{r['file']}", r["bytes"]) for r in map(json.loads, told.read().decode().splitlines())]
    return sorted((f.path, f.size) for f in files if f.size and f.base_name.endswith(".warc.gz") and not f.base_name.startswith("."))


class Window:
    """Bytes of a file from a moving start, read in blocks. Bytes that were passed are let go a block at a time."""

    def __init__(self, file, at: int):
        self.file, self.base, self.held, self.past, self.over = file, at, bytearray(), 0, False

    @property
    def at(self) -> int:
        return self.base + self.past

    def need(self, n: int) -> int:
        """Hold ``n`` bytes from the start on if the file has them; how many there are."""
        while len(self.held) - self.past < n and not self.over:
            more = self.file.read_at(READ_BYTES, self.base + len(self.held))
            self.over = not more
            self.held += more
        return len(self.held) - self.past

    def piece(self, at: int, n: int) -> bytes:
        return bytes(self.held[self.past + at : self.past + at + n])

    def find(self, what: bytes) -> int:
        """Where ``what`` starts among the held bytes, from the start on; -1 if nowhere."""
        found = self.held.find(what, self.past)
        return found - self.past if found >= 0 else -1

    def skip(self, n: int) -> None:
        self.past += n
        if self.past >= READ_BYTES:
            del self.held[: self.past]
            self.base, self.past = self.at, 0


def inflate(window: Window) -> tuple[bytes, int] | None:
    """The whole member at the window's start and its compressed length; None if it's no record.

    Bytes that merely look like a member are told by their first inflated bytes, which must be a version line; what
    begins like a record is read to the end of its header block, however long.
    """
    unpack, out, used = zlib.decompressobj(31), bytearray(), 0
    try:
        while not unpack.eof:
            step = 4096 if used < 1 << 16 else READ_BYTES
            if window.need(used + step) <= used:
                return None  # the file ends inside
            piece = window.piece(used, step)
            out += unpack.decompress(piece)
            used += len(piece) - len(unpack.unused_data)
            if not VERSION.startswith(bytes(out[: len(VERSION)])):
                return None
    except zlib.error:
        return None
    return (bytes(out), used) if b"\r\n\r\n" in out else None


def records_of(file, start: int, end: int) -> Iterator[tuple[int, dict]]:
    """(offset, record) of the records that start in [start, end)."""
    window = Window(file, start)
    while window.at < end:
        window.need(len(MAGIC))
        if window.piece(0, len(MAGIC)) != MAGIC:
            # Look for the next magic; keep two bytes, as one may lie across two reads.
            held = window.need(READ_BYTES)
            found = window.find(MAGIC)
            if found < 0 and window.over:
                return
            window.skip(found if found >= 0 else max(1, held - 2))
            continue
        member = inflate(window)
        parsed = parse(member[0]) if member else None
        if parsed is None:
            window.skip(1)
            continue
        yield window.at, parsed
        window.skip(member[1])


def read(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """One row per record of the archives below ``path``; without ``payloads`` that column is null."""
    files = archives(path)
    if not files:
        return spark.createDataFrame([], RECORDS)
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("size") - 1, F.lit(split_bytes).cast("bigint"))).alias("start")
    told = spark.createDataFrame(files, "file string, size bigint").select("file", "size", start)
    told = told.select("file", "start", F.least(F.col("start") + split_bytes, "size").alias("end"))
    # A task takes one range, or several where there are more ranges than MAX_TASKS.
    told = told.repartition(min(MAX_TASKS, sum(-(-size // split_bytes) for _, size in files)), "file", "start")

    def run(batches):
        fs, _ = pafs.FileSystem.from_uri(path)
        names = RECORDS.names[2:]
        for batch in batches:
            for part in batch.to_pylist():
                with fs.open_input_file(part["file"]) as file:
                    rows, held = [], 0
                    for offset, r in records_of(file, part["start"], part["end"]):
                        held += len(r["payload"] or b"")
                        if not payloads:
                            r["payload"] = None
                        rows.append({"file": part["file"], "offset": offset} | {k: r[k] for k in names})
                        if held > READ_BYTES:
                            yield _batch(rows)
                            rows, held = [], 0
                    if rows:
                        yield _batch(rows)

    return told.mapInArrow(run, RECORDS)


_ARROW = pa.schema([("file", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary())])


def _batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, _ARROW)
