"""WARC archives: writing with revisit records, and a reader that salvages damaged files.

The reader checks every gzip member and every record's block digest.  After a failed check it
searches for the next member or version line that holds a valid record, goes on there, and
logs the bytes between as a quarantined gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercata.llm.support import stored
from mercata.session import scratch_path

FILE_BYTES = 64 << 20      # an archive file is closed at this size
READ_BYTES = 1 << 20
SMALLEST_REVISIT = 1_000   # bytes; shorter payloads are always stored
LEVEL = 3
MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1."
VERSION_LINE = re.compile(rb"WARC/1\.[01]\r\n")
ONCE = ("warc-type", "warc-record-id", "warc-date", "content-length")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


# ---- records ------------------------------------------------------------------
def sha1_32(block: bytes) -> str:
    return base64.b32encode(hashlib.sha1(block).digest()).decode()


def record(kind: str, ident, uri, payload: bytes, digest: str, refers_to) -> bytes:
    """One gzip member holding one record; a revisit keeps the headers and leaves out the payload."""
    block = HTTP % len(payload) + (payload if kind == "response" else b"")
    lines = [
        f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'' if ident is None else ident}>", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}", f"WARC-Block-Digest: sha1:{sha1_32(block)}",
        "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}",
    ]
    if uri is not None:
        lines.append(f"WARC-Target-URI: {quote(uri, safe=':/?#[]@!$&()*+,;=%-._~')}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    head = "WARC/1.1\r\n" + "\r\n".join(lines) + "\r\n\r\n"
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(head.encode() + block + b"\r\n\r\n") + packer.flush()


def parsed(data: bytes, at: int = 0):
    """The record that begins at ``at`` of decompressed bytes: (end, fields, block), or the reason
    why there is none (a string)."""
    if not VERSION_LINE.match(data, at):
        return "no version line"
    head_end = data.find(b"\r\n\r\n", at)
    if head_end < 0:
        return "header without end"
    fields = {}
    for line in data[at:head_end].split(b"\r\n")[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return "malformed header"
        name = name.strip().lower().decode("latin-1")
        if name in fields and name in ONCE:  # a cut record runs into the next one's header
            return "repeated field"
        fields[name] = value.strip().decode("utf-8", "replace")
    length = fields.get("content-length", "")
    if not length.isdigit():
        return "no length"
    start = head_end + 4
    end = start + int(length)
    if data[end:end + 4] != b"\r\n\r\n":
        return "wrong length"
    block = data[start:end]
    stated = fields.get("warc-block-digest", "")
    if stated.startswith("sha1:") and stated[5:] != sha1_32(block):
        return "block digest differs"
    payload = block.partition(b"\r\n\r\n")[2] if fields.get("content-type", "").startswith("application/http") else block
    stated = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") != "revisit" and re.fullmatch(r"sha1:[0-9a-f]{40}", stated):
        if stated[5:] != hashlib.sha1(payload).hexdigest():
            return "payload digest differs"
    return end + 4, fields, payload


# ---- salvage ------------------------------------------------------------------
class Source:
    """Random access to a file's bytes through blocks, so that a file is never held whole."""

    def __init__(self, file, size: int):
        self.file, self.size, self.at, self.block = file, size, 0, b""

    def read(self, start: int, count: int) -> bytes:
        if not (self.at <= start and start + count <= self.at + len(self.block)):
            self.file.seek(start)
            self.at, self.block = start, self.file.read(max(count, READ_BYTES))
        return self.block[start - self.at:start - self.at + count]

    def find(self, start: int, *marks: bytes) -> int:
        """First place from ``start`` on where one of the marks begins, or the size."""
        keep = max(map(len, marks)) - 1
        while start < self.size:
            block = self.read(start, min(READ_BYTES, self.size - start))
            places = [p for p in (block.find(m) for m in marks) if p >= 0]
            if places:
                return start + min(places)
            start += max(1, len(block) - keep) if len(block) > keep else len(block) or self.size
        return self.size


def member(source: Source, start: int):
    """(end, bytes) of the gzip member at ``start``, or the reason why it can't be read."""
    unpacker, parts, at = zlib.decompressobj(31), [], start
    try:
        while not unpacker.eof:
            if at >= source.size:
                return "truncated member"
            block = source.read(at, min(READ_BYTES, source.size - at))
            parts.append(unpacker.decompress(block))
            at += len(block)
    except zlib.error:
        return "damaged member"
    return at - len(unpacker.unused_data), b"".join(parts)


def looks_valid(source: Source, start: int) -> bool:
    head = source.read(start, min(4096, source.size - start))
    if head.startswith(VERSION):
        return True
    try:
        return zlib.decompressobj(31).decompress(head, 64).startswith(VERSION)
    except zlib.error:
        return False


def plain(source: Source, start: int):
    """The uncompressed record at ``start``."""
    count = 1 << 16
    while True:
        data = source.read(start, min(count, source.size - start))
        found = parsed(data)
        if not isinstance(found, str) or start + len(data) >= source.size:
            return found
        head_end = data.find(b"\r\n\r\n")
        stated = re.search(rb"(?im)^content-length:\s*(\d+)\s*$", data[:head_end].replace(b"\r", b"")) if head_end >= 0 else None
        if head_end < 0 and count < READ_BYTES:
            count = READ_BYTES
        elif stated and head_end + 8 + int(stated[1]) > len(data):
            count = head_end + 8 + int(stated[1])
            if start + count > source.size:
                return "truncated record"
        else:
            return found


def salvage(file, size: int) -> Iterator[tuple]:
    """Everything in an archive, in order: ("record", start, end, fields, payload) and
    ("gap", start, end, reason, None)."""
    source, at, bad_from, reason = Source(file, size), 0, None, None
    while at < size:
        head = source.read(at, min(16, size - at))
        good, failed = [], None
        if head.startswith(MAGIC):
            got = member(source, at)
            if isinstance(got, str):
                failed = got
            else:
                end, data = got
                good, failed = inside(data, at, end)
        elif head.startswith(VERSION):
            got = plain(source, at)
            if isinstance(got, str):
                failed = got
            else:
                end = at + got[0]
                good = [("record", at, end, got[1], got[2])]
        else:
            failed = "no member or version line"
        if good:
            if bad_from is not None:
                yield "gap", bad_from, at, reason, None
                bad_from = None
            yield from good
            at = end
            continue
        if bad_from is None:
            bad_from, reason = at, failed
        at = source.find(at + 1, MAGIC, VERSION)
        while at < size and not looks_valid(source, at):
            at = source.find(at + 1, MAGIC, VERSION)
    if bad_from is not None:
        yield "gap", bad_from, size, reason, None


def inside(data: bytes, start: int, end: int):
    """Valid records of a decompressed member (usually one), and gaps between them."""
    out, at, failed, gap = [], 0, None, False
    while at < len(data):
        got = parsed(data, at)
        if isinstance(got, str):
            failed, gap = failed or got, True
            following = VERSION_LINE.search(data, at + 1)
            at = following.start() if following else len(data)
        else:
            out.append(("record", start, end, got[1], got[2]))
            at = got[0]
    if out and gap:
        out.append(("gap", start, end, f"inside a member: {failed}", None))
    return out, failed or "empty member"


# ---- files --------------------------------------------------------------------
def opened(uri: str):
    """(file system, path) of a URI that Spark named."""
    from pyarrow.fs import FileSystem, LocalFileSystem

    if uri.startswith("file:"):
        return LocalFileSystem(), "/" + uri[5:].lstrip("/")
    return FileSystem.from_uri(uri)


def qualified(spark, folder: str) -> str:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toString()


def with_revisits(pages: DataFrame) -> DataFrame:
    """(page_id, url, payload, payload_digest, record_type, refers_to) of pages (page_id, url, html).

    Of equal payloads of at least ``SMALLEST_REVISIT`` bytes the largest page_id is kept as response.  A null
    html is an empty payload.  Rows that share the largest id are all responses, and so are rows of a
    payload that only rows without an id have; a row without an id otherwise revisits."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    each = pages.select("page_id", "url", payload.alias("payload"), F.sha1(payload).alias("payload_digest"))
    long_ones = each.filter(F.length("payload") >= SMALLEST_REVISIT)
    kept = (
        long_ones.groupBy("payload_digest").agg(F.max("page_id").alias("kept"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1 and kept is not null").select("payload_digest", "kept")
    )
    joined = each.join(stored(kept, "warc-kept"), "payload_digest", "left")
    revisit = F.col("kept").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("kept"))
    return joined.select(
        "page_id", "url", "payload", "payload_digest",
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")).alias("record_type"),
        F.when(revisit, F.col("kept")).alias("refers_to"),
    )


def write_archives(records: DataFrame, folder: str) -> DataFrame:
    """Write gzip archives below ``folder`` (one series of files per partition) and return the written
    manifest (path, records, bytes).  A file appears under its name only when it is whole, so a task that
    is run again replaces what its first attempt left."""
    folder = qualified(records.sparkSession, folder)

    def run(batches):
        from pyspark import TaskContext

        task = TaskContext.get()
        fs, base = opened(folder)
        fs.create_dir(base, recursive=True)
        state = {"out": None, "count": 0, "bytes": 0, "n": 0}
        done = []

        def close():
            if state["out"] is not None:
                state["out"].close()
                name = f"{base}/part-{task.partitionId():06d}-{state['n']:04d}.warc.gz"
                fs.move(state["trial"], name)
                done.append((f"{folder}/{name.rsplit('/', 1)[1]}", state["count"], state["bytes"]))
                state.update(out=None, n=state["n"] + 1)

        for batch in batches:
            names = ("record_type", "page_id", "url", "payload", "payload_digest", "refers_to")
            columns = [batch.column(n) for n in names]
            for i in range(batch.num_rows):
                if state["out"] is None:
                    trial = f"{base}/.trial-{task.taskAttemptId()}-{state['n']}"
                    state.update(trial=trial, out=fs.open_output_stream(trial), count=0, bytes=0)
                data = record(*(c[i].as_py() for c in columns))
                state["out"].write(data)
                state.update(count=state["count"] + 1, bytes=state["bytes"] + len(data))
                if state["bytes"] >= FILE_BYTES:
                    close()
        close()
        if done:
            path, count, size = zip(*done)
            yield pa.RecordBatch.from_arrays(
                [pa.array(path), pa.array(count, pa.int64()), pa.array(size, pa.int64())], names=["path", "records", "bytes"]
            )

    return stored(records.mapInArrow(run, "path string, records long, bytes long"), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Records and gaps of the archives named by ``manifest`` (path), one task per file.

    Columns: path, start, end, status ("record" or "gap"), reason, record_type, record_id, uri, refers_to,
    payload_digest (of the bytes read; as stated for a revisit), payload_bytes (null for a revisit),
    payload (null unless asked for)."""
    names = ["path", "start", "end", "status", "reason", "record_type", "record_id", "uri", "refers_to", "payload_digest"]
    types = pa.schema(
        [(n, pa.int64() if n in ("start", "end") else pa.string()) for n in names]
        + [("payload_bytes", pa.int64()), ("payload", pa.binary())]
    )
    ident = lambda text: None if text is None else text.removeprefix("<").removesuffix(">")

    def row(path, status, start, end, what, payload):
        if status == "gap":
            return (path, start, end, status, what) + (None,) * 7
        kind = what.get("warc-type")
        stated = what.get("warc-payload-digest", "").removeprefix("sha1:")
        revisit = kind == "revisit"
        uri = what.get("warc-target-uri")
        return (
            path, start, end, status, None, kind, ident(what.get("warc-record-id")), uri and unquote(uri),
            ident(what.get("warc-refers-to")), stated if revisit else hashlib.sha1(payload).hexdigest(),
            None if revisit else len(payload), payload if payloads and not revisit else None,
        )

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                fs, name = opened(path)
                rows, held = [], 0
                with fs.open_input_file(name) as file:
                    for item in salvage(file, file.size()):
                        rows.append(row(path, *item))
                        held += len(item[4] or b"") if payloads else 0
                        if len(rows) >= 1_000 or held >= FILE_BYTES:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], schema=types)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows), types)], schema=types)

    schema = ", ".join(f"`{n}` {'long' if n in ('start', 'end') else 'string'}" for n in names) + ", payload_bytes long, payload binary"
    files = manifest.select("path")
    return files.repartition(max(1, files.count())).mapInArrow(run, schema)


def archived(pages: DataFrame) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to archives and read them back: page_id, payload_bytes,
    payload_digest (hexadecimal SHA-1), record_type, refers_to.

    A gap in an archive that was just written raises an error.  Empty tables give no rows; other
    columns are ignored; see ``with_revisits`` for nulls and repeated rows."""
    spark = pages.sparkSession
    kind = pages.schema["page_id"].dataType.simpleString()
    manifest = write_archives(with_revisits(pages), scratch_path(spark, "warc"))
    number = lambda c: F.nullif(F.regexp_replace(c, "^urn:page:", ""), F.lit("")).cast(kind)
    back = read_archives(manifest).withColumn(
        "status", F.when(F.col("status") == "gap", F.raise_error(F.lit("an archive is damaged")).cast("string")).otherwise(F.col("status"))
    )
    back = stored(
        back.filter("status = 'record'").select(
            number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
            number(F.col("refers_to")).alias("refers_to"),
        ), "warc-records",
    )
    sizes = (
        back.filter("record_type = 'response' and page_id is not null")
        .groupBy(F.col("page_id").alias("refers_to"), "payload_digest").agg(F.first("payload_bytes").alias("full_bytes"))
    )
    return back.join(sizes, ["refers_to", "payload_digest"], "left").select(
        "page_id", F.coalesce("payload_bytes", "full_bytes").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
