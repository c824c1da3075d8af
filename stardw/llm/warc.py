"""WARC archives: a writer of per-record gzip members and a splittable reader.

Every record is a gzip member of its own.  The reader deals byte ranges of the
archives to tasks; a task looks for the gzip magic in its range, takes a
candidate for a member only if it decodes to a WARC header and ends where the
file ends or another member's magic stands, and owns the records that *start*
in its range, reading beyond it to finish the last one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stardw.llm.components import stored

MAGIC = b"\x1f\x8b\x08"
#: A task starts another archive beyond so many bytes.
ARCHIVE_BYTES = 256 << 20
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORD = ("page_id long, record_type string, url string, payload string, payload_bytes long, payload_digest string, "
          "refers_to long, archive string, position long")


def open_store(path: str):
    """The file system of a shared path, and the path within it."""
    from pyarrow import fs
    if path.startswith("file:/") and not path.startswith("file://"):
        path = "file://" + path[5:]
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}')}>"


def encode_record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, date: str) -> bytes:
    """One record, uncompressed; a revisit (``refers_to`` given) has the HTTP
    headers, whose Content-Length is the full payload's, but no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page_id)}",
            f"WARC-Date: {date}", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c.isprintable() else "".join(f"%{b:02X}" for b in c.encode()) for c in url))
    if page_id is not None:
        head.append(f"Page-ID: {page_id}")
    if refers_to is not None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(refers_to)}", f"Refers-To-Page-ID: {refers_to}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(head).encode() + block + b"\r\n\r\n"


def member(record: bytes, level: int = 6) -> bytes:
    z = zlib.compressobj(level, zlib.DEFLATED, 31)
    return z.compress(record) + z.flush()


def decode_record(data: bytes) -> tuple[dict[str, str], bytes] | None:
    """Headers (lower-case names) and block; None if it is no whole record."""
    head, mark, rest = data.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not mark or not lines[0].startswith("WARC/1."):
        return None
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    size = fields.get("content-length", "")
    if not size.isdigit() or len(rest) != int(size) + 4 or rest[-4:] != b"\r\n\r\n":
        return None
    return fields, rest[:-4]


def _member_at(read, size: int, at: int) -> tuple[bytes, int] | None:
    """The decoded member at ``at`` and where it ends; None if there is none."""
    z, out, pos, step = zlib.decompressobj(31), [], at, 1 << 12
    known = False
    try:
        while not z.eof:
            data = read(pos, step)
            if not data:
                return None
            out.append(z.decompress(data))
            pos += len(data)
            step = 1 << 16
            if not known and sum(map(len, out)) >= 7:
                if not b"".join(out).startswith(b"WARC/1."):
                    return None
                known = True
    except zlib.error:
        return None
    end = pos - len(z.unused_data)
    if end < size and not MAGIC.startswith(read(end, 3)[:3] or b"?"):
        return None
    return b"".join(out), end


def read_range(f, size: int, start: int, end: int) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, headers, block) of the records that start in [start, end)."""
    buffer = f.read_at(min(end + 2, size) - start, start)

    def read(pos: int, n: int) -> bytes:
        if pos + n <= start + len(buffer):
            return buffer[pos - start:pos - start + n]
        return f.read_at(min(n, size - pos), pos) if pos < size else b""
    at = start
    while at < end:
        at = buffer.find(MAGIC, at - start)
        if at < 0 or at + start >= end:
            return
        at += start
        got = _member_at(read, size, at)
        record = got and decode_record(got[0])
        if record:
            yield at, *record
            at = got[1]
        else:
            at += 1


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                   revisit_from: int = 0, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Writes a record per row under the shared folder ``path``; returns the
    stored list ``archive, bytes, records`` of the archives that count.

    The payload is the html in UTF-8 (null: empty).  Of rows with equal
    payloads (SHA-256) of at least ``revisit_from`` bytes, that with the
    smallest id is the response and the others revisit it; rows that repeat
    the smallest id are responses as well; null ids come last.  A null url
    leaves the header out; other columns are ignored; an empty table writes
    nothing.  A task that runs again writes new files, and only those of the
    attempt that Spark commits are listed.  Ids are integers.
    """
    html = F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), html.alias("html"),
                        F.sha2(html.cast("binary"), 256).alias("content"))
    firsts = (pages.select(F.col(id_col).cast("long").alias("page_id"), html.alias("html")).where(F.octet_length("html") >= revisit_from)
              .groupBy(F.sha2(F.col("html").cast("binary"), 256).alias("content")).agg(F.min("page_id").alias("first")))
    linked = rows.join(firsts, "content", "left").select(
        "page_id", "url", "html", F.when(~F.col("first").eqNullSafe(F.col("page_id")), F.col("first")).alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, out, name, size, n = [], None, "", 0, 0
        for batch in batches:
            for page_id, url, text, refers_to in zip(*(batch.column(x).to_pylist() for x in ("page_id", "url", "html", "refers_to")), strict=True):
                if out is None:
                    store, top = open_store(path)
                    store.create_dir(top, recursive=True)
                    name, size, n = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = store.open_output_stream(f"{top}/{name}", compression=None)
                data = member(encode_record(page_id, url, text.encode("utf-8", "replace"), refers_to, date))
                out.write(data)
                size, n = size + len(data), n + 1
                if size > ARCHIVE_BYTES:
                    out.close()
                    done.append((name, size, n))
                    out = None
        if out is not None:
            out.close()
            done.append((name, size, n))
        if done:
            a, b, c = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b, pa.int64()), pa.array(c, pa.int64())], ["archive", "bytes", "records"])
    return stored(linked.mapInArrow(run, "archive string, bytes long, records long"), "warc-archives")


#: Tasks that read splits, at most; beyond it a task reads several.
READ_TASKS = 20_000


def read_archives(spark: SparkSession, archives: DataFrame, path: str, split_bytes: int = 16 << 20, payloads: bool = True) -> DataFrame:
    """A row per record of ``archives`` (``archive, bytes``) under ``path``:
    page_id, record_type, url, payload, payload_bytes, payload_digest,
    refers_to, archive, position.

    ``payload_bytes`` and ``payload_digest`` describe the full payload: a
    response's are measured on what was read, a revisit's come from its
    headers.  Without ``payloads`` that column is null.  Bytes that belong to
    no valid member are skipped; no archives give no rows.
    """
    splits = archives.where("bytes > 0").select(
        "archive", "bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))).alias("start"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("page_id", pa.int64()), ("record_type", pa.string()), ("url", pa.string()), ("payload", pa.string()),
                            ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to", pa.int64()),
                            ("archive", pa.string()), ("position", pa.int64())])
        store, top = open_store(path)
        for batch in batches:
            for name, size, start in zip(*(batch.column(x).to_pylist() for x in ("archive", "bytes", "start")), strict=True):
                rows, held = [], 0
                with store.open_input_file(f"{top}/{name}") as f:
                    for at, fields, block in read_range(f, size, start, min(size, start + split_bytes)):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        kind = fields.get("warc-type")
                        page, refers = fields.get("page-id"), fields.get("refers-to-page-id")
                        if kind == "response":
                            n, sha = len(payload), digest(payload)
                        else:
                            told = [x.split(b":")[1] for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
                            n, sha = int(told[0]) if told else None, fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        text = payload.decode("utf-8", "replace") if payloads and kind == "response" else None
                        rows.append((page and int(page), kind, fields.get("warc-target-uri"), text, n, sha, refers and int(refers), name, at))
                        held += len(payload)
                        if held > 4 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
    # a task for each split, up to READ_TASKS: a number that is asked for is not merged into fewer by size
    tasks = splits.count()
    return splits.repartition(max(1, min(tasks, READ_TASKS)), "archive", "start").mapInArrow(run, RECORD)
