"""WARC archives: record writer with revisits and a splittable reader (operator 3).

Every record is its own gzip member. The reader deals byte ranges to tasks; a task scans its
range for the gzip magic, accepts a candidate only if it decodes to a WARC header, and owns the
records that start inside its range, however far they reach beyond it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

#: An empty gzip member; stands between records as the writer's row separator.
EMPTY_MEMBER = bytes.fromhex("1f8b08000000000000ff" "0300" "0000000000000000")
MAGIC = b"\x1f\x8b\x08"
DATE = "2024-01-01T00:00:00Z"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _gzip(data: bytes, level: int) -> bytes:
    c = zlib.compressobj(level, zlib.DEFLATED, 31)
    return c.compress(data) + c.flush()


def record(kind: str, record_id: str, uri: str | None, payload: bytes, digest: str, refers_to: str | None, date: str) -> bytes:
    """One WARC/1.1 record. A revisit carries the HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = [f"WARC-Type: {kind}", f"WARC-Record-ID: <{record_id}>", f"WARC-Date: {date}"]
    if uri is not None:
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", uri))
    if kind == "revisit":
        head += [f"WARC-Profile: {_REVISIT}", f"WARC-Refers-To: <{refers_to}>"]
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "WARC/1.1\r\n".encode() + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


_CHECKED: set[str] = set()


def _check_writer(spark: SparkSession) -> None:
    """Raise unless Spark's text writer copies a string's bytes and the separator as they are."""
    if spark.sparkContext.applicationId in _CHECKED:
        return
    path, data = f"{scratch_dir(spark)}/bytes", bytes(range(256))
    row = spark.range(1, numPartitions=1).select(F.unhex(F.lit(data.hex())).cast("string"))
    row.write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)
    got = spark.read.format("binaryFile").load(path).where("length > 0").select("content").collect()
    if [bytes(r.content) for r in got] != [data + EMPTY_MEMBER]:
        raise RuntimeError("this Spark's text writer changes bytes; archives can't be written with it")
    _CHECKED.add(spark.sparkContext.applicationId)


def write(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_revisit_bytes: int = 0, level: int = 1, date: str = DATE) -> None:
    """Write one record per row of ``pages`` below ``path``, on any file system Spark can write.

    Payload: the column in UTF-8, null as empty. Among rows with equal payloads of at least
    ``min_revisit_bytes`` those with the largest id are responses, all others revisit it. Rows
    that repeat id and payload get equal records; a null id is the smallest and written as an
    empty id. Payloads meet only by digest: the group maximum is aggregated before the
    shuffle, and only ids and digests take part in the join that a common payload skews. An
    empty table writes no record. Spark's commit protocol makes retried tasks safe.
    """
    text: Column = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    base = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).cast("string").alias("url"), text.alias("payload"))
    keys = base.where(F.octet_length("payload") >= min_revisit_bytes).select("id", F.sha1(F.col("payload").cast("binary")).alias("digest"))
    top = keys.groupBy("digest").agg(F.max("id").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1 and top is not null").select("digest", "top")
    again = keys.join(top, "digest").where("id is null or id < top").distinct()
    again = again.select(F.coalesce("id", F.lit(-1)).alias("k"), F.col("id").isNull().alias("z"), F.col("digest").alias("d"), "top")
    full = base.withColumn("digest", F.sha1(F.col("payload").cast("binary")))
    full = full.join(again, (F.coalesce(full["id"], F.lit(-1)) == again["k"]) & (full["id"].isNull() == again["z"]) & (full["digest"] == again["d"]), "left")

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part, out = b.slice(at, 256), []
                for i, url, payload, top_id in zip(*(part.column(k).to_pylist() for k in range(4)), strict=True):
                    data = payload.encode() if isinstance(payload, str) else payload
                    kind = "response" if top_id is None else "revisit"
                    name = "" if i is None else i
                    out.append(_gzip(record(kind, f"urn:row:{name}", url, data, base32_sha1(data), f"urn:row:{top_id}", date), level))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    rows = full.select("id", "url", "payload", "top").mapInArrow(members, "value binary")
    # Spark's text writer copies a string's bytes as they are, so members reach the file unchanged.
    _check_writer(pages.sparkSession)
    rows.select(F.col("value").cast("string")).write.option("lineSep", EMPTY_MEMBER.decode("latin-1")).option("encoding", "ISO-8859-1").text(path)


def _place(path: str):
    """(file system, path in it) of a path as Spark writes it; raises where pyarrow knows no such system."""
    from pyarrow import fs

    if path.startswith("file:") or "://" not in path and not path.startswith("dbfs:"):
        return fs.LocalFileSystem(), re.sub(r"^file:/*", "/", path)
    if path.startswith("dbfs:"):
        return fs.LocalFileSystem(), "/dbfs/" + path.removeprefix("dbfs:").lstrip("/")
    return fs.FileSystem.from_uri(re.sub(r"^s3[an]://", "s3://", path))


def _opener(path: str):
    system, inner = _place(path)
    return system.open_input_file(inner)


class _Held:
    """A file whose bytes Spark has read."""

    def __init__(self, data: bytes) -> None:
        self.data = data

    def size(self) -> int:
        return len(self.data)

    def read_at(self, n: int, at: int) -> bytes:
        return self.data[at : at + n]

    def __enter__(self) -> _Held:
        return self

    def __exit__(self, *_: object) -> None:
        return None


class _Window:
    """Bytes of a file by absolute position, read ahead in steps and let go behind."""

    def __init__(self, file, at: int, step: int = 4 << 20) -> None:
        self.file, self.base, self.data, self.step = file, at, b"", step
        self.end = file.size()

    def more(self) -> bool:
        got = self.file.read_at(min(self.step, self.end - self.base - len(self.data)), self.base + len(self.data)) if self.base + len(self.data) < self.end else b""
        self.data += got
        return bool(got)

    def forget(self, before: int) -> None:
        if before - self.base > self.step:
            self.data, self.base = self.data[before - self.base :], before


def _decode(win: _Window, at: int) -> tuple[bytes, int] | None:
    """The member at ``at`` as (content, position after it) if it holds WARC records."""
    d, out, pos, seen = zlib.decompressobj(31), [], at, 0
    try:
        while not d.eof:
            if pos - win.base >= len(win.data) and not win.more():
                return None
            part = win.data[pos - win.base : pos - win.base + (1 << 16)]
            got = d.decompress(part)
            pos += len(part)
            out.append(got)
            seen += len(got)
            if seen >= 5 and not b"".join(out[:8])[:5] == b"WARC/":
                return None
    except zlib.error:
        return None
    content = b"".join(out)
    return (content, pos - len(d.unused_data)) if content.startswith(b"WARC/") else None


def _records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    at = 0
    while content.startswith(b"WARC/", at):
        end = content.find(b"\r\n\r\n", at)
        if end < 0:
            return
        lines = content[at:end].decode("utf-8", "replace").split("\r\n")
        head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
        if not head.get("content-length", "").isdigit():
            return
        body = end + 4
        at = body + int(head["content-length"])
        yield head, content[body:at]
        while content[at : at + 2] == b"\r\n":
            at += 2


def scan_range(path: str, start: int, stop: int, data: bytes | None = None) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(position, header, block) of the records whose member starts in [start, stop) of a file."""
    with _opener(path) if data is None else _Held(data) as file:
        win, at = _Window(file, start), start
        while at < stop:
            i = win.data.find(MAGIC, at - win.base)
            if i < 0:
                at = max(at, win.base + len(win.data) - len(MAGIC) + 1)
                if at >= stop or not win.more():
                    return
                continue
            at = win.base + i
            if at >= stop:
                return
            if (found := _decode(win, at)) is None:
                at += 1
                continue
            for head, block in _records(found[0]):
                yield at, head, block
            at = found[1]
            win.forget(at)


def _payload(head: dict[str, str], block: bytes) -> tuple[bytes | None, int]:
    """(payload or None where the record leaves it out, its full length)."""
    if head.get("content-type", "").startswith("application/http"):
        http, cut, body = block.partition(b"\r\n\r\n")
        if head.get("warc-type") == "revisit":
            m = re.search(rb"(?im)^content-length:\s*(\d+)", http)
            return None, int(m[1]) if m else 0
        return (body if cut else b""), len(body)
    return block, len(block)


_OUT = "file string, offset long, record_id string, record_type string, target_uri string, refers_to string, payload_bytes long, payload_digest string, digest_ok boolean, payload binary"


def read(spark: SparkSession, path: str, split_bytes: int = 16 << 20, with_payload: bool = True) -> DataFrame:
    """Records of the gzip WARC files below ``path``, one row each.

    ``payload_digest`` is the bare base32 SHA-1, computed from the payload of a response and
    taken from the header of a revisit; ``digest_ok`` says whether header and payload agree
    (null where either is missing). Bytes that are no WARC member are passed over. Spark lists
    the files without reading them; a task holds one range and one record at a time. Tasks open
    files through pyarrow (local, HDFS, S3, GCS, Azure); of a store that only Spark's readers
    know, a task takes whole files, which then may have 2 GB at most.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    try:
        _place(path)
        whole = False
    except (ValueError, OSError, NotImplementedError):
        whole = True
    if whole:
        ranges = files.where("length > 0").select("path", F.lit(0).cast("long").alias("start"), "content")
    else:
        files = files.select("path", "length").where("length > 0")
        ranges = files.select("path", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))).alias("start"))
        ranges = ranges.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["file", "offset", "record_id", "record_type", "target_uri", "refers_to", "payload_bytes", "payload_digest", "digest_ok", "payload"]
        types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
        rows, held = [], 0
        for b in batches:
            for k, (file, start) in enumerate(zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)):
                data = b.column(2)[k].as_py() if whole else None
                for at, head, block in scan_range(file, start, len(data) if whole else start + split_bytes, data):
                    payload, n = _payload(head, block)
                    stated = head.get("warc-payload-digest", "").removeprefix("sha1:") or None
                    digest = stated if payload is None else base32_sha1(payload)
                    rows.append((file, at, head.get("warc-record-id", "").strip("<>"), head.get("warc-type"), head.get("warc-target-uri"), head.get("warc-refers-to", "").strip("<>") or None, n, digest, None if payload is None or stated is None else stated == digest, payload if with_payload else None))
                    held += n if with_payload else 100
                    if held > 4 << 20 or len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
                        rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return ranges.mapInArrow(scan, _OUT)
