"""WARC archives of gzip members, written with revisit records and read in splits (operator 2).

The reader deals byte ranges of the files to tasks. A task scans its range for the gzip magic, takes a place
for a member if what it inflates to begins with a WARC version line and a full block of header fields, and from there on
goes from member to member. It owns the records that start inside its range, and reads beyond the range's end to finish
the last one.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._shared import cut, qualified, scratch_path, shuffle_width

MAGIC = b"\x1f\x8b\x08"
#: Payloads of fewer bytes are stored again rather than referred to.
LEAST_REVISIT = 1000
#: Bytes of a file that are a range with records of its own, and bytes that a reading task gets, in several ranges, where there are more than tasks.
SPLIT, TASK = 16 << 20, 128 << 20
#: Bytes read or handed on at once.
BLOCK = 1 << 20
#: Bytes that are inflated at once to see whether a member begins a record.
HEAD = 16 << 10
#: Records are dated so unless a column says otherwise; the same input gives the same archive.
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS = T.StructType([
    T.StructField("path", T.StringType()), T.StructField("offset", T.LongType()), T.StructField("record_type", T.StringType()),
    T.StructField("headers", T.MapType(T.StringType(), T.StringType())), T.StructField("payload", T.BinaryType()),
])


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a URI, or of a plain local path, as tasks open it."""
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else path.replace("file:", "file://", 1))
    return pafs.LocalFileSystem(), path


def roles(pages: DataFrame, page_id: str = "page_id", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """pages with payload (UTF-8; null html: empty), payload_digest (SHA-1) and refers_to.

    refers_to is the largest page_id among rows of equal payload, where that is another and the payload has at
    least `least` bytes; else null. Rows that repeat the largest page_id are responses all of them; so is a row without a page_id,
    which nothing refers to.
    """
    payload, digest = F.coalesce(F.encode(F.col(html), "UTF-8"), F.lit(b"")), F.sha1("payload")
    rows = pages.withColumn("payload", payload).withColumn("payload_digest", digest)
    # digests meet without payloads; payloads then meet their revisits by page, a key that no page shares with others
    large = pages.select(F.col(page_id).alias("page_id"), payload.alias("payload")).filter(F.octet_length("payload") >= least).select("page_id", digest.alias("payload_digest"))
    latest = large.groupBy("payload_digest").agg(F.max("page_id").alias("latest"), F.count("*").alias("n")).filter("n > 1").drop("n")
    old = large.join(latest, "payload_digest").filter("page_id < latest").select(F.col("page_id").alias("of"), F.col("payload_digest").alias("as"), F.col("latest").alias("refers_to")).distinct()
    return rows.drop("refers_to").join(old, (F.col(page_id) == F.col("of")) & (F.col("payload_digest") == F.col("as")), "left").drop("of", "as")


def record(kind: str, page: str, url: str, payload: bytes, digest: str, refers_to: str | None) -> bytes:
    """One record, not yet compressed. A revisit leaves the payload out and states its length in a field of its own."""
    fields = [
        ("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x-page:{page}>"), ("WARC-Date", DATE), ("WARC-Target-URI", url),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()), ("X-Payload-Length", str(len(payload))),
    ]
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<urn:x-page:{refers_to}>"), ("WARC-Profile", PROFILE)]
    block = head if kind == "revisit" else head + payload
    fields += [("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    lines = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return b"WARC/1.1\r\n" + lines.encode("utf-8", "surrogatepass") + b"\r\n" + block + b"\r\n\r\n"


def clean(value: str | None) -> str:
    """A header value on one line."""
    return " ".join((value or "").split())


def gzip_member(data: bytes, level: int) -> bytes:
    packer = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def write(rows: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", level: int = 4) -> DataFrame:
    """Write what roles() gives as one archive a task under folder; a DataFrame of path, length and n_records. A folder without a scheme is one
    of the cluster's own file system, as for Spark's writers.

    A task writes under a name of its own attempt and lists it only when the file is closed, so files of lost or repeated
    attempts are never read. Tasks without rows write no file.
    """
    folder = qualified(rows.sparkSession, folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, place = filesystem(folder)
        out = path = None
        n = length = 0
        for batch in batches:
            for k in range(batch.num_rows):
                page, uri, payload, digest, refers = (batch.column(c)[k].as_py() for c in ("page_id", "url", "payload", "payload_digest", "refers_to"))
                if out is None:
                    store.create_dir(place, recursive=True)
                    path = f"{uuid.uuid4().hex}.warc.gz"
                    out = store.open_output_stream(f"{place}/{path}", compression=None)
                member = gzip_member(record("response" if refers is None else "revisit", "" if page is None else str(page), clean(uri), payload, digest, None if refers is None else str(refers)), level)
                out.write(member)
                n, length = n + 1, length + len(member)
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{path}"]), pa.array([length]), pa.array([n])], ["path", "length", "n_records"])

    named = rows.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), "payload", "payload_digest", F.col("refers_to").alias("refers_to"))
    return cut(named.mapInArrow(run, "path string, length bigint, n_records bigint"), "files")


class Window:
    """A file seen through a buffer that moves on."""

    def __init__(self, file, length: int, at: int):
        self.file, self.length, self.start, self.data = file, length, at, b""

    def bytes_at(self, at: int, n: int) -> bytes:
        """n bytes from at, fewer only at the file's end; what lies before at is let go."""
        if at < self.start or at > self.start + len(self.data):
            self.start, self.data = at, b""
        if at + n > self.start + len(self.data):
            kept = self.data[at - self.start :]
            self.file.seek(at + len(kept))
            self.start, self.data = at, kept + self.file.read(min(max(n - len(kept), BLOCK), max(0, self.length - at - len(kept))))
        return self.data[at - self.start : at - self.start + n]


def head_of(window: Window, at: int) -> bool:
    """Whether a gzip member of a WARC record begins at a place: it inflates to a version line and a whole header, however long."""
    unpack, text, here, seen = zlib.decompressobj(31), bytearray(), at, 0
    try:
        while not unpack.eof:
            data = window.bytes_at(here, HEAD)
            if not data:
                return False
            text += unpack.decompress(data)
            here += len(data)
            if not text.startswith(b"WARC/"[: len(text)]):
                return False
            end = text.find(b"\r\n\r\n", max(0, seen - 3))
            if end > 0:
                return b"\r\nWARC-Type:" in text[:end] and b"\r\nContent-Length:" in text[:end]
            seen = len(text)
    except zlib.error:
        pass
    return False


def find_member(window: Window, at: int, stop: int) -> int | None:
    """The first place in [at, stop) where a member begins."""
    while at < stop:
        data = window.bytes_at(at, BLOCK + len(MAGIC) - 1)
        hit = data.find(MAGIC)
        if hit < 0:
            if len(data) < BLOCK:
                return None
            at += BLOCK
        elif at + hit >= stop:
            return None
        elif head_of(window, at + hit):
            return at + hit
        else:
            at += hit + 1
    return None


def read_member(window: Window, at: int) -> tuple[bytes, int] | None:
    """A member's content, and where the next one begins; None if it is cut off or damaged."""
    unpack, parts, here = zlib.decompressobj(31), [], at
    try:
        while not unpack.eof:
            data = window.bytes_at(here, BLOCK)
            if not data:
                return None
            parts.append(unpack.decompress(data))
            here += len(data) - len(unpack.unused_data)
    except zlib.error:
        return None
    return b"".join(parts), here


def parse(content: bytes) -> tuple[str, list[tuple[str, str]], bytes] | None:
    """Type, header fields and payload of a record; for HTTP records the payload is what follows the HTTP header."""
    end = content.find(b"\r\n\r\n")
    if not content.startswith(b"WARC/") or end < 0:
        return None
    fields: dict[str, str] = {}
    for line in content[:end].split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        fields[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    try:
        block = content[end + 4 : end + 4 + int(fields.get("content-length", ""))]
    except ValueError:
        return None
    if fields.get("content-type", "").startswith("application/http"):
        block = block.partition(b"\r\n\r\n")[2]
    return fields.get("warc-type", ""), list(fields.items()), block


def records_of(path: str, length: int, start: int, stop: int) -> Iterator[tuple[int, str, list[tuple[str, str]], bytes]]:
    """Offset, type, header and payload of the records that start in [start, stop). Damaged members are passed over up to
    the next place where one begins."""
    store, place = filesystem(path)
    with store.open_input_file(place) as file:
        window = Window(file, length, start)
        at = find_member(window, start, stop)
        while at is not None and at < stop:
            member = read_member(window, at)
            found = parse(member[0]) if member else None
            if found:
                yield (at, *found)
            follow = member[1] if member else None
            if follow is not None and (follow >= length or window.bytes_at(follow, len(MAGIC)) == MAGIC):
                at = follow if follow < length else None
            else:
                at = find_member(window, at + 1 if follow is None else follow, stop)


def read(files: DataFrame, split: int = SPLIT) -> DataFrame:
    """path, offset, record_type, headers (names in lower case), payload of every record of files (path, length)."""
    ranges = files.filter("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long"))).alias("start"))
    sums = files.agg(F.sum(F.ceil(F.col("length") / split)).alias("ranges"), F.sum("length").alias("bytes")).first()
    width = shuffle_width(files.sparkSession)
    n = max(1, min(int(sums.ranges or 1), width), -(-int(sums.bytes or 0) // TASK))
    dealt = ranges.repartition(n)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())

        def made(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.string(), kind, pa.binary()), strict=True)], RECORDS.names)

        rows: list[tuple] = []
        size = 0
        for batch in batches:
            for r in batch.to_pylist():
                for offset, *rest in records_of(r["path"], r["length"], r["start"], min(r["start"] + split, r["length"])):
                    rows.append((r["path"], offset, *rest))
                    size += len(rest[-1]) + 1000
                    if size > 4 * BLOCK:
                        yield made(rows)
                        rows, size = [], 0
        if rows:
            yield made(rows)

    return dealt.mapInArrow(run, RECORDS)


def archived(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of every page, as its archived record tells.

    Repeated rows have a record each. The digest of a response is that of the payload read, a revisit's
    that of its header. Columns besides page_id, url and html are not archived. An empty table has no archive and gives no row.
    """
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    files = write(roles(pages.select("page_id", "url", "html")), folder)
    number = lambda name: F.expr(f"try_cast(regexp_extract(headers['{name}'], '<urn:x-page:(-?[0-9]+)>', 1) as bigint)")
    told = F.when(F.col("record_type") == "revisit", F.col("headers")["x-payload-length"].cast("long")).otherwise(F.octet_length("payload").cast("long"))
    rows = read(files).select(
        number("warc-record-id").alias("page_id"), told.alias("payload_bytes"), F.sha1("payload").alias("own"),
        F.col("headers")["warc-payload-digest"].alias("digest"), "record_type", number("warc-refers-to").alias("refers_to"),
    )
    return rows.select("page_id", "payload_bytes", F.when(F.col("record_type") == "revisit", hex_digest(F.col("digest"))).otherwise(F.col("own")).alias("payload_digest"), "record_type", "refers_to")


def hex_digest(digest):
    """Lower-case hexadecimal digits of `sha1:` and 32 base-32 digits: 8 of those are 10 of these."""
    digits = F.substring(digest, 6, 32)
    parts = []
    for k in range(4):
        value = F.lit(0).cast("long")
        for i in range(8):
            value = value * 32 + F.position(F.substring(digits, 8 * k + i + 1, 1), F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")) - 1
        parts.append(F.lpad(F.lower(F.hex(value)), 10, "0"))
    return F.concat(*parts)
