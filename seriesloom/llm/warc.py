"""WARC archives: deduplicating writer and splittable reader.

Each record is a gzip member of its own. Files are written by Spark's text sink, so they are committed like any Spark
output and can lie in any store that Spark reaches: the sink ends each row with a separator, and the separator is the
zero byte with which every member ends anyway (the top byte of its length; members of 16 MiB or more are followed by an
empty member, which ends so too).

The reader lets Spark cut files into byte ranges and each task scan its own for the gzip magic; a record belongs to the
range in which its magic starts, and the task reads on to the record's end. Magic also occurs inside compressed data by
chance, so a candidate counts only if a gzip header and the start of a WARC record decode from it; the rest is put back
onto the member it was cut from, also if that began in another range. Archives named ``.gz`` are read as the bytes they
are too; Hadoop does not cut files of that name, so each of them is streamed by one task.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seriesloom.llm.common import freeing_shuffles

MAGIC = b"\x1f\x8b\x08"
#: Payloads below this size are stored in full each time.
MIN_REVISIT_BYTES = 1000
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n"
REVISIT_PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORD_ID = "urn:record:"


def _uri(text: str | None) -> bytes:
    """A header value on one line: everything but visible ASCII is percent-encoded."""
    return b"".join(b"%c" % b if 0x21 <= b <= 0x7E else b"%%%02X" % b for b in (text or "").encode())


def _digest(hexed: str) -> bytes:
    return b"sha1:" + base64.b32encode(bytes.fromhex(hexed))


def _member(data: bytes) -> bytes:
    press = zlib.compressobj(6, zlib.DEFLATED, 31)
    out = press.compress(data) + press.flush()
    if out[-1]:
        press = zlib.compressobj(6, zlib.DEFLATED, 31)
        out += press.compress(b"") + press.flush()
    return out


def _record(key: int | None, uri: str | None, payload: bytes, digest: str, refers: int | None, date: bytes) -> bytes:
    head = [
        b"WARC/1.1",
        b"WARC-Type: " + (b"response" if refers is None else b"revisit"),
        b"WARC-Record-ID: <%s%s>" % (_RECORD_ID.encode(), b"" if key is None else b"%d" % key),
        b"WARC-Date: " + date,
        b"WARC-Target-URI: " + _uri(uri),
        b"WARC-Payload-Digest: " + _digest(digest),
        b"WARC-Payload-Length: %d" % len(payload),
    ]
    if refers is None:
        head.append(b"Content-Type: application/http; msgtype=response")
        block = HTTP_HEAD % len(payload) + payload
    else:
        head.append(b"WARC-Refers-To: <%s%d>" % (_RECORD_ID.encode(), refers))
        head.append(b"WARC-Profile: " + REVISIT_PROFILE)
        block = b""
    head.append(b"Content-Length: %d" % len(block))
    return _member(b"\r\n".join(head) + b"\r\n\r\n" + block + b"\r\n\r\n")


def write(pages: DataFrame, path: str, key: str = "page_id", uri: str = "url", body: str = "html", date: str = "2024-01-01T00:00:00Z") -> None:
    """One record per row of ``pages`` in WARC files under ``path``.

    Of rows with equal payloads of ``MIN_REVISIT_BYTES`` or more, the one with the largest key is a response and the
    others are revisits of it (rows that repeat that key are responses too). Null bodies are empty payloads, null keys
    records without a number. Other columns are not written, whatever their names; an empty table gives an empty folder.
    Payloads may have any length a Spark value can have. ``date`` is the capture date of all records, so that equal input
    gives equal archives.
    """
    data = F.coalesce(F.col(body).cast("binary"), F.lit(b"").cast("binary"))
    rows = pages.select(F.col(key).cast("long").alias("key"), F.col(uri).cast("string").alias("uri"), data.alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload")).withColumn("size", F.octet_length("payload"))
    large = rows.where(F.col("size") >= MIN_REVISIT_BYTES)
    repeated = large.groupBy("digest", "size").agg(F.max("key").alias("last"), F.count("*").alias("n")).where("n > 1")
    repeated = repeated.select(F.col("digest").alias("d"), F.col("size").alias("s"), "last")
    rows = rows.join(repeated, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("s")), "left")
    rows = rows.select("key", "uri", "payload", "digest", F.when(~F.col("key").eqNullSafe(F.col("last")), F.col("last")).alias("refers"))
    day = date.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                some = batch.slice(at, 64).to_pylist()
                made = [_record(r["key"], r["uri"], r["payload"], r["digest"], r["refers"], day)[:-1] for r in some]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["value"])

    members = rows.mapInArrow(run, "value binary").select(F.col("value").cast("string").alias("value"))
    with freeing_shuffles(pages.sparkSession):
        members.write.option("lineSep", "\0").text(path)


def _starts(piece: bytes) -> bool:
    """Whether a gzip header and the start of a WARC record (or an empty member) decode from the piece."""
    try:
        head = zlib.decompressobj(31).decompress(piece[:4096], 5)
    except zlib.error:
        return False
    return head == b"WARC/" or (len(piece) < 64 and b"WARC/".startswith(head))


class _Damaged(bytes):
    """A member that does not decode."""


def _decoded(pieces: list[bytes]) -> bytes | None:
    """The member's content, or None if it goes on."""
    d = zlib.decompressobj(31)
    raw = b"".join(pieces)
    try:
        data = d.decompress(raw)
    except zlib.error:
        return _Damaged(raw)
    return data if d.eof else None


_FIELDS = (
    "record_id", "record_uri", "record_type", "target_uri", "payload_digest", "payload_length", "refers_to", "refers_to_uri", "payload",
)


def _number(value: str | None) -> int | None:
    found = re.fullmatch(rf"<{_RECORD_ID}(-?\d+)>", value or "")
    return int(found[1]) if found else None


def _hex(digest: str) -> str | None:
    """A SHA-1 digest in base 32 or hexadecimal as lower-case hexadecimal; null if it is neither."""
    name, _, value = digest.partition(":")
    if name.lower() != "sha1":
        return None
    if re.fullmatch("[0-9A-Fa-f]{40}", value):
        return value.lower()
    return base64.b32decode(value.upper()).hex() if re.fullmatch("[2-7A-Za-z]{32}", value) else None


def _whole_number(value: str | None, other: int) -> int:
    return int(value) if re.fullmatch("[0-9]+", value or "") else other


def _body(block: bytes) -> bytes:
    """The body of an HTTP response, its chunks joined and its gzip or deflate coding undone as far as it goes."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {name.strip().lower(): value.strip().lower() for name, _, value in (x.partition(b":") for x in head.split(b"\r\n")[1:])}
    if fields.get(b"transfer-encoding") == b"chunked":
        parts, at = [], 0
        while (end := body.find(b"\r\n", at)) >= 0 and re.fullmatch(b"[0-9A-Fa-f]+", body[at:end].split(b";")[0].strip()):
            size = int(body[at:end].split(b";")[0], 16)
            if not size:
                break
            parts.append(body[end + 2 : end + 2 + size])
            at = end + 4 + size
        body = b"".join(parts) if parts or at or body.startswith(b"0") else body
    if fields.get(b"content-encoding") in (b"gzip", b"x-gzip", b"deflate"):
        for window in (47, -15):
            try:
                return zlib.decompressobj(window).decompress(body)
            except zlib.error:
                continue
    return body


def parsed(data: bytes) -> tuple:
    """The fields of one decoded record; a member that does not decode has the type ``damaged`` and its own length."""
    if isinstance(data, _Damaged):
        return None, None, "damaged", None, None, len(data), None, None, None
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        fields[name.strip().lower()] = value.strip()
    block = rest[: _whole_number(fields.get("content-length"), len(rest))]
    payload = block
    if "application/http" in fields.get("content-type", ""):
        payload = _body(block)
    kind = fields.get("warc-type")
    length = _whole_number(fields.get("warc-payload-length"), len(payload))
    own, other = fields.get("warc-record-id"), fields.get("warc-refers-to")
    return (
        _number(own), own, kind, fields.get("warc-target-uri"), _hex(fields.get("warc-payload-digest", "")), length,
        _number(other), other, payload if kind != "revisit" else None,
    )


_KINDS = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
_SCHEMA = (
    "record_id long, record_uri string, record_type string, target_uri string, payload_digest string, payload_length long, "
    "refers_to long, refers_to_uri string, payload binary"
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    arrays = [pa.array(c, k) for c, k in zip(columns, _KINDS, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, list(_FIELDS))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between gzip magics, a row each, in file order within each byte range."""
    source = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1"))
    passing = spark._jvm.org.apache.hadoop.io.compress.PassthroughCodec  # hands the bytes on as they are
    source = source.option("io.compression.codecs", passing.CLASSNAME).option(passing.OPT_EXTENSION, ".gz")
    return source.text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"), F.col("value").cast("binary").alias("piece")
    )


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bool, list[bytes], bytes | None]]:
    """``range, begins here, pieces, decoded`` of each member or part of one; decoded is None for parts."""
    where: tuple[str, int] | None = None
    pieces: list[bytes] = []
    begins = False
    for batch in batches:
        files, ranges, found = (batch.column(i) for i in range(3))
        for i in range(batch.num_rows):
            at = (files[i].as_py(), ranges[i].as_py())
            raw = found[i].as_py()
            if at != where:
                if pieces:
                    yield where, begins, pieces, None
                where, pieces, begins = at, [], False
                if at[1] == 0 and not raw:
                    continue  # what stands before the file's first magic
            piece = MAGIC + raw
            if _starts(piece):
                if pieces:
                    yield where, begins, pieces, None
                pieces, begins = [piece], True
            else:
                pieces.append(piece)
            if begins and (data := _decoded(pieces)) is not None:
                yield where, True, pieces, data
                pieces, begins = [], False
    if pieces:
        yield where, begins, pieces, None


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records of the WARC files under ``path``: ids, type, URI, payload digest (lower-case hex) and length as the
    headers give them, what a revisit refers to, and the payload (null for revisits). Tasks read byte ranges.

    ``record_id`` and ``refers_to`` are the numbers that ``write`` gives; the ``uri`` columns have any archive's ids as
    they stand. Chunked and compressed HTTP bodies are undone. A member that does not decode gives a row of the type
    ``damaged`` with its length and nothing else, and the rest is read on; a header that is missing or malformed is null.
    A folder without records gives no rows.
    """

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for _, _, _, data in _members(batches):
            if data:
                rows.append(parsed(data))
                size += len(data)
            if size > 4 << 20:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = 0
        for (file, start), _, pieces, data in _members(batches):
            if data is None:
                order += 1
                values = [[file], [start], [order], [b"".join(pieces)]]
                yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["file", "range", "order", "part"])

    def joined(table: pa.Table) -> pa.Table:
        rows, held = [], b""
        for row in table.sort_by([("range", "ascending"), ("order", "ascending")]).to_pylist():
            if held and _starts(row["part"]):
                rows.append(parsed(_Damaged(held)))  # another member begins before this one ends
                held = b""
            held += row["part"]
            if (data := _decoded([held])) is not None:
                rows.append(parsed(data))
                held = b""
        if held:
            rows.append(parsed(_Damaged(held)))  # the file ends inside a member
        return pa.Table.from_batches([_batch(rows)]) if rows else pa.Table.from_batches([], _batch_schema())

    # Members cut by a chance magic at a range's edge: next to none, so a file's are few.
    cut = _pieces(spark, path).mapInArrow(parts, "file string, range long, order long, part binary")
    return _pieces(spark, path).mapInArrow(whole, _SCHEMA).union(cut.groupBy("file").applyInArrow(joined, _SCHEMA))


def _batch_schema() -> pa.Schema:
    return pa.schema(list(zip(_FIELDS, _KINDS, strict=True)))
