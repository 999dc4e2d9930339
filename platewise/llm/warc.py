"""WARC archives on Spark: a writer, and a reader that salvages damaged files (10).

Writer: one record per page, gzip members of one record each (or plain records). Of pages with equal payloads of
``min_revisit`` bytes or more the one with the largest page_id is a response and the others are revisits of it;
smaller ones are all responses. Spark's text writer puts the members into files of bounded size; the separator it
needs between rows is an empty gzip member, or the empty lines that end a plain record, so the files are valid.

Reader: each file is read from its start. Where a member or record fails its checks (deflate and its CRC, version
line, lengths, digests), the reader searches for the next valid member or version line, goes on there, and reports
the bytes between as a quarantined gap with the reason. The content of a member that holds several records is searched
in the same way, and so is what a damaged member of several records gives before the damage: records there count if the
member is merely cut short, or if a digest shows that their content is whole (headers have no digest). Such gaps have
the member's place and, in the reason, their own.

Results for special input: a null html is an empty payload, a null url an empty target; a null page_id is kept and
comes last when the response of a group is chosen; repeated rows of the largest page_id are all responses; an empty
table writes an archive without records; payloads of any length stay whole.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from platewise.llm.common import BINARY, LONG, STRING, fields, pick, run_dir

MIN_REVISIT = 1000
RECORDS_PER_FILE = 20_000
_DATE = "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_MAGIC, _VERSION = b"\x1f\x8b\x08", b"WARC/1."
_CHUNK, _PIECE = 1 << 16, 512
_CUT = "member cut short"
#: Header fields that every record has.
_NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")
#: Digest algorithms that are checked; others are taken as they are.
_ALGORITHMS = ("md5", "sha1", "sha224", "sha256", "sha384", "sha512")
_CHUNKED = re.compile(rb"(?im)^transfer-encoding:.*chunked").search
_CHUNK_SIZE = re.compile(rb"([0-9A-Fa-f]{1,8})[^\r\n]*\r\n").match


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


#: What the text writer puts after each row, by compression.
SEPARATOR = {"gzip": _member(b""), "none": b"\r\n\r\n"}


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """A response record, or a revisit record of ``refers_to`` without its payload; without the two empty lines."""
    sha1 = hashlib.sha1(payload).digest()
    digest = "sha1:" + base64.b32encode(sha1).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    target = re.sub(r"[\r\n]", "", url or "")
    lines = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
             f"WARC-Record-ID: <urn:x-page:{'' if page_id is None else page_id}>", f"WARC-Date: {_DATE}",
             f"WARC-Target-URI: {target}", f"WARC-Payload-Digest: {digest}",
             "WARC-Block-Digest: sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode()]
    if refers_to is not None:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block


class Bad(ValueError):
    """A record or member that fails its checks."""


def digest_of(value: str) -> tuple[str, bytes]:
    """Algorithm and bytes of a labelled digest, in base 32 or hexadecimal digits of either case; raises ``Bad``. The
    bytes are empty where the algorithm is not known."""
    label, colon, digits = value.partition(":")
    label = label.strip().lower().replace("-", "")
    if not colon or not label:
        raise Bad("digest without algorithm")
    if label not in _ALGORITHMS:
        return label, b""
    size, digits = hashlib.new(label).digest_size, digits.strip()
    try:
        own = bytes.fromhex(digits) if len(digits) == 2 * size else \
            base64.b32decode(digits.rstrip("=").upper() + "=" * (-len(digits.rstrip("=")) % 8))
    except ValueError:
        own = b""
    if len(own) != size:
        raise Bad("malformed digest")
    return label, own


def _dechunked(body: bytes) -> bytes | None:
    """The content of a body in chunked transfer encoding; None if it is not in that encoding."""
    out, at = [], 0
    while (line := _CHUNK_SIZE(body, at)) and int(line[1], 16):
        at = line.end() + int(line[1], 16)
        out.append(body[line.end():at])
        if body[at:at + 2] != b"\r\n":
            return None
        at += 2
    return b"".join(out) if line else None


def _check_payload(headers: dict, block: bytes) -> None:
    """Raises ``Bad`` where the payload digest is malformed or differs from the payload. The payload of a revisit, of a
    segment and of a truncated record is not in the block."""
    label, want = digest_of(headers["warc-payload-digest"])
    if not want or headers["warc-type"].lower() == "revisit" or "warc-segment-number" in headers or "warc-truncated" in headers:
        return
    payload = block
    if headers.get("content-type", "").lower().startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        if hashlib.new(label, payload).digest() != want and _CHUNKED(http):
            payload = _dechunked(payload) or payload
    if hashlib.new(label, payload).digest() != want:
        raise Bad("payload digest differs")


def parse(data, start: int = 0) -> tuple[dict, bytes, int]:
    """Headers, block and end of the record at ``start``; raises ``Bad`` if it fails a check."""
    if bytes(data[start:start + len(_VERSION)]) != _VERSION:
        raise Bad("no version line")
    end = data.find(b"\r\n\r\n", start)
    if end < 0:
        raise Bad("header without end")
    lines = bytes(data[start:end]).decode("utf-8", "replace").split("\r\n")
    headers = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon:
            raise Bad("header line without colon")
        name = name.strip().lower()
        if name in headers and name in _NEEDED or value.strip().startswith("WARC/1."):
            raise Bad("two headers in one")  # a record cut off within its header
        headers[name] = value.strip()
    if missing := [h for h in _NEEDED if h not in headers]:
        raise Bad(f"no {missing[0]}")
    if not re.fullmatch("[0-9]{1,18}", headers["content-length"]):
        raise Bad("no valid content length")
    first = end + 4
    last = first + int(headers["content-length"])
    if last > len(data):
        raise Bad("block cut short")
    if data[last:last + 4] != b"\r\n\r\n":
        raise Bad("no end of record")
    block = bytes(data[first:last])
    if "warc-block-digest" in headers:
        label, want = digest_of(headers["warc-block-digest"])
        if want and hashlib.new(label, block).digest() != want:
            raise Bad("block digest differs")
    if "warc-payload-digest" in headers:
        _check_payload(headers, block)
    return headers, block, last + 4


def member(data: bytes, start: int) -> tuple[bytes, int]:
    """Content and end of the gzip member at ``start``; raises ``Bad`` if it is damaged."""
    z, out, at = zlib.decompressobj(31), [], start
    try:
        while not z.eof:
            chunk = data[at:at + _CHUNK]
            if not chunk:
                raise Bad(_CUT)
            out.append(z.decompress(chunk))
            at += len(chunk)
    except zlib.error as e:
        raise Bad(f"member damaged: {e}") from None
    return b"".join(out), at - len(z.unused_data)


def beginning(data: bytes, start: int, least: int | None = None) -> tuple[bytes, int]:
    """What the damaged gzip member at ``start`` gives before the damage, or its first ``least`` bytes and perhaps a few
    more; and the place up to which it was read."""
    z, out, size, at = zlib.decompressobj(31), [], 0, start
    step = _PIECE
    while at < len(data) and (least is None or size < least):
        before = z.copy()
        try:
            got = z.decompress(data[at:at + step])
        except zlib.error:
            if step == 1:
                break
            z, step = before, 1  # byte by byte up to the damage
            continue
        if step > 1 and least is not None and size + len(got) >= least:
            z, step = before, 1
            continue
        out.append(got)
        size += len(got)
        at += step
        if z.eof:
            break
    return b"".join(out), min(at, len(data))


def inner_salvage(content: bytes) -> Iterator[tuple[str, int, int, object]]:
    """As ``salvage`` for the records within a member's content."""
    at, gap, why, n = 0, None, "", len(content)
    while at < n:
        try:
            headers, block, end = parse(content, at)
        except Bad as e:
            if gap is None:
                gap, why = at, str(e)
            at = content.find(_VERSION, at + 1)
            at = n if at < 0 else at
            continue
        if gap is not None:
            yield "gap", gap, at, why
            gap = None
        yield "record", at, end, (headers, block)
        at = end
    if gap is not None:
        yield "gap", gap, n, why


def _inside(start: int, end: int, why: str) -> str:
    return f"bytes {start} to {end} of the member's content: {why}"


def _verified(headers: dict) -> bool:
    """Whether a digest of the record's content was compared."""
    own = [headers[h] for h in ("warc-block-digest", "warc-payload-digest") if h in headers
           and (h == "warc-block-digest" or headers["warc-type"].lower() != "revisit")]
    return any(digest_of(x)[1] for x in own)


class Marks:
    """Where the next member or version line starts. Each kind is looked for again only when the last find is passed, so
    every byte is searched once a kind, however many gaps there are."""

    def __init__(self, data: bytes):
        self.data, self.found = data, {_MAGIC: -1, _VERSION: -1}

    def after(self, at: int) -> int:
        """The first mark at ``at`` or behind it; the end of the data if there is none."""
        for mark, place in self.found.items():
            if place < at:
                place = self.data.find(mark, at)
                self.found[mark] = len(self.data) if place < 0 else place
        return min(self.found.values())


def salvage(data: bytes) -> Iterator[tuple[str, int, int, object]]:
    """("record", start, end, (headers, block)) and ("gap", start, end, reason) over a whole file, in order.

    Records and gaps within a gzip member have the member's place; the reason of such a gap has its place in the
    member's content."""
    at, gap, why, n, marks = 0, None, "", len(data), Marks(data)
    while at < n:
        found, end, broken = [], at, None
        try:
            if data.startswith(_MAGIC[:2], at):
                try:
                    content, end = member(data, at)
                except Bad as e:
                    broken = str(e)
                    content, _ = beginning(data, at)
                found = list(inner_salvage(content))
                if broken and content.count(_VERSION) < 2:
                    raise Bad(broken)  # the checksum is that of this one record
                if broken and broken != _CUT:  # a cut leaves what is before it as it was; other damage shows late
                    found = [("gap", a, b, "no digest in a damaged member") if kind == "record" and not _verified(what[0])
                             else (kind, a, b, what) for kind, a, b, what in found]
                if good := [b for kind, _, b, _ in found if kind == "record"]:
                    if broken:  # all bytes up to the last good record are the member's own
                        end = beginning(data, at, good[-1])[1]
                        found = [x for x in found if x[1] < good[-1]]
                        broken = _inside(good[-1], len(content), broken)
                elif broken or found:
                    raise Bad(broken or found[0][3])
            else:
                headers, block, end = parse(data, at)
                found.append(("record", at, end, (headers, block)))
        except Bad as e:
            if gap is None:
                gap, why = at, str(e)
            at = marks.after(at + 1)
            continue
        if gap is not None:
            yield "gap", gap, at, why
            gap = None
        for kind, a, b, what in found:
            yield kind, at, end, what if kind == "record" else _inside(a, b, what)
        at = end
        if broken:
            gap, why = at, broken
            at = marks.after(at)
    if gap is not None:
        yield "gap", gap, n, why


def write_archive(pages: DataFrame, path: str, compression: str = "gzip", min_revisit: int = MIN_REVISIT,
                  records_per_file: int = RECORDS_PER_FILE) -> None:
    """Writes the archive of ``pages`` (page_id, url, html) into the folder ``path``."""
    rows = pick(pages, "page_id", "url", "html").select(
        "page_id", F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload")) \
        .withColumn("size", F.octet_length("payload")).withColumn("sha", F.sha1("payload"))
    groups = rows.where(F.col("size") >= min_revisit).groupBy("sha", "size").agg(
        F.max("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null")
    joined = rows.join(groups.drop("n"), ["sha", "size"], "left").select(
        "page_id", "url", "payload", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first")).alias("refers_to"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = b"\r\n\r\n"
        for batch in batches:
            out = []
            for p, u, d, r in zip(*(c.to_pylist() for c in batch.columns)):
                raw = record(p, u, d, r)
                out.append(_member(raw + end) if compression == "gzip" else raw)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["value"])

    joined.mapInArrow(encode, fields(value=BINARY)).select(F.col("value").cast("string").alias("value")).write \
        .option("encoding", "ISO-8859-1").option("lineSep", SEPARATOR[compression].decode("latin-1")) \
        .option("maxRecordsPerFile", records_per_file).option("compression", "none").text(path)


_ROW = fields(kind=STRING, file=STRING, start=LONG, end=LONG, reason=STRING, record_type=STRING, record_id=STRING,
              refers_to=STRING, target=STRING, http_length=LONG, payload_digest=STRING, payload=BINARY)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Rows of kind ``record`` and, for bytes that could not be read, of kind ``gap`` with their place and reason."""
    files = spark.read.format("binaryFile").load(path).select("path", "content")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                file, data = batch.column(0)[k].as_py(), batch.column(1)[k].as_py()
                held, size = [], 0
                for kind, a, b, what in salvage(data):
                    if kind == "gap":
                        held.append((kind, file, a, b, what, None, None, None, None, None, None, None))
                    else:
                        headers, block = what
                        http, blank, payload = block.partition(b"\r\n\r\n")
                        length = re.search(rb"(?im)^content-length:\s*(\d{1,18})(?!\d)", http)
                        label, own = digest_of(headers.get("warc-payload-digest", "none:"))
                        revisit = headers.get("warc-type") == "revisit"
                        held.append((kind, file, a, b, None, headers.get("warc-type"), headers.get("warc-record-id"),
                                     headers.get("warc-refers-to"), headers.get("warc-target-uri"),
                                     int(length[1]) if length else None,
                                     own.hex() if label == "sha1" else None,
                                     None if revisit or not blank else payload))
                        size += len(block)
                    if size > 8 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(_ROW.names, r)) for r in held], schema=_arrow())
                        held, size = [], 0
                if held:
                    yield pa.RecordBatch.from_pylist([dict(zip(_ROW.names, r)) for r in held], schema=_arrow())

    return files.mapInArrow(read, _ROW)


def _arrow() -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
    kinds["bigint"] = pa.int64()
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in _ROW.fields])


def _page(column: str):
    return F.regexp_extract(column, r"^<urn:x-page:(-?\d+)>$", 1).try_cast("long")


def digest(records: DataFrame) -> DataFrame:
    """The records as the registered query returns them: sizes and digests of the full payload."""
    own = F.col("payload").isNotNull()
    return records.where("kind = 'record'").select(
        _page("record_id").alias("page_id"),
        F.when(own, F.octet_length("payload").cast("long")).otherwise(F.col("http_length")).alias("payload_bytes"),
        F.when(own, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type", _page("refers_to").alias("refers_to"))


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    path = run_dir(spark, "warc") + "/archive"
    write_archive(pages, path)
    return digest(read_archive(spark, path))


def oracle_sql(min_revisit: int = MIN_REVISIT) -> str:
    """The registered query in SQL."""
    return f"""
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
       CASE WHEN first IS NULL THEN 'response' ELSE 'revisit' END AS record_type, first AS refers_to
FROM (SELECT page_id, h, CASE WHEN strlen(h) >= {min_revisit} AND page_id IS DISTINCT FROM last THEN last END AS first
      FROM (SELECT page_id, h, max(page_id) OVER (PARTITION BY h) AS last
            FROM (SELECT page_id, coalesce(html, '') AS h FROM pages) p) q) r"""
