"""Legacy web archives (ARC 1 and 2) written, converted to WARC, and read back.

An archive is one file of records that are gzip members of their own. Files are written by Spark's text sink, a
row per archive: it puts the bytes of a value down as they are, and what it adds, one zero byte, is padding that
gzip readers skip. So archives lie wherever Spark can write, are committed as other tables are, and a lost executor
costs a rerun of its tasks. They are read as binary files; an archive is bounded by ARCHIVE_BYTES and its last record.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from urllib.parse import quote

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from playledger.llm.common import batch_rows, discarded, shared_folder, written

ARCHIVE_BYTES = 4 << 20
LEAST_REVISITED = 1000
SALTS = 16
LEVEL = 3
BATCH = 256
_CHUNK = 16 << 10

# fixed values of the two formats
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: (
        "URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset",
        "Filename", "Archive-length",
    ),
}
WARC_VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_FOUND = "path string, offset long, page_id long, payload_bytes long, digest binary, record_id string, uri string, date string"
_PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


@dataclass
class Record:
    """A record of either format: its place, header fields and block."""

    offset: int
    fields: dict[str, str]
    block: bytes
    version: int = 0
    archive: str = ""
    http: dict[str, str] = field(default_factory=dict)
    payload: bytes = b""


def members(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(offset, bytes) of each gzip member of an archive; an archive without compression is one piece."""
    if data[:2] != b"\x1f\x8b":
        yield 0, data
        return
    view, at = memoryview(data), 0
    while at < len(data) and data[at]:
        start, out, inflater = at, [], zlib.decompressobj(31)
        while not inflater.eof:
            if at >= len(data):
                raise ValueError(f"the archive ends inside the member at {start}")
            chunk = view[at : at + _CHUNK]
            out.append(inflater.decompress(chunk))
            at += len(chunk) - len(inflater.unused_data)
        yield start, b"".join(out)


def packed(record: bytes) -> bytes:
    deflater = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return deflater.compress(record) + deflater.flush()


def _split_http(record: Record) -> Record:
    """Takes the HTTP head off a block that has one; the rest is the payload."""
    if not record.block.startswith(b"HTTP/"):
        record.payload = record.block
        return record
    ends = [(at, len(mark)) for mark in (b"\r\n\r\n", b"\n\n") if (at := record.block.find(mark)) >= 0]
    at, width = min(ends, default=(len(record.block), 0))
    for line in record.block[:at].decode("latin-1").splitlines()[1:]:
        name, _, value = line.partition(":")
        record.http[name.strip().lower()] = value.strip()
    record.payload = record.block[at + width :]
    return record


# --- ARC ---------------------------------------------------------------------------------


def arc_head(version: int, name: str, date: str) -> bytes:
    """The record that opens an archive: version, and the names of the fields of its header lines."""
    block = f"{version} 0 pages\n{' '.join(ARC_FIELDS[version])}\n".encode()
    return arc_record(version, f"filedesc://{name}", "0.0.0.0", date, "text/plain", block, name)


def arc_record(version: int, url: str, ip: str, date: str, mime: str, block: bytes, name: str, offset: int = 0) -> bytes:
    """Header line of the version, block, and the newline that parts records."""
    values = [url, ip, date, mime]
    if version == 2:
        values += ["200", hashlib.md5(block).hexdigest(), "-", str(offset), name]
    return " ".join([*values, str(len(block))]).encode() + b"\n" + block + b"\n"


def arc_url(url: str | None) -> str:
    """A url as one word of a header line: white space, controls and other than ASCII escaped; `-` for none."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~|{}^`\\\"<>-._") if url else "-"


def arc_records(data: bytes) -> Iterator[Record]:
    """The records of an archive, the opening one included, by declared version and lengths."""
    version, name = 0, ""
    for offset, piece in members(data):
        at = 0
        while at < len(piece):
            if piece[at : at + 1] in b"\r\n\0":
                at += 1
                continue
            end = piece.find(b"\n", at)
            line = piece[at : end if end >= 0 else len(piece)].decode("utf-8", "replace").rstrip("\r")
            if not version and line.startswith("filedesc://"):
                # the opening line is alike in both versions up to the length, its last word
                length = int(line.rsplit(" ", 1)[1])
                block = piece[end + 1 : end + 1 + length]
                version, name = int(block.split(None, 1)[0]), line.split(" ", 1)[0].removeprefix("filedesc://")
                if version not in ARC_FIELDS:
                    raise ValueError(f"no archive of version {version} is known")
            if not version:
                raise ValueError("an archive must open with its filedesc record")
            names = ARC_FIELDS[version]
            # a url may hold spaces, the other fields do not
            values = line.rsplit(" ", len(names) - 1)
            if len(values) != len(names) or not values[-1].isdigit():
                raise ValueError(f"not a header line of version {version}: {line[:200]}")
            length = int(values[-1])
            block = piece[end + 1 : end + 1 + length]
            if end < 0 or len(block) != length:
                raise ValueError(f"the record at {offset} ends before its declared {length} bytes")
            place = offset if data[:2] == b"\x1f\x8b" else at
            yield _split_http(Record(place, dict(zip(names, values)), block, version, name))
            at = end + 1 + length


# --- WARC --------------------------------------------------------------------------------


def iso_date(digits: str) -> str:
    """2024-01-31T12:00:00Z from the digits of an archive date; what is left out counts as its least value."""
    least = "19700101000000"
    digits = digits if digits.isdigit() and len(digits) >= 4 else least
    d = (digits + least[len(digits) :])[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def labelled_digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(record: Record) -> str:
    """The same for every conversion of the same archive."""
    key = f"{record.archive}/{record.offset} {record.fields['Archive-date']} {record.fields['URL']}"
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, key)}>"


def warc_record(fields: dict[str, str], block: bytes) -> bytes:
    lines = [WARC_VERSION, *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def converted(record: Record, refers: dict | None) -> bytes:
    """The WARC record of an ARC record: warcinfo for the opening one, response for HTTP blocks, resource for
    others; with `refers` (record_id, uri, date, page_id of the response with the same payload) a revisit, which
    keeps the HTTP head alone."""
    fields = {"WARC-Type": "", "WARC-Record-ID": record_id(record), "WARC-Date": iso_date(record.fields["Archive-date"])}
    if record.fields["URL"].startswith("filedesc://"):
        block = f"software: playledger\r\nformat: WARC File Format 1.1\r\nisPartOf: {record.archive}\r\n".encode()
        fields |= {"WARC-Type": "warcinfo", "WARC-Filename": record.archive, "Content-Type": "application/warc-fields"}
        return warc_record(fields, block)
    http = record.block.startswith(b"HTTP/")
    fields["WARC-Type"] = "response" if http else "resource"
    fields |= {"WARC-Target-URI": record.fields["URL"], "WARC-IP-Address": record.fields["IP-address"]}
    fields["WARC-Payload-Digest"] = labelled_digest(record.payload)
    block = record.block
    if refers:
        block = record.block[: len(record.block) - len(record.payload)]
        fields |= {
            "WARC-Type": "revisit", "WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": refers["record_id"],
            "WARC-Refers-To-Target-URI": refers["uri"], "WARC-Refers-To-Date": refers["date"],
        }
        if refers["page_id"] is not None:
            fields["X-Refers-To-Page-Id"] = str(refers["page_id"])
    fields["WARC-Block-Digest"] = labelled_digest(block)
    fields["Content-Type"] = "application/http; msgtype=response" if http else record.fields["Content-type"]
    return warc_record(fields, block)


def warc_records(data: bytes) -> Iterator[Record]:
    """The records of a WARC archive by their declared lengths; block and payload digests are verified."""
    for offset, piece in members(data):
        at = 0
        while at < len(piece):
            if piece[at : at + 1] in b"\r\n\0":
                at += 1
                continue
            end = piece.find(b"\r\n\r\n", at)
            first, *lines = piece[at : max(at, end)].decode("utf-8", "replace").split("\r\n")
            if not first.startswith("WARC/"):
                raise ValueError(f"no WARC record at {offset}")
            fields = {k.strip(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            length = int(fields["Content-Length"])
            block = piece[end + 4 : end + 4 + length]
            if len(block) != length:
                raise ValueError(f"the record at {offset} ends before its declared {length} bytes")
            record = _split_http(Record(offset, fields, block))
            _verify(record)
            yield record
            at = end + 4 + length


def _verify(record: Record) -> None:
    whole = record.fields.get("WARC-Type") != "revisit"
    for name, data in (("WARC-Block-Digest", record.block), ("WARC-Payload-Digest", record.payload if whole else None)):
        if data is not None and record.fields.get(name, labelled_digest(data)) != labelled_digest(data):
            raise ValueError(f"{name} of the record at {record.offset} does not hold")


# --- Spark -------------------------------------------------------------------------------


def _saved(archives: DataFrame, folder: str) -> None:
    """Writes each row of `archives(archive binary)` as a file of its own."""
    rows = archives.select(F.col("archive").cast("string").alias("value"))
    rows.write.option("maxRecordsPerFile", 1).option("lineSep", "\0").text(folder)


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.format("binaryFile").load(folder).select("path", "content")


def write_arcs(pages: DataFrame, folder: str, captured: str = "20240101000000") -> None:
    """Writes a record per row of `pages(page_id, url, html)` to legacy archives in `folder`, of both versions in turn.

    A block is an HTTP response, its body the html in UTF-8; a null html is empty. The page_id is a header of that
    response, absent if null. `captured` is the archive date, as pages have none.
    """

    def build(batches):
        task, k, parts, held = TaskContext.get().partitionId(), 0, [], 0
        for batch in batches:
            for page_id, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                version, name = 1 + k % 2, f"pages-{task:06}-{k:06}.arc.gz"
                if not parts:
                    parts.append(packed(arc_head(version, name, captured)))
                    held = len(parts[0])
                body = (html or "").encode()
                head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                head += f"X-Page-Id: {page_id}\r\n" if page_id is not None else ""
                block = f"{head}Content-Length: {len(body)}\r\n\r\n".encode() + body
                parts.append(packed(arc_record(version, arc_url(url), "0.0.0.0", captured, "text/html", block, name, held)))
                held += len(parts[-1])
                if held >= ARCHIVE_BYTES:
                    yield pa.record_batch([pa.array([b"".join(parts)], pa.binary())], ["archive"])
                    k, parts = k + 1, []
        if parts:
            yield pa.record_batch([pa.array([b"".join(parts)], pa.binary())], ["archive"])

    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.col("html").cast("string"))
    with batch_rows(pages.sparkSession, BATCH):
        _saved(rows.mapInArrow(build, "archive binary"), folder)


def _page_id(record: Record) -> int | None:
    value = record.http.get("x-page-id")
    return int(value) if value is not None else None


def found_records(files: DataFrame) -> DataFrame:
    """The HTTP records of ARC `files(path, content)`, without blocks: place, page_id, payload and identity."""

    def scan(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                rows = [
                    (
                        path.as_py(), r.offset, _page_id(r), len(r.payload), hashlib.sha1(r.payload).digest(), record_id(r),
                        r.fields["URL"], iso_date(r.fields["Archive-date"]),
                    )
                    for r in arc_records(content.as_py())
                    if r.block.startswith(b"HTTP/")
                ]
                yield _batch(rows, _FOUND)

    return files.mapInArrow(scan, _FOUND)


def revisits(found: DataFrame, least: int) -> DataFrame:
    """The records that revisit another, by archive: (path, revisits array<struct<offset, refers...>>).

    Of records with the same payload of `least` bytes or more, that with the largest page_id (of several, the last by
    path and offset) is the response. Its identity meets the others in SALTS parts, so that no task gets all
    copies of a common payload.
    """
    large = found.filter(F.col("payload_bytes") >= least)
    best = F.max(F.struct("page_id", "path", "offset", "record_id", "uri", "date")).alias("best")
    groups = large.groupBy("digest", "payload_bytes").agg(best, F.count(F.lit(1)).alias("n")).filter("n > 1")
    groups = groups.select(
        F.col("digest").alias("of"), F.col("payload_bytes").alias("of_bytes"), "best", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("of_salt")
    )
    dealt = large.select("path", "offset", "digest", "payload_bytes", F.pmod(F.xxhash64("path", "offset"), F.lit(SALTS)).cast("int").alias("salt"))
    same = (F.col("digest") == F.col("of")) & (F.col("payload_bytes") == F.col("of_bytes")) & (F.col("salt") == F.col("of_salt"))
    others = dealt.join(groups, same).filter((F.col("path") != F.col("best.path")) | (F.col("offset") != F.col("best.offset")))
    told = F.struct("offset", "best.record_id", "best.uri", "best.date", "best.page_id")
    # an archive is bounded, and so are its records
    return others.groupBy(F.col("path").alias("of_path")).agg(F.collect_list(told).alias("revisits"))


def convert_arcs(spark: SparkSession, arcs: str, warcs: str, least: int = LEAST_REVISITED) -> None:
    """Converts the archives in folder `arcs` to WARC archives in folder `warcs`, one for one.

    The first pass over the archives finds payload digests, from which revisits are told; only digests are
    shuffled by payload. The second pass takes an archive's revisits along and writes its records.
    """
    files = _files(spark, arcs)
    decided = written(revisits(written(found_records(files)), least))

    def convert(batches):
        for batch in batches:
            for content, known in zip(batch.column(0), batch.column(1)):
                refers = {r["offset"]: r for r in known.as_py() or []}
                parts = [packed(converted(r, refers.get(r.offset))) for r in arc_records(content.as_py())]
                yield pa.record_batch([pa.array([b"".join(parts)], pa.binary())], ["archive"])

    joined = files.join(decided, F.col("path") == F.col("of_path"), "left").select("content", "revisits")
    with batch_rows(spark, 1):
        _saved(joined.mapInArrow(convert, "archive binary"), warcs)


def read_warcs(spark: SparkSession, folder: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to of the response and revisit records in `folder`.

    The digest is the hexadecimal form of the record's; a revisit's size is that its HTTP head declares.
    """

    def scan(batches):
        for batch in batches:
            for content in batch.column(0):
                rows = []
                for r in warc_records(content.as_py()):
                    kind = r.fields["WARC-Type"]
                    if kind not in ("response", "revisit"):
                        continue
                    size = len(r.payload) if kind == "response" else int(r.http["content-length"])
                    digest = base64.b32decode(r.fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
                    page = r.fields.get("X-Refers-To-Page-Id")
                    rows.append((_page_id(r), size, digest, kind, int(page) if page is not None else None))
                yield _batch(rows, _PAGE)

    return _files(spark, folder).select("content").mapInArrow(scan, _PAGE)


def _batch(rows: list[tuple], ddl: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}
    fields = [f.split() for f in ddl.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.record_batch([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], [n for n, _ in fields])


def archived_pages(pages: DataFrame, least: int = LEAST_REVISITED) -> DataFrame:
    """Archives `pages(page_id, url, html)` in the legacy format, converts that to WARC, and reads the WARC archives back.

    A row per page, repeated rows included: page_id, payload_bytes, payload_digest, record_type (response or revisit),
    refers_to (page_id of the response that a revisit refers to). Null html is empty, null urls are written as `-`, a null
    page_id is smaller than any; other columns are ignored, an empty table gives no rows. The legacy archives
    are removed once they are converted.
    """
    spark = pages.sparkSession
    top = f"{shared_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_arcs(pages, f"{top}/arc")
    convert_arcs(spark, f"{top}/arc", f"{top}/warc", least)
    discarded(spark, f"{top}/arc")
    return read_warcs(spark, f"{top}/warc")
