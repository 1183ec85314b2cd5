"""Legacy ARC archives converted to WARC.

ARC files of version 1 and 2 are read record by record: the version block
names the header fields of its version, every header line declares the length
of what follows.  Each record becomes a WARC 1.1 record with a synthesised
identifier (from archive name and offset, so a second conversion gives the
same), an ISO timestamp, a type, and digests.  Payloads that repeat become
revisit records.

Archives are files in any store that Spark reaches: read with its
``binaryFile`` source, written with its text sink (bytes as they are, the
line separator being the end of the record), so lost tasks are simply run
again and no executor touches a folder of its own.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import re
import uuid
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm.common import keyed, stored

#: Header fields of the two ARC versions, as their version blocks name them.
ARC_FIELDS = {
    "1": "URL IP-address Archive-date Content-type Archive-length",
    "2": "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
#: Payloads of fewer bytes are never revisits.
LEAST_REVISIT = 1000
#: Bytes of an archive that the page writer aims at.
ARCHIVE_BYTES = 8 << 20
#: The header that carries a record's own number through both formats.
SOURCE_HEADER = "X-Page-Id"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

_RECORD = [("archive", pa.string()), ("offset", pa.int64()), ("record_id", pa.string()), ("type", pa.string()),
           ("uri", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("content_type", pa.string()),
           ("head", pa.string()), ("source_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_sha1", pa.string()),
           ("block_sha1", pa.string()), ("refers_to_id", pa.string()), ("error", pa.string()), ("payload", pa.binary())]
RECORD = pa.schema(_RECORD)
RECORD_DDL = ("archive string, offset bigint, record_id string, type string, uri string, ip string, date string, "
              "content_type string, head string, source_id bigint, payload_bytes bigint, payload_sha1 string, "
              "block_sha1 string, refers_to_id string, error string, payload binary")


def opened(content: bytes) -> io.BufferedReader:
    """The archive's bytes as a stream; gzip files are expanded as they are read."""
    raw = io.BytesIO(content)
    return io.BufferedReader(gzip.GzipFile(fileobj=raw) if content[:2] == b"\x1f\x8b" else raw)


def _http(block: bytes) -> tuple[bytes, bytes]:
    """(head with its blank line, payload) of an HTTP block; others have no head."""
    if not block.startswith(b"HTTP/"):
        return b"", block
    ends = [(m.end(), m) for m in (re.compile(rb"\r?\n\r?\n").search(block),) if m]
    return (block[:ends[0][0]], block[ends[0][0]:]) if ends else (block, b"")


def _header(head: bytes, name: str) -> str | None:
    m = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(.*?)[ \t]*\r?$", head)
    return m[1].decode("latin-1") if m else None


def _number(text: str | None) -> int | None:
    return int(text) if text and re.fullmatch(r"-?\d{1,18}", text) else None


def iso_date(date: str) -> str | None:
    """An ARC date (4 to 14 digits, the rest the earliest) as WARC writes it."""
    if not re.fullmatch(r"\d{4,14}", date):
        return None
    full = date + "00000101000000"[len(date):]
    return f"{full[:4]}-{full[4:6]}-{full[6:8]}T{full[8:10]}:{full[10:12]}:{full[12:14]}Z"


def _row(archive: str, offset: int, block: bytes, **fields) -> dict:
    head, payload = _http(block)
    kind = fields.pop("type", None) or ("response" if head else "resource")
    row = dict.fromkeys(RECORD.names) | {
        "archive": archive, "offset": offset, "type": kind, "head": head.decode("latin-1"), "payload": payload,
        "source_id": _number(_header(head, SOURCE_HEADER)), "payload_bytes": len(payload),
        "payload_sha1": hashlib.sha1(payload).hexdigest(), "block_sha1": hashlib.sha1(block).hexdigest(),
    }
    return row | fields


def _next_header(f, fields: list[str]) -> tuple[int, bytes]:
    """Bytes before the next line that is a record's header, and that line."""
    skipped, date = 0, fields.index("Archive-date") if "Archive-date" in fields else None
    while line := f.readline():
        values = line.rstrip(b"\r\n").decode("latin-1").rsplit(" ", len(fields) - 1)
        length = _number(values[-1])
        if len(values) == len(fields) and ":" in values[0] and length is not None and length >= 0 \
                and (date is None or re.fullmatch("[0-9]{14}", values[date])):
            return skipped, line
        skipped += len(line)
    return skipped, b""


def arc_records(content: bytes, name: str = "") -> Iterator[dict]:
    """The records of one ARC archive of either version.

    A line in the place of a header that is not one gives a record with
    ``error``, and reading goes on at the next line that is one: as many fields
    as the version has, a date of 14 digits and a length.  A length beyond the
    archive's end, bytes that do not unpack and a version block that is none
    give a last record with ``error``."""
    f = opened(content)
    offset, fields, version = 0, [], ""
    while True:
        try:
            line = f.readline()
            while line in (b"\n", b"\r\n"):  # between records
                offset += len(line)
                line = f.readline()
        except (OSError, EOFError) as e:
            yield dict.fromkeys(RECORD.names) | {"archive": name, "offset": offset, "error": f"unreadable: {e}"}
            return
        if not line:
            return
        text = line.rstrip(b"\r\n").decode("latin-1")
        names = fields or (["URL"] * 4 + ["Archive-length"])
        # a URL may hold blanks: the other fields are counted from the right
        values = text.rsplit(" ", len(names) - 1) if fields else text.split(" ")
        length = _number(values[-1])
        if length is None or length < 0 or (fields and len(values) != len(names)) or (not fields and not text.startswith("filedesc:")):
            yield dict.fromkeys(RECORD.names) | {"archive": name, "offset": offset, "error": f"not a header: {text[:80]}"}
            if not fields:
                return
            offset += len(line)
            try:
                skipped, line = _next_header(f, fields)
            except (OSError, EOFError) as e:
                yield dict.fromkeys(RECORD.names) | {"archive": name, "offset": offset, "error": f"unreadable: {e}"}
                return
            if not line:
                return
            offset += skipped
            values = line.rstrip(b"\r\n").decode("latin-1").rsplit(" ", len(names) - 1)
            length = _number(values[-1])
        try:
            block = f.read(length)
        except (OSError, EOFError):
            block = b""
        if len(block) < length:
            yield dict.fromkeys(RECORD.names) | {"archive": name, "offset": offset, "error": f"cut: {len(block)} of {length} bytes"}
            return
        at, offset = offset, offset + len(line) + length
        if not fields:  # the version block
            name = values[0].removeprefix("filedesc://") or name
            version, fields = (block.split(b" ", 1)[0].decode("latin-1").strip(), [])
            lines = block.decode("latin-1").splitlines()
            fields = lines[1].split() if len(lines) > 1 and lines[1].split() else ARC_FIELDS.get(version, "").split()
            if not fields or fields[0] != "URL" or fields[-1] != "Archive-length":
                yield dict.fromkeys(RECORD.names) | {"archive": name, "offset": at, "error": f"unknown version: {lines[:2]}"}
                return
            continue
        got = dict(zip(fields, values))
        yield _row(name, at, block, uri=got["URL"], ip=got.get("IP-address"), date=iso_date(got.get("Archive-date", "")),
                   content_type=got.get("Content-type"), record_id=f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'arc:{name}:{at}')}>")


def warc_records(content: bytes, name: str = "") -> Iterator[dict]:
    """The records of one WARC archive; digests are computed anew.  For a
    revisit, ``payload_sha1`` is the digest it names and ``payload_bytes`` the
    Content-Length of the head that it keeps.  A record that cannot be read
    gives a last one with ``error``, as does a digest that is not its own."""
    f = opened(content)
    offset = 0
    while True:
        line = f.readline()
        while line in (b"\n", b"\r\n"):
            offset += len(line)
            line = f.readline()
        if not line:
            return
        at, head = offset, line
        while (line := f.readline()) not in (b"\r\n", b"\n", b""):
            head += line
        length = _number(_header(head, "Content-Length"))
        if not head.startswith(b"WARC/") or length is None or length < 0:
            yield dict.fromkeys(RECORD.names) | {"archive": name, "offset": at, "error": f"not a record: {head[:80]!r}"}
            return
        block = f.read(length)
        if len(block) < length:
            yield dict.fromkeys(RECORD.names) | {"archive": name, "offset": at, "error": f"cut: {len(block)} of {length} bytes"}
            return
        offset += len(head) + len(line) + length
        row = _row(name, at, block, type=_header(head, "WARC-Type"), record_id=_header(head, "WARC-Record-ID"),
                   uri=_header(head, "WARC-Target-URI"), ip=_header(head, "WARC-IP-Address"), date=_header(head, "WARC-Date"),
                   content_type=_header(head, "Content-Type"), refers_to_id=_header(head, "WARC-Refers-To"))
        named = (_header(head, "WARC-Payload-Digest") or "").removeprefix("sha1:")
        if row["type"] == "revisit":
            row |= {"payload_sha1": named, "payload_bytes": _number(_header(row["head"].encode("latin-1"), "Content-Length"))}
        elif named and named != row["payload_sha1"]:
            row["error"] = f"payload digest is {row['payload_sha1']}, not {named}"
        yield row


def _records(files: DataFrame, parse, payload: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for b in batches:
            for i in range(b.num_rows):
                for row in parse(b.column("content")[i].as_py() or b"", b.column("path")[i].as_py() or ""):
                    if not payload:
                        row["payload"] = None
                    rows.append(row)
                    size += 300 + len(row["payload"] or b"")
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=RECORD)
                        rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_pylist(rows, schema=RECORD)

    return files.select("path", "content").mapInArrow(run, RECORD_DDL)


def archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, content) of the archive files below ``path``."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path", "content")


def read_arc(files: DataFrame, payload: bool = True) -> DataFrame:
    """Records of ARC archives, converted (no version blocks); see :func:`arc_records`."""
    return _records(files, arc_records, payload)


def read_warc(files: DataFrame, payload: bool = True) -> DataFrame:
    """Records of WARC archives; see :func:`warc_records`."""
    return _records(files, warc_records, payload)


def revisits(records: DataFrame, least_bytes: int = LEAST_REVISIT) -> DataFrame:
    """(record_id, refers_to_id, refers_to_uri, refers_to_date) of the records
    that only repeat a payload.  Of equal payloads of ``least_bytes`` or more
    the record with the largest source id (null lowest), then record id, stays.

    Only digests that occur twice or more are joined back, on digest and
    length; payloads are not moved."""
    small = records.where(F.col("error").isNull() & (F.col("payload_bytes") >= least_bytes)) \
        .select("record_id", "source_id", "payload_sha1", "payload_bytes", "uri", "date")
    key = ["payload_sha1", "payload_bytes"]
    stays = F.max(F.struct("source_id", "record_id", "uri", "date")).alias("stays")
    groups = small.groupBy(*key).agg(F.count("*").alias("n"), stays).where("n > 1").select(*key, "stays")
    met = small.select("record_id", *key).join(groups, key)
    return met.where("record_id <> stays.record_id").select(
        "record_id", F.col("stays.record_id").alias("refers_to_id"), F.col("stays.uri").alias("refers_to_uri"),
        F.col("stays.date").alias("refers_to_date"))


def _line(name: str, value: Column) -> Column:
    """A header line, or nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit("\r\n")), F.lit(""))


def write_warc(records: DataFrame, path: str, records_per_file: int = 20_000) -> None:
    """Write records with their ``payload`` (and, for revisits, refers_to_id,
    refers_to_uri, refers_to_date) as gzip WARC files.  A revisit keeps its
    HTTP head and no payload.  Records with ``error`` are left out."""
    revisit = F.col("refers_to_id").isNotNull()
    head = F.encode("head", "ISO-8859-1")
    block = F.concat(head, F.when(revisit, F.lit(b"")).otherwise(F.coalesce("payload", F.lit(b""))))
    kind = F.when(revisit, "revisit").otherwise(F.col("type"))
    block_sha1 = F.when(revisit, F.sha1(head)).otherwise(F.col("block_sha1"))
    content_type = F.when(F.length("head") > 0, "application/http; msgtype=response").otherwise(F.col("content_type"))
    lines = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind), _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", F.coalesce("date", F.lit("1970-01-01T00:00:00Z"))), _line("WARC-Target-URI", F.col("uri")),
        _line("WARC-IP-Address", F.col("ip")), _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "payload_sha1")),
        _line("WARC-Block-Digest", F.concat(F.lit("sha1:"), block_sha1)),
        _line("WARC-Profile", F.when(revisit, REVISIT_PROFILE)), _line("WARC-Refers-To", F.col("refers_to_id")),
        _line("WARC-Refers-To-Target-URI", F.when(revisit, F.col("refers_to_uri"))),
        _line("WARC-Refers-To-Date", F.when(revisit, F.col("refers_to_date"))), _line("Content-Type", content_type),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"))
    whole = F.concat(F.encode(lines, "UTF-8"), block, F.lit(b"\r\n"))
    # the sink adds the record's last line end
    records.where("error is null").select(whole.cast("string").alias("value")).write.option("lineSep", "\r\n") \
        .option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED") \
        .option("maxRecordsPerFile", records_per_file).text(path)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least_bytes: int = LEAST_REVISIT) -> int:
    """Convert the ARC files below ``arc_path`` to WARC files in ``warc_path``.
    What could not be read is written beside them, to ``<warc_path>-errors``
    (archive, offset, error), and counted: the result.  Empty archives give no
    records; repeated archives give repeated ones."""
    heads = stored(read_arc(archives(spark, arc_path), payload=False).drop("payload", "head"), "arc-heads")
    errors = heads.where("error is not null").select("archive", "offset", "error")
    n = errors.count()
    if n:
        errors.write.json(f"{warc_path}-errors")
    again = stored(revisits(heads, least_bytes), "revisits")
    records = read_arc(archives(spark, arc_path)).drop("refers_to_id")
    write_warc(records.join(again, "record_id", "left"), warc_path)
    return n


def write_pages_as_arc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
                       date: str = "20000101000000") -> None:
    """A table of pages as ARC files, every other one of version 2: the legacy
    archives that :func:`convert` reads.  Null pages are empty ones, a null
    URL becomes ``urn:none``, white space in URLs is escaped; every row is a
    record of its own.  One file per ``ARCHIVE_BYTES`` or longer page."""
    rows = keyed(pages, id=id_col, url=url_col, html=html_col).withColumn("id", F.col("id").cast("bigint"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, number, parts, size = TaskContext.get().partitionId(), 0, [], 0

        def archive() -> pa.RecordBatch:
            version = "12"[(task + number) % 2]
            name = f"pages-{task:06d}-{number:06d}.arc"
            body = f"{version} 0 pages\n{ARC_FIELDS[version]}\n"
            extra = f"200 - - 0 {name} " if version == "2" else ""
            text = [f"filedesc://{name} 0.0.0.0 {date} text/plain {extra}{len(body)}\n{body}"]
            at = len(text[0]) + 1
            for url, block in parts:
                more = f"200 - - {at} {name} " if version == "2" else ""
                n = len(block.encode("utf-8", "surrogatepass"))
                line = f"{url} 0.0.0.0 {date} text/html {more}{n}\n"
                text.append(line + block)
                at += len(line) + n + 1
            return pa.record_batch([pa.array(["\n".join(text)], pa.large_string() if size > 1 << 30 else pa.string())], names=["value"])

        for b in batches:
            for i, url, html in zip(b.column("id").to_pylist(), b.column("url").to_pylist(), b.column("html").to_pylist()):
                html = html or ""
                n = len(html.encode("utf-8", "surrogatepass"))
                own = "" if i is None else f"{SOURCE_HEADER}: {i}\r\n"
                head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n}\r\n{own}\r\n"
                parts.append((quote(url or "urn:none", safe="%/:=&?~#+!$,;'@()*[]"), head + html))
                size += n + 200
                if size >= ARCHIVE_BYTES:
                    yield archive()
                    number, parts, size = number + 1, [], 0
        if parts:
            yield archive()

    # a row is a file; the sink adds its last line end
    rows.mapInArrow(run, "value string").write.option("lineSep", "\n").option("compression", "gzip") \
        .option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", 1).text(path)
