"""Legacy archives to WARC (operator 3).

``write_arc`` packs pages into ARC files of version 1 or 2, ``convert`` turns ARC files into WARC
files, ``read_warc`` reads WARC files back. Archives are real gzip files in a folder that all
executors share; Spark writes and reads them (text writer, binary file reader), Python only builds
and parses records. Records are bytes throughout, so payloads in any encoding stay as they are. An
archive is cut by records and by bytes (``ARCHIVE_BYTES``); reading decompresses piece by piece and
holds one record beside the compressed file.

Converting: the version block of an ARC file (``filedesc://``) says which header line its records
have (version 1: five fields; version 2: ten); the last field is the declared length, by which the
parser steps from record to record. Each record becomes a WARC/1.1 record with

* WARC-Record-ID: a name-based UUID of archive, offset and target, the same in every attempt;
* WARC-Date: the 14-digit (or shorter) ARC date in ISO form;
* WARC-Type: ``response``, or ``revisit`` (identical-payload-digest) where an equal payload of at
  least ``least`` bytes is kept elsewhere; records that are no HTTP responses (DNS, FTP) become
  ``resource``, version blocks ``warcinfo``;
* WARC-Payload-Digest and WARC-Block-Digest: SHA-1 in base 32.

Of records with equal payloads the one with the largest page id is the response (a null id is
smaller than any; of rows that share the largest id one, by record id, is the response). Digests
are gathered without payloads; the decisions go back to the archives, one list per archive of
bounded length, so payloads themselves are never shuffled and a group of copies of any size makes
no large task.

Defined results: a null payload is empty; null URLs become ``about:blank``, blanks and control
characters in URLs are percent-encoded; repeated pages are records of their own; very long pages
are whole; an archive that is damaged, cut off or not to be decompressed gives the records before
the damage and one row with ``error``; no pages give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerspark.session import scratch_path

from . import common

common.by_value(__name__)

RECORDS_PER_ARCHIVE = 1000
ARCHIVE_BYTES = 16 << 20             # a new archive is begun beyond
PIECE = 1 << 18                      # compressed bytes that are decompressed at a time
LONGEST_LINE = 1 << 20               # of a header line
# Fixed header lines of the two ARC versions.
ARC_FIELDS = {1: "URL IP-address Archive-date Content-type Archive-length",
              2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset "
                 "Filename Archive-length"}
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# The same lines read: URL, address, date, content type, (version 2: further fields,) length.
ARC_LINE = {1: re.compile(r"(.*) (\S+) ([0-9]{4,14}) (.*) ([0-9]+)"),
            2: re.compile(r"(.*) (\S+) ([0-9]{4,14}) (.*) \S+ \S+ \S+ \S+ \S+ ([0-9]+)")}
DIGESTS = "archive string, offset long, record_id string, page_id long, digest string, " \
          "payload_bytes long, target string, date string, http boolean, error string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, " \
          "refers_to long, record_id string, date string, error string"


# -- ARC ----------------------------------------------------------------------------------------

def _target(url: str | None) -> str:
    """A URL that can stand in a header line."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "") or "about:blank"


def _version_block(version: int, name: str, date: str) -> bytes:
    body = f"{version} 0 archive\n{ARC_FIELDS[version]}\n"
    head = f"filedesc://{name} 0.0.0.0 {date} text/plain"
    middle = "" if version == 1 else f" 200 - - 0 {name}"
    return f"{head}{middle} {len(body)}\n{body}".encode()


def _arc_record(version: int, name: str, date: str, target: str, content: bytes) -> bytes:
    middle = "" if version == 1 else f" 200 {hashlib.sha1(content).hexdigest()} - 0 {name}"
    return f"{target} 0.0.0.0 {date} text/html{middle} {len(content)}\n".encode() + content


class _Filler:
    """Records gathered to archives of bounded size; an archive is one row and one file."""

    def __init__(self, between: bytes):
        self.between, self.records, self.size = between, [], 0

    def full(self) -> bool:
        return len(self.records) > RECORDS_PER_ARCHIVE or self.size >= ARCHIVE_BYTES

    def add(self, record: bytes) -> None:
        self.records.append(record)
        self.size += len(record)

    def batch(self) -> pa.RecordBatch:
        whole = self.between.join(self.records)
        self.records, self.size = [], 0
        return pa.RecordBatch.from_arrays([pa.array([whole], pa.binary())], names=["value"])


def _write(rows: DataFrame, path: str, ending: str) -> None:
    """Each row (bytes) as a gzip file of its own; the text writer puts bytes out as they are."""
    (rows.select(F.col("value").cast("string")).write.option("compression", "gzip")
     .option("zlib.compress.level", "BEST_SPEED").option("lineSep", ending)
     .option("maxRecordsPerFile", 1).text(path))


def write_arc(pages: DataFrame, path: str, date: str = "20240101000000") -> None:
    """ARC files of at most ``RECORDS_PER_ARCHIVE`` pages (page_id, url, html) and about
    ``ARCHIVE_BYTES``; versions 1 and 2 take turns."""
    def run(batches):
        from pyspark import TaskContext
        part, number, name, version = TaskContext.get().partitionId(), 0, "", 1
        arc = _Filler(b"\n")
        for b in batches:
            for page_id, url, html in zip(*b.columns):
                if not arc.records:
                    version, name = 1 + (part + number) % 2, f"pages-{part}-{number}.arc"
                    number += 1
                    arc.add(_version_block(version, name, date))
                body = (html.as_py() or "").encode()
                number_of = "-" if page_id.as_py() is None else page_id.as_py()
                content = ("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                           f"X-Page-Id: {number_of}\r\n"
                           f"Content-Length: {len(body)}\r\n\r\n").encode() + body
                arc.add(_arc_record(version, name, date, _target(url.as_py()), content))
                if arc.full():
                    yield arc.batch()
        if arc.records:
            yield arc.batch()

    _write(pages.select(F.col("page_id").cast("long"), "url", "html")
           .mapInArrow(run, "value binary"), path, "\n")


class Damaged(ValueError):
    """An archive that cannot be parsed further."""


class _Reader:
    """The content of an archive from front to back, gzip of any number of members or plain."""

    def __init__(self, data: bytes):
        self.data, self.at = memoryview(data), 0        # compressed bytes, read so far
        self.gzip = bytes(self.data[:2]) == b"\x1f\x8b"
        self.inflate = None
        self.rest = bytearray()                          # decompressed, not yet taken
        self.offset = 0                                  # of rest within the content
        self.broken = None

    def _more(self) -> bool:
        """Some more content; False at the end or where it can't be decompressed."""
        if self.broken or self.at >= len(self.data):
            if self.inflate is not None and not self.broken:
                self.broken = "cut off within gzip data"
            return False
        piece = self.data[self.at:self.at + PIECE]
        self.at += len(piece)
        if not self.gzip:
            self.rest += piece
            return True
        self.inflate = self.inflate or zlib.decompressobj(31)
        again = self.inflate.copy()
        try:
            self.rest += self.inflate.decompress(piece)
        except zlib.error:
            return self._salvage(again, piece)
        if self.inflate.eof:                             # a member ends; blanks may pad the file
            self.at -= len(self.inflate.unused_data)
            self.inflate = None
            if not bytes(self.data[self.at:self.at + PIECE]).strip(b"\0"):
                self.at = len(self.data)
        return True

    def _salvage(self, inflate, piece) -> bool:
        """The content of a broken piece up to a few bytes before the damage."""
        n = len(self.rest)
        try:
            for at in range(0, len(piece), 32):
                self.rest += inflate.decompress(piece[at:at + 32])
        except zlib.error as e:
            self.broken = str(e)
        return len(self.rest) > n

    def fill(self, n: int) -> bool:
        """Whether ``n`` bytes are there."""
        while len(self.rest) < n:
            if not self._more():
                return False
        return True

    def until(self, mark: bytes) -> bytes | None:
        """What stands before ``mark``, which is taken too; None without it."""
        seen = 0
        while (end := self.rest.find(mark, seen)) < 0:
            seen = max(0, len(self.rest) - len(mark) + 1)
            if seen > LONGEST_LINE or not self._more():
                return None
        out = bytes(self.rest[:end])
        self.skip(end + len(mark))
        return out

    def take(self, n: int) -> bytes:
        out = bytes(self.rest[:n])
        self.skip(len(out))
        return out

    def skip(self, n: int) -> None:
        del self.rest[:n]
        self.offset += n

    def damaged(self, what: str) -> Damaged:
        return Damaged(f"{what} at byte {self.offset}" + (f": {self.broken}" if self.broken else ""))


def _arc_records(data: bytes):
    """(version, offset, [URL, address, date, content type], content) of each record, by declared
    lengths."""
    reader, version = _Reader(data), None
    while True:
        while reader.fill(1) and reader.rest[:1] in (b"\n", b"\r"):    # blank lines between records
            reader.skip(1)
        at = reader.offset
        if not reader.fill(1):
            if reader.broken:
                raise reader.damaged("no more data")
            return
        line = reader.until(b"\n")
        text = (line or b"").decode(errors="replace").rstrip("\r")
        about = text.startswith("filedesc://")
        found = None
        for v in (1, 2) if about else (version,):
            # which of the two lines a version block has is told by the block itself
            found = found or (ARC_LINE[v].fullmatch(text) if v else None)
        if not found:
            raise reader.damaged(f"no record header at byte {at}, read on")
        size = int(found[5])
        if not reader.fill(size):
            raise reader.damaged(f"record at byte {at} is shorter than declared, read on")
        content = reader.take(size)
        if about:
            first = content.split(b" ", 1)[0]
            if first not in (b"1", b"2"):
                raise Damaged(f"unknown version at byte {at}")
            version = int(first)
        yield version, at, [found[k] for k in (1, 2, 3, 4)], content


def _http(content: bytes) -> tuple[bytes, dict[str, str], bytes]:
    """Header block with its blank line, header fields, body."""
    head, blank, body = content.partition(b"\r\n\r\n")
    if not blank or not head.startswith(b"HTTP/"):
        return b"", {}, content
    fields = {}
    for line in head.decode(errors="replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.strip().lower()] = value.strip()
    return head + blank, fields, body


def _iso(date: str) -> str:
    """WARC-Date of an ARC date of 4 to 14 digits."""
    d = date + "00000101000000"[len(date):] if len(date) < 14 else date[:14]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:]}Z"


def _record_id(archive: str, offset: int, target: str) -> str:
    return f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{offset}#{target}')}"


def _base32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _archive_name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _page(fields: dict[str, str]) -> int | None:
    value = fields.get("x-page-id", "")
    return int(value) if re.fullmatch(r"-?[0-9]+", value) else None


def _archives(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path).select("path", "content")


def _digests(archives: DataFrame) -> DataFrame:
    """What deciding needs of every record, without payloads."""
    def run(batches):
        for b in batches:
            for path, content in zip(b.column(0), b.column(1)):
                name, rows = _archive_name(path.as_py()), []
                try:
                    for _, at, fields, block in _arc_records(content.as_py()):
                        if fields[0].startswith("filedesc://"):
                            continue
                        head, http, body = _http(block)
                        rows.append((name, at, _record_id(name, at, fields[0]), _page(http),
                                     hashlib.sha1(body).hexdigest(), len(body), fields[0],
                                     _iso(fields[2]), bool(head), None))
                except Damaged as e:
                    rows.append((name, *[None] * 8, str(e)))
                cols = list(zip(*rows)) or [()] * 10
                types = [pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(),
                         pa.int64(), pa.string(), pa.string(), pa.bool_(), pa.string()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, types)],
                    names=["archive", "offset", "record_id", "page_id", "digest",
                           "payload_bytes", "target", "date", "http", "error"])
    return archives.mapInArrow(run, DIGESTS)


def _revisits(digests: DataFrame, least: int) -> DataFrame:
    """Per archive: (offset, response's record id, page id, target, date) of its revisits."""
    d = digests.where((F.col("payload_bytes") >= least) & F.col("error").isNull() & F.col("http"))
    order = F.struct(F.col("page_id").isNotNull().alias("known"), "page_id", "record_id")
    kept = d.groupBy("digest", "payload_bytes").agg(
        F.count("*").alias("copies"),
        F.max_by(F.struct("record_id", "page_id", "target", "date"), order).alias("r")
    ).where("copies > 1").select("digest", "payload_bytes", "r")
    again = d.join(kept, ["digest", "payload_bytes"]).where(
        F.col("record_id") != F.col("r.record_id"))
    return again.groupBy("archive").agg(F.collect_list(
        F.struct("offset", "r.record_id", "r.page_id", "r.target", "r.date")).alias("revisits"))


# -- WARC ---------------------------------------------------------------------------------------

def _warc_record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    head = "".join(f"{k}: {v}\r\n" for k, v in fields)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block


def _converted(name: str, data: bytes, revisits: dict):
    """The WARC records of one ARC file."""
    for version, at, fields, block in _arc_records(data):
        target, date = fields[0], _iso(fields[2])
        base = [("WARC-Record-ID", f"<{_record_id(name, at, target)}>"), ("WARC-Date", date)]
        if target.startswith("filedesc://"):
            yield _warc_record([("WARC-Type", "warcinfo"), *base, ("WARC-Filename", name),
                                ("Content-Type", "application/warc-fields")],
                               f"software: converted from ARC version {version}\r\n".encode())
            continue
        head, _, body = _http(block)
        common_fields = [*base, ("WARC-Target-URI", _target(target)), ("WARC-IP-Address", fields[1]),
                         ("Content-Type", "application/http;msgtype=response" if head
                          else fields[3]), ("WARC-Payload-Digest", _base32(body))]
        to = revisits.get(at)
        if to is None:
            yield _warc_record([("WARC-Type", "response" if head else "resource"), *common_fields,
                                ("WARC-Block-Digest", _base32(block))], block)
        else:
            page = [] if to["page_id"] is None else [("X-Refers-To-Page-Id", to["page_id"])]
            yield _warc_record([("WARC-Type", "revisit"), *common_fields,
                                ("WARC-Profile", REVISIT_PROFILE),
                                ("WARC-Refers-To", f"<{to['record_id']}>"),
                                ("WARC-Refers-To-Target-URI", _target(to["target"])),
                                ("WARC-Refers-To-Date", to["date"]), *page,
                                ("WARC-Block-Digest", _base32(head))], head)


def convert(spark: SparkSession, arc_path: str, warc_path: str, least: int = 1000) -> None:
    """WARC files in ``warc_path`` from the ARC files (gzip or plain) in ``arc_path``."""
    revisits = _revisits(common.stored(_digests(_archives(spark, arc_path)), "arc-digests"), least)
    archives = _archives(spark, arc_path).withColumn(
        "archive", F.element_at(F.split("path", "/"), -1))
    both = archives.join(revisits, "archive", "left").select("archive", "content", "revisits")

    def run(batches):
        for b in batches:
            for name, content, again in zip(*b.columns):
                own = {r["offset"]: r for r in again.as_py() or []}
                warc = _Filler(b"\r\n\r\n")
                try:
                    for record in _converted(name.as_py(), content.as_py(), own):
                        warc.add(record)
                        if warc.full():
                            yield warc.batch()
                except Damaged as e:
                    warc.add(_warc_record(
                        [("WARC-Type", "metadata"), ("WARC-Filename", name.as_py()),
                         ("Content-Type", "text/plain")], f"damaged archive: {e}".encode()))
                if warc.records:
                    yield warc.batch()

    _write(both.mapInArrow(run, "value binary"), warc_path, "\r\n\r\n")


def _warc_records(data: bytes):
    """(header fields, block) of each record, by declared lengths."""
    reader = _Reader(data)
    while reader.fill(1):
        at = reader.offset
        head = reader.until(b"\r\n\r\n")
        lines = (head or b"").decode(errors="replace").split("\r\n")
        fields = {}
        for line in lines[1:]:
            key, _, value = line.partition(":")
            fields[key.strip().lower()] = value.strip()
        size = fields.get("content-length", "")
        if not lines[0].startswith("WARC/") or not size.isdigit():
            raise reader.damaged(f"no record header at byte {at}, read on")
        if not reader.fill(int(size)):
            raise reader.damaged(f"record at byte {at} is shorter than declared, read on")
        yield fields, reader.take(int(size))
        while reader.fill(1) and reader.rest[:1] in (b"\r", b"\n"):
            reader.skip(1)
    if reader.broken:
        raise reader.damaged("no more data")


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row per response, resource and revisit record. Digests of payloads that are there are
    computed from what was read and must agree with the header; a difference is reported in
    ``error``."""
    def row(fields: dict, block: bytes) -> tuple | None:
        kind = fields.get("warc-type")
        if kind == "metadata":
            return (None, None, None, kind, None, None, None, block.decode(errors="replace"))
        if kind not in ("response", "resource", "revisit"):
            return None
        _, http, body = _http(block)
        stated = fields.get("warc-payload-digest", "").removeprefix("sha1:")
        digest = base64.b32decode(stated).hex() if stated else None
        error, size = None, len(body)
        if kind != "revisit":
            if digest != hashlib.sha1(body).hexdigest():
                error = "payload digest differs"
        else:
            size = int(http.get("content-length", "0"))
        to = fields.get("x-refers-to-page-id")
        return (_page(http), size, digest, kind, int(to) if to else None,
                fields.get("warc-record-id", "").strip("<>"), fields.get("warc-date"), error)

    names = [c.split()[0] for c in RECORDS.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
             pa.string(), pa.string()]

    def run(batches):
        for b in batches:
            for content in b.column(1):
                rows = []
                try:
                    for fields, block in _warc_records(content.as_py()):
                        r = row(fields, block)
                        if r is not None:
                            rows.append(r)
                except Damaged as e:
                    rows.append((*[None] * 7, str(e)))
                cols = list(zip(*rows)) or [()] * len(names)
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                                 names=names)
    return _archives(spark, path).mapInArrow(run, RECORDS)


def archive_pages(pages: DataFrame, least: int = 1000) -> DataFrame:
    """Pages to ARC files, those to WARC files, and the records read back from these."""
    spark = pages.sparkSession
    arc, out = (scratch_path(spark, f"{kind}-{uuid.uuid4().hex}") for kind in ("arc", "warc"))
    write_arc(pages, arc)
    convert(spark, arc, out, least)
    return read_warc(spark, out)
