"""Legacy ARC archives, their conversion to WARC, and reading both back.

Archives are written by Spark's text sink, whose line separator is the end of a record, so they reach any file system
that Spark does and come with its commit protocol; a file is one gzip stream. They are read as whole files, which are
as large as a task's share of the rows, and parsed by the declared lengths as a stream.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..workspace import new_folder
from .workers import importable

#: The fields of a URL record's header line, by ARC version. The last is the declared length.
ARC_FIELDS = {
    1: ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length"),
    2: ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"),
}
ARC_END, WARC_END = "\n", "\r\n\r\n"
#: Namespace of record ids, so that converting an archive again gives the same ids.
RECORDS = uuid.uuid5(uuid.NAMESPACE_URL, "urn:silofeed:arc-records")
PIECE = 1 << 16
BATCH_BYTES = 1 << 23

ARC_RECORD = (
    "archive string, position long, version int, url string, ip string, date string, mime string, status string, "
    "headers string, payload binary"
)
WARC_RECORD = (
    "archive string, position long, record_id string, type string, url string, date string, mime string, "
    "payload_digest string, refers_to_id string, page_id long, payload_length long, payload binary"
)


def digest(payload: bytes) -> str:
    """Base32 SHA-1, as WARC headers have it."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _write(records: DataFrame, folder: str, end: str) -> str:
    """One archive for each partition of the column ``record``."""
    sink = records.select(F.col("record").cast("string").alias("record")).write
    sink.option("lineSep", end).option("zlib.compress.level", "BEST_SPEED").text(folder, compression="gzip")
    return folder


def write_arc(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
              version: Callable[[int], int] = lambda task: 1 + task % 2, date: str = "20240101000000") -> str:
    """ARC archives of pages as HTTP responses; the new folder's name. ``version`` is by number of the task.

    Null bodies are empty. White space in a URL is percent-encoded; a page without one gets ``urn:page``. The id goes
    into a response header; a null id leaves it out.
    """
    importable(pages.sparkSession)
    columns = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"),
                           F.coalesce(F.col(body_col).cast("binary"), F.lit(b"")).alias("body"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        kind = version(task)
        first = True
        for batch in batches:
            records = []
            if first and batch.num_rows:
                names = " ".join(ARC_FIELDS[kind])
                block = f"{kind} 0 silofeed\n{names}\n".encode()
                fields = _arc_line(kind, f"filedesc://pages-{task}.arc", "0.0.0.0", date, "text/plain", "200", len(block))
                records.append(fields + block)
                first = False
            for page, url, body in zip(*(batch.column(i) for i in range(3)), strict=True):
                body = body.as_py()
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                if page.is_valid:
                    head += b"X-Page-Id: %d\r\n" % page.as_py()
                block = head + b"Content-Length: %d\r\n\r\n" % len(body) + body
                address = "".join("%%%02X" % ord(c) if c.isspace() and ord(c) < 256 else c for c in url.as_py() or "")
                records.append(_arc_line(kind, address.replace(" ", "") or "urn:page", "0.0.0.0", date, "text/html",
                                         "200", len(block)) + block)
            yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])

    return _write(columns.mapInArrow(write, "record binary"), new_folder(pages.sparkSession, "arc"), ARC_END)


def _arc_line(version: int, url: str, ip: str, date: str, mime: str, status: str, length: int) -> bytes:
    values = {"URL": url, "IP-address": ip, "Archive-date": date, "Content-type": mime, "Result-code": status,
              "Archive-length": str(length), "Offset": "0"}
    return (" ".join(values.get(name, "-") for name in ARC_FIELDS[version]) + "\n").encode()


class Bytes:
    """A gzip stream, or plain bytes, read by lines and lengths; holds one record and a piece."""

    def __init__(self, data: bytes) -> None:
        self.data, self.at = memoryview(data), 0
        self.held, self.start = b"", 0
        self.zip = zlib.decompressobj(31) if data[:2] == b"\x1f\x8b" else None

    def more(self) -> bool:
        """Read a piece more; what has been taken is let go."""
        while True:
            if self.zip and self.zip.eof:  # a file of many gzip members
                rest, self.zip = self.zip.unused_data, zlib.decompressobj(31)
                got = self.zip.decompress(rest) if rest else b""
            elif self.at >= len(self.data):
                return False
            else:
                piece = self.data[self.at : self.at + PIECE]
                self.at += PIECE
                got = self.zip.decompress(piece) if self.zip else bytes(piece)
            if got:
                self.held, self.start = self.held[self.start :] + got, 0
                return True

    def line(self) -> bytes | None:
        """The next line without its end; null at the end of the file."""
        while (end := self.held.find(b"\n", self.start)) < 0:
            if not self.more():
                end = len(self.held)
                break
        if self.start >= len(self.held):
            return None
        line, self.start = self.held[self.start : end], end + 1
        return line.rstrip(b"\r")

    def take(self, length: int) -> bytes:
        pieces, missing = [], length
        while len(self.held) - self.start < missing:
            pieces.append(self.held[self.start :])
            missing -= len(pieces[-1])
            self.start = len(self.held)
            if not self.more():
                raise ValueError(f"an archive ends {missing} bytes early")
        pieces.append(self.held[self.start : self.start + missing])
        self.start += missing
        return b"".join(pieces)


@dataclass
class ArcRecord:
    version: int
    fields: dict[str, str]
    block: bytes


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of an archive, the version block aside, by the header lines that its version has.

    An archive names its version and fields in its first record; one that does not is taken as version 1.
    """
    source, version, names = Bytes(data), 1, ARC_FIELDS[1]
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        values = line.decode("utf-8", "replace").split(" ")
        if line.startswith(b"filedesc:"):
            block = source.take(int(values[-1])).decode("utf-8", "replace").split("\n")
            version = int(block[0].split(" ")[0])
            names = ARC_FIELDS.get(version) or tuple(block[1].split(" "))
            continue
        if len(values) != len(names):
            raise ValueError(f"{len(values)} fields in a header line of ARC version {version}: {line[:200]!r}")
        yield ArcRecord(version, dict(zip(names, values, strict=True)), source.take(int(values[-1])))


def split_http(block: bytes) -> tuple[str, bytes] | None:
    """Head and body of an HTTP response; null if the block is none."""
    if not block.startswith(b"HTTP/"):
        return None
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        head, _, body = block.partition(b"\n\n")
    return head.decode("utf-8", "replace"), body


def _files(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content")


def warc_date(date: str) -> str:
    """ISO time of an ARC date of 14 digits, or of 12 or 8 as old archives have; null is the epoch."""
    digits = ("".join(c for c in date if c.isdigit()) + "00000000000000")[:14] if date else "19700101000000"
    d = digits if digits[4:8] != "0000" else digits[:4] + "0101" + digits[8:]
    return f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z"


def read_arc(spark: SparkSession, folder: str) -> DataFrame:
    """Records of ARC archives as WARC records in waiting: with synthesised id, type, time and digest.

    HTTP responses become ``response``, other records ``resource``. An id follows from archive, position, URL, and
    date, so it stays when a task is repeated.
    """
    importable(spark)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                name = path.rsplit("/", 1)[-1]
                rows, size = [], 0
                for position, record in enumerate(parse_arc(content.as_buffer().to_pybytes())):
                    row = converted(name, position, record)
                    rows.append(row)
                    size += len(row["payload"])
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, CONVERTED)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, CONVERTED)

    return _files(spark, folder).mapInArrow(read, WARC_RECORD + ", head string")


CONVERTED = pa.schema([
    ("archive", pa.string()), ("position", pa.int64()), ("record_id", pa.string()), ("type", pa.string()),
    ("url", pa.string()), ("date", pa.string()), ("mime", pa.string()), ("payload_digest", pa.string()),
    ("refers_to_id", pa.string()), ("page_id", pa.int64()), ("payload_length", pa.int64()), ("payload", pa.binary()),
    ("head", pa.string()),
])


def converted(archive: str, position: int, record: ArcRecord) -> dict:
    """The WARC record that is equivalent to an ARC record."""
    url, date = record.fields["URL"], record.fields["Archive-date"]
    http = split_http(record.block)
    head, payload = http or (None, record.block)
    page = next((line.split(":", 1)[1].strip() for line in (head or "").splitlines()
                 if line.lower().startswith("x-page-id:")), None)
    return {
        "archive": archive, "position": position,
        "record_id": f"urn:uuid:{uuid.uuid5(RECORDS, f'{archive} {position} {url} {date}')}",
        "type": "response" if http else "resource", "url": url, "date": warc_date(date),
        "mime": "application/http; msgtype=response" if http else record.fields["Content-type"],
        "payload_digest": digest(payload), "refers_to_id": None, "page_id": int(page) if page else None,
        "payload_length": len(payload), "payload": payload, "head": head,
    }


def mark_revisits(records: DataFrame, least: int = 0) -> DataFrame:
    """Records whose payload equals that of one with a smaller id become ``revisit``, without payload.

    Only payloads of ``least`` bytes or more count. Of records with equal digest the one with the smallest page id,
    then record id, stays. Null page ids sort last.
    """
    rank = F.struct(F.col("page_id").isNull().alias("none"), F.col("page_id"), F.col("record_id"))
    first = records.where((F.col("payload_length") >= least) & (F.col("type") == "response")).groupBy(
        F.col("payload_digest").alias("digest")).agg(F.min(rank)["record_id"].alias("original"), F.count("*").alias("n"))
    shared = first.where("n > 1").drop("n")
    met = records.join(shared, (F.col("payload_digest") == F.col("digest")) & (F.col("type") == "response")
                       & (F.col("payload_length") >= least), "left")
    again = F.col("original").isNotNull() & (F.col("original") != F.col("record_id"))
    return met.select(*[
        F.when(again, F.lit("revisit")).otherwise(F.col("type")).alias("type") if c == "type"
        else F.when(again, F.col("original")).alias("refers_to_id") if c == "refers_to_id"
        else F.when(~again, F.col("payload")).alias("payload") if c == "payload"
        else F.col(c) for c in records.columns
    ])


def warc_text(records: DataFrame) -> Column:
    """A WARC record's header lines and block, without the blank lines that end it."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise(F.lit(""))
    head = F.when(F.col("head").isNotNull(), F.concat(F.col("head"), F.lit("\r\n\r\n"))).otherwise(F.lit(""))
    block = F.concat(head.cast("binary"), F.coalesce("payload", F.lit(b"")))
    headers = F.concat(
        F.lit("WARC/1.0\r\n"), line("WARC-Type", F.col("type")), line("WARC-Target-URI", F.col("url")),
        line("WARC-Date", F.col("date")), line("WARC-Record-ID", F.concat(F.lit("<"), F.col("record_id"), F.lit(">"))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        line("WARC-Refers-To", F.concat(F.lit("<"), F.col("refers_to_id"), F.lit(">"))),
        line("WARC-Profile", F.when(F.col("type") == "revisit",
             F.lit("http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"))),
        line("Content-Type", F.col("mime")), line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    return F.concat(headers.cast("binary"), block)


def write_warc(records: DataFrame) -> str:
    """WARC archives of converted records; the new folder's name."""
    return _write(records.select(warc_text(records).alias("record")), new_folder(records.sparkSession, "warc"), WARC_END)


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields, by lower-case name, and block of each record of an archive."""
    source = Bytes(data)
    while (line := source.line()) is not None:
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:200]!r}")
        fields: dict[str, str] = {}
        while line := source.line():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, source.take(int(fields["content-length"]))


def read_warc(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Records of WARC archives; ``payload_length`` and digest are those of the payload at hand, null for revisits.

    A digest that differs from the declared one is an error. ``payloads=False`` leaves the payloads out.
    """
    importable(spark)
    schema = pa.schema([f for f in CONVERTED if f.name != "head"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                name = path.rsplit("/", 1)[-1]
                rows, size = [], 0
                for position, (fields, block) in enumerate(parse_warc(content.as_buffer().to_pybytes())):
                    row = _warc_row(name, position, fields, block, payloads)
                    rows.append(row)
                    size += len(row["payload"] or b"") + 256
                    if size > BATCH_BYTES:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    return _files(spark, folder).mapInArrow(read, WARC_RECORD)


def _warc_row(archive: str, position: int, fields: dict[str, str], block: bytes, payloads: bool) -> dict:
    head, payload = split_http(block) or ("", block)
    declared = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    revisit = fields["warc-type"] == "revisit"
    if not revisit and declared != (found := digest(payload)):
        raise ValueError(f"record {fields['warc-record-id']} declares {declared}, its payload has {found}")
    page = next((x.split(":", 1)[1].strip() for x in head.splitlines() if x.lower().startswith("x-page-id:")), None)
    bare = lambda x: x.strip("<>") if x else None
    return {
        "archive": archive, "position": position, "record_id": bare(fields["warc-record-id"]), "type": fields["warc-type"],
        "url": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "mime": fields.get("content-type"),
        "payload_digest": declared, "refers_to_id": bare(fields.get("warc-refers-to")),
        "page_id": int(page) if page else None, "payload_length": None if revisit else len(payload),
        "payload": None if revisit or not payloads else payload,
    }


def convert(spark: SparkSession, arc_folder: str, least: int = 0) -> str:
    """Convert a folder of ARC archives to WARC with revisit records; the new folder's name."""
    return write_warc(mark_revisits(read_arc(spark, arc_folder), least))


def resolved(records: DataFrame) -> DataFrame:
    """Records with ``payload_length`` of the full payload and ``refers_to``, the page that a revisit refers to."""
    there = records.where("type <> 'revisit'").select(
        F.col("record_id").alias("there_id"), F.col("page_id").alias("refers_to"), F.col("payload_length").alias("there_length"))
    met = records.join(there, F.col("refers_to_id") == F.col("there_id"), "left")
    return met.withColumn("payload_length", F.coalesce("payload_length", "there_length")).drop("there_id", "there_length")
