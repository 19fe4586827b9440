"""Legacy web archives (ARC, versions 1 and 2) converted to WARC.

``write_arc`` makes ARC files of pages, ``convert`` turns ARC files into WARC files and
``read_warc`` reads these back. An archive is a folder of gzipped volumes of about
``VOLUME_BYTES``; a volume is the unit that one task parses by its declared lengths.

Defined results. A null html is an empty payload, a null url becomes ``urn:page:<id>``, and
spaces in a url are percent-encoded. A page without an id keeps a null id. Records with
equal payloads of at least ``REVISIT_BYTES`` are revisits of the one with the largest
page_id (records that repeat that page_id are all responses); a group without any id
has responses only. Smaller payloads are always responses. Extra columns of the pages are
dropped. A record longer than a volume is a volume of its own. An empty table gives
archives without records. Bytes that are not UTF-8 become U+FFFD, and the digests
are those of what is written. A declared length that points beyond the file is an error.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from walletyield.llm.common import stored

VOLUME_BYTES = 8 << 20
REVISIT_BYTES = 1000
ARC_DATE = "20000101000000"
#: The fields of a header line by ARC version; a format, so these are fixed values.
ARC_FIELDS = {
    1: ["URL", "IP-address", "Archive-date", "Content-type", "Archive-length"],
    2: ["URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename",
        "Archive-length"],
}
ID_HEADER = "X-Page-Id"
VOLUME_SCHEMA = "volume int, seq long, value string"


def _write_volumes(rows: DataFrame, folder: str, separator: str) -> None:
    """One file for each task and volume, records in order, each followed by the separator."""
    (rows.sortWithinPartitions("volume", "seq").select("value", "volume").write.partitionBy("volume")
     .option("compression", "gzip").option("lineSep", separator).text(folder))


def _volumes(records: Iterator[str], head) -> Iterator[pa.RecordBatch]:
    """Deals records to volumes; ``head(volume)`` is the first record of each."""
    volume, size, seq, rows = -1, VOLUME_BYTES, 0, []
    for text in records:
        if size >= VOLUME_BYTES:
            if rows:
                yield _batch(rows)
            volume, size, rows = volume + 1, 0, [(volume + 1, seq, head(volume + 1))]
            seq += 1
        rows.append((volume, seq, text))
        seq += 1
        size += len(text)
    if rows:
        yield _batch(rows)


def _batch(rows) -> pa.RecordBatch:
    volume, seq, value = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(volume, pa.int32()), pa.array(seq, pa.int64()), pa.array(value, pa.string())],
                                      names=["volume", "seq", "value"])


def arc_line(version: int, url: str, date: str, mime: str, length: int, name: str) -> str:
    rest = [str(length)] if version == 1 else ["200", "-", "-", "0", name, str(length)]
    return " ".join([url, "0.0.0.0", date, mime, *rest])


def write_arc(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
              date: str = ARC_DATE) -> None:
    """Pages as ARC volumes; tasks with an even number write version 1, the others version 2."""
    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), F.coalesce(F.col(html_col), F.lit("")))

    def run(batches):
        task = TaskContext.get().partitionId()
        version = 1 + task % 2

        def head(volume: int) -> str:
            name = f"pages-{task}-{volume}.arc"
            about = f"{version} 0 walletyield\n{' '.join(ARC_FIELDS[version])}\n"
            return arc_line(version, f"filedesc://{name}", date, "text/plain", len(about), name) + "\n" + about

        def records():
            for batch in batches:
                for page, url, html in zip(*(c.to_pylist() for c in batch.columns)):
                    size = len(html.encode("utf-8"))
                    own = "" if page is None else f"{ID_HEADER}: {page}\r\n"
                    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n{own}\r\n"
                    url = f"urn:page:{page}" if url is None else "%20".join(url.split())
                    yield arc_line(version, url, date, "text/html", len(block) + size, "-") + "\n" + block + html

        yield from _volumes(records(), head)

    _write_volumes(rows.mapInArrow(run, VOLUME_SCHEMA), folder, "\n")


@dataclass
class ArcRecord:
    offset: int
    url: str
    date: str
    mime: str
    block: bytes

    @property
    def http(self) -> tuple[bytes, bytes]:
        """The HTTP head with its closing empty line, and the payload."""
        if not self.block.startswith(b"HTTP/"):
            return b"", self.block
        head, end, payload = self.block.partition(b"\r\n\r\n")
        return head + end, payload

    @property
    def page_id(self) -> int | None:
        return header_id(self.http[0])


def header_id(head: bytes) -> int | None:
    mark = f"\r\n{ID_HEADER}: ".encode()
    _, found, rest = head.partition(mark)
    return int(rest.partition(b"\r\n")[0]) if found else None


def parse_arc(data: bytes) -> Iterator[ArcRecord]:
    """Records of one ARC file; the version block says which fields a header line has."""
    at, fields = 0, None
    while at < len(data):
        if data[at : at + 1] == b"\n":
            at += 1
            continue
        stop = data.index(b"\n", at)
        line = data[at:stop].decode("utf-8", "replace")
        begin, size = stop + 1, int(line.rpartition(" ")[2])
        block = data[begin : begin + size]
        if len(block) < size:
            raise ValueError(f"the record at byte {at} declares {size} bytes, {len(block)} are left")
        if fields is None:
            if not line.startswith("filedesc://"):
                raise ValueError("an ARC file begins with its version block")
            fields = ARC_FIELDS[int(block.split(b" ", 1)[0])]
        else:
            values = dict(zip(fields, line.rsplit(" ", len(fields) - 1)))
            yield ArcRecord(at, values["URL"], values["Archive-date"], values["Content-type"], block)
        at = begin + size


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").option("recursiveFileLookup", "true").load(folder)
            .select(F.col("path").alias("file"), "content"))


def arc_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """file, offset, page_id, payload_bytes, digest (hex) of every record."""
    def run(batches):
        for batch in batches:
            for file, data in zip(batch.column(0), batch.column(1)):
                rows = []
                for r in parse_arc(gzip.decompress(data.as_py())):
                    payload = _clean(r.http[1])
                    rows.append((r.offset, r.page_id, len(payload), hashlib.sha1(payload).hexdigest()))
                if rows:
                    cols = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int64(), pa.int64(), pa.int64(), pa.string()))]
                    yield pa.RecordBatch.from_arrays([pa.array([file.as_py()] * len(rows), pa.string()), *cols],
                                                     names=["file", "offset", "page_id", "payload_bytes", "digest"])

    return _files(spark, folder).mapInArrow(run, "file string, offset long, page_id long, payload_bytes long, digest string")


def _clean(data: bytes) -> bytes:
    return data.decode("utf-8", "replace").encode("utf-8")


def revisits(payloads: DataFrame, least_bytes: int = REVISIT_BYTES) -> DataFrame:
    """file, offset, response: the records that revisit another, and that one's page_id."""
    large = payloads.where(F.col("payload_bytes") >= least_bytes)
    top = (large.groupBy("digest", "payload_bytes").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
           .where("n > 1 AND response IS NOT NULL").drop("n"))
    return (large.join(top, ["digest", "payload_bytes"])
            .where("page_id IS NULL OR page_id < response").select("file", "offset", "response"))


def warc_record(kind: str, fields: dict[str, str], block: str) -> str:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", *(f"{k}: {v}" for k, v in fields.items()),
             f"Content-Length: {len(block.encode('utf-8'))}"]
    return "\r\n".join(lines) + "\r\n\r\n" + block


def _digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page: int | None, digest: str, offset: int) -> str:
    return f"<urn:page:{page}>" if page is not None else f"<urn:record:{digest[5:]}:{offset}>"


def to_warc(r: ArcRecord, response: int | None) -> str:
    """One ARC record as a WARC response, revisit (of page ``response``) or resource."""
    head, payload = r.http
    head, payload = _clean(head), _clean(payload)
    digest = _digest(payload)
    d = r.date.ljust(14, "0")
    fields = {
        "WARC-Record-ID": _record_id(r.page_id, digest, r.offset),
        "WARC-Date": f"{d[:4]}-{d[4:6]}-{d[6:8]}T{d[8:10]}:{d[10:12]}:{d[12:14]}Z",
        "WARC-Target-URI": r.url,
        "WARC-Payload-Digest": digest,
        "Content-Type": "application/http; msgtype=response" if head else r.mime,
    }
    if response is not None:
        fields |= {"WARC-Refers-To": f"<urn:page:{response}>", "X-Payload-Length": str(len(payload)),
                   "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
        return warc_record("revisit", fields, head.decode())
    fields["WARC-Block-Digest"] = _digest(head + payload)
    return warc_record("response" if head else "resource", fields, (head + payload).decode())


def convert(spark: SparkSession, arc: str, warc: str, least_bytes: int = REVISIT_BYTES) -> None:
    """ARC volumes to WARC volumes.

    The first pass reads digests only; what is a revisit is then known by file and offset,
    and joins the files as one short list each, so no payload is dealt by its digest.
    """
    payloads = stored(arc_payloads(spark, arc), "arc-payloads")
    marks = (revisits(payloads, least_bytes).groupBy("file")
             .agg(F.collect_list(F.struct("offset", "response")).alias("marks")))

    def run(batches):
        task = TaskContext.get().partitionId()

        def head(volume: int) -> str:
            about = "software: walletyield\r\nformat: WARC File Format 1.1\r\n"
            return warc_record("warcinfo", {"WARC-Record-ID": f"<urn:volume:{task}:{volume}>", "WARC-Date": "2000-01-01T00:00:00Z",
                                            "WARC-Filename": f"pages-{task}-{volume}.warc.gz",
                                            "Content-Type": "application/warc-fields"}, about)

        def records():
            for batch in batches:
                for data, marks in zip(batch.column(0), batch.column(1)):
                    response = {m["offset"]: m["response"] for m in marks.as_py() or []}
                    for r in parse_arc(gzip.decompress(data.as_py())):
                        yield to_warc(r, response.get(r.offset))

        yield from _volumes(records(), head)

    rows = _files(spark, arc).join(marks, "file", "left").select("content", "marks")
    _write_volumes(rows.mapInArrow(run, VOLUME_SCHEMA), warc, "\r\n\r\n")


def parse_warc(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of one WARC file."""
    at = 0
    while at < len(data):
        stop = data.index(b"\r\n\r\n", at)
        lines = data[at:stop].decode("utf-8", "replace").split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no record begins at byte {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        begin, size = stop + 4, int(fields["Content-Length"])
        if begin + size > len(data):
            raise ValueError(f"the record at byte {at} declares {size} bytes, {len(data) - begin} are left")
        yield fields, data[begin : begin + size]
        at = begin + size + 4


def read_warc(spark: SparkSession, folder: str, with_payload: bool = False) -> DataFrame:
    """page_id, url, payload_bytes, payload_digest (hex), record_type, refers_to of the
    response, resource and revisit records; payload as well on demand (null in revisits)."""
    kinds = [("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
             ("record_type", pa.string()), ("refers_to", pa.int64()), *([("payload", pa.binary())] if with_payload else [])]

    def one(fields: dict[str, str], block: bytes) -> tuple:
        kind, digest = fields["WARC-Type"], fields["WARC-Payload-Digest"]
        head, end, payload = block.partition(b"\r\n\r\n") if block.startswith(b"HTTP/") else (b"", b"", block)
        refers, size = None, len(payload)
        if kind == "revisit":
            refers, size, payload = int(fields["WARC-Refers-To"][10:-1]), int(fields["X-Payload-Length"]), None
        elif _digest(payload) != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} differs from its digest")
        row = (header_id(head + end), fields["WARC-Target-URI"], size, base64.b32decode(digest[5:]).hex(), kind, refers)
        return (*row, payload) if with_payload else row

    def run(batches):
        for batch in batches:
            for data in batch.column(1):
                rows = [one(f, b) for f, b in parse_warc(gzip.decompress(data.as_py())) if f["WARC-Type"] != "warcinfo"]
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(zip(*rows), kinds)],
                                                     names=[n for n, _ in kinds])

    return _files(spark, folder).mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, "
                                            "record_type string, refers_to long" + ", payload binary" * with_payload)
