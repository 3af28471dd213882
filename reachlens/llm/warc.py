"""WARC archives: a writer with revisit records, and a salvage reader.

The writer builds each record as a column and writes it through Spark's text
sink, whose line separator is a record's last byte: any file system that Spark
reaches will do, and a lost task is run again. The reader checks every record
(version line, header, length, closing blank lines, digests; of gzip members
also CRC and size). After a failed check it looks for the next member or version
line that passes, goes on from there, and reports the bytes between as a gap.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import packed, prepare, stored

DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 4000
MEMBER = b"\x1f\x8b\x08"
#: Anywhere, as a cut record leaves the next one in the middle of a line; what follows must pass all checks.
START = re.compile(rb"WARC/1\.[01]\r\n|\x1f\x8b\x08")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of a SHA-1: each 40 bits as 8 digits of base 32, in the alphabet A-Z2-7."""
    hexed = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(hexed, 1 + 10 * k, 10), 16, 32), 8, "0") for k in range(4)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_types(pages: DataFrame, id_col: str, payload_col: str, min_bytes: int = 0) -> DataFrame:
    """``row`` (all columns), id, payload, refers_to: null for responses, else the largest id with that payload.

    Payloads under ``min_bytes`` are never revisits. A null id is never
    referred to unless no copy has one; rows that repeat the largest id are all
    responses.
    """
    payload = F.coalesce(F.col(payload_col), F.lit(""))
    copies = pages.filter(F.octet_length(payload) >= min_bytes).groupBy(F.sha2(payload, 256).alias("same")).agg(F.max(id_col).alias("last"), F.count("*").alias("n"))
    copies = stored(copies.filter("n > 1").select("same", "last"), "payload-copies")
    rows = pages.select(F.col(id_col).alias("id"), payload.alias("payload"), packed(pages)).withColumn("same", F.sha2("payload", 256))
    rows = rows.join(copies, "same", "left")
    return rows.select("row", "id", "payload", F.when(F.col("last").isNotNull() & ~F.col("id").eqNullSafe(F.col("last")), F.col("last")).alias("refers_to"))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, records_per_file: int = RECORDS_PER_FILE) -> str:
    """Write a record per row below ``path``; returns ``path``."""
    rows = record_types(pages, id_col, payload_col, min_bytes)
    eol = "\r\n"
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.octet_length("payload").cast("string"), F.lit(eol * 2))
    rows = rows.withColumn("block", F.when(F.col("refers_to").isNull(), F.concat(head, "payload")).otherwise(head))
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    url = F.regexp_replace(F.col(f"row.`{url_col}`"), "[\\x00-\\x20]+", "%20")
    line = lambda name, value: F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(eol)), F.lit(""))
    record = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(F.col("refers_to").isNull(), "response").otherwise("revisit")),
        line("WARC-Record-ID", urn(F.col("id"))), line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", url),
        line("WARC-Refers-To", urn(F.col("refers_to"))), line("WARC-Profile", F.when(F.col("refers_to").isNotNull(), PROFILE)),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("payload")))),
        line("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(F.col("block")))),
        line("Content-Type", F.lit("application/http; msgtype=response")), line("Content-Length", F.octet_length("block").cast("string")),
        F.lit(eol), F.col("block"), F.lit("\r\n\r"))
    rows.select(record.alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", records_per_file).text(path)
    return path


def sha1_digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _plain(data: bytes, at: int) -> tuple[int, dict, bytes] | None:
    """(end, header, payload) of the record at ``at``, or None if a check fails."""
    if not (m := START.match(data, at)) or data[at] == 0x1F:
        return None
    header, low = {}, m.end()
    # headers may be of any length, as urls are; a line without a colon ends what is none
    while (stop := data.find(b"\r\n", low)) != low:
        name, colon, value = data[low:max(stop, low)].partition(b":")
        if not colon:
            return None
        header[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
        low = stop + 2
    size = header.get("content-length", "")
    if not size.isdecimal():
        return None
    low, end = stop + 2, stop + 2 + int(size)
    if data[end:end + 4] != b"\r\n\r\n":
        return None
    block = data[low:end]
    if (said := header.get("warc-block-digest", "")).startswith("sha1:") and said[5:] != sha1_digest(block):
        return None
    payload = block
    if header.get("content-type", "").startswith("application/http"):
        payload = block.partition(b"\r\n\r\n")[2]
    if header.get("warc-type") != "revisit" and (said := header.get("warc-payload-digest", "")).startswith("sha1:") and said[5:] != sha1_digest(payload):
        return None
    return end + 4, header, payload


def _member(data: bytes, at: int) -> tuple[int, dict, bytes] | None:
    """The one record of the gzip member at ``at``, or None."""
    unzip, out, low = zlib.decompressobj(31), [], at
    try:
        while not unzip.eof:
            if low >= len(data):
                return None
            out.append(unzip.decompress(data[low:low + (1 << 16)]))
            low += 1 << 16
    except zlib.error:
        return None
    end = min(low, len(data)) - len(unzip.unused_data)
    record = _plain(text := b"".join(out), 0)
    return (end, *record[1:]) if record and record[0] == len(text) else None


def salvage(data: bytes) -> Iterator[tuple[int, int, dict | None, bytes]]:
    """(start, end, header, payload) of each sound record in order; header is None for a gap.

    Gaps and records cover ``data`` from end to end.
    """
    at = bad = 0
    while at < len(data):
        record = _member(data, at) if data.startswith(MEMBER, at) else _plain(data, at)
        if record:
            if bad < at:
                yield bad, at, None, b""
            yield at, *record
            at = bad = record[0]
        else:
            m = START.search(data, at + 1)
            at = m.start() if m else len(data)
    if bad < len(data):
        yield bad, len(data), None, b""


FIELDS = {"warc-type": "type", "warc-record-id": "record_id", "warc-refers-to": "refers_to", "warc-target-uri": "url", "warc-payload-digest": "digest"}


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """All records and gaps of the archives below ``path``, plain or gzip by member.

    archive, start, end, gap, type, record_id, refers_to, url, digest,
    payload_bytes, payload_digest (of the bytes read), payload. One task reads
    an archive; its memory is a few times the archive's size, which the writer
    bounds. Rows with ``gap`` are the quarantined byte ranges.
    """
    schema = ("archive string, start bigint, `end` bigint, gap boolean, type string, record_id string, refers_to string, url string, digest string, "
              "payload_bytes bigint, payload_digest string" + ", payload binary" * with_payload)

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows = []
                for start, end, header, payload in salvage(content.as_py()):
                    row = {"archive": name.as_py(), "start": start, "end": end, "gap": header is None}
                    if header is not None:
                        row |= {to: header.get(key) for key, to in FIELDS.items()} | {"payload_bytes": len(payload), "payload_digest": sha1_digest(payload)}
                        if with_payload:
                            row["payload"] = payload
                    rows.append(row)
                    if len(rows) >= 1000:
                        yield pa.RecordBatch.from_pylist(rows, shape)
                        rows = []
                yield pa.RecordBatch.from_pylist(rows, shape)

    text, count = pa.string(), pa.int64()
    shape = pa.schema([("archive", text), ("start", count), ("end", count), ("gap", pa.bool_()), ("type", text), ("record_id", text), ("refers_to", text), ("url", text),
                       ("digest", text), ("payload_bytes", count), ("payload_digest", text)] + [("payload", pa.binary())] * with_payload)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "[!_.]*").load(path)
    return files.select("path", "content").mapInArrow(parse, schema)


def round_trip(pages: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write ``pages``, read the archives back: page_id, payload_bytes, payload_digest, record_type, refers_to.

    A revisit's size and digest are those of the response that it refers to.
    A null html is an empty payload; a null url or id leaves its line out. An
    empty table gives no rows; a gap in what was just written is an error.
    """
    spark = prepare(pages.sparkSession)
    path = path or f"{ensure_checkpoint_dir(spark)}/warc/{uuid.uuid4().hex}"
    write_warc(pages, path, **options)
    number = lambda c: F.regexp_extract(c, "^<urn:page:(-?\\d+)>$", 1).try_cast("bigint")
    found = stored(read_warc(spark, path, with_payload=False).select(
        "archive", "start", "gap", number(F.col("record_id")).alias("page_id"), F.col("type").alias("record_type"), number(F.col("refers_to")).alias("refers_to"),
        "payload_bytes", "payload_digest", F.regexp_replace("digest", "^sha1:", "").alias("said")), "warc-records")
    if lost := found.filter("gap").select("archive", "start").first():
        raise ValueError(f"{lost.archive} cannot be read back from byte {lost.start}")
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    responses = found.filter("record_type = 'response'").select(*columns)
    revisits = found.filter("record_type = 'revisit'").select("page_id", "record_type", "refers_to", F.col("said").alias("payload_digest"))
    aims = responses.select(F.col("page_id").alias("refers_to"), "payload_digest", "payload_bytes").distinct()
    aims = stored(aims.join(revisits.select("refers_to", "payload_digest").distinct(), ["refers_to", "payload_digest"]), "warc-aims")
    return responses.unionByName(revisits.join(aims, ["refers_to", "payload_digest"]).select(*columns))
