"""WARC files: a writer on Spark's text sink and a sequential reader.

Every record is one gzip member.  The writer packs members into rows of a few
MB and Spark's own text sink puts them into files in the shared folder, on any
file system that Spark can write.  That sink ends each row with a separator,
and a gzip member ends with the top byte of its length, 0 below 16 MiB: the
last zero of each row is left out and the separator (one zero byte) puts it
back, so the files are plain gzip.  A longer record is followed by an empty
member, which readers skip.

The reader streams a file member by member: incremental inflate, header block,
content-length framing, block and payload digest.

Defined results: a null payload counts as empty; a null id is written as
``null`` and read as null; equal payloads whose largest id occurs in several
rows are responses in all of these; if all ids of equal payloads are null, all
are responses.  Empty tables give no records.  Further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabready.llm.common import releasing, scratch_path

#: Compressed bytes of a written row, and rows of a file: a file holds about 32 MB.
ROW_BYTES, ROWS_PER_FILE = 4 << 20, 8
MIN_REVISIT_BYTES = 1000
EMPTY_MEMBER = zlib.compress(b"", 1, 31)
RECORD_SCHEMA = ("record_id string, uri string, record_type string, refers_to_id string, payload_bytes long, "
                 "payload_digest string, payload binary")


class WarcError(ValueError):
    """A record that breaks the format or does not match its digests."""


def digest32(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(record_id: str, uri: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One uncompressed record; a revisit holds the HTTP head only."""
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    if refers_to is None:
        block += payload
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", f"<{record_id}>"),
              ("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", uri)),
              ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Block-Digest", digest32(block)),
              ("WARC-Payload-Digest", digest32(payload)), ("Content-Type", "application/http; msgtype=response")]
    if refers_to is not None:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
                   ("WARC-Refers-To", f"<{refers_to}>")]
    fields.append(("Content-Length", str(len(block))))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as a gzip member that ends with a zero byte."""
    out = zlib.compress(data, 4, 31)
    return out if out[-1] == 0 else out + EMPTY_MEMBER


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: list[bytes] = []
    size = 0

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["members"])

    for batch in batches:
        for record_id, uri, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns)):
            held.append(member(record(record_id, uri or "", payload or b"", refers_to)))
            size += len(held[-1])
            if size >= ROW_BYTES:
                yield row()
                held, size = [], 0
    if held:
        yield row()


def with_revisits(pages: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """Add ``refers_to`` to ``id, uri, payload``: of equal payloads of ``min_bytes`` or
    more, rows below the largest id refer to it.

    Only digests that occur more than once come back from the aggregate.  A
    digest that fills a third of the rows is one row there; on the page side it
    is a plain equi-join, which adaptive execution splits."""
    digest = F.sha1("payload")
    rows = pages.withColumn("digest", F.when(F.octet_length("payload") >= min_bytes, digest))
    groups = (rows.where(F.col("digest").isNotNull()).groupBy("digest")
              .agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", "keeper"))
    same = F.col("id").eqNullSafe(F.col("keeper"))
    return (rows.join(groups, "digest", "left")
            .select("id", "uri", "payload", F.when(~same & F.col("keeper").isNotNull(), F.col("keeper")).alias("refers_to")))


def write_warc(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html",
               min_bytes: int = MIN_REVISIT_BYTES) -> None:
    """Write one record per row of ``pages`` to gzip files under ``path``."""
    urn = lambda c: F.concat(F.lit("urn:x-page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")))
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit("").cast("binary"))
    base = pages.select(F.col(id_col).alias("id"), F.col(uri_col).alias("uri"), payload.alias("payload"))
    rows = with_revisits(base, min_bytes).select(
        urn("id").alias("record_id"), "uri", "payload",
        F.when(F.col("refers_to").isNotNull(), urn("refers_to")).alias("refers_to"))
    (rows.mapInArrow(releasing(_pack), "members binary").select(F.col("members").cast("string").alias("value"))
     .write.mode("error").option("lineSep", "\u0000").option("maxRecordsPerFile", ROWS_PER_FILE).text(path))


class Members:
    """Bytes of consecutive gzip members, inflated as they are asked for."""

    STEP = 1 << 16

    def __init__(self, data: bytes):
        self.data, self.at = memoryview(data), 0

    def __iter__(self) -> Iterator[bytes]:
        """The content of each member that is not empty."""
        while self.at < len(self.data):
            inflate, parts = zlib.decompressobj(31), []
            while not inflate.eof:
                if self.at >= len(self.data):
                    raise WarcError("the last gzip member is cut off")
                chunk = self.data[self.at:self.at + self.STEP]
                try:
                    parts.append(inflate.decompress(chunk))
                except zlib.error as e:
                    raise WarcError(f"gzip member: {e}") from e
                self.at += len(chunk) - len(inflate.unused_data)
            if content := b"".join(parts):
                yield content


def fields(head: bytes) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in
            (line.partition(":") for line in head.decode("utf-8", "replace").split("\r\n")[1:])}


def parse(data: bytes) -> dict:
    """Take one record apart and verify its framing and digests."""
    cut = data.find(b"\r\n\r\n")
    if not data.startswith(b"WARC/") or cut < 0:
        raise WarcError("no WARC header")
    head = fields(data[:cut])
    if not re.fullmatch(r"\d+", head.get("content-length", "")):
        raise WarcError("no content length")
    length = int(head["content-length"])
    block, tail = data[cut + 4:cut + 4 + length], data[cut + 4 + length:]
    if len(block) != length or tail != b"\r\n\r\n":
        raise WarcError("the block does not have its content length")
    if head.get("warc-block-digest", digest32(block)) != digest32(block):
        raise WarcError("block digest")
    http, _, payload = block.partition(b"\r\n\r\n")
    revisit, said = head.get("warc-type") == "revisit", head.get("warc-payload-digest")
    if not revisit and said not in (None, digest32(payload)):
        raise WarcError("payload digest")
    sha1 = base64.b32decode(said.removeprefix("sha1:")).hex() if said else hashlib.sha1(payload).hexdigest()
    return {"record_id": head.get("warc-record-id", "").strip("<>"), "uri": head.get("warc-target-uri"),
            "record_type": head.get("warc-type"), "refers_to_id": head.get("warc-refers-to", "").strip("<>") or None,
            "payload_bytes": int(fields(http)["content-length"]) if revisit else len(payload), "payload_digest": sha1,
            "payload": None if revisit else payload}


def read_warc(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """The records (``RECORD_SCHEMA``) of all files under ``path``, each file
    read in order; ``payloads=False`` verifies the payloads and leaves them out."""
    schema = pa.schema([("record_id", pa.string()), ("uri", pa.string()), ("record_type", pa.string()),
                        ("refers_to_id", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("payload", pa.binary())])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                held, size = [], 0
                for data in Members(content.as_buffer()):
                    held.append(parse(data) | ({} if payloads else {"payload": None}))
                    size += len(held[-1]["payload"] or b"") + 200
                    if size > ROW_BYTES:
                        yield pa.RecordBatch.from_pylist(held, schema)
                        held, size = [], 0
                yield pa.RecordBatch.from_pylist(held, schema)

    files = spark.read.format("binaryFile").load(path)
    return files.select("content").mapInArrow(releasing(read), RECORD_SCHEMA)


def round_trip(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url", payload_col: str = "html") -> DataFrame:
    """Write ``pages`` as WARC files and describe what the reader finds."""
    spark = pages.sparkSession
    path = scratch_path(spark, "warc")
    write_warc(pages, path, id_col, uri_col, payload_col)
    number = lambda c: F.expr(f"try_cast(substring_index({c}, ':', -1) AS BIGINT)")
    return read_warc(spark, path, payloads=False).select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to_id").alias("refers_to"))
