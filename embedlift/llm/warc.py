"""WARC archives: write pages as segmented, chunked records; read, reassemble and decode them.

Blocks are framed and cut once per page, records are built with column functions and written by Spark's text writer, whose
line separator is the end of a record, so archives can go to any file system that
Spark writes. A record above ``SEGMENT_CHARS`` is cut into a first record and
continuation records, which name the first one, their number and, in the last, the
total length. Reading parses each archive file where Spark reads it; only segments of
cut records are shuffled, grouped by their origin, ordered by number and checked
against the total length, before the chunked transfer framing is taken off.

Defined cases: a null or empty body is an empty payload; a null url becomes
``urn:page:<id>``; line ends in urls are percent-encoded. Rows with the same
page_id and payload are all responses if their id is the smallest. A null page_id
is written without the field and read back as null; it can be a response only where
its group has no other id. A record whose segments are missing or disagree with the
total length comes out with ``problem`` set and a null payload.
"""

from __future__ import annotations

import gzip
import io
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

SEGMENT_CHARS = 32768
CHUNK_CHARS = 8192
RECORDS_PER_FILE = 2000
#: Payloads below this are never replaced by a revisit.
REVISIT_BYTES = 100
_EOL = "\r\n"
_PART = "number int, total long, block binary"
_RECORD = f"record_id string, origin_id string, record_type string, page_id long, refers_to long, payload_bytes long, payload_digest string, {_PART}"


_HEAD = _EOL.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8", "Transfer-Encoding: chunked", "", ""])


def segments(body: str | None) -> list[str]:
    """The block of a page, chunked and cut into segments; None for a revisit, which has no body."""
    if body is None:
        return [_HEAD]
    pieces = [_HEAD]
    for at in range(0, len(body), CHUNK_CHARS):
        chunk = body[at:at + CHUNK_CHARS]
        pieces += [f"{len(chunk.encode('utf-8', 'surrogatepass')):x}", _EOL, chunk, _EOL]
    block = "".join([*pieces, "0", _EOL, _EOL])
    return [block[at:at + SEGMENT_CHARS] for at in range(0, len(block), SEGMENT_CHARS)]


@F.arrow_udf(ArrayType(StringType()))
def _segments(bodies: pa.Array, refers: pa.Array) -> pa.Array:
    return pa.array((segments(b.as_py() if r.as_py() is None else None) for b, r in zip(bodies, refers)), pa.list_(pa.string()), size=len(bodies))


_segments = _segments.asNondeterministic()   # cut once per page, whatever is asked of the parts


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url", html: str = "html") -> None:
    """Write one record per page; equal payloads become revisits of the one with the smallest id."""
    body = F.coalesce(F.col(f"`{html}`"), F.lit(""))
    base = pages.select(F.col(f"`{page_id}`").cast("long").alias("page_id"), F.col(f"`{url}`").alias("url"), body.alias("body"),
                        F.sha2(F.encode(body, "utf-8"), 256).alias("digest"), F.octet_length(body).alias("bytes"))
    shared = (base.where(F.col("bytes") >= REVISIT_BYTES).groupBy("digest")
              .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n"))
    rows = (base.join(shared, "digest", "left")
            .withColumn("refers", F.expr("case when first is not null and not (page_id <=> first) then first end"))
            .withColumn("record_id", F.concat(F.lit("<urn:uuid:"), F.uuid(), F.lit(">"))))
    rows = (rows.withColumn("parts", _segments("body", "refers")).drop("body")
            .withColumn("total", F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + F.octet_length(p)))
            .withColumn("n_parts", F.size("parts")).select("*", F.posexplode("parts").alias("at", "part")).drop("parts"))

    def field(name: str, value) -> F.Column:
        return F.concat(F.lit(f"{name}: "), value.cast("string"))

    first, cut = F.col("at") == 0, F.col("n_parts") > 1
    kind = F.when(~first, "continuation").when(F.col("refers").isNotNull(), "revisit").otherwise("response")
    target = F.regexp_replace(F.regexp_replace(F.coalesce("url", F.concat(F.lit("urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("unknown")))),
                                               "\r", "%0D"), "\n", "%0A")
    origin = F.col("record_id")
    own = F.when(first, origin).otherwise(F.concat(F.expr("substring(record_id, 1, length(record_id) - 1)"), F.lit(":"), F.col("at").cast("string"), F.lit(">")))
    header = F.concat_ws(_EOL, F.lit("WARC/1.1"), field("WARC-Type", kind), field("WARC-Record-ID", own), field("WARC-Target-URI", target),
                         field("WARC-Date", F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
                         F.when(first, field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest")))),
                         F.when(first, field("X-Page-Id", F.col("page_id"))),
                         F.when(first, field("X-Payload-Length", F.col("bytes"))),
                         F.when(first, field("X-Refers-To-Page", F.col("refers"))),
                         F.when(first & F.col("refers").isNotNull(), field("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))),
                         F.when(cut, field("WARC-Segment-Number", F.col("at") + 1)),
                         F.when(~first, field("WARC-Segment-Origin-ID", origin)),
                         F.when(cut & (F.col("at") + 1 == F.col("n_parts")), field("WARC-Segment-Total-Length", F.col("total"))),
                         F.when(first, F.lit("Content-Type: application/http; msgtype=response")),
                         field("Content-Length", F.octet_length("part")))
    (rows.select(F.concat(header, F.lit(_EOL + _EOL), F.col("part")).alias("value")).write.option("lineSep", _EOL + _EOL)
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


def records_in(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields (names in lower case) and block of each record of one archive; gzip in one or many members, or plain."""
    source = gzip.GzipFile(fileobj=io.BytesIO(data)) if data[:2] == b"\x1f\x8b" else io.BytesIO(data)
    while line := source.readline():
        if line == b"\r\n":
            continue
        if not re.fullmatch(rb"WARC/1\.[01]\r\n", line):
            raise ValueError(f"no record header: {line[:80]!r}")
        fields = {}
        while (line := source.readline()) not in (b"\r\n", b""):
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        n = int(fields.get("content-length", -1))
        block = source.read(max(n, 0))
        if n < 0 or len(block) < n:
            raise ValueError("record is cut off or has no length")
        yield fields, block


_BATCH_BYTES = 4 << 20


def _rows(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = lambda v: int(v) if v is not None else None
    rows, size = [], 0
    for batch in batches:
        for data in batch.column(0):
            for f, block in records_in(data.as_py()):
                rows.append({"record_id": f["warc-record-id"], "origin_id": f.get("warc-segment-origin-id", f["warc-record-id"]), "record_type": f["warc-type"],
                             "page_id": number(f.get("x-page-id")), "refers_to": number(f.get("x-refers-to-page")), "payload_bytes": number(f.get("x-payload-length")),
                             "payload_digest": f.get("warc-payload-digest", "").rpartition(":")[2] or None,
                             "number": number(f.get("warc-segment-number")), "total": number(f.get("warc-segment-total-length")), "block": block})
                size += len(block)
                if size >= _BATCH_BYTES or len(rows) >= 1000:
                    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)
                    rows, size = [], 0
    yield pa.RecordBatch.from_pylist(rows, _SCHEMA)


_SCHEMA = pa.schema([("record_id", pa.string()), ("origin_id", pa.string()), ("record_type", pa.string()), ("page_id", pa.int64()), ("refers_to", pa.int64()),
                     ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("number", pa.int32()), ("total", pa.int64()), ("block", pa.binary())])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """Every record as it stands in the archives below ``path``."""
    return spark.read.format("binaryFile").load(path).select("content").mapInArrow(_rows, _RECORD)


@F.arrow_udf(BinaryType())
def _joined(parts: pa.Array) -> pa.Array:
    return pa.array((b"".join(p.as_py()) for p in parts), pa.binary(), size=len(parts))


def reassembled(records: DataFrame) -> DataFrame:
    """One row per logical record: segments joined in order, ``problem`` where they don't add up.

    A group holds the segments of one record, so its size is that of one page.
    """
    whole = records.where("number is null").withColumn("problem", F.lit(None).cast("string"))
    cut = records.where("number is not null").groupBy("origin_id").agg(
        *[F.max(F.when(F.col("number") == 1, F.col(c))).alias(c) for c in ("record_id", "record_type", "page_id", "refers_to", "payload_bytes", "payload_digest")],
        F.max("total").alias("total"), F.sort_array(F.collect_list(F.struct("number", "block"))).alias("parts"))
    joined = (cut.withColumn("problem", F.expr(
        "case when total is null or size(parts) != parts[size(parts) - 1].number or parts[0].number != 1 then 'segments are missing' "
        "when aggregate(parts, 0L, (n, p) -> n + octet_length(p.block)) != total then 'total length differs' end"))
        .withColumn("block", _joined("parts.block")))
    columns = ["record_id", "record_type", "page_id", "refers_to", "payload_bytes", "payload_digest", "block", "problem"]
    return whole.select(*columns).unionByName(joined.select(*columns))


def unchunked(body: bytes) -> bytes:
    """A body without its chunked transfer framing."""
    at, parts = 0, []
    while True:
        end = body.index(b"\r\n", at)
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(parts)
        parts.append(body[end + 2:end + 2 + n])
        if len(parts[-1]) != n or body[end + 2 + n:end + 4 + n] != b"\r\n":
            raise ValueError("chunk is cut off")
        at = end + 4 + n


def http_payload(block: bytes | None) -> bytes | None:
    """The body of an HTTP response; null where it can't be decoded."""
    if block is None:
        return None
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    if re.search(rb"(?im)^transfer-encoding:\s*chunked\s*$", head.replace(b"\r", b"")):
        try:
            return unchunked(body)
        except ValueError:
            return None
    return body


@F.arrow_udf(BinaryType())
def _payload(blocks: pa.Array) -> pa.Array:
    return pa.array([http_payload(b) for b in blocks.to_pylist()], pa.binary())


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Pages of the archives: page_id, record_type, refers_to, payload (null for revisits), payload_bytes, payload_digest, problem.

    Length and digest of a response are computed from what was decoded and compared with its fields; a revisit has those
    of the payload it stands for in its fields. ``dangling`` finds revisits without their response.
    """
    pages = reassembled(read_records(spark, path)).where("record_type in ('response', 'revisit')")
    response = F.col("record_type") == "response"
    pages = (pages.withColumn("payload", _payload(F.when(response & F.col("problem").isNull(), F.col("block")))).drop("block")
             .withColumn("own", F.when(response, F.sha2("payload", 256))).withColumn("size", F.when(response, F.octet_length("payload").cast("long"))))
    problem = F.coalesce("problem", F.when(response & F.col("payload").isNull(), "framing is broken")
                         .when(response & ((F.col("own") != F.col("payload_digest")) | (F.col("size") != F.col("payload_bytes"))), "digest or length differs")
                         .when(F.col("payload_bytes").isNull() & ~response, "length is missing"))
    return pages.select("page_id", "record_type", "refers_to", "payload", F.coalesce("size", "payload_bytes").alias("payload_bytes"),
                        F.coalesce("own", "payload_digest").alias("payload_digest"), problem.alias("problem"))


def dangling(pages: DataFrame) -> DataFrame:
    """Revisits whose payload no response has."""
    whole = pages.where("record_type = 'response' and problem is null").select("payload_digest").distinct()
    return pages.where("record_type = 'revisit'").join(whole, "payload_digest", "left_anti")
