"""WARC archives as a chunked record table.

A payload is never a single cell on its way through an archive: it is cut into
rows of (record, chunk number), each at most CHUNK bytes. Spark's text writer
puts them out as WARC records, a payload's later chunks as continuation records
(segments), so a file is a plain WARC file on any store that Spark writes to.
The reader parses an archive of bounded size at a time and gives back the chunk
rows, each with the digest of its payload up to there.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import fresh_folder, materialise

CHUNK = 1 << 16
ROWS_PER_FILE = 1024  # of at most CHUNK bytes each
END = "\r\n\r\n"
ZERO_TIME = "1970-01-01T00:00:00Z"
CHUNK_ROWS = (
    "record_id string, row_no long, page_id long, record_type string, url string, chunk_no int, last boolean, whole_bytes long,"
    " refers_to string, payload_digest string, digest_so_far string, chunk binary"
)


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1 of a binary column."""
    digits = F.sha1(payload)
    # 20 bits are five hexadecimal digits and four of base 32.
    quads = [F.lpad(F.conv(F.substring(digits, 5 * k + 1, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*quads), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id: Column, row_no: Column) -> Column:
    """A UUID made of the page's id, which revisits name, or of the row's number where the page has none."""
    own = F.coalesce(F.concat(F.lit("page:"), page_id.cast("string")), F.concat(F.lit("row:"), row_no.cast("string")))
    h = F.md5(own.cast("binary"))
    cuts = ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in cuts]), F.lit(">"))


def records(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Per row of `pages` (page_id, url, html): payload, digest, record_type, refers_to.

    Of pages with equal payloads of `least_bytes` or more, the one with the
    largest page_id is a response and the others revisit it; smaller payloads are
    all responses. Equal means equal SHA-1 and length. A null html is an empty
    payload, a null url an empty one. Pages without a page_id are responses and
    nobody's original; rows that repeat the largest page_id are all responses.
    """
    payload = F.coalesce(F.col("`html`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("`page_id`").cast("long").alias("page_id"), F.regexp_replace(F.coalesce(F.col("`url`"), F.lit("")), r"[\r\n]", " ").alias("url"),
        payload.alias("payload"), base32_sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes"),
    )
    firsts = (
        rows.filter((F.col("bytes") >= least_bytes) & F.col("page_id").isNotNull()).groupBy("digest", "bytes")
        .agg(F.max("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    )
    # Few payloads stand twice. Written first, so that Spark knows how small the list is and payloads
    # needn't be shuffled to meet it; beyond what it broadcasts they are, and a payload that stands very often is split.
    firsts = materialise(firsts, "firsts")
    revisit = F.col("page_id") < F.col("first")
    return rows.join(firsts, ["digest", "bytes"], "left").select(
        "page_id", "url", "payload", "digest", "bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"),
    )


def chunk_records(rows: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """The WARC records of `records`, one text each, without their closing line ends.

    All of a row's chunks carry the number its task gave it, so rows that repeat
    a page_id, and share its record id, stay apart.
    """
    kept = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    size = F.octet_length("_kept").cast("long")
    rows = rows.withColumn("_kept", kept).withColumn("_row", F.monotonically_increasing_id())
    rows = rows.withColumn("_id", record_id(F.col("page_id"), F.col("_row")))
    rows = rows.withColumn("_no", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((size - 1) / chunk)).cast("int"))))
    part = F.substring(F.col("_kept"), F.col("_no") * chunk + 1, F.lit(chunk))
    several, last = size > chunk, (F.col("_no") + 1).cast("long") * chunk >= size
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n"))
    only = lambda condition, text: F.when(condition, text).otherwise(F.lit(""))
    first, revisit = F.col("_no") == 0, F.col("record_type") == "revisit"
    segment = F.concat(F.substring(F.col("_id"), 1, 45), F.lit("/"), F.col("_no").cast("string"), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(first, F.col("record_type")).otherwise("continuation")),
        line("WARC-Record-ID", F.when(first, F.col("_id")).otherwise(segment)),
        line("WARC-Date", F.lit(ZERO_TIME)),
        line("WARC-Target-URI", F.col("url")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        only(F.col("page_id").isNotNull(), line("X-Page-ID", F.coalesce(F.col("page_id"), F.lit(0)))),
        line("X-Row-Number", F.col("_row")),
        line("X-Payload-Length", F.col("bytes")),
        only(revisit, F.concat(
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            line("WARC-Refers-To", record_id(F.col("refers_to"), F.lit(0))),
            line("X-Refers-To-Page-ID", F.coalesce(F.col("refers_to"), F.lit(0))),
        )),
        only(several, line("WARC-Segment-Number", F.col("_no") + 1)),
        only(several & ~first, line("WARC-Segment-Origin-ID", F.col("_id"))),
        only(several & last, line("WARC-Segment-Total-Length", F.col("bytes"))),
        line("Content-Length", F.octet_length(part)),
        F.lit("\r\n"),
    )
    return rows.select(F.concat(head.cast("binary"), part).cast("string").alias("value"))


def write_archives(pages: DataFrame, folder: str | None = None, least_bytes: int = 0, chunk: int = CHUNK) -> str:
    """Write `pages` as WARC files below `folder` (a new shared one if None); the folder's name."""
    folder = folder or fresh_folder(pages.sparkSession, "warc")
    lines = chunk_records(records(pages, least_bytes), chunk)
    lines.write.option("lineSep", END).option("maxRecordsPerFile", ROWS_PER_FILE).text(folder)
    return folder


def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunk rows of the WARC files in `content`. A payload in one chunk has its digest at once."""
    names = [f.split()[0] for f in CHUNK_ROWS.split(",")]
    for batch in batches:
        for content in batch["content"]:
            data, at, out, held = memoryview(content.as_buffer()), 0, {n: [] for n in names}, 0
            while at < len(data):
                # Headers are short; only a slice is searched for their end.
                reach, stop = 1 << 12, -1
                while stop < 0:
                    stop = bytes(data[at:at + reach]).find(b"\r\n\r\n")
                    if stop < 0 and at + reach >= len(data):
                        raise ValueError("a record's headers don't end")
                    reach *= 4
                lines = bytes(data[at:at + stop]).decode("utf-8", "surrogateescape").split("\r\n")
                head = dict(line.split(": ", 1) for line in lines[1:])
                start = at + stop + 4
                size, number = int(head["Content-Length"]), int(head.get("WARC-Segment-Number", 1))
                chunk = data[start:start + size]
                if len(chunk) != size or bytes(data[start + size:start + size + 4]) != b"\r\n\r\n":
                    raise ValueError("a record doesn't end where its length says")
                at = start + size + 4
                kind, whole, page = head["WARC-Type"], int(head["X-Payload-Length"]), head.get("X-Page-ID")
                single = kind == "response" and "WARC-Segment-Number" not in head
                out["record_id"].append(head.get("WARC-Segment-Origin-ID", head["WARC-Record-ID"]))
                out["row_no"].append(int(head["X-Row-Number"]))
                out["page_id"].append(int(page) if page else None)
                out["record_type"].append(kind)
                out["url"].append(head["WARC-Target-URI"].encode("utf-8", "surrogateescape").decode("utf-8", "replace"))
                out["chunk_no"].append(number - 1)
                out["last"].append("WARC-Segment-Number" not in head or "WARC-Segment-Total-Length" in head)
                out["whole_bytes"].append(whole)
                out["refers_to"].append(head.get("X-Refers-To-Page-ID"))
                out["payload_digest"].append(head["WARC-Payload-Digest"].removeprefix("sha1:"))
                out["digest_so_far"].append(base64.b32encode(hashlib.sha1(chunk).digest()).decode() if single else None)
                out["chunk"].append(bytes(chunk))
                held += size
                if held > 4 << 20:
                    yield _rows(out)
                    out, held = {n: [] for n in names}, 0
            if out["chunk"]:
                yield _rows(out)


def _rows(out: dict[str, list]) -> pa.RecordBatch:
    kinds = {"row_no": pa.int64(), "page_id": pa.int64(), "chunk_no": pa.int32(), "last": pa.bool_(), "whole_bytes": pa.int64(), "chunk": pa.binary()}
    return pa.RecordBatch.from_arrays([pa.array(v, kinds.get(n, pa.string())) for n, v in out.items()], list(out))


def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fill digest_so_far of rows sorted by record, row and chunk: one running state, one chunk at a time."""
    key, state = None, hashlib.sha1()
    for batch in batches:
        done = []
        for record, row, no, chunk in zip(*[batch[n].to_pylist() for n in ("record_id", "row_no", "chunk_no")], batch["chunk"]):
            if (record, row) != key:
                key, state = (record, row), hashlib.sha1()
            state.update(chunk.as_buffer())
            done.append(base64.b32encode(state.digest()).decode())
        at = batch.schema.names.index("digest_so_far")
        columns = list(batch.columns)
        columns[at] = pa.array(done, pa.string())
        yield pa.RecordBatch.from_arrays(columns, batch.schema.names)


def read_chunks(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk table of the archives below `folder` (CHUNK_ROWS).

    Payloads of one chunk are digested while parsing. Chunks of longer ones may
    lie in several files: they go to one task per written row, sorted, and are
    digested as they pass, so a payload of any size takes the memory of a chunk.
    An empty folder gives no rows; a truncated record is an error.
    """
    rows = spark.read.format("binaryFile").load(folder).select("content").mapInArrow(parsed, CHUNK_ROWS)
    whole = (F.col("chunk_no") == 0) & F.col("last")
    long = rows.filter(~whole).repartition("record_id", "row_no").sortWithinPartitions("record_id", "row_no", "chunk_no")
    return rows.filter(whole).union(long.mapInArrow(digested, CHUNK_ROWS))


def page_records(chunks: DataFrame) -> DataFrame:
    """Per page of a chunk table: payload_bytes, payload_digest, record_type, refers_to, and whether the digest held.

    Lengths and digests of responses are those of the bytes read; a revisit has
    those its record names, which are its original's.
    """
    # The last chunk has the digest of all; the first knows what kind of record it is.
    ends = chunks.filter("last").withColumn("revisit", F.col("record_type") == "revisit")
    return ends.select(
        "page_id", F.col("whole_bytes").alias("payload_bytes"),
        F.when(F.col("revisit"), F.col("payload_digest")).otherwise(F.col("digest_so_far")).alias("payload_digest"),
        F.when(F.col("revisit"), "revisit").otherwise("response").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
        (F.col("revisit") | (F.col("payload_digest") == F.col("digest_so_far"))).alias("intact"),
    )
