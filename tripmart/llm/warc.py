"""WARC archives through a chunked record table.

A page becomes one or more rows (row id, chunk number, data of at most `chunk_bytes` bytes), and every row
is written as one WARC record: the first chunk as `response`, later ones as `continuation` with the standard's segment
fields, so no record is longer than a chunk. A chunk also ends inside any occurrence of the record marker in a
payload; the marker then stands only at the head of a record, and the text reader can cut archives at it and stream them.

Oversized payloads are cut in one forward pass: their bytes are read where they lie in the Arrow batch, and chunks are handed on in
batches of `batch_bytes`, so beyond the page's own row no task allocates a second whole payload. Digests are carried incrementally:
the pass that cuts a payload feeds its chunks to a running digest, and so does the reader, for which chunks are
sorted by (row id, chunk); a payload of one chunk is hashed where it is read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm.tables import new_folder, stored

# Fixed by the WARC 1.1 standard: version line and the profile of identical payloads.
MARKER = "WARC/1.1\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE, GAP = "\r\n", "\r\n\r\n"
# The version line without its end, and its part after which a marker inside a payload is cut.
VERSION, HALF = b"WARC/1.1", b"WARC/"
_MARKED = re.compile(re.escape(MARKER.encode()))


@dataclass(frozen=True)
class WarcFormat:
    chunk_bytes: int = 64 * 1024
    min_revisit_bytes: int = 100
    compression: str = "gzip"
    date: str = "2026-01-01T00:00:00Z"
    batch_bytes: int = 4 * 1024 * 1024


def described(pages: DataFrame, params: WarcFormat) -> DataFrame:
    """(page_id, url, html, digest, bytes, refers_to): refers_to is the smallest page with an equal payload, if smaller.

    Payloads under `min_revisit_bytes` never refer. Only digests that occur twice or more are joined back.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    base = pages.select(
        F.col("page_id").cast("long"),
        F.col("url").cast("string"),
        html.alias("html"),
        F.sha2(html.cast("binary"), 256).alias("digest"),
        F.octet_length(html).cast("long").alias("bytes"),
    )
    large = base.where(F.col("bytes") >= params.min_revisit_bytes)
    groups = large.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("copies"))
    groups = stored(groups.where("copies > 1 and first is not null").select("digest", "first"), "copies")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return base.join(groups, "digest", "left").select("page_id", "url", "html", "digest", "bytes", refers.alias("refers_to"))


def cuts(data: memoryview, size: int) -> Iterator[tuple[int, int]]:
    """The (start, end) of each chunk of UTF-8 bytes, from front to back.

    A chunk has at most `size` bytes, or one character if that is longer. It ends at a border of characters and holds no record marker,
    nor would it together with the line end that follows a record.
    """
    start, stop = 0, len(data)
    while True:
        end = min(start + size, stop)
        while end < stop and end > start and data[end] & 0xC0 == 0x80:
            end -= 1
        if end == start < stop:
            end += 1
            while end < stop and data[end] & 0xC0 == 0x80:
                end += 1
        inside = _MARKED.search(data, start, end)
        if inside:
            end = inside.start() + len(HALF)
        elif bytes(data[max(start, end - len(VERSION)) : end]) == VERSION:
            end -= len(VERSION) - len(HALF)
        yield start, end
        start = end
        if start >= stop:
            return


def cut_rows(params: WarcFormat):
    """Arrow batches of (page_id, url, digest, bytes, row_id, html) to the chunk table's rows, checking each digest as it runs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            html = batch.column(5)
            for k in range(batch.num_rows):
                data, whole = memoryview(html[k].as_buffer()), hashlib.sha256()
                held: list[tuple[int, bool, bytes]] = []
                filled = 0
                for chunk, (start, end) in enumerate(cuts(data, params.chunk_bytes)):
                    whole.update(data[start:end])
                    held.append((chunk, end == len(data), bytes(data[start:end])))
                    filled += end - start
                    if filled >= params.batch_bytes:
                        yield chunk_batch(batch, k, held)
                        held, filled = [], 0
                if whole.hexdigest() != batch.column(2)[k].as_py():
                    raise ValueError(f"page {batch.column(0)[k].as_py()} changed while it was cut")
                if held:
                    yield chunk_batch(batch, k, held)

    return rows


def chunk_batch(batch: pa.RecordBatch, k: int, held: list[tuple[int, bool, bytes]]) -> pa.RecordBatch:
    """Some chunks of one page beside the page's own columns."""
    page = [pa.array([batch.column(at)[k].as_py()] * len(held), kind) for at, kind in enumerate((pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()))]
    chunk, last, data = zip(*held)
    own = [pa.array(chunk, pa.int32()), pa.array(last, pa.bool_()), pa.array(data, pa.binary()).cast(pa.string())]
    return pa.RecordBatch.from_arrays([*page, *own], ["page_id", "url", "digest", "bytes", "row_id", "chunk", "last", "data"])


def chunk_table(rows: DataFrame, params: WarcFormat) -> DataFrame:
    """One row for each chunk: row_id, chunk, whether it is the last, and data in place of html; a revisit has one empty chunk."""
    html = F.col("html")
    whole = (F.octet_length(html) <= params.chunk_bytes) & ~F.contains(html, F.lit(MARKER)) & ~F.endswith(html, F.lit(VERSION.decode()))
    page = ["page_id", "url", "digest", "bytes", F.expr("uuid()").alias("row_id")]
    revisit = F.col("refers_to").isNotNull()
    one = rows.where(whole | revisit).select(
        *page, F.lit(0).alias("chunk"), F.lit(True).alias("last"), F.when(revisit, F.lit("")).otherwise(html).alias("data"), "refers_to"
    )
    oversized = rows.where(~whole & ~revisit).select(*page, "html")
    kinds = "page_id long, url string, digest string, bytes long, row_id string, chunk int, last boolean, data string"
    return one.unionByName(oversized.mapInArrow(cut_rows(params), kinds).withColumn("refers_to", F.lit(None).cast("long")))


def archive_records(chunks: DataFrame, params: WarcFormat) -> Column:
    """The text of one WARC record for each row of the chunk table, without the two line ends that close it."""
    page = F.coalesce(F.col("page_id").cast("string"), F.lit("unknown"))
    first, split = F.col("chunk") == 0, (F.col("chunk") > 0) | ~F.col("last")
    identity = F.concat(F.lit("<urn:page:"), page, F.lit(">"))
    kind = F.when(F.col("refers_to").isNotNull(), "revisit").when(first, "response").otherwise("continuation")

    def field(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value)

    fields = [
        field("WARC-Type", kind),
        field("WARC-Record-ID", F.when(first, identity).otherwise(F.concat(F.lit("<urn:page:"), page, F.lit(":segment:"), F.col("chunk") + 1, F.lit(">")))),
        field("WARC-Date", F.lit(params.date)),
        # An address that ends like the version line would make a marker with the line end.
        field("WARC-Target-URI", F.regexp_replace(F.regexp_replace("url", "[\\x00-\\x20]+", "%20"), "WARC/1\\.1$", "WARC/1%2E1")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        field("WARC-Block-Digest", F.concat(F.lit("sha256:"), F.sha2(F.col("data").cast("binary"), 256))),
        F.when(F.col("refers_to").isNotNull(), field("WARC-Profile", F.lit(PROFILE))),
        F.when(F.col("refers_to").isNotNull(), field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("refers_to"), F.lit(">")))),
        F.when(split, field("WARC-Segment-Number", (F.col("chunk") + 1).cast("string"))),
        F.when(split & ~first, field("WARC-Segment-Origin-ID", identity)),
        F.when(split & F.col("last"), field("WARC-Segment-Total-Length", F.col("bytes").cast("string"))),
        field("X-Payload-Length", F.col("bytes").cast("string")),
        field("X-Row-ID", F.col("row_id")),
        field("Content-Type", F.lit("text/html; charset=utf-8")),
        field("Content-Length", F.octet_length("data").cast("string")),
    ]
    return F.concat(F.lit(MARKER), F.concat_ws(LINE, *fields), F.lit(GAP), F.col("data"))


def write_archives(pages: DataFrame, folder: str, params: WarcFormat = WarcFormat()) -> None:
    """Write a WARC file for each task to the folder."""
    chunks = chunk_table(described(pages, params), params)
    records = chunks.select(archive_records(chunks, params).alias("value"))
    records.write.option("lineSep", GAP).option("compression", params.compression).text(folder)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The chunk table of the archives; a record whose length or digest is not what its fields say is an error."""
    records = spark.read.option("lineSep", MARKER).text(folder).where("value != ''")
    head = F.substring_index("value", GAP, 1)
    body = F.substr("value", F.length(head) + len(GAP) + 1, F.length("value") - F.length(head) - 2 * len(GAP))
    rows = records.select(F.str_to_map(head, F.lit(LINE), F.lit(": ")).alias("field"), body.alias("data"))
    value = lambda name: F.col("field")[name]
    sound = (F.octet_length("data") == value("Content-Length").cast("int")) & (
        F.concat(F.lit("sha256:"), F.sha2(F.col("data").cast("binary"), 256)) == value("WARC-Block-Digest")
    )
    return rows.select(
        F.regexp_extract(F.coalesce(value("WARC-Segment-Origin-ID"), value("WARC-Record-ID")), "urn:page:(-?\\d+)>", 1).try_cast("long").alias("page_id"),
        value("WARC-Type").alias("kind"),
        value("X-Row-ID").alias("row_id"),
        value("WARC-Segment-Number").cast("int").alias("segment"),
        value("WARC-Segment-Total-Length").cast("long").alias("total"),
        F.substring_index(value("WARC-Payload-Digest"), ":", -1).alias("digest"),
        value("X-Payload-Length").cast("long").alias("bytes"),
        F.regexp_extract(value("WARC-Refers-To"), "urn:page:(-?\\d+)>", 1).try_cast("long").alias("refers_to"),
        F.when(sound, F.col("data")).otherwise(F.raise_error(F.concat(F.lit("damaged record "), value("WARC-Record-ID")))).alias("data"),
    )


def running_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks sorted by (row_id, segment) to (row_id, page_id, own_bytes, own_digest); one digest state at a time."""
    row = page = digest = None
    size, expected = 0, 1

    def done(found: list) -> None:
        if row is not None:
            found.append((row, page, size, digest.hexdigest()))

    def batch_of(found: list) -> pa.RecordBatch:
        columns = zip(*found) if found else ([], [], [], [])
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds)], ["row_id", "page_id", "own_bytes", "own_digest"])

    for batch in batches:
        found: list = []
        for k in range(batch.num_rows):
            own, segment = batch.column(0)[k].as_py(), batch.column(2)[k].as_py()
            if own != row:
                done(found)
                row, page, digest, size, expected = own, batch.column(1)[k].as_py(), hashlib.sha256(), 0, 1
            if segment != expected:
                raise ValueError(f"segment {expected} of page {page} is missing")
            data = batch.column(3)[k].as_buffer()
            digest.update(data)
            size, expected = size + data.size, expected + 1
        yield batch_of(found)
    found = []
    done(found)
    yield batch_of(found)


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every page in the archives.

    Payloads of all responses are hashed anew and compared with what their records say.
    """
    records = read_records(spark, folder)
    parts = records.where("segment is not null").select("row_id", "page_id", "segment", F.col("data").cast("binary").alias("data"), "bytes", "digest")
    said = parts.where("segment = 1").select("row_id", "bytes", "digest")
    ordered = parts.select("row_id", "page_id", "segment", "data").repartition("row_id").sortWithinPartitions("row_id", "segment")
    found = ordered.mapInArrow(running_digests, "row_id string, page_id long, own_bytes long, own_digest string")
    long = stored(found.join(said, "row_id").drop("row_id"), "long_payloads")
    own = records.where("segment is null and kind = 'response'")
    own = own.select("page_id", F.octet_length("data").cast("long").alias("own_bytes"), F.sha2(F.col("data").cast("binary"), 256).alias("own_digest"), "bytes", "digest")
    same = (F.col("own_bytes") == F.col("bytes")) & (F.col("own_digest") == F.col("digest"))
    checked = F.when(same, F.col("own_digest")).otherwise(F.raise_error(F.concat(F.lit("wrong payload of page "), F.col("page_id"))))
    responses = own.unionByName(long).select(
        "page_id", F.col("own_bytes").alias("payload_bytes"), checked.alias("payload_digest"), F.lit("response").alias("record_type"), F.lit(None).cast("long").alias("refers_to")
    )
    revisits = records.where("kind = 'revisit'").select(
        "page_id", F.col("bytes").alias("payload_bytes"), F.col("digest").alias("payload_digest"), F.lit("revisit").alias("record_type"), "refers_to"
    )
    return responses.unionByName(revisits)


def round_trip(pages: DataFrame, params: WarcFormat = WarcFormat(), folder: str | None = None) -> DataFrame:
    """Write the pages to archives in the shared folder, read these back and return what `read_payloads` gives.

    Null html is an empty payload, a null url leaves its field out, and a page without id keeps a null id: it refers to a page
    with an equal payload but is never referred to. Rows that repeat an id and payload are all responses. Other columns are
    ignored; an empty table gives no rows.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder, params)
    return read_payloads(pages.sparkSession, folder)
