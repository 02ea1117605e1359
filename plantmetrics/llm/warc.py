"""WARC archives from a table of record chunks.

Writing: every payload is cut once, from its start on, into rows (record, chunk number) of at most `chunk_chars` characters. A row
carries the bytes and the SHA-256 digest of the payload up to its own end, so the last row of a record has the whole payload's.
The rows are stored; equal payloads are found by the last rows' digests alone, without reading the blocks again. A payload of one
chunk becomes one record, a longer one a first segment and continuation records, so that no row holds a whole formatted record.
Only chunks of longer payloads are shuffled, to bring a record's segments together in order. Spark's text writer puts the rows
into gzip files on whatever file system the path names; every file holds whole records in order.

Reading: the lines of a file are streamed through a parser that follows Content-Length and holds one line at a time. It gives a
row per chunk with the bytes and the digest of the payload up to there, and compares both with what the record states.

Equal payloads of at least `least_bytes` bytes are stored once: the record with the smallest id is the response, the others are
revisit records that name it. Rows that repeat the smallest id are responses too.

Defined cases: ids are of any type that casts to a string and back (percent-encoded in the archive); a null payload is empty; a
null id is written as such, is never the response that others refer to unless every id of the group is null, in which case all
are responses; a null url has no target line; line ends in a url are percent-encoded; an empty table writes an archive without
records; other columns are never read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from urllib.parse import unquote_plus

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantmetrics.functions.sizing import small_side, stored

CHUNK_CHARS = 1 << 16
LEAST_BYTES = 100
_HELD = 1 << 23
#: Columns of the parser's rows; ids are still text.
CHUNKS = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("chunk_no", T.IntegerType()), T.StructField("last", T.BooleanType()),
    T.StructField("record_type", T.StringType()), T.StructField("refers_to", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("payload_bytes", T.LongType()), T.StructField("payload_digest", T.StringType()), T.StructField("data", T.BinaryType()),
])


def _chunk_end(text: np.ndarray, begin: int, chars: int) -> int:
    """The place behind the `chars` code points of UTF-8 `text` that start at `begin`; only these bytes are looked at."""
    end = begin
    while chars and end < len(text):
        window = text[end:end + chars]
        end += len(window)
        chars -= np.count_nonzero((window & 0xC0) != 0x80)
    while end < len(text) and text[end] & 0xC0 == 0x80:
        end += 1
    return end


def _pieces(payload: pa.Buffer, chunk_chars: int) -> Iterator[tuple[int, bool, int, str, bytes]]:
    """(chunk number, last, bytes so far, digest so far, block) of one payload; an empty one has one empty chunk."""
    text = np.frombuffer(payload, np.uint8)
    digest, begin, number, last = hashlib.sha256(), 0, 0, False
    while not last:
        end = _chunk_end(text, begin, chunk_chars)
        number, last, block = number + 1, end == len(text), text[begin:end].tobytes()
        digest.update(block)
        yield number, last, end, digest.hexdigest(), block
        begin = end


def chunk_table(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", chunk_chars: int = CHUNK_CHARS) -> DataFrame:
    """The stored chunks: row (names the input row), key, url, chunk_no, last, cut (of several chunks), bytes and digest so far, block."""
    rows = pages.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload), F.lit("")).alias("payload"),
    )
    own = T.StructType([f for f in rows.schema if f.name != "payload"])
    schema = T.StructType([
        *own, T.StructField("chunk_no", T.IntegerType()), T.StructField("last", T.BooleanType()), T.StructField("cut", T.BooleanType()),
        T.StructField("bytes", T.LongType()), T.StructField("digest", T.StringType()), T.StructField("block", T.StringType()),
    ])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(batch: pa.RecordBatch, at: list[int], made: list[tuple]) -> pa.RecordBatch:
            number, last, several, size, digest, block = zip(*made, strict=True)
            columns = [batch.column(n).take(pa.array(at)) for n in own.names]
            columns += [pa.array(number, pa.int32()), pa.array(last), pa.array(several), pa.array(size, pa.int64()), pa.array(digest)]
            return pa.RecordBatch.from_arrays([*columns, pa.array(block, pa.binary()).view(pa.string())], schema.names)

        for batch in batches:
            at, made, held = [], [], 0
            for k, value in enumerate(batch.column("payload").cast(pa.binary())):
                for number, last, size, digest, block in _pieces(value.as_buffer(), chunk_chars):
                    at.append(k)
                    made.append((number, last, number > 1 or not last, size, digest, block))
                    held += len(block)
                    if held > _HELD:
                        yield batch_of(batch, at, made)
                        at, made, held = [], [], 0
            if made:
                yield batch_of(batch, at, made)

    return stored(rows.mapInArrow(cut, schema), "warc-chunks")


def revisits(chunks: DataFrame, least_bytes: int = LEAST_BYTES) -> DataFrame:
    """(row, refers_to, whole_digest, whole_bytes) of the records that repeat the payload of a smaller key, from last chunks alone."""
    ends = chunks.filter(F.col("last") & (F.col("bytes") >= least_bytes)).select("row", "key", "digest", "bytes")
    first = ends.groupBy("digest").agg(F.min("key").alias("refers_to"), F.count("*").alias("n")).filter("n > 1 AND refers_to IS NOT NULL")
    again = ends.join(first, "digest").filter(~F.col("key").eqNullSafe(F.col("refers_to")))
    return again.select("row", "refers_to", F.col("digest").alias("whole_digest"), F.col("bytes").alias("whole_bytes"))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _urn(key: Column, chunk: Column | None = None) -> Column:
    page = F.coalesce(F.concat(F.lit("<urn:page:"), F.url_encode(key.cast("string"))), F.lit("<urn:unnamed"))
    return F.concat(page, F.lit(">")) if chunk is None else F.concat(page, F.lit(":chunk:"), chunk.cast("string"), F.lit(">"))


def record_chunks(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html",
    chunk_chars: int = CHUNK_CHARS, least_bytes: int = LEAST_BYTES,
) -> DataFrame:
    """Rows (record_id, chunk_no, value): the text of one WARC record each, segments of a page next to each other and in order."""
    chunks = chunk_table(pages, key, url, payload, chunk_chars)
    again = small_side(revisits(chunks, least_bytes))
    whole = chunks.filter(~F.col("cut")).join(again, "row", "left")
    long = chunks.filter("cut").join(again, "row", "left").filter("refers_to IS NULL OR chunk_no = 1")
    rows = whole.unionByName(long.repartition("row").sortWithinPartitions("row", "chunk_no"))
    repeats = F.col("refers_to").isNotNull()
    segment = F.col("cut") & ~repeats
    later = F.col("chunk_no") > 1
    block = F.when(repeats, F.lit("")).otherwise(F.col("block"))
    kind = F.when(later, "continuation").when(repeats, "revisit").otherwise("response")
    target = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    through = F.coalesce("whole_bytes", "bytes").cast("string")
    head = F.concat(
        F.lit("WARC/1.1\r\n"), _line("WARC-Type", kind),
        _line("WARC-Record-ID", F.when(later, _urn(F.col("key"), F.col("chunk_no"))).otherwise(_urn(F.col("key")))),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        F.coalesce(_line("WARC-Target-URI", target), F.lit("")),
        # Of a segment that is not the last one, digest and length are those of the payload up to its end.
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.coalesce("whole_digest", "digest"))),
        _line("X-Payload-Length", through),
        F.coalesce(_line("WARC-Refers-To", F.when(repeats, _urn(F.col("refers_to")))), F.lit("")),
        F.when(segment, _line("WARC-Segment-Number", F.col("chunk_no").cast("string"))).otherwise(F.lit("")),
        F.when(later, _line("WARC-Segment-Origin-ID", _urn(F.col("key")))).otherwise(F.lit("")),
        F.when(segment & F.col("last"), _line("WARC-Segment-Total-Length", through)).otherwise(F.lit("")),
        _line("Content-Length", F.octet_length(block).cast("string")), F.lit("\r\n"),
    )
    return rows.select(F.col("key").alias("record_id"), "chunk_no", F.concat(head, block, F.lit("\r\n")).alias("value"))


def write_archives(chunks: DataFrame, path: str) -> None:
    """Gzip files below `path`, one per partition; the writer's line end is the second one behind a record."""
    chunks.select("value").write.option("lineSep", "\r\n").option("compression", "gzip").text(path)


def _page(urn: str | None) -> str | None:
    """The id that a record's name holds, as text."""
    if urn is None or urn.startswith("<urn:unnamed"):
        return None
    return unquote_plus(urn.removeprefix("<urn:page:").removesuffix(">").split(":")[0])


class _Parser:
    """Chunk rows of one file from its lines, in order."""

    def __init__(self, with_data: bool):
        self.with_data, self.fields, self.left, self.gap = with_data, {}, -1, False
        self.digest, self.seen, self.held = hashlib.sha256(), 0, []

    def line(self, line: bytes) -> tuple | None:
        if self.gap:
            self.gap = False
            if line != b"\r":
                raise ValueError(f"no record end before {line[:60]!r}")
            return None
        if self.left >= 0:
            return self._block(line + b"\n")
        line = line.removesuffix(b"\r")
        if line:
            name, _, value = line.partition(b": ")
            self.fields[name.decode()] = value.decode()
        else:
            self.left = int(self.fields["Content-Length"])
            if self.fields["WARC-Type"] != "continuation":
                self.digest, self.seen = hashlib.sha256(), 0
        return None

    def _block(self, piece: bytes) -> tuple | None:
        part = piece[:self.left]
        self.digest.update(part)
        self.seen += len(part)
        if self.with_data:
            self.held.append(part)
        if len(piece) <= self.left:
            self.left -= len(piece)
            return None
        if piece[self.left:] != b"\r\n":
            raise ValueError("a record is longer than its Content-Length")
        return self._end()

    def _end(self) -> tuple:
        fields, data = self.fields, b"".join(self.held) if self.with_data else None
        self.fields, self.left, self.gap, self.held = {}, -1, True, []
        whole, stated = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:")
        origin = fields.get("WARC-Segment-Origin-ID", fields["WARC-Record-ID"])
        revisit = fields["WARC-Type"] == "revisit"
        kind = "revisit" if revisit else "response"
        last = revisit or "WARC-Segment-Number" not in fields or "WARC-Segment-Total-Length" in fields
        size, digest = (whole, stated) if revisit else (self.seen, self.digest.hexdigest())
        if (size, digest) != (whole, stated):
            raise ValueError(f"{origin}: payload and stated digest differ")
        return (
            _page(origin), int(fields.get("WARC-Segment-Number", 1)), last, kind, _page(fields.get("WARC-Refers-To")),
            fields.get("WARC-Target-URI"), size, digest, data,
        )


def read_chunks(spark: SparkSession, path: str, with_data: bool = True, key_type: str = "bigint") -> DataFrame:
    """A row per chunk: record_id and refers_to (as `key_type`), chunk_no, last, record_type, url, bytes and digest so far, data."""
    lines = spark.read.option("lineSep", "\n").text(path).select("value", F.col("_metadata.file_path").alias("file"))
    schema = pa.schema([
        ("record_id", pa.string()), ("chunk_no", pa.int32()), ("last", pa.bool_()), ("record_type", pa.string()),
        ("refers_to", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("data", pa.binary()),
    ])

    def parsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, parser = None, _Parser(with_data)
        for batch in batches:
            rows: list[tuple] = []
            held = 0
            for value, at in zip(batch.column(0).cast(pa.binary()), batch.column(1), strict=True):
                if at.as_py() != file:
                    file, parser = at.as_py(), _Parser(with_data)
                row = parser.line(value.as_py())
                if row is not None:
                    rows.append(row)
                    held += len(row[-1] or b"")
                if held > _HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    rows = lines.mapInArrow(parsed, CHUNKS)
    return rows.withColumns({c: F.col(c).cast(key_type) for c in ("record_id", "refers_to")})


def round_trip(pages: DataFrame, path: str, key: str = "page_id", **options) -> DataFrame:
    """Archives written to `path` and read back: a row per record."""
    write_archives(record_chunks(pages, key, **options), path)
    key_type = pages.schema[key].dataType.simpleString()
    chunks = read_chunks(pages.sparkSession, path, with_data=False, key_type=key_type)
    return chunks.filter("last").drop("chunk_no", "last", "data")
