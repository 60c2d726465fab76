"""WARC archives: writing with revisit records, and reading by verifying the chain of boundaries.

Archives are read in splits like any text file. Each task cuts its split at lines that look like the
start of a record and emits them as candidates with the offset of their successor, which follows
from the header's Content-Length. A look-alike inside a payload is told from a record by pointer
jumping: starting from offset 0 of every file, jumps of 1, 2, 4, ... records mark what the chain
reaches, and only that is kept. A record that runs across splits, or holds look-alikes, is put
together from the pieces of the splits it covers. Tasks hold one record at a time.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stayvalue.llm.shared import store, utf8
from stayvalue.sources.writers import scratch_path

#: Payloads shorter than this are always stored.
MIN_REVISIT_BYTES = 100
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MAGIC = b"WARC/1."
END = b"\r\n\r\n"
#: Bytes of a file's stretches in which loose records look for their segments.
CELL = 1 << 24
#: Bytes that a task gathers before it hands on a batch.
BATCH_BYTES = 4 << 20

_LENGTH = re.compile(rb"(?i)\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*\r\n")
_LENGTH_SQL = r"(?i)\r\ncontent-length:[ \t]*([0-9]{1,18})[ \t]*\r\n"

SEGMENT_SCHEMA = (
    "file long, start long, pos long, length long, magic boolean, header binary, "
    "complete boolean, exact boolean, head binary, payload binary, raw binary"
)
_SEGMENT = pa.schema(
    [
        ("file", pa.int64()),
        ("start", pa.int64()),
        ("pos", pa.int64()),
        ("length", pa.int64()),
        ("magic", pa.bool_()),
        ("header", pa.binary()),
        ("complete", pa.bool_()),
        ("exact", pa.bool_()),
        ("head", pa.binary()),
        ("payload", pa.binary()),
        ("raw", pa.binary()),
    ]
)


def repeated_payloads(pages: DataFrame) -> DataFrame:
    """(digest, first_id) of payloads that occur more than once and are long enough to revisit."""
    sums = store(
        pages.select(
            "page_id", F.sha2(utf8("html"), 256).alias("digest"), F.octet_length("html").alias("n")
        ).filter(F.col("n") >= MIN_REVISIT_BYTES),
        "warc-sums",
    )
    return store(
        sums.groupBy("digest")
        .agg(F.min("page_id").alias("first_id"), F.count("*").alias("copies"))
        .filter("copies > 1 and first_id is not null")
        .select("digest", "first_id"),
        "warc-repeated",
    )


def _field(name: str, value: Column) -> Column:
    """A header line, or nothing for NULL; line ends in the value are percent-encoded."""
    safe = F.replace(F.replace(value.cast("string"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit("\r\n")), F.lit(""))


def write_warc(pages: DataFrame, path: str) -> None:
    """One WARC/1.1 record per page (``page_id``, ``url``, ``html``), a file per task.

    The payload is the html in UTF-8, NULL being empty. Of equal payloads of at least 100 bytes the
    one with the smallest id is a response and the others revisit it; rows that repeat this id are
    responses too, and a page without an id is never revisited. Texts are shuffled only if the table
    of repeated payloads is too large to broadcast.
    """
    page = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html")).withColumn(
        "digest", F.sha2(utf8("html"), 256)
    )
    joined = page.join(repeated_payloads(pages), "digest", "left")
    revisit = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    block = F.when(revisit, F.lit("")).otherwise(F.col("html"))
    urn = F.concat(F.lit("<urn:page:"), F.coalesce(F.col("page_id").cast("string"), F.lit("")), F.lit(">"))
    header = F.concat(
        F.lit("WARC/1.1\r\n"),
        _field("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _field("WARC-Record-ID", urn),
        _field("WARC-Date", F.lit(DATE)),
        _field("WARC-Target-URI", F.col("url")),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "digest")),
        _field("WARC-Profile", F.when(revisit, F.lit(PROFILE))),
        _field(
            "WARC-Refers-To",
            F.when(revisit, F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">"))),
        ),
        _field("X-Payload-Length", F.octet_length("html")),
        _field("Content-Type", F.lit("text/html; charset=utf-8")),
        _field("Content-Length", F.octet_length(block)),
    )
    # The text writer ends each row with a line feed, the last byte of the record.
    record = F.concat(header, F.lit("\r\n"), block, F.lit("\r\n\r"))
    joined.select(record.alias("value")).write.option("lineSep", "\n").text(path)


class _Segments:
    """Collects the rows of one task and hands them on in batches of bounded size."""

    def __init__(self, content: bool) -> None:
        self.content = content
        self.rows: list[tuple] = []
        self.bytes = 0

    def add(self, key: tuple, pos: int, lines: list[bytes], magic: bool) -> None:
        data = b"\n".join([*lines, b""])
        header = head = payload = raw = None
        complete = exact = False
        if magic:
            end = data.find(END)
            complete = end >= 0
            header = data[: end + 4] if complete else data
            found = _LENGTH.search(header) if complete else None
            if found:
                stop = len(header) + int(found[1])
                exact = stop + 4 == len(data) and data.endswith(END)
                if exact and self.content:
                    payload = data[len(header) : stop]
        elif data.startswith(b"\r\n"):
            head = b"\r\n"
        elif (end := data.find(END)) >= 0:
            head = data[: end + 4]
        if self.content and not exact:
            raw = data
        self.rows.append(
            (*key, pos, len(data), magic, header, complete, exact, head, payload, raw)
        )
        self.bytes += len(data) if self.content else 500

    def batch(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows, strict=True)) or [()] * len(_SEGMENT)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, _SEGMENT, strict=True)]
        self.rows, self.bytes = [], 0
        return pa.RecordBatch.from_arrays(arrays, schema=_SEGMENT)


def segments(spark: SparkSession, path: str, content: bool) -> DataFrame:
    """The splits of all files, cut at look-alikes; payloads and raw bytes only with ``content``."""

    def task(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Segments(content)
        key, pos, begin, lines, magic = None, 0, 0, [], False
        for batch in batches:
            for value, file, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, start) != key:
                    if lines:
                        out.add(key, begin, lines, magic)
                    key, pos, begin, lines, magic = (file, start), 0, 0, [], False
                if value.startswith(MAGIC):
                    if lines:
                        out.add(key, begin, lines, magic)
                    begin, lines, magic = pos, [], True
                    if out.bytes >= BATCH_BYTES:
                        yield out.batch()
                lines.append(value)
                pos += len(value) + 1
        if lines:
            out.add(key, begin, lines, magic)
        yield out.batch()

    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("value").cast("binary").alias("value"),
        # A number in place of the path keeps the tables of offsets, and what is broadcast, small.
        F.xxhash64("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    ).mapInArrow(task, SEGMENT_SCHEMA)


def blocks_of(index: DataFrame) -> DataFrame:
    """Per split: its place in the file, its size, the file's size, the head of the next split."""
    sizes = index.groupBy("file", "start").agg(
        F.sum("length").alias("block_length"), F.max("head").alias("head")
    )
    order = Window.partitionBy("file").orderBy("start")
    return sizes.select(
        "file",
        "start",
        "block_length",
        (F.sum("block_length").over(order) - F.col("block_length")).alias("base"),
        F.sum("block_length").over(Window.partitionBy("file")).alias("file_size"),
        F.lead("head").over(order).alias("next_head"),
    )


def candidates_of(index: DataFrame, blocks: DataFrame) -> DataFrame:
    """Look-alikes with a readable header: offset, successor, payload place, header as text."""
    last = F.col("pos") + F.col("length") == F.col("block_length")
    header = F.when(F.col("complete"), F.col("header")).when(
        last, F.concat("header", "next_head")
    )
    length = F.regexp_extract(F.col("text"), _LENGTH_SQL, 1)
    return (
        index.filter("magic")
        .join(blocks, ["file", "start"])
        .withColumn("text", header.cast("string"))
        .withColumn("offset", F.col("base") + F.col("pos"))
        .withColumn("payload_length", length.try_cast("long"))
        .filter("payload_length is not null")
        .withColumn("payload_start", F.col("offset") + F.octet_length("text"))
        .withColumn("successor", F.col("payload_start") + F.col("payload_length") + len(END))
        .select(
            "file", "offset", "successor", "start", "pos", "exact", "payload_start",
            "payload_length", "file_size", "text",
        )
    )


def reachable(candidates: DataFrame) -> DataFrame:
    """(file, offset) of the candidates that the chain from offset 0 of their file reaches.

    The jump table doubles its reach each round; rounds are as many as the logarithm of the longest
    chain. Keys are file and offset, so a file with most of the records is no hot key.
    """
    jump = store(candidates.select("file", "offset", F.col("successor").alias("to")), "warc-jump")
    found = store(jump.filter(F.col("offset") == 0).select("file", "offset"), "warc-found")
    known = found.count()
    while True:
        ahead = found.join(jump, ["file", "offset"]).select("file", F.col("to").alias("offset"))
        # A successor beyond the last record is no candidate.
        real = ahead.join(candidates.select("file", "offset"), ["file", "offset"], "left_semi")
        found = store(found.unionAll(real).distinct(), "warc-found")
        before, known = known, found.count()
        if known == before:
            return found
        further = jump.select("file", F.col("offset").alias("to"), F.col("to").alias("next"))
        jump = store(
            jump.join(further, ["file", "to"]).select("file", "offset", F.col("next").alias("to")),
            "warc-jump",
        )


def _spanning(spark: SparkSession, path: str, loose: DataFrame, blocks: DataFrame) -> DataFrame:
    """(text, payload) of records that are not one segment: pieces of the segments they cover."""
    end = F.col("payload_start") + F.col("payload_length")

    def cells(first: Column, stop: Column) -> Column:
        """The stretches of ``CELL`` bytes that a range has a part in."""
        last = F.greatest(first, stop - 1)
        return F.explode(F.sequence(F.floor(first / CELL), F.floor(last / CELL)))

    # Records and segments meet in the stretches of their file, not each with all of the file.
    wanted = loose.select(
        "file", "offset", "payload_start", "payload_length", cells(F.col("payload_start"), end).alias("cell")
    )
    block_end = F.col("base") + F.col("block_length")
    held = blocks.select("file", "start", "base", "block_length", cells(F.col("base"), block_end).alias("cell"))
    needs = store(
        wanted.join(held, ["file", "cell"])
        .filter((F.col("base") < end) & (block_end > F.col("payload_start")))
        .drop("cell")
        .distinct(),
        "warc-needs",
    )
    data = F.coalesce("raw", F.concat("header", "payload", F.lit(END)))
    at = F.col("base") + F.col("pos")
    first = F.greatest(F.lit(0), F.col("payload_start") - F.col("at"))
    stop = F.least(F.col("length"), end - F.col("at"))
    pieces = (
        segments(spark, path, content=True)
        .select("file", "start", "pos", "length", data.alias("data"))
        .join(needs, ["file", "start"])
        .withColumn("at", at)
        .withColumn("first", first)
        .withColumn("stop", stop)
        .filter("first < stop")
        .select(
            "file", "offset", "at",
            F.expr("substring(data, cast(first + 1 as int), cast(stop - first as int))").alias("piece"),
        )
    )
    whole = pieces.groupBy("file", "offset").agg(
        F.array_sort(F.collect_list(F.struct("at", "piece"))).alias("pieces")
    )
    empty = F.lit(b"")
    payload = F.aggregate("pieces", empty, lambda done, x: F.concat(done, x["piece"]))
    return loose.join(whole, ["file", "offset"], "left").select(
        "text", F.coalesce(payload, empty).alias("payload")
    )


def _value(name: str) -> Column:
    found = F.regexp_extract("text", rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)\r\n", 1)
    return F.when(found != "", found)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """All records of the plain archives in a folder: header fields and payload, a row per record.

    Compressed archives (``.warc.gz``) are not read: their records begin at no place that a split could
    look for. Unpack them first.

    Columns: record_type, record_id, target_uri, refers_to, payload_digest, payload_length (of the
    full payload, where the writer told it), payload (binary). Raises ``ValueError`` if a file's
    chain does not end at its end. Empty files and folders give no rows.
    """
    index = store(segments(spark, path, content=False).drop("payload", "raw"), "warc-index")
    blocks = store(blocks_of(index), "warc-blocks")
    candidates = store(candidates_of(index, blocks), "warc-candidates")
    found = reachable(candidates)
    records = candidates.join(found, ["file", "offset"], "left_semi")
    ends = records.groupBy("file").agg(F.max("successor").alias("end"))
    broken = store(
        blocks.groupBy("file").agg(F.max("file_size").alias("file_size"))
        .join(ends, "file", "left")
        .filter("end is null or end <> file_size"),
        "warc-broken",
    )
    if not broken.isEmpty():
        raise ValueError(f"the chain of records breaks in {broken.count()} files under {path}")
    # Few look-alikes are false, so leaving these out needs no shuffle of the payloads.
    false = index.filter("magic").select("file", "start", "pos").join(
        records.select("file", "start", "pos"), ["file", "start", "pos"], "left_anti"
    )
    false = store(false, "warc-rejected")
    exact = (
        segments(spark, path, content=True)
        .filter("exact")
        .join(false, ["file", "start", "pos"], "left_anti")
        .select(F.col("header").cast("string").alias("text"), "payload")
    )
    loose = store(records.filter("not exact"), "warc-loose")
    if not loose.isEmpty():
        exact = exact.unionByName(_spanning(spark, path, loose, blocks))
    return exact.select(
        _value("WARC-Type").alias("record_type"),
        _value("WARC-Record-ID").alias("record_id"),
        _value("WARC-Target-URI").alias("target_uri"),
        _value("WARC-Refers-To").alias("refers_to"),
        _value("WARC-Payload-Digest").alias("payload_digest"),
        _value("X-Payload-Length").cast("long").alias("payload_length"),
        "payload",
    )


def _page(column: str) -> Column:
    return F.regexp_extract(column, r"urn:page:(-?[0-9]+)", 1).try_cast("long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages, read them back, and report each record by its page."""
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_warc(pages, path)
    stored = F.col("record_type") == "response"
    return read_warc(spark, path).select(
        _page("record_id").alias("page_id"),
        F.when(stored, F.octet_length("payload").cast("long"))
        .otherwise(F.col("payload_length"))
        .alias("payload_bytes"),
        F.when(stored, F.sha2("payload", 256))
        .otherwise(F.regexp_replace("payload_digest", "^sha256:", ""))
        .alias("payload_digest"),
        "record_type",
        _page("refers_to").alias("refers_to"),
    )
