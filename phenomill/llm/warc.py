"""WARC archives: writing, normalising whole-file gzip streams, reading by offset.

``write_archives`` puts one record per page into archives that are compressed as one gzip stream each. Of records
with equal payloads of at least ``least_bytes`` the one with the largest page id holds the payload, the others
revisit it. ``normalise`` inflates each archive once, as a stream, writes every record as a gzip member of its own
and an offset index beside the archive; ``read_records`` then fetches records by offset.

All files go to the shared folder. Tasks open them through ``pyarrow.fs`` by URI, so any store that it knows
will do. A normalised file appears by a rename when it is whole, and two attempts write the same bytes: a lost
executor does no harm. Archives hold at most ``records_per_file`` records; a task holds one record at a time.

Null html counts as empty; null urls are left out and line breaks in them are percent-encoded; repeated page ids have a
record each; without an id a page can't be referred to: it is written without one, and never
stays for others. An empty table gives no records; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from phenomill.llm.common import texts, written
from phenomill.session import scratch_path

RECORDS_PER_FILE = 20_000
READ_BYTES = 1 << 20
BLANK = "\r\n\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = "archive string, record long, page_id long, record_type string, offset long, length long"
RECORDS = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _described(with_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = texts(batch, "html")
            keys = pa.array([hashlib.sha256(p).digest() for p in payloads], pa.binary())
            sizes = pa.array([len(p) for p in payloads], pa.int64())
            if not with_payload:
                yield pa.RecordBatch.from_arrays([keys, batch.column("page_id"), sizes], ["key", "page_id", "size"])
                continue
            sha1 = pa.array([base32_sha1(p) for p in payloads], pa.string())
            yield pa.RecordBatch.from_arrays([keys, *batch.columns, sizes, sha1], ["key", *batch.schema.names, "size", "sha1"])

    return run


def decided(pages: DataFrame, page_id: str, url: str, html: str, least_bytes: int) -> DataFrame:
    """Pages with size, sha1 and refers_to (null for a response). Payloads meet by their SHA-256."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html")
    )
    small = rows.mapInArrow(_described(False), "key binary, page_id long, size long")
    stays = written(small.where(F.col("size") >= least_bytes).groupBy("key").agg(F.max("page_id").alias("stays")), "warc-stays")
    full = rows.mapInArrow(_described(True), "key binary, page_id long, url string, html string, size long, sha1 string")
    refers = F.when(F.col("page_id").isNull() | (F.col("page_id") != F.col("stays")), F.col("stays"))
    return full.join(stays, "key", "left").withColumn("refers_to", refers).drop("key", "stays")


def _record(rows: DataFrame) -> DataFrame:
    """One column: the record without the blank lines that end it."""
    line = lambda name, value: F.when(value.isNotNull(), F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))).otherwise("")
    urn = lambda c: F.concat(F.lit("<urn:page:"), c.cast("string"), F.lit(">"))
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit(BLANK)
    )
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(F.col("html")))
    size = F.octet_length(http) + F.when(revisit, F.lit(0)).otherwise(F.octet_length("html"))
    safe = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    head = F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "),
        F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit(f"\r\nWARC-Date: {DATE}\r\n"),
        line("WARC-Record-ID", urn(F.col("page_id"))),
        line("WARC-Target-URI", safe),
        F.concat(F.lit("WARC-Payload-Digest: sha1:"), F.col("sha1"), F.lit("\r\n")),
        line("WARC-Refers-To", urn(F.col("refers_to"))),
        F.when(revisit, F.lit(f"WARC-Profile: {PROFILE}\r\n")).otherwise(""),
        F.lit("Content-Type: application/http; msgtype=response\r\nContent-Length: "),
        size.cast("string"),
        F.lit(BLANK),
    )
    return rows.select(F.concat(head, block).alias("value"))


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    html: str = "html",
    least_bytes: int = 0,
    records_per_file: int = RECORDS_PER_FILE,
) -> None:
    """Archives as Spark writes gzip text: one stream per file, records ended by two line breaks."""
    rows = _record(decided(pages, page_id, url, html, least_bytes))
    options = {"compression": "gzip", "lineSep": BLANK, "maxRecordsPerFile": records_per_file}
    rows.write.options(**options).text(folder)


def _opened(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri))


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The bytes of a gzip stream, of one member or several."""
    stream = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            yield stream.decompress(chunk)
            chunk = b""
            if stream.eof:
                chunk = stream.unused_data
                stream = zlib.decompressobj(31)


def header(raw: bytes) -> dict[str, str]:
    lines = raw.decode("utf-8", "replace").split("\r\n")
    return {name.lower(): value.strip() for name, _, value in (x.partition(":") for x in lines[1:])}


def records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, whole record with the blank lines at its end) of an inflated archive."""
    buffer = bytearray()

    def filled(n: int) -> bool:
        while len(buffer) < n:
            more = next(chunks, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    searched = 0
    while True:
        at = buffer.find(b"\r\n\r\n", max(0, searched - 3))
        if at < 0:
            searched = len(buffer)
            if not filled(searched + 1):
                if buffer.strip():
                    raise ValueError("an archive ends within a record")
                return
            continue
        fields = header(bytes(buffer[:at]))
        end = at + 4 + int(fields["content-length"]) + 4
        if not filled(end):
            raise ValueError("an archive ends within a record")
        yield fields, bytes(buffer[:end])
        del buffer[:end]
        searched = 0


def _chunks(uri: str) -> Iterator[bytes]:
    system, path = _opened(uri)
    with system.open_input_stream(path, compression=None) as source:
        while chunk := source.read(READ_BYTES):
            yield chunk


def _page(value: str | None) -> int | None:
    return int(value.removeprefix("<urn:page:").rstrip(">")) if value else None


def normalise_file(source: str, target: str, level: int = 6) -> list[tuple]:
    """Rewrites one archive record by record, with its index beside it; returns the index rows."""
    system, path = _opened(target)
    part = f"{path}.{uuid.uuid4().hex}.part"
    rows, offset = [], 0
    with system.open_output_stream(part, compression=None) as out, system.open_output_stream(part + ".idx", compression=None) as side:
        for number, (fields, whole) in enumerate(records(inflated(_chunks(source)))):
            packer = zlib.compressobj(level, zlib.DEFLATED, 31)
            member = packer.compress(whole) + packer.flush()
            out.write(member)
            row = (target, number, _page(fields.get("warc-record-id")), fields["warc-type"], offset, len(member))
            side.write((json.dumps(dict(zip(("record", "page_id", "type", "offset", "length"), row[1:]))) + "\n").encode())
            rows.append(row)
            offset += len(member)
    for made, final in ((part, path), (part + ".idx", path + ".idx")):
        if system.get_file_info(final).type != fs.FileType.NotFound:
            system.delete_file(final)  # of an earlier attempt, with the same bytes
        system.move(made, final)
    return rows


def _index_batch(rows: list[tuple]) -> pa.RecordBatch:
    names = [f.split()[0] for f in INDEX.split(", ")]
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
    columns = list(zip(*rows)) or [()] * 6
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names)


def normalise(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Normalises every ``*.gz`` archive of a folder into ``target``; the index as a stored table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for source in batch.column("path").to_pylist():
                name = re.sub(r"(\.\w+)?\.gz$", "", source.rsplit("/", 1)[-1])
                yield _index_batch(normalise_file(source, f"{target}/{name}.warc.gz"))

    _make_folder(target)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("path")
    return written(files.mapInArrow(run, INDEX), "warc-index")


def _make_folder(uri: str) -> None:
    system, path = _opened(uri)
    system.create_dir(path, recursive=True)


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [f.split()[0] for f in RECORDS.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
    open_as, source = None, None
    for batch in batches:
        rows, held = [], 0
        for archive, offset, length in zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))):
            if open_as != archive:
                if source:
                    source.close()
                system, path = _opened(archive)
                open_as, source = archive, system.open_input_file(path)
            source.seek(offset)
            fields, whole = next(records(inflated(iter([source.read(length)]))))
            block = whole[whole.index(b"\r\n\r\n") + 4 : -4]
            cut = block.index(b"\r\n\r\n")
            payload, kind = block[cut + 4 :], fields["warc-type"]
            digest = fields["warc-payload-digest"].removeprefix("sha1:")
            size = int(header(block[:cut])["content-length"])
            if kind == "response" and (base32_sha1(payload) != digest or len(payload) != size):
                raise ValueError(f"a payload in {archive} differs from its digest")
            rows.append((_page(fields.get("warc-record-id")), fields.get("warc-target-uri"), kind, _page(fields.get("warc-refers-to")), size, digest, payload))
            held += len(payload)
            if held > 16 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
                rows, held = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
    if source:
        source.close()


def read_records(index: DataFrame) -> DataFrame:
    """Records of the indexed archives, fetched by offset and checked against their digests."""
    archives = max(1, index.select("archive").distinct().count())
    rows = index.select("archive", "offset", "length").repartition(archives, "archive").sortWithinPartitions("archive", "offset")
    return rows.mapInArrow(_read, RECORDS)


def archived_pages(pages: DataFrame, **options) -> DataFrame:
    """Pages written as archives, normalised and read back: the records."""
    spark = pages.sparkSession
    folder = scratch_path(spark, "warc")
    write_archives(pages, f"{folder}/streams", **options)
    return read_records(normalise(spark, f"{folder}/streams", f"{folder}/members"))
