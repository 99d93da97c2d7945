"""Web archives of one Zstandard frame per record, with a shared dictionary.

A file starts with a skippable frame that holds the dictionary its records were compressed with; then
each record is a frame of its own, so that a reader can start at any of them. Of records with equal
payloads only one carries the payload; the others are revisits that refer to it.

Files are written with Spark's text writer: a record's frame is the line, and an empty skippable
frame, which decoders pass over, is the line separator. Reading takes whole files, one per row; the
writer keeps them below :data:`FILE_BYTES` of payload by the number of partitions.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import work_dir

DICTIONARY_MAGIC = 0x184D2A5D
SKIPPABLE = range(0x184D2A50, 0x184D2A60)
FRAME_MAGIC = 0xFD2FB528
#: An empty skippable frame: its magic number and a length of zero. All bytes are ASCII.
SEPARATOR = struct.pack("<II", 0x184D2A50, 0).decode("ascii")
FILE_BYTES = 16 << 20
DICTIONARY_BYTES, SAMPLE_RECORDS, SAMPLE_BYTES = 16 << 10, 400, 1 << 20
LEVEL = 3

FIELDS = ["WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length"]
RECORDS = (
    "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"
)


class BadArchive(ValueError):
    """An archive that breaks the format."""


def _header_value(value: str) -> str:
    """Line ends would end the header."""
    return re.sub(r"[\r\n]+", " ", value)


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, revisit: bool, date: str = "1970-01-01T00:00:00Z") -> bytes:
    """A WARC/1.1 record; a revisit has an empty block. ``page_id`` and ``refers_to`` may be None."""
    block = b"" if revisit else payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Target-URI: {_header_value(url)}"] if url is not None else []),
        *(
            ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
             f"WARC-Refers-To: <urn:page:{'' if refers_to is None else refers_to}>"]
            if revisit else []
        ),
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(samples: list[bytes]) -> bytes:
    """A dictionary for records like the samples; empty if there are too few to train one."""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if len(samples) < 16 or size < 1024:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:  # the samples are too much alike
        return b""


def _write_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``frame``: the dictionary's frame, if there is one, then the records' frames."""

    def rows():
        for batch in batches:
            html = batch.column("html").cast(pa.binary())
            small = batch.drop_columns(["html"]).to_pylist()
            for r, payload in zip(small, html):
                yield record_bytes(r["page_id"], r["url"], payload.as_py() or b"", r["digest"], r["refers_to"], r["revisit"])

    records, first, size = rows(), [], 0
    for record in records:
        first.append(record)
        size += len(record)
        if len(first) >= SAMPLE_RECORDS or size >= SAMPLE_BYTES:
            break
    shared = dictionary(first)
    out = [struct.pack("<II", DICTIONARY_MAGIC, len(shared)) + shared] if shared else []
    packer = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(shared)) if shared else zstandard.ZstdCompressor(level=LEVEL)
    held = 0
    for source in (first, records):
        for record in source:
            out.append(packer.compress(record))
            held += len(out[-1])
            if held > 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                out, held = [], 0
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record for each row of ``pages`` (``page_id``, ``url``, ``html``) to files below ``path``.

    Of rows with equal payloads the one with the smallest ``page_id`` (null last) becomes the
    response, of equal ones just one; the others become revisits of it. Ids travel without the
    pages: each row's html is shuffled once, by id, which spreads copies over all tasks.
    """
    digest = F.sha1(F.coalesce(F.col("html"), F.lit("")))
    payloads = pages.select("page_id", "url", "html", digest.alias("sha")).withColumn("k", F.xxhash64("page_id", "sha"))
    firsts = payloads.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    copies = firsts.filter("n > 1").select("sha", "first")
    ids = payloads.select("k", "page_id", "sha").join(copies, "sha").distinct()
    ids = ids.select("k", F.col("page_id").alias("id"), F.col("sha").alias("sha_"), "first").alias("i")
    total = pages.agg(F.coalesce(F.sum(F.octet_length("html")), F.lit(0))).first()[0]
    parts = max(1, -(-total // FILE_BYTES), pages.sparkSession.sparkContext.defaultParallelism)
    # One shuffle by k serves the join, the window and the files.
    rows = payloads.repartition(parts, "k").alias("p")
    # The other columns only guard against equal hashes. As further keys they would ask for another shuffle.
    differ = lambda a, b: F.coalesce((F.col(a) < F.col(b)) | (F.col(a) > F.col(b)), F.lit(False))
    same = (F.col("p.k") == F.col("i.k")) & ~differ("page_id", "id") & ~differ("sha", "sha_")
    rows = rows.join(ids, same, "left").drop(F.col("i.k"))
    # Rows that repeat both id and payload: one of them is the response.
    number = F.row_number().over(Window.partitionBy("k", "page_id", "sha").orderBy("url"))
    revisit = F.col("sha_").isNotNull() & (~F.col("first").eqNullSafe(F.col("page_id")) | (number > 1))
    rows = rows.withColumn("revisit", revisit).withColumn("refers_to", F.when(F.col("revisit"), F.col("first")))
    records = rows.select("page_id", "url", "html", F.col("sha").alias("digest"), "refers_to", "revisit")
    frames = records.mapInArrow(_with_digest, "frame binary")
    # A file is what a task wrote: a session's limit on records would leave the second one without its dictionary.
    writer = frames.select(F.col("frame").cast("string").alias("value")).write.option("maxRecordsPerFile", 0)
    writer.option("lineSep", SEPARATOR).text(path)


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests in base 32 instead of hexadecimal, then records."""

    def changed():
        for batch in batches:
            own = [base64.b32encode(bytes.fromhex(x)).decode() for x in batch.column("digest").to_pylist()]
            at = batch.schema.get_field_index("digest")
            yield batch.set_column(at, "digest", pa.array(own, pa.string()))

    return _write_records(changed())


def frames(data: bytes) -> Iterator[tuple[int, int, int]]:
    """``(magic number, start, end)`` of each frame of an archive, from its headers alone."""
    at = 0
    while at < len(data):
        if at + 8 > len(data):
            raise BadArchive("cut frame header")
        magic, size = struct.unpack_from("<II", data, at)
        start = at
        if magic in SKIPPABLE:
            at += 8 + size
        elif magic == FRAME_MAGIC:
            head = data[at : at + 18]
            at += zstandard.frame_header_size(head)
            last = False
            while not last:
                if at + 3 > len(data):
                    raise BadArchive("cut block header")
                block = int.from_bytes(data[at : at + 3], "little")
                last, kind, length = block & 1, block >> 1 & 3, block >> 3
                at += 3 + (1 if kind == 1 else length)
            at += 4 * zstandard.get_frame_parameters(head).has_checksum
        else:
            raise BadArchive(f"no frame starts with {magic:#x}")
        if at > len(data):
            raise BadArchive("cut frame")
        yield magic, start, at


def parse_record(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises :class:`BadArchive` if it breaks the format."""
    head, found, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8").split("\r\n")
    if not found or lines[0] not in ("WARC/1.0", "WARC/1.1"):
        raise BadArchive("no WARC header")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(":")
        if not colon or not name.strip():
            raise BadArchive("a header line without a name")
        fields[name.strip()] = value.strip()
    for name in FIELDS:
        if name not in fields:
            raise BadArchive(f"no {name}")
    if not re.fullmatch(r"\d+", fields["Content-Length"]):
        raise BadArchive("Content-Length is no number")
    length = int(fields["Content-Length"])
    if len(rest) != length + 4 or rest[length:] != b"\r\n\r\n":
        raise BadArchive("the block is not as long as Content-Length says")
    return fields, rest[:length]


def read_archive(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of every record of an archive, with all checks."""
    unpacker = zstandard.ZstdDecompressor()
    view = memoryview(data)
    for k, (magic, start, end) in enumerate(frames(data)):
        if magic == DICTIONARY_MAGIC:
            if k:
                raise BadArchive("a dictionary after the first frame")
            content = bytes(view[start + 8 : end])
            if content[:4] == struct.pack("<I", FRAME_MAGIC):  # the dictionary may be compressed itself
                content = zstandard.ZstdDecompressor().decompress(content, max_output_size=64 << 20)
            unpacker = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(content))
        elif magic == FRAME_MAGIC:
            try:
                raw = unpacker.decompressobj().decompress(view[start:end])
            except zstandard.ZstdError as problem:
                raise BadArchive(str(problem)) from problem
            fields, block = parse_record(raw)
            digest = fields.get("WARC-Payload-Digest", "")
            if fields["WARC-Type"] == "response" and digest and digest != "sha1:" + base32_sha1(block):
                raise BadArchive("the payload does not have its digest")
            yield fields, block


def _page(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d*)>", urn or "")
    if not found:
        raise BadArchive("no page id")
    return int(found[1]) if found[1] else None


def _parse(keep_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
            ("payload_digest", pa.string()), ("payload_bytes", pa.int64()), ("payload", pa.binary()),
        ])
        for batch in batches:
            for content in batch.column(0):
                rows, size = [], 0
                for fields, block in read_archive(content.as_py() or b""):
                    revisit = fields["WARC-Type"] == "revisit"
                    rows.append({
                        "page_id": _page(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI"),
                        "record_type": fields["WARC-Type"], "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None,
                        "payload_digest": fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                        "payload_bytes": int(fields["X-Payload-Length"]) if revisit else len(block),
                        "payload": block if keep_payload and not revisit else None,
                    })
                    size += len(block) if keep_payload else 100
                    if size > 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def read_archives(spark: SparkSession, path: str, keep_payload: bool = True) -> DataFrame:
    """Records of all archives below ``path``, with the columns of :data:`RECORDS`.

    A file that breaks the format fails the job with :class:`BadArchive`. Revisits have no payload.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(_parse(keep_payload), RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives of ``pages`` to the shared folder and read them back.

    Returns ``page_id``, ``payload_bytes``, ``payload_digest``, ``record_type`` and ``refers_to`` per
    row. Null html counts as empty; null ids and urls and repeated rows are kept; further columns are
    ignored; an empty table gives an empty result.
    """
    path = work_dir(pages.sparkSession, "warc")
    write_archives(pages.select("page_id", "url", "html"), path)
    return read_archives(pages.sparkSession, path, keep_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )
