"""WARC archives of Zstandard frames: a dictionary in front, then one frame for each record.

An archive is a skippable frame (its magic number is ``DICTIONARY_FRAME``) that holds the dictionary,
followed by one frame per record, compressed with that dictionary. The reader takes the dictionary from
the leading frame, decodes frame by frame, and checks every record: version line, required fields, the
declared length of the block, the two line ends behind it, the length of the HTTP payload and its digest.

Of pages with equal payloads of at least ``REVISIT_BYTES`` bytes the one with the largest page id is
written as a response and the others as revisits that refer to it. Payloads are equal if their lengths
and SHA-1 digests are.

Rules: a null html counts as empty, a null url gets a name made from the page id. Rows that share both
page id and payload are all responses if that id is the largest. A null page id takes no part in finding
the largest; if no page of a group has an id, all are responses. Extra columns take no part. An empty
table gives no archives. A page of any length is one record; an archive ends with the record that fills it.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hailgrid.llm.arrow import batch_of, column, slices
from hailgrid.llm.files import unique, write_file
from hailgrid.llm.sampling import sampled_keys

# Fixed values of the two formats.
DICTIONARY_FRAME = 0x184D2A5D
FRAME = 0xFD2FB528
VERSION = b"WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
REQUIRED = ("warc-type", "warc-record-id", "warc-date", "content-length")

REVISIT_BYTES = 1000
#: Compressed bytes after which an archive is closed.
ARCHIVE_BYTES = 8 << 20
#: The dictionary is trained on so many pages at most, of each at most so many characters.
SAMPLE_PAGES, SAMPLE_CHARS = 1000, 16384
DICTIONARY_BYTES = 65536
LEVEL = 3
DATE = "2025-01-01T00:00:00Z"

MANIFEST = "name string, records long, bytes long"
RECORDS = (
    "archive string, offset long, frame_bytes long, record_type string, record_id string, "
    "target_uri string, refers_to string, payload_digest string, payload_bytes long, payload binary"
)


def train(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> bytes:
    """A dictionary from a bounded sample of pages; empty if there are too few to train on."""
    picked = sampled_keys(pages, page_id, SAMPLE_PAGES)
    sample = pages.where(F.col(page_id).isin(picked)).select(F.substring(html, 1, SAMPLE_CHARS))
    texts = [x[0].encode() for x in sample.limit(SAMPLE_PAGES).collect() if x[0]]
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes() if len(texts) > 9 else b""
    except zstandard.ZstdError:
        return b""


def identified(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages with payload digest and length, and the id of the page that a revisit refers to."""
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.col(url).cast("string").alias("url"),
        F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8").alias("payload"),
    )
    rows = rows.withColumns({"digest": F.sha1("payload"), "size": F.octet_length("payload").cast("long")})
    groups = rows.where(F.col("size") >= REVISIT_BYTES).groupBy("digest", "size")
    groups = groups.agg(F.max("page_id").alias("last_id"), F.count(F.lit(1)).alias("copies"))
    groups = groups.where((F.col("copies") > 1) & F.col("last_id").isNotNull()).drop("copies")
    joined = rows.join(groups, ["digest", "size"], "left")
    other = ~F.col("page_id").eqNullSafe(F.col("last_id"))
    return joined.select(
        "page_id", "url", "payload", "digest", F.when(other, F.col("last_id")).alias("refers_to")
    )


def record(page: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """A WARC record: named fields, and an HTTP answer as its block (without body in a revisit)."""
    if page is None:
        own = f"urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{url} {digest}')}"
    else:
        own = f"urn:page:{page}"
    target = re.sub(r"[\x00-\x20\x7f]", lambda x: f"%{ord(x[0]):02X}", url) if url else own
    revisit = refers_to is not None
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block += b"" if revisit else payload
    fields = {
        "WARC-Type": "revisit" if revisit else "response",
        "WARC-Record-ID": f"<{own}>",
        "WARC-Date": DATE,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode(),
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if revisit:
        fields |= {"WARC-Profile": SAME_PAYLOAD, "WARC-Refers-To": f"<urn:page:{refers_to}>"}
    head = "".join(f"{k}: {v}\r\n" for k, v in fields.items()).encode()
    return VERSION + b"\r\n" + head + b"\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, folder: str, dictionary: bytes, archive_bytes: int = ARCHIVE_BYTES
) -> DataFrame:
    """Write the rows of ``identified`` to archives in ``folder``; returns the stored manifest."""
    schema = pa.schema([("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=known, write_checksum=True)
        lead = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary] if dictionary else []
        task, number, frames, size = TaskContext.get().partitionId(), 0, [], 0

        def close() -> pa.RecordBatch:
            name = unique(f"pages-{task:06d}-{number:04d}", ".warc.zst")
            data = b"".join([*lead, *frames])
            write_file(folder, name, data)
            return batch_of(schema, [[name], [len(frames)], [len(data)]])

        for batch in slices(batches):
            names = ("page_id", "url", "payload", "digest", "refers_to")
            for row in zip(*(column(batch, x) for x in names)):
                frames.append(press.compress(record(*row)))
                size += len(frames[-1])
                if size >= archive_bytes:
                    yield close()
                    frames, size, number = [], 0, number + 1
        if frames:
            yield close()

    store = f"{folder}/manifest"
    pages.mapInArrow(work, MANIFEST).write.mode("overwrite").parquet(store)
    return pages.sparkSession.read.parquet(store)


def _leading(data: bytes) -> tuple[bytes, int]:
    """The dictionary of an archive and where the first record begins."""
    if len(data) < 8 or struct.unpack_from("<I", data)[0] != DICTIONARY_FRAME:
        return b"", 0
    end = 8 + struct.unpack_from("<I", data, 4)[0]
    held = data[8:end]
    if len(data) < end:
        raise ValueError("the dictionary is cut short")
    if held[:4] == struct.pack("<I", FRAME):  # a dictionary may be compressed itself
        held = zstandard.ZstdDecompressor().decompressobj().decompress(held)
    return held, end


def frames(data: bytes, piece: int = 1 << 15) -> Iterator[tuple[int, int, bytes]]:
    """Offset, size and content of each frame behind the dictionary."""
    dictionary, at = _leading(data)
    known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
    press = zstandard.ZstdDecompressor(dict_data=known)
    while at < len(data):
        one, out, end = press.decompressobj(), [], at
        while not one.eof:
            if end >= len(data):
                raise ValueError(f"the frame at {at} is cut short")
            fed = data[end : end + piece]
            out.append(one.decompress(fed))
            end += len(fed)
        end -= len(one.unused_data)
        yield at, end - at, b"".join(out)
        at = end


def parse(content: bytes) -> dict:
    """Check a record and take it apart."""
    head, found, rest = content.partition(b"\r\n\r\n")
    lines = head.split(b"\r\n")
    if not found or lines[0] not in (VERSION, b"WARC/1.0"):
        raise ValueError(f"no version line or no end of the fields: {content[:60]!r}")
    fields: dict[str, str] = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"not a field: {line[:80]!r}")
        fields[name.decode().lower()] = value.strip().decode()
    for name in REQUIRED:
        if not fields.get(name):
            raise ValueError(f"{name} is missing")
    if not fields["content-length"].isdecimal() or int(fields["content-length"]) != len(rest) - 4:
        raise ValueError(f"declared length {fields['content-length']}, found {len(rest) - 4}")
    if rest[-4:] != b"\r\n\r\n":
        raise ValueError("the record does not end with two line ends")
    if fields["warc-type"] not in ("response", "revisit"):
        return {"record_type": fields["warc-type"], "fields": fields}
    http, found, payload = rest[:-4].partition(b"\r\n\r\n")
    size = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", http)
    if not found or not size:
        raise ValueError("no HTTP fields or no payload length")
    kind, _, digest = fields.get("warc-payload-digest", "").partition(":")
    if kind != "sha1":
        raise ValueError("no SHA-1 payload digest")
    hexed = base64.b32decode(digest).hex()
    if fields["warc-type"] == "response":
        if len(payload) != int(size[1]):
            raise ValueError(f"declared payload {int(size[1])}, found {len(payload)}")
        if hashlib.sha1(payload).hexdigest() != hexed:
            raise ValueError("the payload does not have its digest")
    elif "warc-refers-to" not in fields or payload:
        raise ValueError("a revisit needs a reference and has no payload")
    return {
        "record_type": fields["warc-type"],
        "fields": fields,
        "payload_digest": hexed,
        "payload_bytes": int(size[1]),
        "payload": payload if fields["warc-type"] == "response" else None,
    }


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record of every archive in ``folder``; a record that fails a check ends the job."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder)
    named = files.select(F.element_at(F.split("path", "/"), -1).alias("name"), "content")
    schema = pa.schema([
        ("archive", pa.string()), ("offset", pa.int64()), ("frame_bytes", pa.int64()),
        ("record_type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()),
        ("refers_to", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
        ("payload", pa.binary()),
    ])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            for name, data in zip(column(batch, "name"), column(batch, "content")):
                rows, held = [], 0
                for offset, size, content in frames(data):
                    try:
                        got = parse(content)
                    except ValueError as error:
                        raise ValueError(f"{name}, record at {offset}: {error}") from error
                    fields = got["fields"]
                    rows.append({
                        "archive": name, "offset": offset, "frame_bytes": size,
                        "record_type": got["record_type"], "record_id": fields["warc-record-id"],
                        "target_uri": fields.get("warc-target-uri"),
                        "refers_to": fields.get("warc-refers-to"),
                        "payload_digest": got.get("payload_digest"),
                        "payload_bytes": got.get("payload_bytes"),
                        "payload": got.get("payload") if payloads else None,
                    })
                    held += len(content)
                    if held >= 4 << 20:
                        yield pa.RecordBatch.from_pylist(rows, schema=schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return named.mapInArrow(work, RECORDS)


def digests(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """Per page, as read back: payload length and digest, kind of record, and the page it refers to."""
    page = lambda name: F.regexp_extract(name, r"^<urn:page:(-?\d+)>$", 1)
    number = lambda name: F.when(page(name) != "", page(name)).cast("long")
    names = manifest.select(F.col("name").alias("archive"))
    return records.join(names, "archive", "left_semi").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        number("refers_to").alias("refers_to"),
    )
