"""WARC archives with an index that is written first and read by.

Pages become WARC records, each a gzip member of its own, in archives of bounded size. Pages with
equal payloads are stored once: the page with the smallest id is the response, the others are
revisits that name it. Writing a record gives its index row: archive, offset, length, URL and
digest. Readers start from the index: they select rows, sort them by place, merge neighbouring byte
ranges into one read each, and parse the records found there.

Scale. Payloads are never shuffled while the table of repeated payloads is small enough to
broadcast, and a hot payload is salted otherwise. Tasks write and read archives through
``pyarrow.fs``, so the folder must be one that all executors share and Arrow can open (file, hdfs,
s3, gs). The index is stored once; archives of attempts that were lost are in no index.

Defined results: a null page is empty and a record of its own; payloads under ``MIN_SHARED`` bytes
are never shared; rows with the smallest id of their payload are all responses; a null id is larger
than all others; line breaks in a URL are escaped in the archive. An empty table writes no archive.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolag.llm.common import stored
from aerolag.operators.joins import lookup_join

# Payloads of fewer bytes are stored as often as they occur.
MIN_SHARED = 100
# Bytes after which a task begins another archive.
ARCHIVE_BYTES = 64 << 20
# Ranges closer than this are read together, up to the size of one read.
GAP = 64 << 10
READ_BYTES = 8 << 20

DATE = "1970-01-01T00:00:00Z"
_END = b"\r\n\r\n"
_MADE = ["file", "offset", "length", "digest", "payload_bytes", "refers_to"]


def record(page: object, url: str | None, payload: bytes, digest: str, refers_to: object) -> bytes:
    """One WARC record. A revisit keeps the HTTP header, which tells its length, but no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}"
    block = http.encode() + _END + (b"" if revisit else payload)
    target = (url or "").replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {target}",
        f"WARC-Payload-Digest: sha256:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if revisit:
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"WARC-Refers-To: <urn:page:{refers_to}>")
    return "\r\n".join(lines).encode() + _END + block + _END


def _headers(block: bytes) -> tuple[dict[str, str], bytes]:
    head, _, rest = block.partition(_END)
    lines = head.decode("utf-8").split("\r\n")[1:]
    return dict(line.split(": ", 1) for line in lines), rest


def parsed(found: bytes) -> dict:
    """What a record says of itself; the digest and length of a payload are taken from the payload."""
    warc, rest = _headers(found)
    http, payload = _headers(rest[: int(warc["Content-Length"])])
    revisit = warc["WARC-Type"] == "revisit"
    return {
        "record_type": warc["WARC-Type"],
        "refers_to": warc["WARC-Refers-To"][len("<urn:page:") : -1] if revisit else None,
        "payload_bytes": int(http["Content-Length"]) if revisit else len(payload),
        "payload_digest": warc["WARC-Payload-Digest"].removeprefix("sha256:")
        if revisit
        else hashlib.sha256(payload).hexdigest(),
        "payload": None if revisit else payload,
    }


class _Writer:
    """Archives of one task."""

    def __init__(self, folder: str) -> None:
        self.store, self.path = fs.FileSystem.from_uri(folder)
        self.store.create_dir(self.path, recursive=True)
        self.out, self.name, self.offset = None, "", 0

    def write(self, data: bytes) -> tuple[str, int, int]:
        """Archive, offset and length of the record just written."""
        if self.out is None or self.offset > ARCHIVE_BYTES:
            self.close()
            self.name, self.offset = f"{uuid.uuid4().hex}.warc.gz", 0
            self.out = self.store.open_output_stream(f"{self.path}/{self.name}", compression=None)
        packer = zlib.compressobj(6, zlib.DEFLATED, 31)
        member = packer.compress(data) + packer.flush()
        self.out.write(member)
        place = self.name, self.offset, len(member)
        self.offset += len(member)
        return place

    def close(self) -> None:
        if self.out is not None:
            self.out.close()


def _written(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer = None
        for batch in batches:
            rows = []
            for page, url, payload, digest, first in zip(*(c.to_pylist() for c in batch.columns)):
                writer = writer or _Writer(folder)
                refers_to = None if first is None or first == page else first
                place = writer.write(record(page, url, payload, digest, refers_to))
                rows.append((*place, digest, len(payload), refers_to))
            columns = list(zip(*rows)) or [()] * len(_MADE)
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), batch.schema.types[0]]
            made = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *made], ["page", "url", *_MADE]
            )
        if writer is not None:
            writer.close()

    return run


def write_archives(
    pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Write every page to an archive in ``folder``; gives the index, stored."""
    payload = F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary")
    chosen = pages.select(
        F.col(f"`{id}`").alias("page"), F.col(f"`{url}`").alias("url"), payload.alias("payload")
    ).withColumn("digest", F.sha2("payload", 256))
    repeated = stored(
        chosen.where(F.octet_length("payload") >= MIN_SHARED)
        .groupBy("digest")
        .agg(F.min("page").alias("first"), F.count("*").alias("n"))
        .where(F.col("n") > 1)
        .select("digest", "first")
    )
    linked = lookup_join(chosen, repeated, ["digest"], "left")
    page = chosen.schema["page"].dataType
    schema = T.StructType(
        [
            T.StructField("page", page),
            T.StructField("url", T.StringType()),
            T.StructField("file", T.StringType()),
            T.StructField("offset", T.LongType()),
            T.StructField("length", T.LongType()),
            T.StructField("digest", T.StringType()),
            T.StructField("payload_bytes", T.LongType()),
            T.StructField("refers_to", page),
        ]
    )
    ordered = linked.select("page", "url", "payload", "digest", "first")
    return stored(ordered.mapInArrow(_written(folder), schema))


def merged_ranges(places: list[tuple[int, int]]) -> Iterator[list[int]]:
    """Positions in ``places``, sorted (offset, length) pairs, in groups to be read at once."""
    group: list[int] = []
    for i, (offset, length) in enumerate(places):
        if group:
            begin, last = places[group[0]][0], places[group[-1]]
            if offset - sum(last) > GAP or offset + length - begin > READ_BYTES:
                yield group
                group = []
        group.append(i)
    if group:
        yield group


def _read(folder: str, with_payload: bool):
    names = ["payload_bytes", "payload_digest", "record_type", "refers_to"]
    names += ["payload"] * with_payload

    def records(store, path: str, places: list[tuple[int, int]]) -> Iterator[tuple]:
        with store.open_input_file(path) as file:
            for group in merged_ranges(places):
                begin = places[group[0]][0]
                data = file.read_at(sum(places[group[-1]]) - begin, begin)
                for i in group:
                    at = places[i][0] - begin
                    found = parsed(zlib.decompress(data[at : at + places[i][1]], 31))
                    yield tuple(found[name] for name in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = fs.FileSystem.from_uri(folder)
        for batch in batches:
            files, offsets, lengths = (batch.column(i).to_pylist() for i in (2, 3, 4))
            kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.binary()]

            def made(rows: list[tuple], begin: int) -> pa.RecordBatch:
                columns = list(zip(*rows)) or [()] * len(names)
                new = [pa.array(column, kind) for column, kind in zip(columns, kinds)]
                old = [batch.column(i).slice(begin, len(rows)) for i in (0, 1)]
                return pa.RecordBatch.from_arrays([*old, *new], ["page", "url", *names])

            rows, sent, held, at = [], 0, 0, 0
            while at < len(files):
                end = at
                while end < len(files) and files[end] == files[at]:
                    end += 1
                places = list(zip(offsets[at:end], lengths[at:end]))
                for row in records(store, f"{path}/{files[at]}", places):
                    rows.append(row)
                    held += len(row[-1] or b"") if with_payload else 0
                    if held >= READ_BYTES:
                        yield made(rows, sent)
                        rows, sent, held = [], sent + len(rows), 0
                at = end
            yield made(rows, sent)

    return run


def read_records(index: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """The records of the index rows given, which may be any selection of an index."""
    page = index.schema["page"].dataType
    fields = [T.StructField("page", page), T.StructField("url", T.StringType())]
    fields.append(T.StructField("payload_bytes", T.LongType()))
    fields += [T.StructField(n, T.StringType()) for n in ("payload_digest", "record_type", "refers_to")]
    if with_payload:
        fields.append(T.StructField("payload", T.BinaryType()))
    # Ranges of (file, offset): each task reads neighbouring bytes.
    ranged = index.select("page", "url", "file", "offset", "length").repartitionByRange("file", "offset")
    return (
        ranged.sortWithinPartitions("file", "offset")
        .mapInArrow(_read(folder, with_payload), T.StructType(fields))
        .withColumn("refers_to", F.col("refers_to").cast(page))
    )
