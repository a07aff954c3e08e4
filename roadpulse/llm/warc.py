"""WARC archives: written whole-file compressed, normalised to one gzip member per record, read back.

`write_archives` lets Spark's text writer produce archives that are single gzip streams.
`normalise` inflates each such stream once, in pieces, writes every record as a member of its own
and a sidecar index of offsets. `read_records` then seeks to single members through the index.

Rows: a null `html` is an empty payload. Of records with equal payloads of at least
`REVISIT_BYTES` bytes the one with the largest page_id is the response and the others are revisits
that refer to it; repeated rows with that page_id are all responses. A null page_id is the smallest;
if a payload has null page_ids only, all are responses. Smaller payloads are all responses. Line
ends in a URL become spaces. An empty table gives no archive and no record.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadpulse.session import materialise, shared_folder

REVISIT_BYTES = 1000
_CHUNK = 1 << 20
_END = "\r\n\r\n"
_HTTP = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8{_END}"
INDEX = "archive string, ordinal long, offset long, length long, record_id string, record_type string"
RECORD = ("page_id long, url string, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long, payload binary")


def label_records(pages: DataFrame) -> DataFrame:
    """page_id, url, payload and its size and SHA-1, record type, and the page that a revisit refers to."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("payload_bytes"),
        F.sha1(payload.cast("binary")).alias("payload_digest"))
    # Only payloads that occur more than once reach the join; counts are combined map-side.
    shared = (
        rows.filter(F.col("payload_bytes") >= REVISIT_BYTES)
        .groupBy("payload_digest").agg(F.count("*").alias("n"), F.max("page_id").alias("first"))
        .filter("n > 1").select("payload_digest", "first"))
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return rows.join(shared, "payload_digest", "left").select(
        "page_id", "url", "payload", "payload_bytes", "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"))


def write_archives(records: DataFrame, folder: str) -> None:
    """One archive per partition, each a single gzip stream over all its records."""
    block = F.concat(F.lit(_HTTP), F.when(F.col("record_type") == "response", F.col("payload")).otherwise(""))

    def header(name: str, value) -> F.Column:
        return F.when(value.isNotNull(), F.concat(F.lit(f"\r\n{name}: "), value)).otherwise("")

    def urn(column: str):
        return F.concat(F.lit("<urn:page:"), F.col(column).cast("string"), F.lit(">"))

    record = F.concat(
        F.lit("WARC/1.1"),
        header("WARC-Type", F.col("record_type")),
        header("WARC-Record-ID", F.coalesce(urn("page_id"), F.lit("<urn:page:>"))),
        header("WARC-Target-URI", F.regexp_replace("url", r"[\r\n]", " ")),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        header("WARC-Refers-To", urn("refers_to")),
        header("X-Payload-Length", F.col("payload_bytes").cast("string")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(_END), block)
    (records.select(record.alias("value")).write
     .option("compression", "gzip").option("lineSep", _END).text(folder))


def open_path(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system that a path of Spark's belongs to, as tasks can reach it."""
    if uri.startswith(("file:", "/")):
        return fs.LocalFileSystem(), re.sub("^file:/+", "/", uri)
    return fs.FileSystem.from_uri(uri)


class Inflated:
    """Reads a gzip file piece by piece; several members in a row are one stream."""

    def __init__(self, source) -> None:
        self.source, self.buffer, self.inflate = source, bytearray(), zlib.decompressobj(31)

    def fill(self) -> bool:
        data = self.inflate.unused_data if self.inflate.eof else b""
        if self.inflate.eof:
            self.inflate = zlib.decompressobj(31)
        data = data or self.inflate.unconsumed_tail or self.source.read(_CHUNK)
        if data:
            self.buffer += self.inflate.decompress(data, _CHUNK)
        return bool(data)

    def until(self, mark: bytes) -> bytes:
        """The bytes up to and with `mark`; empty at the end of the file."""
        start = 0
        while (at := self.buffer.find(mark, start)) < 0:
            start = max(0, len(self.buffer) - len(mark) + 1)
            if not self.fill():
                if self.buffer.strip():
                    raise ValueError("the archive ends inside a record's header")
                return b""
        return self.take(at + len(mark))

    def take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def pieces(self, n: int) -> Iterator[bytes]:
        while n:
            if not self.buffer and not self.fill():
                raise ValueError("the archive ends inside a record")
            piece = self.take(min(n, len(self.buffer), _CHUNK))
            n -= len(piece)
            yield piece


def fields_of(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    return dict(line.split(": ", 1) for line in lines[1:] if ": " in line)


def rewrite(source: str, target: str) -> list[tuple]:
    """Rewrite one archive; both files appear under their names only when they are complete."""
    system, path = open_path(source)
    out_system, out = open_path(target)
    draft, index, offset = f"{out}.{uuid.uuid4().hex}", [], 0
    with system.open_input_stream(path, compression=None) as raw, out_system.open_output_stream(
            draft, compression=None) as sink:
        stream = Inflated(raw)
        while header := stream.until(_END.encode()):
            fields = fields_of(header)
            member, begin = zlib.compressobj(6, zlib.DEFLATED, 31), offset
            offset += sink.write(member.compress(header)) or 0
            for piece in stream.pieces(int(fields["Content-Length"]) + len(_END)):
                offset += sink.write(member.compress(piece)) or 0
            offset += sink.write(member.flush()) or 0
            index.append((target, len(index), begin, offset - begin, fields["WARC-Record-ID"], fields["WARC-Type"]))
    out_system.move(draft, out)
    with out_system.open_output_stream(f"{draft}.idx", compression=None) as sidecar:
        for _, _, begin, length, record, kind in index:
            sidecar.write(f"{begin} {length} {record} {kind}\n".encode())
    out_system.move(f"{draft}.idx", f"{out}.idx")
    return index


def normalise(spark: SparkSession, folder: str, target: str) -> DataFrame:
    """Rewrite every archive of `folder` into `target`; returns the rows of all sidecar indexes.

    A task holds a few pieces of one archive at a time. A task that runs again writes the same
    bytes under the same names.
    """
    system, path = open_path(target)
    system.create_dir(path, recursive=True)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder)
             .select("path"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [field.split()[0] for field in INDEX.split(", ")]
        for batch in batches:
            for source in batch["path"]:
                name = source.rsplit("/", 1)[1].removesuffix(".txt.gz")
                yield pd.DataFrame(rewrite(source, f"{target}/{name}.warc.gz"), columns=names)

    return materialise(files.mapInPandas(run, INDEX))


def read_member(data: bytes) -> tuple:
    """One record from its own member: the columns of `RECORD`."""
    header, _, block = zlib.decompress(data, 31).partition(_END.encode())
    fields = fields_of(header)
    number = lambda name: int(n[1]) if (n := re.search(r":(-?\d+)>", fields.get(name, ""))) else None
    payload = None
    if fields["WARC-Type"] == "response":
        payload = block[len(_HTTP.encode()):int(fields["Content-Length"])]
        size, digest = len(payload), hashlib.sha1(payload).hexdigest()
        if digest != fields["WARC-Payload-Digest"].removeprefix("sha1:"):
            raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    else:
        size, digest = int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha1:")
    return (number("WARC-Record-ID"), fields.get("WARC-Target-URI"), size, digest,
            fields["WARC-Type"], number("WARC-Refers-To"), payload)


def read_records(index: DataFrame) -> DataFrame:
    """The records that the index points at, each read by one seek."""
    names = [field.split()[0] for field in RECORD.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for archive, rows in batch.groupby("archive", sort=False):
                system, path = open_path(archive)
                with system.open_input_file(path) as source:
                    found = []
                    for offset, length in zip(rows["offset"], rows["length"]):
                        source.seek(offset)
                        found.append(read_member(source.read(length)))
                out = pd.DataFrame(found, columns=names, dtype=object)
                for name in ("page_id", "payload_bytes", "refers_to"):
                    out[name] = out[name].astype("Int64")
                yield out

    return index.mapInPandas(run, RECORD)


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write `pages` as archives in the shared folder, normalise them and read all records back."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    write_archives(label_records(pages), f"{folder}/monolithic")
    return read_records(normalise(spark, f"{folder}/monolithic", f"{folder}/members"))
