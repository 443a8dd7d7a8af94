"""Web archives: from one gzip stream a file to one gzip member a record, with an index of offsets.

A file compressed as a whole can only be read from its start. The normaliser inflates such a stream
once, in chunks, compresses every record as a member of its own, and writes a sidecar of offsets, by which
records are read alone and in any order. Files are worked on side by side; a record of any size passes
through in chunks. A file appears under its name when it is complete, so that a lost task is simply run again.
"""

from __future__ import annotations

import hashlib
import io
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from typing import BinaryIO

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandfold.llm.common import new_folder, stored

CHUNK = 1 << 20
#: Payloads below this size are stored again rather than referred to.
LEAST_SHARED = 100
END = b"\r\n\r\n"
INDEX = "file string, offset long, length long, record_id string, record_type string"


def located(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI as Spark writes it."""
    return fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", re.sub("^s3[an]:", "s3:", uri)))


class Inflated(io.RawIOBase):
    """The content of a gzip stream of one or more members, inflated as it is read."""

    def __init__(self, source: BinaryIO, name: str):
        self.source, self.name, self.pending = source, name, b""
        self.stream, self.begun = zlib.decompressobj(31), False

    def readable(self) -> bool:
        return True

    def readinto(self, target: memoryview) -> int:
        while True:
            if self.stream.eof:
                self.pending = self.stream.unused_data or self.pending
                self.pending = self.pending or self.source.read(CHUNK)
                if not self.pending:
                    return 0
                self.stream = zlib.decompressobj(31)
            data = self.pending or self.source.read(CHUNK)
            self.begun = self.begun or bool(data)
            try:
                out = self.stream.decompress(data, len(target))
            except zlib.error as problem:
                raise ValueError(f"{self.name}: not a gzip stream: {problem}") from problem
            self.pending = self.stream.unconsumed_tail
            if out:
                target[:len(out)] = out
                return len(out)
            if not data:
                if self.stream.eof:
                    continue
                if not self.begun:
                    return 0
                raise ValueError(f"{self.name}: the gzip stream ends too early")


def header(source: BinaryIO, name: str) -> tuple[bytes, dict[str, str]] | None:
    """The header block of the next record and its fields; None at the end. Empty lines before it are skipped."""
    line = source.readline()
    while line in (b"\r\n", b"\n"):
        line = source.readline()
    if not line:
        return None
    if not line.startswith(b"WARC/"):
        raise ValueError(f"{name}: no record where one should start: {line[:60]!r}")
    lines, fields = [line], {}
    while (line := source.readline()) not in (b"\r\n", b"\n"):
        if not line:
            raise ValueError(f"{name}: a record header ends too early")
        lines.append(line)
        key, _, value = line.decode("utf-8", "replace").partition(":")
        fields[key.strip().lower()] = value.strip()
    if not fields.get("content-length", "").isdigit():
        raise ValueError(f"{name}: a record has no valid Content-Length")
    return b"".join(lines) + b"\r\n", fields


def body(source: BinaryIO, length: int, name: str) -> Iterator[bytes]:
    while length:
        data = source.read(min(length, CHUNK))
        if not data:
            raise ValueError(f"{name}: a record ends too early")
        length -= len(data)
        yield data


def rewrite(source: str, target: str) -> list[tuple[str, int, int, str, str]]:
    """One file: a member per record and the sidecar ``target`` + ".idx" of JSON lines; returns the index."""
    store, path = located(source)
    out_store, out_path = located(target)
    draft, index, offset = f"{out_path}.{uuid.uuid4().hex}.tmp", [], 0
    with store.open_input_stream(path, compression=None) as raw, out_store.open_output_stream(draft, compression=None) as out:
        stream = io.BufferedReader(Inflated(raw, source), CHUNK)
        while found := header(stream, source):
            block, fields = found
            member, size = zlib.compressobj(6, zlib.DEFLATED, 31), 0
            size += out.write(member.compress(block))
            for data in body(stream, int(fields["content-length"]), source):
                size += out.write(member.compress(data))
            size += out.write(member.compress(END) + member.flush())
            index.append((target, offset, size, fields.get("warc-record-id", ""), fields.get("warc-type", "")))
            offset += size
    with out_store.open_output_stream(f"{draft}.idx", compression=None) as out:
        out.write("".join(json.dumps(dict(zip(("file", "offset", "length", "record_id", "record_type"), row))) + "\n" for row in index).encode())
    out_store.move(f"{draft}.idx", f"{out_path}.idx")
    out_store.move(draft, out_path)
    return index


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrite all ``*.gz`` files of a folder; returns the index (file, offset, length, record_id, record_type).

    Both folders are URIs that executors reach. A damaged file is an error that names it; a folder or file without
    records gives none. The index is written while the files are, and read from then on.
    """
    spark.createDataFrame([], "x int").write.mode("ignore").parquet(f"{target}/_made")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path in pdf["path"]:
                name = re.sub(r"(\.txt|\.warc)?\.gz$", "", path.rpartition("/")[2])
                yield pd.DataFrame(rewrite(path, f"{target}/{name}.warc.gz"), columns=["file", "offset", "length", "record_id", "record_type"])

    return stored(files.mapInPandas(run, INDEX), "warc-index")


def read(index: DataFrame) -> DataFrame:
    """The records of an index, each from its own member.

    (record_id, record_type, target_uri, refers_to, payload, payload_bytes, payload_digest): of a revisit the payload
    is null, and its size and digest are those in its header; otherwise they are taken from what was read.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        name, source = None, None
        for pdf in batches:
            rows = []
            for row in pdf.itertuples(index=False):
                if row.file != name:
                    store, path = located(row.file)
                    name, source = row.file, store.open_input_file(path)
                source.seek(row.offset)
                stream = io.BufferedReader(io.BytesIO(zlib.decompress(source.read(row.length), 31)))
                _, fields = header(stream, name)
                content = b"".join(body(stream, int(fields["content-length"]), name)).partition(END)[2]
                common = (fields.get("warc-record-id"), row.record_type, fields.get("warc-target-uri"), fields.get("warc-refers-to"))
                if row.record_type == "revisit":
                    rows.append((*common, None, int(fields["x-payload-length"]), fields["warc-payload-digest"].rpartition(":")[2]))
                else:
                    rows.append((*common, content, len(content), hashlib.sha256(content).hexdigest()))
            yield pd.DataFrame(rows, columns=["record_id", "record_type", "target_uri", "refers_to", "payload", "payload_bytes", "payload_digest"])

    schema = "record_id string, record_type string, target_uri string, refers_to string, payload binary, payload_bytes long, payload_digest string"
    return index.mapInPandas(run, schema)


def _urn(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def records(pages: DataFrame) -> DataFrame:
    """One column, ``record``: a WARC record of each page, without the two line ends that follow it.

    Of equal payloads of at least LEAST_SHARED bytes those with the smallest page_id are responses (several, if rows
    repeat that page_id), the others revisit it. A null html is an empty payload. A null
    page_id is never referred to. Line breaks in a URL are escaped.
    """
    html = F.coalesce(F.col("html"), F.lit(""))
    rows = pages.select("page_id", F.regexp_replace(F.coalesce("url", F.lit("")), r"[\r\n]", "%0A").alias("url"), html.alias("html"), F.octet_length(html).alias("size"), F.sha2(html.cast("binary"), 256).alias("digest"))
    shared = rows.where(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.min("page_id").alias("first_id"), F.count(F.lit(1)).alias("n")).where("n > 1 and first_id is not null")
    shared = stored(shared.select("digest", "first_id"), "shared-payloads")
    rows = rows.join(shared, "digest", "left")
    again = F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "), F.col("size").cast("string"), F.lit("\r\n\r\n"))
    block = F.when(again, http).otherwise(F.concat(http, "html"))
    rows = rows.select("*", again.alias("again"), block.alias("block"))
    return rows.select(F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: "), F.when(F.col("again"), "revisit").otherwise("response"),
        F.lit("\r\nWARC-Record-ID: "), _urn(F.col("page_id")), F.lit("\r\nWARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: "), "url",
        F.lit("\r\nWARC-Payload-Digest: sha256:"), "digest", F.lit("\r\nX-Payload-Length: "), F.col("size").cast("string"),
        F.when(F.col("again"), F.concat(F.lit("\r\nWARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest\r\nWARC-Refers-To: "), _urn(F.col("first_id")))).otherwise(""),
        F.lit("\r\nContent-Type: application/http;msgtype=response\r\nContent-Length: "), F.octet_length("block").cast("string"), F.lit("\r\n\r\n"), "block",
    ).alias("record"))


def archive(pages: DataFrame, target: str) -> DataFrame:
    """Write the pages as archives that are one gzip stream a file, rewrite those into ``target``, return the index."""
    spark = pages.sparkSession
    whole = new_folder(spark, "warc-whole")
    records(pages).write.option("lineSep", END.decode()).option("compression", "gzip").text(whole)
    return normalise(spark, whole, target)


def digest(found: DataFrame) -> DataFrame:
    """The columns of the registered query."""
    number = lambda urn: F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("")).cast("long")
    return found.select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"),
    )
