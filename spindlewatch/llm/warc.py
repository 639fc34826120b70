"""WARC archives: a writer, a normaliser of monolithic gzip files and a reader by offset index.

Spark's text writer puts the records of a file into one gzip stream, so a record
can only be reached by inflating all before it. The normaliser inflates each such
stream once, rewrites every record as a gzip member of its own and gives the
offset of each, with which single records are read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spindlewatch.llm.common import keep, plain_uri, query, table
from spindlewatch.storage import scratch_folder

RECORDS_A_FILE = 5_000
READ_BYTES = 1 << 20
INDEX = "archive string, offset long, length long, record_id string, record_type string"


def write_archives(pages: DataFrame, uri: str) -> None:
    """One record per row, in monolithic gzip files of at most ``RECORDS_A_FILE`` records below ``uri``.

    Of equal payloads (the html in UTF-8, null is empty) the row with the smallest
    id is a response, the others are revisits without payload. Rows with a null
    id are left out. A row that is repeated whole gives a record each time, and its
    id is a response in each if it is the smallest. Rows with one id and different
    payloads are different pages: a record is told by its id and digest together. Payloads are compared by SHA-1 and size. Only ids and digests are
    shuffled for that, and then the pages once, by id.
    """
    rows = pages.where("page_id is not null").select(
        F.col("page_id").cast("long").alias("page_id"), F.coalesce("html", F.lit("")).alias("html"), F.coalesce("url", F.lit("")).alias("url")
    )
    payload = F.col("html").cast("binary")
    digests = keep(rows.select("page_id", F.sha1(payload).alias("sha"), F.octet_length("html").alias("bytes")), "digests")
    first = keep(digests.groupBy("sha", "bytes").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n")).where("n > 1"), "first")
    again = digests.join(first, ["sha", "bytes"]).where("page_id <> first_id").select("page_id", "sha", "bytes", "first_id").distinct()
    joined = rows.withColumns({"sha": F.sha1(payload), "bytes": F.octet_length("html")}).join(again, ["page_id", "sha", "bytes"], "left")
    digest = _base32("sha")
    is_response = F.col("first_id").isNull()
    line = lambda name, value: F.concat(F.lit(name + ": "), value, F.lit("\r\n"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(is_response, "response").otherwise("revisit")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:page:"), F.col("page_id").cast("string"), F.lit(">"))),
        line("WARC-Target-URI", F.regexp_replace("url", r"[\x00-\x20\x7f]", "")),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(is_response, "").otherwise(
            F.concat(
                line("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">"))),
                line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
            )
        ),
        line("Content-Length", F.when(is_response, F.octet_length("html")).otherwise(0).cast("string")),
        F.lit("\r\n"),
    )
    # The writer adds the line feed that ends the record.
    record = F.concat(head, F.when(is_response, F.col("html")).otherwise(""), F.lit("\r\n\r"))
    joined.select(record.alias("value")).write.option("compression", "gzip").option("lineSep", "\n").option(
        "maxRecordsPerFile", RECORDS_A_FILE
    ).text(uri)


def _base32(sha: str):
    """RFC 4648 base 32 of 20 bytes given as hex: 32 digits of 5 bits."""
    bits = F.concat(*[F.lpad(F.conv(F.substring(sha, i, 10), 16, 2), 40, "0") for i in (1, 11, 21, 31)])
    alphabet = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(*[F.substring(alphabet, F.conv(F.substring(bits, 5 * i + 1, 5), 2, 10).cast("int") + 1, F.lit(1)) for i in range(32)])


@dataclass
class Record:
    headers: dict[str, str]
    raw: bytes
    payload: bytes


class RecordParser:
    """Takes bytes of a WARC stream as they come and gives whole records."""

    def __init__(self):
        self.held = bytearray()
        self.need: tuple[int, dict[str, str], int] | None = None

    def feed(self, data: bytes) -> Iterator[Record]:
        self.held += data
        while True:
            if self.need is None:
                end = self.held.find(b"\r\n\r\n")
                if end < 0:
                    return
                head = bytes(self.held[:end]).decode("utf-8", "replace").split("\r\n")
                headers = {k.strip().lower(): v.strip() for k, _, v in (h.partition(":") for h in head[1:])}
                size = int(headers["content-length"])
                self.need = (end + 4, headers, size)
            start, headers, size = self.need
            if len(self.held) < start + size + 4:
                return
            whole = bytes(self.held[: start + size + 4])
            if whole[-4:] != b"\r\n\r\n":
                raise ValueError("record doesn't end where its length says")
            del self.held[: start + size + 4]
            self.need = None
            yield Record(headers, whole, whole[start : start + size])


def inflated(stream) -> Iterator[bytes]:
    """The content of a gzip stream of one or more members, in pieces."""
    engine = zlib.decompressobj(31)
    while data := stream.read(READ_BYTES):
        while data:
            yield engine.decompress(data)
            data = engine.unused_data
            if engine.eof:
                engine = zlib.decompressobj(31)


def deflated(data: bytes) -> bytes:
    engine = zlib.compressobj(6, zlib.DEFLATED, 31)
    return engine.compress(data) + engine.flush()


def normalise(spark: SparkSession, source: str, target: str) -> DataFrame:
    """Rewrites the archives below ``source`` to ``target``; returns the sidecar index, kept there as a table.

    Every attempt writes a file of its own name, and the index names those of the
    attempts that succeeded: a lost executor leaves at most a file that nothing
    refers to. A task holds one record and a buffer.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(source).select("path")
    paths = [r.path for r in files.collect()]  # names of files, RECORDS_A_FILE records each

    def run(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                reader, name = fs.FileSystem.from_uri(plain_uri(path))
                writer, folder = fs.FileSystem.from_uri(plain_uri(target))
                archive = f"{folder.rstrip('/')}/{uuid.uuid4().hex}.warc.gz"
                rows, at, parser = [], 0, RecordParser()
                with reader.open_input_stream(name, compression=None) as stream, writer.open_output_stream(archive, compression=None) as out:
                    for data in inflated(stream):
                        for record in parser.feed(data):
                            member = deflated(record.raw)
                            out.write(member)
                            rows.append((archive.rpartition("/")[2], at, len(member), record.headers["warc-record-id"], record.headers["warc-type"]))
                            at += len(member)
                if parser.held:
                    raise ValueError(f"{path} ends within a record")
                if rows:
                    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["archive", "offset", "length", "record_id", "record_type"])

    folder_system, folder_name = fs.FileSystem.from_uri(plain_uri(target))
    folder_system.create_dir(folder_name, recursive=True)
    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(max(1, len(paths)))
    index = listed.mapInArrow(run, INDEX)
    index.write.parquet(f"{target.rstrip('/')}/index")
    return spark.read.schema(INDEX).parquet(f"{target.rstrip('/')}/index")


def read_records(index: DataFrame, target: str) -> DataFrame:
    """(page_id, record_type, refers_to, payload_digest, payload_bytes, payload) of each indexed record, by its offset.

    The digest and size of a response are those of the payload that was read, and
    the digest has to agree with the record's header. A revisit has no payload;
    its size is null here.
    """

    def run(batches):
        system, folder = fs.FileSystem.from_uri(plain_uri(target))
        for batch in batches:
            rows = []
            ordered = sorted(zip(*(batch.column(c).to_pylist() for c in ("archive", "offset", "length"))))
            name, handle = None, None
            for archive, offset, length in ordered:
                if archive != name:
                    if handle:
                        handle.close()
                    name, handle = archive, system.open_input_file(f"{folder.rstrip('/')}/{archive}")
                handle.seek(offset)
                (record,) = RecordParser().feed(zlib.decompress(handle.read(length), 31))
                head = record.headers
                said = head["warc-payload-digest"].removeprefix("sha1:")
                response = head["warc-type"] == "response"
                if response and base64.b32encode(hashlib.sha1(record.payload).digest()).decode() != said:
                    raise ValueError(f"{archive} at {offset}: payload differs from its digest")
                refers = _page(head["warc-refers-to"]) if "warc-refers-to" in head else None
                rows.append((_page(head["warc-record-id"]), head["warc-type"], refers, said, len(record.payload) if response else None, record.payload if response else None))
            if handle:
                handle.close()
            if rows:
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary())
                names = ["page_id", "record_type", "refers_to", "payload_digest", "payload_bytes", "payload"]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return index.mapInArrow(run, "page_id long, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary")


def _page(urn: str) -> int:
    return int(urn.strip("<>").rpartition(":")[2])


@query
def op4_warc_normaliser(spark, sf_dir):
    whole, normal = scratch_folder(spark, "warc-whole"), scratch_folder(spark, "warc")
    write_archives(table(spark, sf_dir, "pages"), whole)
    index = normalise(spark, whole, normal)
    read = keep(read_records(index, normal).drop("payload"), "records")
    # A revisit's size is that of the response it refers to.
    sizes = read.where("record_type = 'response'").select(
        F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("of_response")
    )
    revisits = read.where("record_type = 'revisit'").join(sizes.distinct(), ["refers_to", "payload_digest"], "left").withColumn("payload_bytes", F.col("of_response"))
    columns = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return read.where("record_type = 'response'").select(*columns).unionByName(revisits.select(*columns))
