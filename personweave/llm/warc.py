"""WARC archives: writing, reading, and resolution of revisits.

An archive is a folder of gzip-compressed WARC 1.1 files that Spark writes and reads, so it can lie in any store that
Spark reaches. Payloads are never shuffled by digest: only headers are. The decisions about repeated payloads, one row
per repeat, are then joined to the payloads, and records are written with fresh headers.
"""

from __future__ import annotations

import gzip
import hashlib
import io
from base64 import b32encode
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from personweave.sources.scratch import scratch_table

END = "\r\n"
# The WARC version and the profile that names a revisit by digest.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_FILE = 10_000
RECORD = ("record_id string, record_type string, page_id long, url string, payload_digest string, payload_bytes long, "
          "refers_to_id string")


def base32_sha1(data: Column) -> Column:
    """Upper-case base32 of the SHA-1: every five hex digits are four base32 digits."""
    digest = F.sha1(data)
    parts = [F.lpad(F.conv(F.substring(digest, 5 * i + 1, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.upper(F.concat(*parts)), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def record_id(page_id: Column, digest: Column) -> Column:
    """A name-based record id, the same whenever a task is run again."""
    h = F.md5(F.concat_ws("/", F.coalesce(page_id.cast("string"), F.lit("")), digest))
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]),
                    F.lit(">"))


def captures(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Response records of pages: `page_id`, `url`, `payload`, `payload_bytes`, `payload_digest`. A null payload is empty."""
    payload = F.coalesce(pages[f"`{html_col}`"].cast("string"), F.lit(""))
    return (pages.select(pages[f"`{id_col}`"].cast("long").alias("page_id"), pages[f"`{url_col}`"].cast("string").alias("url"),
                         payload.alias("payload"))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long"))
            .withColumn("payload_digest", base32_sha1(F.col("payload"))))


def revisits(headers: DataFrame, least_bytes: int = 0) -> DataFrame:
    """`page_id`, `payload_digest`, `refers_to` of every record that repeats the payload of a smaller page id.

    Only headers are shuffled, and minima are taken before the shuffle, so a payload that a third of all pages share is
    one row per task. Payloads below `least_bytes` are never revisits.
    """
    headers = headers.where(F.col("payload_bytes") >= least_bytes).select("page_id", "payload_digest", "payload_bytes")
    first = (headers.groupBy("payload_digest", "payload_bytes").agg(F.min("page_id").alias("refers_to"), F.count("*").alias("n"))
             .where(F.col("n") > 1).drop("n"))
    return (headers.join(first, ["payload_digest", "payload_bytes"])
            .where(F.col("page_id") > F.col("refers_to")).select("page_id", "payload_digest", "refers_to").distinct())


def deduplicated(records: DataFrame, least_bytes: int = 0) -> DataFrame:
    """The records with `record_type` and `refers_to`: repeats become revisits without a payload."""
    repeats = scratch_table(revisits(records, least_bytes), "revisits")
    repeat = F.col("refers_to").isNotNull()
    return (records.join(repeats, ["page_id", "payload_digest"], "left")
            .withColumn("record_type", F.when(repeat, "revisit").otherwise("response"))
            .withColumn("payload", F.when(~repeat, F.col("payload"))))


def write_warc(records: DataFrame, path: str, date: str = "2025-01-01T00:00:00Z", records_per_file: int = RECORDS_PER_FILE) -> None:
    """Write the records of `deduplicated` as WARC files with fresh headers.

    The text writer ends each record with the two line ends that the format asks for. A file has at most
    `records_per_file` records and never more than one input partition.
    """
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=UTF-8{END}Content-Length: "),
                    F.col("payload_bytes").cast("string"), F.lit(END + END))
    block_bytes = F.octet_length(http) + F.coalesce(F.octet_length("payload"), F.lit(0))

    def field(name: str, value: Column) -> Column:
        return F.coalesce(F.concat(F.lit(f"{name}: "), F.regexp_replace(value.cast("string"), r"[\r\n]+", " "), F.lit(END)), F.lit(""))

    digest = F.col("payload_digest")
    header = F.concat(
        F.lit(f"{VERSION}{END}WARC-Type: "), F.col("record_type"), F.lit(END),
        field("WARC-Record-ID", record_id(F.col("page_id"), digest)), F.lit(f"WARC-Date: {date}{END}"),
        field("WARC-Target-URI", F.col("url")), field("X-Page-Id", F.col("page_id")),
        field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(F.col("refers_to").isNotNull(), F.concat(
            field("WARC-Profile", F.lit(PROFILE)), field("WARC-Refers-To", record_id(F.col("refers_to"), digest)),
            field("WARC-Refers-To-Date", F.lit(date)))).otherwise(""),
        F.lit(f"Content-Type: application/http;msgtype=response{END}"), field("Content-Length", block_bytes), F.lit(END))
    (records.select(F.concat(header, http, F.coalesce("payload", F.lit(""))).alias("value"))
     .write.option("lineSep", END + END).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path))


def parse(file: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (names in lower case) and block of each record of an open, uncompressed WARC file."""
    while line := file.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = {}
        while (line := file.readline()).strip():
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        yield fields, file.read(int(fields["content-length"]))


def _record(fields: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    head, _, payload = block.partition(b"\r\n\r\n")
    kind, digest, size = fields["warc-type"], fields.get("warc-payload-digest", "").partition(":")[2] or None, None
    if kind == "response":
        actual = b32encode(hashlib.sha1(payload).digest()).decode()
        if digest not in (None, actual):
            raise ValueError(f"{fields.get('warc-record-id')}: the payload is damaged")
        digest, size = actual, len(payload)
    page = fields.get("x-page-id")
    row = (fields.get("warc-record-id"), kind, None if page is None else int(page), fields.get("warc-target-uri"), digest, size,
           fields.get("warc-refers-to"))
    return (*row, payload.decode("utf-8", "replace") if kind == "response" else None) if with_payload else row


def read_warc(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """Response and revisit records of an archive, digests checked; `payload` only if asked for.

    Files are read whole but unpacked as a stream, so memory is bounded by the compressed file and a batch of records.
    """
    names = [f.split()[0] for f in RECORD.split(", ")] + (["payload"] if with_payload else [])
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

        for batch in batches:
            for content in batch["content"]:
                data = io.BytesIO(content.as_buffer())
                rows, size = [], 0
                with gzip.open(data) if data.getbuffer()[:2] == b"\x1f\x8b" else data as file:
                    for fields, block in parse(file):
                        if fields["warc-type"] in ("response", "revisit"):
                            rows.append(_record(fields, block, with_payload))
                            size += len(block) if with_payload else 64
                        if size >= 8 << 20:
                            yield batch_of(rows)
                            rows, size = [], 0
                if rows:
                    yield batch_of(rows)

    files = spark.read.format("binaryFile").load(path).select("content")
    return files.mapInArrow(run, RECORD + (", payload string" if with_payload else ""))


def resolve_revisits(records: DataFrame) -> DataFrame:
    """`page_id`, `payload_bytes`, `payload_digest`, `record_type`, `refers_to`: each revisit with the facts of the
    response that it names. Only revisits and the responses they need take part in the join."""
    originals = (records.where("record_type = 'response'").groupBy(F.col("record_id").alias("refers_to_id"))
                 .agg(F.min("page_id").alias("refers_to"), F.min("payload_bytes").alias("original_bytes")))
    repeat = F.col("record_type") == "revisit"
    wanted = records.where(repeat).select("refers_to_id").distinct()
    resolved = (records.where(repeat).join(originals.join(wanted, "refers_to_id", "left_semi"), "refers_to_id", "left")
                .select("page_id", F.coalesce("payload_bytes", "original_bytes").alias("payload_bytes"), "payload_digest",
                        "record_type", "refers_to"))
    return resolved.unionByName(records.where(~repeat).select("page_id", "payload_bytes", "payload_digest", "record_type",
                                                              F.lit(None).cast("long").alias("refers_to")))


def archive_pages(pages: DataFrame, path: str, least_bytes: int = 0) -> DataFrame:
    """Write a deduplicated archive of `pages` (`page_id`, `url`, `html`) to `path` and read it back, revisits resolved.

    A null html is empty; with `least_bytes` 0 all empty pages but the first revisit it. A page without an id is always a
    response, and no other page refers to it. Repeated rows of one page get records of their own; those with the smallest
    id are all responses. A null url leaves its header out. An empty table gives an empty archive and result.
    """
    write_warc(deduplicated(captures(pages), least_bytes), path)
    # The headers are needed twice below, the files should be read once.
    return resolve_revisits(scratch_table(read_warc(pages.sparkSession, path, with_payload=False), "warc_headers"))
