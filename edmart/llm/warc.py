"""WARC archives without repeated payloads: revisit records point to the original response.

Headers (id, payload digest, size) are shuffled, not payloads: the largest page id of each
digest is the original. Records then get fresh headers and are written as text files
whose line end closes a record, through Spark's own committed writer. Reading parses the
files by Content-Length and joins revisits to their originals.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edmart.llm.shared import shared_folder
from edmart.operators.joins import lookup_join

LEAST_BYTES = 1000
FILE_BYTES = 16 * 1024 * 1024
DATE = "2024-01-01T00:00:00Z"
# Values of the WARC 1.1 format. Fixed values.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LINE_END = "\r\n"


def headers(pages: DataFrame) -> DataFrame:
    """(page_id, digest, size) of each page; a NULL payload is empty."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    return pages.select("page_id", F.sha1(payload).alias("digest"), F.octet_length(payload).cast("long").alias("size"))


def originals(head: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(digest, original): the largest page id of each payload of at least ``least`` bytes that recurs."""
    found = head.filter(F.col("size") >= least).groupBy("digest")
    return found.agg(F.max("page_id").alias("original"), F.count("*").alias("n")).filter("n > 1").drop("n")


def revisits(head: DataFrame, least: int = LEAST_BYTES) -> DataFrame:
    """(page_id, digest, refers_to) of the pages that are not the original of their payload."""
    met = lookup_join(head.filter(F.col("size") >= least), originals(head, least), "digest")
    other = ~F.col("page_id").eqNullSafe(F.col("original")) & F.col("original").isNotNull()
    return met.filter(other).select("page_id", "digest", F.col("original").alias("refers_to")).distinct()


def record_id(key: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), key, F.lit(">"))


def records(pages: DataFrame, least: int = LEAST_BYTES, date: str = DATE, files: int | None = None) -> DataFrame:
    """``record``: one WARC record per row of ``pages`` (page_id, url, html), its last line end left out.

    Control characters and spaces of a url are percent-encoded. Rows that repeat the page id and
    payload of an original are responses too.
    """
    head = headers(pages)
    payload = F.coalesce("html", F.lit(""))
    # ids as text, so that NULL ids join and the join reuses the partitioning below
    key = F.coalesce(F.col("page_id").cast("string"), F.lit("none"))
    rows = pages.select(
        key.alias("id"),
        F.coalesce("url", F.lit("")).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).alias("size"),
        F.sha1(F.encode(payload, "UTF-8")).alias("digest"),
    )
    found = revisits(head, least).select(key.alias("id"), "digest", F.col("refers_to").cast("string"))
    if files:
        rows, found = rows.repartition(files, "id", "digest"), found.repartition(files, "id", "digest")
    rows = rows.join(found, ["id", "digest"], "left")
    target = F.col("url")
    for char in " \t\n\r\x0b\x0c":
        target = F.replace(target, F.lit(char), F.lit(f"%{ord(char):02X}"))
    is_revisit = F.col("refers_to").isNotNull()

    def header(name: str, value: Column) -> Column:
        return F.concat(F.lit(f"{name}: "), value, F.lit(LINE_END))

    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{LINE_END}Content-Type: text/html; charset=utf-8{LINE_END}"),
        header("Content-Length", F.col("size").cast("string")),
        F.lit(LINE_END),
    )
    block = F.when(is_revisit, http).otherwise(F.concat(http, F.col("payload")))
    record = F.concat(
        F.lit(VERSION + LINE_END),
        header("WARC-Type", F.when(is_revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        header("WARC-Record-ID", record_id(F.col("id"))),
        header("WARC-Date", F.lit(date)),
        header("WARC-Target-URI", target),
        header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(
            is_revisit,
            F.concat(
                header("WARC-Profile", F.lit(PROFILE)), header("WARC-Refers-To", record_id(F.col("refers_to")))
            ),
        ).otherwise(F.lit("")),
        header("Content-Type", F.lit("application/http; msgtype=response")),
        header("Content-Length", F.octet_length(block).cast("string")),
        F.lit(LINE_END),
        block,
        F.lit(LINE_END),
    )
    return rows.select(record.alias("record"))


def write_archives(pages: DataFrame, path: str, least: int = LEAST_BYTES, file_bytes: int = FILE_BYTES) -> None:
    """Write ``pages`` as gzip WARC files of about ``file_bytes`` of payload each, dealt by page id."""
    size = pages.agg(F.sum(F.octet_length("html").cast("long")).alias("n")).first()["n"] or 0
    found = records(pages, least, files=max(1, -(-size // file_bytes)))
    found.write.option("lineSep", LINE_END).option("compression", "gzip").text(path)


def inflated(content: bytes) -> bytes:
    """The content of a gzip file of any number of members, such as one per record."""
    out = []
    while content:
        member = zlib.decompressobj(wbits=47)
        out += [member.decompress(content), member.flush()]
        content = member.unused_data.lstrip(b"\0")
    return b"".join(out)


def digest_of(field: str) -> str:
    """A SHA-1 in hex from ``sha1:`` and hex or base 32."""
    value = field.removeprefix("sha1:")
    return base64.b32decode(value).hex() if len(value) == 32 else value.lower()


def parse(data: bytes) -> list[tuple]:
    """(record id, type, digest, refers to, payload bytes, digest as read) of the responses and revisits of an archive.

    Records of other types are passed over. A response without a digest gets that of its payload.
    """
    out, at = [], 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8", "surrogatepass").split(LINE_END)
        if not lines[0].startswith(VERSION[:-1]):
            raise ValueError(f"no WARC record at byte {at}")
        fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
        start = end + 4
        at = start + int(fields["Content-Length"])
        kind = fields["WARC-Type"]
        if kind in ("response", "revisit"):
            block = data[start:at]
            payload = block[block.index(b"\r\n\r\n") + 4 :]
            whole = kind == "response"
            seen = hashlib.sha1(payload).hexdigest() if whole else None
            out.append(
                (
                    fields["WARC-Record-ID"],
                    kind,
                    digest_of(fields["WARC-Payload-Digest"]) if "WARC-Payload-Digest" in fields else seen,
                    fields.get("WARC-Refers-To"),
                    len(payload) if whole else None,
                    seen,
                )
            )
        while data[at : at + 1] in (b"\r", b"\n"):
            at += 1
    return out


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of every record under ``path``.

    Files may have one gzip member or many; records other than responses and revisits are passed over.
    Revisits get their size from the original they refer to. A response whose payload does
    not have the digest of its header fails the job.
    """
    schema = "id string, record_type string, payload_digest string, target string, size long, seen string"

    def run(batches):
        for batch in batches:
            for content in batch["content"]:
                rows = pd.DataFrame(parse(inflated(content)), columns=["id", "record_type", "payload_digest", "target", "size", "seen"])
                wrong = rows[rows["seen"].notna() & (rows["seen"] != rows["payload_digest"])]
                if len(wrong):
                    raise ValueError(f"payload and digest differ: {wrong['id'].iloc[0]}")
                yield rows.astype({"size": "Int64"})

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    found = files.mapInPandas(run, schema)

    def number(urn: str) -> Column:
        return F.nullif(F.regexp_extract(urn, "^<urn:page:(.*)>$", 1), F.lit("none")).cast("long")

    found = found.select(
        number("id").alias("page_id"), "size", "payload_digest", "record_type", number("target").alias("refers_to")
    )
    key = ["refers_to", "payload_digest"]
    whole = found.filter("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", "size")
    needed = found.filter("record_type = 'revisit'").select(*key).distinct()
    # an original that occurs several times counts once
    whole = whole.join(needed, key, "left_semi").groupBy(*key).agg(F.max("size").alias("whole_size"))
    joined = lookup_join(found, whole, key, "left", spread=["page_id"])
    return joined.select(
        "page_id",
        F.coalesce("size", "whole_size").alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )


def archived(pages: DataFrame) -> DataFrame:
    """``pages`` written to new archives in the shared folder and read back."""
    path = f"{shared_folder(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path)
