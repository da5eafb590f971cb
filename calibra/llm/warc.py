"""WARC archives: digests, revisit resolution, deduplicated writing and reading.

Only headers (id, digest, length) are shuffled by payload digest; the payloads meet their role by
record id, which no hot digest can skew.  Archives are written and committed by Spark's text
writer, whose line separator is the blank lines that end a record, so any store that Spark writes
to will do and a lost executor leaves no half archive.  The payload travels as raw bytes.
"""

from __future__ import annotations

import gzip
import io

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .shared import fresh, store

VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RECORDS_PER_ARCHIVE = 5_000
_END = "\r\n\r\n"
# base32 digits in the order of the alphabet with extended hex, and of RFC 4648.
_HEX32, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def sha1_base32(payload: Column) -> Column:
    """SHA-1 of a binary column in upper-case base32: 5 hexadecimal digits are 4 of base32."""
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*parts), _HEX32, _BASE32)


def record_urn(*parts: Column) -> Column:
    """A record id that a recomputed task writes again alike."""
    code = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    cut = [F.substring(code, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def resolve(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Adds ``record_type`` and ``refers_to`` to ``headers (id, digest, bytes)``.

    Of the records with one payload the smallest id is the response and the others revisit it;
    payloads under ``min_bytes`` are always responses.  Rows that repeat id and digest are all
    responses where they are the smallest; a record without id revisits one that has an id.
    """
    # Copies are counted before the shuffle; what has none needs no lookup row.
    first = headers.where(F.col("bytes") >= min_bytes).groupBy("digest")
    first = store(
        first.agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1 and first is not null").drop("n"),
        "originals",
    )
    out = headers.join(first, "digest", "left")
    revisit = F.col("first").isNotNull() & (F.col("id").isNull() | (F.col("id") != F.col("first"))) & (F.col("bytes") >= min_bytes)
    return out.select(
        *headers.columns,
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_warc(
    pages: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    date: str = "2024-01-01T00:00:00Z",
    min_bytes: int = 0,
    records_per_archive: int = RECORDS_PER_ARCHIVE,
) -> None:
    """Write one record per row of ``pages``: a response with its payload, or a revisit without.

    A missing payload is empty, a missing url or key leaves its header out.  Line breaks in a url
    become spaces, so no value can end a header.  ``date`` is the date of all records.  Rows that repeat
    are records of their own, as :func:`resolve` tells them apart; a payload of any length is one
    record; no rows leave a folder without archives.
    """
    rows = pages.select(
        F.col(key).alias("id"),
        F.regexp_replace(F.col(url).cast("string"), r"[\r\n]+", " ").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    )
    rows = rows.withColumns({"digest": sha1_base32(F.col("payload")), "bytes": F.length("payload").cast("bigint")})
    roles = resolve(rows.select("id", "digest", "bytes"), min_bytes).select("id", "digest", "record_type", "refers_to")
    # Revisits are the lookup rows; a record that is not among them is a response.
    again = store(roles.where("record_type = 'revisit'").distinct(), "revisits")
    again = again.select(F.col("id").alias("id2"), F.col("digest").alias("digest2"), "refers_to")
    joined = rows.join(again, F.col("id").eqNullSafe(F.col("id2")) & (F.col("digest") == F.col("digest2")), "left")
    revisit = F.col("refers_to").isNotNull()
    body = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))

    def line(name, value):
        return F.coalesce(F.concat(F.lit(f"{name}: "), value.cast("string"), F.lit("\r\n")), F.lit(""))

    head = F.concat(
        F.lit(f"{VERSION}\r\n"),
        line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        line("WARC-Record-ID", record_urn(F.col("id"), F.col("digest"))),
        line("WARC-Date", F.lit(date)),
        line("WARC-Target-URI", F.col("url")),
        line("X-Source-Key", F.col("id")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        line("X-Payload-Length", F.col("bytes")),
        F.when(
            revisit,
            F.concat(
                line("WARC-Profile", F.lit(REVISIT_PROFILE)),
                line("WARC-Refers-To", record_urn(F.col("refers_to"), F.col("digest"))),
                line("X-Refers-To-Key", F.col("refers_to")),
            ),
        ).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")),
        line("Content-Length", F.length(body)),
        F.lit("\r\n"),
    )
    # concat of binaries keeps the bytes; the cast to string does not check or change them.
    record = F.concat(head.cast("binary"), body).cast("string").alias("value")
    writer = joined.select(record).write.option("lineSep", _END).option("compression", "gzip")
    writer.option("maxRecordsPerFile", records_per_archive).text(path)


def records(data) -> iter:
    """``(headers, payload)`` of every record of a stream of an uncompressed archive."""
    while line := data.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not the start of a WARC record: {line[:40]!r}")
        headers = {}
        while line := data.readline().rstrip(b"\r\n"):
            name, _, value = line.partition(b":")
            headers[name.strip().lower().decode()] = value.strip().decode("utf-8", "replace")
        yield headers, data.read(int(headers["content-length"]))


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``; one archive is one task's work, read as a stream.

    Archives may be compressed, as a whole or by record.
    """

    def run(frames):
        for frame in frames:
            for name, content in zip(frame["path"], frame["content"]):
                stream = io.BytesIO(content)
                if content[:2] == b"\x1f\x8b":
                    stream = gzip.GzipFile(fileobj=stream)
                rows, held = [], 0
                for h, payload in records(io.BufferedReader(stream)):
                    rows.append(
                        (
                            h.get("x-source-key"), h.get("warc-type"), h.get("warc-record-id"), h.get("warc-date"),
                            h.get("warc-target-uri"), h.get("warc-payload-digest", "").removeprefix("sha1:"),
                            int(h.get("x-payload-length", len(payload))), h.get("warc-refers-to"),
                            h.get("x-refers-to-key"), payload,
                        )
                    )
                    held += len(payload)
                    if held > 8_000_000:
                        yield pd.DataFrame(rows, columns=names)
                        rows, held = [], 0
                if rows:
                    yield pd.DataFrame(rows, columns=names)

    names = ["key", "record_type", "record_id", "date", "url", "payload_digest", "payload_bytes", "refers_to_id", "refers_to", "payload"]
    kinds = ["string"] * 6 + ["bigint", "string", "string", "binary"]
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInPandas(run, ", ".join(f"{n} {k}" for n, k in zip(names, kinds)))


def originals(read: DataFrame) -> DataFrame:
    """Every record with its full payload: revisits get that of the response they refer to.

    Responses are looked up by record id; a revisit whose original is not in the archives keeps a
    missing payload.
    """
    responses, revisits = read.where("record_type <> 'revisit'"), read.where("record_type = 'revisit'")
    bodies, = fresh(read, "__body")
    found = responses.select(F.col("record_id").alias("refers_to_id"), F.col("payload").alias(bodies)).dropDuplicates(["refers_to_id"])
    full = revisits.join(found, "refers_to_id", "left").drop("payload").withColumnRenamed(bodies, "payload")
    return responses.unionByName(full)
