"""WARC archives: written by DataFrame expressions, read back and assembled into captures (operator 7).

Every page becomes a transaction of three records: a request, a response or revisit, and a
metadata record.  Request and metadata name the response in WARC-Concurrent-To.  Reading parses
the archives by their content lengths and joins the records of a transaction on that identifier,
one nested row per capture.

Archives are gzip-compressed text files whose record separator is the format's own blank lines, so
Spark's text writer commits them, and any store that Spark writes to will do.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the format.
VERSION, CRLF = "WARC/1.1", "\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
#: Records per archive at most, which bounds what a reading task holds.
RECORDS_PER_FILE = 12_000


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 SHA-1 of a string: 40 hex digits, five at a time to four characters."""
    digits = F.sha1(payload)
    alphabet = F.lit(_BASE32)
    out = []
    for i in range(0, 40, 5):
        bits = F.conv(F.substring(digits, i + 1, 5), 16, 10).cast("int")
        out += [F.substring(alphabet, F.shiftright(bits, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*out)


def _record(kind: str, record_id: Column, block: Column, *headers: Column) -> Column:
    """A record without its closing blank lines; null headers are left out."""
    lines = F.concat_ws(CRLF, F.lit(VERSION), F.lit(f"WARC-Type: {kind}") if isinstance(kind, str) else kind,
                        F.concat(F.lit("WARC-Record-ID: "), record_id), *headers,
                        F.concat(F.lit("Content-Length: "), F.octet_length(block)))
    return F.concat(lines, F.lit(CRLF * 2), block)


def _urn(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("|", *parts))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url",
                   payload_col: str = "html", revisit_bytes: int = 0,
                   date: str = "2000-01-01T00:00:00Z") -> None:
    """Write the transactions of all pages below ``path``.

    Of pages with equal payloads of at least ``revisit_bytes`` bytes, the one with the largest id
    is the response and the others revisit it.  Defined results: a null payload is empty; a null
    url is an empty one; line breaks in a url become blanks; a null id counts as the smallest; rows
    that repeat the largest id of their payload are all responses; other columns are ignored; an
    empty table writes no record.
    """
    rows = pages.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.regexp_replace(F.coalesce(url_col, F.lit("")), r"[\r\n]", " ").alias("url"),
        F.coalesce(payload_col, F.lit("")).alias("payload"))
    rows = rows.withColumns({"digest": base32_sha1(F.col("payload")), "bytes": F.octet_length("payload")})
    # groups of equal payloads: counted and reduced before they are shuffled, without the payloads
    groups = (rows.filter(F.col("bytes") >= revisit_bytes).groupBy("digest").agg(
        F.max("id").alias("first_id"), F.max_by("url", "id").alias("first_url"), F.count("*").alias("n"))
        .filter("n > 1").drop("n"))
    rows = rows.join(groups, "digest", "left").withColumn("revisits", F.coalesce(
        F.col("first_id") != F.col("id"), F.col("first_id").isNotNull()))
    rows = rows.withColumn("nr", F.monotonically_increasing_id())  # tells repeated pages apart
    h = lambda name, value: F.concat(F.lit(f"{name}: "), value)
    date_line, url_line = F.lit(f"WARC-Date: {date}"), h("WARC-Target-URI", F.col("url"))
    own = _urn(F.lit("response"), F.col("id").cast("string"), F.col("digest"), F.col("nr").cast("string"))
    concurrent = h("WARC-Concurrent-To", own)
    head = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
                    F.col("bytes"), F.lit(CRLF * 2))
    fields = F.concat_ws(CRLF, h("pageId", F.col("id")), F.when(F.col("revisits"), h("refersToPageId", F.col("first_id"))))
    records = F.array(
        _record("request", _urn(F.lit("request"), own), F.concat(F.lit(f"GET / HTTP/1.1{CRLF * 2}")),
                F.lit("Content-Type: application/http; msgtype=request"), date_line, url_line, concurrent),
        _record(F.when(F.col("revisits"), "WARC-Type: revisit").otherwise("WARC-Type: response"), own,
                F.when(F.col("revisits"), head).otherwise(F.concat(head, F.col("payload"))),
                F.lit("Content-Type: application/http; msgtype=response"), date_line, url_line,
                h("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
                F.when(F.col("revisits"), F.lit(f"WARC-Profile: {PROFILE}")),
                F.when(F.col("revisits"), h("WARC-Refers-To-Target-URI", F.col("first_url")))),
        _record("metadata", _urn(F.lit("metadata"), own), F.coalesce(fields, F.lit("")),
                F.lit("Content-Type: application/warc-fields"), date_line, url_line, concurrent))
    (rows.select(F.explode(records).alias("value")).write.option("lineSep", CRLF * 2)
     .option("compression", "gzip").option("maxRecordsPerFile", RECORDS_PER_FILE).text(path))


# Reading -------------------------------------------------------------------------------
def _inflated(data: bytes) -> bytes:
    """Plain bytes of a file of any number of gzip members, or the file itself."""
    if data[:2] != b"\x1f\x8b":
        return data
    out = []
    while data:
        z = zlib.decompressobj(31)
        out.append(z.decompress(data))
        data = z.unused_data
    return b"".join(out)


def _headers(block: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    for line in block.decode("utf-8", "replace").split(CRLF)[1:]:
        name, _, value = line.partition(":")
        found.setdefault(name.strip().lower(), value.strip())
    return found


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record, found by content length."""
    at = 0
    while True:
        while data[at:at + 2] == b"\r\n":
            at += 2
        end = data.find(b"\r\n\r\n", at)
        if end < 0:
            return
        head = _headers(data[at:end])
        size = int(head.get("content-length", 0))
        yield head, data[end + 4:end + 4 + size]
        at = end + 4 + size


_FIELDS = ("type", "record_id", "target_uri", "date", "content_type", "payload_digest", "profile",
           "refers_to_uri")
_SOURCE = {"type": "warc-type", "record_id": "warc-record-id", "target_uri": "warc-target-uri", "date": "warc-date",
           "content_type": "content-type", "payload_digest": "warc-payload-digest", "profile": "warc-profile",
           "refers_to_uri": "warc-refers-to-target-uri"}
RECORD = ", ".join(f"{f}: string" for f in _FIELDS) + (
    ", http_length: bigint, payload_bytes: bigint, payload_sha1: string, fields: map<string, string>, payload: binary")


def _parsed(batches, with_payload: bool):
    names = [*_FIELDS, "http_length", "payload_bytes", "payload_sha1", "fields", "payload"]
    kinds = [pa.string()] * len(_FIELDS) + [pa.int64(), pa.int64(), pa.string(), pa.map_(pa.string(), pa.string()), pa.binary()]
    struct = pa.struct(list(zip(names, kinds)))
    for batch in batches:
        for content in batch.column(0):
            keys, rows, held = [], [], 0
            for head, block in records(_inflated(content.as_py())):
                payload, http, fields = block, {}, {}
                if "application/http" in head.get("content-type", ""):
                    top, _, payload = block.partition(b"\r\n\r\n")
                    http = _headers(top)
                elif head.get("content-type", "") == "application/warc-fields":
                    fields = _headers(b"\r\n" + block)
                row = {f: head.get(_SOURCE[f]) for f in _FIELDS}
                row |= {"http_length": int(n) if (n := http.get("content-length", "")).isdigit() else None,
                        "payload_bytes": len(payload), "fields": list(fields.items()),
                        "payload_sha1": base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                        "payload": payload if with_payload else None}
                keys.append(head.get("warc-concurrent-to") or head.get("warc-record-id"))
                rows.append(row)
                held += len(payload) if with_payload else 200
                if held > 1 << 23:
                    yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(rows, struct)], ["capture", "record"])
                    keys, rows, held = [], [], 0
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(rows, struct)], ["capture", "record"])


def read_captures(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """One row per capture: ``capture`` (the response's record id) and the nested records
    ``request, response, metadata`` (a revisit is the response of its capture; its ``payload`` is
    empty and its ``http_length`` that of the original).

    The join on the concurrent-to identifier is one aggregation: the records of a capture share
    the key, and each kind is picked out.  A record whose partners are missing makes a row with
    nulls in their place.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("content")
    rows = files.mapInArrow(lambda it: _parsed(it, with_payload), f"capture string, record struct<{RECORD}>")
    pick = lambda *kinds: F.first(F.when(F.col("record.type").isin(*kinds), F.col("record")), ignorenulls=True)
    return rows.groupBy("capture").agg(pick("request").alias("request"), pick("response", "revisit").alias("response"),
                                       pick("metadata").alias("metadata"))


def page_digests(captures: DataFrame) -> DataFrame:
    """Per page: ``page_id, payload_bytes, payload_digest, record_type, refers_to`` from what was
    read; a response's length and digest are those of the payload itself."""
    r, revisit = F.col("response"), F.col("response.type") == "revisit"
    return captures.select(
        F.col("metadata.fields")["pageid"].cast("bigint").alias("page_id"),
        F.when(revisit, r["http_length"]).otherwise(r["payload_bytes"]).alias("payload_bytes"),
        F.when(revisit, F.substring_index(r["payload_digest"], ":", -1)).otherwise(r["payload_sha1"]).alias("payload_digest"),
        r["type"].alias("record_type"),
        F.when(revisit, F.col("metadata.fields")["referstopageid"].cast("bigint")).alias("refers_to"))
