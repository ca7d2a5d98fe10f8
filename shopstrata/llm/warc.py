"""Web archives: written as WARC records with segments and chunked bodies, and reassembled.

Writing. Each page is one record. Of pages with equal payloads the one with the
smallest id is the response, the others are revisits that refer to it. A response's
block is an HTTP message in chunked transfer framing; a block longer than
``segment_chars`` is split into a first record and continuation records. Files are made
by the text writer with the record's closing blank line as separator, and hold a
bounded number of bounded records.

Reading. Files are parsed one record at a time. Continuation records are grouped by the
identifier of their origin record, ordered by segment number, checked for gaps and
against the stated total length, and the chunked framing is removed. Revisits take the
length of the payload from the response they refer to. A record that does not add up is
not dropped: it keeps its row, with the reason in ``problem``.

Edge cases: null html is an empty payload, a null url leaves its header out, and line
breaks in a url are percent-encoded. Null page ids come last: they are a response only
where no page with an id has the payload. Rows that repeat page id and payload have the same role.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstrata.llm.columns import let
from shopstrata.llm.scratch import new_path, written

CRLF = "\r\n"
WARC_DATE = "2024-01-01T00:00:00Z"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
RECORDS_PER_FILE = 4096

HTTP_HEAD = CRLF.join(["HTTP/1.1 200 OK", "Content-Type: text/html; charset=utf-8"]) + CRLF


def base32_sha1(payload: Column) -> Column:
    """Upper-case base32 of the SHA-1: five hexadecimal digits are four characters."""

    def four(digits: Column, at: int) -> Column:
        value = F.conv(F.substring(digits, at, 5), 16, 10).cast("int")
        return F.concat(
            *[F.substring(F.lit(BASE32), F.shiftright(value, s).bitwiseAND(31) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
        )

    return let(
        F.sha1(payload.cast("binary")), lambda h: F.concat(*[four(h, 1 + 5 * i) for i in range(8)])
    )


def _pieces(text: Column, size: int) -> Column:
    """A text cut every ``size`` characters, in one pass over it."""
    return F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % size), F.lit(0))


def _chunked(payload: Column, size: int) -> Column:
    chunks = F.transform(
        _pieces(payload, size), lambda p: F.concat(F.hex(F.octet_length(p)), F.lit(CRLF), p, F.lit(CRLF))
    )
    return F.concat(F.array_join(chunks, ""), F.lit("0" + CRLF + CRLF))


def _header(name: str, value: Column) -> Column:
    """A header line, or null if it has no value; nulls are left out when the lines are joined."""
    return F.concat(F.lit(name + ": "), value)


def records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
    segment_chars: int = 8192,
    chunk_chars: int = 2048,
    least_revisit_bytes: int = 0,
) -> DataFrame:
    """One row per WARC record, as text without its closing blank line."""
    read = pages.select(
        F.col(id_col).alias("id"),
        F.col(url_col).alias("url"),
        F.coalesce(F.col(html_col), F.lit("")).alias("payload"),
    ).withColumn("digest", base32_sha1(F.col("payload")))
    first = read.groupBy("digest").agg(F.min("id").alias("first_id"))
    known = read.join(first, "digest").withColumn("row", F.monotonically_increasing_id())
    large = F.octet_length("payload") >= least_revisit_bytes
    revisit = large & F.col("first_id").isNotNull() & ~F.col("id").eqNullSafe(F.col("first_id"))
    page = F.coalesce(F.col("id").cast("string"), F.lit("null"))
    block = F.when(F.col("revisit"), F.lit(HTTP_HEAD + CRLF)).otherwise(
        F.concat(F.lit(HTTP_HEAD + "Transfer-Encoding: chunked" + CRLF + CRLF), _chunked(F.col("payload"), chunk_chars))
    )
    whole = known.withColumn("revisit", revisit).select(
        "url", "digest", "revisit", "first_id",
        F.concat(F.lit("urn:page:"), page, F.lit(":"), F.col("row")).alias("urn"),
        _pieces(block, segment_chars).alias("parts"),
    )
    each = whole.select(
        "url", "digest", "revisit", "first_id", "urn",
        F.size("parts").alias("n"),
        F.aggregate("parts", F.lit(0).cast("bigint"), lambda a, p: a + F.octet_length(p)).alias("total"),
        F.posexplode("parts").alias("k", "part"),
    )
    head, last = F.col("k") == 0, F.col("k") == F.col("n") - 1
    split = F.col("n") > 1
    url = F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A")
    lines = [
        F.lit("WARC/1.1"),
        _header(
            "WARC-Type",
            F.when(~head, F.lit("continuation")).when(F.col("revisit"), F.lit("revisit")).otherwise(F.lit("response")),
        ),
        _header(
            "WARC-Record-ID",
            F.concat(F.lit("<"), "urn", F.when(head, F.lit("")).otherwise(F.concat(F.lit(":"), F.col("k") + 1)), F.lit(">")),
        ),
        F.lit("WARC-Date: " + WARC_DATE),
        F.when(head, _header("WARC-Target-URI", url)),
        F.when(head, _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "digest"))),
        F.when(
            F.col("revisit"),
            _header("WARC-Refers-To", F.concat(F.lit("<urn:page:"), F.col("first_id").cast("string"), F.lit(">"))),
        ),
        F.when(
            F.col("revisit"),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"),
        ),
        F.when(split, _header("WARC-Segment-Number", (F.col("k") + 1).cast("string"))),
        F.when(~head, _header("WARC-Segment-Origin-ID", F.concat(F.lit("<"), "urn", F.lit(">")))),
        F.when(split & last, _header("WARC-Segment-Total-Length", F.col("total").cast("string"))),
        F.when(head, F.lit("Content-Type: application/http; msgtype=response")),
        _header("Content-Length", F.octet_length("part").cast("string")),
    ]
    return each.select(F.concat(F.concat_ws(CRLF, *lines), F.lit(CRLF + CRLF), "part").alias("value"))


def write(pages: DataFrame, path: str, **options) -> None:
    """Write the archives of ``pages`` below ``path``."""
    (
        records(pages, **options)
        .write.option("lineSep", CRLF + CRLF)
        .option("compression", "gzip")
        .option("maxRecordsPerFile", RECORDS_PER_FILE)
        .text(path)
    )


def parse(stream) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers, by lower-case name, and block of each record of an uncompressed stream."""
    while True:
        line = stream.readline()
        if not line:
            return
        if not line.strip():
            continue
        headers = {"version": line.strip().decode()}
        for line in iter(stream.readline, b"\r\n"):
            if not line:
                break
            name, _, value = line.decode().partition(":")
            headers[name.strip().lower()] = value.strip()
        yield headers, stream.read(int(headers.get("content-length", "0")))


def unchunk(body: bytes) -> tuple[bytes, str | None]:
    """The payload without chunked framing, and what is wrong with the framing, if anything."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return b"".join(parts), "chunk without size"
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return b"".join(parts), "chunk size unreadable"
        at = end + 2
        if size == 0:
            return b"".join(parts), None
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            return b"".join(parts), "chunk cut short"
        parts.append(body[at : at + size])
        at += size + 2


def payload_of(block: bytes) -> tuple[bytes, str | None]:
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return b"", "HTTP head not closed"
    if b"transfer-encoding: chunked" in head.lower():
        return unchunk(body)
    return body, None


def digest_of(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


_PARTS = (
    "origin string, segment int, total long, record_type string, digest string, refers_to string,"
    " payload_bytes long, found_digest string, problem string, payload binary, block binary"
)
_WHOLE = (
    "origin string, record_type string, digest string, payload_bytes long, found_digest string, problem string,"
    " payload binary"
)
_KINDS = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}


def _batch(schema: str, rows: list[dict]) -> pa.RecordBatch:
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r.get(n) for r in rows], _KINDS[k]) for n, k in fields], names=[n for n, _ in fields]
    )


def _decoded(block: bytes, keep_payload: bool) -> dict:
    payload, problem = payload_of(block)
    return {
        "payload_bytes": len(payload), "found_digest": digest_of(payload), "problem": problem,
        "payload": payload if keep_payload else None,
    }


def _parse_files(keep_payload: bool, flush_bytes: int = 8 << 20):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for batch in batches:
            for content in batch.column(0):
                for headers, block in parse(gzip.GzipFile(fileobj=io.BytesIO(content.as_buffer()))):
                    number = int(headers.get("warc-segment-number", "0"))
                    row = {
                        "origin": headers.get("warc-segment-origin-id", headers["warc-record-id"]).strip("<>"),
                        "segment": number,
                        "total": int(headers["warc-segment-total-length"]) if "warc-segment-total-length" in headers else None,
                        "record_type": headers["warc-type"],
                        "digest": headers.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                        "refers_to": headers.get("warc-refers-to", "").strip("<>").removeprefix("urn:page:") or None,
                    }
                    if number:
                        row["block"] = block
                    elif row["record_type"] == "response":
                        row |= _decoded(block, keep_payload)
                    rows.append(row)
                    held += 500 + len(row.get("block") or b"") + len(row.get("payload") or b"")
                    if held >= flush_bytes:
                        yield _batch(_PARTS, rows)
                        rows, held = [], 0
        yield _batch(_PARTS, rows)

    return run


def _decode_blocks(keep_payload: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = {name: batch.column(name)[i].as_py() for name in batch.schema.names}
                blocks = row.pop("blocks")
                if row["problem"] is None:
                    row |= _decoded(b"".join(blocks), keep_payload)
                yield _batch(_WHOLE, [row])

    return run


def read(spark: SparkSession, path: str, keep_payload: bool = False) -> DataFrame:
    """One row per archived page: ``page_id, payload_bytes, payload_digest, record_type, refers_to, problem, payload``."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("content")
    # Written once: the records of the segments are read several times below.
    parts = written(files.mapInArrow(_parse_files(keep_payload), _PARTS), "warc-parts")
    single = parts.where("segment = 0").drop("block", "segment", "total")

    pieces = (
        parts.where("segment > 0")
        .groupBy("origin")
        .agg(
            F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("s"),
            F.max("total").alias("total"),
            F.max("digest").alias("digest"),
            F.max(F.when(F.col("segment") == 1, F.col("record_type"))).alias("record_type"),
        )
    )
    length = F.aggregate("s", F.lit(0).cast("bigint"), lambda a, x: a + F.octet_length(x["block"]))
    gap = F.exists(F.transform("s", lambda x, i: x["segment"] != i + 1), lambda x: x)
    problem = (
        F.when(F.col("total").isNull(), F.lit("last segment missing"))
        .when(gap, F.lit("segment missing or repeated"))
        .when(length != F.col("total"), F.lit("total length differs"))
    )
    reassembled = pieces.select(
        "origin", "record_type", "digest", F.transform("s", lambda x: x["block"]).alias("blocks"),
        problem.alias("problem"),
    ).mapInArrow(_decode_blocks(keep_payload), _WHOLE)
    found = single.unionByName(reassembled, allowMissingColumns=True).select(
        F.expr("try_cast(split_part(origin, ':', 3) as bigint)").alias("page_id"),
        "record_type", "digest", F.expr("try_cast(refers_to as bigint)").alias("refers_to"), "payload_bytes",
        F.coalesce(
            "problem", F.when(F.col("found_digest") != F.col("digest"), F.lit("payload digest differs"))
        ).alias("problem"),
        "payload",
    )
    targets = (
        found.where("record_type = 'response'")
        .groupBy(F.col("page_id").alias("_page"), F.col("digest").alias("_digest"))
        .agg(F.max("payload_bytes").alias("_bytes"))
    )
    linked = found.join(
        targets, (F.col("refers_to") == F.col("_page")) & (F.col("digest") == F.col("_digest")), "left"
    )
    lost = (F.col("record_type") == "revisit") & F.col("_bytes").isNull()
    return linked.select(
        "page_id",
        F.coalesce("payload_bytes", "_bytes").alias("payload_bytes"),
        F.col("digest").alias("payload_digest"),
        "record_type",
        "refers_to",
        F.coalesce("problem", F.when(lost, F.lit("response missing"))).alias("problem"),
        "payload",
    )


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write the archives of ``pages`` to a new shared folder and read them back."""
    path = new_path(pages.sparkSession, "warc")
    write(pages, path, **options)
    return read(pages.sparkSession, path)


# The registered query in DuckDB, over the view ``pages``.
ORACLE = r"""
WITH p AS (
  SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
  FROM pages),
v AS (SELECT *, list_transform(range(8), lambda i: CAST('0x' || substr(h, 5 * i + 1, 5) AS BIGINT)) AS five FROM p)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(five, lambda x:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 15) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 10) & 31) + 1, 1) ||
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((x >> 5) & 31) + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (x & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN first_id IS NULL OR page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to,
       CAST(NULL AS VARCHAR) AS problem
FROM v
"""
