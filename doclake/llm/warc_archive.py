"""A content-addressed archive of WARC records: payload bytes once by digest, exact headers apart, records rebuilt by joins.

An archive is a folder of two tables. ``payloads`` holds each distinct payload once, under its SHA-256. ``records`` holds, for
each record, the exact bytes before its payload (WARC header and HTTP header) and the digest of the payload. Of records with
equal payloads one is a response; the others are revisits of it, as the WARC format has it for repeated content. Digests are
verified on both ways: on writing, bytes that share a SHA-256 must share length and SHA-1 too; on reading, every payload is
hashed again, and the digest and length in the record's own header must be those of the payload.

Everything is a DataFrame of built-in functions. Payload bytes are shuffled once, after copies were reduced inside the
tasks that read them; all other steps move digests and headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from doclake.llm.common import stored
from doclake.operators.joins import join_reduced

_CRLF = "\r\n"
#: Fixed values of the WARC format.
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DIGITS, _ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in upper-case base 32 (32 characters), as WARC digests are written."""
    digits = F.sha1(payload)
    groups = [(1, 15, 12), (16, 15, 12), (31, 10, 8)]  # hexadecimal digits from, how many, base-32 digits of them
    parts = [F.lpad(F.conv(F.substring(digits, at, n), 16, 32), width, "0") for at, n, width in groups]
    return F.translate(F.concat(*parts), _DIGITS, _ALPHABET)


def page_records(pages: DataFrame, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """``pages (page_id, url, html)`` as records to archive: ``name long, target string, date string, http binary, payload binary``.

    The payload is the html in UTF-8, empty for null; a null url has no target. Other columns are left out.
    """
    payload = F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{_CRLF}Content-Type: text/html; charset=utf-8{_CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(_CRLF * 2),
    )
    return pages.select(
        F.col("page_id").cast("long").alias("name"),
        F.col("url").alias("target"),
        F.lit(date).alias("date"),
        F.encode(http, "UTF-8").alias("http"),
        payload.alias("payload"),
    )


def _line(field: str, value: Column) -> Column:
    """A header line, nothing for a null value."""
    return F.coalesce(F.concat(F.lit(f"{field}: "), value, F.lit(_CRLF)), F.lit(""))


def _one_line(value: Column) -> Column:
    """Control characters, blanks and percent signs percent-encoded, so that a header line stays one line."""
    for c in ["%", *map(chr, range(33)), "\x7f"]:
        value = F.replace(value, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return value


def _record_id(row: Column) -> Column:
    digits = F.sha2(row.cast("string"), 256)
    cuts = [F.substring(digits, at, n) for at, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cuts), F.lit(">"))


def write_archive(records: DataFrame, folder: str) -> None:
    """Write ``records (name, target, date, http, payload)`` to a new archive at ``folder``.

    Of records with equal payloads, empty ones included, the one with the largest name is the response; of several with that name,
    repeated rows included, one is, and the others revisit it. A null name comes before all others. Null ``http`` and ``payload``
    are empty, null targets and dates leave their header lines out; other columns are not stored. An empty table makes an
    empty archive. Nothing is made per copy but its header: copies of a payload may be a third of all records.
    """
    spark = records.sparkSession
    payload, http = F.coalesce("payload", F.encode(F.lit(""), "UTF-8")), F.coalesce("http", F.encode(F.lit(""), "UTF-8"))
    records = records.select("name", "target", "date", http.alias("http"), payload.alias("payload"))
    digest = F.unhex(F.sha2("payload", 256)).alias("digest")
    size, sha1 = F.octet_length("payload").cast("long").alias("size"), base32_sha1(F.col("payload")).alias("sha1")
    # Numbered once and stored, so that no later pass can number the rows otherwise.
    keyed = stored(records.select("name", "target", "date", "http", digest, size, sha1, F.monotonically_increasing_id().alias("row")), "warc-keys")
    top = F.max(F.struct("name", "row")).alias("top")
    alike = (F.min("sha1") == F.max("sha1")) & (F.min("size") == F.max("size"))
    firsts = keyed.groupBy("digest").agg(top, F.assert_true(alike, F.lit("different payloads share a SHA-256")).alias("checked"))
    placed = join_reduced(keyed, firsts.filter("checked is null"), "digest", "inner")
    response = F.col("row") == F.col("top.row")
    header = F.concat(
        F.lit(f"WARC/1.1{_CRLF}"),
        _line("WARC-Type", F.when(response, "response").otherwise("revisit")),
        _line("WARC-Record-ID", _record_id(F.col("row"))),
        _line("WARC-Date", _one_line(F.col("date"))),
        _line("WARC-Target-URI", _one_line(F.col("target"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        _line("WARC-Profile", F.when(~response, _REVISIT)),
        _line("WARC-Refers-To", F.when(~response, _record_id(F.col("top.row")))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", (F.octet_length("http") + F.when(response, F.col("size")).otherwise(0)).cast("string")),
        F.lit(_CRLF),
    )
    placed.select(
        "name",
        _record_id(F.col("row")).alias("record_id"),
        F.when(~response, F.col("top.name")).alias("refers_to_name"),
        F.encode(header, "UTF-8").alias("header"),
        "http",
        "digest",
    ).write.parquet(f"{folder}/records")
    # The largest of equal values is any of them; copies are reduced inside a task before the shuffle.
    payloads = records.select(digest, "payload").groupBy("digest").agg(F.max("payload").alias("payload"))
    payloads.write.option("compression", "zstd").parquet(f"{folder}/payloads")


def read_payloads(spark: SparkSession, folder: str) -> DataFrame:
    """``digest, payload, payload_bytes, payload_digest``, once each, the bytes verified against their address."""
    rows = spark.read.schema("digest binary, payload binary").parquet(f"{folder}/payloads")
    good = F.assert_true(F.unhex(F.sha2("payload", 256)) == F.col("digest"), F.lit("a payload is not what its digest says"))
    return rows.filter(good.isNull()).select(
        "digest",
        "payload",
        F.octet_length("payload").cast("long").alias("payload_bytes"),
        base32_sha1(F.col("payload")).alias("payload_digest"),
    )


def _field(name: str) -> Column:
    """The value of a header line; null without one."""
    text = F.decode("header", "UTF-8")
    value = F.regexp_extract(text, rf"\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(value != "", value)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """Every record of the archive, rebuilt from its header and its payload.

    ``name``, ``record_id``, ``record_type``, ``target``, ``refers_to`` (a record id) and ``refers_to_name``, ``payload_bytes``,
    ``payload_digest``, ``payload`` (whole, for revisits too), ``record``: the exact bytes of the record as a WARC file has them.
    Columns that are not asked for are not read or moved, so a listing joins headers with digests and lengths alone; the bytes
    are hashed again even then. A record whose payload is missing, or whose header disagrees with its payload, is an error.
    """
    schema = "name long, record_id string, refers_to_name long, header binary, http binary, digest binary"
    rows = spark.read.schema(schema).parquet(f"{folder}/records")
    rows = rows.select(
        "*",
        _field("WARC-Type").alias("record_type"),
        _field("WARC-Target-URI").alias("target"),
        _field("WARC-Refers-To").alias("refers_to"),
        _field("WARC-Payload-Digest").alias("stated"),
        _field("Content-Length").cast("long").alias("length"),
    )
    found = join_reduced(rows, read_payloads(spark, folder), "digest", "left")
    body = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(0)
    same = F.col("stated") == F.concat(F.lit("sha1:"), F.col("payload_digest"))
    fits = F.coalesce(same & (F.col("length") == F.octet_length("http") + body), F.lit(False))
    content = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.encode(F.lit(""), "UTF-8"))
    end = F.encode(F.lit(_CRLF * 2), "UTF-8")
    return found.filter(F.assert_true(fits, F.lit("a record does not fit its payload")).isNull()).select(
        "name",
        "record_id",
        "record_type",
        "target",
        "refers_to",
        "refers_to_name",
        "payload_bytes",
        "payload_digest",
        "payload",
        F.concat("header", "http", content, end).alias("record"),
    )
