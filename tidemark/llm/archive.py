"""A content-addressed archive of web records in the WARC 1.1 form.

Payload bytes are stored once, under the SHA-256 of the bytes and their length. Record headers are
stored apart, exactly as they stand in the record, with the address of their payload. Joining the
two gives the original records back byte by byte.

Of records with equal payloads that with the largest page id is the response; the others are
revisits that refer to it and have headers only. Payloads shorter than the least size are responses
every time. The address is verified on reading: the stored payload's own SHA-256 must be its address
and its SHA-1 the one that each record's header carries, or the read fails.

Rows are grouped by digest with a map-side limit of one row per digest, so a payload that a third of
all pages share moves once per input task. The join on read carries only slim headers on its large
side, and adaptive execution splits a hot digest.

Defined results: null html is an empty payload; a null url has no WARC-Target-URI line, and line ends
within a url are left out; equal page
ids are told apart by nothing, so equal rows are one response and revisits of it, in undefined but
single order; a null page id is the response only if all ids of its group are null; an empty table
gives an empty archive; other columns are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored

LEAST_BYTES = 0
_DATE = "2024-01-01T00:00:00Z"  # pages carry no fetch time
_CRLF = "\r\n"
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 in base 32: five hex digits at a time are four base-32 digits."""
    digest = F.sha1(payload)
    parts = [
        F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)
    ]
    return F.translate(F.concat(*parts), "0123456789ABCDEFGHIJKLMNOPQRSTUV", _BASE32)


def _header(*lines: Column) -> Column:
    """Lines of a header, each closed by CRLF; null lines are left out."""
    return F.concat(F.concat_ws(_CRLF, F.lit("WARC/1.1"), *lines), F.lit(_CRLF + _CRLF))


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value.cast("string"))


def _urn(page_id: Column) -> Column:
    """A record's name: its page id, in a URN of the library's own."""
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def write_archive(pages: DataFrame, path: str, least: int = LEAST_BYTES) -> None:
    """Write path/payloads (address, payload) and path/headers (page_id, address, header)."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    records = pages.select(
        "page_id", "url", payload.alias("payload"), F.length(payload).cast("long").alias("size")
    ).withColumn("address", F.concat(F.sha2("payload", 256), F.lit("-"), F.col("size")))
    newest = Window.partitionBy("address").orderBy(F.desc_nulls_last("page_id"))
    stored_once = records.withColumn("n", F.row_number().over(newest)).where("n = 1")
    stored_once.select("address", "size", "payload").write.parquet(f"{path}/payloads")

    slim = records.withColumn("digest", base32_sha1(F.col("payload"))).drop("payload")
    slim = stored(slim, "archive-slim")
    owner = slim.groupBy("address").agg(F.max("page_id").alias("owner"))
    joined = slim.join(owner, "address")
    # Rows with the owner's id besides the first are copies of it as well.
    nth = F.row_number().over(Window.partitionBy("address", "page_id").orderBy("url"))
    at_owner = joined.where(F.col("page_id").eqNullSafe(F.col("owner"))).withColumn(
        "first", nth == 1
    )
    others = joined.where(~F.col("page_id").eqNullSafe(F.col("owner"))).withColumn(
        "first", F.lit(False)
    )
    all_records = at_owner.unionByName(others)
    is_response = F.col("first") | (F.col("size") < least)
    kind = F.when(is_response, F.lit("response")).otherwise(F.lit("revisit"))
    header = _header(
        _line("WARC-Type", kind),
        _line("WARC-Record-ID", _urn(F.coalesce(F.col("page_id").cast("string"), F.lit("none")))),
        _line("WARC-Date", F.lit(_DATE)),
        _line("WARC-Target-URI", F.replace(F.replace("url", F.lit("\r")), F.lit("\n"))),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(~is_response, _line("WARC-Refers-To", _urn(F.col("owner")))),
        F.when(~is_response, _line("WARC-Profile", F.lit(_REVISIT))),
        _line("Content-Length", F.when(is_response, F.col("size")).otherwise(F.lit(0))),
    )
    all_records.select("page_id", "address", header.alias("header")).write.parquet(
        f"{path}/headers"
    )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """page_id, header, payload, record and what the header says, of every record.

    record is the record's bytes as archived: header, the response's payload, two line ends.
    """
    payloads = spark.read.parquet(f"{path}/payloads").select(
        F.col("address").alias("at"), "payload", "size"
    )
    whole = F.concat(F.sha2("payload", 256), F.lit("-"), F.length("payload"))
    checked = payloads.withColumn("sha1", base32_sha1(F.col("payload"))).withColumn(
        "sound", whole == F.col("at")
    )
    headers = spark.read.parquet(f"{path}/headers")
    said = headers.select(
        "page_id",
        "address",
        "header",
        _said("WARC-Type").alias("record_type"),
        F.substring(_said("WARC-Payload-Digest"), 6, 32).alias("payload_digest"),
        F.regexp_extract("header", r"\r\nWARC-Refers-To: <urn:page:(-?[0-9]+)>", 1)
        .try_cast("long")
        .alias("refers_to"),
    )
    joined = said.join(checked, said.address == checked["at"], "left")
    sound = F.coalesce(F.col("sound") & (F.col("sha1") == F.col("payload_digest")), F.lit(False))
    broken = F.raise_error(F.concat(F.lit("payload does not match its digest: "), F.col("address")))
    verified = F.when(sound, F.col("payload")).otherwise(broken.cast("binary"))
    body = F.when(F.col("record_type") == "response", verified).otherwise(
        F.lit("").cast("binary")
    )
    return joined.select(
        "page_id",
        "header",
        verified.alias("payload"),
        F.concat(
            F.col("header").cast("binary"), body, F.lit(_CRLF + _CRLF).cast("binary")
        ).alias("record"),
        "record_type",
        "payload_digest",
        "refers_to",
    )


def _said(name: str) -> Column:
    return F.regexp_extract("header", rf"\r\n{name}: ([^\r\n]*)", 1)


def summary(records: DataFrame) -> DataFrame:
    """What the records say, with the body of each rebuilt response checked against its digest."""
    around = F.octet_length("header") + 2 * len(_CRLF)
    body = F.substring("record", F.octet_length("header") + 1, F.length("record") - around)
    # A revisit has no body; its payload is the response's, which was verified when it was joined.
    bare = (F.col("record_type") == "revisit") & (F.length(body) == 0)
    sound = bare | (base32_sha1(body) == F.col("payload_digest"))
    size = F.when(bare, F.length("payload")).otherwise(F.length(body)).cast("long")
    broken = F.raise_error(F.concat(F.lit("record can't be rebuilt: "), F.col("header")))
    return records.select(
        "page_id",
        F.when(sound, size).otherwise(broken.cast("long")).alias("payload_bytes"),
        "payload_digest",
        "record_type",
        "refers_to",
    )
