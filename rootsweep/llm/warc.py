"""Operator 4: content-addressed WARC archive.

``write`` makes one WARC/1.1 record per page and stores it in two tables: ``heads``
has each record's exact header bytes (WARC and HTTP), ``payloads`` each distinct
payload once under its SHA-256 and length. ``records`` joins them back to the exact
record bytes, verifying each payload against its address; ``parse`` reads such bytes;
``originals`` gives every page's payload, of revisits too.

Of records with equal payloads of at least ``min_bytes`` bytes the one with the
smallest page_id is the response, the others are revisits that name it (the first
stored, where an id repeats). Shorter payloads are responses all.

Cases: a null html is an empty payload; a null url is an empty target; control
characters and spaces in a url are written as %20; page ids of any type are written as
percent-encoded text and read back as that type; a null page_id is larger than any other and
is written as ``()`` (null again when read); repeated rows are records of
their own; an empty table gives empty archives; other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rootsweep.llm.common import own_columns, stored

CRLF = "\r\n"
DATE = "2024-01-01T00:00:00Z"
#: A null page id (percent-encoded text has no parentheses).
NO_ID = "()"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Digits of radix 32 and of base32 (fixed values).
_RADIX, _BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


class Archive(NamedTuple):
    heads: DataFrame     # record_id, page_id, type, sha256, size, head
    payloads: DataFrame  # sha256, size, payload


def sha1_base32(payload: Column) -> Column:
    """SHA-1 in base32: 40 hex digits are 8 groups of 20 bits, 4 digits each."""
    digits = F.sha1(payload)
    groups = [F.lpad(F.conv(F.substring(digits, 1 + 5 * i, 5), 16, 32), 4, "0") for i in range(8)]
    return F.translate(F.concat(*groups), _RADIX, _BASE32)


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _uuid(*parts: Column) -> Column:
    h = F.md5(F.concat_ws("\n", *parts))
    return F.concat(F.lit("<urn:uuid:"), *[x for i, (a, n) in enumerate(((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
                                           for x in ((F.lit("-"),) if i else ()) + (F.substring(h, a, n),)], F.lit(">"))


def write(pages: DataFrame, min_bytes: int = 0, id_col: str = "page_id", url_col: str = "url",
          html_col: str = "html") -> Archive:
    """Store one record per row of ``pages``. Payload bytes move once (to be stored
    under their address); which record is the response is a minimum per address with
    partial aggregates, and the join back to the records carries no payload."""
    rows = own_columns(pages, id_col, url_col, html_col).toDF("page_id", "url", "html")
    payload = F.coalesce(F.col("html").cast("binary"), F.lit("").cast("binary"))
    rows = rows.select("page_id", F.coalesce("url", F.lit("")).alias("url"), payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("sha256"), F.octet_length("payload").cast("bigint").alias("size"),
        sha1_base32(F.col("payload")).alias("digest"), F.monotonically_increasing_id().alias("row"))
    # row numbers and digests are fixed by writing them out; payloads go to their own table once
    kept = stored(rows.select("page_id", "url", "sha256", "size", "digest", "row"), "warc")
    payloads = stored(rows.groupBy("sha256", "size").agg(F.first("payload").alias("payload")), "warc")
    first = kept.groupBy("sha256", "size").agg(F.min(F.struct(F.col("page_id").isNull(), "page_id", "row")).alias("m")).select(
        "sha256", "size", F.col("m.page_id").alias("first_id"), F.col("m.row").alias("first_row"))
    out = kept.join(first, ["sha256", "size"]).withColumn(
        "revisit", (F.col("size") >= min_bytes) & (F.col("row") != F.col("first_row")))
    page, first_page = (F.coalesce(F.url_encode(F.col(c).cast("string")), F.lit(NO_ID)) for c in ("page_id", "first_id"))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"),
                    _field("Content-Length", F.col("size").cast("string")), F.lit(CRLF))
    target = F.regexp_replace("url", "[\\x00-\\x20\\x7F]", "%20")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}"),
        _field("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        _field("WARC-Record-ID", _uuid(page, F.col("digest"), F.col("row").cast("string"))),
        _field("WARC-Target-URI", target), _field("WARC-Date", F.lit(DATE)), _field("WARC-Page-ID", page),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(F.col("revisit"), F.concat(
            _field("WARC-Profile", F.lit(PROFILE)),
            _field("WARC-Refers-To", _uuid(first_page, F.col("digest"), F.col("first_row").cast("string"))),
            _field("WARC-Refers-To-Page", first_page))).otherwise(F.lit("")),
        _field("Content-Type", F.lit("application/http; msgtype=response")),
        _field("Content-Length", (F.octet_length(http) + F.when(F.col("revisit"), 0).otherwise(F.col("size"))).cast("string")),
        F.lit(CRLF), http)
    heads = out.select("page_id", F.when(F.col("revisit"), "revisit").otherwise("response").alias("type"),
                       "sha256", "size", head.cast("binary").alias("head"))
    return Archive(stored(heads, "warc"), payloads)


def _verified(payload: Column, sha256: Column) -> Column:
    """The payload, if it is there and still has its digest."""
    return F.when(F.sha2(payload, 256) == sha256, payload).otherwise(
        F.raise_error(F.concat(F.lit("payload missing or damaged: "), sha256)))


def records(archive: Archive) -> DataFrame:
    """Exact bytes of every record. A response finds its payload by its address (few
    rows share one, as equal payloads are revisits); revisits have none and skip the join."""
    tail = F.lit(CRLF * 2).cast("binary")
    full = archive.heads.where("type = 'response'").join(archive.payloads, ["sha256", "size"], "left")
    return full.select(F.concat("head", _verified(F.col("payload"), F.col("sha256")), tail).alias("record")).unionAll(
        archive.heads.where("type = 'revisit'").select(F.concat("head", tail).alias("record")))


def originals(archive: Archive) -> DataFrame:
    """page_id and full payload of every record, revisits too. A payload that many
    records share is repeated once per 1,000 of them, so no join key is hot; a bounded
    list of such payloads is broadcast, beyond it records keep to the first copy."""
    many = archive.heads.groupBy("sha256", "size").count().select(
        "sha256", "size", F.ceil(F.col("count") / 1000).cast("int").alias("salts"))
    spread = archive.payloads.join(many, ["sha256", "size"]).withColumn("salt", F.explode(F.expr("sequence(0, salts - 1)")))
    heads = archive.heads.join(F.broadcast(many.where("salts > 1").limit(100_000)), ["sha256", "size"], "left").withColumn(
        "salt", F.pmod(F.xxhash64("head"), F.coalesce("salts", F.lit(1))).cast("int")).drop("salts")
    return heads.join(spread, ["sha256", "size", "salt"]).select(
        "page_id", _verified(F.col("payload"), F.col("sha256")).alias("payload"))


def _value(head: str, name: str) -> Column:
    return F.regexp_extract(head, rf"(?m)^{name}: ([^\r\n]*)$", 1)


def parse(records: DataFrame, record_col: str = "record", id_type: str = "bigint") -> DataFrame:
    """Fields of WARC records (page ids as ``id_type``): page_id, target_uri, record_type, payload_digest,
    payload_bytes, refers_to, payload (null for revisits). The digest and size of a
    stored payload are checked against its headers."""
    text = F.decode(F.col(record_col), "ISO-8859-1")  # bytes as characters: offsets stay
    out = records.select(F.col(record_col).alias("record"), F.substring_index(text, CRLF * 2, 1).alias("warc"),
                         F.substring_index(text, CRLF * 2, 2).alias("both"))
    out = out.select("record", F.concat("warc", F.lit(CRLF)).alias("warc"), F.expr("length(both)").alias("at"),
                     F.concat(F.expr("substring(both, length(warc) + 5)"), F.lit(CRLF)).alias("http"))
    out = out.select(
        _value("warc", "WARC-Page-ID").alias("page"), F.decode(F.encode(_value("warc", "WARC-Target-URI"), "ISO-8859-1"), "UTF-8").alias("target_uri"),
        _value("warc", "WARC-Type").alias("record_type"),
        F.regexp_extract("warc", r"(?m)^WARC-Payload-Digest: sha1:([A-Z2-7]+)$", 1).alias("payload_digest"),
        _value("http", "Content-Length").try_cast("bigint").alias("payload_bytes"),
        _value("warc", "WARC-Refers-To-Page").alias("refers"),
        F.expr("substring(record, at + 5, length(record) - at - 8)").alias("payload"))
    good = (F.col("record_type") == "revisit") | ((F.octet_length("payload") == F.col("payload_bytes"))
                                                 & (sha1_base32(F.col("payload")) == F.col("payload_digest")))
    stored_payload = F.when(good, F.when(F.col("record_type") == "response", F.col("payload"))).otherwise(
        F.raise_error(F.concat(F.lit("record is damaged: "), F.col("page"))).cast("binary"))
    page_id = lambda c: F.when(F.col(c) != NO_ID, F.url_decode(c).try_cast(id_type))
    return out.select(page_id("page").alias("page_id"), "target_uri", "record_type", "payload_digest", "payload_bytes",
                      F.when(F.col("record_type") == "revisit", page_id("refers")).alias("refers_to"), stored_payload.alias("payload"))


def archived_pages(pages: DataFrame, min_bytes: int = 0) -> DataFrame:
    """Write an archive of all pages, read its records back and report each."""
    return parse(records(write(pages, min_bytes)), id_type=dict(pages.dtypes)["page_id"]).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
        (F.octet_length("payload").isNull() == (F.col("record_type") == "revisit")).alias("read_back"))
