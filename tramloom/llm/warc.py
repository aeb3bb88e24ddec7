"""WARC archives with revisit resolution.

Headers (id, address, payload digest and length) are shuffled by digest, without payloads. Of the records with one
payload the one with the largest id is the response, the others become revisit records that refer to it. Records with
fresh headers are written by Spark's text writer, whose separator is the two CRLFs that end a record; they are read
back by their Content-Length, and revisits are joined to the responses they refer to.

Defined results: a null html is an empty payload; CR and LF in addresses and ids are percent-encoded, a null address
is left out, a null id has a name of its own; rows alike are each a record, and those that share the largest id are all responses; a null id is below all
others, and where all of a payload's ids are null all are responses.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tramloom.llm.common import col, fresh_path, materialize, spread_join

#: Bytes of records that one archive holds on average; an archive is read back whole by one task.
ARCHIVE_BYTES = 16_000_000
#: Bytes that a record's headers count as.
HEAD_BYTES = 500
_END = "\r\n\r\n"
# The base32 alphabet, the profile's and the format's names
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def sha1_base32(payload: Column) -> Column:
    """Bare upper-case base32 of the SHA-1 of a binary column: 5 hex digits give 4 letters."""
    digits = F.sha1(payload)
    letters = []
    for i in range(8):
        v = F.conv(F.substring(digits, 5 * i + 1, 5), 16, 10).cast("int")
        letters += [F.substring(F.lit(_BASE32), F.shiftright(v, s).bitwiseAND(F.lit(31)) + 1, F.lit(1)) for s in (15, 10, 5, 0)]
    return F.concat(*letters)


def resolve_revisits(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """id, url, digest, bytes, refers_to (null for responses) of every row, without payloads."""
    payload = F.coalesce(col(html), F.lit("")).cast("binary")
    heads = materialize(pages.select(col(key).alias("id"), col(url).alias("url"), sha1_base32(payload).alias("digest"), F.octet_length(payload).cast("long").alias("bytes")), "heads")
    # only payloads held twice need a join
    first = heads.where(F.col("bytes") >= min_bytes).groupBy("digest").agg(F.max("id").alias("original"), F.count("*").alias("n")).where("n > 1")
    joined = spread_join(heads, materialize(first, "originals"), "digest", "n", "left")
    other = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original")) & (F.col("bytes") >= min_bytes)
    return joined.select("id", "url", "digest", "bytes", F.when(other, F.col("original")).alias("refers_to"))


_ESCAPES = (("%", "%25"), ("\r", "%0D"), ("\n", "%0A"))


def _name(ident: Column) -> Column:
    """The record id of a page id, whatever characters it has."""
    text = ident.cast("string")
    for plain, code in _ESCAPES:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return F.coalesce(F.concat(F.lit("<urn:page:"), text, F.lit(">")), F.lit("<urn:page>"))


def _ident(name: Column, kind: str) -> Column:
    """The page id of a record id."""
    text = F.regexp_extract(name, "^<urn:page:(.*)>$", 1)
    for plain, code in reversed(_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return F.when(name != "<urn:page>", text).cast(kind)


def _header(name: str, value: Column) -> Column:
    return F.coalesce(F.concat(F.lit(name + ": "), value, F.lit("\r\n")), F.lit(""))


def record(digest: Column, size: Column, refers_to: Column, ident: Column, url: Column, payload: Column) -> Column:
    """One record but for the separator at its end."""
    revisit = refers_to.isNotNull()
    address = F.replace(F.replace(url, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _header("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        _header("WARC-Record-ID", _name(ident)),
        _header("WARC-Date", F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        _header("WARC-Target-URI", address),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha1:"), digest)),
        F.when(revisit, F.concat(_header("WARC-Refers-To", _name(refers_to)), _header("WARC-Profile", F.lit(_PROFILE)))).otherwise(F.lit("")),
        F.lit("Content-Type: text/html; charset=utf-8\r\nContent-Length: "),
        F.when(revisit, F.lit(0)).otherwise(size).cast("string"),
        F.lit(_END),
        F.when(revisit, F.lit("")).otherwise(payload),
    )


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0, archive_bytes: int = ARCHIVE_BYTES, compression: str = "gzip") -> None:
    """Write all pages as deduplicated WARC archives into the folder path, responses and revisits in archives of bounded size each; with gzip an archive is one member."""
    heads = materialize(resolve_revisits(pages, key, url, html, min_bytes), "resolved")
    kept, again = heads.where("refers_to is null"), heads.where("refers_to is not null")
    payload = F.coalesce(col(html), F.lit(""))
    held, n, revisits = heads.agg(F.sum(F.when(F.col("refers_to").isNull(), F.col("bytes"))), F.count_if(F.col("refers_to").isNull()), F.count_if(F.col("refers_to").isNotNull())).first()
    many = lambda size: max(1, -(-size // archive_bytes))
    archives, more = many((held or 0) + HEAD_BYTES * n), many(HEAD_BYTES * revisits)
    # each row that is a response writes its own payload, so payloads shuffle once, into as many archives as their size asks for
    k = F.xxhash64("id", "digest").alias("k")
    bodies = pages.select(col(key).alias("id"), col(url).alias("url"), payload.alias("payload"), sha1_base32(payload.cast("binary")).alias("digest"))
    chosen = kept.select(k).distinct().repartition(archives, "k")  # dealt alike, so that the join moves no payload again
    full = bodies.select("*", k).repartition(archives, "k").join(chosen, "k")
    lines = lambda df, size, to, body: df.select(record(F.col("digest"), size, to, F.col("id"), F.col("url"), body).alias("value"))
    own = lines(full, F.octet_length("payload"), F.lit(None).cast("string"), F.col("payload"))
    own.unionByName(lines(again.repartition(more), F.col("bytes"), F.col("refers_to"), F.lit(""))).write.option("lineSep", _END).option("compression", compression).text(path)


_LINE = re.compile(rb"([^:\r\n]+): ?([^\r\n]*)")


def parse_records(data: bytes) -> Iterator[tuple[dict[bytes, bytes], bytes]]:
    """(headers, payload) of each record of an archive, gzipped or not."""
    data = gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data
    at = 0
    while at < len(data):
        cut = data.index(b"\r\n\r\n", at)
        headers = dict(_LINE.findall(data, at, cut))
        size = int(headers[b"Content-Length"])
        yield headers, data[cut + 4 : cut + 4 + size]
        at = cut + 4 + size + 4


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """record_id, type, url, digest, refers_to (a record id) and payload of every record."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = (b"WARC-Record-ID", b"WARC-Type", b"WARC-Target-URI", b"WARC-Payload-Digest", b"WARC-Refers-To")
        for b in batches:
            for i in range(b.num_rows):
                cols: list[list] = [[] for _ in range(6)]
                for headers, payload in parse_records(b.column("content")[i].as_py()):
                    for c, name in zip(cols, names, strict=False):
                        c.append(headers.get(name))
                    cols[5].append(payload)
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.binary()).cast(pa.string()) for c in cols[:5]], pa.array(cols[5], pa.binary())], names=["record_id", "type", "url", "digest", "refers_to", "payload"])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")
    return files.mapInArrow(parse, "record_id string, type string, url string, digest string, refers_to string, payload binary")


def archived_pages(pages: DataFrame, path: str | None = None, key: str = "page_id", url: str = "url", html: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write pages to archives and read them back: key, payload_bytes, payload_digest, record_type, refers_to.

    Lengths and digests are those of the payloads read; a revisit's come from the response it refers to.
    """
    spark = pages.sparkSession
    path = path or fresh_path(spark, "warc")
    kind = pages.schema[key].dataType.simpleString()
    write_archives(pages, path, key, url, html, min_bytes)
    read = read_archives(spark, path).select("record_id", F.col("type").alias("record_type"), "refers_to", F.substring("digest", 6, 32).alias("stated"), F.octet_length("payload").cast("long").alias("n"), sha1_base32(F.col("payload")).alias("found"))
    read = materialize(read, "archived")
    responses = read.where("record_type = 'response'")
    own = responses.select("record_id", "record_type", "refers_to", F.col("n").alias("payload_bytes"), F.col("found").alias("payload_digest"))
    revisits = read.where("record_type = 'revisit'")
    asked = revisits.groupBy(F.col("refers_to").alias("original"), F.col("stated").alias("payload_digest")).agg(F.count("*").alias("asked"))
    originals = responses.select(F.col("record_id").alias("original"), F.col("found").alias("payload_digest"), F.col("n").alias("payload_bytes")).dropDuplicates(["original", "payload_digest"])
    originals = materialize(originals.join(asked, ["original", "payload_digest"]), "asked")
    revisits = revisits.select("record_id", "record_type", "refers_to", F.col("refers_to").alias("original"), F.col("stated").alias("payload_digest"))
    revisits = spread_join(revisits, originals, ["original", "payload_digest"], "asked")
    every = own.unionByName(revisits.select("record_id", "record_type", "refers_to", "payload_bytes", "payload_digest"))
    return every.select(_ident(F.col("record_id"), kind).alias(key), "payload_bytes", "payload_digest", "record_type", _ident(F.col("refers_to"), kind).alias("refers_to"))
