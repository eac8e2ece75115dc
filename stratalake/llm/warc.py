"""WARC archives: writing and reading them with Spark, and resolving records with equal payloads to revisits."""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.session import work_folder

# Names and values of the WARC 1.1 format, and the alphabet of base32.
VERSION = "WARC/1.1"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
# Named fields of our own: the number a record had in its table, and that of the record it refers to.
KEY, REFERS_KEY = "X-Key", "X-Refers-To-Key"
CRLF = "\r\n"
SLICE_LINES, BATCH_BYTES = 2048, 1 << 23

HEADER_FIELDS = (
    "record_id string, record_type string, key long, uri string, date string, payload_digest string, strong_digest binary, "
    "payload_bytes long, refers_id string, refers_key long, refers_uri string, refers_date string"
)
_ARROW = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def base32_sha1(payload: Column) -> Column:
    """SHA-1 in base32, of text or bytes: 40 bits (ten hexadecimal digits) make eight digits to the base 32."""
    digits = "".join("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"[i] for i in range(32))
    code = F.sha1(payload)
    parts = [F.lpad(F.conv(F.substring(code, at, 10), 16, 32), 8, "0") for at in (1, 11, 21, 31)]
    return F.translate(F.concat(*parts), digits, BASE32)


def uuid_of(*parts: Column) -> Column:
    """A record id that depends on the values only, so that a repeated task writes the same one."""
    code = F.sha1(F.concat_ws(" ", *parts))
    cut = [F.substring(code, at, n) for at, n in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    return F.concat(cut[0], F.lit("-"), cut[1], F.lit("-5"), cut[2], F.lit("-8"), cut[3], F.lit("-"), cut[4])


# --- writing --------------------------------------------------------------------------------------


def _field(name: str, value: Column) -> Column:
    """One header line; nothing where the value is null. Control characters and blanks cannot stand in it."""
    safe = F.regexp_replace(value.cast("string"), r"[\x00-\x20\x7F]+", "%20")
    return F.coalesce(F.concat(F.lit(f"{name}: "), safe, F.lit(CRLF)), F.lit(""))


def record_text(row: dict[str, Column]) -> Column:
    """A whole WARC record but for its last line feed, which the text writer adds.

    The block is an HTTP response. That of a revisit has no body; its HTTP length still tells the size of the payload.
    """
    revisit = row["record_type"] == "revisit"
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "), row["payload_bytes"].cast("string"), F.lit(CRLF * 2))
    block = F.concat(http, F.when(revisit, F.lit("")).otherwise(row["payload"].cast("string")))
    urn = F.lit("<urn:uuid:")
    digest = F.concat(F.lit("sha1:"), row["payload_digest"])
    fields = [
        _field("WARC-Type", row["record_type"]), _field("WARC-Record-ID", F.concat(urn, row["record_id"], F.lit(">"))),
        _field("WARC-Date", row["date"]), _field("WARC-Target-URI", row["uri"]), _field(KEY, row["key"]),
        _field("WARC-Payload-Digest", digest), _field("WARC-Block-Digest", F.concat(F.lit("sha1:"), base32_sha1(block))),
        _field("WARC-Profile", F.when(revisit, F.lit(IDENTICAL))),
        _field("WARC-Refers-To", F.when(revisit, F.concat(urn, row["refers_id"], F.lit(">")))),
        _field("WARC-Refers-To-Target-URI", F.when(revisit, row["refers_uri"])),
        _field("WARC-Refers-To-Date", F.when(revisit, row["refers_date"])), _field(REFERS_KEY, F.when(revisit, row["refers_key"])),
        F.lit(f"Content-Type: application/http;msgtype=response{CRLF}Content-Length: "), F.octet_length(block).cast("string"),
    ]
    return F.concat(F.lit(VERSION + CRLF), *fields, F.lit(CRLF * 2), block, F.lit(CRLF + "\r"))


def write_archives(records: DataFrame, folder: str, level: str = "BEST_SPEED") -> None:
    """Write records as gzip archives, one per task, without a shuffle. Columns: HEADER_FIELDS but the strong digest, and payload.

    ``level`` is Hadoop's compression level. The fastest takes a third of the time and a tenth more space than the default.
    """
    made = record_text({name: F.col(name) for name in records.columns})
    packed = records.select(made.alias("value")).write.option("compression", "gzip").option("zlib.compress.level", level)
    packed.option("lineSep", "\n").text(folder)


def capture(pages: DataFrame, id_column: str = "page_id", uri_column: str = "url", payload_column: str = "html") -> DataFrame:
    """A response record for each row, ready to be written. A null payload is empty, a null id or address gives no such field."""
    given = pages.select(
        pages[id_column].cast("long").alias("key"), pages[uri_column].cast("string").alias("uri"),
        F.coalesce(pages[payload_column].cast("string"), F.lit("")).alias("payload"),
    )
    numbered = given.withColumn("row", F.monotonically_increasing_id())
    none = F.lit(None).cast("string")
    return numbered.select(
        uuid_of(F.lit(uuid.uuid4().hex), F.col("row").cast("string")).alias("record_id"), F.lit("response").alias("record_type"), "key", "uri",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("date"), base32_sha1(F.col("payload")).alias("payload_digest"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), none.alias("refers_id"), none.cast("long").alias("refers_key"),
        none.alias("refers_uri"), none.alias("refers_date"), "payload",
    )


# --- reading --------------------------------------------------------------------------------------


class Damaged(ValueError):
    """An archive that does not follow the format."""


def _named(block: bytes) -> dict[str, str]:
    """Header fields by lower-case name; a line that starts with a blank continues the one before."""
    fields: dict[str, str] = {}
    name = None
    for line in block.split(b"\r\n"):
        text = line.decode("utf-8", "replace")
        if text[:1] in (" ", "\t") and name:
            fields[name] += " " + text.strip()
        elif ":" in text:
            name, _, value = text.partition(":")
            name = name.strip().lower()
            fields[name] = value.strip()
    return fields


def records_of(stream: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header fields, block) of the records in a stream of bytes that comes in stretches of any length."""
    held, wanted, header = bytearray(), 1, None
    for stretch in stream:
        held += stretch
        while len(held) >= wanted:
            if header is None:
                blank = len(held) - len(held.lstrip(b"\r\n"))
                if blank:
                    del held[:blank]
                end = held.find(b"\r\n\r\n")
                if held and not (held.startswith(b"WARC/1.") or b"WARC/1.".startswith(held[:7])):
                    raise Damaged(f"no record starts at {bytes(held[:40])!r}")
                if end < 0:
                    wanted = len(held) + 1
                    break
                header = _named(bytes(held[:end]))
                if not header.get("content-length", "").isdigit():
                    raise Damaged(f"a record without a length: {header}")
                del held[: end + 4]
                wanted = int(header["content-length"])
            else:
                yield header, bytes(held[:wanted])
                del held[:wanted]
                header, wanted = None, 1
    if header is not None or held.strip(b"\r\n"):
        raise Damaged("an archive ends inside a record")


def _payload(header: dict[str, str], block: bytes) -> tuple[bytes, int]:
    """The payload of a block and its whole length, which a block without it states in its HTTP header."""
    if not header.get("content-type", "").startswith("application/http"):
        return block, len(block)
    top, _, body = block.partition(b"\r\n\r\n")
    length = _named(top).get("content-length", "")
    without = header.get("warc-type") == "revisit" and length.isdigit()
    return body, int(length) if without else len(body)


def _urn(value: str | None) -> str | None:
    return value.strip("<>").removeprefix("urn:uuid:") if value else None


def _whole(value: str | None) -> int | None:
    return int(value) if value and value.lstrip("-").isdigit() else None


def _row(header: dict[str, str], block: bytes, with_payload: bool) -> tuple:
    payload, length = _payload(header, block)
    digest, strong = header.get("warc-payload-digest", "").removeprefix("sha1:") or None, None
    if header.get("warc-type") != "revisit":
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        strong = None if with_payload else hashlib.sha256(payload).digest()
    made = (
        _urn(header.get("warc-record-id")), header.get("warc-type"), _whole(header.get(KEY.lower())), header.get("warc-target-uri"),
        header.get("warc-date"), digest, strong, length, _urn(header.get("warc-refers-to")), _whole(header.get(REFERS_KEY.lower())),
        header.get("warc-refers-to-target-uri"), header.get("warc-refers-to-date"),
    )
    return (*made, payload) if with_payload else made


def read_archives(spark: SparkSession, folder: str, payload: bool = False) -> DataFrame:
    """The records of gzip archives: HEADER_FIELDS and, if asked for, the payload.

    Spark unpacks an archive and hands on its lines in order (gzip files are never split); records are cut by their stated
    length, so a task holds one record and a few lines. Digests and lengths are those of the payload read; of a revisit,
    those stated. Archives with one gzip member per record, or one in all, are read alike. A damaged archive is an error.
    """
    fields = HEADER_FIELDS + ", payload binary" * payload
    types = pa.schema([(f.split()[0], _ARROW[f.split()[1]]) for f in fields.split(", ")])

    def lines(batches: Iterable[pa.RecordBatch]) -> Iterator[bytes]:
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_LINES):
                yield b"\n".join(batch.column(0).slice(at, SLICE_LINES).to_pylist()) + b"\n"

    def parse(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for header, block in records_of(lines(batches)):
            rows.append(_row(header, block, payload))
            size += len(block) if payload else 500
            if size > BATCH_BYTES:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)
                rows, size = [], 0
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), types)], schema=types)

    text = spark.read.option("lineSep", "\n").text(folder)
    return text.select(F.col("value").cast("binary").alias("value")).mapInArrow(parse, fields)


# --- revisits -------------------------------------------------------------------------------------


def revisits(headers: DataFrame, min_bytes: int = 0) -> DataFrame:
    """The records that repeat an earlier-chosen response: record_id, refers_id, refers_key, refers_uri, refers_date.

    Of responses with equal payloads (SHA-1, SHA-256 and length) of at least ``min_bytes`` the one with the largest key is the
    original, of equal keys that with the largest record id; a null key is the smallest. The others refer to it. A record that came as a
    revisit refers to the original of its stated digest; where there is none it is not returned and keeps what it refers to.

    Only headers are shuffled. Originals are found by a grouping that combines in the map tasks; the join back is on the
    digests, one row per payload on one side, so that Spark can split a payload that a third of all records share.
    """
    responses = headers.where((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_bytes))
    best = F.max(F.struct("key", "record_id", "uri", "date"))
    same = ["payload_digest", "strong_digest", "payload_bytes"]
    found = F.col("best.record_id"), F.col("best.key"), F.col("best.uri"), F.col("best.date")
    named = [c.alias(n) for c, n in zip(found, ("refers_id", "refers_key", "refers_uri", "refers_date"))]
    originals = responses.groupBy(*same).agg(best.alias("best")).select(*same, *named)
    again = responses.select("record_id", *same).join(originals, same).where("record_id <> refers_id")
    by_digest = responses.groupBy("payload_digest").agg(best.alias("best")).select("payload_digest", *named)
    came = headers.where("record_type = 'revisit'").select("record_id", "payload_digest").join(by_digest, "payload_digest")
    columns = ["record_id", "refers_id", "refers_key", "refers_uri", "refers_date"]
    return again.select(*columns).unionByName(came.select(*columns))


def deduplicate(spark: SparkSession, source: str, target: str, min_bytes: int = 0) -> None:
    """Rewrite the archives of ``source`` as archives in ``target`` in which each payload stands once, under fresh headers.

    Headers are read and resolved first and the revisits stored. The payloads are then read, matched with that table by record
    id and written. Spark knows the table's size from its files: it broadcasts a small one, so payloads are not shuffled, and
    joins a large one by a shuffle. Records of other types are left out.
    """
    folder = work_folder(spark, "revisits")
    read_archives(spark, source).write.parquet(folder + "/headers")
    headers = spark.read.schema(HEADER_FIELDS).parquet(folder + "/headers")
    revisits(headers, min_bytes).write.parquet(folder + "/revisits")
    names = ("refers_id", "refers_key", "refers_uri", "refers_date")
    known = spark.read.schema("record_id string, refers_id string, refers_key long, refers_uri string, refers_date string").parquet(folder + "/revisits")
    known = known.select(F.col("record_id").alias("of"), *[F.col(n).alias(f"new_{n}") for n in names])
    records = read_archives(spark, source, payload=True).where(F.col("record_type").isin("response", "revisit"))
    joined = records.join(known, F.col("record_id") == F.col("of"), "left")
    fresh = joined.withColumns({n: F.coalesce(F.col(f"new_{n}"), F.col(n)) for n in names})
    fresh = fresh.withColumn("record_type", F.when(F.col("of").isNotNull(), "revisit").otherwise(F.col("record_type")))
    renewed = {n: F.when(F.col(n).isNotNull(), uuid_of(F.lit("deduplicated"), F.col(n))) for n in ("record_id", "refers_id")}
    write_archives(fresh.withColumns(renewed).drop("of", "strong_digest", *[f"new_{n}" for n in names]), target)


def resolve_pages(pages: DataFrame, min_bytes: int = 0, folder: str | None = None, id_column: str = "page_id", uri_column: str = "url", payload_column: str = "html") -> DataFrame:
    """Pages through archives: page_id, payload_bytes, payload_digest, record_type, refers_to, read from deduplicated archives.

    Every row becomes a response record of archives in ``folder``/captured; ``deduplicate`` rewrites them to ``folder``/archives, and the
    headers of those are returned. A null payload is the empty one, which is a payload like others. Ids may be null (smallest) or repeat: of
    rows with the largest id one stays a response. Very long payloads are one record. No rows give no rows; other columns are not read.
    """
    spark = pages.sparkSession
    folder = folder or work_folder(spark, "warc")
    write_archives(capture(pages, id_column, uri_column, payload_column), folder + "/captured")
    deduplicate(spark, folder + "/captured", folder + "/archives", min_bytes)
    return read_archives(spark, folder + "/archives").select(
        F.col("key").alias(id_column), "payload_bytes", "payload_digest", "record_type", F.col("refers_key").alias("refers_to")
    )
