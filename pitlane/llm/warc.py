"""WARC writing, and a salvaging reader that gets past damage.

The reader walks an archive record by record.  Every record is checked: version
line, header block, Content-Length, the blank lines behind the block, and the
payload digest if there is one; for compressed archives also the gzip member's
own checksum.  When a check fails, it searches for the next gzip member or the
next version line that starts a valid record, goes on from there, and reports
the bytes between as a quarantined gap with the reason.

Archives are written by Spark's text writer and read by its ``binaryFile``
source, so they may lie in any store that Spark can open.  An archive is read
whole by one task; ``write_archives`` keeps archives to about ``archive_bytes``.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.llm.common import land

ARCHIVE_BYTES = 16 << 20
MIN_REVISIT_BYTES = 100
END = "\r\n\r\n"
_ID = "<urn:page:"

# -- writing ---------------------------------------------------------------------------------------


def _header(value: Column) -> Column:
    """A header value without control characters (they would end the line)."""
    return F.regexp_replace(value, r"[\x00-\x1f\x7f]", " ")


def plan_records(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", body_col: str = "html",
                 min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(page_id, url, body, payload_digest, payload_bytes, refers_to) per row of ``pages``.

    A null body is an empty payload.  Of rows with equal payloads of at least
    ``min_bytes``, those with the smallest id are responses (``refers_to`` null)
    and the others revisit it; smaller payloads are all responses.  Repeated rows
    each get a record.  A null id never is the smallest unless all are null.
    """
    body = F.coalesce(F.col(body_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).alias("url"), body.alias("body"))
    rows = rows.withColumn("payload_digest", F.sha2("body", 256)).withColumn(
        "payload_bytes", F.octet_length("body").cast("long"))
    # ids and digests only: the bodies don't take part in the shuffle by digest, where copies make hot keys
    keys = rows.select("page_id", "payload_digest", "payload_bytes").where(F.col("payload_bytes") >= min_bytes)
    first = keys.groupBy("payload_digest").agg(
        F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies")
    later = keys.join(first, "payload_digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to"))).select(
        F.col("page_id").alias("r_id"), F.col("payload_digest").alias("r_digest"), "refers_to").distinct()
    # written, so that its size is known when the join is planned: a small list of revisits moves no body
    later = land(later, "revisits")
    return rows.join(later, F.col("page_id").eqNullSafe(F.col("r_id")) & (F.col("payload_digest") == F.col("r_digest")),
                     "left").drop("r_id", "r_digest")


def record_text(plan: DataFrame) -> DataFrame:
    """One column ``value``: each record's header and block, without the closing blank lines."""
    revisit = F.col("refers_to").isNotNull()
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.when(revisit, F.lit(0)).otherwise(F.col("payload_bytes")).cast("string"), F.lit(END))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("body").cast("string")))
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    optional = lambda name, value: F.when(value.isNotNull(), line(name, value)).otherwise(F.lit(""))
    urn = lambda c: F.concat(F.lit(_ID), c.cast("string"), F.lit(">"))
    head = F.concat(
        F.lit("WARC/1.1\r\n"),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        optional("WARC-Record-ID", urn(F.col("page_id"))),
        optional("WARC-Target-URI", _header(F.col("url"))),
        line("WARC-Date", F.lit("1970-01-01T00:00:00Z")),
        optional("WARC-Refers-To", urn(F.col("refers_to"))),
        F.when(revisit, line("WARC-Profile", F.lit(
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))).otherwise(F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("payload_digest"))),
        F.lit("Content-Type: application/http;msgtype=response\r\n"),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit("\r\n"))
    return plan.select(F.concat(head, block).alias("value"))


def write_archives(plan: DataFrame, path: str, archive_bytes: int = ARCHIVE_BYTES) -> None:
    """Write the records of ``plan`` as uncompressed archives under ``path``.

    Each task writes its own rows, a new archive after as many records as make
    ``archive_bytes`` on average.  The text writer puts ``lineSep`` behind each record:
    the two blank lines that end it.
    """
    mean = plan.agg(F.avg("payload_bytes")).first()[0] or 0
    records = max(1, int(archive_bytes / (mean + 400)))
    record_text(plan).write.option("lineSep", END).option("compression", "none").option("maxRecordsPerFile", records).text(path)


# -- reading ---------------------------------------------------------------------------------------

_VERSION = re.compile(rb"WARC/[01]\.\d{1,2}\r?\n")
_MEMBER = b"\x1f\x8b\x08"
_BREAK = re.compile(rb"\r?\n\r?\n")
_LINE = re.compile(r"\r?\n")  # and nothing else that Unicode counts as a line's end
_SLICE = 1 << 16


class Damaged(ValueError):
    """A record or member failed a check; the message says which."""


def _headers(block: bytes) -> dict[str, str]:
    found: dict[str, str] = {}
    last = ""
    for line in _LINE.split(block.decode("utf-8", "replace")):
        if line[:1] in " \t" and last:  # a folded line goes on
            found[last] += " " + line.strip()
            continue
        name, colon, value = line.partition(":")
        if not colon:
            raise Damaged("header line without a colon")
        last = name.strip().lower()
        # a header cut short runs on into the next record's; a value may end in a version by itself
        if last in found and last != "warc-concurrent-to":
            raise Damaged("header repeated or run into another record")
        found[last] = value.strip(" \t")
    return found


def _payload(headers: dict[str, str], block: bytes) -> bytes:
    """The payload of an HTTP response block, else the block."""
    if not headers.get("content-type", "").replace(" ", "").startswith("application/http"):
        return block
    cut = _BREAK.search(block)
    return block[cut.end():] if cut else b""


def _verify_digest(headers: dict[str, str], payload: bytes) -> None:
    """Check WARC-Payload-Digest, hexadecimal or base 32; a revisit has no payload to check."""
    kind, _, value = headers.get("warc-payload-digest", "").partition(":")
    if not value or headers.get("warc-type") == "revisit" or kind.lower() not in ("sha1", "sha256", "md5"):
        return
    got = hashlib.new(kind.lower(), payload)
    if value.lower() != got.hexdigest() and value.upper().rstrip("=") != base64.b32encode(got.digest()).decode().rstrip("="):
        raise Damaged("payload digest differs")


def _record(data: bytes, at: int) -> tuple[int, dict[str, str], bytes]:
    """The record at ``at``: where it ends, its headers, its payload."""
    version = _VERSION.match(data, at)
    if not version:
        raise Damaged("no version line")
    stop = _BREAK.search(data, version.end() - 1)
    if not stop:
        raise Damaged("header block without end")
    headers = _headers(data[version.end():stop.start()])
    if not re.fullmatch(r"\d+", headers.get("content-length", "")):
        raise Damaged("no Content-Length")
    end = stop.end() + int(headers["content-length"])
    if end > len(data):
        raise Damaged("block is cut short")
    if data[end:end + 4] != END.encode():
        raise Damaged("no blank lines behind the block")
    payload = _payload(headers, data[stop.end():end])
    _verify_digest(headers, payload)
    return end + 4, headers, payload


def _members(data: bytes, at: int) -> tuple[int, bytes]:
    """The gzip member at ``at``: where it ends and what it holds; zlib checks length and CRC."""
    engine, plain, view = zlib.decompressobj(31), [], memoryview(data)
    try:
        while not engine.eof and at < len(data):  # by slices, so that what lies behind isn't copied each time
            plain.append(engine.decompress(view[at:at + _SLICE]))
            at += len(view[at:at + _SLICE])
    except zlib.error as e:
        raise Damaged(f"gzip member: {e}") from None
    if not engine.eof:
        raise Damaged("gzip member is cut short")
    return at - len(engine.unused_data), b"".join(plain)


def salvage(data: bytes) -> Iterator[tuple[str, int, int, str, dict[str, str], bytes]]:
    """(kind, offset, length, reason, headers, payload) of each record and gap, in order.

    Offsets count bytes of the archive as it is stored.  Records and gaps cover
    all of it without overlap.  Plain and compressed records may follow each other.
    """
    at = gap = 0
    line = member = -1  # the next version line and the next member start at or behind ``at``, once looked for
    why = ""

    def step(at: int) -> tuple[int, dict[str, str], bytes]:
        if data[at:at + 3] == _MEMBER:
            end, plain = _members(data, at)
            used, headers, payload = _record(plain, 0)
            if used != len(plain):
                raise Damaged("member holds more than a record")
            return end, headers, payload
        return _record(data, at)

    while at < len(data):
        try:
            end, headers, payload = step(at)
        except Damaged as e:
            why = why or str(e)
            # on to the next place where a member or a version line may start
            if line <= at:
                found = _VERSION.search(data, at + 1)
                line = found.start() if found else len(data)
            if member <= at:
                member = data.find(_MEMBER, at + 1)
                member = len(data) if member < 0 else member
            at = min(line, member)
            continue
        if gap < at:
            yield "gap", gap, at - gap, why, {}, b""
        yield "record", at, end - at, "", headers, payload
        at = gap = end
        why = ""
    if gap < len(data):
        yield "gap", gap, len(data) - gap, why, {}, b""


_RECORDS = ("archive string, kind string, offset long, length long, reason string, warc_type string, record_id string, "
            "target_uri string, refers_to string, payload_digest string, headers map<string,string>, payload binary")


def read_contents(archives: DataFrame, path_col: str = "path", content_col: str = "content",
                  payloads: bool = True) -> DataFrame:
    """Records and gaps of archives given as rows of (path, bytes).

    ``kind`` is 'record' or 'gap'.  A gap has its offset, length and reason, the
    rest is null.  A record has its headers (names in lower case) and payload, and
    ``payload_digest`` as the record states it.  A null or empty archive has neither.
    ``payloads=False`` still reads and checks payloads but returns them empty.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("archive", pa.string()), ("kind", pa.string()), ("offset", pa.int64()), ("length", pa.int64()),
                            ("reason", pa.string()), ("warc_type", pa.string()), ("record_id", pa.string()),
                            ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_digest", pa.string()),
                            ("headers", pa.map_(pa.string(), pa.string())), ("payload", pa.binary())])
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1), strict=True):
                rows, held = [], 0
                for kind, at, n, why, h, payload in salvage(content.as_py() or b""):
                    rows.append((name.as_py(), kind, at, n, why or None, h.get("warc-type"), h.get("warc-record-id"),
                                 h.get("warc-target-uri"), h.get("warc-refers-to"), h.get("warc-payload-digest"),
                                 list(h.items()) if kind == "record" else None,
                                 (payload if payloads else b"") if kind == "record" else None))
                    held += len(payload)
                    if held > 4 << 20:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)
                        rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema)

    # one archive a batch would be best; a partition holds few, as the source packs files by size
    return archives.select(F.col(path_col).alias("path"), F.col(content_col).alias("content")).mapInArrow(run, _RECORDS)


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """Records and gaps of all archives under ``path`` (see ``read_contents``)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return read_contents(files.where("length > 0"), payloads=payloads)


def gaps(rows: DataFrame) -> DataFrame:
    """The quarantine log: (archive, offset, length, reason) of each byte gap."""
    return rows.where("kind = 'gap'").select("archive", "offset", "length", "reason")


def digest_log(rows: DataFrame) -> DataFrame:
    """One slim row per record or gap: its place, and of a record ids, and length and digest of the payload that was read."""
    page = lambda c: F.regexp_extract(c, "^<urn:page:(-?[0-9]+)>$", 1).try_cast("long")
    return rows.select(
        "kind", "archive", "offset", "length", "reason",
        page(F.col("record_id")).alias("page_id"), page(F.col("refers_to")).alias("refers_to"),
        F.col("warc_type").alias("record_type"), F.substring_index("payload_digest", ":", -1).alias("stated"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha2("payload", 256).alias("payload_digest"))


def record_digests(rows: DataFrame) -> DataFrame:
    """The records of ``digest_log``, without their places."""
    return digest_log(rows.where("kind = 'record'")).drop("kind", "archive", "offset", "length", "reason")


def require_whole(log: DataFrame) -> DataFrame:
    """The records of a written ``digest_log``; fails if it has a gap, for archives that must not have any."""
    found = gaps(log)
    if lost := found.count():
        first = found.orderBy("archive", "offset").first()
        raise ValueError(f"{lost} gaps; the first: {first['length']} bytes at {first['offset']} of {first['archive']}: {first['reason']}")
    return log.where("kind = 'record'").drop("kind", "archive", "offset", "length", "reason")


def resolve_revisits(records: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    ``records`` is a written table of ``record_digests``.  A response's figures come
    from the payload that was read.  A revisit has none: its response is looked up by
    the id it refers to and the digest it states.  If that response is lost, the
    revisit keeps its stated digest and null bytes.
    """
    responses = records.where("record_type = 'response'").select(
        "page_id", "payload_bytes", "payload_digest", "record_type", F.lit(None).cast("long").alias("refers_to"))
    known = responses.where("page_id is not null").groupBy("page_id", "payload_digest").agg(
        F.max("payload_bytes").alias("payload_bytes")).withColumnsRenamed(
        {"page_id": "refers_to", "payload_digest": "stated"})
    revisits = records.where("record_type = 'revisit'").drop("payload_bytes", "payload_digest")
    found = revisits.join(known, ["refers_to", "stated"], "left").select(
        "page_id", "payload_bytes", F.col("stated").alias("payload_digest"), "record_type", "refers_to")
    return responses.unionByName(found)
