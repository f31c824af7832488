"""WARC archives: writing with segments and revisits, and reassembly on reading.

A payload goes out as an HTTP response in chunked transfer framing. A block longer than a
segment becomes a first record and continuation records; reading groups those by origin
identifier, orders them by segment number, verifies the total length and then undoes the
chunks. Records with a payload that was already written are revisits of the first one.
"""

import base64
import datetime
import hashlib
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import functions as F

from llm.frames import mapped, scratch_path
from llm.words import slices

#: Code points in a chunk and in a segment; records in an archive file.
CHUNK, SEGMENT, FILE_RECORDS = 8192, 24576, 5000
VERSION, BREAK = b"WARC/1.1\r\n", "\r\n"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def payload_digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(text, size=CHUNK):
    """Chunked transfer framing of a text in UTF-8; no character is cut."""
    parts = [text[i:i + size] for i in range(0, len(text), size)]
    return "".join(f"{len(p.encode()):x}\r\n{p}\r\n" for p in parts) + "0\r\n\r\n"


def unchunked(body):
    """The payload of a chunked body, or None where the framing is broken."""
    parts, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        try:
            size = int(body[at:end].split(b";")[0], 16) if end >= 0 else -1
        except ValueError:
            size = -1
        if size < 0 or (size and body[end + 2 + size:end + 4 + size] != b"\r\n"):
            return None
        if not size:
            return b"".join(parts)
        parts.append(body[end + 2:end + 2 + size])
        at = end + 4 + size


def _record(fields, block):
    fields = [*fields, ("Content-Length", len(block.encode()))]
    return VERSION.decode() + "".join(f"{k}: {v}\r\n" for k, v in fields) + BREAK + block


def records_of(page_id, url, html, refers_to, revisit, date, segment=SEGMENT):
    """The records of one page as text, without the two line ends that close each."""
    payload = html.encode()
    own = f"<urn:uuid:{uuid.uuid4()}>"
    url = "".join(c for c in url if c >= " ")
    common = [("WARC-Date", date), ("WARC-Target-URI", url)]
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", own),
              *common, ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
              ("Content-Type", "application/http; msgtype=response")]
    if page_id is not None:
        fields.append(("Page-ID", page_id))
    if revisit:
        fields += [("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/"
                                    "identical-payload-digest"), ("Refers-To-Page-ID", refers_to)]
        return [_record(fields, f"{_HTTP}Content-Length: {len(payload)}\r\n\r\n")]
    block = f"{_HTTP}Transfer-Encoding: chunked\r\n\r\n{chunked(html)}"
    if len(block) <= segment:
        return [_record(fields, block)]
    parts = [block[i:i + segment] for i in range(0, len(block), segment)]
    out = [_record([*fields, ("WARC-Segment-Number", 1)], parts[0])]
    for number, part in enumerate(parts[1:], 2):
        more = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"),
                *common, ("WARC-Segment-Number", number), ("WARC-Segment-Origin-ID", own)]
        if number == len(parts):
            more.append(("WARC-Segment-Total-Length", len(block.encode())))
        out.append(_record(more, part))
    return out


def _rendered(segment):
    def render(batches):
        date = datetime.datetime.now(datetime.timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
        for whole in batches:
            for batch in slices(whole, "html", 4 << 20):
                rows = zip(*(batch.column(c).to_pylist() for c in (
                    "page_id", "url", "html", "refers_to", "revisit")))
                records = [r for page_id, url, html, refers_to, revisit in rows
                           for r in records_of(page_id, url or "", html or "", refers_to,
                                               revisit, date, segment)]
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.string())], ["value"])
    return render


def with_revisits(pages):
    """Adds ``refers_to`` and ``revisit``: equal payloads point to the smallest page_id.

    Only ids and digests meet by payload, so a payload that a third of all rows share is
    aggregated before the shuffle; its text never travels by that key.
    """
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"),
                        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
    rows = rows.withColumn("same", F.sha2("html", 256))
    firsts = rows.groupBy("same").agg(F.min("page_id").alias("first"))
    revisits = rows.select("page_id", "same").join(firsts, "same") \
        .where(~F.col("page_id").eqNullSafe(F.col("first"))) \
        .select(F.col("page_id").alias("p"), F.col("same").alias("s"),
                F.col("first").alias("refers_to")).distinct()
    on = rows["page_id"].eqNullSafe(F.col("p")) & (rows["same"] == F.col("s"))
    return rows.join(revisits, on, "left").select(
        "page_id", "url", "html", "refers_to", F.col("p").isNotNull().alias("known"), "s") \
        .withColumn("revisit", F.col("s").isNotNull()).drop("s", "known")


def write_archives(pages, path, segment=SEGMENT):
    """Write ``pages(page_id, url, html)`` as gzipped WARC files into the folder ``path``.

    Spark's text writer closes each record with the two line ends that the format asks for,
    so the files land wherever Spark can write and a lost task is simply run again.
    """
    mapped(with_revisits(pages), _rendered(segment), "value string").write \
        .option("lineSep", "\r\n\r\n").option("compression", "gzip") \
        .option("maxRecordsPerFile", FILE_RECORDS).text(path)


_PARTS = ("id string, type string, page_id long, refers_to long, digest string, "
          "segment int, origin string, total long, block binary")


def parse_records(data):
    """(fields, block) of each record, cut by its Content-Length."""
    at = 0
    while at < len(data):
        if data[at:at + len(VERSION)] != VERSION:
            raise ValueError(f"no record at byte {at}")
        end = data.index(b"\r\n\r\n", at)
        lines = data[at + len(VERSION):end].decode().split("\r\n")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record of byte {at} isn't closed")
        yield fields, data[start:stop]
        at = stop + 4


def _inflated(content):
    if content[:2] != b"\x1f\x8b":
        return content
    out = []
    while content:
        member = zlib.decompressobj(31)
        out.append(member.decompress(content))
        content = member.unused_data
    return b"".join(out)


def _number(text):
    return None if text is None else int(text)


def _parsed(batches):
    types = [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int32(),
             pa.string(), pa.int64(), pa.binary()]
    names = [c.split()[0] for c in _PARTS.split(", ")]

    def sent(rows):
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    for batch in batches:
        for content in batch.column("content"):
            rows, size = [], 0
            for fields, block in parse_records(_inflated(content.as_py())):
                own = fields["warc-record-id"]
                rows.append((
                    own, fields["warc-type"], _number(fields.get("page-id")),
                    _number(fields.get("refers-to-page-id")),
                    fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
                    _number(fields.get("warc-segment-number")),
                    fields.get("warc-segment-origin-id", own),
                    _number(fields.get("warc-segment-total-length")), block))
                size += len(block)
                if size > 4 << 20:
                    yield sent(rows)
                    rows, size = [], 0
            if rows:
                yield sent(rows)


_PAGES = ("page_id long, record_type string, refers_to long, payload_bytes long, "
          "payload_digest string, intact boolean, payload binary")


def _payload_of(kind, block, digest, total):
    """(bytes, digest, intact, payload) of a whole record block."""
    head, _, body = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (
        x.partition(":") for x in head.decode().split("\r\n")[1:])}
    if kind == "revisit":
        return _number(fields.get("content-length")), digest, True, None
    framed = fields.get("transfer-encoding", "").lower() == "chunked"
    payload = unchunked(body) if framed else body
    if payload is None or (total is not None and total != len(block)):
        return None, digest, False, None
    own = payload_digest(payload)
    return len(payload), own, own == digest, payload


def _decoded(batches):
    names = [c.split()[0] for c in _PAGES.split(", ")]
    types = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary()]
    for batch in batches:
        out = [[] for _ in types]
        columns = [batch.column(c).to_pylist() for c in (
            "type", "page_id", "refers_to", "digest", "total", "blocks")]
        for kind, page_id, refers_to, digest, total, blocks in zip(*columns):
            size, own, intact, payload = _payload_of(kind, b"".join(blocks), digest, total)
            for column, value in zip(out, (page_id, kind, refers_to, size, own, intact, payload)):
                column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], names)


def read_archives(spark, path):
    """One row for each page of the archives in ``path``, its segments put together.

    ``intact`` is false, and the payload null, where the total length, the numbering of the
    segments or the chunk framing is wrong; a payload whose digest differs from the header
    is returned with ``intact`` false. A revisit has no payload, its length and digest come
    from its header. Only records in segments are shuffled, by origin identifier. Files that
    hold no record give no row.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    parts = mapped(files, _parsed, _PARTS)
    columns = ["type", "page_id", "refers_to", "digest", "total", "blocks"]
    whole = parts.where("segment IS NULL").withColumn("blocks", F.array("block")).select(columns)
    groups = parts.where("segment IS NOT NULL").groupBy("origin").agg(
        F.max(F.when(F.col("segment") == 1, F.col("type"))).alias("type"),
        F.max("page_id").alias("page_id"), F.max("refers_to").alias("refers_to"),
        F.max("digest").alias("digest"),
        F.coalesce(F.max("total"), F.lit(-1)).alias("total"),
        F.sort_array(F.collect_list(F.struct("segment", "block"))).alias("parts"))
    numbered = F.col("parts.segment") == F.sequence(F.lit(1), F.size("parts"))
    groups = groups.withColumns({
        "total": F.when(numbered, F.col("total")).otherwise(-1),
        "blocks": F.col("parts.block")}).select(columns)
    return mapped(whole.unionByName(groups), _decoded, _PAGES)


def through_archives(pages):
    """The columns of op4: write the pages as archives, read them back.

    One row for each row of ``pages``. Null html or url counts as empty. A null ``page_id``
    is never referred to unless no other id has the payload, and then its rows are all
    responses; so are rows that repeat both the smallest id and the payload. Other columns
    are left out; an empty table gives an empty result.
    """
    path = scratch_path(pages.sparkSession, "warc")
    write_archives(pages, path)
    return read_archives(pages.sparkSession, path).drop("payload")


#: The result of op4 in DuckDB's SQL: base32 from the bits of the digest, five at a time.
SQL = """
WITH t AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (
    SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex,
        min(page_id) OVER (PARTITION BY payload) AS first FROM t)
SELECT page_id, payload_bytes,
    array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((('0x' || substr(hex, 5 * (i // 4) + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31)::BIGINT, 1)
        FOR i IN range(32)], '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to, true AS intact
FROM d
"""
