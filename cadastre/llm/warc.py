"""WARC archives: segmented records with chunked transfer framing, written and reassembled.

A record whose block is longer than a segment is written as a first segment and continuations.
Reading groups continuations by the identifier of their origin, orders them by segment number,
checks their total length, and takes the payload out of the HTTP block.  Records of one segment
are never shuffled.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadastre.llm.common import maybe_broadcast, ship
from cadastre.sources.scratch import cut

VERSION = "WARC/1.1"
SEGMENT, CHUNK = 1 << 16, 1 << 14
OUT_BYTES = 1 << 23  # handed to Spark at a time
DATE = "2000-01-01T00:00:00Z"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK) -> bytes:
    """Chunked transfer framing.

    A chunk ends inside any ``WARC/1.1`` of the payload, so that no block of ours holds the text
    that begins a record.
    """
    mark, out, at = VERSION.encode(), [], 0
    while at < len(payload):
        end = min(at + size, len(payload))
        found = payload.find(mark, at, end + len(mark))
        if 0 <= found < end:
            end = found + 1
        out += [b"%x\r\n" % (end - at), payload[at:end], b"\r\n"]
        at = end
    return b"".join([*out, b"0\r\n\r\n"])


def dechunked(body: bytes) -> bytes | None:
    """The payload of a chunked body, extensions and trailers left out; None if it is broken."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            return None
        size = body[at:end].split(b";")[0].strip()
        if not re.fullmatch(rb"[0-9A-Fa-f]{1,15}", size):
            return None
        n, at = int(size, 16), end + 2
        if not n:
            return b"".join(out)
        if body[at + n : at + n + 2] != b"\r\n":
            return None
        out.append(body[at : at + n])
        at += n + 2


def http_payload(block: bytes) -> bytes | None:
    """Payload of an HTTP response block; None if the head or the framing is broken."""
    head, gap, body = block.partition(b"\r\n\r\n")
    if not gap:
        return None
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked[ \t]*\r?$", head):
        return dechunked(body)
    return body


def _record(fields: dict[str, str], block: bytes) -> bytes:
    lines = [VERSION, *(f"{k}: {v}" for k, v in fields.items()), f"Content-Length: {len(block)}"]
    # The text writer adds the last line end.
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r"


def write_pages(
    pages: DataFrame,
    folder: str,
    min_bytes: int = 0,
    segment: int = SEGMENT,
    chunk: int = CHUNK,
) -> None:
    """Write a record per row of ``pages(page_id, url, html)``; other columns are left out.

    The payload is the html in UTF-8, null being empty.  Among equal payloads of ``min_bytes`` or
    more the rows with the smallest page_id (nulls last) are responses, the others revisits of it;
    smaller payloads are responses.  Repeated rows give repeated records.
    """
    spark = pages.sparkSession
    ship(spark)
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string"), payload.alias("payload"))
    rows = rows.withColumn("key", F.concat_ws(":", F.sha2("payload", 256), F.octet_length("payload")))
    first = rows.filter(F.octet_length("payload") >= min_bytes).groupBy("key").agg(
        F.min("page_id").alias("first"), F.count("*").alias("n")
    )
    # Only payloads that occur again: usually few, and never more than half of the rows.
    first = maybe_broadcast(cut(first.filter("n > 1 and first is not null").select("key", "first")))
    rows = rows.join(first, "key", "left")
    again = F.col("first").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first")))
    rows = rows.select(
        F.col("page_id").cast("string"),  # as text: pandas has no whole numbers with nulls
        "url",
        "payload",
        F.when(again, F.col("first")).cast("string").alias("refers_to"),
    )

    def run(batches):
        out, held = [], 0
        for pdf in batches:
            for page, url, body, refers in pdf.itertuples(index=False, name=None):
                if held > OUT_BYTES:
                    yield pd.DataFrame({"value": out})
                    out, held = [], 0
                held += len(body)
                sha = digest(body)
                # Escaped: a line end or a text that begins a record would end the header.
                url = re.sub(r"[^!-~]|%", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), url or "")
                url = url.replace(VERSION, "WARC%2F1.1")
                name = lambda n: f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {url} {sha} {n}')}>"
                fields = {"WARC-Type": "response", "WARC-Record-ID": name(1), "WARC-Date": DATE}
                fields |= {"WARC-Target-URI": url} if url else {}
                fields |= {"WARC-Payload-Digest": f"sha1:{sha}", "X-Payload-Length": str(len(body))}
                fields |= {"Content-Type": "application/http;msgtype=response"}
                fields |= {"X-Page-ID": page} if page is not None else {}
                if refers is not None:
                    fields |= {"WARC-Type": "revisit", "X-Refers-To-Page-ID": refers}
                    fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                    out.append(_record(fields, HTTP + b"\r\n"))
                    continue
                block = HTTP + b"Transfer-Encoding: chunked\r\n\r\n" + chunked(body, chunk)
                parts = [block[i : i + segment] for i in range(0, len(block), segment)]
                for n, part in enumerate(parts, 1):
                    if n > 1:
                        fields = {"WARC-Type": "continuation", "WARC-Record-ID": name(n), "WARC-Date": DATE}
                        fields["WARC-Segment-Origin-ID"] = name(1)
                    if len(parts) > 1:
                        fields["WARC-Segment-Number"] = str(n)
                        if n == len(parts):
                            fields["WARC-Segment-Total-Length"] = str(len(block))
                    out.append(_record(fields, part))
        yield pd.DataFrame({"value": out})

    records = rows.mapInPandas(run, "value binary")
    records.select(F.col("value").cast("string")).write.text(folder)


def _parse(piece: bytes):
    """(fields, block) for the records of a piece of an archive that begins after a version line."""
    while piece.strip():
        head, gap, rest = piece.partition(b"\r\n\r\n")
        fields = {}
        for line in head.split(b"\r\n"):
            k, colon, v = line.partition(b":")
            if colon:
                fields[k.strip().lower().decode("latin-1")] = v.strip().decode("utf-8", "replace")
        n = fields.get("content-length", "")
        if not gap or not re.fullmatch("[0-9]{1,15}", n) or int(n) > len(rest):
            yield fields, None
            return
        yield fields, rest[: int(n)]
        piece = rest[int(n) :]
        at = piece.find(VERSION.encode() + b"\r\n")
        piece = piece[at + len(VERSION) + 2 :] if at >= 0 else b""


FIELDS = (
    "record_id string, type string, uri string, page_id string, refers_to string, digest string, "
    "payload_length long, segment int, origin string, total_length long, file string, block binary"
)


def read_records(spark: SparkSession, folder: str) -> DataFrame:
    """The records of uncompressed archives of one WARC version, unordered.

    Files are split between records by Spark's text reader, so a large archive is read in
    parallel.  A foreign block may hold the text that begins a record; the record is then short of
    its Content-Length, and that file is read again as a whole, by the lengths alone.
    """
    ship(spark)

    def rows_of(fields, block, file):
        number = lambda k: int(v) if (v := fields.get(k, "")).isdigit() else None
        return (
            fields.get("warc-record-id"), fields.get("warc-type"), fields.get("warc-target-uri"),
            fields.get("x-page-id"), fields.get("x-refers-to-page-id"),
            fields.get("warc-payload-digest", "").removeprefix("sha1:") or None,
            number("x-payload-length"), number("warc-segment-number"), fields.get("warc-segment-origin-id"),
            number("warc-segment-total-length"), file, block,
        )

    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches):
        for pdf in batches:
            found = [
                rows_of(*record, file)
                for piece, file in zip(pdf["piece"], pdf["file"], strict=True)
                for record in _parse(piece)
            ]
            out = pd.DataFrame(found, columns=names)
            for c in ("payload_length", "segment", "total_length"):
                out[c] = out[c].astype("Int64")
            yield out

    text = spark.read.option("lineSep", VERSION + "\r\n").text(folder)
    pieces = text.select(F.col("value").cast("binary").alias("piece"), F.col("_metadata.file_path").alias("file"))
    records = pieces.filter(F.octet_length("piece") > 0).mapInPandas(run, FIELDS)
    head = F.substring_index("value", "\r\n\r\n", 1)
    length = F.expr("try_cast(regexp_extract(head, '(?im)^content-length:[ \\t]*([0-9]+)', 1) AS bigint)")
    there = F.octet_length("value") - F.octet_length("head") - 4
    short = text.filter("value <> ''").withColumn("head", head).filter(length.isNull() | (there < length))
    broken = [r[0] for r in short.select("_metadata.file_path").distinct().collect()]
    if not broken:
        return records
    whole = spark.read.format("binaryFile").load(broken)
    after_version = F.expr(f"substring(content, {len(VERSION) + 3})")
    whole = whole.select(after_version.alias("piece"), F.col("path").alias("file"))
    return records.filter(~F.col("file").isin(broken)).unionByName(whole.mapInPandas(run, FIELDS))


def reassemble(records: DataFrame) -> DataFrame:
    """Whole records: type, uri, page_id, refers_to, digest, payload_length, payload, complete.

    Segments are grouped by origin, ordered by number and joined; ``complete`` says that numbers
    1 to n are there, that the total length is right and that the HTTP framing could be decoded.
    A repeated record comes out as often as its first segment.  An origin's segments meet in one
    task, as they make up one record.
    """
    ship(records.sparkSession)
    keep = ["type", "uri", "page_id", "refers_to", "digest", "payload_length"]
    schema = (
        "type string, uri string, page_id string, refers_to string, digest string, "
        "payload_length long, payload binary, complete boolean"
    )
    parted = F.col("segment").isNotNull() | F.col("origin").isNotNull()
    single = records.filter(~parted).select(*keep, F.col("block").isNotNull().alias("whole"), "block")

    part = F.struct("segment", "block", "total_length")
    origin = F.col("segment") == 1
    groups = records.filter(parted).groupBy(F.coalesce("origin", "record_id").alias("origin")).agg(
        *[F.max(F.when(origin, F.col(c))).alias(c) for c in keep],
        F.count(F.when(origin, 1)).alias("copies"),
        F.array_sort(F.collect_set(part)).alias("parts"),
    )
    last = F.element_at("parts", -1)["total_length"]
    numbers = F.transform("parts", lambda x: x["segment"])
    right = F.coalesce(numbers == F.sequence(F.lit(1), F.size("parts")), F.lit(False))
    groups = groups.withColumn("ordered", right).withColumn("total", last)

    def join(batches):
        for pdf in batches:
            blocks = [b"".join(p["block"] or b"" for p in parts) for parts in pdf["parts"]]
            whole = [o and t == len(b) for o, t, b in zip(pdf["ordered"], pdf["total"], blocks, strict=True)]
            out = pdf[[*keep, "copies"]].assign(whole=pd.Series(whole, dtype=bool), block=blocks)
            yield out.assign(payload_length=out["payload_length"].astype("Int64"))

    fields = "type string, uri string, page_id string, refers_to string, digest string, payload_length long"
    joined = groups.mapInPandas(join, f"{fields}, copies long, whole boolean, block binary")
    many = F.explode(F.sequence(F.lit(1), F.greatest("copies", F.lit(1))))
    joined = joined.withColumn("copy", many).select(*keep, "whole", "block")

    def payloads(batches):
        for pdf in batches:
            got = [
                b"" if kind == "revisit" else http_payload(block) if ok else None
                for kind, ok, block in zip(pdf["type"], pdf["whole"], pdf["block"], strict=True)
            ]
            out = pdf[keep].assign(payload=got, complete=[x is not None for x in got])
            yield out.assign(payload_length=out["payload_length"].astype("Int64"))

    return single.unionByName(joined).mapInPandas(payloads, schema)


def archived_pages(pages: DataFrame, folder: str, min_bytes: int = 0) -> DataFrame:
    """Write the pages below ``folder`` and return what the archives hold, a row per page.

    Length and digest of a response come from its reassembled payload; a revisit has no payload
    of its own and carries both in its header.
    """
    write_pages(pages, folder, min_bytes)
    records = reassemble(read_records(pages.sparkSession, folder))
    own = F.col("type") == "response"

    return records.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.when(own, F.octet_length("payload")).otherwise(F.col("payload_length")).cast("long").alias("payload_bytes"),
        F.when(own, base32(F.sha1("payload"))).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"),
        F.col("refers_to").cast("long").alias("refers_to"),
        "complete",
    )


def base32(hexadecimal):
    """RFC 4648 base32, upper case without padding, of 40 hex digits: 5 bits a letter."""
    bits = F.concat(
        *[F.lpad(F.conv(F.substring(hexadecimal, 1 + 10 * i, 10), 16, 2), 40, "0") for i in range(4)]
    )
    value = lambda i: F.conv(F.substring(bits, 1 + 5 * i, 5), 2, 10).cast("int")
    letters = F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")
    return F.concat(*[F.substr(letters, value(i) + 1, F.lit(1)) for i in range(32)])
