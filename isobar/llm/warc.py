"""WARC archives: writing pages as compressed records, and a reader that salvages records
from damaged archives.

Archives are written by Spark's text writer, whose commit survives lost executors: a row
is one gzip member holding one record, and the line separator is an empty gzip member, so
a file is a plain sequence of members, one record each, as the format recommends.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isobar.llm.common import materialize, pick
from isobar.llm.exact_dedup import winners_of
from isobar.session import run_folder

# Fixed values of the format.
VERSION = b"WARC/1.1"
MEMBER = b"\x1f\x8b\x08"
EMPTY_MEMBER = b"\x1f\x8b\x08\x00\x00\x00\x00\x00\x00\x03\x03\x00\x00\x00\x00\x00\x00\x00\x00\x00"
IDENTICAL = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: Digests that are checked if a record states one.
ALGORITHMS = ("md5", "sha1", "sha256", "sha512")

#: Payloads under this many bytes are always written in full.
LEAST_REVISIT_BYTES = 100
#: Records have no crawl time in the page table; a fixed one keeps reruns identical.
DATE = "1970-01-01T00:00:00Z"
#: Records of one archive at most; archives end earlier at the end of a task.
ARCHIVE_RECORDS = 20_000

RECORDS = "kind string, file string, start long, end long, reason string, page_id long, record_type string, refers_to long, payload_bytes long, payload_digest string, url string, payload binary"


def _urn(page_id) -> str:
    return f"urn:page:{'' if page_id is None else page_id}"


def _page_of(urn: str | None) -> int | None:
    number = (urn or "").strip("<>").removeprefix("urn:page:")
    return int(number) if re.fullmatch(r"-?\d+", number) else None


def record(page_id, url, payload: bytes, digest: str, refers_to, is_revisit: bool) -> bytes:
    """One record. A revisit carries the HTTP header only."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if is_revisit else payload)
    head = [VERSION.decode(), f"WARC-Type: {'revisit' if is_revisit else 'response'}", f"WARC-Record-ID: <{_urn(page_id)}>", f"WARC-Date: {DATE}"]
    if url:  # white space and control characters would end the header line
        head.append("WARC-Target-URI: " + re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    head.append(f"WARC-Payload-Digest: sha256:{digest}")
    if is_revisit:
        head += [f"WARC-Refers-To: <{_urn(refers_to)}>", f"WARC-Profile: {IDENTICAL}"]
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _members(batches):
    for batch in batches:
        out = []
        for row in batch.to_pylist():
            payload = row["html"].encode()
            squeeze = zlib.compressobj(6, zlib.DEFLATED, 31)
            refers = row["winner"] if row["revisit"] else None
            made = record(row["page_id"], row["url"], payload, row["digest"], refers, row["revisit"])
            out.append(squeeze.compress(made) + squeeze.flush())
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["member"])


def write_archives(pages: DataFrame, path: str) -> None:
    """Write a record per row of ``pages`` (page_id, url, html) as ``.gz`` archives.

    The payload is the html in UTF-8, null as empty. Of equal payloads of at least
    ``LEAST_REVISIT_BYTES`` the row with the smallest page_id (null last) is written in
    full, rows that repeat that page_id too; the others revisit it. An empty table writes
    an empty folder. The html shuffles once, by page_id, never by its digest."""
    pages = pick(pages, page_id="page_id", url="url", html="html").select(
        F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html")
    )
    hashed = pages.withColumn("digest", F.sha2("html", 256))
    rows = materialize(
        hashed.where(F.octet_length("html") >= LEAST_REVISIT_BYTES).select(
            F.col("page_id").alias("doc_id"), F.monotonically_increasing_id().alias("rid"), F.unhex("digest").alias("digest")
        ),
        "payloads",
    )
    revisits = (
        winners_of(rows)
        .where(~F.col("doc_id").eqNullSafe(F.col("keep_id")))
        .select(F.col("doc_id").alias("of"), F.lower(F.hex("digest")).alias("of_digest"), F.col("keep_id").alias("winner"))
        .distinct()
    )
    same = F.col("page_id").eqNullSafe(F.col("of")) & (F.col("digest") == F.col("of_digest"))
    typed = hashed.join(revisits, same, "left").withColumn("revisit", F.col("of_digest").isNotNull())
    lines = typed.select("page_id", "url", "html", "digest", "winner", "revisit").mapInArrow(_members, "member binary")
    (
        lines.select(F.col("member").cast("string").alias("value"))
        .write.option("lineSep", EMPTY_MEMBER.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .option("maxRecordsPerFile", ARCHIVE_RECORDS)
        .text(path)
    )


def _agrees(stated: str, payload: bytes) -> bool | None:
    """Whether the payload has the stated digest, in base 16 or 32; None if none is stated
    or its algorithm is unknown."""
    name, colon, value = stated.partition(":")
    if not colon and re.fullmatch(r"[0-9a-fA-F]{64}", stated):
        name, value = "sha256", stated
    name = name.lower().replace("-", "")
    if name not in ALGORITHMS:
        return None
    made = hashlib.new(name, payload).digest()
    return value.lower() == made.hex() or value.upper().rstrip("=") == base64.b32encode(made).decode().rstrip("=")


def parse_record(data: bytes, at: int) -> tuple[dict | None, int, str]:
    """The record that starts at ``at`` of uncompressed ``data``: (fields, end, ""), or
    (None, at, why not)."""
    stop = data.find(b"\r\n\r\n", at)
    if stop < 0:
        return None, at, "no end of header"
    lines = data[at:stop].split(b"\r\n")
    if not re.fullmatch(rb"WARC/1\.[01]", lines[0]):
        return None, at, "no version line"
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None, at, "bad header line"
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    if not re.fullmatch(r"\d+", fields.get("content-length", "")):
        return None, at, "no content length"
    begin, end = stop + 4, stop + 4 + int(fields["content-length"])
    if data[end : end + 4] != b"\r\n\r\n":
        return None, at, "record is cut or overlong"
    http, payload, verified = b"", data[begin:end], None
    if fields.get("content-type", "").lower().startswith("application/http") or ("content-type" not in fields and payload.startswith(b"HTTP/")):
        http, found, payload = payload.partition(b"\r\n\r\n")
        if not found and fields.get("warc-type") != "revisit":
            return None, at, "no HTTP header"
    digest = fields.get("warc-payload-digest", "")
    if fields.get("warc-type") == "revisit":
        stated = re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", http)
        size, payload, digest = int(stated[1]) if stated else None, None, digest.removeprefix("sha256:") or None
    else:
        if "warc-segment-number" not in fields:  # the digest of a segment is that of the whole
            verified = _agrees(digest, payload)
        if verified is False:
            return None, at, "payload digest differs"
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    return fields | {"payload": payload, "size": size, "digest": digest, "verified": bool(verified)}, end + 4, ""


def _member_at(data: bytes, at: int) -> tuple[bytes, int]:
    """What the gzip member at ``at`` gives, and its end if it is whole and its checksum
    right. Of a damaged one, what it gives before the damage, and ``at``."""
    opened, out = zlib.decompressobj(31), []
    for i in range(at, len(data), 1 << 16):  # by pieces: a bad start fails early
        try:
            out.append(opened.decompress(data[i : i + (1 << 16)]))
        except zlib.error:  # what the piece gave is lost: again, byte by byte
            opened = zlib.decompressobj(31)
            opened.decompress(data[at:i])
            try:
                for k in range(i, len(data)):
                    out.append(opened.decompress(data[k : k + 1]))
            except zlib.error:
                break
        if opened.eof:
            return b"".join(out), min(i + (1 << 16), len(data)) - len(opened.unused_data)
    return b"".join(out), at


def _reach(data: bytes, at: int, enough: int) -> int:
    """Where the member at ``at`` has given ``enough`` bytes."""
    opened, given, i, step = zlib.decompressobj(31), 0, at, 1 << 16
    while given < enough:
        trial = opened.copy() if step > 1 else opened
        try:
            n = len(trial.decompress(data[i : i + step]))
        except zlib.error:
            n = enough
        if step > 1 and given + n >= enough:
            step = 1
            continue
        opened, given, i = trial, given + n, i + step
    return i


def salvage(data: bytes):
    """Yields (kind, start, end, reason, fields) for all of an archive's bytes, in order:
    ``record`` for valid records, ``gap`` for quarantined bytes.

    After a failed check the reader searches for the next member or version line at which
    reading succeeds, and goes on there. Works on compressed members (one or more records
    each), on plain records, and on a mixture. A sound member with a bad record inside
    gives its other records and a gap that names the member's bytes.

    A damaged member gives the records that more of its bytes follow, with a reason that
    says so and whether a digest verified the payload; the gap begins behind the last of
    them. A record at which the member breaks off is part of the gap."""
    at, bad, why = 0, None, ""
    while at < len(data):
        found, end, reason, after = [], at, "neither a member nor a version line", ""
        if data.startswith(MEMBER, at):
            plain, end = _member_at(data, at)
            inside = list(salvage(plain))
            reason = ""
            if end == at:
                sound = max((i for i, x in enumerate(inside) if x[0] == "record" and x[2] < len(plain)), default=-1) + 1
                if sound:
                    end = _reach(data, at, inside[sound - 1][2])
                    said = lambda x: "damaged member" if x["verified"] else "damaged member, payload not verified"
                    inside = [(*x[:3], x[3] or said(x[4]), x[4]) if x[0] == "record" else x for x in inside[:sound]]
                    after = "damaged member"
                else:
                    reason = "damaged member"
            found = [(kind, f"inside a member: {inner}" if inner else "", x) for kind, _, _, inner, x in inside]
        elif data.startswith(b"WARC/1.", at):
            fields, end, reason = parse_record(data, at)
            found = [("record", "", fields)]
        if reason:
            bad, why = (at, reason) if bad is None else (bad, why)
            places = [x for x in (data.find(MEMBER, at + 1), data.find(b"WARC/1.", at + 1)) if x >= 0]
            at = min(places, default=len(data))
            continue
        if bad is not None:
            yield "gap", bad, at, why, {}
            bad = None
        for kind, inner, fields in found:
            yield kind, at, end, inner, fields
        at = end
        if after and not data.startswith((MEMBER, b"WARC/1."), at) and at < len(data):
            bad, why = at, after
    if bad is not None:
        yield "gap", bad, at, why, {}


def _read(batches):
    schema = pa.schema(
        [("kind", pa.string()), ("file", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("reason", pa.string()), ("page_id", pa.int64()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("url", pa.string()), ("payload", pa.binary())]
    )
    for batch in batches:
        for file, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows, held = [], 0
            for kind, start, end, why, x in salvage(content.as_buffer().to_pybytes()):
                page, refers = _page_of(x.get("warc-record-id")), _page_of(x.get("warc-refers-to"))
                rows.append((kind, file, start, end, why, page, x.get("warc-type"), refers, x.get("size"), x.get("digest"), x.get("warc-target-uri"), x.get("payload")))
                held += len(x.get("payload") or b"")
                if held > 4 << 20 or len(rows) >= 4096:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)
                    rows, held = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """All records (kind ``record``) and quarantined byte gaps (kind ``gap``: file, start,
    end, reason) of the archives below ``path``; columns as in ``RECORDS``.

    ``start`` and ``end`` of a record are those of its member or its plain bytes. Records
    of all types are read; a block that isn't HTTP is the payload. payload_digest is the
    payload's SHA-256; a digest that the record states is checked if its algorithm is known.
    A revisit has no payload, its payload_bytes and payload_digest are those it states of the
    full payload, null if none. A ``record`` with a reason is from a damaged member. A record without a numeric id has a null page_id. One archive is read by one
    task and has to fit its memory (Spark's limit is 2 GB)."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(_read, RECORDS)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write ``pages`` as archives in the run's folder, read them back: one row per record
    with page_id, payload_bytes, payload_digest, record_type and refers_to."""
    spark = pages.sparkSession
    path = f"{run_folder(spark)}/archives-{uuid.uuid4().hex}"
    write_archives(pages, path)
    return (
        read_archives(spark, path)
        .where("kind = 'record'")
        .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    )
