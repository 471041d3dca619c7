"""WARC archives: written with revisits and segments, read back, reassembled and decoded.

Writing: a page is an HTTP response with a chunked body. A block over ``SEGMENT`` bytes is cut into a
first record and continuation records that carry the origin's id, their number and, on the last, the
total length. Of the pages with equal payloads of ``LEAST_SHARED`` bytes or more, the one with the
largest page_id is a response and the others are revisits without a body. Spark's text writer puts the
records into compressed files of bounded size in the shared folder.

Reading: each file is parsed by its records' lengths. Segments are grouped by origin, ordered by number
and joined; numbers and total length are verified, then the chunked framing is decoded and the payload's
digest is compared. A revisit takes its length from the response that it refers to.

A null html is an empty payload. Rows without page_id are always responses; rows that repeat a page_id
with the same payload have the same record type. An empty table gives an empty archive. Record ids are
``urn:page:<page_id>:<random>``; WARC-Refers-To names ``urn:page:<page_id>`` of the response. Further
columns are not archived, except ``url``, which is optional.
"""

from __future__ import annotations

import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import common
from tidemart.session import shared_dir, stored

SEGMENT = 16 << 10
CHUNK = 4 << 10
LEAST_SHARED = 1000
RECORDS_PER_FILE = 1024
HTTP = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        b"Transfer-Encoding: chunked\r\n\r\n")
PARSED = ("origin string, number int, total long, page_id long, record_type string, refers_to long, "
          "digest string, payload_bytes long, block binary")


def chunked(payload: bytes) -> bytes:
    parts = []
    for at in range(0, len(payload), CHUNK):
        piece = payload[at:at + CHUNK]
        parts += [b"%x\r\n" % len(piece), piece, b"\r\n"]
    return b"".join([*parts, b"0\r\n\r\n"])


def unchunked(body: bytes) -> bytes:
    parts, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        if size == 0:
            return b"".join(parts)
        at = end + 2 + size
        if body[at:at + 2] != b"\r\n":
            raise ValueError("a chunk does not end where its size says")
        parts.append(body[end + 2:at])
        at += 2


def payload_of(block: bytes) -> bytes:
    """The body of an HTTP message, without transfer framing."""
    head, _, body = block.partition(b"\r\n\r\n")
    return unchunked(body) if b"transfer-encoding: chunked" in head.lower() else body


def record(kind: str, record_id: str, block: bytes, fields: dict[str, object]) -> bytes:
    """One record without its last line feed, which the text writer adds."""
    named = {"WARC-Type": kind, "WARC-Record-ID": f"<{record_id}>", **fields,
             "WARC-Block-Digest": f"sha1:{hashlib.sha1(block).hexdigest()}", "Content-Length": len(block)}
    lines = "".join(f"{k}: {v}\r\n" for k, v in named.items() if v is not None)
    return b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r"


def _records(page_id: int | None, url: str | None, digest: str, owner: int | None,
             payload: bytes) -> Iterator[bytes]:
    name = f"urn:page:{'' if page_id is None else page_id}:{uuid.uuid4().hex}"
    target = (url or "").replace("\r", "").replace("\n", "") or None
    fields = {"WARC-Date": "2024-03-01T00:00:00Z", "WARC-Target-URI": target,
              "WARC-Payload-Digest": f"sha1:{digest}"}
    if owner is not None:
        yield record("revisit", name, b"", {
            **fields, "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            "WARC-Refers-To": f"<urn:page:{owner}>"})
        return
    block = HTTP + chunked(payload)
    cuts = [block[at:at + SEGMENT] for at in range(0, len(block), SEGMENT)]
    for k, part in enumerate(cuts, 1):
        last = {"WARC-Segment-Total-Length": len(block)} if 1 < k == len(cuts) else {}
        if k == 1:
            yield record("response", name, part, {**fields, **({"WARC-Segment-Number": 1} if cuts[1:] else {})})
        else:
            yield record("continuation", f"{name}:{k}", part, {
                "WARC-Date": fields["WARC-Date"], "WARC-Segment-Origin-ID": f"<{name}>",
                "WARC-Segment-Number": k, **last})


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = zip(*(batch.column(k) for k in range(5)), strict=True)
        made = [r for row in rows for r in _records(*(x.as_py() for x in row))]
        yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], ["record"])


def revisits(pages: DataFrame) -> DataFrame:
    """(page_id, digest, owner) of pages whose payload is stored with a larger page_id."""
    large = pages.where(F.length("payload") >= LEAST_SHARED).select(
        "page_id", "digest", F.length("payload").alias("n"))
    owners = large.groupBy("digest", "n").agg(F.max("page_id").alias("owner"), F.count("*").alias("copies"))
    return large.join(owners.where("copies > 1"), ["digest", "n"]).where("page_id < owner").select(
        "page_id", "digest", "owner").distinct()


def write_archives(pages: DataFrame, folder: str) -> None:
    """The records of every page as compressed files of at most ``RECORDS_PER_FILE`` records."""
    spark = pages.sparkSession
    common.arrow_rows(spark)
    url = F.col("url") if "url" in pages.columns else F.lit(None).cast("string")
    rows = pages.select(F.col("page_id").cast("long"), url.alias("url"),
                        F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    refers = common.broadcast_if_small(stored(revisits(rows), "revisits"))
    made = rows.join(refers, ["page_id", "digest"], "left").select(
        "page_id", "url", "digest", "owner",
        F.when(F.col("owner").isNull(), F.col("payload")).otherwise(F.lit(b"")).alias("payload"))
    made.mapInArrow(_build, "record binary").select(F.col("record").cast("string")).write.options(
        lineSep="\n", compression="gzip", maxRecordsPerFile=RECORDS_PER_FILE).text(folder)


def read_records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of one file."""
    while line := stream.readline():
        if not line.strip():
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"no record begins with {line[:40]!r}")
        fields = {}
        while line := stream.readline().rstrip(b"\r\n"):
            key, _, value = line.decode().partition(":")
            fields[key.strip().lower()] = value.strip()
        size = int(fields["content-length"])
        block = stream.read(size)
        if len(block) != size:
            raise ValueError("a record ends before its length")
        if fields.get("warc-block-digest", "") not in ("", f"sha1:{hashlib.sha1(block).hexdigest()}"):
            raise ValueError("a block does not have its digest")
        yield fields, block


def _page(name: str | None) -> int | None:
    part = (name or "").strip("<>").split(":")
    return int(part[2]) if len(part) > 2 and part[2] else None


def _checked(block: bytes, digest: str | None) -> int:
    payload = payload_of(block)
    if digest and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError("a payload does not have its digest")
    return len(payload)


def _row(fields: dict[str, str], block: bytes) -> tuple:
    name = fields["warc-record-id"].strip("<>")
    kind, number = fields["warc-type"], fields.get("warc-segment-number")
    total, digest = fields.get("warc-segment-total-length"), fields.get("warc-payload-digest")
    digest = digest and digest.removeprefix("sha1:")
    origin = fields.get("warc-segment-origin-id", f"<{name}>").strip("<>") if number else None
    whole = kind == "response" and not number
    return (origin, number and int(number), total and int(total), _page(name), kind,
            _page(fields.get("warc-refers-to")), digest,
            _checked(block, digest) if whole else None, block if number else None)


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [p.split(" ")[0] for p in PARSED.split(", ")]
    kinds = {"string": pa.string(), "int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    types = [kinds[p.split(" ")[1]] for p in PARSED.split(", ")]
    for batch in batches:
        for content in batch.column(0):
            stream, rows = io.BufferedReader(gzip.GzipFile(fileobj=io.BytesIO(content.as_py()))), []
            for found in read_records(stream):
                rows.append(_row(*found))
                if len(rows) == 256:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)
                    rows = []
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), types, strict=True)], names)


def joined(segments: list[dict]) -> bytes:
    """The block of one record from its segments; numbers and total length must fit."""
    ordered = sorted(segments, key=lambda s: s["number"])
    block = b"".join(s["block"] for s in ordered)
    if [s["number"] for s in ordered] != list(range(1, len(ordered) + 1)):
        raise ValueError("a segment is missing or repeated")
    if ordered[-1]["total"] != len(block):
        raise ValueError("the segments do not add up to the total length")
    return block


def _reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, sizes, digests = [], [], []
        for segments in batch.column(0):
            parts = segments.as_py()
            first = next((s for s in parts if s["number"] == 1), None)
            if first is None:
                raise ValueError("a record has no first segment")
            ids.append(first["page_id"])
            digests.append(first["digest"])
            sizes.append(_checked(joined(parts), first["digest"]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())],
            ["page_id", "payload_bytes", "payload_digest"])


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to) of each archived page."""
    common.arrow_rows(spark, 16)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    parsed = stored(files.mapInArrow(_parse, PARSED), "records")
    whole = parsed.where("record_type = 'response' AND origin IS NULL").select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"))
    parts = parsed.where("origin IS NOT NULL").groupBy("origin").agg(F.collect_list(
        F.struct("number", "total", "page_id", "digest", "block")).alias("segments"))
    built = parts.select("segments").mapInArrow(
        _reassemble, "page_id long, payload_bytes long, payload_digest string")
    responses = stored(whole.unionByName(built), "responses")
    sizes = responses.where("page_id IS NOT NULL").select(
        F.col("page_id").alias("refers_to"), F.col("payload_digest"), "payload_bytes").distinct()
    again = parsed.where("record_type = 'revisit'").select(
        "page_id", "refers_to", F.col("digest").alias("payload_digest"))
    seen = again.join(sizes, ["refers_to", "payload_digest"], "left").select(
        "page_id", "payload_bytes", "payload_digest", F.lit("revisit").alias("record_type"), "refers_to")
    return responses.select(
        "page_id", "payload_bytes", "payload_digest", F.lit("response").alias("record_type"),
        F.lit(None).cast("long").alias("refers_to")).unionByName(seen)


SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
o AS (SELECT payload_digest, payload_bytes, max(page_id) AS owner FROM p GROUP BY ALL)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < owner THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < owner THEN owner END AS refers_to
FROM p JOIN o USING (payload_digest, payload_bytes)"""


def op9_warc(spark, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "warc")
    write_archives(common.table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder)
