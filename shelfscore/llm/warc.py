"""WARC archives: writing, reading and reassembly of segmented records.

Payloads are sent as chunked HTTP messages. A long message is cut into a first
record and continuation records, which name the first one's id as their origin.
Archives are written by Spark's own text sink, whose line end is the record
end, so they go to any store that Spark can write to. On reading, continuation
records are grouped by origin, ordered by segment number, checked against the
total length, and the chunked framing is taken off."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscore.llm.storage import bounded_batches, scratch_dir, written

SEGMENT_BYTES = 16 * 1024
CHUNK_BYTES = 4 * 1024
# Records per archive file, and the bytes of a file that one reading task holds.
RECORDS_PER_FILE = 2_000
_VERSION = b"WARC/1.1"
_PARSED = "record_id string, kind string, origin string, segment int, total bigint, page string, refers string, digest string, block binary"


def sha1_base32(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def chunked(payload: bytes, size: int = CHUNK_BYTES) -> bytes:
    """Chunked transfer framing of a payload."""
    parts = [payload[k : k + size] for k in range(0, len(payload), size)]
    return b"".join(b"%x\r\n%s\r\n" % (len(p), p) for p in parts) + b"0\r\n\r\n"


def dechunked(body: bytes) -> bytes:
    """The payload of a chunked body. Chunk extensions and trailer fields are
    skipped; a body that ends early is an error."""
    out, at = [], 0
    while True:
        end = body.index(b"\r\n", at)
        size = int(body[at:end].split(b";")[0], 16)
        at = end + 2
        if size == 0:
            return b"".join(out)
        if len(body) < at + size + 2 or body[at + size : at + size + 2] != b"\r\n":
            raise ValueError("a chunk is cut off")
        out.append(body[at : at + size])
        at += size + 2


def http_payload(message: bytes) -> bytes:
    """Payload of an HTTP response, with the transfer framing removed."""
    head, _, body = message.partition(b"\r\n\r\n")
    if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked\b", head):
        return dechunked(body)
    length = re.search(rb"(?im)^content-length:\s*(\d+)", head)
    return body[: int(length[1])] if length else body


def record(fields: list[tuple[str, str | int]], block: bytes) -> bytes:
    """A WARC record without the two line ends behind it."""
    lines = [_VERSION, *(f"{k}: {v}".encode() for k, v in fields), b"Content-Length: %d" % len(block)]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block


def records(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields (lower-case names) and block of each record of an archive."""
    at = 0
    while True:
        at = data.find(_VERSION[:5], at)
        if at < 0:
            return
        end = data.index(b"\r\n\r\n", at)
        fields = {}
        for line in data[at:end].split(b"\r\n")[1:]:
            name, _, value = line.decode("utf-8", "replace").partition(":")
            fields[name.strip().lower()] = value.strip()
        at = end + 4 + int(fields["content-length"])
        if at > len(data):
            raise ValueError("a record is cut off")
        yield fields, data[end + 4 : at]
        at += 4


def _one_line(url: str | None) -> str:
    return re.sub(r"\s", "%20", url or "")


def write_archives(
    pages: DataFrame,
    path: str,
    segment_bytes: int = SEGMENT_BYTES,
    min_revisit_bytes: int = 0,
    records_per_file: int = RECORDS_PER_FILE,
) -> str:
    """Write rows (page_id, url, html) as WARC files under path.

    Of pages with equal payloads of at least min_revisit_bytes, those with the
    largest page_id carry the payload and the others become revisit records."""
    spark = pages.sparkSession
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).alias("payload")
    rows = pages.select(F.col("page_id").cast("string").alias("page"), F.col("url").cast("string").alias("url"), "page_id", payload)
    key = F.sha2("payload", 256)
    equal = rows.select("page_id", key.alias("key"), F.octet_length("payload").alias("bytes"))
    equal = equal.where(F.col("bytes") >= min_revisit_bytes).groupBy("key").agg(F.max("page_id").alias("response"), F.count("*").alias("n"))
    equal = written(equal.where("n > 1").select("key", F.col("response").cast("string").alias("response")), "equal")
    rows = rows.drop("page_id").withColumn("key", key).join(equal.hint("merge"), "key", "left")

    def archive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("page", "url", "response")]
            for page, url, response, data in zip(*columns, batch["payload"].cast(pa.binary()).to_pylist(), strict=True):
                digest = sha1_base32(data)
                # Ids are percent-quoted, so one with a colon or bracket keeps its name's shape.
                name = lambda of, d=digest: f"<urn:x-page:{'' if of is None else quote(of, safe='')}:{d}>"
                own = [("WARC-Target-URI", _one_line(url)), ("WARC-Date", "2024-01-01T00:00:00Z"), ("WARC-Payload-Digest", f"sha1:{digest}")]
                kind = ("Content-Type", "application/http; msgtype=response")
                head = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
                if response is not None and page != response:
                    profile = ("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
                    fields = [("WARC-Type", "revisit"), ("WARC-Record-ID", name(page)), *own, profile, ("WARC-Refers-To", name(response)), kind]
                    out.append(record(fields, head))
                    continue
                message = head + chunked(data)
                cuts = [message[k : k + segment_bytes] for k in range(0, len(message), segment_bytes)]
                fields = [("WARC-Type", "response"), ("WARC-Record-ID", name(page)), *own, kind]
                if len(cuts) > 1:
                    fields.append(("WARC-Segment-Number", 1))
                out.append(record(fields, cuts[0]))
                for k, cut in enumerate(cuts[1:], 2):
                    fields = [("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name(page)[:-1]}:{k}>"), *own[:2]]
                    fields += [("WARC-Segment-Origin-ID", name(page)), ("WARC-Segment-Number", k)]
                    if k == len(cuts):
                        fields.append(("WARC-Segment-Total-Length", len(message)))
                    out.append(record(fields, cut))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    text = rows.select("page", "url", "response", "payload").mapInArrow(archive, "record binary")
    writer = text.select(F.col("record").cast("string").alias("value")).write
    # The text sink copies the bytes of a value as they are.
    writer.option("lineSep", "\r\n\r\n").option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(path)
    return path


def parsed(spark: SparkSession, path: str) -> DataFrame:
    """One row per record of all archives under path. A file is parsed in one
    task, so archives are to be of a size that a task can hold."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            for data in batch["content"].to_pylist():
                if data[:2] == b"\x1f\x8b":
                    plain = []
                    while data:
                        opened = zlib.decompressobj(31)
                        plain.append(opened.decompress(data))
                        data = opened.unused_data
                    data = b"".join(plain)
                rows = []
                for fields, block in records(data):
                    get = fields.get
                    name = get("warc-record-id", "").strip("<>")
                    page = unquote(name.split(":")[2]) if name.startswith("urn:x-page:") else None
                    number, total = get("warc-segment-number"), get("warc-segment-total-length")
                    origin = get("warc-segment-origin-id", "").strip("<>") or (name if number else None)
                    digest = get("warc-payload-digest", "").removeprefix("sha1:") or None
                    row = (name, get("warc-type"), origin, number and int(number), total and int(total), page or None)
                    rows.append((*row, get("warc-refers-to", "").strip("<>") or None, digest, block))
                    if len(rows) == 256:
                        yield _batch(rows)
                        rows = []
                if rows:
                    yield _batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(parse, _PARSED)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    s, types = pa.string(), [pa.int32(), pa.int64()]
    kinds = [s, s, s, *types, s, s, s, pa.binary()]
    names = [f.strip().split()[0] for f in _PARSED.split(",")]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


_PAYLOAD = "record_id string, page string, digest string, payload binary"


def reassembled(found: DataFrame) -> DataFrame:
    """(record_id, page, digest, payload) of every response record.

    The parts of a segmented record meet in one group, which holds that one
    record. Equal records, from repeated rows, come out as often as they were
    written. A missing or repeated segment, a wrong total length or a payload
    that does not have its digest is an error."""

    def unframe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [http_payload(b) for b in batch["block"].to_pylist()]
            _check(payloads, batch["digest"].to_pylist())
            columns = [batch["record_id"], batch["page"], batch["digest"], pa.array(payloads, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["record_id", "page", "digest", "payload"])

    def join(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["segment"])
        copies = sum(r["segment"] == 1 for r in rows)
        rows = rows[:: max(copies, 1)]
        if [r["segment"] for r in rows] != list(range(1, len(rows) + 1)):
            raise ValueError(f"segments of {rows[0]['origin']} are missing")
        message = b"".join(r["block"] for r in rows)
        if rows[-1]["total"] != len(message):
            raise ValueError(f"{rows[0]['origin']} has {len(message)} bytes and not {rows[-1]['total']}")
        payload = http_payload(message)
        _check([payload], [rows[0]["digest"]])
        names = ("record_id", "page", "digest")
        return pa.table({n: [rows[0][n]] * copies for n in names} | {"payload": pa.array([payload] * copies, pa.binary())})

    whole = found.where("kind = 'response' and segment is null").select("record_id", "page", "digest", "block")
    cut = found.where("segment is not null").select("origin", "segment", "total", "record_id", "page", "digest", "block")
    return whole.mapInArrow(unframe, _PAYLOAD).unionAll(cut.groupBy("origin").applyInArrow(join, _PAYLOAD))


def _check(payloads: list[bytes], digests: list[str | None]) -> None:
    for payload, digest in zip(payloads, digests, strict=True):
        if digest and sha1_base32(payload) != digest:
            raise ValueError(f"a payload does not have the digest {digest}")


def read_archives(spark: SparkSession, path: str, payloads: bool = True) -> DataFrame:
    """(page, record_type, refers_to, payload_bytes, payload_digest, payload) of
    every page; payload is null for revisits, whose size is that of the record
    they refer to. Without payloads that column is left out, and the archives'
    responses are reassembled once only."""
    bounded_batches(spark)
    found = parsed(spark, path)
    responses = reassembled(found).withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    if not payloads:
        responses = written(responses.drop("payload"), "responses")
    sizes = responses.select(F.col("record_id").alias("refers"), "payload_bytes", F.col("page").alias("refers_to"))
    revisits = found.where("kind = 'revisit'").select("page", F.col("digest").alias("payload_digest"), "refers")
    # One row per response, written so that a response with very many revisits
    # can be split in the join.
    revisits = revisits.join(written(sizes.distinct(), "sizes"), "refers", "left")
    columns = ["page", "record_type", "refers_to", "payload_bytes", "payload_digest", *["payload"] * payloads]
    own = responses.withColumnsRenamed({"digest": "payload_digest"}).withColumn("record_type", F.lit("response"))
    own = own.withColumn("refers_to", F.lit(None).cast("string")).select(*columns)
    revisits = revisits.withColumn("record_type", F.lit("revisit")).withColumn("payload", F.lit(None).cast("binary"))
    return own.unionByName(revisits.select(*columns))


def round_trip(
    pages: DataFrame, segment_bytes: int = SEGMENT_BYTES, min_revisit_bytes: int = 0, payloads: bool = True
) -> DataFrame:
    """Write pages (page_id, url, html) as archives and read them back.

    Defined cases: a null html is an empty payload, a null url an empty target.
    Rows of one page_id that hold the same payload are all responses if it is
    the largest. A null page_id is smaller than all others. An empty table
    gives an empty result. Other columns of the input are not read."""
    spark = pages.sparkSession
    bounded_batches(spark)
    path = write_archives(pages, scratch_dir(spark, "archives"), segment_bytes, min_revisit_bytes)
    return read_archives(spark, path, payloads)
