"""Write and read WARC archives with revisit records, segmented records and chunked payloads.

Files are gzip members, one per record, written by tasks under names of their own; a manifest lists those of
committed attempts. Records longer than a segment are cut into a first record and continuation records. The reader
groups segments by origin identifier, orders them by segment number, verifies their total length, and then
decodes the HTTP framing.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brookmart.llm.common import Scratch, importable, whole
from brookmart.llm.token_files import _storage

SEGMENT, CHUNK, FILE_BYTES = 32 * 1024, 8 * 1024, 128 * 1024 * 1024
DATE = "2024-01-01T00:00:00Z"
HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nTransfer-Encoding: chunked\r\n\r\n"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
MANIFEST = "path string, records long"


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def chunked(payload: bytes) -> bytes:
    parts = [b"%x\r\n%s\r\n" % (len(c), c) for c in (payload[i:i + CHUNK] for i in range(0, len(payload), CHUNK))]
    return b"".join(parts) + b"0\r\n\r\n"


def unchunked(body: bytes) -> bytes:
    """The payload of a chunked body; chunk extensions and trailers are skipped. ValueError if it is cut off."""
    out, at = [], 0
    while True:
        end = body.find(b"\r\n", at)
        if end < 0:
            raise ValueError("chunk size missing")
        n = int(body[at:end].split(b";")[0], 16)
        if n == 0:
            return b"".join(out)
        if end + 2 + n > len(body):
            raise ValueError("chunk cut off")
        out.append(body[end + 2:end + 2 + n])
        at = end + 4 + n


def http_payload(block: bytes) -> bytes:
    """The payload of an HTTP response block, with its transfer framing decoded."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        raise ValueError("no end of HTTP head")
    return unchunked(body) if re.search(rb"(?im)^transfer-encoding:[^\r\n]*\bchunked", head) else body


def record(fields: dict[str, str | int], block: bytes) -> bytes:
    head = "".join(f"{k}: {_one_line(v)}\r\n" for k, v in {**fields, "Content-Length": len(block)}.items())
    return b"WARC/1.1\r\n" + head.encode("utf-8", "replace") + b"\r\n" + block + b"\r\n\r\n"


def _one_line(value: str | int) -> str:
    return re.sub(r"[\r\n]+", " ", str(value))


def _urn() -> str:
    return f"<urn:uuid:{uuid.uuid4()}>"


def records_of(page_id: int | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: int | None,
               revisit: bool, segment: int = SEGMENT) -> Iterator[bytes]:
    """The record of one page: a response, cut into segments if it is long, or a revisit without payload."""
    origin = _urn()
    common = {"WARC-Target-URI": url or "", "WARC-Date": DATE, "Page-Id": "" if page_id is None else page_id,
              "WARC-Payload-Digest": f"sha1:{digest}", "Payload-Length": size, "Content-Type": "application/http; msgtype=response"}
    if revisit:
        yield record({"WARC-Type": "revisit", "WARC-Record-ID": origin, "WARC-Profile": REVISIT,
                      "Refers-To-Page-Id": "" if refers_to is None else refers_to, **common}, HEAD)
        return
    block = HEAD + chunked(payload)
    pieces = [block[i:i + segment] for i in range(0, len(block), segment)]
    first = {"WARC-Type": "response", "WARC-Record-ID": origin, **common}
    yield record({**first, "WARC-Segment-Number": 1} if len(pieces) > 1 else first, pieces[0])
    for n, piece in enumerate(pieces[1:], 2):
        fields: dict[str, str | int] = {"WARC-Type": "continuation", "WARC-Record-ID": _urn(), "WARC-Date": DATE,
                                        "WARC-Segment-Origin-ID": origin, "WARC-Segment-Number": n}
        if n == len(pieces):
            fields["WARC-Segment-Total-Length"] = len(block)
        yield record(fields, piece)


def members(stream) -> Iterator[bytes]:
    """Records of an open archive, one at a time: gzip members, or one by one out of a plain file."""
    data = stream.read(1 << 20)
    if data[:2] == b"\x1f\x8b":
        while data:
            unzip, out = zlib.decompressobj(31), []
            while not unzip.eof:
                out.append(unzip.decompress(data))
                data = unzip.unused_data if unzip.eof else stream.read(1 << 20)
                if not data and not unzip.eof:
                    raise ValueError("gzip member cut off")
            data = data or stream.read(1 << 20)
            yield b"".join(out)
        return
    data = bytearray(data)
    while True:
        while (end := data.find(b"\r\n\r\n")) < 0 or len(data) < end + 8 + _length(data[:end]):
            more = stream.read(1 << 20)
            if not more:
                if data.strip():
                    raise ValueError("record cut off")
                return
            data += more
        size = end + 8 + _length(data[:end])
        yield bytes(data[:size])
        del data[:size]


def _length(head: bytes) -> int:
    return int(re.search(rb"(?im)^content-length:\s*(\d+)", bytes(head))[1])


def parse(raw: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (lower-case names) and block of one record."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].lstrip().startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    n = int(fields["content-length"])
    if len(rest) < n:
        raise ValueError("block cut off")
    return fields, rest[:n]


def write_warc(spark: SparkSession, path: str, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
               revisit_bytes: int = 0, segment: int = SEGMENT) -> DataFrame:
    """Write a record per row of the Parquet table at ``path``; returns the manifest table.

    Of equal payloads of at least ``revisit_bytes`` bytes the row with the smallest identifier (null last, then by place) is the
    response, others are revisits of it. Null html is an empty payload. No rows give no files. Other columns are not read.
    """
    importable(spark)
    rows = spark.read.parquet(path).select(
        F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"),
        F.encode(whole(F.col(html_col)), "UTF-8").alias("payload"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.row_index").alias("row"),
    ).withColumn("key", F.sha2("payload", 256))
    firsts = rows.groupBy("key").agg(F.min(F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "file", "row")).alias("first"))
    size = F.octet_length("payload")
    revisit = (size >= revisit_bytes) & ((F.col("file") != F.col("first.file")) | (F.col("row") != F.col("first.row")))
    ready = rows.join(firsts, "key").select(
        "page_id", "url", F.when(~revisit, F.col("payload")).alias("payload"), size.cast("long").alias("size"), F.sha1("payload").alias("sha1"),
        F.when(revisit, F.col("first.page_id")).alias("refers_to"), revisit.alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _storage(f"{folder}/warc")
        out, name, n, written = None, "", 0, 0

        def close() -> pa.RecordBatch:
            out.close()
            return pa.record_batch([pa.array([f"{folder}/warc/{name}"]), pa.array([n], pa.int64())], names=["path", "records"])

        for batch in batches:
            for i in range(batch.num_rows):
                page_id, url, payload, n_bytes, sha1, refers_to, is_revisit = (c[i].as_py() for c in batch.columns)
                if out is None:
                    fs.create_dir(root, recursive=True)
                    name, n, written = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    out = fs.open_output_stream(f"{root}/{name}", compression=None)
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                for raw in records_of(page_id, url, payload or b"", n_bytes, digest, refers_to, is_revisit, segment):
                    zipped = zlib.compressobj(1, zlib.DEFLATED, 31)
                    data = zipped.compress(raw) + zipped.flush()
                    out.write(data)
                    n, written = n + 1, written + len(data)
                if written >= FILE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    ready.mapInArrow(write, MANIFEST).write.mode("overwrite").parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


RECORD = ("key string, type string, page_id string, url string, digest string, size string, refers_to string, "
          "segment int, total long, block binary, payload_bytes long, payload_digest string, payload binary, error string")


def read_warc(spark: SparkSession, manifest: DataFrame, with_payload: bool = False) -> DataFrame:
    """One row per record of the archives, continuations joined to their origin.

    Returns page_id, url, record_type, refers_to, payload_bytes, payload_digest (of the payload read; for revisits as the
    record tells them), error and, if asked for, payload. ``error`` is null unless segments are missing or repeated, their length is not the total,
    the framing is broken or the digest differs from the record's; then bytes and digest are null. Only segmented blocks are shuffled, each by
    its own origin, so a group is as large as one record.
    """
    importable(spark)
    names = [x.split()[0] for x in RECORD.split(", ")]
    kinds = [pa.string()] * 7 + [pa.int32(), pa.int64(), pa.binary(), pa.int64(), pa.string(), pa.binary(), pa.string()]

    def opened(fields: dict[str, str], block: bytes) -> tuple:
        """Bytes, digest and payload of a whole response, or what is wrong with it."""
        try:
            payload = http_payload(block)
        except ValueError as e:
            return None, None, None, str(e)
        digest, told = base32_sha1(payload), fields.get("digest") or ""
        if told and told != f"sha1:{digest}":
            return None, None, None, "digest differs"
        return len(payload), digest, payload if with_payload else None, None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, place = _storage(path)
                rows, held = [], 0
                with fs.open_input_stream(place, compression=None) as stream:
                    for raw in members(stream):
                        f, block = parse(raw)
                        origin, part = f.get("warc-segment-origin-id"), f.get("warc-segment-number")
                        own = {"digest": f.get("warc-payload-digest")}
                        if f["warc-type"] == "revisit":
                            result = (int(f["payload-length"]) if f.get("payload-length") else None,
                                      (own["digest"] or "").removeprefix("sha1:") or None, None, None)
                        else:
                            result = (None,) * 4 if part else opened(own, block)
                        rows.append((
                            origin or f["warc-record-id"], f["warc-type"], f.get("page-id"), f.get("warc-target-uri"), own["digest"],
                            f.get("payload-length"), f.get("refers-to-page-id"), int(part) if part else None,
                            int(f["warc-segment-total-length"]) if "warc-segment-total-length" in f else None, block if part else None, *result))
                        held += len(block)
                        if len(rows) == 2000 or held > 1 << 24:
                            yield _batch(rows, kinds, names)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, kinds, names)

    head = [F.max_by(c, F.col("type") != "continuation").alias(c)
            for c in ("type", "page_id", "url", "digest", "refers_to", "payload_bytes", "payload_digest", "payload", "error")]
    parts = F.sort_array(F.collect_list(F.when(F.col("segment").isNotNull(), F.struct("segment", "block"))))
    joined = (
        manifest.select("path").repartition(max(1, manifest.count())).mapInArrow(read, RECORD).groupBy("key")
        .agg(*head, F.max("total").alias("total"), parts.alias("parts"))
        .select(*(c for c in ("type", "page_id", "url", "digest", "refers_to", "payload_bytes", "payload_digest", "payload", "error", "total")),
                F.expr("transform(parts, p -> p.segment)").alias("numbers"), F.expr("transform(parts, p -> p.block)").alias("blocks"))
    )
    result = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary, error string"
    out_kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.string()]
    out_names = [x.split()[0] for x in result.split(", ")]

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                found = (r["payload_bytes"], r["payload_digest"], r["payload"], r["error"])
                if r["numbers"]:
                    block = b"".join(r["blocks"])
                    if r["numbers"] != list(range(1, len(r["numbers"]) + 1)):
                        found = (None, None, None, "segments missing or repeated")
                    elif r["total"] != len(block):
                        found = (None, None, None, "total length differs")
                    else:
                        found = opened({"digest": r["digest"]}, block)
                rows.append((int(r["page_id"]) if r["page_id"] else None, r["url"], r["type"],
                             int(r["refers_to"]) if r["refers_to"] else None, *found))
            if rows:
                yield _batch(rows, out_kinds, out_names)

    out = joined.mapInArrow(assemble, result)
    return out if with_payload else out.drop("payload")


def _batch(rows: list[tuple], kinds: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)


def archive(spark: SparkSession, path: str, **options) -> DataFrame:
    """Write the table's pages to fresh archives below the shared folder and read them back; see the two functions above."""
    return read_warc(spark, write_warc(spark, path, Scratch(spark, "warc").folder, **options))
