"""WARC writing with revisit records, and a splittable reader of gzip members.

Every record is a gzip member of its own. A reading task gets a byte range: it
looks for the gzip magic from the range's start, takes a member as a record only if
it decodes to a WARC header, and owns every record that starts inside its range,
also where the record ends behind it.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tapewire.llm.common import dealt, open_store, shared_folder, stage

MAGIC = b"\x1f\x8b\x08"
SPLIT_BYTES = 16 << 20
READ_BYTES = 1 << 20
BATCH_BYTES = 8 << 20
HEAD_BYTES = 64 << 10  # decoded at once while the end of a header is looked for
RECORD_ID = "urn:page:"
DATE = "2000-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _field(value: str) -> str:
    """A header value on one line of ASCII: other characters as percent escapes of their UTF-8 bytes."""
    return "".join(chr(b) if 32 < b < 127 else f"%{b:02X}" for b in value.encode("utf-8", "surrogatepass"))


def record_bytes(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None) -> bytes:
    """One gzip member: a response with its payload, or a revisit that names the response."""
    digest = base32_sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <{RECORD_ID}{'none' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_field(url)}"] if url else []),
        *([f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {PROFILE}"] if refers_to is not None else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return packer.compress(head) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def mark_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, payload and refers_to: the smallest page_id with an equal payload, null for responses.

    Payload is the html in UTF-8, empty if null. Payloads under `least` bytes, rows
    with a null page_id and rows that repeat the smallest id are responses. Equality
    is that of length and SHA-256. Payloads that occur once never leave the scan:
    only digests of repeated ones are joined back, from a written table, so a
    payload with a third of all rows is split by AQE.
    """
    rows = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.encode(F.coalesce(F.col("html"), F.lit("")), "UTF-8").alias("payload"),
    )
    key = F.when((F.length("payload") >= least) & F.col("page_id").isNotNull(), F.sha2("payload", 256))
    keyed = rows.withColumn("key", key)
    groups = keyed.where("key IS NOT NULL").groupBy("key").agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
    repeated = stage(groups.where("n > 1").select("key", "first"), "warc-repeats")
    other = F.when(F.col("first") != F.col("page_id"), F.col("first"))
    return keyed.join(repeated, "key", "left").select("page_id", "url", "payload", other.alias("refers_to"))


FILES = "path string, bytes long, records long"


def write_warc(records: DataFrame, folder: str | None = None) -> DataFrame:
    """Write page_id, url, payload, refers_to as .warc.gz files, one per task; the staged list of files.

    A task writes under a name of its attempt and renames at the end. Tasks without
    rows write no file.
    """
    folder = folder or shared_folder(records.sparkSession, "warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, size, count = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", None, 0, 0
        for batch in batches:
            columns = [batch[c] for c in ("page_id", "url", "payload", "refers_to")]
            for row in zip(*columns, strict=True):
                if out is None:
                    store, final = open_store(path)
                    store.create_dir(final.rpartition("/")[0])
                    trial = f"{final}.{TaskContext.get().taskAttemptId()}"
                    out = store.open_output_stream(trial)
                data = record_bytes(*[v.as_py() for v in row])
                out.write(data)
                size, count = size + len(data), count + 1
        if out is not None:
            out.close()
            store.move(trial, final)
            yield pa.RecordBatch.from_pydict({"path": [path], "bytes": [size], "records": [count]})

    return stage(records.select("page_id", "url", "payload", "refers_to").mapInArrow(write, FILES), "warc-files")


class Member:
    """A gzip member that is read from `source` at `at`, a piece at a time."""

    def __init__(self, source, at: int):
        self.source, self.at, self.end = source, at, None
        self.inflate = zlib.decompressobj(31)
        source.seek(at)
        self.place, self.rest = at, b""

    def read(self, most: int) -> bytes:
        """Up to `most` decoded bytes; none at the end. zlib checks the CRC and length at the end."""
        while not self.inflate.eof:
            if not self.rest:
                self.rest = self.source.read(READ_BYTES)
                self.place += len(self.rest)
                if not self.rest:
                    raise zlib.error("the file ends inside a member")
            data = self.inflate.decompress(self.rest, most)
            self.rest = self.inflate.unconsumed_tail
            if data:
                return data
        if self.end is None:
            self.end = self.place - len(self.inflate.unused_data)
        return b""


def _headers(text: bytes) -> dict[str, str]:
    pairs = (line.partition(b":") for line in text.split(b"\r\n")[1:])
    return {k.strip().lower().decode("latin-1"): v.strip().decode("latin-1") for k, _, v in pairs}


def read_member(source, at: int) -> tuple[dict[str, str], bytes, int] | None:
    """WARC headers, block and end of the record that starts at `at`; None if there is none.

    What begins as a WARC header is read until the header ends, at most to the end of its member.
    """
    member, data = Member(source, at), bytearray()
    try:
        seen = 0
        while (cut := data.find(b"\r\n\r\n", max(seen - 3, 0))) < 0:
            seen = len(data)
            more = member.read(HEAD_BYTES)
            data += more
            if not more or not data.startswith(b"WARC/1."[: len(data)]):
                return None
        headers = _headers(bytes(data[:cut]))
        length = int(headers["content-length"])
        if not data.startswith(b"WARC/1.") or length < 0 or "warc-type" not in headers:
            return None
        del data[: cut + 4]
        while more := member.read(READ_BYTES):
            data += more
        return (headers, bytes(data[:length]), member.end) if len(data) >= length else None
    except (zlib.error, KeyError, ValueError):
        return None


def records_in_range(source, start: int, end: int) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of the records that start in [start, end).

    Behind a record the next one is tried at once. Where none starts, the next
    magic is looked for, so a damaged member costs only itself. A whole WARC archive
    stored without compression inside a record could be taken for records by a range
    that begins inside it; archives of text never hold one.
    """
    at = start
    while at < end:
        found = read_member(source, at)
        if found:
            headers, block, at = found
            yield headers, block
            continue
        base, tail = at + 1, b""
        source.seek(base)
        while True:
            data = tail + source.read(READ_BYTES)
            hit = data.find(MAGIC)
            if hit >= 0:
                at = base + hit
                break
            if len(data) <= len(tail) or base >= end:
                return
            tail = data[-2:]
            base += len(data) - len(tail)


def read_warc(files: DataFrame, split: int = SPLIT_BYTES) -> DataFrame:
    """Records of the listed archives: record_id, type, target_uri, refers_to_id, payload_digest, http_length, payload.

    `files` needs path and bytes. Each file is read in ranges of `split` bytes, one
    row per range, dealt over the tasks. payload is what follows the HTTP header;
    http_length is the Content-Length of that header, which a revisit keeps though
    its payload is left out. Records of other types have null HTTP columns.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.greatest(F.col("bytes") - 1, F.lit(0)), F.lit(split).cast("bigint")))
    ranges = files.select("path", "bytes", starts.alias("start")).withColumn("end", F.least("bytes", F.col("start") + split))
    names = ["record_id", "type", "target_uri", "refers_to_id", "payload_digest", "http_length", "payload"]
    kinds = [*[pa.string()] * 5, pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names)

        rows, size = [], 0
        for part in batches:
            for r in part.to_pylist():
                store, path = open_store(r["path"])
                with store.open_input_file(path) as source:
                    for headers, block in records_in_range(source, r["start"], r["end"]):
                        http, payload = None, None
                        if headers.get("content-type", "").startswith("application/http"):
                            head, _, payload = block.partition(b"\r\n\r\n")
                            length = _headers(head).get("content-length", "")
                            http = int(length) if length.isdigit() else None
                        digest = headers.get("warc-payload-digest", "").removeprefix("sha1:") or None
                        reference = headers.get("warc-refers-to")
                        rows.append(
                            (headers.get("warc-record-id", "").strip("<>"), headers["warc-type"], headers.get("warc-target-uri"))
                            + (reference and reference.strip("<>"), digest, http, payload)
                        )
                        size += len(block) + 1000
                        if size > BATCH_BYTES:
                            yield batch(rows)
                            rows, size = [], 0
        if rows:
            yield batch(rows)

    spread = dealt(ranges.withColumn("size", F.col("end") - F.col("start")), "size", ["path", "start"], max(1, split // 4)).drop("size")
    columns = [f"{n} string" for n in names[:5]] + ["http_length long", "payload binary"]
    return spread.mapInArrow(read, ", ".join(columns))


def checked(rows: DataFrame, files: DataFrame) -> DataFrame:
    """`rows` written once; ValueError unless they are as many as the records that `files` lists.

    `rows` has one row per record read, best without the payloads.
    """
    rows = stage(rows, "warc-read")
    listed, read = files.agg(F.coalesce(F.sum("records"), F.lit(0))).first()[0], rows.count()
    if listed != read:
        raise ValueError(f"{read} records read of {listed} written")
    return rows


def page_number(record_id: Column) -> Column:
    """The page_id of a record id; null where the page had none."""
    digits = F.regexp_extract(record_id, r"^urn:page:(-?\d+)$", 1)
    return F.when(digits != "", digits).cast("bigint")
