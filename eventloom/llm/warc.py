"""Web archives: a gzip member for each record, and a reader that splits files anywhere.

Writing needs nothing but Spark's text sink. A member ends with the length of its content as four bytes, low byte
first, so the last one is zero below 16 MB; the sink puts that zero as its line separator. A longer record is
followed by an empty member, which ends with a zero too. Any gzip reader sees plain members one after the other.

Reading scans byte ranges for the gzip magic: Spark's text source splits files by size and cuts them
at the magic. A task tries each cut as a member: its header must decode and its content begin as a record
does. Magic bytes inside a member fail that test, or come while a member is not at its end, and are put
back into it. Records belong to the task in whose range they start. What a
range ends with may go on in the next one; such rests, about one in 16 MB, are put together afterwards.

Pages with equal payloads of at least ``min_bytes`` are one response, that with the smallest id,
and revisits that refer to it. A null payload is an empty one. Pages without an id are always responses and come back
without one; rows with the same smallest id are all responses. Null addresses are left out of the
record. An empty table gives no records.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections import deque
from collections.abc import Iterator
from itertools import groupby
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.tables import small, written

MAGIC = b"\x1f\x8b\x08"
GZIP = 31
DATE = "2000-01-01T00:00:00Z"

RECORD = (
    "record_type string, headers map<string,string>, http map<string,string>, payload binary, payload_bytes bigint, payload_digest string"
)
_READ = f"{RECORD}, file string, range bigint, turn bigint, rest binary"


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, GZIP)
    return packer.compress(data) + packer.flush()


def sealed(record: bytes) -> bytes:
    """A record as a member whose last byte, a zero, is left to the sink."""
    member = _member(record)
    if member[-1]:
        member += _member(b"")
    return member[:-1]


def record(kind: str, headers: dict[str, str], block: bytes) -> bytes:
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Date: {DATE}", *(f"{k}: {v}" for k, v in headers.items()), f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _page_record(page, url: str | None, payload: bytes, refers_to, name: str) -> bytes:
    headers = {"WARC-Payload-Digest": f"sha1:{digest(payload)}", "Content-Type": "application/http; msgtype=response"}
    if url is not None:
        headers["WARC-Target-URI"] = quote(url, safe="%/:?#[]@!$&'()*+,;=-._~")
    if page is not None:
        headers["WARC-Record-ID"] = f"<urn:page:{page}>"
    else:
        headers["WARC-Record-ID"] = f"<urn:page-without-id:{name}>"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if refers_to is None:
        return record("response", headers, http + payload)
    headers["WARC-Refers-To"] = f"<urn:page:{refers_to}>"
    headers["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
    return record("revisit", headers, http)


def write_archives(pages: DataFrame, path: str, key: str = "page_id", url: str = "url", payload: str = "html", min_bytes: int = 0) -> None:
    """A folder of archives, one for each partition of ``pages``."""
    from pyspark import TaskContext

    body = F.coalesce(F.col(payload).cast("binary"), F.lit("").cast("binary"))
    known = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), body.alias("body")).withColumn("sha", F.sha1("body"))
    groups = known.where(F.octet_length("body") >= min_bytes).groupBy("sha").agg(F.min("key").alias("first"), F.count(F.lit(1)).alias("n"))
    groups = written(groups.where("n > 1").select("sha", "first"), "payloads")
    linked = known.join(small(groups), "sha", "left")
    refers = F.when((F.octet_length("body") >= min_bytes) & (F.col("key") > F.col("first")), F.col("first"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        info = record("warcinfo", {"Content-Type": "application/warc-fields"}, b"format: WARC File Format 1.1\r\n")
        number, members, size = 0, [sealed(info)], 0
        for batch in batches:
            for row in zip(*batch.columns):
                page, address, data, refers_to = (value.as_py() for value in row)
                members.append(sealed(_page_record(page, address, data, refers_to, f"{part}-{number}")))
                number += 1
                size += len(members[-1])
                if size > 1 << 24:
                    yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["value"])
                    members, size = [], 0
        if members:
            yield pa.RecordBatch.from_arrays([pa.array(members, pa.binary())], names=["value"])

    packed = linked.select("key", "url", "body", refers.alias("refers")).mapInArrow(run, "value binary")
    # The cast keeps the bytes as they are.
    packed.select(F.col("value").cast("string").alias("value")).write.text(path, compression="none", lineSep="\0")


def _fields(lines: list[bytes]) -> dict[str, str]:
    parts = (line.decode("utf-8", "replace").partition(":") for line in lines)
    return {name.strip(): value.strip() for name, colon, value in parts if colon}


def parse(data: bytes, with_payload: bool) -> dict | None:
    """A record's columns; None if it is none."""
    head, end, rest = data.partition(b"\r\n\r\n")
    first, *lines = head.split(b"\r\n")
    if not end or not first.startswith(b"WARC/"):
        return None
    headers = _fields(lines)
    block = rest[: int(headers.get("Content-Length", 0))]
    http: dict[str, str] = {}
    payload: bytes | None = block
    if headers.get("Content-Type", "").startswith("application/http"):
        head, _, payload = block.partition(b"\r\n\r\n")
        http = _fields(head.split(b"\r\n")[1:])
    kind = headers.get("WARC-Type")
    if kind == "revisit":
        known = http.get("Content-Length", "")
        size, name = int(known) if known.isdigit() else None, headers.get("WARC-Payload-Digest", "").rpartition(":")[2] or None
        payload = None
    else:
        size, name = len(payload), digest(payload)
    return {
        "record_type": kind, "headers": headers, "http": http, "payload": payload if with_payload else None, "payload_bytes": size, "payload_digest": name,
    }


class _Open:
    """A member whose end has not come."""

    def __init__(self):
        self.parts: list[bytes] = []
        self.unpacker = zlib.decompressobj(GZIP)
        self.content: list[bytes] = []
        self.ended = False

    def feed(self, data: bytes) -> None:
        self.content.append(self.unpacker.decompress(data))
        self.parts.append(data)
        self.ended = self.unpacker.eof

    def plausible(self) -> bool:
        start = b"".join(self.content[:9])[:5]
        return b"WARC/".startswith(start) or (self.ended and not start)

    def certain(self) -> bool:
        """Whether it has begun as a record does; a few bytes of header say little."""
        return self.ended or b"".join(self.content[:9])[:5] == b"WARC/"


def _started(data: bytes) -> _Open | None:
    """A member that starts with these bytes, if they can be one."""
    member = _Open()
    return member if _goes_on(member, data) else None


def _goes_on(member: _Open, data: bytes) -> bool:
    try:
        member.feed(data)
    except zlib.error:
        return False
    return member.plausible()


def read_archives(spark: SparkSession, path: str, with_payload: bool = True) -> DataFrame:
    """(record_type, headers, http, payload, payload_bytes, payload_digest) of all records of the archives at ``path``."""
    cuts = (
        spark.read.option("lineSep", MAGIC.decode("latin-1"))
        .option("encoding", "ISO-8859-1")
        .text(path)
        .select("_metadata.file_path", "_metadata.file_block_start", F.col("value").cast("binary").alias("value"))
    )
    keys = list(dict.fromkeys(part.split()[0] for part in _READ.split(", ")))

    def table(rows: list[dict]) -> pa.RecordBatch:
        kinds = [pa.string(), pa.map_(pa.string(), pa.string()), pa.map_(pa.string(), pa.string()), pa.binary(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.binary()]
        values = ([list(v.items()) if isinstance(v := row.get(k), dict) else v for row in rows] for k in keys)
        return pa.RecordBatch.from_arrays([pa.array(v, kind) for v, kind in zip(values, kinds)], names=keys)

    def batched(rows: Iterator[dict]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for row in rows:
            waiting.append(row)
            size += 1000 + len(row.get("payload") or row.get("rest") or b"")
            if size > 1 << 23:
                yield table(waiting)
                waiting, size = [], 0
        if waiting:
            yield table(waiting)

    def scan(cuts: Iterator[tuple[str, int, bytes]]) -> Iterator[dict]:
        for (file, begin), group in groupby(cuts, key=lambda cut: cut[:2]):
            values = (value for _, _, value in group)
            if begin == 0:  # what comes before the first magic
                next(values, None)
            yield from own(file, begin, values)

    def own(file: str, begin: int, values: Iterator[bytes]) -> Iterator[dict]:
        """Records that start in one range, and rests that may belong to one from a range before or go on in the next."""
        waiting: deque[bytes] = deque()
        member, owned, turn = None, begin == 0, 0

        def rest(data: bytes) -> dict:
            return {"file": file, "range": begin, "turn": turn, "rest": data}

        while waiting or (value := next(values, None)) is not None:
            data = waiting.popleft() if waiting else MAGIC + value
            if member is None:
                member = _started(data)
                if member is None:
                    if not owned:
                        yield rest(data)
                        turn += 1
                    continue
            elif not _goes_on(member, data):
                # Either damaged, or no member at all: then what it took may hold the next one.
                taken = member.parts if member.parts[-1] is data else [*member.parts, data]
                if not member.certain():
                    if not owned:
                        yield rest(taken[0])
                        turn += 1
                    waiting.extendleft(reversed(taken[1:]))
                else:
                    waiting.appendleft(data)
                member = None
                continue
            owned = owned or member.certain()
            if member.ended:
                if (found := parse(b"".join(member.content), with_payload)) is not None:
                    yield found
                member = None
        if member is not None:
            yield rest(b"".join(member.parts))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(scan(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))))

    def join(rests: Iterator[tuple[str, int, int, bytes]]) -> Iterator[dict]:
        for _, group in groupby(rests, key=lambda rest: rest[0]):
            member = None
            for _, _, _, data in group:
                while data:
                    # What follows a member that has not ended belongs to it.
                    if member is not None and not _goes_on(member, data):
                        member = None
                    elif member is not None:
                        data = b""
                    if member is None:
                        member, data = _started(data), b""
                    if member is not None and member.ended:
                        if (found := parse(b"".join(member.content), with_payload)) is not None:
                            yield found
                        more = member.unpacker.unused_data
                        member, data = None, more if more.startswith(MAGIC) else b""

    def run_rests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched(join(row for b in batches for row in zip(*(c.to_pylist() for c in b.columns))))

    found = written(cuts.mapInArrow(run, _READ), "records")
    rests = found.where("rest IS NOT NULL").select("file", "range", "turn", "rest").repartition("file").sortWithinPartitions("file", "range", "turn")
    columns = keys[:6]
    return found.where("rest IS NULL").select(columns).unionByName(rests.mapInArrow(run_rests, _READ).select(columns))
