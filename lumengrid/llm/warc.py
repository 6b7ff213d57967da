"""WARC writing, and a splittable reader.

Writer: each task writes gzip members, one record each, to an archive of its own in the shared folder; a name is unique
to the attempt, and only archives that a finished task reports count, so a retried task does no harm. Of records with
equal payloads the one with the smallest page_id is a response, the others revisit it.

Reader: an archive is cut into byte ranges. A task looks for gzip magic in its range, decodes the start of each
candidate and accepts it as a record if a WARC header appears; it then owns all records that start inside its range and
reads the last of them past the range's end. So each record has one owner, whatever the range size.

Archives of others are read too: ids are kept as text (page_id and refers_to are null unless they are ours), requests,
metadata and other types are rows of their type, and lengths that are no numbers don't matter. Damage is told, not
hidden: each member that begins like a record gives a row with its place and a status, which is `ok`, `corrupt` (its
bytes don't decode, or fail their check sum), `truncated` (the archive ends within it) or `malformed` (no WARC header, or
a block shorter than it says); what could be decoded of the header is told, the payload is null.

Defined cases: a null payload counts as empty, and empty payloads are equal to each other; a page with a null page_id
is a response and refers to nothing (its id comes back as null); repeated rows of the smallest page_id are a response
each; an empty table gives no archives and no rows; a payload of any length is one record, held whole by one task at a
time; other columns aren't read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import as_bytes, meet, saved, shared_dir, table

#: Bytes of an archive range that one reading task owns.
RANGE_BYTES = 64 << 20
#: Payloads of fewer bytes are never written as revisits.
LEAST_REVISIT = 0
_MAGIC = b"\x1f\x8b\x08"
_BEGIN = b"WARC/1."
#: Bytes read at once: within a range, and beyond its end.
_STEP, _LOOK = 1 << 20, 1 << 14
#: Reading tasks at most; with more ranges, a task reads several.
MOST_TASKS = 100_000


def digest(payload: bytes) -> str:
    """Base32 SHA-1 in upper case."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


_urn = "urn:page:{}".format


def record(page_id: int | None, url: str | None, payload: bytes, sha: str, refers_to: int | None) -> bytes:
    """One gzip member with a response record, or with a revisit record that holds no payload."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    head = {"WARC-Type": "response" if refers_to is None else "revisit"}
    if page_id is not None:
        head["WARC-Record-ID"] = f"<{_urn(page_id)}>"
    if url is not None:
        head["WARC-Target-URI"] = " ".join(url.split())
    head |= {"WARC-Date": "1970-01-01T00:00:00Z", "WARC-Payload-Digest": f"sha1:{sha}", "Content-Type": "application/http; msgtype=response"}
    if refers_to is not None:
        head |= {"WARC-Refers-To": f"<{_urn(refers_to)}>", "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"}
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head.items()) + f"Content-Length: {len(block)}\r\n\r\n"
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(text.encode() + block + b"\r\n\r\n") + pack.flush()


def _number(text: str | bytes | None) -> int | None:
    try:
        return max(0, int(text))
    except (TypeError, ValueError):
        return None


_OURS = re.compile(r"<?urn:page:(-?\d+)>?")


def _own(ident: str | None) -> int | None:
    """The page_id of an id that the writer made."""
    found = _OURS.fullmatch(ident or "")
    return int(found[1]) if found else None


def _told_digest(value: str | None) -> tuple[str | None, str | None]:
    """Algorithm and value of a digest field; SHA-1 in hex becomes base32."""
    if not value:
        return None, None
    kind, _, text = value.rpartition(":")
    if kind.lower() in ("", "sha1") and re.fullmatch(r"[0-9A-Fa-f]{40}", text):
        text = base64.b32encode(bytes.fromhex(text)).decode()
    return kind.lower() or None, text


def _parse(data: bytes, status: str = "ok") -> dict:
    """The fields of a decoded record; of a damaged one, those that its header tells."""
    end = data.find(b"\r\n\r\n")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in data[: end if end >= 0 else len(data)].decode("utf-8", "replace").split("\r\n")[1:])}
    length, kind = _number(head.get("content-length")), head.get("warc-type")
    if status == "ok" and (end < 0 or (length is not None and len(data) < end + 4 + length)):
        status = "malformed"
    block = data[end + 4 : None if length is None else end + 4 + length]
    split = block.find(b"\r\n\r\n")
    http, payload = (block[:split], block[split + 4 :]) if block.startswith(b"HTTP/") and split >= 0 else (b"", block)
    told = next((n for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:") and (n := _number(x.partition(b":")[2])) is not None), None)
    algorithm, sha = _told_digest(head.get("warc-payload-digest"))
    whole = status == "ok" and kind != "revisit"
    known = algorithm in (None, "sha1")
    return {
        "page_id": _own(head.get("warc-record-id")), "record_id": head.get("warc-record-id"), "record_type": kind, "refers_to": _own(head.get("warc-refers-to")), "refers_to_id": head.get("warc-refers-to"), "url": head.get("warc-target-uri"),
        "payload_bytes": len(payload) if whole else told if kind == "revisit" else None, "payload_digest": sha if sha else digest(payload) if whole else None, "payload": payload if whole else None,
        "intact": status == "ok" and (digest(payload) == sha if whole and sha and known else None if sha and not known else True), "status": status,
    }


def _readable(unpack, piece) -> bytes:
    """What decodes of a piece up to its first error: byte by byte."""
    out = []
    for i in range(len(piece)):
        try:
            out.append(unpack.decompress(piece[i : i + 1]))
        except zlib.error:
            break
    return b"".join(out)


class _Ahead:
    """The bytes of an open archive from `at` on: read forward, a step at a time, and kept only until they are passed. A range costs its own bytes and those of the last record that starts in it."""

    def __init__(self, source, size: int, at: int, end: int):
        self.source, self.size, self.at, self.end = source, size, at, end
        self.base, self.data = at, memoryview(b"")

    def more(self) -> bool:
        """Read on, keeping what isn't passed yet; in small steps beyond the range's end, where only one record is left to finish."""
        place = self.base + len(self.data)
        if place >= self.size:
            return False
        self.source.seek(place)
        part = self.source.read(min(_STEP, self.end - place) if place < self.end else min(_LOOK, self.size - place))
        self.base, self.data = self.at, memoryview(bytes(self.data[self.at - self.base :]) + part)
        return bool(part)

    def back(self, to: int) -> None:
        """Go back to a place; what the buffer no longer holds is read again."""
        self.at = to
        if not self.base <= to <= self.base + len(self.data):
            self.base, self.data = to, memoryview(b"")

    def find(self, what: bytes, before: int) -> bool:
        """Go to the next place of `what` that starts before `before`."""
        while True:
            found = self.data.obj.find(what, self.at - self.base)
            if found >= 0:
                self.at = self.base + found
                return self.at < before
            self.at = max(self.at, self.base + len(self.data) - len(what) + 1)
            if self.at >= before or not self.more():
                return False

    def member(self) -> tuple[bytes, str] | None:
        """The record decoded from the gzip member here, which is then passed, and its status; None, at the same place, if the data doesn't decode to the beginning of a record. The first bytes decide early; compressed bytes are passed as they are decoded. A damaged record isn't passed: the next may begin anywhere after its first byte."""
        start, unpack, out, head, status = self.at, zlib.decompressobj(31), [], b"", "truncated"
        while self.at < self.base + len(self.data) or self.more():
            piece = self.data[self.at - self.base :][:_LOOK]
            before = unpack.copy()
            try:
                out.append(unpack.decompress(piece))
            except zlib.error:
                out.append(_readable(before, piece))
                status = "corrupt"
            self.at += len(piece) - len(unpack.unused_data)
            head = (head + out[-1])[: len(_BEGIN)]
            if head != _BEGIN[: len(head)] or status == "corrupt":
                break
            if unpack.eof:
                status = "ok"
                break
        if head != _BEGIN:
            self.back(start)
            return None
        if status != "ok":
            self.back(start)
        return b"".join(out), status


def records_in_range(source, size: int, start: int, end: int) -> Iterator[dict]:
    """The records of an open archive that start in [start, end), with their offset and status: candidates are searched by gzip magic and accepted if they decode to the beginning of a record; a record's end is the next candidate."""
    ahead = _Ahead(source, size, start, end)
    while ahead.at < end and ahead.find(_MAGIC, end):
        begin = ahead.at
        got = ahead.member()
        if got:
            yield {**_parse(*got), "offset": begin}
        if not got or got[1] != "ok":
            ahead.back(begin + 1)


def write_archives(pages: DataFrame) -> DataFrame:
    """Write (page_id, url, html, sha: hex SHA-1 of the payload, refers_to) as archives; a row per archive: path, size, no (0, 1, ...; not all in use), folder."""
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = fs.FileSystem.from_uri(folder)
        out, path = None, ""
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(base, recursive=True)
                path = f"{base}/{uuid.uuid4().hex}.warc.gz"
                out = store.open_output_stream(path, compression=None)
            ids, urls, shas, refers = (batch.column(i).to_pylist() for i in (0, 1, 3, 4))
            for i, url, payload, sha, first in zip(ids, urls, as_bytes(batch.column(2)), shas, refers):
                out.write(record(i, url, payload, base64.b32encode(bytes.fromhex(sha)).decode(), first))
        if out is not None:
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "size": pa.array([store.get_file_info(path).size], pa.int64()), "no": pa.array([TaskContext.get().partitionId()], pa.int64())})

    made = saved(pages.select("page_id", "url", "html", "sha", "refers_to").mapInArrow(write, "path string, size long, no long"), "archives")
    return made.withColumn("folder", F.lit(folder))


_READ_TYPE = pa.schema([("page_id", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("refers_to_id", pa.string()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("intact", pa.bool_()), ("status", pa.string()), ("offset", pa.int64()), ("path", pa.string())])
_READ = "page_id long, record_id string, record_type string, refers_to long, refers_to_id string, url string, payload_bytes long, payload_digest string, payload binary, intact boolean, status string, offset long, path string"


def archives_at(spark: SparkSession, folder: str, pattern: str = "*.warc.gz") -> DataFrame:
    """A table of archives for read_archives(), whoever wrote them: all files of that name below a folder. Their contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern).load(folder)
    return saved(files.select(F.col("path"), F.col("length").alias("size"), F.xxhash64("path").alias("no"), F.lit(None).cast("string").alias("folder")), "archives")


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES, most: int = MOST_TASKS) -> DataFrame:
    """The records of archives (path, size, no; folder, or null if the path is a URI), read range by range; the number of tasks grows with that of the ranges."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start, folder in zip(*(batch.column(i).to_pylist() for i in range(4))):
                store, at = (fs.FileSystem.from_uri(folder)[0], path) if folder else fs.FileSystem.from_uri(path)
                with store.open_input_file(at) as source:
                    rows, held = [], 0
                    for r in records_in_range(source, size, start, min(size, start + range_bytes)):
                        rows.append({**r, "path": path})
                        held += len(r["payload"] or b"")
                        if held > 8 << 20 or len(rows) >= 5000:
                            yield pa.RecordBatch.from_pylist(rows, schema=_READ_TYPE)
                            rows, held = [], 0
                    yield pa.RecordBatch.from_pylist(rows, schema=_READ_TYPE)

    amount = archives.agg(F.sum(F.ceil(F.col("size") / range_bytes)), F.count(F.lit(1))).first()
    ranges = archives.where("size > 0").select("path", "size", F.explode(F.expr(f"sequence(0L, size - 1, {range_bytes}L)")).alias("start"), "folder", "no")
    tasks = max(1, min(most, int(amount[0] or 0)))
    # an archive's ranges lie as many places apart as there are archives, so tasks get equal numbers of them; the given number keeps tiny rows of ranges from being merged into one task
    dealt = ranges.repartitionById(tasks, F.pmod(F.pmod(F.col("no"), F.lit(1 << 40)) + F.expr(f"start div {range_bytes}L") * amount[1], F.lit(tasks)).cast("int"))
    return dealt.select("path", "size", "start", "folder").mapInArrow(read, _READ)


def pages_to_archives(pages: DataFrame) -> DataFrame:
    """Write pages (page_id, url, html) as archives. Only ids, digests and lengths are grouped; a payload moves once, to meet its decision."""
    own = pages.select(F.col("page_id").cast("long"), "url", "html", F.sha1(F.coalesce("html", F.lit("")).cast("binary")).alias("sha"))
    marks = own.where("page_id is not null").where(F.coalesce(F.octet_length("html"), F.lit(0)) >= LEAST_REVISIT)
    marks = saved(marks.select("page_id", "sha"), "payloads")
    first = marks.groupBy("sha").agg(F.min("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = meet(marks, first, ["sha"], "n").where("page_id > refers_to").select("page_id", "sha", "refers_to").distinct()
    return write_archives(own.join(revisits.hint("shuffle_hash"), ["page_id", "sha"], "left"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = pages_to_archives(table(spark, sf_dir, "pages"))
    return read_archives(archives).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
     b AS (SELECT page_id, html, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
             1 + ((((strpos('0123456789abcdef', substr(hex, 1 + (5 * i) // 4, 1)) - 1) * 16 + greatest(0, strpos('0123456789abcdef', substr(hex, 2 + (5 * i) // 4, 1)) - 1)) // CAST(pow(2, 3 - (5 * i) % 4) AS INTEGER)) % 32), 1)), '') AS payload_digest FROM p),
     f AS (SELECT payload_digest, min(page_id) AS first_id FROM b GROUP BY payload_digest)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN page_id > first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first_id THEN first_id END AS refers_to
FROM b JOIN f USING (payload_digest)
"""
