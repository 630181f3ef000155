"""WARC archives in ZIP packages: written by Spark's own writer, read back by byte ranges.

A package is a ZIP file of stored (uncompressed) members: WARC files under archive/ and an index of their records under
indexes/. A reader takes the central directory from the end of the file (ZIP64 where sizes ask for it), so it knows
where each member's bytes lie, reads the index, and then only the records it wants; nothing is extracted.

Packages are written through the text writer, a row for each piece that ends in a newline, so they land wherever Spark
can write and only whole ones are committed. Ranges are read with Arrow's file systems (local and shared folders, S3,
GCS, HDFS with its library).
"""

from __future__ import annotations

import base64
import hashlib
import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import save, shared_dir

#: Signatures and flags of the ZIP format, and the most that 32 and 16 bits hold (fixed values).
LOCAL, CENTRAL, END, END64, LOCATOR64, DESCRIPTOR = 0x04034B50, 0x02014B50, 0x06054B50, 0x06064B50, 0x07064B50, 0x08074B50
FULL32, FULL16 = 0xFFFFFFFF, 0xFFFF
SIZES_BEHIND, UTF8_NAMES = 0x0008, 0x0800
#: 1 January 1980, the first date that ZIP has; the date of all records, so that reruns agree.
ZIP_DATE, WARC_DATE = 0x0021, "1980-01-01T00:00:00Z"

#: A WARC member is closed when it has so many bytes, and the next one begun.
MEMBER_BYTES = 256 << 20
#: Entries are read by tasks in runs of so many bytes of one package.
SLAB_BYTES = 8 << 20
#: Directories and members are read in pieces of so many bytes.
PIECE = 1 << 20


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- writing ----


def record(kind: str, record_id: str, payload: bytes, digest: str, size: int, uri: str | None, refers_to: str | None, extra: dict[str, str]) -> bytes:
    """One WARC record with an HTTP response; a revisit has its header alone, which still tells the payload's size."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    body = http + payload if kind == "response" else http
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": f"<{record_id}>",
        "WARC-Date": WARC_DATE,
        "WARC-Target-URI": uri,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Refers-To": f"<{refers_to}>" if refers_to else None,
        "WARC-Profile": "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None,
        **extra,
        "Content-Type": "application/http;msgtype=response",
        "Content-Length": str(len(body)),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return f"WARC/1.1\r\n{lines}\r\n".encode() + body + b"\r\n\r\n"


class Package:
    """The bytes of one ZIP package, piece by piece; every piece ends in a newline.

    Sizes stand behind each member (in 64 bits) and in the directory. big: write ZIP64 fields even where sizes are small.
    """

    def __init__(self, big: bool = False):
        self.at, self.big, self.members, self.name = 0, big, [], None

    def _out(self, data: bytes) -> bytes:
        self.at += len(data)
        return data

    def begin(self, name: str) -> bytes:
        self.name, self.header, self.crc = name, self.at, 0
        sizes = struct.pack("<HHQQ", 1, 16, 0, 0)
        raw = name.encode()
        out = self._out(struct.pack("<IHHHHHIIIHH", LOCAL, 45, SIZES_BEHIND | UTF8_NAMES, 0, 0, ZIP_DATE, 0, FULL32, FULL32, len(raw), len(sizes)) + raw + sizes)
        self.start = self.at
        return out

    def add(self, data: bytes) -> bytes:
        self.crc = zlib.crc32(data, self.crc)
        return self._out(data)

    def end(self) -> bytes:
        size = self.at - self.start
        self.members.append((self.name, self.header, size, self.crc))
        self.name = None
        return self._out(struct.pack("<IIQQ", DESCRIPTOR, self.crc, size, size))

    def finish(self) -> bytes:
        """The directory; its comment is the newline behind it."""
        start, out = self.at, b""
        for name, header, size, crc in self.members:
            raw, wide = name.encode(), b""
            if self.big or size >= FULL32:
                wide += struct.pack("<QQ", size, size)
            if self.big or header >= FULL32:
                wide += struct.pack("<Q", header)
            extra = struct.pack("<HH", 1, len(wide)) + wide if wide else b""
            short = FULL32 if self.big or size >= FULL32 else size
            at = FULL32 if self.big or header >= FULL32 else header
            out += struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, 45, 45, SIZES_BEHIND | UTF8_NAMES, 0, 0, ZIP_DATE, crc, short, short, len(raw), len(extra), 0, 0, 0, 0, at) + raw + extra
        n, size = len(self.members), len(out)
        many = self.big or n >= FULL16 or size >= FULL32 or start >= FULL32
        if many:
            out += struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start)
            out += struct.pack("<IIQI", LOCATOR64, 0, start + size, 1)
        cut = lambda v, most: most if many else v
        out += struct.pack("<IHHHHIIH", END, 0, 0, cut(n, FULL16), cut(n, FULL16), cut(size, FULL32), cut(start, FULL32), 1)
        return self._out(out + b"\n")


def _uri(url: str | None) -> str | None:
    """A url as a header can carry it: what is no visible ASCII becomes %XX."""
    return None if url is None else "".join(chr(b) if 0x20 < b < 0x7F else f"%{b:02X}" for b in url.encode("utf-8", "surrogatepass"))


def _record_id(key: int | None, digest: str) -> str:
    return uuid.uuid5(uuid.NAMESPACE_URL, f"{key}:{digest}").urn


def _package_rows(big: bool, member_bytes: int):
    """Rows (key, url, payload, refers, key_of) to the pieces of one package a task, without their last newlines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        package, lines, opened, head = Package(big), [], 0, b""
        for batch in batches:
            out: list[bytes] = []
            held = 0
            for key, url, payload, revisit, target in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if package.name is None:
                    head = head + package.begin(f"archive/data-{opened:05d}.warc")
                    opened += 1
                digest = base32_sha1(payload)
                kind = "revisit" if revisit else "response"
                extra = {} if key is None else {"X-Page-Id": str(key)}
                data = record(kind, _record_id(key, digest), payload, digest, len(payload), _uri(url), _record_id(target, digest) if revisit else None, extra)
                offset = package.at - package.start
                lines.append((package.name, offset, len(data)))
                out.append(head + package.add(data))
                head, held = b"", held + len(data)
                if package.at - package.start >= member_bytes:
                    head = package.end()
                if held >= 8 * PIECE:
                    yield pa.RecordBatch.from_arrays([pa.array([x[:-1] for x in out], pa.binary())], names=["piece"])
                    out, held = [], 0
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[:-1] for x in out], pa.binary())], names=["piece"])
        if not opened:
            return
        if package.name:
            head += package.end()
        head += package.begin("indexes/index.jsonl")
        for lo in range(0, len(lines), 4096):
            text = "".join(json.dumps({"filename": n, "offset": o, "length": k}) + "\n" for n, o, k in lines[lo : lo + 4096]).encode()
            yield pa.RecordBatch.from_arrays([pa.array([(head + package.add(text))[:-1]], pa.binary())], names=["piece"])
            head = b""
        head = package.end()
        yield pa.RecordBatch.from_arrays([pa.array([(head + package.finish())[:-1]], pa.binary())], names=["piece"])

    return run


def write_packages(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", least: int = 0, big: bool = False, member_bytes: int = MEMBER_BYTES) -> None:
    """Writes a record for every row of pages, one package for each task that has rows.

    The payload is the text in UTF-8 (null: empty). Of rows with equal payloads of at least `least` bytes those with the
    largest id are responses and the others revisits of it (a null id is the smallest; rows that repeat the largest id are
    all responses); rows without an equal are responses. Only payloads that occur more than once are looked up, by
    SHA-256; where they are few Spark broadcasts them and no page is shuffled. Extra columns are not read.
    """
    payload = F.coalesce(F.col(payload_col).cast("binary"), F.lit(b""))
    rows = pages.select(F.col(id_col).cast("long").alias("key"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    rows = rows.withColumn("same", F.when(F.octet_length("payload") >= least, F.sha2("payload", 256)))
    groups = rows.where("same is not null").groupBy("same").agg(F.max("key").alias("target"), F.count(F.lit(1)).alias("n"))
    groups = save(groups.where("n > 1").select("same", "target"), "warc-equal").withColumn("equal", F.lit(True))
    decided = rows.join(groups, "same", "left")
    revisit = F.coalesce(F.col("equal"), F.lit(False)) & ~F.col("key").eqNullSafe(F.col("target"))
    pieces = decided.select("key", "url", "payload", revisit.alias("revisit"), "target").mapInArrow(_package_rows(big, member_bytes), "piece binary")
    pieces.select(F.col("piece").cast("string").alias("value")).write.option("compression", "none").option("lineSep", "\n").text(path)


# ---- reading ----


def _open(path: str):
    """A file that can seek."""
    scheme = urlsplit(path).scheme
    if scheme in ("", "file"):
        return fs.LocalFileSystem().open_input_file(unquote(urlsplit(path).path) if scheme else path)
    system, inside = fs.FileSystem.from_uri(path)
    return system.open_input_file(inside)


def directory(file, size: int) -> Iterator[dict]:
    """The members of a ZIP file of `size` bytes: name, method, header, stored, size, crc. Reads the end and the directory.

    Raises ValueError for what is no ZIP file, is cut off, or spans several disks.
    """
    tail_at = max(0, size - (22 + FULL16))
    tail = file.read_at(size - tail_at, tail_at)
    at = len(tail)
    while True:  # the last end record whose comment fills the rest
        at = tail.rfind(struct.pack("<I", END), 0, at)
        if at < 0:
            raise ValueError("no end of a central directory: not a ZIP file")
        if at + 22 <= len(tail):
            _, disk, first, _, count, length, start, comment = struct.unpack_from("<IHHHHIIH", tail, at)
            if at + 22 + comment == len(tail):
                break
    end = tail_at + at
    if FULL16 in (disk, first, count) or FULL32 in (length, start):
        if end < 20:
            raise ValueError("no locator of a ZIP64 end record")
        magic, _, end64, disks = struct.unpack("<IIQI", file.read_at(20, end - 20))
        if magic != LOCATOR64 or disks > 1:
            raise ValueError("no locator of a ZIP64 end record" if magic != LOCATOR64 else "a ZIP file on several disks")
        magic, _, _, _, disk, first, _, count, length, start = struct.unpack("<IQHHIIQQQQ", file.read_at(56, end64))
        if magic != END64:
            raise ValueError("no ZIP64 end record where its locator points")
        end = end64
    if disk or first:
        raise ValueError("a ZIP file on several disks")
    shift = end - length - start  # bytes put before the file
    if shift < 0:
        raise ValueError("the central directory is cut off")
    at, stop, held, held_at = start + shift, end, b"", start + shift
    for _ in range(count):
        if at + 46 + 3 * FULL16 > held_at + len(held) and held_at + len(held) < stop:
            held, held_at = file.read_at(min(PIECE, stop - at), at), at
        magic, _, _, _, method, _, _, crc, packed, full, n, m, k, _, _, _, header = struct.unpack_from("<IHHHHHHIIIHHHHHII", held, at - held_at)
        if magic != CENTRAL:
            raise ValueError(f"no entry of the central directory at byte {at}")
        name = held[at - held_at + 46 : at - held_at + 46 + n].decode("utf-8", "replace")
        extra = held[at - held_at + 46 + n : at - held_at + 46 + n + m]
        i = 0
        while i + 4 <= len(extra):
            kind, width = struct.unpack_from("<HH", extra, i)
            if kind == 1:  # 64-bit values, in this order, of those fields that are full
                wide = list(struct.unpack_from(f"<{width // 8}Q", extra, i + 4))
                full = wide.pop(0) if full == FULL32 else full
                packed = wide.pop(0) if packed == FULL32 else packed
                header = wide.pop(0) if header == FULL32 else header
            i += 4 + width
        at += 46 + n + m + k
        yield {"member": name, "method": method, "header": header + shift, "size": full, "packed": packed, "crc": crc}


def data_start(file, header: int) -> int:
    """Where a member's bytes begin: behind its local header, whose name and extra field may differ from the directory's."""
    magic, *_, n, m = struct.unpack("<IHHHHHIIIHH", file.read_at(30, header))
    if magic != LOCAL:
        raise ValueError(f"no local header at byte {header}")
    return header + 30 + n + m


def fields(head: bytes) -> dict[str, str]:
    """The named fields of a record's header block, names in lower case; a line that begins with a space continues the last."""
    found: dict[str, str] = {}
    last = None
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        if line[:1] in (" ", "\t") and last:
            found[last] += " " + line.strip()
        elif ":" in line:
            last, value = line.split(":", 1)
            last = last.strip().lower()
            found[last] = value.strip()
    return found


def walk_records(file, start: int, size: int) -> Iterator[tuple[int, int]]:
    """(offset, length) of each record of a WARC member without an index: header by header, bodies are skipped."""
    at = 0
    while at < size:
        head, step = b"", 4096
        while b"\r\n\r\n" not in head:
            more = file.read_at(min(step, size - at - len(head)), start + at + len(head))
            if not more:
                raise ValueError(f"a record at byte {at} of its member has no end of its header")
            head, step = head + more, step * 2
        head = head[: head.index(b"\r\n\r\n") + 4]
        if not head.startswith(b"WARC/"):
            raise ValueError(f"no record at byte {at} of its member")
        length = len(head) + int(fields(head)["content-length"]) + 4
        if at + length > size:
            raise ValueError(f"the record at byte {at} of its member is cut off")
        yield at, length
        at += length


MEMBER_TYPES = "path string, member string, method int, start long, size long, crc long"


def _member_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, size in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            with _open(path) as file:
                found = [(path, m["member"], m["method"], data_start(file, m["header"]), m["size"], m["crc"]) for m in directory(file, size)]
            types = (pa.string(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = zip(*found, strict=True) if found else [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["path", "member", "method", "start", "size", "crc"])


def package_members(spark: SparkSession, path: str) -> DataFrame:
    """(path, member, method, start, size, crc) of all members of the packages in a folder; method 0 is stored. Empty files
    have none."""
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    return files.repartition("path").mapInArrow(_member_batches, MEMBER_TYPES)


ENTRY = pa.schema([("path", pa.string()), ("at", pa.int64()), ("length", pa.int64())])


def _entry_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of packages to their records' ranges: from an index, or by walking a WARC file that has none."""

    def out(path: str, ranges: list[tuple[int, int]]) -> pa.RecordBatch:
        at, length = zip(*ranges, strict=True) if ranges else ((), ())
        return pa.RecordBatch.from_arrays([pa.array([path] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(length, pa.int64())], schema=ENTRY)

    for batch in batches:
        for path, start, size, index, starts in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            with _open(path) as file:
                if not index:
                    ranges = []
                    for at, length in walk_records(file, start, size):
                        ranges.append((start + at, length))
                        if len(ranges) == 4096:
                            yield out(path, ranges)
                            ranges = []
                    yield out(path, ranges)
                    continue
                where, rest = {s["member"]: s["start"] for s in starts}, b""
                for lo in range(0, size, PIECE):
                    *lines, rest = (rest + file.read_at(min(PIECE, size - lo), start + lo)).split(b"\n")
                    entries = [json.loads(x) for x in lines if x]
                    yield out(path, [(where[e["filename"]] + int(e["offset"]), int(e["length"])) for e in entries])
                if rest.strip():
                    e = json.loads(rest)
                    yield out(path, [(where[e["filename"]] + int(e["offset"]), int(e["length"]))])


RECORD_TYPES = "record_id string, type string, target_uri string, refers_to string, page_id long, payload_bytes long, payload_digest string"
RECORD = pa.schema([("record_id", pa.string()), ("type", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string())])


def parse_record(data: bytes) -> tuple[tuple, bytes | None]:
    """A record's row and payload (None for a revisit). The digest of a response is computed and held against its header's."""
    cut = data.index(b"\r\n\r\n")
    head, body = fields(data[:cut]), data[cut + 4 : -4]
    if not data.startswith(b"WARC/") or len(body) != int(head["content-length"]):
        raise ValueError(f"no whole record: {data[:40]!r}")
    cut = body.index(b"\r\n\r\n")
    http, payload = fields(body[:cut]), body[cut + 4 :]
    said = head["warc-payload-digest"].removeprefix("sha1:")
    kind, size, digest = head["warc-type"], int(http["content-length"]), said
    if kind == "response":
        size, digest = len(payload), base32_sha1(payload)
        if digest != said or size != int(http["content-length"]):
            raise ValueError(f"the payload of {head['warc-record-id']} is not what its header tells")
    plain = lambda x: x and x.strip("<>")
    key = head.get("x-page-id")
    row = (plain(head["warc-record-id"]), kind, head.get("warc-target-uri"), plain(head.get("warc-refers-to")), int(key) if key else None, size, digest)
    return row, payload if kind == "response" else None


def _record_batches(payloads: bool):
    """Rows (path, at, length) in order to their records; one file is open at a time, one record is held at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, opened = None, None
        for batch in batches:
            rows, found, held = [], [], 0
            for path, at, length in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ENTRY.names], strict=True):
                if path != opened:
                    if file:
                        file.close()
                    file, opened = _open(path), path
                row, payload = parse_record(file.read_at(length, at))
                rows.append(row)
                found.append(payload)
                held += length if payloads else 0
                if held >= 8 * PIECE:
                    yield _records(rows, found if payloads else None)
                    rows, found, held = [], [], 0
                elif not payloads:
                    found.clear()
            if rows:
                yield _records(rows, found if payloads else None)
        if file:
            file.close()

    return run


def _records(rows: list[tuple], payloads: list[bytes | None] | None) -> pa.RecordBatch:
    arrays = [pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), RECORD, strict=True)]
    if payloads is None:
        return pa.RecordBatch.from_arrays(arrays, schema=RECORD)
    return pa.RecordBatch.from_arrays([*arrays, pa.array(payloads, pa.binary())], names=[*RECORD.names, "payload"])


def read_packages(spark: SparkSession, path: str, payloads: bool = True, wanted: Column | None = None) -> DataFrame:
    """The records in a folder of packages: record_id, type, target_uri, refers_to (a record_id), page_id, payload_bytes,
    payload_digest (of the full payload, for revisits as their headers tell), and payload.

    Packages without an index are walked record by record. Each record is read by its range, in runs of SLAB_BYTES that
    tasks share, whatever package they come from. wanted: a condition on (path, at, length) of what to read. A WARC member
    that is not stored cannot be read by ranges and raises; other members are left alone. A folder without packages (or
    with empty ones) gives no rows.
    """
    members = save(package_members(spark, path), "warc-members")
    warcs = members.where("member like 'archive/%' and size > 0")
    packed = warcs.where("method <> 0").select("path", "member").first()
    if packed:
        raise ValueError(f"{packed.member} in {packed.path} is compressed; its records have no ranges")
    starts = warcs.groupBy("path").agg(F.collect_list(F.struct("member", "start")).alias("starts"))
    index = members.where("member like 'indexes/%' and size > 0 and method = 0").select("path", "start", "size", F.lit(True).alias("index"))
    indexed = index.join(starts, "path")
    walked = warcs.select("path", "start", "size", F.lit(False).alias("index")).join(index.select("path"), "path", "left_anti")
    walked = walked.withColumn("starts", F.lit(None).cast("array<struct<member: string, start: bigint>>"))
    entries = indexed.unionByName(walked).repartition("path", "start").mapInArrow(_entry_batches, "path string, at long, length long")
    if wanted is not None:
        entries = entries.where(wanted)
    slab = F.expr(f"at div {SLAB_BYTES}")
    dealt = entries.repartition("path", slab).sortWithinPartitions("path", "at")
    return dealt.mapInArrow(_record_batches(payloads), RECORD_TYPES + (", payload binary" if payloads else ""))


def resolve(records: DataFrame) -> DataFrame:
    """(page_id, payload_bytes, payload_digest, record_type, refers_to): revisits with the page, size and digest of the
    response that they refer to; one whose response is not there keeps what its header tells and has no refers_to.

    Both sides of the join are tables, so a response with very many revisits can be split.
    """
    responses = records.where("type = 'response'").select(F.col("record_id").alias("of"), F.struct(F.col("page_id").alias("p"), F.col("payload_bytes").alias("b"), F.col("payload_digest").alias("d")).alias("r"))
    responses = responses.groupBy("of").agg(F.max("r").alias("r"))
    revisits = records.where("type = 'revisit'").join(responses, F.col("refers_to") == F.col("of"), "left")
    same = records.where("type = 'response'").select("page_id", "payload_bytes", "payload_digest", F.col("type").alias("record_type"), F.lit(None).cast("long").alias("refers_to"))
    return same.unionByName(
        revisits.select("page_id", F.coalesce("r.b", "payload_bytes").alias("payload_bytes"), F.coalesce("r.d", "payload_digest").alias("payload_digest"), F.col("type").alias("record_type"), F.col("r.p").alias("refers_to"))
    )


def new_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/warc-{uuid.uuid4().hex}"
