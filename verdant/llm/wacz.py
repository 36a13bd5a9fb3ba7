"""WARC records in ZIP-packaged archives (the WACZ layout), written and read back.

An archive is a ZIP file with two stored members: ``archive/data.warc.gz``
(a gzip member per record) and ``indexes/index.cdx`` (a line per record: id,
offset and length in the WARC member).  Members are stored, not deflated, so a
record is a byte range of the ZIP file.

The reader never extracts: it reads the end of the file for the end record
(the ZIP64 one where there is one), the central directory, the member's local
header for its data's place, the index, and then one range per record.  Index
entries are rows, so record reads spread over the cluster by archive and range.

Paths go through the Arrow file systems, so an archive can lie on any store
that Arrow opens (a local or mounted path, S3, GCS, HDFS).  A writer task writes
under a name of its own attempt and the manifest, stored once the write job has
ended, names the attempts that count; a lost task's file is never read.

Defined results: a null payload is empty; a null url is the empty URI; equal
payloads of ``threshold`` bytes or more: the rows with the smallest id are
responses, all others revisits of it; rows with a null id come after every id
(if no row of a group has an id, all are responses); repeated rows get a record
each.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import struct
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from verdant.llm.common import small_batches, stored
from verdant.session import fresh_dir

WARC_MEMBER, INDEX_MEMBER = "archive/data.warc.gz", "indexes/index.cdx"
DATE = "1970-01-01T00:00:00Z"  # the pages have no date of their own
BIG = 0xFFFFFFFF
READ_AT_ONCE = 4 << 20
READ_TOGETHER = 8 << 20    # neighbouring ranges of this many bytes are read by one task
READ_A_TASK = 128 << 20    # bytes of archives for one reading task


def opened(path: str) -> tuple[pafs.FileSystem, str]:
    if "://" in path or path.startswith("file:"):
        return pafs.FileSystem.from_uri(path if "://" in path else "file://" + path[5:])
    return pafs.LocalFileSystem(), path


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


# -- records ---------------------------------------------------------------

def record(page_id: int | None, url: str, payload: bytes, digest: str, size: int, refers_to: int | None) -> bytes:
    """One WARC/1.1 record; a revisit holds the HTTP head alone."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    revisit = refers_to is not None
    block = http if revisit else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
            f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>", f"WARC-Date: {DATE}",
            "WARC-Target-URI: " + "".join(c for c in url if c not in "\r\n"),
            f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
                 f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(raw: bytes) -> dict:
    """The fields of one record (as ``record`` and other writers make them)."""
    top, _, rest = raw.partition(b"\r\n\r\n")
    lines = top.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    head = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    block = rest[:int(head["content-length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in
              (x.partition(":") for x in http.decode("latin-1").split("\r\n")[1:])}

    def page(uri: str | None) -> int | None:
        number = (uri or "").strip("<>").rpartition(":")[2]
        return int(number) if number else None

    return {"page_id": page(head.get("warc-record-id")), "url": head.get("warc-target-uri", ""),
            "record_type": head["warc-type"], "payload": payload,
            "payload_bytes": int(fields.get("content-length", len(payload))),
            "payload_digest": head.get("warc-payload-digest", "").removeprefix("sha1:"),
            "refers_to": page(head.get("warc-refers-to"))}


def gzipped(data: bytes) -> bytes:
    z = zlib.compressobj(3, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


# -- the ZIP container -----------------------------------------------------

class StoredZip:
    """Writes stored members one after the other; sizes are known only at a
    member's end, so they follow it (data descriptor) and stand in the directory."""

    def __init__(self, out, zip64: bool = False):
        self.out, self.at, self.zip64, self.members = out, 0, zip64, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def begin(self, name: str) -> None:
        self.name, self.head, self.crc = name.encode(), self.at, 0
        # flag 8: sizes follow; the ZIP64 extra makes them 8 bytes wide there
        self._put(struct.pack("<4s5H3L2H", b"PK\3\4", 45, 8, 0, 0, 33, 0, BIG, BIG, len(self.name), 20)
                  + self.name + struct.pack("<2H2Q", 1, 16, 0, 0))
        self.start = self.at

    def add(self, data: bytes) -> int:
        """Offset of the data within the member."""
        at = self.at - self.start
        self.crc = zlib.crc32(data, self.crc)
        self._put(data)
        return at

    def end(self) -> None:
        size = self.at - self.start
        self._put(struct.pack("<4sL2Q", b"PK\7\x08", self.crc, size, size))
        self.members.append((self.name, self.head, size, self.crc))

    def close(self) -> None:
        start = self.at
        for name, head, size, crc in self.members:
            wide = self.zip64 or size >= BIG or head >= BIG
            extra = struct.pack("<2H3Q", 1, 24, size, size, head) if wide else b""
            shown = (BIG, BIG) if wide else (size, size)
            self._put(struct.pack("<4s6H3L5H2L", b"PK\1\2", 45, 45, 8, 0, 0, 33, crc, *shown, len(name), len(extra), 0, 0, 0,
                                  0, BIG if wide else head) + name + extra)
        length, n = self.at - start, len(self.members)
        wide = self.zip64 or start >= BIG
        if wide:
            end64 = self.at
            self._put(struct.pack("<4sQ2H2L4Q", b"PK\6\6", 44, 45, 45, 0, 0, n, n, length, start))
            self._put(struct.pack("<4sLQL", b"PK\6\7", 0, end64, 1))
        self._put(struct.pack("<4s4H2LH", b"PK\5\6", 0, 0, *((0xFFFF,) * 2 if wide else (n, n)),
                              BIG if wide else length, BIG if wide else start, 0))


def directory(f, size: int) -> dict[str, tuple[int, int]]:
    """(offset of the local header, size) of every stored member, from the end
    record, the ZIP64 end record where one is pointed to, and the central directory."""
    tail_at = max(0, size - 65_557)
    tail = f.read_at(size - tail_at, tail_at)
    at = tail.rfind(b"PK\5\6")
    if at < 0:
        raise ValueError("no end record: not a ZIP file, or cut off")
    n, length, start = struct.unpack("<10xH2L", tail[at:at + 20])
    if n == 0xFFFF or BIG in (length, start):
        locator = f.read_at(20, tail_at + at - 20)
        if locator[:4] != b"PK\6\7":
            raise ValueError("no ZIP64 locator")
        end64 = f.read_at(56, struct.unpack("<8xQ", locator[:16])[0])
        if end64[:4] != b"PK\6\6":
            raise ValueError("no ZIP64 end record")
        length, start = struct.unpack("<40x2Q", end64)
    listing, found, p = f.read_at(length, start), {}, 0
    while listing[p:p + 4] == b"PK\1\2":
        method, packed, full, n_name, n_extra, n_note, head = struct.unpack("<10xH8x2L3H8xL", listing[p:p + 46])
        name = listing[p + 46:p + 46 + n_name].decode()
        extra = listing[p + 46 + n_name:p + 46 + n_name + n_extra]
        q = 0
        while q + 4 <= len(extra):
            kind, n_field = struct.unpack("<2H", extra[q:q + 4])
            if kind == 1:  # the fields that are too wide, in this order
                wide = list(struct.unpack(f"<{n_field // 8}Q", extra[q + 4:q + 4 + n_field // 8 * 8]))
                full = wide.pop(0) if full == BIG else full
                packed = wide.pop(0) if packed == BIG else packed
                head = wide.pop(0) if head == BIG else head
            q += 4 + n_field
        if method == 0:
            found[name] = (head, packed)
        p += 46 + n_name + n_extra + n_note
    return found


def data_offset(f, head: int) -> int:
    """Where a member's data begins: its local header has lengths of its own."""
    local = f.read_at(30, head)
    if local[:4] != b"PK\3\4":
        raise ValueError("no local header")
    n_name, n_extra = struct.unpack("<26x2H", local)
    return head + 30 + n_name + n_extra


# -- Spark -----------------------------------------------------------------

def planned(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
            threshold: int = 0) -> DataFrame:
    """(page_id, url, html, sha1, refers_to): what each row's record is to be.

    Groups of equal payloads are known by SHA-1 and length; only those of two rows
    or more go through the join, which splits a hot group (AQE)."""
    rows = pages.select(F.col(id_col).cast("long").alias("page_id"), F.coalesce(url_col, F.lit("")).alias("url"),
                        F.coalesce(html_col, F.lit("")).alias("html"))
    rows = rows.withColumn("sha1", F.sha1("html"))
    size = F.octet_length("html")
    shared = (rows.filter(size >= threshold).groupBy("sha1", size.alias("size"))
              .agg(F.count("*").alias("n"), F.min("page_id").alias("least")).filter("n > 1"))
    shared = shared.select(F.col("sha1").alias("same_sha1"), F.col("size").alias("same_size"), "least")
    joined = rows.join(shared, (rows["sha1"] == shared["same_sha1"]) & (F.octet_length(rows["html"]) == shared["same_size"]), "left")
    first = F.col("page_id").eqNullSafe(F.col("least")) | F.col("least").isNull()
    return joined.select("page_id", "url", "html", "sha1", F.when(~first, F.col("least")).alias("refers_to"))


def write(records: DataFrame, root: str, zip64: bool = False) -> DataFrame:
    """Write one archive per task under ``root``; the manifest (path, records, size), stored."""
    small_batches(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, out, index, n = "", None, [], 0
        for b in batches:
            for page_id, url, html, sha1, refers_to in zip(*(b[c].to_pylist() for c in
                                                             ("page_id", "url", "html", "sha1", "refers_to"))):
                if out is None:
                    path = posixpath.join(root, f"part-{uuid.uuid4().hex}.wacz")
                    fs, local = opened(path)
                    fs.create_dir(posixpath.dirname(local), recursive=True)
                    out = fs.open_output_stream(local)
                    z = StoredZip(out, zip64)
                    z.begin(WARC_MEMBER)
                payload = html.encode("utf-8", "replace")
                digest = base64.b32encode(bytes.fromhex(sha1)).decode()
                data = gzipped(record(page_id, url, payload, digest, len(payload), refers_to))
                index.append(f"{'' if page_id is None else page_id} {z.add(data)} {len(data)}\n")
                n += 1
        if out is not None:
            z.end()
            z.begin(INDEX_MEMBER)
            for a in range(0, len(index), 10_000):
                z.add("".join(index[a:a + 10_000]).encode())
            z.end()
            z.close()
            out.close()
            yield pa.RecordBatch.from_pydict({"path": [path], "records": [n], "size": [fs.get_file_info(local).size]})

    return stored(records.mapInArrow(run, "path string, records long, size long"), "wacz-manifest")


def entries(manifest: DataFrame) -> DataFrame:
    """(path, start, length) of every record of the archives, absolute in the ZIP file."""
    small_batches(manifest.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path in b["path"].to_pylist():
                fs, local = opened(path)
                with fs.open_input_file(local) as f:
                    members = directory(f, f.size())
                    (warc, _), (cdx, size) = members[WARC_MEMBER], members[INDEX_MEMBER]
                    base, at, rest = data_offset(f, warc), data_offset(f, cdx), b""
                    end = at + size
                    while at < end:  # the index in pieces
                        piece = f.read_at(min(READ_AT_ONCE, end - at), at)
                        at += len(piece)
                        lines = (rest + piece).split(b"\n")
                        rest = lines.pop()
                        got = [x.rsplit(b" ", 2)[1:] for x in lines]
                        yield pa.RecordBatch.from_pydict({"path": pa.array([path] * len(got), pa.string()),
                                                          "start": pa.array([base + int(x) for x, _ in got], pa.int64()),
                                                          "length": pa.array([int(x) for _, x in got], pa.int64())})

    return manifest.select("path").mapInArrow(run, "path string, start long, length long")


def read_tasks(manifest: DataFrame) -> int:
    """How many tasks are to read the archives: one for each ``READ_A_TASK`` of their bytes,
    the session's parallelism at least.  The index is tiny beside what its ranges read, so
    its own size says nothing."""
    size = manifest.agg(F.sum("size")).first()[0] or 0
    return max(manifest.sparkSession.sparkContext.defaultParallelism, -(-size // READ_A_TASK))


def read(places: DataFrame, tasks: int | None = None) -> DataFrame:
    """Range-read the records at ``entries`` in ``tasks`` tasks (default: the session's
    parallelism) and parse them; a response's payload is checked against its digest."""
    tasks = tasks or places.sparkSession.sparkContext.defaultParallelism
    small_batches(places.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()),
                           ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
                           ("payload", pa.binary())])
        now, f = None, None
        for b in batches:
            out = []
            for path, start, length in zip(*(b[c].to_pylist() for c in ("path", "start", "length"))):
                if path != now:
                    if f:
                        f.close()
                    fs, local = opened(path)
                    now, f = path, fs.open_input_file(local)
                got = parse_record(zlib.decompress(f.read_at(length, start), 31))
                if got["record_type"] == "response" and base32_sha1(got["payload"]) != got["payload_digest"]:
                    raise ValueError(f"payload of {got['page_id']} in {path} differs from its digest")
                out.append(got)
            yield pa.RecordBatch.from_pylist(out, kinds)
        if f:
            f.close()

    # neighbouring ranges of an archive stay together; an archive is many groups
    spread = places.repartition(tasks, "path", F.floor(F.col("start") / READ_TOGETHER)).sortWithinPartitions("path", "start")
    return spread.mapInArrow(run, "page_id long, url string, payload_bytes long, payload_digest string, "
                                  "record_type string, refers_to long, payload binary")


def round_trip(pages: DataFrame, threshold: int = 0) -> DataFrame:
    """Write the pages' records to archives in the shared scratch folder and read them back."""
    manifest = write(planned(pages, threshold=threshold), fresh_dir(pages.sparkSession, "wacz"))
    tasks = read_tasks(manifest)
    return read(entries(manifest.repartition(tasks, "path")), tasks)
