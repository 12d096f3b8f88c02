"""WARC archives with a two-level capture index.

Writing: every page becomes one record in a gzip member of its own. Of pages with equal payloads of at least
``REVISIT_BYTES`` the one with the largest id is the response, the others are revisits that hold headers only. Digests
are grouped, not payloads, and only the ids of revisits are joined to the pages.

Indexing: the keys, host labels reversed, then the path, then the page id, are sorted over range partitions. A partition
becomes one index file: blocks of ``BLOCK_LINES`` lines, each compressed, and at the end a sparse directory with the first
key, offset and length of every block.

Reading: keys to look up are dealt to the index file whose range holds them; a task searches the directory by bisection,
reads and opens single blocks, and fetches the records by byte range.

Defined results: NULL html is an empty payload; NULL urls share the key ``-``; rows equal in id and payload are all
responses or all revisits; a page without id can only be a revisit, or a response if no equal page has an id; further
columns are not stored.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobstrata.llm.files import RangeReader, fresh
from jobstrata.session import materialise, new_path

REVISIT_BYTES = 1000
BLOCK_LINES = 300
TASK_BYTES = 4 << 20  # of compressed records that one look-up task reads
FILE_BYTES = 1 << 30
_ID = "urn:x-page:"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_URL = re.compile(r"(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^#]*)", re.S)


def url_key(url: str | None) -> str:
    """Sortable key of a URL: host labels reversed, then port and path; scheme, user and fragment are left out."""
    if url is None:
        return "-"
    found = _URL.match(url.strip())
    if not found:
        return ")" + _visible(url)
    host, port, path = found.groups()
    labels = ",".join(reversed(_visible(host.lower()).rstrip(".").split(".")))
    return f"{labels}{':' + port if port else ''}){_visible(path or '/')}"


def _visible(text: str) -> str:
    """Blanks and control characters as percent codes."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def capture_key(url: str | None, page_id: int | None) -> str:
    number = "-" if page_id is None else f"{page_id + (1 << 63):020d}"
    return f"{url_key(url)} {number}"


# ---- records -----------------------------------------------------------------------------------------------------


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}",
             f"WARC-Record-ID: <{_ID}{'' if page_id is None else page_id}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append(f"WARC-Target-URI: {_visible(url)}")
    if revisit:
        lines += [f"WARC-Profile: {_PROFILE}", f"WARC-Refers-To: <{_ID}{refers_to}>"]
    lines += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http; msgtype=response",
              f"Content-Length: {len(block)}", "", ""]
    return "\r\n".join(lines).encode("utf-8", "replace") + block + b"\r\n\r\n"


def parse(data: bytes) -> dict:
    """What a record says and holds; raises if the payload does not have the digest it names."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = re.search(rb"Content-Length: (\d+)", http)
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind = fields["WARC-Type"]
    if kind == "response" and hashlib.sha1(payload).hexdigest() != digest:
        raise ValueError(f"payload of {fields['WARC-Record-ID']} is damaged")
    own, other = (fields.get(f, "").strip("<>").removeprefix(_ID) for f in ("WARC-Record-ID", "WARC-Refers-To"))
    return {"page_id": int(own) if own else None, "payload_bytes": int(number[1]), "payload_digest": digest,
            "record_type": kind, "refers_to": int(other) if other else None, "payload": payload}


# ---- writing -----------------------------------------------------------------------------------------------------


def with_revisits(pages: DataFrame) -> DataFrame:
    """``page_id, url, html, revisit, refers_to``."""
    body = F.coalesce("html", F.lit(""))
    marks = materialise(pages.select("page_id", F.sha1(body).alias("digest"), F.octet_length(body).alias("size"))
                        .where(F.col("size") >= REVISIT_BYTES).select("page_id", "digest"), "digests")
    groups = marks.groupBy("digest").agg(F.max("page_id").alias("refers_to"), F.count(F.lit(1)).alias("n"))
    groups = groups.where("n > 1 and refers_to is not null")
    again = (marks.join(groups, "digest").where(~F.col("page_id").eqNullSafe(F.col("refers_to")))
             .select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest"), "refers_to").distinct())
    return pages.select("page_id", "url", "html", F.sha1(body).alias("_own")).join(
        materialise(again, "revisits"), F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("_own") == F.col("_digest")),
        "left").select("page_id", "url", "html", F.col("_digest").isNotNull().alias("revisit"), "refers_to")


def write_archives(pages: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write the archives; the stored ``key, path, offset, length`` of every record."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, path, out, at = TaskContext.get().partitionId(), "", None, 0
        for batch in batches:
            rows: tuple[list, ...] = ([], [], [], [])
            for page in batch.to_pylist():
                if out is None or at > FILE_BYTES:
                    if out is not None:
                        out.close()
                    path, out = fresh(folder, part, "warc.gz")
                    at = 0
                payload = (page["html"] or "").encode("utf-8", "replace")
                squeeze = zlib.compressobj(4, zlib.DEFLATED, 31)
                data = squeeze.compress(record(page["page_id"], page["url"], payload, page["refers_to"],
                                               page["revisit"], date)) + squeeze.flush()
                out.write(data)
                for column, value in zip(rows, (capture_key(page["url"], page["page_id"]), path, at, len(data))):
                    column.append(value)
                at += len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[0], pa.string()), pa.array(rows[1], pa.string()), pa.array(rows[2], pa.int64()),
                 pa.array(rows[3], pa.int64())], ["key", "path", "offset", "length"])
        if out is not None:
            out.close()

    return materialise(with_revisits(pages).mapInArrow(run, "key string, path string, offset long, length long"), "records")


# ---- index -------------------------------------------------------------------------------------------------------


def write_index(records: DataFrame, folder: str, block_lines: int = BLOCK_LINES) -> DataFrame:
    """Write the index files; the stored ``path, first_key`` of each."""
    ranged = records.repartitionByRange("key").sortWithinPartitions("key", "path", "offset")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        path, out, at, lines, directory = "", None, 0, [], []

        def block() -> int:
            data = squeeze.compress("\n".join(lines).encode())
            out.write(data)
            directory.append(f"{lines[0].split(chr(9), 1)[0]}\t{at}\t{len(data)}")
            lines.clear()
            return at + len(data)

        for batch in batches:
            for row in zip(*[batch[c].to_pylist() for c in ("key", "path", "offset", "length")]):
                if out is None:
                    path, out = fresh(folder, TaskContext.get().partitionId(), "idx")
                lines.append("\t".join(map(str, row)))
                if len(lines) == block_lines:
                    at = block()
        if out is not None:
            if lines:
                at = block()
            data = squeeze.compress("\n".join(directory).encode())
            out.write(data + at.to_bytes(8, "little") + len(data).to_bytes(8, "little"))
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([directory[0].split("\t")[0]])],
                                             ["path", "first_key"])

    return materialise(ranged.mapInArrow(run, "path string, first_key string"), "index")


class IndexFile:
    """One index file: its directory is read at once, its blocks when a key needs them."""

    def __init__(self, reader: RangeReader, path: str):
        self.reader, self.path, self.open = reader, path, zstandard.ZstdDecompressor()
        size = reader.size(path)
        tail = reader.read(path, size - 16, 16)
        at, length = (int.from_bytes(tail[k:k + 8], "little") for k in (0, 8))
        rows = [r.split("\t") for r in self.open.decompress(reader.read(path, at, length)).decode().split("\n")]
        self.first = [r[0] for r in rows]
        self.places = [(int(r[1]), int(r[2])) for r in rows]
        self.held: tuple[int, list[list[str]]] = (-1, [])

    def _block(self, k: int) -> list[list[str]]:
        if self.held[0] != k:
            data = self.open.decompress(self.reader.read(self.path, *self.places[k])).decode()
            self.held = (k, [line.split("\t") for line in data.split("\n")])
        return self.held[1]

    def find(self, key: str) -> Iterator[tuple[str, int, int]]:
        """Path, offset and length of the records of a key, by bisection of the directory and then of the block."""
        k = max(0, bisect_left(self.first, key) - 1)  # equal keys may begin in the block before
        while k < len(self.first) and self.first[k] <= key:
            rows = self._block(k)
            for row in rows[bisect_left(rows, key, key=lambda r: r[0]):]:
                if row[0] != key:
                    return
                yield row[1], int(row[2]), int(row[3])
            k += 1


def look_up(keys: DataFrame, index: DataFrame, with_payload: bool = False, records: DataFrame | None = None) -> DataFrame:
    """The records of the distinct ``key`` values, read by way of the index.

    A key is a few bytes, its record may be a large page. With ``records`` the number of tasks follows the bytes of all of
    them, ``TASK_BYTES`` each.
    """
    size = records.agg(F.sum("length")).first()[0] or 0 if records is not None else 0
    tasks = [max(1, -(-size // TASK_BYTES))] if records is not None else []
    files = sorted((r["first_key"], r["path"]) for r in index.collect())  # a row per index file
    if not files:
        files = [("", "")]
    starts, paths = [f[0] for f in files], [f[1] for f in files]

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [max(0, bisect_right(starts, k) - 1) for k in batch["key"].to_pylist()]
            yield pa.RecordBatch.from_arrays([batch["key"], pa.array(found, pa.int32())], ["key", "file"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader, now, index_file = RangeReader(), -1, None
        for batch in batches:
            rows = []
            for file, key in zip(batch["file"].to_pylist(), batch["key"].to_pylist()):
                if file != now and paths[file]:
                    now, index_file = file, IndexFile(reader, paths[file])
                for path, offset, length in index_file.find(key) if paths[file] else ():
                    rows.append(parse(zlib.decompress(reader.read(path, offset, length), 31)))
            columns = [pa.array([r[c] for r in rows], t) for c, t in
                       (("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
                        ("record_type", pa.string()), ("refers_to", pa.int64()))]
            if with_payload:
                columns.append(pa.array([r["payload"] for r in rows], pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, names)
        reader.close()

    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * with_payload
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    dealt = keys.select("key").distinct().mapInArrow(deal, "key string, file int")
    return dealt.repartitionByRange(*tasks, "file", "key").sortWithinPartitions("file", "key").mapInArrow(
        run, schema + (", payload binary" if with_payload else ""))


def archive(pages: DataFrame, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Write archives and index below the folder; the records and the index files."""
    folder = folder or new_path(pages.sparkSession, "warc")
    records = write_archives(pages, folder + "/archives")
    return records, write_index(records, folder + "/index")


def keys_of(pages: DataFrame) -> DataFrame:
    """The index keys of the rows of ``page_id, url``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = [capture_key(u, p) for u, p in zip(batch["url"].to_pylist(), batch["page_id"].to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string())], ["key"])

    return pages.select("page_id", "url").mapInArrow(run, "key string")
