"""WARC archives with a two-level capture index.

Records are written where the pages lie, in the tasks' order: payloads are not
shuffled to be sorted. Each record is a gzip member of its own, so that a range
read gives it whole. Of pages with equal payloads the one with the largest id is
a response, and the others are revisits of it.

The index is sorted instead: lines of reversed-host URL keys, in compressed
blocks of ``BLOCK_LINES``. Each index part has a sparse directory, one entry per
block; a list of the parts' first keys stands above them. A lookup bisects the
parts, then the part's directory, then the block, and reads one range.

Tasks write to temporary names and rename, so a task that runs again or twice
leaves whole files; the captures' table names the files that count.
"""

from __future__ import annotations

import bisect
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.binary_ids import filesystem, read_file, write_atomically
from sieveline.llm.common import scratch_path, stored
from sieveline.llm.tokens import text_blocks
from sieveline.operators.joins import redealt

#: Payloads of fewer bytes are never revisits.
LEAST_BYTES = 1000
BLOCK_LINES = 512
#: Captures of an index part, about.
PART_LINES = 200_000
GZIP_LEVEL = 2
DATE = "2000-01-01T00:00:00Z"

CAPTURE = "key binary, page_id long, line string"
RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: str | None) -> bytes:
    """The host's labels reversed, then the rest: com,example,www)/a?b. Without a
    scheme the whole text stands for the rest."""
    if not url:
        return b")"
    head, sep, rest = url.partition("://")
    if not sep:
        return b")" + quote(url, safe="/?&=#:;,+~%!*'()@").encode()
    cut = min((i for i in (rest.find(c) for c in "/?#") if i >= 0), default=len(rest))
    host = ",".join(reversed(rest[:cut].lower().split(".")))
    return quote(host + ")" + (rest[cut:] or "/"), safe="/?&=#:;,+~%!*'()@").encode()


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None) -> bytes:
    """One WARC record. A revisit holds the headers alone, and says what it leaves out."""
    kind = "response" if refers_to is None else "revisit"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    body = http + (payload if refers_to is None else b"")
    head = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {url} {digest}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe=_URI)}",
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Page-Id: {'' if page_id is None else page_id}",
        "Content-Type: application/http; msgtype=response",
    ]
    if refers_to is not None:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page-Id: {refers_to}", f"X-Payload-Length: {len(payload)}"]
    return ("\r\n".join([*head, f"Content-Length: {len(body)}"]) + "\r\n\r\n").encode() + body + b"\r\n\r\n"


_URI = "/?&=#:;,+~%!*'()@[]$"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """A record's headers and its payload; an error if it is cut short."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
    size = int(headers["Content-Length"])
    if not version.startswith("WARC/1.") or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return headers, rest[:size].partition(b"\r\n\r\n")[2]


def gzip_member(data: bytes) -> bytes:
    squeeze = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
    return squeeze.compress(data) + squeeze.flush()


def write_archives(pages: DataFrame, folder: str, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least_bytes: int = LEAST_BYTES) -> DataFrame:
    """Write a record per row; key, page_id and line (file, offset, length) of each capture."""
    rows = pages.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url"), F.encode(F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")), "UTF-8").alias("payload"))
    rows = rows.withColumn("digest", F.sha1("payload"))
    seen = stored(rows.where(F.octet_length("payload") >= least_bytes).select("page_id", "digest"), "digests")
    newest = seen.groupBy("digest").agg(F.max("page_id").alias("newest"), F.count("*").alias("n")).where("n > 1 AND newest IS NOT NULL").drop("n")
    older = seen.join(redealt(newest), "digest").where(~F.col("page_id").eqNullSafe(F.col("newest"))).distinct().withColumnsRenamed({"digest": "__digest", "page_id": "__page"})
    joined = rows.join(older, (F.col("digest") == F.col("__digest")) & F.col("page_id").eqNullSafe(F.col("__page")), "left").select("page_id", "url", "payload", "digest", "newest")
    store, at = filesystem(folder)
    store.create_dir(at, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get()
        name = f"part-{task.stageId():05d}-{task.partitionId():06d}-{task.taskAttemptId()}.warc.gz"  # each attempt its own: offsets belong to one file
        store, path = filesystem(f"{folder}/{name}")
        out, offset = None, 0
        for batch, payloads in text_blocks(batches, "payload"):
            out = out or store.open_output_stream(path, compression=None)
            keys, lines = [], []
            for page_id, url, payload, digest, newest in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url")), payloads, *(batch.column(c).to_pylist() for c in ("digest", "newest")), strict=True):
                member = gzip_member(record(page_id, url, payload, digest, newest))
                out.write(member)
                keys.append(url_key(url))
                lines.append(json.dumps([name, offset, len(member)]))
                offset += len(member)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), batch.column("page_id"), pa.array(lines, pa.string())], ["key", "page_id", "line"])
        if out:
            out.close()

    return stored(joined.mapInArrow(run, CAPTURE), "captures")


def entry(key: bytes, page_id: int | None) -> bytes:
    """What index lines are sorted by; a null id comes first."""
    return key + b" " + (b"" if page_id is None else b"%020d" % (page_id + 2**63))


def write_index(captures: DataFrame, folder: str, *, block_lines: int = BLOCK_LINES, part_lines: int = PART_LINES) -> list[tuple[bytes, str]]:
    """Write the index parts and their directories; (first entry, name) of each part, in order."""
    parts = max(1, -(-captures.count() // part_lines))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        name = f"index-{TaskContext.get().partitionId():06d}"
        blocks, directory, waiting = [], [], []
        offset = 0

        def flush() -> None:
            nonlocal offset
            squeezed = zlib.compress(b"\n".join(waiting), 6)
            blocks.append(squeezed)
            directory.append([waiting[0].split(b"\t")[0].decode(), offset, len(squeezed)])
            offset += len(squeezed)
            waiting.clear()

        for batch in batches:
            for key, page_id, line in zip(*(batch.column(c).to_pylist() for c in ("key", "page_id", "line")), strict=True):
                waiting.append(entry(key, page_id) + b"\t" + line.encode())
                if len(waiting) == block_lines:
                    flush()
        if waiting:
            flush()
        if blocks:
            write_atomically(f"{folder}/{name}.cdx", b"".join(blocks))
            write_atomically(f"{folder}/{name}.dir", json.dumps(directory).encode())
            yield pa.RecordBatch.from_arrays([pa.array([directory[0][0].encode()]), pa.array([name])], ["first", "name"])

    ordered = captures.repartitionByRange(parts, "key", F.col("page_id").asc_nulls_first()).sortWithinPartitions("key", F.col("page_id").asc_nulls_first(), "line")
    return sorted((bytes(r["first"]), r["name"]) for r in ordered.mapInArrow(run, "first binary, name string").collect())


class CaptureIndex:
    """Looks captures up; keeps a few directories and blocks."""

    def __init__(self, folder: str, parts: list[tuple[bytes, str]]):
        self.folder, self.firsts, self.names = folder, [f for f, _ in parts], [n for _, n in parts]
        self.directory = lru_cache(8)(self._directory)
        self.block = lru_cache(8)(self._block)
        self.files = lru_cache(64)(self._file)

    def _directory(self, part: int) -> tuple[list[bytes], list[tuple[int, int]]]:
        rows = json.loads(read_file(f"{self.folder}/{self.names[part]}.dir"))
        return [first.encode() for first, _, _ in rows], [(offset, length) for _, offset, length in rows]

    def _file(self, name: str):
        store, path = filesystem(f"{self.folder}/{name}")
        return store.open_input_file(path)

    def _block(self, part: int, number: int) -> tuple[list[bytes], list[bytes]]:
        offset, length = self.directory(part)[1][number]
        lines = [line.split(b"\t", 1) for line in zlib.decompress(self.files(f"{self.names[part]}.cdx").read_at(length, offset)).split(b"\n")]
        return [e for e, _ in lines], [rest for _, rest in lines]

    def find(self, key: bytes, page_id: int | None) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of each capture of the key by the page."""
        wanted = entry(key, page_id)
        # equal entries may begin in the block, or the part, before the first that isn't less
        part = max(0, bisect.bisect_left(self.firsts, wanted) - 1)
        while part < len(self.firsts) and self.firsts[part] <= wanted:
            firsts, ranges = self.directory(part)
            number = max(0, bisect.bisect_left(firsts, wanted) - 1)
            while number < len(ranges) and firsts[number] <= wanted:
                entries, lines = self.block(part, number)
                for i in range(bisect.bisect_left(entries, wanted), bisect.bisect_right(entries, wanted)):
                    yield tuple(json.loads(lines[i]))
                number += 1
            part += 1

    def read(self, name: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
        return parse(zlib.decompress(self.files(name).read_at(length, offset), 31))


def read_captures(wanted: DataFrame, folder: str, parts: list[tuple[bytes, str]], *, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of each capture
    of the distinct (url, page) rows, found by the index and read from the archives.
    A response's payload is digested anew and must agree with its header."""

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([url_key(u) for u in batch.column("url").to_pylist()], pa.binary()), batch.column("page_id")], ["key", "page_id"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = CaptureIndex(folder, parts)
        for batch in batches:
            rows = []
            for key, page_id in zip(batch.column("key").to_pylist(), batch.column("page_id").to_pylist(), strict=True):
                for where in index.find(key, page_id):
                    headers, payload = index.read(*where)
                    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if headers["WARC-Type"] == "response" and hashlib.sha1(payload).hexdigest() != digest:
                        raise ValueError(f"damaged record in {where[0]} at {where[1]}")
                    size = len(payload) if headers["WARC-Type"] == "response" else int(headers["X-Payload-Length"])
                    refers = headers.get("X-Refers-To-Page-Id")
                    rows.append((int(headers["X-Page-Id"]) if headers["X-Page-Id"] else None, size, digest, headers["WARC-Type"], None if refers is None else int(refers)))
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], [f.split()[0] for f in RECORD.split(", ")])

    if not parts:
        return wanted.sparkSession.createDataFrame([], RECORD)
    asked = wanted.select(F.col(f"`{id_col}`").cast("long").alias("page_id"), F.col(f"`{url_col}`").cast("string").alias("url")).mapInArrow(keys, "key binary, page_id long")
    n = max(len(parts), int(wanted.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    near = asked.distinct().repartitionByRange(n, "key", "page_id").sortWithinPartitions("key", "page_id")
    return near.mapInArrow(run, RECORD)


def round_trip(pages: DataFrame, **options) -> DataFrame:
    """Write ``pages`` to the shared folder, index them, and read every capture back.

    Null html is an empty payload. Null urls have a key of their own. A page whose
    id is null is a revisit if another page has its payload, and never the response
    that others revisit. Repeated rows are written and read each. An empty table
    gives no rows.
    """
    folder = scratch_path(pages.sparkSession, "warc")
    captures = write_archives(pages, folder, **options)
    parts = write_index(captures, folder)
    names = {k: v for k, v in options.items() if k in ("id_col", "url_col")}
    return read_captures(pages, folder, parts, **names)
