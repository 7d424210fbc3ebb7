"""Token ids in a compact binary file format.

Ids are replaced by their rank in the corpus' id frequencies (the commonest id is
rank 0, ties to the smaller id), so that most take one byte. Ranks are coded with
one to four data bytes each; the lengths stand apart as two-bit codes, four to a
control byte, and a table lookup decodes whole shards with numpy.

A shard (``shard-000000007-000000.ids``), little-endian::

    8 bytes   magic  b"SVLIDS02"
    6 x u64   documents, those without an id (they stand first), ids, control bytes, data bytes, vocabulary entries
    u32 each  the ranks' ids (rank -> id), so that a shard reads on its own
    i64 each  doc_id; 0 where there is none
    u64 each  ids of the document
    control bytes, then data bytes

Shards hold ascending ranges of doc_id; their order is the corpus order. A task
writes to a temporary name and renames it, so a task that runs again, or twice,
leaves one whole shard.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import scratch_path, small_batches, stored
from sieveline.llm.tokens import default_path, text_blocks, tokenizer

MAGIC = b"SVLIDS02"
#: Ids of a shard, about; what a task holds at once follows it.
SHARD_IDS = 4_000_000

#: For each control byte: the lengths of its four codes, and how many bytes they take.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)


def encode_ranks(ranks: np.ndarray) -> tuple[bytes, bytes]:
    """Control and data bytes; a last group of under four is filled with zeros' codes
    in the control byte only."""
    ranks = np.ascontiguousarray(ranks, dtype="<u4")
    n = 1 + (ranks >= 1 << 8).astype(np.uint8) + (ranks >= 1 << 16) + (ranks >= 1 << 24)
    codes = np.zeros(-(-len(ranks) // 4) * 4, np.uint8)
    codes[: len(ranks)] = n - 1
    control = (codes.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8)
    used = np.arange(4, dtype=np.uint8)[None, :] < n[:, None]
    return control.tobytes(), ranks.view(np.uint8).reshape(-1, 4)[used].tobytes()


def decode_ranks(control: np.ndarray, data: np.ndarray, n: int) -> np.ndarray:
    lengths = LENGTHS[control].reshape(-1)[:n]
    ends = np.cumsum(lengths, dtype=np.int64)
    starts = ends - lengths
    out = data[starts].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(lengths > k)
        out[longer] |= data[starts[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def shard_bytes(doc_ids: np.ndarray, nulls: int, counts: np.ndarray, ids: np.ndarray, rank_of: np.ndarray, id_of: np.ndarray) -> bytes:
    control, data = encode_ranks(rank_of[ids])
    head = MAGIC + struct.pack("<6Q", len(doc_ids), nulls, len(ids), len(control), len(data), len(id_of))
    return b"".join([head, id_of.astype("<u4").tobytes(), doc_ids.astype("<i8").tobytes(), counts.astype("<u8").tobytes(), control, data])


def read_shard(blob: bytes) -> tuple[np.ndarray, int, np.ndarray, np.ndarray]:
    """doc_ids, how many of them (the first ones) are null, ids per document, all ids."""
    if blob[:8] != MAGIC:
        raise ValueError("not a token id shard")
    docs, nulls, n, controls, size, entries = struct.unpack_from("<6Q", blob, 8)
    at = 56
    id_of = np.frombuffer(blob, "<u4", entries, at)
    doc_ids = np.frombuffer(blob, "<i8", docs, at := at + 4 * entries)
    counts = np.frombuffer(blob, "<u8", docs, at := at + 8 * docs)
    control = np.frombuffer(blob, np.uint8, controls, at := at + 8 * docs)
    data = np.frombuffer(blob, np.uint8, size, at + controls)
    return doc_ids, nulls, counts, id_of[decode_ranks(control, data, n)]


def filesystem(uri: str):
    """The file system and path of a URI, for workers on any machine."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_atomically(uri: str, blob: bytes) -> None:
    store, path = filesystem(uri)
    part = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(part, compression=None) as f:
        f.write(blob)
    store.move(part, path)


def read_file(uri: str) -> bytes:
    store, path = filesystem(uri)
    with store.open_input_stream(path, compression=None) as f:
        return f.read()


def encoded(docs: DataFrame, path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (the bytes of unsigned 16- or 32-bit ids) and n of each row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        kind = "<u2" if max(tok.size, end_id + 1) <= 1 << 16 else "<u4"
        for batch, texts in text_blocks(batches, "__text", raw=True):
            ids = [np.append(x, np.uint32(end_id)).astype(kind) for x in tok.encode(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64())], ["doc_id", "ids", "n"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, "doc_id long, ids binary, n long")


def unpacked(blob: bytes, n: int) -> np.ndarray:
    return np.frombuffer(blob, "<u2" if len(blob) == 2 * n else "<u4").astype(np.uint32)


def unpacked_all(batch: pa.RecordBatch) -> np.ndarray:
    """The ids of all of a batch's documents in a row."""
    blobs = batch.column("ids").to_pylist()
    return unpacked(b"".join(blobs), int(pc.sum(batch.column("n")).as_py() or 0))


def id_counts(tokens: DataFrame) -> DataFrame:
    """id, n over all documents: counted per task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            found = np.bincount(unpacked_all(batch))
            if len(found) > len(total):
                total, found = found, total
            total[: len(found)] += found
        ids = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(total[ids], pa.int64())], ["id", "n"])

    return tokens.select("ids", "n").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def write_ids(docs: DataFrame, folder: str, *, tokenizer_path: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> list[tuple[str, int, int]]:
    """Encode every whole text and write shards in ascending id order; (file, documents,
    ids) of each shard in that order.

    Null text: the end id alone. Null ids come first. Rows that repeat an id are all
    written, in the order of a hash of their ids. An empty table gives no shard. What comes to
    the driver is the vocabulary's counts and one row per shard.
    """
    spark = docs.sparkSession
    path = tokenizer_path or default_path()
    tokens = stored(encoded(docs, path, end_id, id_col, text_col), "tokens")
    with small_batches(spark):
        counts = sorted(((r["n"], r["id"]) for r in id_counts(tokens).collect()), key=lambda x: (-x[0], x[1]))
    id_of = np.array([i for _, i in counts], np.uint32)
    rank_of = np.zeros(int(id_of.max(initial=0)) + 1, np.uint32)
    rank_of[id_of] = np.arange(len(id_of), dtype=np.uint32)
    shards = max(1, -(-sum(n for n, _ in counts) // shard_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        number = nulls = 0

        def flush() -> pa.RecordBatch:
            nonlocal parts, number, nulls
            doc_ids, n, ids = (np.concatenate(x) for x in zip(*parts, strict=True))
            name = f"shard-{shard:09d}-{number:06d}.ids"
            write_atomically(f"{folder}/{name}", shard_bytes(doc_ids, nulls, n, ids, rank_of, id_of))
            parts, number, nulls = [], number + 1, 0
            return pa.RecordBatch.from_arrays([pa.array([name]), *[pa.array([x], pa.int64()) for x in (shard, number - 1, len(doc_ids), len(ids))]], ["file", "shard", "number", "docs", "ids"])

        held = 0
        for batch in batches:
            n = batch.column("n").to_numpy()
            if not len(n):
                continue
            ids = unpacked_all(batch)
            parts.append((pc.fill_null(batch.column("doc_id"), 0).to_numpy(), n, ids))
            nulls += batch.column("doc_id").null_count
            held += len(ids)
            if held >= 2 * shard_ids:  # a range that holds more than its share
                yield flush()
                held = 0
        if parts:
            yield flush()

    store, at = filesystem(folder)
    store.create_dir(at, recursive=True)
    # the hash parts rows that repeat an id, or have none, over several shards
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("ids")]
    ordered = tokens.repartitionByRange(shards, *order).sortWithinPartitions(*order, "ids")
    with small_batches(spark):
        written = ordered.mapInArrow(run, "file string, shard long, number long, docs long, ids long").collect()
    return [(r["file"], r["docs"], r["ids"]) for r in sorted(written, key=lambda r: (r["shard"], r["number"]))]


def read_ids(spark: SparkSession, folder: str, shards: list[tuple[str, int, int]]) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, decoded from the shards."""
    starts = accumulate((n for _, _, n in shards), initial=0)
    rows = [(f"{folder}/{name}", start) for (name, _, _), start in zip(shards, starts, strict=False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, start in zip(batch.column("uri").to_pylist(), batch.column("start").to_pylist(), strict=True):
                doc_ids, nulls, counts, ids = read_shard(read_file(uri))
                counts = counts.astype(np.int64)
                ends = np.cumsum(counts)
                raw = memoryview(np.ascontiguousarray(ids, "<u4").view(np.uint8))
                crc = [zlib.crc32(raw[4 * (e - n) : 4 * e]) for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids, mask=np.arange(len(doc_ids)) < nulls), pa.array(start + ends - counts), pa.array(counts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    schema = "doc_id long, start long, n_tokens long, ids_crc32 long"
    if not rows:
        return spark.createDataFrame([], schema)
    files = spark.createDataFrame(rows, "uri string, start long").repartition(len(rows))
    return files.mapInArrow(run, schema)


def round_trip(docs: DataFrame, **options) -> DataFrame:
    """Write ``docs`` to the shared folder and read the files back."""
    folder = scratch_path(docs.sparkSession, "ids")
    return read_ids(docs.sparkSession, folder, write_ids(docs, folder, **options))
