"""Benchmark decontamination: which documents hold a test item.

An item is in a document where at least ``threshold`` of the item's distinct word
shingles are among the document's. The search is one of containment, not of
resemblance, so both sides are signed by MinHash at the rate that an item's size
asks for. Items are partitioned by size (number of shingles, in powers of two).
An item's signature is its n - ceil(t n) + 1 shingles of the smallest hashes: a
document that holds the share t of the item lacks n - ceil(t n) shingles at most,
so it holds one of the signature's. A partition's bound is the largest hash in
its items' signatures, and a document's signature for that partition is all of
its shingle hashes up to the bound: the larger the items, the smaller the part of
a long document that is looked up. Documents whose signature meets an item's are
candidates, no other can qualify, however long the document; they are verified by
exact containment of all the item's shingles.

Tasks build the partitions' tables in blocks of about ``BLOCK_WORDS`` words of
items and write them to the shared folder; what one holds is bounded by a block.
Texts are read once: a task takes some megabytes of text through one block after
the other. The driver sees the blocks' names only.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.binary_ids import filesystem, read_file, write_atomically
from sieveline.llm.common import scratch_path, small_batches, stored, without
from sieveline.llm.tokens import text_blocks
from sieveline.llm.wordhash import Words

WIDTH = 5
THRESHOLD = 0.8
#: Words of the items in a block, about.
BLOCK_WORDS = 400_000
#: Bytes of text that go through the blocks at once: with one block, and with several.
TEXT, MORE_TEXT = 2 << 20, 16 << 20

MATCHES = "doc_id long, item_id long, n_shared long, n_item long, containment double"


def needed(n: int, threshold: float) -> int:
    """The least number of n shingles that makes the share."""
    return max(1, math.ceil(threshold * n - 1e-9))


class Items:
    """A block of items: their shingles, and by (width, size class) the table of the
    partition: hashes (ascending), the items they sign, and the bound."""

    def __init__(self, items: list[tuple[int, str]], width: int, threshold: float):
        words = Words([text for _, text in items])
        widths = np.minimum(np.diff(words.first), width)
        hashed = {int(k): words.shingles(int(k)) for k in np.unique(widths) if k}
        self.ids: list[int] = []
        self.shingles: list[frozenset[bytes]] = []
        self.need: list[int] = []
        signed: dict[tuple[int, int], list[tuple[np.ndarray, np.ndarray]]] = {}
        for i, (item_id, _) in enumerate(items):
            if not (k := int(widths[i])):
                continue
            value, text = hashed[k]
            hashes = np.unique(value[slice(*np.searchsorted(text, [i, i + 1]))])
            self.shingles.append(_shingles(words.of(i), k))
            self.need.append(needed(len(self.shingles[-1]), threshold))
            signature = hashes[: len(hashes) - needed(len(hashes), threshold) + 1]
            signed.setdefault((k, len(hashes).bit_length()), []).append((signature, np.full(len(signature), len(self.ids))))
            self.ids.append(item_id)
        self.tables = {}
        for partition, parts in signed.items():
            value, owner = (np.concatenate(x) for x in zip(*parts, strict=True))
            order = np.argsort(value, kind="stable")
            self.tables[partition] = value[order], owner[order], value.max()

    def find(self, words: Words, hashed: dict[int, tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[int, int, int]]:
        """(text, item, shared shingles) of each item that a text holds. hashed: the texts'
        shingles by width, which other blocks use too."""
        pairs: dict[int, set[tuple[int, int]]] = {}
        for (k, _), (keys, owners, bound) in self.tables.items():
            if k not in hashed:
                hashed[k] = words.shingles(k)
            value, text = hashed[k]
            signature = value <= bound
            value, text = value[signature], text[signature]
            a, b = np.searchsorted(keys, value), np.searchsorted(keys, value, "right")
            met = np.flatnonzero(b > a)
            pairs.setdefault(k, set()).update((t, owner) for t, x, y in zip(text[met].tolist(), a[met].tolist(), b[met].tolist(), strict=True) for owner in owners[x:y].tolist())
        for k, candidates in pairs.items():
            at, mine = -1, frozenset()
            for t, item in sorted(candidates):
                if t != at:
                    at, mine = t, _shingles(words.of(t), k)
                shared = len(self.shingles[item] & mine)
                if shared >= self.need[item]:
                    yield t, item, shared


def _shingles(words: list[bytes], width: int) -> frozenset[bytes]:
    return frozenset(b" ".join(words[i : i + width]) for i in range(len(words) - width + 1))


@lru_cache(1)
def _block(uri: str) -> Items:
    return pickle.loads(read_file(uri))


def write_blocks(items: DataFrame, width: int, threshold: float) -> list[str]:
    """Build the tables of items (columns id, text) and write them; the files."""
    spark = items.sparkSession
    held = stored(items.where("id IS NOT NULL AND text IS NOT NULL").distinct(), "items")
    n_words = held.agg(F.sum(F.size(F.split("text", r"\s+")))).first()[0]
    if n_words is None:
        return []
    folder = scratch_path(spark, "blocks")
    store, at = filesystem(folder)
    store.create_dir(at, recursive=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        block: list[tuple[int, str]] = []
        words, number = 0, 0
        for batch in batches:
            for item_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                block.append((item_id, text))
                words += len(text.split())
                if words >= 2 * BLOCK_WORDS:
                    yield _written(block, f"{folder}/{TaskContext.get().partitionId():06d}-{number:04d}", width, threshold)
                    block, words, number = [], 0, number + 1
        if block:
            yield _written(block, f"{folder}/{TaskContext.get().partitionId():06d}-{number:04d}", width, threshold)

    with small_batches(spark):
        return sorted(r["uri"] for r in held.repartition(max(1, -(-n_words // BLOCK_WORDS)), "id", "text").mapInArrow(run, "uri string").collect())


def _written(block: list[tuple[int, str]], uri: str, width: int, threshold: float) -> pa.RecordBatch:
    write_atomically(uri, pickle.dumps(Items(block, width, threshold), pickle.HIGHEST_PROTOCOL))
    return pa.RecordBatch.from_arrays([pa.array([uri])], ["uri"])


def contaminated(docs: DataFrame, items: DataFrame, *, width: int = WIDTH, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, item_id, n_shared, n_item and containment of every document and item
    whose containment is at least ``threshold``.

    Words are lower-cased (A-Z) runs outside ASCII white space. An item with fewer
    words than ``width`` has one shingle, all of it. Null or wordless items match
    nothing and neither do null or wordless texts. Rows with a null doc_id are
    left out; rows that repeat an item or a document give the pair once, with the
    largest containment. An empty table gives no rows. Other columns take no part.
    """
    blocks = write_blocks(items.select(F.col(f"`{item_id_col}`").cast("long").alias("id"), F.col(f"`{item_text_col}`").cast("string").alias("text")), width, threshold)
    if not blocks:
        return docs.sparkSession.createDataFrame([], MATCHES)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, text in text_blocks(batches, "text", TEXT if len(blocks) == 1 else MORE_TEXT):
            doc_ids = batch.column("doc_id").to_pylist()
            words, hashed, rows = Words(text), {}, []
            for uri in blocks:
                known = _block(uri)
                rows += [(doc_ids[t], known.ids[i], n, len(known.shingles[i]), n / len(known.shingles[i])) for t, i, n in known.find(words, hashed)]
            columns = list(zip(*rows, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.float64())], [f.split()[0] for f in MATCHES.split(", ")])

    found = stored(texts.mapInArrow(run, MATCHES), "matches")
    best = F.max(F.struct("containment", "n_shared", "n_item")).alias("best")
    return found.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "best.n_shared", "best.n_item", "best.containment")


def drop_contaminated(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """``docs`` without those that hold a test item; null ids stay, and so do all columns."""
    found = contaminated(docs, items, **options)
    return without(docs, options.get("id_col", "doc_id"), stored(found.select("doc_id").distinct(), "leaks"))
