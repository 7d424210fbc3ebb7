"""Packing: documents into fixed windows, each filled with lexical neighbours.

Every document is encoded once. A document's lexical key (its two largest ids:
in a merge-ordered vocabulary, its rarest pieces) orders the corpus; equal
ranges of that order are the shards, so that documents that share rare pieces
meet. The ranges are cut by the counted ids of each key: a key that a third of the
documents share is dealt over as many shards as its ids fill.
Each shard builds a BM25 inverted index over ids, with the whole corpus'
document frequencies and mean length. A seed document queries the index with all
of its terms; its unused neighbours fill its window in the order of their scores, whole where
they fit, and the best of those that don't fit is cut to fill the rest. What
remains of a cut document seeds the next window. The tail of a shard, less than
a window, is cut at powers of two, which need no padding; so no id is padding.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.binary_ids import unpacked
from sieveline.llm.common import small_batches, stored
from sieveline.llm.tokens import default_path, text_blocks, tokenizer

WINDOW = 2048
#: Ids of a shard, about.
SHARD_IDS = 2_000_000
#: Neighbours of a seed that are put in order first; of the others only those that still fit are.
FIRST = 64
#: Terms that one document in so many has are rows of a matrix; the others are posting lists.
WIDE = 8
K1, B = 1.2, 0.75

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def keyed_tokens(docs: DataFrame, path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, ids, n and the lexical key of each row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = tokenizer(path)
        kind = "<u2" if max(tok.size, end_id + 1) <= 1 << 16 else "<u4"
        for batch, texts in text_blocks(batches, "__text", raw=True):
            ids, keys = [], []
            for x in tok.encode(texts):
                top = np.unique(x)[-2:] if len(x) < 2 else _two_largest(x)
                keys.append(_scramble(int(top[-1])) << 32 | int(top[0]) if len(top) else 0)
                ids.append(np.append(x, np.uint32(end_id)).astype(kind))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([x.tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int64()), pa.array(keys, pa.int64())], ["doc_id", "ids", "n", "key"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, "doc_id long, ids binary, n long, key long")


def _scramble(x: int) -> int:
    """31 bits in another order: long documents, whose largest ids are larger, must not lie together."""
    return (x * 0x9E3779B1 & 0xFFFFFFFF) >> 1


def _pairs(docs: list[np.ndarray]) -> tuple[np.ndarray, int]:
    """id << bits | document of every id, sorted, in 32 bits where they fit; and bits."""
    bits = max(1, (len(docs) - 1).bit_length())
    ids = np.concatenate(docs)
    kind = np.uint32 if int(ids.max(initial=0)) < 1 << (32 - bits) else np.uint64
    pairs = ids.astype(kind) << kind(bits) | np.repeat(np.arange(len(docs), dtype=kind), [len(d) for d in docs])
    pairs.sort()
    return pairs, bits


def _two_largest(x: np.ndarray) -> tuple[int, int]:
    most = x.max()
    rest = x[x < most]
    return (rest.max() if len(rest) else most), most


def document_frequencies(tokens: DataFrame) -> DataFrame:
    """id, n: in how many documents; id -1: documents, id -2: ids. Counted per task, then summed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, docs, ids = np.zeros(0, np.int64), 0, 0
        for batch in batches:
            blobs, n = batch.column("ids").to_pylist(), batch.column("n").to_pylist()
            docs, ids = docs + len(n), ids + sum(n)
            for a in range(0, len(n), 256):
                part = [unpacked(b, k) for b, k in zip(blobs[a : a + 256], n[a : a + 256], strict=True)]
                pairs, bits = _pairs(part)
                first = np.append(True, pairs[1:] != pairs[:-1])
                found = np.bincount((pairs[first] >> pairs.dtype.type(bits)).astype(np.int64))
                if len(found) > len(total):
                    total, found = found, total
                total[: len(found)] += found
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(seen, [-1, -2]), pa.int64()), pa.array(np.append(total[seen], [docs, ids]), pa.int64())], ["id", "n"])

    return tokens.select("ids", "n").mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def sharded(tokens: DataFrame, shards: int, shard_ids: int) -> DataFrame:
    """``tokens`` (key, doc_id, n, ids), a partition for each shard of about ``shard_ids`` ids.

    All ids lie on one line in the order of keys. A key that fills an eighth of a shard
    or more has an interval of its own, over which its rows are spread by their hash; the
    others lie in the interval of their largest id, by the hash of the second. The driver
    gets a row per largest id, which the vocabulary bounds, and at most eight a shard."""
    by_key = stored(tokens.groupBy("key").agg(F.sum("n").alias("n")), "keys")
    own = F.col("n") * 8 >= shard_ids
    top = F.shiftright("key", 32)
    heavy = [(r["key"] >> 32, r["key"], r["n"]) for r in by_key.where(own).collect()]
    light = [(r["top"], -1, r["n"]) for r in by_key.where(~own).groupBy(top.alias("top")).agg(F.sum("n").alias("n")).collect()]
    line, at = [], 0
    for above, key, n in sorted(light + heavy):
        line.append((above, key, at, n))
        at += n
    schema = "top long, own long, at long, width long"
    tops = tokens.sparkSession.createDataFrame([x for x in line if x[1] < 0], schema).select("top", "at", "width")
    owns = tokens.sparkSession.createDataFrame([x for x in line if x[1] >= 0], schema).select("own", F.col("at").alias("own_at"), F.col("width").alias("own_width"))
    share = lambda *c: F.shiftrightunsigned(F.xxhash64(*c), 11) / F.lit(float(1 << 53))
    placed = tokens.withColumn("top", top).join(F.broadcast(tops), "top", "left").join(owns, F.col("key") == F.col("own"), "left")
    where = F.when(F.col("own").isNotNull(), F.col("own_at") + F.col("own_width") * share("doc_id", "ids")).otherwise(F.col("at") + F.col("width") * share("key"))
    shard = F.least(F.floor(where / shard_ids), F.lit(shards - 1)).cast("int")
    return placed.withColumn("shard", shard).repartitionById(shards, F.col("shard")).select("key", "doc_id", "n", "ids")


class Index:
    """BM25 over one shard: the documents' weights by term, and each document's terms."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean: float):
        lengths = np.array([len(d) for d in docs], np.int64)
        pairs, bits = _pairs(docs)
        first = np.flatnonzero(np.append(True, pairs[1:] != pairs[:-1]))
        tf = np.diff(np.append(first, len(pairs)))
        held = pairs[first].astype(np.int64)
        term, self.doc = held >> bits, held & ((1 << bits) - 1)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * lengths[self.doc] / mean))
        edges = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        self.first, self.last = edges, np.append(edges[1:], len(term))
        slot = np.repeat(np.arange(len(edges)), self.last - self.first)
        # each document's terms that another document has too
        useful = np.flatnonzero((self.last - self.first)[slot] > 1)
        order = useful[np.argsort(self.doc[useful].astype(np.uint16 if len(docs) <= 1 << 16 else np.int64), kind="stable")]
        self.terms = slot[order]
        self.of = np.searchsorted(self.doc[order], np.arange(len(docs) + 1))
        self.size = len(docs)
        # the lists of common terms, a row each: at most WIDE times their postings
        common = (self.last - self.first) * WIDE >= self.size
        self.row = np.where(common, np.cumsum(common) - 1, -1)
        self.wide = np.zeros((int(common.sum()), self.size), np.float32)
        held = common[slot]
        self.wide[self.row[slot[held]], self.doc[held]] = self.weight[held]

    def scores(self, seed: int, free: np.ndarray) -> np.ndarray:
        """Of each document the sum over all of the seed's terms; 0 if it is used."""
        terms = self.terms[self.of[seed] : self.of[seed + 1]]
        if not len(terms):
            return np.zeros(self.size)
        rows = self.row[terms]
        lists = [slice(a, b) for a, b in zip(self.first[terms[rows < 0]].tolist(), self.last[terms[rows < 0]].tolist(), strict=True)]
        scores = np.zeros(self.size)
        if lists:
            scores += np.bincount(np.concatenate([self.doc[x] for x in lists]), np.concatenate([self.weight[x] for x in lists]), minlength=self.size)
        if (rows >= 0).any():
            asked = np.zeros(len(self.wide), np.float32)
            asked[rows[rows >= 0]] = 1
            scores += asked @ self.wide
        scores[~free] = 0
        return scores

    def neighbours(self, seed: int, free: np.ndarray) -> np.ndarray:
        """Unused documents that share a term with the seed, best first by the sum over
        all terms, ties in shard order."""
        return _best_first(scores := self.scores(seed, free), np.flatnonzero(scores))


def _best_first(scores: np.ndarray, found: np.ndarray) -> np.ndarray:
    return found[np.argsort(-scores[found], kind="stable")]


def _filling(scores: np.ndarray, left: np.ndarray, space: int) -> tuple[list[int], int]:
    """The neighbours that fill the space, best first, each whole where it fits; and the best that
    doesn't fit in its turn, else -1."""
    taken: list[int] = []
    spare = -1

    def go_through(order: np.ndarray) -> None:
        nonlocal space, spare
        sizes, at = left[order], 0
        while space and at < len(order):
            fits = sizes[at:] <= space
            step = int(fits.argmax())
            if spare < 0 and not fits[0]:
                spare = int(order[at])
            if not fits[step]:
                return
            at += step
            taken.append(int(order[at]))
            space -= int(sizes[at])
            at += 1

    found = np.flatnonzero(scores)
    if len(found) > FIRST:
        held = scores[found]
        above = held >= np.partition(held, len(held) - FIRST)[len(held) - FIRST]
        go_through(_best_first(scores, found[above]))
        found = found[~above]
    if space and len(found):
        # those beyond the space can't come in any more; they count only as the first that doesn't fit
        go_through(_best_first(scores, found[left[found] <= space] if spare >= 0 else found))
    return taken, spare



def pack(docs: list[np.ndarray], idf: np.ndarray, mean: float, window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document, start, length). All but the last few are full; those have
    lengths of powers of two."""
    sequences: list[list[tuple[int, int, int]]] = []
    start = np.zeros(len(docs), np.int64)
    left = np.array([len(d) for d in docs], np.int64)
    for d in np.flatnonzero(left >= window).tolist():
        whole = int(left[d]) // window
        sequences += [[(d, k * window, window)] for k in range(whole)]
        start[d], left[d] = whole * window, left[d] - whole * window
    free = left > 0
    index = Index(docs, idf, mean) if free.any() else None
    cursor, cut = 0, -1
    while True:
        while cursor < len(docs) and not free[cursor]:
            cursor += 1
        seed = cut if cut >= 0 and free[cut] else cursor
        cut = -1
        if seed >= len(docs):
            return sequences
        filled, space = [], window

        def take(d: int, n: int) -> None:
            nonlocal space
            filled.append((d, int(start[d]), n))
            start[d] += n
            left[d] -= n
            space -= n
            free[d] = left[d] > 0

        take(seed, min(int(left[seed]), space))
        if space:
            taken, spare = _filling(index.scores(seed, free), left, space)
            for d in taken:
                take(d, int(left[d]))
            at = cursor
            while space:
                if spare < 0 or not free[spare]:
                    while at < len(docs) and not free[at]:
                        at += 1
                    if at >= len(docs):
                        break
                    spare = at
                take(spare, min(int(left[spare]), space))
                if free[spare]:
                    cut = spare
        if not space:
            sequences.append(filled)
            continue
        # the tail: cut where its length's binary digits are
        total, queue = window - space, filled[::-1]
        while total:
            room, part = 1 << (total.bit_length() - 1), []
            total -= room
            while room:
                d, s, n = queue.pop()
                if n > room:
                    queue.append((d, s + room, n - room))
                    n = room
                part.append((d, s, n))
                room -= n
            sequences.append(part)


def pack_documents(docs: DataFrame, *, window: int = WINDOW, tokenizer_path: str | None = None, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text", shard_ids: int = SHARD_IDS) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Null or empty text: the end id alone. Null ids and repeated rows are packed as
    they are; other columns take no part. An empty table gives no rows. A text longer
    than a window is cut, and its task holds it whole. What comes to the driver is the
    vocabulary's document frequencies, and ``sharded``'s counts.
    """
    path = tokenizer_path or default_path()
    tokens = stored(keyed_tokens(docs, path, end_id, id_col, text_col), "packing")
    with small_batches(docs.sparkSession):
        counts = {r["id"]: r["n"] for r in document_frequencies(tokens).collect()}
    n_docs, n_ids = counts.pop(-1, 0), counts.pop(-2, 0)
    df = np.zeros(max(counts, default=0) + 1)
    df[list(counts)] = list(counts.values())
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5)).astype(np.float32)
    mean = n_ids / max(1, n_docs)
    shards = max(1, -(-n_ids // shard_ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        made = 0
        doc_ids: list[int | None] = []
        texts: list[np.ndarray] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal made, held
            rows = []
            for sequence in pack(texts, idf, mean, window):
                offset = 0
                for d, s, n in sequence:
                    rows.append((doc_ids[d], s, n, zlib.crc32(texts[d][s : s + n].astype("<u4").tobytes()), len(texts[d]), shard << 32 | made, offset))
                    offset += n
                made += 1
            doc_ids.clear()
            texts.clear()
            held = 0
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], [f.split()[0] for f in PIECES.split(", ")])

        for batch in batches:
            for doc_id, blob, n in zip(batch.column("doc_id").to_pylist(), batch.column("ids").to_pylist(), batch.column("n").to_pylist(), strict=True):
                doc_ids.append(doc_id)
                texts.append(unpacked(blob, n))
                held += n
                if held >= 2 * shard_ids:  # a range with more than its share
                    yield flush()
        if texts:
            yield flush()

    dealt = sharded(tokens, shards, shard_ids).sortWithinPartitions("key", "doc_id", "ids")
    return stored(dealt.select("doc_id", "ids", "n").mapInArrow(run, PIECES), "pieces")
