"""SimHash near-dedup: fingerprints that differ in few bits, and what they connect.

A fingerprint is embedded by the number of ones in each of its 32 two-bit
segments. The Manhattan distance of two embeddings never exceeds the Hamming
distance, so the join is one of range: points within ``MOST_BITS`` of each
other. Counts of a segment are written in unary (00, 01, 11), which makes the
Manhattan distance a population count of one exclusive or.

The grid's cells are the points of one half of the embedding, 16 segments. Of a
distance of at most 3, one half has at most 1; so each point looks into its own
cell and the cells one step up in one segment, in both halves, and every pair
within range meets. The whole Manhattan distance then filters, and the
fingerprints themselves decide.

Only distinct fingerprints take part, so exact copies cost nothing. A cell of
many distinct fingerprints is dealt out in square blocks of bounded size, and a
block returns a spanning set of its links rather than its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import stored, without
from sieveline.llm.tokens import text_blocks
from sieveline.llm.wordhash import Words, bit_counts
from sieveline.operators.graph import components
from sieveline.operators.joins import redealt

WIDTH = 3
MOST_BITS = 3
#: A cell with more distinct fingerprints is dealt out in blocks of this side.
CELL, BLOCK = 128, 2048
_EVEN = 0x5555555555555555


def fingerprint_ints(texts: list[str | None], width: int = WIDTH) -> np.ndarray:
    """A bit is set where over half of the shingles' XXH64 have it; no words: zero."""
    hashes, counts = Words(texts).xxh64(width)
    ones = bit_counts(hashes, counts)
    packed = np.packbits(2 * ones > counts[:, None], axis=1, bitorder="little")
    return packed.view("<i8").reshape(-1)


def fingerprints(docs: DataFrame, *, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the fingerprint as a signed 64-bit integer, one row per row; null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_blocks(batches, "__text", 2 << 20):
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(fingerprint_ints(texts, width), pa.int64())], ["doc_id", "fp"])

    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("__text")).mapInArrow(run, "doc_id long, fp long")


def embedding(fp: Column) -> Column:
    """Each two-bit segment's ones, in unary."""
    even, odd = F.lit(_EVEN), F.shiftrightunsigned(fp, 1)
    return F.shiftleft(fp.bitwiseAND(odd).bitwiseAND(even), 1).bitwiseOR(fp.bitwiseOR(odd).bitwiseAND(even))


def _cells(half: Column) -> Column:
    """A half's own cell first, then the cells one step up; null where a segment is full."""

    def up(k: int) -> Column:
        segment = F.shiftrightunsigned(half, 2 * k).bitwiseAND(F.lit(3))
        return F.when(segment == 0, half.bitwiseOR(F.lit(1 << 2 * k))).when(segment == 1, half.bitwiseOR(F.lit(2 << 2 * k)))

    return F.array(half, *[up(k) for k in range(16)])


def links(classes: DataFrame, *, cell: int = CELL, block: int = BLOCK) -> DataFrame:
    """a, b: links between distinct fingerprints (column fp), enough to connect
    whatever differs in at most MOST_BITS bits, and nothing else."""
    points = classes.select("fp", embedding(F.col("fp")).alias("t"))
    low, high = F.col("t").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("t", 32)
    halves = points.select("fp", "t", F.explode(F.array(F.struct(F.lit(0).alias("half"), low.alias("at")), F.struct(F.lit(1).alias("half"), high.alias("at")))).alias("h")).select("fp", "t", "h.half", F.col("h.at").alias("cell"))
    looks = halves.select(F.col("fp").alias("fq"), F.col("t").alias("tq"), "half", F.posexplode(_cells(F.col("cell"))).alias("step", "cell")).where("cell IS NOT NULL")
    full = stored(halves.groupBy("half", "cell").agg(F.count("*").alias("n")).where(F.col("n") > cell), "cells")
    near = (F.bit_count(F.col("t").bitwiseXOR(F.col("tq"))) <= MOST_BITS) & (F.bit_count(F.col("fp").bitwiseXOR(F.col("fq"))) <= MOST_BITS)
    once = (F.col("step") > 0) | (F.col("fp") < F.col("fq"))
    if full.isEmpty():
        return halves.join(looks, ["half", "cell"]).where(once & near).select(F.col("fp").alias("a"), F.col("fq").alias("b"))
    keys = full.select("half", "cell")
    sparse = halves.join(keys, ["half", "cell"], "left_anti").join(looks, ["half", "cell"]).where(once & near).select(F.col("fp").alias("a"), F.col("fq").alias("b"))

    # full cells: both sides are dealt to blocks by hash, and every block of one side meets every block of the other
    held = halves.join(full, ["half", "cell"])
    seen = looks.join(keys, ["half", "cell"])
    sizes = full.join(seen.groupBy("half", "cell").agg(F.count("*").alias("m")), ["half", "cell"]).select("half", "cell", F.ceil(F.col("n") / block).alias("nb"), F.ceil(F.col("m") / block).alias("mb"))
    spread = lambda fp, n: F.pmod(F.xxhash64(fp), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    left = held.drop("n", "t").join(sizes, ["half", "cell"]).select("half", "cell", spread("fp", "nb").alias("i"), every("mb").alias("j"), F.col("fp").alias("p"), F.lit(True).alias("side"))
    right = seen.join(sizes, ["half", "cell"]).select("half", "cell", every("nb").alias("i"), spread("fq", "mb").alias("j"), F.col("fq").alias("p"), F.lit(False).alias("side"))

    def connect(rows: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame(spanning(rows["p"].to_numpy()[rows["side"].to_numpy()], rows["p"].to_numpy()[~rows["side"].to_numpy()]), columns=["a", "b"])

    dense = left.unionByName(right).groupBy("half", "cell", "i", "j").applyInPandas(connect, "a long, b long")
    return sparse.unionByName(dense)


def spanning(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Links (rows of two) that connect what the pairs within MOST_BITS between the
    two sides connect; each is a chain of such pairs, at most one per member."""
    left, right = np.unique(left), np.unique(right)
    near = np.bitwise_count((left[:, None] ^ right[None, :]).view(np.uint64)) <= MOST_BITS  # (of signed numbers it counts the absolute value)
    rank = {x: i for i, x in enumerate(np.union1d(left, right).tolist())}
    value = np.array(list(rank), np.int64)
    own = [np.array([rank[x] for x in side.tolist()], np.int64) for side in (left, right)]
    label = np.arange(len(value))
    while True:
        before = label.copy()
        for (at, to), adjacent in zip((own, own[::-1]), (near, near.T), strict=True):
            least = np.where(adjacent, label[to][None, :], len(value)).min(axis=1, initial=len(value))
            np.minimum.at(label, at, least)
        if (label == before).all():
            break
    moved = np.flatnonzero(label != np.arange(len(label)))
    return np.stack([value[label[moved]], value[moved]], axis=1)


def near_duplicates(docs: DataFrame, *, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row: the smallest
    doc_id that links of at most MOST_BITS bits reach.

    Null or empty text has the fingerprint zero and links like any other. A null
    doc_id keeps its row and is never a component_id, unless all of its component
    are null. Repeated rows stay. An empty table gives no rows.
    """
    prints = stored(fingerprints(docs, width=width, id_col=id_col, text_col=text_col), "prints")
    classes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes))
    known = classes.join(roots, classes["fp"] == roots["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    least = known.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = known.join(redealt(least), "root").select("fp", "component_id")
    return prints.join(labels, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id. Rows
    with a null id stay; so do all rows that repeat a kept id."""
    found = near_duplicates(docs, id_col=id_col, text_col=text_col, width=width)
    return without(docs, id_col, stored(found.where("doc_id <> component_id").select("doc_id").distinct(), "copies"))
