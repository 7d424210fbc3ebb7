"""Suffix-array dedup: bytes of long strings that occur more than once go.

A string of ``length`` bytes is repeated if it starts at two places of the corpus.
Sorting every suffix would shuffle each byte many times over, so only suffixes that can
lie beside an equal one are sorted:

1. The string's *anchor* is the place in it whose ``GRAM`` bytes hash lowest: equal
   strings have it at the same distance. A run of starts that share an anchor is a row of
   two hashes (of the anchor's bytes, and of all bytes of the run's strings), so a text has
   a row for some 65 bytes. Rows are counted by hash before anything else is shuffled;
   an anchor of one row repeats nothing and goes, and equal rows are one row with its count.
2. Rows of an anchor that differ are cut into suffixes that stand for ``STEP`` starts each.
   Splitters sampled by Spark partition them by range of their leading bytes, 8 at a time as
   tokens, in order; ties are dealt on, so that a suffix that a third of the rows share fills
   many buckets. A bucket is sorted by multikey quicksort, and each run of equal suffixes
   settles its strings by the few bytes on either side.
3. Runs that touch a bucket's end may go on in the next: their strings are compared
   across the boundaries, by counts of the same keys.

Spans travel back to the texts by id and a hash of the text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType, StructField, StructType

from sieveline.llm.common import fresh, replacing, small_batches, stored
from sieveline.llm.wordhash import _powers, mix
from sieveline.operators.joins import redealt

#: Bytes hashed at an anchor, starts that a sorted suffix stands for, and bytes that a task hashes at a time.
GRAM, STEP, PIECE = 72, 16, 1 << 19
#: Suffixes of a bucket, about.
BUCKET = 40_000

_BASES = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_INVERSES = tuple(np.uint64(pow(int(b), -1, 1 << 64)) for b in _BASES)
_BYTES = np.random.default_rng(5).integers(0, 1 << 63, (2, 256), dtype=np.uint64)
_AT = np.uint64((1 << 21) - 1)

ANCHORS = "id long, row long, gram long, seg long, lo int, hi int, off int, reps int"


def _least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values, by minima within blocks from both sides."""
    n = len(h) - width + 1
    blocks = np.concatenate([h, np.full(-len(h) % width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1 : width - 1 + n])


def anchored(data: np.ndarray, starts: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of ``starts`` (ascending places in ``data`` where a string of ``length`` bytes
    may start) that share an anchor: first and last start, anchor, and both hashes."""
    with np.errstate(over="ignore"):
        n = len(data)
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(t[data] * _powers(b, n))]) for t, b in zip(_BYTES, _BASES, strict=True)]
        inverse = [_powers(i, n) for i in _INVERSES]
        h = mix((sums[0][gram:] - sums[0][:-gram]) * inverse[0][: n - gram + 1])
        placed = (h & ~_AT) | np.arange(len(h), dtype=np.uint64)  # of equal ones the first
        anchor = (_least(placed, length - gram + 1)[starts] & _AT).astype(np.int64)
        first = np.ones(len(starts), bool)
        first[1:] = (anchor[1:] != anchor[:-1]) | (starts[1:] != starts[:-1] + 1)
        lo, at = starts[first], anchor[first]
        hi = starts[np.append(np.flatnonzero(first)[1:] - 1, len(starts) - 1)]
        whole = (sums[1][hi + length] - sums[1][lo]) * inverse[1][lo]
        seg = mix(whole + mix((at - lo).astype(np.uint64) * np.uint64(1 << 21) + (hi - lo).astype(np.uint64)))
    return lo, hi, at, h[at], seg


def _pieces(columns: list[pa.Array], length: int) -> Iterator[tuple[np.ndarray, list[tuple[int, int, int]]]]:
    """Bytes of many texts with (row, place in the text, starts) of each; a long text comes in
    pieces that overlap by length - 1 bytes, so that each start is in one of them."""
    held, size, parts = [], 0, []
    for row, text in enumerate(columns):
        if text is None or len(text) < length:
            continue
        data = np.frombuffer(text, np.uint8)
        for at in range(0, len(data) - length + 1, PIECE):
            part = data[at : at + PIECE + length - 1]
            parts.append((row, at, len(part) - length + 1))
            held.append(part)
            size += len(part)
            if size >= PIECE:
                yield np.concatenate(held), parts
                held, size, parts = [], 0, []
    if held:
        yield np.concatenate(held), parts


def anchors(texts: DataFrame, length: int) -> DataFrame:
    """ANCHORS of (id, row, text): starts lo up to hi of the text have their anchor at lo + off.
    ``reps`` runs of one start each that follow each other and are equal are one row."""
    gram = min(GRAM, length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, parts in _pieces([t.as_buffer() if t.is_valid else None for t in batch.column("text")], length):
                row, at, n = (np.array(c, np.int64) for c in zip(*parts, strict=True))
                begin = np.cumsum(n + length - 1) - (n + length - 1)
                of = np.repeat(np.arange(len(n)), n)
                starts = np.arange(n.sum()) + np.repeat(begin - (np.cumsum(n) - n), n)
                lo, hi, anchor, grams, seg = anchored(data, starts, length, gram)
                of = of[np.searchsorted(starts, lo)]
                new = np.ones(len(lo), bool)
                new[1:] = (grams[1:] != grams[:-1]) | (seg[1:] != seg[:-1]) | (hi[1:] != lo[1:]) | (lo[1:] != hi[:-1] + 1) | (of[1:] != of[:-1])
                reps = np.diff(np.append(np.flatnonzero(new), len(lo)))
                shift = (at - begin)[of[new]]
                lo, hi, off, of = lo[new] + shift, hi[new] + shift, (anchor - lo)[new], row[of[new]]
                columns = [*[batch.column(c).take(pa.array(of)) for c in ("id", "row")], pa.array(grams[new].view(np.int64)), pa.array(seg[new].view(np.int64)), *[pa.array(c.astype(np.int32)) for c in (lo, hi, off, reps)]]
                yield pa.RecordBatch.from_arrays(columns, ["id", "row", "gram", "seg", "lo", "hi", "off", "reps"])

    return texts.mapInArrow(run, ANCHORS)


def suffixes(held: DataFrame, length: int) -> DataFrame:
    """Sorted suffixes' rows of (id, row, text, at: array of (lo, hi, off, n)).

    ``core`` is what the strings at up to STEP starts have in common, ``around`` the bytes
    on either side of it, ``open`` the starts (bit t: t bytes before the core) that the row
    stands for, ``place`` the core's place, ``n`` how often the whole row occurs."""
    step = min(STEP, length)
    core, side = length - step + 1, step - 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                text = np.frombuffer(batch.column("text")[i].as_buffer(), np.uint8)
                lo, hi, off, n = (np.array(batch.column("at")[i].values.field(c).to_numpy(), np.int64) for c in ("lo", "hi", "off", "n"))
                anchor = lo + off
                first, last = (anchor - hi) // step, (anchor - lo) // step  # blocks of distances to the anchor
                count = last - first + 1
                of = np.repeat(np.arange(len(lo)), count)
                block = first[of] + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                place = anchor[of] - block * step
                start = place[:, None] - np.arange(step)
                is_open = ((start >= lo[of, None]) & (start <= hi[of, None])) @ (1 << np.arange(step))
                padded = np.concatenate([np.zeros(side, np.uint8), text, np.zeros(length, np.uint8)])
                for a in range(0, len(place), 4096):
                    p = place[a : a + 4096] + side
                    cores = np.lib.stride_tricks.sliding_window_view(padded, core)[p]
                    near = np.concatenate([np.lib.stride_tricks.sliding_window_view(padded, max(side, 1))[x][:, :side] for x in (p - side, p + core)], axis=1)
                    columns = [[batch.column("id")[i].as_py()] * len(p), [batch.column("row")[i].as_py()] * len(p), place[a : a + 4096], is_open[a : a + 4096].astype(np.int32), n[of[a : a + 4096]]]
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64()]
                    raw = [pa.array([x.tobytes() for x in m], pa.binary()) for m in (cores, near)]
                    yield pa.RecordBatch.from_arrays([*map(pa.array, columns, kinds), *raw], ["id", "row", "place", "open", "n", "core", "around"])

    return held.mapInArrow(run, "id long, row long, place int, open int, n long, core binary, around binary")


def multikey_order(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort, a token of all undecided groups at a time: the order of the rows
    of ``tokens``, and the number of each sorted row's group of equal rows."""
    order = np.arange(len(tokens))
    group = np.zeros(len(tokens), np.int64)
    live = np.arange(len(tokens))  # sorted places whose group has more rows than one
    for depth in range(tokens.shape[1]):
        if not len(live):
            break
        token = tokens[order[live], depth]
        inner = np.lexsort((token, group[live]))
        order[live] = order[live][inner]
        token, g = token[inner], group[live]
        new = np.zeros(len(live), bool)
        new[0] = True
        new[1:] = (g[1:] != g[:-1]) | (token[1:] != token[:-1])
        firsts = np.flatnonzero(new)
        group[live] = live[firsts][np.cumsum(new) - 1]  # a group is named by its first place
        sizes = np.diff(np.append(firsts, len(live)))
        live = live[np.repeat(sizes > 1, sizes)]
    return order, group


def settle(table: pa.Table, length: int) -> Iterator[pa.RecordBatch]:
    """A bucket's rows: spans of starts that are repeated inside it, and the keys of the strings
    of its first and last run of equal suffixes, for the neighbours."""
    step = min(STEP, length)
    side, m = step - 1, table.num_rows
    flat = lambda c: np.frombuffer(b"".join(table.column(c).to_pylist()), np.uint8).reshape(m, -1)
    cores = flat("core")
    tokens = np.concatenate([cores, np.zeros((m, -cores.shape[1] % 8), np.uint8)], axis=1).view(">u8").astype(np.uint64)
    order, group = multikey_order(tokens)
    place, is_open, n = (table.column(c).to_numpy()[order] for c in ("place", "open", "n"))
    around = flat("around")[order] if side else np.zeros((m, 0), np.uint8)
    in_end = (group == group[0]) | (group == group[-1])
    run = np.cumsum(np.append(True, group[1:] != group[:-1])) - 1
    twice = (np.bincount(run)[run] > 1) | in_end
    kept = np.flatnonzero(twice)
    again = np.zeros((m, step), bool)
    names = {}
    for g in {group[0], group[-1]}:
        names[g] = np.frombuffer(hashlib.blake2b(cores[order[np.flatnonzero(group == g)[0]]].tobytes(), digest_size=16).digest(), "<i8")
    outer = []
    for t in range(step):
        rows = kept[(is_open[kept] >> t) & 1 == 1]
        if not len(rows):
            continue
        near = np.zeros((len(rows), 16), np.uint8)
        near[:, :side] = around[rows, side - t : 2 * side - t]
        x, y = near.view("<i8").T
        sort = np.lexsort((y, x, run[rows]))
        r, x, y = rows[sort], x[sort], y[sort]
        new = np.append(True, (run[r[1:]] != run[r[:-1]]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]))
        firsts = np.flatnonzero(new)
        total = np.add.reduceat(n[r], firsts)
        again[r, t] = np.repeat(total > 1, np.diff(np.append(firsts, len(r))))
        shown = in_end[r[firsts]]  # one row for each string of an end run
        i = firsts[shown]
        core = np.where((group[r[i]] == group[0])[:, None], names[group[0]], names[group[-1]])
        outer.append((r[i], np.full(len(i), t), *core.T, x[i], y[i], total[shown]))
    ids, rows = (table.column(c).combine_chunks().take(pa.array(order)) for c in ("id", "row"))
    of = lambda c, i: c.take(pa.array(i))
    ended = ((again & ~np.pad(again, ((0, 0), (0, 1)))[:, 1:]).nonzero(), (again & ~np.pad(again, ((0, 0), (1, 0)))[:, :-1]).nonzero())
    (at, far), (_, near) = ended  # bit t is a start t bytes before the core: the span's first start has the largest t
    fields = ["id", "row", "lo", "hi", "c1", "c2", "t", "x", "y", "n"]
    blank = lambda k: [pa.nulls(k, t) for t in (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())]
    if len(at):
        yield pa.RecordBatch.from_arrays([of(ids, at), of(rows, at), pa.array((place[at] - far).astype(np.int32)), pa.array((place[at] - near).astype(np.int32)), *blank(len(at))], fields)
    if outer:
        r, t, c1, c2, x, y, total = (np.concatenate(c) for c in zip(*outer, strict=True))
        start = pa.array((place[r] - t).astype(np.int32))
        yield pa.RecordBatch.from_arrays([of(ids, r), of(rows, r), start, start, pa.array(c1), pa.array(c2), pa.array(t.astype(np.int32)), pa.array(x), pa.array(y), pa.array(total)], fields)


def repeated(rows: DataFrame, length: int, bucket: int = BUCKET) -> DataFrame:
    """(id, row, lo, hi): spans of starts that the sorted suffixes find repeated."""
    rows = stored(rows, "suffixes")
    buckets = max(1, -(-rows.count() // bucket))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if sum(b.num_rows for b in held):
            yield from settle(pa.Table.from_batches(held), length)

    dealt = rows.withColumn("tie", F.xxhash64("id", "row", "place")).repartitionByRange(buckets, "core", "tie").drop("tie")
    found = stored(dealt.mapInArrow(run, "id long, row long, lo int, hi int, c1 long, c2 long, t int, x long, y long, n long"), "suffix-runs")
    inside = found.where("c1 IS NULL").select("id", "row", "lo", "hi")
    key = ["c1", "c2", "t", "x", "y"]
    ends = found.where("c1 IS NOT NULL")
    shared = redealt(ends.groupBy(*key).agg(F.sum("n").alias("total")).where("total > 1"))
    return inside.unionByName(ends.join(shared, key).select("id", "row", "lo", "hi"))


def _cut(texts: pa.Array, spans: pa.Array) -> Iterator[tuple[int, int, int, bytes]]:
    for text, some in zip(texts, spans, strict=True):
        data = text.as_py()
        if not some.is_valid or not len(some):
            yield len(data), 0, 0, data
            continue
        lo, hi = (some.values.field(c).to_numpy().astype(np.int64) for c in ("lo", "hi"))
        order = np.argsort(lo, kind="stable")
        lo, hi = lo[order], np.maximum.accumulate(hi[order])
        new = np.append(True, lo[1:] > hi[:-1])
        lo, hi = lo[new], hi[np.append(np.flatnonzero(new)[1:] - 1, len(hi) - 1)]
        edges = zip(np.append(0, hi).tolist(), np.append(lo, len(data)).tolist(), strict=True)
        yield len(data), int((hi - lo).sum()), len(lo), b"".join(data[a:b] for a, b in edges)


def drop_repeated_strings(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``
    (binary: the UTF-8 bytes left, which may be cut inside a character).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else, in
    the same text or another; overlapping strings count, strings never cross texts, and all
    are judged on the input. Null text is empty, and shorter texts stay whole. Rows that
    repeat an id (null or not) are rows of their own, so a repeated row of ``length``
    bytes or more goes whole. An empty table gives no rows. All input columns stay, but for
    those named like an output. Work follows bytes, a very long text is hashed in pieces, and
    a task holds one bucket of suffixes or one text's spans.
    """
    spark = docs.sparkSession
    key, row, text, at_id, at_row, spans, *made = fresh(docs.columns, "__key", "__row", "__text", "__id", "__at", "__spans", "__bytes", "__removed", "__runs", "__kept")
    whole = docs.withColumns({key: F.col(f"`{id_col}`").cast("long"), text: F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))}).withColumn(row, F.xxhash64(text))
    raw = whole.select(F.col(key).alias("id"), F.col(row).alias("row"), F.col(text).cast("binary").alias("text")).where(F.octet_length("text") >= length)
    found = stored(anchors(raw, length), "anchors")
    often = redealt(found.groupBy("gram").agg(F.sum("reps").alias("all")).where("all > 1").select("gram"))
    hits = stored(found.join(often, "gram"), "anchors-often")
    one = F.struct("id", "row", "lo", "hi", "off")
    kinds = stored(hits.groupBy("gram", "seg").agg(F.sum("reps").alias("n"), F.min(one).alias("at")), "anchor-kinds")
    mixed = redealt(kinds.groupBy("gram").agg(F.count("*").alias("kinds"), F.min("n").alias("least")).where("kinds > 1 AND least = 1").select("gram"))
    # texts with strings to sort: each kind of such an anchor once, from the first place that has it
    places = kinds.join(mixed, "gram").select("at.id", "at.row", F.struct("at.lo", "at.hi", "at.off", "n").alias("at")).groupBy("id", "row").agg(F.collect_list("at").alias("at"))
    # a text that repeats under its id is read once
    joined = raw.alias("a").join(places.alias("b"), F.expr("a.id <=> b.id AND a.row = b.row")).selectExpr("a.id", "a.row", "a.text", "b.at")
    with small_batches(spark):
        sorted_out = repeated(suffixes(joined, length), length)
    full = redealt(kinds.where("n > 1").select("gram", "seg"))
    runs = hits.join(full, ["gram", "seg"]).select("id", "row", "lo", (F.col("hi") + F.col("reps") - 1).alias("hi"))
    marked = runs.unionByName(sorted_out).groupBy("id", "row").agg(F.collect_list(F.struct("lo", (F.col("hi") + length).alias("hi"))).alias(spans))

    cuts = whole.join(marked.withColumnsRenamed({"id": at_id, "row": at_row}), F.col(key).eqNullSafe(F.col(at_id)) & (F.col(row) == F.col(at_row)), "left").drop(at_id, at_row, row, key)
    out = StructType([*[f for f in cuts.schema if f.name not in (spans, text)], *[StructField(c, LongType()) for c in made[:3]], StructField(made[3], BinaryType())])
    names = [f.name for f in out]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 100):
                part = batch.slice(a, 100)
                new = zip(*_cut(part.column(text), part.column(spans)), strict=True)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.binary())
                own = [part.column(i) for i, c in enumerate(part.schema.names) if c not in (spans, text)]
                yield pa.RecordBatch.from_arrays([*own, *map(pa.array, new, kinds)], names)

    cuts = cuts.withColumn(text, F.col(text).cast("binary"))
    done = cuts.mapInArrow(cut, out)
    return replacing(done, **dict(zip(("n_bytes", "n_removed", "n_spans", "kept"), map(F.col, made), strict=True))).drop(*made)
