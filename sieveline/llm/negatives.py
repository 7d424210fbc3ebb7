"""Hard-negative mining by a pivot table.

Vectors become integers. Each is given one more component, so that all have the length of
the longest, and an anchor a zero: then |anchor - row|² = longest² + |anchor|² - 2 * score,
and the largest inner products are the nearest rows. The pivot table holds each row's
distances to a few pivots; by the triangle inequality they bracket its distance to any
anchor, and so its score. Rows lie in blocks by their nearest pivot and their distance to
it, anchors likewise, and a block keeps the range of its distances:

* two blocks meet only if their ranges leave room for a score that is still wanted;
* of those, only the rows whose own bracket reaches it are checked, by the exact product.

Positives come first: each block of anchors meets its nearest block, which gives every anchor a
score to beat, then all others that may hold a better one. Negatives follow, with the
positives' scores as the band. A task has one block of either side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import stored

#: Pivots, rows that they are chosen from, rows of a block, anchors of a block, and rows checked at a time.
PIVOTS, SAMPLE, ROWS, ANCHORS, PAGE = 16, 512, 8192, 512, 1024
#: Scores up to this are exact in double precision, and so are sums on the way to them.
EXACT = 1 << 52

PACKED = "dims int, ids binary, labels binary, vectors binary, near array<double>, far array<double>, low long, high long, most double"
Pivots = dict[int, np.ndarray]


def whole_vectors(df: DataFrame, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """id, label, v: rows that take part, v as integers. Of rows that repeat an id the least."""
    name = lambda c: F.col(f"`{c}`")
    v = F.transform(name(vector_col).cast("array<double>"), lambda x: F.floor(x * scale))
    real = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    kept = df.where(name(id_col).isNotNull() & name(label_col).isNotNull() & (F.size(name(vector_col)) > 0) & F.forall(name(vector_col).cast("array<double>"), real))
    return kept.select(name(id_col).cast("long").alias("id"), name(label_col).cast("long").alias("label"), v.alias("v")).groupBy("id").agg(F.min(F.struct("label", "v")).alias("m")).select("id", "m.label", "m.v")


def matrix(column: pa.ChunkedArray | pa.Array, dims: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(-1, dims)


def choose_pivots(sample: list[list[int]], longest: float) -> Pivots:
    """For each length of vectors, sampled rows far from each other."""
    out = {}
    for dims in {len(v) for v in sample}:
        x = np.array([v for v in sample if len(v) == dims], float)
        x = np.column_stack([x, np.sqrt(np.maximum(longest - (x**2).sum(1), 0))])
        chosen = [0]
        apart = ((x - x[0]) ** 2).sum(1)
        while len(chosen) < min(PIVOTS, len(x)):
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, ((x - x[chosen[-1]]) ** 2).sum(1))
        out[dims] = x[chosen]
    return out


def distances(x: np.ndarray, pivots: Pivots, longest: float, anchors: bool) -> np.ndarray:
    """Of rows (or anchors, whose added component is 0) to the pivots of their length; where the
    sample had none of it, to the longest vector along the first axis."""
    dims = x.shape[1]
    p = pivots.get(dims)
    if p is None:
        p = np.append(np.sqrt(longest), np.zeros(dims))[None]
    norms = (x.astype(float) ** 2).sum(1)
    extra = np.zeros(len(x)) if anchors else np.sqrt(np.maximum(longest - norms, 0))
    square = norms[:, None] + extra[:, None] ** 2 + (p**2).sum(1) - 2 * (x @ p[:, :-1].T + extra[:, None] * p[:, -1])
    return np.sqrt(np.maximum(square, 0))


def blocks(rows: DataFrame, pivots: Pivots, longest: float, size: int, anchors: bool) -> DataFrame:
    """PACKED blocks with a number, of rows that lie near each other."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dims))
                d = distances(matrix(part.column("v"), dims), pivots, longest, anchors)
                first = d.argmin(1)
                columns = [*[part.column(c) for c in ("id", "label", "v", "dims")], pa.array(first.astype(np.int32)), pa.array(d[np.arange(len(d)), first])]
                yield pa.RecordBatch.from_arrays(columns, ["id", "label", "v", "dims", "pivot", "apart"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
            lengths = table.column("dims").to_numpy()
            for dims in np.unique(lengths).tolist():
                part = table.filter(pa.array(lengths == dims))
                x = matrix(part.column("v"), dims)
                for a in range(0, len(x), size):
                    some = x[a : a + size]
                    d = distances(some, pivots, longest, anchors)
                    ids, labels = (part.column(c).to_numpy()[a : a + size] for c in ("id", "label"))
                    values = [[dims], [ids.tobytes()], [labels.tobytes()], [some.astype("<i4").tobytes()], [d.min(0).tolist()], [d.max(0).tolist()], [int(labels.min())], [int(labels.max())], [float((some.astype(float) ** 2).sum(1).max())]]
                    kinds = [pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.int64(), pa.int64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], ["dims", "ids", "labels", "vectors", "near", "far", "low", "high", "most"])

        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                table = pa.Table.from_batches(held)
                yield from packed(table.slice(0, size))
                held = table.slice(size).to_batches()
        if held:
            yield from packed(pa.Table.from_batches(held))

    placed = stored(rows.withColumn("dims", F.size("v")).mapInArrow(place, "id long, label long, v array<long>, dims int, pivot int, apart double"), "pivot-rows")
    parts = max(1, -(-placed.count() // (4 * size)))
    order = ["dims", "pivot", "apart", "id"]
    ordered = placed.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return stored(ordered.mapInArrow(pack, PACKED).withColumn("block", F.monotonically_increasing_id()), "pivot-blocks")


def meetings(anchors: DataFrame, rows: DataFrame, longest: float) -> DataFrame:
    """ab, rb of blocks of one length, with what the pivots say of every pair of theirs: ``upper``
    and ``lower``, bounds of its score."""
    salts = 16  # all blocks may have one length: they are dealt to so many keys
    a = anchors.select(F.col("block").alias("ab"), "dims", F.col("near").alias("an"), F.col("far").alias("af"), F.col("low").alias("al"), F.col("high").alias("ah"), "most", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    b = rows.select(F.col("block").alias("rb"), "dims", F.col("near").alias("rn"), F.col("far").alias("rf"), F.col("low").alias("rl"), F.col("high").alias("rh"), F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"))
    least = F.array_max(F.zip_with(F.zip_with("an", "rf", lambda x, y: x - y), F.zip_with("rn", "af", lambda x, y: x - y), lambda x, y: F.greatest(x, y)))
    most = F.array_min(F.zip_with("af", "rf", lambda x, y: x + y))
    slack = longest * 1e-9 + 1
    upper = (longest + F.col("most") - F.pow(F.greatest(least, F.lit(0.0)), F.lit(2))) / 2 + slack
    lower = (longest - F.pow(most, F.lit(2))) / 2 - slack
    return a.join(b, ["dims", "salt"]).select("ab", "rb", upper.alias("upper"), lower.alias("lower"), ((F.col("al") <= F.col("rh")) & (F.col("rl") <= F.col("ah"))).alias("alike"), ((F.col("al") != F.col("ah")) | (F.col("rl") != F.col("rh")) | (F.col("al") != F.col("rl"))).alias("unlike"))


class Best:
    """The first ``k`` of each slot by (score, smaller id), of what pages bring."""

    def __init__(self, slots: int, k: int):
        self.k, self.kth, self.parts = k, np.full(slots, -np.inf), []

    def add(self, slots: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """scores: of slots x ids, -inf where a pair isn't wanted."""
        if scores.shape[1] >= self.k:
            own = np.partition(scores, -self.k, axis=1)[:, -self.k]
            self.kth[slots] = np.maximum(self.kth[slots], own)
        i, j = np.nonzero((scores >= self.kth[slots][:, None]) & (scores > -np.inf))
        self.parts.append((slots[i], ids[j], scores[i, j]))

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        slot, ids, score = (np.concatenate(c) for c in zip(*self.parts, strict=True)) if self.parts else (np.zeros(0, int), np.zeros(0, np.int64), np.zeros(0))
        order = np.lexsort((ids, -score, slot))
        slot, ids, score = slot[order], ids[order], score[order]
        first = np.flatnonzero(np.append(True, slot[1:] != slot[:-1])) if len(slot) else np.zeros(0, int)
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.append(first, len(slot))))
        keep = rank < self.k
        return slot[keep], ids[keep], score[keep]


def survivors(dq: np.ndarray, dx: np.ndarray, norms: np.ndarray, longest: float, floor: np.ndarray, ceiling: np.ndarray) -> np.ndarray:
    """Pairs whose bracket by the pivots meets their anchor's [floor, ceiling]."""
    least, most = np.zeros((len(dq), len(dx))), np.full((len(dq), len(dx)), np.inf)
    for j in range(dq.shape[1]):
        least = np.maximum(least, np.abs(dq[:, j, None] - dx[None, :, j]))
        most = np.minimum(most, dq[:, j, None] + dx[None, :, j])
    slack = longest * 1e-9 + 1
    base = longest + norms[:, None]
    return ((base - least**2) / 2 + slack >= floor[:, None]) & ((base - most**2) / 2 - slack <= ceiling[:, None])


def _opened(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, labels = np.frombuffer(row["ids"], "<i8"), np.frombuffer(row["labels"], "<i8")
    return ids, labels, np.frombuffer(row["vectors"], "<i4").reshape(len(ids), -1).astype(float)


def checked(met: DataFrame, anchors: DataFrame, rows: DataFrame, kernel: Callable, schema: str, name: str) -> DataFrame:
    """The kernel's rows for all pairs of blocks in ``met`` (ab, rb); a worker has few at a time."""
    side = lambda df, key, tag: df.select(F.col("block").alias(key), F.struct(*[c for c in df.columns if c not in ("block", "near", "far", "low", "high")]).alias(tag))
    pairs = met.select("ab", "rb").join(side(anchors, "ab", "a"), "ab").join(side(rows, "rb", "b"), "rb").select("a", "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield kernel(batch.column("a")[i].as_py(), batch.column("b")[i].as_py())

    spark, key = met.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(key)
    spark.conf.set(key, "4")
    try:
        return stored(pairs.mapInArrow(run, schema), name)
    finally:
        spark.conf.set(key, own)


def hard_negatives(
    df: DataFrame, anchors: Column, *, id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding", scale: int = 256,
    positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
) -> DataFrame:
    """anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    A vector's components become floor(scale * x), and scores are their inner products. An
    anchor's positives are its first ``positives`` other rows of its label, by score, ties to
    the smaller id; for each, its negatives are the first ``negatives`` rows of other labels
    with low * positive <= 100 * score <= high * positive. All there are, if fewer; a
    positive below zero has none. ``anchors`` is a condition on ``df``.

    Null ids, null labels, null or empty vectors, and vectors with a null or non-finite
    component take no part. Rows that repeat an id count once, as the least of them by label and
    vector. Vectors of different lengths don't meet. Vectors so long that scores aren't exact (2**52)
    are an error. An empty table gives no rows; other columns take no part.
    """
    spark = df.sparkSession
    rows = stored(whole_vectors(df, id_col, label_col, vector_col, scale), "pivot-vectors")
    square = F.aggregate(F.transform("v", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda total, x: total + x)
    longest = rows.agg(F.max(square)).first()[0] or 0.0
    if longest * max(low, high, 100) > EXACT:
        raise ValueError(f"vectors are too long for exact scores: the largest square is {longest:g}")
    pivots = choose_pivots([r["v"] for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()], longest)
    asked = df.where(anchors).select(F.col(f"`{id_col}`").cast("long").alias("id")).distinct()
    held = blocks(rows, pivots, longest, ROWS, False)
    asks = blocks(rows.join(asked, "id", "left_semi"), pivots, longest, ANCHORS, True)
    met = stored(meetings(asks, held, longest), "pivot-meetings")

    def best_positives(a: dict, b: dict) -> pa.RecordBatch:
        (ids, labels, x), (others, kinds, y) = _opened(a), _opened(b)
        floor = np.frombuffer(a["floors"], "<f8") if a.get("floors") else np.full(len(ids), -np.inf)
        dq, dx, norms = distances(x, pivots, longest, True), distances(y, pivots, longest, False), (x**2).sum(1)
        best = Best(len(ids), positives)
        best.kth = floor.copy()
        for at in range(0, len(others), PAGE):
            p = slice(at, at + PAGE)
            near = survivors(dq, dx[p], norms, longest, best.kth, np.full(len(ids), np.inf)) & (labels[:, None] == kinds[None, p]) & (ids[:, None] != others[None, p])
            i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if len(i):
                best.add(i, others[p][j], np.where(near[np.ix_(i, j)], x[i] @ y[p][j].T, -np.inf))
        slot, found, score = best.result()
        return pa.RecordBatch.from_arrays([pa.array(ids[slot]), pa.array(found), pa.array(score.astype(np.int64))], ["anchor_id", "positive_id", "positive_score"])

    kind = "anchor_id long, positive_id long, positive_score long"
    cut = Window.partitionBy("anchor_id").orderBy(F.desc("positive_score"), "positive_id")
    top = lambda found: found.withColumn("n", F.row_number().over(cut)).where(F.col("n") <= positives)
    home = F.row_number().over(Window.partitionBy("ab").orderBy(F.desc("upper"), "rb"))
    first = stored(met.where("alike").withColumn("n", home).where("n = 1").select("ab", "rb"), "pivot-homes")
    near = checked(first, asks, held, best_positives, kind, "pivot-first")
    floors = top(near).where(F.col("n") == positives).select("anchor_id", F.col("positive_score").cast("double").alias("floor"))
    known = stored(with_values(asks, floors, "floors", "floor", "min"), "pivot-floors")
    rest = met.where("alike").join(first, ["ab", "rb"], "left_anti").join(known.select(F.col("block").alias("ab"), "bound"), "ab").where(F.col("upper") >= F.col("bound"))
    others = checked(rest, known, held, best_positives, kind, "pivot-rest")
    chosen = stored(top(near.unionByName(others)).drop("n"), "pivot-positives")

    def best_negatives(a: dict, b: dict) -> pa.RecordBatch:
        (ids, labels, x), (others, kinds, y) = _opened(a), _opened(b)
        at_slot = np.repeat(np.arange(len(ids)), [len(p) for p in a["values"]])
        held_ids = np.array([p["id"] for some in a["values"] for p in some], np.int64)
        score = np.array([p["score"] for some in a["values"] for p in some], np.int64)
        floor, ceiling = np.full(len(ids), np.inf), np.full(len(ids), -np.inf)
        np.minimum.at(floor, at_slot, score * low / 100)
        np.maximum.at(ceiling, at_slot, score * high / 100)
        dq, dx, norms = distances(x, pivots, longest, True), distances(y, pivots, longest, False), (x**2).sum(1)
        best = Best(len(held_ids), negatives)
        for at in range(0, len(others), PAGE):
            p = slice(at, at + PAGE)
            wanted = np.full(len(ids), np.inf)
            np.minimum.at(wanted, at_slot, best.kth)  # what every positive of an anchor has ten better ones than isn't looked at
            near = survivors(dq, dx[p], norms, longest, np.maximum(floor, wanted), ceiling) & (labels[:, None] != kinds[None, p])
            i, j = np.flatnonzero(near.any(1)), np.flatnonzero(near.any(0))
            if not len(i):
                continue
            product = np.where(near[np.ix_(i, j)], x[i] @ y[p][j].T, -np.inf)
            slots = np.flatnonzero(np.isin(at_slot, i))
            own = product[np.searchsorted(i, at_slot[slots])]
            fits = (100 * own >= low * score[slots, None]) & (100 * own <= high * score[slots, None])
            best.add(slots, others[p][j], np.where(fits, own, -np.inf))
        slot, found, s = best.result()
        return pa.RecordBatch.from_arrays([pa.array(ids[at_slot[slot]]), pa.array(held_ids[slot]), pa.array(score[slot]), pa.array(found), pa.array(s.astype(np.int64))], ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"])

    lists = chosen.groupBy("anchor_id").agg(F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("some"))
    banded = stored(with_lists(asks, lists, low, high), "pivot-bands")
    room = met.where("unlike").join(banded.select(F.col("block").alias("ab"), "floor", "ceiling"), "ab").where((F.col("upper") >= F.col("floor")) & (F.col("lower") <= F.col("ceiling")))
    found = checked(room, banded, held, best_negatives, f"{kind}, negative_id long, negative_score long", "pivot-negatives")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("negative_score"), "negative_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= negatives).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _members(asks: DataFrame) -> DataFrame:
    """block, at, anchor_id: a block's anchors with their places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = np.frombuffer(batch.column("ids")[i].as_py(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), batch.column("block")[i].as_py())), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)], ["block", "at", "anchor_id"])

    return asks.select("block", "ids").mapInArrow(run, "block long, at int, anchor_id long")


def with_values(asks: DataFrame, values: DataFrame, name: str, value: str, bound: str) -> DataFrame:
    """``asks`` with ``name``, a double for each of its anchors (minus infinity where there's none), and
    ``bound``, the least of them."""
    lowest = F.lit(float("-inf"))
    each = _members(asks).join(values, "anchor_id", "left").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce(value, lowest).alias("x")))).alias("xs"))
    each = each.select("block", F.transform("xs", lambda s: s["x"]).alias("xs")).select("block", "xs", F.array_min("xs").alias("bound"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = [np.array(x, "<f8").tobytes() for x in batch.column("xs").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(raw, pa.binary()), batch.column("bound")], ["block", name, "bound"])

    return asks.join(each.mapInArrow(run, f"block long, {name} binary, bound double"), "block")


def with_lists(asks: DataFrame, lists: DataFrame, low: int, high: int) -> DataFrame:
    """``asks`` with ``values``, each anchor's positives, and the block's lowest floor and highest ceiling."""
    none = F.array().cast("array<struct<id:bigint,score:bigint>>")
    each = _members(asks).join(lists, "anchor_id", "left").groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", F.coalesce("some", none).alias("some")))).alias("m"))
    values = F.transform("m", lambda s: s["some"])
    scores = F.transform(F.flatten(values), lambda s: s["score"])
    each = each.select("block", values.alias("values"), (F.array_min(scores) * low / 100).alias("floor"), (F.array_max(scores) * high / 100).alias("ceiling"))
    return asks.join(each.where("floor IS NOT NULL"), "block")
