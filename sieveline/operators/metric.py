"""Exact similarity joins by metric partitioning.

A few pivots cut the space into Voronoi cells; rows are dealt by range of (cell, distance to its
pivot) and packed into blocks, each of which keeps the range of its rows' distances to every
pivot. By the triangle inequality two rows are at least as far apart as their distances to any
pivot differ, and |x - y|² = |x|² + |y|² - 2<x, y>, so the ranges bound the inner products of two blocks, and of
two pages inside them. Blocks that can't hold a pair similar enough never meet: a row travels only
to the blocks that its own may match. What meets is screened in single precision with a bound of
its error, and what passes is computed in double precision.

Clustered vectors meet few blocks. Vectors that lie evenly in many dimensions can't be pruned by any
metric; there every two blocks meet, once, and the work is that of a blocked product.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.session import written

#: Pivots, how many of them blocks are told apart by, rows that they are chosen from, rows of a block and of a page.
PIVOTS, TOLD, SAMPLE, BLOCK, PAGE = 256, 32, 4096, 4096, 256
#: Keys that blocks of one length are dealt to where they look for each other.
SALTS = 16

PACKED = "dims int, ids binary, vectors binary, near array<double>, far array<double>, longest double"


def similarity(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows (or one row), each by itself, so that copies are equal to the last bit."""
    return (x * y).sum(axis=-1)


def _pivots(sample: list[list[float]]) -> dict[int, np.ndarray]:
    """For each length of vectors some sampled rows that are far from each other."""
    out = {}
    for dims in {len(v) for v in sample}:
        x = np.array([v for v in sample if len(v) == dims])
        wanted = min(PIVOTS, max(1, len(x) // 4))
        chosen, apart = [0], ((x - x[0]) ** 2).sum(1)
        while len(chosen) < wanted:
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, ((x - x[chosen[-1]]) ** 2).sum(1))
        out[dims] = x[chosen]
    return out


def _places(p: np.ndarray) -> np.ndarray:
    """Places of the pivots along a path from each to the nearest one not yet passed, so that rows of
    neighbouring cells lie side by side."""
    place, left, at = np.zeros(len(p), np.int32), np.ones(len(p), bool), 0
    for n in range(len(p)):
        place[at], left[at] = n, False
        if n + 1 < len(p):
            apart = np.where(left, ((p - p[at]) ** 2).sum(1), np.inf)
            at = int(apart.argmin())
    return place


def _distances(x: np.ndarray, pivots: dict[int, np.ndarray]) -> np.ndarray:
    p = pivots.get(x.shape[1])
    if p is None:  # a length that the sample has none of: one pivot, the origin
        p = np.zeros((1, x.shape[1]))
    return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (p**2).sum(1) - 2 * (x @ p.T), 0))


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, dims)


class Blocks:
    """The rows of ``df`` that have an identity and a vector of finite components, in blocks.

    Identities are cast to long. ``pivots`` of another table make both sides comparable."""

    def __init__(self, df: DataFrame, vector: str, identity: str, *, pivots: dict[int, np.ndarray] | None = None, parts: int | None = None):
        v = F.col(vector).cast("array<double>")
        finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        rows = df.where(F.col(identity).isNotNull() & (F.size(vector) > 0)).where(finite)
        rows = written(rows.select(F.col(identity).cast("long").alias("id"), v.alias("v"), F.size(vector).alias("dims")), "metric-rows")
        self.count = rows.count()
        size = min(BLOCK, max(1, -(-self.count // (parts or 1))))
        if pivots is None:
            pivots = _pivots([list(r["v"]) for r in rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("v").collect()])
        self.pivots = pivots
        order = ["dims", "cell", "apart", "id"]
        placed = rows.mapInArrow(_placer(pivots), "id long, v array<double>, dims int, cell int, apart double")
        ordered = written(placed, "metric-cells").repartitionByRange(max(1, -(-self.count // (4 * size))), *order).sortWithinPartitions(*order)
        self.blocks = written(ordered.mapInArrow(_packer(pivots, size), PACKED).withColumn("block", F.monotonically_increasing_id()), "metric-blocks")

    def meetings(self, other: Blocks | None = None) -> DataFrame:
        """a, b, upper: blocks of one length and a bound of the inner products of their rows; with
        ``other``, its blocks are b, else every two blocks come once and each block with itself."""
        salt = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        names = lambda s: [F.col(c).alias(f"{s}_{c}") for c in ("near", "far", "longest")]
        left = self.blocks.select(F.col("block").alias("a"), "dims", *names("a"), salt.alias("salt"))
        right = (other or self).blocks.select(F.col("block").alias("b"), "dims", *names("b"), F.pmod(F.xxhash64("block"), F.lit(SALTS)).cast("int").alias("salt"))
        met = left.join(right, ["dims", "salt"])
        if other is None:
            met = met.where("a <= b")
        minus = lambda x, y: x - y
        apart = F.array_max(F.zip_with(F.zip_with("a_near", "b_far", minus), F.zip_with("b_near", "a_far", minus), lambda x, y: F.greatest(x, y)))
        most = F.col("a_longest") + F.col("b_longest")
        upper = (most - F.pow(F.greatest(apart, F.lit(0.0)), F.lit(2))) / 2 + most * 1e-9
        return met.select("a", "b", upper.alias("upper"))

    def run(self, met: DataFrame, kernel: Callable, schema: str, other: Blocks | None = None, extra: DataFrame | None = None) -> DataFrame:
        """``kernel(ids, vectors, ids, vectors, same block, extra)`` for each two blocks that meet.
        ``extra``: block a and a value for it. The rows are written; a worker holds few blocks at a time."""
        side = lambda blocks, key: blocks.select(F.col("block").alias(key), F.struct("ids", "vectors").alias(f"{key}s"))
        pairs = met.select("a", "b").join(side(self.blocks, "a"), "a").join(side((other or self).blocks, "b"), "b")
        pairs = pairs.join(extra.toDF("a", "extra"), "a", "left") if extra is not None else pairs.withColumn("extra", F.lit(None).cast("binary"))
        alone = other is None

        def held(side: dict) -> tuple[np.ndarray, np.ndarray]:
            ids = np.frombuffer(side["ids"], "<i8")
            return ids, np.frombuffer(side["vectors"], "<f8").reshape(len(ids), -1)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i in range(batch.num_rows):
                    row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                    yield from kernel(*held(row["as"]), *held(row["bs"]), alone and row["a"] == row["b"], row["extra"])

        spark, key = met.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
        own = spark.conf.get(key)
        spark.conf.set(key, "2")
        try:
            return written(pairs.mapInArrow(work, schema), "metric-pairs")
        finally:
            spark.conf.set(key, own)


def _placer(pivots: dict[int, np.ndarray]) -> Callable:
    places = {dims: _places(p) for dims, p in pivots.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = batch.column("dims").to_numpy()
            for dims in np.unique(lengths).tolist():
                part = batch.filter(pa.array(lengths == dims))
                d = _distances(_matrix(part.column("v"), dims), pivots)
                nearest = d.argmin(1)
                cell = places.get(dims, np.zeros(1, np.int32))[nearest]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("v"), part.column("dims"), pa.array(cell), pa.array(d[np.arange(len(d)), nearest])], ["id", "v", "dims", "cell", "apart"])

    return place


def _packer(pivots: dict[int, np.ndarray], size: int) -> Callable:
    def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        lengths = table.column("dims").to_numpy()
        for dims in np.unique(lengths).tolist():
            part = table.filter(pa.array(lengths == dims)).combine_chunks()
            x, ids = _matrix(part.column("v").combine_chunks(), dims), part.column("id").to_numpy()
            for at in range(0, len(x), size):
                some = x[at : at + size]
                d = _distances(some, pivots)
                values = [[dims], [ids[at : at + size].tobytes()], [some.tobytes()], [d.min(0)[:TOLD].tolist()], [d.max(0)[:TOLD].tolist()], [float((some**2).sum(1).max())]]
                kinds = [pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.float64()), pa.list_(pa.float64()), pa.float64()]
                yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds, strict=True)], [c.split()[0] for c in PACKED.split(", ")])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            while sum(b.num_rows for b in held) >= size:
                table = pa.Table.from_batches(held)
                yield from packed(table.slice(0, size))
                held = table.slice(size).to_batches()
        if held:
            yield from packed(pa.Table.from_batches(held))

    return pack


def _pages(x: np.ndarray, pivots: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts of pages, and of each the least and largest distances to the pivots and the largest square."""
    starts = np.arange(0, len(x), PAGE)
    d = _distances(x, pivots)
    return starts, np.minimum.reduceat(d, starts), np.maximum.reduceat(d, starts), np.maximum.reduceat((x**2).sum(1), starts)


def screened(x: np.ndarray, y: np.ndarray, pivots: dict[int, np.ndarray], floor: Callable[[], float], same: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(rows of x, rows of y, exact inner products) of at least ``floor()``, which may rise meanwhile:
    pages against all pages that their pivot ranges leave room for. Of one block, each two rows once."""
    sx, near_x, far_x, most_x = _pages(x, pivots)
    sy, near_y, far_y, most_y = _pages(y, pivots)
    x32, y32 = x.astype(np.float32), y.astype(np.float32)
    unit = (x.shape[1] + 4) * 2.0**-23
    for p, at in enumerate(sx.tolist()):
        apart = np.maximum(0, np.maximum(near_x[p] - far_y, near_y - far_x[p]).max(1))
        most = most_x[p] + most_y
        upper = (most - apart**2) / 2 + most * 1e-9
        pages = np.flatnonzero(upper >= floor())
        if same:
            pages = pages[pages >= p]
        if not len(pages):
            continue
        cols = np.concatenate([np.arange(sy[q], min(sy[q] + PAGE, len(y))) for q in pages.tolist()])
        score = x32[at : at + PAGE] @ y32[cols].T
        error = unit * np.sqrt(most_x[p] * most_y.max())
        i, j = np.nonzero(score >= floor() - error)
        i, j = i + at, cols[j]
        if same:
            keep = i < j
            i, j = i[keep], j[keep]
        exact = np.concatenate([similarity(x[i[k : k + 65536]], y[j[k : k + 65536]]) for k in range(0, len(i), 65536)]) if len(i) else np.zeros(0)
        keep = exact >= floor()
        yield i[keep], j[keep], exact[keep]


def _ends(ids: np.ndarray, i: np.ndarray, others: np.ndarray, j: np.ndarray, s: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    l, r = np.minimum(ids[i], others[j]), np.maximum(ids[i], others[j])
    keep = l != r
    return l[keep], r[keep], s[keep]


PAIRS = "left_id long, right_id long, cosine double"


def similar_pairs(held: Blocks, least: float) -> DataFrame:
    """PAIRS with an inner product of at least ``least``, each once."""
    pivots = held.pivots

    def kernel(ids, x, others, y, same, _):
        for i, j, s in screened(x, y, pivots, lambda: least, same):
            l, r, s = _ends(ids, i, others, j, s)
            if len(l):
                yield pa.RecordBatch.from_arrays([pa.array(l), pa.array(r), pa.array(s)], ["left_id", "right_id", "cosine"])

    met = held.meetings()
    return held.run(met.where(F.col("upper") >= least) if np.isfinite(least) else met, kernel, PAIRS)


def best_pairs(held: Blocks, best: int, least: float = float("-inf")) -> DataFrame:
    """The ``best`` most similar pairs, ties to the smaller identities. Each block alone comes first; what they
    have sets what two blocks must promise to meet."""
    pivots = held.pivots

    def kernel_from(floor: float) -> Callable:
        def kernel(ids, x, others, y, same, _):
            l, r, s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
            now = lambda: s[-1] if len(s) == best else floor
            for i, j, found in screened(x, y, pivots, now, same):
                a, b, c = _ends(ids, i, others, j, found)
                if len(c) > 4 * best:  # as many as can matter, and all ties with the last
                    few = c >= np.partition(c, -best)[-best]
                    a, b, c = a[few], b[few], c[few]
                l, r, s = np.append(l, a), np.append(r, b), np.append(s, c)
                first = np.lexsort((r, l, -s))[:best]
                l, r, s = l[first], r[first], s[first]
            yield pa.RecordBatch.from_arrays([pa.array(l), pa.array(r), pa.array(s)], ["left_id", "right_id", "cosine"])

        return kernel

    met = written(held.meetings(), "metric-meetings")
    order = [F.desc("cosine"), "left_id", "right_id"]
    alone = held.run(met.where("a = b"), kernel_from(least), PAIRS)
    floor = alone.orderBy(*order).limit(best).agg(F.count("*"), F.min("cosine")).first()
    least = max(least, floor[1]) if floor[0] == best else least
    rest = met.where("a <> b")
    more = held.run(rest.where(F.col("upper") >= least) if np.isfinite(least) else rest, kernel_from(least), PAIRS)
    return alone.unionByName(more).orderBy(*order).limit(best)


def banded_pairs(held: Blocks, bands: list[tuple[str, float, float, int]], rank: Callable[[str, int, int], str]) -> DataFrame:
    """PAIRS, band and h: of each band (name, from, below, number) the ``number`` pairs of the least
    ``rank(band, left, right)``, in hex. Each two blocks give no more than that, so rows follow blocks, not pairs."""
    pivots, low = held.pivots, min(b[1] for b in bands)

    def kernel(ids, x, others, y, same, _):
        first: dict[str, list] = {b[0]: [] for b in bands}
        for i, j, s in screened(x, y, pivots, lambda: low, same):
            l, r, s = _ends(ids, i, others, j, s)
            left = np.ones(len(s), bool)
            for name, start, end, number in bands:
                of = np.flatnonzero(left & (s >= start) & (s < end))
                left[of] = False
                some = [(rank(name, a, b), a, b, c) for a, b, c in zip(l[of].tolist(), r[of].tolist(), s[of].tolist(), strict=True)]
                first[name] = sorted(first[name] + some)[:number]
        rows = [(a, b, c, name, h) for name, some in first.items() for h, a, b, c in some]
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["left_id", "right_id", "cosine", "band", "h"])

    return held.run(held.meetings().where(F.col("upper") >= low), kernel, f"{PAIRS}, band string, h string")


def _raise(found: np.ndarray, x: np.ndarray, y: np.ndarray, pivots: dict[int, np.ndarray]) -> None:
    """``found``, the largest inner products of x so far, with those of y."""
    sx, near_x, far_x, most_x = _pages(x, pivots)
    sy, near_y, far_y, most_y = _pages(y, pivots)
    x32, y32 = x.astype(np.float32), y.astype(np.float32)
    unit = (x.shape[1] + 4) * 2.0**-23
    for p, at in enumerate(sx.tolist()):
        rows = slice(at, at + PAGE)
        apart = np.maximum(0, np.maximum(near_x[p] - far_y, near_y - far_x[p]).max(1))
        most = most_x[p] + most_y
        pages = np.flatnonzero((most - apart**2) / 2 + most * 1e-9 >= found[rows].min())
        if not len(pages):
            continue
        cols = np.concatenate([np.arange(sy[q], min(sy[q] + PAGE, len(y))) for q in pages.tolist()])
        score = x32[rows] @ y32[cols].T
        error = unit * np.sqrt(most_x[p] * most_y.max())
        floor = np.maximum(score.max(1) - 2 * error, found[rows] - error)
        i, j = np.nonzero(score >= floor[:, None])
        np.maximum.at(found, i + at, similarity(x[i + at], y[cols[j]]))


def nearest(asks: Blocks, known: Blocks) -> DataFrame:
    """id and similarity: each asking row's largest inner product with the known ones of its length. A block first
    meets the block that promises most; the others only if they promise more than its least row has."""
    pivots = known.pivots

    def kernel(ids, x, others, y, same, extra):
        found = np.frombuffer(extra, "<f8").copy() if extra is not None else np.full(len(ids), -np.inf)
        _raise(found, x, y, pivots)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(found)], ["id", "similarity"])

    met = written(asks.meetings(known), "metric-meetings")
    home = met.groupBy("a").agg(F.max_by("b", F.struct("upper", F.col("b"))).alias("b"))
    first = asks.run(home, kernel, "id long, similarity double", known)
    floors = asks.blocks.select("block", "ids").mapInArrow(_members, "block long, at int, id long").join(first.groupBy("id").agg(F.max("similarity").alias("s")), "id")
    packed = floors.groupBy("block").agg(F.array_sort(F.collect_list(F.struct("at", "s"))).alias("m"), F.min("s").alias("least"))
    packed = written(packed.select("block", "least", F.transform("m", lambda x: x["s"]).alias("m")).mapInArrow(_bytes, "block long, least double, floors binary"), "metric-floors")
    rest = met.join(home, ["a", "b"], "left_anti").join(packed.select(F.col("block").alias("a"), "least"), "a").where(F.col("upper") >= F.col("least"))
    more = asks.run(rest, kernel, "id long, similarity double", known, packed.select("block", "floors"))
    return first.unionByName(more).groupBy("id").agg(F.max("similarity").alias("similarity"))


def _members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            ids = np.frombuffer(batch.column("ids")[i].as_py(), "<i8")
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), batch.column("block")[i].as_py())), pa.array(np.arange(len(ids), dtype=np.int32)), pa.array(ids)], ["block", "at", "id"])


def _bytes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = pa.array([np.array(m, "<f8").tobytes() for m in batch.column("m").to_pylist()], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("least"), raw], ["block", "least", "floors"])


def met_share(held: Blocks, least: float) -> tuple[float, float]:
    """Shares of the pairs of blocks, and of the pairs of pages in them, that can hold a similarity of ``least``."""
    met = held.meetings()
    pivots = held.pivots

    def kernel(ids, x, others, y, same, _):
        _, near_x, far_x, most_x = _pages(x, pivots)
        _, near_y, far_y, most_y = _pages(y, pivots)
        apart = np.maximum(0, np.maximum(near_x[:, None] - far_y[None], near_y[None] - far_x[:, None]).max(2))
        most = most_x[:, None] + most_y[None]
        fit = (most - apart**2) / 2 + most * 1e-9 >= least
        yield pa.RecordBatch.from_arrays([pa.array([int(fit.sum())]), pa.array([fit.size])], ["met", "every"])

    near = met.where(F.col("upper") >= least)
    pages = held.run(met, kernel, "met long, every long").agg(F.sum("met"), F.sum("every")).first()
    return near.count() / max(1, met.count()), (pages[0] or 0) / max(1, pages[1] or 1)
