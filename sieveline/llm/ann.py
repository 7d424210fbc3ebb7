"""Approximate nearest neighbours by largest inner product, over balanced posting lists.

Equal vectors are made one class first; a class keeps its smallest ids, as many
as any answer can use, so that a vector that a third of the rows share is one
entry. Vectors get one more component that makes all norms equal, which turns
the largest inner product into the least distance.

Centroids come from balanced hierarchical k-means over a bounded sample; there is
one for every ``LIST_SIZE`` vectors, so lists keep their size as the table grows, up
to a fourth of the largest sample (``SAMPLE_BYTES``; at 64 dimensions 65,000 lists
for 8 million vectors, beyond which lists grow). A vector near a boundary is put
on several lists: those nearly as near as the nearest, unless a centroid chosen
before is much nearer to theirs; how near is set so that ``REPLICATED`` of the
sample is near a boundary. A graph over the centroids, held in memory, is searched
best-first with a bounded pool, from the nearest groups of centroids, for the lists
of a vector or a query. A query reads
the lists whose distance is within a ratio of the nearest list's; its pool is
widened until it ends beyond that ratio. The ratio is the one that reaches
``TARGET`` recall for sampled queries against brute force on the sample.

Lists that lie near each other share shards of bounded size (a larger list has
several); a shard meets the queries that read it, and only a shard that many
read is repeated, once for each block of its queries. A window over the query
merges the shards' best few classes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import stored

#: Vectors of the sample, at least (if there are as many) and at most.
SAMPLE, SAMPLE_BYTES = 20_000, 128 << 20
LIST_SIZE, PER_LIST = 128, 4
BRANCHES = 16
#: Distances that rounds over the whole sample may take, after at least one.
REFINE = 400_000_000
REPLICAS, REPLICATED, APART = 3, 0.2, 0.15
DEGREE, NEAR, FAR, ENTRIES, STEP = 12, 40, 40, 3, 4
#: Pool of a vector's search for its lists.
HOMES = 12
TARGET = 0.97
SHARD, QUERY_BLOCK = 16_384, 8_192
#: Bytes of marks for the centroids that a slice of searches has seen.
SEEN = 32 << 20

ANSWERS = "query_id long, rank int, vec_id long, score double"


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    n = len(column)
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten()).reshape(n, -1).astype(np.float64) if n else np.zeros((0, 1))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T, 0)


def _refined(x: np.ndarray, c: np.ndarray, rng: np.random.Generator, rounds: int) -> np.ndarray:
    """Lloyd's rounds from c, in which a list too large is split at the cost of one too small."""
    for _ in range(rounds):
        own = np.concatenate([squared(x[a : a + 1024], c).argmin(1) for a in range(0, len(x), 1024)])
        n = np.bincount(own, minlength=len(c))
        order = np.argsort(own, kind="stable")
        filled = np.flatnonzero(n)
        c = c.copy()
        c[filled] = np.add.reduceat(x[order], (np.cumsum(n) - n)[filled], axis=0) / n[filled, None]
        mean = len(x) / len(c)
        large, small = np.flatnonzero(n > 2 * mean), np.flatnonzero(n < mean / 4)
        for j, i in zip(large[np.argsort(-n[large])].tolist(), small.tolist()):
            members = x[own == j]
            a = members[rng.integers(len(members))]
            b = members[squared(a[None], members)[0].argmax()]
            side = squared(members, np.stack([a, b])).argmin(1) == 0
            if side.any() and not side.all():
                c[i], c[j] = members[side].mean(0), members[~side].mean(0)
    return c


def _balanced(x: np.ndarray, count: int, rng: np.random.Generator) -> np.ndarray:
    """``count`` centroids: x is split in at most BRANCHES parts, each part in turn by its share
    of the rows. Centroids of a part stand together."""
    if count <= 1 or len(x) <= count:
        return x[:count] if len(x) <= count else x.mean(axis=0, keepdims=True)
    parts = _refined(x, x[rng.choice(len(x), min(count, BRANCHES), replace=False)], rng, 6)
    own = np.concatenate([squared(x[a : a + 4096], parts).argmin(1) for a in range(0, len(x), 4096)])
    n = np.bincount(own, minlength=len(parts))
    exact = n * count / len(x)
    quota = np.minimum(np.maximum(np.floor(exact).astype(int), n > 0), n)
    for j in np.argsort(quota - exact)[: max(0, count - quota.sum())]:
        quota[j] += quota[j] < n[j]
    return np.concatenate([_balanced(x[own == j], int(quota[j]), rng) for j in range(len(parts)) if quota[j]])


def _graph(c: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Each centroid's links, itself where it has fewer than DEGREE: of the NEAR nearest and FAR
    random others, by distance, those to which no link before is nearer (so that links lead
    in every direction and out of every cluster), and the next centroid in order."""
    count = len(c)
    own = np.arange(count)[:, None]
    nearest = [np.argpartition(squared(c[a : a + 1024], c), min(NEAR, count - 1), axis=1)[:, : NEAR + 1] for a in range(0, count, 1024)]
    options = np.concatenate([np.concatenate(nearest), rng.integers(0, count, (count, FAR))], axis=1)
    far = np.stack([((c - c[o]) ** 2).sum(axis=1) for o in options.T], axis=1)
    order = np.argsort(far, axis=1, kind="stable")
    options, far = np.take_along_axis(options, order, axis=1), np.take_along_axis(far, order, axis=1)
    links, n = np.repeat(own, DEGREE, axis=1), np.zeros(count, int)
    for o, d in zip(options.T, far.T, strict=True):
        good = (d > 0) & (n < DEGREE)
        for j in range(int(n.max(initial=0))):
            good &= (j >= n) | (((c[links[:, j]] - c[o]) ** 2).sum(axis=1) >= d)
        links[good, n[good]] = o[good]
        n += good
    return np.concatenate([links, (own + 1) % count], axis=1)


def _grouped(c: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """About as many groups of centroids as a group has members: their means, and their members (-1: no more)."""
    groups = _balanced(c, math.isqrt(len(c) - 1) + 1, rng)
    own = np.concatenate([squared(c[a : a + 1024], groups).argmin(1) for a in range(0, len(c), 1024)])
    order = np.argsort(own, kind="stable")
    n = np.bincount(own, minlength=len(groups))
    members = np.full((len(groups), int(n.max())), -1)
    members[own[order], np.arange(len(c)) - np.repeat(np.cumsum(n) - n, n)] = order
    return groups, members


@dataclass
class Lists:
    """Centroids with the graph over them, and groups of them where searches begin. ``top``:
    the largest squared norm."""

    centroids: np.ndarray
    graph: np.ndarray
    groups: np.ndarray
    members: np.ndarray
    top: float
    boundary: float = 1.0
    ratio: float = 1.0
    width: int = 1

    def lifted(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([x, np.sqrt(np.maximum(self.top - (x * x).sum(1), 0))[:, None]], axis=1)

    def asked(self, q: np.ndarray) -> np.ndarray:
        """Queries among the lifted vectors. Their scale doesn't change their order."""
        y = np.concatenate([q, np.zeros((len(q), 1))], axis=1)
        return y * (np.sqrt(self.top) / np.maximum(np.linalg.norm(y, axis=1), 1e-300)[:, None])

    def entries(self, y: np.ndarray) -> tuple[np.ndarray, int]:
        """The centroids of each row's nearest groups (-1: none), and how many groups were compared."""
        near = min(ENTRIES, len(self.groups))
        first = np.argpartition(squared(y, self.groups), near - 1, axis=1)[:, :near]
        return self.members[first].reshape(len(y), -1), len(self.groups)

    def search(self, y: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ``width`` nearest centroids found for each row and their distances, in order,
        and how many centroids and groups were compared.

        Best-first from the centroids of the nearest groups: the STEP nearest of the pool
        that aren't expanded yet give their neighbours in the graph to the pool, which keeps
        ``width``, until all of the pool are expanded. Where the pool would hold a third of
        all, all are compared."""
        k = len(self.centroids)
        width = min(width, k)
        size = max(16, min(1024, SEEN // k))
        if len(y) > size:
            return tuple(np.concatenate(c) for c in zip(*[self.search(y[a : a + size], width) for a in range(0, len(y), size)], strict=True))
        n, rows = len(y), np.arange(len(y))[:, None]
        if 3 * width >= k:
            far = np.sqrt(squared(y, self.centroids))
            order = np.argsort(far, axis=1, kind="stable")[:, :width]
            return order, far[rows, order], np.full(n, k)
        light, c = y.astype(np.float32), self.centroids.astype(np.float32)
        own, norms = (y * y).sum(axis=1), (self.centroids**2).sum(axis=1)
        distance = lambda who, near: np.maximum(own[who, None] + norms[near] - 2 * np.einsum("id,ijd->ij", light[who], c[near]), 0)
        near, groups = self.entries(y)
        seen = np.zeros((n, k + 1), bool)  # the last for -1
        seen[rows, near] = True
        seen[:, k] = False
        far = np.concatenate([np.where(near >= 0, distance(np.arange(n), near), np.inf), np.full((n, width), np.inf)], axis=1)
        at = np.concatenate([near, np.full((n, width), -1)], axis=1)
        order = np.argpartition(far, width - 1, axis=1)[:, :width]
        far, at = far[rows, order], at[rows, order]
        done = ~np.isfinite(far)
        active = np.arange(n)
        step = min(STEP, width)
        while len(active):
            waiting = np.where(done[active], np.inf, far[active])
            best = np.argpartition(waiting, step - 1, axis=1)[:, :step]
            open_ = np.isfinite(np.take_along_axis(waiting, best, axis=1))
            going = open_.any(axis=1)
            active, best, open_ = active[going], best[going], open_[going]
            if not len(active):
                break
            done[active[:, None], best] = True
            near = np.where(open_[:, :, None], self.graph[at[active[:, None], best]], 0).reshape(len(active), -1)
            near.sort(axis=1)
            new = ~seen[active[:, None], near]
            new[:, 1:] &= near[:, 1:] != near[:, :-1]
            seen[active[:, None], near] = True
            reach = np.where(new, distance(active, near), np.inf)
            both = np.concatenate([far[active], reach], axis=1)
            keep = np.argpartition(both, width - 1, axis=1)[:, :width]
            take = lambda held, more: np.take_along_axis(np.concatenate([held, more], axis=1), keep, axis=1)
            far[active] = take(far[active], reach)
            at[active] = take(at[active], near)
            done[active] = take(done[active], ~new)
        far = np.where(np.isfinite(far), np.sqrt(((y[:, None, :] - self.centroids[at]) ** 2).sum(axis=2)) if width <= 64 else np.sqrt(far), np.inf)
        order = np.argsort(far, axis=1, kind="stable")
        return at[rows, order], far[rows, order], seen.sum(axis=1) + groups

    def homes(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, list) of the lists that hold each vector, the nearest first."""
        at, far, _ = self.search(self.lifted(x), HOMES)
        chosen = np.zeros(at.shape, bool)
        chosen[:, :1] = True
        for j in range(1, at.shape[1]):
            near = np.flatnonzero((far[:, j] <= self.boundary * far[:, 0]) & (chosen.sum(axis=1) < REPLICAS))
            for i in range(j):
                between = np.linalg.norm(self.centroids[at[near, j]] - self.centroids[at[near, i]], axis=1)
                near = near[~chosen[near, i] | (between >= APART * far[near, j])]
            chosen[near, j] = True
        who, which = np.nonzero(chosen)
        return who, at[who, which]

    def probes(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, list) of the lists that each query reads, and how many centroids each compared."""
        y, k = self.asked(q), len(self.centroids)
        compared = np.zeros(len(q), np.int64)
        who, lists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        left, width = np.arange(len(q)), self.width
        while len(left):
            at, far, seen = self.search(y[left], width)
            compared[left] += seen
            within = far <= self.ratio * far[:, :1] + 1e-12
            ended = ~within[:, -1] | (width >= k)
            i, j = np.nonzero(within & ended[:, None])
            who.append(left[i])
            lists.append(at[i, j])
            left, width = left[~ended], 4 * width
        return np.concatenate(who), np.concatenate(lists), compared


def fit(sample: np.ndarray, n: int, top: float, k: int) -> Lists:
    """Lists for n vectors from a sample of them, with the boundary that replicates its share
    and the ratio that finds the k nearest."""
    rng = np.random.default_rng(7)
    count = int(np.clip(n // LIST_SIZE, 1, max(1, len(sample) // PER_LIST)))
    lists = Lists(*[np.zeros((0, 0))] * 4, top)
    lifted = lists.lifted(sample)
    lists.centroids = _balanced(lifted, count, rng)
    count = len(lists.centroids)
    lists.centroids = _refined(lifted, lists.centroids, rng, min(6, max(1, REFINE // (len(sample) * count))))
    lists.graph = _graph(lists.centroids, rng)
    lists.groups, lists.members = _grouped(lists.centroids, rng)
    if count > 1:
        _, far, _ = lists.search(lists.lifted(sample[rng.choice(len(sample), min(len(sample), 2000), replace=False)]), HOMES)
        lists.boundary = float(np.quantile(far[:, 1] / np.maximum(far[:, 0], 1e-9), REPLICATED))
    asks = rng.choice(len(sample), min(len(sample), 200), replace=False)
    score = sample[asks] @ sample.T
    score[np.arange(len(asks)), asks] = -np.inf
    true = np.argsort(-score, axis=1)[:, : min(k, len(sample) - 1)]
    if count > 1 and true.size:
        far = np.sqrt(squared(lists.asked(sample[asks]), lists.centroids))
        who, at = lists.homes(sample[true.ravel()])
        needs = np.full(true.size, np.inf)
        np.minimum.at(needs, who, far[who // true.shape[1], at] / np.maximum(far.min(axis=1), 1e-9)[who // true.shape[1]])
        lists.ratio = float(np.quantile(needs, TARGET, method="higher"))
        lists.width = 1 + int(np.quantile((far <= lists.ratio * far.min(axis=1, keepdims=True)).sum(axis=1), 0.9))
    return lists


def _finite(v: Column) -> Column:
    return ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))) & F.exists(v, lambda x: x != 0)


def nearest(vectors: DataFrame, is_query: Column, *, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id and score: for each row of ``vectors`` where ``is_query``
    holds, the k rows of largest inner product found, the query's own id left out;
    ties to the smaller id.

    Null, empty and zero vectors, vectors that hold nulls or non-finite components,
    and null ids take no part. Vectors of different lengths have no product: each length
    has an index for itself, and a query's candidates are those of its length. Rows
    that repeat count once; of several vectors of an id the best score counts, over
    all of the query's vectors and lengths. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    kind = "array<float>" if dict(vectors.dtypes)[vector_col] == "array<float>" else "array<double>"
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast(kind).alias("v"), is_query.alias("asks"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & _finite(F.col("v")))
    lengths = sorted(r[0] for r in rows.select(F.size("v")).distinct().collect())
    if not lengths:
        return spark.createDataFrame([], ANSWERS)
    if len(lengths) > 1:
        rows = stored(rows, "vectors")
    found = [_answers(rows.where(F.size("v") == d) if len(lengths) > 1 else rows, d, kind, k) for d in lengths]
    each = reduce(DataFrame.unionByName, found)
    if len(found) > 1:
        each = each.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    by_query = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(by_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _answers(rows: DataFrame, dims: int, kind: str, k: int) -> DataFrame:
    """query_id, vec_id and score of the nearest found, among them the k nearest, for rows (id, v, asks) of one length."""
    spark = rows.sparkSession
    alike = Window.partitionBy("v").orderBy("id")
    classes = rows.select("id", "v").withColumn("r", F.dense_rank().over(alike)).where(F.col("r") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_set("id")).alias("ids"))
    # a class is named by its least id, and by a hash where ids have several vectors
    classes = stored(classes.select(F.xxhash64("v").alias("cid"), "ids", "v"), "classes")
    norm = F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    n, top = classes.agg(F.count("*"), F.max(norm)).first()
    bound = max(1, min(max(SAMPLE, PER_LIST * (n // LIST_SIZE)), SAMPLE_BYTES // (8 * dims)))
    sample = matrix(classes.orderBy("cid").limit(bound).select("v").toArrow().column("v"))
    shared = spark.sparkContext.broadcast(fit(sample, n, top, k))

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, lists = shared.value.homes(matrix(batch.column("v")))
            out = batch.take(pa.array(who))
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int32()), *[out.column(c) for c in ("cid", "ids", "v")]], ["list", "cid", "ids", "v"])

    postings = stored(classes.mapInArrow(post, f"list int, cid long, ids array<long>, v {kind}"), "postings")
    sizes_by_list = {r["list"]: r["count"] for r in postings.groupBy("list").count().collect()}  # a row per list
    first, blocks, shard, held = {}, {}, 0, 0
    for at in sorted(sizes_by_list):
        count = sizes_by_list[at]
        if held and held + count > SHARD:
            shard, held = shard + 1, 0
        first[at], blocks[at] = shard, -(-count // SHARD)
        if blocks[at] > 1:
            shard, held = shard + blocks[at], 0
        else:
            held += count
    where = spark.createDataFrame([(a, first[a], blocks[a]) for a in first], "list int, first int, blocks int")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            who, lists, _ = shared.value.probes(matrix(batch.column("v")))
            reads: dict[tuple[int, int], list[int]] = {}
            for i, at in zip(who.tolist(), lists.tolist(), strict=True):
                for s in range(first.get(at, 0), first.get(at, 0) + blocks.get(at, 0)):
                    reads.setdefault((i, s), []).append(at)
            out = batch.take(pa.array([i for i, _ in reads], pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([s for _, s in reads], pa.int32()), out.column("query_id"), out.column("v"), pa.array(list(reads.values()), pa.list_(pa.int32()))], ["shard", "query_id", "v", "lists"])

    asking = rows.where("asks").select(F.col("id").alias("query_id"), "v")
    asked = stored(asking.mapInArrow(ask, f"shard int, query_id long, v {kind}, lists array<int>"), "asked")
    # a shard's queries are cut in blocks by hash; the shard is repeated for each block, so with its readers
    readers = asked.groupBy("shard").agg(F.ceil(F.count("*") / QUERY_BLOCK).alias("m"))
    dealt = postings.join(F.broadcast(where), "list").select((F.col("first") + F.pmod("cid", F.col("blocks").cast("long"))).cast("int").alias("shard"), "list", "cid", "ids", "v")
    dealt = dealt.join(readers, "shard").select("shard", "list", "cid", "ids", "v", F.explode(F.sequence(F.lit(0).cast("long"), F.col("m") - 1)).alias("block"))
    cut = readers.select(F.col("shard").alias("at"), F.col("m").alias("cuts"))
    blocked = asked.join(cut, F.col("shard") == F.col("at")).select("shard", "query_id", "v", "lists", F.pmod(F.xxhash64("query_id"), F.col("cuts")).alias("block"))

    def scan(held: pa.Table, asked: pa.Table) -> pa.Table:
        least = np.array([i[0] for i in held.column("ids").to_pylist()], np.int64)
        held = held.take(np.lexsort((held.column("cid").to_numpy(), least)))  # ties go to what stands first
        least.sort()
        x, q = matrix(held.column("v")), matrix(asked.column("v"))
        slots = REPLICAS * (k + 1)  # a class is on REPLICAS lists at most
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        if len(x) and len(q):
            names, of = np.unique(held.column("list").to_numpy(), return_inverse=True)
            reads = asked.column("lists").combine_chunks()
            asks, wants = np.repeat(np.arange(len(q)), np.diff(reads.offsets.to_numpy())), np.searchsorted(names, reads.flatten().to_numpy()).clip(0, len(names) - 1)
            missed = names[wants] != reads.flatten().to_numpy()  # a list of which this shard holds nothing
            table = np.zeros((len(q), len(names)), bool)
            table[asks[~missed], wants[~missed]] = True
            # queries that begin with the same list go together, so a block reads few lists beyond each query's own
            order = np.argsort(table.argmax(axis=1), kind="stable")
            for who in np.array_split(order, -(-len(order) // 256)):
                mine = np.flatnonzero(table[who].any(axis=0)[of])
                if not len(mine):
                    continue
                score = np.where(table[who][:, of[mine]], q[who] @ x[mine].T, -np.inf)
                if len(mine) > slots:
                    keep = np.argpartition(-score, slots - 1, axis=1)[:, :slots]
                    cut = np.take_along_axis(score, keep, axis=1).min(axis=1, keepdims=True)
                    for i in np.flatnonzero(((score >= cut).sum(axis=1) > slots) & (cut[:, 0] > -np.inf)).tolist():
                        keep[i] = np.argsort(-score[i], kind="stable")[:slots]
                    i, j = np.nonzero(np.take_along_axis(score, keep, axis=1) > -np.inf)
                    found.append((who[i], mine[keep[i, j]]))
                else:
                    i, j = np.nonzero(score > -np.inf)
                    found.append((who[i], mine[j]))
        whom, which = (np.concatenate(c) for c in zip(*found, strict=True))
        exact = np.einsum("ij,ij->i", q[whom], x[which]) if len(whom) else np.zeros(0)
        order = np.lexsort((which, -exact, whom))
        whom, which, exact = whom[order], which[order], exact[order]
        again = np.zeros(len(whom), bool)
        cid = held.column("cid").to_numpy()
        for back in range(1, REPLICAS):  # copies of a class stand in a row
            again[back:] |= (whom[back:] == whom[:-back]) & (least[which[back:]] == least[which[:-back]]) & (cid[which[back:]] == cid[which[:-back]])
        whom, which, exact = whom[~again], which[~again], exact[~again]
        first = np.arange(len(whom)) - np.searchsorted(whom, whom) <= k
        return pa.table({"query_id": asked.column("query_id").take(pa.array(whom[first])), "cid": held.column("cid").take(pa.array(which[first])), "ids": held.column("ids").take(pa.array(which[first])), "score": pa.array(exact[first], pa.float64())})

    answers = dealt.groupBy("shard", "block").cogroup(blocked.groupBy("shard", "block")).applyInArrow(scan, "query_id long, cid long, ids array<long>, score double")
    by_query = Window.partitionBy("query_id")
    best = answers.withColumn("r", F.dense_rank().over(by_query.orderBy(F.desc("score"), F.col("ids")[0], "cid"))).where(F.col("r") <= k + 1)
    return best.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id").groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
