"""Selections whose choices depend on earlier ones, over tables of any size.

Each choice is the least row of an order that only moves one way: similarity to what is chosen can
only grow, and a row that is ruled out stays so. So a scan brings the driver the
first rows of every partition and, as a bound, the first row of those that stay behind. The driver
goes on choosing among the rows it has as long as the next one lies before the bound, which makes
the choice the whole table's; then comes another scan, with what was chosen since. Scans keep no
state: a lost executor costs its tasks. What the driver holds follows the choices asked for and
``HELD``, not the table.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.scalars import hash_bits, stable_rank
from sieveline.operators.joins import nearest_existing
from sieveline.session import written

#: Rows that a scan brings, about: each partition's part of them, but ``LEAST`` at least.
HELD, LEAST = 20_000, 8


def similarity(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Inner products of rows with one vector; a row's doesn't depend on the rows beside it, so
    copies are equal to the last bit in every scan."""
    return (x * c).sum(axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


def _share(rows: DataFrame) -> int:
    return max(LEAST, HELD // max(1, rows.rdd.getNumPartitions()))


class Farthest:
    """Farthest-first choices, one after another, within each key.

    rows: id, key (string), v, g (group), s (stratum), r (rank), base (similarity to what there was
    before), used (rows of the group that count already), and more columns that come with a choice.
    ``cap``: rows of a group; ``room``: rows of a stratum. ``scans`` counts the passes over the table.
    """

    def __init__(self, rows: DataFrame, cap: int | None = None, room: dict[str, int] | None = None):
        self.rows = written(rows, "diverse")
        self.share = _share(self.rows)
        self.cap, self.room = cap, None if room is None else dict(room)
        self.picks: dict[str, list] = defaultdict(list)
        self.compared: dict[str, list[np.ndarray]] = defaultdict(list)
        self.used: dict[str, Counter] = defaultdict(Counter)
        self.scans = 0

    def _open(self, key: str, row) -> bool:
        if self.room is not None and self.room.get(row["s"], 0) <= 0:
            return False
        return self.cap is None or row["used"] + self.used[key][row["g"]] < self.cap

    def _scan(self, want: Column | None, done: set[str]) -> dict[str, tuple[list, tuple | None]]:
        self.scans += 1
        share, cap, schema = self.share, self.cap, self.rows.schema
        compared = {k: np.stack(v) for k, v in self.compared.items() if v}
        chosen = {k: {p["id"] for p in v} for k, v in self.picks.items()}
        used = {k: dict(v) for k, v in self.used.items()}
        closed = None if self.room is None else {s for s, n in self.room.items() if n > 0}
        names = [*schema.names, "closest", "last"]

        def first(held: pa.Table, last: bool) -> pa.Table:
            order = np.lexsort((held.column("r").to_numpy(zero_copy_only=False).astype(str), held.column("closest").to_numpy()))
            kept = held.take(pa.array(order[: share + 1]))
            return kept if not last else kept.drop_columns("last").append_column("last", pa.array(np.arange(len(kept)) == share))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[str, pa.Table] = {}
            for batch in batches:
                keys = batch.column("key").to_numpy(zero_copy_only=False)
                for key in set(keys.tolist()):
                    part = batch.filter(pa.array(keys == key))
                    out = chosen.get(key, ())
                    mine = used.get(key, {})
                    keep = np.array([i not in out and (cap is None or u + mine.get(g, 0) < cap) and (closed is None or s in closed) for i, g, s, u in zip(*[part.column(c).to_pylist() for c in ("id", "g", "s", "used")], strict=True)], bool)
                    part = part.filter(pa.array(keep))
                    if not part.num_rows:
                        continue
                    x, closest = _matrix(part.column("v")), part.column("base").to_numpy()
                    for c in compared.get(key, ()):
                        closest = np.maximum(closest, similarity(x, c))
                    table = pa.Table.from_batches([part]).append_column("closest", pa.array(closest)).append_column("last", pa.array(np.zeros(len(closest), bool)))
                    held[key] = first(pa.concat_tables([held[key], table]) if key in held else table, False)
            for table in held.values():
                yield from first(table, True).combine_chunks().to_batches()

        source = self.rows if want is None else self.rows.where(want)
        if done:
            source = source.where(~F.col("key").isin(*done))
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        found = source.mapInArrow(run, f"{kinds}, closest double, last boolean").select(*names).collect()
        pools: dict[str, tuple[list, tuple | None]] = {}
        for row in found:
            some, bound = pools.get(row["key"], ([], None))
            if row["last"]:
                here = (row["closest"], row["r"])
                bound = here if bound is None else min(bound, here)
            else:
                some.append(row)
            pools[row["key"]] = (some, bound)
        return pools

    def run(self, enough: Callable[[str], bool], want: Column | None = None, added: Callable[[object], None] = lambda row: None) -> None:
        """Choose among the rows that ``want`` holds for until ``enough`` or nothing is left."""
        done: set[str] = {k for k in self.picks if enough(k)}
        while True:
            pools = self._scan(want, done)
            if not pools:
                return
            for key, (rows, bound) in pools.items():
                if rows:
                    self._take(key, rows, bound, enough, added)
                if enough(key) or bound is None:
                    done.add(key)
            if done.issuperset(pools):
                return

    def _take(self, key: str, rows: list, bound: tuple | None, enough, added) -> None:
        x = np.array([r["v"] for r in rows])
        closest = np.array([r["closest"] for r in rows])
        ranks = np.array([r["r"] for r in rows])
        place = np.empty(len(rows), np.int64)
        place[np.argsort(ranks, kind="stable")] = np.arange(len(rows))
        free = np.ones(len(rows), bool)
        while not enough(key):
            at = np.flatnonzero(free)
            if not len(at):
                return
            least = at[closest[at] == closest[at].min()]
            best = int(least[np.argmin(place[least])])
            if bound is not None and (closest[best], rows[best]["r"]) >= bound:
                return
            free[best] = False
            if not self._open(key, rows[best]):
                continue
            self.picks[key].append(rows[best])
            self.compared[key].append(x[best])
            self.used[key][rows[best]["g"]] += 1
            if self.room is not None:
                self.room[rows[best]["s"]] -= 1
            added(rows[best])
            closest = np.maximum(closest, similarity(x, x[best]))


def _rows(pool: DataFrame, vector: str, identity: str, *, key: Column | None = None, group: str | None = None, stratum: str | None = None, seeds: DataFrame | None = None, excluded: DataFrame | None = None, more: dict[str, Column] | None = None) -> DataFrame:
    """What ``Farthest`` takes. Rows without a vector take no part. ``seeds``: vectors that there
    were before; ``excluded``: rows (identity, group) that aren't chosen and count for their group."""
    if excluded is not None:
        pool = pool.join(excluded.select(identity), identity, "left_anti")
    g = F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit("")
    rows = pool.where(F.col(vector).isNotNull()).select(
        F.col(identity).alias("id"), (F.lit("") if key is None else key).alias("key"), F.col(vector).cast("array<double>").alias("v"), g.alias("g"),
        (F.coalesce(F.col(stratum).cast("string"), F.lit("")) if stratum else F.lit("")).alias("s"), stable_rank(identity).alias("r"), *[c.alias(n) for n, c in (more or {}).items()],
    )
    none = F.lit(float("-inf"))
    if seeds is not None:
        near = nearest_existing(rows, seeds.select(F.col(vector).alias("v")), "v", "id")
        rows = rows.join(near.withColumnRenamed("similarity", "base"), "id").withColumn("base", F.coalesce("base", none))
    else:
        rows = rows.withColumn("base", none)
    if excluded is not None and group:
        used = excluded.groupBy(F.coalesce(F.col(group).cast("string"), F.lit("")).alias("g")).agg(F.count("*").alias("used"))
        return rows.join(used, "g", "left").withColumn("used", F.coalesce("used", F.lit(0)).cast("long"))
    return rows.withColumn("used", F.lit(0).cast("long"))


def _short(have: int, wanted: int, what: str) -> None:
    if have < wanted:
        raise ValueError(f"{what}: {have} of {wanted}")


def diverse(
    pool: DataFrame, vector: str, identity: str, count: int, *, group: str | None = None, cap: int | None = None, by: list[str] | None = None,
    seeds: DataFrame | None = None, excluded: DataFrame | None = None, shortfall: bool = True,
) -> DataFrame:
    """The ``by`` columns, identity and position of ``count`` rows chosen one after another, within each
    value of ``by``: the row whose largest similarity to all chosen, and to ``seeds``, is least,
    ties by stable hash; the first by hash alone. A group gives ``cap`` rows at most, those of
    ``excluded`` (identity and group) counted. Without ``shortfall`` too few rows are an error.

    Identities are unique. Rows without a vector take no part; null groups are the blank one. The result, as many rows as are
    chosen, goes through the driver.
    """
    spark, keys = pool.sparkSession, by or []
    kinds = dict(pool.dtypes)
    key = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in keys]) if keys else None
    search = Farthest(_rows(pool, vector, identity, key=key, group=group, seeds=seeds, excluded=excluded, more={f"by_{c}": F.col(c) for c in keys}), cap if group else None)
    search.run(lambda k: len(search.picks[k]) >= count)
    if not shortfall:
        for k in search.picks or {"": []}:
            _short(len(search.picks[k]), count, f"rows{f' of {k}' * bool(k)}")
    found = [(*[p[f"by_{c}"] for c in keys], p["id"], n) for picks in search.picks.values() for n, p in enumerate(picks, 1)]
    return spark.createDataFrame(found, ", ".join([*[f"{c} {kinds[c]}" for c in keys], f"{identity} {kinds[identity]}", "position long"]))


def diverse_by_quota(pool: DataFrame, identity: str, vector: str, group: str, stratum: str, features: str, *, minimums: list[tuple[str, int]], strata: dict[str, int], cap: int) -> DataFrame:
    """identity, stratum and position: diverse rows that meet feature minimums in order, then fill
    the strata. A row counts for each of its features; a stratum takes its number and no more."""
    search = Farthest(_rows(pool, vector, identity, group=group, stratum=stratum, more={"features": F.col(features)}), cap, strata)
    have: Counter = Counter()
    count = lambda row: have.update(set(row["features"] or ()))
    for feature, least in minimums:
        if have[feature] < least:
            search.run(lambda _, f=feature, n=least: have[f] >= n, F.array_contains("features", feature), count)
    for name in strata:
        if search.room[name] > 0:
            search.run(lambda _, n=name: search.room[n] <= 0, F.col("s") == name, count)
    found = [(p["id"], p["s"], n) for n, p in enumerate(search.picks[""], 1)]
    return pool.sparkSession.createDataFrame(found, f"{identity} {dict(pool.dtypes)[identity]}, stratum string, position long")


def diverse_by_category(
    pool: DataFrame, identity: str, vector: str, group: str, *, categories: list[tuple[str, Column, int]], fill: tuple[str, Column] | None = None, total: int | None = None,
    cap: int | None = None, seeds: DataFrame | None = None, most: float | None = None,
) -> DataFrame:
    """identity, category and position: each category in turn takes its quota of the rows that its
    condition holds for, diverse against what was chosen before, or against ``seeds`` as long as
    nothing was; a category may fall short. Then ``fill`` takes rows up to ``total``, or it is an error. Rows with a similarity
    of ``most`` or more to a seed take no part."""
    conditions = {f"is_{i}": c for i, (_, c, _) in enumerate(categories)}
    if fill is not None:
        conditions["is_fill"] = fill[1]
    rows = _rows(pool, vector, identity, group=group, seeds=seeds, more={n: F.coalesce(c, F.lit(False)) for n, c in conditions.items()})
    if most is not None:
        rows = rows.where(F.col("base") < most)
    search = Farthest(rows, cap)
    named: list[str] = []

    def take(name: str, flag: str, number: int) -> None:
        if search.picks[""] and named and seeds is not None:
            search.rows = search.rows.withColumn("base", F.lit(float("-inf")))  # from here on only the chosen count
        goal = len(named) + number
        if number > 0:
            search.run(lambda _: len(search.picks[""]) >= goal, F.col(flag))
        named.extend([name] * (len(search.picks[""]) - len(named)))

    for i, (name, _, quota) in enumerate(categories):
        take(name, f"is_{i}", quota)
    if fill is not None:
        take(fill[0], "is_fill", (total or 0) - len(named))
        _short(len(named), total or 0, "rows")
    found = [(p["id"], c, n) for n, (p, c) in enumerate(zip(search.picks[""], named, strict=True), 1)]
    return pool.sparkSession.createDataFrame(found, f"{identity} {dict(pool.dtypes)[identity]}, category string, position long")


def _near_vectors(least: float) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    return lambda x, c: similarity(x, c) >= least


def _near_hashes(most: int) -> Callable[[np.ndarray, np.ndarray], np.ndarray]:
    return lambda x, c: np.bitwise_count(x ^ c) <= most


class Admission:
    """Rows in a given order, each included unless a limit or an included row near it speaks against it.

    rows: id, v (array of doubles, or a long of 64 bits), g, s, o (struct that sorts), near (near
    something that there was before). Included rows are ``maximum`` at most, so they are what tasks
    are told; every scan passes over rows that these rule out."""

    def __init__(self, rows: DataFrame, near: Callable, *, group_cap: int, site_cap: int, maximum: int, order: str):
        self.rows, self.near = written(rows, "admission"), near
        self.share = _share(self.rows)
        self.group_cap, self.site_cap, self.maximum, self.order = group_cap, site_cap, maximum, order.split("-")
        self.included: list = []
        self.groups, self.sites = Counter(), Counter()
        self.scans = 0
        self.hashes = dict(rows.dtypes)["v"] == "bigint"

    def _values(self) -> Callable[[pa.Array], np.ndarray]:
        if self.hashes:
            return lambda column: column.to_numpy().view(np.uint64)
        return _matrix

    def _scan(self, after: tuple | None) -> tuple[list, tuple | None]:
        self.scans += 1
        share, near, values = self.share, self.near, self._values()
        kept = [np.uint64(np.int64(r["v"]).view(np.uint64)) if self.hashes else np.array(r["v"]) for r in self.included]
        full_groups = {g for g, n in self.groups.items() if n >= self.group_cap}
        full_sites = {s for s, n in self.sites.items() if n >= self.site_cap} if "site" in self.order else set()
        fields = self.rows.schema.names

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: list[tuple[tuple, dict]] = []
            for batch in batches:
                orders = [tuple(o.values()) for o in batch.column("o").to_pylist()]
                free = np.array([(after is None or o >= after) and g not in full_groups and s not in full_sites for o, g, s in zip(orders, batch.column("g").to_pylist(), batch.column("s").to_pylist(), strict=True)], bool) & ~batch.column("near").to_numpy(zero_copy_only=False).astype(bool)
                at = np.flatnonzero(free)
                if not len(at):
                    continue
                x = values(batch.column("v").take(pa.array(at)))
                apart = np.ones(len(at), bool)
                for c in kept:
                    apart &= ~near(x, c)
                at = at[apart].tolist()
                if len(at) > share:
                    at = sorted(at, key=orders.__getitem__)[: share + 1]
                held += [(orders[i], {c: batch.column(c)[i].as_py() for c in fields}) for i in at]
                held = sorted(held, key=lambda h: h[0])[: share + 1]
            if held:
                table = pa.Table.from_pylist([{**row, "last": n == share} for n, (_, row) in enumerate(held)], schema=batch.schema.append(pa.field("last", pa.bool_())))
                yield from table.to_batches()

        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.rows.schema)
        rows, bound = [], None
        for row in self.rows.mapInArrow(run, f"{kinds}, last boolean").collect():
            if row["last"]:
                bound = tuple(row["o"]) if bound is None else min(bound, tuple(row["o"]))
            else:
                rows.append(row)
        return sorted(rows, key=lambda r: tuple(r["o"])), bound

    def run(self) -> None:
        after = None
        while len(self.included) < self.maximum:
            rows, bound = self._scan(after)
            now = len(self.included)
            for row in rows:
                if bound is not None and tuple(row["o"]) >= bound or len(self.included) >= self.maximum:
                    break
                if self.groups[row["g"]] >= self.group_cap or "site" in self.order and self.sites[row["s"]] >= self.site_cap:
                    continue
                x = np.array([row["v"]], np.int64).view(np.uint64) if self.hashes else np.array([row["v"]])
                others = [np.uint64(np.int64(r["v"]).view(np.uint64)) if self.hashes else np.array(r["v"]) for r in self.included[now:]]
                if any(self.near(x, c)[0] for c in others):
                    continue
                self.included.append(row)
                self.groups[row["g"]] += 1
                self.sites[row["s"]] += 1
            if bound is None:
                return
            after = bound

    def decisions(self, kind: str, identity: str) -> DataFrame:
        """identity and decision of every row: included, or the first reason that holds where its turn comes."""
        kept = sorted(self.included, key=lambda r: tuple(r["o"]))
        orders = [tuple(r["o"]) for r in kept]
        vectors = [np.uint64(np.int64(r["v"]).view(np.uint64)) if self.hashes else np.array(r["v"]) for r in kept]
        places: dict[str, dict[str, list[int]]] = {"g": defaultdict(list), "s": defaultdict(list)}
        for n, r in enumerate(kept):
            for c in places:
                places[c][r[c]].append(n)
        places = {c: dict(p) for c, p in places.items()}
        caps = {"g": self.group_cap, "s": self.site_cap}
        near, values, reasons, maximum = self.near, self._values(), self.order, self.maximum

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                own = [tuple(o.values()) for o in batch.column("o").to_pylist()]
                before = np.array([bisect_left(orders, o) for o in own], np.int64)
                is_in = np.array([b < len(orders) and orders[b] == o for b, o in zip(before, own, strict=True)], bool)
                fails = {"capacity": before >= maximum, "near": batch.column("near").to_numpy(zero_copy_only=False).astype(bool).copy()}
                for name, c in (("group", "g"), ("site", "s")):
                    fails[name] = np.array([bisect_left(places[c].get(v, ()), b) >= caps[c] for v, b in zip(batch.column(c).to_pylist(), before.tolist(), strict=True)], bool)
                x = values(batch.column("v")) if batch.num_rows else None
                for n, v in enumerate(vectors):
                    fails["near"] |= (before > n) & near(x, v)
                said = np.full(batch.num_rows, "included", object)
                for reason in reversed(reasons):
                    said[fails[reason] & ~is_in] = reason
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(said, pa.string())], [identity, "decision"])

        return self.rows.mapInArrow(run, f"{identity} {kind}, decision string")


def admitted(
    pool: DataFrame, identity: str, vector: str, group: str, site: str, position: list[Column], *, most: float, group_cap: int, site_cap: int, maximum: int,
    existing: DataFrame | None = None, order: str = "capacity-site-group-near",
) -> DataFrame:
    """identity and decision of every row, decided in the order of ``position`` (ascending, ties by
    stable hash): ``included``, or the first of the reasons in ``order`` that holds when its turn comes.
    near: a similarity of ``most`` or more to a row of ``existing`` or to one included before. Any
    number of rows; included ones, ``maximum`` at most, go through the driver. Rows without a vector have no decision."""
    held = pool.where(F.col(vector).isNotNull())
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = held.select(F.col(identity).alias("id"), F.col(vector).cast("array<double>").alias("v"), text(group).alias("g"), text(site).alias("s"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*position, stable_rank(identity)])]).alias("o"))
    if existing is not None:
        near = nearest_existing(rows, existing.select(F.col(vector).alias("v")), "v", "id")
        rows = rows.join(near, "id").withColumn("near", F.coalesce(F.col("similarity") >= most, F.lit(False))).drop("similarity")
    else:
        rows = rows.withColumn("near", F.lit(False))
    search = Admission(rows, _near_vectors(most), group_cap=group_cap, site_cap=site_cap, maximum=maximum, order=order)
    search.run()
    return search.decisions(dict(pool.dtypes)[identity], identity)


def admitted_by_hash(rows: DataFrame, identity: str, bits: str, group: str, site: str, position: list[Column], *, most: int, group_cap: int, maximum: int, minimum_sites: int = 0, order: str = "capacity-group-near") -> DataFrame:
    """As ``admitted``, with near a Hamming distance of ``most`` bits of a long, and without a limit of
    sites. Fewer sites than ``minimum_sites`` among the included are an error, unless there are no rows."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    held = rows.where(F.col(bits).isNotNull()).select(F.col(identity).alias("id"), F.col(bits).alias("v"), text(group).alias("g"), text(site).alias("s"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*position, stable_rank(identity)])]).alias("o"), F.lit(False).alias("near"))
    search = Admission(held, _near_hashes(most), group_cap=group_cap, site_cap=0, maximum=maximum, order=order)
    search.run()
    if search.included:
        _short(len({r["s"] for r in search.included}), minimum_sites, "sites in the queue")
    return search.decisions(dict(rows.dtypes)[identity], identity)


def validation_queue(pool: DataFrame, identity: str, phash: str, group: str, site: str, confidence: str, small: str, *, most: int, group_cap: int, site_cap: int, maximum: int, minimum_sites: int = 0) -> DataFrame:
    """identity and decision of each site's first ``site_cap`` rows by confidence, small boxes and
    stable hash, decided round by round over the sites: see ``admitted_by_hash``. phash: 16 hexadecimal
    digits; rows without one take no part. A null site is a site."""
    first = Window.partitionBy(site).orderBy(F.desc(confidence), F.desc(small), stable_rank(identity))
    rows = pool.withColumns({"_bits": hash_bits(F.col(phash)), "_t": F.row_number().over(first)}).where(F.col("_t") <= site_cap)
    return admitted_by_hash(rows, identity, "_bits", group, site, [F.col("_t"), -F.col(confidence)], most=most, group_cap=group_cap, maximum=maximum, minimum_sites=minimum_sites)
