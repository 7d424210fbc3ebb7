"""Selection whose choices depend on earlier ones: numpy kernels over a bounded pool.

A pool is reduced by relational operators first; ``POOL_ROWS`` bounds what a
kernel takes, and a larger pool is an error, never a silent cut. Each kernel is a
plain function over rows, so that tests can hold it against a slow version.
"""

from __future__ import annotations

import functools
import math
from collections import Counter
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.scalars import stable_rank

#: Rows of a pool that one kernel takes.
POOL_ROWS = 200_000


def _places(ranks: list[str]) -> np.ndarray:
    """Each row's place in the order of ranks, ties by position."""
    place = np.empty(len(ranks), np.int64)
    place[np.argsort(np.array(ranks), kind="stable")] = np.arange(len(ranks))
    return place


def _coded(values: list) -> tuple[list, np.ndarray]:
    """The distinct values, and each row's number among them."""
    names: dict = {}
    code = np.fromiter((names.setdefault(v, len(names)) for v in values), np.int64, len(values))
    return list(names), code


def _farthest(free: np.ndarray, closest: np.ndarray, place: np.ndarray) -> int | None:
    """Of the rows where ``free``: the least similar to all chosen, ties by place."""
    at = np.flatnonzero(free)
    if not len(at):
        return None
    least = at[closest[at] == closest[at].min()]
    return int(least[np.argmin(place[least])])


def farthest_first(vectors: np.ndarray, ranks: list[str], count: int, *, groups: list[str] | None = None, cap: int | None = None, seeds: np.ndarray | None = None) -> list[int]:
    """Positions chosen one after another: the row whose largest similarity to all chosen
    (and to ``seeds``) is least, ties by rank; the first by rank alone. A group gives
    ``cap`` rows at most. Stops early when nothing is eligible."""
    place = _places(ranks)
    closest = (vectors @ seeds.T).max(axis=1) if seeds is not None and len(seeds) else np.full(len(ranks), -np.inf)
    names, group = _coded(groups if cap is not None else [None] * len(ranks))
    used, free = np.zeros(len(names), np.int64), np.ones(len(ranks), bool)
    chosen: list[int] = []
    while len(chosen) < count and (best := _farthest(free, closest, place)) is not None:
        chosen.append(best)
        free[best] = False
        used[group[best]] += 1
        if cap is not None and used[group[best]] >= cap:
            free &= group != group[best]
        closest = np.maximum(closest, vectors @ vectors[best])
    return chosen


def quota_selection(rows: list[dict], vectors: np.ndarray, ranks: list[str], features: list[tuple[str, int]], strata: dict[str, int], cap: int) -> list[int]:
    """Diverse rows that meet feature minimums in order, then fill strata. A row counts for
    each of its features; a stratum takes its number and no more; groups are capped."""
    place, closest = _places(ranks), np.full(len(rows), -np.inf)
    names, group = _coded([r["group"] for r in rows])
    kinds, stratum = _coded([r["stratum"] for r in rows])
    room = np.array([strata.get(k, 0) for k in kinds], np.int64)
    left = np.full(len(names), cap, np.int64)
    free, have = np.ones(len(rows), bool), Counter()
    chosen: list[int] = []

    def add(want: np.ndarray) -> bool:
        nonlocal closest
        best = _farthest(free & want & (left[group] > 0) & (room[stratum] > 0), closest, place)
        if best is None:
            return False
        chosen.append(best)
        free[best] = False
        room[stratum[best]] -= 1
        left[group[best]] -= 1
        have.update(rows[best]["features"])
        closest = np.maximum(closest, vectors @ vectors[best])
        return True

    for feature, least in features:
        holds = np.fromiter((feature in r["features"] for r in rows), bool, len(rows))
        while have[feature] < least and add(holds):
            pass
    for name, number in strata.items():
        of = np.fromiter((r["stratum"] == name for r in rows), bool, len(rows))
        filled = sum(rows[i]["stratum"] == name for i in chosen)
        while filled < number and add(of):
            filled += 1
    return chosen


def rarest_first(rows: list[dict], ranks: list[str], targets: dict[str, int], total: int, *, smallest: int = 0, side_most: float = 0.0, negatives: int = 0, frames: dict[str, int] | None = None) -> list[int]:
    """Positive rows for each class, rarest first, in rank order until the class' count reaches
    its target (the test follows an addition); by rank up to ``total``; then ``smallest`` more,
    of the least sides up to ``side_most``; then the first ``negatives`` of the other rows
    (``negative`` true). Whatever falls short is an error. ``frames`` counts the positive rows of
    each class where ``rows`` are only some of them."""
    order = sorted((i for i in range(len(rows)) if not rows[i].get("negative")), key=lambda i: ranks[i])
    frames = Counter(c for i in order for c in set(rows[i]["classes"])) if frames is None else frames
    chosen: list[int] = []
    taken: set[int] = set()
    counts: Counter = Counter()

    def enough(what: str, have: int, wanted: int) -> None:
        if have < wanted:
            raise ValueError(f"{what}: {have} of {wanted}")

    def take(more: list[int]) -> None:
        chosen.extend(more)
        taken.update(more)

    for name in sorted(targets, key=lambda c: (frames[c], c)):
        for i in order:
            if i in taken or name not in rows[i]["classes"]:
                continue
            take([i])
            counts.update(rows[i]["classes"])
            if counts[name] >= targets[name]:
                break
        enough(f"boxes of {name}", counts[name], targets[name])
    take([i for i in order if i not in taken][: max(0, total - len(chosen))])
    enough("positive rows", len(chosen), total)
    if smallest:
        small = sorted((i for i in order if i not in taken and rows[i]["side"] <= side_most), key=lambda i: (rows[i]["side"], ranks[i]))
        enough("rows of small sides", len(small), smallest)
        take(small[:smallest])
    others = sorted((i for i in range(len(rows)) if rows[i].get("negative")), key=lambda i: ranks[i])
    enough("negative rows", len(others), negatives)
    take(others[:negatives])
    return chosen


def _decided(values: np.ndarray, held: np.ndarray, groups: list[str], sites: list[str], near: Callable, *, group_cap: int, site_cap: int, maximum: int, order: str) -> list[str]:
    """A decision for each value in turn: included, or the first reason against it in the order
    given. ``near(held, value)`` tells whether what exists or was included is too like it."""
    n = len(held)
    by_group, by_site, decisions = Counter(), Counter(), []
    included = 0
    for v, g, s in zip(values, groups, sites, strict=True):
        tests = {
            "capacity": lambda: included >= maximum,
            "site": lambda s=s: by_site[s] >= site_cap,
            "group": lambda g=g: by_group[g] >= group_cap,
            "near": lambda v=v: n > 0 and near(held[:n], v),
        }
        reason = next((r for r in order.split("-") if tests[r]()), None)
        decisions.append(reason or "included")
        if reason is None:
            included += 1
            by_group[g] += 1
            by_site[s] += 1
            if n == len(held):
                held = np.concatenate([held, np.zeros((max(64, n), *held.shape[1:]), held.dtype)])
            held[n] = v
            n += 1
    return decisions


def near_free(vectors: np.ndarray, groups: list[str], sites: list[str], *, most: float, group_cap: int, site_cap: int, maximum: int, existing: np.ndarray | None = None, order: str = "capacity-site-group-near") -> list[str]:
    """Decisions where near is a similarity of ``most`` or more to what exists or was included."""
    held = np.zeros((0, len(vectors[0]) if len(vectors) else 0)) if existing is None or not len(existing) else np.asarray(existing, float)
    return _decided(vectors, held, groups, sites, lambda kept, v: float(np.max(kept @ v)) >= most, group_cap=group_cap, site_cap=site_cap, maximum=maximum, order=order)


def hash_free(hashes: np.ndarray, groups: list[str], sites: list[str], *, most: int, group_cap: int, site_cap: int, maximum: int, order: str = "capacity-group-near") -> list[str]:
    """Decisions where near is a Hamming distance of at most ``most`` bits of 64 to what was included."""
    return _decided(hashes, np.zeros(0, np.uint64), groups, sites, lambda kept, v: int(np.bitwise_count(kept ^ v).min()) <= most, group_cap=group_cap, site_cap=site_cap, maximum=maximum, order=order)


def budgeted_plan(queues: dict[str, list[tuple[str, int]]], targets: dict[str, int], budget: int) -> list[tuple[str, str, int]]:
    """(season, site, size): the seasons in turn take from their queues the next site not
    yet chosen that fits the budget; what doesn't is passed for good."""
    chosen: list[tuple[str, str, int]] = []
    at, sites, left = Counter(), set(), budget
    got = Counter()
    moving = True
    while moving:
        moving = False
        for season, queue in queues.items():
            while got[season] < targets[season] and at[season] < len(queue):
                site, size = queue[at[season]]
                at[season] += 1
                if site not in sites and size <= left:
                    chosen.append((season, site, size))
                    sites.add(site)
                    left -= size
                    got[season] += 1
                    moving = True
                    break
    return chosen


def bucketed(rows: list[dict], targets: dict[tuple[str, str], int], site_cap: int, day_roles: frozenset[str] = frozenset({"negative"}), *, fill: list[dict] | None = None, season_share: float = 0.0) -> tuple[list[dict], list[dict]]:
    """Rows dealt to buckets of (role, season) in turn, and the rows that fill up.

    One row per bucket and round: an unused component, a site below its cap, for some roles
    a camera day that these roles don't use yet; new sites first, then sites of fewer rows,
    then confidence (not for those roles), then rank. After a round without a row each role
    takes what it lacks from ``fill`` whatever the season, seasons below their share of
    the total first."""
    sites, seasons, components, days = Counter(), Counter(), set(), set()
    wanted: Counter = Counter()
    for (role, _), target in targets.items():
        wanted[role] += target
    least = math.ceil(season_share * sum(wanted.values()))

    def best(some: list[dict], short: bool) -> dict | None:
        fit = [r for r in some if r["component"] not in components and sites[r["site"]] < site_cap and not (r["role"] in day_roles and r["day"] in days)]
        key = lambda r: (short and seasons[r["season"]] >= least, sites[r["site"]] > 0, sites[r["site"]], 0 if r["role"] in day_roles else -r["confidence"], r["rank"])
        found = min(fit, key=key, default=None)
        if found is not None:
            sites[found["site"]] += 1
            seasons[found["season"]] += 1
            components.add(found["component"])
            if found["role"] in day_roles:
                days.add(found["day"])
        return found

    held: dict[tuple[str, str], list[dict]] = {b: [] for b in targets}
    for r in rows:
        held.setdefault((r["role"], r["season"]), []).append(r)
    got, dealt, filled = Counter(), [], []
    moving = True
    while moving:
        moving = False
        for bucket, target in targets.items():
            found = best(held[bucket], False) if got[bucket] < target else None
            if found is not None:
                dealt.append(found)
                got[bucket] += 1
                moving = True
    have = Counter(r["role"] for r in dealt)
    for role in wanted if fill is not None else ():
        some = [r for r in fill if r["role"] == role]
        while have[role] < wanted[role] and (found := best(some, True)) is not None:
            filled.append(found)
            have[role] += 1
    return dealt, filled


def suffices(rows: list[dict], kinds: tuple[str, ...], picks: int) -> bool:
    """Whether rows in order of preference hold so many that share no value of ``kinds`` that
    after any ``picks`` - 1 choices, each using one value of each kind, one of them is still free:
    then no row behind them is ever chosen."""
    used: list[set] = [set() for _ in kinds]
    free = 0
    for r in rows:
        if all(r[k] not in u for k, u in zip(kinds, used, strict=True)):
            free += 1
            for k, u in zip(kinds, used, strict=True):
                u.add(r[k])
            if free > len(kinds) * (picks - 1):
                return True
    return False


def floors_with_swaps(rows: list[dict], count: int, floors: dict[str, int], group_cap: int) -> tuple[list[int], dict[str, int]]:
    """``count`` rows that meet class floors under a group cap, as far as a greedy choice
    with single swaps can; and what each floor still lacks. Not proven optimal."""
    lack = lambda have: sum(max(0, f - have[c]) for c, f in floors.items())
    chosen: list[int] = []
    have, groups = Counter(), Counter()
    left = sorted(range(len(rows)), key=lambda i: rows[i]["rank"])
    while left and len(chosen) < count:
        fit = [i for i in left if groups[rows[i]["group"]] < group_cap]
        if not fit:
            break
        best = min(fit, key=lambda i: (lack(have + Counter(rows[i]["classes"])), -sum(min(5, n) for n in Counter(rows[i]["classes"]).values()), rows[i]["rank"]))
        left.remove(best)
        chosen.append(best)
        have.update(rows[best]["classes"])
        groups[rows[best]["group"]] += 1
    better = lack(have) > 0
    while better:
        better = False
        for out in list(chosen):
            for into in left:
                if groups[rows[into]["group"]] - (rows[into]["group"] == rows[out]["group"]) >= group_cap:
                    continue
                after = have - Counter(rows[out]["classes"]) + Counter(rows[into]["classes"])
                if lack(after) < lack(have):
                    chosen[chosen.index(out)] = into
                    left[left.index(into)] = out
                    groups[rows[out]["group"]] -= 1
                    groups[rows[into]["group"]] += 1
                    have, better = after, True
                    break
            if better:
                break
    return chosen, {c: max(0, f - have[c]) for c, f in floors.items()}


def one_swap(frames: list[dict], incoming: list[dict], floors: dict[str, int], group_cap: int, *, have: dict[str, int] | None = None, groups: dict[str, int] | None = None) -> tuple[int, int] | None:
    """The swap (out, in) that meets all floors and the cap with the fewest boxes changed,
    then by rank; locked frames stay. None if no swap does. ``have`` and ``groups`` count
    boxes and frames where ``frames`` are only some of them."""
    have = Counter(c for f in frames for c in f["classes"]) if have is None else have
    groups = Counter(f["group"] for f in frames) if groups is None else groups
    names = list(floors)
    boxes = lambda rows: np.array([[r["classes"].count(c) for c in names] for r in rows], np.int64).reshape(len(rows), len(names))
    order = np.array(sorted(range(len(incoming)), key=lambda i: (len(incoming[i]["classes"]), incoming[i]["rank"])), np.int64)
    more, size = boxes(incoming)[order], np.array([len(incoming[i]["classes"]) for i in order], np.int64)
    _, code = _coded([incoming[i]["group"] for i in order] + [f["group"] for f in frames])
    full = np.array([groups.get(incoming[i]["group"], 0) for i in order], np.int64)
    spare = np.array([have.get(c, 0) - floors[c] for c in names], np.int64)
    less, options = boxes(frames), []
    for o, out in enumerate(frames):
        if out["locked"]:
            continue
        fits = (spare - less[o] + more >= 0).all(axis=1) & (full - (code[: len(order)] == code[len(order) + o]) < group_cap)
        if fits.any():
            i = int(np.argmax(fits))
            options.append((len(out["classes"]) + int(size[i]), out["rank"], incoming[order[i]]["rank"], o, int(order[i])))
    return min(options)[3:] if options else None


def _bounded(pool: DataFrame, by: list[str] | None, pool_rows: int) -> None:
    """An error if the pool, or a group of ``by``, has more rows than a kernel takes."""
    found = pool.groupBy(*by).count().agg(F.max("count")).first()[0] if by else pool.limit(pool_rows + 1).count()
    if (found or 0) > pool_rows:
        raise ValueError(f"a pool of {'over ' * (not by)}{found - (not by)} rows; reduce it to {pool_rows} first")


def select_diverse(pool: DataFrame, vector: str, identity: str, count: int, *, group: str | None = None, cap: int | None = None, by: list[str] | None = None, pool_rows: int = POOL_ROWS) -> DataFrame:
    """``farthest_first`` over the pool, or within each value of ``by``: identity and position."""
    kind = dict(pool.dtypes)[identity]
    keys = by or []
    _bounded(pool, by, pool_rows)
    rows = pool.select(*keys, F.col(identity), F.col(vector).cast("array<double>").alias("_v"), (F.col(group).cast("string") if group else F.lit("")).alias("_g"), stable_rank(identity).alias("_r"))

    def kernel(held: pd.DataFrame) -> pd.DataFrame:
        chosen = farthest_first(np.stack(held["_v"].to_numpy()), held["_r"].tolist(), count, groups=held["_g"].tolist() if cap else None, cap=cap)
        found = held.iloc[chosen][[*keys, identity]].copy()
        found["position"] = np.arange(1, len(chosen) + 1)
        return found

    schema = ", ".join([*[f"{k} {dict(pool.dtypes)[k]}" for k in keys], f"{identity} {kind}", "position long"])
    return rows.groupBy(*keys).applyInPandas(kernel, schema)


def over_pool(pool: DataFrame, kernel: Callable[[pd.DataFrame], pd.DataFrame], schema: str, *, by: list[str] | None = None, pool_rows: int = POOL_ROWS) -> DataFrame:
    """Run a kernel over the pool, or over each group of ``by``; too large a group is an error,
    told before any task holds it."""
    _bounded(pool, by, pool_rows)
    return pool.groupBy(*(by or [])).applyInPandas(kernel, schema)


def admit(pool: DataFrame, identity: str, vector: str, group: str, site: str, position: str, *, existing: np.ndarray | None = None, **limits) -> DataFrame:
    """identity and decision of every row, decided in the order of ``position``: see ``near_free``."""
    kind = dict(pool.dtypes)[identity]

    def kernel(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values("_p", kind="stable")
        decisions = near_free(np.stack(held["_v"].to_numpy()), held["_g"].tolist(), held["_s"].tolist(), existing=existing, **limits)
        return pd.DataFrame({identity: held[identity], "decision": decisions})

    rows = pool.select(identity, F.col(vector).cast("array<double>").alias("_v"), F.col(group).cast("string").alias("_g"), F.col(site).cast("string").alias("_s"), F.col(position).alias("_p"))
    return over_pool(rows, kernel, f"{identity} {kind}, decision string")


def select_by_quota(pool: DataFrame, identity: str, vector: str, group: str, stratum: str, features: str, *, minimums: list[tuple[str, int]], strata: dict[str, int], cap: int) -> DataFrame:
    """identity, stratum and position of a diverse selection: see ``quota_selection``."""
    kind = dict(pool.dtypes)[identity]

    def kernel(held: pd.DataFrame) -> pd.DataFrame:
        rows = [{"stratum": s, "group": g, "features": set(f)} for s, g, f in zip(held["_s"], held["_g"], held["_f"], strict=True)]
        chosen = quota_selection(rows, np.stack(held["_v"].to_numpy()), held["_r"].tolist(), minimums, strata, cap)
        found = held.iloc[chosen]
        return pd.DataFrame({identity: found[identity], "stratum": found["_s"], "position": np.arange(1, len(chosen) + 1)})

    rows = pool.select(identity, F.col(vector).cast("array<double>").alias("_v"), F.col(group).cast("string").alias("_g"), F.col(stratum).alias("_s"), F.col(features).alias("_f"), stable_rank(identity).alias("_r"))
    return over_pool(rows, kernel, f"{identity} {kind}, stratum string, position long")


def validation_queue(pool: DataFrame, identity: str, phash: str, group: str, site: str, confidence: str, small: str, *, most: int, group_cap: int, site_cap: int, maximum: int, minimum_sites: int = 0) -> DataFrame:
    """identity and decision of each site's first ``site_cap`` rows by confidence, small boxes and
    hash, round by round over the sites: see ``hash_free``. Fewer sites than the minimum
    among the included are an error; an empty pool gives no rows. phash: 16 hexadecimal digits."""
    kind = dict(pool.dtypes)[identity]
    rows = pool.select(identity, F.col(phash).alias("_h"), F.col(group).cast("string").alias("_g"), F.col(site).cast("string").alias("_s"), F.col(confidence).alias("_c"), F.col(small).alias("_b"), stable_rank(identity).alias("_r"))
    turn = F.row_number().over(Window.partitionBy("_s").orderBy(F.desc("_c"), F.desc("_b"), "_r"))

    def kernel(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["_t", "_c", "_r"], ascending=[True, False, True])
        hashes = np.array([int(h, 16) for h in held["_h"]], np.uint64)
        decisions = hash_free(hashes, held["_g"].tolist(), held["_s"].tolist(), most=most, group_cap=group_cap, site_cap=site_cap, maximum=maximum)
        sites = {s for s, d in zip(held["_s"], decisions, strict=True) if d == "included"}
        if len(sites) < minimum_sites:
            raise ValueError(f"sites in the queue: {len(sites)} of {minimum_sites}")
        return pd.DataFrame({identity: held[identity], "decision": decisions})

    return over_pool(rows.withColumn("_t", turn).where(F.col("_t") <= site_cap), kernel, f"{identity} {kind}, decision string")


def shortlist(pool: DataFrame, identity: str, classes: str, *, targets: dict[str, int], total: int, negative: str | None = None, side: str | None = None, smallest: int = 0, side_most: float = 0.0, negatives: int = 0) -> DataFrame:
    """identity and position, positive rows before negative ones, each by rank: see
    ``rarest_first``. negative: a boolean column (null: false); side: the least side of a row's boxes.

    Any number of rows: the kernel gets those only that can be chosen. The classes take ``most`` rows
    together at most, so of each class its first ``most`` suffice; of all the first ``total``; of
    small sides as many as are asked for behind all that was taken before; and the first negatives.
    Null classes are none; repeated rows stay. An empty pool gives no rows.
    """
    kind = dict(pool.dtypes)[identity]
    most = sum(max(1, n) for n in targets.values())
    named = pool.select(F.col(identity).alias("_id"), F.coalesce(F.col(classes).cast("array<string>"), F.array()).alias("_c"), (F.coalesce(F.col(negative).cast("boolean"), F.lit(False)) if negative else F.lit(False)).alias("_n"), (F.col(side).cast("double") if side else F.lit(0.0)).alias("_s"), stable_rank(identity).alias("_r"))
    # repeated rows are numbered, so that those of the several parts below are told from each other
    named = named.withColumn("_k", F.row_number().over(Window.partitionBy(*named.columns).orderBy("_r")))
    positive = named.where("NOT _n")
    by_rank = ["_r", "_c", "_s", "_k"]
    of_class = positive.withColumn("_t", F.explode(F.array_intersect("_c", F.array(*[F.lit(c) for c in targets]).cast("array<string>"))))
    first = of_class.withColumn("_i", F.row_number().over(Window.partitionBy("_t").orderBy(*by_rank))).where(F.col("_i") <= most)
    small = positive.where(F.col("_s") <= side_most).orderBy("_s", *by_rank).limit(max(most, total) + smallest) if smallest else positive.limit(0)
    parts = [first.select(*named.columns), positive.orderBy(*by_rank).limit(max(0, total)), small, named.where("_n").orderBy(*by_rank).limit(negatives)]
    frames = {r["_t"]: r["count"] for r in of_class.groupBy("_t").count().collect()}

    def kernel(held: pd.DataFrame) -> pd.DataFrame:
        rows = [{"id": i, "classes": list(c), "negative": n, "side": s, "rank": r, "copy": k} for i, c, n, s, r, k in zip(held["_id"], held["_c"], held["_n"], held["_s"], held["_r"], held["_k"], strict=True)]
        rows.sort(key=lambda r: (r["rank"], [(c is not None, c or "") for c in r["classes"]], math.inf if math.isnan(r["side"]) else r["side"], r["copy"]))
        ranks = [r["rank"] for r in rows]
        chosen = rarest_first(rows, ranks, targets, total, smallest=smallest, side_most=side_most, negatives=negatives, frames=Counter(frames))
        chosen.sort(key=lambda i: (rows[i]["negative"], ranks[i]))
        return pd.DataFrame({identity: [rows[i]["id"] for i in chosen], "position": np.arange(1, len(chosen) + 1)})

    return over_pool(functools.reduce(DataFrame.unionByName, parts).distinct(), kernel, f"{identity} {kind}, position long")


def supplement(pool: DataFrame, identity: str, classes: str, group: str, *, count: int, floors: dict[str, int], cap: int) -> DataFrame:
    """identity of ``count`` rows that meet the floors as far as found: see ``floors_with_swaps``."""
    kind = dict(pool.dtypes)[identity]

    def kernel(held: pd.DataFrame) -> pd.DataFrame:
        rows = [{"classes": list(c), "group": g, "rank": r} for c, g, r in zip(held["_c"], held["_g"], held["_r"], strict=True)]
        chosen, _ = floors_with_swaps(rows, count, floors, cap)
        return pd.DataFrame({identity: held.iloc[sorted(chosen)][identity]})

    return over_pool(pool.select(identity, F.col(classes).alias("_c"), F.col(group).cast("string").alias("_g"), stable_rank(identity).alias("_r")), kernel, f"{identity} {kind}")


def plan_archives(archives: DataFrame, sites: DataFrame, *, least_bytes: int, budget: int, total: int, seasons: tuple[str, ...] = ("winter", "spring", "summer", "autumn")) -> DataFrame:
    """season, site and bytes of the plan. archives: site, season, bytes; a season's queue has
    each known site's smallest archive that is large enough, by size, then hash."""
    fit = archives.where(F.col("bytes") >= least_bytes).join(sites.select("site").distinct(), "site", "left_semi")
    queue = fit.groupBy("season", "site").agg(F.min("bytes").alias("bytes")).withColumn("_r", stable_rank(F.lit("plan"), "season", "site"))

    def kernel(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["bytes", "_r"])
        queues = {s: list(zip(g["site"], g["bytes"].astype(int), strict=True)) for s in seasons for g in [held[held["season"] == s]]}
        targets = {s: total // len(seasons) + (i < total % len(seasons)) for i, s in enumerate(seasons)}
        return pd.DataFrame(budgeted_plan(queues, targets, budget), columns=["season", "site", "bytes"])

    return over_pool(queue, kernel, f"season string, site {dict(archives.dtypes)['site']}, bytes long")


def select_frames(frames: DataFrame, identity: str, *, targets: dict[tuple[str, str], int], site_cap: int, minimum_sites: int = 0, season_share: float = 0.15, day_role: str = "negative", pool_rows: int = POOL_ROWS) -> DataFrame:
    """identity, position and phase (dealt or fill) of the chosen: see ``bucketed``. frames: role,
    season, site, component, day, confidence (null: 0).

    Any number of frames: the kernel gets the best rows only, of each component, then of each
    site, then of each bucket, in the order of either phase. That these suffice is proven
    (``suffices``) or an error. So are too few rows, sites, or rows of a season among
    those of ``targets``. Null sites, components or days are one
    value each. An empty table gives no rows."""
    kind = dict(frames.dtypes)[identity]
    picks = sum(targets.values())
    per_bucket = pool_rows // (2 * len(targets))
    per_site = min(4 * picks, per_bucket)
    asked = F.concat_ws("\x1f", "role", "season").isin([f"{r}\x1f{s}" for r, s in targets])
    order = lambda phase: F.struct(F.when(F.col("role") == day_role, F.lit(0.0)).otherwise(-F.coalesce("confidence", F.lit(0.0)).cast("double")).alias("minus"), stable_rank(F.lit(phase), "role", "season", identity).alias("rank"), F.col(identity).alias("who"))
    texts = {k: F.col(k).cast("string") for k in ("site", "component", "day")}
    same = frames.where(asked).withColumns(texts).groupBy("role", "season", "site", "component", F.when(F.col("role") == day_role, F.col("day")).alias("day"))
    bests = same.agg(*[F.min(order(p)).alias(p) for p in ("dealt", "fill")])
    each = bests.select("role", "season", "site", "component", "day", F.explode(F.map_from_arrays(F.array(F.lit("dealt"), F.lit("fill")), F.array("dealt", "fill"))).alias("phase", "b"))
    each = each.select("phase", "role", "season", "site", "component", "day", F.col("b.minus").alias("minus"), F.col("b.rank").alias("rank"), F.col("b.who").alias("who"))
    for number, keys, most in (("_i", ["phase", "role", "season", "site"], per_site), ("_j", ["phase", "role", "season"], per_bucket)):
        each = each.withColumn(number, F.row_number().over(Window.partitionBy(*keys).orderBy("minus", "rank"))).where(F.col(number) <= most)

    def kernel(held: pd.DataFrame) -> pd.DataFrame:
        held = held.sort_values(["minus", "rank"], kind="stable")
        held["confidence"] = -held["minus"]
        for keys, most, kinds in ((["phase", "role", "season", "site"], per_site, ("component",)), (["phase", "role", "season"], per_bucket, ("site", "component"))):
            for found, rows in held.groupby(keys, dropna=False):
                uses = (*kinds, "day") if found[1] == day_role else kinds
                if len(rows) >= most and not suffices(rows.to_dict("records"), uses, picks):
                    raise ValueError(f"the first {most} frames of {found} may not suffice; allow more rows")
        dealt, filled = bucketed(held[held["phase"] == "dealt"].to_dict("records"), targets, site_cap, frozenset({day_role}), fill=held[held["phase"] == "fill"].to_dict("records"), season_share=season_share)
        chosen = dealt + filled
        seasons = Counter(r["season"] for r in chosen)
        least = math.ceil(season_share * picks)
        sites = len({r["site"] for r in chosen})
        if len(chosen) < picks or sites < minimum_sites or any(seasons[s] < least for _, s in targets):
            raise ValueError(f"frames: {len(chosen)} of {picks}; sites: {sites} of {minimum_sites}; by season: {dict(seasons)}, at least {least} each")
        return pd.DataFrame({identity: [r["who"] for r in chosen], "position": np.arange(1, len(chosen) + 1), "phase": ["dealt"] * len(dealt) + ["fill"] * len(filled)})

    return over_pool(each.drop("_i", "_j"), kernel, f"{identity} {kind}, position long, phase string", pool_rows=pool_rows)


def swap_repair(frames: DataFrame, incoming: DataFrame, identity: str, classes: str, group: str, *, floors: dict[str, int], group_cap: int, locked: str | None = None, pool_rows: int = POOL_ROWS) -> DataFrame:
    """out_id and in_id of the swap that ``one_swap`` finds; no row if no swap does.

    Only the first of the rows with the same classes and group can be part of the best
    swap, so each side is cut to these before the kernel takes them. Null classes are none;
    a null group is a group.
    """
    kind = dict(frames.dtypes)[identity]
    held = [df.select(F.col(identity).alias("_id"), F.array_sort(F.coalesce(F.col(classes), F.array())).cast("array<string>").alias("_c"), F.coalesce(F.col(group).cast("string"), F.lit("")).alias("_g"), (F.col(locked) if locked and locked in df.columns else F.lit(False)).alias("_l")) for df in (frames, incoming)]
    have = {r["c"]: r["count"] for r in held[0].select(F.explode("_c").alias("c")).where(F.col("c").isin(*floors)).groupBy("c").count().collect()}
    counts = held[0].groupBy("_g").agg(F.count("*").alias("_n"))
    first = F.min(F.struct(stable_rank("_id").alias("r"), F.col("_id").alias("id"))).alias("_f")
    sides = [df.where("NOT _l").groupBy("_c", "_g").agg(first).select(F.lit(side).alias("_s"), "_c", "_g", "_f.*") for side, df in zip(("out", "in"), held, strict=True)]
    pool = sides[0].unionByName(sides[1]).join(counts, "_g", "left").na.fill(0, ["_n"])

    def kernel(rows: pd.DataFrame) -> pd.DataFrame:
        parts = [[{"id": i, "classes": list(c), "group": g, "rank": r, "locked": False} for i, c, g, r in zip(some["id"], some["_c"], some["_g"], some["r"], strict=True)] for some in (rows[rows["_s"] == "out"], rows[rows["_s"] == "in"])]
        found = one_swap(*parts, floors, group_cap, have=have, groups=dict(zip(rows["_g"], rows["_n"], strict=True)))
        return pd.DataFrame([(parts[0][found[0]]["id"], parts[1][found[1]]["id"])] if found else [], columns=["out_id", "in_id"])

    return over_pool(pool, kernel, f"out_id {kind}, in_id {kind}", pool_rows=pool_rows)
