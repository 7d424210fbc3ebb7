"""Groups dealt whole to parts of exactly the sizes asked for.

Only how many groups there are of each size decides whether sizes can be met, so Spark counts
that histogram and the choice is made over it: most groups of a size go to parts by their shares, and a
subset-sum program over a reserve settles what is left. Which groups go where is then a matter of hash order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scalars import stable_rank
from sieveline.operators.ranking import numbered

#: Bits of one program's reachable sums, at most; the joint program of all parts needs their product.
MOST_BITS = 1 << 26

Histogram = dict[int, int]


class Unreachable(ValueError):
    """No groups make these sizes. ``nearest`` are the sizes that come closest, or None where
    the program over all parts was too large to tell."""

    def __init__(self, sizes: list[int], nearest: list[int] | None):
        super().__init__(f"no groups make parts of {sizes}; " + (f"the nearest are {nearest}" if nearest else "not shown that none exist"))
        self.nearest = nearest


def _layers(items: list[int], shifts: list[int], mask: int) -> list[int]:
    """Reachable sums as bits, after no item, one item and so on; an item of size s may add s
    times any of ``shifts``, or nothing."""
    layers = [1]
    for s in items:
        now = layers[-1]
        for shift in shifts:
            now |= layers[-1] << (s * shift)
        layers.append(now & mask)
    return layers


def _one_part(free: Histogram, target: int) -> Histogram | None:
    """Groups whose sizes add up to the target: large ones first, so that small ones stay."""
    items = [s for s, n in sorted(free.items(), reverse=True) for _ in range(min(n, target // s if s else 0))]
    layers = _layers(items, [1], (1 << (target + 1)) - 1)
    if not layers[-1] >> target & 1:
        return None
    taken: Histogram = {}
    for i in range(len(items), 0, -1):
        if not layers[i - 1] >> target & 1:
            taken[items[i - 1]] = taken.get(items[i - 1], 0) + 1
            target -= items[i - 1]
    return taken


def _jointly(free: Histogram, targets: list[int]) -> tuple[list[Histogram], list[int]]:
    """All parts at once: the groups of each part and the sizes reached, those asked for or the nearest.

    A state is the sums of all parts; parts may pass their target by the largest group."""
    slack = max(free, default=0)
    widths = [t + slack + 1 for t in targets]
    shifts, product = [], 1
    for w in widths:
        shifts.append(product)
        product *= w
    sums = lambda state: [state // shift % w for shift, w in zip(shifts, widths, strict=True)]
    items = [s for s, n in sorted(free.items(), reverse=True) for _ in range(n)]
    states: list[dict[int, int]] = [{0: -1}]
    for s in items:
        now = dict.fromkeys(states[-1], -1)
        for state in states[-1]:
            for k, (have, w) in enumerate(zip(sums(state), widths, strict=True)):
                if have + s < w:
                    now.setdefault(state + s * shifts[k], k)
        states.append(now)
    best = min(states[-1], key=lambda state: (sum(abs(a - b) for a, b in zip(sums(state), targets, strict=True)), state))
    taken: list[Histogram] = [{} for _ in targets]
    reached, state = sums(best), best
    for i in range(len(items), 0, -1):
        k = states[i][state]
        if k >= 0:
            taken[k][items[i - 1]] = taken[k].get(items[i - 1], 0) + 1
            state -= items[i - 1] * shifts[k]
    return taken, reached


def plan(histogram: Histogram, sizes: list[int]) -> list[Histogram]:
    """How many groups of each size go to each part but the last, which takes what is left.

    ``sizes`` are those of all parts and add up to all rows. First shares of each size are dealt out
    but for a reserve; if no choice over the reserve meets the sizes, the reserve is doubled. Where
    parts one after the other don't work out over all groups, all parts are tried at once.
    """
    total = sum(s * n for s, n in histogram.items())
    if sum(sizes) != total:
        raise ValueError(f"parts of {sum(sizes)} rows in all, {total} rows")
    targets, reserve = sizes[:-1], 4
    while True:
        bulk = [{s: max(0, n * t // total - reserve) for s, n in histogram.items()} for t in targets]
        free = {s: n - sum(b[s] for b in bulk) for s, n in histogram.items()}
        left = [t - sum(s * n for s, n in b.items()) for t, b in zip(targets, bulk, strict=True)]
        if max(left, default=0) > MOST_BITS:
            break
        found = []
        for target in left:
            taken = _one_part(free, target)
            if taken is None:
                break
            free = {s: n - taken.get(s, 0) for s, n in free.items()}
            found.append(taken)
        else:
            return [{s: b[s] + f.get(s, 0) for s in histogram} for b, f in zip(bulk, found, strict=True)]
        if not any(any(b.values()) for b in bulk):
            break
        reserve *= 2
    slack, states = max(histogram), 1
    for t in targets:
        states *= t + slack + 1
    if states * sum(histogram.values()) > MOST_BITS:
        raise Unreachable(sizes, None)
    taken, reached = _jointly(histogram, targets)
    if reached != targets:
        raise Unreachable(sizes, [*reached, total - sum(reached)])
    return taken


def exact_group_split(rows: DataFrame, group: str, parts: list[tuple[str, int]], seed: str = "42") -> DataFrame:
    """``rows`` with a column ``split``: groups are whole and parts have exactly their sizes.

    Within a size, groups go to parts by the stable hash of their name; a null group is one group.
    Sizes that no groups make are an error that names the nearest. The driver holds the histogram of sizes.
    """
    sizes = rows.groupBy(group).agg(F.count("*").alias("__size"))
    histogram = {r["__size"]: r["n"] for r in sizes.groupBy("__size").agg(F.count("*").alias("n")).collect()}
    if not histogram:
        return rows.withColumn("split", F.lit(parts[-1][0]))
    chosen = plan(histogram, [n for _, n in parts])
    order = numbered(sizes, [F.col("__size"), stable_rank(F.coalesce(F.col(group).cast("string"), F.lit("")), seed=seed), F.col(group)], "__number")
    before, cuts = 0, []
    for s in sorted(histogram):
        edge = before
        for (name, _), take in zip(parts, chosen, strict=False):
            if take.get(s, 0):
                cuts.append((s, edge, edge + take[s], name))
                edge += take[s]
        before += histogram[s]
    spans = rows.sparkSession.createDataFrame(cuts, "__s long, __from long, __to long, split string")
    # some spans a size; a size's groups are told apart by number
    told = order.join(F.broadcast(spans), (F.col("__size") == F.col("__s")) & (F.col("__number") > F.col("__from")) & (F.col("__number") <= F.col("__to")), "left")
    told = told.select(F.col(group).alias("__group"), F.coalesce("split", F.lit(parts[-1][0])).alias("split"))
    return rows.join(told, F.col(group).eqNullSafe(F.col("__group"))).drop("__group")
