"""Joins and suppression of boxes for scenes of any number of boxes.

A box has the level of its longer side, rounded up to a power of two, and covers few
cells of that size. The larger box of a pair stays at its level, the smaller one rises to
it, so small boxes meet nothing but what is near, whatever lies in the scene besides. A pair is
told in one cell only: that of the upper left corner of what both share.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.geometry import intersection, iou, overlaps
from sieveline.session import written

SIDES = ("x1", "y1", "x2", "y2")


def level(b: Column) -> Column:
    """The least n with 2^n at or above the longer side. The logarithm may be off by a rounding, so its neighbours are tried."""
    side = F.greatest(b["x2"] - b["x1"], b["y2"] - b["y1"])
    n = F.ceil(F.log2(side)).cast("int")
    two = lambda k: F.pow(F.lit(2.0), k)
    return F.when(two(n) < side, n + 1).when(two(n - 1) >= side, n - 1).otherwise(n)


def real(b: Column) -> Column:
    """Whether a box has an area and four finite corners."""
    finite = [(F.abs(b[c]) < float("inf")) & ~F.isnan(b[c]) for c in SIDES]
    return F.coalesce(finite[0] & finite[1] & finite[2] & finite[3] & (b["x2"] > b["x1"]) & (b["y2"] > b["y1"]), F.lit(False))


def _celled(df: DataFrame, b: str, levels: Column) -> DataFrame:
    """``df`` once for each cell that its box covers at each of the levels: columns _g, _x and _y."""
    rows = df.withColumn("_g", F.explode(levels))
    size = F.pow(F.lit(2.0), F.col("_g"))
    across = lambda low, high: F.explode(F.sequence(F.floor(F.col(b)[low] / size), F.floor(F.col(b)[high] / size)))
    return rows.withColumn("_x", across("x1", "x2")).withColumn("_y", across("y1", "y2"))


def _rise(least: float) -> int:
    """How many levels the smaller of two boxes with this IoU can lie below the larger: its longer side is
    at least this share of the other's."""
    levels = 0
    while 2.0**-levels > least * (1 - 1e-9):
        levels += 1
    return levels


def overlapping(left: DataFrame, right: DataFrame, keys: list[str], left_box: str, right_box: str, least: float | None = None) -> DataFrame:
    """Rows of both sides whose boxes share an area, in one scene (equal ``keys``, nulls equal each other), each pair once.

    ``least``: the least IoU, above 0; without it, any shared area counts, and the levels that occur
    are gathered first (at most one for each power of two, whatever the number of boxes). The
    sides' other columns have different names. Boxes without an area, or with a corner that is
    null or not finite, overlap nothing.
    """
    if least is not None and not 0 < least <= 1:
        raise ValueError("the least IoU lies above 0 and is 1 at most")
    sides = [df.where(real(F.col(b))).withColumn("_own", level(F.col(b))) for df, b in ((left, left_box), (right, right_box))]
    own = F.col("_own")
    if least is None:
        found = sides[0].select("_own").unionByName(sides[1].select("_own")).distinct()
        present = F.array(*[F.lit(r[0]) for r in sorted(found.collect())]).cast("array<int>")
        upward = lambda first: F.filter(present, lambda g: g >= own + first)
    else:
        rise = _rise(least)
        upward = lambda first: F.sequence(own + first, own + rise) if first <= rise else F.array().cast("array<int>")
    named = [*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col("_g").alias("_rg"), F.col("_x").alias("_rx"), F.col("_y").alias("_ry")]
    same = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)] + [F.col(f"_{c}") == F.col(f"_r{c}") for c in "gxy"]
    others = [c for c in right.columns if c not in keys]

    def met(left_levels: Column, right_levels: Column) -> DataFrame:
        l = _celled(sides[0], left_box, left_levels)  # noqa: E741
        r = _celled(sides[1], right_box, right_levels).select(*others, *named)
        a, b, size = F.col(left_box), F.col(right_box), F.pow(F.lit(2.0), F.col("_g"))
        here = (F.floor(F.greatest(a["x1"], b["x1"]) / size) == F.col("_x")) & (F.floor(F.greatest(a["y1"], b["y1"]) / size) == F.col("_y"))
        enough = iou(a, b) >= least if least is not None else intersection(a, b) > 0
        return l.join(r, same).where(here & enough).select(*left.columns, *others)

    home = F.array(own)
    return met(home, upward(0)).unionByName(met(upward(1), home))


def suppress(boxes: DataFrame, keys: list[str], *, most_iou: float = 0.5, most_coverage: float = 0.5) -> DataFrame:
    """``matching.suppress`` for scenes of any size: the boxes that stay, all columns kept.

    Columns x1, y1, x2, y2, confidence, view and row; ``row`` tells a scene's boxes apart. A box is
    decided as soon as all boxes before it that overlap it are: those that none is left before
    stay, what overlaps them goes, and so on in rounds, each over all scenes together. The rounds are as many as
    the longest chain of boxes that wait for each other, which is short unless boxes are chained
    on purpose; a round writes the overlaps that are left, so no scene is one task.
    """
    of = lambda n: F.struct(*SIDES, "view", F.struct((-F.col("confidence")).alias("c"), "view", "row").alias("place")).alias(f"_{n}")
    scene = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]).alias("_scene")
    node = lambda n: F.struct("_scene", f"_{n}.place.row").alias(n)
    pairs = overlapping(boxes.select(scene, of("a")), boxes.select(scene, of("b")), ["_scene"], "_a", "_b")
    pairs = pairs.where(F.col("_a.place") < F.col("_b.place")).where(overlaps(F.col("_a"), F.col("_b"), most_iou, most_coverage))
    left = written(pairs.select(node("a"), node("b")), "overlaps")
    lost = None
    while left.limit(1).count():
        heads = left.select("a").distinct().join(left.select(F.col("b").alias("a")).distinct(), "a", "left_anti")
        gone = written(left.join(heads, "a", "left_semi").select("b").distinct(), "suppressed")
        lost = gone if lost is None else lost.unionByName(gone)
        left = written(left.join(gone, "b", "left_anti").join(gone.select(F.col("b").alias("a")), "a", "left_anti"), "overlaps")
    if lost is None:
        return boxes
    rows = boxes.withColumn("_b", F.struct(scene, F.col("row").alias("row")))
    return rows.join(lost.select(F.col("b").alias("_b")), "_b", "left_anti").select(*boxes.columns)


