"""Suppression and matching of boxes: folds over each group's sorted boxes.

A group is one image (and class family), so its boxes are few; the fold runs in
the JVM over an array that the group's aggregation has built.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.geometry import coverage, iou, overlaps

#: Classes that compete with each other.
ROAD_VEHICLES = ["car", "bus", "truck"]


def domain(class_name: Column) -> Column:
    """Road vehicles are one domain; any other class is its own."""
    return F.when(class_name.isin(ROAD_VEHICLES), "road_vehicle").otherwise(class_name)


def empty_like(items: Column) -> Column:
    return F.slice(items, 1, 0)


def suppress(boxes: DataFrame, keys: list[str], fields: list[str], *, most_iou: float = 0.5, most_coverage: float = 0.5) -> DataFrame:
    """Greedy suppression within ``keys``: by falling confidence, then view, then row, a
    box stays unless it overlaps one that stayed. Columns x1, y1, x2, y2, confidence,
    view and row; ``fields`` travel along. One row per box that stays."""
    order = F.struct((-F.col("confidence")).alias("order"), "view", "row", "x1", "y1", "x2", "y2", "confidence", *fields)
    sorted_boxes = boxes.groupBy(*keys).agg(F.array_sort(F.collect_list(order)).alias("boxes"))
    kept = F.aggregate("boxes", empty_like(F.col("boxes")), lambda kept, b: F.when(F.exists(kept, lambda k: overlaps(k, b, most_iou, most_coverage)), kept).otherwise(F.array_append(kept, b)))
    return sorted_boxes.select(*keys, F.explode(kept).alias("b")).select(*keys, "b.view", "b.row", "b.x1", "b.y1", "b.x2", "b.y2", "b.confidence", *[f"b.{f}" for f in fields])


def match_pairs(predictions: DataFrame, targets: DataFrame, keys: list[str], least: float = 0.5) -> DataFrame:
    """One-to-one matching per ``keys``: pairs of IoU ``least`` or more, by (same class,
    IoU, confidence, prediction, target) falling, each side used once. Predictions:
    p, class_id, confidence and box columns; targets: t, class_id and box columns."""
    p = predictions.select(*keys, "p", F.col("class_id").alias("p_class"), "confidence", F.struct("x1", "y1", "x2", "y2").alias("pb"))
    t = targets.select(*keys, "t", F.col("class_id").alias("t_class"), F.struct("x1", "y1", "x2", "y2").alias("tb"))
    pairs = p.join(t, keys).withColumn("iou", iou(F.col("pb"), F.col("tb"))).where(F.col("iou") >= least)
    order = F.struct((~(F.col("p_class") == F.col("t_class"))).alias("other"), (-F.col("iou")).alias("by_iou"), (-F.col("confidence")).alias("by_confidence"), (-F.col("p")).alias("by_p"), (-F.col("t")).alias("by_t"), "p", "t", "p_class", "t_class", "iou", "confidence")
    grouped = pairs.groupBy(*keys).agg(F.array_sort(F.collect_list(order)).alias("pairs"))
    taken = F.aggregate("pairs", empty_like(F.col("pairs")), lambda used, x: F.when(F.exists(used, lambda u: (u["p"] == x["p"]) | (u["t"] == x["t"])), used).otherwise(F.array_append(used, x)))
    return grouped.select(*keys, F.explode(taken).alias("m")).select(*keys, "m.p", "m.t", "m.p_class", "m.t_class", "m.iou", "m.confidence")


def match_events(predictions: DataFrame, targets: DataFrame, keys: list[str], least: float = 0.5, near: float = 0.1) -> DataFrame:
    """true_positive, class_confusion, duplicate_detection, localization_error,
    false_positive and false_negative events of each group."""
    matched = match_pairs(predictions, targets, keys, least)
    hits = matched.select(*keys, F.when(F.col("p_class") == F.col("t_class"), "true_positive").otherwise("class_confusion").alias("type"), F.col("t_class").alias("actual"), F.col("p_class").alias("predicted"), "p", "t", "iou", "confidence")
    lost = predictions.join(matched.select(*keys, "p"), [*keys, "p"], "left_anti")
    same = lost.join(targets.select(*keys, "class_id", F.struct("x1", "y1", "x2", "y2").alias("tb")), [*keys, "class_id"], "left").withColumn("iou", F.coalesce(iou(F.struct("x1", "y1", "x2", "y2"), F.col("tb")), F.lit(0.0)))
    best = same.groupBy(*keys, "p", "class_id", "confidence").agg(F.max("iou").alias("iou"))
    kind = F.when(F.col("iou") >= least, "duplicate_detection").when(F.col("iou") >= near, "localization_error").otherwise("false_positive")
    false_hits = best.select(*keys, kind.alias("type"), F.lit(None).cast("int").alias("actual"), F.col("class_id").alias("predicted"), "p", F.lit(None).cast("long").alias("t"), "iou", "confidence")
    missed = targets.join(matched.select(*keys, "t"), [*keys, "t"], "left_anti").select(*keys, F.lit("false_negative").alias("type"), F.col("class_id").alias("actual"), F.lit(None).cast("int").alias("predicted"), F.lit(None).cast("long").alias("p"), "t", F.lit(None).cast("double").alias("iou"), F.lit(None).cast("double").alias("confidence"))
    return hits.unionByName(false_hits).unionByName(missed)


def differences(before: Column, after: Column, least: float = 0.5) -> Column:
    """How many proposals (class_id and box) a revision keeps, removes and adds: each in
    turn takes the unused box of its class with the best IoU, if that reaches ``least``."""
    zero = F.transform(after, lambda a: F.struct(a.alias("b"), F.lit(False).alias("used")))

    def step(state: Column, b: Column) -> Column:
        scores = F.transform(state, lambda s, i: F.struct(F.when(s["used"] | (s["b"]["class_id"] != b["class_id"]), -1.0).otherwise(iou(s["b"], b)).alias("iou"), (-i).alias("i")))
        best = F.array_max(scores)
        return F.when(best.isNull() | (best["iou"] < least), state).otherwise(F.transform(state, lambda s, i: F.struct(s["b"].alias("b"), (s["used"] | (i == -best["i"])).alias("used"))))

    used = F.size(F.filter(F.aggregate(before, zero, step), lambda s: s["used"]))
    return F.struct(used.alias("matched"), (F.size(before) - used).alias("removed"), (F.size(after) - used).alias("added"))


def agreed(baseline: Column, candidate: Column, least_iou: float, least_confidence: float) -> Column:
    """Boxes that two models agree on: class, IoU and both confidences; of a pair the
    surer box, the baseline's at ties. A candidate serves one baseline box."""
    good = lambda boxes: F.filter(boxes, lambda b: b["confidence"] >= least_confidence)
    start = F.struct(empty_like(baseline).alias("won"), F.transform(good(candidate), lambda c: F.struct(c.alias("b"), F.lit(False).alias("used"))).alias("pool"))

    def step(state: Column, b: Column) -> Column:
        first = F.array_min(F.filter(F.transform(state["pool"], lambda s, i: F.when(~s["used"] & (s["b"]["class_id"] == b["class_id"]) & (iou(s["b"], b) >= least_iou), i)), lambda i: i.isNotNull()))
        other = F.get(state["pool"], first)["b"]
        return F.when(first.isNull(), state).otherwise(F.struct(F.array_append(state["won"], F.when(other["confidence"] > b["confidence"], other).otherwise(b)).alias("won"), F.transform(state["pool"], lambda s, i: F.struct(s["b"].alias("b"), (s["used"] | (i == first)).alias("used"))).alias("pool")))

    return F.aggregate(good(baseline), start, step)["won"]


def united(baseline: Column, candidate: Column, least_iou: float = 0.5) -> Column:
    """Both models' boxes in turn, each merged into the first of its family it overlaps:
    the surer box stands for both, and the models add up. Boxes carry ``family`` and ``models``."""
    boxes = F.concat(baseline, candidate)

    def step(state: Column, b: Column) -> Column:
        first = F.array_min(F.filter(F.transform(state, lambda s, i: F.when((s["family"] == b["family"]) & (iou(s, b) >= least_iou), i)), lambda i: i.isNotNull()))

        def merged(s: Column) -> Column:
            models = F.array_sort(F.array_union(s["models"], b["models"]))
            return F.when(b["confidence"] > s["confidence"], b.withField("models", models)).otherwise(s.withField("models", models))

        return F.when(first.isNull(), F.array_append(state, b)).otherwise(F.transform(state, lambda s, i: F.when(i == first, merged(s)).otherwise(s)))

    return F.aggregate(boxes, empty_like(boxes), step)


def novel(existing: Column, candidates: Column, most: float = 0.5) -> Column:
    """Candidates, surest first, that overlap nothing of their domain by IoU or coverage,
    neither what exists nor what was added before."""
    order = F.array_sort(F.transform(candidates, lambda b: F.struct((-b["confidence"]).alias("o"), b["class_id"].alias("c"), b["x1"].alias("x1"), b["y1"].alias("y1"), b["x2"].alias("x2"), b["y2"].alias("y2"), b.alias("b"))))
    start = F.struct(existing.alias("held"), empty_like(existing).alias("new"))

    def step(state: Column, o: Column) -> Column:
        b = o["b"]
        near = F.exists(state["held"], lambda h: (h["domain"] == b["domain"]) & ((iou(h, b) >= most) | (coverage(h, b) >= most)))
        return F.when(near, state).otherwise(F.struct(F.array_append(state["held"], b).alias("held"), F.array_append(state["new"], b).alias("new")))

    return F.aggregate(order, start, step)["new"]


def signals(left: Column, right: Column, other: Column, threshold: float, near: float = 0.05, confusing: float = 0.1) -> Column:
    """What two models' boxes of an image say about it, sorted. left and right: baseline
    and candidate boxes of target classes; other: the candidate's boxes of other classes.
    Boxes carry family, confidence and view (0: the full view)."""
    best = F.array_max(F.transform(right, lambda b: b["confidence"]))
    full = lambda boxes: F.exists(boxes, lambda b: b["view"] == 0)
    crop = lambda boxes: F.exists(boxes, lambda b: b["view"] > 0)
    only_crop = lambda boxes: crop(boxes) & ~full(boxes)
    shared = F.exists(left, lambda a: F.exists(right, lambda b: (a["family"] == b["family"]) & (iou(a, b) >= 0.5)))
    some = lambda boxes: F.size(boxes) > 0
    named = {
        "baseline_only": some(left) & ~some(right),
        "candidate_only": ~some(left) & some(right),
        "confuser": ~some(right) & F.exists(other, lambda b: b["confidence"] >= confusing),
        "crop_only": only_crop(left) | only_crop(right),
        "full_crop_disagreement": (full(left) != full(right)) | (crop(left) != crop(right)),
        "high_candidate": best >= threshold,
        "near_threshold": some(right) & (F.abs(best - threshold) <= near + 1e-12),
        "shared": shared,
    }
    return F.array_compact(F.array(*[F.when(c, n) for n, c in named.items()]))


def provenance(b: Column, full: Column, crop: Column) -> Column:
    """Which views saw a fused box, before suppression."""
    seen = lambda boxes: F.exists(boxes, lambda x: (x["domain"] == b["domain"]) & ((iou(x, b) >= 0.5) | (coverage(x, b) >= 0.5)))
    return F.when(seen(full) & seen(crop), "shared").when(seen(full), "full").when(seen(crop), "crop").otherwise("none")


def modes(boxes: DataFrame) -> DataFrame:
    """Each box once for every evaluation mode that looks at its view."""
    every = F.array(F.struct(F.lit("full_image").alias("mode"), (F.col("view") == 0).alias("sees")), F.struct(F.lit("crop_only").alias("mode"), (F.col("view") > 0).alias("sees")), F.struct(F.lit("pipeline").alias("mode"), F.lit(True).alias("sees")))
    return boxes.withColumn("_m", F.explode(every)).where("_m.sees").withColumn("mode", F.col("_m.mode")).drop("_m")


def sweep(predictions: DataFrame, targets: DataFrame, keys: list[str], thresholds: list[float]) -> DataFrame:
    """Match events at each confidence threshold. The thresholds are few and fixed."""
    every = F.explode(F.array(*[F.lit(t) for t in thresholds]))
    p = predictions.withColumn("threshold", every).where("confidence >= threshold")
    t = targets.withColumn("threshold", every)
    return match_events(p, t, [*keys, "threshold"])
