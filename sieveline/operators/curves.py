"""Precision over recall, and its mean, for detections of any number.

Places by confidence and sums along them come from ranges of the order, each summed for itself; the
envelope of a curve needs 101 values a class and IoU only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.geometry import iou
from sieveline.operators.spatial import overlapping
from sieveline.session import written

#: The levels of IoU that a mean is taken over.
LEVELS = [0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]


def hits(predictions: DataFrame, targets: DataFrame, keys: list[str], levels: list[float] = LEVELS) -> DataFrame:
    """keys, class_id, p and ``hit``, an array that says at which levels the prediction is a true one.

    A prediction speaks for the target of its class that it overlaps best (the smaller t at ties); at
    each level a target belongs to the surest of those that speak for it there (the smaller p at
    ties), the rest are false. Predictions that hit at no level aren't in the result. Columns as in
    ``matching.match_pairs``; p and t tell a scene's rows apart.
    """
    box = lambda n: F.struct("x1", "y1", "x2", "y2").alias(n)
    scene = [*keys, "class_id"]
    met = overlapping(predictions.select(*scene, "p", "confidence", box("_p")), targets.select(*scene, "t", box("_t")), scene, "_p", "_t", min(levels))
    met = met.select(*scene, "p", "confidence", "t", iou(F.col("_p"), F.col("_t")).alias("iou"))
    best = met.groupBy(*scene, "p", "confidence").agg(F.max(F.struct("iou", (-F.col("t")).alias("t"))).alias("b"))
    surest = F.struct(F.col("confidence").alias("c"), (-F.col("p")).alias("p"))
    winners = [F.max(F.when(F.col("b.iou") >= x, surest))["p"].alias(f"_w{i}") for i, x in enumerate(levels)]
    won = best.groupBy(*scene, F.col("b.t").alias("t")).agg(*winners).select(*scene, F.posexplode(F.array(*[F.col(f"_w{i}") for i in range(len(levels))])).alias("i", "w")).where("w IS NOT NULL")
    at = won.groupBy(*scene, (-F.col("w")).alias("p")).agg(F.collect_set("i").alias("at"))
    return at.select(*scene, "p", F.transform(F.sequence(F.lit(0), F.lit(len(levels) - 1)), lambda i: F.array_contains("at", i)).alias("hit"))


def _placed(rows: DataFrame, order: list[str], levels: int, known: DataFrame) -> DataFrame:
    """class_id, targets (from ``known``), confidence, place (from 1 in the class) and k0, k1, ...: the true ones up to it
    at each level. Rows meet what is said of their class by class and range, so a large class isn't one task."""
    flags = [F.coalesce(F.get("hit", F.lit(i)), F.lit(False)).cast("long").alias(f"f{i}") for i in range(levels)]
    laid = rows.select("class_id", "confidence", *order, *flags).repartitionByRange("class_id", F.desc("confidence"), *order).sortWithinPartitions("class_id", F.desc("confidence"), *order)
    laid = written(laid.withColumn("_at", F.monotonically_increasing_id()).withColumn("_range", F.shiftright("_at", 33)), "curves")
    sums = laid.groupBy("class_id", "_range").agg(F.count("*").alias("n"), *[F.sum(f"f{i}").alias(f"s{i}") for i in range(levels)])
    before = Window.partitionBy("class_id").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    begun = sums.select("class_id", "_range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"_{c}") for c in ["n", *[f"s{i}" for i in range(levels)]]]).join(known, "class_id")
    inside = Window.partitionBy("class_id", "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    summed = laid.withColumns({"place": F.count("*").over(inside), **{f"k{i}": F.sum(f"f{i}").over(inside) for i in range(levels)}})
    return summed.join(begun, ["class_id", "_range"]).select("class_id", "targets", "confidence", (F.col("place") + F.col("_n")).alias("place"), *[f"f{i}" for i in range(levels)], *[(F.col(f"k{i}") + F.col(f"_s{i}")).alias(f"k{i}") for i in range(levels)])


def average_precision(predictions: DataFrame, targets: DataFrame, keys: list[str], levels: list[float] = LEVELS) -> DataFrame:
    """One row a class that has targets, and one of all (class_id null), their plain mean.

    targets and predictions (their numbers), ``ap`` (an array, one for each level), ``mean_ap``, and at the first level's best F1:
    precision, recall, f1 and the confidence there. An average precision is the mean over the recalls 0, 0.01, ..., 1 of
    the best precision at that recall or beyond, 0 where none is reached. Predictions go by falling confidence, ties by ``keys``
    and p; those without a confidence or of a class without targets take no part. No targets give no rows.
    """
    many = range(len(levels))
    known = targets.where("class_id IS NOT NULL").groupBy("class_id").agg(F.count("*").alias("targets"))
    sure = predictions.where("confidence IS NOT NULL AND NOT isnan(confidence)")
    named = [*keys, "class_id", "p"]
    found = hits(sure, targets, keys, levels).select("hit", *[F.col(c).alias(f"_n{i}") for i, c in enumerate(named)])
    same = [F.col(c).eqNullSafe(F.col(f"_n{i}")) for i, c in enumerate(named)]
    rows = sure.select(*named, "confidence").join(found, same, "left")
    placed = _placed(rows.select("class_id", "confidence", *keys, "p", "hit"), [*keys, "p"], len(levels), known)
    precision = F.col("k0") / F.col("place")
    f1 = 2 * F.col("k0") / (F.col("place") + F.col("targets"))
    best = F.max(F.struct(f1.alias("f1"), (-F.col("place")).alias("place"), precision.alias("precision"), (F.col("k0") / F.col("targets")).alias("recall"), F.col("confidence").alias("confidence"))).alias("best")
    tops = placed.groupBy("class_id").agg(F.count("*").alias("predictions"), best)
    true_at = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"f{i}").alias("f"), F.col(f"k{i}").alias("k")) for i in many])
    points = placed.select("class_id", "targets", "place", F.inline(F.filter(true_at, lambda x: x["f"] > 0)))
    reached = points.groupBy("class_id", "i", F.expr("(100 * k) div targets").alias("j")).agg(F.max(F.col("k") / F.col("place")).alias("best"))
    curve = reached.groupBy("class_id", "i").agg(F.collect_list(F.struct("j", "best")).alias("curve"))
    height = F.aggregate(F.sequence(F.lit(0), F.lit(100)), F.lit(0.0), lambda so_far, r: so_far + F.coalesce(F.array_max(F.transform(F.filter("curve", lambda x: x["j"] >= r), lambda x: x["best"])), F.lit(0.0)))
    aps = curve.select("class_id", "i", (height / 101).alias("a")).groupBy("class_id").agg(F.map_from_entries(F.collect_list(F.struct("i", "a"))).alias("m"))
    every = known.join(tops, "class_id", "left").join(aps, "class_id", "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    ap = F.array(*[zero(F.try_element_at("m", F.lit(i))) for i in many])
    classes = every.select("class_id", "targets", F.coalesce("predictions", F.lit(0)).alias("predictions"), ap.alias("ap"), *[zero(F.col(f"best.{c}")).alias(c) for c in ("precision", "recall", "f1")], F.col("best.confidence").alias("confidence"))
    means = F.array(*[F.avg(F.get("ap", F.lit(i))) for i in many]).alias("ap")
    total = classes.agg(F.sum("targets").alias("targets"), F.sum("predictions").alias("predictions"), means, *[F.avg(c).alias(c) for c in ("precision", "recall", "f1")]).where("targets IS NOT NULL")
    total = total.select(F.lit(None).cast(classes.schema["class_id"].dataType).alias("class_id"), *[c if c != "confidence" else F.lit(None).cast("double").alias(c) for c in classes.columns[1:]])
    mean = F.aggregate("ap", F.lit(0.0), lambda s, a: s + a) / len(levels)
    return classes.unionByName(total).withColumn("mean_ap", mean)
