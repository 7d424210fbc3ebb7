"""Geometry, suppression, matching and metrics over boxes computed from events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import geometry as G
from sieveline.operators import aggregates as A
from sieveline.operators import curves, spatial
from sieveline.operators import matching as M
from sieveline.operators.ledger import small_target
from sieveline.plans.catalog import register, table

#: The same arithmetic for both engines: eight boxes to an image, on a canvas of 640 x 480.
BOXES = """
    WITH boxes AS (
      SELECT event_id, event_id // 8 AS image, (event_id * 37 % 400)::DOUBLE AS x1, (event_id * 53 % 300)::DOUBLE AS y1,
             (event_id * 37 % 400 + 40 + event_id * 29 % 160)::DOUBLE AS x2, (event_id * 53 % 300 + 40 + event_id * 31 % 140)::DOUBLE AS y2,
             (event_id * 71 % 997) / 997.0::DOUBLE AS confidence, (event_id % 3)::INT AS view, (event_id % 4)::INT AS class_id
      FROM events)
"""
_AREA = "(({0}.x2 - {0}.x1) * ({0}.y2 - {0}.y1))"
_BOTH = "(greatest(0, least(a.x2, b.x2) - greatest(a.x1, b.x1)) * greatest(0, least(a.y2, b.y2) - greatest(a.y1, b.y1)))"
_IOU = f"({_BOTH} / ({_AREA.format('a')} + {_AREA.format('b')} - {_BOTH}))"
_COVER = f"({_BOTH} / least({_AREA.format('a')}, {_AREA.format('b')}))"


def boxes(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    x, y = e * 37 % 400, e * 53 % 300
    return table(spark, d, "events").select(
        "event_id",
        F.floor(e / 8).alias("image"),
        x.cast("double").alias("x1"),
        y.cast("double").alias("y1"),
        (x + 40 + e * 29 % 160).cast("double").alias("x2"),
        (y + 40 + e * 31 % 140).cast("double").alias("y2"),
        (e * 71 % 997 / F.lit(997.0)).alias("confidence"),
        (e % 3).cast("int").alias("view"),
        (e % 4).cast("int").alias("class_id"),
    )


def _pairs(spark: SparkSession, d: str) -> DataFrame:
    side = lambda n: boxes(spark, d).select("image", F.col("event_id").alias(n), F.struct("x1", "y1", "x2", "y2", "view", "class_id").alias(f"{n}_box"))
    return side("a").join(side("b"), "image").where("a < b")


@register("box_iou_pairs", f"{BOXES} SELECT a.event_id AS a, b.event_id AS b, round({_IOU}, 6) AS iou, round({_COVER}, 6) AS coverage FROM boxes a JOIN boxes b ON a.image = b.image AND a.event_id < b.event_id WHERE {_IOU} >= 0.1")
def box_iou_pairs(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).withColumns({"iou": G.iou(F.col("a_box"), F.col("b_box")), "coverage": G.coverage(F.col("a_box"), F.col("b_box"))})
    return p.where("iou >= 0.1").select("a", "b", F.round("iou", 6).alias("iou"), F.round("coverage", 6).alias("coverage"))


@register("box_overlaps", f"{BOXES} SELECT a.event_id AS a, b.event_id AS b FROM boxes a JOIN boxes b ON a.image = b.image AND a.event_id < b.event_id WHERE {_IOU} >= 0.5 OR (a.view <> b.view AND {_COVER} >= 0.5)")
def box_overlaps(spark: SparkSession, d: str) -> DataFrame:
    return _pairs(spark, d).where(G.overlaps(F.col("a_box"), F.col("b_box"))).select("a", "b")


@register("box_formats", f"{BOXES} SELECT event_id, x2 - x1 AS w, y2 - y1 AS h, (x1 + x2) / 2 AS cx, (y1 + y2) / 2 AS cy, round(x1 / 640, 9) AS nx, round(y2 / 480, 9) AS ny, round(x1, 9) AS back FROM boxes")
def box_formats(spark: SparkSession, d: str) -> DataFrame:
    b = F.struct("x1", "y1", "x2", "y2")
    w, h = F.lit(640.0), F.lit(480.0)
    return boxes(spark, d).select("event_id", G.to_xywh(b)["w"].alias("w"), G.to_xywh(b)["h"].alias("h"), G.to_center(b)["cx"].alias("cx"), G.to_center(b)["cy"].alias("cy"), F.round(G.normalized(b, w, h)["x1"], 9).alias("nx"), F.round(G.normalized(b, w, h)["y2"], 9).alias("ny"), F.round(G.from_center(G.to_center(b))["x1"], 9).alias("back"))


@register("iou_xywh", f"{BOXES} SELECT a.event_id AS a, round({_IOU}, 6) AS iou FROM boxes a JOIN boxes b ON a.image = b.image AND b.event_id = a.event_id + 1")
def iou_xywh(spark: SparkSession, d: str) -> DataFrame:
    p = _pairs(spark, d).where("b = a + 1")
    return p.select("a", F.round(G.iou_xywh(G.to_xywh(F.col("a_box")), G.to_xywh(F.col("b_box"))), 6).alias("iou"))


@register(
    "box_rotation",
    f"""{BOXES}, s AS (SELECT event_id, event_id % 4 * 90 AS r, x1 / 640 AS x1, y1 / 480 AS y1, x2 / 640 AS x2, y2 / 480 AS y2 FROM boxes)
    SELECT event_id, round(CASE r WHEN 90 THEN y1 WHEN 180 THEN 1 - x2 WHEN 270 THEN 1 - y2 ELSE x1 END, 9) AS x1, round(CASE r WHEN 90 THEN 1 - x2 WHEN 180 THEN 1 - y2 WHEN 270 THEN x1 ELSE y1 END, 9) AS y1 FROM s""",
)
def box_rotation(spark: SparkSession, d: str) -> DataFrame:
    turned = G.rotated(G.normalized(F.struct("x1", "y1", "x2", "y2"), F.lit(640.0), F.lit(480.0)), F.col("event_id") % 4 * 90)
    return boxes(spark, d).select("event_id", F.round(turned["x1"], 9).alias("x1"), F.round(turned["y1"], 9).alias("y1"))


@register(
    "size_tags",
    f"""{BOXES}, s AS (SELECT *, least(x2 - x1, y2 - y1) / 4 AS side, (x2 - x1) * (y2 - y1) / 4 AS area FROM boxes)
    SELECT event_id, CASE WHEN side < 16 THEN 'tiny' WHEN side <= 32 THEN 'small' WHEN side <= 96 THEN 'medium' ELSE 'large' END AS side_tag,
           CASE WHEN area < 1024 THEN 'small' WHEN area < 9216 THEN 'medium' ELSE 'large' END AS area_tag, least(x2 - x1, y2 - y1) <= 50 AS is_small FROM s""",
)
def size_tags(spark: SparkSession, d: str) -> DataFrame:
    b = F.struct("x1", "y1", "x2", "y2")
    size = G.area_at(b, F.lit(1280.0), F.lit(960.0))
    return boxes(spark, d).select("event_id", G.side_tag(G.short_side(b) / 4).alias("side_tag"), G.area_tag(size).alias("area_tag"), small_target(F.array(b), 50).alias("is_small"))


@register(
    "size_counts",
    f"{BOXES} SELECT image, count(*) FILTER ((x2 - x1) * (y2 - y1) < 4096) AS small, count(*) FILTER ((x2 - x1) * (y2 - y1) BETWEEN 4096 AND 9215.999) AS medium, count(*) FILTER ((x2 - x1) * (y2 - y1) >= 9216) AS large FROM boxes GROUP BY image",
)
def size_counts(spark: SparkSession, d: str) -> DataFrame:
    size = G.area(F.struct("x1", "y1", "x2", "y2"))
    tag = F.when(size < 4096, "small").when(size < 9216, "medium").otherwise("large")
    return boxes(spark, d).groupBy("image").agg(*[F.count_if(tag == t).alias(t) for t in ("small", "medium", "large")])


@register(
    "tiles",
    """
    WITH p AS (SELECT p_partkey, 640 + p_size * 8 AS w, 480 + p_size * 4 AS h FROM part),
    t AS (SELECT *, greatest(1, ceil(w / 4.2::DOUBLE))::INT AS tw, greatest(1, ceil(h / 2.6::DOUBLE))::INT AS th FROM p)
    SELECT p_partkey, (y * 5 + x + 1)::INT AS priority, CASE x WHEN 4 THEN w - tw ELSE round_even(x * (w - tw) / 4.0::DOUBLE, 0)::INT END AS tile_x,
           CASE y WHEN 2 THEN h - th ELSE round_even(y * (h - th) / 2.0::DOUBLE, 0)::INT END AS tile_y, tw AS tile_w, th AS tile_h
    FROM t, range(0, 5) a(x), range(0, 3) b(y)
    """,
)
def tiles(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "part").select("p_partkey", (640 + F.col("p_size") * 8).alias("width"), (480 + F.col("p_size") * 4).alias("height"))
    return G.tiles(images).select("p_partkey", "priority", "tile_x", "tile_y", "tile_w", "tile_h")


@register(
    "letterbox",
    """
    WITH p AS (SELECT p_partkey, (640 + p_size * 8)::DOUBLE AS w, (480 + p_size * 4)::DOUBLE AS h FROM part),
    s AS (SELECT *, least(640 / w, 640 / h) AS scale FROM p), t AS (SELECT *, greatest(1, round_even(w * scale, 0))::INT AS tw, greatest(1, round_even(h * scale, 0))::INT AS th FROM s)
    SELECT p_partkey, round(scale, 9) AS scale, (640 - tw) // 2 AS off_x, (640 - th) // 2 AS off_y FROM t
    """,
)
def letterbox(spark: SparkSession, d: str) -> DataFrame:
    v = G.letterbox((640 + F.col("p_size") * 8).cast("double"), (480 + F.col("p_size") * 4).cast("double"))
    return table(spark, d, "part").select("p_partkey", F.round(v["scale"], 9).alias("scale"), v["off_x"].alias("off_x"), v["off_y"].alias("off_y"))


@register(
    "view_to_image",
    f"{BOXES} SELECT event_id, round(least(greatest((x1 - 10) / 2 + 100, 0), 319), 6) AS x1, round(least(greatest((y2 - 20) / 2 + 200, 0), 359), 6) AS y2 FROM boxes",
)
def view_to_image(spark: SparkSession, d: str) -> DataFrame:
    view = F.struct(F.lit(2.0).alias("scale"), F.lit(10.0).alias("off_x"), F.lit(20.0).alias("off_y"), F.lit(100.0).alias("crop_x"), F.lit(200.0).alias("crop_y"))
    b = G.to_image(F.struct("x1", "y1", "x2", "y2"), view, F.lit(320.0), F.lit(360.0))
    return boxes(spark, d).select("event_id", F.round(b["x1"], 6).alias("x1"), F.round(b["y2"], 6).alias("y2"))


_CROP = "(SELECT 100.0::DOUBLE AS x1, 100.0::DOUBLE AS y1, 300.0::DOUBLE AS x2, 300.0::DOUBLE AS y2)"


@register(
    "crop_visibility",
    f"""{BOXES} SELECT a.event_id, round({_BOTH} / {_AREA.format('a')}, 6) AS visible,
    least(a.x2, 300) - greatest(a.x1, 100) >= 1 AND least(a.y2, 300) - greatest(a.y1, 100) >= 1 AND (((a.x1 + a.x2) / 2 >= 100 AND (a.x1 + a.x2) / 2 < 300 AND (a.y1 + a.y2) / 2 >= 100 AND (a.y1 + a.y2) / 2 < 300) OR {_BOTH} / {_AREA.format('a')} >= 0.5) AS kept,
    a.x1 <= 102 OR a.y1 <= 102 OR a.x2 >= 298 OR a.y2 >= 298 AS at_edge,
    CASE WHEN {_BOTH} / {_AREA.format('a')} >= 0.5 THEN round(greatest(0, least(least(a.x2, 300) - greatest(a.x1, 100), least(a.y2, 300) - greatest(a.y1, 100))) * 3.2, 6) ELSE 0 END AS side
    FROM boxes a, {_CROP} b""",
)
def crop_visibility(spark: SparkSession, d: str) -> DataFrame:
    crop = G.box(F.lit(100), F.lit(100), F.lit(300), F.lit(300))
    b = F.struct("x1", "y1", "x2", "y2")
    return boxes(spark, d).select("event_id", F.round(G.visible_share(b, crop), 6).alias("visible"), G.inside_crop(b, crop).alias("kept"), G.at_inner_edge(b, crop, F.lit(640.0), F.lit(480.0)).alias("at_edge"), F.round(G.view_short_side(b, crop, F.lit(False)), 6).alias("side"))


@register(
    "privacy_rectangles",
    f"""{BOXES}, r AS (SELECT event_id, greatest(0, floor(x1 - (x2 - x1) * 0.1::DOUBLE))::INT AS x1, greatest(0, floor(y1 - (y2 - y1) * 0.1::DOUBLE))::INT AS y1, least(640, ceil(x2 + (x2 - x1) * 0.1::DOUBLE))::INT AS x2, least(480, ceil(y2 + (y2 - y1) * 0.1::DOUBLE))::INT AS y2 FROM boxes)
    SELECT *, greatest(8, round_even(least(x2 - x1, y2 - y1) * 0.1::DOUBLE, 0)::INT) AS radius FROM r""",
)
def privacy_rectangles(spark: SparkSession, d: str) -> DataFrame:
    r = G.privacy_rectangle(F.struct("x1", "y1", "x2", "y2"), F.lit(640), F.lit(480))
    return boxes(spark, d).select("event_id", *[r[c].alias(c) for c in ("x1", "y1", "x2", "y2", "radius")])


@register("detection_filter", f"{BOXES} SELECT event_id, class_id FROM boxes WHERE confidence >= 0.47 AND class_id IN (0, 1, 2) AND x2 > x1 AND y2 > y1")
def detection_filter(spark: SparkSession, d: str) -> DataFrame:
    return boxes(spark, d).where((F.col("confidence") + 1e-7 >= 0.47) & F.col("class_id").isin(0, 1, 2) & (F.col("x2") > F.col("x1")) & (F.col("y2") > F.col("y1"))).select("event_id", "class_id")


@register("view_flags", f"{BOXES} SELECT image, bool_or(view = 0) AS has_full, bool_or(view > 0) AS has_crop, bool_or(view = 0) <> bool_or(view > 0) AS disagreement FROM boxes WHERE confidence >= 0.6 GROUP BY image")
def view_flags(spark: SparkSession, d: str) -> DataFrame:
    return A.view_flags(boxes(spark, d).where("confidence >= 0.6"), "image")


_NMS = f"""
    WITH RECURSIVE boxes AS ({BOXES.split('AS (', 1)[1].rstrip().rstrip(')')}),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY image, class_id % 2 ORDER BY confidence DESC, view, event_id) AS r FROM boxes),
    sizes AS (SELECT image, class_id % 2 AS dom, max(r) AS n FROM ranked GROUP BY ALL),
    step AS (
      SELECT image, dom, n, 0::BIGINT AS r, []::BIGINT[] AS kept FROM sizes
      UNION ALL
      SELECT s.image, s.dom, s.n, s.r + 1,
             CASE WHEN EXISTS (SELECT 1 FROM ranked b WHERE list_contains(s.kept, b.event_id) AND b.image = s.image AND ({_IOU} >= 0.5 OR (a.view <> b.view AND {_COVER} >= 0.5))) THEN s.kept ELSE list_append(s.kept, a.event_id) END
      FROM step s JOIN ranked a ON a.image = s.image AND a.class_id % 2 = s.dom AND a.r = s.r + 1)
    SELECT image, dom, unnest(kept) AS event_id FROM step WHERE r = n
"""


@register("suppression", _NMS)
def suppression(spark: SparkSession, d: str) -> DataFrame:
    """Greedy suppression in each image and class family, as one fold per group."""
    rows = boxes(spark, d).withColumns({"row": F.col("event_id"), "dom": (F.col("class_id") % 2).cast("long")})
    return M.suppress(rows, ["image", "dom"], ["event_id"]).select("image", F.col("dom").cast("int").alias("dom"), "event_id")


def _truth(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Predictions are moved copies of the truth, one per box and so far from others'
    boxes that matching is one to one by construction."""
    far = F.col("event_id") * 1000.0
    base = table(spark, d, "events").select("event_id", F.floor(F.col("event_id") / 8).alias("image"), far.alias("x1"), F.lit(0.0).alias("y1"), (far + 100.0).alias("x2"), F.lit(100.0).alias("y2"), (F.col("event_id") % 4).cast("int").alias("class_id"), (F.col("event_id") * 71 % 997 / F.lit(997.0)).alias("confidence"))
    shift = F.when(F.col("event_id") % 5 == 0, 90.0).when(F.col("event_id") % 5 == 1, 60.0).otherwise(20.0)
    predictions = base.where("event_id % 7 <> 0").withColumns({"p": F.col("event_id"), "x1": F.col("x1") + shift, "x2": F.col("x2") + shift, "class_id": F.when(F.col("event_id") % 11 == 0, (F.col("class_id") + 1) % 4).otherwise(F.col("class_id"))})
    targets = base.withColumn("t", F.col("event_id"))
    return predictions.select("image", "p", "class_id", "confidence", "x1", "y1", "x2", "y2"), targets.select("image", "t", "class_id", "x1", "y1", "x2", "y2")


_EVENTS = """
    WITH e AS (SELECT event_id, event_id // 8 AS image, (event_id % 4)::INT AS actual, ((event_id % 4 + (event_id % 11 = 0)::INT) % 4)::INT AS predicted, event_id % 7 <> 0 AS seen, event_id % 5 > 1 AS near, event_id % 5 = 1 AS mid, event_id * 71 % 997 / 997.0::DOUBLE AS confidence FROM events),
    ev AS (
      SELECT image, event_id AS p, event_id AS t, CASE WHEN actual = predicted THEN 'true_positive' ELSE 'class_confusion' END AS type, actual, predicted, confidence FROM e WHERE seen AND near
      UNION ALL SELECT image, event_id, NULL, CASE WHEN mid AND actual = predicted THEN 'localization_error' ELSE 'false_positive' END, NULL, predicted, confidence FROM e WHERE seen AND NOT near
      UNION ALL SELECT image, NULL, event_id, 'false_negative', actual, NULL, NULL FROM e WHERE NOT (seen AND near))
"""


@register("match_events", f"{_EVENTS} SELECT image, p, t, type, actual, predicted FROM ev")
def match_events(spark: SparkSession, d: str) -> DataFrame:
    return M.match_events(*_truth(spark, d), ["image"]).select("image", "p", "t", "type", "actual", "predicted")


_RATES = """
    c AS (SELECT type, actual AS class, 1 AS tp, 0 AS fp, 0 AS fn FROM ev WHERE type = 'true_positive' UNION ALL SELECT type, actual, 0, 0, 1 FROM ev WHERE type IN ('class_confusion', 'false_negative')
          UNION ALL SELECT type, predicted, 0, 1, 0 FROM ev WHERE type NOT IN ('true_positive', 'false_negative'))
"""


@register(
    "metrics_grouping_sets",
    f"""{_EVENTS}, {_RATES}, s AS (
      SELECT 'total' AS level, '' AS value, sum(tp) AS tp, sum(fp) AS fp, sum(fn) AS fn FROM c UNION ALL SELECT 'class', class::VARCHAR, sum(tp), sum(fp), sum(fn) FROM c GROUP BY class UNION ALL SELECT 'type', type, sum(tp), sum(fp), sum(fn) FROM c GROUP BY type)
    SELECT level, value, tp, fp, fn, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6) AS precision, round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6) AS recall, round(CASE WHEN tp > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6) AS f1 FROM s""",
)
def metrics_grouping_sets(spark: SparkSession, d: str) -> DataFrame:
    found = A.summarize(M.match_events(*_truth(spark, d), ["image"]), ["class", "type"])
    return found.select("level", "value", "tp", "fp", "fn", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")])


@register(
    "threshold_sweep",
    f"""{_EVENTS}, t AS (SELECT unnest([0.2, 0.35, 0.5]::DOUBLE[]) AS threshold),
    n AS (SELECT threshold, count(*) FILTER (seen AND near AND confidence >= threshold AND actual = predicted) AS tp, count(*) FILTER (seen AND confidence >= threshold AND NOT (near AND actual = predicted)) AS fp, count(*) FILTER (NOT (seen AND near AND confidence >= threshold AND actual = predicted)) AS fn FROM t, e GROUP BY threshold)
    SELECT threshold, tp, fp, fn FROM n""",
)
def threshold_sweep(spark: SparkSession, d: str) -> DataFrame:
    events = A.contributions(M.sweep(*_truth(spark, d), ["image"], [0.2, 0.35, 0.5]))
    return events.groupBy("threshold").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])


@register("confusion_matrix", f"{_EVENTS} SELECT actual, predicted, count(*) AS n FROM ev WHERE type IN ('true_positive', 'class_confusion') GROUP BY ALL")
def confusion_matrix(spark: SparkSession, d: str) -> DataFrame:
    events = M.match_events(*_truth(spark, d), ["image"]).where(F.col("type").isin("true_positive", "class_confusion"))
    return events.groupBy("actual", "predicted").agg(F.count("*").alias("n"))


@register("evaluation_modes", f"{BOXES} SELECT mode, count(*) AS n FROM boxes, (VALUES ('full_image', 0), ('crop_only', 1), ('pipeline', 2)) m(mode, k) WHERE k = 2 OR (k = 0 AND view = 0) OR (k = 1 AND view > 0) GROUP BY mode")
def evaluation_modes(spark: SparkSession, d: str) -> DataFrame:
    return M.modes(boxes(spark, d)).groupBy("mode").agg(F.count("*").alias("n"))


def _two_models(spark: SparkSession, d: str) -> DataFrame:
    """Each image's boxes as the baseline has them, and as a candidate has them: moved by up
    to 60 pixels, some of another class. In order of event."""
    move = F.col("event_id") % 7 * 10.0

    def side(model: str) -> DataFrame:
        rows = boxes(spark, d)
        if model == "candidate":
            rows = rows.withColumns({"x1": F.col("x1") + move, "x2": F.col("x2") + move, "class_id": F.when(F.col("event_id") % 11 == 0, (F.col("class_id") + 1) % 4).otherwise(F.col("class_id")).cast("int")})
        item = F.struct("event_id", "x1", "y1", "x2", "y2", "confidence", "class_id", "view", (F.col("class_id") % 2).alias("family"), (F.col("class_id") % 2).alias("domain"), F.array(F.lit(model)).alias("models"))
        return rows.groupBy("image").agg(F.array_sort(F.collect_list(item)).alias(model))

    return side("baseline").join(side("candidate"), "image")


@register("model_agreement")
def model_agreement(spark: SparkSession, d: str) -> DataFrame:
    return _two_models(spark, d).select("image", F.explode(M.agreed(F.col("baseline"), F.col("candidate"), 0.5, 0.3)).alias("b")).select("image", "b.event_id")


@register("model_union")
def model_union(spark: SparkSession, d: str) -> DataFrame:
    return _two_models(spark, d).select("image", F.explode(M.united(F.col("baseline"), F.col("candidate"), 0.3)).alias("b")).select("image", "b.event_id", F.array_join("b.models", ";").alias("models"))


@register("novel_instances")
def novel_instances(spark: SparkSession, d: str) -> DataFrame:
    return _two_models(spark, d).select("image", F.explode(M.novel(F.col("baseline"), F.col("candidate"))).alias("b")).select("image", "b.event_id")


@register("mining_signals")
def mining_signals(spark: SparkSession, d: str) -> DataFrame:
    target = lambda c: F.filter(c, lambda b: b["class_id"] < 3)
    other = F.filter("candidate", lambda b: b["class_id"] == 3)
    return _two_models(spark, d).select("image", F.array_join(M.signals(target("baseline"), target("candidate"), other, 0.6), ";").alias("signals"))


@register("proposal_differences")
def proposal_differences(spark: SparkSession, d: str) -> DataFrame:
    return _two_models(spark, d).select("image", M.differences(F.col("baseline"), F.col("candidate"), 0.1).alias("x")).select("image", "x.*")


@register("fused_provenance")
def fused_provenance(spark: SparkSession, d: str) -> DataFrame:
    every = _two_models(spark, d).select("image", F.concat("baseline", "candidate").alias("boxes"))
    full, crop = F.filter("boxes", lambda b: b["view"] == 0), F.filter("boxes", lambda b: b["view"] > 0)
    return every.withColumn("b", F.explode("boxes")).select("image", "b.event_id", M.provenance(F.col("b"), full, crop).alias("source"))


#: Four scenes that hold all boxes, on strips that grow with the table; every 500th box is large.
STRIPS = """
    WITH s AS (SELECT event_id, (event_id % 4)::INT AS class_id, (event_id * 3 + event_id * 7919 % 997)::DOUBLE AS x1, (event_id * 53 % 3000)::DOUBLE AS y1,
                      CASE WHEN event_id % 500 = 7 THEN 4000 ELSE 40 + event_id * 29 % 160 END::DOUBLE AS w, CASE WHEN event_id % 500 = 7 THEN 3000 ELSE 40 + event_id * 31 % 140 END::DOUBLE AS h FROM events),
    boxes AS (SELECT event_id, class_id, x1, y1, x1 + w AS x2, y1 + h AS y2 FROM s)
"""


def strips(spark: SparkSession, d: str) -> DataFrame:
    e = F.col("event_id")
    x, y, large = e * 3 + e * 7919 % 997, e * 53 % 3000, e % 500 == 7
    corners = {"x1": x, "y1": y, "x2": x + F.when(large, 4000).otherwise(40 + e * 29 % 160), "y2": y + F.when(large, 3000).otherwise(40 + e * 31 % 140)}
    return table(spark, d, "events").select("event_id", (e % 4).cast("int").alias("class_id"), *[c.cast("double").alias(n) for n, c in corners.items()], (e * 71 % 997 / F.lit(997.0)).alias("confidence"), (e % 3).cast("int").alias("view"))


@register("dense_box_pairs", f"{STRIPS} SELECT a.event_id AS a, b.event_id AS b, round({_IOU}, 6) AS iou FROM boxes a JOIN boxes b ON a.class_id = b.class_id AND a.event_id < b.event_id AND a.x1 < b.x2 AND b.x1 < a.x2 WHERE {_IOU} >= 0.25")
def dense_box_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Overlaps in scenes that hold a quarter of all boxes each."""
    side = lambda n: strips(spark, d).select("class_id", F.col("event_id").alias(n), F.struct("x1", "y1", "x2", "y2").alias(f"{n}_box"))
    met = spatial.overlapping(side("a"), side("b"), ["class_id"], "a_box", "b_box", 0.25).where("a < b")
    return met.select("a", "b", F.round(G.iou(F.col("a_box"), F.col("b_box")), 6).alias("iou"))


@register("dense_suppression")
def dense_suppression(spark: SparkSession, d: str) -> DataFrame:
    """Suppression in the same scenes, in rounds over all of them."""
    return spatial.suppress(strips(spark, d).withColumn("row", F.col("event_id")), ["class_id"]).select("class_id", "event_id")


_MAP = f"""{BOXES},
    p AS (SELECT image, event_id AS p, confidence, CASE WHEN event_id % 11 = 0 THEN (class_id + 1) % 4 ELSE class_id END AS class_id, x1 + event_id % 9 * 8 AS x1, y1, x2 + event_id % 9 * 8 AS x2, y2 FROM boxes WHERE event_id % 7 <> 0),
    best AS (SELECT b.class_id, b.p, b.confidence, a.event_id AS t, {_IOU} AS iou FROM boxes a JOIN p b ON a.image = b.image AND a.class_id = b.class_id WHERE {_IOU} >= 0.5 QUALIFY row_number() OVER (PARTITION BY b.p ORDER BY {_IOU} DESC, a.event_id) = 1),
    levels AS (SELECT unnest([0.5, 0.55, 0.6, 0.65, 0.7, 0.75, 0.8, 0.85, 0.9, 0.95]::DOUBLE[]) AS least),
    hit AS (SELECT least, p FROM best, levels WHERE iou >= least QUALIFY row_number() OVER (PARTITION BY t, least ORDER BY confidence DESC, p) = 1),
    n AS (SELECT class_id, count(*) AS targets FROM boxes GROUP BY class_id),
    placed AS (SELECT class_id, p, row_number() OVER (PARTITION BY class_id ORDER BY confidence DESC, image, p) AS place FROM p),
    k AS (SELECT class_id, least, place, row_number() OVER (PARTITION BY class_id, least ORDER BY place) AS k FROM placed JOIN hit USING (p)),
    f AS (SELECT class_id, max(2.0::DOUBLE * k / (place + targets)) AS f1 FROM k JOIN n USING (class_id) WHERE least = 0.5 GROUP BY class_id),
    top AS (SELECT class_id, least, r, max(k::DOUBLE / place) AS best FROM k JOIN n USING (class_id), range(101) g(r) WHERE 100 * k >= r * targets GROUP BY ALL),
    ap AS (SELECT class_id, least, sum(best) / 101 AS ap FROM top GROUP BY ALL),
    c AS (SELECT class_id, targets, (SELECT count(*) FROM p WHERE p.class_id = n.class_id) AS predictions, coalesce((SELECT ap FROM ap WHERE least = 0.5 AND ap.class_id = n.class_id), 0) AS map50, coalesce((SELECT ap FROM ap WHERE least = 0.75 AND ap.class_id = n.class_id), 0) AS map75, coalesce((SELECT sum(ap) / 10 FROM ap WHERE ap.class_id = n.class_id), 0) AS map50_95, coalesce(f1, 0) AS f1 FROM n LEFT JOIN f USING (class_id)),
    every AS (SELECT class_id, targets, predictions, map50, map75, map50_95, f1 FROM c UNION ALL SELECT NULL, sum(targets)::BIGINT, sum(predictions)::BIGINT, avg(map50), avg(map75), avg(map50_95), avg(f1) FROM c)
    SELECT class_id, targets, predictions, round(map50, 9) AS map50, round(map75, 9) AS map75, round(map50_95, 9) AS map50_95, round(f1, 9) AS f1 FROM every WHERE targets IS NOT NULL
"""


@register("mean_average_precision", _MAP)
def mean_average_precision(spark: SparkSession, d: str) -> DataFrame:
    """Predictions are the boxes moved by up to 64 pixels, a seventh missing, some of another class."""
    rows, move = boxes(spark, d), F.col("event_id") % 9 * 8
    targets = rows.withColumn("t", F.col("event_id"))
    moved = {"p": F.col("event_id"), "x1": F.col("x1") + move, "x2": F.col("x2") + move, "class_id": F.when(F.col("event_id") % 11 == 0, (F.col("class_id") + 1) % 4).otherwise(F.col("class_id"))}
    found = curves.average_precision(rows.where("event_id % 7 <> 0").withColumns(moved), targets, ["image"])
    ap = lambda level: F.get("ap", F.lit(curves.LEVELS.index(level)))
    return found.select("class_id", "targets", "predictions", *[F.round(c, 9).alias(n) for n, c in (("map50", ap(0.5)), ("map75", ap(0.75)), ("map50_95", F.col("mean_ap")), ("f1", F.col("f1")))])
