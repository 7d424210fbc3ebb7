"""Boxes: geometry, suppression, matching and metrics against the library's fixtures."""

import pytest
from pyspark.sql import functions as F

from sieveline.functions import geometry as G
from sieveline.operators import aggregates as A
from sieveline.operators import matching as M


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def lit_box(x1, y1, x2, y2, **extra):
    fields = [F.lit(float(v)).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), (x1, y1, x2, y2), strict=True)]
    return F.struct(*fields, *[F.lit(v).alias(n) for n, v in extra.items()])


def test_iou_of_exactly_half_suppresses(spark):
    a, b = lit_box(0, 0, 60, 10, view=0), lit_box(20, 0, 80, 10, view=0)
    assert value(spark, G.iou(a, b)) == 0.5
    assert value(spark, G.overlaps(a, b))


def test_coverage_counts_across_views_only(spark):
    wide, small = lit_box(0, 0, 20, 10, view=0), lit_box(15, 0, 25, 10, view=0)
    assert value(spark, G.coverage(wide, small)) == 0.5
    assert not value(spark, G.overlaps(wide, small))
    assert value(spark, G.overlaps(wide, small.withField("view", F.lit(3))))
    assert not value(spark, G.overlaps(wide, lit_box(15.1, 0, 25.1, 10, view=3)))


def test_inverse_transform(spark):
    view = F.struct(F.lit(2.0).alias("scale"), F.lit(10.0).alias("off_x"), F.lit(20.0).alias("off_y"), F.lit(100.0).alias("crop_x"), F.lit(200.0).alias("crop_y"))
    got = value(spark, G.to_image(lit_box(20, 40, 60, 100), view, F.lit(1000.0), F.lit(1000.0)))
    assert tuple(got) == (105, 210, 125, 240)


def test_rotation(spark):
    got = value(spark, G.rotated(lit_box(0.1, 0.2, 0.4, 0.7), F.lit(90)))
    assert [round(x, 6) for x in got] == [0.2, 0.6, 0.7, 0.9]


def test_tiles(spark):
    rows = G.tiles(spark.createDataFrame([(4608, 2592)], "width int, height int")).orderBy("priority").collect()
    assert len(rows) == 15 and {(r["tile_w"], r["tile_h"]) for r in rows} == {(1098, 997)}
    assert [r["tile_x"] for r in rows[:5]] == [0, 878, 1755, 2632, 3510] and [r["tile_y"] for r in rows[::5]] == [0, 798, 1595]
    tiny = G.tiles(spark.createDataFrame([(1, 1)], "width int, height int")).collect()
    assert {(r["tile_x"], r["tile_y"], r["tile_w"], r["tile_h"]) for r in tiny} == {(0, 0, 1, 1)} and len(tiny) == 15
    tall = G.tiles(spark.createDataFrame([(300, 900)], "width int, height int")).collect()
    assert len({r["tile_x"] for r in tall}) == 3 and len({r["tile_y"] for r in tall}) == 5


BOXES = "image int, dom string, x1 double, y1 double, x2 double, y2 double, confidence double, view int, row int, class string"


def test_suppression_keeps_the_surest_of_a_domain(spark):
    rows = [(1, "car", 0.8), (1, "bus", 0.9), (1, "truck", 0.85), (1, "person", 0.1)]
    df = spark.createDataFrame([(i, "", 0.0, 0.0, 10.0, 10.0, c, 0, n, k) for n, (i, k, c) in enumerate(rows)], BOXES).withColumn("dom", M.domain(F.col("class")))
    assert {r["class"] for r in M.suppress(df, ["image", "dom"], ["class"]).collect()} == {"bus", "person"}


def test_equal_confidence_goes_to_the_first_view(spark):
    df = spark.createDataFrame([(1, "car", 0.0, 0.0, 10.0, 10.0, 0.5, v, 0, "car") for v in (8, 2, 0)], BOXES)
    assert [r["view"] for r in M.suppress(df, ["image", "dom"], ["class"]).collect()] == [0]


def test_suppression_is_transitive_through_kept_boxes_only(spark):
    xs = [(0.0, 0.9), (4.0, 0.8), (8.0, 0.7)]  # neighbours overlap by half, ends don't
    df = spark.createDataFrame([(1, "car", x, 0.0, x + 12, 10.0, c, 0, i, "car") for i, (x, c) in enumerate(xs)], BOXES)
    assert sorted(r["confidence"] for r in M.suppress(df, ["image", "dom"], ["class"]).collect()) == [0.7, 0.9]


PRED = "image int, p long, class_id int, confidence double, x1 double, y1 double, x2 double, y2 double"
TRUE = "image int, t long, class_id int, x1 double, y1 double, x2 double, y2 double"


def events(spark, predictions, targets):
    return M.match_events(spark.createDataFrame(predictions, PRED), spark.createDataFrame(targets, TRUE), ["image"])


def test_confusion_counts_for_both_classes(spark):
    found = events(spark, [(1, 0, 7, 0.9, 0.0, 0.0, 10.0, 10.0), (1, 1, 2, 0.8, 100.0, 0.0, 110.0, 10.0)], [(1, 0, 2, 0.0, 0.0, 10.0, 10.0), (1, 1, 0, 50.0, 50.0, 60.0, 60.0)])
    assert sorted(r["type"] for r in found.collect()) == ["class_confusion", "false_negative", "false_positive"]
    total = A.summarize(found, []).first()
    assert (total["tp"], total["fp"], total["fn"]) == (0, 2, 2) and total["f1"] == 0


def test_same_class_pairs_come_first(spark):
    predictions = [(1, 0, 1, 0.9, 0.0, 0.0, 10.0, 10.0), (1, 1, 2, 0.5, 1.0, 0.0, 11.0, 10.0)]
    found = {r["type"]: r["p"] for r in events(spark, predictions, [(1, 0, 2, 0.0, 0.0, 10.0, 10.0)]).collect()}
    assert found == {"true_positive": 1, "false_positive": 0}


def test_leftovers_are_told_apart(spark):
    predictions = [(1, i, 2, 0.9 - i / 10, x, 0.0, x + 10, 10.0) for i, x in enumerate((0.0, 1.0, 7.0, 50.0))]
    found = {r["p"]: r["type"] for r in events(spark, predictions, [(1, 0, 2, 0.0, 0.0, 10.0, 10.0)]).collect()}
    assert found == {0: "true_positive", 1: "duplicate_detection", 2: "localization_error", 3: "false_positive"}


@pytest.mark.parametrize(("counts", "want"), [((883, 98, 430), (0.900, 0.673, 0.770)), ((2088, 244, 2926), (0.895, 0.416, 0.568)), ((0, 0, 0), (0, 0, 0))])
def test_rates(spark, counts, want):
    tp, fp, fn = (F.lit(c) for c in counts)
    got = A.rates(tp, fp, fn)
    assert [round(value(spark, got[c]), 3) for c in ("precision", "recall", "f1")] == list(want)


def detections(spark, rows):
    """rows: model, class, confidence, view, box; arrays of each model in one row."""
    item = "x1 double, y1 double, x2 double, y2 double, confidence double, class_id int, view int, family string, domain string, models array<string>"
    made = {m: [(*b, c, k, v, "vehicle" if k else "person", "road" if k else "person", [m]) for mm, k, c, v, b in rows if mm == m] for m in ("a", "b", "o")}
    return spark.createDataFrame([(made["a"], made["b"], made["o"])], f"a array<struct<{item}>>, b array<struct<{item}>>, o array<struct<{item}>>".replace(" double", ": double").replace(" int", ": int").replace(" string,", ": string,").replace("models array", "models: array"))


SQUARE = (0.0, 0.0, 10.0, 10.0)


def test_signals(spark):
    df = detections(spark, [("a", 2, 0.4, 1, SQUARE), ("b", 2, 0.31, 1, SQUARE)])
    got = df.select(M.signals(F.col("a"), F.col("b"), F.col("o"), 0.30).alias("s")).first()["s"]
    assert set(got) == {"high_candidate", "shared", "crop_only", "near_threshold"}
    lone = detections(spark, [("o", 9, 0.2, 0, SQUARE)]).select(M.signals(F.col("a"), F.col("b"), F.col("o"), 0.3).alias("s")).first()["s"]
    assert lone == ["confuser"]


@pytest.mark.parametrize(("rows", "n"), [([("a", 2, 0.6, 0, SQUARE), ("b", 2, 0.7, 0, SQUARE)], 1), ([("a", 2, 0.6, 0, SQUARE), ("b", 3, 0.7, 0, SQUARE)], 0), ([("a", 2, 0.6, 0, SQUARE), ("b", 2, 0.4, 0, SQUARE)], 0)])
def test_agreement(spark, rows, n):
    got = detections(spark, rows).select(M.agreed(F.col("a"), F.col("b"), 0.3, 0.5).alias("s")).first()["s"]
    assert len(got) == n and all(b["confidence"] == 0.7 for b in got)


def test_union_adds_models_and_drifts(spark):
    got = detections(spark, [("a", 2, 0.5, 0, SQUARE), ("b", 3, 0.9, 0, (2.0, 0.0, 12.0, 10.0)), ("b", 0, 0.4, 0, SQUARE)]).select(M.united(F.col("a"), F.col("b")).alias("s")).first()["s"]
    assert [(b["x1"], b["models"]) for b in got] == [(2.0, ["a", "b"]), (0.0, ["b"])]


def test_novel_instances(spark):
    df = detections(spark, [("a", 2, 0.9, 0, SQUARE), ("b", 3, 0.8, 0, (1.0, 1.0, 5.0, 5.0)), ("b", 0, 0.7, 0, SQUARE), ("b", 2, 0.6, 0, (50.0, 0.0, 60.0, 10.0))])
    got = df.select(M.novel(F.col("a"), F.col("b")).alias("s")).first()["s"]
    assert [(b["class_id"], b["confidence"]) for b in got] == [(0, 0.7), (2, 0.6)]


def test_differences(spark):
    df = detections(spark, [("a", 2, 0.9, 0, SQUARE), ("a", 2, 0.8, 0, SQUARE), ("b", 2, 0.8, 0, SQUARE), ("b", 0, 0.8, 0, SQUARE)])
    assert tuple(df.select(M.differences(F.col("a"), F.col("b")).alias("d")).first()["d"]) == (1, 1, 1)


def test_gate(spark):
    gains = spark.createDataFrame([("x", v - 0.43) for v in (0.436, 0.436, 0.436)] + [("y", v - 0.43) for v in (0.42, 0.46, 0.46)], "m string, v double")
    got = {r["m"]: r["passed"] for r in A.acceptance(A.replicas(gains, ["m"], "v")).collect()}
    assert got == {"x": True, "y": False}


def test_crop_edges_and_privacy(spark):
    crop = lit_box(0, 0, 100, 100)
    edge = lambda *b: value(spark, G.at_inner_edge(lit_box(*b), crop, F.lit(200.0), F.lit(100.0)))
    assert (edge(90, 10, 99, 20), edge(10, 10, 20, 99), edge(10, 10, 20, 20)) == (True, False, False)
    assert tuple(value(spark, G.privacy_rectangle(lit_box(10, 10, 30, 50), F.lit(32), F.lit(100)))) == (8, 6, 32, 54, 8)
