"""Joins, suppression and curves of boxes against plain loops."""

import numpy as np
import pytest

from sieveline.operators import curves, spatial
from sieveline.operators import matching as M


def iou(a, b):
    w, h = min(a[2], b[2]) - max(a[0], b[0]), min(a[3], b[3]) - max(a[1], b[1])
    both = max(w, 0.0) * max(h, 0.0)
    union = max(a[2] - a[0], 0.0) * max(a[3] - a[1], 0.0) + max(b[2] - b[0], 0.0) * max(b[3] - b[1], 0.0) - both
    return both / union if union > 0 else 0.0


def scene(seed, n):
    """Boxes of sides from 1/4 to 512, negative corners, sides of exact powers of two, copies, and some without an area."""
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        x, y = (float(v) for v in np.round(rng.uniform(-300, 300, 2), 2))
        w, h = (float(v) for v in (2.0 ** rng.integers(-2, 10, 2) if i % 3 else np.round(rng.uniform(1, 200, 2), 2)))
        rows.append((["a", "b", None][i % 3 if i % 7 else 0], i, x, y, x + w, y + (0.0 if i % 29 == 5 else h)))
    return rows + [(k, n + j, *box) for j, (k, _, *box) in enumerate(rows[: n // 5])]


SIDE = "k string, {0} long, {0}1 double, {0}2 double, {0}3 double, {0}4 double"


def sides(spark, left, right):
    from pyspark.sql import functions as F

    made = []
    for n, rows in (("l", left), ("r", right)):
        df = spark.createDataFrame(rows, SIDE.format(n))
        made.append(df.select("k", n, F.struct(*[F.col(f"{n}{i + 1}").alias(c) for i, c in enumerate(spatial.SIDES)]).alias(f"{n}_box")))
    return made


@pytest.mark.parametrize("least", [None, 0.1, 0.5, 1.0])
def test_overlapping_equals_all_pairs(spark, least):
    left, right = scene(1, 150), scene(2, 120) + scene(1, 40)
    right = [(k, i, *box) for i, (k, _, *box) in enumerate(right)] + [("a", 999, None, 0.0, 1.0, 1.0), ("a", 998, float("nan"), 0.0, 1.0, 1.0), ("a", 997, 0.0, 0.0, float("inf"), 1.0)]
    found = spatial.overlapping(*sides(spark, left, right), ["k"], "l_box", "r_box", least).select("l", "r").collect()
    want = {(a[1], b[1]) for a in left for b in right[:-3] if a[0] == b[0] and (iou(a[2:], b[2:]) > 0 if least is None else iou(a[2:], b[2:]) >= least)}
    assert len(found) == len(set(map(tuple, found))) and set(map(tuple, found)) == want and want


def test_overlapping_without_rows_and_with_a_bad_floor(spark):
    l, r = sides(spark, [], scene(3, 5))  # noqa: E741
    assert spatial.overlapping(l, r, ["k"], "l_box", "r_box").count() == 0
    with pytest.raises(ValueError):
        spatial.overlapping(l, r, ["k"], "l_box", "r_box", 0.0)


@pytest.mark.parametrize("seed", [4, 5])
def test_suppress_in_rounds_equals_the_fold(spark, seed):
    rng = np.random.default_rng(seed)
    rows = [(k, i, *box, float(rng.integers(0, 20)) / 20, i % 3, f"x{i}") for k, i, *box in scene(seed, 120)]
    df = spark.createDataFrame(rows, "k string, row long, x1 double, y1 double, x2 double, y2 double, confidence double, view int, extra string")
    fold = {r["row"] for r in M.suppress(df, ["k"], ["extra"]).collect()}
    rounds = spatial.suppress(df, ["k"])
    assert rounds.columns == df.columns and {r["row"] for r in rounds.collect()} == fold and len(fold) < len(rows)
    assert spatial.suppress(df.limit(0), ["k"]).count() == 0


def test_a_scene_of_fifty_thousand_boxes(spark):
    from pyspark.sql import functions as F

    i = F.col("id")
    x, y = i % 250 * 40.0, F.floor(i / 250) * 40.0
    side = lambda n, move: spark.range(50_000).select(i.alias(n), F.struct((x + move).alias("x1"), y.alias("y1"), (x + move + 40).alias("x2"), (y + 40).alias("y2")).alias(f"{n}_box"))
    assert spatial.overlapping(side("l", 0.0), side("r", 10.0), [], "l_box", "r_box", 0.5).where("l = r").count() == 50_000


def plain_curve(predictions, targets, levels):
    """class -> (targets, predictions, [average precision], f1) by loops; predictions: (scene, p, class, confidence, box)."""
    out = {}
    for c in {t[2] for t in targets}:
        ts, ps = [t for t in targets if t[2] == c], sorted((p for p in predictions if p[2] == c), key=lambda p: (-p[3], p[0], p[1]))
        speaks = {}
        for p in ps:
            near = [(iou(p[4], t[3]), -t[1], t) for t in ts if t[0] == p[0]]
            if near:
                speaks[p[:2]] = max(near)
        aps, best_f1 = [], 0.0
        for n, least in enumerate(levels):
            taken, k, points = set(), 0, []
            for place, p in enumerate(sorted(ps, key=lambda p: (-p[3], p[0], p[1])), 1):
                share, _, t = speaks.get(p[:2], (0.0, 0, None))
                if t is not None and share >= least and t[:2] not in taken:
                    taken.add(t[:2])
                    k += 1
                points.append((k / len(ts), k / place))
                best_f1 = max(best_f1, 2 * k / (place + len(ts))) if n == 0 else best_f1
            aps.append(sum(max((pr for re, pr in points if re >= r / 100 - 1e-12), default=0.0) for r in range(101)) / 101)
        out[c] = (len(ts), len(ps), aps, best_f1)
    return out


def test_average_precision_equals_loops(spark):
    rng = np.random.default_rng(8)
    targets, predictions = [], []
    for s in range(12):
        for t in range(int(rng.integers(0, 9))):
            x, y, w, h = (float(v) for v in rng.integers(0, 60, 2).tolist() + rng.integers(20, 60, 2).tolist())
            targets.append((s, t, int(rng.integers(0, 3)), (x, y, x + w, y + h)))
            for p in range(int(rng.integers(0, 4))):
                m = float(rng.integers(0, 12))
                predictions.append((s, t * 10 + p, targets[-1][2] if rng.random() < 0.8 else 7, float(rng.integers(0, 10)) / 10, (x + m, y, x + w + m, y + h)))
    targets += [(99, 0, 5, (0.0, 0.0, 9.0, 9.0))]
    p = spark.createDataFrame([(s, i, c, f, *b) for s, i, c, f, b in predictions], "image long, p long, class_id int, confidence double, x1 double, y1 double, x2 double, y2 double")
    t = spark.createDataFrame([(s, i, c, *b) for s, i, c, b in targets], "image long, t long, class_id int, x1 double, y1 double, x2 double, y2 double")
    want = plain_curve(predictions, targets, curves.LEVELS)
    for parts in (1, 5):
        rows = {r["class_id"]: r for r in curves.average_precision(p.repartition(parts), t, ["image"]).collect()}
        assert set(rows) == {*want, None} and want[5][2] == [0.0] * 10
        for c, (n, m, aps, f1) in want.items():
            assert (rows[c]["targets"], rows[c]["predictions"]) == (n, m)
            assert rows[c]["ap"] == pytest.approx(aps, abs=1e-12) and rows[c]["f1"] == pytest.approx(f1, abs=1e-12)
        assert rows[None]["mean_ap"] == pytest.approx(np.mean([w[2] for w in want.values()]), abs=1e-12)
    assert curves.average_precision(p, t.limit(0), ["image"]).count() == 0
