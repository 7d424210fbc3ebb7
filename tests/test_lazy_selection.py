"""Choices over whole tables against the sequential kernels, with few rows held so that scans repeat."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.functions.scalars import SEED, UNIT
from sieveline.operators import lazy, selection


def rank(*parts):
    import hashlib

    return hashlib.sha256(UNIT.join([SEED, *map(str, parts)]).encode()).hexdigest()


@pytest.fixture
def few(monkeypatch):
    monkeypatch.setattr(lazy, "HELD", 60)


def table(spark, seed, n=300, copies=True):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 6))
    if copies:
        x[n // 2 :] = x[rng.integers(n // 2, size=n - n // 2)]
    rows = [(i, [float(v) for v in x[i]], f"g{rng.integers(12)}", f"s{rng.integers(3)}", int(rng.integers(5))) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v array<double>, g string, s string, label int").repartition(5)
    return df, x, rows


def order_of(df, *columns):
    return [tuple(r) for r in df.orderBy("position").select(*columns).collect()]


@pytest.mark.parametrize("cap", [None, 2])
@pytest.mark.parametrize("seeded", [False, True])
def test_diverse_equals_the_kernel(spark, few, cap, seeded):
    df, x, rows = table(spark, 1)
    seeds = x[:7] if seeded else None
    want = selection.farthest_first(x, [rank(r[0]) for r in rows], 20, groups=[r[2] for r in rows] if cap else None, cap=cap, seeds=seeds)
    got = lazy.diverse(df, "v", "id", 20, group="g", cap=cap, seeds=df.where("id < 7").select("v") if seeded else None)
    assert [i for i, in order_of(got, "id")] == want


def test_diverse_within_labels_and_null_labels(spark, few):
    df, x, rows = table(spark, 2)
    df = df.withColumn("label", F.when(F.col("label") < 4, F.col("label")))
    got = {}
    for r in lazy.diverse(df, "v", "id", 6, by=["label"]).orderBy("position").collect():
        got.setdefault(r["label"], []).append(r["id"])
    for label in (0, 1, 2, 3, None):
        own = [i for i, r in enumerate(rows) if r[4] == (4 if label is None else label)]
        assert got[label] == [own[k] for k in selection.farthest_first(x[own], [rank(i) for i in own], 6)]


def test_excluded_rows_count_for_their_groups(spark, few):
    df, x, rows = table(spark, 3)
    out = df.where("id % 9 = 0")
    got = [i for i, in order_of(lazy.diverse(df, "v", "id", 10, group="g", cap=4, excluded=out), "id")]
    used = {}
    for r in rows:
        if r[0] % 9 == 0:
            used[r[2]] = used.get(r[2], 0) + 1
    closest, want = np.full(len(rows), -np.inf), []
    while len(want) < 10 and (fit := [i for i, r in enumerate(rows) if r[0] % 9 and i not in want and used.get(r[2], 0) < 4]):
        best = min(fit, key=lambda i: (closest[i], rank(i)))
        want.append(best)
        used[rows[best][2]] = used.get(rows[best][2], 0) + 1
        closest = np.maximum(closest, lazy.similarity(x, x[best]))
    assert got == want
    with pytest.raises(ValueError, match="of 50"):
        lazy.diverse(df, "v", "id", 50, group="g", cap=2, shortfall=False)


def test_more_asked_than_there_is_and_no_rows(spark):
    df, x, _ = table(spark, 4, 12, copies=False)
    assert sorted(i for i, in order_of(lazy.diverse(df, "v", "id", 99), "id")) == list(range(12))
    assert lazy.diverse(df.limit(0), "v", "id", 3).collect() == []
    assert lazy.diverse(df.withColumn("v", F.when(F.col("id") > 2, F.col("v"))), "v", "id", 99).count() == 9


def test_few_scans(spark, monkeypatch):
    """Many choices come from one scan once some rows are held."""
    df, _, _ = table(spark, 5, 3000, copies=False)
    search = lazy.Farthest(lazy._rows(df, "v", "id"))
    search.run(lambda k: len(search.picks[k]) >= 80)
    assert len(search.picks[""]) == 80 and search.scans <= 3
    monkeypatch.setattr(lazy, "HELD", 600)
    again = lazy.Farthest(lazy._rows(df, "v", "id"))
    again.run(lambda k: len(again.picks[k]) >= 80)
    assert [p["id"] for p in again.picks[""]] == [p["id"] for p in search.picks[""]] and again.scans <= 12


def test_quotas_equal_the_kernel(spark, few):
    df, x, rows = table(spark, 6)
    df = df.withColumn("f", F.array_compact(F.array(F.when(F.col("id") % 5 == 0, "small"), F.when(F.col("id") % 7 == 0, "occluded"))))
    features = [{n for n, k in (("small", 5), ("occluded", 7)) if i % k == 0} for i in range(len(rows))]
    minimums, strata = [("small", 10), ("occluded", 8)], {"s0": 12, "s1": 10, "s2": 8}
    want = selection.quota_selection([{"group": r[2], "stratum": r[3], "features": f} for r, f in zip(rows, features, strict=True)], x, [rank(r[0]) for r in rows], minimums, strata, 3)
    got = lazy.diverse_by_quota(df, "id", "v", "g", "s", "f", minimums=minimums, strata=strata, cap=3)
    assert [i for i, in order_of(got, "id")] == want


def slow_categories(x, rows, tests, quotas, seeds, cap, total):
    """Each category's rows in turn, against the seeds while nothing is chosen and then against the chosen alone."""
    chosen, names, used = [], [], {}
    for (name, test), quota in zip(tests, [*quotas, None], strict=True):
        against = [x[i] for i in chosen] if chosen else list(seeds)
        closest = np.full(len(x), -np.inf)
        for c in against:
            closest = np.maximum(closest, lazy.similarity(x, c))
        number = quota if quota is not None else total - len(chosen)
        for _ in range(number):
            fit = [i for i in range(len(x)) if test(i) and i not in chosen and used.get(rows[i][2], 0) < cap]
            if not fit:
                break
            best = min(fit, key=lambda i: (closest[i], rank(i)))
            chosen.append(best)
            names.append(name)
            used[rows[best][2]] = used.get(rows[best][2], 0) + 1
            closest = np.maximum(closest, lazy.similarity(x, x[best]))
    return list(zip(chosen, names, strict=True))


def test_categories_in_turn(spark, few):
    df, x, rows = table(spark, 7)
    tests = [("a", lambda i: i % 4 == 0), ("b", lambda i: i % 3 == 0), ("rare", lambda i: i in (5, 11)), ("fill", lambda i: i % 4 != 0)]
    seeds = np.random.default_rng(9).normal(size=(4, 6))
    have = spark.createDataFrame([([float(v) for v in s],) for s in seeds], "v array<double>")
    got = lazy.diverse_by_category(
        df, "id", "v", "g", categories=[("a", F.expr("id % 4 = 0"), 6), ("b", F.expr("id % 3 = 0"), 7), ("rare", F.col("id").isin(5, 11), 5)],
        fill=("fill", F.expr("id % 4 <> 0")), total=25, cap=4, seeds=have,
    )
    assert order_of(got, "id", "category") == slow_categories(x, rows, tests, [6, 7, 5], seeds, 4, 25)


@pytest.mark.parametrize("order", ["capacity-site-group-near", "group-near-capacity", "site-near-group-capacity"])
@pytest.mark.parametrize("maximum", [1, 20, 500])
def test_admission_equals_the_kernel(spark, few, order, maximum):
    df, x, rows = table(spark, 8)
    turn = sorted(range(len(rows)), key=lambda i: (rows[i][4], rank(i)))
    limits = {"most": 3.0, "group_cap": 6, "site_cap": 15}
    want = selection.near_free(x[turn], [rows[i][2] for i in turn], [rows[i][3] for i in turn], maximum=maximum, order=order, existing=x[:2] * 0.5, **limits)
    if "site" not in order:
        want = selection.near_free(x[turn], [rows[i][2] for i in turn], ["z"] * len(turn), maximum=maximum, order=order, existing=x[:2] * 0.5, most=3.0, group_cap=6, site_cap=10**9)
    have = spark.createDataFrame([([float(v) * 0.5 for v in x[i]],) for i in range(2)], "v array<double>")
    got = dict(tuple(r) for r in lazy.admitted(df, "id", "v", "g", "s", [F.col("label")], maximum=maximum, order=order, existing=have, **limits).collect())
    assert [got[i] for i in turn] == want


def test_admission_by_hash_equals_the_kernel(spark, few):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    bits = np.array([base[rng.integers(40)] ^ np.uint64(int(rng.integers(2)) << int(rng.integers(64))) for _ in range(400)], np.uint64)
    rows = [(i, int(np.int64(b.view(np.int64))), f"g{i % 30}") for i, b in enumerate(bits)]
    df = spark.createDataFrame(rows, "id long, b long, g string").repartition(5)
    turn = sorted(range(400), key=lambda i: (-(i % 7), rank(i)))
    want = selection.hash_free(bits[turn], [f"g{i % 30}" for i in turn], ["z"] * 400, most=2, group_cap=2, site_cap=10**9, maximum=30)
    got = dict(tuple(r) for r in lazy.admitted_by_hash(df, "id", "b", "g", "g", [-(F.col("id") % 7)], most=2, group_cap=2, maximum=30).collect())
    assert [got[i] for i in turn] == want


def test_no_rows_to_admit(spark):
    df, _, _ = table(spark, 1, 10)
    limits = {"most": 3.0, "group_cap": 6, "site_cap": 15, "maximum": 4}
    assert lazy.admitted(df.limit(0), "id", "v", "g", "s", [F.col("label")], **limits).collect() == []


def test_validation_queue_equals_the_pool_version(spark, few):
    rng = np.random.default_rng(4)
    base = [f"{int(b):016x}" for b in rng.integers(0, 1 << 62, 50)]
    rows = [(i, base[rng.integers(50)], f"g{rng.integers(20)}", f"s{rng.integers(9)}", float(rng.integers(5)) / 4, int(rng.integers(2))) for i in range(300)]
    df = spark.createDataFrame(rows, "id long, phash string, g string, s string, confidence double, small int").repartition(4)
    limits = {"most": 6, "group_cap": 2, "site_cap": 8, "maximum": 25}
    names = ("id", "phash", "g", "s", "confidence", "small")
    want = sorted(map(tuple, selection.validation_queue(df, *names, **limits).collect()))
    assert sorted(map(tuple, lazy.validation_queue(df, *names, **limits).collect())) == want
    with pytest.raises(ValueError, match="sites in the queue"):
        lazy.validation_queue(df, *names, minimum_sites=10, **limits)
    assert lazy.validation_queue(df.limit(0), *names, minimum_sites=10, **limits).collect() == []
