"""Exact parts against enumeration; numbering without one task."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from sieveline.operators import exact_parts as E
from sieveline.operators.ranking import numbered


def reachable(groups, parts):
    """All sizes of all parts, by trying every deal."""
    found = set()
    for deal in itertools.product(range(parts), repeat=len(groups)):
        sums = [0] * parts
        for g, p in zip(groups, deal, strict=True):
            sums[p] += g
        found.add(tuple(sums))
    return found


def test_plan_equals_enumeration():
    r, told = random.Random(3), [0, 0]
    for _ in range(150):
        parts = r.choice([2, 3])
        groups = [r.choice([1, 2, 3, 5, 7, 11]) * r.choice([1, 2]) for _ in range(r.randint(1, 7))]
        total = sum(groups)
        cuts = sorted(r.randint(0, total) for _ in range(parts - 1))
        sizes = [b - a for a, b in zip([0, *cuts], [*cuts, total], strict=True)]
        histogram = {s: groups.count(s) for s in set(groups)}
        every = reachable(groups, parts)
        if tuple(sizes) in every:
            chosen = E.plan(histogram, sizes)
            assert [sum(s * n for s, n in c.items()) for c in chosen] == sizes[:-1]
            assert all(sum(c.get(s, 0) for c in chosen) <= n for s, n in histogram.items())
            told[0] += 1
        else:
            with pytest.raises(E.Unreachable) as error:
                E.plan(histogram, sizes)
            off = lambda x: sum(abs(a - b) for a, b in zip(x[:-1], sizes[:-1], strict=True))
            assert tuple(error.value.nearest) in every and off(error.value.nearest) == min(map(off, every))
            told[1] += 1
    assert min(told) > 20


def test_large_histograms_are_met_over_a_reserve():
    histogram = {1: 40_000_000, 2: 3_000_000, 17: 90_001, 1000: 77, 250_000: 3}
    total = sum(s * n for s, n in histogram.items())
    sizes = [total // 10, total // 10 + 1, total - 2 * (total // 10) - 1]
    chosen = E.plan(histogram, sizes)
    assert [sum(s * n for s, n in c.items()) for c in chosen] == sizes[:-1]
    assert all(sum(c[s] for c in chosen) <= n for s, n in histogram.items())


def test_groups_stay_whole_with_nulls_and_a_hot_group(spark):
    names = [None] * 7 + ["hot"] * 400 + [f"g{i % 200}" for i in range(500)] + [f"s{i}" for i in range(93)]
    rows = spark.createDataFrame(list(enumerate(names)), "id long, g string").withColumn("split_", F.lit(1))
    found = E.exact_group_split(rows, "g", [("a", 123), ("b", 77), ("rest", 800)]).collect()
    assert len(found) == 1000 and len({r.id for r in found}) == 1000
    sizes = {p: sum(r.split == p for r in found) for p in ("a", "b", "rest")}
    assert sizes == {"a": 123, "b": 77, "rest": 800}
    assert all(len({r.split for r in found if r.g == n}) == 1 for n in set(names))
    again = E.exact_group_split(rows.repartition(5), "g", [("a", 123), ("b", 77), ("rest", 800)]).collect()
    assert {(r.id, r.split) for r in found} == {(r.id, r.split) for r in again}
    with pytest.raises(E.Unreachable):
        E.exact_group_split(rows.where("g = 'hot'"), "g", [("a", 100), ("rest", 300)])
    assert E.exact_group_split(rows.where("false"), "g", [("a", 0), ("rest", 0)]).collect() == []


def test_numbers_of_a_total_order_need_no_single_task(spark):
    rows = spark.range(5000).repartition(6).withColumn("k", F.col("id") % 7)
    found = numbered(rows, [F.desc("k"), F.col("id")], "n")
    want = {i: n for n, i in enumerate(sorted(range(5000), key=lambda i: (-(i % 7), i)), 1)}
    assert {r.id: r.n for r in found.collect()} == want
    assert "Window" not in found._jdf.queryExecution().toString()
    assert numbered(rows.where("id < 0"), [F.col("id")]).collect() == []
    assert sorted(r.number for r in numbered(rows.select("k"), [F.col("k")]).collect()) == list(range(1, 5001))
