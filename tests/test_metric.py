"""Similarity joins by metric partitioning against brute force; how much of the work clusters save."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.operators import dedup, joins, metric


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(metric, "BLOCK", 60)
    monkeypatch.setattr(metric, "SAMPLE", 80)


def clustered(seed, n, dims=8, groups=12, spread=0.15):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    x = centres[rng.integers(groups, size=n)] + spread * rng.normal(size=(n, dims))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def even(seed, n, dims=8):
    x = np.random.default_rng(seed).normal(size=(n, dims))
    return x * np.random.default_rng(seed + 1).uniform(0.2, 3, (n, 1))  # of any length


def table(spark, x, first=0):
    return spark.createDataFrame([(first + i, [float(v) for v in row]) for i, row in enumerate(x)], "id long, v array<double>").repartition(4)


def all_pairs(x, least):
    s = x @ x.T
    return {(i, j) for i in range(len(x)) for j in range(i + 1, len(x)) if s[i, j] >= least}


@pytest.mark.parametrize(("make", "least"), [(clustered, 0.9), (even, 4.0), (clustered, -0.2)])
def test_pairs_equal_brute_force(spark, small, make, least):
    x = make(3, 400)
    x[300:] = x[300]  # a fourth of the rows are copies
    got = [(r["left_id"], r["right_id"]) for r in joins.cosine_pairs(table(spark, x), "v", "id", least).collect()]
    assert len(got) == len(set(got)) and set(got) == all_pairs(x, least)


def test_pairs_of_mixed_lengths_and_odd_vectors(spark, small):
    x, y = clustered(4, 150), clustered(5, 130, dims=3)
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(1000 + i, [float(v) for v in r]) for i, r in enumerate(y)]
    odd = [(2000, None), (2001, []), (2002, [None] * 8), (2003, [float("nan")] * 8), (2004, [float("inf")] * 8), (None, [1.0] * 8), (2005, [1.0] * 5)]
    df = spark.createDataFrame([*rows, *odd], "id long, v array<double>")
    want = all_pairs(x, 0.8) | {(1000 + i, 1000 + j) for i, j in all_pairs(y, 0.8)}
    assert {(r["left_id"], r["right_id"]) for r in joins.cosine_pairs(df, "v", "id", 0.8).collect()} == want
    assert joins.cosine_pairs(df.limit(0), "v", "id", 0.8).collect() == []


@pytest.mark.parametrize("make", [clustered, even])
def test_best_pairs_equal_brute_force(spark, small, make):
    x = make(6, 300)
    x[250:] = x[250]  # ties
    s = x @ x.T
    want = sorted(((-round(float(s[i, j]), 9), i, j) for i in range(300) for j in range(i + 1, 300)))[:70]
    got = joins.cosine_pairs(table(spark, x), "v", "id", float("-inf"), best=70).collect()
    assert sorted((-round(r["cosine"], 9), r["left_id"], r["right_id"]) for r in got) == want


@pytest.mark.parametrize("make", [clustered, even])
def test_nearest_existing_equals_brute_force(spark, small, make):
    x, y = make(7, 250), make(8, 330)
    got = {r["id"]: r["similarity"] for r in joins.nearest_existing(table(spark, x), table(spark, y), "v", "id").collect()}
    assert np.allclose([got[i] for i in range(250)], (x @ y.T).max(1), atol=1e-12, rtol=0)
    none = joins.nearest_existing(table(spark, x[:3]), table(spark, y).limit(0), "v", "id").collect()
    assert sorted(tuple(r) for r in none) == [(0, None), (1, None), (2, None)]


def test_copies_have_one_similarity(spark, small):
    """To the last bit, so that ties among copies are ties."""
    x, y = even(9, 200), even(10, 150)
    x[100:] = x[100]
    got = {r["id"]: r["similarity"] for r in joins.nearest_existing(table(spark, x), table(spark, y), "v", "id").collect()}
    assert len({got[i] for i in range(100, 200)}) == 1


def test_bands_equal_all_pairs(spark, small):
    x = clustered(11, 200)
    df = table(spark, x)
    bands = [("high", 0.95, 2, 9), ("middle", 0.5, 0.95, 7), ("low", 0.2, 0.5, 400)]
    got = dedup.banded_sample(metric.Blocks(df, "v", "id"), bands)
    named = F.coalesce(*[F.when((F.col("cosine") >= low) & (F.col("cosine") < high), F.lit(n)) for n, low, high, _ in bands])
    from sieveline.functions.scalars import stable_rank

    every = joins.cosine_pairs(df, "v", "id", 0.2).withColumn("band", named).withColumn("h", stable_rank("band", "left_id", "right_id"))
    want = {}
    for r in every.orderBy("h").collect():
        want.setdefault(r["band"], []).append((r["left_id"], r["right_id"]))
    for name, *_, number in bands:
        assert [(r["left_id"], r["right_id"]) for r in got.where(F.col("band") == name).orderBy("rank").collect()] == want[name][:number]


def test_clusters_save_work_and_even_vectors_do_not(spark, small):
    few, pages = metric.met_share(metric.Blocks(table(spark, clustered(12, 1500, 16, 10, 0.05)), "v", "id"), 0.9)
    assert few < 0.4 and pages < 0.4
    x = np.random.default_rng(13).normal(size=(600, 64))
    even_share, _ = metric.met_share(metric.Blocks(table(spark, x / np.linalg.norm(x, axis=1, keepdims=True)), "v", "id"), 0.35)
    assert even_share > 0.9
