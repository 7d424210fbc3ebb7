"""Relational operators, selections, files and incremental runs."""

import hashlib
import io
import json
import tarfile
import zipfile
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.functions import pixels
from sieveline.functions import scalars as S
from sieveline.operators import aggregates, dedup, joins, ledger, projections, ranking, selection, splits
from sieveline.operators.graph import components
from sieveline.sources import readers, writers
from sieveline.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


# ---- scalars


def test_stable_rank_is_plain_sha(spark):
    import hashlib

    want = hashlib.sha256("\x1f".join(["20260826", "a", "", "7"]).encode()).hexdigest()
    assert one(spark, S.stable_rank(F.lit("a"), F.lit(None), F.lit(7))) == want


@pytest.mark.parametrize(("value", "want"), [(2.5, 2), (3.5, 4), (-0.5, 0)])
def test_rounding_to_even(spark, value, want):
    assert one(spark, S.half_even(F.lit(value))) == want


def test_shares_sum_up(spark):
    for total, parts in ((10, 4), (3, 5), (0, 2)):
        got = [one(spark, S.share(total, parts, F.lit(i))) for i in range(parts)]
        assert sum(got) == total and max(got) - min(got) <= 1


def test_bits_of_hex(spark):
    assert one(spark, S.hash_bits(F.lit("ffffffffffffffff"))) == -1
    assert one(spark, S.hamming(S.hash_bits(F.lit("f" * 16)), S.hash_bits(F.lit("0" * 15 + "1")))) == 63
    assert one(spark, S.hash_bits(F.lit("xyz"))) is None


def test_vectors(spark):
    v = lambda *x: F.array(*[F.lit(float(i)) for i in x])
    assert one(spark, S.dot(v(1, 2), v(3, 4))) == 11
    assert one(spark, S.unit_vector(v(3, 4))) == [0.6, 0.8]
    assert one(spark, S.unit_vector(v(0, 0))) is None and one(spark, S.unit_vector(v(float("nan"), 1))) is None


def test_slug(spark):
    assert one(spark, S.slug(F.lit(" A b/C..jpg-"))) == "a-b-c..jpg"
    assert one(spark, S.slug(F.lit("///"))) is None and one(spark, S.slug(F.lit("x" * 121))) is None


def test_perceptual_hash_tells_images_apart(spark):
    rng = np.random.default_rng(0)
    image = rng.random((32, 32)).cumsum(0)
    near, far = image + rng.normal(0, 0.01, image.shape), rng.random((32, 32)).cumsum(1)
    h = [int(x, 16) for x in pixels.perceptual_hashes(np.stack([i.ravel() for i in (image, near, far)]))]
    assert (h[0] ^ h[1]).bit_count() <= 6 < (h[0] ^ h[2]).bit_count()
    df = spark.createDataFrame([([float(x) for x in image.ravel()],), ([1.0],), (None,)], "g array<double>")
    assert [r[0] for r in df.select(pixels.perceptual_hash(F.col("g"))).collect()] == [f"{h[0]:016x}", None, None]


# ---- ledger and joins


def test_reasons(spark):
    df = ledger.with_reasons(spark.createDataFrame([(1, 5), (2, None), (3, 50)], "id int, n int"), {"small": F.col("n") < 10, "odd": F.col("id") % 2 == 1})
    assert [(r["id"], r["reason_code"]) for r in ledger.ledger(df, ["id"], "s").orderBy("id", "reason_code").collect()] == [(1, "odd"), (1, "small"), (3, "odd")]
    assert [r["id"] for r in ledger.accepted(df).collect()] == [2]
    with pytest.raises(ValueError, match="missing columns: x"):
        ledger.require_columns(df, ["id", "x"])
    with pytest.raises(PermissionError):
        ledger.guard_sealed(df.withColumn("split", F.lit("sealed")), "split", "sealed", False)


def test_blank_hashes_match_nothing(spark):
    rows, used = spark.createDataFrame([(1, ""), (2, "a"), (3, None)], "id int, h string"), spark.createDataFrame([("",), ("a",), (None,)], "h string")
    assert sorted(r["id"] for r in joins.exclude(rows, [(used, "h")]).collect()) == [1, 3]
    assert sorted(r["id"] for r in joins.exclude(rows, [(used, "h")], blank_matches=True).collect()) == [3]


def test_hamming_pairs_equal_brute_force(spark):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(-(2**62), 2**62, 20)]
    values = base + [b ^ sum(1 << int(k) for k in rng.choice(62, n, replace=False)) for b in base for n in (2, 5, 7)]
    got = {(r["left_id"], r["right_id"]): r["hamming"] for r in joins.hamming_pairs(spark.createDataFrame(list(enumerate(values)), "id long, b long"), "b", "id", 5).collect()}
    mask = (1 << 64) - 1
    want = {(i, j): n for i, a in enumerate(values) for j, b in enumerate(values) if i < j and (n := ((a ^ b) & mask).bit_count()) <= 5}
    assert got == want


@pytest.mark.parametrize("most", [0, 2, 12])
def test_hamming_pairs_link_copies_to_their_class(spark, most):
    rng = np.random.default_rng(most)
    base = [int(x) for x in rng.integers(0, 2**60, 30)]
    values = [*base, *base[:9], *base[:9], *(b ^ sum(1 << int(k) for k in rng.choice(60, n, replace=False)) for b in base for n in (1, 2, 6, 12)), None, None]
    got = [(r["left_id"], r["right_id"], r["hamming"]) for r in joins.hamming_pairs(spark.createDataFrame(list(enumerate(values)), "id long, b long"), "b", "id", most, 60).collect()]
    first = {v: i for i, v in reversed(list(enumerate(values))) if v is not None}
    want = {(i, j, n) for a, i in first.items() for b, j in first.items() if i < j and (n := (a ^ b).bit_count()) <= most}
    want |= {(first[v], i, 0) for i, v in enumerate(values) if v is not None and i != first[v]}
    assert len(got) == len(set(got)) and set(got) == want


def test_class_links_count_what_pairs_would(spark):
    df = spark.createDataFrame([(5, "a"), (3, "a"), (9, "a"), (1, "b"), (2, None), (4, None)], "id int, k string")
    assert sorted(map(tuple, joins.class_links(df, "k", "id").collect())) == [(3, 3, 2), (5, 3, 2), (9, 3, 2)]
    assert not joins.class_links(df.limit(0), "k", "id").collect()


def test_vectors_of_other_lengths_do_not_pair(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (3, [1.0, 0.1]), (4, None), (5, [None, 1.0]), (6, [1.0, 0.0, 0.2])], "id long, v array<double>")
    assert sorted((r["left_id"], r["right_id"]) for r in joins.cosine_pairs(df, "v", "id", 0.5, 2).collect()) == [(1, 3), (2, 6)]
    near = {r["id"]: r["similarity"] for r in joins.nearest_existing(df.where("id IN (1, 2, 4)"), df.where("id = 3"), "v", "id").collect()}
    assert near == {1: 1.0, 2: None, 4: None}


@pytest.mark.parametrize("blocks", [1, 3])
def test_most_similar_pairs_have_no_floor(spark, tmp_path, blocks):
    from sieveline.plans.pairs import topk_pairs

    x = np.concatenate([np.eye(12), -np.eye(12)[:3], np.eye(12)[:2] + 0.1])
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    want = sorted(((float(x[i] @ x[j]), i, j) for i in range(len(x)) for j in range(i + 1, len(x))), key=lambda t: (-t[0], t[1], t[2]))[:50]
    got = joins.cosine_pairs(df, "embedding", "vec_id", float("-inf"), blocks, best=50).orderBy(F.desc("cosine"), "left_id", "right_id").limit(50).collect()
    assert [(r["left_id"], r["right_id"]) for r in got] == [(i, j) for _, i, j in want]
    df.write.parquet(f"{tmp_path}/embeddings.parquet")
    assert [(r["left_id"], r["right_id"]) for r in topk_pairs(spark, str(tmp_path)).collect()] == [(i, j) for _, i, j in want]


@pytest.mark.parametrize("all_pairs", [20_000, 0])
def test_calibration_controls_come_from_all_row_pairs(spark, tmp_path, monkeypatch, all_pairs):
    from sieveline.plans.pairs import calibration_sample

    monkeypatch.setattr(dedup, "ALL_PAIRS", all_pairs, raising=False)
    x = np.random.default_rng(9).normal(size=(150, 32))
    x[:12] = x[0] + x[:12] / 4
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = calibration_sample(spark, str(tmp_path)).collect()
    assert len({(r["left_id"], r["right_id"]) for r in got}) == len(got) == 40
    assert all(r["left_id"] < r["right_id"] and abs(r["cosine"] - x[r["left_id"]] @ x[r["right_id"]]) < 1e-9 for r in got)
    # the bands and the most similar fill a half, the rest are controls, most of them not similar
    kinds = Counter(r["kind"] for r in got)
    assert kinds["control"] == 20 and sum(r["kind"] == "control" and r["cosine"] < 0.25 for r in got) >= 10


@pytest.mark.parametrize("blocks", [1, 3])
def test_cosine_pairs_equal_brute_force(spark, blocks):
    x = np.random.default_rng(2).normal(size=(60, 4))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    got = {(r["left_id"], r["right_id"]) for r in joins.cosine_pairs(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "id long, v array<double>"), "v", "id", 0.8, blocks).collect()}
    assert got == {(i, j) for i in range(60) for j in range(i + 1, 60) if x[i] @ x[j] >= 0.8}


def test_time_neighbours(spark):
    rows = [("a", "2024-01-01 10:00:00", True), ("a", "2024-01-01 11:00:00", False), ("a", "2024-01-01 11:00:01", False), ("b", "2024-01-01 10:30:00", False), ("a", "2024-01-01 09:30:00", False), ("a", "2024-01-01 10:00:00", False)]
    df = spark.createDataFrame(rows, "g string, t string, s boolean").withColumn("t", F.col("t").cast("timestamp"))
    assert sorted(str(r["t"])[11:] for r in joins.time_neighbours(df, "g", "t", F.col("s")).collect()) == ["09:30:00", "11:00:00"]


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (7, 7), (200, 100)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in (100, 101, 102, 200)}}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


@pytest.mark.parametrize(("links", "most"), [([(i % 7, 7 + i) for i in range(60)], 7), ([(i, i + 1) for i in range(40)], 40)])
def test_components_take_few_tasks(spark, links, most):
    """Links that are stars already need no round, and a round some three tasks a partition; before, a round took
    sixteen and the last one was made twice. most: tasks in so many times the partitions."""
    held, context = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}, spark.sparkContext
    own = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        context.setJobGroup(group := f"components-{len(links)}", "")
        found = components(spark.createDataFrame(links, "a long, b long").coalesce(1))
        jobs = [context.statusTracker().getJobInfo(i) for i in context.statusTracker().getJobIdsForGroup(group)]
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        for k, v in own.items():
            spark.conf.set(k, v)
    stages = {i for job in jobs for i in job.stageIds}
    tasks = sum(info.numCompletedTasks for i in stages if (info := context.statusTracker().getStageInfo(i)))
    assert 0 < tasks <= most * 50
    assert {r["node"]: r["root"] for r in found.collect()} == ({i: i % 7 if i < 7 else (i - 7) % 7 for i in range(67)} if most == 7 else {i: 0 for i in range(41)})


def test_duplicate_groups(spark):
    rows = spark.createDataFrame([(i,) for i in range(6)], "id long")
    got = dedup.duplicate_groups(rows, spark.createDataFrame([(0, 3), (3, 5)], "left_id long, right_id long"), "id").collect()
    assert Counter(r["members"] for r in got) == {3: 3, 1: 3} and sum(r["is_kept"] for r in got) == 4
    assert {r["replacement_id"] for r in dedup.replacement_ledger(dedup.duplicate_groups(rows, spark.createDataFrame([(0, 3)], "left_id long, right_id long"), "id"), "id").collect()} <= {0, 3}


def test_reviewed_faults(spark):
    rows = [("source_sha256", "distinct", "r"), ("phash", "distinct", "r"), ("phash", "maybe", "r"), ("phash", "duplicate", "")]
    got = dedup.reviewed_faults(spark.createDataFrame(rows, "signals string, decision string, reviewer string")).collect()
    assert sorted(r["fault"] for r in got) == ["exact_pair_distinct", "unattributed", "undecided"]


def test_resolved_edges(spark):
    rows = [("phash", 1, 1, "t", "t"), ("phash", 1, 2, "t", "t"), ("phash;sscd_auto", 1, 2, "t", "u")]
    got = dedup.resolved_edges(spark.createDataFrame(rows, "signals string, left_site int, right_site int, left_stamp string, right_stamp string")).collect()
    assert [r["resolution"] for r in got] == ["edge", "resolved_collision", "edge"]


# ---- cuts and splits


def test_cumulative_cut_stops_after_the_target(spark):
    df = spark.createDataFrame([("u", i, 4) for i in range(5)], "u string, i int, n int")
    assert [r["i"] for r in ranking.cumulative_cut(df, ["u"], [F.col("i")], "n", F.lit(9)).orderBy("i").collect()] == [0, 1, 2]


def test_split_is_leak_free_and_repeats(spark):
    rows = [(s, d, f) for s in ("a", "b") for d in range(10) for f in range(2)]
    df = spark.createDataFrame(rows, "site string, day int, frame int")
    got = splits.site_day_split(df, "site", "day").collect()
    assert sum(r["split"] == "sealed_test" for r in got) == 12
    assert all(len({r["split"] for r in got if (r["site"], r["day"]) == k}) == 1 for k in {(r["site"], r["day"]) for r in got})
    assert sorted(map(tuple, got)) == sorted(map(tuple, splits.site_day_split(df.repartition(3), "site", "day").collect()))


def test_leakage(spark):
    df = spark.createDataFrame([("train", "h1", "", ""), ("val", "h2", "h1", ""), ("val", "h3", "", "")], "split string, sha string, parent string, g string")
    assert [(r["domain"], r["value"]) for r in splits.leakage(df, "split", {"sha": ["sha", "parent"], "g": ["g"]}).collect()] == [("sha", "h1")]


def test_agreement(spark):
    first = spark.createDataFrame([(1, "confirmed_negative", "a"), (2, "confirmed_negative", "a"), (3, "object", "a"), (4, "confirmed_negative", "a")], "id int, decision string, reviewer string")
    second = spark.createDataFrame([(1, "confirmed_negative", "b"), (2, "confirmed_negative", "a"), (3, "confirmed_negative", "b"), (5, "object", "b")], "id int, decision string, reviewer string")
    got = {r["id"]: r["result"] for r in aggregates.agreement(first, second, "id").collect()}
    assert got == {1: "accepted_negative", 2: "same_reviewer", 3: "requires_resolution", 4: "missing_round", 5: "missing_round"}


# ---- selection kernels


def slow_farthest(vectors, ranks, count, groups, cap):
    chosen = []
    while len(chosen) < count:
        free = [i for i in range(len(ranks)) if i not in chosen and sum(groups[j] == groups[i] for j in chosen) < cap]
        if not free:
            break
        chosen.append(min(free, key=lambda i: (max((float(vectors[i] @ vectors[j]) for j in chosen), default=-np.inf), ranks[i])))
    return chosen


def test_farthest_first_equals_the_slow_version():
    rng = np.random.default_rng(3)
    for cap in (2, 9):
        x, ranks, groups = rng.normal(size=(40, 5)), [f"{i:04d}" for i in rng.permutation(40)], [str(i % 6) for i in range(40)]
        assert selection.farthest_first(x, ranks, 20, groups=groups, cap=cap) == slow_farthest(x, ranks, 20, groups, cap)


def test_group_cap_takes_five_of_six():
    chosen = selection.farthest_first(np.eye(7), [str(i) for i in range(7)], 6, groups=["same"] * 6 + ["different"], cap=5)
    assert sorted(i == 6 for i in chosen) == [False] * 5 + [True]


def test_prior_vectors_steer_the_choice():
    assert selection.farthest_first(np.array([[0.9, 0.1], [0.0, 1.0]]), ["a", "b"], 1, seeds=np.array([[1.0, 0.0]])) == [1]


def test_floors_are_met_by_a_supplement():
    rows = [{"classes": c, "group": g, "rank": str(i)} for i, (c, g) in enumerate([(["car"], "1"), (["truck"], "2"), (["bus"], "3"), (["car", "car"], "4")])]
    chosen, lack = selection.floors_with_swaps(rows, 2, {"truck": 1, "bus": 1}, 1)
    assert sorted(chosen) == [1, 2] and not any(lack.values())


def test_one_swap_keeps_locked_frames():
    frames = [{"classes": [c], "group": str(i), "rank": str(i), "locked": c == "person"} for i, c in enumerate(["car", "person", "motorcycle"])]
    incoming = [{"classes": ["bicycle"], "group": "9", "rank": "0"}]
    assert selection.one_swap(frames, incoming, {"person": 1, "car": 1, "bicycle": 1}, 5) == (2, 0)
    assert selection.one_swap(frames, incoming, {"bicycle": 2}, 5) is None


def slow_swap(frames, incoming, floors, cap):
    found = []
    for o, out in enumerate(frames):
        for i, into in enumerate(incoming):
            after = [f for f in frames if f is not out] + [into]
            boxes, groups = Counter(c for f in after for c in f["classes"]), Counter(f["group"] for f in after)
            if not out["locked"] and all(boxes[c] >= n for c, n in floors.items()) and groups[into["group"]] <= cap:
                found.append((len(out["classes"]) + len(into["classes"]), out["rank"], into["rank"], o, i))
    return min(found)[3:] if found else None


def test_one_swap_equals_the_slow_version():
    rng = np.random.default_rng(4)
    none = 0
    for turn in range(40):
        made = [{"classes": rng.choice(list("abc"), rng.integers(0, 4)).tolist(), "group": str(rng.integers(4)), "rank": f"{k:02}", "locked": bool(rng.random() < 0.3)} for k in rng.permutation(24)]
        frames, incoming = made[:12], made[12:]
        floors, cap = {"a": 5 + turn % 4, "b": 4}, 3 + turn % 3
        want = slow_swap(frames, incoming, floors, cap)
        none += want is None
        assert selection.one_swap(frames, incoming, floors, cap) == want
    assert 0 < none < 40


def test_swap_repair_of_tables(spark):
    rng = np.random.default_rng(8)
    kind = "id long, classes array<string>, grp string, locked boolean"
    for turn in range(3):
        rows = [(k, rng.choice(list("abc"), rng.integers(0, 4)).tolist(), str(rng.integers(4)), bool(rng.random() < 0.3)) for k in range(30)] + [(30, None, None, False), (31, ["a"] * 3, None, False)]
        order = rng.permutation(len(rows))
        frames, incoming = [rows[i] for i in order[:16]], [rows[i] for i in order[16:]]
        ranked = [[{"classes": r[1] or [], "group": r[2], "rank": hashlib.sha256(f"20260826\x1f{r[0]}".encode()).hexdigest(), "locked": r[3], "id": r[0]} for r in some] for some in (frames, incoming)]
        have = Counter(c for f in ranked[0] for c in f["classes"])
        want = slow_swap(*[ranked[0], [dict(r, locked=False) for r in ranked[1]]], {"a": have["a"] + 1, "b": have["b"]}, 6)
        got = selection.swap_repair(spark.createDataFrame(frames, kind), spark.createDataFrame(incoming, kind).drop("locked"), "id", "classes", "grp", floors={"a": have["a"] + 1, "b": have["b"]}, group_cap=6, locked="locked").collect()
        assert [tuple(r) for r in got] == ([(ranked[0][want[0]]["id"], ranked[1][want[1]]["id"])] if want else [])
    empty = spark.createDataFrame([], kind)
    assert not selection.swap_repair(empty, empty, "id", "classes", "grp", floors={"a": 1}, group_cap=1).collect()


def test_paired_bootstrap_of_odd_rows(spark):
    from sieveline.operators.splits import paired_bootstrap

    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 1.0, 0.0), (None, 1.0, 0.0), ("c", None, 1.0)], "g string, l double, r double")
    assert tuple(paired_bootstrap(df, "g", F.col("l"), F.col("r"), 200).first()[:3]) == (1.0, 1.0, 1.0)
    assert tuple(paired_bootstrap(df.limit(0), "g", F.col("l"), F.col("r"), 20).first()) == (None, None, None, 0)


def test_utc_stamp_follows_no_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        from sieveline.functions.scalars import utc_stamp

        assert spark.sql("SELECT TIMESTAMP '2026-08-26 03:04:05+02:00' AS t").select(utc_stamp(F.col("t"))).first()[0] == "2026-08-26T01:04:05Z"
        assert len(spark.range(1).select(utc_stamp()).first()[0]) == 20
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_admission_order_of_reasons():
    x = np.array([[1.0, 0, 0], [0.99, 0.1, 0], [0, 0, 1.0], [0, 0.7, 0.7]])
    limits = {"most": 0.95, "group_cap": 9, "site_cap": 9, "existing": np.array([[0, 1.0, 0]])}
    assert selection.near_free(x, list("abcd"), list("abcd"), maximum=9, **limits) == ["included", "near", "included", "included"]
    assert selection.near_free(x, list("abcd"), list("abcd"), maximum=1, **limits)[1:] == ["capacity"] * 3
    assert selection.near_free(x, list("abcd"), list("abcd"), maximum=1, order="group-near-capacity", **limits)[1] == "near"


def test_plan_within_budget():
    queues = {s: [(f"{s}1", 60), (f"{s}2", 70)] for s in ("winter", "spring", "summer", "autumn")}
    got = selection.budgeted_plan(queues, {s: 1 for s in queues}, 240)
    assert [s for s, _, _ in got] == list(queues) and sum(b for *_, b in got) == 240
    assert len(selection.budgeted_plan(queues, {s: 1 for s in queues}, 130)) == 2


def test_rarest_class_comes_first():
    rows = [{"classes": c} for c in (["car"], ["car", "bus"], ["car"], ["bus"], ["car"])]
    assert selection.rarest_first(rows, list("abcde"), {"car": 2, "bus": 1}, 3) == [1, 0, 2]


def test_frames_are_dealt_over_sites():
    rows = [{"role": r, "season": s, "site": f"{i % 4}", "component": str(i), "day": str(i), "confidence": 0.5, "rank": f"{i:03d}"} for i, (r, s) in enumerate([(r, s) for r in ("positive", "negative") for s in ("winter", "summer") for _ in range(8)])]
    chosen, _ = selection.bucketed(rows, {(r, s): 2 for r in ("positive", "negative") for s in ("winter", "summer")}, 2)
    assert len(chosen) == 8 and max(Counter(r["site"] for r in chosen).values()) == 2


def test_a_role_is_filled_from_other_seasons():
    row = lambda i, role, season, **k: {"role": role, "season": season, "site": f"s{i}", "component": i, "day": f"d{i}", "confidence": 0.1 * i, "rank": f"{i}", **k}
    rows = [row(0, "positive", "winter"), row(1, "positive", "winter"), row(2, "positive", "summer"), row(3, "negative", "winter", day="d0"), row(4, "negative", "summer", day="d0"), row(5, "negative", "summer")]
    targets = {("positive", "winter"): 1, ("positive", "summer"): 2, ("negative", "winter"): 1, ("negative", "summer"): 1}
    dealt, filled = selection.bucketed(rows, targets, 1, fill=rows)
    # a positive row's camera day doesn't stop a negative one's; a negative row's does
    assert [r["component"] for r in dealt] == [1, 2, 3, 5] and [r["component"] for r in filled] == [0]
    assert selection.bucketed(rows, targets, 1)[1] == []
    # winter is below its share: it comes before summer's surer row
    rows = [row(0, "positive", "winter"), row(1, "positive", "summer"), row(2, "positive", "summer")]
    for share, second in ((0.5, 0), (0.0, 1)):
        dealt, filled = selection.bucketed(rows, {("positive", "summer"): 1, ("positive", "autumn"): 1}, 1, fill=rows, season_share=share)
        assert [r["component"] for r in dealt + filled] == [2, second]


def _frames(n, sites, components, days, seed):
    rng = np.random.default_rng(seed)
    draw = lambda k: rng.integers(0, k, n).tolist()
    roles, seasons = ("positive", "negative"), ("winter", "summer")
    return [(i, roles[a], seasons[b], s, c, f"{s}-{y}", round(float(v), 2)) for i, (a, b, s, c, y, v) in enumerate(zip(draw(2), draw(2), draw(sites), draw(components), draw(days), rng.random(n), strict=True))]


@pytest.mark.parametrize(("sites", "components", "days", "pool"), [(60, 200, 9, 1600), (7, 300, 40, 4000), (60, 40, 2, 1600)])
def test_the_best_frames_are_chosen_from_a_whole_table(spark, sites, components, days, pool):
    names = ["id", "role", "season", "site", "component", "day", "confidence"]
    rows = _frames(4000, sites, components, days, sites)
    df = spark.createDataFrame(rows, "id long, role string, season string, site long, component long, day string, confidence double")
    targets = {(r, s): 3 for r in ("positive", "negative") for s in ("winter", "summer")}
    got = [r["id"] for r in selection.select_frames(df, "id", targets=targets, site_cap=3, pool_rows=pool).orderBy("position").collect()]
    ranks = {p: {r["id"]: r["x"] for r in df.select("id", S.stable_rank(F.lit(p), "role", "season", "id").alias("x")).collect()} for p in ("dealt", "fill")}
    held = {p: [dict(zip(names, r, strict=True), rank=ranks[p][r[0]]) for r in rows] for p in ranks}
    dealt, filled = selection.bucketed(held["dealt"], targets, 3, fill=held["fill"], season_share=0.15)
    assert got == [r["id"] for r in dealt + filled] and len(got) == 12


def test_frames_that_fall_short_are_an_error(spark):
    schema = "id long, role string, season string, site long, component long, day string, confidence double"
    targets = {(r, s): 3 for r in ("positive", "negative") for s in ("winter", "summer")}
    with pytest.raises(Exception, match="frames: 1 of 12"):
        selection.select_frames(spark.createDataFrame([(1, "positive", "winter", 1, 1, "d", None)], schema), "id", targets=targets, site_cap=3).collect()
    with pytest.raises(Exception, match="sites: .* of 99"):
        selection.select_frames(spark.createDataFrame(_frames(500, 30, 200, 9, 1), schema), "id", targets=targets, site_cap=3, minimum_sites=99).collect()
    # all rows are of two sites and one component: the first of many can't be proven to suffice
    with pytest.raises(Exception, match="may not suffice"):
        selection.select_frames(spark.createDataFrame(_frames(4000, 2, 1, 2000, 1), schema), "id", targets=targets, site_cap=3, pool_rows=400).collect()
    assert selection.select_frames(spark.createDataFrame([], schema), "id", targets=targets, site_cap=3).count() == 0
    rows = [(i, "positive", "winter", i, None, None, 0.5) for i in range(3)]
    with pytest.raises(Exception, match="frames: 1 of 2"):
        selection.select_frames(spark.createDataFrame(rows, schema), "id", targets={("positive", "winter"): 2}, site_cap=3).collect()


def test_shortlist_adds_small_sides_and_negatives():
    rows = [{"classes": ["car"], "side": s, "negative": n} for s, n in ((0.5, False), (0.2, False), (0.1, False), (0.1, True), (0.9, True), (0.1, False))]
    assert selection.rarest_first(rows, list("abcdef"), {"car": 1}, 1, smallest=2, side_most=0.2, negatives=1) == [0, 2, 5, 3]
    for short in ({"smallest": 4, "side_most": 0.2}, {"negatives": 3}):
        with pytest.raises(ValueError, match="[34]$"):
            selection.rarest_first(rows, list("abcdef"), {"car": 1}, 1, **short)
    with pytest.raises(ValueError, match="boxes of car: 4 of 5"):
        selection.rarest_first(rows, list("abcdef"), {"car": 5}, 1)
    with pytest.raises(ValueError, match="positive rows: 4 of 5"):
        selection.rarest_first(rows, list("abcdef"), {"car": 1}, 5)


def test_shortlist_of_a_pool_of_any_size(spark):
    """The rows that the kernel gets give what all rows would; repeated rows and blanks too."""
    import random

    r = random.Random(3)
    schema = "id long, classes array<string>, negative boolean, side double"
    for size in (0, 12, 60, 400):
        rows = [(r.randrange(size), [r.choice("abcd") for _ in range(r.randrange(4))], r.choice([True, False, None]), r.choice([None, *(k / 10 for k in range(10))])) for _ in range(size)]
        rows = [next(x for x in rows if x[0] == row[0]) for row in rows]
        pool = spark.createDataFrame(rows, schema)
        limits = {"smallest": 4, "side_most": 0.5, "negatives": 5}
        plain = pool.withColumn("rank", selection.stable_rank("id")).collect()
        kept = [{"classes": x["classes"], "negative": bool(x["negative"]), "side": float("nan") if x["side"] is None else x["side"]} for x in plain]
        try:
            want = selection.rarest_first(kept, [x["rank"] for x in plain], {"a": 3, "b": 5, "c": 0}, 14, **limits)
        except ValueError as error:
            if size:
                with pytest.raises(Exception, match=str(error)):
                    selection.shortlist(pool, "id", "classes", targets={"a": 3, "b": 5, "c": 0}, total=14, negative="negative", side="side", **limits).collect()
            continue
        want = [plain[i]["id"] for i in sorted(want, key=lambda i: (kept[i]["negative"], plain[i]["rank"]))]
        got = selection.shortlist(pool, "id", "classes", targets={"a": 3, "b": 5, "c": 0}, total=14, negative="negative", side="side", **limits).orderBy("position").collect()
        assert [x["id"] for x in got] == want
    many = spark.range(selection.POOL_ROWS + 50_000).select("id", F.array(F.concat(F.lit("c"), F.col("id") % 3)).alias("classes"), (F.col("id") % 5 == 0).alias("negative"))
    got = selection.shortlist(many, "id", "classes", targets={"c0": 2, "c2": 2}, total=6, negative="negative", negatives=1).orderBy("position").collect()
    ranked = many.withColumn("rank", selection.stable_rank("id")).orderBy("rank")
    first = lambda where, n: [(x["rank"], x["id"]) for x in ranked.where(where).limit(n).collect()]
    held = first("NOT negative AND classes[0] = 'c0'", 2) + first("NOT negative AND classes[0] = 'c2'", 2)
    rest = [x for x in first("NOT negative", 6) if x not in held]
    assert [x["id"] for x in got] == [i for _, i in sorted(held + rest[:2])] + [first("negative", 1)[0][1]]


def test_validation_queue_tells_near_hashes(spark):
    near = {"group_cap": 1, "site_cap": 9, "maximum": 2}
    hashes = np.array([0, 0b11, 0b111, 0xFF00, 0xFF0000], np.uint64)
    assert selection.hash_free(hashes, list("abacd"), list("zzzzz"), most=2, **near) == ["included", "near", "group", "included", "capacity"]
    rows = [(1, "0" * 16, "g1", "s1", 0.9, 0), (2, "0" * 15 + "1", "g2", "s2", 0.8, 0), (3, "f" * 16, "g3", "s1", 0.7, 0), (4, "f" * 8 + "0" * 8, "g4", "s1", 0.7, 1)]
    df = spark.createDataFrame(rows, "id long, h string, g string, s string, c double, b long")
    got = {r["id"]: r["decision"] for r in selection.validation_queue(df, "id", "h", "g", "s", "c", "b", most=1, group_cap=1, site_cap=2, maximum=9).collect()}
    assert got == {1: "included", 2: "near", 4: "included"}
    with pytest.raises(Exception, match="sites in the queue: 1 of 2"):
        selection.validation_queue(df, "id", "h", "g", "s", "c", "b", most=1, group_cap=1, site_cap=2, maximum=9, minimum_sites=2).collect()


def test_bundles_number_their_own_images(spark):
    images = spark.createDataFrame([("a", 0, 9, 9), ("b", 1, 9, 9), ("c", 1, 9, 9)], "file_name string, bundle long, width long, height long")
    boxes = spark.createDataFrame([("a", 0, 0.0, 0.0, 1.0, 1.0), ("b", 1, 1.0, 1.0, 3.0, 4.0)], "file_name string, class_id int, x1 double, y1 double, x2 double, y2 double")
    documents = writers.coco_document(images, boxes, [(0, "car"), (1, "bus")], "bundle")
    assert documents.count() == 2
    got = readers.coco_annotations(documents, "bundle").select("file_name", "category", "x", "h", "fault").collect()
    assert sorted(map(tuple, got)) == [("a", "car", 0.0, 1.0, None), ("b", "bus", 1.0, 3.0, None)]
    bare = writers.coco_document(images, boxes.limit(0), [(0, "car")], "bundle")
    assert bare.count() == 2 and readers.coco_annotations(bare, "bundle").count() == 0


def test_a_pool_that_is_too_large_is_an_error(spark):
    df = spark.createDataFrame([(i, [1.0, float(i)]) for i in range(5)], "id long, v array<double>")
    with pytest.raises(Exception, match="reduce it to 3 first"):
        selection.select_diverse(df, "v", "id", 2, pool_rows=3).collect()


# ---- files


def test_manifest(spark, tmp_path):
    path = str(tmp_path / "m.csv")
    with open(path, "w", encoding="utf-8-sig") as f:
        f.write('id,note,extra\n1,"a ""b"",\nc",\n2,,x\n')
    got = readers.manifest(spark, path, ["id"])
    assert got.columns == ["id", "note", "extra"]
    assert [tuple(r) for r in got.orderBy("id").collect()] == [("1", 'a "b",\nc', ""), ("2", "", "x")]
    with pytest.raises(ValueError):
        readers.manifest(spark, path, ["absent"])
    with pytest.raises(ValueError, match="unknown columns: b"):
        writers.write_manifest(spark.range(1).selectExpr("1 AS a", "2 AS b"), str(tmp_path / "o"), ["a"])


def test_archive_members(spark, tmp_path):
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w:gz") as t:
        for name, size in (("site_2020_04_01_120000.jpg", 3), ("site_IR_2020.jpg", 3), ("../up.jpg", 1)):
            info = tarfile.TarInfo(name)
            info.size = size
            t.addfile(info, io.BytesIO(b"x" * size))
        link = tarfile.TarInfo("l.jpg")
        link.type = tarfile.SYMTYPE
        t.addfile(link)
    files = spark.createDataFrame([("good", bytearray(out.getvalue())), ("broken", bytearray(b"no tar"))], "path string, content binary")
    got = {(r["path"], r["member"]): r["reason_code"] for r in readers.tar_members(files).collect()}
    assert got == {("good", "site_2020_04_01_120000.jpg"): None, ("good", "../up.jpg"): "traversal", ("good", "l.jpg"): "link", ("broken", None): "archive_read_failed"}


def test_coco_export(spark):
    document = {"categories": [{"id": 1, "name": "car"}], "images": [{"id": 5, "file_name": "a.jpg", "width": 10, "height": 10}], "annotations": [{"id": i, "image_id": im, "category_id": 1, "bbox": b} for i, im, b in ((1, 5, [1, 1, 2, 2]), (1.5, 5, [1, 1, 2, 2]), (2, 9, [1, 1, 2, 2]), (3, 5, [5, 5, 9, 9]))]}
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("annotations/instances_default.json", json.dumps(document))
    files = spark.createDataFrame([("a", bytearray(out.getvalue())), ("b", bytearray(b"no zip"))], "path string, content binary")
    read = readers.coco_documents(files)
    assert {r["path"]: r["reason_code"] for r in read.collect()} == {"a": None, "b": "unreadable"}
    got = {r["id"]: r["fault"] for r in readers.coco_annotations(read.where("reason_code IS NULL")).collect()}
    assert got == {"1": None, "1.5": "id_not_whole", "2": "unknown_image", "3": "box_outside"}


def test_labels(spark):
    lines = spark.createDataFrame([("0 0.5 0.5 0.25 0.25",), ("0 0.5 0.5 0.25",), ("x 0.5 0.5 0.1 0.1",), ("0 0.99 0.5 0.25 0.25",), ("0 nan 0.5 0.1 0.1",)], "value string")
    assert [r["is_faulty"] for r in readers.label_lines(lines).collect()] == [False, True, True, True, True]


def test_label_files(spark, tmp_path, monkeypatch):
    """One file an image, many to a folder; any name, blank and null apart; a failed job and stray files don't show."""
    monkeypatch.setattr(writers, "FOLDER_FILES", 500)
    names = [*[f"i{k}" for k in range(2000)], "a/b", "", None, "007", "..", "é" * 300, "x y"]
    held = [(n, c, 10.0 * c, 20.0, 10.0 * c + 8, 40.0, 640.0, 480.0) for n in names for c in (1, 0)]
    rows = spark.createDataFrame(held, "name string, class_id int, x1 double, y1 double, x2 double, y2 double, width double, height double")
    path = tmp_path / "labels"
    bad = rows.withColumn("class_id", F.when(F.col("name") == "i77", F.raise_error(F.lit("i77 is bad"))).otherwise(F.col("class_id")))
    with pytest.raises(Exception, match="i77 is bad"):
        writers.write_labels(bad, str(path), "name")
    writers.write_labels(rows, str(path), "name")
    files = [f for f in path.rglob("*.txt")]
    assert len(files) == len(names) and max(len(list(f.iterdir())) for f in {f.parent for f in files}) <= 500
    (files[0].parent / "stray.txt").write_text("0 0.5 0.5 0.1 0.1")
    got = Counter((r["image"], r["class_id"], r["is_faulty"]) for r in readers.label_lines(readers.label_files(spark, str(path))).collect())
    assert got == Counter((n, c, False) for n in names for c in (0, 1))
    with pytest.raises(Exception, match="already exists|ALREADY_EXISTS"):
        writers.write_labels(rows, str(path), "name")
    writers.write_labels(rows.where("name = 'i1'"), str(path), "name", mode="overwrite")
    assert readers.label_files(spark, str(path)).count() == 2 and len(list(path.rglob("*.txt"))) == 1
    next(path.rglob("i1.txt")).write_text("0")
    with pytest.raises(Exception, match="is not whole"):
        readers.label_files(spark, str(path)).collect()


def test_inventory(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / ".secret").mkdir()
    for name in ("site-a_2026-08-01_120000.jpg", "sub/site-b_2026_08_02_130000.png", "notes.txt"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / ".secret" / "c.jpg").write_bytes(b"x")
    got = {r["name"]: r["reason_code"] for r in readers.inventory(spark, str(tmp_path), content=True).collect()}
    assert got["notes.txt"] == "suffix" and [n for n, r in got.items() if r is None] and "site-b_2026_08_02_130000.png" in got


def test_zip_is_reproducible():
    assert writers.reproducible_zip({"b": b"1", "a": b"2"}) == writers.reproducible_zip({"a": b"2", "b": b"1"})


def test_json_settings(spark, tmp_path):
    (tmp_path / "c.json").write_text('{"a": 1}')
    (tmp_path / "d.json").write_text("[1]")
    assert readers.json_object(spark, str(tmp_path / "c.json")) == {"a": 1}
    with pytest.raises(ValueError):
        readers.json_object(spark, str(tmp_path / "d.json"))
    assert writers.statistics_json(spark.range(1).selectExpr("2 AS b", "1 AS a")) == '{"a": 1, "b": 2}'


def test_catalog_violations(spark):
    sha = "a" * 64
    m = spark.createDataFrame([("1", "train", "images/train/1.jpg", "labels/train/1.txt", 1, sha, "", "", "g1"), ("2", "val", "images/val/2.jpg", "", 0, "b" * 64, sha, "", "g2")], "image_id string, split string, image_path string, label_path string, annotation_count int, source_sha256 string, parent_source_sha256 string, decoded_sha256 string, group_id string")
    files = spark.createDataFrame([("x", "1"), ("y", "2")], "name string, sha256 string")
    listed = spark.createDataFrame([("1", "x"), ("9", "z")], "digest string, name string")
    got = {(r["kind"], r["subject"]) for r in projections.catalog_violations(m, listed, files, {"train": 1, "val": 1}).collect()}
    assert got == {("unlisted_file", "y"), ("missing_file", "z"), ("split_leak", f"sha {sha}")}


# ---- incremental


def test_resume(spark):
    source = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "id int, h string")
    done = spark.createDataFrame([(1, "a", "completed"), (2, "x", "completed"), (3, "c", "failed"), (9, "z", "completed")], "id int, h string, status string")
    assert [r["id"] for r in incremental.remaining(source, done, ["id"]).collect()] == [3]
    assert {(r["id"], r["fault"]) for r in incremental.stale(source, done, ["id"], "h").collect()} == {(2, "changed"), (9, "not_in_source")}
    with pytest.raises(ValueError, match="model"):
        incremental.same_run({"model": 1, "x": 2}, {"model": 2, "x": 2})
    with pytest.raises(PermissionError):
        incremental.guard_human_progress(spark.createDataFrame([("", " "), ("", "yes")], "a string, b string"), ["a", "b"])


def test_file_stream_runs_each_file_once(spark, tmp_path):
    schema = "id int, ts timestamp, event_type string"
    seen = []
    step = lambda batch, number: seen.extend(r["id"] for r in batch.collect())
    for day in (1, 2):
        spark.createDataFrame([(day, f"2024-01-0{day} 00:00:00", "a")], "id int, ts string, event_type string").withColumn("ts", F.col("ts").cast("timestamp")).write.mode("append").parquet(str(tmp_path / "in"))
        incremental.run_batches(incremental.file_stream(spark, str(tmp_path / "in"), schema), step, str(tmp_path / "check"))
    assert seen == [1, 2]
