"""Vector archives: round trips, ranges, damage, publishing."""

import json
import os
import uuid

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.session import shared_dir
from sieveline.sources import archives as A


@pytest.fixture
def folder(spark):
    return f"{shared_dir(spark)}/vec-{uuid.uuid4().hex}"


def local(path):
    return path.removeprefix("file://")


def vectors(spark, n=1000, width=5, parts=3):
    return spark.range(n).repartition(parts).select(F.concat(F.lit("é"), "id").alias("identity"), F.transform(F.sequence(F.lit(0), F.lit(width - 1)), lambda i: (F.col("id") * 3 + i).cast("float") / 8).alias("embedding"), F.lit("x").alias("archive"))


@pytest.mark.parametrize("compressed", [False, True])
@pytest.mark.parametrize("verify", [False, True])
def test_round_trip_and_ranges(spark, folder, compressed, verify):
    rows = vectors(spark)
    A.write_vector_archives(rows, folder, rows_per_archive=100, compressed=compressed, model="m")
    found = A.vector_archives(spark, folder, rows_per_task=30, verify=verify)
    if not compressed and not verify:
        assert found.rdd.getNumPartitions() >= 1000 / 30
    assert found.where("reason_code IS NOT NULL").isEmpty()
    assert sorted(map(tuple, A.accepted_vectors(found).collect())) == sorted(map(tuple, rows.select("identity", "embedding").collect()))
    told = json.load(open(f"{local(folder)}/_manifest.json"))
    assert told["model"] == "m" and sum(a["rows"] for a in told["archives"]) == 1000 and max(a["rows"] for a in told["archives"]) <= 100


def test_other_peoples_archives_and_their_damage(spark, folder):
    os.makedirs(f"{local(folder)}/deep")
    at = lambda name: f"{local(folder)}/{name}.npz"
    good = np.arange(12, dtype=np.float64).reshape(4, 3)
    np.savez(at("deep/good"), identities=np.array(["a", "b", "c", "d"]), embeddings=good)
    np.savez_compressed(at("short"), identities=np.array(["a"]), embeddings=good)
    np.savez(at("flat"), identities=np.array(["a", "b"]), embeddings=np.arange(2.0))
    np.savez(at("named"), ids=np.array(["a"]), embeddings=good)
    np.savez(at("objects"), identities=np.array(["a", None], dtype=object), embeddings=good[:2])
    np.savez(at("infinite"), identities=np.array([1, 2]), embeddings=np.array([[1.0, 2.0], [np.inf, 0.0]]))
    np.savez_compressed(at("none"), identities=np.array([], dtype=str), embeddings=np.empty((0, 3)))
    whole = open(at("deep/good"), "rb").read()
    open(at("cut"), "wb").write(whole[: len(whole) // 2])
    place = whole.index(good.tobytes()) + 3
    open(at("flipped"), "wb").write(whole[:place] + bytes([whole[place] ^ 255]) + whole[place + 1 :])
    found = A.vector_archives(spark, folder)
    reasons = {r.archive.removesuffix(".npz"): r.reason_code for r in found.where("reason_code IS NOT NULL").collect()}
    assert reasons == {"short": "shape", "flat": "shape", "named": "member_missing", "objects": "shape", "infinite": "not_finite", "cut": "archive_read_failed", "flipped": "archive_read_failed"}
    assert sorted(tuple(r) for r in A.accepted_vectors(found).collect()) == [(n, v) for n, v in zip("abcd", good.tolist(), strict=True)]


def test_a_changed_archive_is_told_by_its_digest(spark, folder):
    A.write_vector_archives(vectors(spark, 50, parts=1), folder)
    name = json.load(open(f"{local(folder)}/_manifest.json"))["archives"][0]["archive"]
    with open(f"{local(folder)}/{name}", "ab") as f:
        f.write(b"more")
    assert [r.reason_code for r in A.vector_archives(spark, folder, verify=True).collect()] == ["digest_mismatch"]


def test_a_failing_task_leaves_nothing_and_nothing_is_overwritten(spark, folder):
    bad = vectors(spark).withColumn("embedding", F.when(F.col("identity") == "é77", F.array(F.lit(float("nan")).cast("float"))).otherwise(F.col("embedding")))
    with pytest.raises(Exception, match="é77"):
        A.write_vector_archives(bad, folder, rows_per_archive=10)
    left = [f for _, _, files in os.walk(local(folder)) for f in files if f.endswith(".npz") or f == "_manifest.json"]
    assert left == []
    A.write_vector_archives(vectors(spark, 20), folder)
    with pytest.raises(Exception, match="is published"):
        A.write_vector_archives(vectors(spark, 30), folder)
    assert A.vector_archives(spark, folder).count() == 20


def test_a_second_attempt_counts_once(spark, folder):
    """Archives that no manifest names, as a lost attempt leaves them, aren't read."""
    A.write_vector_archives(vectors(spark, 20), folder)
    np.savez(f"{local(folder)}/stray.npz", identities=np.array(["q"]), embeddings=np.ones((1, 5)))
    assert A.vector_archives(spark, folder).count() == 20


def test_no_rows_mixed_lengths_and_repeats(spark, folder):
    A.write_vector_archives(vectors(spark, 0), folder + "a")
    assert A.vector_archives(spark, folder + "a").collect() == []
    mixed = spark.createDataFrame([("a", [1.0]), ("a", [1.0]), ("b", [1.0, 2.0]), ("", [3.0])], "identity string, embedding array<double>").coalesce(1)
    A.write_vector_archives(mixed, folder + "b")
    assert sorted((r.identity, r.embedding) for r in A.vector_archives(spark, folder + "b").collect()) == [("", [3.0]), ("a", [1.0]), ("a", [1.0]), ("b", [1.0, 2.0])]


def test_ranges_far_into_an_archive(spark, folder):
    """A range that begins beyond what the reader of a member holds."""
    rows = vectors(spark, 5000, width=64, parts=1)
    A.write_vector_archives(rows, folder)
    found = A.vector_archives(spark, folder, rows_per_task=700)
    assert found.where("reason_code IS NOT NULL").isEmpty()
    assert sorted(map(tuple, found.select("identity", "embedding").collect())) == sorted(map(tuple, rows.select("identity", "embedding").collect()))
