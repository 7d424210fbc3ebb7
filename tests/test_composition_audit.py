"""The audit of a composition against plain loops."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.operators import dedup

ROWS = "doc_id long, source_sha256 string, decoded_sha256 string, extra int"
VECTORS = "doc_id long, embedding array<double>, model string"


def test_composition_faults_equal_loops(spark):
    rng = np.random.default_rng(3)
    unit = [list(map(float, v / np.linalg.norm(v))) for v in rng.normal(size=(60, 4))]
    unit[11] = unit[10] = unit[9]  # copies of a vector
    rows = [(i, f"s{i // 2 if i < 6 else i}", " " if i in (7, 8) else f"d{i}", 1) for i in range(50)] + [(None, "s0", "d0", 1)]
    vectors = [(i, unit[i], "b" if i in (4, 40) else "a") for i in range(60) if i not in (20, 21)] + [(21, [1.0, None, 0.0, 0.0], "a"), (30, unit[30], "a")]
    got = sorted(map(tuple, dedup.composition_faults(spark.createDataFrame(rows, ROWS), spark.createDataFrame(vectors, VECTORS), "doc_id", ["source_sha256", "decoded_sha256"], least=0.9).collect()), key=str)
    want = [("duplicate_source_sha256", str(i), str(i + 1)) for i in (0, 2, 4)] + [("missing_vector", "20", None), ("missing_vector", "21", None), ("several_vectors", "30", "2"), ("several_models", "4", "b"), ("several_models", "40", "b")]
    kept = [i for i in range(50) if i not in (20, 21)]
    classes = [i for i in kept if i not in (10, 11)]
    want += [("similar", str(i), str(j)) for n, i in enumerate(classes) for j in classes[n + 1 :] if float(np.dot(unit[i], unit[j])) >= 0.9] + [("similar", "9", "10"), ("similar", "9", "11")]
    assert got == sorted(want, key=str)


def test_composition_faults_of_nothing(spark):
    rows, vectors = spark.createDataFrame([], ROWS), spark.createDataFrame([(1, [1.0], "a")], VECTORS)
    assert dedup.composition_faults(rows, vectors, "doc_id", ["source_sha256"]).collect() == []
    alone = dedup.composition_faults(spark.createDataFrame([(1, None, "", 0)], ROWS), vectors.limit(0), "doc_id", ["source_sha256", "decoded_sha256"])
    assert [tuple(r) for r in alone.collect()] == [("missing_vector", "1", None)]


@pytest.mark.parametrize("most", [3, 6])
def test_perceptual_candidates_equal_loops(spark, most):
    rng = np.random.default_rng(most)
    base = [int(v) for v in rng.integers(0, 1 << 62, 12)]
    bits = [b ^ sum({1 << int(k) for k in rng.integers(0, 60, rng.integers(0, 5))}) for b in base for _ in range(7)] + [None, None] + base[:4] * 3
    df = spark.createDataFrame(list(enumerate(bits)), "id long, bits long")
    real = [b for b in bits if b is not None]
    want = sum((x ^ y).bit_count() <= most for i, x in enumerate(real) for y in real[i + 1 :])
    assert dedup.perceptual_candidates(df, "bits", "id", most).collect() == [(want,)]
    assert dedup.perceptual_candidates(df.where(F.lit(False)), "bits", "id", most).collect() == [(0,)]
