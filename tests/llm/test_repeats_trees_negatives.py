"""Suffix dedup, Merkle manifests and hard negatives: brute force, nulls, ties, repeats, empty tables, clashes."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import merkle, negatives, suffixes
from sieveline.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["op11_suffix_dedup", "op12_hard_negatives", "op13_merkle_manifest"])
def test_query_equals_its_sql(spark, name):
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "embeddings"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    found = QUERIES[name](spark, SF)
    want = c.sql(ORACLES[name])
    assert sorted(want.columns) == sorted(found.columns)
    at = [want.columns.index(x) for x in found.columns]
    assert sorted(str(tuple(r)) for r in found.collect()) == sorted(str(tuple(r[i] for i in at)) for r in want.fetchall())


# ---- repeated strings


def repeats(texts, length):
    seen, raw = {}, [(t or "").encode() for t in texts]
    for b in raw:
        for p in range(len(b) - length + 1):
            seen[b[p : p + length]] = seen.get(b[p : p + length], 0) + 1
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if seen[b[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((len(b), sum(gone), runs, bytes(c for c, g in zip(b, gone, strict=True) if not g)))
    return out


def passages(seed, n):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghijklmnopqrstuvwxyzéß") for _ in range(rng.randint(1, 9)))
    prose = lambda k: " ".join(word() for _ in range(k))
    known = [prose(rng.randint(15, 90)) for _ in range(8)]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(rng.randint(1, 6)):
            kind = rng.random()
            if kind < 0.5:
                parts.append(prose(rng.randint(1, 60)))
            elif kind < 0.9:
                q = rng.choice(known)
                parts.append(q[rng.randint(0, len(q) // 2) :] if rng.random() < 0.5 else q)
            elif kind < 0.95:
                parts.append(rng.choice(["a", "ab ", "=-+"]) * rng.randint(50, 400))
            else:
                parts.append(known[0])  # one passage has a large share of all
        out.append(rng.choice([" ", "\n", ""]).join(parts))
    return out


@pytest.mark.parametrize(("length", "bucket", "piece"), [(200, 40_000, 1 << 19), (200, 60, 700), (40, 500, 1 << 19), (3, 400, 100)])
def test_repeated_strings_equal_brute_force(spark, monkeypatch, length, bucket, piece):
    """Also with buckets so small that runs cross their boundaries, and texts in many pieces."""
    monkeypatch.setattr(suffixes, "PIECE", piece)
    monkeypatch.setattr(suffixes.repeated, "__defaults__", (bucket,))
    texts = [*passages(3, 30 if length == 3 else 150), None, "", "x" * 199, "y" * 200, "z" * 201, "y" * 200]
    texts += [texts[3], texts[3], texts[5][:-3], "é" * 150, "x" + "é" * 150]
    rows = [(None if i % 50 == 7 else i, t, i) for i, t in enumerate(texts)] + [(3, texts[3], 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_spans int").selectExpr("*", "1 AS id", "2 AS __key", "3 AS lo").repartition(3)
    got = suffixes.drop_repeated_strings(docs, length=length)
    assert [c for c in got.columns if c not in ("n_bytes", "n_removed", "kept", "n_spans")] == ["doc_id", "text", "id", "__key", "lo"]
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect())
    assert found == sorted((i is None, i or 0, *b) for (i, *_), b in zip(rows, repeats([t for _, t, _ in rows], length), strict=True))


def test_no_repeats_and_no_rows(spark):
    one = spark.createDataFrame([(1, "short"), (2, None)], "doc_id long, text string")
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, bytes(r.kept)) for r in suffixes.drop_repeated_strings(one).collect()) == [(1, 5, 0, b"short"), (2, 0, 0, b"")]
    assert suffixes.drop_repeated_strings(one.limit(0)).collect() == []


def test_a_very_long_text(spark):
    rng = random.Random(8)
    word = "".join(rng.choice("abcdef ") for _ in range(300))
    text = "".join(rng.choice("abcdefghij klm") for _ in range(1_300_000))
    rows = [(1, text[:600_000] + word + text[600_000:] + word), (2, "z" + word)]
    got = {r.doc_id: r for r in suffixes.drop_repeated_strings(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_removed, got[1].n_spans, bytes(got[1].kept).decode()) == (600, 2, text)
    assert (got[2].n_removed, got[2].n_spans, bytes(got[2].kept)) == (300, 1, b"z")


def test_multikey_order():
    rng = np.random.default_rng(5)
    tokens = rng.integers(0, 3, (500, 4)).astype(np.uint64)
    order, group = suffixes.multikey_order(tokens)
    want = sorted(map(tuple, tokens.tolist()))
    assert [tuple(x) for x in tokens[order].tolist()] == want
    assert [want.index(x) for x in want] == group.tolist()


# ---- trees


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def tree(leaves):
    """Root, and for each leaf what stands left and right of its path at each level."""
    beside, at, level = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(level) > 1:
        for k, i in enumerate(at):
            run = level[i // 3 * 3 :][:3]
            beside[k].append(("".join(run[: i % 3]), "".join(run[i % 3 + 1 :])))
            at[k] = i // 3
        level = [digest("".join(level[i : i + 3])) for i in range(0, len(level), 3)]
    return level[0] if level else None, beside


def manifest_rows(rows):
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: digest("".join(map(field, r)))
    touched = lambda r: (*r[:4], r[4].replace("\n", "")) if r[4] is not None and r[0] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r
    groups = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    held = {}
    for s in groups:
        own = sorted(((r[0] is not None, r[0] or 0, leaf(r), leaf(touched(r)), r) for r in rows if r[1] == s), key=lambda x: x[:4])
        held[s] = own, *tree([x[2] for x in own])
    root, above = tree([held[s][1] for s in groups])
    out = []
    for s, top in zip(groups, above, strict=True):
        own, subroot, beside = held[s]
        for (_, _, node, fold, row), path in zip(own, beside, strict=True):
            for left, right in path + top:
                fold = digest(left + fold + right)
            out.append((row[0], node, subroot, root, digest("".join(a + b for a, b in path + top)), fold, fold == root))
    return sorted(map(str, out))


def ask_manifest(spark, rows, levels):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string").selectExpr("*", "1 AS grp", "2 AS pos", "3 AS sides").repartition(3)
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(touched, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return sorted(str(tuple(r)) for r in merkle.manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": text}, levels=levels).collect())


@pytest.mark.parametrize(("levels", "part"), [(8, 400_000), (2, 60), (1, 50)])
def test_manifest_equals_brute_force(spark, monkeypatch, levels, part):
    """One bucket, two tiers, and many; a source of half the rows, sources of one, null and empty ones."""
    monkeypatch.setattr(merkle, "PART", part)
    rng = random.Random(levels)
    rows = [
        (rng.choice([None, i, i, i % 50]), rng.choice([None, "", "a", "a", "a", "a", "b", "é", f"z{i % 30}"]), rng.choice(["en", None]), rng.choice([None, i]), rng.choice([None, "", "x\ny", "abc é\n\n", "l" * 3000]))
        for i in range(300)
    ]
    rows += rows[:3]
    assert ask_manifest(spark, rows, levels) == manifest_rows(rows)


@pytest.mark.parametrize("n", [0, 1, 2, 4])
def test_manifest_of_few_rows(spark, n):
    rows = [(i, "a", "en", 1, "x\n") for i in range(n)]
    assert ask_manifest(spark, rows, 1) == manifest_rows(rows)


# ---- hard negatives


def mined(rows, positives=5, n_negatives=10):
    held = {}
    for i, label, v in rows:
        if i is not None and label is not None and v and all(x is not None and np.isfinite(x) for x in v):
            own = (label, [int(np.floor(256 * np.float64(np.float32(x)))) for x in v])
            held[i] = min(held.get(i, own), own)
    out = []
    for a, (label, v) in held.items():
        score = {b: int(np.dot(v, w)) for b, (_, w) in held.items() if b != a and len(w) == len(v)} if a % 100 == 0 else {}
        first = lambda ids: sorted(ids, key=lambda b: (-score[b], b))  # noqa: B023, E731
        for p in first([b for b in score if held[b][0] == label])[:positives]:
            fit = [b for b in score if held[b][0] != label and 30 * score[p] <= 100 * score[b] <= 90 * score[p]]
            out += [(a, p, k, b, score[p], score[b]) for k, b in enumerate(first(fit)[:n_negatives], 1)]
    return sorted(out)


def vectors(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(9, 8))
    rows = [(i, int(rng.integers(4)), [float(np.float32(x)) for x in centres[rng.integers(9)] + (0.5 * rng.normal(size=8) if rng.random() < 0.8 else 0)]) for i in range(n)]
    odd = [(5000, None, [1.0] * 8), (5100, 1, None), (5200, 1, []), (5300, 1, [None] + [1.0] * 7), (5400, 2, [float("nan")] * 8), (5500, 2, [float("inf")] * 8)]
    return [*rows, *odd, (None, 1, [1.0] * 8), (100, 0, [0.5] * 8), rows[7], rows[200], (6000, 1, [0.0] * 8), *[(7000 + i, int(rng.integers(2)), [float(np.float32(x)) for x in rng.normal(size=3)]) for i in range(150)]]


def ask_negatives(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").selectExpr("*", "1 AS id", "2 AS v", "3 AS block").repartition(3)
    return sorted(tuple(r) for r in negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect())


@pytest.mark.parametrize(("size", "anchors", "sample"), [(8192, 512, 512), (100, 7, 512), (300, 64, 20)])
def test_negatives_equal_brute_force(spark, monkeypatch, size, anchors, sample):
    """Ties, copies, repeated ids, vectors of two lengths (one of them unsampled), many blocks."""
    for name, value in (("ROWS", size), ("ANCHORS", anchors), ("SAMPLE", sample), ("PAGE", 64)):
        monkeypatch.setattr(negatives, name, value)
    rows = vectors(2, 1500)
    assert ask_negatives(spark, rows) == mined(rows)


def test_negatives_of_few_rows(spark):
    rows = [(0, 1, [1.0, 0.0]), (1, 1, [1.0, 1.0]), (2, 2, [0.5, 3.0]), (3, 2, [0.1, 0.0])]
    for n in range(5):
        assert ask_negatives(spark, rows[:n]) == mined(rows[:n])


def test_too_long_vectors_are_an_error(spark):
    with pytest.raises(ValueError, match="too long"):
        ask_negatives(spark, [(0, 1, [1e9, 0.0]), (1, 1, [1.0, 1.0])])


def test_brackets_hold_and_leave_rows_out():
    rng = np.random.default_rng(3)
    centres = 40 * rng.normal(size=(30, 16))
    y = np.floor(centres[rng.integers(30, size=2000)] + rng.normal(size=(2000, 16)))
    x = y[:50]
    longest = float((y**2).sum(1).max())
    pivots = negatives.choose_pivots(y[:200].astype(int).tolist(), longest)
    dq, dx = negatives.distances(x, pivots, longest, True), negatives.distances(y, pivots, longest, False)
    score = x @ y.T
    wanted = np.sort(score, axis=1)[:, -20]
    near = negatives.survivors(dq, dx, (x**2).sum(1), longest, wanted, np.full(50, np.inf))
    assert near[score >= wanted[:, None]].all() and near.mean() < 0.5
