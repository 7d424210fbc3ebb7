"""Operators over documents: brute force, nulls, empty and long texts, ties, repeats, clashes."""

import hashlib
import math
import re
import string
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash

from sieveline.llm import binary_ids, decontaminate, line_dedup, packing, quality, simhash, similar, tokens, toxicity
from sieveline.llm.wordhash import Words, bit_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def docs(spark, *texts, first=1):
    return spark.createDataFrame([(first + i, t, "en", "s", 0) for i, t in enumerate(texts)], SCHEMA)


def words(text):
    return re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))


LONG = " ".join(f"w{i % 977}x{i}" for i in range(30_000))
ODD = [None, "", " \n\t ", "one", "A a A a A a", "É é é \x1c x", "<|endoftext|> Hi.", "it's 've. don't!", "İi Σ. ﬁ, ́a", "日本語。 한국어", LONG]


# ---- tokens, files, packing


def direct(text, end):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokens.default_path())
    return np.array([*tok.encode(text or "", add_special_tokens=False).ids, end], "<u4")


def test_tokenizer_equals_the_library():
    tok = tokens.WordTokenizer(tokens.default_path())
    for got, text in zip(tok.encode(ODD), ODD, strict=True):
        assert got.tolist() == direct(text, 1)[:-1].tolist(), text


def test_tokenizer_equals_the_library_on_odd_texts():
    rng = np.random.default_rng(1)
    pools = [list("abcXYZHJTW"), list("İıΣσςßſKÅéÉñ"), list("!\"#$%&'()*+,-./:;<=>?@[]^_`{|}~"), list(" \t\n\x0b\x1c\x85\xa0\u3000"), ["<|endoftext|>", "<|", "'s", "'ve"], [chr(c) for c in (*range(0x300, 0x340), 0x3099)], list("0123456789٣Ⅷ½"), list("日本語한국어각שלוםمرحبا"), ["ﬁ", "🙂", "\u200d"]]

    def odd():
        out = []
        for _ in range(int(rng.integers(1, 25))):
            c = int(rng.integers(1, 0x11000))
            pool = pools[int(rng.integers(len(pools)))]
            out.append(chr(c) if rng.random() < 0.1 and not 0xD800 <= c < 0xE000 else pool[int(rng.integers(len(pool)))])
        return "".join(out)

    from tokenizers import Tokenizer

    texts = ["İ.", "İ)", "İ-", "İ>", "Y\u030a", "H\u0331x", *[odd() for _ in range(10_000)]]
    want = Tokenizer.from_file(tokens.default_path()).encode_batch(texts, add_special_tokens=False)
    got = tokens.WordTokenizer(tokens.default_path()).encode(texts)
    assert [t for t, g, w in zip(texts, got, want, strict=True) if g.tolist() != w.ids] == []


def test_tokenizer_is_the_same_after_its_memory_is_cleared(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 3)
    tok = tokens.WordTokenizer(tokens.default_path())
    for _ in range(2):
        for text in ODD:
            assert tok.encode([text])[0].tolist() == direct(text, 1)[:-1].tolist()


@pytest.mark.parametrize("ranks", [[], [0], [255, 256, 65535, 65536, 2**24, 2**32 - 1, 3], list(range(1000))])
def test_ranks_round_trip(ranks):
    control, data = binary_ids.encode_ranks(np.array(ranks, np.uint32))
    back = binary_ids.decode_ranks(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(ranks))
    assert back.tolist() == ranks


def test_token_files(spark):
    rows = [(5, "b c"), (None, "n"), (1, None), (5, "b c"), (3, ""), (2, LONG)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS ids", "2 AS n", "'x' AS `start`")
    got = binary_ids.round_trip(df, shard_ids=5000).collect()
    start, want = 0, []
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = direct(t, 2)
        want.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_token_files_of_an_empty_table(spark):
    assert binary_ids.round_trip(docs(spark)).collect() == []


def test_ids_keep_the_smallest_id_and_nulls_apart(spark):
    rows = [(-(2**63), "least"), (None, "none"), (0, "zero"), (None, None), (2**63 - 1, "most"), (-(2**63), "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for shard_ids in (1, 4_000_000):
        got = sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["n_tokens"]) for r in binary_ids.round_trip(df, shard_ids=shard_ids).collect())
        assert [x[:2] for x in got] == [(False, 0), (False, 0), (True, -(2**63)), (True, -(2**63)), (True, 0), (True, 2**63 - 1)]
        assert got[0][2] == 1 and got[1][2] > 1


def check_packing(rows, texts, window=2048):
    ids = {i: direct(t, 1) for i, t in texts.items()}
    pieces, sequences = {}, {}
    for r in rows:
        own = ids[r["doc_id"]]
        assert r["length"] > 0 and r["doc_tokens"] == len(own)
        assert zlib.crc32(own[r["start"] : r["start"] + r["length"]].tobytes()) == r["ids_crc32"]
        pieces.setdefault(r["doc_id"], []).append((r["start"], r["length"]))
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for i, own in ids.items():
        at = 0
        for a, n in sorted(pieces[i]):
            assert a == at
            at += n
        assert at == len(own)
    for parts in sequences.values():
        at = 0
        for a, n in sorted(parts):
            assert a == at
            at += n
        assert at <= window and at & (at - 1) == 0 or at == window  # no padding anywhere


def test_packing(spark):
    texts = dict(enumerate([*ODD, *[f"common words and t{i} u{i % 7}" for i in range(60)]], 1))
    df = docs(spark, *texts.values()).withColumnRenamed("n_chars", "n").selectExpr("*", "1 AS ids", "2 AS key", "3 AS offset")
    check_packing(packing.pack_documents(df, shard_ids=40_000).collect(), texts)


def test_packing_small_tables(spark):
    assert packing.pack_documents(docs(spark)).collect() == []
    (row,) = packing.pack_documents(docs(spark, None)).collect()
    assert (row["length"], row["doc_tokens"], row["offset"]) == (1, 1, 0)
    same = packing.pack_documents(spark.createDataFrame([(7, "a b")] * 2 + [(None, "c")], "doc_id long, text string")).collect()
    assert sum(r["length"] for r in same) == 3 + 3 + 2


def test_packing_prefers_lexical_neighbours():
    rng = np.random.default_rng(1)
    topics = [rng.integers(1000 * k, 1000 * k + 40, 300).astype(np.uint32) for k in range(4) for _ in range(6)]
    df = np.bincount(np.concatenate([np.unique(t) for t in topics]), minlength=5000)
    idf = np.log1p((24 - df + 0.5) / (df + 0.5)).astype(np.float32)
    order = [topics[i] for i in rng.permutation(24)]
    first = packing.pack(order, idf, 300.0, 1024)[0]
    assert len({int(order[d][0]) // 1000 for d, _, _ in first}) == 1


@pytest.mark.parametrize("wide", [0, 8, 10**6])
def test_neighbours_are_scored_with_all_terms(monkeypatch, wide):
    monkeypatch.setattr(packing, "WIDE", wide)
    rng = np.random.default_rng(5)
    texts = [rng.choice(400, int(n), p=(p := 1 / np.arange(2, 402)) / p.sum()).astype(np.uint32) for n in rng.integers(100, 300, 40)]
    df = np.bincount(np.concatenate([np.unique(d) for d in texts]), minlength=400)
    idf = np.log1p((40 - df + 0.5) / (df + 0.5)).astype(np.float32)
    mean = np.mean([len(d) for d in texts])
    index = packing.Index(texts, idf, mean)
    for seed in range(40):
        free = np.arange(40) % 3 != seed % 3
        want = {}
        for d in np.flatnonzero(free).tolist():
            tf = np.bincount(texts[d], minlength=400)[np.unique(texts[seed])]
            want[d] = float((idf[np.unique(texts[seed])] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(texts[d]) / mean))).sum())
        got = index.neighbours(seed, free).tolist()
        assert sorted(got) == sorted(want)
        assert np.allclose([want[d] for d in got], sorted(want.values(), reverse=True), rtol=1e-5)


# ---- line dedup


def brute_lines(rows, min_docs=3, min_chars=20):
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(LOWER)
    holders = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= min_chars and i is not None:
                holders.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(holders.get(key(x), ())) >= min_docs and i != max(holders[key(x)]))]
        out.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def test_line_dedup(spark):
    line, other = "This is a line of some length", "été à la plage, vingt-cinq"
    rows = [(1, f"{line}\nx\n  {line.upper()} \t"), (2, f"{line}\n{other}"), (3, f"\x0b{line}"), (4, None), (5, ""), (6, "\n\n"), (7, other), (8, other + "\r"), (None, line), (2, f"{line}\n{other}"), (9, "short line\nshort line"), (10, "short line"), (11, "short line")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "5 AS N_LINES", "doc_id AS __pos")
    from pyspark.sql import functions as F

    got = line_dedup.drop_repeated_lines(df).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256)).collect()
    order = lambda r: (r[0] is None, r)
    assert sorted(map(tuple, got), key=order) == sorted(brute_lines(rows), key=order)


def test_line_dedup_empty_and_long(spark):
    assert line_dedup.drop_repeated_lines(docs(spark)).collect() == []
    rows = [(i, "\n".join([f"line number {j} of the long text" for j in range(3000)])) for i in range(3)]
    got = {r["doc_id"]: r["n_dropped"] for r in line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 3000, 1: 3000, 2: 0}


def test_line_dedup_is_linear_in_lines(spark):
    from pyspark.sql import functions as F

    lines = F.transform(F.sequence(F.lit(1), F.lit(500_000)), lambda i: F.concat(F.lit("a line of the long text, number "), F.when(i % 5 == 0, F.concat(F.col("id"), F.lit("-"), i)).otherwise(i.cast("string"))))
    df = spark.range(3).select(F.col("id").alias("doc_id"), F.array_join(lines, "\n").alias("text"))
    got = line_dedup.drop_repeated_lines(df).select("doc_id", "n_lines", "n_dropped", F.size(F.split("kept_text", "\n")).alias("left")).collect()
    assert sorted(map(tuple, got)) == [(0, 500_000, 400_000, 100_000), (1, 500_000, 400_000, 100_000), (2, 500_000, 0, 500_000)]


# ---- simhash


def brute_print(text):
    w = words(text)
    s = [" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in s]
    return sum(1 << j for j in range(64) if 2 * sum(x >> j & 1 for x in h) > len(h))


def brute_components(prints):
    ids = list(range(len(prints)))
    parent = ids[:]

    def find(a):
        while parent[a] != a:
            a = parent[a]
        return a

    for a in ids:
        for b in ids[:a]:
            if (prints[a] ^ prints[b]).bit_count() <= 3:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return [find(a) for a in ids]


def test_fingerprints_and_components(spark):
    base = " ".join(f"v{i}" for i in range(400))
    texts = [*ODD, base, base + " tail", base.replace("v7 ", "z "), "one", None, " ".join(reversed(base.split()))]
    got = {r["doc_id"]: r for r in simhash.near_duplicates(docs(spark, *texts).selectExpr("*", "1 AS fp", "2 AS fingerprint")).collect()}
    prints = [brute_print(t) for t in texts]
    assert [got[i + 1]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i + 1]["component_id"] - 1 for i in range(len(texts))] == brute_components(prints)


@pytest.mark.parametrize("cell", [1, 8, 10**6])
def test_links_connect_what_brute_force_connects(spark, cell):
    rng = np.random.default_rng(3)
    near = [0x0123456789ABCDEF ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)) for _ in range(60)]
    chain = [0]
    for _ in range(20):
        chain.append(chain[-1] ^ sum(1 << int(b) for b in rng.choice(64, 3, replace=False)))
    values = sorted({*near, *chain, *(int(x) for x in rng.integers(0, 2**63, 60))})
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    links = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), cell=cell, block=16)
    from sieveline.operators.graph import components

    roots = {r["node"]: r["root"] for r in components(links).collect()}
    mine = [roots.get(v, v) for v in signed]
    want = brute_components(values)
    assert [[a == b for b in mine] for a in mine] == [[a == b for b in want] for a in want]


def test_near_duplicates_with_nulls_and_repeats(spark):
    rows = [(None, "same text here now"), (4, "same text here now"), (2, "same text here now"), (2, "same text here now"), (None, "alone in the world")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.near_duplicates(df).collect()), key=str)
    assert got == sorted([(None, 2), (4, 2), (2, 2), (2, 2), (None, None)], key=str)
    assert simhash.near_duplicates(docs(spark)).collect() == []
    kept = sorted(((r["doc_id"]) for r in simhash.drop_near_duplicates(df).collect()), key=str)
    assert kept == [2, 2, None, None]


# ---- near copies by similarity


def brute_sets(texts, width=5):
    w = [words(t) for t in texts]
    return [{tuple(x[a : a + min(width, len(x))]) for a in range(len(x) - min(width, len(x)) + 1)} if x else set() for x in w]


def brute_groups(texts, similarity=0.8):
    """The least position that links of the similarity reach."""
    sets = brute_sets(texts)
    root = list(range(len(texts)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(sets)):
        for b in range(a):
            if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return [find(a) for a in range(len(texts))]


def test_shingle_sets_equal_brute_force():
    value, ends = similar.shingle_sets(ODD)
    sets = brute_sets(ODD)
    assert np.diff(ends, prepend=0).tolist() == [len(s) for s in sets]


def test_bit_counts():
    rng = np.random.default_rng(1)
    hashes, counts = rng.integers(0, 2**63, 1310, dtype=np.uint64) * np.uint64(2), np.array([0, 3, 1, 256, 0, 1050, 0])
    want, at = [], 0
    for n in counts.tolist():
        want.append([sum(int(h) >> j & 1 for h in hashes[at : at + n]) for j in range(64)])
        at += n
    assert bit_counts(hashes, counts).tolist() == want


def test_near_copies_are_found_and_nothing_else(spark):
    """Of texts with words replaced, nearly all pairs of 0.8 and more are grouped, and no group
    joins what links don't; a chain of near copies is one group."""
    rng = np.random.default_rng(2)
    vocabulary = np.array([f"w{i}" for i in range(3000)])
    texts = [*ODD]
    for n in (40, 120, 400, 1500):
        for _ in range(12):
            base = rng.choice(vocabulary, n)
            texts.append(" ".join(base))
            for share in (0.004, 0.01, 0.02, 0.04):
                copy = base.copy()
                copy[rng.choice(n, max(1, int(n * share)), replace=False)] = "changed"
                texts.append(" ".join(copy))
    df = docs(spark, *texts).selectExpr("*", "1 AS c", "2 AS n", "3 AS __gone", "4 AS h")
    got = {r["doc_id"] - 1: r["component_id"] - 1 for r in similar.similar_groups(df).collect()}
    want = brute_groups(texts)
    assert sorted(got) == list(range(len(texts)))
    assert all(len({want[i] for i in got if got[i] == r}) == 1 for r in set(got.values()))
    assert np.mean([got[i] == want[i] for i in got]) >= 0.97
    assert all(got[i] == want[i] for i in range(len(ODD)))


def test_near_copies_with_nulls_and_repeats(spark):
    rows = [(None, "a b c d e f"), (4, "a b c d e f"), (2, "A b c\td e f"), (2, "a b c d e f"), (None, "x"), (7, "alone in all the world"), (7, "a b c d e f"), (9, None), (8, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(map(tuple, similar.similar_groups(df).collect()))
    assert got == [(2, 2), (2, 2), (4, 2), (7, 2), (7, 7), (8, 8), (9, 8)]
    kept = sorted(((r["doc_id"], r["text"]) for r in similar.drop_similar(df).collect()), key=str)
    assert kept == sorted([(None, "a b c d e f"), (2, "A b c\td e f"), (2, "a b c d e f"), (None, "x"), (7, "alone in all the world"), (7, "a b c d e f"), (8, "")], key=str)
    assert similar.similar_groups(docs(spark)).collect() == []


# ---- decontamination


def brute_leaks(rows, items, width=5, threshold=0.8):
    out = {}
    for i, text in rows:
        for j, item in items:
            w, k = words(item), min(width, len(words(item)))
            if i is None or text is None or item is None or not k:
                continue
            cut = lambda v: {tuple(v[a : a + k]) for a in range(len(v) - k + 1)}
            own, mine = cut(w), cut(words(text))
            if len(own & mine) >= threshold * len(own) - 1e-9:
                out[i, j] = (len(own & mine), len(own))
    return out


def test_decontamination(spark):
    rng = np.random.default_rng(0)
    vocabulary = [f"t{i}" for i in range(60)]
    items = [(j, " ".join(rng.choice(vocabulary, int(rng.integers(1, 40))))) for j in range(25)] + [(99, None), (98, " "), (97, "two Words"), (3, None)]
    rows = [(1, None), (2, ""), (3, "some two\twords here"), (None, items[0][1]), (5, LONG + " " + items[2][1].upper())]
    for i in range(80):
        w = items[i % 25][1].split()
        if i % 3 == 0 and len(w) > 12:
            w[int(rng.integers(len(w)))] = "zzz"
        rows.append((100 + i, " ".join([*rng.choice(vocabulary, 30), *w, *rng.choice(vocabulary, 30)])))
    rows.append((101, rows[-79][1]))
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS item_id", "0.5 AS containment")
    got = {(r["doc_id"], r["item_id"]): (r["n_shared"], r["n_item"]) for r in decontaminate.contaminated(df, bench).collect()}
    assert got == brute_leaks(rows, items)
    left = {r["doc_id"] for r in decontaminate.drop_contaminated(df, bench).collect()}
    assert left == {i for i, _ in rows} - {i for i, _ in got}


def test_decontamination_in_blocks_and_empty(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", 3)
    items = spark.createDataFrame([(i, f"alpha beta gamma delta e{i}") for i in range(4)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs(spark, "alpha beta gamma delta e2 x", "alpha beta gamma delta"), items).collect()}
    assert got == {(1, 2)}
    assert decontaminate.contaminated(docs(spark), items).collect() == []
    assert decontaminate.contaminated(docs(spark, "a"), items.limit(0)).collect() == []


def test_word_hashes_do_not_depend_on_the_block():
    one = Words(["some words in a row here"]).shingles(3)[0]
    many = Words([LONG, None, "some words in a row here", "x"])
    value, text = many.shingles(3)
    assert value[text == 2].tolist() == one.tolist()


# ---- classifiers


def labelled(spark, n=120):
    rng = np.random.default_rng(5)
    vocabulary = np.array([f"word{i}" for i in range(200)])
    rows, labels = [], []
    for i in range(n):
        good = i % 3 != 0
        body = " ".join(rng.choice(vocabulary, 80)) if good else " ".join([rng.choice(vocabulary)] * 80) + "!!"
        if i % 4 == 0:
            body += " nastyword at you"
        rows.append((i, body + ".", "en", "s", 0))
        labels.append((i, int(good), int(i % 4 == 0)))
    extra = [(1000, None), (1001, ""), (1002, LONG), (None, "x y z"), (5, rows[5][1])]
    rows += [(i, t, "en", "s", 0) for i, t in extra]
    labels += [(1, 1, 0), (2, None, None), (None, 1, 1), (7000, 0, 0)]
    return spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize(("run", "label"), [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_classifiers(spark, run, label):
    df, labels = labelled(spark)
    got = run(df.selectExpr("*", "1 AS score", "2 AS x", "3 AS y"), labels).collect()
    assert len(got) == df.count()
    truth = {r["doc_id"]: r[label] for r in labels.collect() if r["doc_id"] is not None and r["doc_id"] < 1000 and r[label] is not None}
    for r in got:
        assert 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
    held = [(r["predicted"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    assert len(held) > 10 and np.mean([a == b for a, b in held]) > 0.95


def slow_statistics(text):
    text, found = text or "", words(text)
    n, size, some = len(found), len(text.encode()), max(len(found), 1)
    marks, digits = [c for c in text if c in string.punctuation], [c for c in text if c in string.digits]
    capitals = sum("A" <= c <= "Z" or "\xc0" <= c <= "\xde" for c in text)
    letters = sum(ord(c) > 32 and c not in string.punctuation + string.digits for c in text)
    repeated = sum(a == b for a, b in zip(found, found[1:]))
    bare = sum(all(c in string.punctuation for c in w) for w in found)
    ends = sum(len(w.encode()) >= 3 and w[-1] in string.punctuation and w[-2] in string.punctuation for w in found)
    rate = lambda k, of, room=20: math.log((k + 0.5) / (of + room))
    commonest = max(Counter(found).values(), default=0)
    return [math.log1p(n), math.log((size + 1) / (n + 1)), math.sqrt(repeated / some), math.log1p(len(set(found))) / math.log1p(some), math.sqrt(commonest / some), rate(len(marks), size), rate(capitals, letters), rate(len(digits), size), math.sqrt(bare / some), rate(text.count("\n") + 1, n, 1), math.log1p(max((len(w.encode()) for w in found), default=0)), math.sqrt(ends / some)]


def test_quality_equals_the_discriminant_worked_out_directly(spark):
    df, labels = labelled(spark)
    odd = [(2000, "\xc0 la Carte!! ... 12,5 a A a\n\n", "en", "s", 0), (2001, "!?", "en", "s", 0), (2003, "x" * 50 + " \u4e2d\u6587 \u2026", "en", "s", 0)]
    df = df.unionByName(spark.createDataFrame(odd, SCHEMA))
    rows = [(r["doc_id"], slow_statistics(r["text"])) for r in df.collect()]
    known = {}
    for r in labels.collect():
        if r["doc_id"] is not None and r["quality"] in (0, 1):
            known[r["doc_id"]] = max(r["quality"], known.get(r["doc_id"], 0))
    learnt = [(x, known[i]) for i, x in rows if i in known and zlib.crc32(str(i).encode()) % 5]
    x, y = np.array([a for a, _ in learnt]), np.array([b for _, b in learnt])
    sides = [x[y == k] for k in (0, 1)]
    cov = [np.cov(part.T, bias=True) for part in sides]
    pooled = sum(len(part) * c for part, c in zip(sides, cov)) / len(x)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-12))
    densities = []
    for part, c in zip(sides, cov):
        shrink = max(quality.SHRINK, len(scale) / (len(scale) + len(part)))
        sigma = ((1 - shrink) * c + shrink * pooled) / np.outer(scale, scale)
        sigma = (1 - quality.RIDGE) * sigma + quality.RIDGE * np.diag(np.maximum(np.diag(sigma), 1e-6)) + 1e-9 * np.eye(len(scale))
        away = lambda v, part=part, sigma=sigma: (v / scale - part.mean(axis=0) / scale) @ np.linalg.solve(sigma, v / scale - part.mean(axis=0) / scale)
        densities.append(lambda v, part=part, sigma=sigma, away=away: math.log(len(part) / len(x)) - (np.linalg.slogdet(sigma)[1] + away(v)) / 2)
    margin = lambda v: (d := densities[1](np.array(v)) - densities[0](np.array(v))) and math.copysign(math.log1p(abs(d)), d)
    got = sorted((str(r["doc_id"]), r["score"]) for r in quality.score_quality(df, labels).collect())

    # the curve is the one whose penalised likelihood is stationary, and each score lies on it
    m = np.array([margin(v) for v in x])
    a, b = 1.0, 0.0
    for _ in range(200):
        p = 1 / (1 + np.exp(-(a * m + b)))
        gradient = np.array([(m * (p - y)).sum() + (a - 1), (p - y).sum() + 0.01 * b])
        w = p * (1 - p)
        a, b = np.array([a, b]) - np.linalg.solve([[(m * m * w).sum() + 1, (m * w).sum()], [(m * w).sum(), w.sum() + 0.01]], gradient) / 2
    want = sorted((str(i), 1 / (1 + math.exp(-max(-60, min(60, a * margin(v) + b))))) for i, v in rows)
    assert [i for i, _ in got] == [i for i, _ in want]
    assert np.allclose([s for _, s in got], [s for _, s in want], atol=1e-6)


@pytest.mark.parametrize("run", [quality.score_quality, toxicity.score_toxicity])
def test_classifiers_never_see_held_out_labels(spark, run):
    from pyspark.sql import functions as F

    df, labels = labelled(spark)
    lied = labels.withColumns({c: F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, 1 - F.col(c)).otherwise(F.col(c)) for c in ("quality", "toxic")})
    scores = lambda l: sorted((str(r["doc_id"]), r["score"]) for r in run(df, l).collect())
    assert scores(labels) == scores(lied)


@pytest.mark.parametrize("run", [quality.score_quality, toxicity.score_toxicity])
def test_classifiers_without_labels_or_rows(spark, run):
    df, labels = labelled(spark, 9)
    assert {r["score"] for r in run(df, labels.limit(0)).collect()} == {0.5}
    assert run(df.limit(0), labels).collect() == []


def test_automaton_equals_edit_distance():
    def distance(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row = row, [i]
            for j, y in enumerate(b, 1):
                row.append(min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y)))
        return row[-1]

    terms = ["idiot", "worthless", "scum", "stup*", "nastywo*"]
    automaton = toxicity.Automaton(terms)
    rng = np.random.default_rng(2)
    for _ in range(1500):
        word = list(terms[rng.integers(len(terms))].rstrip("*") + "ab"[: rng.integers(0, 2)])
        for _ in range(rng.integers(0, 4)):
            at = int(rng.integers(len(word) + 1))
            word[at : at + int(rng.integers(0, 2))] = list("abst"[: rng.integers(0, 2)])
        word = "".join(word)
        want = set()
        for t, term in enumerate(terms):
            body = term.rstrip("*")
            d = min(distance(word[:k], body) for k in range(len(word) + 1)) if term != body else distance(word, body)
            if d <= automaton.allowed[t]:
                want.add((d, t))
        assert set(automaton.match(word)) == want, word


@pytest.mark.parametrize(
    ("text", "quoted"),
    [
        ("c” this idiot “d e”", False),
        ('"one two three four five six seven eight nine" this idiot "ok"', False),
        ('"one two three four five six seven eight nine ten idiot" he wrote', True),
        ("he said “you idiot”", True),
        ("„so ein idiot“ sagte er", True),
        ("„so“ ein idiot “x”", False),
        ("« un idiot » dit-il", True),
        ("»idiot« sagt", True),
        ('a 5" idiot, a 6" one', False),
        ('"never ended idiot', False),
        ('("idiot")', True),
        ('"a" idiot "b"', False),
        ("“a «b» idiot”", True),
        ("idiot", False),
        ("“" + "word " * 5000 + "idiot”", True),
    ],
)
def test_quotations_are_told_by_the_side_of_their_marks(text, quoted):
    """By a plain walk over the characters between a beginning and its end."""
    scorer = toxicity.Scorer(["idiot"], {(0, 0): 5.0}, [], 0.5)
    x, n = scorer.features([None, text, "", text])
    assert n == [0, 1, 0, 1]
    at = text.index("idiot")
    assert any(a < at < b for a, b in toxicity.quotations(text)) == quoted
    assert (x[1, 1] < 5 * toxicity.REPORTED) == quoted and (x[1] == x[3]).all()


def test_a_long_text_does_not_empty_the_sample(spark):
    """Wherever the long text stands in the order, the others are learnt from."""
    rows = [(i, ("you vile slugger go away " if i % 3 == 0 else "the weather was mild and calm today ") + f"w{i}", int(i % 3 == 0)) for i in range(300)]
    long = [(1000 + k, "calm words " * 20_000, k % 2) for k in range(20)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows + long], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows + long], "doc_id long, toxic int")
    found = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, labels, sample_bytes=50_000).collect()}
    assert all(found[i] == y for i, _, y in rows)


def test_quotation_counts_less():
    scorer = toxicity.Scorer(["idiot"], {(0, 0): 5.0, (1, 0): 4.0}, [1.0, 0.0, -1.0], 0.1)
    plain, quoted, wrong = scorer.score(scorer.features(["you are an idiot", 'he wrote "what an idiot" there', "an idi0t"])[0])
    assert plain > wrong > quoted


@pytest.mark.parametrize("seed", [1, 2])
def test_near_copies_of_a_dense_family_in_any_partitioning(spark, seed):
    """300 texts, each with 1 to 4 of 120 words replaced: equal groups for any layout, nothing linked
    below the similarity, and 19 of 20 of the texts that an exact search drops."""
    import random

    rng = random.Random(seed)
    base = [f"w{rng.randrange(4000)}" for _ in range(120)]
    texts = []
    for _ in range(300):
        words = list(base)
        for place in rng.sample(range(120), rng.randint(1, 4)):
            words[place] = f"x{rng.randrange(4000)}"
        texts.append(" ".join(words))
    found = []
    for parts in (1, 3, 7):
        df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(parts)
        found.append(dict(map(tuple, similar.similar_groups(df).collect())))
    assert found[0] == found[1] == found[2]
    want = brute_groups(texts)
    assert all(want[i] == want[r] for i, r in found[0].items())
    dropped = sum(i != r for i, r in enumerate(want))
    assert sum(i != r for i, r in found[0].items()) >= 0.95 * dropped


@pytest.mark.parametrize("frequent", [True, False])
def test_near_copies_of_a_dense_family_are_all_linked(spark, monkeypatch, frequent):
    """The groups are those of all pairs, for any choice of shingles that come last."""
    if not frequent:
        monkeypatch.setattr(similar, "FREQUENT", 1 << 40)
    rng = np.random.default_rng(7)
    texts = [*ODD]
    for size, most in ((60, 3), (120, 5), (250, 9)):
        base = rng.choice([f"w{i}" for i in range(4000)], size)
        for _ in range(120):
            copy = base.copy()
            copy[rng.choice(size, rng.integers(1, most + 1), replace=False)] = f"x{rng.integers(4000)}"
            texts.append(" ".join(copy))
    got = {r["doc_id"] - 1: r["component_id"] - 1 for r in similar.similar_groups(docs(spark, *texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts)


def test_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(8)
    frequent = np.arange(0, 400, 7, dtype=np.uint64)
    for _ in range(300):
        a = set(rng.choice(400, int(rng.integers(1, 60)), replace=False).tolist())
        b = set(list(a)[: int(len(a) * rng.uniform(0.7, 1)) + 1]) | set(rng.choice(400, int(rng.integers(0, 8))).tolist())
        value = np.concatenate([np.sort(np.array(list(x), np.uint64)) for x in (a, b)])
        x, y = map(set, similar.prefixes(value, np.array([len(a), len(a) + len(b)]), 0.8, frequent).to_pylist())
        assert len(a & b) < 0.8 * len(a | b) - 1e-9 or x & y


def test_parities_rule_out_no_pair_of_the_similarity(spark):
    rng = np.random.default_rng(10)
    sets = []
    for n in (1, 5, 60, 64, 65, 130, 500, 1030):
        base = rng.integers(0, 1 << 63, n)
        for share in (0.0, 0.05, 0.1, 0.11, 0.2, 0.5):
            sets += [base[int(n * share) :], np.append(base[int(n * share / 2) :], rng.integers(0, 1 << 63, int(n * share / 2)))]
    sets = [set(x.tolist()) for x in sets if len(x)]
    value = np.concatenate([np.array(list(x), np.uint64) for x in sets])
    marks = similar.parities(value, np.cumsum([len(x) for x in sets])).to_pylist()
    classes = spark.createDataFrame([(i, len(x), m) for i, (x, m) in enumerate(zip(sets, marks, strict=True))], "c long, n long, parity array<long>")
    every = [(a, b) for b in range(len(sets)) for a in range(b)]
    pairs = spark.createDataFrame([(a, b, a + b) for a, b in every], "a long, b long, bits long")
    for similarity in (0.8, 0.3):
        left = similar.left_open(pairs, classes, similarity).collect()
        assert all(r["bits"] == r["a"] + r["b"] for r in left)
        left = {(r["a"], r["b"]) for r in left}
        assert {p for p in every if len(sets[p[0]] & sets[p[1]]) >= similarity * len(sets[p[0]] | sets[p[1]])} <= left
        fit = {(a, b) for a, b in every if 32 < min(len(sets[a]), len(sets[b])) >= 0.8 * max(len(sets[a]), len(sets[b]))}
        strange = {p for p in fit if not sets[p[0]] & sets[p[1]]}
        assert similarity < 0.8 or (strange and not strange & left)


def test_sets_are_read_for_few_pairs_below_the_similarity(spark, monkeypatch):
    """Texts with one rare passage in common, and so shingles of their prefixes, aren't compared set by set;
    before, each such pair carried a whole set through two shuffles."""
    monkeypatch.setattr(similar, "FREQUENT", 1 << 40)
    compared = []

    def counted(pairs, sets, similarity, of=similar.verified):
        compared.append(pairs.count())
        return of(pairs, sets, similarity)

    monkeypatch.setattr(similar, "verified", counted)
    rng = np.random.default_rng(11)
    passage = [f"p{i}" for i in range(30)]
    texts = [" ".join([*passage, *[f"w{x}" for x in rng.integers(0, 100_000, 90)]]) for _ in range(60)]
    texts += [texts[7] + " and one more"]
    got = {r["doc_id"] - 1: r["component_id"] - 1 for r in similar.similar_groups(docs(spark, *texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_groups(texts)
    assert sum(compared) < len(texts)


def test_links_between_groups_give_the_components_of_all_links(spark):
    """Links found later join the groups of the earlier ones and classes without a group; before, all links were searched again."""
    from sieveline.operators.graph import components

    rng = np.random.default_rng(12)
    early, late = ([tuple(map(int, sorted(x))) for x in rng.integers(0, 300, (n, 2)) if x[0] != x[1]] for n in (120, 60))
    roots = components(spark.createDataFrame(early, "a long, b long"))
    of = {r["node"]: r["root"] for r in roots.collect()}
    between = [(of.get(a, a), of.get(b, b)) for a, b in late]
    links = spark.createDataFrame([x for x in between if x[0] != x[1]], "root_a long, root_b long")
    want = sorted(map(tuple, components(spark.createDataFrame(early + late, "a long, b long")).collect()))
    got = sorted(map(tuple, similar.linked_roots(roots, links).collect()))
    alone = {x for link, ends in zip(late, between, strict=True) if ends[0] == ends[1] for x in link} - {n for n, _ in got}
    assert not alone and got == want
    assert similar.linked_roots(roots, links.limit(0)) is roots


def test_filling_in_two_steps_is_that_of_the_whole_order():
    rng = np.random.default_rng(9)
    for n in (0, 1, 5, 63, 64, 65, 400):
        for most in (1, 3, 40, 3000):
            scores, left, space = rng.integers(0, 30, n).astype(float), rng.integers(1, most + 1, n), int(rng.integers(1, 2048))
            taken, spare, room = [], -1, space
            for d in sorted(np.flatnonzero(scores).tolist(), key=lambda d: (-scores[d], d)):
                if room and left[d] <= room:
                    taken.append(d)
                    room -= left[d]
                elif room and spare < 0:
                    spare = d
            assert packing._filling(scores, left, space) == (taken, spare)
