"""Vectors, pages and the pipeline: brute force, nulls, ties, repeats, empty tables, clashes."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from sieveline.llm import ann, url_rules, warc
from sieveline.llm.queries import ORACLES, QUERIES, URL_RULES

SF = "/root/testdata/sf0.001"

# ---- nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_nearest_equals_brute_force_on_a_small_table(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(90, 8)).astype(np.float32)
    x[40:70] = x[40]  # copies
    x[5] *= 3
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(90)]
    bad = [(200, None, 0), (220, [], 0), (240, [0.0] * 8, 0), (260, [1.0, None] + [0.0] * 6, 0), (280, [float("nan")] + [1.0] * 7, 0), (300, [float("inf")] + [1.0] * 7, 0), (320, [1.0] * 3, 0), (None, [1.0] * 8, 0)]
    df = vectors(spark, [*rows, *bad, rows[0], rows[20]]).selectExpr("*", "1 AS rank", "2 AS cid", "3 AS ids")
    got = {}
    for r in ann.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    y = x.astype(np.float64)
    assert set(got) == {0, 20, 40, 60, 80}
    for q, found in got.items():
        score = y @ y[q]
        score[q] = -np.inf
        want = sorted(range(90), key=lambda i: (-round(score[i], 9), i))[:20]
        assert [i for _, i, _ in sorted(found)] == want
        assert np.allclose([s for _, _, s in sorted(found)], score[want])


def test_nearest_returns_all_if_there_are_fewer(spark):
    got = ann.nearest(vectors(spark, [(0, [1.0, 0.0], 0), (1, [0.5, 0.5], 0), (2, [0.5, 0.5], 0)]), F.col("vec_id") % 20 == 0).collect()
    assert sorted((r["rank"], r["vec_id"]) for r in got) == [(1, 1), (2, 2)]
    assert ann.nearest(vectors(spark, [(0, [1.0], 0)]), F.lit(True)).collect() == []
    assert ann.nearest(vectors(spark, []), F.lit(True)).collect() == []
    assert ann.nearest(vectors(spark, [(1, [1.0], 0), (2, [1.0], 0)]), F.col("vec_id") % 20 == 0).collect() == []


def test_nearest_of_several_lengths(spark):
    """Each length for itself; a query with vectors of two lengths has candidates of both."""
    rng = np.random.default_rng(6)
    rows = [(i, [float(v) for v in rng.normal(size=(2, 4, 7)[i % 3]).astype(np.float32)], 0) for i in range(80)] + [(20, [0.5, 0.25, 1.0, 2.0], 0)]
    got = {}
    for r in ann.nearest(vectors(spark, rows), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], round(r["score"], 9)))
    want = {}
    for q, x, _ in rows:
        if q % 20 == 0:
            for i, y, _ in rows:
                if i != q and len(x) == len(y):
                    score = round(float(np.dot(np.array(x), np.array(y))), 9)
                    want.setdefault(q, {})[i] = max(score, want.get(q, {}).get(i, -np.inf))
    assert set(got) == {0, 20, 40, 60}
    for q, found in got.items():
        best = sorted(want[q].items(), key=lambda x: (-x[1], x[0]))[:20]
        assert sorted(found) == [(n, i, s) for n, (i, s) in enumerate(best, 1)]


def test_recall_over_many_lists(spark, monkeypatch):
    monkeypatch.setattr(ann, "LIST_SIZE", 40)
    monkeypatch.setattr(ann, "SHARD", 300)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 16))
    x = centres[rng.integers(12, size=1500)] + 0.4 * rng.normal(size=(1500, 16))
    got = {}
    for r in ann.nearest(vectors(spark, [(i, [float(v) for v in x[i].astype(np.float32)], 0) for i in range(1500)]), F.col("vec_id") % 20 == 0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    y = x.astype(np.float32).astype(float)
    hits = [len(got[q] & {int(i) for i in [i for i in np.argsort(-(y @ y[q])) if i != q][:20]}) for q in range(0, 1500, 20)]
    assert np.mean(hits) / 20 >= 0.9


def test_the_index_reads_little_of_clustered_vectors():
    """20,000 vectors in 64 clusters: few centroids are compared, few postings read, boundary
    vectors lie on several lists, and recall against brute force is high."""
    rng = np.random.default_rng(6)
    centres = (rng.normal(size=(16, 1, 64)) + 0.5 * rng.normal(size=(16, 8, 64))).reshape(-1, 64)
    x = centres[rng.integers(128, size=20_000)] + 0.35 * rng.normal(size=(20_000, 64))
    lists = ann.fit(x, len(x), float((x * x).sum(axis=1).max()), 20)
    who, home = lists.homes(x)
    size = np.bincount(home, minlength=len(lists.centroids))
    asks = np.arange(0, 20_000, 100)
    of, reads, compared = lists.probes(x[asks])
    assert compared.mean() < 0.6 * len(lists.centroids)
    assert size[reads].sum() / len(asks) < 0.1 * len(home)
    assert 0.05 < (np.bincount(who) > 1).mean() < 0.6
    read = [set(reads[of == i].tolist()) for i in range(len(asks))]
    homes = {}
    for i, at in zip(who.tolist(), home.tolist(), strict=True):
        homes.setdefault(i, set()).add(at)
    hits = 0
    for n, i in enumerate(asks):
        score = x @ x[i]
        score[i] = -np.inf
        hits += sum(bool(homes[int(j)] & read[n]) for j in np.argsort(-score)[:20])
    assert hits / (20 * len(asks)) >= 0.95


def test_the_graph_search_finds_the_nearest_lists():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(300, 1, 8)) + 0.3 * rng.normal(size=(300, 40, 8))
    x = x.reshape(-1, 8)
    lists = ann.fit(x, len(x) * 4, float((x * x).sum(axis=1).max()), 20)
    y = lists.asked(x[:500])
    at, far, compared = lists.search(y, 8)
    exact = np.sqrt(ann.squared(y, lists.centroids))
    assert np.allclose(far, np.take_along_axis(exact, at, axis=1))
    want = np.sort(exact, axis=1)[:, :8]
    assert np.isclose(far, want)[:, 0].mean() > 0.95 and compared.max() < len(lists.centroids)


# ---- URL rules


def brute_rule(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = host.translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    best = max(((len(h + p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best


ODD_URLS = [None, "", "no scheme", "http://", "http://Example.COM", "http://example.com/en/x?q=1#f", "https://www.example.com/en/", "http://a.net/es/1", "http://net/fr/", "http://xnet/fr/", "x://y://z/en", "http://É.example.com/EN/\nq", "http://example.org#/en/", "http://example.com?x=/en/", "http://" + "a." * 200 + "net/es/" + "y" * 5000]


@pytest.mark.parametrize("inline", [200, 0])
def test_explicit_rules(spark, monkeypatch, inline):
    monkeypatch.setattr(url_rules, "INLINE", inline)
    rows = [(i, u) for i, u in enumerate([*ODD_URLS, ODD_URLS[5]])]
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS HOST", "1 AS verdict", "2 AS tokens", "3 AS item")
    got = {r["page_id"]: r for r in url_rules.judge_urls(df, URL_RULES).collect()}
    assert len(got) == len(rows) and "tokens" in df.columns
    for i, url in rows:
        host, path, best = brute_rule(url, URL_RULES)
        assert (got[i]["host"], got[i]["path"], got[i]["rule"]) == (host, path, best and best[1])
        assert got[i]["verdict"] == best[2] if best else got[i]["verdict"] in ("allow", "block")


def test_mined_rules_judge_the_rest(spark):
    urls = [f"http://s{i % 5}.shop.net/es/{i}?ad=1" for i in range(40)] + [f"http://s{i % 5}.news.com/x/{i}" for i in range(40)] + ["http://other.org/es/7?ad=2", "http://other.org/x/9", "ftp://plain.org/"]
    got = {r["url"]: r for r in url_rules.judge_urls(spark.createDataFrame([(u,) for u in urls], "url string"), URL_RULES).collect()}
    assert got["http://other.org/es/7?ad=2"]["verdict"] == "block" and got["http://other.org/es/7?ad=2"]["rule"] is None
    assert got["http://other.org/x/9"]["verdict"] == "allow"
    # the verdict is that of the best fitting rule, by brute force over all rules
    read = spark.createDataFrame([(u,) for u in urls], "url string").withColumns({"h": url_rules.url_host(F.col("url")), "p": url_rules.url_path(F.col("url"))})
    tokens = {r["url"]: set(r["t"]) for r in read.select("url", url_rules.url_tokens(F.col("url"), F.col("h"), F.col("p")).alias("t")).collect()}
    labelled = [(sorted(tokens[u]), b[2]) for u in urls if (b := brute_rule(u, URL_RULES)[2])]
    mined = url_rules.mine(spark.createDataFrame(labelled, "tokens array<string>, verdict string")).collect()
    assert mined
    for u in urls:
        if brute_rule(u, URL_RULES)[2] is None:
            fit = [(-m["confidence"], -len(m["antecedent"]), -m["support"], m["antecedent"], m["verdict"]) for m in mined if set(m["antecedent"]) <= tokens[u]]
            assert got[u]["verdict"] == (min(fit)[4] if fit else "allow")


def test_urls_of_many_shared_parts(spark):
    """Neither 40 keys that 200 URLs share, each left out at random, nor 5,000 keys of one URL
    multiply the itemsets; single tokens are counted whole."""
    rng = np.random.default_rng(3)
    urls = [f"http://a.net/{'es' if i % 2 else 'x'}/?" + "&".join(f"k{j}=1" for j in range(40) if rng.random() < 0.95) for i in range(200)]
    urls += [f"http://b.com/{i}?late{i % 3}" for i in range(100)] + ["http://b.org/?" + "&".join(f"k{j}=1" for j in range(5000)), "http://c.org/?late1"]
    judged = [(r["url"], r["verdict"]) for r in url_rules.judge_urls(spark.createDataFrame([(u,) for u in urls], "url string"), URL_RULES).collect()]
    assert sorted(u for u, _ in judged) == sorted(urls) and dict(judged)["http://c.org/?late1"] == "allow"
    read = spark.createDataFrame([(u,) for u in urls], "url string").withColumns({"h": url_rules.url_host(F.col("url")), "p": url_rules.url_path(F.col("url"))})
    rows = [(r["t"], brute_rule(r["url"], URL_RULES)[2]) for r in read.select("url", url_rules.url_tokens(F.col("url"), F.col("h"), F.col("p")).alias("t")).collect()]
    labelled = [(t, b[2]) for t, b in rows if b]
    mined = url_rules.mine(spark.createDataFrame(labelled, "tokens array<string>, verdict string")).collect()
    base = {v: sum(w == v for _, w in labelled) / len(labelled) for v in ("allow", "block")}

    def rates(antecedent, verdict):
        held = [w for t, w in labelled if set(antecedent) <= set(t)]
        return held.count(verdict) / len(held), held.count(verdict) / len(labelled)

    for m in mined:
        confidence, support = rates(m["antecedent"], m["verdict"])
        assert (m["confidence"], m["support"], m["lift"]) == pytest.approx((confidence, support, confidence / base[m["verdict"]]))
        assert m["lift"] >= url_rules.LIFT and m["confidence"] >= url_rules.CONFIDENCE and len(m["antecedent"]) <= url_rules.MOST_TOKENS
        # nothing that a part of it says already
        assert not any(set(o["antecedent"]) < set(m["antecedent"]) and o["verdict"] == m["verdict"] and o["confidence"] >= m["confidence"] for o in mined)
    single = {t for t, _ in labelled for t in t}
    for t in single:
        for v in base:
            confidence, support = rates([t], v)
            if support >= url_rules.SUPPORT and confidence >= url_rules.CONFIDENCE and confidence / base[v] >= url_rules.LIFT:
                assert any(m["antecedent"] == [t] and m["verdict"] == v for m in mined)


@pytest.mark.parametrize("most_tokens", [8, 2, 12])
def test_rules_of_urls_of_twelve_tokens_equal_brute_force(spark, most_tokens):
    """All antecedents count, of the least telling tokens too: only k10 and k11 together, or neither, mean
    block, and ten other tokens tell more alone."""
    rng = np.random.default_rng(5)
    labelled = []
    for _ in range(240):
        bad = rng.random() < 0.5
        pair = [bool(rng.random() < 0.5)] * 2 if bad else [False, True][:: rng.choice([1, -1])]
        on = [rng.random() < (0.8 if bad else 0.6) for _ in range(10)] + pair
        labelled.append(([f"k{j:02}" for j in range(12) if on[j]], "block" if bad else "allow"))
    options = {"support": 0.05, "confidence": 0.6, "lift": 1.1, "most_tokens": most_tokens}
    got = {(tuple(r["antecedent"]), r["verdict"]): r["confidence"] for r in url_rules.mine(spark.createDataFrame(labelled, "tokens array<string>, verdict string"), **options).collect()}
    masks = np.array([sum(1 << int(t[1:]) for t in tokens) for tokens, _ in labelled])
    bad = np.array([v == "block" for _, v in labelled])
    want = {}
    for a in sorted(range(1, 1 << 12), key=int.bit_count):
        held = masks & a == a
        for verdict, own in (("allow", ~bad), ("block", bad)):
            n = int((held & own).sum())
            if n / 240 >= 0.05 and (rate := n / int(held.sum())) >= 0.6 and rate / own.mean() >= 1.1 and not any(b & a == b and v == verdict and c >= rate for (b, v), c in want.items()):
                want[a, verdict] = rate
    assert max(int.bit_count(a) for a, _ in want) > 2 and (0b11 << 10, "block") in want
    assert got == {(tuple(f"k{j:02}" for j in range(12) if a >> j & 1), v): c for (a, v), c in want.items()}


def test_rules_are_mined_from_all_labelled_pages(spark):
    rows = spark.range(60_000).select(F.when(F.col("id") < 54_000, F.array(F.lit("h:hot"))).otherwise(F.array(F.lit("h:rare"))).alias("tokens"), F.when(F.col("id") < 54_000, "allow").otherwise("block").alias("verdict"))
    got = {(*r["antecedent"], r["verdict"]): (round(r["support"], 9), r["confidence"]) for r in url_rules.mine(rows).collect()}
    assert got == {("h:hot", "allow"): (0.9, 1.0), ("h:rare", "block"): (0.1, 1.0)}


def test_url_rules_of_empty_tables(spark):
    empty = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge_urls(empty, URL_RULES).collect() == []
    got = url_rules.judge_urls(spark.createDataFrame([(1, "http://a.b/")], "page_id long, url string"), []).collect()
    assert [(r["rule"], r["verdict"]) for r in got] == [(None, "allow")]


# ---- WARC


def brute_records(rows):
    newest = {}
    for i, _, html in rows:
        if i is not None and len((html or "").encode()) >= 1000:
            newest[html] = max(i, newest.get(html, i))
    copies = [h for _, _, h in rows]
    out = []
    for i, _, html in rows:
        payload = (html or "").encode()
        to = newest.get(html)
        to = None if to == i or copies.count(html) == 1 else to
        out.append((i, len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if to is not None else "response", to))
    return out


def test_warc_round_trip(spark, monkeypatch):
    big, other = "é" * 500, "x" * 1000
    rows = [(1, "http://a.com/1", big), (2, "http://b.com/ x\ty", big), (3, None, big), (4, "", None), (5, "http://a.com/1", ""), (6, "u", "x" * 999), (7, "u", "x" * 999), (8, "http://É.org/é?q=ü#z", other), (9, "http://a.com/1", other), (9, "http://a.com/1", other), (None, "http://n.com", big), (None, None, "lone"), (-5, "http://a.com/1", "line\r\n\r\nWARC/1.1\r\n"), (11, "http://z.com/" + "p" * 20_000, "y" * 300_000)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS payload", "2 AS line", "3 AS newest")
    order = lambda r: tuple((v is None, v) for v in r)
    assert sorted(map(tuple, warc.round_trip(df).collect()), key=order) == sorted(brute_records(rows), key=order)
    assert warc.round_trip(df.limit(0)).collect() == []


def test_capture_index_finds_each_entry(spark):
    from sieveline.llm.common import scratch_path

    rows = [(f"com,k{i % 37})/".encode(), None if i % 50 == 0 else i, f'["f", {i}, 1]') for i in range(400)]
    folder = scratch_path(spark, "index")
    store, at = warc.filesystem(folder)
    store.create_dir(at, recursive=True)
    parts = warc.write_index(spark.createDataFrame(rows, warc.CAPTURE), folder, block_lines=7, part_lines=60)
    index = warc.CaptureIndex(folder, parts)
    assert len(parts) > 1
    for key in {k for k, _, _ in rows}:
        for page in {p for k, p, _ in rows if k == key}:
            assert sorted(o for _, o, _ in index.find(key, page)) == sorted(i for i, (k, p, _) in enumerate(rows) if (k, p) == (key, page))
    assert list(index.find(b"com,none)/", 3)) == [] and list(index.find(b"zzz", 3)) == []


def test_damaged_records_are_refused():
    data = warc.record(1, "http://a.com/", b"body", hashlib.sha1(b"body").hexdigest(), None)
    assert warc.parse(data)[1] == b"body"
    with pytest.raises(ValueError):
        warc.parse(data[:-3])


# ---- queries and the pipeline


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels", "embeddings", "conversations"):
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_equal_their_sql(spark, duck, name):
    found = QUERIES[name](spark, SF)
    columns = sorted(found.columns)
    want = duck.sql(ORACLES[name])
    assert sorted(want.columns) == columns
    key = lambda row: tuple(str(round(v, 9) if isinstance(v, float) else v) for v in row)
    assert sorted(key([r[c] for c in columns]) for r in found.collect()) == sorted(key([dict(zip(want.columns, r, strict=True))[c] for c in columns]) for r in want.fetchall())


def test_every_operator_has_one_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 11))


def test_pipeline_equals_its_operators_by_brute_force(spark):
    import corpus_pipeline
    from test_text_operators import brute_groups, brute_leaks, brute_lines, check_packing

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "near_dedup", "decontamination", "packing"]
    bad = {r["doc_id"] for r in QUERIES["op4_toxicity"](spark, SF).where("predicted = 1").collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.collect() if r["doc_id"] not in bad]
    clean = stages["toxicity"](spark, docs, SF)
    assert clean.columns == docs.columns and {r["doc_id"] for r in clean.collect()} == {i for i, _ in rows}
    after_lines = {r["doc_id"]: r["text"] for r in stages["line_dedup"](spark, clean, SF).collect()}
    want = {i: h for i, _, _, h in brute_lines(rows)}
    assert {i: hashlib.sha256((t or "").encode()).hexdigest() for i, t in after_lines.items()} == want
    ids = sorted(after_lines)
    roots = brute_groups([after_lines[i] for i in ids])
    kept = [i for n, i in enumerate(ids) if roots[n] == n]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    leaks = {i for i, _ in brute_leaks([(i, after_lines[i]) for i in kept], items)}
    final = {i: after_lines[i] for i in kept if i not in leaks}
    check_packing(corpus_pipeline.run(spark, SF).collect(), final)


def test_pipeline_stages_keep_columns_and_odd_rows(spark):
    import corpus_pipeline

    line = "a line that three documents hold"
    texts = [None, "", line + "\none", line + "\ntwo", line + "\nthree", "same words in the same order here", "same words in the same order here"]
    rows = [(i or None, t, "en", "s", len(t or ""), i) for i, t in enumerate(texts)] + [(5, texts[5], "en", "s", 33, 9)]
    clashes = ["__gone", "__hit", "__drop", "__id", "__did", "__text", "__row"]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, row long").selectExpr("*", *[f"row AS {c}" for c in clashes])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, SF)
        assert made.columns == docs.columns, name
        got = made.collect()
        assert all(r["__gone"] == r["row"] == r["__id"] for r in got)
        kept = sorted(r["row"] for r in got)
        assert kept == ([0, 1, 2, 3, 4, 5, 9] if name == "near_dedup" else list(range(7)) + [9]), name
        assert stage(spark, docs.limit(0), SF).collect() == []
    assert {r["row"]: r["text"] for r in corpus_pipeline.line_dedup(spark, docs, SF).collect()}[3] == "two"
    assert sum(r["doc_id"] is None for r in corpus_pipeline.packing(spark, docs, SF).collect()) == 1
    assert corpus_pipeline.packing(spark, docs.limit(0), SF).collect() == []


def test_helper_columns_give_way_to_the_caller_s(spark):
    from sieveline.llm import decontaminate, simhash, toxicity

    names = ["__gone", "__hit", "__shape", "__mined", "__tokens", "__host", "__h1", "__best", "tokens", "best", "known"]
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(30).selectExpr("*", *[f"doc_id AS {c}" for c in names])
    made = [simhash.drop_near_duplicates(docs), toxicity.drop_toxic(docs, spark.read.parquet(f"{SF}/labels.parquet")), decontaminate.drop_contaminated(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))]
    for df in made:
        assert df.columns == docs.columns and all(r["doc_id"] == r[c] for r in df.collect() for c in names)
    pages = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").selectExpr("*", *[f"page_id AS {c}" for c in names])
    judged = url_rules.judge_urls(pages, URL_RULES)
    assert judged.columns == [*pages.columns, "host", "path", "rule", "verdict"] and all(r["page_id"] == r[c] for r in judged.collect() for c in names)
