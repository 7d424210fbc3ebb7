"""Projections, catalogue checks, greedy selections and streams over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import pixels
from sieveline.functions import scalars as S
from sieveline.operators import aggregates as A
from sieveline.operators import ledger as L
from sieveline.operators import projections as P
from sieveline.operators import lazy as G
from sieveline.operators import ranking as R
from sieveline.operators import selection as X
from sieveline.operators.program import exact_supplement
from sieveline.plans.boxes import BOXES, boxes
from sieveline.plans.catalog import register, table
from sieveline.session import shared_dir
from sieveline.sources import readers
from sieveline.streaming import incremental as I


@register(
    "candidate_rows",
    f"""{BOXES} SELECT o_orderkey AS image, 'Clerk ' || o_custkey || ' — ' || o_orderpriority AS attribution, 'author-' || substr(sha256('Clerk ' || o_custkey), 1, 16) AS provenance_group_id,
    coalesce((SELECT array_to_string(list_sort(list_distinct(list(class_id::VARCHAR))), ';') FROM boxes WHERE image = o_orderkey), '') AS compiled_classes, (SELECT count(*) FROM boxes WHERE image = o_orderkey) AS annotation_count FROM orders""",
)
def candidate_rows(spark: SparkSession, d: str) -> DataFrame:
    images = table(spark, d, "orders").select(F.col("o_orderkey").alias("image"), F.format_string("Clerk %d", "o_custkey").alias("author"), F.lit(" ").alias("author_url"), F.col("o_orderpriority").alias("license"))
    return P.candidate_rows(images, boxes(spark, d), "image").select("image", "attribution", "provenance_group_id", "compiled_classes", F.col("annotation_count").cast("long").alias("annotation_count"))


@register("mapped_classes", "SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'house' WHEN 'AUTOMOBILE' THEN 'car' END AS compiled_class FROM customer WHERE c_mktsegment IN ('BUILDING', 'AUTOMOBILE')")
def mapped_classes(spark: SparkSession, d: str) -> DataFrame:
    return P.mapped_classes(table(spark, d, "customer"), {"BUILDING": "house", "AUTOMOBILE": "car"}, "c_mktsegment").select("c_custkey", "compiled_class")


@register("normalized_manifest", "SELECT s_suppkey::VARCHAR AS s_suppkey, s_name, '' AS author FROM supplier")
def normalized_manifest(spark: SparkSession, d: str) -> DataFrame:
    return P.with_columns_or_blank(table(spark, d, "supplier"), ["s_suppkey", "s_name", "author"])


@register("fallback_fields", "SELECT conv_id, turn, CASE WHEN turn % 3 = 0 THEN role WHEN turn % 3 = 1 THEN 'group-' || conv_id ELSE '' END AS value FROM conversations")
def fallback_fields(spark: SparkSession, d: str) -> DataFrame:
    turn = F.col("turn") % 3
    value = P.filled(F.when(turn == 0, F.col("role")).otherwise("  "), F.when(turn == 1, F.concat(F.lit("group-"), F.col("conv_id").cast("string"))))
    return table(spark, d, "conversations").select("conv_id", "turn", value.alias("value"))


@register("triage", "SELECT doc_id, CASE WHEN toxic = 1 THEN 0 WHEN quality = 0 THEN 1 WHEN doc_id % 10 = 0 THEN 2 ELSE 9 END AS triage_priority, CASE WHEN toxic = 1 THEN 'required' WHEN quality = 0 THEN 'missing_detection' WHEN doc_id % 10 = 0 THEN 'rare_class' ELSE 'sample' END AS triage_reason FROM labels")
def triage(spark: SparkSession, d: str) -> DataFrame:
    return P.triage(table(spark, d, "labels"), F.col("toxic") == 1, F.col("quality") == 0, F.col("doc_id") % 10 == 0).select("doc_id", "triage_priority", "triage_reason")


@register("enabled_counts", f"{BOXES} SELECT image, count(*) FILTER (class_id = 2) AS car, count(*) FILTER (class_id = 0) AS person, count(*) FILTER (class_id IN (0, 2)) AS total, bool_or(class_id IN (0, 2)) AS detected FROM boxes GROUP BY image")
def enabled_counts(spark: SparkSession, d: str) -> DataFrame:
    name = F.when(F.col("class_id") == 0, "person").when(F.col("class_id") == 2, "car").otherwise("other")
    return P.enabled_counts(boxes(spark, d).withColumn("name", name), "image", ["car", "person"], "name")


def _manifest(spark: SparkSession, d: str) -> DataFrame:
    split = F.when(F.col("doc_id") % 10 == 0, "val").when(F.col("doc_id") % 17 == 0, "odd").otherwise("train")
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("image_id"), split.alias("split"), F.sha2("text", 256).alias("source_sha256"), F.when(F.col("doc_id") % 50 == 0, F.sha2("text", 256)).otherwise("").alias("parent_source_sha256"), F.lit("").alias("decoded_sha256"), F.concat(F.lit("g"), F.col("doc_id").cast("string")).alias("group_id"), "doc_id")
    rows = rows.withColumns({"image_path": F.concat(F.lit("images/"), F.when(F.col("doc_id") % 23 == 0, "other").otherwise(F.col("split")), F.lit("/x.jpg")), "annotation_count": F.col("doc_id") % 2})
    return rows.withColumn("label_path", F.when(F.col("doc_id") % 2 == 1, F.concat(F.lit("labels/"), F.col("split"), F.lit("/x.txt"))).otherwise(""))


@register(
    "catalog_faults",
    "SELECT doc_id::VARCHAR AS image_id, concat_ws(';', CASE WHEN doc_id % 23 = 0 THEN 'image_outside_split' END, CASE WHEN doc_id % 17 = 0 AND doc_id % 10 <> 0 THEN 'unknown_split' END) AS reasons FROM documents WHERE doc_id % 23 = 0 OR (doc_id % 17 = 0 AND doc_id % 10 <> 0)",
)
def catalog_faults(spark: SparkSession, d: str) -> DataFrame:
    return P.catalog_faults(_manifest(spark, d)).select("image_id", F.array_join("reasons", ";").alias("reasons"))


@register(
    "catalog_violations",
    """
    WITH m AS (SELECT doc_id, text, CASE WHEN doc_id % 10 = 0 THEN 'val' WHEN doc_id % 17 = 0 THEN 'odd' ELSE 'train' END AS split FROM documents)
    SELECT 'manifest' AS kind, count(*) AS n FROM (SELECT 1 FROM m WHERE doc_id % 23 = 0 UNION ALL SELECT 1 FROM m WHERE split = 'odd')
    UNION ALL SELECT 'missing_file', count(*) FROM m WHERE doc_id % 40 = 1 UNION ALL SELECT 'unlisted_file', count(*) FROM m WHERE doc_id % 40 = 2 UNION ALL SELECT 'changed_file', count(*) FROM m WHERE doc_id % 40 = 3
    UNION ALL SELECT 'split_leak', count(*) FROM (SELECT text FROM m GROUP BY text HAVING count(DISTINCT split) > 1)
    UNION ALL SELECT 'composition', 3
    """,
)
def catalog_violations(spark: SparkSession, d: str) -> DataFrame:
    m = _manifest(spark, d)
    listed = m.where("doc_id % 40 <> 2").select(F.col("source_sha256").alias("digest"), F.col("image_id").alias("name"))
    there = m.where("doc_id % 40 <> 1").select(F.col("image_id").alias("name"), F.when(F.col("doc_id") % 40 == 3, "x").otherwise(F.col("source_sha256")).alias("sha256"))
    return P.catalog_violations(m, listed, there, {"train": 1, "val": 2}).groupBy("kind").agg(F.count("*").alias("n"))


@register("content_restore", "SELECT doc_id, (SELECT min(e.doc_id) FROM documents e WHERE e.text = d.text AND e.doc_id % 2 = 0) AS pool_path FROM documents d")
def content_restore(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("source_sha256"))
    pool = docs.where("doc_id % 2 = 0").select(F.col("doc_id").alias("path"), F.col("source_sha256").alias("sha256"))
    return P.restored(docs, pool).select("doc_id", "pool_path")


@register("model_gate", "WITH g AS (SELECT lang AS variant, avg(quality) - 0.8 AS mean, min(quality) - 0.0 AS least FROM documents JOIN labels USING (doc_id) GROUP BY lang) SELECT variant, round(mean, 6) AS mean, mean >= 0.005 AND least >= 0 AS passed FROM g")
def model_gate(spark: SparkSession, d: str) -> DataFrame:
    gains = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").groupBy(F.col("lang").alias("variant")).agg((F.avg("quality") - 0.8).alias("mean"), F.min("quality").cast("double").alias("least"))
    return A.acceptance(gains).select("variant", F.round("mean", 6).alias("mean"), "passed")


@register("subset_deltas", "SELECT round(avg(value), 6) AS total, round(avg(value) FILTER (user_id <> 1), 6) AS without, round(avg(value) - avg(value) FILTER (user_id <> 1), 6) AS delta FROM events")
def subset_deltas(spark: SparkSession, d: str) -> DataFrame:
    total, without = F.avg("value"), F.avg(F.when(F.col("user_id") != 1, F.col("value")))
    return table(spark, d, "events").agg(F.round(total, 6).alias("total"), F.round(without, 6).alias("without"), F.round(total - without, 6).alias("delta"))


@register("view_recovery", f"{BOXES}, f AS (SELECT image, class_id FROM boxes WHERE view = 0), c AS (SELECT image, class_id FROM boxes WHERE view > 0), j AS (SELECT coalesce(f.image, c.image) AS image, f.image IS NOT NULL AS a, c.image IS NOT NULL AS b FROM (SELECT DISTINCT * FROM f) f FULL JOIN (SELECT DISTINCT * FROM c) c ON f.image = c.image AND f.class_id = c.class_id) SELECT count(*) FILTER (a AND b) AS shared, count(*) FILTER (a AND NOT b) AS lost, count(*) FILTER (b AND NOT a) AS recovered FROM j")
def view_recovery(spark: SparkSession, d: str) -> DataFrame:
    seen = boxes(spark, d).groupBy("image", "class_id").agg(F.bool_or(F.col("view") == 0).alias("a"), F.bool_or(F.col("view") > 0).alias("b"))
    return seen.agg(F.count_if(F.col("a") & F.col("b")).alias("shared"), F.count_if(F.col("a") & ~F.col("b")).alias("lost"), F.count_if(F.col("b") & ~F.col("a")).alias("recovered"))


@register("pixel_digests", "SELECT doc_id, sha256(encode(n_chars || 'x1' || chr(0) || 'RGB' || chr(0)) || encode(text)) AS digest FROM documents WHERE text <> ''")
def pixel_digests(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").where("text <> ''").select("doc_id", pixels.pixel_digest(F.encode("text", "UTF-8"), F.col("n_chars"), F.lit(1)).alias("digest"))


@register("perceptual_hashes")
def perceptual_hashes(spark: SparkSession, d: str) -> DataFrame:
    """The hash of each vector laid out as an image, its values sixteen times over."""
    return table(spark, d, "embeddings").select("vec_id", pixels.perceptual_hash(F.flatten(F.array_repeat("embedding", 16))).alias("phash"))


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", "embedding", "label", (F.col("vec_id") % 40).alias("grp"), S.stable_rank("vec_id").alias("position"), F.concat(F.lit("s"), F.col("vec_id") % 3).alias("stratum"), F.array_compact(F.array(F.when(F.col("vec_id") % 5 == 0, "small"), F.when(F.col("vec_id") % 7 == 0, "occluded"))).alias("features"))


def _greedy_sql(start: str, steps: list[tuple[str, str, str]], output: str, cap: int | None = None) -> str:
    """Farthest-first choices written out step by step. start: rows s0 (id, key, g, v, r, and near, the
    similarity to what was there before); a step: its condition, the order, and a name."""
    parts, found = [f"s0 AS MATERIALIZED (SELECT *, '-infinity'::DOUBLE AS own, 0 AS used FROM ({start}))"], []
    for k, (condition, order, name) in enumerate(steps):
        room = "" if cap is None else f" AND used < {cap}"
        parts += [
            f"c{k} AS MATERIALIZED (SELECT * FROM s{k} WHERE {condition}{room} QUALIFY row_number() OVER (PARTITION BY key ORDER BY {order}, r) = 1)",
            f"s{k + 1} AS MATERIALIZED (SELECT s.* REPLACE (greatest(s.own, coalesce(list_dot_product(s.v, c.v), '-infinity'::DOUBLE)) AS own, s.used + coalesce(s.g = c.g, false)::INT AS used) FROM s{k} s LEFT JOIN c{k} c ON s.key = c.key WHERE s.id IS DISTINCT FROM c.id)",
        ]
        found.append(f"SELECT id, key, '{name}' AS name, {k + 1} AS position FROM c{k}")
    return f"WITH {', '.join(parts)} SELECT {output} FROM ({' UNION ALL '.join(found)})"


_RANKED = "sha256('20260826' || chr(31) || vec_id)"
_POOL = f"SELECT vec_id AS id, '' AS key, vec_id % 40 AS g, embedding::DOUBLE[] AS v, {_RANKED} AS r, label, '-infinity'::DOUBLE AS near FROM embeddings"
_SEEDED = f"SELECT a.vec_id AS id, '' AS key, a.vec_id % 40 AS g, a.embedding::DOUBLE[] AS v, sha256('20260826' || chr(31) || a.vec_id) AS r, a.label, max(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) AS near FROM embeddings a, embeddings b WHERE a.label <> 0 AND b.label = 0 GROUP BY ALL"


@register(
    "reviewed_admission",
    f"""
    WITH RECURSIVE p AS (SELECT row_number() OVER (ORDER BY {_RANKED}) AS n, vec_id, embedding::DOUBLE[] AS v, vec_id % 40 AS g, label AS s FROM embeddings),
    r AS (
      SELECT 0::BIGINT AS n, NULL::BIGINT AS vec_id, NULL::VARCHAR AS decision, []::DOUBLE[][] AS vs, []::BIGINT[] AS gs, []::INT[] AS ss
      UNION ALL
      SELECT n, vec_id, decision, CASE WHEN decision = 'included' THEN list_append(vs, v) ELSE vs END, CASE WHEN decision = 'included' THEN list_append(gs, g) ELSE gs END, CASE WHEN decision = 'included' THEN list_append(ss, s) ELSE ss END
      FROM (SELECT p.*, r.vs, r.gs, r.ss,
              CASE WHEN len(r.vs) >= 80 THEN 'capacity' WHEN len(list_filter(r.ss, lambda x: x = p.s)) >= 12 THEN 'site' WHEN len(list_filter(r.gs, lambda x: x = p.g)) >= 3 THEN 'group'
                   WHEN len(r.vs) > 0 AND list_max(list_transform(r.vs, lambda x: list_dot_product(x, p.v))) >= 0.35 THEN 'near' ELSE 'included' END AS decision
            FROM r JOIN p ON p.n = r.n + 1))
    SELECT vec_id, decision FROM r WHERE n > 0
    """,
)
def reviewed_admission(spark: SparkSession, d: str) -> DataFrame:
    return G.admitted(_vectors(spark, d), "vec_id", "embedding", "grp", "label", [F.col("position")], most=0.35, group_cap=3, site_cap=12, maximum=80)


@register("validation_queue")
def validation_queue(spark: SparkSession, d: str) -> DataFrame:
    rows = _vectors(spark, d).withColumns({"phash": pixels.perceptual_hash(F.flatten(F.array_repeat("embedding", 16))), "confidence": F.round(F.abs(F.get("embedding", F.lit(0))), 3), "small": F.col("vec_id") % 3})
    return G.validation_queue(rows, "vec_id", "phash", "grp", "label", "confidence", "small", most=10, group_cap=3, site_cap=12, maximum=60)


@register("quota_selection")
def quota_selection(spark: SparkSession, d: str) -> DataFrame:
    return G.diverse_by_quota(_vectors(spark, d), "vec_id", "embedding", "grp", "stratum", "features", minimums=[("small", 10), ("occluded", 8)], strata={"s0": 12, "s1": 10, "s2": 8}, cap=2)


@register("capped_diverse", _greedy_sql(_POOL, [("true", "own", "")] * 40, "id AS vec_id, position", cap=2))
def capped_diverse(spark: SparkSession, d: str) -> DataFrame:
    return G.diverse(_vectors(spark, d), "embedding", "vec_id", 40, group="grp", cap=2)


@register("seeded_diverse", _greedy_sql(_SEEDED, [("true", "greatest(own, near)", "")] * 12, "id AS vec_id, position"))
def seeded_diverse(spark: SparkSession, d: str) -> DataFrame:
    """All of label 0 is there before; the others are filled up with what is least like it and like each other."""
    rows = table(spark, d, "embeddings")
    return G.diverse(rows.where("label <> 0"), "embedding", "vec_id", 12, seeds=rows.where("label = 0"), shortfall=False)


@register(
    "category_quotas",
    _greedy_sql(_SEEDED, [("label <= 3", "greatest(own, near)", "low")] * 6 + [("id % 3 = 0", "own", "third")] * 5 + [("label > 3", "own", "fill")] * 9, "id AS vec_id, name AS category, position", cap=2),
)
def category_quotas(spark: SparkSession, d: str) -> DataFrame:
    """Quotas of categories in turn, then a fill; only the first compares with what was there before."""
    rows = _vectors(spark, d)
    return G.diverse_by_category(
        rows.where("label <> 0"), "vec_id", "embedding", "grp", categories=[("low", F.col("label") <= 3, 6), ("third", F.col("vec_id") % 3 == 0, 5)],
        fill=("fill", F.col("label") > 3), total=20, cap=2, seeds=rows.where("label = 0"),
    )


@register("shortlist")
def shortlist(spark: SparkSession, d: str) -> DataFrame:
    pool = table(spark, d, "part").select("p_partkey", F.split("p_type", " ").alias("classes"), (F.col("p_partkey") % 4 == 0).alias("negative"), (F.col("p_size") / 50).alias("side"))
    return X.shortlist(pool, "p_partkey", "classes", targets={"PROMO": 10, "STANDARD": 12, "LARGE": 8}, total=60, negative="negative", side="side", smallest=5, side_most=0.5, negatives=20)


@register("floor_supplement")
def floor_supplement(spark: SparkSession, d: str) -> DataFrame:
    """The best 20 parts by their types' words, with floors and at most 3 of a brand."""
    pool = table(spark, d, "part").select("p_partkey", F.split("p_type", " ").alias("classes"), "p_brand")
    weights = {"PROMO": 100, "STANDARD": 70, "LARGE": 10, "ECONOMY": 25, "MEDIUM": 1}
    return exact_supplement(pool, "p_partkey", "classes", "p_brand", count=20, floors={"PROMO": 4, "STANDARD": 4, "LARGE": 6, "MEDIUM": 3}, cap=3, weights=weights)


@register(
    "swap_repair",
    """
    WITH p AS (SELECT p_partkey AS id, string_split(p_type, ' ') AS classes, p_brand AS g, p_size <= 25 AS inside, p_partkey % 9 = 0 AS locked, sha256('20260826' || chr(31) || p_partkey) AS r FROM part),
    n AS (SELECT g, count(*) AS n FROM p WHERE inside GROUP BY g), t AS (SELECT (SELECT max(n) FROM n) AS cap, (SELECT count(*) FROM p WHERE inside AND list_contains(classes, 'PROMO')) AS have)
    SELECT o.id AS out_id, i.id AS in_id FROM t, p o, p i LEFT JOIN n ON n.g = i.g
    WHERE o.inside AND NOT o.locked AND NOT i.inside AND have - list_contains(o.classes, 'PROMO')::INT + list_contains(i.classes, 'PROMO')::INT >= have + 1 AND coalesce(n.n, 0) - (o.g = i.g)::INT < cap
    ORDER BY len(o.classes) + len(i.classes), o.r, i.r LIMIT 1
    """,
)
def swap_repair(spark: SparkSession, d: str) -> DataFrame:
    """One box of a class is missing in the parts of small size; no brand may grow beyond the largest."""
    parts = table(spark, d, "part").select("p_partkey", F.split("p_type", " ").alias("classes"), "p_brand", "p_size", (F.col("p_partkey") % 9 == 0).alias("locked"))
    inside, outside = parts.where("p_size <= 25"), parts.where("p_size > 25")
    have = inside.where(F.array_contains("classes", "PROMO")).count()
    cap = inside.groupBy("p_brand").count().agg(F.max("count")).first()[0] or 0
    return X.swap_repair(inside, outside.drop("locked"), "p_partkey", "classes", "p_brand", floors={"PROMO": have + 1}, group_cap=cap, locked="locked")


@register("frame_rows", "SELECT p_partkey, 'cam' || p_size AS site_id, '2020-' || lpad((1 + p_size % 12)::VARCHAR, 2, '0') || '-05T10:20:30' AS timestamp, CASE WHEN p_size % 2 = 0 THEN 'winter' ELSE 'summer' END AS season, 'cam' || p_size || ':2020-' || lpad((1 + p_size % 12)::VARCHAR, 2, '0') || '-05' AS group_id FROM part")
def frame_rows(spark: SparkSession, d: str) -> DataFrame:
    members = table(spark, d, "part").select("p_partkey", "p_size", F.format_string("cam%d_2020_%02d_05_102030.jpg", "p_size", 1 + F.col("p_size") % 12).alias("member"))
    rows = P.frame_rows(members, readers.frame_parts(F.col("member")), S.season(F.when(F.col("p_size") % 2 == 0, 1).otherwise(7)))
    return rows.select("p_partkey", "site_id", "timestamp", "season", "group_id")


@register("review_rows", "SELECT doc_id, CASE WHEN toxic = 1 THEN 'positive' ELSE 'negative' END AS provisional_role, CASE WHEN toxic = 1 THEN 'boxes' ELSE 'absence' END AS review_scope, 'pending' AS review_status, '' AS decision, '' AS reviewer, '' AS reviewed_at, '' AS note FROM labels WHERE toxic IS NOT NULL")
def review_rows(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", "toxic")
    return P.review_rows(labels.where("toxic = 1"), "positive").unionByName(P.review_rows(labels.where("toxic <> 1"), "negative")).drop("toxic")


@register("utc_stamps", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp FROM events")
def utc_stamps(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    return e.select("event_id", S.utc_stamp(F.to_utc_timestamp(F.col("ts").cast("timestamp"), "UTC")).alias("stamp"))


@register(
    "guards",
    """
    SELECT 'sealed, closed' AS guard, EXISTS (FROM documents WHERE lang = 'en') AS refused UNION ALL SELECT 'sealed, opened', false
    UNION ALL SELECT 'human progress', EXISTS (FROM labels WHERE toxic = 1) UNION ALL SELECT 'no progress', false
    UNION ALL SELECT 'other run', (SELECT count(*) FROM documents) <> (SELECT count(*) FROM labels) UNION ALL SELECT 'same run', false
    """,
)
def guards(spark: SparkSession, d: str) -> DataFrame:
    """Which of the steps that must not go on are refused."""
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    noted = labels.select("doc_id", F.when(F.col("toxic") == 1, "seen").otherwise(" ").alias("note"), F.lit("").alias("decision"))
    steps = {
        "sealed, closed": lambda: L.guard_sealed(docs, "lang", "en", False),
        "sealed, opened": lambda: L.guard_sealed(docs, "lang", "en", True),
        "human progress": lambda: I.guard_human_progress(noted, ["decision", "note"]),
        "no progress": lambda: I.guard_human_progress(noted, ["decision"]),
        "other run": lambda: I.same_run({"rows": docs.count()}, {"rows": labels.count()}),
        "same run": lambda: I.same_run({"rows": 1}, {"rows": 1}),
    }

    def refused(step) -> bool:
        try:
            step()
        except (PermissionError, ValueError):
            return True
        return False

    return spark.createDataFrame([(name, refused(step)) for name, step in steps.items()], "guard string, refused boolean")


@register("budgeted_plan")
def budgeted_plan(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select((F.col("o_custkey") % 97).alias("site"), S.season(F.month("o_orderdate")).alias("season"), F.col("o_totalprice").cast("long").alias("bytes"))
    return X.plan_archives(orders, table(spark, d, "customer").select(F.col("c_custkey").alias("site")), least_bytes=20_000, budget=2_000_000, total=30)


@register("frame_selection")
def frame_selection(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events")
    frames = e.select("event_id", F.when(F.col("value") > 50, "positive").otherwise("negative").alias("role"), S.season(F.col("event_id") % 12 + 1).alias("season"), F.col("user_id").alias("site"), (F.col("event_id") % 900).alias("component"), S.day_group(F.col("user_id"), F.col("ts")).alias("day"), F.col("value").alias("confidence"))
    targets = {(r, s): 5 for r in ("positive", "negative") for s in ("winter", "spring", "summer", "autumn")}
    return X.select_frames(frames, "event_id", targets=targets, site_cap=3, minimum_sites=15)


@register("stream_day_counts", "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_day_counts(spark: SparkSession, d: str) -> DataFrame:
    """The table as a file stream, batch by batch into a table: each batch's partial counts
    are written under its number, and their sums are the answer."""
    root = f"{shared_dir(spark)}/sieveline/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(d)

    def step(batch: DataFrame, number: int) -> None:
        I.day_counts(batch).write.mode("overwrite").parquet(f"{root}/out/batch={number}")

    I.run_batches(stream, step, f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out").groupBy("day", "event_type").agg(F.sum("n").alias("n"))


@register("sliding_totals", "WITH w AS (SELECT unnest([time_bucket(INTERVAL 30 MINUTE, ts), time_bucket(INTERVAL 30 MINUTE, ts) - INTERVAL 30 MINUTE]) AS start, value FROM events) SELECT start, count(*) AS n, round(sum(value), 4) AS total FROM w GROUP BY start")
def sliding_totals(spark: SparkSession, d: str) -> DataFrame:
    return I.sliding_counts(table(spark, d, "events")).select("start", "n", F.round("total", 4).alias("total"))


@register("distinct_events", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_events(spark: SparkSession, d: str) -> DataFrame:
    return I.distinct_events(table(spark, d, "events"), ["user_id", "event_type"]).select("user_id", "event_type")


@register("hardest_first", "WITH r AS (SELECT doc_id, quality, toxic, row_number() OVER (ORDER BY toxic = 0, sha256('20260826' || chr(31) || 'rare' || chr(31) || doc_id)) AS a FROM labels), s AS (SELECT *, row_number() OVER (PARTITION BY a > 20 ORDER BY quality, sha256('20260826' || chr(31) || 'difficult' || chr(31) || doc_id)) AS b FROM r) SELECT doc_id, CASE WHEN a <= 20 THEN 'rare' WHEN b <= 30 THEN 'difficult' ELSE 'common' END AS stratum FROM s")
def hardest_first(spark: SparkSession, d: str) -> DataFrame:
    """Two cuts, the second over what the first left."""
    first = R.numbered(table(spark, d, "labels"), [F.col("toxic") == 0, S.stable_rank(F.lit("rare"), "doc_id")], "a")
    second = R.numbered(first.where("a > 20"), [F.col("quality"), S.stable_rank(F.lit("difficult"), "doc_id")], "b")
    strata = first.where("a <= 20").select("doc_id", F.lit("rare").alias("stratum"))
    return strata.unionByName(second.select("doc_id", F.when(F.col("b") <= 30, "difficult").otherwise("common").alias("stratum")))
