"""Compositions of operators over the driver's tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import scalars as S
from sieveline.operators import joins as J
from sieveline.operators import workflows as W
from sieveline.plans.catalog import register, table
from sieveline.plans.relational import RANK
from sieveline.session import shared_dir


@register(
    "review_sample",
    """
    WITH m AS (SELECT p_partkey, p_size % 10 = 0 AS req, CASE WHEN p_size > 5 THEN p_size ELSE 0 END AS n, sha256('20260826' || chr(31) || 'box-review' || chr(31) || p_partkey) AS h FROM part),
    t AS (SELECT ceil(sum(n) * 0.3::DOUBLE) AS target, coalesce(sum(n) FILTER (req), 0) AS have FROM m),
    c AS (SELECT *, coalesce(sum(n) OVER (ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM m WHERE NOT req)
    SELECT p_partkey FROM m WHERE req UNION ALL SELECT p_partkey FROM c, t WHERE before < target - have
    """,
)
def review_sample(spark: SparkSession, d: str) -> DataFrame:
    return W.review_sample(table(spark, d, "part"), "p_partkey", required=F.col("p_size") % 10 == 0, positive=F.col("p_size") > 5, boxes="p_size", fraction=0.3).select("p_partkey")


@register(
    "internal_queue",
    """
    WITH r AS (SELECT event_id, user_id, ts::DATE AS day, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id, ts::DATE) AS n FROM events),
    t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY i, day) AS turn FROM r),
    k AS (SELECT *, count(*) FILTER (turn <= 12) OVER (PARTITION BY user_id, day) AS k FROM t),
    f AS (SELECT event_id FROM k WHERE k > 0 AND list_contains(list_transform(range(0, k), lambda x: round_even(x * (n - 1) / greatest(1, k - 1)::DOUBLE, 0)::BIGINT), i))
    SELECT event_id, 'representative' AS category FROM f
    UNION ALL SELECT event_id, 'informative' FROM events e WHERE event_id NOT IN (SELECT event_id FROM f) AND EXISTS (SELECT 1 FROM events s WHERE s.event_type = 'purchase' AND s.user_id = e.user_id AND abs(floor(epoch(s.ts))::BIGINT - floor(epoch(e.ts))::BIGINT) BETWEEN 1 AND 3600)
    """,
)
def internal_queue(spark: SparkSession, d: str) -> DataFrame:
    return W.internal_queue(table(spark, d, "events"), "user_id", "ts", "event_id", F.col("event_type") == "purchase", 12)


@register(
    "replacement_round",
    f"WITH k AS (SELECT doc_id FROM labels WHERE quality = 1), m AS (SELECT greatest(0, 400 - count(*)) AS n FROM k), p AS (SELECT doc_id, row_number() OVER (ORDER BY {RANK.format('doc_id')}) AS r FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) SELECT doc_id, 'retained' AS origin FROM k UNION ALL SELECT doc_id, 'replacement' FROM p, m WHERE r <= n",
)
def replacement_round(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", "quality")
    return W.replacements(labels.where("quality = 1"), table(spark, d, "documents").select("doc_id"), labels, "doc_id", 400, [S.stable_rank("doc_id")])


@register("final_composition", "SELECT doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'conflict' WHEN quality = 1 THEN 'positive' ELSE 'negative' END AS polarity FROM labels WHERE quality = 1 OR toxic = 1 UNION ALL SELECT doc_id, 'conflict' FROM labels WHERE quality = 1 AND toxic = 1")
def final_composition(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    side = lambda c: labels.where(c).select("doc_id", F.lit(c).alias("source"))
    return W.assembled([side("quality = 1"), side("quality = 1 AND doc_id % 2 = 0")], side("quality = 1 AND doc_id % 3 = 0"), side("toxic = 1"), "doc_id").select("doc_id", "polarity")


@register(
    "group_split",
    """
    WITH g AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS root FROM documents),
    u AS (SELECT doc_id, ('0x' || substr(sha256('42' || chr(31) || root), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM g)
    SELECT doc_id, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM u
    """,
)
def group_split(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("k"))
    edges = J.class_pairs(docs, "k", "doc_id").select(F.col("left_id").alias("a"), F.col("right_id").alias("b"))
    return W.group_split(docs, edges, "doc_id", [("train", 0.8), ("val", 0.1), ("test", 0.1)]).select("doc_id", "split")


@register("prediction_index", "SELECT conv_id AS id, turn AS detection FROM conversations WHERE conv_id % 3 <> 0 UNION ALL SELECT DISTINCT conv_id + 100000, NULL FROM conversations WHERE conv_id % 3 = 1")
def prediction_index(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    records = c.groupBy(F.col("conv_id").alias("id")).agg(F.collect_list("turn").alias("detections"))
    ids = c.select(F.col("conv_id").alias("id")).distinct()
    index = ids.withColumn("status", F.when(F.col("id") % 3 == 0, "failed").otherwise("completed"))
    bare = ids.where("id % 3 = 1").select((F.col("id") + 100000).alias("id"), F.lit("completed").alias("status"))
    return W.predictions(index.unionByName(bare), records, "id")


@register("partition_scan", "SELECT doc_id FROM documents WHERE lang = 'de' AND source = 'src0'")
def partition_scan(spark: SparkSession, d: str) -> DataFrame:
    path = f"{shared_dir(spark)}/sieveline/by-split-{uuid.uuid4().hex}"
    W.write_by_split(table(spark, d, "documents").select("doc_id", F.col("source").alias("site_id"), F.col("lang").alias("split")), path)
    return W.split_rows(spark, path, "de", "src0").select("doc_id")
