"""Ranking, windows and cuts over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import scalars as S
from sieveline.operators import joins as J
from sieveline.operators import ranking as R
from sieveline.plans.catalog import register, table
from sieveline.plans.relational import RANK
from sieveline.streaming import incremental as I


@register("stable_sample_per_group", f"SELECT lang, doc_id, rank FROM (SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY {RANK.format('doc_id')}) AS rank FROM documents) WHERE rank <= 10")
def stable_sample_per_group(spark: SparkSession, d: str) -> DataFrame:
    return R.top_per_group(table(spark, d, "documents").select("lang", "doc_id"), ["lang"], [S.stable_rank("doc_id")], 10)


@register(
    "first_event_per_user_day",
    """
    WITH f AS (SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY sha256('20260826' || chr(31) || event_id || chr(31) || 'day')) = 1 AS is_first FROM events)
    SELECT event_id, is_first, row_number() OVER (PARTITION BY user_id ORDER BY is_first DESC, sha256('20260826' || chr(31) || event_id)) AS position FROM f
    """,
)
def first_event_per_user_day(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return R.first_then_rest(rows, ["day"], [S.stable_rank("event_id", F.lit("day"))], [S.stable_rank("event_id")], ["user_id"]).select("event_id", "is_first", "position")


@register("round_robin_sites", "SELECT event_id, user_id, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS turn FROM events")
def round_robin_sites(spark: SparkSession, d: str) -> DataFrame:
    return R.round_robin(table(spark, d, "events"), "user_id", [F.desc("value"), F.col("event_id")], [F.col("user_id")]).select("event_id", "user_id", "turn")


@register("cumulative_quota_cut", f"SELECT doc_id, source, n_chars, before FROM (SELECT *, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY {RANK.format('doc_id')} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before < 20000")
def cumulative_quota_cut(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "source", "n_chars")
    return R.cumulative_cut(rows, ["source"], [S.stable_rank("doc_id")], "n_chars", F.lit(20000))


@register("group_cap_topn", "SELECT o_orderkey, o_custkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM orders) WHERE n <= 2 ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def group_cap_topn(spark: SparkSession, d: str) -> DataFrame:
    return R.capped(table(spark, d, "orders"), "o_custkey", [F.desc("o_totalprice"), F.col("o_orderkey")], 2, 100).select("o_orderkey", "o_custkey")


@register(
    "banded_topn",
    f"""
    WITH b AS (SELECT doc_id, CASE WHEN n_chars < 500 THEN 'short' WHEN n_chars < 2000 THEN 'medium' WHEN n_chars < 5000 THEN 'long' END AS band FROM documents),
    r AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY {RANK.format("doc_id")}) AS rank FROM b WHERE band IS NOT NULL)
    SELECT doc_id, band, rank FROM r WHERE rank <= CASE band WHEN 'short' THEN 5 WHEN 'medium' THEN 8 ELSE 3 END
    """,
)
def banded_topn(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id", "n_chars")
    return R.banded(rows, "n_chars", [("short", 0, 500, 5), ("medium", 500, 2000, 8), ("long", 2000, 5000, 3)], [S.stable_rank("doc_id")]).select("doc_id", "band", "rank")


@register(
    "temporal_uniform",
    """
    WITH r AS (SELECT event_id, user_id, ts::DATE AS day, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) - 1 AS i, count(*) OVER (PARTITION BY user_id, ts::DATE) AS n FROM events),
    t AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY i, day) AS turn FROM r),
    k AS (SELECT *, count(*) FILTER (turn <= 12) OVER (PARTITION BY user_id, day) AS k FROM t)
    SELECT event_id, user_id FROM k WHERE k > 0 AND list_contains(list_transform(range(0, k), lambda x: round_even(x * (n - 1) / greatest(1, k - 1)::DOUBLE, 0)::BIGINT), i)
    """,
)
def temporal_uniform(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").withColumn("day", F.to_date("ts"))
    return R.spread(rows, ["user_id"], "day", [F.col("ts"), F.col("event_id")], 12).select("event_id", "user_id")


@register("temporal_neighbors_1h", "SELECT event_id FROM events e WHERE EXISTS (SELECT 1 FROM events s WHERE s.event_type = 'purchase' AND s.user_id = e.user_id AND abs(floor(epoch(s.ts))::BIGINT - floor(epoch(e.ts))::BIGINT) BETWEEN 1 AND 3600)")
def temporal_neighbors_1h(spark: SparkSession, d: str) -> DataFrame:
    return J.time_neighbours(table(spark, d, "events"), "user_id", "ts", F.col("event_type") == "purchase").select("event_id")


@register("argmax_with_ties", "SELECT user_id, arg_max(event_id, (value, -event_id)) AS event_id FROM events GROUP BY user_id")
def argmax_with_ties(spark: SparkSession, d: str) -> DataFrame:
    return R.best_by(table(spark, d, "events"), ["user_id"], ["event_id"], F.struct("value", -F.col("event_id")))


@register("argmin_per_group", "SELECT c_nationkey, c_mktsegment, min(c_acctbal) AS least, arg_min(c_custkey, (c_acctbal, c_custkey)) AS c_custkey FROM customer GROUP BY ALL")
def argmin_per_group(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").groupBy("c_nationkey", "c_mktsegment").agg(F.min("c_acctbal").alias("least"), F.min_by("c_custkey", F.struct("c_acctbal", "c_custkey")).alias("c_custkey"))


@register("worst_n", "SELECT user_id, count(*) AS n FROM events WHERE event_type <> 'view' GROUP BY user_id ORDER BY n DESC, user_id LIMIT 12")
def worst_n(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").where("event_type <> 'view'").groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").limit(12)


@register(
    "review_queue_order",
    "SELECT doc_id, row_number() OVER (ORDER BY toxic = 1 DESC, CASE WHEN quality = 0 THEN 9 ELSE quality END, sha256('20260826' || chr(31) || doc_id)) AS review_order FROM labels",
)
def review_queue_order(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "labels").select("doc_id", (F.col("toxic") == 1).alias("required"), F.when(F.col("quality") == 1, "1").otherwise("").alias("priority"))
    return R.review_order(rows, "required", "priority", S.stable_rank("doc_id")).select("doc_id", "review_order")


@register("sorted_arrays", "SELECT o_custkey, list_sort(list((o_totalprice, o_orderkey)))[1][2] AS cheapest, array_to_string(list_sort(list_distinct(list(o_orderstatus))), ';') AS statuses FROM orders GROUP BY o_custkey")
def sorted_arrays(spark: SparkSession, d: str) -> DataFrame:
    pairs = F.array_sort(F.collect_list(F.struct("o_totalprice", "o_orderkey")))
    return table(spark, d, "orders").groupBy("o_custkey").agg(F.get(pairs, F.lit(0))["o_orderkey"].alias("cheapest"), S.sorted_set_text(F.collect_list("o_orderstatus")).alias("statuses"))


@register("running_ids", "SELECT conv_id, turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS id FROM conversations")
def running_ids(spark: SparkSession, d: str) -> DataFrame:
    from pyspark.sql import Window

    return table(spark, d, "conversations").select("conv_id", "turn", F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")).alias("id"))


@register("interval_join", "SELECT event_id, count(*) AS n FROM (SELECT event_id, user_id, floor(epoch(ts))::BIGINT AS s FROM events) e JOIN (SELECT user_id, floor(epoch(ts))::BIGINT AS a, floor(epoch(ts))::BIGINT + 7200 AS b FROM events WHERE event_type = 'purchase') i ON e.user_id = i.user_id AND s >= a AND s < b GROUP BY event_id")
def interval_join(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").withColumn("at", F.unix_seconds(F.col("ts").cast("timestamp")))
    spans = events.where("event_type = 'purchase'").select("user_id", F.col("at").alias("a"), (F.col("at") + 7200).alias("b"))
    return J.interval_join(events, spans, ["user_id"], "at", "a", "b", 7200).groupBy("event_id").agg(F.count("*").alias("n"))


@register("tumbling_days", "SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_type, count(*) AS n FROM events GROUP BY ALL")
def tumbling_days(spark: SparkSession, d: str) -> DataFrame:
    return I.day_counts(table(spark, d, "events"))


@register("session_counts", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)), s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT user_id, count(*) AS n, min(ts) AS start FROM s GROUP BY user_id, s")
def session_counts(spark: SparkSession, d: str) -> DataFrame:
    return I.sessions(table(spark, d, "events")).select("user_id", "n", "start")


@register("resume_remaining", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE toxic = 0)")
def resume_remaining(spark: SparkSession, d: str) -> DataFrame:
    done = table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 0, "completed").otherwise("failed").alias("status"))
    return I.remaining(table(spark, d, "documents").select("doc_id"), done, ["doc_id"])


@register("stale_checkpoint", "SELECT doc_id, 'changed' AS fault FROM documents WHERE doc_id % 10 = 3")
def stale_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    source = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("digest"))
    done = source.withColumn("digest", F.when(F.col("doc_id") % 10 == 3, "old").otherwise(F.col("digest")))
    return I.stale(source, done, ["doc_id"], "digest")


@register("merged_checkpoint", "SELECT doc_id, CASE WHEN toxic = 1 THEN 'completed' ELSE 'failed' END AS status FROM labels")
def merged_checkpoint(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    return I.merged(labels.select("doc_id", F.lit("failed").alias("status")), labels.where("toxic = 1").select("doc_id", F.lit("completed").alias("status")), ["doc_id"])
