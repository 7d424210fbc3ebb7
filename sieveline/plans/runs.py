"""Stateful runs, archives, exact parts and numbering: queries over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.operators import exact_parts as E
from sieveline.plans.catalog import register, table
from sieveline.session import shared_dir
from sieveline.sources import archives as A
from sieveline.streaming import screening as Z

#: Rows of one start of the screening stream, at most about.
SLICE_ROWS = 5_000_000


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sieveline/{name}-{uuid.uuid4().hex}"


def screen_value(payload: str, attempt: int) -> tuple[str | None, str]:
    """A stand-in for a model: low values never pass, middling ones do when tried again."""
    number, _, value = payload.partition("|")
    if not value or float(value) < 60:
        return None, "source_mismatch"
    return (None, "screen_failed") if float(value) < 90 and attempt == 1 else (number, "")


@register(
    "screening_run",
    """
    WITH e AS (SELECT concat_ws(':', user_id, event_type) AS identity, event_id, ts, value, CASE WHEN value >= 250 THEN 'b' ELSE 'a' END AS digest FROM events WHERE ts IS NOT NULL),
    o AS (SELECT *, row_number() OVER w AS i, lead(ts) OVER w AS nxt, first_value(digest) OVER w AS own FROM e WINDOW w AS (PARTITION BY identity ORDER BY ts, event_id)),
    d AS (SELECT *, coalesce(value >= 90, false) AS passes, coalesce(value >= 60 AND value < 90, false) AND (nxt IS NULL OR nxt >= ts + INTERVAL 6 HOUR) AS later FROM o),
    s AS (SELECT identity, min(i) FILTER (digest <> own) AS s, count(*) AS n, max(event_id) FILTER (nxt IS NULL) AS context FROM d GROUP BY identity),
    f AS (SELECT s.identity, s.s, s.n, s.context, min(i) FILTER (passes OR later) AS done FROM s LEFT JOIN d ON d.identity = s.identity AND i < coalesce(s.s, s.n + 1) GROUP BY ALL)
    SELECT f.identity, CASE WHEN s IS NOT NULL THEN 'stale' WHEN done IS NULL THEN 'failed' ELSE 'completed' END AS status,
    CASE WHEN s IS NOT NULL THEN 'stale_checkpoint' WHEN done IS NULL THEN 'source_mismatch' ELSE '' END AS reason_code,
    d.event_id::VARCHAR AS result, f.context::VARCHAR AS context, CASE WHEN done IS NULL THEN coalesce(s - 1, n) ELSE done + (d.later AND NOT d.passes)::INT END AS attempts,
    n - coalesce(done, s - 1, n) AS skipped
    FROM f LEFT JOIN d ON d.identity = f.identity AND d.i = f.done
    """,
)
def screening_run(spark: SparkSession, d: str) -> DataFrame:
    """All events as a manifest that arrives in slices of time, the stream stopped and started for each."""
    e = table(spark, d, "events").where("ts IS NOT NULL").withColumn("ts", F.col("ts").cast("timestamp"))
    bounds = e.agg(F.count("*").alias("n"), F.min(F.unix_micros("ts")).alias("a"), F.max(F.unix_micros("ts")).alias("b")).first()
    slices, shards = max(3, -(-bounds.n // SLICE_ROWS)), 128
    rows = Z.screening_rows(e, F.concat_ws(":", "user_id", "event_type"), F.when(F.col("value") >= 250, "b").otherwise("a"), F.col("ts"), F.col("event_id"), F.concat_ws("|", "event_id", "value"), F.col("event_id"), shards)
    inbox, root = _folder(spark, "inbox"), _folder(spark, "screening")
    run = {"rows": bounds.n, "model": "screen_value", "floor": 60}
    found = None
    for k in range(slices):
        step = (bounds.b or 0) - (bounds.a or 0) + 1
        a, b = ((bounds.a or 0) + step * i // slices for i in (k, k + 1))
        now = rows.where((F.unix_micros("stamp") >= a) & (F.unix_micros("stamp") < b))
        last = Z.closing_rows(spark, shards) if k == slices - 1 else None
        (now.unionByName(last) if last is not None else now).write.mode("append").parquet(inbox)
        found = Z.run_screening(spark, inbox, root, screen_value, run, stores=16, delay_seconds=6 * 3600, flush_every=20)
    return found.select("identity", "status", "reason_code", "result", "context", "attempts", "skipped")


@register("vector_archive_round_trip", "SELECT vec_id::VARCHAR AS identity, embedding FROM embeddings WHERE embedding IS NOT NULL")
def vector_archive_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """All vectors as archives, published whole and read back by ranges of rows."""
    rows = table(spark, d, "embeddings").where("embedding IS NOT NULL").select(F.col("vec_id").cast("string").alias("identity"), "embedding")
    path = _folder(spark, "vectors")
    A.write_vector_archives(rows, path, rows_per_archive=4096)
    return A.vector_archives(spark, path, rows_per_task=2048).select("identity", "embedding")


@register("vector_archive_checks", "SELECT 'kept' AS what, count(*) AS n FROM embeddings WHERE embedding IS NOT NULL UNION ALL SELECT 'damaged', 0")
def vector_archive_checks(spark: SparkSession, d: str) -> DataFrame:
    """The same, compressed, with every archive's digest compared as it is read."""
    rows = table(spark, d, "embeddings").where("embedding IS NOT NULL").select(F.col("vec_id").cast("string").alias("identity"), "embedding")
    path = _folder(spark, "vectors")
    A.write_vector_archives(rows, path, compressed=True)
    found = A.vector_archives(spark, path, verify=True).agg(F.count_if(F.col("reason_code").isNull()).alias("kept"), F.count_if(F.col("reason_code").isNotNull()).alias("damaged"))
    return found.unpivot([], ["kept", "damaged"], "what", "n")


@register("exact_group_split", "WITH n AS (SELECT count(*) AS n FROM documents) SELECT split, rows, 1 AS parts_of_a_group FROM (SELECT 'train' AS split, n - 2 * (n // 10) AS rows FROM n UNION ALL SELECT 'val', n // 10 FROM n UNION ALL SELECT 'test', n // 10 FROM n) WHERE rows > 0")
def exact_group_split(spark: SparkSession, d: str) -> DataFrame:
    """Copies stay together, and the parts have exactly their sizes."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("copy"))
    n = docs.count()
    parts = E.exact_group_split(docs, "copy", [("val", n // 10), ("test", n // 10), ("train", n - 2 * (n // 10))])
    each = parts.groupBy("copy").agg(F.count_distinct("split").alias("k"), F.first("split").alias("split"), F.count("*").alias("n"))
    return each.groupBy("split").agg(F.sum("n").alias("rows"), F.max("k").alias("parts_of_a_group"))
