"""Incremental runs: resuming, staleness, and streams over files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def remaining(source: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows that a checkpoint doesn't hold as completed; failed ones come again."""
    finished = done.where("status = 'completed'") if "status" in done.columns else done
    return source.join(finished.select(*keys).distinct(), keys, "left_anti")


def stale(source: DataFrame, done: DataFrame, keys: list[str], digest: str) -> DataFrame:
    """Checkpointed rows whose source has changed or is gone."""
    now = source.select(*keys, F.col(digest).alias("_now"))
    return done.join(now, keys, "left").where(~F.col(digest).eqNullSafe(F.col("_now"))).select(*keys, F.when(F.col("_now").isNull(), "not_in_source").otherwise("changed").alias("fault"))


def merged(done: DataFrame, fresh: DataFrame, keys: list[str]) -> DataFrame:
    """The checkpoint after a run: new rows take the place of old ones of their key."""
    return done.join(fresh.select(*keys).distinct(), keys, "left_anti").unionByName(fresh, allowMissingColumns=True)


def same_run(before: dict, now: dict) -> None:
    """Refuse to go on with a checkpoint of another run."""
    different = sorted(k for k in {*before, *now} if before.get(k) != now.get(k))
    if different:
        raise ValueError(f"another run's checkpoint: {', '.join(different)} differ")


def guard_human_progress(rows: DataFrame, columns: list[str]) -> None:
    """Refuse to overwrite rows that a person has filled in."""
    filled = None
    for c in columns:
        one = F.coalesce(F.trim(c), F.lit("")) != ""
        filled = one if filled is None else filled | one
    if not rows.where(filled).isEmpty():
        raise PermissionError("a review has begun")


def file_stream(spark: SparkSession, path: str, schema, files_per_batch: int = 64) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def run_batches(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Process what there is, batch by batch; a batch that was committed isn't run again."""
    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def day_counts(events: DataFrame, stamp: str = "ts", key: str = "event_type", late: str = "1 day") -> DataFrame:
    """Tumbling days; as a batch it is the same query."""
    source = events.withWatermark(stamp, late) if events.isStreaming else events
    return source.groupBy(F.window(stamp, "1 day").alias("w"), key).agg(F.count("*").alias("n")).select(F.col("w.start").alias("day"), key, "n")


def sliding_counts(events: DataFrame, stamp: str = "ts", size: str = "1 hour", step: str = "30 minutes", late: str = "1 day") -> DataFrame:
    source = events.withWatermark(stamp, late) if events.isStreaming else events
    return source.groupBy(F.window(stamp, size, step).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), "n", "total")


def sessions(events: DataFrame, user: str = "user_id", stamp: str = "ts", gap: str = "30 minutes", late: str = "1 day") -> DataFrame:
    source = events.withWatermark(stamp, late) if events.isStreaming else events
    return source.groupBy(user, F.session_window(stamp, gap).alias("s")).agg(F.count("*").alias("n")).select(user, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "n")


def distinct_events(events: DataFrame, keys: list[str], stamp: str = "ts", late: str = "1 day") -> DataFrame:
    return events.withWatermark(stamp, late).dropDuplicatesWithinWatermark(keys) if events.isStreaming else events.dropDuplicates(keys)
