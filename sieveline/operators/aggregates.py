"""Aggregations: rates, summaries, gates, agreements, calibration."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, zero where the whole is."""
    return F.when(whole > 0, part / whole).otherwise(0.0)


def rates(tp: Column, fp: Column, fn: Column) -> dict[str, Column]:
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return {
        "precision": precision,
        "recall": recall,
        "f1": F.when(precision + recall > 0, 2 * precision * recall / (precision + recall)).otherwise(0.0),
        "accuracy": ratio(tp, tp + fp + fn),
    }


def contributions(events: DataFrame) -> DataFrame:
    """One row per class that an event counts for, with tp, fp and fn. A class confusion is
    a miss of the actual class and a false hit of the predicted one."""
    one = lambda c, tp, fp, fn: F.struct(c.alias("class"), F.lit(tp).alias("tp"), F.lit(fp).alias("fp"), F.lit(fn).alias("fn"))
    parts = (
        F.when(F.col("type") == "true_positive", F.array(one(F.col("actual"), 1, 0, 0)))
        .when(F.col("type") == "class_confusion", F.array(one(F.col("actual"), 0, 0, 1), one(F.col("predicted"), 0, 1, 0)))
        .when(F.col("type") == "false_negative", F.array(one(F.col("actual"), 0, 0, 1)))
        .otherwise(F.array(one(F.col("predicted"), 0, 1, 0)))
    )
    return events.withColumn("_c", F.explode(parts)).select("*", "_c.*").drop("_c")


def summarize(events: DataFrame, by: list[str]) -> DataFrame:
    """tp, fp, fn and rates in total and for each value of each column of ``by``, as one
    pass of grouping sets. ``level`` names the column, ``value`` its value."""
    rows = contributions(events)
    sets = F.array(F.struct(F.lit("total").alias("level"), F.lit("").alias("value")), *[F.struct(F.lit(c).alias("level"), F.coalesce(F.col(c).cast("string"), F.lit("none")).alias("value")) for c in by])
    summed = rows.withColumn("_s", F.explode(sets)).groupBy("_s.level", "_s.value").agg(*[F.sum(c).alias(c) for c in ("tp", "fp", "fn")])
    return summed.withColumns(rates(F.col("tp"), F.col("fp"), F.col("fn")))


def deficits(counts: DataFrame, floors: dict[str, int], key: str) -> DataFrame:
    """What each floor still lacks; ``counts`` has the key and n."""
    wanted = counts.sparkSession.createDataFrame(list(floors.items()), f"{key} string, floor long")
    return wanted.join(counts, key, "left").select(key, "floor", F.coalesce("n", F.lit(0)).alias("n"), F.greatest(F.lit(0), F.col("floor") - F.coalesce("n", F.lit(0))).alias("deficit"))


def threshold_calibration(scored: DataFrame, score: str, good: str, thresholds: list[float], most: float) -> DataFrame:
    """For each threshold how many rows reach it, the share of those that aren't good (none:
    zero), and whether it is the first that keeps the share within ``most``. One scan and
    one row per band; the sums over higher bands follow from those."""
    edges = sorted(thresholds)
    band = F.size(F.filter(F.array(*[F.lit(t) for t in edges]), lambda t: t <= F.col(score)))
    counted = scored.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.count_if(~F.col(good)).alias("bad"))
    every = scored.sparkSession.createDataFrame([(i + 1, t) for i, t in enumerate(edges)], "band int, threshold double")
    above = Window.orderBy(F.desc("band"))
    summed = every.join(counted, "band", "left").select("band", "threshold", F.sum(F.coalesce("n", F.lit(0))).over(above).alias("n"), F.sum(F.coalesce("bad", F.lit(0))).over(above).alias("bad"))
    share = summed.withColumn("bad_share", ratio(F.col("bad").cast("double"), F.col("n")))
    return share.withColumn("chosen", F.col("threshold") == F.min(F.when(F.col("bad_share") <= most, F.col("threshold"))).over(Window.partitionBy())).drop("band")


def agreement(first: DataFrame, second: DataFrame, identity: str, confirm: str = "confirmed_negative") -> DataFrame:
    """Two review rounds: accepted where both confirm and the reviewers differ; one-sided
    identities and shared reviewers are told apart."""
    a = first.select(identity, F.col("decision").alias("decision"), F.col("reviewer").alias("reviewer"))
    b = second.select(identity, F.col("decision").alias("second_decision"), F.col("reviewer").alias("second_reviewer"))
    joined = a.join(b, identity, "full")
    result = (
        F.when(F.col("decision").isNull() | F.col("second_decision").isNull(), "missing_round")
        .when(F.col("reviewer") == F.col("second_reviewer"), "same_reviewer")
        .when((F.col("decision") == confirm) & (F.col("second_decision") == confirm), "accepted_negative")
        .otherwise("requires_resolution")
    )
    return joined.withColumn("result", result)


def replicas(df: DataFrame, group: list[str], value: str) -> DataFrame:
    return df.groupBy(*group).agg(F.avg(value).alias("mean"), F.min(value).alias("least"), F.coalesce(F.stddev_samp(value), F.lit(0.0)).alias("deviation"), F.count("*").alias("n"))


def acceptance(summary: DataFrame, gain: float = 0.005, least: float = 0.0) -> DataFrame:
    """``summary`` of gains (mean, least) with whether they pass: the mean by ``gain`` and every replica by ``least``."""
    return summary.withColumn("passed", (F.col("mean") >= gain) & (F.col("least") >= least))


def singletons(df: DataFrame, group: str, value: str) -> DataFrame:
    """Each group's distinct values, and whether there is just one."""
    return df.groupBy(group).agg(F.array_sort(F.collect_set(value)).alias("values")).withColumn("single", F.size("values") == 1)


def view_flags(boxes: DataFrame, image: str) -> DataFrame:
    flags = boxes.groupBy(image).agg(F.bool_or(F.col("view") == 0).alias("has_full"), F.bool_or(F.col("view") > 0).alias("has_crop"))
    return flags.withColumn("disagreement", F.col("has_full") != F.col("has_crop"))


def composition(counts: DataFrame, expected: dict[str, int], key: str) -> DataFrame:
    """Groups whose number isn't the expected one, missing and unexpected groups included."""
    wanted = counts.sparkSession.createDataFrame(list(expected.items()), f"{key} string, expected long")
    joined = wanted.join(counts.select(F.col(key).cast("string").alias(key), "n"), key, "full").select(key, F.coalesce("expected", F.lit(0)).alias("expected"), F.coalesce("n", F.lit(0)).alias("n"))
    return joined.withColumn("as_expected", F.col("expected") == F.col("n"))


def stage(states: dict[str, Column], otherwise: str) -> Column:
    """The first stage whose condition holds."""
    return F.coalesce(*[F.when(c, F.lit(n)) for n, c in states.items()], F.lit(otherwise))
