"""Leak-free splits and their audit."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.scalars import stable_rank


def site_day_split(rows: DataFrame, site: str, group: str, *, test: float = 0.2, least_test: int = 3, dev: float = 0.5, seed: str = "17") -> DataFrame:
    """Each site's groups (camera days) dealt to sealed_test, development and mining by
    hash; every row follows its group. Sites with too few groups for all three are left
    out. Halves round to even."""
    groups = rows.select(site, group).distinct()
    n = F.count("*").over(Window.partitionBy(site))
    ranked = groups.withColumns({"_n": n, "_r": F.row_number().over(Window.partitionBy(site).orderBy(stable_rank(site, group, seed=seed)))})
    ranked = ranked.withColumn("_test", F.greatest(F.lit(least_test), F.bround(F.col("_n") * F.lit(test)).cast("int"))).where(F.col("_n") >= F.col("_test") + 2)
    rest = F.col("_n") - F.col("_test")
    ranked = ranked.withColumn("_dev", F.greatest(F.lit(1), F.least(rest - 1, F.bround(rest * F.lit(dev)))).cast("int"))
    split = F.when(F.col("_r") <= F.col("_test"), "sealed_test").when(F.col("_r") <= F.col("_test") + F.col("_dev"), "development").otherwise("mining")
    return rows.join(ranked.select(site, group, split.alias("split")), [site, group])


def leakage(rows: DataFrame, split: str, keys: dict[str, list[str]]) -> DataFrame:
    """Values that several splits share: domain, value, splits. ``keys`` maps a domain to
    its columns; blanks aren't values."""
    pairs = [F.struct(F.lit(domain).alias("domain"), F.col(c).cast("string").alias("value")) for domain, columns in keys.items() for c in columns]
    each = rows.select(split, F.explode(F.array(*pairs)).alias("k")).where("k.value <> ''").select(split, "k.domain", "k.value")
    return each.groupBy("domain", "value").agg(F.count_distinct(split).alias("splits")).where("splits > 1")


def poisson_steps() -> list[float]:
    """Where a uniform number becomes one more draw of a Poisson variable of mean 1."""
    steps, total, p = [], 0.0, 2.718281828459045**-1
    for k in range(12):
        total += p
        steps.append(total)
        p /= k + 1
    return steps


def _resampled(sums: DataFrame, group: str, resamples: int, seed: str) -> DataFrame:
    """The mean _m of each resample; sums: group, _s and _c. A group's weight is a Poisson draw
    from the hash of it and the resample, 1 in resample -1, which is the rows as they are."""
    draws = sums.withColumn("resample", F.explode(F.sequence(F.lit(-1), F.lit(resamples - 1))))
    u = F.conv(F.substring(stable_rank(group, "resample", seed=seed), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    drawn = F.size(F.filter(F.array(*[F.lit(s) for s in poisson_steps()]), lambda s: s <= u))
    weighed = draws.withColumn("_w", F.when(F.col("resample") < 0, 1).otherwise(drawn))
    return weighed.groupBy("resample").agg((F.sum(F.col("_w") * F.col("_s")) / F.nullif(F.sum(F.col("_w") * F.col("_c")), F.lit(0))).alias("_m"))


def bootstrap(rows: DataFrame, group: str, value: Column, resamples: int, seed: str = "20260915") -> DataFrame:
    """The mean of ``value`` in each resample of groups. A group's weight in a resample
    is a Poisson draw from the hash of both, so no resample is drawn from a list."""
    sums = rows.groupBy(group).agg(F.sum(value).alias("_s"), F.count(value).alias("_c"))
    return _resampled(sums, group, resamples, seed).where("resample >= 0").select("resample", F.col("_m").alias("mean"))


def paired_bootstrap(rows: DataFrame, group: str, left: Column, right: Column, resamples: int = 10_000, seed: str = "20260915", share: float = 0.95) -> DataFrame:
    """One row: the mean of left less right, and the bounds between which the middle ``share``
    of the resamples' means lie. Both values of a row are drawn together, by group; rows that
    lack either take no part. No rows give nulls."""
    both = rows.select(F.col(group).alias("_g"), (left - right).cast("double").alias("_d")).where("_d IS NOT NULL")
    sums = both.groupBy("_g").agg(F.sum("_d").alias("_s"), F.count("*").alias("_c"))
    means = _resampled(sums, "_g", resamples, seed)
    tail, drawn = (1 - share) / 2, F.when(F.col("resample") >= 0, F.col("_m"))
    found = means.agg(F.max(F.when(F.col("resample") < 0, F.col("_m"))).alias("difference"), F.percentile(drawn, F.array(F.lit(tail), F.lit(1 - tail))).alias("_p"), F.count(drawn).alias("resamples"))
    return found.select("difference", F.get("_p", F.lit(0)).alias("low"), F.get("_p", F.lit(1)).alias("high"), "resamples")
