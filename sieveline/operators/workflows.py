"""Compositions of operators: review samples, queues, replacements, final tables, splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sieveline.functions.scalars import stable_rank
from sieveline.operators.graph import components
from sieveline.operators.joins import last_wins, time_neighbours
from sieveline.operators.ranking import spread


def review_sample(rows: DataFrame, identity: str, *, required: Column, positive: Column, boxes: str, fraction: float, buckets: int = 64) -> DataFrame:
    """Required rows, then others by hash until the positives among them hold the fraction of
    all positives' boxes. The running sum is one of hash buckets first, then within
    the one bucket where the target falls, so no task sorts the table."""
    marked = rows.withColumns({"_req": F.coalesce(required, F.lit(False)), "_n": F.when(positive, F.col(boxes)).otherwise(0), "_h": stable_rank(F.lit("box-review"), identity)})
    marked = marked.withColumn("_b", F.floor(F.conv(F.substring("_h", 1, 6), 16, 10).cast("long") * buckets / (1 << 24)).cast("int"))
    totals = marked.agg(F.sum("_n").alias("all"), F.sum(F.when(F.col("_req"), F.col("_n"))).alias("required")).first()
    target, have = -(-(totals["all"] or 0) * fraction // 1), totals["required"] or 0
    by_bucket = {r["_b"]: r["n"] for r in marked.where(~F.col("_req")).groupBy("_b").agg(F.sum("_n").alias("n")).collect()}
    full, cut = [], None
    for b in range(buckets):
        if have >= target:
            break
        if have + by_bucket.get(b, 0) < target:
            have += by_bucket.get(b, 0)
            full.append(b)
        else:
            cut = b
            break
    left = marked.where(~F.col("_req"))
    whole = left.where(F.col("_b").isin(full)) if full else left.limit(0)
    part = left.limit(0)
    if cut is not None:
        before = F.coalesce(F.sum("_n").over(Window.orderBy("_h").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        part = left.where(F.col("_b") == cut).withColumn("_before", before).where(F.col("_before") < target - have).drop("_before")
    return marked.where("_req").unionByName(whole).unionByName(part).drop("_req", "_n", "_h", "_b")


def internal_queue(rows: DataFrame, site: str, stamp: str, identity: str, strong: Column, limit: int) -> DataFrame:
    """A site's queue: rows spread evenly over its days (representative), and rows within an
    hour of a strong one that the first choice left (informative)."""
    days = rows.withColumn("_day", F.to_date(stamp))
    first = spread(days, [site], "_day", [F.col(stamp), F.col(identity)], limit).select(identity, F.lit("representative").alias("category"))
    near = time_neighbours(rows, site, stamp, strong).select(identity).join(first.select(identity), identity, "left_anti").select(identity, F.lit("informative").alias("category"))
    return first.unionByName(near)


def replacements(retained: DataFrame, pool: DataFrame, attempted: DataFrame, identity: str, wanted: int, order: list[Column]) -> DataFrame:
    """The retained rows and, for those that fell out, the best of the pool not tried before."""
    missing = max(0, wanted - retained.count())
    fresh = pool.join(attempted.select(identity), identity, "left_anti").join(retained.select(identity), identity, "left_anti").orderBy(*order).limit(missing)
    return retained.select(identity, F.lit("retained").alias("origin")).unionByName(fresh.select(identity, F.lit("replacement").alias("origin")))


def assembled(positives: list[DataFrame], imports: DataFrame, negatives: DataFrame, identity: str) -> DataFrame:
    """The final table: positives of all sources, later ones winning, overlaid with reviewed
    imports; then accepted negatives. An identity in both is an error that the caller sees as polarity ``conflict``."""
    good = last_wins([*positives, imports], [identity]).withColumn("polarity", F.lit("positive"))
    every = good.unionByName(negatives.withColumn("polarity", F.lit("negative")), allowMissingColumns=True)
    both = F.count_distinct("polarity")
    conflict = every.groupBy(identity).agg(both.alias("_k")).where("_k > 1").select(identity, F.lit(True).alias("_conflict"))
    return every.join(conflict, identity, "left").withColumn("polarity", F.when(F.col("_conflict"), "conflict").otherwise(F.col("polarity"))).drop("_conflict")


def group_split(rows: DataFrame, edges: DataFrame, identity: str, sizes: list[tuple[str, float]], seed: str = "42") -> DataFrame:
    """Components of ``edges`` dealt whole to parts by the hash of their root: no group is in
    two parts, and parts have their shares of the groups as hashing goes."""
    roots = components(edges)
    joined = rows.join(roots, rows[identity] == roots["node"], "left").withColumn("group_root", F.coalesce("root", identity)).drop("node", "root")
    u = F.conv(F.substring(stable_rank("group_root", seed=seed), 1, 13), 16, 10).cast("double") / F.lit(float(16**13))
    split, edge = F.lit(sizes[-1][0]), 0.0
    cases = []
    for name, share in sizes[:-1]:
        edge += share
        cases.append(F.when(u < edge, F.lit(name)))
    return joined.withColumn("split", F.coalesce(*cases, split))


def predictions(index: DataFrame, records: DataFrame, identity: str) -> DataFrame:
    """Records of completed index rows, a row per detection; a completed row without
    detections stays, with nulls."""
    done = index.where("status = 'completed'").select(identity)
    return done.join(records, identity, "left").withColumn("detection", F.explode_outer("detections")).drop("detections")


def write_by_split(manifest: DataFrame, path: str, split: str = "split") -> None:
    manifest.write.mode("errorifexists").partitionBy(split).parquet(path)


def split_rows(spark: SparkSession, path: str, split: str, site: str | None = None) -> DataFrame:
    """One split's rows (its files alone are read), of one site if asked; no rows are an error."""
    rows = spark.read.parquet(path).where(F.col("split") == split)
    rows = rows.where(F.col("site_id") == site) if site is not None else rows
    if rows.isEmpty():
        raise ValueError(f"no rows of {split}" + (f" at {site}" if site is not None else ""))
    return rows
