"""Joins beyond equality: overlays, ordered exclusion, neighbours in time, near pairs."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.operators import metric
from sieveline.session import written


def redealt(summed: DataFrame) -> DataFrame:
    """An aggregate's rows, dealt anew, for a join on its keys with the rows it came from.

    Without it the join takes the aggregate's partitions as they are, and a key that
    a third of the rows share is one task. With it both sides have a shuffle of their
    own, of which the adaptive planner splits a skewed partition or does without
    one where the aggregate turns out small."""
    return summed.repartition(int(summed.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def overlay(base: DataFrame, updates: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """base with the update's values where there is one."""
    fresh = updates.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = base.join(fresh, keys, "left")
    kept = [F.col(c) for c in base.columns if c not in columns]
    return joined.select(*kept, *[F.coalesce(f"_new_{c}", c).alias(c) for c in columns])


def last_wins(parts: list[DataFrame], keys: list[str]) -> DataFrame:
    """The union in which a later table's row of a key hides the earlier ones'."""
    marked = [p.withColumn("_turn", F.lit(i)) for i, p in enumerate(parts)]
    every = marked[0]
    for part in marked[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    latest = Window.partitionBy(*keys).orderBy(F.desc("_turn"))
    return every.withColumn("_n", F.row_number().over(latest)).where("_n = 1").drop("_n", "_turn")


def exclude(df: DataFrame, others: list[tuple[DataFrame, str]], blank_matches: bool = False) -> DataFrame:
    """Rows that match none of the (table, column) pairs. Blanks match nothing unless asked."""
    for other, column in others:
        used = other.select(F.col(column)).where(F.col(column).isNotNull() if blank_matches else F.coalesce(F.col(column) != "", F.lit(False))).distinct()
        df = df.join(used, column, "left_anti")
    return df


def equal_pairs(df: DataFrame, key: str, identity: str) -> DataFrame:
    """Pairs of identities (left before right) that share a key. Meant for keys of few
    rows each; ``class_pairs`` and ``class_links`` keep their rows in proportion."""
    a = df.where(F.col(key).isNotNull()).select(key, F.col(identity).alias("left_id"))
    return a.join(a.withColumnRenamed("left_id", "right_id"), key).where("left_id < right_id").select("left_id", "right_id")


def class_links(df: DataFrame, key: str, identity: str) -> DataFrame:
    """Each row that shares its key: identity, class_id (the key's least identity) and links,
    the number of other rows with the key. Rows without a key or a partner are left out."""
    held = df.where(F.col(key).isNotNull()).select(key, identity)
    found = redealt(held.groupBy(key).agg(F.min(identity).alias("class_id"), (F.count("*") - 1).alias("links")).where("links > 0"))
    return held.join(found, key).select(identity, "class_id", "links")


def class_pairs(df: DataFrame, key: str, identity: str) -> DataFrame:
    """A pair from each key's least identity to every other: it links the same rows as all
    pairs do, with as many rows as there are copies."""
    held = df.where(F.col(key).isNotNull())
    first = redealt(held.groupBy(key).agg(F.min(identity).alias("left_id")))
    return held.join(first, key).where(F.col(identity) > F.col("left_id")).select("left_id", F.col(identity).alias("right_id"))


def hamming_pairs(df: DataFrame, bits: str, identity: str, most: int, width: int = 64) -> DataFrame:
    """Pairs of classes whose bits differ in at most ``most`` places, and each copy with its class.

    Rows of equal bits are one class, named by its least identity; left_id and right_id
    are classes, or a class and one of its other rows at distance 0. Null bits match nothing.
    Bits are cut into so few bands that of most differences one band holds two at most;
    the smaller class looks for its band's value and for all values within two
    bits of it, and a pair counts in the first band that it shares.
    """
    bands = most // 3 + 1
    edges = [width * i // bands for i in range(bands + 1)]
    sizes = [high - low for low, high in zip(edges, edges[1:], strict=False)]
    near = most // bands
    signed = lambda n: n - (1 << 64) if n >> 63 else n
    band = lambda value, i: F.shiftrightunsigned(value, edges[i]).bitwiseAND(F.lit(signed((1 << sizes[i]) - 1)))
    flips = [[signed(sum(1 << b for b in some)) for k in range(near + 1) for some in combinations(range(size), k)] for size in sizes]
    classes = df.where(F.col(bits).isNotNull()).groupBy(F.col(bits).alias("bits")).agg(F.min(identity).alias("id"))
    at = lambda i, value: F.struct(F.lit(i).alias("band"), value.alias("value"))
    around = lambda i: F.transform(F.array(*map(F.lit, flips[i])).cast("array<bigint>"), lambda m: at(i, band(F.col("bits"), i).bitwiseXOR(m)))
    probes = F.concat(*map(around, range(bands)))
    holders = F.array(*[at(i, band(F.col("bits"), i)) for i in range(bands)])
    a = classes.select(F.inline(probes), F.col("id").alias("left_id"), F.col("bits").alias("lb"))
    b = classes.select(F.inline(holders), F.col("id").alias("right_id"), F.col("bits").alias("rb"))
    apart = F.col("lb").bitwiseXOR(F.col("rb"))
    first = F.coalesce(*[F.when(F.bit_count(band(apart, i)) <= near, F.lit(i)) for i in range(bands)])
    met = a.join(b, ["band", "value"]).where((F.col("left_id") < F.col("right_id")) & (F.bit_count(apart) <= most) & (F.col("band") == first))
    copies = class_pairs(df, bits, identity).select("left_id", "right_id", F.lit(0).alias("hamming"))
    return met.select("left_id", "right_id", F.bit_count(apart).alias("hamming")).unionByName(copies)


def cosine_pairs(df: DataFrame, vector: str, identity: str, least: float, blocks: int | None = None, best: int | None = None) -> DataFrame:
    """Pairs of vectors whose inner product is at least ``least``, in double precision.

    Exact, by metric partitioning (module ``metric``): only blocks whose distances to the
    pivots leave room for such a pair meet. Vectors of different lengths don't pair; null ones, and those with null or
    non-finite components, pair with none. With ``best`` only that many pairs, the most
    similar, ties to the smaller identities. ``blocks``: how many blocks to make, at least.
    """
    held = metric.Blocks(df, vector, identity, parts=blocks)
    return metric.similar_pairs(held, least) if best is None else metric.best_pairs(held, best, least)


def nearest_existing(candidates: DataFrame, existing: DataFrame, vector: str, identity: str) -> DataFrame:
    """Each candidate's largest inner product with the existing set, in double precision.

    Exact, by metric partitioning: see ``metric.nearest``. No pair is a row. Null without a
    vector of finite components, or without an existing one of its length.
    """
    number = F.monotonically_increasing_id()
    known = metric.Blocks(existing.select(F.col(vector).alias("v")).withColumn("n", number), "v", "n")
    held = written(candidates.select(F.col(identity).alias("_id"), F.col(vector).alias("v")).withColumn("n", number), "nearest-rows")
    found = metric.nearest(metric.Blocks(held, "v", "n", pivots=known.pivots), known)
    joined = held.select("_id", "n").join(found, held["n"] == found["id"], "left")
    return joined.groupBy("_id").agg(F.max("similarity").alias("similarity")).select(F.col("_id").alias(identity), "similarity")


def time_neighbours(df: DataFrame, group: str, stamp: str, strong: Column, seconds: int = 3600) -> DataFrame:
    """Rows within (0, seconds] of a strong row of their group, on either side.

    Time is cut into bins of ``seconds``. Any other strong instant of the row's own
    bin is near; of the bin before only the last can be, of the next only the
    first. So a row needs four numbers of its bin, which one join on group and bin
    brings; a group that holds most rows is spread over its bins.
    """
    at = F.unix_seconds(F.col(stamp).cast("timestamp"))
    rows = df.withColumns({"_at": at, "_bin": F.floor(at / seconds)})
    ends = rows.where(strong).groupBy(F.col(group).alias("_g"), "_bin").agg(F.min("_at").alias("_min"), F.max("_at").alias("_max"))
    seen = ends.select("_g", "_min", "_max", "_bin", F.explode(F.array(F.lit(-1), F.lit(0), F.lit(1))).alias("_step"))
    of = lambda step, c: F.max(F.when(F.col("_step") == step, F.col(c)))
    near = seen.groupBy("_g", (F.col("_bin") + F.col("_step")).alias("_b")).agg(of(1, "_max").alias("_before"), of(0, "_min").alias("_first"), of(0, "_max").alias("_last"), of(-1, "_min").alias("_after"))
    joined = rows.join(near, (rows[group] == near["_g"]) & (rows["_bin"] == near["_b"]))
    found = (F.col("_before") >= F.col("_at") - seconds) | (F.col("_first") != F.col("_at")) | (F.col("_last") != F.col("_at")) | (F.col("_after") <= F.col("_at") + seconds)
    return joined.where(found).select(*[rows[c] for c in df.columns])


def interval_join(points: DataFrame, intervals: DataFrame, keys: list[str], at: str, start: str, end: str, width: int) -> DataFrame:
    """Points within [start, end) of their group's intervals: both are cut into bins of
    ``width``, so a point meets the intervals of one bin."""
    cut = intervals.withColumn("_bin", F.explode(F.sequence(F.floor(F.col(start) / width), F.floor((F.col(end) - 1) / width))))
    return points.withColumn("_bin", F.floor(F.col(at) / width)).join(cut, [*keys, "_bin"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(end))).drop("_bin")
