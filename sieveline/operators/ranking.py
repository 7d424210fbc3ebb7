"""Orders, cuts and top-k. Every order ends in a key that is unique."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.session import written


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    ranked = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= n)


def first_then_rest(df: DataFrame, group: list[str], first_order: list[Column], rest_order: list[Column], unit: list[str]) -> DataFrame:
    """Within ``unit``: the first of each group before all others; position numbers both."""
    leads = Window.partitionBy(*unit, *group).orderBy(*first_order)
    marked = df.withColumn("is_first", F.row_number().over(leads) == 1)
    order = Window.partitionBy(*unit).orderBy(F.desc("is_first"), *rest_order)
    return marked.withColumn("position", F.row_number().over(order))


def round_robin(df: DataFrame, group: str, order: list[Column], across: list[Column]) -> DataFrame:
    """``turn``: the row's place in its group. Ordering by turn, then ``across``, takes the
    groups' best rows in turn."""
    return df.withColumn("turn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).orderBy("turn", *across)


def cumulative_cut(df: DataFrame, unit: list[str], order: list[Column], amount: str, target: Column) -> DataFrame:
    """Rows in order until their amounts reach the target: a row stays if the sum of those
    before it hasn't."""
    before = F.coalesce(F.sum(amount).over(Window.partitionBy(*unit).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("before", before).where(F.col("before") < target)


def capped(df: DataFrame, group: str, order: list[Column], cap: int, most: int) -> DataFrame:
    """The best ``most`` rows of which no group has more than ``cap``."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("_n") <= cap).drop("_n").orderBy(*order).limit(most)


def banded(df: DataFrame, value: str, bands: list[tuple[str, float, float, int]], order: list[Column]) -> DataFrame:
    """The first rows of each half-open band (name, from, to, number)."""
    named = F.coalesce(*[F.when((F.col(value) >= low) & (F.col(value) < high), F.lit(name)) for name, low, high, _ in bands])
    most = F.coalesce(*[F.when(F.col("band") == name, F.lit(n)) for name, _, _, n in bands])
    ranked = df.withColumn("band", named).where("band IS NOT NULL").withColumn("rank", F.row_number().over(Window.partitionBy("band").orderBy(*order)))
    return ranked.where(F.col("rank") <= most)


def spread(df: DataFrame, unit: list[str], part: str, order: list[Column], limit: int) -> DataFrame:
    """``limit`` rows of each unit, dealt over its parts in turn and evenly within each.

    Parts are numbered in order; slot by slot, each part that still has rows gives
    one, until the limit. A part with k slots of n rows gives those at
    round(i (n - 1) / max(1, k - 1)), halves to even.
    """
    w = Window.partitionBy(*unit, part)
    rows = df.withColumns({"_i": F.row_number().over(w.orderBy(*order)) - 1, "_n": F.count("*").over(w)})
    turns = Window.partitionBy(*unit).orderBy("_i", part)
    dealt = rows.withColumn("_turn", F.row_number().over(turns)).withColumn("_k", F.count(F.when(F.col("_turn") <= limit, 1)).over(w))
    wanted = F.transform(F.sequence(F.lit(0), F.col("_k").cast("int") - 1), lambda i: F.bround(i * (F.col("_n") - 1) / F.greatest(F.lit(1), F.col("_k") - 1)).cast("int"))
    return dealt.where("_k > 0").where(F.array_contains(wanted, F.col("_i").cast("int"))).drop("_i", "_n", "_turn", "_k")


def best_by(df: DataFrame, group: list[str], row: list[str], order: Column) -> DataFrame:
    """The row of the greatest order in each group."""
    best = F.max_by(F.struct(*row), order).alias("_b")
    found = df.groupBy(*group).agg(best) if group else df.agg(best)
    return found.select(*group, *[F.col(f"_b.{c}").alias(c) for c in row])


def numbered(df: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """``df`` numbered from 1 in a total order, by no single task: ranges of the order are sorted
    each for itself and written, and each begins where the counts of those before it end.

    The driver holds one count a range. Rows that tie get numbers in any order, the same
    for every later reader; rows without an order (nulls) come as the sort has them.
    """
    spark = df.sparkSession
    laid = written(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", F.monotonically_increasing_id()), "numbered")
    part, inner = F.shiftright("__at", 33), F.col("__at").bitwiseAND((1 << 33) - 1)
    counts = sorted(laid.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    starts, so_far = [], 0
    for p, n in counts:
        starts.append((p, so_far))
        so_far += n
    begun = spark.createDataFrame(starts, "__p long, __begun long")
    return laid.withColumn("__p", part).join(F.broadcast(begun), "__p").withColumn(name, F.col("__begun") + inner + 1).drop("__p", "__begun", "__at")


def review_order(df: DataFrame, required: str, priority: str, rank: Column) -> DataFrame:
    """Numbers rows: required first, then priority (blank last), then rank."""
    blank_last = F.coalesce(F.col(priority).try_cast("int"), F.lit(9))
    return numbered(df, [F.desc(required), blank_last, rank], "review_order").withColumn("review_order", F.col("review_order").cast("int"))
