"""Eligibility with reasons, and checks that return what is wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def require_columns(df: DataFrame, names: list[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_reasons(df: DataFrame, reasons: dict[str, Column]) -> DataFrame:
    """``df`` with ``reasons``: the names of all conditions that hold, sorted. A
    condition that is null doesn't hold."""
    named = [F.when(condition, F.lit(name)) for name, condition in reasons.items()]
    return df.withColumn("reasons", F.array_sort(F.array_compact(F.array(*named))))


def accepted(df: DataFrame) -> DataFrame:
    return df.where(F.size("reasons") == 0).drop("reasons")


def ledger(df: DataFrame, identity: list[str], stage: str) -> DataFrame:
    """One row per rejected row and reason."""
    return df.select(*identity, F.lit(stage).alias("stage"), F.explode("reasons").alias("reason_code"))


def first_reason(reasons: dict[str, Column], otherwise: str = "included") -> Column:
    """The first condition that holds names the decision."""
    return F.coalesce(*[F.when(condition, F.lit(name)) for name, condition in reasons.items()], F.lit(otherwise))


def unit_box_faults(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Whether texts fail to be a box of shares: numbers in [0, 1], least before most."""
    number = lambda c: c.try_cast("double")
    inside = lambda c: F.coalesce(number(c).between(0.0, 1.0), F.lit(False))
    return ~(inside(x1) & inside(y1) & inside(x2) & inside(y2) & F.coalesce((number(x1) < number(x2)) & (number(y1) < number(y2)), F.lit(False)))


def rotation_or_null(value: Column) -> Column:
    """0, 90, 180 or 270 from text; blank and nan are null, and so is anything else."""
    number = F.trim(value).try_cast("double")
    return F.when(number.isin(0.0, 90.0, 180.0, 270.0), number.cast("int"))


def candidate_kind(live: Column, verified_negative: Column, confuser: Column) -> Column:
    return F.when(live, "positive").when(verified_negative | confuser, "negative")


def small_target(boxes: Column, most: float) -> Column:
    """Whether the smallest side of any box of shares is at most ``most``."""
    return F.array_min(F.transform(boxes, lambda b: F.least(b["x2"] - b["x1"], b["y2"] - b["y1"]))) <= most


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that several rows share, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def unknown_references(df: DataFrame, known: DataFrame, keys: list[str]) -> DataFrame:
    return df.join(known.select(*keys).distinct(), keys, "left_anti")


def set_differences(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys on one side only, and on which."""
    a, b = (x.select(*keys).distinct().withColumn(f"_{n}", F.lit(True)) for n, x in (("l", left), ("r", right)))
    both = a.join(b, keys, "full").where("_l IS NULL OR _r IS NULL")
    return both.select(*keys, F.when(F.col("_l").isNull(), "right_only").otherwise("left_only").alias("side"))


def guard_sealed(df: DataFrame, column: str, sealed: str, opened: bool) -> DataFrame:
    """Refuse rows of the sealed partition unless the protocol was opened."""
    if not opened and not df.where(F.col(column) == sealed).isEmpty():
        raise PermissionError(f"rows of {sealed} are closed")
    return df
