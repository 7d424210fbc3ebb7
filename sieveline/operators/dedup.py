"""Duplicates: exact classes, signalled pairs, reviewed components, representatives."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.scalars import SEED, UNIT, dot, stable_rank
from sieveline.operators import metric
from sieveline.operators.graph import components
from sieveline.operators.joins import class_pairs, cosine_pairs, hamming_pairs, redealt
from sieveline.session import written


def exact_representatives(df: DataFrame, key: Column, identity: str) -> DataFrame:
    """``df`` with the class' size and representative: the identity of the least stable hash."""
    keyed = df.withColumn("_k", F.sha2(key, 256))
    best = keyed.groupBy("_k").agg(F.count("*").alias("copies"), F.min_by(identity, F.struct(stable_rank(identity), F.col(identity))).alias("representative"))
    return keyed.join(redealt(best), "_k").withColumn("is_kept", F.col(identity) == F.col("representative")).drop("_k")


def signalled(parts: dict[str, DataFrame]) -> DataFrame:
    """Pairs (left_id, right_id) of several searches, with the sorted names of those that found them."""
    every = None
    for name, pairs in parts.items():
        named = pairs.select("left_id", "right_id", F.lit(name).alias("signal"))
        every = named if every is None else every.unionByName(named)
    return every.groupBy("left_id", "right_id").agg(F.array_join(F.array_sort(F.collect_set("signal")), ";").alias("signals"))


def reviewed_faults(pairs: DataFrame) -> DataFrame:
    """Reviewed pairs that contradict themselves: an exact pair called distinct, or a
    decision without a reviewer or a known value."""
    exact = F.col("signals").rlike("(^|;)(source_sha256|decoded_sha256)(;|$)")
    fault = F.when(exact & (F.col("decision") == "distinct"), "exact_pair_distinct").when(~F.coalesce(F.col("decision").isin("duplicate", "distinct"), F.lit(False)), "undecided").when(F.coalesce(F.col("reviewer"), F.lit("")) == "", "unattributed")
    return pairs.withColumn("fault", fault).where("fault IS NOT NULL")


def duplicate_groups(rows: DataFrame, edges: DataFrame, identity: str, prefix: str = "duplicate-", digits: int = 20) -> DataFrame:
    """``rows`` with group_id (a hash of its members), representative and is_kept, by
    connected components of edges (left_id, right_id); a row without edges is its own group."""
    roots = components(edges.select(F.col("left_id").alias("a"), F.col("right_id").alias("b")))
    joined = rows.join(roots, rows[identity] == roots["node"], "left").withColumn("_root", F.coalesce("root", identity)).drop("node", "root")
    groups = joined.groupBy("_root").agg(
        F.min_by(identity, F.struct(stable_rank(identity), F.col(identity))).alias("representative"),
        F.concat(F.lit(prefix), F.substring(F.sha2(F.array_join(F.array_sort(F.collect_set(F.col(identity).cast("string"))), UNIT), 256), 1, digits)).alias("group_id"),
        F.count("*").alias("members"),
    )
    return joined.join(redealt(groups), "_root").withColumn("is_kept", F.col(identity) == F.col("representative")).drop("_root")


def replacement_ledger(grouped: DataFrame, identity: str) -> DataFrame:
    """What was removed, and for what."""
    return grouped.where(~F.col("is_kept")).select(F.col(identity), F.lit("deduplication").alias("stage"), F.lit("near_duplicate").alias("reason_code"), F.col("representative").alias("replacement_id"))


def resolved_edges(pairs: DataFrame) -> DataFrame:
    """Which signalled pairs are edges: exact ones, embedding ones, and perceptual ones of
    one site and instant; other perceptual pairs are collisions."""
    has = lambda *names: F.exists(F.split("signals", ";"), lambda s: s.isin(*names))
    same = (F.col("left_site") == F.col("right_site")) & (F.col("left_stamp") == F.col("right_stamp"))
    edge = has("source_sha256", "decoded_sha256", "sscd_auto", "sscd_review") | (has("phash") & same)
    return pairs.withColumn("resolution", F.when(edge, "edge").when(has("phash"), "resolved_collision").otherwise("none"))


#: Up to so many row pairs are all candidates for controls; of more, controls are drawn.
ALL_PAIRS = 20_000


def _controls(df: DataFrame, vector: str, identity: str, number: int) -> DataFrame:
    """left_id, right_id, cosine and _h: pairs of any two rows, at least ``number`` of them
    if there are as many, in the order of _h.

    A draw hashes every identity with its number, once for each side; the least hash
    is the row drawn, so any row pair is as likely as another and no pair table is made.
    """
    held = df.where(F.col(vector).isNotNull()).select(F.col(identity).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    n = held.count()
    if n * (n - 1) // 2 <= max(ALL_PAIRS, 4 * number):
        return cosine_pairs(df, vector, identity, float("-inf")).withColumn("_h", stable_rank(F.lit("control"), "left_id", "right_id"))
    sides = [F.min(F.struct(F.xxhash64(F.lit(SEED), F.lit(side), "draw", "id"), "id")).getField("id").alias(side) for side in ("x", "y")]
    drawn = held.select("id", F.explode(F.sequence(F.lit(0), F.lit(2 * number + 99))).alias("draw")).groupBy("draw").agg(*sides)
    pairs = drawn.where("x <> y").groupBy(F.least("x", "y").alias("left_id"), F.greatest("x", "y").alias("right_id")).agg(F.lpad(F.min("draw").cast("string"), 10, "0").alias("_h"))
    left, right = (held.select(F.col("id").alias(f"{side}_id"), F.col("v").alias(f"_{side}")) for side in ("left", "right"))
    return pairs.join(left, "left_id").join(right, "right_id").select("left_id", "right_id", dot("_left", "_right").alias("cosine"), "_h")


def banded_sample(held: metric.Blocks, bands: list[tuple[str, float, float, int]]) -> DataFrame:
    """left_id, right_id, cosine, band, h and rank: of each band the pairs of the least stable hash. Every
    two blocks bring as many at most, so no band's pairs are ever rows."""
    rank = lambda *parts: hashlib.sha256(UNIT.join([SEED, *map(str, parts)]).encode()).hexdigest()
    most = F.coalesce(*[F.when(F.col("band") == name, F.lit(n)) for name, *_, n in bands])
    found = metric.banded_pairs(held, bands, rank).withColumn("rank", F.row_number().over(Window.partitionBy("band").orderBy("h")))
    return found.where(F.col("rank") <= most)


def calibration_sample(df: DataFrame, vector: str, identity: str, bands: list[tuple[str, float, float, int]], minimum: int) -> DataFrame:
    """Pairs to review: so many of each band by hash, then the most similar of the rest until
    there are half of ``minimum``, then controls up to ``minimum``, drawn from all row pairs."""
    named = F.coalesce(*[F.when((F.col("cosine") >= low) & (F.col("cosine") < high), F.lit(name)) for name, low, high, _ in bands], F.lit("control"))
    held = metric.Blocks(df, vector, identity)
    banded = banded_sample(held, bands).select("left_id", "right_id", "cosine", F.col("h").alias("_h"), F.lit("band").alias("kind"))
    top = minimum // 2 + sum(n for *_, n in bands)
    similar = metric.best_pairs(held, top).select("left_id", "right_id", "cosine", F.lit("").alias("_h"), F.lit("similar").alias("kind"))
    controls = _controls(df, vector, identity, minimum + top).select("left_id", "right_id", "cosine", "_h", F.lit("control").alias("kind"))

    # a few hundred rows from here on; a pair counts where it comes first
    turn = F.when(F.col("kind") == "band", 0).when(F.col("kind") == "similar", 1).otherwise(2)
    order = [turn, F.when(F.col("kind") == "similar", -F.col("cosine")), "_h", "left_id", "right_id"]
    queue = banded.unionByName(similar).unionByName(controls.orderBy("_h").limit(minimum + top))
    once = queue.withColumn("_n", F.row_number().over(Window.partitionBy("left_id", "right_id").orderBy(turn))).where("_n = 1")
    counted = once.withColumn("_at", F.row_number().over(Window.orderBy(*order)))
    kept = counted.where((F.col("kind") != "similar") | (F.col("_at") <= minimum // 2))
    return kept.orderBy(*order).limit(minimum).select("left_id", "right_id", "cosine", named.alias("band"), "kind")


def composition_faults(rows: DataFrame, vectors: DataFrame, identity: str, digests: list[str], *, vector: str = "embedding", model: str = "model", least: float = 0.95) -> DataFrame:
    """kind, left and right (text): everything for which the audit of a final composition refuses it.

    duplicate_<digest>: a row and the least other one of equal digest (blanks and nulls are none);
    missing_vector: a row that ``vectors`` says nothing usable of; several_vectors: a row with more
    than one; several_models: a row whose vector comes from another model than most rows' (the
    lesser name at ties); similar: rows whose vectors' inner product reaches ``least``.
    Identities are longs. Vectors of rows outside the composition take no part, nor do rows without an identity.
    """
    row = lambda df, kind, left, right: df.select(F.lit(kind).alias("kind"), left.cast("string").alias("left"), right.cast("string").alias("right"))
    known = rows.where(F.col(identity).isNotNull())
    parts = []
    for digest in digests:
        marked = known.select(F.col(identity).alias("id"), F.nullif(F.trim(F.col(digest)), F.lit("")).alias("d"))
        parts.append(row(class_pairs(marked, "d", "id"), f"duplicate_{digest}", F.col("left_id"), F.col("right_id")))
    usable = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & (F.size(vector) > 0)
    held = vectors.where(usable).join(known.select(F.col(identity).alias("id")).distinct(), vectors[identity] == F.col("id"), "left_semi")
    held = written(held.select(F.col(identity).cast("long").alias("id"), F.col(vector).alias("v"), F.col(model).alias("m")), "audited")
    parts.append(row(known.join(held, F.col(identity) == F.col("id"), "left_anti"), "missing_vector", F.col(identity), F.lit(None)))
    parts.append(row(held.groupBy("id").agg(F.count("*").alias("n")).where("n > 1"), "several_vectors", F.col("id"), F.col("n")))
    named = F.coalesce("m", F.lit(""))
    most = held.groupBy(named.alias("most")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "most").limit(1).select("most")
    parts.append(row(held.join(F.broadcast(most), named != F.col("most")), "several_models", F.col("id"), F.col("m")))
    # copies of a vector are one class in the join, each linked to its first, so that they don't give all their pairs
    copies = class_pairs(held.where(dot("v", "v") >= least), "v", "id")
    first = held.groupBy("v").agg(F.min("id").alias("id"))
    near = metric.similar_pairs(metric.Blocks(first, "v", "id"), least).select("left_id", "right_id").where("left_id <> right_id").unionByName(copies.select("left_id", "right_id"))
    parts.append(row(near.distinct(), "similar", F.col("left_id"), F.col("right_id")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def perceptual_candidates(rows: DataFrame, bits: str, identity: str, most: int, width: int = 64) -> DataFrame:
    """One row, candidates: how many pairs of rows differ in at most ``most`` bits. The pairs of two classes
    of equal bits are the product of their sizes, so copies are counted and not paired."""
    held = rows.where(F.col(bits).isNotNull())
    classes = held.groupBy(F.col(bits).alias("bits")).agg(F.min(identity).alias("id"), F.count("*").alias("n"))
    near = hamming_pairs(classes, "bits", "id", most, width)
    size = lambda n: classes.select(F.col("id").alias(f"{n}_id"), F.col("n").alias(f"{n}_n"))
    between = near.join(size("left"), "left_id").join(size("right"), "right_id").select((F.col("left_n") * F.col("right_n")).alias("pairs"))
    inside = classes.select(F.expr("n * (n - 1) div 2").alias("pairs"))
    return between.unionByName(inside).agg(F.coalesce(F.sum("pairs"), F.lit(0)).alias("candidates"))
