"""Eligibility, joins, sets, scalars and aggregations over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import scalars as S
from sieveline.operators import aggregates as A
from sieveline.operators import joins as J
from sieveline.operators import ledger as L
from sieveline.operators.dedup import exact_representatives, replacement_ledger
from sieveline.plans.catalog import register, table

#: The library's stable rank of one column, in SQL.
RANK = "sha256('20260826' || chr(31) || {})"


@register(
    "exact_dedup_documents",
    f"""
    WITH c AS (SELECT sha256(coalesce(text, '')) AS k, count(*) AS copies, arg_min(doc_id, {RANK.format("doc_id")}) AS representative FROM documents GROUP BY 1)
    SELECT doc_id, copies, representative, doc_id = representative AS is_kept FROM documents JOIN c ON sha256(coalesce(text, '')) = k
    """,
)
def exact_dedup_documents(spark: SparkSession, d: str) -> DataFrame:
    """Exact copies, the representative of each by stable hash."""
    return exact_representatives(table(spark, d, "documents"), S.text_or_blank(F.col("text")), "doc_id").select("doc_id", "copies", "representative", "is_kept")


@register(
    "dedup_ledger",
    f"""
    WITH c AS (SELECT text, arg_min(doc_id, {RANK.format("doc_id")}) AS r FROM documents GROUP BY 1)
    SELECT doc_id, 'deduplication' AS stage, 'near_duplicate' AS reason_code, r AS replacement_id FROM documents JOIN c USING (text) WHERE doc_id <> r
    """,
)
def dedup_ledger(spark: SparkSession, d: str) -> DataFrame:
    return replacement_ledger(exact_representatives(table(spark, d, "documents"), S.text_or_blank(F.col("text")), "doc_id"), "doc_id")


def _eligible(spark: SparkSession, d: str) -> DataFrame:
    reasons = {
        "language_not_allowed": ~F.col("lang").isin("en", "de", "fr"),
        "text_blank": F.trim(S.text_or_blank(F.col("text"))) == "",
        "text_too_long": F.col("n_chars") > 4000,
        "text_too_short": F.col("n_chars") < 200,
    }
    return L.with_reasons(table(spark, d, "documents"), reasons)


_REASONS = """
    list_filter([CASE WHEN lang NOT IN ('en', 'de', 'fr') THEN 'language_not_allowed' END,
                 CASE WHEN trim(coalesce(text, '')) = '' THEN 'text_blank' END,
                 CASE WHEN n_chars > 4000 THEN 'text_too_long' END,
                 CASE WHEN n_chars < 200 THEN 'text_too_short' END], lambda x: x IS NOT NULL)
"""


@register("eligibility_ledger", f"SELECT doc_id, source, 'eligibility' AS stage, unnest({_REASONS}) AS reason_code FROM documents")
def eligibility_ledger(spark: SparkSession, d: str) -> DataFrame:
    return L.ledger(_eligible(spark, d), ["doc_id", "source"], "eligibility")


@register("eligibility_accepted", f"SELECT doc_id, lang, n_chars FROM documents WHERE len({_REASONS}) = 0")
def eligibility_accepted(spark: SparkSession, d: str) -> DataFrame:
    return L.accepted(_eligible(spark, d)).select("doc_id", "lang", "n_chars")


@register(
    "ordered_exclusion",
    """
    SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'negative_balance' WHEN c_custkey NOT IN (SELECT o_custkey FROM orders) THEN 'never_ordered'
           WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') THEN 'urgent_order' ELSE 'included' END AS decision FROM customer
    """,
)
def ordered_exclusion(spark: SparkSession, d: str) -> DataFrame:
    """One pass over orders gives both facts; the first reason that holds decides."""
    facts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.bool_or(F.col("o_orderpriority") == "1-URGENT").alias("urgent"))
    joined = table(spark, d, "customer").join(facts, "c_custkey", "left")
    decision = L.first_reason({"negative_balance": F.col("c_acctbal") < 0, "never_ordered": F.col("urgent").isNull(), "urgent_order": F.col("urgent")})
    return joined.select("c_custkey", decision.alias("decision"))


@register("missing_metadata", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def missing_metadata(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels").select("doc_id"), "doc_id", "left_anti")


@register("relevant_semi", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1 UNION SELECT doc_id FROM labels WHERE toxic = 1)")
def relevant_semi(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    wanted = labels.where("quality = 1").select("doc_id").unionByName(labels.where("toxic = 1").select("doc_id"))
    return table(spark, d, "documents").select("doc_id", "lang").join(wanted, "doc_id", "left_semi")


@register("multi_key_exclusion", "SELECT p_partkey, p_brand FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 49) AND p_brand NOT IN (SELECT p_brand FROM part WHERE p_size = 50)")
def multi_key_exclusion(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    sold = table(spark, d, "lineitem").where("l_quantity > 49").select(F.col("l_partkey").alias("p_partkey"))
    return J.exclude(part.select("p_partkey", "p_brand"), [(sold, "p_partkey"), (part.where("p_size = 50"), "p_brand")], blank_matches=True)


@register("reviewed_overlay", "SELECT d.doc_id, coalesce(l.quality, -1) AS quality, l.doc_id IS NOT NULL AS reviewed FROM documents d LEFT JOIN labels l USING (doc_id)")
def reviewed_overlay(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id").withColumns({"quality": F.lit(-1), "reviewed": F.lit(False)})
    return J.overlay(docs, table(spark, d, "labels").select("doc_id", "quality").withColumn("reviewed", F.lit(True)), ["doc_id"], ["quality", "reviewed"])


@register("last_wins_union", "SELECT doc_id, CASE WHEN toxic = 1 THEN 'second' ELSE 'first' END AS origin FROM labels")
def last_wins_union(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    return J.last_wins([labels.select("doc_id", F.lit("first").alias("origin")), labels.where("toxic = 1").select("doc_id", F.lit("second").alias("origin"))], ["doc_id"])


@register(
    "set_differences",
    """
    SELECT coalesce(a.k, b.k) AS k, CASE WHEN a.k IS NULL THEN 'right_only' ELSE 'left_only' END AS side
    FROM (SELECT DISTINCT c_custkey AS k FROM customer) a FULL JOIN (SELECT DISTINCT o_custkey AS k FROM orders) b ON a.k = b.k WHERE a.k IS NULL OR b.k IS NULL
    """,
)
def set_differences(spark: SparkSession, d: str) -> DataFrame:
    return L.set_differences(table(spark, d, "customer").select(F.col("c_custkey").alias("k")), table(spark, d, "orders").select(F.col("o_custkey").alias("k")), ["k"])


@register("set_intersection", "SELECT n_nationkey AS k FROM nation WHERE n_nationkey IN (SELECT c_nationkey FROM customer) AND n_nationkey IN (SELECT s_nationkey FROM supplier)")
def set_intersection(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select(F.col("c_nationkey").alias("k")).intersect(table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@register("set_except", "SELECT doc_id FROM labels EXCEPT SELECT doc_id FROM labels WHERE quality = 1")
def set_except(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    return labels.select("doc_id").exceptAll(labels.where("quality = 1").select("doc_id")).distinct()


@register("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return L.duplicates(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("unknown_references", "SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 25)")
def unknown_references(spark: SparkSession, d: str) -> DataFrame:
    known = table(spark, d, "part").where("p_size < 25").select(F.col("p_partkey").alias("l_partkey"))
    return L.unknown_references(table(spark, d, "lineitem").select("l_partkey").distinct(), known, ["l_partkey"])


@register("union_counts", "SELECT origin, count(*) AS n FROM (SELECT 'customer' AS origin FROM customer UNION ALL SELECT 'supplier' FROM supplier UNION ALL SELECT 'part' FROM part) GROUP BY origin")
def union_counts(spark: SparkSession, d: str) -> DataFrame:
    parts = [table(spark, d, t).select(F.lit(t).alias("origin")) for t in ("customer", "supplier", "part")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("origin").agg(F.count("*").alias("n"))


@register("lookup_enrichment", "SELECT s_suppkey, n_name, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey")
def lookup_enrichment(spark: SparkSession, d: str) -> DataFrame:
    """nation and region have 25 and 5 rows at every scale, so they are broadcast."""
    n, r = F.broadcast(table(spark, d, "nation")), F.broadcast(table(spark, d, "region"))
    return table(spark, d, "supplier").join(n, F.col("s_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey")).select("s_suppkey", "n_name", "r_name")


@register(
    "review_agreement",
    """
    SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'missing_round' WHEN doc_id % 5 = 0 THEN 'same_reviewer' WHEN quality = 1 AND toxic = 0 THEN 'accepted_negative' ELSE 'requires_resolution' END AS result FROM labels
    """,
)
def review_agreement(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels")
    say = lambda c: F.when(c, "confirmed_negative").otherwise("object_present")
    first = labels.select("doc_id", say(F.col("quality") == 1).alias("decision"), F.lit("a").alias("reviewer"))
    second = labels.where("doc_id % 7 <> 0").select("doc_id", say(F.col("toxic") == 0).alias("decision"), F.when(F.col("doc_id") % 5 == 0, "a").otherwise("b").alias("reviewer"))
    return A.agreement(first, second, "doc_id").select("doc_id", "result")


@register("floor_deficits", "SELECT b AS p_brand, f AS floor, coalesce(n, 0) AS n, greatest(0, f - coalesce(n, 0)) AS deficit FROM (VALUES ('Brand#11', 5), ('Brand#12', 100000), ('None', 3)) v(b, f) LEFT JOIN (SELECT p_brand, count(*) AS n FROM part GROUP BY 1) ON b = p_brand")
def floor_deficits(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"))
    return A.deficits(counts, {"Brand#11": 5, "Brand#12": 100000, "None": 3}, "p_brand")


@register("composition_check", "SELECT r_name AS k, 1 AS expected, count(*) AS n, count(*) = 1 AS as_expected FROM region GROUP BY r_name")
def composition_check(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "region").groupBy(F.col("r_name").alias("k")).agg(F.count("*").alias("n"))
    return A.composition(counts, {"AFRICA": 1, "AMERICA": 1, "ASIA": 1, "EUROPE": 1, "MIDDLE EAST": 1}, "k")


@register(
    "calibrated_threshold",
    """
    WITH s AS (SELECT (least(n_chars, 10000) / 10000.0)::DOUBLE AS score, quality = 1 AS good FROM documents JOIN labels USING (doc_id)),
    t AS (SELECT i / 10.0::DOUBLE AS threshold FROM range(0, 10) r(i)),
    c AS (SELECT threshold, count(score) AS n, count(*) FILTER (NOT good) AS bad FROM t LEFT JOIN s ON score >= threshold GROUP BY threshold),
    r AS (SELECT *, CASE WHEN n > 0 THEN bad / n ELSE 0 END AS share FROM c)
    SELECT round(threshold, 6) AS threshold, n, bad, round(share, 6) AS bad_share, coalesce(threshold = (SELECT min(threshold) FROM r WHERE share <= 0.1), false) AS chosen FROM r
    """,
)
def calibrated_threshold(spark: SparkSession, d: str) -> DataFrame:
    scored = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id").select((F.least("n_chars", F.lit(10000)) / 10000.0).alias("score"), (F.col("quality") == 1).alias("good"))
    found = A.threshold_calibration(scored, "score", "good", [i / 10 for i in range(10)], 0.1)
    return found.select(F.round("threshold", 6).alias("threshold"), "n", "bad", F.round("bad_share", 6).alias("bad_share"), F.coalesce("chosen", F.lit(False)).alias("chosen"))


@register("replica_statistics", "SELECT lang, round(avg(n_chars), 6) AS mean, min(n_chars) AS least, round(coalesce(stddev_samp(n_chars), 0), 4) AS deviation, count(*) AS n FROM documents GROUP BY lang")
def replica_statistics(spark: SparkSession, d: str) -> DataFrame:
    found = A.replicas(table(spark, d, "documents"), ["lang"], "n_chars")
    return found.select("lang", F.round("mean", 6).alias("mean"), "least", F.round("deviation", 4).alias("deviation"), "n")


@register("singleton_groups", "SELECT o_custkey, list_sort(list_distinct(list(o_orderstatus))) AS values, count(DISTINCT o_orderstatus) = 1 AS single FROM orders GROUP BY o_custkey")
def singleton_groups(spark: SparkSession, d: str) -> DataFrame:
    return A.singletons(table(spark, d, "orders"), "o_custkey", "o_orderstatus")


@register("season_counts", "SELECT CASE WHEN month(o_orderdate) IN (12, 1, 2) THEN 'winter' WHEN month(o_orderdate) IN (3, 4, 5) THEN 'spring' WHEN month(o_orderdate) IN (6, 7, 8) THEN 'summer' ELSE 'autumn' END AS season, count(*) AS n FROM orders GROUP BY 1")
def season_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").groupBy(S.season(F.month("o_orderdate")).alias("season")).agg(F.count("*").alias("n"))


@register("conditional_counts", "SELECT event_type, count(*) AS n, count(*) FILTER (value > 50) AS large, count(DISTINCT user_id) AS users, coalesce(max(value) FILTER (user_id % 2 = 0), 0) AS most_even FROM events GROUP BY event_type")
def conditional_counts(spark: SparkSession, d: str) -> DataFrame:
    even = F.max(F.when(F.col("user_id") % 2 == 0, F.col("value")))
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_if(F.col("value") > 50).alias("large"), F.count_distinct("user_id").alias("users"), F.coalesce(even, F.lit(0.0)).alias("most_even"))


@register("exploded_counts", "SELECT w, count(*) AS n, count(DISTINCT p_partkey) AS frames FROM (SELECT p_partkey, unnest(string_split(p_type, ' ')) AS w FROM part) GROUP BY w")
def exploded_counts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", F.explode(F.split("p_type", " ")).alias("w")).groupBy("w").agg(F.count("*").alias("n"), F.count_distinct("p_partkey").alias("frames"))


@register("grouped_lists", "SELECT user_id, list_sort(list_distinct(list(event_type))) AS types, bool_or(value > 99) AS any_large FROM events GROUP BY user_id")
def grouped_lists(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("types"), F.bool_or(F.col("value") > 99).alias("any_large"))


@register("workflow_stage", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'finished' WHEN o_totalprice > 200000 THEN 'review' WHEN o_orderpriority LIKE '1%' THEN 'urgent' ELSE 'open' END AS stage FROM orders")
def workflow_stage(spark: SparkSession, d: str) -> DataFrame:
    states = {"finished": F.col("o_orderstatus") == "F", "review": F.col("o_totalprice") > 200000, "urgent": F.col("o_orderpriority").startswith("1")}
    return table(spark, d, "orders").select("o_orderkey", A.stage(states, "open").alias("stage"))


@register("gate_all", "SELECT bool_and(c_acctbal > -1000) AS balances, bool_and(c_nationkey < 25) AS nations, bool_and(c_acctbal > 0) AS positive FROM customer")
def gate_all(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").agg(F.bool_and(F.col("c_acctbal") > -1000).alias("balances"), F.bool_and(F.col("c_nationkey") < 25).alias("nations"), F.bool_and(F.col("c_acctbal") > 0).alias("positive"))


@register(
    "tpch_style_rollup",
    """
    SELECT coalesce(r_name, 'all') AS region, coalesce(n_name, 'all') AS nation, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    GROUP BY ROLLUP (r_name, n_name)
    """,
)
def tpch_style_rollup(spark: SparkSession, d: str) -> DataFrame:
    """Aggregated by nation first, so that the rollup expands 25 rows and not every line."""
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_extendedprice", "l_discount")
    joined = lines.join(table(spark, d, "orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey")).join(table(spark, d, "customer").select("c_custkey", "c_nationkey"), F.col("o_custkey") == F.col("c_custkey"))
    by_nation = joined.groupBy("c_nationkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), F.count("*").alias("n"))
    named = by_nation.join(F.broadcast(table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey")).join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return named.rollup("r_name", "n_name").agg(F.round(F.sum("revenue"), 2).alias("revenue"), F.sum("n").alias("n")).select(F.coalesce("r_name", F.lit("all")).alias("region"), F.coalesce("n_name", F.lit("all")).alias("nation"), "revenue", "n")


@register("json_props", "SELECT event_id, (props->>'$.k')::BIGINT AS k, '{\"k\":' || (props->>'$.k') || '}' AS canonical FROM events")
def json_props(spark: SparkSession, d: str) -> DataFrame:
    parsed = F.from_json("props", "k long")
    return table(spark, d, "events").select("event_id", parsed["k"].alias("k"), F.to_json(parsed).alias("canonical"))


@register(
    "scalar_text",
    """
    SELECT p_partkey, nullif(regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9._-]+', '-', 'g'), '^[-.]+|[-.]+$', '', 'g'), '') AS slug,
           printf('image_%04d_', p_partkey % 10000) || substr(sha256(p_name), 1, 12) || '.jpg' AS file_name,
           split_part(p_brand, '#', 1) AS head, 'part-' || substr(sha256(p_brand), 1, 16) AS group_id,
           concat_ws('; ', nullif(p_brand, ''), nullif(p_type, '')) AS context FROM part
    """,
)
def scalar_text(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select(
        "p_partkey",
        S.slug(F.col("p_name")).alias("slug"),
        S.numbered_name(F.col("p_name"), F.col("p_partkey") % 10000).alias("file_name"),
        S.before_mark(F.col("p_brand"), "#").alias("head"),
        S.short_id("part-", F.col("p_brand")).alias("group_id"),
        S.context_text(F.col("p_brand"), F.col("p_type")).alias("context"),
    )


@register(
    "scalar_hashes",
    f"""
    WITH h AS (SELECT doc_id, {RANK.format("doc_id")} AS r FROM documents)
    SELECT doc_id, r AS rank, round(('0x' || substr(r, 1, 13))::BIGINT / 4503599627370496.0::DOUBLE, 9) AS fraction,
           bit_count(xor(('0x' || substr(r, 1, 15))::BIGINT, ('0x' || substr(r, 16, 15))::BIGINT)) AS apart FROM h
    """,
)
def scalar_hashes(spark: SparkSession, d: str) -> DataFrame:
    r = S.stable_rank("doc_id")
    bits = lambda at: F.conv(F.substring(r, at, 15), 16, 10).cast("bigint")
    return table(spark, d, "documents").select("doc_id", r.alias("rank"), F.round(S.hash_fraction(r), 9).alias("fraction"), S.hamming(bits(1), bits(16)).alias("apart"))


@register(
    "scalar_dates_numbers",
    """
    SELECT event_id, user_id || ':' || strftime(ts, '%Y-%m-%d') AS day_group, abs(floor(epoch(ts))::BIGINT - epoch(TIMESTAMP '2024-01-01')::BIGINT) AS apart,
           round_even(event_id / 2.0, 0)::BIGINT AS even, (event_id // 7)::INT + (user_id % 7 < event_id % 7)::INT AS part, least(greatest(value, 10), 90) AS clamped FROM events
    """,
)
def scalar_dates_numbers(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").select(
        "event_id",
        S.day_group(F.col("user_id"), F.col("ts")).alias("day_group"),
        S.seconds_apart(F.col("ts"), F.lit("2024-01-01 00:00:00").cast("timestamp")).alias("apart"),
        S.half_even(F.col("event_id") / 2.0).cast("bigint").alias("even"),
        S.share(F.col("event_id"), 7, F.col("user_id") % 7).alias("part"),
        S.clamp(F.col("value"), F.lit(10.0), F.lit(90.0)).alias("clamped"),
    )


@register("vector_checks", "SELECT vec_id, round(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]), 5) AS norm, len(embedding) AS width, true AS valid FROM embeddings")
def vector_checks(spark: SparkSession, d: str) -> DataFrame:
    v = F.col("embedding")
    return table(spark, d, "embeddings").select("vec_id", F.round(S.dot(v, v), 5).alias("norm"), F.size(v).alias("width"), S.valid_vector(v).alias("valid"))


@register("unit_vectors", "SELECT vec_id, round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)) / sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 5) AS total FROM embeddings")
def unit_vectors(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "embeddings").select("vec_id", F.round(F.aggregate(S.unit_vector(F.col("embedding")), F.lit(0.0), lambda s, x: s + x), 5).alias("total"))


@register("rotation_parse", "SELECT doc_id, CASE WHEN doc_id % 6 = 1 THEN 0 WHEN doc_id % 6 = 2 THEN 90 WHEN doc_id % 6 = 3 THEN 270 END::INT AS rotation, doc_id % 4 = 0 AS flag, CASE WHEN doc_id % 3 = 0 THEN true WHEN doc_id % 3 = 1 THEN false END AS strict FROM documents")
def rotation_parse(spark: SparkSession, d: str) -> DataFrame:
    pick = lambda values: F.get(F.array(*[F.lit(v) for v in values]), (F.col("doc_id") % len(values)).cast("int"))
    return table(spark, d, "documents").select("doc_id", L.rotation_or_null(pick(["", "0", "90.0", " 270", "45", "nan"])).alias("rotation"), S.flag(pick(["1", "0", "", "yes"])).alias("flag"), S.strict_bool(pick([" True", "false", "1"])).alias("strict"))


@register(
    "unit_box_faults",
    "SELECT l_orderkey, count(*) AS n, count(*) FILTER (NOT (l_discount < l_tax AND l_quantity / 50 < 0.5)) AS faulty FROM lineitem GROUP BY l_orderkey",
)
def unit_box_faults(spark: SparkSession, d: str) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    wide = F.when(F.col("l_quantity") / 50 < 0.5, F.lit("0.5")).otherwise(F.lit("x"))
    return table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"), F.count_if(L.unit_box_faults(text("l_discount"), F.lit("0"), text("l_tax"), wide)).alias("faulty"))


@register("candidate_kinds", "SELECT doc_id, CASE WHEN quality = 1 AND toxic = 1 THEN 'positive' WHEN quality = 0 OR toxic = 1 THEN 'negative' END AS kind FROM labels")
def candidate_kinds(spark: SparkSession, d: str) -> DataFrame:
    kind = L.candidate_kind((F.col("quality") == 1) & (F.col("toxic") == 1), F.col("quality") == 0, F.col("toxic") == 1)
    return table(spark, d, "labels").select("doc_id", kind.alias("kind"))


@register("leakage_audit", "SELECT 'text' AS domain, text AS value, count(DISTINCT lang) AS splits FROM documents WHERE text <> '' GROUP BY text HAVING count(DISTINCT lang) > 1 UNION ALL SELECT 'source', source, count(DISTINCT lang) FROM documents GROUP BY source HAVING count(DISTINCT lang) > 1")
def leakage_audit(spark: SparkSession, d: str) -> DataFrame:
    from sieveline.operators.splits import leakage

    return leakage(table(spark, d, "documents"), "lang", {"text": ["text"], "source": ["source"]})


@register(
    "site_day_split",
    """
    WITH g AS (SELECT DISTINCT user_id, user_id || ':' || strftime(ts, '%Y-%m-%d') AS day FROM events),
    r AS (SELECT *, count(*) OVER (PARTITION BY user_id) AS n, row_number() OVER (PARTITION BY user_id ORDER BY sha256('17' || chr(31) || user_id || chr(31) || day)) AS r FROM g),
    t AS (SELECT *, greatest(3, round_even(n * 0.2::DOUBLE, 0)::INT) AS test FROM r),
    s AS (SELECT *, greatest(1, least(n - test - 1, round_even((n - test) * 0.5::DOUBLE, 0)::INT)) AS dev FROM t WHERE n >= test + 2)
    SELECT event_id, CASE WHEN r <= test THEN 'sealed_test' WHEN r <= test + dev THEN 'development' ELSE 'mining' END AS split
    FROM events e JOIN s ON e.user_id = s.user_id AND s.day = e.user_id || ':' || strftime(ts, '%Y-%m-%d')
    """,
)
def site_day_split(spark: SparkSession, d: str) -> DataFrame:
    from sieveline.operators.splits import site_day_split as split

    return split(table(spark, d, "events").withColumn("day", S.day_group(F.col("user_id"), F.col("ts"))), "user_id", "day").select("event_id", "split")
