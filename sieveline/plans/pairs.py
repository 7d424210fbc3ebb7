"""Near pairs, components, deduplication and selection over the driver's tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import scalars as S
from sieveline.operators import dedup as D
from sieveline.operators import joins as J
from sieveline.operators.graph import components
from sieveline.operators.lazy import diverse
from sieveline.operators.metric import Blocks
from sieveline.operators.splits import bootstrap, paired_bootstrap, poisson_steps
from sieveline.plans.catalog import register, table

_DOT = "list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])"


@register("duplicate_pairs_equal", "SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS class_id, count(*) OVER (PARTITION BY text) - 1 AS links FROM documents WHERE text IS NOT NULL QUALIFY count(*) OVER (PARTITION BY text) > 1")
def duplicate_pairs_equal(spark: SparkSession, d: str) -> DataFrame:
    """Each copy's class and the number of its pairs: the pairs themselves grow with the square."""
    return J.class_links(table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("k")), "k", "doc_id")


@register("duplicate_class_pairs", "SELECT min(doc_id) OVER (PARTITION BY text) AS left_id, doc_id AS right_id FROM documents QUALIFY doc_id > min(doc_id) OVER (PARTITION BY text)")
def duplicate_class_pairs(spark: SparkSession, d: str) -> DataFrame:
    return J.class_pairs(table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("k")), "k", "doc_id")


@register(
    "hamming_pairs",
    """
    WITH h AS (SELECT doc_id, ('0x' || substr(sha256(text), 1, 15))::BIGINT AS b FROM documents WHERE text IS NOT NULL), k AS (SELECT b, min(doc_id) AS id FROM h GROUP BY b)
    SELECT x.id AS left_id, y.id AS right_id, bit_count(xor(x.b, y.b)) AS hamming FROM k x JOIN k y ON x.id < y.id WHERE bit_count(xor(x.b, y.b)) <= 12
    UNION ALL SELECT k.id, h.doc_id, 0 FROM h JOIN k USING (b) WHERE h.doc_id > k.id
    """,
)
def hamming_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of classes of equal bits, and each copy with its class."""
    bits = table(spark, d, "documents").select("doc_id", F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("bigint").alias("b"))
    return J.hamming_pairs(bits, "b", "doc_id", 12, 60)


@register("cosine_pairs", f"SELECT a.vec_id AS left_id, b.vec_id AS right_id, round({_DOT}, 5) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_DOT} >= 0.35")
def cosine_pairs(spark: SparkSession, d: str) -> DataFrame:
    return J.cosine_pairs(table(spark, d, "embeddings"), "embedding", "vec_id", 0.35).select("left_id", "right_id", F.round("cosine", 5).alias("cosine"))


@register(
    "cosine_bands",
    f"""
    WITH p AS (SELECT a.vec_id AS l, b.vec_id AS r, {_DOT} AS c FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id WHERE {_DOT} >= 0.3),
    n AS (SELECT l, r, CASE WHEN c >= 0.4 THEN 'high' WHEN c >= 0.35 THEN 'middle' ELSE 'low' END AS band FROM p),
    k AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY sha256('20260826' || chr(31) || band || chr(31) || l || chr(31) || r)) AS rank FROM n)
    SELECT l AS left_id, r AS right_id, band, rank FROM k WHERE rank <= 20
    """,
)
def cosine_bands(spark: SparkSession, d: str) -> DataFrame:
    held = Blocks(table(spark, d, "embeddings"), "embedding", "vec_id")
    return D.banded_sample(held, [("high", 0.4, 2, 20), ("middle", 0.35, 0.4, 20), ("low", 0.3, 0.35, 20)]).select("left_id", "right_id", "band", "rank")


@register("topk_pairs", f"SELECT a.vec_id AS left_id, b.vec_id AS right_id, round({_DOT}, 5) AS cosine FROM embeddings a JOIN embeddings b ON a.vec_id < b.vec_id ORDER BY {_DOT} DESC, 1, 2 LIMIT 50")
def topk_pairs(spark: SparkSession, d: str) -> DataFrame:
    pairs = J.cosine_pairs(table(spark, d, "embeddings"), "embedding", "vec_id", float("-inf"), best=50)
    return pairs.orderBy(F.desc("cosine"), "left_id", "right_id").limit(50).select("left_id", "right_id", F.round("cosine", 5).alias("cosine"))


@register("nearest_existing", f"SELECT a.vec_id, round(max({_DOT}), 5) AS similarity FROM embeddings a, embeddings b WHERE a.label <> 0 AND b.label = 0 GROUP BY a.vec_id")
def nearest_existing(spark: SparkSession, d: str) -> DataFrame:
    """The existing set is all of label 0."""
    e = table(spark, d, "embeddings")
    found = J.nearest_existing(e.where("label <> 0"), e.where("label = 0"), "embedding", "vec_id")
    return found.select("vec_id", F.round("similarity", 5).alias("similarity"))


@register(
    "connected_components",
    f"""
    WITH RECURSIVE e AS (SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id WHERE {_DOT} >= 0.4),
    r AS (SELECT x AS node, x AS root FROM e UNION SELECT e.y, r.root FROM r JOIN e ON r.node = e.x)
    SELECT node, min(root) AS root FROM r GROUP BY node
    """,
)
def connected_components(spark: SparkSession, d: str) -> DataFrame:
    """Equal vectors are linked to their first, which alone is compared with others."""
    vectors = table(spark, d, "embeddings").where("embedding IS NOT NULL").select("vec_id", "embedding")
    copies = J.class_pairs(vectors.where(S.dot("embedding", "embedding") >= 0.4), "embedding", "vec_id")
    first = vectors.groupBy("embedding").agg(F.min("vec_id").alias("vec_id"))
    pairs = J.cosine_pairs(first, "embedding", "vec_id", 0.4).select("left_id", "right_id").unionByName(copies)
    return components(pairs.select(F.col("left_id").alias("a"), F.col("right_id").alias("b")))


@register(
    "duplicate_groups",
    """
    WITH g AS (SELECT text, count(*) AS members, arg_min(doc_id, sha256('20260826' || chr(31) || doc_id)) AS representative, 'duplicate-' || substr(sha256(array_to_string(list_sort(list(doc_id::VARCHAR)), chr(31))), 1, 20) AS group_id FROM documents GROUP BY text)
    SELECT doc_id, members, representative, group_id, doc_id = representative AS is_kept FROM documents JOIN g USING (text)
    """,
)
def duplicate_groups(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("k"))
    return D.duplicate_groups(docs, J.class_pairs(docs, "k", "doc_id"), "doc_id").select("doc_id", "members", "representative", "group_id", "is_kept")


@register(
    "signalled_pairs",
    """
    WITH p AS (SELECT min(doc_id) OVER (PARTITION BY text) AS l, doc_id AS r, 'source_sha256' AS s FROM documents WHERE text IS NOT NULL
    UNION ALL SELECT min(doc_id) OVER (PARTITION BY source, n_chars), doc_id, 'phash' FROM documents WHERE source IS NOT NULL AND n_chars IS NOT NULL)
    SELECT l AS left_id, r AS right_id, string_agg(s, ';' ORDER BY s) AS signals FROM p WHERE l < r GROUP BY l, r
    """,
)
def signalled_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Each signal links a row to its class's first, not all rows of a class to each other."""
    docs = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("k"), F.concat("source", F.lit(":"), F.col("n_chars").cast("string")).alias("h"))
    return D.signalled({"source_sha256": J.class_pairs(docs, "k", "doc_id"), "phash": J.class_pairs(docs, "h", "doc_id")})


@register("calibration_sample")
def calibration_sample(spark: SparkSession, d: str) -> DataFrame:
    return D.calibration_sample(table(spark, d, "embeddings"), "embedding", "vec_id", [("high", 0.4, 2, 8), ("middle", 0.35, 0.4, 8), ("low", 0.3, 0.35, 4)], 40)


def _kcenter_sql(count: int) -> str:
    """Step by step: c, the choice of each label, and s, the rows left with their largest similarity to all chosen."""
    parts = ["s0 AS MATERIALIZED (SELECT vec_id AS id, label, embedding::DOUBLE[] AS v, sha256('20260826' || chr(31) || vec_id) AS r, '-infinity'::DOUBLE AS near FROM embeddings)"]
    for k in range(count):
        parts += [
            f"c{k} AS MATERIALIZED (SELECT * FROM s{k} QUALIFY row_number() OVER (PARTITION BY label ORDER BY near, r) = 1)",
            f"s{k + 1} AS MATERIALIZED (SELECT s.* REPLACE (greatest(s.near, list_dot_product(s.v, c.v)) AS near) FROM s{k} s JOIN c{k} c ON s.label = c.label WHERE s.id <> c.id)",
        ]
    return f"WITH {', '.join(parts)} {' UNION ALL '.join(f'SELECT label, id AS vec_id, {k + 1} AS position FROM c{k}' for k in range(count))}"


@register("kcenter_select", _kcenter_sql(8))
def kcenter_select(spark: SparkSession, d: str) -> DataFrame:
    """The farthest-first choice within each label."""
    return diverse(table(spark, d, "embeddings"), "embedding", "vec_id", 8, by=["label"])


def _resamples(value: str, number: int) -> str:
    """SQL: m(resample, mean), the mean of a value of labels in resamples of documents' sources."""
    drawn = " + ".join(f"(u >= {step!r}::DOUBLE)::INT" for step in poisson_steps())
    return f"""
    g AS (SELECT source, sum({value}) AS s, count(*) AS c FROM labels JOIN documents USING (doc_id) WHERE ({value}) IS NOT NULL GROUP BY source),
    u AS (SELECT resample, s, c, ('0x' || substr(sha256('20260915' || chr(31) || coalesce(source, '') || chr(31) || resample), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u FROM g, range({number}) r(resample)),
    w AS (SELECT resample, s, c, {drawn} AS n FROM u),
    m AS (SELECT resample::INT AS resample, (sum(n * s) / nullif(sum(n * c), 0))::DOUBLE AS mean FROM w GROUP BY resample)"""


@register("group_bootstrap", f"WITH {_resamples('quality', 50)} SELECT resample, round(mean, 9) AS mean FROM m")
def group_bootstrap(spark: SparkSession, d: str) -> DataFrame:
    means = bootstrap(table(spark, d, "labels").join(table(spark, d, "documents"), "doc_id"), "source", F.col("quality").cast("double"), 50)
    return means.select("resample", F.round("mean", 9).alias("mean"))


@register("paired_bootstrap", f"WITH {_resamples('quality - toxic', 10_000)} SELECT round((SELECT sum(s) / sum(c) FROM g), 9) AS difference, round(quantile_cont(mean, 0.025), 9) AS low, round(quantile_cont(mean, 0.975), 9) AS high, count(mean) AS resamples FROM m")
def paired_differences(spark: SparkSession, d: str) -> DataFrame:
    """How much likelier a good label is than a toxic one, with bounds over resampled sources."""
    rows = table(spark, d, "labels").join(table(spark, d, "documents").select("doc_id", "source"), "doc_id")
    found = paired_bootstrap(rows, "source", F.col("quality"), F.col("toxic"))
    return found.select(*[F.round(c, 9).alias(c) for c in ("difference", "low", "high")], "resamples")


_COMPOSED = """
    WITH r AS (SELECT doc_id, sha256(text) AS source_sha256, sha256(lower(trim(text))) AS decoded_sha256 FROM documents WHERE doc_id IS NOT NULL),
    v AS (SELECT vec_id, embedding::DOUBLE[] AS v, CASE WHEN vec_id % 97 = 3 THEN 'second' ELSE 'first' END AS m FROM embeddings WHERE vec_id IN (SELECT doc_id FROM r) AND embedding IS NOT NULL)
"""


@register(
    "composition_audit",
    f"""{_COMPOSED}
    SELECT 'duplicate_source_sha256' AS kind, (min(doc_id) OVER (PARTITION BY source_sha256))::VARCHAR AS "left", doc_id::VARCHAR AS "right" FROM r WHERE source_sha256 IS NOT NULL QUALIFY doc_id > min(doc_id) OVER (PARTITION BY source_sha256)
    UNION ALL SELECT 'duplicate_decoded_sha256', (min(doc_id) OVER (PARTITION BY decoded_sha256))::VARCHAR, doc_id::VARCHAR FROM r WHERE decoded_sha256 IS NOT NULL QUALIFY doc_id > min(doc_id) OVER (PARTITION BY decoded_sha256)
    UNION ALL SELECT 'missing_vector', doc_id::VARCHAR, NULL FROM r WHERE doc_id NOT IN (SELECT vec_id FROM v)
    UNION ALL SELECT 'several_models', vec_id::VARCHAR, m FROM v WHERE m = 'second'
    UNION ALL SELECT DISTINCT 'similar', a.vec_id::VARCHAR, b.vec_id::VARCHAR FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_dot_product(a.v, b.v) >= 0.4
    """,
)
def composition_audit(spark: SparkSession, d: str) -> DataFrame:
    """The composition is all documents; the vectors of their ids come from two models."""
    rows = table(spark, d, "documents").select("doc_id", F.sha2("text", 256).alias("source_sha256"), F.sha2(F.lower(F.trim("text")), 256).alias("decoded_sha256"))
    vectors = table(spark, d, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding", F.when(F.col("vec_id") % 97 == 3, "second").otherwise("first").alias("model"))
    return D.composition_faults(rows, vectors, "doc_id", ["source_sha256", "decoded_sha256"], least=0.4)


@register(
    "perceptual_candidates",
    "WITH h AS (SELECT doc_id, ('0x' || substr(sha256(text), 1, 15))::BIGINT & 1152921504606846975 AS b FROM documents WHERE text IS NOT NULL), k AS (SELECT b, count(*) AS n FROM h GROUP BY b) SELECT coalesce((SELECT sum(n * (n - 1) // 2) FROM k), 0)::BIGINT + coalesce((SELECT sum(x.n * y.n) FROM k x JOIN k y ON x.b < y.b WHERE bit_count(xor(x.b, y.b)) <= 6), 0)::BIGINT AS candidates",
)
def perceptual_candidates(spark: SparkSession, d: str) -> DataFrame:
    bits = table(spark, d, "documents").select("doc_id", F.conv(F.substring(F.sha2("text", 256), 1, 15), 16, 10).cast("bigint").alias("b"))
    return D.perceptual_candidates(bits, "b", "doc_id", 6, 60)
