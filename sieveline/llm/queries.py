"""The queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(sql: str | None = None):
    def keep(function):
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return keep


@_query(
    """
    WITH lines AS (
      SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
             generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
      FROM documents),
    keyed AS (
      SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
    common AS (
      SELECT k, max(doc_id) AS last FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
    marked AS (SELECT keyed.*, common.last IS NOT NULL AND doc_id < common.last AS dropped FROM keyed LEFT JOIN common USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
    FROM marked GROUP BY doc_id
    """
)
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.line_dedup import drop_repeated_lines

    return drop_repeated_lines(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


_WORDS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""
_SHINGLES = f"""
    WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
    b AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
    di AS (SELECT DISTINCT doc_id, array_to_string(w[i:i+4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d)),
    bi AS (SELECT DISTINCT item_id, array_to_string(w[i:i+least(len(w), 5)-1], ' ') AS s, least(len(w), 5) AS k FROM (SELECT item_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM b WHERE len(w) > 0)),
    n AS (SELECT item_id, count(*) AS n_item FROM bi GROUP BY item_id)
"""


@_query(
    _SHINGLES
    + """
    SELECT doc_id, item_id, count(*) AS n_shared, n_item, count(*) / n_item AS containment
    FROM di JOIN bi USING (s) JOIN n USING (item_id) WHERE k = 5
    GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item
    """
)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.decontaminate import contaminated

    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query()
def op2_token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.binary_ids import round_trip

    return round_trip(table(spark, sf_dir, "documents"))


@_query()
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"))


@_query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


@_query()
def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.quality import score_quality

    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query()
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.toxicity import score_toxicity

    return score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@_query()
def op5_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


#: The contract's rules (host, path, verdict).
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@_query()
def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.url_rules import judge_urls

    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@_query(
    """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
    newest AS (SELECT html, max(page_id) AS newest FROM p WHERE payload_bytes >= 1000 GROUP BY html)
    SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
           CASE WHEN newest <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN newest <> page_id THEN newest END AS refers_to
    FROM p LEFT JOIN newest USING (html)
    """
)
def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.warc import round_trip

    return round_trip(table(spark, sf_dir, "pages"))


@_query(
    """
    WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    piece AS (SELECT doc_id, q, substr(x, 2 * q + 1, 2398) AS y FROM (SELECT doc_id, x, unnest(range(0, greatest(0, length(x) // 2 - 199), 1000)) AS q FROM d)),
    strings AS (SELECT doc_id, q + j AS p, md5(substr(y, 2 * j + 1, 400)) AS s FROM (SELECT doc_id, q, y, unnest(range(0, least(1000, length(y) // 2 - 199))) AS j FROM piece)),
    often AS (SELECT s FROM strings GROUP BY s HAVING count(*) > 1),
    hit AS (SELECT doc_id, p, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM strings JOIN often USING (s)),
    run AS (SELECT doc_id, p, sum(CASE WHEN gap <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM hit),
    span AS (SELECT doc_id, r, min(p) AS a, max(p) + 200 AS b FROM run GROUP BY doc_id, r),
    edge AS (SELECT doc_id, r, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY r), 0) AS last FROM span),
    part AS (SELECT doc_id, r, a, b, substr(x, 2 * last + 1, 2 * (a - last)) AS k FROM edge JOIN d USING (doc_id)),
    cut AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(k, '' ORDER BY r) AS k FROM part GROUP BY doc_id)
    SELECT doc_id, length(x) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
           sha256(unhex(coalesce(k, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
    FROM d LEFT JOIN cut USING (doc_id)
    """
)
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.suffixes import drop_repeated_strings

    kept = drop_repeated_strings(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@_query(
    """
    WITH v AS (
      SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS l,
             list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
      FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (
      SELECT a.id AS anchor_id, b.id AS id, a.l = b.l AS same,
             list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS score
      FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
    p AS (
      SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank,
           id AS negative_id, CAST(positive_score AS BIGINT) AS positive_score, CAST(score AS BIGINT) AS negative_score
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) <= 10
    """
)
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.negatives import hard_negatives

    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


def _tree_sql(levels: int = 16) -> str:
    """The trees of sources and of all, so many levels high at most (3**16 leaves)."""
    f = lambda c, v=None: f"coalesce(CAST(strlen(CAST({v or c} AS VARCHAR)) AS VARCHAR) || ':' || CAST({v or c} AS VARCHAR), '-')"
    text = "CASE WHEN crc % 2 = 0 THEN replace(text, chr(10), '') ELSE text END"
    leaf = lambda t: "sha256(" + " || ".join([*map(f, ("doc_id", "source", "lang", "n_chars")), f("text", t)]) + ")"

    def climb(name: str, start: str, group: str) -> str:
        parts = [f"{name}0 AS ({start})"]
        for k in range(levels):
            run = f"OVER (PARTITION BY {group}, i // 3 ORDER BY i"
            parts += [
                f"{name}s{k} AS (SELECT {group}, i, h, n, coalesce(string_agg(h, '') {run} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l, coalesce(string_agg(h, '') {run} ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r FROM {name}{k})",
                f"{name}{k + 1} AS (SELECT {group}, CASE WHEN n = 1 THEN 0 ELSE i // 3 END AS i, CASE WHEN n = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h, (n + 2) // 3 AS n FROM {name}{k} GROUP BY {group}, CASE WHEN n = 1 THEN 0 ELSE i // 3 END, n)",
            ]
        return ", ".join(parts)

    def fold(name: str, start: str, tree: str, group: str) -> str:
        parts = [f"{name}0 AS ({start})"]
        for k in range(levels):
            keep = f"CASE WHEN s.n = 1 THEN p.{{0}} ELSE {{1}} END AS {{0}}"
            parts.append(
                f"{name}{k + 1} AS (SELECT p.doc_id, p.leaf, p.grp, p.top, p.at // 3 AS at, {keep.format('fold', 'sha256(s.l || p.fold || s.r)')}, {keep.format('proof', 'p.proof || s.l || s.r')} FROM {name}{k} p JOIN {tree}s{k} s ON p.{group} = s.{group} AND s.i = p.at)"
            )
        return ", ".join(parts)

    return f"""
    WITH c AS (SELECT *, {_crc_sql('CAST(doc_id AS VARCHAR)')} AS crc FROM documents),
    leaves AS (SELECT doc_id, coalesce('+' || source, '') AS grp, {leaf('text')} AS leaf, {leaf(text)} AS other FROM c),
    placed AS (SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY grp) AS n, 0 AS top FROM leaves),
    {climb('t', 'SELECT grp, i, leaf AS h, n FROM placed', 'grp')},
    subroots AS (SELECT grp, h, row_number() OVER (ORDER BY encode(grp)) - 1 AS i, count(*) OVER () AS n, 0 AS top FROM t{levels}),
    {climb('u', 'SELECT top, i, h, n FROM subroots', 'top')},
    {fold('p', "SELECT doc_id, leaf, grp, top, i AS at, other AS fold, '' AS proof FROM placed", 't', 'grp')},
    {fold('q', f'SELECT p.doc_id, p.leaf, p.grp, p.top, s.i AS at, p.fold, p.proof FROM p{levels} p JOIN subroots s USING (grp)', 'u', 'top')}
    SELECT q.doc_id, q.leaf, s.h AS subroot, u.h AS root, sha256(q.proof) AS proof_sha256, q.fold AS folded_root, q.fold = u.h AS verified
    FROM q{levels} q JOIN subroots s USING (grp) CROSS JOIN u{levels} u
    """


def _crc_sql(text: str) -> str:
    """Unsigned crc32 of ASCII text, bit by bit: the reversed polynomial 0xEDB88320."""
    step = "list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, {})"
    byte = step.format("xor(c, CAST(ascii(b) AS BIGINT))")
    return f"xor(list_reduce(string_split({text}, ''), lambda c, b: {byte}, CAST(4294967295 AS BIGINT)), 4294967295)"


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from sieveline.llm.merkle import manifest

    docs = table(spark, sf_dir, "documents")
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False))
    text = F.when(touched, F.translate("text", "\n", "")).otherwise(F.col("text"))
    return manifest(docs, ["doc_id", "source", "lang", "n_chars", "text"], changed={"text": text}).withColumnRenamed("proof", "proof_sha256")


_query(_tree_sql())(op13_merkle_manifest)
