"""Merkle manifest of a dataset: a digest for each row, each source and the whole, with proofs.

Leaves are hashed in the JVM and numbered within their source without a task that holds it:
they are dealt by range of (source, id), and what lies before a partition comes from
counts. ``BUCKET`` consecutive leaves, a power of ``FAN``, are an aligned bucket, so that
no run of the tree crosses it. Tasks load whole buckets into a DuckDB of their own, as
Arrow tables, where one query a level joins the runs' digests (an ordered string_agg),
hashes them (sha256) and another keeps what stands on either side of each leaf. The buckets' roots are the leaves of the next tier,
BUCKET times smaller, and go the same way until a source has one; the sources' subroots
make the last tree. Spark joins what lies above a bucket to its leaves, and folds it on.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.common import stored
from sieveline.operators.joins import redealt

#: Children of a node, levels of a bucket, leaves of a range partition, and least rows of a DuckDB block.
FAN, LEVELS, PART, BLOCK = 3, 8, 400_000, 20_000

SIDES = "array<struct<left:string,right:string>>"
NONE = f"cast(array() AS {SIDES})"


def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 bytes' count, ``:`` and the bytes."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with ``pos``, from 0 within the group in the given order, and ``total``, the
    group's rows. A group may be any share of the rows: it fills as many range partitions as it takes."""
    parts = max(1, -(-rows.count() // PART))
    dealt = rows.repartitionByRange(parts, group, *order).sortWithinPartitions(group, *order)
    # ids grow along the partitions, so they are the order; written, they are the same in each later reading
    held = stored(dealt.withColumn("_at", F.monotonically_increasing_id()), "merkle-order").withColumn("_part", F.shiftright("_at", 33))
    counts = held.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    along = Window.partitionBy(group).orderBy("_part")
    before = counts.select(F.col(group).alias("_g"), F.col("_part").alias("_p"), "_first", (F.sum("_n").over(along) - F.col("_n")).alias("_before"), F.sum("_n").over(Window.partitionBy(group)).alias("total"))
    met = held.join(redealt(before), F.col(group).eqNullSafe(F.col("_g")) & (F.col("_part") == F.col("_p")))
    return met.withColumn("pos", F.col("_before") + F.col("_at") - F.col("_first")).drop("_g", "_p", "_at", "_part", "_first", "_before")


def _blocks(batches: Iterator[pa.RecordBatch], key: list[str], least: int) -> Iterator[pa.Table]:
    """Tables of whole buckets, of rows that come bucket by bucket."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = list(zip(*[batch.column(c).to_pylist() for c in key], strict=True))
        start = 0
        for i in range(batch.num_rows):
            last = keys[i - 1] if i else (tuple(held[-1].column(c)[-1].as_py() for c in key) if held else None)
            if last is not None and keys[i] != last and sum(b.num_rows for b in held) + i - start >= least:
                yield pa.Table.from_batches([*held, batch.slice(start, i - start)])
                held, start = [], i
        if batch.num_rows > start:
            held.append(batch.slice(start))
    if held:
        yield pa.Table.from_batches(held)


def climb(nodes: DataFrame, levels: int, fan: int, sides: bool) -> DataFrame:
    """One tier. Of nodes (grp, pos, single: whether its group fits one bucket, node, ...) the
    buckets' roots (grp, pos, node), or with ``sides`` every node's row and an array of (left,
    right), the digests on either side of its path at each level up to the bucket's root.

    A bucket without others stops where one node is left; others climb all levels, a lone node too."""
    width = fan**levels
    columns = [f.name for f in nodes.schema]
    kinds = {f.name: pa.bool_() if f.dataType.typeName() == "boolean" else pa.int64() if f.dataType.typeName() == "long" else pa.string() for f in nodes.schema}
    pair = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    shape = pa.schema([*kinds.items(), ("sides", pair)] if sides else [("grp", pa.string()), ("pos", pa.int64()), ("node", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import duckdb

        for block in _blocks(batches, ["grp", "bucket"], BLOCK):
            con = duckdb.connect(config={"threads": 1, "memory_limit": "600MB"})
            try:
                con.register("block", block)
                con.execute("CREATE TABLE bucket AS SELECT grp, bucket, row_number() OVER () AS b FROM (SELECT DISTINCT grp, bucket FROM block)")
                con.execute(f"CREATE TABLE leaf AS SELECT b.b, t.pos % {width} AS i, t.* FROM block t JOIN bucket b ON t.grp IS NOT DISTINCT FROM b.grp AND t.bucket = b.bucket")
                con.execute("CREATE TABLE level AS SELECT b, i, single, node AS h FROM leaf")
                if sides:
                    con.execute('CREATE TABLE path AS SELECT b, i, i AS at, [] :: STRUCT("left" VARCHAR, "right" VARCHAR)[] AS sides FROM leaf')
                for _ in range(levels):
                    con.execute("CREATE OR REPLACE TABLE going AS SELECT b, NOT (bool_and(single) AND count(*) = 1) AS go FROM level GROUP BY b")
                    con.execute(f"CREATE OR REPLACE TABLE run AS SELECT b, i // {fan} AS i, bool_and(single) AS single, string_agg(h, '' ORDER BY i) AS cat FROM level JOIN going USING (b) WHERE go GROUP BY b, i // {fan}")
                    if sides:
                        con.execute(
                            f"CREATE OR REPLACE TABLE path AS SELECT p.b, p.i, CASE WHEN cat IS NULL THEN p.at ELSE p.at // {fan} END AS at, "
                            f"CASE WHEN cat IS NULL THEN sides ELSE list_append(sides, {{'left': cat[:(p.at % {fan}) * 64], 'right': cat[(p.at % {fan}) * 64 + 65:]}}) END AS sides "
                            f"FROM path p LEFT JOIN run ON run.b = p.b AND run.i = p.at // {fan}"
                        )
                    con.execute("CREATE OR REPLACE TABLE level AS SELECT b, i, single, sha256(cat) AS h FROM run UNION ALL SELECT b, i, single, h FROM level JOIN going USING (b) WHERE NOT go")
                if sides:
                    found = con.sql(f"SELECT {', '.join(f'leaf.{c}' for c in columns)}, sides FROM leaf JOIN path USING (b, i)")
                else:
                    found = con.sql("SELECT bucket.grp, bucket.bucket AS pos, h AS node FROM level JOIN bucket USING (b)")
                yield from found.to_arrow_table().cast(shape).to_batches(max_chunksize=2000)
            finally:
                con.close()

    cut = nodes.withColumn("bucket", F.floor(F.col("pos") / width).cast("long")).repartition("grp", "bucket").sortWithinPartitions("grp", "bucket")
    return cut.mapInArrow(run, ", ".join([*[f"{f.name} {f.dataType.simpleString()}" for f in nodes.schema], f"sides {SIDES}"]) if sides else "grp string, pos long, node string")


class Trees:
    """A tree for each group of ``nodes`` (grp, pos, single, node, ...), tier by tier.

    ``roots``: grp, root. ``above``: what lies above each bucket of the rows. ``nodes_with_sides``:
    the rows with all that stands beside their paths.
    Each tier has a bucket's fraction of the rows before, so three of them hold 10**11."""

    def __init__(self, nodes: DataFrame, levels: int = LEVELS, fan: int = FAN):
        self.levels, self.fan, self.tiers = levels, fan, [nodes]
        self.roots = None
        while True:
            tops = stored(climb(self.tiers[-1], levels, fan, False), "merkle-roots")
            self.tops = tops if len(self.tiers) == 1 else self.tops
            sizes = redealt(tops.groupBy("grp").agg(F.count("*").alias("n")))
            known = tops.alias("t").join(sizes.alias("s"), F.expr("t.grp <=> s.grp")).selectExpr("t.grp", "t.pos", f"s.n <= {fan**levels} AS single", "t.node", "s.n")
            done = known.where("n = 1").selectExpr("grp", "node AS root")
            self.roots = done if self.roots is None else self.roots.unionByName(done)
            more = stored(known.where("n > 1").drop("n"), "merkle-tier")
            if more.isEmpty():
                break
            self.tiers.append(more)

    def above(self) -> DataFrame:
        """grp, pos and sides of the first tier's buckets: what stands beside their paths up to the root."""
        up = None
        for tier in reversed(self.tiers[1:]):
            own = climb(tier, self.levels, self.fan, True)
            up = stored((own if up is None else self.joined(own, up)).select("grp", "pos", "sides"), "merkle-sides")
        buckets = self.tops.select("grp", "pos")
        if up is None:
            return buckets.withColumn("sides", F.expr(NONE))
        met = buckets.alias("b").join(up.alias("u"), F.expr("b.grp <=> u.grp AND b.pos = u.pos"), "left")
        return met.select("b.grp", "b.pos", F.coalesce("u.sides", F.expr(NONE)).alias("sides"))

    def joined(self, rows: DataFrame, above: DataFrame) -> DataFrame:
        """Rows of a tier whose sides go on with those of their buckets, and the buckets' other columns."""
        up = above.withColumnsRenamed({"grp": "_g", "pos": "_b", "sides": "_up"})
        at = F.floor(F.col("pos") / self.fan**self.levels).cast("long")
        met = rows.join(up, F.col("grp").eqNullSafe(F.col("_g")) & (at == F.col("_b")), "left")
        return met.withColumn("sides", F.concat("sides", F.coalesce("_up", F.expr(NONE)))).drop("_g", "_b", "_up")

    def nodes_with_sides(self, above: DataFrame) -> DataFrame:
        return self.joined(climb(self.tiers[0], self.levels, self.fan, True), above)


def leaf_digest(values: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def manifest(docs: DataFrame, columns: list[str], *, id_col: str = "doc_id", group_col: str = "source", changed: dict[str, Column] | None = None, levels: int = LEVELS, fan: int = FAN) -> DataFrame:
    """Of each row: id_col, ``leaf`` (the digest of ``columns``), ``subroot`` of its group's tree,
    ``root`` of all, ``proof`` (digest of the siblings along its path, in their order),
    ``folded_root`` (what the path makes of the row with the ``changed`` columns) and ``verified``
    (whether that is the root).

    Leaves of a group ascend by id, nulls first, and rows that repeat an id by their
    digests; groups ascend bytewise, null first, as a group of its own beside the empty one.
    Every ``fan`` consecutive nodes, or what is left of them, are hashed to one until one is left; a lone
    leaf is its subroot. A null value counts as ``-``, so it differs from an empty one; whole texts
    are hashed, however long, in the JVM. An empty table gives no rows. Other columns take no part.
    """
    name = lambda c: F.col(f"`{c}`")
    new = changed or {}
    rows = docs.select(
        name(id_col).cast("long").alias("id"), name(group_col).cast("string").alias("grp"),
        leaf_digest([name(c) for c in columns]).alias("node"), leaf_digest([new.get(c, name(c)) for c in columns]).alias("other"),
    )
    width = fan**levels
    placed = numbered(stored(rows, "merkle-leaves"), "grp", ["id", "node", "other"])
    leaves = stored(placed.select("grp", "pos", (F.col("total") <= width).alias("single"), "node", "other", "id"), "merkle-nodes")
    trees = Trees(leaves, levels, fan)
    subroots = numbered(stored(trees.roots.withColumn("every", F.lit("")), "merkle-subroots"), "every", ["grp"])
    tops = stored(subroots.select(F.col("every").alias("grp"), "pos", (F.col("total") <= width).alias("single"), F.col("root").alias("node"), F.col("grp").alias("own")), "merkle-tops")
    whole = Trees(tops, levels, fan)
    last = whole.nodes_with_sides(whole.above()).join(whole.roots, "grp").select(F.col("own").alias("_own"), F.col("node").alias("subroot"), F.col("sides").alias("_last"), "root")
    # a bucket, not its group, is the key that leaves meet the upper trees by: no key has more rows than a bucket
    above = trees.above().join(stored(last, "merkle-last"), F.col("grp").eqNullSafe(F.col("_own"))).withColumn("sides", F.concat("sides", "_last")).drop("_own", "_last")
    met = trees.nodes_with_sides(stored(above, "merkle-above"))
    folded = F.aggregate("sides", F.col("other"), lambda digest, side: F.sha2(F.concat(side["left"], digest, side["right"]).cast("binary"), 256))
    proof = F.sha2(F.array_join(F.transform("sides", lambda side: F.concat(side["left"], side["right"])), "").cast("binary"), 256)
    out = met.select(F.col("id").alias(id_col), F.col("node").alias("leaf"), "subroot", "root", proof.alias("proof"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
