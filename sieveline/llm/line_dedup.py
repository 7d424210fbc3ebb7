"""Line dedup: drop lines that many documents share, from all but one of them.

Lines are exploded with their position, normalised and hashed to 128 bits; the
hashes are counted by distinct document with partial aggregation before the
shuffle, and only the positions to drop travel back to the documents. Texts are
joined once, by document; no group of lines is ever gathered. A document is
reassembled by position in one pass over its lines: the positions to drop become
a mask that is zipped with them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.llm.common import ASCII_SPACE, ascii_lower, fresh, replacing, stored
from sieveline.operators.joins import redealt


def line_key(line: Column) -> Column:
    """The line without ASCII white space at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(ASCII_SPACE)))


def mask(drops: Column) -> Column:
    """Ascending positions as booleans: false at each of them and true before, up to the last."""
    before = F.slice(F.concat(F.array(F.lit(-1)), drops), F.lit(1), F.size(drops))
    return F.flatten(F.zip_with(drops, before, lambda at, last: F.concat(F.array_repeat(F.lit(True), at - last - 1), F.array(F.lit(False)))))


def drop_repeated_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_docs: int = 3, min_chars: int = 20) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped`` and ``kept_text``.

    A key of at least ``min_chars`` code points found in at least ``min_docs``
    distinct documents loses all its lines but those in the largest id holding
    it. Null or empty text: one empty line, kept. A row with a null id counts as
    no document; its lines of a dropped key go. Rows that repeat an id count as
    one document. An empty table gives no rows. Work on a document is in
    proportion to its lines. All input columns stay, but for those named like an output.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    base = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("row"), F.split(text, "\n").alias("lines"))
    lines = base.select("id", "row", F.posexplode("lines").alias("pos", "line")).withColumn("key", line_key(F.col("line"))).where(F.char_length("key") >= min_chars)
    lines = lines.select("id", "row", "pos", F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"))
    lines = stored(lines, "lines")  # read twice below; the texts are not
    common = lines.groupBy("h1", "h2").agg(F.count_distinct("id").alias("n"), F.max("id").alias("last")).where(F.col("n") >= min_docs).drop("n")
    common = redealt(common)  # a line that a third of the documents hold is then split
    did, drow, drop, own_id, own_text, own_row = fresh(docs.columns, "__did", "__drow", "__drop", "__id", "__text", "__row")
    drops = (
        lines.join(common, ["h1", "h2"])
        .where(F.col("id").isNull() | (F.col("id") < F.col("last")))
        .groupBy("id", "row")
        .agg(F.array_sort(F.collect_set("pos")).alias("drop"))
        .toDF(did, drow, drop)
    )
    whole = docs.withColumns({own_id: F.col(f"`{id_col}`"), own_text: text, own_row: F.xxhash64(text)})
    joined = whole.join(drops, F.col(own_id).eqNullSafe(F.col(did)) & (F.col(own_row) == F.col(drow)), "left")
    split = F.split(own_text, "\n")
    left = F.zip_with(split, mask(F.col(drop)), lambda line, stays: F.when(F.coalesce(stays, F.lit(True)), line))
    kept = F.when(F.col(drop).isNull(), F.col(own_text)).otherwise(F.array_join(left, "\n"))  # which leaves nulls out
    result = replacing(joined, n_lines=F.size(split).cast("long"), n_dropped=F.coalesce(F.size(drop), F.lit(0)).cast("long"), kept_text=kept)
    return result.drop(own_id, own_text, own_row, did, drow, drop)
