"""What the operators of this subpackage share: scratch tables and column hygiene."""

from __future__ import annotations

import atexit
import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.session import shared_dir

#: ASCII white space as the contracts define it: [\x20\x09-\x0D].
ASCII_SPACE = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

#: Rows of a batch that goes to a Python worker.
BATCH_ROWS = 1000

_scratch: list[tuple[SparkSession, str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder. What results were derived from must outlive them, so
    it is removed by ``sweep``, at the latest when the driver's Python ends."""
    if not _scratch:
        atexit.register(sweep)
    path = f"{shared_dir(spark)}/sieveline/{name}-{uuid.uuid4().hex}"
    _scratch.append((spark, path))
    return path


def sweep() -> None:
    """Remove every scratch table made so far; only for callers that have written
    out whatever was derived from them."""
    while _scratch:
        spark, name = _scratch.pop()
        try:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jvm.org.apache.hadoop.conf.Configuration()).delete(path, True)
        except (OSError, TypeError, Py4JError):  # the JVM went first
            return


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Arrow batches of BATCH_ROWS rows at most while a job runs: 10,000 long texts in a
    batch take gigabytes on both sides. The session's own setting comes back after it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    own = spark.conf.get(key)
    if not 0 < int(own) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(key, own)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its lineage is cut, and
    an executor that is lost later takes no part of it along. Python operators in
    it get small batches."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    with small_batches(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """``names``, each with as many lines before it as it takes to differ from all ``columns``,
    in any case: helper columns beside columns that the caller named."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def without(docs: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """``docs`` without the rows of the ids (first column of ``ids``); null ids stay, and so do all columns."""
    (gone,) = fresh(docs.columns, "__gone")
    return docs.join(ids.toDF(gone), F.col(f"`{id_col}`") == F.col(gone), "left_anti")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else. (``lower`` does that to ASCII text, and faster.)"""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5 (a null id: no)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def replacing(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with ``columns`` set; input columns of the same name, in any case,
    give way to them."""
    taken = {name.lower() for name in columns}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c.lower() not in taken], *[c.alias(n) for n, c in columns.items()])
