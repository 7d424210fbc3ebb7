"""What a session needs before it runs the library's queries."""

from __future__ import annotations

import io
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_shipped: set[str] = set()
_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session doesn't name one, a local session (tests) gets a temporary
    folder. On a cluster that is an error, as executors wouldn't see each other's files.
    """
    global _own_dir
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if _own_dir is None:
        if not (spark.sparkContext.master.startswith("local[") or spark.sparkContext.master == "local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        _own_dir = "file://" + tempfile.mkdtemp(prefix="sieveline-")
    spark.sparkContext.setCheckpointDir(_own_dir)
    return _own_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back, for what several jobs read: the same
    rows in each of them, also after an executor is lost."""
    return written_at(df, name)[0]


def written_at(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``written``, and the folder, for what ``removed`` takes away as soon as it has been read."""
    path = f"{shared_dir(df.sparkSession)}/sieveline/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ship(spark: SparkSession) -> SparkSession:
    """Give the workers this package, once for each application."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).parent
        held = io.BytesIO()
        with zipfile.ZipFile(held, "w") as package:
            for path in sorted(root.rglob("*.py")):
                package.write(path, path.relative_to(root.parent))
        folder = os.path.realpath(tempfile.mkdtemp(prefix="package-"))
        Path(folder, "sieveline.zip").write_bytes(held.getvalue())
        context.addPyFile(f"{folder}/sieveline.zip")
        _shipped.add(context.applicationId)
    return spark
