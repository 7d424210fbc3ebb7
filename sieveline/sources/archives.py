"""Archives of vectors as a data source of Spark: read by ranges, published whole.

A folder holds NPZ archives of ``identities`` and ``embeddings``. Tasks write archives of bounded
size under a folder of their job; the commit checks that all are there and then publishes them with
one manifest, which names every archive with its rows, bytes and digest. Readers of a published folder see what
the manifest names and nothing else, so a failed job or a second attempt of a task never shows. A
folder without a manifest is read as it is, archive by archive.

Planning reads the manifest or lists the folder; it opens no archive. Members that aren't compressed
are read by ranges of rows, so one archive may be split over several tasks.
"""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

MANIFEST = "_manifest.json"
SCHEMA = "identity string, embedding array<float>, archive string, position long, reason_code string"
ARROW = pa.schema([("identity", pa.string()), ("embedding", pa.list_(pa.float32())), ("archive", pa.string()), ("position", pa.int64()), ("reason_code", pa.string())])
#: Rows that a task hands on at once, and bytes that it reads at once for a digest.
BATCH_ROWS, CHUNK = 1024, 4 << 20
#: An archive is closed at so many bytes of vectors, whatever its rows.
ARCHIVE_BYTES = 64 << 20


class Damaged(ValueError):
    """Why an archive can't be read: its reason code."""


class Rows(NamedTuple):
    """Rows of an archive; without an end, all of them and what the archive itself says."""

    archive: str
    start: int = 0
    end: int | None = None
    digest: str | None = None


@dataclass
class Files(WriterCommitMessage):
    """The archives that one task wrote."""

    archives: list[dict]


def located(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system and the path within it. Paths have been qualified on the driver."""
    head, _, tail = path.partition(":")
    return pafs.FileSystem.from_uri(f"{head}://{tail}" if tail.startswith("/") and not tail.startswith("//") else path)


def qualified(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark itself would give it."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(target).toString()


def _listed(fs: pafs.FileSystem, root: str) -> list[str]:
    found = fs.get_file_info(pafs.FileSelector(root, recursive=True))
    return sorted(i.path[len(root) :].lstrip("/") for i in found if i.type == pafs.FileType.File and i.path.endswith(".npz"))


def _manifest(fs: pafs.FileSystem, root: str) -> list[dict] | None:
    if fs.get_file_info(f"{root}/{MANIFEST}").type != pafs.FileType.File:
        return None
    with fs.open_input_stream(f"{root}/{MANIFEST}") as f:
        return json.loads(f.read())["archives"]


def _digest(fs: pafs.FileSystem, path: str) -> str:
    found = hashlib.sha256()
    with fs.open_input_stream(path) as f:
        while piece := f.read(CHUNK):
            found.update(piece)
    return found.hexdigest()


class Member:
    """An array of an archive, read row by row from its start or from any row if it isn't compressed."""

    def __init__(self, archive: zipfile.ZipFile, name: str, dimensions: int):
        if name not in archive.namelist():
            raise Damaged("member_missing")
        self.stream = archive.open(name)
        version = np.lib.format.read_magic(self.stream)
        read = np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0
        shape, fortran, self.dtype = read(self.stream)
        if len(shape) != dimensions or self.dtype.hasobject or (fortran and dimensions > 1):
            raise Damaged("shape")
        self.rows, self.width = shape[0], int(np.prod(shape[1:], dtype=np.int64))
        self.row_bytes, self.head = self.dtype.itemsize * self.width, self.stream.tell()

    def seek(self, row: int) -> None:
        self.stream.seek(self.head + row * self.row_bytes)

    def next(self, rows: int) -> np.ndarray:
        held = self.stream.read(rows * self.row_bytes)
        if len(held) != rows * self.row_bytes:
            raise Damaged("archive_read_failed")
        return np.frombuffer(held, self.dtype).reshape(rows, self.width)


def vector_rows(fs: pafs.FileSystem, root: str, part: Rows) -> Iterator[pa.RecordBatch]:
    """The rows of a part, or one row with a reason where its archive is damaged.

    The reason comes after rows that were read before the damage was met.
    """
    path = f"{root}/{part.archive}"

    def batch(names, vectors, first, reasons) -> pa.RecordBatch:
        n = len(names)
        return pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(vectors, pa.list_(pa.float32())), pa.array([part.archive] * n), pa.array(range(first, first + n) if first is not None else [None] * n, pa.int64()), pa.array(reasons, pa.string())], schema=ARROW)

    try:
        if part.digest is not None and _digest(fs, path) != part.digest:
            raise Damaged("digest_mismatch")
        # a file for each member: a seek may go from where the file is, which the other member's reads would move
        with fs.open_input_file(path) as one, fs.open_input_file(path) as two, zipfile.ZipFile(one) as first, zipfile.ZipFile(two) as second:
            names, vectors = Member(first, "identities.npy", 1), Member(second, "embeddings.npy", 2)
            if names.rows != vectors.rows or vectors.dtype.kind not in "fiu" or names.dtype.kind not in "USiu":
                raise Damaged("shape")
            end = names.rows if part.end is None else part.end
            for member in (names, vectors):
                member.seek(part.start)
            for at in range(part.start, end, BATCH_ROWS):
                n = min(BATCH_ROWS, end - at)
                ids, matrix = names.next(n)[:, 0].astype(str), vectors.next(n).astype(np.float32)
                finite = np.isfinite(matrix).all(axis=1)
                yield batch(ids.tolist(), list(matrix), at, [None if f else "not_finite" for f in finite])
            if part.end is None:
                for member in (names, vectors):
                    member.stream.read(1)  # the end of a member is where its checksum is compared
    except Damaged as error:
        yield batch([None], [None], None, [str(error)])
    except (zipfile.BadZipFile, OSError, EOFError, ValueError, NotImplementedError, UnicodeDecodeError):
        yield batch([None], [None], None, ["archive_read_failed"])


class VectorReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.rows, self.verify = options["path"], int(options.get("rows_per_task", 65_536)), options.get("verify", "false").lower() == "true"

    def partitions(self) -> list[InputPartition]:
        fs, root = located(self.path)
        known = _manifest(fs, root)
        if known is None:
            return [InputPartition(Rows(a)) for a in _listed(fs, root)]
        parts = []
        for a in known:
            if self.verify or a["compressed"]:
                parts.append(Rows(a["archive"], digest=a["sha256"] if self.verify else None))
            else:
                parts += [Rows(a["archive"], i, min(i + self.rows, a["rows"])) for i in range(0, a["rows"], self.rows)]
        return [InputPartition(p) for p in parts]

    def read(self, partition: InputPartition | None) -> Iterator[pa.RecordBatch]:
        if partition is None:  # a plan without parts is one empty part
            return
        fs, root = located(self.path)
        yield from vector_rows(fs, root, partition.value)


class VectorWriter(DataSourceArrowWriter):
    """Archives of one task after the other, none of which shows before the commit."""

    def __init__(self, options: dict):
        self.path, self.rows = options["path"], int(options.get("rows_per_archive", 16_384))
        self.compressed, self.model = options.get("compressed", "false").lower() == "true", options.get("model", "")
        fs, root = located(self.path)
        if _manifest(fs, root) is not None:
            raise FileExistsError(f"{self.path} is published")
        self.job = f"job-{uuid.uuid4().hex}"

    def stored(self, names: list, vectors: list) -> dict:
        matrix = np.asarray(vectors, dtype=np.float32)
        held = io.BytesIO()
        (np.savez_compressed if self.compressed else np.savez)(held, identities=np.asarray(names, dtype=str), embeddings=matrix)
        content = held.getvalue()
        fs, root = located(self.path)
        name = f"{self.job}/{uuid.uuid4().hex}.npz"
        fs.create_dir(f"{root}/{self.job}", recursive=True)
        with fs.open_output_stream(f"{root}/{name}") as f:
            f.write(content)
        if _digest(fs, f"{root}/{name}") != hashlib.sha256(content).hexdigest():
            raise OSError(f"{name} reads back otherwise")
        return {"archive": name, "rows": len(names), "width": int(matrix.shape[1]), "bytes": len(content), "sha256": hashlib.sha256(content).hexdigest(), "compressed": self.compressed}

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        done, names, vectors, width = [], [], [], None
        for batch in iterator:
            for name, vector in zip(batch.column("identity").to_pylist(), batch.column("embedding").to_pylist(), strict=True):
                if name is None or not vector or None in vector or not np.isfinite(vector).all():
                    raise ValueError(f"the vector of {name!r} is not valid")
                if width is not None and len(vector) != width or len(names) >= self.rows or len(names) * len(vector) * 4 >= ARCHIVE_BYTES:
                    done.append(self.stored(names, vectors))
                    names, vectors = [], []
                width = len(vector)
                names.append(name)
                vectors.append(vector)
        if names:
            done.append(self.stored(names, vectors))
        return Files(done)

    def commit(self, messages: list) -> None:
        fs, root = located(self.path)
        archives = sorted((a for m in messages if m is not None for a in m.archives), key=lambda a: a["archive"])
        for a, info in zip(archives, fs.get_file_info([f"{root}/{a['archive']}" for a in archives]), strict=True):
            if info.type != pafs.FileType.File or info.size != a["bytes"]:
                raise OSError(f"{a['archive']} is not whole")
        if _manifest(fs, root) is not None:
            raise FileExistsError(f"{self.path} is published")
        fs.create_dir(root, recursive=True)
        with fs.open_output_stream(f"{root}/.{self.job}.json") as f:
            f.write(json.dumps({"model": self.model, "archives": archives}, sort_keys=True).encode())
        fs.move(f"{root}/.{self.job}.json", f"{root}/{MANIFEST}")

    def abort(self, messages: list) -> None:
        fs, root = located(self.path)
        if fs.get_file_info(f"{root}/{self.job}").type == pafs.FileType.Directory:
            fs.delete_dir(f"{root}/{self.job}")


class VectorArchives(DataSource):
    @classmethod
    def name(cls) -> str:
        return "vector_archives"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> VectorReader:
        return VectorReader(dict(self.options))

    def writer(self, schema, overwrite: bool) -> VectorWriter:
        if overwrite:
            raise ValueError("a published folder isn't written again")
        return VectorWriter(dict(self.options))


def _registered(spark: SparkSession) -> SparkSession:
    """Spark runs a source's planning and commit beside the driver, where the files given to
    executors aren't, so the source travels in its pickle."""
    import sys

    from pyspark import cloudpickle

    module = sys.modules[__name__]
    cloudpickle.register_pickle_by_value(module)
    try:
        spark.dataSource.register(VectorArchives)
    finally:
        cloudpickle.unregister_pickle_by_value(module)
    return spark


def write_vector_archives(df: DataFrame, path: str, *, model: str = "", rows_per_archive: int = 16_384, compressed: bool = False) -> None:
    """``identity`` and ``embedding`` as archives under ``path``, all of them or none.

    Null identities and vectors that are null, empty or hold null or non-finite components are an
    error, as is a folder that is published already. Vectors of another length begin a new archive. No rows publish an empty manifest. Other
    columns aren't written. The manifest, one line an archive, is made on the driver.
    """
    spark = _registered(df.sparkSession)
    rows = df.selectExpr("cast(identity AS string) AS identity", "cast(embedding AS array<float>) AS embedding")
    rows.write.format("vector_archives").option("model", model).option("rows_per_archive", rows_per_archive).option("compressed", str(compressed).lower()).mode("append").save(qualified(spark, path))


def vector_archives(spark: SparkSession, path: str, *, rows_per_task: int = 65_536, verify: bool = False) -> DataFrame:
    """identity, embedding, archive, position and reason_code of all archives under ``path``.

    A row whose vector isn't finite says not_finite; an archive that can't be read gives a row
    without identity: member_missing, shape, digest_mismatch (with ``verify``, which reads archives
    whole) or archive_read_failed. ``accepted_vectors`` leaves archives with a reason out.
    """
    return _registered(spark).read.format("vector_archives").option("rows_per_task", rows_per_task).option("verify", str(verify).lower()).load(qualified(spark, path))


def accepted_vectors(rows: DataFrame) -> DataFrame:
    """Rows of archives that have no reason: one bad row rejects its archive."""
    from pyspark.sql import functions as F

    bad = rows.where("reason_code IS NOT NULL").select("archive").distinct()
    return rows.join(bad, "archive", "left_anti").select("identity", F.col("embedding"))
