"""Sources: manifests, nested catalogues, archives, labels, inventories."""

from __future__ import annotations

import io
import json
import tarfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sieveline.functions.scalars import iso_stamp
from sieveline.operators.ledger import require_columns
from sieveline.sources.archives import located, qualified

#: How the files of a frame archive and of an inventory are named.
ARCHIVE_NAME = r"^([A-Za-z0-9_.-]+?)_(\d{4})_(\d{2})\.tar\.gz$"
FRAME_NAME = r"(?i)^([a-z0-9._-]+?)_(\d{4})_(\d{2})_(\d{2})_(\d{6})\.jpg$"
STAMPED_NAME = r"^(.+?)_(\d{4})[-_](\d{2})[-_](\d{2})_(\d{6})$"
#: Members are handed on when so many bytes of them are held.
MEMBER_BATCH = 32 << 20
BOM = "﻿"


def manifest(spark: SparkSession, path: str, required: list[str] | None = None) -> DataFrame:
    """A CSV manifest: every column text, blank for missing, a byte order mark ignored,
    unknown columns kept in order; an error without a required column."""
    raw = spark.read.csv(path, header=True, escape='"', multiLine=True, inferSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    named = raw.toDF(*[c.lstrip(BOM) for c in raw.columns])
    return require_columns(named, required or []).na.fill("")


def path_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def optional_manifest(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """A manifest, or no rows where there is no file."""
    if path_exists(spark, path):
        return manifest(spark, path, columns)
    return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))


def subset_of(path: Column, known: tuple[str, ...] = ("train", "validation", "test"), default: str = "validation") -> Column:
    """The partition that a file's folder names."""
    folder = F.element_at(F.split(path, "/"), -2)
    return F.when(folder.isin(*known), folder).otherwise(F.lit(default))


def json_object(spark: SparkSession, path: str) -> dict:
    """A small JSON object of settings."""
    text = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    try:
        found = json.loads(text)
    except ValueError as error:
        raise ValueError(f"{path} is not JSON: {error}") from error
    if not isinstance(found, dict):
        raise ValueError(f"{path} is not a JSON object")
    return found


def feature_sites(collection: DataFrame, key: str = "sitename") -> DataFrame:
    """A feature collection's properties, one row per named site; the last feature of a name wins."""
    each = collection.select(F.posexplode("features").alias("_i", "_f")).select("_i", "_f.properties.*").where(F.coalesce(F.trim(key), F.lit("")) != "")
    last = each.groupBy(key).agg(F.max("_i").alias("_i"))
    return each.join(last, [key, "_i"]).drop("_i")


def first_of_type(items: Column, kind: str, field: str = "Type", value: str = "URL") -> Column:
    """The value of the first array item of a type; null without one."""
    return F.get(F.filter(items, lambda x: x[field] == kind), F.lit(0))[value]


def archive_parts(name: Column) -> Column:
    """site, year and month of an archive's name; null unless it is one."""
    part = lambda i: F.regexp_extract(name, ARCHIVE_NAME, i)
    return F.when(name.rlike(ARCHIVE_NAME), F.struct(part(1).alias("site"), part(2).cast("int").alias("year"), part(3).cast("int").alias("month")))


def frame_parts(name: Column) -> Column:
    part = lambda i: F.regexp_extract(name, FRAME_NAME, i)
    return F.when(name.rlike(FRAME_NAME), F.struct(part(1).alias("site"), iso_stamp(part(2), part(3), part(4), part(5)).alias("stamp")))


def stamped_parts(stem: Column) -> Column:
    """site and stamp of a file's stem, its date with hyphens or underscores."""
    part = lambda i: F.regexp_extract(stem, STAMPED_NAME, i)
    return F.when(stem.rlike(STAMPED_NAME), F.struct(part(1).alias("site"), F.try_to_timestamp(iso_stamp(part(2), part(3), part(4), part(5)), F.lit("yyyy-MM-dd'T'HH:mm:ss")).alias("stamp")))


def inventory(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("jpg", "jpeg", "png"), content: bool = False) -> DataFrame:
    """Every file below root: path, name, bytes, sha256 (with ``content``) and a reason why
    it isn't taken (hidden, suffix), null if it is. Symbolic links aren't followed."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    name = F.element_at(F.split("path", "/"), -1)
    inner = F.split(F.substring_index("path", root.rstrip("/").rsplit("/", 1)[-1] + "/", -1), "/")
    hidden = F.exists(inner, lambda p: F.startswith(p, F.lit(".")))
    reason = F.when(hidden, "hidden").when(~F.lower(F.element_at(F.split(name, r"\."), -1)).isin(*suffixes), "suffix")
    digest = {"sha256": F.sha2("content", 256)} if content else {}
    return files.withColumns({"name": name, "bytes": F.col("length"), "reason_code": reason, **digest}).select("path", "name", "bytes", *digest, "reason_code")


def tar_members(files: DataFrame, *, most_members: int = 10_000, most_bytes: int = 2 << 30, skip: str = "_IR_") -> DataFrame:
    """Members of tar.gz files (path, content): member, bytes, content and a reason code for
    those that aren't safe (link, traversal, too_large, too_many); an archive that
    can't be read gives a row of reason archive_read_failed after those read before."""
    columns = ["path", "member", "bytes", "content", "reason_code"]

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for held in batches:
            rows, size = [], 0
            for path, content in zip(held["path"], held["content"], strict=True):
                try:
                    with tarfile.open(fileobj=io.BytesIO(content), mode="r:gz") as archive:
                        total = 0
                        for number, m in enumerate(archive):
                            if m.isdir() or skip in m.name:
                                continue
                            total += m.size
                            bad = "link" if not m.isfile() else "traversal" if m.name.startswith("/") or ".." in m.name.split("/") else "too_many" if number >= most_members else "too_large" if total > most_bytes else None
                            rows.append((path, m.name, m.size, None if bad else archive.extractfile(m).read(), bad))
                            size += 0 if bad else m.size
                            if size >= MEMBER_BATCH:
                                yield pd.DataFrame(rows, columns=columns)
                                rows, size = [], 0
                except (tarfile.TarError, OSError, EOFError):
                    rows.append((path, None, None, None, "archive_read_failed"))
            yield pd.DataFrame(rows, columns=columns)

    return files.select("path", "content").mapInPandas(run, "path string, member string, bytes long, content binary, reason_code string")


def coco_documents(files: DataFrame, most_bytes: int = 50 << 20) -> DataFrame:
    """The one instances_*.json of each ZIP file (path, content), as text; a reason code where there isn't just one."""

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        for held in batches:
            rows = []
            for path, content in zip(held["path"], held["content"], strict=True):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as z:
                        found = [i for i in z.infolist() if i.filename.rsplit("/", 1)[-1].startswith("instances_") and i.filename.endswith(".json")]
                        bad = "not_one_document" if len(found) != 1 else "too_large" if found[0].file_size > most_bytes else None
                        rows.append((path, None if bad else z.read(found[0]).decode("utf-8"), bad))
                except (zipfile.BadZipFile, UnicodeDecodeError):
                    rows.append((path, None, "unreadable"))
            yield pd.DataFrame(rows, columns=["path", "document", "reason_code"])

    return files.select("path", "content").mapInPandas(run, "path string, document string, reason_code string")


COCO = "categories array<struct<id:string,name:string>>, images array<struct<id:string,file_name:string,width:int,height:int>>, annotations array<struct<id:string,image_id:string,category_id:string,bbox:array<double>>>"


def coco_annotations(documents: DataFrame, by: str | None = None) -> DataFrame:
    """file_name, category and box of each annotation; ids must be whole numbers, else the fault
    says so. ``by`` names each of several documents, whose ids are their own."""
    key = [by] if by else []
    parsed = documents.select(*key, F.from_json("document", COCO).alias("d"))
    images = parsed.select(*key, F.explode("d.images").alias("i")).select(*key, F.col("i.id").alias("image_id"), "i.file_name", "i.width", "i.height")
    names = parsed.select(*key, F.explode("d.categories").alias("c")).select(*key, F.col("c.id").alias("category_id"), F.col("c.name").alias("category"))
    each = parsed.select(*key, F.explode("d.annotations").alias("a")).select(*key, "a.*")
    whole = lambda c: F.coalesce(F.col(c).rlike(r"^-?\d+$"), F.lit(False))
    joined = each.join(images, [*key, "image_id"], "left").join(names, [*key, "category_id"], "left")
    x, y, w, h = (F.get("bbox", F.lit(i)) for i in range(4))
    fault = F.when(~(whole("id") & whole("image_id") & whole("category_id")), "id_not_whole").when(F.col("file_name").isNull(), "unknown_image").when(F.col("category").isNull(), "unknown_category").when(~F.coalesce((F.size("bbox") == 4) & (w > 0) & (h > 0) & (x >= 0) & (y >= 0) & (x + w <= F.col("width") + 1) & (y + h <= F.col("height") + 1), F.lit(False)), "box_outside")
    return joined.select("id", "file_name", "category", x.alias("x"), y.alias("y"), w.alias("w"), h.alias("h"), fault.alias("fault"))


def label_files(spark: SparkSession, path: str) -> DataFrame:
    """image and value, a row for each line of the label files that ``writers.write_labels`` published; a file of
    another size than it was written with is an error."""
    root = qualified(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = located(root)
        for batch in batches:
            texts, size, first = [], 0, 0
            for i, (file, told) in enumerate(zip(batch.column("file").to_pylist(), batch.column("bytes").to_pylist(), strict=True)):
                with fs.open_input_stream(f"{base}/{file}") as f:
                    content = f.read()
                if len(content) != told:
                    raise OSError(f"{file} is not whole")
                texts.append(content.decode())
                size += told
                if size >= MEMBER_BATCH or i + 1 == batch.num_rows:
                    yield pa.RecordBatch.from_arrays([batch.column("image").slice(first, len(texts)), pa.array(texts, pa.string())], ["image", "value"])
                    texts, size, first = [], 0, i + 1

    index = spark.read.parquet(f"{root}/index")
    whole = index.mapInArrow(run, f"image {index.schema['image'].dataType.simpleString()}, value string")
    return whole.select("image", F.explode(F.split("value", "\n")).alias("value"))


def label_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """Label lines of class and centre box, with a fault where a line isn't five finite
    shares of a box within the image."""
    parts = F.split(F.trim(value), r"\s+")
    number = lambda i: F.get(parts, F.lit(i)).try_cast("double")
    cls, cx, cy, w, h = F.get(parts, F.lit(0)).try_cast("int"), *(number(i) for i in range(1, 5))
    fine = (F.size(parts) == 5) & cls.isNotNull() & (w > 0) & (h > 0) & (cx - w / 2 >= -1e-6) & (cy - h / 2 >= -1e-6) & (cx + w / 2 <= 1 + 1e-6) & (cy + h / 2 <= 1 + 1e-6)
    return lines.select("*", cls.alias("class_id"), cx.alias("cx"), cy.alias("cy"), w.alias("w"), h.alias("h"), (~F.coalesce(fine, F.lit(False))).alias("is_faulty"))


def checksum_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    parts = F.split(value, "  ", 2)
    return lines.select(F.get(parts, F.lit(0)).alias("digest"), F.get(parts, F.lit(1)).alias("name")).where(F.col("digest").rlike("^[0-9a-f]{64}$") & F.col("name").isNotNull())


def ini_sections(lines: DataFrame, order: str, value: str = "value") -> DataFrame:
    """Each line of a text with the header above it: one text's lines, in ``order``."""
    from pyspark.sql import Window

    header = F.regexp_extract(value, r"^\s*\[([^\]]*)\]\s*$", 1)
    marked = F.when(F.col(value).rlike(r"^\s*\[[^\]]*\]\s*$"), header)
    keys = [c for c in lines.columns if c not in (order, value)]
    return lines.withColumn("section", F.last(marked, True).over(Window.partitionBy(*keys).orderBy(order)))
