"""Sinks: manifests, statistics, labels, documents, checksums. Spark's commit protocol
makes each write whole or absent; nothing is overwritten unless asked."""

from __future__ import annotations

import hashlib
import io
import json
import uuid
import zipfile
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scalars import center_line
from sieveline.session import removed
from sieveline.sources.archives import located, qualified

#: Label files of a folder, at most.
FOLDER_FILES = 10_000


def write_manifest(df: DataFrame, path: str, fields: list[str], mode: str = "errorifexists") -> None:
    """A CSV of exactly ``fields``; other columns are an error."""
    extra = sorted(set(df.columns) - set(fields))
    if extra:
        raise ValueError(f"unknown columns: {', '.join(extra)}")
    df.select(*fields).write.mode(mode).csv(path, header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)


def statistics_json(metrics: DataFrame) -> str:
    """One row of metrics as JSON with sorted keys."""
    row = metrics.limit(2).collect()
    if len(row) != 1:
        raise ValueError("metrics must be one row")
    return json.dumps(row[0].asDict(recursive=True), sort_keys=True, default=str)


def write_json_lines(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).json(path)


def write_vectors(df: DataFrame, path: str, model: str, mode: str = "errorifexists") -> None:
    """identity and embedding, with the model's name in every row; invalid vectors are an error."""
    from sieveline.functions.scalars import valid_vector

    checked = df.select("identity", F.when(valid_vector(F.col("embedding")), F.col("embedding")).otherwise(F.raise_error(F.lit("a vector is not valid"))).alias("embedding"), F.lit(model).alias("embedding_model"))
    checked.write.mode(mode).parquet(path)


def label_texts(boxes: DataFrame, image: str) -> DataFrame:
    """Each image's label file: lines by class and box, eight decimals."""
    line = center_line(F.col("class_id"), F.struct("x1", "y1", "x2", "y2"), F.col("width"), F.col("height"))
    return boxes.groupBy(image).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("value"))


def label_name(image: str | None) -> str:
    """The file of an image, whatever its name holds; long names by their digest."""
    name = "%" if image is None else quote(image, safe=" ")
    return (name if len(name) <= 200 else "%" + hashlib.sha256(image.encode()).hexdigest()) + ".txt"


def write_labels(boxes: DataFrame, path: str, image: str, mode: str = "errorifexists") -> None:
    """One label file for each image with boxes, and the table ``index`` below ``path``: image, file and bytes.

    Tasks write the files themselves, FOLDER_FILES at most to a folder of their attempt, and Spark commits the index, so a
    failed job or a second attempt of a task never shows. ``readers.label_files`` reads what the index names. Null images are one.
    """
    spark, root, job = boxes.sparkSession, qualified(boxes.sparkSession, path), f"labels/{uuid.uuid4().hex}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = located(root)
        folder, used = "", set()
        for batch in batches:
            files, sizes = [], []
            for text, lines in zip(batch.column("name").to_pylist(), batch.column("value").to_pylist(), strict=True):
                name, content = label_name(text), lines.encode()
                if not folder or name in used or len(used) >= FOLDER_FILES:
                    folder, used = f"{job}/{uuid.uuid4().hex}", set()
                    fs.create_dir(f"{base}/{folder}", recursive=True)
                used.add(name)
                with fs.open_output_stream(f"{base}/{folder}/{name}") as f:
                    f.write(content)
                files.append(f"{folder}/{name}")
                sizes.append(len(content))
            yield pa.RecordBatch.from_arrays([batch.column("image"), pa.array(files, pa.string()), pa.array(sizes, pa.int64())], ["image", "file", "bytes"])

    texts = label_texts(boxes, image).select(F.col(image).alias("image"), F.col(image).cast("string").alias("name"), "value")
    kind = texts.schema["image"].dataType.simpleString()
    try:
        texts.mapInArrow(run, f"image {kind}, file string, bytes long").write.mode(mode).parquet(f"{root}/index")
    except Exception:
        removed(spark, f"{root}/{job}")
        raise
    if mode == "overwrite":
        fs, base = located(root)
        for info in fs.get_file_info(pafs.FileSelector(f"{base}/labels", allow_not_found=True)):
            if info.base_name != job.split("/")[1]:
                fs.delete_dir(info.path)


def coco_document(images: DataFrame, boxes: DataFrame, categories: list[tuple[int, str]], by: str | None = None) -> DataFrame:
    """One JSON document of a review bundle (a bundle is for people, so it is small), or one for
    each value of ``by``, a column of ``images``, beside that value: images numbered by file
    name within their document, annotations by image and box, categories from 1."""
    from pyspark.sql import Window

    key = [by] if by else []
    numbered = images.withColumn("id", F.row_number().over(Window.partitionBy(*key).orderBy("file_name")))
    joined = boxes.drop(*key).join(numbered.select(*key, "file_name", F.col("id").alias("image_id")), "file_name")
    ids = F.row_number().over(Window.partitionBy(*key).orderBy("image_id", "class_id", "x1", "y1", "x2", "y2"))
    bbox = F.array(F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1"))
    notes = joined.select(*key, ids.alias("id"), "image_id", (F.col("class_id") + 1).alias("category_id"), bbox.alias("bbox"))
    listed = lambda df, *c: df.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(*c))).alias("x"))
    a, b = listed(numbered, "id", "file_name", "width", "height").withColumnRenamed("x", "images"), listed(notes, "id", "image_id", "category_id", "bbox").withColumnRenamed("x", "annotations")
    kinds = F.array(*[F.struct(F.lit(i + 1).alias("id"), F.lit(n).alias("name")) for i, n in sorted(categories)])
    both = a.join(b, by, "left").withColumn("annotations", F.coalesce("annotations", F.array())) if by else a.join(b)
    return both.select(*key, F.to_json(F.struct(F.col("annotations"), kinds.alias("categories"), F.col("images"))).alias("document"))


def reproducible_zip(members: dict[str, bytes]) -> bytes:
    """The same bytes for the same members: sorted names, fixed times and modes."""
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name in sorted(members):
            info = zipfile.ZipInfo(name, (1980, 1, 1, 0, 0, 0))
            info.external_attr, info.compress_type = 0o644 << 16, zipfile.ZIP_DEFLATED
            z.writestr(info, members[name])
    return out.getvalue()


def checksum_text(files: DataFrame) -> DataFrame:
    """Checksum lines (digest, two spaces, name) of name and content, sorted by name."""
    return files.select(F.concat(F.sha2("content", 256), F.lit("  "), F.col("name")).alias("value"), "name").orderBy("name").select("value")
