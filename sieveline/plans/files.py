"""Sources and sinks: tables written in the library's formats and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions import scalars as S
from sieveline.plans.catalog import register, table
from sieveline.session import shared_dir
from sieveline.sources import readers, writers


def _path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/sieveline/{name}-{uuid.uuid4().hex}"


@register("manifest_round_trip", "SELECT doc_id::VARCHAR AS doc_id, lang, source, CASE WHEN doc_id % 3 = 0 THEN '' ELSE text END AS note FROM documents")
def manifest_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Quotes, line ends and blanks survive a manifest."""
    rows = table(spark, d, "documents").select("doc_id", "lang", "source", F.when(F.col("doc_id") % 3 == 0, "").otherwise(F.col("text")).alias("note"))
    path = _path(spark, "manifest")
    writers.write_manifest(rows, path, ["doc_id", "lang", "source", "note"])
    return readers.manifest(spark, path, ["doc_id", "note"])


@register("optional_manifest", "SELECT '' AS a, '' AS b WHERE false")
def optional_manifest(spark: SparkSession, d: str) -> DataFrame:
    return readers.optional_manifest(spark, _path(spark, "absent"), ["a", "b"])


@register("json_lines_round_trip", "SELECT user_id, count(*) AS n, list_sort(list(event_id)) AS events FROM events GROUP BY user_id")
def json_lines_round_trip(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "events").groupBy("user_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list("event_id")).alias("events"))
    path = _path(spark, "lines")
    writers.write_json_lines(rows, path)
    return spark.read.schema(rows.schema).json(path)


@register("vectors_round_trip", "SELECT vec_id::VARCHAR AS identity, round(list_sum(embedding::DOUBLE[]), 5) AS total, 'm1' AS embedding_model FROM embeddings")
def vectors_round_trip(spark: SparkSession, d: str) -> DataFrame:
    path = _path(spark, "vectors")
    writers.write_vectors(table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("identity"), "embedding"), path, "m1")
    return spark.read.parquet(path).select("identity", F.round(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x), 5).alias("total"), "embedding_model")


@register(
    "labels_round_trip",
    "SELECT event_id // 8 AS image, (event_id % 4)::INT AS class_id, round(((event_id * 37 % 400) + (40 + event_id * 29 % 160) / 2.0) / 640, 8) AS cx, round((40 + event_id * 31 % 140) / 480.0, 8) AS h, false AS is_faulty FROM events",
)
def labels_round_trip(spark: SparkSession, d: str) -> DataFrame:
    from sieveline.plans.boxes import boxes

    rows = boxes(spark, d).withColumns({"width": F.lit(640.0), "height": F.lit(480.0)})
    path = _path(spark, "labels")
    writers.write_labels(rows, path, "image")
    read = readers.label_lines(readers.label_files(spark, path))
    return read.select(F.col("image").cast("long").alias("image"), "class_id", F.round("cx", 8).alias("cx"), F.round("h", 8).alias("h"), "is_faulty")


@register("checksum_inventory", "SELECT sha256(text) AS digest, doc_id || '.txt' AS name FROM documents WHERE text <> ''")
def checksum_inventory(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "documents").where("text <> ''").select(F.concat(F.col("doc_id").cast("string"), F.lit(".txt")).alias("name"), F.col("text").alias("content"))
    path = _path(spark, "checksums")
    writers.checksum_text(files).write.text(path)
    return readers.checksum_lines(spark.read.text(path))


@register(
    "archive_names",
    "SELECT p_partkey, 'site-' || p_size AS site, (2000 + p_size % 20)::INT AS year, (1 + p_size % 12)::INT AS month, 'cam' || p_size AS frame_site, '2020-' || lpad((1 + p_size % 12)::VARCHAR, 2, '0') || '-05T10:20:30' AS stamp FROM part",
)
def archive_names(spark: SparkSession, d: str) -> DataFrame:
    n = F.col("p_size")
    archive = readers.archive_parts(F.format_string("site-%d_%d_%02d.tar.gz", n, 2000 + n % 20, 1 + n % 12))
    frame = readers.frame_parts(F.format_string("cam%d_2020_%02d_05_102030.JPG", n, 1 + n % 12))
    return table(spark, d, "part").select("p_partkey", archive["site"].alias("site"), archive["year"].alias("year"), archive["month"].alias("month"), frame["site"].alias("frame_site"), frame["stamp"].alias("stamp"))


@register("stamped_names", "SELECT p_partkey, 'a_b' AS site, TIMESTAMP '2026-08-01 12:00:00' + to_days(p_size % 28) AS stamp FROM part")
def stamped_names(spark: SparkSession, d: str) -> DataFrame:
    day = 1 + F.col("p_size") % 28
    stem = F.when(F.col("p_size") % 2 == 0, F.format_string("a_b_2026-08-%02d_120000", day)).otherwise(F.format_string("a_b_2026_08_%02d_120000", day))
    part = readers.stamped_parts(stem)
    return table(spark, d, "part").select("p_partkey", part["site"].alias("site"), part["stamp"].cast("timestamp_ntz").alias("stamp"))


@register("subset_names", "SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'train' WHEN 1 THEN 'test' ELSE 'validation' END AS subset, 'u' || user_id AS url FROM events")
def subset_names(spark: SparkSession, d: str) -> DataFrame:
    folder = F.get(F.array(*[F.lit(x) for x in ("train", "test", "validation", "other")]), (F.col("event_id") % 4).cast("int"))
    items = F.array(F.struct(F.lit("S3").alias("Type"), F.lit("no").alias("URL")), F.struct(F.lit("GET").alias("Type"), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("URL")))
    return table(spark, d, "events").select("event_id", readers.subset_of(F.concat(F.lit("/data/"), folder, F.lit("/x.jpg"))).alias("subset"), readers.first_of_type(items, "GET").alias("url"))


@register("ini_sections", "SELECT conv_id, turn, 'c' || ((turn // 3) * 3) AS section FROM conversations")
def ini_sections(spark: SparkSession, d: str) -> DataFrame:
    """The header above each line; every third turn stands for one."""
    line = F.when(F.col("turn") % 3 == 0, F.concat(F.lit("[c"), F.col("turn").cast("string"), F.lit("]"))).otherwise(F.lit("k = v"))
    rows = table(spark, d, "conversations").select("conv_id", "turn", line.alias("value"))
    return readers.ini_sections(rows, "turn").select("conv_id", "turn", "section")


@register("coco_round_trip", "SELECT event_id // 8 || '.jpg' AS file_name, 'c' || event_id % 4 AS category, (event_id * 37 % 400)::DOUBLE AS x, (40 + event_id * 31 % 140)::DOUBLE AS h FROM events")
def coco_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A document for every thousand images, written and read back."""
    from sieveline.plans.boxes import boxes

    rows = boxes(spark, d).withColumn("file_name", F.concat(F.col("image").cast("string"), F.lit(".jpg")))
    images = rows.select("file_name", F.floor(F.col("image") / 1000).alias("bundle"), F.lit(640).alias("width"), F.lit(480).alias("height")).distinct()
    path = _path(spark, "bundles")
    writers.coco_document(images, rows, [(i, f"c{i}") for i in range(4)], "bundle").write.parquet(path)
    return readers.coco_annotations(spark.read.parquet(path), "bundle").where("fault IS NULL").select("file_name", "category", "x", "h")


@register("feature_sites", "SELECT 'n' || n_regionkey AS sitename, max(n_nationkey) AS code FROM nation GROUP BY 1")
def feature_sites(spark: SparkSession, d: str) -> DataFrame:
    feature = F.struct(F.struct(F.concat(F.lit("n"), F.col("n_regionkey").cast("string")).alias("sitename"), F.col("n_nationkey").alias("code")).alias("properties"), F.col("n_nationkey").alias("order"))
    nested = table(spark, d, "nation").agg(F.array_sort(F.collect_list(feature), lambda a, b: F.when(a["order"] < b["order"], -1).otherwise(1)).alias("features"))
    return readers.feature_sites(nested).select("sitename", "code")


@register("artifact_names", "SELECT doc_id, doc_id || ':' || source || ':' || lang AS identity, lower(source) || '-' || doc_id AS name FROM documents")
def artifact_names(spark: SparkSession, d: str) -> DataFrame:
    name = S.slug(F.concat(F.col("source"), F.lit("  "), F.col("doc_id").cast("string")))
    return table(spark, d, "documents").select("doc_id", S.identity3(F.col("doc_id"), F.col("source"), F.col("lang")).alias("identity"), name.alias("name"))


@register("settings_round_trip", "SELECT count(*) AS documents, sum(n_chars)::BIGINT AS chars FROM documents")
def settings_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """One row of statistics as sorted JSON, read back as an object."""
    found = table(spark, d, "documents").agg(F.count("*").alias("documents"), F.sum("n_chars").cast("long").alias("chars"))
    path = _path(spark, "statistics")
    spark.createDataFrame([(writers.statistics_json(found),)], "value string").coalesce(1).write.text(path)
    read = readers.json_object(spark, path)
    return spark.createDataFrame([(read["documents"], read["chars"])], "documents long, chars long")


@register("zip_members", "SELECT doc_id, member, CASE member WHEN 'a/lang.txt' THEN sha256(coalesce(lang, '')) ELSE sha256(coalesce(text, '')) END AS sha256, true AS repeats FROM documents, (VALUES ('a/lang.txt'), ('b/text.txt')) m(member)")
def zip_members(spark: SparkSession, d: str) -> DataFrame:
    """An archive for each document: the members' order in memory doesn't show in the bytes."""

    def run(batches):
        import hashlib
        import io
        import zipfile

        import pandas as pd

        for held in batches:
            rows = []
            for doc, lang, text in zip(held["doc_id"], held["lang"], held["text"], strict=True):
                members = {"b/text.txt": (text or "").encode(), "a/lang.txt": (lang or "").encode()}
                made = writers.reproducible_zip(members)
                same = made == writers.reproducible_zip(dict(reversed(members.items())))
                with zipfile.ZipFile(io.BytesIO(made)) as z:
                    rows += [(doc, i.filename, hashlib.sha256(z.read(i)).hexdigest(), same and i.date_time == (1980, 1, 1, 0, 0, 0)) for i in z.infolist()]
            yield pd.DataFrame(rows, columns=["doc_id", "member", "sha256", "repeats"])

    return table(spark, d, "documents").select("doc_id", "lang", "text").mapInPandas(run, "doc_id long, member string, sha256 string, repeats boolean")


@register(
    "tar_members",
    """
    SELECT doc_id, 'text.txt' AS member, strlen(coalesce(text, '')) AS bytes, sha256(coalesce(text, '')) AS sha256, NULL AS reason_code FROM documents WHERE doc_id % 11 <> 0
    UNION ALL SELECT doc_id, '../lang.txt', strlen(coalesce(lang, '')), NULL, 'traversal' FROM documents WHERE doc_id % 11 <> 0
    UNION ALL SELECT doc_id, 'link.jpg', 0, NULL, 'link' FROM documents WHERE doc_id % 11 <> 0
    UNION ALL SELECT doc_id, NULL, NULL, NULL, 'archive_read_failed' FROM documents WHERE doc_id % 11 = 0
    """,
)
def tar_members(spark: SparkSession, d: str) -> DataFrame:
    """An archive for each document, with members that aren't safe; every eleventh isn't an archive."""

    def run(batches):
        import io
        import tarfile

        import pandas as pd

        for held in batches:
            rows = []
            for doc, lang, text in zip(held["doc_id"], held["lang"], held["text"], strict=True):
                out = io.BytesIO()
                with tarfile.open(fileobj=out, mode="w:gz", compresslevel=1) as archive:
                    for name, content in (("text.txt", text), ("x_IR_y.jpg", text), ("../lang.txt", lang)):
                        info = tarfile.TarInfo(name)
                        info.size = len((content or "").encode())
                        archive.addfile(info, io.BytesIO((content or "").encode()))
                    info = tarfile.TarInfo("link.jpg")
                    info.type, info.linkname = tarfile.SYMTYPE, "text.txt"
                    archive.addfile(info)
                rows.append((str(doc), b"no archive" if doc % 11 == 0 else out.getvalue()))
            yield pd.DataFrame(rows, columns=["path", "content"])

    files = table(spark, d, "documents").select("doc_id", "lang", "text").mapInPandas(run, "path string, content binary")
    return readers.tar_members(files).select(F.col("path").cast("long").alias("doc_id"), "member", "bytes", F.sha2("content", 256).alias("sha256"), "reason_code")


@register("file_inventory", "SELECT c_nationkey AS nation, suffix, sum(strlen(c_name) + CASE WHEN suffix = 'txt' THEN 1 ELSE 13 END)::BIGINT AS bytes, CASE WHEN suffix = 'txt' THEN 'suffix' END AS reason_code FROM customer, (VALUES ('txt'), ('json')) s(suffix) GROUP BY ALL")
def file_inventory(spark: SparkSession, d: str) -> DataFrame:
    """Files below a folder, those of another suffix told apart."""
    path = _path(spark, "inventory")
    rows = table(spark, d, "customer").select(F.col("c_name").alias("value"), F.col("c_nationkey").alias("nation"))
    rows.write.partitionBy("nation").text(f"{path}/texts")
    rows.write.partitionBy("nation").json(f"{path}/objects")
    found = readers.inventory(spark, path, suffixes=("json",)).where("name <> '_SUCCESS'")
    nation, suffix = F.regexp_extract("path", r"/nation=(\d+)/", 1).cast("int"), F.element_at(F.split("name", r"\."), -1)
    return found.groupBy(nation.alias("nation"), suffix.alias("suffix"), "reason_code").agg(F.sum("bytes").alias("bytes"))
