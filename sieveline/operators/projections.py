"""Row builders: candidates, frames, reviews, selections and final manifests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scalars import short_id, text_or_blank

SPLITS = ("train", "val", "test_id", "test_ood", "holdout")
DIGEST = "^[0-9a-f]{64}$"


def filled(value: Column, *others: Column) -> Column:
    """The first text that isn't blank; blank if none is."""
    return F.coalesce(*[F.nullif(F.trim(text_or_blank(c)), F.lit("")) for c in (value, *others)], F.lit(""))


def with_columns_or_blank(df: DataFrame, names: list[str]) -> DataFrame:
    """Exactly ``names``, as text; a column that isn't there is blank."""
    return df.select(*[(text_or_blank(F.col(n)) if n in df.columns else F.lit("")).alias(n) for n in names])


def mapped_classes(labels: DataFrame, mapping: dict[str, str], label: str) -> DataFrame:
    """Rows with ``compiled_class``; labels outside the mapping go. The mapping is a configuration's."""
    known = F.create_map(*[F.lit(x) for pair in mapping.items() for x in pair])
    return labels.withColumn("compiled_class", known[F.col(label)]).where("compiled_class IS NOT NULL")


def candidate_rows(images: DataFrame, boxes: DataFrame, image: str) -> DataFrame:
    """One row per image: attribution, provenance group, class list and its boxes in canonical
    order (class, then corners), none if it has no boxes."""
    box = F.struct("class_id", "x1", "y1", "x2", "y2")
    grouped = boxes.groupBy(image).agg(F.array_sort(F.collect_list(box)).alias("annotations"))
    joined = images.join(grouped, image, "left").withColumn("annotations", F.coalesce("annotations", F.array().cast("array<struct<class_id:int,x1:double,y1:double,x2:double,y2:double>>")))
    classes = F.array_join(F.transform(F.array_sort(F.array_distinct(F.transform("annotations", lambda b: b["class_id"]))), lambda c: c.cast("string")), ";")
    owner = filled(F.col("author_url"), F.col("author"))
    return joined.withColumns({"attribution": F.concat_ws(" — ", filled(F.col("author")), filled(F.col("license"))), "provenance_group_id": short_id("author-", owner), "compiled_classes": classes, "annotations_json": F.to_json("annotations"), "annotation_count": F.size("annotations")})


def frame_rows(members: DataFrame, parts: Column, season: Column) -> DataFrame:
    """Members of a frame archive with site, stamp, camera day and the archive's season."""
    return members.withColumns({"site_id": parts["site"], "timestamp": parts["stamp"], "season": season, "group_id": F.concat(parts["site"], F.lit(":"), F.substring(parts["stamp"], 1, 10))})


def review_rows(df: DataFrame, role: str) -> DataFrame:
    """Rows with empty decision columns and the scope that the role asks for."""
    blank = {c: F.lit("") for c in ("decision", "reviewer", "reviewed_at", "note")}
    return df.withColumns({"provisional_role": F.lit(role), "review_scope": F.lit("boxes" if role == "positive" else "absence"), "review_status": F.lit("pending"), **blank})


def triage(df: DataFrame, required: Column, missing: Column, rare: Column) -> DataFrame:
    """Priority and reason of a review row: required, then missing boxes, then rare classes."""
    priority = F.when(required, 0).when(missing, 1).when(rare, 2).otherwise(9)
    reason = F.when(required, "required").when(missing, "missing_detection").when(rare, "rare_class").otherwise("sample")
    return df.withColumns({"triage_priority": priority, "triage_reason": reason})


def serialized(boxes: Column, names: dict[int, str]) -> Column:
    """Detections as JSON, with the class' name and the kind of view."""
    known = F.create_map(*[F.lit(x) for pair in names.items() for x in pair])
    return F.to_json(F.transform(boxes, lambda b: F.struct(F.round(b["confidence"], 8).alias("confidence"), known[b["class_id"]].alias("name"), F.when(b["view"] == 0, "full").otherwise("crop").alias("view"))))


def enabled_counts(boxes: DataFrame, image: str, order: list[str], name: str) -> DataFrame:
    """Each image's counts of the enabled classes in the canonical order, the total and whether there is any."""
    counts = [F.count_if(F.col(name) == n).alias(n) for n in order]
    total = sum((F.col(n) for n in order[1:]), F.col(order[0]))
    found = boxes.groupBy(image).agg(*counts)
    return found.select(image, *order, total.alias("total"), (total > 0).alias("detected"))


def catalog_faults(manifest: DataFrame) -> DataFrame:
    """Rows of a catalogue manifest that contradict themselves, with the reasons."""
    from sieveline.operators.ledger import with_reasons

    split = F.col("split")
    reasons = {
        "bad_digest": ~F.coalesce(F.col("source_sha256").rlike(DIGEST), F.lit(False)),
        "unknown_split": ~split.isin(*SPLITS),
        "image_outside_split": F.get(F.split("image_path", "/"), F.lit(1)) != split,
        "label_outside_split": (F.col("label_path") != "") & (F.get(F.split("label_path", "/"), F.lit(1)) != split),
        "count_without_label": (F.col("annotation_count") > 0) != (F.col("label_path") != ""),
    }
    return with_reasons(manifest, reasons).where(F.size("reasons") > 0)


def catalog_violations(manifest: DataFrame, checksums: DataFrame, files: DataFrame, expected: dict[str, int]) -> DataFrame:
    """Everything that a catalogue check refuses: kind and subject. checksums: digest, name;
    files: name, sha256; expected: rows of each split."""
    from sieveline.operators.aggregates import composition
    from sieveline.operators.ledger import duplicates
    from sieveline.operators.splits import leakage

    row = lambda df, kind, subject: df.select(F.lit(kind).alias("kind"), subject.cast("string").alias("subject"))
    parts = [row(catalog_faults(manifest).withColumn("reason", F.explode("reasons")), "manifest", F.concat_ws(" ", "image_id", "reason")), row(duplicates(manifest, ["image_id"]), "duplicate_image", F.col("image_id"))]
    both = checksums.join(files, "name", "full")
    parts.append(row(both.where("sha256 IS NULL"), "missing_file", F.col("name")))
    parts.append(row(both.where("digest IS NULL"), "unlisted_file", F.col("name")))
    parts.append(row(both.where("digest <> sha256"), "changed_file", F.col("name")))
    parts.append(row(leakage(manifest, "split", {"sha": ["source_sha256", "parent_source_sha256"], "group": ["group_id"], "pixels": ["decoded_sha256"]}), "split_leak", F.concat_ws(" ", "domain", "value")))
    counts = manifest.groupBy("split").agg(F.count("*").alias("n"))
    parts.append(row(composition(counts, expected, "split").where("NOT as_expected"), "composition", F.col("split")))
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part)
    return every


def restored(manifest: DataFrame, pool: DataFrame) -> DataFrame:
    """Where each manifest row's content lies in a pool (path, sha256), the first path by name; null where nowhere."""
    where = pool.groupBy(F.col("sha256").alias("source_sha256")).agg(F.min("path").alias("pool_path"))
    return manifest.join(where, "source_sha256", "left")
