"""Box geometry as column expressions. Boxes are structs x1, y1, x2, y2 unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.scalars import clamp

OVERLAP = 0.2


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.struct(x1.cast("double").alias("x1"), y1.cast("double").alias("y1"), x2.cast("double").alias("x2"), y2.cast("double").alias("y2"))


def area(b: Column) -> Column:
    return F.greatest(b["x2"] - b["x1"], F.lit(0.0)) * F.greatest(b["y2"] - b["y1"], F.lit(0.0))


def intersection(a: Column, b: Column) -> Column:
    wide = F.least(a["x2"], b["x2"]) - F.greatest(a["x1"], b["x1"])
    high = F.least(a["y2"], b["y2"]) - F.greatest(a["y1"], b["y1"])
    return F.greatest(wide, F.lit(0.0)) * F.greatest(high, F.lit(0.0))


def iou(a: Column, b: Column) -> Column:
    """Intersection over union; zero where the union is empty."""
    both = intersection(a, b)
    union = area(a) + area(b) - both
    return F.when(union > 0, both / union).otherwise(0.0)


def iou_xywh(a: Column, b: Column) -> Column:
    """The same for boxes of left, top, width and height."""
    return iou(from_xywh(a), from_xywh(b))


def coverage(a: Column, b: Column) -> Column:
    """The intersection's share of the smaller box."""
    least = F.least(area(a), area(b))
    return F.when(least > 0, intersection(a, b) / least).otherwise(0.0)


def overlaps(a: Column, b: Column, most_iou: float = 0.5, most_coverage: float = 0.5) -> Column:
    """Whether two detections show one thing: by IoU, or across views by coverage."""
    return (iou(a, b) >= most_iou) | ((a["view"] != b["view"]) & (coverage(a, b) >= most_coverage))


def from_xywh(b: Column) -> Column:
    return box(b["x"], b["y"], b["x"] + b["w"], b["y"] + b["h"])


def to_xywh(b: Column) -> Column:
    return F.struct(b["x1"].alias("x"), b["y1"].alias("y"), (b["x2"] - b["x1"]).alias("w"), (b["y2"] - b["y1"]).alias("h"))


def to_center(b: Column) -> Column:
    return F.struct(((b["x1"] + b["x2"]) / 2).alias("cx"), ((b["y1"] + b["y2"]) / 2).alias("cy"), (b["x2"] - b["x1"]).alias("w"), (b["y2"] - b["y1"]).alias("h"))


def from_center(b: Column) -> Column:
    return box(b["cx"] - b["w"] / 2, b["cy"] - b["h"] / 2, b["cx"] + b["w"] / 2, b["cy"] + b["h"] / 2)


def scaled(b: Column, width: Column, height: Column) -> Column:
    """Shares to pixels."""
    return box(b["x1"] * width, b["y1"] * height, b["x2"] * width, b["y2"] * height)


def normalized(b: Column, width: Column, height: Column) -> Column:
    return box(b["x1"] / width, b["y1"] / height, b["x2"] / width, b["y2"] / height)


def rotated(b: Column, degrees: Column) -> Column:
    """A box of shares after the image turns counter-clockwise by a multiple of 90."""
    one = F.lit(1.0)
    return (
        F.when(degrees == 90, box(b["y1"], one - b["x2"], b["y2"], one - b["x1"]))
        .when(degrees == 180, box(one - b["x2"], one - b["y2"], one - b["x1"], one - b["y1"]))
        .when(degrees == 270, box(one - b["y2"], b["x1"], one - b["y1"], b["x2"]))
        .otherwise(b)
    )


def tiles(images: DataFrame, width: str = "width", height: str = "height", overlap: float = OVERLAP) -> DataFrame:
    """One row per tile (priority, x, y, w, h): five by three along the longer side,
    neighbours overlap, the last touches the edge; halves round to even."""
    w, h = F.col(width), F.col(height)
    across, down = F.when(w >= h, 5).otherwise(3), F.when(w >= h, 3).otherwise(5)
    side = lambda size, n: F.greatest(F.lit(1), F.ceil(size / (n - (n - 1) * F.lit(overlap)))).cast("int")
    start = lambda i, size, own, n: F.when(i == n - 1, size - own).otherwise(F.bround(i * (size - own) / (n - 1))).cast("int")
    sized = images.withColumns({"tile_w": side(w, across), "tile_h": side(h, down), "_across": across, "_down": down})
    rows = sized.withColumn("_y", F.explode(F.sequence(F.lit(0), F.col("_down") - 1))).withColumn("_x", F.explode(F.sequence(F.lit(0), F.col("_across") - 1)))
    placed = rows.withColumns(
        {
            "priority": F.col("_y") * F.col("_across") + F.col("_x") + 1,
            "tile_x": start(F.col("_x"), w, F.col("tile_w"), F.col("_across")),
            "tile_y": start(F.col("_y"), h, F.col("tile_h"), F.col("_down")),
        }
    )
    return placed.drop("_x", "_y", "_across", "_down")


def letterbox(width: Column, height: Column, size: int = 640) -> Column:
    """The scale, the resized sides and the offsets that centre an image on a square."""
    scale = F.least(F.lit(float(size)) / width, F.lit(float(size)) / height)
    w, h = F.greatest(F.lit(1), F.bround(width * scale)).cast("int"), F.greatest(F.lit(1), F.bround(height * scale)).cast("int")
    return F.struct(scale.alias("scale"), w.alias("w"), h.alias("h"), F.floor((F.lit(size) - w) / 2).cast("int").alias("off_x"), F.floor((F.lit(size) - h) / 2).cast("int").alias("off_y"))


def to_image(b: Column, view: Column, width: Column, height: Column) -> Column:
    """A box of a view's square back in the image, clipped to its last pixels.
    view: scale, off_x, off_y, crop_x, crop_y."""
    x = lambda v: clamp((v - view["off_x"]) / view["scale"] + view["crop_x"], F.lit(0.0), width - F.lit(1.0))
    y = lambda v: clamp((v - view["off_y"]) / view["scale"] + view["crop_y"], F.lit(0.0), height - F.lit(1.0))
    return box(x(b["x1"]), y(b["y1"]), x(b["x2"]), y(b["y2"]))


def clipped(b: Column, frame: Column) -> Column:
    return box(F.greatest(b["x1"], frame["x1"]), F.greatest(b["y1"], frame["y1"]), F.least(b["x2"], frame["x2"]), F.least(b["y2"], frame["y2"]))


def visible_share(b: Column, frame: Column) -> Column:
    return F.when(area(b) > 0, intersection(b, frame) / area(b)).otherwise(0.0)


def short_side(b: Column) -> Column:
    return F.least(b["x2"] - b["x1"], b["y2"] - b["y1"])


def view_short_side(b: Column, frame: Column, full: Column, size: float = 640.0, least: float = 0.5) -> Column:
    """The visible part's short side at the view's scale; zero if a tile shows too little."""
    part = clipped(b, frame)
    scale = F.least(F.lit(size) / (frame["x2"] - frame["x1"]), F.lit(size) / (frame["y2"] - frame["y1"]))
    seen = full | (visible_share(b, frame) >= least)
    return F.when(seen, F.greatest(short_side(part), F.lit(0.0)) * scale).otherwise(0.0)


def side_tag(side: Column) -> Column:
    return F.when(side < 16, "tiny").when(side <= 32, "small").when(side <= 96, "medium").otherwise("large")


def area_at(b: Column, width: Column, height: Column, size: float = 640.0) -> Column:
    """The box's area once the image's longer side is ``size``."""
    return area(b) * F.pow(F.lit(size) / F.greatest(width, height), 2)


def area_tag(value: Column) -> Column:
    return F.when(value < 1024, "small").when(value < 9216, "medium").otherwise("large")


def privacy_rectangle(b: Column, width: Column, height: Column) -> Column:
    """The box a tenth larger on each side, on whole pixels within the image, and the blur's radius."""
    dx, dy = (b["x2"] - b["x1"]) * 0.1, (b["y2"] - b["y1"]) * 0.1
    x1, y1 = F.greatest(F.floor(b["x1"] - dx), F.lit(0)), F.greatest(F.floor(b["y1"] - dy), F.lit(0))
    x2, y2 = F.least(F.ceil(b["x2"] + dx), width), F.least(F.ceil(b["y2"] + dy), height)
    return F.struct(x1.cast("int").alias("x1"), y1.cast("int").alias("y1"), x2.cast("int").alias("x2"), y2.cast("int").alias("y2"), F.greatest(F.lit(8), F.bround(F.least(x2 - x1, y2 - y1) * 0.1)).cast("int").alias("radius"))


def inside_crop(b: Column, crop: Column, least: float = 0.5, pixels: float = 1.0) -> Column:
    """Whether a crop keeps a box: big enough there, and its centre or enough of it inside."""
    part = clipped(b, crop)
    cx, cy = (b["x1"] + b["x2"]) / 2, (b["y1"] + b["y2"]) / 2
    centred = (cx >= crop["x1"]) & (cx < crop["x2"]) & (cy >= crop["y1"]) & (cy < crop["y2"])
    return (part["x2"] - part["x1"] >= pixels) & (part["y2"] - part["y1"] >= pixels) & (centred | (visible_share(b, crop) >= least))


def moved(b: Column, dx: Column, dy: Column) -> Column:
    return box(b["x1"] + dx, b["y1"] + dy, b["x2"] + dx, b["y2"] + dy)


def at_inner_edge(b: Column, crop: Column, width: Column, height: Column, margin: float = 2.0) -> Column:
    """Whether a box touches an edge of its crop that isn't the image's own edge."""
    return (
        ((crop["x1"] > 0) & (b["x1"] <= crop["x1"] + margin))
        | ((crop["y1"] > 0) & (b["y1"] <= crop["y1"] + margin))
        | ((crop["x2"] < width) & (b["x2"] >= crop["x2"] - margin))
        | ((crop["y2"] < height) & (b["y2"] >= crop["y2"] - margin))
    )
