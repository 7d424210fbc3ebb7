"""Scalar column functions: stable hashes, text, dates, numbers, vectors, JSON."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

UNIT = "\x1f"
SEED = "20260826"


def text_or_blank(value: Column) -> Column:
    """Missing text is the empty string, never null."""
    return F.coalesce(value.cast("string"), F.lit(""))


def stable_rank(*parts: Column | str, seed: str = SEED) -> Column:
    """The deterministic order of the library: SHA-256 of the seed and the parts, in hex."""
    columns = [text_or_blank(F.col(p) if isinstance(p, str) else p) for p in parts]
    return F.sha2(F.concat_ws(UNIT, F.lit(seed), *columns), 256)


def hash_fraction(digest: Column) -> Column:
    """The first 13 hex digits as a number in [0, 1)."""
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(16**13))


def short_id(prefix: str, text: Column, digits: int = 16) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.sha2(text, 256), 1, digits))


def identity3(dataset: Column, subset: Column, item: Column) -> Column:
    return F.concat_ws(":", text_or_blank(dataset), text_or_blank(subset), text_or_blank(item))


def hash_bits(hex16: Column) -> Column:
    """A 16-digit hex hash as a signed 64-bit integer; null unless it is one."""
    return F.when(hex16.rlike("^[0-9a-fA-F]{16}$"), F.conv(hex16, 16, -10).cast("bigint"))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))


def strict_bool(value: Column) -> Column:
    """true and false in any case, spaces around; anything else is null."""
    plain = F.lower(F.trim(value))
    return F.when(plain == "true", F.lit(True)).when(plain == "false", F.lit(False))


def flag(value: Column) -> Column:
    return text_or_blank(value) == "1"


def season(month: Column) -> Column:
    return F.when(month.isin(12, 1, 2), "winter").when(month.isin(3, 4, 5), "spring").when(month.isin(6, 7, 8), "summer").otherwise("autumn")


def day_group(site: Column, stamp: Column) -> Column:
    """A site's camera day."""
    return F.concat(site.cast("string"), F.lit(":"), F.date_format(stamp, "yyyy-MM-dd"))


def iso_stamp(year: Column, month: Column, day: Column, clock: Column) -> Column:
    """yyyy, mm, dd and hhmmss texts as yyyy-mm-ddThh:mm:ss."""
    return F.concat(year, F.lit("-"), month, F.lit("-"), day, F.lit("T"), F.substring(clock, 1, 2), F.lit(":"), F.substring(clock, 3, 2), F.lit(":"), F.substring(clock, 5, 2))


def utc_stamp(at: Column | None = None) -> Column:
    """An instant as yyyy-mm-ddThh:mm:ssZ in UTC, whatever the session's zone; of the query's
    start if none is given. Pass an instant where a result must repeat."""
    return F.date_format(F.convert_timezone(None, F.lit("UTC"), (F.now() if at is None else at).cast("timestamp").cast("timestamp_ntz")), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def seconds_apart(a: Column, b: Column) -> Column:
    return F.abs(F.unix_seconds(a.cast("timestamp")) - F.unix_seconds(b.cast("timestamp")))


def half_even(value: Column, digits: int = 0) -> Column:
    """Rounding to even at halves."""
    return F.bround(value, digits)


def finite(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def share(total: int | Column, parts: int, index: Column) -> Column:
    """What the index-th of ``parts`` gets of a total dealt as evenly as whole numbers go."""
    total = F.lit(total) if isinstance(total, int) else total
    return F.floor(total / F.lit(parts)).cast("int") + (index < total % F.lit(parts)).cast("int")


def dot(a: Column, b: Column) -> Column:
    """The inner product in double precision, summed in order."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def valid_vector(v: Column) -> Column:
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: finite(x.cast("double"))) & F.exists(v, lambda x: x != 0)


def unit_vector(v: Column) -> Column:
    """The vector over its length; null if it is zero or not finite."""
    return F.when(valid_vector(v), F.transform(v, lambda x: x.cast("double") / F.sqrt(dot(v, v))))


def slug(text: Column, most: int = 120) -> Column:
    """A file-safe name: lower case, other runs a hyphen, no mark at the ends; null if too long or empty."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9._-]+", "-"), "^[-.]+|[-.]+$", "")
    return F.when((plain != "") & (F.length(plain) <= most), plain)


def numbered_name(identity: Column, index: Column) -> Column:
    return F.format_string("image_%04d_%s.jpg", index.cast("int"), F.substring(F.sha2(identity, 256), 1, 12))


def context_text(*parts: Column) -> Column:
    """The parts that aren't blank, parted by semicolons."""
    return F.concat_ws("; ", *[F.nullif(text_or_blank(p), F.lit("")) for p in parts])


def sorted_set_text(items: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(items)), ";")


def before_mark(text: Column, mark: str) -> Column:
    return F.substring_index(text, mark, 1)


def center_line(class_id: Column, box: Column, width: Column, height: Column) -> Column:
    """A label line: class and the box's centre and size, as shares with eight decimals."""
    return F.format_string(
        "%d %.8f %.8f %.8f %.8f",
        class_id.cast("int"),
        (box["x1"] + box["x2"]) / 2.0 / width,
        (box["y1"] + box["y2"]) / 2.0 / height,
        (box["x2"] - box["x1"]) / width,
        (box["y2"] - box["y1"]) / height,
    )
