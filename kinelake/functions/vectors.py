"""Column functions on vectors (arrays of numbers) and on names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Texts that stand for no value, compared without case and outer blanks (fixed values).
NO_TEXT = ("", "null", "none", "nan", "-1")


def doubles(c: Column) -> Column:
    return F.transform(c, lambda x: x.cast("double"))


def part(c: Column, start: int, width: int) -> Column:
    """The slice ``[start, start + width)`` of a vector."""
    return F.slice(c, start + 1, width)


def parts(c: Column, widths: list[int]) -> list[Column]:
    """A vector cut into parts of the given widths."""
    out, at = [], 0
    for w in widths:
        out.append(part(c, at, w))
        at += w
    return out


def gather(c: Column, positions: list[int]) -> Column:
    return F.array(*[F.get(c, F.lit(p)) for p in positions])


def rotate(c: Column, k: int) -> Column:
    """The first ``k`` elements moved to the end."""
    return F.concat(F.slice(c, F.lit(k + 1), F.greatest(F.size(c) - k, F.lit(0))), F.slice(c, 1, k))


def minus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x - y)


def plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def pad_right(c: Column, width: int, value: float = 0.0) -> Column:
    """Cut or filled up to ``width``."""
    return F.concat(F.slice(c, 1, width), F.array_repeat(F.lit(value), F.greatest(F.lit(width) - F.size(c), F.lit(0))))


def pad_mask(c: Column, width: int) -> Column:
    """True where ``pad_right`` fills up."""
    return F.transform(F.sequence(F.lit(1), F.lit(width)), lambda i: i > F.size(c))


def total(c: Column) -> Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x)


def is_text(c: Column) -> Column:
    """Not null and none of the spellings of no value."""
    return c.isNotNull() & ~F.lower(F.trim(c)).isin(*NO_TEXT)


def clamp(c: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(c, F.lit(low)), F.lit(high))


def camera_name(c: Column) -> Column:
    """The last segment of a camera's key, lower case, with single underscores."""
    last = F.element_at(F.split(c, r"\."), -1)
    return F.lower(F.regexp_replace(F.regexp_replace(last, "[^0-9A-Za-z]+", "_"), "^_+|_+$", ""))
