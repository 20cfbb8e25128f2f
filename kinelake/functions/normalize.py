"""Normalization by stored statistics, and its inverse."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Below this a range is degenerate; values are limited to the bound after scaling (fixed values).
DEGENERATE, BOUND, TINY = 1e-4, 5.0, 1e-8
RANGE_MODES = {"min/max": ("lo", "hi"), "q01/q99": ("q01", "q99"), "q001/q999": ("q001", "q999")}


def scale_and_offset(mode: str, stats: dict[str, Column]) -> tuple[Column, Column]:
    """``x * scale + offset`` normalizes; a degenerate range is only shifted."""
    if mode == "z-score":
        flat = stats["hi"] - stats["lo"] < DEGENERATE
        scale = F.when(flat, 1.0).otherwise(1 / (stats["std"] + TINY))
        return scale, -stats["mean"] * scale
    low, high = (stats[k] for k in RANGE_MODES[mode])
    flat = high - low < DEGENERATE
    scale = F.when(flat, 1.0).otherwise(2 / (high - low))
    return scale, F.when(flat, -low).otherwise(-1 - low * scale)


def forward(x: Column, scale: Column, offset: Column) -> Column:
    """NaN becomes 0 before the limits apply, since ordering puts NaN above all."""
    y = x * scale + offset
    return F.when(F.isnan(y), 0.0).otherwise(F.least(F.greatest(y, F.lit(-BOUND)), F.lit(BOUND)))


def backward(y: Column, scale: Column, offset: Column) -> Column:
    return (y - offset) / scale


def tail_forward(x: Column, low: Column, high: Column, c: Column) -> Column:
    """Identity between ``low`` and ``high``, logarithmic beyond."""
    return F.when(x > high, high + c * F.log1p((x - high) / c)).when(x < low, low - c * F.log1p((low - x) / c)).otherwise(x)


def tail_backward(y: Column, low: Column, high: Column, c: Column) -> Column:
    return F.when(y > high, high + c * F.expm1((y - high) / c)).when(y < low, low - c * F.expm1((low - y) / c)).otherwise(y)
