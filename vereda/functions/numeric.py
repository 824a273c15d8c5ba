"""Column expressions over numbers: coercion, guards, scaling, costs."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def nan_to_null(c: Column) -> Column:
    """One missing value: NaN becomes NULL, so min, max, median and count agree."""
    return F.when(~F.isnan(c), c)


def coerce_double(c: Column) -> Column:
    """Number or NULL; text that is no number gives NULL instead of an error."""
    return nan_to_null(c.try_cast("double"))


def coalesce_zero(*cs: Column) -> Column:
    """First non-null of several sources, 0.0 when all are missing."""
    return F.coalesce(*[c.cast("double") for c in cs], F.lit(0.0))


def safe_divide(a: Column, b: Column, default: float | None = None) -> Column:
    q = F.try_divide(a, b)
    return q if default is None else F.coalesce(q, F.lit(float(default)))


def clip_below(c: Column, floor: float) -> Column:
    return F.greatest(c, F.lit(float(floor)))


def minmax(c: Column, lo: Column, hi: Column) -> Column:
    """Rescaled to [0, 1]; a constant or missing value gives 0."""
    return safe_divide(c - lo, hi - lo, 0.0)


def zscore(c: Column, mean: Column, std: Column) -> Column:
    """Standardised by the population deviation; a constant gives 0."""
    return safe_divide(c - mean, std, 0.0)


def threshold_label(score: Column, threshold: Column) -> Column:
    """1 at or above the threshold, else 0. A missing score is 0."""
    return F.when(score >= threshold, 1).otherwise(0)


def map_values(c: Column, mapping: dict) -> Column:
    """Recode through a small literal mapping; values outside it give NULL."""
    out = None
    for k, v in mapping.items():
        out = F.when(c == F.lit(k), F.lit(v)) if out is None else out.when(c == F.lit(k), F.lit(v))
    return out if out is not None else F.lit(None)


def edge_cost(length: Column, suitability: Column) -> Column:
    """Length over suitability; a missing length counts as 1."""
    return F.coalesce(length.cast("double"), F.lit(1.0)) * (F.lit(1.0) / suitability)
