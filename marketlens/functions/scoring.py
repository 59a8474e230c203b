"""Scores and bands as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Base, span, factor, rate, offset and sign of the seven component weights as functions of experience.
WEIGHTS = (
    (0.05, 0.10, 0.75, 0.23, 3.0, 1), (0.05, 0.05, 0.75, 0.23, 3.0, 1), (0.05, 0.15, 0.55, 0.20, 3.0, 1), (0.15, 0.10, 0.55, 0.15, 3.0, 1),
    (0.05, 0.10, 0.85, 0.30, 3.0, -1), (0.14, 0.02, 0.45, 0.10, 3.0, -1), (0.30, 0.10, 0.55, 0.20, 3.0, -1),
)


def component_weights(years: Column) -> list[Column]:
    """Weights of the seven similarity components at an experience, summing to 1; unknown experience counts as 0."""
    e = F.when(years >= 0, years).otherwise(F.lit(0.0))
    raw = [F.lit(base) + F.lit(span) / (1 + F.exp(-sign * (factor * F.exp(rate * e) - offset))) for base, span, factor, rate, offset, sign in WEIGHTS]
    total = raw[0]
    for w in raw[1:]:
        total = total + w
    return [w / total for w in raw]


def _known(a: Column, b: Column, value: Column) -> Column:
    return F.when((a < 0) | (b < 0) | a.isNull() | b.isNull(), 0.0).otherwise(value)


def experience_similarity(a: Column, b: Column) -> Column:
    """1 for equal experience, falling with the relative gap; 0 where either is unknown."""
    lo, hi = F.least(a, b), F.greatest(a, b)
    return _known(a, b, F.when(lo == 0, F.exp(-2.0 * hi)).otherwise(F.exp(-0.4 * F.pow((hi - lo) / lo, 2) * lo)))


def salary_similarity(a: Column, b: Column) -> Column:
    lo, hi = F.least(a, b), F.greatest(a, b)
    r = (hi - lo) / lo
    return _known(a, b, F.when(lo == 0, F.exp(-hi)).otherwise(F.exp(-1.3 * (0.2 * F.pow(r, 4) + 0.2 * F.pow(r, 2)) * lo)))


def overlaps(a_min: Column, a_max: Column, b_min: Column, b_max: Column) -> Column:
    """1 where two ranges meet, else 0; an open end is unbounded."""
    apart = F.coalesce(a_min > b_max, F.lit(False)) | F.coalesce(b_min > a_max, F.lit(False))
    return F.when(apart, 0).otherwise(1)


def banded(c: Column, edges: list[float]) -> Column:
    """Number of the right-closed band (1, 2, ...) a value falls in; null for null."""
    out = F.lit(len(edges) + 1)
    for i in range(len(edges), 0, -1):
        out = F.when(c <= edges[i - 1], i).otherwise(out)
    return F.when(c.isNotNull(), out)


def neighbour_bands(band: Column, most: int) -> Column:
    """The bands compatible with a band: itself and its neighbours."""
    return F.sequence(F.greatest(band - 1, F.lit(1)), F.least(band + 1, F.lit(most)))
