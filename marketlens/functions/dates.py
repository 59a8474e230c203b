"""Dates and recency; every relative date takes an explicit ``asof``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def day(asof: str) -> Column:
    return F.lit(asof).cast("date")


def younger_than(asof: str, k: int, *columns: str) -> Column:
    """Whether any of the dates is less than ``k`` days before ``asof`` (or after it); a null date decides nothing."""
    out = F.lit(False)
    for c in columns:
        out = out | F.coalesce(F.datediff(day(asof), F.to_date(c)) < k, F.lit(False))
    return out


def parse_any(c: Column, *formats: str) -> Column:
    """The first format that fits; null if none does."""
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats]).cast("timestamp_ntz")


def segment(asof: str, ts: Column, active: int = 92, inactive: int = 183) -> Column:
    """``active``, ``inactive`` or ``revival`` by days since; null without a date."""
    d = F.datediff(day(asof), F.to_date(ts))
    return F.when(d <= active, "active").when(d <= inactive, "inactive").when(d.isNotNull(), "revival")


def recency_step(days: Column) -> Column:
    """1, 0.9, 0.8 or 0.6, at 10, 20 and 30 days."""
    d = F.abs(days)
    return F.when(d <= 10, 1.0).when(d <= 20, 0.9).when(d <= 30, 0.8).when(d.isNotNull(), 0.6)


def cyclic_window(asof: str, span: int, slices: int) -> tuple[Column, Column]:
    """Start and end day of the slice of the last ``span`` days whose turn it is on ``asof``, by day of week."""
    size = span // slices
    turn = (F.dayofweek(day(asof)) - 1) % slices
    end = F.date_sub(day(asof), turn * size)
    return F.date_sub(end, size), end
