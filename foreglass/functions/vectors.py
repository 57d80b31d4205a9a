"""Vectors in array columns, ordered by market name; no Python in the hot path."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sorted_values(mapping: Column) -> Column:
    """Values of a map, ordered by key."""
    return F.transform(F.array_sort(F.map_entries(mapping)), lambda e: e["value"])


def price_vector(market_data: Column, side: str) -> Column:
    """Prices of one side (``yes_ask`` or ``no_ask``, in cents) as shares of one, ordered by market."""
    return F.transform(F.array_sort(F.map_entries(F.transform_values(market_data, lambda _, v: v[side]))), lambda e: e["value"] / 100.0)


def market_view(odds: Column, no_odds: Column, both_sides: bool) -> Column:
    """What the market predicts: the yes price, or the mean of it and of one minus the no price."""
    return F.zip_with(odds, no_odds, lambda y, n: (y + (1.0 - n)) / 2) if both_sides else odds


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def same_length(*vectors: Column) -> Column:
    """True if no vector is null and all have the same length."""
    first, *others = vectors
    same = first.isNotNull()
    for other in others:
        same = same & (F.size(first) == F.size(other)) & other.isNotNull()
    return same


def not_nan(value: Column) -> Column:
    """NaN as null: missing values are null everywhere inside."""
    return F.nanvl(value.cast("double"), F.lit(None).cast("double"))
