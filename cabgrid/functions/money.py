"""Sums of money that don't depend on the order of rows. Doubles that are no binary
fractions add up to different last digits in another order, and a total order of totals
then changes with the partitioning. Whole cents as integers don't, and they are
combined map-side like any sum."""

from pyspark.sql import Column, functions as F


def to_cents(amount) -> Column:
    """An amount of whole cents as an integer (halves of a cent go up)."""
    c = F.col(amount) if isinstance(amount, str) else amount
    return F.floor(c * F.lit(100.0) + F.lit(0.5)).cast("long")


def sum_of_cents(amount) -> Column:
    """The exact sum, rounded once to a double; NULL where there is no amount."""
    return F.sum(to_cents(amount)) / F.lit(100.0)


def avg_of_cents(amount) -> Column:
    """The mean, from the exact sum."""
    cents = to_cents(amount)
    return F.sum(cents) / F.lit(100.0) / F.nullif(F.count(cents), F.lit(0))
