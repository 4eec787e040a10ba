"""Sums of doubles that do not depend on the order of rows, tasks or partitions.

A value is cut into multiples of fixed powers of two. Sums of such multiples are exact in doubles while a group has no more than some
million rows, so any order gives the same bits; the sums of the cuts are added at the end in one order. What is smaller than half the last
unit is rounded away in each row alike. All of it is plain arithmetic that aggregates map-side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, WindowSpec
from pyspark.sql import functions as F

#: Exponents of the units. FINE is for values scaled to about 1 (2^26 rows); READINGS for instrument readings in their own units, up to
#: 2^45 in sum, down to 2^-41 (some 5e-13) in a reading, for 2^22 rows of a group.
FINE = (8, -20, -48, -76)
READINGS = (-8, -40)


def _cuts(value: Column, units: Sequence[int]) -> list[Column]:
    rest, out = value.cast("double"), []
    for e in units:
        magic = F.lit(1.5 * 2.0 ** (52 + e))  # adding it rounds to a multiple of 2^e
        cut = (rest + magic) - magic
        out.append(cut)
        rest = rest - cut
    return out


def cut_columns(value: str, units: Sequence[int] = READINGS) -> dict[str, Column]:
    """The cuts of a column under names of their own, for many conditional sums over it (`exact_avg_where`)."""
    return {f"__{value}_{i}": c for i, c in enumerate(_cuts(F.col(value), units))}


def exact_avg_where(condition: Column, value: str, units: Sequence[int] = READINGS) -> Column:
    """Mean of a column over the rows of a group that meet the condition, from its `cut_columns`."""
    parts = [F.sum(F.when(condition, F.col(f"__{value}_{i}"))) for i in range(len(units))]
    return F.try_divide(_added(parts), F.count(F.when(condition, F.col(value))))


def exact_sum(value: str | Column, over: WindowSpec | None = None, units: Sequence[int] = FINE) -> Column:
    """Sum of a group (or window); null without values, and infinite or NaN where a plain sum would be."""
    return _added([F.sum(c) if over is None else F.sum(c).over(over) for c in _cuts(F.col(value) if isinstance(value, str) else value, units)])


def _added(parts: Sequence[Column]) -> Column:
    total = parts[-1]
    for p in parts[-2::-1]:
        total = total + p
    return F.when(F.abs(parts[0]) < float("inf"), total).otherwise(parts[0])


def exact_avg(value: str | Column, over: WindowSpec | None = None, units: Sequence[int] = FINE) -> Column:
    n = F.count(value) if over is None else F.count(value).over(over)
    return F.try_divide(exact_sum(value, over, units), n)


def partial_sums(name: str, value: Column, units: Sequence[int] = READINGS) -> list[Column]:
    """Aggregates that stand for a mean and can be added up later: the sums of the cuts and the count (`merged_sums`, `mean_of_sums`)."""
    return [*[F.sum(c).alias(f"{name}__{i}") for i, c in enumerate(_cuts(value, units))], F.count(value).alias(f"{name}__n")]


def merged_sums(name: str, units: Sequence[int] = READINGS) -> list[Column]:
    return [F.sum(c).alias(c) for c in (*[f"{name}__{i}" for i in range(len(units))], f"{name}__n")]


def sum_of_sums(name: str, units: Sequence[int] = READINGS) -> Column:
    return _added([F.col(f"{name}__{i}") for i in range(len(units))])


def mean_of_sums(name: str, units: Sequence[int] = READINGS) -> Column:
    """The mean, with the bits that `exact_avg` over all the rows gives."""
    return F.try_divide(sum_of_sums(name, units), F.col(f"{name}__n"))
