"""Unit conversions, ratios and display helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from abyssal.functions.common import as_col, safe_div
from abyssal.schemas import AMPS_PER_COUNT


def counts_to_amps(counts: Column) -> Column:
    return counts * F.lit(AMPS_PER_COUNT)


def counts_to_torr(counts: Column, sensitivity: float | str | Column) -> Column:
    return safe_div(counts_to_amps(counts), as_col(sensitivity))


def current_in_unit(counts: Column, unit: str, sensitivity: float | str | Column) -> Column:
    """Raw counts as themselves, in Amps or in Torr."""
    if unit == "raw":
        return counts
    return counts_to_amps(counts) if unit == "amps" else counts_to_torr(counts, sensitivity)


def ratio_or_null(value: Column, reference: Column) -> Column:
    """Null where the reference is zero or missing."""
    return F.when(reference != 0, value / reference)


def hydrogen_ion(ph: Column) -> Column:
    """H+ in mol/L."""
    return F.pow(F.lit(10.0), -ph)


def fahrenheit_to_celsius(temp_f: Column) -> Column:
    return (temp_f - 32) * 5 / 9


def at_least(value: Column, bound: float) -> Column:
    """Lower clip that keeps nulls (`greatest` would skip them)."""
    return F.when(value.isNotNull(), F.greatest(value, F.lit(bound)))


def at_most(value: Column, bound: float) -> Column:
    return F.when(value.isNotNull(), F.least(value, F.lit(bound)))


def jassby_platt(par: Column, pmax: Column, alpha: Column, r: Column) -> Column:
    return pmax * F.tanh(alpha * par / pmax) - r


def humanize_seconds(seconds: Column) -> Column:
    """Compact duration: the two largest of days, hours, minutes, or seconds; empty for null."""
    s = F.rint(seconds).cast("bigint")
    days, hours = F.floor(s / 86_400), F.floor(s % 86_400 / 3600)
    minutes, secs = F.floor(s % 3600 / 60), s % 60
    return (
        F.when(seconds.isNull(), F.lit(""))
        .when(days != 0, F.concat(days.cast("string"), F.lit("d "), hours.cast("string"), F.lit("h")))
        .when(hours != 0, F.concat(hours.cast("string"), F.lit("h "), minutes.cast("string"), F.lit("m")))
        .when(minutes != 0, F.concat(minutes.cast("string"), F.lit("m")))
        .otherwise(F.concat(secs.cast("string"), F.lit("s")))
    )
