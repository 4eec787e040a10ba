"""Ratios of masses to the argon reading, and differences between oxygen loggers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from abyssal.functions.scalars import ratio_or_null
from abyssal.operators.asof import asof_join
from abyssal.schemas import ARGON, KEY


def ratio_to_mass(rga: DataFrame, reference: int = ARGON, keys: Sequence[str] = (KEY,), order: str = "pos") -> DataFrame:
    """Each reading over the reference-mass reading nearest in time (the earlier one on a tie).

    Masses never share a timestamp in a scan. Zero references and the reference mass itself drop out; the
    other columns of the reading (its context) stay.
    """
    ref = rga.where(F.col("mass") == reference).select(*keys, "ts", F.col("current").alias("__ref"), F.col(order).alias("__ord"))
    rows = asof_join(
        rga.where(F.col("mass") != reference), ref, keys, ["__ref"], direction="nearest", right_order="__ord"
    )
    return rows.where("__ref != 0").withColumn("ratio", F.col("current") / F.col("__ref")).drop("__ref")


def wide_ratio_to_mass(table: DataFrame, masses: Sequence[int], ts: str, reference: int = ARGON, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Long (ts, mass, ratio) from a wide table of averages; missing masses and zero references drop out."""
    ref = f"mass_{reference}_avg"
    have = [m for m in masses if m != reference and f"mass_{m}_avg" in table.columns]
    wide = table.select(*keys, F.col(ts).alias("ts"), *[ratio_or_null(F.col(f"mass_{m}_avg"), F.col(ref)).alias(str(m)) for m in have])
    long = wide.unpivot([*keys, "ts"], [str(m) for m in have], "mass", "ratio")
    return long.where("ratio IS NOT NULL").withColumn("mass", F.col("mass").cast("bigint"))


def scan_ratio(rows: DataFrame, reference: int, scan_keys: Sequence[str], value: str = "current") -> DataFrame:
    """Reading over the reference-mass reading of its own scan; null without one or at zero.

    A scan holds a mass once, so rows meet their reference in one shuffle, and are not read a second time for it.
    """
    # the scan first: rows are sorted by these columns, and the number tells them apart at once
    scan = Window.partitionBy(*reversed(scan_keys))
    ref = F.max(F.when(F.col("mass") == reference, F.col(value))).over(scan)
    return rows.withColumn("__ref", ref).withColumn("ratio", ratio_or_null(F.col(value), F.col("__ref"))).drop("__ref")


def mesocosm_difference(hobo: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """Mesocosm minus chamber oxygen, loggers paired by nearest time."""
    meso = hobo.where("location = 'mesocosm'").select(*keys, "ts", F.col("oxygen_mgl").alias("mesocosm_oxygen_mgl"))
    chambers = hobo.where("location NOT IN ('mesocosm', 'ambient')").select(*keys, "ts", "location", "oxygen_mgl")
    rows = asof_join(chambers, meso, keys, ["mesocosm_oxygen_mgl"], direction="nearest")
    # Deployments without a mesocosm logger have no difference series at all.
    return rows.where("mesocosm_oxygen_mgl IS NOT NULL").withColumn(
        "diff_mgl", F.col("mesocosm_oxygen_mgl") - F.col("oxygen_mgl")
    )
