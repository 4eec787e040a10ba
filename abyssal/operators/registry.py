"""Deployment registry: rule violations and the resolution of processing parameters."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.schemas import DEFAULTS, KEY

CONDITIONS = ("grass", "sediment", "none")
# Each group is one quantity, given by at most one of its keys.
GROUPS = {
    "chamber_area_m2": "area", "chamber_volume_l": "depth", "chamber_height_m": "depth", "settle_offset_s": "settle",
    "partial_pressure_sensitivity_a_per_torr": "partial_pressure", "total_pressure_sensitivity_a_per_torr": "total_pressure",
    "n2_ar_sensitivity_ratio": "n2_ar", "par_time_offset_h": "par_offset", "dark_par_threshold_umol_m2_s": "dark_par",
    "min_par_coverage": "par_coverage", "metabolism_min_r2": "min_r2", "chamber_par_transmittance": "transmittance",
}
POSITIVE = (
    "chamber_area_m2", "chamber_volume_l", "chamber_height_m", "partial_pressure_sensitivity_a_per_torr",
    "total_pressure_sensitivity_a_per_torr", "n2_ar_sensitivity_ratio", "chamber_par_transmittance",
)
SOURCES = ("argument", "deployment", "config", "default")


def _rule(df: DataFrame, broken: Column, rule: str, detail: Column) -> DataFrame:
    return df.where(broken).select(KEY, F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def deployment_violations(deployments: DataFrame, given: DataFrame) -> DataFrame:
    """Every broken rule as a row, all at once; an empty result means the batch may start.

    `deployments` has the catalogue columns plus `path`; `given` is (deployment_id, key, value).
    """
    d, missing = deployments, []
    for c in ("site", "start", "c1", "c2", "test"):
        missing.append(_rule(d, F.col(c).isNull(), "missing required key", F.lit(c)))
    vocabulary = [_rule(d, ~F.col(c).isin(*CONDITIONS), f"{c} not in vocabulary", F.col(c)) for c in ("c1", "c2")]
    order = _rule(d, F.col("end") <= F.col("start"), "end must be after start", F.col("end"))
    positive = _rule(given, F.col("key").isin(*POSITIVE) & ~(F.col("value") > 0), "must be a positive number", F.col("key"))
    unknown = _rule(given, ~F.col("key").isin(*GROUPS), "unknown processing key", F.col("key"))
    grouped = given.withColumn("group", group_of(F.col("key"))).where("group IS NOT NULL")
    double = grouped.groupBy(KEY, "group").agg(F.count_distinct("key").alias("n")).where("n > 1")
    double = double.select(KEY, F.lit("give only one key of a group").alias("rule"), F.col("group").alias("detail"))
    used = d.groupBy(KEY).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    used = used.select(KEY, F.lit("id used by more than one folder").alias("rule"), F.col("n").cast("string").alias("detail"))
    return reduce(lambda a, b: a.unionByName(b), [*missing, *vocabulary, order, positive, unknown, double, used, nested_folders(d)])


def nested_folders(deployments: DataFrame) -> DataFrame:
    """Deployments whose folder contains another one: every ancestor of a path looked up by equality."""
    parts = F.split("path", "/")
    ancestors = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts) - 1), lambda i: F.array_join(F.slice(parts, 1, i), "/")))
    inner = deployments.where("contains(path, '/')").select(F.col("path").alias("inner_path"), ancestors.alias("path"))
    return deployments.join(inner, "path").select(
        KEY, F.lit("contains another deployment").alias("rule"), F.col("inner_path").alias("detail")
    )


def group_of(key: Column) -> Column:
    out = F.lit(None).cast("string")
    for k, g in GROUPS.items():
        out = F.when(key == k, F.lit(g)).otherwise(out)
    return out


def resolve_processing(
    deployments: DataFrame, given: DataFrame, overrides: dict[str, float | None] | None = None,
    config: dict[str, float] | None = None, defaults: dict[str, float] = DEFAULTS,
) -> DataFrame:
    """Each deployment's parameters with their source: argument, then deployment, then config, then default.

    Per group, so a height given as an argument displaces a volume from further down.
    """
    layers = [("argument", {k: v for k, v in (overrides or {}).items() if v is not None}), ("config", config or {}), ("default", defaults)]
    ids = deployments.select(KEY).distinct()
    rows = [given.where(F.col("key").isin(*GROUPS)).select(KEY, "key", "value", F.lit(1).alias("rank"))]
    for source, values in layers:
        known = [F.struct(F.lit(k).alias("key"), F.lit(float(v)).alias("value")) for k, v in values.items() if k in GROUPS]
        if known:
            rows.append(ids.select(KEY, F.explode(F.array(*known)).alias("p")).select(
                KEY, "p.key", "p.value", F.lit(SOURCES.index(source)).alias("rank")))
    layered = reduce(lambda a, b: a.unionByName(b), rows).withColumn("group", group_of(F.col("key")))
    best = layered.groupBy(KEY, "group").agg(F.min_by(F.struct("key", "value", "rank"), "rank").alias("p"))
    source = F.element_at(F.array(*[F.lit(s) for s in SOURCES]), F.col("p.rank") + 1)
    return best.select(KEY, "group", "p.key", "p.value", source.alias("source"))


def processing_table(resolved: DataFrame) -> DataFrame:
    """One row per deployment with the parameters as columns, geometry completed."""
    from abyssal.operators.fluxes import chamber_geometry

    wide = resolved.groupBy(KEY).pivot("key", list(GROUPS)).agg(F.first("value"))
    return chamber_geometry(wide)
