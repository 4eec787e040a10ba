"""The whole batch over an archive: raw folders in, all tables of every deployment out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from abyssal.functions.common import use_utc, write_and_read
from abyssal.operators.aggregate import aggregate_onto_windows, discover_masses
from abyssal.operators.cycles import attach_chamber_context, candidate_statistics, cycle_candidates, long_enough, scan_windows
from abyssal.operators.fluxes import daily_par
from abyssal.operators.ranges import clip, with_condition
from abyssal.operators.registry import deployment_violations, processing_table, resolve_processing
from abyssal.plans.recompute import in_torr, layers_from_streams
from abyssal.schemas import KEY
from abyssal.sources.loggers import read_hobo, read_par
from abyssal.sources.logs import read_log_tables
from abyssal.sources.tables import commit, durations_to_seconds, load_run, new_run, run_summary, write_table


class RegistryError(ValueError):
    """The deployment table breaks its rules; nothing was written."""


def run_batch(
    spark: SparkSession, raw_root: str, out: str, deployments: DataFrame, given: DataFrame, calibrations: DataFrame,
    overrides: dict[str, float] | None = None, config: dict[str, float] | None = None, fmt: str = "parquet",
    par_root: str | None = None, hobo_root: str | None = None, par_start: Column | None = None, par_end: Column | None = None,
) -> DataFrame:
    """Process every deployment below `raw_root` and return the run summary.

    Files belong to the deepest folder that is named like a deployment. Logger exports are read from `par_root` and `hobo_root`
    where these are given; `par_start` and `par_end` trim the light readings. Inputs that are absent give empty tables.

    Stages meet in written tables: a later stage reads what an earlier one wrote, so lost executors redo
    one stage only and the optimiser knows every table's real size.
    """
    use_utc(spark)
    out = out.rstrip("/")
    if raw_root.rstrip("/") == out:
        raise ValueError("output must differ from the raw root")
    broken = deployment_violations(deployments, given)
    _refuse(broken.select(KEY, "rule", "detail"), out)
    parameters = processing_table(resolve_processing(deployments, given, overrides, config))
    _refuse(parameters.where("problem IS NOT NULL").select(KEY, F.lit("parameter").alias("rule"), F.col("problem").alias("detail")), out)
    run = new_run()

    def stage(df: DataFrame, name: str) -> DataFrame:
        write_table(df, out, name, fmt, run)
        return load_run(spark, out, name, fmt, run, durations_to_seconds(df).schema)

    ids = [r[0] for r in deployments.select(KEY).distinct().collect()]
    deployments = stage(deployments.drop("path"), "deployment")
    parameters = stage(parameters.drop("problem"), "processing")

    tables = {name: stage(df, name) for name, df in read_log_tables(spark, raw_root, staged=True, ids=ids).items()}
    par = stage(read_par(spark, par_root or raw_root, calibrations, parameters, par_start, par_end, ids), "par")
    daily = stage(daily_par(par), "par_daily")
    hobo = stage(read_hobo(spark, hobo_root or raw_root, ids), "hobo_oxygen")

    clipped = {n: clip(df, deployments) for n, df in {**tables, "par": par}.items() if n != "system_health"}
    masses = discover_masses(clipped["rga"])
    settle = parameters.select(KEY, "settle_offset_s")
    # Written, because the windows and the summary count them, and the scans because the match below reads them twice.
    candidates = write_and_read(cycle_candidates(clipped["valve"].join(settle, KEY), "settle_offset_s"))
    windows = stage(long_enough(candidates), "cycle_windows")
    streams = {n: clipped[n] for n in ("rga", "scalup", "status", "par")}
    scans = stage(attach_chamber_context(write_and_read(scan_windows(clipped["rga"])), windows), "scan_windows")
    layer_b = in_torr(aggregate_onto_windows(scans, streams, masses, 1.0, 1.0), parameters, masses, [KEY])
    layer_b = stage(layer_b, "rga_scans")
    conditioned = lambda df, name: stage(with_condition(df, deployments) if name != "chamber_cycles" else df, name)
    layers = layers_from_streams(streams, clipped["valve"], parameters, masses, windows=windows, fit=True, stage=conditioned)
    cycles, fluxes, metabolism, pi_fit = (layers[n] for n in ("chamber_cycles", "fluxes", "metabolism", "pi_fit"))
    produced = {**tables, "par": par, "par_daily": daily, "hobo_oxygen": hobo, "rga_scans": layer_b, "chamber_cycles": cycles,
                "fluxes": fluxes, "metabolism": metabolism, "pi_fit": pi_fit}
    summary = write_and_read(run_summary(produced, candidate_statistics(candidates)))
    # the earlier output counts until here, and this run's from here
    commit(spark, out, run, deployments, fmt)
    return summary


def _refuse(violations: DataFrame, out: str) -> None:
    """Write all violations as a table and raise, if there are any."""
    found = write_and_read(violations)
    n = found.count()
    if n:
        place = f"{out.rstrip('/')}/violations"
        found.write.mode("overwrite").parquet(place)
        some = "; ".join(f"{r[KEY]}: {r['rule']} ({r['detail']})" for r in found.orderBy(KEY, "rule").limit(5).collect())
        raise RegistryError(f"{n} violations, all listed in {place}; first: {some}")
