"""Scalar, window, ordering and set functions on the derived streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from abyssal import standin
from abyssal.functions.common import micros, seconds_between, whole_minutes, whole_seconds
from abyssal.functions.scalars import (
    at_least, at_most, counts_to_amps, counts_to_torr, current_in_unit, fahrenheit_to_celsius, humanize_seconds, hydrogen_ion, jassby_platt, ratio_or_null,
)
from abyssal.operators.ratios import wide_ratio_to_mass
from abyssal.ordering import ordered_scan, time_slice
from abyssal.queries.averages import layer_c
from abyssal.queries.base import query
from abyssal.queries.ctes import MASSES
from abyssal.schemas import KEY

D = KEY
E = standin.events


@query("SCF01", f"{D} ts mass raw amps:4@1e16 torr:4@1e12", f"SELECT {D}, ts, mass, current AS raw, current * 1e-16 AS amps, current * 1e-16 / 8.01e-5 AS torr FROM rga")
def units(spark, d):
    return standin.rga(spark, d).withColumns({u: current_in_unit(F.col("current"), u, 8.01e-5) for u in ("raw", "amps", "torr")})


@query("SCF02", f"{D} ts total_pressure_amps:4@1e16 total_pressure_torr:4@1e12", f"""
SELECT {D}, ts, raw_total_pressure_current * 1e-16 AS total_pressure_amps, raw_total_pressure_current * 1e-16 / 1.34e-5 AS total_pressure_torr FROM status""")
def pressures(spark, d):
    raw = F.col("raw_total_pressure_current")
    return standin.status(spark, d).withColumns({"total_pressure_amps": counts_to_amps(raw), "total_pressure_torr": counts_to_torr(raw, 1.34e-5)})


@query("SCF03", "event_id ratio:6", "SELECT event_id, CASE WHEN k % 10 <> 0 THEN value / (k % 10) END AS ratio FROM ev")
def guarded_ratio(spark, d):
    return E(spark, d).withColumn("ratio", ratio_or_null(F.col("value"), F.col("k") % 10))


VARIABLES = ["oxygen_mgL", "temp_degC", "mass_28"]


@query("SCF04", f"{D} timestamp variable value:5", f"""
SELECT {D}, "timestamp", 'oxygen_mgL' AS variable, oxygen_mgL AS value FROM layer_c UNION ALL SELECT {D}, "timestamp", 'temp_degC', temp_degC FROM layer_c
UNION ALL SELECT {D}, "timestamp", 'mass_28', CASE WHEN mass_40_avg <> 0 THEN mass_28_avg / mass_40_avg END FROM layer_c""")
def selector(spark, d):
    c = layer_c(spark, d)
    cells = [F.struct(F.lit(v).alias("variable"), (ratio_or_null(F.col(f"{v}_avg"), F.col("mass_40_avg")) if v.startswith("mass") else F.col(v)).alias("value")) for v in VARIABLES]
    return c.select(D, "timestamp", F.explode(F.array(*cells)).alias("c")).select(D, "timestamp", "c.variable", "c.value")


@query("SCF05", f"{D} ts h:6@1e9", f"SELECT {D}, ts, pow(10.0::DOUBLE, -ph) AS h FROM scalup")
def hydrogen(spark, d):
    return standin.scalup(spark, d).withColumn("h", hydrogen_ion(F.col("ph")))


@query("SCF06", "event_id e:6 l:6 p:5", "SELECT event_id, exp(-k / 10.0::DOUBLE) AS e, ln(1 + value) AS l, pow(k::DOUBLE, 1.5) AS p FROM ev")
def powers(spark, d):
    k = F.col("k")
    return E(spark, d).withColumns({"e": F.exp(-k / 10), "l": F.ln(1 + F.col("value")), "p": F.pow(k, 1.5)})


@query("SCF07", "event_id flux:6", "SELECT event_id, 20 * tanh(0.5::DOUBLE * value / 20) - 3 AS flux FROM ev")
def saturation(spark, d):
    return E(spark, d).withColumn("flux", jassby_platt(F.col("value"), F.lit(20.0), F.lit(0.5), F.lit(3.0)))


@query("SCF08", "event_id low:6 high:6", "SELECT event_id, CASE WHEN k <> 5 THEN greatest(value - 20, 0) END AS low, CASE WHEN k <> 5 THEN least(value, 30) END AS high FROM ev")
def clips(spark, d):
    v = F.when(F.col("k") != 5, F.col("value"))
    return E(spark, d).withColumns({"low": at_least(v - 20, 0.0), "high": at_most(v, 30.0)})


@query("SCF09", "event_id inside listed missing same", """
SELECT event_id, k BETWEEN 10 AND 50 AS inside, event_type IN ('view', 'click') AS listed, x IS NULL AS missing, x IS NOT DISTINCT FROM (CASE WHEN k % 4 = 0 THEN k END) AS same
FROM (SELECT *, CASE WHEN k % 2 = 0 THEN k END AS x FROM ev)""")
def predicates(spark, d):
    k = F.col("k")
    x, y = F.when(k % 2 == 0, k), F.when(k % 4 == 0, k)
    return E(spark, d).withColumns({"inside": k.between(10, 50), "listed": F.col("event_type").isin("view", "click"), "missing": x.isNull(), "same": x.eqNullSafe(y)})


@query("SCF10", f"{D} ts oxygen:6", f"SELECT {D}, ts, coalesce(oxygen_mgl, 0.0) AS oxygen FROM scalup")
def filled(spark, d):
    return standin.scalup(spark, d).withColumn("oxygen", F.coalesce("oxygen_mgl", F.lit(0.0)))


@query("SCF11", f"{D} ts day seconds:6 whole", f"""
SELECT {D}, ts, CAST(ts AS DATE)::VARCHAR AS day, (epoch_us(ts) - epoch_us(ts_scalup)) / 1e6 AS seconds, (epoch_us(ts) - epoch_us(TIMESTAMP '2024-01-01')) // 1000000 AS whole FROM scalup""")
def date_parts(spark, d):
    origin = F.lit("2024-01-01").cast("timestamp_ntz")
    return standin.scalup(spark, d).withColumns({
        "day": F.to_date("ts").cast("string"), "seconds": seconds_between(F.col("ts_scalup"), F.col("ts")),
        "whole": whole_seconds(micros("ts") - micros(origin))})


@query("SCF12", "event_id c:6", "SELECT event_id, (k - 32) * 5 / 9.0::DOUBLE AS c FROM ev")
def celsius(spark, d):
    return E(spark, d).withColumn("c", fahrenheit_to_celsius(F.col("k")))


@query("SCF13", f"{D} window_start minutes:6", f"SELECT {D}, window_start, trunc(elapsed_us / 1e6) / 60 AS minutes FROM cycles60")
def minutes(spark, d):
    from abyssal.operators.cycles import cycle_windows

    return cycle_windows(standin.valve(spark, d), 60.0).withColumn("minutes", whole_minutes(F.col("elapsed_us")))


@query("SCF14", "event_id kind number starts", """
SELECT event_id, event_type AS kind, k AS number, event_type LIKE 's%' AS starts FROM ev""")
def strings(spark, d):
    from abyssal.functions.text import strip

    line = F.concat(F.lit(" \t"), "event_type", F.lit(" k="), F.col("k").cast("string"), F.lit(" \n"))
    e = E(spark, d).withColumn("line", strip(line))
    return e.select("event_id", F.split("line", " ")[0].alias("kind"), F.regexp_extract("line", r"k=(\d+)$", 1).cast("int").alias("number"), F.col("line").startswith("s").alias("starts"))


@query("SCF15", "event_id text", """
SELECT event_id, CASE WHEN s IS NULL THEN '' WHEN s // 86400 <> 0 THEN (s // 86400) || 'd ' || (s % 86400 // 3600) || 'h' WHEN s // 3600 <> 0 THEN (s // 3600) || 'h ' || (s % 3600 // 60) || 'm'
  WHEN s // 60 <> 0 THEN (s // 60) || 'm' ELSE s || 's' END AS text FROM (SELECT *, CASE WHEN k <> 9 THEN round_even(value * k * k, 0)::BIGINT END AS s FROM ev)""")
def durations(spark, d):
    seconds = F.when(F.col("k") != 9, F.col("value") * F.col("k") * F.col("k"))
    return E(spark, d).withColumn("text", humanize_seconds(seconds))


# --- window functions: previous, following, running values without one task per deployment ---------------


def _scan(spark, d, keys=(D,), **ops):
    df = standin.rga(spark, d).withColumn("t", micros("ts")).withColumn("slice", time_slice(F.col("t"), 86_400_000_000))
    return ordered_scan(df, list(keys), ["slice"], ["t", "pos"], **ops)


W = f"OVER (PARTITION BY {D} ORDER BY ts, pos)"
WM = f"OVER (PARTITION BY {D}, mass ORDER BY ts, pos)"


@query("WIN01", f"{D} ts mass before", f"SELECT {D}, ts, mass, lag(current) {W} AS before FROM rga")
def shift_back(spark, d):
    return _scan(spark, d, prev={"before": F.col("current")})


@query("WIN02", f"{D} ts mass after", f"SELECT {D}, ts, mass, lead(current) {W} AS after FROM rga")
def shift_ahead(spark, d):
    return _scan(spark, d, following={"after": F.col("current")})


@query("WIN03", f"{D} ts mass before", f"SELECT {D}, ts, mass, lag(current) {WM} AS before FROM rga")
def shift_in_group(spark, d):
    return _scan(spark, d, (D, "mass"), prev={"before": F.col("current")})


@query("WIN04", f"{D} ts mass diff:6", f"SELECT {D}, ts, mass, current - lag(current) {WM} AS diff FROM rga")
def differences(spark, d):
    return _scan(spark, d, (D, "mass"), prev={"before": F.col("current")}).withColumn("diff", F.col("current") - F.col("before"))


@query("WIN05", f"{D} ts mass i", f"SELECT {D}, ts, mass, row_number() {WM} - 1 AS i FROM rga")
def positions(spark, d):
    return _scan(spark, d, (D, "mass"), total={"n": F.lit(1)}).withColumn("i", F.col("n") - 1)


@query("WIN06", f"{D} ts mass centred:4", f"SELECT {D}, ts, mass, current - avg(current) OVER (PARTITION BY {D}, mass) AS centred FROM rga")
def group_means(spark, d):
    """The group mean comes from a map-side aggregate joined back, not from a window over the group."""
    rga = standin.rga(spark, d)
    means = rga.groupBy(D, "mass").agg(F.avg("current").alias("m"))
    return rga.join(means, [D, "mass"]).withColumn("centred", F.col("current") - F.col("m"))


@query("WIN07", f"{D} ts mass filled", f"""
SELECT {D}, ts, mass, coalesce(x, first_value(x IGNORE NULLS) OVER (PARTITION BY {D} ORDER BY ts, pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)) AS filled
FROM (SELECT *, CASE WHEN mass = 40 THEN current END AS x FROM rga)""")
def backward_fill(spark, d):
    x = F.when(F.col("mass") == 40, F.col("current"))
    return _scan(spark, d, following={"next": x}).withColumn("filled", F.coalesce(x, F.col("next")))


@query("WIN08", f"{D} mass first_current", f"SELECT {D}, mass, arg_min(current, ts) AS first_current FROM rga GROUP BY ALL")
def first_by_time(spark, d):
    return standin.rga(spark, d).groupBy(D, "mass").agg(F.min_by("current", "ts").alias("first_current"))


@query("ORD01", f"{D} timestamp chamber temp_degC:5", f'SELECT {D}, "timestamp", chamber, temp_degC FROM layer_c')
def sorted_output(spark, d):
    return layer_c(spark, d).orderBy(D, "timestamp")


@query("ORD03", f"{D} event_type event_id", f"SELECT {D}, event_type, arg_max(event_id, ts) AS event_id FROM ev GROUP BY ALL")
def latest(spark, d):
    return E(spark, d).groupBy(D, "event_type").agg(F.max_by("event_id", "ts").alias("event_id"))


@query("SET01", f"{D} ts source value:6", f"SELECT {D}, ts, 'scalup' AS source, temp_degc AS value FROM scalup UNION ALL SELECT {D}, ts, 'hobo', temp_degc FROM hobo")
def union_all(spark, d):
    pick = lambda df, n: df.select(D, "ts", F.lit(n).alias("source"), F.col("temp_degc").alias("value"))
    return pick(standin.scalup(spark, d), "scalup").unionByName(pick(standin.hobo(spark, d), "hobo"))


@query("SET02", f"{D} location", f"SELECT DISTINCT {D}, location FROM hobo")
def unique(spark, d):
    return standin.hobo(spark, d).select(D, "location").distinct()


@query("SET03", f"{D} C1:5 C2:5 mesocosm:5 ambient:5", f"""
SELECT {D}, {', '.join(f"avg(CASE WHEN location = '{c}' THEN oxygen_mgl END) AS {c}" for c in ('C1', 'C2', 'mesocosm', 'ambient'))} FROM hobo GROUP BY ALL""")
def pivoted(spark, d):
    return standin.hobo(spark, d).groupBy(D).pivot("location", ["C1", "C2", "mesocosm", "ambient"]).agg(F.avg("oxygen_mgl"))


@query("SET04", f"{D} ts sensor temp_c:6", f"""
{' UNION ALL '.join(f"SELECT {D}, ts, '{c}' AS sensor, {c} AS temp_c FROM status" for c in ('turbo_etemp_c', 'turbo_btemp_c', 'turbo_mtemp_c'))}""")
def unpivoted(spark, d):
    return standin.status(spark, d).unpivot([D, "ts"], ["turbo_etemp_c", "turbo_btemp_c", "turbo_mtemp_c"], "sensor", "temp_c")


@query("SET05", f"{D} ts mass ratio:5", f"""
SELECT * FROM ({' UNION ALL '.join(f'SELECT {D}, "timestamp" AS ts, {m}::BIGINT AS mass, CASE WHEN mass_40_avg <> 0 THEN mass_{m}_avg / mass_40_avg END AS ratio FROM layer_c' for m in MASSES if m != 40)}) WHERE ratio IS NOT NULL""")
def wide_ratios(spark, d):
    return wide_ratio_to_mass(layer_c(spark, d), MASSES, "timestamp")


