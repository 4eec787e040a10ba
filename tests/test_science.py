import math
from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from abyssal.functions.seawater import gas_solubility, n2_ar_sensitivity, seawater_density
from abyssal.operators import stats, fluxes, metabolism, quality, spread
from abyssal.sources import loggers
from tests.helpers import at, values


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_published_solubility_and_density_values(spark):
    lit = F.lit
    assert _one(spark, gas_solubility("Ar", lit(10.0), lit(35.0))) == pytest.approx(13.4622, rel=1e-5)
    assert _one(spark, gas_solubility("N2", lit(10.0), lit(35.0))) == pytest.approx(500.885, rel=1e-5)
    for t, s, want in [(0.0, 0.0, 999.842594), (30.0, 0.0, 995.65113374), (0.0, 35.0, 1028.10633141), (30.0, 35.0, 1021.72863949)]:
        assert _one(spark, seawater_density(lit(t), lit(s))) == pytest.approx(want / 1000, rel=1e-9)
    ratio = gas_solubility("N2", lit(12.0), lit(30.0)) / gas_solubility("Ar", lit(12.0), lit(30.0))
    assert _one(spark, n2_ar_sensitivity(ratio * 1.2, lit(12.0), lit(30.0))) == pytest.approx(1.2)


def _cycles(spark, rows, columns):
    data = [("d", e, c, at(m * 60), int(m * 60e6), *v) for e, c, m, *v in rows]
    spec = ", ".join(f"{c} DOUBLE" for c in columns)
    return spark.createDataFrame(data, f"deployment_id STRING, experiment_number BIGINT, chamber STRING, timestamp TIMESTAMP_NTZ, elapsed_us BIGINT, {spec}")


def test_n2_uses_the_first_cycles_argon_and_skips_zero_argon(spark):
    c = _cycles(spark, [(1, "C1", 0, 100.0, 1000.0, 10.0, 32.0), (1, "C1", 1, 999.0, 0.0, 12.0, 32.0), (1, "C1", 2, 120.0, 1000.0, 14.0, 32.0)],
                ["mass_28_avg", "mass_40_avg", "temp_degC", "sal_PSU"])
    out = {r.variable: r for r in fluxes.compute_fluxes(c, 4.0, 0.06).collect()}
    argon = _one(spark, gas_solubility("Ar", F.lit(10.0), F.lit(32.0)) * seawater_density(F.lit(10.0), F.lit(32.0)))
    n2 = out["n2_denitrification"]
    assert n2.n_points == 2 and n2.slope_native_per_min == pytest.approx(0.02 * argon / 2)
    assert n2.output_value == pytest.approx(n2.slope_native_per_min * 1e-3 * 4.0 / 0.06 * 60)
    assert out["temp_degC"].output_value == pytest.approx(2.0 * 60) and set(out) == {"n2_denitrification", "temp_degC"}


def test_oxygen_flux_sign_and_rejected_geometry(spark):
    c = _cycles(spark, [(1, "C1", 0, 8.0), (1, "C1", 1, 7.0), (1, "C2", 0, 8.0)], ["oxygen_mgL"])
    row = fluxes.compute_fluxes(c, 4.0, 0.06).collect()
    assert [(r.chamber, r.variable, r.r2) for r in row] == [("C1", "oxygen", 1.0)]
    assert row[0].output_value == pytest.approx(-1.0 / 32 * 4.0 / 0.06 * 60)
    with pytest.raises(ValueError):
        fluxes.compute_fluxes(c, 0.0, 0.06)


def test_experiment_light_mean_integral_and_coverage(spark):
    spans = spark.createDataFrame([("d", 1, at(0), at(1200)), ("d", 2, at(3600), at(4800))],
                                  "deployment_id STRING, experiment_number BIGINT, experiment_start TIMESTAMP_NTZ, experiment_end TIMESTAMP_NTZ")
    par = spark.createDataFrame([("d", at(m * 60), v, 300.0) for m, v in [(0, 100.0), (5, 200.0), (10, 300.0), (15, 400.0), (20, 999.0), (40, 999.0), (65, None)]],
                                "deployment_id STRING, ts TIMESTAMP_NTZ, par_umol_m2_s DOUBLE, interval_s DOUBLE")
    out = fluxes.experiment_par(par, spans).collect()
    assert [(r.experiment_number, r.par_mean_umol_m2_s, r.par_coverage) for r in out] == [(1, 250.0, 1.0)]
    assert out[0].par_integrated_mol_m2 == pytest.approx(1000 * 300 / 1e6)


def _fluxes(spark, rows):
    data = [("d", i, ch, at(i), "oxygen", 1.0, float(o2), par, 0.0, 1.0) for i, (ch, par, o2) in enumerate(rows)]
    return spark.createDataFrame(data, "deployment_id STRING, experiment_number BIGINT, chamber STRING, experiment_start TIMESTAMP_NTZ, variable STRING, r2 DOUBLE, "
                                       "output_value DOUBLE, par_mean_umol_m2_s DOUBLE, par_integrated_mol_m2 DOUBLE, par_coverage DOUBLE")


def test_light_curve_recovers_known_parameters_per_chamber(spark):
    par = [0.5, 3.0, 9.0, 15.0, 40.0, 90.0, 160.0, 300.0, 450.0, 700.0, 1000.0, 1300.0]
    curve = lambda p, a, r: [p * math.tanh(a * i / p) - r for i in par]
    rows = [("C1", i, v) for i, v in zip(par, curve(1500, 6, 250))] + [("C2", i, v) for i, v in zip(par, curve(2600, 12, 400))] + [("C3", 4.0, -80), ("C3", 620.0, 500), ("C4", None, 1)]
    out = {r.chamber: r for r in metabolism.fit_pi_curves(metabolism.classify_o2_fluxes(_fluxes(spark, rows))).collect()}
    assert set(out) == {"C1", "C2", "C3"}
    for ch, (p, a, r) in {"C1": (1500, 6, 250), "C2": (2600, 12, 400)}.items():
        row = out[ch]
        assert row.converged and (row.n_light, row.n_dark) == (8, 4)
        assert (row.pmax_mmol_m2_h, row.alpha_mmol_m2_h_per_par, row.r_fit_mmol_m2_h) == pytest.approx((p, a, r), rel=1e-4)
        assert row.ik_umol_m2_s == pytest.approx(p / a, rel=1e-4) and row.fit_r2 == pytest.approx(1.0)
    assert not out["C3"].converged and out["C3"].pmax_mmol_m2_h is None and out["C3"].r_dark_mmol_m2_h == 80.0


def _brute_curve(i, y):
    """Best (sse, ln k) by a fine search over ln k between the operator's limits, Pmax >= 0 by a straight line for each."""
    i, y = np.array(i), np.array(y)
    lo, hi = math.log(1e-3 / i.max()), math.log(6.0 / i[i > 0].min())
    best = (((y - y.mean()) ** 2).sum(), None)
    for u in np.linspace(lo, hi, 4001):
        x = np.tanh(np.exp(u) * i)
        p = ((x - x.mean()) * (y - y.mean())).sum() / ((x - x.mean()) ** 2).sum()
        if p > 1e-9:
            best = min(best, (((y - y.mean() - p * (x - x.mean())) ** 2).sum(), u))
    return *best, lo, hi


def test_light_curves_converge_on_their_bounds(spark):
    par = [0.0, 0.5, 4.0, 15.0, 40.0, 90.0, 160.0, 300.0, 700.0, 1300.0]
    rng = np.random.default_rng(8)
    shapes = {
        "noisy": [900 * math.tanh(5 * i / 900) - 100 + e for i, e in zip(par, rng.normal(0, 60, 10))],
        "straight": [0.7 * i - 20 for i in par],
        "bent up": [1e-3 * i * i - 20 for i in par],
        "saturated": [-50.0] + [400.0] * 9,
        "falling": [500 - 0.3 * i for i in par],
        "level": [5.0] * 10,
        "wild": list(rng.normal(0, 300, 10)),
    }
    rows = [(name, i, v) for name, values in shapes.items() for i, v in zip(par, values)]
    out = {r.chamber: r for r in metabolism.fit_pi_curves(metabolism.classify_o2_fluxes(_fluxes(spark, rows))).collect()}
    for name, y in shapes.items():
        row, (sse, u, lo, hi) = out[name], _brute_curve(par, y)
        assert row.converged, name
        p, a, r = row.pmax_mmol_m2_h, row.alpha_mmol_m2_h_per_par, row.r_fit_mmol_m2_h
        got = sum((v - (p * math.tanh(a * i / p) - r)) ** 2 for i, v in zip(par, y))
        assert got <= sse * (1 + 1e-6) + 1e-3, name
        assert p >= 1e-9 and a >= 1e-9
        if u in (lo, hi) or u is None:
            assert row.pmax_se is None, name
    assert out["straight"].alpha_mmol_m2_h_per_par == pytest.approx(0.7, rel=1e-5) and out["straight"].pmax_mmol_m2_h > 900_000
    assert out["saturated"].pmax_mmol_m2_h == pytest.approx(450, rel=1e-4) and out["noisy"].pmax_se > 0
    assert (out["falling"].pmax_mmol_m2_h, out["falling"].r_fit_mmol_m2_h) == (1e-9, pytest.approx(-np.mean(shapes["falling"])))


def test_f_tail_known_values():
    # F(1, d) is the square of Student's t; F(2, d) has the closed form (1 + 2 x / d)^(-d/2).
    got = spread.f_tail_values(np.array([4.0, 0.5, 30.0]), np.array([2.0, 2.0, 2.0]), np.array([10.0, 7.0, 50.0]))
    assert got == pytest.approx([(1 + 0.8) ** -5, (1 + 1 / 7) ** -3.5, (1 + 60 / 50) ** -25], rel=1e-10)
    assert spread.f_tail_values(np.array([1.0]), np.array([5.0]), np.array([5.0])) == pytest.approx([0.5])


def test_noise_model_recovers_its_terms(spark):
    s = [10.0 ** (i / 4) for i in range(4, 29)]
    rows = [("d", x, math.sqrt(12.0**2 + 3 * x + (0.05 * x) ** 2)) for x in s]
    df = spark.createDataFrame(rows, "deployment_id STRING, current_raw_mean DOUBLE, current_raw_noise DOUBLE")
    row = spread.fit_noise_model(df).first()
    assert (row.floor, row.shot, row.prop) == pytest.approx((12.0, 3.0, 0.05), rel=1e-3)
    assert spread.fit_noise_model(df.limit(2)).count() == 0


def _times(spark, seconds, table="status"):
    return spark.createDataFrame([("d", table, None, at(s)) for s in seconds], "deployment_id STRING, table STRING, group STRING, ts TIMESTAMP_NTZ")


def test_gaps_inside_leading_trailing_and_whole_range(spark):
    limit = spark.createDataFrame([("d", "status", 8.0, 60.0)], "deployment_id STRING, table STRING, nominal_interval_s DOUBLE, gap_threshold_s DOUBLE")
    bounds = lambda a, b: spark.createDataFrame([("d", at(a), at(b))], "deployment_id STRING, lo TIMESTAMP_NTZ, hi TIMESTAMP_NTZ")
    inner = _times(spark, [i * 7 for i in range(60) if not 25 <= i < 40])
    assert values(quality.find_gaps(inner, limit), "gap_start", "gap_end", "gap_s") == [(at(168), at(280), 112.0)]
    late = _times(spark, [240 + i * 12 for i in range(8)])
    assert values(quality.find_gaps(late, limit, bounds(0, 900)), "gap_start", "gap_s") == [(at(0), 240.0), (at(324), 576.0)]
    none = quality.find_gaps(late, limit, bounds(4000, 6400))
    assert values(none, "group", "gap_start", "gap_s") == [(None, at(4000), 2400.0)]


def test_range_flags_are_inclusive(spark):
    df = spark.createDataFrame([(v,) for v in [-1.5, -1.0, 0.99, 1.0, 15.0, 15.5, 20.0, 20.25, None, float("nan")]], "v DOUBLE")
    got = [r[0] for r in df.select(quality.range_flag(F.col("v"), (-1.0, 20.0, 1.0, 15.0))).collect()]
    assert got == ["fail", "suspect", "suspect", "pass", "pass", "suspect", "suspect", "fail", "missing", "missing"]


PAR_EXPORT = "﻿Site Name ,harbour\r\nLogger Serial Number ,50472\r\n\r\nScan No ,Date and Time\r\n , ,RAW VALUE ,CALIBRATED VALUE,\r\n1,18/09/2026 , 16:11:14,2223,2223\r\n2,18/09/2026 , 16:16:14,0,0\r\ngarbled\r\n3,18/09/2026 , 16:21:14,3293,3293"
HOBO_EXPORT = ('﻿"Plot Title: C1"\r\n"#","Date Time, GMT-04:30","DO conc, mg/L (LGR S/N: 20113801)","Temp, °F (LGR S/N: 20113801)","Stopped"\r\n'
               "1,09/23/26 11:00:00 AM,8.73,73.58,\r\n2,09/23/26 11:02:00 AM,-888.88,-888.88,Logged\r\n3,09/23/26 11:02:40 AM,,,Logged")


def test_logger_exports(spark, tmp_path):
    dep = tmp_path / "dep"
    dep.mkdir()
    (dep / "a.CSV").write_bytes(PAR_EXPORT.encode())
    (dep / "h.csv").write_bytes(HOBO_EXPORT.encode())
    (dep / "gems_pump.csv").write_text("ts,rpm\n1,2\n")
    cal = spark.createDataFrame([(1, "50472", None, None, 0.4647, 6.4541, None)], "sensor_number BIGINT, serial_number STRING, cal_date DATE, interval_s DOUBLE, slope DOUBLE, intercept DOUBLE, notes STRING")
    par = loggers.read_par(spark, str(tmp_path), cal, 4.0).orderBy("scan_no").collect()
    assert [(r.scan_no, r.par_raw, r.interval_s) for r in par] == [(1, 2223.0, 300.0), (2, 0.0, 300.0), (3, 3293.0, 300.0)]
    assert par[0].ts == datetime(2026, 9, 18, 20, 11, 14) and par[0].par_umol_m2_s == pytest.approx(0.4647 * 2223 + 6.4541)
    wrong = cal.withColumn("interval_s", F.lit(900.0))
    assert all(r.par_umol_m2_s is None for r in loggers.read_par(spark, str(tmp_path), wrong).collect())
    hobo = loggers.read_hobo(spark, str(tmp_path)).collect()
    assert [(r.ts, r.location, r.oxygen_mgl, r.serial_number) for r in hobo] == [(datetime(2026, 9, 23, 15, 30), "C1", 8.73, "20113801")]
    assert hobo[0].temp_degc == pytest.approx((73.58 - 32) * 5 / 9)


def test_adjusted_p_values_leave_nulls_out(spark):
    rows = [("d", 1, None), ("d", 2, 0.01), ("d", 3, 0.04), ("e", 1, None)]
    out = spread.benjamini_hochberg(spark.createDataFrame(rows, "deployment_id STRING, mass INT, p_value DOUBLE"))
    assert sorted((r.deployment_id, r.mass, r.p_adj) for r in out.collect()) == [("d", 1, None), ("d", 2, 0.02), ("d", 3, 0.04), ("e", 1, None)]


def test_exact_median_of_odd_values(spark):
    inf = float("inf")
    groups = {"near": [300 + i * 1e-9 for i in range(1001)], "inf": [inf, 1.0, 2.0, -inf, 5.0], "two": [-3.0, 4.0], "zero": [0.0, 0.0, -0.5, 1e-320], "high": [inf, inf, 1.0]}
    df = spark.createDataFrame([(k, v) for k, vs in groups.items() for v in [*vs, None, float("nan")]], "k STRING, v DOUBLE")
    got = {r.k: r.m for r in stats.exact_median(df, ["k"], F.col("v"), "m").collect()}
    assert got == pytest.approx({k: float(np.median(vs)) for k, vs in groups.items()})


def test_noise_model_against_a_search(spark):
    """Noisy holds of three instruments: all terms, no shot term, floor alone; least squares by a zooming grid search."""
    rng = np.random.default_rng(9)
    terms = {"all": (30.0, 2.0, 0.02), "noshot": (50.0, 0.0, 0.05), "floor": (40.0, 0.0, 0.0)}
    holds = {k: [(float(s), float(math.sqrt(f * f + h * s + (p * s) ** 2) * math.exp(rng.normal(0, 0.1)))) for s in np.geomspace(10, 1e5, 40)] for k, (f, h, p) in terms.items()}
    rows = [(k, s, n) for k, v in holds.items() for s, n in v] + [("few", 1.0, 1.0), ("few", 2.0, 1.0)]
    got = {r.deployment_id: r for r in spread.fit_noise_model(spark.createDataFrame(rows, "deployment_id STRING, current_raw_mean DOUBLE, current_raw_noise DOUBLE")).collect()}
    assert set(got) == set(terms)
    for k, v in holds.items():
        s, y = np.array(v).T

        def sse(u):
            return ((np.log(y) - 0.5 * np.log(np.exp(u[0]) + np.exp(u[1]) * s + np.exp(u[2]) * s * s)) ** 2).sum()

        best, width = np.array([7.0, 0.0, -8.0]), 8.0
        for _ in range(40):
            grid = [best + width * np.array(d) for d in np.ndindex(5, 5, 5) for d in [(np.array(d) - 2) / 2]]
            best, width = min(grid + [best], key=sse), width * 0.7
        r = got[k]
        own = ((np.log(y) - 0.5 * np.log(r.floor**2 + r.shot * s + (r.prop * s) ** 2)) ** 2).sum()
        assert own == pytest.approx(r.sse, rel=1e-9) and own <= sse(best) * (1 + 1e-4), k
        assert r.floor >= 0 and r.shot >= 0 and r.prop >= 0
    assert got["all"].floor == pytest.approx(30, rel=0.2) and got["all"].prop == pytest.approx(0.02, rel=0.2)
