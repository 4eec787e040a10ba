"""Common table expressions of the checking SQL (DuckDB): the derived streams and the shared layers."""

from __future__ import annotations

MASSES = (2, 18, 28, 32, 40, 44)
SPAN = "PARTITION BY deployment_id ORDER BY pos"
CTES: dict[str, str] = {}

CTES["ev"] = """
SELECT event_id, ts, user_id, event_type, value, k, user_id % 8 AS n, 'd' || (user_id % 8) AS deployment_id,
       2 * xor(event_id, s) + s AS arrival
FROM (SELECT *, CASE WHEN k < 10 THEN 1::BIGINT ELSE 0::BIGINT END AS s
      FROM (SELECT *, CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k FROM events))"""
CTES["rga"] = """
SELECT deployment_id, ts + j * INTERVAL 5 SECOND AS ts, ([2, 18, 28, 32, 40, 44][j + 1])::BIGINT AS mass,
       CASE WHEN j = 4 AND k = 50 THEN 0.0 ELSE floor(value * 100) * (j + 1) + k END AS current, arrival * 8 + j AS pos
FROM ev, (SELECT unnest([0, 1, 2, 3, 4, 5]) AS j) WHERE k % 7 <> j"""
CTES["valve"] = """
SELECT deployment_id, ts,
       CASE event_type WHEN 'click' THEN 'C2' WHEN 'signup' THEN 'C2' ELSE 'C1' END AS chamber,
       CASE event_type WHEN 'view' THEN 'Re' WHEN 'click' THEN 'Re' WHEN 'error' THEN 'Unknown' ELSE 'Fl' END AS flush_state,
       arrival AS pos FROM ev"""
CTES["scalup"] = """
SELECT deployment_id, ts + INTERVAL 10 SECOND AS ts, ts AS ts_scalup, 10 + k / 10.0::DOUBLE AS temp_degc, 30 + k / 50.0::DOUBLE AS sal_psu,
       1000 + value AS pressure_mbar, CASE WHEN k % 25 <> 0 THEN value / 20 END AS oxygen_mgl, 7.5::DOUBLE + k / 200.0::DOUBLE AS ph,
       CAST(NULL AS BIGINT) AS field_mask, arrival AS pos FROM ev"""
CTES["status"] = """
SELECT deployment_id, ts + INTERVAL 20 SECOND AS ts, CASE WHEN k = 99 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS turbo_error,
       (1100 + k * 2)::DOUBLE AS turbo_speed_hz, 50 + k / 10.0::DOUBLE AS turbo_power_w, 30 + k / 10.0::DOUBLE AS turbo_etemp_c,
       25 + k / 10.0::DOUBLE AS turbo_btemp_c, 24 + k / 10.0::DOUBLE AS turbo_mtemp_c,
       floor(value * 10) AS raw_total_pressure_current, (8000 + k)::DOUBLE AS pump_rpm, arrival AS pos FROM ev"""
CTES["system_health"] = """
SELECT deployment_id, ts + INTERVAL 30 SECOND AS ts, 20 + k / 10.0::DOUBLE AS voltage_v, k / 1000.0::DOUBLE AS current_a,
       40 + k / 2.0::DOUBLE AS teensy_temp_c FROM ev"""
CTES["par"] = """
SELECT deployment_id, ts + INTERVAL 40 SECOND AS ts, event_id AS scan_no, raw AS par_raw,
       CASE WHEN n <> 7 THEN greatest(0.0::DOUBLE, raw * 0.5::DOUBLE - 2.0::DOUBLE) END AS par_umol_m2_s, '50472' AS serial_number, 1800.0::DOUBLE AS interval_s
FROM (SELECT *, CASE WHEN hour(ts) BETWEEN 6 AND 17 THEN floor(value * 20) ELSE (k % 7)::DOUBLE END AS raw FROM ev)"""
CTES["hobo"] = """
SELECT deployment_id, ts + INTERVAL 50 SECOND AS ts, ['C1', 'C2', 'mesocosm', 'ambient'][k % 4 + 1] AS location, value / 20 AS oxygen_mgl,
       10 + k / 10.0::DOUBLE AS temp_degc, '2011' || (k % 4) AS serial_number FROM ev"""
CTES["dep"] = """
SELECT deployment_id, n, 'site' || (n % 3) AS site, min(ts) + INTERVAL 12 HOUR AS start,
       CASE WHEN n <> 3 THEN max(ts) - INTERVAL 12 HOUR END AS "end", n = 5 AS test,
       ['grass', 'sediment', 'none'][(n % 3 + 1)::INT] AS c1, ['grass', 'sediment', 'none'][((n + 1) % 3 + 1)::INT] AS c2
FROM ev GROUP BY deployment_id, n"""
CTES["given"] = """
SELECT DISTINCT deployment_id, 'settle_offset_s' AS key, (30 + 10 * n)::DOUBLE AS value FROM ev WHERE n < 4
UNION ALL SELECT DISTINCT deployment_id, 'chamber_height_m', 0.1::DOUBLE + n / 100.0::DOUBLE FROM ev WHERE n IN (2, 5)
UNION ALL SELECT DISTINCT deployment_id, 'chamber_volume_l', 28.0::DOUBLE FROM ev WHERE n = 6
UNION ALL SELECT DISTINCT deployment_id, 'n2_ar_sensitivity_ratio', 1.2::DOUBLE FROM ev WHERE n = 1"""

# Transitions and experiments.
CTES["transitions"] = f"""
SELECT * EXCLUDE (pc, pf) FROM (SELECT *, lag(chamber) OVER ({SPAN}) AS pc, lag(flush_state) OVER ({SPAN}) AS pf FROM valve)
WHERE pc IS NULL OR pc <> chamber OR pf <> flush_state"""
CTES["markers"] = f"""
SELECT *, CASE WHEN chamber = 'C1' AND flush_state = 'Re' THEN 1 WHEN chamber = 'C2' AND flush_state = 'Fl' AND re_before > 0 THEN 2 END AS marker
FROM (SELECT *, lead(ts) OVER ({SPAN}) AS next_ts,
      coalesce(sum(CASE WHEN flush_state = 'Re' THEN 1 ELSE 0 END) OVER ({SPAN} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS re_before
      FROM transitions)"""
CTES["labelled"] = f"""
SELECT *, CASE WHEN no > 0 THEN no::BIGINT END AS experiment_number FROM (
  SELECT *, sum(CASE WHEN starts THEN 1 ELSE 0 END) OVER ({SPAN} ROWS UNBOUNDED PRECEDING) AS no,
         last_value(CASE WHEN starts THEN ts END IGNORE NULLS) OVER ({SPAN} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS exp_start
  FROM (SELECT *, (flush_state = 'Re' AND re_before = 0) OR (chamber = 'C1' AND flush_state = 'Re' AND coalesce(lm, 0) = 2) AS starts
        FROM (SELECT *, last_value(marker IGNORE NULLS) OVER ({SPAN} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS lm FROM markers)))"""


def cycle_candidates(settle: float, source: str = "labelled") -> str:
    return f"""
SELECT deployment_id, ts + INTERVAL '{settle} seconds' AS window_start, next_ts AS window_end, chamber, experiment_number,
       epoch_us(ts) - epoch_us(exp_start) AS elapsed_us
FROM {source} WHERE flush_state = 'Re' AND experiment_number IS NOT NULL AND next_ts IS NOT NULL"""


CTES["cycles60"] = f"SELECT * FROM ({cycle_candidates(60)}) WHERE window_end > window_start"
CTES["cycles0"] = f"SELECT * FROM ({cycle_candidates(0)}) WHERE window_end > window_start"
CTES["spans60"] = """
SELECT deployment_id, experiment_number, make_timestamp(min(epoch_us(window_start) - 60000000 - elapsed_us)) AS experiment_start,
       max(window_end) AS experiment_end FROM cycles60 GROUP BY ALL"""

# Scans: the next row that repeats a mass seen since, then the orbit of the first row.
CTES["scan_next"] = """
SELECT *, min(nxt) OVER (PARTITION BY deployment_id ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nb
FROM (SELECT *, lead(i) OVER (PARTITION BY deployment_id, mass ORDER BY i) AS nxt
      FROM (SELECT *, row_number() OVER (PARTITION BY deployment_id ORDER BY pos) AS i FROM rga))"""
CTES["orbit_scan"] = """
SELECT deployment_id, 1::BIGINT AS i FROM scan_next GROUP BY deployment_id
UNION ALL SELECT o.deployment_id, s.nb FROM orbit_scan o JOIN scan_next s ON s.deployment_id = o.deployment_id AND s.i = o.i WHERE s.nb IS NOT NULL"""
CTES["scans"] = """
SELECT s.* EXCLUDE (nxt, nb), (sum(CASE WHEN o.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY s.deployment_id ORDER BY s.i ROWS UNBOUNDED PRECEDING) - 1)::BIGINT AS segment
FROM scan_next s LEFT JOIN orbit_scan o ON o.deployment_id = s.deployment_id AND o.i = s.i"""
CTES["scan_windows"] = """
SELECT * FROM (SELECT deployment_id, segment, window_start, lead(window_start) OVER (PARTITION BY deployment_id ORDER BY segment) AS window_end
               FROM (SELECT deployment_id, segment, min(ts) AS window_start FROM scans GROUP BY ALL)) WHERE window_end IS NOT NULL"""
CTES["scan_context"] = """
SELECT s.deployment_id, s.window_start, s.window_end, CASE WHEN hit THEN chamber END AS chamber, CASE WHEN hit THEN experiment_number END AS experiment_number,
       CASE WHEN hit THEN elapsed_us END AS elapsed_us
FROM (SELECT s.*, c.chamber, c.experiment_number, c.elapsed_us, s.window_start < c.window_end AS hit
      FROM scan_windows s ASOF LEFT JOIN cycles60 c ON s.deployment_id = c.deployment_id AND s.window_start >= c.window_start) s"""


def match(stream: str, windows: str) -> str:
    return (f"SELECT r.*, w.window_start, w.window_end FROM {stream} r ASOF JOIN {windows} w "
            f"ON r.deployment_id = w.deployment_id AND r.ts >= w.window_start WHERE r.ts < w.window_end")


def layer(windows: str, pp: str = "8.01e-5", tp: str = "1.34e-5") -> str:
    grain = f"(SELECT deployment_id, window_start, window_end FROM {windows})"
    avg = ", ".join(f"avg(CASE WHEN mass = {m} THEN current END) AS m{m}" for m in MASSES)
    mass = ", ".join(f"m{m} AS mass_{m}_avg, m{m} * 1e-16 AS mass_{m}_amps, m{m} * 1e-16 / {pp} AS mass_{m}_torr" for m in MASSES)
    return f"""
SELECT w.deployment_id, w.window_start AS "timestamp", experiment_number, elapsed_us, elapsed_us / 1e6 AS elapsed_s, chamber, {mass},
       tp * 1e-16 AS total_pressure_amps, tp * 1e-16 / {tp} AS total_pressure_torr, temp_degC, sal_PSU, pressure_mbar, oxygen_mgL, pH,
       par_umol_m2_s, par_raw, turbo_speed_hz, turbo_power_w, water_pump_rpm
FROM {windows} w
LEFT JOIN (SELECT deployment_id, window_start, {avg} FROM ({match('rga', grain)}) GROUP BY ALL) a USING (deployment_id, window_start)
LEFT JOIN (SELECT deployment_id, window_start, avg(temp_degc) AS temp_degC, avg(sal_psu) AS sal_PSU, avg(pressure_mbar) AS pressure_mbar,
                  avg(oxygen_mgl) AS oxygen_mgL, avg(ph) AS pH FROM ({match('scalup', grain)}) GROUP BY ALL) b USING (deployment_id, window_start)
LEFT JOIN (SELECT deployment_id, window_start, avg(turbo_speed_hz) AS turbo_speed_hz, avg(turbo_power_w) AS turbo_power_w,
                  avg(pump_rpm) AS water_pump_rpm, avg(raw_total_pressure_current) AS tp FROM ({match('status', grain)}) GROUP BY ALL) c USING (deployment_id, window_start)
LEFT JOIN (SELECT deployment_id, window_start, avg(par_umol_m2_s) AS par_umol_m2_s, avg(par_raw) AS par_raw
           FROM ({match('par', grain)}) GROUP BY ALL) d USING (deployment_id, window_start)"""


CTES["layer_c"] = layer("cycles60")
CTES["layer_b"] = layer("scan_context")

# Fluxes and light.
SOLUBILITY = {"Ar": ((2.79150, 3.17609, 4.13116, 4.90379), (-6.96233e-3, -7.66670e-3, -1.16888e-2)),
              "N2": ((6.42931, 2.92704, 4.32531, 4.69149), (-7.44129e-3, -8.02566e-3, -1.46775e-2))}


def solubility_sql(gas: str, t: str, s: str) -> str:
    (a0, a1, a2, a3), (b0, b1, b2) = SOLUBILITY[gas]
    x = f"ln((298.15 - {t}) / (273.15 + {t}))"
    return f"exp({a0} + {a1} * {x} + {a2} * pow({x}, 2) + {a3} * pow({x}, 3) + {s} * ({b0} + {b1} * {x} + {b2} * pow({x}, 2)))"


def density_sql(t: str, s: str) -> str:
    return (f"((999.842594 + 6.793952e-2 * {t} - 9.095290e-3 * pow({t}, 2) + 1.001685e-4 * pow({t}, 3) - 1.120083e-6 * pow({t}, 4) + 6.536332e-9 * pow({t}, 5)"
            f" + (8.24493e-1 - 4.0899e-3 * {t} + 7.6438e-5 * pow({t}, 2) - 8.2467e-7 * pow({t}, 3) + 5.3875e-9 * pow({t}, 4)) * {s}"
            f" + (-5.72466e-3 + 1.0227e-4 * {t} - 1.6546e-6 * pow({t}, 2)) * pow({s}, 1.5) + 4.8314e-4 * pow({s}, 2)) / 1000)")


def flux_long(source: str, ratio: str = "1.0") -> str:
    base = 'deployment_id, experiment_number, chamber, "timestamp", trunc(elapsed_us / 1e6) / 60 AS x'
    return f"""
SELECT {base}, 'oxygen' AS variable, oxygen_mgL AS y FROM {source}
UNION ALL SELECT {base}, 'h_ion', pow(10.0::DOUBLE, -pH) FROM {source}
UNION ALL SELECT {base}, 'temp_degC', temp_degC FROM {source}
UNION ALL SELECT {base.replace('deployment_id, experiment_number, chamber', 'c.deployment_id, c.experiment_number, c.chamber')}, 'n2_denitrification',
  mass_28_avg / mass_40_avg / {ratio} * {solubility_sql('Ar', 't0', 's0')} * {density_sql('t0', 's0')}
  FROM (SELECT * FROM {source} WHERE mass_40_avg <> 0) c LEFT JOIN (
    SELECT deployment_id, experiment_number, chamber, arg_min(temp_degC, "timestamp") AS t0, arg_min(sal_PSU, "timestamp") AS s0 FROM {source}
    WHERE mass_40_avg <> 0 AND temp_degC IS NOT NULL AND sal_PSU IS NOT NULL GROUP BY ALL) a USING (deployment_id, experiment_number, chamber)"""


def fluxes(source: str, volume: str = "30.0", area: str = "0.3", ratio: str = "1.0") -> str:
    return f"""
SELECT deployment_id, experiment_number, chamber, experiment_start, variable, slope AS slope_native_per_min, r2, n_points,
  CASE variable WHEN 'temp_degC' THEN slope * 60 WHEN 'oxygen' THEN slope / 32.0 * {volume} / {area} * 60
       WHEN 'h_ion' THEN slope * 1000 * {volume} / {area} * 60 ELSE slope * 1e-3 * {volume} / {area} * 60 END AS output_value,
  CASE variable WHEN 'temp_degC' THEN 'degC h-1' ELSE 'mmol m-2 h-1' END AS output_unit
FROM (SELECT deployment_id, experiment_number, chamber, variable, min("timestamp") AS experiment_start, regr_slope(y, x) AS slope,
             regr_r2(y, x) AS r2, count(*) AS n_points FROM ({flux_long(source, ratio)}) WHERE y IS NOT NULL GROUP BY ALL HAVING count(DISTINCT x) > 1)"""


CTES["fluxes"] = fluxes("layer_c")
CTES["exp_par"] = """
SELECT deployment_id, experiment_number, avg(par_umol_m2_s) AS par_mean_umol_m2_s, sum(par_umol_m2_s * interval_s) / 1e6 AS par_integrated_mol_m2,
       least(sum(interval_s) / any_value(epoch_us(experiment_end) - epoch_us(experiment_start)) * 1e6, 1.0) AS par_coverage
FROM (SELECT r.*, s.experiment_number, s.experiment_start, s.experiment_end FROM (SELECT * FROM par WHERE par_umol_m2_s IS NOT NULL) r
      ASOF JOIN spans60 s ON r.deployment_id = s.deployment_id AND r.ts >= s.experiment_start WHERE r.ts < s.experiment_end) GROUP BY ALL"""
CTES["fluxes_par"] = "SELECT * FROM fluxes LEFT JOIN exp_par USING (deployment_id, experiment_number)"
CTES["par_daily"] = """
SELECT deployment_id, CAST(ts AS DATE) AS date, count(*) AS n_readings, least(sum(interval_s) / 86400, 1.0) AS coverage,
       CASE WHEN count(par_umol_m2_s) > 0 THEN sum(par_umol_m2_s * interval_s) / 1e6 END AS dli_mol_m2_d, max(par_umol_m2_s) AS max_par_umol_m2_s
FROM par GROUP BY ALL"""


def metabolism(source: str, dark: float = 20, coverage: float = 0.9, min_r2: float = 0.0, transmittance: float = 1.0) -> str:
    return f"""
SELECT *, CASE WHEN used AND period = 'light' THEN o2 END AS ncp_mmol_m2_h, CASE WHEN used AND period = 'light' THEN o2 + rd END AS gpp_mmol_m2_h, o2 AS o2_flux_mmol_m2_h
FROM (SELECT *, -avg(CASE WHEN used AND period = 'dark' THEN o2 END) OVER (PARTITION BY deployment_id, chamber) AS rd
      FROM (SELECT *, excluded_reason IS NULL AS used FROM (
        SELECT *, output_value AS o2, par_mean_umol_m2_s * {transmittance} AS par_chamber_umol_m2_s,
               CASE WHEN par_mean_umol_m2_s IS NULL THEN NULL WHEN par_mean_umol_m2_s * {transmittance} < {dark} THEN 'dark' ELSE 'light' END AS period,
               CASE WHEN par_mean_umol_m2_s IS NULL THEN 'no PAR' WHEN par_coverage < {coverage} THEN 'PAR coverage below minimum'
                    WHEN r2 IS NULL OR r2 < {min_r2} THEN 'r2 below minimum' END AS excluded_reason
        FROM {source} WHERE variable = 'oxygen')))"""


CTES["light_response"] = """
SELECT deployment_id, event_id AS experiment_number, CASE WHEN k % 2 = 0 THEN 'C1' ELSE 'C2' END AS chamber, ts AS experiment_start, 'oxygen' AS variable,
       k / 100.0::DOUBLE AS r2, 1500 * tanh(6 * (value * 8) / 1500) - 200 + (k - 50) * 2 AS output_value, CASE WHEN k <> 13 THEN value * 8 END AS par_mean_umol_m2_s,
       value * 8 * 3.6e-3::DOUBLE AS par_integrated_mol_m2, 0.85::DOUBLE + k / 400.0::DOUBLE AS par_coverage FROM ev"""
CTES["metab"] = metabolism("fluxes_par")
CTES["metab_lr"] = metabolism("light_response")
