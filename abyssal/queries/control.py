"""Setpoint and detector analyses on derived control lines."""

from __future__ import annotations

from pyspark.sql import functions as F

from abyssal import standin
from abyssal.functions.common import write_and_read
from abyssal.operators import detector, setpoint, spread
from abyssal.queries.base import query
from abyssal.queries.ctes import CTES
from abyssal.schemas import KEY

D = KEY
WINDOW, SETTLE = standin.WINDOW_S, standin.SETTLE_S


# --- setpoint ----------------------------------------------------------------------------------------------

CTES["ctl"] = f"""
SELECT {D}, ts + to_seconds(after) AS ts, kind, setpoint, event_id * 8 + i AS pos FROM (
  SELECT *, 1000 + 100 * (k // 20) AS sp FROM ev WHERE event_type = 'click') e, LATERAL (VALUES
  (0, 0, 'command', sp, true), (1, 3, 'command', sp, true), (2, 200, 'command', sp, k % 2 = 0), (3, 5, 'ack', CASE WHEN k % 5 <> 0 THEN sp END, k % 3 <> 0),
  (4, 60, 'ack', CASE WHEN k % 5 <> 0 THEN sp END, k % 3 <> 0), (5, 30, 'acq_on', NULL, k % 4 <> 0)) v(i, after, kind, setpoint, ok) WHERE ok"""
CTES["telemetry"] = f"""
SELECT {D}, ts + INTERVAL 1 SECOND AS ts, (1200 + k)::DOUBLE AS speed_hz, (k % 9)::DOUBLE AS power_w, CASE WHEN k % 11 <> 0 THEN (k * 3)::DOUBLE END AS tp_raw
FROM ev WHERE event_type = 'signup'"""


def _greedy(name: str, source: str) -> None:
    """First of each burst: a later row is kept when the setpoint differs or the kept one is over the window ago."""
    CTES[f"{name}_n"] = f"SELECT *, row_number() OVER (PARTITION BY {D} ORDER BY ts, pos) AS i FROM ({source})"
    CTES[f"{name}_x"] = f"""
SELECT a.{D}, a.i, min(b.i) AS nb FROM {name}_n a JOIN {name}_n b ON a.{D} = b.{D} AND b.i > a.i
  AND (b.setpoint <> a.setpoint OR b.ts > a.ts + to_seconds({WINDOW})) GROUP BY ALL"""
    CTES[f"orbit_{name}"] = f"""
SELECT {D}, 1::BIGINT AS i FROM {name}_n GROUP BY {D}
UNION ALL SELECT o.{D}, x.nb FROM orbit_{name} o JOIN {name}_x x ON o.{D} = x.{D} AND o.i = x.i"""
    CTES[name] = f"SELECT n.* FROM {name}_n n JOIN orbit_{name} o ON n.{D} = o.{D} AND n.i = o.i"


_greedy("asked", f"SELECT {D}, ts, setpoint, pos FROM ctl WHERE kind = 'command'")
_greedy("accepted", f"""SELECT * FROM (SELECT a.{D}, a.ts, coalesce(a.setpoint, r.setpoint) AS setpoint, a.pos FROM (SELECT * FROM ctl WHERE kind = 'ack') a
  ASOF LEFT JOIN asked r ON a.{D} = r.{D} AND a.ts >= r.ts) WHERE setpoint IS NOT NULL""")
CTES["holds"] = f"""
SELECT *, row_number() OVER (PARTITION BY {D} ORDER BY ts) - 1 AS segment, lead(ts) OVER (PARTITION BY {D} ORDER BY ts) AS next_ts FROM (
  SELECT *, lag(setpoint) OVER (PARTITION BY {D} ORDER BY ts, source) AS before FROM (
    SELECT {D}, ts, setpoint, 'ack' AS source FROM accepted UNION ALL SELECT r.{D}, r.ts, r.setpoint, 'command' FROM asked r WHERE NOT EXISTS (
      SELECT 1 FROM accepted a WHERE a.{D} = r.{D} AND a.setpoint = r.setpoint AND abs(epoch_us(a.ts) - epoch_us(r.ts)) <= {WINDOW} * 1e6)))
WHERE before IS NULL OR before <> setpoint"""
CTES["legs"] = f"""
SELECT *, coalesce(own, first_value(own IGNORE NULLS) OVER (PARTITION BY {D} ORDER BY ts ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), 'down') AS leg
FROM (SELECT *, CASE WHEN setpoint < before THEN 'down' WHEN setpoint > before THEN 'up' END AS own FROM holds)"""
CTES["changes"] = f"""
SELECT l.* EXCLUDE (own, before), CASE WHEN next_ts IS NULL OR on_ts < next_ts THEN on_ts END AS acq_on_ts FROM (
  SELECT l.*, a.ts AS on_ts FROM legs l ASOF LEFT JOIN (SELECT DISTINCT {D}, ts FROM ctl WHERE kind = 'acq_on') a ON l.{D} = a.{D} AND l.ts <= a.ts) l"""


def tagged_sql(source: str) -> str:
    return f"""
SELECT r.*, c.ts AS change_ts, c.setpoint, c.segment, c.leg, c.acq_on_ts, (epoch_us(r.ts) - epoch_us(coalesce(c.acq_on_ts, c.ts))) / 1e6 < {SETTLE} AS in_settle
FROM {source} r ASOF JOIN changes c ON r.{D} = c.{D} AND r.ts >= c.ts"""


CTES["tagged"] = tagged_sql("(SELECT *, current * 1e-16 AS amps, current * 1e-16 / 8.01e-5 AS torr FROM rga)")
CTES["tag_next"] = f"""
SELECT *, min(nxt) OVER (PARTITION BY {D} ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nb FROM (
  SELECT *, lead(i) OVER (PARTITION BY {D}, mass ORDER BY i) AS nxt FROM (SELECT *, row_number() OVER (PARTITION BY {D} ORDER BY ts, pos) AS i FROM tagged))"""
CTES["orbit_tag"] = f"""
SELECT {D}, 1::BIGINT AS i FROM tag_next GROUP BY {D}
UNION ALL SELECT o.{D}, s.nb FROM orbit_tag o JOIN tag_next s ON s.{D} = o.{D} AND s.i = o.i WHERE s.nb IS NOT NULL"""
CTES["tag_scans"] = f"""
SELECT s.*, sum(CASE WHEN o.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY s.{D} ORDER BY s.i ROWS UNBOUNDED PRECEDING) - 1 AS scan_id
FROM tag_next s LEFT JOIN orbit_tag o ON o.{D} = s.{D} AND o.i = s.i"""
CTES["tag_ratio"] = f"""
SELECT s.*, CASE WHEN r.current <> 0 THEN s.current / r.current END AS ratio FROM tag_scans s LEFT JOIN (SELECT {D}, scan_id, current FROM tag_scans WHERE mass = 40) r USING ({D}, scan_id)"""


def spread_sql(value: str, prefix: str, keys: str, where: str = "true", extra: str = "") -> str:
    return f"""
SELECT *, 100 * {prefix}_std / {prefix}_mean AS rsd_pct, 100 * {prefix}_noise / {prefix}_mean AS rsd_diff_pct FROM (
  SELECT {D}, {keys}, mass, count(*) AS n, avg({value}) AS {prefix}_mean, stddev_samp({value}) AS {prefix}_std, stddev_samp(d) / sqrt(2) AS {prefix}_noise{extra}
  FROM (SELECT *, {value} - lag({value}) OVER (PARTITION BY {D}, segment, mass ORDER BY ts, pos) AS d FROM tag_ratio WHERE NOT in_settle AND {where}) GROUP BY ALL)"""


MASS_EXTRA = ", avg(amps) AS amps_mean, stddev_samp(amps) AS amps_std, avg(torr) AS torr_mean, stddev_samp(torr) AS torr_std"
SEGMENTS = "segment, leg, setpoint, change_ts"
CTES["mass_speed"] = spread_sql("current", "current_raw", "setpoint", extra=MASS_EXTRA)
CTES["mass_segment"] = spread_sql("current", "current_raw", SEGMENTS, extra=MASS_EXTRA)


def _control(spark, d):
    return setpoint.extract_control(standin.control_lines(spark, d))


def _changes(spark, d):
    # parsed once: commands, acknowledgements and acquisition-on are each read several times
    rows = write_and_read(_control(spark, d).where("kind != 'telemetry'").select(D, "kind", "ts", "setpoint", "file_name", "chunk", "pos"))
    pick = lambda kind: rows.where(F.col("kind") == kind).select(D, "ts", "setpoint", F.col("file_name").alias("source_file"), "chunk", "pos")
    changes = setpoint.build_setpoint_changes(pick("command"), pick("ack"), WINDOW)
    return write_and_read(setpoint.add_acquisition_on(changes, pick("acq_on")))


def _tagged(spark, d):
    return setpoint.tag_readings(setpoint.prepare_rga(standin.rga(spark, d)), _changes(spark, d), SETTLE)


READING = [D, "ts", "mass", "current", "segment", "chunk", "pos"]


def _written(spark, d, *more):
    """The tagged readings as a table of the columns that the query needs."""
    return write_and_read(_tagged(spark, d).select(*READING, *more))


def _with_ratio(spark, d):
    return write_and_read(setpoint.add_ratio(_written(spark, d, "setpoint", "in_settle")))


@query("SEQ10", f"{D} ts setpoint source", f"SELECT {D}, ts, setpoint, source FROM holds")
def setpoint_changes(spark, d):
    return _changes(spark, d)


@query("SEQ11", f"{D} ts setpoint segment leg", f"SELECT {D}, ts, setpoint, segment, leg FROM legs")
def hold_segments(spark, d):
    return _changes(spark, d)


@query("SEQ12", f"{D} ts kind setpoint speed_hz power_w tp_raw", f"""
SELECT {D}, ts, kind, setpoint::BIGINT AS setpoint, NULL::DOUBLE AS speed_hz, NULL::DOUBLE AS power_w, NULL::DOUBLE AS tp_raw FROM ctl
UNION ALL SELECT {D}, ts, 'telemetry', NULL, speed_hz, power_w, tp_raw FROM telemetry""")
def control_rows(spark, d):
    return _control(spark, d)


@query("SEQ12_raw", f"{D} ts kind setpoint speed_hz power_w tp_raw", f"""
SELECT {D}, ts, kind, setpoint::BIGINT AS setpoint, NULL::DOUBLE AS speed_hz, NULL::DOUBLE AS power_w, NULL::DOUBLE AS tp_raw FROM ctl
UNION ALL SELECT {D}, ts, 'telemetry', NULL, speed_hz, power_w, tp_raw FROM telemetry""")
def control_rows_from_raw_lines(spark, d):
    """The same rows from raw lines: events-log lines, lander lines and lines that begin with their own time, between headers and empty ones."""
    rows = standin.control_lines(spark, d)
    p, ts = F.col("payload"), standin.stamp(F.col("ts"))
    telemetry = p.startswith("TS,")
    own = ~telemetry & (F.col("pos") % 3 == 0)
    line = F.when(telemetry, F.concat_ws(" ", ts, p)).when(own, F.concat_ws(" ", ts, p)).otherwise(F.concat_ws(" ", ts, F.lit(">"), p))
    name = F.when(telemetry, "surface_2024-01-01-00-00_lander.log").when(own, "gems_2024-01-01-00-00.txt").otherwise("surface_2024-01-01-00-00_events.log")
    made = F.array(line, F.concat(F.lit("# "), line), F.when(~own, F.concat(ts, F.lit(" "))), F.when(own, p))
    raw = rows.select(KEY, name.alias("file_name"), "chunk", "pos", F.explode(made).alias("line")).where("line IS NOT NULL")
    return setpoint.extract_control(setpoint.timestamped_lines(raw))


@query("JN06", f"{D} ts setpoint acq_on_ts", f"SELECT {D}, ts, setpoint, acq_on_ts FROM changes")
def acquisition_on(spark, d):
    return _changes(spark, d)


@query("JN07", f"{D} ts mass current setpoint segment change_ts in_settle", f"SELECT {D}, ts, mass, current, setpoint, segment, change_ts, in_settle FROM tagged")
def tagged_readings(spark, d):
    return _tagged(spark, d)


@query("JN13", f"{D} ts mass scan_id ratio:7", f"SELECT {D}, ts, mass, scan_id::BIGINT AS scan_id, ratio FROM tag_ratio")
def scan_ratios(spark, d):
    return setpoint.add_ratio(_written(spark, d))


STAT = "n current_raw_mean:4 current_raw_std:4 current_raw_noise:4 amps_mean:6@1e16 torr_std:4@1e12 rsd_pct:5 rsd_diff_pct:5"


@query("AGG15", f"{D} segment leg setpoint change_ts mass {STAT}", "SELECT * FROM mass_segment")
def mass_statistics(spark, d):
    return setpoint.mass_stats(write_and_read(_tagged(spark, d)), setpoint.SEGMENT)


RATIO = "mass <> 40 AND ratio IS NOT NULL"


@query("AGG16", f"{D} setpoint mass n ratio_mean:6 ratio_std:6 ratio_noise:6 rsd_pct:5 rsd_diff_pct:5", spread_sql("ratio", "ratio", "setpoint", RATIO))
def ratio_statistics(spark, d):
    return setpoint.ratio_stats(_with_ratio(spark, d), ["setpoint"])


TURBO = f"""SELECT {D}, ts, 'TS' AS source, speed_hz, power_w, tp_raw FROM telemetry UNION ALL SELECT {D}, ts, 'status', turbo_speed_hz, turbo_power_w, raw_total_pressure_current FROM status"""
CTES["turbo"] = f"SELECT *, 0 AS pos FROM ({TURBO}) WHERE tp_raw IS NOT NULL OR speed_hz IS NOT NULL"


def _turbo(spark, d):
    return setpoint.build_turbo(_control(spark, d).where("kind = 'telemetry'"), standin.status(spark, d))


@query("DOM16", f"{D} ts source speed_hz power_w:4 tp_raw", "SELECT * FROM turbo")
def pump_readings(spark, d):
    return _turbo(spark, d)


def pump_sql(keys: str) -> str:
    return f"""
SELECT *, 100 * tp_raw_std / tp_raw_mean AS tp_rsd_pct FROM (SELECT {D}, {keys}, count(tp_raw) AS n, avg(speed_hz) AS speed_hz_mean, stddev_samp(speed_hz) AS speed_hz_std,
  avg(power_w) AS power_w_mean, avg(tp_raw) AS tp_raw_mean, stddev_samp(tp_raw) AS tp_raw_std, avg(tp_raw * 1e-16 / 1.34e-5) AS tp_torr_mean
  FROM ({tagged_sql('turbo')}) WHERE NOT in_settle GROUP BY ALL)"""


@query("AGG17", f"{D} setpoint n speed_hz_mean:4 speed_hz_std:4 power_w_mean:5 tp_raw_mean:4 tp_raw_std:4 tp_torr_mean:4@1e12 tp_rsd_pct:5", pump_sql("setpoint"))
def pump_statistics(spark, d):
    return setpoint.pump_stats(setpoint.tag_readings(setpoint.prepare_turbo(_turbo(spark, d)), _changes(spark, d), SETTLE), ["setpoint"])


CTES["pairs"] = f"""
SELECT {D}, mass, setpoint, d / m AS x FROM (
  SELECT *, current - lag(current) OVER w AS d, avg(current) OVER (PARTITION BY {D}, segment, mass) AS m, row_number() OVER w - 1 AS i
  FROM tagged WHERE NOT in_settle WINDOW w AS (PARTITION BY {D}, segment, mass ORDER BY ts, pos)) WHERE i % 2 = 1 AND m <> 0"""
CTES["pairs_abs"] = f"""
SELECT {D}, mass, setpoint, d AS x FROM (SELECT *, current - lag(current) OVER w AS d, row_number() OVER w - 1 AS i FROM tagged WHERE NOT in_settle
  WINDOW w AS (PARTITION BY {D}, segment, mass ORDER BY ts, pos)) WHERE i % 2 = 1"""


def spread_tests_sql(pairs: str, prefix: str) -> str:
    """Brown-Forsythe F with its tail and the adjustment across masses.

    The tail is the incomplete beta function as an integral of sin^(2a-1) cos^(2b-1), by Simpson's rule over 4,000 panels per test;
    the operator uses a continued fraction.
    """
    CTES[f"{prefix}_f"] = f"""
SELECT {D}, mass, n_setpoints, n, statistic, (n - n_setpoints) / 2.0 AS a, (n_setpoints - 1) / 2.0 AS b,
       asin(sqrt((n - n_setpoints) / ((n - n_setpoints) + (n_setpoints - 1) * statistic))) AS top FROM (
  SELECT {D}, mass, count(*) AS n_setpoints, sum(n)::BIGINT AS n, (sum(n) - count(*)) / (count(*) - 1) * sum(n * pow(zm - g, 2)) / nullif(sum(ss), 0) AS statistic FROM (
    SELECT *, sum(n * zm) OVER (PARTITION BY {D}, mass) / sum(n) OVER (PARTITION BY {D}, mass) AS g FROM (
      SELECT {D}, mass, setpoint, count(*) AS n, avg(z) AS zm, var_pop(z) * count(*) AS ss FROM (
        SELECT *, abs(x - median(x) OVER (PARTITION BY {D}, mass, setpoint)) AS z FROM {pairs}) GROUP BY ALL HAVING count(*) >= 3))
  GROUP BY ALL HAVING count(*) >= 2)"""
    CTES[f"{prefix}_p"] = f"""
SELECT {D}, mass, any_value(n_setpoints) AS n_setpoints, any_value(n) AS n, any_value(statistic) AS statistic,
       CASE WHEN any_value(statistic) IS NOT NULL THEN least(1.0, 2 * any_value(top) / 4000 / 3 * sum(weight * CASE WHEN t <= 0 THEN 0 ELSE
         exp((2 * a - 1) * ln(sin(t)) + (2 * b - 1) * ln(greatest(cos(t), 1e-300)) + lgamma(a + b) - lgamma(a) - lgamma(b)) END)) END AS p_value
FROM (SELECT *, top * i / 4000 AS t, CASE WHEN i IN (0, 4000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS weight FROM {prefix}_f, (SELECT unnest(range(4001)) AS i)) GROUP BY {D}, mass"""
    return f"""
SELECT *, CASE WHEN p_value IS NOT NULL THEN least(min(raw) OVER (PARTITION BY {D} ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0) END AS p_adj FROM (
  SELECT *, p_value * count(p_value) OVER (PARTITION BY {D}) / r AS raw FROM (
    SELECT *, row_number() OVER (PARTITION BY {D} ORDER BY p_value NULLS LAST, mass) AS r FROM {prefix}_p))"""


CTES["tests_rel"] = spread_tests_sql("pairs", "rel")
CTES["tests_abs"] = spread_tests_sql("pairs_abs", "abs")


@query("AGG18", f"{D} mass setpoint_lo setpoint_hi signal_lo_hi:6 noise_lo_hi:6 rsd_lo_hi:6 p_adj_rsd:7 p_adj_noise:7", f"""
SELECT l.{D}, l.mass, lo AS setpoint_lo, hi AS setpoint_hi, l.current_raw_mean / h.current_raw_mean AS signal_lo_hi, l.current_raw_noise / h.current_raw_noise AS noise_lo_hi,
       l.rsd_diff_pct / h.rsd_diff_pct AS rsd_lo_hi, r.p_adj AS p_adj_rsd, a.p_adj AS p_adj_noise
FROM (SELECT {D}, min(setpoint) AS lo, max(setpoint) AS hi FROM mass_speed WHERE current_raw_noise > 0 GROUP BY ALL) e
JOIN mass_speed l ON l.{D} = e.{D} AND l.setpoint = lo AND l.current_raw_noise > 0 JOIN mass_speed h ON h.{D} = e.{D} AND h.setpoint = hi AND h.mass = l.mass AND h.current_raw_noise > 0
LEFT JOIN tests_rel r ON r.{D} = l.{D} AND r.mass = l.mass LEFT JOIN tests_abs a ON a.{D} = l.{D} AND a.mass = l.mass""")
def noise_floor(spark, d):
    tagged = _written(spark, d, "setpoint", "in_settle", "amps", "torr")
    by_speed = setpoint.mass_stats(tagged, ["setpoint"])
    rsd, noise = spread.setpoint_spread_tests(tagged), spread.setpoint_spread_tests(tagged, relative=False)
    return setpoint.noise_floor_summary(by_speed, rsd, noise)


@query("AGG25", f"{D} setpoint {' '.join(f'rsd_m{m}:5' for m in (2, 18, 28, 32, 40, 44))}", f"""
SELECT {D}, setpoint, {', '.join(f'max(CASE WHEN mass = {m} THEN rsd_pct END) AS rsd_m{m}' for m in (2, 18, 28, 32, 40, 44))} FROM mass_speed GROUP BY ALL""")
def rsd_pivot(spark, d):
    stats = setpoint.mass_stats(write_and_read(_tagged(spark, d)), ["setpoint"])
    wide = stats.groupBy(D, "setpoint").pivot("mass", [2, 18, 28, 32, 40, 44]).agg(F.max("rsd_pct"))
    return wide.withColumnsRenamed({str(m): f"rsd_m{m}" for m in (2, 18, 28, 32, 40, 44)})


@query("STA01", f"{D} mass n_setpoints n statistic:6", f"""
SELECT {D}, mass, count(*) AS n_setpoints, sum(n)::BIGINT AS n, (sum(n) - count(*)) / (count(*) - 1) * sum(n * pow(zm - g, 2)) / sum(ss) AS statistic FROM (
  SELECT *, sum(n * zm) OVER (PARTITION BY {D}, mass) / sum(n) OVER (PARTITION BY {D}, mass) AS g FROM (
    SELECT {D}, mass, setpoint, count(*) AS n, avg(z) AS zm, var_pop(z) * count(*) AS ss FROM (
      SELECT *, abs(x - median(x) OVER (PARTITION BY {D}, mass, setpoint)) AS z FROM pairs) GROUP BY ALL HAVING count(*) >= 3))
GROUP BY ALL HAVING count(*) >= 2""")
def spread_statistic(spark, d):
    return spread.brown_forsythe(spread.successive_pairs(write_and_read(_tagged(spark, d))))


@query("STA02", f"{D} mass test n_setpoints n statistic:5 p_value:7 p_adj:7", "SELECT *, 'Brown-Forsythe' AS test FROM tests_rel")
def spread_tests(spark, d):
    return spread.setpoint_spread_tests(write_and_read(_tagged(spark, d)))


@query("STA03", f"{D} mass p_value:12 p_adj:12", f"""
SELECT *, least(min(p_value * m / r) OVER (PARTITION BY {D} ORDER BY r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 1.0) AS p_adj FROM (
  SELECT *, row_number() OVER (PARTITION BY {D} ORDER BY p_value, mass) AS r, count(*) OVER (PARTITION BY {D}) AS m FROM (
    SELECT {D}, k AS mass, avg(value) / 1000 * (k + 1) / 100 AS p_value FROM ev GROUP BY deployment_id, k))""")
def adjusted(spark, d):
    tests = standin.events(spark, d).groupBy(D, F.col("k").alias("mass")).agg((F.avg("value") / 1000 * (F.col("k") + 1) / 100).alias("p_value"))
    return spread.benjamini_hochberg(tests)


@query("STA04", f"{D} floor:2 shot:3 prop:4", f"SELECT {D}, 30.0 AS floor, 2.0 AS shot, 0.02 AS prop FROM ev GROUP BY {D}")
def noise_model(spark, d):
    """Holds that follow the model exactly, so its terms are known."""
    s = F.col("value") * 100
    holds = standin.events(spark, d).select(
        D, s.alias("current_raw_mean"), (F.sqrt(F.pow(F.lit(30.0), 2) + 2 * s + F.pow(0.02 * s, 2))).alias("current_raw_noise"))
    return spread.fit_noise_model(holds)


START, END = "2024-01-06", "2024-01-25"


@query("DOM15", f"{D} setpoint mass {STAT}", f"""
SELECT *, 100 * current_raw_std / current_raw_mean AS rsd_pct, 100 * current_raw_noise / current_raw_mean AS rsd_diff_pct FROM (
  SELECT {D}, setpoint, mass, count(*) AS n, avg(current) AS current_raw_mean, stddev_samp(current) AS current_raw_std, stddev_samp(d) / sqrt(2) AS current_raw_noise{MASS_EXTRA} FROM (
    SELECT *, current - lag(current) OVER (PARTITION BY {D}, change_ts, mass ORDER BY ts, pos) AS d FROM tagged
    WHERE NOT in_settle AND change_ts >= TIMESTAMP '{START}' AND ts <= TIMESTAMP '{END}') GROUP BY ALL)""")
def windowed_analysis(spark, d):
    lit = lambda s: F.lit(s).cast("timestamp_ntz")
    out = setpoint.analyze(standin.rga(spark, d), standin.status(spark, d), _control(spark, d).where("kind = 'telemetry'"), _changes(spark, d), SETTLE, lit(START), lit(END),
                           only=["mass_stats_by_speed"])
    return out["mass_stats_by_speed"]


# --- detector ----------------------------------------------------------------------------------------------

CTES["det_events"] = f"""
SELECT {D}, date_trunc('second', ts) AS receipt_ts, CASE event_type WHEN 'view' THEN 'AON' WHEN 'click' THEN 'AOFF' WHEN 'purchase' THEN 'EMON' ELSE 'EMOFF' END AS event,
       epoch_us(ts) AS pos FROM ev WHERE event_type <> 'error'"""
CTES["det_rga"] = f"SELECT {D}, date_trunc('second', ts) AS receipt_ts, ts, mass, current AS counts, epoch_us(ts) AS pos FROM rga"
CTES["det_status"] = f"SELECT {D}, date_trunc('second', ts) AS receipt_ts, ts, raw_total_pressure_current, epoch_us(ts) AS pos FROM status"


def spans_sql(on: str, off: str) -> str:
    return f"""
SELECT {D}, receipt_ts AS start, coalesce(e, TIMESTAMP '9999-12-31 23:59:59.999999') AS "end", row_number() OVER (PARTITION BY {D} ORDER BY pos) - 1 AS span FROM (
  SELECT *, lead(receipt_ts) OVER (PARTITION BY {D} ORDER BY pos) AS e FROM (
    SELECT *, lag(event) OVER (PARTITION BY {D} ORDER BY pos) AS before FROM det_events WHERE event IN ('{on}', '{off}')) WHERE before IS NULL OR before <> event) WHERE event = '{on}'"""


CTES["em_spans"] = spans_sql("EMON", "EMOFF")
CTES["run_spans"] = spans_sql("AON", "AOFF")


def in_spans(source: str) -> str:
    return f"""
SELECT r.*, s.start AS run_start, s.span AS run, EXISTS (SELECT 1 FROM em_spans m WHERE m.{D} = r.{D} AND r.receipt_ts >= m.start AND r.receipt_ts < m."end") AS em
FROM (SELECT r.{D}, r.pos, min(s.span) AS span FROM {source} r JOIN run_spans s ON r.{D} = s.{D} AND r.receipt_ts BETWEEN s.start AND s."end" GROUP BY ALL) x
JOIN {source} r ON r.{D} = x.{D} AND r.pos = x.pos JOIN run_spans s ON s.{D} = x.{D} AND s.span = x.span"""


CTES["det_runs"] = f"SELECT *, row_number() OVER (PARTITION BY {D}, run ORDER BY pos) AS i FROM ({in_spans('det_rga')})"
CTES["det_next"] = f"""
SELECT *, min(nxt) OVER (PARTITION BY {D}, run ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS nb FROM (
  SELECT *, lead(i) OVER (PARTITION BY {D}, run, mass ORDER BY i) AS nxt FROM det_runs)"""
CTES["orbit_det"] = f"""
SELECT {D}, run, 1::BIGINT AS i FROM det_next GROUP BY {D}, run
UNION ALL SELECT o.{D}, o.run, s.nb FROM orbit_det o JOIN det_next s ON s.{D} = o.{D} AND s.run = o.run AND s.i = o.i WHERE s.nb IS NOT NULL"""
CTES["labelled_det"] = f"""
SELECT s.* EXCLUDE (nxt, nb, em), CASE WHEN em THEN 'CDEM' ELSE 'FC' END AS detector, counts * 1e-16 AS amps, (epoch_us(receipt_ts) - epoch_us(run_start)) // 1000 / 1000 AS elapsed_s,
       (epoch_us(receipt_ts) - epoch_us(run_start)) / 1e6 >= {SETTLE} AS stable,
       sum(CASE WHEN o.i IS NULL THEN 0 ELSE 1 END) OVER (PARTITION BY s.{D}, s.run ORDER BY s.i ROWS UNBOUNDED PRECEDING) - 1 AS scan
FROM det_next s LEFT JOIN orbit_det o ON o.{D} = s.{D} AND o.run = s.run AND o.i = s.i"""
CTES["det_ratio"] = f"""
SELECT l.*, CASE WHEN r.amps <> 0 THEN l.amps / r.amps END AS ratio FROM labelled_det l LEFT JOIN (SELECT {D}, run, scan, amps FROM labelled_det WHERE mass = 40) r USING ({D}, run, scan)"""
CTES["det_diff"] = f"""
SELECT *, d - median(d) OVER (PARTITION BY {D}, detector, mass) AS dd FROM (
  SELECT *, amps - lag(amps) OVER (PARTITION BY {D}, detector, mass ORDER BY receipt_ts, pos) AS d FROM labelled_det WHERE stable) WHERE d IS NOT NULL"""
CTES["det_stats"] = f"""
SELECT a.{D}, a.detector, a.mass, n, n_stable, mean_amps, sd_amps, sd_amps / nullif(mean_amps, 0) * 100 AS rsd_pct, ms AS mean_stable_amps, sds AS sd_stable_amps, sds / sqrt(n_stable) AS se_stable_amps,
       sds / nullif(ms, 0) * 100 AS rsd_stable_pct, CASE WHEN nd >= 2 THEN sd / sqrt(2) / nullif(ms, 0) * 100 END AS noise_rsd_pct,
       CASE WHEN nd >= 2 THEN 1.4826::DOUBLE * mad / sqrt(2) / nullif(ms, 0) * 100 END AS noise_mad_rsd_pct, CASE WHEN n_stable >= 3 THEN slope / nullif(ms, 0) * 100 END AS drift_pct_per_min, ratio_to_m40_rsd_pct
FROM (SELECT {D}, detector, mass, count(*) AS n, count_if(stable)::BIGINT AS n_stable, avg(amps) AS mean_amps, stddev_samp(amps) AS sd_amps, avg(CASE WHEN stable THEN amps END) AS ms,
             stddev_samp(CASE WHEN stable THEN amps END) AS sds, regr_slope(CASE WHEN stable THEN amps END, CASE WHEN stable THEN elapsed_s / 60 END) AS slope,
             stddev_samp(CASE WHEN stable THEN ratio END) / nullif(avg(CASE WHEN stable THEN ratio END), 0) * 100 AS ratio_to_m40_rsd_pct FROM det_ratio GROUP BY ALL) a
LEFT JOIN (SELECT {D}, detector, mass, count(*) AS nd, stddev_samp(d) AS sd, median(abs(dd)) AS mad FROM det_diff GROUP BY ALL) b USING ({D}, detector, mass)"""


def _labelled(spark, d):
    return write_and_read(detector.label_readings(standin.detector_readings(spark, d), standin.detector_events(spark, d), SETTLE))


@query("SEQ09", f"{D} start end span", 'SELECT * FROM run_spans')
def on_off_spans(spark, d):
    return detector.spans(standin.detector_events(spark, d), "AON", "AOFF")


@query("SEQ13", f"{D} kind receipt_ts n", f"""
SELECT {D}, 'event' AS kind, receipt_ts, count(*) AS n FROM det_events GROUP BY ALL UNION ALL SELECT {D}, 'reading', receipt_ts, count(*) FROM (SELECT {D}, date_trunc('second', ts) AS receipt_ts FROM ev WHERE k % 10 NOT IN (3, 4, 5, 6)) GROUP BY ALL
UNION ALL SELECT {D}, 'status', receipt_ts, count(*) FROM (SELECT {D}, date_trunc('second', ts) AS receipt_ts FROM ev WHERE k % 3 <> 0) GROUP BY ALL""")
def control_log(spark, d):
    """Lander-log payloads and control lines on their receipt time."""
    stamp = F.concat(F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z"))
    lines = standin.log_lines(spark, d).withColumn("receipt", stamp).select(D, "receipt", "payload", "chunk", "pos")
    events = standin.detector_events(spark, d)
    control = events.select(D, F.concat(F.date_format("receipt_ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("receipt"), F.concat(F.lit("OK,"), "event").alias("payload"), "chunk", "pos")
    readings, ev, status = detector.read_control(lines.unionByName(control))
    count = lambda df, kind: df.groupBy(D, "receipt_ts").agg(F.count(F.lit(1)).alias("n")).withColumn("kind", F.lit(kind))
    return count(ev, "event").unionByName(count(readings, "reading")).unionByName(count(status, "status"))


@query("SEQ14", f"{D} receipt_ts ts mass run scan detector elapsed_s:4 stable", "SELECT * REPLACE (scan::BIGINT AS scan) FROM labelled_det")
def labelled_readings(spark, d):
    return detector.label_readings(standin.detector_readings(spark, d), standin.detector_events(spark, d), SETTLE)


DET_SPEC = ("n n_stable mean_amps:4@7.310585786300049e15 sd_amps:4@7.310585786300049e15 rsd_pct:5 mean_stable_amps:4@7.310585786300049e15 se_stable_amps:4@7.310585786300049e15 rsd_stable_pct:5 noise_rsd_pct:5 noise_mad_rsd_pct:5 "
            "drift_pct_per_min:5 ratio_to_m40_rsd_pct:5")


@query("AGG19", f"{D} detector mass {DET_SPEC}", "SELECT * FROM det_stats")
def detector_statistics(spark, d):
    return detector.detector_stats(_labelled(spark, d))


CTES["gains"] = f"""
SELECT *, g * sqrt(pow(cse / cm, 2) + pow(fse / fm, 2)) AS cdem_fc_gain_se, g AS cdem_fc_gain, g * 8.01e-5 AS cdem_sensitivity_a_per_torr_from_nominal_fc, fmad / nullif(cmad, 0) AS noise_improvement_fc_over_cdem FROM (
  SELECT *, cm / nullif(fm, 0) AS g FROM (SELECT {D}, mass, mean_stable_amps AS fm, se_stable_amps AS fse, noise_mad_rsd_pct AS fmad FROM det_stats WHERE detector = 'FC') f
  FULL JOIN (SELECT {D}, mass, mean_stable_amps AS cm, se_stable_amps AS cse, noise_mad_rsd_pct AS cmad FROM det_stats WHERE detector = 'CDEM') c USING ({D}, mass))"""


def _gains(spark, d, labelled=None):
    labelled = _labelled(spark, d) if labelled is None else labelled
    return detector.gain_table(detector.detector_stats(labelled))


@query("JN12", f"{D} mass fc_mean_stable_amps:4@1e16 cdem_mean_stable_amps:4@1e16", f"SELECT {D}, mass, fm AS fc_mean_stable_amps, cm AS cdem_mean_stable_amps FROM gains")
def joined_detectors(spark, d):
    return _gains(spark, d)


@query("AGG20", f"{D} mass cdem_fc_gain:6 cdem_fc_gain_se:6 cdem_sensitivity_a_per_torr_from_nominal_fc:5@1e6 noise_improvement_fc_over_cdem:5", "SELECT * FROM gains")
def gain(spark, d):
    return _gains(spark, d)


CTES["det_tp"] = f"SELECT *, raw_total_pressure_current * 1e-16 / 1.34e-5 AS total_pressure_torr FROM ({in_spans('det_status')}) WHERE NOT em AND raw_total_pressure_current > 0"
CTES["det_torr"] = f"""
SELECT l.*, amps / (8.01e-5 * CASE WHEN detector = 'CDEM' THEN g ELSE 1.0::DOUBLE END) AS torr FROM labelled_det l LEFT JOIN (SELECT {D}, g FROM gains WHERE mass = 28) USING ({D})"""


def _pressure(spark, d):
    return detector.total_pressure(standin.detector_status(spark, d), standin.detector_events(spark, d))


@query("JN14", f"{D} receipt_ts ts total_pressure_torr:4@1e12", "SELECT * FROM det_tp")
def faraday_pressure(spark, d):
    return _pressure(spark, d)


@query("DOM17", f"{D} receipt_ts ts mass detector torr:4@1e12", "SELECT * FROM det_torr")
def partial_pressure(spark, d):
    rows = _labelled(spark, d)
    return detector.add_partial_pressure(rows, _gains(spark, d, rows), 8.01e-5)


@query("AGG21", f"{D} kind run detector start end scans", f"""
SELECT {D}, 'run' AS kind, run, detector, min(receipt_ts) AS start, max(receipt_ts) AS "end", count(DISTINCT scan) AS scans FROM labelled_det GROUP BY ALL
UNION ALL SELECT {D}, 'stable', NULL, detector, min(receipt_ts), max(receipt_ts), NULL FROM labelled_det WHERE stable GROUP BY ALL""")
def run_summaries(spark, d):
    rows = _labelled(spark, d)
    return detector.run_summary(rows).withColumn("kind", F.lit("run")).unionByName(detector.stable_spans(rows).withColumn("kind", F.lit("stable")), allowMissingColumns=True)


@query("AGG22", f"{D} mass fc_mean_stable_torr:4@1e12 cdem_mean_stable_torr:4@1e12 cdem_over_fc_torr:6", f"""
SELECT *, cdem_mean_stable_torr / nullif(fc_mean_stable_torr, 0) AS cdem_over_fc_torr FROM (SELECT {D}, mass, avg(CASE WHEN detector = 'FC' THEN torr END) AS fc_mean_stable_torr,
  avg(CASE WHEN detector = 'CDEM' THEN torr END) AS cdem_mean_stable_torr FROM det_torr WHERE stable GROUP BY ALL)""")
def torr_pivot(spark, d):
    return detector.mean_torr_by_detector(partial_pressure(spark, d))


@query("AGG23", f"{D} mean_total_torr:4@1e12 mean_partial_sum_torr:4@1e12", f"""
SELECT {D}, mean_total_torr, mean_partial_sum_torr FROM (SELECT {D}, min(receipt_ts) AS a, max(receipt_ts) AS z FROM labelled_det WHERE stable AND detector = 'FC' GROUP BY ALL) w
LEFT JOIN (SELECT t.{D}, avg(total_pressure_torr) AS mean_total_torr FROM det_tp t JOIN (SELECT {D}, min(receipt_ts) AS a, max(receipt_ts) AS z FROM labelled_det WHERE stable AND detector = 'FC' GROUP BY ALL) w
  ON t.{D} = w.{D} AND receipt_ts BETWEEN a AND z GROUP BY ALL) USING ({D})
LEFT JOIN (SELECT {D}, avg(s) AS mean_partial_sum_torr FROM (SELECT {D}, scan, sum(torr) AS s FROM det_torr WHERE stable AND detector = 'FC' GROUP BY ALL) GROUP BY ALL) USING ({D})""")
def pressure_balance(spark, d):
    rows = partial_pressure(spark, d).select(D, "receipt_ts", "detector", "stable", "scan", "torr")
    return detector.pressure_balance(write_and_read(rows), _pressure(spark, d))
