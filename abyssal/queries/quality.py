"""Data-quality queries: gaps, completeness, coverage and range flags over every stream."""

from __future__ import annotations

from pyspark.sql import functions as F

from abyssal import standin
from abyssal.functions.common import write_and_read
from abyssal.functions.scalars import humanize_seconds
from abyssal.operators import quality, ranges
from abyssal.queries.base import query
from abyssal.queries.ctes import CTES
from abyssal.queries.sequences import ALL_TIMES
from abyssal.schemas import KEY

D = KEY
CADENCE = ", ".join(f"('{t}', {n}, {g})" for t, _, n, g in quality.STREAM_CADENCE)
CTES["qc_times"] = f"""
SELECT DISTINCT {D}, tbl, grp, ts FROM (SELECT {D}, 'rga' AS tbl, mass::VARCHAR AS grp, ts FROM rga UNION ALL SELECT {D}, 'hobo_oxygen', location, ts FROM hobo
  UNION ALL SELECT {D}, tbl, NULL, ts FROM ({ALL_TIMES}) WHERE tbl NOT IN ('rga', 'hobo_oxygen'))"""
CTES["qc_nominal"] = f"""
SELECT b.{D}, tbl, CASE WHEN tbl = 'par' THEN m.own ELSE nominal::DOUBLE END AS nominal_interval_s, gap::DOUBLE AS gap_threshold_s
FROM bounds b JOIN (SELECT {D}, median(interval_s) AS own FROM par GROUP BY ALL) m USING ({D}), (VALUES {CADENCE}) c(tbl, nominal, gap)"""
CTES["qc_gaps"] = f"""
SELECT g.{D}, g.tbl, grp, gap_start, ts AS gap_end, (epoch_us(ts) - epoch_us(gap_start)) / 1e6 AS gap_s
FROM (SELECT *, lag(ts) OVER (PARTITION BY {D}, tbl, grp ORDER BY ts) AS gap_start FROM (
  SELECT * FROM qc_times UNION SELECT {D}, tbl, grp, lo FROM (SELECT DISTINCT {D}, tbl, grp FROM qc_times) JOIN bounds USING ({D})
  UNION SELECT {D}, tbl, grp, hi FROM (SELECT DISTINCT {D}, tbl, grp FROM qc_times) JOIN bounds USING ({D}))) g
JOIN qc_nominal n ON g.{D} = n.{D} AND g.tbl = n.tbl WHERE (epoch_us(ts) - epoch_us(gap_start)) / 1e6 > gap_threshold_s"""
CTES["qc_scores"] = f"""
SELECT s.*, expected, CASE WHEN expected > 0 THEN least(observed / expected, 1.0) END AS completeness, coalesce(n_gaps, 0) AS n_gaps, coalesce(longest, 0) AS longest_gap_s,
       coalesce(total, 0) AS total_gap_s, (epoch_us(hi) - epoch_us(last_record)) / 1e6 AS staleness_s
FROM (SELECT t.{D}, t.tbl, t.grp, CASE WHEN grp IS NULL THEN t.tbl ELSE t.tbl || ' ' || grp END AS stream, any_value(nominal_interval_s) AS nominal_interval_s,
             any_value(gap_threshold_s) AS gap_threshold_s, count(*) AS observed, max(ts) AS last_record, any_value(hi) AS hi,
             any_value((epoch_us(hi) - epoch_us(lo)) / 1e6 / nominal_interval_s) AS expected
      FROM qc_times t JOIN qc_nominal n ON t.{D} = n.{D} AND t.tbl = n.tbl JOIN bounds b ON t.{D} = b.{D} GROUP BY ALL) s
LEFT JOIN (SELECT {D}, tbl, grp, count(*) AS n_gaps, max(gap_s) AS longest, sum(gap_s) AS total FROM qc_gaps GROUP BY ALL) g
  ON s.{D} = g.{D} AND s.tbl = g.tbl AND s.grp IS NOT DISTINCT FROM g.grp"""


def _parts(spark, d):
    tables = standin.streams(spark, d)
    times = write_and_read(quality.stream_times(tables))
    bounds = write_and_read(ranges.time_bounds(tables))
    nominal = quality.nominal_intervals(bounds, tables)
    return tables, times, bounds, nominal


def _named(df):
    return df.withColumnsRenamed({"table": "tbl", "group": "grp"})


@query("QC01", f"{D} tbl grp gap_start gap_end gap_s:6", "SELECT * FROM qc_gaps")
def gaps(spark, d):
    _, times, bounds, nominal = _parts(spark, d)
    return _named(quality.find_gaps(times, nominal, bounds))


def _scores(spark, d):
    _, times, bounds, nominal = _parts(spark, d)
    return quality.completeness(times, nominal, write_and_read(quality.find_gaps(times, nominal, bounds)), bounds)


@query("QC02", f"{D} stream nominal_interval_s gap_threshold_s expected:3 observed completeness:7 n_gaps longest_gap_s:4 total_gap_s:3 last_record staleness_s:6", "SELECT * FROM qc_scores")
def scores(spark, d):
    return _scores(spark, d)


SEGMENTS = f"""
SELECT {D}, CASE WHEN grp IS NULL THEN tbl ELSE tbl || ' ' || grp END AS stream, seg_start, seg_end FROM (
  SELECT s.{D}, s.tbl, s.grp, s.seg_start, coalesce(lead(s.cut) OVER (PARTITION BY s.{D}, s.tbl, s.grp ORDER BY s.o), hi) AS seg_end FROM (
    SELECT {D}, tbl, grp, lo AS seg_start, NULL::TIMESTAMP AS cut, 0 AS o FROM (SELECT DISTINCT {D}, tbl, grp FROM qc_times) JOIN bounds USING ({D})
    UNION ALL SELECT {D}, tbl, grp, gap_end, gap_start, epoch_us(gap_start) FROM qc_gaps) s JOIN bounds USING ({D})) WHERE seg_start < seg_end"""


@query("QC03", f"{D} stream seg_start seg_end", SEGMENTS)
def segments(spark, d):
    _, times, bounds, nominal = _parts(spark, d)
    return quality.coverage_segments(times, write_and_read(quality.find_gaps(times, nominal, bounds)), bounds)


def _flag(table: str, column: str, limits) -> str:
    def outside(lo, hi):
        c = [f"{column} < {lo!r}::DOUBLE"] if lo is not None else []
        c += [f"{column} > {hi!r}::DOUBLE"] if hi is not None else []
        return " OR ".join(c) or "false"

    source = "hobo" if table == "hobo_oxygen" else table
    return f"""SELECT {D}, '{table}' AS tbl, '{column}' AS col, ts, {column} AS value, CASE WHEN {column} IS NULL THEN 'missing' WHEN {outside(*limits[:2])} THEN 'fail'
  WHEN {outside(*limits[2:])} THEN 'suspect' ELSE 'pass' END AS flag FROM {source}"""


CTES["qc_flags"] = " UNION ALL ".join(_flag(t, c, lim) for (t, c), lim in quality.RANGE_LIMITS.items())


@query("QC04", f"{D} tbl col ts value:6 flag", "SELECT * FROM qc_flags")
def flags(spark, d):
    return quality.flagged_values(standin.streams(spark, d)).withColumnsRenamed({"table": "tbl", "column": "col"})


@query("QC05", f"{D} tbl col n n_null n_suspect n_fail pct_flagged:6 min:6 max:6 first_flag_ts last_flag_ts", f"""
SELECT {D}, tbl, col, count(*) AS n, count_if(flag = 'missing')::BIGINT AS n_null, count_if(flag = 'suspect')::BIGINT AS n_suspect, count_if(flag = 'fail')::BIGINT AS n_fail,
       100.0 * count_if(flag IN ('suspect', 'fail')) / count(*) AS pct_flagged, min(value) AS "min", max(value) AS "max",
       min(CASE WHEN flag IN ('suspect', 'fail') THEN ts END) AS first_flag_ts, max(CASE WHEN flag IN ('suspect', 'fail') THEN ts END) AS last_flag_ts FROM qc_flags GROUP BY ALL""")
def flag_summary(spark, d):
    return quality.range_summary(quality.flagged_values(standin.streams(spark, d))).withColumnsRenamed({"table": "tbl", "column": "col"})


@query("QC06", f"{D} tbl col ts value:6 flag", "SELECT * FROM qc_flags WHERE flag IN ('suspect', 'fail')")
def flagged(spark, d):
    return quality.flagged_rows(quality.flagged_values(standin.streams(spark, d))).withColumnsRenamed({"table": "tbl", "column": "col"})


@query("ORD02", f"{D} tbl col ts value:6 flag", f"SELECT * FROM qc_flags WHERE flag IN ('suspect', 'fail') ORDER BY tbl, col, ts, {D} LIMIT 10000")
def first_flagged(spark, d):
    """The display limit of the drill-down table is the feature here."""
    return quality.flagged_rows(quality.flagged_values(standin.streams(spark, d)), 10_000).withColumnsRenamed({"table": "tbl", "column": "col"})


@query("QC07", f"{D} tbl nominal_interval_s gap_threshold_s", "SELECT * FROM qc_nominal")
def nominal(spark, d):
    return _named(_parts(spark, d)[3])


@query("QC08", f"{D} stream attention longest_gap total_gap", f"""
SELECT {D}, stream, completeness < 0.9 OR staleness_s > gap_threshold_s AS attention, {{}} AS longest_gap, {{}} AS total_gap FROM qc_scores""".format(
    *[f"CASE WHEN s{i} // 86400 <> 0 THEN (s{i} // 86400) || 'd ' || (s{i} % 86400 // 3600) || 'h' WHEN s{i} // 3600 <> 0 THEN (s{i} // 3600) || 'h ' || (s{i} % 3600 // 60) || 'm' "
      f"WHEN s{i} // 60 <> 0 THEN (s{i} // 60) || 'm' ELSE s{i} || 's' END" for i in (1, 2)]).replace("FROM qc_scores", "FROM (SELECT *, round_even(longest_gap_s, 0)::BIGINT AS s1, round_even(total_gap_s, 0)::BIGINT AS s2 FROM qc_scores)"))
def attention(spark, d):
    rows = quality.needs_attention(_scores(spark, d))
    return rows.withColumns({"longest_gap": humanize_seconds(F.col("longest_gap_s")), "total_gap": humanize_seconds(F.col("total_gap_s"))})


@query("QC09", "tbl n_streams n_limits n_records", f"""
SELECT tbl, count(DISTINCT tbl) AS n_streams, any_value(n_limits) AS n_limits, count(*) AS n_records FROM ({ALL_TIMES})
JOIN (SELECT * FROM (VALUES {", ".join(f"('{t}', {sum(1 for x, _ in quality.RANGE_LIMITS if x == t)}::BIGINT)" for t, *_ in quality.STREAM_CADENCE)}) v(tbl, n_limits)) USING (tbl) GROUP BY tbl""")
def configured(spark, d):
    """Configured streams and limits against the loaded tables."""
    tables = standin.streams(spark, d)
    rows = ranges.overview(tables).groupBy("table").agg(F.sum("rows").alias("n_records"))
    limits = F.lit(0)
    streams = F.lit(0)
    for t, *_ in quality.STREAM_CADENCE:
        limits = F.when(F.col("table") == t, F.lit(sum(1 for x, _ in quality.RANGE_LIMITS if x == t))).otherwise(limits)
        streams = F.when(F.col("table") == t, F.lit(1)).otherwise(streams)
    return rows.select(F.col("table").alias("tbl"), streams.alias("n_streams"), limits.alias("n_limits"), "n_records")


@query("QC10", f"{D} tbl grp n first_ts last_ts", f"SELECT {D}, tbl, grp, count(*) AS n, min(ts) AS first_ts, max(ts) AS last_ts FROM qc_times GROUP BY ALL")
def normalised(spark, d):
    times = quality.stream_times(standin.streams(spark, d))
    return _named(times.groupBy(*quality.STREAM).agg(F.count(F.lit(1)).alias("n"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))


# The same without a range: every stream over its own span, and gaps between records only.
CTES["own_spans"] = f"SELECT {D}, tbl, min(ts) AS lo, max(ts) AS hi FROM qc_times GROUP BY ALL"
CTES["own_gaps"] = f"""
SELECT g.{D}, g.tbl, grp, gap_start, ts AS gap_end, (epoch_us(ts) - epoch_us(gap_start)) / 1e6 AS gap_s
FROM (SELECT *, lag(ts) OVER (PARTITION BY {D}, tbl, grp ORDER BY ts) AS gap_start FROM qc_times) g
JOIN qc_nominal n ON g.{D} = n.{D} AND g.tbl = n.tbl WHERE (epoch_us(ts) - epoch_us(gap_start)) / 1e6 > gap_threshold_s"""
CTES["own_scores"] = CTES["qc_scores"].replace(f"JOIN bounds b ON t.{D} = b.{D}", f"JOIN own_spans b ON t.{D} = b.{D} AND t.tbl = b.tbl").replace("qc_gaps", "own_gaps")


def _own_parts(spark, d):
    _, times, _, nominal = _parts(spark, d)
    return times, nominal, write_and_read(quality.find_gaps(times, nominal))


@query("QC02_own", f"{D} stream nominal_interval_s gap_threshold_s expected:3 observed completeness:7 n_gaps longest_gap_s:4 total_gap_s:3 last_record staleness_s:6", "SELECT * FROM own_scores")
def own_scores(spark, d):
    return quality.completeness(*_own_parts(spark, d))


@query("QC03_own", f"{D} stream seg_start seg_end", SEGMENTS.replace(f"JOIN bounds USING ({D})", f"JOIN own_spans USING ({D}, tbl)").replace("qc_gaps", "own_gaps"))
def own_segments(spark, d):
    times, _, gaps = _own_parts(spark, d)
    return quality.coverage_segments(times, gaps)


@query("QC10_own", f"{D} tbl lo hi", f"""
SELECT {D}, tbl, CASE WHEN half THEN TIMESTAMP '2024-01-08' ELSE min(ts) END AS lo, max(ts) AS hi
FROM (SELECT *, substr({D}, 2)::INT % 2 = 0 AS half FROM qc_times) WHERE NOT half OR ts >= TIMESTAMP '2024-01-08' GROUP BY {D}, tbl, half""")
def half_open_ranges(spark, d):
    """Range bounds from the argument where given (a start for every other deployment), else from the data."""
    times = write_and_read(quality.stream_times(standin.streams(spark, d)))
    given = standin.deployments(spark, d).where(F.substring(D, 2, 10).cast("int") % 2 == 0)
    given = given.select(D, F.lit("2024-01-08").cast("timestamp_ntz").alias("lo"), F.lit(None).cast("timestamp_ntz").alias("hi"))
    return _named(quality.own_spans(times, times.select(D, "table").distinct(), given))
