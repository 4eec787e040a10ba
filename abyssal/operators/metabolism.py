"""Light/dark oxygen metabolism and the photosynthesis-irradiance curve per chamber."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from abyssal.functions.common import as_col, write_and_read
from abyssal.functions.exact import exact_avg
from abyssal.functions.scalars import jassby_platt
from abyssal.operators.stats import line_fit
from abyssal.schemas import DEFAULTS, KEY

MIN_FIT_POINTS = 4
LOWER_BOUND = 1e-9
# k = alpha / Pmax lies between a curve that is straight to 1 in 10^6 at the highest light and one that is flat at the lowest.
STRAIGHT, SATURATED = 1e-3, 6.0
FIRST_POINTS = 17  # values of ln k tried in the first pass
MOST_STEPS, NEWTON_TOLERANCE, BRACKET_TOLERANCE = 60, 1e-6, 1e-11  # a Newton step squares the error


def classify_o2_fluxes(
    fluxes: DataFrame,
    dark_threshold: float | str | Column = DEFAULTS["dark_par_threshold_umol_m2_s"],
    min_coverage: float | str | Column = DEFAULTS["min_par_coverage"],
    min_r2: float | str | Column = DEFAULTS["metabolism_min_r2"],
    transmittance: float | str | Column = DEFAULTS["chamber_par_transmittance"],
    keys: Sequence[str] = (KEY,),
) -> DataFrame:
    """One row per oxygen flux: period, why it is excluded (kept, not dropped), NCP and GPP.

    Respiration is each chamber's mean over used dark rows, so GPP is null without any.
    """
    if isinstance(transmittance, (int, float)) and not 0 < transmittance <= 1:
        raise ValueError("chamber_par_transmittance must be in (0, 1]")
    par = F.col("par_chamber_umol_m2_s")
    rows = fluxes.where("variable = 'oxygen'").withColumn(
        "par_chamber_umol_m2_s", F.col("par_mean_umol_m2_s") * as_col(transmittance)
    )
    period = F.when(par < as_col(dark_threshold), "dark").when(par.isNotNull(), "light")
    reason = (
        F.when(par.isNull(), "no PAR")
        .when(F.col("par_coverage") < as_col(min_coverage), "PAR coverage below minimum")
        .when(F.col("r2").isNull() | (F.col("r2") < as_col(min_r2)), "r2 below minimum")
    )
    rows = rows.select(
        *keys, "experiment_number", "chamber", "experiment_start", "par_mean_umol_m2_s", "par_integrated_mol_m2",
        "par_coverage", "par_chamber_umol_m2_s", F.col("output_value").alias("o2_flux_mmol_m2_h"), "r2",
        period.alias("period"), reason.isNull().alias("used"), reason.alias("excluded_reason"),
    )
    r_dark = dark_respiration(rows, keys)
    light = F.col("used") & (F.col("period") == "light")
    return rows.join(r_dark, [*keys, "chamber"], "left").withColumns(
        {
            "ncp_mmol_m2_h": F.when(light, F.col("o2_flux_mmol_m2_h")),
            "gpp_mmol_m2_h": F.when(light, F.col("o2_flux_mmol_m2_h") + F.col("r_dark_mmol_m2_h")),
        }
    ).drop("r_dark_mmol_m2_h")


def dark_respiration(rows: DataFrame, keys: Sequence[str] = (KEY,)) -> DataFrame:
    return rows.where("used AND period = 'dark'").groupBy(*keys, "chamber").agg(
        (-exact_avg("o2_flux_mmol_m2_h")).alias("r_dark_mmol_m2_h")
    )


def _centred(a: str, b: str) -> Column:
    """Sum of products about the means, from raw sums; `__1` is the number of points."""
    name = "__" + "_".join(sorted((a, b)))
    return F.col(name) - F.col(f"__{a}") * F.col(f"__{b}") / F.col("__1")


def _first_pass(points: DataFrame, limits: DataFrame, group: list[str]) -> DataFrame:
    """Per chamber the best of `FIRST_POINTS` values of ln k, all tried in one aggregate without copying a point."""
    step = (F.col("hi") - F.col("lo")) / (FIRST_POINTS - 1)
    at = [F.col("lo") + step * j for j in range(FIRST_POINTS)]
    rows = points.join(limits.select(*group, "lo", "hi", "__my"), group).withColumn("y", F.col("y") - F.col("__my"))
    x = [F.tanh(F.exp(u) * F.col("i")) for u in at]
    sums = rows.groupBy(*group, "lo", "hi", "__my").agg(
        F.count(F.lit(1)).alias("n"), F.sum("y").alias("sy"), F.sum(F.col("y") * F.col("y")).alias("syy"),
        *[c.alias(f"{n}{j}") for j, v in enumerate(x) for n, c in (("x", F.sum(v)), ("xx", F.sum(v * v)), ("xy", F.sum(v * F.col("y"))))])
    tries = []
    for j, u in enumerate(at):
        sxx, sxy = F.col(f"xx{j}") - F.col(f"x{j}") * F.col(f"x{j}") / F.col("n"), F.col(f"xy{j}") - F.col(f"x{j}") * F.col("sy") / F.col("n")
        rises = (sxx > 0) & (sxy > LOWER_BOUND * sxx)
        tries.append(F.when(rises, F.struct((F.col("syy") - sxy * sxy / sxx).alias("sse"), F.lit(j).alias("j"), u.alias("u"))))
    best = sums.select(*group, "lo", "hi", F.array_min(F.filter(F.array(*tries), lambda t: t.isNotNull())).alias("b"), step.alias("step"))
    return best.select(
        *group, F.col("b").isNull().alias("flat"), F.col("b.u").alias("u"), "lo", "hi",
        F.greatest("lo", F.col("b.u") - F.col("step")).alias("a"), F.least("hi", F.col("b.u") + F.col("step")).alias("z"),
        (F.col("b.j") <= 1).alias("low_open"), (F.col("b.j") >= FIRST_POINTS - 2).alias("high_open"))


def _newton_step(points: DataFrame, state: DataFrame, group: list[str]) -> DataFrame:
    """One Newton step in ln k on the squared error with Pmax and R solved for, kept inside [a, z]; one aggregate over the points.

    x = tanh(k i), p and q its first and second derivative by ln k. Where Newton leaves the bracket, an untried limit of k comes
    next, else the middle. On a limit with the error still falling outwards the search ends: the limit is the fit.
    """
    rows = points.join(state.where("NOT flat AND NOT done"), group)
    ki = F.exp("u") * F.col("i")
    x = F.tanh(ki)
    p = ki * (1 - x * x)
    q = p * (1 - 2 * ki * x)
    rows = rows.select(*group, "u", "a", "z", "lo", "hi", "low_open", "high_open", (F.col("y") - F.col("__my")).alias("y"), x.alias("x"), p.alias("p"), q.alias("q"))
    pairs = [("x", "x"), ("x", "y"), ("p", "y"), ("p", "x"), ("p", "p"), ("q", "y"), ("q", "x")]
    sums = rows.groupBy(*group, "u", "a", "z", "lo", "hi", "low_open", "high_open").agg(
        F.count(F.lit(1)).alias("__1"), *[F.sum(c).alias(f"__{c}") for c in "xypq"],
        *[F.sum(F.col(a) * F.col(b)).alias("__" + "_".join(sorted((a, b)))) for a, b in pairs])
    n = sums.select(*group, "u", "a", "z", "lo", "hi", "low_open", "high_open", _centred("x", "x").alias("s0"), _centred("x", "y").alias("c0"), _centred("p", "y").alias("c1"),
                    (2 * _centred("p", "x")).alias("s1"), _centred("q", "y").alias("c2"), (2 * (_centred("p", "p") + _centred("q", "x"))).alias("s2"))
    s0, s1, s2, c0, c1, c2 = (F.col(c) for c in ("s0", "s1", "s2", "c0", "c1", "c2"))
    pmax = c0 / s0
    slope = pmax * (pmax * s1 - 2 * c1)
    bend = pmax * (pmax * s2 - 2 * c2) - 2 * (c1 - pmax * s1) * (c1 - pmax * s1) / s0
    n = n.withColumns({"slope": slope, "bend": bend})
    u, falling = F.col("u"), F.col("slope") < 0
    n = n.withColumns({"a": F.when(falling, u).otherwise(F.col("a")), "z": F.when(falling, F.col("z")).otherwise(u),
                       "low_open": F.col("low_open") & ~falling, "high_open": F.col("high_open") & falling})
    newton = u - F.try_divide(F.col("slope"), F.col("bend"))
    inside = (F.col("bend") > 0) & (newton > F.col("a")) & (newton < F.col("z"))
    stuck = ((u == F.col("lo")) & ~falling) | ((u == F.col("hi")) & falling)
    middle = (F.col("a") + F.col("z")) / 2
    to = F.when(stuck, u).when(inside, newton).when(F.col("high_open"), F.col("hi")).when(F.col("low_open"), F.col("lo")).otherwise(middle)
    done = stuck | (inside & (F.abs(newton - u) <= NEWTON_TOLERANCE)) | (F.col("z") - F.col("a") <= BRACKET_TOLERANCE)
    return n.select(*group, to.alias("u"), "a", "z", "lo", "hi", "low_open", "high_open", F.lit(False).alias("flat"), done.alias("done"))


def fit_pi_curves(
    metabolism: DataFrame,
    transmittance: float | str | Column = DEFAULTS["chamber_par_transmittance"],
    keys: Sequence[str] = (KEY,),
    materialise: bool = True,
) -> DataFrame:
    """Least-squares Pmax, alpha, R of NCP = Pmax tanh(alpha I / Pmax) - R over each chamber's used rows, Pmax and alpha positive.

    With k = alpha / Pmax fixed the rest is a straight line, so the fit is in ln k alone: one pass over a coarse row of values, then
    Newton steps inside the bracket of the best, each one grouped aggregate. An optimum on a bound is a fit too: points on a straight line have
    the least k (Pmax far above them), points that are all saturated the greatest; where light lowers the flux, Pmax and alpha are
    `LOWER_BOUND`. Such fits have no standard errors. Fewer than four points or no light point: converged is false.
    """
    group = [*keys, "chamber"]
    used = metabolism.where("used").select(
        *group, "period", F.col("par_chamber_umol_m2_s").alias("i"), F.col("o2_flux_mmol_m2_h").alias("y")
    )
    if materialise:
        used = write_and_read(used)
    light, dark = F.col("period") == "light", F.col("period") == "dark"
    counts = used.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_points"), F.count_if(light).alias("n_light"), F.count_if(dark).alias("n_dark"),
        (-exact_avg(F.when(dark, F.col("y")))).alias("r_dark_mmol_m2_h"), exact_avg("y").alias("__mean"),
        F.max("i").alias("__top"), F.min(F.when(F.col("i") > 0, F.col("i"))).alias("__least"),
    )
    if materialise:
        counts = write_and_read(counts)
    fit_group = counts.where(f"n_points >= {MIN_FIT_POINTS} AND n_light > 0 AND __top > 0")
    lo, hi = F.ln(F.lit(STRAIGHT) / F.col("__top")), F.ln(F.lit(SATURATED) / F.col("__least"))
    limits = fit_group.select(*group, lo.alias("lo"), hi.alias("hi"), F.col("__mean").alias("__my"))
    points = used.select(*group, "i", "y")
    state = _first_pass(points, limits, group).withColumn("done", F.lit(False))
    found: list[DataFrame] = []
    centred = points.join(limits.select(*group, "__my"), group)
    if materialise:
        centred, state = write_and_read(centred), write_and_read(state)
    found.append(state.where("flat"))
    state = state.where("NOT flat")
    for n in range(MOST_STEPS):
        state = write_and_read(_newton_step(centred, state, group))  # a row per chamber
        found.append(state.where("done"))
        state = state.where("NOT done")
        if state.isEmpty():
            break
    found.append(state)  # the last bracket's point where the tolerance was not met
    params = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [f.select(*group, "u", "lo", "hi", "flat") for f in found])
    x = F.tanh(F.exp("u") * F.col("i"))
    line = line_fit(centred.join(params.where("NOT flat"), group), [*group, "u", "lo", "hi"], x, F.col("y"))
    line = line.select(*group, F.greatest("slope", F.lit(LOWER_BOUND)).alias("pmax"), F.greatest(F.col("slope") * F.exp("u"), F.lit(LOWER_BOUND)).alias("alpha"),
                       (-F.col("intercept")).alias("r"), ((F.col("u") <= F.col("lo")) | (F.col("u") >= F.col("hi"))).alias("__bound"))
    flat = params.where("flat").join(counts.select(*group, "__mean"), group).select(
        *group, F.lit(LOWER_BOUND).alias("pmax"), F.lit(LOWER_BOUND).alias("alpha"), (-F.col("__mean")).alias("r"), F.lit(True).alias("__bound"))
    params = line.unionByName(flat)
    if materialise:  # a row per chamber; the search is not repeated for the errors
        params = write_and_read(params)
    return _with_errors(used, counts, params, group, transmittance)


def _with_errors(used: DataFrame, counts: DataFrame, params: DataFrame, group: list[str], transmittance) -> DataFrame:
    base = counts.join(params, group, "left")
    u = F.col("alpha") * F.col("i") / F.col("pmax")
    sech2 = 1 - F.pow(F.tanh(u), 2)
    jac = used.join(base.where("pmax IS NOT NULL"), group).select(
        *group, (F.tanh(u) - u * sech2).alias("a"), (F.col("i") * sech2).alias("b"),
        F.pow(F.col("y") - jassby_platt(F.col("i"), F.col("pmax"), F.col("alpha"), F.col("r")), 2).alias("e2"),
        F.pow(F.col("y") - F.col("__mean"), 2).alias("t2"),
    )
    s = jac.groupBy(*group).agg(
        F.sum(F.col("a") * F.col("a")).alias("aa"), F.sum(F.col("a") * F.col("b")).alias("ab"), F.sum("a").alias("sa"),
        F.sum(F.col("b") * F.col("b")).alias("bb"), F.sum("b").alias("sb"), F.count(F.lit(1)).cast("double").alias("n"),
        F.sum("e2").alias("sse"), F.sum("t2").alias("sst"),
    )
    aa, ab, sa, bb, sb, n = (F.col(c) for c in ("aa", "ab", "sa", "bb", "sb", "n"))
    det = aa * (bb * n - sb * sb) - ab * (ab * n - sb * sa) + sa * (ab * sb - bb * sa)
    variance = F.when((det > 0) & (n > 3), F.col("sse") / (n - 3) / det)
    root = lambda cofactor: F.when(~F.col("__bound") & (variance * cofactor >= 0), F.sqrt(variance * cofactor))
    s = s.join(params.select(*group, "__bound"), group)
    errors = s.select(
        *group,
        root(bb * n - sb * sb).alias("pmax_se"),
        root(aa * n - sa * sa).alias("alpha_se"),
        root(aa * bb - ab * ab).alias("r_fit_se"),
        F.when(F.col("sst") > 0, 1 - F.col("sse") / F.col("sst")).alias("fit_r2"),
    )
    return base.join(errors, group, "left").select(
        *group,
        as_col(transmittance).alias("chamber_par_transmittance"),
        "n_points", "n_light", "n_dark", "r_dark_mmol_m2_h",
        F.col("pmax").alias("pmax_mmol_m2_h"), "pmax_se",
        F.col("alpha").alias("alpha_mmol_m2_h_per_par"), "alpha_se",
        F.col("r").alias("r_fit_mmol_m2_h"), "r_fit_se",
        (F.col("pmax") / F.col("alpha")).alias("ik_umol_m2_s"),
        "fit_r2",
        F.col("pmax").isNotNull().alias("converged"),
    )


def pi_curves(fits: DataFrame, placed: DataFrame, points: int = 200, keys: Sequence[str] = (KEY,)) -> DataFrame:
    """The fitted curve of every converged chamber on an even grid up to 1.05 times the highest PAR."""
    top = placed.groupBy(*keys).agg((F.max("par_chamber_umol_m2_s") * 1.05).alias("top"))
    rows = fits.where("converged").join(top, list(keys))
    rows = rows.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(points - 1))))
    par = F.col("top") * F.col("point") / (points - 1)
    return rows.select(
        *keys, "chamber", F.col("point").cast("bigint").alias("point"), par.alias("par"),
        jassby_platt(par, F.col("pmax_mmol_m2_h"), F.col("alpha_mmol_m2_h_per_par"), F.col("r_fit_mmol_m2_h")).alias("flux"),
    )
