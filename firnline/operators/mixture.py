"""One-dimensional Gaussian mixture by expectation maximisation on aggregates.

The values are put into a fixed number of bins once, each with the count, mean and squared deviations of its values.
Every iteration is one aggregation over those rows, however many values there are, which serves all restarts
together; the driver holds nothing but the k weights, means and deviations of each restart. Responsibilities are
those of the bin means, moments those of the values, so what is lost is of the order of (bin width / deviation)^2, and nothing
where a bin has one distinct value.
"""

import math
import sys

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..schema import values_table

VARIANCE_FLOOR = 1e-6
BINS = 1 << 16


def rank_components(components):
    """Number the components from the heaviest on; the window sees one row per component."""
    w = Window.orderBy(F.desc("weight"), "mean")
    return components.withColumn("component", F.row_number().over(w))


def histogram(df, column):
    """Distinct values with their counts; NaN and null do not take part."""
    v = F.col(column).cast("double")
    return df.select(v.alias("value")).where(F.col("value").isNotNull() & ~F.isnan("value")).groupBy("value").agg(
        F.count("*").alias("cnt")
    )


def binned(df, column, bins=BINS):
    """At most ``bins`` rows (value, cnt, within) of even width: mean, count and squared deviations of the values of a bin.

    NaN and null do not take part.
    """
    v = F.col(column).cast("double")
    values = df.select(v.alias("v")).where(F.col("v").isNotNull() & ~F.isnan("v"))
    low, high = values.agg(F.min("v"), F.max("v")).first()
    if low is None:
        raise ValueError(f"no values in {column}")
    width = (high - low) / bins or 1.0
    bin_ = F.least(F.floor((F.col("v") - F.lit(low)) / F.lit(width)), F.lit(bins - 1))
    off = F.col("v") - (F.lit(low) + F.col("bin") * F.lit(width))  # small, so that squares keep their digits
    sums = values.withColumn("bin", bin_).groupBy("bin").agg(F.count("*").alias("cnt"), F.sum(off).alias("s"), F.sum(off * off).alias("q"))
    mean = F.col("s") / F.col("cnt")
    return sums.select(
        (F.lit(low) + F.col("bin") * F.lit(width) + mean).alias("value"), "cnt", F.greatest(F.col("q") - F.col("s") * mean, F.lit(0.0)).alias("within"))


def start_quantiles(k, n_init, seed):
    """Where the restarts put their means: evenly spaced quantiles first, then random quantiles."""
    rng = np.random.default_rng(seed)
    probs = [[(j + 0.5) / k for j in range(k)]] + [sorted(rng.uniform(0.01, 0.99, k)) for _ in range(n_init - 1)]
    return [[float(p) for p in row] for row in probs]


def _starts(df, column, k, n_init, seed):
    """Start parameters of every restart."""
    flat = [p for row in start_quantiles(k, n_init, seed) for p in row]
    col = F.col(column).cast("double")
    spread, *means = (
        df.where(col.isNotNull() & ~F.isnan(col))
        .agg(F.stddev_pop(col).alias("sd"), F.percentile_approx(col, flat, 1_000_000).alias("q"))
        .select("sd", *[F.col("q")[i] for i in range(len(flat))])
        .first()
    )
    if spread is None:
        raise ValueError(f"no values in {column}")
    sd = max(float(spread) / k, math.sqrt(VARIANCE_FLOOR))
    # equal start means could never part again
    return [
        [(1.0 / k, means[r * k + j] + 1e-3 * sd * j, sd) for j in range(k)] for r in range(n_init)
    ]


def _params_sql(states):
    def fields(comps):
        return ", ".join(f"'w{j}', {math.log(w)!r}D, 'm{j}', {m!r}D, 's{j}', {s!r}D" for j, (w, m, s) in enumerate(comps))

    return "array(" + ", ".join(f"named_struct('r', {r}, {fields(c)})" for r, c in states.items()) + ")"


def _expectation(hist, states, k):
    """One pass over the bins: per restart the responsibilities' sums and the log-likelihood."""
    comps = range(k)
    half_log_2pi = 0.5 * math.log(2 * math.pi)
    rows = (
        hist.selectExpr("value", "cnt", "within", f"inline({_params_sql(states)})")
        .selectExpr("*", *[
            f"w{j} - ln(s{j}) - {half_log_2pi!r}D - 0.5D * ((value - m{j}) / s{j}) * ((value - m{j}) / s{j}) AS l{j}" for j in comps
        ])
        .selectExpr("*", ("greatest(" + ", ".join(f"l{j}" for j in comps) + ")" if k > 1 else "l0") + " AS top")
        .selectExpr("*", *[f"exp(l{j} - top) AS e{j}" for j in comps])
        .selectExpr("*", " + ".join(f"e{j}" for j in comps) + " AS tot")
    )
    sums = ["sum(cnt) AS total", "sum(cnt * (top + ln(tot))) AS ll"]
    for j in comps:
        resp = f"cnt * e{j} / tot"
        sums += [f"sum({resp}) AS n{j}", f"sum({resp} * (value - m{j})) AS d{j}", f"sum({resp} * (value - m{j}) * (value - m{j}) + e{j} / tot * within) AS q{j}"]
    return {row["r"]: row for row in rows.groupBy("r").agg(*map(F.expr, sums)).collect()}


def _maximise(row, comps):
    out = []
    for j, (_, mean, _) in enumerate(comps):
        n = max(row[f"n{j}"], 10 * sys.float_info.epsilon)
        shift = row[f"d{j}"] / n
        var = max(row[f"q{j}"] / n - shift * shift, 0.0) + VARIANCE_FLOOR
        out.append((n / row["total"], mean + shift, math.sqrt(var)))
    return out


def gaussian_mixture(df, column, k, max_iter=1000, tol=1e-3, n_init=10, seed=0, bins=BINS):
    """Components of the best restart: component (heaviest first), mean, weight, std.

    Runs jobs when called, like any model fit.
    """
    hist = binned(df, column, bins).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        states = dict(enumerate(_starts(df, column, k, n_init, seed)))
        lower = dict.fromkeys(states, -math.inf)
        done = {}
        for _ in range(max_iter):
            rows = _expectation(hist, states, k)
            for r, row in rows.items():
                bound = row["ll"] / row["total"]
                states[r] = _maximise(row, states[r])
                if abs(bound - lower[r]) < tol:
                    done[r] = (bound, states.pop(r))
                lower[r] = bound
            if not states:
                break
        for r, comps in states.items():
            done[r] = (lower[r], comps)
    finally:
        hist.unpersist()
    _, best = max(done.values(), key=lambda d: d[0])
    best = sorted(best, key=lambda c: (-c[0], c[1]))
    rows = [(j + 1, m, w, s) for j, (w, m, s) in enumerate(best)]
    return values_table(df.sparkSession, ["component", "mean", "weight", "std"], rows)
