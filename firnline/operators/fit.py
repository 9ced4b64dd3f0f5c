"""Least-squares fits per group, computed from aggregated sums."""

from math import comb

from pyspark.sql import functions as F

from ..functions.hydro import poly_eval
from .sizes import settled


def linear_regression(df, x, y, key=None):
    """Slope, intercept and r2 of y on x."""
    fit = (
        F.regr_slope(F.col(y), F.col(x)).alias("slope"),
        F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
        F.regr_r2(F.col(y), F.col(x)).alias("r2"),
        F.regr_count(F.col(y), F.col(x)).alias("pairs"),
    )
    return df.groupBy(*([key] if key else [])).agg(*fit)


def _solved(sums, degree):
    """Columns c0..cd of the normal equations x0..x2d, y0..yd of each row, null where they are singular.

    Elimination written out as columns; the equations are in centred and scaled x, so no
    pivoting is needed.
    """
    size = degree + 1
    sums = sums.withColumns({f"a{i}{j}": F.col(f"x{i + j}") for i in range(size) for j in range(size)})
    sums = sums.withColumns({f"b{i}": F.col(f"y{i}") for i in range(size)})
    for k in range(size):
        pivot = F.when(F.col(f"a{k}{k}") > F.col("x0") * 1e-9, F.col(f"a{k}{k}"))
        sums = sums.withColumn("_pivot", pivot)
        rows = {}
        for i in range(k + 1, size):
            factor = F.col(f"a{i}{k}") / F.col("_pivot")
            rows |= {f"a{i}{j}": F.col(f"a{i}{j}") - factor * F.col(f"a{k}{j}") for j in range(k + 1, size)}
            rows[f"b{i}"] = F.col(f"b{i}") - factor * F.col(f"b{k}")
        sums = sums.withColumns(rows | {f"a{k}{k}": F.col("_pivot")})
    for k in reversed(range(size)):
        known = F.col(f"b{k}")
        for j in range(k + 1, size):
            known = known - F.col(f"a{k}{j}") * F.col(f"c{j}")
        sums = sums.withColumn(f"c{k}", known / F.col(f"a{k}{k}"))
    return sums


def poly_fit(df, key, x, y, degree, order=None):
    """Polynomial of degree 1 to 3 per group: coefs (highest power first), rss, pairs, first_x, last_x.

    Three passes over the data, each one aggregation: means and spread, power sums of the centred and scaled x, from
    which the coefficients follow as columns, and the residuals themselves. A difference of sums would have
    lost the digits of a good fit; the sum of squared residuals has them, and an error of the coefficients enters it by its square only.
    The per-group rows are settled between the passes, so that joining them does not shuffle
    the data by group. Groups with too few different x get null coefficients. ``order`` says which
    x is first and last (default: x).
    """
    if degree not in (1, 2, 3):
        raise ValueError("degree must be 1, 2 or 3")
    order = order or x
    rows = df.select(F.col(key).alias("key"), F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"),
                     F.col(order).alias("o")).dropna(subset=["x", "y"])
    stats = settled(rows.groupBy("key").agg(
        F.avg("x").alias("mx"), F.avg("y").alias("my"),
        F.when(F.stddev_pop("x") > 0, F.stddev_pop("x")).otherwise(F.lit(1.0)).alias("sx"),
        F.min_by("x", "o").alias("first_x"), F.max_by("x", "o").alias("last_x"),
    ), "fit-stats")

    def power(k):
        out = F.lit(1.0)
        for _ in range(k):
            out = out * F.col("t")
        return out

    centred = ((F.col("x") - F.col("mx")) / F.col("sx")).alias("t"), (F.col("y") - F.col("my")).alias("u")
    sums = (
        rows.join(stats, "key").select("key", *centred).groupBy("key")
        .agg(*[F.sum(power(k)).alias(f"x{k}") for k in range(2 * degree + 1)],
             *[F.sum(power(k) * F.col("u")).alias(f"y{k}") for k in range(degree + 1)], F.sum(F.col("u") * F.col("u")).alias("uu"))
    )
    solved = _solved(sums, degree).select("key", "x0", "uu", *[f"c{k}" for k in range(degree + 1)])
    solved = settled(solved.join(stats, "key"), "fits")
    value = F.lit(0.0)
    for k in reversed(range(degree + 1)):
        value = value * F.col("t") + F.col(f"c{k}")
    left = rows.join(solved, "key").select("key", *[f"c{k}" for k in range(degree + 1)], *centred).select("key", (F.col("u") - value).alias("r"))
    fits = solved.join(settled(left.groupBy("key").agg(F.sum(F.col("r") * F.col("r")).alias("left")), "residuals"), "key")
    # c in powers of (x - mx) / sx to powers of x
    scaled = [F.col(f"c{k}") / F.pow("sx", F.lit(k)) for k in range(degree + 1)]
    plain = []
    for power_of in range(degree + 1):
        terms = [scaled[k] * comb(k, power_of) * F.pow(-F.col("mx"), F.lit(k - power_of)) for k in range(power_of, degree + 1)]
        plain.append(sum(terms[1:], terms[0]))
    plain[0] = plain[0] + F.col("my")
    coefs = F.when(F.col(f"c{degree}").isNotNull(), F.array(*reversed(plain)))
    left = F.col("left")  # below the rounding of the residuals it is 0
    return fits.select(
        F.col("key").alias(key), coefs.alias("coefs"), F.when(left <= F.col("uu") * 1e-28, 0.0).otherwise(left).alias("rss"),
        F.col("x0").cast("long").alias("pairs"), "first_x", "last_x")


def poly_curve(fits, key, points=50):
    """The fitted curve at evenly spaced x from the first to the last x of each group."""
    step = (F.col("last_x") - F.col("first_x")) / (points - 1)
    return (
        fits.select(key, "coefs", "first_x", "last_x", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .withColumn("x", F.col("first_x") + F.col("point") * step)
        .select(key, "point", "x", poly_eval("x", "coefs").alias("y"))
    )
