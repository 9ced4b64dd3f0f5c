"""Gaussian kernel density and mixture curves on an even grid."""

import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from .mixture import histogram
from .sizes import settled

GRID_POINTS = 10_000
GRID_START = 100.0
BANDWIDTH = 5.0
_BLOCK = 256


def grid_end(df, column):
    """Largest value plus 51, rounded to hundreds (half to even)."""
    v = F.col(column).cast("double")
    top = df.agg(F.max(F.when(~F.isnan(v), v)).alias("m")).first()["m"]
    if top is None:
        raise ValueError(f"no values in {column}")
    return float(np.round(top + 51, -2))


def _partial_kernel_sums(grid, bandwidth):
    """Per task: the kernel sum of its share of the values at every grid point."""
    def run(batches):
        acc, total = np.zeros(len(grid)), 0.0
        for pdf in batches:
            values, counts = pdf["value"].to_numpy(), pdf["cnt"].to_numpy(dtype=float)
            total += counts.sum()
            for i in range(0, len(values), _BLOCK):
                z = (grid[None, :] - values[i:i + _BLOCK, None]) / bandwidth
                acc += counts[i:i + _BLOCK] @ np.exp(-0.5 * z * z)
        if total:
            yield pd.DataFrame({"point": np.arange(len(grid)), "kernel": acc, "total": total})

    return run


def kernel_density(df, column, end=None, start=GRID_START, points=GRID_POINTS, bandwidth=BANDWIDTH):
    """Density at ``points`` even steps: point, x, density.

    Values are compressed to (value, count); each task folds its values into one sum
    per grid point, so what is shuffled is tasks x points rows and no pair of value
    and grid point is ever a row.
    """
    end = grid_end(df, column) if end is None else end
    grid = np.linspace(start, end, points)
    partial = histogram(df, column).mapInPandas(
        _partial_kernel_sums(grid, bandwidth), "point int, kernel double, total double"
    )
    step = (end - start) / (points - 1)
    scale = bandwidth * math.sqrt(2 * math.pi)
    return partial.groupBy("point").agg(
        (F.sum("kernel") / (F.sum("total") * scale)).alias("density")
    ).select("point", (F.lit(start) + F.col("point") * step).alias("x"), "density")


REACH = 6  # bandwidths beyond which the kernel is left out; it is below 1.6e-8 of its peak there


def binned_density(df, column, end=None, start=GRID_START, points=GRID_POINTS, bandwidth=BANDWIDTH, reach=REACH):
    """kernel_density from linear bins: each value is split between its two neighbours on the grid, bins meet the kernel.

    Work is one pass over the values and grid points x window, whatever the values, all in DataFrame functions. The density differs
    from the direct sum by at most binned_error(step, bandwidth, reach).
    """
    end = grid_end(df, column) if end is None else end
    step = (end - start) / (points - 1)
    wide = math.ceil(reach * bandwidth / step)
    v = F.col(column).cast("double")
    at = df.select(((v - F.lit(start)) / F.lit(step)).alias("at")).where(F.col("at").isNotNull() & ~F.isnan("at"))
    # a value further out than the kernel reaches counts in the total only; it goes to a bin that reaches no point
    at = at.select(F.greatest(F.lit(-2.0 - wide), F.least(F.col("at"), F.lit(points + 1.0 + wide))).alias("at"))
    part = F.col("at") - F.floor("at")
    both = F.array(F.struct(F.floor("at").alias("bin"), (1 - part).alias("w")), F.struct((F.floor("at") + 1).alias("bin"), part.alias("w")))
    bins = settled(at.select(F.inline(both)).groupBy("bin").agg(F.sum("w").alias("w")), "bins")
    total = bins.agg(F.sum("w")).first()[0]
    z = F.col("k") * F.lit(step / bandwidth)
    spread = bins.select("bin", "w", F.explode(F.sequence(F.lit(-wide), F.lit(wide))).alias("k"))
    kernel = F.col("w") * F.exp(-0.5 * z * z)
    out = spread.select((F.col("bin") + F.col("k")).cast("int").alias("point"), kernel.alias("kernel")).where(F.col("point").between(0, points - 1))
    empty = df.sparkSession.range(points).select(F.col("id").cast("int").alias("point"), F.lit(0.0).alias("kernel"))  # points no value reaches
    return out.unionByName(empty).groupBy("point").agg((F.sum("kernel") / (total * bandwidth * math.sqrt(2 * math.pi))).alias("density")).select(
        "point", (F.lit(start) + F.col("point") * F.lit(step)).alias("x"), "density")


def binned_error(step, bandwidth, reach=REACH):
    """Bound of the error of binned_density: linear interpolation of the kernel, and its tail."""
    peak = 1 / (bandwidth * math.sqrt(2 * math.pi))
    return peak * ((step / bandwidth) ** 2 / 8 + math.exp(-0.5 * reach * reach))


def component_curves(components, end, start=GRID_START, points=GRID_POINTS):
    """Weighted normal curve of each mixture component on the grid."""
    step = (end - start) / (points - 1)
    z = (F.col("x") - F.col("mean")) / F.col("std")
    return (
        components.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point"))
        .withColumn("x", F.lit(start) + F.col("point") * step)
        .withColumn("density", F.col("weight") / (F.col("std") * math.sqrt(2 * math.pi)) * F.exp(-0.5 * z * z))
        .select("component", "point", "x", "density")
    )


def component_peaks(curves):
    return curves.groupBy("component").agg(F.max("density").alias("peak"))
