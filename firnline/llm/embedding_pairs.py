"""Embedding near-duplicates: exact cosine links by PCA-ordered tiled comparison.

Equal vectors are one class, so copies are never compared with each other. Classes are turned into
the order of their principal components and sorted by the first into tiles of equal
size. Unit vectors at cosine t or more are at most sqrt(2 - 2t) apart, in the first component alone
as well, so a tile meets only the following tiles within that distance. A pair of tiles is
compared by blocks of leading components: after each block the part of a product that is still to come is at
most the product of the norms of the two rests (Cauchy-Schwarz), and a pair that cannot reach the
threshold any more is dropped. What is left is computed in double precision from the original vectors.

A task returns for each class with links how many vectors it is linked with there and the smallest
class of its component there, so rows grow with the vectors of a tile and not with its links.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from .common import components, cut

THRESHOLD = 0.9
TILE = 2048
SAMPLE = 4096  # rows that the components are fitted on; they decide the speed only
STEPS = (8, 16, 32)
ROWS = 256
SLACK = 1e-4


def usable(vector):
    """Whether a column of vectors can be compared: no null, no null or non-finite component, not all zero."""
    v = F.col(vector)
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return v.isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


def fit_components(vectors, rows=SAMPLE):
    """Principal directions of unit vectors (columns, largest first), from a bounded seeded sample."""
    sample = vectors.withColumn("h", F.xxhash64(F.lit(5), "v")).orderBy("h", "v").limit(rows).select("v").toPandas()["v"]
    if not len(sample):
        return None
    width = max(map(len, sample))
    x = np.stack([np.asarray(v, float) for v in sample if len(v) == width])
    x /= np.linalg.norm(x, axis=1)[:, None]
    values, directions = np.linalg.eigh(x.T @ x)
    return directions[:, np.argsort(-values)]


def _matrix(column):
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().astype(np.float64).reshape(len(flat), -1)


def _smallest(parent, i):
    while parent[i] != i:
        parent[i] = parent[parent[i]]
        i = parent[i]
    return i


def close_pairs(a, b, directions, threshold):
    """Row by row of ``a``: the rows of ``b`` at cosine ``threshold`` or more, exact."""
    norm = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    # scaled first, so that neither tiny nor huge vectors lose their direction
    a, b = a / np.abs(a).max(1)[:, None], b / np.abs(b).max(1)[:, None]
    p, q = norm(a) @ directions, norm(b) @ directions
    steps = [s for s in STEPS if s < p.shape[1]]
    rest = lambda x: {s: np.sqrt(np.maximum(0, 1 - (x[:, :s] ** 2).sum(1))) for s in steps}
    rest_a, rest_b = rest(p), rest(q)
    na, nb = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    low_p, low_q = p.astype(np.float32), q.astype(np.float32)
    for start in range(0, len(a), ROWS):
        rows = slice(start, min(start + ROWS, len(a)))
        # the first block for all pairs at once
        s = steps[0] if steps else p.shape[1]
        part = low_p[rows, :s] @ low_q[:, :s].T
        limit = np.float32(threshold - SLACK)
        if steps:
            part += np.outer(rest_a[s][rows], rest_b[s]).astype(np.float32)
        i, j = np.nonzero(part >= limit)
        if len(i) * 16 > part.size:  # many close pairs: whole products are cheaper than lists of pairs
            exact = (a[rows] @ b.T) / np.outer(na[rows], nb)
            i, j = np.nonzero(exact >= threshold)
        else:
            i += start
            done = 0
            total = np.zeros(len(i))
            for s in steps:
                total += np.einsum("ij,ij->i", p[i, done:s], q[j, done:s])
                alive = total + rest_a[s][i] * rest_b[s][j] >= threshold - SLACK
                i, j, total, done = i[alive], j[alive], total[alive], s
            exact = np.einsum("ij,ij->i", a[i], b[j]) / (na[i] * nb[j])
            alive = exact >= threshold
            i, j = i[alive] - start, j[alive]
        edges = np.searchsorted(i, np.arange(rows.stop - rows.start + 1))
        for r in range(rows.stop - rows.start):
            if edges[r] < edges[r + 1]:
                yield start + r, j[edges[r] : edges[r + 1]]


def _compare(directions, threshold):
    def run(t):
        own, side, ti, tj = (t[c].to_numpy() for c in ("node", "tile", "ti", "tj"))
        times = t["times"].to_numpy()
        x = _matrix(t["v"])
        one = np.flatnonzero(side == ti[0])
        two = one if ti[0] == tj[0] else np.flatnonzero(side == tj[0])
        parent, count = np.arange(len(own)), np.zeros(len(own), np.int64)
        if len(one) and len(two):
            for r, found in close_pairs(x[one], x[two], directions, threshold):
                found = two[found]
                i = one[r]
                if ti[0] == tj[0]:
                    found = found[found > i]
                if not len(found):
                    continue
                count[i] += times[found].sum()
                count[found] += times[i]
                roots = {_smallest(parent, i)}
                # most partners hang below few roots already
                up = parent[found]
                while True:
                    above = parent[up]
                    if (above == up).all():
                        break
                    up = above
                parent[found] = up
                roots.update(np.unique(up).tolist())
                first = min(roots)
                for c in roots:
                    parent[c] = first
        linked = np.flatnonzero(count)
        roots = np.array([_smallest(parent, k) for k in linked], np.int64)
        return pa.table({"node": pa.array(own[linked]), "n": pa.array(count[linked]), "root": pa.array(own[roots] if len(roots) else np.empty(0, np.int64))})

    return run


def near_duplicates(vectors, threshold=THRESHOLD, tile=TILE):
    """vec_id, n_links, component_id and kept of every row of ``vectors`` (vec_id, embedding).

    n_links counts the other rows at cosine ``threshold`` or more, copies among them; component_id is
    the smallest vec_id reachable over links, itself included; kept is vec_id = component_id. Vectors
    that are null, zero or have null or non-finite components, and rows without vec_id,
    link with nothing (component_id is their own vec_id). Vectors of different lengths
    link with nothing of another length. Repeated rows count as rows of their own. An empty table gives no rows;
    other columns are not read.
    """
    rows = vectors.select("vec_id", F.col("embedding").alias("v"))
    fit_for = usable("v") & F.col("vec_id").isNotNull()
    rows = rows.withColumn("h", F.when(fit_for, F.xxhash64(F.lit(3), F.size("v"), "v"))).withColumn("g", F.when(fit_for, F.xxhash64(F.lit(4), "v")))
    good = rows.where("h IS NOT NULL")
    classes = cut(good.groupBy("h", "g", "v").agg(F.min("vec_id").alias("low"), F.count("*").alias("times")).select(
        F.col("h").alias("node"), "g", "v", "low", "times", F.size("v").alias("width")))
    links, totals = [], []
    for width in [r.width for r in classes.select("width").distinct().collect()]:  # one per model that made vectors
        found = _within(classes.where(F.col("width") == width).drop("width"), threshold, tile)
        if found is not None:
            links.append(found.where("node != root").select(F.col("node").alias("a"), F.col("root").alias("b")))
            totals.append(found.groupBy("node").agg(F.sum("n").alias("n")))
    if not links:
        ids = classes.select("node", F.col("low").alias("component"), F.lit(0).cast("long").alias("n"), "times")
    else:
        union = lambda dfs: dfs[0] if len(dfs) == 1 else dfs[0].unionByName(union(dfs[1:]))
        comp = cut(components(union(links)))
        rooted = cut(classes.select("node", "low", "times").join(comp, "node", "left").select("node", "low", "times", F.coalesce("root", "node").alias("root")))
        lowest = cut(rooted.groupBy("root").agg(F.min("low").alias("component")))
        ids = rooted.join(lowest, "root").join(cut(union(totals)), "node", "left").select("node", "component", F.coalesce("n", F.lit(0)).alias("n"), "times")
    ids = cut(ids)
    done = good.select("vec_id", F.col("h").alias("node")).join(ids, "node").select("vec_id", (F.col("n") + F.col("times") - 1).alias("n_links"), F.col("component").alias("component_id"))
    rest = rows.where("h IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _within(classes, threshold, tile):
    """Links among vectors of one length: (node, n, root) per tile pair."""
    directions = fit_components(classes)
    first = [float(x) for x in directions[:, 0]]

    @F.pandas_udf("double")
    def leading(v: pd.Series) -> pd.Series:
        x = np.stack([np.asarray(r, float) for r in v]) if len(v) else np.empty((0, len(first)))
        x /= np.abs(x).max(1)[:, None] if len(x) else 1
        return pd.Series((x @ np.array(first)) / np.linalg.norm(x, axis=1) if len(x) else np.empty(0))

    placed = cut(classes.select("node", "v", "times", leading("v").alias("p")))
    count = max(1, -(-placed.count() // tile))
    limits = np.empty(0)
    if count > 1:
        limits = np.unique(placed.agg(F.percentile_approx("p", [k / count for k in range(1, count)], 10_000).alias("m")).first()["m"])
    # zone k holds p in (limits[k-1], limits[k]]; one that very many share is split by hash
    low, high = np.concatenate([[-np.inf], limits]), np.concatenate([limits, [np.inf]])
    reach = float(np.sqrt(2 - 2 * threshold) + 1e-6)
    since, until = np.searchsorted(high, low - reach, side="left"), np.searchsorted(low, high + reach, side="right") - 1
    edges = F.array(*[F.lit(float(x)) for x in limits])
    zoned = placed.withColumn("zone", F.size(F.filter(edges, lambda x: x < F.col("p"))) if len(limits) else F.lit(0))
    sizes = dict(map(tuple, zoned.groupBy("zone").count().collect()))  # one row per zone
    parts = np.array([max(1, -(-sizes.get(z, 0) // (2 * tile))) for z in range(len(low))])
    first_tile = np.concatenate([[0], np.cumsum(parts)])
    bounds = pd.DataFrame({"zone": range(len(low)), "parts": parts, "offset": first_tile[:-1], "since": first_tile[since], "until": first_tile[until + 1] - 1})
    table = placed.sparkSession.createDataFrame(bounds.astype("int32"), "zone int, parts int, offset int, since int, until int")
    tiled = zoned.join(F.broadcast(table), "zone")  # one row per tile
    tiled = tiled.withColumn("tile", F.col("offset") + F.pmod(F.xxhash64(F.lit(9), "node"), F.col("parts").cast("long")).cast("int"))
    spread = tiled.select("node", "v", "times", "tile", F.explode(F.sequence("since", "until")).alias("o"))
    spread = spread.select("node", "v", "times", "tile", F.least("tile", "o").alias("ti"), F.greatest("tile", "o").alias("tj"))
    return cut(spread.groupBy("ti", "tj").applyInArrow(_compare(directions, threshold), "node long, n long, root long"))
