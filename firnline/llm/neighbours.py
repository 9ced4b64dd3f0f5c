"""Approximate nearest neighbours: a hierarchical navigable small-world graph per shard.

Distinct vectors are dealt to shards of bounded size by a hash. Each shard builds its graph:
nodes get levels of exponentially falling size, and on each level they are linked in a few rounds
of doubling size, so early nodes get far links and later ones near links; of the nearest nodes so far
a node keeps those that are closer to it than to a neighbour it has already. A shard is one row of flat
arrays. Queries meet every shard in blocks; a search goes down the levels with a beam, for all
queries of a block at once, and the best of all shards are merged per query.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import cut
from .embedding_pairs import _matrix, usable

SHARD = 8192
BLOCK = 2048
LINKS = 16
NEAR = 48  # nearest nodes that links are chosen from
BEAM = 160
JITTER = np.float32(1e-6)
K = 5
EVERY = 50


def _unit(x):
    x = x / np.abs(x).max(1)[:, None]
    return x / np.linalg.norm(x, axis=1)[:, None]


def _diverse(x, own, near, sims, most):
    """Per row of ``near`` (sorted by similarity, -1 for none): the candidates to link, at most ``most``."""
    out = np.full((len(own), most), -1, np.int32)
    for start in range(0, len(own), 256):
        c, s = near[start : start + 256], sims[start : start + 256]
        vectors = x[np.maximum(c, 0)]
        among = np.einsum("bik,bjk->bij", vectors, vectors)
        chosen = np.zeros(c.shape, bool)
        for k in range(c.shape[1]):
            rival = np.where(chosen, among[:, k], -np.inf).max(1)
            chosen[:, k] = (c[:, k] >= 0) & (rival < s[:, k]) & (chosen.sum(1) < most)
        # free places go to the nearest of the rest
        order = np.argsort(np.where(chosen, 0, np.where(c >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
        picked = np.take_along_axis(c, order, 1)
        out[start : start + 256, : picked.shape[1]] = picked
    return out


def _level(x, most, rng):
    """Neighbour array of one level: row i holds the links of node i, -1 behind the last.

    Candidates whose similarities single precision hardly tells apart come in random order, else they would all link
    to the same few of them and leave others without a way in.
    """
    n = len(x)
    links = np.full((n, most), -1, np.int32)
    done, size = 1, 32
    while done < n:
        end = min(n, done + size)
        new = np.arange(done, end)
        near, sims = np.empty((len(new), min(NEAR, end - 1)), np.int32), np.empty((len(new), min(NEAR, end - 1)), np.float32)
        for start in range(0, len(new), 512):
            rows = new[start : start + 512]
            s = x[rows] @ x[:end].T + JITTER * rng.random((len(rows), end), np.float32)
            s[np.arange(len(rows)), rows] = -np.inf
            top = np.argpartition(-s, near.shape[1] - 1, axis=1)[:, : near.shape[1]]
            value = np.take_along_axis(s, top, 1)
            order = np.argsort(-value, axis=1, kind="stable")
            near[start : start + 512], sims[start : start + 512] = np.take_along_axis(top, order, 1), np.take_along_axis(value, order, 1)
        links[new] = _diverse(x, new, near, sims, most)[:, :most]
        # the way back, and choosing anew where there are too many
        a, b = np.repeat(new, most), links[new].ravel()
        a, b = b[b >= 0], a[b >= 0]
        touched = np.unique(a)
        old = links[touched]
        a, b = np.concatenate([a, np.repeat(touched, most)]), np.concatenate([b, old.ravel()])
        a, b = a[b >= 0], b[b >= 0]
        both = np.unique(a.astype(np.int64) << 32 | b)
        a, b = (both >> 32).astype(np.int32), (both & 0xFFFFFFFF).astype(np.int32)
        value = np.einsum("ij,ij->i", x[a], x[b]) + JITTER * rng.random(len(a), np.float32)
        order = np.lexsort((-value, a))
        a, b, value = a[order], b[order], value[order]
        begin = np.searchsorted(a, touched)
        place = np.arange(len(a)) - begin[np.searchsorted(touched, a)]
        wide = min(max(most, int(place.max()) + 1), 2 * NEAR)
        keep = place < wide
        near, sims = np.full((len(touched), wide), -1, np.int32), np.full((len(touched), wide), -np.inf, np.float32)
        row = np.searchsorted(touched, a[keep])
        near[row, place[keep]], sims[row, place[keep]] = b[keep], value[keep]
        full = (near >= 0).sum(1) > most
        links[touched[~full]] = near[~full, :most]
        if full.any():
            links[touched[full]] = _diverse(x, touched[full], near[full], sims[full], most)
        done, size = end, size * 2
    return links


def build(vectors, seed=3):
    """The graph of a shard: order of insertion, and per level its nodes and their neighbour array."""
    x = _unit(np.asarray(vectors, np.float64)).astype(np.float32)
    rng = np.random.default_rng(seed)
    height = np.floor(-np.log(rng.random(len(x))) / np.log(LINKS)).astype(int)
    levels = []
    for h in range(int(height.max()) + 1):
        nodes = np.flatnonzero(height >= h)
        nodes = nodes[rng.permutation(len(nodes))]
        levels.append((nodes.astype(np.int32), _level(x[nodes], 2 * LINKS if h == 0 else LINKS, rng)))
    return levels


def _beam(x, nodes, links, queries, entries, ef):
    """Per query the ``ef`` nearest nodes met (positions on this level, best first), starting at ``entries``."""
    n, q = len(nodes), len(queries)
    y = x[nodes]
    best = np.full((q, ef), -1, np.int64)
    sims = np.full((q, ef), -np.inf, np.float32)
    opened = np.ones((q, ef), bool)
    seen = np.zeros((q, n), bool)
    width = min(ef, entries.shape[1])
    best[:, :width] = entries[:, :width]
    valid = best >= 0
    sims[valid] = np.einsum("ij,ij->i", queries[np.nonzero(valid)[0]], y[best[valid]])
    opened[valid] = False
    seen[np.nonzero(valid)[0], best[valid]] = True
    live = np.arange(q)
    while len(live):
        waiting = np.where(opened[live], -np.inf, sims[live])
        pick = waiting.argmax(1)
        live = live[waiting[np.arange(len(live)), pick] > -np.inf]
        if not len(live):
            break
        waiting = np.where(opened[live], -np.inf, sims[live])
        pick = waiting.argmax(1)
        at = best[live, pick]
        opened[live, pick] = True
        near = links[at].astype(np.int64)
        new = (near >= 0) & ~seen[live[:, None], np.maximum(near, 0)]
        r, c = np.nonzero(new)
        if not len(r):
            continue
        seen[live[r], near[r, c]] = True
        s = np.full(near.shape, -np.inf, np.float32)
        s[r, c] = np.einsum("ij,ij->i", queries[live[r]], y[near[r, c]])
        some = np.unique(r)
        rows = live[some]
        all_sims = np.concatenate([sims[rows], s[some]], 1)
        all_best = np.concatenate([best[rows], np.where(new[some], near[some], -1)], 1)
        all_open = np.concatenate([opened[rows], ~new[some]], 1)
        order = np.argsort(-all_sims, axis=1, kind="stable")[:, :ef]
        sims[rows], best[rows], opened[rows] = (np.take_along_axis(v, order, 1) for v in (all_sims, all_best, all_open))
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(best, order, 1)


def search(vectors, levels, queries, ef=BEAM):
    """Positions of the ``ef`` nearest vectors found for each query, by single precision; -1 where there are fewer."""
    x, q = _unit(np.asarray(vectors, np.float64)).astype(np.float32), _unit(np.asarray(queries, np.float64)).astype(np.float32)
    entries = np.zeros((len(q), 1), np.int64)
    for h in range(len(levels) - 1, -1, -1):
        nodes, links = levels[h]
        found = _beam(x, nodes, links, q, entries, ef if h == 0 else 8)
        if h == 0:
            return np.where(found >= 0, nodes[np.maximum(found, 0)], -1)
        place = np.full(len(x), -1, np.int64)
        place[levels[h - 1][0]] = np.arange(len(levels[h - 1][0]))
        entries = np.where(found >= 0, place[nodes[np.maximum(found, 0)]], -1)


def _index(table):
    """One row per shard: its nodes, vectors and the neighbour arrays of all levels end to end."""
    order = np.lexsort((table["node"].to_numpy(), table["low"].to_numpy()))
    node, low, x = table["node"].to_numpy()[order], table["low"].to_numpy()[order], _matrix(table["v"])[order]
    # vectors that single precision cannot tell apart would only link to each other; they are one node of the graph
    _, first, of = np.unique(_unit(x).astype(np.float32), axis=0, return_index=True, return_inverse=True)
    levels = build(x[first])
    return pa.table({
        "shard": pa.array([table["shard"][0].as_py()], pa.int32()), "node": pa.array([node], pa.list_(pa.int64())), "v": pa.array([x.tobytes()], pa.binary()),
        "low": pa.array([low], pa.list_(pa.int64())), "of": pa.array([of.ravel().astype(np.int32)], pa.list_(pa.int32())),
        "sizes": pa.array([[len(n) for n, _ in levels]], pa.list_(pa.int32())),
        "members": pa.array([np.concatenate([n for n, _ in levels])], pa.list_(pa.int32())),
        "links": pa.array([np.concatenate([e.ravel() for _, e in levels])], pa.list_(pa.int32()))})


def _search(k):
    schema = {"query": pa.int64(), "query_node": pa.int64(), "node": pa.int64(), "score": pa.float64()}

    def run(queries, index):
        if not len(index) or not len(queries):
            return pa.table({c: pa.array([], t) for c, t in schema.items()})
        row = index.slice(0, 1).to_pydict()
        node = np.array(row["node"][0], np.int64)
        x = np.frombuffer(row["v"][0]).reshape(len(node), -1)
        members, links = np.array(row["members"][0], np.int32), np.array(row["links"][0], np.int32)
        levels, m, e = [], 0, 0
        for h, n in enumerate(row["sizes"][0]):
            most = 2 * LINKS if h == 0 else LINKS
            levels.append((members[m : m + n], links[e : e + n * most].reshape(n, most)))
            m, e = m + n, e + n * most
        q, low, of = _matrix(queries["v"]), np.array(row["low"][0], np.int64), np.array(row["of"][0], np.int32)
        own = np.argsort(of, kind="stable")
        starts = np.searchsorted(of[own], np.arange(of.max() + 2))
        found = search(x[own[starts[:-1]]], levels, q)
        lengths, r, hit, score = np.linalg.norm(x, axis=1), [], [], []
        for i, near in enumerate(found):
            # all vectors of the nodes found, and only by their double scores, ties by vec_id, the best of them
            some = np.concatenate([own[starts[n] : starts[n + 1]] for n in near[near >= 0]])
            cosine = np.einsum("ij,j->i", x[some], q[i]) / (np.linalg.norm(q[i]) * lengths[some])
            best = np.lexsort((low[some], -cosine))[:k]
            r.append(np.full(len(best), i))
            hit.append(some[best])
            score.append(cosine[best])
        r, hit, score = np.concatenate(r), np.concatenate(hit), np.concatenate(score)
        return pa.table({"query": queries["query"].to_numpy()[r], "query_node": queries["query_node"].to_numpy()[r], "node": node[hit], "score": score}, schema=pa.schema(list(schema.items())))

    return run


def nearest(vectors, k=K, every=EVERY, shard=SHARD, block=BLOCK):
    """query_id, rank, vec_id and score: the ``k`` nearest rows found for each row whose vec_id is divisible by ``every``.

    Nearest first, by cosine in double precision, ties to the smaller vec_id, all candidates if there are fewer.
    Vectors that are null, zero or have null or non-finite components, and rows without vec_id, take no part.
    Rows that repeat vec_id and vector count once, and no row with the query's vec_id is its neighbour;
    vectors of another length are none either. An empty table gives no rows; other columns are not read.
    """
    good = vectors.select("vec_id", F.col("embedding").alias("v")).where(usable("v") & F.col("vec_id").isNotNull())
    good = good.withColumn("node", F.xxhash64(F.lit(3), F.size("v"), "v")).withColumn("width", F.size("v"))
    classes = cut(good.groupBy("node", "v", "width").agg(F.min("vec_id").alias("low")))
    # a query needs at most its k + 1 smallest members of a class, whatever its size
    by_class = Window.partitionBy("node").orderBy("vec_id")
    members = good.select("node", "vec_id").withColumn("nth", F.dense_rank().over(by_class)).where(F.col("nth") <= k + 1).select("node", "vec_id").distinct()
    queries = cut(good.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query"), F.col("node").alias("query_node"), "v", "width").distinct())
    found = None
    for width in [r.width for r in classes.select("width").distinct().collect()]:
        part = _found(classes.where(F.col("width") == width), queries.where(F.col("width") == width), k, shard, block)
        found = part if found is None else found.unionByName(part)
    if found is None:
        found = classes.select(F.col("low").alias("query"), F.col("node").alias("query_node"), "node", F.lit(0.0).alias("score"))
    best = Window.partitionBy("query", "query_node").orderBy(F.col("score").desc(), "node")
    # whatever shares the last score stays, for the tie goes by vec_id
    found = found.withColumn("nth", F.rank().over(Window.partitionBy("query", "query_node").orderBy(F.col("score").desc()))).where(F.col("nth") <= k + 1)
    each = found.join(members, "node").where("vec_id != query")
    rank = F.row_number().over(best.orderBy(F.col("score").desc(), "vec_id"))
    return each.withColumn("rank", rank).where(F.col("rank") <= k).select(F.col("query").alias("query_id"), "rank", "vec_id", "score")


def _found(classes, queries, k, shard, block):
    """The k + 1 nearest classes in each shard for each query; of equal ones those with the smallest vec_id are enough."""
    shards = max(1, -(-classes.count() // shard))
    blocks = max(1, -(-queries.count() // block))
    dealt = classes.select("node", "v", "low", F.pmod(F.xxhash64(F.lit(8), "node"), F.lit(shards).cast("long")).cast("int").alias("shard"))
    index = cut(dealt.groupBy("shard").applyInArrow(_index, "shard int, node array<long>, v binary, low array<long>, of array<int>, sizes array<int>, members array<int>, links array<int>"))
    asked = queries.withColumn("block", F.pmod(F.xxhash64(F.lit(6), "query"), F.lit(blocks).cast("long")).cast("int"))
    asked = asked.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).select("query", "query_node", "v", "shard", "block")
    spread = index.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    schema = "query long, query_node long, node long, score double"
    return cut(asked.groupBy("shard", "block").cogroup(spread.groupBy("shard", "block")).applyInArrow(_search(k + 1), schema))
