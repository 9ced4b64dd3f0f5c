import numpy as np
import pytest

from firnline.llm import embedding_pairs as pairs


def brute(rows, threshold=0.9):
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v is not None and None not in v and np.isfinite(v).all() and np.any(v)]
    x = np.array([np.array(rows[k][1], float) / np.abs(rows[k][1]).max() for k in good])
    c = (x @ x.T) / np.outer(np.linalg.norm(x, axis=1), np.linalg.norm(x, axis=1)) >= threshold
    np.fill_diagonal(c, False)
    label = np.array([rows[k][0] for k in good])
    while True:
        new = np.array([min(label[a], label[c[a]].min(initial=label[a])) for a in range(len(good))])
        if (new == label).all():
            break
        label = new
    out = [(i, 0, i, i is not None) for i, _ in rows]
    for a, k in enumerate(good):
        out[k] = (rows[k][0], int(c[a].sum()), int(label[a]), bool(label[a] == rows[k][0]))
    return sorted(out, key=repr)


def made(n, seed, dims=24):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 3, dims))
    x = np.concatenate([base, base[: n // 4] + rng.normal(size=(n // 4, dims)) * 0.3, base[:40], base[:5].repeat(30, 0) * rng.uniform(1, 4, (150, 1)), base[6] + rng.normal(size=(200, dims)) * 0.25])
    return [(i, r.astype(np.float32).tolist()) for i, r in enumerate(x[rng.permutation(len(x))])]


@pytest.mark.parametrize("tile,threshold", [(64, 0.9), (5000, 0.9), (100, 0.6)])
def test_against_all_pairs(spark, tile, threshold):
    rows = made(600, tile) + [(9000, None), (9001, [0.0] * 24), (9002, [float("nan")] * 24), (9003, [None] + [1.0] * 23), (None, [1.0] * 24), (9004, [1e-30] * 24), (9005, [3e30] * 24), (9006, []), (3, [1.0] * 24), (3, [1.0] * 24)]
    df = spark.createDataFrame([(*r, 7, "x") for r in rows], "vec_id long, embedding array<float>, node int, tile string").repartition(5)
    got = sorted((tuple(r) for r in pairs.near_duplicates(df, threshold, tile).collect()), key=repr)
    assert got == brute([(i, v or None) for i, v in rows], threshold)


def test_one_vector_and_none(spark):
    df = spark.createDataFrame([(4, [1.0, 0.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in pairs.near_duplicates(df).collect()] == [(4, 0, 4, True)]
    assert pairs.near_duplicates(df.limit(0)).count() == 0
    two = spark.createDataFrame([(4, [1.0, 0.0]), (2, [1.0, 0.0, 0.0]), (1, [2.0, 0.1])], "vec_id long, embedding array<double>")
    assert sorted(tuple(r) for r in pairs.near_duplicates(two).collect()) == [(1, 1, 1, True), (2, 0, 2, True), (4, 1, 1, False)]
