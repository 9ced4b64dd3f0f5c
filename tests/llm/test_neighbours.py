import numpy as np

from firnline.llm import neighbours


def brute(rows, k=5, every=50):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    ids, x = np.array([i for i, _ in good]), np.array([v for _, v in good])
    out = {}
    for i, v in good:
        if i % every == 0:
            s = x @ v / (np.linalg.norm(x, axis=1) * np.linalg.norm(v))
            near = sorted({(-round(float(a), 12), int(b)) for a, b in zip(s, ids, strict=True) if b != i})[:k]
            out[i] = [(n + 1, b, -a) for n, (a, b) in enumerate(near)]
    return out


def answers(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 12)))
    return out


def test_small_tables_are_exact(spark):
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(220, 8)))] + [(1000 + i, [1.0] * 8) for i in range(60)]
    rows += [(None, [1.0] * 8), (5000, None), (5050, [0.0] * 8), (5100, [float("inf")] * 8), (5150, [None] + [1.0] * 7), (3, rows[3][1]), (50, rows[50][1])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<double>, node string, shard int").repartition(4)
    assert answers(neighbours.nearest(df, shard=100, block=3)) == brute(rows)


def test_few_candidates(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.0, 2.0]), (50, [1.0, 1.0, 1.0])], "vec_id long, embedding array<double>")
    assert answers(neighbours.nearest(df)) == {0: [(1, 7, 0.0)]}
    assert neighbours.nearest(df.limit(0)).count() == 0


def test_recall_of_a_shard():
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(40, 32))
    x = np.concatenate([rng.normal(size=(3000, 32)), centres[rng.integers(0, 40, 2000)] + 0.1 * rng.normal(size=(2000, 32))])
    levels = neighbours.build(x)
    q = x[::20]
    got = neighbours.search(x, levels, q)[:, :6]
    u = x / np.linalg.norm(x, axis=1)[:, None]
    want = np.argsort(-(u[::20] @ u.T), axis=1)[:, :6]
    assert np.mean([len(set(a) & set(b)) / 6 for a, b in zip(got.tolist(), want.tolist(), strict=True)]) > 0.95


def test_ties_go_to_the_smaller_id(spark):
    rng = np.random.default_rng(6)
    one = rng.normal(size=8)
    ids = rng.permutation(np.arange(1, 60)).tolist()
    rows = [(0, one.tolist())] + [(i, (one * 2.0**k).tolist()) for k, i in enumerate(ids, -30)]  # all cosines are exactly 1
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for shard in (1000, 20):
        got = neighbours.nearest(df, shard=shard).where("query_id = 0").orderBy("rank").collect()
        assert [r.vec_id for r in got] == [1, 2, 3, 4, 5] and len({r.score for r in got}) == 1


def test_closer_than_single_precision_tells(spark):
    rows = [(0, [1.0, 0.0])] + [(i, [1.0, i * 3e-6]) for i in range(1, 41)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    assert [r.vec_id for r in neighbours.nearest(df).orderBy("rank").collect()] == [1, 2, 3, 4, 5]


def test_recall_of_the_whole_query(spark):
    rng = np.random.default_rng(7)
    centres = rng.normal(size=(30, 24))
    x = np.concatenate([rng.normal(size=(3000, 24)), centres[rng.integers(0, 30, 2000)] + 0.2 * rng.normal(size=(2000, 24))])
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    got = answers(neighbours.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), shard=1500, block=64))
    want = brute(rows)
    assert got.keys() == want.keys() and len(want) == 100
    assert np.mean([len({v for _, v, _ in got[q]} & {v for _, v, _ in want[q]}) / 5 for q in want]) > 0.95
