import random
import zlib

import numpy as np
import pytest

from firnline.llm import linear, quality, toxicity


def made(n=900, seed=4):
    """Texts with slurs somewhere (toxic) or with junk all over (bad quality), among invented words."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdeio") for _ in range(rng.randrange(2, 5))) for _ in range(400)]
    docs, labels = [], []
    for i in range(n):
        text = [rng.choice(words) for _ in range(rng.randrange(20, 120))]
        toxic, good = int(rng.random() < 0.2), int(rng.random() < 0.8)
        if toxic:
            for _ in range(3):
                text[rng.randrange(len(text))] = rng.choice(["grobian", "schuft", "lump"])
        if not good:
            text = [t + rng.choice(["###", "%%%"]) for t in text]
        docs.append((i, " ".join(text)))
        labels.append((i, good, toxic))
    return docs, labels


EDGES = [(None, "null id grobian"), (9000, None), (9001, ""), (9002, "wort " * 60_000), (3, "repeated"), (3, "repeated")]


@pytest.fixture(scope="module")
def tables(spark):
    docs, labels = made()
    odd = [(None, 1, 1), (5, None, 1), (7, 1, 9), (999_999, 0, 1), (9001, 1, 0)]
    frame = spark.createDataFrame([(*d, "x", 0.5) for d in docs + EDGES], "doc_id long, text string, label string, score double")
    marks = spark.createDataFrame([(*r, "y") for r in labels + odd], "doc_id long, quality int, toxic int, text string")
    return frame, marks, {i: (q, t) for i, q, t in labels}


@pytest.mark.parametrize("which", ["toxic", "quality"])
def test_held_out_accuracy_and_edges(tables, which):
    docs, labels, known = tables
    score = toxicity.score_toxicity if which == "toxic" else quality.score_quality
    rows = score(docs, labels).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    limit = 0.5 if which == "toxic" else 0.3
    assert all(r.predicted == int(r.score >= limit) for r in rows)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [(r.predicted, known[r.doc_id][which == "toxic"]) for r in rows if r.held_out and r.doc_id in known]
    assert len(held) > 100 and np.mean([a == b for a, b in held]) > 0.95
    assert len({r.score for r in rows if r.doc_id in (9000, 9001)}) == 1
    if which == "toxic":
        assert next(r for r in rows if r.doc_id is None).predicted == 1


def test_labels_of_the_held_out_fold_do_not_count(tables, spark):
    docs, labels, known = tables
    turned = labels.withColumn("toxic", linear.F.when(linear.fold(linear.F.col("doc_id")) == 0, 1 - linear.F.col("toxic")).otherwise(linear.F.col("toxic")))
    one, two = (linear.fit(docs, x, "toxic", **toxicity.FEATURES, **toxicity.LEARNING) for x in (labels, turned))
    assert np.array_equal(one[0], two[0]) and np.array_equal(one[1], two[1])


def test_without_labels_and_rows(tables, spark):
    docs, labels, _ = tables
    assert {(r.score, r.predicted) for r in toxicity.score_toxicity(docs, labels.limit(0)).collect()} == {(0.0, 0)}
    assert {(r.score, r.predicted) for r in quality.score_quality(docs, labels.limit(0)).collect()} == {(1.0, 1)}
    assert toxicity.score_toxicity(docs.limit(0), labels).count() == 0
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == docs.count()


def test_l1_keeps_weights_few(tables):
    docs, labels, _ = tables
    at, w = linear.fit(docs, labels, "toxic", **toxicity.FEATURES, **toxicity.LEARNING)
    assert 3 <= len(at) < 2000


def test_learner_follows_the_closed_form():
    """One coordinate against the update written out."""
    m = linear.Ftrl(1, alpha=0.5, beta=1.0, l1=0.1, l2=0.01)
    z = n = 0.0
    for y in (1, 0, 1, 1):
        w = 0.0 if abs(z) <= 0.1 else -(z - np.sign(z) * 0.1) / ((1 + np.sqrt(n)) / 0.5 + 0.01)
        g = 1 / (1 + np.exp(-w)) - y
        z, n = z + g - (np.sqrt(n + g * g) - np.sqrt(n)) / 0.5 * w, n + g * g
        m.learn(np.array([0]), np.array([1.0]), y)
    assert m.z[0] == pytest.approx(z) and m.n[0] == pytest.approx(n)


def test_sample_is_bounded(tables, spark):
    docs, labels, known = tables
    docs = docs.unionByName(docs).unionByName(docs.selectExpr("doc_id", "concat(text, ' other') AS text", "label", "score"))
    both = labels.unionByName(labels)
    rows = linear.sample(docs, both, "toxic", rows=200).collect()
    assert len(rows) == len({r.doc_id for r in rows}) == 200
    assert all(zlib.crc32(str(r.doc_id).encode()) % 5 for r in rows)
    some = linear.sample(docs, both, "toxic", most_bytes=20_000).collect()
    total = sum(len(r.text.encode()) for r in some)
    assert 0 < total <= 20_000 and {r.doc_id for r in some} < {r.doc_id for r in linear.sample(docs, both, "toxic").collect()}


def test_features_come_in_slices(monkeypatch):
    batch = linear.pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "label": [0, 1, 0, 1], "text": ["a b c", None, "", "a a b"]})
    whole = linear.pa.Table.from_batches(linear._featurise(12, (1,), True)([batch]))
    monkeypatch.setattr(linear, "FEATURES_HELD", 1)
    assert linear.pa.Table.from_batches(linear._featurise(12, (1,), True)([batch])).to_pylist() == whole.to_pylist()
    assert [len(v) for v in linear._views(whole["at"])] == [len(linear.vector(t, 12, (1,), True)[0]) for t in ("a b c", None, "", "a a b")]
