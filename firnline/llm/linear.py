"""Follow-the-regularised-leader logistic regression over hashed text features.

Documents become sparse vectors of hashed word n-grams in parallel tasks. A bounded, seeded
sample of labelled rows is dealt to a few groups; it has at most ``TRAIN_ROWS`` rows, one per doc_id, and about
``TRAIN_BYTES`` of text, both documented parameters. Each group learns on its own with per-coordinate rates and
L1/L2 terms, and the weights are averaged; rows with label 1 weigh ``positive`` times as much. The non-zero
weights, at most 2^bits of them, are the model that tasks get.

Tasks work on Arrow columns text by text, so what a task holds is one batch, a small cache and the model.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

TRAIN_ROWS = 16_000
TRAIN_BYTES = 64 << 20
TRAIN_TASKS = 32
FEATURES_HELD = 1 << 20
TOKENS_HELD = 40_000
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


class _Tokens(dict):
    """Hash of each token seen lately."""

    def __missing__(self, token):
        if len(self) >= TOKENS_HELD:
            self.clear()
        h = self[token] = zlib.crc32(token.encode("utf-8", "replace")) * 0x9E3779B1 + 0x7F4A7C15
        return h


_SEEN = _Tokens()


def _pairs(a, b, kind):
    h = (a * np.uint64(0xBF58476D1CE4E5B9) + b + np.uint64(kind)) * _MIX
    return h ^ (h >> np.uint64(31))


def grams(text, bits, skips=()):
    """Hashed features of a whole text: words, word pairs, and pairs with 1.. words between as named in ``skips``."""
    tokens = _TOKEN.findall((text or "").lower())
    h = np.fromiter(map(_SEEN.__getitem__, tokens), np.uint64, len(tokens))
    found = [_pairs(h, h, 1), _pairs(h[:-1], h[1:], 2)]
    found += [_pairs(h[: -1 - s], h[1 + s :], 10 + s) for s in skips]
    return (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64)


def vector(text, bits, skips, counts):
    """Indices and values: values 1 (``counts`` false), or counts on a unit length."""
    at, n = np.unique(grams(text, bits, skips), return_counts=True)
    if not counts:
        return at, np.ones(len(at))
    return at, n / np.sqrt(max(1.0, float((n * n).sum())))


class Ftrl:
    """FTRL-proximal: weight i is 0 while |z| <= l1, else pulled by its own learning rate."""

    def __init__(self, bits, alpha, beta, l1, l2, positive=1.0):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)
        self.alpha, self.beta, self.l1, self.l2, self.positive = alpha, beta, l1, l2, positive
        self.bias = 1 << bits

    def weights(self, at):
        z, l1 = self.z[at], np.where(at == self.bias, 0.0, self.l1)
        w = -(z - np.sign(z) * l1) / ((self.beta + np.sqrt(self.n[at])) / self.alpha + self.l2)
        return np.where(np.abs(z) <= l1, 0.0, w)

    def learn(self, at, x, label):
        w = self.weights(at)
        g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - label) * x * (self.positive if label else 1.0)
        sigma = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / self.alpha
        self.z[at] += g - sigma * w
        self.n[at] += g * g


def fold(doc_id):
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def _lists(arrays, kind):
    """Arrays as one list column."""
    offsets = np.cumsum([0, *map(len, arrays)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.empty(0)]).astype(kind)))


def _featurise(bits, skips, counts):
    def run(batches):
        for batch in batches:
            texts, start, made, held = batch.column("text"), 0, [], 0
            for i in range(len(batch)):
                made.append(vector(texts[i].as_py(), bits, skips, counts))
                held += len(made[-1][0])
                if held >= FEATURES_HELD or i + 1 == len(batch):
                    values = _lists([m[1] for m in made], np.float32) if counts else pa.nulls(len(made), pa.list_(pa.float32()))
                    own = [batch.column(c).slice(start, len(made)) for c in ("doc_id", "label")]
                    yield pa.RecordBatch.from_arrays([*own, _lists([m[0] for m in made], np.int32), values], names=["doc_id", "label", "at", "x"])
                    start, made, held = i + 1, [], 0

    return run


def _views(column):
    """The lists of a column as views of its buffers, None for null."""
    out = []
    for chunk in column.chunks:
        ends, values, known = chunk.offsets.to_numpy(), chunk.values.to_numpy(), chunk.is_valid().to_pylist()
        out += [values[ends[i] : ends[i + 1]] if known[i] else None for i in range(len(chunk))]
    return out


def _train(bits, alpha, beta, l1, l2, positive, epochs, seed):
    def run(rows):
        model, rng = Ftrl(bits, alpha, beta, l1, l2, positive), np.random.default_rng(seed)
        at, x, y = _views(rows["at"]), _views(rows["x"]), rows["label"].to_numpy()
        order = np.argsort(rows["doc_id"].to_numpy(), kind="stable")
        for _ in range(epochs):
            for i in order[rng.permutation(len(order))]:
                values = np.ones(len(at[i])) if x[i] is None else x[i]
                model.learn(np.append(at[i], model.bias), np.append(values, 1.0), y[i])
        w = model.weights(np.arange((1 << bits) + 1))
        at = np.flatnonzero(w)
        return pa.table({"at": at, "w": w[at]})

    return run


def sample(docs, labels, label, rows=TRAIN_ROWS, most_bytes=TRAIN_BYTES, seed=7):
    """doc_id, label and text of the rows to learn from.

    Documents with a 0/1 ``label`` whose crc32(doc_id as text) mod 5 is not 0, in the order of a seeded hash of
    doc_id: at most ``rows`` of them, as long as their texts have at most ``most_bytes`` bytes together. A doc_id is one row:
    with the smaller of its labels and the smaller of its texts, if it has several. Null ids, labels and other values are left out.
    """
    given = labels.select(F.col("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id IS NOT NULL AND label IN (0, 1)")
    given = given.where(fold(F.col("doc_id")) != 0).groupBy("doc_id").agg(F.min("label").alias("label"))
    chosen = given.withColumn("h", F.xxhash64(F.lit(seed), "doc_id")).orderBy("h", "doc_id").limit(rows)
    train = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")  # at most ``rows`` rows
    train = train.groupBy("doc_id", "label", "h").agg(F.min("text").alias("text"))
    upto = F.sum(F.octet_length("text").cast("long")).over(Window.orderBy("h", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    return train.withColumn("upto", upto).where(F.col("upto") <= most_bytes).select("doc_id", "label", "text")


def fit(docs, labels, label, *, bits=18, skips=(), counts=False, alpha=0.1, beta=1.0, l1=1.0, l2=1e-4, positive=1.0, epochs=2, groups=1, rows=TRAIN_ROWS, most_bytes=TRAIN_BYTES, seed=7):
    """The model: sorted indices and weights (the bias at 2^bits), or None without rows to learn from (see ``sample``)."""
    train = sample(docs, labels, label, rows, most_bytes, seed).repartition(TRAIN_TASKS, "doc_id")
    made = train.mapInArrow(_featurise(bits, skips, counts), "doc_id long, label int, at array<int>, x array<float>")
    made = made.withColumn("part", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), F.lit(groups).cast("long")))
    learned = made.groupBy("part").applyInArrow(_train(bits, alpha, beta, l1, l2, positive, epochs, seed), "at long, w double")
    mean = learned.groupBy("at").agg((F.sum("w") / groups).alias("w")).orderBy("at").toArrow()
    if not len(mean):
        return None
    return mean["at"].to_numpy(), mean["w"].to_numpy()


def scorer(model, *, bits=18, skips=(), counts=False, empty_model=0.0):
    """A column function from text to a score from 0 to 1; ``empty_model`` is the score without a model."""
    if model is None:
        return lambda text: F.lit(float(empty_model))
    at, w = model

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        dense = np.zeros((1 << bits) + 1)
        dense[at] = w
        out = np.empty(len(texts))
        for i in range(len(texts)):
            found = grams(texts[i].as_py(), bits, skips)
            if counts:
                n = np.unique(found, return_counts=True)[1]
                s = dense[found].sum() / np.sqrt(max(1.0, float((n * n).sum())))
            else:
                s = dense[np.unique(found[dense[found] != 0])].sum()
            out[i] = 1 / (1 + np.exp(-min(35.0, max(-35.0, s + dense[-1]))))
        return pa.array(out)

    return score


def scored(docs, score, threshold):
    """doc_id, held_out, score and predicted of every row."""
    out = docs.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), score(F.col("text")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
