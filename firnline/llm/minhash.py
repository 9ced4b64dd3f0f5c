"""Near-duplicate documents: b-bit MinHash signatures joined by Hamming distance.

A signature has 30 MinHash values of 16 bits. It is split into six chunks of five values;
by the pigeonhole principle two signatures that differ in at most 11 values agree in four of
five values of some chunk, so one key per chunk and left-out value (30 keys) finds every
such pair. A pair at the similarity 0.85 is missed with a chance of 2e-5, at 0.9 of 7e-8. Lower
thresholds get more chunks, so that a pair at 0.8 is missed with a chance of 2.3e-5 (eight chunks, 40 keys).

Nothing emits the pairs of a bucket. First every document is held against one centre of
each bucket it is in, on full shingle sets; buckets whose documents are linked by then are
done, however large. The others are compared whole inside tasks, cut into tiles, and
return a spanning forest of the links between documents that were not linked yet.
"""

from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import components, cut

WORDS = 5
PERCENT = 85
CHUNKS, PER_CHUNK = 6, 5
VALUES = CHUNKS * PER_CHUNK
MOST_CHUNKS = 12
MISSED = 2.5e-5  # the chance of a pair at the threshold to share no key is at most this
FAR = 16  # signatures of a pair at PERCENT differ in more values with a chance of 1e-7
TILE = 512
UNIT_ROWS = 4000
BLOCK = 1 << 21

_RNG = np.random.default_rng(20)
_XOR = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64)
_MUL = _RNG.integers(0, 1 << 63, VALUES, dtype=np.uint64) | np.uint64(1)
_XOR = np.append(_XOR, _RNG.integers(0, 1 << 63, MOST_CHUNKS * PER_CHUNK - VALUES, dtype=np.uint64))
_MUL = np.append(_MUL, _RNG.integers(0, 1 << 63, MOST_CHUNKS * PER_CHUNK - VALUES, dtype=np.uint64) | np.uint64(1))
_BASE = np.uint64(0x9E3779B97F4A7C15)


def _chunks(percent):
    """Chunks of a signature: CHUNKS, and more for a threshold at which they miss too many pairs."""
    same = percent / 100
    miss = 1 - same**PER_CHUNK - PER_CHUNK * (1 - same) * same ** (PER_CHUNK - 1)
    chunks = next((n for n in range(CHUNKS, MOST_CHUNKS + 1) if miss**n <= MISSED), None)
    if chunks is None:
        raise ValueError(f"a similarity of {percent} % needs more than {MOST_CHUNKS} chunks")
    return chunks


def _far(percent):
    """In how many values signatures of a pair at the threshold may differ: FAR, and more for lower thresholds."""
    n, q = _chunks(percent) * PER_CHUNK, 1 - percent / 100
    return next((f for f in range(FAR, n) if sum(comb(n, i) * q**i * (1 - q) ** (n - i) for i in range(f + 1, n + 1)) <= 2e-7), n)


def shingles(text, words=WORDS):
    """Hashes (64 bits) of the word shingles of a text, sorted and distinct."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    k = min(words, len(h))
    s = h[: len(h) - k + 1].copy()
    for i in range(1, k):
        s *= _BASE
        s += h[i : len(h) - k + 1 + i]
    s ^= s >> np.uint64(29)
    s *= np.uint64(0xBF58476D1CE4E5B9)
    s ^= s >> np.uint64(32)
    s.sort()
    return s[np.concatenate([[True], s[1:] != s[:-1]])]


def signatures(sets, values=VALUES):
    """One row of 16-bit MinHash values per set (none empty)."""
    starts = np.cumsum([0, *map(len, sets[:-1])])
    every = np.concatenate(sets)
    out = np.empty((len(sets), values), np.int32)
    for k in range(values):
        low = np.minimum.reduceat((every ^ _XOR[k]) * _MUL[k], starts)
        out[:, k] = ((low >> np.uint64(20)) ^ (low >> np.uint64(41))) & np.uint64(0xFFFF)
    return out


def _features(words, values):
    def run(batches):
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            start = 0
            while start < len(texts):
                sets, held, i = [], 0, start
                while i < len(texts) and (held < BLOCK or i == start):
                    sets.append(shingles(texts[i].as_py(), words))
                    held += len(sets[-1])
                    i += 1
                n = np.array([len(s) for s in sets], np.int64)
                digest = np.array([xxhash.xxh3_128_intdigest(s.tobytes()) if len(s) else 0 for s in sets], object)
                sig = np.zeros((len(sets), values), np.int32)
                if n.any():
                    sig[n > 0] = signatures([s for s in sets if len(s)], values)
                two = [np.array([(int(d) >> (64 * p)) & 0xFFFFFFFFFFFFFFFF for d in digest], np.uint64).view(np.int64) for p in (0, 1)]
                offsets = np.arange(0, (len(sets) + 1) * values, values, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(start, i - start), pa.array(n), pa.array(two[0]), pa.array(two[1]), pa.ListArray.from_arrays(pa.array(offsets), pa.array(sig.ravel())),
                     *(c.slice(start, i - start) for c in batch.columns[2:])],
                    names=["doc_id", "n_shingles", "d1", "d2", "sig", *batch.schema.names[2:]])
                start = i

    return run


def _sets(words):
    def run(batches):
        for batch in batches:
            nodes, texts = batch.column(0).to_numpy(), batch.column(1)
            own, sets, held = [], [], 0
            for i in range(len(texts)):
                s = shingles(texts[i].as_py(), words)
                if len(s) and xxhash.xxh3_128_intdigest(s.tobytes()) & 0xFFFFFFFFFFFFFFFF == int(nodes[i]) & 0xFFFFFFFFFFFFFFFF:
                    own.append(nodes[i])
                    sets.append(s.view(np.int64))
                    held += len(s)
                if sets and (held > BLOCK or i + 1 == len(texts)):
                    yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "grams"])
                    own, sets, held = [], [], 0
            if sets:
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array(sets, pa.list_(pa.int64()))], names=["node", "grams"])

    return run


def _keys(chunks=CHUNKS):
    """The keys of a signature, 30 for six chunks: each chunk with each of its values left out."""
    out = []
    for c in range(chunks):
        at = range(c * PER_CHUNK, (c + 1) * PER_CHUNK)
        out += [F.xxhash64(F.lit(skip), *[F.col("sig")[i] for i in at if i != skip]) for skip in at]
    return F.array(*out)


def _near(a, b, n_a, n_b, percent):
    """What two documents over the threshold have in common for certain (sizes) or nearly so (signatures)."""
    differ = F.size(F.filter(F.zip_with(a, b, lambda x, y: x != y), lambda d: d))
    return (F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent) & (differ <= _far(percent))


def _compare(percent):
    """Links between documents of different groups in each (key, tile pair), as a spanning forest."""
    far = _far(percent)

    def run(t):
        node, comp = t["node"].to_numpy(), t["comp"].to_numpy()
        unit = np.stack([t[c].to_numpy() for c in ("key", "ti", "tj")], 1)
        side = t["tile"].to_numpy()
        sig = t["sig"].combine_chunks().flatten().to_numpy().reshape(len(node), -1)
        grams = t["grams"].combine_chunks()
        sets = [grams[i].values.to_numpy().view(np.uint64) for i in range(len(node))]
        sizes = np.array([len(s) for s in sets])
        order = np.lexsort(unit.T)
        edges = np.flatnonzero((np.diff(unit[order], axis=0) != 0).any(1)) + 1
        a, b = [], []
        for rows in np.split(order, edges):
            group = {c: c for c in comp[rows].tolist()}

            def root(c, group=group):
                while group[c] != c:
                    group[c] = group[group[c]]
                    c = group[c]
                return c

            ti, tj = unit[rows[0], 1], unit[rows[0], 2]
            right = rows if ti == tj else rows[side[rows] == tj]
            left = rows if ti == tj else rows[side[rows] == ti]
            for i in left:
                others = right[(right > i) if ti == tj else slice(None)]
                ok = (comp[others] != comp[i]) & (np.minimum(sizes[others], sizes[i]) * 100 >= np.maximum(sizes[others], sizes[i]) * percent)
                others = others[ok]
                others = others[(sig[others] != sig[i]).sum(1) <= far]
                for j in others:
                    x, y = root(comp[i].item()), root(comp[j].item())
                    if x == y:
                        continue
                    both = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
                    if 100 * both >= percent * (sizes[i] + sizes[j] - both):
                        group[max(x, y)] = min(x, y)
                        a.append(node[i])
                        b.append(node[j])
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _links(docs, classes, words, percent):
    """Links (a, b) between classes of equal sets that join up all that are similar enough."""
    keyed = classes.select("node", F.explode(_keys(_chunks(percent))).alias("key"))
    seen = keyed.groupBy("key").agg(F.count("*").alias("docs"), F.min("node").alias("centre"), F.bit_xor(F.xxhash64("node")).alias("who")).where("docs > 1")
    shared = cut(seen.groupBy("docs", "centre", "who").agg(F.min("key").alias("key")).select("key", "docs", "centre"))
    member = cut(keyed.join(shared, "key"))
    # every document against the centres of its buckets
    pairs = member.where("node != centre").select("node", "centre").distinct()
    one, two = classes.select("node", "n", "sig"), classes.select(F.col("node").alias("centre"), F.col("n").alias("n_c"), F.col("sig").alias("sig_c"))
    pairs = cut(pairs.join(one, "node").join(two, "centre").where(_near(F.col("sig"), F.col("sig_c"), F.col("n"), F.col("n_c"), percent)).select("node", "centre"))
    wanted = cut(member.select("node").distinct().join(classes.select("node", "rep"), "node"))
    text = docs.select(F.col("doc_id").alias("rep"), "text").join(wanted, "rep").select("node", "text")
    sets = cut(text.mapInArrow(_sets(words), "node long, grams array<long>").dropDuplicates(["node"]))
    both = F.size(F.array_intersect("grams", "grams_c"))
    close = both * 100 >= (F.size("grams") + F.size("grams_c") - both) * percent
    links = cut(pairs.join(sets, "node").join(sets.select(F.col("node").alias("centre"), F.col("grams").alias("grams_c")), "centre").where(close)
                .select(F.col("node").alias("a"), F.col("centre").alias("b")))
    known = cut(components(links))
    # what is not in one piece by now, compared whole; buckets with one centre, which are
    # mostly the same documents under several keys, are taken together
    grouped = cut(member.where("docs > 2").select(F.col("centre").alias("key"), "node").distinct().join(known, "node", "left")
                  .select("key", "node", F.coalesce("root", "node").alias("comp")))
    counted = grouped.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("docs"))
    rows = cut(grouped.join(cut(counted.where("lo != hi").select("key", "docs")), "key"))
    stars = known.select(F.col("node").alias("a"), F.col("root").alias("b"))
    n = rows.count()
    if not n:
        return stars
    tiles = F.ceil(F.col("docs") / F.lit(TILE)).cast("int")
    tiled = rows.withColumn("tiles", tiles).withColumn("tile", F.pmod(F.xxhash64("node"), F.col("tiles").cast("long")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    tiled = tiled.select("key", "node", "comp", "tile", other.alias("o")).select(
        "key", "node", "comp", "tile", F.least("tile", "o").alias("ti"), F.greatest("tile", "o").alias("tj"))
    full = tiled.join(sets, "node").join(classes.select("node", "sig"), "node")
    units = max(1, n // UNIT_ROWS)
    work = full.withColumn("unit", F.pmod(F.xxhash64("key", "ti", "tj"), F.lit(units).cast("long")))
    found = cut(work.groupBy("unit").applyInArrow(_compare(percent), "a long, b long"))
    return stars.unionByName(found)


def near_duplicates(docs, words=WORDS, percent=PERCENT):
    """Components of documents whose shingle sets are similar: one row per row of ``docs``.

    Returns doc_id, n_shingles, component_id (the smallest doc_id reachable over links, itself
    included) and kept (doc_id = component_id). Null or empty texts have no shingles and
    are their own component. Rows without doc_id take no part: component_id null, kept
    false. Repeated rows are equal sets, so they share a component, and so do rows that
    repeat a doc_id with another text, each by its own text. An empty table gives no rows; other
    columns are not read.
    """
    out = _grouped(docs.select("doc_id", "text"), words, percent)
    return out.select("doc_id", "n_shingles", "component_id", "kept")


def _grouped(docs, words, percent, more=""):
    """near_duplicates with the root of each component, null without shingles; ``more`` declares columns of ``docs`` to keep."""
    feats = cut(docs.mapInArrow(_features(words, _chunks(percent) * PER_CHUNK), "doc_id long, n_shingles long, d1 long, d2 long, sig array<int>" + more))
    own = docs.columns[2:]
    some = feats.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut(some.groupBy("d1", "d2", "n_shingles", "sig").agg(F.min("doc_id").alias("rep")).select(
        F.col("d1").alias("node"), "d2", F.col("n_shingles").alias("n"), "sig", "rep"))
    comp = cut(components(_links(docs, classes, words, percent)))
    rooted = cut(classes.select("node", "rep").join(comp, "node", "left").select("node", "rep", F.coalesce("root", "node").alias("root")))
    low = cut(rooted.groupBy("root").agg(F.min("rep").alias("component")))
    ids = cut(rooted.join(low, "root").select(F.col("node").alias("d1"), "component", "root"))
    out = some.join(ids, "d1").select("doc_id", "n_shingles", F.col("component").alias("component_id"), "root", *own)
    out = out.unionByName(feats.where("n_shingles = 0 OR doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(None).cast("long").alias("root"), *own))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))


def keep_one(docs, words=WORDS, percent=PERCENT):
    """``docs`` with one document of each group of near-duplicates, all columns as they are.

    Of rows that repeat a doc_id those with equal or linked texts fall together (the smallest text stays);
    another text of the same doc_id is a document of its own, and goes only if it is near a kept one. Rows
    without doc_id have no identity to compare by and stay. Column names may be any.
    """
    texts = docs.select("doc_id", "text", F.xxhash64("text").alias("_kept_text"))
    kept = _grouped(texts, words, percent, ", _kept_text long").where("kept")
    kept = cut(kept.select(F.col("doc_id").alias("_kept_id"), "_kept_text", F.col("root").alias("_kept_root")).distinct())
    some = docs.join(kept, (docs["doc_id"] == kept["_kept_id"]) & (F.xxhash64(docs["text"]) == kept["_kept_text"]))
    first = Window.partitionBy("_kept_id", "_kept_root").orderBy(F.col("text").asc_nulls_last())
    some = some.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").select(docs.columns)
    return some.unionByName(docs.where("doc_id IS NULL"))
