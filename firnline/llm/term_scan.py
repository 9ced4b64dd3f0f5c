"""Ranked lexical search by scanning texts with an Aho-Corasick automaton; no index of the documents.

The terms of the items form an automaton whose words are guarded by a blank on both sides, as are
the terms of a text, so only whole terms match; what an automaton puts out are the numbers of terms, and
those map to items. A first scan adds up the statistics, a second scores each document for all items
it shares a term with and keeps the best per item in each task; only those meet in a shuffle.

Items are dealt to blocks of about ``BLOCK_BYTES`` of terms, and only one block at a time is sent to the tasks,
so what is broadcast is bounded however many items there are; each block scans the documents.
"""

from math import floor, log

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.sizes import settled

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 50
BLOCK_BYTES = 4 << 20
MERGES = 64
SLICE, CELLS = 1 << 22, 1 << 22
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# what a byte of UTF-8 becomes: A-Z lower, 0-9, a-z and all beyond ASCII themselves, the rest a blank
_PLAIN = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))


def _guarded(text):
    """The bytes of a text as characters, its terms between blanks; and the number of its terms."""
    plain = text.encode("utf-8", "replace").translate(_PLAIN)
    return f" {plain.decode('latin-1')} ", len(plain.split())


def automaton(terms):
    """Automaton that puts out i for each whole occurrence of terms[i]."""
    a = ahocorasick.Automaton()
    for i, term in enumerate(terms):
        a.add_word(_guarded(term)[0], i)
    a.make_automaton()
    return a


def _counted(a, texts):
    """Occurrences in texts: (row, term, times) of all terms found, and the number of terms of each text."""
    rows, terms, sizes = [], [], np.zeros(len(texts), np.int64)
    for i, text in enumerate(texts):
        if text:
            plain, sizes[i] = _guarded(text)
            found = np.fromiter((t for _, t in a.iter(plain)), np.int64)
            terms.append(found)
            rows.append(np.full(len(found), i))
    if not rows:
        return np.empty((3, 0), np.int64), sizes
    width = np.int64(len(a))
    both, times = np.unique(np.concatenate(rows) * width + np.concatenate(terms), return_counts=True)
    return np.stack([both // width, both % width, times]), sizes


def _texts(batch, rows=CELLS):
    """Slices of a batch of at most ``rows`` rows whose texts have about SLICE bytes together on average, or one text each."""
    step = max(1, min(rows, len(batch) * SLICE // max(1, batch.column("text").nbytes)))
    for start in range(0, len(batch), step):
        yield batch.slice(start, step)


def _statistics(terms):
    """Per task: documents holding each term, and as term -1 and -2 the documents with terms and all their terms."""
    def run(batches):
        a, df, docs, total = automaton(terms), np.zeros(len(terms), np.int64), 0, 0
        for batch in batches:
            for part in _texts(batch):
                (_, term, _), sizes = _counted(a, part.column("text").to_pylist())
                df += np.bincount(term, minlength=len(terms))
                docs, total = docs + int((sizes > 0).sum()), total + int(sizes.sum())
        hit = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(hit, [-1, -2])), pa.array(np.append(df[hit], [docs, total]))], names=["term", "n"])

    return run


def _best(items, scores, ids, k):
    """Of (item, score, doc_id) the ``k`` best per item: by score, then doc_id, null last."""
    order = np.lexsort((ids[1], ids[0], -scores, items))
    items, scores, ids = items[order], scores[order], ids[:, order]
    first = np.flatnonzero(np.append(True, items[1:] != items[:-1])) if len(items) else np.empty(0, int)
    place = np.arange(len(items)) - np.repeat(first, np.diff(np.append(first, len(items))))
    keep = place < k
    return items[keep], scores[keep], ids[:, keep]


def _scores(terms, weights, starts, owners, n_items, docs, total, k):
    """Per task the ``k`` best documents of each item; the items of term t are owners[starts[t]:starts[t + 1]]."""
    def run(batches):
        a = automaton(terms)
        item, score, ids = np.empty(0, np.int64), np.empty(0, np.int64), np.empty((2, 0), np.int64)
        for batch in batches:
            for part in _texts(batch, CELLS // n_items):
                (row, term, tf), sizes = _counted(a, part.column("text").to_pylist())
                m = 50 + (50 * sizes * docs) // max(1, total)
                gain = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[row]))
                many = starts[term + 1] - starts[term]
                at = np.repeat(starts[term], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                sums = np.zeros(len(part) * n_items, np.int64)
                np.add.at(sums, np.repeat(row, many) * n_items + owners[at], np.repeat(gain, many))
                cell = np.flatnonzero(sums)
                doc = part.column("doc_id")
                own = np.stack([np.asarray(doc.is_null()), doc.fill_null(0).to_numpy()]).astype(np.int64)[:, cell // n_items]
                item, score, ids = _best(np.append(item, cell % n_items), np.append(score, sums[cell]), np.concatenate([ids, own], 1), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), pa.array(ids[1], mask=ids[0] > 0), pa.array(score)], names=["item", "doc_id", "score"])

    return run


def _low(text):
    return F.translate(text, UPPER, LOWER)


def _items(benchmark, block_bytes):
    """(block, item_id, terms) of the items with terms, and the number of blocks."""
    terms = F.regexp_extract_all(_low(F.coalesce("text", F.lit(""))), F.lit(TERM), F.lit(0))
    items = benchmark.where("item_id IS NOT NULL").select("item_id", F.explode(terms).alias("term")).groupBy("item_id").agg(F.sort_array(F.collect_set("term")).alias("terms"))
    items = settled(items, "items")
    size = items.agg(F.sum(F.expr("aggregate(terms, 0L, (s, t) -> s + octet_length(t) + 16)"))).first()[0] or 0
    blocks = -(-size // block_bytes)
    return items.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, blocks))).cast("int")), blocks


def search(docs, benchmark, k=K, block_bytes=BLOCK_BYTES):
    """item_id, rank (from 1), doc_id and score: the ``k`` best documents of each item, those with a score above 0.

    Rows that repeat an item_id are one item with the terms of all; null item_id is none, and items without
    terms find nothing. Every row of ``docs`` is a document, also if it repeats another; null or empty
    texts have no terms. Equal scores go by doc_id, null last. Empty tables give no rows; other columns are not read.
    """
    texts = docs.select("doc_id", "text")
    items, blocks = _items(benchmark.select("item_id", "text"), block_bytes)
    found = None
    for block in range(blocks):
        part = _block(texts, items.where(F.col("block") == block), k)
        if part is not None:
            found = part if found is None else found.unionByName(part)
    if found is None:
        return texts.limit(0).select(F.lit(0).cast("long").alias("item_id"), F.lit(0).alias("rank"), "doc_id", F.lit(0).cast("long").alias("score"))
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    # the best of all tasks are merged in two steps, so that no item is in one task with what all tasks found
    first = F.row_number().over(Window.partitionBy("item_id", "salt").orderBy(*best))
    found = found.withColumn("salt", F.spark_partition_id() % MERGES).withColumn("rank", first).where(F.col("rank") <= k)
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy(*best))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")


def _block(texts, items, k):
    """Best documents per task for the items of one block (their terms are at most about BLOCK_BYTES, or one item)."""
    held = items.orderBy("item_id").collect()
    if not held:
        return None
    terms = sorted({t for r in held for t in r["terms"]})
    number = {t: i for i, t in enumerate(terms)}
    pairs = np.array(sorted((number[t], i) for i, r in enumerate(held) for t in r["terms"]), np.int64).reshape(-1, 2)
    starts = np.searchsorted(pairs[:, 0], np.arange(len(terms) + 1))
    counted = texts.select("text").mapInArrow(_statistics(terms), "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    counts = {r["term"]: r["n"] for r in counted.collect()}  # a row per term of the block
    n_docs, total = counts.get(-1, 0), counts.get(-2, 0)
    weights = np.array([floor(1000 * log((2 * n_docs + 2) / (2 * counts[i] + 1))) if i in counts else 0 for i in range(len(terms))], np.int64)
    scored = texts.mapInArrow(_scores(terms, weights, starts, pairs[:, 1], len(held), n_docs, total, k), "item long, doc_id long, score long")
    names = texts.sparkSession.createDataFrame([(i, r["item_id"]) for i, r in enumerate(held)], "item long, item_id long")
    return scored.join(F.broadcast(names), "item").select("item_id", "doc_id", "score")  # at most the items of the block


def oracle(docs="documents", items="benchmark", k=K):
    """The same in DuckDB SQL, from a table of all terms of all documents."""
    found = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERM}')"
    return f"""WITH texts AS (SELECT row_number() OVER () AS k, doc_id, {found} AS terms FROM {docs}),
whole AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM texts WHERE len(terms) > 0),
held AS (SELECT k, doc_id, CAST(len(terms) AS BIGINT) AS n, unnest(terms) AS term FROM texts),
counted AS (SELECT k, doc_id, n, term, CAST(count(*) AS BIGINT) AS tf FROM held GROUP BY ALL),
asked AS (SELECT DISTINCT item_id, unnest({found}) AS term FROM {items} WHERE item_id IS NOT NULL),
weighed AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counted, whole GROUP BY term, n_docs),
scored AS (SELECT item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM asked JOIN weighed USING (term) JOIN counted USING (term), whole GROUP BY 1, 2, 3)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {k}"""
