"""Ranked search against a plain count over split texts, and against its SQL."""

import random
import re
from collections import Counter
from math import floor, log

import duckdb
import pytest

from firnline.llm import term_scan

WORDS = ["a", "b", "ab", "ba", "aba", "Über", "über", "x1", "İ", "ß", "naïve", "日本", "the", "THE", "q"]


def terms(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(term_scan.TERM, low)


def brute(docs, items, k=term_scan.K):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, total = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    w = {t: floor(1000 * log((2 * n_docs + 2) / (2 * n + 1))) for t, n in df.items()}
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(terms(t))
    out = []
    for item, wanted in asked.items():
        found = []
        for (doc, c), n in zip(counts, sizes):
            m = 50 + (50 * n * n_docs) // max(1, total)
            score = sum(w[t] * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m)) for t in wanted if t in c)
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, r, None if none else doc, -s) for r, (s, none, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def text(rnd, n):
    return "".join(rnd.choice(WORDS) + rnd.choice([" ", "  ", "-", ", ", "\n", "\x00", "_"]) for _ in range(rnd.randint(0, n)))


def tables(seed, n_docs, n_items):
    rnd = random.Random(seed)
    docs = [(None if rnd.random() < 0.02 else i, rnd.choice([None, "", " ,;"]) if rnd.random() < 0.1 else text(rnd, 40)) for i in range(n_docs)]
    docs += docs[:20] + [(5000, "the a " * 60_000)]  # repeated rows, so ties; a very long text
    return docs, [(rnd.choice([None, i, i, 1]), rnd.choice([None, "", text(rnd, 6)])) for i in range(n_items)]


@pytest.mark.parametrize("block_bytes", [term_scan.BLOCK_BYTES, 200])
def test_brute_force(spark, block_bytes):
    docs, items = tables(3, 300, 30)
    d = spark.createDataFrame([(*r, 1) for r in docs], "doc_id long, text string, item_id int").repartition(5)
    b = spark.createDataFrame([(*r, 1) for r in items], "item_id long, text string, doc_id int")
    for k in (3, term_scan.K):
        got = [tuple(r) for r in term_scan.search(d, b, k, block_bytes).collect()]
        assert sorted(got, key=str) == brute(docs, items, k)


def test_empty_tables(spark):
    d, b = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    item = spark.createDataFrame([(1, "a"), (2, " ;")], "item_id long, text string")
    assert term_scan.search(d, b).count() == term_scan.search(one, b).count() == term_scan.search(d, item).count() == 0
    assert [tuple(r) for r in term_scan.search(one, item).collect()] == brute([(1, "a")], [(1, "a")])
    assert term_scan.search(d, b).dtypes == term_scan.search(one, item).dtypes


def test_sql_says_the_same():
    docs, items = tables(4, 200, 20)
    docs, items = [(i, t and t.replace("\x00", " ")) for i, t in docs], [(i, t and t.replace("\x00", " ")) for i, t in items]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR); CREATE TABLE benchmark (item_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    con.executemany("INSERT INTO benchmark VALUES (?, ?)", items)
    assert sorted(con.sql(term_scan.oracle()).fetchall(), key=str) == brute(docs, items)
