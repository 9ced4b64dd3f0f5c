"""The manifest against trees built level by level in plain Python, and against its SQL."""

import hashlib
import random
import zlib

import duckdb
import pytest

from firnline.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, source, lang, n_chars, text = row
    values = doc_id, source, lang, None if n_chars is None else n_chars + more, text
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def climbs(hashes):
    """Per hash its steps (sibling on the left, sibling or None), and the top."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for k, path in enumerate(paths):
            other = at[k] ^ 1
            path.append((other < at[k], level[other] if other < len(level) else None))
            at[k] //= 2
        level = [digest(*level[i : i + 2]) for i in range(0, len(level), 2)]
    return paths, level[0] if level else None


def brute(rows):
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    own = {x: sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is None, r[0] or 0, leaf(r))) for x in langs}
    low = {x: climbs([leaf(r) for r in own[x]]) for x in langs}
    upper, root = climbs([low[x][1] for x in langs])
    out = []
    for x, high in zip(langs, upper):
        for row, path in zip(own[x], low[x][0]):
            hit = row[0] is not None and row[3] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            h = leaf(row, int(hit))
            for left, sib in path + high:
                h = digest(h) if sib is None else digest(sib, h) if left else digest(h, sib)
            out.append((row[0], leaf(row), low[x][1], root, digest(*[s for _, s in path + high if s]), h, h == root))
    return out


def table(seed, n):
    rnd = random.Random(seed)
    rows = [(None if rnd.random() < 0.03 else i, rnd.choice([None, "web", "a:b"]), rnd.choice([None, "", "en", "en", "en", "de", "é"]),
             rnd.choice([None, i, (1 << 63) - 1]), rnd.choice([None, "", "x" * i, "ñ-"])) for i in range(n)]
    rows += rows[:4]  # repeated rows
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("n", [0, 1, 400])
def test_brute_force(spark, n):
    rows = table(n, n)
    docs = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA + ", leaf string")  # another column of a name used inside
    got = [tuple(r) for r in merkle.manifest(docs).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_trees_of_many_tiers(spark, monkeypatch):
    monkeypatch.setattr(merkle, "STEP", 2)
    rows = [r[:2] + (None,) + r[3:] for r in table(5, 150)]  # one language, its top is the root
    got = [tuple(r) for r in merkle.manifest(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert sorted(got, key=str) == sorted(brute(rows), key=str)


def test_sql_says_the_same():
    rows = [r for r in table(9, 90) if r[3] != (1 << 63) - 1]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, source VARCHAR, lang VARCHAR, n_chars BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    got = con.sql(merkle.oracle()).fetchall()
    assert sorted(got, key=str) == sorted(brute(rows), key=str)
