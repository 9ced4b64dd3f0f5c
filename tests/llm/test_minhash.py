import random
import re
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from firnline.llm import minhash
from firnline.llm.common import components


def plain_set(text, k=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", low)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute(rows, percent=85):
    """All pairs of rows through an index of their shingles."""
    sets = [plain_set(t) if i is not None else frozenset() for i, t in rows]
    where, both = defaultdict(list), defaultdict(int)
    for r, s in enumerate(sets):
        for g in s:
            where[g].append(r)
    for found in where.values():
        for a in range(len(found)):
            for b in range(a):
                both[found[a], found[b]] += 1
    label = [i for i, _ in rows]
    links = [(a, b) for (a, b), n in both.items() if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n)]
    changed = True
    while changed:
        changed = False
        for a, b in links:
            low = min(label[a], label[b])
            if label[a] != low or label[b] != low:
                label[a] = label[b] = low
                changed = True
    return sorted(((i, len(plain_set(t)), label[r], i is not None and label[r] == i) for r, (i, t) in enumerate(rows)), key=repr)


def corpus(seed=1):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)] + ["Ä", "é,", "　x", "NaN"]
    text = lambda n: [rng.choice(words) for _ in range(n)]

    def edited(base, n):
        out = list(base)
        for _ in range(n):
            out[rng.randrange(len(out))] = rng.choice(words)
        return out

    docs = [text(rng.randrange(1, 200)) for _ in range(150)]
    hub = text(150)
    docs += [edited(hub, rng.randrange(0, 9)) for _ in range(120)]  # around the threshold, to the hub and to each other
    chain = text(120)
    for _ in range(25):
        docs.append(chain)
        chain = edited(chain, 1)
    docs += [hub] * 60 + [docs[3]] * 5 + [docs[i][:-1] for i in range(0, 150, 7)]
    passage = text(80)
    docs += [passage + text(40) for _ in range(40)]
    made = [(" " if rng.random() < 0.5 else "\n").join(d) for d in docs]
    rng.shuffle(made)
    made = [t.upper() if rng.random() < 0.2 else t for t in made]
    return list(enumerate(made)) + [(9000, None), (9001, ""), (9002, " \t\n"), (None, made[0]), (9003, "one two"), (9004, "ONE  two"), (9005, "one two three"), (9006, "a " * 5000), (9007, "a " * 40), (5, made[5]), (5, made[5]), (6, made[9])]


@pytest.mark.parametrize("tile,unit", [(512, 4000), (16, 50)])
def test_against_all_pairs(spark, monkeypatch, tile, unit):
    monkeypatch.setattr(minhash, "TILE", tile)
    monkeypatch.setattr(minhash, "UNIT_ROWS", unit)
    rows = corpus(tile)
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, node string, n_shingles int").repartition(6)
    got = sorted((tuple(r) for r in minhash.near_duplicates(docs).collect()), key=repr)
    assert got == brute(rows)


def test_keep_one(spark):
    rows = corpus(3)
    docs = spark.createDataFrame([(*r, "x", 3) for r in rows], "doc_id long, text string, node string, component int")
    out = minhash.keep_one(docs)
    assert out.columns == docs.columns
    kept = [r.doc_id for r in out.collect()]
    want = {i for i, _, c, k in brute(rows) if k}
    assert sorted(i for i in kept if i is not None) == sorted(want) and kept.count(None) == 1


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert minhash.near_duplicates(docs).count() == 0 and minhash.keep_one(docs).count() == 0


def test_keys_find_all_pairs_within_the_distance(spark):
    """Pigeonhole: signatures that differ in at most 11 of 30 values share a key."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(60):
        a = rng.integers(0, 65536, minhash.VALUES)
        b = a.copy()
        at = rng.choice(minhash.VALUES, 11, replace=False)
        b[at] = rng.integers(65536, 70000, 11)
        rows += [(i, a.tolist()), (i, b.tolist())]
    df = spark.createDataFrame(rows, "pair int, sig array<int>")
    keys = defaultdict(list)
    for r in df.select("pair", minhash._keys().alias("keys")).collect():
        keys[r.pair].append(set(r["keys"]))
    assert all(a & b for a, b in keys.values())


def test_components_of_chains_stars_and_cycles(spark):
    rng = random.Random(7)
    links = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 180)] + [(200 + i, 200 + (i + 1) % 30) for i in range(30)]
    links += [(rng.randrange(300, 420), rng.randrange(300, 420)) for _ in range(90)] + [(7, 7), (1, 0)]
    names = list(range(500))
    rng.shuffle(names)
    links = [(names[a], names[b]) for a, b in links]
    label = {x: x for pair in links for x in pair}
    while True:
        before = dict(label)
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
        if before == label:
            break
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: v for k, v in label.items() if k != v}


@pytest.mark.parametrize("seed", [3, 5])
def test_stage_keeps_one_at_80(spark, seed):
    rows = corpus(seed)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r.doc_id for r in corpus_pipeline.drop_near_duplicates(spark, docs, None).collect()]
    want = {i for i, _, c, k in brute(rows, 80) if k}
    assert want != {i for i, _, c, k in brute(rows) if k}
    assert {i for i in kept if i is not None} == want and kept.count(None) == 1


def test_chance_of_a_miss():
    assert [minhash._chunks(p) for p in (80, 85, 90)] == [8, 6, 6] and minhash._far(85) == minhash.FAR and minhash._far(80) == 23


def test_keep_one_of_each_text_of_a_repeated_id(spark):
    a, b, c, d = (" ".join(f"{w}{i}" for i in range(40)) for w in "abcd")
    rows = [(7, b), (7, c), (7, c + " end"), (7, a), (7, a), (3, a), (8, d), (8, None), (8, ""), (9, "  ")]
    out = minhash.keep_one(spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, root int"))
    assert out.columns == ["doc_id", "text", "root"]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in out.collect()))) == sorted(map(repr, [(7, b), (7, c), (3, a), (8, d), (8, ""), (9, "  ")]))
