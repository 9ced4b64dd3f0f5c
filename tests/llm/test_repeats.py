"""Removal of repeated passages against a table of all strings of 100 bytes."""

import hashlib
import random

import numpy as np
import pytest

from firnline.llm import repeats

SCHEMA = "doc_id long, text string, uid int, runs string"


def brute(rows):
    order = sorted(range(len(rows)), key=lambda i: (rows[i][0] is None, rows[i][0] or 0, rows[i][1] is not None, rows[i][1] or ""))
    seen, out = set(), []
    for i in order:
        data = (rows[i][1] or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - 99):
            s = data[p : p + 100]
            if s in seen:
                gone[p : p + 100] = b"\x01" * 100
            seen.add(s)
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((rows[i][0], len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(spark, rows, parts=3, **how):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA).repartition(parts)
    return sorted((tuple(r) for r in repeats.remove_repeats(docs, **how).collect()), key=str)


def words(rnd, n):
    return " ".join("".join(rnd.choice("abcdeñ日") for _ in range(rnd.randint(1, 7))) for _ in range(n))


def corpus(seed):
    rnd = random.Random(seed)
    shared = [words(rnd, n) for n in (20, 25, 40, 200)]
    line = words(rnd, 26)
    rows = []
    for i in range(120):
        text = words(rnd, rnd.choice([1, 5, 30, 80]))
        for _ in range(rnd.randint(0, 3)):
            text += rnd.choice(["", "\n"]) + rnd.choice(shared)[rnd.randint(0, 30) :] + words(rnd, rnd.randint(0, 20))
        if i % 2:
            text = words(rnd, 4) + line + words(rnd, 6) + text  # one passage in half of all, each time among other words
        rows.append((i, text))
    rows += [(200 + k, rows[3 + k][1]) for k in range(30)]  # exact copies
    rows += [(300, "a" * 250), (301, "ab" * 300), (302, "a" * 99), (303, "a" * 100), (304, None), (305, ""), (306, None)]
    rows += [(400, rows[7][1] + "!" + rows[7][1])]
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("how", [{}, {"hot": 8, "unit_rows": 50}])
def test_brute_force(spark, how):
    rows = corpus(5)
    assert found(spark, rows, **how) == brute(rows)


def test_repeated_and_missing_ids(spark):
    rows = corpus(6)[:60]
    rows += rows[:10] + [(rows[0][0], rows[1][1]), (None, rows[2][1]), (None, rows[2][1]), (None, "x" * 300)]
    assert found(spark, rows) == brute(rows)


def test_small_tables(spark):
    assert found(spark, [], 1) == [] and found(spark, [(1, "abc")], 1) == brute([(1, "abc")])


def test_very_long_text(spark, monkeypatch):
    rnd = random.Random(8)
    part = words(rnd, 3000)
    rows = [(1, words(rnd, 260_000) + part), (2, part[500:] + words(rnd, 50) + "z" * 5000)]
    assert found(spark, rows) == brute(rows)


def test_longest_previous_factor():
    rnd = np.random.default_rng(1)
    data = rnd.integers(97, 99, 400, dtype=np.uint8)
    rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(data, 12))
    place = rnd.permutation(len(rows))
    got = repeats.longest_previous(rows, place)
    for i, row in enumerate(rows):
        same = (rows[place < place[i]] == row).cumprod(1).sum(1)
        assert got[i] == (same.max() if len(same) else 0)


def test_slices_do_not_matter(monkeypatch):
    data = np.frombuffer(words(random.Random(2), 900).encode(), np.uint8)
    ends = np.array([10, 10, 700, 820, len(data)])
    starts = lambda t: sorted((i, p, a) for i, lo, hi, a, _ in t.T.tolist() for p in range(lo, hi + 1))
    whole = starts(repeats.stretches(data, ends))
    monkeypatch.setattr(repeats, "SLICE", 333)
    assert starts(repeats.stretches(data, ends)) == whole
    assert len(whole) == sum(max(0, n - 99) for n in np.diff(ends, prepend=0))
