import re
from collections import defaultdict

import pytest

from firnline.llm import mixing


def targets(rows):
    """Share by weight, cut at the limit, reshare what is over, until none is above."""
    total = defaultdict(int)
    for _, s, t in rows:
        total[s] += len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    names = sorted([s for s in total if s is not None]) + [None] * (None in total)
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, out = 1.5 * sum(total.values()), set(names), dict.fromkeys(names, 0.0)
    while open_:
        w = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / w > 2 * total[s]}
        if not over:
            out |= {s: left * weight[s] / w for s in open_}
            break
        for s in over:
            out[s] = 2.0 * total[s]
            left -= out[s]
        open_ -= over
    return total, out


def seats(votes, n):
    out = dict.fromkeys(votes, 0)
    for _ in range(n):
        best = max(votes, key=lambda s: (votes[s] / (2 * out[s] + 1), -s))
        out[best] += 1
    return out


ROWS = [(i, ["big", "big", "b", "ä", "c", None, "z\U0001F600"][i % 7], " ".join(["w"] * (1 + i * 37 % 90))) for i in range(900)]
EDGES = [(None, "b", "null id"), (None, "b", "null id"), (5, "b", None), (6, "empty", ""), (7, None, "  \t x\n"), (1, "big", "again"), (8, "tiny", "one")]


@pytest.mark.parametrize("shard_rows,blocks", [(500, 50_000), (40, 300), (10_000, 7)])
def test_targets_and_taken(spark, shard_rows, blocks):
    rows = ROWS + EDGES
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], "doc_id long, source string, text string, size int, total int")
    got = mixing.mix(docs, shard_rows=shard_rows, blocks=blocks).collect()
    total, want = targets(rows)
    assert len(got) == len(rows)
    left = sorted(((i, len((t or "").split()), total[s], round(want[s], 6)) for i, s, t in rows), key=repr)
    assert sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6)) for r in got), key=repr) == left
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    if blocks == 50_000:
        taken = defaultdict(int)
        for r in got:
            taken[r.source_size, round(r.target, 6)] += r.taken
        for s in total:
            assert abs(taken[total[s], round(want[s], 6)] - want[s]) <= max(3, 0.002 * want[s]), s
    again = mixing.mix(docs.repartition(3), shard_rows=shard_rows, blocks=blocks).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, again))


def test_seats_are_those_of_the_highest_quotients(spark):
    votes = {1: 530.0, 2: 240.5, 3: 100.0, 4: 100.0, 5: 29.5, 6: 0.0}
    cells = spark.createDataFrame([(9, f"s{k}", k, 1000, v) for k, v in votes.items()], "_mix_shard long, _mix_src string, rank int, z long, votes double")
    for blocks in (7, 10, 33, 100):
        got = {int(r._mix_src[1:]): r.seats for r in mixing._seats(cells, blocks).collect()}
        block = max(1, int(1000 // blocks))
        assert got == seats(votes, round(1000 / block)), blocks


def test_copies_as_mixed(spark):
    rows = [(i, "s%d" % (i % 3), f"w{i} " * (i % 9), 7) for i in range(60)]
    docs = spark.createDataFrame([(*r, "en") for r in rows], "doc_id long, source string, text string, n_chars long, taken string")
    out = mixing.mixed(docs)
    assert out.columns == docs.columns
    taken = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    words = defaultdict(int)
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
        assert r.n_chars == len(r.text)
    assert {k: v for k, v in taken.items() if v} == dict(words)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, source string, text string")
    assert mixing.mix(docs).count() == 0 and mixing.mixed(docs).count() == 0
