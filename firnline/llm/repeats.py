"""Passages that repeat: longest-previous-factor arrays over sorted suffixes, the first copy stays.

A string of 100 bytes goes if it also starts earlier. Whether it does is a question to its longest
previous factor: of the suffixes before and after in suffix order the nearest that start earlier
have the longest match with an earlier start, and 100 bytes of it are enough.

To sort suffixes in many tasks, equal strings have to meet. Of the 50-byte grams in a string of 100 bytes
the one with the smallest hash is its anchor, wherever the string stands; starts in a row that share an anchor are a
stretch of up to 51 strings. Stretches meet by the hash of their anchor. Equal stretches are one, so of
copies only the first goes on, and they are put together in each task before the shuffle already; only
anchors with different stretches, which is where copies begin and end, get their text cut out, sorted and
searched. An anchor with more than ``HOT`` different stretches is not sorted in one task: its strings
meet by digests instead.
"""

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.sizes import settled
from .common import numbered

LENGTH = 100
GRAM = 50
HOT = 4000
UNIT_ROWS = 16_000
SLICE = (1 << 20) - 4 * LENGTH  # starts looked at in one go; their index fits the low 20 bits of a key
BATCH = 16 << 20

_RNG = np.random.default_rng(11)
_BYTES = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS = {}


def _powers():
    """Powers of the base modulo 2^64 and of its inverse, for the positions of a slice."""
    if not _POWERS:
        n = 1 << 20
        for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
            p = np.full(n + 1, base, np.uint64)
            p[0] = 1
            _POWERS[name] = np.multiply.accumulate(p)
    return _POWERS["up"], _POWERS["down"]


def _mixed(h):
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def _slice_stretches(data, valid):
    """Stretches (first, last, anchor hash, stretch hash) of one slice; ``valid`` says which starts have a whole string."""
    up, down = _powers()
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=sums[1:])
    gram = _mixed((sums[GRAM:] - sums[:-GRAM]) * down[: len(data) + 1 - GRAM])
    low = (gram & ~np.uint64(0xFFFFF)) | np.arange(len(gram), dtype=np.uint64)
    width, grams = 1, LENGTH - GRAM + 1
    while width * 2 <= grams:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[: len(low) - (grams - width)], low[grams - width :])
    at = (low & np.uint64(0xFFFFF)).astype(np.int64)[: len(valid)]
    change = np.append(True, (at[1:] != at[:-1]) | ~valid[:-1])
    first = np.flatnonzero(change & valid)
    last = np.append(first[1:], len(at)) - 1
    ends = np.flatnonzero(valid & ~np.append(valid[1:], False))  # the last start of each document
    last = np.minimum(last, ends[np.searchsorted(ends, first)]) if len(first) else last
    whole = _mixed((sums[last + LENGTH] - sums[first]) * down[first])
    return first, last, gram[at[first]], whole


def stretches(data, ends):
    """Stretches of texts laid end to end, as columns (text, first, last, anchor hash, stretch hash); starts are within the text."""
    begins = np.append(0, ends[:-1])
    found = []
    for start in range(0, len(data) - LENGTH + 1, SLICE):
        part = data[start : start + SLICE + LENGTH - 1]
        valid = np.ones(len(part) - LENGTH + 1, bool)
        cut = ends[np.searchsorted(ends, start, "right") : np.searchsorted(ends, start + len(part), "left")] - start
        # no string starts in the last 99 bytes of a text
        gone = np.zeros(len(valid) + 1, np.int64)
        np.add.at(gone, np.clip(cut - LENGTH + 1, 0, len(valid)), 1)
        np.add.at(gone, np.clip(cut, 0, len(valid)), -1)
        valid &= np.cumsum(gone)[:-1] == 0
        if valid.any():
            first, last, anchor, whole = _slice_stretches(part, valid)
            text = np.searchsorted(ends, first + start, "right")
            found.append(np.stack([text, first + start - begins[text], last + start - begins[text], anchor.view(np.int64), whole.view(np.int64)]))
    return np.concatenate(found, 1) if found else np.empty((5, 0), np.int64)


def _bytes(column):
    """The bytes of a binary column laid end to end, and the end of each value."""
    column = column.cast(pa.large_binary()).fill_null(b"")
    if not len(column):
        return np.empty(0, np.uint8), np.empty(0, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return (np.frombuffer(data, np.uint8) if data else np.empty(0, np.uint8))[offsets[0] : offsets[-1]], offsets[1:] - offsets[0]


def _runs(uid, first, last):
    """Stretches that follow each other joined to runs."""
    order = np.lexsort((first, uid))
    uid, first, last = uid[order], first[order], last[order]
    new = np.flatnonzero(np.append(True, (uid[1:] != uid[:-1]) | (first[1:] != last[:-1] + 1))) if len(uid) else np.empty(0, int)
    return uid[new], first[new], last[np.append(new[1:], len(uid)) - 1] if len(uid) else last


CANDIDATE = "key long, whole long, uid long, place long, later boolean"


def _candidates(batches):
    """Stretches of the texts of a task: of equal ones the first, and the runs of the later ones as rows of their own.

    A stretch has its anchor as key and as place its first start and its length, 64 times the one plus the other; a run of
    later copies has its text as key, its first start as place and its last as ``whole``.
    """
    names = ["key", "whole", "uid", "place", "later"]
    for batch in batches:
        step = max(1, len(batch) * BATCH // max(1, batch.column("text").nbytes))
        for start in range(0, len(batch), step):
            part = batch.slice(start, step)
            text, first, last, anchor, whole = stretches(*_bytes(part.column("text")))
            uid = part.column("uid").to_numpy()[text]
            order = np.lexsort((first, uid, whole, anchor))
            uid, first, last, anchor, whole = (v[order] for v in (uid, first, last, anchor, whole))
            new = np.append(True, (anchor[1:] != anchor[:-1]) | (whole[1:] != whole[:-1]))[: len(uid)]
            place = first * 64 + last - first
            yield pa.RecordBatch.from_arrays([*(pa.array(v[new]) for v in (anchor, whole, uid, place)), pa.array(np.zeros(new.sum(), bool))], names=names)
            own, lo, hi = _runs(uid[~new], first[~new], last[~new])
            yield pa.RecordBatch.from_arrays([pa.array(own), pa.array(hi), pa.array(own), pa.array(lo), pa.array(np.ones(len(own), bool))], names=names)


def longest_previous(windows, place):
    """Longest previous factor, up to the width of ``windows``, of strings that stand at distinct places.

    ``windows`` are the strings as rows of bytes. Suffix order, common prefixes of neighbours, then one pass with a
    stack: a string's nearest smaller places on both sides are where its longest earlier match is.
    """
    n, width = windows.shape
    order = np.argsort(windows.view(f"S{width}").ravel(), kind="stable")
    common = np.zeros(n + 1, np.int64)
    for start in range(1, n, 1 << 16):
        some = slice(start, min(n, start + (1 << 16)))
        differ = windows[order[some]] != windows[order[start - 1 : some.stop - 1]]
        common[some] = np.where(differ.any(1), differ.argmax(1), width)
    best, stack = [0] * n, []
    for at, here, shared in zip([*order.tolist(), -1], [*place[order].tolist(), -1], common.tolist()):
        while stack and here < stack[-1][1]:
            old, _, before = stack.pop()
            best[old] = max(before, shared)
            shared = min(before, shared)
        stack.append((at, here, shared if stack else 0))
    return np.array(best)


def _windows(data, ends, first):
    """All strings of stretches laid end to end: stretch number, start in its text, and the strings as rows."""
    begins = np.append(0, ends[:-1])
    many = ends - begins - LENGTH + 1
    of = np.repeat(np.arange(len(ends)), many)
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    rows = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[begins[of] + nth] if len(of) else np.empty((0, LENGTH), np.uint8)
    return of, first[of] + nth, np.ascontiguousarray(rows)


def _repeated(t):
    """Runs of strings that start earlier too, among the stretches of a unit."""
    t = t.combine_chunks()
    column = t.column("text").chunk(0) if t.num_rows else pa.array([], pa.binary())
    uid, lo = t["uid"].to_numpy(), t["lo"].to_numpy()
    of, at, rows = _windows(*_bytes(column), lo)
    place = np.empty(len(of), np.int64)
    place[np.lexsort((at, uid[of]))] = np.arange(len(of))
    hit = longest_previous(rows, place) >= LENGTH if len(of) else np.empty(0, bool)
    run = _runs(uid[of[hit]], at[hit], at[hit])
    return pa.table({"uid": run[0], "lo": run[1], "hi": run[2]})


def _packed(batches):
    """Texts as compressed bytes, as they go through shuffles whole."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        for start in range(0, len(batch), 256):
            part = batch.slice(start, 256)
            packed = [pack.compress((t.as_py() or "").encode("utf-8")) for t in part.column("text")]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("uid"), pa.array(packed, pa.binary())], names=["doc_id", "uid", "packed"])


def _cut_out(batches):
    """The text of each wanted stretch."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        uid, packed, wanted = batch.column("uid"), batch.column("packed"), batch.column("wanted")
        for i in range(len(batch)):
            data, some = unpack.decompress(packed[i].as_py()), wanted[i].as_py()
            yield pa.RecordBatch.from_arrays(
                [pa.array([w["anchor"] for w in some]), pa.array([w["hot"] for w in some]), pa.array([uid[i].as_py()] * len(some)), pa.array([w["lo"] for w in some]),
                 pa.array([data[w["lo"] : w["hi"] + LENGTH] for w in some], pa.binary())], names=["anchor", "hot", "uid", "lo", "text"])


def _digests(batches):
    """Digests of all strings of each stretch."""
    for batch in batches:
        of, at, rows = _windows(*_bytes(batch.column("text")), batch.column("lo").to_numpy())
        both = np.array([(d & 0xFFFFFFFFFFFFFFFF, d >> 64) for d in map(xxhash.xxh3_128_intdigest, map(bytes, rows))], np.uint64).reshape(-1, 2).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(both[:, 0].copy()), pa.array(both[:, 1].copy()), pa.array(batch.column("uid").to_numpy()[of]), pa.array(at)], names=["d1", "d2", "uid", "at"])


def _by_digest(pieces):
    """Strings of very frequent anchors that start earlier too: smallest text and start per digest, joined back."""
    strings = pieces.select("uid", "lo", "text").mapInArrow(_digests, "d1 long, d2 long, uid long, at long")
    own = settled(strings, "strings")
    first = own.groupBy("d1", "d2", "uid").agg(F.min("at").alias("at"))
    first = settled(first.groupBy("d1", "d2").agg(F.min("uid").alias("uid_1"), F.min_by("at", "uid").alias("at_1"), F.count("*").alias("n")), "firsts")
    later = own.join(first, ["d1", "d2"]).where("uid > uid_1 OR at > at_1")
    return later.select("uid", F.col("at").alias("lo"), F.col("at").alias("hi"))


def _compared(texts, packed, hot):
    """Runs of later copies, and stretches to search: the first of equal ones where an anchor has several, and their text."""
    found = texts.mapInArrow(_candidates, CANDIDATE)
    # the copies met in a task are settled; they come along under the number of their text, apart from all anchors
    by_anchor = Window.partitionBy("key", "copies").orderBy("whole", "uid", "place")
    every = by_anchor.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    again = ~F.col("copies") & F.coalesce(F.lag("whole").over(by_anchor) == F.col("whole"), F.lit(False))
    found = found.withColumnRenamed("later", "copies").repartition("key").withColumn("later", F.col("copies") | again)
    found = found.withColumn("kinds", F.when(~F.col("copies"), F.sum((~F.col("later")).cast("int")).over(every)))
    first = F.when(F.col("copies"), F.col("place")).otherwise(F.shiftright("place", 6))
    last = F.when(F.col("copies"), F.col("whole")).otherwise(F.shiftright("place", 6) + F.col("place").bitwiseAND(F.lit(63)))
    found = found.where("later OR kinds > 1").select(F.when(~F.col("later"), F.col("key")).alias("anchor"), "uid", first.alias("lo"), last.alias("hi"), (F.col("kinds") > hot).alias("hot"))
    found = settled(found, "stretches")
    wanted = found.where("anchor IS NOT NULL").groupBy("uid").agg(F.collect_list(F.struct("anchor", "lo", "hi", "hot")).alias("wanted"))
    pieces = packed.join(settled(wanted, "wanted"), "uid").mapInArrow(_cut_out, "anchor long, hot boolean, uid long, lo long, text binary")
    return found, settled(pieces, "pieces")


def _searched(found, pieces, unit_rows):
    """uid, lo, hi: runs of starts whose strings also start earlier."""
    size = {r["hot"]: r["count"] for r in found.where("anchor IS NOT NULL").groupBy("hot").count().collect()}
    units = max(1, -(-size.get(False, 0) // unit_rows))
    usual = pieces.where("NOT hot").withColumn("unit", F.pmod(F.xxhash64("anchor"), F.lit(units)))
    runs = found.where("anchor IS NULL").select("uid", "lo", "hi").unionByName(usual.groupBy("unit").applyInArrow(_repeated, "uid long, lo long, hi long"))
    if size.get(True):
        runs = runs.unionByName(_by_digest(pieces.where("hot")))
    return runs


def _kept(batches):
    """Bytes, removed bytes and spans, and the digest of what stays of each text."""
    unpack = zstandard.ZstdDecompressor()
    for batch in batches:
        out = []
        runs = batch.column("runs")
        for i, packed in enumerate(batch.column("packed")):
            data = unpack.decompress(packed.as_py())
            spans, kept, digest, at = 0, 0, hashlib.sha256(), 0
            for lo, hi in sorted((r["lo"], r["hi"]) for r in runs[i].as_py() or ()):
                if lo > at or not spans:
                    digest.update(data[at:lo])
                    kept += lo - at
                    spans += 1
                at = max(at, hi + LENGTH)
            digest.update(data[at:])
            kept += len(data) - at
            out.append((len(data), len(data) - kept, spans, digest.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array([o[k] for o in out], pa.int64() if k < 3 else pa.string()) for k in range(4))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _identified(docs):
    """doc_id, text and uid, a number that is unique and ascends by doc_id: doc_id itself where that is so."""
    texts = docs.select("doc_id", "text")
    if texts.groupBy("doc_id").count().where("count > 1 OR doc_id IS NULL").isEmpty():
        return texts.withColumn("uid", F.col("doc_id"))
    rows = texts.select(F.lit(0).alias("all"), F.col("doc_id").isNull().alias("late"), "doc_id", "text")
    return numbered(rows, "all", ["late", "doc_id", "text"], "texts").select("doc_id", "text", F.col("pos").alias("uid"))


def remove_repeats(docs, hot=HOT, unit_rows=UNIT_ROWS):
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs``.

    Removed is each byte covered by a string of 100 bytes that also starts earlier: in a text with a smaller doc_id, or
    earlier in the same text. Null texts are empty ones. Rows that repeat a doc_id are texts of
    their own, ordered by text, and those without doc_id come last; of equal rows one counts as the first.
    An empty table gives no rows; other columns are not read.
    """
    rows = _identified(docs)
    texts = rows.select("uid", F.coalesce("text", F.lit("")).alias("text"))
    packed = rows.select("doc_id", "uid", "text").mapInArrow(_packed, "doc_id long, uid long, packed binary")
    runs = _searched(*_compared(texts, packed, hot), unit_rows)
    runs = settled(runs.groupBy("uid").agg(F.collect_list(F.struct("lo", "hi")).alias("runs")), "runs")
    joined = packed.join(runs, "uid", "left").select("doc_id", "packed", "runs")
    return joined.mapInArrow(_kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
