"""SentencePiece encoding and decoding; giant documents by a max-plus parallel scan.

Byte-pair encoding has no sums of scores to maximise, yet it is a path problem. Tokens
t1..tn are the encoding of their text exactly if every pair of neighbours is the encoding
of its own text: merges inside a token never depend on what is outside, and a merge across
two neighbours would show in the pair already. So among all ways to cut a text into
vocabulary entries one path alone has weight 0, every other has a forbidden step (-inf).

A text longer than ``CHUNK`` characters is cut there, wherever that falls. The state at a
cut is the token that holds the character before it: an entry of the vocabulary that fits
the text there, known from the characters around the cut. A chunk yields a matrix from the
states at its start to those at its end, 0 where a path without forbidden step joins them.
The matrices of a document are combined associatively (forwards and backwards), which leaves one
state per cut, and then each chunk writes its tokens on its own.

Inside a chunk the path comes from the public library. No entry of the vocabulary has a word
separator after another character, so every path passes the start of a word; the part of a
chunk between its first and last such place needs no matrix.
"""

from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F
from sentencepiece import sentencepiece_model_pb2 as spm

from .common import cut

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
CHUNK = 65_536
DOCUMENTS_PER_TASK = 256
BATCH_CHARS = 1 << 20
MARK = "▁"


class Pieces:
    """A BPE model with byte fallback, with and without the space that it puts first."""

    def __init__(self, proto):
        model = spm.ModelProto()
        model.ParseFromString(proto)
        spec = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or spec.name != "identity" or spec.remove_extra_whitespaces or not (spec.add_dummy_prefix and model.trainer_spec.byte_fallback):
            raise ValueError("the model must be BPE with byte fallback, a first space and texts otherwise as they are")
        self.whole = sentencepiece.SentencePieceProcessor(model_proto=proto)
        spec.add_dummy_prefix = False
        self.part = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.ids = {p.piece.replace(MARK, " "): i for i, p in enumerate(model.pieces) if p.type == 1}
        self.bytes = frozenset(i for i, p in enumerate(model.pieces) if p.type == 6)
        self.longest = max(map(len, self.ids))
        self.words = not any(" " in p.lstrip(" ") for p in self.ids)

    def first(self, ids, token):
        return bool(ids) and (ids[0] == self.ids[token] if token in self.ids else ids[0] in self.bytes)

    def last(self, ids, token):
        return bool(ids) and (ids[-1] == self.ids[token] if token in self.ids else ids[-1] in self.bytes)

    def states(self, s, at):
        """Spans (start, end) of the tokens that may hold the character before ``at``."""
        return [(a, e) for a in range(max(0, at - self.longest), at) for e in range(at, min(len(s), a + self.longest) + 1)
                if (e - a == 1 or s[a:e] in self.ids)]

    def matrix(self, s, start, end, from_start, to_end):
        """Weights from the states at ``start`` to those at ``end``; one state where a text begins or ends."""
        rows = [(start, start)] if from_start else self.states(s, start)
        cols = [(end, end)] if to_end else self.states(s, end)
        words = [i for i in range(max(1, start), end) if s[i] == " " and s[i - 1] != " "] if self.words else []
        out = np.full((len(rows), len(cols)), -np.inf)
        if words:
            head = np.array([from_start or self.first(self.part.encode(s[a : words[0]]), s[a:e]) for a, e in rows])
            tail = np.array([to_end or self.last(self.part.encode(s[words[-1] : e]), s[a:e]) for a, e in cols])
            out[np.outer(head, tail)] = 0
            return rows, cols, out
        for i, (a, e) in enumerate(rows):
            for end_at in {c[1] for c in cols}:
                ids = self.part.encode(s[a:end_at])
                if from_start or self.first(ids, s[a:e]):
                    for j, (b, f) in enumerate(cols):
                        if f == end_at and (to_end or (b >= e and self.last(ids, s[b:f])) or ((a, e) == (b, f))):
                            out[i, j] = 0
        return rows, cols, out

    def between(self, s, entry, leave):
        """Ids of the tokens after the token ``entry`` up to the end of the token ``leave``."""
        (a, e), (_, f) = entry, leave
        if f <= e:
            return []
        drop = 0 if e == a else 1 if s[a:e] in self.ids else len(s[a:e].encode())
        return self.part.encode(s[a:f])[drop:]


@lru_cache(2)
def pieces(proto):
    return Pieces(proto)


CHUNKS = pa.schema([("rid", pa.int64()), ("k", pa.int32()), ("low", pa.int64()), ("start", pa.int32()), ("end", pa.int32()), ("last", pa.bool_()), ("s", pa.string())])


def plain(text):
    """What decoding gives back: the separator itself cannot be told from a space."""
    return text.replace(MARK, " ")


def combine(a, b):
    """Max-plus product of two transfer matrices; associative."""
    return (a[:, :, None] + b[None, :, :]).max(1)


def scan(matrices):
    """Products of all prefixes, by combining neighbours and scanning their products."""
    if len(matrices) == 1:
        return matrices
    pairs = scan([combine(matrices[i], matrices[i + 1]) for i in range(0, len(matrices) - 1, 2)])
    out = [matrices[0]]
    for i in range(1, len(matrices)):
        out.append(pairs[i // 2] if i % 2 else combine(pairs[i // 2 - 1], matrices[i]))
    return out


def _small(proto, batches):
    """Whole texts, some at a time, for ids as Python numbers take much more room than text."""
    p = pieces(proto)
    for batch in batches:
        texts = [t or "" for t in batch.column(batch.num_columns - 1).to_pylist()]
        start = 0
        while start < len(texts):
            end, held = start, 0
            while end < len(texts) and (held < BATCH_CHARS or end == start):
                held += len(texts[end])
                end += 1
            part = texts[start:end]
            ids = p.whole.encode(part, num_threads=1)
            back = [p.whole.decode(i) == plain(t) for i, t in zip(ids, part, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(c.slice(start, end - start) for c in batch.columns[:-1]), pa.array(map(len, ids), pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.bool_())],
                names=[*batch.schema.names[:-1], "n_tokens", "ids", "round_trip"])
            start = end


def _chunked(size, longest, schema, batches):
    """The chunks of each text with the characters around them; the first carries the kept columns."""
    for batch in batches:
        kept = batch.column(2)
        for row, (rid, text) in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            s = " " + plain(text)
            cuts = [*range(0, len(s), size), len(s)]
            for k, (start, end) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                low, high = max(0, start - longest), min(len(s), end + longest)
                values = (rid, k, low, start - low, end - low, end == len(s), s[low:high])
                one = [pa.array([v], t) for v, t in zip(values, schema.types, strict=True)]
                yield pa.RecordBatch.from_arrays([*one, kept.slice(row, 1) if k == 0 else pa.nulls(1, kept.type)], names=[*schema.names, "kept"])


def _matrices(proto, batches):
    p = pieces(proto)
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            rows, cols, m = p.matrix(r["s"], r["start"], r["end"], r["k"] == 0, r["last"])
            place = lambda spans, low=r["low"]: np.array(spans, np.int64).ravel() + low
            out.append({"rid": r["rid"], "k": r["k"], "rows": place(rows), "cols": place(cols), "m": (m == 0).ravel()})
        yield pa.RecordBatch.from_pandas(
            pd.DataFrame(out, columns=["rid", "k", "rows", "cols", "m"]),
            schema=pa.schema([("rid", pa.int64()), ("k", pa.int32()), ("rows", pa.list_(pa.int64())), ("cols", pa.list_(pa.int64())), ("m", pa.list_(pa.bool_()))]), preserve_index=False)


def _states(rows):
    """The one state at each cut of a document: on a path from its start and on one to its end."""
    rows = rows.sort_values("k")
    spans = [np.asarray(c).reshape(-1, 2) for c in rows["cols"]]
    starts = [np.asarray(c).reshape(-1, 2) for c in rows["rows"]]
    ms = [np.where(np.asarray(m, bool).reshape(len(a), len(b)), 0.0, -np.inf) for m, a, b in zip(rows["m"], starts, spans, strict=True)]
    ahead = [m[0] for m in scan(ms)]
    behind = [m[:, 0] for m in (x.T for x in scan([x.T for x in ms[::-1]]))][::-1]
    at = [int(np.argmax(ahead[i] + behind[i + 1])) for i in range(len(ms) - 1)] + [0]
    leave = [s[j] for s, j in zip(spans, at, strict=True)]
    entry = [starts[0][0], *leave[:-1]]
    return pd.DataFrame({"rid": rows["rid"], "k": rows["k"], "a": [x[0] for x in entry], "e": [x[1] for x in entry], "b": [x[0] for x in leave], "f": [x[1] for x in leave]})


def _chunk_ids(proto, batches):
    p = pieces(proto)
    for batch in batches:
        rows = batch.to_pylist()
        ids, back = [], []
        for r in rows:
            a, e, f = r["a"] - r["low"], r["e"] - r["low"], r["f"] - r["low"]
            ids.append(p.between(r["s"], (a, e), (r["b"] - r["low"], f)))
            back.append(p.part.decode(ids[-1]) == r["s"][e:f])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.bool_())], names=["rid", "k", "ids", "round_trip"])


def encode(docs, model=MODEL, chunk=CHUNK, keep=("doc_id",)):
    """The columns ``keep`` of every row with n_tokens, ids and round_trip (decoding gives the text back).

    Null and empty texts have no tokens. The separator character itself counts as a space, as the
    model has it. Rows are encoded each on its own: repeated rows alike, null doc_id as
    any. An empty table gives no rows; columns that are not kept are not read.
    """
    with open(model, "rb") as f:
        proto = f.read()
    longest = pieces(proto).longest
    rows = docs.select(*keep, "text")
    size = F.coalesce(F.length(rows["text"]), F.lit(0))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    small = rows.where(size < chunk).mapInArrow(partial(_small, proto), f"{kept}, n_tokens long, ids array<int>, round_trip boolean")
    giant = rows.where(size >= chunk).select(F.monotonically_increasing_id().alias("rid"), "text", F.struct(*keep).alias("kept"))
    form = "rid long, k int, low long, start int, end int, last boolean, s string, kept " + giant.schema["kept"].dataType.simpleString()
    # chunks are dealt to tasks and kept once; all that follows is derived from them
    parts = cut(giant.mapInArrow(partial(_chunked, chunk, longest, CHUNKS), form).repartition("rid", "k"))
    tasks = max(1, parts.where("k = 0").count() // DOCUMENTS_PER_TASK)
    found = parts.drop("kept").mapInArrow(partial(_matrices, proto), "rid long, k int, rows array<long>, cols array<long>, m array<boolean>")
    states = found.repartition(tasks, "rid").groupBy("rid").applyInPandas(_states, "rid long, k int, a long, e long, b long, f long")
    done = parts.drop("kept").join(states, ["rid", "k"]).mapInArrow(partial(_chunk_ids, proto), "rid long, k int, ids array<int>, round_trip boolean")
    whole = done.groupBy("rid").agg(F.array_sort(F.collect_list(F.struct("k", "ids"))).alias("parts"), F.min("round_trip").alias("round_trip"))
    whole = whole.join(parts.where("k = 0").select("rid", "kept"), "rid")
    ids = F.flatten(F.col("parts.ids"))
    return small.unionByName(whole.select("kept.*", F.size(ids).cast("long").alias("n_tokens"), ids.alias("ids"), "round_trip"))


def decode(rows, model=MODEL):
    """``rows`` with ids replaced by text; null ids give null."""
    with open(model, "rb") as f:
        proto = f.read()

    @F.pandas_udf("string")
    def text(ids: pd.Series) -> pd.Series:
        p = pieces(proto)
        return ids.map(lambda i: None if i is None else p.whole.decode([int(x) for x in i]))

    return rows.withColumn("text", text(F.col("ids"))).drop("ids")
