"""Merkle manifest of a table: leaves per row, a tree per language, proofs by a recursive query.

The tree is binary and is stored as parent-linked node rows. Every ninth
level is stored; a row has the steps to its parent (side and sibling of up to ``STEP`` levels), so a table of n rows has
n / 511 rows above its leaves and a climb visits log512(n) of them. A recursive query of Spark
ascends from every leaf at once, appends the siblings and folds the hash on the way. Each of its rounds goes through
a shuffle with all siblings so far, so rounds are what it costs; rows whose parent is the root end the climb.

Places of leaves come from one range sort: an index within each sorted part and a table of part sizes, so
no language is in one task, and a block of 512 neighbours is all that meets in one group.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sizes import settled
from .common import numbered

STEP = 9
EVERY = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value):
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _digest(*texts):
    return F.unhex(F.sha2(F.concat(*texts), 256))


def _hex(digest):
    return F.lower(F.hex(digest))


def leaves(docs, every=EVERY):
    """doc_id, group (language, null first in order), leaf and the leaf of the tampered row, null where that is the same."""
    fields = {c: docs[c] for c in FIELDS}
    more = fields | {"n_chars": fields["n_chars"].cast("decimal(20,0)") + 1}
    hit = (F.crc32(docs["doc_id"].cast("string").cast("binary")) % every == 0) & docs["n_chars"].isNotNull()
    group = F.coalesce(F.concat(F.lit("s"), docs["lang"]), F.lit("n"))
    return docs.select(
        docs["doc_id"], group.alias("group"), _digest(*map(_field, fields.values())).alias("leaf"),
        F.when(hit, _digest(*map(_field, more.values()))).alias("changed"))


def _joined(level):
    """The level above an array of hashes: every two neighbours become one, a last one alone too."""
    runs = F.sequence(F.lit(0), ((F.size(level) + 1) / 2).cast("int") - 1)
    return F.transform(runs, lambda i: _digest(_hex(F.get(level, i * 2)), F.coalesce(_hex(F.get(level, i * 2 + 1)), F.lit(""))))


def _blocks(nodes, own):
    """Blocks of 2^STEP neighbours of a group with the tree above each: its top, and its nodes with their steps.

    A step is whether the sibling is on the left and the sibling, null where a node goes up alone. The steps of a node
    lead to the top of its block, or to the top of the group if that is lower.
    """
    blocks = nodes.groupBy("group", "n", F.shiftright("pos", STEP).alias("block")).agg(F.sort_array(F.collect_list(F.struct("pos", "hash", *own))).alias("nodes"))
    blocks = blocks.withColumn("l0", F.col("nodes.hash"))
    for j in range(STEP):
        blocks = blocks.withColumn(f"l{j + 1}", F.when(F.col("n") > (1 << j), _joined(f"l{j}")).otherwise(F.col(f"l{j}")))

    def with_path(node, i):
        steps = []
        for j in range(STEP):
            at = F.shiftright(i, j)
            steps.append(F.when(F.col("n") > (1 << j), F.struct((at % 2 == 1).alias("left"), F.get(F.col(f"l{j}"), at.bitwiseXOR(F.lit(1))).alias("sib"))))
        path = F.filter(F.array(*steps), lambda s: s.isNotNull())
        return F.struct(*[node[c].alias(c) for c in ("pos", "hash", *own)], path.alias("path"))

    return blocks.select("group", "n", "block", F.get(f"l{STEP}", F.lit(0)).alias("above"), F.transform("nodes", with_path).alias("nodes"))


def _id(prefix, tier, pos, group):
    return F.concat_ws(":", F.lit(f"{prefix}{tier}"), pos.cast("string"), group)


def _linked(blocks, prefix, tier, own):
    """Node rows with their id and that of their parent, null at the top of the group."""
    rows = blocks.select("group", "n", "block", F.explode("nodes").alias("node")).select("group", "n", "block", "node.*")
    parent = F.when(F.col("n") > 1, _id(prefix, tier + 1, F.col("block"), F.col("group")))
    return rows.select(*own, _id(prefix, tier, F.col("pos"), F.col("group")).alias("id"), parent.alias("parent"), "path", "hash", "group", (F.col("n") == 1).alias("top"))


def _tree(nodes, prefix, own):
    """Stored tiers of the trees over the groups of ``nodes``, the tier of the nodes first.

    A tier has 2^STEP times fewer rows than the one below; the last has the tops of the largest groups.
    """
    tiers, largest = [], nodes.agg(F.max("n")).first()[0] or 0
    while True:
        blocks = settled(_blocks(nodes, own), f"tier-{prefix}{len(tiers)}")
        tiers.append(_linked(blocks, prefix, len(tiers), own))
        if largest <= 1:
            return tiers
        above = blocks.where("n > 1")  # one node alone is the top already
        nodes = above.select("group", F.ceil(F.col("n") / (1 << STEP)).alias("n"), F.col("block").alias("pos"), F.col("above").alias("hash"))
        largest, own = -(-largest // (1 << STEP)), []


_FOLD = "aggregate({path}, {start}, (h, s) -> unhex(sha2(CASE WHEN s.sib IS NULL THEN lower(hex(h)) WHEN s.left THEN concat(lower(hex(s.sib)), lower(hex(h))) ELSE concat(lower(hex(h)), lower(hex(s.sib))) END, 256)))"
_PROOF = "aggregate({path}, CAST('' AS BINARY), (p, s) -> concat(p, coalesce(s.sib, CAST('' AS BINARY))))"
CLIMB = f"""WITH RECURSIVE climb(doc_id, leaf, subroot, proof, folded, parent) AS (
  SELECT doc_id, hash, CASE WHEN top THEN hash END, {_PROOF.format(path="path")}, {_FOLD.format(path="path", start="coalesce(changed, hash)")}, parent FROM {{leaves}}
  UNION ALL
  SELECT c.doc_id, c.leaf, coalesce(c.subroot, CASE WHEN n.top THEN n.hash END), concat(c.proof, {_PROOF.format(path="n.path")}), {_FOLD.format(path="n.path", start="c.folded")}, n.parent
  FROM climb c JOIN {{nodes}} n ON c.parent = n.id)
SELECT doc_id, lower(hex(leaf)) AS leaf, lower(hex(subroot)) AS subroot, {{root}} AS root, sha2(lower(hex(proof)), 256) AS proof_sha256,
  lower(hex(folded)) AS folded_root, lower(hex(folded)) = {{root}} AS verified FROM climb WHERE parent IS NULL"""


def manifest(docs, every=EVERY):
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row of ``docs``.

    Leaves of a language ascend by doc_id (null last), rows that repeat a doc_id by their leaf; equal rows have equal
    leaves and each its own place. The subroots of the languages, null first, make the root. Nulls are
    hashed as ``-``, so they differ from empty texts. A row whose n_chars is null, or that has no
    doc_id, is never tampered with. An empty table gives no rows; other columns are not read.
    """
    rows = leaves(docs, every).withColumn("late", F.col("doc_id").isNull())
    placed = numbered(rows, "group", ["late", "doc_id", "leaf"], "leaves").withColumnRenamed("leaf", "hash")
    tiers = _tree(placed, "", ["doc_id", "changed"])
    # the tops of the languages are the leaves of the last tree; their order is that of the group names
    tops = reduce(DataFrame.unionByName, [t.where("top").select(F.lit("").alias("group"), F.col("group").alias("lang"), "hash", F.col("id").alias("below")) for t in tiers])
    upper = _tree(numbered(tops, "group", ["lang"], "languages"), "r", ["below"])
    root = upper[-1].select("id", F.lower(F.hex("hash")).alias("hash")).first()
    if root is None:
        return docs.limit(0).select("doc_id", *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")], F.lit(True).alias("verified"))
    upper = [t.withColumn("parent", F.when(F.col("parent") != root["id"], F.col("parent"))) for t in upper]
    nodes = [t.select("id", "parent", "path", "hash", "top") for t in tiers] + [t.select("id", "parent", "path", "hash", F.lit(False).alias("top")) for t in upper]
    nodes = reduce(DataFrame.unionByName, nodes[1 : len(tiers)] + nodes[len(tiers) + 1 : -1], nodes[0].limit(0))
    # a climb has as many rows as leaves times stored tiers, far above the default limit of recursive queries
    docs.sparkSession.conf.set("spark.sql.cteRecursionRowLimit", "-1")
    return docs.sparkSession.sql(CLIMB, root=root["hash"], leaves=_lift(tiers[0], upper[0]), nodes=settled(_lift(nodes, upper[0]), "nodes"))


def _lift(nodes, upper):
    """Tops of the languages get path and parent of the tree above them, in which they are ``below``."""
    up = upper.select(F.col("below").alias("_id"), F.col("parent").alias("_parent"), F.col("path").alias("_path"))
    both = nodes.join(up, F.when(nodes["top"], nodes["id"]) == F.col("_id"), "left")
    return both.withColumns({"parent": F.coalesce("parent", "_parent"), "path": F.coalesce("_path", "path")}).drop("_id", "_parent", "_path")


def oracle(table="documents", every=EVERY):
    """The same in DuckDB SQL, with binary trees level by level; crc32 is spelled out."""
    def digest(more):
        values = [f"CAST({c} AS VARCHAR)" if c != "n_chars" else f"CAST(CAST(n_chars AS HUGEINT) + {more} AS VARCHAR)" for c in FIELDS]
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"

    pair = "sha256(string_agg(h, '' ORDER BY pos))"
    alive = "((n + (1 << level) - 1) >> level) > 1"
    fold = "sha256(CASE WHEN s.h IS NULL THEN f.h WHEN s.pos < f.pos THEN s.h || f.h ELSE f.h || s.h END)"
    bit = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    return f"""WITH RECURSIVE crcs AS (SELECT list(list_reduce(list_prepend(CAST(b AS BIGINT), CAST(range(8) AS BIGINT[])), lambda x, i: {bit}) ORDER BY b) AS t FROM range(256) r(b)),
hashed AS (SELECT doc_id, lang, {digest(0)} AS leaf, {digest(1)} AS more,
  xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))), lambda x, c: xor(x >> 8, t[(xor(x, c) & 255) + 1])), 4294967295) AS crc FROM {table}, crcs),
leaves AS (SELECT *, CASE WHEN doc_id IS NOT NULL AND crc % {every} = 0 THEN more ELSE leaf END AS given, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS LAST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n,
  row_number() OVER () AS k FROM hashed),
low AS (SELECT coalesce('s' || lang, 'n') AS g, 0 AS level, pos, n, leaf AS h FROM leaves
  UNION ALL SELECT g, level + 1, pos >> 1, n, {pair} FROM low WHERE {alive} GROUP BY g, level, pos >> 1, n),
tops AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM low WHERE NOT {alive}),
high AS (SELECT 0 AS level, pos, n, h FROM tops UNION ALL SELECT level + 1, pos >> 1, n, {pair} FROM high WHERE {alive} GROUP BY level, pos >> 1, n),
climb AS (SELECT k, g, 0 AS level, leaves.pos, leaves.n, given AS h FROM leaves, (SELECT DISTINCT g FROM low) WHERE g = coalesce('s' || lang, 'n')
  UNION ALL SELECT f.k, f.g, f.level + 1, f.pos >> 1, f.n, {fold} FROM climb f LEFT JOIN low s ON s.g = f.g AND s.level = f.level AND s.pos = xor(f.pos, 1) WHERE ((f.n + (1 << f.level) - 1) >> f.level) > 1),
upper AS (SELECT c.k, 0 AS level, t.pos, t.n, c.h FROM climb c JOIN tops t USING (g) WHERE ((c.n + (1 << c.level) - 1) >> c.level) = 1
  UNION ALL SELECT f.k, f.level + 1, f.pos >> 1, f.n, {fold} FROM upper f LEFT JOIN high s ON s.level = f.level AND s.pos = xor(f.pos, 1) WHERE ((f.n + (1 << f.level) - 1) >> f.level) > 1),
siblings AS (SELECT c.k, c.level, s.h FROM climb c JOIN low s ON s.g = c.g AND s.level = c.level AND s.pos = xor(c.pos, 1) WHERE ((c.n + (1 << c.level) - 1) >> c.level) > 1
  UNION ALL SELECT u.k, 1000 + u.level, s.h FROM upper u JOIN high s ON s.level = u.level AND s.pos = xor(u.pos, 1) WHERE ((u.n + (1 << u.level) - 1) >> u.level) > 1),
proofs AS (SELECT k, string_agg(h, '' ORDER BY level) AS p FROM siblings GROUP BY k),
folded AS (SELECT k, h FROM upper WHERE ((n + (1 << level) - 1) >> level) = 1),
root AS (SELECT h FROM high WHERE ((n + (1 << level) - 1) >> level) = 1)
SELECT doc_id, leaf, tops.h AS subroot, root.h AS root, sha256(coalesce(p, '')) AS proof_sha256, folded.h AS folded_root, folded.h = root.h AS verified
FROM leaves JOIN tops ON tops.g = coalesce('s' || lang, 'n') JOIN folded USING (k) LEFT JOIN proofs USING (k), root"""
