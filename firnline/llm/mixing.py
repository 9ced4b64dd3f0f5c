"""Mixing sources to target weights by Sainte-Laguë apportionment, in DataFrame functions only.

Documents are dealt by a seeded hash to shards of about ``SHARD_ROWS`` rows, so no source is in one
task however large it is. The mix of a shard is a number of equal blocks of words, at most
about ``BLOCKS`` of them; they go to its sources by the highest quotients votes / (2 seats + 1),
the votes being what the shard should give of the source's target. The documents of a source in a shard,
laid end to end in seeded order and twice over, are cut into those blocks, and the first blocks up
to the quota are taken: whole documents but for the last one of a lap. Where texts are handed on, that
one is rounded in or out by a seeded rule, with the part taken as its chance.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import cut

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SHARD_ROWS = 500
BLOCKS = 50_000
SHARDS_PER_TASK = 64
SEED = 11
SPACE = r"[\x20\x09-\x0D]+"


def _words(text):
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def _sized(docs, seed):
    """With size, a source key that is never null, and a seeded place in the order of documents."""
    return docs.withColumns({
        "_mix_size": F.size(_words(docs["text"])).cast("long"),
        "_mix_src": F.coalesce(F.concat(F.lit("s"), docs["source"]), F.lit("n")),
        "_mix_at": F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(str(seed)), docs["doc_id"].cast("string"), docs["text"]).cast("binary")), 1, 15), 16, 10).cast("long"),
    })


def _targets(totals, weights, share, most):
    """Weighted shares of ``share`` times all words, none above ``most`` times its source.

    Sources that reach their limit are those with the smallest limit per weight; the rest
    get weight times the level that uses up what is left.
    """
    by_source = Window.orderBy(F.col("_mix_src").startswith("n"), "_mix_src")  # one row per source
    rank = F.row_number().over(by_source)
    every = Window.partitionBy()
    before = Window.orderBy("ratio", "rank").rowsBetween(Window.unboundedPreceding, -1)
    out = totals.withColumn("rank", rank)
    out = out.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("rank") - 1) % len(weights) + 1).cast("int")))
    out = out.withColumn("most", F.col("total") * float(most)).withColumn("ratio", F.col("most") / F.col("weight"))
    left = F.sum("total").over(every) * float(share) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    weight = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    out = out.withColumn("level", left / weight)
    return out.withColumn("target", F.least("most", F.max("level").over(every) * F.col("weight"))).select("_mix_src", "rank", "total", "target")


def _seats(cells, blocks, tasks=1):
    """Blocks of each source in each shard: the divisor is halved in, ties go by the next quotient."""
    # few bytes, much work: dealt to a number of tasks that is not merged again
    one = cells.repartition(max(1, tasks), "_mix_shard").groupBy("_mix_shard").agg(F.array_sort(F.collect_list(F.struct("rank", "_mix_src", "z", "votes"))).alias("all"))
    one = one.withColumn("votes", F.expr("aggregate(all, 0D, (s, x) -> s + x.votes)")).where("votes > 0")
    one = one.withColumn("block", F.greatest(F.lit(1.0), F.floor(F.col("votes") / float(blocks)).cast("double")))
    one = one.withColumn("n", F.round(F.col("votes") / F.col("block")))
    seats = "aggregate(all, 0D, (t, x) -> t + floor(x.votes / {d} + 0.5D))"
    step = f"if({seats.format(d='((s.lo + s.hi) / 2D)')} > n, struct((s.lo + s.hi) / 2D AS lo, s.hi AS hi), struct(s.lo AS lo, (s.lo + s.hi) / 2D AS hi))"
    one = one.withColumn("d", F.expr(f"aggregate(sequence(1, 60), struct(votes / (n + size(all)) AS lo, if(n > size(all), votes / (n - size(all)), 2.5D * votes) AS hi), (s, i) -> {step}).hi"))
    one = one.withColumn("left", F.expr("n - " + seats.format(d="d")))
    one = one.withColumn("next", F.expr("array_sort(transform(all, x -> struct(-x.votes / (2D * floor(x.votes / d + 0.5D) + 1D) AS q, x.rank AS rank, x AS own)))"))
    out = one.select("_mix_shard", "block", "left", "d", F.posexplode("next").alias("pos", "x"))
    count = F.floor(F.col("x.own.votes") / F.col("d") + 0.5) + F.when(F.col("pos") < F.col("left"), 1).otherwise(0)
    return out.select("_mix_shard", F.col("x.own._mix_src").alias("_mix_src"), F.col("x.own.z").alias("z"), count.alias("seats"), "block")


def _taken(docs, weights, share, most, shard_rows, blocks, seed, narrow):
    """``docs`` with _mix_ columns: size, source total, target and the words taken (repeats counted)."""
    sized = cut(_sized(docs, seed).select(*narrow, "_mix_size", "_mix_src", "_mix_at")) if narrow else _sized(docs, seed)
    small = sized if narrow else cut(sized.select("_mix_size", "_mix_src", "_mix_at"))
    shards = max(1, -(-small.count() // shard_rows))
    shard = F.pmod(F.col("_mix_at"), F.lit(shards).cast("long"))
    cells = small.groupBy("_mix_src", shard.alias("_mix_shard")).agg(F.sum("_mix_size").alias("z"))
    cells = cut(cells)
    totals = cells.groupBy("_mix_src").agg(F.sum("z").alias("total"))
    targets = cut(_targets(totals, weights, share, most))
    cells = cells.join(targets, "_mix_src")
    votes = F.when(F.col("total") > 0, F.col("target") * F.col("z") / F.col("total")).otherwise(0.0)
    seats = _seats(cells.select("_mix_shard", "_mix_src", "rank", "z", votes.alias("votes")), blocks, shards // SHARDS_PER_TASK)
    quota = cells.select("_mix_shard", "_mix_src", "total", "target").join(seats, ["_mix_shard", "_mix_src"], "left")
    quota = cut(quota.select(
        "_mix_shard", "_mix_src", F.col("total").alias("_mix_total"), F.col("target").alias("_mix_target"), F.coalesce("z", F.lit(0)).alias("_mix_z"),
        F.coalesce(F.least(F.col("z") * most, (F.col("seats") * F.col("block")).cast("long")), F.lit(0)).alias("_mix_quota")))
    dealt = sized.withColumn("_mix_shard", shard).join(quota, ["_mix_shard", "_mix_src"])
    line = Window.partitionBy("_mix_shard", "_mix_src").orderBy("_mix_at", "_mix_size").rowsBetween(Window.unboundedPreceding, 0)
    dealt = dealt.withColumn("_mix_end", F.sum("_mix_size").over(line))
    words = F.lit(0).cast("long")
    for lap in range(most):
        stop = F.greatest(F.col("_mix_quota") - lap * F.col("_mix_z"), F.lit(0))
        words = words + F.least(F.col("_mix_end"), stop) - F.least(F.col("_mix_end") - F.col("_mix_size"), stop)
    return dealt.withColumn("_mix_taken", words)


def mix(docs, weights=WEIGHTS, share=SHARE, most=MOST, shard_rows=SHARD_ROWS, blocks=BLOCKS, seed=SEED):
    """doc_id, size (words), source_size, target (of the source) and taken (words, repeats counted).

    Null texts have size 0, a null source is a source of its own and comes last. A row counts as
    a document of its own, also if it repeats another; null doc_id is no exception. Sources
    without words have the target 0. Reruns agree: the order is a hash of seed, doc_id and text.
    An empty table gives no rows; other columns are not read.
    """
    docs = docs.select("doc_id", "source", "text")
    out = _taken(docs, weights, share, most, shard_rows, blocks, seed, ["doc_id"])
    return out.select("doc_id", F.col("_mix_size").alias("size"), F.col("_mix_total").alias("source_size"), F.col("_mix_target").alias("target"), F.col("_mix_taken").alias("taken"))


_PRIME = 999_983  # steps of the seeded rule


def mixed(docs, weights=WEIGHTS, share=SHARE, most=MOST, shard_rows=SHARD_ROWS, blocks=BLOCKS, seed=SEED):
    """``docs`` as mixed: each document once per copy taken, all columns as they are, texts always whole.

    A copy of which ``mix`` takes a part is in or out by the seeded hash of the document: in with that part as
    chance, so a source's words differ from its target by less than a document per shard and lap, and not on average. Documents
    without words or of which nothing is taken go.
    """
    out = _taken(docs, weights, share, most, shard_rows, blocks, seed, None)
    size, taken, rest = F.col("_mix_size"), F.col("_mix_taken"), F.col("_mix_at") % _PRIME
    part = lambda i: F.greatest(F.lit(0), F.least(size, taken - i.cast("long") * size))
    copies = F.filter(F.sequence(F.lit(0), F.lit(most - 1)), lambda i: part(i) * _PRIME > rest * size)
    return out.where("_mix_taken > 0").withColumn("_mix_copy", F.explode(copies)).select(docs.columns)


def oracle(table="documents", weights=WEIGHTS, share=SHARE, most=MOST, shard_rows=SHARD_ROWS, blocks=BLOCKS, seed=SEED):
    """The result of ``mix`` in DuckDB SQL; the divisor is halved in by a recursive query."""
    seats = "list_sum(list_transform(v, lambda x: floor(x / {d} + 0.5)))"
    weight = "CASE (rank - 1) % {} {} END".format(len(weights), " ".join(f"WHEN {i} THEN {float(w)!r}e0" for i, w in enumerate(weights)))
    laps = " + ".join(
        f"least(fin, greatest(quota - {lap} * z, 0)) - least(fin - size, greatest(quota - {lap} * z, 0))" for lap in range(most))
    return f"""WITH RECURSIVE sized AS (SELECT doc_id, coalesce('s' || source, 'n') AS src, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
  CAST('0x' || substr(md5(concat_ws(':', '{seed}', CAST(doc_id AS VARCHAR), text)), 1, 15) AS BIGINT) AS place FROM {table}),
dealt AS (SELECT *, place % (SELECT greatest(1, CAST(ceil(count(*) / {float(shard_rows)!r}) AS BIGINT)) FROM sized) AS shard FROM sized),
cells AS (SELECT src, shard, CAST(sum(size) AS BIGINT) AS z FROM dealt GROUP BY 1, 2),
ranked AS (SELECT src, total, CAST(row_number() OVER (ORDER BY src LIKE 'n%', src) AS INTEGER) AS rank FROM (SELECT src, CAST(sum(z) AS BIGINT) AS total FROM cells GROUP BY 1) t),
weighed AS (SELECT *, {weight} AS weight, total * {float(most)!r}e0 AS most FROM ranked),
levels AS (SELECT *, (sum(total) OVER () * {float(share)!r}e0 - coalesce(sum(most) OVER b, 0e0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0e0)) AS level
  FROM weighed WINDOW b AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT *, least(most, max(level) OVER () * weight) AS target FROM levels),
votes AS (SELECT shard, src, rank, z, total, target, CASE WHEN total > 0 THEN target * z / total ELSE 0e0 END AS vote FROM cells JOIN targets USING (src)),
shards AS (SELECT *, round(s / block) AS n FROM (SELECT *, greatest(1e0, floor(s / {float(blocks)!r}e0)) AS block FROM (
  SELECT shard, v, list_sum(v) AS s FROM (SELECT shard, list(vote ORDER BY rank) AS v FROM votes GROUP BY 1) a) b WHERE s > 0) c),
halved AS (SELECT shard, v, n, block, 0 AS i, s / (n + len(v)) AS lo, CASE WHEN n > len(v) THEN s / (n - len(v)) ELSE 2.5e0 * s END AS hi FROM shards
  UNION ALL SELECT shard, v, n, block, i + 1, CASE WHEN {seats.format(d='((lo + hi) / 2e0)')} > n THEN (lo + hi) / 2e0 ELSE lo END, CASE WHEN {seats.format(d='((lo + hi) / 2e0)')} > n THEN hi ELSE (lo + hi) / 2e0 END FROM halved WHERE i < 60),
divisors AS (SELECT shard, block, hi AS d, n - {seats.format(d='hi')} AS spare FROM halved WHERE i = 60),
seated AS (SELECT shard, src, z, block, floor(vote / d + 0.5) + CASE WHEN row_number() OVER (PARTITION BY shard ORDER BY -vote / (2e0 * floor(vote / d + 0.5) + 1e0), rank) <= spare THEN 1 ELSE 0 END AS seats FROM votes JOIN divisors USING (shard)),
lines AS (SELECT doc_id, size, total, target, cells.z, coalesce(least(cells.z * {most}, CAST(seats * block AS BIGINT)), 0) AS quota,
  CAST(sum(size) OVER (PARTITION BY dealt.shard, dealt.src ORDER BY place, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fin
  FROM dealt JOIN cells USING (src, shard) JOIN targets USING (src) LEFT JOIN seated ON seated.src = dealt.src AND seated.shard = dealt.shard)
SELECT doc_id, size, total AS source_size, target, CAST({laps} AS BIGINT) AS taken FROM lines"""
