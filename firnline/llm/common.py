"""What several operators share: shared-folder checkpoints, places in an order, linked components."""

import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators.sizes import settled

_INDEX = (1 << 33) - 1  # monotonically_increasing_id has the row number of a part in its low 33 bits


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df):
    """``df`` computed once and kept in the folder of spark.checkpoint.dir, which outlives executors.

    Only a local session without that setting falls back to a temporary folder.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        base = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not base and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        sc.setCheckpointDir(base or tempfile.mkdtemp(prefix="firnline-"))
    return df.checkpoint()


def numbered(rows, group, order, name):
    """``rows`` with their place (from 0) in the order of their group, and the size n of the group.

    One range sort over all; the place is the index in the sorted part plus the rows of the group in parts before.
    """
    parts = rows.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    parts = settled(parts.withColumn("_at", F.monotonically_increasing_id()), name)
    part, index = F.shiftrightunsigned("_at", 33).alias("_part"), F.col("_at").bitwiseAND(F.lit(_INDEX))
    sizes = parts.groupBy(group, part).agg(F.min(index).alias("_first"), F.count("*").alias("_rows"))
    upto = Window.partitionBy(group).orderBy("_part")  # one row per part of the sort
    sizes = sizes.select(
        group, "_part", (F.sum("_rows").over(upto) - F.col("_rows") - F.col("_first")).alias("_base"), F.sum("_rows").over(Window.partitionBy(group)).alias("n"))
    sizes = settled(sizes, f"{name}-parts")
    placed = parts.withColumn("_part", part).join(sizes, [group, "_part"])
    return placed.withColumn("pos", index + F.col("_base")).drop("_at", "_part", "_base")


def share(key, parts):
    """A stable number from 0 to parts-1 for a key."""
    return F.pmod(F.xxhash64(F.lit(17), key), F.lit(parts).cast("long")).cast("int")


def _no_star(edges):
    """Number of nodes that keep ``edges`` (u > v) from being a forest of stars."""
    ends = edges.select(F.col("u").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(
        edges.select(F.col("v").alias("n"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    seen = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return seen.where("up > 1 OR (up = 1 AND down = 1)").count()


def components(links):
    """Connected components of links (a, b): rows (node, root), root the smallest node of its component.

    Alternating large-star and small-star steps: each replaces the links of a node by links to
    the smallest node it sees, so a component becomes a star in O(log^2 n) rounds whatever
    its shape. Minima are combined before the shuffle, and the joins have a plain exchange on
    both sides, so a node with very many links is split as a skewed join. Roots with
    no other node do not appear.
    """
    e = cut(links.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    while _no_star(e):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = cut(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        big = cut(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = cut(big.groupBy("u").agg(F.min("v").alias("m")))
        rest = big.join(low, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = cut(rest.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
