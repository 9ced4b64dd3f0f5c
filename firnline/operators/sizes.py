"""How to tell the optimizer the size of an intermediate result."""

from ..session import scratch_dir


def settled(df, name):
    """A small intermediate result written to the shared folder and read back.

    Its size is then known before the join that uses it is planned: below the broadcast
    threshold the other side is not shuffled at all, above it the join shuffles both. Its
    folder goes with the session (see session.scratch_dir).
    """
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
