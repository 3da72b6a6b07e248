"""Connected components of a link table, by rounds of star contraction on DataFrames."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_base(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or the context's checkpoint folder.

    A temporary folder takes its place where none is named and the master is local; elsewhere that is an error.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    return tempfile.mkdtemp(prefix="marlstone-")


def cut(df: DataFrame) -> DataFrame:
    """``df`` computed once and its lineage cut, by a checkpoint in the shared folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_base(df.sparkSession))
    return df.checkpoint()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (long columns a and b): root is the smallest node it reaches.

    Large stars hang every larger neighbour on the smallest one, small stars do so with the smaller
    ones; the two alternate until nothing changes, which takes about log(nodes) rounds. Minima are
    aggregated before they are shuffled and travel back by a join that adaptive execution splits,
    so that a node with very many links needs no task of its own. Nulls and self links are ignored.
    """
    own = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    own = cut(own.where("a > b").distinct())
    seen = None
    while True:
        both = own.unionByName(own.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("low"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        large = large.distinct()
        low = large.groupBy("a").agg(F.min("b").alias("low"))
        small = large.join(low, "a")
        small = small.where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(
            low.select("a", F.col("low").alias("b"))
        )
        own = cut(small.distinct())
        now = own.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
        if now == seen:
            break
        seen = now
    roots = own.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return own.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)
