"""Connected components of an edge table, all on Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import cut_lineage


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges (u, v)``; the component is
    its smallest node.  Self links and repeated links do no harm; nulls are
    ignored; no edges give no rows.

    Alternating large and small stars: each round hangs every node under the
    smallest node it knows, so a long chain needs a number of rounds that
    grows with its logarithm.  Every round is written to the shared checkpoint
    folder; the loop ends when a round changes nothing.
    """
    now = cut_lineage(edges.where("u is not null and v is not null and u <> v")
                      .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    seen = _digest(now)
    while seen[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        root = large.groupBy("u").agg(F.min("v").alias("m"))
        under = large.join(root, "u")
        small = (under.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(root.select("u", F.col("m").alias("v"))))
        now = cut_lineage(small.where("u <> v").distinct())
        digest = _digest(now)
        if digest == seen:
            break
        seen = digest
    pairs = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    """Equal for equal edge sets: count and two sums of hashes."""
    r = edges.agg(F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
                  F.sum(F.xxhash64("v", "u").cast("decimal(38,0)")).alias("s")).first()
    return r["n"], r["x"], r["s"]
