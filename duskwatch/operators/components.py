"""Connected components of an edge table."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from duskwatch.operators.skew import join_counted
from duskwatch.session import materialize


def _with_minimum(directed: DataFrame) -> DataFrame:
    """Edges ``(u, v)`` with ``m``, the least of ``u`` and its neighbours in ``directed``."""
    least = directed.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    return join_counted(directed, least.select("u", F.least("u", "m").alias("m")), "u", counts=least)


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(u, v)``; the component is its least node.

    Alternating large-star and small-star steps turn every component into a star around
    its least node in a logarithmic number of rounds; they end when a round changes nothing.
    A step is an aggregate per node and a salted join back, at every size; a node that a third
    of the edges meet is dealt over many tasks. Each round is written to shared storage, which
    cuts the lineage and survives lost executors.
    """
    def normal(df: DataFrame) -> DataFrame:
        return df.where("u <> v").select(F.least("u", "v").alias("v"), F.greatest("u", "v").alias("u"))

    def settle(df: DataFrame) -> tuple[DataFrame, tuple]:
        """Materialize the edges; their fingerprint is taken while they are written."""
        seen = Observation()
        stored = materialize(normal(df).distinct().observe(
            seen, F.count("*").alias("n"), F.bit_xor(F.xxhash64("u", "v")).alias("x"),
            F.sum(F.hash("u", "v").cast("decimal(38,0)")).alias("s")), "components")
        return stored, tuple(sorted(seen.get.items(), key=lambda kv: kv[0]))

    current, state = settle(edges)  # u is always the greater node
    while True:
        both = current.select("u", "v").union(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = _with_minimum(normal(large))
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            small.select("u", F.col("m").alias("v")))
        previous = state
        current, state = settle(small)
        if state == previous:
            break
    members = current.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.union(roots)
