"""A stored index of distinct texts and their near-duplicate groups that grows by each run's new texts.

The index is five flat tables. Only texts that it does not hold yet are signed. Their buckets
are looked up among the stored ones; a stored group that they touch takes part in the component
step as a single node, whatever it holds, and only rows that change are returned.
"""

from dataclasses import dataclass, fields, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.operators import dedup as D
from duskwatch.operators.components import connected_components
from duskwatch.operators.skew import join_counted
from duskwatch.session import materialize
from duskwatch.sources.versions import merge_versions

#: Key by which a later row of a table replaces an earlier one; rows of the others are only added.
KEYS = {"exact": None, "texts": None, "buckets": None, "members": "text_id", "groups": "group_id"}


@dataclass
class NearIndex:
    exact: DataFrame    # (text_key, object_name): every membership of every run
    texts: DataFrame    # (text_id, text_key, object_name, text): one row per distinct text, as first seen
    buckets: DataFrame  # (band, k1, k2, k3, anchor): the least text of every bucket
    members: DataFrame  # (text_id, group_id); a group is named by its least text
    groups: DataFrame   # (group_id, rank, tie, representative, n_members); a merged group has no members

    def overlaid(self, added: "NearIndex") -> "NearIndex":
        """This index with the rows that a run added."""
        return NearIndex(**{
            f.name: merge_versions(getattr(self, f.name), getattr(added, f.name), KEYS[f.name]) if KEYS[f.name]
            else getattr(self, f.name).unionByName(getattr(added, f.name)) for f in fields(self)})

    def near(self) -> DataFrame:
        """``(text_id, group_id, representative, n_members)`` for every text."""
        live = self.groups.where("n_members > 0").select("group_id", "representative", "n_members")
        return join_counted(self.members, live, "group_id", counts=live.select("group_id", F.col("n_members").alias("n")))

    def uniques(self) -> DataFrame:
        """``(representative, n_members)`` of every group."""
        return self.groups.where("n_members > 0").select("representative", "n_members")

    def counted_texts(self) -> DataFrame:
        """The texts with their number of copies over all runs."""
        copies = self.exact.groupBy("text_key").agg(F.count("*").alias("n_copies"))
        return self.texts.hint("merge").join(copies, "text_key").select(*self.texts.columns, "n_copies")


@dataclass
class Extension:
    added: NearIndex    # rows to store, in proportion to the run
    n_fresh: int        # texts not known before
    n_fresh_unique: int  # those of them that represent their group


def numbered(rows: DataFrame, column: str, start: int, name: str) -> DataFrame:
    """``rows``, written once, with consecutive numbers from ``start``.

    Rows are numbered within the partitions that write them; the first number of a partition
    comes from the sizes of those before it, one small row per partition.
    """
    spark = rows.sparkSession
    stored = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), name)
    part = F.shiftright("_row", 33)
    sizes = sorted(stored.groupBy(part.alias("part")).count().collect())
    firsts, total = [], start
    for number, count in sizes:
        firsts.append((number, total))
        total += count
    offsets = F.broadcast(spark.createDataFrame(firsts, "_part bigint, _first bigint"))
    return stored.withColumn("_part", part).join(offsets, "_part").select(
        *rows.columns, (F.col("_first") + F.col("_row").bitwiseAND((1 << 33) - 1)).alias(column))


def _component_edges(signed: DataFrame, touched: DataFrame, index: NearIndex | None) -> DataFrame:
    """Links of fresh texts to the node of each of their buckets: a stored group, or the bucket's first fresh text."""
    if index is not None:
        group_of = index.members.withColumnRenamed("text_id", "anchor")
        known = touched.where("known").join(group_of, "anchor").select(*D.BUCKET, F.col("group_id").alias("node"), "n")
        touched = known.union(touched.where("not known").select(*D.BUCKET, F.col("anchor").alias("node"), "n"))
    else:
        touched = touched.select(*D.BUCKET, F.col("anchor").alias("node"), "n")
    linked = join_counted(signed, touched.drop("n"), D.BUCKET, counts=touched.drop("node"))
    return linked.where("text_id <> node").select(F.col("text_id").alias("u"), F.col("node").alias("v"))


def extend(index: NearIndex | None, preprocessed: DataFrame) -> Extension:
    """What ``preprocessed (object_name, text)`` adds to the index.

    Texts known before only add memberships. A fresh text joins the group of every text it
    shares a bucket with; groups that it links become one, under the least text's name. The
    groups equal those of one run over all texts. Empty texts are left out; of several objects
    of a fresh text the first by name stands for it.
    """
    exact = D.exact_index(preprocessed)
    firsts = D.distinct_texts(preprocessed).select("text_key", "object_name", "text")
    start = 0
    if index is not None:
        firsts = firsts.join(index.texts.select("text_key"), "text_key", "left_anti")
        start = (index.texts.agg(F.max("text_id")).first()[0] or 0) + 1
    fresh = materialize(numbered(firsts, "text_id", start, "fresh_rows").select(
        "text_id", "text_key", "object_name", "text"), "fresh_texts")
    signed = materialize(D.bucket_members(fresh, "text_id"), "fresh_buckets")

    touched = signed.groupBy(*D.BUCKET).agg(F.min("text_id").alias("first"), F.count("*").alias("n"))
    if index is None:
        touched = touched.select(*D.BUCKET, F.col("first").alias("anchor"), F.lit(False).alias("known"), "n")
    else:
        touched = touched.join(index.buckets, D.BUCKET, "left").select(
            *D.BUCKET, F.coalesce("anchor", "first").alias("anchor"), F.col("anchor").isNotNull().alias("known"), "n")
    touched = materialize(touched, "touched_buckets")
    buckets = touched.where("not known").select(*D.BUCKET, "anchor")
    linking = touched.where("known or n > 1")
    placed = materialize(
        connected_components(_component_edges(signed, linking, index).distinct()).withColumnRenamed("node", "text_id"), "placed")

    members = fresh.select("text_id").join(placed, "text_id", "left").select(
        "text_id", F.coalesce("component", "text_id").alias("group_id"))
    facts = members.join(fresh.select(
        "text_id", (-F.length("text")).alias("rank"), F.col("object_name").alias("tie")), "text_id").select(
        "group_id", F.struct("rank", "tie", F.col("text_id").alias("representative")).alias("best"), F.lit(1).cast("long").alias("n"))
    if index is not None:
        # Nodes below the first fresh number are stored groups.
        reached = placed.where(F.col("text_id") < start).select(F.col("text_id").alias("group_id"), "component")
        old = index.groups.where("n_members > 0").join(reached, "group_id")
        facts = facts.union(old.select("component", F.struct("rank", "tie", "representative"), "n_members"))
        moved = materialize(old.where("component <> group_id").select("group_id", "component", F.col("n_members").alias("n")), "moved")
        members = members.union(join_counted(
            index.members, moved.drop("n"), "group_id", counts=moved.drop("component")).select("text_id", "component"))
    groups = facts.groupBy("group_id").agg(F.min("best").alias("best"), F.sum("n").alias("n_members")).select(
        "group_id", "best.*", "n_members")
    if index is not None:
        empty = moved.select("group_id", *[F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in ("rank", "tie", "representative")],
                             F.lit(0).cast("long").alias("n_members"))
        groups = groups.union(empty)
    groups = materialize(groups, "groups")
    counts = groups.agg(F.count_if((F.col("n_members") > 0) & (F.col("representative") >= start))).first()[0]
    added = NearIndex(exact, fresh, buckets, materialize(members, "members"), groups)
    return Extension(added, fresh.count(), counts)


def grown(index: NearIndex | None, added: NearIndex) -> NearIndex:
    """The index after a run."""
    return replace(added) if index is None else index.overlaid(added)
