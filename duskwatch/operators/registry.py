"""The address registry: lookups, merges, repairs.

A registry holds one row per address. Sightings may hold a third of their rows on one
address, so they are always aggregated per address (map-side combined) before they meet
the registry, and per-sighting answers use :func:`join_counted`.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.constants import SOURCES
from duskwatch.operators.skew import join_counted
from duskwatch.schemas import REGISTRY

COLUMNS = REGISTRY.fieldNames()
#: Total order of sightings. Offsets restart in every partition of every topic, a topic carries one source.
ORDER = ("ts", "source", "partition", "offset")


def lookup_registry(sightings: DataFrame, registry: DataFrame) -> DataFrame:
    """Each sighting with its registry row, or nulls."""
    sizes = sightings.groupBy("onion").agg(F.count("*").alias("n_sightings"))
    found = sizes.join(registry.withColumnRenamed("ts", "registry_ts"), "onion", "left")
    return join_counted(
        sightings, found, "onion", counts=sizes.withColumnRenamed("n_sightings", "n")).drop("n_sightings")


def anti_incoherent(objects: DataFrame, registry: DataFrame) -> DataFrame:
    """Addresses with a stored object that the registry does not list as downloaded."""
    return first_object(objects).join(registry.where("downloaded").select("onion"), "onion", "left_anti")


def refresh_downloaded(registry: DataFrame, objects: DataFrame) -> DataFrame:
    """Set ``downloaded`` of every row to whether an object exists."""
    stored = objects.select("onion").distinct().withColumn("stored", F.lit(True))
    return (
        registry.join(stored, "onion", "left")
        .withColumn("downloaded", F.coalesce("stored", F.lit(False)))
        .select(*COLUMNS)
    )


def _flag(name: str, column: str | Column = "source") -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column == name


def _seen_flags() -> list[Column]:
    return [F.bool_or(_flag(s)).alias(f"new_{s}") for s in SOURCES]


def _merged_flags(old: str = "old", new: str = "new_") -> list[Column]:
    return [
        (F.coalesce(F.col(f"{old}.{s}"), F.lit(False)) | F.coalesce(F.col(f"{new}{s}"), F.lit(False))).alias(s)
        for s in SOURCES
    ]


def _date(ts: Column) -> Column:
    return F.timestamp_micros(F.round(ts * 1_000_000).cast("bigint"))


def upsert_sightings(registry: DataFrame, sightings: DataFrame, fetched: DataFrame) -> DataFrame:
    """Apply a batch of sightings ``(onion, source, ts)`` to the registry.

    ``fetched`` lists the addresses whose page could be stored. The outcome equals taking
    the sightings in the order of time: a downloaded row only gains source flags; any other
    address is tried at each sighting until it is stored.
    """
    batch = sightings.groupBy("onion").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), *_seen_flags())
    stored = fetched.select("onion").distinct().withColumn("stored", F.lit(True))
    batch = batch.join(stored, "onion", "left").withColumn("stored", F.coalesce("stored", F.lit(False)))
    merged = registry.alias("old").join(batch.alias("b"), "onion", "full_outer")
    keep = F.col("first_ts").isNull() | F.coalesce(F.col("old.downloaded"), F.lit(False))
    ts = F.when(keep, F.col("old.ts")).when(F.col("stored"), F.col("first_ts")).otherwise(F.col("last_ts"))
    return merged.select(
        "onion",
        F.when(keep, F.col("old.downloaded")).otherwise(F.col("stored")).alias("downloaded"),
        F.when(keep, F.col("old.download_date")).otherwise(_date(ts)).alias("download_date"),
        ts.alias("ts"),
        *_merged_flags(),
        F.col("old.first_identification").alias("first_identification"),
    )


def decision_log(
    registry: DataFrame, sightings: DataFrame, fetched: DataFrame
) -> DataFrame:
    """What happens to each sighting when they are taken in the order of time, topic, partition and offset."""
    place = F.struct(*ORDER)
    firsts = sightings.groupBy("onion").agg(
        F.count("*").alias("n_sightings"),
        F.min(place).alias("first"),
        *[F.min(F.when(_flag(s), place)).alias(f"first_{s}") for s in SOURCES],
    )
    stored = fetched.select("onion").distinct().withColumn("stored", F.lit(True))
    known = firsts.join(stored, "onion", "left").join(
        registry.select("onion", F.lit(True).alias("known"), F.col("downloaded").alias("was_downloaded"), *SOURCES),
        "onion", "left")
    rows = join_counted(sightings, known, "onion", counts=firsts.withColumnRenamed("n_sightings", "n"))
    earlier = place > F.col("first")
    old_flag, first_of_source = F.lit(False), F.lit(None)
    for s in SOURCES:
        old_flag = F.when(_flag(s), F.coalesce(F.col(s), F.lit(False))).otherwise(old_flag)
        first_of_source = F.when(_flag(s), F.col(f"first_{s}")).otherwise(first_of_source)
    rows = rows.select(
        "partition", "offset", "onion", "source",
        (F.coalesce("known", F.lit(False)) | earlier).alias("seen_before"),
        (F.coalesce("was_downloaded", F.lit(False)) | (F.coalesce("stored", F.lit(False)) & earlier))
        .alias("downloaded_before"),
        F.coalesce("stored", F.lit(False)).alias("stored"),
        (old_flag | (place > first_of_source)).alias("flag_before"),
    )
    return rows.select(
        F.col("source").alias("listed_by"), "partition", "offset", "onion", "seen_before", "downloaded_before",
        (~F.col("downloaded_before") & F.col("stored")).alias("downloaded_now"),
        F.when(F.col("downloaded_before") & F.col("flag_before"), "False").otherwise(F.col("source")).alias("source"),
    )


def merge_single_source(registry: DataFrame, sightings: DataFrame, source: str) -> DataFrame:
    """Insert addresses the registry lacks with their first sighting; flag the others."""
    batch = sightings.where(_flag(source)).groupBy("onion").agg(F.min("ts").alias("new_ts"))
    merged = registry.alias("old").join(batch, "onion", "full_outer")
    known, sighted = F.col("old.downloaded").isNotNull(), F.col("new_ts").isNotNull()
    return merged.select(
        "onion",
        F.when(known, F.col("old.downloaded")).otherwise(F.lit(False)).alias("downloaded"),
        F.when(known, F.col("old.download_date")).otherwise(_date(F.col("new_ts"))).alias("download_date"),
        F.when(known, F.col("old.ts")).otherwise(F.col("new_ts")).alias("ts"),
        *[
            (F.coalesce(F.col(f"old.{s}"), F.lit(False)) | (sighted if s == source else F.lit(False))).alias(s)
            for s in SOURCES
        ],
        F.col("old.first_identification").alias("first_identification"),
    )


def merge_all_sources(registry: DataFrame, sightings: DataFrame) -> DataFrame:
    """Merge the sightings of all sources: newest time wins, sighted rows need a new download."""
    batch = sightings.groupBy("onion").agg(F.max("ts").alias("new_ts"), *_seen_flags())
    merged = registry.alias("old").join(batch, "onion", "full_outer")
    sighted = F.col("new_ts").isNotNull()
    ts = F.greatest(F.col("old.ts"), F.col("new_ts"))
    return merged.select(
        "onion",
        F.when(sighted, F.lit(False)).otherwise(F.col("old.downloaded")).alias("downloaded"),
        F.when(sighted, _date(ts)).otherwise(F.col("old.download_date")).alias("download_date"),
        ts.alias("ts"),
        *_merged_flags(),
        F.col("old.first_identification").alias("first_identification"),
    )


def first_identification(sightings: DataFrame) -> DataFrame:
    """Earliest sighting of each address over all sources."""
    return sightings.groupBy("onion").agg(F.min("ts").alias("first_identification"))


def set_first_seen(registry: DataFrame, sightings: DataFrame) -> DataFrame:
    """Store the earliest sighting on existing rows; no row is added."""
    seen = first_identification(sightings).withColumnRenamed("first_identification", "seen")
    return (
        registry.join(seen, "onion", "left")
        .withColumn("first_identification", F.coalesce("seen", "first_identification"))
        .select(*COLUMNS)
    )


def first_object(objects: DataFrame) -> DataFrame:
    """First stored object of each address, by day and then by name."""
    return (
        objects.groupBy("onion").agg(F.min(F.struct("dt", "object_name")).alias("first"))
        .select("onion", "first.dt", "first.object_name")
    )


def backfill_from_objects(registry: DataFrame, objects: DataFrame, source: str) -> DataFrame:
    """Complete missing or not downloaded rows from the first object of each address."""
    merged = registry.alias("old").join(first_object(objects).alias("o"), "onion", "full_outer")
    has_object = F.col("o.dt").isNotNull()
    fill = has_object & ~F.coalesce(F.col("old.downloaded"), F.lit(False))
    return merged.select(
        "onion",
        F.when(fill, F.lit(True)).otherwise(F.col("old.downloaded")).alias("downloaded"),
        F.when(fill, F.col("o.dt").cast("timestamp")).otherwise(F.col("old.download_date")).alias("download_date"),
        F.col("old.ts").alias("ts"),
        *[
            (F.coalesce(F.col(f"old.{s}"), F.lit(False)) | (has_object if s == source else F.lit(False))).alias(s)
            for s in SOURCES
        ],
        F.col("old.first_identification").alias("first_identification"),
    )


def _hour_before(when: Column) -> Column:
    return F.unix_micros(when - F.expr("interval 1 hour")) / F.lit(1e6)


def backfill_missing(registry: DataFrame, objects: DataFrame) -> DataFrame:
    """Add a downloaded row without source for every stored address the registry lacks."""
    day = F.col("dt").cast("timestamp")
    added = (
        first_object(objects).join(registry.select("onion"), "onion", "left_anti")
        .select(
            "onion", F.lit(True).alias("downloaded"), day.alias("download_date"), _hour_before(day).alias("ts"),
            *[F.lit(False).alias(s) for s in SOURCES], F.lit(None).cast("double").alias("first_identification"),
        )
    )
    return registry.unionByName(added)


def recompute_timestamp(registry: DataFrame) -> DataFrame:
    """Set every row's time to one hour before its download date."""
    return registry.withColumn("ts", _hour_before(F.col("download_date")))


def registry_scan(registry: DataFrame) -> DataFrame:
    """Downloaded addresses only; filter and projection reach the Parquet scan."""
    return registry.where("downloaded").select("onion")


def duplicate_objects(objects: DataFrame) -> DataFrame:
    """Objects of an address after its first one, each with the first one's name."""
    firsts = objects.groupBy("onion").agg(
        F.min(F.struct("dt", "object_name")).alias("first"), F.count("*").alias("n_objects")).where("n_objects > 1")
    return (
        join_counted(
            objects.select("onion", "dt", "object_name"), firsts, "onion", counts=firsts.withColumnRenamed("n_objects", "n"))
        .where(F.struct("dt", "object_name") != F.col("first"))
        .select("onion", F.col("first.object_name").alias("first_object"), F.col("object_name").alias("later_object"))
    )


def merge_counts(registry: DataFrame, sightings: DataFrame) -> DataFrame:
    """Per source: sightings, those new to the registry, those already present.

    Sources are merged one after the other, so an address counts as new only for the
    first of them, and only once.
    """
    order = F.lit(None).cast("int")
    for i, s in enumerate(SOURCES):
        order = F.when(_flag(s), F.lit(i)).otherwise(order)
    totals = sightings.groupBy("source").agg(F.count("*").alias("total"))
    new = (
        sightings.groupBy("onion").agg(F.min(order).alias("first_source"))
        .join(registry.select("onion"), "onion", "left_anti")
        .groupBy("first_source").agg(F.count("*").alias("new"))
        .select(F.get(F.array(*[F.lit(s) for s in SOURCES]), F.col("first_source")).alias("source"), "new")
    )
    return totals.join(new, "source", "left").select(
        "source", "total", F.coalesce("new", F.lit(0)).alias("missing"),
        (F.col("total") - F.coalesce("new", F.lit(0))).alias("present"))
