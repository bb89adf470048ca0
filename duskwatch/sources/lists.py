"""Line lists, saved records and sighting tables."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch import constants as C
from duskwatch import schemas
from duskwatch.functions.base import strip_space


def load_line_list(spark: SparkSession, path: str) -> DataFrame:
    """Lines of a text file without surrounding white space."""
    return spark.read.text(path).select(strip_space(F.col("value")).alias("line"))


def bulk_load(spark: SparkSession, path: str, target: str) -> None:
    """Append saved sighting records (JSON lines) to a sighting table."""
    spark.read.schema(schemas.SIGHTING).json(path).write.mode("append").parquet(target)


def union_sightings(tables: dict[str, DataFrame]) -> DataFrame:
    """Address and time of every source's sightings, labelled with the source."""
    parts = [df.select(F.lit(source).alias("source"), "onion", "ts") for source, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def by_source(sightings: DataFrame) -> dict[str, DataFrame]:
    """The sighting collections of one table, one per source."""
    return {s: sightings.where(F.col("coll") == C.COLLECTION_PREFIX + s) for s in C.SOURCES}


def emit_sightings(found: DataFrame, advertiser: Column, ts: Column | None = None) -> DataFrame:
    """Sighting records of found addresses; the time defaults to the run time."""
    now = F.unix_micros(F.current_timestamp()) / F.lit(1e6) if ts is None else ts
    return found.select(advertiser.alias("advertiser"), "onion", now.alias("ts"))
