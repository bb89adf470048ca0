"""Change-stream documents, sighting messages and object events."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch import constants as C
from duskwatch import schemas
from duskwatch.functions import addresses as A

COLLECTIONS = tuple(C.COLLECTION_PREFIX + s for s in C.SOURCES)


def cdc_filter(changes: DataFrame, collections: tuple[str, ...] = COLLECTIONS) -> DataFrame:
    """Full documents of the wanted collections from JSON change events in ``value``."""
    parsed = changes.withColumn("change", F.from_json("value", schemas.CHANGE_EVENT))
    return parsed.where(F.col("change.ns.coll").isin(*collections)).select(
        *[c for c in changes.columns if c != "value"], F.col("change.ns.coll").alias("coll"), "change.fullDocument.*")


def decode_messages(messages: DataFrame) -> DataFrame:
    """Decode the twice-encoded ``value``: ``status`` is ``ok``, ``no_address`` or ``undecodable``."""
    inner = F.get_json_object(F.col("value").cast("string"), "$")
    decoded = messages.withColumn("inner", inner).withColumn("onion", F.get_json_object("inner", "$.onion"))
    decodable = F.get_json_object("inner", "$").isNotNull()
    return decoded.withColumn(
        "status",
        F.when(F.col("onion").isNotNull(), "ok").when(decodable, "no_address").otherwise("undecodable"),
    ).drop("inner")


def decode_sightings(messages: DataFrame) -> DataFrame:
    """Decodable sightings with their source."""
    return decode_messages(messages).where("status = 'ok'").withColumn(
        "source", A.source_from_topic(F.col("topic"))).drop("status", "value", "topic")


def quarantine(messages: DataFrame) -> DataFrame:
    """Messages set aside because no address could be read, with the reason."""
    return decode_messages(messages).where("status <> 'ok'").drop("onion")


def decode_object_events(events: DataFrame) -> DataFrame:
    """Event name, object path and first record time; undecodable events have no path."""
    parsed = events.withColumn("event", F.from_json(F.col("value").cast("string"), schemas.OBJECT_EVENT))
    return parsed.select(
        *[c for c in events.columns if c != "value"],
        F.col("event.EventName").alias("event_name"),
        A.event_object_name(F.col("event.Key")).alias("object_name"),
        F.get(F.col("event.Records"), F.lit(0))["eventTime"].alias("event_time"),
    )


def dated_object_events(events: DataFrame) -> DataFrame:
    """Decoded events of stored pages with the day ``object_dt`` that their object's name tells."""
    decoded = decode_object_events(events).where(F.col("object_name").rlike(r"^/?\d+/\d+/\d+/"))
    return decoded.withColumn("object_dt", A.path_date(F.col("object_name"))).where("object_dt is not null")


def event_days(events: DataFrame) -> list[date]:
    """The days of the objects that some events name: at most one per day of the calendar."""
    return sorted(r[0] for r in dated_object_events(events).select("object_dt").distinct().collect())


def object_key_join(events: DataFrame, objects: DataFrame) -> DataFrame:
    """Each decoded event with the body of its object.

    ``objects`` are stored in folders per ``dt``, the day in their name, so only the folders of
    the events' days are read: the days, one row each, filter the partitions while the query runs.
    The join itself is on day and name.
    """
    dated = dated_object_events(events)
    days = F.broadcast(dated.select(F.col("object_dt").alias("dt")).distinct())
    stored = objects.select("dt", "object_name", "body").join(days, "dt", "left_semi")
    return dated.join(stored.withColumnRenamed("dt", "object_dt"), ["object_dt", "object_name"]).drop("object_dt")
