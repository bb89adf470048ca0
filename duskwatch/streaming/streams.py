"""Streaming forms of the sighting, enrichment and counting jobs.

Every job is at-least-once with idempotent writes: a micro-batch writes only below its own
batch number, so a replay replaces itself. Checkpoints belong into shared storage.
"""

import math
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from duskwatch import schemas
from duskwatch.constants import SOURCES, TOPIC_PREFIX
from duskwatch.operators.pages import page_enrich
from duskwatch.operators.registry import upsert_sightings
from duskwatch.sources import messages as M
from duskwatch.streaming.buckets import BucketStore

TOPICS = tuple(f"{TOPIC_PREFIX}results_{s}" for s in SOURCES)


def kafka_sightings(spark: SparkSession, servers: str, max_offsets: int, topics: tuple[str, ...] = TOPICS) -> DataFrame:
    """Sighting messages from the first offset on. Needs Spark's Kafka connector on the class path."""
    return (
        spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
        .option("subscribe", ",".join(topics)).option("startingOffsets", "earliest")
        .option("maxOffsetsPerTrigger", max_offsets).load()
        .select("topic", "partition", "offset", (F.unix_micros("timestamp") / F.lit(1e6)).alias("ts"), F.col("value").cast("string"))
    )


def file_stream(spark: SparkSession, path: str, schema: StructType = schemas.MESSAGE, files: int = 1) -> DataFrame:
    """Messages from JSON files, a few files per trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).json(path)


def drain(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process everything available now, batch by batch, and stop."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def rocksdb_state(spark: SparkSession, partitions: int | None = None):
    """Streams started here keep their state in RocksDB: on local disk, not on the executor's heap.

    A new stream deals its state over ``partitions``; one that goes on keeps the number of its checkpoint.
    """
    settings = {"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    if partitions:
        settings["spark.sql.shuffle.partitions"] = str(partitions)
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def state_partitions(spark: SparkSession) -> int:
    """No more state partitions than a few per core: every batch loads, runs and commits each of them, however small."""
    return min(int(spark.conf.get("spark.sql.shuffle.partitions")), max(32, 4 * spark.sparkContext.defaultParallelism))


def _batch_writer(path: str, name: str = "batch_id"):
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/{name}={batch_id}")

    return write


def stream_to_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append rows of a stateless or deduplicating stream."""
    drain(stream.writeStream.format("parquet").outputMode("append").option("path", path), checkpoint)


def stream_sightings(messages: DataFrame, path: str, checkpoint: str) -> None:
    """Decoded sightings of all topics."""
    stream_to_files(M.decode_sightings(messages), path, checkpoint)


def registry_store(spark: SparkSession, path: str, **options: int) -> BucketStore:
    return BucketStore(spark, path, schemas.REGISTRY, ["onion"], **options)


def stream_upsert(
    messages: DataFrame, registry: DataFrame, fetched: DataFrame, path: str, checkpoint: str, **options: int
) -> None:
    """Merge each micro-batch into the registry below ``path``, which starts as ``registry``.

    A batch reads the buckets of its addresses, merges the rows of these addresses only, and
    writes only them. Messages of one address must come in the order of time over batches.
    """
    store = registry_store(messages.sparkSession, path, **options)
    if not store.exists:
        store.create(registry)

    def merge(batch: DataFrame, batch_id: int) -> None:
        batch = M.decode_sightings(batch).persist()
        buckets = store.touched(batch)
        if buckets:
            before = store.state(buckets, batch_id).join(batch.select("onion").distinct(), "onion", "left_semi")
            store.apply(upsert_sightings(before, batch, fetched), batch_id, buckets)
        batch.unpersist()

    drain(messages.writeStream.foreachBatch(merge), checkpoint)


def latest_registry(spark: SparkSession, path: str, registry: DataFrame) -> DataFrame:
    """The registry after the last micro-batch; the initial one before any."""
    store = registry_store(spark, path)
    return store.state() if store.exists else registry


def stream_quarantine(messages: DataFrame, good: str, bad: str, checkpoint: str) -> None:
    """Decoded sightings to one sink, unreadable messages with the reason to another."""
    def split(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        _batch_writer(good)(M.decode_sightings(batch), batch_id)
        _batch_writer(bad)(M.quarantine(batch), batch_id)
        batch.unpersist()

    drain(messages.writeStream.foreachBatch(split), checkpoint)


def enrich_batch(events: DataFrame, objects: DataFrame) -> DataFrame:
    """One micro-batch of object events with their pages, read from the folders of the batch's days only."""
    return page_enrich(events, objects.where(F.col("dt").isin(M.event_days(events))))


def stream_page_enrich(events: DataFrame, objects: DataFrame, path: str, checkpoint: str) -> None:
    """Object events joined with the stored pages: title and description.

    The days of a micro-batch are known before its join is planned, so they are literals there.
    """
    def enrich(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        _batch_writer(path)(enrich_batch(batch, objects), batch_id)
        batch.unpersist()

    drain(events.writeStream.foreachBatch(enrich), checkpoint)


PAIR = StructType().add("onion", "string").add("source", "string")


def event_time(ts: str = "ts"):
    return F.timestamp_micros((F.col(ts) * 1_000_000).cast("bigint"))


def stream_dedupe_source(messages: DataFrame, path: str, checkpoint: str, delay: str = "40 days", **options: int) -> None:
    """Each address once per source, in a table of pairs below ``path``.

    The stream's state drops repeats within ``delay`` of event time and forgets a pair after it;
    sightings later than that are dropped. A pair that comes again after it was forgotten meets
    the stored pairs of its bucket. So the state holds no more than ``delay`` of pairs, on the
    state store's disk, and the table every pair once.
    """
    store = BucketStore(messages.sparkSession, path, PAIR, ["onion", "source"], **options)
    pairs = M.decode_sightings(messages).select("onion", "source", event_time().alias("event_time"))
    pairs = pairs.withWatermark("event_time", delay).dropDuplicatesWithinWatermark(["onion", "source"]).drop("event_time")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch = batch.distinct().persist()
        buckets = store.touched(batch)
        if buckets:
            store.apply(batch.join(store.state(buckets, batch_id), ["onion", "source"], "left_anti"), batch_id, buckets)
        batch.unpersist()

    with rocksdb_state(messages.sparkSession):
        drain(pairs.writeStream.outputMode("append").foreachBatch(keep), checkpoint)


def seen_pairs(spark: SparkSession, path: str) -> DataFrame:
    """The pairs that :func:`stream_dedupe_source` has stored."""
    return BucketStore(spark, path, PAIR, ["onion", "source"]).state()


def _stream_updates(rows: DataFrame, path: str, checkpoint: str) -> None:
    drain(rows.writeStream.outputMode("update").foreachBatch(_batch_writer(path)), checkpoint)


def latest_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Last emitted row of each key."""
    rows = spark.read.parquet(path)
    values = [c for c in rows.columns if c not in (*keys, "batch_id")]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch_id").alias("last")).select(*keys, "last.*")


#: Slots of addresses that share one stored value. It is part of the state's keys, so a checkpoint needs the same number.
SEEN_SLOTS = 1024
UNKNOWN = (math.inf, -math.inf, 0)  # first and last time and sources, before any


class SeenState(StatefulProcessor):
    """Per address its first and last time and its sources, until it was not seen for ``keep_ms`` of event time.

    The addresses of a slot come as one group and are stored as one value: calls to the state store
    and data frames, which take longer than hundreds of addresses, are per slot. A batch reads
    and writes the slots of its addresses only. A slot has one timer, at the least end of its addresses
    or before: it stays where it is when they are seen again, and is set anew when it is due.
    ``sources`` has a bit per source.
    """

    def __init__(self, keep_ms: int):
        self.keep_ms = keep_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slot = handle.getValueState(
            "slot", "onions array<string>, first_ts array<double>, last_ts array<double>, sources array<int>, timer bigint")

    def _load(self) -> tuple[dict[str, tuple], int | None]:
        onions, first, last, sources, timer = self.slot.get() or ((), (), (), (), None)
        return dict(zip(onions, zip(first, last, sources, strict=True), strict=True)), timer

    def _store(self, states: dict[str, tuple], timer: int | None) -> None:
        first, last, sources = zip(*states.values(), strict=True)
        self.slot.update((list(states), list(first), list(last), list(sources), timer))

    def _end(self, state: tuple) -> float:
        """When an address is forgotten; never without a known time."""
        return int(state[1] * 1000) + self.keep_ms if state[1] > -math.inf else math.inf

    def _set_timer(self, ends: Iterable[float], timer: int | None = None) -> int | None:
        """The slot's timer, moved to the least of ``ends`` if that is earlier."""
        least = min(ends, default=math.inf)
        if least >= (math.inf if timer is None else timer):
            return timer
        if timer is not None:
            self.handle.deleteTimer(timer)
        self.handle.registerTimer(least)
        return least

    def _rows(self, states: dict[str, tuple], expired: bool) -> Iterator[pd.DataFrame]:
        if states:
            first, last, sources = zip(*states.values(), strict=True)
            rows = pd.DataFrame({"onion": list(states), "first_ts": first, "last_ts": last, "sources": sources, "expired": expired})
            yield rows.replace([math.inf, -math.inf], math.nan) if math.inf in first else rows

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        states, timer = self._load()
        met = set()
        for part in rows:
            for onion, ts, bit in zip(part["onion"].tolist(), part["ts"].tolist(), part["sources"].tolist(), strict=True):
                first, last, bits = states.get(onion, UNKNOWN)
                # A time that is not known is less than none and greater than none.
                states[onion] = (ts if ts < first else first, ts if ts > last else last, bits | bit)
                met.add(onion)
        met = {onion: states[onion] for onion in met}
        self._store(states, self._set_timer(map(self._end, met.values()), timer))
        yield from self._rows(met, False)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        states, now = self._load()[0], timerValues.getCurrentWatermarkInMs()
        gone = {onion: state for onion, state in states.items() if self._end(state) <= now}
        left = {onion: state for onion, state in states.items() if onion not in gone}
        if left:
            self._store(left, self._set_timer(map(self._end, left.values())))
        else:
            self.slot.clear()
        yield from self._rows(gone, True)

    def close(self) -> None:
        pass


def stream_seen_state(messages: DataFrame, path: str, checkpoint: str, delay: str = "40 days", keep_days: int = 400) -> None:
    """State per address: first and last time, the sources that listed it, and whether it has expired.

    A state of its own kind on the RocksDB store: it ends ``keep_days`` of event time after the
    address was last seen, with one last row that says so, and begins anew if it comes back. A
    batch's rows of a slot of addresses are read in Arrow batches, one after another. Sightings
    later than ``delay`` are dropped.
    """
    rows = M.decode_sightings(messages).withColumn("event_time", event_time()).withWatermark("event_time", delay)
    slot = F.pmod(F.xxhash64("onion"), F.lit(SEEN_SLOTS)).cast("int").alias("slot")
    bits = sum((F.when(F.col("source") == s, 1 << i).otherwise(0) for i, s in enumerate(SOURCES)), F.lit(0))
    state = rows.select(slot, "onion", "event_time", "ts", bits.alias("sources")).groupBy("slot").transformWithStateInPandas(
        SeenState(keep_days * 86_400_000), outputMode="Update", timeMode="EventTime",
        outputStructType="onion string, first_ts double, last_ts double, sources int, expired boolean")
    flags = [(F.col("sources").bitwiseAND(1 << i) != 0).alias(s) for i, s in enumerate(SOURCES)]
    spark = messages.sparkSession
    with rocksdb_state(spark, state_partitions(spark)):
        _stream_updates(state.select("onion", "first_ts", "last_ts", *flags, "expired"), path, checkpoint)


def stream_daily_counts(messages: DataFrame, path: str, checkpoint: str, delay: str = "40 days") -> None:
    """Sightings per day of event time; rows later than ``delay`` are dropped."""
    rows = M.decode_sightings(messages).withColumn("event_time", event_time())
    counts = rows.withWatermark("event_time", delay).groupBy(F.window("event_time", "1 day").alias("w")).agg(
        F.count("*").alias("n_sightings"))
    _stream_updates(counts.select(F.to_date("w.start").alias("day"), "n_sightings"), path, checkpoint)


def stream_cdc(changes: DataFrame, path: str, checkpoint: str) -> None:
    """Full documents of the wanted collections from a change stream."""
    stream_to_files(M.cdc_filter(changes), path, checkpoint)
