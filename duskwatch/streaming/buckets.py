"""A table that micro-batches keep up to date: hash buckets of rows, and the rows each batch changed."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class BucketStore:
    """The latest row of every key, in folders ``path/of=<buckets>/bucket=<b>``.

    In a bucket, ``delta=<n>`` holds the rows that batch ``n`` changed and ``full=<n>`` the whole
    bucket after batch ``n``. A batch writes only into the buckets of its keys, and reads only
    these. When ``compact_after`` deltas stand on a full bucket, the bucket is written anew; older
    folders are left to the retention rule of the path. A batch that is run again replaces its
    own folders and reads none of them. ``batch_id`` starts at 0; the table before is batch -1.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: StructType, key: list[str], buckets: int = 64, compact_after: int = 8
    ):
        self.spark, self.root, self.schema, self.key, self.compact_after = spark, path.rstrip("/"), schema, key, compact_after
        stored = [name for name in self._names(self.root) if name.startswith("of=")]
        self.exists = bool(stored)
        self.buckets = int(stored[0].removeprefix("of=")) if stored else buckets  # a store keeps its number
        self.path = f"{self.root}/of={self.buckets}"

    def _names(self, path: str) -> list[str]:
        """Names in a folder: at most a few per bucket and batch, never files of rows."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [status.getPath().getName() for status in system.listStatus(folder)] if system.exists(folder) else []

    def bucket(self):
        """The bucket of a row's key."""
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that hold the keys of some rows."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("bucket")).distinct().collect())

    def _generations(self, bucket: int, before: int) -> tuple[int | None, list[int]]:
        """The newest full folder before a batch and the deltas on top of it."""
        found = {"full": [], "delta": []}
        for name in self._names(f"{self.path}/bucket={bucket}"):
            kind, _, number = name.partition("=")
            if kind in found and int(number) < before:
                found[kind].append(int(number))
        full = max(found["full"], default=None)
        return full, sorted(n for n in found["delta"] if full is None or n > full)

    def state(self, buckets: list[int] | None = None, before: int = 1 << 62) -> DataFrame:
        """The rows of some buckets (all by default) as they stood before a batch."""
        paths = []
        for bucket in range(self.buckets) if buckets is None else buckets:
            full, deltas = self._generations(bucket, before)
            folder = f"{self.path}/bucket={bucket}"
            paths += [f"{folder}/full={full}"] if full is not None else []
            paths += [f"{folder}/delta={n}" for n in deltas]
        names = self.schema.fieldNames()
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        rows = self.spark.read.schema(StructType([*self.schema.fields]).add("batch_id", "long")).parquet(*paths)
        last = rows.groupBy(*self.key).agg(F.max(F.struct("batch_id", *[n for n in names if n not in self.key])).alias("last"))
        return last.select(*self.key, "last.*").select(*names)

    def _put(self, rows: DataFrame, kind: str, batch_id: int) -> None:
        """Write rows into their buckets' folders of a batch; other folders stay as they are."""
        dealt = rows.select(*self.schema.fieldNames(), F.lit(batch_id).cast("bigint").alias("batch_id"),
                            self.bucket().alias("bucket"), F.lit(batch_id).alias(kind))
        dealt.hint("rebalance", "bucket").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            "bucket", kind).parquet(self.path)

    def create(self, rows: DataFrame) -> None:
        """The table before the first batch."""
        self._put(rows, "full", -1)
        self.exists = True

    def apply(self, changed: DataFrame, batch_id: int, buckets: list[int]) -> None:
        """Write the rows that a batch changed; buckets with many deltas are written anew."""
        self._put(changed, "delta", batch_id)
        worn = [b for b in buckets if len(self._generations(b, batch_id + 1)[1]) > self.compact_after]
        if worn:
            self._put(self.state(worn, batch_id + 1), "full", batch_id)
