"""Daily dataset versions as Parquet folders: full versions, deltas on top of them, and their merge."""

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.constants import FIRST_VERSION

CHAIN = "version_date date, parent date, key string"


class VersionStore:
    """Datasets below one folder.

    ``root/dataset/version_date=YYYY-MM-DD`` holds full versions, ``root/deltas/dataset/..`` the
    rows that a version adds to its parent. ``root/chains/dataset/..`` holds one row per version:
    its parent (none for a full version) and the key by which its rows replace older ones. The
    row is written last, so a version that was not finished is not seen.
    """

    def __init__(self, spark: SparkSession, root: str, compact_after: int = 14):
        self.spark, self.root, self.compact_after = spark, root.rstrip("/"), compact_after

    def path(self, dataset: str) -> str:
        return f"{self.root}/{dataset}"

    def _read(self, path: str, schema: str | None = None) -> DataFrame | None:
        """All rows below a folder; None if nothing was written yet. What cannot be read raises."""
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        if not folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(folder):
            return None
        return (self.spark.read.schema(schema) if schema else self.spark.read).parquet(path)

    def _put(self, df: DataFrame, path: str, version: date) -> None:
        """Replace one day's folder; a version without rows has a file with its schema."""
        df.write.mode("overwrite").parquet(f"{path}/version_date={version.isoformat()}")

    def _days(self, path: str, days: list[date]) -> DataFrame:
        """Rows of these days' folders; no other folder is listed."""
        return self.spark.read.option("basePath", path).parquet(*[f"{path}/version_date={d.isoformat()}" for d in days])

    def read_all(self, dataset: str) -> DataFrame | None:
        """The rows of all full versions."""
        return self._read(self.path(dataset))

    def versions(self, dataset: str) -> dict[date, tuple[date | None, str | None]]:
        """Parent and key of every version: a row per day."""
        chain = self._read(f"{self.root}/chains/{dataset}", CHAIN)
        if chain is not None:
            return {r["version_date"]: (r["parent"], r["key"]) for r in chain.collect()}
        stored = self.read_all(dataset)  # a folder of full versions without this record
        return {} if stored is None else {r[0]: (None, None) for r in stored.select("version_date").distinct().collect()}

    def _register(self, dataset: str, version: date, parent: date | None, key: str | None) -> None:
        row = self.spark.createDataFrame([(parent, key)], "parent date, key string")
        self._put(row.coalesce(1), f"{self.root}/chains/{dataset}", version)

    def chain(self, dataset: str, version: date) -> list[date]:
        """The version, its parent and so on, down to a full version."""
        versions, days = self.versions(dataset), [version]
        while versions[days[-1]][0] is not None:
            days.append(versions[days[-1]][0])
        return days

    def newest_before(self, dataset: str, from_date: date, floor: date = FIRST_VERSION) -> date | None:
        return max((v for v in self.versions(dataset) if floor <= v < from_date), default=None)

    def read(self, dataset: str, version: date) -> DataFrame | None:
        """The state of a version: its full version overlaid by the deltas since, merged while reading.

        Only the full version and the deltas on top of it are read. Keys of the deltas are few
        beside the full version: its rows are only matched with them, not regrouped.
        """
        versions = self.versions(dataset)
        if version not in versions:
            return None
        *deltas, base = self.chain(dataset, version)
        rows = self._days(self.path(dataset), [base])
        if deltas:
            changed = self._days(f"{self.root}/deltas/{dataset}", deltas)
            rows, key = rows.unionByName(changed), versions[version][1]
            if key is not None:
                last = changed.groupBy(F.col(key).alias("_key")).agg(F.max("version_date").alias("_last"))
                rows = rows.join(last, (F.col(key) == F.col("_key")) & (F.col("version_date") < F.col("_last")), "left_anti")
        return rows.drop("version_date")

    def delta(self, dataset: str, version: date) -> DataFrame | None:
        """Only the rows that a version added; all rows of a full version."""
        versions = self.versions(dataset)
        if version not in versions:
            return None
        path = self.path(dataset) if versions[version][0] is None else f"{self.root}/deltas/{dataset}"
        return self._days(path, [version]).drop("version_date")

    def latest_before(self, dataset: str, from_date: date) -> DataFrame | None:
        """Rows of the newest version older than ``from_date``; None if there is none."""
        newest = self.newest_before(dataset, from_date)
        return None if newest is None else self.read(dataset, newest)

    def write(self, df: DataFrame, dataset: str, version: date) -> DataFrame:
        """Write one full version, replacing only that day, and return the stored rows."""
        self._put(df, self.path(dataset), version)
        self._register(dataset, version, None, None)
        return self.read(dataset, version)

    def append(self, new: DataFrame, dataset: str, version: date, key: str | None, parent: date | None) -> DataFrame:
        """Write the day's rows on top of ``parent`` and return the version's state.

        With a ``key`` the rows replace those of the same key in older versions; rows with a null
        key replace nothing. Without a ``key`` they are added. Without a parent they are a full
        version. When ``compact_after`` deltas stand on one full version, the state is written as
        a full version too.
        """
        if parent is None:
            return self.write(new, dataset, version)
        if parent >= version:
            raise ValueError(f"version {version} cannot stand on {parent}")
        self._put(new, f"{self.root}/deltas/{dataset}", version)
        self._register(dataset, version, parent, key)
        if len(self.chain(dataset, version)) > self.compact_after:
            return self.compact(dataset, version)
        return self.read(dataset, version)

    def compact(self, dataset: str, version: date) -> DataFrame:
        """Write the state of a version as a full version; later reads start there."""
        state = self.read(dataset, version)
        if len(self.chain(dataset, version)) == 1:
            return state
        return self.write(state, dataset, version)

    def write_stats(self, counts: DataFrame, dataset: str, version: date) -> None:
        """The ``label: value`` lines of a version as a text file."""
        stats_lines(counts).coalesce(1).write.mode("overwrite").text(
            f"{self.root}/stats/{dataset}/{version.isoformat()}")


def eligible_versions(stored: DataFrame, from_date: date | Column, floor: date = FIRST_VERSION) -> DataFrame:
    day = F.col("version_date")
    return stored.where((day >= F.lit(floor)) & (day < F.lit(from_date)))


def latest_version_before(stored: DataFrame, from_date: date) -> DataFrame:
    """Rows of the newest version in ``[first version, from_date)`` as one declarative plan."""
    eligible = eligible_versions(stored, from_date)
    newest = eligible.agg(F.max("version_date").alias("version_date"))  # one row
    return eligible.join(F.broadcast(newest), "version_date")


def merge_versions(old: DataFrame | None, new: DataFrame, key: str) -> DataFrame:
    """Old rows overlaid by new ones; the new row wins per key."""
    if old is None:
        return new
    return old.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new)


def latest_row_per_key(versions: DataFrame, key: str, order: str) -> DataFrame:
    """Last write of every key over all versions, as an aggregate (map-side combined)."""
    rest = [c for c in versions.columns if c not in (key, order)]
    return versions.groupBy(key).agg(F.max(F.struct(order, *rest)).alias("last")).select(key, "last.*")


def stats_lines(counts: DataFrame) -> DataFrame:
    """``label: value`` lines of a counter table ``(metric, value)``; shares keep their fraction."""
    value = F.col("value")
    text = F.when(value == F.floor(value), value.cast("bigint").cast("string")).otherwise(value.cast("string"))
    return counts.select(F.concat("metric", F.lit(": "), text).alias("value"))
