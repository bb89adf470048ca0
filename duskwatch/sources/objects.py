"""Stored pages: scanning by day, decoding, reading and writing partitioned objects."""

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.functions import addresses as A


def scan_date_range(objects: DataFrame, start: date, end: date, include_end: bool = False) -> DataFrame:
    """Objects of the days ``[start, end)``; backfill jobs include the last day.

    ``dt`` is the partition column, so the range prunes folders before any file is opened.
    """
    upper = F.col("dt") <= F.lit(end) if include_end else F.col("dt") < F.lit(end)
    return objects.where((F.col("dt") >= F.lit(start)) & upper)


def day_folders(spark: SparkSession, path: str, start: date, end: date, folder: str) -> list[str]:
    """The folders ``path/{y}/{m}/{d}/folder`` of the days ``[start, end)`` that exist; no other one is listed."""
    days = [start + timedelta(n) for n in range((end - start).days)]
    found = []
    for day in days:
        place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{day.year}/{day.month}/{day.day}/{folder}")
        if place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
            found.append(place.toString())
    return found


def read_object_files(
    spark: SparkSession, path: str, start: date | None = None, end: date | None = None, suffix: str = "html", folder: str = "htmls"
) -> DataFrame:
    """Raw object files below ``path/{y}/{m}/{d}/htmls/`` as ``(object_name, dt, onion, body)``.

    With ``start`` and ``end`` only the folders of the days ``[start, end)`` are listed and read.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{suffix}")
    if start and end:
        paths = day_folders(spark, path, start, end, folder)
        if not paths:
            return spark.createDataFrame([], "object_name string, dt date, onion string, body binary")
        files = files.load(paths)
    else:
        files = files.option("recursiveFileLookup", "true").load(path)
    name = F.regexp_extract("path", rf"(\d+/\d+/\d+/[a-z]+/[^/]+\.{suffix})$", 1)
    return files.select(name.alias("object_name"), F.col("content").alias("body")).select(
        "object_name", A.path_date(F.col("object_name")).alias("dt"),
        A.path_address(F.col("object_name")).alias("onion"), "body")


def decode_utf8(objects: DataFrame) -> DataFrame:
    """Strict UTF-8 decoding: ``html`` and ``bad``, never a sentinel text."""
    return objects.withColumn("bad", ~F.is_valid_utf8(F.col("body").cast("string"))).withColumn(
        "html", F.when(~F.col("bad"), F.col("body").cast("string")))


def write_html_partitioned(objects: DataFrame, path: str) -> None:
    """One folder per day; a day that is written again replaces only itself.

    The rebalance hint gathers a day's rows and splits a busy day into several tasks by size.
    """
    (
        objects.hint("rebalance", "dt")
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").parquet(path)
    )


def write_scans(scans: DataFrame, path: str) -> None:
    """Scan reports ``(dt, onion, report)`` as JSON lines per day."""
    scans.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("dt").json(path)


def parse_object_path(objects: DataFrame) -> DataFrame:
    """Address and day out of the object name, in the general and the fixed-width form."""
    name = F.col("object_name")
    return objects.withColumns({
        "path_onion": A.path_address(name),
        "slice_onion": A.path_address_fixed(name),
        "path_date": A.path_date(name),
    })
