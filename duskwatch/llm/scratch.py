"""Intermediate tables in the shared folder, dropped as soon as they are not needed."""

import gc

from pyspark.sql import DataFrame

from duskwatch.session import scratch_path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back; then let go of the shuffles that made it.

    Spark removes a finished shuffle's files when the driver has collected its last reference.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._scratch = path
    del df
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    return stored


def discard(*tables: DataFrame) -> None:
    """Remove staged tables that nothing will read again."""
    for table in tables:
        spark = table.sparkSession
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table._scratch)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    mark = "_"
    while any(f"{mark}{name}".lower() in taken for name in names):
        mark += "_"
    return [f"{mark}{name}" for name in names]
