"""Joins that stay balanced when one key holds a large share of the rows."""

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

#: A key is split if it holds more than this part of an average partition.
PARTS_PER_PARTITION = 16


def heavy_keys(counts: DataFrame, on: list[str], parts: int) -> DataFrame:
    """``(key, _salts)`` of the keys with more than one ``parts``-th of all rows: fewer than ``parts`` rows.

    ``counts`` has one row per key with its number of rows ``n``; ``_salts`` is how many
    ``parts``-ths the key fills. One job finds the largest keys and the total.
    """
    spark, seen = counts.sparkSession, Observation()
    counts = counts.select(*on, "n").observe(seen, F.sum("n").alias("total"))
    largest = counts.orderBy(F.desc("n")).limit(parts).collect()
    total = seen.get["total"]
    found = [(*row[:-1], -(-row["n"] * parts // total)) for row in largest if row["n"] * parts > total]
    schema = StructType([*[counts.schema[key] for key in on]]).add("_salts", IntegerType())
    if not found:  # a list made here would start Python workers, in every round of every join
        return spark.range(0).select(*[F.lit(None).cast(field.dataType).alias(field.name) for field in schema])
    return spark.createDataFrame(found, schema)


def join_counted(
    rows: DataFrame, keyed: DataFrame, on: str | list[str], how: str = "inner", counts: DataFrame | None = None
) -> DataFrame:
    """Join many ``rows`` per key with one ``keyed`` row per key, by one plan at every size.

    A sort-merge join on the key and a salt. A key gets as many salts as its own number of
    rows asks for: its keyed row is repeated once per salt, its rows are dealt over them by
    a hash of the row. So no task gets much more than its share, whatever a key holds, and
    only the keyed rows of heavy keys are repeated. Neither side is broadcast; the list of
    heavy keys is, which has fewer rows than 16 times the number of shuffle partitions.

    ``counts`` has one row per key with its number of ``rows`` in ``n``; without it they
    are counted. Either is computed once more to find the heavy keys. ``how`` is ``inner``
    or ``left``; a null key matches nothing, its rows are dealt like those of a heavy key.
    Rows that are equal in all columns share a salt.
    """
    on = [on] if isinstance(on, str) else list(on)
    if counts is None:
        counts = rows.groupBy(*on).agg(F.count("*").alias("n"))
    parts = PARTS_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    unknown = F.lit(False)
    for key in on:
        unknown = unknown | F.col(key).isNull()
    heavy = F.broadcast(heavy_keys(counts.where(~unknown), on, parts))
    salts = F.when(unknown, F.lit(parts)).otherwise(F.coalesce("_salts", F.lit(1)))
    dealt = rows.withColumn("_hash", F.xxhash64(*rows.columns)).join(heavy, on, "left").withColumn(
        "_salt", F.pmod("_hash", salts).cast("int")).select(*rows.columns, "_salt")
    repeated = keyed.join(heavy, on, "left").withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return dealt.hint("merge").join(repeated, [*on, "_salt"], how).drop("_salt")
