"""One-shot registry jobs."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.constants import FIRST_DAY
from duskwatch.operators import registry as R
from duskwatch.sources.objects import scan_date_range


def coherence_job(objects: DataFrame, registry: DataFrame, today: date, start: date = FIRST_DAY) -> DataFrame:
    """Findings ``(finding, onion, object_name)``: later copies, and addresses the registry misses."""
    scanned = scan_date_range(objects, start, today)
    repeated = R.duplicate_objects(scanned).select(
        F.lit("duplicate").alias("finding"), "onion", F.col("later_object").alias("object_name"))
    missing = R.anti_incoherent(scanned, registry).select(
        F.lit("not registered").alias("finding"), "onion", "object_name")
    return repeated.unionByName(missing)


def downloaded_job(objects: DataFrame, registry: DataFrame, today: date, start: date = FIRST_DAY) -> DataFrame:
    """Registry with ``downloaded`` refreshed from the stored objects, today included."""
    return R.refresh_downloaded(registry, scan_date_range(objects, start, today, include_end=True))
