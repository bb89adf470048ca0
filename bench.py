"""Seconds per headline query, one JSON line on standard output."""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from duskwatch.plans.catalog import QUERIES  # noqa: E402
from duskwatch.session import build_session  # noqa: E402

HEADLINE = [
    "decode_utf8_status", "main_content", "compose_text", "remove_noise", "noise_reasons", "extract_addresses",
    "extract_links", "lookup_registry", "upsert_sightings", "decision_log", "merge_all_sources", "backfill_from_objects",
    "merge_versions", "exact_duplicates", "minhash_signature", "lsh_candidates", "near_groups", "mirror_label",
    "instances_per_unique", "language_top2", "length_histograms", "class_tfidf", "stream_upsert",
    "stream_daily_counts", "download_step", "preprocess_step", "dedup_step", "discover_code", "discover_pages",
    "coherence_job",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executors before the clock
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
