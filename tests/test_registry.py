"""Set-based registry merges against a plain loop over the sightings."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from duskwatch import schemas
from duskwatch.constants import SOURCES
from duskwatch.operators import registry as R
from duskwatch.operators.skew import heavy_keys, join_counted


def registry_rows(rng, n):
    rows = []
    for i in range(n):
        if rng.random() < 0.6:
            ts = float(1000 + i)
            rows.append({"onion": f"o{i}", "downloaded": rng.random() < 0.5, "ts": ts,
                         **{s: rng.random() < 0.3 for s in SOURCES}})
    return rows


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(7)
    rows = registry_rows(rng, 30)
    # A third of all sightings belong to one address.
    # Offsets restart in every partition of every topic, and later offsets may hold earlier times.
    sightings, used = [], Counter()
    for _ in range(300):
        source, partition = rng.choice(SOURCES), rng.randrange(3)
        onion = "o3" if rng.random() < 0.33 else f"o{rng.randrange(40)}"
        sightings.append((onion, source, float(rng.randrange(500, 1100)), partition, used[source, partition]))
        used[source, partition] += 1
    fetched = {f"o{i}" for i in range(0, 40, 3)}
    registry = spark.createDataFrame(rows, "onion string, downloaded boolean, ts double, " + ", ".join(
        f"{s} boolean" for s in SOURCES)).selectExpr(
            "*", "timestamp_seconds(ts) as download_date", "cast(null as double) as first_identification").select(
                *schemas.REGISTRY.fieldNames())
    return {
        "rows": rows, "sightings": sightings, "fetched": fetched, "registry": registry,
        "s": spark.createDataFrame(sightings, "onion string, source string, ts double, partition int, offset bigint").repartition(4),
        "f": spark.createDataFrame([(x,) for x in fetched], "onion string"),
    }


def state(rows):
    return {r["onion"]: (r["downloaded"], r["ts"], *[r[s] for s in SOURCES]) for r in rows}


def collected(df):
    rows = df.withColumn("when", F.unix_micros("download_date") / 1e6).collect()
    assert len({r["onion"] for r in rows}) == len(rows)
    for r in rows:
        assert r["when"] == r["ts"]
    return state(rows)


def loop_upsert(data):
    table = {r["onion"]: dict(r) for r in data["rows"]}
    log = []
    for onion, source, ts, partition, offset in sorted(data["sightings"], key=lambda s: (s[2], s[1], *s[3:])):
        old = table.get(onion)
        before = old is not None and old["downloaded"]
        now = False
        shown = source
        if not before:
            now = onion in data["fetched"]
            flags = {s: s == source or bool(old and old[s]) for s in SOURCES}
            table[onion] = {"onion": onion, "downloaded": now, "ts": ts, **flags}
        elif old[source]:
            shown = "False"
        else:
            old[source] = True
        log.append((source, partition, offset, onion, old is not None, before, now, shown))
    return state(table.values()), log


def test_upsert_equals_loop(data):
    wanted, _ = loop_upsert(data)
    assert collected(R.upsert_sightings(data["registry"], data["s"], data["f"])) == wanted


def test_upsert_twice_changes_nothing_but_failed_downloads(data):
    once = R.upsert_sightings(data["registry"], data["s"], data["f"])
    assert collected(R.upsert_sightings(once, data["s"], data["f"])) == collected(once)


def test_decision_log_equals_loop(data):
    _, wanted = loop_upsert(data)
    got = R.decision_log(data["registry"], data["s"], data["f"]).collect()
    assert {tuple(r) for r in got} == set(wanted) and len(got) == len(wanted)


def test_merge_all_sources_equals_loop(data):
    table = {r["onion"]: dict(r) for r in data["rows"]}
    counts = {}
    for source in SOURCES:
        total = missing = 0
        for onion, s, ts, *_ in data["sightings"]:
            if s != source:
                continue
            total += 1
            if onion not in table:
                missing += 1
                table[onion] = {"onion": onion, "downloaded": False, "ts": ts, **{x: x == source for x in SOURCES}}
            else:
                row = table[onion]
                row.update({"ts": max(row["ts"], ts), "downloaded": False, source: True})
        counts[source] = (total, missing, total - missing)
    assert collected(R.merge_all_sources(data["registry"], data["s"])) == state(table.values())
    got = {r["source"]: (r["total"], r["missing"], r["present"]) for r in R.merge_counts(data["registry"], data["s"]).collect()}
    assert got == counts


def test_merge_single_source_equals_loop(data):
    table = {r["onion"]: dict(r) for r in data["rows"]}
    for onion, s, ts, *_ in sorted(data["sightings"], key=lambda s: (s[2], s[1], *s[3:])):
        if s == "gateways":
            if onion in table:
                table[onion]["gateways"] = True
            else:
                table[onion] = {"onion": onion, "downloaded": False, "ts": ts, **{x: x == "gateways" for x in SOURCES}}
    assert collected(R.merge_single_source(data["registry"], data["s"], "gateways")) == state(table.values())


def test_first_identification_only_on_existing_rows(data):
    first = {}
    for onion, _, ts, *_ in data["sightings"]:
        first[onion] = min(ts, first.get(onion, ts))
    rows = R.set_first_seen(data["registry"], data["s"]).collect()
    assert {r["onion"] for r in rows} == {r["onion"] for r in data["rows"]}
    assert all(r["first_identification"] == first.get(r["onion"]) for r in rows)


def test_lookup_keeps_every_sighting(data):
    rows = R.lookup_registry(data["s"], data["registry"])
    known = {r["onion"]: r["downloaded"] for r in data["rows"]}
    got = rows.collect()
    assert len(got) == len(data["sightings"])
    assert all(r["downloaded"] == known.get(r["onion"]) for r in got)


def test_duplicate_objects(spark):
    objects = spark.sql("""select 'o' || (id % 7 % 3) as onion, date_add(date'2022-11-01', cast(id % 5 as int)) as dt,
        'p' || lpad(id, 3, '0') as object_name from range(40)""")
    rows = [tuple(r) for r in objects.collect()]
    firsts = {}
    for onion, dt, name in sorted(rows, key=lambda r: (r[1], r[2])):
        firsts.setdefault(onion, name)
    wanted = sorted((o, firsts[o], n) for o, _, n in rows if n != firsts[o])
    assert sorted(tuple(r) for r in R.duplicate_objects(objects).collect()) == wanted


def test_backfills(data, spark):
    objects = spark.createDataFrame(
        [("o1", "2022-11-02", "b"), ("o1", "2022-11-01", "a"), ("new", "2022-11-05", "c"), ("o3", "2022-11-04", "d")],
        "onion string, dt string, object_name string").withColumn("dt", F.to_date("dt"))
    old = {r["onion"]: r for r in data["registry"].collect()}
    filled = {r["onion"]: r for r in R.backfill_from_objects(data["registry"], objects, "onions_farmer").collect()}
    assert set(filled) == set(old) | {"new", "o1", "o3"}
    assert filled["new"]["downloaded"] and filled["new"]["ts"] is None and str(filled["new"]["download_date"]) == "2022-11-05 00:00:00"
    for onion, row in filled.items():
        if onion in ("new", "o1", "o3"):
            assert row["downloaded"] and row["onions_farmer"]
        else:
            assert row == old[onion]
    added = {r["onion"]: r for r in R.backfill_missing(data["registry"], objects).collect()}
    assert added["new"]["ts"] == added["new"]["download_date"].timestamp() - 3600 or added["new"]["ts"] == 1667606400 - 3600
    assert not any(added["new"][s] for s in SOURCES)


@pytest.fixture
def all_partitions(spark):
    """Partitions as they are dealt, without merging small ones."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def rows_per_task(joined):
    found = joined.withColumn("task", F.spark_partition_id()).groupBy("task").agg(F.count("*").alias("n")).collect()
    return sorted(r["n"] for r in found)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("given", [True, False])
def test_join_counted_splits_heavy_keys(spark, all_partitions, how, given):
    # A third of the rows on one key, a third on null.
    rows = spark.range(60_000).selectExpr("case id % 3 when 0 then 7L when 1 then null else id end as k", "id")
    keyed = rows.groupBy("k").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    joined = join_counted(rows, keyed.drop("n"), "k", how, keyed.select("k", "n") if given else None)
    sizes = rows_per_task(joined)
    assert sum(sizes) == (40_000 if how == "inner" else 60_000) and len(sizes) == 8
    assert sizes[-1] <= 2 * sizes[3]
    assert "SortMergeJoin" in joined._jdf.queryExecution().sparkPlan().toString()
    assert joined.where("k = 7").agg(F.count("*"), F.max("low"), F.countDistinct("id")).first() == (20_000, 0, 20_000)
    assert joined.where("k is null and low is not null").count() == 0
    assert joined.columns == ["k", "id", "low"] and joined.distinct().count() == sum(sizes)


def test_heavy_keys_are_few(spark):
    counts = spark.createDataFrame([(f"k{i}", n) for i, n in enumerate([500, 300, 100, 60, 40])], "k string, n bigint")
    assert {tuple(r) for r in heavy_keys(counts, ["k"], 8).collect()} == {("k0", 4), ("k1", 3)}
    assert heavy_keys(counts.limit(0), ["k"], 8).count() == 0


def test_lookup_of_a_hot_address(spark, all_partitions):
    sightings = spark.range(30_000).selectExpr(
        "case when id % 3 = 0 then 'hot' else concat('o', id) end as onion", "'gateways' as source", "cast(id as double) as ts", "0 as partition", "id as offset")
    registry = spark.createDataFrame(
        [("hot", True, None, 1.0, True, False, False, False, None)], schemas.REGISTRY)
    looked = R.lookup_registry(sightings, registry)
    sizes = rows_per_task(looked)
    assert sum(sizes) == 30_000 and sizes[-1] <= 2 * sizes[3]
    assert looked.where("registry_ts = 1.0").count() == 10_000
    log = R.decision_log(registry, sightings, registry.select("onion"))
    sizes = rows_per_task(log)
    assert sum(sizes) == 30_000 and sizes[-1] <= 2 * sizes[3]

