"""Versions, daily run, pushdown, late rows and replays."""

import json
import os
import random
from datetime import date
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from duskwatch import schemas
from duskwatch.constants import SOURCES
from duskwatch.operators import registry as R
from duskwatch.sources import lists, objects
from duskwatch.sources.versions import VersionStore
from duskwatch.streaming import streams


def plan(df):
    return df._jdf.queryExecution().toString()


def test_store_keeps_days_apart_and_replaces_one_day(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path))
    assert store.latest_before("d", date(2023, 1, 1)) is None
    for day, value in ((date(2022, 11, 1), 0), (date(2022, 11, 20), 1), (date(2022, 11, 25), 2), (date(2022, 11, 20), 3)):
        store.write(spark.createDataFrame([(value,)], "v int"), "d", day)
    assert store.latest_before("d", date(2022, 11, 25)).collect()[0].v == 3
    assert store.latest_before("d", date(2022, 11, 26)).collect()[0].v == 2
    # Versions before the first version day do not count.
    assert store.latest_before("d", date(2022, 11, 15)) is None
    assert store.read_all("d").count() == 3


def test_object_files_round_trip(spark, tmp_path):
    folder = tmp_path / "2022" / "11" / "3" / "htmls"
    folder.mkdir(parents=True)
    (folder / "abc.html").write_bytes(b"<title>x</title>")
    (folder / "bad.html").write_bytes(b"\xff<title>")
    rows = {r["onion"]: r for r in objects.decode_utf8(objects.read_object_files(spark, str(tmp_path))).collect()}
    assert rows["abc"]["dt"] == date(2022, 11, 3) and rows["abc"]["object_name"] == "2022/11/3/htmls/abc.html"
    assert not rows["abc"]["bad"] and rows["bad"]["bad"] and rows["bad"]["html"] is None
    other = tmp_path / "2022" / "12" / "30" / "htmls"
    other.mkdir(parents=True)
    (other / "late.html").write_bytes(b"x")
    days = objects.read_object_files(spark, str(tmp_path), date(2022, 11, 1), date(2022, 12, 1))
    assert {r["onion"] for r in days.collect()} == {"abc", "bad"} and not any("late" in f for f in days.inputFiles())
    assert objects.read_object_files(spark, str(tmp_path), date(2022, 12, 30), date(2022, 12, 31)).count() == 1
    assert objects.read_object_files(spark, str(tmp_path), date(2023, 1, 1), date(2023, 2, 1)).count() == 0


def test_date_range_prunes_partitions_and_registry_scan_prunes_columns(spark, tmp_path):
    df = spark.sql("select 'o' || id as onion, date_add(date'2022-11-01', cast(id as int)) as dt, cast('x' as binary) as body from range(20)")
    objects.write_html_partitioned(df, str(tmp_path / "o"))
    stored = spark.read.parquet(str(tmp_path / "o"))
    scanned = objects.scan_date_range(stored, date(2022, 11, 5), date(2022, 11, 8))
    assert scanned.count() == 3 and objects.scan_date_range(stored, date(2022, 11, 5), date(2022, 11, 8), True).count() == 4
    assert "PartitionFilters: [isnotnull(dt" in plan(scanned)
    spark.createDataFrame([], schemas.REGISTRY).write.parquet(str(tmp_path / "r"))
    text = plan(R.registry_scan(spark.read.parquet(str(tmp_path / "r"))))
    assert "ReadSchema: struct<onion:string,downloaded:boolean>" in text and "EqualTo(downloaded,true)" in text


def test_scans_and_bulk_load(spark, tmp_path):
    scans = spark.sql("select date'2022-11-01' as dt, 'a' as onion, '{}' as report")
    objects.write_scans(scans, str(tmp_path / "s"))
    assert spark.read.json(str(tmp_path / "s")).count() == 1
    (tmp_path / "saved.json").write_text(json.dumps({"advertiser": "x", "onion": "o", "timestamp": 1, "ts": 2.0}))
    for _ in range(2):
        lists.bulk_load(spark, str(tmp_path / "saved.json"), str(tmp_path / "t"))
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2


def message(offset, ts, onion="o1", source="gateways"):
    inner = json.dumps({"onion": onion})
    return {"topic": f"crawlab_test.results_{source}", "partition": offset % 3, "offset": offset // 3, "ts": ts, "value": json.dumps(inner)}


def write_file(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(r) for r in rows))


def test_late_rows_are_dropped(spark, tmp_path):
    """A second run sees the watermark of the first; a row older than it is not counted."""
    day = 86_400.0
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    write_file(source, "a.json", [message(1, 1 * day + 5), message(2, 9 * day)])
    streams.stream_daily_counts(streams.file_stream(spark, str(source)), out, checkpoint, delay="2 days")
    write_file(source, "b.json", [message(3, 1 * day + 9), message(4, 9 * day + 1)])
    streams.stream_daily_counts(streams.file_stream(spark, str(source)), out, checkpoint, delay="2 days")
    got = {str(r["day"]): r["n_sightings"] for r in streams.latest_updates(spark, out, ["day"]).collect()}
    assert got == {"1970-01-02": 1, "1970-01-10": 2}


def test_stream_upsert_continues_and_repeats_change_nothing(spark, tmp_path):
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    start = spark.createDataFrame([], schemas.REGISTRY)
    fetched = spark.createDataFrame([("o1",)], "onion string")
    write_file(source, "a.json", [message(1, 10.0), message(2, 11.0, "o2"), {"topic": "x", "offset": 3, "ts": 1.0, "value": "{bad"}])
    streams.stream_upsert(streams.file_stream(spark, str(source)), start, fetched, out, checkpoint)
    write_file(source, "b.json", [message(4, 20.0, "o1", "onions_farmer"), message(5, 21.0, "o2")])
    streams.stream_upsert(streams.file_stream(spark, str(source)), start, fetched, out, checkpoint)
    streams.stream_upsert(streams.file_stream(spark, str(source)), start, fetched, out, checkpoint)
    rows = {r["onion"]: r for r in streams.latest_registry(spark, out, start).collect()}
    assert rows["o1"]["downloaded"] and rows["o1"]["ts"] == 10.0 and rows["o1"]["onions_farmer"] and rows["o1"]["gateways"]
    assert not rows["o2"]["downloaded"] and rows["o2"]["ts"] == 21.0 and not rows["o2"]["onions_farmer"]
    assert set(rows) == {"o1", "o2"}


def test_daily_run_twice_gives_the_same_version(spark, tmp_path):
    from duskwatch import bridge as B
    from duskwatch.operators import language as L
    from duskwatch.plans.daily import daily_pipeline

    sf = "/root/testdata/sf0.001"
    stored = B.html_objects(spark, sf).persist()
    model = L.train(B.labelled_texts(spark, sf).select("text", "lang"))
    runs = []
    for root in ("a", "a"):
        store = VersionStore(spark, str(tmp_path / root))
        metrics = daily_pipeline(store, stored, model, date(2023, 1, 1), date(2022, 11, 1))
        runs.append(sorted((r["step"], r["metric"], r["value"]) for r in metrics.collect()))
    assert runs[0] == runs[1]
    values = {(s, m): v for s, m, v in runs[0]}
    assert values["download", "Total onions"] == values["download", "Cleaned onions"] + values[
        "download", "Empty onions"] + values["download", "Bad-encoded onions"]
    assert values["deduplicate", "Total onions"] == values["version_deduplicated", "Total onions"]


def test_incremental_dedup_counts_only_new_rows(spark):
    from duskwatch.plans.daily import dedup_step

    words = [" ".join(f"w{i}x{j}" for j in range(30)) for i in range(4)]
    first = spark.createDataFrame([("a", words[0]), ("b", words[1]), ("c", words[1])], "object_name string, text string")
    second = spark.createDataFrame(
        [("d", words[0]), ("e", words[2]), ("f", words[2]), ("g", words[1] + " more"), ("h", "")], "object_name string, text string")
    one = dedup_step(first)
    counts = {r[0]: r[1] for r in one.counts.collect()}
    assert counts == {"Total onions": 3, "Exact mirrors": 1, "Near mirrors": 0, "Unique onions": 2}
    two = dedup_step(second, one.exact, one.texts)
    counts = {r[0]: r[1] for r in two.counts.collect()}
    # d copies a known text, f copies e; g is the longer form of a known text and represents it
    assert counts == {"Total onions": 4, "Exact mirrors": 2, "Near mirrors": 0, "Unique onions": 2}
    assert two.texts.count() == 4 and two.exact.count() == 7
    assert two.texts.agg(F.sum("n_copies")).first()[0] == 7


def test_language_accuracy(spark):
    from duskwatch import bridge as B
    from duskwatch.operators import language as L

    labelled = B.labelled_texts(spark, "/root/testdata/sf0.001")
    model = L.train(labelled.select("text", "lang"))
    top = L.language_top2(model, labelled, "doc_id").join(
        labelled.select("doc_id", L.language_name(F.col("lang")).alias("truth")), "doc_id")
    row = top.agg(F.avg((F.col("first_language") == F.col("truth")).cast("double")).alias("accuracy"),
                  F.count_if(F.col("first_confidence") < F.col("second_confidence")).alias("wrong_order")).first()
    assert row["accuracy"] > 0.9 and row["wrong_order"] == 0


def test_language_of_texts_not_learned_from(spark):
    from duskwatch import bridge as B
    from duskwatch.operators import language as L

    labelled = B.labelled_texts(spark, "/root/testdata/sf0.01")
    learn, rest = labelled.where("doc_id % 3 <> 1"), labelled.where("doc_id % 3 = 1")
    days = [L.language_counts(learn.where(f"doc_id % 2 = {d}")) for d in (0, 1)]
    model = L.fit(L.added_counts(*days), size=5000)
    assert model.weights.count() == 5000 and model.languages == ["de", "en", "es", "fr"]
    top = L.language_top2(model, rest, "doc_id").join(rest.select("doc_id", L.language_name(F.col("lang")).alias("truth")), "doc_id")
    assert top.count() == rest.count() and top.agg(F.avg((F.col("first_language") == F.col("truth")).cast("double"))).first()[0] > 0.95


def test_language_of_texts_without_known_words(spark):
    from duskwatch.operators import language as L

    texts = spark.createDataFrame(
        [(1, "the cat", "en"), (2, "the dog", "en"), (3, "die katze", "de"), (4, "1 2", None)], "doc_id int, text string, lang string")
    model = L.train(texts)
    odd = spark.createDataFrame([(1, ""), (2, None), (3, "12 漢"), (4, "katze"), (5, "die the")], "doc_id int, text string")
    rows = {r["doc_id"]: r for r in L.language_top2(model, odd, "doc_id").collect()}
    assert [rows[i]["first_language"] for i in range(1, 6)] == ["English", "English", "English", "German", "English"]
    assert rows[1]["first_confidence"] == pytest.approx(2 / 3) and rows[1]["second_language"] == "German"
    assert L.language_top2(model, odd.limit(0), "doc_id").count() == 0
    nothing = L.language_top2(L.train(texts.limit(0)), odd, "doc_id").collect()
    assert {r["first_language"] for r in nothing} == {None} and len(nothing) == 5


def test_language_scores_in_pieces_equal_a_loop(spark, monkeypatch):
    """Pieces shorter than a text; one id in two rows, no words, null; grams of short and long words."""
    import math
    import re

    from duskwatch.operators import language as L

    learned = [("a bb ccc dddd the theme", "en"), ("die katze a été ñandú bb", "de"), ("the the bb", "en"), ("x", None)]
    odd = [(1, "The theory a a zz"), (1, "katze été"), (2, None), (3, "7 ."), (4, "ññ bbb " * 9), (5, "qqq")]

    def grams(text):
        return [g for w in re.findall(r"[^\W\d_]+", (text or "").lower()) for g in (w, "^" + w[:3], w[-3:] + "$")]

    monkeypatch.setattr(L, "PIECE", 12)  # four words
    model = L.train(spark.createDataFrame(learned, "text string, lang string"))
    counts = {}
    for text, lang in learned:
        for gram in grams(text) if lang else []:
            counts[lang, gram] = counts.get((lang, gram), 0) + 1
    assert {(r["lang"], r["gram"]): r["n"] for r in model.counts.where("gram <> ''").collect()} == counts
    assert {r["lang"]: r["n"] for r in model.counts.where("gram = ''").collect()} == {"en": 2, "de": 1}
    known = {gram for _, gram in counts}
    wanted = {}
    for i, text in odd:
        for k, lang in enumerate(model.languages):
            row = wanted.setdefault(i, list(model.priors))
            row[k] += sum(round(math.log(counts.get((lang, g), 0) + 1) * L.UNIT) - model.costs[k] for g in grams(text) if g in known)
    table = spark.createDataFrame(odd, "doc_id int, text string").coalesce(1)
    assert {r["doc_id"]: list(r["scores"]) for r in L.language_scores(model, table, "doc_id").collect()} == wanted


def test_grams_are_made_of_distinct_words(spark):
    """The second count takes three rows per distinct word, not three per word of the texts."""
    from duskwatch.operators import language as L

    texts = spark.range(4000).selectExpr("repeat('one two three ', 5) as text", "'en' as lang").coalesce(1)
    plan = L.language_counts(texts)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and plan.index("Aggregate [") < plan.index("Generate explode") < plan.rindex("Aggregate [")
    assert {r["gram"]: r["n"] for r in L.language_counts(texts).collect()} == {"": 4000} | dict.fromkeys(
        ["one", "two", "three", "^one", "^two", "^thr", "one$", "two$", "ree$"], 20000)


def test_topics_of_clear_clusters(spark):
    import random

    from duskwatch.operators.topics import topic_model

    rng = random.Random(1)
    rows = [(i, [10.0 * (i % 3 == j) + rng.random() for j in range(3)]) for i in range(60)] + [(99, None), (98, [1.0, None, 2.0])]
    df = spark.createDataFrame(rows, "vec_id int, embedding array<float>")
    got = {r["vec_id"]: r["topic"] for r in topic_model(df, 3).collect()}
    assert got == {i: i % 3 for i in range(60)} == {r["vec_id"]: r["topic"] for r in topic_model(df.repartition(5), 3).collect()}
    assert topic_model(df.limit(0), 3).count() == 0


def test_reach_walks_no_page_twice(spark):
    """Links that run in circles, a page with many links, pages that nothing reaches."""
    from duskwatch.operators.crawl import depth_limited_reach

    edges = [(i, (i + 1) % 5) for i in range(5)] + [(0, i) for i in range(10, 200)] + [(i, 300) for i in range(10, 200)] + [
        (300, 301), (301, 302), (302, 300), (400, 401), (None, 1), (1, None)]
    links = spark.createDataFrame(edges, "src int, dst int")
    starts = spark.createDataFrame([(0,), (0,), (None,)], "page int")
    for depth in (0, 1, 3, 50):
        wanted, layer = {0: 0}, {0}
        for d in range(1, depth + 1):
            layer = {b for a, b in edges if a in layer and b is not None} - set(wanted)
            wanted |= dict.fromkeys(layer, d)
        found = depth_limited_reach(links, starts, depth)
        assert dict(map(tuple, found.collect())) == wanted and found.count() == len(wanted)
        assert "Join" not in plan(found)


def test_unreadable_store_is_not_an_empty_one(spark, tmp_path):
    from pyspark.errors import AnalysisException

    store = VersionStore(spark, str(tmp_path))
    assert store.read_all("absent") is None
    (tmp_path / "broken" / "version_date=2022-12-01").mkdir(parents=True)
    with pytest.raises(AnalysisException):
        store.read_all("broken")


def test_stats_keep_fractions(spark):
    from duskwatch.sources.versions import stats_lines

    counts = spark.createDataFrame([("all", 3.0), ("share", 66.67)], "metric string, value double")
    assert sorted(r[0] for r in stats_lines(counts).collect()) == ["all: 3", "share: 66.67"]


def overlaid(versions):
    """Rows of the versions taken one after another: a version's rows replace those of the same key."""
    rows = []
    for new in versions:
        keys = {k for k, _ in new if k is not None}
        rows = [r for r in rows if r[0] not in keys] + new
    return sorted(rows, key=str)


def test_deltas_equal_a_loop_and_are_as_large_as_the_day(spark, tmp_path):
    import random

    rng = random.Random(4)
    store, days = VersionStore(spark, str(tmp_path), compact_after=3), []
    for i in range(7):
        new = [(rng.choice([None, *"abcdefghij"]), f"{i}.{j}") for j in range(rng.randrange(0, 7))]
        day, rows = date(2022, 12, 1 + i), spark.createDataFrame(new, "k string, v string")
        parent = store.newest_before("d", day)
        state = store.append(rows, "d", day, "k", parent)
        days.append(new)
        assert sorted(map(tuple, state.collect()), key=str) == overlaid(days)
        # Every third delta is followed by a full version.
        full = i % 3 == 0
        assert (store.versions("d")[day][0] is None) == full
        assert len(store.chain("d", day)) == (1 if full else 1 + i % 3)
        if not full:
            assert store.delta("d", day).count() == len(new)
    # A day that is run again replaces itself; later versions still stand on it or on what it stood on.
    again = [("a", "again")]
    state = store.append(spark.createDataFrame(again, "k string, v string"), "d", date(2022, 12, 6), "k", date(2022, 12, 5))
    assert sorted(map(tuple, state.collect()), key=str) == overlaid([*days[:5], again])
    # The full version of the seventh day does not change.
    assert sorted(map(tuple, store.read("d", date(2022, 12, 7)).collect()), key=str) == overlaid(days)
    assert store.latest_before("d", date(2022, 12, 4)).count() == len(overlaid(days[:3]))
    compacted = store.compact("d", date(2022, 12, 6))
    assert store.versions("d")[date(2022, 12, 6)][0] is None
    assert sorted(map(tuple, compacted.collect()), key=str) == overlaid([*days[:5], again])


def test_state_reads_only_its_own_folders(spark, tmp_path):
    store = VersionStore(spark, str(tmp_path))
    for i in range(5):
        rows = spark.range(10 * i, 10 * i + 15).selectExpr("id as k", f"{i} as v")
        (store.write if i == 2 else lambda r, d, v: store.append(r, d, v, "k", store.newest_before("d", v)))(rows, "d", date(2022, 12, 1 + i))
    state = store.read("d", date(2022, 12, 5))
    assert {f.split("version_date=")[1][:10] for f in state.inputFiles()} == {"2022-12-03", "2022-12-04", "2022-12-05"}
    assert state.count() == 35 and state.where("v = 2").count() == 10
    with pytest.raises(ValueError):
        store.append(rows, "d", date(2022, 12, 1), "k", date(2022, 12, 5))


def near_texts(seed=6):
    """Texts of two days: copies over days, new groups, texts that join one old group and texts that link two."""
    import random

    rng = random.Random(seed)
    bases = [[f"w{rng.randrange(400)}" for _ in range(30)] for _ in range(20)]
    days = [[], []]
    for i, base in enumerate(bases):
        for day in days:
            for _ in range(rng.randrange(4)):
                near = list(base)
                near[rng.randrange(30)] = f"x{rng.randrange(50)}"
                day.append(" ".join(near))
        days[rng.randrange(2)].append(" ".join(base))
        if i % 2 == 0:  # two texts of the first day, and one half way between them on the second
            days[0] += [" ".join(base), " ".join([f"y{i}.{k}" for k in range(12)] + base[12:])]
            days[1].append(" ".join([f"y{i}.{k}" for k in range(6)] + base[6:]))
    days[1] += days[0][:5] + days[1][:3] + [""]
    names = iter(range(10_000))
    return [[(f"o{next(names):05d}", t) for t in day] for day in days]


def index_groups(spark, index):
    """Texts by group, and every group's text with its size."""
    rows = index.near().join(index.texts, "text_id").collect()
    by_id = {r["text_id"]: r["text"] for r in rows}
    groups = {}
    for r in rows:
        groups.setdefault(r["group_id"], set()).add(r["text"])
        assert r["group_id"] <= r["text_id"]
    return {(frozenset(groups[r["group_id"]]), by_id[r["representative"]], r["n_members"]) for r in rows}


def test_two_days_sign_only_new_texts_and_equal_one_run(spark, tmp_path, monkeypatch):
    from duskwatch.operators import dedup as D
    from duskwatch.plans import daily

    signed, original = [], D.bucket_members
    monkeypatch.setattr(D, "bucket_members", lambda texts, key: signed.append(texts.count()) or original(texts, key))
    for seed in (6, 7):
        first, second = (spark.createDataFrame(rows, "object_name string, text string") for rows in near_texts(seed))
        signed.clear()
        whole = daily.dedup_step(first.union(second))
        store = VersionStore(spark, str(tmp_path / str(seed)))
        one = daily.dedup_step(first, index=daily.stored_index(store, date(2022, 12, 1)))
        daily.version_dedup_step(store, one, date(2022, 12, 1))
        two = daily.dedup_step(second, index=daily.stored_index(store, date(2022, 12, 2)))
        unique = daily.version_dedup_step(store, two, date(2022, 12, 2))
        old, new = ({t for _, t in rows if t} for rows in near_texts(seed))
        assert signed == [len(old | new), len(old), len(new - old)]
        stored = daily.stored_index(store, date(2022, 12, 3))
        wanted = index_groups(spark, whole.index)
        assert index_groups(spark, stored) == index_groups(spark, two.index) == wanted
        assert {(r["text"], r["n_members"]) for r in unique.rows.collect()} == {(t, n) for _, t, n in wanted}
        # Some group of the first day was merged, and only changed rows were written.
        assert stored.groups.where("n_members = 0").count() > 0
        assert store.delta("near_index_texts", date(2022, 12, 2)).count() == len(new - old)
        assert store.delta("near_index_members", date(2022, 12, 2)).count() < len(old | new)
        counts, total = ({r[0]: r[1] for r in c.collect()} for c in (unique.counts, daily.version_dedup_step(
            VersionStore(spark, str(tmp_path / f"{seed}w")), whole, date(2022, 12, 2)).counts))
        assert counts == total


def test_text_numbers_do_not_change(spark, tmp_path):
    from duskwatch.plans import daily

    first, second = (spark.createDataFrame(rows, "object_name string, text string") for rows in near_texts())
    store = VersionStore(spark, str(tmp_path))
    numbers = []
    for day, rows in ((1, first), (2, second), (3, second.limit(0))):
        step = daily.dedup_step(rows, index=daily.stored_index(store, date(2022, 12, day)))
        daily.version_dedup_step(store, step, date(2022, 12, day))
        numbers.append({r["text_key"]: r["text_id"] for r in daily.stored_index(store, date(2022, 12, day + 1)).texts.collect()})
    assert numbers[0].items() <= numbers[1].items() == numbers[2].items()
    assert sorted(numbers[2].values()) == list(range(len(numbers[2])))


def object_event(name):
    return {"page_id": 1, "value": json.dumps({"EventName": "s3:ObjectCreated:Put", "Key": f"onions/{name}", "Records": [{"eventTime": "t"}]})}


@pytest.fixture
def stored_pages(spark, tmp_path):
    """Pages of four days; the folders of two days cannot be read."""
    rows = [(f"2022/11/{d}/htmls/o{i}.html", date(2022, 11, d), f"<title>{d} {i}</title>".encode()) for d in range(1, 5) for i in range(3)]
    schema = "object_name string, dt date, body binary"
    objects.write_html_partitioned(spark.createDataFrame(rows, schema), str(tmp_path / "objects"))
    for day in (1, 4):
        for file in (tmp_path / "objects" / f"dt=2022-11-0{day}").glob("*.parquet"):
            file.write_bytes(b"not a file of pages")
    for crc in (tmp_path / "objects").rglob(".*.crc"):
        crc.unlink()
    return spark.read.schema(schema).parquet(str(tmp_path / "objects"))


def test_object_join_reads_only_the_days_of_the_events(spark, stored_pages):
    from duskwatch.sources import messages

    names = ["2022/11/2/htmls/o1.html", "2022/11/3/htmls/o0.html", "2022/11/3/htmls/o0.html", "2022/11/2/htmls/absent.html", "no/day", "2022/13/40/htmls/o1.html"]
    events = spark.createDataFrame([tuple(object_event(n).values()) for n in names] + [(1, "{bad"), (1, None)], "page_id int, value string")
    found = messages.object_key_join(events, stored_pages)
    assert "dynamicpruning" in plan(found).lower()
    assert sorted(r["object_name"] for r in found.collect()) == sorted(names[:3])
    assert set(found.columns) == {"page_id", "event_name", "object_name", "event_time", "body"}
    with pytest.raises(Exception, match="not a Parquet file|FAILED_READ_FILE"):
        stored_pages.select("object_name").collect()  # all days


def test_stream_enriches_from_the_days_of_each_batch(spark, tmp_path, stored_pages):
    source, out = tmp_path / "events", str(tmp_path / "enriched")
    write_file(source, "a.json", [object_event("2022/11/2/htmls/o1.html"), {"page_id": 2, "value": "{bad"}])
    write_file(source, "b.json", [object_event("2022/11/3/htmls/o2.html")])
    events = streams.file_stream(spark, str(source), "page_id int, value string")
    streams.stream_page_enrich(events, stored_pages, out, str(tmp_path / "cp"))
    assert {(r["object_name"], r["title"]) for r in spark.read.parquet(out).collect()} == {
        ("2022/11/2/htmls/o1.html", "2 1"), ("2022/11/3/htmls/o2.html", "3 2")}
    batch = spark.createDataFrame([tuple(object_event("2022/11/2/htmls/o1.html").values())], "page_id int, value string")
    assert "dt#" in plan(streams.enrich_batch(batch, stored_pages)) and "2022-11-02" in plan(streams.enrich_batch(batch, stored_pages))


def folders(path):
    """Every file of rows below a store with its time of writing."""
    return {str(f.relative_to(path)): f.stat().st_mtime_ns for f in path.rglob("*.parquet")}


def test_registry_in_buckets_equals_one_merge(spark, tmp_path):
    """Four batches equal one merge in the order of time; a small fifth one leaves all other buckets as they are."""
    import random

    rng = random.Random(9)
    rows = [(f"o{i}", i % 2 == 0, None, 1.0, True, False, False, False, None) for i in range(0, 60, 2)]
    start = spark.createDataFrame(rows, schemas.REGISTRY)
    fetched = spark.createDataFrame([(f"o{i}",) for i in range(0, 90, 4)], "onion string")
    sources = ("onions_farmer", "ioc_repositories", "gateways", "code_repositories")
    sent = [message(i, 10.0 + i, f"o{rng.randrange(90)}", rng.choice(sources)) for i in range(200)]
    source, out, checkpoint = tmp_path / "in", tmp_path / "out", str(tmp_path / "cp")

    def run():
        streams.stream_upsert(streams.file_stream(spark, str(source)), start, fetched, str(out), checkpoint, buckets=16, compact_after=2)
        return {r["onion"]: tuple(r) for r in streams.latest_registry(spark, str(out), start).collect()}

    for i in range(4):
        write_file(source, f"{i}.json", sent[50 * i:50 * i + 50])
        got = run()
        decoded = streams.M.decode_sightings(spark.createDataFrame([tuple(m.values()) for m in sent[:50 * i + 50]], schemas.MESSAGE))
        assert got == {r["onion"]: tuple(r) for r in R.upsert_sightings(start, decoded, fetched).collect()}
    before = folders(out)
    assert any("full=2" in f or "full=3" in f for f in before)  # worn buckets were written anew
    write_file(source, "4.json", [message(900, 900.0, "o1", "gateways")])
    got = run()
    assert got["o1"][6]
    new = {f for f, t in folders(out).items() if before.get(f) != t}
    assert before.items() <= folders(out).items()
    store = streams.registry_store(spark, str(out))
    bucket = store.touched(spark.createDataFrame([("o1",)], "onion string"))
    assert new and {f.split("bucket=")[1].split("/")[0] for f in new} == {str(bucket[0])}
    assert store.buckets == 16 and len(got) == len(run())


def test_batch_that_runs_again_replaces_itself(spark, tmp_path):
    store = streams.BucketStore(spark, str(tmp_path / "s"), streams.PAIR, ["onion", "source"], buckets=4, compact_after=1)
    assert not store.exists and store.state().count() == 0

    def pairs(*names):
        return spark.createDataFrame([(n, "x") for n in names], "onion string, source string")

    store.create(pairs("a", "b"))
    for n, names in ((0, "cd"), (1, "de"), (1, "df"), (2, "g")):
        rows = pairs(*names)
        store.apply(rows, n, store.touched(rows))
    found = {r["onion"] for r in store.state().collect()}
    assert found == set("abcdfg") or found == set("abcdefg")  # e only where its bucket has no row of the second try
    assert {r["onion"] for r in store.state(before=1).collect()} == set("abcd")


def state_rows(spark, checkpoint, **options):
    return spark.read.format("statestore").options(**options).load(checkpoint).count()


def test_late_repeats_stay_out_and_the_state_shrinks(spark, tmp_path):
    day = 86_400.0
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")
    batches = [
        [message(i, day + i, f"o{i}") for i in range(30)] + [message(31, day, "o1")],
        [message(40, 20 * day, "o1"), message(41, 20 * day, "o1", "ioc_repositories"), message(42, 20 * day, "new")],
        [message(50, 40 * day, "o1"), message(51, 40 * day, "o2"), message(52, 40 * day, "o3"), message(53, day, "o4")],
        [message(60, 60 * day, "o3")],
    ]
    for i, batch in enumerate(batches):
        write_file(source, f"{i}.json", batch)
        streams.stream_dedupe_source(streams.file_stream(spark, str(source)), out, checkpoint, delay="2 days", buckets=4)
        if i == 0:
            assert state_rows(spark, checkpoint) == 30
    stored = [tuple(r) for r in spark.read.schema(streams.PAIR).option("recursiveFileLookup", "true").parquet(out).collect()]
    got = [tuple(r) for r in streams.seen_pairs(spark, out).collect()]
    assert sorted(got) == sorted({(f"o{i}", "gateways") for i in range(30)} | {("o1", "ioc_repositories"), ("new", "gateways")})
    assert len(stored) == len(set(stored))  # no pair was written twice
    assert state_rows(spark, checkpoint) <= 4


def test_seen_state_expires(spark, tmp_path):
    day = 86_400.0
    source, out, checkpoint = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "cp")

    def run(name, *rows):
        write_file(source, name, rows)
        streams.stream_seen_state(streams.file_stream(spark, str(source)), out, checkpoint, delay="1 day", keep_days=5)
        return {r["onion"]: r for r in streams.latest_updates(spark, out, ["onion"]).collect()}

    got = run("a.json", message(1, 2 * day), message(2, day, source="onions_farmer"), message(3, 2 * day, "o2"))
    assert (got["o1"]["first_ts"], got["o1"]["last_ts"]) == (day, 2 * day)
    assert got["o1"]["gateways"] and got["o1"]["onions_farmer"] and not got["o1"]["ioc_repositories"] and not got["o1"]["expired"]
    got = run("b.json", message(4, 5 * day, "o2", "ioc_repositories"))
    assert got["o2"]["last_ts"] == 5 * day and got["o2"]["ioc_repositories"] and got["o2"]["gateways"]
    got = run("c.json", message(5, 9 * day, "o3"))
    got = run("d.json", message(6, 9 * day + 1, "o3"))
    assert got["o1"]["expired"] and not got["o2"]["expired"] and not got["o3"]["expired"]
    got = run("e.json", message(7, 9 * day + 2, "o1"))  # it comes back as a new address
    assert (got["o1"]["first_ts"], got["o1"]["gateways"], got["o1"]["onions_farmer"], got["o1"]["expired"]) == (9 * day + 2, True, False, False)


class StateStore:
    """A slot's state and timers as the store would keep them; counts the calls."""

    def __init__(self):
        self.value, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        return self

    def get(self):
        self.calls += 1
        return self.value

    def update(self, value):
        self.calls, self.value = self.calls + 1, value

    def clear(self):
        self.calls, self.value = self.calls + 1, None

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)

    def deleteTimer(self, at):
        self.calls += 1
        self.timers.remove(at)


def test_seen_state_calls_the_store_per_slot_not_per_address():
    store, state = StateStore(), streams.SeenState(5_000)
    state.init(store)

    def meet(ts):
        part = pd.DataFrame({"onion": [f"o{i}" for i in range(300)], "ts": [ts + i for i in range(300)], "sources": 1})
        return pd.concat(state.handleInputRows((7,), iter([part, part]), None))

    def expire(now):
        at = min(store.timers)
        got = list(state.handleExpiredTimer((7,), SimpleNamespace(getCurrentWatermarkInMs=lambda: now),
                                            SimpleNamespace(getExpiryTimeInMs=lambda: at)))
        store.timers.remove(at)  # Spark does so afterwards
        return {onion for rows in got for onion in rows["onion"]}

    assert len(meet(10)) == 300 and store.calls <= 3 and store.timers == {15_000}
    assert set(meet(20)["first_ts"] - meet(20)["last_ts"]) == {-10.0} and store.calls <= 10 and store.timers == {15_000}
    assert expire(24_999) == set() and store.timers == {25_000}  # seen since
    assert expire(27_000) == {"o0", "o1", "o2"} and store.timers == {28_000}
    assert len(expire(10**9)) == 297 and store.value is None and not store.timers and store.calls <= 17


def test_seen_state_of_shared_slots_equals_a_loop(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(streams, "SEEN_SLOTS", 3)
    day, delay, keep, rng = 86_400.0, 1, 2, random.Random(3)
    expected, states, watermark, latest = [], {}, 0.0, 0.0

    def row(batch, onion, expired):
        first, last, sources = states[onion]
        return (batch, onion, first, last, *[s in sources for s in SOURCES], expired)

    def expire(batch):
        for onion in [o for o, s in states.items() if s[1] + keep * day <= watermark]:
            expected.append(row(batch, onion, True))
            del states[onion]

    for batch in range(9):
        rows = [((2 * batch + rng.randrange(3)) * day / 2 + day, f"o{rng.randrange(60)}", rng.choice(SOURCES)) for _ in range(12)]
        write_file(tmp_path / "in", f"{batch}.json", [message(i, *r) for i, r in enumerate(rows)])
        os.utime(tmp_path / "in" / f"{batch}.json", (1e9 + batch, 1e9 + batch))
        for ts, onion, source in rows:
            first, last, sources = states.get(onion, (ts, ts, set()))
            states[onion] = min(first, ts), max(last, ts), sources | {source}
        expected += [row(batch, onion, False) for onion in {r[1] for r in rows}]
        expire(batch)
        latest = max([latest, *[r[0] for r in rows]])
        watermark = latest - delay * day
    expire(9)  # in a batch without rows, as the watermark has moved
    out = str(tmp_path / "out")
    streams.stream_seen_state(
        streams.file_stream(spark, str(tmp_path / "in")), out, str(tmp_path / "cp"), delay=f"{delay} day", keep_days=keep)
    got = spark.read.parquet(out).select("batch_id", "onion", "first_ts", "last_ts", *SOURCES, "expired").collect()
    assert sorted(map(tuple, got)) == sorted(expected)
    assert sum(r["expired"] for r in got) > 20
    assert state_rows(spark, str(tmp_path / "cp"), stateVarName="slot") <= 3


def test_seen_state_without_a_known_time(spark, tmp_path):
    write_file(tmp_path / "in", "a.json", [message(1, None), message(2, None, "o2"), message(3, 5.0, "o2", "ioc_repositories")])
    streams.stream_seen_state(streams.file_stream(spark, str(tmp_path / "in")), str(tmp_path / "out"), str(tmp_path / "cp"))
    got = {r["onion"]: r for r in streams.latest_updates(spark, str(tmp_path / "out"), ["onion"]).collect()}
    assert (got["o1"]["first_ts"], got["o1"]["last_ts"], got["o1"]["gateways"]) == (None, None, True)
    assert (got["o2"]["first_ts"], got["o2"]["last_ts"], got["o2"]["gateways"], got["o2"]["ioc_repositories"]) == (5.0, 5.0, True, True)


def test_state_partitions_are_a_few_per_core_and_the_setting_stays(spark):
    name, cores = "spark.sql.shuffle.partitions", spark.sparkContext.defaultParallelism
    before = spark.conf.get(name)
    assert streams.state_partitions(spark) == int(before)  # fewer stay as they are
    try:
        spark.conf.set(name, "5000")
        assert streams.state_partitions(spark) == max(32, 4 * cores)
        with streams.rocksdb_state(spark, streams.state_partitions(spark)):
            assert spark.conf.get(name) == str(max(32, 4 * cores))
        assert spark.conf.get(name) == "5000"
    finally:
        spark.conf.set(name, before)
