"""Signatures, groups and counters against brute force on small inputs."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from duskwatch.constants import LSH_BANDS, LSH_ROWS
from duskwatch.operators import dedup as D
from duskwatch.operators.components import _with_minimum, connected_components

WORDS = [f"w{i}" for i in range(200)]


def make_texts():
    rng = random.Random(3)
    texts = []
    for i in range(40):
        base = rng.sample(WORDS, 40)
        texts.append(" ".join(base))
        if i % 2:
            for _ in range(i % 5):
                near = list(base)
                near[rng.randrange(40)] = "changed"
                texts.append(" ".join(near))
    return texts + texts[:10] + [texts[0]] * 20 + ["", " \n "]


@pytest.fixture(scope="module")
def texts(spark):
    rows = list(enumerate(make_texts()))
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


def signature(text, size):
    hashes = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) % D.PRIME for t in set(text.split())]
    return [min(((a * h + b) % D.PRIME for h in hashes), default=D.PRIME)
            for a, b in (D.permutation(i) for i in range(size))]


def firsts(rows):
    seen = {}
    for i, t in rows:
        if t != "":
            seen.setdefault(t, i)
    return {i: t for t, i in seen.items()}


def brute_groups(rows):
    items = firsts(rows)
    parent = {i: i for i in items}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    buckets = {}
    for i, t in items.items():
        sig = signature(t, LSH_BANDS * LSH_ROWS)
        for b in range(LSH_BANDS):
            key = (b, *sig[b * LSH_ROWS:(b + 1) * LSH_ROWS])
            if key in buckets:
                x, y = find(i), find(buckets[key])
                parent[max(x, y)] = min(x, y)
            else:
                buckets[key] = i
    return {i: find(i) for i in items}


def test_signature_equals_brute_force(texts):
    rows, df = texts
    got = {r[0]: list(r[1]) for r in D.signatures(df, "doc_id", 128).collect()}
    assert got == {i: signature(t, 128) for i, t in rows}


def test_signature_in_pieces_hashes_a_word_once(spark, monkeypatch):
    """Texts longer than a piece, without words and null; a piece hashes each of its words once."""
    monkeypatch.setattr(D, "PIECE", 7)
    rows = [(0, " ".join(WORDS[:30])), (1, None), (2, ""), (3, "w1 w1 w2"), (4, "w1"), (5, " ".join(WORDS[25:60]))]
    df = spark.createDataFrame(rows, "doc_id int, text string").coalesce(1)
    assert {r[0]: list(r[1]) for r in D.signatures(df, "doc_id", 10).collect()} == {i: signature(t or "", 10) for i, t in rows}
    monkeypatch.setattr(D, "PIECE", 1 << 16)
    import pyarrow as pa

    hashed = []
    monkeypatch.setattr(D.hashlib, "md5", lambda word, md5=hashlib.md5: hashed.append(word) or md5(word))
    sign = D._signature_udf(5).func
    hashed.clear()
    sign(pa.array([["a", "b"], ["b", "c"], None, ["a", "b", "c"]]))
    assert sorted(hashed) == [b"a", b"b", b"c"]


def test_groups_equal_brute_force(texts):
    rows, df = texts
    distinct = D.distinct_texts(df, "doc_id")
    got = dict(tuple(r) for r in D.near_groups(distinct, "doc_id").collect())
    assert got == brute_groups(rows)


def test_representatives_and_counts(texts):
    rows, df = texts
    distinct = D.distinct_texts(df, "doc_id").persist()
    near = D.near_table(D.near_groups(distinct, "doc_id"), distinct, "doc_id").persist()
    groups, items = brute_groups(rows), firsts(rows)
    for r in near.collect():
        members = [i for i, g in groups.items() if g == groups[r["doc_id"]]]
        best = min(members, key=lambda i: (-len(items[i]), i))
        assert (r["group_id"], r["representative"], r["n_members"]) == (min(members), best, len(members))
    index = D.exact_index(df, "doc_id")
    labels = {r[0]: r[1] for r in D.mirror_labels(index, near, "doc_id").collect()}
    assert set(labels) == {i for i, t in rows if t != ""}
    assert all((labels[i] == "exact mirror") == (i not in items) for i in labels)
    counts = {r[0]: r[1] for r in D.dedup_counts_new(D.mirror_labels(index, near, "doc_id")).collect()}
    assert counts["Total onions"] == counts["Exact mirrors"] + counts["Near mirrors"] + counts["Unique onions"]
    exact = D.exact_duplicates(index, "doc_id")
    totals = {r[0]: r[1] for r in D.dedup_counts_total(exact, D.unique_texts(near, "doc_id")).collect()}
    assert totals["Total onions"] == counts["Total onions"]
    assert totals["Total unique onions"] == len(set(groups.values()))


def test_jaccard_to_representative(texts):
    rows, df = texts
    distinct = D.distinct_texts(df, "doc_id")
    near = D.near_table(D.near_groups(distinct, "doc_id"), distinct, "doc_id")
    items = firsts(rows)
    got = D.jaccard_to_representative(near, distinct, "doc_id").collect()
    assert got
    for r in got:
        a, b = set(items[r["doc_id"]].split()), set(items[r["representative"]].split())
        assert r["jaccard"] == pytest.approx(len(a & b) / len(a | b))


def test_recall_of_similar_texts(texts):
    """Texts with a similarity of 0.9 or more share a bucket."""
    rows, _ = texts
    groups, items = brute_groups(rows), firsts(rows)
    for i, a in items.items():
        for j, b in items.items():
            x, y = set(a.split()), set(b.split())
            if i < j and x and len(x & y) / len(x | y) >= 0.9:
                assert groups[i] == groups[j]


def test_components(spark):
    rng = random.Random(11)
    # a long path, a star whose centre is its largest node, and random small pieces
    edges = [(i, i + 1) for i in range(60)] + [(500, i) for i in range(200, 260)]
    edges += [(a, a + rng.randrange(1, 4)) for a in range(1000, 1100, 5)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = dict(tuple(r) for r in connected_components(df).collect())
    assert got == {n: find(n) for n in list(parent)}


def test_incremental_exact(spark):
    old = spark.createDataFrame([("k1", "a"), ("k2", "b")], "text_key string, object_name string")
    new = spark.createDataFrame([("k1", "a"), ("k3", "c")], "text_key string, object_name string")
    assert D.incremental_exact(old, new).count() == 4
    assert D.incremental_exact(old, new, distinct=True).count() == 3
    assert D.incremental_exact(None, new).count() == 2


def test_union_if_intersecting(spark):
    row = spark.range(1).select(
        D.union_if_intersecting(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))).alias("x"),
        D.union_if_intersecting(F.array(F.lit("a")), F.array(F.lit("c"))).alias("y")).first()
    assert (row["x"], row["y"]) == (["a", "b", "c"], [])


def test_no_duplicates_and_no_texts(spark):
    texts = spark.createDataFrame([(1, "a b c"), (2, "d e f g")], "doc_id bigint, text string")
    assert sorted(tuple(r) for r in D.near_groups(texts, "doc_id").collect()) == [(1, 1), (2, 2)]
    assert D.near_groups(texts.where("doc_id > 5"), "doc_id").collect() == []
    assert connected_components(spark.createDataFrame([(1, 1)], "u bigint, v bigint")).collect() == []


def test_distinct_texts_of_a_repeated_id(spark):
    rows = [("a", "t one"), ("a", "t two"), ("b", "t one"), ("a", "t one")]
    got = D.distinct_texts(spark.createDataFrame(rows, "doc_id string, text string"), "doc_id").collect()
    assert sorted((r["doc_id"], r["text"], r["n_copies"]) for r in got) == [("a", "t one", 3), ("a", "t two", 1)]


def test_component_step_splits_a_hub(spark):
    """A node that a third of the edges meet is dealt over many tasks."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    edges = spark.range(1, 30_001).selectExpr("case when id % 3 = 0 then 0 else id - 1 end as u", "id as v")
    found = _with_minimum(edges).withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    sizes = sorted(r["count"] for r in found)
    assert sum(sizes) == 30_000 and sizes[-1] <= 2 * sizes[3]


def test_no_python_workers_without_heavy_keys(spark):
    """Every component round joins twice; a list of no keys is not made by Python tasks."""
    from duskwatch.operators.skew import heavy_keys

    counts = spark.range(1000).selectExpr("cast(id as string) as k", "id as j", "1L as n")
    found = heavy_keys(counts, ["k", "j"], 16)
    assert found.dtypes == [("k", "string"), ("j", "bigint"), ("_salts", "int")] and found.count() == 0
    assert "ExistingRDD" not in found._jdf.queryExecution().toString()
