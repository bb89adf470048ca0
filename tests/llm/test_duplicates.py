"""Near duplicates of documents, lines and vectors against brute force."""

import random
import re

import numpy as np
import pytest

from duskwatch.llm import embedding_dedup, line_dedup, shingle_join

WORDS = [f"w{i}" for i in range(400)]


def documents():
    rng = random.Random(5)
    rows = []
    for i in range(60):
        base = [rng.choice(WORDS) for _ in range(rng.choice([1, 3, 5, 6, 9, 14, 30, 80, 200, 500]))]
        rows.append(base)
        for _ in range(rng.choice([0, 0, 1, 3, 8])):
            copy = list(base)
            for _ in range(rng.randrange(1 + len(base) // 15 + 1)):
                copy[rng.randrange(len(copy))] = rng.choice(WORDS)
            rows.append(copy[:rng.choice([len(copy), max(1, len(copy) * 9 // 10)])])
    shared = [rng.choice(WORDS) for _ in range(40)]
    rows += [[rng.choice(WORDS) for _ in range(30)] + shared for _ in range(25)]  # a passage many share
    texts = [rng.choice([" ", "\n", "  "]).join(r) for r in rows]
    rng.shuffle(texts)
    return [(100 + 3 * i, t) for i, t in enumerate(texts)] + [(7, None), (8, ""), (9, " \n"), (103, texts[1]), (None, texts[1])]


def sets_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").lower())
    return {tuple(words[i:i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def components(ids, linked):
    least = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            m = min(least[a], least[b])
            if least[a] != m or least[b] != m:
                least[a] = least[b] = m
                changed = True
    return least


def test_parity_sketch_join(spark):
    rows = documents()
    docs = spark.createDataFrame([(t, i, 0, 0) for i, t in rows], "text string, doc_id long, c long, key int").repartition(5)
    got = {}
    for r in shingle_join.near_duplicates(docs).collect():
        if r["doc_id"] is None:
            assert r["component_id"] is None
        else:
            got.setdefault(r["doc_id"], []).append((r["n_shingles"], r["component_id"]))
    known = {i: sets_of(t) for i, t in rows if i is not None}
    ids = list(known)
    linked = [(a, b) for k, a in enumerate(ids) for b in ids[:k]
              if known[a] and known[b] and 100 * len(known[a] & known[b]) >= 80 * len(known[a] | known[b])]
    least = components(ids, linked)
    assert {i: set(v) for i, v in got.items()} == {i: {(len(known[i]), least[i])} for i in ids}
    assert len(got[103]) == 2 and sum(least[i] != i for i in ids) > 40


def test_parity_sketch_join_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert shingle_join.near_duplicates(empty).count() == 0


@pytest.mark.parametrize("n", [1, 4, 5, 9, 40, 333])
def test_every_linked_pair_shares_an_emitted_part(n):
    rng = np.random.default_rng(n)
    for _ in range(60):
        common = rng.integers(0, 1 << 63, n).astype(np.uint64)
        spare = int(rng.integers(0, n // 4 + 1))
        a, b = np.sort(common), np.sort(np.concatenate([common, rng.integers(0, 1 << 63, spare).astype(np.uint64)]))
        if 100 * len(a) < 80 * len(b):
            continue
        keys = [set(shingle_join.part_keys(s, np.array([len(s)]), np.array([1]))[0].tolist()) for s in (a, b)]
        shown = [shingle_join.part_keys(s, np.array([len(s)]), np.array([1]))[2].max() for s in (a, b)]
        assert len(keys[0] & keys[1]) >= max(1, min(shown))


def test_sketches_bound_the_difference_from_below():
    rng = np.random.default_rng(3)
    a = np.unique(rng.integers(0, 1 << 63, 900).astype(np.uint64))
    b = np.unique(np.concatenate([a[30:], rng.integers(0, 1 << 63, 200).astype(np.uint64)]))
    both = np.concatenate([a, b]), np.array([len(a), len(a) + len(b)])
    x, y = (np.frombuffer(s, np.uint8) for s in shingle_join.sketches(*both))
    width = min(len(x), len(y))
    apart = np.bitwise_count(shingle_join.folded(x, width) ^ shingle_join.folded(y, width)).sum()
    assert 0 < apart <= len(np.setxor1d(a, b))


def test_lines(spark):
    rng = random.Random(2)
    base = [" ".join(rng.choice(WORDS) for _ in range(rng.choice([1, 2, 4, 5, 10, 25]))) for _ in range(30)]
    rows = []
    for i in range(40):
        lines = []
        for _ in range(rng.randrange(1, 8)):
            words = rng.choice(base).split()
            if rng.random() < 0.6:
                words[rng.randrange(len(words))] = rng.choice(WORDS)
            lines.append(" ".join(words) if rng.random() < 0.9 else rng.choice(["", "  ", "A b\tc"]))
        rows.append((i, "\n".join(lines)))
    rows += [(50, None), (51, ""), (52, rows[0][1]), (53, " ".join(rng.choice(WORDS) for _ in range(3000)))]
    docs = spark.createDataFrame([(1, t, i) for i, t in rows], "n int, text string, doc_id long").repartition(4)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(docs).collect()}
    seen, wanted = [], {}
    for i, text in rows:
        kept = []
        for line in (text or "").split("\n"):
            words = set(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))
            if not words or not any(100 * len(words & w) >= 80 * len(words | w) for w in seen):
                kept.append(line)
            if words:
                seen.append(words)
        wanted[i] = "\n".join(kept) if text is not None else None
    assert {i: r["text"] for i, r in got.items()} == wanted
    assert got[50]["n_lines"] == 0 and got[52]["text"].strip() == "" and got[52]["n_removed"] > 0
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


@pytest.mark.parametrize("shared", [None, 7])
def test_lines_of_different_texts_of_one_id(spark, shared):
    copy, own = "one two three four five six", [f"own{i} words{i} here{i} now{i} then{i}" for i in range(5)]
    rows = [(shared, f"{copy}\n{own[0]}"), (shared, f"{own[1]}\n{copy}"), (shared, f"{own[2]}\n{own[3]}"), (shared, f"{copy}\n{own[4]}"),
            (shared, f"{own[2]}\n{own[3]}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted((r["text"], r["n_removed"]) for r in line_dedup.dedup_lines(docs).collect())
    # The line stays in one row; equal rows are one place.
    kept = [t for t, _ in got if copy in t]
    assert len(kept) == 1 and sum(n for _, n in got) == 2
    assert sorted(line for t, _ in got for line in t.split("\n") if line != copy) == sorted([*own, own[2], own[3]])


def test_near_copies_with_own_rare_words_meet_early(spark, monkeypatch):
    """Copies that each hold words of their own are explained by the first round, not by all their pairs."""
    rng = random.Random(7)
    left = []

    def pairs_left(copies: int) -> int:
        texts = []
        for group in range(6):
            line = [f"w{group}x{k}" for k in range(60)]
            for copy in range(copies):
                words = list(line)
                for k in rng.sample(range(60), rng.randrange(5)):
                    words[k] = f"own{group}x{copy}x{k}"
                texts.append(" ".join(words))
        rng.shuffle(texts)
        docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
        sets = [set(t.split()) for t in texts]
        expected = {i for i, a in enumerate(sets) if any(100 * len(a & b) >= 80 * len(a | b) for b in sets[:i])}
        left.clear()
        gone = {r["doc_id"] for r in line_dedup.duplicate_lines(docs).select("doc_id").collect()}
        assert gone == expected
        return sum(left)

    staged = line_dedup.stage

    def counted(df, name):
        found = staged(df, name)
        if name == "pairs_of_run":
            left.append(found.count())
        return found

    monkeypatch.setattr(line_dedup, "stage", counted)
    assert pairs_left(20) < 120
    assert pairs_left(80) < 960


def test_vectors(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        rows.append((i, rng.standard_normal(16).tolist(), i % 3))
    for i in range(300, 420):  # near copies of few, a whole cluster of one
        rows.append((i, (np.array(rows[i % 5][1]) * 2 + rng.standard_normal(16) * 0.05).tolist(), rows[i % 5][2]))
    rows += [(500, rows[0][1], 0), (501, rows[0][1], 1), (502, rows[0][1], None), (503, None, 0), (504, [], 0), (505, [0.0] * 16, 0),
             (506, [None] + [1.0] * 15, 0), (507, [float("nan")] + [1.0] * 15, 0), (508, [1.0] * 3, 0), (None, rows[0][1], 0)]
    table = spark.createDataFrame([(i, v, l, "x") for i, v, l in rows], "vec_id long, embedding array<double>, label int, name string")
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(table.repartition(3)).collect()}
    valid = {i: (np.array(v, float) / np.linalg.norm(v), l) for i, v, l in rows
             if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.linalg.norm(v)}
    linked = [(a, b) for a in valid for b in valid if a != b and valid[a][1] == valid[b][1]
              and len(valid[a][0]) == len(valid[b][0]) and valid[a][0] @ valid[b][0] >= 0.93]
    least = components([i for i, _, _ in rows if i is not None], linked)
    degree = {i: sum(a == i for a, _ in linked) for i in least}
    found = sum(got[i]["n_links"] for i in least)
    assert all(got[i]["n_links"] <= degree[i] for i in least) and found >= 0.98 * len(linked)
    assert sum(got[i]["component_id"] == least[i] for i in least) >= 0.98 * len(least)
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in least)
    assert got[None]["n_links"] == 0 and got[501]["n_links"] == 0
    assert embedding_dedup.near_duplicates(table.limit(0)).count() == 0


def test_vectors_of_dense_groups_that_are_linked(spark):
    rng = np.random.default_rng(6)
    centre = rng.standard_normal(32)
    rows = []
    for _ in range(20):  # every list of ten is full of the own group
        own = centre + rng.standard_normal(32) * 0.1
        rows += [(own + rng.standard_normal(32) * 0.001).tolist() for _ in range(30)]
    x = np.array(rows) / np.linalg.norm(rows, axis=1)[:, None]
    assert (x @ x.T).min() > 0.94
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicates(table).collect()
    assert {(r["n_links"], r["component_id"]) for r in got} == {(599, 0)}


def test_rare_links(spark):
    rng = np.random.default_rng(8)
    x = rng.standard_normal((20000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for i in range(60):
        away = x[-1 - i] - (x[-1 - i] @ x[i]) * x[i]
        x[-1 - i] = 0.94 * x[i] + np.sqrt(1 - 0.94 ** 2) * away / np.linalg.norm(away)
    table = spark.createDataFrame([(i, v, 0) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>, label int")
    got = embedding_dedup.near_duplicates(table).where("n_links > 0").count()
    assert got >= 0.98 * 120


def test_a_poor_audit_raises(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "_audit", lambda *_: 0.5)
    monkeypatch.setattr(embedding_dedup, "AUDITS", 1)
    table = spark.createDataFrame([(i, [1.0, float(i)], 0) for i in range(9)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(RuntimeError, match="0.5"):
        embedding_dedup.near_duplicates(table)


def test_more_planes_for_larger_tables():
    work = [embedding_dedup.seed_work(n, 0.93)[0] for n in (0, 1000, 200_000, 50_000_000)]
    assert work == sorted(work) and work[0] >= 4 and work[2] > 12
