"""Language, pseudonyms, benchmark search, sharding, and the pipeline."""

import hashlib
import os
import re
import zlib

import numpy as np
import pytest

import corpus_pipeline
from compare import connect, rows_of
from duskwatch.llm import decontamination, language_id, pseudonyms, sharding
from duskwatch.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_language_on_held_out_rows(spark):
    rows = QUERIES["op5_language_id"](spark, SF).join(
        spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1]
    assert {r["doc_id"] for r in held} == {r["doc_id"] for r in rows if r["held_out"]}
    assert np.mean([r["lang"] == r["lang_pred"] for r in held]) > 0.95 and all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_odd_texts(spark):
    import public_tokenizers

    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = spark.createDataFrame(
        [(i, t, l, 0.5) for i, (t, l) in enumerate([("the cat is here", "en"), ("die katze ist hier", "de")] * 20 + [
            (None, "en"), ("", "de"), ("½ ² ① Ⅷ", "en"), ("katze", None), ("x" * 20000, "en"), ("漢字", None)])],
        "doc_id long, text string, lang string, score double")
    model = language_id.train(docs, path)
    rows = {r["doc_id"]: r for r in language_id.predict(docs, model, path).collect()}
    assert [rows[i]["lang_pred"] for i in (0, 1, 40, 41, 42, 43)] == ["en", "de", "und", "und", "und", "de"]
    assert rows[40]["score"] == 0 and len(rows) == docs.count() and rows[0].asDict().keys() == set(docs.columns) | {"lang_pred"}
    empty = docs.limit(0)
    assert language_id.predict(docs, language_id.train(empty, path), path).select("lang_pred").distinct().collect()[0][0] == "und"
    assert language_id.predict(empty, model, path).count() == 0


def test_words_are_runs_of_letters_and_marks():
    """Against a loop over Unicode categories."""
    import random
    import unicodedata

    def loop(text):
        out, word = [], ""
        for c in text.lower() + " ":
            kind = unicodedata.category(c)
            if kind[0] == "L" or (word and kind[0] == "M"):
                word += c
            else:
                out += [word] if word else []
                word = ""
        return out

    rng = random.Random(4)
    letters = "abcÉßİ½²①Ⅷ_7 -'’नमस्ते漢字\u0301ａ𝒳ͅ\n"
    for _ in range(3000):
        text = "".join(rng.choices(letters, k=rng.randrange(12)))
        assert language_id.find_words(text) == [language_id._OPEN + w for w in loop(text)], text
    assert language_id.find_words("½ ² ① Ⅷ") == [] and language_id.find_words("नमस्ते") == ["▁नमस्ते"]
    assert language_id.find_words("x" * 100 + " y") == ["▁" + "x" * 48, "x" * 48, "x" * 4, "▁y"]


def test_forward_sums_all_segmentations():
    import public_tokenizers

    pieces = language_id.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    p = np.maximum(pieces.prior, language_id.FLOOR)[:, None]
    known = {n: i for i, n in enumerate(pieces.names)}

    def brute(word):
        total = [1.0] + [0.0] * len(word)
        for end in range(1, len(word) + 1):
            for start in range(end):
                piece = word[start:end]
                i = known.get(piece, pieces.n - 1 if end - start == 1 else None)
                if i is not None:
                    total[end] += total[start] * p[i, 0]
        return np.log(total[-1])

    words = ["▁the", "▁katze", "▁é漢x", "abcabc"]
    assert np.allclose(language_id.score_words(pieces, words, p)[:, 0], [brute(w) for w in words])
    counts = language_id.expected_counts(pieces, words, np.ones((4, 1)))
    length = np.array([len(n) for n in pieces.names] + [1])
    assert np.isclose(counts[:, 0] @ length, sum(map(len, words)))


def test_pseudonyms():
    f = pseudonyms.Feistel(b"key")
    for size in (10, 97, 1000):
        assert sorted(f("x", i, size) for i in range(size)) == list(range(size))
    text = ("card 4041894974608795 or 4041-8949-7460-8795, on 2024-02-29 and 29.02.2024; call +1 (988) 555-2485 from 70.123.182.155, "
            "a.b42@example.com, GB82 WEST 1234 5698 7654 32, 123-45-6789, not 4041894974608796, 2023-02-29, 300.1.1.1 or 4.0")
    new, found = pseudonyms.pseudonymise(text, f)
    assert [v["kind"] for v in found] == ["card", "card", "date", "date", "phone", "ip", "email", "iban", "ssn"]
    for v in found:
        assert text[v["start"]:v["end"]] not in new
    for kept in ("4041894974608796", "2023-02-29", "300.1.1.1", "4.0", "@example.com"):
        assert kept in new
    assert len(new.split()) == len(text.split()) and new == pseudonyms.pseudonymise(text, f)[0]
    a, b = re.findall(r"\b\d{16}\b|\b\d{4}-\d{4}-\d{4}-\d{4}\b", new)[:2]
    assert a == b.replace("-", "") and pseudonyms.luhn(a) % 10 == 0
    iso, dmy = re.search(r"on (\S+) and (\S+);", new).groups()
    assert iso.split("-") == dmy.split(".")[::-1]
    assert pseudonyms.pseudonymise(text, pseudonyms.Feistel(b"other"))[0] != new
    again = pseudonyms.pseudonymise(new, f)[1]
    assert [v["kind"] for v in again] == [v["kind"] for v in found]  # still valid values


def test_values_within_longer_matches():
    f = pseudonyms.Feistel(b"key")
    for text, values in (
        ("to BE68 5390 0754 7034 AND then", ["BE68 5390 0754 7034"]), ("4111 1111 1111 1111 123", ["4111 1111 1111 1111"]),
        ("AB13 BE68 5390 0754 7034", ["BE68 5390 0754 7034"]), ("no 17 4111 1111 1111 1111", ["4111 1111 1111 1111"]),
        ("call +1 (017) 555-7713 or +1 (132) 555-1352", ["+1 (017) 555-7713", "+1 (132) 555-1352"])):
        new, found = pseudonyms.pseudonymise(text, f)
        assert [text[v["start"]:v["end"]] for v in found] == values
        assert len(new) == len(text) and not any(v in new for v in values)
        assert new.split()[0] == text.split()[0] or text.startswith("4111")
    shapes = {}
    for v in ("0171234567", "1320551352", "2125551352", "2120551352"):
        new = "".join(c for c in pseudonyms.pseudonymise(f"+1{v}", f)[0] if c.isdigit())[1:]
        shapes[v] = new
        assert (new[0] < "2", new[3] < "2") == (v[0] < "2", v[3] < "2")
    assert len(set(shapes.values())) == 4
    for kept in ("4041894974608796", "BE68 5390 0754 7035 AND"):
        assert pseudonyms.pseudonymise(kept, f) == (kept, [])


def test_pseudonyms_of_a_table(spark):
    docs = spark.createDataFrame(
        [(1, "2024-01-02", "a"), (2, "x 2024-01-02", "b"), (None, None, "c"), (3, "", "d")], "doc_id long, text string, n_values string")
    rows = {r["doc_id"]: r for r in pseudonyms.pseudonymise_documents(docs, b"k").collect()}
    assert rows[2]["text"] == f"x {rows[1]['text']}" != "x 2024-01-02" and rows[None]["text"] is None and rows[3]["n_values"] == 0
    assert pseudonyms.pseudonymise_documents(docs.limit(0), b"k").count() == 0


def brute_passages(docs, items, window=10):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), t or ""))
    phrases = {}
    for name, text in items:
        w = split(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            phrases.setdefault(tuple(w[i:i + window]), set()).add(str(name))
    lengths = {len(p) for p in phrases}
    out = []
    for i, text in docs:
        w, hit, names = split(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (p := tuple(w[k:k + n])) in phrases:
                    hit.update(range(k, k + n))
                    names |= phrases[p]
        out.append((i, len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("case,block_bytes", [("given", None), ("given", 6_000), ("odd", None), ("odd", 1)])
def test_passages(spark, case, block_bytes, monkeypatch):
    if block_bytes:  # several blocks, each in a pass of its own
        monkeypatch.setattr(decontamination, "BLOCK_BYTES", block_bytes)
    if case == "given":
        docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
        items = spark.read.parquet(f"{SF}/benchmark.parquet")
    else:
        a = " ".join(f"k{i % 7}" for i in range(40))
        docs = spark.createDataFrame(
            [(1, a), (2, a.upper() + ", x " + a), (3, None), (4, ""), (None, "one two"), (5, "One. TWO! three one two"), (5, a[:50]),
             (6, "é ü " * 3000 + "one two")], "doc_id long, text string").repartition(2)
        items = spark.createDataFrame([(1, a), (2, "one two"), (3, None), (4, "..."), (5, "k0 k1 k2"), (5, "three")], "item_id long, text string")
    got = decontamination.find_passages(docs, items)
    rows = [(r["doc_id"], r["n_words"], r["n_hit"], r["n_items"], hashlib.sha256(",".join(r["item_ids"]).encode()).hexdigest()) for r in got.collect()]
    wanted = brute_passages([(r["doc_id"], r["text"]) for r in docs.collect()], [(r["item_id"], r["text"]) for r in items.collect()])
    assert sorted(rows, key=str) == wanted and any(r[2] for r in wanted)
    assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_hit"] for r in got.collect())
    clean = decontamination.clean_documents(docs, items)
    assert clean.count() == sum(r[2] == 0 for r in wanted) and clean.columns == docs.columns
    assert decontamination.find_passages(docs.limit(0), items).count() == 0
    assert decontamination.find_passages(docs, items.limit(0)).where("n_hit > 0").count() == 0


def test_blocks_of_the_benchmark_hold_all_items(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 40)
    items = spark.createDataFrame([(i, f"alpha beta w{i}" if i % 5 else None) for i in range(30)] + [(99, "x " * 50)], "item_id long, text string")
    blocks = list(decontamination._blocks(items, 10, "item_id", "text"))
    assert [final for _, final in blocks] == [False] * (len(blocks) - 1) + [True] and len(blocks) > 5
    names = sorted(n for block, _ in blocks for n in set().union(*(block.items(p) for p in range(len(block.length)))))
    assert names == sorted([str(i) for i in range(30) if i % 5] + ["99"])


def test_suffix_array():
    rng = np.random.default_rng(0)
    for n, k in ((1, 1), (50, 2), (300, 3), (200, 1)):
        text = np.append(rng.integers(1, k + 1, n), 0)
        assert decontamination.suffix_array(text).tolist() == sorted(range(n + 1), key=lambda i: text[i:].tolist())


@pytest.mark.parametrize("shards", [3, 16])
def test_sharding(spark, shards):
    rng = np.random.default_rng(1)
    rows = [(i, "ab" * int(n), "x") for i, n in enumerate(rng.integers(0, 60, 200))] + [(500, None, "y"), (500, None, "y"), (None, "zz", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot string").repartition(3)
    got = sharding.shard_documents(docs, shards).collect()
    assert len(got) == len(rows)
    by_shard, by_text = {}, {}
    for r in got:
        by_shard.setdefault(r["shard"], []).append(r)
        by_text.setdefault((r["text_crc32"], r["size"]), set()).add(r["shard"])
    assert all(sorted(r["slot"] for r in own) == list(range(len(own))) for own in by_shard.values())
    assert all(0 <= s < shards for s in by_shard)
    groups = {}
    for i, t, _ in rows:
        key = int(hashlib.md5(t.encode()).hexdigest()[:15], 16) if t is not None else 0
        groups[key] = groups.get(key, 0) + len(t or "") + 1
    sizes = np.array([groups[k] for k in sorted(groups)])
    capacity, _ = sharding.smallest_capacity(sizes, shards)
    assert max(sum(r["size"] for r in own) for own in by_shard.values()) == capacity
    assert all(len(s) == 1 for k, s in by_text.items() if k[1] > 1)
    assert sharding.shard_documents(docs.limit(0), shards).count() == 0


def test_cuts_are_refined_to_single_groups(spark):
    rng = np.random.default_rng(2)
    keys, sizes = np.unique(rng.integers(0, 1 << 60, 3000)), rng.integers(1, 1000, 3000)
    groups = spark.createDataFrame(list(zip(keys.tolist(), sizes[:len(keys)].tolist(), strict=False)), "k long, bytes long")
    wanted, _ = sharding.smallest_capacity(sizes[:len(keys)], 16)
    assert sharding.minimax_cuts(groups, 16, cells=16, split=8)[0] == wanted


def test_smallest_capacity():
    for sizes, shards, wanted in (([3, 1, 4, 1, 5], 2, 8), ([9], 4, 9), ([1] * 10, 3, 4), ([2, 2, 2, 7], 2, 7)):
        capacity, ends = sharding.smallest_capacity(np.array(sizes), shards)
        assert capacity == wanted and ends[-1] == len(sizes)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, name):
    found, wanted = QUERIES[name](spark, SF), connect(SF).execute(ORACLES[name])
    columns = [c[0] for c in wanted.description]
    assert rows_of(found.columns, found.collect()) == rows_of(columns, wanted.fetchall())


def test_pipeline(spark, tmp_path):
    """The stages one by one against their own definitions, on given documents and odd ones."""
    given = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame(
        [(10_000, None, "en", "s", 0), (10_001, "", "en", "s", 0), (10_002, "1 2 3", None, "s", 5)], given.schema)
    docs = given.union(odd)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "decontamination", "packing"]
    kept = None
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r["doc_id"]: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        path = f"file://{tmp_path}/{number}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        ids = {r["doc_id"] for r in docs.collect()}
        assert ids <= set(before)
        if number < 4:
            assert docs.columns == given.columns
        if number == 0:
            assert set(before) - ids == {10_000, 10_001, 10_002}
        if number == 1:
            assert all(r["text"].strip() and r["n_chars"] == len(r["text"]) for r in docs.collect())
        if number == 3:
            hit = {r[0] for r in brute_passages([(i, r["text"]) for i, r in before.items()], [
                (r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]) if r[2]}
            assert set(before) - ids == hit
        kept = ids
    assert kept and docs.where("offset <> 0").count() == 0


def test_one_row_per_group_of_near_copies(spark):
    words = [" ".join(f"{k}{i}" for i in range(60)) for k in "abcd"]
    near = words[0].replace("a59", "other")
    rows = [(1, words[0], "x"), (2, near, "x"), (2, words[1], "x"), (1, words[0], "y"), (1, near, "x"), (None, near, "x"),
            (None, words[2], "x"), (None, words[2], "x"), (None, words[3], "x"), (5, "", "x"), (5, "", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    got = corpus_pipeline.distinct_documents(spark, docs, SF)
    assert got.columns == docs.columns
    kept = sorted((tuple(r) for r in got.collect()), key=str)
    group = [r for r in kept if r[1] in (words[0], near)]
    assert len(group) == 1 and group[0][0] == 1 and group[0][2] == "x"
    assert [r for r in kept if r not in group] == sorted(
        [(2, words[1], "x"), (None, words[2], "x"), (None, words[3], "x"), (5, "", "x"), (5, "", "x")], key=str)


def test_stages_keep_columns_of_any_name(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    odd = docs.selectExpr("*", "cast(doc_id as string) as _gone", "doc_id as _key", "'x' as _lang", "0.5 as _score", "1 as _lines",
                          "2 as _removed", "3 as _id", "'t' as _text", "4 as _other", "5 as `_KEY2`").withColumnRenamed("_KEY2", "__GONE")
    for name, function in corpus_pipeline.STAGES[:-1]:
        plain = {r["doc_id"] for r in function(spark, docs, SF).collect()}
        left = function(spark, odd, SF)
        assert left.columns == odd.columns, name
        rows = left.collect()
        assert {r["doc_id"] for r in rows} == plain and plain
        assert all((r["_gone"], r["_key"], r["_lang"], r["_removed"], r["_text"], r["__GONE"]) == (str(r["doc_id"]), r["doc_id"], "x", 2, "t", 5) for r in rows)


def test_rows_that_share_a_name_all_stay(spark, monkeypatch):
    """Names of a few bits: different rows meet under one name, and none is lost."""
    real = corpus_pipeline.F.xxhash64
    monkeypatch.setattr(corpus_pipeline.F, "xxhash64", lambda *c: real(*c) if len(c) == 3 else real(*c).bitwiseAND(7))
    rows = [(i, f"text number {i} of its own with words {i * 7} {i * 11} {i * 13}") for i in range(40)]
    docs = spark.createDataFrame([*rows, rows[3], rows[3]], "doc_id long, text string")
    left = corpus_pipeline.distinct_documents(spark, docs, SF)
    assert sorted(map(tuple, left.collect())) == rows


def test_pipeline_query(spark):
    assert os.path.exists(SF) and corpus_pipeline.run(spark, SF).where("length = size(ids)").count() > 100
