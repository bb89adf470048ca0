"""Fingerprints, filter audit and collocations against plain loops."""

import hashlib
import random
import re
from collections import Counter
from itertools import permutations

import numpy as np
import pyarrow as pa
import pytest

from duskwatch.llm import collocations, filter_audit, fingerprints
from duskwatch.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


# --- fingerprints ----------------------------------------------------------------------

def following(rows):
    """Rows in descending id order (nulls last) with the next text."""
    return [(r, rows[(i + 1) % len(rows)]) for i, r in enumerate(rows)]


def test_fingerprints_of_a_table(spark):
    docs = sorted(((r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()), reverse=True)
    rows = {r["doc_id"]: r for r in QUERIES["op11_fingerprints"](spark, SF).collect()}
    assert len(rows) == len(docs)
    better = 0
    for (i, text), (j, after) in following(docs):
        half = len(text) // 2
        new, row = text[:len(text) - half] + after[:half], rows[i]
        assert (row["n_chars"], row["edited_sha256"]) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        a, b, c = (int(x, 16) for x in (row["fingerprint"], row["edited_fingerprint"], rows[j]["fingerprint"]))
        for value, other in ((row["near_edited"], b), (row["near_next"], c)):
            assert value == pytest.approx(max(0, np.cos(np.pi * (a ^ other).bit_count() / 128)), abs=1e-12)
        better += row["near_edited"] > row["near_next"] or text == after
        near = sum((a ^ int(r["fingerprint"], 16)).bit_count() <= fingerprints.RADIUS for r in rows.values()) - 1
        assert row["n_near"] == (near if i % 50 == 0 else None)
    assert better > 0.95 * len(docs)


def test_fingerprints_of_odd_rows(spark):
    long = " ".join(f"w{i % 997}" for i in range(60_000))
    docs = [(5, "a b c"), (None, "x y"), (None, None), (7, ""), (5, "a b c"), (5, "others"), (100, long), (50, long), (0, "é漢字 \x00 𝒳"), (None, "x y")]
    df = spark.createDataFrame([(i, t, "f", 1.0) for i, t in docs], "doc_id long, text string, fingerprint string, near_next double")
    rows = fingerprints.fingerprint_documents(df.repartition(3)).collect()
    assert len(rows) == len(docs)
    by = {}
    for r in rows:
        by.setdefault((r["doc_id"], r["n_chars"]), set()).add(r["fingerprint"])
    assert all(len(found) == 1 for found in by.values())
    assert by[100, len(long)] == by[50, len(long)] and by[7, 0] == by[None, 0] == {"0" * 32}
    assert {r["n_near"] for r in rows if r["doc_id"] in (100, 50)} == {1}
    # After the greatest id comes 50 with the same text: its edited text is one of both halves.
    first = next(r for r in rows if r["doc_id"] == 100)
    half = len(long) // 2
    assert first["near_next"] == 1 and first["edited_sha256"] == hashlib.sha256((long[:len(long) - half] + long[:half]).encode()).hexdigest()
    single = fingerprints.fingerprint_documents(df.where("doc_id = 7")).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1 == single[0]["near_edited"]
    assert fingerprints.fingerprint_documents(df.limit(0)).count() == 0


def test_search_equals_brute_force(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(128) for _ in range(60)]
    for value in base[:25] + [base[0]] * 300:  # one large group of near fingerprints
        for _ in range(2):
            near = value
            for bit in rng.sample(range(128), rng.randrange(6)):
                near ^= 1 << bit
            base.append(near)
    prints = spark.createDataFrame([(f"{v:032x}",) for v in base], "fingerprint string").repartition(5)
    queries = spark.createDataFrame([(f"{v:032x}",) for v in base[::7]], "fingerprint string")
    found = {r["fingerprint"]: r["n_near"] for r in fingerprints.search(prints, queries).collect()}
    assert found == {f"{v:032x}": sum((v ^ w).bit_count() <= 3 for w in base) for v in base[::7]}


def test_every_pair_within_the_radius_shares_a_table():
    rng = np.random.default_rng(1)
    a = rng.integers(0, 256, (500, 16), dtype=np.uint8)
    b = a.copy()
    for i in range(500):
        for bit in rng.choice(128, 3, replace=False):
            b[i, bit // 8] ^= 128 >> (bit % 8)
    assert (fingerprints.distance(a, b) == 3).all()
    assert (fingerprints._table_keys(a) == fingerprints._table_keys(b)).any(1).all()


# --- filter audit ----------------------------------------------------------------------

def failed(rows):
    """Letters each row fails, in a loop."""
    least = {}
    for i, text, *_ in rows:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    out = []
    for i, text, *_ in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        out.append("".join(letter for letter, fails in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            any(c in "#$%&*|" for c in text), i is not None and i > least[text]), strict=True) if fails))
    return out


def test_audit_equals_a_loop(spark):
    rng = random.Random(2)
    texts = [None, "", "A", "a|b", "\x00 é", " ".join(f"w{i}" for i in range(200)), " ".join(f"W{i} x y z" for i in range(70)),
             "v " * 500, " ".join(f"{i}é" for i in range(30_000)) + " %"]
    rows = [(rng.choice([None, *range(60)]), rng.choice(texts), rng.choice([None, "", "s", "s", "s", "t"])) for _ in range(120)] + [(1, "A", "s")] * 40
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in [*range(0, 60, 2), None, 4, 4, 99]]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, mask int").repartition(4)
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    marks = failed(rows)
    wanted = {}
    for order in map("".join, permutations("ABCDE")):
        for (i, _, part), fails in zip(rows, marks, strict=True):
            gone = False
            for step, letter in enumerate(order, 1):
                row = wanted.setdefault((part or "", order, step), Counter())
                here = letter in fails
                row["kept"] += not gone and not here
                row["removed"] += here and not gone
                row["redundant"] += here and gone
                row["unique_fails"] += fails == letter
                row["good_lost"] += here and not gone and i in good
                row["toxic_lost"] += here and not gone and i in toxic
                gone |= here
    shapley = Counter()
    for (part, order, step), row in wanted.items():
        shapley[part, order[step - 1]] += row["removed"]
    got = filter_audit.audit_filters(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == len(wanted) == 3 * 600
    for r in got:
        row = wanted[r["part"], r["filter_order"], r["step"]]
        assert {k: r[k] for k in row} == dict(row)
        assert r["shapley"] == shapley[r["part"], r["filter_order"][r["step"] - 1]]
    assert filter_audit.audit_filters(docs.limit(0), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).count() == 0


def test_packed_fields_do_not_overflow():
    n = (1 << 62) // 32
    total = sum(n * filter_audit.packed(mask, True, True) for mask in range(32))
    counts, alone = filter_audit.unpacked(total)
    assert (alone == n).all() and (counts[:, 0, :2].sum(1) == 32 * n).all()
    assert (counts[:, :, 3] == counts[:, :, 1]).all() and (counts[:, 4, 0] == n).all()


# --- collocations ----------------------------------------------------------------------

def mined(rows, least, top):
    """All phrases, cuts and inclusions in a loop."""
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for m in range(1, 6):
                for s in range(len(words) - m + 1):
                    counts[lang, tuple(words[s:s + m])] += 1
    found = {key: n for key, n in counts.items() if n >= least and len(key[1]) > 1}
    covered = {(lang, words[s:s + m]) for (lang, words), n in found.items() for m in range(2, len(words))
               for s in range(len(words) - m + 1) if n >= counts[lang, words[s:s + m]]}
    out = {}
    for (lang, words), a in found.items():
        if (lang, words) not in covered:
            cuts = [(1000 * a * totals[lang] // (counts[lang, words[:k]] * counts[lang, words[k:]]), k) for k in range(1, len(words))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), counts[lang, words[:k]], counts[lang, words[k:]], totals[lang]))
    return {(lang, i, phrase.decode(), -a, l, r, n, -score) for lang, rows in out.items()
            for i, (score, a, phrase, l, r, n) in enumerate(sorted(rows)[:top], 1)}


def odd_texts():
    rng = random.Random(8)
    words = ["the", "The", "cat", "sat", "é", "é漢", "\x00", "b\x01", "b", "\x08x", "\x0ey", "a\x1fb", "x'y", "New", "york"]
    rows = [("en", " ".join(rng.choices(words, k=40))) for _ in range(60)]
    rows += [(rng.choice([None, "und", "a\tb", ""]), "New  York\tcity. New york,city;b b b b b b\x0bthe cat sat on the mat") for _ in range(80)]
    return rows + [("en", None), ("en", ""), (None, " \t\n"), ("fr", "un deux")] + rows[:5] * 3


@pytest.mark.parametrize("bits", [64, 4096, collocations.FILTER_BITS])  # with 64 nearly all pairs pass
def test_collocations_equal_a_loop(spark, bits):
    rows = odd_texts()
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "lang string, text string, n int, phrase string").repartition(6)
    got = collocations.mine_collocations(docs, least=12, top=40, filter_bits=bits).collect()
    wanted = mined(rows, 12, 40)
    assert len(got) == len(wanted) > 60 and {tuple(r) for r in got} == wanted
    assert collocations.mine_collocations(docs.limit(0)).count() == 0


def test_scores_beyond_64_bits(spark):
    rows = [("en", "a b " * 30_000 + "c d")] * 4
    got = collocations.mine_collocations(spark.createDataFrame(rows, "lang string, text string"), least=100, top=9).collect()
    assert {tuple(r) for r in got} == mined(rows, 100, 9)


def test_automaton_over_batches_of_any_size():
    rng = random.Random(3)
    keys = Counter(b"\x09".join([b"6c", *rng.choices([b"a", b"b", b"bb", b"c"], k=rng.randrange(2, 6))]) for _ in range(400))
    ordered = sorted(keys)
    wanted = Counter()
    for key, n in keys.items():
        words = key.split(b"\x09")
        for m in range(3, len(words) + 1):
            wanted[b"\x09".join(words[:m])] += n
    for size in (1, 2, 7, 1000):
        automaton, found = collocations.CountAutomaton(4), Counter()
        parts = [ordered[i:i + size] for i in range(0, len(ordered), size)]
        for states in [*(automaton.add(pa.array(p, pa.binary()), np.array([keys[k] for k in p])) for p in parts), automaton.end()]:
            for prefix, n in zip(*states, strict=True):
                found[prefix] += n
        assert {k: n for k, n in found.items() if n >= 4} == {k: n for k, n in wanted.items() if n >= 4}


def test_shards_are_cut_anywhere(monkeypatch):
    rows = odd_texts()
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], ["lang", "text"])

    def counted():
        total = Counter()
        for shard in collocations._shards(iter([batch])):
            passes = shard.follows.copy()
            for keys, n in collocations.sorted_ngrams(shard, passes):
                found = keys.to_pylist()
                assert found == sorted(found)
                total.update(dict(zip(found, n.tolist(), strict=True)))
        return total

    whole = counted()
    monkeypatch.setattr(collocations, "SHARD_WORDS", 97)
    monkeypatch.setattr(collocations, "SLICE_BYTES", 300)
    assert counted() == whole
