"""Token files, counts and packing against the tokenizers library; the coder by round trips."""

import lzma
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from duskwatch.llm import coder, packing, token_counts, token_files
from duskwatch.llm.tokens import ChunkEncoder, PieceCounter

ODD = [
    "", "  a  b", "x\x1cy \x1c z", "a b c  d\n\n e ", "<|endoftext|>hi <|endoftext|> there", " \n\t", "Σας ΣΑΣ̈ é x",
    "don't 'll  we've\t\tx", "😀 漢字漢字 hé", "\n \nfoo \n bar  ", "a <|startoftext|>b", "x  y", "a \x85b \x85 c",
    "it 's ok", "İstanbul İ. é, a.b ..", "naïve, naïve; 12,5 x2!", "long" * 5000, "é é. K Å",
]
FILES = {"byte_bpe_50k.json": True, "word_bpe_49k.json": False}
SCHEMA = "n_tokens string, doc_id long, text string, shard int"


def table(spark):
    rows = [("x", i, t, 1) for i, t in enumerate(ODD)] + [("x", 900, None, 2), ("x", None, "a null id", 3), ("x", 5, ODD[5], 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.mark.parametrize("name", FILES)
def test_chunks_give_the_ids_of_the_whole_text(name):
    mine, theirs = ChunkEncoder(public_tokenizers.path(name), FILES[name]), Tokenizer.from_file(public_tokenizers.path(name))
    counts = PieceCounter(public_tokenizers.path(name), FILES[name])
    for texts in ([t] for t in ODD), [ODD], [ODD]:
        for batch in texts:
            ids = np.concatenate([i for i, _ in mine.encode(batch)])
            wanted = [theirs.encode(t, add_special_tokens=False).ids for t in batch]
            assert ids.tolist() == sum(wanted, [])
            assert counts.count(batch).tolist() == list(map(len, wanted))


@pytest.mark.parametrize("name", FILES)
def test_counts_of_random_odd_texts(name):
    random = np.random.default_rng(5)
    parts = [" ", "  ", "\n", "\t", "\x85", "\xa0", "\u3000", "'s", "'LL", "\u0308", "é", "İ", "Σ", "漢", "ab", "12", "½", ".", "!!", "<|endoftext|>", "<|", "😀"]
    texts = ["".join(random.choice(parts, random.integers(0, 12))) for _ in range(3000)]
    theirs = Tokenizer.from_file(public_tokenizers.path(name))
    wanted = [len(e.ids) for e in theirs.encode_batch(texts, add_special_tokens=False)]
    assert PieceCounter(public_tokenizers.path(name), FILES[name]).count(texts).tolist() == wanted


def test_a_pre_token_is_counted_once(monkeypatch):
    mine = PieceCounter(public_tokenizers.path("word_bpe_49k.json"), False)
    assert mine.count(["tea, tea tea!", "tea tea,"]).tolist() == [5, 3]
    assert set(mine.pieces) == {"tea", ",", "!"} and len(mine.index) == 3
    monkeypatch.setattr("duskwatch.llm.tokens.COUNTED", 2)
    assert mine.count(["cup"]).tolist() == [1] and set(mine.pieces) == {"cup"}


@pytest.mark.parametrize("ids", [
    np.random.default_rng(0).integers(0, 50257, (3, 4096)), np.zeros((2, 4096), int), np.full((2, 65), 50256),
    np.minimum(np.random.default_rng(1).zipf(1.2, (40, 1000)), 50256), np.random.default_rng(2).integers(0, 2, (1, 1))])
def test_coder_round_trip(ids):
    words = coder.encode_blocks(ids, 50257)
    assert np.array_equal(coder.decode_blocks(words, ids.shape[1], 50257), ids)


@pytest.mark.parametrize("width", [1, 2, 15, 16, 17, 33, 250])
@pytest.mark.parametrize("vocabulary", [1, 3, 50257, 1 << 20])
def test_coder_round_trip_of_short_blocks_and_all_vocabularies(width, vocabulary):
    random = np.random.default_rng(width)
    ids = np.concatenate([random.integers(0, vocabulary, (4, width)), np.minimum(random.zipf(1.3, (4, width)) - 1, vocabulary - 1)])
    assert np.array_equal(coder.decode_blocks(coder.encode_blocks(ids, vocabulary), width, vocabulary), ids)


def test_blocks_are_independent():
    ids = np.minimum(np.random.default_rng(3).zipf(1.2, (9, 700)), 50256)
    alone = [coder.encode_blocks(ids[i:i + 1], 50257)[0] for i in range(9)]
    assert all(np.array_equal(a, b) for a, b in zip(alone, coder.encode_blocks(ids, 50257), strict=True))


def test_mixed_orders_are_smaller_than_general_compression(spark):
    texts = [r["text"] or "" for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").orderBy("doc_id").select("text").collect()]
    theirs = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = np.concatenate([e.ids + [2] for e in theirs.encode_batch(texts, add_special_tokens=False)])
    blocks = ids[:len(ids) // coder.BLOCK * coder.BLOCK].reshape(-1, coder.BLOCK)
    words = coder.encode_blocks(blocks, 50257)
    general = [lzma.compress(b.astype("<u2").tobytes(), format=lzma.FORMAT_RAW, filters=[{"id": lzma.FILTER_LZMA2, "preset": 9}]) for b in blocks]
    assert 4 * sum(map(len, words)) < 0.95 * sum(map(len, general))
    assert np.array_equal(coder.decode_blocks(words, coder.BLOCK, 50257), blocks)


def test_damaged_words_still_give_ids_of_the_vocabulary():
    words = coder.encode_blocks(np.minimum(np.random.default_rng(4).zipf(1.2, (5, 900)), 999), 1000)
    for w in words:
        w[len(w) // 3] ^= 0x5A5A
    with np.errstate(all="ignore"):
        got = coder.decode_blocks(words, 900, 1000)
    assert got.shape == (5, 900) and got.max() < 1000


def test_coder_compresses_what_repeats():
    ids = np.tile(np.random.default_rng(0).integers(0, 50257, 64), (2, 64))
    assert sum(map(len, coder.encode_blocks(ids, 50257))) * 32 < ids.size


def test_damaged_segment_is_noticed():
    data = token_files.to_payloads([np.arange(5000)], 50257)[0]
    assert np.array_equal(token_files.from_payloads([data])[0], np.arange(5000))
    broken = bytearray(data)
    broken[-100] ^= 1
    with pytest.raises(ValueError):
        token_files.from_payloads([bytes(broken)])


def expected(name, end_id=None):
    theirs = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda t: theirs.encode(t or "", add_special_tokens=False).ids + ([] if end_id is None else [end_id])


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_token_files(spark, tmp_path):
    docs, name = table(spark), "byte_bpe_50k.json"
    path = f"file://{tmp_path}/files"
    token_files.write_token_files(docs, path, public_tokenizers.path(name), byte_level=True)
    rows = token_files.read_token_files(spark, path, token_files.checksums, "ids_crc32 long").collect()
    rows.sort(key=lambda r: r["start"])
    order = sorted(docs.collect(), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0))
    at, encode = 0, expected(name, 2)
    for row, doc in zip(rows, order, strict=True):
        ids = encode(doc["text"])
        assert (row["doc_id"], row["start"], row["n_tokens"], row["ids_crc32"]) == (doc["doc_id"], at, len(ids), crc(ids))
        at += len(ids)
    back = token_files.read_token_files(spark, path).where("doc_id = 16").first()
    assert back["ids"] == encode(ODD[16])


def test_token_files_of_an_empty_table(spark, tmp_path):
    path = f"file://{tmp_path}/none"
    token_files.write_token_files(table(spark).limit(0), path, public_tokenizers.path("byte_bpe_50k.json"), byte_level=True)
    assert token_files.read_token_files(spark, path).collect() == []


def test_counts(spark):
    docs, name = table(spark), "word_bpe_49k.json"
    encode = expected(name)
    rows = token_counts.count_tokens(docs, public_tokenizers.path(name), limit=10).collect()
    wanted = sorted((r["doc_id"] or -1, len((r["text"] or "").encode()), len(encode(r["text"])), len(encode(r["text"])) > 10)
                    for r in docs.collect())
    assert sorted((r["doc_id"] or -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows) == wanted
    assert token_counts.count_tokens(docs.limit(0), public_tokenizers.path(name)).count() == 0


def test_packing(spark):
    docs, name = table(spark), "word_bpe_49k.json"
    encode = expected(name, 2)
    pieces = packing.pack_documents(docs, public_tokenizers.path(name), longest=64).collect()
    assert len({p["sequence_id"] for p in pieces}) == len(pieces) and all(p["offset"] == 0 for p in pieces)
    for doc in docs.dropDuplicates().collect():
        ids = encode(doc["text"])
        own = sorted((p for p in pieces if p["doc_id"] == doc["doc_id"]), key=lambda p: (p["start"], p["sequence_id"]))
        copies = 2 if doc["doc_id"] == 5 else 1
        assert sum((p["ids"] for p in own[::copies]), []) == ids and all(p["doc_tokens"] == len(ids) for p in own)
        for p in own:
            assert p["length"] == 1 << p["bucket"] == len(p["ids"]) <= 64
        assert len(own) == copies * (len(ids) // 64 + bin(len(ids) % 64).count("1"))
    sums = packing.with_checksums(packing.pack_documents(docs, public_tokenizers.path(name), longest=64)).collect()
    assert sorted(r["ids_crc32"] for r in sums) == sorted(crc(p["ids"]) for p in pieces)
    assert packing.pack_documents(docs.limit(0), public_tokenizers.path(name)).count() == 0


def test_buckets_hold_one_length_each(spark, tmp_path):
    pieces = packing.pack_documents(table(spark), public_tokenizers.path("word_bpe_49k.json"))
    packing.write_buckets(pieces, f"file://{tmp_path}/buckets")
    for r in spark.read.parquet(f"file://{tmp_path}/buckets").selectExpr("bucket", "size(ids) as n").distinct().collect():
        assert r["n"] == 1 << r["bucket"]
