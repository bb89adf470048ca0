"""SimHash fingerprints of documents, and the search for all fingerprints within a Hamming radius."""

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.scratch import stage
from duskwatch.llm.shipping import map_batches, whole_groups
from duskwatch.llm.words import SPACED, mix, runs_of_rows, words
from duskwatch.operators.skew import PARTS_PER_PARTITION, heavy_keys, join_counted

#: Bits of a fingerprint, and of the distance that the search allows.
BITS, RADIUS = 128, 3
#: Two fingerprints within the radius agree on at least two of five blocks: a table for every choice of two.
BLOCKS = RADIUS + 2
_EDGES = np.linspace(0, BITS, BLOCKS + 1).round().astype(int)
TABLES = list(combinations(range(BLOCKS), BLOCKS - RADIUS))
#: A key holds at most this many bits of a fingerprint, and the table's number above them.
_KEY_BITS = 56

#: Terms are words and pairs of neighbouring words; a pair weighs twice as much.
_PAIR_WEIGHT = 2
_SECOND = np.uint64(0xD1B54A32D192ED03)
#: Terms whose bits are added in one go; 32-bit floats hold these sums exactly.
_TERMS_AT_ONCE = 1 << 14


# --- fingerprints ----------------------------------------------------------------------

def fingerprints(column: pa.Array) -> np.ndarray:
    """One row of ``BITS / 8`` bytes per text; a null counts as empty, a text without words has no bit set.

    Every distinct term of a text votes for or against each bit by the bits of its hash. A term
    that occurs ``c`` times has the weight ``1 + floor(log2 c)``, twice as much for a pair.
    """
    hashes, first = words(column, SPACED)
    size, counts = len(column), np.diff(first)
    text = np.repeat(np.arange(size), counts)
    at = np.flatnonzero(text[1:] == text[:-1])
    terms = np.concatenate([hashes, mix(mix(hashes[at]) + hashes[at + 1])])
    text = np.concatenate([text, text[at]])
    weight = np.ones(len(terms), np.int64)
    weight[len(hashes):] = _PAIR_WEIGHT
    _, example, times = np.unique(mix(terms ^ mix(text.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
    example, times = (x[np.argsort(text[example], kind="stable")] for x in (example, times))
    terms, text = terms[example], text[example]
    weight = (weight[example] * (1 + np.floor(np.log2(times)))).astype(np.float32)
    ends = np.searchsorted(text, np.arange(size + 1))
    out = np.zeros((size, BITS // 8), np.uint8)
    for i in np.flatnonzero(counts):
        votes = np.zeros(BITS, np.int64)
        for a in range(ends[i], ends[i + 1], _TERMS_AT_ONCE):
            b = min(a + _TERMS_AT_ONCE, ends[i + 1])
            both = np.stack([mix(terms[a:b]), mix(terms[a:b] + _SECOND)], 1).view(np.uint8)
            bits = np.unpackbits(both, axis=1).astype(np.float32)
            votes += (2 * (weight[a:b] @ bits) - weight[a:b].sum()).astype(np.int64)
        out[i] = np.packbits(votes > 0)
    return out


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of fingerprints."""
    return np.bitwise_count((a ^ b).view(np.uint64)).sum(-1, dtype=np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cosine of the angle that the share of differing bits stands for, at least 0."""
    return np.maximum(0.0, np.cos(np.pi * distance(a, b) / BITS))


def _hex(prints: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes().hex() for row in prints], pa.string())


# --- documents and the text after them -------------------------------------------------

def edited(text: str, following: str) -> str:
    """``text`` with its last ``floor(n / 2)`` characters replaced by the first as many of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


_KEPT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_STAGED = f"{_RESULT}, edge int, part int, text string"


def _compared(ids: pa.Array, texts: list[str], prints: np.ndarray, following: list[str], next_prints: np.ndarray) -> list[pa.Array]:
    new = [edited(a, b) for a, b in zip(texts, following, strict=True)]
    new_prints = fingerprints(pa.array(new, pa.large_string()))
    return [
        ids, pa.array([len(t) for t in texts], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in new], pa.string()),
        _hex(prints), _hex(new_prints), pa.array(likeness(prints, new_prints)), pa.array(likeness(prints, next_prints))]


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one range in order, each compared with the next. The range's first text and its last row are edges."""
    part, held = TaskContext.get().partitionId(), None

    def edge(kind: int, ids: pa.Array, text: str, prints: np.ndarray) -> pa.RecordBatch:
        nothing = [pa.nulls(1, pa.string()), pa.nulls(1, pa.float64())]
        return pa.RecordBatch.from_arrays([
            ids, pa.array([len(text)], pa.int64()), nothing[0], _hex(prints), nothing[0], nothing[1], nothing[1],
            pa.array([kind], pa.int32()), pa.array([part], pa.int32()), pa.array([text], pa.string())], [*_KEPT, "edge", "part", "text"])

    for batch in batches:
        for rows in runs_of_rows(batch, 1):
            ids, texts = rows.column(0), rows.column(1).to_pylist()
            prints = fingerprints(rows.column(1))
            if held is None:
                yield edge(1, ids.slice(0, 1), texts[0], prints[:1])
            else:
                ids = pa.concat_arrays([held[0], ids])
                texts, prints = [held[1], *texts], np.concatenate([held[2], prints])
            n = len(texts) - 1
            if n:
                found = _compared(ids.slice(0, n), texts[:n], prints[:n], texts[1:], prints[1:])
                yield pa.RecordBatch.from_arrays(
                    [*found, pa.array(np.zeros(n, np.int32)), pa.array(np.full(n, part, np.int32)), pa.nulls(n, pa.string())],
                    [*_KEPT, "edge", "part", "text"])
            held = ids.slice(n, 1), texts[n], prints[n:]
    if held:
        yield edge(2, *held)


def _over_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Last rows of ranges, compared with the first text of the next range."""
    for batch in batches:
        for rows in runs_of_rows(batch, 1):
            prints, next_prints = fingerprints(rows.column(1)), fingerprints(rows.column(2))
            texts, following = rows.column(1).to_pylist(), rows.column(2).to_pylist()
            yield pa.RecordBatch.from_arrays(_compared(rows.column(0), texts, prints, following, next_prints), _KEPT)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprint of every document, of its edited text, and their likeness to it and to the next document.

    The next document is the one with the next smaller id; rows with a null id come last, rows of
    one id in the order of a hash of the text, then of their place in the table; the first
    document follows the last. Texts are shuffled once, into ranges that cut through rows of one
    id too; a task walks over its range. Last rows of ranges meet the first text of the next range
    in a join of one row per range.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumns({"hash": F.xxhash64("text"), "place": F.monotonically_increasing_id()})
    order = [F.desc_nulls_last("doc_id"), F.asc("hash"), F.asc("place")]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    found = stage(map_batches(ranged, _in_order, _STAGED), "fingerprints")

    heads, tails = found.where("edge = 1"), found.where("edge = 2")
    by_part = Window.orderBy("part")
    following = heads.select("part", F.coalesce(
        F.lead("part").over(by_part), F.min("part").over(by_part.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    ).alias("next_part"))  # one row per range
    pairs = tails.join(following, "part").join(heads.select(F.col("part").alias("next_part"), F.col("text").alias("next_text")), "next_part")
    over = map_batches(pairs.select("doc_id", "text", "next_text"), _over_edges, _RESULT)
    return found.where("edge = 0").select(*_KEPT).union(over)


# --- search ----------------------------------------------------------------------------

def _read(column: pa.Array) -> np.ndarray:
    return np.frombuffer(bytes.fromhex("".join(column.to_pylist())), np.uint8).reshape(len(column), BITS // 8)


def _equal_blocks(difference: np.ndarray) -> np.ndarray:
    """For XORs of fingerprints, by block: whether no bit of the block differs."""
    bits = np.unpackbits(difference, axis=-1)
    return np.stack([~bits[..., a:b].any(-1) for a, b in zip(_EDGES[:-1], _EDGES[1:], strict=True)], -1)


def _table_keys(prints: np.ndarray) -> np.ndarray:
    """Per fingerprint and table a number made of the table and the bits of its blocks, without loss."""
    bits = np.unpackbits(prints, axis=1).astype(np.int64)
    keys = np.zeros((len(prints), len(TABLES)), np.int64)
    for t, chosen in enumerate(TABLES):
        for block in chosen:
            for i in range(_EDGES[block], _EDGES[block + 1]):
                keys[:, t] = (keys[:, t] << 1) | bits[:, i]
        keys[:, t] |= t << _KEY_BITS
    return keys


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _table_keys(_read(batch.column(0)))
        rows = pa.array(np.repeat(np.arange(batch.num_rows), len(TABLES)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys.ravel()), *(batch.column(i).take(rows) for i in range(3))], ["key", "fingerprint", "n", "asked"])


def _matches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per query fingerprint and group the rows within the radius that no earlier table has found."""
    for batch in whole_groups(batches, 2):
        keys, salts, asked = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 4))
        prints, n = _read(batch.column(2)), batch.column(3).to_numpy()
        first = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (salts[1:] != salts[:-1])]))
        ends = np.append(first[1:], len(keys))
        queries, counts = [], []
        for a in np.unique(np.searchsorted(first, np.flatnonzero(asked), "right") - 1):
            low, high = first[a], ends[a]
            own = low + np.flatnonzero(asked[low:high])
            other = low + np.flatnonzero(~asked[low:high])
            table = int(keys[low]) >> _KEY_BITS
            found = np.zeros(len(own), np.int64)
            for i in range(0, len(other), 4096):
                part = prints[other[i:i + 4096]]
                for j, query in enumerate(own):
                    near = np.flatnonzero(distance(part, prints[query]) <= RADIUS)
                    if len(near):
                        equal = _equal_blocks(part[near] ^ prints[query])
                        before = np.zeros(len(near), bool)
                        for chosen in TABLES[:table]:
                            before |= equal[:, list(chosen)].all(1)
                        found[j] += n[other[i:i + 4096]][near[~before]].sum()
            queries.append(own[found > 0])
            counts.append(found[found > 0])
        at = np.concatenate([np.zeros(0, np.int64), *queries])
        yield pa.RecordBatch.from_arrays(
            [batch.column(2).take(pa.array(at)), pa.array(np.concatenate([np.zeros(0, np.int64), *counts]))], ["fingerprint", "n_near"])


def search(prints: DataFrame, queries: DataFrame) -> DataFrame:
    """``(fingerprint, n_near)``: how many rows of ``prints`` are within ``RADIUS`` bits of each distinct query.

    Both tables have a ``fingerprint`` column, hexadecimal. Equal ones are counted and looked up
    once. Every distinct fingerprint is entered in ten tables, under the bits of two of its five
    blocks; queries meet the entries of their ten keys inside a task and only counts leave it. A
    key with many entries is dealt over salts, and its queries are repeated for each.
    """
    spark = prints.sparkSession
    base = stage(prints.groupBy("fingerprint").agg(F.count("*").alias("n"), F.lit(False).alias("asked")), "distinct_prints")
    asked = queries.select("fingerprint").distinct().select("fingerprint", F.lit(0).cast("long").alias("n"), F.lit(True).alias("asked"))
    schema = "key long, fingerprint string, n long, asked boolean"
    entries = map_batches(base, _entries, schema)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    heavy = F.broadcast(heavy_keys(entries.groupBy("key").agg(F.count("*").alias("n")), ["key"], PARTS_PER_PARTITION * parts))
    salts = F.coalesce("_salts", F.lit(1))
    dealt = entries.join(heavy, "key", "left").withColumn("salt", F.pmod(F.xxhash64("fingerprint"), salts).cast("int"))
    repeated = map_batches(asked, _entries, schema).join(heavy, "key", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), salts - 1)))
    columns = ["key", "salt", "fingerprint", "n", "asked"]
    met = dealt.select(*columns).union(repeated.select(*columns)).repartition(parts, "key", "salt").sortWithinPartitions("key", "salt")
    found = map_batches(met, _matches, "fingerprint string, n_near long")
    return found.groupBy("fingerprint").agg(F.sum("n_near").alias("n_near"))


def fingerprint_documents(docs: DataFrame, every: int = 50, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, n_near)``.

    One row per row of ``docs``. ``n_near`` says, for ids divisible by ``every``, how many other
    rows have a fingerprint within ``RADIUS`` bits, found in the block tables of all documents;
    it is null for other ids and a null id.

    A null text counts as empty; texts without words have the fingerprint 0 and are like each
    other. Equal texts have equal fingerprints, whatever their length. Repeated rows are
    documents like others and next to each other. A single document is its own next one. An
    empty table gives no rows. Other columns are ignored.
    """
    found = stage(compare_with_next(docs, id_col, text_col), "compared_documents")
    is_query = F.coalesce(F.col("doc_id") % every == 0, F.lit(False))
    asked = found.where(is_query)
    near = stage(search(found, asked), "near_counts")
    rows = join_counted(asked, near.withColumn("n_near", F.col("n_near") - 1), "fingerprint", "left")
    rest = found.where(~is_query).withColumn("n_near", F.lit(None).cast("long"))
    return rows.select(*_KEPT, "n_near").union(rest.select(*_KEPT, "n_near"))
