"""Exact and near duplicate texts.

Groups are kept as flat membership tables, never as one row per group: a group of copies
may hold a large share of all texts. Near-duplicate candidates are kept in factored form,
as bucket memberships with an anchor per bucket, never as all pairs of a bucket.
"""

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.constants import LSH_BANDS, LSH_ROWS, MINHASH_PERMUTATIONS
from duskwatch.functions.base import words
from duskwatch.operators.components import connected_components
from duskwatch.operators.counts import counter_rows, five_numbers
from duskwatch.operators.skew import join_counted
from duskwatch.session import materialize

PRIME = (1 << 31) - 1
BUCKET = ["band", "k1", "k2", "k3"]
#: Tokens that a Python worker signs at a time: their permuted values take at most 512 bytes each.
PIECE = 1 << 16


def text_key(text: Column) -> Column:
    """Identity of a text that is short enough to shuffle."""
    return F.sha2(text, 256)


# --- exact duplicates ------------------------------------------------------------------

def exact_index(preprocessed: DataFrame, id_col: str = "object_name") -> DataFrame:
    """Membership ``(text_key, id)`` of all non-empty texts; the texts are not shuffled."""
    return preprocessed.where("text <> ''").select(text_key(F.col("text")).alias("text_key"), id_col)


def exact_duplicates(index: DataFrame, id_col: str = "object_name") -> DataFrame:
    """Per distinct text its first id and the number of copies."""
    return index.groupBy("text_key").agg(F.min(id_col).alias("first_id"), F.count("*").alias("n_copies"))


def incremental_exact(old: DataFrame | None, new: DataFrame, distinct: bool = False) -> DataFrame:
    """Previous memberships plus those of this run.

    An id seen in both runs is listed twice, as in a plain append, unless ``distinct``.
    """
    merged = new if old is None else old.select(*new.columns).unionByName(new)
    return merged.distinct() if distinct else merged


def distinct_texts(preprocessed: DataFrame, id_col: str = "object_name") -> DataFrame:
    """One row ``(id, text_key, text, n_copies)`` per distinct text, keyed by its first id."""
    keyed = preprocessed.where("text <> ''").select(id_col, text_key(F.col("text")).alias("text_key"), "text")
    firsts = exact_duplicates(keyed, id_col).withColumnRenamed("first_id", id_col)
    # Both sides grow with the data: a merge join, so that the texts are never broadcast.
    # An id may come with several texts, and a text several times with its first id.
    found = keyed.hint("merge").join(firsts, [id_col, "text_key"])
    return found.dropDuplicates([id_col, "text_key"]).select(id_col, "text_key", "text", "n_copies")


# --- signatures ------------------------------------------------------------------------

def token_set(text: Column) -> Column:
    """Distinct white-space separated words."""
    return F.array_distinct(words(text))


def permutation(i: int) -> tuple[int, int]:
    """Multiplier and offset of permutation ``i``: derived from digests of its number."""
    def number(name: str) -> int:
        return int(hashlib.md5(f"{name}{i}".encode()).hexdigest()[:8], 16)

    return number("a") % (PRIME - 1) + 1, number("b") % PRIME


def _signature_udf(size: int):
    # Plain values only: the function travels to executors that need not have this package.
    prime, piece, lines = np.uint64(PRIME), PIECE, 256
    a, b = (np.array(column, dtype=np.uint64) for column in zip(*[permutation(i) for i in range(size)], strict=True))

    @F.arrow_udf("array<bigint>")
    def signature(tokens: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
        bounds = np.concatenate(([0], np.cumsum(lengths, dtype=np.int64)))
        flat = tokens.flatten()
        result = np.full((len(tokens), size), prime, dtype=np.int64)
        for start in range(0, len(flat), piece):
            coded = flat.slice(start, piece).dictionary_encode()
            digests = b"".join([hashlib.md5(word).digest()[:4] for word in coded.dictionary.cast(pa.binary()).to_pylist()])
            hashes = np.frombuffer(digests, dtype=">u4").astype(np.uint64) % prime
            values = np.empty((len(hashes), size), dtype=np.uint32)
            for i in range(0, len(hashes), lines):
                # (a * h + b) mod 2^31 - 1: high bits folded onto the low ones leave less than twice the prime
                x = hashes[i:i + lines, None] * a
                x += b
                high = x >> np.uint64(31)
                x &= prime
                x += high
                folded = x.astype(np.uint32)
                np.minimum(folded, folded - np.uint32(prime), out=values[i:i + lines])
            codes = coded.indices.to_numpy()
            end = start + len(codes)
            row = int(np.searchsorted(bounds, start, "right")) - 1
            while row < len(tokens) and bounds[row] < end:
                own = codes[max(bounds[row] - start, 0):bounds[row + 1] - start]
                if len(own):
                    np.minimum(result[row], values.take(own, axis=0).min(axis=0), out=result[row])
                row += 1
        return pa.ListArray.from_arrays(np.arange(len(tokens) + 1, dtype=np.int32) * size, result.ravel())

    return signature


def minhash_signature(text: Column, size: int = MINHASH_PERMUTATIONS) -> Column:
    """MinHash signature of the token set, ``size`` permutations long.

    Tokens are split by built-in expressions. Arrow batches are taken in pieces of bounded size:
    a word of a piece is hashed and permuted once, whatever number of its texts hold it, and a
    text's minima are taken over the rows of its words. Null has no tokens.
    """
    return _signature_udf(size)(token_set(text))


def band_keys(signature: Column, bands: int = LSH_BANDS, rows: int = LSH_ROWS) -> Column:
    """One struct per band with its five minima packed into three integers, without loss."""
    assert rows == 5, "the packing holds five 31-bit minima"

    def key(b: int) -> Column:
        m = [F.get(signature, F.lit(b * rows + i)) for i in range(rows)]
        return F.struct(
            F.lit(b).alias("band"),
            (F.shiftleft(m[0], 31) + m[1]).alias("k1"), (F.shiftleft(m[2], 31) + m[3]).alias("k2"), m[4].alias("k3"))

    return F.array(*[key(b) for b in range(bands)])


def signatures(texts: DataFrame, id_col: str, size: int = LSH_BANDS * LSH_ROWS) -> DataFrame:
    return texts.select(id_col, minhash_signature(F.col("text"), size).alias("signature"))


# --- candidates ------------------------------------------------------------------------

def bucket_members(texts: DataFrame, id_col: str) -> DataFrame:
    """``(id, band, key)``: the bucket of every text in every band."""
    return signatures(texts, id_col).select(id_col, F.inline(band_keys(F.col("signature"))))


def buckets(members: DataFrame, id_col: str) -> DataFrame:
    """Buckets shared by at least two texts, with size and least id as anchor."""
    return members.groupBy(*BUCKET).agg(
        F.min(id_col).alias("anchor"), F.count("*").alias("n_members")).where("n_members > 1")


def lsh_query(members: DataFrame, id_col: str) -> DataFrame:
    """For each text the shared buckets it falls into: what an index query returns, factored.

    The texts colliding with a text are the members of its buckets. There is no similarity
    check.
    """
    shared = buckets(members, id_col)
    return join_counted(members, shared, BUCKET, counts=shared.withColumnRenamed("n_members", "n"))


def lsh_candidates(members: DataFrame, id_col: str) -> DataFrame:
    """Candidate links ``(id, anchor)``: every member of a bucket to the bucket's least text.

    They connect exactly the texts that all pairs of the buckets would connect.
    """
    found = lsh_query(members, id_col)
    return found.where(F.col(id_col) != F.col("anchor")).select(id_col, "anchor").distinct()


# --- groups ----------------------------------------------------------------------------

def near_groups(texts: DataFrame, id_col: str) -> DataFrame:
    """``(id, group_id)`` for every text: texts linked by shared buckets form a group."""
    members = materialize(bucket_members(texts, id_col), "buckets")
    edges = lsh_candidates(members, id_col).select(F.col(id_col).alias("u"), F.col("anchor").alias("v"))
    grouped = connected_components(edges).select(F.col("node").alias(id_col), F.col("component").alias("group_id"))
    return texts.select(id_col).join(grouped, id_col, "left").select(
        id_col, F.coalesce("group_id", id_col).alias("group_id"))


def first_claim(claims: DataFrame, member: str = "member", group: str = "group_id") -> DataFrame:
    """Each member belongs to the first group that lists it."""
    return claims.groupBy(member).agg(F.min(group).alias(group))


def representatives(groups: DataFrame, texts: DataFrame, id_col: str, tie: str | None = None) -> DataFrame:
    """Per group its longest text (ties: least ``tie``, by default the id) and its size."""
    facts = texts.select(
        id_col, (-F.length("text")).alias("rank"), F.col(tie or id_col).alias("tie"), F.col(id_col).alias("best_id"))
    longest = groups.join(facts, id_col).groupBy("group_id").agg(
        F.min(F.struct("rank", "tie", "best_id")).alias("best"), F.count("*").alias("n_members"))
    return longest.select("group_id", F.col("best.best_id").alias("representative"), "n_members")


def near_table(
    groups: DataFrame, texts: DataFrame, id_col: str, tie: str | None = None
) -> DataFrame:
    """``(id, group_id, representative, n_members)`` for every text."""
    reps = representatives(groups, texts, id_col, tie)
    return join_counted(groups, reps, "group_id", counts=reps.withColumnRenamed("n_members", "n"))


def unique_texts(near: DataFrame, id_col: str) -> DataFrame:
    """The representative texts only."""
    return near.where(F.col(id_col) == F.col("representative")).select("representative", "n_members")


def jaccard_to_representative(
    near: DataFrame, texts: DataFrame, id_col: str
) -> DataFrame:
    """Similarity of every grouped text with its group's representative: one row per text."""
    tokens = texts.select(id_col, token_set(F.col("text")).alias("tokens"))
    rep_tokens = near.where(F.col(id_col) == F.col("representative")).join(tokens, id_col).select(
        "representative", "n_members", F.col("tokens").alias("rep_tokens"))
    members = near.where(F.col(id_col) != F.col("representative")).select(id_col, "representative").join(tokens, id_col)
    pairs = join_counted(
        members, rep_tokens, "representative", counts=rep_tokens.select("representative", F.col("n_members").alias("n")))
    shared = F.size(F.array_intersect("tokens", "rep_tokens"))
    return pairs.select(
        id_col, "representative",
        (shared / (F.size("tokens") + F.size("rep_tokens") - shared)).alias("jaccard"))


def union_if_intersecting(a: Column, b: Column) -> Column:
    """Union of two member lists that share an element, else an empty list."""
    return F.when(F.arrays_overlap(a, b), F.array_union(a, b)).otherwise(F.array().cast("array<string>"))


# --- labels and counts -----------------------------------------------------------------

def mirror_labels(index: DataFrame, near: DataFrame, id_col: str) -> DataFrame:
    """``unique``, ``near mirror`` or ``exact mirror`` for every id of the exact index.

    ``near`` lists each distinct text under its first id; any later copy is an exact mirror.
    """
    firsts = exact_duplicates(index, id_col)
    label = F.when(F.col(id_col) == F.col("representative"), "unique").otherwise("near mirror")
    labelled = firsts.join(
        near.select(F.col(id_col).alias("first_id"), label.alias("first_label")), "first_id")
    rows = join_counted(index, labelled, "text_key", counts=firsts.withColumnRenamed("n_copies", "n"))
    return rows.select(
        id_col,
        F.when(F.col(id_col) == F.col("first_id"), F.col("first_label")).otherwise("exact mirror").alias("label"))


def dedup_counts_new(labels: DataFrame) -> DataFrame:
    """This run's texts: total, exact mirrors, near mirrors, unique."""
    label = F.col("label")
    return counter_rows(labels.agg(
        F.count("*").alias("Total onions"),
        F.count_if(label == "exact mirror").alias("Exact mirrors"),
        F.count_if(label == "near mirror").alias("Near mirrors"),
        F.count_if(label == "unique").alias("Unique onions"),
    ))


def dedup_counts_total(exact: DataFrame, uniques: DataFrame) -> DataFrame:
    """Whole-version totals from copies per text and members per group."""
    copies = exact.agg(F.sum(F.col("n_copies") - 1).alias("e"))
    members = uniques.agg(F.sum("n_members").alias("m"), F.count("*").alias("u"))
    return counter_rows(copies.join(F.broadcast(members)).select(
        (F.col("e") + F.col("m")).alias("Total onions"),
        F.col("e").alias("Total exact mirrors"),
        (F.col("m") - F.col("u")).alias("Total near mirrors"),
        F.col("u").alias("Total unique onions"),
    ))


def instances_per_unique(uniques: DataFrame, exact: DataFrame) -> DataFrame:
    """Per representative: group members plus further exact copies of the representative."""
    return uniques.join(exact.withColumnRenamed("first_id", "representative"), "representative").select(
        "representative", (F.col("n_members") + F.col("n_copies") - 1).alias("instances"))


def instance_boxplot(instances: DataFrame) -> DataFrame:
    return instances.agg(*five_numbers(F.col("instances")))
