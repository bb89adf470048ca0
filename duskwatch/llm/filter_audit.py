"""How filters interact: what each removes, repeats or is alone to find, in every order they can run in."""

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.scratch import stage
from duskwatch.llm.shipping import map_batches, ship
from duskwatch.llm.words import mix, runs_of_rows, text_bytes, word_table, words
from duskwatch.operators.skew import join_counted

#: A: few words; B: few distinct words; C: many capitals; D: a symbol; E: an earlier document's text.
FILTERS = "ABCDE"
ORDERS = ["".join(order) for order in permutations(FILTERS)]
SYMBOLS = b"#$%&*|"

_WORDS = word_table(b"\x20\x09\x0a\x0b\x0c\x0d", lower=False)
#: Outcomes of a step that have a field of their own.
_OUTCOMES = ("kept", "removed", "redundant", "good_lost", "toxic_lost")
#: Bits of a field. A count of rows has at most 63, so the sum of a field never reaches the next one.
_WIDTH = 64

SCHEMA = ("part string, filter_order string, step int, kept long, removed long, redundant long, unique_fails long, "
          "good_lost long, toxic_lost long, shapley long")


# --- masks -----------------------------------------------------------------------------

def _counts(marked: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    return np.diff(np.searchsorted(np.flatnonzero(marked), offsets))


def text_masks(column: pa.Array) -> np.ndarray:
    """Per text the bits of the filters A to D that it fails; a null counts as empty."""
    data, offsets = text_bytes(column)
    size = len(offsets) - 1
    hashes, first = words(column, _WORDS)
    n_words = np.diff(first)
    text = np.repeat(np.arange(size, dtype=np.uint64), n_words)
    _, at = np.unique(mix(hashes ^ mix(text + np.uint64(1))), return_index=True)
    n_distinct = np.bincount(text[at].astype(np.int64), minlength=size)
    n_chars = np.diff(offsets) - _counts((data & 0xC0) == 0x80, offsets)
    n_capitals = _counts((data >= 65) & (data <= 90), offsets)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    failed = (n_words < 200, 100 * n_distinct < 50 * n_words, 100 * n_capitals > 2 * n_chars, _counts(symbol[data], offsets) > 0)
    return sum(f.astype(np.int32) << i for i, f in enumerate(failed))


def _masked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in runs_of_rows(batch, 2):
            data, offsets = text_bytes(rows.column(2))
            keys = [hashlib.blake2b(data[a:b], digest_size=16).digest() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [rows.column(0), rows.column(1), pa.array(keys, pa.binary()), pa.array(text_masks(rows.column(2)))],
                ["doc_id", "part", "text_key", "mask"])


def mask_counts(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """``(part, mask, good, toxic, n)``: rows per combination of failed filters and labels.

    Texts are read once and not shuffled; from then on rows hold a hash of the text. A row
    fails E if its id is greater than the least id of its text: rows that match ``(text,
    least id)`` are told apart by a join on both, so copies of one text spread over all tasks.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.col(text_col).cast("string").alias("text"))
    masked = map_batches(rows, _masked, "doc_id long, part string, text_key binary, mask int")
    masked = stage(masked.groupBy("doc_id", "part", "text_key", "mask").agg(F.count("*").alias("n")), "filter_masks")
    firsts = masked.where("doc_id is not null").groupBy("text_key").agg(F.min("doc_id").alias("doc_id"))
    masked = masked.join(firsts.withColumn("first", F.lit(True)), ["text_key", "doc_id"], "left")
    repeated = F.col("doc_id").isNotNull() & F.col("first").isNull()
    masked = masked.select("doc_id", "part", "mask", repeated.alias("repeated"), "n").groupBy(
        "doc_id", "part", "mask", "repeated").agg(F.sum("n").alias("n"))

    def has(column: str):
        return F.max(F.coalesce(F.col(column) == 1, F.lit(False))).alias(column)

    judged = labels.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).cast("long").alias("doc_id")).agg(
        has("quality"), has("toxic"))
    rows = join_counted(masked, judged, "doc_id", "left")
    return rows.groupBy(
        "part", (F.col("mask") + F.when(F.col("repeated"), 16).otherwise(0)).alias("mask"),
        F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    ).agg(F.sum("n").alias("n"))


# --- packed counters -------------------------------------------------------------------

@lru_cache(maxsize=4 << len(FILTERS))
def packed(mask: int, good: bool, toxic: bool) -> int:
    """What a row with this mask adds to all counters, as one integer of 64-bit fields.

    The fields are the outcomes of every step of every order, then whether a filter alone fails.
    """
    fields = np.zeros((len(ORDERS), len(FILTERS), len(_OUTCOMES)), "<u8")
    for o, order in enumerate(ORDERS):
        gone = False
        for s, name in enumerate(order):
            fails = bool(mask >> FILTERS.index(name) & 1)
            here = fails and not gone
            fields[o, s] = (not gone and not fails, here, fails and gone, here and good, here and toxic)
            gone |= fails
    alone = np.array([mask == 1 << f for f in range(len(FILTERS))], "<u8")
    return int.from_bytes(fields.tobytes() + alone.tobytes(), "little")


def unpacked(total: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts by (order, step, outcome) and rows that only one filter fails."""
    steps = len(ORDERS) * len(FILTERS) * len(_OUTCOMES)
    data = total.to_bytes((steps + len(FILTERS)) * _WIDTH // 8, "little")
    fields = np.frombuffer(data, "<u8").astype(np.int64)
    return fields[:steps].reshape(len(ORDERS), len(FILTERS), len(_OUTCOMES)), fields[steps:]


def _steps(table: pa.Table) -> pa.Table:
    """All steps of all orders of one part, from its at most 128 counts."""
    total = sum(r["n"] * packed(r["mask"], r["good"], r["toxic"]) for r in table.to_pylist())
    counts, alone = unpacked(total)
    filters = np.array([[FILTERS.index(name) for name in order] for order in ORDERS])
    removed = counts[:, :, _OUTCOMES.index("removed")]
    shapley = np.array([removed[filters == f].sum() for f in range(len(FILTERS))])
    n = filters.size
    by_step = dict(zip(_OUTCOMES, counts.reshape(n, -1).T, strict=True))
    columns = {
        "part": pa.array([table.column("part")[0].as_py()] * n), "filter_order": pa.array(np.repeat(ORDERS, len(FILTERS))),
        "step": pa.array(np.tile(np.arange(1, len(FILTERS) + 1, dtype=np.int32), len(ORDERS))),
        **{name: pa.array(by_step[name]) for name in ("kept", "removed", "redundant")},
        "unique_fails": pa.array(alone[filters.ravel()]),
        **{name: pa.array(by_step[name]) for name in ("good_lost", "toxic_lost")},
        "shapley": pa.array(shapley[filters.ravel()]),
    }
    return pa.table(columns)


def audit_filters(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source"
) -> DataFrame:
    """``(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley)``.

    One row per part, order of the five filters and step, zeros included. Every combination of
    failed filters and labels has one big integer whose 64-bit fields hold its outcome at all
    600 steps; a part's counters are the sum of its rows' integers. Rows are counted per
    combination first (at most 128 for each part), so a part of any size is summed in one call.

    A null text counts as empty (fails A only), a null part as the empty part. A null id has no
    label, never fails E and makes no other row fail it; rows of one id and text do not fail E for
    each other. Each repeated row counts. With several label rows for an id, one with the value 1
    is enough. An empty table gives no rows. Other columns are ignored.
    """
    ship(docs.sparkSession)
    counts = mask_counts(docs, labels, id_col, text_col, part_col)
    return counts.groupBy("part").applyInArrow(_steps, SCHEMA)
