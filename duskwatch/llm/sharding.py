"""Minimax contiguous partition of documents into shards of nearly equal bytes.

Equal texts form one atomic group; groups are ordered by 60 bits of the MD5 of their text. The
smallest feasible capacity is found by binary search, each capacity checked greedily, and the
groups are cut there. The driver only ever sees totals of key ranges: it starts with ``cells``
equal ranges, brackets capacity and cuts, and asks again for the ranges in which a cut can
still fall, each divided by ``split``, until those hold one group each. A round returns at most
a few times ``cells`` rows at any input size, and every round shrinks the bracket ``split``-fold.
"""

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from duskwatch.llm.scratch import stage

KEY_BITS = 60


def text_key(text: Column) -> Column:
    """60 bits of the MD5 of a text, as a non-negative long; a null text has key 0."""
    return F.coalesce(F.conv(F.substring(F.md5(text), 1, KEY_BITS // 4), 16, 10).cast("long"), F.lit(0).cast("long"))


def _greedy(prefix: np.ndarray, capacity: int, shards: int) -> np.ndarray:
    """End positions of ``shards`` runs filled greedily; stays in place before a cell that does not fit."""
    ends = np.zeros(shards, np.int64)
    at = 0
    for i in range(shards):
        at = int(np.searchsorted(prefix, prefix[at] + capacity, "right")) - 1
        ends[i] = at
    return ends


def smallest_capacity(sizes: np.ndarray, shards: int) -> tuple[int, np.ndarray]:
    """The smallest capacity that lets ``shards`` greedy runs hold all sizes in order, and the runs' ends."""
    prefix = np.concatenate([[0], np.cumsum(sizes.astype(np.int64))])
    low, high = -(-int(prefix[-1]) // shards), int(prefix[-1])
    while low < high:
        middle = (low + high) // 2
        if _greedy(prefix, middle, shards)[-1] == len(sizes):
            high = middle
        else:
            low = middle + 1
    return high, _greedy(prefix, high, shards)


def _ask(groups: DataFrame, ranges: list[tuple[int, int]], split: int) -> list[tuple[int, int, int, int, int]]:
    """Totals of the non-empty parts of key ranges: ``(low, high, bytes, largest group, groups)``, in key order.

    A range ``(low, width)`` is divided into ``split`` parts. Ranges ascend, their widths are powers of two.
    """
    spark = groups.sparkSession
    table = spark.createDataFrame([(lo, w, max(1, w // split)) for lo, w in ranges], "lo long, w long, part long")
    if len(ranges) == 1:
        lo, w = ranges[0]
        part = max(1, w // split)
        keyed = groups.select("bytes", F.lit(part).cast("long").alias("part"), (
            F.lit(lo) + F.floor((F.col("k") - lo) / part).cast("long") * part if part == 1 else
            F.expr(f"{lo} + (k - {lo}) div {part} * {part}")).alias("low"))
    else:
        width = min(w for _, w in ranges)  # all asked ranges of a round have one width
        keyed = groups.withColumn("lo", F.expr(f"k div {width} * {width}")).join(F.broadcast(table), "lo").select(
            "bytes", "part", F.expr("lo + (k - lo) div part * part").alias("low"))
    rows = keyed.groupBy("low", "part").agg(
        F.sum("bytes").alias("bytes"), F.max("bytes").alias("largest"), F.count("*").alias("n")).collect()
    return sorted((r["low"], r["low"] + r["part"], r["bytes"], r["largest"], r["n"]) for r in rows)


def minimax_cuts(groups: DataFrame, shards: int, cells: int = 16_384, split: int = 64) -> tuple[int, list[int]]:
    """The smallest shard capacity and the ``shards - 1`` keys at which a next shard begins.

    ``groups(k, bytes)`` holds one row per atomic group with distinct keys.
    """
    parts = _ask(groups, [(0, 1 << KEY_BITS)], cells)
    if not parts:
        return 0, [1 << KEY_BITS] * (shards - 1)
    while True:
        sizes = np.array([p[2] for p in parts], np.int64)
        prefix = np.concatenate([[0], np.cumsum(sizes)])
        high, ends = smallest_capacity(sizes, shards)  # feasible: ranges kept whole
        low = max(-(-int(prefix[-1]) // shards), max(p[3] for p in parts))
        least = _greedy(prefix, low, shards)  # no cut lies before these
        unsure = set()
        for i in range(shards - 1):
            most = int(np.searchsorted(prefix, min((i + 1) * high, prefix[-1]), "right"))
            unsure.update(j for j in range(int(least[i]), min(most + 1, len(parts))) if parts[j][4] > 1 and parts[j][1] - parts[j][0] > 1)
        if not unsure or low >= high:
            # A capacity that equals its lower bound is the smallest, whatever the ranges hold.
            starts = [parts[e][0] if e < len(parts) else 1 << KEY_BITS for e in ends[:-1]]
            return high, starts
        widest = max(parts[j][1] - parts[j][0] for j in unsure)
        chosen = [j for j in sorted(unsure) if parts[j][1] - parts[j][0] == widest]
        finer = _ask(groups, [(parts[j][0], widest) for j in chosen], split)
        kept = set(chosen)
        parts = sorted([p for j, p in enumerate(parts) if j not in kept] + finer)


def gapless(rows: DataFrame, group: str, spread: Column, order: list[str], name: str, cells: int = 1024) -> DataFrame:
    """Number the rows of each ``group`` from 0 without gaps, in tasks of a ``cells``-th of a group.

    ``group`` must have few values: the counts per group and cell are broadcast, at most
    ``groups * cells`` rows. ``spread`` deals rows to cells; ``order`` orders them inside a cell.
    """
    rows = rows.withColumn("_cell", F.pmod(F.xxhash64(spread), F.lit(cells)))
    counts = rows.groupBy(group, "_cell").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "_cell", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inside = F.row_number().over(Window.partitionBy(group, "_cell").orderBy(*order))
    return rows.withColumn("_inside", inside).join(F.broadcast(counts), [group, "_cell"]).withColumn(
        name, F.col("_base") + F.col("_inside") - 1).drop("_cell", "_inside", "_base")


def shard_documents(docs: DataFrame, shards: int = 16, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, size, text_crc32, law, shard, slot, grown_shard)``, one row per row of ``docs``.

    Size is the UTF-8 bytes of the text plus 1; a null text has size 1, the checksum of no bytes
    and a group with other null texts. Ties do not occur: equal texts, repeated rows too, share a
    group and thus a shard. Rows with a null id are kept. Fewer groups than shards leave shards
    empty; an empty table gives no rows. Other columns of ``docs`` are ignored.
    """
    text = F.col(text_col)
    rows = stage(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), text_key(text).alias("k"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(""))).alias("text_crc32")), "shard_rows")
    groups = stage(rows.groupBy("k").agg(F.sum("size").alias("bytes")), "shard_groups")
    _, starts = minimax_cuts(groups, shards)
    shard = sum((F.col("k") >= F.lit(s).cast("long")).cast("int") for s in starts) if starts else F.lit(0)
    numbered = gapless(rows.withColumn("shard", shard), "shard", F.struct("k", "doc_id"), ["k", "doc_id"], "slot")
    return numbered.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"))
