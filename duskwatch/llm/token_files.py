"""Token ids of documents in compressed files, in ascending document order, and back.

A file set is a Parquet folder with one row per segment: whole documents of together about
``SEGMENT_IDS`` ids (one longer document is a segment of its own), in order within a ``shard``,
a range of document ids. The payload holds independently coded blocks (``coder``) behind a header
with the vocabulary's size, the ids, and per block its 32-bit words and the CRC-32 of its ids.
"""

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from duskwatch.llm.coder import BLOCK, decode_blocks, encode_blocks
from duskwatch.llm.shipping import map_batches
from duskwatch.llm.tokens import encoder, texts_of

SEGMENT_IDS = 1 << 20
#: Ids that are coded together, in blocks side by side; bounds a task's memory.
BATCH_IDS = 3 << 20
MAGIC = b"IDRC\x01\x00\x00\x00"
SEGMENTS = "shard int, segment long, first long, n_ids long, doc_ids array<long>, counts array<long>, payload binary"


def to_payloads(parts: list[np.ndarray], vocabulary: int) -> list[bytes]:
    """Code several id sequences, their blocks side by side."""
    lengths = [[min(BLOCK, len(p) - i) for i in range(0, len(p), BLOCK)] for p in parts]
    total = sum(map(len, lengths))
    words: list[np.ndarray] = [np.zeros(0, "<u4")] * total
    flat, sums = [], []
    for p, own in zip(parts, lengths, strict=True):
        for k, n in enumerate(own):
            block = np.ascontiguousarray(p[k * BLOCK:k * BLOCK + n], "<u4")
            flat.append(block)
            sums.append(zlib.crc32(block))
    widths = np.array([_width(len(b)) for b in flat], np.int64)
    for width in np.unique(widths):
        chosen = np.flatnonzero(widths == width)
        matrix = np.zeros((len(chosen), width), np.uint32)
        for row, i in enumerate(chosen):
            matrix[row, :len(flat[i])] = flat[i]
        for i, w in zip(chosen, encode_blocks(matrix, vocabulary), strict=True):
            words[i] = w
    out, at = [], 0
    for p, own in zip(parts, lengths, strict=True):
        mine = range(at, at + len(own))
        at += len(own)
        header = struct.pack("<8sIQI", MAGIC, vocabulary, len(p), len(own))
        table = np.array([[len(words[i]), sums[i]] for i in mine], "<u4").reshape(-1, 2)
        out.append(b"".join([header, table.tobytes(), *(words[i].tobytes() for i in mine)]))
    return out


def _width(n: int) -> int:
    """Ids a block is filled up to before coding: the next power of two."""
    return 1 << max(0, n - 1).bit_length()


def from_payloads(payloads: list[bytes]) -> list[np.ndarray]:
    """The id sequences; raises ``ValueError`` on a damaged block."""
    jobs: dict[tuple[int, int], list[tuple[int, int, int, np.ndarray, int]]] = {}
    out: list[np.ndarray] = []
    size = struct.calcsize("<8sIQI")
    for k, data in enumerate(payloads):
        magic, vocabulary, n, blocks = struct.unpack_from("<8sIQI", data)
        if magic != MAGIC:
            raise ValueError("not a segment of token ids")
        table = np.frombuffer(data, "<u4", 2 * blocks, size).reshape(-1, 2)
        at = size + table.nbytes
        out.append(np.empty(n, np.uint32))
        for b in range(blocks):
            words = np.frombuffer(data, "<u4", int(table[b, 0]), at)
            at += words.nbytes
            length = min(BLOCK, n - b * BLOCK)
            jobs.setdefault((vocabulary, _width(length)), []).append((k, b * BLOCK, length, words, int(table[b, 1])))
    for (vocabulary, width), own in jobs.items():
        ids = decode_blocks([w for _, _, _, w, _ in own], width, vocabulary)
        for row, (k, start, length, _, crc) in enumerate(own):
            block = np.ascontiguousarray(ids[row, :length], "<u4")
            if zlib.crc32(block) != crc:
                raise ValueError(f"checksum of block {start // BLOCK} of a segment differs")
            out[k][start:start + length] = block
    return out


def write_token_files(
    docs: DataFrame, path: str, tokenizer: str, byte_level: bool, end_id: int = 2, id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode every whole text, ``end_id`` after each, and write the files at ``path``.

    Shards are ranges of ascending ids, documents ascend within them; null ids come first, rows
    with equal ids stay together in any order. A null or empty text is the end id alone. An
    empty table writes an empty file set. Other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(tokenizer, byte_level)
        vocabulary = max(pieces.tokenizer.get_vocab_size(True), end_id + 1)
        shard, state = TaskContext.get().partitionId(), {"segment": 0, "first": 0}
        segments: list[tuple[list, list, list]] = [([], [], [])]
        held = own_ids = 0  # ids of all open segments, and of the last

        def flush() -> pa.RecordBatch:
            full = [s for s in segments if s[0]]
            ids = [np.concatenate(s[2]) for s in full]
            n = np.array([len(i) for i in ids], np.int64)
            first = state["first"] + np.concatenate([[0], np.cumsum(n)[:-1]])
            batch = pa.RecordBatch.from_arrays([
                pa.array([shard] * len(full), pa.int32()), pa.array(range(state["segment"], state["segment"] + len(full)), pa.int64()),
                pa.array(first), pa.array(n), pa.array([s[0] for s in full], pa.list_(pa.int64())),
                pa.array([s[1] for s in full], pa.list_(pa.int64())), pa.array(to_payloads(ids, vocabulary), pa.binary())],
                ["shard", "segment", "first", "n_ids", "doc_ids", "counts", "payload"])
            state["segment"] += len(full)
            state["first"] += int(n.sum())
            return batch

        for batch in batches:
            names, done = batch.column(0).to_pylist(), 0
            for ids, ends in pieces.encode(texts_of(batch.column(1))):
                ids = np.insert(ids, ends, end_id)
                ends = ends + np.arange(1, len(ends) + 1)
                start = 0
                for end in ends.tolist():
                    own = segments[-1]
                    if own[0] and own_ids + end - start > SEGMENT_IDS:
                        segments.append(([], [], []))
                        own, own_ids = segments[-1], 0
                    own[0].append(names[done])
                    own[1].append(end - start)
                    own[2].append(ids[start:end])
                    held += end - start
                    own_ids += end - start
                    start, done = end, done + 1
                    if held >= BATCH_IDS:
                        yield flush()
                        segments, held, own_ids = [([], [], [])], 0, 0
        if held:
            yield flush()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    # Rows of one id, or of none, are dealt over ranges by a hash of their text.
    order = ["doc_id", F.xxhash64("text")]
    map_batches(rows.repartitionByRange(*order).sortWithinPartitions(*order), run, SEGMENTS, keeps=True).write.parquet(path)


def read_token_files(
    spark: SparkSession, path: str, columns: Callable[[np.ndarray, np.ndarray], list[pa.Array]] | None = None,
    schema: str = "ids array<int>",
) -> DataFrame:
    """``(doc_id, start, n_tokens)`` and the ids of every document, decoded from the files at ``path``.

    ``start`` counts the ids of all documents before it. ``columns`` may derive other columns of
    ``schema`` from a segment's joined ids and the ends of its documents, in place of ``ids``.
    """
    names = [c.split()[0] for c in schema.split(",")]

    def lists(ids: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        return [pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int32)))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.column(2).to_pylist()
            at = 0
            while at < len(n):
                to, held = at + 1, n[at]
                while to < len(n) and held + n[to] <= BATCH_IDS:
                    held += n[to]
                    to += 1
                part = batch.slice(at, to - at)
                at = to
                for k, ids in enumerate(from_payloads([x.as_buffer().to_pybytes() for x in part.column(5)])):
                    counts = np.array(part.column(4)[k].as_py(), np.int64)
                    ends = np.cumsum(counts)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([part.column(0)[k].as_py()] * len(counts), pa.int32()),
                        part.column(3)[k].values, pa.array(part.column(1)[k].as_py() + ends - counts), pa.array(counts),
                        *(columns or lists)(ids, ends)], ["shard", "doc_id", "start", "n_tokens", *names])

    files = spark.read.parquet(path)
    totals = files.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # one row per shard
    bases = totals.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    decoded = map_batches(
        files.select("shard", "first", "n_ids", "doc_ids", "counts", "payload"), run,
        f"shard int, doc_id long, start long, n_tokens long, {schema}")
    return decoded.join(F.broadcast(bases), "shard").select(
        "doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", *names)


def checksums(ids: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
    """Unsigned CRC-32 of each document's ids as little-endian unsigned 32-bit integers."""
    data = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    starts = np.concatenate([[0], ends[:-1]])
    return [pa.array([zlib.crc32(data[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.int64())]
