"""Power-of-two decomposition of documents into training sequences."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.shipping import map_batches
from duskwatch.llm.tokens import encoder, texts_of

SCHEMA = "doc_id long, start long, length long, bucket int, ids array<int>, doc_tokens long, sequence_id long, offset long"


def binary_lengths(tokens: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece lengths of every document, joined, and the number of pieces per document.

    Full pieces of ``longest`` come first, then the powers of two of the rest, largest first.
    """
    top = longest.bit_length() - 1
    full, rest = tokens // longest, tokens % longest
    bits = (rest[:, None] >> np.arange(top - 1, -1, -1)) & 1
    counts = full + bits.sum(1)
    kinds = np.concatenate([np.full((len(tokens), 1), longest), 1 << np.arange(top - 1, -1, -1)[None, :].repeat(len(tokens), 0)], 1)
    repeats = np.concatenate([full[:, None], bits], 1)
    return np.repeat(kinds.ravel(), repeats.ravel()), counts


def pack_documents(
    docs: DataFrame, tokenizer: str, byte_level: bool = False, end_id: int = 2, longest: int = 4096,
    id_col: str = "doc_id", text_col: str = "text", checksums: bool = False,
) -> DataFrame:
    """``(doc_id, start, length, bucket, ids, doc_tokens, sequence_id, offset)``, one row per piece.

    With ``checksums`` there is ``ids_crc32`` instead of ``ids``: the unsigned CRC-32 of a piece's
    ids as little-endian unsigned 32-bit integers. The ids then never leave the task.

    The ids of a document, ``end_id`` last, are cut into pieces of ``longest`` (a power of two) and
    of the powers of two of the rest. A piece is a sequence of its own, so none crosses documents
    and none needs padding; ``bucket`` is the exponent of its length, and batches are drawn from
    one bucket (``write_buckets``). Sequence ids hold the input partition and a counter in it, so a
    repeated task gives the same ids and no shuffle is needed. A null or empty text is the end id
    alone; rows with a null id and repeated rows are packed like others; other columns are ignored.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = encoder(tokenizer, byte_level)
        following = TaskContext.get().partitionId() << 40
        for batch in batches:
            doc_ids, done = batch.column(0), 0
            for ids, ends in pieces.encode(texts_of(batch.column(1))):
                n = len(ends)
                own = doc_ids.slice(done, n)
                done += n
                ids = np.insert(ids.astype(np.int32), ends, end_id)
                tokens = np.diff(ends, prepend=0) + 1
                lengths, counts = binary_lengths(tokens, longest)
                total = np.concatenate([[0], np.cumsum(lengths)])
                doc_of = np.repeat(np.arange(n), counts)
                first = np.concatenate([[0], np.cumsum(tokens)[:-1]])
                held = _sums(ids, total) if checksums else pa.ListArray.from_arrays(pa.array(total, pa.int32()), pa.array(ids))
                yield pa.RecordBatch.from_arrays([
                    own.take(pa.array(doc_of)), pa.array(total[:-1] - first[doc_of]), pa.array(lengths.astype(np.int64)),
                    pa.array(np.log2(lengths).astype(np.int32)), held, pa.array(tokens[doc_of]),
                    pa.array(np.arange(following, following + len(lengths))), pa.array(np.zeros(len(lengths), np.int64))],
                    ["doc_id", "start", "length", "bucket", "ids_crc32" if checksums else "ids", "doc_tokens", "sequence_id", "offset"])
                following += len(lengths)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, run, SCHEMA.replace("ids array<int>", "ids_crc32 long") if checksums else SCHEMA, keeps=True)


def _sums(ids: np.ndarray, ends: np.ndarray) -> pa.Array:
    """CRC-32 of consecutive runs of ids."""
    data = memoryview(np.ascontiguousarray(ids, dtype="<u4")).cast("B")
    edges = (4 * ends).tolist()
    return pa.array([zlib.crc32(data[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)], pa.int64())


def write_buckets(pieces: DataFrame, path: str) -> None:
    """Write the sequences below one folder per length, ``bucket=<exponent>``."""
    pieces.select("bucket", "sequence_id", "offset", "doc_id", "start", "length", "ids").write.partitionBy("bucket").parquet(path)


def with_checksums(pieces: DataFrame, column: str = "ids_crc32") -> DataFrame:
    """Replace ``ids`` by the unsigned CRC-32 of them as little-endian unsigned 32-bit integers."""
    kept = [f for f in pieces.schema.fields if f.name != "ids"]
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(batch.schema.get_field_index("ids"))
            sums = _sums(np.asarray(lists.values), np.asarray(lists.offsets, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(batch.schema.get_field_index(n)) for n in names] + [sums], names + [column])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    return map_batches(pieces, run, f"{schema}, {column} long")
