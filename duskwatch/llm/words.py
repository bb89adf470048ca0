"""Vectorised helpers on Arrow string batches: byte buffers, words and their 64-bit hashes."""

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: Bytes hashed in one go; bounds the helper arrays whatever the batch or the text holds.
BLOCK_BYTES = 4 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= _MIX1
    x ^= x >> np.uint64(27)
    x *= _MIX2
    x ^= x >> np.uint64(31)
    return x


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the ``n + 1`` offsets of the texts; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64, n + 1 + column.offset)[column.offset:]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """A byte table that maps every separator byte to 0 and, if wanted, lower-cases A-Z.

    A zero byte that is no separator becomes 255, which no text holds.
    """
    table = np.arange(256, dtype=np.uint8)
    table[0] = 255
    if lower:
        table[65:91] += 32
    table[list(separators)] = 0
    return table


#: Words are runs without ASCII white space.
SPACED = word_table(b"\x20\x09\x0a\x0b\x0c\x0d")
#: Words are runs of digits, letters and non-ASCII characters.
ALNUM = word_table(bytes([*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]))


def _inverse_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    power = np.full(n, _BASE, np.uint64)
    power[:1] = 1
    np.multiply.accumulate(power, out=power)
    back = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
    back[:1] = 1
    np.multiply.accumulate(back, out=back)
    return power, back


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        _POWERS[:] = _inverse_powers(n)
    return _POWERS[0][:n], _POWERS[1][:n]


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte spans ``data[start:end]``; spans ascend and do not overlap.

    A polynomial modulo 2^64 from prefix sums, then the finaliser with the span's length. The
    prefix sums run over blocks of bytes that end between spans (one longer span is a block).
    """
    out = np.empty(len(start), np.uint64)
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + BLOCK_BYTES, "right")))
        a, b = int(start[i]), int(end[j - 1])
        power, back = _powers(b - a + 1)
        total = np.zeros(b - a + 1, np.uint64)
        np.cumsum((data[a:b].astype(np.uint64) + np.uint64(1)) * power[:-1], out=total[1:])
        s, e = start[i:j] - a, end[i:j] - a
        out[i:j] = (total[e] - total[s]) * back[s]
        out[i:j] += (e - s).astype(np.uint64) << np.uint64(56)
        i = j
    return mix(out)


def word_spans(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Mapped bytes of all texts, start and end of every word, and per text the position of its first word (``n + 1``)."""
    data, offsets = text_bytes(column)
    data = table[data]
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 0
    step = np.diff(inside)
    # A word also ends where its text ends, even if the next text begins with a word byte.
    cut = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(data))] if len(offsets) > 2 else np.zeros(0, np.int64)
    cut = np.unique(cut)
    cut = cut[(data[cut] != 0) & (data[cut - 1] != 0)] if len(cut) else cut
    start = np.sort(np.concatenate([np.flatnonzero(step == 1), cut]))
    end = np.sort(np.concatenate([np.flatnonzero(step == -1), cut]))
    return data, start, end, np.searchsorted(start, offsets, "left")


def words(column: pa.Array, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in order, and per text the position of its first word (``n + 1``)."""
    data, start, end, first = word_spans(column, table)
    return hash_spans(data, start, end), first


def runs_of_rows(batch: pa.RecordBatch, column: int, size: int = BLOCK_BYTES):
    """Slices of a batch whose texts hold about ``size`` bytes together (a longer text is a slice of its own)."""
    offsets = text_bytes(batch.column(column))[1]
    first = 0
    while first < batch.num_rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        yield batch.slice(first, last - first)
        first = last


def ranges(start: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``start[i], start[i] + 1, ...`` for ``count[i]`` values each, joined."""
    count = count.astype(np.int64)
    total = int(count.sum())
    if total == 0:
        return np.zeros(0, np.int64)
    shift = np.repeat(start.astype(np.int64) - np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    return np.arange(total, dtype=np.int64) + shift
