"""Benchmark passages in documents, found by backward search in an FM-index per training shard.

The phrases are the windows of the benchmark items, as sequences of word hashes. A shard is a run
of documents of one task. Words that no phrase contains can lie in no occurrence, so each becomes
a separator; stretches of phrase words shorter than the shortest phrase are left out with them.
The index of the rest has a suffix array sampled at every ``SAMPLE``-th position, and the
Burrows-Wheeler transform as a wavelet tree with ranks. All phrases of a block are searched at once.
An index lives as long as its shard's search. A benchmark of several blocks is searched block after
block, each in its own pass over the documents with a written table between, so that driver and
workers hold the phrases of one block at a time.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.scratch import discard, stage
from duskwatch.llm.shipping import map_batches
from duskwatch.llm.words import ALNUM, ranges, words

SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, item_ids array<string>, spans array<struct<start:long,end:long>>"
SAMPLE = 8
#: Words of documents per index; bounds a task's memory (one longer document is a shard of its own).
SHARD_WORDS = 2_000_000
#: Bytes of items whose phrases are searched at once (or one longer item); a larger benchmark is searched in blocks.
BLOCK_BYTES = 4 << 20


class Phrases:
    """Distinct phrases of a benchmark block: codes 1.. per distinct word, and the items of each phrase."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        hashes, first = words(pa.array([t for _, t in items], pa.string()), ALNUM)
        self.vocabulary = np.unique(hashes)
        codes = np.append(np.searchsorted(self.vocabulary, hashes) + 1, 0).astype(np.int32)
        size = np.diff(first)
        count = np.where(size > 0, np.maximum(size - window + 1, 1), 0)
        length = np.minimum(np.repeat(size, count), window)
        place = ranges(first[:-1], count)[:, None] + np.arange(-window, 0) + length[:, None]
        # Aligned right, as the search runs backward; 0 fills shorter phrases.
        rows = np.where(np.arange(window) >= window - length[:, None], codes[np.maximum(place, 0)], 0).astype(np.int32)
        _, at, which = np.unique(rows.view(np.dtype((np.void, rows.itemsize * window))).ravel(), return_index=True, return_inverse=True)
        self.codes, self.length = rows[at], length[at].astype(np.int64)
        # Items of phrase i: names[item[start[i]:start[i + 1]]].
        self.names = [n for n, _ in items]
        order = np.argsort(which, kind="stable")
        self.item = np.repeat(np.arange(len(items)), count)[order]
        self.start = np.searchsorted(which[order], np.arange(len(at) + 1))

    def items(self, phrase: int) -> set[str]:
        return {self.names[i] for i in self.item[self.start[phrase]:self.start[phrase + 1]]}

    @property
    def shortest(self) -> int:
        return int(self.length.min()) if len(self.length) else 0


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix order of a code sequence, by prefix doubling over the suffixes that still tie."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    ranked = text[order]
    head = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    rank = np.empty(n + 1, np.int64)
    rank[n] = -1
    rank[order] = np.maximum.accumulate(np.where(head, np.arange(n), 0))  # a tie has the place of its first suffix
    step = 1
    while True:
        tied = ~head | ~np.append(head[1:], True)
        at = np.flatnonzero(tied)
        if not len(at):
            return order
        suffix = order[at]
        group, after = rank[suffix], rank[np.minimum(suffix + step, n)]
        by = np.lexsort((after, group))
        suffix, group, after = suffix[by], group[by], after[by]
        order[at] = suffix
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        head[at] = new
        place = at[np.maximum.accumulate(np.where(new, np.arange(len(at)), 0))]
        rank[suffix] = place
        step *= 2


class WaveletTree:
    """Ranks of codes in a sequence: one bit vector per bit of the codes, zeros first at each level."""

    def __init__(self, codes: np.ndarray, top: int):
        self.levels = []
        self.bits = max(1, int(top).bit_length())
        for bit in range(self.bits - 1, -1, -1):
            ones = (codes >> bit) & 1
            total = np.zeros(len(codes) + 1, np.int32)
            np.cumsum(ones, out=total[1:])
            self.levels.append((bit, total, len(codes) - int(total[-1])))
            codes = np.concatenate([codes[ones == 0], codes[ones == 1]])
        self.start: dict[int, int] = {}

    def rank(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often ``code`` occurs before position ``at``."""
        low = np.zeros_like(at)
        for bit, total, zeros in self.levels:
            one = ((code >> bit) & 1).astype(bool)
            ones_low, ones_at = total[low], total[at]
            low = np.where(one, zeros + ones_low, low - ones_low)
            at = np.where(one, zeros + ones_at, at - ones_at)
        return at - low

    def access(self, at: np.ndarray) -> np.ndarray:
        """The codes at positions."""
        code = np.zeros_like(at)
        for bit, total, zeros in self.levels:
            one = total[at + 1] - total[at] == 1
            code |= one.astype(np.int64) << bit
            at = np.where(one, zeros + total[at], at - total[at])
        return code


class FMIndex:
    """Backward search and location in a code sequence; codes are 1.. ``top`` and 0 separates."""

    def __init__(self, text: np.ndarray, top: int):
        text = np.append(text, -1) + 1  # one end mark below everything
        order = suffix_array(text)
        bwt = text[order - 1]
        self.tree = WaveletTree(bwt, top + 1)
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=top + 2))])
        self.sampled = np.concatenate([[0], np.cumsum(order % SAMPLE == 0)])
        self.positions = order[order % SAMPLE == 0]
        self.n = len(text)

    def _back(self, code: np.ndarray, at: np.ndarray) -> np.ndarray:
        return self.smaller[code] + self.tree.rank(code, at)

    def search(self, codes: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix ranges ``[low, high)`` of the phrases, all phrases one word further per step."""
        low, high = np.zeros(len(codes), np.int64), np.full(len(codes), self.n, np.int64)
        width = codes.shape[1]
        for step in range(width):
            on = np.flatnonzero((step < length) & (low < high))
            code = codes[on, width - 1 - step].astype(np.int64) + 1
            low[on], high[on] = self._back(code, low[on]), self._back(code, high[on])
        return low, high

    def locate(self, at: np.ndarray) -> np.ndarray:
        """Text positions of suffixes: steps back to the next sampled one."""
        at, moved = at.copy(), np.zeros(len(at), np.int64)
        todo = np.arange(len(at))
        while len(todo := todo[self.sampled[at[todo] + 1] == self.sampled[at[todo]]]):
            at[todo] = self._back(self.tree.access(at[todo]), at[todo])
            moved[todo] += 1
        return self.positions[self.sampled[at]] + moved


def occurrences(codes: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """All occurrences in a shard: the position of the first word, and the phrase. No occurrence crosses texts."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(phrases.length) or not len(codes):
        return none
    # Stretches of phrase words within one text, at least as long as the shortest phrase.
    known = codes > 0
    edge = np.zeros(len(codes) + 1, bool)
    edge[first] = True
    begins = known & (edge[:-1] | ~np.concatenate([[False], known[:-1]]))
    ends = known & (edge[1:] | ~np.concatenate([known[1:], [False]]))
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    long_enough = stop - start >= phrases.shortest
    start, length = start[long_enough], (stop - start)[long_enough]
    if not len(start):
        return none
    origin = ranges(start, length + 1)  # with one separator after each stretch
    own = codes[np.minimum(origin, len(codes) - 1)].copy()
    own[np.cumsum(length + 1) - 1] = 0
    index = FMIndex(own, len(phrases.vocabulary))
    low, high = index.search(phrases.codes, phrases.length)
    count = np.maximum(high - low, 0)
    return origin[index.locate(ranges(low, count))], np.repeat(np.arange(len(count)), count)


def _shards(first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of documents of at most ``SHARD_WORDS`` words, or one longer document."""
    i, n = 0, len(first) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(first, first[i] + SHARD_WORDS, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def _blocks(benchmark: DataFrame, window: int, item_col: str, item_text: str) -> Iterator[tuple[Phrases, bool]]:
    """The benchmark's phrases in blocks of bounded size, one at a time, and whether a block is the last."""
    block, size = [], 0
    rows = benchmark.select(F.col(item_col).cast("string").alias("i"), F.col(item_text).cast("string").alias("t"))
    for row in rows.where("i is not null and t is not null").toLocalIterator():
        n = len(row["t"].encode())
        if block and size + n > BLOCK_BYTES:
            yield Phrases(block, window), False
            block, size = [], 0
        block.append((row["i"], row["t"]))
        size += n
    yield Phrases(block, window), True


def _search(texts: pa.Array, phrases: Phrases) -> Iterator[tuple[np.ndarray, np.ndarray, list[set[str]]]]:
    """Per shard of the texts: which words are hit, where texts begin, and the items of each text."""
    hashes, first = words(texts, ALNUM)
    for a, b in _shards(first):
        yield _search_shard(hashes[first[a]:first[b]], first[a:b + 1] - first[a], phrases)


def _search_shard(hashes: np.ndarray, first: np.ndarray, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
    items: list[set[str]] = [set() for _ in range(len(first) - 1)]
    if not len(phrases.vocabulary):
        return np.zeros(len(hashes), bool), first, items
    cover = np.zeros(len(hashes) + 1, np.int64)
    at = np.minimum(np.searchsorted(phrases.vocabulary, hashes), len(phrases.vocabulary) - 1)
    codes = np.where(phrases.vocabulary[at] == hashes, at + 1, 0)
    where, phrase = occurrences(codes, first, phrases)
    np.add.at(cover, where, 1)
    np.add.at(cover, where + phrases.length[phrase], -1)
    doc = np.searchsorted(first, where, "right") - 1
    for d, p in set(zip(doc.tolist(), phrase.tolist(), strict=True)):
        items[d].update(phrases.items(p))
    return np.cumsum(cover)[:-1] > 0, first, items


def _passes(rows: DataFrame, benchmark: DataFrame, window: int, item_col: str, item_text: str, one: Callable, last: Callable) -> DataFrame:
    """``one(rows, phrases)`` for each block of the benchmark, written between, and ``last`` for the last one.

    ``phrases`` is a broadcast of one block, which is gone before the next one is made.
    """
    context, staged = benchmark.sparkSession.sparkContext, []
    for block, final in _blocks(benchmark, window, item_col, item_text):
        phrases = context.broadcast(block)
        if final:
            return last(rows, phrases)
        rows = stage(one(rows, phrases), "searched")
        phrases.destroy()
        if staged:
            discard(staged.pop())
        staged.append(rows)


def find_passages(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, item_ids, spans)``, one row per row of ``docs``.

    Words are lower-cased runs of digits, letters and non-ASCII characters, compared by 64-bit
    hashes. A phrase is ``window`` consecutive words of an item, or a shorter item whole; a word
    in any occurrence is hit, and ``spans`` are the merged ranges of hit words, over all blocks of
    items. Null or empty texts have no words; null or wordless items no phrases; rows with a null id
    and repeated rows are kept; items with one id are one item; other columns are ignored.
    """
    kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
    between = "doc_id long, text string, item_ids array<string>, spans array<struct<start:long,end:long>>"
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.select("*", F.expr("cast(array() as array<string>)").alias("item_ids"),
                       F.expr("cast(array() as array<struct<start:long,end:long>>)").alias("spans"))

    def search(rows: DataFrame, phrases: Broadcast, final: bool) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                done = 0
                for hit, first, items in _search(batch.column(1), phrases.value):
                    n = len(items)
                    own = batch.slice(done, n)
                    done += n
                    known, before = own.column(2).to_pylist(), own.column(3).to_pylist()
                    spans = [[] for _ in items]
                    for d in (d for d in range(n) if items[d] or known[d]):
                        items[d].update(known[d])
                        mask = hit[first[d]:first[d + 1]].astype(np.int8)
                        for span in before[d]:
                            mask[span["start"]:span["end"]] = 1
                        edge = np.diff(np.concatenate([[0], mask, [0]]))
                        spans[d] = [{"start": s, "end": e} for s, e in zip(
                            np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True)]
                    names, spans_ = pa.array([sorted(i) for i in items], pa.list_(pa.string())), pa.array(spans, kind)
                    if not final:
                        yield pa.RecordBatch.from_arrays([own.column(0), own.column(1), names, spans_], ["doc_id", "text", "item_ids", "spans"])
                        continue
                    n_hit = pa.array([sum(s["end"] - s["start"] for s in found) for found in spans], pa.int64())
                    yield pa.RecordBatch.from_arrays([
                        own.column(0), pa.array(np.diff(first), pa.int64()), n_hit, pa.array([len(i) for i in items], pa.int64()),
                        names, spans_], ["doc_id", "n_words", "n_hit", "n_items", "item_ids", "spans"])

        return map_batches(rows, run, SCHEMA if final else between)

    return _passes(rows, benchmark, window, item_col, item_text, lambda r, p: search(r, p, False), lambda r, p: search(r, p, True))


def clean_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text_col: str = "text", item_col: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds no phrase of the benchmark."""
    place = docs.columns.index(text_col)

    def search(rows: DataFrame, phrases: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not i for _, _, items in _search(batch.column(place), phrases.value) for i in items]
                yield batch.filter(pa.array(clean, pa.bool_()))

        return map_batches(rows, run, docs.schema)

    return _passes(docs, benchmark, window, item_col, item_text, search, search)
