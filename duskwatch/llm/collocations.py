"""Phrases whose words occur together more often than by chance, from weighted automata of n-grams."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.scratch import discard, stage
from duskwatch.llm.shipping import map_batches
from duskwatch.llm.words import hash_spans, mix, runs_of_rows, text_bytes, word_spans, word_table
from duskwatch.operators.skew import join_counted

#: Words of a phrase at most.
LONGEST = 5
#: Words of a shard: what a task counts at once. Bounds its memory and lets a word's number fit 21 bits.
SHARD_WORDS = 1 << 19
#: Bytes of text that are split and hashed in one go.
SLICE_BYTES = 1 << 19
#: Bits of the filter of frequent pairs (a power of two): 16 MB, whatever the corpus.
FILTER_BITS = 1 << 27

#: Rows of an Arrow batch that a task returns.
ROWS_AT_ONCE = 50_000

#: Pieces end at these bytes, words at blanks and tabs too.
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
_BREAK = np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
#: Joins the words of a key. No word holds it, and as other control bytes are mapped to bytes that
#: no text holds, it is the least byte of a key: all keys that begin with the same words are neighbours.
_JOIN = b"\x09"
_TABLE = word_table(BREAKS + b"\x20\x09")
_TABLE[0x00:0x09] = np.arange(0xF5, 0xFE)
_BACK = bytes.maketrans(bytes(range(0xF5, 0xFE)), bytes(range(0x00, 0x09)))


def _language(lang: str | None) -> bytes:
    return ("und" if lang is None else lang).encode().hex().encode()


# --- shards ----------------------------------------------------------------------------

class Shard:
    """Words of some texts in order: language, hash, place in the bytes, and whether the next word follows in the piece."""

    def __init__(self) -> None:
        self.parts, self.langs, self.size = [], {}, 0

    def add(self, langs: pa.Array, texts: pa.Array) -> None:
        data, start, end, first = word_spans(texts, _TABLE)
        breaks = np.searchsorted(np.flatnonzero(_BREAK[text_bytes(texts)[0]]), start)
        text = np.repeat(np.arange(len(texts)), np.diff(first))
        follows = np.zeros(len(start), bool)
        follows[:-1] = (text[1:] == text[:-1]) & (breaks[1:] == breaks[:-1])
        codes = np.array([self.langs.setdefault(lang, len(self.langs)) for lang in map(_language, langs.to_pylist())], np.int64)
        base = sum(len(part[0]) for part in self.parts)
        places = [(x + base).astype(np.int32) for x in (start, end)]
        self.parts.append((data, hash_spans(data, start, end), *places, codes[text].astype(np.int32), follows))
        self.size += len(start)

    def close(self) -> None:
        data, *columns = zip(*self.parts, strict=True) if self.parts else [[]] * 6
        join = lambda arrays: np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
        self.data = join(data).astype(np.uint8).tobytes()
        self.hash, self.start, self.end, self.lang, self.follows = map(join, columns)
        self.parts = []
        names = sorted(self.langs, key=self.langs.get)
        self.names = pa.array(names, pa.binary())
        self.marks = mix(hash_spans(np.frombuffer(b"".join(names), np.uint8), *self._spans(names))) if names else np.zeros(0, np.uint64)

    @staticmethod
    def _spans(names: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum([len(n) for n in names])
        return ends - [len(n) for n in names], ends

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Places whose next word follows in the piece, and a hash of language and both words."""
        at = np.flatnonzero(self.follows)
        return at, mix(mix(self.hash[at] ^ self.marks[self.lang[at]]) + self.hash[at + 1])

    def words_at(self, places: np.ndarray) -> pa.Array:
        """The words that start at these places."""
        length = (self.end[places] - self.start[places]).astype(np.int64)
        offsets = np.concatenate([[0], np.cumsum(length)])
        at = np.arange(offsets[-1]) + np.repeat(self.start[places] - offsets[:-1], length)
        data = np.frombuffer(self.data, np.uint8)[at]
        return pa.Array.from_buffers(pa.large_binary(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
    shard = Shard()
    for batch in batches:
        for rows in runs_of_rows(batch, 1, SLICE_BYTES):
            shard.add(rows.column(0), rows.column(1))
            if shard.size >= SHARD_WORDS:
                shard.close()
                yield shard
                shard = Shard()
    if shard.size:
        shard.close()
        yield shard


def _first_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard: words per language, occurrences of each word, and of each hashed pair."""
    def rows(key, pair, n):
        return pa.RecordBatch.from_arrays(
            [key.cast(pa.binary()), pa.array(pair, pa.int64()), pa.array(n, pa.int64())], ["key", "pair", "n"])

    for shard in _shards(batches):
        totals = np.bincount(shard.lang, minlength=len(shard.names))
        yield rows(shard.names, [None] * len(totals), totals)
        _, at, n = np.unique(mix(shard.hash ^ shard.marks[shard.lang]), return_index=True, return_counts=True)
        names = shard.names.take(pa.array(shard.lang[at])).cast(pa.large_binary())
        yield rows(pc.binary_join_element_wise(names, shard.words_at(at), pa.scalar(_JOIN, pa.large_binary())), [None] * len(at), n)
        pair, n = np.unique(shard.pairs()[1], return_counts=True)
        for i in range(0, len(pair), ROWS_AT_ONCE):
            part = pair[i:i + ROWS_AT_ONCE].view(np.int64)
            yield rows(pa.nulls(len(part), pa.binary()), part, n[i:i + ROWS_AT_ONCE])
        del shard  # before the next one is gathered


def _filter_positions(pair: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    low, high = pair & np.uint64(bits - 1), (pair >> np.uint64(32)) & np.uint64(bits - 1)
    return low.astype(np.int64), high.astype(np.int64)


def pair_filter(pairs: DataFrame, bits: int = FILTER_BITS) -> np.ndarray:
    """A bit set of fixed size that holds two positions of every pair; others pass it by chance only.

    Tasks set the bits of 64-bit blocks; the driver gets at most ``bits / 64`` blocks.
    """
    low = F.col("pair").bitwiseAND(bits - 1)
    high = F.shiftrightunsigned("pair", 32).bitwiseAND(bits - 1)
    places = pairs.select(F.explode(F.array(low, high)).alias("place"))
    blocks = places.groupBy(F.shiftright("place", 6).alias("block")).agg(
        F.expr("bit_or(shiftleft(1L, cast(place & 63 as int)))").alias("bits")).toArrow()
    found = np.zeros(bits // 64, np.int64)
    found[blocks.column("block").to_numpy()] = blocks.column("bits").to_numpy()
    return found.view(np.uint8)


# --- automata --------------------------------------------------------------------------

def sorted_ngrams(shard: Shard, passes: np.ndarray) -> Iterator[tuple[pa.Array, np.ndarray]]:
    """Keys of a shard's n-grams in order, each once, with their counts.

    An n-gram begins at every word and goes on, to ``LONGEST`` words, while the next pair passes.
    One of a single word is left out. Shorter n-grams are the prefixes of these.
    """
    for low in range(0, len(shard.hash), SHARD_WORDS):
        size = min(SHARD_WORDS, len(shard.hash) - low)
        run, width = np.ones(size, bool), np.zeros(size, np.int8)
        tail = np.zeros(size + LONGEST, bool)
        have = passes[low:low + size + LONGEST]
        tail[:len(have)] = have
        for i in range(LONGEST - 1):
            run &= tail[i:i + size]
            width += run
        at = np.flatnonzero(width) + low
        width = width[at - low]
        if not len(at):
            continue
        used = np.zeros(size + LONGEST, bool)
        for i in range(LONGEST):
            used[at[width >= i] - low + i] = True
        used = np.flatnonzero(used) + low
        _, example, number = np.unique(shard.hash[used], return_index=True, return_inverse=True)
        names = shard.words_at(used[example])
        ranking = np.asarray(pc.array_sort_indices(names))
        order = np.empty(len(names), np.int32)
        order[ranking] = np.arange(1, len(names) + 1)
        word = np.zeros(size + LONGEST, np.int32)  # 0: no word; numbers follow the order of the words
        word[used - low] = order[number]
        numbers = [np.where(width >= i, word[at - low + i], 0).astype(np.int64) for i in range(LONGEST)]
        lang = np.asarray(pc.rank(shard.names, tiebreaker="dense")).astype(np.int64)[shard.lang[at]]
        head = (lang << 42) | (numbers[0] << 21) | numbers[1]
        rest = (numbers[2] << 42) | (numbers[3] << 21) | numbers[4]
        by = np.lexsort((rest, head))
        head, rest = head[by], rest[by]
        first = np.flatnonzero(np.concatenate([[True], (head[1:] != head[:-1]) | (rest[1:] != rest[:-1])]))
        counts = np.diff(np.append(first, len(by)))
        rows = by[first]
        ranked = names.take(pa.array(ranking))
        for i in range(0, len(rows), ROWS_AT_ONCE):
            part = rows[i:i + ROWS_AT_ONCE]
            columns = [shard.names.take(pa.array(shard.lang[at[part]])).cast(pa.large_binary())]
            columns += [ranked.take(pa.array(n[part] - 1, mask=n[part] == 0)) for n in numbers]
            yield pc.binary_join_element_wise(
                *columns, pa.scalar(_JOIN, pa.large_binary()), null_handling="skip"), counts[i:i + ROWS_AT_ONCE]


class CountAutomaton:
    """A weighted acyclic automaton that reads sorted keys; its states are the prefixes of the keys.

    Keys are added in order, so only the states of the last key are open; a state closes when
    the keys leave its prefix. Its weight is the sum over all keys below it. ``closed`` yields
    ``(prefixes, weights)`` of states of at least two words; states that may go on in the keys
    before the first or after the last one are told apart by ``edges``.
    """

    def __init__(self, least: int) -> None:
        self.least = least
        self.path: list[bytes] = []
        self.open: dict[int, list] = {}  # depth: prefix, weight, whether it is the first state of its depth

    def add(self, keys: pa.Array, counts: np.ndarray) -> tuple[list[bytes], list[int]]:
        """Read sorted keys with counts; return the closed states that reach ``least``, and edge states."""
        lists = pc.split_pattern(keys, _JOIN)
        n, width = len(lists), LONGEST + 1
        depth = np.diff(np.asarray(lists.offsets))
        flat = pa.concat_arrays([pa.array(self.path, lists.values.type), lists.flatten()])
        coded = flat.dictionary_encode()
        numbers = np.full((n + 1, width), -1, np.int64)
        numbers[0, :len(self.path)] = np.asarray(coded.indices)[:len(self.path)]
        numbers[1:][np.arange(width) < depth[:, None]] = np.asarray(coded.indices)[len(self.path):]
        same = (numbers[1:] == numbers[:-1]) & (numbers[1:] >= 0)
        common = np.cumprod(same, axis=1).sum(1)
        out: tuple[list[bytes], list[int]] = ([], [])
        names = coded.dictionary
        for level in range(3, width + 1):  # a language and at least two words
            below = np.where(depth >= level, counts, 0)
            starts = np.flatnonzero((depth >= level) & (common < level))
            if level in self.open:
                self.open[level][1] += int(below[:starts[0]].sum()) if len(starts) else int(below.sum())
            if not len(starts):
                continue
            weights = np.add.reduceat(below, starts)
            began = level in self.open
            if began:
                self._close(level, out)
            whole = np.flatnonzero(weights[:-1] >= self.least)
            if not began and len(starts) > 1 and 0 not in whole:
                whole = np.concatenate([[0], whole])
            for i in whole:
                out[0].append(_JOIN.join(names[int(k)].as_py() for k in numbers[starts[i] + 1, :level]))
                out[1].append(int(weights[i]))
            last = _JOIN.join(names[int(k)].as_py() for k in numbers[starts[-1] + 1, :level])
            self.open[level] = [last, int(weights[-1]), not began and len(starts) == 1]
        self.path = [names[int(k)].as_py() for k in numbers[-1, :depth[-1]]]
        return out

    def _close(self, level: int, out: tuple[list[bytes], list[int]], edge: bool = False) -> None:
        prefix, weight, first = self.open.pop(level)
        if weight >= self.least or first or edge:
            out[0].append(prefix)
            out[1].append(weight)

    def end(self) -> tuple[list[bytes], list[int]]:
        """The states that are still open."""
        out: tuple[list[bytes], list[int]] = ([], [])
        for level in list(self.open):
            self._close(level, out, edge=True)
        return out


def phrase_counts(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, filter_bits: int = FILTER_BITS
) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, words, n)`` of all phrases of 1 to 5 words that occur ``least`` times, and ``(lang, n)``.

    The texts are read twice, shard by shard. First words and hashed pairs are counted; pairs
    that reach ``least`` set the bits of a filter of fixed size. Then every shard sorts its
    n-grams, which end where a pair does not pass: no frequent phrase holds such a pair, and a
    pair that passes by chance only adds rows. The sorted n-grams of all shards are united by
    ranges of keys: a task reads its range in order, and the weight of a state of its automaton
    is the count of a prefix. States at the ends of a range are added up over ranges.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))
    tab = F.lit(bytearray(_JOIN))
    counted = map_batches(rows, _first_counts, "key binary, pair long, n long").groupBy("key", "pair").agg(F.sum("n").alias("n"))
    is_total = F.col("pair").isNull() & ~F.contains("key", tab)
    counted = stage(counted.where((F.col("n") >= least) | is_total), "word_counts")
    sent = spark.sparkContext.broadcast(pair_filter(counted.where("pair is not null").select("pair"), filter_bits))

    def ngrams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        for shard in _shards(batches):
            at, pair = shard.pairs()
            passes = np.zeros(len(shard.hash), bool)
            found = np.ones(len(at), bool)
            for place in _filter_positions(pair, 8 * len(bits)):
                found &= (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
            passes[at] = found
            for keys, n in sorted_ngrams(shard, passes):
                yield pa.RecordBatch.from_arrays([keys.cast(pa.binary()), pa.array(n, pa.int64())], ["key", "n"])
            del shard

    def united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = CountAutomaton(least)

        def states(found):
            return pa.RecordBatch.from_arrays([pa.array(found[0], pa.binary()), pa.array(found[1], pa.int64())], ["key", "n"])

        for batch in batches:
            if batch.num_rows:
                yield states(automaton.add(batch.column(0), batch.column(1).to_numpy()))
        yield states(automaton.end())

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [key.split(_JOIN) for key in batch.column(0).to_pylist()]
            langs = [bytes.fromhex(p[0].decode()).decode() for p in parts]
            words = [[w.translate(_BACK).decode() for w in p[1:]] for p in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(langs, pa.string()), pa.array([" ".join(w) for w in words], pa.string()),
                 pa.array(words, pa.list_(pa.string())), batch.column(1)], ["lang", "phrase", "words", "n"])

    shards = stage(map_batches(rows, ngrams, "key binary, n long"), "shard_ngrams")
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = shards.repartitionByRange(parts, "key").sortWithinPartitions("key")
    longer = map_batches(ranged, united, "key binary, n long").groupBy("key").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    single = counted.where("pair is null")
    found = stage(map_batches(
        single.select("key", "n").union(longer), decoded, "lang string, phrase string, words array<string>, n long"), "phrases")
    discard(shards, counted)
    sent.unpersist()
    return found.where("phrase <> ''"), found.where("phrase = ''").select("lang", "n")


def mine_collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = 100, top: int = 2000,
    filter_bits: int = FILTER_BITS,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the ``top`` phrases of every language.

    A-Z are lower-cased; pieces end at ``.,;:!?`` and line ends, words at blanks and tabs. A
    phrase of 2 to 5 words with ``a >= least`` occurrences is cut after every word; the parts'
    counts ``l`` and ``r`` are looked up in the counts of all phrases. Its score is the lowest
    ``floor(1000 a n / (l r))`` of its cuts (ties: the earliest cut), in exact decimals; ``n`` is
    all words of the language. A phrase inside a longer one that occurs as often is left out.

    A null text has no words; a null language is ``und`` and joins rows that name it so. Repeated
    rows count each time. An empty table gives no rows. Other columns are ignored.
    """
    known, totals = phrase_counts(docs, lang_col, text_col, least, filter_bits)
    phrases = known.where(F.size("words") > 1).withColumnRenamed("n", "a")
    counts = known.select("lang", "phrase", "n")

    cut = phrases.select("lang", "phrase", "words", "a", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cut = cut.select(
        "lang", "phrase", "a", "k", F.array_join(F.slice("words", 1, F.col("k")), " ").alias("left"),
        F.array_join(F.slice("words", F.col("k") + 1, F.lit(LONGEST)), " ").alias("right"))
    for side, count in (("left", "l"), ("right", "r")):
        cut = join_counted(cut, counts.select("lang", F.col("phrase").alias(side), F.col("n").alias(count)), ["lang", side])
    cut = join_counted(cut, totals, "lang")

    def whole(name: str):
        return F.col(name).cast("decimal(17,0)")

    # 1000 a n and l r pass 64 bits: decimals of 38 digits are exact, and ``div`` takes the floor.
    cut = cut.select("lang", "phrase", "a", "k", "l", "r", "n", (F.lit(1000).cast("decimal(4,0)") * whole("a") * whole("n")).alias("over"),
                     (whole("l") * whole("r")).alias("under"))
    best = F.min(F.struct(F.expr("over div under").alias("score"), "k", "l", "r", "n")).alias("best")
    scored = cut.groupBy("lang", "phrase", "a").agg(best).select("lang", "phrase", "a", "best.l", "best.r", "best.n", "best.score")

    inner = F.expr(
        "flatten(transform(sequence(2, size(words) - 1), m -> transform(sequence(1, size(words) - m + 1),"
        " s -> array_join(slice(words, s, m), ' '))))")
    covered = phrases.where(F.size("words") > 2).select("lang", F.explode(inner).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("longer"))
    scored = scored.join(covered, ["lang", "phrase"], "left").where("longer is null or longer < a")
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return scored.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
