"""Language identification by segmentation-marginalised unigrams.

Words are lower-cased runs of letters. A language is a unigram model over the pieces of a fixed
public vocabulary; the probability of a word is the sum over all its segmentations into pieces,
by the forward algorithm. Piece probabilities come from one expectation step: every word of a
labelled text spreads its count over its segmentations, weighted by a prior that falls with a
piece's place in the vocabulary. Characters outside the vocabulary share one extra piece.
"""

import re
import uuid
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.shipping import map_batches, worker_state
from duskwatch.llm.tokens import Places, texts_of

UNKNOWN = "und"
#: Runs of letters are cut after this many characters; segmentations do not cross a cut.
LONGEST_WORD = 48
#: Words scored side by side, and words a worker remembers.
CHUNK, REMEMBERED = 4_096, 150_000
#: Per character, so that products of small probabilities stay in range.
SCALE = 1_000.0
FLOOR = 1e-7
#: Pseudo-count by which a language's pieces are drawn towards all languages' pieces.
SMOOTHING = 1_000.0
RESOLUTION = 1 << 20  # counts are summed as integers, so their order does not matter

#: Letters are the categories L*; marks (M*) stay inside words. ``\w`` of ``re`` also takes other
#: numbers (fractions, circled and Roman ones) and cuts words at marks, so texts that hold any of
#: these go the longer way.
_FIND = re.compile(r"[^\W\d_]+").findall
_ODD = regex.compile(r"[\p{M}\p{No}\p{Nl}]").search
_FIND_ODD = regex.compile(r"\p{L}[\p{L}\p{M}]*").findall
_OPEN = "▁"


def find_words(text: str) -> list[str]:
    """The words of a text, each with the mark of a word's beginning; long runs in parts."""
    text = text.lower()
    found = (_FIND if text.isascii() or not _ODD(text) else _FIND_ODD)(text)
    if not found:
        return []
    if max(map(len, found)) <= LONGEST_WORD:
        return f" {_OPEN}".join(["", *found])[1:].split(" ")
    out = []
    for word in found:
        if len(word) <= LONGEST_WORD:
            out.append(_OPEN + word)
        else:
            out += [_OPEN + word[:LONGEST_WORD]] + [word[i:i + LONGEST_WORD] for i in range(LONGEST_WORD, len(word), LONGEST_WORD)]
    return out


class Pieces:
    """The vocabulary's pieces, found in many words at once by hashes of their characters."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.names = [
            model.id_to_piece(i) for i in range(model.get_piece_size())
            if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.n = len(self.names) + 1  # the last stands for any other character
        self.longest = max(map(len, self.names))
        place = np.arange(len(self.names), dtype=np.float64)
        self.prior = np.append(1 / (place + 100), 1e-9)
        self.prior /= self.prior.sum()
        hashes = np.array([self._hash(n) for n in self.names], np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.ids = hashes[order], order
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(hashes >> np.uint64(44)).astype(np.int64)] = True

    _STEP, _LAST = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9

    def _hash(self, name: str) -> int:
        h = 0
        for c in name:
            h = ((h + ord(c) + 1) * self._STEP) & (1 << 64) - 1
        return (h ^ (h >> 32)) * self._LAST & (1 << 64) - 1

    def find(self, characters: np.ndarray) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
        """For a matrix of characters, one word per row: ``(start, end, rows, pieces)`` by ascending end, then start."""
        n, width = characters.shape
        found = []
        for start in range(width):
            h = np.zeros(n, np.uint64)
            for end in range(start + 1, min(width, start + self.longest) + 1):
                h = (h + characters[:, end - 1] + np.uint64(1)) * np.uint64(self._STEP)
                full = (h ^ (h >> np.uint64(32))) * np.uint64(self._LAST)
                rows = np.flatnonzero(self.maybe[(full >> np.uint64(44)).astype(np.int64)])
                at = np.minimum(np.searchsorted(self.hashes, full[rows]), len(self.hashes) - 1)
                good = self.hashes[at] == full[rows]
                rows, pieces = rows[good], self.ids[at[good]]
                if end == start + 1 and len(rows) < n:
                    other = np.setdiff1d(np.arange(n), rows, assume_unique=True)
                    rows = np.concatenate([rows, other])
                    pieces = np.concatenate([pieces, np.full(len(other), self.n - 1)])
                if len(rows):
                    found.append((start, end, rows, pieces))
        return sorted(found, key=lambda f: (f[1], f[0]))


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and characters of the words, words of one length side by side."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        for i in range(0, len(at), CHUNK):
            part = at[i:i + CHUNK]
            joined = "".join([words[k] for k in part]).encode("utf-32-le", "surrogatepass")
            yield part, np.frombuffer(joined, "<u4").reshape(len(part), length).astype(np.uint64)


def _forward(pieces: Pieces, characters: np.ndarray, p: np.ndarray):
    """Scaled sums over the segmentations of every prefix, per column of ``p``; and the pieces found."""
    n, width = characters.shape
    found = pieces.find(characters)
    alpha = np.zeros((width + 1, n, p.shape[1]))
    alpha[0] = 1
    for start, end, rows, ids in found:
        alpha[end, rows] += alpha[start, rows] * p[ids] * SCALE ** (end - start)
    return alpha, found


def score_words(pieces: Pieces, words: list[str], p: np.ndarray) -> np.ndarray:
    """Log probabilities of words under the unigram models in the columns of ``p``."""
    out = np.zeros((len(words), p.shape[1]))
    for at, characters in _by_length(words):
        alpha, _ = _forward(pieces, characters, p)
        out[at] = np.log(alpha[-1]) - characters.shape[1] * np.log(SCALE)
    return out


def expected_counts(pieces: Pieces, words: list[str], weights: np.ndarray) -> np.ndarray:
    """Expected pieces of words under the prior; ``weights`` has a column per language."""
    p = np.maximum(pieces.prior, FLOOR)[:, None]
    out = np.zeros((pieces.n, weights.shape[1]))
    for at, characters in _by_length(words):
        alpha, found = _forward(pieces, characters, p)
        beta = np.zeros_like(alpha)
        beta[-1] = 1
        for start, end, rows, ids in sorted(found, key=lambda f: (-f[0], f[1])):
            beta[start, rows] += beta[end, rows] * p[ids] * SCALE ** (end - start)
        for start, end, rows, ids in found:
            share = (alpha[start, rows] * p[ids] * beta[end, rows])[:, 0] * SCALE ** (end - start) / alpha[-1, rows, 0]
            for k in range(weights.shape[1]):
                out[:, k] += np.bincount(ids, share * weights[at[rows], k], pieces.n)
    return out


class Model:
    """Piece probabilities per language."""

    def __init__(self, languages: list[str], counts: np.ndarray):
        pooled = (counts.sum(1) + 1e-3) / (counts.sum() + 1e-3 * len(counts)) if counts.size else np.ones(0)
        self.languages = languages
        self.name = uuid.uuid4().hex  # tells a worker whether it has scores of this model
        self.p = np.maximum((counts + SMOOTHING * pooled[:, None]) / (counts.sum(0) + SMOOTHING), FLOOR) if languages else counts


def held_out(id_col: Column) -> Column:
    """The rows that training leaves out: CRC-32 of the id as text has remainder 1 modulo 3."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> Model:
    """A model from all labelled, not held-out rows. What reaches the driver is bounded by languages x pieces."""
    rows = docs.where(~held_out(F.col(id_col)) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces(vocabulary)
        index = Places()
        names: dict[str, int] = {}
        cells: list[np.ndarray] = []
        total, held = np.zeros((pieces.n, 0)), 0

        def settle() -> None:
            nonlocal total
            total = np.pad(total, ((0, 0), (0, len(names) - total.shape[1])))
            if cells:
                cell, count = np.unique(np.concatenate(cells), return_counts=True)
                weights = np.zeros((len(index), len(names)))
                weights[cell >> 20, cell & 0xFFFFF] = count
                total += expected_counts(pieces, list(index), weights)
            index.clear()
            cells.clear()

        for batch in batches:
            for text, lang in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                name = names.setdefault(lang, len(names))
                found = find_words(text)
                if found:
                    cells.append((np.fromiter(map(index.__getitem__, found), np.int64, len(found)) << 20) | name)
                held += len(found)
                if len(index) > REMEMBERED or held > 1 << 20:
                    settle()
                    held = 0
        settle()
        for lang, k in names.items():
            ids = np.flatnonzero(total[:, k])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(ids), pa.string()), pa.array(ids, pa.int64()), pa.array(np.rint(total[ids, k] * RESOLUTION).astype(np.int64))],
                ["lang", "piece", "n"])

    found = map_batches(rows, run, "lang string, piece long, n long").groupBy("lang", "piece").agg(F.sum("n").alias("n")).toPandas()
    languages = sorted(found["lang"].unique())
    counts = np.zeros((Pieces(vocabulary).n, len(languages)))
    counts[found["piece"].to_numpy(int), np.searchsorted(languages, found["lang"].to_numpy(str)) if languages else []] = found["n"] / RESOLUTION
    return Model(languages, counts)


class Scorer:
    """Scores of words met by this worker."""

    def __init__(self, vocabulary: str, model: Model):
        self.pieces, self.p = Pieces(vocabulary), model.p
        self.clear()

    def clear(self) -> None:
        self.index = Places()
        self.scores = np.zeros((0, self.p.shape[1]))

    def __call__(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Log probabilities of the texts per language, and their numbers of words."""
        total, counts = np.zeros((len(texts), self.p.shape[1])), np.zeros(len(texts), np.int64)
        i = 0
        while i < len(texts):
            if len(self.index) > REMEMBERED:
                self.clear()
            run, size, first = [], 0, i
            while i < len(texts) and (not run or size < 1 << 20):
                run.append(find_words(texts[i] or ""))
                size += len(texts[i] or "")
                i += 1
            joined = [w for words in run for w in words]
            known = len(self.index)
            at = np.fromiter(map(self.index.__getitem__, joined), np.int64, len(joined))
            self.scores = np.concatenate([self.scores, score_words(self.pieces, list(islice(self.index, known, None)), self.p)])
            counts[first:i] = [len(words) for words in run]
            filled = np.flatnonzero(counts[first:i])
            if len(filled):
                starts = np.concatenate([[0], np.cumsum(counts[first:i])[:-1]])
                total[first + filled] = np.add.reduceat(self.scores[at], starts[filled], axis=0)
        return total, counts


def predict(
    docs: DataFrame, model: Model, vocabulary: str, text_col: str = "text", lang_col: str = "lang_pred",
    score_col: str = "score",
) -> DataFrame:
    """``docs`` with a predicted language and its posterior probability under equal priors.

    Null texts, texts without letters and a model without languages give ``und`` and score 0.
    Ties go to the language that sorts first. A column of ``docs`` with an output's name is replaced.
    """
    names = [c for c in docs.columns if c not in (lang_col, score_col)]
    rows = docs.select(*names)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        known = worker_state("language")
        if known.get("of") != model.name:
            known.update({"of": model.name, "scorer": Scorer(vocabulary, model) if model.languages else None})
        for batch in (b.slice(i, 1000) for b in batches for i in range(0, b.num_rows, 1000)):
            texts = batch.column(place).to_pylist()
            if model.languages:
                total, counts = known["scorer"](texts)
                share = np.exp(total - total.max(1, keepdims=True))
                share /= share.sum(1, keepdims=True)
                best = share.argmax(1)
                lang = [model.languages[b] if c else UNKNOWN for b, c in zip(best, counts, strict=True)]
                score = np.where(counts > 0, share.max(1), 0.0)
            else:
                lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(lang, pa.string()), pa.array(score, pa.float64())], [*names, lang_col, score_col])

    from pyspark.sql.types import DoubleType, StringType, StructType

    schema = StructType(list(rows.schema.fields)).add(lang_col, StringType()).add(score_col, DoubleType())
    return map_batches(rows, run, schema, keeps=True)
