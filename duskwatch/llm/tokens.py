"""Tokenizing whole texts of Arrow batches with the ``tokenizers`` library, each distinct chunk once.

A text is cut only where no pre-token of the file can reach across, so the ids of the chunks,
joined, are the ids of the text. A chunk met before is not encoded again: its ids come from a
table of the worker, which is emptied when it holds ``CACHE_IDS`` ids.
"""

import os
import re
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa

from duskwatch.llm.shipping import worker_state

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

CACHE_IDS = 2_500_000
#: Texts are encoded in runs of at most this many bytes (or one longer text).
RUN_BYTES = 2 << 20

#: Cut before a single blank between two characters that no library counts as white space; the
#: blank opens the next chunk. Byte-level pre-tokens carry at most one leading blank.
_BYTE_LEVEL = re.compile(r"\s*\S+(?:(?! \S)\s+\S+)*(?:(?! \S)\s+\Z)?|\s+")


def _spaced(text: str) -> list[bytes]:
    """White space is removed before the merges, so words between ASCII white space stand alone."""
    return text.encode().split()


_TAILS = frozenset(".,;:!?")


class Places(dict):
    """Chunk to place; a chunk met for the first time gets the next place."""

    def __missing__(self, chunk: str | bytes) -> int:
        self[chunk] = place = len(self)
        return place


class ChunkEncoder:
    """Ids per distinct chunk of one tokenizer file."""

    def __init__(self, path: str, byte_level: bool):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.byte_level = byte_level
        self.find = _BYTE_LEVEL.findall if byte_level else _spaced
        self.mark_id, added = max(self.tokenizer.get_added_tokens_decoder().items())
        self.mark = added.content
        names = {i: name for name, i in self.tokenizer.get_vocab(True).items()}
        special = self.tokenizer.get_added_tokens_decoder()
        #: Bytes of each id (byte-level names hold one character per byte), or whether it ends a word.
        self.measure = np.array([
            0 if i in special or i not in names else len(names[i]) if byte_level else names[i].endswith("</w>")
            for i in range(max(names) + 1)], np.int64)
        self.clear()

    def clear(self) -> None:
        self.index = Places()
        self.ids, self.held = np.zeros(1 << 16, np.uint32), 0
        self.start, self.length = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)

    def _joined(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and ids per chunk of chunks that may stand side by side; ``None`` if their ends can't be told."""
        ids = self._encode(("" if self.byte_level else " ").join(chunks))
        if self.byte_level:
            wanted = np.cumsum(np.fromiter((len(c.encode()) for c in chunks), np.int64, len(chunks)))
            have = np.cumsum(self.measure[ids])
            ends = np.searchsorted(have, wanted) + 1
            if ends[-1] != len(ids) or not np.array_equal(have[ends - 1], wanted):
                return None
        else:
            words = np.cumsum(np.fromiter((1 + (c[-1] in _TAILS) for c in chunks), np.int64, len(chunks)))
            ends = np.flatnonzero(self.measure[ids]) + 1
            if len(ends) != words[-1]:
                return None
            ends = ends[words - 1]
        return ids, np.diff(ends, prepend=0)

    def _marked(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids and ids per chunk of any chunks; a special token between them, which splits texts, marks their ends."""
        if any(self.mark in c for c in chunks):
            parts = [self._encode(c) for c in chunks]
            return np.concatenate(parts), np.array([len(p) for p in parts], np.int64)
        ids = self._encode(self.mark.join(chunks) + self.mark)
        at = np.flatnonzero(ids == self.mark_id)
        return np.delete(ids, at), np.diff(at, prepend=-1) - 1

    def _learn(self, chunks: list[str], places: np.ndarray) -> None:
        """Encode chunks, many in one call, and note their ids at the places."""
        if self.byte_level:
            plain = [c[0] == " " and len(c) > 1 and not c[1].isspace() and not c[-1].isspace() and self.mark not in c for c in chunks]
        else:
            # One pre-token of letters, or two with a final mark.
            plain = [(c[:-1] if c[-1] in _TAILS else c).isalpha() for c in chunks]
        plain = np.array(plain, bool)
        for side in (plain, ~plain):
            own = np.flatnonzero(side)
            for i in range(0, len(own), 4_000):
                part = own[i:i + 4_000]
                these = [chunks[k] for k in part]
                ids, lengths = (self._joined(these) if side is plain else None) or self._marked(these)
                if self.held + len(ids) > len(self.ids):
                    grown = np.zeros(max(2 * len(self.ids), self.held + len(ids)), np.uint32)
                    grown[:self.held] = self.ids[:self.held]
                    self.ids = grown
                self.ids[self.held:self.held + len(ids)] = ids
                self.start[places[part]] = self.held + np.cumsum(lengths) - lengths
                self.length[places[part]] = lengths
                self.held += len(ids)

    def _lookup(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per chunk its place in the table, and chunks per text."""
        if self.held > CACHE_IDS:
            self.clear()
        chunks, counts = [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = self.find(text)
            counts[i] = len(found)
            chunks += found
        known = len(self.index)
        place = np.fromiter(map(self.index.__getitem__, chunks), np.int64, len(chunks))
        more = len(self.index) - known
        if more:
            self.start = np.concatenate([self.start, np.zeros(more, np.int64)])
            self.length = np.concatenate([self.length, np.zeros(more, np.int64)])
            new = list(islice(self.index, known, None))
            self._learn(new if self.byte_level else [c.decode() for c in new], np.arange(known, known + more))
        return place, counts

    def _runs(self, texts: Iterable[str | None]):
        run, size = [], 0
        for text in texts:
            text = text or ""
            if run and size + len(text) > RUN_BYTES:
                yield run
                run, size = [], 0
            run.append(text)
            size += len(text)
        if run:
            yield run

    def encode(self, texts: Iterable[str | None]):
        """Yield ``(ids, ends)`` for consecutive runs of the texts: joined ids, and where each text's ids end."""
        for run in self._runs(texts):
            place, counts = self._lookup(run)
            start, length = self.start[place], self.length[place]
            total = np.concatenate([[0], np.cumsum(length)])
            at = np.arange(total[-1]) + np.repeat(start - total[:-1], length)
            yield self.ids[at], total[np.cumsum(counts)]


#: Distinct pre-tokens and chunks a counter holds before it starts anew.
COUNTED = 2_000_000


class PieceCounter(ChunkEncoder):
    """Pieces per distinct pre-token of one tokenizer file; no ids are kept."""

    def clear(self) -> None:
        super().clear()
        self.pieces: dict[str, int] = {}

    def _learn(self, chunks: list[str], places: np.ndarray) -> None:
        """Count the pieces of chunks, each distinct pre-token once."""
        normalizer, splitter, model = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer, self.tokenizer.model
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        pieces, lengths = self.pieces, []
        for chunk in chunks:
            if any(s in chunk for s in special):
                lengths.append(len(self._encode(chunk)))  # the library cuts texts at these before anything else
                continue
            n = 0
            for name, _ in splitter.pre_tokenize_str(normalizer.normalize_str(chunk) if normalizer else chunk):
                own = pieces.get(name)
                if own is None:
                    pieces[name] = own = len(model.tokenize(name))
                n += own
            lengths.append(n)
        self.length[places] = lengths
        self.held = len(pieces) + len(self.index)

    def count(self, texts: Iterable[str | None]) -> np.ndarray:
        """Pieces per text: frequencies of the distinct chunks per text, joined to their pieces and summed."""
        out = [np.zeros(0, np.int64)]
        for run in self._runs(texts):
            if self.held > COUNTED:
                self.clear()
            place, counts = self._lookup(run)
            width = max(1, len(self.index))
            pair, frequency = np.unique(np.repeat(np.arange(len(run)), counts) * width + place, return_counts=True)
            text, chunk = np.divmod(pair, width)
            total = np.concatenate([[0], np.cumsum(frequency * self.length[chunk])])
            out.append(np.diff(total[np.searchsorted(text, np.arange(len(run) + 1))]))
        return np.concatenate(out)


def encoder(path: str, byte_level: bool) -> ChunkEncoder:
    """The worker's encoder for a tokenizer file."""
    known = worker_state("tokens")
    if path not in known:
        known[path] = ChunkEncoder(path, byte_level)
    return known[path]


def counter(path: str, byte_level: bool) -> PieceCounter:
    """The worker's counter for a tokenizer file."""
    known = worker_state("counts")
    if path not in known:
        known[path] = PieceCounter(path, byte_level)
    return known[path]


def texts_of(column: pa.Array) -> Iterator[str | None]:
    """The texts of a column, some at a time."""
    for i in range(0, len(column), 500):
        yield from column.slice(i, 500).to_pylist()
