"""Near duplicates by a parity-sketch join on word shingles.

Two sets of sizes ``a <= b`` with Jaccard similarity of at least 4/5 differ in at most
``(a + b) / 9`` elements, and ``b <= 5a / 4``. In a size band every shingle flips one bit of a
long bit sketch, which is cut into as many parts as the band's smallest set has elements; a part
is named by the XOR of the hashes of its set bits. A differing element spoils at most one part,
so of any ``d + 1 + s`` non-empty parts of a set at least ``s + 1`` are equal in a linked set, if
``d`` bounds the difference. A set therefore emits only its ``d + 1 + s`` fullest parts, and a
set whose emitted parts are found elsewhere fewer than ``s + 1`` times has no partner. The rest is
narrowed again to the rarest parts (prefix filter). Sets with too few parts for the guarantee
also emit a prefix of their shingles, so nothing rests on chance.

Equal sets are one class. Within a part's classes, links are sought with the least class first;
only classes of different components are compared further, by sketches of fixed length whose
Hamming distance is a lower bound of the difference. Every link is verified on whole sets.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch.llm.shipping import map_batches, whole_groups
from duskwatch.llm.words import SPACED, mix, ranges, words
from duskwatch.operators.components import connected_components
from duskwatch.llm.scratch import stage

WORDS = 5
_STEP = np.uint64(0xD6E8FEB86659FD93)
#: Slack: a set of n shingles emits n // SLACK parts more than it must.
SLACK = 32
#: Members of a part that are compared side by side.
BLOCK = 1024
#: Shingles that are handled side by side.
RUN = 1 << 19


def shingle_sets(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Runs of texts: the first text, the sorted distinct shingle hashes joined, and the ends per text."""
    hashes, first = words(column, SPACED)
    n = len(first) - 1
    i = 0
    while i < n:
        j = min(n, max(i + 1, int(np.searchsorted(first, first[i] + RUN, "right")) - 1))
        own = hashes[first[i]:first[j]]
        ends = first[i + 1:j + 1] - first[i]
        sets = []
        if len(own) >= WORDS:
            rolled = np.zeros(len(own) - WORDS + 1, np.uint64)
            for k in range(WORDS):
                rolled = (rolled + own[k:len(own) - WORDS + 1 + k]) * _STEP
            rolled = mix(rolled)
        start = 0
        for end in ends.tolist():
            if end - start >= WORDS:
                sets.append(np.unique(rolled[start:end - WORDS + 1]))
            elif end > start:
                whole = np.array([end - start], np.uint64)
                for k in range(start, end):
                    whole = mix(whole * _STEP + own[k:k + 1])
                sets.append(whole)
            else:
                sets.append(np.zeros(0, np.uint64))
            start = end
        yield i, np.concatenate(sets), np.cumsum([len(s) for s in sets])
        i = j


def set_names(sets: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit names per set, from sums of element hashes; 0 for an empty set."""
    out = []
    for salt in (np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)):
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets ^ salt), dtype=np.uint64)])
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        out.append(np.where(ends > starts, mix(total[ends] - total[starts] + salt), np.uint64(0)).view(np.int64))
    return out[0], out[1]


def bands(sizes: np.ndarray) -> np.ndarray:
    """Exponent of the largest power of two up to each size (0 for an empty set)."""
    return np.searchsorted(1 << np.arange(1, 62), sizes, "right")


def sketches(sets: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """Parity sketches of four bits per element of the band's smallest set, 64 at least; every element flips one bit."""
    sizes = np.diff(ends, prepend=0)
    bits = np.maximum(64, 4 << bands(sizes))
    starts = np.concatenate([[0], np.cumsum(bits)])
    row = np.repeat(np.arange(len(ends)), sizes)
    # The place is a remainder by a power of two, so folding a sketch gives the next shorter one.
    cell = starts[row] + (mix(sets ^ np.uint64(77)) % bits[row].astype(np.uint64)).astype(np.int64)
    flat = np.packbits((np.bincount(cell, minlength=starts[-1]) & 1).astype(np.uint8))
    return [flat[i // 8:j // 8].tobytes() for i, j in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]


def folded(sketch: np.ndarray, width: int) -> np.ndarray:
    """A sketch of bytes shortened to ``width`` bytes; the parity of a folded bit is that of its two halves."""
    while len(sketch) > width:
        half = len(sketch) // 2
        sketch = sketch[:half] ^ sketch[half:]
    return sketch


def largest_difference(n: np.ndarray) -> np.ndarray:
    """The most elements by which a linked pair with a set of ``n`` can differ."""
    return (n + 5 * n // 4) // 9


def part_keys(sets: np.ndarray, ends: np.ndarray, names: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Emitted parts of the sets: key, the set's name, and in how many equal parts a partner shows at least."""
    sizes = np.diff(ends, prepend=0)
    band = bands(sizes)
    out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for lower in (0, 1):
        # A set is in the band of its size, and as the larger partner in the band below.
        chosen = np.flatnonzero((sizes > 0) & ((band > 0) & (4 * sizes < 5 << band) if lower else True))
        if not len(chosen):
            continue
        n, own_band = sizes[chosen], band[chosen] - lower
        element = _members(ends, sizes, chosen)
        row = np.repeat(np.arange(len(chosen)), n)
        h = mix(sets[element] ^ (own_band[row].astype(np.uint64) * _STEP))
        parts = (1 << own_band).astype(np.int64)
        part = ((h >> np.uint64(32)) * parts[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        cell = np.concatenate([[0], np.cumsum(parts)])[row] + part
        order = np.argsort(cell, kind="stable")
        cell = cell[order]
        head = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        xor = np.bitwise_xor.reduceat(mix(h[order]), head)
        full = np.diff(np.append(head, len(cell)))
        row, part = row[order][head], part[order][head]
        key = mix(xor + part.astype(np.uint64) * _STEP + own_band[row].astype(np.uint64))
        # The fullest parts first; a part's fullness belongs to its key, so the order is everybody's.
        order = np.lexsort((key, -full, row))
        row, key = row[order], key[order]
        count = np.bincount(row, minlength=len(chosen))
        place = np.arange(len(row)) - np.concatenate([[0], np.cumsum(count)[:-1]])[row]
        d = largest_difference(n)
        emitted = d + 1 + n // SLACK
        strong = count >= emitted
        shown = np.where(strong, 4 * n // (5 * SLACK) + 1, 1)
        keep = place < emitted[row]
        out.append((key[keep], names[chosen][row[keep]], shown[row[keep]]))
        weak = np.flatnonzero(count <= d)
        for w in weak.tolist():
            end = ends[chosen[w]]
            prefix = np.sort(mix(sets[end - n[w]:end]))[:n[w] - (4 * n[w] + 4) // 5 + 1]
            out.append((mix(prefix + _STEP), np.full(len(prefix), names[chosen[w]]), np.ones(len(prefix), np.int64)))
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _members(ends: np.ndarray, sizes: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """Places of the elements of the chosen sets, joined."""
    return ranges(ends[chosen] - sizes[chosen], sizes[chosen])


def _fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, c, c2)`` per row; ``c``, ``c2`` name the set."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, sets, ends in shingle_sets(batch.column(1)):
                c, c2 = set_names(sets, ends)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(at, len(ends)), pa.array(np.diff(ends, prepend=0)), pa.array(c), pa.array(c2)],
                    ["doc_id", "n_shingles", "c", "c2"])

    return map_batches(docs, run, "doc_id long, n_shingles long, c long, c2 long")


def _keys(docs: DataFrame) -> DataFrame:
    """``(key, c, shown)``: the emitted parts, of equal sets once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for batch in batches:
            for _, sets, ends in shingle_sets(batch.column(1)):
                c, _ = set_names(sets, ends)
                starts = np.concatenate([[0], ends[:-1]])
                fresh = []
                for i, name in enumerate(c.tolist()):
                    if name not in done and ends[i] > starts[i]:
                        done.add(name)
                        fresh.append(i)
                fresh = np.array(fresh, np.int64)
                sizes = ends - starts
                own = sets[_members(ends, sizes, fresh)]
                key, name, shown = part_keys(own, np.cumsum(sizes[fresh]), c[fresh])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key.view(np.int64)), pa.array(name), pa.array(shown.astype(np.int32))], ["key", "c", "shown"])

    return map_batches(docs, run, "key long, c long, shown int")


def _candidates(docs: DataFrame) -> DataFrame:
    """``(key, c)``: parts in which a class must look for partners."""
    keys = _keys(docs)
    # Counted on a shortened key, whose rows pack well; a key counted too high only stays longer.
    counts = keys.select(F.shiftrightunsigned("key", 16).alias("short")).groupBy("short").agg(F.count("*").alias("rows"))
    shared = keys.withColumn("short", F.shiftrightunsigned("key", 16)).join(counts.where("rows > 1"), "short").drop("short")
    shared = stage(shared, "shared_parts")
    # Rows of one class: at most its emitted parts, some hundredths of a text's words.
    distinct = shared.dropDuplicates(["c", "key"])
    rank = F.row_number().over(Window.partitionBy("c").orderBy("rows", "key"))
    total = F.count("*").over(Window.partitionBy("c"))
    narrowed = distinct.withColumn("rank", rank).withColumn("total", total).where("rank <= total - shown + 1")
    return stage(narrowed.select("key", "c"), "candidate_parts")


def _fetch(docs: DataFrame, classes: DataFrame, members: DataFrame) -> DataFrame:
    """``(c, n, items, sketch)``: the sets of classes, computed again from one text each."""
    wanted = stage(
        members.join(classes, "c", "left_semi").groupBy("c", "c2").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "c"),
        "wanted")
    # By shuffle at every size: the ids grow with the input.
    texts = docs.join(wanted.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, sets, ends in shingle_sets(batch.column(1)):
                c, _ = set_names(sets, ends)
                starts = np.concatenate([[0], ends[:-1]])
                yield pa.RecordBatch.from_arrays([
                    pa.array(c), pa.array(ends - starts),
                    pa.array([sets[a:b].tobytes() for a, b in zip(starts.tolist(), ends.tolist(), strict=True)], pa.binary()),
                    pa.array(sketches(sets, ends), pa.binary())], ["c", "n", "items", "sketch"])

    sets = map_batches(texts, run, "c long, n long, items binary, sketch binary")
    # Ids may repeat with other texts, and two sets might share one 64-bit name: keep what was asked for.
    return stage(sets.join(wanted.select("c").distinct(), "c", "left_semi").dropDuplicates(["c", "n", "sketch"]), "sets")


def _close_in_parts(parts: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` of classes of different components in one part whose sizes and sketches allow a link.

    ``parts(key, c, component)``. The members of a part are compared in blocks; a part of many
    blocks is spread over as many groups as pairs of blocks. A first pass only tells which classes
    have such a partner. A second one over these, which know all their parts, returns a pair from
    the least part that both are in.
    """
    short = sets.select("c", "n", "sketch")
    some = stage(_compared(parts.join(short, "c").withColumn("keys", F.array().cast("array<long>")), True), "have_close")
    parts = stage(parts.join(some.select("c").distinct(), "c", "left_semi"), "close_parts")
    keys = parts.groupBy("c").agg(F.collect_list("key").alias("keys"))  # a class's own emitted parts
    return _compared(parts.join(short, "c").join(keys, "c"), False)


def _compared(rows: DataFrame, members: bool) -> DataFrame:
    """``(c)`` of the classes with a close partner in a part, or the close pairs ``(a, b)``."""
    blocks = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    rows = rows.join(blocks, "key").withColumn("own", F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int"))
    both = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    rows = rows.select("key", "c", "component", "n", "sketch", "keys", "own", both).select(
        "key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "c", "component", "n", "sketch",
        "keys")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, 3):
            own, c, component, n = (np.asarray(batch.column(k)) for k in (3, 4, 5, 6))
            key, i, j = (np.asarray(batch.column(k)) for k in (0, 1, 2))
            head = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
            found = []
            for start, end in zip(head.tolist(), [*head[1:].tolist(), len(key)], strict=True):
                if end - start < 2:
                    continue
                sketch = [np.frombuffer(x.as_buffer(), np.uint8) for x in batch.column(7).slice(start, end - start)]
                width = min(map(len, sketch))
                bits = np.stack([folded(x, width) for x in sketch]).view(np.uint64)
                left = np.flatnonzero(own[start:end] == i[start])
                right = np.flatnonzero(own[start:end] == j[start])
                size, name, comp = n[start:end], c[start:end], component[start:end]
                lists: dict[int, set[int]] = {}

                def least(p: int, q: int, start=start, lists=lists) -> bool:
                    for r in (p, q):
                        if r not in lists:
                            lists[r] = set(batch.column(8)[start + r].as_py())
                    return min(lists[p] & lists[q]) == key[start]

                for k in range(0, len(left), 64):
                    a = left[k:k + 64, None]
                    good = (comp[a] != comp[right]) & (5 * size[a] >= 4 * size[right]) & (5 * size[right] >= 4 * size[a])
                    x, y = np.nonzero(good)
                    x, y = left[k + x], right[y]
                    for at in range(0, len(x), 1 << 14):
                        p, q = x[at:at + (1 << 14)], y[at:at + (1 << 14)]
                        near = 9 * np.bitwise_count(bits[p] ^ bits[q]).sum(1, dtype=np.int64) <= size[p] + size[q]
                        if members:
                            found.append((name[np.union1d(p[near], q[near])],))
                            continue
                        near = [(r, t) for r, t in zip(p[near].tolist(), q[near].tolist(), strict=True) if least(r, t)]
                        if near:
                            p, q = np.array(near).T
                            found.append((name[p], name[q]))
            if found and members:
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate([f[0] for f in found])))], ["c"])
            elif found:
                x, y = (np.concatenate(f) for f in zip(*found, strict=True))
                pairs = np.unique(np.stack([np.minimum(x, y), np.maximum(x, y)]), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])

    order = ["key", "i", "j"]
    rows = rows.repartition(*order).sortWithinPartitions(*order)
    return map_batches(rows, run, "c long" if members else "a long, b long").distinct()


def _close(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs ``(a, b)`` whose sizes and sketches allow a link; whole sets are moved for these only."""
    short = sets.select("c", "n", "sketch")
    both = pairs.join(short.toDF("a", "na", "sa"), "a").join(short.toDF("b", "nb", "sb"), "b").where(
        "5 * least(na, nb) >= 4 * greatest(na, nb)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for x, y, total in zip(batch.column(2), batch.column(3), batch.column(4).to_pylist(), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint8), np.frombuffer(y.as_buffer(), np.uint8)
                width = min(len(x), len(y))
                near.append(9 * int(np.bitwise_count(folded(x, width) ^ folded(y, width)).sum()) <= total)
            near = pa.array(near, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(near), batch.column(1).filter(near)], ["a", "b"])

    return map_batches(both.selectExpr("a", "b", "sa", "sb", "na + nb as total"), run, "a long, b long")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Pairs of classes with a similarity of at least 4/5, on whole sets."""
    whole = sets.select("c", "items")
    both = pairs.join(whole.toDF("a", "xa"), "a").join(whole.toDF("b", "xb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= 80 * (len(x) + len(y) - common))
            good = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], ["u", "v"])

    return map_batches(both.select("a", "b", "xa", "xb"), run, "u long, v long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row per row of ``docs``.

    Words are lower-cased (A-Z) runs without ASCII white space; a text's set holds the hashes of
    its five-word shingles, or of its whole word sequence if shorter. Null, empty and blank texts
    have no set and link with nothing. ``component_id`` is the least id reachable over links of
    similarity 0.8 or more. Repeated rows link with each other; a row with a null id takes part in
    nothing and has a null component. Other columns are ignored.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    known = docs.where("doc_id is not null")
    rows = stage(_fingerprints(docs), "fingerprints")
    members = rows.where("doc_id is not null and n_shingles > 0")
    parts = _candidates(known)
    sets = _fetch(known, parts.select("c").distinct(), members)
    # First every class with the least class of each of its parts: links in proportion to the rows.
    least = parts.groupBy("key").agg(F.min("c").alias("b"))
    tried = stage(parts.join(least, "key").where("c <> b").select(F.col("c").alias("a"), "b").distinct(), "first_pairs")
    links = stage(_verified(stage(_close(tried, sets), "first_close"), sets), "first_links")
    # Then classes of one part that no link connects yet.
    component = stage(connected_components(links), "first_components")
    placed = parts.join(component, F.col("c") == F.col("node"), "left").select(
        "key", "c", F.coalesce("component", "c").alias("component"))
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key")
    placed = stage(placed.join(split, "key", "left_semi"), "open_parts")
    more = _verified(stage(_close_in_parts(placed, sets), "rest_close"), sets)
    links = stage(links.union(more), "links")
    # Components of documents: a class hangs on its least document, linked classes on each other.
    classes = stage(members.groupBy("c", "c2").agg(F.min("doc_id").alias("rep")), "classes")
    edges = links.join(classes.select(F.col("c").alias("u"), F.col("rep").alias("x")), "u").join(
        classes.select(F.col("c").alias("v"), F.col("rep").alias("y")), "v").select(F.col("x").alias("u"), F.col("y").alias("v"))
    component = connected_components(edges)
    of_class = classes.join(component, F.col("rep") == F.col("node"), "left").select(
        "c", "c2", F.coalesce("component", "rep").alias("least"))
    return rows.join(of_class, ["c", "c2"], "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))
