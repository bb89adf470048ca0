"""Near-duplicate lines across all documents, by an exact set-similarity join in DataFrame functions.

A line's set holds its distinct lower-cased (A-Z) words. Its words are ordered by rarity: by how
often words of their bucket (``BUCKETS`` hash buckets, a bounded table that covers all lines)
occur, then by hash. Two sets with Jaccard similarity 4/5 or more share one of their first
``n - ceil(4n/5) + 1`` words (prefix filter), the smaller one within its first ``n - ceil(8n/9) + 1``,
at places that leave enough common words (positional filter), and their sizes differ by a quarter at
most (length filter); a parity sketch of 128 bits per set, compared in the join, bounds the difference
from below. Pairs that pass are verified on their whole sets, as 64-bit hashes of the words. A line
goes if a similar or equal line stands earlier, in another document or its own. Equal sets are told
by 128 bits over their hashes. Lines without words stay.

A row is named by its id and a hash of its text, so texts of one id, or of none, are kept apart.
"""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.llm.scratch import discard, free_names, stage

BUCKETS = 1 << 17
#: Least hashes of a line's prefix by which, besides its rarest word, it first meets earlier lines, and
#: how many lines for each: the earliest of every share of the lines that meet by it.
LEAST, SAMPLES = 4, 8


def _plain_words(line: Column) -> Column:
    """Runs without ASCII white space, A-Z in lower case; empty ones between them."""
    spaces = "\t\x0b\x0c\r"
    found = F.contains(line, F.lit(spaces[0]))
    for c in spaces[1:]:
        found = found | F.contains(line, F.lit(c))
    line = F.when(found, F.translate(line, spaces, "    ")).otherwise(line)
    # ``lower`` is the faster one, and right for ASCII only.
    upper, small = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    lowered = F.transform(F.split(line, " "), lambda w: F.when(_ascii(w), F.lower(w)).otherwise(F.translate(w, upper, small)))
    return F.when(_ascii(line), F.split(F.lower(line), " ")).otherwise(lowered)


def _ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def _hashes(line: Column) -> Column:
    """Distinct 64-bit hashes of a line's words, in order."""
    hashes = F.transform(_plain_words(line), lambda w: F.xxhash64(w))
    return F.sort_array(F.array_distinct(F.array_remove(hashes, F.xxhash64(F.lit("")))))


def _text_id(text: Column) -> Column:
    """Tells the texts of one id apart."""
    return F.xxhash64(text)


def _lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_id, line_no, line)`` of all texts; a null id sorts first."""
    return docs.where("text is not null").select("doc_id", _text_id(F.col("text")).alias("text_id"), F.posexplode(F.split("text", "\n", -1)).alias("line_no", "line"))


def _rarity(lines: DataFrame) -> list[int]:
    """Per bucket a class of how many words of all lines fall into it; four classes to a doubling."""
    words = lines.select(F.explode(_plain_words(F.col("line"))).alias("w")).where("w <> ''")
    counts = words.groupBy(F.xxhash64("w").bitwiseAND(BUCKETS - 1).cast("int").alias("b")).agg(F.count("*").alias("n"))
    classes = [0] * BUCKETS
    for row in counts.collect():  # as many rows as buckets at most
        classes[row["b"]] = round(4 * math.log2(row["n"])) + 1
    return classes


def _by_rarity(hashes: Column, classes: list[int]) -> Column:
    """One number per word, the rarest first: the class of its bucket, then 40 bits of its hash."""
    # A constant, folded to one array when the query is planned.
    table = F.from_json(F.lit(str(classes)), "array<bigint>")
    return F.sort_array(F.transform(hashes, lambda h: F.shiftleft(F.get(table, h.bitwiseAND(BUCKETS - 1).cast("int")), 40).bitwiseOR(
        F.shiftrightunsigned(h, 24))))


def _parity(hashes: Column, half: int) -> Column:
    """Half of 128 bits of which every word flips one: sets differ in as many words at least as sketches in bits."""
    def bit(h: Column) -> Column:
        mine = F.shiftrightunsigned(h, 57).bitwiseAND(1)
        mine = mine if half else mine.bitwiseXOR(F.lit(1).cast("long"))
        return F.call_function("shiftleft", mine, F.shiftrightunsigned(h, 58).cast("int"))

    return F.aggregate(hashes, F.lit(0).cast("long"), lambda bits, h: bits.bitwiseXOR(bit(h)))


def _prefix_length(n: Column) -> Column:
    return n - F.ceil(4 * n / 5).cast("int") + 1


def duplicate_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_id, line_no)`` of the lines that go, for ``docs(doc_id, text)``."""
    lines = _lines(docs)
    classes = _rarity(lines)
    h = F.col("h")
    sets = lines.select("doc_id", "text_id", "line_no", _hashes(F.col("line")).alias("h")).select(
        "doc_id", "text_id", "line_no", F.xxhash64("h").alias("set"), F.xxhash64(F.lit(1), "h").alias("set2"), F.size("h").alias("n"),
        F.slice(_by_rarity(h, classes), 1, _prefix_length(F.size("h"))).alias("prefix"), _parity(h, 0).alias("bits"), _parity(h, 1).alias("bits2"))
    sets = stage(sets.where("n > 0"), "line_sets")
    # Equal sets: all lines but the first. Later steps see one line per set, named by a number that
    # follows the order of places: ranges are sorted, and numbers ascend in and over them.
    first = sets.groupBy("set", "set2").agg(
        F.min(F.struct("doc_id", "line_no", "text_id", "n", "prefix", "bits", "bits2")).alias("f"), F.count("*").alias("lines"))
    first = stage(first.select("set", "set2", "f.*", "lines").orderBy("doc_id", "line_no", "text_id").withColumn(
        "id", F.monotonically_increasing_id()), "first_lines")
    repeated = first.where("lines > 1").select("set", "set2", F.col("doc_id").alias("first_id"), F.col("text_id").alias("first_text"), F.col("line_no").alias("first_no"))
    later = stage(sets.select("set", "set2", "doc_id", "text_id", "line_no").join(repeated, ["set", "set2"]).where(
        "not (doc_id <=> first_id and text_id = first_text and line_no = first_no)").select("doc_id", "text_id", "line_no"), "repeated_lines")
    places = stage(first.select("id", "doc_id", "text_id", "line_no", "set", "set2"), "line_places")
    discard(sets)
    # Sets of up to 3 words are similar only to themselves. First each line meets a few early lines
    # by a few keys of its prefix: work in proportion to the lines, and enough for most copies.
    long = first.where("n > 3")
    rarest = long.select("id", "n", "bits", "bits2", F.lit(True).alias("open"), F.inline(_meeting_keys(F.col("prefix"))))
    share = F.pmod(F.xxhash64("id"), F.lit(SAMPLES))
    earliest = rarest.groupBy("token", share.alias("share")).agg(F.min(F.struct("id", "open", "n", "pos", "bits", "bits2")).alias("e"))
    rarest, earliest = (x.select("token", *_entry(c)) for x, c in ((rarest, ""), (earliest, "e.")))
    near = stage(_similar(_pairs(rarest, earliest, first=True), docs, places), "near_lines")
    # Of the other pairs only those matter whose later line is not explained by then. A larger line
    # looks for smaller ones: an open line for all, an explained line for open ones.
    marked = long.join(near.select(F.col("id").alias("near_id")), F.col("id") == F.col("near_id"), "left")
    marked = stage(marked.select("id", "n", "bits", "bits2", "prefix", F.col("near_id").isNull().alias("open")), "open_lines")
    discard(first)
    larger = marked.select("open", "id", "n", "bits", "bits2", F.posexplode("prefix").alias("pos", "token"))
    fewer = F.slice("prefix", 1, F.col("n") - F.ceil(8 * F.col("n") / 9).cast("int") + 1)
    smaller = marked.select("open", "id", "n", "bits", "bits2", F.posexplode(fewer).alias("pos", "token"))
    # Words of even and of odd number in runs of their own, so that half as much is shuffled at once.
    odd = F.col("token").bitwiseAND(1) == 1
    sides = [(larger.where("open").where(~odd), smaller.where(~odd)), (larger.where("not open"), smaller.where("open")),
             (larger.where("open").where(odd), smaller.where(odd))]
    runs = [stage(_pairs(*(x.select("token", *_entry("")) for x in side)), "pairs_of_run") for side in sides]
    discard(marked)
    more = stage(_similar(reduce(DataFrame.union, runs).distinct(), docs, places), "more_lines")
    discard(places, *runs)
    return reduce(DataFrame.union, (x.select("doc_id", "text_id", "line_no") for x in (later, near, more)))


def _meeting_keys(prefix: Column) -> Column:
    """``(pos, token)`` by which a line first meets earlier ones: its rarest word, and the least hashes of its prefix.

    Near copies differ in their rarest words, which moves all others to other places; the word of least
    hash is the same one wherever it stands, if both prefixes hold it.
    """
    rarest = F.struct(F.lit(0).alias("pos"), F.get(prefix, F.lit(0)).alias("token"))
    least = [F.struct(F.lit(0).alias("pos"), F.array_min(F.transform(prefix, lambda t: F.xxhash64(t, F.lit(i)))).alias("token"))  # noqa: B023
             for i in range(LEAST)]
    return F.array(rarest, *least)


def _entry(prefix: str) -> list[Column]:
    """What the join compares: a line's number, its size, the word's place and whether it is open in one number, its sketch."""
    place = F.shiftleft(F.col(f"{prefix}pos").cast("long"), 1).bitwiseOR(F.col(f"{prefix}open").cast("long"))
    size = F.shiftleft(F.col(f"{prefix}n").cast("long"), 32).bitwiseOR(place).alias("size")
    return [F.col(f"{prefix}id").alias("id"), size, F.col(f"{prefix}bits").alias("bits"), F.col(f"{prefix}bits2").alias("bits2")]


def _pairs(entries: DataFrame, others: DataFrame, first: bool = False) -> DataFrame:
    """Numbers ``(id, id2)`` of two lines that pass the filters, the later one open and the second not larger.

    With ``first`` the second only has to be earlier: it stands for the lines of its share.
    """
    others = others.select("token", *(F.col(c).alias(f"{c}_") for c in ("id", "size", "bits", "bits2")))
    n, n2 = F.shiftright("size", 32), F.shiftright("size_", 32)
    pos, pos2 = (F.shiftright(F.col(c).bitwiseAND((1 << 32) - 1), 1) for c in ("size", "size_"))
    later = F.when(F.col("id") > F.col("id_"), F.col("size")).otherwise(F.col("size_"))
    apart = sum((F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_"))) for c in ("bits", "bits2")), F.lit(0))
    # Two sets with similarity 4/5 have at least 4/9 of their sizes' sum in common.
    passed = (9 * apart <= n + n2) & (5 * n2 >= 4 * n) & (5 * n >= 4 * n2)
    passed = passed & (9 * F.least(n - pos, n2 - pos2) >= 4 * (n + n2))
    passed = passed & (F.col("id") > F.col("id_") if first else (F.col("id") != F.col("id_")) & (later.bitwiseAND(1) == 1) & (n2 <= n))
    return entries.hint("merge").join(others, "token").where(passed).select("id", F.col("id_").alias("id2")).distinct()


def _similar(pairs: DataFrame, docs: DataFrame, places: DataFrame) -> DataFrame:
    """``(id, doc_id, text_id, line_no)`` of the later lines of pairs whose whole word sets are similar.

    Nearly all pairs that pass the filters are similar, and one similar earlier line is enough. So
    each later line is verified against its earliest partner, and only those for which that one
    fails against the others: in a dense group the work grows with its lines, not with its pairs.
    """
    pairs = stage(pairs.select(F.greatest("id", "id2").alias("id"), F.least("id", "id2").alias("id2")).distinct(), "line_pairs")
    words = _line_words(pairs.select("id").union(pairs.select("id2")).distinct(), docs, places)
    one = stage(pairs.groupBy("id").agg(F.min("id2").alias("id2")), "first_partners")
    found = stage(_verified(one, words), "similar_to_one")
    rest = pairs.join(one, ["id", "id2"], "left_anti").join(found.select("id"), "id", "left_anti")
    return found.union(_verified(rest, words))


def _line_words(wanted: DataFrame, docs: DataFrame, places: DataFrame) -> DataFrame:
    """``(id, doc_id, text_id, line_no, words)`` of wanted lines: the hashes of their words."""
    wanted = stage(places.join(wanted, "id", "left_semi"), "wanted_lines")
    # One text per wanted row, and of it only the wanted lines.
    own = wanted.groupBy(F.col("doc_id").alias("_id"), F.col("text_id").alias("_text")).agg(
        F.collect_list(F.struct("id", "line_no", "set", "set2")).alias("places"))
    texts = docs.join(own, docs["doc_id"].eqNullSafe(own["_id"]) & (_text_id(docs["text"]) == own["_text"])).select(
        "doc_id", F.col("_text").alias("text_id"), F.split("text", "\n", -1).alias("all"), "places")
    found = texts.select("doc_id", "text_id", F.inline(F.transform("places", lambda p: F.struct(
        p["id"].alias("id"), p["line_no"].alias("line_no"), p["set"].alias("set"), p["set2"].alias("set2"), F.get("all", p["line_no"]).alias("line")))))
    found = found.select("id", "doc_id", "text_id", "line_no", "set", "set2", _hashes(F.col("line")).alias("words"))
    # Two texts of an id might share a name: keep the line that the set's name was made of.
    found = found.where((F.xxhash64("words") == F.col("set")) & (F.xxhash64(F.lit(1), "words") == F.col("set2")))
    return stage(found.dropDuplicates(["id"]).select("id", "doc_id", "text_id", "line_no", "words"), "line_words")


def _verified(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``(id, doc_id, text_id, line_no)`` of the first lines of pairs whose whole word sets have Jaccard similarity 4/5 or more."""
    a, b = words.alias("a"), words.withColumnRenamed("id", "id2").alias("b")
    both = pairs.join(a, "id").join(b, "id2")
    common = F.size(F.array_intersect("a.words", "b.words"))
    similar = both.where(100 * common >= 80 * (F.size("a.words") + F.size("b.words") - common))
    return similar.select("a.id", "a.doc_id", "a.text_id", "a.line_no").distinct()


def without_lines(
    docs: DataFrame, gone: DataFrame, text_col: str = "text", id_col: str = "doc_id", lines_col: str = "_lines",
    removed_col: str = "_removed",
) -> DataFrame:
    """``docs`` without the lines ``gone(doc_id, text_id, line_no)``, and two more columns: their numbers of lines and removed ones.

    Columns of ``docs`` keep their values, whatever their names, but for the text and those two.
    """
    kept_names = [c for c in docs.columns if c not in (lines_col, removed_col)]
    gone_id, gone_text, numbers = free_names(docs, "id", "text", "gone")
    gone = gone.groupBy(F.col("doc_id").alias(gone_id), F.col("text_id").alias(gone_text)).agg(F.collect_set("line_no").alias(numbers))
    lines = F.split(docs[text_col], "\n", -1)
    kept = F.filter(lines, lambda _, i: ~F.array_contains(gone[numbers], i))
    joined = docs.join(gone, docs[id_col].eqNullSafe(gone[gone_id]) & (_text_id(docs[text_col]) == gone[gone_text]), "left")
    return joined.select(
        *(F.when(gone[numbers].isNull(), docs[c]).otherwise(F.array_join(kept, "\n")).alias(c) if c == text_col else docs[c]
          for c in kept_names),
        F.coalesce(F.size(lines), F.lit(0)).alias(lines_col), F.coalesce(F.size(gone[numbers]), F.lit(0)).alias(removed_col))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, n_lines, n_removed)``: one row per row of ``docs``, without lines that repeat earlier ones.

    Earlier means a smaller id (null ids first), then a smaller line number, then a smaller hash of
    the text. Rows of one id, or of a null id, with different texts are different documents. Of
    repeated rows with one id and text all copies keep the same lines, as line places are equal. A null text stays
    null, an empty one empty; a text that loses all its lines is empty. Other columns are ignored.
    """
    docs = docs.select(id_col, text_col)
    gone = duplicate_lines(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    return without_lines(docs, gone, text_col, id_col, "n_lines", "n_removed")
