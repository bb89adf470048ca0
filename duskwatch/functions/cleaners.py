"""Text cleaners and the noise-removal chain built from them."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from duskwatch import constants as C
from duskwatch.functions.base import PUNCT, SPACE, SPACE_CHARS, SPACE_CLASS, WORD_CHAR, bind, collapse_spaces, strip_space, words
from duskwatch.functions.noise import keep_sentence

_JUNK = rf"{PUNCT}0-9"


def sentence_split(text: Column) -> Column:
    """Sentences end at ``.``, ``!`` or ``?`` followed by white space."""
    return F.split(F.rtrim(text, F.lit(SPACE_CHARS)), rf"(?<=[.!?]){SPACE_CLASS}+")


def word_tokens(text: Column) -> Column:
    """Runs of word characters, and every other visible character on its own."""
    return F.regexp_extract_all(text, F.lit(rf"[{WORD_CHAR}]+|[^{WORD_CHAR}{SPACE}]"), F.lit(0))


def breaks_to_periods(s: Column) -> Column:
    return F.replace(F.replace(s, F.lit("\n"), F.lit(". ")), F.lit("\t"), F.lit(". "))


def strip_special(s: Column) -> Column:
    return F.regexp_replace(s, f"[{C.SPECIAL_CHARACTERS}]", "")


def collapse_blanks(s: Column) -> Column:
    return F.regexp_replace(s, "  +", " ")


def strip_leading_junk(s: Column) -> Column:
    """Drop leading words made of punctuation and digits only, one in two.

    Let ``k`` be the first even position whose word has something left after removing
    leading punctuation and digits. Even positions before ``k`` go, odd ones stay, word
    ``k`` loses its leading junk. Without such a ``k`` all even positions go.
    """
    def bare(w: Column) -> Column:
        return F.regexp_replace(w, rf"^[{_JUNK}]+", "")

    def even(i: Column) -> Column:
        return i.bitwiseAND(F.lit(1)) == 0

    def from_words(w: Column) -> Column:
        found = F.array_position(F.transform(w, lambda x, i: even(i) & (bare(x) != "")), True)
        return bind(F.struct(w.alias("w"), (found - 1).alias("k")), cut)

    def cut(b: Column) -> Column:
        w, k = b["w"], b["k"]
        kept = F.filter(
            F.transform(w, lambda x, i: F.struct(i.alias("i"), F.when(i == k, bare(x)).otherwise(x).alias("x"))),
            lambda e: ~even(e["i"]) | ((k >= 0) & (e["i"] >= k)),
        )
        return F.array_join(F.transform(kept, lambda e: e["x"]), " ")

    # Nearly every sentence starts with a real word: one anchored replacement is enough.
    return bind(strip_space(collapse_spaces(s)), lambda p: (
        F.when(p.rlike(rf"^[{_JUNK}]*(?: |\z)"), bind(words(p), from_words)).otherwise(bare(p))))


def collapse_punctuation(s: Column) -> Column:
    return F.regexp_replace(s, rf"([^{WORD_CHAR}{SPACE}])\1+", "$1")


def space_before_punct(s: Column) -> Column:
    return F.regexp_replace(s, " ([!?,;:])", "$1")


def _drop_repeats(s: Column, separator: str, pattern: str) -> Column:
    return bind(F.split(s, pattern), lambda p: F.array_join(
        F.filter(p, lambda x, i: (i == 0) | (x != F.get(p, i - 1))), separator))


def dedup_adjacent_words(s: Column) -> Column:
    return _drop_repeats(s, " ", " ")


def dedup_adjacent_sentences(s: Column) -> Column:
    return _drop_repeats(s, ".", "[.]")


def end_with_period(s: Column) -> Column:
    def close(x: Column) -> Column:
        return F.when(F.contains(F.lit(C.PUNCTUATION), F.substring(x, -1, 1)), x).otherwise(F.concat(x, F.lit(".")))

    return strip_space(bind(s, close))


def capitalize_sentences(s: Column) -> Column:
    """One space and an upper-case letter at the start and after ``.``, ``!`` and ``?``."""
    def upper_first(x: Column) -> Column:
        return F.concat(F.upper(F.substring(x, 1, 1)), F.substr(x, F.lit(2)))

    def at_start(x: Column) -> Column:
        plain = F.regexp_replace(x, rf"^{SPACE_CLASS}+(?=[a-z])", "")
        return F.when(plain.rlike("^[a-z]"), F.concat(F.lit(" "), upper_first(plain))).otherwise(x)

    def cased(x: Column) -> Column:
        pieces = F.split(x, rf"(?<=[.!?]){SPACE_CLASS}*(?=[a-z])")
        return F.array_join(F.transform(
            pieces, lambda p, i: F.when(i == 0, at_start(p)).otherwise(upper_first(p))), " ")

    return bind(s, lambda x: F.when(x.rlike(rf"(?:^|[.!?]){SPACE_CLASS}*[a-z]"), cased(x)).otherwise(x))


def rewrite_separators(s: Column) -> Column:
    for old, new in C.SEPARATOR_REPLACEMENTS:
        s = F.replace(s, F.lit(old), F.lit(new))
    return strip_space(collapse_spaces(s))


def is_plain(s: Column) -> Column:
    """A capital, then letters, commas and single blanks up to one closing mark: only repeated words can change.

    Such a sentence has no break, special character, leading junk, doubled mark, blank before a mark
    or lower-case start, and it is closed.
    """
    odd = F.lit(False)
    for part in ("  ", ",,", " ,", " !", " ?"):
        odd = odd | s.contains(part)
    return s.rlike(r"^\p{Lu}[a-zA-Z ,\p{L}]*+[.!?]\z") & ~odd


def clean_sentence(s: Column) -> Column:
    def cleaned(x: Column) -> Column:
        for step in (
            breaks_to_periods, strip_special, collapse_blanks, strip_leading_junk, collapse_punctuation,
            space_before_punct, dedup_adjacent_words, end_with_period, capitalize_sentences,
        ):
            x = step(x)
        return x

    return bind(s, lambda x: F.when(is_plain(x), dedup_adjacent_words(x)).otherwise(cleaned(x)))


def remove_noise(text: Column, require_word: bool = False) -> Column:
    """Drop noise sentences, clean the others and join them again."""
    kept = F.filter(sentence_split(text), lambda s: keep_sentence(s, require_word))
    joined = F.array_join(F.transform(kept, lambda s: F.concat(clean_sentence(s), F.lit(" "))), "")
    return strip_space(dedup_adjacent_sentences(collapse_punctuation(rewrite_separators(joined))))


def compose_text(title: Column, description: Column, content: Column) -> Column:
    """Join the parts of a page into one text.

    A description equal to the title is left out, and so is a part that without its last
    character equals the text so far. Each part is closed by a period or, after ASCII
    punctuation, by a blank.
    """
    parts = F.when(title == description, F.array(title, content)).otherwise(F.array(title, description, content))

    def append(text: Column, part: Column) -> Column:
        body = F.substr(part, F.lit(1), F.length(part) - 1)
        closing = F.when(part.rlike(rf"[{PUNCT}]\z"), F.lit(" ")).otherwise(F.lit(". "))
        return F.when((part != "") & (body != text), F.concat(text, part, closing)).otherwise(text)

    return F.aggregate(parts, F.lit(""), append)


