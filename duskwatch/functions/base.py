"""Small helpers shared by the column functions."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space, letters-or-digits, and ASCII punctuation as explicit classes, so the
# meaning does not depend on a regex engine's defaults. The ASCII members are listed, though
# the categories contain them, because they are found faster that way.
OTHER_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE = rf" {OTHER_SPACE}"
# The same as complete bracket expressions: one wide range rejects nearly every character
# before the exact members are looked at, several times faster on long texts.
_NEAR_SPACE = r"\t-\r\x1c-\x1f\x85\xa0\u1680-\u3000"
OTHER_SPACE_CLASS = rf"[{_NEAR_SPACE}&&[{OTHER_SPACE}]]"
SPACE_CLASS = rf"[ {_NEAR_SPACE}&&[{SPACE}]]"
WORD_CHAR = r"a-zA-Z0-9_\p{L}\p{N}"
PUNCT = r"!-/:-@\[-`{-~"


def unicode_regex(pattern: str, ignore_case: bool = False) -> str:
    """Unicode character classes, and only a line feed counts as a line end."""
    return f"(?{'i' if ignore_case else ''}dU){pattern}"


def matches(col: Column, pattern: str, ignore_case: bool = False) -> Column:
    return F.coalesce(col, F.lit("")).rlike(unicode_regex(pattern, ignore_case))


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it many times inside ``body``.

    Lambda bodies get no common-subexpression elimination, so an array needed by index
    inside ``filter`` or ``transform`` has to be bound to a name first.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# The characters of SPACE, for trimming without a regular expression.
SPACE_CHARS = "".join(chr(c) for c in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
    0x205F, 0x3000))


def strip_space(col: Column) -> Column:
    return F.btrim(col, F.lit(SPACE_CHARS))


def collapse_spaces(col: Column) -> Column:
    """Every run of white space becomes one blank."""
    return F.regexp_replace(F.regexp_replace(col, OTHER_SPACE_CLASS, " "), "  +", " ")


def words(col: Column) -> Column:
    """White-space separated words, without empty ones."""
    return F.filter(F.split(col, f"{SPACE_CLASS}+"), lambda w: w != "")
