"""Predicates that mark a sentence as noise."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from duskwatch import constants as C
from duskwatch.functions.base import WORD_CHAR, matches


def _bounded(pattern: str) -> str:
    """Spell a pattern's leading and trailing word boundary out for Unicode words."""
    body = pattern.removeprefix(r"\b").removesuffix(r"\b")
    return rf"(?<![{WORD_CHAR}]){body}(?![{WORD_CHAR}])"


# Each predicate first looks for a literal its pattern cannot match without; a substring
# search is far cheaper than a regular expression and settles nearly every sentence.

def has_address(s: Column) -> Column:
    return s.contains(C.ADDRESS_SUFFIX) & s.rlike(_bounded(C.NOISE_ADDRESS))


def has_pgp_block(s: Column) -> Column:
    return s.contains("-----BEGIN PGP") & matches(s, C.NOISE_PGP)


def has_email(s: Column) -> Column:
    return s.contains("@") & matches(s, C.NOISE_EMAIL)


def has_money(s: Column) -> Column:
    unit = s.contains("%") | s.contains("$") | s.contains("USD") | s.contains("EUR") | s.contains("BTC")
    return unit & matches(s, C.NOISE_MONEY)


def is_url(s: Column) -> Column:
    return s.contains("://") & matches(s, C.NOISE_URL, ignore_case=True)


def has_bitcoin(s: Column) -> Column:
    return s.rlike(C.NOISE_BITCOIN)


def is_web_tag(s: Column) -> Column:
    return s.isin(*C.WEB_TAGS)


def has_word(s: Column) -> Column:
    return s.rlike(_bounded(C.WORD))


REASONS = {
    "Onion": has_address,
    "PGP": has_pgp_block,
    "Email": has_email,
    "Monetary": has_money,
    "URL": is_url,
    "Bitcoin": has_bitcoin,
    "Webtag": is_web_tag,
}


def keep_sentence(s: Column, require_word: bool = False) -> Column:
    """True if no noise predicate fires. Sentences without a word pass unless asked for."""
    keep = F.lit(True)
    for fires in REASONS.values():
        keep = keep & ~fires(s)
    return keep & has_word(s) if require_word else keep


def noise_reasons(s: Column) -> Column:
    """Names of the predicates that fire on a sentence."""
    return F.array_compact(F.array(*[F.when(fires(s), F.lit(name)) for name, fires in REASONS.items()]))
