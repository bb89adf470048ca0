"""Format-preserving pseudonyms for personal values in texts.

Values are found by pattern, validated (check digits, calendar, ranges), and permuted with a key
by a Feistel network over exactly the values of their format. The same value has the same
pseudonym in every document, different values have different ones, and a pseudonym is again a
valid value of the format: card numbers keep a right check digit, dates stay dates.
"""

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from duskwatch.llm.shipping import map_batches
from duskwatch.llm.tokens import texts_of

ROUNDS = 10

#: A text without any of these characters holds no value.
_ANY = re.compile(r"[0-9@=]").search
#: Tokens of a match without a value.
_TOKEN_END = re.compile(r"[ -]").search
_VALUE = re.compile(
    r"(?P<email>(?<![\w.+-])[A-Za-z0-9](?:[A-Za-z0-9_.+-]{0,63})(?=@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}\b))"
    r"|(?P<key>\bAKIA[0-9A-Z]{16}\b)"
    r"|(?P<secret>(?<=password=)[^\s\"']{6,}|(?<=passwd=)[^\s\"']{6,}|(?<=api_key=)[^\s\"']{6,}|(?<=token = \")[^\s\"]{6,}(?=\")|(?<=token=)[^\s\"']{6,}|(?<=secret=)[^\s\"']{6,})"
    r"|(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[0-9A-Z]{4}){2,7}(?: ?[0-9A-Z]{1,3})?\b)"
    r"|(?P<phone>(?<![\w+])\+1[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9]))"
    r"|(?P<ip>(?<![\w.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\w|\.[0-9]))"
    r"|(?P<iso>(?<![\w-])[0-9]{4}-[0-9]{2}-[0-9]{2}(?![\w-]))"
    r"|(?P<dmy>(?<![\w./])[0-9]{2}(?P<sep>[./])[0-9]{2}(?P=sep)[0-9]{4}(?![\w/]|\.[0-9]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<![\w+-])[0-9](?:[ -]?[0-9]){12,18}(?![\w]|-[0-9]))"
)


class Feistel:
    """A keyed permutation of ``0 .. size - 1`` per kind of value."""

    def __init__(self, key: bytes):
        self.key = hashlib.blake2b(key).digest()

    def _round(self, kind: str, i: int, half: int, modulus: int) -> int:
        width = (modulus.bit_length() + 7) // 8 + 16
        seed = f"{kind}/{i}/{half}".encode()
        return int.from_bytes(hashlib.shake_256(self.key + seed).digest(width), "big") % modulus

    def __call__(self, kind: str, value: int, size: int, valid: Callable[[int], bool] = lambda x: True) -> int:
        """Walk the cycle of the network over a grid of at least ``size`` cells to the next valid value."""
        if size < 2:
            return value
        a = 1
        while a * a < size:
            a = a * 2
        b = -(-size // a)
        kind = f"{kind}/{size}"
        while True:
            left, right = divmod(value, b)  # left < a, right < b
            for i in range(0, ROUNDS, 2):
                left = (left + self._round(kind, i, right, a)) % a
                right = (right + self._round(kind, i + 1, left, b)) % b
            value = left * b + right
            if value < size and valid(value):
                return value


def luhn(digits: str) -> int:
    """The sum that is a multiple of 10 for a number with a right check digit."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total


def _check_digit(digits: str) -> str:
    return str(-luhn(digits + "0") % 10)


def _shorter(found: str, least: int, most: int) -> Iterator[str]:
    """``found`` and its beginnings of ``least`` to ``most`` characters besides separators, the longest first."""
    ends = [i + 1 for i, c in enumerate(found) if c not in " -"]
    for n in range(min(most, len(ends)), least - 1, -1):
        yield found[:ends[n - 1]]


def _fill(shape: str, characters: str, keep: str = " -") -> str:
    """``characters`` in the places of ``shape`` that are not separators."""
    following = iter(characters)
    return "".join(c if c in keep else next(following) for c in shape)


def _classes(text: str) -> list[tuple[int, int]]:
    """Per character the first of its class and the size of the class."""
    return [(48, 10) if "0" <= c <= "9" else (97, 26) if "a" <= c <= "z" else (65, 26) if "A" <= c <= "Z" else (ord(c), 1)
            for c in text]


def _characters(feistel: Feistel, kind: str, text: str) -> str:
    """Digits for digits, letters for letters of the same case; other characters stay."""
    classes = _classes(text)
    value, size = 0, 1
    for c, (base, n) in zip(text, classes, strict=True):
        value, size = value * n + ord(c) - base, size * n
    shape = "".join("0" if n == 10 else "a" if base == 97 else "A" if n == 26 else chr(base) for base, n in classes)
    value = feistel(f"{kind}/{shape}", value, size)
    out = []
    for base, n in reversed(classes):
        value, d = divmod(value, n)
        out.append(chr(base + d))
    return "".join(reversed(out))


def _card(f: Feistel, found: str) -> str | None:
    digits = re.sub("[ -]", "", found)
    if luhn(digits) % 10 or len(set(digits)) == 1:
        return None
    n = len(digits) - 1
    same = lambda v: len(set(f"{v:0{n}d}")) > 1 or _check_digit(f"{v:0{n}d}") != f"{v:0{n}d}"[0]
    body = f"{f('card', int(digits[:-1]), 10 ** n, same):0{n}d}"
    return _fill(found, body + _check_digit(body))


def _iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _iban(f: Feistel, found: str) -> str | None:
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _iban_rest(plain) != 1 or not 2 <= int(plain[2:4]) <= 98:
        return None
    body = _characters(f, f"iban/{plain[:2]}", plain[4:])
    check = 98 - _iban_rest(plain[:2] + "00" + body)
    return _fill(found, f"{plain[:2]}{check:02d}{body}", " ")


def _phone(f: Feistel, found: str) -> str:
    """Area code and exchange stay among those that begin with 0 or 1, or with 2 to 9."""
    digits = re.sub("[^0-9]", "", found)[1:]
    low = digits[0] < "2", digits[3] < "2"
    number = f("phone", int(digits), 10 ** 10, lambda v: (v < 2 * 10 ** 9, v // 10 ** 6 % 10 < 2) == low)
    following = iter(f"{number:010d}")
    return "+1" + "".join(next(following) if c.isdigit() else c for c in found[2:])


def _ip(f: Feistel, found: str) -> str | None:
    parts = [int(p) for p in found.split(".")]
    if max(parts) > 255 or any(len(p) > 1 and p[0] == "0" for p in found.split(".")):
        return None
    value = f("ip", int.from_bytes(bytes(parts), "big"), 1 << 32)
    return ".".join(map(str, value.to_bytes(4, "big")))


def _ssn(f: Feistel, found: str) -> str | None:
    def valid(v: int) -> bool:
        area, group, serial = v // 10 ** 6, v // 10 ** 4 % 100, v % 10 ** 4
        return 0 < area < 900 and area != 666 and group > 0 and serial > 0

    value = int(found.replace("-", ""))
    if not valid(value):
        return None
    digits = f"{f('ssn', value, 10 ** 9, valid):09d}"
    return f"{digits[:3]}-{digits[3:5]}-{digits[5:]}"


_CENTURIES = ((datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal()), (1, datetime.date.max.toordinal() + 1))


def _date(f: Feistel, year: str, month: str, day: str) -> datetime.date | None:
    """A date of 1900 to 2099 stays in these years, any other among all other four-digit years."""
    try:
        value = datetime.date(int(year), int(month), int(day)).toordinal()
    except ValueError:
        return None
    (low, high), (first, end) = _CENTURIES
    if low <= value < high:
        return datetime.date.fromordinal(low + f("date", value - low, high - low))
    return datetime.date.fromordinal(first + f("year", value - first, end - first, lambda v: not low <= first + v < high))


def _iso(f: Feistel, found: str) -> str | None:
    day = _date(f, *found.split("-"))
    return day and f"{day.year:04d}-{day.month:02d}-{day.day:02d}"


def _dmy(f: Feistel, found: str) -> str | None:
    """Day first; month first only where day first is no date."""
    a, b, year, sep = found[:2], found[3:5], found[6:], found[2]
    day = _date(f, year, b, a)
    if day:
        return f"{day.day:02d}{sep}{day.month:02d}{sep}{day.year:04d}"
    day = _date(f, year, a, b)
    if not day:
        return None
    # Month first is the only reading of ``found`` and must stay the only one of its pseudonym.
    value = day
    while value.day <= 12:
        value = _date(f, f"{value.year:04d}", str(value.month), str(value.day))
    return f"{value.month:02d}{sep}{value.day:02d}{sep}{value.year:04d}"


#: Lengths of values that are looked for within a longer match.
_LENGTHS = {"iban": (15, 34), "card": (13, 19)}

#: Lengths of the IBANs of a country.
_COUNTRY = {c: n for n, names in {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for c in names.split()}

_KINDS: dict[str, Callable[[Feistel, str], str | None]] = {
    "email": lambda f, s: _characters(f, "email", s),
    "key": lambda f, s: "AKIA" + _characters(f, "key", s[4:]),
    "secret": lambda f, s: _characters(f, "secret", s),
    "iban": _iban, "phone": _phone, "ip": _ip, "iso": _iso, "dmy": _dmy, "ssn": _ssn, "card": _card,
}


def _replaced(kind: str, found: str, feistel: Feistel) -> tuple[str, str | None]:
    """The longest valid value that begins a match and its pseudonym; a value ends where a word does.

    An IBAN of its country's length comes before longer ones.
    """
    values = list(_shorter(found, *_LENGTHS[kind])) if kind in _LENGTHS else [found]
    if kind == "iban":
        values.sort(key=lambda v: len(v.replace(" ", "")) != _COUNTRY.get(v[:2]))
    for value in values:
        if found[len(value):len(value) + 1] in ("", " ", "-"):
            new = _KINDS[kind](feistel, value)
            if new is not None:
                return value, new
    return found, None


def _next_token(m: re.Match) -> int:
    """The start of the second token of a match without a value, or its end."""
    token = _TOKEN_END(m.string, m.start(), m.end())
    return token.end() if token else m.end()


def pseudonymise(text: str | None, feistel: Feistel) -> tuple[str | None, list[dict]]:
    """The text with pseudonyms, and the kind and place of each replaced value in the given text."""
    if not text or not _ANY(text):
        return text, []
    out, at, found, place = [], 0, [], 0
    while m := _VALUE.search(text, place):
        kind = m.lastgroup if m.lastgroup != "sep" else "dmy"
        value, new = _replaced(kind, m.group(), feistel)
        if new is None:
            # A value of another kind, or a later one, may begin within the match.
            place = _next_token(m)
            continue
        end = m.start() + len(value)
        out += [text[at:m.start()], new]
        at = place = end
        found.append({"kind": {"iso": "date", "dmy": "date"}.get(kind, kind), "start": m.start(), "end": end})
    return ("".join([*out, text[at:]]), found) if found else (text, [])


def pseudonymise_documents(
    docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, text, values, n_values)``: whole texts with pseudonyms, kinds and places in the old text.

    Null and empty texts stay as they are; rows with a null id and repeated rows are kept; other
    columns are ignored. No shuffle: equal values meet by the key alone.
    """
    fields = {f.name: f for f in docs.schema.fields}
    value = StructType().add("kind", StringType()).add("start", LongType()).add("end", LongType())
    schema = StructType([fields[id_col], fields[text_col]]).add("values", ArrayType(value)).add("n_values", LongType())
    kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        feistel = Feistel(key)
        for batch in batches:
            done = [pseudonymise(t, feistel) for t in texts_of(batch.column(1))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([t for t, _ in done], batch.column(1).type), pa.array([v for _, v in done], kinds),
                pa.array([len(v) for _, v in done], pa.int64())], [id_col, text_col, "values", "n_values"])

    return map_batches(docs.select(id_col, text_col), run, schema)
