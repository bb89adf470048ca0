"""Reading raw HTML with regular expressions; stored pages are rarely well-formed XML."""

from html.entities import html5, name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from duskwatch.functions.base import bind

_COMMENT = r"(?s)<!--.*?(?:-->|\z)"
_TAG = r"(?s)</?[A-Za-z!?][^>]*>"


def _element(name: str) -> str:
    return rf"(?is)<{name}\b.*?(?:</{name}\s*>|\z)"


#: Their content is no markup, so they end at their first end tag.
_RAW = ("script", "style", "noscript")
_BOILERPLATE = ("head", "nav", "footer", "header", "aside", "table")
#: Elements without content or end tag.
_VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr")
_BLOCK_END = r"(?i)<(?:br|hr)\b[^>]*>|</(?:p|div|li|ul|ol|h[1-6]|article|section|main|blockquote|pre|dd|dt)\s*>"


def decode_entities(text: Column) -> Column:
    """Replace named and numeric character references of HTML 5; unknown names stay as they are.

    A name that ends with a semicolon has to be known as a whole. Without one, the longest of the
    old names that may stand alone counts: ``&notit`` is ``¬it``.
    """
    # Constant maps, written as text so that the plan holds two literals; common names come first.
    def names(wanted: list[str]) -> Column:
        listed = "\x01".join(f"{name}\x02{html5[name]}" for name in wanted)
        return F.str_to_map(F.lit(listed), F.lit("\x01"), F.lit("\x02"))

    common = {f"{name};" for name in name2codepoint}
    closed = names(sorted((name for name in html5 if name.endswith(";")), key=lambda name: (name not in common, name)))
    alone = sorted((name for name in html5 if not name.endswith(";")), key=lambda name: (-len(name), name))
    open_names, open_pattern = names(alone), f"^(?:{'|'.join(alone)})"

    def code_point(number: Column) -> Column:
        known = number.between(1, 0xD7FF) | number.between(0xE000, 0x10FFFF)
        return F.when(known, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise(F.lit("�"))

    def piece(part: Column, i: Column) -> Column:
        number = F.regexp_extract(part, r"^(#\d{1,9}|#[xX][0-9a-fA-F]{1,7});?", 1)
        rest = F.regexp_replace(part, r"^(?:#\d{1,9}|#[xX][0-9a-fA-F]{1,7});?", "")
        value = F.when(
            number.rlike("^#[xX]"), code_point(F.conv(F.substr(number, F.lit(3)), 16, 10).cast("bigint"))).otherwise(
            code_point(F.substr(number, F.lit(2)).cast("bigint")))
        name, old = F.regexp_extract(part, "^[A-Za-z][A-Za-z0-9]*;", 0), F.regexp_extract(part, open_pattern, 0)
        found = F.when(number != "", F.concat(value, rest)).otherwise(F.coalesce(
            F.concat(F.try_element_at(closed, name), F.substr(part, F.length(name) + 1)),
            F.concat(F.try_element_at(open_names, old), F.substr(part, F.length(old) + 1))))
        return F.when(i == 0, part).otherwise(F.coalesce(found, F.concat(F.lit("&"), part)))

    return bind(text, lambda t: F.when(
        t.contains("&"), F.array_join(F.transform(F.split(t, "&"), piece), "")).otherwise(t))


def html_title(html: Column) -> Column:
    """Text of the first title element; empty if missing or not plain text."""
    raw = F.regexp_extract(html, r"(?is)<title\b[^>]*>(.*?)</title\s*>", 1)
    return bind(raw, lambda t: F.when(t.rlike(_TAG), F.lit("")).otherwise(F.coalesce(decode_entities(t), F.lit(""))))


def html_description(html: Column) -> Column:
    """Content of the first description meta element, whatever the attribute order."""
    tag = F.regexp_extract(html, r"""(?is)<meta\b(?=[^>]*\bname\s*=\s*["']?description["'\s/>])[^>]*>""", 0)
    quoted = [r'(?is)\bcontent\s*=\s*"([^"]*)"', r"(?is)\bcontent\s*=\s*'([^']*)'"]
    bare = r"""(?is)\bcontent\s*=\s*([^\s"'>]+)"""
    content = bind(tag, lambda t: F.coalesce(
        *[F.nullif(F.regexp_extract(t, pattern, 1), F.lit("")) for pattern in quoted], F.regexp_extract(t, bare, 1)))
    return F.coalesce(decode_entities(content), F.lit(""))


def outside(html: Column, names: tuple[str, ...]) -> Column:
    """The markup outside the elements with these names, however they are nested.

    A page is split before every tag. One pass over the pieces keeps the names of the open
    elements, innermost first, and how many were open when a listed element began: pieces are left
    out until fewer are. An end tag closes the innermost element of its name and all that were
    opened inside it and never closed; one without such an element closes nothing. So an element
    without an end tag ends with its parent.
    """
    def step(state: Column, piece: Column) -> Column:
        name = F.lower(F.regexp_extract(piece, r"^</?([A-Za-z][A-Za-z0-9:-]*)", 1))
        return bind(F.struct(state.alias("s"), name.alias("name")), lambda x: walked(x["s"], x["name"], piece))

    def walked(state: Column, name: Column, piece: Column) -> Column:
        opened, since = state["open"], state["since"]
        at = F.array_position(opened, name)
        rest = F.slice(opened, (at + 1).cast("int"), F.greatest(F.size(opened), F.lit(1)))
        ends, none = piece.startswith("</"), (name == "") | name.isin(*_VOID) | piece.rlike(r"^<[^>]*/>")
        begins = ~ends & ~none
        depth = F.size(opened)
        closed = ends & (at > 0)
        left_after = F.when(closed, depth - at).otherwise(depth)
        hidden = F.when(closed & (left_after < since), 0).when(begins & (since == 0) & name.isin(*names), depth + 1).otherwise(since)
        return F.struct(
            F.when(closed, rest).when(begins, F.concat(F.array(name), opened)).otherwise(opened).alias("open"),
            hidden.cast("int").alias("since"),
            F.concat(state["kept"], F.when(hidden == 0, "1").otherwise("0")).alias("kept"))

    def kept(pieces: Column) -> Column:
        start = F.struct(F.array().cast("array<string>").alias("open"), F.lit(0).alias("since"), F.lit("").alias("kept"))
        flags = F.aggregate(pieces, start, step, lambda state: F.split(state["kept"], ""))
        return bind(flags, lambda f: F.array_join(F.filter(pieces, lambda p, i: F.get(f, i) == "1"), ""))

    return bind(F.split(html, r"(?=</?[A-Za-z])"), kept)


def main_content(html: Column) -> Column:
    """Main text of a page, one line per block, without navigation, tables and markup."""
    text = F.regexp_replace(html, _COMMENT, "")
    for name in _RAW:
        text = F.regexp_replace(text, _element(name), "")
    listed = rf"(?i)<(?:{'|'.join(_BOILERPLATE)})\b"
    text = bind(text, lambda t: F.when(t.rlike(listed), outside(t, _BOILERPLATE)).otherwise(t))
    text = F.regexp_replace(text, _BLOCK_END, "\n")
    text = decode_entities(F.regexp_replace(text, _TAG, ""))
    text = F.regexp_replace(text, r"[\t\x0b\f\r  ]+", " ")
    text = F.regexp_replace(text, r" ?\n[ \n]*", "\n")
    return F.coalesce(F.regexp_replace(text, r"^[ \n]+|[ \n]+\z", ""), F.lit(""))


def visible_text(html: Column) -> Column:
    """Text nodes below the body except those of scripts; node borders become spaces."""
    body = F.regexp_replace(html, r"(?is)^.*?<body\b[^>]*>", "")
    body = F.regexp_replace(body, _COMMENT, " ")
    body = F.regexp_replace(body, _element("script"), " ")
    return decode_entities(F.regexp_replace(body, _TAG, " "))


def href_values(html: Column) -> Column:
    """Raw link targets of the anchor and area elements."""
    found = F.regexp_extract_all(
        html, F.lit(r"""(?is)<(?:a|area)\b[^>]*?\bhref\s*=\s*["']([^"']*)["']"""), F.lit(1)
    )
    return F.transform(found, lambda h: decode_entities(F.trim(h)))


def resolve_link(base: Column, href: Column) -> Column:
    """Absolute form of a link found on page ``base``; fragments are dropped."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    page = F.regexp_replace(base, r"[?#].*$", "")
    folder = F.when(page.rlike(r"^[^/]+//[^/]*$"), F.concat(page, F.lit("/"))).otherwise(
        F.regexp_replace(page, r"[^/]*$", ""))
    target = F.regexp_replace(href, r"#.*$", "")
    return (
        F.when(target.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), target)
        .when(target.startswith("//"), F.concat(scheme, F.lit(":"), target))
        .when(target.startswith("/"), F.concat(origin, target))
        .when(target.startswith("?"), F.concat(page, target))
        .when(target == "", F.regexp_replace(base, r"#.*$", ""))
        .otherwise(F.concat(folder, target))
    )


def snippet_rows(snippet: Column) -> Column:
    """Rows of a search-hit snippet as ``(line_no, line)`` structs, marked lines only."""
    rows = F.regexp_extract_all(snippet, F.lit(r"(?is)<tr\b.*?</tr\s*>"), F.lit(0))
    parsed = F.transform(rows, lambda row: F.struct(
        F.trim(F.regexp_extract(row, r"""(?is)<div\b[^>]*class\s*=\s*["'][^"']*lineno[^"']*["'][^>]*>(.*?)</div""", 1))
        .alias("line_no"),
        F.regexp_extract(row, r"(?is)<pre\b[^>]*>(.*?)</pre", 1).alias("code"),
    ))
    marked = F.filter(parsed, lambda r: r["code"].contains("<mark"))
    return F.transform(marked, lambda r: F.struct(
        r["line_no"].alias("line_no"),
        decode_entities(F.regexp_replace(r["code"], _TAG, "")).alias("line"),
    ))
