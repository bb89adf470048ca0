"""Hand-written cases for extractors, noise predicates and cleaners."""

import pytest
from pyspark.sql import functions as F

from duskwatch.functions import addresses as A
from duskwatch.functions import cleaners as K
from duskwatch.functions import html as H
from duskwatch.functions import noise as N

ONION = "a" * 55 + "d.onion"
OTHER = "b" * 55 + "d.onion"


def apply(spark, fn, values):
    schema = "i int, " + ", ".join(f"c{j} string" for j in range(len(values[0])))
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], schema).repartition(2)
    rows = df.select("i", fn(*[F.col(f"c{j}") for j in range(len(values[0]))]).alias("r")).orderBy("i").collect()
    return [r["r"] for r in rows]


CASES = {
    "extract_addresses": (A.extract_addresses, [
        (f"x {ONION} y {OTHER}/ {ONION}", [ONION, OTHER]), ("none " + "a" * 55 + "e.onion", []), ("", [])]),
    "first_address": (A.first_address, [(f"http://{ONION}/{OTHER}", ONION), ("http://x.org", None)]),
    "gateway_address": (A.gateway_address, [
        ("https://" + "a" * 55 + "d.gw.example/", ONION), ("https://www.gw.example/", None)]),
    "is_valid_address": (A.is_valid_address, [
        (ONION, True), ("sub." + ONION, True), ("x" + ONION, False), ("a" * 56 + ".onion", True),
        (ONION + "/", False), ("a" * 15 + ".onion", False), ("A" * 56 + ".onion", False)]),
    "url_authority": (A.url_authority, [
        ("http://user@host:80/p?q#f", "user@host:80"), ("https://h.org", "h.org"), ("plain", ""),
        ("http://h.org?q=/x", "h.org")]),
    "path_address": (A.path_address, [(f"2022/11/3/htmls/{ONION}.html", ONION), (f"/2022/1/3/htmls/{ONION}.html", ONION)]),
    "path_date": (lambda p: A.path_date(p).cast("string"), [("2022/11/3/htmls/x.html", "2022-11-03"), ("/2023/1/12/htmls/x", "2023-01-12")]),
    "source_from_topic": (A.source_from_topic, [
        ("crawlab_test.results_gateways", "gateways"), ("results_onions_farmer", "onions_farmer")]),
    "html_title": (H.html_title, [
        ("<title>A &amp; B</title><title>C</title>", "A & B"), ("<p>x</p>", ""), ("<TITLE lang=en>\n a </TITLE>", "\n a "),
        ("<title>x<b>y</b></title>", "")]),
    "html_description": (H.html_description, [
        ('<meta name="description" content="d &#39;1&#x27;">', "d '1'"), ("<meta content='q' name=description />", "q"),
        ('<meta name="descriptions" content="d">', ""), ('<meta name="description">', ""), ("", "")]),
    "main_content": (H.main_content, [
        ("<head><title>t</title></head><body><nav>n</nav><p>One&nbsp;two</p><p>a <b>b</b>\n c</p><script>s()</script>"
         "<table><tr><td>x</td></tr></table><!-- c --><footer>f</footer></body>", "One two\na b\nc"),
        ("", ""), ("<p>unclosed <script>x", "unclosed")]),
    "balanced_elements": (H.main_content, [
        ("<p>a</p><table><tr><td>x<table><tr><td>y</td></tr></table>tail</td></tr></table><p>b</p>", "a\nb"),
        ("<body><div><nav>menu<ul><li>one</div><p>text</p></body>", "text"),
        ("<div><nav><p>menu</p></div>a<aside>b<nav>c</nav>d</aside>e", "ae"),
        ("<header>h<header>i</header>j</header>k", "k"), ("</nav>a</table>b", "ab"), ("<nav/>a<NAV>b</nav >c", "ac"),
        ("<table><tr><td>x", ""), ("a < b <nav>c</nav> d", "a < b d"), ("it&apos;s &notit; &amp;lt; &hellip;&nosuch; &AMP", "it's ¬it; &lt; …&nosuch; &"),
        ("<p>x<br>y<table><img src=a><td>z<br></table>w", "x\ny w".replace(" ", "")), ("", ""), (None, ""),
    ]),
    "visible_text": (lambda h: A.extract_addresses(H.visible_text(h)), [
        (f"<head>{OTHER}</head><body><p>{ONION}</p><script>{OTHER}</script><!-- {OTHER} --></body>", [ONION]),
        ("<body>" + ONION[:30] + "<b>" + ONION[30:] + "</b></body>", [])]),
    "decode_entities": (H.decode_entities, [
        ("a &lt;b&gt; &unknown; &amp;lt; &#8364; &#xe9;&amp", "a <b> &unknown; &lt; € é&"), ("no refs", "no refs"),
        ("&#0;&#55296;", "��")]),
    "snippet_rows": (lambda s: F.transform(H.snippet_rows(s), lambda r: F.concat(r["line_no"], F.lit("|"), r["line"])), [
        ('<tr><td><div class="lineno"> 7 </div></td><td><pre>x</pre></td></tr><tr><td><div class="lineno">8</div></td>'
         '<td><pre>a <mark id="1">b</mark> &lt;<span>c</span></pre></td></tr>', ["8|a b <c"])]),
    "has_address": (N.has_address, [
        ("go abcdefghij234567.onion now", True), ("Xabcdefghij234567.onion", False), ("éabcdefghij234567.onion", False),
        ("abc.onion", False)]),
    "has_pgp_block": (N.has_pgp_block, [
        ("-----BEGIN PGP PUBLIC KEY BLOCK----- x -----END PGP PUBLIC KEY BLOCK-----", True),
        ("-----BEGIN PGP PUBLIC KEY BLOCK-----\nx -----END PGP PUBLIC KEY BLOCK-----", False)]),
    "has_email": (N.has_email, [("to a.b@c.org now", True), ("a.b@c.org now", False), ("to a@b.c now", False)]),
    "has_money": (N.has_money, [
        ("$ 25", True), ("25 BTC", True), ("100%", True), ("EUR1.000", True), ("BTC 5", False), ("5 dollars", False)]),
    "is_url": (N.is_url, [
        ("http://example.org/x", True), ("HTTPS://EXAMPLE.ORG", True), ("see http://example.org", False),
        ("http://10.0.0.1:80/a", True), ("http://localhost", True), ("ftp://a b.org", False)]),
    "has_bitcoin": (N.has_bitcoin, [("1AGNa15ZQXAZUgFiqJ2i7Z2DPU2J6hW62i", True), ("bc1" + "a" * 27, True), ("2" + "a" * 40, False)]),
    "is_web_tag": (N.is_web_tag, [("Login", True), ("login", False), ("Dark Web", True), ("Login.", False)]),
    "has_word": (N.has_word, [("1 a 2", True), ("é", False), ("1a", False), ("...", False)]),
    "noise_reasons": (N.noise_reasons, [("costs $ 5 at a@b.org now", ["Email", "Monetary"]), ("fine", [])]),
    "sentence_split": (K.sentence_split, [("A b. C!  D? e\n", ["A b.", "C!", "D?", "e"]), ("a.b", ["a.b"]), ("x. . y", ["x.", ".", "y"])]),
    "word_tokens": (K.word_tokens, [("Héllo, w_1!", ["Héllo", ",", "w_1", "!"])]),
    "breaks_to_periods": (K.breaks_to_periods, [("a\nb\tc", "a. b. c")]),
    "strip_special": (K.strip_special, [('a<#*_="+>b-c', "ab-c")]),
    "collapse_spaces": (K.collapse_spaces, [("a \t\n b  c d　e", "a b c d e")]),
    # Junk words are tested one in two: the odd ones stay.
    "strip_leading_junk": (K.strip_leading_junk, [
        ("!!! ??? -- 12 word end", "??? 12 word end"), ("  ..Hello  1 2", "Hello 1 2"), ("1 2 3 4", "2 4"),
        ("1 word", "word"), ("1 2word ..x", "2word x"), ("...", ""), ("", "")]),
    "collapse_punctuation": (K.collapse_punctuation, [("a!!! b..c -- __ ??!!", "a! b.c - __ ?!"), ("« «« x", "« « x")]),
    "space_before_punct": (K.space_before_punct, [("a , b !  ? c ; d : e .", "a, b! ? c; d: e .")]),
    "dedup_adjacent_words": (K.dedup_adjacent_words, [("a a b a  c c c", "a b a  c"), ("x", "x"), ("", "")]),
    "end_with_period": (K.end_with_period, [("a", "a."), ("a!", "a!"), ("a ", "a ."), ("", ""), ("é", "é.")]),
    "capitalize_sentences": (K.capitalize_sentences, [
        ("hello. world!  again?yes 3. Done", " Hello. World! Again? Yes 3. Done"), ("A.b", "A. B"), ("É. é", "É. é"), ("", "")]),
    "rewrite_separators": (K.rewrite_separators, [
        ("a#b", "a.b"), ("a - b", "a. b"), ("x :) y", "x y"), ("a | b", "a. b"), ("wow!", "wow."), ("why ?no", "why? no"),
        ("k : v", "k: v"), ("f( x )", "f (x)"), ("a; b ;", "a. b."), ("end .", "end.")]),
    "dedup_adjacent_sentences": (K.dedup_adjacent_sentences, [("a.a.b.a", "a.b.a"), ("a. a", "a. a"), ("", "")]),
    "remove_noise": (K.remove_noise, [
        ("Visit abcdefghij234567.onion now. hello hello world. Login", "Hello world."),
        ("Pay $ 5. 12 -- good !!", "- good."), ("... good  thing,thing !!", "Good thing,thing."), ("http://example.org/x", ""), ("", "")]),
}


@pytest.mark.parametrize("name", CASES)
def test_column_function(spark, name):
    fn, cases = CASES[name]
    assert apply(spark, fn, [(given,) for given, _ in cases]) == [wanted for _, wanted in cases]


def test_compose_text(spark):
    cases = [
        (("Ti", "De", "Co."), "Ti. De. Co. "), (("Ti", "Ti", "Co"), "Ti. Co. "), (("", "", ""), ""), (("", "D!", ""), "D! "),
        # A part that without its last character equals the text so far is left out; at the
        # start that is any part of one character.
        (("T", "D", "Co."), "Co. "), (("Ab", "Ab. !", "x"), "Ab. x. "),
    ]
    got = apply(spark, K.compose_text, [given for given, _ in cases])
    assert got == [wanted for _, wanted in cases]


def test_require_word(spark):
    assert apply(spark, lambda t: K.remove_noise(t, require_word=True), [("12 34. Words here.",)]) == ["Words here."]
    assert apply(spark, K.remove_noise, [("12 34. Words here.",)]) == ["34. Words here."]


def test_resolve_link(spark):
    base = "http://h.org/a/b?x=1#t"
    cases = {"/c": "http://h.org/c", "c": "http://h.org/a/c", "//k.org/z": "http://k.org/z", "?y": "http://h.org/a/b?y",
             "#f": "http://h.org/a/b?x=1", "https://q.org/": "https://q.org/", "mailto:a@b": "mailto:a@b"}
    assert apply(spark, H.resolve_link, [(base, href) for href in cases]) == list(cases.values())


def test_advertisers_are_flat(spark):
    from duskwatch.sources import search

    lines = spark.createDataFrame([(f"r{i % 3}", f"see {ONION} here") for i in range(9)], "repo string, line string")
    rows = search.advertisers(lines).collect()
    assert sorted(r["repo"] for r in rows) == ["r0", "r1", "r2"] and len({r["onion"] for r in rows}) == 1
    assert search.advertiser_concat(lines).first()["advertiser"] == "Grep.app (r0, r1, r2)"


def test_outside_equals_a_stack(spark):
    """Random markup against a plain stack of open elements."""
    import random
    import re

    rng = random.Random(12)
    pieces = ["<nav>", "</nav>", "<table class=x>", "</table>", "<div>", "</div>", "<p>", "</p>", "<br>", "<tr>", "<aside/>", "text", " < ", "</x>"]
    pages = ["".join(rng.choice(pieces) + str(i) for i in range(rng.randrange(30))) for _ in range(300)]

    def loop(page):
        out, opened, since = "", [], 0
        for piece in re.split(r"(?=</?[A-Za-z])", page):
            tag = re.match(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)[^>]*?(/?)>", piece)
            if tag and tag[1]:
                if tag[2] in opened:
                    while opened.pop() != tag[2]:
                        pass
                    since = 0 if len(opened) < since else since
            elif tag and not tag[3] and tag[2] != "br":
                opened.append(tag[2])
                if not since and tag[2] in ("nav", "table", "aside"):
                    since = len(opened)
            out += "" if since else piece
        return out

    assert apply(spark, lambda h: H.outside(h, ("nav", "table", "aside")), [(p,) for p in pages]) == [loop(p) for p in pages]


def test_plain_sentences_take_the_short_way_with_the_same_result(spark):
    import random

    rng = random.Random(5)
    parts = ["a", "Zb", "é", "É", " ", " a", " a", " Zb", "  ", ",", ", b", "!", "?", ".", "\t", "\xa0", "1", "-", "ǅ", "漢"]
    texts = ["".join([rng.choice(("A", "É", "a", "")), *rng.choices(parts, k=rng.randrange(7)), rng.choice((".", "!", "", "?"))])
             for _ in range(4000)] + ["", "A", "A.", "Ab ab ab.", "A A A!", "Word " * 9000 + "end."]
    s = F.col("s")
    whole = s
    for step in (
        K.breaks_to_periods, K.strip_special, K.collapse_blanks, K.strip_leading_junk, K.collapse_punctuation,
        K.space_before_punct, K.dedup_adjacent_words, K.end_with_period, K.capitalize_sentences,
    ):
        whole = step(whole)
    table = spark.createDataFrame([(t,) for t in [*texts, None]], "s string").select(
        "s", K.is_plain(s).alias("plain"), K.clean_sentence(s).alias("got"), whole.alias("wanted"))
    rows = table.collect()
    assert all(r["got"] == r["wanted"] for r in rows)
    assert 100 < sum(bool(r["plain"]) for r in rows) < 3500
