"""ANSI SQL with the same meaning as each query of the catalog, for an independent engine.

``VIEWS`` holds the derived tables as common table expressions; :func:`sql` puts those a
statement names (directly or through other views) in front of it.
"""

import re

from duskwatch import constants as C
from duskwatch.operators.language import LANGUAGE_NAMES
from duskwatch.operators.topics import STOPWORDS

P = (1 << 31) - 1
WS = r"\t-\r\x1c-\x20\x{85}\p{Z}"
WORD = r"\p{L}\p{N}_"
PUNCT = r"!-/:-@\[-`{-~"
JUNK = PUNCT + "0-9"
RUN_TS = "1700000000.0::double"


def lit(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def addr(key: str) -> str:
    return f"(translate(substr(md5({key}) || md5('x' || {key}), 1, 55), '0189', 'wxyz') || 'd.onion')"


def strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def entities(x: str) -> str:
    """The entities that occur in the pages, with and without semicolon; ampersands last."""
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        x = f"regexp_replace({x}, '&{name}(;|([^A-Za-z0-9;]|$))', {lit(char + chr(92) + '2')}, 'g')"
    return x


def title(x: str) -> str:
    return entities(rf"regexp_extract({x}, '(?is)<title\b[^>]*>(.*?)</title\s*>', 1)")


def description(x: str) -> str:
    tag = f"""regexp_extract({x}, '(?is)<meta\\b[^>]*name="description"[^>]*>', 0)"""
    return entities(f"""regexp_extract({tag}, '(?is)content="([^"]*)"', 1)""")


def content(x: str) -> str:
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', '', 'g')"
    for name in ("head", "script", "style", "noscript", "nav", "footer", "header", "aside", "table"):
        x = rf"regexp_replace({x}, '(?is)<{name}\b.*?(?:</{name}\s*>|\z)', '', 'g')"
    ends = r"(?i)<(?:br|hr)\b[^>]*>|</(?:p|div|li|ul|ol|h[1-6]|article|section|main|blockquote|pre|dd|dt)\s*>"
    x = f"regexp_replace({x}, '{ends}', chr(10), 'g')"
    x = entities(f"regexp_replace({x}, '(?s)</?[A-Za-z!?][^>]*>', '', 'g')")
    x = rf"regexp_replace({x}, '[\t\x0b\f\r\x{{a0}} ]+', ' ', 'g')"
    x = rf"regexp_replace({x}, ' ?\n[ \n]*', chr(10), 'g')"
    return rf"regexp_replace({x}, '^[ \n]+|[ \n]+$', '', 'g')"


def visible(x: str) -> str:
    x = rf"regexp_replace({x}, '(?is)^.*?<body\b[^>]*>', '')"
    x = f"regexp_replace({x}, '(?s)<!--.*?-->', ' ', 'g')"
    x = rf"regexp_replace({x}, '(?is)<script\b.*?(?:</script\s*>|\z)', ' ', 'g')"
    return entities(f"regexp_replace({x}, '(?s)</?[A-Za-z!?][^>]*>', ' ', 'g')")


def first_by(*columns: str) -> str:
    return ", ".join(columns)


FLAGS = list(C.SOURCES)
_PLACE = '(event_id % 10)::integer as "partition", event_id // 10 as "offset"'
NOISE = {
    "Onion": rf"regexp_matches(s, '(^|[^{WORD}])[a-z2-7]{{16,56}}\.onion([^{WORD}]|$)')",
    "PGP": f"regexp_matches(s, {lit(C.NOISE_PGP)})",
    "Email": f"regexp_matches(s, {lit(C.NOISE_EMAIL)})",
    "Monetary": f"regexp_matches(s, {lit(C.NOISE_MONEY)})",
    "URL": f"regexp_matches(s, {lit('(?i)' + C.NOISE_URL)})",
    "Bitcoin": f"regexp_matches(s, {lit(C.NOISE_BITCOIN)})",
    "Webtag": f"s in ({', '.join(lit(t) for t in C.WEB_TAGS)})",
}
HAS_WORD = rf"regexp_matches(s, '(^|[^{WORD}])[a-zA-Z]+([^{WORD}]|$)')"
KEEP = "not (" + " or ".join(NOISE.values()) + ")"

# Cleaner steps: (helper column or None, result); both read the text column ``s``.
LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _capitalize(x: str) -> str:
    for c in LETTERS:
        x = f"regexp_replace({x}, '(^|[.!?])[{WS}]*{c}', '\\1 {c.upper()}', 'g')"
    return x


def _separators(x: str) -> str:
    for old, new in C.SEPARATOR_REPLACEMENTS:
        x = f"replace({x}, {lit(old)}, {lit(new)})"
    return strip(f"regexp_replace({x}, '[{WS}]+', ' ', 'g')")


STEPS = {
    "breaks_to_periods": [(None, "replace(replace(s, chr(10), '. '), chr(9), '. ')")],
    "strip_special": [(None, "regexp_replace(s, '[<#*_=\"+>]', '', 'g')")],
    "collapse_blanks": [(None, "regexp_replace(s, ' +', ' ', 'g')")],
    "collapse_spaces": [(None, f"regexp_replace(s, '[{WS}]+', ' ', 'g')")],
    "strip_leading_junk": [
        (f"list_filter(regexp_split_to_array(s, '[{WS}]+'), lambda x: x <> '')", None),
        (f"coalesce(list_position(list_transform(h, lambda x, i: i % 2 = 1 and regexp_replace(x, '^[{JUNK}]+', '')"
         " <> ''), true), 0)", None),
        (None, "array_to_string(list_filter(list_transform(h, lambda x, i: case when i = h2 then"
               f" regexp_replace(x, '^[{JUNK}]+', '') else x end), lambda x, i: i % 2 = 0 or (h2 > 0 and i >= h2)), ' ')"),
    ],
    "collapse_punctuation": [
        ("regexp_extract_all(s, '(?s).')", None),
        (None, "array_to_string(list_filter(h, lambda x, i: i = 1 or x <> h[i - 1]"
               f" or regexp_matches(x, '[{WORD}{WS}]')), '')"),
    ],
    "space_before_punct": [(None, r"regexp_replace(s, ' ([!?,;:])', '\1', 'g')")],
    "dedup_adjacent_words": [
        ("string_split(s, ' ')", None),
        (None, "array_to_string(list_filter(h, lambda x, i: i = 1 or x <> h[i - 1]), ' ')")],
    "end_with_period": [
        (None, strip(f"case when s <> '' and not regexp_matches(right(s, 1), '[{PUNCT}]') then s || '.' else s end"))],
    "capitalize_sentences": [(None, _capitalize("s"))],
    "rewrite_separators": [(None, _separators("s"))],
    "dedup_adjacent_sentences": [
        ("string_split(s, '.')", None),
        (None, "array_to_string(list_filter(h, lambda x, i: i = 1 or x <> h[i - 1]), '.')")],
}
SENTENCE_CHAIN = [
    "breaks_to_periods", "strip_special", "collapse_blanks", "strip_leading_junk", "collapse_punctuation",
    "space_before_punct", "dedup_adjacent_words", "end_with_period", "capitalize_sentences",
]


def chain(source: str, keys: str, steps: list[str]) -> str:
    """Nested selects that apply cleaner steps to column ``s`` of ``source``."""
    query = f"select {keys}, s from {source}"
    for name in steps:
        carried = ""
        for helper, result in STEPS[name]:
            if result is not None:
                query = f"select {keys}, {result} as s from ({query})"
            elif not carried:
                query, carried = f"select {keys}, s, {helper} as h from ({query})", "h"
            else:
                query = f"select {keys}, s, h, {helper} as h2 from ({query})"
    return query


def sentences(source: str, keys: str) -> str:
    """``keys, pos, s``: sentences of column ``text``."""
    parts = (f"string_split(regexp_replace(regexp_replace(text, '[{WS}]+$', ''),"
             f" '([.!?])[{WS}]+', '\\1' || chr(1), 'g'), chr(1))")
    return f"select {keys}, unnest(range(len(p))) as pos, unnest(p) as s from (select {keys}, {parts} as p from {source})"


def denoise(source: str, keys: str) -> str:
    """``keys, text``: noise removed from column ``text``."""
    cleaned = chain(f"(select * from ({sentences(source, keys)}) where {KEEP})", f"{keys}, pos", SENTENCE_CHAIN)
    glued = (f"select k.{keys}, coalesce(c.s, '') as s from {source} k left join (select {keys},"
             f" string_agg(s || ' ', '' order by pos) as s from ({cleaned}) group by {keys}) c using ({keys})")
    done = chain(f"({glued})", keys, ["rewrite_separators", "collapse_punctuation", "dedup_adjacent_sentences"])
    return f"select {keys}, {strip('s')} as text from ({done})"


def registry_columns(prefix: str = "") -> str:
    return ", ".join(prefix + c for c in ("downloaded", "download_date", "ts", *FLAGS, "first_identification"))


def near_views(prefix: str, source: str, key: str, tie: str) -> dict[str, str]:
    """Signature, bucket, component and group views over distinct texts ``(key, text, n_copies)``."""
    n = prefix
    return {
        f"{n}_tokens": f"select distinct {key}, tok from (select {key}, unnest(regexp_split_to_array(text,"
                       f" '[{WS}]+')) as tok from {source}) where tok <> ''",
        f"{n}_sig": f"select {key}, i, min((a * (h % {P}) + b) % {P}) as v from (select {key},"
                    f" ('0x' || substr(md5(tok), 1, 8))::bigint as h from {n}_tokens), perm where i < 125"
                    f" group by {key}, i union all select {key}, i, {P} from {source}, perm where i < 125"
                    f" and {key} not in (select {key} from {n}_tokens)",
        f"{n}_bands": f"select {key}, i // 5 as band, string_agg(v::varchar, '-' order by i) as k from {n}_sig"
                      f" group by {key}, i // 5",
        f"{n}_buckets": f"select band, k, min({key}) as anchor, count(*) as n_members from {n}_bands"
                        " group by band, k having count(*) > 1",
        f"{n}_found": f"select {key}, band, anchor, n_members from {n}_bands join {n}_buckets using (band, k)",
        f"{n}_links": f"select distinct {key}, anchor from {n}_found where {key} <> anchor",
        f"{n}_sym": f"select {key} as u, anchor as v from {n}_links union select anchor, {key} from {n}_links",
        f"{n}_reach": f"select u as node, u as seen from {n}_sym union select r.node, e.v from {n}_reach r"
                      f" join {n}_sym e on r.seen = e.u",
        f"{n}_groups": f"select t.{key}, coalesce(g.group_id, t.{key}) as group_id from {source} t left join"
                       f" (select node, min(seen) as group_id from {n}_reach group by node) g on g.node = t.{key}",
        f"{n}_reps": f"select group_id, {key} as representative, n_members from (select group_id, {key},"
                     f" count(*) over (partition by group_id) as n_members, row_number() over (partition by group_id"
                     f" order by length(text) desc, {tie}) as rn from {n}_groups join {source} using ({key})) where rn = 1",
        f"{n}_near": f"select {key}, group_id, representative, n_members from {n}_groups join {n}_reps using (group_id)",
    }


def step(text: str, part: str) -> str:
    """One part appended to a composed text."""
    return (f"case when {part} <> '' and left({part}, length({part}) - 1) <> {text} then {text} || {part} ||"
            f" case when regexp_matches(right({part}, 1), '[{PUNCT}]') then ' ' else '. ' end else {text} end")


_LISTED = ", ".join(lit(C.COLLECTION_PREFIX + s) for s in FLAGS)
_DESCRIBED = (
    "replace(html, '</title>', '</title><meta name=\"description\" content=\"' || case when page_id % 6 = 0"
    " then 'About this page' else regexp_extract(html, '<title>(.*?)</title>', 1) end || '\">')")
_D = addr("'d' || doc_id::varchar")

VIEWS = {
    "perm": f"select i, ('0x' || substr(md5('a' || i::varchar), 1, 8))::bigint % {P - 1} + 1 as a,"
            f" ('0x' || substr(md5('b' || i::varchar), 1, 8))::bigint % {P} as b from range(128) t(i)",
    "sightings": "select event_id, case event_type when 'click' then 'results_onions_farmer' when 'view' then"
                 " 'results_gateways' when 'error' then 'results_ioc_repositories' when 'purchase' then"
                 " 'results_code_repositories' else 'results_other' end as coll, 'adv' || (event_id % 7)::varchar as"
                 f" advertiser, {addr(chr(39) + 'u' + chr(39) + ' || user_id::varchar')} as onion,"
                 " epoch_us(ts) / 1e6::double as ts from events",
    "listed": f"select {_PLACE}, substr(coll, 9) as source, onion, ts from sightings where coll in ({_LISTED})",
    "registry": f"select {addr(chr(39) + 'u' + chr(39) + ' || user_id::varchar')} as onion, user_id % 2 = 0 as downloaded,"
                " (1704067200 + 3600 * user_id)::double as download_date, (1704067200 + 3600 * user_id)::double as ts,"
                " user_id % 4 = 0 as onions_farmer, user_id % 5 = 0 as ioc_repositories, user_id % 7 = 0 as gateways,"
                " user_id % 11 = 0 as code_repositories, null::double as first_identification from (select user_id"
                " from events where event_type = 'signup' group by user_id having max(value) >= 130)",
    "stored": "select page_id, url, concat_ws('/', year(dt)::varchar, month(dt)::varchar, day(dt)::varchar, 'htmls',"
              " onion || '.html') as object_name, dt, onion, bad, html from (select page_id, url, date '2022-11-01' +"
              " (page_id % 60)::integer as dt, " + addr(
                  "'u' || (case when page_id % 5 = 4 then page_id - 1 else page_id end)::varchar") + " as onion,"
              " page_id % 19 <> 18 and page_id % 17 = 16 as bad, case when page_id % 19 = 18 then '' when"
              f" page_id % 3 = 0 then {_DESCRIBED} else html end as html from pages)",
    "first_objects": "select onion, dt, object_name from (select *, row_number() over (partition by onion order by dt,"
                     " object_name) as rn from stored) where rn = 1",
    "decoded": f"select page_id, object_name, dt, {title('html')} as title, {description('html')} as description,"
               f" {content('html')} as content from stored where not bad",
    "composed1": f"select *, {step(lit(''), 'title')} as t1 from decoded",
    "composed2": f"select *, case when title = description then t1 else {step('t1', 'description')} end as t2 from composed1",
    "composed": f"select *, {step('t2', 'content')} as text from composed2",
    "cleaned": "select object_name, dt, text, case when text = '' then 'empty' else 'ok' end as status from composed"
               " union all select object_name, dt, '', 'bad' from stored where bad",
    "clean_ok": "select object_name, text from cleaned where status = 'ok'",
    "preprocessed": denoise("clean_ok", "object_name"),
    "noisy": f"select doc_id, {_D} as onion, text || case doc_id % 11 when 0 then ' Visit ' || {_D} || ' today.'"
             " when 1 then ' -----BEGIN PGP PUBLIC KEY BLOCK----- abc -----END PGP PUBLIC KEY BLOCK-----.'"
             " when 2 then ' Write to a.b@c.org now.' when 3 then ' It costs $ 25 today.'"
             " when 4 then '. http://example.org/x' when 5 then ' Send to 1AGNa15ZQXAZUgFiqJ2i7Z2DPU2J6hW62i now.'"
             " when 6 then '. Login' when 7 then ' !!! ??? -- 12 word word , end' else '' end as text from documents",
    "noisy_sentences": sentences("noisy", "doc_id"),
    "hits": "select source as repo, lang || '/' || (doc_id % 40)::varchar as path, (doc_id % 5)::varchar as line_no, doc_id,"
            f" 1 + doc_id % 120 as page, 'see ' || {addr(chr(39) + 'd' + chr(39) + ' || (doc_id % 60)::varchar')} ||"
            " ' in <' || lang || '> & co' as line from documents",
    "merged_hits": "select repo, path, line_no, page, line from (select *, row_number() over (partition by repo, path,"
                   " line_no order by page desc, line desc) as rn from hits) where rn = 1",
    "indicators": "select distinct case when coll = 'results_other' then 'http://plain.example/' || advertiser else"
                  " 'http://' || onion || '/x?' || onion end as indicator from sightings",
    "gateway_rows": "select event_id as rank, 'gw' || substr(advertiser, 4) || '.example' as gateway, case when coll ="
                    " 'results_other' then 'http://www.gw' || substr(advertiser, 4) || '.example/' else 'https://' ||"
                    " substr(onion, 1, 57) || 'gw' || substr(advertiser, 4) || '.example/p' end as url from sightings",
    "gateway_found": f"select distinct gateway, regexp_extract(url, {lit(C.GATEWAY_ADDRESS)}) || 'onion' as onion"
                     f" from gateway_rows where regexp_matches(url, {lit(C.GATEWAY_ADDRESS)})",
    "edges": "select page_id as src, (page_id * 7 + 1) % n as dst from pages, (select count(*) as n from pages)"
             " union all select page_id, (page_id * 3 + 2) % n from pages, (select count(*) as n from pages)",
    "messages": f"select {_PLACE}, 'crawlab_test.' || coll as topic, substr(coll, 9) as source, case when"
                " event_id % 50 = 49 then 'undecodable' when event_id % 50 = 48 then 'no_address' else 'ok' end as status,"
                " onion, ts from sightings where coll <> 'results_other'",
    "good": 'select "partition", "offset", source, onion, ts from messages where status = \'ok\'',
    "versions": "select 'o' || doc_id::varchar as object_name, case when c = 1 then 'changed ' || text else text end as"
                " text, date '2022-11-15' + (doc_id % 30)::integer + c as version_date from documents,"
                " (values (0), (1)) v(c) where c = 0 or lang <> 'en'",
    "last_rows": "select object_name, version_date, text from (select *, row_number() over (partition by object_name"
                 " order by version_date desc) as rn from versions) where rn = 1",
    "old_rows": "select object_name, text from (select *, row_number() over (partition by object_name order by"
                " version_date desc) as rn from versions where version_date < date '2022-12-01') where rn = 1",
    "new_rows": "select object_name, text from (select *, row_number() over (partition by object_name order by"
                " version_date desc) as rn from versions where version_date >= date '2022-12-01') where rn = 1",
    "languages": "select doc_id, case lang " + " ".join(
        f"when {lit(k)} then {lit(v)}" for k, v in LANGUAGE_NAMES.items()) + " else lang end as first_language from documents",
    "language_shares": "select first_language as language, count(*) * 100.0::double / sum(count(*)) over () as percentage"
                       " from languages group by 1",
    "relabelled": "select doc_id, case when first_language = 'Spanish' then 'Portuguese' else first_language end as"
                  " first_language from languages",
    "relabelled_shares": "select first_language as language, count(*) * 100.0::double / sum(count(*)) over () as percentage"
                         " from relabelled group by 1",
    "lengths": f"select doc_id, len(string_split(regexp_replace(regexp_replace(text, '[{WS}]+$', ''), '([.!?])[{WS}]+',"
               f" '\\1' || chr(1), 'g'), chr(1))) as n_sentences, len(regexp_extract_all(text, '[{WORD}]+|[^{WORD}{WS}]'))"
               " as n_words from documents",
    "histogram": "select 'sentences' as kind, n_sentences as length, count(*) as n_texts from lengths group by 2 union all"
                 " select 'words', n_words, count(*) from lengths group by 2",
    "english_histogram": "select 'sentences' as kind, n_sentences as length, count(*) as n_texts from lengths join languages"
                         " using (doc_id) where first_language = 'English' group by 2 union all select 'words', n_words,"
                         " count(*) from lengths join languages using (doc_id) where first_language = 'English' group by 2",
    "copies": "select sha256(text) as text_key, min(doc_id) as first_id, count(*) as n_copies from documents"
              " where text <> '' group by text",
    "firsts": "select doc_id, sha256(text) as text_key, text, n_copies from documents join (select min(doc_id) as doc_id,"
              " count(*) as n_copies from documents where text <> '' group by text) using (doc_id)",
    **near_views("t", "firsts", "doc_id", "doc_id"),
    "labels_of": "select d.doc_id, case when d.doc_id <> f.doc_id then 'exact mirror' when f.doc_id = n.representative"
                 " then 'unique' else 'near mirror' end as label from documents d join firsts f on d.text = f.text"
                 " join t_near n on n.doc_id = f.doc_id where d.text <> ''",
    "instances": "select representative, n_members + n_copies - 1 as instances from t_reps join firsts on doc_id ="
                 " representative",
    "words_of": "select lang as topic, unnest(regexp_extract_all(lower(text), '\\p{L}+')) as word from documents",
    "word_tf": "select topic, word, count(*) as tf from words_of where word not in ("
               + ", ".join(lit(w) for w in sorted(STOPWORDS)) + ") group by 1, 2",
    "grams": "select doc_id, lang, unnest(w || list_transform(w, lambda x: '^' || substr(x, 1, 3)) || list_transform(w, lambda x:"
             " right(x, 3) || '$')) as gram from (select doc_id, lang, regexp_extract_all(lower(text), '\\p{L}+') as w from documents)",
    "lang_grams": "select lang, gram, count(*) as n from grams group by 1, 2",
    "frequent_grams": "select gram from lang_grams group by gram order by sum(n) desc, gram limit 65536",
    "kept_grams": "select lang, gram, n from lang_grams join frequent_grams using (gram)",
    "lang_facts": "select lang, round(ln(count(*) / (select count(*) from documents)) * 1000000)::bigint as prior, any_value(cost) as cost"
                  " from documents join (select lang, round(ln(sum(n) + (select count(*) from frequent_grams)) * 1000000)::bigint as cost"
                  " from kept_grams group by lang) using (lang) group by lang",
    "text_grams": "select doc_id, count(*) as n from grams join frequent_grams using (gram) group by doc_id",
    "lang_scores": "select d.doc_id, f.lang, f.prior + coalesce(w.s, 0) - coalesce(t.n, 0) * f.cost as score from documents d, lang_facts f"
                   " left join text_grams t on t.doc_id = d.doc_id left join (select g.doc_id, k.lang, sum(round(ln(k.n + 1) *"
                   " 1000000)::bigint) as s from grams g join kept_grams k using (gram) group by 1, 2) w on w.doc_id = d.doc_id and"
                   " w.lang = f.lang",
    "lang_probs": "select doc_id, case lang " + " ".join(f"when {lit(k)} then {lit(v)}" for k, v in LANGUAGE_NAMES.items())
                  + " else lang end as language, exp((score - max(score) over (partition by doc_id)) / 1000000.0::double) as share,"
                  " row_number() over (partition by doc_id order by score desc, lang) as rank from lang_scores",
    "lang_ranked": "select doc_id, language, rank, round(share / sum(share) over (partition by doc_id), 6) as confidence from lang_probs",
    "lang_top2": "select a.doc_id, a.language as first_language, a.confidence as first_confidence, b.language as second_language,"
                 " b.confidence as second_confidence from lang_ranked a join lang_ranked b on b.doc_id = a.doc_id and a.rank = 1 and b.rank = 2",
    "linked_pages": "select page_id, url, replace(html, '</article>', '<p>' || "
                    + addr("'v' || page_id::varchar") + " || '</p><script>' || " + addr("'s' || page_id::varchar")
                    + " || '</script></article>') as html from pages",
    "download_counts": "select 'Total onions' as metric, count(*)::double as value from cleaned union all select"
                       " 'Empty onions', count(*) filter (status = 'empty') from cleaned union all select"
                       " 'Bad-encoded onions', count(*) filter (status = 'bad') from cleaned union all select"
                       " 'Cleaned onions', count(*) filter (status = 'ok') from cleaned",
    "preprocess_metrics": "select 'Cleaned onions' as metric, count(*)::double as value from preprocessed union all select"
                          " 'Empty onions (after preprocessing)', count(*) filter (text = '') from preprocessed union all"
                          " select 'Preprocessed onions', count(*) filter (text <> '') from preprocessed",
    "new_label_counts": "select 'Total onions' as metric, count(*)::double as value from labels_of union all select"
                        " 'Exact mirrors', count(*) filter (label = 'exact mirror') from labels_of union all select"
                        " 'Near mirrors', count(*) filter (label = 'near mirror') from labels_of union all select"
                        " 'Unique onions', count(*) filter (label = 'unique') from labels_of",
    "totals_row": "select (select sum(n_copies - 1) from firsts) as e, sum(n_members) as m, count(*) as u from t_reps",
    "total_counts": "select 'Total onions' as metric, (e + m)::double as value from totals_row union all select"
                    " 'Total exact mirrors', e from totals_row union all select 'Total near mirrors', m - u from totals_row"
                    " union all select 'Total unique onions', u from totals_row",
}
RECURSIVE = {"t_reach"}
ORACLES: dict[str, str] = {}


def _needed(text: str, found: dict[str, None]) -> None:
    for name in VIEWS:
        if name not in found and re.search(rf"\b{name}\b", text):
            found[name] = None
            _needed(VIEWS[name], found)


def sql(text: str) -> str:
    """``text`` with the views it needs in front, in dependency order."""
    found: dict[str, None] = {}
    _needed(text, found)
    ordered: list[str] = []

    def place(name: str) -> None:
        if name in ordered:
            return
        for other in VIEWS:
            if other != name and other in found and re.search(rf"\b{other}\b", VIEWS[name]):
                place(other)
        ordered.append(name)

    for name in found:
        place(name)
    if not ordered:
        return text
    return "with recursive " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in ordered) + "\n" + text


def oracle(name: str, text: str) -> None:
    ORACLES[name] = sql(text)


def registry_oracle(name: str, select: str) -> None:
    oracle(name, select)


# --- scans, sources, sinks
oracle("scan_date_range", "select page_id, object_name, dt from stored where dt >= date '2022-11-15' and dt < date '2022-12-15'")
oracle("decode_utf8_status", "select page_id, case when bad then 'bad' else 'ok' end as status, case when bad then '' else html"
       " end as text from stored")
oracle("parse_object_path", "select page_id, onion as path_onion, onion as slice_onion, dt as path_date from stored")
oracle("write_html_partitioned", "select page_id, dt, object_name, strlen(html) + bad::bigint as n_bytes from stored")
oracle("write_scans", """select onion, '{"onion":"' || onion || '","page_id":' || page_id || '}' as report, dt from stored""")
oracle("registry_scan", "select onion from registry where downloaded")
oracle("union_sightings", "select source, onion, ts from listed")
oracle("union_sources", "select source, onion, ts from listed")
oracle("cdc_filter", f"select event_id, coll, advertiser, onion, ts from sightings where coll in ({_LISTED})")
oracle("decode_sighting_messages", 'select "partition", "offset", topic, case when status = \'ok\' then onion end as onion, status from messages')
oracle("decode_object_events", "select page_id, case when page_id % 41 <> 40 then 's3:ObjectCreated:Put' end as event_name,"
       " case when page_id % 41 <> 40 then object_name end as object_name, case when page_id % 41 <> 40 then"
       " dt::varchar || 'T00:00:00Z' end as event_time from stored")
oracle("object_key_join", "select e.page_id, o.object_name, e.dt::varchar || 'T00:00:00Z' as event_time, strlen(o.html) +"
       " o.bad::bigint as n_bytes from stored e join stored o on o.object_name = e.object_name where e.page_id % 41 <> 40")
oracle("load_line_list", "select url as line from pages")
oracle("explode_search_hits", "select page, repo, path, '<table><tr data-line=\"0\"><td><div class=\"lineno\">999</div></td><td>"
       "<pre>import re</pre></td></tr><tr><td><div class=\"lineno\"> ' || line_no || '</div></td><td><pre>' || replace(replace("
       "replace(replace(line, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), 'see', '<mark>see</mark>') ||"
       " '</pre></td></tr></table>' as snippet, page * 10 + doc_id % 3 > 10 * page as has_next from hits")
oracle("explode_indicators", "select indicator from indicators")
oracle("bulk_load", "select advertiser, onion, ts from sightings")
oracle("latest_version_before", "select version_date, object_name, text from versions where version_date = (select"
       " max(version_date) from versions where version_date >= date '2022-11-15' and version_date < date '2022-12-01')")
oracle("write_version", "select object_name, onion, date '2022-12-31' as version_date from stored")
oracle("write_stats", "select metric || ': ' || value::bigint::varchar as value from download_counts")
oracle("unique_sink", "select representative from t_reps")
oracle("emit_sighting", f"select 'doc ' || doc_id::varchar as advertiser, unnest(list_distinct(regexp_extract_all(text,"
       f" {lit(C.ADDRESS)}))) as onion, {RUN_TS} as ts from noisy")

# --- address and page extraction
oracle("extract_addresses", f"select doc_id, array_to_string(list_sort(list_distinct(regexp_extract_all(text, {lit(C.ADDRESS)}))),"
       " ',') as result from noisy")
oracle("first_address", f"select indicator, regexp_extract(indicator, {lit(C.ADDRESS)}) as onion from indicators where"
       f" regexp_matches(indicator, {lit(C.ADDRESS)})")
oracle("gateway_address", "select gateway, onion from gateway_found")
oracle("is_valid_address", "select event_id, value, length(value) >= 22 and value like '%.onion' and regexp_matches(value,"
       f" {lit(C.VALID_ADDRESS)}) as valid from (select event_id, case event_id % 5 when 0 then onion when 1 then 'sub.' || onion"
       " when 2 then onion || '/' when 3 then 'A' || substr(onion, 2) else substr(onion, 10) end as value from sightings)")
oracle("url_authority", "select page_id, split_part(url, '/', 3) as authority from pages")
oracle("address_url", "select onion, 'http://' || onion as url from registry")
oracle("visible_text", f"select page_id, array_to_string(list_sort(list_distinct(regexp_extract_all({visible('html')},"
       f" {lit(C.ADDRESS)}))), ',') as onions, regexp_replace({visible('html')}, '\\s+', ' ', 'g') as text from linked_pages")
oracle("extract_links", "select distinct url, regexp_extract(url, '^[^/]*//[^/]*') || href as link from (select url,"
       " unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\"', 1)) as href from pages) where split_part(url, '/', 3) in"
       " (select split_part(url, '/', 3) from pages where url like 'https://%')")
oracle("depth_limited_reach", "select page, min(depth) as depth from (select page_id as page, 0::bigint as depth from pages where"
       " url like 'https://www.%' union all select a.dst, 1 from edges a join pages p on p.page_id = a.src where p.url like"
       " 'https://www.%' union all select b.dst, 2 from edges a join pages p on p.page_id = a.src join edges b on b.src = a.dst"
       " where p.url like 'https://www.%' union all select c.dst, 3 from edges a join pages p on p.page_id = a.src join edges b on"
       " b.src = a.dst join edges c on c.src = b.dst where p.url like 'https://www.%') group by page")
oracle("marked_lines", "select page, repo, path, line_no, line from hits")
oracle("html_title", "select page_id, title from decoded")
oracle("html_description", "select page_id, description from decoded")
oracle("main_content", "select page_id, content from decoded")
oracle("compose_text", "select page_id, text from composed")
oracle("source_from_topic", 'select "partition", "offset", source from messages')
oracle("page_enrich", "select e.page_id, 's3:ObjectCreated:Put' as event_name, e.dt::varchar || 'T00:00:00Z' as event_time,"
       " d.object_name, d.title, d.description from stored e join decoded d on d.object_name = e.object_name"
       " where e.page_id % 41 <> 40")

# --- noise predicates and cleaners
for _name, _reason in {"has_address": "Onion", "has_pgp_block": "PGP", "has_email": "Email", "has_money": "Monetary",
                       "is_url": "URL", "has_bitcoin": "Bitcoin", "is_web_tag": "Webtag"}.items():
    oracle(_name, f"select doc_id, pos from noisy_sentences where {NOISE[_reason]}")
oracle("has_word", f"select doc_id, pos from noisy_sentences where {HAS_WORD}")
oracle("keep_sentence", f"select doc_id, pos from noisy_sentences where {KEEP}")
oracle("noise_reasons", " union all ".join(
    f"select {lit(r)} as reason, count(*) as n_sentences from noisy_sentences where {p} having count(*) > 0"
    for r, p in NOISE.items()))
oracle("sentence_split", "select doc_id, pos, s as sentence from noisy_sentences")
oracle("word_tokens", f"select doc_id, array_to_string(regexp_extract_all(text, '[{WORD}]+|[^{WORD}{WS}]'), chr(10)) as result from noisy")
for _name in STEPS:
    if _name != "collapse_blanks":
        oracle(_name, f"select doc_id, s as result from ({chain('(select doc_id, text as s from noisy)', 'doc_id', [_name])})")
oracle("remove_noise", f"select doc_id, text as result from ({denoise('noisy', 'doc_id')})")

# --- joins, lookups, upserts
oracle("lookup_registry", 'select "partition", "offset", l.onion, source, l.ts, downloaded, r.ts as registry_ts from listed l left join'
       " registry r on r.onion = l.onion")
oracle("anti_incoherent", "select onion, object_name from first_objects where onion not in (select onion from registry where downloaded)")
oracle("except_registry", "select distinct onion from stored where onion not in (select onion from registry where downloaded)")
oracle("refresh_downloaded", "select onion, onion in (select onion from stored) as downloaded, download_date, ts, "
       + ", ".join(FLAGS) + ", first_identification from registry")


def _batch(source: str) -> str:
    flags = ", ".join(f"bool_or(source = '{s}') as new_{s}" for s in FLAGS)
    return (f'select onion, arg_min(ts, (ts, source, "partition", "offset")) as first_ts, arg_max(ts, (ts, source, "partition", "offset")) as last_ts, max(ts) as max_ts, {flags},'
            f" onion in (select onion from stored) as fetched from {source} group by onion")


_MERGED = ", ".join(f"coalesce(r.{s}, false) or coalesce(b.new_{s}, false) as {s}" for s in FLAGS)


def _upsert(source: str) -> str:
    keep = "b.onion is null or coalesce(r.downloaded, false)"
    ts = f"case when {keep} then r.ts when fetched then first_ts else last_ts end"
    return (f"select onion, case when {keep} then r.downloaded else fetched end as downloaded, case when {keep} then"
            f" r.download_date else {ts} end as download_date, {ts} as ts, {_MERGED}, r.first_identification from registry r"
            f" full join ({_batch(source)}) b using (onion)")


oracle("upsert_sightings", _upsert("listed"))
_OLD_FLAG = "case source " + " ".join(f"when '{s}' then coalesce(r.{s}, false)" for s in FLAGS) + " end"
oracle("decision_log", f"""select source as listed_by, "partition", "offset", onion, seen_before, downloaded_before, not downloaded_before and fetched as downloaded_now,
 case when downloaded_before and flag_before then 'False' else source end as source from (
 select l."partition", l."offset", l.onion, source, r.onion is not null or rn > 1 as seen_before, l.onion in (select onion from stored) as fetched,
 coalesce(r.downloaded, false) or (l.onion in (select onion from stored) and rn > 1) as downloaded_before,
 {_OLD_FLAG} or rs > 1 as flag_before from (select *, row_number() over (partition by onion order by ts, source, "partition", "offset") as rn,
 row_number() over (partition by onion, source order by ts, source, "partition", "offset") as rs from listed) l left join registry r on r.onion = l.onion)""")
oracle("merge_single_source", "select onion, case when r.ts is null then false else r.downloaded end as downloaded, coalesce("
       "r.download_date, b.first_ts) as download_date, coalesce(r.ts, b.first_ts) as ts, coalesce(r.onions_farmer, false) or"
       " b.onion is not null as onions_farmer, coalesce(r.ioc_repositories, false) as ioc_repositories, coalesce(r.gateways, false)"
       " as gateways, coalesce(r.code_repositories, false) as code_repositories, r.first_identification from registry r full join"
       " (select onion, min(ts) as first_ts from listed where source = 'onions_farmer' group by onion) b using (onion)")
oracle("merge_all_sources", "select onion, case when b.onion is not null then false else r.downloaded end as downloaded, case when"
       " b.onion is not null then greatest(coalesce(r.ts, max_ts), max_ts) else r.download_date end as download_date, greatest("
       f"coalesce(r.ts, max_ts), coalesce(max_ts, r.ts)) as ts, {_MERGED}, r.first_identification from registry r full join"
       f" ({_batch('listed')}) b using (onion)")
oracle("set_first_seen", f"select onion, downloaded, download_date, r.ts, {', '.join(FLAGS)}, coalesce(seen,"
       " first_identification) as first_identification from registry r left join (select onion, min(ts) as seen from listed"
       " group by onion) using (onion)")
_OBJ_DATE = "epoch_us(o.dt::timestamp) / 1e6::double"
_FILL = "o.dt is not null and not coalesce(r.downloaded, false)"
oracle("backfill_from_objects", f"select onion, case when {_FILL} then true else r.downloaded end as downloaded, case when {_FILL}"
       f" then {_OBJ_DATE} else r.download_date end as download_date, r.ts, coalesce(r.onions_farmer, false) or o.dt is not null"
       " as onions_farmer, coalesce(r.ioc_repositories, false) as ioc_repositories, coalesce(r.gateways, false) as gateways,"
       " coalesce(r.code_repositories, false) as code_repositories, r.first_identification from registry r full join"
       " first_objects o using (onion)")
oracle("backfill_missing", f"select onion, {registry_columns()} from registry union all select onion, true, {_OBJ_DATE},"
       f" {_OBJ_DATE} - 3600, false, false, false, false, null from first_objects o where onion not in (select onion from registry)")
oracle("recompute_timestamp", "select onion, downloaded, download_date, download_date - 3600 as ts, " + ", ".join(FLAGS)
       + ", first_identification from registry")
oracle("merge_versions", "select object_name, text from new_rows union all select object_name, text from old_rows where"
       " object_name not in (select object_name from new_rows)")
oracle("merge_version_deltas", "select object_name, text from last_rows")
oracle("compact_versions", "select object_name, text from last_rows")
oracle("semi_english", "select doc_id, text from documents where lang = 'en'")

# --- aggregations
oracle("advertisers", f"select distinct unnest(regexp_extract_all(line, {lit(C.ADDRESS)})) as onion, repo from hits")
oracle("advertiser_concat", "select onion, 'Grep.app (' || string_agg(repo, ', ' order by repo) || ')' as advertiser from (select"
       f" distinct unnest(regexp_extract_all(line, {lit(C.ADDRESS)})) as onion, repo from hits) group by onion")
oracle("first_identification", "select onion, min(ts) as first_identification from listed group by onion")
_ORDER = "case source " + " ".join(f"when '{s}' then {i}" for i, s in enumerate(FLAGS)) + " end"
oracle("merge_counts", f"""select source, total, coalesce(n, 0) as missing, total - coalesce(n, 0) as present from (select source,
 count(*) as total, {_ORDER} as o from listed group by source) left join (select o, count(*) as n from (select onion,
 min({_ORDER}) as o from listed where onion not in (select onion from registry) group by onion) group by o) using (o)""")
oracle("union_distinct_addresses", f"select unnest(regexp_extract_all(indicator, {lit(C.ADDRESS)})) as onion from indicators union"
       f" select unnest(regexp_extract_all(text, {lit(C.ADDRESS)})) from noisy")
oracle("hit_merge", "select repo, path, line_no, page, line from merged_hits")
oracle("exact_duplicates", "select text_key, first_id, n_copies from copies")
oracle("status_counts", "select metric, value from download_counts")
oracle("preprocess_counts", "select metric, value from preprocess_metrics")
oracle("dedup_counts_new", "select metric, value from new_label_counts")
oracle("dedup_counts_total", "select metric, value from total_counts")
oracle("instances_per_unique", "select representative, instances from instances")
BOX = {"minimum": 0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75, "maximum": 1}


def box(column: str) -> str:
    return ", ".join(f"quantile_cont({column}, {q})::double as {n}" for n, q in BOX.items())


oracle("instance_boxplot", f"select {box('instances')} from instances")
oracle("language_share", "select language, round(percentage, 6) as percentage from language_shares")
oracle("length_histograms", "select kind, length, n_texts from histogram")
oracle("length_boxes", f"select kind, {box('length')} from histogram group by kind")
oracle("length_boxes_weighted", f"select 'sentences' as kind, {box('n_sentences')} from lengths union all select 'words',"
       f" {box('n_words')} from lengths")
oracle("daily_object_count", "select dt, count(*) as n_objects from stored group by dt")
oracle("duplicate_addresses", "select s.onion, f.object_name as first_object, s.object_name as later_object from stored s join"
       " first_objects f on f.onion = s.onion where s.object_name <> f.object_name")
oracle("metrics_table", "select step, date '2022-12-31' as version_date, metric, round(value, 6) as value from (select 'download'"
       " as step, metric, value from download_counts union all select 'preprocess', metric, value from preprocess_metrics union all"
       " select 'identify_languages', 'Total onions', count(*) from languages union all select * from (select"
       " 'identify_languages', language, percentage from language_shares order by percentage desc, language limit 10))")

# --- similarity and deduplication
oracle("token_sets", f"select doc_id, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(text, '[{WS}]+'),"
       " lambda x: x <> ''))), chr(10)) as result from noisy")
oracle("minhash_signature", f"select doc_id, string_agg(v::varchar, '-' order by i) as signature from (select doc_id, i, min((a *"
       f" (h % {P}) + b) % {P}) as v from (select doc_id, ('0x' || substr(md5(tok), 1, 8))::bigint as h from (select distinct"
       f" doc_id, unnest(regexp_split_to_array(text, '[{WS}]+')) as tok from documents) where tok <> ''), perm group by doc_id, i)"
       " group by doc_id")
oracle("lsh_candidates", "select doc_id, anchor from t_links")
oracle("lsh_query", "select doc_id, band, anchor, n_members from t_found")
oracle("jaccard_pairs", "select doc_id, representative, round(shared::double / (n1 + n2 - shared), 6) as jaccard from (select"
       " n.doc_id, representative, (select count(*) from t_tokens a where a.doc_id = n.doc_id) as n1, (select count(*) from"
       " t_tokens a where a.doc_id = n.representative) as n2, (select count(*) from t_tokens a join t_tokens b on a.tok = b.tok"
       " where a.doc_id = n.doc_id and b.doc_id = n.representative) as shared from t_near n where n.doc_id <> representative)")
oracle("near_groups", "select doc_id, group_id from t_groups")
oracle("first_claim", "select doc_id as member, min(anchor) as group_id from t_found group by doc_id")
oracle("representative", "select group_id, representative, n_members from t_reps")
oracle("incremental_exact", "select sha256(text) as text_key, object_name from old_rows union all select sha256(text), object_name from new_rows")
oracle("incremental_exact_distinct", "select sha256(text) as text_key, doc_id from documents where text <> ''")
oracle("mirror_label", "select doc_id, label from labels_of")
_A = f"list_filter(regexp_split_to_array(title, '[{WS}]+'), lambda x: x <> '')"
_B = f"list_filter(regexp_split_to_array(content, '[{WS}]+'), lambda x: x <> '')"
oracle("intersect_groups", f"select page_id, case when list_has_any(a, b) then array_to_string(list_sort(list_distinct(a || b)), ',')"
       f" else '' end as members from (select page_id, {_A} as a, {_B} as b from decoded)")

# --- language and topics
_ROUNDS, _TOPICS = 8, 10


def _topics() -> str:
    """The rounds of the clusters, written one after another: centres ``c<i>`` and assignments ``a<i>``."""
    distance = "list_sum(list_transform(list_zip(v, c), lambda x: (x[1] - x[2]) * (x[1] - x[2])))"
    parts = ["e as (select vec_id, embedding::double[] as v from embeddings)",
             f"c0 as (select row_number() over (order by vec_id) - 1 as topic, v as c from (select * from e order by vec_id limit {_TOPICS}))"]
    for i in range(_ROUNDS + 1):
        parts.append(f"a{i} as (select vec_id, v, topic from (select vec_id, v, topic, row_number() over (partition by vec_id order by"
                     f" {distance}, topic) as rn from e, c{i}) where rn = 1)")
        parts.append(f"c{i + 1} as (select topic, coalesce(m, c) as c from c{i} left join (select topic, list(x order by p) as m from"
                     f" (select topic, p, round(avg(x), 6) as x from (select topic, unnest(v) as x, unnest(range(len(v))) as p from a{i})"
                     " group by topic, p) group by topic) using (topic))")
    return f"with {', '.join(parts[:-1])} select vec_id, topic::integer as topic from a{_ROUNDS}"


ORACLES["topic_model"] = _topics()
oracle("language_counts", "select lang, gram, n from lang_grams union all select lang, '', count(*) from documents group by lang")
oracle("language_top2", "select * from lang_top2")
oracle("topk_predictions", "select doc_id, rank::integer as rank, language, confidence from lang_ranked where rank <= 2")
oracle("language_names", "select doc_id, case when length(text) > 5000 then lang || '-x' else lang end as code, case when"
       " length(text) > 5000 then lang || '-x' else first_language end as language from documents join languages using (doc_id)")
oracle("language_versioned", "select language, round(percentage, 6) as percentage from relabelled_shares order by 2 desc, 1 limit 10")
oracle("english_length_profile", "select kind, length, n_texts from english_histogram")
oracle("class_tfidf", """select topic, rank, word, tf, score from (select topic, word, tf, round(raw, 6) as score, row_number() over (
 partition by topic order by round(raw, 6) desc, word) as rank from (select topic, word, tf, tf * ln(1 + a / f) as raw from word_tf join
 (select word, sum(tf) as f from word_tf group by word) using (word), (select sum(tf)::double / count(distinct topic) as a from word_tf)))
 where rank <= 10""")
oracle("stopwords", "select word, count(*) as n from words_of where word not in (" + ", ".join(lit(w) for w in sorted(STOPWORDS))
       + ") group by word")

# --- windows, sorts, limits
oracle("first_path_per_address", "select onion, dt, object_name from first_objects")
oracle("latest_row_per_key", "select object_name, version_date, text from last_rows")
oracle("share_of_total", "select coll, count(*) as n, round(count(*) * 100.0::double / sum(count(*)) over (), 6) as percentage"
       " from sightings group by coll")
oracle("previous_element", "select doc_id, len(w) as n_words, len(list_filter(w, lambda x, i: i = 1 or x <> w[i - 1])) as n_kept from"
       " (select doc_id, string_split(text, ' ') as w from noisy)")
oracle("top10_languages", "select language, round(percentage, 6) as percentage from language_shares order by 2 desc, 1 limit 10")
oracle("both_sort_orders", "select event_id, onion from (select event_id, onion from sightings order by event_id desc limit 1000) union"
       " select event_id, onion from (select event_id, onion from sightings order by event_id limit 1000)")
oracle("page_cap", "select page, repo, path, line_no, doc_id from hits where page <= 100")
oracle("gateway_cap", "select rank, gateway, url from (select *, row_number() over (partition by gateway order by rank) as rn from"
       " gateway_rows) where rn <= 200")

# --- streaming, after everything has been read
oracle("stream_sightings", 'select "partition", "offset", onion, source, ts from good')
oracle("stream_upsert", _upsert("good"))
oracle("stream_upsert_batches", _upsert("good"))
oracle("stream_quarantine", 'select "partition", "offset", source, status from messages')
oracle("stream_page_enrich", "select e.page_id, d.object_name, e.dt::varchar || 'T00:00:00Z' as event_time, d.title, d.description"
       " from stored e join decoded d on d.object_name = e.object_name where e.page_id % 41 <> 40")
oracle("stream_dedupe_source", "select distinct onion, source from good")
oracle("stream_seen_state", "select onion, min(ts) as first_ts, max(ts) as last_ts, "
       + ", ".join(f"bool_or(source = '{s}') as {s}" for s in FLAGS) + " from good group by onion")
oracle("stream_daily_counts", "select make_timestamp((ts * 1000000)::bigint)::date as day, count(*) as n_sightings from good group by 1")
oracle("stream_cdc", f"select event_id, coll, advertiser, onion, ts from sightings where coll in ({_LISTED})")

# --- jobs
oracle("download_step", "select object_name, text, status from cleaned")
oracle("version_cleaned_step", "select case metric when 'Total onions' then 'Total collected onions' when 'Empty onions' then"
       " 'Total empty onions' when 'Bad-encoded onions' then 'Total bad encoded' else 'Total cleaned onions' end as metric, value"
       " from download_counts")
oracle("preprocess_step", "select object_name, text from preprocessed")
oracle("version_preprocessed_step", "select case metric when 'Cleaned onions' then 'Total cleaned onions' when 'Preprocessed onions'"
       " then 'Total preprocessed onions' else 'Total empty onions (after preprocessing)' end as metric, value from"
       " preprocess_metrics")
oracle("dedup_step", "select metric, value from new_label_counts")
oracle("incremental_dedup", "select representative, n_members from t_reps")
oracle("version_dedup_step", "select metric, value from total_counts")
oracle("language_step", "select sha256(text) as text_key, first_language, first_confidence, second_language, second_confidence from"
       " lang_top2 join t_reps on representative = doc_id join documents using (doc_id)")
oracle("version_language_step", "select 'Total onions' as metric, count(*)::double as value from relabelled union all select * from"
       " (select language, round(percentage, 6) from relabelled_shares order by 2 desc, 1 limit 10)")
oracle("classify_step", f"select kind, {box('length')} from english_histogram group by kind")
oracle("coherence_job", "select 'duplicate' as finding, s.onion, s.object_name from stored s join first_objects f on f.onion = s.onion"
       " where s.object_name <> f.object_name union all select 'not registered', onion, object_name from first_objects where onion not"
       " in (select onion from registry where downloaded)")
oracle("downloaded_job", "select onion, onion in (select onion from stored where dt <= date '2022-12-15') as downloaded,"
       " download_date, ts, " + ", ".join(FLAGS) + ", first_identification from registry")
oracle("discover_code", f"select 'Grep.app (' || string_agg(repo, ', ' order by repo) || ')' as advertiser, onion, {RUN_TS} as ts from"
       f" (select distinct unnest(regexp_extract_all(line, {lit(C.ADDRESS)})) as onion, repo from merged_hits) group by onion")
oracle("discover_code_text", f"select distinct 'Sourcegraph' as advertiser, unnest(regexp_extract_all(text, {lit(C.ADDRESS)})) as onion,"
       f" {RUN_TS} as ts from noisy")
oracle("discover_gateways", f"select 'DuckDuckGo (' || gateway || ')' as advertiser, onion, {RUN_TS} as ts from gateway_found")
oracle("discover_ioc", f"select distinct 'Suspicious/Scam/Malware repositories' as advertiser, unnest(regexp_extract_all(text,"
       f" {lit(C.ADDRESS)})) as onion, {RUN_TS} as ts from noisy union all select distinct 'AlienVault', regexp_extract(indicator,"
       f" {lit(C.ADDRESS)}), {RUN_TS} from indicators where regexp_matches(indicator, {lit(C.ADDRESS)})")
oracle("discover_pages", f"select split_part(url, '/', 3) as advertiser, unnest(list_distinct(regexp_extract_all({visible('html')},"
       f" {lit(C.ADDRESS)}))) as onion, {RUN_TS} as ts from linked_pages")
