"""The operators over the test tables with production parameters, and their SQL counterparts."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm import collocations, decontamination, embedding_dedup, filter_audit, fingerprints, language_id, line_dedup, packing, pseudonyms, sharding, shingle_join, token_counts, token_files
from duskwatch.session import prepare, scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op1_token_files(spark, sf_dir):
    path = scratch_path(spark, "token_files")
    token_files.write_token_files(documents(spark, sf_dir), path, public_tokenizers.path("byte_bpe_50k.json"), byte_level=True)
    return token_files.read_token_files(spark, path, token_files.checksums, "ids_crc32 long")


@query
def op2_parity_sketch_join(spark, sf_dir):
    return shingle_join.near_duplicates(documents(spark, sf_dir))


@query
def op3_token_counts(spark, sf_dir):
    return token_counts.count_tokens(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


@query
def op4_nn_descent(spark, sf_dir):
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


@query
def op5_language_id(spark, sf_dir):
    docs, vocabulary = documents(spark, sf_dir), public_tokenizers.path("piece_bpe_32k.model")
    model = language_id.train(docs, vocabulary)
    return language_id.predict(docs.select("doc_id", "text"), model, vocabulary).select(
        "doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


#: Stands for the secret of a deployment.
PSEUDONYM_KEY = b"duskwatch test tables"


@query
def op6_pii_pseudonyms(spark, sf_dir):
    return pseudonyms.pseudonymise_documents(documents(spark, sf_dir), PSEUDONYM_KEY)


@query
def op7_benchmark_decontamination(spark, sf_dir):
    found = decontamination.find_passages(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"), "spans")


@query
def op8_line_dedup(spark, sf_dir):
    return line_dedup.dedup_lines(documents(spark, sf_dir))


ORACLES["op8_line_dedup"] = r"""
with l as (
  select doc_id, unnest(generate_series(1, len(string_split(text, chr(10))))) - 1 as line_no,
         unnest(string_split(text, chr(10))) as line
  from documents where text is not null),
w as (
  select doc_id, line_no, list_sort(list_distinct(list_filter(string_split(translate(line,
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ' || chr(9) || chr(11) || chr(12) || chr(13), 'abcdefghijklmnopqrstuvwxyz    '), ' '), lambda x: x <> ''))) as ws
  from l),
s as (
  select ws, len(ws) as n, min((doc_id, line_no)) as place from w where len(ws) > 0 group by ws),
t as (select place, n, unnest(ws) as word from s where n > 3),
f as (select word, count(*) as c from t group by word),
o as (
  select place, n, word, row_number() over (partition by place order by c, word) as pos from t join f using (word)),
p as (select * from o where pos <= n - ceil(4 * n / 5.0) + 1),
pairs as (
  select distinct a.place, b.place as place2 from p a join p b on a.word = b.word
  where b.place < a.place and 5 * b.n >= 4 * a.n and 5 * a.n >= 4 * b.n),
near as (
  select distinct p.place from pairs p join s a on a.place = p.place join s b on b.place = p.place2
  where 100 * len(list_intersect(a.ws, b.ws)) >= 80 * (a.n + b.n - len(list_intersect(a.ws, b.ws)))),
gone as (
  select w.doc_id, w.line_no from w join s using (ws)
  where (w.doc_id, w.line_no) <> s.place or s.place in (select place from near)),
kept as (
  select l.doc_id, string_agg(l.line, chr(10) order by l.line_no) as text
  from l anti join gone g on g.doc_id = l.doc_id and g.line_no = l.line_no group by l.doc_id),
counts as (select doc_id, count(*) as n from gone group by doc_id)
select d.doc_id, case when d.text is null then null else coalesce(k.text, '') end as text,
       cast(coalesce(len(string_split(d.text, chr(10))), 0) as integer) as n_lines,
       cast(coalesce(c.n, 0) as integer) as n_removed
from documents d left join kept k using (doc_id) left join counts c using (doc_id)
"""


@query
def op9_sharding(spark, sf_dir):
    return sharding.shard_documents(documents(spark, sf_dir))


@query
def op10_packing(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"), checksums=True)


@query
def op11_fingerprints(spark, sf_dir):
    return fingerprints.fingerprint_documents(documents(spark, sf_dir))


@query
def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


ORACLES["op12_filter_audit"] = r"""
with d as (select doc_id, coalesce(text, '') as t, coalesce(source, '') as part from documents),
w as (
  select *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws, min(doc_id) over (partition by t) as least from d),
m as (
  select doc_id, part,
    case when len(ws) < 200 then 'A' else '' end
    || case when 100 * len(list_distinct(ws)) < 50 * len(ws) then 'B' else '' end
    || case when 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) then 'C' else '' end
    || case when regexp_matches(t, '[#$%&*|]') then 'D' else '' end
    || case when doc_id > least then 'E' else '' end as fails
  from w),
j as (select doc_id, bool_or(coalesce(quality = 1, false)) as good, bool_or(coalesce(toxic = 1, false)) as bad from labels group by doc_id),
c as (
  select part, fails, coalesce(good, false) as good, coalesce(bad, false) as bad, count(*) as n
  from m left join j using (doc_id) group by all),
l as (select unnest(string_split('ABCDE', '')) as x),
o as (
  select a.x || b.x || c.x || d.x || e.x as filter_order from l a, l b, l c, l d, l e
  where len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s as (select filter_order, unnest([1, 2, 3, 4, 5]) as step from o),
r as (
  select part, filter_order, step, substr(filter_order, step, 1) as f, n, good, bad, fails,
         contains(fails, substr(filter_order, step, 1)) as failed,
         length(translate(substr(filter_order, 1, step - 1), fails, '')) < step - 1 as gone
  from c, s),
g as (
  select part, filter_order, step, any_value(f) as f,
    coalesce(sum(n) filter (not failed and not gone), 0) as kept, coalesce(sum(n) filter (failed and not gone), 0) as removed,
    coalesce(sum(n) filter (failed and gone), 0) as redundant, coalesce(sum(n) filter (fails = f), 0) as unique_fails,
    coalesce(sum(n) filter (failed and not gone and good), 0) as good_lost,
    coalesce(sum(n) filter (failed and not gone and bad), 0) as toxic_lost
  from r group by part, filter_order, step)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed,
       cast(redundant as bigint) as redundant, cast(unique_fails as bigint) as unique_fails,
       cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
       cast(sum(removed) over (partition by part, f) as bigint) as shapley
from g
"""


@query
def op13_collocations(spark, sf_dir):
    return collocations.mine_collocations(documents(spark, sf_dir))


ORACLES["op13_collocations"] = r"""
with d as (
  select row_number() over () as doc, coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t
  from documents),
p as (select lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) as piece from d),
w as (select lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') as ws from p),
g as (
  select lang, m, ws[s:s + m - 1] as ws
  from (select lang, ws, m, unnest(generate_series(1, len(ws) - m + 1)) as s
        from w, (select unnest([1, 2, 3, 4, 5]) as m) where len(ws) >= m)),
f as (select lang, m, ws, count(*) as n from g group by all),
t as (select lang, sum(n) as n from f where m = 1 group by lang),
c as (select lang, m, ws, n as a from f where m > 1 and n >= 100),
k as (select *, unnest(generate_series(1, m - 1)) as k from c),
s as (
  select k.lang, k.m, k.ws, k.a, k.k, l.n as l, r.n as r, t.n as n,
         (1000::hugeint * k.a::hugeint * t.n::hugeint) // (l.n::hugeint * r.n::hugeint) as score
  from k join f l on l.lang = k.lang and l.ws = k.ws[1:k.k] join f r on r.lang = k.lang and r.ws = k.ws[k.k + 1:k.m]
  join t on t.lang = k.lang),
b as (select * from s qualify row_number() over (partition by lang, ws order by score, k) = 1),
i as (
  select lang, a, ws[s:s + m - 1] as ws
  from (select c.lang, c.a, c.ws, x.m, unnest(generate_series(1, c.m - x.m + 1)) as s
        from c, (select unnest([2, 3, 4]) as m) x where x.m < c.m)),
j as (select lang, ws, max(a) as longer from i group by all),
o as (
  select b.*, array_to_string(b.ws, ' ') as phrase from b left join j on j.lang = b.lang and j.ws = b.ws
  where j.longer is null or j.longer < b.a),
q as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from o)
select lang, rank, phrase, a, l, r, cast(n as bigint) as n, cast(score as bigint) as score from q where rank <= 2000
"""
