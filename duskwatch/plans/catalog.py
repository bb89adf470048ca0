"""Every operator as a named query over the test tables: ``name -> f(spark, sf_dir)``.

Array results are sorted and joined to text, because set order is undefined.
"""

from collections.abc import Callable
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch import bridge as B
from duskwatch import constants as C
from duskwatch import schemas
from duskwatch.functions import addresses as A
from duskwatch.functions import cleaners as K
from duskwatch.functions import html as H
from duskwatch.functions import noise as N
from duskwatch.operators import counts as G
from duskwatch.operators import crawl, pages
from duskwatch.operators import dedup as D
from duskwatch.operators import language as L
from duskwatch.operators import registry as R
from duskwatch.operators import topics as T
from duskwatch.plans import daily, discovery, jobs
from duskwatch.session import materialize, prepare, scratch_path
from duskwatch.sources import lists, messages, objects, search
from duskwatch.sources import versions as V
from duskwatch.streaming import streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_TS = 1_700_000_000.0
FROM_DATE = date(2022, 12, 1)
TODAY = date(2023, 1, 1)
VERSION = date(2022, 12, 31)


def query(fn: Query) -> Query:
    """Register a query under its function name."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(prepare(spark), sf_dir)

    QUERIES[fn.__name__] = run
    return fn


def joined(values: Column, sort: bool = True) -> Column:
    return F.array_join(F.sort_array(values) if sort else values, ",")


def per_text(name: str, fn: Callable[[Column], Column], column: str = "result") -> None:
    """Register a column function applied to every whole text."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return B.noisy_texts(prepare(spark), sf_dir).select("doc_id", fn(F.col("text")).alias(column))

    QUERIES[name] = run


def per_sentence(name: str, predicate: Callable[[Column], Column]) -> None:
    """Register a predicate counted over all sentences: texts and sentences it fires on."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        rows = pages.sentences(B.noisy_texts(prepare(spark), sf_dir), "doc_id")
        return rows.where(predicate(F.col("sentence"))).select("doc_id", F.col("pos").cast("bigint").alias("pos"))

    QUERIES[name] = run


def registry_out(df: DataFrame) -> DataFrame:
    """Registry rows with the date as epoch seconds, independent of time zones."""
    return df.withColumn("download_date", F.unix_micros("download_date") / F.lit(1e6))


def stored_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.source_sightings(spark, sf_dir).select(*B.message_place(), "advertiser", "onion", "ts", "source")


def feed(df: DataFrame, key: str, name: str) -> str:
    """Write a table as the input files of a stream, in ranges of ``key``."""
    spark = df.sparkSession
    chunks = max(4, -(-df.count() // 1_000_000))
    path = scratch_path(spark, name)
    df.repartitionByRange(chunks, key).write.json(path)
    return path


# --- scans, sources, sinks -------------------------------------------------------------

@query
def scan_date_range(spark, sf_dir):
    return objects.scan_date_range(B.html_objects(spark, sf_dir), date(2022, 11, 15), date(2022, 12, 15)).select(
        "page_id", "object_name", "dt")


@query
def decode_utf8_status(spark, sf_dir):
    return objects.decode_utf8(B.html_objects(spark, sf_dir)).select(
        "page_id", F.when(F.col("bad"), "bad").otherwise("ok").alias("status"),
        F.coalesce("html", F.lit("")).alias("text"))


@query
def parse_object_path(spark, sf_dir):
    return objects.parse_object_path(B.html_objects(spark, sf_dir)).select(
        "page_id", "path_onion", "slice_onion", "path_date")


@query
def write_html_partitioned(spark, sf_dir):
    path = scratch_path(spark, "html")
    objects.write_html_partitioned(B.html_objects(spark, sf_dir), path)
    return spark.read.parquet(path).select(
        "page_id", "dt", A.object_path(F.col("dt"), F.col("onion")).alias("object_name"),
        F.octet_length("body").cast("bigint").alias("n_bytes"))


@query
def write_scans(spark, sf_dir):
    path, scans = scratch_path(spark, "scans"), B.html_objects(spark, sf_dir).select(
        "dt", "onion", F.to_json(F.struct("onion", "page_id")).alias("report"))
    objects.write_scans(scans, path)
    return spark.read.json(path, schema="onion string, report string, dt date")


@query
def registry_scan(spark, sf_dir):
    return R.registry_scan(materialize(B.registry(spark, sf_dir), "registry"))


@query
def union_sightings(spark, sf_dir):
    return lists.union_sightings(lists.by_source(B.sightings(spark, sf_dir)))


QUERIES["union_sources"] = QUERIES["union_sightings"]


@query
def cdc_filter(spark, sf_dir):
    return messages.cdc_filter(B.change_events(spark, sf_dir))


@query
def decode_sighting_messages(spark, sf_dir):
    return messages.decode_messages(B.messages(spark, sf_dir)).select("partition", "offset", "topic", "onion", "status")


@query
def decode_object_events(spark, sf_dir):
    return messages.decode_object_events(B.object_events(spark, sf_dir))


@query
def object_key_join(spark, sf_dir):
    return messages.object_key_join(B.object_events(spark, sf_dir), B.html_objects(spark, sf_dir)).select(
        "page_id", "object_name", "event_time", F.octet_length("body").cast("bigint").alias("n_bytes"))


@query
def load_line_list(spark, sf_dir):
    path = scratch_path(spark, "lines")
    B.table(spark, sf_dir, "pages", "url").select(F.concat(F.lit("  "), "url", F.lit("\t")).alias("value")).write.text(path)
    return lists.load_line_list(spark, path)


@query
def explode_search_hits(spark, sf_dir):
    return search.explode_search_hits(B.search_pages(spark, sf_dir))


@query
def explode_indicators(spark, sf_dir):
    return search.explode_indicators(B.indicator_pages(spark, sf_dir))


@query
def bulk_load(spark, sf_dir):
    saved, target = scratch_path(spark, "saved"), scratch_path(spark, "sightings")
    records = B.sightings(spark, sf_dir).select("advertiser", "onion", "ts")
    records.write.json(saved)
    lists.bulk_load(spark, saved, target)
    return spark.read.parquet(target)


@query
def latest_version_before(spark, sf_dir):
    return V.latest_version_before(B.versions(spark, sf_dir), FROM_DATE)


@query
def write_version(spark, sf_dir):
    store = V.VersionStore(spark, scratch_path(spark, "versions"))
    rows = B.html_objects(spark, sf_dir).select("object_name", "onion")
    store.write(rows, "names", VERSION)
    store.write(rows, "names", VERSION)  # a second run of the day replaces the first
    return store.read_all("names").select("object_name", "onion", "version_date")


@query
def write_stats(spark, sf_dir):
    store = V.VersionStore(spark, scratch_path(spark, "versions"))
    store.write_stats(_status_counts(spark, sf_dir), "cleaned_onions", VERSION)
    return spark.read.text(f"{store.root}/stats/cleaned_onions/{VERSION.isoformat()}")


@query
def unique_sink(spark, sf_dir):
    path = scratch_path(spark, "unique")
    D.unique_texts(_near(spark, sf_dir), "doc_id").select("representative").write.parquet(path)
    return spark.read.parquet(path)


@query
def emit_sighting(spark, sf_dir):
    found = B.noisy_texts(spark, sf_dir).select(
        "doc_id", F.explode(A.extract_addresses(F.col("text"))).alias("onion"))
    return lists.emit_sightings(found, F.concat(F.lit("doc "), F.col("doc_id").cast("string")), F.lit(RUN_TS))


# --- address and page extraction -------------------------------------------------------

per_text("extract_addresses", lambda t: joined(A.extract_addresses(t)))


@query
def first_address(spark, sf_dir):
    return search.explode_indicators(B.indicator_pages(spark, sf_dir)).select(
        "indicator", A.first_address(F.col("indicator")).alias("onion")).where("onion is not null")


@query
def gateway_address(spark, sf_dir):
    return search.gateway_addresses(B.gateway_results(spark, sf_dir))


@query
def is_valid_address(spark, sf_dir):
    values = B.sightings(spark, sf_dir).select("event_id", F.expr(
        "case event_id % 5 when 0 then onion when 1 then concat('sub.', onion) when 2 then concat(onion, '/')"
        " when 3 then concat('A', substr(onion, 2)) else substr(onion, 10) end").alias("value"))
    return values.withColumn("valid", A.is_valid_address(F.col("value")))


@query
def url_authority(spark, sf_dir):
    return B.table(spark, sf_dir, "pages", "page_id", "url").select("page_id", A.url_authority(F.col("url")).alias("authority"))


@query
def address_url(spark, sf_dir):
    return B.registry(spark, sf_dir).select("onion", A.address_url(F.col("onion")).alias("url"))


def _pages_with_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with one address in the visible text and one in a script."""
    shown = B.address("concat('v', cast(page_id as string))")
    hidden = B.address("concat('s', cast(page_id as string))")
    return B.table(spark, sf_dir, "pages").selectExpr(
        "page_id", "url",
        f"replace(html, '</article>', concat('<p>', {shown}, '</p><script>', {hidden}, '</script></article>')) as html")


@query
def visible_text(spark, sf_dir):
    return _pages_with_addresses(spark, sf_dir).select(
        "page_id", joined(A.extract_addresses(H.visible_text(F.col("html")))).alias("onions"),
        F.regexp_replace(H.visible_text(F.col("html")), r"\s+", " ").alias("text"))


def _start_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.table(spark, sf_dir, "pages", "url").where("url like 'https://%'")


@query
def extract_links(spark, sf_dir):
    return crawl.extract_links(B.table(spark, sf_dir, "pages", "url", "html"), _start_urls(spark, sf_dir))


@query
def depth_limited_reach(spark, sf_dir):
    starts = B.table(spark, sf_dir, "pages", "page_id", "url").where("url like 'https://www.%'").select(F.col("page_id").alias("page"))
    return crawl.depth_limited_reach(B.links(spark, sf_dir), starts)


@query
def marked_lines(spark, sf_dir):
    return search.marked_lines(search.explode_search_hits(B.search_pages(spark, sf_dir)))


def _decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_parts(B.html_objects(spark, sf_dir)).where("not bad")


@query
def html_title(spark, sf_dir):
    return _decoded(spark, sf_dir).select("page_id", "title")


@query
def html_description(spark, sf_dir):
    return _decoded(spark, sf_dir).select("page_id", "description")


@query
def main_content(spark, sf_dir):
    return _decoded(spark, sf_dir).select("page_id", "content")


@query
def compose_text(spark, sf_dir):
    return _decoded(spark, sf_dir).select(
        "page_id", K.compose_text(F.col("title"), F.col("description"), F.col("content")).alias("text"))


@query
def source_from_topic(spark, sf_dir):
    return B.messages(spark, sf_dir).select("partition", "offset", A.source_from_topic(F.col("topic")).alias("source"))


@query
def page_enrich(spark, sf_dir):
    return pages.page_enrich(B.object_events(spark, sf_dir), B.html_objects(spark, sf_dir)).select(
        "page_id", "event_name", "event_time", "object_name", "title", "description")


# --- noise predicates and cleaners -----------------------------------------------------

for _name, _predicate in {
    "has_address": N.has_address, "has_pgp_block": N.has_pgp_block, "has_email": N.has_email,
    "has_money": N.has_money, "is_url": N.is_url, "has_bitcoin": N.has_bitcoin, "is_web_tag": N.is_web_tag,
    "has_word": N.has_word, "keep_sentence": N.keep_sentence,
}.items():
    per_sentence(_name, _predicate)


@query
def noise_reasons(spark, sf_dir):
    rows = pages.sentences(B.noisy_texts(spark, sf_dir), "doc_id")
    return rows.select("doc_id", F.explode(N.noise_reasons(F.col("sentence"))).alias("reason")).groupBy("reason").agg(
        F.count("*").alias("n_sentences"))


@query
def sentence_split(spark, sf_dir):
    return pages.sentences(B.noisy_texts(spark, sf_dir), "doc_id").select(
        "doc_id", F.col("pos").cast("bigint").alias("pos"), "sentence")


per_text("word_tokens", lambda t: F.array_join(K.word_tokens(t), "\n"))
for _name in (
    "breaks_to_periods", "strip_special", "collapse_spaces", "strip_leading_junk", "collapse_punctuation",
    "space_before_punct", "dedup_adjacent_words", "end_with_period", "capitalize_sentences", "rewrite_separators",
    "dedup_adjacent_sentences", "remove_noise",
):
    per_text(_name, getattr(K, _name))


# --- joins, lookups, upserts -----------------------------------------------------------

@query
def lookup_registry(spark, sf_dir):
    return R.lookup_registry(stored_sightings(spark, sf_dir), B.registry(spark, sf_dir)).select(
        "partition", "offset", "onion", "source", "ts", "downloaded", "registry_ts")


def _objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.html_objects(spark, sf_dir).select("onion", "dt", "object_name")


@query
def anti_incoherent(spark, sf_dir):
    return R.anti_incoherent(_objects(spark, sf_dir), B.registry(spark, sf_dir)).select("onion", "object_name")


@query
def except_registry(spark, sf_dir):
    listed = B.registry(spark, sf_dir).where("downloaded").select("onion")
    return _objects(spark, sf_dir).select("onion").subtract(listed)


@query
def refresh_downloaded(spark, sf_dir):
    return registry_out(R.refresh_downloaded(B.registry(spark, sf_dir), _objects(spark, sf_dir)))


@query
def upsert_sightings(spark, sf_dir):
    return registry_out(R.upsert_sightings(
        B.registry(spark, sf_dir), stored_sightings(spark, sf_dir), _objects(spark, sf_dir)))


@query
def decision_log(spark, sf_dir):
    return R.decision_log(B.registry(spark, sf_dir), stored_sightings(spark, sf_dir), _objects(spark, sf_dir))


@query
def merge_single_source(spark, sf_dir):
    return registry_out(R.merge_single_source(
        B.registry(spark, sf_dir), stored_sightings(spark, sf_dir), "onions_farmer"))


@query
def merge_all_sources(spark, sf_dir):
    return registry_out(R.merge_all_sources(B.registry(spark, sf_dir), stored_sightings(spark, sf_dir)))


@query
def set_first_seen(spark, sf_dir):
    return registry_out(R.set_first_seen(B.registry(spark, sf_dir), stored_sightings(spark, sf_dir)))


@query
def backfill_from_objects(spark, sf_dir):
    return registry_out(R.backfill_from_objects(B.registry(spark, sf_dir), _objects(spark, sf_dir), "onions_farmer"))


@query
def backfill_missing(spark, sf_dir):
    return registry_out(R.backfill_missing(B.registry(spark, sf_dir), _objects(spark, sf_dir)))


@query
def recompute_timestamp(spark, sf_dir):
    return registry_out(R.recompute_timestamp(B.registry(spark, sf_dir)))


def _two_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Rows before and from the first of December as an old and a new dataset."""
    rows = B.versions(spark, sf_dir)
    old = V.latest_row_per_key(rows.where(F.col("version_date") < F.lit(FROM_DATE)), "object_name", "version_date")
    new = V.latest_row_per_key(rows.where(F.col("version_date") >= F.lit(FROM_DATE)), "object_name", "version_date")
    return old.select("object_name", "text"), new.select("object_name", "text")


@query
def merge_versions(spark, sf_dir):
    old, new = _two_versions(spark, sf_dir)
    return V.merge_versions(old, new, "object_name")


def _three_versions(spark: SparkSession, sf_dir: str) -> V.VersionStore:
    """A store of three runs of ten days each: a full version and two deltas on top of it."""
    store, rows = V.VersionStore(spark, scratch_path(spark, "store")), B.versions(spark, sf_dir)
    for start, version in ((date(2022, 11, 15), date(2022, 11, 24)), (date(2022, 11, 25), date(2022, 12, 4)), (date(2022, 12, 5), VERSION)):
        days = rows.where(F.col("version_date").between(F.lit(start), F.lit(version)))
        new = V.latest_row_per_key(days, "object_name", "version_date").drop("version_date")
        store.append(new, "texts", version, "object_name", store.newest_before("texts", start))
    return store


@query
def merge_version_deltas(spark, sf_dir):
    return _three_versions(spark, sf_dir).read("texts", VERSION)


@query
def compact_versions(spark, sf_dir):
    return _three_versions(spark, sf_dir).compact("texts", VERSION)


def _languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.labelled_texts(spark, sf_dir).select("doc_id", L.language_name(F.col("lang")).alias("first_language"))


@query
def semi_english(spark, sf_dir):
    return B.texts(spark, sf_dir).join(L.semi_english(_languages(spark, sf_dir)).select("doc_id"), "doc_id", "left_semi")


# --- aggregations ----------------------------------------------------------------------

@query
def advertisers(spark, sf_dir):
    return search.advertisers(B.search_hits(spark, sf_dir))


@query
def advertiser_concat(spark, sf_dir):
    return search.advertiser_concat(B.search_hits(spark, sf_dir))


@query
def first_identification(spark, sf_dir):
    return R.first_identification(stored_sightings(spark, sf_dir))


@query
def merge_counts(spark, sf_dir):
    return R.merge_counts(B.registry(spark, sf_dir), stored_sightings(spark, sf_dir))


@query
def union_distinct_addresses(spark, sf_dir):
    indicators = search.explode_indicators(B.indicator_pages(spark, sf_dir)).select(
        F.explode(A.extract_addresses(F.col("indicator"))).alias("onion"))
    documents = B.noisy_texts(spark, sf_dir).select(F.explode(A.extract_addresses(F.col("text"))).alias("onion"))
    return indicators.union(documents).distinct()


@query
def hit_merge(spark, sf_dir):
    return search.hit_merge(B.search_hits(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.exact_index(B.texts(spark, sf_dir), "doc_id")


@query
def exact_duplicates(spark, sf_dir):
    return D.exact_duplicates(_index(spark, sf_dir), "doc_id")


def _cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written once, as in the daily run: a filter on the status would repeat the extraction."""
    return materialize(pages.clean_pages(B.html_objects(spark, sf_dir)), "cleaned")


def _status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return G.status_counts(_cleaned(spark, sf_dir))


@query
def status_counts(spark, sf_dir):
    return _status_counts(spark, sf_dir)


@query
def preprocess_counts(spark, sf_dir):
    return G.preprocess_counts(pages.preprocess(_cleaned(spark, sf_dir)))


def _distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.distinct_texts(B.texts(spark, sf_dir), "doc_id")


def _near(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = materialize(_distinct(spark, sf_dir), "texts")
    return D.near_table(D.near_groups(distinct, "doc_id"), distinct, "doc_id")


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.mirror_labels(_index(spark, sf_dir), _near(spark, sf_dir), "doc_id")


@query
def dedup_counts_new(spark, sf_dir):
    return D.dedup_counts_new(_labels(spark, sf_dir))


@query
def dedup_counts_total(spark, sf_dir):
    return D.dedup_counts_total(
        D.exact_duplicates(_index(spark, sf_dir), "doc_id"), D.unique_texts(_near(spark, sf_dir), "doc_id"))


def _instances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return D.instances_per_unique(
        D.unique_texts(_near(spark, sf_dir), "doc_id"), D.exact_duplicates(_index(spark, sf_dir), "doc_id"))


@query
def instances_per_unique(spark, sf_dir):
    return _instances(spark, sf_dir)


@query
def instance_boxplot(spark, sf_dir):
    return D.instance_boxplot(_instances(spark, sf_dir))


def _rounded(df: DataFrame, column: str = "percentage") -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


@query
def language_share(spark, sf_dir):
    return _rounded(G.language_share(_languages(spark, sf_dir)))


@query
def length_histograms(spark, sf_dir):
    return G.length_histograms(B.texts(spark, sf_dir))


@query
def length_boxes(spark, sf_dir):
    return G.length_boxes(G.length_histograms(B.texts(spark, sf_dir)))


@query
def length_boxes_weighted(spark, sf_dir):
    return G.length_boxes(G.length_histograms(B.texts(spark, sf_dir)), weighted=True)


@query
def daily_object_count(spark, sf_dir):
    return G.daily_object_count(_objects(spark, sf_dir))


@query
def duplicate_addresses(spark, sf_dir):
    return R.duplicate_objects(_objects(spark, sf_dir))


@query
def metrics_table(spark, sf_dir):
    cleaned = _cleaned(spark, sf_dir)
    steps = {
        "download": G.status_counts(cleaned),
        "preprocess": G.preprocess_counts(pages.preprocess(cleaned)),
        "identify_languages": G.language_metrics(_languages(spark, sf_dir)),
    }
    parts = [G.as_metrics(counts, step, VERSION) for step, counts in steps.items()]
    return _rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), "value")


# --- similarity and deduplication ------------------------------------------------------

per_text("token_sets", lambda t: F.array_join(F.sort_array(D.token_set(t)), "\n"))


@query
def minhash_signature(spark, sf_dir):
    return D.signatures(B.texts(spark, sf_dir), "doc_id", C.MINHASH_PERMUTATIONS).select(
        "doc_id", F.array_join(F.transform("signature", lambda v: v.cast("string")), "-").alias("signature"))


def _members(spark: SparkSession, sf_dir: str) -> DataFrame:
    return materialize(D.bucket_members(_distinct(spark, sf_dir), "doc_id"), "buckets")


@query
def lsh_candidates(spark, sf_dir):
    return D.lsh_candidates(_members(spark, sf_dir), "doc_id")


@query
def lsh_query(spark, sf_dir):
    return D.lsh_query(_members(spark, sf_dir), "doc_id").select(
        "doc_id", F.col("band").cast("bigint").alias("band"), "anchor", "n_members")


@query
def jaccard_pairs(spark, sf_dir):
    distinct = materialize(_distinct(spark, sf_dir), "texts")
    near = D.near_table(D.near_groups(distinct, "doc_id"), distinct, "doc_id")
    return _rounded(D.jaccard_to_representative(near, distinct, "doc_id"), "jaccard")


@query
def near_groups(spark, sf_dir):
    return D.near_groups(materialize(_distinct(spark, sf_dir), "texts"), "doc_id")


@query
def first_claim(spark, sf_dir):
    claims = D.lsh_query(_members(spark, sf_dir), "doc_id").select(F.col("doc_id").alias("member"), F.col("anchor").alias("group_id"))
    return D.first_claim(claims)


@query
def representative(spark, sf_dir):
    distinct = materialize(_distinct(spark, sf_dir), "texts")
    return D.representatives(D.near_groups(distinct, "doc_id"), distinct, "doc_id")


@query
def incremental_exact(spark, sf_dir):
    old, new = _two_versions(spark, sf_dir)
    return D.incremental_exact(D.exact_index(old), D.exact_index(new))


@query
def incremental_exact_distinct(spark, sf_dir):
    index = _index(spark, sf_dir)
    return D.incremental_exact(index, index, distinct=True)


@query
def mirror_label(spark, sf_dir):
    return _labels(spark, sf_dir)


@query
def intersect_groups(spark, sf_dir):
    parts = _decoded(spark, sf_dir).select(
        "page_id", D.token_set(F.col("title")).alias("a"), D.token_set(F.col("content")).alias("b"))
    return parts.select("page_id", joined(D.union_if_intersecting(F.col("a"), F.col("b"))).alias("members"))


# --- language and topics ---------------------------------------------------------------

def _top2(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = B.labelled_texts(spark, sf_dir)
    return _confidences(L.language_top2(L.train(labelled.select("text", "lang")), labelled, "doc_id"))


def _confidences(rows: DataFrame) -> DataFrame:
    return _rounded(_rounded(rows, "first_confidence"), "second_confidence")


@query
def language_top2(spark, sf_dir):
    return _top2(spark, sf_dir)


@query
def topk_predictions(spark, sf_dir):
    rows = _top2(spark, sf_dir)
    return rows.select("doc_id", F.inline(F.array(
        F.struct(F.lit(1).alias("rank"), F.col("first_language").alias("language"),
                 F.col("first_confidence").alias("confidence")),
        F.struct(F.lit(2).alias("rank"), F.col("second_language").alias("language"),
                 F.col("second_confidence").alias("confidence")))))


@query
def language_counts(spark, sf_dir):
    """Counts of two halves of the texts, added up."""
    labelled = B.labelled_texts(spark, sf_dir)
    halves = [L.language_counts(labelled.where(F.col("doc_id") % 2 == half)) for half in (0, 1)]
    return L.added_counts(*halves)


@query
def language_names(spark, sf_dir):
    codes = B.labelled_texts(spark, sf_dir).withColumn(
        "code", F.when(F.length("text") > 5000, F.concat("lang", F.lit("-x"))).otherwise(F.col("lang")))
    return codes.select("doc_id", "code", L.language_name(F.col("code")).alias("language"))


def _language_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged language table of two runs: the later run relabels texts that also occur in it."""
    rows = _languages(spark, sf_dir)
    long = F.col("first_language") == "Spanish"
    new = rows.where(long).withColumn("first_language", F.lit("Portuguese"))
    return V.merge_versions(rows, new, "doc_id")


@query
def language_versioned(spark, sf_dir):
    return _rounded(G.top_languages(_language_versions(spark, sf_dir)))


@query
def english_length_profile(spark, sf_dir):
    return daily.classify_step(_languages(spark, sf_dir), B.texts(spark, sf_dir), "doc_id")


@query
def topic_model(spark, sf_dir):
    return T.topic_model(B.table(spark, sf_dir, "embeddings"), k=10)


@query
def class_tfidf(spark, sf_dir):
    return T.class_tfidf(T.word_counts(B.labelled_texts(spark, sf_dir), "lang"))


@query
def stopwords(spark, sf_dir):
    counts = T.word_counts(B.labelled_texts(spark, sf_dir), "lang", stopwords=None)
    return T.drop_stopwords(counts.groupBy("word").agg(F.sum("tf").alias("n")))


# --- windows, sorts, limits ------------------------------------------------------------

@query
def first_path_per_address(spark, sf_dir):
    return R.first_object(_objects(spark, sf_dir))


@query
def latest_row_per_key(spark, sf_dir):
    return V.latest_row_per_key(B.versions(spark, sf_dir), "object_name", "version_date")


@query
def share_of_total(spark, sf_dir):
    counts = B.sightings(spark, sf_dir).groupBy("coll").agg(F.count("*").alias("n"))
    return _rounded(G.share_of_total(counts))


@query
def previous_element(spark, sf_dir):
    texts = B.noisy_texts(spark, sf_dir)
    return texts.select(
        "doc_id", F.size(F.split("text", " ")).cast("bigint").alias("n_words"),
        F.size(F.split(K.dedup_adjacent_words(F.col("text")), " ")).cast("bigint").alias("n_kept"))


@query
def top10_languages(spark, sf_dir):
    return _rounded(G.top_languages(_languages(spark, sf_dir)))


@query
def both_sort_orders(spark, sf_dir):
    return search.both_sort_orders(B.sightings(spark, sf_dir).select("event_id", "onion"), "event_id", 1000)


@query
def page_cap(spark, sf_dir):
    return search.page_cap(B.search_hits(spark, sf_dir)).select("page", "repo", "path", "line_no", "doc_id")


@query
def gateway_cap(spark, sf_dir):
    return search.gateway_cap(B.gateway_results(spark, sf_dir))


# --- streaming -------------------------------------------------------------------------

def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streams.file_stream(spark, feed(B.messages(spark, sf_dir), "offset", "messages"))


@query
def stream_sightings(spark, sf_dir):
    out = scratch_path(spark, "sightings")
    streams.stream_sightings(_message_stream(spark, sf_dir), out, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("partition", "offset", "onion", "source", "ts")


@query
def stream_upsert(spark, sf_dir):
    out, start = scratch_path(spark, "registry"), materialize(B.registry(spark, sf_dir), "registry")
    fetched = materialize(_objects(spark, sf_dir).select("onion").distinct(), "fetched")
    # One batch holds every file, so the outcome does not depend on the order of the files.
    stream = streams.file_stream(spark, feed(B.messages(spark, sf_dir), "offset", "messages"), files=1_000_000)
    streams.stream_upsert(stream, start, fetched, out, scratch_path(spark, "checkpoint"))
    return registry_out(streams.latest_registry(spark, out, start))


@query
def stream_upsert_batches(spark, sf_dir):
    """The messages in four micro-batches in the order of time: a registry in buckets with deltas."""
    out, start = scratch_path(spark, "registry"), materialize(B.registry(spark, sf_dir), "registry")
    fetched = materialize(_objects(spark, sf_dir).select("onion").distinct(), "fetched")
    path, rows = scratch_path(spark, "messages"), materialize(B.messages(spark, sf_dir), "messages")
    edges = [None, *rows.approxQuantile("ts", [0.25, 0.5, 0.75], 0.01), None]
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        part = rows if low is None else rows.where(F.col("ts") >= low)
        (part if high is None else part.where(F.col("ts") < high)).coalesce(1).write.mode("append").json(path)
    streams.stream_upsert(
        streams.file_stream(spark, path), start, fetched, out, scratch_path(spark, "checkpoint"), buckets=8, compact_after=2)
    return registry_out(streams.latest_registry(spark, out, start))


@query
def stream_quarantine(spark, sf_dir):
    good, bad = scratch_path(spark, "good"), scratch_path(spark, "bad")
    streams.stream_quarantine(_message_stream(spark, sf_dir), good, bad, scratch_path(spark, "checkpoint"))
    kept = spark.read.parquet(good).select("partition", "offset", "source", F.lit("ok").alias("status"))
    return kept.unionByName(spark.read.parquet(bad).select(
        "partition", "offset", A.source_from_topic(F.col("topic")).alias("source"), "status"))


@query
def stream_page_enrich(spark, sf_dir):
    out = scratch_path(spark, "enriched")
    path = feed(B.object_events(spark, sf_dir), "page_id", "object-events")
    events = streams.file_stream(spark, path, B.object_events(spark, sf_dir).schema)
    streams.stream_page_enrich(
        events, materialize(B.html_objects(spark, sf_dir), "objects"), out, scratch_path(spark, "checkpoint"))
    return spark.read.parquet(out).select("page_id", "object_name", "event_time", "title", "description")


@query
def stream_dedupe_source(spark, sf_dir):
    out = scratch_path(spark, "pairs")
    streams.stream_dedupe_source(_message_stream(spark, sf_dir), out, scratch_path(spark, "checkpoint"))
    return streams.seen_pairs(spark, out)


@query
def stream_seen_state(spark, sf_dir):
    out = scratch_path(spark, "state")
    streams.stream_seen_state(_message_stream(spark, sf_dir), out, scratch_path(spark, "checkpoint"))
    return streams.latest_updates(spark, out, ["onion"]).drop("expired")


@query
def stream_daily_counts(spark, sf_dir):
    out = scratch_path(spark, "daily")
    streams.stream_daily_counts(_message_stream(spark, sf_dir), out, scratch_path(spark, "checkpoint"))
    return streams.latest_updates(spark, out, ["day"])


@query
def stream_cdc(spark, sf_dir):
    out = scratch_path(spark, "cdc")
    changes = B.change_events(spark, sf_dir)
    streams.stream_cdc(
        streams.file_stream(spark, feed(changes, "event_id", "changes"), changes.schema), out,
        scratch_path(spark, "checkpoint"))
    return spark.read.schema("event_id bigint, coll string, advertiser string, onion string, ts double").parquet(out)


# --- jobs ------------------------------------------------------------------------------

def _store(spark: SparkSession) -> V.VersionStore:
    return V.VersionStore(spark, scratch_path(spark, "store"))


@query
def download_step(spark, sf_dir):
    return daily.download_step(B.html_objects(spark, sf_dir), C.FIRST_DAY, TODAY).rows


def _two_downloads(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    stored = B.html_objects(spark, sf_dir)
    return tuple(
        materialize(daily.download_step(stored, start, end).rows, "cleaned")
        for start, end in ((C.FIRST_DAY, FROM_DATE), (FROM_DATE, TODAY)))


FIRST_RUN = date(2022, 11, 30)


@query
def version_cleaned_step(spark, sf_dir):
    store, (old, new) = _store(spark), _two_downloads(spark, sf_dir)
    daily.version_cleaned_step(store, old, C.FIRST_DAY, FIRST_RUN)
    return daily.version_cleaned_step(store, new, FROM_DATE, VERSION).counts


@query
def preprocess_step(spark, sf_dir):
    return daily.preprocess_step(_cleaned(spark, sf_dir)).rows


@query
def version_preprocessed_step(spark, sf_dir):
    store, (old, new) = _store(spark), _two_downloads(spark, sf_dir)
    daily.version_preprocessed_step(store, pages.preprocess(old), C.FIRST_DAY, FIRST_RUN)
    return daily.version_preprocessed_step(store, pages.preprocess(new), FROM_DATE, VERSION).counts


def _document_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as preprocessed objects; the object name sorts like the number."""
    return B.texts(spark, sf_dir).select(F.format_string("o%012d", "doc_id").alias("object_name"), "text")


@query
def dedup_step(spark, sf_dir):
    return daily.dedup_step(_document_texts(spark, sf_dir)).counts


@query
def incremental_dedup(spark, sf_dir):
    """The near-duplicate index after two runs; the second signs only texts that the first has not seen."""
    store, rows = _store(spark), _document_texts(spark, sf_dir)
    middle = F.format_string("o%012d", F.lit(B.texts(spark, sf_dir).agg(F.avg("doc_id").cast("bigint")).first()[0] or 0))
    for part, start, version in ((rows.where(F.col("object_name") <= middle), FIRST_RUN, FIRST_RUN), (rows.where(F.col("object_name") > middle), FROM_DATE, VERSION)):
        daily.version_dedup_step(store, daily.dedup_step(part, index=daily.stored_index(store, start)), version, start)
    uniques = store.read("unique_onions", VERSION).where("n_members > 0")
    return uniques.select(F.substr("object_name", F.lit(2)).cast("bigint").alias("representative"), "n_members")


@query
def version_dedup_step(spark, sf_dir):
    return daily.version_dedup_step(_store(spark), daily.dedup_step(_document_texts(spark, sf_dir)), VERSION).counts


@query
def language_step(spark, sf_dir):
    labelled = B.labelled_texts(spark, sf_dir)
    model = L.train(labelled.select("text", "lang"))
    return _confidences(daily.language_step(model, daily.dedup_step(_document_texts(spark, sf_dir))).rows)


@query
def version_language_step(spark, sf_dir):
    store, rows = _store(spark), _languages(spark, sf_dir)
    daily.version_language_step(store, rows, C.FIRST_VERSION, FIRST_RUN, "doc_id")
    new = rows.where("first_language = 'Spanish'").withColumn("first_language", F.lit("Portuguese"))
    return _rounded(daily.version_language_step(store, new, FROM_DATE, VERSION, "doc_id").counts, "value")


@query
def classify_step(spark, sf_dir):
    histogram = daily.classify_step(_languages(spark, sf_dir), B.texts(spark, sf_dir), "doc_id")
    return G.length_boxes(histogram)


@query
def daily_pipeline(spark, sf_dir):
    store, stored = _store(spark), materialize(B.html_objects(spark, sf_dir), "objects")
    model = L.train(B.labelled_texts(spark, sf_dir).select("text", "lang"))
    daily.daily_pipeline(store, stored, model, FROM_DATE, C.FIRST_DAY)
    return daily.daily_pipeline(store, stored, model, TODAY, FROM_DATE).select(*schemas.METRIC.fieldNames())


@query
def coherence_job(spark, sf_dir):
    return jobs.coherence_job(_objects(spark, sf_dir), B.registry(spark, sf_dir), TODAY)


@query
def downloaded_job(spark, sf_dir):
    return registry_out(jobs.downloaded_job(_objects(spark, sf_dir), B.registry(spark, sf_dir), date(2022, 12, 15)))


@query
def discover_code(spark, sf_dir):
    return discovery.discover_code(B.search_pages(spark, sf_dir), F.lit(RUN_TS))


@query
def discover_code_text(spark, sf_dir):
    return discovery.discover_code_text(B.noisy_texts(spark, sf_dir), F.lit(RUN_TS))


@query
def discover_gateways(spark, sf_dir):
    return discovery.discover_gateways(B.gateway_results(spark, sf_dir), F.lit(RUN_TS))


@query
def discover_ioc(spark, sf_dir):
    return discovery.discover_ioc(B.indicator_pages(spark, sf_dir), B.noisy_texts(spark, sf_dir), F.lit(RUN_TS))


@query
def discover_pages(spark, sf_dir):
    return discovery.discover_pages(_pages_with_addresses(spark, sf_dir).select("url", "html"), F.lit(RUN_TS))
