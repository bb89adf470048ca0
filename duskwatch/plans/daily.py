"""The daily analysis: download, version, preprocess, deduplicate, label, classify.

Each step takes tables, writes its version to a :class:`VersionStore` where it has one, and
returns the stored rows with its counters, so the lineage is cut at every dataset.
"""

from dataclasses import dataclass, fields, replace
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.operators import counts as G
from duskwatch.operators import dedup as D
from duskwatch.operators import language as L
from duskwatch.operators import pages as P
from duskwatch.operators.near_index import KEYS, NearIndex, extend, grown
from duskwatch.session import materialize
from duskwatch.sources.objects import scan_date_range
from duskwatch.sources.versions import VersionStore


@dataclass
class Step:
    rows: DataFrame
    counts: DataFrame


@dataclass
class DedupStep:
    added: NearIndex      # the rows this run adds to the stored index
    index: NearIndex      # the index with them
    counts: DataFrame

    @property
    def exact(self) -> DataFrame:
        """``(text_key, object_name)``: previous and new memberships."""
        return self.index.exact

    @property
    def texts(self) -> DataFrame:
        """``(text_id, text_key, object_name, text, n_copies)``: one row per distinct text."""
        return self.index.counted_texts()

    @property
    def near(self) -> DataFrame:
        """``(text_id, group_id, representative, n_members)``: one row per distinct text."""
        return self.index.near()


def download_step(objects: DataFrame, from_date: date, today: date) -> Step:
    cleaned = P.clean_pages(scan_date_range(objects, from_date, today)).select("object_name", "text", "status")
    return Step(cleaned, G.status_counts(cleaned))


def _version(store: VersionStore, dataset: str, new: DataFrame, key: str, from_date: date, version: date) -> DataFrame:
    """The newest version before ``from_date`` overlaid by this run's rows; only these are written."""
    return store.append(new, dataset, version, key, store.newest_before(dataset, from_date))


def version_cleaned_step(store: VersionStore, cleaned: DataFrame, from_date: date, version: date) -> Step:
    rows = _version(store, "cleaned_onions", cleaned, "object_name", from_date, version)
    counts = G.status_counts(rows, "Total")
    store.write_stats(counts, "cleaned_onions", version)
    return Step(rows, counts)


def preprocess_step(cleaned: DataFrame) -> Step:
    rows = P.preprocess(cleaned)
    return Step(rows, G.preprocess_counts(rows))


def version_preprocessed_step(store: VersionStore, preprocessed: DataFrame, from_date: date, version: date) -> Step:
    rows = _version(store, "preprocessed_onions", preprocessed, "object_name", from_date, version)
    counts = G.preprocess_counts(rows, total=True)
    store.write_stats(counts, "preprocessed_onions", version)
    return Step(rows, counts)


def dedup_step(
    preprocessed: DataFrame, previous_exact: DataFrame | None = None, previous_texts: DataFrame | None = None,
    index: NearIndex | None = None,
) -> DedupStep:
    """The index of texts and near groups grown by this run: only texts that it lacks are signed.

    Without an ``index`` one is made of the previous run's texts and memberships, if given.
    Counters are about this run's rows: a text known before makes its copies exact mirrors;
    new texts are unique or near mirrors by their place in the groups.
    """
    if index is None and previous_texts is not None:
        made = extend(None, previous_texts.select("object_name", "text")).added
        index = replace(made, exact=previous_exact if previous_exact is not None else made.exact)
    found = extend(index, preprocessed)
    counts = G.counter_rows(found.added.exact.agg(F.count("*").alias("total")).select(
        F.col("total").alias("Total onions"),
        (F.col("total") - found.n_fresh).alias("Exact mirrors"),
        F.lit(found.n_fresh - found.n_fresh_unique).alias("Near mirrors"),
        F.lit(found.n_fresh_unique).alias("Unique onions")))
    return DedupStep(found.added, grown(index, found.added), counts)


INDEX = {f.name: f"near_index_{f.name}" for f in fields(NearIndex)}


def stored_index(store: VersionStore, from_date: date) -> NearIndex | None:
    """The near-duplicate index of the newest version before ``from_date``."""
    tables = {name: store.latest_before(dataset, from_date) for name, dataset in INDEX.items()}
    return None if None in tables.values() else NearIndex(**tables)


def version_dedup_step(
    store: VersionStore, dedup: DedupStep, version: date, from_date: date | None = None
) -> Step:
    """Write what the run adds to the index and to the unique texts; count the totals.

    ``from_date`` is the first day of the run; by default the day of the version.
    """
    from_date = from_date or version
    state = NearIndex(**{
        name: store.append(getattr(dedup.added, name), dataset, version, KEYS[name], store.newest_before(dataset, from_date))
        for name, dataset in INDEX.items()})
    # Representatives of the groups that changed; merged groups are left without one.
    changed = store.delta(INDEX["groups"], version).select("group_id", "representative", "n_members")
    texts = state.texts.withColumnRenamed("text_id", "representative")
    uniques = store.append(
        changed.join(texts, "representative", "left"), "unique_onions", version, "group_id",
        store.newest_before("unique_onions", from_date)).where("n_members > 0")
    counts = D.dedup_counts_total(D.exact_duplicates(state.exact), uniques)
    store.write_stats(counts, "deduplicated_onions", version)
    return Step(uniques, counts)


def language_step(model: L.LanguageModel, dedup: DedupStep) -> Step:
    """The two best languages of every representative text."""
    uniques = dedup.index.uniques().select(F.col("representative").alias("text_id"))
    rows = L.language_top2(model, dedup.index.texts.join(uniques, "text_id", "left_semi"), "text_key")
    return Step(rows, G.language_metrics(rows))


def version_language_step(
    store: VersionStore, languages: DataFrame, from_date: date, version: date, key: str = "text_key"
) -> Step:
    rows = _version(store, "languages", languages, key, from_date, version)
    store.write_stats(G.top_languages(rows).select(F.col("language").alias("metric"), F.col("percentage").alias("value")),
                      "languages", version)
    return Step(rows, G.language_metrics(rows))


def classify_step(languages: DataFrame, texts: DataFrame, key: str = "text_key") -> DataFrame:
    """Sentence and word histograms of the texts whose first language is English."""
    english = texts.join(L.semi_english(languages).select(key), key, "left_semi")
    return G.length_histograms(english)


def daily_pipeline(
    store: VersionStore, objects: DataFrame, model: L.LanguageModel, today: date, from_date: date | None = None
) -> DataFrame:
    """All steps for the days ``[from_date, today)``; returns the run's metrics table."""
    version = today - timedelta(days=1)
    from_date = from_date or version
    download = download_step(objects, from_date, today)
    cleaned = materialize(download.rows, "cleaned")
    total_cleaned = version_cleaned_step(store, cleaned, from_date, version)
    preprocessed = materialize(preprocess_step(cleaned).rows, "preprocessed")
    total_preprocessed = version_preprocessed_step(store, preprocessed, from_date, version)
    dedup = dedup_step(preprocessed, index=stored_index(store, from_date))
    total_dedup = version_dedup_step(store, dedup, version, from_date)
    language = language_step(model, dedup)
    labelled = materialize(language.rows, "languages")
    total_language = version_language_step(store, labelled, from_date, version)
    lengths = store.write(classify_step(labelled, dedup.index.texts), "english_lengths", version)
    steps = {
        "download": G.status_counts(cleaned),
        "version_cleaned": total_cleaned.counts,
        "preprocess": G.preprocess_counts(preprocessed),
        "version_preprocessed": total_preprocessed.counts,
        "deduplicate": dedup.counts,
        "version_deduplicated": total_dedup.counts,
        "identify_languages": G.language_metrics(labelled),
        "version_languages": total_language.counts,
        "classify": lengths.groupBy(F.concat(F.lit("Distinct "), "kind", F.lit(" counts")).alias("metric")).agg(
            F.count("*").cast("double").alias("value")),
    }
    metrics = None
    for name, counts in steps.items():
        rows = G.as_metrics(counts, name, version)
        metrics = rows if metrics is None else metrics.unionByName(rows)
    return store.write(metrics.drop("version_date"), "metrics", version).withColumn("version_date", F.lit(version))
