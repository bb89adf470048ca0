"""Counters, shares and length profiles."""

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.functions.cleaners import sentence_split, word_tokens


def counter_rows(counts: DataFrame) -> DataFrame:
    """One row of counters as ``(metric, value)`` rows."""
    pairs = F.array(*[F.struct(F.lit(c).alias("metric"), F.col(f"`{c}`").cast("double").alias("value"))
                      for c in counts.columns])
    return counts.select(F.inline(pairs))


def status_counts(cleaned: DataFrame, prefix: str = "") -> DataFrame:
    """Total, empty, badly encoded and clean rows of a table with ``status``."""
    names = {
        "": ("Total onions", "Empty onions", "Bad-encoded onions", "Cleaned onions"),
        "Total": ("Total collected onions", "Total empty onions", "Total bad encoded", "Total cleaned onions"),
    }[prefix]
    status = F.col("status")
    return counter_rows(cleaned.agg(
        F.count("*").alias(names[0]),
        F.count_if(status == "empty").alias(names[1]),
        F.count_if(status == "bad").alias(names[2]),
        F.count_if(status == "ok").alias(names[3]),
    ))


def preprocess_counts(preprocessed: DataFrame, total: bool = False) -> DataFrame:
    """Rows before and after noise removal, and those it left empty."""
    names = (
        ("Total cleaned onions", "Total empty onions (after preprocessing)", "Total preprocessed onions")
        if total else ("Cleaned onions", "Empty onions (after preprocessing)", "Preprocessed onions")
    )
    return counter_rows(preprocessed.agg(
        F.count("*").alias(names[0]),
        F.count_if(F.col("text") == "").alias(names[1]),
        F.count_if(F.col("text") != "").alias(names[2]),
    ))


def share_of_total(counts: DataFrame, value: str = "n") -> DataFrame:
    """Percentage of each row in the column total; ``counts`` is one row per class."""
    total = counts.agg(F.sum(value).alias("total"))
    return counts.join(F.broadcast(total)).withColumn("percentage", F.col(value) * 100.0 / F.col("total")).drop("total")


def language_share(languages: DataFrame) -> DataFrame:
    """Percentage of texts per first language."""
    counts = languages.groupBy(F.col("first_language").alias("language")).agg(F.count("*").alias("n"))
    return share_of_total(counts).select("language", "percentage")


def top_languages(languages: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` largest language shares; equal shares in order of the name."""
    return language_share(languages).orderBy(F.desc("percentage"), "language").limit(k)


def daily_object_count(objects: DataFrame) -> DataFrame:
    return objects.groupBy("dt").agg(F.count("*").alias("n_objects"))


def text_lengths(texts: DataFrame) -> DataFrame:
    """Sentences and words of every text."""
    return texts.select(
        F.size(sentence_split(F.col("text"))).cast("bigint").alias("n_sentences"),
        F.size(word_tokens(F.col("text"))).cast("bigint").alias("n_words"),
    )


def length_histograms(texts: DataFrame) -> DataFrame:
    """Number of texts per sentence count and per word count."""
    lengths = text_lengths(texts)
    kinds = F.array(
        F.struct(F.lit("sentences").alias("kind"), F.col("n_sentences").alias("length")),
        F.struct(F.lit("words").alias("kind"), F.col("n_words").alias("length")),
    )
    return lengths.select(F.inline(kinds)).groupBy("kind", "length").agg(F.count("*").alias("n_texts"))


def five_numbers(values: Column, weights: Column | None = None) -> list[Column]:
    """Minimum, quartiles and maximum; percentiles keep one counter per distinct value."""
    names = ("minimum", "lower_quartile", "median", "upper_quartile", "maximum")
    points = F.array(*[F.lit(p) for p in (0.0, 0.25, 0.5, 0.75, 1.0)])
    summary = F.percentile(values, points) if weights is None else F.percentile(values, points, weights)
    return [F.get(summary, F.lit(i)).alias(name) for i, name in enumerate(names)]


def length_boxes(histogram: DataFrame, weighted: bool = False) -> DataFrame:
    """Five-number summary per kind, over the distinct lengths or weighted by texts."""
    weights = F.col("n_texts") if weighted else None
    return histogram.groupBy("kind").agg(*five_numbers(F.col("length"), weights))


def as_metrics(counts: DataFrame, step: str, version: date) -> DataFrame:
    """Counters as rows of the metrics table."""
    return counts.select(
        F.lit(step).alias("step"), F.lit(version).alias("version_date"),
        "metric", F.col("value").cast("double").alias("value"))


def language_metrics(languages: DataFrame) -> DataFrame:
    """Total and the ten largest shares as ``(metric, value)`` rows."""
    total = counter_rows(languages.agg(F.count("*").alias("Total onions")))
    top = top_languages(languages).select(F.col("language").alias("metric"), F.col("percentage").alias("value"))
    return total.unionByName(top)
