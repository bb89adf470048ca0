"""From raw documents to training sequences, in five stages with a written table between them."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch.llm import decontamination, language_id, line_dedup, packing, shingle_join
from duskwatch.llm.scratch import free_names, stage
from duskwatch.session import prepare

#: A document stays if its language is at least this probable.
LEAST_SCORE = 0.5

#: Tokenizers, models and components are not expressible in SQL.
ORACLE_SQL = None


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or of no clear language, go. The model learns from the labelled ones."""
    vocabulary = public_tokenizers.path("piece_bpe_32k.model")
    model = language_id.train(docs, vocabulary)
    lang, score = free_names(docs, "lang", "score")
    found = language_id.predict(docs, model, vocabulary, lang_col=lang, score_col=score)
    return found.where((F.col(lang) != language_id.UNKNOWN) & (F.col(score) >= LEAST_SCORE)).select(*docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that repeat an earlier line go, and documents that lose all their words with them.

    ``n_chars``, if there, follows the text; other columns keep their values.
    """
    gone = line_dedup.duplicate_lines(docs.select("doc_id", "text"))
    lines, removed = free_names(docs, "lines", "removed")
    left = line_dedup.without_lines(docs, gone, lines_col=lines, removed_col=removed)
    left = left.where((F.col(removed) == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    if "n_chars" in docs.columns:
        length = F.when(F.col(removed) > 0, F.char_length("text")).otherwise(F.col("n_chars"))
        left = left.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return left.select(*docs.columns)


def distinct_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of near duplicates one row stays: the least id, then the least hash of id and text.

    Rows are told apart by id and text, so another text of a removed row's id stays. Rows with a null
    id are compared as any others and come last. Of rows equal in both the one with the least other
    columns stays. Rows without words belong to no group and all stay. Rows are named by a hash of 64
    bits for the comparison; where different rows share a name, all of them stay.
    """
    has_words = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
    key, other = free_names(docs, "key", "other")
    named = docs.where(has_words).withColumns({key: F.xxhash64("doc_id", "text"), other: F.xxhash64(F.lit(1), "doc_id", "text")})
    ids = stage(named.select(F.col(key).alias("key"), F.col(other).alias("other"), "doc_id").distinct(), "row_names")
    shared = ids.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = shingle_join.near_duplicates(named.select(F.col(key).alias("key"), "text"), "key").select(F.col("doc_id").alias("key"), "component_id")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "key")).alias("first")
    kept = found.distinct().join(ids, "key").groupBy("component_id").agg(first).select("first.key")
    kept = stage(kept.union(shared).distinct(), "kept_rows")
    one = F.min(F.struct(*[F.col(c) for c in docs.columns])).alias("row")
    left = named.join(kept.withColumnRenamed("key", key), key, "left_semi").groupBy(key, other).agg(one).select("row.*")
    return left.union(docs.where(~has_words))


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences of binary lengths, one row each."""
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("line_dedup", distinct_lines),
    ("ngram_jaccard", distinct_documents),
    ("decontamination", without_benchmark),
    ("packing", sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's table is written and read again."""
    docs = prepare(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
