"""Topics: clusters of text embeddings and the words that describe a class of texts."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A short stop-word list for the four languages of the test texts.
STOPWORDS = {
    "a", "and", "as", "at", "be", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that", "the", "this",
    "to", "was", "with",
    "au", "aux", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "la", "le", "les", "ou", "par",
    "pas", "pour", "que", "qui", "sur", "un", "une",
    "con", "del", "el", "los", "las", "por", "se", "una", "y",
    "das", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "sich", "und", "von", "zu",
}


def _nearest(vector: Column, centres: list[list[float]]) -> Column:
    """Number of the nearest centre; the first of equally near ones."""
    table = F.array(*[F.array(*[F.lit(x) for x in centre]) for centre in centres])

    def distance(centre: Column) -> Column:
        return F.aggregate(F.zip_with(vector, centre, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda x, y: x + y)

    ranked = F.transform(table, lambda centre, i: F.struct(distance(centre).alias("d"), i.alias("topic")))
    return F.array_min(ranked)["topic"]


def topic_model(embeddings: DataFrame, k: int, rounds: int = 8) -> DataFrame:
    """``(vec_id, topic)``: cluster of every embedding, by a fixed number of Lloyd rounds.

    The first centres are the ``k`` vectors with the least ids. A round assigns every vector to
    its nearest centre and averages the vectors of a topic by map-side aggregates; a topic without
    vectors keeps its centre. The driver holds ``k`` centres, rounded to six digits, so a run gives
    the same topics again. Null vectors and vectors with null components are left out.
    """
    vectors = embeddings.where("embedding is not null and not exists(embedding, x -> x is null)").select(
        "vec_id", F.col("embedding").cast("array<double>").alias("v"))
    first = vectors.orderBy("vec_id", "v").limit(k).collect()
    centres = [[float(x) for x in r["v"]] for r in first]
    if not centres:
        return vectors.select("vec_id", F.lit(0).alias("topic"))
    means = [F.round(F.avg(F.get("v", F.lit(i))), 6).alias(f"m{i}") for i in range(len(centres[0]))]
    for _ in range(rounds):
        moved = vectors.withColumn("topic", _nearest(F.col("v"), centres)).groupBy("topic").agg(*means).collect()
        for row in moved:
            centres[row["topic"]] = list(row[1:])
    return vectors.select("vec_id", _nearest(F.col("v"), centres).alias("topic"))


def topic_words(text: Column) -> Column:
    """Lower-case words of letters only."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"\p{L}+"), F.lit(0))


def word_counts(texts: DataFrame, topic: str, stopwords: set[str] | None = STOPWORDS) -> DataFrame:
    """``(topic, word, tf)``; counted on the map side before any shuffle."""
    rows = texts.select(F.col(topic).alias("topic"), F.explode(topic_words(F.col("text"))).alias("word"))
    if stopwords:
        rows = rows.where(~F.col("word").isin(*sorted(stopwords)))
    return rows.groupBy("topic", "word").agg(F.count("*").alias("tf"))


def class_tfidf(counts: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` words that describe each topic best: ``tf * ln(1 + A / f)``.

    ``f`` is a word's count over all topics and ``A`` the mean number of words per topic.
    Only word counts are shuffled, one row per topic and word.
    """
    totals = counts.groupBy("word").agg(F.sum("tf").alias("f"))
    mean = counts.agg((F.sum("tf") / F.count_distinct("topic")).alias("a"))  # one row
    scored = counts.join(totals, "word").join(F.broadcast(mean)).withColumn(
        "score", F.col("tf") * F.log1p(F.col("a") / F.col("f")))
    order = Window.partitionBy("topic").orderBy(F.desc(F.round("score", 6)), "word")
    return scored.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n).select(
        "topic", F.col("rank").cast("bigint").alias("rank"), "word", "tf", F.round("score", 6).alias("score"))


def drop_stopwords(words: DataFrame, stopwords: set[str] = STOPWORDS) -> DataFrame:
    """Words that are not stop words; the list is a fixed constant."""
    return words.where(~F.col("word").isin(*sorted(stopwords)))
