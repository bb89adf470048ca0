"""From stored page bodies to one cleaned text per page."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.functions import cleaners as K
from duskwatch.functions import html as H
from duskwatch.sources.messages import object_key_join
from duskwatch.sources.objects import decode_utf8


def page_parts(objects: DataFrame) -> DataFrame:
    """Title, description and main content of every object; null where the body is not UTF-8."""
    def part(read) -> Column:
        return F.when(~F.col("bad"), read(F.col("html")))

    return decode_utf8(objects).withColumns({
        "title": part(H.html_title), "description": part(H.html_description), "content": part(H.main_content),
    }).drop("html", "body")


def clean_pages(objects: DataFrame) -> DataFrame:
    """``(object_name, dt, text, status)`` with status ``ok``, ``empty`` or ``bad``."""
    text = K.compose_text(F.col("title"), F.col("description"), F.col("content"))
    composed = page_parts(objects).withColumn("text", F.when(F.col("bad"), "").otherwise(text))
    status = F.when(F.col("bad"), "bad").when(F.col("text") == "", "empty").otherwise("ok")
    return composed.select("object_name", "dt", "text", status.alias("status"))


def page_enrich(events: DataFrame, objects: DataFrame) -> DataFrame:
    """Title and description behind each object event; undecodable events and bodies drop out."""
    joined = decode_utf8(object_key_join(events, objects)).where("not bad")
    return joined.select(
        *[c for c in events.columns if c != "value"], "event_name", "event_time", "object_name",
        H.html_title(F.col("html")).alias("title"), H.html_description(F.col("html")).alias("description"))


def preprocess(cleaned: DataFrame) -> DataFrame:
    """Noise-free text of every page that had one; sentinel states drop out."""
    return cleaned.where("status = 'ok'").select("object_name", K.remove_noise(F.col("text")).alias("text"))


def sentences(texts: DataFrame, id_col: str) -> DataFrame:
    """``(id, pos, sentence)`` of every text."""
    return texts.select(id_col, F.posexplode(K.sentence_split(F.col("text"))).alias("pos", "sentence"))
