"""Domain tables derived from the generic test tables.

The engine works on sightings, a registry, stored pages, search hits and so on. Every one
of them is derived here from ``events``, ``pages`` and ``documents`` by row-wise
expressions and aggregates, so that it grows with its table. ``oracle.py`` states the same
views in ANSI SQL.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from duskwatch import constants as C
from duskwatch import schemas
from duskwatch.functions import addresses as A
from duskwatch.session import spread

EPOCH_MICROS = "timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)"
REGISTRY_MIN_VALUE = 130


def address(key: str) -> str:
    """SQL text of a valid 62-character address made from a key expression."""
    return f"concat(translate(substr(concat(md5({key}), md5(concat('x', {key}))), 1, 55), '0189', 'wxyz'), 'd.onion')"


SPREAD = {
    "pages": ("page_id", "url", "html"),
    "documents": ("doc_id", "text", "lang", "source"),
    "events": ("event_id", "ts", "user_id", "event_type", "value"),
}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table; tables that feed costly work are spread over all cores if they are not yet."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    columns = columns or SPREAD.get(name, ())
    df = df.select(*columns) if columns else df
    return spread(df) if {"html", "text", "ts"} & set(columns) else df


def sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per event; one collection is foreign to the four sources."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "case event_type when 'click' then 'results_onions_farmer' when 'view' then 'results_gateways'"
        " when 'error' then 'results_ioc_repositories' when 'purchase' then 'results_code_repositories'"
        " else 'results_other' end as coll",
        "concat('adv', cast(event_id % 7 as string)) as advertiser",
        f"{address('concat(\"u\", cast(user_id as string))')} as onion",
        f"{EPOCH_MICROS} / 1e6D as ts",
    )


def source_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings of the four sources with the source name."""
    return (
        sightings(spark, sf_dir)
        .where(F.col("coll").isin(*[C.COLLECTION_PREFIX + s for s in C.SOURCES]))
        .withColumn("source", A.source_from_topic(F.col("coll")))
        .drop("coll")
    )


def registry(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Addresses of users with a large sign-up, about two thirds of all addresses."""
    users = (
        table(spark, sf_dir, "events", "user_id", "event_type", "value").where("event_type = 'signup'")
        .groupBy("user_id").agg(F.max("value").alias("v")).where(F.col("v") >= REGISTRY_MIN_VALUE)
    )
    return users.selectExpr(
        f"{address('concat(\"u\", cast(user_id as string))')} as onion",
        "user_id % 2 = 0 as downloaded",
        "timestamp_seconds(1704067200 + 3600 * user_id) as download_date",
        "cast(1704067200 + 3600 * user_id as double) as ts",
        "user_id % 4 = 0 as onions_farmer", "user_id % 5 = 0 as ioc_repositories",
        "user_id % 7 = 0 as gateways", "user_id % 11 = 0 as code_repositories",
        "cast(null as double) as first_identification",
    ).to(schemas.REGISTRY)


def html_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored pages; one address in five occurs on two days, some bodies are empty or bad UTF-8."""
    key = "concat('u', cast(case when page_id % 5 = 4 then page_id - 1 else page_id end as string))"
    described = (
        "replace(html, '</title>', concat('</title><meta name=\"description\" content=\"',"
        " case when page_id % 6 = 0 then 'About this page'"
        " else regexp_extract(html, '<title>(.*?)</title>', 1) end, '\">'))"
    )
    return (
        table(spark, sf_dir, "pages")
        .selectExpr(
            "page_id", "url", "date_add(date'2022-11-01', cast(page_id % 60 as int)) as dt", f"{address(key)} as onion",
            "case when page_id % 19 = 18 then 'empty' when page_id % 17 = 16 then 'bad' else 'ok' end as expected",
            f"case when page_id % 19 = 18 then '' when page_id % 3 = 0 then {described} else html end as html",
        )
        .withColumn("object_name", A.object_path(F.col("dt"), F.col("onion")))
        .withColumn("body", F.expr(
            "case when expected = 'bad' then concat(unhex('FF'), encode(html, 'UTF-8')) else encode(html, 'UTF-8') end"))
        .select("page_id", "url", "object_name", "dt", "onion", "body")
    )


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as they are."""
    return table(spark, sf_dir, "documents", "doc_id", "text")


def noisy_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents, most with one noise sentence appended so that every rule fires."""
    addr = address("concat('d', cast(doc_id as string))")
    return table(spark, sf_dir, "documents", "doc_id", "text").selectExpr("doc_id", f"{addr} as onion", f"""concat(text,
         case doc_id % 11
           when 0 then concat(' Visit ', {addr}, ' today.')
           when 1 then ' -----BEGIN PGP PUBLIC KEY BLOCK----- abc -----END PGP PUBLIC KEY BLOCK-----.'
           when 2 then ' Write to a.b@c.org now.' when 3 then ' It costs $ 25 today.'
           when 4 then '. http://example.org/x' when 5 then ' Send to 1AGNa15ZQXAZUgFiqJ2i7Z2DPU2J6hW62i now.'
           when 6 then '. Login' when 7 then ' !!! ??? -- 12 word word , end' else '' end) as text""")


def search_hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code-search hits on 120 result pages; keys repeat across pages so that the later page wins."""
    addr = address("concat('d', cast(doc_id % 60 as string))")
    return table(spark, sf_dir, "documents", "doc_id", "lang", "source").selectExpr(
        "source as repo", "concat(lang, '/', cast(doc_id % 40 as string)) as path",
        "cast(doc_id % 5 as string) as line_no", "doc_id", "1 + doc_id % 120 as page",
        f"concat('see ', {addr}, ' in <', lang, '> & co') as line",
    )


def search_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search-result pages as JSON, one hit per page, with an unmarked line in each snippet."""
    def esc(c: str) -> str:
        return f"replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"

    snippet = (
        "concat('<table><tr data-line=\"0\"><td><div class=\"lineno\">999</div></td><td><pre>import re</pre></td></tr>',"
        " '<tr><td><div class=\"lineno\"> ', line_no, '</div></td><td><pre>',"
        f" replace({esc('line')}, 'see', '<mark>see</mark>'), '</pre></td></tr></table>')"
    )
    return search_hits(spark, sf_dir).selectExpr("page", f"""to_json(named_struct(
        'facets', named_struct('count', page * 10 + doc_id % 3),
        'hits', named_struct('hits', array(named_struct(
            'repo', named_struct('raw', repo), 'path', named_struct('raw', path),
            'content', named_struct('snippet', {snippet})))))) as value""")


def indicator_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Threat-indicator pages as JSON, one indicator each, listed in both sort orders."""
    rows = sightings(spark, sf_dir).selectExpr(
        "event_id", "case when coll = 'results_other' then concat('http://plain.example/', advertiser)"
        " else concat('http://', onion, '/x?', onion) end as indicator")
    return rows.selectExpr("event_id", "explode(array('-modified', 'modified')) as sort_order", "indicator").selectExpr(
        "sort_order", "event_id as page",
        "to_json(named_struct('results', array(named_struct('indicator', indicator)))) as value")


def gateway_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search results for gateways: URLs ``http://<label>.<gateway>/``, some without a label."""
    return sightings(spark, sf_dir).selectExpr(
        "event_id as rank", "concat('gw', substr(advertiser, 4), '.example') as gateway",
        "case when coll = 'results_other' then concat('http://www.gw', substr(advertiser, 4), '.example/')"
        " else concat('https://', substr(onion, 1, 57), 'gw', substr(advertiser, 4), '.example/p') end as url")


def links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outgoing links per page."""
    pages = table(spark, sf_dir, "pages", "page_id")
    total = pages.agg(F.count("*").alias("n"))  # one row
    return pages.join(F.broadcast(total)).selectExpr(
        "page_id as src", "explode(array((page_id * 7 + 1) % n, (page_id * 3 + 2) % n)) as dst")


def message_place() -> list[Column]:
    """Partition and offset of a message; offsets restart in every partition of every topic."""
    return [(F.col("event_id") % 10).cast("int").alias("partition"), F.floor(F.col("event_id") / 10).alias("offset")]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sightings as stream messages, JSON encoded twice; some undecodable, some without the field."""
    def twice(field: str) -> Column:
        once = F.concat(F.lit(f'{{"{field}":"'), F.col("onion"), F.lit('"}'))
        return F.concat(F.lit('"'), F.replace(once, F.lit('"'), F.lit('\\"')), F.lit('"'))

    slot = F.col("event_id") % 50
    return sightings(spark, sf_dir).where("coll <> 'results_other'").select(
        F.concat(F.lit("crawlab_test."), "coll").alias("topic"), *message_place(), "ts",
        F.when(slot == 49, "{bad").when(slot == 48, twice("other")).otherwise(twice("onion")).alias("value"),
    )


def change_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change-stream documents of all collections as JSON."""
    return sightings(spark, sf_dir).selectExpr("event_id", """to_json(named_struct(
        'ns', named_struct('db', 'crawlab_test', 'coll', coll),
        'fullDocument', named_struct('advertiser', advertiser, 'onion', onion, 'ts', ts))) as value""")


def object_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Object-created events; a few are undecodable."""
    return html_objects(spark, sf_dir).selectExpr("page_id", """case when page_id % 41 = 40 then '{bad' else concat(
        '{"EventName":"s3:ObjectCreated:Put","Key":"onions/', object_name,
        '","Records":[{"eventTime":"', cast(dt as string), 'T00:00:00Z"}]}') end as value""")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset versions over thirty days; texts not in English change the day after."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang").selectExpr(
        "doc_id", "concat('o', cast(doc_id as string)) as object_name", "lang", "text",
        "date_add(date'2022-11-15', cast(doc_id % 30 as int)) as version_date")
    changed = docs.where("lang <> 'en'").selectExpr(
        "doc_id", "object_name", "lang", "concat('changed ', text) as text", "date_add(version_date, 1) as version_date")
    return docs.unionByName(changed).select("version_date", "object_name", "text")


def labelled_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id", "text", "lang")
