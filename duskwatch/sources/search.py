"""Search-result pages: code search, threat indicators, gateways."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from duskwatch import constants as C
from duskwatch import schemas
from duskwatch.functions import addresses as A
from duskwatch.functions import html as H


def explode_search_hits(pages: DataFrame) -> DataFrame:
    """Rows ``(page, repo, path, snippet, has_next)`` of code-search pages ``(page, value)``."""
    parsed = pages.withColumn("p", F.from_json("value", schemas.SEARCH_PAGE))
    hits = parsed.select("page", F.col("p.facets.count").alias("count"), F.explode("p.hits.hits").alias("h"))
    return hits.select(
        "page", F.col("h.repo.raw").alias("repo"), F.col("h.path.raw").alias("path"),
        F.col("h.content.snippet").alias("snippet"),
        (F.col("count") > C.GREP_PAGE_SIZE * F.col("page")).alias("has_next"),
    )


def marked_lines(hits: DataFrame) -> DataFrame:
    """Rows ``(page, repo, path, line_no, line)`` of the marked snippet lines."""
    return hits.select("page", "repo", "path", F.inline(H.snippet_rows(F.col("snippet"))))


def hit_merge(lines: DataFrame) -> DataFrame:
    """One line per ``(repo, path, line_no)``; the latest page wins, then the greatest line."""
    return lines.groupBy("repo", "path", "line_no").agg(F.max(F.struct("page", "line")).alias("last")).select(
        "repo", "path", "line_no", F.col("last.page").alias("page"), F.col("last.line").alias("line"))


def advertisers(lines: DataFrame) -> DataFrame:
    """Distinct ``(onion, repo)`` of the lines that mention an address, combined on the map side."""
    return lines.select(F.explode(A.extract_addresses(F.col("line"))).alias("onion"), "repo").distinct()


def advertiser_concat(lines: DataFrame) -> DataFrame:
    """Report over ``advertisers``: per address the sorted repositories as ``Grep.app (r1, r2)``.

    One row holds all repositories of an address, and nothing bounds their number; use the flat
    table for anything but the text.
    """
    return advertisers(lines).groupBy("onion").agg(F.sort_array(F.collect_list("repo")).alias("repos")).select(
        "onion", F.concat(F.lit("Grep.app ("), F.array_join("repos", ", "), F.lit(")")).alias("advertiser"))


def explode_indicators(pages: DataFrame) -> DataFrame:
    """Distinct indicators of all pages; the two sort orders overlap."""
    return pages.select(F.explode(F.from_json("value", schemas.INDICATOR_PAGE)["results"]["indicator"])
                        .alias("indicator")).distinct()


def both_sort_orders(rows: DataFrame, key: str, cap: int) -> DataFrame:
    """What a capped listing shows when read newest first and oldest first."""
    newest = rows.orderBy(F.desc(key)).limit(cap)
    oldest = rows.orderBy(F.asc(key)).limit(cap)
    return newest.union(oldest).distinct()


def page_cap(pages: DataFrame, cap: int = C.GREP_PAGE_CAP) -> DataFrame:
    """Result pages a code-search listing serves."""
    return pages.where(F.col("page") <= cap)


def gateway_addresses(results: DataFrame) -> DataFrame:
    """Distinct ``(gateway, onion)`` of gateway search results."""
    return results.select("gateway", A.gateway_address(F.col("url")).alias("onion")).where("onion is not null").distinct()


def gateway_cap(results: DataFrame, cap: int = C.GATEWAY_RESULT_CAP) -> DataFrame:
    """The first results each gateway query returns; the limit is applied before the shuffle."""
    first = Window.partitionBy("gateway").orderBy("rank")
    return results.withColumn("n", F.row_number().over(first)).where(F.col("n") <= cap).drop("n")
