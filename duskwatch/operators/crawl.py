"""Stored directory pages: addresses in them, their links, and reach by depth."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from duskwatch.constants import CRAWL_DEPTH
from duskwatch.functions import addresses as A
from duskwatch.functions import html as H
from duskwatch.operators.skew import join_counted
from duskwatch.session import materialize


def page_addresses(pages: DataFrame) -> DataFrame:
    """Addresses in the visible text of pages ``(url, html)`` with the page's host as advertiser."""
    return pages.select(
        A.url_authority(F.col("url")).alias("advertiser"),
        F.explode(A.extract_addresses(H.visible_text(F.col("html")))).alias("onion"))


def extract_links(pages: DataFrame, start_urls: DataFrame) -> DataFrame:
    """Distinct links ``(url, link)`` whose host, or a parent domain of it, is a start URL's host."""
    allowed = start_urls.select(A.url_host(F.col("url")).alias("domain")).distinct()
    found = pages.select("url", F.explode(F.array_distinct(H.href_values(F.col("html")))).alias("href"))
    links = found.select("url", H.resolve_link(F.col("url"), F.col("href")).alias("link")).where(
        F.col("link").rlike("^(?i)https?://")).distinct()
    labels = F.split(A.url_host(F.col("link")), "[.]")
    domains = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    return (
        links.withColumn("domain", F.explode(domains)).join(allowed, "domain", "left_semi")
        .select("url", "link").distinct()
    )


def depth_limited_reach(links: DataFrame, starts: DataFrame, depth: int = CRAWL_DEPTH) -> DataFrame:
    """Pages reachable from ``starts`` over ``links(src, dst)`` within ``depth`` steps, with their least depth.

    Breadth first: a round joins the links of the pages found last, leaves out those found
    before, and writes what is new; it ends early when nothing is. So every page is walked
    once, however the links run in circles, and no round's plan holds an earlier one. Pages
    with very many links are dealt over tasks. Null pages are left out.
    """
    links = links.where("src is not null and dst is not null").select(F.col("src").alias("page"), "dst")
    counts = materialize(links.groupBy("page").agg(F.count("*").alias("n")), "out_degrees")
    frontier = starts.where("page is not null").select("page").distinct()
    reached = visited = None
    for d in range(depth + 1):
        if d:
            found = join_counted(links, frontier, "page", counts=counts.join(frontier, "page", "left_semi"))
            frontier = found.select(F.col("dst").alias("page")).distinct().join(visited, "page", "left_anti")
        frontier = materialize(frontier, "frontier")
        layer = frontier.withColumn("depth", F.lit(d).cast("bigint"))
        reached = layer if reached is None else reached.union(layer)
        visited = reached.select("page")
        if d < depth and frontier.isEmpty():
            break
    return reached
