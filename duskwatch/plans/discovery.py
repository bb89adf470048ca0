"""Discovery over stored search results, lists and pages: each returns sighting records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from duskwatch.functions import addresses as A
from duskwatch.operators.crawl import page_addresses
from duskwatch.sources import search as S
from duskwatch.sources.lists import emit_sightings

ENGINE = "DuckDuckGo"
CODE_SOURCE = "Sourcegraph"
INDICATOR_SOURCE = "AlienVault"
LIST_SOURCE = "Suspicious/Scam/Malware repositories"


def discover_code(search_pages: DataFrame, ts: Column | None = None, responses: DataFrame | None = None) -> DataFrame:
    """Code search: addresses on marked lines, advertised by the repositories that hold them.

    ``responses`` are the stored answers ``(text)`` of a second search that tells no repository.
    """
    lines = S.hit_merge(S.marked_lines(S.explode_search_hits(search_pages)))
    found = emit_sightings(S.advertiser_concat(lines), F.col("advertiser"), ts)
    return found if responses is None else found.unionByName(discover_code_text(responses, ts))


def discover_code_text(responses: DataFrame, ts: Column | None = None) -> DataFrame:
    """Every address in the whole answers of a code search, once."""
    found = responses.select(F.explode(A.extract_addresses(F.col("text"))).alias("onion")).distinct()
    return emit_sightings(found, F.lit(CODE_SOURCE), ts)


def discover_gateways(results: DataFrame, ts: Column | None = None) -> DataFrame:
    """Gateway URLs in search results."""
    found = S.gateway_addresses(results)
    return emit_sightings(found, F.concat(F.lit(f"{ENGINE} ("), "gateway", F.lit(")")), ts)


def discover_ioc(indicator_pages: DataFrame, list_pages: DataFrame, ts: Column | None = None) -> DataFrame:
    """Indicator listings (first address of each) and plain list pages (every address)."""
    indicators = S.explode_indicators(indicator_pages).select(
        A.first_address(F.col("indicator")).alias("onion")).where("onion is not null").distinct()
    lists = list_pages.select(F.explode(A.extract_addresses(F.col("text"))).alias("onion")).distinct()
    return emit_sightings(lists, F.lit(LIST_SOURCE), ts).unionByName(
        emit_sightings(indicators, F.lit(INDICATOR_SOURCE), ts))


def discover_pages(pages: DataFrame, ts: Column | None = None) -> DataFrame:
    """Directory pages: every address in the visible text."""
    return emit_sightings(page_addresses(pages), F.col("advertiser"), ts)
