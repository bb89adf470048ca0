"""Finding and checking addresses, and taking paths, topics and URLs apart."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from duskwatch import constants as C


def extract_addresses(text: Column) -> Column:
    """All distinct addresses in a text."""
    return F.array_distinct(F.regexp_extract_all(text, F.lit(C.ADDRESS), F.lit(0)))


def first_address(value: Column) -> Column:
    """First address in a value, null if there is none."""
    return F.nullif(F.regexp_extract(value, C.ADDRESS, 0), F.lit(""))


def gateway_address(url: Column) -> Column:
    """Address hidden in a gateway URL (``<label>.<gateway>``), null if there is none."""
    label = F.regexp_extract(url, C.GATEWAY_ADDRESS, 0)
    return F.when(label != "", F.concat(label, F.lit(C.ADDRESS_SUFFIX[1:])))


def is_valid_address(value: Column) -> Column:
    return (
        (F.octet_length(value) >= C.MIN_ADDRESS_LENGTH)
        & value.endswith(C.ADDRESS_SUFFIX)
        & value.rlike("(?d)" + C.VALID_ADDRESS.replace("$", r"\z"))
    )


def url_authority(url: Column) -> Column:
    """Network location with user and port; empty when the URL has no ``//`` part."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def url_host(url: Column) -> Column:
    authority = F.regexp_replace(url_authority(url), r"^.*@", "")
    return F.lower(F.regexp_replace(authority, r":\d*$", ""))


def address_url(onion: Column) -> Column:
    return F.concat(F.lit("http://"), onion)


def source_from_topic(topic: Column) -> Column:
    """Source name behind a stream topic or a collection name."""
    return F.regexp_replace(topic, rf"^(?:{C.TOPIC_PREFIX.replace('.', '[.]')})?{C.COLLECTION_PREFIX}", "")


def path_address(path: Column) -> Column:
    """Address part of an object path: the file name without ``.html``."""
    return F.regexp_extract(path, r"([^/]+)\.html$", 1)


def path_address_fixed(path: Column) -> Column:
    """The fixed-width form of :func:`path_address` for 62-character addresses."""
    return F.substring(path, -67, 62)


def path_date(path: Column) -> Column:
    """Day of an object path, null if it names none; month and day carry no leading zero."""
    part = [F.regexp_extract(path, r"^/?(\d+)/(\d+)/(\d+)/", i) for i in (1, 2, 3)]
    return F.concat_ws("-", *part).try_cast("date")


def object_path(dt: Column, onion: Column, folder: str = "htmls", suffix: str = "html") -> Column:
    return F.concat_ws(
        "/",
        F.year(dt).cast("string"), F.month(dt).cast("string"), F.dayofmonth(dt).cast("string"),
        F.lit(folder), F.concat(onion, F.lit("." + suffix)),
    )


def event_object_name(key: Column) -> Column:
    """Object path behind an event key: the key without its bucket name."""
    return F.substr(key, F.lit(len(C.OBJECT_BUCKET_PREFIX) + 1))
