"""Table schemas."""

from pyspark.sql import types as T

SIGHTING = T.StructType([
    T.StructField("advertiser", T.StringType()),
    T.StructField("onion", T.StringType()),
    T.StructField("ts", T.DoubleType()),
])

REGISTRY = T.StructType([
    T.StructField("onion", T.StringType()),
    T.StructField("downloaded", T.BooleanType()),
    T.StructField("download_date", T.TimestampType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("onions_farmer", T.BooleanType()),
    T.StructField("ioc_repositories", T.BooleanType()),
    T.StructField("gateways", T.BooleanType()),
    T.StructField("code_repositories", T.BooleanType()),
    T.StructField("first_identification", T.DoubleType()),
])

MESSAGE = T.StructType([
    T.StructField("topic", T.StringType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("ts", T.DoubleType()),
    T.StructField("value", T.StringType()),
])

CHANGE_EVENT = T.StructType([
    T.StructField("ns", T.StructType([T.StructField("db", T.StringType()), T.StructField("coll", T.StringType())])),
    T.StructField("fullDocument", SIGHTING),
])

OBJECT_EVENT = T.StructType([
    T.StructField("EventName", T.StringType()),
    T.StructField("Key", T.StringType()),
    T.StructField("Records", T.ArrayType(T.StructType([T.StructField("eventTime", T.StringType())]))),
])

SEARCH_PAGE = T.StructType([
    T.StructField("facets", T.StructType([T.StructField("count", T.LongType())])),
    T.StructField("hits", T.StructType([T.StructField("hits", T.ArrayType(T.StructType([
        T.StructField("repo", T.StructType([T.StructField("raw", T.StringType())])),
        T.StructField("path", T.StructType([T.StructField("raw", T.StringType())])),
        T.StructField("content", T.StructType([T.StructField("snippet", T.StringType())])),
    ])))])),
])

INDICATOR_PAGE = T.StructType([
    T.StructField("results", T.ArrayType(T.StructType([T.StructField("indicator", T.StringType())]))),
    T.StructField("next", T.StringType()),
])

METRIC = T.StructType([
    T.StructField("step", T.StringType()),
    T.StructField("version_date", T.DateType()),
    T.StructField("metric", T.StringType()),
    T.StructField("value", T.DoubleType()),
])
