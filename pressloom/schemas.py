"""Fixed record layouts: column order of the stored tables and config/state shapes."""

from __future__ import annotations

from pyspark.sql import types as T

ARTICLE_COLUMNS = [
    "title", "text", "description", "url", "visited_url", "scraped_from", "netloc", "path",
    "authors", "images", "videos", "lang", "keywords", "section", "publish_date", "generator",
    "summary", "fake", "scraped_date",
]

_S, _B, _TS, _L = T.StringType(), T.BooleanType(), T.TimestampNTZType(), T.LongType()
_ARR = T.ArrayType(T.StringType())

ARTICLE_SCHEMA = T.StructType([
    T.StructField("title", _S), T.StructField("text", _S), T.StructField("description", _S),
    T.StructField("url", _S, False), T.StructField("visited_url", _S), T.StructField("scraped_from", _S),
    T.StructField("netloc", _S), T.StructField("path", _S),
    T.StructField("authors", _ARR), T.StructField("images", _ARR), T.StructField("videos", _ARR),
    T.StructField("lang", _S), T.StructField("keywords", _ARR), T.StructField("section", _S),
    T.StructField("publish_date", _TS), T.StructField("generator", _S), T.StructField("summary", _S),
    T.StructField("fake", _B), T.StructField("scraped_date", _TS),
])

ERROR_COLUMNS = ["type", "url", "source_article", "from_fake", "additional_info", "creation_date"]
ERROR_SCHEMA = T.StructType([
    T.StructField("type", _S), T.StructField("url", _S), T.StructField("source_article", _S),
    T.StructField("from_fake", _B), T.StructField("additional_info", _S), T.StructField("creation_date", _TS),
])

SOURCE_SCHEMA = T.StructType([T.StructField("factual_reporting", _S), T.StructField("url", _S)])

LINK_SCHEMA = T.StructType([
    T.StructField("batch_id", _L), T.StructField("seq", _L), T.StructField("url", _S),
    T.StructField("scraped_from", _S), T.StructField("fake", _B),
])

STATE_DATA = T.StructType([T.StructField("url", _S), T.StructField("page", _L), T.StructField("posts", _L)])
STATE_SCHEMA = T.StructType([
    T.StructField("name", _S), T.StructField("is_over", _B), T.StructField("data", STATE_DATA),
])

SELECTORS = T.StructType([T.StructField("nextp", _S), T.StructField("entries", _S), T.StructField("links", _S)])
CONDITION = T.StructType([T.StructField("value_container", _S), T.StructField("values", _ARR)])
FEED_SCHEMA = T.StructType([
    T.StructField("type", _S), T.StructField("name", _S), T.StructField("url", _S),
    T.StructField("sel", SELECTORS), T.StructField("stop_after", _L), T.StructField("fake_news", _B),
    T.StructField("condition", CONDITION),
])
RULES_SCHEMA = T.StructType([
    T.StructField("blacklist", T.StructType([T.StructField("titles", _ARR), T.StructField("urls", _ARR)])),
    T.StructField("min_length", T.StructType([
        T.StructField("title", _L), T.StructField("text", _L), T.StructField("path_loc", _L)])),
])
FORUM_SCHEMA = T.StructType([
    T.StructField("subs", T.MapType(_S, _B)), T.StructField("num_posts", _L),
])
CONFIG_SCHEMA = T.StructType([
    T.StructField("backup", _S), T.StructField("sources", T.ArrayType(FEED_SCHEMA)),
    T.StructField("rules", RULES_SCHEMA), T.StructField("reddit", FORUM_SCHEMA),
])
# Saved progress: collector name -> {is_over, data}.
STATE_FILE_TYPE = "MAP<STRING, STRUCT<is_over: BOOLEAN, data: STRUCT<url: STRING, page: BIGINT, posts: BIGINT>>>"

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", _L), T.StructField("ts", _TS), T.StructField("user_id", _L),
    T.StructField("event_type", _S), T.StructField("value", T.DoubleType()), T.StructField("props", _S),
])
