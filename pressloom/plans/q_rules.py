"""Queries for rules and error cleanup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.functions.urls import maintain_path, site_key
from pressloom.operators import errors as er
from pressloom.operators.rules import Rules
from pressloom.plans import oracle as o
from pressloom.plans.registry import register
from pressloom.sources.fixtures import Views

# Rule configuration used by the rule queries (ours; the reference's values are not known).
RULES_CONF = {
    "blacklist": {"titles": [" title 1 ", "Page not found"], "urls": ["http://dup.example.org/p/0", "https://a.example.org/x"]},
    "min_length": {"title": 10, "text": 5000, "path_loc": 8},
    "ignored_section": {"x": 1},
}
ART_COLS = "batch_id, seq, title, url, visited_url, fake"


def _arts(v: Views) -> DataFrame:
    return v.art.withColumn("path", maintain_path("url"))


def _sel(df: DataFrame) -> DataFrame:
    return df.select("batch_id", "seq", "title", "url", "visited_url", "fake")


def _in(vals) -> str:
    return ", ".join(o.lit(v) for v in vals)


BL = RULES_CONF["blacklist"]
ML = RULES_CONF["min_length"]
TITLE_BL = f"coalesce(title NOT IN ({_in(BL['titles'])}), true)"
URL_BL = f"coalesce(url NOT IN ({_in(BL['urls'])}), true)"
TITLE_ML = f"coalesce(length(title) >= {ML['title']}, false)"
TEXT_ML = f"coalesce(length(text) >= {ML['text']}, false)"
PATH_ML = f"coalesce(length({o.maintain_path('url')}) >= {ML['path_loc']}, false)"


def _rule_query(key: str, cond: str, build):
    @register(key, o.with_views(f"SELECT {ART_COLS} FROM art WHERE {cond}", "art"))
    def q(spark: SparkSession, sf: str) -> DataFrame:
        return _sel(build(Rules()).apply(_arts(Views(spark, sf))))

    return q


_rule_query("title_blacklist", TITLE_BL, lambda r: r.add_blacklist("title", BL["titles"]))
_rule_query("url_blacklist", URL_BL, lambda r: r.add_blacklist("url", BL["urls"]))
_rule_query("min_title_length", TITLE_ML, lambda r: r.add_min_length("title", ML["title"]))
_rule_query("min_text_length", TEXT_ML, lambda r: r.add_min_length("text", ML["text"]))
_rule_query("min_path_length", PATH_ML, lambda r: r.add_min_length("path", ML["path_loc"]))


@register("apply_rules", o.with_views(
    f"SELECT {ART_COLS} FROM art WHERE {TITLE_BL} AND {URL_BL} AND {TITLE_ML} AND {TEXT_ML} AND {PATH_ML}", "art"))
def q_apply_rules(spark: SparkSession, sf: str) -> DataFrame:
    return _sel(Rules.from_config(RULES_CONF).apply(_arts(Views(spark, sf))))


@register("custom_checks", o.with_views(
    f"SELECT {ART_COLS} FROM art WHERE NOT starts_with(title, ' ') AND (fake OR length(url) > 30) "
    f"AND NOT contains(text, 'Lorem')", "art"))
def q_custom_checks(spark: SparkSession, sf: str) -> DataFrame:
    r = (Rules().add_title(lambda t: ~t.startswith(" "))
         .add(F.col("fake") | (F.length("url") > 30))
         .add_text(lambda t: ~t.contains("Lorem")))
    return _sel(r.apply(_arts(Views(spark, sf))))


@register("custom_url_checker", o.with_views(
    f"SELECT batch_id, seq, url, fake FROM lnk WHERE coalesce(ends_with({o.site_key('url')}, '.org') AND NOT fake, false)",
    "lnk"))
def q_custom_url_checker(spark: SparkSession, sf: str) -> DataFrame:
    r = Rules(url_check=lambda url, fake, archived: F.coalesce(site_key(url).endswith(".org") & ~fake & ~archived,
                                                               F.lit(False)))
    return r.admit(Views(spark, sf).lnk).select("batch_id", "seq", "url", "fake")


# ---- error cleanup on the err view; articles = the art view ----

E5_SQL = "SELECT * FROM err a WHERE NOT EXISTS (SELECT 1 FROM err b WHERE a.creation_date < b.creation_date AND a.url = b.url)"
E4_BODY = "NOT EXISTS (SELECT 1 FROM art a WHERE e.url = a.url OR e.url = a.visited_url)"


@register("delete_superseded_errors", o.with_views(E5_SQL, "err"))
def q_e5(spark: SparkSession, sf: str) -> DataFrame:
    return er.delete_superseded_errors(Views(spark, sf).err)


@register("delete_resolved_errors", o.with_views(f"SELECT * FROM err e WHERE {E4_BODY}", "err", "art"))
def q_e4(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    return er.delete_resolved_errors(v.err, v.art)


@register("delete_restored_errors", o.with_views(
    "SELECT * FROM err e WHERE NOT EXISTS (SELECT 1 FROM art a WHERE a.url = e.url)", "err", "art"))
def q_e6(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    return er.delete_restored_errors(v.err, v.art.select("url"))


@register("cleanup_errors", o.with_views(f"SELECT * FROM ({E5_SQL}) e WHERE {E4_BODY}", "err", "art"))
def q_p4(spark: SparkSession, sf: str) -> DataFrame:
    v = Views(spark, sf)
    return er.cleanup_errors(v.err, v.art)
