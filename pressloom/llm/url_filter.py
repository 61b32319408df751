"""URL filter (operator 5): rules, then a list of URLs behind a blocked Bloom filter.

Listed canonical URLs set bits in a blocked Bloom filter that is itself a table:
one row of eight 64-bit words per block. A URL probes one block. URLs whose bits
are all set go on to an exact hash join with the list, which removes the false
positives; the others are certainly not listed and skip that join.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import bounded, table

WORDS = 8  # 64-bit words of a block; each URL sets one bit in each
BITS_PER_URL = 16
#: largest frames that are broadcast: 9 longs a block, one digest-sized key a URL
MAX_BLOCKS_BROADCAST = 200_000
MAX_LISTED_BROADCAST = 100_000
TRACKING = r"^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$"
#: (verdict, host, path) of the registered query
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
         ("allow", "com", "/fr/"), ("block", "com", "/de/")]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; '' without ``://``."""
    raw = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(raw, _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """Host without ``www.`` and default port, path without closing slashes, sorted parameters that aren't tracking.

    Scheme and fragment are dropped. Null for URLs without a host.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r":(80|443)$", ""), r"^www\.", "")
    path = F.regexp_replace(path_of(url), r"/+$", "")
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(TRACKING)))
    return F.when(host != "", F.concat(host, path, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise("")))


def rule_verdict(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """The longest fitting rule as struct(length, rule, verdict); null if none fits. Few rules: they are literals."""
    fits = [F.when(((host == h) | host.endswith("." + h)) & path.startswith(p),
                   F.struct(F.lit(len(h + p)).alias("length"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")))
            for v, h, p in rules]
    return fits[0] if len(fits) == 1 else F.greatest(*fits)


def _block(url: str, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(F.col(url)), F.lit(n_blocks))


def _mask(url: str, word: int) -> Column:
    """The word of a block with the bit of the URL: six bits of a second hash for each word."""
    return F.expr(f"shiftleft(1L, cast(shiftright(xxhash64({url}, 1L), {6 * word}) & 63 as int))")


def bloom_blocks(listed: DataFrame, url: str, n_blocks: int) -> DataFrame:
    """The filter as rows (block, w0 .. w7); the words are combined before the shuffle."""
    return listed.groupBy(_block(url, n_blocks).alias("_block")).agg(
        *(F.bit_or(_mask(url, i)).alias(f"_w{i}") for i in range(WORDS)))


def listed_urls(pages: DataFrame, listed: DataFrame, key: str = "canonical", out: str = "is_listed") -> DataFrame:
    """``pages`` with ``out`` (boolean): whether ``key`` is among the URLs of ``listed`` (column ``key``).

    Null keys are not listed; null and repeated URLs of the list count for nothing.
    An empty list lists nothing. Rows of ``pages`` are kept as they are, repeats too.
    """
    keys = listed.select(F.col(key).alias("_listed")).where(F.col("_listed").isNotNull()).distinct()
    n = keys.count()
    n_blocks = max(1, -(-n * BITS_PER_URL // (64 * WORDS)))
    blocks = bloom_blocks(keys, "_listed", n_blocks)
    probed = pages.withColumn("_probe", _block(key, n_blocks)).join(
        bounded(blocks, MAX_BLOCKS_BROADCAST), F.col("_probe") == F.col("_block"), "left")
    hit = reduce(Column.__and__, (F.col(f"_w{i}").bitwiseAND(_mask(key, i)) != 0 for i in range(WORDS)))
    probed = probed.withColumn("_hit", F.coalesce(hit & F.col(key).isNotNull(), F.lit(False)))
    helpers = ["_probe", "_block", "_hit", *(f"_w{i}" for i in range(WORDS))]
    exact = keys if n > MAX_LISTED_BROADCAST else F.broadcast(keys)
    hits = (probed.where("_hit").drop(*helpers).join(exact, F.col(key) == F.col("_listed"), "left")
            .withColumn(out, F.col("_listed").isNotNull()).drop("_listed"))
    return hits.unionByName(probed.where(~F.col("_hit")).drop(*helpers).withColumn(out, F.lit(False)))


def filter_urls(pages: DataFrame, listed: DataFrame, rules: list[tuple[str, str, str]], url: str = "url") -> DataFrame:
    """``pages`` with host, path, canonical, rule, is_listed and verdict of each URL.

    The longest fitting rule decides; without one, a listed URL is blocked and any
    other allowed. Existing columns of these names are replaced. A null URL, or one
    without ``://``, has an empty host and path, no canonical form, and is allowed.
    """
    made = ("host", "path", "canonical", "rule", "is_listed", "verdict")
    address = F.col("_url")
    base = pages.withColumn("_url", F.col(url))
    base = base.drop(*(c for c in base.columns if c.lower() in made)).select(
        "*", host_of(address).alias("host"), path_of(address).alias("path"), canonical(address).alias("canonical")).drop("_url")
    judged = listed_urls(base, listed).withColumn("_rule", rule_verdict(F.col("host"), F.col("path"), rules))
    by_list = F.when(F.col("is_listed"), "block").otherwise("allow")
    return judged.withColumns({"rule": F.col("_rule.rule"), "verdict": F.coalesce(F.col("_rule.verdict"), by_list)}).drop("_rule")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page url. Listed: the canonical URLs that two or more pages carry (crawled more than once)."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    repeated = (pages.select(canonical(F.col("url")).alias("canonical")).where(F.col("canonical").isNotNull())
                .groupBy("canonical").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("canonical"))
    return filter_urls(pages, repeated, RULES).select("page_id", "host", "path", "rule", "verdict", "is_listed")


OP5_SQL = r"""
with u as (
  select page_id, url,
    coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
    list_sort(list_filter(string_split(regexp_extract(url, '(?s)^[^?#]*\?([^#]*)', 1), '&'),
      lambda p: p <> '' and not regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid)(=.*)?$'))) as params
  from pages),
c as (
  select *, case when host <> '' then
      regexp_replace(regexp_replace(host, ':(80|443)$', ''), '^www\.', '') || regexp_replace(path, '/+$', '')
      || case when len(params) > 0 then '?' || array_to_string(params, '&') else '' end end as canonical
  from u),
r(verdict, rhost, rpath) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
  ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
listed as (select canonical from c where canonical is not null group by canonical having count(*) > 1)
select c.page_id, c.host, c.path,
  (select rhost || rpath from r where (c.host = rhost or ends_with(c.host, '.' || rhost)) and starts_with(c.path, rpath)
   order by length(rhost || rpath) desc limit 1) as rule,
  coalesce((select r.verdict from r where (c.host = rhost or ends_with(c.host, '.' || rhost)) and starts_with(c.path, rpath)
   order by length(rhost || rpath) desc limit 1), case when l.canonical is not null then 'block' else 'allow' end) as verdict,
  l.canonical is not null as is_listed
from c left join listed l on c.canonical = l.canonical
"""

QUERIES = {"op5_url_filter": op5_url_filter}
ORACLES = {"op5_url_filter": OP5_SQL}
