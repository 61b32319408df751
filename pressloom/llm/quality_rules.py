"""Quality rules with risk-controlled thresholds (operator 8).

Each rule rejects a text whose measure exceeds a cutoff. Cutoffs come from a
labelled holdout: for every stratum, rule and candidate cutoff, the exact
binomial tail tests whether the rate of good texts that the cutoff would reject
is below ``RISK``. Of all these tests together at most a share ``ERROR`` may be
wrong (Bonferroni), so all certified cutoffs hold at once. Among the certified
cutoffs of a rule the one of the best gain on the holdout is taken; without one
the rule rejects nothing in that stratum.

DataFrame functions only. Measures take no shuffle; the holdout is reduced to one
row per stratum, rule and candidate before anything is gathered.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pressloom.llm.common import SPACES, bounded, stage, table

RISK = 0.01  # certified rate of good texts that a rule may reject, per stratum
ERROR = 0.05  # chance that any of the certified cutoffs doesn't hold
GOOD_LOST = 20  # bad texts that a cutoff must catch for each good text it rejects
MAX_STRATA_BROADCAST = 100_000
#: candidate cutoffs of every measure (per thousand); fixed beforehand, as the tests ask for
CUTOFFS = [0, 5, 20, 50, 100, 150, 200, 300, 400, 500, 700]
MIN_WORDS = 50
SYMBOLS = "#*$%&|<>"
_DROP_SPACES = " \t\n\x0b\x0c\r"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once a row, also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null gives none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACES + "+"), lambda w: w != "")


def _covered(hashes: Column) -> Column:
    """Number of words in three-word windows that occur twice or more; the windows' hashes are sorted with their places."""
    def places(pairs: Column) -> Column:
        same = lambda p, j: (p.h == F.get(pairs, j - 1).h) | (p.h == F.get(pairs, j + 1).h)
        twice = F.filter(pairs, lambda p, j: F.coalesce(same(p, j), F.lit(False)))
        return F.size(F.array_distinct(F.flatten(F.transform(twice, lambda p: F.array(p.i, p.i + 1, p.i + 2)))))

    return _let(F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i")))), places)


def repeat_words(words: Column) -> Column:
    """Words that lie in a three-word window found twice or more in the text, the first one included."""
    windows = F.transform(F.arrays_zip(words.alias("a"), F.slice(words, 2, 1 << 30).alias("b"), F.slice(words, 3, 1 << 30).alias("c")),
                          lambda w: F.xxhash64(w.a, w.b, w.c))
    hashes = F.when(F.size(words) >= 3, F.slice(windows, 1, F.size(words) - 2)).otherwise(F.array().cast("array<bigint>"))
    return _let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(_covered(h)))


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def measures(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """The columns ``keep`` and the counts of each whole text. No shuffle.

    n_words, word_chars (code points in words), n_symbols, n_lines and n_dup_lines
    (lines with a word; those equal to an earlier one), n_repeat_words, n_marks
    (exclamation and question marks). Null and empty texts count 0 of everything.
    """
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counts = _let(words_of(F.col(text)), lambda w: F.struct(F.size(w).alias("n"), repeat_words(w).alias("r")))
    counted = docs.select(
        *keep, counts.alias("_w"),
        F.length(F.translate(t, _DROP_SPACES, "")).alias("_chars"), _count(t, SYMBOLS).alias("_symbols"), _count(t, "!?").alias("_marks"),
        _let(lines, lambda x: F.struct(F.size(x).alias("n"), (F.size(x) - F.size(F.array_distinct(x))).alias("d"))).alias("_l"))
    made = {"n_words": "_w.n", "word_chars": "_chars", "n_symbols": "_symbols", "n_lines": "_l.n", "n_dup_lines": "_l.d",
            "n_repeat_words": "_w.r", "n_marks": "_marks"}
    return counted.select(*keep, *(F.col(c).cast("bigint").alias(name) for name, c in made.items()))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _per_thousand(part: str, whole: str) -> Column:
    return F.coalesce(F.floor(1000 * F.col(part) / F.nullif(F.col(whole), F.lit(0))), F.lit(0)).cast("bigint")


def rule_values() -> dict[str, Column]:
    """Measure of each rule, in thousandths; a text exceeds a cutoff or doesn't."""
    return {"symbols": _per_thousand("n_symbols", "n_words"), "dup_lines": _per_thousand("n_dup_lines", "n_lines"),
            "repeats": _per_thousand("n_repeat_words", "n_words"), "marks": _per_thousand("n_marks", "n_words")}


def max_false(n: Column, tests: Column) -> Column:
    """The most rejected good texts of n for which the binomial tail P(X <= k | n, RISK) is at most ERROR / tests; else -1.

    The sum runs over at most n * RISK + 1 terms: beyond the mean the tail is over a half.
    """
    odds = math.log(RISK) - math.log1p(-RISK)
    start = F.struct((n * math.log1p(-RISK)).alias("lp"), F.lit(0.0).alias("p"), F.lit(-1).cast("bigint").alias("k"))

    def step(s: Column, i: Column) -> Column:
        p = s.p + F.exp(s.lp)
        return F.struct((s.lp + F.log((n - i) / (i + 1)) + odds).alias("lp"), p.alias("p"),
                        F.when(p <= ERROR / tests, i).otherwise(s.k).alias("k"))

    return F.aggregate(F.sequence(F.lit(0).cast("bigint"), F.floor(n * RISK).cast("bigint")), start, step, lambda s: s.k)


def choose_cutoffs(counted: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """(stratum, rule, cutoff, n_good, false_rejections) of the certified cutoffs that gain most on the holdout.

    ``labels`` has (doc_id, quality): 1 is good, 0 is bad. Null labels and labels of
    no document take no part; of several labels of a document the smallest counts.
    Texts that fail the base rules are no part of the holdout, as no cutoff decides
    about them. A null stratum is a stratum. Empty labels give no cutoffs.
    """
    judged = (labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("quality"))
              .join(counted.where(~base_failed()), "doc_id"))
    rules = rule_values()
    values = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), v.alias("value")) for r, v in rules.items()))).alias("x")
    level = F.size(F.filter(F.array(*map(F.lit, CUTOFFS)), lambda c: c < F.col("x.value")))  # cutoffs that the value exceeds
    held = (judged.select(F.col(stratum).alias("stratum"), "quality", values).groupBy("stratum", "x.rule", level.alias("level"))
            .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad")))
    # from here on at most (cutoffs + 1) rows for each stratum and rule
    group = Window.partitionBy("stratum", "rule")
    spread = (held.groupBy("stratum", "rule").agg(F.collect_list(F.struct("level", "good", "bad")).alias("h"))
              .withColumn("n_good", F.aggregate("h", F.lit(0).cast("bigint"), lambda a, x: a + x.good))
              .select("stratum", "rule", "n_good", "h", F.posexplode(F.array(*map(F.lit, CUTOFFS))).alias("at", "cutoff")))
    over = lambda part: F.aggregate(F.filter("h", lambda x: x.level > F.col("at")), F.lit(0).cast("bigint"), lambda a, x: a + x[part])
    tested = spread.select("stratum", "rule", "cutoff", "n_good", over("good").alias("false_rejections"), over("bad").alias("caught"))
    strata = held.select("stratum").distinct().agg(F.count(F.lit(1)).alias("strata"))  # one row
    certified = (tested.crossJoin(F.broadcast(strata))  # with that single row
                 .where(F.col("false_rejections") <= max_false(F.col("n_good"), F.col("strata") * len(rules) * len(CUTOFFS)))
                 .withColumn("gain", F.col("caught") - GOOD_LOST * F.col("false_rejections")).where("gain > 0"))
    best = F.row_number().over(group.orderBy(F.desc("gain"), F.desc("cutoff")))
    return certified.withColumn("_best", best).where("_best = 1").select("stratum", "rule", "cutoff", "n_good", "false_rejections")


def judge(counted: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """``counted`` with base_failed and kept. Rows, repeats and null ids are all kept as rows."""
    wide = (cutoffs.groupBy(F.col("stratum").alias("_stratum"))
            .agg(*(F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_c_{r}") for r in rule_values())))
    joined = counted.join(bounded(wide, MAX_STRATA_BROADCAST), F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    over = F.lit(False)
    for r, v in rule_values().items():
        over = over | F.coalesce(v > F.col(f"_c_{r}"), F.lit(False))
    out = joined.select(*(F.col(c) for c in counted.columns), base_failed().alias("base_failed"), over.alias("_over"))
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("_over")).drop("_over")


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """Counts and verdict of every row of ``docs`` (doc_id, text and the stratum are used).

    The counts are staged once, narrow, for the holdout and the verdict.
    """
    counted = stage(measures(docs, keep=("doc_id", stratum)), "quality-measures")
    return judge(counted, choose_cutoffs(counted, labels, stratum), stratum)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = apply_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


MEASURES_SQL = r"""
w as (select doc_id, lang, coalesce(text, '') as t,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents),
g as (select doc_id, unnest(generate_series(1, len(words) - 2)) as i, words from w where len(words) >= 3),
g2 as (select doc_id, i, count(*) over (partition by doc_id, words[i], words[i + 1], words[i + 2]) as c from g),
rep as (select doc_id, count(distinct j) as n from (select doc_id, unnest([i, i + 1, i + 2]) as j from g2 where c > 1) group by doc_id),
m as (select w.doc_id, lang, len(words) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) as n_symbols, len(lines) as n_lines, len(lines) - len(list_distinct(lines)) as n_dup_lines,
    coalesce(rep.n, 0) as n_repeat_words, length(regexp_replace(t, '[^!?]', '', 'g')) as n_marks
  from w left join rep using (doc_id)),
mb as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
    coalesce(cast(floor(1000 * n_symbols / nullif(n_words, 0)) as bigint), 0) as symbols,
    coalesce(cast(floor(1000 * n_dup_lines / nullif(n_lines, 0)) as bigint), 0) as dup_lines,
    coalesce(cast(floor(1000 * n_repeat_words / nullif(n_words, 0)) as bigint), 0) as repeats,
    coalesce(cast(floor(1000 * n_marks / nullif(n_words, 0)) as bigint), 0) as marks from m)
"""

OP8_SQL = f"""
with {MEASURES_SQL},
lab as (select doc_id, min(quality) as quality from labels where quality in (0, 1) and doc_id is not null group by doc_id),
vals as (unpivot (select lang, quality, symbols, dup_lines, repeats, marks from mb join lab using (doc_id) where not base_failed)
  on symbols, dup_lines, repeats, marks into name rule value value),
cand as (select unnest({CUTOFFS}) as cutoff),
tests as (select lang, rule, cutoff, sum(quality) as n_good, sum(case when value > cutoff then quality else 0 end) as k,
    sum(case when value > cutoff then 1 - quality else 0 end) as caught from vals, cand group by all),
s as (select count(*) as strata from (select distinct lang from vals)),
certified as (select *, caught - {GOOD_LOST} * k as gain from tests, s
  where k <= n_good * {RISK} and {ERROR} / (strata * 4 * {len(CUTOFFS)}) >= (
    select sum(exp(lgamma(n_good + 1) - lgamma(i + 1) - lgamma(n_good - i + 1) + i * ln({RISK}) + (n_good - i) * ln(1 - {RISK})))
    from (select unnest(generate_series(0, cast(k as bigint))) as i))),
best as (select lang, rule, cutoff from certified where gain > 0
  qualify row_number() over (partition by lang, rule order by gain desc, cutoff desc) = 1),
over as (select distinct mb.doc_id from mb join best b on mb.lang is not distinct from b.lang and
  case b.rule when 'symbols' then symbols when 'dup_lines' then dup_lines when 'repeats' then repeats else marks end > b.cutoff)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and over.doc_id is null as kept
from mb left join over using (doc_id)
"""

QUERIES = {"op8_quality_rules": op8_quality_rules}
ORACLES = {"op8_quality_rules": OP8_SQL}
