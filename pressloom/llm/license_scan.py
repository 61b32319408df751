"""License scan (operator 4): canonical digests of entire texts, joined to those of known licence texts.

A text is brought to a canonical form (case, punctuation, copyright lines,
equivalent spellings, spaces), and the SHA-256 of that form is looked up by a
hash join among the digests of the known texts. Only entire texts match: the
whole document, each whole line of it (a notice is a line of its own), and runs of
as many consecutive paragraphs, or lines, as a known text has (a licence inside a longer file).
Comment signs are punctuation, so headers in comments match as well. Each text is read
and brought to its form once.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pressloom.llm.common import bounded, table
from pressloom.llm.licences import KNOWN

#: known digests are broadcast up to this number (a digest, two lengths and an id each)
MAX_KNOWN_BROADCAST = 50_000
#: equivalent spellings: (pattern over the canonical alphabet, what replaces it)
SPELLINGS = [("licence", "license"), ("licenced", "licensed"), ("acknowledgement", "acknowledgment"), ("favour", "favor"),
             ("merchantibility", "merchantability"), ("organisation", "organization"), ("whilst", "while"), ("sub license", "sublicense"),
             ("per cent", "percent"), ("non commercial", "noncommercial"), ("https", "http")]
#: a line that states a copyright (with a sign, a year, a colon or by whom), as licences wrap to lines that begin with the mere word; used with flag m,
#: and \n as the only line end
COPYRIGHT_LINE = r"^[^\p{L}\p{N}\n(©]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|:|by[ \t]|the[ \t][^\n]*authors)|\(c\)[ \t]*(?:copyright|[0-9]{4})|©)[^\n]*$"


def canonical_lines(text: Column) -> Column:
    """Canonical form of a text with its line breaks; null counts as ''.

    Lower case; lines that state a copyright emptied; every run
    of characters that are neither letters nor digits becomes one space; then the
    equivalent spellings, on word bounds (of two words also over one line break).
    """
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "(?dm)" + COPYRIGHT_LINE, "")
    out = F.regexp_replace(F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " "), r"(?m)^ +| +$", "")
    return reduce(lambda c, s: F.regexp_replace(c, _spelling(s[0]), s[1]), SPELLINGS, out)


def _spelling(words: str) -> str:
    return r"\b" + words.replace(" ", r"[ \n]") + r"\b"


def joined_lines(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, r"\n+", " "))


def lines_of(form: Column) -> Column:
    return F.filter(F.split(form, "\n"), lambda x: x != "")


def paragraphs_of(form: Column) -> Column:
    return F.filter(F.transform(F.split(form, r"\n\n+"), joined_lines), lambda x: x != "")


def digest(canonical: Column) -> Column:
    return F.sha2(canonical.cast("binary"), 256)


def known_forms(known: DataFrame) -> DataFrame:
    """licence, whole canonical text, its lines and its paragraphs; texts with an empty form are left out."""
    form = known.select("licence", canonical_lines(F.col("text")).alias("_form"))
    return form.select("licence", joined_lines(F.col("_form")).alias("_whole"), lines_of(F.col("_form")).alias("_lines"),
                       paragraphs_of(F.col("_form")).alias("_paragraphs")).where(F.col("_whole") != "")


def known_digests(forms: DataFrame) -> DataFrame:
    """(digest, licence): the smallest name of each digest."""
    return forms.groupBy(digest(F.col("_whole")).alias("_digest")).agg(F.min("licence").alias("_licence"))


def run_ends(forms: DataFrame, parts: str) -> dict[int, tuple[list[int], list[int]]]:
    """By number of parts: the hashes of first and of last parts of the known texts, which are a bounded table."""
    rows = forms.select(F.size(parts).alias("n"), F.xxhash64(F.element_at(parts, 1)).alias("first"), F.xxhash64(F.element_at(parts, -1)).alias("last"))
    got: dict[int, tuple[list[int], list[int]]] = {}
    for r in rows.distinct().collect():
        got.setdefault(r.n, ([], []))[0].append(r.first)
        got[r.n][1].append(r.last)
    return got


def begins(parts: str, ends: dict[int, tuple[list[int], list[int]]]) -> Column:
    """0-based places of parts that begin a known text."""
    firsts = sorted({h for f, _ in ends.values() for h in f})
    places = F.transform(parts, lambda x, i: F.when(F.xxhash64(x).isin(firsts), i) if firsts else F.lit(None).cast("int"))
    return F.filter(places, lambda i: i.isNotNull())


def runs(parts: str, at: str, ends: dict[int, tuple[list[int], list[int]]], least: int) -> list[Column]:
    """Runs of as many parts as a known text has, from the places ``at`` to a part that ends one; of ``least`` parts at least."""
    return [F.transform(F.filter(at, lambda i: (i + n <= F.size(parts)) & F.xxhash64(F.get(parts, i + n - 1)).isin(sorted(set(last)))),
                        lambda i: F.array_join(F.slice(F.col(parts), i + 1, n), " "))
            for n, (_, last) in sorted(ends.items()) if n >= least]


def scan_licences(docs: DataFrame, known: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of ``docs``: the key, digest, whole_licence, line_licences and block_licences.

    ``digest``: of the whole canonical text. ``whole_licence``: the known text that
    equals it, else null. ``line_licences``: the known texts that equal a line of
    the document; ``block_licences``: those that equal consecutive paragraphs, or two or more consecutive lines (empty
    ones don't count); each once, in order of name, empty if none. Null and empty texts
    have the digest of '' and match nothing. Rows are scanned each for itself, with one key or a null key too.
    ``known`` (licence, text) is a bounded table: some hashes of each text go into the plan.
    """
    forms = known_forms(known)
    lookup = bounded(known_digests(forms), MAX_KNOWN_BROADCAST)
    line_ends, block_ends = run_ends(forms, "_lines"), run_ends(forms, "_paragraphs")
    form = docs.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), canonical_lines(F.col(text)).alias("_form"))
    parts = form.select("_row", "_key", digest(joined_lines(F.col("_form"))).alias("_digest"),
                        lines_of(F.col("_form")).alias("_lines"), paragraphs_of(F.col("_form")).alias("_paragraphs"))
    found = parts.select("*", begins("_lines", line_ends).alias("_at"), begins("_paragraphs", block_ends).alias("_pat"))
    none = F.array().cast("array<string>")
    line = runs("_lines", "_at", {n: e for n, e in line_ends.items() if n == 1}, 1)
    blocks = runs("_lines", "_at", line_ends, 2) + runs("_paragraphs", "_pat", block_ends, 1)
    piece = lambda kind, d: F.struct(F.lit(kind).alias("kind"), d.alias("digest"))
    pieces = F.concat(F.array(piece(0, F.col("_digest"))),
                      F.transform(F.array_distinct(F.concat(none, *line)), lambda x: piece(1, digest(x))),
                      F.transform(F.array_distinct(F.concat(none, *blocks)), lambda x: piece(2, digest(x))))
    hits = found.select("_row", "_key", F.explode(pieces).alias("_piece")).select("_row", "_key", "_piece.*") \
        .join(lookup, F.col("digest") == F.col("_digest"), "left")
    of = lambda kind, c: F.when(F.col("kind") == kind, F.col(c))
    names = lambda kind: F.array_sort(F.collect_set(of(kind, "_licence")))  # noqa: E731  (of known names: bounded)
    return hits.groupBy("_row").agg(F.first("_key").alias(key), F.max(of(0, "digest")).alias("digest"), F.max(of(0, "_licence")).alias("whole_licence"),
                                    names(1).alias("line_licences"), names(2).alias("block_licences")).drop("_row")


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = spark.createDataFrame(KNOWN, "licence string, text string")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licences(docs, known).select("doc_id", "digest", "whole_licence", F.array_join("line_licences", ",").alias("line_licences"),
                                             F.array_join("block_licences", ",").alias("block_licences"))


def _sql_form(expr: str) -> str:
    out = f"regexp_replace(lower(coalesce({expr}, '')), '(?m){COPYRIGHT_LINE}', '', 'g')"
    out = f"regexp_replace({out}, '{r'[^\p{L}\p{N}\n]+'}', ' ', 'g')"
    out = f"regexp_replace({out}, '(?m)^ +| +$', '', 'g')"
    for a, b in SPELLINGS:
        out = f"regexp_replace({out}, '{_spelling(a)}', '{b}', 'g')"
    return out


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_SQL_WHOLE = r"trim(regexp_replace(f, '\n+', ' ', 'g'))"
_SQL_LINES = "list_filter(string_split(f, chr(10)), lambda x: x <> '')"
_SQL_PARTS = r"list_filter(list_transform(string_split_regex(f, '\n\n+'), lambda x: trim(regexp_replace(x, '\n+', ' ', 'g'))), lambda x: x <> '')"

OP4_SQL = f"""
with known(licence, body) as (values {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in KNOWN)}),
kf as (select licence, {_SQL_WHOLE} as whole, {_SQL_LINES} as ls, {_SQL_PARTS} as ps
  from (select licence, {_sql_form('body')} as f from known)),
k as (select sha256(whole) as d, min(licence) as licence from kf where whole <> '' group by 1),
nl as (select distinct len(ls) as n from kf where len(ls) >= 2), np as (select distinct len(ps) as n from kf where len(ps) >= 1),
d as materialized (select doc_id, sha256({_SQL_WHOLE}) as digest, {_SQL_LINES} as ls, {_SQL_PARTS} as ps
  from (select doc_id, {_sql_form('text')} as f from documents)),
lines as (select distinct doc_id, unnest(ls) as piece from d),
pieces as (select doc_id, array_to_string(ls[i : i + n - 1], ' ') as piece
    from (select doc_id, ls, n, unnest(generate_series(1, len(ls) - n + 1)) as i from d cross join nl)
  union all select doc_id, array_to_string(ps[i : i + n - 1], ' ')
    from (select doc_id, ps, n, unnest(generate_series(1, len(ps) - n + 1)) as i from d cross join np)),
in_lines as (select doc_id, string_agg(distinct licence, ',' order by licence) as names from lines join k on sha256(piece) = k.d group by doc_id),
in_blocks as (select doc_id, string_agg(distinct licence, ',' order by licence) as names from pieces join k on sha256(piece) = k.d group by doc_id)
select d.doc_id, digest, k.licence as whole_licence, coalesce(l.names, '') as line_licences, coalesce(b.names, '') as block_licences
from d left join k on d.digest = k.d left join in_lines l using (doc_id) left join in_blocks b using (doc_id)
"""

QUERIES = {"op4_license_scan": op4_license_scan}
ORACLES = {"op4_license_scan": OP4_SQL}
