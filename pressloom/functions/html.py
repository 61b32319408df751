"""Article fields from raw html (K1-K4), as native regex column expressions.

A full html parser per row is not used: each field has a documented,
deterministic regex definition that Java regex and RE2 evaluate alike (no
look-around, no backreferences). Scripts, styles and comments are removed
first, since script text may contain markup such as ``"</p>"``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.selectors import attr, clean_pieces, element_spans, inside, let, literal_part, tag_list
from pressloom.functions.text import check_strings, decode_entities, py_strip, value_or_none

# Fixed patterns of the extraction rules.
TITLE_RE = r"(?is)<title[^>]*>(.*?)</title>"
NOISE_RE = r"(?is)<script.*?</script>|<style.*?</style>|<!--.*?-->|<nav.*?</nav>|<footer.*?</footer>"
ARTICLE_RE = r"(?is)<article[^>]*>(.*)</article>"
BODY_RE = r"(?is)<body[^>]*>(.*)</body>"
BLOCK_END_RE = r"(?i)</p>|<p\b[^>]*>|<br\s*/?>|</h[1-6]>|</li>|</div>"
TAG_RE = r"(?s)<[^>]*>"
BLANK_LINES_RE = "[ \t]*\n[\n \t]*"
HTML_TAG_RE = r"(?is)<html\b[^>]*>"
IMG_TAG_RE = r"(?is)<img\b[^>]*>"
VIDEO_TAG_RE = r"(?is)<(?:video|iframe|embed|source)\b[^>]*>"
META_TAG_RE = r"(?is)<meta[^>]*>"
DATE_RE = r"^\s*([0-9]{4}-[0-9]{2}-[0-9]{2})(?:[T ]([0-9]{2}:[0-9]{2}(?::[0-9]{2})?))?"


# Which meta tag feeds which field.
META_DESCRIPTION = ("name", "description")
META_KEYWORDS = ("name", "keywords")
META_GENERATOR = ("name", "generator")
META_AUTHOR = ("name", "author")
META_SECTION = ("property", "article:section")
META_PUBLISHED = ("property", "article:published_time")


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def title_tag_text(html) -> Column:
    """Inner text of the first ``<title>``, entities decoded ('' when absent)."""
    return decode_entities(F.regexp_extract(_c(html), TITLE_RE, 1))


def page_title(html) -> Column:
    """K1: the stripped ``<title>`` text."""
    return py_strip(title_tag_text(html))


def page_text(html) -> Column:
    """K2: visible text of the main block, block ends as newlines (before newline removal)."""
    clean = F.regexp_replace(_c(html), NOISE_RE, "")
    art = F.regexp_extract(clean, ARTICLE_RE, 1)
    body = F.regexp_extract(clean, BODY_RE, 1)
    main = F.when(art != "", art).when(body != "", body).otherwise(clean)
    t = F.regexp_replace(main, BLOCK_END_RE, "\n")
    t = F.regexp_replace(t, TAG_RE, "")
    t = F.regexp_replace(t, BLANK_LINES_RE, "\n")
    return decode_entities(t)


def meta_tags(html) -> Column:
    """Per ``<meta ...>`` tag of the page, in order, ``(name, property, content)``, the first two in lower case (one pass over the html)."""
    tags = F.regexp_extract_all(_c(html), F.lit(META_TAG_RE), F.lit(0))
    return F.transform(tags, lambda t: F.struct(F.lower(attr(t, "name")).alias("name"), F.lower(attr(t, "property")).alias("property"),
                                                attr(t, "content").alias("content")))


def _named(metas: Column, spec: tuple[str, str]) -> Column:
    """Contents of the meta tags whose attribute has the given value, in order; tags without content are left out."""
    name, value = spec
    kept = F.filter(metas, lambda t: F.coalesce(t[name] == value, F.lit(False)) & t.content.isNotNull())
    return F.transform(kept, lambda t: t.content)


def _first(metas: Column, spec: tuple[str, str]) -> Column:
    """Content of the first meta tag of that name, or null when there is none. Attributes may stand in any order and quotes."""
    return F.try_element_at(_named(metas, spec), F.lit(1))


def _publish_date(metas: Column) -> Column:
    raw = F.coalesce(_first(metas, META_PUBLISHED), F.lit(""))
    day = F.regexp_extract(raw, DATE_RE, 1)
    clock = F.regexp_extract(raw, DATE_RE, 2)
    txt = F.when(day != "", F.concat(day, F.when(clock != "", F.concat(F.lit(" "), clock)).otherwise(F.lit(""))))
    return txt.try_cast("timestamp_ntz")


#: K3: field -> how it is made of the page's meta tags; description is '' when absent, like the parser's default
_META_FIELDS = {
    "description": lambda m: F.coalesce(_first(m, META_DESCRIPTION), F.lit("")),
    "keywords": lambda m: check_strings(F.split(F.coalesce(_first(m, META_KEYWORDS), F.lit("")), ",", -1)),
    "section": lambda m: _first(m, META_SECTION),
    "generator": lambda m: value_or_none(_first(m, META_GENERATOR)),
    "publish_date": _publish_date,
    "authors": lambda m: F.array_distinct(check_strings(_named(m, META_AUTHOR))),
}


def meta_fields(html) -> Column:
    """K3: struct of all meta fields; the page's meta tags are read once."""
    return let(meta_tags(html), lambda metas: F.struct(*(make(metas).alias(n) for n, make in _META_FIELDS.items())))


def page_lang(html) -> Column:
    """``<html lang>``: first two letters, lower case, when they are letters; else null."""
    two = F.substring(F.coalesce(attr(F.regexp_extract(_c(html), HTML_TAG_RE, 0), "lang"), F.lit("")), 1, 2)
    return F.when(two.rlike("^[A-Za-z]{2}$"), F.lower(two))


def _sources(html, tag_pattern: str) -> Column:
    tags = F.regexp_extract_all(_c(html), F.lit(tag_pattern), F.lit(0))
    return F.array_sort(F.array_distinct(check_strings(F.transform(tags, lambda t: attr(t, "src")))))


def page_images(html) -> Column:
    """K4: image sources, distinct, sorted."""
    return _sources(html, IMG_TAG_RE)


def page_videos(html) -> Column:
    return _sources(html, VIDEO_TAG_RE)


def archive_original_url(html) -> tuple[Column, Column]:
    """Original url of an archive page = ``value`` of the first ``input`` in the
    first table under ``#HEADER``, whatever stands before the table; inputs elsewhere
    don't count. Returns ``(url, error_type)``: no such input -> ``TypeError``; no
    value attribute -> ``KeyError``; empty value -> ``ArchivedURLNotFound``; else
    error null.
    """
    def first_input(tags: Column) -> Column:
        first = lambda inner, part: F.try_element_at(element_spans(inner, literal_part(part)), F.lit(1))
        table = lambda inner: let(first(inner, "table"), lambda s: F.when(s.isNotNull(), inside(inner, s)))
        header = let(first(tags, "#HEADER"), lambda s: F.when(s.isNotNull(), table(inside(tags, s))))
        return F.try_element_at(F.filter(header, lambda t: t.n == "input"), F.lit(1))

    tag = let(tag_list(clean_pieces(_c(html)), ("id",), "input value"), first_input)
    value = tag.h
    err = (F.when(tag.isNull(), F.lit("TypeError")).when(value.isNull(), F.lit("KeyError"))
           .when(value == "", F.lit("ArchivedURLNotFound")))
    return F.when(err.isNull(), value), err
