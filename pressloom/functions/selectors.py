"""Elements and anchors of raw html by a subset of CSS selectors, as native column expressions.

A selector is a part, or a part, a combinator (blank or ``>``) and an anchor part. Parts:
``tag``, ``tag.class``, ``.class``, ``#id``, ``tag#id``; anchor parts: ``a``, ``a.class``,
``a#id``. Anything else raises ``ValueError``. Attribute values may be in double or single
quotes or bare; entities in them are decoded. An element ends at its own end tag, whatever
elements of its name it holds; one that is never closed ends with the page. Elements inside
a matched element are part of it. Scripts, styles and comments are left out.

The markup of a page is read once into a list of tags (``tag_list``); selectors are data
(``selector_rows``) and are matched on that list without looking at the text again, so the plan
doesn't grow with the number of selectors and a page isn't parsed once per selector.
"""

from __future__ import annotations

import json
import re
from typing import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.text import decode_entities

HIDDEN_RE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
TAG_RE = r"(?s)<[^>]*>"
PIECES_RE = r"(?=<[A-Za-z/])"  # before every tag
VOID = ["area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"]
_PART = re.compile(r"^(?P<tag>[a-z][a-z0-9]*)?(?:(?P<kind>[.#])(?P<name>[A-Za-z0-9_-]+))?$")

#: a part (empty: any), a selector with the token that a page must hold to match it
PART_TYPE = "struct<tag:string,cls:string,id:string>"
SELECTOR_TYPE = f"struct<s:string,key:string,inside:boolean,child:boolean,container:{PART_TYPE},anchor:{PART_TYPE}>"


def attr_re(name: str) -> str:
    """Pattern of an attribute in the text of a tag; its value is group 1 (double quotes), 2 (single) or 3 (bare)."""
    return rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""


def attr(tag: Column, name: str) -> Column:
    """Value of an attribute of a tag, entities decoded; null when the tag doesn't have it."""
    p = attr_re(name)
    return F.when(tag.rlike(p), decode_entities(F.concat(*(F.regexp_extract(tag, p, i) for i in (1, 2, 3)))))


def let(value: Column, body) -> Column:
    """``body(value)``, the value computed once also where ``body`` uses it inside lambdas."""
    return F.transform(F.array(value), body)[0]


def parse_part(part: str) -> re.Match:
    m = _PART.match(part.strip())
    if not m or not m.group(0):
        raise ValueError(f"unsupported selector part: {part!r}")
    return m


def parse_selector(selector: str) -> tuple[str | None, bool, str]:
    """``(container or None, whether the anchor must be its child, anchor part)`` of a link selector."""
    parts = re.split(r"\s*>\s*|\s+", selector.strip())
    if len(parts) > 2 or parse_part(parts[-1]).group("tag") != "a":
        raise ValueError(f"unsupported link selector: {selector!r}")
    if len(parts) == 2:
        parse_part(parts[0])
    return (parts[0] if len(parts) == 2 else None), ">" in selector, parts[-1]


def _part(part: str | None) -> dict[str, str]:
    m = parse_part(part) if part else None
    name = lambda kind: m.group("name") if m and m.group("kind") == kind else ""
    return {"tag": (m and m.group("tag")) or "", "cls": name("."), "id": name("#")}


def _key(*parts: dict[str, str]) -> str:
    """The rarest token that a page must hold: an id or class if there is one, else a tag."""
    for p in parts:
        if p["id"] or p["cls"]:
            return f"#{p['id']}" if p["id"] else f".{p['cls']}"
    return parts[0]["tag"]


def _rows(rows: list[dict]) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), f"array<{SELECTOR_TYPE}>")  # one literal, however many


def selector_rows(selectors: Iterable[str]) -> Column:
    """Link selectors as data: an array of ``SELECTOR_TYPE``."""
    rows = []
    for s in selectors:
        container, child, anchor = parse_selector(s)
        c, a = _part(container), _part(anchor)
        rows.append({"s": s, "key": _key(c, a) if container else _key(a), "inside": container is not None, "child": child, "container": c, "anchor": a})
    return _rows(rows)


def element_rows(parts: Iterable[str]) -> Column:
    """Parts that select elements, as data: an array of ``SELECTOR_TYPE`` with the part as container."""
    rows = [{"s": s, "key": _key(_part(s)), "inside": True, "child": False, "container": _part(s), "anchor": _part(None)} for s in parts]
    return _rows(rows)


def _needs(*parts: str | None) -> tuple[str, ...]:
    """The attributes that must be read to match some parts."""
    kinds = {parse_part(p).group("kind") for p in parts if p}
    return tuple(name for kind, name in ((".", "class"), ("#", "id")) if kind in kinds)


def clean_pieces(html: Column) -> Column:
    """The page without scripts, styles and comments, split before every tag."""
    return F.split(F.regexp_replace(F.coalesce(html, F.lit("")), HIDDEN_RE, ""), PIECES_RE)


def tag_list(pieces: Column, need: Iterable[str] = ("class", "id", "href"), extra: str | None = None) -> Column:
    """Per piece (b, e, n, c, i, h): names of the begin and end tag, name if attributes may follow it, classes, id, href of an anchor.

    Attributes that aren't in ``need`` are left empty; ``extra`` = tag name and attribute ("input value") to be read as ``h`` instead.
    """
    need = set(need)
    tag_of, attr_of = extra.split() if extra else ("a", "href")

    def read(p: Column) -> Column:
        tag = F.regexp_extract(p, TAG_RE, 0)
        begins = F.lower(F.regexp_extract(p, r"^<([A-Za-z][A-Za-z0-9]*)", 1))
        full = F.lower(F.regexp_extract(p, r"^<([A-Za-z][A-Za-z0-9]*)(?=[\s/>])", 1))
        classes = F.when(begins != "", F.split(F.coalesce(attr(tag, "class"), F.lit("")), r"\s+")) if "class" in need else F.lit(None).cast("array<string>")
        ident = F.when(begins != "", F.trim(attr(tag, "id"))) if "id" in need else F.lit(None).cast("string")
        href = F.when(full == tag_of, attr(tag, attr_of)) if "href" in need or extra else F.lit(None).cast("string")
        return F.struct(begins.alias("b"), F.lower(F.regexp_extract(p, r"^</([A-Za-z][A-Za-z0-9]*)", 1)).alias("e"), full.alias("n"),
                        classes.alias("c"), ident.alias("i"), href.alias("h"))

    return F.transform(pieces, read)


def _fits(t: Column, part: Column) -> Column:
    """Whether a tag matches a part."""
    return ((t.n != "") & ((part.tag == "") | (t.n == part.tag)) & ((part.cls == "") | F.coalesce(F.array_contains(t.c, part.cls), F.lit(False)))
            & ((part.id == "") | F.coalesce(t.i == part.id, F.lit(False))))


def literal_part(part: str | None) -> Column:
    return F.struct(*(F.lit(v).alias(k) for k, v in _part(part).items()))


def element_spans(tags: Column, part: Column) -> Column:
    """(a, b) of every outermost element that matches ``part``: its begin tag's place in the list and its end tag's."""
    add = lambda s: F.concat(s.spans, F.array(F.struct(s.at.alias("a"), s.i.alias("b"))))

    def step(s: Column, t: Column) -> Column:
        enters = (s.at < 0) & (t.b != "") & ~t.b.isin(VOID) & _fits(t, part)
        depth = s.depth + F.when(t.b == s.tag, 1).otherwise(0) - F.when(t.e == s.tag, 1).otherwise(0)
        leaves = (s.at >= 0) & (depth == 0)
        return F.struct(
            (s.i + 1).alias("i"),
            F.when(enters, s.i).when(leaves, F.lit(-1)).otherwise(s.at).alias("at"),
            F.when(enters, t.b).otherwise(s.tag).alias("tag"),
            F.when(enters, F.lit(1)).when(s.at >= 0, depth).otherwise(F.lit(0)).alias("depth"),
            F.when(leaves, add(s)).otherwise(s.spans).alias("spans"))

    start = F.struct(F.lit(0).alias("i"), F.lit(-1).alias("at"), F.lit("").alias("tag"), F.lit(0).alias("depth"),
                     F.array().cast("array<struct<a:int,b:int>>").alias("spans"))
    return F.aggregate(tags, start, step, lambda s: F.when(s.at >= 0, add(s)).otherwise(s.spans))


def inside(tags: Column, span: Column) -> Column:
    """The tags between the begin and the end tag of an element."""
    return F.slice(tags, span.a + 2, span.b - span.a - 1)


def _children(tags: Column) -> Column:
    """Begin tags of the outermost elements of a list of tags."""
    def step(s: Column, t: Column) -> Column:
        opens, closes = (t.b != "") & ~t.b.isin(VOID), (t.e != "") & ~t.e.isin(VOID)
        return F.struct((s.depth + F.when(opens, 1).otherwise(0) - F.when(closes, 1).otherwise(0)).alias("depth"),
                        F.when((t.b != "") & (s.depth == 0), F.concat(s.found, F.array(t))).otherwise(s.found).alias("found"))

    start = F.struct(F.lit(0).alias("depth"), F.filter(tags, lambda _: F.lit(False)).alias("found"))
    return F.aggregate(tags, start, step, lambda s: s.found)


def anchor_hrefs(tags: Column, selector: Column) -> Column:
    """Hrefs of the anchors that a selector (of ``selector_rows``) matches, in order; an anchor without href gives null."""
    whole = F.array(F.struct(F.lit(-1).alias("a"), F.size(tags).alias("b")))
    spans = F.when(selector.inside, element_spans(tags, selector.container)).otherwise(whole)
    found = F.flatten(F.transform(spans, lambda s: let(inside(tags, s), lambda part: F.when(selector.child, _children(part)).otherwise(part))))
    return F.transform(F.filter(found, lambda t: _fits(t, selector.anchor)), lambda t: t.h)


def _inner(pieces: Column, span: Column) -> Column:
    return F.regexp_replace(F.array_join(F.slice(pieces, span.a + 1, span.b - span.a), ""), r"(?s)^<[^>]*>", "")


def element_texts(pieces: Column, tags: Column, part: Column) -> Column:
    """Text of every element that matches ``part``, tags dropped and entities decoded."""
    return F.transform(element_spans(tags, part), lambda s: decode_entities(F.regexp_replace(_inner(pieces, s), TAG_RE, "")))


def candidates(tags: Column, selectors: Column) -> Column:
    """Those of the selectors whose key the page holds; the others match nothing on it."""
    tokens = F.flatten(F.transform(tags, lambda t: F.concat(
        F.array(t.n), F.transform(F.coalesce(t.c, F.array().cast("array<string>")), lambda x: F.concat(F.lit("."), x)),
        F.array(F.concat(F.lit("#"), F.coalesce(t.i, F.lit("")))))))
    return let(F.array_intersect(tokens, F.transform(selectors, lambda s: s.key)), lambda keys: F.filter(selectors, lambda s: F.array_contains(keys, s.key)))


def matches(html: Column, selectors: Column, kind: str, make: Callable[[Column, Column, Column], Column]) -> Column:
    """Array of (s, h): every selector that may match something on the page and ``make(pieces, tags, selector)``, of type ``kind``.

    The page is parsed once, whatever the number of selectors.
    """
    one = lambda pieces, tags: F.transform(candidates(tags, selectors), lambda x: F.struct(x.s.alias("s"), make(pieces, tags, x).cast(kind).alias("h")))
    return let(clean_pieces(html), lambda pieces: let(tag_list(pieces), lambda tags: one(pieces, tags)))


def regions(html: Column, part: str) -> Column:
    """Inner html of every outermost element that matches ``part``, in order."""
    return let(clean_pieces(html), lambda pieces: let(tag_list(pieces, _needs(part)), lambda tags: F.transform(
        element_spans(tags, literal_part(part)), lambda s: _inner(pieces, s))))


def hrefs(html: Column, selector: str) -> Column:
    """Hrefs of the anchors that a link selector matches, in order; an anchor without href gives null."""
    container, _, anchor = parse_selector(selector)
    row = selector_rows([selector])[0]
    return let(tag_list(clean_pieces(html), (*_needs(container, anchor), "href")), lambda tags: anchor_hrefs(tags, row))


def texts(html: Column, part: str) -> Column:
    """Text of every element that matches ``part``, tags dropped and entities decoded."""
    return F.transform(regions(html, part), lambda r: decode_entities(F.regexp_replace(r, TAG_RE, "")))
