"""DuckDB oracle texts: the fixture views and the scalar functions as SQL.

Only used to check the Spark plans: the driver runs each ``oracle_sql()`` text
in DuckDB on the same parquet tables and compares results.
"""

from __future__ import annotations

from pressloom.functions.text import PY_SPACE, TITLE_SEPARATORS, HTML_ENTITIES, MAX_TITLE
from pressloom.functions.urls import (NETLOC_RE, PATH_RE, PARAMS_RE, SCHEME_RE, USES_PARAMS, ARCHIVE_LINK_RE, WEB_ARCHIVE_LINK_RE,
                                      ENCODED_URL_RE, FORUM_DOMAIN)

VIEWS = {
    "src": """
SELECT rn AS source_id,
       CASE rn % 9 WHEN 0 THEN 'very high' WHEN 1 THEN 'high' WHEN 2 THEN 'mixed' WHEN 3 THEN 'low'
                   WHEN 4 THEN 'very low' WHEN 5 THEN 'satire' WHEN 6 THEN 'insane stuff'
                   WHEN 7 THEN 'unrated' ELSE 'High' END AS factual_reporting,
       CASE WHEN rn % 7 = 0 THEN concat('http://', h, '/news')
            WHEN rn % 5 = 0 THEN concat('https://www.', h, '/') ELSE h END AS url
FROM (SELECT h, row_number() OVER (ORDER BY h) AS rn
      FROM (SELECT DISTINCT regexp_replace(regexp_extract(url, '^https?://([^/?#]*)', 1), '^www[.]', '') AS h FROM pages) a) b""",
    "lnk": """
SELECT page_id % 4 AS batch_id, page_id AS seq,
       CASE page_id % 7 WHEN 0 THEN concat('https://web.archive.org/web/2018/', url)
                        WHEN 1 THEN concat('http://archive.is/', page_id)
                        WHEN 2 THEN concat('https://www.archive.is/', page_id)
                        WHEN 3 THEN concat('/relative/', page_id) ELSE url END AS url,
       concat('https://feed', page_id % 3, '.example.com/') AS scraped_from, page_id % 5 < 3 AS fake
FROM pages
UNION ALL
SELECT page_id % 4, page_id + 1000000, url, 'https://feed9.example.com/', page_id % 5 >= 3
FROM pages WHERE page_id % 11 IN (0, 5)""",
    "art": """
SELECT page_id % 4 AS batch_id, page_id AS seq,
       CASE WHEN page_id % 6 = 0 THEN concat(' title ', page_id % 37, ' ')
            ELSE regexp_extract(html, '<title>([^<]*)</title>', 1) END AS title,
       CASE WHEN page_id % 5 = 0 THEN concat('http://dup.example.org/p/', page_id % 35) ELSE url END AS url,
       url AS visited_url, html AS text, page_id % 3 = 0 AS fake
FROM pages""",
    "err": """
SELECT CASE e.event_id % 5 WHEN 0 THEN 'TimeoutError' WHEN 1 THEN 'ClientConnectorError'
            WHEN 2 THEN 'HttpStatusError' WHEN 3 THEN 'ClientPayloadError' ELSE 'clienterror' END AS type,
       CASE WHEN e.event_id % 17 = 0 THEN concat('http://gone.example.org/', e.event_id % 51) ELSE p.url END AS url,
       CASE WHEN e.event_id % 19 = 0 THEN NULL ELSE concat('https://feed', e.event_id % 3, '.example.com/') END AS source_article,
       e.event_id % 3 = 0 AS from_fake, e.props AS additional_info,
       CASE WHEN e.event_id % 23 = 0 THEN NULL ELSE date_trunc('day', e.ts) END AS creation_date
FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)
WHERE e.event_type = 'error'""",
    "post": """
SELECT e.event_type AS sub, e.event_id AS post_id, (e.event_id * 7919) % 10007 AS score, e.ts AS created, p.url AS url,
       CASE WHEN e.event_id % 13 = 0 THEN p.url ELSE concat('/r/', e.event_type, '/', e.event_id) END AS permalink
FROM events e JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)""",
    "edge": """
SELECT h AS feed, page_id, url AS page_url,
       lead(url) OVER (PARTITION BY h ORDER BY page_id) AS next_url,
       row_number() OVER (PARTITION BY h ORDER BY page_id) AS rn
FROM (SELECT page_id, url, regexp_extract(url, '^https?://([^/?#]*)', 1) AS h FROM pages) a""",
    "feed": """
SELECT feed AS name, page_url AS url, CASE WHEN page_id % 5 = 0 THEN -1 ELSE page_id % 4 END AS stop_after, page_id % 2 = 0 AS fake_news
FROM edge WHERE rn = 1""",
    "state": """
SELECT feed AS name, page_id % 3 = 0 AS is_over, page_url AS url, page_id % 5 - 1 AS page
FROM edge WHERE rn = 2 AND page_id % 4 < 3""",
    # the feeds' pages by what their markup was made of: next link, entries, article links, mark
    "site": """
SELECT p.page_id, p.url, e.next_url, a.url AS e1, b.url AS e2, c.url AS l1, d.url AS l2, concat('m', p.page_id % 3) AS mark
FROM (SELECT page_id, url, (page_id * 7 + 3) % n AS k1, (page_id * 11 + 5) % n AS k2, (page_id * 3 + 1) % n AS k3, (page_id * 5 + 2) % n AS k4
      FROM pages, (SELECT count(*) AS n FROM pages) z) p
JOIN edge e ON e.page_id = p.page_id JOIN pages a ON a.page_id = p.k1 JOIN pages b ON b.page_id = p.k2
JOIN pages c ON c.page_id = p.k3 JOIN pages d ON d.page_id = p.k4""",
    "conf": """
SELECT feed AS name, page_url AS url, CASE WHEN page_id % 5 = 0 THEN -1 ELSE page_id % 4 END AS stop_after, page_id % 2 = 0 AS fake_news, page_id AS position
FROM edge WHERE rn = 1""",
    # responses of links; some urls are fetched again later with another page, some are there twice
    "resp": """
SELECT CASE page_id % 7 WHEN 0 THEN concat('https://web.archive.org/web/2018/', url)
                        WHEN 1 THEN concat('http://archive.is/', page_id)
                        WHEN 2 THEN concat('https://www.archive.is/', page_id) ELSE url END AS url,
       CASE WHEN page_id % 13 = 0 AND k <> 2 THEN 404 ELSE 200 END AS status, CASE WHEN k = 2 THEN 2 ELSE 1 END AS fetched,
       CASE WHEN page_id % 17 = 0 THEN NULL
            WHEN page_id % 7 = 1 AND page_id % 9 = 0 THEN concat('<div id="HEADER"><table><tr><td><input value=""></td></tr></table></div>', body)
            WHEN page_id % 7 = 1 THEN concat('<div id="HEADER"><p>saved</p><table><tr><td><input type="text" value="', url, '"></td></tr></table></div>', body)
            ELSE body END AS html
FROM (SELECT page_id, url, k, CASE WHEN k = 2 THEN replace(html, '</article>', '<p>Fetched again.</article>') ELSE html END AS body
      FROM pages, (VALUES (1), (2), (3)) f(k) WHERE k = 1 OR (k = 2 AND page_id % 6 = 2) OR (k = 3 AND page_id % 10 = 4)) p
WHERE page_id % 7 <> 3 AND page_id % 29 <> 0""",
    # the one response of each url
    "resp1": """
SELECT url, status, html FROM (
  SELECT *, row_number() OVER (PARTITION BY url ORDER BY fetched DESC, status = 200 DESC, html IS NOT NULL DESC, md5(html) DESC) AS k FROM resp) r
WHERE k = 1""",
}
VIEW_DEPS = {"feed": ["edge"], "state": ["edge"], "site": ["edge"], "conf": ["edge"], "resp1": ["resp"]}


def with_views(body: str, *names: str, extra: list[tuple[str, str]] | None = None, recursive: bool = False) -> str:
    """``WITH`` clause holding the named views (and their dependencies), then ``body``."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in VIEW_DEPS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    parts = [f"{n} AS ({VIEWS[n].strip()})" for n in order]
    parts += [f"{n} AS ({sql.strip()})" for n, sql in (extra or [])]
    return (("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body.strip()) if parts else body.strip()


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# ---- scalar functions as DuckDB SQL (mirror pressloom.functions) ----

def py_strip(x: str) -> str:
    return f"regexp_replace({x}, {lit('^' + PY_SPACE + '+|' + PY_SPACE + '+' + chr(92) + 'z')}, '', 'g')"


def value_or_none(x: str) -> str:
    return f"nullif({py_strip(x)}, '')"


def remove_newlines(x: str) -> str:
    return py_strip(f"regexp_replace({x}, {lit(chr(10) + '+')}, ' ', 'g')")


def min_words_or_none(x: str, n: int) -> str:
    s = py_strip(x)
    return f"CASE WHEN length({s}) - length(replace({s}, ' ', '')) + 1 >= {n} THEN {s} END"


def truncate_title(x: str) -> str:
    return f"substring({x}, 1, {MAX_TITLE})"


def correct_title(title: str, tag_text: str) -> str:
    t = py_strip(tag_text)
    cuts = []
    for sep in TITLE_SEPARATORS:
        esc = "".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in sep)
        cuts.append(f"CASE WHEN contains({t}, {lit(sep)}) THEN regexp_extract({t}, {lit('(?s)^(.*)' + esc)}, 1) END")
    repaired = truncate_title(f"coalesce({', '.join(cuts)}, {t})")
    return f"CASE WHEN ends_with({py_strip(title)}, '…') THEN {repaired} ELSE {title} END"


def decode_entities(x: str) -> str:
    out = x
    for ent, ch in HTML_ENTITIES:
        out = f"replace({out}, {lit(ent)}, {lit(ch)})"
    return out


def check_strings(arr: str) -> str:
    return f"list_filter(list_transform({arr}, lambda x: {py_strip("x")}), lambda x: x IS NOT NULL AND x <> '')"


def _clean(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, {lit(r'^[\x00-\x20]+')}, ''), {lit(r'[\t\r\n]')}, '', 'g')"


def maintain_netloc(x: str) -> str:
    return f"regexp_extract({_clean(x)}, {lit(NETLOC_RE)}, 1)"


def maintain_path(x: str) -> str:
    u = _clean(x)
    raw = f"regexp_extract({u}, {lit(PATH_RE)}, 1)"
    schemes = ", ".join(lit(s) for s in USES_PARAMS)
    return (f"CASE WHEN lower(regexp_extract({u}, {lit(SCHEME_RE)}, 1)) IN ({schemes}) "
            f"THEN regexp_replace({raw}, {lit(PARAMS_RE)}, '') ELSE {raw} END")


def remove_prefix(x: str) -> str:
    s = py_strip(x)
    s = f"CASE WHEN starts_with({s}, 'http') THEN regexp_replace({s}, 'https?://', '') ELSE {s} END"
    s = f"regexp_replace({s}, '^www[.]', '')"
    return f"regexp_replace({s}, {lit('/' + chr(92) + 'z')}, '')"


def site_key(x: str) -> str:
    h = maintain_netloc(x)
    return f"CASE WHEN contains({h}, '[') = contains({h}, ']') THEN {remove_prefix(h)} END"


def link_kind(x: str) -> str:
    return (f"CASE WHEN regexp_matches({x}, {lit(ARCHIVE_LINK_RE)}) THEN 'archive' "
            f"WHEN regexp_matches({x}, {lit(WEB_ARCHIVE_LINK_RE)}) THEN 'web_archive' ELSE 'default' END")


def web_archive_target(x: str) -> str:
    return f"regexp_extract({maintain_path(x)}, {lit(ENCODED_URL_RE)}, 1)"


def forum_source_url(x: str) -> str:
    return f"concat({lit(FORUM_DOMAIN)}, {x}, '/')"


def label_of_reporting(x: str) -> str:
    return (f"CASE WHEN {x} IN ('mixed') THEN 'mixed' WHEN {x} IN ('very high', 'high') THEN 'high' "
            f"WHEN {x} IN ('low', 'insane stuff', 'satire', 'very low') THEN 'low' END")


LABEL_DIM_SQL = f"""
SELECT key, arg_max(label, prio) AS label FROM (
  SELECT {remove_prefix('url')} AS key, {label_of_reporting('factual_reporting')} AS label, source_id AS prio FROM src
  UNION ALL
  SELECT * FROM (VALUES ('archive.is', 'archive', 9223372036854775807), ('archive.fo', 'archive', 9223372036854775807),
                        ('archive.today', 'archive', 9223372036854775807), ('web.archive.org', 'archive', 9223372036854775807)) v(key, label, prio)
) t WHERE label IS NOT NULL AND key IS NOT NULL GROUP BY key"""


def admission(label: str, fake: str, archived: str) -> str:
    f, a = f"coalesce({fake}, false)", f"coalesce({archived}, false)"
    return (f"coalesce(CASE WHEN {label} = 'high' THEN NOT {f} WHEN {label} = 'low' THEN {f} "
            f"WHEN {label} = 'mixed' THEN {f} AND {a} "
            f"ELSE ({label} = 'archive') AND {f} AND NOT {a} END, false)")


# ---- html field functions (mirror pressloom.functions.html) ----

from pressloom.functions import html as _h  # noqa: E402


def title_tag_text(x: str) -> str:
    return decode_entities(f"regexp_extract({x}, {lit(_h.TITLE_RE)}, 1)")


def page_title(x: str) -> str:
    return py_strip(title_tag_text(x))


def page_text(x: str) -> str:
    clean = f"regexp_replace({x}, {lit(_h.NOISE_RE)}, '', 'g')"
    art = f"regexp_extract(c, {lit(_h.ARTICLE_RE)}, 1)"
    body = f"regexp_extract(c, {lit(_h.BODY_RE)}, 1)"
    main = f"CASE WHEN {art} <> '' THEN {art} WHEN {body} <> '' THEN {body} ELSE c END"
    t = f"regexp_replace({main}, {lit(_h.BLOCK_END_RE)}, chr(10), 'g')"
    t = f"regexp_replace({t}, {lit(_h.TAG_RE)}, '', 'g')"
    t = f"regexp_replace({t}, {lit(_h.BLANK_LINES_RE)}, chr(10), 'g')"
    # the cleaned html is bound once through a lambda over a one-element list
    return f"(list_transform([{clean}], lambda c: {decode_entities(t)}))[1]"


def attr(tag: str, name: str) -> str:
    p = lit(rf"""(?is)[\s"'/]{name}\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
    value = decode_entities(f"concat({', '.join(f'regexp_extract({tag}, {p}, {i})' for i in (1, 2, 3))})")
    return f"CASE WHEN regexp_matches({tag}, {p}) THEN {value} END"


def named_metas(x: str, spec) -> str:
    name, value = spec
    return (f"list_filter(list_transform(list_filter(regexp_extract_all({x}, {lit(_h.META_TAG_RE)}, 0), lambda t: "
            f"coalesce(lower({attr('t', name)}) = {lit(value)}, false)), lambda t: {attr('t', 'content')}), lambda c: c IS NOT NULL)")


def meta_content(x: str, spec) -> str:
    return f"({named_metas(x, spec)})[1]"


def meta_description(x: str) -> str:
    return f"coalesce({meta_content(x, _h.META_DESCRIPTION)}, '')"


def page_lang(x: str) -> str:
    tag = f"regexp_extract({x}, {lit(_h.HTML_TAG_RE)}, 0)"
    two = f"substring(coalesce({attr(tag, 'lang')}, ''), 1, 2)"
    return f"CASE WHEN regexp_matches({two}, '^[A-Za-z]{{2}}$') THEN lower({two}) END"


def page_keywords(x: str) -> str:
    return check_strings(f"string_split(coalesce({meta_content(x, _h.META_KEYWORDS)}, ''), ',')")


def page_section(x: str) -> str:
    return meta_content(x, _h.META_SECTION)


def page_generator(x: str) -> str:
    return value_or_none(meta_content(x, _h.META_GENERATOR))


def page_publish_date(x: str) -> str:
    raw = f"coalesce({meta_content(x, _h.META_PUBLISHED)}, '')"
    day = f"regexp_extract({raw}, {lit(_h.DATE_RE)}, 1)"
    clock = f"regexp_extract({raw}, {lit(_h.DATE_RE)}, 2)"
    return (f"TRY_CAST(CASE WHEN {day} <> '' THEN concat({day}, CASE WHEN {clock} <> '' THEN concat(' ', {clock}) "
            f"ELSE '' END) END AS TIMESTAMP)")


def _sources(x: str, tags: str) -> str:
    found = f"list_transform(regexp_extract_all({x}, {lit(tags)}, 0), lambda t: {attr('t', 'src')})"
    return f"list_sort(list_distinct({check_strings(found)}))"


def page_images(x: str) -> str:
    return _sources(x, _h.IMG_TAG_RE)


def page_videos(x: str) -> str:
    return _sources(x, _h.VIDEO_TAG_RE)


def page_authors(x: str) -> str:
    return f"list_distinct({check_strings(named_metas(x, _h.META_AUTHOR))})"


def archive_original_url(x: str) -> tuple[str, str]:
    """By the header that the resp view puts before an archive page."""
    attrs = f"""regexp_extract({x}, '(?s)^<div id="HEADER">(?:<p>saved</p>)?<table><tr><td><input ([^>]*)>', 1)"""
    value = f"""regexp_extract({attrs}, 'value="([^"]*)"', 1)"""
    err = f"CASE WHEN {attrs} = '' THEN 'TypeError' WHEN {value} = '' THEN 'ArchivedURLNotFound' END"
    return f"CASE WHEN ({err}) IS NULL THEN {value} END", err


def message(template: str, **exprs: str) -> str:
    """SQL form of ``pressloom.sources.tables.message``."""
    import re as _re
    parts = _re.split(r"\{(\w+)\}", template)
    pieces = [lit(p) if i % 2 == 0 else f"CAST({exprs[p]} AS VARCHAR)" for i, p in enumerate(parts) if p or i % 2]
    return f"concat({', '.join(pieces)})" if len(pieces) > 1 else pieces[0]
