"""String functions with Python ``str`` semantics, as native Spark expressions.

Spark's ``trim`` only removes spaces; Python's ``str.strip()`` removes every
character for which ``str.isspace()`` is true. ``PY_SPACE`` is that set as a
regex class, written so that Java regex and RE2 read it the same way.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts (29 code points).
PY_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

# Fixed value: the title length limit of the article parser configuration.
MAX_TITLE = 500

# Separators tried, in this order, when a cut title is repaired.
TITLE_SEPARATORS = [" - ", " | ", " – "]

# Html entities decoded in extracted text; "&amp;" goes last.
HTML_ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"),
                 ("&nbsp;", " "), ("&amp;", "&")]

_STRIP_RE = rf"^{PY_SPACE}+|{PY_SPACE}+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: remove leading and trailing Python whitespace."""
    return F.regexp_replace(_c(c), _STRIP_RE, "")


def check_strings(arr) -> Column:
    """L1: keep strings only, strip each, drop empty ones; order and repeats kept."""
    stripped = F.transform(_c(arr), lambda x: py_strip(x))
    return F.filter(stripped, lambda x: x.isNotNull() & (x != F.lit("")))


def value_or_none(c) -> Column:
    """L2: stripped value, or null when empty (or null)."""
    s = py_strip(c)
    return F.when(s != F.lit(""), s)


def remove_newlines(c) -> Column:
    """L3: each run of ``\\n`` becomes one space, then strip (``\\r`` stays)."""
    return py_strip(F.regexp_replace(_c(c), "\n+", " "))


def min_words_or_none(c, n: int) -> Column:
    """L4: stripped text if it has at least ``n`` pieces when split on one space.

    ``''`` splits into one piece, so ``('', 1)`` stays ``''`` (never null).
    Pieces = number of spaces + 1, exactly like ``len(s.split(' '))``.
    """
    s = py_strip(c)
    pieces = F.length(s) - F.length(F.regexp_replace(s, " ", "")) + F.lit(1)
    return F.when(pieces >= F.lit(n), s)


def truncate_title(c, limit: int = MAX_TITLE) -> Column:
    """Cut the title at ``limit`` code points."""
    return F.substring(_c(c), 1, limit)


def _cut_at_last(t: Column, sep: str) -> Column:
    # Greedy prefix before the separator == text up to its last occurrence (rfind).
    escaped = "".join("\\" + ch if ch in r"\.^$|?*+()[]{}" else ch for ch in sep)
    return F.when(t.contains(sep), F.regexp_extract(t, rf"(?s)^(.*){escaped}", 1))


def correct_title(title, title_tag_text) -> Column:
    """Repair a title cut with an ellipsis.

    If the stripped title ends with ``…``, take the stripped ``<title>`` text and
    cut it at the last occurrence of the first separator found; no separator
    keeps the whole text. The result is cut to the title limit.
    """
    t = py_strip(title_tag_text)
    cuts = [_cut_at_last(t, sep) for sep in TITLE_SEPARATORS]
    repaired = truncate_title(F.coalesce(*cuts, t))
    return F.when(py_strip(title).endswith("…"), repaired).otherwise(_c(title))


def decode_entities(c) -> Column:
    """Literal (not regex) replacement of the fixed entities, ``&amp;`` last."""
    out = _c(c)
    for ent, ch in HTML_ENTITIES:
        out = F.replace(out, F.lit(ent), F.lit(ch))
    return out
