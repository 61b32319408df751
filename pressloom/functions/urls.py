"""URL functions with Python ``urllib.parse`` semantics, as native Spark expressions.

Spark's ``parse_url`` differs from ``urlparse`` (null on spaces, null host
without a scheme, keeps ``;params``), so the authority and path are taken with
regexes that follow ``urlsplit``: optional ``scheme:``, then ``//authority``
up to the first ``/ ? #``, then the path up to ``? #``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from pressloom.functions.text import PY_SPACE, py_strip

# urlsplit drops leading C0 controls and spaces, and removes tab, CR and LF everywhere.
_LEAD_C0 = r"^[\x00-\x20]+"
_UNSAFE = r"[\t\r\n]"
NETLOC_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
PATH_RE = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)"
PARAMS_RE = r";[^/]*\z"
SCHEME_RE = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
# Schemes whose last path segment carries ";params" (urllib.parse.uses_params).
USES_PARAMS = ["", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp", "rtsps", "rtspu",
               "sip", "sips", "mms", "sftp", "tel"]

# Link kinds recognised by their start (case-sensitive, no "www.").
ARCHIVE_LINK_RE = r"^https?://archive[.]"
WEB_ARCHIVE_LINK_RE = r"^https?://web[.]archive[.]"
PY_NONSPACE = "[^" + PY_SPACE[1:]
ENCODED_URL_RE = rf"(https?://{PY_NONSPACE}+)"
FORUM_DOMAIN = "https://www.reddit.com/r/"

KIND_DEFAULT, KIND_ARCHIVE, KIND_WEB_ARCHIVE = "default", "archive", "web_archive"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _clean(u: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(u, _LEAD_C0, ""), _UNSAFE, "")


def maintain_netloc(c) -> Column:
    """Authority (user info and port kept); ``''`` when there is no ``//``."""
    return F.regexp_extract(_clean(_c(c)), NETLOC_RE, 1)


def maintain_path(c) -> Column:
    """Path without query, fragment and the last segment's ``;params``
    (params are split only for the schemes that use them)."""
    u = _clean(_c(c))
    raw = F.regexp_extract(u, PATH_RE, 1)
    scheme = F.lower(F.regexp_extract(u, SCHEME_RE, 1))
    return F.when(scheme.isin(*USES_PARAMS), F.regexp_replace(raw, PARAMS_RE, "")).otherwise(raw)


def remove_prefix(c) -> Column:
    """Strip; if it starts with ``http`` drop the first ``https?://`` found
    anywhere; then a leading ``www.``; then one trailing ``/``. Case-sensitive."""
    s = py_strip(c)
    s = F.when(s.startswith("http"), F.regexp_replace(s, r"(?s)^(.*?)https?://", "$1")).otherwise(s)
    s = F.regexp_replace(s, r"^www[.]", "")
    return F.regexp_replace(s, r"/\z", "")


def site_key(c) -> Column:
    """``remove_prefix(maintain_netloc(url))`` — the key a label is looked up by.

    An authority with an unbalanced ``[``/``]`` is not a valid url and gets no key.
    """
    host = maintain_netloc(c)
    bad = host.contains("[") != host.contains("]")
    return F.when(~bad, remove_prefix(host))


def link_kind(c) -> Column:
    """Which extractor a link goes to."""
    u = _c(c)
    return (F.when(u.rlike(ARCHIVE_LINK_RE), F.lit(KIND_ARCHIVE))
            .when(u.rlike(WEB_ARCHIVE_LINK_RE), F.lit(KIND_WEB_ARCHIVE))
            .otherwise(F.lit(KIND_DEFAULT)))


def web_archive_target(c) -> Column:
    """First ``https?://<non-space>+`` in the *path* of a web-archive link; ``''`` if none.

    Query and fragment of the archived url are lost, as only the path is searched.
    """
    return F.regexp_extract(maintain_path(c), ENCODED_URL_RE, 1)


def forum_source_url(c) -> Column:
    """The page a forum link counts as found on."""
    return F.concat(F.lit(FORUM_DOMAIN), _c(c), F.lit("/"))


def archived_flag(url, visited_url) -> Column:
    """The article's actual url differs from the one visited."""
    return _c(url) != _c(visited_url)
