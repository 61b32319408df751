"""Column -> Column scalar functions."""

from pressloom.functions.text import (  # noqa: F401
    PY_SPACE,
    py_strip,
    check_strings,
    value_or_none,
    remove_newlines,
    min_words_or_none,
    correct_title,
    truncate_title,
    decode_entities,
    MAX_TITLE,
)
from pressloom.functions.urls import (  # noqa: F401
    remove_prefix,
    maintain_netloc,
    maintain_path,
    site_key,
    link_kind,
    web_archive_target,
    forum_source_url,
    archived_flag,
)
