"""Article rules: blacklists, minimum lengths, custom checks, url checker.

Every check is a ``Column`` predicate, so Catalyst sees all of them in one
``where``; a Python UDF can still be passed as a check, at UDF speed.
"""

from __future__ import annotations

from typing import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pressloom.operators.common import bounded_broadcast
from pressloom.operators.labels import admission

UrlChecker = Callable[[Column, Column, Column], Column]

# Lists longer than this are matched by a broadcast anti join instead of IN.
INLINE_LIST_MAX = 1000


def default_url_checker(label_col: str = "label") -> UrlChecker:
    """D1 over an already attached label column."""
    return lambda url, fake, archived: admission(F.col(label_col), fake, archived)


class Rules:
    """The checks an article must pass (D9: all of them).

    ``url_check(url, from_fake, archived) -> Column`` decides admission (N2).
    """

    def __init__(self, url_check: UrlChecker | None = None):
        self.url_check = url_check or default_url_checker()
        self._checks: list[Callable[[], Column]] = []
        self._anti: list[tuple[str, list[str]]] = []

    # Custom checks
    def add(self, check: Column | Callable[[], Column]) -> "Rules":
        self._checks.append(check if callable(check) else (lambda c=check: c))
        return self

    def add_on(self, col: str, check: Callable[[Column], Column]) -> "Rules":
        return self.add(lambda: check(F.col(col)))

    def add_title(self, check: Callable[[Column], Column]) -> "Rules":
        return self.add_on("title", check)

    def add_text(self, check: Callable[[Column], Column]) -> "Rules":
        return self.add_on("text", check)

    def add_path(self, check: Callable[[Column], Column]) -> "Rules":
        return self.add_on("path", check)

    def add_url(self, check: Callable[[Column], Column]) -> "Rules":
        return self.add_on("url", check)

    # Exact blacklists; a null value is not in the list, so it passes
    def add_blacklist(self, col: str, values: Iterable[str]) -> "Rules":
        vals = [v for v in values if v is not None]
        if len(vals) <= INLINE_LIST_MAX:
            return self.add_on(col, lambda c: F.coalesce(~c.isin(*vals), F.lit(True)))
        self._anti.append((col, vals))
        return self

    # Minimum lengths in code points (a null value fails)
    def add_min_length(self, col: str, n: int) -> "Rules":
        return self.add_on(col, lambda c: F.coalesce(F.length(c) >= F.lit(int(n)), F.lit(False)))

    @classmethod
    def from_config(cls, rules: Mapping | None, url_check: UrlChecker | None = None) -> "Rules":
        """Config keys ``blacklist.{titles,urls}`` and ``min_length.{title,text,path_loc}``;
        unknown keys are ignored; a missing section means no rule. Each list is
        checked against its own column (title list on titles, url list on urls)."""
        r = cls(url_check)
        rules = rules or {}
        for key, value in rules.items():
            if value is None:
                continue
            if key == "blacklist":
                for k, vals in value.items():
                    if k == "titles" and vals is not None:
                        r.add_blacklist("title", vals)
                    elif k == "urls" and vals is not None:
                        r.add_blacklist("url", vals)
            elif key == "min_length":
                for k, n in value.items():
                    if n is None:
                        continue
                    if k == "title":
                        r.add_min_length("title", n)
                    elif k == "text":
                        r.add_min_length("text", n)
                    elif k == "path_loc":
                        r.add_min_length("path", n)
        return r

    def predicate(self) -> Column:
        out = F.lit(True)
        for c in self._checks:
            out = out & c()
        return out

    def apply(self, articles: DataFrame) -> DataFrame:
        """Rows passing every check."""
        df = articles.where(self.predicate())
        spark = articles.sparkSession
        for col, vals in self._anti:
            lst = bounded_broadcast(spark.createDataFrame([(v,) for v in vals], "_v string"))
            df = df.join(lst, df[col] == lst["_v"], "left_anti")
        return df

    def admit(self, links: DataFrame, url: str = "url", fake: str = "fake", archived: Column | None = None) -> DataFrame:
        """D2 / D3 with this rule set's url checker."""
        arch = archived if archived is not None else F.lit(False)
        return links.where(self.url_check(F.col(url), F.col(fake), arch))
