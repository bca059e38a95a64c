"""Title, author and text of web pages."""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGE_PARTS = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "author", "body", "error")])
_HIDDEN = {"script", "style"}


class _Page(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.title: str | None = None
        self.author: str | None = None
        self.pieces: list[str] = []
        self._inside: list[str] = []

    def handle_starttag(self, tag, attrs):
        if tag == "title" or tag in _HIDDEN:
            self._inside.append(tag)
        elif tag == "meta":
            named = dict(attrs)
            if (named.get("name") or "").lower() in ("author", "creator"):
                self.author = named.get("content")

    def handle_endtag(self, tag):
        if self._inside and self._inside[-1] == tag:
            self._inside.pop()

    def handle_data(self, data):
        if not self._inside:
            self.pieces.append(data)
        elif self._inside[-1] == "title":
            self.title = (self.title or "") + data


def _parts(html: str | None) -> tuple[str | None, str | None, str | None, str | None]:
    if html is None:
        return None, None, None, "no content"
    try:
        page = _Page()
        page.feed(html)
        page.close()
        body = " ".join(" ".join(page.pieces).split())
        title = page.title.strip() if page.title is not None else None
        return title, page.author, body, None
    except Exception as error:  # one bad page must not fail the job
        return None, None, None, str(error)


@F.pandas_udf(PAGE_PARTS)
def page_parts(html: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_parts(h) for h in html], columns=PAGE_PARTS.names)
