"""URL columns, and links out of HTML."""

from __future__ import annotations

from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..session import ship
from .catalogs import NO_ARTICLE
from .rules import contains_any, let

LINKS = "array<struct<title:string,link:string>>"


class _Anchors(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.found: list[tuple[str, str]] = []
        self.open: tuple[str, list[str]] | None = None

    def _close(self):
        if self.open:
            self.found.append(("".join(self.open[1]).strip(), self.open[0]))
            self.open = None

    def handle_starttag(self, tag, attrs):
        if tag == "a":
            self._close()
            href = dict(attrs).get("href")
            self.open = (href, []) if href is not None else None

    def handle_endtag(self, tag):
        if tag == "a":
            self._close()

    def handle_data(self, data):
        if self.open:
            self.open[1].append(data)


def anchors(page: str | None, base: str | None) -> list[dict]:
    """Every anchor of a page in order; links of the same site made absolute."""
    parser = _Anchors()
    parser.feed(page or "")
    parser.close()
    parser._close()
    return [{"title": t, "link": urljoin(base or "", h) if h.startswith("/") else h} for t, h in parser.found]


def _anchor_series(pages: pd.Series, bases: pd.Series) -> pd.Series:
    return pd.Series([anchors(p, b) for p, b in zip(pages, bases)])


def page_links(page: Column, base: Column) -> Column:
    """LINKS of a page; an Arrow batch at a time."""
    from pyspark.sql import SparkSession

    ship(SparkSession.getActiveSession())
    return F.pandas_udf(_anchor_series, LINKS)(page, base)


def article_links(links: Column, base: Column, least_title: int = 15, longer: int = 10, most: int = 15) -> Column:
    """The first most of links (a column of the frame, as page_links runs Python) that look like articles, each once."""
    good = F.filter(
        links,
        lambda x: (F.length(x["title"]) >= least_title) & x["link"].startswith("http") & ~contains_any(F.lower(x["link"]), NO_ARTICLE) & (F.length(x["link"]) > F.length(base) + longer),
    )
    once = lambda g: let(F.transform(g, lambda x: x["link"]), lambda u: F.filter(g, lambda x, i: F.array_position(u, x["link"]) == i + 1))
    return F.slice(let(good, once), 1, most)


def domain(url: Column) -> Column:
    return F.try_parse_url(url, F.lit("HOST"))


def favicon(url: Column) -> Column:
    return F.concat(F.lit("https://"), domain(url), F.lit("/favicon.ico"))


def absolute(base: Column, href: Column) -> Column:
    """href on base's site: schemeless and root-relative ones are completed."""
    return F.when(href.startswith("//"), F.concat(F.lit("https:"), href)).when(href.startswith("/"), F.concat(F.try_parse_url(base, F.lit("PROTOCOL")), F.lit("://"), domain(base), href)).otherwise(href)


def without_protocol(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^https?://(www\.)?", ""), "/+$", "")


def resolve_tracker(title: Column, link: Column) -> Column:
    """A metrics link gives way to the URL in its title."""
    return F.when(link.contains("post_type=od_url_metrics") & title.startswith("http"), F.trim(title)).otherwise(F.trim(link))


def image_of(page: Column) -> Column:
    """The page's image: og or twitter meta, else the first acceptable img."""
    meta = F.coalesce(*[F.nullif(F.regexp_extract(page, p, 1), F.lit("")) for p in (r'(?i)<meta[^>]+property="og:image"[^>]+content="([^"]+)"', r'(?i)<meta[^>]+name="twitter:image"[^>]+content="([^"]+)"')])
    images = F.filter(F.regexp_extract_all(page, F.lit(r'(?i)<img[^>]+src="([^"]+)"'), 1), lambda u: u.startswith("http") & ~F.lower(u).rlike(r"(pixel|spacer|logo|icon)"))
    return F.coalesce(meta, F.get(images, F.lit(0)))


def fingerprint(link: Column, title: Column) -> Column:
    """Whether a link can be archived: a web link with a title."""
    return F.coalesce(link.startswith("http") & (F.trim(title) != ""), F.lit(False))
