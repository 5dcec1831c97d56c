"""A Python data source for feeds: one partition for each feed, read by a fetch function that the caller gives."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..session import ship

SCHEMA = "feed string, page int, url string, status int, body string, error string"
#: (url, timeout seconds) to (status, body); it raises where nothing was fetched.
Fetch = Callable[[str, float], tuple[int, str]]


def http_fetch(url: str, timeout: float) -> tuple[int, str]:
    """With certificates checked and no disguise."""
    from urllib.request import Request, urlopen

    with urlopen(Request(url, headers={"User-Agent": "quillgrid"}), timeout=timeout) as r:  # noqa: S310
        return r.status, r.read().decode("utf-8", "replace")


class _Feed(InputPartition):
    def __init__(self, name: str, url: str):
        self.name, self.url = name, url


#: Answers for which the site's front page is asked.
GONE = (404, 403, 410, 500)


def site(url: str) -> str:
    parts = urlsplit(url)
    return f"{parts.scheme}://{parts.netloc}"


def page_url(url: str, page: int) -> str:
    return url if page == 1 else f"{url}{'&' if '?' in url else '?'}paged={page}"


def feed_source(fetch: Fetch, feeds: list[tuple[str, str]], pages: int = 1, timeout: float = 12.0, home_timeout: float = 8.0) -> type[DataSource]:
    """A data source class over feeds (name, url). pages > 1 follows ?paged= until a page fails or is empty.

    An error becomes a row, so that one feed stops no other. An answer in GONE gives way to the site's front page, whose
    links stand for the feed (feed_entries with base="url").
    """

    class Reader(DataSourceReader):
        def partitions(self):
            return [_Feed(n, u) for n, u in feeds] or [_Feed("", "")]

        def read(self, partition: _Feed) -> Iterator[tuple]:
            if not partition.url:
                return
            for page in range(1, pages + 1):
                url = page_url(partition.url, page)
                try:
                    status, body = fetch(url, timeout)
                except Exception as e:  # noqa: BLE001  told in the row
                    yield partition.name, page, url, None, None, f"{type(e).__name__}: {e}"
                    return
                if page == 1 and status in GONE:
                    try:
                        root, (ok, home) = site(url), fetch(site(url), home_timeout)
                        if ok == 200:
                            status, body, url = ok, home, root
                    except Exception:  # noqa: BLE001  the first answer stands
                        pass
                if page > 1 and (status != 200 or not body):
                    return
                yield partition.name, page, url, status, body, None

    class FeedSource(DataSource):
        @classmethod
        def name(cls) -> str:
            return "feeds"

        def schema(self) -> str:
            return SCHEMA

        def reader(self, schema) -> DataSourceReader:
            return Reader()

    return FeedSource


def read_feeds(spark: SparkSession, fetch: Fetch, feeds: list[tuple[str, str]], pages: int = 1) -> DataFrame:
    ship(spark)
    spark.dataSource.register(feed_source(fetch, feeds, pages))
    return spark.read.format("feeds").load()


def due_feeds(catalog: DataFrame, held: DataFrame, state: DataFrame, as_of) -> DataFrame:
    """Feeds of a catalog (name, url, category) that aren't held and are due by state (name, next_check)."""
    from ..operators.filters import is_due

    return catalog.join(held.select("name"), "name", "left_anti").join(state, "name", "left").filter(is_due(state["next_check"], as_of)).select(*catalog.columns)
