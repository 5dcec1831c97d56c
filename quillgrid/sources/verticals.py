"""Single producers: what they carry down, cap, drop and label. Rows come from recorded documents, never from the net here."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import contains_any
from ..functions.text import clean_text
from ..functions.times import parse_any
from ..operators.filters import fisheries_type, legislative_action, species
from ..operators.merge import first_by_either, keep_first
from ..operators.ranking import fill_forward, top_n


def table_rows(df: DataFrame, html: str = "value", least: int = 4) -> DataFrame:
    """df's columns, position and cells of each row with enough cells in a page's last table."""
    last = F.try_element_at(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<table\b[^>]*>(.*?)</table>"), 1), F.lit(-1))
    rows = F.regexp_extract_all(last, F.lit(r"(?is)<tr\b[^>]*>(.*?)</tr>"), 1)
    cells = F.transform(F.regexp_extract_all(F.col("__row"), F.lit(r"(?is)<td\b[^>]*>(.*?)</td>"), 1), lambda c: clean_text(c))
    return df.select(*df.columns, F.posexplode(rows).alias("position", "__row")).select(*df.columns, "position", cells.alias("cells")).filter(F.size("cells") >= least)


def spills(df: DataFrame, as_of: Column, html: str = "value", days: int = 14) -> DataFrame:
    """Spills of the last days: number, name, date, place of a register's table."""
    c = lambda k: F.get("cells", F.lit(k))
    rows = table_rows(df, html).select(c(0).alias("number"), c(1).alias("title"), F.to_date(parse_any(c(2), "M/d/yyyy", "yyyy-MM-dd")).alias("day"), c(3).alias("place"))
    return rows.filter(F.datediff(as_of, "day") <= days).withColumn("hash", F.sha2(F.concat_ws("|", "number", "title").cast("binary"), 256))


def local_bulletins(df: DataFrame, text: str, words: Sequence[str]) -> DataFrame:
    return df.filter(contains_any(F.lower(text), words)).withColumn("hash", F.sha2(F.col(text).cast("binary"), 256))


def permit_notices(df: DataFrame, title: str = "title") -> DataFrame:
    """Notices with the permit's number, the first word of the title."""
    return df.withColumn("number", F.split_part(title, F.lit(" "), F.lit(1)))


def fisheries(df: DataFrame, feed: str = "feed", position: str = "position", title: str = "title", summary: str = "summary", each: int = 15) -> DataFrame:
    """The first entries of each feed, each once, with kind and species of their text."""
    first = keep_first(top_n(df, [feed], [F.col(position)], each).drop("rank"), [title, "link"], position)
    text = F.lower(F.concat_ws(" ", title, summary))
    return first.withColumns({"type": fisheries_type(text), "species": species(text), summary: F.substring(summary, 1, 300)})


def legislative_actions(rows: DataFrame, session: str, position: str = "position") -> DataFrame:
    """Action rows (bill, text) of a session's table with the chamber of the heading above them; headings go."""
    carried = fill_forward(rows, ["chamber"], [position], [session])
    return carried.filter(F.col("bill").isNotNull()).withColumn("type", legislative_action(F.lower("text")))


def session_status(text: Column) -> Column:
    low = F.lower(text)
    return F.when(contains_any(low, ["adjourned", "sine die"]), "adjourned").when(contains_any(low, ["special session"]), "special").when(contains_any(low, ["session"]), "in_session").otherwise("unknown")


def news(df: DataFrame, group: str, position: str, title: str, each: int) -> DataFrame:
    """The first news of each school or campus, no title twice in one."""
    return top_n(keep_first(df, [group, title], position), [group], [F.col(position)], each).drop("rank")


def district_news(df: DataFrame, title: str = "title", href: str = "href", seq: str = "seq", home: str = "", paths: Sequence[str] = ("/post/", "/article/"), words: Sequence[str] = ("news", "recap"), least: int = 10, most: int = 20) -> DataFrame:
    """The first most links of a district's page that are news, by path or title, with url; no url and no title that a link
    before it took."""
    named = df.withColumn("__t", F.trim(title)).filter((F.length("__t") > least) & (contains_any(F.lower(F.col(href)), paths) | contains_any(F.lower("__t"), words)))
    url = F.when(F.col(href).startswith("/"), F.concat(F.lit(home), F.col(href))).otherwise(F.col(href))
    return first_by_either(named.withColumns({"url": url, title: F.col("__t")}).drop("__t"), "url", title, seq, most)


def venues(df: DataFrame, page: str, position: str = "position") -> DataFrame:
    """Venues (name) with the city of the heading above, one row for each name and city."""
    carried = fill_forward(df, ["city"], [position], [page])
    return keep_first(carried.filter(F.col("name").isNotNull()), ["name", "city"], position)


def wildlife(df: DataFrame, text: Column, urgent: Sequence[str] = ("attack", "emergency", "closure")) -> DataFrame:
    """Wildlife notices: the impact of urgent ones is higher; keys don't hold the time of reading, so they deduplicate."""
    impact = F.when(contains_any(F.lower(text), urgent), 85).otherwise(60)
    return df.withColumns({"impactScore": impact, "hash": F.sha2(F.concat_ws("|", "link", "title").cast("binary"), 256)})


def school_sites(links: DataFrame, host: Column, district: Column, words: Sequence[str] = ("school", "elementary", "middle", "high")) -> DataFrame:
    """Links of a district's page to its schools: another host of the same domain, or a path that says so; last one of a URL."""
    from ..operators.merge import keep_last

    ok = (host != district) & host.endswith(F.regexp_replace(district, "^www", ""))
    return keep_last(links.filter(ok | contains_any(F.lower("link"), [f"/{w}" for w in words])), ["link"])
