"""What is published: sitemaps, feeds, JSON lines, snapshots. Strings are made on the JVM and written by Spark's writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import slug, xml_escape


def url_block(link: Column, title: Column, source: Column, ts: Column, today: str, fallback: str = "Unknown") -> Column:
    """One url element of a news sitemap; null for what is no web link. Titles are escaped, links are not."""
    name = F.replace(F.coalesce(F.nullif(source, F.lit("")), F.lit(fallback)), F.lit("&"), F.lit("&amp;"))
    lines = [
        F.lit("  <url>"), F.concat(F.lit("    <loc>"), link, F.lit("</loc>")), F.lit("    <news:news>"), F.lit("      <news:publication>"),
        F.concat(F.lit("        <news:name>"), name, F.lit("</news:name>")), F.lit("        <news:language>en</news:language>"), F.lit("      </news:publication>"),
        F.concat(F.lit("      <news:publication_date>"), F.substring(F.coalesce(ts, F.lit(today)), 1, 10), F.lit("</news:publication_date>")),
        F.concat(F.lit("      <news:title>"), xml_escape(F.coalesce(title, F.lit(""))), F.lit("</news:title>")), F.lit("    </news:news>"), F.lit("  </url>"),
    ]
    return F.when(F.coalesce(link.startswith("http"), F.lit(False)), F.concat_ws("\n", *lines))


def sitemaps(df: DataFrame, by: str, block: str, order: Sequence[Column], most: int = 1000) -> DataFrame:
    """(slug, urls, xml) of each source: its first most blocks, a bounded number."""
    ranked = df.filter(F.col(block).isNotNull()).withColumn("__n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("__n") <= most)
    grouped = ranked.groupBy(by).agg(F.count("*").alias("urls"), F.array_sort(F.collect_list(F.struct("__n", block))).alias("__b"))
    body = F.array_join(F.transform("__b", lambda b: b[block]), "\n")
    xml = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<urlset xmlns="http://www.sitemaps.org/schemas/sitemap/0.9" xmlns:news="http://www.google.com/schemas/sitemap-news/0.9">\n'), body, F.lit("\n</urlset>\n"))
    return grouped.select(slug(F.col(by)).alias("slug"), "urls", xml.alias("xml"))


def sitemap_index(maps: DataFrame, base: str, today: str) -> DataFrame:
    """One index of all sitemaps; their number is that of the sources."""
    entry = F.concat(F.lit(f"  <sitemap><loc>{base}/"), F.col("slug"), F.lit(f".xml</loc><lastmod>{today}</lastmod></sitemap>"))
    joined = F.array_join(F.array_sort(F.collect_list(entry)), "\n")
    return maps.agg(F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?>\n<sitemapindex xmlns="http://www.sitemaps.org/schemas/sitemap/0.9">\n'), joined, F.lit("\n</sitemapindex>\n")).alias("xml"))


def static_sitemap(spark: SparkSession, pages: Sequence[tuple[str, str]], first_year: int, last_year: int, as_of_year: int) -> DataFrame:
    """(path, priority): fixed pages, and a page for each month of the years; newer years come first in priority."""
    fixed = spark.range(1).select(F.explode(F.array(*[F.struct(F.lit(p).alias("path"), F.lit(q).alias("priority")) for p, q in pages])).alias("x")).select("x.*")
    years = spark.range(first_year, last_year + 1).select(F.col("id").alias("y"), F.explode(F.sequence(F.lit(1), F.lit(12))).alias("m"))
    age = F.lit(as_of_year) - F.col("y")
    monthly = years.select(F.format_string("/archive/%d/%02d", "y", "m").alias("path"), F.when(age <= 0, "0.8").when(age <= 2, "0.6").otherwise("0.4").alias("priority"))
    return fixed.unionByName(monthly)


def json_lines(df: DataFrame, key: Column, columns: Sequence[str], order: str) -> DataFrame:
    """(key, lines): each key's rows as JSON lines. For small keys such as a day's links; jsonl_files is for any size."""
    rows = df.select(key.alias("key"), F.col(order).alias("__o"), F.to_json(F.struct(*columns)).alias("__j"))
    return rows.groupBy("key").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("__o", "__j"))).alias("__x")).select("key", "n", F.array_join(F.transform("__x", lambda x: x["__j"]), "\n").alias("lines"))


def jsonl_files(df: DataFrame, path: str, *partitions: str) -> None:
    """Append JSON lines, a folder for each value of partitions; Spark splits large ones over files."""
    writer = df.write.mode("append")
    (writer.partitionBy(*partitions) if partitions else writer).json(path)


def write_archive(df: DataFrame, path: str, ts: str = "ts") -> None:
    """Months as partitions; only the months in df are replaced. df must not read path: store.Store may replace what it reads."""
    df.withColumn("year", F.date_format(ts, "yyyy")).withColumn("month", F.date_format(ts, "MM")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("year", "month").json(path)


def write_snapshot(df: DataFrame, path: str, day: str) -> bool:
    """A day's snapshot, written once; False if there is one."""
    target = f"{path}/snapshot_date={day}"
    spark = df.sparkSession
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(target)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return False
    df.write.mode("ignore").json(target)
    return True


def _first(df: DataFrame, order: Sequence[Column], most: int) -> DataFrame:
    """One row: n, and rows, an array of the first most rows by order. most bounds what one task holds."""
    top = df.orderBy(*order).limit(most).withColumn("__n", F.row_number().over(Window.orderBy(*order)))
    return top.agg(F.count("*").alias("n"), F.transform(F.array_sort(F.collect_list(F.struct("__n", F.struct(*df.columns).alias("row")))), lambda x: x["row"]).alias("rows"))


def expired_snapshots(snapshots: DataFrame, as_of: Column, day: str = "snapshot_date", days: int = 365) -> DataFrame:
    """Snapshots, by the text of their day, that are more than days old at as_of; what names no day stays."""
    then = F.try_to_timestamp(F.col(day), F.lit("yyyy-MM-dd"))
    return snapshots.filter(F.coalesce(then < as_of - F.make_dt_interval(days=F.lit(days)), F.lit(False)))


def prune_snapshots(spark: SparkSession, path: str, as_of: Column, days: int = 365) -> list[str]:
    """Remove the folders of expired snapshots below path, at most one a day; their names."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in files.listStatus(at)] if files.exists(at) else []
    held = spark.createDataFrame([(n, n.removeprefix("snapshot_date=")) for n in names], "name string, snapshot_date string")
    gone = sorted(r.name for r in expired_snapshots(held, as_of, days=days).collect())
    for name in gone:
        files.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}"), True)
    return gone


def snapshot(df: DataFrame, header: dict[str, str], order: Sequence[Column], items: str = "items", most: int = 1000) -> DataFrame:
    """One object: header fields, the count, and the first most rows by order."""
    return _first(df, order, most).select(F.col("n").alias("count"), F.col("rows").alias(items)).select(F.to_json(F.struct(*[F.lit(v).alias(k) for k, v in header.items()], "count", items)).alias("value"))


def rss(df: DataFrame, title: str, link: str, order: Sequence[Column], most: int = 150) -> DataFrame:
    """An RSS document of df's first most rows (title, link, description) by order."""
    element = lambda row, c: F.concat(F.lit(f"<{c}>"), xml_escape(F.coalesce(row[c], F.lit(""))), F.lit(f"</{c}>"))
    item = lambda row: F.concat(F.lit("<item>"), *[element(row, c) for c in ("title", "link", "description")], F.lit("</item>"))
    head = f'<?xml version="1.0" encoding="UTF-8"?><rss version="2.0"><channel><title>{title}</title><link>{link}</link>'
    return _first(df, order, most).select(F.concat(F.lit(head), F.array_join(F.transform("rows", item), ""), F.lit("</channel></rss>")).alias("value"))


def health_page(summary: DataFrame, broken: DataFrame, most: int = 100) -> DataFrame:
    """An HTML report of AGG health and the first most broken feeds (name, error)."""
    row = F.concat(F.lit("<tr><td>"), xml_escape(F.col("name")), F.lit("</td><td>"), xml_escape(F.coalesce("error", F.lit(""))), F.lit("</td></tr>"))
    rows = broken.orderBy("name").limit(most).agg(F.array_join(F.collect_list(row), "").alias("rows"))
    return summary.crossJoin(F.broadcast(rows)).select(F.format_string("<h1>Feeds: %d of %d healthy</h1><table>%s</table>", "healthy", "total", "rows").alias("value"))  # one row each
