"""Queries that write tables, replace them while they read them, and read them back; carried values and batches against a history."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest, merge, ranking
from ..operators.store import Store
from ..session import scratch, settle
from ..sources import daily, snapshots
from .frames import AS_OF, EVENTS, as_of, events, table
from .queries import query

_ROW = "seq, md5('u'||user_id) AS hash, ts, sector, impact"


def _signals(spark, d):
    return events(spark, d).select("seq", F.md5(F.concat(F.lit("u"), "user_id").cast("binary")).alias("hash"), "ts", "sector", "impact")


@query(f"""SELECT hash, strftime(ts, '%Y-%m') AS month, seq, sector, impact FROM (SELECT {_ROW}, CASE sector WHEN 'click' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS run FROM {EVENTS})
QUALIFY row_number() OVER (PARTITION BY hash, month ORDER BY run DESC, seq DESC) = 1""")
def archive_store(spark, d):
    """An archive of months after three runs, each of which merges into the months that it reads."""
    store, e = Store(spark, scratch(spark, "archive")), _signals(spark, d)
    for run in (F.col("sector") == "click", F.col("sector") == "view", ~F.col("sector").isin("click", "view")):
        store.upsert_months(e.filter(run), ["hash"], seq="seq")
    return store.read().select("hash", F.date_format("ts", "yyyy-MM").alias("month"), "seq", "sector", "impact")


@query(f"""SELECT hash, seq, sector FROM (SELECT {_ROW} FROM {EVENTS}) WHERE ts >= TIMESTAMP '{AS_OF}' - INTERVAL 20 DAY QUALIFY row_number() OVER (PARTITION BY hash ORDER BY seq DESC) = 1""")
def rolling_store(spark, d):
    """The rolling table, written with half of the rows, then twice replaced by what is made of itself."""
    store, e = Store(spark, scratch(spark, "rolling")), _signals(spark, d)
    store.replace(e.filter("impact < 50"))
    store.replace(merge.priority_merge([store.read(), e.filter("impact >= 50 OR impact IS NULL")], ["hash", "seq"], last_wins=True))
    store.replace(merge.keep_last(store.read().filter(F.col("ts") >= as_of() - F.expr("INTERVAL 20 DAYS")), ["hash"]))
    return store.read().select("hash", "seq", "sector")


@query("""SELECT conv_id, turn, last_value(CASE WHEN role='user' THEN md5(text) END IGNORE NULLS) OVER w AS heading, last_value(CASE WHEN turn = 0 THEN conv_id END IGNORE NULLS) OVER w AS opened
FROM conversations WINDOW w AS (ORDER BY conv_id, turn ROWS UNBOUNDED PRECEDING)""")
def carried_headings(spark, d):
    """Headings carried over the whole table, across conversations too."""
    c = table(spark, d, "conversations").select("conv_id", "turn", F.when(F.col("role") == "user", F.md5(F.col("text").cast("binary"))).alias("heading"), F.when(F.col("turn") == 0, F.col("conv_id")).alias("opened"))
    return ranking.fill_forward(c, ["heading", "opened"], ["conv_id", "turn"])


_BATCH = "md5(user_id||'/'||hour(ts)) AS hash, event_id AS seq"


@query(f"""SELECT hash, min(seq) AS seq FROM (SELECT {_BATCH} FROM events WHERE event_type IN ('error', 'purchase')) WHERE hash NOT IN (SELECT hash FROM (SELECT {_BATCH}, event_type FROM events) WHERE event_type IN ('click', 'view'))
GROUP BY hash""")
def new_against_history(spark, d):
    """What a batch has that no earlier run had seen."""
    e = table(spark, d, "events").select(F.md5(F.concat(F.col("user_id"), F.lit("/"), F.hour("ts")).cast("binary")).alias("hash"), F.col("event_id").alias("seq"), "event_type")
    batch, history = e.filter("event_type IN ('error', 'purchase')"), e.filter("event_type IN ('click', 'view')")
    return merge.only_new_of_history(batch.drop("event_type"), history, ["hash"])


@query("""SELECT sha256(d||'/'||b||'/'||payload) AS batch, rows, payload FROM (
  SELECT d, b, count(*) AS rows, '['||string_agg(j, ',' ORDER BY n)||']' AS payload FROM (
    SELECT d, j, n, n // 50 AS b FROM (SELECT d, j, row_number() OVER (PARTITION BY d ORDER BY j) - 1 AS n FROM (
      SELECT j, substring(md5(j), 1, 2) AS d FROM (SELECT to_json({id: doc_id, source: source, category: lang, text: md5(text)})::VARCHAR AS j FROM documents))))
  GROUP BY d, b)""")
def ingest_payloads(spark, d):
    """The batches that an ingest endpoint gets, with their idempotency keys."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source", F.col("lang").alias("category"), F.md5(F.col("text").cast("binary")).alias("text"))
    return ingest.ingest_batches(rows)


_STAMP = "CASE WHEN page_id % 3 = 0 THEN '2019' ELSE '2020' END || '0' || (page_id % 9 + 1) || '15' || '120000'"


@query(f"""SELECT md5(incident) AS hash, incident, location, type, md5(text) AS text, strftime(ts, '%Y-%m-%d') AS day FROM (
  SELECT 'AK'||(1000000 + page_id) AS incident, lang AS location, coalesce(nullif(host, ''), 'Incident') AS type, text,
    CASE WHEN page_id % 2 = 0 THEN TIMESTAMP '2018-03-04' ELSE date_trunc('day', strptime({_STAMP}, '%Y%m%d%H%M%S')) END AS ts
  FROM (SELECT page_id, regexp_extract(html, 'lang="([a-z]+)"', 1) AS lang, regexp_extract(url, '//([^/]+)', 1) AS host, trim(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1), '\\s+', ' ', 'g')) AS raw, html, url,
      replace(replace(replace(replace(replace(raw, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;', '&') AS text FROM pages)
  WHERE length(text) >= 20)""")
def backfilled_snapshots(spark, d):
    """Incidents of archived pages, by a stream over their manifest that stops after two batches and goes on later."""
    p = table(spark, d, "pages")
    stamp = F.concat(F.when(F.col("page_id") % 3 == 0, "2019").otherwise("2020"), F.lit("0"), F.col("page_id") % 9 + 1, F.lit("15120000"))
    posted = F.when(F.col("page_id") % 2 == 0, F.lit(r" Posted on 3/4/2018 by DPS\x")).otherwise(F.lit(""))
    item = F.concat(
        F.lit('<ul><li class="x"><a href="/Home/DisplayIncident?incidentNumber=AK'), F.col("page_id") + 1_000_000, F.lit('">More</a><br>Location: '), F.regexp_extract("html", 'lang="([a-z]+)"', 1),
        F.lit("<br>Type: "), F.regexp_extract("url", "//([^/]+)", 1), F.lit("<br>Dispatch Text: "), F.regexp_extract("html", "<title>([^<]*)</title>", 1), posted, F.lit("</li></ul>"), F.col("html"),
    )
    held = settle(p.select(stamp.alias("stamp"), F.concat(F.lit("/"), F.col("page_id")).alias("original"), F.col("page_id").alias("id"), item.alias("body")), "pages")
    manifest, out, mark = (scratch(spark, n) for n in ("manifest", "snapshots", "checkpoint"))
    held.select("stamp", "original").write.json(manifest)
    per_batch = -(-held.count() // 5)
    where = held.inputFiles()[0].rpartition("/")[0]

    def fetch(entries):
        from pyarrow import dataset, fs as files

        system, at = files.FileSystem.from_uri(where)
        names = [f.path for f in system.get_file_info(files.FileSelector(at)) if f.base_name.startswith("part-")]
        wanted = [int(original[1:]) for _, original in entries]
        rows = dataset.dataset(names, filesystem=system, format="parquet").to_table(columns=["id", "body"], filter=dataset.field("id").isin(wanted)).to_pylist()
        bodies = {r["id"]: r["body"] for r in rows}
        for i in wanted:
            yield 200, bodies[i]

    for batches in (2, None):
        snapshots.backfill(spark, fetch, manifest, out, mark, per_batch, batches, per_task=-(-per_batch // 8))
    found = snapshots.snapshot_incidents(spark.read.schema(snapshots.SCHEMA).parquet(out))
    return found.select("hash", "incident", "location", "type", F.md5(F.col("text").cast("binary")).alias("text"), F.date_format("ts", "yyyy-MM-dd").alias("day"))


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, row_number() OVER (PARTITION BY strftime(ts, '%Y-%m-%d') ORDER BY event_id)::INT - 1 AS position, event_id AS id, event_type AS kind
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-09'""")
def daily_files(spark, d):
    """A week out of daily files that hold all events."""
    path = scratch(spark, "daily")
    e = table(spark, d, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("kind"), F.to_date("ts").alias("day"))
    daily.write_daily(e, path, "day", "id", ["id", "kind"])
    week = daily.read_daily(spark, path).filter("day >= DATE '2024-01-03' AND day <= DATE '2024-01-09'")
    item = F.from_json("item", "id long, kind string")
    return week.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "position", item["id"].alias("id"), item["kind"].alias("kind"))
