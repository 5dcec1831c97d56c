"""Queries that find things in whole texts: names of a gazetteer, vehicles and people, broken markup, news each told once."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import extract as X
from ..functions.markup import NAME, PIECE, VOID, close_open
from ..operators import gazetteer, merge, places
from .frames import table
from .queries import query

#: Names of one to four words, as a gazetteer: the first words of the benchmark's texts, and two common words.
_NAMES = """(SELECT array_to_string(w[1:n], ' ') AS name, 'item'||(n) AS label FROM (SELECT regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+') AS w FROM benchmark), (SELECT unnest(range(2, 5)) AS n) WHERE len(w) >= n
  UNION SELECT 'the', 'common' UNION SELECT 'de la', 'common')"""


@query(f"""WITH names AS (SELECT name, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, len(string_split(name, ' ')) AS n FROM {_NAMES} GROUP BY name),
words AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}]+') AS w FROM documents),
places AS (SELECT doc_id, unnest(range(len(w))) AS place, w FROM words),
met AS (SELECT doc_id, place, n, name, labels FROM (SELECT doc_id, place, k, array_to_string(w[place + 1 : place + k], ' ') AS name FROM places, (SELECT unnest(range(1, 5)) AS k) WHERE place + k <= len(w)) JOIN names USING (name) WHERE k = n),
longest AS (SELECT doc_id, place, max(n) AS n, arg_max(name, n) AS name, arg_max(labels, n) AS labels FROM met GROUP BY doc_id, place),
kept AS (SELECT doc_id, unnest(list_reduce(list([{{'place': place, 'n': n, 'name': name, 'labels': labels}}] ORDER BY place), lambda a, x: CASE WHEN x[1].place >= a[-1].place + a[-1].n THEN list_concat(a, x) ELSE a END)) AS m FROM longest GROUP BY doc_id)
SELECT doc_id, m.place::INT AS place, m.n::INT AS words, m.name AS name, m.labels AS labels FROM kept""")
def gazetteer_entities(spark, d):
    words = gazetteer.words_of(F.col("text"))
    items = table(spark, d, "benchmark").select(words.alias("w")).select("w", F.explode(F.array(*[F.lit(n) for n in (2, 3, 4)])).alias("n")).filter(F.size("w") >= F.col("n"))
    names = items.select(F.array_join(F.slice("w", F.lit(1), F.col("n")), " ").alias("name"), F.concat(F.lit("item"), "n").alias("label"))
    names = names.unionByName(spark.createDataFrame([("The", "common"), ("de la", "common")], "name string, label string"))
    return gazetteer.gazetteer_matches(table(spark, d, "documents"), names, row="doc_id")


_W = "[\\p{L}\\p{N}_]+"
#: A street grid: what each two or three following words, at every third place, of the benchmark's texts say, placed by length.
_STREETS = f"""(SELECT DISTINCT name, 60 + length(name)::DOUBLE / 100 AS lat, -150 - length(name)::DOUBLE / 10 AS lng FROM (SELECT regexp_replace(array_to_string(w[i:i + n - 1], ''), '^[^\\p{{L}}\\p{{N}}_]+', '') AS name
  FROM (SELECT w, n, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT regexp_extract_all(lower(text), '[^\\p{{L}}\\p{{N}}_]*{_W}') AS w FROM benchmark), (SELECT unnest(range(2, 4)) AS n)) WHERE i % 3 = 1))"""


@query(f"""WITH streets AS {_STREETS},
words AS (SELECT doc_id, regexp_extract_all(lower(text), '[^\\p{{L}}\\p{{N}}_]*{_W}') AS w FROM documents),
spans AS (SELECT doc_id, regexp_replace(array_to_string(w[i:i + n - 1], ''), '^[^\\p{{L}}\\p{{N}}_]+', '') AS name FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM words, (SELECT unnest(range(2, 4)) AS n))),
best AS (SELECT doc_id, name AS street, lat, lng FROM spans JOIN streets USING (name) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY length(name) DESC, name) = 1)
SELECT doc_id, street, round(lat, 6) AS lat, round(lng - CASE WHEN doc_id % 3 > 0 THEN ((doc_id * 37) % 9000) / 100 * 0.0016::DOUBLE ELSE 0 END, 6) AS lng FROM documents LEFT JOIN best USING (doc_id)""")
def street_grid(spark, d):
    """The longest street of a grid that each whole text names; two thirds of the texts begin with a block."""
    w = F.regexp_extract_all(F.lower("text"), F.lit(r"[^\p{L}\p{N}_]*[\p{L}\p{N}_]+"), 0)
    spans = table(spark, d, "benchmark").select(w.alias("w")).select("w", F.explode(F.array(F.lit(2), F.lit(3))).alias("n")).filter(F.size("w") >= F.col("n"))
    spans = spans.select("w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("at")).filter("at % 3 = 1")
    name = F.regexp_replace(F.array_join(F.slice("w", F.col("at"), F.col("n")), ""), r"^[^\p{L}\p{N}_]+", "")
    streets = spans.select(name.alias("name")).select("name", (60 + F.length("name") / 100).alias("lat"), (-150 - F.length("name") / 10).alias("lng"))
    block = F.when(F.col("doc_id") % 3 > 0, F.concat((F.col("doc_id") * 37) % 9000, F.lit(" block: "))).otherwise("")
    found = places.street_points(table(spark, d, "documents").select("doc_id", F.concat(block, F.coalesce("text", F.lit(""))).alias("text")), streets, "doc_id", "text")
    return found.select("doc_id", "street", F.round("lat", 6).alias("lat"), F.round("lng", 6).alias("lng"))


_ASCII = "regexp_replace(text, '[^\\x00-\\x7F]', 'x', 'g')"


@query(f"""SELECT doc_id, array_to_string(list_filter(list_distinct_in_order, lambda v: true), '|') AS vehicles, array_to_string(people, '|') AS people FROM (
  SELECT doc_id, list_reduce(list_prepend([]::VARCHAR[], list_transform(list_filter(phrases, lambda v: length(v) > 3), lambda v: [v])), lambda a, x: CASE WHEN list_contains(a, x[1]) THEN a ELSE list_concat(a, x) END) AS list_distinct_in_order,
    list_reduce(list_prepend([]::VARCHAR[], list_transform(list_filter(list_transform(regexp_extract_all(t, '\\b(?:The|Der|Die|La|Le)\\.?\\s+((?:[A-Z][a-z]+)(?:\\s+(?:[A-Z]\\.|[A-Z][a-z]+)){{0,2}})', 1), lambda n: regexp_replace(n, '\\s+', ' ', 'g')), lambda n: length(n) > 4), lambda v: [v])), lambda a, x: CASE WHEN list_contains(a, x[1]) THEN a ELSE list_concat(a, x) END) AS people
  FROM (SELECT doc_id, t, list_transform(p, lambda x, i: regexp_replace(trim(right(array_to_string(p[greatest(1, i - 8):i], ''), length(regexp_extract(x, '(?is)\\b(the|und|les|que)$', 1)) + 15), ' '), '^[^A-Z]*', '')) AS phrases
    FROM (SELECT doc_id, t, regexp_extract_all(t, '(?is).*?\\b(?:the|und|les|que)\\b') AS p FROM (SELECT doc_id, {_ASCII} AS t FROM documents))))""")
def vehicles_and_people(spark, d):
    """The rules for vehicles and people, over words that the documents have."""
    t = F.regexp_replace("text", "[^\\x00-\\x7F]", "x")
    found = table(spark, d, "documents").select("doc_id", X.vehicles(t, ("the", "und", "les", "que")).alias("v"), X.people(t, titles="The|Der|Die|La|Le").alias("p"))
    return found.select("doc_id", F.array_join("v", "|").alias("vehicles"), F.array_join("p", "|").alias("people"))


_KEYS = "doc_id AS seq, source||(n_chars % 41) AS a, lang||(n_chars % 59) AS b"


@query(f"""SELECT unnest(list_reduce(list([{{'seq': seq, 'a': a, 'b': b}}] ORDER BY seq), lambda acc, x: CASE WHEN len(list_filter(acc, lambda k: k.a = x[1].a OR k.b = x[1].b)) > 0 THEN acc ELSE list_concat(acc, x) END), recursive := true)
FROM (SELECT {_KEYS} FROM documents)""")
def either_key_first(spark, d):
    """The sequential rule over all documents: neither key was taken by one that stayed before."""
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("seq"), F.concat("source", F.col("n_chars") % 41).alias("a"), F.concat("lang", F.col("n_chars") % 59).alias("b"))
    return merge.first_by_either(rows, "a", "b")


_VOID = ", ".join(f"'{v}'" for v in VOID)
_STEP = f"""CASE WHEN x.seg = '<' THEN {{'stack': a.stack, 'out': a.out || '&lt;', 'seg': ''}}
  WHEN starts_with(x.seg, '<!--') THEN a
  WHEN regexp_extract(x.seg, '{NAME}', 1) = '' THEN {{'stack': a.stack, 'out': a.out || x.seg, 'seg': ''}}
  WHEN starts_with(x.seg, '</') THEN CASE WHEN list_contains(list_transform(a.stack, lambda n: lower(n)), lower(regexp_extract(x.seg, '{NAME}', 1)))
    THEN {{'stack': a.stack[list_position(list_transform(a.stack, lambda n: lower(n)), lower(regexp_extract(x.seg, '{NAME}', 1))) + 1 :],
      'out': a.out || array_to_string(list_transform(a.stack[1 : list_position(list_transform(a.stack, lambda n: lower(n)), lower(regexp_extract(x.seg, '{NAME}', 1)))], lambda n: '</' || n || '>'), ''), 'seg': ''}} ELSE a END
  WHEN ends_with(x.seg, '/>') THEN {{'stack': a.stack, 'out': a.out || x.seg, 'seg': ''}}
  WHEN lower(regexp_extract(x.seg, '{NAME}', 1)) IN ({_VOID}) THEN {{'stack': a.stack, 'out': a.out || regexp_replace(x.seg, '>$', '/>'), 'seg': ''}}
  ELSE {{'stack': list_prepend(regexp_extract(x.seg, '{NAME}', 1), a.stack), 'out': a.out || x.seg, 'seg': ''}} END"""


@query(f"""SELECT page_id, length(s) AS n, md5(s) AS m FROM (SELECT page_id, r.out || array_to_string(list_transform(r.stack, lambda n: '</' || n || '>'), '') AS s FROM (
  SELECT page_id, list_reduce(list_prepend({{'stack': []::VARCHAR[], 'out': '', 'seg': ''}}, list_transform(regexp_extract_all(html, '{PIECE}'), lambda p: {{'stack': []::VARCHAR[], 'out': '', 'seg': p}})), lambda a, x: {_STEP}) AS r FROM pages))""")
def closed_markup(spark, d):
    closed = close_open(F.col("html"))
    return table(spark, d, "pages").select("page_id", closed.alias("s")).select("page_id", F.length("s").alias("n"), F.md5(F.col("s").cast("binary")).alias("m"))
