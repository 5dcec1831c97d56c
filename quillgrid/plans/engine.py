"""The whole batch: raw feed entries and other producers' signals in, an archive and published tables out."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import catalogs as C
from ..functions.keys import title_link_key
from ..functions.text import clean_text, data_tag, snippet_of_clean
from ..functions.times import parse_iso, resolve_published, url_date, within
from ..functions.urls import resolve_tracker
from ..operators import aggregates, filters, linking, merge
from ..operators.store import Store
from ..sources.signals import adapt, union


def _spread(df: DataFrame, order: str) -> DataFrame:
    """df dealt evenly: a choice of one row a hash sorts its input first, which for a scan may be a whole file."""
    return df.repartition("hash", order)


@dataclass(frozen=True)
class SignalEngine:
    """as_of stands for now. days: what the rolling table keeps. Catalogs are the defaults unless given."""

    as_of: str
    days: int = 60
    regions: Sequence = tuple(C.TAG_REGIONS)
    typed: Sequence = tuple(C.TYPED_REGIONS)
    entities: Sequence = tuple(C.ENTITIES)

    @property
    def now(self) -> Column:
        return F.lit(self.as_of).cast("timestamp")

    def enrich(self, entries: DataFrame, seen: DataFrame) -> DataFrame:
        """Signals of feed entries (source, category, title, link, description, published, seq) that seen (hash) lacks."""
        df = entries.withColumn("link", resolve_tracker(F.col("title"), F.col("link"))).filter(filters.has_title_and_link(F.col("title"), F.col("link")))
        df = df.filter(~filters.is_bad_item(F.col("title"), F.col("link"), F.col("description"), F.col("source")))
        df = df.withColumn("hash", title_link_key(F.col("title"), F.col("link")))
        dated = resolve_published(parse_iso(F.col("published")), url_date(F.col("link")), self.now)
        df = df.withColumn("ts", dated).withColumn("__t", clean_text(F.col("description")))
        df = df.withColumn("summary", snippet_of_clean(F.col("__t")))
        whole, low = F.lower(F.concat_ws(" ", "title", "__t")), F.lower(F.concat_ws(" ", "title", "summary"))
        df = df.withColumns({
            "dataTag": data_tag(filters.region(whole, self.regions), F.col("category")), "sourceAttribution": F.col("source"), "timestamp": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "impactScore": filters.impact_score(F.col("category"), low), "region": filters.region(low, self.typed), "sector": filters.sector(F.col("category")), "entitySlugs": filters.entity_slugs(low, self.entities),
        })
        # Whole texts end here: only what is made of them is dealt out and sorted.
        df = merge.only_new(_spread(df.drop("description", "__t"), "seq"), seen, ["hash"]).filter(filters.young_enough(F.col("ts"), self.now))
        return adapt(df.withColumn("urgency", filters.urgency(F.col("impactScore"))))

    def merge(self, old: DataFrame, *new: DataFrame) -> DataFrame:
        """Old and new signals, the last of each hash by arrival: later frames first, in a frame the highest seq; rows
        without seq come before those with it, by time and title. Rows without a web link go; related signals are linked."""
        frames = [f.withColumns({"__b": F.lit(k), "seq": F.col("seq") if "seq" in f.columns else F.lit(None).cast("long")}) for k, f in enumerate([old, *new])]
        both = union(frames).filter(filters.is_web_link(F.col("link")))
        ordered = _spread(both.withColumn("__o", F.struct("__b", "seq", "timestamp", "title")), "__o")
        kept = merge.keep_last(ordered, ["hash"], "__o").drop("__b", "__o", "seq")
        kept = linking.settled(kept)  # linking reads it many times over
        ranked = kept.withColumn("seq", F.struct((-F.coalesce(F.unix_micros("ts"), F.lit(0))).alias("t"), "hash"))
        links = linking.related(ranked, entities="entitySlugs").select("hash", F.col("related").alias("__r"))
        return kept.join(links, "hash", "left").withColumn("relatedSignalIds", F.col("__r")).drop("__r")

    def archive(self, store: Store, signals: DataFrame) -> int:
        """Bring signals into the months of an archive, the last of each hash and month; its new version."""
        return store.upsert_months(signals.filter(F.col("ts").isNotNull()), ["hash"])

    def rolling(self, signals: DataFrame) -> DataFrame:
        return signals.filter(within(F.col("ts"), self.now, self.days * 86_400) & F.col("ts_has_offset"))

    def pulse(self, signals: DataFrame) -> DataFrame:
        groups = {"health": ["health", "safety"], "subsistence": ["fisheries", "subsistence"], "economy": ["economy", "energy"]}
        return aggregates.pulse(signals.filter("ts_has_offset"), groups, self.now, impact="impactScore")

    def summary(self, signals: DataFrame) -> DataFrame:
        return aggregates.summary_counts(signals, "category", "source")

    def slices(self, signals: DataFrame) -> tuple[DataFrame, DataFrame]:
        """The last day and the last week."""
        return tuple(signals.filter(within(F.col("ts"), self.now, d * 86_400)) for d in (1, 7))
