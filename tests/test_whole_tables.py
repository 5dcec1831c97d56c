"""Queries that must take whole tables in, against their SQL in DuckDB."""

import duckdb
import pytest

from quillgrid.operators import linking
from quillgrid.plans import catalog
from quillgrid.plans.engine import SignalEngine
from quillgrid.sources.signals import union

from .conftest import DATA


def held_to_sql(spark, name, size="sf0.001"):
    """The query's rows, after comparing them with those of its SQL."""
    rows = [tuple(r) for r in catalog.queries()[name](spark, f"{DATA}/{size}").collect()]
    with duckdb.connect() as con:
        con.execute("SET TimeZone='UTC'")
        for f in (DATA / size).glob("*.parquet"):
            con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}{'/*.parquet' if f.is_dir() else ''}'")
        want = con.execute(catalog.oracle_sql()[name]).fetchall()
    assert sorted(rows, key=str) == sorted(want, key=str)
    return rows


@pytest.mark.parametrize("name", ["upsert_selected_cols", "insert_only_merge"])
def test_customer_merges_take_every_key(spark, name):
    keys = {r.c_custkey for r in spark.read.parquet(f"{DATA}/sf0.001/customer.parquet").collect()}
    rows = held_to_sql(spark, name)
    assert {r[0] for r in rows} == keys and {r[-1] for r in rows} == {"old", "new"}


@pytest.mark.parametrize("name", ["anti_join_new", "set_difference", "case_left_join", "removed_keys", "cluster_signals", "feed_recovery", "delayed_airports", "action_summary", "severity_counts", "clean_agency", "notice_types", "dispatch_fields", "place_lookup", "static_sitemap", "airport_status", "agency_points", "era_articles", "milepost_geocode", "tiered_places", "page_facts"])
def test_held_to_sql(spark, name):
    assert held_to_sql(spark, name)


def test_json_lines_take_every_event(spark):
    events = spark.read.parquet(f"{DATA}/sf0.001/events.parquet").collect()
    rows = [r[0] for r in held_to_sql(spark, "merge_every_json_line")]
    assert sum(r.startswith("broken") for r in rows) == sum(e.event_type == "error" for e in events)
    assert len({(e.user_id, e.ts.day) for e in events}) == sum(r.startswith("{") for r in rows)


def test_engine_summary_needs_each_step(spark, monkeypatch):
    right = sorted(held_to_sql(spark, "engine_summary"), key=str)
    related = linking.related
    for where, name, f in [(SignalEngine, "merge", lambda self, *frames: union(frames).selectExpr("* EXCEPT (relatedSignalIds)", "array('x') AS relatedSignalIds")), (SignalEngine, "rolling", lambda self, signals: signals), (linking, "related", lambda *a, **b: related(*a, **b).limit(1))]:
        with monkeypatch.context() as m:
            m.setattr(where, name, f)
            assert sorted((tuple(r) for r in catalog.queries()["engine_summary"](spark, f"{DATA}/sf0.001").collect()), key=str) != right, name


def test_related_gives_every_event_an_entity(spark):
    assert all(related for _, related in held_to_sql(spark, "related_by_entity"))
