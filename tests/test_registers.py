"""Registers, bulletins and small rules, against their SQL and by hand."""

import pytest

from quillgrid.sources import pages

from .test_whole_tables import held_to_sql


@pytest.mark.parametrize("name", ["bulletin_links", "bare_pages", "event_times", "missing_register", "vehicle_register", "fisheries_entries"])
def test_held_to_sql(spark, name):
    assert held_to_sql(spark, name)


def test_bulletins(spark):
    html = [
        '<A HREF="/getmedia/1/Doe.pdf" title=" Jane DOE "><img alt="" src="/a.png"/></A><a href="/getmedia/2/x/Jon.pdf">t<img src="/b.png"></a>',
        '<a href="/other/Jon.pdf"><img src="/c.png"></a><a href="/getmedia/3/Jon.pdf">no picture</a><a\ntitle="jane doe" href="/getmedia/4"><img src="/d.png"></a>',
        None, "", "<a href='/getmedia/5/jon.pdf'><img src='/e.png'></a><a href='/getmedia/6/JON.pdf' title=''><img src='/f.png'></a>",
    ]
    df = spark.createDataFrame(list(enumerate(html)), "page_id long, html string").repartition(3)
    got = sorted(map(tuple, pages.bulletins(df, base="https://x").collect()))
    assert got == [("jane doe", "https://x/getmedia/4", "https://x/d.png"), ("jon", "https://x/getmedia/6/JON.pdf", "https://x/f.png")]
    assert pages.bulletins(df.limit(0)).count() == 0
