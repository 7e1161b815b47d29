"""Url rules and trust along links."""

import duckdb
import pytest

pytest.importorskip("airshed.llm")

from airshed.llm import sql, url_filter  # noqa: E402

PAGES = "page_id long, url string, html string, HOST string"


def link(*urls):
    return "".join(f'<p><a class=x href="{u}">t</a>' for u in urls)


ROWS = [
    (1, "http://Good.example.net/en/1", link("https://a.com/x", "http://a.com/y", "/local", "http://b.com?q=1")),
    (2, "https://bad.NET/x", link("http://a.com/")),
    (3, "http://a.com/p", link("http://c.com/", "http://a.com/self")),
    (4, "http://c.com", None),
    (5, "http://farm.com/1", "<A HREF='http://bad.net/'>x</A>" * 3),
    (6, "http://farm2.com/1#x", link("http://farm.com/") * 50),
    (7, "http://lonely.com/", ""),
    (8, None, "<a href=http://a.com>"),
    (9, "no host", link("http://bad.net/")),
    (10, "http://sub.example.com/de/7?a://b", ""),
    (10, "http://sub.example.com/de/7?a://b", ""),
    (11, "http://www.free.org/fr/", link("http://bad.net/")),
    (12, "http://net/", ""),
    (13, "http://xnet/", ""),
    (14, "http://bad2.net", ""),
    (15, "http://u@h.net:80/a\nb?c", "<a " + "x" * 200_000),
    (16, "://", link("http://:///")),
]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(*r, "kept") for r in ROWS], PAGES)


def test_verdicts(pages):
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    verdict = {i: r["verdict"] for i, r in got.items()}
    assert (got[1].rule, verdict[1]) == ("example.net/en/", "allow") and got[1]["_host"] == "good.example.net"
    assert (got[2].rule, verdict[2]) == ("net/", "block") and got[2]["HOST"] == "kept"
    assert verdict[3] == "allow" and got[3].trust > 0  # a trusted page links to it
    assert verdict[4] == "allow" and got[4].trust > got[4].distrust
    assert verdict[5] == "block" and got[5].rule is None  # links to a blocked host
    assert verdict[6] == "block"  # links to one that does
    assert [verdict[i] for i in (7, 8, 9)] == ["allow"] * 3 and got[8]["_host"] == "" and got[9].path == ""
    assert (got[10].rule, verdict[10]) == ("example.com/de/", "block") and got[10].path == "/de/7"
    assert (got[11].rule, verdict[11]) == ("org/fr/", "allow")
    assert got[12].rule == "net/" and got[13].rule is None
    assert got[14].rule is None and got[14].path == ""  # an empty path doesn't start with /
    assert got[15]["_host"] == "u@h.net:80" and got[15].path == "/a\nb" and got[15].rule is None
    assert url_filter.judged(pages).count() == len(ROWS)


def test_against_sql(spark, pages, tmp_path):
    pages.drop("HOST").write.parquet(str(tmp_path / "pages.parquet"))
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    want = sorted(con.execute(sql.urls()).fetchall(), key=repr)
    got = [tuple(r) for r in url_filter.digest(pages).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert sorted(got, key=repr) == want


def test_walks_carry_what_page_rank_says(spark):
    edges = spark.createDataFrame([("t", "a", "b", 0.5), ("t", "a", "c", 0.5), ("t", "b", "a", 1.0)], "kind string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("t", "a", 1.0)], "kind string, host string, score double")
    got = {r.host: r.score for r in url_filter.spread(edges, seeds, steps=60, damping=0.5).collect()}
    a = 0.5 / (1 - 0.125)  # a = 0.5 + 0.5 b, b = 0.25 a
    assert got == pytest.approx({"a": a, "b": a / 4, "c": a / 4})


def test_far_hosts_are_reached(spark):
    n = 30
    chain = [(i, f"http://h{i}.com/", link(f"http://h{i + 1}.com/" if i < n else "http://bad.net/")) for i in range(1, n + 1)]
    pages = spark.createDataFrame([(*r, "kept") for r in [*chain, (0, "http://bad.net/x", "")]], PAGES)
    got = {r.page_id: r for r in url_filter.judged(pages).collect()}
    assert all(r["verdict"] == "block" for r in got.values())
    assert got[1].distrust == pytest.approx(0.15 * 0.85**n)


def test_walks_go_on_until_little_is_left(spark):
    edges = spark.createDataFrame([("t", "a", "b", 1.0), ("t", "b", "a", 1.0), *[("t", f"c{i}", f"c{i + 1}", 1.0) for i in range(20)]],
                                  "kind string, src string, dst string, weight double")
    seeds = spark.createDataFrame([("t", "a", 0.5), ("t", "c0", 0.5)], "kind string, host string, score double")
    got = {r.host: r.score for r in url_filter.spread(edges, seeds, damping=0.5, tolerance=1e-4).collect()}
    a = 0.25 / (1 - 0.25)
    assert got["a"] == pytest.approx(a, abs=1e-4) and got["b"] == pytest.approx(a / 2, abs=1e-4)
    assert got["c20"] == pytest.approx(0.25 * 0.5**20)  # reached, however little


def test_no_pages(spark):
    assert url_filter.judged(spark.createDataFrame([], PAGES)).count() == 0
