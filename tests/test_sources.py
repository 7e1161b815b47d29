import json

import pytest
from conftest import as_set, dicts
from pyspark.sql import functions as F

from airshed.config import AQO_STATIONS, WEATHER_STATIONS
from airshed.operators.grouping import literal_rows
from airshed.sources import files, geojson, html, manifest
from airshed.sources.schemas import ACTIVE_FIRES, EVACUATION_LOG, struct
from airshed.streaming.polls import append_snapshot


def feature(i, coordinates, props=True):
    geometry = None if coordinates is None else {"type": "Point", "coordinates": coordinates}
    return {"type": "Feature", "id": f"f.{i}", "properties": {"uid": i, "code": "x"} if props else {}, "geometry": geometry}


def test_geojson_pages_from_files(spark, tmp_path):
    pages = [
        [feature(1, [-80.5, 44.5]), feature(2, None), feature(3, [-80.0])],
        [feature(3, [-81.0, 45.0, 9.0]), feature(4, [-82.0, 46.0], props=False)],
        [],
    ]
    for n, features in enumerate(pages):
        (tmp_path / f"page{n}.json").write_text(json.dumps({"type": "FeatureCollection", "features": features}, indent=1))
    read = geojson.read_pages(spark, str(tmp_path), struct("uid bigint, code string"))
    flat = geojson.flatten_features(read.drop("source_file"), lineage={"source_url": F.lit("u")})
    got = {(r["uid"], r["longitude"], r["latitude"], r["geometry_type"]) for r in dicts(flat)}
    assert got == {
        (1, -80.5, 44.5, "Point"), (2, None, None, None), (3, None, None, "Point"), (3, -81.0, 45.0, "Point"),
        (None, -82.0, 46.0, "Point"),
    }
    assert geojson.flatten_features(read, drop_empty=True).count() == 4


def test_overlapping_pages_keep_every_key_once(rows):
    a = rows([(i, f"a{i}", 1) for i in range(1000)], "id int, v string, n int")
    b = rows([(i, f"a{i}", 1) for i in range(900, 1947)], "id int, v string, n int")
    merged = geojson.union_pages([a, b], "id", "n")
    assert merged.count() == 1947
    assert merged.where("page_copies = 2").count() == 100


PAGE = """<html><table><tr><th>AQHI</th><th>Category meaning</th></tr><tr><td>1</td></tr></table>
<TABLE class=r><thead><tr><th>Date</th><th>Time<th><b>AQHI</b></th><th>Category</th></tr></thead>
<tr><td>2025-03-25</td><td>4:00&nbsp;pm EDT</td><td><a href="day.php?d=1">3</a></td><td>low &amp; steady</td></tr>
<tr><td>2025-03-25<td>4:00 pm EDT<td>10+<td></tr>
<tr><td>2025-03-26</td><td>4:00 pm EDT</td><td>2</td><td>low risk</td></tr></TABLE></html>"""


def test_html_result_table(rows):
    pages = rows([("p", PAGE), ("none", "<p>no table</p>"), ("legend", PAGE.split("<TABLE")[0])], "page string, html string")
    found = html.table_rows(pages)
    got = {(r["page"], r["table_index"], r["row_index"], r["date"], r["time"], r["aqhi"], r["category"]) for r in dicts(found)}
    assert got == {
        ("p", 1, 1, "2025-03-25", "4:00 pm EDT", "3", "low & steady"),
        ("p", 1, 2, "2025-03-25", "4:00 pm EDT", "10+", None),
        ("p", 1, 3, "2025-03-26", "4:00 pm EDT", "2", "low risk"),
    }
    assert html.rows_on_dates(found, ["2025-03-25"]).count() == 2
    links = dicts(html.links(pages))
    assert [(x["page"], x["link_text"], x["href"]) for x in links] == [("p", "3", "day.php?d=1")]


def test_csv_contract(spark, tmp_path):
    path = tmp_path / "fires.csv"
    path.write_text("FIELD_STAGE_OF_CONTROL_STATUS,OBJECTID,Extra Col\nEX,7,a\nBM,x,b\n")
    df = files.read_csv(spark, str(path), ACTIVE_FIRES, required=["OBJECTID"])
    assert df.columns[: len(ACTIVE_FIRES)] == ACTIVE_FIRES.fieldNames() and "Extra Col" in df.columns
    assert as_set(df.select("OBJECTID", "FIELD_STAGE_OF_CONTROL_STATUS", "FIELD_FIRE_SIZE")) == [(7, "EX", None), (None, "BM", None)]
    with pytest.raises(ValueError, match="OBJECTIDX"):
        files.read_csv(spark, str(path), ACTIVE_FIRES, required=["OBJECTIDX"])
    assert "extra_col" in files.read_csv(spark, str(path), normalise=True).columns


def test_evacuation_csv_with_quoted_commas(spark, tmp_path):
    path = tmp_path / "log.csv"
    names = ",".join(EVACUATION_LOG.fieldNames())
    path.write_text(f'{names}\nEVAC-001,Armstrong,Thunder Bay,2026-07-13,,Ongoing,2026-08-04,,CBC News,2026-07-14,https://www.cbc.ca/a,,,,"late on July 13, 2026, ordered"\n')
    row = files.read_csv(spark, str(path), EVACUATION_LOG, required=["event_id"]).first()
    assert row["notes"] == "late on July 13, 2026, ordered" and row["evacuation_end_date"] is None


def test_file_context_and_union(spark, tmp_path):
    (tmp_path / "barrie_42183_2024_01.csv").write_text("t,temp\n1,2\n")
    df = spark.read.option("header", True).csv(str(tmp_path))
    parts = files.with_file_parts(df, r"^(\w+)_(\d+)_(\d{4})_(\d{2})\.csv$", ["city", "station", "y", "m"])
    assert tuple(parts.first())[2:] == ("barrie", "42183", "2024", "01")
    other = spark.sql("select '9' as t, 'x' as flag")
    both = files.union_by_name([(df, {"src": F.lit("a")}), (other, {"src": F.lit("b")})])
    assert as_set(both.select("t", "temp", "flag", "src")) == [("1", "2", None, "a"), ("9", None, "x", "b")]


def test_payloads(spark, tmp_path):
    (tmp_path / "good.csv").write_text("Date/Time,Temp\n1,2\n2,3\n")
    (tmp_path / "bad.csv").write_text("<html>error</html>\n\n\n")
    (tmp_path / "short.csv").write_text("Date/Time,Temp\n")
    df = files.read_payloads(spark, str(tmp_path))
    ok = df.where(files.payload_is_valid(F.col("text"))).select(F.regexp_extract("path", r"([^/]+)$", 1))
    assert as_set(ok) == [("good.csv",)]


def test_manifests_have_the_published_sizes(spark):
    wx = literal_rows(spark, ["station_id", "city", "name", "climate"], WEATHER_STATIONS).selectExpr(
        "station_id", "city", "date'2024-01-15' as first_month", "date'2026-07-31' as last_month"
    )
    months = manifest.month_manifest(wx)
    assert months.count() == 124 and months.select("file_name").distinct().count() == 124
    aqo = literal_rows(spark, ["station_id", "city", "name"], AQO_STATIONS).selectExpr("*", "2024 as a", "2026 as b")
    assert manifest.year_manifest(aqo, "a", "b").count() == 42
    landed = months.orderBy("file_name").limit(1).select("file_name", F.lit("skipped").alias("outcome"), F.lit(744).alias("rows"))
    assert manifest.outstanding(months, landed).count() == 123
    new = manifest.outstanding(months, landed).select("file_name", F.lit("new").alias("outcome"), F.lit(730).alias("rows"))
    summary = manifest.extraction_summary(months, landed.unionByName(new)).first()
    assert tuple(summary) == (124, 123, 1, 0, 0, 744 + 123 * 730)


def test_sinks(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, snapshot_ts string")
    files.write_table(empty, str(tmp_path / "empty"))
    assert spark.read.parquet(str(tmp_path / "empty")).columns == ["a", "snapshot_ts"]
    files.write_table(empty, str(tmp_path / "parts"), ["snapshot_ts"])
    assert files.read_table(spark, str(tmp_path / "parts")).schema == empty.schema
    files.write_table(spark.sql("select 1 as a, 't' as snapshot_ts"), str(tmp_path / "parts"), ["snapshot_ts"])
    assert as_set(files.read_table(spark, str(tmp_path / "parts"))) == [(1, "t")]
    files.export_csv(empty, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 0
    path = str(tmp_path / "snap")
    for stamp, n in (("t1", 3), ("t2", 5), ("t1", 3)):
        append_snapshot(spark.range(n).selectExpr("id", f"'{stamp}' as snapshot_ts"), path)
    assert as_set(spark.read.parquet(path).groupBy("snapshot_ts").count()) == [("t1", 3), ("t2", 5)]


def test_geojson_properties_that_no_schema_names(spark):
    """A property of the second page arrives as a column; one that changes its kind is text and reported."""
    one = '{"features":[{"id":"a","properties":{"n":1,"code":5,"on":true,"page":"p"},"geometry":{"type":"Point","coordinates":[-80.5,44]}},{"properties":null}]}'
    two = '{"features":[{"id":"b","properties":{"n":2.5,"code":"x","new":{"k":[1]},"it\'s \\"odd\\" $.a":"v","N":7,"gone":null},"geometry":null}]}'
    pages = spark.createDataFrame([(1, one), (2, two), (3, "no json"), (4, None), (5, "{}"), (6, '{"features":3}')], "page int, body string")
    got = geojson.flatten_open(pages, "body").orderBy("page", "source_feature_id")
    assert [r["source_feature_id"] for r in got.collect()] == [None, "a", "b"]
    a, b = got.collect()[1:]
    assert (a["property_n"], a["code"], a["on"], a["property_page"], a["longitude"], a["latitude"], a["new"]) == (1.0, "5", True, "p", -80.5, 44.0, None)
    assert (b["property_n"], b["code"], b["on"], b["new"], b['it\'s "odd" $.a'], b["longitude"], b["gone"]) == (2.5, "x", None, '{"k":[1]}', "v", None, None)
    assert (a["N"], b["N"]) == (None, 7) and dict(got.dtypes)["property_n"] == "double"
    report = {r["property"]: (r["kinds"], r["feature_count"], r["kind_changes"]) for r in geojson.property_report(geojson.open_features(pages, "body")).collect()}
    assert report["code"] == ("integer,text", 2, True) and report["n"] == ("integer,number", 2, False)
    assert report["new"] == ("object", 1, False) and report["gone"] == ("null", 0, False) and report["on"] == ("boolean", 1, False)
    assert geojson.flatten_open(pages.where("page > 2"), "body").count() == 0
