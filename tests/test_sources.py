"""Sources on small fixtures: HTML headings, JSON shapes, event records."""

import json

from pyspark.sql import functions as F

from pansift.sources import readers as RD
from pansift.sources.html import extract_links_by_heading

PAGE = """<html><body><h4>Events in January</h4><p><a href="/x">Winter Jazzfest™</a> <a>short</a>
<a href="http://x">http://link.example</a></p><div><b><a>Restaurant Week®</a></b></div>
<h4>July highlights</h4><p><a>Summer Streets Festival</a></p><h4>June</h4><ul><li><a>Pride March Parade</a></li></ul>
</body></html>"""


def test_links_by_month_heading(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    out = extract_links_by_heading(pages, heading_tag="h4").orderBy("title").collect()
    assert [(r["title"], r["month"]) for r in out] == [("Pride March Parade", 6), ("Restaurant Week", 1),
                                                       ("Winter Jazzfest", 1)]
    assert str(out[0]["date"]) == "2024-06-15"


def test_links_without_headings(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    titles = {r["title"] for r in extract_links_by_heading(pages, heading_tag=None).collect()}
    assert "Summer Streets Festival" in titles and "short" not in titles


def test_json_columnar_and_matrix(spark):
    doc = json.dumps({"latitude": 40.7, "timezone": "America/New_York",
                      "hourly": {"time": ["2024-01-01T00:00", "2024-01-01T01:00"], "temperature_2m": [1.5, None]}})
    df = spark.createDataFrame([(doc,)], "doc string").select(
        F.from_json("doc", "latitude double, timezone string, hourly struct<time: array<string>, temperature_2m: array<double>>").alias("j")).select("j.*")
    out = RD.read_json_columnar(df, "hourly", {"time": "timestamp_local"}, keep=["latitude"]).collect()
    assert [(r["timestamp_local"], r["temperature_2m"]) for r in out] == [("2024-01-01T00:00", 1.5), ("2024-01-01T01:00", None)]
    m = json.dumps([["NAME", "B01003_001E", "zip code tabulation area"], ["ZCTA5 10001", "21102", "10001"]])
    t = RD.read_json_matrix(spark.createDataFrame([(m,)], "doc string"), "doc").collect()
    assert t[0]["b01003_001e"] == "21102" and t[0]["zip code tabulation area"] == "10001"


def test_normalize_event_records(spark):
    rows = [("Parade A", "2024-03-02T10:00:00.000", None, "parade"), ("Late", "2024-08-01T00:00:00.000", "BRONX", None),
            ("Empty", "", "BRONX", None), ("B", "2024-06-30T23:00:00.123", "QUEENS", None)]
    df = spark.createDataFrame(rows, "event_name string, event_date string, event_borough string, event_type string")
    out = RD.normalize_event_records(df).orderBy("date").collect()
    assert all(r["source"] == "api" for r in out)
    assert [(r["title"], r["date"], r["borough"], r["type"]) for r in out] == [
        ("Parade A", "2024-03-02", "UNKNOWN", "parade"), ("B", "2024-06-30", "QUEENS", "permitted")]


def test_load_table_unknown_extension(spark):
    assert RD.load_table(spark, "/nonexistent/file.xyz") is None


def test_load_table_by_extension(spark):
    from pansift.session import scratch_path
    base = scratch_path(spark, "load")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "ID long, Name string")
    df.write.option("header", True).csv(f"{base}/t.csv")
    df.write.json(f"{base}/t.json")
    df.write.parquet(f"{base}/t.parquet")
    assert RD.load_table(spark, f"{base}/t.csv").columns == ["id", "name"]       # normalised header
    assert sorted(RD.load_table(spark, f"{base}/t.json").columns) == ["id", "name"]
    assert RD.load_table(spark, f"{base}/t.parquet").count() == 2
    assert RD.load_table(spark, f"{base}/t.xlsx") is None


def test_links_end_with_the_section(spark):
    html = "<div><h4>March</h4><p><a>inside the section</a></p></div><a>outside the section</a><h4>May</h4><br><a>under another one</a>"
    out = extract_links_by_heading(spark.createDataFrame([(1, html)], "page_id long, html string"), heading_tag="h4")
    assert sorted((r["title"], r["month"]) for r in out.collect()) == [("inside the section", 3), ("under another one", 5)]


def test_json_matrix_headers_differ(spark):
    docs = [json.dumps([["a", "b"], ["1", "2"]]), json.dumps([["b", "a"], ["3", "4"]]), json.dumps([["a", "c"], ["5", "6"]]), "[]", None]
    out = RD.read_json_matrix(spark.createDataFrame([(d,) for d in docs], "doc string"), "doc")
    assert out.columns == ["a", "b", "c"]
    assert sorted(map(tuple, out.collect())) == [("1", "2", None), ("4", "3", None), ("5", None, "6")]


def test_dummy_names_never_collide(spark):
    from pansift.operators.stats import treatment_dummies
    df = spark.createDataFrame([("A",), ("A-B",), ("A_B",), (None,)], "g string")
    out, names = treatment_dummies(df, ["g"])
    assert len(set(names)) == 2 and len(set(out.columns)) == 3
