"""Gap runs of a panel, capped distinct counts, links without an id."""

import random

from pyspark.sql import functions as F

from pansift.operators import columns as C
from pansift.operators.profile import missing_panel_cells
from pansift.sources.html import extract_links_by_heading


def test_gap_runs(spark):
    rs = random.Random(4)
    cells = {(f"2024-01-{d:02d}", e) for d in range(1, 29) for e in "abcdef" if rs.random() < 0.5} | {("2024-02-01", "z")}
    rows = [*cells, *list(cells)[:9], (None, "only an undated row"), ("2024-03-01", None)]
    df = spark.createDataFrame(rows, "date string, borough string").repartition(4)
    got = [tuple(r) for r in missing_panel_cells(df).collect()]
    days, names = {d for d, _ in rows if d}, {e for _, e in rows if e}
    assert sorted(got) == sorted((d, e) for d in days for e in names if (d, e) not in cells)


def test_gap_runs_hold_no_sets(spark):
    df = spark.range(5000).select(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 7).cast("int")).alias("date"),
                                  (F.col("id") * 31).alias("borough"))
    cells = missing_panel_cells(df)
    assert cells.count() == 5000 * 6
    assert "collect_set" not in cells._jdf.queryExecution().optimizedPlan().toString()
    assert missing_panel_cells(df.limit(0)).count() == 0
    full = spark.range(12).select((F.col("id") % 3).alias("date"), F.floor(F.col("id") / 3).alias("borough"))
    assert missing_panel_cells(full).count() == 0


def test_capped_counts(spark):
    df = spark.range(3000).select(*[(F.col("id") % n).alias(f"n{n}") for n in (1, 2, 7, 8, 9, 10, 12, 64, 3000)],
                                  F.lit(None).cast("int").alias("none"), F.when(F.col("id") > 5, F.col("id") % 8).alias("gaps"))
    got = C.distinct_counts(df, df.columns, cap=8)
    assert got == {"n1": 1, "n2": 2, "n7": 7, "n8": 8, **{f"n{n}": 9 for n in (9, 10, 12, 64, 3000)}, "none": 0, "gaps": 8}
    assert C.distinct_counts(df, ["n12", "n3000"]) == {"n12": 12, "n3000": 3000}
    assert C.distinct_counts(df, [], cap=8) == {}


def test_only_columns_of_few_values_are_counted(spark, monkeypatch):
    from pansift.operators import profile
    asked = []
    counted = profile.distinct_counts_long
    monkeypatch.setattr(profile, "distinct_counts_long", lambda df, cols: asked.append(list(cols)) or counted(df, cols))
    C.is_discrete_numeric(spark.range(1000).select("id", (F.col("id") % 3).alias("few")))
    assert asked == [["few"]]


def test_links_without_an_id(spark):
    pages = spark.createDataFrame([(None, "<h1>A</h1><a href='x'>a link of it</a>"), (2 ** 60 + 1, "<h1>B</h1><a href='y'>another link</a>"), (3, None)],
                                  "page_id long, html string")
    got = [(r.page_id, r.heading, r.title) for r in extract_links_by_heading(pages, heading_tag="h1", require_month=False).collect()]
    assert sorted(got, key=str) == sorted([(None, "A", "a link of it"), (2 ** 60 + 1, "B", "another link")], key=str)
