"""Link extraction from HTML pages (the one place Python parsing is needed).

Runs as ``mapInPandas`` over the page table: each task parses its own
pages with the standard-library parser, so pages are processed whole and
in parallel, and only the extracted (page, heading, title) rows leave the
task.
"""

from __future__ import annotations

from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pansift.functions.text import strip_symbols_expr
from pansift.session import ship_package

# Fixed values from the reference: month names and their numbers.
MONTHS = {"january": 1, "february": 2, "march": 3, "april": 4, "may": 5, "june": 6, "july": 7,
          "august": 8, "september": 9, "october": 10, "november": 11, "december": 12}

OUT_SCHEMA = "page_id string, heading string, month int, title string"


# Elements without an end tag.
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Links(HTMLParser):
    """Collect (current heading, link text) in document order.  A heading
    holds for its following siblings and what they contain: it ends with the
    next heading or with the element that contains it."""

    def __init__(self, heading_tag):
        super().__init__(convert_charrefs=True)
        self.heading_tag = heading_tag
        self.open: list[str] = []
        self.heading, self.level = None, 0
        self.heading_buf: list[str] | None = None
        self.link_buf: list[str] | None = None
        self.out: list[tuple] = []

    def handle_starttag(self, tag, attrs):
        if self.heading_tag and tag == self.heading_tag:
            self.heading_buf = []
        elif tag == "a":
            self.end_link()
            self.link_buf = []
        if tag not in VOID:
            self.open.append(tag)

    def handle_endtag(self, tag):
        if self.heading_tag and tag == self.heading_tag and self.heading_buf is not None:
            self.heading, self.heading_buf = "".join(self.heading_buf).strip(), None
            self.level = len(self.open) - 1
        elif tag == "a":
            self.end_link()
        if tag in self.open:
            while self.open.pop() != tag:
                pass
            if len(self.open) < self.level:
                self.heading, self.level = None, 0

    def end_link(self):
        if self.link_buf is not None:
            self.out.append((self.heading, "".join(self.link_buf).strip()))
            self.link_buf = None

    def handle_data(self, data):
        if self.heading_buf is not None:
            self.heading_buf.append(data)
        if self.link_buf is not None:
            self.link_buf.append(data)


def _month_of(text):
    if text is None:
        return None
    low = text.lower()
    for name, num in MONTHS.items():
        if name in low:
            return num
    return None


def _parse_batches(heading_tag):
    def run(batches):
        for pdf in batches:
            rows = []
            for pid, html in zip(pdf["page_id"], pdf["html"]):
                if html is None:
                    continue
                p = _Links(heading_tag)
                p.feed(html)   # the parser reads on over malformed markup; any other error is one to see
                p.close()
                for heading, title in p.out:
                    rows.append((pid, heading, _month_of(heading), title))
            yield pd.DataFrame(rows, columns=["page_id", "heading", "month", "title"])
    return run


def extract_links_by_heading(pages: DataFrame, html_col: str = "html", id_col: str = "page_id",
                             heading_tag: str | None = "h4", max_month: int | None = 6,
                             year: int = 2024, min_len: int = 5, require_month: bool = True) -> DataFrame:
    """Link titles grouped under month headings.

    With ``heading_tag`` set, only links after a heading that names a month
    <= ``max_month`` (until the next heading) are kept and get a synthetic
    mid-month date; with ``heading_tag=None`` every link of the page is
    kept (no month, no date).  Titles must be longer than ``min_len``
    characters and not start with ``http``; trademark signs are removed.
    ``require_month=False`` keeps links under any heading (month may be NULL).
    Pages without an id give links without one; pages without HTML give none.
    """
    ship_package(pages.sparkSession)
    # ids go through pandas as text, whose number columns know no nulls
    src = pages.select(F.col(id_col).cast("long").cast("string").alias("page_id"), F.col(html_col).alias("html"))
    links = src.mapInPandas(_parse_batches(heading_tag), OUT_SCHEMA).withColumn("page_id", F.col("page_id").cast("long"))
    keep = (F.length("title") > min_len) & ~F.col("title").startswith("http")
    if heading_tag and require_month:
        keep = keep & F.col("month").isNotNull() & (F.col("month") <= (max_month or 12))
    elif heading_tag:
        keep = keep & F.col("heading").isNotNull()
    out = links.where(keep).withColumn("title", strip_symbols_expr("title")).where(F.length("title") > 0)
    date = F.when(F.col("month").isNotNull(),
                  F.make_date(F.lit(year), F.col("month"), F.lit(15)))
    return out.withColumn("date", date)
