"""Result tables and links from raw HTML pages, as Spark expressions on the page text.

The whole page stays one value until its rows are taken out of it; nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airshed.functions.text import SEPARATOR

TABLE = r"(?is)<table\b[^>]*>(.*?)</table>"
ROW = r"(?is)<tr\b[^>]*>(.*?)(?=<tr\b|</tr|\z)"
CELL = r"(?is)<t[hd]\b[^>]*>(.*?)(?=<t[hd]\b|</t[hd]|\z)"
CELL_START = r"(?i)<t[hd]\b[^>]*>"
ANCHOR = r"(?is)<a\b[^>]*>.*?</a>"
HREF = r"(?is)^<a\b[^>]*?\bhref\s*=\s*[\"']?([^\"'\s>]*)"
HEADER_WORDS = ("date", "aqhi", "category")
ENTITIES = [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def _all(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def plain_text(html: Column) -> Column:
    """Text of a fragment: tags out, entities resolved, white space folded."""
    text = F.regexp_replace(html, r"(?s)<[^>]*>", " ")
    for entity, char in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def _cells(row: Column) -> Column:
    return F.transform(_all(row, CELL, 1), plain_text)


def result_table(html: Column, words: Sequence[str] = HEADER_WORDS) -> Column:
    """(at, rows) of the first table whose header names every one of ``words``; other tables, such
    as a legend, are passed over. Null when there is none."""
    tables = F.transform(
        _all(html, TABLE, 1), lambda t, i: F.struct(i.alias("at"), _all(t, ROW, 1).alias("rows"))
    )

    def fits(t: Column) -> Column:
        header = F.lower(plain_text(F.get(t["rows"], F.lit(0))))
        found = F.lit(True)
        for w in words:
            found = found & header.contains(w)
        return F.coalesce(found, F.lit(False))

    return F.get(F.filter(tables, fits), F.lit(0))


def table_rows(
    pages: DataFrame, html: str = "html", fields: Sequence[str] = ("date", "time", "aqhi", "category")
) -> DataFrame:
    """One row per data row of each page's result table: named fields, row text, cells."""
    keep = [c for c in pages.columns if c != html]
    found = pages.select(*keep, result_table(F.col(html)).alias("t"))
    # Header positions once per page, cells once per row; pages without a table explode to nothing.
    headed = found.select(
        *keep,
        "t",
        F.transform(_cells(F.get("t.rows", F.lit(0))), lambda c: F.lower(c)).alias("header"),
    ).select(*keep, "t", *[F.array_position("header", f).alias(f"at_{f}") for f in fields])
    rows = headed.select(
        *keep,
        F.col("t.at").alias("table_index"),
        *[f"at_{f}" for f in fields],
        F.posexplode("t.rows").alias("row_index", "tr"),
    ).where((F.col("row_index") > 0) & F.col("tr").rlike(CELL_START))
    return rows.withColumn("cells", _cells(F.col("tr"))).selectExpr(
        *[f"`{c}`" for c in keep],
        "table_index",
        "row_index",
        *[
            f"if(at_{f} > 0, nullif(get(cells, int(at_{f} - 1)), ''), null) as `{f}`"
            for f in fields
        ],
        f"array_join(cells, '{SEPARATOR}') as row_text",
        "cells",
    )


def rows_on_dates(rows: DataFrame, dates: Sequence[str], text: str = "row_text") -> DataFrame:
    """Rows whose text names any of the dates."""
    wanted = F.array(*[F.lit(d) for d in dates])
    return rows.where(F.exists(wanted, lambda d: F.contains(F.col(text), d)))


def links(pages: DataFrame, html: str = "html") -> DataFrame:
    """Every link with its position, text and target."""
    keep = [c for c in pages.columns if c != html]
    anchors = pages.select(*keep, F.posexplode(_all(F.col(html), ANCHOR, 0)).alias("link_no", "a"))
    href = F.regexp_extract("a", HREF, 1)
    return anchors.select(
        *keep, "link_no", plain_text(F.col("a")).alias("link_text"), href.alias("href")
    )
