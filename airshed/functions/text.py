"""Text helpers: names, nullable strings, safe numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

NULL_MARK = "<NA>"
SEPARATOR = " | "


def clean_text(c: Column) -> Column:
    """Text form with outer spaces removed; null stays null."""
    return F.trim(c.cast("string"))


NUMBER_PATTERN = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"


def number_sql(text: str) -> str:
    """SQL for the number that a trimmed text spells out in decimal digits, else null.

    A plain cast also reads NaN, Infinity and Java's suffixed literals such as 1d.
    """
    return f"if(rlike({text}, r'{NUMBER_PATTERN}'), try_cast({text} as double), cast(null as double))"


def snake(c: Column) -> Column:
    """Value form of the column-name rule: lower case, other characters folded to one underscore."""
    return F.trim(
        F.regexp_replace(F.lower(F.trim(c)), "[^a-z0-9]+", "_"),
        F.lit("_"),
    )


def snake_names(headers: list, number_repeats: bool = False) -> list[str]:
    """Column names for a list of headers.

    A header may be a tuple of stacked header cells. With ``number_repeats`` blank headers get a
    generic name and a repeated name is numbered from 2; without it names are only normalised.
    """
    out: list[str] = []
    seen: dict[str, int] = {}
    for header in headers:
        parts = header if isinstance(header, tuple) else (header,)
        texts = [str(p).strip() for p in parts]
        if isinstance(header, tuple):
            texts = [t for t in texts if t and not t.lower().startswith("unnamed")]
        joined = "_".join(dict.fromkeys(texts))
        name = re.sub(r"[^a-z0-9]+", "_", joined.lower()).strip("_")
        if number_repeats:
            name = name or "unnamed_column"
            seen[name] = seen.get(name, 0) + 1
            if seen[name] > 1:
                name = f"{name}_{seen[name]}"
        out.append(name)
    return out


def columns_with(columns: list[str], *parts: str) -> list[str]:
    """The columns whose name contains every one of ``parts``."""
    return [c for c in columns if all(p in c for p in parts)]


def file_label(city: Column, station_id: Column, month_start: Column) -> Column:
    """Name of a landed monthly file: city slug, station, year, two-digit month."""
    return F.concat_ws(
        "_",
        F.replace(F.lower(city), F.lit(" "), F.lit("_")),
        station_id.cast("string"),
        F.date_format(month_start, "yyyy"),
        F.concat(F.date_format(month_start, "MM"), F.lit(".csv")),
    )


def thousands(c: Column, digits: int = 1) -> Column:
    return F.format_number(c, digits)


def url_host(c: Column) -> Column:
    """Host of a URL in lower case, null when the text is no absolute URL."""
    host = F.lower(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    return F.when(host != "", host)
