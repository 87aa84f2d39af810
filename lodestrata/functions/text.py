"""Text: white space, identifiers, citations in brackets, entities."""

from __future__ import annotations

import html

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def squash(c: Column) -> Column:
    """Runs of any white space become one space; ends trimmed; null is empty."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+", " "))


def doi(c: Column) -> Column:
    """A DOI without resolver or prefix, lower case."""
    return F.lower(F.trim(F.regexp_replace(F.trim(c), r"(?i)^(https?://(dx\.)?doi\.org/|doi:\s*)", "")))


def slug(path: Column) -> Column:
    """The stem of a file's path with anything but letters, digits, dot, dash and underscore as underscore."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.[^.]*$", "")
    return F.regexp_replace(stem, r"[^A-Za-z0-9_.-]", "_")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


# Named entities, the ampersand last.
ENTITIES = (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&"))


def unescape(c: Column) -> Column:
    """The common entities, by built-in expressions."""
    for entity, plain in ENTITIES:
        c = F.replace(c, F.lit(entity), F.lit(plain))
    return c


def unescape_all(c: Column) -> Column:
    """All entities of HTML, numeric ones included."""

    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: v if v is None else html.unescape(v))

    return run(c)


def split_list(c: Column, separator: str = "|") -> Column:
    """Parts of a joined list without blank ones."""
    return F.filter(F.split(c, "\\" + separator), lambda x: F.trim(x) != "")


def html_title(c: Column) -> Column:
    """The text of a page's title, entities resolved; null if there is none."""
    return unescape(blank_to_null(F.regexp_extract(c, r"(?s)<title>(.*?)</title>", 1)))
