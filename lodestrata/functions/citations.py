"""Citations by number: ``[1,26-28]``."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions import numbers

GROUP = r"\[(\d[\d,\s–—-]*)\]"
#: A number or a range between commas; numbers of ten digits and more are none.
PART = r",\s*(\d{1,9})(?:\s*-\s*(\d{1,9}))?\s*(?=,)"


def groups(c: Column) -> Column:
    """What stands in each citation's brackets."""
    return F.regexp_extract_all(c, F.lit(GROUP), F.lit(1))


def expand(c: Column) -> Column:
    """Numbers of ``1,26-28`` in order, repeats kept; a falling range is empty; other parts are dropped."""
    listed = F.concat(F.lit(","), numbers.plain_minus(F.coalesce(c, F.lit(""))), F.lit(","))
    low, high = (F.regexp_extract_all(listed, F.lit(PART), F.lit(i)) for i in (1, 2))
    none = F.array().cast("array<int>")
    # Digits are few enough for any int; without a second end the first stands alone.
    return F.flatten(F.zip_with(low.cast("array<int>"), high, lambda a, b: F.when(b == "", F.array(a)).when(a <= b.cast("int"), F.sequence(a, b.cast("int"))).otherwise(none)))


def cited(c: Column) -> Column:
    """All numbers that a text cites, sorted, each once."""
    return F.array_sort(F.array_distinct(expand(F.array_join(groups(c), ","))))


def near(value: Column, text: Column, window: int = 160) -> Column:
    """Numbers cited first within so many characters after any occurrence of a value (a double), sorted."""
    group = re.compile(GROUP)

    @F.pandas_udf("array<int>")
    def run(values: pd.Series, texts: pd.Series) -> pd.Series:
        out = []
        for v, t in zip(values, texts):
            found: set[int] = set()
            if not pd.isna(v) and t is not None:
                t = t.translate(str.maketrans("−–", "--"))
                for form in {f"{v:g}", repr(float(v))}:
                    for m in re.finditer(re.escape(form) + r"(?!\d)", t):
                        if g := group.search(t, m.end(), m.end() + window):
                            for part in re.split(r"\s*,\s*", g[1].translate(str.maketrans("–—", "--")).strip()):
                                if p := re.fullmatch(r"(\d+)(?:\s*-\s*(\d+))?", part):
                                    found.update(range(int(p[1]), int(p[2] or p[1]) + 1))
            out.append(sorted(found))
        return pd.Series(out)

    return run(value, text)


def harvest(from_text: Column, from_model: Column) -> Column:
    """struct(refs, how): what both signals give, else the text's, else the model's."""
    both = F.array_intersect(from_text, from_model)
    choice = (
        F.when(F.size(both) > 0, F.struct(both.alias("refs"), F.lit("agreed").alias("how")))
        .when(F.size(from_text) > 0, F.struct(from_text.alias("refs"), F.lit("text").alias("how")))
        .when(F.size(from_model) > 0, F.struct(from_model.alias("refs"), F.lit("llm").alias("how")))
        .otherwise(F.struct(F.array().cast("array<int>").alias("refs"), F.lit("none").alias("how")))
    )
    return F.struct(F.array_sort(F.array_distinct(choice["refs"])).alias("refs"), choice["how"].alias("how"))
