"""Keys that content alone determines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lodestrata.functions import numbers, text


def paper_key(doi: Column, slug: Column) -> Column:
    """The DOI, or the document's slug where it has none."""
    return F.coalesce(text.blank_to_null(text.doi(doi)), F.concat(F.lit("xml:"), slug))


def reference_key(doi: Column, owner: Column, number: Column) -> Column:
    """The DOI, or the owner's key and the number; an error without an owner."""
    fallback = F.when(text.blank_to_null(owner).isNotNull(), F.concat(owner, F.lit("#ref"), number.cast("string")))
    key = F.coalesce(text.blank_to_null(text.doi(doi)), fallback)
    return F.when(key.isNotNull(), key).otherwise(F.raise_error(F.lit("a reference without a DOI needs its paper's key")))


def dedup_key(components: Column, ratio: Column, prop: Column, value: Column, degrees: Column, doi: Column) -> Column:
    """16 hex digits of a datum: the same measurement reported twice has the same."""
    names = F.array_sort(F.transform(F.filter(components, lambda x: F.trim(F.coalesce(x, F.lit(""))) != ""), lambda x: F.lower(F.trim(x))))
    parts = [F.array_join(names, "+"), F.coalesce(ratio, F.lit("")), prop, numbers.general(value), F.coalesce(numbers.general(degrees), F.lit("")), F.lower(F.coalesce(doi, F.lit("")))]
    return F.substring(F.sha1(F.concat_ws("|", *parts)), 1, 16)


def short_hash(c: Column) -> Column:
    """16 hex digits of a text's SHA-256."""
    return F.substring(F.sha2(c, 256), 1, 16)


def request_key(**parts: Column) -> Column:
    """SHA-256 of a request as JSON with sorted keys."""
    return F.sha2(F.to_json(F.struct(*[parts[k].alias(k) for k in sorted(parts)])), 256)


def prose_key(slug: Column, section: Column, prop: Column, components: Column, value: Column) -> Column:
    """Key of a claim in prose; the slug keeps papers apart."""
    names = text.blank_to_null(F.array_join(F.array_sort(components), "+"))
    return F.concat_ws(":", F.concat(F.lit("P-"), slug), section, prop, F.coalesce(names, F.lit("?")), F.coalesce(numbers.general(value), F.lit("none")))
