"""String arrays: cleaning and order-keeping deduplication."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import collapse_blanks, strip


def distinct_in_order(c: Column) -> Column:
    """Drop later repeats; the first occurrence keeps its place."""
    return F.array_distinct(c)


def clean_string_array(c: Column) -> Column:
    """Strip and collapse each entry, drop nulls and empties, drop repeats. Null gives ``[]``."""
    cleaned = F.transform(c, lambda x: collapse_blanks(strip(x)))
    kept = F.filter(cleaned, lambda x: x.isNotNull() & (x != ""))
    return F.coalesce(F.array_distinct(kept), F.array().cast("array<string>"))


def strings_of_variant(v: Column) -> Column:
    """The string entries of a VARIANT array; entries of other types are left out.

    Anything that is not an array gives ``[]``.
    """
    items = F.try_variant_get(v, "$", "array<variant>")
    strings = F.filter(items, lambda x: F.schema_of_variant(x) == "STRING")
    return F.coalesce(
        F.transform(strings, lambda x: F.try_variant_get(x, "$", "string")),
        F.array().cast("array<string>"),
    )


def missing_entries(required: list[str], present: Column) -> Column:
    """Required names that ``present`` (an array, null = empty) does not hold, sorted."""
    wanted = F.array(*[F.lit(name) for name in sorted(required)]) if required else F.array().cast("array<string>")
    return F.array_except(wanted, F.coalesce(present, F.array().cast("array<string>")))
