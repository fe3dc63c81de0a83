"""Row selectors. Each adds a predicate that can reach the scan, or a semi/anti join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.jsonio import field_text, keys
from .ordering import first_per_key, listed


def by_ids(df: DataFrame, ids: list[int] | DataFrame, col: str = "id") -> DataFrame:
    """Rows whose key is in the list; an empty list gives nothing.

    A list, as typed by hand, becomes an ``IN`` predicate that reaches the scan; ids
    that come from data stay a DataFrame and become a semi join.
    """
    if isinstance(ids, DataFrame):
        wanted = ids.select(F.col(ids.columns[0]).alias("_id"))
        return df.join(wanted, df[col] == wanted["_id"], "left_semi")
    return df.filter(F.col(col).isin([int(i) for i in ids]) if ids else F.lit(False))


def parse_id_spec(spec: str) -> list[tuple[int, int]]:
    """``"1-3, 5"`` → inclusive ranges.

    A range with too many parts or in falling order is left out; anything that
    is not a number empties the selection.
    """
    ranges: list[tuple[int, int]] = []
    for part in (p.strip() for p in spec.strip().split(",")):
        ends = part.split("-")
        if len(ends) > 2:
            continue
        try:
            low, high = int(ends[0]), int(ends[-1])
        except ValueError:
            return []
        if low <= high:
            ranges.append((low, high))
    return ranges


def select_ids(df: DataFrame, spec: str, col: str = "id") -> DataFrame:
    """Rows named by an id-range spec, as range predicates on the scan."""
    tests = [F.col(col).between(low, high) for low, high in parse_id_spec(spec)]
    return df.filter(reduce(lambda a, b: a | b, tests)) if tests else df.filter(F.lit(False))


# The selections below take ``limit`` or ``ordered`` to become a list, newest first.


def where_equal(df: DataFrame, limit: int | None = None, ordered: bool = False, **values: object) -> DataFrame:
    """Rows where every named column equals its value; None leaves a column out."""
    tests = [F.col(name) == value for name, value in values.items() if value is not None]
    return listed(df.filter(reduce(lambda a, b: a & b, tests)) if tests else df, limit, ordered)


def by_cleaner(df: DataFrame, cleaner: str, version: str | None = None, limit: int | None = None, ordered: bool = False) -> DataFrame:
    return where_equal(df, limit, ordered, cleaner_used=cleaner, cleaner_version=version)


def cutoff(df: DataFrame, time: str, as_of: str, hours: float = 0, days: float = 0) -> Column:
    """``as_of`` less some time, as a constant of the column's own type (so the scan can use it)."""
    kind = df.schema[time].dataType.simpleString()
    return F.lit(as_of).cast(kind) - F.make_dt_interval(F.lit(int(days)), F.lit(int(hours)), F.lit(0), F.lit(0.0))


def recent(df: DataFrame, hours: int, as_of: str, time: str = "created_at", limit: int | None = None, ordered: bool = False) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of`` (and after it)."""
    return listed(df.filter(F.col(time) >= cutoff(df, time, as_of, hours=hours)), limit, ordered, time)


def contains(df: DataFrame, col: str, term: str, limit: int | None = None, ordered: bool = False) -> DataFrame:
    """Case-insensitive contains; ``%`` and ``_`` in the term are wildcards."""
    return listed(df.filter(F.col(col).ilike(f"%{term}%")), limit, ordered)


def metadata_contains(
    df: DataFrame, term: str, field: str | None = None, col: str = "metadata", limit: int | None = None, ordered: bool = False
) -> DataFrame:
    """Contains within one JSON field, or anywhere in the JSON text."""
    text = field_text(F.col(col), field) if field else F.col(col)
    return listed(df.filter(text.ilike(f"%{term}%")), limit, ordered)


def field_values(df: DataFrame, field: str, limit: int | None = None, col: str = "metadata") -> DataFrame:
    """Non-null values of one JSON field; with a limit, of the newest rows that have one."""
    values = df.select("id", "created_at", field_text(F.col(col), field).alias("field_value"))
    return listed(values.filter(F.col("field_value").isNotNull()), limit)


def schemas_with_property(schemas: DataFrame, name: str, top_level_only: bool = False) -> DataFrame:
    """Schemas whose text holds the quoted property name, or that have it as a top-level key."""
    text = F.col("metadata_schema")
    test = F.array_contains(keys(text), name) if top_level_only else text.ilike(f'%"{name}"%')
    return schemas.filter(test)


def select_targets(
    targets: DataFrame,
    collector_id: int | None = None,
    status_id: int | None = None,
    type_ids: list[int] | None = None,
    languages: list[str] | None = None,
    ids: list[int] | None = None,
    ordered: bool = False,
) -> DataFrame:
    """Targets by any mix of collector, status, types, languages and ids, as one predicate.

    ``ordered`` gives them by language, then oldest first. The collector always applies.
    """
    df = targets
    if collector_id is not None:
        df = df.filter(F.col("collector_name_id") == collector_id)
    if status_id is not None:
        df = df.filter(F.col("collection_status_id") == status_id)
    if type_ids:
        df = df.filter(F.col("collection_type_id").isin(type_ids))
    if languages:
        df = df.filter(F.col("language_code").isin(languages))
    if ids:
        df = by_ids(df, ids)
    return df.orderBy("language_code", "created_at", "id") if ordered else df


def not_checked(targets: DataFrame, checks: DataFrame) -> DataFrame:
    """Targets without any check so far."""
    return targets.join(checks, targets["id"] == checks["collection_target_id"], "left_anti")


def select_for_check(
    targets: DataFrame,
    checks: DataFrame | None = None,
    type_ids: list[int] | None = None,
    languages: list[str] | None = None,
    ids: list[int] | None = None,
) -> DataFrame:
    """Targets to check; those already checked are skipped when ``checks`` is given (no recheck)."""
    df = targets
    if type_ids:
        df = df.filter(F.col("collection_type_id").isin(type_ids))
    if languages:
        df = df.filter(F.col("language_code").isin(languages))
    if ids:
        df = by_ids(df, ids)
    return not_checked(df, checks) if checks is not None else df


def with_title_and_content(df: DataFrame, title: str = "title", content: str = "content") -> DataFrame:
    """Drop records without a title or without content (null or empty)."""
    return df.filter((F.col(title) != "") & (F.col(content) != ""))


def unique_languages(targets: DataFrame, collector_id: int | None = None, status_id: int | None = None) -> DataFrame:
    """The oldest target of each language."""
    df = targets
    if collector_id is not None:
        df = df.filter(F.col("collector_name_id") == collector_id)
    if status_id is not None:
        df = df.filter(F.col("collection_status_id") == status_id)
    return first_per_key(df, ["language_code"], [F.col("created_at").asc(), F.col("id").asc()])
