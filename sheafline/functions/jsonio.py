"""JSON text and VARIANT columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decode(c: Column) -> Column:
    """JSON text → VARIANT; malformed text becomes ``{}``, null stays null."""
    return F.when(c.isNotNull(), F.coalesce(F.try_parse_json(c), F.parse_json(F.lit("{}"))))


def decode_struct(c: Column, ddl: str) -> Column:
    """JSON text → typed struct, for a known shape; malformed text gives null fields."""
    return F.from_json(c, ddl, {"mode": "PERMISSIVE"})


def json_path(field: str) -> str:
    """Path of a top-level field; quoted so that dots in a name stay part of it."""
    return "$['" + field.replace("'", "\\'") + "']"


def field_text(c: Column, field: str) -> Column:
    """A top-level field of JSON text, as text."""
    return F.get_json_object(c, json_path(field))


def keys(c: Column) -> Column:
    """Top-level keys of JSON text; null for anything that is not an object."""
    return F.json_object_keys(c)


def has_key(c: Column, field: str) -> Column:
    return F.coalesce(F.array_contains(keys(c), field), F.lit(False))


def is_empty_object(c: Column) -> Column:
    """Null, ``{}``, malformed, or not an object: nothing to clean."""
    return F.coalesce(F.size(keys(c)) <= 0, F.lit(True))


def canonical(c: Column) -> Column:
    """The same JSON document with sorted keys and no spaces; null if malformed."""
    return F.to_json(F.try_parse_json(c))


def encode(c: Column, keep_nulls: bool = True) -> Column:
    """Struct or map → JSON text."""
    return F.to_json(c, {"ignoreNullFields": "false" if keep_nulls else "true"})


def put_fields(base: Column, fields: dict[str, Column]) -> Column:
    """JSON text of an object with fields put over it; a null field leaves the object as it is there.

    Works on a map of VARIANT values, so nested values keep their shape; the
    object is parsed once.
    """
    added = F.create_map(*[x for name, c in fields.items() for x in (F.lit(name), c.cast("variant"))])
    held = F.map_filter(added, lambda k, v: v.isNotNull())
    names = list(fields)
    kept = F.map_filter(F.from_json(base, "map<string,variant>"), lambda k, v: ~k.isin(names))
    return F.to_json(F.map_concat(kept, held))


def normalise_number(c: Column) -> Column:
    """NaN becomes null."""
    return F.when(~F.isnan(c), c)


def iso_instant(c: Column) -> Column:
    """Timestamp → ISO text with microseconds only when there are any."""
    whole = F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(F.extract(F.lit("SECOND"), c) % 1 == 0, whole).otherwise(
        F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    )
