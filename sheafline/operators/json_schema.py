"""JSON Schema (draft 7 subset) compiled to column expressions, and schema selection.

Supported keywords: type, required, enum, const, minimum, maximum,
exclusiveMinimum, exclusiveMaximum, minLength, maxLength, pattern, properties,
additionalProperties (false), items (one schema), minItems, maxItems, uniqueItems,
allOf, anyOf, oneOf, not, and $ref within the document; true and false are schemas. A
schema with any other checking keyword is refused when it is compiled.

A reference is compiled where it is used. One that comes back to itself is unfolded
``ref_depth`` times; a document that goes deeper has an error that says so, and none
of its values pass unseen. One that comes back without going into the document is
refused.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ordering import first_per_key

_ANNOTATIONS = {"$schema", "$id", "title", "description", "default", "examples", "$comment", "definitions", "$defs"}
_CHECKS = {
    "type", "required", "enum", "const", "minimum", "maximum", "exclusiveMinimum", "exclusiveMaximum",
    "minLength", "maxLength", "pattern", "properties", "additionalProperties", "items", "minItems", "maxItems",
    "uniqueItems", "allOf", "anyOf", "oneOf", "not",
}
_ERROR = "array<struct<path:string,message:string,sub_errors:array<string>,failed_value:string>>"
REF_DEPTH = 3


def _quote(value: object) -> str:
    return json.dumps(value, ensure_ascii=False)


@dataclass(frozen=True)
class _Scope:
    """Where a schema stands: the whole document, the references entered, and those entered since the last step down."""

    root: dict | bool
    ref_depth: int
    entered: tuple[str, ...] = ()
    level: tuple[str, ...] = ()

    def below(self) -> _Scope:
        return replace(self, level=())

    def follow(self, schema: dict | bool) -> tuple[dict | bool, _Scope]:
        """The schema behind any references (keywords beside a reference do not count)."""
        scope = self
        while isinstance(schema, dict) and "$ref" in schema:
            ref = schema["$ref"]
            if ref in scope.level:
                raise ValueError(f"reference without an end: {ref}")
            if scope.entered.count(ref) > scope.ref_depth:
                return {"_too_deep": ref}, scope
            scope = replace(scope, entered=(*scope.entered, ref), level=(*scope.level, ref))
            schema = scope.target(ref)
        return schema, scope

    def target(self, ref: str) -> dict | bool:
        if not isinstance(ref, str) or not ref.startswith("#"):
            raise ValueError(f"only references within the document are supported: {ref}")
        found = self.root
        for part in ref[1:].split("/")[1:]:
            name = unquote(part).replace("~1", "/").replace("~0", "~")
            try:
                found = found[int(name)] if isinstance(found, list) else found[name]
            except (KeyError, IndexError, ValueError, TypeError):
                raise ValueError(f"reference to nothing: {ref}") from None
        return found


class _Node:
    """A VARIANT value with its kind, and the tests a schema needs."""

    def __init__(self, value: Column, kind: Column, path: Column):
        self.value, self.kind, self.path = value, kind, path

    def double(self) -> Column:
        return F.try_variant_get(self.value, "$", "double")

    def text(self) -> Column:
        return F.try_variant_get(self.value, "$", "string")

    def items(self) -> Column:
        return F.try_variant_get(self.value, "$", "array<variant>")

    def shown(self) -> Column:
        return F.to_json(self.value)

    def child(self, name: str) -> Column:
        return F.try_variant_get(self.value, _step(name), "variant")

    def is_type(self, name: str) -> Column:
        number = self.kind.isin("BIGINT", "DOUBLE", "FLOAT") | self.kind.startswith("DECIMAL")
        tests = {
            "null": self.kind == "VOID",
            "boolean": self.kind == "BOOLEAN",
            "string": self.kind == "STRING",
            "number": number,
            "integer": (self.kind == "BIGINT") | (number & (self.double() == F.floor(self.double()))),
            "array": self.kind.startswith("ARRAY"),
            "object": self.kind.startswith("OBJECT"),
        }
        if name not in tests:
            raise ValueError(f"unknown JSON Schema type: {name}")
        return tests[name]


def _step(name: str) -> str:
    return "$['" + name.replace("'", "\\'") + "']"


def _refuse_unknown(schema: dict | bool) -> dict:
    """The schema as a document; true has no checks, false takes nothing."""
    if isinstance(schema, bool):
        return {} if schema else {"_false": True}
    unknown = set(schema) - _CHECKS - _ANNOTATIONS - {"_too_deep"}
    if unknown:
        raise ValueError(f"unsupported JSON Schema keywords: {sorted(unknown)}")
    if not isinstance(schema.get("items", True), (dict, bool)):
        raise ValueError("items must be one schema")
    if schema.get("additionalProperties", False) is not False:
        raise ValueError("additionalProperties may only be false")
    for keyword in ("allOf", "anyOf", "oneOf"):
        if keyword in schema and not (isinstance(schema[keyword], list) and schema[keyword]):
            raise ValueError(f"{keyword} must be a list of schemas that is not empty")
    return schema


def _no_errors() -> Column:
    return F.array().cast(_ERROR)


def _error(node: _Node, message: Column, sub_errors: Column | None = None) -> Column:
    """One error of a value, with the messages of its alternatives and the value as JSON."""
    return F.struct(
        node.path.alias("path"),
        message.alias("message"),
        (F.array().cast("array<string>") if sub_errors is None else sub_errors).alias("sub_errors"),
        node.shown().alias("failed_value"),
    )


def _own_errors(schema: dict, node: _Node) -> list[Column]:
    """Errors of a value itself, each null when its test passes; an absent value has none."""
    out: list[Column] = []

    def add(test: Column, message: Column) -> None:
        out.append(F.when(test, _error(node, message)))

    def said(text: str) -> Column:
        return F.concat(node.shown(), F.lit(text))

    if "_false" in schema:
        add(node.value.isNotNull(), F.concat(F.lit("False schema does not allow "), node.shown()))
    if "_too_deep" in schema:
        add(node.value.isNotNull(), said(f" is nested deeper than {schema['_too_deep']} is followed"))
    if "type" in schema:
        types = schema["type"] if isinstance(schema["type"], list) else [schema["type"]]
        test = node.is_type(types[0])
        for name in types[1:]:
            test = test | node.is_type(name)
        add(~test, said(" is not of type " + ", ".join(f"'{t}'" for t in types)))
    for keyword, values in (("enum", schema.get("enum")), ("const", [schema["const"]] if "const" in schema else None)):
        if values is not None:
            allowed = [F.to_json(F.parse_json(F.lit(_quote(x)))) for x in values]
            label = f" is not one of {_quote(values)}" if keyword == "enum" else f" is not {_quote(values[0])}"
            add(node.value.isNotNull() & ~node.shown().isin(allowed), said(label))
    number = node.is_type("number")
    for keyword, breaks, label in (
        ("minimum", lambda limit: node.double() < limit, " is less than the minimum of "),
        ("maximum", lambda limit: node.double() > limit, " is greater than the maximum of "),
        ("exclusiveMinimum", lambda limit: node.double() <= limit, " is less than or equal to the minimum of "),
        ("exclusiveMaximum", lambda limit: node.double() >= limit, " is greater than or equal to the maximum of "),
    ):
        if keyword in schema:
            add(number & breaks(F.lit(float(schema[keyword]))), said(f"{label}{schema[keyword]}"))
    text = node.is_type("string")
    if "minLength" in schema:
        add(text & (F.length(node.text()) < schema["minLength"]), said(" is too short"))
    if "maxLength" in schema:
        add(text & (F.length(node.text()) > schema["maxLength"]), said(" is too long"))
    if "pattern" in schema:
        add(text & ~node.text().rlike(schema["pattern"]), said(f" does not match '{schema['pattern']}'"))
    array = node.is_type("array")
    if "minItems" in schema:
        add(array & (F.size(node.items()) < schema["minItems"]), said(" is too short"))
    if "maxItems" in schema:
        add(array & (F.size(node.items()) > schema["maxItems"]), said(" is too long"))
    if schema.get("uniqueItems"):
        different = F.array_distinct(F.transform(node.items(), _canonical))
        add(array & (F.size(different) < F.size(node.items())), said(" has non-unique elements"))
    obj = node.is_type("object")
    for name in schema.get("required", []):
        add(obj & node.child(name).isNull(), F.lit(f"'{name}' is a required property"))
    if "additionalProperties" in schema:
        known = F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>")
        extra = F.array_sort(F.array_except(F.json_object_keys(node.shown()), known))
        add(
            obj & (F.size(extra) > 0),
            F.concat(F.lit("Additional properties are not allowed ("), F.array_join(extra, ", "), F.lit(")")),
        )
    return out


def _canonical(value: Column) -> Column:
    """A text that is equal for equal values: numbers by value (those inside other values as written)."""
    node = _Node(value, F.schema_of_variant(value), F.lit(""))
    return F.when(node.is_type("number"), node.double().cast("string")).otherwise(node.shown())


def _combined_errors(schema: dict, node: _Node, scope: _Scope) -> list[Column]:
    """Error arrays of allOf, anyOf, oneOf and not; an absent value has none."""
    out: list[Column] = []

    def checked(keyword: str) -> list[Column]:
        return [_errors_of(sub, node, scope) for sub in schema[keyword]]

    def add(test: Column, message: Column, sub_errors: Column | None = None) -> None:
        broken = node.value.isNotNull() & test
        out.append(F.when(broken, F.array(_error(node, message, sub_errors)).cast(_ERROR)).otherwise(_no_errors()))

    def said(text: str) -> Column:
        return F.concat(node.shown(), F.lit(text))

    def messages(branches: list[Column]) -> Column:
        return F.transform(F.concat(*branches), lambda e: e["message"])

    if "allOf" in schema:
        out += checked("allOf")
    if "anyOf" in schema:
        branches = checked("anyOf")
        none = F.lit(True)
        for errors in branches:
            none = none & (F.size(errors) > 0)
        add(none, said(" is not valid under any of the given schemas"), messages(branches))
    if "oneOf" in schema:
        branches = checked("oneOf")
        labels = [F.when(F.size(errors) == 0, _quote(sub)) for sub, errors in zip(schema["oneOf"], branches)]
        valid = F.array_compact(F.array(*labels))
        add(F.size(valid) == 0, said(" is not valid under any of the given schemas"), messages(branches))
        # The first valid schema is named last.
        named = F.concat(F.slice(valid, 2, len(branches)), F.slice(valid, 1, 1))
        add(F.size(valid) > 1, F.concat(node.shown(), F.lit(" is valid under each of "), F.array_join(named, ", ")))
    if "not" in schema:
        errors = _errors_of(schema["not"], node, scope)
        add(F.size(errors) == 0, said(f" should not be valid under {_quote(schema['not'])}"))
    return out


def _errors_of(schema: dict | bool, node: _Node, scope: _Scope) -> Column:
    """Error array of a value with everything below it."""
    schema, scope = scope.follow(schema)
    schema = _refuse_unknown(schema)
    own = _own_errors(schema, node)
    parts = [F.array_compact(F.array(*own)).cast(_ERROR)] if own else []
    parts += _combined_errors(schema, node, scope)
    if "items" in schema:
        parts.append(_errors_of_items(schema["items"], node, scope.below()))
    for name, sub in schema.get("properties", {}).items():
        value = node.child(name)
        path = F.concat(node.path, F.when(node.path == "", F.lit("")).otherwise(F.lit(".")), F.lit(name))
        parts.append(_errors_of(sub, _Node(value, F.schema_of_variant(value), path), scope.below()))
    return F.concat(*parts) if parts else _no_errors()


def _errors_of_items(schema: dict | bool, node: _Node, scope: _Scope) -> Column:
    def one(x: Column, i: Column) -> Column:
        here = F.concat(node.path, F.when(node.path == "", F.lit("")).otherwise(F.lit(".")), i.cast("string"))
        return _errors_of(schema, _Node(x, F.schema_of_variant(x), here), scope)

    return F.coalesce(F.when(node.is_type("array"), F.flatten(F.transform(node.items(), one))), _no_errors())


def with_schema_errors(df: DataFrame, document: str, schema: dict | bool, name: str = "errors", ref_depth: int = REF_DEPTH) -> DataFrame:
    """Add ``name``: all errors of a VARIANT column, sorted by path.

    An error has its path, its message, the messages of the alternatives that failed
    (``sub_errors``, for anyOf and oneOf) and the value it is about as JSON
    (``failed_value``). Each property is taken out of the document once, then its
    kind is found once, and all tests use these columns. A null column has no errors.
    """
    nodes: list[tuple[dict, _Scope, str, str]] = []

    def visit(sub: dict | bool, scope: _Scope, at: str, path: str) -> None:
        sub, scope = scope.follow(sub)
        sub = _refuse_unknown(sub)
        nodes.append((sub, scope, at, path))
        for key, deeper in sub.get("properties", {}).items():
            visit(deeper, scope.below(), at + _step(key)[1:], f"{path}.{key}" if path else key)

    visit(schema, _Scope(schema, ref_depth), "$", "")
    values = {
        f"_value{i}": F.col(document) if at == "$" else F.try_variant_get(F.col(document), at, "variant")
        for i, (_, _, at, _) in enumerate(nodes)
    }
    kinds = {f"_kind{i}": F.schema_of_variant(F.col(f"_value{i}")) for i in range(len(nodes))}
    own: list[Column] = []
    nested: list[Column] = []
    for i, (sub, scope, _, path) in enumerate(nodes):
        node = _Node(F.col(f"_value{i}"), F.col(f"_kind{i}"), F.lit(path))
        own += _own_errors(sub, node)
        nested += _combined_errors(sub, node, scope)
        if "items" in sub:
            nested.append(_errors_of_items(sub["items"], node, scope.below()))
    errors = F.array_compact(F.array(*own)).cast(_ERROR) if own else _no_errors()
    if nested:
        errors = F.concat(errors, *nested)
    staged = df.withColumns(values).withColumns(kinds).withColumn(name, F.array_sort(errors))
    return staged.drop(*values, *kinds)


def error_messages(errors: Column) -> Column:
    """Errors as the stored text list: message, its path when there is one, and its sub-errors."""
    # Prefixes of the stored texts.
    return F.flatten(
        F.transform(
            errors,
            lambda e: F.concat(
                F.array_compact(
                    F.array(
                        F.concat(F.lit("Schema validation failed: "), e["message"]),
                        F.when(e["path"] != "", F.concat(F.lit("Field path: "), e["path"])),
                    )
                ),
                F.transform(e["sub_errors"], lambda m: F.concat(F.lit("Sub error: "), m)),
            ),
        )
    )


def stored_error(errors: Column) -> Column:
    """Errors as the stored JSON: the text list and the first error's value; null when there are none.

    The value stands as JSON inside the JSON.
    """
    first = F.get(errors, 0)
    whole = F.to_variant_object(F.struct(error_messages(errors).alias("validation_errors"), F.parse_json(first["failed_value"]).alias("failed_value")))
    return F.when(F.size(errors) > 0, F.to_json(whole))


def active_schemas(schemas: DataFrame, name_field: str = "cleaner_name", version_field: str = "current_schema_version") -> DataFrame:
    """The newest schema of each (name, version), with its schema part as JSON text."""
    text = F.col("metadata_schema")
    named = schemas.select(
        F.col("id").alias("schema_id"),
        F.get_json_object(text, f"$.{name_field}").alias("name"),
        F.get_json_object(text, f"$.{version_field}").alias("version"),
        F.get_json_object(text, "$.schema").alias("schema"),
        "created_at",
    ).filter(F.col("name").isNotNull() & F.col("version").isNotNull())
    return first_per_key(named, ["name", "version"], [F.col("created_at").desc(), F.col("schema_id").desc()])


def load_schema(schemas: DataFrame, name: str, version: str, name_field: str = "cleaner_name") -> tuple[int, dict]:
    """Id and document of one active schema: a one-row read. A missing one is an error."""
    active = active_schemas(schemas, name_field).filter((F.col("name") == name) & (F.col("version") == version))
    row = active.select("schema_id", "schema").first()
    if row is None or row["schema"] is None:
        raise ValueError(f"No schema found for {name} v{version}")
    return row["schema_id"], json.loads(row["schema"])


def schema_info(schemas: DataFrame, rows: DataFrame, schema_col: str, name_field: str = "cleaner_name") -> DataFrame:
    """Active schemas with the number of rows stored under each."""
    counts = rows.groupBy(F.col(schema_col).alias("schema_id")).agg(F.count("*").alias("row_count"))
    return active_schemas(schemas, name_field).join(counts, "schema_id", "left").select(
        "schema_id", "name", "version", "created_at", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )
