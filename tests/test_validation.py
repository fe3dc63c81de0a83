import json

import pytest
from pyspark.sql import functions as F

from sheafline.operators import json_schema, validation
from sheafline.operators.validation import Fields

GOOD = {"title": "T", "content": "long enough content", "url": "https://x.org", "language": "en", "collected_at": "2024-01-01"}
REQUIRED = list(GOOD)


def record_errors(spark, record):
    df = spark.createDataFrame([(json.dumps(record),)], "j string")
    return df.select(validation.record_errors(Fields(df, "j"), REQUIRED, min_length=10).alias("e")).first().e


def test_record_rules(spark):
    assert record_errors(spark, GOOD) == []
    assert record_errors(spark, {k: v for k, v in GOOD.items() if k not in ("url", "title")}) == ["Missing required fields: title, url"]
    assert record_errors(spark, {**GOOD, "title": ""}) == ["Field 'title' is empty"]
    assert record_errors(spark, {**GOOD, "title": None}) == ["Field 'title' is empty"]
    assert record_errors(spark, {**GOOD, "content": "   short   "}) == ["Content too short <10 characters."]
    assert record_errors(spark, {**GOOD, "content": "broken â€™ content here"}) == ["Potential encoding issues in content"]
    assert record_errors(spark, {**GOOD, "language": "eng"}) == ["Invalid language code: eng"]
    assert record_errors(spark, {**GOOD, "url": "ftp://x"}) == ["Invalid URL format: ftp://x"]


def test_batch_verdict_and_first_errors(spark):
    df = spark.createDataFrame([(1, ["a", "b"]), (2, []), (3, ["c"])], "id int, errors array<string>")
    assert validation.batch_verdict(df).first().asDict() == {"record_count": 3, "error_count": 3, "passed": False}
    assert validation.batch_verdict(df.filter("id = 2")).first().passed is True
    assert validation.batch_verdict(df.filter("id = 9")).first().passed is False
    assert [r.message for r in validation.first_errors(df, "id", limit=2).collect()] == ["a", "b"]


def poll_errors(spark, **changes):
    base = {"cycle": 2016, "state": "Ohio", "candidate_name": "A", "pct_estimate": 40.0, "pct_trend_adjusted": 41.0, "candidate_id": 3, "language": "en", "modeldate": "x"}
    df = spark.createDataFrame([(json.dumps({k: v for k, v in {**base, **changes}.items() if v != "drop"}),)], "j string")
    return df.select(validation.poll_errors(Fields(df, "j")).alias("e")).first().e


@pytest.mark.parametrize(
    "changes, starts",
    [
        ({}, []),
        ({"state": "drop"}, ["Missing required field: state"]),
        ({"pct_estimate": None}, ["Required field is null: pct_estimate"]),
        ({"cycle": 1960}, ["Invalid cycle: 1960"]),
        ({"cycle": "x"}, ["Cycle must be an integer: x"]),
        ({"state": "  "}, ["State cannot be empty"]),
        ({"state": "s" * 51}, ["State name too long: 51"]),
        ({"candidate_name": "c" * 101}, ["Candidate name too long: 101"]),
        ({"pct_estimate": 101, "pct_trend_adjusted": 90}, ["Invalid percentage estimate: 101.0"]),
        ({"pct_trend_adjusted": "y"}, ["Trend-adjusted percentage must be a number: y"]),
        ({"candidate_id": 0}, ["Candidate ID must be positive: 0"]),
        ({"candidate_id": "q"}, ["Candidate ID must be an integer: q"]),
        ({"modeldate": " "}, ["modeldate cannot be empty string"]),
        ({"language": "fr"}, ["Invalid language code: fr"]),
        ({"pct_estimate": 10, "pct_trend_adjusted": 70}, ["Large difference between estimate (10.0)"]),
    ],
)
def test_poll_rules(spark, changes, starts):
    got = poll_errors(spark, **changes)
    assert len(got) == len(starts) and all(g.startswith(s) for g, s in zip(got, starts)), got


def errors_of(spark, document, schema):
    df = spark.createDataFrame([(json.dumps(document),)], "j string").select(F.parse_json("j").alias("d"))
    return [(e.path, e.message) for e in json_schema.with_schema_errors(df, "d", schema).first().errors]


@pytest.mark.parametrize(
    "schema, good, bad",
    [
        ({"type": "string"}, "a", 1),
        ({"type": "integer"}, 2.0, 2.5),
        ({"type": "number"}, 2.5, True),
        ({"type": ["number", "null"]}, None, "x"),
        ({"type": "boolean"}, True, 0),
        ({"type": "array"}, [], {}),
        ({"type": "object"}, {}, []),
        ({"enum": ["a", 1, None]}, None, "b"),
        ({"const": 3}, 3, 4),
        ({"minimum": 0}, 0, -1),
        ({"maximum": 5}, "not a number", 6),
        ({"exclusiveMinimum": 0}, 1, 0),
        ({"exclusiveMaximum": 5}, 4, 5),
        ({"minLength": 2}, "ab", "a"),
        ({"maxLength": 2}, 12345, "abc"),
        ({"pattern": "^a+$"}, "aa", "b"),
        ({"minItems": 1}, [1], []),
        ({"maxItems": 1}, [1], [1, 2]),
        ({"items": {"type": "string"}}, ["a"], ["a", 1]),
        ({"required": ["a"]}, {"a": None}, {"b": 1}),
        ({"properties": {"a": {"type": "string"}}}, {"b": 1}, {"a": 1}),
        ({"properties": {"a": {}}, "additionalProperties": False}, {"a": 1}, {"a": 1, "b": 2}),
        ({"uniqueItems": True}, [1, "1", True, [1], None], [2, 1, 2.0]),
        ({"uniqueItems": True}, [{"a": 1}, {"a": 2}], [{"a": 1, "b": 2}, {"b": 2, "a": 1}]),
        ({"allOf": [{"type": "integer"}, {"minimum": 3}]}, 3, 2),
        ({"anyOf": [{"type": "string"}, {"minimum": 3}]}, "x", 2),
        ({"oneOf": [{"type": "integer"}, {"minimum": 3}]}, 2, 3),
        ({"oneOf": [{"type": "integer"}, {"minimum": 3}]}, 3.5, 2.5),
        ({"not": {"type": "string"}}, 1, "x"),
        ({"not": {"required": ["a"]}}, {"b": 1}, {"a": 1}),
        ({"properties": {"a": {"not": {"type": "string"}}}}, {}, {"a": "x"}),
        ({"items": {"anyOf": [{"type": "string"}, {"type": "null"}]}}, ["a", None], ["a", 1]),
        ({"properties": {"a": True, "b": False}}, {"a": 1}, {"b": 1}),
        ({"$ref": "#/definitions/name", "definitions": {"name": {"type": "string"}}}, "x", 1),
        ({"properties": {"a": {"$ref": "#/$defs/a~1b/0"}}, "$defs": {"a/b": [{"minLength": 2}]}}, {"a": "xy"}, {"a": "x"}),
    ],
)
def test_schema_keywords(spark, schema, good, bad):
    assert errors_of(spark, good, schema) == []
    assert len(errors_of(spark, bad, schema)) == 1


def test_schema_paths_and_refusals(spark):
    schema = {"properties": {"a": {"properties": {"b": {"type": "string"}}}, "l": {"items": {"properties": {"n": {"minimum": 1}}}}}}
    assert errors_of(spark, {"a": {"b": 1}, "l": [{"n": 5}, {"n": 0}]}, schema) == [
        ("a.b", "1 is not of type 'string'"),
        ("l.1.n", "0 is less than the minimum of 1"),
    ]
    df = spark.range(1).select(F.parse_json(F.lit("{}")).alias("d"))
    refused = [{"oneOf": []}, {"type": "text"}, {"additionalProperties": {}}, {"items": []}, {"anyOf": {}}, {"allOf": [{"contains": {}}]}]
    refused += [{"$ref": "#/definitions/none"}, {"$ref": "http://elsewhere/x"}, {"$ref": "#"}, {"not": {"patternProperties": {}}}]
    refused += [{"$ref": "#/definitions/a", "definitions": {"a": {"anyOf": [{"$ref": "#/definitions/b"}]}, "b": {"$ref": "#/definitions/a"}}}]
    for bad in refused:
        with pytest.raises(ValueError):
            json_schema.with_schema_errors(df, "d", bad)


def full_errors(spark, document, schema, **options):
    df = spark.createDataFrame([(json.dumps(document),)], "j string").select(F.parse_json("j").alias("d"))
    checked = json_schema.with_schema_errors(df, "d", schema, **options)
    return checked.select("errors", json_schema.error_messages(F.col("errors")).alias("texts"), json_schema.stored_error(F.col("errors")).alias("stored")).first()


def test_sub_errors_and_failed_value(spark):
    schema = {"properties": {"v": {"anyOf": [{"type": "string"}, {"type": "object", "required": ["n"], "properties": {"m": {"minimum": 5}}}]}}}
    row = full_errors(spark, {"v": {"m": 1}}, schema)
    assert [(e.path, e.message, e.failed_value) for e in row.errors] == [("v", '{"m":1} is not valid under any of the given schemas', '{"m":1}')]
    subs = ['{"m":1} is not of type \'string\'', "'n' is a required property", "1 is less than the minimum of 5"]
    assert row.errors[0].sub_errors == subs
    assert row.texts == ["Schema validation failed: " + row.errors[0].message, "Field path: v", *[f"Sub error: {m}" for m in subs]]
    assert json.loads(row.stored) == {"validation_errors": row.texts, "failed_value": {"m": 1}}
    assert full_errors(spark, {"v": "x"}, schema).stored is None


def test_one_of_names_the_schemas_that_hold(spark):
    schema = {"oneOf": [{"type": "integer"}, {"type": "string"}, {"minimum": 1}, {"maximum": 9}]}
    [error] = full_errors(spark, 5, schema).errors
    assert error.message == '5 is valid under each of {"minimum": 1}, {"maximum": 9}, {"type": "integer"}'
    [error] = full_errors(spark, -5.5, {"oneOf": schema["oneOf"][:3]}).errors
    assert len(error.sub_errors) == 3 and error.failed_value == "-5.5"


def test_combinators_inside_each_other_keep_their_paths(spark):
    schema = {"allOf": [{"properties": {"l": {"items": {"allOf": [{"not": {"const": 2}}, {"properties": {"k": {"type": "string"}}}]}}}}, {"required": ["z"]}]}
    rows = full_errors(spark, {"l": [1, 2, {"k": 3}]}, schema).errors
    assert [(e.path, e.message) for e in rows] == [
        ("", "'z' is a required property"),
        ("l.1", '2 should not be valid under {"const": 2}'),
        ("l.2.k", "3 is not of type 'string'"),
    ]


def test_references_that_come_back_are_unfolded_to_a_depth(spark):
    tree = {"definitions": {"node": {"type": "object", "required": ["name"], "properties": {"child": {"$ref": "#/definitions/node"}}}}, "$ref": "#/definitions/node"}

    def nested(n, last=None):
        return {"name": "x", **({"child": nested(n - 1, last)} if n else last or {})}

    assert full_errors(spark, nested(3), tree).errors == []
    [error] = full_errors(spark, {"name": "x", "child": {"child": {"name": "y"}}}, tree).errors
    assert (error.path, error.message) == ("child", "'name' is a required property")
    [error] = full_errors(spark, nested(4), tree).errors
    assert error.path == "child.child.child.child" and "nested deeper" in error.message
    assert full_errors(spark, nested(6), tree, ref_depth=6).errors == []
    lists = {"items": {"$ref": "#"}, "type": ["array", "integer"]}
    assert full_errors(spark, [1, [2, [3]]], lists).errors == []
    assert [e.path for e in full_errors(spark, [1, [2, ["x"]]], lists).errors] == ["1.1.0"]


def test_active_schema_is_the_newest(spark):
    doc = lambda n: json.dumps({"cleaner_name": "c", "current_schema_version": "1.0.0", "schema": {"maxLength": n}})
    schemas = spark.createDataFrame([(1, doc(1), "2024-01-01"), (2, doc(2), "2024-01-02"), (3, "{}", "2024-01-03")], "id bigint, metadata_schema string, created_at string")
    assert json_schema.load_schema(schemas, "c", "1.0.0") == (2, {"maxLength": 2})
    with pytest.raises(ValueError, match="No schema found"):
        json_schema.load_schema(schemas, "c", "9.0.0")


def test_route(spark):
    df = spark.createDataFrame([(1, []), (2, ["bad"])], "id int, errors array<string>")
    rows = {r.id: r for r in validation.route(df).collect()}
    assert rows[1].validation_status == "valid" and rows[1].validation_error is None
    assert json.loads(rows[2].validation_error) == {"validation_errors": ["bad"]}
    assert {r.validation_status for r in validation.route(df, validate=False).collect()} == {"pending"}
