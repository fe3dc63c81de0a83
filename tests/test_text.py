from pyspark.sql import functions as F

from sheafline.functions import arrays, jsonio, text


def one(spark, value, expr, kind="string"):
    df = spark.createDataFrame([(value,)], f"x {kind}")
    return df.select(expr(F.col("x")).alias("y")).first()["y"]


def test_clean_text_rules(spark):
    cases = {
        "a[1] b[citation needed] c[clarification needed]": "a b c",
        "“q” ‘s’ – —": "\"q\" 's' - -",
        "a\n\n\n\n\nb": "a\n\nb",
        "a\n\nb": "a\n\nb",
        "a \t  b": "a b",
        "a\n \n \nb": "a\n \n \nb",
        "  padded  \x1f": "padded",
        "[ref] [1a] kept": "[ref] [1a] kept",
        "": "",
    }
    df = spark.createDataFrame(list(cases.items()), "x string, want string")
    rows = df.select("x", "want", text.clean_text(F.col("x")).alias("got")).collect()
    assert [(r.x, r.got) for r in rows] == [(r.x, r.want) for r in rows]
    assert one(spark, None, text.clean_text) == ""


def test_clean_text_is_idempotent_without_nested_brackets(spark):
    samples = ["a [1]  b", "“x”\n\n\n\ny ", "\tz—\t\tq [citation needed]", "plain", "\n \n \n"]
    df = spark.createDataFrame([(s,) for s in samples], "x string")
    first = text.clean_text(F.col("x"))
    assert all(r.a == r.b for r in df.select(first.alias("a"), text.clean_text(first).alias("b")).collect())
    assert one(spark, "[[1]2]", text.clean_text) == "[2]"


def test_clean_title_keeps_quotes(spark):
    assert one(spark, "Test Article[1]   ", text.clean_title) == "Test Article"
    assert one(spark, " “T” – x ", text.clean_title) == "“T” – x"
    assert one(spark, None, text.clean_title) == ""


def test_counts(spark):
    assert one(spark, "one  two\nthree four", text.word_count) == 4
    assert one(spark, "", text.word_count) == 0
    assert one(spark, None, text.word_count) == 0
    assert one(spark, "héé", text.char_count) == 3
    assert one(spark, None, text.char_count) == 0


def test_collector_label(spark):
    assert one(spark, "wikipedia_collector", text.collector_label) == "Wikipedia"
    assert one(spark, "mIXED_x_y", text.collector_label) == "Mixed"


def test_string_arrays(spark):
    values = ["Category 1", "Category 1", None, "   Category 2   ", "", "Category 2", "a \t b"]
    assert one(spark, values, arrays.clean_string_array, "array<string>") == ["Category 1", "Category 2", "a b"]
    assert one(spark, None, arrays.clean_string_array, "array<string>") == []


def test_mixed_json_arrays_keep_strings_only(spark):
    got = one(spark, '["a", 123, null, {"b": 1}, "c", true]', lambda c: arrays.strings_of_variant(F.parse_json(c)))
    assert got == ["a", "c"]
    assert one(spark, '"text"', lambda c: arrays.strings_of_variant(F.parse_json(c))) == []


def test_decode_gives_empty_object_for_broken_json(spark):
    assert one(spark, '{"a": 1', lambda c: F.to_json(jsonio.decode(c))) == "{}"
    assert one(spark, '{"a": 1}', lambda c: F.to_json(jsonio.decode(c))) == '{"a":1}'
    assert one(spark, None, lambda c: F.to_json(jsonio.decode(c))) is None


def test_put_fields_keeps_nested_values(spark):
    import json

    fields = {"n": F.lit(5), "gone": F.lit(None).cast("string"), "list": F.array(F.lit("x"))}
    got = one(spark, '{"n": 1, "o": {"b": [1, null]}, "gone": "stays out"}', lambda c: jsonio.put_fields(c, fields))
    assert json.loads(got) == {"n": 5, "o": {"b": [1, None]}, "list": ["x"]}


def test_empty_objects(spark):
    df = spark.createDataFrame([(x,) for x in (None, "{}", "nope", "[1]", '{"a":null}')], "x string")
    assert [r[0] for r in df.select(jsonio.is_empty_object(F.col("x"))).collect()] == [True, True, True, True, False]


def test_canonical_json(spark):
    assert one(spark, '{"b": 1, "a": {"d": 1, "c": 2}}', jsonio.canonical) == '{"a":{"c":2,"d":1},"b":1}'
    assert one(spark, "broken", jsonio.canonical) is None
