from pyspark.sql import functions as F

from cadastre.functions import text


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


def many(spark, values, expr, kind="string"):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in sorted(frame.select("i", expr(F.col("v"))).collect())]


def test_zero_pad_never_truncates(spark):
    assert many(spark, ["", "7", "12", "123"], text.zero_pad) == ["00", "07", "12", "123"]


def test_entry_needs_exactly_one_colon(spark):
    values = ["a.b:app", "a.b", "a:b:c", "", None, ":app"]
    assert many(spark, values, text.entry_module) == ["a.b", None, None, None, None, ""]
    assert many(spark, values, text.entry_attr) == ["app", None, None, None, None, "app"]


def test_canonical_path_is_null_with_a_null_part(spark):
    frame = spark.createDataFrame([("g", "s"), ("g", None)], "g string, s string")
    found = [r[0] for r in frame.select(text.canonical_path("g", "s")).collect()]
    assert found == ["/g/s", None]


def test_strip_suffix_first_mark_to_its_line_end(spark):
    values = ["Act 01 · Context", "no mark", "a · b · c", "a · b\nc · d", "·x", "﻿ a  ·"]
    assert many(spark, values, text.strip_suffix) == [
        "Act 01", "no mark", "a", "a \nc · d", "", "a",
    ]


def test_strip_suffix_long_text(spark):
    body = "word " * 200_000
    assert one(spark, body + "· tail", text.strip_suffix) == body.strip()


def test_label_precedence(spark):
    cases = [
        ("Own", "03 Old", "Head", "Own"),
        ("", "03 Old", "Head", "Old"),
        (None, " 3  Old ", "Head", "Old"),
        (None, "42", "Head", "42"),
        (None, "  ", "Head", "  "),
        (None, "", "  " + "h" * 50, "h" * 40),
        (None, None, " ", "Slide"),
        (None, None, None, "Slide"),
        (None, " 7 Sete", None, "Sete"),
    ]
    frame = spark.createDataFrame(
        [(i, *c[:3]) for i, c in enumerate(cases)], "i int, a string, b string, c string"
    )
    found = frame.select("i", text.label_fallback("a", "b", "c").alias("l")).collect()
    assert [r["l"] for r in sorted(found)] == [c[3] for c in cases]


def test_clamp_keeps_null(spark):
    assert many(spark, [-3, 0, 2, 9, None], lambda c: text.clamp(c, 4), "int") == [0, 0, 2, 3, None]


def test_bounded_index(spark):
    values = ["#1", "#4", "#5", "#0", "#007", "#x", "#1\n", "1", "", None, "#99999999999999999999"]
    found = many(spark, values, lambda c: text.bounded_index(c, 4))
    assert found == [0, 3, 0, 0, 0, 0, 0, 0, 0, 0, 0]
    found = many(spark, values, lambda c: text.bounded_index(c, 8, -1))
    assert found == [0, 3, 4, -1, 6, -1, -1, -1, -1, -1, -1]


def test_json_array_is_strict(spark):
    values = [
        '["a", 1, null]', " [1] ", "[]", "", None, '{"k": 69}', "[1", "[1] x", "[1]]", "[1],[2]",
        "['a']", "[01]", "[NaN]", '"a"', "1", '[[1],{"a":2}]', '["a",]', '[{"a":1,"a":2}]', "null",
    ]
    assert many(spark, values, text.json_array) == [
        ["a", "1", None], ["1"], [], [], [], [], [], [], [], [],
        [], [], [], [], [], ["[1]", '{"a":2}'], [], ['{"a":1,"a":2}'], [],
    ]


def test_direction(spark):
    frame = spark.createDataFrame(
        [(0, 2, 1), (1, 1, 2), (2, 1, 1), (3, None, 1)], "i int, a int, b int"
    )
    found = frame.select("i", text.direction("a", "b").alias("d")).collect()
    assert [r["d"] for r in sorted(found)] == [1, -1, 1, 1]


def test_diagnostic(spark):
    values = ["a/b.py:3:14: E501 too long: x", "a.py:3: m", "", "a.py:x:1: m", "a:1:2: ", "a:1:2: m\nn"]
    assert [tuple(r) for r in many(spark, values, text.diagnostic)] == [
        ("a/b.py", 3, 14, "E501 too long: x"),
        (None,) * 4,
        (None,) * 4,
        (None,) * 4,
        ("a", 1, 2, ""),
        (None,) * 4,
    ]


def test_default_only_when_absent(spark):
    frame = spark.createDataFrame(
        [(0, None, ["x"]), (1, None, ["enabled"]), (2, False, ["enabled"])],
        "i int, v boolean, p array<string>",
    )
    expr = text.default_if_absent("v", "p", "enabled", True).alias("v")
    assert [r["v"] for r in sorted(frame.select("i", expr).collect())] == [True, None, False]


def test_component_order_differs_from_text_order(spark):
    frame = spark.createDataFrame([("a-b/x",), ("a/x",), ("a/b/c",)], "p string")
    found = [r[0] for r in frame.orderBy(text.path_parts("p")).collect()]
    assert found == ["a/b/c", "a/x", "a-b/x"]
