"""Edge rows of the column functions."""

import pytest
from pyspark.sql import functions as F

from starloom.functions import arrays, encode, numeric, text


def column(spark, values, kind, expression):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in rows.orderBy("i").select(expression.alias("r")).collect()]


def test_rounding_is_half_even_and_never_negative_zero(spark):
    got = column(spark, [0.5, 1.5, 2.5, -0.4, 2.675, None], "double", numeric.rounded("v", 0))
    assert got == [0.0, 2.0, 2.0, 0.0, 3.0, None]
    assert str(got[3]) == "0.0"


def test_number_parsing(spark):
    values = ["1", " 2.5 ", "1e3", "-.5", "x", "", None, "1d", "0x10", "nan", "3."]
    assert column(spark, values, "string", numeric.to_number("v")) == [
        1.0, 2.5, 1000.0, -0.5, None, None, None, None, None, None, 3.0,
    ]
    for values, kind, expected in ((["7", "x", None], "string", [7.0, 0.0, 0.0]), ([True, None], "boolean", [1.0, 0.0]), ([2.5, float("nan")], "double", [2.5, 0.0])):
        df = spark.createDataFrame([(v,) for v in values], f"v {kind}").coalesce(1)
        assert [r[0] for r in df.select(numeric.number_or_zero(df, "v")).collect()] == expected


def test_nan_becomes_null(spark):
    assert column(spark, [1.0, float("nan"), None], "double", numeric.nan_as_null("v")) == [1.0, None, None]


@pytest.mark.parametrize(
    ("low", "high", "expected"), [(1.0, 3.0, 2.0), (None, 3.0, 3.0), (1.0, None, 1.0), (None, None, None)]
)
def test_midpoint(spark, low, high, expected):
    rows = spark.createDataFrame([(low, high)], "a double, b double")
    assert rows.select(numeric.midpoint("a", "b")).first()[0] == expected


def test_ratios(spark):
    rows = spark.createDataFrame([(3.0, 7.0), (3.0, 0.0), (3.0, None), (None, 2.0)], "a double, b double")
    got = rows.select(numeric.ratio_or_null("a", "b"), numeric.ratio_over_one("a", "b")).collect()
    assert [tuple(r) for r in got] == [(0.4286, 0.4286), (None, 3.0), (None, None), (None, None)]
    errors = rows.select(numeric.percentage_error("b", "a")).collect()
    assert errors[1][0] is None and errors[0][0] == pytest.approx(400 / 7)


def test_range_mask_is_closed(spark):
    values = [19_999.99, 20_000.0, 500_000.0, 500_000.01, None]
    assert column(spark, values, "double", numeric.within("v", 20_000, 500_000)) == [None, 20_000.0, 500_000.0, None, None]


def test_epoch_and_month(spark):
    month = numeric.month_label(numeric.epoch_ms_to_timestamp("v"))
    assert column(spark, ["1672531200000", "x", None], "string", month) == ["2023-01", None, None]


def test_flag(spark):
    assert column(spark, [1.0, 0.0, None], "double", numeric.flag("v")) == [1, 0, 0]


def test_clean_text(spark):
    values = [
        None, "", "<p><b></b></p>", "12 345", "the and of", "A\tB\nData Science!", "x<br>Python3 SQL", "don't stop",
        "Run<a href='x'>ning</a>",
    ]
    assert column(spark, values, "string", text.clean_text("v")) == [
        "", "", "", "", "", "data science", "python sql", "stop", "run ning",
    ]
    assert column(spark, ["", "a b c"], "string", text.token_count("v")) == [0, 3]


def test_titles(spark):
    assert column(spark, ["\t Senior Dev \n", None], "string", text.normal_title("v")) == ["senior dev", None]
    values = ["Team LEADer", "Analyst", None, "VP"]
    assert column(spark, values, "string", text.keyword_flag("v")) == [1, 0, 0, 1]
    assert column(spark, values, "string", text.keyword_flag("v", whole_words=True)) == [0, 0, 0, 1]


def test_regions(spark):
    values = ["California", " TX ", "ny", "Ontario", None, "New York\t", "QQ", ""]
    assert column(spark, values, "string", encode.region_code("v")) == [
        "CA", "TX", "Unknown", "Unknown", "Unknown", "NY", "QQ", "Unknown",
    ]


def test_ordinals_and_labels(spark):
    levels = ["Director", "nonsense", None]
    assert column(spark, levels, "string", encode.ordinal("v", encode.EXPERIENCE_CODES, -1)) == [4, -1, -1]
    assert column(spark, ["IT", "XX", None], "string", encode.label("v")) == ["Info Technology", "XX", None]
    assert column(spark, ["skill_count", "some_other"], "string", encode.feature_label("v")) == ["Skill count", "Some Other"]
    tricky = {"it's": "a\\b", "x": "y"}
    assert column(spark, ["it's", "x"], "string", encode.label("v", tricky)) == ["a\\b", "y"]


def test_dummies_drop_the_first_value(spark):
    rows = spark.createDataFrame([("B",), ("A",), ("C",), (None,)], "v string")
    got = rows.select(*[c.alias(n) for n, c in encode.dummies("v", ["C", "A", "B"], "work").items()])
    assert got.columns == ["work_B", "work_C"]
    assert [tuple(r) for r in got.collect()] == [(1, 0), (0, 0), (0, 1), (0, 0)]


def test_arrays(spark):
    rows = spark.createDataFrame([(["b", "a", "b"],), ([],)], "v array<string>")
    got = rows.select(arrays.keep_allowed("v", ["b"]), arrays.multi_hot("v", ["a", "b", "c"]), arrays.length("v")).collect()
    assert [tuple(r) for r in got] == [(["b", "b"], [1, 1, 0], 3), ([], [0, 0, 0], 0)]
    assert rows.select(encode.set_label("v", {"a": "Alpha"})).first()[0] == "Alpha + b + b"
