from pyspark.sql import functions as F

from respondo.functions import numbers, text, vectors


def column(spark, values, build, kind="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [r[0] for r in df.select(build(F.col("x"))).collect()]


def test_strip_takes_all_white_space(spark):
    assert column(spark, [" a b\t", "　가\n", None, "", " "], text.strip) == ["a b", "가", None, "", ""]


def test_null_tokens_and_fillers(spark):
    assert column(spark, ["NA", "x", "", "null", None], text.null_tokens) == [None, "x", None, None, None]
    assert column(spark, ["merged", " nan ", "ok", None, " "], text.has_value) == [False, False, True, False, False]


def test_first_text_does_not_fall_through_blanks(spark):
    df = spark.createDataFrame([(None, " a "), (" ", "b"), (None, None)], "x string, y string")
    assert [r[0] for r in df.select(text.first_text(F.col("x"), F.col("y"))).collect()] == ["a", None, None]


def test_numbers_in_texts(spark):
    assert column(spark, ["3.0", "abc", None, "7"], text.number_text) == ["3", "abc", None, "7"]
    assert column(spark, ["(1,234)", "2024-01-01", "12:30", "1_000", "x", "nan", None], text.cleaned_number) == [-1234.0, 20240101.0, 1230.0, 1000.0, None, None, None]


def test_anchor(spark):
    assert column(spark, ["문17-1", "Q17_1", "B1701A", "SQ04", "기타", None], text.anchor) == ["17-1", "17-1", "17-1", "4", None, None]


def test_type_precedence(spark):
    assert column(spark, ["방금 고르신 곳의 좋은 점은?", "기타 좋은 점", "떠올릴 때 생각나는", "?"], text.question_type) == ["depend_pos_neg", "etc_pos_neg", "img", "concept"]


def test_lenient_json(spark):
    got = column(spark, ['{"a": 1}', '```json\n{"a": 2}\n```', "garbage", None, "{}"], lambda c: text.lenient_json(c, "a int", "a")["a"])
    assert got == [1, 2, None, None, None]


def test_template(spark):
    import pytest

    assert column(spark, ["q", None], lambda c: text.template("<{x}> {y}", x=c, y="z")) == ["<q> z", "<> z"]
    assert text.template_names("{a} {b} {a}") == ["a", "b"]
    with pytest.raises(KeyError):
        text.template("{missing}")


def test_project_name(spark):
    assert column(spark, ["-2024년01월_Alpha survey", "123", "가온 7"], text.project_name) == ["alpha", "default", "가온"]


def test_money_and_time(spark):
    assert column(spark, [0.0, 0.005, 1.5], numbers.cost_text, "double") == ["$0.00", "$0.005000", "$1.5000"]
    assert column(spark, [59.9, 3599.0, 3600.0], numbers.runtime_text, "double") == ["59.9s", "59m 59.0s", "1h 0m 0.0s"]
    df = spark.createDataFrame([("2031-01-01T00:00:00", "2031-01-01T00:00:01.5"), ("bad", "2031-01-01")], "a string, b string")
    assert [r[0] for r in df.select(numbers.seconds_between(F.col("a"), F.col("b"))).collect()] == [1.5, 0.0]


def test_grades(spark):
    assert column(spark, [0.96, 0.88, 0.83, 0.72, 0.1], numbers.grade, "double") == ["EXCELLENT", "GOOD", "FAIR", "IMPROVE", "FAIL"]


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0], [4.0, 3.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<float>, b array<float>")
    rows = df.select(vectors.cosine(F.col("a"), F.col("b")).alias("c"), vectors.unit(F.col("a")).alias("u")).collect()
    assert abs(rows[0].c - 0.96) < 1e-6 and rows[0].u == [0.6, 0.8]
    assert rows[1].c is None and rows[1].u is None
    assert column(spark, ["[1.0, 2.5]", "eval(1)"], vectors.parse_vector) == [[1.0, 2.5], None]
