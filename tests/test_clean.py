import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weekmart.functions import clean as c


@pytest.fixture(scope="module")
def texts(spark):
    def run(expression, *values):
        frame = spark.createDataFrame([(v,) for v in values], "t string")
        return [r[0] for r in frame.select(expression(F.col("t"))).collect()]
    return run


def test_numbers(texts):
    assert texts(c.to_number, "1,234.5", " 7 ", "", "x", None, "-3") == [1234.5, 7.0, None, None, None, -3.0]
    with pytest.raises(PySparkException):
        texts(lambda t: c.to_number(t, strict=True), "x")


def test_sign_is_kept_unless_asked_otherwise(texts):
    assert texts(c.digits_number, "-1,200 lb", "$ 5", "lb") == [-1200.0, 5.0, None]
    assert texts(lambda t: c.digits_number(t, keep_sign=False), "-1,200 lb") == [1200.0]
    assert texts(c.dash_number, "-", "-5", "1,000") == [0.0, -5.0, 1000.0]
    assert texts(lambda t: c.dash_number(t, keep_sign=False), "-", "-5") == [0.0, 5.0]


def test_categories(texts):
    assert texts(c.category_equal, "Potato", "Sweet Potato", "Onion", None) == ["Potato", "Potato", "Prepared Foods", "Prepared Foods"]
    assert texts(lambda t: c.category_contains(t, "POT"), "FRZ POT", "x", None) == ["Potato", "Prepared Foods", "Prepared Foods"]
    assert texts(lambda t: c.category_contains(t, "Potato", keep_null=True), "Sweet Potato", None) == ["Potato", None]
    assert texts(c.category_prefix, "Potato Skins", "Sweet Potato") == ["Potato", "Prepared Foods"]
    assert texts(c.category_inside, "Pot", "Potatoes") == ["Potato", "Prepared Foods"]


def test_cities(texts, spark):
    assert texts(lambda t: c.clean_city(t, ["TORONTO"]), " toronto east", "Ottawa", None) == ["TORONTO", "NA", "NA"]
    assert texts(c.clean_city, "Toronto") == ["NA"]
    assert c.with_clean_city(spark.range(1)).first().city == "NA"


def test_blanks(texts):
    assert texts(c.blank_to_null, " a ", "  ", "\t", "", None) == ["a", None, None, None, None]
    assert texts(lambda t: c.blank_to_null(t, any_space=False), "\t", "  ") == ["\t", None]


def test_ids(texts):
    assert texts(c.strip_decimal, "10.0", "1.05", "7") == ["10", "1.05", "7"]
    assert texts(c.strip_zeros, "00120", "0") == ["120", ""]
    assert texts(lambda t: c.last_chars(t, 3), "12345") == ["345"]


def test_imputed_weight(spark, rows):
    frame = spark.createDataFrame([(0.0, 2.0, 5.0), (0.0, 0.0, 5.0), (3.0, 2.0, 5.0), (0.0, 1.0, None)], "w double, q double, cw double")
    assert [r[0] for r in frame.select(c.impute_weight(F.col("w"), F.col("q"), F.col("cw"))).collect()] == [10.0, 0.0, 3.0, None]


def test_pack_and_size(spark, rows):
    frame = spark.createDataFrame([("6/5 LB/x", "a"), ("6", "b"), (None, "c")], "pack string, size string")
    assert rows(c.split_pack(frame)) == [("6", "5 LB/x"), ("6", "b"), (None, "c")]


def test_row_filters_keep_nulls(spark, rows):
    frame = spark.createDataFrame([("a-b",), ("ab",), (None,)], "t string")
    assert rows(c.drop_containing(frame, "t")) == [("ab",), (None,)]
    assert rows(c.drop_prefix(frame, "t", "a")) == [(None,)]


def test_relabel_without_column(spark):
    frame = spark.range(1)
    assert c.relabel(frame, "segment_l2", {"a": "b"}) is frame


def test_headers(spark):
    assert c.plain_headers(spark.range(1).withColumnRenamed("id", "SAP_Key"), "SAP_").columns == ["key"]
