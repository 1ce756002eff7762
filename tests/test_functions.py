import datetime as dt

import pytest
from pyspark.sql import functions as F

from quern.functions import codes, dates, numbers, text


def one(spark, kind, values, change):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return [row[0] for row in df.select(change(F.col("x"))).collect()]


def test_map_codes_ignores_case_and_blanks(spark):
    labels = {"S": "Single", "M": "Married"}
    got = one(spark, "string", ["s", " M ", None, "X"], lambda c: codes.map_codes(c, labels, "n/a"))
    assert got == ["Single", "Married", "n/a", "n/a"]


def test_map_codes_on_numbers_and_without_codes(spark):
    got = one(spark, "int", [1, 2, None], lambda c: codes.map_codes(c, {1: "a"}, "z", fold=False))
    assert got == ["a", "z", "z"]
    assert one(spark, "int", [1], lambda c: codes.map_codes(c, {}, "z", fold=False)) == ["z"]


def test_long_code_lists_give_the_same_labels(spark):
    labels = {f" k{i} ": f"label {i}" for i in range(150)}
    got = one(spark, "string", ["K7", " k149", "none", None], lambda c: codes.map_codes(c, labels, "other"))
    assert got == ["label 7", "label 149", "other", "other"]
    got = one(spark, "int", [7, 149, 150, None], lambda c: codes.map_codes(c, {i: str(i) for i in range(150)}, fold=False))
    assert got == ["7", "149", None, None]


def test_threshold_is_exclusive_and_null_is_low(spark):
    got = one(spark, "double", [0.1, 0.11, None], lambda c: codes.above(c, 0.1, "High", "Low"))
    assert got == ["Low", "High", "Low"]


def test_date_from_number(spark):
    got = one(spark, "int", [20240229, 20230229, 0, 12345, None, 20231301, 99991231, -1234567], dates.date_from_number)
    leap, last = dt.date(2024, 2, 29), dt.date(9999, 12, 31)
    assert got == [leap, None, None, None, None, None, last, None]


def test_past_only_keeps_null_and_the_day_itself(spark):
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2), None]
    assert one(spark, "date", days, lambda c: dates.past_only(c, F.lit(dt.date(2024, 1, 1)))) == [days[0], None, None]


def test_month_start_fails_on_month_13(spark):
    assert one(spark, "string", ["2024-03", None], dates.month_start) == [dt.datetime(2024, 3, 1), None]
    with pytest.raises(Exception, match="not a month"):
        one(spark, "string", ["2024-13"], dates.month_start)


def test_integer_division_truncates(spark):
    df = spark.createDataFrame([(7, 2), (-7, 2), (7, 0), (None, 2)], "a int, b int")
    assert [r[0] for r in df.select(numbers.whole_quotient("a", "b")).collect()] == [3, -3, None, None]


def test_percentage_of_zero_is_null(spark):
    df = spark.createDataFrame([(1, 8), (1, 0), (None, 3)], "a int, b int")
    assert [r[0] for r in df.select(numbers.percentage(F.col("a"), F.col("b"))).collect()] == [12.5, None, None]


@pytest.mark.parametrize(
    ("sales", "quantity", "price", "new_sales", "new_price"),
    [
        (10, 2, 5, 10, 5),
        (None, 2, 5, 10, 5),
        (-10, 2, 5, 10, 5),
        (11, 2, 5, 10, 5),
        (10, 2, None, 10, 5),
        (10, 2, -5, 10, 5),
        (10, 0, 0, 0, None),
        (None, 2, None, None, None),
        (7, 2, None, 7, 3),
    ],
)
def test_sales_repair(spark, sales, quantity, price, new_sales, new_price):
    df = spark.createDataFrame([(sales, quantity, price)], "s int, q int, p int")
    row = df.select(numbers.repaired_sales("s", "q", "p"), numbers.repaired_price("s", "q", "p")).first()
    assert tuple(row) == (new_sales, new_price)


def test_degrees(spark):
    texts = ["111°40'24.022\" W", "25 02 04.688 n", "NULL", "rubbish", None, "1°1'1.5.5\" N", " 10°30'0\"S "]
    assert one(spark, "string", texts, text.degrees_from_dms) == [-111.6733, 25.0346, None, None, None, None, -10.5]


def test_accents(spark):
    words = ["Querétaro Ñandú ÀÉÎÕÜ", "é", "plain", None]
    plain = ["Queretaro Nandu AEIOU", "e", "plain", None]
    assert one(spark, "string", words, text.strip_accents) == plain
    assert one(spark, "string", words, text.strip_accents_any_script) == plain
    signs = ["1ª Sección 2º", "ﬁn ½ ĳs", "Ḿ Å x²"]
    assert one(spark, "string", signs, text.strip_accents) == ["1a Seccion 2o", "fin 1⁄2 ijs", "M A x2"]
    assert one(spark, "string", ["Αθήνα", "й"], text.strip_accents_any_script) == ["Αθηνα", "и"]


def test_text_pieces(spark):
    assert one(spark, "string", ["NASAW1", "AW1", None], lambda c: text.strip_prefix(c, "NAS")) == ["AW1", "AW1", None]
    assert one(spark, "string", ["CO-RF-FR-1  ", "abc"], lambda c: text.tail_from(c, 7)) == ["FR-1  ", ""]
    assert one(spark, "string", ["*", "N/D", "5", None], text.blank_to_null) == [None, None, "5", None]
