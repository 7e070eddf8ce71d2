import pytest
from pyspark.sql import functions as F

from folioframe.functions import dates as D
from folioframe.functions import numbers as N
from folioframe.functions import text as T


def column(spark, values, make):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["y"] for r in rows.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_number_tokens(spark):
    cases = {"1.720.000 500 98,50": ["1.720.000", "500", "98,50"], "1 720.000": ["1 720.000"], "5.000 000": ["5.000", "000"], "31.250.000/3000.—": ["31.250.000", "3000"], "12 345 678 a9": ["12 345 678", "9"], "": [], None: []}
    assert column(spark, list(cases), N.number_tokens) == list(cases.values())


@pytest.mark.parametrize("decimal,cases", [(True, {"98,50": "98.50", "1.720": "1720", "1.5": "1.5", "": "", ",5": "5", "1.234,5": "1234.5"}), (False, {"98,50": "9850", "1O0": "100", "12'000": "12000"})])
def test_parse_number(spark, decimal, cases):
    assert column(spark, list(cases), lambda c: N.parse_number(c, decimal)) == list(cases.values())


def test_validators(spark):
    assert column(spark, ["35", "30", "25", "20025", "20000", "x", ""], N.is_nominal) == [True, False, True, False, True, False, False]
    assert column(spark, ["0", "1", "30", "31"], N.is_suspicious) == [False, True, True, False]
    assert column(spark, ["315000000", "105000000", "1234"], N.without_row_marker) == ["5000000", "5000000", "1234"]


def test_glued_and_identity(spark):
    assert column(spark, ["1000500", "123"], lambda c: F.concat_ws("/", N.glued(c)["value"], N.glued(c)["nominal"])) == ["1000/500", "123/"]
    assert column(spark, ["7 500"], N.identity_values) == [["500"]]


def test_dates(spark):
    assert column(spark, ["5-1-50", "31/2/1950", "5-13-50", "x", None], D.parse_date) == ["1950-01-05", "1950-02-31", "", "", ""]
    assert column(spark, ["1 luglio", "genn", "x"], D.parse_month_day) == ["--07-01", "--01-01", ""]
    assert column(spark, ["30-55", "1960", "29-31", "12"], D.parse_year) == ["1930-1955", "1960", "2029-1931", ""]


def test_text(spark):
    assert column(spark, ["—", " - .", "==", "a", "5", None], T.is_blank_cell) == [True, True, True, False, False, True]
    assert column(spark, ["12 Fiat ee S.p.A. ,", ""], T.clean_issuer) == ["Fiat S.p.A", ""]
    assert column(spark, ["Città  d’Asti", None], T.lookup_text) == ["citta d asti", ""]
    assert column(spark, ["=1", "a"], T.spreadsheet_safe) == ["'=1", "a"]
    assert column(spark, ["Électricité"], T.letters_only) == ["electricite"]
    assert column(spark, ["tide"], lambda c: T.match_ratio(c, F.lit("diet"))) == [0.25]
