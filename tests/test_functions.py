import datetime as d

import pytest
from pyspark.sql import functions as F

from callops.functions import dates as dt
from callops.functions import numbers as nm
from callops.functions import text as tx


def apply(spark, rule, values, kind="string"):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in frame.select("i", rule(F.col("v"))).orderBy("i").collect()]


def test_first_integer(spark):
    cases = {
        "[a, 3, 4]": "3", "[ 5 ]": "5", "[[1],2]": "2", "[-2,1]": "-2", "['3',4]": "4", "[]": "NoResponse",
        "": "NoResponse", "x": "NoResponse", "[1.5, 2]": "2", "[1_0]": "1_0", "[+7]": "+7", None: "NoResponse",
    }
    assert apply(spark, tx.first_integer, cases) == list(cases.values())


def test_rating_number(spark):
    assert apply(spark, tx.rating_number, ["5", "NoResponse", None]) == [5, None, None]


def test_expected_rows(spark):
    cases = {"Total 3 rows found 9": 3, "none": None, "x3 4\t5": 4, "": None, "007": 7, "3.5 2": 2}
    assert apply(spark, tx.expected_rows, cases) == list(cases.values())


def test_duration_normalise(spark):
    cases = {
        "0:75:10": "01:15:10", "1:2:3": "01:02:03", "25:00:61": "25:01:01", "123:00:00": "123:00:00",
        "abc": "abc", "1:2": "1:2", None: None, "1:2:3:4": "1:2:3:4", "00:00:-1": "-1:59:59", " 1:2:3": "01:02:03",
    }
    assert apply(spark, nm.normalise_duration, cases) == list(cases.values())


def test_duration_seconds(spark):
    assert apply(spark, nm.duration_seconds, ["01:02:03", None, "00:00:01.5", "x"]) == [3723.0, None, 1.5, None]


def test_quotes(spark):
    assert apply(spark, tx.quotes_to_backtick, ["a'b\"c"]) == ["a`b'c"]
    assert apply(spark, tx.quotes_dropped, ["a'b\"c"]) == ["ab'c"]


def test_sanitise_is_per_row(spark):
    frame = spark.createDataFrame([(1, "it's", 'a"b'), (2, "fine", 'a"b'), (3, None, "x'y")], "i int, a string, b string")
    out = [tuple(r) for r in tx.sanitise_rows(frame, tx.quotes_to_backtick).orderBy("i").collect()]
    assert out == [(1, "it`s", "a'b"), (2, "fine", 'a"b'), (3, None, "x`y")]


def test_names(spark):
    assert apply(spark, tx.drop_nbsp, [r"a\xa0b", "a b", None]) == ["AB", "AB", None]
    assert apply(spark, tx.strip, ["  \t x y \n　", "\x1cz", None]) == ["x y", "z", None]
    assert apply(spark, tx.ascii_only, ["é1 2ü"]) == ["12"]
    assert apply(spark, tx.upper_name, ["o'neil", None]) == ["O'NEIL", None]
    assert apply(spark, tx.blank_to_null, ["a", " ", "", " ", None]) == ["a", None, None, None, None]


@pytest.mark.parametrize("days,band", [
    (-1, "0-30 days"), (30, "0-30 days"), (31, "30-60 days"), (60, "30-60 days"), (90, "60-90 days"),
    (120, "90-120 days"), (180, "120-180 days"), (181, "Above 180 days"), (None, "Above 180 days"),
])
def test_tenure_band(spark, days, band):
    as_of = d.date(2023, 6, 1)
    joined = None if days is None else as_of - d.timedelta(days=days)
    assert apply(spark, lambda c: dt.tenure_band(c, "2023-06-01"), [joined], "date") == [band]


def test_calendar_against_python(spark):
    days = [d.date(2022, 12, 20) + d.timedelta(days=i) for i in range(800)]
    assert apply(spark, dt.monday_week_number, days, "date") == [int(x.strftime("%W")) for x in days]
    assert apply(spark, dt.weekday_abbr, days, "date") == [x.strftime("%a").lower() for x in days]
    assert apply(spark, dt.day_first_text, days, "date") == [x.strftime("%d-%m-%Y") for x in days]


def test_dates(spark):
    assert apply(spark, dt.lenient_date, ["2023-01-02", "xx", None]) == [d.date(2023, 1, 2), None, None]
    assert apply(spark, dt.text_date, ["2023-01-02", "02/01/2023"]) == [d.date(2023, 1, 2), None]
    cut = lambda c: dt.after_cutoff(c, "2023-09-09")
    assert apply(spark, cut, [d.date(2023, 5, 5), d.date(2023, 5, 6), None], "date") == [False, True, None]
    month = lambda c: dt.in_month(c, "2023-05-20")
    assert apply(spark, month, [d.date(2023, 5, 1), d.date(2022, 5, 1)], "date") == [True, False]


def test_nan_and_ratio(spark):
    assert apply(spark, nm.nan_to_null, [1.0, float("nan"), None], "double") == [1.0, None, None]
    assert apply(spark, lambda c: nm.percent(F.lit(1), c), [3, 0, None], "int") == [33.33, None, None]
