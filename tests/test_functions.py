"""Hand-made edge rows for every column function."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelflow.functions import dates, numbers, owners, text

D = dt.date


def test_to_number(mapped):
    given_texts = ["1,234", " 12 ", "nan", "", "abc", "1e3", None, "1d", "2f", "0x1p3", "inf", "-Infinity", ".5", "7."]
    inf = float("inf")
    expected = [None, 12.0, None, None, None, 1000.0, None, None, None, None, inf, -inf, 0.5, 7.0]
    assert mapped(numbers.to_number, given_texts, "x string") == expected


def test_rounding_goes_to_even(mapped):
    assert mapped(lambda x: numbers.round_base(x, 5000), [12500.0, 17500.0, None], "x double") == [10000.0, 20000.0, None]
    assert mapped(lambda x: numbers.round_base(x, 25000), [62500.0, 37500.0], "x double") == [50000.0, 50000.0]
    tens = [15000.0, 25000.0, 1234567.0, None]
    assert mapped(numbers.round_ten_thousands, tens, "x double") == [20000.0, 20000.0, 1230000.0, None]


def test_positive_and_sums(mapped):
    assert mapped(numbers.positive_or_null, [5.0, 0.0, -1.0, None, float("nan")], "x double") == [5.0, None, None, None, None]
    assert mapped(numbers.sum_parts, [(1.0, 2.0, 3.0), (1.0, None, 3.0)], "a double, b double, c double") == [6.0, None]
    assert mapped(numbers.sale_type_code, [None, "I", "L"], "x string") == ["0", "1", "L"]


def test_price_interval(mapped):
    lower = mapped(lambda p: numbers.price_interval(p)[0], [200000.0], "p double")
    upper = mapped(lambda p: numbers.price_interval(p)[1], [200000.0], "p double")
    assert (lower, upper) == ([180000.0], [220000.0])  # 175,000 and 225,000, halves to even


def test_padding_never_cuts(mapped):
    assert mapped(lambda x: text.pad_left(x, 3), ["12345", "1", None], "x string") == ["12345", "001", None]
    key = mapped(
        lambda *p: text.build_key(list(zip(p, (3, 4, 4, 2)))),
        [("1", "2", "3 ", "4"), ("1", None, "3", "4")],
        "a string, b string, c string, d string",
    )
    assert key == ["0010002003" + "04", None]


def test_identifiers(mapped):
    assert mapped(text.normalize_id, ["12-34.5", None], "x string") == ["12345", None]
    assert mapped(lambda x: text.id_part(x, 2), ["ohio-butler"], "x string") == ["butler"]
    assert mapped(text.first_token, ["  WD  deed", "one", None], "x string") == ["WD", "one", None]
    assert mapped(text.clean_missing, ["NaN", "NaT", "none", "x", None], "x string") == [None, None, None, "x", None]


def test_title_case(mapped):
    names = ["o'brien 123abc mc-donald LLC", None, "", "PEÑA st"]
    assert mapped(text.title_case, names, "x string") == ["O'Brien 123Abc Mc-Donald Llc", None, "", "Peña St"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.text(alphabet=st.sampled_from("abcXYZ 019'-.,_/é"), max_size=40))
def test_title_case_is_python_title_case(one, name):
    assert one(text.title_case(F.lit(name))) == name.title()


def test_business(mapped):
    names = ["Acme LLC", "llc", "Incline", "Main Incline", None]
    assert mapped(owners.is_business, names, "x string") == [1, 0, 0, 1, 0]


def test_same_owner(mapped):
    cases = {
        ("Hernandez Al", "Smith Bo", None): 0,
        ("Jane Smith", "John Smith", None): 1,
        ("Al Fox", "Al Fox Jr", None): 1,
        ("Bo Lee", "Al Fox", None): 0,
        ("Bo Lee", None, None): 0,
        (None, "Bo Lee", None): 0,
        ("Al Fox Jr", "Bo Lee", "Al Fox"): 1,
        ("Al Fox", "Bo Lee", "Al Fox Jr"): 0,
        ("Mary Jones", "Bo Lee", "Tim Jones"): 1,
        ("MARY", "mary ann", None): 1,
    }
    result = mapped(owners.same_owner, list(cases), "owner string, prev string, prev2 string")
    assert result == list(cases.values())


def test_good_sale(mapped):
    cases = [(0, None), (0, 0.0), (1, 5.0), (0, 5.0)]
    assert mapped(owners.good_sale, cases, "same int, price double") == [1, 0, 0, 1]


def test_day_month_year(mapped):
    texts = ["05-JAN-68", "05-Jan-99", "5-Jan-20", "bad", None]
    parsed = mapped(lambda x: dates.parse_day_month_year(x, F.lit(D(2026, 6, 1))), texts, "x string")
    assert parsed == [D(1968, 1, 5), D(1999, 1, 5), D(2020, 1, 5), None, None]


def test_date_from_parts(mapped):
    parts = [(2021, 2, 3), (2021, 2, 30), (None, 1, 1), (98, 1, 1)]
    assert mapped(dates.date_from_parts, parts, "y int, m int, d int") == [D(2021, 2, 3), None, None, None]
    assert mapped(dates.four_digit_year, [98, 99, 97, 2005, None], "y int") == [1998, 1999, 97, 2005, None]
    assert mapped(dates.parse_date, ["2021-02-03", "2/3/2021", "2021-02-03 04:05:06", "x"], "x string") == [
        D(2021, 2, 3), D(2021, 2, 3), D(2021, 2, 3), None,
    ]


def test_whole_years(mapped):
    pairs = [
        (D(2020, 6, 30), D(2021, 6, 1)), (D(2021, 6, 1), D(2021, 5, 1)), (D(2021, 6, 1), D(2020, 5, 1)),
        (D(2020, 6, 1), D(2021, 5, 31)), (None, D(2021, 1, 1)),
    ]
    assert mapped(dates.whole_years_between, pairs, "a date, b date") == [1, -1, -2, 0, None]
    assert mapped(lambda x: dates.capped(x, 25), [3, 30, None], "x int") == [3, 25, None]


def test_age(mapped):
    age = mapped(lambda y: dates.age_since_year(y, F.lit(D(2022, 3, 1))), [1799, 2000, None, 1800], "y int")
    assert age == [None, 22, None, 222]
    assert mapped(dates.january_first, [2000, None, 0], "y int") == [D(2000, 1, 1), None, None]


def test_month_sequence(mapped):
    pairs = [
        (D(2020, 2, 29), D(2020, 5, 10)), (D(2020, 5, 1), D(2020, 4, 30)), (D(2020, 1, 31), D(2020, 2, 1)),
        (D(2020, 2, 29), D(2020, 2, 29)),
    ]
    months = mapped(dates.month_sequence, pairs, "a date, b date")
    assert months == [
        [D(2020, 3, 1), D(2020, 4, 1), D(2020, 5, 1)], [], [D(2020, 1, 1), D(2020, 2, 1)], [],
    ]
    assert mapped(dates.date_text, [D(2020, 1, 2)], "d date") == ["2020-01-02"]
