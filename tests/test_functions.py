from __future__ import annotations

import datetime as dt
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.conftest import day
from tidemark import fixed
from tidemark.functions import dates, numbers, rows, tdist, vocab


def apply(frame, fn, values, kind="string"):
    df = frame(f"i int, x {kind}", enumerate(values))
    return [r[0] for r in df.orderBy("i").select(fn(F.col("x"))).collect()]


def test_clean_number(frame):
    cases = {
        "रू १,२३४.५": 1234.5, "  42 ": 42.0, "1,000": 1000.0, "1_000": 1000.0, "1e3": 1000.0, "-.5": -0.5,
        "": None, "n/a": None, "nan": None, "1d": None, "_1": None, "1__0": None, "५": 5.0, "1 2": None, None: None,
        "inf": math.inf, "\t7\n": 7.0,
    }
    assert apply(frame, numbers.clean_number, list(cases)) == list(cases.values())


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=8))
def test_any_printed_float_is_read_back(frame, xs):
    assert apply(frame, numbers.clean_number, [repr(x) for x in xs]) == xs


def test_ascii_digits_keeps_the_rest(frame):
    assert apply(frame, numbers.ascii_digits, ["०१२३४५६७८९ x", None]) == ["0123456789 x", None]


def test_normalize_category_order_decides(frame):
    names = ["गोलभेडा ठूलो(नेपाली)", "गोलभेडा सानो(टनेल)", "गोलभेडा", " आलु (रातो) ", None, "x गोलभेडा सानो y"]
    want = ["Tomato_Big", "Tomato_Small", "Tomato", "आलु", "nan", "Tomato_Small"]
    assert apply(frame, numbers.normalize_category, names) == want


def test_no_nan(frame):
    assert apply(frame, numbers.no_nan, [1.0, float("nan"), None], "double") == [1.0, None, None]


def test_parse_date(frame):
    texts = ["2024-02-29", "02/29/2024", "02/30/2024", "2024/1/1x", "", None, "2024-02-29 11:12:13"]
    want = [day("2024-02-29"), day("2024-02-29"), None, None, None, None, day("2024-02-29")]
    assert apply(frame, dates.parse_date, texts) == want


def test_extract_ad_date(frame):
    texts = [
        "2082.12.11(2026.03.26)", "2018.04.02 (2074.12.19)", "प्रेस 2082.05.15 (2025.08.31)", "2025.13.01",
        "2025.13.01 2024/2/3", "no date", None, "2082-01-01", "२०२४.०१.०२",
    ]
    want = [day("2026-03-26"), day("2018-04-02"), day("2025-08-31"), None, day("2024-02-03"), None, None, None, day("2024-01-02")]
    assert apply(frame, dates.extract_ad_date, texts) == want


def test_parse_rfc822_is_utc(frame):
    texts = ["Mon, 01 Jan 2024 10:00:00 GMT", "Mon, 1 Jan 2024 10:00:00 +0545", "1 Jan 2024 10:00:00 GMT", "yesterday", "", None]
    want = [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 4, 15), dt.datetime(2024, 1, 1, 10), None, None, None]
    assert apply(frame, dates.parse_rfc822, texts) == want


def test_fiscal_labels(frame):
    assert apply(frame, dates.fiscal_start_year, ["2021/22", "2022/23 (2079/80)", "Jul/Aug", "21/22", None]) == [2021, 2022, None, None, None]
    assert apply(frame, dates.month_pair_number, ["Jul/Aug", " jun/jul ", "x", None]) == [7, 6, None, None]


def test_calendar_parts(frame):
    assert apply(frame, dates.weekday, [day("2024-01-01"), day("2024-01-07")], "date") == [0, 6]
    assert apply(frame, dates.is_weekend, [day("2024-01-05"), day("2024-01-06"), day("2024-01-07")], "date") == [0, 1, 1]
    weeks = apply(frame, lambda c: dates.weeks_to_day_of_year(c, 280), [day("2023-10-07"), day("2023-01-01"), day("2023-07-01")], "date")
    assert weeks == pytest.approx([0.0, 86 / 7, 98 / 7])


@pytest.mark.parametrize(
    ("text", "flag"),
    [("2024-03-01", 1), ("2024-03-20", 1), ("2024-03-21", 0), ("2024-04-09", 0), ("2024-04-10", 1), ("2024-09-24", 0),
     ("2024-09-25", 1), ("2024-10-15", 1), ("2024-10-16", 0), ("2024-11-01", 1), ("2024-11-16", 0)],
)
def test_festival_ranges(frame, text, flag):
    assert apply(frame, lambda c: dates.in_day_ranges(c, fixed.FESTIVAL_RANGES), [day(text)], "date") == [flag]


def test_harvest_months_differ_by_use():
    assert 11 in fixed.SEARCH_HARVEST_MONTHS and 11 not in fixed.SEASON_MONTHS["is_terai_harvest"]


def test_first_match_order(frame):
    texts = ["flood in sarlahi and kathmandu", "kavrepalanchok hit", "dhading", "nowhere", "", None]
    got = apply(frame, lambda c: vocab.first_match(F.lower(c), fixed.PLACE_NAMES), texts)
    assert got == ["Kathmandu", "Kavre", "Dhading", None, None, None]


def test_event_type_order(frame):
    texts = ["Flood after landslide", "river overflow", "road closed by heavy rain", "calm"]
    got = apply(frame, lambda c: vocab.first_group(F.lower(c), fixed.EVENT_WORDS), texts)
    assert got == ["Landslide", "Flood", "Road_Block", None]


def test_severity_tiers_and_variants(frame):
    texts = ["quiet", "flood", "major flood", "flood, two killed", "extreme flood killed many", "death toll rises", "damaged road"]
    assert apply(frame, lambda c: vocab.tier_score(F.lower(c), fixed.SEVERITY_WORDS), texts) == [1, 2, 3, 4, 5, 1, 1]
    assert apply(frame, lambda c: vocab.tier_score(F.lower(c), fixed.SEVERITY_WORDS_LOCAL), texts) == [1, 2, 3, 4, 5, 4, 2]


def test_row_statistics_skip_nulls(frame):
    df = frame("a double, b double, c double", [(1.0, 3.0, None), (None, None, None), (2.0, None, None), (1.0, 2.0, 6.0)])
    cols = [F.col(c) for c in "abc"]
    got = df.select(rows.row_mean(cols), rows.row_std(cols), rows.row_max(cols)).collect()
    assert [tuple(r) for r in got] == [
        (2.0, pytest.approx(math.sqrt(2)), 3.0), (None, None, None), (2.0, None, 2.0), (3.0, pytest.approx(math.sqrt(7)), 6.0),
    ]


def test_student_t_known_values(frame):
    # one and two degrees of freedom have closed forms
    cases = [(t, v) for v in (1, 2) for t in (-30.0, -2.0, -0.5, 0.0, 0.7, 3.0)]
    df = frame("t double, v bigint", cases)
    got = [r[0] for r in df.select(tdist.student_t_cdf(F.col("t"), F.col("v"))).collect()]
    want = [0.5 + math.atan(t) / math.pi if v == 1 else 0.5 + t / (2 * math.sqrt(2 + t * t)) for t, v in cases]
    assert got == pytest.approx(want, abs=1e-8)


def test_student_t_tables(frame):
    # 97.5 % quantiles of the t table
    cases = [(12.706205, 1), (2.228139, 10), (2.042272, 30), (1.983972, 100), (1.959966, 1_000_000)]
    got = [r[0] for r in frame("t double, v bigint", cases).select(tdist.student_t_cdf(F.col("t"), F.col("v"))).collect()]
    assert got == pytest.approx([0.975] * len(cases), abs=2e-6)
    nulls = frame("t double, v bigint", [(None, 3), (1.0, 0), (1.0, None)])
    assert [r[0] for r in nulls.select(tdist.student_t_cdf(F.col("t"), F.col("v"))).collect()] == [None] * 3


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_local_today_in_any_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        df = spark.sql("select explode(array(timestamp'2024-01-01 18:14:00Z', timestamp'2024-01-01 18:16:00Z')) t")
        got = [r[0] for r in df.select(dates.local_today(F.col("t"))).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert got == [day("2024-01-01"), day("2024-01-02")]
