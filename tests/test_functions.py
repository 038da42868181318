"""Column functions on tables of example strings."""

import hashlib
import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from postlens import fixed_values as fv
from postlens.functions import experience, labels, requests, salary, text


def column(spark, values, *expressions, schema="s string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {schema}")
    return [tuple(r)[1:] for r in df.select("i", *expressions).orderBy("i").collect()]


def test_salary_bounds(spark):
    cases = {
        "10 - 20 triệu": (10_000_000, 20_000_000),
        "Từ 15 triệu": (15_000_000, None),
        "Tới 30 triệu": (None, 30_000_000),
        "upto 2000 usd": (None, 48_000_000),
        "1000 - 2000 USD": (24_000_000, 48_000_000),
        "3000 - 5000 triệu": (3_000_000_000, 5_000_000_000),
        "Thoả thuận": (None, None),
        "thỏa thuận": (None, None),
        "Trên 10 triệu": (None, None),
        "99999999999 - 99999999999": (None, None),
        " ": (None, None),
        None: (None, None),
    }
    got = column(spark, list(cases), salary.min_salary("s"), salary.max_salary("s"))
    assert got == list(cases.values())


def test_salary_bands_cover_the_line(spark):
    values = [-1.0, 0.0, 9_999_999.0, 10_000_000.0, 99_999_999.5, 100_000_000.0, 1e12, None]
    got = [r[0] for r in column(spark, values, salary.salary_bench("s"), schema="s double")]
    assert got == ["Below 10M VND"] * 3 + ["10-20M VND", "90-100M VND", "Above 100M VND", "Above 100M VND", "Not Specified"]


def test_salary_value_lies_between_its_bounds(spark):
    rows = [(10, 20), (None, 7), (7, None), (None, None), (3, 4)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    got = [r[0] for r in df.select(salary.salary_value("a", "b")).collect()]
    assert got == [15.0, 7.0, 7.0, None, 3.5]


def test_salary_text_label(spark):
    rows = [(None, None), (None, 30_000_000), (None, 5_000_000), (15_000_000, None), (10_000_000, 20_000_000)]
    df = spark.createDataFrame(rows, "a bigint, b bigint")
    got = [r[0] for r in df.select(salary.salary_band_label("a", "b")).collect()]
    assert got == ["Not Specified", "20-30000000M VND", "0-5000000M VND", "15-25M VND", "10-20M VND"]


def test_experience(spark):
    cases = {
        "2-4 năm": ("2-4", 3.0),
        "2 – 3 năm": ("2 – 3", None),
        "Từ 2 TO 3 Years": ("2 TO 3", None),
        "3+ years": ("3+", 3.0),
        "3 + yea": (None, None),
        "dưới 1 năm": ("1-", 0.5),
        "ít nhất 2 năm": ("2+", 2.0),
        "5 năm": ("5", 5.0),
        "không": ("Unknown", None),
        None: ("Unknown", None),
    }
    years = experience.extract_experience("s")
    assert column(spark, list(cases), years, experience.years_normalized(years)) == list(cases.values())


def test_experience_bands_cover_the_line(spark):
    got = column(
        spark, [None, 0.5, 1.0, 3.0, 5.0, 8.0], experience.years_band("s"), experience.years_level("s"), schema="s double"
    )
    assert got == [
        ("Unknown", "Unknown"),
        ("0-1 year", "Intern / Fresher"),
        ("1-3 years", "Junior"),
        ("3-5 years", "Mid-level"),
        ("5-8 years", "Senior"),
        ("8+ years", "Lead / Principal"),
    ]


def test_initcap_starts_words_after_any_boundary(spark):
    cases = {
        " data-engineer c++/python ": "Data-Engineer C++/Python",
        "kỹ sư (ai)\tđề_x": "Kỹ Sư (Ai)\tĐề_x",
        "o'neil ßa 3d": "O'Neil ßa 3d",
        None: None,
    }
    assert [r[0] for r in column(spark, list(cases), text.initcap_trim("s"))] == list(cases.values())


@settings(max_examples=25, deadline=None)
@given(st.lists(st.text(alphabet="aB 1_-/(đẩÉ\t", max_size=12), min_size=1, max_size=8))
def test_initcap_matches_plain_python(spark, values):
    import regex

    expected = [regex.sub(r"\b(\w)", lambda m: m[1].upper(), v.strip().lower()) for v in values]
    assert [r[0] for r in column(spark, values, text.initcap_trim("s"))] == expected


def test_location_and_keys(spark):
    assert column(spark, ["Hà Nội (mới) & Đà Nẵng", None], text.normal_location("s")) == [("hà nội  - đà nẵng",), (None,)]
    a, b = column(spark, ["x", None], text.surrogate_key(F.lit("p"), "s"))
    assert a == (hashlib.md5(b"p|x").hexdigest().upper(),)
    assert b == (None,)


def test_labels(spark):
    words = [" Từ xa ", "tá»« xa", "lai", "AT OFFICE", "khác", None]
    assert [r[0] for r in column(spark, words, labels.work_model("s"))] == ["Remote", "Remote", "Hybrid", "On-Site", "khác", None]
    words = ["Toàn thời gian", "part time", "Thực tập", "x"]
    assert [r[0] for r in column(spark, words, labels.work_arrangement("s"))] == ["Full-time", "Part-time", "Internship", "x"]
    words = ["Đại học hoặc cao đẳng", "PhD", "master", "", None]
    assert [r[0] for r in column(spark, words, labels.education_level("s"))] == ["College", "PhD", "Master", "Unknown", "Unknown"]


def test_request_plans(spark):
    cases = {
        "cho tôi 2 job lương cao nhất": (2, 50, True, True),
        "kiếm job data analyst phù hợp": (5, 5, False, False),
        "cho tôi 3 job Python remote lương cao nhất": (3, 50, True, False),
        "top 30 highest salary": (10, 50, True, True),
        "hai việc": (2, 2, False, False),
        "0 job": (5, 5, False, False),
    }
    df = spark.createDataFrame([(i, m) for i, m in enumerate(cases)], "i int, m string")
    got = df.select("i", requests.plan_query("m").alias("p")).select("i", "p.*").orderBy("i").collect()
    assert [tuple(r)[1:] for r in got] == list(cases.values())
    asked = df.limit(1).select(requests.plan_query("m", F.lit(20)).alias("p")).select("p.response_limit").first()
    assert asked[0] == fv.MAX_RESPONSE_LIMIT


def test_salary_from_text_and_sort_value(spark):
    cases = {"10 - 20 Triệu": 20.0, "25 - 50 Triệu": 50.0, "Thoả Thuận": -1.0, "12,5 - 13": 13.0, "2000 USD": 50.0, None: -1.0}
    none = F.lit(None).cast("string")
    got = [r[0] for r in column(spark, list(cases), salary.salary_sort_value(none, F.lit(""), "s"))]
    assert all(math.isclose(a, b) for a, b in zip(got, cases.values()))
    assert column(spark, ["12,5", " 7 ", "x", "", None], salary.number_value("s")) == [(12.5,), (7.0,), (None,), (None,), (None,)]


def test_fold_accents_keeps_letters_without_decomposition(spark):
    assert column(spark, ["Đường Lương Cao NHẤT", "é"], text.fold_accents("s")) == [("đuong luong cao nhat",), ("e",)]


def test_preview(spark):
    got = column(spark, ["a \n b", "x" * 12, None], text.preview("s", 10))
    assert got == [("a b",), ("x" * 10 + "...",), ("<None>",)]


@pytest.mark.parametrize("word", ["nơi khác", "từ xa", "thời"])
def test_misread_words_are_lower_case(word):
    assert labels.misread(word) == labels.misread(word).lower() != word
