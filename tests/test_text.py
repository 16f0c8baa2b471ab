"""Location, title, folding, tags, skills and display texts."""

import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from rolecall.functions import display, skills, text
from rolecall.functions.location import location_std


def column(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")


def apply(spark, values, expression):
    return [r[0] for r in column(spark, values).orderBy("i").select(expression(F.col("v"))).collect()]


FOLDED = [
    ("Ho Chi Minh City", "Ho Chi Minh"), ("HCM", "Ho Chi Minh"), ("Sai Gon", "Ho Chi Minh"), ("Hà Nội", "Ha Noi"),
    ("Hanoi", "Ha Noi"), ("HN", "Ha Noi"), ("Đà Nẵng", "Da Nang"), ("Danang", "Da Nang"), ("Remote", "Remote"),
    ("Work from home", "Remote"), ("Binh Duong", "Other"), (None, "Other"), ("john", "Other"),
]
ASCII = [("Hà Nội", "Other"), ("ha noi", "Ha Noi"), ("john", "Ha Noi"), ("hnay", "Other"), (" HCM ", "Ho Chi Minh"), (None, "Other")]
ACCENTED = [("Hà Nội", "Ha Noi"), ("Hồ Chí Minh", "Ho Chi Minh"), ("Sài Gòn", "Ho Chi Minh"), ("Đà Nẵng", "Da Nang"), ("sai gon", "Other")]


@pytest.mark.parametrize("dialect,cases", [("folded", FOLDED), ("ascii", ASCII), ("accented", ACCENTED)])
def test_locations(spark, dialect, cases):
    assert apply(spark, [c[0] for c in cases], lambda v: location_std(v, dialect)) == [c[1] for c in cases]


def test_titles(spark):
    cases = [("  A  B ", "A B"), ("A\nB\tC\r\nD", "A B C D"), (None, ""), ("a  b　", "a b"), ("Đ é", "Đ é")]
    assert apply(spark, [c[0] for c in cases], text.clean_title) == [c[1] for c in cases]


def expected_fold(value):
    plain = unicodedata.normalize("NFKD", value.replace("Đ", "D").replace("đ", "d"))
    return "".join(c for c in plain if not unicodedata.combining(c)).lower().strip()


def test_fold_composed_and_decomposed(spark):
    words = ["Thỏa thuận", "Đà Nẵng", "ÀÉÎÕÜ ç ñ", "  İstanbul ", "สวัสดี", "ＡＢＣ１", "a b", ""]
    values = words + [unicodedata.normalize("NFD", w) for w in words]
    assert apply(spark, values, text.ascii_fold) == [expected_fold(v) for v in values]
    assert apply(spark, [None], text.ascii_fold) == [""]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(max_codepoint=0xFFFF, exclude_categories=["Cs"], exclude_characters="\x00"), max_size=20), min_size=1, max_size=40))
def test_compat_fold_equals_full_rule(spark, values):
    assert apply(spark, values, lambda v: text.ascii_fold(v, compat=True)) == [expected_fold(v) for v in values]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(min_codepoint=0x20, max_codepoint=0x17F, exclude_characters="¼½¾ĲĳĿŀŉſ\x7f" + "".join(map(chr, range(0x80, 0xA0)))), max_size=30), min_size=1, max_size=40))
def test_default_fold_is_exact_on_latin_text(spark, values):
    assert apply(spark, values, text.ascii_fold) == [expected_fold(v) for v in values]


def test_tags(spark):
    decode = lambda v: text.decode_tags(v)
    assert apply(spark, ['["a","b"]', "x, y,, z", None, '["1","2","3","4","5","6","7"]', "[]"], decode) == [
        ["a", "b"], ["x", "y", "z"], None, ["1", "2", "3", "4", "5", "6"], [],
    ]
    unique = lambda v: text.ordered_unique_tags(F.split(v, ","))
    assert apply(spark, ["b, a,,b , c"], unique) == [["b", "a", "c"]]


def test_skills(spark):
    found = lambda whole: lambda v: skills.matched_skills(text.search_text(v, F.lit(None)), whole_words=whole)
    titles = ["Golang developer", "C# and .NET", "JavaScript/Java", "category manager", "Power BI", None]
    assert apply(spark, titles, found(False)) == [
        ["Golang", "Go"], ["C#", ".Net"], ["Java", "Javascript"], ["Go"], ["Power Bi"], [],
    ]
    assert apply(spark, titles, found(True)) == [["Golang"], ["C#", ".Net"], ["Java", "Javascript"], [], ["Power Bi"], []]


def test_display(spark):
    assert apply(spark, ["Login to view", None, "", "1 USD"], display.salary_display) == [display.SALARY_PLACEHOLDER] * 3 + ["1 USD"]
    df = spark.createDataFrame([(1000.0, 2000.0, "USD"), (1000.0, None, "USD"), (5.0, 5.0, "VND"), (None, 3e6, None)], "a double, b double, c string")
    shown = [r[0] for r in df.select(display.salary_range_display(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert shown == ["1,000 - 2,000 USD", "Từ 1,000 USD", "Từ 5 VND", "0 - 3,000,000 VND"]


def test_every_character_folds_without_python(spark):
    every = [chr(c) for c in range(1, 0x110000) if unicodedata.category(chr(c)) not in ("Cs", "Cn", "Co")]
    values = ["x" + "y".join(every[i : i + 50]) + "x" for i in range(0, len(every), 50)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i")
    for folded in (df.select("v", text.ascii_fold(F.col("v")).alias("f")), df.select("v", text.ascii_fold(F.col("v"), compat=True).alias("f"))):
        assert "Python" not in folded._jdf.queryExecution().executedPlan().toString()
    wrong = [r for r in folded.collect() if r.f != expected_fold(r.v)]
    # Java knows fewer capitals of recent Unicode versions: a letter may keep its case, nothing else
    assert all(r.f.lower() == expected_fold(r.v) for r in wrong) and len(wrong) < 40
    assert apply(spark, ["한국어 각 ﬁ ½ ㍿ ﷺ"], text.ascii_fold) == [expected_fold("한국어 각 ﬁ ½ ㍿ ﷺ")]


def test_parsing_and_locations_need_no_python(spark):
    from rolecall.functions.location import with_location
    from rolecall.functions.salary import with_salary

    df = spark.createDataFrame([("½ triệu", "Ｈà Nội")], "salary string, location string")
    plan = with_location(with_salary(df), dialect="folded")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
