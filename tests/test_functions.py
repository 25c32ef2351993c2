import datetime as dt
from decimal import Decimal

import pytest
from conftest import plan
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfscout.functions import categories, cleaning, display, scoring
from shelfscout.policy import CategoryPolicy


def column_of(spark, values, expression, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
    return [row[0] for row in df.orderBy("i").select(expression).collect()]


def test_clean_string_strips_every_white_space(spark):
    raw = ["  a b ", "\tx\n", " y　", "", "   ", "\t ", None]
    assert column_of(spark, raw, cleaning.clean_string("c")) == ["a b", "x", "y", None, None, None, None]


def test_whitespace_list_is_the_unicode_property(spark):
    text = "".join(map(chr, range(1, 0x3100)))
    (left,) = column_of(spark, [text], F.regexp_replace("c", r"(?U)\S", ""))
    assert sorted(left) == sorted(cleaning.WHITESPACE)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=cleaning.WHITESPACE + "aé", max_size=8), min_size=1, max_size=8))
def test_both_trims_agree(spark, texts):
    edge = cleaning.WHITESPACE
    expected = [t.strip(edge) for t in texts]
    assert column_of(spark, texts, cleaning.trimmed("c")) == expected
    assert column_of(spark, texts, cleaning.trimmed_fact("c")) == expected
    assert column_of(spark, [None], cleaning.trimmed_fact("c")) == [None]


def test_parse_money(spark):
    raw = ["GBP 76,503.29", "76503.29", " GBP -5.5 ", "n/a", "", "1-2", "(500)", None]
    parsed = column_of(spark, raw, cleaning.parse_money("c"))
    assert parsed == [
        Decimal("76503.29"), Decimal("76503.29"), Decimal("-5.5"), None, None, None, Decimal(500), None,
    ]
    strict = column_of(spark, raw, cleaning.money_layout_ok("c"))
    assert strict == [True, True, True, False, None, False, False, None]


def test_dates_keep_to_one_format(spark):
    raw = ["24/01/2023", "4/1/2023", "31/02/2023", "2023-01-24", "24/01/23", " ", None]
    day = dt.date(2023, 1, 24)
    assert column_of(spark, raw, cleaning.parse_dmy("c")) == [
        day, dt.date(2023, 1, 4), None, None, None, None, None,
    ]
    assert column_of(spark, raw, cleaning.parse_iso("c")) == [None, None, None, day, None, None, None]


def test_key_of_any_type_becomes_text(spark):
    assert column_of(spark, [4829, None], cleaning.normalise_key("c"), "int") == ["4829", None]


def test_full_name_without_parts_is_empty_not_null(spark):
    df = spark.createDataFrame(
        [(1, " Ada ", "Byron"), (2, None, " Byron"), (3, "Ada", ""), (4, None, " ")],
        "i int, f string, l string",
    )
    names = [r[0] for r in df.orderBy("i").select(cleaning.full_name("f", "l")).collect()]
    assert names == ["Ada Byron", "Byron", "Ada", ""]


def test_unknown_stage_is_open(spark):
    raw = ["Closed Won ", "Closed Lost", "Negotiation", "closed won", None]
    assert column_of(spark, raw, cleaning.stage_group("c")) == ["won", "lost", "open", "open", "open"]


def test_fingerprint_tells_missing_from_shifted(spark):
    df = spark.createDataFrame(
        [("a", None, "b"), ("a", "b", None), (" a", "b ", ""), ("ab", None, None)], "x string, y string, z string"
    )
    prints = [r[0] for r in df.select(cleaning.row_fingerprint(["x", "y", "z"])).collect()]
    assert prints[1] == prints[2]
    assert len(set(prints)) == 3


def test_fingerprint_holds_separators_apart(spark):
    pairs = [("x\x1fy", "z"), ("x", "y\x1fz"), ("\x1e", "a"), (None, "a"), ("null", "a"), ('x","c1":"y', "z"), ("", "a")]
    df = spark.createDataFrame(pairs, "x string, y string")
    prints = [r[0] for r in df.select(cleaning.row_fingerprint(["x", "y"])).collect()]
    # Only the missing and the empty text are one value once cleaned.
    assert len(set(prints)) == len(pairs) - 1
    assert prints[3] == prints[6]
    hashes = [r[0] for r in df.select(cleaning.row_hash(["x", "y"])).collect()]
    assert len(set(hashes)) == len(pairs)


def classified(spark, names, policy):
    df = spark.createDataFrame([(n,) for n in names], "category_name string")
    found = categories.classify(df, policy).collect()
    return [(r.cat_group, r.gin_category) for r in found]


def test_categories_by_list_only(spark):
    policy = CategoryPolicy()
    names = [" imported dry gins", "FLAVORED GIN", "Flavored Gins ", "AMERICAN DRY GINS",
             "AMERICAN SLOE GINS", "PUERTO RICO & VIRGIN ISLANDS RUM", None]
    assert classified(spark, names, policy) == [
        ("GIN_PREMIUM", "IMPORTED DRY GINS"),
        ("GIN_PREMIUM", "FLAVORED GINS"),
        ("GIN_PREMIUM", "FLAVORED GINS"),
        ("GIN_OTHER", "AMERICAN DRY GINS"),
        ("NON_GIN", None),
        ("NON_GIN", None),
        ("NON_GIN", None),
    ]
    assert policy.details == (
        "IMPORTED DRY GINS", "IMPORTED GINS", "FLAVORED GINS", "AMERICAN DRY GINS",
    )


def test_policy_without_aliases(spark):
    policy = CategoryPolicy(premium=("A",), other=("B",), aliases={})
    assert classified(spark, ["a", "b", "c"], policy) == [
        ("GIN_PREMIUM", "A"), ("GIN_OTHER", "B"), ("NON_GIN", None),
    ]


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (None, 2), (3, None)], "a int, b int")
    assert [r[0] for r in df.select(scoring.safe_ratio("a", "b")).collect()] == [0.5, None, None, None]


def test_numbers_for_people(spark):
    values = [1234.5, 1235.5, -0.4, 0.0, None, 1e9]
    assert column_of(spark, values, display.fmt_int(F.col("c")), "double") == [
        "1,234", "1,236", "-0", "0", None, "1,000,000,000",
    ]
    assert column_of(spark, values[:2], display.fmt_plain_int(F.col("c")), "double") == ["1234", "1236"]
    assert column_of(spark, [5.0, None], display.fmt_currency(F.col("c"), "£"), "double") == ["£5", "-"]
    shares = [0.125, 0.135, 1.0, None]
    assert column_of(spark, shares, display.fmt_share(F.col("c")), "double") == ["12%", "14%", "100%", "0%"]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet="abXY 'o-.3é", max_size=12), min_size=1, max_size=8))
def test_title_case_equals_python(spark, texts):
    assert column_of(spark, texts, display.title_case(F.col("c"))) == [t.title() for t in texts]


@pytest.mark.parametrize("factor", ["0.005", "0.015", "2.5"])
def test_format_rounds_half_even_like_python(spark, factor):
    value = float(factor) * 100
    assert column_of(spark, [value], display.fmt_int(F.col("c")), "double") == [f"{value:,.0f}"]


def test_quick_paths_of_cleaning_and_dates_equal_the_slow_ones(spark):
    edges = [None, "", " ", "\t", "a", " a", "a ", " a　", "é", " é ", "aé", "\x7f", "\x7fa ", "\x1ca", "a​", " ", "x y\n"]
    days = ["31/02/2024", "29/02/2024", "01/12/1999", " 01/12/1999 ", "1/2/2024", "01/12/0099", "01/12/0000", "01/12/1999\n"]
    days += ["2024-02-30", "2024-02-29", "2024-2-9", "0000-01-01", "0099-01-01", "2024-13-01", "٠١/١٢/١٩٩٩", "007/01/2024", "01/12/+12024"]
    df = spark.createDataFrame([(v,) for v in edges + days], "v string")
    slow = F.nullif(F.btrim("v", F.lit(cleaning.WHITESPACE)), F.lit(""))
    pairs = [
        (cleaning.trimmed("v"), F.btrim("v", F.lit(cleaning.WHITESPACE))),
        (cleaning.clean_string("v"), slow),
        (cleaning.parse_dmy("v"), F.try_to_date(slow, "d/M/yyyy")),
        (cleaning.parse_iso("v"), F.try_to_date(slow, "yyyy-M-d")),
    ]
    unlike = [F.struct("v", a.alias("a"), b.alias("b")) for a, b in pairs]
    for one in unlike:
        assert df.select(one.alias("o")).where("not (o.a <=> o.b)").collect() == []
    quick = df.select(cleaning.parse_dmy("v"), cleaning.parse_iso("v"))
    assert "RLIKE" in plan(quick)
