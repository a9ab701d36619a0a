import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import (
    WHITE_SPACE,
    is_blank,
    is_uuid,
    merge_text,
    random_uuid,
    trim_unicode,
    truncate_chars,
    uuid5,
)
from tidemark.plans.spec import PATIENT_NAMESPACE

SLOW_START = settings(
    max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def one_column(spark, values, column):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in rows.orderBy("i").select(column(F.col("v"))).collect()]


def test_uuid5_equals_standard_library(spark):
    ids = [-(2**63), -1, *range(0, 3_000), 2**31, 2**63 - 1]
    rows = spark.createDataFrame([(i,) for i in ids], "id long")
    got = {r.id: r.key for r in rows.select("id", uuid5(F.col("id"), PATIENT_NAMESPACE).alias("key")).collect()}
    assert got == {i: str(uuid.uuid5(PATIENT_NAMESPACE, str(i))) for i in ids}
    assert got[1] == "3eb9191e-e35a-5b19-ab9a-5e4526c482d0"


@SLOW_START
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"])), min_size=1, max_size=50))
def test_uuid5_of_any_text(spark, values):
    got = one_column(spark, values, lambda c: uuid5(c, uuid.NAMESPACE_DNS))
    assert got == [str(uuid.uuid5(uuid.NAMESPACE_DNS, v)) for v in values]


def test_uuid5_of_null(spark):
    assert one_column(spark, [None], lambda c: uuid5(c, PATIENT_NAMESPACE)) == [None]


BLANKS = st.text(st.sampled_from(WHITE_SPACE), max_size=4)
WORDS = st.text(st.characters(exclude_categories=["Cs"]), max_size=12)


@SLOW_START
@given(st.lists(st.tuples(BLANKS, WORDS, BLANKS).map("".join), min_size=1, max_size=50))
def test_trim_unicode(spark, values):
    assert one_column(spark, values, trim_unicode) == [v.strip(WHITE_SPACE) for v in values]


def test_white_space_is_the_unicode_property():
    assert len(set(WHITE_SPACE)) == 25
    assert all(c.isspace() for c in WHITE_SPACE)


@SLOW_START
@given(st.lists(WORDS, min_size=1, max_size=50), st.integers(0, 15))
def test_truncate_counts_code_points(spark, values, limit):
    assert one_column(spark, values, lambda c: truncate_chars(c, limit)) == [
        v[:limit] for v in values
    ]


@pytest.mark.parametrize(
    ("first", "last", "expected"),
    [
        ("Bayu", "Wijaya", "Bayu Wijaya"),
        ("  ", "\t", ""),
        ("Dian", "", "Dian"),
        ("", "Dian", "Dian"),
        (None, None, ""),
        (None, "Dian", "Dian"),
        (" Ana　", "", "Ana"),
        (" a b ", " c ", "a b c"),
    ],
)
def test_merge_text(spark, first, last, expected):
    row = spark.createDataFrame([(first, last)], "a string, b string")
    assert row.select(merge_text(F.col("a"), F.col("b"))).first()[0] == expected


def test_truncated_text_is_not_trimmed_again(spark):
    merged = one_column(spark, ["ab cd"], lambda c: truncate_chars(merge_text(c), 3))
    assert merged == ["ab "]


def test_is_blank(spark):
    assert one_column(spark, [None, "", "  ", "x"], is_blank) == [True, True, True, False]


def test_is_uuid(spark):
    good = "3eb9191e-e35a-5b19-ab9a-5e4526c482d0"
    values = {
        good: True,
        good.upper(): True,
        "urn:uuid:" + good: True,
        "{" + good + "}": True,
        good.replace("-", ""): True,
        good.replace("-", "", 1): False,
        good + "\n": False,
        " " + good: False,
        "{" + good: False,
        good[:-1] + "g": False,
        "": False,
    }
    assert dict(zip(values, one_column(spark, list(values), is_uuid))) == values


def test_random_uuid(spark):
    keys = [r[0] for r in spark.range(500).select(random_uuid()).collect()]
    assert len(set(keys)) == 500
    assert all(uuid.UUID(k).version == 4 for k in keys)
