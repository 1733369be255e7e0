import pytest
from pyspark.sql import functions as F

from lading.functions import tsql


def values(spark, column, rows):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "n int, c string")
    return [row.r for row in df.select("n", column.alias("r")).orderBy("n").collect()]


def test_concat_treats_null_as_blank(spark):
    assert values(spark, tsql.concat_blank("c", F.lit("-"), F.lit(None)), ["a", None]) == ["a-", "-"]


def test_trimmed_length_ignores_trailing_spaces_only(spark):
    assert values(spark, tsql.trimmed_length("c"), ["ab  ", "  ab", "", None]) == [2, 4, 0, None]


def test_first_padding_zero_goes(spark):
    rows = ["COLOMBO 03", "100", "10", "0", "003 04", "a0\n01", "", None]
    assert values(spark, tsql.drop_padding_zero("c"), rows) == [
        "COLOMBO 3", "10", "10", "0", "03 04", "a0\n1", "", None,
    ]


def test_trailing_comma(spark):
    rows = ["a,", "a,,", "a", ",", "", None, "a,\n"]
    assert values(spark, tsql.drop_trailing_comma("c"), rows) == [
        "a", "a,", "a", "", None, None, "a,\n",
    ]


def test_head_and_tail(spark):
    rows = ["one", "one two", " one two", "a  b c ", "", None]
    assert values(spark, tsql.head_word("c"), rows) == ["", "one", "", "a", "", None]
    assert values(spark, tsql.tail_words("c"), rows) == ["one", "two", "one two", "b c", "", None]


def test_replace_is_one_pass_and_ignores_empty_search(spark):
    assert values(spark, tsql.replace_all("c", ",,", ","), [",,,", "a,,b"]) == [",,", "a,b"]
    assert values(spark, tsql.replace_all("c", "", "x"), ["ab"]) == ["ab"]


@pytest.mark.parametrize("sensitive, expected", [(True, ["Kandy Rd", ""]), (False, [" Rd", ""])])
def test_replace_collation(spark, sensitive, expected):
    column = tsql.replace_all("c", "KANDY", "", sensitive)
    assert values(spark, column, ["Kandy Rd", "KANDY"]) == expected


def test_equality_ignores_trailing_spaces(spark):
    rows = ["YES", "YES  ", "yes", "YESX", " YES", None]
    assert values(spark, tsql.equals("c", "YES"), rows) == [True, True, False, False, False, None]
    assert values(spark, tsql.equals("c", "YES", False), rows) == [True, True, True, False, False, None]


def test_membership_and_digits(spark):
    assert values(spark, tsql.is_one_of("c", ("A", "B")), ["A ", "C", None]) == [True, False, None]
    assert values(spark, tsql.has_digit("c"), ["a1", "", None]) == [True, False, None]


def test_last_part_and_deletion(spark):
    assert values(spark, tsql.last_part("c"), ["a,b,c", "a,"]) == [",c", ","]
    assert values(spark, tsql.delete_chars("c", "\r\n"), ["a\r\nb\n", "\n"]) == ["ab", ""]
