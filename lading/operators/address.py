"""Splitting a one-line address into building, street and city.

Every stage is a ``DataFrame -> DataFrame`` step for ``df.transform`` over a
frame with ``address`` and ``town``; other columns pass through. ``clean`` chains
them. There is no shuffle in any stage.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lading.functions import tsql
from lading.operators.spread import checked_hot_rows, hot_keys, spread_join

# Words that belong to the building although they carry no number.
BUILDING_WORDS = ("FLOOR", "TOWER", "LANE")
# Longest street that still takes the last words of the building part,
# and the field limits of the target system.
JOINED_STREET_LIMIT = 30
BUILDING_LIMIT = 35
STREET_LIMIT = 30
CITY_LIMIT = 30
# Fixed value: the report looks back this many months.
REPORT_MONTHS = 6


@dataclass(frozen=True)
class Rules:
    """Options of the cleaning.

    ``repaired`` changes three habits of the original rules: a building word is
    no longer repeated in the street, two spaces in the report become one
    instead of none, and a town is cut from the address only as a whole word.
    ``case_sensitive=False`` compares text as a case-insensitive collation does.
    """

    repaired: bool = False
    case_sensitive: bool = True


DEFAULT = Rules()


def resolve_source(pickups: DataFrame, customers: DataFrame, hot_rows: int | None = None) -> DataFrame:
    """Pickups with the customer's address or town where their own is missing.

    Address and town fall back independently and only from NULL. Pickups without
    a customer stay, with ``customer_found`` false. ``customer_id`` must be unique
    in ``customers``.

    It is the only join of the cleaning, so the adaptive skew join can split a
    customer with very many pickups. With ``hot_rows``, customers with that many
    are found by a count and salted instead.
    """
    owner = customers.filter("customer_id IS NOT NULL").select(
        "customer_id",
        F.col("customer_id").alias("_owner_id"),
        "customer_name",
        F.col("address").alias("_owner_address"),
        F.col("town").alias("_owner_town"),
    )
    if hot_rows is None:
        joined = pickups.join(owner, "customer_id", "left")
    else:
        hot = hot_keys(pickups, ["customer_id"], checked_hot_rows(hot_rows))
        joined = spread_join(pickups, owner, ["customer_id"], hot, spread_by=["pickup_id"])
    return joined.select(
        "pickup_id",
        "customer_id",
        "customer_name",
        F.coalesce("pickup_address", "_owner_address").alias("address"),
        F.coalesce("pickup_town", "_owner_town").alias("town"),
        "created_date",
        F.col("_owner_id").isNotNull().alias("customer_found"),
    )


def settle(df: DataFrame, columns: list[str]) -> DataFrame:
    """Evaluate ``columns`` here, once per row.

    Catalyst moves a filter below projections by substituting their expressions
    into it. Each stage uses its input several times, so over all stages that
    text would outgrow the driver's memory. Filters do not move below a
    generator; this one yields exactly one row per row. It also starts a new
    function in the generated code: without it all stages form one function,
    which is longer than the JVM is willing to compile.
    """
    others = [c for c in df.columns if c not in columns]
    return df.select(*others, F.inline(F.array(F.struct(*columns))))


def strip_town_zero(df: DataFrame) -> DataFrame:
    """``COLOMBO 03`` becomes ``COLOMBO 3``; an empty town becomes NULL; tabs go."""
    town = F.when(F.col("town") != "", tsql.drop_padding_zero("town"))
    return df.withColumn("town", tsql.delete_chars(town, "\t"))


def strip_address_zero(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """The same for the part after the last comma, wherever that part occurs."""
    part = F.col("_part")
    stripped = tsql.replace_all("address", part, tsql.drop_padding_zero(part), rules.case_sensitive)
    address = F.when(F.contains("address", F.lit(",")), stripped).otherwise(F.col("address"))
    df = df.withColumn("_part", tsql.last_part("address")).withColumn(
        "address", tsql.delete_chars(address, "\t")
    )
    return settle(df.drop("_part"), ["address", "town"])


def remove_town(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Cut the town, also written without spaces, out of the address.

    Adds ``cln_address`` and keeps the input as ``orig_address``.
    """
    town = tsql.replace_all("town", ",", "")
    df = df.withColumn("town", town)
    joined_town = tsql.replace_all("town", " ", "")
    if rules.repaired:
        rest = _cut_word(_cut_word(F.col("address"), F.col("town"), rules), joined_town, rules)
    else:
        rest = tsql.replace_all("address", F.col("town"), "", rules.case_sensitive)
        rest = tsql.replace_all(rest, joined_town, "", rules.case_sensitive)
    df = df.withColumn("cln_address", tsql.replace_all(F.trim(rest), ",,", ",")).withColumnRenamed(
        "address", "orig_address"
    )
    return settle(df, ["cln_address", "town", "orig_address"])


def _cut_word(text: Column, word: Column, rules: Rules) -> Column:
    """Delete ``word`` where no letter or digit touches it."""
    quoted = F.replace(word, F.lit("\\E"), F.lit("\\E\\\\E\\Q"))
    flags = "" if rules.case_sensitive else "(?i)"
    pattern = F.concat(
        F.lit(flags + "(?<![\\p{L}\\p{N}])\\Q"), quoted, F.lit("\\E(?![\\p{L}\\p{N}])")
    )
    return F.when(word == "", text).otherwise(F.regexp_replace(text, pattern, F.lit("")))


def strip_trailing_commas(df: DataFrame) -> DataFrame:
    """Up to two trailing commas go, then all dots."""
    once = df.withColumn("cln_address", F.trim(tsql.drop_trailing_comma("cln_address")))
    text = F.rtrim(tsql.drop_trailing_comma("cln_address"))
    return once.withColumn("cln_address", tsql.delete_chars(text, "."))


def extract_street(df: DataFrame) -> DataFrame:
    """Add ``street``: from the last comma to the end, empty without a comma."""
    text = F.col("cln_address")
    street = F.when(F.contains(text, F.lit(",")), tsql.last_part(text)).when(text.isNotNull(), F.lit(""))
    return df.withColumn("street", street)


def finish_street(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Take the street out of ``cln_address`` and tidy both; add ``has_street``."""
    rest = F.trim(tsql.replace_all("cln_address", F.col("street"), "", rules.case_sensitive))
    street = F.when(F.col("street") != "", F.substr("street", F.lit(2)))
    df = (
        df.withColumn("cln_address", rest)
        .withColumns(
            {
                "cln_address": _without_breaks(tsql.drop_trailing_comma("cln_address")),
                "street": _without_breaks(street),
            }
        )
        .withColumn("has_street", F.when(tsql.trimmed_length("street") > 0, "Y").otherwise("N"))
    )
    return settle(df, ["cln_address", "street", "has_street"])


def _without_breaks(text: Column) -> Column:
    # Line breaks go before the trim and tabs after it, so a tab can leave spaces behind.
    return tsql.delete_chars(F.trim(tsql.delete_chars(text, "\r\n")), "\t")


def split_prefixes(df: DataFrame) -> DataFrame:
    """Add ``prefix1`` to ``prefix4``: up to three leading words, and the rest.

    The last word is always in ``prefix4``.
    """
    df = (
        df.withColumn("prefix1", tsql.head_word("cln_address"))
        .withColumn("_rest", tsql.tail_words("cln_address"))
        .withColumn("prefix2", tsql.head_word("_rest"))
        .withColumn("_rest", tsql.tail_words("_rest"))
        .withColumn("prefix3", tsql.head_word("_rest"))
        .withColumn("prefix4", tsql.tail_words("_rest"))
        .drop("_rest")
    )
    return settle(df, ["prefix1", "prefix2", "prefix3", "prefix4"])


def assign_fields(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """Add ``building``, replace ``street`` by the final one, rename ``town`` to ``city``."""
    first, second, third, last = (F.col(f"prefix{i}") for i in range(1, 5))
    space = F.lit(" ")
    street = F.col("street")
    first_two = tsql.concat_blank(first, space, second)
    last_two = tsql.concat_blank(third, space, last)

    separate_street = F.col("has_street") == "Y"
    joined = F.col("_joined")
    fits = tsql.trimmed_length(joined) <= JOINED_STREET_LIMIT

    only_first = (
        (tsql.trimmed_length(second) == 0)
        & (tsql.trimmed_length(third) == 0)
        & (tsql.trimmed_length(last) == 0)
    )
    numbered_first, numbered_second = F.col("_numbered1"), F.col("_numbered2")
    no_number = ~numbered_first & ~numbered_second
    short_second = tsql.trimmed_length(second) <= 1
    named_second = tsql.is_one_of(second, BUILDING_WORDS, rules.case_sensitive)
    # The length of the third word guards only the last of these cases.
    long_third = tsql.trimmed_length(third) > 1
    two_in_building = numbered_second | (numbered_first & (short_second | named_second) & long_third)
    two_off_street = (
        two_in_building if rules.repaired else numbered_second | (numbered_first & short_second & long_third)
    )

    building = (
        F.when(separate_street & fits, tsql.concat_blank(first, space, second, space, third))
        .when(separate_street, F.col("cln_address"))
        .when(only_first | no_number, F.lit(None).cast("string"))
        .when(two_in_building, first_two)
        .otherwise(first)
    )
    final_street = (
        F.when(separate_street & fits, joined)
        .when(separate_street, street)
        .when(only_first, first)
        .when(no_number, F.concat(F.trim(first_two), space, F.trim(last_two)))
        .when(two_off_street, last_two)
        .otherwise(F.concat(F.trim(tsql.concat_blank(second, space, third)), space, last))
    )
    df = df.withColumns(
        {
            "_joined": tsql.concat_blank(last, space, street),
            "_numbered1": tsql.has_digit(first),
            "_numbered2": tsql.has_digit(second),
        }
    ).withColumns({"building": building, "street": F.trim(final_street)})
    df = df.drop("_joined", "_numbered1", "_numbered2").withColumnRenamed("town", "city")
    return settle(df, ["building", "street", "city"])


FIELDS = [
    "cln_address",
    "prefix1",
    "prefix2",
    "prefix3",
    "prefix4",
    "building",
    "street",
    "city",
    "has_street",
    "orig_address",
]


def clean(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """All stages over a frame with ``address`` and ``town``; adds ``FIELDS``."""
    return (
        df.transform(strip_town_zero)
        .transform(strip_address_zero, rules)
        .transform(remove_town, rules)
        .transform(strip_trailing_commas)
        .transform(extract_street)
        .transform(finish_street, rules)
        .transform(split_prefixes)
        .transform(assign_fields, rules)
    )


CLEANED_COLUMNS = ["pickup_id", "customer_id", "customer_name", *FIELDS]


def with_customer(source: DataFrame) -> DataFrame:
    """Only pickups whose customer exists; Catalyst turns the lookup into an inner join."""
    return source.filter("customer_found")


def clean_pickups(pickups: DataFrame, customers: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    """The cleaned table: one row per pickup that has a customer."""
    source = with_customer(resolve_source(pickups, customers))
    return clean(source, rules).select(*CLEANED_COLUMNS)


def recent_pickups(pickups: DataFrame, as_of: dt.date | str, months: int = REPORT_MONTHS) -> DataFrame:
    """Pickups created in the ``months`` before ``as_of``, as a range Parquet can prune on."""
    start = F.add_months(F.lit(str(as_of)).cast("date"), -months)
    return pickups.filter(F.col("created_date") >= start.cast(pickups.schema["created_date"].dataType))


def too_long(df: DataFrame, building: int = BUILDING_LIMIT, street: int = STREET_LIMIT, city: int = CITY_LIMIT) -> DataFrame:
    """Rows with a field over its limit (trailing spaces do not count)."""
    return df.filter(
        (tsql.trimmed_length("building") > building)
        | (tsql.trimmed_length("street") > street)
        | (tsql.trimmed_length("city") > city)
    )


def tidy_for_report(df: DataFrame, rules: Rules = DEFAULT) -> DataFrame:
    return df.withColumns(
        {
            "street": tsql.replace_all("street", "  ", " " if rules.repaired else ""),
            "city": F.trim("city"),
        }
    )


def overlong_report(
    pickups: DataFrame,
    customers: DataFrame,
    as_of: dt.date | str,
    months: int = REPORT_MONTHS,
    rules: Rules = DEFAULT,
) -> DataFrame:
    """Recent cleaned pickups that do not fit the target fields."""
    cleaned = clean_pickups(recent_pickups(pickups, as_of, months), customers, rules)
    return tidy_for_report(too_long(cleaned), rules)
