import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lading.operators import address

# name, address, town, cln_address, has_street, prefixes, building, street, city
GOLDEN = [
    ("G1", "42/1 GREGORY RD, COLOMBO 07", "COLOMBO 07", "42/1 GREGORY RD", "N", ("42/1", "GREGORY", "", "RD"), "42/1", "GREGORY RD", "COLOMBO 7"),
    ("G2", "NO 33, WARD PL, COLOMBO 7", "COLOMBO 7", "NO 33", "Y", ("NO", "", "", "33"), "NO  ", "33 WARD PL", "COLOMBO 7"),
    ("G3", "330 T B JAYAH MW", "COLOMBO 10", "330 T B JAYAH MW", "N", ("330", "T", "B", "JAYAH MW"), "330", "T B JAYAH MW", "COLOMBO 10"),
    ("G4", "55 FLOOR GALLE ROAD COLPETTY", "KANDY", "55 FLOOR GALLE ROAD COLPETTY", "N", ("55", "FLOOR", "GALLE", "ROAD COLPETTY"), "55 FLOOR", "FLOOR GALLE ROAD COLPETTY", "KANDY"),
    ("G5", "KANDY", "KANDY", None, "N", (None,) * 4, None, None, "KANDY"),
    ("G6", "X 1,,,,,,", "Q", "X 1", "N", ("X", "", "", "1"), None, "X 1", "Q"),
    ("G7", "1 A, B  C", "KANDY", "1 A", "Y", ("1", "", "", "A"), "1  ", "A B  C", "KANDY"),
    ("G8", "NO 33 ROAD", "KANDY", "NO 33 ROAD", "N", ("NO", "33", "", "ROAD"), "NO 33", "ROAD", "KANDY"),
    ("G9", "MAIN STREET", "KANDY", "MAIN STREET", "N", ("MAIN", "", "", "STREET"), None, "MAIN STREET", "KANDY"),
    ("G10", "TEMPLE", "KANDY", "TEMPLE", "N", ("", "", "", "TEMPLE"), None, "TEMPLE", "KANDY"),
    ("G11", ", FOO", "KANDY", None, "Y", (None,) * 4, "  ", "FOO", "KANDY"),
    ("G12", "12 A, SIR CHITTAMPALAM A GARDINER MAWATHA, COLOMBO 02", "COLOMBO 02", "12 A", "Y", ("12", "", "", "A"), "12 A", "SIR CHITTAMPALAM A GARDINER MAWATHA", "COLOMBO 2"),
    ("G13", "12 GALLE ROAD, GALLE", "GALLE", "12  ROAD", "N", ("12", "", "", "ROAD"), "12", "ROAD", "GALLE"),
    ("G14", "\r\n", "KANDY", "", "N", ("", "", "", ""), None, "", "KANDY"),
    ("G15", "7 FLOWER RD 05", "COLOMBO 05", "7 FLOWER RD 05", "N", ("7", "FLOWER", "RD", "05"), "7", "FLOWER RD 05", "COLOMBO 5"),
    ("G16", "41 2/1 GREGORY S RD", "COLOMBO 7", "41 2/1 GREGORY S RD", "N", ("41", "2/1", "GREGORY", "S RD"), "41 2/1", "GREGORY S RD", "COLOMBO 7"),
    ("G17", "330 T JAYAH MW", "COLOMBO 10", "330 T JAYAH MW", "N", ("330", "T", "JAYAH", "MW"), "330 T", "JAYAH MW", "COLOMBO 10"),
    ("G18", "9 ST. JOHN'S RD.", "KANDY", "9 ST JOHN'S RD", "N", ("9", "ST", "JOHN'S", "RD"), "9", "ST JOHN'S RD", "KANDY"),
    ("G19", "5 MAIN ST", "", None, "N", (None,) * 4, None, None, None),
    ("G20", None, "KANDY", None, "N", (None,) * 4, None, None, "KANDY"),
    ("G21", "8\tLAKE RD", "COLOMBO 100", "8LAKE RD", "N", ("8LAKE", "", "", "RD"), "8LAKE", "RD", "COLOMBO 10"),
    ("G22", "5 MAIN ST", None, None, "N", (None,) * 4, None, None, None),
]


def run(spark, pairs, rules=address.DEFAULT):
    rows = [(i, a, t) for i, (a, t) in enumerate(pairs)]
    df = spark.createDataFrame(rows, "n int, address string, town string")
    return address.clean(df, rules).orderBy("n").collect()


def test_golden_rows(spark):
    for case, row in zip(GOLDEN, run(spark, [(g[1], g[2]) for g in GOLDEN]), strict=True):
        prefixes = tuple(row[f"prefix{i}"] for i in range(1, 5))
        found = (row.cln_address, row.has_street, prefixes, row.building, row.street, row.city)
        assert found == case[3:], case[0]


def test_report_joins_words_at_double_spaces(spark):
    df = spark.createDataFrame([("A B  C", " KANDY ")], "street string, city string")
    assert address.tidy_for_report(df).first() == ("A BC", "KANDY")
    assert address.tidy_for_report(df, address.Rules(repaired=True)).first() == ("A B C", "KANDY")


def test_repaired_rules(spark):
    pairs = [
        ("55 FLOOR GALLE ROAD COLPETTY", "KANDY"),
        ("12 GALLEFACE RD, GALLE", "GALLE"),
        ("3 A.(B RD", "A.(B"),
        ("5 MAIN ST", ","),
    ]
    rows = run(spark, pairs, address.Rules(repaired=True))
    assert (rows[0].building, rows[0].street) == ("55 FLOOR", "GALLE ROAD COLPETTY")
    assert rows[1].cln_address == "12 GALLEFACE RD"
    assert rows[2].cln_address == "3  RD"
    assert rows[3].cln_address == "5 MAIN ST"


def test_case_insensitive_rules(spark):
    pairs = [("5 main rd, kandy", "KANDY"), ("55 floor galle road colpetty", "KANDY")]
    rows = run(spark, pairs, address.Rules(case_sensitive=False))
    assert rows[0].cln_address == "5 main rd"
    assert rows[1].building == "55 floor"
    assert run(spark, pairs)[1].building == "55"


def pickups(spark, rows):
    schema = "pickup_id long, customer_id long, pickup_address string, pickup_town string, created_date timestamp"
    return spark.createDataFrame(rows, schema)


def customers(spark, rows):
    return spark.createDataFrame(rows, "customer_id long, customer_name string, address string, town string")


NOW = dt.datetime(2020, 8, 31, 12)


def test_fallback_is_per_field_and_only_from_null(spark, any_hot_rows):
    left = pickups(spark, [(1, 7, None, "T1", NOW), (2, 7, "", None, NOW), (3, 8, "A3", None, NOW), (4, None, None, None, NOW)])
    right = customers(spark, [(7, "N", "CA", "CT")])
    source = address.resolve_source(left, right).orderBy("pickup_id")
    assert [(r.address, r.town, r.customer_found) for r in source.collect()] == [
        ("CA", "T1", True), ("", "CT", True), ("A3", None, False), (None, None, False),
    ]
    salted = address.resolve_source(left, right, hot_rows=1).orderBy("pickup_id")
    assert salted.collect() == source.collect()
    assert [r.pickup_id for r in address.clean_pickups(left, right).orderBy("pickup_id").collect()] == [1, 2]


def test_report_limits_and_recency(spark):
    long_street = "12 A, SIR CHITTAMPALAM A GARDINER MAWATHA"
    created = [dt.datetime(2020, 2, 29), dt.datetime(2020, 2, 28, 23, 59), NOW, None]
    left = pickups(spark, [(i, 7, long_street, "X", c) for i, c in enumerate(created)])
    right = customers(spark, [(7, "N", None, None)])
    report = address.overlong_report(left, right, "2020-08-31")
    # Six months before 31 August is 29 February in a leap year.
    assert sorted(r.pickup_id for r in report.collect()) == [0, 2]
    assert address.too_long(report, street=35).count() == 0


def test_recency_reaches_the_scan_and_fields_stay_above(spark, data, tmp_path):
    left = pickups(spark, [(1, 7, "A", "T", NOW)])
    left.write.parquet(str(tmp_path / "p"))
    report = address.overlong_report(
        spark.read.parquet(str(tmp_path / "p")), customers(spark, [(7, "N", "A", "T")]), "2020-08-31"
    )
    plan = report._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate inline" in plan
    assert len(plan) < 60_000
    physical = report._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(created_date" in physical


def test_adaptive_join_splits_a_hot_customer(spark):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.shuffle.partitions": "16",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
    }
    left = spark.range(0, 60_000, numPartitions=8).select(
        F.col("id").alias("pickup_id"),
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 5000).cast("long").alias("customer_id"),
        F.concat(F.col("id"), F.lit(" MAIN RD")).alias("pickup_address"),
        F.lit("X").alias("pickup_town"),
        F.lit(NOW).alias("created_date"),
    )
    right = spark.range(5000).selectExpr("id customer_id", "string(id) customer_name", "'A' address", "'T' town")
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        cleaned = address.clean_pickups(left, right)
        assert len(cleaned.collect()) == 60_000
        plan = cleaned._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "SortMergeJoin(skew=true)" in plan


@pytest.mark.parametrize("seed", [1, 2])
def test_row_order_does_not_matter(spark, seed):
    pairs = [(g[1], g[2]) for g in GOLDEN]
    rows = [(i, a, t) for i, (a, t) in enumerate(pairs)]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "n int, address string, town string").repartition(3)
    assert sorted(address.clean(df).collect()) == sorted(run(spark, pairs))


# A plain restatement of the rules, row by row, to test against.


def plain_clean(text, town):
    def comma(s):
        return None if not s else s.removesuffix(",")

    def unzero(s):
        for i in range(len(s) - 1):
            if s[i] == "0" and s[i + 1] in "0123456789":
                return s[:i] + s[i + 1 :]
        return s

    def trim(s):
        return None if s is None else s.strip(" ")

    def tidy(s):
        return None if s is None else s.replace("\r", "").replace("\n", "").strip(" ").replace("\t", "")

    town = unzero(town).replace("\t", "") if town else None
    if text is not None and "," in text:
        tail = text[text.rindex(",") :]
        text = text.replace(tail, unzero(tail))
    text = None if text is None else text.replace("\t", "")
    town = None if town is None else town.replace(",", "")
    if text is None or town is None:
        rest = None
    else:
        rest = text.replace(town, "") if town else text
        joined = town.replace(" ", "")
        rest = (rest.replace(joined, "") if joined else rest).strip(" ").replace(",,", ",")
    rest = comma(trim(comma(rest)))
    rest = None if rest is None else rest.rstrip(" ").replace(".", "")
    cut = None if rest is None else rest[rest.rindex(",") :] if "," in rest else ""
    street = tidy(cut[1:]) if cut else None
    if rest is not None:
        rest = tidy(comma(trim(rest.replace(cut, "") if cut else rest)))

    def head(s):
        return s[: s.index(" ")].strip(" ") if " " in s else ""

    def after(s):
        return s[s.index(" ") :].strip(" ") if " " in s else s.strip(" ")

    if rest is None:
        p = [None] * 4
    else:
        t1 = after(rest)
        t2 = after(t1)
        p = [head(rest), head(t1), head(t2), after(t2)]
    return rest, street, p, town


ALPHABET = st.sampled_from([" ", ",", ".", "0", "3", "A", "B", "\t", "\r", "\n", "KANDY", "COLOMBO 03", "RD"])
TEXTS = st.one_of(st.none(), st.lists(ALPHABET, max_size=12).map("".join))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXTS, TEXTS), min_size=40, max_size=120))
def test_against_plain_rules(spark, pairs):
    for (text, town), row in zip(pairs, run(spark, pairs), strict=True):
        rest, street, prefixes, city = plain_clean(text, town)
        assert row.cln_address == rest, (text, town)
        assert [row[f"prefix{i}"] for i in range(1, 5)] == prefixes, (text, town)
        assert row.city == city, (text, town)
        assert row.has_street == ("Y" if street and street.rstrip(" ") else "N"), (text, town)


def test_row_count_is_kept(spark):
    df = spark.range(1000).select(
        F.col("id"), F.concat(F.col("id"), F.lit(" MAIN RD, X")).alias("address"), F.lit("X").alias("town")
    )
    assert address.clean(df).count() == 1000
