from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import moments, numbers, text
from tidemark.plans.dimensions import size_category
from tidemark.plans.silver import delivery_columns


def test_strip_takes_all_white_space(values):
    texts = ["\t a ", " b ", "c d\n", "", " \t", None]
    assert values(texts, text.strip) == ["a", "b", "c d", "", "", None]


def test_title_case_follows_every_non_letter(values):
    texts = ["santa bárbara d'oeste-sul", "SÃO PAULO", "3rd ave", "", None, "água"]
    assert values(texts, text.title_case) == [t.title() if t is not None else None for t in texts]


def test_zero_fill_never_cuts(values):
    texts = ["123", "1234567", "", "-12", "+1", "12345", None]
    assert values(texts, lambda c: text.zero_fill(c, 5)) == [t.zfill(5) if t is not None else None for t in texts]


def test_is_number(values):
    good = ["1e5", " 7 ", "7.0", ".5", "5.", "+5", "-.5e-3", "inf", "-Infinity", "\t8\n", "1E+5"]
    bad = ["1.0d", "nan", "x", "0x10", "1_000", "True", "", "1,000", "1e", "--5", "5f", "1 2"]
    assert values(good, numbers.is_number) == [True] * len(good)
    assert values(bad, numbers.is_number) == [False] * len(bad)


def test_numbers_coerce_to_null(values):
    texts = ["2.345", "1e3", " 7 ", "x", "1.0d", None, "99999999999", "2.344", "-2.345"]
    want = ["2.35", "1000.00", "7.00", None, None, None, None, "2.34", "-2.35"]
    assert values(texts, numbers.to_money) == [None if w is None else Decimal(w) for w in want]
    assert values(["7.0", "7.9", "8", "x", None, "-1.5"], numbers.to_whole) == [7, 7, 8, None, None, -1]


def test_moments_coerce_to_null(values):
    got = values(["2024-01-02 10:11:12", "2024-01-02", "bad", "2024-02-30 00:00:00", None], moments.to_moment)
    assert [str(x) if x else None for x in got] == ["2024-01-02 10:11:12", "2024-01-02 00:00:00", None, None, None]
    assert values(["2024-01-02 10:11:12", "x"], lambda c: moments.date_key(moments.to_moment(c))) == [20240102, None]


@pytest.mark.parametrize(
    ("bought", "delivered", "estimate", "days", "late"),
    [
        ("2024-01-01 23:00:00", "2024-01-02 00:00:00", "2024-01-05", 0, False),
        ("2024-01-02 12:00:00", "2024-01-02 00:00:00", "2024-01-05", -1, False),
        ("2024-01-01 00:00:00", "2024-01-05 23:00:00", "2024-01-05", 4, False),
        ("2024-01-01 00:00:00", "2024-01-06 00:00:00", "2024-01-05", 5, True),
        ("2024-01-01 00:00:00", None, "2024-01-05", None, False),
        ("2024-01-01 00:00:00", "2024-01-06 00:00:00", None, 5, False),
    ],
)
def test_delivery(spark, bought, delivered, estimate, days, late):
    df = spark.createDataFrame([(bought, delivered, estimate)], "a string, b string, c string").select(
        moments.to_moment(F.col("a")).alias("order_purchase_timestamp"),
        moments.to_moment(F.col("b")).alias("order_delivered_at"),
        moments.to_day(F.col("c")).alias("order_estimated_delivery"),
    )
    assert tuple(df.select(*delivery_columns()).first()) == (days, late)


def test_days_do_not_depend_on_the_session_zone(spark):
    # Local clocks skipped an hour in between, at midnight of 2018-11-04.
    df = spark.sql("SELECT TIMESTAMP_NTZ'2018-11-03 12:00:00' AS a, TIMESTAMP_NTZ'2018-11-04 11:30:00' AS b, TIMESTAMP_NTZ'2018-11-04 00:30:00' AS c")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/Sao_Paulo")
    try:
        row = df.select(
            moments.elapsed_days(F.col("a"), F.col("b")), moments.elapsed_days(F.col("a"), F.col("a")), moments.date_key(F.col("c"))
        ).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert tuple(row) == (0, 0, 20181104)


def test_size_category(spark):
    volumes = [Decimal("499.99"), Decimal("500.00"), Decimal("4999.99"), Decimal("5000.00"), None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(volumes)], "i int, v decimal(12,2)")
    got = [r[0] for r in df.orderBy("i").select(size_category(F.col("v"))).collect()]
    assert got == ["Small", "Medium", "Medium", "Large", "Unknown"]


def test_mapped_default(values):
    assert values(["a", "z", None], lambda c: text.mapped(c, {"a": "x"}, "other")) == ["x", "other", "other"]
