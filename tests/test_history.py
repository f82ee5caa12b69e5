from datetime import date

from pyspark.sql import functions as F

from tests.conftest import AS_OF, RUN_TS
from tidemark.operators.history import CHANGE, change_counts, one_per_key, upsert, version_dimension, versions_of
from tidemark.operators.keys import number_new_rows, number_rows

DIM = "id string, city string, state string, effective_start_date date, effective_end_date date, is_current boolean, version_number int"
OLD = date(2020, 1, 1)


def table(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def triples(df):
    return sorted((r.id, r.version_number, r.is_current, r[CHANGE]) for r in df.collect())


def test_versions(spark):
    current = table(
        spark,
        [
            ("same", "A", "X", OLD, None, True, 1),
            ("moved", "A", "X", OLD, None, True, 2),
            ("filled", "A", None, OLD, None, True, 1),
            ("absent", "A", "X", OLD, None, True, 1),
            ("null", "A", None, OLD, None, True, 1),
        ],
        DIM,
    )
    batch = table(
        spark,
        [("same", "A", "X"), ("moved", "B", "X"), ("filled", "A", "Y"), ("new", "C", None), ("null", "A", None), (None, "Q", "Q")],
        "id string, city string, state string",
    )
    out = version_dimension(current, batch, "id", ["city", "state", "not_there"], AS_OF, RUN_TS)
    assert triples(out) == [
        ("absent", 1, True, "kept"),
        ("filled", 1, False, "closed"),
        ("filled", 2, True, "changed"),
        ("moved", 2, False, "closed"),
        ("moved", 3, True, "changed"),
        ("new", 1, True, "new"),
        ("null", 1, True, "kept"),
        ("same", 1, True, "kept"),
    ]
    assert tuple(change_counts(out).first()) == (1, 2)
    closed = out.where("id = 'moved' and not is_current").first()
    assert (closed.effective_start_date, closed.effective_end_date, closed.city) == (OLD, AS_OF, "A")
    # The same batch again changes nothing, and a key has one current row.
    again = version_dimension(out.where("is_current").drop(CHANGE), batch, "id", ["city", "state"], AS_OF, RUN_TS)
    assert tuple(change_counts(again).first()) == (0, 0)
    assert again.count() == again.select("id").distinct().count() == 6
    history = versions_of(out.unionByName(out.limit(0)), "id", "moved")
    assert [r.version_number for r in history.collect()] == [2, 3]


def test_duplicate_in_batch_gives_one_current_row(spark):
    current = table(spark, [], DIM)
    batch = table(spark, [("a", "A", "X"), ("a", "B", "X")], "id string, city string, state string")
    out = version_dimension(current, batch, "id", ["city"], AS_OF, RUN_TS)
    assert [(r.id, r.city) for r in out.collect()] == [("a", "B")]


def test_upsert(spark):
    existing = table(
        spark, [("a", 1, "kept", OLD), ("b", 2, "kept", OLD), (None, 9, "x", OLD)], "k string, v int, extra string, seen date"
    ).withColumns({"created_at": F.lit("2020-01-01 00:00:00").cast("timestamp_ntz"), "updated_at": F.lit(None).cast("timestamp_ntz")})
    batch = table(spark, [("b", 5, 1), ("b", 6, 2), ("c", 7, 1), (None, 8, 1)], "k string, v int, n int")
    out = upsert(existing, batch, ["k"], run_ts=RUN_TS, order_by=["n"])
    assert out.columns == existing.columns
    got = sorted([(r.k, r.v, r.extra, r.created_at.year, r.updated_at) for r in out.collect()], key=repr)
    assert got == sorted(
        [
            ("a", 1, "kept", 2020, None),
            ("b", 6, "kept", 2020, RUN_TS),
            ("c", 7, None, 2024, RUN_TS),
            (None, 9, "x", 2020, None),
            (None, 8, None, 2024, RUN_TS),
        ],
        key=repr,
    )


def test_upsert_of_listed_columns_and_several_keys(spark):
    existing = table(spark, [("a", 1, 10, "p"), ("a", 2, 20, "p")], "k string, j int, v int, w string")
    batch = table(spark, [("a", 2, 21, "q"), ("a", 3, 30, "q")], "k string, j int, v int, w string")
    out = upsert(existing, batch, ["k", "j"], update_cols=["v"])
    assert sorted(tuple(r) for r in out.collect()) == [("a", 1, 10, "p"), ("a", 2, 21, "p"), ("a", 3, 30, "q")]


def test_one_per_key_keeps_null_keys(spark):
    df = table(spark, [("a", 1), ("a", 2), (None, 1), (None, 2)], "k string, v int")
    assert sorted((r.k or "", r.v) for r in one_per_key(df, ["k"], ["v"]).collect()) == [("", 1), ("", 2), ("a", 2)]
    assert one_per_key(df.select("k"), ["k"]).count() == 3


def test_numbers_are_dense_and_ordered(spark):
    df = spark.range(5000).select(F.format_string("%06d", F.col("id") * 7919 % 5000).alias("k")).repartition(7)
    out = number_rows(df, "key", ["k"], start=100)
    got = [(r.k, r.key) for r in out.orderBy("k").collect()]
    assert [key for _, key in got] == list(range(101, 5101))
    existing = out.limit(0)
    assert number_rows(existing.drop("key"), "key", ["k"]).count() == 0


def test_new_rows_continue_the_numbers(spark):
    existing = table(spark, [(5, "b"), (9, "a")], "key bigint, id string")
    rows = table(spark, [(5, "b"), (9, "a"), (None, "d"), (None, "c")], "key bigint, id string")
    out = number_new_rows(rows, "key", ["id"], existing)
    assert sorted((r.id, r.key) for r in out.collect()) == [("a", 9), ("b", 5), ("c", 10), ("d", 11)]


