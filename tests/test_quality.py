import json

from pyspark.sql import functions as F

from tests.conftest import RUN_TS
from tidemark import pipeline
from tidemark.operators import quality
from tidemark.operators.quality import Validator, orphan_keys, repeated_current_keys
from tidemark.operators.rejects import reject_records
from tidemark.warehouse import Warehouse


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def test_reasons_in_check_order(spark):
    data = [("a", "1", 1), ("a", "2", 2), (None, " ", 3), (None, "3", 4), ("  ", None, 5), ("b", "4", 6)]
    df = spark.createDataFrame(data, "k string, v string, n int")
    checks = Validator(df, "bronze.x", "B", order_by=["n"]).check_nulls(["k", "v", "absent"]).check_unique(["k"])
    valid, rejected = checks.finalize()
    assert rows(valid) == [("a", "1", 1), ("b", "4", 6)]
    assert rows(rejected, "n", "reject_reason") == [
        (2, "Duplicate on k; "),
        (3, "NULL in k; NULL in v; "),
        (4, "NULL in k; Duplicate on k; "),
        (5, "NULL in k; NULL in v; "),
    ]
    got = {r.check_name: (r.passed, r.total_records, r.failed_records, str(r.success_pct), r.observed_value)
           for r in checks.results(RUN_TS).collect()}
    assert got == {
        "null_check_k": (False, 6, 3, "50.000", "3 nulls"),
        "null_check_v": (False, 6, 2, "66.667", "2 nulls"),
        "unique_check_k": (False, 6, 2, "66.667", "2 duplicates"),
    }


def test_valid_and_rejected_make_the_input(spark):
    # Identical copies and one key holding most rows: exactly one copy of each key stays.
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 7).otherwise(F.col("id") % 100).alias("k"), F.lit("same").alias("v"))
    valid, rejected = Validator(df, "t", "B").check_unique(["k"]).finalize()
    assert valid.count() == valid.select("k").distinct().count() == df.select("k").distinct().count()
    assert valid.count() + rejected.count() == 2000


def test_many_repeated_keys_are_flagged(spark):
    df = spark.range(900).select(F.when(F.col("id") >= 300, F.col("id") % 100).alias("k"), F.col("id").alias("n"))
    valid, rejected = Validator(df, "t", "B", order_by=["n"]).check_unique(["k"]).finalize()
    assert {(r.k, r.n) for r in valid.collect()} == {(None, 0)} | {(i % 100, i) for i in range(300, 400)}
    assert rejected.count() == 900 - 101


def test_warnings_and_numbers_never_reject(spark):
    df = spark.createDataFrame([("x", "bad"), (None, "ok"), ("5", None)], "n string, s string")
    checks = Validator(df, "t", "B").check_numeric(["n"], "ERROR").check_value_in_set("s", ["ok"], "ERROR")
    checks.check_nulls(["n"], "WARNING").check_unique(["s"], "WARNING").check_min_rows(9).check_lengths({"s": 2})
    valid, rejected = checks.finalize()
    assert (valid.count(), rejected.count()) == (3, 0)
    assert [r.failed_records for r in checks.results(RUN_TS).collect()] == [1, 1, 1, 0, 1, 1]


def test_empty_frame_and_no_checks(spark):
    df = spark.createDataFrame([], "k string")
    result = Validator(df, "t", "B", order_by=["k"]).check_nulls(["k"]).check_unique(["k"]).results(RUN_TS).collect()
    assert [(r.passed, str(r.success_pct)) for r in result] == [(True, "0.000"), (True, "0.000")]
    assert Validator(df, "t", "B").results(RUN_TS).count() == 0


def test_keep_first_follows_the_order(spark):
    df = spark.createDataFrame([("a", 3), ("a", 1), ("a", 1), ("a", 2)], "k string, n int")
    valid = Validator(df, "t", "B", order_by=["n"]).check_unique(["k"]).valid()
    assert rows(valid) == [("a", 1)]


def test_reject_json_keeps_nulls(spark):
    df = spark.createDataFrame([("a", None, "why; ")], "k string, v string, reject_reason string")
    record = reject_records(df, "t", "B", RUN_TS).first()
    assert json.loads(record.raw_data) == {"k": "a", "v": None, "reject_reason": "why; "}
    assert record.reject_reason == "why; "
    assert reject_records(df.drop("reject_reason"), "t", "B", RUN_TS).first().reject_reason == "Unknown"


def test_dotted_columns(spark):
    df = spark.createDataFrame([("a", "1"), ("a", "x"), (None, "2")], ["who.name", "who.n"])
    checks = Validator(df, "t", "B", order_by=["who.n"]).check_nulls(["who.name"]).check_unique(["who.name"]).check_numeric(["who.n"])
    valid, rejected = checks.check_lengths({"who.name": 0}).finalize()
    assert rows(valid) == [("a", "1")]
    assert json.loads(reject_records(rejected, "t", "B", RUN_TS).where("reject_reason LIKE 'NULL%'").first().raw_data)["who.n"] == "2"
    assert [r.failed_records for r in checks.results(RUN_TS).collect()] == [1, 1, 1, 2]


def test_keys(spark):
    dim = spark.createDataFrame([("a", True), ("a", True), ("b", True), ("b", False)], "id string, is_current boolean")
    assert rows(repeated_current_keys(dim, "id")) == [("a", 2)]
    fact = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k bigint")
    known = spark.createDataFrame([(2,)], "k bigint")
    assert rows(orphan_keys(fact, {"k": (known, "k")})) == [("k", 1, 2)]


def test_checks_are_worked_out_once_when_the_rows_are_staged(spark, tmp_path):
    """What is written has an outcome per check, so neither the valid nor the rejected rows check anything again."""
    df = spark.createDataFrame([(" ", "1.5", 1), ("\u2003\t", "x", 2), ("a", "1e30", 3), (" b", "2.5d", 4), (None, None, 5)], "k string, v string, _position int")

    def checked():
        return Validator(df, "t", "B").check_nulls(["k"]).check_numeric(["v"]).check_precision({"v": (12, 2)}, "ERROR")

    def write(rows):
        rows.write.parquet(str(tmp_path / "staged"))
        return spark.read.parquet(str(tmp_path / "staged"))

    plain, staged = checked(), checked()
    staged.staged(write)
    for part in ("valid", "rejected"):
        got, want = getattr(staged, part)(), getattr(plain, part)()
        assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert sorted(r.v for r in staged.valid().collect()) == ["2.5d"]
    assert sorted(map(str, staged.results(RUN_TS).collect())) == sorted(map(str, plain.results(RUN_TS).collect()))
    plan = staged.rejected()._jdf.queryExecution().optimizedPlan().toString()
    assert "RLIKE" not in plan and "try_cast" not in plan.lower()


def test_a_load_checks_its_rows_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    source = next(s for s in pipeline.SOURCES if s.table == "order_items")
    (tmp_path / "a.csv").write_text("order_id,order_item_id,product_id,seller_id,shipping_limit_date,price,freight_value\no1,1,p,s,,1,2\no2,1,p,,,1d,2\n")
    counts = pipeline.load_bronze(warehouse, source.read_files(spark, str(tmp_path / "a.csv")), source, "B", RUN_TS)
    assert counts == {"read": 2, "inserted": 1, "rejected": 1}
    staged = spark.read.parquet(f"{warehouse.root}/staging/B/order_items")
    assert [c for c in staged.columns if c.startswith("_fails")]
    assert [r.reject_reason for r in warehouse.read("bronze.rejected_records").collect()] == ["NULL in seller_id; "]
