"""Random inputs against plain Python, one Spark job per property."""

import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pandas as pd
from pyspark.sql import functions as F

from tests.conftest import AS_OF, RUN_TS
from tidemark.functions import moments, numbers, text
from tidemark.operators.history import upsert, version_dimension
from tidemark.operators.quality import Validator

LETTERS = "abcxyzABCXYZáéíõçÁÉÕÇñ"
OTHERS = " '-.0123456789/&\t\n"


def texts(seed, alphabet, n=3000, longest=14):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, longest))) for _ in range(n)]


def test_text_functions_agree_with_python(values):
    sample = texts(1, LETTERS + OTHERS) + texts(2, LETTERS + " ")
    assert values(sample, text.title_case) == [s.title() for s in sample]
    assert values(sample, text.strip) == [s.strip() for s in sample]
    assert values(sample, lambda c: text.zero_fill(c, 5)) == [s.zfill(5) for s in sample]


def test_number_texts_agree(values):
    sample = texts(3, "123456789.eE+- ", longest=7) + texts(4, "0129.dfnaxi", longest=5) + ["0", "0e5", "1e999", "-1e400"]
    parsed = pd.to_numeric(pd.Series(sample, dtype=object), errors="coerce")
    want = [not missing for missing in parsed.isna()]
    assert values(sample, numbers.is_number) == want


def test_money_rounds_half_up(values):
    rng = random.Random(5)
    sample = [f"{rng.randint(-10**6, 10**6)}.{rng.randint(0, 9999):04d}" for _ in range(2000)] + ["0.005", "-0.005", "1.005"]
    want = [Decimal(s).quantize(Decimal("0.01"), ROUND_HALF_UP) for s in sample]
    assert values(sample, numbers.to_money) == want


def test_elapsed_days_agree(spark):
    rng = random.Random(6)
    start = datetime(2017, 1, 1)
    pairs = [
        (i, start + timedelta(seconds=rng.randint(0, 10**8)), start + timedelta(seconds=rng.randint(0, 10**8), microseconds=rng.randint(0, 999999)))
        for i in range(2000)
    ]
    df = spark.createDataFrame([(i, str(a), str(b)) for i, a, b in pairs], "i int, a string, b string")
    got = df.select("i", moments.elapsed_days(moments.to_moment(F.col("a")), moments.to_moment(F.col("b")))).orderBy("i").collect()
    assert [r[1] for r in got] == [(b - a).days for _, a, b in pairs]


def test_keep_first_agrees(spark):
    rng = random.Random(7)
    data = [(rng.choice(["a", "b", "c", "", None]), rng.choice([1, 2, 3, None]), i) for i in range(400)]
    df = spark.createDataFrame(data, "k string, j int, n int").repartition(5)
    valid, rejected = Validator(df, "t", "B", order_by=["n"]).check_nulls(["k"]).check_unique(["k", "j"]).finalize()
    seen, want_valid, want_reasons = set(), [], {}
    for k, j, n in data:
        reason = "" if k else "NULL in k; "
        reason += "Duplicate on k, j; " if (k, j) in seen else ""
        seen.add((k, j))
        if reason:
            want_reasons[n] = reason
        else:
            want_valid.append(n)
    assert sorted(r.n for r in valid.collect()) == want_valid
    assert {r.n: r.reject_reason for r in rejected.collect()} == want_reasons


def test_upsert_agrees(spark):
    rng = random.Random(8)
    existing = {k: (k, rng.randint(0, 9), "old") for k in rng.sample(range(300), 150)}
    batch = [(rng.randint(0, 299), rng.randint(10, 99), i) for i in range(500)]
    want = dict(existing)
    for k, v, _ in batch:
        want[k] = (k, v, want[k][2] if k in want else None)
    out = upsert(
        spark.createDataFrame(list(existing.values()), "k int, v int, note string"),
        spark.createDataFrame(batch, "k int, v int, n int"), ["k"], run_ts=RUN_TS, order_by=["n"],
    )
    assert sorted(tuple(r) for r in out.collect()) == sorted(want.values())


def test_versions_agree_over_many_batches(spark):
    rng = random.Random(9)
    schema = ("id int, city string, effective_start_date date, effective_end_date date, is_current boolean, version_number int")
    history, current = [], {}
    table = spark.createDataFrame([], schema)
    closed = []
    for step in range(4):
        day = AS_OF + timedelta(days=step)
        batch = {k: rng.choice(["x", "y", None]) for k in rng.sample(range(40), 25)}
        for k, city in batch.items():
            if k not in current:
                current[k] = (k, city, day, None, True, 1)
            elif current[k][1] != city:
                old = current[k]
                history.append((*old[:3], day, False, old[5]))
                current[k] = (k, city, day, None, True, old[5] + 1)
        out = version_dimension(table, spark.createDataFrame(list(batch.items()), "id int, city string"), "id", ["city"], day)
        rows = [tuple(r)[:-1] for r in out.collect()]
        closed += [r for r in rows if not r[4]]
        table = spark.createDataFrame([r for r in rows if r[4]], schema)
        assert sorted((r for r in rows if r[4]), key=repr) == sorted(current.values(), key=repr)
    assert sorted(closed, key=repr) == sorted(history, key=repr)
    versions = {}
    for r in [*closed, *current.values()]:
        versions.setdefault(r[0], []).append(r[5])
    assert all(sorted(v) == list(range(1, len(v) + 1)) for v in versions.values())
