"""Hard negatives against plain products and sorts."""

import math
import random

import numpy as np
import pytest

from tests.conftest import SMALL
from tests.oracle import connect, differences
from tidemark.llm import op11_packed_products as op11


def clipped(x):
    return min(op11.HIGHEST, max(op11.LOWEST, x))


def plain(rows, every=100):
    def whole(x):
        return int(x) * 256 if abs(x) > 2**53 else math.floor(256 * x)

    used = []
    for i, label, v in rows:
        if label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        used.append((i, label, [whole(x) for x in v]))
    last = op11.NO_ID
    out = []
    for a, (i, label, v) in enumerate(used):
        if i is None or i % every:
            continue
        scored = [(-clipped(sum(x * y for x, y in zip(v, w))), last if j is None else j, k) for b, (j, k, w) in enumerate(used) if b != a]
        scored.sort()
        for s, j, k in [x for x in scored if x[2] == label][:5]:
            fit = [(t, m) for t, m, z in scored if z != label and 30 * -s <= 100 * -t <= 90 * -s]
            for rank, (t, m) in enumerate(fit[:10], 1):
                out.append((i, None if j == last else j, rank, None if m == last else m, -s, -t))
    return sorted(out, key=repr)


def returned(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def frame(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    return df.selectExpr("*", "1 as row", "2 as id", "'x' as lane", "3 as positives")


def test_query_equals_sql(spark):
    got = op11.op11_packed_products(spark, SMALL)
    assert differences(got, connect(SMALL), op11.ORACLE_SQL) == []
    assert got.count() > 0


@pytest.mark.parametrize("seed", [0, 1])
def test_random_vectors(spark, seed, monkeypatch):
    """Small groups and lanes, ties, repeated ids and rows, and everything that takes no part."""
    monkeypatch.setattr(op11, "GROUP", 3)
    monkeypatch.setattr(op11, "LANE_ROWS", 50)
    draw = random.Random(seed)
    centre = [[draw.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = []
    for i in range(400):
        label = draw.choice([0, 0, 0, 1, 2, 3, 4])
        rows.append((i, label, [round(x + draw.gauss(0, 0.7), draw.choice([0, 1, 5])) for x in centre[label]]))
    rows += rows[:120] + [(i, 1, rows[i + 7][2]) for i in (0, 100, 200)]
    rows += [(None, 0, rows[5][2]), (None, 1, rows[6][2]), (900, None, rows[1][2]), (1000, 1, None), (1100, 2, [None] * 8)]
    rows += [(1200, 2, [math.nan] * 8), (1300, 2, [math.inf] + [0.0] * 7), (1400, 3, [0.0] * 8), (1500, 4, []), (1600, 1, [1.0, 2.0])]
    draw.shuffle(rows)
    got = returned(op11.hard_negatives(frame(spark, rows), anchor_every=20))
    assert got == plain(rows, 20) and len(got) > 300


def test_large_components(spark):
    draw = random.Random(4)
    rows = [(i, i % 3, [draw.gauss(0, 1) * 10 ** draw.choice([0, 5, 9, 30, 300]) for _ in range(4)]) for i in range(120)]
    assert returned(op11.hard_negatives(frame(spark, rows), anchor_every=10)) == plain(rows, 10)


def test_one_label_no_anchor_and_empty(spark):
    rows = [(i, 1, [1.0, i / 10]) for i in range(30)]
    assert returned(op11.hard_negatives(frame(spark, rows), anchor_every=10)) == []
    assert returned(op11.hard_negatives(frame(spark, rows), anchor_every=1_000_000_007)) == []
    assert returned(op11.hard_negatives(frame(spark, [(1, 1, [1.0]), (3, 2, [1.0])]))) == []
    assert returned(op11.hard_negatives(frame(spark, []))) == []


@pytest.mark.parametrize("size", [1, 40, 300, 5_000, 1 << 22, 1 << 26, 1 << 40])
def test_products_are_exact(size):
    """Two fields in a double and more, one, and wide integers."""
    draw = np.random.default_rng(size)
    a, b = (draw.integers(-size, size + 1, (n, 64)) for n in (7, 23))
    expected = [[clipped(sum(int(x) * int(y) for x, y in zip(p, q, strict=True))) for q in b] for p in a]
    assert op11.products(a.astype(float), b.astype(float)).tolist() == expected


def test_fields_hold_the_largest_sums():
    a = np.array([[300.0] * 64, [-300.0] * 64, [0.0] * 64])
    b = np.array([[255.0] * 64, [-256.0] * 64, [0.0] * 64, [255.0, -256.0] * 32])
    assert op11.products(a, b).tolist() == (a.astype(int) @ b.astype(int).T).tolist()
