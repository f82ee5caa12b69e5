"""Benchmark windows in documents, against loops over all places."""

import hashlib
import random
import re

import pytest

from tests.conftest import SMALL
from tests.llm.helpers import frame
from tests.oracle import connect, differences
from tidemark.llm import op12_prefix_join as op12

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def plain(docs, items, window=10):
    found = []
    for i, text in docs:
        w, hit, met = words(text), set(), set()
        for item, item_text in items:
            v = words(item_text)
            n = min(window, len(v))
            whole = {tuple(v[s : s + n]) for s in range(len(v) - n + 1)} if n else set()
            for s in range(len(w) - n + 1 if n else 0):
                if tuple(w[s : s + n]) in whole:
                    hit |= set(range(s, s + n))
                    met.add(item)
        met = sorted(str(m) for m in met if m is not None)
        digest = hashlib.sha256(",".join(met).encode()).hexdigest()
        found.append((i, len(w), len(hit), len(met), digest, bool(hit)))
    return sorted(found, key=str)


def returned(df):
    columns = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


def items_of(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "1 as words", "2 as shingle")


def test_documents_equal_sql(spark):
    got = op12.op12_prefix_join(spark, SMALL)
    assert differences(got, connect(SMALL), op12.ORACLE_SQL) == []
    assert got.where("contaminated").count() > 0


@pytest.mark.parametrize("seed", range(3))
def test_random_texts(spark, seed):
    draw = random.Random(seed)
    vocabulary = ["a", "B", "the", "of", "Zeta", "x9", "é", "ÉTÉ", "日本", "K", "word", "alpha"]
    gaps = [" ", "  ", ", ", "\n", "-", "_", " ", "'", "\t[", " \x7f"]

    def text(n):
        return "".join(draw.choice(vocabulary) + draw.choice(gaps) for _ in range(n))

    items = [(i, text(draw.choice([0, 1, 2, 3, 4, 9, 10, 11, 14, 30]))) for i in range(25)] + [(100, None), (None, text(12))]
    docs = [(i, text(draw.randrange(40))) for i in range(60)]
    for i in range(60, 120):  # passages of items, some cut short, some whole
        source = words(draw.choice(items)[1])
        start = draw.randrange(max(1, len(source)))
        part = source[start : start + draw.choice([5, 9, 10, 12, 40])]
        docs.append((i, text(draw.randrange(6)) + draw.choice([" ", ". "]).join(part).upper() + " " + text(draw.randrange(6))))
    got = returned(op12.contaminated(frame(spark, docs), items_of(spark, items)))
    assert got == plain(docs, items)


def test_repeats_long_words_and_empty_tables(spark):
    giant = "Q" * 100_000
    ten = "one two three four five six seven eight nine ten"
    docs = [(1, ten), (1, ten), (2, None), (3, ""), (4, "!?"), (5, f"x {giant} y"), (6, f"{ten} eleven " * 3_000), (7, giant + "Q")]
    items = [(9, ten), (9, ten), (10, ten.upper()), (11, giant.lower()), (12, "!"), (13, "eleven one"), (14, "y")]
    assert returned(op12.contaminated(frame(spark, docs), items_of(spark, items))) == plain(docs, items)
    assert returned(op12.contaminated(frame(spark, docs[:6]), items_of(spark, []))) == plain(docs[:6], [])
    assert returned(op12.contaminated(frame(spark, []), items_of(spark, items))) == []


def test_hot_window(spark):
    """A window of all items in a third of the documents, and its rarest shingle in many windows."""
    ten = "p q r s t u v w x y"
    items = [(i, f"{ten} z{i}") for i in range(40)]
    docs = [(i, f"start {ten} z{i % 7} end" if i % 3 == 0 else f"nothing here {i}") for i in range(300)]
    assert returned(op12.contaminated(frame(spark, docs), items_of(spark, items))) == plain(docs, items)


def test_filter_holds_what_it_was_made_from(spark):
    import numpy as np

    draw = np.random.default_rng(3)
    hashes = np.concatenate([draw.integers(-(2**63), 2**63 - 1, 5_000), [0, 1, 32_768, 32_769, -1]])
    held = op12.Filter(spark.createDataFrame([(int(h),) for h in hashes], "h long"), "h", 1 << 20)
    assert held.holds(hashes).all()
    assert held.holds(draw.integers(-(2**63), 2**63 - 1, 100_000)).mean() < 0.02
