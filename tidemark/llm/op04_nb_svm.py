"""Quality: n-gram indicators scaled by class log-count ratios, and a linear hinge-loss model over them.

A text's indicators are its words, and one to three neighbouring word shapes (`Aa+`, `a+.`, `A+!+`, ...; a word
that repeats the one before has a shape of its own), hashed to a fixed number of features. A long token, as of
text written without white space, also gives all its runs of GRAM characters, and those of its shape. How often each
feature stands in texts of either class is counted over all labelled rows outside the held-out fold; the logs of
the two classes' ratios scale the indicators. The linear model is fitted by dual coordinate descent, one
row at a time, on a bounded sample of those rows. Scoring reads each whole text once in the task that has it.

Defined results: null or empty text has no indicators and scores the model's intercept; texts of any length are
read whole; ids may be repeated or null, and a null one is not held out and teaches nothing; rows without a label do
not teach; with labels of one class only, or none, every score is that class' (or 0.5); an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, in_fold, remainder, rows_of, table
from tidemark.session import settled

BITS = 18
HELD_OUT = (3, 1)
#: Labelled rows the linear model is fitted on at most, about; chosen by a hash of the id.
FIT_ROWS = 20_000
SMOOTHING = 1.0
COST = 1.0
PASSES = 12
#: How much of each weight is the mean weight, which speaks for features the sample lacks.
EVEN = 0.25
MAP_ENTRIES = 300_000
#: Longer tokens are rarely words: every run of GRAM characters in them is an indicator, too.
LONG = 24
GRAM = 4
#: Characters of a token that are cut into runs at a time.
SLICE = 1 << 18

RUN = re.compile(r"(.)\1+")
EDGES = re.compile(r"^\W+|\W+$")
REPEAT = zlib.crc32(b"repeat")


def pattern(token: str) -> str:
    """A whole token's shape: letters by case, digits, other characters as they are, runs marked."""
    found = ["A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c for c in token]
    return RUN.sub(r"\1+", "".join(found))


def crc(text: str, start: int = 0) -> int:
    return zlib.crc32(text.encode("utf-8", "replace"), start)


def shape(token: str) -> int:
    return crc(pattern(token))


def grams(text: str, seed: int, mask: int) -> set[int]:
    """Features of all runs of GRAM characters."""
    found: set[int] = set()
    for start in range(0, len(text) - GRAM + 1, SLICE):
        part = text[start : start + SLICE + GRAM - 1]
        codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
        sums = np.full(len(codes) - GRAM + 1, seed, np.uint64)
        for i in range(GRAM):
            sums = (sums ^ codes[i : i + len(sums)]) * np.uint64(0x9E3779B97F4A7C15)
            sums ^= sums >> np.uint64(29)
        found.update(np.unique(sums & np.uint64(mask)).tolist())
    return found


class Indicators:
    """The distinct features of a text; what a token gives is kept until the map is full."""

    def __init__(self, bits: int = BITS):
        self.mask = (1 << bits) - 1
        self.known: dict[str, tuple[int, int]] = {}  # token: shape, feature of its word

    def _add(self, tokens: set[str]) -> None:
        if len(self.known) > MAP_ENTRIES:
            self.known = {}
        for t in tokens.difference(self.known):
            self.known[t] = (shape(t), self._word(t))

    def _word(self, token: str) -> int:
        return crc(EDGES.sub("", token).lower(), 1) & self.mask

    def _long(self, tokens: set[str]) -> tuple[dict[str, tuple[int, int]], set[int]]:
        """What `known` has of other tokens, which isn't kept for long ones, and their runs of characters."""
        read, found = {}, set()
        for t in tokens:
            form = pattern(t)
            read[t] = (crc(form), self._word(t))
            found |= grams(t.lower(), 1, self.mask) | grams(form, 2, self.mask)
        return read, found

    def of(self, text: str) -> np.ndarray:
        tokens = text.split()
        distinct = set(tokens)
        long = {t for t in distinct if len(t) > LONG}
        distinct -= long
        if not distinct <= self.known.keys():
            self._add(distinct)
            self._add(distinct)  # the first call may have emptied the map
        known, features = self.known, set()
        if long:
            read, features = self._long(long)
            known = {**{t: known[t] for t in distinct}, **read}
        features |= {known[t][1] for t in distinct | long}
        shapes = [known[t][0] for t in tokens]
        for i in [i for i, (a, b) in enumerate(zip(tokens, tokens[1:], strict=False), 1) if a == b]:
            shapes[i] = REPEAT
        mask = self.mask
        features.update((s * 2654435761 >> 7) & mask for s in set(shapes))
        features.update(
            ((a * 2654435761 ^ b * 40503) >> 5) & mask for a, b in set(zip(shapes, shapes[1:], strict=False))
        )
        features.update(
            ((a * 2654435761 ^ b * 40503 ^ c * 2246822519) >> 3) & mask
            for a, b, c in set(zip(shapes, shapes[1:], shapes[2:], strict=False))
        )
        return np.fromiter(sorted(features), np.int32, len(features))


@dataclass(frozen=True)
class Model:
    """weights: per feature, the log-count ratio times what was fitted. scale: per feature, the ratio alone."""

    weights: np.ndarray
    scale: np.ndarray
    intercept: float
    bits: int = BITS

    def score(self, features: np.ndarray) -> float:
        norm = np.sqrt(np.square(self.scale[features]).sum()) or 1.0
        margin = self.weights[features].sum() / norm + self.intercept
        return float(1 / (1 + np.exp(-np.clip(3 * margin, -30, 30))))


def features(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bits: int = BITS) -> DataFrame:
    """doc_id and the sorted distinct features of each row."""

    def make():
        indicators = Indicators(bits)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [indicators.of(t or "") for t in batch.column(text_column).to_pylist()]
            offsets = np.concatenate([[0], np.cumsum([len(f) for f in found])])
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(found), pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(id_column), lists], names=["doc_id", "features"])

        return step

    return rows_of(docs, id_column, text_column).mapInArrow(by_batch(make), "doc_id long, features array<int>")


def descend(rows: list[np.ndarray], signs: np.ndarray, scale: np.ndarray) -> tuple[np.ndarray, float]:
    """Dual coordinate descent for the hinge loss; rows are indicators, scaled and set to unit length."""
    weights, intercept = np.zeros(len(scale)), 0.0
    values = [scale[r] / (np.sqrt(np.square(scale[r]).sum()) or 1.0) for r in rows]
    lengths = np.array([np.square(v).sum() + 1.0 for v in values])
    dual = np.zeros(len(rows))
    order = np.random.default_rng(0)
    for _ in range(PASSES):
        largest = 0.0
        for i in order.permutation(len(rows)):
            r, v, y = rows[i], values[i], signs[i]
            slope = y * (weights[r] @ v + intercept) - 1.0
            if (dual[i] == 0 and slope >= 0) or (dual[i] == COST and slope <= 0):
                continue
            new = min(max(dual[i] - slope / lengths[i], 0.0), COST)
            change = (new - dual[i]) * y
            dual[i] = new
            weights[r] += change * v
            intercept += change
            largest = max(largest, abs(slope))
        if largest < 0.01:
            break
    return weights, float(intercept)


def fit(
    found: DataFrame,
    labels: DataFrame,
    fold: tuple[int, int] | None = HELD_OUT,
    most: int = FIT_ROWS,
    bits: int = BITS,
) -> Model:
    """found has doc_id and features, labels doc_id and quality."""
    size = 1 << bits
    marked = labels.select(F.col("doc_id").cast("long"), F.col("quality").cast("int")).where(
        "doc_id is not null and quality in (0, 1)"
    )
    if fold:
        marked = marked.where(remainder("doc_id", fold[0]) != fold[1])
    # Labels grow with the documents: joined by a shuffle at any size.
    taught = settled(found.join(marked.hint("merge"), "doc_id").select("doc_id", "features", "quality"))
    totals = {r["quality"]: r["n"] for r in taught.groupBy("quality").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(totals) < 2:
        only = 10.0 * (1 if 1 in totals else -1) if totals else 0.0
        return Model(np.zeros(size), np.ones(size), only, bits)
    counts = (
        taught.select(F.explode("features").alias("feature"), "quality")
        .groupBy("feature")
        .agg(F.sum("quality").alias("good"), F.count(F.lit(1)).alias("all"))
        .toPandas()
    )  # at most one row per feature
    good, bad = np.full(size, SMOOTHING), np.full(size, SMOOTHING)
    good[counts["feature"]] += counts["good"]
    bad[counts["feature"]] += counts["all"] - counts["good"]
    scale = np.log(good / good.sum()) - np.log(bad / bad.sum())
    share = min(1.0, most / sum(totals.values()))
    chosen = taught.where(F.xxhash64("doc_id").bitwiseAND((1 << 20) - 1) < share * (1 << 20)).orderBy("doc_id")
    sample = chosen.select("features", "quality").toArrow()
    rows = [np.asarray(r.values, np.int32) for r in sample.column("features")]
    signs = 2.0 * sample.column("quality").to_numpy() - 1.0
    weights, intercept = descend(rows, signs, scale)
    mean = np.abs(weights).mean()
    return Model(((1 - EVEN) * weights + EVEN * mean) * scale, scale, intercept, bits)


_indicators: dict[int, Indicators] = {}


def score(text: Column, spark: SparkSession, model: Model) -> Column:
    shared = spark.sparkContext.broadcast(model)  # two numbers per feature

    @F.pandas_udf("double")
    def apply(batch: pd.Series) -> pd.Series:
        indicators = _indicators.setdefault(shared.value.bits, Indicators(shared.value.bits))
        return pd.Series([shared.value.score(indicators.of(t or "")) for t in batch], dtype=float)

    return apply(text)


def scored(found: DataFrame, model: Model) -> DataFrame:
    """doc_id and score, from doc_id and features."""
    shared = found.sparkSession.sparkContext.broadcast(model)

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            lists = batch.column("features")
            flat, edges = lists.flatten().to_numpy(), lists.offsets.to_numpy() - lists.offsets[0].as_py()
            scores = [shared.value.score(flat[a:b]) for a, b in zip(edges, edges[1:], strict=False)]
            return pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], names=["doc_id", "score"]
            )

        return step

    return found.mapInArrow(by_batch(make), "doc_id long, score double")


def good_quality(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows that score at least the threshold, with the columns they have."""
    model = fit(features(docs), labels)
    return docs.where(score(F.col("text").cast("string"), docs.sparkSession, model) >= threshold)


def op4_nb_svm(spark: SparkSession, folder: str) -> DataFrame:
    found = settled(features(table(spark, folder, "documents")))
    result = scored(found, fit(found, table(spark, folder, "labels")))
    divisor, rest = HELD_OUT
    return result.select(
        "doc_id",
        in_fold("doc_id", divisor, rest).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
