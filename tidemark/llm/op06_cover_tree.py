"""Near-duplicate embeddings: cover trees of blocks, walked in pairs; exact links above a cosine.

On unit vectors a cosine of 0.98 is a distance of 0.2. Vectors of one label are dealt into blocks of bounded size,
close ones together: by the signs of some fixed projections, as many as the label's size asks for, and a crowded
cell over several blocks. Equal vectors are one, with a count. Each block is a cover tree: nested levels of nodes
whose radii halve. Two blocks meet if their own covering balls come within 0.2; then both trees are walked
down together, level by level: a pair of nodes is dropped when its centres are farther apart than both covering
radii and 0.2, is taken whole when everything below must be that close, and else is opened. What is left at the
points is compared in double precision. A pair of blocks returns, for each vector, how many it links to there and
the smallest vector it is connected to, never the pairs themselves.

Defined results: a vector that is null, empty, zero or has null or non-finite components, or has no label or no
id, links with nothing; vectors of different lengths don't link; rows equal in id, label and components are one vector,
rows equal in the id alone are vectors of their own; a row with a null id has no component and stays; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import components, digest, named, table
from tidemark.session import settled

COSINE = 0.98
BLOCK = 2048
MOST_BITS = 16
TILE = 512
LEVELS = (1.0, 0.5, 0.25, 0.125, 0.0625)
MARGIN = 1e-6


def unit(raw: np.ndarray) -> np.ndarray:
    """Rows set to length 1; scaled first, so that no square overflows or vanishes."""
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return raw / np.sqrt(np.square(raw).sum(axis=1, keepdims=True))


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (a @ b.T)))


class CoverTree:
    """levels: per level (centre of each node as a point, parent node, covering radius, node of each point)."""

    def __init__(self, points: np.ndarray):
        self.points = points
        n = len(points)
        of = np.zeros(n, np.int64)
        self.levels = [(np.zeros(1, np.int64), np.zeros(1, np.int64), self._radii(np.zeros(1, np.int64), of), of)]
        for radius in LEVELS:
            centres, parents, node = [], [], np.full(n, -1)
            for parent in range(len(self.levels[-1][0])):
                left = np.flatnonzero(of == parent)
                while len(left) and 2 * len(centres) <= n:
                    d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * (points[left] @ points[left[0]])))
                    near = d <= radius
                    near[0] = True
                    node[left[near]] = len(centres)
                    centres.append(left[0])
                    parents.append(parent)
                    left = left[~near]
            if 2 * len(centres) > n:
                break  # from here on the points themselves are as good
            of = node
            at = np.array(centres)
            self.levels.append((at, np.array(parents), self._radii(at, of), of))

    def _radii(self, centres: np.ndarray, of: np.ndarray) -> np.ndarray:
        d = np.sqrt(np.maximum(0.0, 2.0 - 2.0 * np.einsum("ij,ij->i", self.points, self.points[centres[of]])))
        radii = np.zeros(len(centres))
        np.maximum.at(radii, of, d)
        return radii + MARGIN


def linked(a: CoverTree, b: CoverTree, cosine: float = COSINE) -> np.ndarray:
    """Which points of a link with which of b, by walking both trees down together."""
    reach = np.sqrt(2.0 - 2.0 * cosine)
    state = np.ones((1, 1), np.int8)  # 0 dropped, 1 open, 2 taken whole
    deepest = max(len(a.levels), len(b.levels))
    for k in range(deepest):
        ca, pa_, ra, _ = a.levels[min(k, len(a.levels) - 1)]
        cb, pb, rb, _ = b.levels[min(k, len(b.levels) - 1)]
        if k:
            state = state[pa_ if k < len(a.levels) else np.arange(len(ca))]
            state = state[:, pb if k < len(b.levels) else np.arange(len(cb))]
        if (state == 1).any():
            d = distances(a.points[ca], b.points[cb])
            both = ra[:, None] + rb[None, :]
            state = np.where((state == 1) & (d > both + reach + MARGIN), 0, state)
            state = np.where((state == 1) & (d + both < reach - MARGIN), 2, state).astype(np.int8)
    of_a, of_b = a.levels[-1][3], b.levels[-1][3]
    found = np.zeros((len(a.points), len(b.points)), bool)
    for start in range(0, len(a.points), TILE):
        rows = slice(start, start + TILE)
        below = state[of_a[rows]][:, of_b]
        open_ = below == 1
        tile = below == 2
        if open_.any():
            rest = np.flatnonzero(open_.any(axis=0))
            exact = a.points[rows] @ b.points[rest].T >= cosine
            tile[:, rest] |= exact & open_[:, rest]
        found[rows] = tile
    return found


def smallest(links: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that each point of a and of b is connected to through these links; its own if it has none."""
    top = np.iinfo(np.int64).max
    while True:
        from_b = np.minimum(a, np.where(links, b[None, :], top).min(axis=1, initial=top))
        from_a = np.minimum(b, np.where(links, from_b[:, None], top).min(axis=0, initial=top))
        if (from_b == a).all() and (from_a == b).all():
            return a, b
        a, b = from_b, from_a


def _signs(n: int) -> list[list[float]]:
    """Fixed directions: row k of a matrix of normal numbers, for vectors of length n."""
    return np.random.default_rng(20240601).standard_normal((MOST_BITS, n)).tolist()


def blocks(vectors: DataFrame) -> DataFrame:
    """label, dim, block, ids, weights, points (row by row), centre, radius of blocks of at most about BLOCK vectors.

    vectors: vec_id, label, dim, weight, v (array of double).
    """
    sizes = vectors.groupBy("label", "dim").agg(F.count(F.lit(1)).alias("n"))
    bits = F.least(F.lit(MOST_BITS), F.greatest(F.lit(0), F.ceil(F.log2(F.col("n") / BLOCK)))).cast("int")
    sized = vectors.join(sizes.select("label", "dim", bits.alias("bits")), ["label", "dim"])

    @F.pandas_udf("long")
    def cell(v: pd.Series, bits: pd.Series) -> pd.Series:
        out = np.zeros(len(v), np.int64)
        for n in v.map(len).unique():
            rows = np.flatnonzero((v.map(len) == n).to_numpy())
            side = np.stack(v.iloc[rows]) @ np.array(_signs(int(n))).T > 0
            every = side @ (1 << np.arange(MOST_BITS))
            out[rows] = every & ((1 << bits.iloc[rows].to_numpy().astype(np.int64)) - 1)
        return pd.Series(out)

    celled = settled(sized.withColumn("cell", cell("v", "bits")).drop("bits"))
    crowded = celled.groupBy("label", "dim", "cell").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("parts"))
    dealt = celled.join(crowded, ["label", "dim", "cell"]).withColumn(
        "block", F.xxhash64("cell", F.pmod(F.xxhash64("vec_id"), F.col("parts")))
    )

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("vec_id")
        points = unit(np.stack(rows["v"]))
        middle = points.mean(axis=0)
        radius = np.sqrt(np.square(points - middle).sum(axis=1)).max()
        return pd.DataFrame(
            {
                "label": [rows["label"].iloc[0]],
                "dim": [rows["dim"].iloc[0]],
                "block": [rows["block"].iloc[0]],
                "ids": [rows["vec_id"].to_numpy()],
                "weights": [rows["weight"].to_numpy()],
                "points": [np.stack(rows["v"]).astype(kind).tobytes()],
                "centre": [middle],
                "radius": [radius],
            }
        )

    kind = "<f4" if vectors.schema["single"].dataType.simpleString() == "float" else "<f8"
    schema = (
        "label string, dim int, block long, ids array<long>, weights array<long>, points binary, "
        "centre array<double>, radius double"
    )
    return settled(dealt.drop("single").groupBy("label", "dim", "block").applyInPandas(build, schema))


def block_links(built: DataFrame, kind: str, cosine: float = COSINE) -> DataFrame:
    """(vec_id, links, root) for each vector and pair of blocks in which it has links."""
    reach = float(np.sqrt(2.0 - 2.0 * cosine))
    own = built.select("label", "dim", F.col("block").alias("b1"), F.col("centre").alias("c1"), F.col("radius").alias("r1"))
    other = built.select("label", "dim", F.col("block").alias("b2"), F.col("centre").alias("c2"), F.col("radius").alias("r2"))
    apart = F.sqrt(F.aggregate(F.zip_with("c1", "c2", lambda x, y: (x - y) * (x - y)), F.lit(0.0), lambda s, x: s + x))
    meet = own.join(other, ["label", "dim"]).where(
        (F.col("b1") <= F.col("b2")) & (apart <= F.col("r1") + F.col("r2") + reach + MARGIN)
    )
    pairs = settled(meet.select("label", "dim", "b1", "b2"))
    load = built.select("label", "dim", "block", "ids", "weights", "points")
    first = pairs.join(load.withColumnRenamed("block", "b1"), ["label", "dim", "b1"]).withColumn("first", F.lit(True))
    second = pairs.where("b1 <> b2").join(load.withColumnRenamed("block", "b2"), ["label", "dim", "b2"])
    both = first.unionByName(second.withColumn("first", F.lit(False)))

    def walk(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("first", ascending=False)
        trees = [CoverTree(unit(np.frombuffer(p, kind).reshape(len(i), -1).astype(float))) for p, i in zip(rows["points"], rows["ids"], strict=True)]
        ids = [np.asarray(i, np.int64) for i in rows["ids"]]
        weights = [np.asarray(w, np.int64) for w in rows["weights"]]
        links = linked(trees[0], trees[-1], cosine)
        if len(trees) == 1:
            np.fill_diagonal(links, False)
            links |= links.T
        low_a, low_b = smallest(links, ids[0], ids[-1])
        found = [pd.DataFrame({"vec_id": ids[0], "links": links @ weights[-1], "root": np.minimum(low_a, low_b) if len(trees) == 1 else low_a})]
        if len(trees) == 2:
            found.append(pd.DataFrame({"vec_id": ids[1], "links": weights[0] @ links, "root": low_b}))
        out = pd.concat(found)
        return out[out["links"] > 0]

    return both.groupBy("label", "dim", "b1", "b2").applyInPandas(walk, "vec_id long, links long, root long")


def near_embeddings(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
    cosine: float = COSINE,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    element = vectors.schema[vector_column].dataType.elementType
    kind = "<f4" if element.simpleString() == "float" else "<f8"
    plain = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"),
        F.col(label_column).cast("string").alias("label"),
        F.col(vector_column).alias("e"),
    )
    known = plain.where("vec_id is not null")
    names = None
    if not known.groupBy("vec_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        # A hash skips nulls, so where they stand goes in, too.
        content = [F.col("label"), F.col("e"), F.transform("e", lambda x: x.isNull())]
        whole = named(known, "vec_id", content).groupBy("key", "vec_id").agg(F.min(F.struct("label", "e")).alias("s"))
        whole = settled(whole)
        names = whole.select("key", "vec_id")
        plain = whole.select(F.col("key").alias("vec_id"), "s.label", "s.e").union(plain.where("vec_id is null"))
    finite = F.forall("e", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x) < float("inf")))
    sound = plain.where(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("e").isNotNull() & finite
    ).where(F.exists("e", lambda x: x != 0))
    # Equal vectors are one; -0.0 is 0.0.
    same = F.transform("e", lambda x: F.when(x == 0, F.lit(0).cast(element)).otherwise(x))
    d1, d2 = digest(F.col("label"), F.size("e"), F.col("e"))
    sound = sound.withColumn("e", same).withColumns({"d1": d1, "d2": d2})
    copies = sound.groupBy("d1", "d2").agg(F.min("vec_id").alias("first"), F.count(F.lit(1)).alias("weight"))
    members = settled(sound.join(copies, ["d1", "d2"]).drop("d1", "d2"))
    heads = members.where("vec_id = first").select(
        "vec_id",
        "label",
        F.size("e").alias("dim"),
        "weight",
        F.col("e").cast("array<double>").alias("v"),
        F.lit(0).cast(element).alias("single"),
    )
    found = settled(block_links(blocks(heads), kind, cosine))
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    by_first = (
        members.select(F.col("vec_id").alias("id"), "first", "weight")
        .join(counts.withColumnRenamed("vec_id", "first"), "first", "left")
        .join(roots.toDF("first", "component"), "first", "left")
        .select(
            "id",
            (F.col("weight") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    every = plain.select("vec_id").join(by_first, F.col("vec_id") == F.col("id"), "left")
    result = every.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    if names is not None:
        for column in ("vec_id", "component_id"):
            result = result.join(names.toDF(column, "__id"), column, "left").drop(column).withColumnRenamed("__id", column)
    return result.select("vec_id", "n_links", "component_id", "kept")


def op6_cover_tree(spark: SparkSession, folder: str) -> DataFrame:
    return near_embeddings(table(spark, folder, "embeddings"))
