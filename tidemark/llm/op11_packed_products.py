"""Hard negatives by Kronecker-packed inner products.

Components become integers (floor of 256 x). A candidate's are biased so that none is negative, and those of
several candidates are put side by side into the fields of one wide integer for each dimension; one product with
an anchor's component then adds to the scores of all of them, and the sums are unpacked exactly. A field is as
wide as the largest sum of its tile can be. As long as the fields of two candidates or more fit into 53 bits, the
wide integer is the significand of a double: every partial sum is an integer below 2^53, so a matrix product of
doubles is exact and multiplies once per anchor component. Larger components go through wide Python integers of
many fields.

Anchors are sorted by label and cut into groups of at most `GROUP`; candidates are dealt to lanes. A task takes a
group, which it holds, and one lane, which streams past in batches; it keeps the first few of each list, whose
last score is the bar for the next batch. Lists of different lanes meet in an aggregate of at most lanes x list
rows. One pass finds the positives, where a candidate goes only to groups that have its label; the second finds
the negatives of all positives at once, with each positive's bounds.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no part; a row
without id takes part, after all others in ties, and is returned with a null id; missing components of shorter
vectors are 0; scores beyond 64 bits count as the nearest 64-bit number; repeated rows and ids are rows of their
own; a positive with a negative score has no negatives; other columns are ignored; with no anchors, or an empty
table, there are no rows.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, table
from tidemark.session import settled

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score is between these hundredths of its positive's.
LEAST, MOST = 30, 90
#: Anchors that a task holds at most.
GROUP = 8_192
#: Candidates of a lane at least, and lanes at most: how far a group's work is spread.
LANE_ROWS = 4_096
LANES = 64
#: Anchors and candidates that are multiplied at a time, and of a lane's first candidates, which set the bars.
TILE_ANCHORS, TILE_ROWS, FIRST_ROWS = 1_024, 4_096, 256

EXACT = 1 << 53
LOWEST, HIGHEST = -(2**63) + 1, 2**63 - 1
#: Stands for a missing id in ties, where it comes last.
NO_ID = HIGHEST


def matrix(vectors: pa.Array) -> np.ndarray:
    """Rows of integers floor(SCALE x): as doubles if all are exact so, else as Python's integers."""
    vectors = vectors.cast(pa.large_list(pa.float64()))
    sizes = pc.list_value_length(vectors).to_numpy().astype(np.int64)
    flat = vectors.flatten().to_numpy()
    width = int(sizes.max()) if len(sizes) else 0
    found = np.zeros((len(sizes), width))
    found[np.arange(width) < sizes[:, None]] = flat
    if (np.abs(found) < EXACT // SCALE).all():
        return np.floor(SCALE * found)
    whole = [[int(x) * SCALE if abs(x) >= EXACT else math.floor(SCALE * x) for x in row] for row in found.tolist()]
    return np.array(whole, object).reshape(found.shape)


def widened(values: np.ndarray, width: int) -> np.ndarray:
    return np.pad(values, ((0, 0), (0, width - values.shape[1]))) if values.shape[1] < width else values


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all anchors with all rows, as 64-bit integers (anchors x rows)."""
    width = max(anchors.shape[1], rows.shape[1])
    if not width or not len(anchors) or not len(rows):
        return np.zeros((len(anchors), len(rows)), np.int64)
    anchors, rows = widened(anchors, width), widened(rows, width)
    low, high = int(rows.min()), int(rows.max())
    reach = max(1, int(np.abs(anchors).sum(axis=1).max()))
    most = reach * max(1, high - low)  # no field's sum is larger, on either side of 0
    bits = (2 * most + 1).bit_length()
    fields = 0
    while most * sum(1 << bits * j for j in range(fields + 1)) < EXACT:
        fields += 1
    small = anchors.dtype == rows.dtype == np.float64 and abs(low) * reach < HIGHEST // 2
    return _in_doubles(anchors, rows, low, most, bits, fields) if fields and small else _in_wide(anchors, rows, low, most)


def _in_doubles(anchors: np.ndarray, rows: np.ndarray, low: int, most: int, bits: int, fields: int) -> np.ndarray:
    n = len(rows)
    biased = rows - low
    biased = np.concatenate([biased, np.zeros((-n % fields, rows.shape[1]))])
    packed = sum(biased[j::fields] * float(1 << bits * j) for j in range(fields))
    wide = (anchors @ packed.T).astype(np.int64)
    wide += sum(most << bits * j for j in range(fields))  # no field is negative now
    back = low * anchors.sum(axis=1).astype(np.int64)[:, None] - most
    out = np.empty((len(anchors), len(biased)), np.int64)
    for j in range(fields):
        out[:, j::fields] = (wide >> bits * j & (1 << bits) - 1) + back
    return out[:, :n]


def _in_wide(anchors: np.ndarray, rows: np.ndarray, low: int, most: int) -> np.ndarray:
    size = -(-((2 * most + 1).bit_length()) // 8)  # bytes of a field
    rows = [[int(x) - low for x in row] for row in rows.tolist()]
    packed = [int.from_bytes(b"".join(row[d].to_bytes(size, "little") for row in rows), "little") for d in range(len(rows[0]))]
    lift = int.from_bytes(most.to_bytes(size, "little") * len(rows), "little")
    out = np.empty((len(anchors), len(rows)), np.int64)
    for i, anchor in enumerate(anchors.tolist()):
        anchor = [int(x) for x in anchor]
        wide = sum((a * p for a, p in zip(anchor, packed, strict=True)), lift).to_bytes(size * len(rows), "little")
        back = low * sum(anchor) - most
        out[i] = [
            min(HIGHEST, max(LOWEST, int.from_bytes(wide[k : k + size], "little") + back))
            for k in range(0, len(wide), size)
        ]
    return out


class Lists:
    """The first `keep` entries of many lists, by higher score and smaller id."""

    def __init__(self, n: int, keep: int, least: np.ndarray | None = None):
        self.keep = keep
        self.score = np.full((n, keep), LOWEST - 1, np.int64)
        self.id = np.full((n, keep), NO_ID, np.int64)
        self.used = np.zeros((n, keep), bool)
        self.bar = np.full(n, LOWEST - 1) if least is None else least.copy()

    def add(self, of: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(of):
            return
        touched = np.unique(of)
        old = self.used[touched]
        of = np.concatenate([np.repeat(touched, self.keep)[old.ravel()], of])
        score = np.concatenate([self.score[touched][old], score])
        ids = np.concatenate([self.id[touched][old], ids])
        order = np.lexsort([ids, -score, of])
        of, score, ids = of[order], score[order], ids[order]
        place = np.arange(len(of)) - np.searchsorted(of, of)
        few = place < self.keep
        at = (of[few], place[few])
        self.score[at], self.id[at], self.used[at] = score[few], ids[few], True
        full = touched[self.used[touched, -1]]
        self.bar[full] = self.score[full, -1]


class Search:
    """A group of anchors and what they have found so far."""

    def __init__(self, anchors: pa.Table):
        self.row, self.id, self.label = (anchors.column(c).to_numpy() for c in ("row", "id", "label"))
        self.values = matrix(anchors.column("embedding").combine_chunks())
        self.lists = self._lists(anchors)

    def add(self, rows: pa.RecordBatch) -> None:
        values = matrix(rows.column("embedding"))
        row, ids, label = (rows.column(c).to_numpy() for c in ("row", "id", "label"))
        edges = [*range(0, len(row), TILE_ROWS), len(row)]
        if len(row) > FIRST_ROWS:
            edges.insert(1, FIRST_ROWS)
        for x, y in itertools.pairwise(edges):
            for p in range(0, len(self.row), TILE_ANCHORS):
                q = p + TILE_ANCHORS
                self._meet(p, q, products(self.values[p:q], values[x:y]), row[x:y], ids[x:y], label[x:y])


class Positives(Search):
    def _lists(self, anchors: pa.Table) -> Lists:
        return Lists(len(self.row), POSITIVES)

    def _meet(self, p: int, q: int, scores: np.ndarray, row: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
        near, at = np.nonzero((scores >= self.lists.bar[p:q, None]) & (label == self.label[p:q, None]))
        other = self.row[p + near] != row[at]
        near, at = near[other], at[other]
        self.lists.add(p + near, scores[near, at], ids[at])

    def found(self) -> pa.RecordBatch:
        of, place = np.nonzero(self.lists.used)
        columns = [self.row[of], self.lists.score[of, place], self.lists.id[of, place]]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["row", "score", "id"])


class Negatives(Search):
    def _lists(self, anchors: pa.Table) -> Lists:
        found = anchors.column("positives").combine_chunks()
        self.many = pc.list_value_length(found).to_numpy().astype(np.int64)
        self.first = np.cumsum(self.many) - self.many
        flat = found.flatten()
        self.score, self.positive = (flat.field(k).to_numpy() for k in ("score", "id"))
        # Bounds without products that could pass 64 bits.
        tenth, rest = self.score // 10, self.score % 10
        self.least = (LEAST // 10) * tenth + -(-(LEAST // 10) * rest // 10)
        self.most = (MOST // 10) * tenth + (MOST // 10) * rest // 10
        return Lists(len(flat), NEGATIVES, self.least)

    def _meet(self, p: int, q: int, scores: np.ndarray, row: np.ndarray, ids: np.ndarray, label: np.ndarray) -> None:
        """Any positive's bounds first, then each positive's own."""
        first, many = self.first[p:q], self.many[p:q]
        some = np.flatnonzero(many)
        low, high = np.full(len(first), HIGHEST), np.full(len(first), LOWEST)
        if len(some):
            x, y = first[some[0]], first[some[-1]] + many[some[-1]]
            low[some] = np.minimum.reduceat(self.lists.bar[x:y], first[some] - x)
            high[some] = np.maximum.reduceat(self.most[x:y], first[some] - x)
        near, at = np.nonzero((scores >= low[:, None]) & (scores <= high[:, None]) & (label != self.label[p:q, None]))
        score = scores[near, at]
        for k in range(int(many.max(initial=0))):
            has = k < many[near]
            of = first[near[has]] + k
            fits = (score[has] >= self.lists.bar[of]) & (score[has] <= self.most[of])
            self.lists.add(of[fits], score[has][fits], ids[at[has]][fits])

    def found(self) -> pa.RecordBatch:
        of, place = np.nonzero(self.lists.used)
        anchor = np.searchsorted(self.first + self.many, of, side="right")
        columns = {
            "row": self.row[anchor],
            "slot": of - self.first[anchor],
            "anchor_id": self.id[anchor],
            "positive_id": self.positive[of],
            "positive_score": self.score[of],
            "score": self.lists.score[of, place],
            "id": self.lists.id[of, place],
        }
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns.values()], names=list(columns))


def vectors(df: DataFrame, id_column: str = "vec_id", label_column: str = "label", vector_column: str = "embedding") -> DataFrame:
    """The rows that take part: row (a number of its own), id, label, embedding."""
    finite = F.forall(vector_column, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    taking_part = df.where(F.col(label_column).isNotNull() & F.col(vector_column).isNotNull() & F.coalesce(finite, F.lit(False)))
    named = taking_part.select(
        F.coalesce(F.col(id_column).cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(label_column).cast("long").alias("label"),
        F.col(vector_column).alias("embedding"),
    )
    return settled(named.withColumn("row", F.monotonically_increasing_id()))


def _searched(anchors: DataFrame, rows: DataFrame, lanes: int, search: type[Search], schema: str) -> DataFrame:
    """Run a search for each group and lane. rows has the groups that each row goes to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, state = None, [], None
        for batch in batches:
            key = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(3)])
            edges = [0, *(np.flatnonzero(np.diff(key).any(axis=0)) + 1).tolist(), batch.num_rows]
            for x, y in itertools.pairwise(edges):
                if x == y:
                    continue
                part, (group, lane, kind) = batch.slice(x, y - x), key[:, x]
                if (group, lane) != now:
                    if state:
                        yield state.found()
                    now, held, state = (group, lane), [], None
                if kind == 0:
                    held.append(part)
                elif held:
                    state = state or search(pa.Table.from_batches(held))
                    state.add(part)
        if state:
            yield state.found()

    columns = ["group", "lane", "kind", "row", "id", "label", "embedding", "positives"]
    spread = anchors.withColumns({"lane": F.explode(F.sequence(F.lit(0), F.lit(lanes - 1))), "kind": F.lit(0)})
    # Lanes by hash, as neighbours in a file may be alike.
    dealt = rows.withColumns({"lane": F.pmod(F.xxhash64("row"), F.lit(lanes)).cast("int"), "kind": F.lit(1)})
    dealt = dealt.withColumn("positives", F.lit(None).cast(anchors.schema["positives"].dataType))
    both = spread.select(*columns).unionAll(dealt.select(*columns))
    both = both.repartition("group", "lane").sortWithinPartitions("group", "lane", "kind")
    return both.mapInArrow(run, schema)


def hard_negatives(
    df: DataFrame,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    anchor_every: int = 100,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    rows = vectors(df, id_column, label_column, vector_column)
    is_anchor = (F.col("id") % anchor_every == 0) & (F.col("id") != NO_ID)
    numbered = ranked(rows.where(is_anchor), ["label", "row"], "number")
    anchors = settled(numbered.withColumn("group", F.floor(F.col("number") / GROUP)).drop("number"))
    n, groups = rows.count(), (anchors.agg(F.max("group")).first()[0] or 0) + 1
    lanes = max(1, min(LANES, -(-n // LANE_ROWS)))
    entry = "array<struct<score: long, id: long>>"

    # A label's anchors are neighbours, so its groups are a range.
    of_label = anchors.groupBy("label").agg(F.min("group").alias("first"), F.max("group").alias("last"))
    own = rows.join(of_label, "label").withColumn("group", F.explode(F.sequence("first", "last")))
    blank = anchors.withColumn("positives", F.lit(None).cast(entry))
    positives = _searched(blank, own, lanes, Positives, "row long, score long, id long")
    positives = _first(positives, ["row"], POSITIVES).groupBy("row").agg(
        F.transform(
            F.array_sort(F.collect_list(F.struct("rank", "score", "id"))), lambda x: F.struct(x["score"], x["id"])
        ).cast(entry).alias("positives")
    )

    with_positives = settled(anchors.join(positives, "row"))
    everywhere = rows.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    schema = "row long, slot long, anchor_id long, positive_id long, positive_score long, score long, id long"
    negatives = _first(_searched(with_positives, everywhere, lanes, Negatives, schema), ["row", "slot"], NEGATIVES)
    return negatives.select(
        "anchor_id",
        F.nullif("positive_id", F.lit(NO_ID)).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.nullif("id", F.lit(NO_ID)).alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _first(found: DataFrame, of: list[str], keep: int) -> DataFrame:
    """The first entries of lists whose parts are from different lanes, at most lanes x keep rows for each."""
    order = Window.partitionBy(*of).orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= keep)


ORACLE_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id, a.label = b.label AS same,
    CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v AS a, v AS b WHERE a.vec_id % 100 = 0 AND a.r <> b.r
), p AS (
  SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id) <= 5
), n AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id,
    s.score AS negative_score, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s USING (a)
  WHERE NOT s.same AND 30 * p.score <= 100 * s.score AND 100 * s.score <= 90 * p.score
)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 10
"""


def op11_packed_products(spark: SparkSession, folder: str) -> DataFrame:
    df = table(spark, folder, "embeddings").select("vec_id", "label", "embedding")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(df.withColumn("label", moved))
