"""Helpers the operators share: input tables, row keys, global ranks and connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import settled

#: Bits that monotonically_increasing_id() gives to the row number within a partition.
LOCAL_BITS = 33


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rows_of(df: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """Just the id and the text, as long and string, so that other columns can't clash."""
    return df.select(F.col(id_column).cast("long").alias(id_column), F.col(text_column).cast("string").alias(text_column))


def digest(*columns: Column) -> list[Column]:
    """Two independent 64-bit hashes: 128 bits, for which equal means the same at any table size.

    A hash skips nulls, so each column goes in with a mark that tells a null from nothing.
    """
    marked = [part for c in columns for part in (c, c.isNull())]
    return [F.xxhash64(*marked), F.xxhash64(F.lit(7), *marked)]


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo the divisor: the fold that a contract names."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % divisor


def in_fold(id_column: str, divisor: int, rest: int) -> Column:
    """Whether an id's remainder is the given one; a null id is in no fold."""
    return F.coalesce(remainder(id_column, divisor) == rest, F.lit(False))


def ranked(df: DataFrame, order: list[str], rank: str) -> DataFrame:
    """Number all rows from 0 in the given order, without a single-partition window.

    Rows are sorted by range, so rows with one value in a column may spread over many tasks, and written
    once; then each partition's rows are counted and the counts before it added.
    """
    place, part, local, before = "__place", "__part", "__local", "__before"
    sorted_ = df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order)
    fixed = settled(sorted_.withColumn(place, F.monotonically_increasing_id()))
    fixed = fixed.withColumn(part, F.shiftright(place, LOCAL_BITS)).withColumn(
        local, F.col(place).bitwiseAND((1 << LOCAL_BITS) - 1)
    )
    sizes = fixed.groupBy(part).agg(F.count(F.lit(1)).alias("__n"))
    running = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = sizes.select(part, F.coalesce(F.sum("__n").over(running), F.lit(0)).alias(before))
    return (
        fixed.join(F.broadcast(offsets), part)
        .withColumn(rank, F.col(local) + F.col(before))
        .drop(place, part, local, before)
    )


def named(rows: DataFrame, id_column: str, content: list[Column]) -> DataFrame:
    """Add k1 and k2, which only rows with the same id and content share, and key, their number in the order of the
    ids: rows with one id and different content have keys of their own."""
    k1, k2 = digest(*content)
    rows = rows.withColumns({"k1": k1, "k2": k2})
    order = [id_column, "k1", "k2"]
    names = settled(ranked(rows.select(*order).distinct(), order, "key"))
    return rows.join(names, order)


def components(edges: DataFrame) -> DataFrame:
    """Smallest node of each node's connected component: (node, component), for nodes that have an edge.

    edges has long columns a and b. Alternating large-star and small-star steps; each takes a node's
    smallest neighbour by an aggregate that combines before the shuffle and joins it back, so a node with
    very many edges is split like any skewed join. Each step is written, which cuts the lineage.
    """
    edges = settled(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    )
    state = None
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m"))
        large = (
            both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")).distinct()
        )
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
        edges = settled(small.union(low.select("a", F.col("m").alias("b"))).distinct())
        now = tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


#: Bytes of a batch that are handled together, which bounds what a task needs beside the batch itself.
SLICE_BYTES = 8_000_000


def by_batch(make):
    """For mapInArrow: set up once a task, then turn each batch into one batch, a slice of it at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for batch in batches:
            rows = max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes)))
            for start in range(0, batch.num_rows, rows):
                yield step(batch.slice(start, rows))

    return run
