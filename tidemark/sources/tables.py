"""Tables, queries and databases as sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.moments import to_moment


def newer_than(df: DataFrame, column: str, value: str) -> DataFrame:
    """Rows after a watermark; rows whose column is no timestamp are left out."""
    c = F.col(f"`{column}`")
    if isinstance(df.schema[column].dataType, T.StringType):
        c = to_moment(c)
    return df.where(c > F.lit(value).cast("timestamp_ntz"))


def read_table(
    table: DataFrame,
    columns: list[str] | None = None,
    where: str | Column | None = None,
    watermark_col: str | None = None,
    watermark_value: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Some columns and rows of a table. A limit takes the first rows by the first column, as a top-k
    and not as a full sort; the other chosen columns break ties."""
    rows = table
    if watermark_col and watermark_value:
        rows = rows.where(F.col(watermark_col) > F.lit(watermark_value).cast(table.schema[watermark_col].dataType))
    if where is not None:
        rows = rows.where(where)
    chosen = rows.select(*(columns or table.columns))
    return chosen if limit is None else chosen.orderBy(*chosen.columns).limit(limit)


def read_query(spark: SparkSession, query: str, params: dict | None = None) -> DataFrame:
    """Rows of an SQL query with named parameters."""
    return spark.sql(query, args=params or {})


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str] | None = None,
    partition_column: str | None = None,
    bounds: tuple[str, str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """A database table; with a partition column and its bounds many tasks read it side by side.
    Filters, columns and limits applied with `read_table` are pushed to the database."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(properties or {}))
    if partition_column and bounds and partitions:
        reader = reader.options(
            partitionColumn=partition_column, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=partitions
        )
    return reader.load()
