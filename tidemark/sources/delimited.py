"""CSV source."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import null_if_in
from tidemark.lookups import CSV_NULL_TEXTS
from tidemark.operators.quality import POSITION
from tidemark.session import settled
from tidemark.sources.position import opened, position
from tidemark.sources.ranges import RECORD, csv_layout, pieces, records
from tidemark.sources.tables import newer_than


#: Encodings in which a line end and a quote are the bytes they are in ASCII, and no part of another character.
BYTEWISE = {"utf-8", "utf8", "us-ascii", "ascii", "iso-8859-1", "latin-1", "latin1", "windows-1252", "cp1252"}


def with_quoted_newlines(spark: SparkSession, path: str | list[str], encoding: str = "utf-8") -> DataFrame:
    """The files, as `file`, in which some field may span lines: if one does, a line holds an odd number of quotes."""
    lines = opened(lambda: spark.read.option("encoding", encoding).text(path), path)
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return lines.where(F.col("value").contains('"') & (quotes % 2 == 1)).select(F.col("_metadata.file_path").alias("file")).distinct()


def has_quoted_newlines(spark: SparkSession, path: str | list[str], encoding: str = "utf-8") -> bool:
    return not with_quoted_newlines(spark, path, encoding).isEmpty()


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "utf-8",
    watermark_col: str | None = None,
    watermark_value: str | None = None,
    multi_line: bool | None = None,
    dtypes: dict[str, str] | None = None,
    keep_position: bool = False,
) -> DataFrame:
    """Text columns named by the header; the usual texts for "no value" become NULL.

    Whether fields contain line breaks is found out for each file unless `multi_line` says so. Files with and
    without are cut by many tasks alike (see `ranges`); only in encodings that aren't bytewise is a file with
    breaks read by one. With a watermark, only rows after it are kept. `dtypes` names Spark types for some columns;
    a value that does not fit is an error.
    """
    options = {"header": True, "escape": '"', "encoding": encoding}
    header = opened(lambda: spark.read.options(multiLine=True, **options).csv(path), path)
    names = header.columns

    def by_line(whole: bool = False) -> DataFrame:
        raw = header if whole else spark.read.schema(header.schema).options(**options).csv(path)
        return raw.select(*[F.col(f"`{c}`") for c in names], position())

    if multi_line is None:
        odd = settled(with_quoted_newlines(spark, path, encoding))
        multi_line = not odd.isEmpty()
    else:
        odd = None
    if not multi_line:
        rows = by_line()
    elif encoding.lower() not in BYTEWISE:
        rows = by_line(whole=True)
    else:
        lines = pieces(spark, path, "\n", encoding)
        of_file = F.col(f"{POSITION}.file") == F.col("file")
        rows = _across_lines(lines if odd is None else lines.join(odd, F.col("_file") == F.col("file"), "left_semi"), names)
        if odd is not None:
            rows = rows.unionByName(by_line().join(odd, of_file, "left_anti"))
    rows = rows.select(*[null_if_in(F.col(f"`{c}`"), CSV_NULL_TEXTS).alias(c) for c in names], POSITION)
    if watermark_col and watermark_value and watermark_col in names:
        rows = newer_than(rows, watermark_col, watermark_value)
    for name, kind in (dtypes or {}).items():
        rows = rows.withColumn(name, F.col(f"`{name}`").cast(kind))
    return rows if keep_position else rows.drop(POSITION)


def _across_lines(lines: DataFrame, names: list[str]) -> DataFrame:
    """The rows of files with line breaks in fields. The header is left out, and so are blank lines."""
    found = records(lines, csv_layout())
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in names)
    line = F.regexp_replace(RECORD, r"\r$", "")
    rows = found.where(~F.col("_heads") & (F.trim(line) != ""))
    parsed = rows.select(F.from_csv(line, schema, {"escape": '"'}).alias("_row"), POSITION)
    return parsed.select("_row.*", POSITION)
