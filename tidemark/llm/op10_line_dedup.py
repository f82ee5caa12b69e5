"""Line dedup: drop the lines whose key stands in many documents, by keep bitmaps; DataFrame functions only.

Only hashes leave the documents. They are partitioned by range of (hash, document, position), so that the
lines of one key, however many, lie sorted in as many tasks as they need; each task streams its runs of equal
hashes into a count and a first occurrence, and the few partial counts of a key are added. What comes back to
a document is a bitmap of its dropped lines: 64 positions to a word, words without a dropped line left out.

Defined results: a row is a document, so a repeated row counts again; null text is empty; an empty text is one
empty line, which has no key and stays; a key is counted once per document; ids may be null or repeated. An
empty table gives an empty result. With keep_first the first line of a repeated key, by document id (nulls
first) and position, stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import digest, table
from tidemark.session import settled

# Fixed values of the contract: what is stripped from a line, and which letters are lower-cased.
BLANKS = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

MIN_DOCUMENTS = 10
WORD = 64
#: Columns that dedup_lines adds; a column of the input with such a name gives way.
MADE = ("n_lines", "n_dropped", "dropped_lines")


def line_key(line: Column) -> Column:
    """The line stripped of blanks, A-Z in lower case; lower() does just that where all is ASCII."""
    bare = F.trim(line, F.lit(BLANKS))
    ascii_only = F.octet_length(bare) == F.char_length(bare)
    return F.when(ascii_only, F.lower(bare)).otherwise(F.translate(bare, UPPER, UPPER.lower()))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _document(id_column: str, text_column: str) -> list[Column]:
    """Rows with the same id and text have the same lines, so they may share a key."""
    d1, d2 = digest(F.col(id_column), F.col(text_column))
    return [d1.alias("__d1"), d2.alias("__d2")]


def keep_bitmaps(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    keep_first: bool = False,
) -> DataFrame:
    """(__d1, __d2, __dropped): for each document that loses lines, the bitmap as a map from word to 64 bits."""
    k1, k2 = digest(F.col("key"))
    lines = (
        docs.select(
            F.col(id_column).cast("long").alias("id"),
            *_document(id_column, text_column),
            F.posexplode(F.transform(_lines(F.col(text_column)), line_key)).alias("pos", "key"),
        )
        .where("key <> ''")
        .select(k1.alias("k1"), k2.alias("k2"), "id", "__d1", "__d2", "pos")
    )
    order = ["k1", "k2", "id", "__d1", "__d2", "pos"]
    lines = settled(lines.repartitionByRange(*order).sortWithinPartitions(*order))
    # The first position of a key in each row of a document: repeated lines of one document count once.
    firsts = lines.groupBy("k1", "k2", "id", "__d1", "__d2", "pos").agg(F.count(F.lit(1)).alias("copies"))
    if keep_first:
        firsts = firsts.groupBy("k1", "k2", "id", "__d1", "__d2").agg(
            F.max("copies").alias("copies"), F.min("pos").alias("pos")
        )
        counts = firsts.groupBy("k1", "k2").agg(
            F.sum("copies").alias("documents"), F.min(F.struct("id", "__d1", "__d2", "pos")).alias("first")
        )
    else:
        per_document = firsts.groupBy("k1", "k2", "id", "__d1", "__d2").agg(F.max("copies").alias("copies"))
        counts = per_document.groupBy("k1", "k2").agg(F.sum("copies").alias("documents"))
    frequent = settled(counts.where(F.col("documents") >= min_documents))
    gone = lines.join(frequent, ["k1", "k2"])
    if keep_first:
        gone = gone.where(~F.struct("id", "__d1", "__d2", "pos").eqNullSafe(F.col("first")))
    words = gone.groupBy("__d1", "__d2", F.expr(f"pos div {WORD}").cast("int").alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD})")).alias("bits")
    )
    return words.groupBy("__d1", "__d2").agg(
        F.map_from_entries(F.collect_list(F.struct("word", "bits"))).alias("__dropped")
    )


def dedup_lines(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    min_documents: int = MIN_DOCUMENTS,
    keep_first: bool = False,
) -> DataFrame:
    """The documents with their columns, the text without the dropped lines, and n_lines, n_dropped, dropped_lines."""
    bitmaps = keep_bitmaps(docs, id_column, text_column, min_documents, keep_first)
    marked = docs.select("*", *_document(id_column, text_column)).join(bitmaps, ["__d1", "__d2"], "left")
    lines = _lines(F.col(text_column))
    kept = F.filter(
        lines,
        lambda _, i: F.coalesce(F.col("__dropped")[F.floor(i / WORD).cast("int")], F.lit(0)).bitwiseAND(
            F.expr("1L") * F.call_function("shiftleft", F.lit(1).cast("long"), i % WORD)
        )
        == 0,
    )
    counted = F.aggregate(F.map_values("__dropped"), F.lit(0).cast("long"), lambda n, w: n + F.bit_count(w))
    return marked.select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in (text_column, *MADE)],
        F.when(F.col("__dropped").isNull(), F.coalesce(F.col(text_column), F.lit("")))
        .otherwise(F.array_join(kept, "\n"))
        .alias(text_column),
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(counted, F.lit(0).cast("long")).alias("n_dropped"),
        F.col("__dropped").alias("dropped_lines"),
    )


def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


ORACLE_SQL = """
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
  SELECT r, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs
), keyed AS (
  SELECT r, pos, line,
    translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines
), frequent AS (
  SELECT k FROM keyed WHERE k <> '' GROUP BY k HAVING count(DISTINCT r) >= 10
), kept AS (
  SELECT r, count(*) AS n_dropped_not,
    string_agg(line, chr(10) ORDER BY pos) AS text FROM keyed WHERE k NOT IN (SELECT k FROM frequent) GROUP BY r
)
SELECT doc_id, CAST(len(ls) AS BIGINT) AS n_lines, CAST(len(ls) - coalesce(n_dropped_not, 0) AS BIGINT) AS n_dropped,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""
