"""Benchmark decontamination by a prefix-filtered join of windows with documents.

An item's windows (ten words in a row, or all words of a shorter item) are sets of shingles of up to three words.
All shingles of the benchmark are counted over all documents, which orders them by rarity. For a document to
hold a window whole it must hold the window's prefix in that order; as nothing may be missing, the prefix is one
shingle, the rarest. Documents give the places of prefix shingles only, each with the words around it, and join
the windows on the shingle. The place of the shingle in the window says where the window would start; it must
start and end inside the document (position and length), and then its words are compared one by one. The words
that verified windows cover are counted as a union of spans per document.

Words are found on the bytes of whole slices of the table: in UTF-8 every character outside ASCII is made of
bytes that are word bytes. A shingle's hash is that of its words joined by blanks, from running sums, so a
shingle of any size costs the same. Tasks ask a bit map of the benchmark's hashes, of a size fixed in advance
(`FILTER_BITS`), what to give on; the joins are exact, so a full map costs time, not results. Items with the
same words are one class; identical windows are joined once.

Defined results: null, empty and wordless texts have no words, hits or items, and the digest of the empty string;
wordless items occur nowhere; texts and words of any length are read whole (words of more than 64 bytes are
compared by their 32-byte digests); repeated documents are rows of their own, also with one id; an item_id that
stands on several items is listed once; the windows of an item without id are hit, but it is neither counted nor
listed; other columns are ignored; with no items or no documents the result has no hits or no rows.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, digest, table
from tidemark.session import settled

WINDOW = 10
SHINGLE = 3
#: Bits of the map of the benchmark's shingles that every task reads: 8 MB, whatever the benchmark's size.
FILTER_BITS = 1 << 26
#: Bits of one row of the map, as Spark's bitmap functions make them.
ROW_BITS = 32_768
#: A word of more bytes goes by its digest.
LONG_WORD = 64
#: Counts that a task keeps before it gives them on.
KEPT_COUNTS = 1_000_000

#: Odd, so that its powers have inverses modulo 2^64.
BASE = 0x9E3779B97F4A7C15
#: Of each byte what it counts as: A-Z as a-z; 0 for what parts words.
FOLD = np.array(
    [b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 0 for b in range(256)], np.uint8
)
BLANK = 32


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(max(1, n), base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Words:
    """The words of a batch of texts, numbered through; each text's are starts[t] to starts[t + 1]."""

    def __init__(self, texts: pa.Array):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        # A parting byte after each text, so that no word runs into the next.
        data = np.frombuffer("\n".join([*texts.to_pylist(), ""]).encode("utf-8", "surrogatepass"), np.uint8)
        ends_of_texts = np.cumsum(sizes + 1)
        folded = FOLD[data]
        inside = folded != 0
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        first, end = edge[::2], edge[1::2]
        self.starts = np.concatenate([[0], np.searchsorted(first, ends_of_texts)])
        # The words alone, each followed by one blank.
        self.size = end - first + 1
        self.at = np.cumsum(self.size) - self.size
        keep = inside.copy()
        keep[end[end < len(keep)]] = True
        self.bytes = np.where(inside, folded, BLANK).astype(np.uint8)[keep]

    def __len__(self) -> int:
        return len(self.size)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))

    def shingles(self, sizes: list[int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(size, words where such a shingle starts, their hashes) for each size."""
        if not len(self):
            return
        powers, inverse = _powers(len(self.bytes), BASE), _powers(len(self.bytes), pow(BASE, -1, 1 << 64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((self.bytes.astype(np.uint64) + np.uint64(1)) * powers)])
        last = np.repeat(self.starts[1:], np.diff(self.starts))  # where each word's text ends
        for size in sizes:
            word = np.flatnonzero(np.arange(len(self)) + size <= last)
            begin = self.at[word]
            end = self.at[word + size - 1] + self.size[word + size - 1]
            yield size, word, _mixed((sums[end] - sums[begin]) * inverse[begin])

    def words(self, first: int, end: int) -> list[str]:
        found = self.bytes[self.at[first] : self.at[end - 1] + self.size[end - 1] - 1].tobytes().split(b" ")
        if self.size[first:end].max() > LONG_WORD:
            found = [w if len(w) <= LONG_WORD else b"\x01" + hashlib.sha256(w).hexdigest().encode() for w in found]
        return [w.decode("utf-8", "surrogatepass") for w in found]


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the low bits of sums modulo 2^64, as signed numbers."""
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(29))).view(np.int64)


def item_windows(
    benchmark: DataFrame, id_column: str = "item_id", text_column: str = "text", window: int = WINDOW, shingle: int = SHINGLE
) -> DataFrame:
    """A row per item and window: item_id, words, the hashes of its shingles in order; an item's key is its words' digest."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = Words(batch.column(1))
            by_size = {}
            for size, word, found in words.shingles(list(range(1, shingle + 1))):
                at = np.full(len(words), -1)
                at[word] = np.arange(len(word))
                by_size[size] = (at, found)
            ids, keys, texts, hashes = [], [], [], []
            for t, (x, y) in enumerate(itertools.pairwise(words.starts.tolist())):
                if x == y:
                    continue
                size = min(window, y - x)
                at, found = by_size[min(shingle, size)]
                whole = words.words(x, y)
                key = hashlib.sha256(" ".join(whole).encode("utf-8", "surrogatepass")).hexdigest()
                for start in range(y - x - size + 1):
                    texts.append(whole[start : start + size])
                    hashes.append(found[at[x + start : x + start + size - min(shingle, size) + 1]])
                    keys.append(key)
                    ids.append(t)
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(ids, pa.int64())),
                    pa.array(keys, pa.string()),
                    pa.array(texts, pa.list_(pa.string())),
                    pa.array([h.tolist() for h in hashes], pa.list_(pa.int64())),
                ],
                names=["item_id", "item_key", "words", "shingles"],
            )

        return step

    rows = benchmark.select(F.col(id_column).cast("string").alias("item_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(by_batch(make), "item_id string, item_key string, words array<string>, shingles array<long>")


class Filter:
    """A map of bits by hash; what it doesn't hold is certainly not among the hashes it was made from."""

    def __init__(self, hashes: DataFrame, column: str, bits: int = FILTER_BITS):
        place = F.col(column).bitwiseAND(F.lit(bits - 1)).alias("place")
        rows = (
            hashes.select(place)
            .groupBy(F.bitmap_bucket_number("place").alias("row"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
            .collect()  # bits / ROW_BITS rows of 4 KB at most
        )
        self.mask = bits - 1
        # Numbers of rows begin at 1, with the places 1 to ROW_BITS.
        self.map = np.zeros(bits // 8 + 2 * ROW_BITS // 8, np.uint8)
        for row in rows:
            start = row["row"] * ROW_BITS // 8
            self.map[start : start + ROW_BITS // 8] = np.frombuffer(bytes(row["bits"]), np.uint8)

    def holds(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes & self.mask
        # bitmap_bucket_number(0) is 0, with bit 0; places from 1 on are bit (place - 1) % ROW_BITS of row 1 + ...
        at = np.where(place > 0, place - 1 + ROW_BITS, 0)
        return (self.map[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def rarity(docs: DataFrame, text_column: str, shingles: DataFrame, sizes: list[int]) -> DataFrame:
    """(shingle, n): how often each of the given shingles stands in all documents, 0 included."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Filter(shingles, "shingle"))  # FILTER_BITS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        parts, kept = [], 0

        def summed():
            found = np.concatenate([x for x, _ in parts])
            order = np.argsort(found, kind="stable")
            found, n = found[order], np.concatenate([x for _, x in parts])[order]
            opens = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]]))
            return found[opens], np.add.reduceat(n, opens)

        def batch_of(found, n):
            return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n)], names=["shingle", "n"])

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            for _, _, found in Words(batch.column(0)).shingles(sizes):
                parts.append(np.unique(found[held.holds(found)], return_counts=True))
            return batch

        for _ in by_batch(lambda: step)(batches):
            kept = sum(len(x) for x, _ in parts)
            if kept > KEPT_COUNTS:
                parts[:] = [summed()]
                if len(parts[0][0]) > KEPT_COUNTS // 2:
                    yield batch_of(*parts[0])
                    parts.clear()
        if parts and any(len(x) for x, _ in parts):
            yield batch_of(*summed())

    texts = docs.select(F.col(text_column).cast("string").alias("text"))
    counted = texts.mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    return shingles.join(counted, "shingle", "left").select("shingle", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def with_prefix(windows: DataFrame, counts: DataFrame) -> DataFrame:
    """Each window with its rarest shingle and where that stands in it."""
    each = windows.select("w1", "w2", F.posexplode("shingles").alias("offset", "shingle")).join(counts, "shingle")
    first = each.groupBy("w1", "w2").agg(F.min(F.struct("n", "shingle", "offset")).alias("rarest"))
    return windows.join(first, ["w1", "w2"]).select("w1", "w2", "words", "rarest.shingle", "rarest.offset")


def places(
    docs: DataFrame, id_column: str, text_column: str, prefixes: DataFrame, sizes: list[int], window: int, shingle: int
) -> DataFrame:
    """A row per document: doc_id, n_words and its prefix shingles, each with its place and the words around it."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(Filter(prefixes, "shingle"))  # FILTER_BITS

    def make():
        held = shared.value

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            words = Words(batch.column(1))
            of, found, at, before, around = [], [], [], [], []
            text_of, starts = words.text_of(), words.starts
            for size, word, hashes in words.shingles(sizes):
                some = np.flatnonzero(held.holds(hashes))
                reach = window - size if size == shingle else 0  # shorter shingles are whole windows
                texts = text_of[word[some]]
                low = np.maximum(starts[texts], word[some] - reach)
                high = np.minimum(starts[texts + 1], word[some] + size + reach)
                of.append(texts)
                found.append(hashes[some])
                at.append(word[some] - starts[texts])
                before.append(word[some] - low)
                around += [words.words(x, y) for x, y in zip(low.tolist(), high.tolist(), strict=True)]
            none = [np.zeros(0, np.int64)]
            of = np.concatenate(of or none)
            order = np.argsort(of, kind="stable")
            edges = np.concatenate([[0], np.cumsum(np.bincount(of, minlength=batch.num_rows))])
            entries = pa.StructArray.from_arrays(
                [
                    pa.array(np.concatenate(found or none)[order], pa.int64()),
                    pa.array(np.concatenate(at or none)[order], pa.int64()),
                    pa.array(np.concatenate(before or none)[order], pa.int64()),
                    pa.array([around[i] for i in order.tolist()], pa.list_(pa.string())),
                ],
                names=["shingle", "at", "before", "around"],
            )
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(np.diff(starts), pa.int64()),
                    pa.ListArray.from_arrays(pa.array(edges, pa.int32()), entries),
                ],
                names=["doc_id", "n_words", "found"],
            )

        return step

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    entry = "shingle: long, at: long, before: long, around: array<string>"
    return rows.mapInArrow(by_batch(make), f"doc_id long, n_words long, found array<struct<{entry}>>")


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    window: int = WINDOW,
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row per document: words, words inside benchmark windows, the items these are from."""
    items = settled(item_windows(benchmark, item_column, "text", window, shingle))
    items = items.withColumns(dict(zip(("w1", "w2"), digest(F.array_join("words", " ")), strict=True)))
    windows = settled(items.select("w1", "w2", "words", "shingles").dropDuplicates(["w1", "w2"]))
    sizes = sorted(r[0] for r in windows.select(F.least(F.lit(shingle), F.size("words"))).distinct().collect())
    shingles = windows.select(F.explode("shingles").alias("shingle")).distinct()
    prefixed = settled(with_prefix(windows, rarity(docs, text_column, shingles, sizes)))

    found = places(docs, id_column, text_column, prefixed, sizes, window, shingle)
    found = settled(found.withColumn("row", F.monotonically_increasing_id()))
    hits = found.where(F.size("found") > 0).select("row", "n_words", F.explode("found").alias("e"))
    hits = hits.select("row", "n_words", "e.*").join(prefixed, "shingle")
    n = F.size("words")
    begin = F.col("at") - F.col("offset")
    inside = (F.col("offset") <= F.col("before")) & (begin >= 0) & (begin + n <= F.col("n_words"))
    part = F.slice("around", (F.col("before") - F.col("offset") + 1).cast("int"), n)
    hits = hits.where(inside).where(F.when(inside, part == F.col("words")))
    hits = settled(hits.select("row", begin.alias("begin"), (begin + n).alias("end"), "w1", "w2"))

    return (
        found.select("row", "doc_id", "n_words")
        .join(_covered(hits), "row", "left")
        .join(_items(hits, items), "row", "left")
        .select(
            F.col("doc_id").alias(id_column),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
            F.coalesce("items_sha256", F.sha2(F.lit(""), 256)).alias("items_sha256"),
            F.coalesce(F.col("n_hit") > 0, F.lit(False)).alias("contaminated"),
        )
    )


def _covered(hits: DataFrame) -> DataFrame:
    """(row, n_hit): the words in the union of a document's spans. At most one span begins at a word and length."""
    spans = hits.groupBy("row", "begin").agg(F.max("end").alias("end"))
    sorted_ = spans.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("spans"))
    zero = F.lit(0).cast("long")
    total = F.aggregate(
        "spans",
        F.struct(zero.alias("n"), zero.alias("upto")),
        lambda s, x: F.struct(
            (s["n"] + F.greatest(zero, x["end"] - F.greatest(x["begin"], s["upto"]))).alias("n"),
            F.greatest(s["upto"], x["end"]).alias("upto"),
        ),
        lambda s: s["n"],
    )
    return sorted_.select("row", total.alias("n_hit"))


def _items(hits: DataFrame, items: DataFrame) -> DataFrame:
    """(row, n_items, items_sha256). Items with the same words go together until the list is written."""
    of_window = items.select("w1", "w2", "item_key").distinct()
    ids = items.select("item_key", "item_id").distinct().groupBy("item_key").agg(F.collect_list("item_id").alias("ids"))
    met = hits.select("row", "w1", "w2").distinct().join(of_window, ["w1", "w2"]).select("row", "item_key").distinct()
    listed = met.join(ids, "item_key").groupBy("row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("ids")
    )
    return listed.select(
        "row", F.size("ids").alias("n_items"), F.sha2(F.array_join("ids", ","), 256).alias("items_sha256")
    )


ORACLE_SQL = r"""
WITH d AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents
), i AS (
    SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark
), iw AS (
    SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS win
    FROM i, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS t(s) WHERE len(w) > 0
), dw AS (
    SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS win
    FROM d, (SELECT DISTINCT n FROM iw) AS sizes, unnest(range(1, len(w) - n + 2)) AS t(s)
), hit AS (
    SELECT DISTINCT r, s, n, item_id FROM dw JOIN iw USING (n, win)
), covered AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(s, s + n)) AS t(p) GROUP BY r
), listed AS (
    SELECT r, count(*) AS n_items, sha256(string_agg(item_id, ',' ORDER BY item_id)) AS items_sha256
    FROM (SELECT DISTINCT r, item_id FROM hit WHERE item_id IS NOT NULL) AS x GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (r) LEFT JOIN listed USING (r)
"""


def op12_prefix_join(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
