"""Near duplicates by BagMinHash: weighted-Jaccard signatures of word-shingle multisets, banded and verified.

A shingle that stands w times in a text has weight w. Over each shingle runs a Poisson process in (value, weight),
laid out by dyadic intervals of weight (0,1], (1,2], (2,4], ...: a text takes whole intervals below its weight, and
of the last one the points whose weight it reaches. Every point falls into one register, which keeps its
smallest value; two registers are equal with just the probability of the weighted Jaccard similarity.
Points come in rising order, so a process stops once it is past the largest register.

Texts with equal multisets are one class, and only one of them goes on. Classes that share a band of registers are
candidates; a bucket whose members are those of an earlier band's is left out, as its pairs met there. The members of
a band's bucket are dealt into blocks of bounded size, and each pair of blocks is
one piece of work: no row is made for a pair of documents. There, pairs that met in an earlier band are left out, and
so are those whose registers agree too little to leave any doubt; the others are verified on the multisets
themselves, as products of 0-1 vectors. Of the verified pairs, which are links, a piece returns those that connect
what was apart in it; components of these are groups, the same as of all links.

Defined results: a word is what stands between white space, in lower case, without marks at its ends; texts of one
to four words are one shingle; texts without words (null, empty, marks only) are one class; rows with a null id
link with nothing; rows with one id and different texts are documents of their own, and rows equal in both are one;
texts of any length are read whole; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, components, digest, named, rows_of, table
from tidemark.session import settled

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 25, 5
REGISTERS = BANDS * ROWS
#: A pair of similarity 0.8 agrees in fewer than this share of its registers once in a hundred million times.
LEAST_AGREEMENT = 0.6
#: Documents in a block of a bucket; two blocks are compared at a time.
BLOCK = 512
#: Columns of 0-1 vectors that are multiplied at a time.
COLUMNS = 4096

EDGES = re.compile(r"^\W+|\W+$")
U = np.uint64


def mixed(x: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit hash of each number (splitmix64's finisher)."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def _word_hash(word: str) -> int:
    """Of the word without marks at its ends; 0 if nothing is left."""
    bare = word if word.isalnum() else EDGES.sub("", word)
    raw = bare.encode("utf-8", "replace")
    return (zlib.crc32(raw) << 32 | zlib.crc32(raw, 0x9E3779B9) ^ (len(raw) * 2654435761 & 0xFFFFFFFF)) if bare else 0


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, shingle, times): the multisets of a batch, sorted by text."""
    lists = pc.utf8_split_whitespace(pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), "")))
    coded = lists.flatten().dictionary_encode()
    offsets = lists.offsets.to_numpy()
    of = np.repeat(np.arange(len(texts)), np.diff(offsets))
    hashes = np.array([_word_hash(w) for w in coded.dictionary.to_pylist()], U)
    word = hashes[coded.indices.to_numpy()] if len(of) else np.zeros(0, U)
    of, word = of[word != 0], mixed(word[word != 0])
    count = np.bincount(of, minlength=len(texts))
    end = np.cumsum(count)

    n = len(word)
    rolled = np.zeros(n, U)
    for k in range(words):
        rolled[: max(0, n - k)] = mixed(rolled[: max(0, n - k)] * U(31) + word[k:] + U(k + 1))
    whole = np.arange(n) + words <= end[of]
    found, text = rolled[whole], of[whole]
    short = np.flatnonzero((count > 0) & (count < words))
    if len(short):
        own = []
        for i in short:
            h = U(count[i])
            for w in word[end[i] - count[i] : end[i]]:
                h = mixed(np.array([h], U) * U(31) + w)[0]
            own.append(h)
        text, found = np.concatenate([text, short]), np.concatenate([found, np.array(own, U)])
    _, first, times = np.unique(
        mixed(found ^ mixed(text.astype(U) + U(1))), return_index=True, return_counts=True
    )
    order = np.argsort(text[first], kind="stable")
    return text[first][order], found[first][order], times[order]


def signatures(text: np.ndarray, shingle: np.ndarray, times: np.ndarray, n: int, m: int = REGISTERS) -> np.ndarray:
    """Registers of n texts, n x m; infinite for a text without shingles."""
    # One process per shingle and dyadic interval of weight below its weight.
    levels = np.ceil(np.log2(times)).astype(np.int64) + 1
    at = np.repeat(np.arange(len(text)), levels)
    level = np.arange(len(at)) - np.repeat(np.cumsum(levels) - levels, levels)
    low = np.where(level == 0, 0, 1 << np.maximum(level - 1, 0))
    width = np.where(level == 0, 1, low)
    key = mixed(shingle[at] + mixed(level.astype(U) + U(77)))
    own, reach = text[at], times[at] - low  # reach: how much of the interval the weight covers
    registers = np.full(n * m, np.inf)
    value = np.zeros(len(at))
    largest = np.full(n, np.inf)
    turn = 0
    while len(own):
        turn += 1
        draw = mixed(key + U(turn * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        value = value - np.log(((draw >> U(20)).astype(np.float64) + 0.5) * 2.0**-44) / width
        live = value < largest[own]
        if not live.all():
            key, own, width, reach, value, draw = (x[live] for x in (key, own, width, reach, value, draw))
            if not len(own):
                break
        place = ((draw & U(0xFFFFF)) * U(m)) >> U(20)
        part = reach < width
        hits = np.ones(len(own), bool)
        if part.any():
            mark = (mixed(draw[part] + U(0x5851F42D4C957F2D)) >> U(11)).astype(np.float64) * 2.0**-53
            hits[part] = np.floor(mark * width[part]) < reach[part]
        np.minimum.at(registers, own[hits] * m + place[hits].astype(np.int64), value[hits])
        touched = np.unique(own)
        largest[touched] = registers.reshape(n, m)[touched].max(axis=1)
    return registers.reshape(n, m)


def band_hashes(registers: np.ndarray) -> np.ndarray:
    """The hash of each band of registers, which are given by their bits: n x BANDS."""
    n = len(registers)
    bits = registers.astype(U).reshape(n, BANDS, ROWS)
    band = np.broadcast_to(np.arange(BANDS, dtype=U), (n, BANDS)).copy()
    for k in range(ROWS):
        band = mixed(band * U(31) + bits[:, :, k] + U(1))
    return band


def sketched(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, (c1, c2) equal for equal multisets only, registers, and the hash of each band."""

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n = batch.num_rows
            text, shingle, times = shingles(batch.column(text_column))
            classes = []
            for salt in (1, 2):
                sums = np.zeros(n, U)
                with np.errstate(over="ignore"):
                    np.add.at(sums, text, mixed(shingle + U(salt)) * times.astype(U))
                classes.append(pa.array(sums.view(np.int64)))
            registers = signatures(text, shingle, times, n).astype("<f4")
            band = band_hashes(registers.view(np.uint32))
            bands = pa.ListArray.from_arrays(
                pa.array(np.arange(n + 1) * BANDS, pa.int32()), pa.array(band.reshape(-1).view(np.int64))
            )
            return pa.RecordBatch.from_arrays(
                [batch.column(id_column), *classes, pa.array([r.tobytes() for r in registers], pa.binary()), bands],
                names=["doc_id", "c1", "c2", "registers", "bands"],
            )

        return step

    schema = "doc_id long, c1 long, c2 long, registers binary, bands array<long>"
    return rows_of(docs, id_column, text_column).mapInArrow(by_batch(make), schema)


def _shared_counts(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """Size of the overlap of sets a[i] and b[j] for each pair (i, j). A set is an array of distinct numbers."""
    if len(pairs) * 8 < len(a) + len(b):
        return np.array([len(np.intersect1d(sets[a[i]], sets[b[j]], assume_unique=True)) for i, j in pairs])
    left, right = np.concatenate([sets[x] for x in a]), np.concatenate([sets[x] for x in b])
    common = np.intersect1d(left, right)  # what only one side has is in no overlap
    rows_a, rows_b = (np.repeat(np.arange(len(x)), [len(sets[y]) for y in x]) for x in (a, b))
    keep_a, keep_b = np.isin(left, common), np.isin(right, common)
    at_a, at_b = np.searchsorted(common, left[keep_a]), np.searchsorted(common, right[keep_b])
    rows_a, rows_b = rows_a[keep_a], rows_b[keep_b]
    total = np.zeros((len(a), len(b)), np.float32)
    for start in range(0, len(common), COLUMNS):
        x, y = np.zeros((len(a), COLUMNS), np.float32), np.zeros((len(b), COLUMNS), np.float32)
        for m, rows, at in ((x, rows_a, at_a), (y, rows_b, at_b)):
            inside = (at >= start) & (at < start + COLUMNS)
            m[rows[inside], at[inside] - start] = 1
        total += x @ y.T
    return total[pairs[:, 0], pairs[:, 1]].astype(np.int64)


def _connecting(
    ids: np.ndarray, part: np.ndarray, registers: np.ndarray, bands: np.ndarray, band: int, sets: list, threshold: float
) -> list[tuple[int, int]]:
    """Links within one block (one part) or between two that connect what was apart among these documents."""
    first = part == part.min()
    a = np.flatnonzero(first)
    b = a if first.all() else np.flatnonzero(~first)
    pairs = []
    for start in range(0, len(a), 64):
        rows = a[start : start + 64]
        likely = (registers[rows][:, None] == registers[b][None]).mean(axis=2) >= LEAST_AGREEMENT
        likely &= ~(bands[rows][:, None, :band] == bands[b][None, :, :band]).any(axis=2)
        if b is a:
            likely &= (start + np.arange(len(rows)))[:, None] < np.arange(len(b))[None]
        pairs.append(np.argwhere(likely) + [start, 0])
    pairs = np.concatenate(pairs)
    if not len(pairs):
        return []
    used_a, used_b = np.unique(pairs[:, 0]), np.unique(pairs[:, 1])
    inner = np.stack([np.searchsorted(used_a, pairs[:, 0]), np.searchsorted(used_b, pairs[:, 1])], axis=1)
    shared = _shared_counts(sets, a[used_a], b[used_b], inner)
    size = np.array([len(s) for s in sets])
    total = size[a[pairs[:, 0]]] + size[b[pairs[:, 1]]] - shared
    parent = list(range(len(ids)))

    def top(x: int) -> int:
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    found = []
    for i, j in pairs[shared >= threshold * np.maximum(1, total)].tolist():
        x, y = top(a[i]), top(b[j])
        if x != y:
            parent[x] = y
            found.append((int(ids[a[i]]), int(ids[b[j]])))
    return found


def _occurrences(texts: pa.Array, words: int) -> list[np.ndarray]:
    """Each text's multiset as a set: the k-th occurrence of a shingle is an element of its own."""
    text, shingle, times = shingles(texts, words)
    at = np.repeat(np.arange(len(text)), times)
    k = np.arange(len(at)) - np.repeat(np.cumsum(times) - times, times)
    own = mixed(shingle[at] + mixed(k.astype(U)))
    edges = np.searchsorted(text[at], np.arange(len(texts) + 1))
    return [own[x:y] for x, y in zip(edges, edges[1:], strict=False)]


def _links(blocks: DataFrame, threshold: float, words: int) -> DataFrame:
    """(a, b): connecting links of each piece (band, bucket, i, j). blocks: these, doc_id, part, registers, text;
    rows of a piece lie together."""

    def pieces(batches):
        """Tables that hold whole pieces, a bounded number of bytes beyond a single piece at a time."""
        rest = None
        for batch in batches:
            for start in range(0, batch.num_rows, 2 * BLOCK):
                now = pa.Table.from_batches([batch.slice(start, 2 * BLOCK)])
                now = now if rest is None else pa.concat_tables([rest, now])
                keys = np.stack([now.column(c).to_numpy() for c in ("band", "bucket", "i", "j")], axis=1)
                changes = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
                if len(changes):
                    yield now.slice(0, changes[-1]), np.concatenate([[0], changes])
                    rest = now.slice(changes[-1])
                else:
                    rest = now
        if rest is not None and rest.num_rows:
            yield rest, np.array([0, rest.num_rows])

    def run(batches):
        for rows, edges in pieces(batches):
            texts = rows.column("text").combine_chunks().dictionary_encode()
            distinct = _occurrences(texts.dictionary, words)
            which = texts.indices.to_numpy()
            ids, part = rows.column("doc_id").to_numpy(), rows.column("part").to_numpy()
            band = rows.column("band").to_numpy()
            registers = np.frombuffer(b"".join(rows.column("registers").to_pylist()), "<u4").reshape(len(ids), -1)
            bands = band_hashes(registers)
            found = []
            for x, y in zip(edges, edges[1:], strict=False):
                sets = [distinct[w] for w in which[x:y]]
                found += _connecting(ids[x:y], part[x:y], registers[x:y], bands[x:y], int(band[x]), sets, threshold)
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.int64())],
                names=["a", "b"],
            )

    return blocks.mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = THRESHOLD,
    words: int = WORDS,
) -> tuple[DataFrame, DataFrame]:
    """(groups, links): doc_id, class_id, group_id, kept for each document; verified links that connect the classes
    of a group.

    class_id is the smallest id with an equal multiset, group_id the smallest one reachable by links. One document
    of each group is kept, with the smallest id. If ids repeat, groups also has k1 and k2, the digest of the text.
    """
    docs = rows_of(docs, id_column, text_column).toDF("doc_id", "text").where("doc_id is not null")
    names = None
    if not docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty():
        whole = settled(named(docs, "doc_id", [F.col("text")]).groupBy("key", "doc_id", "k1", "k2").agg(F.min("text").alias("text")))
        names, docs = whole.drop("text"), whole.select(F.col("key").alias("doc_id"), "text")
    sketches = settled(sketched(docs))
    classes = sketches.groupBy("c1", "c2").agg(F.min("doc_id").alias("class_id"))
    members = settled(sketches.select("doc_id", "c1", "c2").join(classes, ["c1", "c2"]).select("doc_id", "class_id"))
    own = settled(sketches.join(members.where("doc_id = class_id").select("doc_id"), "doc_id"))

    banded = own.select("doc_id", F.posexplode("bands").alias("band", "bucket"))
    # A bucket with the same members as one of an earlier band holds only pairs that met there.
    members_of = [F.count(F.lit(1)).alias("size"), *(F.bit_xor(F.xxhash64(F.lit(k), "doc_id")).alias(f"m{k}") for k in (1, 2))]
    buckets = banded.groupBy("band", "bucket").agg(*members_of).where("size > 1")
    first = buckets.groupBy("size", "m1", "m2").agg(F.min(F.struct("band", "bucket")).alias("at"))
    sizes = first.select("at.band", "at.bucket", "size")
    shared = settled(banded.join(sizes.hint("merge"), ["band", "bucket"]))
    # Only documents that share a bucket are needed again; they are many, so both joins shuffle at any size.
    wanted = shared.select("doc_id").distinct()
    texts = docs.join(wanted.hint("merge"), "doc_id", "left_semi")
    needed = texts.join(own.select("doc_id", "registers").hint("merge"), "doc_id")
    parts = F.ceil(F.col("size") / BLOCK).cast("int")
    dealt = shared.withColumn("parts", parts).withColumn("part", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int"))
    key = ["band", "bucket", "i", "j"]
    paired = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).select(
        "band", "bucket", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "doc_id", "part"
    )
    blocks = paired.join(needed.hint("merge"), "doc_id").repartition(*key).sortWithinPartitions(*key)
    links = settled(_links(blocks.select(*key, "doc_id", "part", "registers", "text"), threshold, words))
    found = components(links).toDF("class_id", "group_id")
    groups = members.join(found, "class_id", "left").select(
        "doc_id", "class_id", F.coalesce("group_id", "class_id").alias("group_id")
    )
    groups = groups.withColumn("kept", F.col("doc_id") == F.col("group_id"))
    if names is None:
        return groups, links
    ids = names.select("key", "doc_id")
    for column in ("class_id", "group_id"):
        groups = groups.join(ids.toDF(column, "__id"), column).drop(column).withColumnRenamed("__id", column)
    for column in ("a", "b"):
        links = links.join(ids.toDF(column, "__id"), column).drop(column).withColumnRenamed("__id", column)
    groups = groups.withColumnRenamed("doc_id", "key").join(names, "key")
    return groups.select("doc_id", "class_id", "group_id", "kept", "k1", "k2"), links.select("a", "b")


def one_of_each_group(docs: DataFrame) -> DataFrame:
    """The documents, with the columns they have, of which one of each group stays: that with the smallest id.

    Rows with a null id stay; of rows with one id and one text, which are one document, one row stays.
    """
    groups, _ = near_duplicates(docs)
    own = {"__doc": F.col("doc_id").cast("long")}
    if "k1" in groups.columns:
        own["__k1"], own["__k2"] = digest(F.col("text").cast("string"))
    kept = groups.where("kept").select("doc_id", *[c[2:] for c in own if c != "__doc"]).toDF(*own)
    stay = docs.where("doc_id is not null").withColumns(own).join(kept, list(own))
    if "k1" in groups.columns:
        stay = stay.dropDuplicates(list(own))
    return stay.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def op9_bagminhash(spark: SparkSession, folder: str) -> DataFrame:
    groups, _ = near_duplicates(table(spark, folder, "documents"))
    return groups.select("doc_id", "class_id", "group_id", "kept")
