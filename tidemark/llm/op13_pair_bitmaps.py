"""Alignment of two tokenizers over a corpus, scored by an inverted index of bitmaps.

A scan's task encodes each distinct chunk of its texts by both tokenizers (see `Aligner`) and lays the two token
sequences over the same bytes: cutting at all ends of tokens of either side gives one link a piece, cutting at
the common ends gives the groups. Per document only counts and a digest go on. The links go into an index: for
each pair of ids and each block of up to 65,536 documents a compressed bitmap of the documents that link it, and
one bitmap more per binary digit of the links beyond the first (multiplicity planes). The partial bitmaps of a
task's slices are OR-merged into its block.

Blocks share no document, so the OR of a pair's bitmaps has as many bits as they have together: the popcounts,
summed by pair, are the document counts. Each posting then gets its pair's count and whether no pair of that A
id has more, goes to its block, and there its bits add to the documents' scores, weighted by their plane. What
one task holds is one block's sums, whatever the size of a pair's posting list; lists that are long (a blank, a
stop word) are many rows and join like any skewed key. No row per document and pair is ever made.

Defined results: a null or empty text, and one whose tokens of either side don't give back a blank and the text
byte for byte, has no tokens: zeros and an empty digest; texts of any length are aligned whole; rows that repeat
are documents of their own and count as such; ids may be null; other columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import LOCAL_BITS, SLICE_BYTES, rows_of, table
from tidemark.llm.words import CUT, ByteLevel, Side, gather
from tidemark.session import settled

VOCABULARY_A = public_tokenizers.path("byte_bpe_50k.json")
VOCABULARY_B = public_tokenizers.path("piece_bpe_32k.model")
#: Chunks that go into one call of a tokenizer, joined by blanks.
TOGETHER = 2_000
#: A block is closed before it has more documents than its bitmaps have places, or when it has so many postings.
BLOCK_DOCS = 65_536
BLOCK_POSTINGS = 3_000_000
#: A bitmap with fewer documents is the sorted list of them (16 bits each), else one bit per place of the block.
DENSE = 4_096
#: Rows of postings in one Arrow batch.
BATCH_ROWS = 20_000

#: Texts with blanks at an end, or with two neighbours that may be white space to a library, are cut with care.
CAREFUL = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}|\A[\s\x0b\x1c-\x1f\x{85}\p{Z}]|[\s\x0b\x1c-\x1f\x{85}\p{Z}]\z"
BLANK_PIECE = "▁"

INDEX = (
    "block long, doc int, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, "
    "a int, b int, docs binary, planes array<binary>, n_docs long"
)


def _offsets(sizes) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.asarray(sizes, np.int64))]).astype(np.int64)


class Pieces(Side):
    """BPE with byte fallback by sentencepiece, which puts the blank before its input itself."""

    def __init__(self, vocabulary: str):
        import sentencepiece

        self.model = model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)

        def spelt(i: int) -> bytes:
            name = model.id_to_piece(i)
            return bytes([int(name[3:5], 16)]) if model.is_byte(i) else name.replace(BLANK_PIECE, " ").encode()

        super().__init__([spelt(i) for i in range(model.get_piece_size())])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass
class Aligned:
    """Distinct chunks and their alignment; offsets have one entry more than there are chunks."""

    fine: np.ndarray  # whether both sides give back the chunk
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    pairs: np.ndarray  # A id * 2^32 + B id of each link
    pair_offsets: np.ndarray
    groups: list[bytes]  # each group ends with a semicolon


class Aligner:
    """Encodes by both tokenizers and aligns by bytes.

    A text may be cut before a single blank between two characters that are no white space: the blank opens a
    match of A's pattern, and no token of B has a blank inside, so no token of either side crosses the cut. For
    the same reason such chunks can be joined by blanks again, thousands in one call, and told apart by bytes.
    """

    def __init__(self, vocabulary_a: str = VOCABULARY_A, vocabulary_b: str = VOCABULARY_B):
        self.a, self.b = ByteLevel(vocabulary_a), Pieces(vocabulary_b)
        most = max(len(self.a.sizes), len(self.b.sizes))
        width = len(str(most))
        self.digits = np.zeros((most, width + 1), np.uint8)
        self.n_digits = np.array([len(str(i)) for i in range(most)])
        for i in range(most):
            self.digits[i, : self.n_digits[i]] = np.frombuffer(str(i).encode(), np.uint8)

    def chunks(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(distinct chunks, the chunk numbers of all texts in order, their offsets by text)."""
        careful = pc.match_substring_regex(texts, CAREFUL).to_numpy(zero_copy_only=False)
        kind = pa.large_list(pa.large_string())
        plain = pc.split_pattern(texts.filter(pa.array(~careful)), " ").cast(kind)
        slow = pa.array([CUT.split(t) for t in texts.filter(pa.array(careful)).to_pylist()], kind)
        lists = pa.concat_arrays([plain, slow])
        coded = lists.flatten().dictionary_encode()
        sizes = pc.list_value_length(lists).to_numpy()
        starts = np.cumsum(sizes) - sizes
        back = np.argsort(np.concatenate([np.flatnonzero(~careful), np.flatnonzero(careful)]), kind="stable")
        code = coded.indices.to_numpy()[gather(starts[back], sizes[back])]
        return coded.dictionary.to_pylist(), code, _offsets(sizes[back])

    def _encode(self, chunks: list[str]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """(fine, for either side the ids of all chunks that are fine and how many each has)."""
        n = len(chunks)
        fine = np.zeros(n, bool)
        counts = [np.zeros(n, np.int64), np.zeros(n, np.int64)]
        found: tuple[list, list] = ([], [])  # (first chunk, ids)
        alone = [i for i, c in enumerate(chunks) if not c or c[0].isspace() or c[-1].isspace() or BLANK_PIECE in c]
        left_out = set(alone)
        joint = [i for i in range(n) if i not in left_out] if alone else list(range(n))
        runs = [joint[k : k + TOGETHER] for k in range(0, len(joint), TOGETHER)]
        joined = [" ".join([chunks[i] for i in run]) for run in runs]
        for side, (tokenizer, kept) in enumerate(zip((self.a, self.b), found, strict=True)):
            kept += [np.array(ids, np.int64) for ids in tokenizer.encode(joined)]
            for k, run in enumerate(runs):
                data = (" " + joined[k]).encode("utf-8", "surrogatepass")
                ends = np.cumsum([len(chunks[i].encode("utf-8", "surrogatepass")) + 1 for i in run])
                token_ends = np.cumsum(tokenizer.sizes[kept[k]])
                at = np.searchsorted(token_ends, ends)
                if tokenizer.spelt(kept[k]) == data and np.array_equal(token_ends[at], ends):
                    counts[side][run] = np.diff(at + 1, prepend=0)
                else:
                    kept[k] = None
        for k in [k for k in range(len(runs)) if found[0][k] is None or found[1][k] is None]:
            alone += runs[k]
            found[0][k] = found[1][k] = None
        single: dict[int, list] = {}
        for i in alone:
            data = (" " + chunks[i]).encode("utf-8", "surrogatepass")
            if chunks[i]:
                ids = [np.array(t.encode([chunks[i]])[0], np.int64) for t in (self.a, self.b)]
                if all(t.spelt(x) == data for t, x in zip((self.a, self.b), ids, strict=True)):
                    single[i] = ids
        by_run = {run[0]: k for k, run in enumerate(runs) if found[0][k] is not None}
        of_run = {i: run[0] for k, run in enumerate(runs) if found[0][k] is not None for i in run}
        fine[list(of_run)] = True
        fine[list(single)] = True
        flat = []
        for side in (0, 1):
            parts, owners = [], []
            for first, k in by_run.items():
                parts.append(found[side][k])
                owners.append(np.repeat(runs[k], counts[side][runs[k]]))
            for i, ids in single.items():
                counts[side][i] = len(ids[side])
                parts.append(ids[side])
                owners.append(np.full(len(ids[side]), i))
            counts[side][~fine] = 0
            ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            order = np.argsort(np.concatenate(owners), kind="stable") if owners else np.zeros(0, np.int64)
            flat.append((ids[order], counts[side]))
        return fine, flat

    def align(self, chunks: list[str]) -> Aligned:
        fine, ((a, n_a), (b, n_b)) = self._encode(chunks)
        ends_a, ends_b = np.cumsum(self.a.sizes[a]), np.cumsum(self.b.sizes[b])
        last_a = _offsets(n_a)
        chunk_ends = np.concatenate([[0], ends_a])[last_a]  # bytes before each chunk
        ends = np.union1d(ends_a, ends_b)
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        of_a, of_b = np.searchsorted(ends_a, ends), np.searchsorted(ends_b, ends)
        pairs = (a[of_a] << 32) | b[of_b]
        pair_offsets = np.searchsorted(ends, chunk_ends, side="right")
        group_offsets = np.searchsorted(common, chunk_ends, side="right")

        # Both sides' tokens in the order group, side, place; each with its separator.
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        ids = np.concatenate([a, b])[order]
        closing = np.concatenate([np.isin(ends_a, common), np.isin(ends_b, common)])[order]
        is_b = np.concatenate([np.zeros(len(a), bool), np.ones(len(b), bool)])[order]
        separator = np.where(closing, np.where(is_b, ord(";"), ord("|")), ord(",")).astype(np.uint8)
        cells, sizes = self.digits[ids], self.n_digits[ids]
        cells[np.arange(len(ids)), sizes] = separator
        text = cells[np.arange(cells.shape[1]) <= sizes[:, None]].tobytes()
        token_offsets = last_a + _offsets(n_b)
        edges = _offsets(sizes + 1)[token_offsets].tolist()
        groups = [text[x:y] for x, y in itertools.pairwise(edges)]
        return Aligned(fine, n_a, n_b, np.diff(group_offsets), pairs, pair_offsets, groups)


def bitmaps(of: np.ndarray, docs: np.ndarray, n: int) -> pa.Array:
    """n bitmaps as bytes; entry i is document docs[i] of bitmap of[i], sorted by both."""
    sizes = np.bincount(of, minlength=n)
    edges = _offsets(sizes)
    data = docs.astype("<u2").tobytes()
    if (sizes < DENSE).all():
        return pa.Array.from_buffers(
            pa.binary(), n, [None, pa.py_buffer((edges * 2).astype(np.int32).tobytes()), pa.py_buffer(data)]
        )
    out = []
    for i, size in enumerate(sizes.tolist()):
        if size < DENSE:
            out.append(data[2 * edges[i] : 2 * edges[i + 1]])
        else:
            bits = np.zeros(BLOCK_DOCS, bool)
            bits[docs[edges[i] : edges[i + 1]]] = True
            out.append(np.packbits(bits, bitorder="little").tobytes())
    return pa.array(out, pa.binary())


def read_bitmaps(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(which bitmap, document) of each bit; the reverse of bitmaps()."""
    sizes = pc.binary_length(found).to_numpy().astype(np.int64)
    dense = sizes == BLOCK_DOCS // 8
    lists = found.filter(pa.array(~dense))
    of = [np.repeat(np.flatnonzero(~dense), sizes[~dense] // 2)]
    docs = [np.frombuffer(b"".join(lists.to_pylist()), "<u2").astype(np.int64)]
    for i, data in zip(np.flatnonzero(dense).tolist(), found.filter(pa.array(dense)).to_pylist(), strict=True):
        docs.append(np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8), bitorder="little")))
        of.append(np.full(len(docs[-1]), i))
    return np.concatenate(of), np.concatenate(docs)


class Block:
    """The index over the documents of one block, as sorted (pair and document, links) until it is closed."""

    def __init__(self, number: int):
        self.number, self.docs, self.parts, self.postings = number, 0, [], 0

    def add(self, key: np.ndarray, links: np.ndarray) -> None:
        """OR-merge the postings of a slice: key is pair number << 16 | document, each once."""
        self.parts.append((key, links))
        self.postings += len(key)

    def rows(self) -> Iterator[pa.RecordBatch]:
        if not self.postings:
            return
        key = np.concatenate([k for k, _ in self.parts])
        order = np.argsort(key, kind="stable")
        key, links = key[order], np.concatenate([x for _, x in self.parts])[order]
        pair, doc = key >> 16, key & 0xFFFF
        opens = np.flatnonzero(np.diff(pair, prepend=-1))
        starts = [*opens[::BATCH_ROWS].tolist(), len(pair)]
        for x, y in itertools.pairwise(starts):
            yield self._batch(pair[x:y], doc[x:y], links[x:y])

    def _batch(self, pair: np.ndarray, doc: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
        opens = np.flatnonzero(np.diff(pair, prepend=-1))
        of = np.cumsum(np.diff(pair, prepend=-1) != 0) - 1
        n = len(opens)
        more = links - 1
        digits = np.array([int(m).bit_length() for m in np.maximum.reduceat(more, opens).tolist()], np.int64)
        first = _offsets(digits)
        entries = [(first[of[hit]] + k, doc[hit]) for k in range(digits.max()) if len(hit := np.flatnonzero(more >> k & 1))]
        where = np.concatenate([w for w, _ in entries]) if entries else np.zeros(0, np.int64)
        which = np.concatenate([d for _, d in entries]) if entries else np.zeros(0, np.int64)
        order = np.lexsort([which, where])
        planes = bitmaps(where[order], which[order], int(first[-1]))
        ids = pair[opens]
        return _index_rows(
            n,
            block=pa.array(np.full(n, self.number), pa.int64()),
            a=pa.array(ids // 2**24, pa.int32()),
            b=pa.array(ids % 2**24, pa.int32()),
            docs=bitmaps(of, doc, n),
            planes=pa.ListArray.from_arrays(pa.array(first, pa.int32()), planes),
            n_docs=pa.array(np.bincount(of, minlength=n), pa.int64()),
        )


ARROW = pa.schema(
    [
        ("block", pa.int64()), ("doc", pa.int32()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
        ("n_groups", pa.int64()), ("groups_sha256", pa.string()), ("a", pa.int32()), ("b", pa.int32()),
        ("docs", pa.binary()), ("planes", pa.list_(pa.binary())), ("n_docs", pa.int64()),
    ]
)


def _index_rows(n: int, **columns: pa.Array) -> pa.RecordBatch:
    arrays = [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in ARROW]
    return pa.RecordBatch.from_arrays(arrays, schema=ARROW)


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = min(BLOCK_DOCS, max(1, int(batch.num_rows * SLICE_BYTES / max(1, batch.nbytes))))
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def index(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary_a: str = VOCABULARY_A,
    vocabulary_b: str = VOCABULARY_B,
) -> DataFrame:
    """A row per document (counts, digest, its block and place there) and, with ids a and b, one per posting."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(vocabulary_a, vocabulary_b)
        numbers = itertools.count(TaskContext.get().partitionId() << LOCAL_BITS)
        block = Block(next(numbers))
        for part in _slices(batches):
            if block.docs + part.num_rows > BLOCK_DOCS or block.postings > BLOCK_POSTINGS:
                yield from block.rows()
                block = Block(next(numbers))
            yield _documents(aligner, part.column(0), part.column(1), block)
        yield from block.rows()

    return rows_of(docs, id_column, text_column).mapInArrow(run, INDEX)


def _documents(aligner: Aligner, ids: pa.Array, texts: pa.Array, block: Block) -> pa.RecordBatch:
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    chunks, code, edges = aligner.chunks(texts)
    found = aligner.align(chunks)
    spoilt = np.concatenate([[0], np.cumsum(~found.fine[code])])[edges]
    fine = np.diff(spoilt) == 0

    def total(each: np.ndarray) -> np.ndarray:
        return np.where(fine, np.diff(np.concatenate([[0], np.cumsum(each[code])])[edges]), 0)

    digests = []
    listed = code.tolist()
    for good, (x, y) in zip(fine.tolist(), itertools.pairwise(edges.tolist()), strict=True):
        text = b"".join([found.groups[c] for c in listed[x:y]])[:-1] if good else b""
        digests.append(hashlib.sha256(text).hexdigest() if text else "")

    # Each document's distinct chunks and how often it has them, then their links, summed by (pair, document).
    doc = np.repeat(np.arange(n), np.diff(edges))
    used = fine[doc]
    key, times = np.unique(doc[used] * max(1, len(chunks)) + code[used], return_counts=True)
    of, chunk = key // max(1, len(chunks)), key % max(1, len(chunks))
    sizes = np.diff(found.pair_offsets)[chunk]
    link = found.pairs[gather(found.pair_offsets[chunk], sizes)]
    place = np.repeat(of, sizes) + block.docs
    key = ((link >> 32) << 40) | ((link & 0xFFFFFFFF) << 16) | place
    order = np.argsort(key, kind="stable")
    key, weight = key[order], np.repeat(times, sizes)[order]
    opens = np.flatnonzero(np.diff(key, prepend=-1))
    block.add(key[opens], np.add.reduceat(weight, opens) if len(opens) else weight)
    places = np.arange(block.docs, block.docs + n)
    block.docs += n
    return _index_rows(
        n,
        block=pa.array(np.full(n, block.number), pa.int64()),
        doc=pa.array(places, pa.int32()),
        doc_id=ids,
        n_a=pa.array(total(found.n_a), pa.int64()),
        n_b=pa.array(total(found.n_b), pa.int64()),
        n_groups=pa.array(total(found.n_groups), pa.int64()),
        groups_sha256=pa.array(digests, pa.string()),
    )


def pair_counts(postings: DataFrame) -> DataFrame:
    """(a, b, pair_docs, is_best): how many documents link the pair; whether no pair of that A id has more."""
    counts = postings.groupBy("a", "b").agg(F.sum("n_docs").alias("pair_docs"))
    best = counts.groupBy("a").agg(F.max("pair_docs").alias("__top"))
    return counts.join(best, "a").select("a", "b", "pair_docs", (F.col("pair_docs") == F.col("__top")).alias("is_best"))


def scores(postings: DataFrame, counts: DataFrame) -> DataFrame:
    """(block, doc, n_links, n_best, count_sum): every posting returns its pair's figures to its documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, sums = None, None

        def closed() -> pa.RecordBatch:
            some = np.flatnonzero(sums[0])
            columns = [np.full(len(some), now), some.astype(np.int32), *(s[some] for s in sums)]
            names = ["block", "doc", "n_links", "n_best", "count_sum"]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

        for batch in batches:
            blocks = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
            for x, y in itertools.pairwise(edges):
                if x == y:
                    continue
                if blocks[x] != now:
                    if sums is not None:
                        yield closed()
                    now, sums = blocks[x], np.zeros((3, BLOCK_DOCS), np.int64)
                part = batch.slice(x, y - x)
                count = part.column(3).to_numpy()
                best = part.column(4).to_numpy(zero_copy_only=False).astype(np.int64)
                planes = part.column(2)
                many = pc.list_value_length(planes).to_numpy()
                rows = np.repeat(np.arange(y - x), many)
                digit = np.arange(len(rows)) - np.repeat(np.cumsum(many) - many, many)
                for found, row, weight in (
                    (part.column(1), np.arange(y - x), np.ones(y - x, np.int64)),
                    (planes.flatten(), rows, 1 << digit),
                ):
                    of, docs = read_bitmaps(found)
                    row, weight = row[of], weight[of]
                    np.add.at(sums[0], docs, weight)
                    np.add.at(sums[1], docs, weight * best[row])
                    np.add.at(sums[2], docs, weight * count[row])
        if sums is not None:
            yield closed()

    rated = postings.join(counts, ["a", "b"]).select("block", "docs", "planes", "pair_docs", "is_best")
    dealt = rated.repartition("block").sortWithinPartitions("block")
    return dealt.mapInArrow(run, "block long, doc int, n_links long, n_best long, count_sum long")


def align_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary_a: str = VOCABULARY_A,
    vocabulary_b: str = VOCABULARY_B,
) -> DataFrame:
    """One row per row of docs: its id, the sizes of its alignment, its scores and the digest of its groups."""
    found = settled(index(docs, id_column, text_column, vocabulary_a, vocabulary_b))
    postings = found.where("a is not null").select("block", "a", "b", "docs", "planes", "n_docs")
    figures = scores(postings, pair_counts(postings))
    documents = found.where("a is null").select("block", "doc", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256")
    none = F.lit(0).cast("long")
    return documents.join(figures, ["block", "doc"], "left").select(
        F.col("doc_id").alias(id_column),
        "n_a",
        "n_b",
        "n_groups",
        *[F.coalesce(c, none).alias(c) for c in ("n_links", "n_best", "count_sum")],
        "groups_sha256",
    )


def op13_pair_bitmaps(spark: SparkSession, folder: str) -> DataFrame:
    return align_documents(table(spark, folder, "documents"))
