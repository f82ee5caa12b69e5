"""Byte-level BPE by replaying all merges over a corpus of distinct words.

A task takes its documents batch by batch. The distinct pieces of a batch are laid out as one array of tokens
with links to the neighbours inside a piece; an inverted index gives, for each merge rank, the positions whose
pair it merges. Ranks are applied in order, each to all of its positions at once; a merge makes new pairs
with the two neighbours it touched, and only those are looked up and entered into the index. No shuffle: the
documents are read once and only counts and digests leave a task. Pieces met before are kept in a bounded map.

Defined results: null or empty text has 0 tokens and the digests of the empty string; texts of any length are
encoded whole; other columns and repeated rows are left as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import itertools
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, rows_of, table
from tidemark.llm.words import encode_batch

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
#: Entries that the maps of chunks and pieces hold before they are emptied.
MAP_ENTRIES = 300_000
#: Bytes of distinct pieces that are replayed together.
REPLAY_BYTES = 8_000_000

NONE = np.int32(2**31 - 1)
ID = np.dtype("<i4").type


class Replay:
    """The merges of a rank file, applied to many byte strings together."""

    def __init__(self, vocabulary: str):
        with open(vocabulary, "rb") as lines:
            self.ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int64)
        self.base = max(self.tokens) + 1
        pairs = [
            (self.ranks[t[:k]] * self.base + self.ranks[t[k:]], r)
            for t, r in self.ranks.items()
            for k in range(1, len(t))
            if t[:k] in self.ranks and t[k:] in self.ranks
        ]
        table = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        self.keys, self.values = table[:, 0].copy(), table[:, 1].astype(np.int32)

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair of tokens, NONE where there is none."""
        key = left.astype(np.int64) * self.base + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.values[at], NONE)

    def encode(self, words: list[bytes]) -> list[bytes]:
        """Token ids of each word, as little-endian 32-bit integers; a word that is itself a token is that token,
        as in the public library."""
        out: list = [ID(self.ranks[w]).tobytes() if w in self.ranks else b"" for w in words]
        rest = [i for i, ids in enumerate(out) if not ids and words[i]]
        start = 0
        while start < len(rest):
            stop, size = start, 0
            while stop < len(rest) and (stop == start or size < REPLAY_BYTES):
                size += len(words[rest[stop]])
                stop += 1
            for i, ids in zip(rest[start:stop], self._replay([words[i] for i in rest[start:stop]]), strict=True):
                out[i] = ids
            start = stop
        return out

    def _replay(self, words: list[bytes]) -> list[bytes]:
        sizes = np.array([len(w) for w in words])
        ends = np.cumsum(sizes)
        token = self.byte[np.frombuffer(b"".join(words), np.uint8)].astype(np.int32)
        n = len(token)
        after = np.arange(1, n + 1, dtype=np.int32)
        before = np.arange(-1, n - 1, dtype=np.int32)
        after[ends - 1] = -1
        before[ends - sizes] = -1
        alive = np.ones(n, bool)

        # rank[p]: the merge that the pair starting at p stands for just now.
        rank = np.full(n, NONE, np.int32)
        pairs = np.flatnonzero(after >= 0)
        rank[pairs] = self.rank_of(token[pairs], token[pairs + 1])
        order = np.argsort(rank, kind="stable").astype(np.int32)
        starts = np.searchsorted(rank[order], np.arange(self.base + 1))
        index: dict[int, list] = {}  # positions that later merges have added to a rank
        waiting = np.flatnonzero(np.diff(starts)).tolist()
        queued = set(waiting)  # a sorted list is a heap
        done_initial = set()

        while waiting:
            r = heapq.heappop(waiting)
            queued.discard(r)
            added = index.pop(r, None)
            at = order[starts[r] : starts[r + 1]] if r not in done_initial else order[:0]
            done_initial.add(r)
            if added is not None:
                at = np.unique(np.concatenate([at, *added]))
            at = at[rank[at] == r]
            if len(at) > 1:  # of overlapping pairs every other one, from the left
                touching = after[at[:-1]] == at[1:]
                if touching.any():
                    opens = np.flatnonzero(np.concatenate([[True], ~touching]))
                    place = np.arange(len(at)) - np.repeat(opens, np.diff(np.append(opens, len(at))))
                    at = at[place % 2 == 0]
            if not len(at):
                continue
            gone = after[at]
            beyond = after[gone]
            token[at], alive[gone], rank[gone], after[at] = r, False, NONE, beyond
            inner = beyond >= 0
            before[beyond[inner]] = at[inner]
            left = before[at]
            left = left[left >= 0]
            rank[at[~inner]] = NONE
            touched = np.concatenate([left, at[inner]])
            new = self.rank_of(token[touched], token[after[touched]])
            rank[touched] = new
            some = new != NONE
            touched, new = touched[some], new[some]
            if not len(touched):
                continue
            by_rank = np.argsort(new, kind="stable")
            touched, new = touched[by_rank], new[by_rank]
            cuts = np.flatnonzero(np.diff(new)) + 1
            firsts = new[np.concatenate([[0], cuts])].tolist()
            for k, part in zip(firsts, np.split(touched, cuts) if len(cuts) else [touched], strict=True):
                index.setdefault(k, []).append(part)
                if k not in queued:
                    queued.add(k)
                    heapq.heappush(waiting, k)

        ids = token[alive].astype("<i4").tobytes()
        counts = np.add.reduceat(alive, ends - sizes, dtype=np.int64)
        bounds = np.concatenate([[0], 4 * np.cumsum(counts)]).tolist()
        return [ids[a:b] for a, b in zip(bounds, bounds[1:], strict=False)]

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Encoder:
    """Encodes batches of texts; the pieces of earlier batches are kept until the map is full."""

    def __init__(self, vocabulary: str = VOCABULARY, pattern: str = PATTERN):
        self.replay, self.pieces_of = Replay(vocabulary), regex.compile(pattern).findall
        self.of_piece: dict[str, bytes] = {}

    def encode(self, batch: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        return encode_batch(batch, self._chunks)

    def _chunks(self, distinct: list[str]) -> list[bytes]:
        pieces = list(map(self.pieces_of, distinct))
        if len(self.of_piece) > MAP_ENTRIES:
            self.of_piece = {}
        unknown = list(set(chain.from_iterable(pieces)).difference(self.of_piece))
        encoded = self.replay.encode([p.encode("utf-8", "surrogatepass") for p in unknown])
        self.of_piece.update(zip(unknown, encoded, strict=True))
        piece = self.of_piece.__getitem__
        return [piece(p[0]) if len(p) == 1 else b"".join(map(piece, p)) for p in pieces]


def encode_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """(id, ids): the token ids of each row's whole text, as an array."""

    def make():
        encoder = Encoder(vocabulary, pattern)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, offsets = encoder.encode(batch.column(text_column))
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(id_column), lists], names=[id_column, "ids"])

        return step

    return rows_of(docs, id_column, text_column).mapInArrow(by_batch(make), f"{id_column} long, ids array<int>")


def decode_documents(encoded: DataFrame, id_column: str = "doc_id", vocabulary: str = VOCABULARY) -> DataFrame:
    """(id, text): the texts of arrays of token ids; bytes that are no UTF-8 become the replacement character."""

    def make():
        replay = Replay(vocabulary)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            found = [replay.decode(ids or []).decode("utf-8", "replace") for ids in batch.column("ids").to_pylist()]
            return pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(found, pa.string())], names=[id_column, "text"]
            )

        return step

    return encoded.select(id_column, F.col("ids").cast("array<int>").alias("ids")).mapInArrow(
        by_batch(make), f"{id_column} long, text string"
    )


def digests(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = VOCABULARY,
    pattern: str = PATTERN,
) -> DataFrame:
    """Encode and decode each row in one task and return what is needed to compare: count and two digests."""

    def make():
        encoder = Encoder(vocabulary, pattern)
        decimal: dict[int, str] = {rank: str(rank) for rank in encoder.replay.tokens}

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            n_tokens, ids_sha, decoded_sha = [], [], []
            flat, offsets = encoder.encode(batch.column(text_column))
            for start, end in itertools.pairwise(offsets.tolist()):
                ids = flat[start:end].tolist()
                n_tokens.append(len(ids))
                ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(encoder.replay.decode(ids)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [batch.column(id_column), pa.array(n_tokens, pa.int64()), pa.array(ids_sha), pa.array(decoded_sha)],
                names=[id_column, "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return step

    schema = f"{id_column} long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return rows_of(docs, id_column, text_column).mapInArrow(by_batch(make), schema)


def op7_merge_replay(spark: SparkSession, folder: str) -> DataFrame:
    return digests(table(spark, folder, "documents"))
