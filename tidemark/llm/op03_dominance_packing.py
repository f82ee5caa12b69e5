"""Packing documents into sequences: dominance reduction on the counts of lengths, then best fit.

Texts are tokenised in the tasks that read them, and only (document, piece, start, length, checksum) goes on.
How to pack depends on the lengths alone, of which there are at most as many as a sequence has tokens, so the
plan is made from one count per length: first Martello and Toth's reduction takes out sets of lengths that no
other set can beat, and the counts shrink by them; what is left goes by best fit, longest first, whole groups
of equal sequences at a time. The plan says, for runs of ranks within a length, in which sequence and where
they stand. Pieces get their rank by a sort by range over (length, document, piece), so a length that a third
of all pieces have is no single task's, and each looks its place up.

Defined results: null or empty text is the end token alone; a text that is longer than a sequence is cut from
its end into full pieces, so the first may be shorter; repeated rows are packed each on their own; ids may be
null; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import by_batch, ranked, rows_of, table
from tidemark.llm.words import worker_encoder
from tidemark.session import settled

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 1024
END_ID = 2
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


@dataclass(frozen=True)
class Placement:
    """Items [first, first + sequences * each) of a length: `each` of them in every sequence from `sequence` on."""

    length: int
    first: int
    sequences: int
    each: int
    sequence: int
    offset: int


class Plan:
    """Where the items of each length go. counts: by length; only lengths of 1 to capacity."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        self.capacity = capacity
        self.left = {length: n for length, n in sorted(counts.items(), reverse=True) if n}
        self.taken = dict.fromkeys(self.left, 0)
        self.placements: list[Placement] = []
        self.sequences = 0
        self.reduced = self._reduce()
        self._best_fit()

    def _place(self, length: int, sequences: int, each: int, sequence: int, offset: int) -> None:
        self.placements.append(Placement(length, self.taken[length], sequences, each, sequence, offset))
        self.taken[length] += sequences * each
        self.left[length] -= sequences * each
        if not self.left[length]:
            del self.left[length]

    def _fix(self, lengths: list[int], times: int) -> None:
        """Close `times` sequences that hold just these lengths."""
        offset = 0
        for length in lengths:
            self._place(length, times, 1, self.sequences, offset)
            offset += length
        self.sequences += times

    def _reduce(self) -> int:
        """Fix sets that dominate every other set with their longest item; returns the sequences fixed.

        For the longest item left, of length j: it stays alone if not even the shortest item fits beside it;
        an item that fills the sequence exactly dominates whatever else could stand there; if no two items fit
        beside it, the longest that fits does; so it does if it is at least as long as any two that fit and no
        three do, as Martello and Toth ask.
        """
        for j in list(self.left):
            while j in self.left:
                room = self.capacity - j
                own = self.left[j]
                others = {k: n - (k == j) for k, n in self.left.items() if n > (k == j)}
                fitting = [k for k in others if k <= room]  # longest first, as left is
                if not fitting:
                    self._fix([j], own)
                    continue
                partner = fitting[0]
                shortest = fitting[-1]
                runner_up = shortest if others[shortest] > 1 else (fitting[-2] if len(fitting) > 1 else room + 1)
                alone = shortest + runner_up > room
                pairs = partner >= self._best_pair(others, fitting, room) and not self._three_fit(others, fitting, room)
                if not (partner == room or alone or pairs):
                    break
                # With fewer items left there are fewer sets to beat, so this holds until one of the two runs out.
                times = own // 2 if partner == j else min(own, self.left[partner])
                self._fix([j, partner], times)
        return self.sequences

    @staticmethod
    def _three_fit(others: dict[int, int], fitting: list[int], room: int) -> bool:
        """Whether the three shortest other items fit."""
        shortest = [k for k in reversed(fitting[-3:]) for _ in range(min(3, others[k]))][:3]
        return len(shortest) == 3 and sum(shortest) <= room

    @staticmethod
    def _best_pair(others: dict[int, int], fitting: list[int], room: int) -> int:
        """The most that two other items can fill of the room; 0 if none fit."""
        low, high, best = 0, len(fitting) - 1, 0
        while low <= high:
            if low == high and others[fitting[low]] < 2:
                break
            total = fitting[low] + fitting[high]
            if total > room:
                low += 1
            else:
                best = max(best, total)
                high -= 1
        return best

    def _best_fit(self) -> None:
        groups: dict[int, list[tuple[int, int]]] = {}  # by room: (first sequence, how many)
        for length in list(self.left):
            while length in self.left:
                room = min((r for r in groups if r >= length), default=None)
                if room is None:
                    each = self.capacity // length
                    new = max(1, self.left[length] // each)
                    groups.setdefault(self.capacity, []).append((self.sequences, new))
                    self.sequences += new
                    room = self.capacity
                start, many = groups[room].pop()
                each = min(room // length, self.left[length])
                used = min(many, self.left[length] // each)
                self._place(length, used, each, start, self.capacity - room)
                if many > used:
                    groups[room].append((start + used, many - used))
                elif not groups[room]:
                    del groups[room]
                if rest := room - each * length:
                    groups.setdefault(rest, []).append((start, used))

    def arrays(self) -> dict[str, np.ndarray]:
        """The placements by length and first rank, for looking up."""
        found = sorted(self.placements, key=lambda p: (p.length, p.first))
        return {k: np.array([getattr(p, k) for p in found], np.int64) for k in Placement.__dataclass_fields__}


def token_pieces(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece of a document's ids: doc_id, piece, start, length, ids_crc32."""
    job = uuid.uuid4().hex

    def make():
        encoder = worker_encoder(vocabulary, job)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids, offsets = encoder.encode(batch.column(text_column))
            n = np.diff(offsets) + 1
            many = -(-n // capacity)
            of = np.repeat(np.arange(len(n)), many)
            piece = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            head = n[of] - (many[of] - 1) * capacity
            start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
            length = np.where(piece == 0, head, capacity)
            end = np.array([end_id], "<u4").tobytes()
            flat = ids.astype("<u4")
            last = piece == many[of] - 1
            begin = offsets[of] + start
            crc = [
                zlib.crc32(end, zlib.crc32(flat[a : a + k - 1])) if closing else zlib.crc32(flat[a : a + k])
                for a, k, closing in zip(begin.tolist(), length.tolist(), last.tolist(), strict=True)
            ]
            return pa.RecordBatch.from_arrays(
                [
                    batch.column(id_column).take(pa.array(of)),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

        return step

    return rows_of(docs, id_column, text_column).mapInArrow(by_batch(make), PIECES)


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces with sequence_id and offset. pieces has doc_id, piece, length; it is read twice."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = Plan(counts, capacity)
    starts = np.zeros(capacity + 2, np.int64)  # rank of the first piece of each length
    for length, n in counts.items():
        starts[length + 1] = n
    starts = np.cumsum(starts)
    shared = spark.sparkContext.broadcast((plan.arrays(), starts))  # a few entries per length

    def make():
        at, before = shared.value
        base = max(1, int(before[-1]))
        keys = at["length"] * base + at["first"]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            length = batch.column("length").to_numpy()
            rank = batch.column("__rank").to_numpy() - before[length]
            p = np.searchsorted(keys, length * base + rank, side="right") - 1
            j = rank - at["first"][p]
            sequence = at["sequence"][p] + j // at["each"][p]
            offset = at["offset"][p] + j % at["each"][p] * length
            kept = [batch.column(c) for c in batch.schema.names if c != "__rank"]
            names = [c for c in batch.schema.names if c != "__rank"]
            return pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)], [*names, *made])

        return step

    made = ["sequence_id", "offset"]
    columns = [c for c in pieces.columns if c not in made]
    order = ["length", "doc_id", "piece"]
    numbered = ranked(pieces.select(*columns), order, "__rank").select(*columns, "__rank")
    fields = [f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in columns]
    return numbered.mapInArrow(by_batch(make), ", ".join([*fields, "sequence_id long, offset long"]))


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    vocabulary: str = VOCABULARY,
    capacity: int = CAPACITY,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece with its sequence and its place there."""
    return placed(settled(token_pieces(docs, id_column, text_column, vocabulary, capacity, end_id)), capacity)


def op3_dominance_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))
