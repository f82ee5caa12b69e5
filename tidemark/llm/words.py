"""Token ids of a batch of texts from those of its distinct chunks, for byte-level BPE.

A text is cut before each single blank between two characters that are no white space: such a blank always
opens a match of the pattern, so no token crosses a cut and chunks can be encoded one by one. Cutting, finding
the distinct chunks and laying out the ids are array operations; only distinct chunks are handled one by one.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CUT = re.compile(r"(?<=\S) (?=\S)")
#: Two neighbours of which either may be white space to some library: such texts are cut with care.
CLOSE_BLANKS = r"[\s\x0b\x1c-\x1f\x{85}\p{Z}]{2}"


def _pieces(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lists of the texts' parts between cuts, and which text each list is of."""
    careful = pc.match_substring_regex(texts, CLOSE_BLANKS).to_numpy(zero_copy_only=False)
    plain = pc.split_pattern(texts.filter(pa.array(~careful)), " ").cast(pa.large_list(pa.large_string()))
    slow = [CUT.split(t) for t in texts.filter(pa.array(careful)).to_pylist()]
    lists = pa.concat_arrays([plain, pa.array(slow, pa.large_list(pa.large_string()))])
    return lists, np.concatenate([np.flatnonzero(~careful), np.flatnonzero(careful)])


def gather(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of runs of the given sizes, one after another."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def encode_batch(texts: pa.Array, encode: Callable[[list[str]], list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """(ids, offsets): the ids of text i are ids[offsets[i]:offsets[i + 1]].

    encode gives the ids of distinct non-empty chunks as little-endian 32-bit integers. Null reads as empty.
    """
    coded, code, first, order, counts = _coded(texts)
    names = coded.to_pylist()

    # A part that opens its text stands alone; any other has its blank before it.
    inner, opening = np.unique(code[~first]), np.unique(code[first])
    chunks = [" " + names[c] for c in inner] + [names[c] for c in opening]
    known = [i for i, c in enumerate(chunks) if c]
    encoded = dict(zip(known, encode([chunks[i] for i in known]), strict=True))
    flat = [encoded.get(i, b"") for i in range(len(chunks))]
    vocabulary = np.frombuffer(b"".join(flat), "<i4")
    size = np.array([len(x) // 4 for x in flat], np.int64)
    start = np.cumsum(size) - size

    chunk = np.empty(len(code), np.int64)
    chunk[~first] = np.searchsorted(inner, code[~first])
    chunk[first] = len(inner) + np.searchsorted(opening, code[first])
    return _laid_out(vocabulary, start, size, chunk[order], counts)


def _parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """(parts, whether each opens its text, the places in the order of the texts, how many each text has)."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    lists, of_text = _pieces(texts)
    parts = lists.flatten()
    begins = lists.offsets.to_numpy()[:-1] - lists.offsets[0].as_py()
    counts = np.diff(lists.offsets.to_numpy())
    first = np.zeros(len(parts), bool)
    first[begins[counts > 0]] = True
    back = np.argsort(of_text, kind="stable")
    return parts, first, gather(begins[back], counts[back]), counts[back]


def _coded(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(distinct parts, the part at each place, whether it opens its text, the places in the order of the texts, how
    many each text has)."""
    parts, first, order, counts = _parts(texts)
    coded = parts.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy().astype(np.int64), first, order, counts


def _laid_out(
    vocabulary: np.ndarray, start: np.ndarray, size: np.ndarray, chunk: np.ndarray, counts: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all texts, and their offsets, from the ids of each chunk and the chunks of each text."""
    ids = vocabulary[gather(start[chunk], size[chunk])]
    edges = np.concatenate([[0], np.cumsum(size[chunk])])
    return ids, edges[np.concatenate([[0], np.cumsum(counts)])]


#: White space to any library at an end of a part.
EDGE_BLANK = r"\A[\s\x0b\x1c-\x1f\x{85}\p{Z}]|[\s\x0b\x1c-\x1f\x{85}\p{Z}]\z"
#: Chunks that go into one call of the library; chunks, and bytes of them and their ids, that are kept for the next batch.
TOGETHER, KEPT, KEPT_BYTES = 2_000, 600_000, 64_000_000


class Joined:
    """As `encode_batch`, with the new chunks put together again by their blanks, thousands in one call of the
    library, and told apart by the bytes of their tokens: no token crosses such a blank.

    Chunks are numbered by one dictionary over those known and those of the batch, so no chunk is handled by
    itself. If they get too many or too long, those that most batches had stay, half as many.
    """

    def __init__(self, tokenizer: ByteLevel):
        self.tokenizer = tokenizer
        self.known = pa.array([], pa.large_string())  # chunks that don't open a text, without their blanks
        self.ids = np.zeros(0, np.int32)
        self.start, self.size, self.batches = (np.zeros(0, np.int64) for _ in range(3))  # of each known chunk

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        parts, first, order, counts = _parts(texts)
        if len(self.known) > KEPT or self.known.nbytes + self.ids.nbytes > KEPT_BYTES:
            self._forget()
        before = len(self.known)
        inner = pa.concat_arrays([self.known, parts.filter(pa.array(~first))]).dictionary_encode()
        number = inner.indices.to_numpy()[before:]
        self._learn(inner.dictionary, before)
        met = np.zeros(len(self.known), bool)
        met[number] = True
        self.batches += met
        opening = parts.filter(pa.array(first)).dictionary_encode()
        found = self.tokenizer.encode_bare(opening.dictionary.to_pylist())

        vocabulary = np.concatenate([self.ids, *[np.array(ids, np.int32) for ids in found]])
        sizes = np.array([len(ids) for ids in found], np.int64)
        size = np.concatenate([self.size, sizes])
        start = np.concatenate([self.start, len(self.ids) + np.cumsum(sizes) - sizes])
        chunk = np.empty(len(parts), np.int64)
        chunk[~first] = number
        chunk[first] = len(self.known) + opening.indices.to_numpy()
        return _laid_out(vocabulary, start, size, chunk[order], counts)

    def _forget(self) -> None:
        bytes_ = pc.binary_length(self.known).to_numpy() + 8 + 4 * self.size
        kept = np.argsort(-self.batches, kind="stable")[: KEPT // 2]
        kept = np.sort(kept[np.cumsum(bytes_[kept]) <= KEPT_BYTES // 2])
        size = self.size[kept]
        self.known, self.ids, self.start, self.size, self.batches = (
            self.known.take(pa.array(kept)),
            self.ids[gather(self.start[kept], size)],
            np.cumsum(size) - size,
            size,
            self.batches[kept] // 2,  # so that what is met no more goes in the end
        )

    def _learn(self, chunks: pa.Array, before: int) -> None:
        """Add the ids of the chunks after those known, which get the next numbers."""
        new = chunks[before:]
        sizes = pc.binary_length(new).to_numpy().astype(np.int64)
        fit = ~pc.match_substring_regex(new, EDGE_BLANK).to_numpy(zero_copy_only=False) & (sizes > 0)
        joint = np.flatnonzero(fit)
        cuts = np.append(np.arange(0, len(joint), TOGETHER), len(joint))
        runs = pa.LargeListArray.from_arrays(pa.array(cuts), new.take(pa.array(joint)))
        learnt, many, parts, alone = [], [], [], [np.flatnonzero(~fit)]
        joined = pc.binary_join(runs, pa.scalar(" ", pa.large_string())).to_pylist()
        for a, b, ids in zip(cuts[:-1], cuts[1:], self.tokenizer.encode(joined), strict=True):
            run, ids = joint[a:b], np.array(ids, np.int32)
            token_ends, ends = np.cumsum(self.tokenizer.sizes[ids]), np.cumsum(sizes[run] + 1)
            at = np.searchsorted(token_ends, ends)
            if np.array_equal(token_ends[at], ends):
                learnt.append(run)
                many.append(np.diff(at + 1, prepend=0))
                parts.append(ids)
            else:
                alone.append(run)
        single = np.concatenate(alone)
        found = self.tokenizer.encode(new.take(pa.array(single)).to_pylist())
        every = np.concatenate([*learnt, single])
        size = np.concatenate([*many, [len(ids) for ids in found]]).astype(np.int64)
        start = len(self.ids) + np.cumsum(size) - size
        back = np.argsort(every)
        self.known, self.ids, self.start, self.size, self.batches = (
            chunks,
            np.concatenate([self.ids, *parts, *[np.array(ids, np.int32) for ids in found]]),
            np.concatenate([self.start, start[back]]),
            np.concatenate([self.size, size[back]]),
            np.concatenate([self.batches, np.zeros(len(new), np.int64)]),
        )


@lru_cache(maxsize=1)
def worker_encoder(vocabulary: str, job: str) -> Joined:
    """The encoder that a Python worker keeps from task to task of one job; the next job begins anew."""
    return Joined(ByteLevel(vocabulary))


class Side:
    """A tokenizer: ids of texts, and the bytes of each id."""

    def __init__(self, tokens: list[bytes]):
        self.sizes = np.array([len(t) for t in tokens], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def spelt(self, ids: np.ndarray) -> bytes:
        return self.data[gather(self.starts[ids], self.sizes[ids])].tobytes()


class ByteLevel(Side):
    """Byte-level BPE by the tokenizers library; `encode` puts a blank before each text."""

    def __init__(self, vocabulary: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        other = [b for b in range(256) if b not in printable]
        byte_of = {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(other)}
        names = [self.tokenizer.id_to_token(i) or "" for i in range(self.tokenizer.get_vocab_size())]
        super().__init__([bytes(byte_of.get(c, 0) for c in name) for name in names])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.encode_bare([" " + t for t in texts])

    def encode_bare(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
