"""Operators 3 and 7 against the public tokenizers and an exhaustive packing."""

import base64
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.helpers import documents, frame
from tidemark.llm import op03_dominance_packing as packing
from tidemark.llm import op07_merge_replay as replay
from tidemark.llm import words

ODD = [None, "", " ", "a", "  x  ", "\n\n\n", "a\n \nb", "it's  'll ", "日本語 🙂‍", "a" * 3000, "ab" * 500, "\x1c \x85 x", "<|endoftext|>"]


@pytest.fixture(scope="module")
def public():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_replay_of_odd_texts(public):
    rng = random.Random(1)
    texts = ["".join(rng.choice(" \n\tab's1,!\r　é🙂") for _ in range(rng.randint(0, 50))) for _ in range(3000)]
    texts += [t for t in ODD if t]
    ids, offsets = replay.Encoder().encode(pa.array(texts))
    for text, a, b in zip(texts, offsets, offsets[1:], strict=False):
        assert ids[a:b].tolist() == public.encode_ordinary(text)


def test_replay_query(spark, public):
    got = {r["doc_id"]: r for r in replay.op7_merge_replay(spark, SMALL).collect()}
    texts = documents(spark)
    assert got.keys() == texts.keys()
    for i, text in texts.items():
        ids = public.encode_ordinary(text)
        assert got[i]["n_tokens"] == len(ids)
        assert got[i]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[i]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_round_trip_and_edges(spark):
    rows = [*enumerate(ODD), (None, "no id"), (3, "a"), (3, "a")]
    encoded = replay.encode_documents(frame(spark, rows))
    back = sorted((str(r["doc_id"]), r["text"]) for r in replay.decode_documents(encoded).collect())
    assert back == sorted((str(i), t or "") for i, t in rows)
    assert replay.digests(frame(spark, rows[:0])).count() == 0


def fewest(items, capacity):
    best = [len(items)]
    items = sorted(items, reverse=True)

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for room in {b for b in bins if b + items[i] <= capacity}:
            at = bins.index(room)
            bins[at] += items[i]
            go(i + 1, bins)
            bins[at] -= items[i]
        go(i + 1, [*bins, items[i]])

    go(0, [])
    return best[0]


def test_reduction_is_safe_and_plans_hold():
    rng = random.Random(3)
    extra = 0
    for _ in range(300):
        capacity = rng.choice([10, 20, 30])
        counts = {}
        for _ in range(rng.randint(1, 9)):
            k = rng.randint(1, capacity)
            counts[k] = counts.get(k, 0) + 1
        plan = packing.Plan(dict(counts), capacity)
        items = [k for k, n in counts.items() for _ in range(n)]
        extra += plan.sequences - fewest(items, capacity)
        fixed = packing.Plan.__new__(packing.Plan)
        fixed.capacity, fixed.left = capacity, dict(sorted(counts.items(), reverse=True))
        fixed.taken, fixed.placements, fixed.sequences = dict.fromkeys(counts, 0), [], 0
        done = fixed._reduce()
        rest = [k for k, n in fixed.left.items() for _ in range(n)]
        assert done + (fewest(rest, capacity) if rest else 0) == fewest(items, capacity)
        filled = {}
        for p in plan.placements:
            for s in range(p.sequences):
                filled.setdefault(p.sequence + s, []).extend((p.offset + i * p.length, p.length) for i in range(p.each))
        for parts in filled.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at <= capacity
        assert sorted(length for parts in filled.values() for _, length in parts) == sorted(items)
    assert extra <= 3


def pieces_of(ids):
    head = len(ids) % 1024 or 1024
    cuts = [0, *range(head, len(ids) + 1, 1024)]
    return [
        (n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
        for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))
    ]


def gapless(rows):
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    return by_sequence


def test_packing_query(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    rows = packing.op3_dominance_packing(spark, SMALL).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for i, text in documents(spark).items():
        assert sorted(got[i]) == pieces_of([*tokenizer.encode(text, add_special_tokens=False).ids, 2])
    sequences = gapless(rows)
    assert len(sequences) <= 1.02 * sum(r["length"] for r in rows) / 1024 + 1


def test_packing_edges(spark):
    rows = [*enumerate(ODD), (None, "no id"), (3, "a"), (3, "a")]
    packed = packing.pack(frame(spark, rows)).collect()
    gapless(packed)
    assert sum(r["doc_id"] == 3 for r in packed) == 3
    assert [r["length"] for r in packed if r["doc_id"] == 0] == [1]
    assert packing.pack(frame(spark, rows[:0])).count() == 0


def test_reduction_leaves_lengths_beside_which_three_fit():
    counts = {724: 1, 250: 1, 100: 3, 387: 2}
    assert fewest([k for k, n in counts.items() for _ in range(n)], 1024) == 2
    assert packing.Plan(dict(counts), 1024).sequences == 2


class Counting(words.ByteLevel):
    """Notes the chunks that the library is asked for."""

    def __init__(self):
        super().__init__(packing.VOCABULARY)
        self.asked = []

    def encode_bare(self, texts):
        self.asked += [chunk for text in texts for chunk in text.split()]
        return super().encode_bare(texts)


def test_chunks_that_are_met_again_stay_known(monkeypatch):
    monkeypatch.setattr(words, "KEPT", 40)
    monkeypatch.setattr(words, "KEPT_BYTES", 20_000)
    encoder, tokenizer = words.Joined(Counting()), Tokenizer.from_file(packing.VOCABULARY)
    tokenizer.encode_special_tokens = True
    rng = random.Random(5)
    for n in range(40):
        long = "".join(rng.choice("abé日!") for _ in range(5_000)) if n % 5 == 0 else ""
        rare = " ".join("".join(rng.choice("abcdé1.\n\x85日") for _ in range(rng.randint(0, 9))) for _ in range(15))
        texts = [f"start often met, words\nof all {rare} {long}", *rng.sample(ODD, 4), f"  {rare}  end often met, "]
        ids, offsets = encoder.encode(pa.array(texts, pa.string()))
        for text, a, b in zip(texts, offsets, offsets[1:], strict=False):
            assert ids[a:b].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids
        assert len(encoder.known) <= 40 + 80
        assert encoder.known.nbytes + encoder.ids.nbytes <= 20_000 + 80_000
    assert encoder.tokenizer.asked.count("often") == 1


def test_tasks_of_a_worker_share_what_they_learnt():
    encoder = words.worker_encoder(packing.VOCABULARY, "one job")
    encoder.encode(pa.array(["some text of a task"]))
    again = words.worker_encoder(packing.VOCABULARY, "one job")
    assert "text" in again.known.to_pylist()
    assert not len(words.worker_encoder(packing.VOCABULARY, "next job").known)
