"""Cross-tokenizer alignment against whole texts, token by token."""

import hashlib
import random

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.conftest import SMALL
from tests.llm.helpers import frame
from tidemark.llm import op13_pair_bitmaps as op13

ODD = ["", None, " ", "  ", "a", " a", "a ", "a  b", "\ta\n\nb \n", "x▁y", "<s> </s> <0x41>", "<|endoftext|> x", "日本語 テキスト", "é é", "🎉 🎉🎉"]


def plain(rows):
    """The contract's columns for [(id, text)], by loops over tokens and links."""
    a = Tokenizer.from_file(op13.VOCABULARY_A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=op13.VOCABULARY_B)
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(x): x for x in printable}
    letters |= {chr(256 + i): x for i, x in enumerate(x for x in range(256) if x not in printable)}

    def of_b(i):
        name = b.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if b.is_byte(i) else name.replace("▁", " ").encode()

    found = []
    for _, text in rows:
        entry = {"a": [], "b": [], "links": [], "groups": ""}
        found.append(entry)
        if not text:
            continue
        ids_a = a.encode(" " + text, add_special_tokens=False).ids
        ids_b = b.encode(text)
        bytes_a = [bytes(letters[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = [of_b(i) for i in ids_b]
        if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
            continue
        entry["a"], entry["b"] = ids_a, ids_b
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        i = j = 0
        groups, left, right = [], [], []
        new_a = new_b = True
        while i < len(ids_a) and j < len(ids_b):
            entry["links"].append((ids_a[i], ids_b[j]))
            left += [str(ids_a[i])] * new_a
            right += [str(ids_b[j])] * new_b
            new_a, new_b = ends_a[i] <= ends_b[j], ends_b[j] <= ends_a[i]
            i, j = i + new_a, j + new_b
            if new_a and new_b:
                groups.append(",".join(left) + "|" + ",".join(right))
                left, right = [], []
        entry["groups"] = ";".join(groups)
    counts = {}
    for entry in found:
        for pair in set(entry["links"]):
            counts[pair] = counts.get(pair, 0) + 1
    top = {}
    for (x, _), n in counts.items():
        top[x] = max(top.get(x, 0), n)
    out = []
    for (i, _), e in zip(rows, found, strict=True):
        links = e["links"]
        digest = hashlib.sha256(e["groups"].encode()).hexdigest() if e["groups"] else ""
        n_groups = e["groups"].count(";") + 1 if e["groups"] else 0
        best = sum(counts[p] == top[p[0]] for p in links)
        out.append((i, len(e["a"]), len(e["b"]), n_groups, len(links), best, sum(counts[p] for p in links), digest))
    return out


def returned(df):
    columns = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_documents_equal_whole_texts(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    assert returned(op13.op13_pair_bitmaps(spark, SMALL)) == sorted(plain(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_odd_texts(spark, seed):
    draw = random.Random(seed)
    parts = ["the", "tokenizers", " ", "  ", "\n", "\r\n", "\t", " ", "　", "\u0085", "\x1c", "\x00", "▁", "'s", "’", "42", "1234567", ".", "...", "é", "é", "ﬁ", "日本", "🎉", "👩‍👩‍👧", "<s>", "<0x0A>", "<|endoftext|>", "ſ", "​"]
    texts = ODD + ["".join(draw.choice(parts) + draw.choice(["", " ", " "]) for _ in range(draw.randrange(40))) for _ in range(300)]
    rows = [(i, t) for i, t in enumerate(texts)]
    assert returned(op13.align_documents(frame(spark, rows))) == sorted(plain(rows))


def test_repeats_ties_long_and_empty_tables(spark):
    long = "unbroken" * 20_000
    rows = [(1, "the same text"), (1, "the same text"), (2, "the same"), (3, "and " * 30_000 + "end"), (4, long), (5, None)]
    got = returned(op13.align_documents(frame(spark, rows)))
    assert got == sorted(plain(rows))
    assert returned(op13.align_documents(frame(spark, [(None, "no id")]).selectExpr("*"))) == plain([(None, "no id")])
    assert returned(op13.align_documents(frame(spark, []))) == []


def test_many_blocks_and_dense_bitmaps(spark):
    """Bitmaps on both sides of the switch give the same scores."""
    rows = [(i, f"the cat and the {i % 7} dogs " + "the " * (i % 5)) for i in range(9_000)]
    expected = sorted(plain(rows))
    assert returned(op13.align_documents(frame(spark, rows).coalesce(1))) == expected
    aligner, block = op13.Aligner(), op13.Block(7)
    import pyarrow as pa

    for x in range(0, 9_000, 500):
        op13._documents(aligner, pa.array([i for i, _ in rows[x : x + 500]]), pa.array([t for _, t in rows[x : x + 500]]), block)
    found = [r for batch in block.rows() for r in batch.to_pylist()]
    assert any(len(r["docs"]) == 8192 for r in found) and any(len(r["docs"]) < 8192 for r in found)
    links = sum(r["n_docs"] for r in found)
    for r in found:
        for k, plane in enumerate(r["planes"]):
            links += len(op13.read_bitmaps(pa.array([plane]))[1]) << k
    assert links == sum(r[4] for r in expected)


def test_bitmaps_round_trip():
    draw = np.random.default_rng(5)
    sizes = [0, 1, 4_095, 4_096, 60_000, 3]
    docs = [np.sort(draw.choice(op13.BLOCK_DOCS, s, replace=False)) for s in sizes]
    of = np.repeat(np.arange(len(sizes)), sizes)
    found = op13.bitmaps(of, np.concatenate(docs), len(sizes))
    got_of, got = op13.read_bitmaps(found)
    order = np.lexsort([got, got_of])
    assert np.array_equal(got_of[order], of) and np.array_equal(got[order], np.concatenate(docs))


