"""Plain versions of what the operators compute, for comparison."""

from __future__ import annotations

from itertools import combinations

from tests.conftest import SMALL


def documents(spark, folder=SMALL):
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    return {r["doc_id"]: r["text"] or "" for r in rows}


def frame(spark, rows, extra=True):
    """doc_id, text and columns with names that operators use themselves."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    if extra:
        df = df.selectExpr("*", "1 as length", "'x' as key", "2 as n_lines", "3 as score", "4 as piece", "null as a")
    return df


def connected(nodes, links):
    """Smallest node reachable from each node."""
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def overlap(a: dict, b: dict) -> float:
    keys = set(a) | set(b)
    total = sum(max(a.get(k, 0), b.get(k, 0)) for k in keys)
    return sum(min(a.get(k, 0), b.get(k, 0)) for k in keys) / total if total else 1.0


def shingle_sets(texts: dict, words: int = 5) -> dict:
    """Multisets of word shingles, written without the operator's array code."""
    import re

    found = {}
    for i, text in texts.items():
        bare = [re.sub(r"^\W+|\W+$", "", w) for w in text.lower().split()]
        bare = [w for w in bare if w]
        grams = [tuple(bare[k : k + words]) for k in range(max(1, len(bare) - words + 1))] if bare else []
        found[i] = {g: grams.count(g) if len(grams) < 400 else None for g in grams}
        if any(v is None for v in found[i].values()):
            counts: dict = {}
            for g in grams:
                counts[g] = counts.get(g, 0) + 1
            found[i] = counts
    return found


def near_groups(texts: dict, threshold: float = 0.8) -> dict:
    sets = shingle_sets(texts)
    by_gram: dict = {}
    for i, grams in sets.items():
        for g in grams:
            by_gram.setdefault(g, set()).add(i)
    pairs = {p for members in by_gram.values() for p in combinations(sorted(members), 2)}
    links = [p for p in pairs if overlap(sets[p[0]], sets[p[1]]) >= threshold]
    empty = sorted(i for i, s in sets.items() if not s)
    return connected(texts, links + list(zip(empty, empty[1:], strict=False)))
