"""Toxicity: a lexicon that also catches misspellings, and the context that tells abuse from quotation.

The lexicon has stated terms and terms learned from labelled texts: words that stand in several contexts of toxic
texts and hardly in clean ones. (Copies of one text repeat its contexts, so their other words do not pass.) The
lexicon is a trie. Reading a token means walking the trie and a Levenshtein automaton together: a state is
a set of (trie node, errors so far). States and moves are found when first met and kept, so later tokens run
through a finished automaton, character by character, and most die within a few. Errors count wherever they are,
at the start too. A token that is no term as a whole is also read in parts, between marks and underscores, and with
single letters put together. A hit is weighed by the words
around it: quotation marks, verbs of saying and words about words speak for a quotation. A document's counts of
plain and quoted, exact and misspelled hits enter a logistic model whose weights are fitted to all labelled rows
with hits outside the held-out fold, towards stated prior weights; as counts are small numbers, the fit needs one
row per combination of them. A text without hits scores the share of toxic rows among such labelled rows.

Defined results: null or empty text has no hits and scores the model's base rate; texts of any length are read
whole; ids may be repeated or null (a row's score depends on its text alone), and a null one is not held out and
teaches nothing; rows without a label do not teach; without any labelled row the stated terms and prior weights hold; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import in_fold, remainder, rows_of, table
from tidemark.session import settled

# Terms of abuse, and what marks a quotation or talk about a word.
LEXICON = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "clown", "pathetic", "worthless", "disgusting",
    "imbecile", "dumbass", "asshole", "bastard", "bitch", "retard", "scumbag", "dickhead", "jackass", "cretin",
)
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes word words term terms insult insults slur slurs "
    "quoting cited phrase so-called spelled meaning means".split()
)
QUOTES = "\"“”„‟«»‹›"
LEET = str.maketrans("013457@$!", "oieastasi")

#: Tokens on either side of a hit that are looked at.
WINDOW = 4
FEATURES = ("exact_plain", "exact_quoted", "near_plain", "near_quoted")
#: Counts above this weigh as much as this.
LEVELS = 3
#: Intercept and weights before any label is seen, and how many rows' worth of trust they have. The intercept also
#: gives the score of a text without hits then.
PRIOR = (-3.0, 5.0, 0.5, 3.5, 0.2)
PRIOR_ROWS = 1.0
HELD_OUT = (5, 0)
#: Labelled rows of each class from which terms are learned at most, chosen by a hash of the id.
LEARN_ROWS = 50_000
#: A learned term has this many contexts in toxic texts, and is this many times as frequent there as in clean ones.
MIN_CONTEXTS = 4
MIN_LIFT = 50
MAP_ENTRIES = 300_000

EDGES = re.compile(r"^\W+|\W+$")
MARKS = re.compile(r"[\W_]+")


def allowed_errors(term: str) -> int:
    if term not in LEXICON:  # a learned term has no errors in a short stem to spare
        return 1 if len(term) >= 8 else 0
    return 0 if len(term) < 5 else 1 if len(term) < 9 else 2


class Lexicon:
    """A trie of terms read together with a Levenshtein automaton; both are made deterministic on the way.

    With first_given, the first letter counts as given: no error is allowed there.
    """

    def __init__(self, terms: tuple[str, ...] = LEXICON, first_given: bool = True):
        self.first_given = first_given
        self.children: list[dict[str, int]] = [{}]
        self.most = [0]  # errors that some term below a node allows
        self.term: dict[int, int] = {}  # node where a term ends, and the errors it allows
        for term in terms:
            node = 0
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], allowed_errors(term))
            self.term[node] = allowed_errors(term)
        self.most[0] = max(self.most)
        self.letters = {c for node in self.children for c in node}
        self.sets: list[frozenset] = []
        self.numbers: dict[frozenset, int] = {}
        self.result: list[int] = []  # errors of the best term that ends here, -1 for none
        self.moves: list[dict[str, int]] = []
        self.start = self._number(frozenset({(0, 0)}) if first_given else self._closed({0: 0}))

    def _number(self, states: frozenset) -> int:
        if states not in self.numbers:
            self.numbers[states] = len(self.sets)
            self.sets.append(states)
            self.moves.append({})
            ends = [e for node, e in states if e <= self.term.get(node, -1)]
            self.result.append(min(ends, default=-1))
        return self.numbers[states]

    def _closed(self, reached: dict[int, int]) -> frozenset:
        """Add the nodes reached by leaving out letters of a term; keep the fewest errors of each node."""
        todo = list(reached)
        while todo:
            node = todo.pop()
            for child in self.children[node].values():
                errors = reached[node] + 1
                if errors <= self.most[child] and errors < reached.get(child, 9):
                    reached[child] = errors
                    todo.append(child)
        return frozenset(reached.items())

    def _move(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, errors: int) -> None:
            if errors <= self.most[node] and errors < reached.get(node, 9):
                reached[node] = errors

        for node, errors in self.sets[state]:
            if node == 0 and self.first_given:
                if letter in self.children[0]:
                    reach(self.children[0][letter], 0)
                continue
            reach(node, errors + 1)  # a letter too many
            for c, child in self.children[node].items():
                reach(child, errors + (c != letter))
        return self._number(self._closed(reached))

    def errors(self, token: str) -> int:
        """Errors between a token and the nearest term within its allowance; -1 if there is none."""
        state = self.start
        for c in token:
            letter = c if c in self.letters else ""
            found = self.moves[state].get(letter)
            if found is None:
                found = self.moves[state][letter] = self._move(state, letter)
            state = found
            if not self.sets[state]:
                return -1
        return self.result[state]


class Reader:
    """Counts the hits of whole texts by kind."""

    def __init__(self, terms: tuple[str, ...] = LEXICON):
        self.lexicon = Lexicon(terms, first_given=False)
        self.kind: dict[str, tuple[int, int]] = {}  # token: its exact and misspelled hits

    def _errors(self, forms: set[str]) -> int:
        return min((e for e in map(self.lexicon.errors, forms) if e >= 0), default=-1)

    def _read(self, token: str) -> tuple[int, int]:
        lower = token.lower()
        leet = lower.translate(LEET)
        found = [self._errors({EDGES.sub("", lower), EDGES.sub("", leet)})]
        if found[0] != 0 and (MARKS.search(lower) or MARKS.search(leet)):
            # Other ways to read it: that with the most hits counts, and of these that with the most exact ones.
            ways = [found, [self._errors({"".join(MARKS.split(lower)), "".join(MARKS.split(leet))})]]
            ways += [[self._errors({p, p.translate(LEET)}) for p in self._parts(form)] for form in (lower, leet)]
            found = max(ways, key=lambda errors: (sum(e >= 0 for e in errors), errors.count(0)))
        return found.count(0), sum(e > 0 for e in found)

    @staticmethod
    def _parts(form: str) -> list[str]:
        """What stands between marks; neighbouring single letters are one part."""
        found: list[str] = []
        single = False
        for part in filter(None, MARKS.split(form)):
            if single and len(part) == 1:
                found[-1] += part
            else:
                found.append(part)
            single = len(part) == 1
        return found

    def hit(self, token: str) -> tuple[int, int]:
        found = self.kind.get(token)
        if found is None:
            if len(self.kind) > MAP_ENTRIES:
                self.kind = {}
            found = self.kind[token] = self._read(token)
        return found

    def counts(self, text: str) -> tuple[int, int, int, int]:
        tokens = text.split()
        hits = {t: found for t in set(tokens) if any(found := self.hit(t))}
        found = [0, 0, 0, 0]
        if hits:
            marks = np.cumsum([sum(map(t.count, QUOTES)) for t in tokens])
            for i in [i for i, t in enumerate(tokens) if t in hits]:
                near = tokens[max(0, i - WINDOW) : i + WINDOW + 1]
                before = int(marks[i - 1]) if i else 0
                quoted = (
                    any(c in tokens[i] for c in QUOTES)
                    or (before % 2 == 1 and marks[min(len(tokens) - 1, i + 12 * WINDOW)] > before)
                    or any(EDGES.sub("", t.lower()) in REPORTING for t in near)
                )
                for kind, n in enumerate(hits[tokens[i]]):
                    found[2 * kind + quoted] += n
        return tuple(min(n, LEVELS) for n in found)


_reader: dict[tuple, Reader] = {}


def hits(text: Column, terms: tuple[str, ...] = LEXICON) -> Column:
    """A struct of the counts in FEATURES, each at most LEVELS."""

    @F.pandas_udf(", ".join(f"{f} int" for f in FEATURES))
    def count(batch: pd.Series) -> pd.DataFrame:
        reader = _reader.setdefault(terms, Reader(terms))  # one a worker process
        rows = [reader.counts(t or "") for t in batch]
        return pd.DataFrame(rows, columns=list(FEATURES), dtype="int32")

    return count(text)


def training_rows(labels: DataFrame, fold: tuple[int, int] | None = HELD_OUT) -> DataFrame:
    """doc_id and toxic of the labelled rows that may teach."""
    marked = labels.select(F.col("doc_id").cast("long"), F.col("toxic").cast("int")).where(
        "doc_id is not null and toxic in (0, 1)"
    )
    return marked.where(remainder("doc_id", fold[0]) != fold[1]) if fold else marked


def learned_terms(
    docs: DataFrame, labels: DataFrame, fold: tuple[int, int] | None = HELD_OUT, most: int = LEARN_ROWS
) -> tuple[str, ...]:
    """Words that mark toxic texts, from at most about `most` labelled rows of each class."""
    rows = training_rows(labels, fold)
    total = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(total) < 2:
        return ()
    share = {k: min(1.0, most / n) for k, n in total.items()}
    wanted = F.when(F.col("toxic") == 1, share[1]).otherwise(share[0])
    rows = rows.where(F.xxhash64("doc_id").bitwiseAND((1 << 20) - 1) < wanted * (1 << 20))

    def words(batches):
        for batch in batches:
            clean: dict[str, int] = {}
            found: list[tuple] = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                tokens = (text or "").lower().split()
                if toxic:
                    around = ["", *tokens, ""]
                    found += {
                        (bare, zlib.crc32(f"{around[i]} {around[i + 2]}".encode("utf-8", "replace")), 0)
                        for i, t in enumerate(tokens)
                        if len(bare := EDGES.sub("", t)) > 3
                    }
                else:
                    for t in {EDGES.sub("", t) for t in set(tokens)}:
                        if len(t) > 3:
                            clean[t] = clean.get(t, 0) + 1
            found += [(t, None, n) for t, n in clean.items()]
            word, context, n = zip(*found, strict=True) if found else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.string()), pa.array(context, pa.int64()), pa.array(n, pa.int64())],
                names=["word", "context", "clean"],
            )

    taught = rows_of(docs, "doc_id", "text").join(F.broadcast(rows), "doc_id").select("text", "toxic")
    by_context = taught.mapInArrow(words, "word string, context long, clean long")
    by_context = by_context.groupBy("word", "context").agg(F.sum("clean").alias("clean"))
    counts = by_context.groupBy("word").agg(F.count("context").alias("contexts"), F.sum("clean").alias("clean"))
    lift = (F.col("contexts") / (total[1] * share[1])) / ((F.col("clean") + 0.5) / (total[0] * share[0]))
    found = counts.where((F.col("contexts") >= MIN_CONTEXTS) & (lift >= MIN_LIFT)).select("word")
    return tuple(sorted(r["word"] for r in found.collect()))


def fit(counted: DataFrame, labels: DataFrame, fold: tuple[int, int] | None = HELD_OUT) -> list[float]:
    """Score without hits, then intercept and weights, from the counts (doc_id and FEATURES) of all labelled rows
    outside the fold."""
    groups = counted.join(training_rows(labels, fold), "doc_id").groupBy(*FEATURES, "toxic").agg(F.count(F.lit(1)).alias("n")).collect()
    none = {r["toxic"]: r["n"] for r in groups if not any(r[f] for f in FEATURES)}
    prior_base = float(1 / (1 + np.exp(-PRIOR[0])))
    base = (none.get(1, 0) + PRIOR_ROWS * prior_base) / (sum(none.values()) + PRIOR_ROWS)
    groups = [r for r in groups if any(r[f] for f in FEATURES)]
    x = np.array([[1.0, *(r[f] for f in FEATURES)] for r in groups]).reshape(-1, 1 + len(FEATURES))
    y, n = np.array([r["toxic"] for r in groups], float), np.array([r["n"] for r in groups], float)
    prior = np.array(PRIOR)
    w = prior.copy()
    for _ in range(50):  # Newton steps towards the most likely weights under the prior
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (n * (y - p)) - PRIOR_ROWS * (w - prior)
        curvature = (x * (n * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + PRIOR_ROWS * np.eye(len(w))
        step = np.linalg.solve(curvature, gradient)
        w += step * min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return [base, *w.tolist()]


def probability(weights: list[float], counts: Column) -> Column:
    base, intercept, *rest = weights
    margin = reduce(lambda s, wf: s + F.lit(wf[0]) * counts[wf[1]], zip(rest, FEATURES, strict=True), F.lit(intercept))
    some = reduce(lambda s, f: s | (counts[f] > 0), FEATURES, F.lit(False))
    return F.when(some, 1 / (1 + F.exp(-margin))).otherwise(F.lit(base))


def counted(
    docs: DataFrame, terms: tuple[str, ...] = LEXICON, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """doc_id and the counts of each row."""
    found = rows_of(docs, id_column, text_column).select(
        F.col(id_column).alias("doc_id"), hits(F.col(text_column), terms).alias("hits")
    )
    return found.select("doc_id", *[F.col("hits")[f].alias(f) for f in FEATURES])


def without_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The rows that score below the threshold, with the columns they have."""
    terms = (*LEXICON, *learned_terms(docs, labels))
    weights = fit(counted(docs, terms), labels)
    return docs.where(probability(weights, hits(F.col("text").cast("string"), terms)) < threshold)


def op8_levenshtein_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    found = settled(counted(docs, (*LEXICON, *learned_terms(docs, labels))))
    weights = fit(found, labels)
    divisor, rest = HELD_OUT
    score = probability(weights, F.struct(*FEATURES))
    scored = found.select("doc_id", in_fold("doc_id", divisor, rest).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
