"""Document fingerprints: invertible Bloom lookup sketches of paragraphs; DataFrame functions only.

A text is cut into paragraphs (lines, and long lines at ends of sentences); each distinct one becomes a 64-bit
digest, 44 bits of hash and 20 that check them. A sketch deals a text's digests over small tables, a power of two of
them that grows with the digests; a digest's first bits name its table, so sorted digests are cut into tables, and
work grows with n log n. A table has cells, each the xor of its digests, and a digest enters one cell of each
third. The larger of two sketches is folded to the size of the smaller one. Subtracting them, which is xor again,
leaves the digests they don't share; a cell whose check is right holds just one of these, and taking it out of its
other cells makes more such cells, until all are empty. What belongs to tables that get stuck, or to a row where a check
was right by chance, is sketched anew from the digests, twice as large and with other hashes, until nothing is left.

The next document of a text is found by a sort by range over the ids alone. Texts are shuffled once, by id; a
document sends the part that is asked for, and its digests, to the one document before it.

Defined results: null text is empty and has no paragraph; two texts without paragraphs are alike (1), such a text
and another are not (0); repeated ids share the document after them, and are one document to the one before
(the least text); a null id comes after all others; a table of one row is followed by itself; an empty
table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import ranked, rows_of, table
from tidemark.session import settled

#: A paragraph is a line, or of a longer line at least so many characters up to an end of sentence.
PARAGRAPH = r"[^\n]{64,400}?[.!?](?=\s|$)|[^\n]{1,400}"
THIRD = 4  # cells in a third of a table; a power of two
LOAD = 5  # digests that a table gets at most on average if two versions of one size share nothing
MOST_BITS = 20  # of the number of tables of a fingerprint
ROUNDS = 6  # of peeling; a table that needs more counts as stuck
CHECK = (1 << 20) - 1
EMPTY = "cast(array() AS array<bigint>)"
NULL_ID = -(2**63)


def paragraphs(text: Column) -> Column:
    """Distinct digests of a text's paragraphs, sorted."""
    found = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), 0)
    trimmed = F.filter(F.transform(found, lambda p: F.trim(p)), lambda p: p != "")
    hashes = F.transform(trimmed, lambda p: F.xxhash64(p).bitwiseAND(~CHECK))
    return F.sort_array(F.array_distinct(F.transform(hashes, lambda h: h.bitwiseOR(F.xxhash64(h).bitwiseAND(CHECK)))))


def _let(name: str, value: str, body: str) -> str:
    """Evaluate a value once, for a body that names it often."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _place(seed: int) -> str:
    """The bits of digest x that say where it goes; larger sketches take other bits."""
    return f"xxhash64(x, {seed}L)" if seed else "x"


def _hit(seed: int) -> str:
    """Whether digest x enters cell i."""
    bits = f"shiftright({_place(seed)}, 24 + 8 * (i div {THIRD}))"
    return f"({bits} & {THIRD - 1}) = i % {THIRD}"


def _cells(digests: str, seed: int) -> str:
    """The cells of one table, from the name of its digests, third by third."""
    thirds = [
        f"""transform(sequence(0, {THIRD - 1}), i -> aggregate({digests}, 0L, (a, x) ->
            if((shiftright({_place(seed)}, {24 + 8 * j}) & {THIRD - 1}) = i, a ^ x, a)))"""
        for j in range(3)
    ]
    return f"concat({', '.join(thirds)})"


SIGN = "shiftleft(1L, 63)"  # turns the order of longs into that of their bits


def _first(bits: str, x: str) -> str:
    """The number that the first bits of x make; 0 for no bits."""
    return f"shiftrightunsigned(shiftrightunsigned({x}, 63 - {bits}), 1)"


def _groups(rows: str, differs: str, skip: int, of: str) -> str:
    """For each run of rows, which are sorted, a value of the run e; differs says whether row i starts a run, of whose
    rows some may be skipped. At least one row."""
    starts = f"filter(sequence(0, size({rows}) - 1), i -> if(i = 0, true, {differs}))"
    end = f"if(g + 1 < size(starts), starts[g + 1], size({rows}))"
    run = f"slice({rows}, start + {skip + 1}, {end} - start - {skip})"
    return _let("starts", starts, f"transform(starts, (start, g) -> {_let('e', run, of)})")


def _sketch(digests: str) -> str:
    """The cells of all tables of a text's digests, table by table."""
    bits = f"least({MOST_BITS}, cast(ceil(log2(greatest(1, 2 * size({digests}) / {LOAD}))) AS int))"
    # Each table's least number goes in before its digests, so that no table is without a run.
    least = f"transform(sequence(0, cast(shiftleft(1, bits) - 1 AS int)), t -> shiftleft(cast(t AS bigint), 64 - bits) ^ {SIGN})"
    cut = _groups("dealt", f"{_first('bits', 'dealt[i] ^ dealt[i - 1]')} <> 0", 1, _cells("e", 0))
    return _let("bits", bits, _let("dealt", f"sort_array(concat({digests}, {least}))", f"flatten({cut})"))


def _folded(cells: str, size: str) -> str:
    """A sketch made as small as another, whose number of cells is given: neighbouring tables are summed."""
    width, times = 3 * THIRD, f"(size({cells}) div {size})"
    summed = f"""transform(sequence(0, {size} - 1), c -> aggregate(sequence(0, cast({times} - 1 AS int)), 0L,
        (a, k) -> a ^ {cells}[cast(((c div {width}) * {times} + k) * {width} + c % {width} AS int)]))"""
    return f"if(size({cells}) = {size}, {cells}, {summed})"


def _peeled(cells: str, seed: int) -> str:
    """The digests that can be taken out of a table's cells, and the cells left."""
    pure = f"array_distinct(filter(s.cells, c -> c <> 0 AND (xxhash64(c & {~CHECK}L) & {CHECK}) = (c & {CHECK})))"
    taken = f"transform(s.cells, (c, i) -> aggregate(p, c, (a, x) -> if({_hit(seed)}, a ^ x, a)))"
    turn = f"""if(size(p) = 0, named_struct('cells', s.cells, 'found', s.found, 'over', true),
        named_struct('cells', {taken}, 'found', concat(s.found, p), 'over', false))"""
    start = f"""named_struct('cells', {cells}, 'found', cast(array() AS array<bigint>),
        'over', NOT exists({cells}, c -> c <> 0))"""
    return f"aggregate(sequence(1, {ROUNDS}), {start}, (s, r) -> if(s.over, s, {_let('p', pure, turn)}))"


def with_fingerprint(df: DataFrame, digests: str, name: str) -> DataFrame:
    """Add the number of digests and the cells of their sketch, as hex."""
    shown = F.transform(F.expr(_sketch(digests)), lambda c: F.lpad(F.hex(c), 16, "0"))
    return df.withColumn(name, F.concat(F.lpad(F.hex(F.size(digests)), 8, "0"), F.array_join(shown, "")))


STUCK = "exists(p.end.cells, c -> c <> 0)"


def _sound(result: str) -> str:
    """A check that was right by chance leaves digests that neither side has: then the whole row is left."""
    return _let(
        "r", result, f"if(size(array_except(r.found, entries)) = 0, r, named_struct('found', {EMPTY}, 'left', entries))"
    )


def _subtracted(a: str, b: str, cells_a: str, cells_b: str) -> str:
    """(found, left): digests that a and b don't share, from the difference of their sketches, and the digests of the
    tables that got stuck."""
    width = 3 * THIRD
    one = _let("e", f"slice(apart, t * {width} + 1, {width})", f"named_struct('end', {_peeled('e', 0)})")
    peeled = f"transform(sequence(0, cast(size(apart) div {width} - 1 AS int)), t -> {one})"
    bits = f"cast(round(log2(size(apart) div {width})) AS int)"
    split = _let(
        "stuck",
        f"transform(peeled, p -> {STUCK})",
        f"""named_struct(
        'found', flatten(transform(filter(peeled, p -> NOT {STUCK}), p -> p.end.found)),
        'left', if(NOT exists(stuck, t -> t), {EMPTY},
            {_let('bits', bits, f"filter(entries, x -> stuck[cast({_first('bits', f'(x ^ {SIGN})')} AS int)])")}))""",
    )
    least = f"least(size({cells_a}), size({cells_b}))"
    apart = f"zip_with({_folded(cells_a, 'least')}, {_folded(cells_b, 'least')}, (x, y) -> x ^ y)"
    whole = _let("least", least, _let("apart", apart, _let("peeled", peeled, _sound(split))))
    return _let("entries", f"concat({a}, {b})", whole)


def _again(entries: str, level: int) -> str:
    """(found, left) of digests that are left, which stand twice if they are shared."""
    tables = f"{2**level} * greatest(1, cast(ceil(size(entries) / {LOAD}) AS int))"
    dealt = f"""sort_array(transform(entries, x ->
        named_struct('t', shiftrightunsigned(xxhash64(x, {level}L), 42) % tables, 'x', x)))"""
    one = _let("cells", _cells("e", level), f"named_struct('of', e, 'end', {_peeled('cells', level)})")
    peeled = _groups("dealt", "dealt[i].t <> dealt[i - 1].t", 0, _let("e", "transform(e, q -> q.x)", one))
    split = f"""named_struct(
        'found', flatten(transform(filter(peeled, p -> NOT {STUCK}), p -> p.end.found)),
        'left', flatten(transform(filter(peeled, p -> {STUCK}), p -> p.of)))"""
    whole = _let("tables", tables, _let("dealt", dealt, _let("peeled", peeled, _sound(split))))
    nothing = f"named_struct('found', {EMPTY}, 'left', {EMPTY})"
    return _let("entries", entries, f"if(size(entries) = 0, {nothing}, {whole})")


def differences(df: DataFrame, pairs: dict[str, tuple[str, str]]) -> DataFrame:
    """Add, for each (a, b) of digest arrays, the digests that stand in one of them only."""
    done, level, columns = [], 0, df.columns
    cells = {c: f"__cells_{i}" for i, c in enumerate(dict.fromkeys(c for pair in pairs.values() for c in pair))}
    pending = df.withColumns({name: F.expr(_sketch(c)) for c, name in cells.items()})
    while True:
        for into, (a, b) in pairs.items():
            found = f"{into}_found"
            if level:
                tried = pending.withColumn("__r", F.expr(_again(f"{into}_left", level)))
                pending = tried.withColumn(found, F.concat(found, "__r.found"))
            else:
                tried = pending.withColumn("__r", F.expr(_subtracted(a, b, cells[a], cells[b])))
                pending = tried.withColumn(found, F.col("__r.found"))
            pending = pending.withColumn(f"{into}_left", F.col("__r.left")).drop("__r")
        pending = settled(pending.drop(*cells.values()))
        solved = reduce(lambda x, y: x & y, [F.size(f"{c}_left") == 0 for c in pairs])
        done.append(pending.where(solved))
        pending = pending.where(~solved)
        level += 1
        if pending.isEmpty():
            whole = reduce(DataFrame.unionByName, done)
            return whole.select(*columns, *[F.col(f"{c}_found").alias(c) for c in pairs])


def likeness(a: Column, b: Column, found: Column) -> Column:
    """Shared digests among all, from the sizes and the difference."""
    total, apart = F.size(a) + F.size(b), F.size(found)
    return F.when(total == 0, 1.0).otherwise((total - apart) / (total + apart))


def with_next(docs: DataFrame) -> DataFrame:
    """Each row (__id, text) with next_text, the part of the next document it can need, and next_digests."""
    keyed = docs.select(F.coalesce("doc_id", F.lit(NULL_ID)).alias("__id"), F.coalesce("text", F.lit("")).alias("text"))
    lengths = keyed.select("__id", F.char_length("text").alias("n"))
    ids = lengths.groupBy("__id").agg(F.max("n").alias("n"), F.count(F.lit(1)).alias("copies"))
    order = settled(ranked(ids, ["__id"], "r"))
    total, copies = order.agg(F.count(F.lit(1)), F.max("copies")).first()
    asking = order.select(
        ((F.col("r") + F.lit((total or 1) - 1)) % F.lit(total or 1)).alias("r"),
        F.col("__id").alias("asker"),
        F.expr("n div 2").alias("wanted"),
    )
    asked = order.select("r", "__id").join(asking, "r").drop("r")
    # Both joins deal the texts out by id, which Spark does once.
    sent = keyed.join(asked, "__id")
    if (copies or 1) > 1:
        sent = sent.groupBy("asker", "wanted").agg(F.min("text").alias("text"))
    sent = sent.select(
        F.col("asker").alias("__id"),
        F.substring("text", F.lit(1), F.col("wanted").cast("int")).alias("next_text"),
        paragraphs(F.col("text")).alias("next_digests"),
    )
    return keyed.join(sent, "__id")


def fingerprints(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its own, the edited text's and the next document's fingerprints compared."""
    rows = rows_of(docs, id_column, text_column).toDF("doc_id", "text")
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    kept = F.substring("text", F.lit(1), (n - half).cast("int"))
    joined = with_next(rows).select(
        F.when(F.col("__id") != NULL_ID, F.col("__id")).alias("doc_id"),
        "text",
        F.concat(kept, F.substring("next_text", F.lit(1), half)).alias("edited"),
        "next_digests",
    )
    digested = joined.select(
        "doc_id",
        F.char_length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        paragraphs(F.col("text")).alias("digests"),
        paragraphs(F.col("edited")).alias("edited_digests"),
        "next_digests",
    )
    # Digests go on to the differences unwritten: they stand in what is written there.
    compared = differences(
        digested,
        {"edited_changes": ("digests", "edited_digests"), "next_changes": ("digests", "next_digests")},
    )
    # Fingerprints are larger than the digests they are made of, so they are not written in between.
    compared = with_fingerprint(compared, "digests", "fingerprint")
    compared = with_fingerprint(compared, "edited_digests", "edited_fingerprint")
    return compared.select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
        likeness(F.col("digests"), F.col("edited_digests"), F.col("edited_changes")).alias("near_edited"),
        likeness(F.col("digests"), F.col("next_digests"), F.col("next_changes")).alias("near_next"),
        "edited_changes", "next_changes", "digests", "edited_digests", "next_digests",
    )


def op5_bloom_lookup(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints(table(spark, folder, "documents")).select(
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
