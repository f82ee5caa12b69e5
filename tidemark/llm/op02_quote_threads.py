"""Chat formatting: link quoted passages to the messages they come from, and order conversations by reply.

A message's lines are read by their quote level (the number of > before them). Runs of one level are passages;
what has level 0 is the message's own text. A passage and its lines, normalised, are hashed, as are the own text,
its paragraphs and its lines; a quoted hash is joined to the latest earlier message of the conversation that has
it as its own. That join is a sort by range of quotes and originals together, in which each task carries the
last original along and starts from the last one before it, so that no conversation and no common line is one
task's. The passage belongs to the message that explains most of its characters. A message replies to the message
of its first linked passage of level 1; replies are followed up to the message that opened the thread by doubling
steps. The conversation's order is by thread, then turn.

Defined results: null or empty text is an empty message; quotes without a known original are cut like others but
link with nothing; a line of attribution right before a quote goes with it; of rows with the same conversation and
turn each is a message, and quotes of either point to that turn; a null conversation or turn links with nothing and
is ordered first; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import LOCAL_BITS, by_batch, digest, ranked, table
from tidemark.session import settled

QUOTE = re.compile(r"^[ \t]{0,3}((?:>[ \t]?)+)(.*)$")
#: How programs of several languages introduce a quote.
ATTRIBUTION = re.compile(r"(wrote|writes|said|schrieb|a écrit|escribió)\s*:\s*$", re.I)
SPACE = re.compile(r"\s+")


def normalised(passage: str) -> str:
    return SPACE.sub(" ", passage).strip().lower()


def split_quotes(text: str | None) -> tuple[str, list[tuple[int, str]]]:
    """The text without quotes, and the quoted passages with their levels, in order."""
    own: list[str] = []
    passages: list[tuple[int, list[str]]] = []
    before = 0
    for line in (text or "").split("\n"):
        found = QUOTE.match(line)
        level = found.group(1).count(">") if found else 0
        if not level:
            own.append(line)
        else:
            if not before and own and ATTRIBUTION.search(own[-1]):
                own.pop()
            if level != before:
                passages.append((level, []))
            passages[-1][1].append(found.group(2))
        before = level
    kept = "\n".join(own)
    return (kept.strip() if passages else kept), [(level, "\n".join(lines)) for level, lines in passages]


def _hash(unit: str) -> int:
    raw = unit.encode("utf-8", "replace")
    return int.from_bytes(blake2b(raw, digest_size=8).digest(), "big", signed=True)


def units(passage: str) -> dict[int, int]:
    """Hashes of a passage, its paragraphs and its lines, with their lengths; empty ones are left out."""
    parts = [passage, *re.split(r"\n\s*\n", passage), *passage.split("\n")]
    return {_hash(n): len(n) for n in map(normalised, parts) if n}


def _keyed(messages: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and a key that only rows equal in all of these share."""
    plain = messages.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"),
        F.col("text").cast("string").alias("text"),
    )
    first, second = digest(*map(F.col, ("conv_id", "turn", "role", "text")))
    return plain.withColumns({"k1": first, "k2": second})


def _parsed(keyed: DataFrame) -> DataFrame:
    """Per message: quotes (passage, level, hash, length) and the hashes of its own text."""

    def make():
        kind = pa.list_(pa.struct([("passage", pa.int32()), ("level", pa.int32()), ("h", pa.int64()), ("n", pa.int64())]))

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            quotes, own, many = [], [], []
            for text in batch.column("text").to_pylist():
                kept, passages = split_quotes(text)
                many.append(len(passages))
                quotes.append(
                    [
                        {"passage": i, "level": level, "h": h, "n": n}
                        for i, (level, passage) in enumerate(passages)
                        for h, n in units(passage).items()
                    ]
                )
                own.append(list(units(kept)))
            kept_columns = [batch.column(c) for c in ("conv_id", "turn", "k1", "k2")]
            return pa.RecordBatch.from_arrays(
                [*kept_columns, pa.array(many, pa.int32()), pa.array(quotes, kind), pa.array(own, pa.list_(pa.int64()))],
                names=["conv_id", "turn", "k1", "k2", "n_quotes", "quotes", "own"],
            )

        return step

    schema = (
        "conv_id long, turn long, k1 long, k2 long, n_quotes int, "
        "quotes array<struct<passage: int, level: int, h: long, n: long>>, own array<long>"
    )
    return keyed.mapInArrow(by_batch(make), schema)


def _last_before(events: DataFrame) -> DataFrame:
    """For each quote among the events (conv_id, h, turn, own, ...), origin: the latest earlier turn that has h.

    Sorted by (conv_id, h, turn, own), the origin is the last own event before the quote, if of the same hash.
    """
    order = ["conv_id", "h", "turn", "own", "k1", "k2", "passage"]
    fixed = settled(
        events.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", F.monotonically_increasing_id())
    ).withColumn("part", F.shiftright("place", LOCAL_BITS))
    original = F.when(F.col("own") == 1, F.struct("conv_id", "h", "turn"))
    within = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    ends = fixed.groupBy("part").agg(F.max_by(original, F.when(F.col("own") == 1, F.col("place"))).alias("end"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    carried = ends.select("part", F.last("end", ignorenulls=True).over(before).alias("carried"))
    marked = fixed.withColumn("last", F.last(original, ignorenulls=True).over(within))
    marked = marked.where("own = 0").join(F.broadcast(carried), "part").withColumn("last", F.coalesce("last", "carried"))
    same = (F.col("last.conv_id") == F.col("conv_id")) & (F.col("last.h") == F.col("h"))
    return marked.where(same).withColumn("origin", F.col("last.turn"))


def links(parsed: DataFrame) -> DataFrame:
    """k1, k2, passage, level, origin: the turn that each passage with a known original comes from."""
    known = parsed.where("conv_id is not null and turn is not null")
    quoted = settled(
        known.where("n_quotes > 0")
        .select("conv_id", "turn", "k1", "k2", F.explode("quotes").alias("q"))
        .select("conv_id", "turn", "k1", "k2", "q.passage", "q.level", "q.h", "q.n")
    )
    wanted = quoted.select("conv_id", "h").distinct()
    originals = (
        known.select("conv_id", "turn", F.explode("own").alias("h"))
        .join(wanted, ["conv_id", "h"], "left_semi")
        .distinct()
    )
    events = quoted.withColumn("own", F.lit(0)).unionByName(originals.withColumn("own", F.lit(1)), allowMissingColumns=True)
    found = _last_before(events).groupBy("k1", "k2", "passage", "level", "origin").agg(F.sum("n").alias("n"))
    best = F.max(F.struct("n", "origin")).alias("best")
    return found.groupBy("k1", "k2", "passage", "level").agg(best).select(
        "k1", "k2", "passage", "level", F.col("best.origin").alias("origin")
    )


def _threads(replies: DataFrame) -> DataFrame:
    """conv_id, turn, root, depth of the messages that reply. replies: conv_id, turn, parent; parent < turn."""
    up = settled(replies.select("conv_id", "turn", F.col("parent").alias("root"), F.lit(1).alias("depth")))
    while True:
        above = up.select("conv_id", F.col("turn").alias("root"), F.col("root").alias("r2"), F.col("depth").alias("d2"))
        joined = up.join(above, ["conv_id", "root"], "left")
        new = settled(
            joined.select(
                "conv_id", "turn", F.coalesce("r2", "root").alias("root"),
                (F.col("depth") + F.coalesce("d2", F.lit(0))).alias("depth"), F.col("r2").isNotNull().alias("moved"),
            )
        )
        up = new.drop("moved")
        if new.where("moved").isEmpty():
            return up


def _copies(rows: DataFrame, order: list[str]) -> DataFrame:
    """Add rank in the order, which ends with k1 and k2, and copy: the number among the rows with its k1 and k2.

    Copies lie together in the order, and a row's place parts them, so that many are dealt over many tasks.
    """
    placed = rows.withColumn("__row", F.monotonically_increasing_id())
    numbered = settled(ranked(placed, [*order, "__row"], "rank").drop("__row"))
    firsts = numbered.groupBy("k1", "k2").agg(F.min("rank").alias("first"))
    return numbered.join(firsts, ["k1", "k2"]).withColumn("copy", F.col("rank") - F.col("first")).drop("first")


def reply_ordered(messages: DataFrame) -> DataFrame:
    """One row per message: conv_id, position, turn, role, text without quotes, n_quotes, n_linked, reply_to, thread,
    depth."""
    keyed = _keyed(messages)
    parsed = settled(_parsed(keyed))
    found = settled(links(parsed))
    first = F.min(F.when(F.col("level") == 1, F.struct("passage", "origin")))
    replies = found.groupBy("k1", "k2").agg(
        F.countDistinct("passage").cast("int").alias("n_linked"), first["origin"].alias("reply_to")
    )
    rows = settled(parsed.select("conv_id", "turn", "k1", "k2", "n_quotes").join(replies, ["k1", "k2"], "left"))
    # Of several rows with one turn, the one that replies to the latest message speaks for the turn.
    parents = rows.where("reply_to is not null").groupBy("conv_id", "turn").agg(F.max("reply_to").alias("parent"))
    threads = _threads(parents)
    ordered = rows.join(threads, ["conv_id", "turn"], "left").select(
        "conv_id", "turn", "k1", "k2", "n_quotes", F.coalesce("n_linked", F.lit(0)).alias("n_linked"), "reply_to",
        F.coalesce("root", "turn").alias("thread"), F.coalesce("depth", F.lit(0)).alias("depth"),
    )
    numbered = settled(_copies(ordered, ["conv_id", "thread", "turn", "k1", "k2"]))
    starts = numbered.groupBy("conv_id").agg(F.min("rank").alias("start"))
    same = numbered["conv_id"].eqNullSafe(starts["conv_id"])
    placed = numbered.join(starts, same).drop(starts["conv_id"])
    # Rows equal in every column have equal keys: each takes one of their places.
    spread = placed.select(
        "k1", "k2", "copy", (F.col("rank") - F.col("start")).alias("position"),
        "n_quotes", "n_linked", "reply_to", "thread", "depth",
    )

    def make():
        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            kept = [split_quotes(t)[0] for t in batch.column("text").to_pylist()]
            at = batch.schema.get_field_index("text")
            return batch.set_column(at, "text", pa.array(kept, pa.string()))

        return step

    own = keyed.mapInArrow(by_batch(make), keyed.schema)
    own = _copies(own, ["k1", "k2"]).drop("rank")
    return own.join(spread, ["k1", "k2", "copy"]).select(
        "conv_id", "position", "turn", "role", "text", "n_quotes", "n_linked", "reply_to", "thread", "depth"
    )


def op2_quote_threads(spark: SparkSession, folder: str) -> DataFrame:
    return reply_ordered(table(spark, folder, "conversations"))
