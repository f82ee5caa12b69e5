"""Records that do not end with the line, cut by many tasks out of one file.

A file is read in pieces, up to each separator, by as many tasks as it has byte ranges. Whether a piece begins
inside quotes, and how deep in brackets, depends on all before it. So each piece says what it does to either case,
running sums over a range say what the range does, and the ranges of a file, which are few, are then chained: that
gives each range, and with the running sums each piece, its true state. A record is the pieces from one that
begins at the level of records to one that ends there. Most are a single piece and are passed on as they are;
only the others are grouped.

The pieces are sorted once by range and settled with their running sums; what a task holds is one byte range
(`spark.sql.files.maxPartitionBytes`) or one record.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tidemark.operators.quality import POSITION
from tidemark.session import settled
from tidemark.sources.position import opened

RECORD = "_record"
RANGE = ["_file", "_block"]


@dataclass(frozen=True)
class Effect:
    """What a piece does: whether it ends inside quotes and by how much it goes deeper, if it begins outside
    quotes and if it begins inside them."""

    quoted: tuple[Column, Column]
    deeper: tuple[Column, Column]


@dataclass(frozen=True)
class Layout:
    """How a file's records are laid out: what parts its pieces, what each of them does, and at which level, a column
    that may use the file's first character `_first._lead`, the records are."""

    separator: str
    effect: Effect
    level: Column
    kept: bool = False  # the separator belongs to the text before it
    separator_closes: bool = False  # it closes a bracket
    first_begins: bool = True  # a file's first piece begins a record even if it begins above their level


def pieces(spark: SparkSession, path: str, separator: str, encoding: str = "utf-8") -> DataFrame:
    """The file cut after each separator, with the place of each piece."""
    raw = opened(lambda: spark.read.option("lineSep", separator).text(path), path)
    value = F.col("value") if encoding.lower() in ("utf-8", "utf8") else F.decode(F.col("value").cast("binary"), encoding)
    return raw.select(
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
        value.alias("_text"),
        (F.octet_length("value") + 1).alias("_bytes"),
        F.col("_metadata.file_size").alias("_size"),
    )


def _running(found: DataFrame, effect: Effect) -> DataFrame:
    """For both cases of the range's start (0: outside quotes, 1: inside): whether each piece begins (`_was`) and
    ends (`_in`) inside quotes, how much deeper it goes (`_step`), and the sum of that so far (`_deep`)."""
    to = W.partitionBy(*RANGE).orderBy("_row")
    found = found.withColumns({"_q0": effect.quoted[0], "_q1": effect.quoted[1], "_d0": effect.deeper[0], "_d1": effect.deeper[1]})
    turns = (F.col("_q0") & ~F.col("_q1")).cast("int")
    found = found.withColumn("_turns", F.sum(turns).over(to))
    # The last piece that ends the same way whatever came before it, and how often the state has turned since.
    fixed = F.when(F.col("_q0") == F.col("_q1"), F.struct("_q0", "_turns"))
    found = found.withColumn("_last", F.last(fixed, ignorenulls=True).over(to))
    known = F.col("_last._q0") != ((F.col("_turns") - F.col("_last._turns")) % 2 == 1)
    odd = F.col("_turns") % 2 == 1
    for case, unknown in ((0, odd), (1, ~odd)):
        found = found.withColumn(f"_in{case}", F.when(F.col("_last").isNull(), unknown).otherwise(known))
        found = found.withColumn(f"_was{case}", F.coalesce(F.lag(f"_in{case}").over(to), F.lit(bool(case))))
        found = found.withColumn(f"_step{case}", F.when(F.col(f"_was{case}"), F.col("_d1")).otherwise(F.col("_d0")))
        found = found.withColumn(f"_deep{case}", F.sum(f"_step{case}").over(to))
    states = [f"_{name}{case}" for name in ("was", "in", "step", "deep") for case in (0, 1)]
    return found.select(*RANGE, "_row", "_text", "_bytes", "_size", *states)


def _starts(found: DataFrame) -> DataFrame:
    """For each range, whether it begins inside quotes (`_inside`) and how deep (`_depth`). Of its file: whether it
    ends inside quotes and how deep, whether a separator ends it, and its first piece that is not blank.

    The fold runs over the ranges of a file: one entry for each `maxPartitionBytes`.
    """
    state = F.struct(*[f"_{name}{case}" for name in ("in", "deep") for case in (0, 1)])
    shown = F.regexp_extract("_text", r"[^\s\uFEFF]", 0)
    lead = F.when(shown != "", F.struct("_block", "_row", shown.alias("_lead")))
    ranges = found.groupBy(*RANGE).agg(
        F.max_by(state, "_row").alias("_s"), F.min(lead).alias("_first"), F.sum("_bytes").alias("_bytes"), F.max("_size").alias("_size")
    )
    files = ranges.groupBy("_file").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_s"))).alias("_ranges"),
        F.min("_first").alias("_first"),
        # Each piece counts one byte for its separator: a file that ends without one seems a byte too long.
        (F.sum("_bytes") == F.max("_size")).alias("_closed"),
    )
    at = "struct<_block: bigint, _inside: boolean, _depth: bigint>"
    begin = F.struct(
        F.lit(False).alias("inside"), F.lit(0).cast("bigint").alias("depth"), F.array().cast(f"array<{at}>").alias("at")
    )

    def step(known: Column, entry: Column) -> Column:
        s, place = entry["_s"], F.struct(entry["_block"], known["inside"], known["depth"]).cast(at)
        return F.struct(
            F.when(known["inside"], s["_in1"]).otherwise(s["_in0"]).alias("inside"),
            (known["depth"] + F.when(known["inside"], s["_deep1"]).otherwise(s["_deep0"])).alias("depth"),
            F.concat(known["at"], F.array(place)).alias("at"),
        )

    folded = files.select("_file", "_first", "_closed", F.aggregate("_ranges", begin, step).alias("_f"))
    ends = [F.col("_f.inside").alias("_open"), F.col("_f.depth").alias("_end")]
    return folded.select("_file", "_first", "_closed", *ends, F.inline("_f.at"))


def records(found: DataFrame, layout: Layout) -> DataFrame:
    """Whole records as text, `_record`, with the place of their first piece in `_position` and, as `_heads`, whether
    they begin with their file's first piece.

    A file that ends inside quotes or brackets is an error: it was cut off, or has a quote too many.
    """
    separator, ending = layout.separator, layout.separator if layout.kept else ""
    found = settled(_running(found, layout.effect))
    starts = settled(_starts(found))
    level = layout.level
    # Without a separator at its end, the last piece was counted as a level up all the same.
    end = F.col("_end") + F.when(F.col("_closed"), 0).otherwise(1 if layout.separator_closes else 0)
    broken = starts.where(F.col("_open") | (end != 0)).select("_file").first()
    if broken:
        raise ValueError(f"{broken['_file']} ends inside a record")

    def true(name: str) -> Column:
        return F.when(F.col("_inside"), F.col(f"_{name}1")).otherwise(F.col(f"_{name}0"))

    after = F.col("_depth") + true("deep")
    at_first = (F.col("_block") == F.col("_first._block")) & (F.col("_row") == F.col("_first._row"))
    placed = found.join(starts, RANGE).select(
        *RANGE, "_row", "_text",
        (~true("was") & ((after - true("step") == level) | (at_first & F.lit(layout.first_begins)))).alias("_begins"),
        (~true("in") & (after == level)).alias("_ends"),
        at_first.alias("_heads"),
    )
    alone = F.col("_begins") & F.col("_ends")
    place = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row")).alias(POSITION)
    whole = placed.where(alone).select(place, F.concat("_text", F.lit(ending)).alias(RECORD), "_heads")

    # The others go to the last piece that begins a record: in their range, or in one before it.
    within = W.partitionBy(*RANGE).orderBy("_row")
    own = F.last(F.when(F.col("_begins"), F.struct("_block", "_row")), ignorenulls=True).over(within)
    parts = placed.where(~alone).withColumn("_own", own)
    earlier = W.partitionBy("_file").orderBy("_block").rowsBetween(W.unboundedPreceding, -1)  # a row per range
    last = placed.groupBy(*RANGE).agg(F.max(F.when(F.col("_begins"), F.struct("_block", "_row"))).alias("_begun"))
    carried = last.select(*RANGE, F.last("_begun", ignorenulls=True).over(earlier).alias("_carried"))
    parts = parts.join(carried, RANGE, "left").withColumn("_key", F.coalesce("_own", "_carried"))
    parts = parts.where("_key IS NOT NULL")  # what is before the first record is no part of one
    grouped = parts.groupBy("_file", "_key").agg(
        F.array_sort(F.collect_list(F.struct("_block", "_row", "_text"))).alias("_parts"),
        F.max("_ends").alias("_ended"),
        F.max("_heads").alias("_heads"),
    )
    place = F.struct(F.col("_file").alias("file"), F.col("_key._block").alias("block"), F.col("_key._row").alias("row")).alias(POSITION)
    text = F.concat(F.array_join(F.transform("_parts", lambda p: p["_text"]), separator), F.lit(ending))
    # What follows the last record, a bracket or a line end, begins nothing that ends.
    return whole.unionByName(grouped.where("_ended").select(place, text.alias(RECORD), "_heads"))


def csv_layout() -> Layout:
    """Lines. A quote opens a field only at its beginning; inside, two quotes are one in the text."""
    value, none = F.col("_text"), F.lit(0).cast("bigint")
    parts, has = F.split(value, '"'), value.contains('"')
    start, plain, inside, after = F.lit(0), F.lit(1), F.lit(2), F.lit(3)

    def ends_in_quotes(at: Column) -> Column:
        def step(state: Column, part: Column) -> Column:
            opens = part.endswith(",") | ((state == 0) & (part == ""))
            doubled = (state == 3) & (part == "")
            return F.when(state == 2, after).when(doubled | opens, inside).otherwise(plain)

        return F.aggregate(F.slice(parts, 1, F.size(parts) - 1), at, step) == 2

    quoted = (F.when(has, ends_in_quotes(start)).otherwise(False), F.when(has, ends_in_quotes(inside)).otherwise(True))
    return Layout("\n", Effect(quoted, (none, none)), F.lit(0))


def json_layout() -> Layout:
    """Pieces up to a closing brace. The records of a list are one level deep, a single object is at none."""
    parts = F.split(F.regexp_replace("_text", r"(?s)\\.", ""), '"')
    turned = (F.size(parts) - 1) % 2 == 1

    def deeper(first: int, ends_outside: Column) -> Column:
        plain = F.array_join(F.filter(parts, lambda _, i: i % 2 == first), "")
        opened_, closed = (F.length(F.regexp_replace(plain, other, "")) for other in (r"[^{\[]", r"[^}\]]"))
        return (opened_ - closed - F.when(ends_outside, 1).otherwise(0)).cast("bigint")

    effect = Effect((turned, ~turned), (deeper(0, ~turned), deeper(1, turned)))
    level = F.when(F.col("_first._lead") == "[", 1).otherwise(0)
    return Layout("}", effect, level, kept=True, separator_closes=True)


def xml_layout() -> Layout:
    """Pieces up to the end of a tag; comments and CDATA sections count as quotes. Records are the root's children.

    A section is taken to end with the first `--` or `]]` before an angle bracket. Where that is the other kind's
    end, or an attribute holds a bare closing bracket, the tags don't add up and the file is an error.
    """
    text = F.col("_text")
    tag = F.regexp_extract(text, r"(?s)<(.*)", 1)
    comment, section = tag.startswith("!--"), tag.startswith("![CDATA[")
    closes = text.endswith("--") | text.endswith("]]")
    whole = F.when(comment, tag.endswith("--") & (F.length(tag) >= 5)).when(section, tag.endswith("]]"))
    single = tag.startswith("!") | tag.startswith("?") | tag.endswith("/") | (tag == "")
    step = F.when(single, 0).when(tag.startswith("/"), -1).otherwise(1).cast("bigint")
    effect = Effect((~F.coalesce(whole, F.lit(True)), ~closes), (step, F.lit(0).cast("bigint")))
    return Layout(">", effect, F.lit(1), kept=True, first_begins=False)
