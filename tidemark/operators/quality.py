"""Data quality: every check is a boolean column, every count comes from one aggregate."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.moments import moment
from tidemark.functions.numbers import NUMBER_PATTERN, is_number
from tidemark.functions.text import is_blank
from tidemark.session import settled

POSITION = "_position"
#: The text of a record that could not be parsed; a frame may have it as a column.
BAD = "_bad_record"


def named(column: str) -> Column:
    """A column by its whole name, which may hold dots."""
    return F.col(f"`{column}`")


REASON = "reject_reason"


def _by_key(df: DataFrame, keys: list[str]):
    return df.groupBy(*[named(k).alias(f"_key{i}") for i, k in enumerate(keys)])


def surplus(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row: how many rows come after the first of their key. NULL keys equal each other.

    Only the keys are shuffled, combined beforehand, so a key holding a third of all rows is no burden.
    """
    copies = _by_key(df, keys).agg(F.count(F.lit(1)).alias("copies"))
    return copies.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("surplus"))


def flag_repeats(df: DataFrame, keys: list[str], order_by: list[str], flag: str) -> DataFrame:
    """Add `flag`: true on every row of a key but its first by `order_by`, which must tell any two rows apart.

    One aggregate gives each key's copies and first place, combined before its shuffle; the repeated keys are
    written once and joined. Knowing their size, Spark broadcasts them or splits the skewed partitions of the join.
    """
    place = F.struct(*[named(c) for c in order_by])
    counted = _by_key(df, keys).agg(F.count(F.lit(1)).alias("_copies"), F.min(place).alias("_first"))
    repeats = settled(counted.where("_copies > 1").drop("_copies"))
    same = reduce(and_, [named(k).eqNullSafe(F.col(f"_key{i}")) for i, k in enumerate(keys)])
    names = [f"_key{i}" for i in range(len(keys))]
    return (
        df.join(repeats, same, "left")
        .withColumn(flag, F.col("_first").isNotNull() & (place > F.col("_first")))
        .drop("_first", *names)
    )


@dataclass(frozen=True)
class Check:
    """One rule: which rows fail it, and how the outcome is worded."""

    name: str
    kind: str
    column: str
    severity: str
    failing: Column | None = None  # None for a repeat check and for the row count
    keys: tuple[str, ...] = ()
    min_rows: int | None = None
    observed: str = "{} failures"
    expected: str = ""
    reason: str | None = None  # set on checks that may reject a row

    @property
    def rejects(self) -> bool:
        return self.reason is not None and self.severity == "ERROR"


class Validator:
    """Collects checks on a frame, then gives result rows and the valid and rejected parts.

    `order_by` decides which copy of a repeated key is the first, and then the `_position` column, which
    the readers give. A frame without positions gets row numbers and is settled on shared storage.
    """

    def __init__(self, df: DataFrame, table: str, batch_id: str, order_by: list[str] | None = None):
        self.table, self.batch_id = table, batch_id
        self.checks: list[Check] = []
        self._df = df
        self.columns = [c for c in df.columns if c != POSITION]
        self._order_by = order_by or []
        self._marked: DataFrame | None = None

    def _text(self, name: str) -> bool:
        return isinstance(self._df.schema[name].dataType, (T.StringType, T.CharType, T.VarcharType))

    def _add(self, check: Check) -> Validator:
        self.checks.append(check)
        self._marked = None
        return self

    def check_nulls(self, columns: Iterable[str], severity: str = "ERROR") -> Validator:
        """NULL or blank text fails; an ERROR rejects the row. Columns the frame lacks are skipped."""
        for name in columns:
            if name in self.columns:
                c = named(name)
                failing = is_blank(c) if self._text(name) else c.isNull()
                self._add(
                    Check(
                        f"null_check_{name}", "null_check", name, severity, failing,
                        observed="{} nulls", expected="0 nulls", reason=f"NULL in {name}; ",
                    )
                )
        return self

    def check_parsed(self) -> Validator:
        """A record that could not be parsed is rejected; its text is in the row. Frames without such texts are skipped."""
        if BAD in self.columns:
            self._add(
                Check(
                    "parse_check", "parse_check", "", "ERROR", named(BAD).isNotNull(),
                    observed="{} unparseable", expected="0 unparseable", reason="Unparseable record; ",
                )
            )
        return self

    def check_unique(self, columns: Iterable[str], severity: str = "ERROR") -> Validator:
        """Every row of a key but the first fails; an ERROR rejects it."""
        keys = tuple(columns)
        label = ", ".join(keys)
        return self._add(
            Check(
                f"unique_check_{label}", "pk_check", label, severity, keys=keys,
                observed="{} duplicates", expected="0 duplicates", reason=f"Duplicate on {label}; ",
            )
        )

    def check_numeric(self, columns: Iterable[str], severity: str = "WARNING") -> Validator:
        """Values that are not numbers are counted, never rejected."""
        for name in columns:
            if name in self.columns:
                c = named(name)
                failing = c.isNotNull() & ~is_number(c) if self._text(name) else F.lit(False)
                self._add(
                    Check(
                        f"type_check_{name}", "type_check", name, severity, failing,
                        observed="{} non-numeric values", expected="all numeric",
                    )
                )
        return self

    def check_value_in_set(self, column: str, values: Iterable[str], severity: str = "WARNING") -> Validator:
        """Values outside a set are counted, never rejected."""
        allowed = list(values)
        if column not in self.columns:
            return self
        c = named(column)
        return self._add(
            Check(
                f"domain_check_{column}", "domain_check", column, severity, c.isNotNull() & ~c.isin(allowed),
                observed="{} out-of-domain values", expected=f"values in {allowed}",
            )
        )

    def check_min_rows(self, min_rows: int, severity: str = "ERROR") -> Validator:
        """The frame has at least this many rows."""
        return self._add(
            Check(
                "min_row_count", "count_check", "*", severity, min_rows=min_rows,
                observed="{}", expected=f">= {min_rows}",
            )
        )

    def check_lengths(self, limits: dict[str, int], severity: str = "WARNING") -> Validator:
        """Text longer than the target column allows is counted; an ERROR rejects the row."""
        for name, limit in limits.items():
            if name in self.columns:
                failing = F.coalesce(F.length(named(name)) > limit, F.lit(False))
                self._add(
                    Check(
                        f"length_check_{name}", "limit_check", name, severity, failing,
                        observed="{} too long", expected=f"at most {limit} characters", reason=f"Too long: {name}; ",
                    )
                )
        return self

    def check_precision(self, limits: dict[str, tuple[int, int]], severity: str = "WARNING") -> Validator:
        """Numbers that do not fit the target decimal are counted; an ERROR rejects the row. Text that is no
        number at all counts as well, but rejects nothing: that is for `check_numeric` to report."""
        for name, (precision, scale) in limits.items():
            if name in self.columns:
                c = named(name)
                failing = c.isNotNull() & c.try_cast(f"decimal({precision},{scale})").isNull()
                if severity == "ERROR" and self._text(name):
                    # As it is written: also a number beyond a double is one that the column can't hold. The pattern
                    # comes first, as a failed cast raises and catches an exception.
                    failing = F.coalesce(c.rlike(NUMBER_PATTERN), F.lit(False)) & failing
                self._add(
                    Check(
                        f"precision_check_{name}", "limit_check", name, severity, failing,
                        observed="{} out of range", expected=f"decimal({precision},{scale})",
                        reason=f"Out of range: {name}; ",
                    )
                )
        return self

    def check_computed(
        self, name: str, value: Column, precision: int, scale: int, severity: str = "ERROR"
    ) -> Validator:
        """A value computed from the row fits the decimal it will be kept in."""
        failing = F.coalesce(value.isNotNull() & value.try_cast(f"decimal({precision},{scale})").isNull(), F.lit(False))
        return self._add(
            Check(
                f"precision_check_{name}", "limit_check", name, severity, failing,
                observed="{} out of range", expected=f"decimal({precision},{scale})", reason=f"Out of range: {name}; ",
            )
        )

    def _flag(self, i: int) -> str:
        return f"_fails{i}"

    def _plain(self) -> dict[str, Column]:
        """The checks on single rows that the frame has no outcome of yet."""
        flags = {self._flag(i): c.failing for i, c in enumerate(self.checks) if c.failing is not None}
        return {name: failing for name, failing in flags.items() if name not in self._df.columns}

    def staged(self, write: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Have the frame written with the outcomes of all checks on single rows, and go on with what was written: no
        later pass works a check out again. No check may be added after it."""
        self._df, self._marked = write(self._df.withColumns(self._plain())), None
        return self._df

    def marked(self) -> DataFrame:
        """The frame with one boolean column per check on rows."""
        if self._marked is None:
            unique = [(i, c) for i, c in enumerate(self.checks) if c.keys]
            if unique and POSITION not in self._df.columns:
                # Whatever the order, equal rows must be told apart.
                self._df = settled(self._df.withColumn(POSITION, F.monotonically_increasing_id()))
            df = self._df
            order_by = self._order_by + [c for c in [POSITION] if c in df.columns]
            for i, check in unique:
                df = flag_repeats(df, list(check.keys), order_by, self._flag(i))
            self._marked = df.withColumns(self._plain()) if self._plain() else df
        return self._marked

    def _rejecting(self) -> list[tuple[int, Check]]:
        return [(i, c) for i, c in enumerate(self.checks) if c.rejects]

    def is_rejected(self) -> Column:
        return reduce(or_, [F.col(self._flag(i)) for i, _ in self._rejecting()], F.lit(False))

    def valid(self) -> DataFrame:
        return self.marked().where(~self.is_rejected()).select(*[named(c) for c in self.columns])

    def rejected(self) -> DataFrame:
        """The rejected rows with their reasons, in the order of the checks."""
        reasons = [F.when(F.col(self._flag(i)), F.lit(c.reason)).otherwise("") for i, c in self._rejecting()]
        reason = F.concat(F.lit(""), *reasons)
        kept = [named(c) for c in self.columns if c != REASON]
        return self.marked().where(self.is_rejected()).select(*kept, reason.alias(REASON))

    def finalize(self) -> tuple[DataFrame, DataFrame]:
        return self.valid(), self.rejected()

    def count_columns(self, checks: list[int] | None = None) -> list[Column]:
        """Aggregates over the marked frame, of all checks at once or of some."""
        columns = [F.count(F.lit(1)).alias("total")]
        for i, check in enumerate(self.checks):
            if check.min_rows is None and (checks is None or i in checks):
                columns.append(F.count_if(F.col(self._flag(i))).alias(f"failed{i}"))
        return columns

    def results(self, run_ts: datetime, counts: DataFrame | None = None) -> DataFrame:
        """One row per check, from a single pass over the frame and an aggregate for each key that must be unique,
        or from counts already taken."""
        if counts is None:
            plain = self._plain()
            rows = [i for i, c in enumerate(self.checks) if c.failing is not None]
            counts = (self._df.withColumns(plain) if plain else self._df).agg(*self.count_columns(rows))
            for i, check in enumerate(self.checks):
                if check.keys:
                    one = surplus(self._df, list(check.keys)).withColumnRenamed("surplus", f"failed{i}")
                    counts = counts.crossJoin(F.broadcast(one))  # one row beside one row
        total = F.col("total")
        rows = []
        for i, check in enumerate(self.checks):
            if check.min_rows is None:
                failed = observed = F.coalesce(F.col(f"failed{i}"), F.lit(0))
            else:
                failed, observed = F.when(total < check.min_rows, 1).otherwise(0), total
            rows.append(_result_row(check, failed.cast("bigint"), total, observed))
        if not rows:
            rows = [_result_row(Check("", "", "", ""), total, total, total)]
            counts = counts.where(F.lit(False))
        return counts.select(F.explode(F.array(*rows)).alias("r")).select(
            F.lit(self.batch_id).alias("batch_id"),
            F.lit(self.table).alias("table_name"),
            "r.*",
            moment(run_ts).alias("checked_at"),
        )


def _result_row(check: Check, failed: Column, total: Column, observed: Column) -> Column:
    before, after = check.observed.split("{}")
    whole = F.greatest(total, F.lit(1)).cast("decimal(19,0)")
    share = (total - failed).cast("decimal(19,0)") * 100 / whole
    return F.struct(
        F.lit(check.name).alias("check_name"),
        F.lit(check.kind).alias("check_type"),
        F.lit(check.column).alias("column_name"),
        (failed == 0).alias("passed"),
        total.alias("total_records"),
        failed.alias("failed_records"),
        F.round(share, 3).cast("decimal(6,3)").alias("success_pct"),
        F.concat(F.lit(before), observed.cast("string"), F.lit(after)).alias("observed_value"),
        F.lit(check.expected).alias("expected_value"),
        F.lit(check.severity).alias("severity"),
    )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once; none means the key is unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def repeated_current_keys(dimension: DataFrame, key: str) -> DataFrame:
    """Keys with more than one current version."""
    return repeated_keys(dimension.where("is_current"), [key])


def orphan_keys(fact: DataFrame, relations: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Non-NULL keys of a fact that their dimension lacks, with the number of rows that use them.

    `relations` gives, for each key of the fact, the dimension and the column it points to. The keys of all
    relations are stacked and counted together, so the fact is read and shuffled once and the counts, each key
    once however often it occurs, meet all dimensions in one join.
    """
    keys = [F.struct(F.lit(name).alias("key_name"), F.col(name).cast("bigint").alias("key")) for name in relations]
    used = fact.select(F.explode(F.array(*keys)).alias("k")).select("k.*").where("key IS NOT NULL")
    used = used.groupBy("key_name", "key").agg(F.count(F.lit(1)).alias("rows"))
    known = [
        dimension.select(F.lit(name).alias("key_name"), F.col(column).cast("bigint").alias("key"))
        for name, (dimension, column) in relations.items()
    ]
    return used.join(reduce(DataFrame.unionByName, known), ["key_name", "key"], "left_anti")
