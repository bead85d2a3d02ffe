"""Contracts: rules, validation reports in two passes, enforcement.

A rule measures its violations in one of three ways: inside the single aggregation that all
such rules of a frame share (``measure``), by the numbers of rows that have a key (``keys``),
or by a grouping of its own (``query``). All rules about keys, of all frames checked together,
share one shuffle: every frame is read once, each row gives its key for each rule that asks for
one, and keys are counted by rule. A report has one row per rule: (rule, violations).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyrisk.functions.keys import normalize_area
from skyrisk.functions.scalars import all_of, any_of, is_infinite, is_missing, safe_double


class ContractError(ValueError):
    """A frame does not respect its contract; nothing has been written."""


@dataclass(frozen=True)
class Keys:
    """``broken`` gives the violations of a key that ``own`` rows of the frame and ``other`` rows
    of the parent have. Keys with a null part do not count, unless ``nulls``."""

    columns: Sequence[str]
    broken: Column
    parent: DataFrame | None = None
    parent_columns: Sequence[str] = ()
    nulls: bool = False


@dataclass(frozen=True)
class Rule:
    name: str
    measure: Column | None = None
    keys: Keys | None = None
    query: Callable[[DataFrame], DataFrame] | None = None


def require_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Fail on missing columns, from the schema alone."""
    missing = sorted(set(columns) - set(df.columns))
    if missing:
        raise ContractError(f"Missing columns: {', '.join(missing)}")
    return df


# --- Rules measured in the shared aggregation -------------------------------------------


def row_rule(name: str, broken: Column) -> Rule:
    """Counts the rows for which ``broken`` is true (null is not a violation)."""
    return Rule(name, measure=F.count_if(broken))


def not_empty() -> Rule:
    return Rule("not_empty", measure=F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))


def row_count(n: int) -> Rule:
    return Rule("row_count", measure=F.abs(F.count(F.lit(1)) - F.lit(n)))


def not_null(*columns: str) -> list[Rule]:
    return [row_rule(f"not_null:{c}", F.col(c).isNull()) for c in columns]


def not_missing(*columns: str) -> list[Rule]:
    """For doubles: NaN counts as missing."""
    return [row_rule(f"not_missing:{c}", is_missing(c)) for c in columns]


def not_blank(column: str) -> Rule:
    return row_rule(f"not_blank:{column}", F.coalesce(F.trim(F.col(column)), F.lit("")) == "")


def accepted(column: str, values: Sequence) -> Rule:
    """Null is not a violation."""
    return row_rule(f"accepted:{column}", ~F.col(column).isin(list(values)))


def whole_between(column: str, low: int, high: int) -> Rule:
    """Numeric text or number, without fraction, inside the bounds, not null."""
    number = safe_double(column)
    good = (number == F.floor(number)) & number.between(low, high)
    return row_rule(f"whole_between:{column}", ~F.coalesce(good, F.lit(False)))


def numeric(*columns: str) -> list[Rule]:
    """Text that is present but is not a number."""
    return [row_rule(f"numeric:{c}", F.col(c).isNotNull() & safe_double(c).isNull()) for c in columns]


def finite(*columns: str) -> Rule:
    return row_rule("finite", any_of([F.coalesce(is_infinite(c), F.lit(False)) for c in columns]))


def parses_as_time(column: str) -> Rule:
    return row_rule(f"timestamp:{column}", F.col(column).try_cast("timestamp").isNull())


def known_area(column: str, domain: list[str] | None = None) -> Rule:
    return row_rule(f"known_area:{column}", normalize_area(column, domain).isNull())


def on_day(column: str, day: date) -> Rule:
    return row_rule(f"on_day:{column}", ~F.to_date(F.col(column)).eqNullSafe(F.lit(day)))


def in_year(time: str, year: str) -> Rule:
    return row_rule(
        f"in_year:{time}", ~F.year(F.col(time).try_cast("timestamp")).eqNullSafe(F.col(year).cast("int"))
    )


def key_matches(key: str, expected: Column) -> Rule:
    return row_rule(f"key_matches:{key}", ~F.col(key).eqNullSafe(expected))


# --- Rules about keys -------------------------------------------------------------------


def _named(columns: Sequence[str]) -> str:
    return ",".join(columns)


def unique(*columns: str) -> Rule:
    """Counts the keys present more than once; keys with a null part are not checked."""
    return Rule(f"unique:{_named(columns)}", keys=Keys(columns, F.when(F.col("own") > 1, 1).otherwise(0)))


def references(column: str, parent: DataFrame, key: str) -> Rule:
    """Counts the rows whose non-null key has no parent row."""
    orphaned = F.when(F.col("other") == 0, F.col("own")).otherwise(0)
    return Rule(f"references:{column}", keys=Keys([column], orphaned, parent, [key]))


def same_keys(column: str, reference: DataFrame, key: str) -> Rule:
    """Counts the keys present on one side only."""
    lonely = F.when((F.col("own") > 0) != (F.col("other") > 0), 1).otherwise(0)
    return Rule(f"same_keys:{column}", keys=Keys([column], lonely, reference, [key], nulls=True))


# --- Rules with a grouping of their own -------------------------------------------------


def group_size(group: Sequence[str], member: str, n: int) -> Rule:
    """Counts the groups that do not have exactly ``n`` distinct members."""

    def query(df: DataFrame) -> DataFrame:
        groups = df.groupBy(*group).agg(F.count_distinct(member).alias("n"))
        return groups.agg(F.count_if(F.col("n") != n).alias("violations"))

    return Rule(f"group_size:{_named(group)}", query=query)


# --- Reports ----------------------------------------------------------------------------


def _key(columns: Sequence[str], nulls: bool) -> Column:
    """One text for the columns of a key; null for a key that does not count."""
    parts = [F.col(c).cast("string") for c in columns]
    if nulls:
        return F.to_json(F.array(*parts))
    return F.when(all_of([p.isNotNull() for p in parts]), parts[0] if len(parts) == 1 else F.to_json(F.array(*parts)))


def _tagged(df: DataFrame, asked: Sequence[tuple[int, Sequence[str], bool, bool]]) -> DataFrame:
    """(rule, key, own, other): what each row adds to each rule that asks this frame for a key.
    Keys travel as the 16 bytes of their MD5, however long they are."""
    items = [
        F.struct(
            F.lit(i).alias("rule"), F.unhex(F.md5(_key(columns, nulls))).alias("key"),
            F.lit(int(own)).cast("long").alias("own"), F.lit(int(not own)).cast("long").alias("other"),
        )
        for i, columns, own, nulls in asked
    ]
    return df.select(F.inline(F.array(*items))).where(F.col("key").isNotNull())


def _counted(frames: Sequence[DataFrame], rules: Sequence[tuple[int, str, Rule]]) -> DataFrame:
    """Reports of rules about keys: (frame number, table, rule) each. A parent that is itself
    among the frames is read once for all its parts."""
    asked: dict[int, tuple[DataFrame, list]] = {id(f): (f, []) for f in frames}
    for i, (at, _, rule) in enumerate(rules):
        k = rule.keys
        asked[id(frames[at])][1].append((i, k.columns, True, k.nulls))
        if k.parent is not None:
            asked.setdefault(id(k.parent), (k.parent, []))[1].append((i, k.parent_columns, False, k.nulls))
    rows = reduce(DataFrame.unionByName, [_tagged(df, wanted) for df, wanted in asked.values() if wanted])
    keys = rows.groupBy("rule", "key").agg(F.sum("own").alias("own"), F.sum("other").alias("other"))
    totals = keys.agg(*[F.sum(F.when(F.col("rule") == i, r.keys.broken).otherwise(0)).alias(f"_{i}") for i, (_, _, r) in enumerate(rules)])
    return _listed(totals, [(table, r.name) for _, table, r in rules])


def _listed(totals: DataFrame, named: Sequence[tuple[str, str]]) -> DataFrame:
    rows = [
        F.struct(F.lit(table).alias("table"), F.lit(rule).alias("rule"), F.coalesce(F.col(f"_{i}"), F.lit(0)).cast("long").alias("violations"))
        for i, (table, rule) in enumerate(named)
    ]
    return totals.select(F.inline(F.array(*rows)))


def validate_all(checks: Mapping[str, tuple[DataFrame, Iterable[Rule]]]) -> DataFrame:
    """Report (table, rule, violations) over several frames: one pass over each for its rows,
    and one over all of them, with one shuffle, for their keys."""
    reports, frames, keyed = [], [], []
    for table, (df, given) in checks.items():
        rules = list(given)
        measured = [r for r in rules if r.measure is not None]
        if measured:
            totals = df.agg(*[r.measure.cast("long").alias(f"_{i}") for i, r in enumerate(measured)])
            reports.append(_listed(totals, [(table, r.name) for r in measured]))
        for r in rules:
            if r.query is not None:
                reports.append(_listed(r.query(df).withColumnRenamed("violations", "_0"), [(table, r.name)]))
            elif r.keys is not None:
                keyed.append((len(frames), table, r))
        frames.append(df)
    if keyed:
        reports.append(_counted(frames, keyed))
    return reduce(DataFrame.unionByName, reports)


def validate(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Report (rule, violations) of one frame."""
    return validate_all({"": (df, rules)}).drop("table")


def enforce(report: DataFrame) -> None:
    """Raise with the broken rules. The report has one row per rule."""
    broken = report.where("violations > 0").orderBy("rule").collect()
    if broken:
        raise ContractError("; ".join(f"{r['rule']} ({r['violations']})" for r in broken))


def check(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Enforce the rules and return the frame unchanged."""
    enforce(validate(df, rules))
    return df
