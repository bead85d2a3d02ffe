"""Profiles and distributions computed in one aggregation each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyrisk.functions.scalars import all_of, is_missing, round_even2


def count_rows() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def all_complete(columns: Sequence[str]) -> Column:
    """True when every row of the group has all the columns."""
    return F.count_if(all_of([F.col(c).isNotNull() for c in columns])) == count_rows()


def share_where(condition: Column) -> Column:
    """Percentage of rows where the condition holds; a null condition counts as false."""
    return F.count_if(condition) / count_rows() * F.lit(100.0)


def null_profile(df: DataFrame) -> DataFrame:
    """Missing count and percentage of each column, most incomplete first."""
    doubles = {f.name for f in df.schema if f.dataType.typeName() in ("double", "float")}
    missing = [is_missing(c) if c in doubles else F.col(c).isNull() for c in df.columns]
    totals = df.agg(
        count_rows().alias("_rows"), *[F.count_if(m).alias(f"_{i}") for i, m in enumerate(missing)]
    )
    rows = [
        F.struct(F.lit(name).alias("colonne"), F.col(f"_{i}").alias("valeurs_manquantes"))
        for i, name in enumerate(df.columns)
    ]
    return (
        totals.select("_rows", F.inline(F.array(*rows)))
        .select(
            "colonne",
            "valeurs_manquantes",
            round_even2(F.try_divide(F.col("valeurs_manquantes"), F.col("_rows")) * 100.0).alias("pourcentage"),
        )
        .orderBy(F.col("pourcentage").desc(), "colonne")
    )


def duplicate_count(df: DataFrame, key: str, name: str = "doublons") -> DataFrame:
    """Rows beyond the first of each key; null is one key value."""
    distinct = F.count_distinct(key) + F.max(F.col(key).isNull().cast("long"))
    return df.agg((count_rows() - F.coalesce(distinct, F.lit(0))).alias(name))


def domain_counts(df: DataFrame, column: str, domain: Sequence, name: str = "n") -> DataFrame:
    """(value, n, total of known values) for each value of a small fixed domain."""
    totals = df.agg(
        F.count(column).alias("total"),
        *[F.count_if(F.col(column) == F.lit(v)).alias(f"_{i}") for i, v in enumerate(domain)],
    )
    rows = [
        F.struct(F.lit(v).cast("long").alias(column), F.col(f"_{i}").alias(name))
        for i, v in enumerate(domain)
    ]
    return totals.select("total", F.inline(F.array(*rows)))


def distribution(
    df: DataFrame, column: str, domain: Sequence, labels: Mapping | None = None
) -> DataFrame:
    """Share of each value of the domain in percent, absent values as 0."""
    counts = domain_counts(df, column, domain)
    label = F.lit(None).cast("string")
    for value, text in (labels or {}).items():
        label = F.when(F.col(column) == F.lit(value), F.lit(text)).otherwise(label)
    share = round_even2(F.coalesce(F.try_divide(F.col("n"), F.col("total")), F.lit(0.0)) * 100.0)
    extra = [label.alias("libelle")] if labels else []
    return counts.select(column, *extra, share.alias("pourcentage")).orderBy(column)


def crosstab_pct(
    df: DataFrame, row: str, column: str, row_domain: Sequence, column_domain: Sequence[str]
) -> DataFrame:
    """Row-domain x column-domain table whose columns each sum to 100."""
    known = F.col(row).isNotNull()
    cells = {
        (r, c): F.count_if((F.col(row) == F.lit(r)) & (F.col(column) == F.lit(c)))
        for r in row_domain
        for c in column_domain
    }
    totals = df.agg(
        *[F.count_if(known & (F.col(column) == F.lit(c))).alias(f"_t{c}") for c in column_domain],
        *[cell.alias(f"_{r}{c}") for (r, c), cell in cells.items()],
    )
    rows = [
        F.struct(
            F.lit(r).cast("long").alias(row),
            *[
                round_even2(
                    F.coalesce(F.try_divide(F.col(f"_{r}{c}"), F.col(f"_t{c}")), F.lit(0.0)) * 100.0
                ).alias(c)
                for c in column_domain
            ],
        )
        for r in row_domain
    ]
    return totals.select(F.inline(F.array(*rows))).orderBy(row)


def coverage(df: DataFrame, keys: list[str], member: str, name: str) -> DataFrame:
    """Groups (null keys aside) that do not have every member met in the whole frame."""
    total = df.agg(F.count_distinct(member)).scalar()
    counts = df.dropna(subset=keys).groupBy(*keys).agg(F.count_distinct(member).alias(name))
    return counts.where(F.col(name) != total)


MIDDLE_ROWS = 100_000  # rows around a median that one task may rank


def medians(df: DataFrame, columns: Sequence[str], spread: float = 0.001) -> dict[str, float]:
    """Exact medians of several columns without gathering any column in one place.

    Approximate quantiles just below and above the middle bound each median, and are taken
    again between the bounds until at most ``MIDDLE_ROWS`` rows, or one value, lie there.
    The rows below the lower bound are counted, and only the values between the bounds,
    counted by value, are ranked. Nulls and NaN are ignored; a column without values gives
    no entry. The columns are persisted for the passes.
    """
    clean = df.select(*[F.when(~is_missing(c), F.col(c).cast("double")).alias(c) for c in columns]).persist()
    try:
        return _medians(clean, columns, spread)
    finally:
        clean.unpersist()


def _medians(clean: DataFrame, columns: Sequence[str], spread: float) -> dict[str, float]:
    around = F.array(F.lit(0.5 - spread), F.lit(0.5 + spread))
    bounds = clean.agg(
        *[F.count(c).alias(f"n_{c}") for c in columns],
        *[F.percentile_approx(c, around, 10_000).alias(f"q_{c}") for c in columns],
    ).first()
    present = [c for c in columns if bounds[f"n_{c}"]]
    if not present:
        return {}
    edges = {c: tuple(bounds[f"q_{c}"]) for c in present}
    below, wide = {}, present
    while wide:
        seen = clean.agg(
            *[F.count_if(F.col(c) < edges[c][0]).alias(f"b_{c}") for c in wide],
            *[F.count_if(F.col(c).between(*edges[c])).alias(f"i_{c}") for c in wide],
        ).first()
        below |= {c: seen[f"b_{c}"] for c in wide}
        wide = [c for c in wide if seen[f"i_{c}"] > MIDDLE_ROWS and edges[c][0] < edges[c][1]]
        if wide:
            # Where the middle ranks lie between the bounds, and a little to either side.
            at = {c: ((bounds[f"n_{c}"] + 1) / 2 - below[c]) / seen[f"i_{c}"] for c in wide}
            near = clean.agg(
                *[
                    F.percentile_approx(
                        F.when(F.col(c).between(*edges[c]), F.col(c)),
                        F.array(F.lit(max(0.0, at[c] - 2 * spread)), F.lit(min(1.0, at[c] + 2 * spread))),
                        10_000,
                    ).alias(c)
                    for c in wide
                ]
            ).first()
            wide = [c for c in wide if tuple(near[c]) != edges[c]]
            edges |= {c: tuple(near[c]) for c in wide}
    # One small row per column: its rank offset and its number of values.
    middle_values = [
        F.struct(
            F.lit(c).alias("name"),
            F.when(F.col(c).between(*edges[c]), F.col(c)).alias("value"),
            F.lit(below[c]).alias("before"),
            F.lit(bounds[f"n_{c}"]).alias("total"),
        )
        for c in present
    ]
    running = Window.partitionBy("name").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    ranked = (
        clean.select(F.inline(F.array(*middle_values)))
        .where(F.col("value").isNotNull())
        .groupBy("name", "value", "before", "total")
        .agg(count_rows().alias("n"))
        .withColumn("last", F.sum("n").over(running) + F.col("before"))
        .withColumn("first", F.col("last") - F.col("n") + 1)
    )
    low_rank, high_rank = F.floor((F.col("total") + 1) / 2), F.floor(F.col("total") / 2) + 1
    found = ranked.groupBy("name").agg(
        F.max(F.when(F.col("first") <= low_rank, F.col("value"))).alias("low"),
        F.max(F.when(F.col("first") <= high_rank, F.col("value"))).alias("high"),
    )
    return {r["name"]: (r["low"] + r["high"]) / 2.0 for r in found.collect()}


def count_apart(df: DataFrame, by: list[str], plain: list[Column], distinct: dict[str, Column]) -> DataFrame:
    """Aggregates of groups with several distinct counts, without multiplying the rows.

    Together, distinct counts make Spark send every row once per counted column. Apart, each
    column is pruned and deduplicated before its shuffle, and the parts, one row per group,
    are put side by side by one more grouping, which keeps a null group.
    """
    parts = [df.groupBy(*by).agg(*plain)]
    for name, column in distinct.items():
        pairs = df.select(*by, column.alias(name)).distinct()
        parts.append(pairs.groupBy(*by).agg(F.count(name).alias(name)))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return every.groupBy(*by).agg(*[F.max(c).alias(c) for c in every.columns if c not in by])
