"""Descriptive reports: exclusion counts, cross tabulation, missing-data profile.

Each report is one distributed aggregation; only its few result rows are
small enough to show or collect.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinframe.session import store


def _stack(pairs: list[tuple[str, str]], name_col: str, value_col: str) -> F.Column:
    """``stack(n, 'a', a, 'b', b, ...)`` as a generator expression."""
    args = ", ".join(f"'{label}', `{column}`" for label, column in pairs)
    return F.expr(f"stack({len(pairs)}, {args}) AS (`{name_col}`, `{value_col}`)")


def exclusion_report(df: DataFrame, prefix: str = "exclusion_", digits: int | None = None) -> DataFrame:
    """Rows ``(criterion, n, pct)``: observations, each flag's count of 1s,
    and the number of rows with any flag equal to 1 ("Total excluded").

    NULL flags count as not excluded; percentages use all rows.
    """
    flags = [c for c in df.columns if c.startswith(prefix)]
    any_flag = F.lit(False)
    for c in flags:
        any_flag = any_flag | F.coalesce(F.col(c) == 1, F.lit(False))
    agg = df.agg(F.count(F.lit(1)).alias("Observations"),
                 *[F.sum(F.when(F.col(c) == 1, 1).otherwise(0)).cast("long").alias(c) for c in flags],
                 F.sum(F.when(any_flag, 1).otherwise(0)).cast("long").alias("Total excluded"))
    pairs = [("Observations", "Observations")] + [(c, c) for c in flags] + [("Total excluded", "Total excluded")]
    long = agg.select(F.col("Observations").alias("_total"), _stack(pairs, "criterion", "n"))
    pct = F.col("n").cast("double") * F.lit(100.0) / F.col("_total").cast("double")
    if digits is not None:
        pct = F.round(pct, digits)
    return long.select("criterion", F.col("n").cast("long").alias("n"), pct.alias("pct"))


def crosstab(df: DataFrame, row: str, column: str, values: Sequence[str],
             row_label: str | None = None) -> DataFrame:
    """Counts of ``row`` x ``column`` with a fixed column list; cells are text
    and a missing combination is NULL (not 0); other categories are ignored."""
    t = df.groupBy(row).pivot(column, list(values)).count()
    return t.select(F.col(row).alias(row_label or row),
                    *[F.col(f"`{v}`").cast("string").alias(v) for v in values])


def missing_per_column(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(variable, n_missing)`` per column, from one aggregation pass."""
    cols = list(columns or df.columns)
    agg = df.agg(*[F.sum(F.col(f"`{c}`").isNull().cast("long")).alias(c) for c in cols])
    return agg.select(_stack([(c, c) for c in cols], "variable", "n_missing")) \
              .select("variable", F.col("n_missing").cast("long").alias("n_missing"))


def missing_patterns(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per combination of missing columns: 0/1 per column and the count ``n``."""
    cols = list(columns or df.columns)
    return df.groupBy(*[F.col(f"`{c}`").isNull().cast("int").alias(c) for c in cols]) \
             .agg(F.count(F.lit(1)).alias("n"))


#: Columns of one mask of :func:`missing_profile`.
MASK_BITS = 62


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """(:func:`missing_patterns`, :func:`missing_per_column`) from one pass over ``df``.

    A row's missing columns are bits of one or more long masks, so the only
    aggregation over the rows is a count per mask; it is stored, and both
    results are read from it, the columns' counts as sums over the patterns.
    """
    cols = list(columns or df.columns)
    groups = [cols[i:i + MASK_BITS] for i in range(0, len(cols), MASK_BITS)]
    masks = []
    for g, names in enumerate(groups):
        mask = F.lit(0).cast("long")
        for bit, c in enumerate(names):
            mask = mask + F.when(F.col(f"`{c}`").isNull(), F.lit(1 << bit).cast("long")).otherwise(F.lit(0).cast("long"))
        masks.append(mask.alias(f"_mask{g}"))
    counted = store(df.groupBy(*masks).agg(F.count(F.lit(1)).alias("n")), "missing-masks")
    missing = [F.getbit(f"_mask{g}", F.lit(bit)).cast("int").alias(c) for g, names in enumerate(groups) for bit, c in enumerate(names)]
    patterns = counted.select(*missing, F.col("n").alias("n"))
    flags = [F.struct(F.lit(c).alias("variable"), F.getbit(f"_mask{g}", F.lit(bit)).cast("long").alias("missing"))
             for g, names in enumerate(groups) for bit, c in enumerate(names)]
    long = counted.select("n", F.inline(F.array(*flags)))
    per_column = long.groupBy("variable").agg(F.sum(F.col("n") * F.col("missing")).alias("n_missing"))
    if not cols:
        return patterns, per_column
    listed = df.sparkSession.createDataFrame([(c,) for c in cols], "variable string")
    return patterns, listed.join(per_column, "variable", "left").select("variable", "n_missing")


def distinct_values(df: DataFrame, column: str, where=None) -> DataFrame:
    """Sorted distinct values of ``column`` (after an optional filter)."""
    if where is not None:
        df = df.filter(where)
    return df.select(column).distinct().orderBy(F.col(column).asc_nulls_last())


def category_counts(df: DataFrame, columns: Sequence[str], name: str = "ct") -> DataFrame:
    """``count(*)`` per combination of ``columns``, ordered by them."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name)) \
             .orderBy(*[F.col(c).asc_nulls_last() for c in columns])
