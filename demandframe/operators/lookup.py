"""Joins, look-ups and set comparisons."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandframe.functions.columns import flag

def join_summary(df: DataFrame, summary: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Join a per-key summary to the rows it came from.

    A plain join: adaptive execution broadcasts the summary if its measured bytes allow that, and else splits keys
    that hold too many rows.
    """
    return df.join(summary, list(on), how)


def one_row(stats: DataFrame) -> Column:
    """A one-row statistics table as a struct column (a scalar subquery, not a join)."""
    return stats.select(F.struct(*stats.columns).alias("s")).scalar()


def attach_row(df: DataFrame, stats: DataFrame, name: str = "_stats") -> DataFrame:
    """The one-row table as a struct column ``name``: one subquery, however often it is used."""
    return df.withColumn(name, one_row(stats))


def with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach every column of a one-row statistics table to every row."""
    return attach_row(df, stats).select(*df.columns, *[F.col("_stats").getField(c).alias(c) for c in stats.columns])


def first_by_key(df: DataFrame, keys: Sequence[str], c: str, order: str, out: str) -> DataFrame:
    """Value of ``c`` on the first row of each key; combined map-side, so hot keys are cheap."""
    return df.groupBy(*keys).agg(F.min_by(c, order).alias(out))


def lookup_first(df: DataFrame, donors: DataFrame, keys: Sequence[str], c: str, order: str, out: str | None = None) -> DataFrame:
    """Left look-up of the first donor value per key. NULL keys find nothing."""
    out = out or f"{c}_first"
    have_key = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    return join_summary(df, first_by_key(donors.where(have_key), keys, c, order, out), keys)


def flag_in(df: DataFrame, c: str, values: Sequence | DataFrame, out: str = "is_in") -> DataFrame:
    """0/1 membership of ``c`` in a list or in the first column of a table."""
    if not isinstance(values, DataFrame):
        return df.withColumn(out, flag(F.col(c).isin(list(values))))
    member = values.select(F.col(values.columns[0]).alias(c)).where(F.col(c).isNotNull()).distinct()
    marked = join_summary(df, member.withColumn("_member", F.lit(1)), [c])
    return marked.select(*df.columns, F.coalesce("_member", F.lit(0)).alias(out))


def align_rows(a: DataFrame, b: DataFrame, order: str) -> DataFrame:
    """Row i of ``a`` next to row i of ``b``: both carry the unique order column."""
    return a.join(b, order, "inner")


def compare_counts(a: DataFrame, b: DataFrame, c: str, names: tuple[str, str] = ("base", "new")) -> DataFrame:
    """Frequency of each label in both tables, 0 where it is missing."""
    label = F.coalesce(F.col(c).cast("string"), F.lit("nan")).alias("label")
    left, right = (t.groupBy(label).agg(F.count("*").alias(n)) for t, n in zip((a, b), names))
    both = left.join(right, "label", "full_outer")
    return both.select("label", *[F.coalesce(n, F.lit(0)).alias(n) for n in names])


def only_in(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is not in ``b``."""
    return a.join(b.select(*keys), list(keys), "left_anti")


def in_both(a: DataFrame, b: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``a`` whose key is also in ``b``."""
    return a.join(b.select(*keys), list(keys), "left_semi")


def stack_tables(*tables: DataFrame) -> DataFrame:
    """Rows of all tables under one another, matched by column name."""
    return reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), tables)
