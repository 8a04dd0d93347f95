"""Sorting and picking rows. Every pick has a tie-break, so results do not depend on partitioning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _ordering(by: Sequence[tuple[str, str]] | str, tie: Sequence[str]):
    pairs = [(by, "asc")] if isinstance(by, str) else list(by)
    keys = [F.desc_nulls_last(c) if d == "desc" else F.asc_nulls_last(c) for c, d in pairs]
    return [*keys, *[F.asc(t) for t in tie]]


def sort(df: DataFrame, by: Sequence[tuple[str, str]] | str, tie: Sequence[str] = ()) -> DataFrame:
    """Total sort (range partitioned), missing values last."""
    return df.orderBy(*_ordering(by, tie))


def top_k(df: DataFrame, by: Sequence[tuple[str, str]] | str, k: int, tie: Sequence[str] = ()) -> DataFrame:
    """First k rows of the sort: each task keeps k rows, only those are merged."""
    return df.orderBy(*_ordering(by, tie)).limit(k)


def arg_min(df: DataFrame, by: str, tie: str) -> DataFrame:
    """The row with the smallest value, first on ties; NULL never wins."""
    return top_k(df.where(F.col(by).isNotNull()), [(by, "asc")], 1, [tie])


def arg_max(df: DataFrame, by: str, tie: str) -> DataFrame:
    return top_k(df.where(F.col(by).isNotNull()), [(by, "desc")], 1, [tie])


def first_row(df: DataFrame, order: str) -> DataFrame:
    return df.orderBy(F.asc(order)).limit(1)
