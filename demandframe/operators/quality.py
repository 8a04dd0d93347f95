"""Table assertions and request checks."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandframe.functions import columns as fc


# ---- rules: each gives a column that is true on a violating row ---------------------------------


def identity_holds(a: str, b: str, total: str) -> Column:
    return (F.col(a) + F.col(b)) != F.col(total)


def not_negative(c: str) -> Column:
    return F.col(c) < 0


def in_range(c: str, lo: float, hi: float) -> Column:
    return (F.col(c) < lo) | (F.col(c) > hi)


def not_null(c: str) -> Column:
    return F.col(c).isNull()


def finite(c: str) -> Column:
    x = F.col(c).cast("double")
    return F.isnan(x) | (F.abs(x) == float("inf"))


def assert_table(df: DataFrame, rules: Mapping[str, Column], checks: Mapping[str, Column] | None = None) -> DataFrame:
    """(rule, violations, passed) in one pass.

    ``rules`` are row conditions that must never be true; ``checks`` are aggregates that must be true
    for the whole table (counted as one violation otherwise).
    """
    checks = checks or {}
    names = [*rules, *checks]
    counted = [F.count_if(cond) for cond in rules.values()]
    counted += [F.when(F.coalesce(cond, F.lit(False)), 0).otherwise(1).cast("bigint") for cond in checks.values()]
    one = df.agg(*[c.alias(f"_r{i}") for i, c in enumerate(counted)])
    cells = [F.struct(F.lit(n).alias("rule"), F.col(f"_r{i}").alias("violations")) for i, n in enumerate(names)]
    return one.select(F.inline(F.array(*cells))).withColumn("passed", (F.col("violations") == 0).cast("int"))


def retention(before: DataFrame, after: DataFrame, share: float = 0.8) -> DataFrame:
    """(rule, violations, passed): at least ``share`` of the rows must be left."""
    n = before.agg(F.count("*").alias("n")).scalar()
    ok = F.coalesce(F.count("*") >= share * n, F.lit(False))
    kept = after.agg(F.when(ok, 0).otherwise(1).cast("bigint").alias("violations"))
    return kept.select(F.lit(f"retention >= {share}").alias("rule"), "violations", (F.col("violations") == 0).cast("int").alias("passed"))


def split_shares(df: DataFrame, fractions: Mapping[str, float], split: str = "split", tolerance: float = 0.05) -> DataFrame:
    """(rule, violations, passed): every split within the tolerance of its share."""
    checks = {
        f"share of {s}": F.abs(F.count_if(F.col(split) == s) / F.count("*") - share) <= tolerance for s, share in fractions.items()
    }
    return assert_table(df, {}, checks)


def disjoint_keys(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """(rule, violations, passed): no key in more than one split."""
    per_key = df.groupBy(key).agg(F.min(split).alias("lo"), F.max(split).alias("hi"))
    return assert_table(per_key, {"splits are disjoint": F.col("lo") != F.col("hi")})


def same_columns(a: DataFrame, b: DataFrame) -> bool:
    return set(a.columns) == set(b.columns)


# ---- requests ------------------------------------------------------------------------------


def validate_requests(df: DataFrame, features: str, n_features: int | None = None) -> DataFrame:
    """Add ``status`` (200, 400 or 422) and ``error`` to rows that hold an array of feature rows.

    Checks in order: missing, empty, inner lengths differ, inner length is not ``n_features``
    (skipped if that is None).
    """
    lengths = fc.inner_lengths(features)
    width = F.get(lengths, F.lit(0))
    missing = F.col(features).isNull()
    empty = F.size(features) == 0
    ragged = F.size(lengths) != 1
    wrong = F.lit(False) if n_features is None else width != n_features
    status = F.when(missing, 400).when(empty | ragged | wrong, 422).otherwise(200)
    found = F.concat_ws(",", F.transform(lengths, lambda n: n.cast("string")))
    error = (
        F.when(missing, F.lit("features missing"))
        .when(empty, F.lit("features empty"))
        .when(ragged, F.concat(F.lit("rows differ in length: "), found))
        .when(wrong, F.concat(F.lit("row length "), width.cast("string"), F.lit(f" but the model expects {n_features}")))
    )
    return df.withColumns({"status": status, "error": error})


def accepted(df: DataFrame) -> DataFrame:
    return df.where("status = 200")


def rejected(df: DataFrame) -> DataFrame:
    return df.where("status <> 200")


def request_type() -> T.ArrayType:
    return T.ArrayType(T.ArrayType(T.DoubleType()))


def as_requests(df: DataFrame, features: str) -> DataFrame:
    """Cast to array<array<double>>."""
    return df.withColumn(features, F.col(features).cast(request_type()))


