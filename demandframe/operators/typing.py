"""Type coercion of dirty columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandframe.functions import columns as fc


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Cast text columns to double; what is not a number becomes NULL. Absent columns are skipped."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns(
        {
            c: fc.number_or_null(c) if isinstance(types[c], T.StringType) else fc.nan_to_null(c)
            for c in cols
            if c in types
        }
    )


def non_numeric_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(column, value, n): every distinct text that is not a number, with its count."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in cols]).unpivot([], list(cols), "column", "value")
    bad = long.where(fc.number_or_null("value").isNull())
    return bad.groupBy("column", "value").agg(F.count("*").alias("n"))


def to_nullable_int(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.withColumns({c: fc.to_long_half_even(c) for c in cols})


def parse_date(df: DataFrame, c: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or c, fc.date_or_null(c))


def to_category(df: DataFrame, c: str, domain: Iterable) -> DataFrame:
    """Keep values of the declared domain, everything else becomes NULL."""
    return df.withColumn(c, F.when(F.col(c).isin(list(domain)), F.col(c)))


def cast_columns(df: DataFrame, double: Sequence[str] = (), flags: Sequence[str] = (), text: Sequence[str] = ()) -> DataFrame:
    """Casts to double, boolean to 0/1, and text with 'nan' for missing."""
    return df.withColumns(
        {
            **{c: F.col(c).cast("double") for c in double},
            **{c: F.col(c).cast("int") for c in flags},
            **{c: fc.text_or_nan(c) for c in text},
        }
    )


def columns_of_kind(df: DataFrame, kind: str) -> list[str]:
    """Names of the columns of a kind: 'number', 'text', 'bool' or 'time'."""
    classes = {
        "number": (T.NumericType,),
        "text": (T.StringType,),
        "bool": (T.BooleanType,),
        "time": (T.DateType, T.TimestampType, T.TimestampNTZType),
    }[kind]
    return [f.name for f in df.schema.fields if isinstance(f.dataType, classes)]


def select_kind(df: DataFrame, kind: str) -> DataFrame:
    return df.select(*columns_of_kind(df, kind))


def date_parts(df: DataFrame, c: str, prefix: str = "") -> DataFrame:
    """Add year, month and weekday (Monday = 0)."""
    return df.withColumns(
        {
            f"{prefix}year": F.year(c),
            f"{prefix}month": F.month(c),
            f"{prefix}weekday": F.weekday(c),
        }
    )
