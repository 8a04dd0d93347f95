"""The cleaning job: dirty hourly text table in, repaired table out."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from demandframe.operators import repair as r
from demandframe.operators.ordered import DEFAULT, Blocking
from demandframe.operators.typing import coerce_numeric, parse_date, to_nullable_int
from demandframe.sources.tables import durable, read_csv_text, require_rows, write_table

# Public holidays of 2011 and 2012.
HOLIDAYS = (
    "2011-01-17", "2011-02-21", "2011-04-15", "2011-05-30", "2011-07-04", "2011-09-05", "2011-10-10",
    "2011-11-11", "2011-11-24", "2011-12-26", "2012-01-02", "2012-01-16", "2012-02-20", "2012-04-16",
    "2012-05-28", "2012-07-04", "2012-09-03", "2012-10-08", "2012-11-12", "2012-11-22", "2012-12-25",
)


@dataclass(frozen=True)
class CleanRules:
    """Column names and limits of the cleaning job. The defaults fit the raw hourly table."""

    order: str = "instant"
    date: str = "dteday"
    season: str = "season"
    year: str = "yr"
    month: str = "mnth"
    hour: str = "hr"
    holiday: str = "holiday"
    weekday: str = "weekday"
    workingday: str = "workingday"
    condition: str = "weathersit"
    measures: Sequence[str] = ("temp", "atemp", "hum", "windspeed")
    counts: tuple[str, str, str] = ("casual", "registered", "cnt")
    unused: Sequence[str] = ("mixed_type_col",)
    year_codes: Mapping[int, int] = field(default_factory=lambda: {2011: 0, 2012: 1})
    holidays: Sequence[str] = HOLIDAYS
    measure_limit: float = 1.0
    condition_limit: float = 4.0
    hour_limit: float = 23.0
    outlier_width: float = 2.5
    blocking: Blocking = DEFAULT

    @property
    def integers(self) -> list[str]:
        return [
            self.order, self.season, self.year, self.month, self.hour, self.holiday, self.weekday, self.workingday, self.condition,
            *self.counts,
        ]


def typed(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """Text to numbers and dates; whatever cannot be read is NULL."""
    df = coerce_numeric(df, [*rules.integers, *rules.measures, *rules.unused])
    return parse_date(to_nullable_int(df, rules.integers), rules.date)


def clean(df: DataFrame, rules: CleanRules = CleanRules()) -> DataFrame:
    """All repair steps. Working days use the holiday column before it is replaced.

    The repairs touch different columns of the same rows, and rows are dropped only after the
    steps that look at other rows. So every statistic (count quartiles, donors per day, first valid
    measure per block) is read from the typed input, one narrow scan each, not from a chain of
    earlier repairs. The deduplicated rows are written once (reliable checkpoint): the two steps
    after it read them twice.
    """
    n = rules
    start = r.drop_columns(typed(df, n), n.unused)
    quartiles = r.outlier_fit(r.whole_counts(start, n.counts), n.counts)
    df = r.bound_and_fill(start, {m: n.measure_limit for m in n.measures}, n.order, blocking=n.blocking)
    df = r.repair_from_group(df, n.season, (1, 2, 3, 4), [n.date], n.order, donors=start)
    df = r.calendar_repairs(df, n.date, n.year, n.month, n.workingday, n.weekday, n.holiday, n.year_codes)
    df = r.repair_count_values(df, *n.counts, k=n.outlier_width, stats=quartiles)
    df = r.drop_negative(r.drop_incomplete(df, n.counts), n.counts)
    df = r.calendar_flag(df, n.date, n.holidays, n.holiday)
    keys = [n.date, n.season, n.year, n.month, n.hour, n.holiday, n.weekday, n.workingday]
    df = durable(r.dedupe_keep_first(df, keys, n.order))
    df = r.bound_and_fill(df, {n.condition: n.condition_limit}, n.order, blocking=n.blocking)
    df = r.resequence_group(r.bound_to_null(df, {n.hour: n.hour_limit}), n.date, n.hour, n.order)
    return df.withColumn(n.holiday, df[n.holiday].cast("bigint"))


def run(spark, source: str, target: str, rules: CleanRules = CleanRules(), fmt: str = "parquet") -> DataFrame:
    """Read a CSV, clean it, write it, and return the written table."""
    raw = require_rows(read_csv_text(spark, source), source)
    write_table(clean(raw, rules), target, fmt)
    out = spark.read.option("header", True).csv(target) if fmt == "csv" else spark.read.parquet(target)
    return require_rows(out, "cleaned table")
