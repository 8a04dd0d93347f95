"""Rule-based repair: calendar codes, bounds, outliers, count identity, duplicates, hours."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from demandframe.functions import columns as fc
from demandframe.operators.lookup import attach_row, join_summary, lookup_first
from demandframe.operators.ordered import DEFAULT, Blocking, fill_next_valid
from demandframe.operators.profile import quantile_row


# ---- calendar codes ------------------------------------------------------------------------


def repair_from_group(
    df: DataFrame, c: str, valid: Iterable, keys: Sequence[str], order: str, donors: DataFrame | None = None
) -> DataFrame:
    """Replace an invalid or NULL value by the first valid value of a row with the same key.

    Without a donor (or with a NULL key) the value stays as it is, even if it is out of domain.
    ``donors`` names an earlier table with the same rows, cheaper to read than ``df``.
    """
    ok = fc.is_one_of(c, valid)
    found = lookup_first(df, (df if donors is None else donors).where(ok), keys, c, order, "_donor")
    fixed = F.when(ok, F.col(c)).otherwise(F.coalesce("_donor", c))
    return found.withColumn(c, fixed).select(*df.columns)


def derive_when_invalid(df: DataFrame, c: str, valid: Iterable, derived: Column) -> DataFrame:
    """Keep a valid value, otherwise take the derived one (which may be NULL)."""
    return df.withColumn(c, F.when(fc.is_one_of(c, valid), F.col(c)).otherwise(derived))


def year_code(c: str, date: str, codes: Mapping[int, int]) -> Column:
    """Code of the year of the date; a NULL date leaves the old value, an unknown year gives NULL."""
    known = F.lit(None).cast("bigint")
    for year, code in codes.items():
        known = F.when(F.year(date) == year, F.lit(code).cast("bigint")).otherwise(known)
    return F.when(F.col(date).isNull(), F.col(c).cast("bigint")).otherwise(known)


def working_day(date: str, holiday: str) -> Column:
    """0 on Saturday, Sunday or a holiday, else 1; NULL without a date."""
    free = (F.weekday(date) >= 5) | F.coalesce(F.col(holiday) == 1, F.lit(False))
    return F.when(F.col(date).isNotNull(), F.when(free, 0).otherwise(1).cast("bigint"))


def calendar_repairs(
    df: DataFrame, date: str, yr: str, mnth: str, workingday: str, weekday: str, holiday: str, year_codes: Mapping[int, int]
) -> DataFrame:
    """Year code, month, working day and weekday repaired from the date in one projection."""
    def keep(c: str, valid: Iterable, derived: Column) -> Column:
        return F.when(fc.is_one_of(c, valid), F.col(c).cast("bigint")).otherwise(derived.cast("bigint"))

    return df.withColumns(
        {
            yr: keep(yr, year_codes.values(), year_code(yr, date, year_codes)),
            mnth: keep(mnth, range(1, 13), F.month(date)),
            workingday: keep(workingday, (0, 1), working_day(date, holiday)),
            weekday: keep(weekday, range(7), F.weekday(date)),
        }
    )


def calendar_flag(df: DataFrame, date: str, dates: Sequence[str], out: str = "holiday") -> DataFrame:
    """1 when the date is in the list, 0 otherwise and for NULL; overwrites ``out``."""
    days = [F.lit(d).cast("date") for d in dates]
    return df.withColumn(out, fc.flag(F.col(date).cast("date").isin(*days)))


# ---- bounds and fills ----------------------------------------------------------------------


def bound_to_null(df: DataFrame, uppers: Mapping[str, float]) -> DataFrame:
    """Values strictly above their upper bound become NULL; low values are left alone."""
    return df.withColumns({c: F.when(F.col(c) <= hi, F.col(c)) for c, hi in uppers.items()})


def bound_and_fill(
    df: DataFrame, uppers: Mapping[str, float], order: str, keys: Sequence[str] = (), blocking: Blocking = DEFAULT
) -> DataFrame:
    """Bound to NULL, then take the next valid value in table order."""
    return fill_next_valid(bound_to_null(df, uppers), list(uppers), order, keys, blocking)


def clip_columns(df: DataFrame, bounds: Mapping[str, tuple[float | None, float | None]]) -> DataFrame:
    return df.withColumns({c: fc.clamp(c, lo, hi) for c, (lo, hi) in bounds.items()})


# ---- outliers ------------------------------------------------------------------------------


def _fences(q: Column, k: float) -> tuple[Column, Column]:
    q1, q3 = q[0], q[1]
    return q1 - k * (q3 - q1), q3 + k * (q3 - q1)


def _outside(c: str, q: Column, k: float) -> Column:
    lo, hi = _fences(q, k)
    return F.coalesce((F.col(c) < lo) | (F.col(c) > hi), F.lit(False))


def iqr_bounds(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """(column, q1, q3, iqr, lo, hi, n_out, pct); pct is over all rows, NULLs are no outliers."""
    ready = attach_row(df, quantile_row(df, cols, [0.25, 0.75]))
    s = F.col("_stats")
    counted = ready.agg(
        F.count("*").alias("_n"),
        F.first(s).alias("_stats"),
        *[F.count_if(_outside(c, s.getField(c), k)).alias(f"_out_{i}") for i, c in enumerate(cols)],
    )
    rows = F.array(
        *[
            F.struct(F.lit(c).alias("column"), s.getField(c).alias("q"), F.col(f"_out_{i}").alias("n_out"), F.col("_n").alias("n"))
            for i, c in enumerate(cols)
        ]
    )
    long = counted.select(F.inline(rows))
    lo, hi = _fences(F.col("q"), k)
    return long.select(
        "column",
        F.col("q")[0].alias("q1"),
        F.col("q")[1].alias("q3"),
        (F.col("q")[1] - F.col("q")[0]).alias("iqr"),
        lo.alias("lo"),
        hi.alias("hi"),
        "n_out",
        (F.col("n_out") * 100.0 / F.col("n")).alias("pct"),
    )


def iqr_flag(df: DataFrame, cols: Sequence[str], k: float = 1.5) -> DataFrame:
    """Add ``<column>_outlier`` 0/1 flags."""
    ready = attach_row(df, quantile_row(df, cols, [0.25, 0.75]))
    flags = {f"{c}_outlier": _outside(c, F.col("_stats").getField(c), k).cast("int") for c in cols}
    return ready.withColumns(flags).drop("_stats")


def outlier_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row with [first quartile, third quartile, median] per column."""
    return quantile_row(df, cols, [0.25, 0.75, 0.5])


def replace_exclusive_outliers(
    df: DataFrame, cols: Sequence[str], k: float = 2.5, stats: DataFrame | None = None
) -> DataFrame:
    """A value that is an outlier in its own column and in no other of ``cols`` becomes the median.

    Fences and medians come from one statistics pass over the unchanged columns (``stats``, see
    ``outlier_fit``). For integer columns the median is rounded half-even.
    """
    ready = attach_row(df, outlier_fit(df, cols) if stats is None else stats)
    s = F.col("_stats")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    outside = {c: _outside(c, s.getField(c), k) for c in cols}
    median = {}
    for c in cols:
        value = s.getField(c)[2]
        median[c] = (value if kinds[c].typeName() in ("double", "float") else F.rint(value)).cast(kinds[c])
    fixed = {}
    for c in cols:
        alone = outside[c]
        for other in cols:
            if other != c:
                alone = alone & ~outside[other]
        fixed[c] = F.when(alone, median[c]).otherwise(F.col(c))
    return ready.withColumns(fixed).drop("_stats")


# ---- counts --------------------------------------------------------------------------------


def computed_once(df: DataFrame, new: Mapping[str, Column]) -> DataFrame:
    """``withColumns`` whose values are computed once per row.

    Catalyst pushes a later filter below a projection by repeating the projected expressions in
    it, which for chained repairs grows exponentially. A one-row ``inline`` stops that.
    """
    kept = [c for c in df.columns if c not in new]
    made = df.select(*kept, F.inline(F.array(F.struct(*[e.alias(c) for c, e in new.items()]))))
    return made.select(*df.columns, *[c for c in new if c not in df.columns])


def whole_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Round half-even to integers, then drop the sign."""
    return df.withColumns({c: F.abs(fc.to_long_half_even(c)) for c in cols})


def fill_by_identity(df: DataFrame, a: str, b: str, total: str) -> DataFrame:
    """Fill one missing member of a + b = total: first total, then a, then b."""
    new_total = F.coalesce(F.col(total), F.col(a) + F.col(b))
    new_a = F.coalesce(F.col(a), new_total - F.col(b))
    new_b = F.coalesce(F.col(b), new_total - new_a)
    return df.withColumns({total: new_total, a: new_a, b: new_b})


def _identity_branch(a: str, b: str, total: str) -> Column:
    """Which member is recomputed: the largest; ties go to a, then b, then total. NULL if consistent."""
    top = F.greatest(a, b, total)
    broken = F.coalesce((F.col(a) + F.col(b)) != F.col(total), F.lit(False))
    which = F.when(F.col(a) == top, "a").when(F.col(b) == top, "b").otherwise("total")
    return F.when(broken, which)


def fix_identity(df: DataFrame, a: str, b: str, total: str) -> DataFrame:
    """Where a + b differs from total, recompute the largest of the three from the other two."""
    branch = F.coalesce(_identity_branch(a, b, total), F.lit("none"))
    return computed_once(
        df,
        {
            a: F.when(branch == "a", F.col(total) - F.col(b)).otherwise(F.col(a)),
            b: F.when(branch == "b", F.col(total) - F.col(a)).otherwise(F.col(b)),
            total: F.when(branch == "total", F.col(a) + F.col(b)).otherwise(F.col(total)),
        },
    )


def drop_incomplete(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(subset=list(cols))


def drop_negative(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows with a negative value go; NULL is not negative."""
    bad = F.lit(False)
    for c in cols:
        bad = bad | F.coalesce(F.col(c) < 0, F.lit(False))
    return df.where(~bad)


def repair_count_values(
    df: DataFrame, a: str, b: str, total: str, k: float = 2.5, stats: DataFrame | None = None
) -> DataFrame:
    """Counts made whole, single outliers replaced, gaps filled, identity restored; no row is dropped."""
    members = [a, b, total]
    df = replace_exclusive_outliers(whole_counts(df, members), members, k, stats)
    return fix_identity(fill_by_identity(df, a, b, total), a, b, total)


def repair_counts(df: DataFrame, a: str, b: str, total: str, k: float = 2.5) -> DataFrame:
    """The whole count step: repaired values, then rows that cannot be saved go."""
    members = [a, b, total]
    return drop_negative(drop_incomplete(repair_count_values(df, a, b, total, k), members), members)


def cleaning_report(df: DataFrame, a: str, b: str, total: str, k: float = 2.5) -> DataFrame:
    """(measure, n): what the count step replaced, filled, recomputed and dropped. One pass."""
    members = [a, b, total]
    whole = whole_counts(df, members)
    old = {m: f"_old_{m}" for m in members}
    kept = whole.withColumns({old[m]: F.col(m) for m in members})
    replaced = replace_exclusive_outliers(kept, members, k)
    nulls = {m: f"_null_{m}" for m in members}
    changed = replaced.withColumns(
        {**{nulls[m]: F.col(m).isNull() for m in members}, **{f"_rep_{m}": ~F.equal_null(F.col(m), F.col(old[m])) for m in members}}
    )
    filled = fill_by_identity(changed, a, b, total).withColumn("_branch", _identity_branch(a, b, total))
    fixed = fix_identity(filled, a, b, total)
    incomplete = F.lit(False)
    negative = F.lit(False)
    for m in members:
        incomplete = incomplete | F.col(m).isNull()
        negative = negative | F.coalesce(F.col(m) < 0, F.lit(False))
    measures = {
        "rows_before": F.count("*"),
        **{f"outliers_replaced_{m}": F.count_if(F.col(f"_rep_{m}")) for m in members},
        **{f"null_before_{m}": F.count_if(F.col(nulls[m])) for m in members},
        **{f"null_after_{m}": F.count_if(F.col(m).isNull()) for m in members},
        "inconsistent": F.count_if(F.col("_branch").isNotNull()),
        f"recomputed_{a}": F.count_if(F.col("_branch") == "a"),
        f"recomputed_{b}": F.count_if(F.col("_branch") == "b"),
        f"recomputed_{total}": F.count_if(F.col("_branch") == "total"),
        "still_inconsistent": F.count_if((F.col(a) + F.col(b)) != F.col(total)),
        "dropped_incomplete": F.count_if(incomplete),
        "dropped_negative": F.count_if(~incomplete & negative),
    }
    one = fixed.agg(*[v.alias(m) for m, v in measures.items()])
    total_rows = F.col("rows_before")
    rows = F.array(
        *[
            F.struct(F.lit(m).alias("measure"), F.col(m).alias("n"), (F.col(m) * 100.0 / F.nullif(total_rows, F.lit(0))).alias("pct"))
            for m in measures
        ]
    )
    return one.select(F.inline(rows))


# ---- duplicates and hours ------------------------------------------------------------------


def dedupe_keep_first(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """First row of each key in table order; NULL keys are equal to each other.

    ``row_number() = 1`` is cut down to one row per key before the shuffle (group limit), so a
    key that fills a third of the table sends one row per task.
    """
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def group_size(df: DataFrame, keys: Sequence[str], out: str = "group_size") -> DataFrame:
    """Rows of the key on every row: counted map-side and joined, not a window over the key."""
    group = F.struct(*keys)
    sizes = df.groupBy(group.alias("_group")).agg(F.count("*").alias(out))
    return join_summary(df.withColumn("_group", group), sizes, ["_group"]).select(*df.columns, out)


def resequence_group(df: DataFrame, key: str, c: str, order: str, size: int = 24) -> DataFrame:
    """Renumber complete groups: ``size`` rows get 0..size-1, one row more gets NULL on its last row.

    Other group sizes keep their values; rows with a NULL key get NULL. Only groups of these two
    sizes are kept together for numbering; the rows of every other group are spread by their order
    value, so a hot group is never in one task.
    """
    sizes = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    complete = sizes.where(F.col("_n").isin(size, size + 1))
    marked = join_summary(df, complete, [key])
    spread = F.when(F.col("_n").isNull(), F.xxhash64(order))
    w = Window.partitionBy(key, "_spread").orderBy(order)
    numbered = marked.withColumn("_spread", spread).withColumn("_seq", F.row_number().over(w) - 1)
    kind = df.schema[c].dataType
    value = (
        F.when(F.col(key).isNull(), F.lit(None))
        .when(F.col("_n").isNull(), F.col(c))
        .when(F.col("_seq") < size, F.col("_seq").cast(kind))
    )
    return numbered.withColumn(c, value).select(*df.columns)


def drop_columns(df: DataFrame, cols: Sequence[str], strict: bool = False) -> DataFrame:
    missing = [c for c in cols if c not in df.columns]
    if strict and missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)
