"""Order-dependent operators that never gather a whole table, or a whole hot key, in one task.

A table order ("the next valid value", "row number", "running sum") is cut into blocks of the
order column. Windows run inside one block; one summary row per block carries the state over the
block border, and only those summary rows are ordered as a whole. Block borders are literals, so
a retried task or a second branch of the plan always cuts at the same places.

Borders come either from the order column itself (``block_size``, for dense integers: no extra
job) or from a thin random sample of it (only the *borders* are sampled, never the rows).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK = "_block"
# Quantiles that the first look at the sample reads; tables of more blocks are looked at again.
PROBES = 128
GROUP = "_group"


@dataclass(frozen=True)
class Blocking:
    """How the order column is cut.

    block_size: width of a block in units of the order (integers, days, microseconds) for an order
        that is dense in them; no job is run.
    rows_per_block: wanted rows per block when borders are sampled.
    fraction: share of rows looked at for the borders.
    """

    block_size: int | None = None
    rows_per_block: int = 250_000
    fraction: float = 0.001
    seed: int = 42


DEFAULT = Blocking()


@dataclass(frozen=True)
class Borders:
    rows: float
    cuts: tuple[float, ...]


def position(df: DataFrame, order: str) -> Column:
    """The order column as a double that rises with it."""
    kind = df.schema[order].dataType
    c = F.col(order)
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(F.to_utc_timestamp(c.cast("timestamp"), F.current_timezone())).cast("double")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(c).cast("double")
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise TypeError(f"cannot cut blocks on {order}: {kind.simpleString()}")


def sample_borders(df: DataFrame, order: str, blocking: Blocking = DEFAULT) -> Borders:
    """Estimated row count and cut points, read from a thin sample of one column in one job."""
    most = PROBES
    probes = [i / most for i in range(1, most)]
    thin = df.select(position(df, order).alias("x")).where("x IS NOT NULL")
    if blocking.fraction < 1:
        thin = thin.sample(False, blocking.fraction, blocking.seed)
    n, cuts = thin.agg(F.count("*"), F.percentile_approx("x", probes, 10 * most)).first()
    rows = n / blocking.fraction
    blocks = math.ceil(rows / blocking.rows_per_block) if rows else 1
    if blocks <= 1 or not cuts:
        return Borders(rows, ())
    if blocks > most:  # a large table: as many borders as blocks, from a second look at the thin sample
        most, probes = blocks, [i / blocks for i in range(1, blocks)]
        cuts = thin.agg(F.percentile_approx("x", probes, 10 * most)).first()[0]
    step = most / blocks
    chosen = {cuts[min(len(cuts) - 1, max(0, round(i * step) - 1))] for i in range(1, blocks)}
    return Borders(rows, tuple(sorted(chosen)))


def with_block(df: DataFrame, order: str, blocking: Blocking = DEFAULT, borders: Borders | None = None) -> DataFrame:
    """Add a block number that rises with ``order``; equal order values share a block."""
    if blocking.block_size:
        number = F.floor(position(df, order) / blocking.block_size).cast("bigint")
        return df.withColumn(BLOCK, F.coalesce(number, F.lit(-(1 << 62))))  # NULL orders come first, as below
    borders = borders or sample_borders(df, order, blocking)
    if not borders.cuts:
        return df.withColumn(BLOCK, F.lit(0).cast("bigint"))
    low = F.lit(float("-inf"))
    placed = df.withColumn("_x", F.coalesce(position(df, order), low))
    cutter = Bucketizer(
        splits=[float("-inf"), *borders.cuts, float("inf")], inputCol="_x", outputCol=BLOCK, handleInvalid="keep"
    )
    return cutter.transform(placed).withColumn(BLOCK, F.col(BLOCK).cast("bigint")).drop("_x")


def _grouped(df: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """A never-NULL struct of the keys: NULL keys are ordinary groups and joins stay hash joins."""
    if not keys:
        return df, []
    return df.withColumn(GROUP, F.struct(*keys)), [GROUP]


def _carry_window(group: list[str]) -> Window:
    return Window.partitionBy(*group).orderBy(BLOCK)


def fill_next_valid(
    df: DataFrame, cols: Sequence[str] | str, order: str, keys: Sequence[str] = (), blocking: Blocking = DEFAULT
) -> DataFrame:
    """Replace NULL by the next non-NULL value in table order (within ``keys`` if given).

    All columns are filled by the same shuffle. NULLs with no later value stay.
    """
    cols = [cols] if isinstance(cols, str) else list(cols)
    names = df.columns
    df, group = _grouped(with_block(df, order, blocking), keys)
    part = [*group, BLOCK]
    heads = df.groupBy(*part).agg(
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_head_{c}") for c in cols]
    )
    # Descending order: a frame that starts at the partition's first row is updated row by row,
    # one that ends at its last row would be computed anew for every row.
    later = Window.partitionBy(*group).orderBy(F.desc(BLOCK)).rowsBetween(Window.unboundedPreceding, -1)
    carry = heads.select(*part, *[F.last(f"_head_{c}", ignorenulls=True).over(later).alias(f"_next_{c}") for c in cols])
    ahead = Window.partitionBy(*part).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumns({f"_local_{c}": F.last(c, ignorenulls=True).over(ahead) for c in cols})
    joined = local.join(carry, part, "left")
    filled = {c: F.coalesce(F.col(f"_local_{c}"), F.col(f"_next_{c}")).alias(c) for c in cols}
    return joined.select(*[filled.get(c, F.col(c)) for c in names])


def running_sums(
    df: DataFrame,
    order: str,
    sums: Mapping[str, str],
    keys: Sequence[str] = (),
    totals: bool = False,
    blocking: Blocking = DEFAULT,
    borders: Borders | None = None,
) -> DataFrame:
    """Add inclusive running sums ``{new column: summed column}`` in table order.

    With ``totals`` a column ``<new>_total`` holds the sum over the whole key.
    """
    names = df.columns
    df, group = _grouped(with_block(df, order, blocking, borders), keys)
    part = [*group, BLOCK]
    blocks = df.groupBy(*part).agg(*[F.sum(c).alias(f"_sum_{o}") for o, c in sums.items()])
    before = _carry_window(group).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*group)
    carry = blocks.select(
        *part,
        *[F.coalesce(F.sum(f"_sum_{o}").over(before), F.lit(0)).alias(f"_before_{o}") for o in sums],
        *([F.sum(f"_sum_{o}").over(whole).alias(f"{o}_total") for o in sums] if totals else []),
    )
    upto = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    local = df.withColumns({f"_local_{o}": F.sum(c).over(upto) for o, c in sums.items()})
    out = local.join(carry, part, "left")
    return out.select(
        *names,
        *[(F.col(f"_local_{o}") + F.col(f"_before_{o}")).alias(o) for o in sums],
        *([F.col(f"{o}_total") for o in sums] if totals else []),
    )


def row_index(
    df: DataFrame,
    order: str,
    keys: Sequence[str] = (),
    out: str = "row_index",
    start: int = 0,
    total: str | None = None,
    blocking: Blocking = DEFAULT,
) -> DataFrame:
    """Gap-free row number in table order; ``total`` adds the number of rows of the key."""
    counted = running_sums(
        df.withColumn("_one", F.lit(1).cast("bigint")), order, {out: "_one"}, keys, totals=total is not None, blocking=blocking
    ).drop("_one")
    counted = counted.withColumn(out, F.col(out) + (start - 1))
    return counted.withColumnRenamed(f"{out}_total", total) if total else counted


def seq_in_group(df: DataFrame, keys: Sequence[str], order: str, out: str = "seq", blocking: Blocking = DEFAULT) -> DataFrame:
    """Sequence number from 1 within each key; a hot key is numbered block by block."""
    return row_index(df, order, keys, out, start=1, blocking=blocking)


def previous(
    df: DataFrame, c: str, order: str, keys: Sequence[str] = (), out: str = "previous", blocking: Blocking = DEFAULT
) -> DataFrame:
    """Value of the preceding row (NULL values included), NULL on the first row."""
    names = df.columns
    df, group = _grouped(with_block(df, order, blocking), keys)
    part = [*group, BLOCK]
    tails = df.groupBy(*part).agg(F.max_by(F.struct(F.col(c).alias("v")), F.col(order)).alias("_tail"))
    carry = tails.select(*part, F.lag("_tail").over(_carry_window(group)).alias("_tail"))
    inside = Window.partitionBy(*part).orderBy(order)
    local = df.withColumns({"_rank": F.row_number().over(inside), "_lag": F.lag(c).over(inside)})
    value = F.when(F.col("_rank") > 1, F.col("_lag")).otherwise(F.col("_tail.v"))
    return local.join(carry, part, "left").select(*names, value.alias(out))


def centered_mean(
    df: DataFrame,
    c: str,
    order: str,
    width: int,
    keys: Sequence[str] = (),
    out: str = "trend",
    blocking: Blocking = DEFAULT,
    chunk: int = 1_000_000,
) -> DataFrame:
    """Centered moving average of ``width`` rows; NULL where the window is not full.

    Rows near a chunk border are also sent to the neighbouring chunk, so every window is whole.
    An even width takes ``width + 1`` rows with half weight on both ends.
    """
    half = width // 2
    names = df.columns
    numbered = row_index(df, order, keys, out="_pos", blocking=blocking)
    first = F.floor(F.greatest(F.col("_pos") - half, F.lit(0)) / chunk).cast("bigint")
    last = F.floor((F.col("_pos") + half) / chunk).cast("bigint")
    spread = numbered.withColumn("_chunk", F.explode(F.sequence(first, last)))
    spread, group = _grouped(spread, keys)
    w = Window.partitionBy(*group, "_chunk").orderBy("_pos")
    frame = w.rowsBetween(-half, half)
    total = F.sum(c).over(frame)
    if width % 2 == 0:
        total = total - 0.5 * (F.lag(c, half).over(w) + F.lead(c, half).over(w))
    mean = F.when(F.count(c).over(frame) == 2 * half + 1, total / width)
    own = F.col("_chunk") == F.floor(F.col("_pos") / chunk)
    return spread.withColumn(out, mean).where(own).select(*names, out)
