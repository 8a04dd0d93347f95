"""One-hot coding of columns with any number of levels: a dictionary table and sparse vectors.

The levels of a column are rows of a table, never a list on the driver or names in a plan. Ids are dense and depend on the set
of levels only: the rank of a level's MD5 among the levels of its column. Ranks are counted on two levels, inside each of
4,096 ranges of the digest and over the ranges, so no task sorts a whole column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from demandframe.sources import tables as io

#: Leading hexadecimal digits of the digest that name a range.
RANGE_DIGITS = 3


def level_table(df: DataFrame, cols: Sequence[str], drop_first: bool = True) -> DataFrame:
    """(column, level, n, id): each level as text, its rows, and its id from 0 within the column.

    With ``drop_first`` the smallest level of a column is the base and has no id. NULL is no level; a column without values has no rows.
    """
    if not cols:
        raise ValueError("no columns to encode")
    text = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    counts = text.unpivot([], list(cols), "column", "level").where("level IS NOT NULL").groupBy("column", "level").agg(F.count("*").alias("n"))
    digest = F.md5(F.col("level").cast("binary"))
    ready = counts.withColumns({"_digest": digest, "_range": F.substring(digest, 1, RANGE_DIGITS)})
    if drop_first:
        base = counts.groupBy(F.col("column").alias("_column")).agg(F.min("level").alias("_base"))
        ready = ready.join(base, F.col("column") == F.col("_column")).withColumn("_kept", F.col("level") != F.col("_base"))
    else:
        ready = ready.withColumn("_kept", F.lit(True))
    inside = Window.partitionBy("column", "_range").orderBy("_digest", "level").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    over = Window.partitionBy("column").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ready.groupBy("column", "_range").agg(F.count_if("_kept").alias("_held"))
    ranges = ranges.select("column", "_range", F.coalesce(F.sum("_held").over(over), F.lit(0)).alias("_before"))
    placed = ready.withColumn("_place", F.count_if("_kept").over(inside) - 1).join(ranges, ["column", "_range"])
    return placed.select("column", "level", "n", F.when(F.col("_kept"), F.col("_before") + F.col("_place")).alias("id"))


def level_ids(df: DataFrame, levels: DataFrame, cols: Sequence[str], suffix: str = "_id") -> DataFrame:
    """Add ``<column><suffix>``: NULL for a NULL value, the base level, and a level the dictionary doesn't have.

    One plain join per column: adaptive execution broadcasts a small dictionary by measured bytes, and else splits hot levels.
    """
    taken = {c.lower() for c in df.columns}
    clash = [f"{c}{suffix}" for c in cols if f"{c}{suffix}".lower() in taken]
    if clash:
        raise ValueError(f"the table already has {', '.join(clash)}")
    for c in cols:
        key, out = f"_level_of_{c}", f"{c}{suffix}"
        own = levels.where((F.col("column") == c) & F.col("id").isNotNull()).select(F.col("level").alias(key), F.col("id").alias(out))
        df = df.join(own, F.col(c).cast("string") == F.col(key), "left").drop(key)
    return df


def sparse_vector(size: int, entries: Column) -> Column:
    """A sparse vector from an array of (i, x) in rising order of i; entries without i, and zeros, are left out.

    MLlib has no function from indices and values to a vector; the vector type is read from JSON instead, which stays in
    the JVM and gives every double back exactly.
    """
    held = F.filter(entries, lambda e: e["i"].isNotNull() & (e["x"] != 0))
    parts = F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"),
        F.transform(held, lambda e: e["i"].cast("int")).alias("indices"), F.transform(held, lambda e: e["x"]).alias("values"),
    )
    return F.from_json(F.to_json(F.struct(parts.alias("v"))), T.StructType([T.StructField("v", VectorUDT())]))["v"]


@dataclass(frozen=True)
class LevelEncoder:
    """Fitted levels: a stored dictionary, the ids per column, and each column's most frequent level."""

    path: str
    spark: SparkSession
    cols: tuple[str, ...]
    sizes: dict[str, int]
    modes: dict[str, str | None]

    @property
    def levels(self) -> DataFrame:
        return io.read_table(self.spark, self.path)

    def width(self, numeric: Sequence[str] = ()) -> int:
        return len(numeric) + sum(self.sizes.values())

    def transform(self, df: DataFrame, numeric: Sequence[str] = (), out: str = "features", fill_mode: bool = False) -> DataFrame:
        """Add a sparse vector: the ``numeric`` columns (NULL as NaN), then the levels of each column.

        A level unseen in the fit has zeros, and so has NULL, unless ``fill_mode`` puts the most frequent level in its place.
        """
        if out.lower() in {c.lower() for c in df.columns}:
            raise ValueError(f"the table already has {out}")
        size = self.width(numeric)
        if not 0 < size < 2**31:
            raise ValueError(f"a vector can't have {size} entries")
        raw, keys = df, {c: f"_value_of_{c}" for c in self.cols}
        for c in self.cols:
            value = F.col(c).cast("string")
            raw = raw.withColumn(keys[c], F.coalesce(value, F.lit(self.modes[c]).cast("string")) if fill_mode else value)
        used = {keys[c]: c for c in self.cols}
        named = self.levels.where(F.col("column").isin(list(self.cols)))
        named = named.withColumn("column", F.concat(F.lit("_value_of_"), "column"))
        coded = level_ids(raw, named, list(used), "_id")
        nan = F.lit(float("nan"))
        entries = [F.struct(F.lit(i).cast("bigint").alias("i"), F.coalesce(F.col(c).cast("double"), nan).alias("x")) for i, c in enumerate(numeric)]
        before = len(numeric)
        for k, c in used.items():
            entries.append(F.struct((F.col(f"{k}_id") + before).cast("bigint").alias("i"), F.lit(1.0).alias("x")))
            before += self.sizes[c]
        return coded.select(*df.columns, sparse_vector(size, F.array(*entries)).alias(out))

    def names(self, numeric: Sequence[str] = ()) -> DataFrame:
        """(i, name) of all entries of the vector, as a table."""
        starts, before = {}, len(numeric)
        for c in self.cols:
            starts[c], before = before, before + self.sizes[c]
        start = F.create_map(*[F.lit(x) for c in self.cols for x in (c, starts[c])])
        coded = self.levels.where("id IS NOT NULL").select(
            (F.try_element_at(start, F.col("column")) + F.col("id")).cast("bigint").alias("i"), F.concat_ws("_", "column", "level").alias("name")
        )
        own = self.spark.createDataFrame([(i, c) for i, c in enumerate(numeric)], "i bigint, name string")
        return own.unionByName(coded)


def fit_levels(train: DataFrame, cols: Sequence[str], path: str | None = None, drop_first: bool = True) -> LevelEncoder:
    """Learn the levels of ``cols``; the dictionary is written to ``path``, or to a fresh folder under ``spark.checkpoint.dir``."""
    spark = train.sparkSession
    path = path or io.fresh_folder(spark, "levels")
    io.write_table(level_table(train, cols, drop_first), path, mode="errorifexists")
    return load_levels(spark, path, cols)


def load_levels(spark: SparkSession, path: str, cols: Sequence[str]) -> LevelEncoder:
    """An encoder from a stored dictionary; one count and one text per column come to the driver."""
    levels = io.read_table(spark, path)
    top = F.min_by("level", F.struct(-F.col("n"), F.col("level"))).alias("mode")
    found = {r["column"]: r for r in levels.where(F.col("column").isin(list(cols))).groupBy("column").agg(F.count("id").alias("size"), top).collect()}
    sizes = {c: found[c]["size"] if c in found else 0 for c in cols}
    return LevelEncoder(path, spark, tuple(cols), sizes, {c: found[c]["mode"] if c in found else None for c in cols})
