"""Level dictionaries and sparse one-hot vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.checks.features import split_sql
from demandframe.checks.registry import Tables, check, plain
from demandframe.operators import levels, prep

#: Line items with gaps; the part number has a level for nearly every part.
GAPPY = """
SELECT l_orderkey, l_linenumber, l_quantity, CAST(CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_partkey END AS VARCHAR(20)) AS part,
       CASE WHEN l_suppkey % 7 = 0 THEN NULL ELSE l_returnflag END AS flag FROM {lineitem}"""

LEVELS_SQL = """SELECT name AS "column", level, n, CASE WHEN level <> base THEN rank() OVER (PARTITION BY name, level <> base ORDER BY md5(level)) - 1 END AS id
FROM (SELECT *, min(level) OVER (PARTITION BY name) AS base FROM (
  SELECT 'part' AS name, part AS level, count(*) AS n FROM {x} WHERE part IS NOT NULL GROUP BY part
  UNION ALL SELECT 'flag', flag, count(*) FROM {x} WHERE flag IS NOT NULL GROUP BY flag))"""


@check("level_table", f"WITH x AS ({plain(GAPPY)}) {LEVELS_SQL.format(x='x')}")
def _(t: Tables) -> DataFrame:
    return levels.level_table(t.view(GAPPY), ["part", "flag"])


def _sparse_sql(fill: bool) -> str:
    part, flag = (f"coalesce(x.{c}, (SELECT level FROM d WHERE name = '{c}' ORDER BY n DESC, level LIMIT 1))" if fill else f"x.{c}" for c in ("part", "flag"))
    return f"""WITH x AS (SELECT *, {split_sql('l_orderkey')} AS split FROM ({plain(GAPPY)})), seen AS (SELECT * FROM x WHERE split = 'train'),
        d AS (SELECT "column" AS name, level, n, id FROM ({LEVELS_SQL.format(x='seen')})),
        w AS (SELECT count(id) AS parts, 1 + count(id) + (SELECT count(id) FROM d WHERE name = 'flag') AS width FROM d WHERE name = 'part')
        SELECT l_orderkey, l_linenumber, CAST(width AS INT) AS width,
               concat_ws(' ', CASE WHEN l_quantity <> 0 THEN '0' END, CAST(p.id + 1 AS VARCHAR), CAST(f.id + 1 + parts AS VARCHAR)) AS held, l_quantity AS first_value
        FROM x CROSS JOIN w LEFT JOIN d p ON p.name = 'part' AND p.level = {part} LEFT JOIN d f ON f.name = 'flag' AND f.level = {flag}"""


def _sparse(t: Tables, fill: bool) -> DataFrame:
    lines = prep.split(t.view(GAPPY), "l_orderkey")
    coder = levels.fit_levels(lines.where("split = 'train'"), ["part", "flag"])
    v = F.unwrap_udt(F.col("features"))
    return coder.transform(lines, ["l_quantity"], fill_mode=fill).select(
        "l_orderkey", "l_linenumber", v["size"].alias("width"), F.concat_ws(" ", v["indices"].cast("array<string>")).alias("held"), v["values"][0].alias("first_value")
    )


@check("onehot_sparse", _sparse_sql(False))
def onehot_sparse(t: Tables) -> DataFrame:
    """Levels learned from the training rows, all rows encoded; unseen levels and NULL have zeros."""
    return _sparse(t, False)


@check("onehot_sparse_by_mode", _sparse_sql(True))
def onehot_sparse_by_mode(t: Tables) -> DataFrame:
    return _sparse(t, True)
