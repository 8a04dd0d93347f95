"""Descriptive statistics, sorting and picking."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.checks.cleaning import HOLES
from demandframe.checks.features import GAPPY_LINES
from demandframe.checks.registry import Tables, check, plain, rounded
from demandframe.operators import lookup, profile, ranking

NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def per_column(cols: list[str], body: str, source: str) -> str:
    return " UNION ALL ".join(f"""SELECT '{c}' AS "column", {body.replace('$', c)} FROM {source}""" for c in cols)


DESCRIBE = """count($) AS count, round(avg($), 6) AS mean, round(stddev_samp($), 6) AS std, min($) AS min, round(quantile_cont($, 0.25), 6) AS q25,
              round(quantile_cont($, 0.5), 6) AS q50, round(quantile_cont($, 0.75), 6) AS q75, max($) AS max"""


@check("describe", per_column(NUMBERS, DESCRIBE, "lineitem"))
def _(t: Tables) -> DataFrame:
    return rounded(profile.describe(t.lineitem, NUMBERS))


@check("describe_ranked", per_column(NUMBERS, DESCRIBE, "lineitem"))
def _(t: Tables) -> DataFrame:
    """Columns with one value, with few values and with none beside ordinary ones."""
    x = t.lineitem.withColumns({c: F.col(c).cast("double") for c in NUMBERS})
    return rounded(profile.describe(x.withColumn("none", F.lit(None).cast("double")), [*NUMBERS, "none"]).where("column <> 'none'"))


LABELS = ["l_returnflag", "l_linestatus"]
TOP = """count($) AS count, count(DISTINCT $) AS "unique", (SELECT $ FROM lineitem GROUP BY $ ORDER BY count(*) DESC, $ LIMIT 1) AS top,
         (SELECT count(*) FROM lineitem GROUP BY $ ORDER BY 1 DESC LIMIT 1) AS freq"""


@check("describe_text", per_column(LABELS, TOP, "lineitem"))
def _(t: Tables) -> DataFrame:
    return profile.describe_text(t.lineitem, LABELS)


@check(
    "category_profile",
    per_column(
        ["p_brand", "p_type"],
        """(SELECT $ FROM part GROUP BY $ ORDER BY count(*) DESC, $ LIMIT 1) AS mode, count(DISTINCT $) AS cardinality,
           (SELECT count(*) FROM part GROUP BY $ ORDER BY 1 DESC LIMIT 1) AS top_frequency,
           round((SELECT count(*) FROM part GROUP BY $ ORDER BY 1 DESC LIMIT 1) * 100.0 / count($), 6) AS top_share""",
        "part",
    ),
)
def _(t: Tables) -> DataFrame:
    return rounded(profile.category_profile(t.part, ["p_brand", "p_type"]))


@check(
    "null_profile",
    f"""WITH x AS ({plain(HOLES)}) SELECT * FROM ({per_column(['event_id', 'user_id', 'v', 'w'], 'count(*) - count($) AS n_null, round((count(*) - count($)) * 100.0 / count(*), 6) AS pct', 'x')})
        WHERE n_null > 0""",
)
def _(t: Tables) -> DataFrame:
    return rounded(profile.null_profile(t.view(HOLES)))


QS = [0.1, 0.25, 0.5, 0.75, 0.99]
Q_SQL = " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", CAST({q} AS DOUBLE) AS quantile, round(quantile_cont({c}, {q}), 6) AS value FROM x""" for c in ["l_quantity", "l_extendedprice", "l_discount"] for q in QS
)


@check("quantiles", f"WITH x AS ({plain(GAPPY_LINES)}) {Q_SQL}")
def _(t: Tables) -> DataFrame:
    return rounded(profile.quantiles(t.view(GAPPY_LINES), ["l_quantity", "l_extendedprice", "l_discount"], QS))


@check("quantiles_ranked", f"WITH x AS ({plain(GAPPY_LINES)}) {Q_SQL}")
def _(t: Tables) -> DataFrame:
    return rounded(profile.quantiles(t.view(GAPPY_LINES), ["l_quantity", "l_extendedprice", "l_discount"], QS))


@check(
    "quantiles_by_group",
    " UNION ALL ".join(
        f"SELECT event_type, 'value' AS \"column\", CAST({q} AS DOUBLE) AS quantile, round(quantile_cont(value, {q}), 6) AS value FROM events GROUP BY event_type" for q in QS
    ),
)
def _(t: Tables) -> DataFrame:
    return rounded(profile.quantiles(t.events, ["value"], QS, ["event_type"]))


@check("quantiles_approximate", " UNION ALL ".join(f"SELECT CAST({q} AS DOUBLE) AS quantile, 1 AS close FROM region WHERE r_regionkey = 0" for q in QS))
def _(t: Tables) -> DataFrame:
    """The sketch: the share of rows up to each estimate must be within half a percent of the wanted one."""
    price = F.col("l_extendedprice")
    found = profile.quantiles(t.lineitem, ["l_extendedprice"], QS, accuracy=1000)
    wide = found.agg(*[F.max(F.when(F.col("quantile") == q, F.col("value"))).alias(f"q{i}") for i, q in enumerate(QS)])
    ready = lookup.attach_row(t.lineitem.select("l_extendedprice"), wide)
    shares = ready.agg(*[F.avg((price <= F.col(f"_stats.q{i}")).cast("double")).alias(f"s{i}") for i in range(len(QS))])
    cells = [F.struct(F.lit(q).alias("quantile"), (F.abs(F.col(f"s{i}") - q) <= 0.005).cast("int").alias("close")) for i, q in enumerate(QS)]
    return shares.select(F.inline(F.array(*cells)))


@check("shape_stats", per_column(["l_quantity", "l_extendedprice", "l_tax"], "round(skewness($), 6) AS skewness, round(kurtosis($), 6) AS kurtosis", "lineitem"))
def _(t: Tables) -> DataFrame:
    return rounded(profile.shape_stats(t.lineitem, ["l_quantity", "l_extendedprice", "l_tax"]))


def _fence(c: str, k: float = 0.4) -> str:
    return f"({c} < a_{c} - {k} * (b_{c} - a_{c}) OR {c} > b_{c} + {k} * (b_{c} - a_{c}))"


OUT = ["l_quantity", "l_extendedprice"]
OUT_CTE = f"""WITH q AS (SELECT {', '.join(f'quantile_cont({c}, 0.25) AS a_{c}, quantile_cont({c}, 0.75) AS b_{c}' for c in OUT)} FROM lineitem),
  x AS (SELECT *, {', '.join(f'{_fence(c)} AS o_{c}' for c in OUT)} FROM lineitem, q)"""


@check(
    "outlier_profile",
    f"""{OUT_CTE} SELECT 'l_quantity' AS "column", count(*) FILTER (o_l_quantity) AS n_out, round(count(*) FILTER (o_l_quantity) * 100.0 / count(*), 6) AS pct FROM x
        UNION ALL SELECT 'l_extendedprice', count(*) FILTER (o_l_extendedprice), round(count(*) FILTER (o_l_extendedprice) * 100.0 / count(*), 6) FROM x
        UNION ALL SELECT '*', count(*) FILTER (o_l_extendedprice OR o_l_quantity), round(count(*) FILTER (o_l_extendedprice OR o_l_quantity) * 100.0 / count(*), 6) FROM x""",
)
def _(t: Tables) -> DataFrame:
    return rounded(profile.outlier_profile(t.lineitem, OUT, 0.4))


@check("drop_outlier_rows", f"{OUT_CTE} SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM x WHERE NOT o_l_quantity AND NOT o_l_extendedprice")
def _(t: Tables) -> DataFrame:
    return profile.drop_outlier_rows(t.lineitem.select("l_orderkey", "l_linenumber", *OUT), OUT, 0.4)


@check("value_counts", "SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderpriority")
def _(t: Tables) -> DataFrame:
    return profile.value_counts(t.orders, "o_orderpriority")


@check(
    "histogram",
    """WITH r AS (SELECT min(value) AS a, max(value) AS b, (max(value) - min(value)) / 50 AS w FROM events),
            h AS (SELECT CAST(least(floor((value - a) / w), 49) AS BIGINT) AS bin, count(*) AS n FROM events, r GROUP BY 1)
       SELECT s.bin, round(a + s.bin * w, 6) AS lo, round(a + (s.bin + 1) * w, 6) AS hi, coalesce(n, 0) AS n
       FROM (SELECT unnest(range(50)) AS bin) s LEFT JOIN h ON s.bin = h.bin, r""",
)
def _(t: Tables) -> DataFrame:
    return rounded(profile.histogram(t.events, "value", 50))


BOX = """count(*) AS n, round(max(q1), 6) AS q1, round(max(q2), 6) AS median, round(max(q3), 6) AS q3,
         round(min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) THEN value END), 6) AS whisker_lo,
         round(max(CASE WHEN value <= q3 + 1.5 * (q3 - q1) THEN value END), 6) AS whisker_hi,
         count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS n_out"""
QUARTERS = "quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS q2, quantile_cont(value, 0.75) AS q3"


@check("box_stats", f"SELECT {BOX} FROM events, (SELECT {QUARTERS} FROM events)")
def _(t: Tables) -> DataFrame:
    return rounded(profile.box_stats(t.events, "value"))


@check(
    "box_stats_by_category",
    f"SELECT e.event_type, {BOX} FROM events e JOIN (SELECT event_type, {QUARTERS} FROM events GROUP BY event_type) q ON e.event_type = q.event_type GROUP BY e.event_type",
)
def _(t: Tables) -> DataFrame:
    return rounded(profile.box_stats(t.events, "value", ["event_type"]))


@check(
    "pivot_mean",
    "SELECT hr, " + ", ".join(f"round(avg(value) FILTER (wd = {d}), 6) AS d{d}" for d in range(7))
    + " FROM (SELECT CAST(hour(ts) AS INT) AS hr, isodow(ts) - 1 AS wd, value FROM events) GROUP BY hr",
)
def _(t: Tables) -> DataFrame:
    x = t.events.select(F.hour("ts").alias("hr"), F.weekday("ts").alias("wd"), "value")
    return rounded(profile.pivot_mean(x, "hr", "wd", "value", range(7), "d"))


@check(
    "correlations",
    " UNION ALL ".join(f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS corr FROM lineitem" for a in NUMBERS for b in NUMBERS),
)
def _(t: Tables) -> DataFrame:
    return rounded(profile.correlations(t.lineitem, NUMBERS))


@check("crosstab", "SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM orders GROUP BY o_orderstatus, o_orderpriority")
def _(t: Tables) -> DataFrame:
    return profile.crosstab(t.orders, "o_orderstatus", "o_orderpriority")


@check(
    "invalid_values",
    "SELECT DISTINCT CAST(CASE WHEN event_id % 7 = 0 THEN 90 + event_id % 5 WHEN event_id % 11 = 0 THEN NULL ELSE event_id % 4 + 1 END AS BIGINT) AS c FROM events WHERE event_id % 7 = 0 OR event_id % 11 = 0",
)
def _(t: Tables) -> DataFrame:
    e = F.col("event_id")
    c = F.when(e % 7 == 0, 90 + e % 5).when(e % 11 == 0, F.lit(None)).otherwise(e % 4 + 1)
    return profile.invalid_values(t.events.select(c.alias("c")), "c", [1, 2, 3, 4])


@check(
    "table_info",
    f"""WITH x AS ({plain(HOLES)})
        SELECT 0 AS position, 'event_id' AS "column", 'bigint' AS type, count(event_id) AS non_null, count(*) AS n_rows FROM x
        UNION ALL SELECT 1, 'user_id', 'bigint', count(user_id), count(*) FROM x UNION ALL SELECT 2, 'v', 'double', count(v), count(*) FROM x
        UNION ALL SELECT 3, 'w', 'double', count(w), count(*) FROM x""",
)
def _(t: Tables) -> DataFrame:
    return profile.table_info(t.view(HOLES))


# ---- sorting and picking -------------------------------------------------------------------


@check("sort", "SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def _(t: Tables) -> DataFrame:
    x = t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority")
    return ranking.sort(x, [("o_orderpriority", "asc"), ("o_totalprice", "desc")], ["o_orderkey"])


@check("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t: Tables) -> DataFrame:
    return ranking.top_k(t.orders.select("o_orderkey", "o_totalprice"), [("o_totalprice", "desc")], 10, ["o_orderkey"])


@check(
    "arg_min_and_max",
    """SELECT * FROM (SELECT 'least' AS which, o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 1)
       UNION ALL SELECT * FROM (SELECT 'most', o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 1)
       UNION ALL SELECT * FROM (SELECT 'first', o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 1)""",
)
def _(t: Tables) -> DataFrame:
    x = t.orders.select("o_orderkey", "o_totalprice")
    low = ranking.arg_min(x, "o_totalprice", "o_orderkey").select(F.lit("least").alias("which"), "*")
    high = ranking.arg_max(x, "o_totalprice", "o_orderkey").select(F.lit("most").alias("which"), "*")
    head = ranking.first_row(x, "o_orderkey").select(F.lit("first").alias("which"), "*")
    return low.unionByName(high).unionByName(head)
