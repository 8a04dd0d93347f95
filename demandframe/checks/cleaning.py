"""Typing and repair."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.checks.registry import Tables, check, plain, rounded
from demandframe.functions import columns as fc
from demandframe.operators import lookup, ordered, repair, typing
from demandframe.operators.ordered import Blocking
from demandframe.plans import clean as clean_plan

BY_ID = Blocking(block_size=1000)
# borders taken from the data instead of from a known width
SAMPLED = Blocking(rows_per_block=700, fraction=0.5)

# ---- typing --------------------------------------------------------------------------------

DIRTY_NUMBERS = """
SELECT event_id,
       CASE WHEN event_id % 17 = 0 THEN 'bad' WHEN event_id % 29 = 0 THEN '1d'
            WHEN event_id % 23 = 0 THEN '  ' || CAST(value AS STRING) || ' ' ELSE CAST(value AS STRING) END AS v,
       CASE WHEN event_id % 13 = 0 THEN 'n/a' WHEN event_id % 19 = 0 THEN '' ELSE CAST(user_id AS STRING) END AS u
FROM {events}"""


@check(
    "coerce_numeric",
    """SELECT event_id, CASE WHEN event_id % 17 = 0 OR event_id % 29 = 0 THEN NULL ELSE value END AS v,
              CASE WHEN event_id % 13 = 0 OR event_id % 19 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS u FROM events""",
)
def _(t: Tables) -> DataFrame:
    return typing.coerce_numeric(t.view(DIRTY_NUMBERS), ["v", "u", "not_there"])


@check(
    "non_numeric_values",
    f"""WITH x AS ({plain(DIRTY_NUMBERS)})
        SELECT 'v' AS "column", v AS value, count(*) AS n FROM x WHERE TRY_CAST(trim(v) AS DOUBLE) IS NULL GROUP BY v
        UNION ALL SELECT 'u', u, count(*) FROM x WHERE TRY_CAST(trim(u) AS DOUBLE) IS NULL GROUP BY u""",
)
def _(t: Tables) -> DataFrame:
    return typing.non_numeric_values(t.view(DIRTY_NUMBERS), ["v", "u"])


@check(
    "to_nullable_int",
    """SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE CAST(round_even(l_quantity / 2, 0) AS BIGINT) END AS half_qty
       FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    x = t.lineitem.select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 17 != 0, F.col("l_quantity") / 2).alias("half_qty"))
    return typing.to_nullable_int(x, ["half_qty"])


DIRTY_DATES = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 13 = 0 THEN '2011-02-30' WHEN o_orderkey % 11 = 0 THEN '  ' || d || ' '
            WHEN o_orderkey % 17 = 0 THEN d || ' 00:00' WHEN o_orderkey % 19 = 0 THEN replace(d, '-', '/')
            WHEN o_orderkey % 23 = 0 THEN replace(d, '-', '') ELSE d END AS d
FROM (SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS STRING) AS d FROM {orders}) z"""


@check(
    "parse_date",
    f"""SELECT o_orderkey, CASE WHEN regexp_full_match(trim(d), '[0-9]{{4}}-[0-9]+-[0-9]+') THEN TRY_CAST(trim(d) AS DATE) END AS d
        FROM ({plain(DIRTY_DATES)})""",
)
def _(t: Tables) -> DataFrame:
    return typing.parse_date(t.view(DIRTY_DATES), "d")


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
ODD_PRIORITY = """SELECT o_orderkey, CASE WHEN o_orderkey % 19 = 0 THEN 'ZZ' WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderpriority END AS p FROM {orders}"""


@check("to_category", f"SELECT o_orderkey, CASE WHEN p <> 'ZZ' THEN p END AS p FROM ({plain(ODD_PRIORITY)})")
def _(t: Tables) -> DataFrame:
    return typing.to_category(t.view(ODD_PRIORITY), "p", PRIORITIES)


@check(
    "cast_columns",
    f"""SELECT o_orderkey, CAST(o_orderkey AS DOUBLE) AS k, CAST(o_orderkey % 3 = 0 AS INT) AS f, coalesce(p, 'nan') AS p
        FROM ({plain(ODD_PRIORITY)})""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(ODD_PRIORITY).select("o_orderkey", F.col("o_orderkey").alias("k"), (F.col("o_orderkey") % 3 == 0).alias("f"), "p")
    return typing.cast_columns(x, double=["k"], flags=["f"], text=["p"])


@check("select_kind", "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def _(t: Tables) -> DataFrame:
    return typing.select_kind(t.lineitem, "number")


@check(
    "date_parts",
    """SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year, CAST(month(o_orderdate) AS INT) AS month,
              CAST(isodow(o_orderdate) - 1 AS INT) AS weekday FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return typing.date_parts(t.orders, "o_orderdate").select("o_orderkey", "year", "month", "weekday")


# ---- calendar ------------------------------------------------------------------------------

CODED_DAYS = """
SELECT event_id, CASE WHEN event_id % 37 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS d,
       CAST(CASE WHEN event_id % 19 = 0 THEN 9 WHEN event_id % 31 = 0 THEN NULL ELSE day(ts) % 4 + 1 END AS BIGINT) AS c
FROM {events}"""


@check(
    "repair_from_group",
    f"""WITH x AS ({plain(CODED_DAYS)}),
             g AS (SELECT d, arg_min(c, event_id) AS g FROM x WHERE c IN (1, 2, 3, 4) GROUP BY d)
        SELECT x.event_id, x.d, CASE WHEN x.c IN (1, 2, 3, 4) THEN x.c ELSE coalesce(g.g, x.c) END AS c
        FROM x LEFT JOIN g ON x.d = g.d""",
)
def _(t: Tables) -> DataFrame:
    return repair.repair_from_group(t.view(CODED_DAYS), "c", [1, 2, 3, 4], ["d"], "event_id")


@check(
    "lookup_first",
    f"""WITH x AS ({plain(CODED_DAYS)}), g AS (SELECT d, arg_min(c, event_id) AS c_first FROM x WHERE c <> 9 GROUP BY d)
        SELECT x.event_id, x.d, x.c, g.c_first FROM x LEFT JOIN g ON x.d = g.d""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(CODED_DAYS)
    return lookup.lookup_first(x, x.where("c <> 9"), ["d"], "c", "event_id").select("event_id", "d", "c", "c_first")


ORDER_CALENDAR = """
SELECT o_orderkey, CASE WHEN o_orderkey % 37 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d,
       CAST(CASE WHEN o_orderkey % 7 = 0 THEN 99 WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderkey % 2 END AS BIGINT) AS yr,
       CAST(CASE WHEN o_orderkey % 7 = 1 THEN 99 WHEN o_orderkey % 11 = 1 THEN NULL ELSE month(o_orderdate) END AS BIGINT) AS mnth,
       CAST(CASE WHEN o_orderkey % 7 = 2 THEN 99 WHEN o_orderkey % 11 = 2 THEN NULL ELSE o_orderkey % 2 END AS BIGINT) AS workingday,
       CAST(CASE WHEN o_orderkey % 7 = 3 THEN 99 WHEN o_orderkey % 11 = 3 THEN NULL ELSE o_orderkey % 7 END AS BIGINT) AS weekday,
       CAST(CASE WHEN o_orderkey % 5 = 0 THEN 1 WHEN o_orderkey % 3 = 0 THEN NULL ELSE 0 END AS BIGINT) AS holiday
FROM {orders}"""
CODES = {1995: 0, 1996: 1}


@check(
    "year_code",
    f"""SELECT o_orderkey, CASE WHEN yr IN (0, 1) THEN yr WHEN d IS NULL THEN yr WHEN year(d) = 1995 THEN 0 WHEN year(d) = 1996 THEN 1 END AS yr
        FROM ({plain(ORDER_CALENDAR)})""",
)
def _(t: Tables) -> DataFrame:
    x = repair.derive_when_invalid(t.view(ORDER_CALENDAR), "yr", [0, 1], repair.year_code("yr", "d", CODES))
    return x.select("o_orderkey", "yr")


@check(
    "month_repair",
    f"SELECT o_orderkey, CASE WHEN mnth BETWEEN 1 AND 12 THEN mnth ELSE month(d) END AS mnth FROM ({plain(ORDER_CALENDAR)})",
)
def _(t: Tables) -> DataFrame:
    x = repair.derive_when_invalid(t.view(ORDER_CALENDAR), "mnth", range(1, 13), F.month("d").cast("bigint"))
    return x.select("o_orderkey", "mnth")


WORKING_SQL = """CASE WHEN workingday IN (0, 1) THEN workingday WHEN d IS NULL THEN NULL
                      WHEN isodow(d) >= 6 OR coalesce(holiday = 1, FALSE) THEN 0 ELSE 1 END"""


@check("working_day_repair", f"SELECT o_orderkey, CAST({WORKING_SQL} AS BIGINT) AS workingday FROM ({plain(ORDER_CALENDAR)})")
def _(t: Tables) -> DataFrame:
    x = repair.derive_when_invalid(t.view(ORDER_CALENDAR), "workingday", [0, 1], repair.working_day("d", "holiday"))
    return x.select("o_orderkey", "workingday")


@check(
    "weekday_repair",
    f"SELECT o_orderkey, CASE WHEN weekday BETWEEN 0 AND 6 THEN weekday ELSE isodow(d) - 1 END AS weekday FROM ({plain(ORDER_CALENDAR)})",
)
def _(t: Tables) -> DataFrame:
    x = repair.derive_when_invalid(t.view(ORDER_CALENDAR), "weekday", range(7), F.weekday("d").cast("bigint"))
    return x.select("o_orderkey", "weekday")


@check(
    "calendar_repairs",
    f"""SELECT o_orderkey, d, CASE WHEN yr IN (0, 1) THEN yr WHEN d IS NULL THEN yr WHEN year(d) = 1995 THEN 0 WHEN year(d) = 1996 THEN 1 END AS yr,
               CASE WHEN mnth BETWEEN 1 AND 12 THEN mnth ELSE month(d) END AS mnth, CAST({WORKING_SQL} AS BIGINT) AS workingday,
               CASE WHEN weekday BETWEEN 0 AND 6 THEN weekday ELSE isodow(d) - 1 END AS weekday, holiday
        FROM ({plain(ORDER_CALENDAR)})""",
)
def _(t: Tables) -> DataFrame:
    return repair.calendar_repairs(t.view(ORDER_CALENDAR), "d", "yr", "mnth", "workingday", "weekday", "holiday", CODES)


FREE_DAYS = [f"{y}-{md}" for y in range(1995, 2002) for md in ("01-01", "05-01", "07-14")]
FREE_SQL = ", ".join(f"DATE '{d}'" for d in FREE_DAYS)


@check(
    "calendar_flag",
    f"SELECT o_orderkey, d, CAST(coalesce(d IN ({FREE_SQL}), FALSE) AS INT) AS holiday FROM ({plain(ORDER_CALENDAR)})",
)
def _(t: Tables) -> DataFrame:
    return repair.calendar_flag(t.view(ORDER_CALENDAR), "d", FREE_DAYS).select("o_orderkey", "d", "holiday")


@check(
    "flag_in",
    f"""SELECT o_orderkey, CAST(coalesce(d IN ({FREE_SQL}), FALSE) AS INT) AS by_list,
               CAST(coalesce(d IN (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderkey % 50 = 0), FALSE) AS INT) AS by_table
        FROM ({plain(ORDER_CALENDAR)})""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(ORDER_CALENDAR).select("o_orderkey", "d")
    x = lookup.flag_in(x, "d", [F.lit(d).cast("date") for d in FREE_DAYS], "by_list")
    days = t.orders.where("o_orderkey % 50 = 0").select(F.col("o_orderdate").cast("date").alias("d"))
    return lookup.flag_in(x, "d", days, "by_table").select("o_orderkey", "by_list", "by_table")


# ---- bounds and fills ----------------------------------------------------------------------

HOLES = """
SELECT event_id, user_id, CASE WHEN event_id % 17 = 0 THEN NULL ELSE value END AS v,
       CASE WHEN event_id % 3 = 0 THEN NULL ELSE value * 2 END AS w FROM {events}"""
AHEAD = "ORDER BY event_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING"


@check("bound_to_null", f"SELECT event_id, user_id, CASE WHEN v <= 60 THEN v END AS v, CASE WHEN w <= 90 THEN w END AS w FROM ({plain(HOLES)})")
def _(t: Tables) -> DataFrame:
    return repair.bound_to_null(t.view(HOLES), {"v": 60, "w": 90})


FILLED_SQL = f"""
SELECT event_id, user_id, first_value(v IGNORE NULLS) OVER ({AHEAD}) AS v, first_value(w IGNORE NULLS) OVER ({AHEAD}) AS w
FROM (SELECT event_id, user_id, CASE WHEN v <= 60 THEN v END AS v, CASE WHEN w <= 90 THEN w END AS w FROM ({plain(HOLES)}))"""


@check("fill_next_valid", FILLED_SQL)
def _(t: Tables) -> DataFrame:
    return repair.bound_and_fill(t.view(HOLES), {"v": 60, "w": 90}, "event_id", blocking=BY_ID)


@check("fill_next_valid_sampled_borders", FILLED_SQL)
def _(t: Tables) -> DataFrame:
    return repair.bound_and_fill(t.view(HOLES), {"v": 60, "w": 90}, "event_id", blocking=SAMPLED)


@check(
    "fill_next_valid_keyed",
    f"""SELECT event_id, user_id, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id {AHEAD}) AS v,
               first_value(w IGNORE NULLS) OVER (PARTITION BY user_id {AHEAD}) AS w FROM ({plain(HOLES)})""",
)
def _(t: Tables) -> DataFrame:
    return ordered.fill_next_valid(t.view(HOLES), ["v", "w"], "event_id", ["user_id"], Blocking(block_size=3000))


@check(
    "clip_columns",
    f"SELECT event_id, user_id, CASE WHEN v IS NOT NULL THEN least(greatest(v, 5.0), 50.0) END AS v, CASE WHEN w IS NOT NULL THEN greatest(w, 20.0) END AS w FROM ({plain(HOLES)})",
)
def _(t: Tables) -> DataFrame:
    return repair.clip_columns(t.view(HOLES), {"v": (5.0, 50.0), "w": (20.0, None)})


# ---- outliers and counts -------------------------------------------------------------------

COUNTS = """
SELECT event_id, CAST(CASE WHEN event_id % 43 = 0 THEN NULL WHEN event_id % 47 = 0 THEN -k ELSE k END AS DOUBLE) AS a,
       CAST(CASE WHEN event_id % 53 = 0 THEN b * 50 WHEN event_id % 61 = 0 THEN NULL ELSE b + 0.5 * (event_id % 2) END AS DOUBLE) AS b,
       CAST(CASE WHEN event_id % 41 = 0 THEN k + b + 7 WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 67 = 0 THEN (k + b) * 40 ELSE k + b END AS DOUBLE) AS total
FROM (SELECT event_id, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, CAST(floor(value) AS BIGINT) AS b FROM {events}) z"""


def count_steps(source: str, a: str = "a", b: str = "b", total: str = "total", k: float = 2.5, rest: str = "event_id") -> str:
    """The count step as a chain of CTEs named whole, fences, replaced, filled, broken, fixed."""
    def fence(c: str) -> str:
        return f"quantile_cont({c}, 0.25) AS q1_{c}, quantile_cont({c}, 0.75) AS q3_{c}, CAST(round_even(quantile_cont({c}, 0.5), 0) AS BIGINT) AS m_{c}"

    def out(c: str) -> str:
        return f"coalesce({c} < q1_{c} - {k} * (q3_{c} - q1_{c}) OR {c} > q3_{c} + {k} * (q3_{c} - q1_{c}), FALSE)"

    def alone(c: str, o1: str, o2: str) -> str:
        return f"CASE WHEN {out(c)} AND NOT {out(o1)} AND NOT {out(o2)} THEN m_{c} ELSE {c} END AS {c}, CAST({out(c)} AND NOT {out(o1)} AND NOT {out(o2)} AND m_{c} IS DISTINCT FROM {c} AS INT) AS rep_{c}"

    keep = f"{rest}, " if rest else ""
    return f"""whole AS (SELECT {keep}abs(CAST(round_even({a}, 0) AS BIGINT)) AS {a}, abs(CAST(round_even({b}, 0) AS BIGINT)) AS {b},
                             abs(CAST(round_even({total}, 0) AS BIGINT)) AS {total} FROM {source}),
      fences AS (SELECT {fence(a)}, {fence(b)}, {fence(total)} FROM whole),
      replaced AS (SELECT {keep}{alone(a, b, total)}, {alone(b, a, total)}, {alone(total, a, b)} FROM whole, fences),
      filled1 AS (SELECT * REPLACE (coalesce({total}, {a} + {b}) AS {total}), {a} AS old_{a}, {b} AS old_{b}, {total} AS old_{total} FROM replaced),
      filled2 AS (SELECT * REPLACE (coalesce({a}, {total} - {b}) AS {a}) FROM filled1),
      filled AS (SELECT * REPLACE (coalesce({b}, {total} - {a}) AS {b}) FROM filled2),
      broken AS (SELECT *, CASE WHEN coalesce({a} + {b} <> {total}, FALSE) THEN
                    CASE WHEN {a} = greatest({a}, {b}, {total}) THEN 'a' WHEN {b} = greatest({a}, {b}, {total}) THEN 'b' ELSE 't' END
                 ELSE 'ok' END AS branch FROM filled),
      fixed AS (SELECT * REPLACE (CASE WHEN branch = 'a' THEN {total} - {b} ELSE {a} END AS {a},
                                  CASE WHEN branch = 'b' THEN {total} - {a} ELSE {b} END AS {b},
                                  CASE WHEN branch = 't' THEN {a} + {b} ELSE {total} END AS {total}) FROM broken)"""


CHAIN = f"WITH src AS ({plain(COUNTS)}), {count_steps('src')}"


@check("whole_counts", f"{CHAIN} SELECT event_id, a, b, total FROM whole")
def _(t: Tables) -> DataFrame:
    return repair.whole_counts(t.view(COUNTS), ["a", "b", "total"])


@check("replace_exclusive_outliers", f"{CHAIN} SELECT event_id, a, b, total FROM replaced")
def _(t: Tables) -> DataFrame:
    return repair.replace_exclusive_outliers(repair.whole_counts(t.view(COUNTS), ["a", "b", "total"]), ["a", "b", "total"], 2.5)


@check("fill_by_identity", f"WITH src AS ({plain(COUNTS)}), {count_steps('src', k=1e9)} SELECT event_id, a, b, total FROM filled")
def _(t: Tables) -> DataFrame:
    return repair.fill_by_identity(repair.whole_counts(t.view(COUNTS), ["a", "b", "total"]), "a", "b", "total")


@check("fix_identity", f"WITH src AS ({plain(COUNTS)}), {count_steps('src', k=1e9)} SELECT event_id, a, b, total FROM fixed")
def _(t: Tables) -> DataFrame:
    whole = repair.whole_counts(t.view(COUNTS), ["a", "b", "total"])
    return repair.fix_identity(repair.fill_by_identity(whole, "a", "b", "total"), "a", "b", "total")


@check("drop_incomplete_and_negative", f"SELECT event_id, a, b, total FROM ({plain(COUNTS)}) WHERE a >= 0 AND b >= 0 AND total >= 0")
def _(t: Tables) -> DataFrame:
    cols = ["a", "b", "total"]
    return repair.drop_negative(repair.drop_incomplete(t.view(COUNTS), cols), cols)


@check("repair_counts", f"{CHAIN} SELECT event_id, a, b, total FROM fixed WHERE a >= 0 AND b >= 0 AND total >= 0")
def _(t: Tables) -> DataFrame:
    return repair.repair_counts(t.view(COUNTS), "a", "b", "total")


def _measure(name: str, expr: str) -> str:
    return f"SELECT '{name}' AS measure, CAST(({expr}) AS BIGINT) AS n, round(({expr}) * 100.0 / count(*), 6) AS pct FROM j"


REPORT_SQL = (
    f"{CHAIN}, j AS (SELECT f.*, w.a AS wa, w.b AS wb, w.total AS wt FROM fixed f JOIN whole w ON f.event_id = w.event_id), "
    "k AS (SELECT 1) "
    + " UNION ALL ".join(
        _measure(n, e)
        for n, e in {
            "rows_before": "count(*)",
            "outliers_replaced_a": "sum(rep_a)", "outliers_replaced_b": "sum(rep_b)", "outliers_replaced_total": "sum(rep_total)",
            "null_before_a": "count(*) - count(old_a)", "null_before_b": "count(*) - count(old_b)", "null_before_total": "count(*) - count(old_total)",
            "null_after_a": "count(*) - count(a)", "null_after_b": "count(*) - count(b)", "null_after_total": "count(*) - count(total)",
            "inconsistent": "count(*) FILTER (branch <> 'ok')",
            "recomputed_a": "count(*) FILTER (branch = 'a')", "recomputed_b": "count(*) FILTER (branch = 'b')",
            "recomputed_total": "count(*) FILTER (branch = 't')",
            "still_inconsistent": "count(*) FILTER (a + b <> total)",
            "dropped_incomplete": "count(*) FILTER (a IS NULL OR b IS NULL OR total IS NULL)",
            "dropped_negative": "count(*) FILTER (a IS NOT NULL AND b IS NOT NULL AND total IS NOT NULL AND (a < 0 OR b < 0 OR total < 0))",
        }.items()
    )
)


@check("cleaning_report", REPORT_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(repair.cleaning_report(t.view(COUNTS), "a", "b", "total"))


def bounds_sql(source: str, cols: list[str], k: float) -> str:
    parts = []
    for c in cols:
        parts.append(
            f"""SELECT '{c}' AS "column", round(q1, 6) AS q1, round(q3, 6) AS q3, round(q3 - q1, 6) AS iqr, round(q1 - {k} * (q3 - q1), 6) AS lo,
                       round(q3 + {k} * (q3 - q1), 6) AS hi, count(*) FILTER ({c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1)) AS n_out,
                       round(count(*) FILTER ({c} < q1 - {k} * (q3 - q1) OR {c} > q3 + {k} * (q3 - q1)) * 100.0 / count(*), 6) AS pct
                FROM {source}, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {source}) GROUP BY q1, q3"""
        )
    return " UNION ALL ".join(parts)


PRICES = ["l_quantity", "l_extendedprice", "l_discount"]


@check("iqr_bounds", bounds_sql("lineitem", PRICES, 0.5))
def _(t: Tables) -> DataFrame:
    return rounded(repair.iqr_bounds(t.lineitem, PRICES, 0.5))


@check("iqr_bounds_ranked", bounds_sql("lineitem", PRICES, 0.5))
def _(t: Tables) -> DataFrame:
    return rounded(repair.iqr_bounds(t.lineitem, PRICES, 0.5))


@check(
    "iqr_flag",
    """SELECT event_id, value, CAST(value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) AS INT) AS value_outlier
       FROM events, (SELECT quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM events)""",
)
def _(t: Tables) -> DataFrame:
    return repair.iqr_flag(t.events, ["value"]).select("event_id", "value", "value_outlier")


# ---- duplicates and hours ------------------------------------------------------------------

LINES = """
SELECT l_orderkey, CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_linenumber END AS l_linenumber,
       l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus FROM {lineitem}"""
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]


@check(
    "dedupe_keep_first",
    f"""SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINE_ORDER)}) AS r
        FROM ({plain(LINES)})) WHERE r = 1""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(LINES).withColumn("o", F.struct(*LINE_ORDER))
    return repair.dedupe_keep_first(x, ["l_orderkey", "l_linenumber"], "o").drop("o")


HOUR_GROUPS = """
SELECT event_id, CASE WHEN event_id % 1009 = 0 THEN NULL WHEN event_id < 2400 THEN CAST(floor(event_id / 24) AS BIGINT)
            WHEN event_id < 4900 THEN 1000 + CAST(floor(event_id / 25) AS BIGINT)
            WHEN event_id < 6000 THEN 5000 ELSE 10000 + CAST(floor(event_id / 7) AS BIGINT) END AS g,
       CAST(hour(ts) AS BIGINT) AS hr FROM {events}"""


@check(
    "resequence_group",
    f"""SELECT event_id, g, CASE WHEN g IS NULL THEN NULL WHEN n IN (24, 25) THEN CASE WHEN s < 24 THEN s END ELSE hr END AS hr
        FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n, row_number() OVER (PARTITION BY g ORDER BY event_id) - 1 AS s FROM ({plain(HOUR_GROUPS)}))""",
)
def _(t: Tables) -> DataFrame:
    return repair.resequence_group(t.view(HOUR_GROUPS), "g", "hr", "event_id")


@check(
    "seq_in_group",
    f"SELECT event_id, g, hr, row_number() OVER (PARTITION BY g ORDER BY event_id) AS seq FROM ({plain(HOUR_GROUPS)})",
)
def _(t: Tables) -> DataFrame:
    return ordered.seq_in_group(t.view(HOUR_GROUPS), ["g"], "event_id", blocking=BY_ID)


@check("group_size", f"SELECT event_id, g, hr, count(*) OVER (PARTITION BY g) AS group_size FROM ({plain(HOUR_GROUPS)})")
def _(t: Tables) -> DataFrame:
    return repair.group_size(t.view(HOUR_GROUPS), ["g"])


@check("drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(t: Tables) -> DataFrame:
    x = repair.drop_columns(t.orders, ["o_orderstatus", "o_orderdate", "not_there"])
    return repair.drop_columns(x, ["o_orderpriority"], strict=True)


# ---- the whole job -------------------------------------------------------------------------

RAW_EVENTS = """
SELECT CAST(event_id AS STRING) AS instant,
       CASE WHEN event_id % 503 = 0 THEN '2024-02-31' ELSE '  ' || CAST(CAST(ts AS DATE) AS STRING) || ' ' END AS dteday,
       CASE WHEN event_id % 19 = 0 THEN 'spring' WHEN event_id % 31 = 0 THEN '9' ELSE CAST(day(ts) % 4 + 1 AS STRING) END AS season,
       CASE WHEN event_id % 7 = 0 THEN '99' WHEN event_id % 11 = 0 THEN '' ELSE '0' END AS yr,
       CASE WHEN event_id % 13 = 0 THEN '13' WHEN event_id % 29 = 0 THEN 'jan' ELSE CAST(month(ts) AS STRING) END AS mnth,
       CASE WHEN event_id % 67 = 0 AND day(ts) % 3 > 0 THEN '99' WHEN event_id % 71 = 0 AND day(ts) % 3 = 2 THEN '77'
            ELSE CAST(hour(ts) AS STRING) END AS hr,
       CASE WHEN event_id % 3 = 0 THEN 'x' ELSE '0' END AS holiday,
       CASE WHEN event_id % 23 = 0 THEN '8' ELSE CAST((day(ts) - 1) % 7 AS STRING) END AS weekday,
       CASE WHEN event_id % 17 = 0 THEN 'oops' WHEN (day(ts) - 1) % 7 >= 5 THEN '0' ELSE '1' END AS workingday,
       CASE WHEN event_id % 37 = 0 THEN '8' WHEN event_id % 41 = 0 THEN 'fog' ELSE CAST(event_id % 4 + 1 AS STRING) END AS weathersit,
       CASE WHEN event_id % 13 = 0 THEN '1.7' WHEN event_id % 17 = 0 THEN 'n/a' ELSE CAST(value / 500 AS STRING) END AS temp,
       CASE WHEN event_id % 14 = 0 THEN '2.5' ELSE CAST(value / 600 AS STRING) END AS atemp,
       CASE WHEN event_id % 15 = 0 THEN '' ELSE CAST(value / 700 AS STRING) END AS hum,
       CASE WHEN event_id % 16 = 0 THEN 'calm' ELSE CAST(value / 800 AS STRING) END AS windspeed,
       CASE WHEN event_id % 43 = 0 THEN 'none' WHEN event_id % 47 = 0 THEN CAST(-k AS STRING) ELSE CAST(k AS STRING) END AS casual,
       CASE WHEN event_id % 53 = 0 THEN CAST(b * 50 AS STRING) ELSE CAST(b AS STRING) END AS registered,
       CASE WHEN event_id % 59 = 0 THEN '?' WHEN event_id % 61 = 0 THEN CAST(k + b + 7 AS STRING) ELSE CAST(k + b AS STRING) END AS cnt,
       CASE WHEN event_id % 2 = 0 THEN 'a' ELSE '1' END AS mixed_type_col
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, CAST(floor(value) AS BIGINT) AS b FROM {events}) z"""

EVENT_RULES = clean_plan.CleanRules(year_codes={2024: 0, 2025: 1}, holidays=("2024-01-01", "2024-01-15"), blocking=BY_ID)


def _ahead(c: str) -> str:
    return f"first_value({c} IGNORE NULLS) OVER (ORDER BY instant ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS {c}"


CLEAN_SQL = f"""
WITH raw AS ({plain(RAW_EVENTS)}),
t AS (SELECT CAST(instant AS BIGINT) AS instant, TRY_CAST(trim(dteday) AS DATE) AS dteday, TRY_CAST(season AS BIGINT) AS season,
             TRY_CAST(yr AS BIGINT) AS yr, TRY_CAST(mnth AS BIGINT) AS mnth, TRY_CAST(hr AS BIGINT) AS hr, TRY_CAST(holiday AS BIGINT) AS holiday,
             TRY_CAST(weekday AS BIGINT) AS weekday, TRY_CAST(workingday AS BIGINT) AS workingday, TRY_CAST(weathersit AS BIGINT) AS weathersit,
             TRY_CAST(temp AS DOUBLE) AS temp, TRY_CAST(atemp AS DOUBLE) AS atemp, TRY_CAST(hum AS DOUBLE) AS hum, TRY_CAST(windspeed AS DOUBLE) AS windspeed,
             TRY_CAST(casual AS DOUBLE) AS casual, TRY_CAST(registered AS DOUBLE) AS registered, TRY_CAST(cnt AS DOUBLE) AS cnt FROM raw),
donor AS (SELECT dteday, arg_min(season, instant) AS s FROM t WHERE season IN (1, 2, 3, 4) GROUP BY dteday),
cal AS (SELECT t.* REPLACE (
          CASE WHEN season IN (1, 2, 3, 4) THEN season ELSE coalesce(s, season) END AS season,
          CASE WHEN yr IN (0, 1) OR t.dteday IS NULL THEN yr WHEN year(t.dteday) = 2024 THEN 0 WHEN year(t.dteday) = 2025 THEN 1 END AS yr,
          CASE WHEN mnth BETWEEN 1 AND 12 THEN mnth ELSE month(t.dteday) END AS mnth,
          CASE WHEN workingday IN (0, 1) THEN workingday WHEN t.dteday IS NULL THEN NULL
               WHEN isodow(t.dteday) >= 6 OR coalesce(holiday = 1, FALSE) THEN 0 ELSE 1 END AS workingday,
          CASE WHEN weekday BETWEEN 0 AND 6 THEN weekday ELSE isodow(t.dteday) - 1 END AS weekday)
        FROM t LEFT JOIN donor ON t.dteday = donor.dteday),
met AS (SELECT * REPLACE (CASE WHEN temp <= 1 THEN temp END AS temp, CASE WHEN atemp <= 1 THEN atemp END AS atemp,
                          CASE WHEN hum <= 1 THEN hum END AS hum, CASE WHEN windspeed <= 1 THEN windspeed END AS windspeed) FROM cal),
met2 AS (SELECT * REPLACE ({_ahead('temp')}, {_ahead('atemp')}, {_ahead('hum')}, {_ahead('windspeed')}) FROM met),
{count_steps('met2', 'casual', 'registered', 'cnt', rest='instant')},
kept AS (SELECT m.* REPLACE (f.casual AS casual, f.registered AS registered, f.cnt AS cnt,
                             CAST(coalesce(dteday IN (DATE '2024-01-01', DATE '2024-01-15'), FALSE) AS BIGINT) AS holiday)
         FROM met2 m JOIN fixed f ON m.instant = f.instant WHERE f.casual >= 0 AND f.registered >= 0 AND f.cnt >= 0),
single AS (SELECT * EXCLUDE (r) FROM (SELECT *, row_number() OVER (PARTITION BY dteday, season, yr, mnth, hr, holiday, weekday, workingday ORDER BY instant) AS r FROM kept) WHERE r = 1),
hours AS (SELECT * EXCLUDE (n, s) REPLACE (
            CASE WHEN dteday IS NULL THEN NULL WHEN n IN (24, 25) THEN CASE WHEN s < 24 THEN s END WHEN hr <= 23 THEN hr END AS hr)
          FROM (SELECT *, count(*) OVER (PARTITION BY dteday) AS n, row_number() OVER (PARTITION BY dteday ORDER BY instant) - 1 AS s FROM single)),
cond AS (SELECT * REPLACE (CASE WHEN weathersit <= 4 THEN weathersit END AS weathersit) FROM hours)
SELECT * REPLACE ({_ahead('weathersit')}, round(temp, 9) AS temp, round(atemp, 9) AS atemp, round(hum, 9) AS hum, round(windspeed, 9) AS windspeed) FROM cond"""


@check("clean_job", CLEAN_SQL)
def _(t: Tables) -> DataFrame:
    return rounded(clean_plan.clean(t.view(RAW_EVENTS), EVENT_RULES), 9)


# ---- scalar helpers ------------------------------------------------------------------------


@check(
    "scalar_functions",
    """SELECT event_id, round_even(value / 2, 0) AS half_even, abs(value - 50) AS distance, round(sqrt(value), 6) AS root,
              round(exp(value / 500), 6) AS grown, CAST(((event_id % 24) + 3) % 24 AS BIGINT) AS hour_shifted,
              least(greatest(value, 5.0), 50.0) AS clipped, epoch_ms(1700000000000 + event_id * 60123) AS at_utc,
              'run_' || event_id || '.csv' AS base, 'run_' || event_id AS stem, greatest(value, 40.0, event_id / 100.0) AS largest, round(value, 1) AS tenth
       FROM events""",
)
def _(t: Tables) -> DataFrame:
    path = F.concat(F.lit("data/processed/run_"), F.col("event_id").cast("string"), F.lit(".csv"))
    v = F.col("value")
    return t.events.select(
        "event_id",
        F.rint(v / 2).alias("half_even"),
        F.abs(v - 50).alias("distance"),
        F.round(F.sqrt(v), 6).alias("root"),
        F.round(F.exp(v / 500), 6).alias("grown"),
        F.pmod(F.col("event_id") % 24 + 3, F.lit(24)).cast("bigint").alias("hour_shifted"),
        fc.clamp(v, 5.0, 50.0).alias("clipped"),
        fc.epoch_ms_to_utc(F.lit(1700000000000) + F.col("event_id") * 60123).alias("at_utc"),
        fc.base_name(path).alias("base"),
        fc.stem(path).alias("stem"),
        F.greatest(v, F.lit(40.0), F.col("event_id") / 100.0).alias("largest"),
        F.round(v, 1).alias("tenth"),
    )
