"""Feature preparation, look-ups, set comparisons, table assertions."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from demandframe.checks.cleaning import COUNTS, ODD_PRIORITY, PRIORITIES
from demandframe.checks.registry import Tables, check, plain, rounded
from demandframe.operators import lookup, ordered, prep, quality
from demandframe.operators.ordered import Blocking
from demandframe.plans import prepare as prepare_plan


def hash_sql(key: str, seed: int) -> str:
    """The seeded key hash in plain SQL."""
    k = f"(({key}) % 4294967296)"
    m = f"(({k} * 40503 + CAST(floor({k} / 65536) AS BIGINT) * 2654435 + {seed * 7919}) % 1000003)"
    return f"((({m} * {m} + {m} * 65599 + {seed}) % 1000003) / 1000003.0)"


def split_sql(key: str, seed: int = 333) -> str:
    u = hash_sql(key, seed)
    return f"CASE WHEN {u} < 0.7 THEN 'train' WHEN {u} < 0.85 THEN 'valid' ELSE 'test' END"


def dummy_sql(c: str, values: list, drop_first: bool = True) -> str:
    return ", ".join(f"""CAST(coalesce({c} = '{v}', FALSE) AS INT) AS "{c}_{v}" """ for v in values[1 if drop_first else 0 :])


# ---- dummies -------------------------------------------------------------------------------


@check("dummies", f"SELECT o_orderkey, {dummy_sql('p', PRIORITIES)} FROM ({plain(ODD_PRIORITY)})")
def _(t: Tables) -> DataFrame:
    return prep.dummies(t.view(ODD_PRIORITY), {"p": PRIORITIES})


@check("dummies_observed", f"SELECT o_orderkey, {dummy_sql('p', [*PRIORITIES, 'ZZ'])} FROM ({plain(ODD_PRIORITY)})")
def _(t: Tables) -> DataFrame:
    return prep.dummies_observed(t.view(ODD_PRIORITY))


@check(
    "align_columns",
    f"""SELECT CAST(coalesce(p = '5-LOW', FALSE) AS INT) AS "p_5-LOW", CAST(0 AS INT) AS p_gone, o_orderkey FROM ({plain(ODD_PRIORITY)})""",
)
def _(t: Tables) -> DataFrame:
    return prep.align_columns(prep.dummies(t.view(ODD_PRIORITY), {"p": PRIORITIES}), ["p_5-LOW", "p_gone", "o_orderkey"])


TYPES = ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]


@check(
    "onehot_learned",
    f"SELECT p_partkey, {dummy_sql('p_type', TYPES[:4])} FROM part",
)
def _(t: Tables) -> DataFrame:
    """Levels are learned from some rows; a level never seen there gives zeros."""
    train = t.part.where("p_type < 'Q'")
    return prep.onehot_apply(t.part.select("p_partkey", "p_type"), prep.onehot_fit(train, ["p_type"]))


# ---- split ---------------------------------------------------------------------------------


@check("split", f"SELECT o_orderkey, {split_sql('o_orderkey')} AS split FROM orders")
def _(t: Tables) -> DataFrame:
    return prep.split(t.orders.select("o_orderkey"), "o_orderkey")


def exact_sql(key: str, table: str, seed: int = 333) -> str:
    """The split by rank: rows in the order of the key's hash, then of the key, cut at shares of the rows."""
    return f"""SELECT *, CASE WHEN r <= floor(round(n * 0.7, 6) + 0.5) THEN 'train' WHEN r <= floor(round(n * 0.85, 6) + 0.5) THEN 'valid' ELSE 'test' END AS split
        FROM (SELECT *, row_number() OVER (ORDER BY {hash_sql(key, seed)}, {key}) AS r, count(*) OVER () AS n FROM {table})"""


@check("split_exact", f"SELECT o_orderkey, split FROM ({exact_sql('o_orderkey', 'orders')})")
def split_exact(t: Tables) -> DataFrame:
    return prep.split_exact(t.orders.select("o_orderkey"), "o_orderkey")


@check("split_exact_sizes", f"SELECT split, count(*) AS n FROM ({exact_sql('l_key', '(SELECT l_orderkey * 8 + l_linenumber AS l_key FROM lineitem)', 42)}) GROUP BY split")
def split_exact_sizes(t: Tables) -> DataFrame:
    lines = t.lineitem.select((F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("l_key"))
    return prep.split_exact(lines, "l_key", seed=42).groupBy("split").agg(F.count("*").alias("n"))


@check("split_sizes", f"SELECT split, count(*) AS n FROM (SELECT {split_sql('o_orderkey', 42)} AS split FROM orders) GROUP BY split")
def _(t: Tables) -> DataFrame:
    return prep.split(t.orders, "o_orderkey", seed=42).groupBy("split").agg(F.count("*").alias("n"))


# ---- scaling -------------------------------------------------------------------------------

SCALED = ["l_quantity", "l_extendedprice", "l_discount", "flat"]
GAPPY_LINES = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_quantity END AS l_quantity, l_extendedprice,
       CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE l_discount END AS l_discount, CAST(3 AS DOUBLE) AS flat FROM {lineitem}"""


def _scaled_sql(c: str, digits: int = 6) -> str:
    return f"round(({c} - lo_{c}) / CASE WHEN hi_{c} = lo_{c} THEN 1 ELSE hi_{c} - lo_{c} END, {digits}) AS {c}"


@check(
    "minmax_scale",
    f"""WITH x AS ({plain(GAPPY_LINES)}),
        s AS (SELECT {', '.join(f'min({c}) AS lo_{c}, max({c}) AS hi_{c}' for c in SCALED)} FROM x WHERE l_orderkey % 2 = 0)
        SELECT l_orderkey, l_linenumber, {', '.join(_scaled_sql(c) for c in SCALED)} FROM x, s""",
)
def _(t: Tables) -> DataFrame:
    x = t.view(GAPPY_LINES)
    return rounded(prep.minmax_apply(x, prep.minmax_fit(x.where("l_orderkey % 2 = 0"), SCALED), SCALED))


@check("minmax_invert", f"SELECT l_orderkey, l_linenumber, l_quantity, round(l_extendedprice, 4) AS l_extendedprice FROM ({plain(GAPPY_LINES)})")
def _(t: Tables) -> DataFrame:
    x, cols = t.view(GAPPY_LINES).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"), ["l_quantity", "l_extendedprice"]
    stats = prep.minmax_fit(x, cols)
    return rounded(prep.minmax_invert(prep.minmax_apply(x, stats, cols), stats, cols), 4)


@check(
    "with_stats",
    """SELECT o_orderkey, o_totalprice, round(m, 4) AS mean_price, hi AS top_price FROM orders, (SELECT avg(o_totalprice) AS m, max(o_totalprice) AS hi FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    stats = t.orders.agg(F.avg("o_totalprice").alias("mean_price"), F.max("o_totalprice").alias("top_price"))
    return rounded(lookup.with_stats(t.orders.select("o_orderkey", "o_totalprice"), stats), 4)


# ---- imputation ----------------------------------------------------------------------------

SPLIT_LINES = f"""
SELECT o_orderkey, CASE WHEN o_custkey % 17 = 0 THEN NULL ELSE o_totalprice END AS price,
       CASE WHEN u >= 0.7 AND o_custkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS DOUBLE) END AS cust,
       CASE WHEN u < 0.7 THEN 'train' WHEN u < 0.85 THEN 'valid' ELSE 'test' END AS split
FROM (SELECT *, {hash_sql('o_orderkey', 333)} AS u FROM {{orders}}) z"""


@check(
    "impute_median_train",
    f"""WITH x AS ({plain(SPLIT_LINES)})
        SELECT o_orderkey, split, coalesce(price, (SELECT quantile_cont(price, 0.5) FROM x WHERE split = 'train')) AS price, cust FROM x""",
)
def _(t: Tables) -> DataFrame:
    """``cust`` has gaps, but none in training, so it is left alone."""
    return prep.impute_median(t.view(SPLIT_LINES), ["price", "cust"])


@check(
    "impute_median_self",
    f"""WITH x AS ({plain(SPLIT_LINES)}), s AS (SELECT split, quantile_cont(price, 0.5) AS p, quantile_cont(cust, 0.5) AS c FROM x GROUP BY split)
        SELECT o_orderkey, x.split, coalesce(price, p) AS price, coalesce(cust, c) AS cust FROM x JOIN s ON x.split = s.split""",
)
def _(t: Tables) -> DataFrame:
    return prep.impute_median(t.view(SPLIT_LINES), ["price", "cust"], stats_from="self")


MODE_LINES = """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE l_returnflag END AS flag,
       CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE CAST(l_quantity AS BIGINT) END AS qty FROM {lineitem}"""


@check(
    "impute_mode",
    f"""WITH x AS ({plain(MODE_LINES)})
        SELECT l_orderkey, l_linenumber,
               coalesce(flag, (SELECT flag FROM x WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1)) AS flag,
               coalesce(qty, (SELECT qty FROM x WHERE qty IS NOT NULL GROUP BY qty ORDER BY count(*) DESC, qty LIMIT 1)) AS qty FROM x""",
)
def _(t: Tables) -> DataFrame:
    return prep.impute_mode(t.view(MODE_LINES), ["flag", "qty"])


# ---- composed ------------------------------------------------------------------------------

PREP_ORDERS = f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 19 = 0 THEN 'ZZ' ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_totalprice END AS price, CAST(o_custkey AS DOUBLE) AS cust,
       CAST(month(o_orderdate) AS BIGINT) AS mnth, o_orderstatus FROM {{orders}}"""
MONTHS = list(range(1, 13))


def _month_dummies() -> str:
    return ", ".join(f"CAST(mnth = {m} AS INT) AS mnth_{m}" for m in MONTHS[1:])


ORDER_RULES = prepare_plan.PrepareRules(
    key="o_orderkey", domains={"priority": PRIORITIES, "mnth": MONTHS}, integers=("o_orderkey",), doubles=("price", "cust"), drop=("o_orderstatus",), scale=("price", "cust")
)
PREPARED_SQL = f"""WITH x AS (SELECT *, {split_sql('o_orderkey')} AS split FROM ({plain(PREP_ORDERS)})),
        s AS (SELECT min(price) AS lo_price, max(price) AS hi_price, min(cust) AS lo_cust, max(cust) AS hi_cust FROM x WHERE split = 'train')
        SELECT o_orderkey, {_scaled_sql('price', 9)}, {_scaled_sql('cust', 9)}, split, {dummy_sql('priority', PRIORITIES)}, {_month_dummies()} FROM x, s"""


@check("prepare_job", PREPARED_SQL)
def _(t: Tables) -> DataFrame:
    made, _ = prepare_plan.prepare(t.view(PREP_ORDERS), ORDER_RULES)
    return rounded(made, 9)


@check(
    "table_prep_estimator",
    f"""WITH x AS ({plain(PREP_ORDERS)}), tr AS (SELECT * FROM x WHERE o_orderkey % 3 > 0 AND priority <> '5-LOW'),
        s AS (SELECT quantile_cont(price, 0.5) AS m_price, min(price) AS lo_price, max(price) AS hi_price, min(cust) AS lo_cust, max(cust) AS hi_cust FROM tr)
        SELECT o_orderkey, round((coalesce(price, m_price) - lo_price) / (hi_price - lo_price), 6) AS price, {_scaled_sql('cust')}, mnth,
               {dummy_sql('priority', ['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', 'ZZ'])} FROM x, s""",
)
def _(t: Tables) -> DataFrame:
    """Fitted on some rows without one of the levels, applied to all."""
    x = t.view(PREP_ORDERS)
    maker = prep.TablePrep(numeric=["price", "cust"], categorical=["priority"], passthrough=["mnth"])
    model = maker.fit(x.where("o_orderkey % 3 > 0 AND priority <> '5-LOW'"))
    return rounded(model.prepared(x).select("o_orderkey", *model.feature_names()))


@check(
    "feature_vector",
    f"""WITH x AS ({plain(PREP_ORDERS)}), s AS (SELECT quantile_cont(price, 0.5) AS m_price, min(price) AS lo_price, max(price) AS hi_price,
               min(cust) AS lo_cust, max(cust) AS hi_cust FROM x)
        SELECT o_orderkey, round((coalesce(price, m_price) - lo_price) / (hi_price - lo_price), 6) AS price, {_scaled_sql('cust')}, CAST(mnth AS DOUBLE) AS mnth,
               {', '.join(f"""CAST(priority = '{p}' AS DOUBLE) AS "priority_{p}" """ for p in [*PRIORITIES[1:], 'ZZ'])} FROM x, s""",
)
def _(t: Tables) -> DataFrame:
    """The same model as a vector column, as a regressor reads it, taken apart again by name."""
    x = prep.ColumnDropper(columns=["o_orderstatus", "not_there"]).transform(t.view(PREP_ORDERS))
    num, cat, rest = prep.feature_lists(x, ["price", "cust", "gone"], ["priority"], "o_orderkey")
    model = prep.TablePrep(numeric=num, categorical=cat, passthrough=rest).fit(x)
    values = vector_to_array("features")
    made = model.transform(x)
    return rounded(made.select("o_orderkey", *[values[i].alias(n) for i, n in enumerate(model.feature_names())]))


@check(
    "label_and_features",
    "SELECT l_orderkey, l_linenumber, l_extendedprice AS label, l_quantity AS f0, l_discount AS f1, l_tax AS f2 FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    x = prep.xy(t.lineitem, "l_extendedprice", ["l_quantity", "l_discount", "l_tax"])
    values = vector_to_array("features")
    return x.select("l_orderkey", "l_linenumber", "label", *[values[i].alias(f"f{i}") for i in range(3)])


# ---- joins and sets ------------------------------------------------------------------------


@check(
    "align_rows",
    """SELECT a.event_id, a.value, b.value AS other FROM events a JOIN (SELECT event_id, value * 2 AS value FROM events WHERE event_id % 3 = 0) b ON a.event_id = b.event_id""",
)
def _(t: Tables) -> DataFrame:
    other = t.events.where("event_id % 3 = 0").select("event_id", (F.col("value") * 2).alias("other"))
    return lookup.align_rows(t.events.select("event_id", "value"), other, "event_id")


HALVES = """SELECT event_id, event_type, value, CASE WHEN day(ts) <= 15 THEN 'base' ELSE 'new' END AS half FROM {events}"""


@check(
    "compare_counts",
    f"""SELECT label, count(*) FILTER (half = 'base') AS base, count(*) FILTER (half = 'new') AS "new"
        FROM (SELECT half, CASE WHEN half = 'base' AND event_type = 'click' THEN 'tap' ELSE event_type END AS label FROM ({plain(HALVES)})) GROUP BY label""",
)
def _(t: Tables) -> DataFrame:
    """A label has another name on one side, so each side holds one that the other lacks."""
    x = t.view(HALVES)
    base = x.where("half = 'base'").replace("click", "tap", "event_type")
    return lookup.compare_counts(base, x.where("half = 'new'"), "event_type")


@check("only_in", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return lookup.only_in(t.orders.select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


@check("in_both", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"))
    return lookup.in_both(t.orders.select("o_orderkey", "o_custkey"), lines, ["o_orderkey"])


@check(
    "stack_tables",
    """SELECT 'orders' AS src, o_orderkey AS id, o_totalprice AS amount FROM orders UNION ALL SELECT 'customers', c_custkey, c_acctbal FROM customer""",
)
def _(t: Tables) -> DataFrame:
    a = t.orders.select(F.lit("orders").alias("src"), F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    b = t.customer.select(F.col("c_acctbal").alias("amount"), F.lit("customers").alias("src"), F.col("c_custkey").alias("id"))
    return lookup.stack_tables(a, b)


# ---- ordered -------------------------------------------------------------------------------


@check("row_index", "SELECT event_id, value, row_number() OVER (ORDER BY value, event_id) - 1 AS row_index, count(*) OVER () AS n_rows FROM (SELECT *, value AS v FROM events)")
def _(t: Tables) -> DataFrame:
    """Numbered by a column with ties: the tie is broken by a unique order made from both."""
    x = t.events.select("event_id", "value", (F.round(F.col("value") * 100).cast("bigint") * 100000000 + F.col("event_id")).alias("o"))
    return ordered.row_index(x, "o", total="n_rows", blocking=Blocking(rows_per_block=900, fraction=0.3)).drop("o")


@check(
    "running_sums",
    """SELECT event_id, user_id, round(sum(value) OVER (PARTITION BY user_id ORDER BY event_id), 4) AS spent,
              round(sum(value) OVER (PARTITION BY user_id), 4) AS spent_total FROM events""",
)
def _(t: Tables) -> DataFrame:
    x = ordered.running_sums(t.events, "event_id", {"spent": "value"}, ["user_id"], totals=True, blocking=Blocking(block_size=2500))
    return rounded(x.select("event_id", "user_id", "spent", "spent_total"), 4)


@check("previous", "SELECT event_id, value, lag(value) OVER (ORDER BY event_id) AS previous FROM events")
def _(t: Tables) -> DataFrame:
    return ordered.previous(t.events.select("event_id", "value"), "value", "event_id", blocking=Blocking(block_size=1000))


@check("previous_keyed", "SELECT event_id, user_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS previous FROM events")
def _(t: Tables) -> DataFrame:
    x = t.events.select("event_id", "user_id", "ts", "value")
    return ordered.previous(x, "value", "ts", ["user_id"], blocking=Blocking(block_size=86_400_000_000)).drop("ts")


@check(
    "centered_mean",
    """SELECT event_id, CASE WHEN count(value) OVER w = 7 THEN round(avg(value) OVER w, 6) END AS trend FROM events
       WINDOW w AS (ORDER BY event_id ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)""",
)
def _(t: Tables) -> DataFrame:
    x = ordered.centered_mean(t.events, "value", "event_id", 7, blocking=Blocking(block_size=1000), chunk=500)
    return rounded(x.select("event_id", "trend"))


@check(
    "centered_mean_even_keyed",
    """SELECT event_id, user_id, CASE WHEN count(value) OVER w = 5 THEN
              round((sum(value) OVER w - 0.5 * (lag(value, 2) OVER o + lead(value, 2) OVER o)) / 4, 6) END AS trend FROM events
       WINDOW w AS (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), o AS (PARTITION BY user_id ORDER BY event_id)""",
)
def _(t: Tables) -> DataFrame:
    x = ordered.centered_mean(t.events, "value", "event_id", 4, ["user_id"], blocking=Blocking(block_size=1000), chunk=20)
    return rounded(x.select("event_id", "user_id", "trend"))


# ---- assertions ----------------------------------------------------------------------------


@check(
    "assert_table",
    f"""WITH x AS ({plain(COUNTS)}), r AS (
          SELECT 'identity' AS rule, count(*) FILTER (a + b <> total) AS violations FROM x
          UNION ALL SELECT 'a not negative', count(*) FILTER (a < 0) FROM x
          UNION ALL SELECT 'b within 0..500', count(*) FILTER (b < 0 OR b > 500) FROM x
          UNION ALL SELECT 'total present', count(*) FILTER (total IS NULL) FROM x
          UNION ALL SELECT 'total finite', 0 FROM x WHERE event_id = 0
          UNION ALL SELECT 'has rows', CASE WHEN count(*) > 0 THEN 0 ELSE 1 END FROM x)
        SELECT rule, violations, CAST(violations = 0 AS INT) AS passed FROM r""",
)
def _(t: Tables) -> DataFrame:
    rules = {
        "identity": quality.identity_holds("a", "b", "total"),
        "a not negative": quality.not_negative("a"),
        "b within 0..500": quality.in_range("b", 0, 500),
        "total present": quality.not_null("total"),
        "total finite": quality.finite("total"),
    }
    return quality.assert_table(t.view(COUNTS), rules, {"has rows": F.count("*") > 0})


@check(
    "split_assertions",
    f"""WITH x AS (SELECT o_orderkey, o_custkey, {split_sql('o_orderkey')} AS split FROM orders), n AS (SELECT count(*) AS n FROM x), r AS (
          SELECT 'share of ' || s.split AS rule, CASE WHEN abs((SELECT count(*) FROM x WHERE x.split = s.split) / n - s.f) <= 0.05 THEN 0 ELSE 1 END AS violations
          FROM n, (VALUES ('train', 0.7), ('valid', 0.15), ('test', 0.15)) s(split, f)
          UNION ALL SELECT 'splits are disjoint', 0
          UNION ALL SELECT 'customers are disjoint', count(*) FROM (SELECT o_custkey FROM x GROUP BY o_custkey HAVING count(DISTINCT split) > 1)
          UNION ALL SELECT 'retention >= 0.8', CASE WHEN (SELECT count(*) FROM x WHERE split <> 'test') >= 0.8 * n THEN 0 ELSE 1 END FROM n
          UNION ALL SELECT 'retention >= 0.9', CASE WHEN (SELECT count(*) FROM x WHERE split <> 'test') >= 0.9 * n THEN 0 ELSE 1 END FROM n)
        SELECT rule, CAST(violations AS BIGINT) AS violations, CAST(violations = 0 AS INT) AS passed FROM r""",
)
def _(t: Tables) -> DataFrame:
    x = prep.split(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey")
    by_customer = quality.disjoint_keys(x, "o_custkey").withColumn("rule", F.lit("customers are disjoint"))
    kept = x.where("split <> 'test'")
    return lookup.stack_tables(
        quality.split_shares(x, {"train": 0.7, "valid": 0.15, "test": 0.15}),
        quality.disjoint_keys(x, "o_orderkey"),
        by_customer,
        quality.retention(x, kept, 0.8),
        quality.retention(x, kept, 0.9),
    )
