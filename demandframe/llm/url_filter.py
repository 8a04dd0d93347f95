"""URL filters: pattern rules indexed by their rarest literal token.

Every rule becomes a regular expression and the list of words that any match of it must contain as whole
tokens. Of these the one that the fewest URLs contain (counted over all URLs) is the rule's index key. A URL's tokens
fetch its candidate rules by an equi-join, and only the candidates' expressions run.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from demandframe.llm.common import ascii_lower, fresh, materialise

TOKEN = "[^a-z0-9]+"


@dataclass(frozen=True)
class SiteRule:
    """Fits ``host``, all its subdomains, and paths that start with ``path``."""

    action: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class PatternRule:
    """``*`` is any text, ``^`` a separator (anything but a letter or digit) or an end; all else is literal, lower case."""

    action: str
    pattern: str

    @property
    def text(self) -> str:
        return self.pattern


#: What is blocked where no site rule fits: words in a host or path that name adult, gambling, spam, pill or tracking pages.
UNWANTED = tuple(PatternRule("block", f"^{w}^") for w in ("adult", "porn", "xxx", "casino", "poker", "gambling", "bets", "betting", "pills", "viagra", "spam", "ads", "adserver"))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for NULL."""
    return ascii_lower(F.regexp_extract(_rest(url), "^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://`` or for NULL."""
    return F.regexp_extract(F.regexp_replace(_rest(url), "^[^/?#]*", ""), "^[^?#]*", 0)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def _regex(rule: SiteRule | PatternRule) -> str:
    """Expression over ``host path`` (one blank between them)."""
    if isinstance(rule, SiteRule):
        return rf"(?s)^(?:.*\.)?{_quote(rule.host)} {_quote(rule.path)}"
    made = "".join({"*": ".*", "^": r"(?:^|$|(?<![a-z0-9])|(?![a-z0-9]))(?:[^a-z0-9]|^|$)"}.get(c) or _quote(c) for c in rule.pattern)
    return f"(?s){made}"


def _quote(text: str) -> str:
    return re.sub(r"([\\.^$*+?()\[\]{}|/-])", r"\\\1", text)


def _tokens(rule: SiteRule | PatternRule) -> list[str]:
    """Words that each match holds as whole tokens: bounded on both sides by a separator. [''] if there is none."""
    text = f"^{rule.host}^{rule.path}*" if isinstance(rule, SiteRule) else f"*{rule.pattern}*"
    words = re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", text.lower())
    return sorted(set(words)) or [""]


def judge(pages: DataFrame, rules: Sequence[SiteRule], patterns: Sequence[PatternRule] = UNWANTED, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule``, ``verdict`` and ``pattern`` (of these, names that are taken get a leading underscore).

    The longest fitting site rule decides (equal lengths: the lexically first rule); where none fits, a fitting
    pattern does (``block`` before ``allow``, then the lexically first, shown in ``pattern``); else ``default``. A NULL, empty or
    malformed URL has an empty host and path, fits nothing and gets ``default``. Repeated rows are judged alike and all
    stay; an empty table gives an empty one.
    """
    out_host, out_path, out_rule, out_verdict, out_pattern, key = fresh(pages.columns, "host", "path", "rule", "verdict", "pattern", "url_key")
    listed = list(dict.fromkeys([*rules, *patterns]))
    spark = pages.sparkSession
    schema = T.StructType([T.StructField(n, t) for n, t in (("id", T.IntegerType()), ("text", T.StringType()), ("action", T.StringType()), ("site", T.BooleanType()), ("rule_host", T.StringType()), ("rule_path", T.StringType()), ("regex", T.StringType()), ("words", T.ArrayType(T.StringType())))])
    table = spark.createDataFrame([(i, r.text, r.action, s := isinstance(r, SiteRule), r.host if s else "", r.path if s else "", _regex(r), _tokens(r)) for i, r in enumerate(listed)], schema)

    urls = pages.select(F.col(url).cast("string").alias("u")).where("u is not null").distinct()
    urls = urls.select("u", host_of(F.col("u")).alias("h"), path_of(F.col("u")).alias("p")).where("h != '' or p != ''")
    text = F.concat_ws(" ", "h", "p")
    # the blank token fetches the rules that have no literal word
    tokens = urls.select("u", "h", "p", F.explode(F.array_distinct(F.concat(F.split(ascii_lower(text), TOKEN), F.array(F.lit(""))))).alias("token"))
    words = table.select("id", F.explode("words").alias("token"))
    counts = tokens.join(words.select("token").distinct(), "token", "left_semi").groupBy("token").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("id").orderBy(F.coalesce("n", F.lit(0)), "token")
    index = words.join(counts, "token", "left").withColumn("k", F.row_number().over(rarest)).where("k = 1").select("id", "token").join(table.drop("words"), "id")

    found = tokens.join(index, "token").where(F.rlike(F.when(F.col("site"), text).otherwise(ascii_lower(text)), F.col("regex")))
    fits = ~F.col("site") | ((F.col("h").eqNullSafe(F.col("rule_host")) | F.endswith(F.col("h"), F.concat(F.lit("."), F.col("rule_host")))) & F.startswith(F.col("p"), F.col("rule_path")))
    best = found.where(fits).groupBy("u").agg(
        F.min(F.when(F.col("site"), F.struct((-F.length("text")).alias("l"), "text", "action"))).alias("s"),
        F.min(F.when(~F.col("site"), F.struct((F.col("action") != "block").alias("l"), "text", "action"))).alias("m"),
    )
    best = best.select(F.col("u").alias(key), F.col("s.text").alias(out_rule), F.coalesce("s.action", "m.action").alias(out_verdict), F.when(F.col("s").isNull(), F.col("m.text")).alias(out_pattern))
    best = materialise(best, "verdicts")  # a table on either side: a URL that very many pages share is split in the join
    judged = pages.join(best, pages[url].cast("string") == best[key], "left")
    return judged.select(
        *[pages[c] for c in pages.columns], host_of(pages[url]).alias(out_host), path_of(pages[url]).alias(out_path), best[out_rule], F.coalesce(best[out_verdict], F.lit(default)).alias(out_verdict), best[out_pattern]
    )
