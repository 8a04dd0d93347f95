"""Personal data: patterns find protected entities, corpus co-occurrence finds the terms that give them away.

For an entity e (one e-mail address, phone number, ...) and a term t in the same text, the share of e's information
content that t discloses is PMI(t; e) / IC(e), with probabilities from counts of different texts over the whole corpus:
1 - log2(n_t / n_te) / log2(N / n_e). It is 1 for a term that occurs with e only and falls with every other text that
holds the term. Terms at ``disclosure`` or above, seen with e in ``contexts`` unlike texts at least, are spans too. Near-copies are
no unlike texts: they count by classes of texts that share half of their five-word shingles. Only DataFrame functions are used.
"""

from __future__ import annotations

import itertools
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandframe.llm.common import materialise
from demandframe.llm.components import connected

KINDS = ("email", "ip", "card", "phone", "term")

# Possessive forms of the stated patterns: they match the same, but in linear time on long runs. A run that can't start
# a match at its first character can't start one inside; \G lets a match start right after the last one.
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[ -]?[0-9])++",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be tried.
NEEDED = {"email": "@", "ip": ".", "card": "", "phone": "+"}
BYTE = "0*(?:[0-9]|[1-9][0-9]|1[0-9][0-9]|2[0-4][0-9]|25[0-5])"
WORD = r"\p{L}+"
#: Letters of the shortest term: one where a letter can be a word or a name, else two.
SHORTEST, LETTER_IS_WORD = 2, r"[\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}]"
#: Min-hash keys of a text's shingles, values of one key, and the share of shingles from which texts are one class.
BANDS, ROWS, ALIKE = 16, 3, 0.5
#: Texts of one key that are compared with each other in one round, and of one cell when all that are left are compared.
CHUNK, CELL = 16, 256
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _luhn(digits: Column) -> Column:
    """Whether the check digit fits: from the right, every second digit counts double, less nine if over nine."""

    def add(s: Column, i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int")
        double = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return s + F.when(i % 2 == 0, double).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, m: Column) -> Column:
    digits = F.regexp_replace(m, "[^0-9]", "")
    if kind == "ip":
        return m.rlike(rf"^{BYTE}\.{BYTE}\.{BYTE}\.{BYTE}$")
    if kind == "card":
        return F.length(digits).between(14, 19) & F.when(F.length(digits).between(14, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(10, 15) if kind == "phone" else F.lit(True)


def _places(text: Column, pattern: str, kind: int) -> Column:
    """Spans of all matches, leftmost and non-overlapping: lengths of what lies between them and of themselves, added up."""
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(between, found, lambda b, m: F.struct(F.length(b).alias("b"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        at = acc["at"] + x["b"]
        one = F.struct(at.alias("start"), F.lit(kind).alias("kind"), (at + F.length(x["m"])).alias("end"), x["m"].alias("value"))
        return F.struct((at + F.length(x["m"])).alias("at"), F.concat(acc["spans"], F.array(one)).alias("spans"))

    return F.aggregate(F.filter(both, lambda x: x["m"].isNotNull()), start, add, lambda acc: acc["spans"])


def _term_spans(text: Column, terms: Column) -> Column:
    """Spans of the words that are terms: one walk over the words, which keeps the end of the last word and the hits."""
    both = F.zip_with(F.split(text, WORD, -1), F.regexp_extract_all(text, F.lit(WORD), F.lit(0)), lambda b, m: F.struct(F.length(b).alias("b"), m.alias("m")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(acc: Column, x: Column) -> Column:
        first, end = acc["at"] + x["b"], acc["at"] + x["b"] + F.length(x["m"])
        one = F.struct(first.alias("start"), F.lit(len(KINDS) - 1).alias("kind"), end.alias("end"), x["m"].alias("value"))
        return F.struct(end.alias("at"), F.when(F.array_contains(terms, F.lower(x["m"])), F.concat(acc["spans"], F.array(one))).otherwise(acc["spans"]).alias("spans"))

    return F.aggregate(F.filter(both, lambda x: x["m"].isNotNull()), start, add, lambda acc: acc["spans"])


def _base_spans(text: Column) -> Column:
    none, parts = F.array().cast(SPAN), []
    for k, (kind, pattern) in enumerate(PATTERNS.items()):
        # the cheap looks first: only texts with a match get their places worked out
        may = text.contains(NEEDED[kind]) & text.rlike(pattern) if NEEDED[kind] else text.rlike(pattern)
        parts.append(F.when(may, F.filter(_places(text, pattern, k), lambda s: _valid(kind, s["value"]))).otherwise(none))  # noqa: B023
    return F.array_sort(F.concat(*parts))


def _words(text: Column) -> Column:
    """Different words of letters, in lower case, long enough for a term."""
    return F.filter(F.array_distinct(F.split(F.lower(text), r"[^\p{L}]+")), lambda w: (F.length(w) >= SHORTEST) | w.rlike(LETTER_IS_WORD))


def _candidates(text: Column) -> Column:
    """The words of a whole text but those that touch digits or @."""
    return _words(F.regexp_replace(text, r"\S*[@0-9]\S*", " "))


def found_entities(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc_id, text_key, spans) of every row, kept as a table."""
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).alias("doc_id"), t.alias("text"))
    rows = rows.select("doc_id", F.struct(F.xxhash64("text"), F.xxhash64(F.lit(1), "text")).alias("text_key"), _base_spans(F.col("text")).alias("spans"))
    return materialise(rows, "entities")


def _keyed(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Shingle sets (text_key, h, node) and min-hash keys (node, key) of (text_key, text), as tables."""
    rows = texts.select("text_key", F.filter(F.split(F.lower("text"), r"\s+"), lambda w: w != "").alias("words"))
    shingles = F.transform(F.sequence(F.lit(1), F.greatest(F.size("words") - 4, F.lit(1))), lambda i: F.xxhash64(F.slice("words", i, 5)))
    sets = materialise(rows.select("text_key", F.array_distinct(shingles).alias("h")).withColumn("node", F.monotonically_increasing_id()), "sets")
    rng = random.Random(9)
    turn = [rng.getrandbits(64) - (1 << 63) for _ in range(BANDS * ROWS)]
    # hashed anew for each: with bits merely turned, masks that share their leading bits would pick the same shingle
    mins = [F.array_min(F.transform("h", lambda x: F.xxhash64(F.lit(r), x))) for r in turn]  # noqa: B023
    keyed = sets.select("node", F.explode(F.array(*[F.xxhash64(F.lit(b), *mins[b * ROWS : b * ROWS + ROWS]) for b in range(BANDS)])).alias("key"))
    return sets, materialise(keyed, "keyed")


def _alike() -> Column:
    both, all_ = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    return (F.least(F.size("x"), F.size("y")) >= ALIKE * F.greatest(F.size("x"), F.size("y"))) & ((1 + ALIKE) * both >= ALIKE * all_)


def _other_links(live: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) among all pairs of texts that share a key and have different roots, for (key, node, root).

    The largest component of a key meets only what lies outside it. Texts are dealt into cells, and any two cells meet in a group of
    their own, so that no key has to be held by one task.
    """
    cells = lambda n: F.ceil(n / CELL).cast("int")
    place = lambda n: F.pmod(F.xxhash64("key", "node"), n).cast("int")
    parts = live.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key").agg(F.max(F.struct("n", "root")).alias("main"), F.sum("n").alias("n"))
    parts = parts.select("key", F.col("main.root").alias("main"), cells(F.col("n") - F.col("main.n")).alias("outer"), cells(F.col("main.n")).alias("inner"))
    inside = F.col("root") == F.col("main")
    # the outer cells come first; they meet all cells, the largest component's only them
    dealt = live.join(parts, "key").withColumn("cell", F.when(inside, F.col("outer") + place(F.col("inner"))).otherwise(place(F.col("outer"))))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(inside, F.col("outer")).otherwise(F.col("outer") + F.col("inner")) - 1)))
    dealt = dealt.withColumns({"one": F.least("cell", "other"), "two": F.greatest("cell", "other")}).join(sets.select("node", "h"), "node")
    left = dealt.where("cell = one").select("key", "one", "two", F.col("node").alias("a"), F.col("root").alias("root_a"), F.col("h").alias("x"))
    right = dealt.where("cell = two").select("key", "one", "two", F.col("node").alias("b"), F.col("root").alias("root_b"), F.col("h").alias("y"))
    met = left.join(right, ["key", "one", "two"]).where("root_a != root_b AND (one < two OR a < b)").where(_alike())
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _classes(texts: DataFrame) -> DataFrame:
    """(text_key, context) for (text_key, text): texts of one class share their context.

    Texts that share a min-hash key are compared by all their shingles; those that share ``ALIKE`` of them link. That goes in rounds first,
    each of which costs as much as there are keys: all texts of a key are compared with one of them, the one with most links, and (after
    the first round) with those that are dealt into the same chunk, anew in each round. Rounds end when one finds no new link;
    then all pairs of a key that no links connect yet are compared, so none that shares a key is left out.
    """
    sets, keyed = _keyed(texts)
    a, b = (sets.select(F.col("node").alias(n), F.col("h").alias(h)) for n, h in (("a", "x"), ("b", "y")))
    links, rooted = None, keyed.withColumns({"root": F.col("node"), "degree": F.lit(0).cast("long")})
    for k in itertools.count():
        mixed = F.xxhash64(F.lit(k), "key", "node")
        groups = rooted.groupBy("key").agg(F.count("*").alias("n"), F.max_by(F.struct("node", "root"), F.struct(F.col("degree"), mixed)).alias("one"), F.min("root").alias("lo"), F.max("root").alias("hi"))
        live = materialise(rooted.join(groups.where("lo < hi"), "key").select("key", "node", "root", "n", "one"), "live")
        if live.isEmpty():
            break
        pairs = live.where("root != one.root").select(F.least("node", "one.node").alias("a"), F.greatest("node", "one.node").alias("b"))
        if k:
            dealt = live.select("key", F.pmod(mixed, F.ceil(F.col("n") / CHUNK)).alias("chunk"), "node", "root")
            left = dealt.select("key", "chunk", F.col("node").alias("a"), F.col("root").alias("root_a"))
            right = dealt.select("key", "chunk", F.col("node").alias("b"), F.col("root").alias("root_b"))
            pairs = pairs.union(left.join(right, ["key", "chunk"]).where("a < b AND root_a != root_b").select("a", "b"))
        found = materialise(pairs.distinct().join(a, "a").join(b, "b").where(_alike()).select("a", "b"), "links")
        last = found.isEmpty()
        if last and not k:
            continue
        if last:
            found = materialise(_other_links(live, sets), "links")
            if found.isEmpty():
                break
        links = links.union(found) if links else found
        roots = materialise(connected(links), "roots")
        if last:
            break
        degrees = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count("*").alias("degree"))
        rooted = keyed.join(roots.join(degrees, "node"), "node", "left").withColumns({"root": F.coalesce("root", "node"), "degree": F.coalesce("degree", F.lit(0))})
    if links is None:
        return materialise(sets.select("text_key", F.col("node").alias("context")), "classes")
    return materialise(sets.select("text_key", "node").join(roots, "node", "left").select("text_key", F.coalesce("root", "node").alias("context")), "classes")


def _texts(docs: DataFrame, text: str) -> DataFrame:
    t = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.struct(F.xxhash64(t), F.xxhash64(F.lit(1), t)).alias("text_key"), t.alias("text"))


def _different(texts: DataFrame) -> DataFrame:
    """(text_key, text) of different texts; copies are folded in each task before the shuffle."""
    return texts.groupBy("text_key").agg(F.first("text").alias("text"))


def _texts_of_words(texts: DataFrame, entities: DataFrame) -> DataFrame:
    """(term, n_t): how many different texts hold a word, for every word of (text_key, text).

    Words are counted over all rows, in each task first, so that a frequent word is a few rows before anything meets it; then what the
    further copies of a text have added is taken off. Only texts that have copies are folded for that.
    """
    counted = texts.select(F.explode(_words(F.col("text"))).alias("term"), F.lit(1).cast("long").alias("n"))
    copied = materialise(entities.groupBy("text_key").agg(F.count("*").alias("rows")).where("rows > 1"), "copied")
    if not copied.isEmpty():
        folded = _different(texts.join(copied.select("text_key"), "text_key", "left_semi")).join(copied, "text_key")
        counted = counted.union(folded.select(F.explode(_words(F.col("text"))).alias("term"), (1 - F.col("rows")).alias("n")))
    return counted.groupBy("term").agg(F.sum("n").alias("n_t"))


def revealing_terms(docs: DataFrame, entities: DataFrame, text: str = "text", disclosure: float = 0.8, contexts: int = 3) -> DataFrame:
    """(term, disclosure): terms that disclose at least that share of some entity's information."""
    near = materialise(entities.select("text_key", F.explode(F.transform("spans", lambda s: s["value"])).alias("entity")).distinct(), "near")
    # what stands in fewer different texts can't stand in so many classes
    several = materialise(near.groupBy("entity").agg(F.count("*").alias("n_e")).where(F.col("n_e") >= contexts), "several")
    if several.isEmpty():
        return several.select(F.col("entity").alias("term"), F.lit(1.0).alias("disclosure"))
    near = materialise(near.join(several.select("entity"), "entity"), "near")
    own = _different(_texts(docs, text).join(near.select("text_key").distinct(), "text_key", "left_semi"))
    own = materialise(own, "own")
    near = materialise(near.join(_classes(own), "text_key"), "near")
    unlike = near.select("entity", "context").distinct().groupBy("entity").agg(F.count("*").alias("n")).where(F.col("n") >= contexts).select("entity")
    near = materialise(near.join(unlike, "entity"), "near")
    held = own.join(near.select("text_key").distinct(), "text_key", "left_semi").select("text_key", F.explode(_candidates(F.col("text"))).alias("term"))
    pairs = near.join(held, "text_key").groupBy("entity", "term", "context").agg(F.count("*").alias("n"))
    pairs = pairs.groupBy("entity", "term").agg(F.count("*").alias("contexts"), F.sum("n").alias("n_te")).where(F.col("contexts") >= contexts)
    pairs = materialise(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.select("term", F.lit(1.0).alias("disclosure"))
    total = entities.select("text_key").distinct().agg(F.count("*").alias("total"))
    share = 1 - F.log2(F.greatest(F.col("n_t") / F.col("n_te"), F.lit(1.0))) / F.log2(F.greatest(F.col("total") / F.col("n_e"), F.lit(2.0)))
    # a term is in so many texts at least: pairs that this rules out need no count over all texts
    least = held.groupBy("term").agg(F.count("*").alias("n_t"))
    pairs = pairs.join(least, "term").join(several, "entity").join(total).where(share >= disclosure).drop("n_t")
    pairs = materialise(pairs, "pairs")
    if pairs.isEmpty():
        return pairs.select("term", F.lit(1.0).alias("disclosure"))
    scored = pairs.join(_texts_of_words(_texts(docs, text), entities), "term")
    return materialise(scored.groupBy("term").agg(F.max(share).alias("disclosure")).where(F.col("disclosure") >= disclosure), "terms")


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", disclosure: float = 0.8, contexts: int = 3) -> DataFrame:
    """(doc_id, text_key, spans) for every row: spans are (start, kind as a place in KINDS, end, value) by start and kind, in code points.

    A NULL text counts as empty. Rows with a NULL doc_id and repeated rows stay. Entities never depend on the terms. An empty table gives no row.
    """
    entities = found_entities(docs, doc_id, text)
    terms = revealing_terms(docs, entities, text, disclosure, contexts)
    if terms.isEmpty():
        return entities.select("doc_id", "text_key", "spans")
    texts = _texts(docs, text).where("text != ''")
    held = texts.select("text_key", F.explode(_words(F.col("text"))).alias("term")).join(terms.select("term"), "term").groupBy("text_key").agg(F.collect_set("term").alias("terms"))
    held = materialise(held, "held")
    own = _different(texts.join(held.select("text_key"), "text_key", "left_semi"))
    more = own.join(held, "text_key").select("text_key", _term_spans(F.col("text"), F.col("terms")).alias("more"))
    return entities.join(materialise(more, "more"), "text_key", "left").select("doc_id", "text_key", F.array_sort(F.concat("spans", F.coalesce("more", F.array().cast(SPAN)))).alias("spans"))


def told(spans: Column, only: Column | None = None) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans if only is None else only, lambda s: F.concat_ws(":", names[s["kind"]], s["start"].cast("string"), s["end"].cast("string"))), ",")


def sanitise(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", disclosure: float = 0.8, contexts: int = 3) -> DataFrame:
    """``docs`` with every span of ``text`` replaced by its kind in brackets; all rows and columns stay, a NULL text stays NULL.

    Overlapping spans become one, named after the first. Terms are generalised to ``[TERM]``.
    """
    spans = find(docs, doc_id, text, disclosure, contexts)
    spans = materialise(spans.where(F.size("spans") > 0).select("text_key", F.col("spans").alias("found_spans")).dropDuplicates(["text_key"]), "spans")
    t = F.coalesce(docs[text].cast("string"), F.lit(""))
    joined = docs.join(spans, F.struct(F.xxhash64(t), F.xxhash64(F.lit(1), t)) == spans["text_key"], "left")
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, s: Column) -> Column:
        inside = s["start"] < acc["at"]
        made = F.concat(acc["out"], F.substring(docs[text], acc["at"] + 1, s["start"] - acc["at"]), names[s["kind"]])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(made).alias("out"))

    def rest(acc: Column) -> Column:
        return F.concat(acc["out"], F.substring(docs[text], acc["at"] + 1, F.length(docs[text])))

    clean = F.when(spans["found_spans"].isNull(), docs[text]).otherwise(F.aggregate(spans["found_spans"], start, add, rest))
    return joined.select(*[clean.alias(c) if c == text else docs[c] for c in docs.columns])
