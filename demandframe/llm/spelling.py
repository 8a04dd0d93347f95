"""Spelling variants: words that differ by one inserted, deleted or replaced code point, found on the frontier of a trie.

All words make two tries, one of the words and one of the words reversed, as tables of nodes with their outgoing
edges. A state (word, position, node, edits) says that the node's prefix turns into the word's first letters with so many
edits. A level joins all states with the nodes they stand on and moves each along one edge: the same letter, or, once,
another letter, an additional one, or past one of the word's. A state with one edit at its word's end names a neighbour
if that node ends a word.

*Parts.* A single edit leaves one side of the word as it is. So a word starts at half its length, once in each trie, on the
node of its untouched half, where few words share a node; the root is never joined. Words of more than 16 letters are
cut into parts of eight letters, each walked alone, with the untouched rest behind it looked up at the end; so there are at
most 32 levels however long a word is.

*Levels.* A node takes part in the levels that its depth can meet, so each level reads its own slice of the trie. An edge
knows which letters follow it, and moves that can't go on are dropped before they are shuffled. Node names are 64-bit hashes,
so found pairs are compared once more.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from demandframe.llm.common import materialise

#: Letters of a part; words of up to two parts are cut in halves. Levels at which parts of longer words can be.
PART = 8
LEVELS = range(4 * PART)
END = "\n"


def _node(back: Column, prefix: Column) -> Column:
    return F.xxhash64(back, prefix)


def _prefix(x: str, n: Column) -> Column:
    return F.substring(F.col(x), F.lit(1), n.cast("int"))


def _strings(words: DataFrame) -> DataFrame:
    """(x, back, size): every word and every word reversed."""
    back = F.explode(F.array(F.lit(0), F.lit(1))).alias("back")
    return words.select("word", back).select(F.when(F.col("back") == 1, F.reverse("word")).otherwise(F.col("word")).alias("x"), "back").withColumn("size", F.length("x"))


def _level(depth: Column) -> Column:
    """The first level at which a part of a long word can stand at this depth; the others are PART apart."""
    return depth % PART + PART


def trie(words: DataFrame) -> DataFrame:
    """(node, level, letters, kids): nodes by the level that reads them, with their edges (letter, child, letters that follow); END among letters ends a word."""
    # no state starts above half of the shortest word that can be near
    first = F.least(F.lit(PART), F.floor((F.col("size") - 1 + F.col("back")) / 2))
    steps = _strings(words).select("x", "back", "size", F.explode(F.sequence(F.greatest(first, F.lit(0)).cast("int"), "size")).alias("depth"))
    letter = F.when(F.col("depth") < F.col("size"), F.substring("x", F.col("depth") + 1, F.lit(1))).otherwise(F.lit(END))
    edge = steps.select(_node(F.col("back"), _prefix("x", F.col("depth"))).alias("node"), "depth", letter.alias("letter"), _node(F.col("back"), _prefix("x", F.col("depth") + 1)).alias("child"), (F.col("size") >= 2 * PART).alias("long"))
    edges = edge.groupBy("node", "letter").agg(F.max("depth").alias("depth"), F.max("child").alias("child"), F.max("long").alias("long"))
    edges = materialise(edges, "edges")
    letters = edges.groupBy("node").agg(F.array_join(F.collect_list("letter"), "").alias("next"))
    follow = edges.join(letters.withColumnRenamed("node", "child"), "child", "left")
    kid = F.when(F.col("letter") != END, F.struct("letter", "child", "next"))
    nodes = follow.groupBy("node").agg(F.max("depth").alias("depth"), F.max("long").alias("long"), F.array_join(F.collect_list("letter"), "").alias("letters"), F.collect_list(kid).alias("kids"))
    short = F.when(F.col("depth") <= 2 * PART + 1, F.array("depth")).otherwise(F.array().cast("array<int>"))
    long = F.when(F.col("long"), F.array(*[_level(F.col("depth")) + k * PART for k in range(3)])).otherwise(F.array().cast("array<int>"))
    return nodes.select("node", "letters", "kids", F.explode(F.array_union(short, long)).alias("level"))


def _seeds(words: DataFrame) -> DataFrame:
    """(x, back, pos, stop, node, edits, rest, level): a state for each part; ``rest`` is the hash of what follows the part."""
    s = _strings(words)
    size = F.col("size")
    long = size > 2 * PART
    middle = F.when(long, size - PART * (F.floor(size / PART) - 1)).otherwise(F.floor(size / 2)).cast("int")
    starts = F.when(F.col("back") == 1, F.array(size - middle)).when(long, F.sequence(middle, size - PART, F.lit(PART))).otherwise(F.array(middle))
    s = s.select("x", "back", "size", long.alias("long"), F.explode(starts).alias("pos"))
    stop = F.when((F.col("back") == 0) & F.col("long"), F.col("pos") + PART).otherwise(F.col("size"))
    s = s.withColumn("stop", stop)
    level = F.when(F.col("long"), _level(F.col("pos"))).otherwise(F.col("pos"))
    return s.select("x", "back", "pos", "stop", _node(F.col("back"), _prefix("x", F.col("pos"))).alias("node"), F.lit(0).alias("edits"), _rest("x", F.col("stop")).alias("rest"), level.alias("level"))


def _rest(x: str, at: Column) -> Column:
    return F.xxhash64(F.substring(F.col(x), at + 1, F.length(x)))


def _ends(words: DataFrame) -> DataFrame:
    """(node, rest, other): where a walk may end, the word's end or, in longer words, before a rest of whole parts."""
    s = _strings(words)
    cut = F.when((F.col("back") == 0) & (F.col("size") >= 2 * PART), F.sequence(F.lit(0), F.col("size") - 1, F.lit(PART))).otherwise(F.array(F.lit(0)))
    s = s.select("x", "back", "size", F.explode(cut).alias("left"))
    at = F.col("size") - F.col("left")
    word = F.when(F.col("back") == 1, F.reverse("x")).otherwise(F.col("x"))
    return s.select(_node(F.col("back"), _prefix("x", at)).alias("node"), _rest("x", at).alias("rest"), word.alias("other"))


def _moves() -> Column:
    """The states that follow a state on its node: an array of (pos, node, edits)."""
    pos, stop, size = F.col("pos"), F.col("stop"), F.length("x")
    at = lambda k: F.when(pos + k < size, F.substring("x", pos + k + 1, F.lit(1))).otherwise(F.lit(END))
    to = lambda p, node, edits: F.struct(p.cast("int").alias("pos"), node.alias("node"), F.lit(edits).alias("edits"))
    kids, none = F.col("kids"), F.array().cast("array<struct<pos:int,node:bigint,edits:int>>")
    along = lambda keep, p, edits: F.transform(F.filter("kids", keep), lambda k: to(p, k["child"], edits))
    here, after, later = at(0), at(1), at(2)
    follows = lambda k, c: F.contains(k["next"], c)
    inside = pos < stop
    same = along(lambda k: k["letter"] == here, pos + 1, 0)
    other = along(lambda k: (k["letter"] != here) & follows(k, after), pos + 1, 1)
    more = along(lambda k: (k["letter"] != here) & follows(k, here), pos, 1)
    last = along(lambda k: follows(k, F.lit(END)), pos, 1)  # an additional letter at the word's end
    # of a run of equal letters the last one goes; the next letter is walked in the same level
    can_skip = (pos + 1 == size) | (here != after)
    skip = F.when(pos + 1 == stop, F.when(F.contains("letters", after), F.array(to(pos + 1, F.col("node"), 1))).otherwise(none)).otherwise(
        along(lambda k: (k["letter"] == after) & follows(k, later), pos + 2, 1)
    )
    first = F.when(inside, F.concat(same, other, more, F.when(can_skip, skip).otherwise(none))).when(stop == size, last).otherwise(none)
    second = along(lambda k: (k["letter"] == here) & follows(k, after), pos + 1, 1)
    return F.when(F.col("edits") == 0, first).otherwise(second)


def neighbours(words: DataFrame) -> DataFrame:
    """(word, other) for every two words of ``words`` (word) that differ by one code point, both ways round.

    Words may repeat; NULL words are left out, the empty word is near to words of one letter.
    """
    words = materialise(words.where("word IS NOT NULL").select("word").distinct(), "words")
    nodes, seeds = _sliced(trie(words), "trie"), _sliced(_seeds(words), "seeds")
    state = ["x", "back", "pos", "stop", "node", "edits", "rest"]
    starts = {r.level for r in seeds.select("level").distinct().collect()}  # LEVELS at most
    open_, walked = None, []
    for level in LEVELS:
        if open_ is not None and open_.isEmpty():
            open_ = None
        if open_ is None and level not in starts:
            continue
        states = seeds.where(F.col("level") == level).select(state)
        states = states.union(open_.select(state)) if open_ is not None else states
        moved = states.join(nodes.where(F.col("level") == level).drop("level"), "node").withColumn("to", F.explode(_moves()))
        moved = materialise(moved.select("x", "back", F.col("to.pos").alias("pos"), "stop", F.col("to.node").alias("node"), F.col("to.edits").alias("edits"), "rest"), "frontier")
        walked.append(moved.where("edits = 1 AND pos = stop"))
        open_ = moved.where("edits = 0 OR pos < stop")
    if not walked:
        return words.select("word", F.col("word").alias("other")).where(F.lit(False))
    found = walked[0]
    for w in walked[1:]:
        found = found.union(w)
    word = F.when(F.col("back") == 1, F.reverse("x")).otherwise(F.col("x"))
    pairs = found.select(word.alias("word"), "node", "rest").distinct().join(_ends(words), ["node", "rest"]).select("word", "other").distinct()
    return pairs.where(F.levenshtein("word", "other", 1) == 1)


def _sliced(df: DataFrame, what: str) -> DataFrame:
    """A table with one folder for each level, of which a level reads its own."""
    return materialise(df, what, "level")


def groups(words: DataFrame, times: int = 5) -> DataFrame:
    """(word, n, form, form_n, n_near, root) of distinct ``words`` (word, n).

    A word's form is its most frequent neighbour (of equals the smallest in code-point order) if that is at least ``times``
    as frequent; the root is where forms end. Words with a NULL word are left out.
    """
    words = materialise(words.where("word IS NOT NULL").select("word", F.col("n").cast("long").alias("n")), "counts")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    near = neighbours(words).join(others, "other")
    best = near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("m"), F.col("other").alias("form"))).alias("b"))
    formed = words.join(best, "word", "left").withColumn("form_n", F.when(-F.col("b.m") >= times * F.col("n"), -F.col("b.m")))
    formed = materialise(formed.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), "form_n", F.when(F.col("form_n").isNotNull(), F.col("b.form")).alias("form")), "forms")
    roots = materialise(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")), "roots")
    while True:  # each round doubles the steps; n rises along them, so there is no way round
        further = roots.join(roots.select(F.col("word").alias("root"), F.col("root").alias("to")), "root", "left")
        moved = materialise(further.select("word", F.coalesce("to", "root").alias("root"), F.col("to").isNotNull().alias("moved")), "roots")
        roots = moved.drop("moved")
        if moved.where("moved").isEmpty():
            break
    return formed.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
