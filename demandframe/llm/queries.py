"""Registered queries of the operators, and the SQL that must give the same rows."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from demandframe.llm import bpe_backtrack, conversation_trie, embedding_dedup, line_dedup, packing, pii, quality, sentencepiece_fst, simhash, spelling, token_store, toxicity, url_filter
from demandframe.llm.common import LOWER, UPPER, ascii_lower, materialise


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: The site rules of the URL query.
SITE_RULES = (
    url_filter.SiteRule("block", "net", "/"),
    url_filter.SiteRule("allow", "example.net", "/en/"),
    url_filter.SiteRule("block", "example.com", "/de/"),
    url_filter.SiteRule("allow", "org", "/fr/"),
)


def op1_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = _table(spark, folder, "pages").select("page_id", "url")
    return url_filter.judge(pages, SITE_RULES).select("page_id", "host", "path", "rule", "verdict", "pattern")


_WORDS = "|".join(r.pattern.strip("^") for r in url_filter.UNWANTED)
OP1_SQL = f"""
WITH r AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM r),
m AS (SELECT *, CASE
    WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
    WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/' END AS rule,
  list_sort(list_filter(regexp_split_to_array(translate(host || ' ' || path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+'), lambda x: regexp_full_match(x, '{_WORDS}')))[1] AS word FROM h)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN word IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL AND word IS NOT NULL THEN '^' || word || '^' END AS pattern FROM m
"""

QUERIES = {"op1_url_filter": op1_url_filter}
SQL = {"op1_url_filter": OP1_SQL}


def op3_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), 0, special_as_text=False).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op7_token_store(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    path = token_store.write(docs, public_tokenizers.path("word_bpe_49k.json"), 2, special_as_text=False)
    return token_store.read_digest(spark, path)


QUERIES |= {"op3_packing": op3_packing, "op7_token_store": op7_token_store}


def op2_simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.groups(_table(spark, folder, "documents"), words=3, budget=2)
    return found.select("doc_id", simhash.hex16(F.col("fp")).alias("fingerprint"), "component_id")


QUERIES["op2_simhash"] = op2_simhash


def op10_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, folder, "embeddings"), 0.95)


QUERIES["op10_embedding_dedup"] = op10_embedding_dedup
SQL["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
c AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.95),
r(vec_id, seen) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.vec_id, c.b FROM r JOIN c ON c.a = r.seen),
m AS (SELECT vec_id, min(seen) AS component_id FROM r GROUP BY vec_id)
SELECT m.vec_id, (SELECT count(*) FROM c WHERE c.a = m.vec_id) AS n_links, component_id, m.vec_id = component_id AS kept FROM m
"""


def op9_pii(spark: SparkSession, folder: str) -> DataFrame:
    found = pii.find(_table(spark, folder, "documents"))
    of = lambda *kinds: F.filter("spans", lambda s: s["kind"].isin([pii.KINDS.index(k) for k in kinds]))
    base = pii.KINDS[:4]
    counts = [F.size(of(k)).cast("long").alias(f"n_{k}") for k in base]
    return found.select("doc_id", *counts, F.sha2(pii.told(of(*base)), 256).alias("base_sha256"), pii.told(F.col("spans")).alias("spans"))


QUERIES["op9_pii"] = op9_pii


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    model = toxicity.train(docs, labels.where(~toxicity.held_out(F.col("doc_id"))))
    rows = toxicity.scored(docs.select("doc_id", "text"), model)
    return rows.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


QUERIES["op5_toxicity"] = op5_toxicity


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return quality.judged(docs, quality.train(docs, labels))


QUERIES["op6_quality"] = op6_quality


def op4_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = line_dedup.remove_boilerplate(_table(spark, folder, "documents"))
    return found.select("doc_id", "text", "n_lines", "n_removed")


def line_dedup_sql(docs: str = "documents", min_sites: int = line_dedup.MIN_SITES) -> str:
    """The same rows (row_id, text, removed) by exact counts."""
    return f"""
lines AS (SELECT row_id, source, text, generate_subscripts(string_split(text, chr(10)), 1) AS place, trim(unnest(string_split(text, chr(10))), chr(32) || chr(9) || chr(11) || chr(12) || chr(13)) AS line FROM {docs}),
wide AS (SELECT line FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT coalesce(source, '')) >= {min_sites}),
gone AS (SELECT row_id, place FROM lines JOIN wide USING (line)),
kept AS (SELECT l.row_id, string_agg(list_extract(string_split(text, chr(10)), place), chr(10) ORDER BY place) AS kept FROM lines l ANTI JOIN gone g ON l.row_id = g.row_id AND l.place = g.place GROUP BY l.row_id),
counted AS (SELECT row_id, count(*) AS n_removed FROM gone GROUP BY row_id),
cleaned AS (SELECT d.* EXCLUDE (text), CASE WHEN n_removed IS NULL THEN d.text ELSE coalesce(kept, '') END AS text, coalesce(len(string_split(d.text, chr(10))), 0) AS n_lines, coalesce(n_removed, 0) AS n_removed
  FROM {docs} d LEFT JOIN kept USING (row_id) LEFT JOIN counted USING (row_id))"""


QUERIES["op4_line_dedup"] = op4_line_dedup
SQL["op4_line_dedup"] = f"""
WITH docs AS (SELECT row_number() OVER () AS row_id, * FROM documents), {line_dedup_sql("docs")}
SELECT doc_id, text, n_lines::INTEGER AS n_lines, n_removed::INTEGER AS n_removed FROM cleaned
"""


def op8_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts to ids and back: numbers and CRC-32 of the ids, and the CRC-32 of the decoded text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    back = sentencepiece_fst.decode(sentencepiece_fst.encode(_table(spark, folder, "documents"), model), model)
    return back.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_ids"), F.crc32("ids").alias("ids_crc32"), F.crc32(F.col("text").cast("binary")).alias("text_crc32"))


QUERIES["op8_sentencepiece"] = op8_sentencepiece


def op11_bpe(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    ids = bpe_backtrack.encode(_table(spark, folder, "documents").select("doc_id", "text"), path)
    back = bpe_backtrack.decode(ids, path)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined, 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"))


QUERIES["op11_bpe"] = op11_bpe


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of the rebuilt conversations: the first h turns of conversation c - c % 5, then c's own after its first h, with h = crc32(c) % 9."""
    convs = turns.select("conv_id").distinct().withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % 9)
    donors = turns.where("pos <= 8").withColumnRenamed("conv_id", "donor")
    heads = convs.withColumn("donor", F.col("conv_id") - F.col("conv_id") % 5).join(donors, "donor").where("pos <= h").select(turns.columns)
    taken = heads.groupBy("conv_id").agg(F.count("*").alias("taken"))
    shifts = convs.join(taken, "conv_id", "left").select("conv_id", "h", F.coalesce("taken", F.lit(0)).alias("taken"))
    own = turns.join(shifts, "conv_id").where("pos > h").withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    return heads.union(own.select(turns.columns)), convs.select("conv_id")


def op12_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = materialise(conversation_trie.numbered(_table(spark, folder, "conversations")), "numbered")
    return conversation_trie.trie(*rebuilt(turns))


QUERIES["op12_conversation_trie"] = op12_conversation_trie

#: CRC-32 in SQL: a table of 256 steps, made by the rule of its polynomial, and one step per byte of a list.
CRC_TABLE = """(SELECT list(v ORDER BY i) AS steps FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i)))"""


def crc_sql(octets: str) -> str:
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda a, b: xor(a >> 8, steps[(xor(a, b) & 255) + 1])), 4294967295)"


SQL["op12_conversation_trie"] = f"""
WITH crc AS {CRC_TABLE},
d AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(length(role) || ':' || role || text ORDER BY turn NULLS FIRST, substr(sha256(length(role) || ':' || role || text), 1, 30)) AS turns,
  list(strlen(text) ORDER BY turn NULLS FIRST, substr(sha256(length(role) || ':' || role || text), 1, 30)) AS bytes FROM d GROUP BY conv_id),
h AS (SELECT own.*, {crc_sql("list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda k: unicode(substr(conv_id::VARCHAR, k, 1))::BIGINT)")} % 9 AS h FROM own, crc),
r AS (SELECT h.conv_id, list_concat(coalesce(list_slice(f.turns, 1, h.h), []), list_slice(h.turns, h.h + 1, len(h.turns))) AS turns,
  list_concat(coalesce(list_slice(f.bytes, 1, h.h), []), list_slice(h.bytes, h.h + 1, len(h.bytes))) AS bytes FROM h LEFT JOIN own f ON f.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, d AS depth, list_slice(turns, 1, d) AS node, CASE WHEN d > 0 THEN list_slice(turns, 1, d - 1) END AS parent, CASE WHEN d > 0 THEN bytes[d] ELSE 0 END AS bytes, d = len(turns) AS last
  FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM r)),
n AS (SELECT node, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(parent) AS parent, count(*) AS n_convs, any_value(bytes) AS bytes,
  sha256(coalesce(string_agg(CASE WHEN last THEN conv_id::VARCHAR END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM p GROUP BY node),
k AS (SELECT parent AS node, count(*) AS n_children FROM n WHERE parent IS NOT NULL GROUP BY parent),
w AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN n_children IS NULL THEN 1 ELSE 0 END AS leaf, (n_convs - 1) * bytes AS saved FROM n LEFT JOIN k USING (node)),
up AS (SELECT list_slice(node, 1, d) AS node, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM (SELECT *, unnest(range(depth + 1)) AS d FROM w) GROUP BY 1)
SELECT w.conv_id, w.depth, a.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, w.ends_sha256
FROM w JOIN up USING (node) LEFT JOIN n a ON a.node = w.parent
"""


#: Letters of a run, the divisor that picks the runs that lose a letter, the shortest and rarest word.
LETTERS, LOSES, LEAST_LETTERS, LEAST_TIMES = "A-Za-z\u00C0-\u00FF", 199, 6, 5


def mangled_words(docs: DataFrame) -> DataFrame:
    """(word, n): runs of letters, A-Z in lower case; where 199 divides the CRC-32 h of "doc_id:run", letter h % length is missing."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(f"[{LETTERS}]{{{LEAST_LETTERS},}}"), F.lit(0))).alias("run"))
    plain = F.octet_length("run") == F.length("run")
    runs = runs.select("doc_id", F.when(plain, F.lower("run")).otherwise(ascii_lower(F.col("run"))).alias("run"))
    h = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("run")).cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.length("run")))
    words = runs.withColumn("h", h).select(F.when(F.col("h") % LOSES == 0, cut).otherwise(F.col("run")).alias("word"))
    return words.groupBy("word").agg(F.count("*").alias("n")).where((F.col("n") >= LEAST_TIMES) & (F.length("word") >= LEAST_LETTERS))


def op13_spelling(spark: SparkSession, folder: str) -> DataFrame:
    found = spelling.groups(mangled_words(_table(spark, folder, "documents")))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


QUERIES["op13_spelling"] = op13_spelling
SQL["op13_spelling"] = f"""
WITH RECURSIVE crc AS {CRC_TABLE},
runs AS (SELECT doc_id, run, count(*) AS n FROM (SELECT doc_id, translate(unnest(regexp_extract_all(text, '[{LETTERS}]{{6,}}')), '{UPPER}', '{LOWER}') AS run FROM documents) GROUP BY ALL),
h AS (SELECT run, n, {crc_sql("flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda c: CASE WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [192 + (unicode(c) >> 6), 128 + (unicode(c) & 63)] END))")} AS h FROM runs, crc),
m AS (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM m GROUP BY word HAVING sum(n) >= 5 AND length(word) >= 6),
k AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS less, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS any_at FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (SELECT a.word, b.word AS other FROM k a JOIN k b ON a.any_at = b.any_at AND a.word <> b.word
  UNION SELECT k.word, w.word FROM k JOIN w ON k.less = w.word UNION SELECT w.word, k.word FROM k JOIN w ON k.less = w.word),
best AS (SELECT near.word, count(*) AS n_near, arg_min(other, (-o.n, other)) AS form, max(o.n) AS form_n FROM near JOIN w o ON o.word = other GROUP BY near.word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * n THEN form END AS form, CASE WHEN form_n >= 5 * n THEN form_n END AS form_n FROM w LEFT JOIN best USING (word)),
r AS (SELECT word, word AS at, form AS to FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.to)
SELECT f.word, f.form, r.at AS root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word AND r.to IS NULL
"""
