"""Registered queries of the operators and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from quotepanel.llm import bpe, chat, credentials, jaccard, langid, lexical, manifest, mixing, neardup, quality, repeats, sharding, toxicity
from quotepanel.llm.common import held_out, table
from quotepanel.session import stored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL if there is one."""

    def add(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


OP2_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 9) || substr(md5(coalesce(text, '')), 1, 9) AS place
  FROM documents),
totals AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM sized GROUP BY source),
caps AS (SELECT *, source_size::DOUBLE * 2 AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5 AS want FROM totals),
filled AS (
  SELECT *, want - coalesce(sum(cap) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
         sum(weight) OVER (ORDER BY cap / weight, source IS NULL, encode(source) ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM caps),
level AS (
  SELECT arg_min(left_over / weights, cap / weight) AS level FROM filled WHERE left_over * weight <= cap * weights),
goals AS (SELECT source, source_size, coalesce(least(cap, weight * level), cap) AS target FROM filled CROSS JOIN level),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM goals),
places AS (SELECT source, place, sum(size) AS n FROM sized GROUP BY source, place),
running AS (SELECT *, sum(n) OVER (PARTITION BY source ORDER BY place) AS upto FROM places),
edges AS (
  SELECT r.source, min(place) AS edge, arg_min(upto, place) AS upto, arg_min(n, place) AS n
  FROM running r JOIN budgets b ON r.source IS NOT DISTINCT FROM b.source
  WHERE upto > target - whole * source_size GROUP BY r.source)
SELECT s.doc_id, s.size, b.source_size, b.target,
       CASE WHEN s.size = 0 THEN 0 ELSE s.size * (b.whole + CASE WHEN s.place < e.edge
            OR s.place = e.edge AND (b.target - b.whole * b.source_size - (e.upto - e.n)) * 2 >= e.n THEN 1 ELSE 0 END) END::BIGINT AS taken
FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
LEFT JOIN edges e ON s.source IS NOT DISTINCT FROM e.source
"""


@query(OP2_SQL)
def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture(table(spark, sf_dir, "documents"))


OP5_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
texts AS (
  SELECT conv_id, count(*)::BIGINT AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<|turn:') + length(role) + length(role) - length(translate(role, '\|<[', '')) + length('|>') + 1
             + length(text) + len(regexp_extract_all(text, '[<\[]\\*(?:\|[^|<]*\|>|/?s>|/?INST\]|</?SYS>>)')) + length('<|end|>') + 1) AS chars
  FROM turns GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
       (chars + length('<s></s>'))::BIGINT AS formatted_chars
FROM texts
"""


@query(OP5_SQL)
def op5_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = F.lit("</s>[INST] ok [/INST]").alias("text")
    added = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), text
    )
    rows = conversations.unionByName(added)
    return chat.digest(chat.render(chat.reconstruct(chat.log_of(rows))))


def byte_vocabulary() -> tuple[list[bytes], str]:
    return bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")), public_tokenizers.PATTERN


def token_digest(rows: DataFrame) -> DataFrame:
    return rows.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query()
def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_digest(bpe.tokenized(documents, *byte_vocabulary()))


def fertility_vocabularies() -> list[list[bytes]]:
    return [bpe.read_ranks(public_tokenizers.path(f"{name}.tiktoken")) for name in ("byte_bpe_50k", "byte_bpe_multi_50k")]


@query()
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = stored(quality.measured(documents, fertility_vocabularies(), public_tokenizers.PATTERN), "quality-measures")
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return quality.judged(rows).select("doc_id", *counts, "base_failed", "kept")


@query()
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(documents, table(spark, sf_dir, "labels").select("doc_id", "toxic"))
    score = F.col("score")
    return toxicity.scored(documents, model).select("doc_id", held_out().alias("held_out"), score, (score >= 0.3).cast("int").alias("predicted"))


@query()
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = langid.learn(documents.select("doc_id", "text", "lang"))
    found = langid.predicted(documents.select("doc_id", "text"), model)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


OP8_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings WHERE embedding IS NOT NULL),
good AS (
  SELECT vec_id, e FROM v WHERE len(e) > 0 AND CASE WHEN len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 THEN list_inner_product(e, e) > 0 ELSE false END),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
roots AS (SELECT node, least(node, min(other)) AS root FROM reach GROUP BY node)
SELECT e.vec_id, (SELECT count(*) FROM links WHERE a = e.vec_id)::BIGINT AS n_links,
       coalesce(root, e.vec_id) AS component_id, e.vec_id = coalesce(root, e.vec_id) AS kept
FROM embeddings e LEFT JOIN roots ON node = e.vec_id
"""


@query(OP8_SQL)
def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


OP3_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) END AS s FROM words),
classes AS (SELECT min(doc_id) AS rep, s FROM (SELECT doc_id, list_sort(s) AS s FROM sets) WHERE len(s) > 0 GROUP BY s),
items AS (SELECT rep, len(s) AS n, unnest(s) AS x FROM classes),
common AS (SELECT a.rep AS a, b.rep AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
  FROM items a JOIN items b ON a.x = b.x AND a.rep < b.rep AND a.n * 100 >= b.n * 90 AND b.n * 100 >= a.n * 90 GROUP BY a.rep, b.rep),
half AS (SELECT a, b FROM common WHERE 100 * c >= 90 * (na + nb - c)),
links AS (SELECT a, b FROM half UNION ALL SELECT b, a FROM half),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a),
roots AS (SELECT node, least(node, min(other)) AS root FROM reach GROUP BY node)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(r.root, c.rep, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON list_sort(s.s) = c.s LEFT JOIN roots r ON r.node = c.rep
"""


@query(OP3_SQL)
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"), 3, 90, 100)


def repeat_digest(rows: DataFrame) -> DataFrame:
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query()
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_digest(repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")))


OP6_SQL = """
WITH RECURSIVE shards AS (
  SELECT range AS shard, 'shard-' || lpad(range::VARCHAR, 5, '0') AS name FROM range(32)),
preference AS (
  SELECT list(('0x' || substr(md5(name || ' offset'), 1, 12))::BIGINT % 4099 ORDER BY shard) AS starts,
         list(('0x' || substr(md5(name || ' skip'), 1, 12))::BIGINT % 4098 + 1 ORDER BY shard) AS skips
  FROM shards),
turns AS (
  SELECT 0 AS turn, list_transform(range(4099), lambda x: -1) AS filled
  UNION ALL
  SELECT turn + 1, filled[:slot] || [turn % 32] || filled[slot + 2:]
  FROM (
    SELECT turn, filled,
           (starts[turn % 32 + 1] + skips[turn % 32 + 1] * list_filter(range(4099),
              lambda j: filled[(starts[turn % 32 + 1] + j * skips[turn % 32 + 1]) % 4099 + 1] < 0)[1]) % 4099 AS slot
    FROM turns, preference WHERE turn < 4099)),
slots AS (SELECT unnest(range(4099)) AS slot, unnest(filled) AS shard FROM turns WHERE turn = 4099)
SELECT doc_id, slot::BIGINT AS slot, shard::BIGINT AS shard
FROM (SELECT doc_id, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT % 4099 AS slot FROM documents) JOIN slots USING (slot)
"""


@query(OP6_SQL)
def op6_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), F.col("doc_id"), sharding.shard_names())


OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS rid,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents),
totals AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_words FROM docs),
tf AS (
  SELECT rid, any_value(doc_id) AS doc_id, term, count(*) AS tf, any_value(n) AS n
  FROM (SELECT rid, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs) GROUP BY rid, term),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
asked AS (
  SELECT no, any_value(item_id) AS item_id, term, count(*) AS times
  FROM (SELECT item_id, row_number() OVER () AS no,
          unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY no, term),
scores AS (
  SELECT no, any_value(item_id) AS item_id, rid, any_value(doc_id) AS doc_id,
         sum(times * floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * n_docs) // n_words))))::BIGINT AS score
  FROM asked JOIN df USING (term) JOIN tf USING (term), totals GROUP BY no, rid),
placed AS (SELECT *, row_number() OVER (PARTITION BY no ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM placed WHERE rank <= 20
"""


@query(OP11_SQL)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op12_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = credentials.found_secrets(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2("base", 256).alias("base_sha256"), "spans", "n_added")


OP13_SQL = """
WITH RECURSIVE fields AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS key, doc_id::VARCHAR AS id, text,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
         || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head
  FROM documents),
digests AS (
  SELECT doc_id, key, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         CASE WHEN id IS NOT NULL AND xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(len(id)), lambda i: ascii(id[i + 1])::BIGINT)),
             lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, k: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 5 = 0
           THEN sha256(head || coalesce(strlen(low) || ':' || low, '-')) END AS changed
  FROM fields),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, row_number() OVER () AS rid FROM digests),
nodes AS (
  SELECT key, 0 AS level, pos AS idx, leaf AS digest, count(*) OVER (PARTITION BY key) AS n FROM placed
  UNION ALL
  SELECT key, any_value(level) + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 15) // 16)
  FROM nodes WHERE n > 1 GROUP BY key, idx // 16),
subroots AS (
  SELECT key, digest AS subroot, level AS height, row_number() OVER (ORDER BY key) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS level, pos AS idx, subroot AS digest, n FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, idx // 16, sha256(string_agg(digest, '' ORDER BY idx)), any_value((n + 15) // 16)
  FROM tops WHERE n > 1 GROUP BY idx // 16),
heights AS (SELECT s.key, s.subroot, s.height, s.pos AS rank, t.level AS top_height, t.digest AS root FROM subroots s, tops t WHERE t.n = 1),
steps AS (
  SELECT p.rid, step, CASE WHEN step < height THEN p.pos // (16 ** step)::BIGINT ELSE rank // (16 ** (step - height))::BIGINT END AS own,
         CASE WHEN step < height THEN p.key END AS tree, CASE WHEN step < height THEN step ELSE step - height END AS level
  FROM placed p JOIN heights h ON p.key = h.key, LATERAL (SELECT unnest(range(h.height + h.top_height)) AS step)),
every AS (SELECT key AS tree, level, idx, digest FROM nodes UNION ALL SELECT NULL, level, idx, digest FROM tops),
runs AS (
  SELECT s.rid, s.step, s.own, e.idx, e.digest FROM steps s
  JOIN every e ON s.tree IS NOT DISTINCT FROM e.tree AND s.level = e.level AND s.own // 16 = e.idx // 16),
proofs AS (SELECT rid, sha256(coalesce(string_agg(digest, '' ORDER BY step, idx) FILTER (idx <> own), '')) AS proof FROM runs GROUP BY rid),
folds AS (
  SELECT rid, 0 AS step, coalesce(changed, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.rid, any_value(f.step) + 1, sha256(string_agg(CASE WHEN r.idx = r.own THEN f.digest ELSE r.digest END, '' ORDER BY r.idx))
  FROM folds f JOIN runs r ON f.rid = r.rid AND f.step = r.step GROUP BY f.rid),
folded AS (SELECT rid, arg_max(digest, step) AS folded_root FROM folds GROUP BY rid)
SELECT p.doc_id, p.leaf, h.subroot, h.root, coalesce(q.proof, sha256('')) AS proof_sha256, f.folded_root, f.folded_root = h.root AS verified
FROM placed p JOIN heights h ON p.key = h.key JOIN folded f ON p.rid = f.rid LEFT JOIN proofs q ON p.rid = q.rid
"""


@query(OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.manifest(table(spark, sf_dir, "documents")).drop("copied")
