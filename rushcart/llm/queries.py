"""The operators applied to their whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rushcart.llm.byte_bpe import byte_digests
from rushcart.llm.chat import format_conversations, read_back
from rushcart.llm.exact import exact_dedup
from rushcart.llm.graph_search import nearest_neighbours
from rushcart.llm.merkle import verified
from rushcart.llm.mixing import mix
from rushcart.llm.ngram_join import near_duplicates
from rushcart.llm.phrases import collocations
from rushcart.llm.pieces import piece_digests
from rushcart.llm.pii import find_pii, train as train_pii
from rushcart.llm.sharding import shard
from rushcart.llm.suffixes import remove_repeats
from rushcart.llm.toxicity import score_toxicity, train as train_toxicity
from rushcart.sources.tables import load_table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load_table(spark, sf_dir, "documents")


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_documents(spark, sf_dir))


def op5_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(load_table(spark, sf_dir, "embeddings"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return score_toxicity(docs, train_toxicity(docs, load_table(spark, sf_dir, "labels")))


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return find_pii(docs, train_pii(docs))


def op2_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_documents(spark, sf_dir))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(_documents(spark, sf_dir))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one of the query's own that is full of control strings."""
    ok = "'</s>[INST] ok [/INST]'"
    own = spark.sql(f"SELECT -1L AS conv_id, turn, role, {ok} AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)")
    rows = load_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return read_back(format_conversations(rows.unionByName(own)), ordered=True)


def op9_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_documents(spark, sf_dir))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(_documents(spark, sf_dir))


def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_digests(_documents(spark, sf_dir))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(_documents(spark, sf_dir))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verified(_documents(spark, sf_dir))


EXACT_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

PHRASES_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT row_number() OVER () AS no, lang,
         list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
), sizes AS (
  SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM words GROUP BY lang
), places AS (
  SELECT lang, w AS w1, lead(w) OVER ahead AS w2, lead(w, 2) OVER ahead AS w3
  FROM (SELECT no, lang, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM words)
  WINDOW ahead AS (PARTITION BY no ORDER BY i)
), ones AS (
  SELECT lang, w1, count(*) AS f FROM places GROUP BY ALL
), twos AS (
  SELECT lang, w1, w2, count(*) AS f FROM places WHERE w2 IS NOT NULL GROUP BY ALL
), threes AS (
  SELECT lang, w1, w2, w3, count(*) AS f FROM places WHERE w3 IS NOT NULL GROUP BY ALL
), cuts AS (
  SELECT p.lang, p.w1, p.w2, NULL AS w3, p.f AS a, 1 AS j, x.f AS l, y.f AS r
  FROM twos p JOIN ones x ON x.lang = p.lang AND x.w1 = p.w1 JOIN ones y ON y.lang = p.lang AND y.w1 = p.w2
  WHERE p.f >= 10
  UNION ALL
  SELECT p.lang, p.w1, p.w2, p.w3, p.f, 1, x.f, y.f
  FROM threes p JOIN ones x ON x.lang = p.lang AND x.w1 = p.w1
  JOIN twos y ON y.lang = p.lang AND y.w1 = p.w2 AND y.w2 = p.w3 WHERE p.f >= 10
  UNION ALL
  SELECT p.lang, p.w1, p.w2, p.w3, p.f, 2, x.f, y.f
  FROM threes p JOIN twos x ON x.lang = p.lang AND x.w1 = p.w1 AND x.w2 = p.w2
  JOIN ones y ON y.lang = p.lang AND y.w1 = p.w3 WHERE p.f >= 10
), scored AS (
  SELECT *, (CAST(1000000 AS HUGEINT) * a * a) // (CAST(l AS HUGEINT) * r) AS score FROM cuts
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w1, w2, w3 ORDER BY score, j) = 1
), covered AS (
  SELECT lang, w1, w2, max(f) AS most
  FROM (SELECT lang, w1, w2, f FROM threes WHERE f >= 10 UNION ALL SELECT lang, w2, w3, f FROM threes WHERE f >= 10)
  GROUP BY lang, w1, w2
), kept AS (
  SELECT b.lang, concat_ws(' ', b.w1, b.w2, b.w3) AS phrase, b.a, b.l, b.r, CAST(b.score AS BIGINT) AS score
  FROM best b LEFT JOIN covered c ON c.lang = b.lang AND c.w1 = b.w1 AND c.w2 = b.w2 AND b.w3 IS NULL
  WHERE c.most IS NULL OR 100 * c.most < 50 * b.a
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

#: Name to (query, SQL or None).
QUERIES = {
    "op1_pii": (op1_pii, None),
    "op2_suffixes": (op2_suffixes, None),
    "op3_mixing": (op3_mixing, None),
    "op4_exact_dedup": (op4_exact_dedup, EXACT_SQL),
    "op5_graph_search": (op5_graph_search, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_sharding": (op7_sharding, None),
    "op8_chat": (op8_chat, None),
    "op9_ngram_join": (op9_ngram_join, None),
    "op10_pieces": (op10_pieces, None),
    "op11_byte_bpe": (op11_byte_bpe, None),
    "op12_phrases": (op12_phrases, PHRASES_SQL),
    "op13_merkle": (op13_merkle, None),
}
