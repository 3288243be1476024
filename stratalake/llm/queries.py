"""Registered queries of this folder, with SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import resampling, trie, warc
from .common import read_table, remainder


def q_op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import FOLDS, identify, learn

    docs = read_table(spark, sf_dir, "documents")
    held = (remainder("doc_id", FOLDS) == 0).alias("held_out")
    return identify(docs, learn(docs), keep=["doc_id", held]).select(
        "doc_id", "held_out", "lang_pred", "score", "margin", "reliable"
    )


def q_op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    return mix(read_table(spark, sf_dir, "documents"))


def q_op3_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import format_pairs, with_foreign_reply

    chosen = read_table(spark, sf_dir, "conversations")
    flat = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws("+", s["start"], s["length"])), ",")
    return (
        format_pairs(chosen, with_foreign_reply(chosen))
        .withColumn("chosen_spans", flat("chosen_spans"))
        .withColumn("rejected_spans", flat("rejected_spans"))
    )


def q_op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def q_op5_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import search

    vectors = read_table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where("vec_id % 100 = 0"))


def q_op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .scoring import score

    return score(read_table(spark, sf_dir, "documents"))


def q_op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import FOLDS, learn, score

    docs = read_table(spark, sf_dir, "documents")
    held = (remainder("doc_id", FOLDS) == 0).alias("held_out")
    return score(docs, learn(docs, read_table(spark, sf_dir, "labels")), keep=["doc_id", held])


def q_op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import compare_neighbours

    return compare_neighbours(read_table(spark, sf_dir, "documents"))


def q_op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard import link_groups

    return link_groups(read_table(spark, sf_dir, "documents"))


def q_op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import FOLDS, learn, score

    docs = read_table(spark, sf_dir, "documents")
    held = (remainder("doc_id", FOLDS) == 0).alias("held_out")
    return score(docs, learn(docs, read_table(spark, sf_dir, "labels")), keep=["doc_id", held])


def q_op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def q_op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.rebuilt_trie(read_table(spark, sf_dir, "conversations"))


def q_op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(read_table(spark, sf_dir, "pages"))


QUERIES = {
    "op1_language_id": q_op1_language_id,
    "op2_mixing": q_op2_mixing,
    "op3_preference": q_op3_preference,
    "op4_packing": q_op4_packing,
    "op5_neighbours": q_op5_neighbours,
    "op6_lm_score": q_op6_lm_score,
    "op7_quality": q_op7_quality,
    "op8_fingerprint": q_op8_fingerprint,
    "op9_jaccard": q_op9_jaccard,
    "op10_toxicity": q_op10_toxicity,
    "op11_resampling": q_op11_resampling,
    "op12_prefix_trie": q_op12_prefix_trie,
    "op13_warc": q_op13_warc,
}

#: Sizes and targets with plain windows; then one walk through each source's ranks.
_MIX = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0 ELSE len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) END::BIGINT AS size
  FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size, sum(size * sqrt(size::DOUBLE)) AS mass FROM d GROUP BY 1),
w AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1)::INT] AS w, 2 * source_size AS lim FROM p),
l AS (SELECT *, lim / w AS level FROM w),
c AS (
  SELECT *,
    level <= (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(lim) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS capped
  FROM l
  WINDOW b AS (ORDER BY level, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT *, CASE WHEN capped THEN lim::DOUBLE ELSE
    w * ((1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(lim) FILTER (capped) OVER (), 0)) / sum(w) FILTER (NOT capped) OVER ()) END AS target
  FROM c),
s AS (SELECT source, source_size, mass, target, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM t),
r0 AS (SELECT *, floor(target)::BIGINT - whole * source_size AS room FROM s),
r AS (
  SELECT d.doc_id, d.size, r0.*, (('0x' || substr(md5('mix' || coalesce(d.doc_id::VARCHAR, '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE AS u,
    CASE WHEN mass > 0 THEN room * sqrt(d.size::DOUBLE) / mass ELSE 0 END AS p
  FROM d JOIN r0 ON d.source IS NOT DISTINCT FROM r0.source),
k AS (
  SELECT *, CASE WHEN p >= 1 THEN u - 1 WHEN p <= 0 THEN u + 1 ELSE
    ((u / (1 - u)) / (p / (1 - p))) / (1 + (u / (1 - u)) / (p / (1 - p))) END AS rank
  FROM r),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY rank, doc_id, size) AS i FROM k),
x AS (
  SELECT source, 0::BIGINT AS i, any_value(room) AS room, false AS extra FROM n GROUP BY 1
  UNION ALL
  SELECT n.source, n.i, x.room - CASE WHEN n.size BETWEEN 1 AND x.room THEN n.size ELSE 0 END, n.size BETWEEN 1 AND x.room
  FROM x JOIN n ON n.source IS NOT DISTINCT FROM x.source AND n.i = x.i + 1)
SELECT doc_id, size, source_size, target, (whole + extra::BIGINT) * size AS taken, n.source, whole + extra::BIGINT AS copies
FROM n JOIN x ON n.source IS NOT DISTINCT FROM x.source AND n.i = x.i
"""

#: Turn by turn; the sides differ first where their turns do.
_PREFERENCE = """
WITH said AS (SELECT conv_id, max(turn) AS last_turn, arg_max(text, turn) AS reply FROM conversations WHERE role = 'assistant' GROUP BY 1),
b AS (
  SELECT c.conv_id, c.turn, c.role, CASE WHEN c.turn = o.last_turn AND c.role = 'assistant' THEN m.reply ELSE c.text END AS text
  FROM conversations c LEFT JOIN said o ON o.conv_id = c.conv_id LEFT JOIN said m ON xor(m.conv_id, 1) = c.conv_id
  WHERE NOT coalesce(c.turn = o.last_turn AND c.role = 'assistant', false) OR m.conv_id IS NOT NULL),
s AS (
  SELECT conv_id, side, i, role, text, '<|im_start|>' || role || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body FROM (
    SELECT conv_id, role, text, 'c' AS side, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i FROM conversations
    UNION ALL SELECT conv_id, role, text, 'r', row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) FROM b)),
f AS (
  SELECT conv_id, coalesce(min(i) FILTER (NOT same), max(i) + 1) - 1 AS n FROM (
    SELECT coalesce(x.conv_id, y.conv_id) AS conv_id, coalesce(x.i, y.i) AS i, coalesce(x.role = y.role AND x.text = y.text, false) AS same
    FROM (SELECT * FROM s WHERE side = 'c') x FULL JOIN (SELECT * FROM s WHERE side = 'r') y ON x.conv_id = y.conv_id AND x.i = y.i)
  GROUP BY 1),
o AS (
  SELECT s.*, f.n, coalesce(sum(length(head) + length(body)) FILTER (i > n) OVER (PARTITION BY s.conv_id, side ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS pos
  FROM s JOIN f ON s.conv_id = f.conv_id)
SELECT conv_id AS pair_id, any_value(n)::INT AS prompt_turns,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 'c' AND i <= n), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 'c' AND i > n), '') AS chosen,
  coalesce(string_agg(pos::BIGINT || '+' || length(body), ',' ORDER BY i) FILTER (side = 'c' AND i > n AND role = 'assistant'), '') AS chosen_spans,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (side = 'r' AND i > n), '') AS rejected,
  coalesce(string_agg(pos::BIGINT || '+' || length(body), ',' ORDER BY i) FILTER (side = 'r' AND i > n AND role = 'assistant'), '') AS rejected_spans
FROM o GROUP BY 1
"""

#: Shingle sets joined on every shingle, links closed recursively.
_JACCARD = """
WITH RECURSIVE d AS (
  SELECT doc_id, CASE WHEN text IS NULL THEN [] ELSE
    regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') END AS w
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, list_aggregate(w[i : i + 3], 'string_agg', ' ') AS sh
  FROM (SELECT doc_id, w, unnest(CASE WHEN len(w) = 0 THEN [] ELSE range(1, greatest(len(w) - 3, 1) + 1) END) AS i FROM d)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
e AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2)
  JOIN n AS m ON a = m.doc_id JOIN n AS o ON b = o.doc_id WHERE 100 * c >= 85 * (m.n + o.n - c)),
r AS (SELECT doc_id, doc_id AS seen FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.seen = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(seen) AS component_id FROM r GROUP BY 1) c USING (doc_id)
"""

ORACLE_SQL: dict[str, str] = {
    "op2_mixing": _MIX,
    "op3_preference": _PREFERENCE,
    "op9_jaccard": _JACCARD,
    "op11_resampling": resampling.SQL,
    "op12_prefix_trie": trie.SQL,
    "op13_warc": warc.SQL,
}
