"""The operators of this package as queries over a folder of Parquet tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotflow.llm import conversations, langid, language_model, latent, mixing, negatives, ordinal, packing, simhash, sitetree, spotsigs, substrings, subwords
from depotflow.llm.common import held_out, table, tokenizer_path


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and the components of fingerprints within 3 bits."""
    return simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents outside passages of 35 words that start more than once."""
    return substrings.substring_digests(table(spark, sf_dir, "documents"), length=35)


OP7_SQL = r"""
WITH words AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT rid, p, array_to_string(w[p:p + 34], ' ') AS seq
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS p FROM words)
), repeated AS (
  SELECT rid, list(p) AS starts
  FROM (SELECT rid, p, count(*) OVER (PARTITION BY seq) AS n FROM windows) WHERE n > 1 GROUP BY rid
), covered AS (
  SELECT rid, list_sort(list(DISTINCT pos)) AS gone
  FROM (SELECT rid, unnest(range(s, s + 35)) AS pos FROM (SELECT rid, unnest(starts) AS s FROM repeated)) GROUP BY rid
), exploded AS (
  SELECT rid, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM words
), kept AS (
  SELECT e.rid, string_agg(e.word, ' ' ORDER BY e.pos) AS text, count(*) AS n
  FROM exploded e LEFT JOIN (SELECT rid, unnest(gone) AS pos FROM covered) g ON e.rid = g.rid AND e.pos = g.pos
  WHERE g.rid IS NULL GROUP BY e.rid
)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM words w LEFT JOIN kept k ON w.rid = k.rid
"""


def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spot-signature fingerprints of all documents and of their edited texts."""
    return spotsigs.edited_fingerprints(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates of all documents that bring the soft domains of the labels to their target weights."""
    return mixing.mixing_rates(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return sitetree.extract_main_text(table(spark, sf_dir, "pages"))


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log-probabilities of all documents under a model of those that are not held out."""
    return language_model.language_model_scores(table(spark, sf_dir, "documents"), held_out(10, 0))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those whose fold is not held out."""
    docs = table(spark, sf_dir, "documents")
    return langid.document_languages(docs, langid.fit_languages(docs, ~held_out(4, 2)))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from labels whose fold is not held out."""
    docs = table(spark, sf_dir, "documents")
    model = subwords.fit_quality(docs, table(spark, sf_dir, "labels"), ~held_out(3, 1))
    return subwords.quality_scores(docs, model)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expected severity and grade of every document, learned from the toxicity labels."""
    docs = table(spark, sf_dir, "documents")
    return ordinal.severities(docs, ordinal.fit_ordinal(docs, table(spark, sf_dir, "labels")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that documents contain, verbatim or paraphrased."""
    return latent.benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest repair of every damaged conversation, as counts, audit and digest."""
    rows = conversations.damaged(table(spark, sf_dir, "conversations"))
    return conversations.repair_digests(conversations.repair_conversations(rows))


def _crc32_of(text: str) -> str:
    """CRC-32 of a text of ASCII characters in SQL that has no such function."""
    step = "xor(acc, code) & 255"
    for _ in range(8):
        step = f"list_transform([{step}], lambda v: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))[1]"
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    summed = f"list_reduce(list_prepend(4294967295::BIGINT, {codes}), lambda acc, code: xor(acc >> 8, {step}))"
    return f"xor({summed}, 4294967295)"


def _over(value: str, cost: int, letter: str) -> str:
    """A path, ten digits of cost and then its letters, one edit longer."""
    return f"lpad((CAST(substr({value}, 1, 10) AS BIGINT) + {cost})::VARCHAR, 10, '0') || substr({value}, 11) || '{letter}'"


def _op11_sql() -> str:
    inserted = f"""
      SELECT *, v0 AS w0, v1 AS w1, u2 AS w2, least(v3, {_over('u2', 5, 'I')}) AS w3
      FROM (SELECT *, least(v2, {_over('v0', 5, 'I')}, {_over('v1', 5, 'I')}, {_over('v3', 5, 'I')}) AS u2 FROM {{source}})"""
    live, more = "fault < 2", "CASE WHEN fault = 1 THEN 5 ELSE 0 END"

    def edit(value: str, extra: int, letter: str, when: str) -> str:
        return f"CASE WHEN {live} AND {when} THEN {_over(value, f'{more} + {extra}', letter)} END"

    def into_user(value: str) -> str:
        return edit(value, 0, "K", "initial = 'u'") + ", " + edit(value, 1, "R", "true")

    return rf"""
WITH RECURSIVE kinds AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {_crc32_of("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS kind FROM conversations
), damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM kinds
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p FROM damaged
), judged AS (
  SELECT *, substr(role, 1, 1) AS initial,
         CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 2
              WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY p) > 1 THEN 3
              WHEN NOT regexp_matches(text, '[.!?][ 	-
]*\z') THEN 1 ELSE 0 END AS fault,
         lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY p) || substr(role, 1, 1) AS pair
  FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 2) AS blank, count(*) FILTER (fault = 3) AS duplicate, count(*) FILTER (fault = 1) AS truncated,
         count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY conv_id
), paths AS (
  SELECT conv_id, 0::BIGINT AS p, '0000000000' AS v0, NULL::VARCHAR AS v1, NULL::VARCHAR AS v2, NULL::VARCHAR AS v3 FROM counted
  UNION ALL
  SELECT conv_id, p, {_over('w0', 2, 'D')},
         least({_over('w1', 2, 'D')}, {edit('w0', 0, 'K', "initial = 's'")}),
         least({_over('w2', 2, 'D')}, {into_user('w0')}, {into_user('w1')}, {into_user('w3')}),
         least({_over('w3', 2, 'D')}, {edit('w2', 0, 'K', "initial = 'a'")}, {edit('w2', 1, 'R', 'true')})
  FROM ({inserted.format(source="(SELECT s.conv_id, j.p, v0, v1, v2, v3, initial, fault FROM paths s JOIN judged j ON s.conv_id IS NOT DISTINCT FROM j.conv_id AND s.p + 1 = j.p)")})
), ended AS (
  SELECT conv_id, least(w0, w3) AS best
  FROM ({inserted.format(source="(SELECT s.* FROM paths s JOIN counted c ON s.conv_id IS NOT DISTINCT FROM c.conv_id AND s.p = c.n)")})
), letters AS (
  SELECT conv_id, unnest(range(11, len(best) + 1)) AS q, best FROM ended
), edits AS (
  SELECT conv_id, q, substr(best, q, 1) AS letter,
         count(*) FILTER (substr(best, q, 1) <> 'I') OVER (PARTITION BY conv_id ORDER BY q) AS p FROM letters
), told AS (
  SELECT e.conv_id, e.q, e.letter, j.role, j.text,
         row_number() OVER (PARTITION BY e.conv_id ORDER BY e.q) AS place,
         max(CASE WHEN e.letter = 'K' AND j.initial = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS opened
  FROM edits e LEFT JOIN judged j ON e.conv_id IS NOT DISTINCT FROM j.conv_id AND e.p = j.p AND e.letter <> 'I' WHERE e.letter <> 'D'
), lines AS (
  SELECT conv_id, place, CASE WHEN letter = 'K' THEN role WHEN (place - opened) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
         || CASE WHEN letter = 'I' THEN '' ELSE text END AS line FROM told
), hashes AS (
  SELECT conv_id, sha256(string_agg(line, chr(10) ORDER BY place)) AS repaired FROM lines GROUP BY conv_id
)
SELECT o.conv_id, coalesce(c.gaps, 0)::BIGINT AS gaps, coalesce(c.blank, 0)::BIGINT AS blank,
       coalesce(c.duplicate, 0)::BIGINT AS duplicate, coalesce(c.truncated, 0)::BIGINT AS truncated,
       coalesce(c.illegal, 0)::BIGINT AS illegal, coalesce(substr(e.best, 1, 10)::BIGINT, 0) AS cost,
       coalesce(substr(e.best, 11), '') AS audit, coalesce(h.repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN ended e ON o.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN hashes h ON o.conv_id IS NOT DISTINCT FROM h.conv_id
"""


def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 2048 tokens."""
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the anchors among all embeddings, with labels moved for ids divisible by 7."""
    rows = negatives.participants(table(spark, sf_dir, "embeddings"), negatives.moved_labels())
    return negatives.hard_negatives(rows)


OP13_SQL = """
WITH parts AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v, row_number() OVER () AS rid
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.rid AS a, a.vec_id AS anchor_id, b.vec_id, b.rid AS b, a.label = b.label AS same,
         CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
  FROM parts a JOIN parts b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT a, anchor_id, vec_id AS positive_id, b, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, vec_id NULLS LAST) <= 5
)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.vec_id AS negative_id,
       p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON p.a = s.a AND NOT s.same AND 80 * p.positive_score <= 100 * s.score AND s.score <= p.positive_score
WINDOW w AS (PARTITION BY p.a, p.b ORDER BY s.score DESC, s.vec_id NULLS LAST)
QUALIFY row_number() OVER w <= 5
"""


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_fingerprints": op1_fingerprints,
        "op2_language_model": op2_language_model,
        "op3_main_text": op3_main_text,
        "op8_mixing": op8_mixing,
        "op4_language": op4_language,
        "op5_quality": op5_quality,
        "op9_toxicity": op9_toxicity,
        "op6_simhash": op6_simhash,
        "op7_substrings": op7_substrings,
        "op10_decontamination": op10_decontamination,
        "op11_conversations": op11_conversations,
        "op12_packing": op12_packing,
        "op13_hard_negatives": op13_hard_negatives,
    }


def llm_oracles() -> dict[str, str]:
    return {"op7_substrings": OP7_SQL, "op11_conversations": _op11_sql(), "op13_hard_negatives": OP13_SQL}
