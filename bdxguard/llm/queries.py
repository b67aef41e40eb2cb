"""Registered queries of the corpus operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of all documents under the 5-word shingle Jaccard join at 80 percent."""
    from .ngram_join import ngram_components

    return ngram_components(_table(spark, sf_dir, "documents"))


def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and their edited texts, with likeness to the edited text and the next document."""
    from .fingerprint import edited_likeness

    return edited_likeness(_table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the documents that are not held out."""
    from .langid import held_out, predict, train

    docs = _table(spark, sf_dir, "documents")
    return predict(docs.withColumn("held_out", held_out()), train(docs), ["doc_id", "held_out"])


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's byte-level ids written to fixed-stride shards in training order; all records read back."""
    from .token_shards import new_folder, read_back, write_shards

    layout, manifest = write_shards(_table(spark, sf_dir, "documents"), new_folder(spark))
    return read_back(spark, layout, manifest)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by weak labels and a hashed linear scorer."""
    from .quality import classify

    return classify(_table(spark, sf_dir, "documents"))


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7 formatted by the template, and digests read back from the output."""
    from .chat import digests, with_probe

    return digests(with_probe(_table(spark, sf_dir, "conversations")))


OP6_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
marked AS (
  SELECT *, CASE role WHEN 'assistant' THEN 15 WHEN 'user' THEN 10 WHEN 'system' THEN 12 ELSE 9 + 7 + length(role) + {role} END + length(text) + {text} + 7 AS chars
  FROM t)
SELECT conv_id::BIGINT AS conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(chars) + count(*) - 1)::BIGINT AS formatted_chars
FROM marked GROUP BY conv_id"""


def _escapes(column: str) -> str:
    """SQL for the number of backslashes that escaping adds to a column."""
    from .chat import CONTROL

    return "(" + " + ".join(f"(length({column}) - length(replace({column}, '{c}', ''))) / {len(c)}" for c in ("\\", *CONTROL)).replace(") / ", ") // ") + ")"


def op7_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, components and kept rows of all embeddings by the pivot-permutation index."""
    from .pivot_dedup import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "embeddings"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins for all documents, without copies or near copies together and with at most two documents of a source."""
    from .packing import NEAR, pack

    return pack(_table(spark, sf_dir, "documents"), near=NEAR)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labelled documents that are not held out."""
    from .toxicity import THRESHOLD, held_out, score, train

    docs = _table(spark, sf_dir, "documents")
    scored = score(docs.withColumn("held_out", held_out()), train(docs, _table(spark, sf_dir, "labels")), ["doc_id", "held_out"])
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def op10_byte_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Ids of every document under the 50k byte-level vocabulary and the bytes they decode to, as digests."""
    from .byte_bpe import digests

    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return digests(_table(spark, sf_dir, "documents"), vocabulary, ["doc_id"])


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality rules over all documents with limits from the quantile sketches of their language and source."""
    from .quality_rules import judge

    return judge(_table(spark, sf_dir, "documents"))


OP11_SQL = r"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
l AS (SELECT *, list_filter(string_split_regex(t, '[ \t-\r]+'), lambda x: x <> '') AS w,
  list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')) AS lines FROM d),
win AS (SELECT r, i, {{'a': w[i], 'b': w[i + 1], 'c': w[i + 2]}} AS g FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM l)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n >= 2),
covered AS (SELECT r, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS o(k) GROUP BY r),
m AS (SELECT r, doc_id, lang, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
  (length(t) - length(translate(t, '{symbols}', '')))::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
  coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines)::BIGINT AS n_lines FROM l LEFT JOIN covered USING (r)),
f AS (SELECT *, (n_words < {least_words} OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  CASE WHEN n_words > 0 THEN word_chars * {scale} // n_words ELSE 0 END AS word_chars_rate,
  CASE WHEN n_words > 0 THEN n_symbols * {scale} // n_words ELSE 0 END AS symbol_rate,
  CASE WHEN n_lines > 0 THEN n_dup_lines * {scale} // n_lines ELSE 0 END AS dup_line_rate,
  CASE WHEN n_words > 0 THEN n_repeat_words * {scale} // n_words ELSE 0 END AS repeat_rate FROM m),
v AS (SELECT lang, source, rate, value, value >> greatest(length(bin(value)) - {digits}, 0) << greatest(length(bin(value)) - {digits}, 0) AS bucket
  FROM (SELECT lang, source, unnest(['word_chars_rate', 'symbol_rate', 'dup_line_rate', 'repeat_rate']) AS rate,
    unnest([word_chars_rate, symbol_rate, dup_line_rate, repeat_rate]) AS value FROM f WHERE NOT base_failed)),
s AS (
  SELECT 'source' AS level, lang, source, rate, bucket, count(*) AS n FROM v GROUP BY ALL
  UNION ALL SELECT 'lang', lang, NULL, rate, bucket, count(*) FROM v GROUP BY ALL
  UNION ALL SELECT 'all', NULL, NULL, rate, bucket, count(*) FROM v GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, rate ORDER BY bucket) AS upto, sum(n) OVER (PARTITION BY level, lang, source, rate) AS docs FROM s),
q AS (SELECT level, lang, source, rate, max(docs) AS docs, min(bucket) FILTER (upto * 100 >= docs * 10) AS q10,
  min(bucket) FILTER (upto * 100 >= docs * 50) AS q50, min(bucket) FILTER (upto * 100 >= docs * 90) AS q90 FROM u GROUP BY ALL),
step(rate, least, two_sided) AS (VALUES {steps}),
fence AS (SELECT level, lang, source, rate, docs, q90 + {spread} * greatest(q90 - q50, least) AS high,
  CASE WHEN two_sided THEN q10 - {spread} * greatest(q50 - q10, least) ELSE 0 END AS low FROM q JOIN step USING (rate)),
x AS (SELECT g.lang, g.source, a.rate,
  CASE WHEN s.docs >= {least} THEN s.high WHEN b.docs >= {least} THEN b.high ELSE a.high END AS high,
  CASE WHEN s.docs >= {least} THEN s.low WHEN b.docs >= {least} THEN b.low ELSE a.low END AS low,
  CASE WHEN s.docs >= {least} THEN 'source' WHEN b.docs >= {least} THEN 'lang' ELSE 'all' END AS level
  FROM (SELECT DISTINCT lang, source FROM v) g
  JOIN (SELECT * FROM fence WHERE level = 'all') a ON true
  JOIN (SELECT * FROM fence WHERE level = 'lang') b ON b.lang IS NOT DISTINCT FROM g.lang AND b.rate = a.rate
  JOIN (SELECT * FROM fence WHERE level = 'source') s ON s.lang IS NOT DISTINCT FROM g.lang AND s.source IS NOT DISTINCT FROM g.source AND s.rate = a.rate),
o AS (SELECT r, max(x.level) AS level, list(x.rate ORDER BY list_position({order}, x.rate)) FILTER (NOT base_failed AND (value > high OR value < low)) AS outside
  FROM (SELECT r, lang, source, base_failed, unnest({order}) AS rate, unnest([word_chars_rate, symbol_rate, dup_line_rate, repeat_rate]) AS value FROM f) y
  LEFT JOIN x ON x.lang IS NOT DISTINCT FROM y.lang AND x.source IS NOT DISTINCT FROM y.source AND x.rate = y.rate GROUP BY r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, level, coalesce(outside, []) AS outside,
  NOT base_failed AND outside IS NULL AS kept FROM f JOIN o USING (r)"""


def _op11_sql() -> str:
    from . import quality_rules as q

    return OP11_SQL.format(symbols=q.SYMBOLS, least_words=q.LEAST_WORDS, scale=q.SCALE, digits=q.BITS + 1, spread=q.SPREAD, least=q.LEAST,
                           steps=", ".join(f"('{r}', {s}, {str(b).lower()})" for r, (s, b) in q.RATES.items()), order=str(list(q.RATES)))


def op12_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str, vocabulary_a: str | None = None, vocabulary_b: str | None = None) -> DataFrame:
    """Tokens, groups and links of every document under the 50k byte-level and the 32k piece vocabulary, with corpus counts of the links."""
    from .alignment import alignment_counts

    if vocabulary_a is None or vocabulary_b is None:
        import public_tokenizers

        vocabulary_a, vocabulary_b = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment_counts(_table(spark, sf_dir, "documents"), vocabulary_a, vocabulary_b, ["doc_id"])


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of all words of all documents that are long and frequent enough."""
    from .spelling import variants

    return variants(_table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_ngram_jaccard_join, op2_document_fingerprints, op3_language_id, op4_token_shards, op5_quality_classifier, op6_chat_formatting,
        op7_embedding_near_dedup, op8_best_fit_packing, op9_toxicity, op10_byte_bpe, op11_quality_rules, op12_cross_tokenizer_alignment, op13_spelling_variants)
}

#: Queries whose rows SQL can express; the others are tested against brute force, a round trip or held-out accuracy.
ORACLE: dict[str, str] = {"op6_chat_formatting": OP6_SQL.format(role=_escapes("role"), text=_escapes("text")), "op11_quality_rules": _op11_sql()}
