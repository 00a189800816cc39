"""The registered queries of this package: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (
    divergence,
    importance_resampling,
    lexical,
    line_dedup,
    near_duplicates,
    packing,
    permutation_index,
    piece_bpe,
    quality,
    repeats,
    secret_scan,
    sharding,
    site_style_tree,
)
from .common import table


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_piece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_style_tree.extract(table(spark, sf_dir, "pages"))


def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.digests(table(spark, sf_dir, "documents"))


def op4_balanced_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"), 40)


def op5_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digests(table(spark, sf_dir, "documents"))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.groups(table(spark, sf_dir, "documents"), size=4, percent=80)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


def op10_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation_index.search(table(spark, sf_dir, "embeddings"), query_every=20, k=20)


def op11_shared_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op12_ranked_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_piece_round_trip,
        op2_main_text,
        op3_repeated_passages,
        op4_balanced_shards,
        op5_importance_resampling,
        op6_secret_spans,
        op7_near_duplicates,
        op8_quality_rules,
        op9_packed_sequences,
        op10_nearest_vectors,
        op11_shared_lines,
        op12_ranked_documents,
        op13_source_divergence,
    )
    return {f.__name__: f for f in found}


REPEATED_WORDS = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT doc_id, i, list_slice(words, i, i + 12) AS win
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)
), firsts AS (
  SELECT win, min(doc_id) AS first_id FROM windows GROUP BY win
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS at
  FROM windows JOIN firsts USING (win) WHERE first_id < doc_id
), kept AS (
  SELECT w.doc_id, string_agg(x.word, ' ' ORDER BY x.at) FILTER (WHERE gone.at IS NULL) AS text, count(gone.at) AS n_removed
  FROM (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS at FROM w) x
  JOIN w USING (doc_id) LEFT JOIN gone ON gone.doc_id = x.doc_id AND gone.at = x.at
  GROUP BY w.doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

SHARED_LINES = r"""
WITH lines AS (
  SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines
), shared AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT doc_id, line, pos, coalesce(doc_id <> last, false) AS gone FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

RANKED_DOCUMENTS = r"""
WITH terms AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM documents
), asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM benchmark)
  GROUP BY item_id, term
), lengths AS (
  SELECT doc_id, count(*) AS n FROM terms GROUP BY doc_id
), corpus AS (
  SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM lengths
), postings AS (
  SELECT term, doc_id, count(*) AS tf FROM terms SEMI JOIN asked USING (term) GROUP BY term, doc_id
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM postings, corpus GROUP BY term, n_docs
), scored AS (
  SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM asked JOIN weights USING (term) JOIN postings USING (term) JOIN lengths USING (doc_id), corpus
  GROUP BY item_id, doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 20
"""

SOURCE_DIVERGENCE = r"""
WITH terms AS (
  SELECT doc, lang, source, translate(unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')),
                                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents)
), kept AS (
  SELECT lang, term, count(*) AS n FROM terms GROUP BY lang, term HAVING count(DISTINCT doc) >= 3
), langs AS (
  SELECT lang, count(*) AS v, sum(n) AS total FROM kept GROUP BY lang
), groups AS (
  SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), counts AS (
  SELECT lang, source, term, count(*) AS n FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term
), totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY lang, source
), shares AS (
  SELECT lang, source, term, coalesce(c.n, 0) AS n,
         CAST(1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (t.total + l.v) AS BIGINT) AS p,
         CAST(1 + 1000000000::HUGEINT * (k.n + 1) // (l.total + l.v) AS BIGINT) AS q
  FROM totals t JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)
), pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, CAST(coalesce(p.value, 0) AS BIGINT) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares WHERE n > 0 AND p > q
)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM found QUALIFY part = 'pair' OR rank <= 200
"""


def secret_spans_sql(rules: tuple[secret_scan.Rule, ...] = secret_scan.BASE + secret_scan.ADDED) -> str:
    """Every rule on every text, without an index: what lies between the matches tells where they are."""

    def matched(order: int, rule: secret_scan.Rule) -> str:
        pattern = "'" + rule.pattern.replace("'", "''") + "'"
        gaps = f"string_split_regex(text, {pattern})"
        return f"""
  SELECT row_id, {order} AS rule, '{rule.kind}' AS kind, {rule.least} AS least, unnest({gaps}) AS gap, generate_subscripts({gaps}, 1) AS pos,
         unnest(regexp_extract_all(text, {pattern})) AS match, unnest(regexp_extract_all(text, {pattern}, {rule.group})) AS value FROM docs"""

    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), matched AS ({"  UNION ALL".join(matched(i, r) for i, r in enumerate(rules))}
), placed AS (
  SELECT row_id, rule, kind, least, value, match,
         CAST(sum(length(gap) + coalesce(length(match), 0)) OVER (PARTITION BY row_id, rule ORDER BY pos) AS BIGINT) AS stop
  FROM matched
), found AS (
  SELECT row_id, rule, stop - length(match) AS start, concat_ws(':', kind, stop - length(match), stop) AS span
  FROM placed WHERE match IS NOT NULL AND length(value) >= least
)
SELECT doc_id, count(*) FILTER (WHERE rule = 0) AS n_assign, count(*) FILTER (WHERE rule = 1) AS n_access, count(*) FILTER (WHERE rule = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, rule) FILTER (WHERE rule < {len(secret_scan.BASE)}), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, rule), '') AS spans
FROM docs LEFT JOIN found USING (row_id) GROUP BY row_id, doc_id
"""


NEAR_DUPLICATES = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS row_id, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), shingles AS (
  SELECT DISTINCT row_id, CASE WHEN len(words) < 4 THEN words ELSE list_slice(words, i, i + 3) END AS shingle
  FROM (SELECT row_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS i FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT row_id, count(*) AS n FROM shingles GROUP BY row_id
), shared AS (
  SELECT shingle, row_number() OVER () AS number FROM (SELECT shingle FROM shingles GROUP BY shingle HAVING count(*) > 1)
), held AS (
  SELECT row_id, n, number FROM shingles JOIN shared USING (shingle) JOIN sizes USING (row_id)
), links AS (
  SELECT a.row_id AS a, b.row_id AS b
  FROM held a JOIN held b ON a.number = b.number AND a.row_id < b.row_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.row_id, b.row_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reached(a, b) AS (
  SELECT row_id, row_id FROM docs UNION SELECT r.a, l.b FROM reached r JOIN both_ways l ON r.b = l.a
)
SELECT d.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(o.doc_id) AS component_id, d.doc_id = min(o.doc_id) AS kept
FROM docs d LEFT JOIN sizes USING (row_id) JOIN reached r ON r.a = d.row_id JOIN docs o ON o.row_id = r.b GROUP BY d.row_id, d.doc_id
"""


#: The calibration has the defaults of :func:`quality.judge`: at most 0.05 / 5 of the good documents a rule, certified at 0.05 in all.
QUALITY_RULES = r"""
WITH docs AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs
), windows AS (
  SELECT row_id, i, list_slice(words, i, i + 2) AS win FROM (SELECT row_id, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) >= 3)
), again AS (
  SELECT row_id, win FROM windows GROUP BY row_id, win HAVING count(*) > 1
), repeated AS (
  SELECT row_id, count(DISTINCT word_no) AS n
  FROM (SELECT row_id, unnest([i, i + 1, i + 2]) AS word_no FROM windows JOIN again USING (row_id, win)) GROUP BY row_id
), counts AS (
  SELECT row_id, doc_id, stratum, text, CAST(len(words) AS BIGINT) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
         length(regexp_replace(text, '[^A-Z]+', '', 'g')) AS n_upper,
         length(regexp_replace(text, '[0-9A-Za-z\x20\x09-\x0D\x{80}-\x{10FFFF}]+', '', 'g')) AS n_marks,
         len(lines) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM docs JOIN split USING (row_id) LEFT JOIN repeated USING (row_id)
), measured AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM counts
), signals AS (
  UNPIVOT (SELECT row_id, 100.0::DOUBLE * n_repeat_words / greatest(n_words, 1) AS repeat_pct, 100.0::DOUBLE * n_symbols / greatest(word_chars, 1) AS symbol_pct,
                  100.0::DOUBLE * n_upper / greatest(word_chars, 1) AS upper_pct, 100.0::DOUBLE * n_marks / greatest(word_chars, 1) AS mark_pct,
                  100.0::DOUBLE * n_dup_lines / greatest(n_lines, 1) AS dup_line_pct FROM measured)
  ON repeat_pct, symbol_pct, upper_pct, mark_pct, dup_line_pct INTO NAME signal VALUE level
), draws AS (
  SELECT stratum, signal, text, max(quality) AS quality, CAST(least(ceil(max(level)), 100) AS INTEGER) AS cell
  FROM measured JOIN labels USING (doc_id) JOIN signals USING (row_id) WHERE quality IN (0, 1) AND NOT base_failed GROUP BY stratum, signal, text
), totals AS (
  SELECT stratum, signal, count(*) FILTER (WHERE quality = 1) AS good_total, count(*) FILTER (WHERE quality = 0) AS bad_total,
         count(*) OVER () AS sequences FROM draws GROUP BY stratum, signal
), grid AS (
  SELECT stratum, signal, good_total, bad_total, sequences, cutoff,
         count(cell) FILTER (WHERE quality = 1 AND cell > cutoff) AS good, count(cell) FILTER (WHERE quality = 0 AND cell > cutoff) AS bad
  FROM totals CROSS JOIN (SELECT unnest(range(100)) AS cutoff) JOIN draws USING (stratum, signal) GROUP BY ALL
), tails AS (
  SELECT good, good_total, sum(exp(lgamma(good_total + 1) - lgamma(i + 1) - lgamma(good_total - i + 1) + i * ln(0.01) + (good_total - i) * ln(0.99))) AS tail
  FROM (SELECT good, good_total, unnest(range(good + 1)) AS i FROM (SELECT DISTINCT good, good_total FROM grid WHERE good < good_total))
  GROUP BY good, good_total
), cutoffs AS (
  SELECT stratum, signal, cutoff, bad / greatest(1, bad_total) - 10 * good / greatest(1, good_total) AS gain
  FROM grid JOIN tails USING (good, good_total) WHERE tail <= 0.05 / sequences AND gain > 0
  QUALIFY row_number() OVER (PARTITION BY stratum, signal ORDER BY gain DESC, cutoff DESC) = 1
), rejected AS (
  SELECT DISTINCT row_id FROM measured JOIN signals USING (row_id) JOIN cutoffs USING (stratum, signal) WHERE level > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rejected.row_id IS NULL AS kept
FROM measured LEFT JOIN rejected USING (row_id)
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_repeated_passages": REPEATED_WORDS,
        "op6_secret_spans": secret_spans_sql(),
        "op7_near_duplicates": NEAR_DUPLICATES,
        "op8_quality_rules": QUALITY_RULES,
        "op11_shared_lines": SHARED_LINES,
        "op12_ranked_documents": RANKED_DOCUMENTS,
        "op13_source_divergence": SOURCE_DIVERGENCE,
    }
