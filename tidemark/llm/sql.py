"""DuckDB statements for the operators that SQL can express."""

from __future__ import annotations

CHAT_FORMAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, t, CASE t WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]'
  FROM range(2) AS r(t)
), placed AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS seq,
    regexp_replace(text, '([<\[])(\\*)(/?s>|t>|/?INST\])', '\1\\\2\3', 'g') AS body,
    regexp_replace(role, '([<\[])(\\*)(/?s>|t>|/?INST\])', '\1\\\2\3', 'g') AS who
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY seq)) AS loss_sha256,
  CAST(7 + sum(length(body) + CASE WHEN before = role THEN 3 ELSE 13 + length(who) END) AS BIGINT)
    AS formatted_chars
FROM placed GROUP BY conv_id
"""

#: base measurements of one document per row, then exact binomial cutoffs
QUALITY_RULES = r"""
WITH w AS (
  SELECT doc_id, lang, coalesce(text, '') AS text,
    list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words,
    list_filter(string_split(coalesce(text, ''), chr(10)),
                lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents
), grams AS (
  SELECT doc_id, i, array_to_string(words[i:i + 7], ' ') AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 6)) AS i FROM w WHERE len(words) >= 8)
), twice AS (
  SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), repeated AS (
  SELECT doc_id, sum(least(8, coalesce(later - i, 8))) AS n FROM (
    SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS later FROM twice) GROUP BY doc_id
), m AS (
  SELECT w.doc_id, lang, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(length(regexp_replace(text, '[^A-Z]', '', 'g')) AS BIGINT) AS n_capitals,
    CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(repeated.n, 0) AS BIGINT) AS n_repeat_words
  FROM w LEFT JOIN repeated ON repeated.doc_id = w.doc_id
), b AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m
), scores AS (
  SELECT doc_id, lang, base_failed, rule, CASE WHEN bottom > 0 THEN top * 1000 // bottom ELSE 0 END AS score
  FROM (
    SELECT doc_id, lang, base_failed, 'symbols' AS rule, n_symbols AS top, word_chars AS bottom FROM b
    UNION ALL SELECT doc_id, lang, base_failed, 'dup_lines', n_dup_lines, n_lines FROM b
    UNION ALL SELECT doc_id, lang, base_failed, 'repeats', n_repeat_words, n_words FROM b
    UNION ALL SELECT doc_id, lang, base_failed, 'capitals', n_capitals, word_chars FROM b
    UNION ALL SELECT doc_id, lang, base_failed, 'long_words', word_chars, n_words FROM b)
), grid AS (
{grid}
), counts AS (
  SELECT lang, grid.rule, cutoff, count(*) AS n,
    count(*) FILTER (WHERE score > cutoff) AS k
  FROM scores JOIN grid ON grid.rule = scores.rule
  WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)
  GROUP BY lang, grid.rule, cutoff
), tails AS (
  SELECT lang, rule, cutoff, n, k, sum(exp(
      lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({alpha}) + (n - i) * ln(1 - {alpha}))) AS p
  FROM (SELECT *, unnest(range(0, k + 1)) AS i FROM counts) GROUP BY ALL
), tested AS (
  SELECT lang, rule, cutoff, bool_and(k < n * {alpha} AND p <= {delta} / sequences)
    OVER (PARTITION BY lang, rule ORDER BY cutoff DESC) AS proven
  FROM tails, (SELECT count(*) AS sequences FROM (SELECT DISTINCT lang, rule FROM counts))
), cuts AS (
  SELECT lang, rule, min(cutoff) AS cutoff FROM tested WHERE proven GROUP BY lang, rule
), broken AS (
  SELECT DISTINCT doc_id FROM scores JOIN cuts
    ON cuts.rule = scores.rule AND cuts.lang IS NOT DISTINCT FROM scores.lang WHERE score > cutoff
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM broken) AS kept
FROM b
"""

TOKEN_COUNTS = r"""
WITH counted AS (
  SELECT source, lang, strlen(coalesce(text, '')) AS bytes,
    len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
    doc_id IS NOT DISTINCT FROM min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first
  FROM documents
)
SELECT source, lang, tokenizer, count(*) AS n_docs, CAST(sum(tokens) AS BIGINT) AS n_tokens
FROM (SELECT source, lang, 'bytes-v1' AS tokenizer, bytes AS tokens FROM counted WHERE first
      UNION ALL SELECT source, lang, 'words-v1', words FROM counted WHERE first)
GROUP BY source, lang, tokenizer
"""

#: every n-gram counted by brute force; 128-bit products
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pieces
), grams AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i
        FROM words JOIN range(1, 6) AS r(k) ON len(ws) >= k)
), f AS (
  SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL
), totals AS (
  SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, string_split(phrase, ' ') AS ws, f AS a FROM f WHERE k > 1 AND f >= 100
), kept AS (
  SELECT * FROM candidates c WHERE NOT EXISTS (
    SELECT 1 FROM candidates x WHERE x.lang = c.lang AND x.k > c.k AND 100 * x.a >= 100 * c.a
      AND contains(' ' || x.phrase || ' ', ' ' || c.phrase || ' '))
), cuts AS (
  SELECT lang, phrase, a, j, array_to_string(ws[:j], ' ') AS first, array_to_string(ws[j + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)
), valued AS (
  SELECT cuts.lang, cuts.phrase, a, j, x.f AS l, y.f AS r, n,
    CAST(CAST(1000 AS HUGEINT) * a * n // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = first
    JOIN f AS y ON y.lang = cuts.lang AND y.phrase = rest JOIN totals ON totals.lang = cuts.lang
), best AS (
  SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
  phrase, a, l, r, n, score
FROM best QUALIFY rank <= 2000
"""

#: every document scored for every item
LEXICAL_SEARCH = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents
), d AS (
  SELECT doc_id, ws, len(ws) AS n FROM split WHERE len(ws) > 0
), totals AS (
  SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM d
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(ws) AS term FROM d) GROUP BY ALL
), q AS (
  SELECT item_id, term, count(*) AS c FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
      'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), w AS (
  SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), totals
), m AS (
  SELECT doc_id, 100 - 75 + ((75 * n * docs) // words) AS m FROM d, totals
), scores AS (
  SELECT item_id, tf.doc_id, CAST(sum(c * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN tf ON tf.term = q.term JOIN w ON w.term = q.term JOIN m ON m.doc_id = tf.doc_id
  GROUP BY item_id, tf.doc_id
)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
  doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""


def _quality_rules() -> str:
    from tidemark.llm.quality_rules import GRID, Risk
    rows = "\n  UNION ALL ".join(f"SELECT '{rule}' AS rule, {cut} AS cutoff"
                                 for rule, cuts in GRID.items() for cut in cuts)
    return (QUALITY_RULES.replace("{grid}", "  " + rows)
            .replace("{alpha}", str(Risk.alpha)).replace("{delta}", str(Risk.delta)))


SQL = {
    "op6_chat_format": CHAT_FORMAT,
    "op8_token_counts": TOKEN_COUNTS,
    "op10_quality_rules": _quality_rules(),
    "op11_lexical_search": LEXICAL_SEARCH,
    "op12_collocations": COLLOCATIONS,
}
