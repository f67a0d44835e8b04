"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from ordermill.llm.quality import BASE_REPEAT_PERCENT, BASE_WORDS, RULES, STOP_WORDS


def quality_sql() -> str:
    """The counts from unnested words and windows, the verdict from the same threshold table."""
    listed = [word for line in STOP_WORDS for word in line.split()]
    forms = sorted({form for word in listed for form in (word, word.capitalize(), word.upper())})
    stop_words = ", ".join(f"'{form}'" for form in forms)
    ratios = {
        "n_words": "n_words",
        "repeat_word_ratio": "n_repeat_words / greatest(n_words, 1)",
        "mean_word_chars": "word_chars / greatest(n_words, 1)",
        "symbols_per_word": "n_symbols / greatest(n_words, 1)",
        "stop_word_ratio": "n_stop_words / greatest(n_words, 1)",
        "letter_word_ratio": "n_letter_words / greatest(n_words, 1)",
        "dup_line_ratio": "n_dup_lines / greatest(n_lines, 1)",
    }
    checks = [f"{ratios[rule.metric]} >= {rule.least}" for rule in RULES if rule.least is not None]
    checks += [f"{ratios[rule.metric]} <= {rule.most}" for rule in RULES if rule.most is not None]
    return f"""
WITH texts AS (
  SELECT doc_id, coalesce(text, '') AS body FROM documents
), split AS (
  SELECT doc_id, body, regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+') AS words,
    list_filter(string_split(body, chr(10)), lambda line: regexp_matches(line, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM texts
), windows AS (
  SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS gram
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM split WHERE len(words) > 2)
), twice AS (
  SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), repeated AS (
  SELECT doc_id, count(DISTINCT i + step) AS n_repeat_words
  FROM twice, (VALUES (0), (1), (2)) AS steps(step) GROUP BY doc_id
), counts AS (
  SELECT doc_id, len(words) AS n_words,
    coalesce(list_sum(list_transform(words, lambda w: length(w))), 0)::BIGINT AS word_chars,
    length(body) - length(regexp_replace(body, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    len(lines) AS n_lines,
    len(list_filter(words, lambda w: w IN ({stop_words}))) AS n_stop_words,
    len(list_filter(words, lambda w: regexp_matches(w, '\\p{{L}}'))) AS n_letter_words
  FROM split LEFT JOIN repeated USING (doc_id)
), judged AS (
  SELECT *, n_words < {BASE_WORDS} OR 100 * n_repeat_words > {BASE_REPEAT_PERCENT} * n_words AS base_failed
  FROM counts
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND {" AND ".join(checks)} AS kept, n_lines, n_stop_words, n_letter_words
FROM judged
"""


def divergence_sql() -> str:
    """Every kept term priced for every pair of sources, one by one."""
    return f"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(text, '') AS body, coalesce(lang, '') AS lang, coalesce(source, '') AS source
  FROM documents
), words AS (
  SELECT id, lang, source, unnest(regexp_extract_all(
    translate(body, '{ascii_uppercase}', '{ascii_lowercase}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM docs
), kept AS (
  SELECT lang, term, count(*) AS lang_n FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 3
), found AS (
  SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY lang, source, term
), groups AS (
  SELECT DISTINCT lang, source FROM docs
), langs AS (
  SELECT lang, count(*) AS terms, sum(lang_n) AS lang_total FROM kept GROUP BY lang
), totals AS (
  SELECT lang, source, sum(n) AS total FROM found GROUP BY lang, source
), levels AS (
  SELECT g.lang, g.source, k.term, coalesce(f.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(f.n, 0) + 1)) // (coalesce(t.total, 0) + l.terms) AS p,
    1 + (1000000000::HUGEINT * (k.lang_n + 1)) // (l.lang_total + l.terms) AS lang_p
  FROM groups g JOIN kept k ON g.lang = k.lang JOIN langs l ON g.lang = l.lang
  LEFT JOIN totals t ON g.lang = t.lang AND g.source = t.source
  LEFT JOIN found f ON g.lang = f.lang AND g.source = f.source AND k.term = f.term
), priced AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
  FROM levels a JOIN levels b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
  GROUP BY a.lang, a.source, b.source
), parts AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN priced p ON a.lang = p.lang AND a.source = p.source AND b.source = p.item
  UNION ALL
  SELECT lang, source, 'term', term, (((p - lang_p) * (p - lang_p)) // lang_p)::BIGINT
  FROM levels WHERE n > 0 AND p > lang_p
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 200
"""


def hard_negatives_sql() -> str:
    """Every anchor compared with every row."""
    return """
WITH points AS (
  SELECT row_number() OVER () AS number, vec_id,
    CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS parts
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), positives AS (
  SELECT a.number, a.vec_id AS anchor_id, a.label, a.parts, p.vec_id AS positive_id,
    list_dot_product(a.parts, p.parts)::BIGINT AS positive_score,
    row_number() OVER (PARTITION BY a.number ORDER BY list_dot_product(a.parts, p.parts) DESC, p.vec_id) AS place
  FROM points a JOIN points p ON a.label = p.label AND a.number <> p.number
  WHERE a.vec_id % 100 = 0
  QUALIFY place <= 5
), scored AS (
  SELECT a.number, n.vec_id AS negative_id, list_dot_product(a.parts, n.parts)::BIGINT AS negative_score
  FROM points a JOIN points n ON a.label <> n.label
  WHERE a.vec_id % 100 = 0
)
SELECT anchor_id, positive_id,
  row_number() OVER (PARTITION BY p.number, place ORDER BY negative_score DESC, negative_id)::INTEGER AS rank,
  negative_id, positive_score, negative_score
FROM positives p JOIN scored s ON p.number = s.number
WHERE 30 * positive_score <= 100 * negative_score AND 100 * negative_score <= 90 * positive_score
QUALIFY rank <= 10
"""
