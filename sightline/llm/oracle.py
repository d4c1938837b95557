"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

QUALITY = r"""
WITH split AS (
  SELECT doc_id, lang, source,
         list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls,
         length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM documents
), windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(ws[i:i + 7], ' ')) AS times
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM split)
), covers AS (
  SELECT doc_id, least(8, coalesce(lead(i) OVER (PARTITION BY doc_id ORDER BY i) - i, 8)) AS n
  FROM windows WHERE times > 1
), repeated AS (
  SELECT doc_id, sum(n)::BIGINT AS n_repeat_words FROM covers GROUP BY doc_id
), measured AS (
  SELECT doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         n_symbols::BIGINT AS n_symbols, len(ls)::BIGINT AS n_lines,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN repeated USING (doc_id)
), ratios AS (
  SELECT *, n_symbols * 10000 // greatest(word_chars, 1) AS v_symbols,
         n_dup_lines * 10000 // greatest(n_lines, 1) AS v_dup_lines,
         n_repeat_words * 10000 // greatest(n_words, 1) AS v_repeats
  FROM measured
), signals AS (
  SELECT lang, source, 'symbols' AS signal, v_symbols AS v FROM ratios
  UNION ALL SELECT lang, source, 'dup_lines', v_dup_lines FROM ratios
  UNION ALL SELECT lang, source, 'repeats', v_repeats FROM ratios
), buckets AS (
  SELECT lang, source, signal, (v >> d) << d AS bucket
  FROM (SELECT *, greatest(length(bin(v)) - 6, 0)::BIGINT AS d FROM signals)
), fine AS (
  SELECT lang, source, signal, count(*) AS n, quantile_disc(bucket, [0.25, 0.5, 0.75]) AS q FROM buckets GROUP BY ALL
), by_lang AS (
  SELECT lang, signal, count(*) AS n, quantile_disc(bucket, [0.25, 0.5, 0.75]) AS q FROM buckets GROUP BY ALL
), every AS (
  SELECT signal, quantile_disc(bucket, [0.25, 0.5, 0.75]) AS q FROM buckets GROUP BY ALL
), chosen AS (
  SELECT f.lang, f.source, f.signal,
         CASE WHEN f.n >= 100 THEN f.q WHEN l.n >= 100 THEN l.q ELSE e.q END AS q
  FROM fine f JOIN by_lang l ON f.lang IS NOT DISTINCT FROM l.lang AND f.signal = l.signal
  JOIN every e ON f.signal = e.signal
), limits AS (
  SELECT lang, source, signal,
         q[2] + greatest(3 * (q[3] - q[1]), CASE signal WHEN 'symbols' THEN 400 WHEN 'dup_lines' THEN 5000 ELSE 3000 END) AS most
  FROM chosen
), wide AS (
  SELECT lang, source, max(most) FILTER (signal = 'symbols') AS m_symbols,
         max(most) FILTER (signal = 'dup_lines') AS m_dup_lines, max(most) FILTER (signal = 'repeats') AS m_repeats
  FROM limits GROUP BY ALL
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed AS base_failed,
       NOT failed AND v_symbols <= m_symbols AND v_dup_lines <= m_dup_lines AND v_repeats <= m_repeats AS kept
FROM (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS failed FROM ratios) r
JOIN wide w ON r.lang IS NOT DISTINCT FROM w.lang AND r.source IS NOT DISTINCT FROM w.source
"""

# The checksum goes bit by bit: a byte is XORed in, then eight marks of -1 shift it through.
SPELLING = r"""
WITH RECURSIVE runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), counted AS (
  SELECT run, coalesce(doc_id::VARCHAR, '') || ':' || run AS keyed, count(*) AS n
  FROM runs WHERE length(run) >= 6 GROUP BY ALL
), steps AS (
  SELECT run, n, flatten(list_transform(string_split(keyed, ''), lambda c:
    CASE WHEN unicode(c) < 128 THEN [unicode(c), -1, -1, -1, -1, -1, -1, -1, -1]
    ELSE [192 + (unicode(c) >> 6), -1, -1, -1, -1, -1, -1, -1, -1, 128 + (unicode(c) & 63), -1, -1, -1, -1, -1, -1, -1, -1] END)) AS s
  FROM counted
), hashed AS (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295::BIGINT, s::BIGINT[]), lambda c, x:
    CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) AS h
  FROM steps
), typed AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
  FROM hashed
), words AS (
  SELECT word, sum(n)::BIGINT AS n FROM typed WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), holes AS (
  SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
), near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS m FROM holes a JOIN holes b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.rest, a.word, a.n FROM holes a JOIN words w ON a.rest = w.word
  UNION SELECT a.word, w.word, w.n FROM holes a JOIN words w ON a.rest = w.word
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY m DESC, encode(other)) AS best, max(m) AS best_n FROM near GROUP BY word
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
         CASE WHEN best_n >= 5 * w.n THEN best END AS form, CASE WHEN best_n >= 5 * w.n THEN best_n END AS form_n
  FROM words w LEFT JOIN best USING (word)
), chain AS (
  SELECT word, word AS at FROM judged
  UNION ALL SELECT c.word, j.form FROM chain c JOIN judged j ON c.at = j.word WHERE j.form IS NOT NULL
)
SELECT j.word, j.form, c.at AS root, j.n, j.n_near, j.form_n
FROM judged j JOIN chain c USING (word) JOIN judged e ON c.at = e.word AND e.form IS NULL
"""
