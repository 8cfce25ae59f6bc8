"""DuckDB SQL of the queries that SQL can express (written independently of the
Spark code). Hashes, tokenisers, learned models and coders have no SQL form."""

ORACLE: dict[str, str] = {}

ORACLE["op5_quality"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (SELECT r, doc_id, text, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM d),
ex AS (SELECT r, unnest(ws) AS word, generate_subscripts(ws, 1) AS p FROM w),
win AS (SELECT r, p, word, lead(word, 1) OVER o AS w2, lead(word, 2) OVER o AS w3 FROM ex WINDOW o AS (PARTITION BY r ORDER BY p)),
tw AS (SELECT r, p, CASE WHEN w3 IS NOT NULL AND count(*) OVER (PARTITION BY r, word, w2, w3) > 1 THEN 1 ELSE 0 END AS twice FROM win),
cov AS (SELECT r, CASE WHEN max(twice) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) = 1 THEN 1 ELSE 0 END AS c FROM tw),
rep AS (SELECT r, sum(c) AS n_repeat_words FROM cov GROUP BY r),
ln AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
li AS (SELECT r, line, count(*) AS k FROM ln WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line),
dup AS (SELECT r, sum(k) AS n_lines, sum(k - 1) AS n_dup_lines FROM li GROUP BY r),
ag AS (SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars, max(length(word)) AS longest_word,
         sum(CASE WHEN regexp_matches(word, '\p{L}') THEN 1 ELSE 0 END) AS n_letter_words,
         sum(CASE WHEN word = upper(word) AND word <> lower(word) THEN 1 ELSE 0 END) AS n_upper FROM ex GROUP BY r),
m AS (SELECT w.doc_id, CAST(coalesce(ag.n_words, 0) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
   CAST(CASE WHEN ag.n_words IS NULL THEN 0 ELSE length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) END AS BIGINT) AS n_symbols,
   CAST(coalesce(n_dup_lines, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
   coalesce(n_lines, 0) AS n_lines, coalesce(n_letter_words, 0) AS n_letter_words, coalesce(n_upper, 0) AS n_upper,
   coalesce(longest_word, 0) AS longest_word
 FROM w LEFT JOIN ag ON ag.r = w.r LEFT JOIN rep ON rep.r = w.r LEFT JOIN dup ON dup.r = w.r),
f AS (SELECT *, CAST((CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN n_words > 1000000 THEN 4 ELSE 0 END) + (CASE WHEN word_chars < 2 * n_words THEN 8 ELSE 0 END)
  + (CASE WHEN word_chars > 15 * n_words THEN 16 ELSE 0 END) + (CASE WHEN 10 * n_symbols > n_words THEN 32 ELSE 0 END)
  + (CASE WHEN 100 * n_dup_lines > 30 * n_lines THEN 64 ELSE 0 END) + (CASE WHEN 100 * n_letter_words < 70 * n_words THEN 128 ELSE 0 END)
  + (CASE WHEN 100 * n_upper > 50 * n_words THEN 256 ELSE 0 END) + (CASE WHEN longest_word > 1000 THEN 512 ELSE 0 END) AS BIGINT) AS failures FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed,
  failures = 0 AS kept, failures FROM f
"""

ORACLE["quality_ablation"] = f"""
WITH q AS ({ORACLE["op5_quality"]}),
rules AS (SELECT unnest(['too_few_words', 'repeated_windows', 'too_many_words', 'short_words', 'long_words', 'symbols',
                         'repeated_lines', 'few_letter_words', 'shouting', 'endless_word']) AS rule,
                 unnest([1, 2, 4, 8, 16, 32, 64, 128, 256, 512]) AS bit)
SELECT rule, CAST(count(*) FILTER (WHERE failures & bit <> 0) AS BIGINT) AS fails,
       CAST(count(*) FILTER (WHERE failures = bit) AS BIGINT) AS alone,
       CAST(count(*) FILTER (WHERE failures = 0 OR failures = bit) AS BIGINT) AS kept_without
FROM rules, q GROUP BY rule
"""

ORACLE["op11_line_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
ln AS (SELECT r, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS p FROM d),
k AS (SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM ln),
h AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT k.r, k.p, k.line, h.top IS NOT NULL AND h.top <> k.doc_id AS gone FROM k LEFT JOIN h ON h.key = k.key),
a AS (SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
        coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '') AS kept FROM j GROUP BY r)
SELECT d.doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(kept) AS kept_sha256
FROM a JOIN d ON d.r = a.r
"""

ORACLE["op13_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, row_number() OVER () AS r,
        regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[.,;:!?\x0A-\x0D]') AS pieces FROM documents),
pc AS (SELECT lang, r, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS q FROM d),
sp AS (SELECT lang, r, q, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM pc),
w AS (SELECT lang, r, q, unnest(ws) AS w1, generate_subscripts(ws, 1) AS p FROM sp),
g AS (SELECT lang, w1, lead(w1, 1) OVER o AS w2, lead(w1, 2) OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r, q ORDER BY p)),
f1 AS (SELECT lang, w1, count(*) AS f FROM g GROUP BY ALL),
f2 AS (SELECT lang, w1, w2, count(*) AS f FROM g WHERE w2 IS NOT NULL GROUP BY ALL),
f3 AS (SELECT lang, w1, w2, w3, count(*) AS f FROM g WHERE w3 IS NOT NULL GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f1 GROUP BY lang),
c2 AS (SELECT c.lang, c.w1, c.w2, c.f AS a, x.f AS l, y.f AS r, (1000000::HUGEINT * c.f * c.f) // (x.f::HUGEINT * y.f) AS score
       FROM f2 c JOIN f1 x ON x.lang = c.lang AND x.w1 = c.w1 JOIN f1 y ON y.lang = c.lang AND y.w1 = c.w2 WHERE c.f >= 10),
c3 AS (SELECT c.lang, c.w1, c.w2, c.w3, c.f AS a, x1.f AS l1, y1.f AS r1, x2.f AS l2, y2.f AS r2,
         (1000000::HUGEINT * c.f * c.f) // (x1.f::HUGEINT * y1.f) AS s1, (1000000::HUGEINT * c.f * c.f) // (x2.f::HUGEINT * y2.f) AS s2
       FROM f3 c JOIN f1 x1 ON x1.lang = c.lang AND x1.w1 = c.w1 JOIN f2 y1 ON y1.lang = c.lang AND y1.w1 = c.w2 AND y1.w2 = c.w3
       JOIN f2 x2 ON x2.lang = c.lang AND x2.w1 = c.w1 AND x2.w2 = c.w2 JOIN f1 y2 ON y2.lang = c.lang AND y2.w1 = c.w3
       WHERE c.f >= 10),
inside AS (SELECT lang, w1, w2, max(a) AS m FROM (SELECT lang, w1, w2, a FROM c3 UNION ALL SELECT lang, w2, w3, a FROM c3) GROUP BY ALL),
cand AS (SELECT c2.lang, c2.w1 || ' ' || c2.w2 AS phrase, a, l, r, score FROM c2
         LEFT JOIN inside i ON i.lang = c2.lang AND i.w1 = c2.w1 AND i.w2 = c2.w2 WHERE NOT coalesce(100 * i.m >= 50 * a, false)
         UNION ALL SELECT lang, w1 || ' ' || w2 || ' ' || w3, a, CASE WHEN s1 <= s2 THEN l1 ELSE l2 END,
           CASE WHEN s1 <= s2 THEN r1 ELSE r2 END, least(s1, s2) FROM c3),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM cand)
SELECT k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, CAST(k.score AS BIGINT) AS score
FROM ranked k JOIN total t ON t.lang = k.lang WHERE k.rank <= 2000
"""
