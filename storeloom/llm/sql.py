"""DuckDB SQL for the corpus queries that SQL can express, written apart from the Spark code."""

OP4 = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (SELECT DISTINCT item_id, least(len(w), 13) AS n, array_to_string(w[i:i + least(len(w), 13) - 1], ' ') AS s
        FROM item, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS u(i) WHERE len(w) > 0),
sizes AS (SELECT DISTINCT n FROM win),
gram AS (SELECT r, n, i, array_to_string(w[i:i + n - 1], ' ') AS s FROM doc, sizes, unnest(range(1, len(w) - n + 2)) AS u(i) WHERE len(w) >= n),
hit AS (SELECT g.r, g.i, g.n, win.item_id FROM gram g JOIN win ON win.n = g.n AND win.s = g.s),
words AS (SELECT r, count(DISTINCT p) AS n_hit FROM hit, unnest(range(i, i + n)) AS u(p) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN words USING (r) LEFT JOIN found USING (r)
"""

_LINES = r"""
doc AS (SELECT row_number() OVER () AS r, doc_id, source, text FROM documents),
line AS (SELECT r, source, i, string_split(text, chr(10))[i] AS s
         FROM doc, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS u(i) WHERE regexp_matches(string_split(text, chr(10))[i], '[^\x20\x09-\x0D]')),
wide AS (SELECT s FROM line GROUP BY s HAVING count(DISTINCT source) >= 10),
cut AS (SELECT r, count(*) AS n, list(i) AS at FROM line WHERE s IN (SELECT s FROM wide) GROUP BY r),
whole AS (SELECT r, count(*) AS n_lines FROM line GROUP BY r),
clean AS (SELECT doc.r, doc.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(cut.n, 0) AS n_removed,
          CASE WHEN cut.r IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(1, len(string_split(text, chr(10))) + 1), lambda x: NOT list_contains(cut.at, x)), lambda x: string_split(text, chr(10))[x]), chr(10)) END AS body
          FROM doc LEFT JOIN whole ON whole.r = doc.r LEFT JOIN cut ON cut.r = doc.r)
"""

OP5 = f"""
WITH {_LINES}
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, CAST(length(coalesce(body, '')) AS BIGINT) AS clean_chars,
       sha256(coalesce(body, '')) AS clean_sha256 FROM clean
"""

OP8 = r"""
WITH doc AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
line AS (SELECT r, s FROM (SELECT r, unnest(string_split(t, chr(10))) AS s FROM doc) WHERE regexp_matches(s, '[^\x20\x09-\x0D]')),
lines AS (SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT s) AS n_dup,
          count(*) FILTER (WHERE regexp_matches(s, '\.\.\.[\x20\x09-\x0D]*$')) AS n_dots, count(*) FILTER (WHERE regexp_matches(s, '^[\x20\x09-\x0D]*[-*]')) AS n_bullets
          FROM line GROUP BY r),
gram AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS s FROM doc, unnest(range(1, len(w) - 3)) AS u(i) WHERE len(w) >= 5),
twice AS (SELECT r, i FROM gram QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
rep AS (SELECT r, count(DISTINCT p) AS n_rep FROM twice, unnest(range(i, i + 5)) AS u(p) GROUP BY r),
base AS (SELECT doc_id, len(w) AS n, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         coalesce(n_dup, 0) AS n_dup, coalesce(n_rep, 0) AS n_rep, coalesce(n_lines, 0) AS n_lines, coalesce(n_dots, 0) AS n_dots, coalesce(n_bullets, 0) AS n_bullets,
         len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS n_stutter, len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_lettered,
         length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters
         FROM doc LEFT JOIN lines USING (r) LEFT JOIN rep USING (r)),
judged AS (SELECT *, n < 10 OR 100 * n_rep > 20 * n AS failed FROM base)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup AS BIGINT) AS n_dup_lines,
       CAST(n_rep AS BIGINT) AS n_repeat_words, failed AS base_failed,
       NOT (failed OR 100 * n_symbols > 10 * n OR word_chars < 3 * n OR word_chars > 12 * n OR 100 * n_dup > 50 * n_lines OR 100 * n_stutter > 25 * n
            OR 100 * n_lettered < 70 * n OR 100 * n_upper > 30 * n_letters OR 100 * n_dots > 30 * n_lines OR 100 * n_bullets > 90 * n_lines) AS kept
FROM judged
"""

OP11 = r"""
WITH doc AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
piece AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM doc)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM piece GROUP BY lang),
gram AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS s FROM piece, range(1, 4) AS a(k), unnest(range(1, len(w) - k + 2)) AS u(i)),
freq AS (SELECT lang, k, s, count(*) AS f FROM gram GROUP BY lang, k, s HAVING count(*) >= 10),
cand AS (SELECT lang, k, s, f AS a, string_split(s, ' ') AS w FROM freq WHERE k > 1),
cut AS (SELECT c.lang, c.s, c.a, c.k, i, x.f AS l, y.f AS r, (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS score
        FROM (SELECT *, unnest(range(1, k)) AS i FROM cand) c
        JOIN freq x ON x.lang = c.lang AND x.s = array_to_string(c.w[1:i], ' ') JOIN freq y ON y.lang = c.lang AND y.s = array_to_string(c.w[i + 1:c.k], ' ')),
lowest AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, i) = 1),
longer AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS s, max(a) AS most FROM (SELECT *, unnest([1, 2]) AS i FROM cand WHERE k = 3) GROUP BY 1, 2),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN longer USING (lang, s) WHERE k = 3 OR most IS NULL OR 100 * most < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM kept)
SELECT lang, rank, s AS phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""

ORACLE = {"op11_collocations": OP11, "op4_decontamination": OP4, "op5_line_spread": OP5, "op8_quality_rules": OP8}
