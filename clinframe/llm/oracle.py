"""DuckDB SQL of the operators that SQL can express, over the registered tables."""

from .licenses import TEMPLATES
from .oracle_merkle import MERKLE_SQL

LINE_WINDOWS = r"""
WITH raw AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls, text FROM documents),
l AS (SELECT doc_id, i, ls[i] AS line, trim(regexp_replace(lower(ls[i]), '[ \t\x0B\f\r]+', ' ', 'g')) AS norm
      FROM (SELECT doc_id, ls, unnest(range(1, len(ls) + 1)) AS i FROM raw)),
f AS (SELECT doc_id, i, norm, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS o FROM l WHERE norm <> ''),
w AS (SELECT doc_id, o, [norm, lead(norm, 1) OVER d, lead(norm, 2) OVER d] AS win, lead(norm, 2) OVER d AS last
      FROM f WINDOW d AS (PARTITION BY doc_id ORDER BY o)),
r AS (SELECT doc_id, o, row_number() OVER (PARTITION BY win ORDER BY doc_id, o) AS n FROM w WHERE last IS NOT NULL),
gone AS (SELECT DISTINCT doc_id, o + k AS o FROM r, (VALUES (0), (1), (2)) v(k) WHERE n > 1),
spans AS (SELECT doc_id, count(*) AS n_removed, count(*) FILTER (WHERE p IS NULL OR p <> o - 1) AS n_spans
          FROM (SELECT doc_id, o, lag(o) OVER (PARTITION BY doc_id ORDER BY o) AS p FROM gone) GROUP BY doc_id),
kept AS (SELECT l.doc_id, string_agg(l.line, chr(10) ORDER BY l.i) AS text
         FROM l LEFT JOIN f ON f.doc_id = l.doc_id AND f.i = l.i LEFT JOIN gone g ON g.doc_id = f.doc_id AND g.o = f.o
         WHERE g.o IS NULL GROUP BY l.doc_id)
SELECT d.doc_id, (SELECT count(*) FROM f WHERE f.doc_id = d.doc_id) AS n_lines, coalesce(s.n_removed, 0) AS n_removed,
       coalesce(s.n_spans, 0) AS n_spans, md5(coalesce(k.text, '')) AS text_md5
FROM documents d LEFT JOIN spans s ON s.doc_id = d.doc_id LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

LINE_FREQUENCY = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i
          FROM (SELECT doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS ws FROM d)),
base AS (SELECT doc_id, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY doc_id),
win AS (SELECT doc_id, i, [word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o, lead(word, 4) OVER o,
               lead(word, 5) OVER o, lead(word, 6) OVER o, lead(word, 7) OVER o] AS g, lead(word, 7) OVER o AS last
        FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win WHERE last IS NOT NULL) WHERE n > 1),
rep AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, range(0, 8) r(k) GROUP BY doc_id),
lines AS (SELECT doc_id, host, text, line, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n,
                 regexp_replace(lower(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' ')), '[0-9]', '0', 'g') AS norm
          FROM (SELECT doc_id, host, text, unnest(string_split(text, chr(10))) AS line FROM d)),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE n > 0 GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT text) AS n FROM d GROUP BY host),
often AS (SELECT l.host, l.norm FROM lines l JOIN hosts h ON h.host = l.host WHERE l.n > 0
          GROUP BY l.host, l.norm, h.n HAVING count(DISTINCT l.text) >= 20 AND 100 * count(DISTINCT l.text) >= 5 * h.n),
freq AS (SELECT l.doc_id, l.host, sum(l.n) AS n FROM lines l JOIN often o ON o.host = l.host AND o.norm = l.norm GROUP BY l.doc_id, l.host),
a AS (SELECT d.doc_id, coalesce(b.n_words, 0) AS n_words, coalesce(b.word_chars, 0) AS word_chars,
             length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(u.n, 0) AS n_dup_lines,
             coalesce(r.n, 0) AS n_repeat_words, coalesce(f.n, 0) AS n_frequent_words
      FROM d LEFT JOIN base b USING (doc_id) LEFT JOIN rep r USING (doc_id) LEFT JOIN dup u USING (doc_id) LEFT JOIN freq f USING (doc_id, host))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines,
       n_repeat_words::BIGINT AS n_repeat_words, n_frequent_words::BIGINT AS n_frequent_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words
            OR n_words - n_frequent_words < 20 OR 100 * (n_words - n_frequent_words) < 50 * n_words) AS kept
FROM a
"""

LICENSES = r"""
WITH tpl(license, text) AS (VALUES %s),
tw AS (SELECT license, list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda w: w <> '') AS w FROM tpl),
ts AS (SELECT DISTINCT license, len(w) AS n, w[i:i + least(5, len(w)) - 1] AS sh
       FROM (SELECT license, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM tw)),
dw AS (SELECT doc_id, list_filter(string_split(trim(regexp_replace(lower(text), '[^\p{L}\p{N}]+', ' ', 'g')), ' '), lambda w: w <> '') AS w FROM documents),
ds AS (SELECT doc_id, w[i:i + k - 1] AS sh FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
       FROM dw, (SELECT DISTINCT len(sh) AS k FROM ts) WHERE len(w) >= k)),
hit AS (SELECT ds.doc_id, ts.license, count(DISTINCT ts.sh) AS n_found FROM ds JOIN ts ON ts.sh = ds.sh GROUP BY ALL),
size AS (SELECT license, count(*) AS n_template FROM ts GROUP BY license)
SELECT doc_id, license, n_found, n_template, n_found / n_template AS containment
FROM hit JOIN size USING (license) WHERE 100 * n_found >= 80 * n_template
""" % ", ".join("('%s', '%s')" % (n, t.replace("'", "''")) for n, t in TEMPLATES)

NEAR_DUPLICATES = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                       '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, w[i:i + 3] AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)),
ends AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, b.y FROM reach r JOIN ends b ON b.x = r.other),
comp AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM comp LEFT JOIN n USING (doc_id)
"""

ORACLE = {"op2_superminhash": NEAR_DUPLICATES, "op4_line_frequency": LINE_FREQUENCY, "op7_line_windows": LINE_WINDOWS, "op10_license_bands": LICENSES,
          "op12_merkle_witnesses": MERKLE_SQL}
