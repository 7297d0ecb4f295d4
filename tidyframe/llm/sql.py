r"""DuckDB SQL for the queries whose results SQL can express.  It is written from the
contracts, not from the Spark code, and reads the same whole tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS row_no, doc_id, coalesce(text, '') AS t,
             {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT row_no, i, array_to_string(w[i:i + 4], ' ') AS key
            FROM (SELECT row_no, w, unnest(range(1, len(w) - 3)) AS i FROM d) AS starts),
again AS (SELECT row_no, i FROM windows
          QUALIFY count(*) OVER (PARTITION BY row_no, key) > 1),
covered AS (SELECT row_no, count(DISTINCT i + j) AS n FROM again,
              (SELECT unnest(range(0, 5)) AS j) AS offsets GROUP BY row_no),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
         length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS n_upper,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
         coalesce(n, 0) AS n_repeat_words
  FROM d LEFT JOIN covered USING (row_no)),
n AS (SELECT *, len(lines) AS n_lines, len(lines) - len(list_distinct(lines)) AS n_dup_lines FROM m),
bits AS (
  SELECT *, (n_words < 10)::BIGINT + 2 * (100 * n_repeat_words > 20 * n_words)::BIGINT
    + 4 * (n_words > 0 AND (word_chars < 2 * n_words OR word_chars > 20 * n_words))::BIGINT
    + 8 * (10 * n_symbols > n_words)::BIGINT + 16 * (n_lines > 1 AND 10 * n_dup_lines > 3 * n_lines)::BIGINT
    + 32 * (2 * n_upper > word_chars)::BIGINT AS fail_bits
  FROM n)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
       fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits
FROM bits
"""

NEAR_COPIES = rf"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0) AS starts),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
met AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n_both
        FROM grams AS a JOIN grams AS b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT met.a, met.b FROM met JOIN sizes AS x ON x.doc_id = met.a JOIN sizes AS y ON y.doc_id = met.b
          WHERE 100 * n_both >= 85 * (x.n + y.n - n_both)),
reach AS (SELECT doc_id, doc_id AS seen FROM d
          UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.seen)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, c.component_id
FROM d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT doc_id, min(seen) AS component_id FROM reach GROUP BY doc_id) AS c ON c.doc_id = d.doc_id
"""

LINE_RUNS = rf"""
WITH raw AS (SELECT doc_id, text, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents),
lines AS (SELECT doc_id, pos, x AS line, len({_WORDS.format("x")}) AS words,
            row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS k
          FROM (SELECT doc_id, pos, trim(line, {_BLANKS}) AS x FROM raw) AS trimmed WHERE x <> ''),
fours AS (SELECT a.doc_id, a.k, a.line || chr(10) || b.line || chr(10) || c.line || chr(10) || e.line AS key
          FROM lines AS a JOIN lines AS b ON b.doc_id = a.doc_id AND b.k = a.k + 1
          JOIN lines AS c ON c.doc_id = a.doc_id AND c.k = a.k + 2
          JOIN lines AS e ON e.doc_id = a.doc_id AND e.k = a.k + 3),
gone AS (
  SELECT DISTINCT doc_id, k + j AS k
  FROM (SELECT doc_id, k FROM fours QUALIFY row_number() OVER (PARTITION BY key ORDER BY doc_id, k) > 1) AS later,
       (SELECT unnest(range(0, 4)) AS j) AS offsets
  UNION
  SELECT doc_id, k FROM lines WHERE words >= 10
  QUALIFY row_number() OVER (PARTITION BY line ORDER BY doc_id, k) > 1),
per AS (SELECT doc_id, count(*) AS n_removed, count_if(before IS NULL) AS n_runs
        FROM (SELECT g.doc_id, h.k AS before FROM gone AS g
              LEFT JOIN gone AS h ON h.doc_id = g.doc_id AND h.k = g.k - 1) AS pairs GROUP BY doc_id),
kept AS (SELECT raw.doc_id, string_agg(raw.line, chr(10) ORDER BY raw.pos) AS text
         FROM raw LEFT JOIN (SELECT lines.doc_id, lines.pos FROM gone JOIN lines USING (doc_id, k)) AS x
           ON x.doc_id = raw.doc_id AND x.pos = raw.pos
         WHERE x.pos IS NULL GROUP BY raw.doc_id)
SELECT documents.doc_id, coalesce(n, 0)::INTEGER AS n_lines, coalesce(n_removed, 0)::INTEGER AS n_removed,
       coalesce(n_runs, 0)::INTEGER AS n_runs,
       CASE WHEN documents.text IS NOT NULL THEN sha256(coalesce(kept.text, '')) END AS kept_sha256
FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM lines GROUP BY doc_id) AS counted USING (doc_id)
LEFT JOIN per USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

SUBSTRINGS = rf"""
WITH d AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS key
            FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d) AS starts),
later AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY key) < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM later, (SELECT unnest(range(0, 50)) AS j) AS offsets),
each_word AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
kept AS (SELECT e.doc_id, count(g.i) AS n_removed,
                coalesce(string_agg(e.word, ' ' ORDER BY e.i) FILTER (WHERE g.i IS NULL), '') AS text
         FROM each_word AS e LEFT JOIN gone AS g ON g.doc_id = e.doc_id AND g.i = e.i GROUP BY e.doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

_ESCAPED = "replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '[', '&#91;')"
CHATS = f"""
WITH said AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, turn, role, '</s>[INST] ok [/INST]'
              FROM (VALUES (0, 'user'), (1, 'assistant')) AS planted(turn, role)),
chats AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                  FILTER (WHERE role = 'assistant'), '') AS loss,
         sum(length('[TURN]' || {_ESCAPED.format('role')} || '[SAYS]' || {_ESCAPED.format('text')} || '</s>')) AS chars
  FROM said GROUP BY conv_id)
SELECT conv_id, n_turns::BIGINT AS n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, chars::BIGINT AS formatted_chars
FROM chats
"""

#: ``part`` holds every occurrence of 1 to 5 words
COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
lists AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
starts AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM lists),
part AS (
  SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM starts, (SELECT unnest(range(1, 6)) AS m) AS lengths WHERE i + m - 1 <= len(w)),
totals AS (SELECT lang, count(*) AS n FROM part WHERE m = 1 GROUP BY lang),
freq AS (SELECT lang, m, phrase, count(*) AS f FROM part GROUP BY lang, m, phrase HAVING count(*) >= 100),
longer AS (
  SELECT lang, phrase, max(f) AS f FROM (
    SELECT lang, f, unnest([array_to_string(string_split(phrase, ' ')[1:m - 1], ' '),
                            array_to_string(string_split(phrase, ' ')[2:m], ' ')]) AS phrase
    FROM freq WHERE m > 2) AS subs GROUP BY lang, phrase),
kept AS (
  SELECT freq.* FROM freq LEFT JOIN longer USING (lang, phrase)
  WHERE m > 1 AND (longer.f IS NULL OR 100 * longer.f < 100 * freq.f)),
cuts AS (
  SELECT lang, phrase, f AS a, k, array_to_string(string_split(phrase, ' ')[1:k], ' ') AS p,
         array_to_string(string_split(phrase, ' ')[k + 1:m], ' ') AS q
  FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) AS each_cut),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, lf.f AS l, rf.f AS r, n,
         (1000::HUGEINT * a * n) // (lf.f::HUGEINT * rf.f) AS score
  FROM cuts JOIN freq AS lf ON lf.lang = cuts.lang AND lf.phrase = p
  JOIN freq AS rf ON rf.lang = cuts.lang AND rf.phrase = q JOIN totals ON totals.lang = cuts.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       a, l, r, n, score::BIGINT AS score
FROM best QUALIFY rank <= 2000
"""
