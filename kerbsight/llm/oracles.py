"""DuckDB SQL for the queries that SQL can express; written from the definitions, not from the operators."""

from __future__ import annotations

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_JACCARD = f"""
WITH RECURSIVE
  docs AS (SELECT doc_id, {WORDS.format(text=LOWERED)} AS w FROM documents),
  sets AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                  ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s FROM docs),
  entries AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
  common AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS k
               FROM entries a JOIN entries b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
  links AS (SELECT x, y FROM common WHERE 100 * k >= 75 * (nx + ny - k)),
  reach(x, y) AS (SELECT doc_id, doc_id FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.component_id
FROM sets s JOIN (SELECT x, min(y) AS component_id FROM reach GROUP BY x) m ON m.x = s.doc_id
"""

SOURCE_MIXING = f"""
WITH
  sizes AS (SELECT doc_id, source, len({WORDS.format(text="coalesce(text, '')")})::BIGINT AS size,
                   ('0x' || md5('mix-1/block/' || coalesce(doc_id::VARCHAR, ''))[1:6])::INT % 256 AS block FROM documents),
  per AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
  weighted AS (SELECT *, ([5, 2, 1])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight FROM per),
  levels AS (
    SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE - coalesce((sum(2 * source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE, 0))
              / (sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
    FROM weighted WINDOW o AS (ORDER BY source_size::DOUBLE / weight, source NULLS LAST)),
  targets AS (
    SELECT source, source_size, coalesce(least((2 * source_size)::DOUBLE,
             (SELECT max(level) FROM levels l WHERE l.level * l.weight <= 2 * l.source_size) * weight), (2 * source_size)::DOUBLE) AS target
    FROM levels),
  blocks AS (
    SELECT source, block, sum(size) AS words, coalesce(sum(sum(size)) OVER (
             PARTITION BY source ORDER BY md5('mix-1/order/' || coalesce(source, '') || '/' || block), block
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sizes GROUP BY source, block HAVING sum(size) > 0),
  takes AS (
    SELECT b.source, b.block, least(b.words, round(t.target) - p.pass * t.source_size - b.before) AS take
    FROM blocks b JOIN targets t ON t.source IS NOT DISTINCT FROM b.source, (VALUES (0), (1)) AS p(pass)),
  placed AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source, block ORDER BY md5('mix-1/doc/' || coalesce(doc_id::VARCHAR, '')), doc_id, size
                                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sizes WHERE size > 0),
  taken AS (
    SELECT p.doc_id, sum(greatest(0, least(p.size, t.take - p.before))) AS taken
    FROM placed p JOIN takes t ON t.source IS NOT DISTINCT FROM p.source AND t.block = p.block GROUP BY p.doc_id)
SELECT s.doc_id, s.size, t.source_size, t.target, coalesce(k.taken, 0)::BIGINT AS taken
FROM sizes s JOIN targets t ON t.source IS NOT DISTINCT FROM s.source LEFT JOIN taken k ON k.doc_id = s.doc_id
"""

SUBSTRING_DEDUP = f"""
WITH
  docs AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
  places AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM docs),
  windows AS (SELECT doc_id, i, w[i] AS word, CASE WHEN i + 34 <= len(w) THEN array_to_string(w[i:i + 34], ' ') END AS win FROM places),
  counted AS (SELECT doc_id, i, word, win IS NOT NULL AND count(*) OVER (PARTITION BY win) > 1 AS again FROM windows),
  marked AS (SELECT doc_id, i, word, max(again::INT) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM counted),
  kept AS (SELECT doc_id, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM marked GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(k.kept, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

BLOCK_SEARCH = f"""
WITH
  docs AS (SELECT doc_id, regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
  sized AS (SELECT doc_id, w, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
  whole AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM sized),
  counts AS (SELECT doc_id, n, t, count(*)::BIGINT AS tf FROM (SELECT doc_id, n, unnest(w) AS t FROM sized) GROUP BY ALL),
  holding AS (SELECT t, count(*)::BIGINT AS df FROM counts GROUP BY t),
  weights AS (SELECT t, floor(1000 * ln((2 * nn + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight FROM holding, whole),
  asked AS (SELECT item_id, unnest(regexp_extract_all({LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
  wanted AS (SELECT item_id, t, count(*)::BIGINT AS times FROM asked GROUP BY ALL),
  scores AS (SELECT item_id, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll))))::BIGINT AS score
               FROM wanted JOIN weights USING (t) JOIN counts USING (t), whole GROUP BY ALL),
  placed AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, place::INT AS rank, doc_id, score FROM placed WHERE place <= 20
"""

QUALITY_RULES = f"""
WITH
  docs AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
  good AS (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id HAVING min(quality) = 1
           ORDER BY md5(doc_id::VARCHAR), doc_id LIMIT 50000),
  coded AS (SELECT doc_id, [('0x' || md5(x)[1:8])::BIGINT // 2 FOR x IN w] AS h FROM docs),
  grams AS (SELECT doc_id, list_concat([x % 65536 FOR x IN h], [(h[i] * 1000003 % 2147483648 + h[i + 1]) % 65536 FOR i IN range(1, len(h))]) AS g FROM coded),
  flat AS (SELECT doc_id, unnest(g) AS bucket FROM grams),
  raw AS (SELECT bucket, count(*)::DOUBLE AS n FROM flat GROUP BY bucket),
  target AS (SELECT bucket, count(*)::DOUBLE AS n FROM flat WHERE doc_id IN (SELECT doc_id FROM good) GROUP BY bucket),
  sums AS (SELECT (SELECT sum(n) FROM raw) AS r, (SELECT coalesce(sum(n), 0) FROM target) AS t),
  ratios AS (SELECT bucket, CASE WHEN t = 0 THEN 0 ELSE round(1e6 * ln((coalesce(target.n, 0) * (r + 65536) / (raw.n + 1) + 65536) / (t + 65536))) END::BIGINT AS ratio
               FROM raw LEFT JOIN target USING (bucket), sums),
  scores AS (SELECT doc_id, sum(ratio)::BIGINT AS ratio FROM flat JOIN ratios USING (bucket) GROUP BY doc_id),
  windows AS (SELECT doc_id, unnest(range(1, len(w) - 6)) AS i, w FROM docs),
  named AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS win FROM windows),
  again AS (SELECT doc_id, i FROM named QUALIFY count(*) OVER (PARTITION BY doc_id, win) > 1),
  covered AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + 8)) AS j FROM again) GROUP BY doc_id),
  lines AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs),
  same AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
  base AS (
    SELECT d.doc_id, len(d.w)::BIGINT AS n_words, length(array_to_string(d.w, ''))::BIGINT AS word_chars,
           (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, coalesce(same.n, 0)::BIGINT AS n_dup_lines,
           coalesce(covered.n, 0)::BIGINT AS n_repeat_words, len(g.g)::BIGINT AS n_grams, coalesce(s.ratio, 0)::BIGINT AS ratio
    FROM docs d JOIN grams g USING (doc_id) LEFT JOIN same USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN scores s USING (doc_id)),
  judged AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT *, NOT base_failed AND ratio >= -100000 * (n_grams + 50) AS kept FROM judged
"""

TURN_REPAIR = r"""
WITH RECURSIVE
  shift(i, v) AS (SELECT 0, 0::BIGINT UNION ALL SELECT i + 1, v + 1 FROM shift WHERE i < 255),
  bits(n, k, v) AS (SELECT v, 0, v FROM shift UNION ALL
                    SELECT n, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM bits WHERE k < 8),
  crc_table AS (SELECT list(v ORDER BY n) AS t FROM bits WHERE k = 8),
  input AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
  keyed AS (SELECT input.*, xor(list_reduce(string_split(key, '')::VARCHAR[], lambda a, b: (xor(t[(xor(a::BIGINT, ord(b)) % 256 + 1)::INT], a::BIGINT // 256))::VARCHAR, '4294967295')::BIGINT, 4294967295) % 20 AS d
              FROM input, crc_table),
  hurt AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
                  CASE d WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text, unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) AS copy
             FROM keyed WHERE d <> 0),
  coded AS (SELECT *, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS inked,
                   md5(strlen(role) || ':' || role || strlen(text) || ':' || text) AS code FROM hurt),
  ordered AS (SELECT *, row_number() OVER o AS i, count(*) OVER (PARTITION BY conv_id) AS n,
                     row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS seen,
                     role[1] AS x, lag(role[1]) OVER o AS before
                FROM coded WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, code, copy)),
  faults AS (SELECT *, inked = '' AS blank, inked <> '' AND seen AS duplicate, inked <> '' AND NOT seen AND inked[-1] NOT IN ('.', '!', '?') AS truncated FROM ordered),
  -- the state: what came last (0 nothing, 1 s, 2 u, 3 a); c and a: least cost and its least audit, by state
  raw_steps(conv_id, i, s) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, [{'c': 0, 'a': ''}, NULL, {'c': 5, 'a': 'I'}, {'c': 10, 'a': 'II'}] FROM faults
    UNION ALL
    SELECT conv_id, i, [s[1], s[2], u, list_min(list_filter([s[4], CASE WHEN u IS NULL THEN NULL ELSE {'c': u.c + 5, 'a': u.a || 'I'} END], lambda z: z IS NOT NULL))] FROM (
      SELECT conv_id, i, s, list_min(list_filter([s[3], CASE WHEN s[1] IS NOT NULL THEN {'c': s[1].c + 5, 'a': s[1].a || 'I'} END,
               CASE WHEN s[2] IS NOT NULL THEN {'c': s[2].c + 5, 'a': s[2].a || 'I'} END, CASE WHEN s[4] IS NOT NULL THEN {'c': s[4].c + 5, 'a': s[4].a || 'I'} END], lambda z: z IS NOT NULL)) AS u FROM (
        SELECT conv_id, i, [list_min(list_transform(list_filter(list_concat(
                 [CASE WHEN s[k] IS NOT NULL THEN {'f': k, 't': k, 'c': 2, 'a': 'D'} END FOR k IN [1, 2, 3, 4]],
                 [CASE WHEN s[k] IS NOT NULL AND NOT must THEN {'f': k, 't': CASE WHEN k = 3 THEN 4 ELSE 3 END, 'c': 1 + more, 'a': 'R'} END FOR k IN [1, 2, 3, 4]],
                 [CASE WHEN s[k] IS NOT NULL AND NOT must AND (x = 's' AND k = 1 OR x = 'u' AND k <> 3 OR x = 'a' AND k = 3)
                       THEN {'f': k, 't': CASE x WHEN 's' THEN 2 WHEN 'u' THEN 3 ELSE 4 END, 'c': more, 'a': 'K'} END FOR k IN [1, 2, 3, 4]]),
               lambda z: z IS NOT NULL AND z.t = j), lambda z: {'c': (s[z.f].c + z.c)::INT, 'a': s[z.f].a || z.a})) FOR j IN [1, 2, 3, 4]] AS s
        FROM (SELECT r.conv_id, f.i, r.s, f.x, f.blank OR f.duplicate AS must, CASE WHEN f.truncated THEN 5 ELSE 0 END AS more
                FROM raw_steps r JOIN faults f ON f.conv_id IS NOT DISTINCT FROM r.conv_id AND f.i = r.i + 1)))),
  ends AS (SELECT r.conv_id, list_min(list_filter([r.s[1], r.s[4]], lambda z: z IS NOT NULL)) AS best
             FROM raw_steps r JOIN (SELECT conv_id, max(i) AS n FROM faults GROUP BY conv_id) m ON m.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = m.n),
  letters AS (SELECT conv_id, best.a AS a, unnest(range(1, length(best.a) + 1)) AS p FROM ends),
  edits AS (SELECT conv_id, p, a[p] AS e, length(replace(a[1:p], 'I', '')) AS i, length(replace(a[1:p - 1], 'D', '')) AS kept FROM letters),
  left_over AS (SELECT e.conv_id, e.p, e.e, e.kept, f.role, f.text FROM edits e LEFT JOIN faults f
                  ON f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i AND e.e <> 'I' WHERE e.e <> 'D'),
  opened AS (SELECT *, coalesce(first_value(e = 'K' AND role[1] = 's') OVER (PARTITION BY conv_id ORDER BY p), false)::INT AS sys FROM left_over),
  said AS (SELECT conv_id, string_agg(CASE WHEN e = 'K' THEN role WHEN (kept - sys) % 2 = 0 THEN 'user' ELSE 'assistant' END || ':' || coalesce(text, ''), chr(10) ORDER BY p) AS whole
             FROM opened GROUP BY conv_id),
  counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
                    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
                    count(*) FILTER (i > 1 AND before || x NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id)
SELECT d.conv_id, coalesce(k.gaps, 0)::BIGINT AS gaps, coalesce(k.blank, 0)::BIGINT AS blank, coalesce(k.duplicate, 0)::BIGINT AS duplicate,
       coalesce(k.truncated, 0)::BIGINT AS truncated, coalesce(k.illegal, 0)::BIGINT AS illegal, coalesce(e.best.c, 0)::BIGINT AS cost,
       coalesce(e.best.a, '') AS audit, sha256(coalesce(s.whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d
LEFT JOIN counts k ON k.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN ends e ON e.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN said s ON s.conv_id IS NOT DISTINCT FROM d.conv_id
"""

ORACLES: dict[str, str] = {
    "op1_ngram_jaccard": NGRAM_JACCARD,
    "op2_source_mixing": SOURCE_MIXING,
    "op5_substring_dedup": SUBSTRING_DEDUP,
    "op11_block_search": BLOCK_SEARCH,
    "op12_quality_rules": QUALITY_RULES,
    "op13_turn_repair": TURN_REPAIR,
}
