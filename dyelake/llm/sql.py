"""SQL forms of operators, for DuckDB over the same tables."""

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words as the contracts define them.
SPACED, ALNUM = r"[^\x20\x09-\x0D]+", r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
TERMS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"



def _levels(depth: int) -> str:
    """The nodes t1, t2, ... of a splitting tree, level by level, from the root's blocks by source in t0."""
    return ",".join(
        f"""u{k} AS (SELECT node, s, row_number() OVER (PARTITION BY node ORDER BY s) - 1 AS i FROM (SELECT node, s, unnest(range(n)) FROM t{k})),
d{k} AS (SELECT node, s, row_number() OVER (PARTITION BY node ORDER BY md5(concat_ws(':', 17, 'tree', {k}, node, i)), i) AS r, count(*) OVER (PARTITION BY node) AS c FROM u{k}),
t{k + 1} AS (SELECT 2 * node + CASE WHEN r <= c // 2 THEN 0 ELSE 1 END AS node, s, count(*) AS n FROM d{k} GROUP BY 1, 2)"""
        for k in range(depth)
    )


OP1 = rf"""
WITH d AS (SELECT row_number() OVER () AS id, doc_id, source, coalesce('=' || source, '~null') AS s, len(regexp_extract_all(coalesce(text, ''), '{SPACED}')) AS size,
    md5(concat_ws(':', 17, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))))) AS key FROM documents),
s AS (SELECT source, s, CAST(sum(size) AS BIGINT) AS source_size, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM d GROUP BY source, s),
f AS (SELECT *, 2 * source_size AS cap,
    coalesce(sum(2 * source_size) OVER (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_,
    sum(w) OVER (ORDER BY 2 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS left_, sum(source_size) OVER () AS all_ FROM s),
g AS (SELECT *, CAST(all_ * 1.5 - full_ AS DOUBLE) AS open_ FROM f),
l AS (SELECT arg_min(open_, full_) AS open_, arg_min(CAST(left_ AS DOUBLE), full_) AS left_ FROM g WHERE open_ * w <= cap * left_),
a AS (SELECT s, source_size, least(CAST(cap AS DOUBLE), l.open_ * w / l.left_) AS target FROM g, l),
q AS (SELECT *, CAST(round(target) AS BIGINT) AS goal, CAST(CASE WHEN target > 0 THEN greatest(1, round(target / (SELECT sum(target) FROM a) * 16 * 64)) ELSE 0 END AS BIGINT) AS blocks FROM a),
t0 AS (SELECT 0 AS node, s, blocks AS n FROM q WHERE blocks > 0),
{_levels(4)},
v AS (SELECT s, node AS shard, n, coalesce(sum(n) OVER (PARTITION BY s ORDER BY node ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS first_ FROM t4),
k AS (SELECT s, k, k * goal // blocks AS low, (k + 1) * goal // blocks AS high, row_number() OVER (PARTITION BY s ORDER BY md5(concat_ws(':', 17, 'block', s, k)), k) - 1 AS place
    FROM (SELECT *, unnest(range(blocks)) AS k FROM q)),
b AS (SELECT k.*, shard FROM k JOIN v ON v.s = k.s AND place >= first_ AND place < first_ + n),
p AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY s ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM d WHERE size > 0),
r AS (SELECT id, p.s, key, m, start + m * source_size AS low, least(start + m * source_size + size, goal) AS high FROM p JOIN q USING (s), (VALUES (0), (1)) m(m)),
x AS (SELECT id, m, k, least(r.high, b.high) - greatest(r.low, b.low) AS words, concat_ws(':', shard, k, md5(concat_ws(':', 17, 'place', key, k))[1:8], least(r.high, b.high) - greatest(r.low, b.low)) AS piece
    FROM r JOIN b ON b.s = r.s AND b.low < r.high AND b.high > r.low AND r.low < r.high),
y AS (SELECT id, CAST(sum(words) AS BIGINT) AS taken, string_agg(piece, ',' ORDER BY m, k) AS pieces FROM x GROUP BY id)
SELECT doc_id, size, source_size, target, coalesce(taken, 0) AS taken, coalesce(pieces, '') AS pieces FROM d JOIN q USING (s) LEFT JOIN y USING (id)
"""

OP2 = rf"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, CASE WHEN conv_id IS NULL THEN concat_ws(':', coalesce(CAST(turn AS VARCHAR), '-'), coalesce(role, '-'), coalesce(text, '-')) ELSE '' END AS lone FROM conversations
    UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok', '' UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok', ''),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id, lone ORDER BY turn NULLS FIRST, role, text) AS i, len(regexp_extract_all(role, '{SPACED}')) > 1 AS wordy FROM t),
-- A role of several words is said before the text.
j AS (SELECT conv_id, lone, i, CASE WHEN wordy THEN '' ELSE role END AS role, CASE WHEN wordy THEN 11 + length(CAST(length(role) AS VARCHAR)) ELSE 0 END AS mark, CASE WHEN wordy THEN role || chr(10) || text ELSE text END AS text FROM n),
k AS (SELECT *, len(regexp_extract_all(text, '{SPACED}')) AS words FROM j),
x AS (SELECT conv_id, lone, i, role, mark, CASE WHEN words <= 508 THEN [text] ELSE regexp_extract_all(text, '(?:[\x20\x09-\x0D]*[^\x20\x09-\x0D]+){{1,508}}(?:[\x20\x09-\x0D]+\z)?') END AS parts FROM k),
y AS (SELECT conv_id, lone, i, role, mark, unnest(parts) AS text, generate_subscripts(parts, 1) AS part FROM x),
z AS (SELECT *, len(regexp_extract_all(text, '{SPACED}')) + 4 AS tokens FROM y),
s AS (SELECT *, i = 1 AND part = 1 AND role = 'system' AND tokens <= 128 AS pinned, sum(tokens) OVER (PARTITION BY conv_id, lone ORDER BY i, part) AS total FROM z),
w AS (SELECT *, CAST((total - 1) // 384 AS INT) AS w, first_value(CASE WHEN pinned THEN tokens ELSE 0 END) OVER (PARTITION BY conv_id, lone ORDER BY i, part) AS sys FROM s),
e AS (SELECT *, max(total) OVER (PARTITION BY conv_id, lone, w) AS until FROM w),
a AS (SELECT *, lead(w, 1) OVER o AS a1, lead(w, 2) OVER o AS a2, lead(until, 1) OVER o AS e1, lead(until, 2) OVER o AS e2 FROM e WINDOW o AS (PARTITION BY conv_id, lone ORDER BY i, part)),
u AS (SELECT conv_id, lone, count(DISTINCT w) AS spans FROM w GROUP BY conv_id, lone),
c AS (SELECT a.*, spans,
    CASE WHEN pinned THEN spans ELSE 1 + len(list_distinct(list_filter([CASE WHEN a1 > w AND e1 - total + tokens + sys <= 1024 THEN a1 END, CASE WHEN a2 > w AND e2 - total + tokens + sys <= 1024 THEN a2 END], lambda x: x IS NOT NULL))) END AS times,
    length(replace(replace(text, '\', '\\'), '<|', '<\|')) + length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '..')) + 24 + CASE WHEN part > 1 THEN 11 ELSE mark END AS chars,
    CASE WHEN pinned THEN tokens ELSE 0 END AS again FROM a JOIN u ON a.conv_id IS NOT DISTINCT FROM u.conv_id AND a.lone = u.lone),
-- Tokens of each window: its new turns, the system turn where it isn't new, and what fits of the two turns before.
h AS (SELECT conv_id, lone, unnest([a1, a2]) AS v, unnest([CASE WHEN a1 > w AND e1 - total + tokens + sys <= 1024 THEN tokens ELSE 0 END, CASE WHEN a2 > w AND a2 IS DISTINCT FROM a1 AND e2 - total + tokens + sys <= 1024 THEN tokens ELSE 0 END]) AS k FROM c WHERE NOT pinned),
b AS (SELECT conv_id, lone, v, sum(k) AS k FROM (SELECT conv_id, lone, v, k FROM h UNION ALL SELECT conv_id, lone, w, tokens FROM c UNION ALL SELECT DISTINCT conv_id, lone, w, CASE WHEN w > 0 THEN sys ELSE 0 END FROM c) WHERE v IS NOT NULL GROUP BY ALL),
m AS (SELECT conv_id, lone, CAST(max(k) AS BIGINT) AS most FROM b GROUP BY ALL),
g AS (SELECT conv_id, lone, CAST(sum(chars * times) AS BIGINT) AS formatted_chars, CAST(any_value(spans) AS BIGINT) AS n_windows FROM c GROUP BY ALL),
r AS (SELECT conv_id, lone, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256 FROM n GROUP BY ALL)
SELECT r.conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, n_windows, most AS most_tokens
FROM r JOIN g ON r.conv_id IS NOT DISTINCT FROM g.conv_id AND r.lone = g.lone JOIN m ON r.conv_id IS NOT DISTINCT FROM m.conv_id AND r.lone = m.lone
"""

OP6 = rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{SPACED}') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 2], ' ') AS x FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 2) + 1)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT p.doc_id AS a, q.doc_id AS b, count(*) AS common FROM s p JOIN s q ON p.x = q.x AND p.doc_id < q.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * common >= 85 * (x.n + y.n - common)),
g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(a, b) AS (SELECT a, a FROM g UNION SELECT r.a, g.b FROM r JOIN g ON g.a = r.b),
m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(m.component_id, d.doc_id) AS component_id, coalesce(m.component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN m USING (doc_id)
"""

OP9 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM}') AS w FROM benchmark),
v AS (SELECT DISTINCT item, w[i : i + 9] AS win, least(10, len(w)) AS l FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
x AS (SELECT r, i, l, w[i : i + l - 1] AS win FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d), (SELECT DISTINCT l FROM v) WHERE i + l - 1 <= len(w)),
m AS (SELECT r, i, l, item FROM x JOIN v USING (win, l)),
h AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM (SELECT DISTINCT r, i, l FROM m), (SELECT unnest(range(0, 10)) AS k) WHERE k < l GROUP BY r),
t AS (SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS items FROM m GROUP BY r),
p AS (SELECT r, w, word, i FROM (SELECT r, w, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d)),
f AS (SELECT word, count(*) AS n FROM p GROUP BY word),
k AS (SELECT item, win, arg_min(word, (coalesce(n, 0), word)) AS word FROM (SELECT item, win, unnest(win) AS word FROM v) LEFT JOIN f USING (word) GROUP BY 1, 2),
q AS (SELECT p.r, k.item, bool_or(list_has_all(p.w[greatest(1, p.i - s) : p.i - s + 13], k.win)) AS near FROM p JOIN k USING (word), (SELECT unnest(range(0, 14)) AS s) GROUP BY 1, 2),
z AS (SELECT r, count(DISTINCT item) AS n_near FROM (SELECT r, item FROM q WHERE near UNION SELECT r, item FROM m) GROUP BY r)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(t.items, sha256('')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AS contaminated, coalesce(n_near, 0) AS n_near_items
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r) LEFT JOIN z USING (r)
"""

OP11 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
x AS (SELECT r, doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{LOWER}') AS key FROM x),
f AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
g AS (SELECT k.*, f.key IS NOT NULL AND doc_id IS DISTINCT FROM last AS gone FROM k LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM g GROUP BY r, doc_id
"""

OP12 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, k, w[i : i + k - 1] AS p FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (VALUES (1), (2), (3)) v(k) WHERE len(w) >= k)),
f AS (SELECT lang, k, p, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 10),
c AS (SELECT f.lang, f.k AS size, f.p, f.a, x.k, x.a AS l, y.a AS r, CAST((CAST(1000000 AS HUGEINT) * f.a * f.a) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
    FROM f JOIN f x ON x.lang = f.lang AND x.k < f.k AND x.p = f.p[1 : x.k] JOIN f y ON y.lang = f.lang AND y.p = f.p[x.k + 1 : f.k] WHERE f.k > 1),
b AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
o AS (SELECT lang, p, max(a) AS a FROM (SELECT lang, p[1:2] AS p, a FROM f WHERE k = 3 UNION ALL SELECT lang, p[2:3], a FROM f WHERE k = 3) GROUP BY ALL),
z AS (SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM b LEFT JOIN o ON o.lang = b.lang AND o.p = b.p WHERE o.a IS NULL OR 100 * o.a < 50 * b.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM z JOIN t USING (lang) QUALIFY rank <= 2000
"""

OP13 = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERMS}') AS w FROM documents),
s AS (SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, w FROM d WHERE len(w) > 0),
c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS words FROM s),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM s) GROUP BY ALL),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{TERMS}')) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
v AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, c WHERE term IN (SELECT term FROM q) GROUP BY term, docs),
m AS (SELECT r, doc_id, 75 + (25 * n * docs) // words AS m FROM s, c),
x AS (SELECT item_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score FROM q JOIN v USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id, r) AS INTEGER) AS rank, doc_id, score FROM x JOIN d USING (r) WHERE score > 0 QUALIFY rank <= 20
"""
