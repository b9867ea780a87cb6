"""SQL that gives the rows of the queries which SQL can express, written from their definitions."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return f"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '{pattern}')"


DECONTAMINATION = f"""
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
    items AS (SELECT item_id, w, least(len(w), 13) AS m FROM (
        SELECT item_id, {_words("coalesce(text, '')")} AS w FROM benchmark) WHERE len(w) > 0),
    windows AS (SELECT DISTINCT item_id, m, array_to_string(w[i:i + m - 1], ' ') AS g
                FROM (SELECT *, unnest(range(1, len(w) - m + 2)) AS i FROM items)),
    sizes AS (SELECT DISTINCT m FROM windows),
    grams AS (SELECT r, m, i, array_to_string(w[i:i + m - 1], ' ') AS g
              FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM texts, sizes WHERE len(w) >= m)),
    hits AS (SELECT DISTINCT r, m, i, item_id FROM grams JOIN windows USING (m, g)),
    covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + m)) AS p FROM hits) GROUP BY r),
    named AS (SELECT r, count(*) AS n, string_agg(name, ',' ORDER BY name) AS ids
              FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS name FROM hits) GROUP BY r)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(covered.n, 0) AS n_hit, coalesce(named.n, 0) AS n_items,
           sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(covered.n, 0) > 0 AND 20 * coalesce(covered.n, 0) >= len(w) AS contaminated
    FROM texts LEFT JOIN covered USING (r) LEFT JOIN named USING (r)"""

SENTENCE_SPANS = rf"""
    WITH sentences AS (
        SELECT doc_id, unnest(s) AS sentence, unnest(range(len(s))) AS i FROM (
            SELECT doc_id, [x FOR x IN string_split(replace(
                regexp_replace(coalesce(text, ''), '([.!?])([ \t\n\x0b\f\r])', '\1' || chr(1) || '\2', 'g'),
                chr(10), chr(10) || chr(1)), chr(1)) IF x <> ''] AS s FROM documents)),
    used AS (SELECT doc_id, i, w, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k
             FROM (SELECT doc_id, i, {_words("sentence")} AS w FROM sentences) WHERE len(w) > 0),
    runs AS (
        SELECT a.doc_id, a.i AS first, b.i AS last, 2 AS size, list_concat(a.w, b.w) AS w
        FROM used a JOIN used b ON b.doc_id = a.doc_id AND b.k = a.k + 1 WHERE len(a.w) + len(b.w) >= 24
        UNION ALL
        SELECT a.doc_id, a.i, c.i, 3, list_concat(list_concat(a.w, b.w), c.w)
        FROM used a JOIN used b ON b.doc_id = a.doc_id AND b.k = a.k + 1
        JOIN used c ON c.doc_id = a.doc_id AND c.k = a.k + 2 WHERE len(a.w) + len(b.w) + len(c.w) >= 8),
    placed AS (SELECT doc_id, first, last,
                      row_number() OVER (PARTITION BY size, array_to_string(w, ' ') ORDER BY doc_id, first) AS nth FROM runs),
    gone AS (SELECT DISTINCT doc_id, unnest(range(first, last + 1)) AS i FROM placed WHERE nth > 1)
    SELECT d.doc_id, count(s.i) AS n_sentences, count(g.i) AS n_removed,
           CAST(strlen(coalesce(string_agg(CASE WHEN g.i IS NULL THEN sentence END, '' ORDER BY s.i), '')) AS BIGINT) AS n_bytes,
           sha256(coalesce(string_agg(CASE WHEN g.i IS NULL THEN sentence END, '' ORDER BY s.i), '')) AS kept_sha256
    FROM documents d LEFT JOIN sentences s ON s.doc_id = d.doc_id LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.i = s.i
    GROUP BY d.doc_id"""

NEAR_VECTORS = """
    WITH RECURSIVE vectors AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
    links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
              ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
              WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
    reached AS (SELECT vec_id AS a, vec_id AS b FROM vectors
                UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
    SELECT vec_id, coalesce(n, 0) AS n_links, smallest AS component_id, vec_id = smallest AS kept
    FROM vectors JOIN (SELECT a, min(b) AS smallest FROM reached GROUP BY a) r ON r.a = vec_id
    LEFT JOIN (SELECT a, count(*) AS n FROM links GROUP BY a) l ON l.a = vec_id"""

HOST_RULES = r"""
    WITH texts AS (
        SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
               nullif(regexp_replace(regexp_replace(regexp_replace(lower(trim(source)), '^[a-z][a-z0-9+.-]*://', ''), '[/?#].*$', ''),
                                     '^([^@]*@)?(www\.)?|:[0-9]+$', '', 'g'), '') AS host,
               regexp_extract_all(coalesce(text, ''), '[^ 	-
]+') AS w FROM documents),
    places AS (SELECT r, unnest(range(1, len(w) - 3)) AS i,
                      unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS g FROM texts WHERE len(w) >= 5),
    windows AS (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS times FROM places),
    covered AS (SELECT r, count(DISTINCT p) AS n
                FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM windows WHERE times > 1) GROUP BY r),
    counts AS (
        SELECT r, doc_id, host, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
               CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
               [x FOR x IN string_split(t, chr(10)) IF len(regexp_extract_all(x, '[^ 	-
]+')) > 0] AS lines,
               coalesce(n, 0) AS n_repeat_words
        FROM texts LEFT JOIN covered USING (r)),
    stats AS (SELECT *, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
                     n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
    hosts AS (
        SELECT host, count(*) AS n, sum(CAST(base_failed OR word_chars NOT BETWEEN 3 * n_words AND 10 * n_words
                                             OR 10 * n_symbols > n_words OR 10 * n_dup_lines > 3 * len(lines) AS INT)) AS failed
        FROM stats WHERE host IS NOT NULL GROUP BY host),
    moments AS (SELECT avg(failed / n) AS m, var_pop(failed / n) AS v, avg(1 / n) AS e FROM hosts),
    prior AS (SELECT m, CASE WHEN v > m * (1 - m) * e AND m * (1 - m) > v THEN (m * (1 - m) - v) / (v - m * (1 - m) * e) END AS k
              FROM moments),
    rejected AS (SELECT host FROM hosts, prior WHERE CASE WHEN k IS NULL THEN m ELSE (failed + m * k) / (n + k) END > 0.5)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT base_failed AND (host IS NULL OR host NOT IN (SELECT host FROM rejected)) AS kept
    FROM stats"""

# crc32 of the decimal digits of a whole number, bit by bit
def _crc32(value: str) -> str:
    bits = "CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    step = f"list_reduce(list_concat([xor(a, b)], [CAST(0 AS BIGINT) FOR i IN range(8)]), lambda x, zero: {bits})"
    digits = f"[CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST({value} AS VARCHAR), '')]"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {digits}), lambda a, b: {step}), 4294967295)"


PERIODIC_RUNS = rf"""
    WITH given AS (SELECT doc_id, {_crc32("doc_id")} AS h,
                          regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
    cut AS (SELECT *, len(w) AS n, (h // 10) % greatest(len(w), 1) AS a FROM given),
    planted AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM cut),
    words AS (SELECT doc_id, n, i, CASE WHEN h % 10 = 0 AND i >= a THEN w[1 + a + (i - a) % p] ELSE w[1 + i] END AS word
              FROM (SELECT *, unnest(range(n)) AS i FROM planted)),
    -- a text against itself: places i where the words i and i + q are the same
    alike AS (SELECT x.doc_id, y.i - x.i AS q, x.i AS i FROM words x JOIN words y
              ON x.doc_id = y.doc_id AND x.word = y.word AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
    islands AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM alike),
    spans AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS n FROM islands GROUP BY doc_id, q, island
              HAVING count(*) + q >= greatest(24, 3 * q)),
    runs AS (SELECT * FROM spans x WHERE NOT EXISTS (
        SELECT 1 FROM spans y WHERE y.doc_id = x.doc_id AND y.q < x.q AND y.s <= x.s AND y.s + y.n >= x.s + x.n)),
    best AS (SELECT * FROM runs x WHERE NOT EXISTS (
        SELECT 1 FROM runs y WHERE y.doc_id = x.doc_id AND (y.n * x.q > x.n * y.q
            OR y.n * x.q = x.n * y.q AND (y.s < x.s OR y.s = x.s AND y.q < x.q)))),
    listed AS (SELECT doc_id, count(*) AS n, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS t FROM runs GROUP BY doc_id),
    gone AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs),
    kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS t FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
    SELECT doc_id, coalesce(listed.n, 0) AS n_runs, best.s AS start, best.n AS length, best.q AS period,
           1000 * best.n // best.q AS exponent_milli, sha256(coalesce(listed.t, '')) AS runs_sha256,
           sha256(coalesce(kept.t, '')) AS collapsed_sha256
    FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN listed USING (doc_id) LEFT JOIN kept USING (doc_id)"""

PREFIX_TRIE = f"""
    WITH given AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                          row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i
                   FROM conversations WHERE conv_id IS NOT NULL),
    convs AS (SELECT c, count(*) AS n, {_crc32("c")} % 9 AS h, c - c % 5 AS base FROM given GROUP BY c),
    begun AS (SELECT a.*, least(a.h, coalesce(b.n, 0)) AS taken FROM convs a LEFT JOIN convs b ON b.c = a.base),
    turns AS (SELECT b.c, g.i, role, text FROM begun b JOIN given g ON g.c = b.base AND g.i <= b.taken
              UNION ALL SELECT b.c, g.i - b.h + b.taken, role, text FROM begun b JOIN given g ON g.c = b.c AND g.i > b.h),
    steps AS (SELECT c, i, strlen(text) AS bytes,
                     md5(string_agg(md5(role || chr(1) || text), '') OVER (PARTITION BY c ORDER BY i)) AS k FROM turns
              UNION ALL SELECT c, 0, 0, '' FROM convs),
    linked AS (SELECT *, lag(k) OVER (PARTITION BY c ORDER BY i) AS parent, i = max(i) OVER (PARTITION BY c) AS ending FROM steps),
    nodes AS (SELECT k, any_value(parent) AS parent, min(c) AS conv_id, any_value(i) AS depth, count(*) AS n,
                     (count(*) - 1) * any_value(bytes) AS saved,
                     sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (ending), '')) AS ends_sha256
              FROM linked GROUP BY k),
    children AS (SELECT parent AS k, count(*) AS n FROM nodes GROUP BY parent),
    below AS (SELECT s.k, count(*) FILTER (children.n IS NULL) AS leaves, sum(w.saved) AS saved
              FROM nodes w LEFT JOIN children ON children.k = w.k
              JOIN steps s ON s.c = w.conv_id AND s.i <= w.depth GROUP BY s.k)
    SELECT x.conv_id, CAST(x.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, x.n AS n_convs, coalesce(children.n, 0) AS n_children,
           below.leaves AS n_leaves, CAST(below.saved AS BIGINT) AS saved_tokens, x.ends_sha256
    FROM nodes x LEFT JOIN nodes p ON p.k = x.parent LEFT JOIN children ON children.k = x.k JOIN below ON below.k = x.k"""

# Bytes as pairs of hexadecimal digits, since substrings count characters
SUFFIX_DEDUP = """
    WITH texts AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x,
                          CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n FROM documents),
    windows AS (SELECT r, i, md5_number(substr(x, CAST(2 * i + 1 AS BIGINT), 800)) AS w
                FROM (SELECT r, x, unnest(range(n - 399)) AS i FROM texts WHERE n >= 400)),
    repeated AS (SELECT w FROM windows GROUP BY w HAVING count(*) > 1),
    starts AS (SELECT r, i, i > coalesce(lag(i) OVER (PARTITION BY r ORDER BY i) + 400, -1) AS new
               FROM windows WHERE w IN (SELECT w FROM repeated)),
    numbered AS (SELECT r, i, sum(CAST(new AS INT)) OVER (PARTITION BY r ORDER BY i) AS k FROM starts),
    spans AS (SELECT r, k, min(i) AS a, max(i) + 400 AS b FROM numbered GROUP BY r, k),
    edges AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans),
    pieces AS (SELECT r, before AS a, a AS b FROM edges UNION ALL SELECT r, max(b), NULL FROM spans GROUP BY r),
    kept AS (SELECT r, string_agg(substr(x, 2 * p.a + 1, 2 * (coalesce(p.b, n) - p.a)), '' ORDER BY p.a) AS y
             FROM pieces p JOIN texts USING (r) GROUP BY r),
    counts AS (SELECT r, sum(b - a) AS removed, count(*) AS spans FROM spans GROUP BY r)
    SELECT doc_id, n AS n_bytes, CAST(coalesce(removed, 0) AS BIGINT) AS n_removed, coalesce(spans, 0) AS n_spans,
           sha256(unhex(coalesce(y, x))) AS kept_sha256
    FROM texts LEFT JOIN counts USING (r) LEFT JOIN kept USING (r)"""

NEAR_DUPLICATES = f"""
    WITH RECURSIVE texts AS (SELECT doc_id, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS w FROM documents),
    runs AS (SELECT doc_id, g, count(*) AS c FROM (
        SELECT doc_id, unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(len(w) - 3, 2))]) AS g FROM texts WHERE len(w) > 0)
        GROUP BY ALL),
    held AS (SELECT g, count(*) AS n FROM runs GROUP BY g),
    weighed AS (SELECT doc_id, g, n, c * (1 + ln((SELECT count(*) FROM documents) / greatest(n, 2))) AS v FROM runs JOIN held USING (g)),
    totals AS (SELECT doc_id, sum(v) AS v FROM weighed GROUP BY doc_id),
    shared AS (SELECT a.doc_id AS a, b.doc_id AS b, sum(least(a.v, b.v)) AS v
               FROM weighed a JOIN weighed b ON a.g = b.g AND a.doc_id < b.doc_id WHERE a.n > 1 GROUP BY 1, 2),
    near AS (SELECT s.a, s.b FROM shared s JOIN totals x ON x.doc_id = s.a JOIN totals y ON y.doc_id = s.b
             WHERE s.v >= 0.8 * (x.v + y.v - s.v) * (1 - 1e-12)
             UNION SELECT first, doc_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY t) AS first FROM texts) WHERE first < doc_id),
    links AS (SELECT a, b FROM near UNION ALL SELECT b, a FROM near),
    reached AS (SELECT doc_id AS a, doc_id AS b FROM texts UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
    SELECT a AS doc_id, min(b) AS class_id, a = min(b) AS kept FROM reached GROUP BY a"""

ORACLE = {"op1_suffix_dedup": SUFFIX_DEDUP, "op7_minhash": NEAR_DUPLICATES, "op11_prefix_trie": PREFIX_TRIE, "op12_periodic_runs": PERIODIC_RUNS, "op13_host_rules": HOST_RULES, "op3_decontamination": DECONTAMINATION, "op6_sentence_spans": SENTENCE_SPANS, "op8_hnsw": NEAR_VECTORS}
