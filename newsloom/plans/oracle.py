"""The same queries as SQL, for checking results with another engine."""

from __future__ import annotations

from newsloom.plans.views import BATCH_TIME, LANGUAGES, STOPWORDS, with_views

# Written from the specification, apart from the engine's own constants.
LETTERS = "àáảãạăằắẳẵặâầấẩẫậđèéẻẽẹêềếểễệìíỉĩịòóỏõọôồốổỗộơờớởỡợùúủũụưừứửữựỳýỷỹỵ"
TONES = [
    (old + plain, new_first + new) for first, plain, new_first, news in (
        ("òóỏõọ", "a", "o", "àáảãạ"), ("òóỏõọ", "e", "o", "èéẻẽẹ"), ("ùúủũụ", "y", "u", "ỳýỷỹỵ"),
    ) for old, new in zip(first, news)
]
NOISE = "(?is)<!--.*?-->|<script.*?</script>|<style.*?</style>"
ARTICLE = "(?is)<article[ >].*?</article>"
WIDTHS = {"title": 500, "slug": 500, "link": 500, "guid": 500, "author": 255}
REQUIRED = ("title", "slug", "link", "published_date")

NOW = f"TIMESTAMP '{BATCH_TIME}'"
# White space after the Unicode standard, apart from the engine's own list
SPACE_CODES = (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288)
SPACES = "'[" + "".join(rf"\x{{{c:x}}}" for c in SPACE_CODES) + "]+'"
TRIMMED = " || ".join(f"chr({c})" for c in SPACE_CODES)
ASCII_SPACES = r"'[ \t\n\x0b\f\r]+'"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _listed(words) -> str:
    return "(" + ", ".join(_quoted(w) for w in words) + ")"


def _replaced(expression: str, pairs) -> str:
    for old, new in pairs:
        expression = f"replace({expression}, {_quoted(old)}, {_quoted(new)})"
    return expression


def _norm(title: str) -> str:
    return f"regexp_replace(trim(lower({title}), {TRIMMED}), {SPACES}, ' ', 'g')"


def _tokens(text: str) -> str:
    return f"[t for t in string_split_regex(trim({text}, {TRIMMED}), {SPACES}) if t <> '']"


def _words(text: str) -> str:
    return f"string_split_regex({text}, '[^a-zA-Z0-9_{LETTERS}]+')"


def _keyword(token: str, length: int = 2, stopwords=STOPWORDS) -> str:
    rule = f"length({token}) >= {length} AND NOT starts_with({token}, 'http')"
    return f"{rule} AND {token} NOT IN {_listed(stopwords)}" if stopwords else rule


def _counts(words: str, keyword: str, token: str = "tu_khoa") -> str:
    return f"""
        SELECT ngay, nguon, chu_de, {token} AS tu_khoa, count(*) AS so_lan_xuat_hien
        FROM (SELECT strftime(CAST(publish_date AS DATE), '%Y%m%d') AS ngay, source AS nguon, chu_de,
                     unnest({words}) AS tu_khoa FROM articles)
        WHERE {keyword} GROUP BY ALL"""


FULL = "concat_ws(' ', title, content)"
TRENDING = _counts(_words(f"lower(nfc_normalize({FULL}))"), _keyword("tu_khoa"))


# The entities of the given data and of the views, in the order in which they may be decoded
ENTITIES = (
    ("&#7879;", "ệ"), ("&agrave;", "à"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"),
    ("&nbsp;", "\xa0"), ("&amp;", "&"),
)


def _strip(html: str) -> str:
    bare = f"regexp_replace({html}, '(?s)<!--.*?-->|</?[A-Za-z][^>]*>', '', 'g')"
    return f"coalesce({_replaced(bare, ENTITIES)}, '')"


def _slug(title: str) -> str:
    """Letters lose their marks; the letters that have none to lose are written out."""
    text = _replaced(f"lower({title})", (("&amp;", "&"), ("ß", "ss"), ("æ", "ae"), ("œ", "oe"), ("đ", "d"), ("ø", "o")))
    text = f"translate(strip_accents({text}), '‘’', '')"
    for _ in range(2):
        text = f"regexp_replace({text}, '([0-9]),([0-9])', '\\1\\2', 'g')"
    return f"trim(regexp_replace({text}, '[^a-z0-9]+', '-', 'g'), '-')"


def _cut_slug(slug: str) -> str:
    return f"""CASE WHEN {slug} = '' THEN 'article' WHEN length({slug}) <= 500 THEN {slug}
        WHEN substr({slug}, 501, 1) = '-' THEN substr({slug}, 1, 500)
        ELSE regexp_replace(substr({slug}, 1, 500), '-[^-]*$', '') END"""


def _article(html: str = "html") -> str:
    body = f"regexp_extract(regexp_replace({html}, '{NOISE}', '', 'g'), '{ARTICLE}', 0)"
    for tag in ("nav", "footer", "header"):
        body = f"regexp_replace({body}, '(?is)<{tag}\\b.*?</{tag}\\s*>', '', 'g')"
    return body


PAGE_TEXT = f"trim(regexp_replace({_strip(_article())}, {SPACES}, ' ', 'g'), {TRIMMED})"
# The given pages hold only h1, p, b and br, no attributes and four entities. A
# paragraph left open ends where the next one starts.
CLEAN_BODY = f"""replace(regexp_replace(replace(
    regexp_replace({_article()}, '</?(article|b)>', '', 'g'), '&quot;', '"'), '&amp;?', '&', 'g'), '&', '&amp;')"""
SANITIZED = f"""
    SELECT page_id, trim(regexp_replace(array_to_string(
        [CASE WHEN i = 1 THEN parts[i] WHEN contains(parts[i], '</p>') THEN '<p>' || parts[i]
              ELSE '<p>' || parts[i] || '</p>' END for i in range(1, len(parts) + 1)], ''),
        {SPACES}, ' ', 'g')) AS main_html
    FROM (SELECT page_id, string_split({CLEAN_BODY}, '<p>') AS parts FROM pages)"""

# The lexicon holds pairs only, so leftmost joining takes every second match of a
# row of overlapping matches.
PHRASES = f"""
    WITH lexicon AS (
        SELECT DISTINCT t[i] || ' ' || t[i + 1] AS phrase
        FROM (SELECT t, unnest(range(1, len(t))) AS i FROM (SELECT {_tokens('lower(text)')} AS t FROM benchmark))),
    words AS (SELECT article_id, unnest(range(len(t))) AS i, unnest(t) AS token
              FROM (SELECT article_id, {_tokens('content')} AS t FROM articles)),
    pairs AS (SELECT *, lower(token || ' ' || lead(token) OVER (PARTITION BY article_id ORDER BY i)) AS pair FROM words),
    matches AS (SELECT article_id, i, i - row_number() OVER (PARTITION BY article_id ORDER BY i) AS island
                FROM pairs WHERE pair IN (SELECT phrase FROM lexicon)),
    taken AS (SELECT article_id, i FROM (
        SELECT *, row_number() OVER (PARTITION BY article_id, island ORDER BY i) AS nth FROM matches) WHERE nth % 2 = 1),
    merged AS (SELECT w.article_id, rtrim(string_agg(
                   w.token || CASE WHEN k.i IS NULL THEN ' ' ELSE '_' END, '' ORDER BY w.i), ' ') AS content
               FROM words w LEFT JOIN taken k ON k.article_id = w.article_id AND k.i = w.i GROUP BY 1)
    SELECT article_id, content, CAST(length(content) - length(replace(content, '_', '')) AS INTEGER) AS joined
    FROM merged"""

VALID = "title IS NOT NULL AND link IS NOT NULL AND published_date IS NOT NULL"
KEY = f"feed_source_id, CAST(published_at AS DATE), {_norm('title')}"
FIRST_IDS = f"""SELECT *, min(article_id) OVER (PARTITION BY {KEY}) AS first_id FROM articles"""
STORED_KEYS = f"""SELECT feed_source_id AS f, CAST(published_at AS DATE) AS d, {_norm('title')} AS t,
        min(article_id) AS known FROM articles WHERE article_id IN (SELECT doc_id FROM labels) GROUP BY ALL"""

RECORD = f"""
    SELECT item_id, feed_source_id, title, link, guid, author, published_date, comment_count,
           coalesce(description, '') AS content_html, {_cut_slug('s')} AS slug,
           CASE WHEN length(plain) > 5000 THEN substr(plain, 1, 4997) || '...' ELSE plain END AS description
    FROM (SELECT *, {_slug('title')} AS s, {_strip('description')} AS plain FROM parsed WHERE {VALID})"""

CRAWLED = f"""
    SELECT link, body FROM (
        SELECT i.link, s.main_html AS body FROM ({SANITIZED}) s JOIN items i ON i.item_id = s.page_id)
    WHERE length(trim(body, {TRIMMED})) > 50 AND link IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY link ORDER BY length(body) DESC, body DESC) = 1"""

ITEM_KEY = f"feed_source_id, CAST(published_date AS DATE), {_norm('title')}"


def _cycle(stored: str) -> str:
    """Common table expressions of the ingest cycle against a set of stored items."""
    return f"""WITH stored AS ({stored}),
    fetched AS (SELECT p.*, f.category_id FROM parsed p JOIN feeds f ON f.id = p.feed_source_id
                WHERE f.is_active AND {VALID}),
    by_title AS (SELECT * FROM fetched
                 QUALIFY row_number() OVER (PARTITION BY {ITEM_KEY} ORDER BY item_id) = 1),
    new_title AS (SELECT * FROM by_title WHERE ({ITEM_KEY}) NOT IN (SELECT ({ITEM_KEY}) FROM stored)),
    by_link AS (SELECT * FROM new_title QUALIFY row_number() OVER (PARTITION BY link ORDER BY item_id) = 1),
    new_link AS (SELECT * FROM by_link WHERE link NOT IN (SELECT link FROM stored)),
    by_guid AS (SELECT * FROM new_link
                QUALIFY guid IS NULL OR row_number() OVER (PARTITION BY guid ORDER BY item_id) = 1),
    accepted AS (SELECT * FROM by_guid
                 WHERE guid IS NULL OR guid NOT IN (SELECT guid FROM stored WHERE guid IS NOT NULL)),
    log AS (SELECT f.id AS feed_source_id,
                   CASE WHEN coalesce(g.n, 0) > 0 THEN 'success' ELSE 'failed' END AS status,
                   coalesce(g.n, 0) AS articles_fetched, coalesce(a.n, 0) AS articles_saved,
                   coalesce(g.n, 0) - coalesce(a.n, 0) AS duplicates_found, coalesce(x.n, 0) AS dropped,
                   CASE WHEN coalesce(g.n, 0) = 0 THEN 'Failed to fetch feed' END AS error_message,
                   {NOW} AS completed_at
            FROM feeds f
            LEFT JOIN (SELECT feed_source_id, count(*) AS n FROM fetched GROUP BY 1) g ON g.feed_source_id = f.id
            LEFT JOIN (SELECT feed_source_id, count(*) AS n FROM accepted GROUP BY 1) a ON a.feed_source_id = f.id
            LEFT JOIN (SELECT feed_source_id, count(*) AS n FROM parsed WHERE NOT ({VALID}) GROUP BY 1) x ON x.feed_source_id = f.id
            WHERE f.is_active)"""


def _stored_by(last_id: str) -> str:
    """The articles that a cycle stores, numbered after ``last_id``."""
    return f"""
        , records AS ({RECORD}), crawled AS ({CRAWLED})
        SELECT {last_id} + row_number() OVER (ORDER BY r.item_id) AS id,
               r.* EXCLUDE (item_id, content_html), a.category_id,
               coalesce(c.body, r.content_html) AS content_html, {NOW} AS fetched_date,
               false AS is_duplicate, CAST(NULL AS BIGINT) AS duplicate_of_id,
               {NOW} AS created_at, {NOW} AS updated_at
        FROM records r JOIN accepted a ON a.item_id = r.item_id LEFT JOIN crawled c ON c.link = r.link"""


CYCLE = _cycle(f"SELECT * FROM parsed WHERE {VALID} AND item_id IN (SELECT doc_id FROM labels)")
FIRST_CYCLE = _cycle("SELECT * FROM parsed WHERE false")


def _first_of_two(table: str) -> str:
    """A table of the cycle over the labelled items alone."""
    return f"""(WITH parsed AS (SELECT * FROM labelled),
        {_cycle("SELECT * FROM labelled WHERE false")[5:]} SELECT * FROM {table})"""


TWO_CYCLES = f"""
    WITH labelled AS (SELECT * FROM parsed WHERE item_id IN (SELECT doc_id FROM labels)),
    one AS {_first_of_two("accepted")}, one_log AS {_first_of_two("log")},
    {_cycle("SELECT * FROM one")[5:]},
    saved AS (SELECT feed_source_id, count(*) AS n_stored, max(id) AS last_id FROM (
        SELECT feed_source_id, row_number() OVER (ORDER BY item_id) AS id FROM one
        UNION ALL SELECT feed_source_id, (SELECT count(*) FROM one) + row_number() OVER (ORDER BY item_id) FROM accepted)
        GROUP BY 1)
    SELECT CAST(cycle_id AS BIGINT) AS cycle_id, feed_source_id, articles_fetched, articles_saved, duplicates_found, dropped,
           n_stored, last_id
    FROM (SELECT 0 AS cycle_id, * FROM one_log UNION ALL SELECT 1, * FROM log) LEFT JOIN saved USING (feed_source_id)"""


def _logs(body: str) -> str:
    return with_views(body, "logs")


def _articles(body: str) -> str:
    return with_views(body, "articles")


def _cycled(body: str, cycle: str = CYCLE) -> str:
    return with_views(f"{cycle}{body}", "parsed", "feeds")


def _over_trending(body: str) -> str:
    return _articles(f"WITH trending AS ({TRENDING})\n{body}")


# Written from the definition of each class, apart from the engine's own code.
_DAY = "(0?[1-9]|[12][0-9]|3[01])"
_PART = r"[\p{L}\p{Nd}]+"
TOKEN_PATTERNS = {
    "email": r"[^@]+@[^.@][^@]*\.[^.@]+",
    "markup": "(?s)<.*>",
    "date": "|".join(f"{_DAY}{s}{_DAY}{s}([0-9]{{2}}|[0-9]{{4}})|[0-9]{{4}}{s}{_DAY}{s}{_DAY}" for s in ("-", "/", r"\.")),
    "time": "([01]?[0-9]|2[0-3]):[0-5][0-9](:[0-5][0-9])?",
    "percent": r"\p{Nd}+([.,]\p{Nd}+)?%",
    "number": r"[-+]?\p{Nd}+([.,]\p{Nd}+)*",
    "punctuation": r"(?s)[^\p{L}\p{Nd}]*",
    "code": rf"{_PART}",
    "compound": rf"{_PART}([-_./']{_PART})+",
    "allcaps": r"\p{Lu}{2,}", "name": r"\p{Lu}[^\p{Lu}]*", "word": r"[^\p{Lu}]+",
}


def _token_case(name: str, pattern: str) -> str:
    case = f"regexp_full_match(token, {_quoted(pattern)})"
    if name == "code":
        case += r" AND regexp_matches(token, '\p{Nd}') AND regexp_matches(token, '\p{L}')"
    if name in ("name", "word"):
        case += r" AND regexp_full_match(token, '\p{L}+')"
    return f"WHEN {case} THEN '{name}'"


TOKEN_CASES = " ".join(_token_case(*item) for item in TOKEN_PATTERNS.items())
VIOLATIONS = ", ".join(
    [f"CASE WHEN length({n}) > {w} THEN '{n}:length' END" for n, w in WIDTHS.items()]
    + [f"CASE WHEN {n} IS NULL THEN '{n}:null' END" for n in REQUIRED]
)

ORACLE: dict[str, str] = {
    # Keyword counting
    "trending_words": _articles(TRENDING),
    "trending_words_compat": _articles(_counts(
        _words(FULL), _keyword("lower(tu_khoa)", stopwords=()), "lower(tu_khoa)"
    )),
    "trending_sorted": _articles(TRENDING),
    "trending_tokens_raw": _articles(f"""
        SELECT publish_date AS ngay, source AS nguon, chu_de, trim(replace(token, '_', ' ')) AS tu_khoa,
               count(*) AS so_lan_xuat_hien
        FROM (SELECT *, unnest(string_split_regex(content, {ASCII_SPACES})) AS token FROM articles)
        WHERE token <> '' GROUP BY ALL"""),
    "project_articles": _articles("""
        SELECT strftime(CAST(publish_date AS DATE), '%Y%m%d') AS ngay, source AS nguon, chu_de, title, content
        FROM articles"""),
    "category_label": _articles(
        "SELECT article_id, CASE category "
        + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in LANGUAGES.items()) + " END AS chu_de FROM articles"
    ),
    "union_categories": """
        SELECT source, text AS content, 'Documents' AS chu_de FROM documents
        UNION ALL SELECT NULL, text, 'Benchmark' FROM benchmark
        UNION ALL SELECT role, text, 'Conversations' FROM conversations""",
    "nonempty_content": _articles("""
        SELECT article_id, coalesce(source, '') AS source, coalesce(content, '') AS content
        FROM articles WHERE coalesce(content, '') <> ''"""),
    "clean_text": _articles(f"""
        SELECT article_id, regexp_replace(lower(nfc_normalize({FULL})), '[^a-zA-Z0-9_{LETTERS}\\s]', ' ', 'g') AS full_text
        FROM articles"""),
    "tokenize": _articles(f"""
        SELECT article_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens
        FROM (SELECT article_id, {_tokens('content')} AS t FROM articles)"""),
    "extract_keywords": _articles(f"""
        SELECT article_id, CAST(len(k) AS INTEGER) AS n_keywords, array_to_string(k, ' ') AS keywords
        FROM (SELECT article_id, [t for t in {_words('lower(nfc_normalize(content))')} if {_keyword('t', 3)}] AS k
              FROM articles)"""),
    "explode_tokens": _articles(f"""
        SELECT article_id, CAST(unnest(range(len(t))) AS INTEGER) AS position, unnest(t) AS token
        FROM (SELECT article_id, {_tokens('content')} AS t FROM articles)"""),
    "stopword_filter": _over_trending("""
        SELECT chu_de, tu_khoa, CAST(sum(so_lan_xuat_hien) AS BIGINT) AS occurrences
        FROM trending GROUP BY 1, 2"""),
    "token_class": _articles(f"""
        SELECT CASE {TOKEN_CASES} ELSE 'other' END AS token_class,
               CAST(sum(n) AS BIGINT) AS occurrences, count(*) AS distinct_tokens
        FROM (SELECT token, count(*) AS n
              FROM (SELECT unnest({_tokens('content')}) AS token FROM articles) GROUP BY 1)
        GROUP BY 1"""),
    "normalize_tone": _articles(f"SELECT article_id, {_replaced('content', TONES)} AS content FROM articles"),
    "merge_phrases": _articles(PHRASES),
    # Serving
    "keywords_per_category": _over_trending("SELECT chu_de, count(*) AS so_luong_tu_khoa FROM trending GROUP BY 1"),
    "top10_keywords": _over_trending("""
        SELECT * FROM trending ORDER BY so_lan_xuat_hien DESC, ngay, nguon, chu_de, tu_khoa LIMIT 10"""),
    "top20_keywords": _over_trending("""
        SELECT tu_khoa, CAST(sum(so_lan_xuat_hien) AS BIGINT) AS tong FROM trending
        GROUP BY 1 ORDER BY tong DESC, tu_khoa LIMIT 20"""),
    "category_keywords": _over_trending("""
        SELECT chu_de, tu_khoa, CAST(sum(so_lan_xuat_hien) AS BIGINT) AS tong FROM trending
        GROUP BY 1, 2 ORDER BY chu_de, tong DESC, tu_khoa"""),
    "row_counts": _over_trending("""
        SELECT 'articles' AS relation, count(*) AS n FROM articles
        UNION ALL SELECT 'trending', count(*) FROM trending
        UNION ALL SELECT 'logs', count(*) FROM events"""),
    "logs_filtered": _logs("SELECT * FROM logs WHERE status = 'failed'"),
    "logs_page": _logs("""
        SELECT *, (SELECT count(*) FROM logs WHERE status = 'failed') AS total FROM logs
        WHERE status = 'failed' ORDER BY started_at DESC, log_id DESC LIMIT 50 OFFSET 100"""),
    "logs_deep_page": _logs("""
        SELECT *, (SELECT count(*) FROM logs WHERE status = 'failed') AS total FROM logs
        WHERE status = 'failed' ORDER BY started_at DESC, log_id DESC
        LIMIT 50 OFFSET (SELECT 2 * count(*) // 3 FROM logs WHERE status = 'failed')"""),
    "latest_log": _logs("SELECT * FROM logs ORDER BY started_at DESC, log_id DESC LIMIT 1"),
    "logs_with_feeds": with_views("""
        SELECT l.log_id, l.feed_source_id, l.status, f.name AS feed_name
        FROM logs l LEFT JOIN (SELECT * FROM feeds WHERE is_active) f ON f.id = l.feed_source_id""", "logs", "feeds"),
    "log_defaults": _logs(f"""
        SELECT log_id, status, articles_fetched, CAST(0 AS BIGINT) AS articles_saved,
               CAST(0 AS BIGINT) AS duplicates_found, {NOW} AS started_at FROM logs"""),
    "log_duration": _logs("""
        SELECT log_id, (epoch_us(completed_at) - epoch_us(started_at)) // 1000 AS execution_time_ms FROM logs"""),
    "list_feeds": with_views("SELECT * FROM feeds", "feeds"),
    "active_feeds": with_views("SELECT * FROM feeds WHERE is_active", "feeds"),
    "feed_category_join": with_views("""
        SELECT f.id, f.name, f.url, c.id AS category_id FROM feeds f JOIN categories s ON s.id = f.category_id
        JOIN categories c ON c.slug = s.slug""", "feeds", "categories"),
    "articles_enriched": with_views("""
        SELECT a.article_id, a.title, a.feed_source_id, f.name AS feed_name, f.category_id, c.name AS category_name
        FROM articles a JOIN feeds f ON f.id = a.feed_source_id JOIN categories c ON c.id = f.category_id""",
        "articles", "feeds", "categories"),
    # Item functions
    "format_day": with_views("SELECT item_id, strftime(iso, '%Y%m%d') AS ngay FROM dated", "dated"),
    "drop_undated": with_views(
        "SELECT item_id, strftime(iso, '%Y%m%d') AS ngay FROM dated WHERE iso IS NOT NULL", "dated"),
    "parse_rfc2822": with_views("SELECT item_id, rfc AS published FROM dated", "dated"),
    "parse_iso": with_views("SELECT item_id, iso AS published FROM dated", "dated"),
    "parse_date": with_views("SELECT item_id, coalesce(rfc, iso) AS published FROM dated", "dated"),
    "comment_count": with_views("SELECT item_id, comment_count FROM parsed", "parsed"),
    "normalize_title": with_views(f"SELECT item_id, {_norm('title')} AS normalized FROM items", "items"),
    "truncate_text": _articles("""
        SELECT article_id, CASE WHEN length(content) > 5000 THEN substr(content, 1, 4997) || '...'
                                ELSE content END AS content FROM articles"""),
    "create_slug": _articles(f"""
        SELECT article_id, CASE WHEN title = '' THEN '' ELSE {_cut_slug('s')} END AS slug
        FROM (SELECT article_id, title, {_slug('title')} AS s FROM articles)"""),
    "link_tail": with_views(
        "SELECT item_id, substr(string_split(link, '/')[-1], 1, 500) AS tail FROM items", "items"),
    "strip_html": with_views(f"SELECT item_id, {_strip('description')} AS plain FROM items", "items"),
    "valid_items": with_views(f"SELECT * FROM parsed WHERE {VALID} AND description IS NOT NULL", "parsed"),
    "quarantine_items": with_views("""
        SELECT item_id, reason FROM (
            SELECT item_id, CASE WHEN title IS NULL THEN 'missing title' WHEN link IS NULL THEN 'missing link'
                                 WHEN published_date IS NULL THEN 'bad date'
                                 WHEN description IS NULL THEN 'missing description' END AS reason FROM parsed)
        WHERE reason IS NOT NULL""", "parsed"),
    "process_articles": with_views(RECORD, "parsed"),
    "apply_defaults": with_views(f"""
        SELECT item_id, title, coalesce(TRY_CAST(comments AS INTEGER), 0) AS comment_count,
               {NOW} AS fetched_date, false AS is_duplicate, CAST(NULL AS BIGINT) AS duplicate_of_id,
               {NOW} AS created_at, {NOW} AS updated_at FROM items""", "items"),
    "constraint_check": with_views(f"""
        SELECT item_id, violations FROM (
            SELECT item_id, concat_ws(',', {VIOLATIONS}) AS violations
            FROM (SELECT *, {_cut_slug('s')} AS slug FROM (SELECT *, {_slug('title')} AS s FROM parsed)))
        WHERE violations <> ''""", "parsed"),
    "result_check": _over_trending("""
        SELECT tu_khoa, concat_ws(',', CASE WHEN length(ngay) > 8 THEN 'ngay:length' END,
            CASE WHEN length(nguon) > 100 THEN 'nguon:length' END, CASE WHEN length(chu_de) > 100 THEN 'chu_de:length' END,
            CASE WHEN length(tu_khoa) > 255 THEN 'tu_khoa:length' END, CASE WHEN ngay IS NULL THEN 'ngay:null' END,
            CASE WHEN nguon IS NULL THEN 'nguon:null' END, CASE WHEN chu_de IS NULL THEN 'chu_de:null' END) AS violations
        FROM trending WHERE length(ngay) > 8 OR length(nguon) > 100 OR length(chu_de) > 100 OR length(tu_khoa) > 255
            OR ngay IS NULL OR nguon IS NULL OR chu_de IS NULL"""),
    "assign_ids": _articles("""
        SELECT (SELECT max(doc_id) FROM labels) + row_number() OVER (ORDER BY published_at, article_id) AS id,
               article_id, published_at FROM articles"""),
    # Duplicates
    "dedup_first_wins": _articles(f"SELECT * EXCLUDE first_id FROM ({FIRST_IDS}) WHERE article_id = first_id"),
    "dedup_by_link": with_views("""
        WITH linked AS (SELECT * FROM items
            QUALIFY link IS NULL OR row_number() OVER (PARTITION BY link ORDER BY item_id) = 1)
        SELECT item_id, link, guid, title FROM linked
        QUALIFY guid IS NULL OR row_number() OVER (PARTITION BY guid ORDER BY item_id) = 1""", "items"),
    "mark_duplicates": _articles(f"""
        SELECT article_id, article_id > first_id AS is_duplicate,
               CASE WHEN article_id > first_id THEN first_id END AS duplicate_of_id FROM ({FIRST_IDS})"""),
    "duplicate_pairs": _articles(f"""
        WITH marked AS ({FIRST_IDS})
        SELECT d.article_id, d.title, d.published_at, d.first_id AS duplicate_of_id,
               o.title AS original_title, o.published_at AS original_published_at
        FROM marked d JOIN articles o ON o.article_id = d.first_id WHERE d.article_id > d.first_id"""),
    "duplicate_of": _articles(f"""
        WITH known AS ({STORED_KEYS})
        SELECT article_id AS item_id, known IS NOT NULL AS is_duplicate, known AS duplicate_id
        FROM articles LEFT JOIN known
          ON f = feed_source_id AND d = CAST(published_at AS DATE) AND t = {_norm('title')}"""),
    "dedup_new_items": _articles(f"""
        WITH known AS ({STORED_KEYS}), firsts AS ({FIRST_IDS})
        SELECT article_id AS item_id, feed_source_id, published_at, title FROM firsts
        WHERE article_id = first_id AND NOT EXISTS (
            SELECT 1 FROM known WHERE f = feed_source_id AND d = CAST(published_at AS DATE)
                                  AND t = {_norm('title')})"""),
    "same_day_candidates": _articles("""
        SELECT s.article_id, s.feed_source_id, s.published_at, s.title FROM articles s
        WHERE s.article_id IN (SELECT doc_id FROM labels) AND EXISTS (
            SELECT 1 FROM articles i WHERE i.article_id NOT IN (SELECT doc_id FROM labels)
               AND i.feed_source_id = s.feed_source_id AND i.published_at >= date_trunc('day', s.published_at)
               AND i.published_at < date_trunc('day', s.published_at) + INTERVAL 1 DAY)"""),
    # Ingest cycle
    "content_fallback": with_views(f"""
        WITH records AS ({RECORD}), crawled AS ({CRAWLED})
        SELECT item_id, r.link, coalesce(body, content_html) AS content_html
        FROM records r LEFT JOIN crawled c ON c.link = r.link""", "parsed"),
    "ingest_articles": _cycled(_stored_by("(SELECT max(item_id) FROM stored)")),
    "ingest_over_history": with_views(TWO_CYCLES, "parsed", "feeds"),
    "ingestion_log": _cycled("SELECT * FROM log"),
    "ingestion_totals": _cycled("""
        SELECT CAST(sum(articles_fetched) AS BIGINT) AS total_fetched,
               CAST(sum(articles_saved) AS BIGINT) AS total_saved,
               CAST(sum(duplicates_found) AS BIGINT) AS total_found, CAST(sum(dropped) AS BIGINT) AS total_dropped FROM log"""),
    "feed_status": _cycled("SELECT feed_source_id, status FROM log"),
    "feed_last_fetched": _cycled(f"""
        SELECT f.* REPLACE (CASE WHEN l.status = 'success' THEN {NOW} ELSE f.last_fetched_at END AS last_fetched_at)
        FROM feeds f LEFT JOIN log l ON l.feed_source_id = f.id"""),
    # Pages
    "scan_pages": "SELECT page_id, url, html FROM pages",
    "page_main": f"SELECT page_id, {_article()} AS main_html FROM pages",
    "page_sanitized": SANITIZED,
    "page_text": f"SELECT page_id, {PAGE_TEXT} AS page_text FROM pages",
    "substantial_pages": f"""
        SELECT page_id, CAST(length(page_text) AS INTEGER) AS n_chars
        FROM (SELECT page_id, {PAGE_TEXT} AS page_text FROM pages) WHERE length(page_text) > 50""",
    "page_links": f"""
        SELECT page_id, CAST(unnest(range(len(hrefs))) AS INTEGER) AS position,
               regexp_extract(url, '^[a-z]+://[^/?#]*') || unnest(hrefs) AS link
        FROM (SELECT *, regexp_extract_all(regexp_replace(html, '{NOISE}', '', 'g'),
                                           '<a href="([^"]*)"', 1) AS hrefs FROM pages)""",
    # Sources and sinks
    "landed_articles": _articles("""
        SELECT publish_date, source, title, content, CASE WHEN chu_de = 'fr' THEN '_unknown' ELSE chu_de END AS chu_de
        FROM articles"""),
    "json_arrays": _articles("""
        SELECT CAST(article_id AS VARCHAR) AS id, title, content, source, category, publish_date, category AS chu_de FROM articles"""),
    "serving_table": _over_trending(f"""
        SELECT ngay, nguon, chu_de, tu_khoa, CAST(so_lan_xuat_hien AS INTEGER) AS so_lan_xuat_hien, {NOW} AS created_at FROM trending"""),
    "feed_files": with_views("""
        SELECT DISTINCT feed_source_id, title, link, guid, author, published_date FROM (
            SELECT p.*, i.pub_date FROM parsed p JOIN items i ON i.item_id = p.item_id)""", "parsed", "items"),
    "result_files": _articles(TRENDING),
    "seeded_categories": with_views("SELECT * FROM categories", "categories"),
    "word_list": f"SELECT DISTINCT unnest({_tokens('lower(text)')}) AS word FROM benchmark",
    "lexicon_file": f"""
        SELECT word, 'n' || length(word) AS kind FROM (SELECT DISTINCT unnest({_tokens('lower(text)')}) AS word FROM benchmark)""",
    # Streams: the end state equals the batch query
    "stream_ingest": with_views("SELECT * FROM parsed", "parsed"),
    "stream_dedup": _articles(f"SELECT * EXCLUDE first_id FROM ({FIRST_IDS}) WHERE article_id = first_id"),
    "stream_ingest_cycle": _cycled(_stored_by("0"), FIRST_CYCLE),
    "stream_ingest_log": _cycled("SELECT *, 0 AS batch_id FROM log", FIRST_CYCLE),
    "stream_feed_files": with_views(f"""
        WITH landed AS (SELECT DISTINCT i.item_id % 3 AS cycle_id, i.feed_source_id, i.title, i.link, i.guid, i.author, i.pub_date,
                               p.title IS NOT NULL AND p.link IS NOT NULL AND p.published_date IS NOT NULL AS valid
                        FROM items i JOIN parsed p ON p.item_id = i.item_id JOIN feeds f ON f.id = i.feed_source_id WHERE is_active)
        SELECT cycle_id, feed_source_id, count(*) FILTER (valid) AS articles_fetched, count(*) FILTER (NOT valid) AS dropped,
               CAST(feed_source_id = 1 AS BIGINT) AS rejected
        FROM landed GROUP BY 1, 2 HAVING count(*) FILTER (valid) > 0""", "parsed", "items", "feeds"),
    "stream_trending": _articles(TRENDING),
}
