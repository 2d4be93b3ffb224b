"""What the queries must give, as SQL over the same tables for another engine."""

from __future__ import annotations

# Whitespace of Unicode, in RE2; letters of the case boundary; texts that stand for NULL.
_WS = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_LOWER = "a-zàáạảãâăêôơưéèẻẽẹđỳỳỷỹ"
_UPPER = "A-ZÀÁẠẢÃÂĂÊÔƠƯÉÈẺẼẸĐỲỶỸ"
_NULL_TOKENS = (
    "'', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', '1.#QNAN', "
    "'<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null'"
)
# End of fixed values.


def _sub(expr: str, pattern: str, put: str, flags: str = "g") -> str:
    quoted = pattern.replace("'", "''")
    return f"regexp_replace({expr}, '{quoted}', '{put}', '{flags}')"


def _spaces(expr: str) -> str:
    return f"trim({_sub(expr, f'[{_WS}]+', ' ')})"


def _tidy(expr: str) -> str:
    cut = _sub(_sub(_sub(expr, f"[{_WS}]+", " "), rf"^[{_WS}.:;,\-]+", ""), rf"[{_WS}.:;,\-]+$", "")
    return (f"(SELECT CASE WHEN x = '' OR right(x, 1) IN ('.', '?', '!') THEN x ELSE x || '.' END "
            f"FROM (SELECT {cut} AS x))")


def _tokens(expr: str) -> str:
    # Points and commas between digits are put out of the way as letters of the private area.
    for mark, letter in ((r"\.", "\ue000"), (",", "\ue001")):
        for _ in range(2):
            expr = _sub(expr, f"([0-9]){mark}([0-9])", rf"\1{letter}\2")
    token = "|".join([
        rf"[A-Za-z][A-Za-z0-9+.\-]*://[^{_WS}]+",
        "[A-Za-z0-9_][A-Za-z0-9_.+\\-\ue000]*@[A-Za-z0-9\\-]+(?:[.\ue000][A-Za-z0-9\\-]+)+",
        r"\.\.\.", "[\\p{L}\\p{M}\\p{N}_\ue000\ue001]+",
        rf"[^\p{{L}}\p{{M}}\p{{N}}_{_WS}]",
    ])
    joined = f"translate(array_to_string(regexp_extract_all({expr}, '{token}'), ' '), '_\ue000\ue001', ' .,')"
    return _spaces(joined)


def _case(expr: str) -> str:
    return _sub(expr, f"([{_LOWER}])([{_UPPER}])", r"\1 \2")


def _clean_plain(expr: str) -> str:
    return _spaces(_case(_tokens(_tidy(expr))))


def _entities(expr: str) -> str:
    for name, char in (("quot", '"'), ("copy", "©"), ("middot", "·"), ("amp", "&")):
        expr = _sub(_sub(expr, f"&{name};", char), f"&{name}([^A-Za-z0-9]|$)", rf"{char}\1")
    return expr


def _untag(expr: str, put: str = " ") -> str:
    return _sub(_sub(expr, r"""</?[A-Za-z](?:[^>"']|"[^"]*"|'[^']*')*>""", put), r"</?[A-Za-z][^>]*>", put)


def _html_text(expr: str) -> str:
    expr = _sub(_sub(expr, r"<!--.*?(?:-->|\z)", " ", "gs"), "<[!?][^>]*>", " ")
    for name in ("script", "style"):
        expr = _sub(expr, rf"<{name}\b[^>]*>.*?(?:</{name}\s*>|\z)", " ", "gsi")
    for name in ("iframe", "video", "button", "noscript"):
        expr = _sub(expr, rf"<{name}\b[^>]*>.*?</{name}\s*>", " ", "gsi")
    return _entities(_untag(expr))


def _inside(expr: str, tag: str, cls: str = "") -> str:
    of_class = f' class="{cls}"' if cls else r"\b[^>]*"
    return f"regexp_extract_all({expr}, '<{tag}{of_class}>(.*?)</{tag}\\s*>', 1, 'si')"


def _fields(html: str) -> str:
    """Article fields by the depth of tags: an element ends at its own end tag, or where one around it ends."""
    trimmed = _sub(_entities("tok"), f"^[{_WS}]+|[{_WS}]+$", "")
    tree = _sub(html, r"<!--.*?(?:-->|\z)|<script\b.*?</script>|<style\b.*?</style>", "<!x>", "gs")
    own = {"published_at": "name = 'footer'", "summary": "name = 'div' AND list_contains(cls, 'ad')",
           "author": "name = 'span' AND list_contains(cls, 'author')"}
    nested = {"title": ("article", "h1"), "content": ("article", "p"), "tags": ("nav", "a")}
    elements = " UNION ALL ".join(
        [f"SELECT page_id, '{f}' AS field, start, stop FROM spans WHERE {fits}" for f, fits in own.items()]
        + [f"""SELECT DISTINCT i.page_id, '{f}', i.start, i.stop FROM spans i JOIN spans o USING (page_id)
               WHERE o.name = '{outer}' AND i.name = '{inner}' AND i.start > o.start AND i.start < o.stop"""
           for f, (outer, inner) in nested.items()])
    columns = ", ".join(f"coalesce(max(text) FILTER (field = '{f}'), 'N/A') AS {f}_raw" for f in [*own, *nested])
    return f"""
        WITH texts AS (SELECT page_id, url, {html} AS html FROM pages WHERE html IS NOT NULL),
        listed AS (SELECT page_id, regexp_extract_all({tree.replace(html, 'html', 1)}, '<[^>]*>|[^<]+') AS toks FROM texts),
        tokens AS (SELECT page_id, unnest(toks) AS tok, unnest(range(len(toks))) AS pos FROM listed),
        tags AS (
            SELECT *, sum(step) OVER (PARTITION BY page_id, name ORDER BY pos) AS depth
            FROM (SELECT page_id, pos, lower(regexp_extract(tok, '^</?([A-Za-z][A-Za-z0-9]*)', 1)) AS name,
                         CASE WHEN tok LIKE '</%' THEN -1 ELSE 1 END AS step,
                         string_split(regexp_extract(tok, '(?i)\\sclass=["'']([^"'']*)', 1), ' ') AS cls
                  FROM tokens WHERE tok LIKE '<%')
            WHERE name NOT IN ('', 'br', 'meta')),
        closed AS (
            SELECT s.page_id, s.name, any_value(s.cls) AS cls, s.pos AS start, coalesce(min(e.pos), 1000000000) AS stop
            FROM tags s LEFT JOIN tags e
              ON e.page_id = s.page_id AND e.name = s.name AND e.step = -1 AND e.depth = s.depth - 1 AND e.pos > s.pos
            WHERE s.step = 1 GROUP BY s.page_id, s.name, s.pos),
        spans AS (
            SELECT i.page_id, i.name, any_value(i.cls) AS cls, i.start, least(i.stop, coalesce(min(o.stop), 1000000000)) AS stop
            FROM closed i LEFT JOIN closed o ON o.page_id = i.page_id AND o.start < i.start AND i.start < o.stop
            GROUP BY i.page_id, i.name, i.start, i.stop),
        elements AS ({elements}),
        said AS (
            SELECT e.page_id, field, start, coalesce(string_agg({trimmed}, '' ORDER BY pos), '') AS text
            FROM elements e LEFT JOIN tokens t
              ON t.page_id = e.page_id AND t.pos > e.start AND t.pos < e.stop AND t.tok NOT LIKE '<%'
            GROUP BY e.page_id, field, start),
        joined AS (
            SELECT page_id, field, CASE WHEN field = 'tags' THEN string_agg(text, ', ' ORDER BY start)
                                        ELSE string_agg(text, chr(10) ORDER BY start) END AS text
            FROM said GROUP BY page_id, field)
        SELECT any_value(url) AS article_url, any_value({_SITE}) AS source_name_raw, any_value({_ROOT}) AS category_raw,
               {columns}, '2024-01-01 06:00:00' AS scraped_at, 'run-1' AS run_id
        FROM texts LEFT JOIN joined USING (page_id) GROUP BY page_id"""


def _crc32(expr: str) -> str:
    return f"""xor(list_reduce(
      list_prepend(4294967295::BIGINT,
        list_transform(range(0, octet_length(encode({expr}))),
          lambda i: ('0x' || substr(hex(encode({expr})), i * 2 + 1, 2))::BIGINT)),
      lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
          lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
      4294967295::BIGINT)"""


_COUNTS = """
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS article_year, CAST(month(o.o_orderdate) AS INTEGER) AS article_month,
       o.o_orderpriority AS category_name, w.tag AS tag_name, c.c_nationkey AS source_key,
       count(DISTINCT o.o_orderkey) AS total_articles
FROM lineitem l
JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part) w ON w.p_partkey = l.l_partkey
GROUP BY ALL"""

_DATE_TEXT = """CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
    WHEN 'O' THEN strftime(o_orderdate, '%d/%m/%Y %H:%M') ELSE 'N/A' END"""
_DATED = "(CASE WHEN o_orderstatus = 'F' THEN date_trunc('second', o_orderdate) WHEN o_orderstatus = 'O' THEN date_trunc('minute', o_orderdate) END)"

_RAISED = "CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END"

_SITE = r"regexp_extract(url, '^[a-z]+://[^/]*\.([a-z]+)/', 1)"
_ROOT = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"


def _absolute(href: str, base: str) -> str:
    return (f"CASE WHEN starts_with({href}, 'http') THEN {href} WHEN starts_with({href}, '//') THEN 'https:' || {href} "
            f"WHEN starts_with({href}, '/') THEN {base} || {href} ELSE {base} || '/' || {href} END")


_LINKS = f"""
SELECT page_id, {_SITE} AS source_name, {_ROOT} AS base_url,
       unnest(hrefs) AS href, unnest(range(len(hrefs))) AS pos
FROM (SELECT page_id, url, regexp_extract_all(html, '<a\\b[^>]*?\\shref="([^"]*)"', 1, 'si') AS hrefs FROM pages)"""

_JOBS = """
SELECT s.s_suppkey AS config_id, 'src' || s.s_nationkey AS source_name,
       'https://s' || s.s_suppkey || '.example.com' AS base_url,
       l.l_returnflag AS category_name, '/' || l.l_returnflag AS category_url
FROM supplier s JOIN (SELECT DISTINCT l_suppkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O') l
  ON l.l_suppkey = s.s_suppkey
WHERE s.s_acctbal > 0"""

_SELECTORS = "SELECT 'src' || n_nationkey AS source_name, n_name AS selector FROM nation WHERE n_regionkey <> 0"

_STAGED = """
SELECT 'doc/' || lpad(CAST(doc_id AS VARCHAR), 12, '0') || CASE WHEN blank THEN '/blank' ELSE '' END AS article_url, source AS source_name,
       CASE WHEN lang = 'es' THEN '' ELSE lang END AS category, '' AS author,
       '2024-01-01 06:00:00' AS published_at, 'no. ' || doc_id AS title, 'N/A' AS summary,
       CASE WHEN blank THEN '' ELSE text END AS content,
       '2024-01-01 06:00:00' AS scraped_at, 'run-1' AS run_id, '' AS tags
FROM (SELECT *, false AS blank FROM documents
      UNION ALL SELECT *, true FROM documents WHERE source IN ('src3', 'src7'))"""

def _mark(prefix: str, key: str) -> str:
    return f"('0x' || substr(md5('{prefix}' || {key}), 1, 15))::BIGINT AS address_mark"


_PART_ID = f"p_partkey % 500 AS article_key, {_mark('part/', 'p_partkey')}"
_ID = "article_key, address_mark"

_WORDS = "SELECT p_partkey, p_size, p_brand, p_type, string_split(p_name, ' ') AS words FROM part"
_DIM_TAG = """
SELECT w AS tag_name, row_number() OVER (ORDER BY w) AS tag_key
FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS w FROM part) WHERE w NOT LIKE 'r%'"""
_PART_LISTS = f"""
SELECT {_PART_ID}, 1 AS n,
       CASE WHEN p_brand = 'Brand#5' THEN [' never seen', ''] ELSE string_split(replace(p_name, ' ', ', '), ',') END AS names
FROM part WHERE p_type NOT IN ('SMALL', 'ECONOMY')
UNION ALL
SELECT {_PART_ID}, 2, [split_part(p_name, ' ', 1)] FROM part WHERE p_size > 40"""
_OLD_BRIDGE = f"""
SELECT DISTINCT {_PART_ID}, tag_key
FROM (SELECT p_partkey, unnest(CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN [words[len(words)]] ELSE words END) AS tag_name
      FROM ({_WORDS}) WHERE p_size <= 45)
JOIN ({_DIM_TAG}) USING (tag_name)"""
_TAG_SYNC = f"""
WITH dim AS ({_DIM_TAG}), bridge AS ({_OLD_BRIDGE}),
lists AS ({_PART_LISTS}),
sets AS (
  SELECT {_ID}, l.n, coalesce(list_sort(list_distinct(list(d.tag_key) FILTER (d.tag_key IS NOT NULL))), []) AS new_keys
  FROM (SELECT {_ID}, n, trim(unnest(names)) AS tag_name FROM lists) l LEFT JOIN dim d USING (tag_name)
  GROUP BY {_ID}, l.n),
held AS (SELECT {_ID}, list_sort(list(tag_key)) AS old_keys FROM bridge GROUP BY {_ID}),
compared AS (
  SELECT {_ID}, s.new_keys, s.new_keys <> coalesce(h.old_keys, []) AS changed
  FROM sets s LEFT JOIN held h USING ({_ID}))"""

_CALENDAR = """
SELECT CAST(date_diff('day', DATE '2005-01-01', d) + 1 AS INTEGER) AS date_key, d AS full_date,
       dayname(d) AS day_of_week, monthname(d) AS month_name, CAST(year(d) AS INTEGER) AS year,
       CAST(day(d) AS INTEGER) AS day_of_month, 'Non-Holiday' AS holiday,
       CASE WHEN isodow(d) >= 6 THEN 'Weekend' ELSE 'Weekday' END AS day_type
FROM (SELECT CAST(unnest(generate_series(CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE), INTERVAL 1 DAY)) AS DATE) AS d
      FROM orders)"""

_NUMBERED = "SELECT {name}, row_number() OVER (ORDER BY {name}) AS {key} FROM (SELECT DISTINCT {of} AS {name} FROM {table})"

_PUT_IN = """'<div class="x ad"><div>in ' || page_id || '</div>on<br><DIV CLASS=''ad''>more<span class="author">A &amp; B</div></div>'
    || '<nav><a href="x">t<a>u</nav><footer>'"""

ORACLE_SQL = {
    "agg_mart_monthly": _COUNTS,
    "top_trends": f"""
        SELECT * FROM (
          SELECT article_year, article_month, tag_name, CAST(sum(total_articles) AS BIGINT) AS total_articles,
                 CAST(row_number() OVER (PARTITION BY article_year, article_month
                                         ORDER BY sum(total_articles) DESC, tag_name) AS INTEGER) AS trend_rank
          FROM ({_COUNTS}) GROUP BY article_year, article_month, tag_name)
        WHERE trend_rank <= 3""",
    "article_key": f"SELECT page_id, {_crc32('url')} AS article_key FROM pages",
    "clean_html": f"SELECT page_id, {_clean_plain(_html_text('html'))} AS content FROM pages",
    "html_text": f"SELECT page_id, {_spaces(_html_text('html'))} AS content FROM pages",
    "player_texts": """
        SELECT conv_id, turn, '  ' || text || '  ' AS content FROM conversations""",
    "clean_text": f"SELECT doc_id, {_tidy('text')} AS content FROM documents",
    "token_spacing": f"SELECT doc_id, {_tokens('text')} AS content FROM documents",
    "split_case_boundary": f"SELECT doc_id, {_case('text')} AS content FROM documents",
    "fix_quotes": """
        SELECT conv_id, turn, '"' || text || '" ''' || role || '''' AS content FROM conversations""",
    "parse_published_at": f"""
        SELECT o_orderkey, strftime(d, '%Y-%m-%d %H:%M:%S') AS published_at,
               CAST(year(d) AS INTEGER) AS article_year, CAST(month(d) AS INTEGER) AS article_month
        FROM (SELECT o_orderkey, {_DATED} AS d FROM orders)""",
    "extract_links": f"""
        SELECT page_id, source_name, CAST(pos AS INTEGER) AS link_pos, {_absolute('href', 'base_url')} AS article_url
        FROM ({_LINKS}) WHERE href <> ''""",
    "normalize_url_variants": f"""
        SELECT page_id, CAST(form AS INTEGER) AS form,
               CASE form WHEN 0 THEN url WHEN 1 THEN regexp_replace(url, '^[a-z]+:', 'https:')
                    ELSE {_ROOT} || '/' || regexp_replace(url, '^[a-z]+://[^/]*/', '') END AS article_url
        FROM pages, range(4) AS forms(form)""",
    "extract_fields": _fields("html"),
    "extract_fields_nested": _fields(f"replace(html, '<footer>', {_PUT_IN})"),
    "home_page_items": f"""
        SELECT page_id, CAST(item_pos AS INTEGER) AS item_pos,
               regexp_extract(item, 'href="([^"]*)"', 1) AS article_url,
               'VnExpress' AS source_name_raw, 'Trang chủ' AS category_raw, '' AS author_raw,
               '2024-01-01 06:00:00' AS published_at_raw,
               trim(regexp_extract(item, '<a[^>]*>(.*?)</a>', 1)) AS title_raw, '' AS summary_raw, '' AS content_raw
        FROM (SELECT page_id, unnest(items[1:3]) AS item, unnest(range(least(len(items), 3))) AS item_pos
              FROM (SELECT page_id, {_inside('html', 'li')} AS items FROM pages))
        WHERE item LIKE '%<a%'""",
    "first_links_per_page": f"""
        SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM ({_LINKS}) WHERE pos < 5 AND NOT href LIKE '%,'""",
    "crawl_job_list": _JOBS,
    "jobs_with_selectors": f"""
        SELECT config_id, category_name, source_name, selector FROM ({_JOBS}) JOIN ({_SELECTORS}) USING (source_name)""",
    "jobs_missing_selector": f"""
        SELECT config_id, category_name, source_name FROM ({_JOBS})
        WHERE source_name NOT IN (SELECT source_name FROM ({_SELECTORS}))""",
    "job_running_total": """
        SELECT source, lang, 'SUCCESS' AS status, n AS extracted,
               CASE WHEN n = 0 THEN 0 ELSE CAST(sum(n) OVER (ORDER BY source, lang) AS BIGINT) END AS loaded,
               CASE WHEN n = 0 THEN 'No article found' END AS note
        FROM (SELECT source, lang, count(l.doc_id) AS n FROM documents d
              LEFT JOIN (SELECT DISTINCT doc_id FROM labels WHERE quality = 1) l ON l.doc_id = d.doc_id
              GROUP BY source, lang)""",
    "entity_text": """
        SELECT doc_id, chr(CAST(65 + doc_id % 26 AS INTEGER)) || 'x' || chr(CAST(97 + doc_id % 26 AS INTEGER)) || chr(65533)
               || replace(text, '&', '+') AS text FROM documents""",
    "stage_rows": _STAGED,
    "clean_staging": f"SELECT * EXCLUDE (run_id) REPLACE ({_clean_plain('content')} AS content) FROM ({_STAGED})",
    "clean_ids": f"""
        SELECT row_number() OVER (ORDER BY article_url) AS id, article_url, source_name, {_clean_plain('content')} AS content
        FROM ({_STAGED}) WHERE NOT article_url LIKE '%/blank'""",
    "null_tokens": """
        SELECT doc_id, CASE WHEN lang IN ('de', 'fr', 'es') THEN NULL ELSE lang END AS lang, source,
               CASE WHEN n_chars > 100 THEN CAST(n_chars AS DOUBLE) END AS n_chars
        FROM documents""",
    "null_token_counts": """
        SELECT source, count(*) FILTER (lang IN ('de', 'fr', 'es')) AS no_lang,
               count(*) FILTER (n_chars <= 100) AS no_chars
        FROM documents GROUP BY source""",
    "transform_rows": f"""
        SELECT 'order/' || o_orderkey AS article_url, o_orderpriority AS source_name, o_orderstatus AS category_name,
               'N/A' AS author_name, strftime({_DATED}, '%Y-%m-%d %H:%M:%S') AS published_at, 't' AS title,
               's' AS description, ' c ' AS content, '2024-01-01 06:00:00' AS scraped_at, 'run-1' AS run_id, 'N/A' AS tags
        FROM orders""",
    "transform_run": "SELECT 'run-1' AS run_id, count(*) AS n_rows FROM orders",
    "rows_per_run": "SELECT event_type AS run_id, count(*) AS n_rows FROM events GROUP BY event_type",
    "tags_present": f"SELECT {_ID}, trim(unnest(names)) AS tag_name FROM ({_PART_LISTS})",
    "tag_lookup": f"""
        SELECT {_ID}, tag_name, tag_key
        FROM (SELECT {_ID}, trim(unnest(names)) AS tag_name FROM ({_PART_LISTS}))
        JOIN ({_DIM_TAG}) USING (tag_name)""",
    "tag_bridge_sync": f"""{_TAG_SYNC}
        SELECT {_ID}, tag_key FROM bridge ANTI JOIN (SELECT * FROM compared WHERE changed) c USING ({_ID})
        UNION
        SELECT {_ID}, unnest(new_keys) AS tag_key FROM compared WHERE changed""",
    "tag_sync_stats": f"""{_TAG_SYNC}
        SELECT count(*) FILTER (changed) AS updated, count(*) FILTER (NOT changed) AS skipped FROM compared""",
    "bridge_insert_absent": f"""
        {_OLD_BRIDGE}
        UNION
        SELECT {_ID}, tag_key FROM (SELECT {_ID}, trim(unnest(names)) AS tag_name FROM ({_PART_LISTS}))
        JOIN ({_DIM_TAG}) USING (tag_name)""",
    "staging_delta": """
        SELECT 'doc/' || doc_id AS article_url, CASE lang WHEN 'es' THEN 'insert' ELSE 'update' END AS change,
               CASE lang WHEN 'de' THEN text || ' more' ELSE text END AS content, '2024-01-02 06:00:00' AS scraped_at
        FROM documents WHERE lang IN ('de', 'es')""",
    "warehouse_upsert": f"""
        SELECT o_orderkey, o_orderstatus, {_RAISED} AS o_totalprice, CAST(year(o_orderdate) AS INTEGER) AS o_year
        FROM orders""",
    "merge_touched_partitions": f"""
        SELECT o_orderkey, o_orderstatus, p AS o_totalprice,
               CAST(year(o_orderdate) + CASE WHEN p > 400000 THEN 1 ELSE 0 END AS INTEGER) AS o_year,
               CAST(o_orderkey % 8 AS INTEGER) AS bucket
        FROM (SELECT *, {_RAISED} AS p FROM orders)""",
    "dim_new_members": """
        SELECT (SELECT count(DISTINCT c_name) FROM customer WHERE c_acctbal > 0)
                 + row_number() OVER (ORDER BY c_name) AS author_key, c_name AS author_name
        FROM (SELECT DISTINCT c_name FROM customer
              WHERE c_name NOT IN (SELECT c_name FROM customer WHERE c_acctbal > 0))""",
    "fact_dimension_keys": f"""
        WITH o AS (SELECT *, 'order/' || o_orderkey AS u,
                          CASE WHEN o_orderstatus <> 'P' THEN 'by ' || o_custkey END AS author FROM orders),
        author AS (SELECT author, row_number() OVER (ORDER BY author) AS author_key
                   FROM (SELECT DISTINCT author FROM o WHERE author IS NOT NULL)),
        category AS ({_NUMBERED.format(name='o_orderstatus', key='category_key', of='o_orderstatus', table='orders')}),
        source AS ({_NUMBERED.format(name='o_orderpriority', key='source_key', of='o_orderpriority', table='orders')})
        SELECT {_crc32('u')} AS article_key, {_mark('', 'u')}, u AS article_url, ({_crc32('u')} % 16)::INTEGER AS bucket,
               CAST(date_diff('day', DATE '2005-01-01', CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS date_key,
               category_key, source_key, author_key,
               CAST(year(o_orderdate) AS INTEGER) AS article_year, CAST(month(o_orderdate) AS INTEGER) AS article_month
        FROM o JOIN category USING (o_orderstatus) JOIN source USING (o_orderpriority) LEFT JOIN author USING (author)""",
    "run_state": """
        SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
        WHERE r = 1""",
    "open_runs": """
        SELECT DISTINCT user_id AS run_id FROM events s
        WHERE event_type = 'signup' AND NOT EXISTS (
          SELECT 1 FROM events e WHERE e.user_id = s.user_id AND e.event_type = 'purchase' AND e.ts >= s.ts)""",
    "run_outcome": """
        SELECT CASE WHEN event_type IN ('error', 'click') THEN 'FAILED' ELSE 'SUCCESS' END AS status,
               CASE event_type WHEN 'error' THEN 'SQL Error: user ' || user_id
                    WHEN 'click' THEN 'Procedure returned None' END AS note,
               count(*) AS n_runs
        FROM events GROUP BY ALL""",
    "date_dimension": _CALENDAR,
    "date_dim_positional": _CALENDAR,
    "csv_delta_roundtrip": f"""
        SELECT 'doc/' || doc_id AS article_url, source AS source_name,
               CASE WHEN lang <> 'de' THEN lang END AS category_name, 'x' AS author_name, 'x' AS published_at,
               ' say "' || doc_id || '", twice ' AS title, 'x' AS description,
               CASE WHEN text NOT IN ({_NULL_TOKENS}) THEN text END AS content, 'x' AS scraped_at, 'x' AS run_id,
               CASE WHEN source <> 'src1' THEN 'a, b' END AS tags
        FROM documents""",
    "csv_article_scan": _STAGED,
    "latest_file": f"SELECT * FROM ({_STAGED}) WHERE category NOT IN ('en', 'de')",
    "daily_article_sink": f"""
        SELECT article_url, category AS category_raw, '010124' AS crawl_date FROM ({_STAGED})
        UNION ALL
        SELECT article_url, category, '020124' FROM ({_STAGED}) WHERE category = 'fr'""",
    "streamed_staging": f"""
        SELECT * REPLACE (CASE category WHEN 'en' THEN 'run-1' ELSE 'run-2' END AS run_id)
        FROM ({_STAGED})""",
    "config_append": """
        SELECT CAST(s_suppkey AS INTEGER) AS config_id, 'src' || s_nationkey AS source_name,
               'https://s' || s_suppkey || '.example.com' AS base_url, s_acctbal > 0 AS active, d AS date_dim
        FROM supplier, (SELECT unnest([DATE '2024-01-01', DATE '2024-01-02']) AS d)""",
    "truncate_load": "SELECT c_custkey, lower(c_name) AS c_name, c_nationkey FROM customer",
    "append_insert": """
        SELECT c_custkey, c_name, c_nationkey FROM customer
        UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier""",
    "mart_publish": f"""
        WITH counts AS ({_COUNTS}),
        category AS ({_NUMBERED.format(name='category_name', key='category_key', of='o_orderpriority', table='orders')}),
        tag AS (SELECT tag_name, row_number() OVER (ORDER BY tag_name) AS tag_key
                FROM (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS tag_name
                      FROM part WHERE p_partkey IN (SELECT l_partkey FROM lineitem))),
        source AS ({_NUMBERED.format(name='source_name', key='source_key', of='s_name', table='supplier')})
        SELECT 'Agg_Mart_Top_Trends' AS table_name,
               concat_ws('/', article_year, article_month, category_key, tag_key, counts.source_key) AS member,
               total_articles AS amount
        FROM counts JOIN category USING (category_name) JOIN tag USING (tag_name)
        UNION ALL SELECT 'DimCategory', category_name, category_key FROM category
        UNION ALL SELECT 'DimTag', tag_name, tag_key FROM tag
        UNION ALL SELECT 'DimSource', source_name, source_key FROM source""",
}

ORACLE_SQL |= {
    "incremental_counts": """
        SELECT CAST(year(o.o_orderdate) AS INTEGER) AS article_year, CAST(month(o.o_orderdate) AS INTEGER) AS article_month,
               CASE WHEN year(o.o_orderdate) = 2001 AND o_orderkey % 7 = 0 THEN 9 ELSE left(o.o_orderpriority, 1)::BIGINT END
                   AS category_key,
               w.tag_key, c.c_nationkey::BIGINT AS source_key, count(DISTINCT o.o_orderkey) AS total_articles
        FROM lineitem l
        JOIN orders o ON o.o_orderkey = l.l_orderkey
        JOIN customer c ON c.c_custkey = o.o_custkey
        JOIN (SELECT p_partkey, (ascii(tag) * 100 + length(tag))::BIGINT AS tag_key
              FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS tag FROM part)) w ON w.p_partkey = l.l_partkey
        WHERE o_orderstatus <> 'P' OR year(o_orderdate) = 2000
        GROUP BY ALL""",
    "run_log_counters": f"""{_TAG_SYNC},
        kept AS (SELECT c_custkey, c_name FROM customer WHERE c_custkey % 3 = 0),
        synced AS (SELECT count(*) AS n, count(*) FILTER (changed) AS updated FROM compared)
        SELECT 'empty' AS job_name, 'SUCCESS' AS status, 0::BIGINT AS extracted, 0::BIGINT AS loaded, NULL AS error
        UNION ALL SELECT 'customers', 'SUCCESS', count(*), count(*), NULL FROM kept
        UNION ALL SELECT 'broken', 'FAILED', 0, 0, 'SQL Error: no article file'
        UNION ALL SELECT 'nothing', 'FAILED', 0, 0, 'Procedure returned None'
        UNION ALL SELECT 'sync_tags', 'SUCCESS', n, updated, NULL FROM synced
        UNION ALL SELECT 'tags', 'SUCCESS', (SELECT count(*) FROM bridge), updated, NULL FROM synced
        UNION ALL SELECT 'SYSTEM_CHECK', 'FAILED', 0, 0, 'There are no jobs to run (Check Active=1)'
        UNION ALL SELECT 'left after FAILED', NULL, c_custkey, NULL, c_name FROM kept""",
    "published_page_forms": """
        SELECT o_orderkey, strftime(CASE o_orderkey % 5 WHEN 0 THEN date_trunc('minute', o_orderdate)
            WHEN 1 THEN date_trunc('second', o_orderdate) WHEN 2 THEN date_trunc('minute', o_orderdate)
            WHEN 3 THEN date_trunc('day', o_orderdate) END, '%Y-%m-%d %H:%M:%S') AS published_at
        FROM orders""",
    "publish_after_failure": """
        SELECT 'customer' AS table_name, c_custkey AS key, lower(c_name) AS name, 2 AS loaded, 1 AS left FROM customer
        UNION ALL SELECT 'supplier', s_suppkey, s_name, 2, 1 FROM supplier""",
    "header_hygiene": """
        SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_nationkey > 5 THEN c_name ELSE '' END AS c_name
        FROM customer""",
}

_CRAWL = f"""
    WITH fields AS ({ORACLE_SQL['extract_fields']}),
    jobs AS (
        SELECT DISTINCT page_id // 50 AS config_id, ['com', 'net', 'org'][page_id // 50 % 3 + 1] AS source_name
        FROM pages WHERE page_id // 50 % 4 <> 3),
    links AS (
        SELECT page_id, page_id // 50 AS config_id, url, unnest(CASE WHEN page_id % 7 = 0 THEN [1, 2] ELSE [1] END) AS copy
        FROM pages),
    crawled AS (
        SELECT fields.* REPLACE (source_name AS source_name_raw, 'all' AS category_raw), config_id, page_id
        FROM links JOIN jobs USING (config_id) JOIN fields ON article_url = url WHERE config_id % 5 <> 4)"""
ORACLE_SQL |= {
    "crawl_articles": f"{_CRAWL} SELECT * EXCLUDE (page_id) FROM crawled",
    "crawl_job_outcomes": f"""{_CRAWL}
        SELECT config_id, source_name, 'all' AS category_name,
               CASE WHEN config_id % 5 = 4 THEN 'FAILED' ELSE 'SUCCESS' END AS status, n AS extracted,
               CASE WHEN n = 0 THEN 0 ELSE CAST(sum(n) OVER (ORDER BY config_id) AS BIGINT) END AS loaded,
               nullif(concat_ws('; ', CASE WHEN config_id % 5 = 4 THEN 'Start page not found' WHEN n = 0 THEN 'No article found' END,
                                CASE WHEN failed > 0 THEN 'Pages failed: ' || failed END), '') AS note
        FROM (SELECT config_id, source_name, count(article_url) FILTER (page_id % 9 <> 0 AND page_id % 11 <> 0) AS n,
                     count(article_url) FILTER (page_id % 9 = 0 OR page_id % 11 = 0) AS failed
              FROM jobs LEFT JOIN crawled USING (config_id)
              GROUP BY config_id, source_name)""",
}
