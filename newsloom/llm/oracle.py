"""SQL counterparts of the queries that SQL can express, worked out from the definitions, not by the operators' methods."""

from __future__ import annotations

_FITS = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"

# Longer rules come first.
_RULES = [("example.com", "/de/", "block"), ("example.net", "/en/", "allow"), ("org", "/fr/", "allow"), ("net", "/", "block")]
_CASES = " ".join(f"WHEN {_FITS.format(host, path)} THEN '{host}{path}'" for host, path, _ in _RULES)
_VERDICTS = " ".join(f"WHEN rule = '{host}{path}' THEN '{verdict}'" for host, path, verdict in _RULES)

_NAMES = "(" + "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key") + ")"
#: Kind, pattern, group and least length of what counts.
_SECRETS = [
    ("assign", rf"""{_NAMES}["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 0),
    ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 0),
    ("slack", "xox[abprs]-[A-Za-z0-9-]{10,}", 0, 0),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 0),
    ("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\x20\x09-\x0D/:@]{1,100}:[^\x20\x09-\x0D/:@]{1,100}@", 0, 0),
]

# Pieces between matches and the matches themselves add up to places.
_MATCHES = " UNION ALL ".join(f"""
    SELECT doc_id, {rank} AS rank, '{kind}' AS kind, {least} AS least,
           regexp_extract_all(t, '{pattern}', 0) AS hits, regexp_extract_all(t, '{pattern}', {group}) AS counted,
           string_split_regex(t, '{pattern}') AS gaps
    FROM texts WHERE regexp_matches(t, '{pattern}')""" for rank, (kind, pattern, group, least) in enumerate(_SECRETS))

_OP1 = f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
    matched AS ({_MATCHES}),
    placed AS (
        SELECT doc_id, rank, kind, least, unnest(hits) AS hit, unnest(counted) AS counted,
               unnest(gaps[:len(hits)]) AS gap, unnest(range(len(hits))) AS i
        FROM matched),
    ends AS (
        SELECT *, sum(length(gap) + length(hit)) OVER (PARTITION BY doc_id, rank ORDER BY i) AS stop FROM placed),
    spans AS (
        SELECT doc_id, rank, kind, (stop - length(hit))::BIGINT AS start,
               kind || ':' || (stop - length(hit))::BIGINT || ':' || stop::BIGINT AS span
        FROM ends WHERE length(counted) >= least),
    listed AS (
        SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
               count(*) FILTER (kind = 'hex') AS n_hex,
               string_agg(span, ',' ORDER BY start, rank) FILTER (rank < 3) AS base,
               string_agg(span, ',' ORDER BY start, rank) AS spans
        FROM spans GROUP BY doc_id)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM documents LEFT JOIN listed USING (doc_id)"""


def _words(text: str) -> str:
    return f"regexp_extract_all({text}, '[^\\x20\\x09-\\x0D]+')"


_A_TO_Z = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_OP6 = f"""
    WITH RECURSIVE texts AS (
        SELECT doc_id, {_words(_A_TO_Z.format("coalesce(text, '')"))} AS w FROM documents),
    sets AS (
        SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
               ELSE list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) END AS s
        FROM texts),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
    links AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM shingles AS a JOIN shingles AS b ON a.x = b.x AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach AS (
        SELECT doc_id, doc_id AS other FROM documents
        UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other),
    components AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept
    FROM sets JOIN components USING (doc_id)"""

_OP7 = f"""
    WITH texts AS (SELECT doc_id, {_words("coalesce(text, '')")} AS w FROM documents),
    windows AS (
        SELECT doc_id, i, md5_number(array_to_string(w[i:i + 49], ' ')) AS x
        FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM texts)),
    later AS (
        SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY x) AS first_id FROM windows)
        WHERE first_id < doc_id),
    words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM texts),
    -- A word is covered if a window starts at most 49 words before it.
    marked AS (
        SELECT words.*, coalesce(words.i - max(later.i) OVER (PARTITION BY words.doc_id ORDER BY words.i) < 50, false) AS gone
        FROM words LEFT JOIN later ON later.doc_id = words.doc_id AND later.i = words.i),
    runs AS (
        SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS begins FROM marked),
    done AS (
        SELECT doc_id, count(*) FILTER (gone) AS n_removed, count(*) FILTER (begins) AS n_spans,
               string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept
        FROM runs GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256,
           coalesce(n_spans, 0) AS n_spans
    FROM texts LEFT JOIN done USING (doc_id)"""

# What a turn is dressed up with, see the template of the operator.
_OPENER = "CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10 WHEN 'assistant' THEN 15 ELSE 10 + length({}) + 6 END"
_GUARDED = r"(\\*)(### System:|### User:|### Assistant:|### Role:|###:|</turn>)"


def _escaped(text: str) -> str:
    return rf"regexp_replace({text}, '{_GUARDED}', '\1\1\\\2', 'g')"


_OP8 = f"""
    WITH said AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum({_OPENER.format(_escaped('role'))} + length({_escaped('text')}) + 9)::BIGINT AS formatted_chars
    FROM said GROUP BY conv_id"""

# Java's and this engine's lower() may differ in rare letters outside the test tables' languages.
_OP10 = f"""
    WITH texts AS (
        SELECT doc_id, source, coalesce(text, '') AS t, {_words("coalesce(text, '')")} AS w FROM documents),
    grams AS (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS times
        FROM (SELECT doc_id, unnest(range(1, len(w) - 1)) AS i,
                     unnest([array_to_string(w[k:k + 2], ' ') FOR k IN range(1, len(w) - 1)]) AS g FROM texts)),
    repeats AS (
        SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words
        FROM (SELECT doc_id, i, unnest([0, 1, 2]) AS k FROM grams WHERE times > 1) GROUP BY doc_id),
    lines AS (
        SELECT * FROM (SELECT doc_id, source, t, unnest(string_split(t, chr(10))) AS line FROM texts)
        WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]')),
    dups AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY doc_id),
    normal AS (
        SELECT doc_id, source, md5(t) AS said_in, len({_words("line")}) AS n_words, regexp_replace(
            lower(array_to_string({_words("line")}, ' ')), '[0-9]', '0', 'g') AS said
        FROM lines),
    hosts AS (SELECT source, count(*) AS host_docs FROM documents GROUP BY source),
    common AS (
        SELECT normal.source, said FROM normal JOIN hosts ON hosts.source IS NOT DISTINCT FROM normal.source
        GROUP BY normal.source, said, host_docs
        HAVING count(DISTINCT said_in) > 50 AND count(DISTINCT said_in) > 0.01 * host_docs),
    removed AS (
        SELECT doc_id, sum(n_words) AS n_removed FROM normal JOIN common
        ON common.source IS NOT DISTINCT FROM normal.source AND common.said = normal.said GROUP BY doc_id),
    figures AS (
        SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
               length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
               coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
               coalesce(n_removed, 0)::BIGINT AS n_removed
        FROM texts LEFT JOIN repeats USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN removed USING (doc_id)),
    judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
    SELECT *, NOT base_failed AND NOT n_words - n_removed < 0.3 * n_words AS kept FROM judged"""

def _nearest(books: str) -> str:
    """Nearest entry of every part, ties to the lower index; d * 64 + e orders by distance, then by entry."""
    distance = " + ".join(f"(v[{i}] - c[{i}]) * (v[{i}] - c[{i}])" for i in range(1, 5))
    return f"""SELECT n, p, any_value(v) AS v, min(({distance}) * 64 + e) AS best
        FROM parts JOIN {books} USING (p) GROUP BY n, p"""


def _moved(books: str, assigned: str) -> str:
    """Entries at the floor of the mean of their parts; unused ones stay."""
    means = ", ".join(f"floor(sum(v[{i}])::DOUBLE / count(*))::BIGINT" for i in range(1, 5))
    return f"""SELECT p, e, coalesce(m, c) AS c FROM {books}
        LEFT JOIN (SELECT p, best % 64 AS e, [{means}] AS m FROM {assigned} GROUP BY p, best % 64) USING (p, e)"""


_OP12 = f"""
    WITH kept AS (
        SELECT row_number() OVER (ORDER BY vec_id) - 1 AS n, vec_id, label,
               list_transform(embedding, lambda x: floor(x::DOUBLE * 256)::BIGINT) AS q
        FROM embeddings
        WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    parts AS (SELECT n, p, q[p * 4 + 1:p * 4 + 4] AS v FROM kept, (SELECT unnest(range(16)) AS p)),
    books0 AS (SELECT p, n AS e, v AS c FROM parts WHERE n < 64),
    near0 AS ({_nearest("books0")}), books1 AS ({_moved("books0", "near0")}),
    near1 AS ({_nearest("books1")}), books2 AS ({_moved("books1", "near1")}),
    near2 AS ({_nearest("books2")}),
    codes AS (
        SELECT n, string_agg(format('{{:02x}}', best % 64), '' ORDER BY p) AS code, sum(best // 64)::BIGINT AS error
        FROM near2 GROUP BY n)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
           (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM books2) AS codebooks_sha256
    FROM codes JOIN kept USING (n)"""

# On these pages the article is marked, and its blocks are headings and paragraphs.
_DECODED = "regexp_replace(regexp_replace(b, '<br>', ' ', 'g'), '<[^>]*>', '', 'g')"
for _name, _char in (("quot", '"'), ("lt", "<"), ("gt", ">"), ("amp", "&")):
    _DECODED = f"regexp_replace({_DECODED}, '&{_name};?', '{_char}', 'g')"
_OP11 = f"""
    WITH blocks AS (
        SELECT page_id, url, string_split_regex(
            regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1), '</?(?:h1|p)>') AS bs
        FROM pages),
    texts AS (
        SELECT page_id, url, array_to_string(list_filter(
            list_transform(bs, lambda b: trim(regexp_replace({_DECODED}, '\\s+', ' ', 'g'))), lambda b: b <> ''), chr(10)) AS text
        FROM blocks)
    SELECT *, length(text) AS n_chars FROM texts"""

# CRC-32 bit by bit, over the distinct runs of a document.
_CRC = """xor(list_reduce(
    list_prepend(4294967295::BIGINT,
        list_transform(range(0, octet_length(encode(said))), lambda i: ('0x' || substr(hex(encode(said)), i * 2 + 1, 2))::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT)"""

_OP13 = f"""
    WITH RECURSIVE runs AS (
        SELECT doc_id, unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
        FROM documents),
    counted AS (SELECT doc_id || ':' || run AS said, run, count(*) AS n FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run),
    hashed AS (SELECT run, n, {_CRC} AS h FROM counted),
    slipped AS (
        SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
        FROM hashed),
    words AS (
        SELECT word, sum(n)::BIGINT AS n FROM slipped WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    cuts AS (
        SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS cut
        FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
    near AS (
        SELECT a.word, b.word AS near, b.n AS near_n FROM cuts a JOIN cuts b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
        UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON b.word = a.cut
        UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON b.word = a.cut),
    best AS (
        SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n
        FROM near GROUP BY word),
    formed AS (
        SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
               CASE WHEN near_n >= 2 * n THEN near_n END AS form_n
        FROM words LEFT JOIN best USING (word)),
    ways AS (
        SELECT word, word AS root FROM formed
        UNION ALL SELECT ways.word, form FROM ways JOIN formed ON formed.word = ways.root WHERE form IS NOT NULL)
    SELECT word, form, root, n, n_near, form_n
    FROM formed JOIN ways USING (word)
    WHERE root IN (SELECT word FROM formed WHERE form IS NULL)"""

ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": _OP1,
    "op4_url_filter": f"""
        WITH parts AS (
            SELECT page_id,
                   translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                   regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
            FROM pages),
        ruled AS (SELECT *, CASE {_CASES} END AS rule FROM parts)
        SELECT page_id, host, path, rule, CASE {_VERDICTS} ELSE 'allow' END AS verdict FROM ruled""",
    "op6_minhash_dedup": _OP6,
    "op7_substring_dedup": _OP7,
    "op8_chat_format": _OP8,
    "op10_quality_rules": _OP10,
    "op11_html_extraction": _OP11,
    "op12_vector_codes": _OP12,
    "op13_spelling_variants": _OP13,
}
