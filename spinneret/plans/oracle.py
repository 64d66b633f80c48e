"""The same queries as one SQL statement each, for a row-by-row check by another engine.

The statements are written apart from the DataFrame code: they order whole tables by one window, use plain patterns
that suit the given pages, and spell the stemmer as CASE chains. Only the published rule tables are shared.
"""

from __future__ import annotations

import re

from spinneret.functions import stemming as rules

# --- text -----------------------------------------------------------------------------------------------------------
_BLOCKS = "p|li|ul|ol|nav|div|article|section|h[1-6]|footer|header|body|html|head|table|tr|td|th|blockquote|pre|br|title"

_CTES: dict[str, str] = {}

_CTES["plain_html"] = r"""
    SELECT page_id, url,
           regexp_replace(regexp_replace(regexp_replace(html,
               '(?is)<!--.*?(?:-->|$)', '', 'g'),
               '(?is)<script\b.*?(?:</script\s*>|$)', ' ', 'g'),
               '(?is)<style\b.*?(?:</style\s*>|$)', ' ', 'g') AS html
    FROM pages"""
_CTES["body_text"] = rf"""
    SELECT page_id, url,
           lower(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html,
               '(?is)^.*?<body[^>]*>', ''),
               '(?i)</?(?:{_BLOCKS})(?:[\s/][^>]*)?(?:>|$)', ' ', 'g'),
               '(?i)<[/!]?[a-z][^>]*(?:>|$)', '', 'g'),
               '&(?:#[0-9]+|#[xX][0-9a-fA-F]+|[a-zA-Z][a-zA-Z0-9]*);', ' ', 'g'),
               '&(?:amp|copy|middot|quot)', ' ', 'g')) AS text
    FROM plain_html"""
_CTES["clean"] = "SELECT page_id, url, regexp_replace(text, '[^a-z0-9 ]', ' ', 'g') AS text FROM body_text"
_CTES["words"] = r"""
    SELECT page_id, url, unnest(string_split_regex(text, '\s+')) AS token,
           generate_subscripts(string_split_regex(text, '\s+'), 1) AS place
    FROM clean"""
_CTES["tokens"] = "SELECT page_id, url, place, token FROM words WHERE length(token) > 1"
_CTES["doc_words"] = r"""
    SELECT DISTINCT doc_id, token
    FROM (SELECT doc_id, unnest(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), '\s+')) AS token
          FROM documents)
    WHERE length(token) > 1"""
_CTES["asked_words"] = r"""
    SELECT DISTINCT token
    FROM (SELECT unnest(string_split_regex(regexp_replace(lower(text), '[^a-z0-9 ]', ' ', 'g'), '\s+')) AS token
          FROM benchmark)
    WHERE length(token) > 1"""
_CTES["vocab"] = """
    SELECT DISTINCT token FROM tokens"""


# --- stemmer --------------------------------------------------------------------------------------------------------
def _cases(branches: list[tuple[str, str]], otherwise: str = "w") -> str:
    return "CASE " + " ".join(f"WHEN {test} THEN {result}" for test, result in branches) + f" ELSE {otherwise} END"


def _suffix_cases(suffixes, result) -> str:
    return _cases([(f"ends_with(w, '{s}')", result(s)) for s in rules.longest_first(suffixes)])


def _cut(n: int, tail: str = "") -> str:
    stump = f"left(w, length(w) - {n})"
    return f"{stump} || '{tail}'" if tail else stump


def _vowel_in(text: str) -> str:
    return f"regexp_matches({text}, '[aeiouy]')"


def _short(text: str) -> str:
    return f"regexp_matches({text}, '{rules.SHORT_SYLLABLE}')"


def _region(start: str) -> str:
    """Start after the first vowel-consonant pair from ``start`` on, both 0-based; the length if there is none."""
    at = f"instr(substr(shape, {start} + 1), 'vc')"
    return f"CASE WHEN {at} > 0 THEN {start} + {at} + 1 ELSE length(w) END"


def stem_sql(words: str) -> str:
    """``(token, stem)`` for the distinct tokens of a table."""
    v, c = rules.VOWELS, "bcdfghjklmnpqrstvwxzY0123456789"
    keep = "token, w, p1, p2, stop"

    def before(n: int) -> str:
        return f"substr(w, length(w) - {n}, 1)"

    def in_region(s: str, p: str) -> str:
        return f"length(w) - {len(s)} >= {p}"

    def letters(s: str, allowed: str | None) -> str:
        return f" AND length(w) > {len(s)} AND instr('{allowed}', {before(len(s))}) > 0" if allowed else ""

    def in_1b(s: str) -> str:
        if s.startswith("eed"):
            return f"CASE WHEN {in_region(s, 'p1')} THEN {_cut(len(s), 'ee')} ELSE w END"
        return f"CASE WHEN {_vowel_in(_cut(len(s)))} THEN {_cut(len(s), '+')} ELSE w END"

    def in_2(s: str) -> str:
        tail, asked = rules.STEP_2[s]
        return f"CASE WHEN {in_region(s, 'p1')}{letters(s, asked)} THEN {_cut(len(s), tail)} ELSE w END"

    def in_3(s: str) -> str:
        tail, region = rules.STEP_3[s]
        more = f" AND {in_region(s, 'p2')}" if region == 2 else ""
        return f"CASE WHEN {in_region(s, 'p1')}{more} THEN {_cut(len(s), tail)} ELSE w END"

    def in_4(s: str) -> str:
        return f"CASE WHEN {in_region(s, 'p2')}{letters(s, rules.STEP_4[s])} THEN {_cut(len(s))} ELSE w END"

    doubles = ", ".join(f"'{d}'" for d in rules.DOUBLES)
    step_1a = _cases([
        ("ends_with(w, 'sses')", _cut(2)),
        ("ends_with(w, 'ied') OR ends_with(w, 'ies')", f"CASE WHEN length(w) > 4 THEN {_cut(2)} ELSE {_cut(1)} END"),
        ("ends_with(w, 'us') OR ends_with(w, 'ss')", "w"),
        (f"ends_with(w, 's') AND length(w) > 2 AND {_vowel_in(_cut(2))}", _cut(1)),
    ])
    repair = _cases([
        ("NOT ends_with(w, '+')", "w"),
        ("left(right(w, 3), 2) IN ('at', 'bl', 'iz')", _cut(1, "e")),
        (f"left(right(w, 3), 2) IN ({doubles})", _cut(2)),
        (f"length(w) - 1 = p1 AND {_short(_cut(1))}", _cut(1, "e")),
    ], otherwise=_cut(1))
    step_1c = _cases([(f"lower(right(w, 1)) = 'y' AND length(w) > 2 AND instr('{v}', {before(1)}) = 0", _cut(1, "i"))])
    step_5 = _cases([
        ("ends_with(w, 'e')", f"CASE WHEN length(w) - 1 >= p2 OR (length(w) - 1 >= p1 AND NOT {_short(_cut(1))}) "
                              f"THEN {_cut(1)} ELSE w END"),
        ("ends_with(w, 'll') AND length(w) - 1 >= p2", _cut(1)),
    ])
    stops = ", ".join(f"'{w}'" for w in rules.INVARIANT_AFTER_1A)

    sql = f"SELECT DISTINCT token FROM {words}"
    sql = f"""SELECT token, CASE WHEN instr(token, 'y') > 0
                THEN regexp_replace(regexp_replace(token, '^y', 'Y'), '([aeiouy])y', '\\1Y', 'g') ELSE token END AS w
              FROM ({sql})"""
    sql = f"SELECT token, w, translate(w, '{v + c}', '{'v' * len(v) + 'c' * len(c)}') AS shape FROM ({sql})"
    r1 = _cases([(f"starts_with(w, '{p}')", str(len(p))) for p in rules.R1_PREFIXES], otherwise=_region("0"))
    sql = f"SELECT token, w, shape, {r1} AS p1 FROM ({sql})"
    sql = f"SELECT token, w, p1, {_region('p1')} AS p2 FROM ({sql})"
    sql = f"SELECT token, p1, p2, {step_1a} AS w FROM ({sql})"
    sql = f"SELECT token, w, p1, p2, w IN ({stops}) AS stop FROM ({sql})"
    for step in (
        _suffix_cases(rules.STEP_1B, in_1b), repair, step_1c, _suffix_cases(rules.STEP_2, in_2),
        _suffix_cases(rules.STEP_3, in_3), _suffix_cases(rules.STEP_4, in_4), step_5,
    ):
        sql = f"SELECT {keep.replace('w,', f'CASE WHEN stop THEN w ELSE {step} END AS w,', 1)} FROM ({sql})"
    whole = [("length(token) <= 2", "token")]
    whole += [(f"token = '{word}'", f"'{stem}'") for word, stem in rules.SPECIAL_STEMS.items()]
    whole += [(f"token = '{word}'", "token") for word in rules.INVARIANT_WORDS]
    return f"SELECT token, {_cases(whole, otherwise=chr(39).join(['replace(w, ', 'Y', ', ', 'y', ')']))} AS stem FROM ({sql})"


_CTES["stems"] = stem_sql("vocab")
_CTES["doc_stems"] = stem_sql("doc_words")
_CTES["asked"] = f"SELECT DISTINCT stem AS term FROM ({stem_sql('asked_words')})"
_CTES["doc_table"] = """
    SELECT row_number() OVER (ORDER BY url) - 1 AS doc_id, url, page_id
    FROM (SELECT url, min(page_id) AS page_id FROM pages GROUP BY url)"""
_CTES["postings"] = """
    SELECT DISTINCT s.stem AS token, d.doc_id
    FROM tokens t JOIN stems s ON t.token = s.token JOIN doc_table d ON d.page_id = t.page_id"""
_CTES["text_postings"] = """
    SELECT DISTINCT s.stem AS token, w.doc_id FROM doc_words w JOIN doc_stems s ON w.token = s.token"""
_CTES["frequency"] = "SELECT token, count(*) AS n_docs FROM postings GROUP BY token"

# --- links ----------------------------------------------------------------------------------------------------------
_CTES["link_tags"] = r"""
    SELECT page_id, url, unnest(regexp_extract_all(html, '(?i)<a[\s/][^>]*>')) AS tag,
           generate_subscripts(regexp_extract_all(html, '(?i)<a[\s/][^>]*>'), 1) - 1 AS position
    FROM plain_html"""
_CTES["hrefs"] = r"""
    SELECT page_id, url, position,
           replace(regexp_extract(tag, '(?i)[\s"/]href\s*=\s*"([^"]*)"', 1), '&amp;', '&') AS href
    FROM link_tags"""
_CTES["links"] = r"""
    SELECT page_id, position,
           CASE WHEN regexp_matches(href, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN href
                WHEN starts_with(href, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*', 0) || href
                ELSE regexp_extract(url, '^[a-z]+://[^/?#]*(?:/[^?#]*/|/)?', 0) || href END AS dst_url
    FROM hrefs"""
_CTES["queue"] = "SELECT url FROM pages UNION ALL SELECT dst_url FROM links"
_CTES["visited"] = "SELECT url FROM pages UNION SELECT dst_url FROM links WHERE position = 0"

# --- layouts --------------------------------------------------------------------------------------------------------
_EARLIER = "ORDER BY token ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"


def _varint(x: str) -> str:
    return "(1 + " + " + ".join(f"CASE WHEN {x} >= {1 << bits} THEN 1 ELSE 0 END" for bits in range(7, 35, 7)) + ")"


def _gaps(postings: str) -> str:
    return f"SELECT token, doc_id, doc_id - lag(doc_id, 1, 0) OVER (PARTITION BY token ORDER BY doc_id) AS gap FROM {postings}"


def _compact(gaps: str) -> str:
    return f"""
    SELECT token, n_docs, n_bytes, CAST(coalesce(sum(n_bytes) OVER ({_EARLIER}), 0) AS BIGINT) AS "offset"
    FROM (SELECT token, count(*) AS n_docs,
                 CAST({_varint('count(*)')} + sum({_varint('gap')}) AS BIGINT) AS n_bytes
          FROM ({gaps}) GROUP BY token)"""


_CTES["fixed"] = f"""
    SELECT token, n_docs, 4 + 4 * n_docs AS n_bytes,
           CAST(coalesce(sum(4 + 4 * n_docs) OVER ({_EARLIER}), 0) AS BIGINT) AS "offset"
    FROM frequency"""
_CTES["dict"] = _compact(_gaps("postings"))
_CTES["samples"] = """
    SELECT slot // 64 AS block, min(token) AS token, min("offset") AS "offset", count(*) AS n_tokens
    FROM (SELECT token, "offset", row_number() OVER (ORDER BY token) - 1 AS slot FROM dict) GROUP BY 1"""
_CTES["trie_steps"] = """
    SELECT substr(token, 1, depth) AS prefix, depth,
           CASE WHEN depth = length(token) THEN "offset" END AS "offset",
           CASE WHEN depth < length(token) THEN substr(token, depth + 1, 1) END AS next
    FROM (SELECT token, "offset", unnest(range(0, length(token) + 1)) AS depth FROM dict)"""

# Every prefix with the endings that make it a token; prefixes with the same endings are one state, named after the first.
_CTES["endings"] = """
    SELECT substr(token, 1, depth) AS prefix, depth, min(slot) AS slot, string_agg(substr(token, depth + 1), ' ' ORDER BY token) AS lang,
           bool_or(depth = length(token)) AS final
    FROM (SELECT token, row_number() OVER (ORDER BY token) - 1 AS slot, unnest(range(0, length(token) + 1)) AS depth FROM dict)
    GROUP BY prefix, depth"""
_CTES["states"] = """
    SELECT lang, min(struct_pack(slot := slot, depth := depth)) AS first FROM endings GROUP BY lang"""

# --- queries --------------------------------------------------------------------------------------------------------
_QUERIES: dict[str, str] = {
    "seed_urls": "SELECT url FROM pages UNION ALL SELECT url || '#again' FROM pages",
    "fetch_frontier": """
        SELECT q.url, d.page_id, d.page_id IS NOT NULL AS fetched
        FROM (SELECT DISTINCT url FROM queue) q LEFT JOIN doc_table d ON q.url = d.url""",
    "page_links": "SELECT page_id, position, href FROM hrefs",
    "resolved_links": "SELECT page_id, position, dst_url FROM links",
    "unvisited_links": "SELECT page_id, position, dst_url FROM links WHERE dst_url NOT IN (SELECT url FROM visited)",
    "visited_dedup": "SELECT DISTINCT url FROM queue WHERE url NOT IN (SELECT url FROM visited)",
    "page_text": "SELECT page_id, trim(regexp_replace(text, ' +', ' ', 'g')) AS text FROM clean",
    "page_tokens": """
        SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY place) - 1 AS position, token FROM tokens""",
    "stemmed_vocab": "SELECT token, stem FROM stems",
    "doc_terms": "SELECT DISTINCT t.page_id, s.stem AS token FROM tokens t JOIN stems s ON t.token = s.token",
    "doc_table": "SELECT doc_id, url FROM doc_table",
    "inverted_index": "SELECT token, doc_id FROM postings",
    "document_index": "SELECT token, doc_id FROM text_postings",
    "doc_frequency": "SELECT token, n_docs FROM frequency",
    "doc_lookup": """
        SELECT 'url' AS asked, q.url, d.doc_id
        FROM (SELECT DISTINCT url FROM queue) q LEFT JOIN doc_table d ON q.url = d.url
        UNION ALL
        SELECT 'id' AS asked, d.url, p.doc_id
        FROM (SELECT DISTINCT doc_id - 5 AS doc_id FROM documents) p LEFT JOIN doc_table d ON p.doc_id = d.doc_id""",
    "doc_listing": "SELECT doc_id, url FROM doc_table ORDER BY doc_id",
    "doc_count": "SELECT count(*) AS n_docs FROM doc_table",
    "indexed_urls": "SELECT doc_id, url FROM doc_table WHERE doc_id IN (SELECT doc_id FROM postings)",
    "crawl_reachable": """
        SELECT p.url, min(w.hop) AS hop FROM walk w JOIN pages p ON p.page_id = w.page_id GROUP BY p.url""",
    "crawl_index": """
        SELECT s.stem AS token, r.doc_id, r.url
        FROM (SELECT row_number() OVER (ORDER BY url) - 1 AS doc_id, page_id, url
              FROM pages WHERE page_id IN (SELECT page_id FROM walk)) r
        JOIN tokens t ON t.page_id = r.page_id JOIN stems s ON t.token = s.token
        GROUP BY s.stem, r.doc_id, r.url""",
    "href_cases": """
        SELECT page_id, 2 * position AS position, dst_url FROM links
        UNION ALL
        SELECT page_id, 2 * position + 1, 'mailto:q@r.s' FROM links""",
    "doc_table_extend": """
        SELECT row_number() OVER (ORDER BY page_id % 2, url) - 1 AS doc_id, url FROM pages""",
    "dump_text": """
        SELECT 'Token: Token[key=' || token || ']' AS line FROM (SELECT DISTINCT token FROM postings)
        UNION ALL
        SELECT '------DocId: ' || doc_id || '-----' AS line FROM postings""",
    "crawl_outcome": """
        SELECT state, hop, count(*) AS n_urls
        FROM (SELECT DISTINCT url, 'fetched' AS state, CAST(0 AS BIGINT) AS hop FROM pages
              UNION ALL
              SELECT DISTINCT dst_url, 'given_up', CAST(1 AS BIGINT) FROM links WHERE dst_url NOT IN (SELECT url FROM pages))
        GROUP BY state, hop""",
    "crawl_retry": """
        SELECT p.url, t.hop, t.attempts, CASE WHEN t.fetched THEN 'fetched' ELSE 'given_up' END AS state
        FROM tries t JOIN pages p ON p.page_id = t.page_id
        UNION ALL
        SELECT l.dst_url, min(t.hop + t.attempts), CAST(4 AS BIGINT), 'given_up'
        FROM tries t JOIN links l ON l.page_id = t.page_id
        WHERE t.fetched AND l.dst_url NOT IN (SELECT url FROM pages) GROUP BY l.dst_url""",
    "retry_ledger": """
        WITH attempts AS (
            SELECT CAST(user_id AS VARCHAR) AS url, event_id, event_type = 'signup' AS ok,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS nth,
                   sum(CASE WHEN event_type <> 'signup' THEN 1 ELSE 0 END)
                       OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n_failed
            FROM events),
        closing AS (
            SELECT url, min(nth) AS last FROM attempts WHERE ok OR n_failed = 4 GROUP BY url)
        SELECT a.url, CAST(max(a.n_failed) AS BIGINT) AS failures,
               CASE WHEN max(c.last) IS NULL THEN 'pending' WHEN max(a.n_failed) > 3 THEN 'given_up' ELSE 'fetched' END AS state,
               max(CASE WHEN a.nth = c.last THEN a.event_id END) AS closed_seq
        FROM attempts a LEFT JOIN closing c ON a.url = c.url
        WHERE c.last IS NULL OR a.nth <= c.last GROUP BY a.url""",
    "index_text_lines": """
        SELECT DISTINCT token, CAST(-1 AS BIGINT) AS doc_id, 'Token: Token[key=' || token || ']' AS line FROM postings
        UNION ALL
        SELECT token, doc_id, '------DocId: ' || doc_id || '-----' AS line FROM postings""",
    "index_table": """
        SELECT token, doc_id // 65536 AS block, count(*) AS n_docs, string_agg(doc_id, ',' ORDER BY doc_id) AS doc_ids
        FROM postings GROUP BY token, block""",
    "postings_fixed": 'SELECT token, n_docs, n_bytes, "offset" FROM fixed',
    "posting_gaps": _gaps("postings"),
    "postings_compact": 'SELECT token, n_docs, n_bytes, "offset" FROM dict',
    "document_compact": _compact(_gaps("text_postings")),
    "token_dict": 'SELECT token, "offset" FROM dict',
    "token_dict_fixed": """
        SELECT slot, token, "offset", slot * 72 AS record_at
        FROM (SELECT token, "offset", row_number() OVER (ORDER BY token) - 1 AS slot FROM dict WHERE strlen(token) <= 64)""",
    "token_dict_rejects": "SELECT token, strlen(token) AS token_bytes FROM dict WHERE strlen(token) > 12",
    "token_trie": """
        SELECT prefix, depth, CASE WHEN depth = 0 THEN '-' ELSE right(prefix, 1) END AS val,
               max("offset") IS NOT NULL AS is_terminal, coalesce(max("offset"), -1) AS "offset",
               count(DISTINCT next) AS n_children
        FROM trie_steps GROUP BY prefix, depth""",
    "token_automaton": """
        SELECT s.first.slot || ':' || s.first.depth AS state, right(c.prefix, 1) AS letter, t.first.slot || ':' || t.first.depth AS target, c.final
        FROM states s
        JOIN endings p ON p.slot = s.first.slot AND p.depth = s.first.depth
        JOIN endings c ON c.depth = p.depth + 1 AND substr(c.prefix, 1, p.depth) = p.prefix
        JOIN states t ON t.lang = c.lang""",
    "segment_roundtrip": """
        SELECT p.token, f."offset", s.slot, d.url
        FROM postings p JOIN doc_table d ON p.doc_id = d.doc_id JOIN fixed f ON p.token = f.token
        LEFT JOIN (SELECT token, row_number() OVER (ORDER BY token) - 1 AS slot FROM fixed WHERE strlen(token) <= 64) s
        ON p.token = s.token""",
    "segment_meta": """
        SELECT 'pages' AS segment_id, (SELECT count(*) FROM frequency) AS token_count,
               (SELECT count(*) FROM doc_table) AS doc_count,
               (SELECT min(token) FROM frequency) AS first_token, (SELECT max(token) FROM frequency) AS last_token""",
    "segment_search": """
        SELECT p.token AS term, d.page_id % 4 AS segment_id, d.url FROM postings p JOIN doc_table d ON p.doc_id = d.doc_id
        WHERE p.token IN (SELECT term FROM asked)""",
    "segment_merge": """
        SELECT p.token, p.doc_id, d.url FROM postings p JOIN doc_table d ON p.doc_id = d.doc_id""",
    "token_lookup": 'SELECT token, n_docs, "offset" FROM dict WHERE token IN (SELECT term FROM asked)',
    "search_urls": """
        SELECT p.token AS term, d.url FROM postings p JOIN doc_table d ON p.doc_id = d.doc_id
        WHERE p.token IN (SELECT term FROM asked)""",
    "prefix_search": "SELECT token, n_docs, \"offset\" FROM dict WHERE starts_with(token, 'th')",
    "prefix_completion": """
        SELECT a.prefix, d.token, d."offset"
        FROM (SELECT DISTINCT left(term, 3) AS prefix FROM asked) a
        JOIN dict d ON left(d.token, length(a.prefix)) = a.prefix""",
    "token_range": "SELECT token, n_docs, \"offset\" FROM dict WHERE token BETWEEN 'con' AND 'est'",
    "sampled_index": 'SELECT block, token, "offset", n_tokens FROM samples',
    "sampled_lookup": "SELECT a.term, max(s.block) AS block FROM asked a LEFT JOIN samples s ON s.token <= a.term GROUP BY a.term",
    "stream_index": """
        SELECT p.token, s.doc_id, s.url
        FROM (SELECT url, row_number() OVER (ORDER BY min(page_id) % 3, url) - 1 AS doc_id FROM pages GROUP BY url) s
        JOIN doc_table d ON d.url = s.url JOIN postings p ON p.doc_id = d.doc_id""",
    "stream_visited": "SELECT DISTINCT url FROM queue",
}
_QUERIES["stream_retry"] = _QUERIES["retry_ledger"]
_QUERIES["dump_table"] = _QUERIES["index_table"]

# Pages reached with each number of hops; a shortest way has fewer hops than there are pages.
_CTES["walk"] = """
    WITH RECURSIVE way(page_id, hop) AS (
        SELECT CAST(1 AS BIGINT), CAST(0 AS BIGINT)
        UNION
        SELECT e.dst, w.hop + 1 FROM way w JOIN edges e ON w.page_id = e.src WHERE w.hop < (SELECT count(*) FROM pages))
    SELECT page_id, hop FROM way"""
# How many attempts at each page fail before the first one that succeeds.
_CTES["page_failures"] = """
    SELECT page_id, count(*) AS n
    FROM (SELECT event_id % (SELECT count(*) FROM pages) AS page_id,
                 max(event_type NOT IN ('error', 'view')) OVER (
                     PARTITION BY event_id % (SELECT count(*) FROM pages) ORDER BY ts, event_id) AS answered
          FROM events)
    WHERE NOT answered GROUP BY page_id"""
# The crawl, round by round: a page's row is replaced with each new attempt.
_CTES["tries"] = """
    WITH RECURSIVE t(page_id, round, attempts) USING KEY (page_id) AS (
        SELECT CAST(1 AS BIGINT), CAST(0 AS BIGINT), CAST(1 AS BIGINT)
        UNION
        (SELECT w.page_id, w.round + 1, w.attempts + 1
         FROM t w JOIN page_failures f ON f.page_id = w.page_id WHERE w.attempts <= f.n AND w.attempts <= 3
         UNION ALL
         SELECT DISTINCT e.dst, w.round + 1, CAST(1 AS BIGINT)
         FROM t w JOIN edges e ON e.src = w.page_id LEFT JOIN page_failures f ON f.page_id = w.page_id
         WHERE w.attempts > coalesce(f.n, 0) AND NOT EXISTS (SELECT 1 FROM recurring.t r WHERE r.page_id = e.dst)))
    SELECT t.page_id, t.round - t.attempts + 1 AS hop, t.attempts, t.attempts > coalesce(f.n, 0) AS fetched
    FROM t LEFT JOIN page_failures f ON f.page_id = t.page_id"""
_CTES["edges"] = """
    SELECT page_id AS src, dst
    FROM (SELECT page_id, unnest([2 * page_id + 1, 2 * page_id + 2,
                 CASE WHEN page_id % 5 = 0 THEN (7 * page_id + 3) % (SELECT count(*) FROM pages) END]) AS dst FROM pages)
    WHERE dst < (SELECT count(*) FROM pages) AND dst <> page_id"""


def _statement(name: str) -> str:
    """The query with the common tables it needs, in order of definition."""
    body = _QUERIES[name]
    needed: set[str] = set()
    todo = [body]
    while todo:
        text = todo.pop()
        for cte in _CTES:
            if cte not in needed and re.search(rf"\b(?:FROM|JOIN|,)\s+{cte}\b", text):
                needed.add(cte)
                todo.append(_CTES[cte])
    order = _definition_order(needed)
    tables = ",\n".join(f"{cte} AS MATERIALIZED ({_CTES[cte]})" for cte in order)
    if not tables:
        return body
    inner = re.match(r"\s*WITH\s+", body)
    return f"WITH {tables},\n{body[inner.end():]}" if inner else f"WITH {tables}\n{body}"


def _definition_order(needed: set[str]) -> list[str]:
    done: list[str] = []

    def visit(cte: str) -> None:
        for other in needed:
            if other != cte and other not in done and re.search(rf"\b(?:FROM|JOIN|,)\s+{other}\b", _CTES[cte]):
                visit(other)
        if cte not in done:
            done.append(cte)

    for cte in sorted(needed):
        visit(cte)
    return done


def all_statements() -> dict[str, str]:
    return {name: _statement(name) for name in _QUERIES}
