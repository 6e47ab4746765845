"""SQL counterparts, written for DuckDB independently of the Spark code.

None for packing, token counts (a tokenizer), language (a compressor), page
extraction (a parser), personal data (positions of backtracking patterns),
periodic runs (a checksum of ids) and the quality classifier (a fit): tests hold
these against brute force, the last one against labels it has not seen.
"""

from __future__ import annotations

_FOLD = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = r"[^\x20\x09-\x0D]+"

# The words, stop words and bounds repeat the production parameters.
_STOPS = """
    'the','of','and','to','in','a','is','that','it','for','on','was','with','as','be','by','this','are','from','or','an','at','not','have',
    'which','he','his','but','le','la','les','de','des','du','et','en','un','une','est','que','qui','dans','pour','pas','sur','au','avec','ce',
    'il','ne','se','par','plus','ou','son','der','die','das','und','den','von','zu','mit','sich','auf','ist','im','dem','nicht','ein','eine',
    'als','auch','es','für','aus','bei','nach','el','los','las','del','y','una','con','para','no','al','lo','su','como','más','o',
    'este','sus','pero'
"""

QUALITY = rf"""
WITH d AS (
    SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '{_SPACE}') AS w
    FROM documents),
grams AS (
    SELECT k, i, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
    FROM (SELECT k, w, unnest(generate_series(1, len(w) - 4)) AS i FROM d)),
twice AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, g) AS n FROM grams) WHERE n > 1),
hit AS (SELECT k, count(DISTINCT p) AS n FROM (SELECT k, unnest(generate_series(i, i + 4)) AS p FROM twice) GROUP BY k),
counted AS (
    SELECT d.doc_id, len(w) AS n_words, list_sum(list_transform(w, lambda x: length(x)))::BIGINT AS chars,
           length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
           list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
           coalesce(hit.n, 0) AS n_repeat_words,
           len(list_filter(w, lambda x: {_FOLD.format("x")} IN ({_STOPS}))) AS stops,
           length(regexp_replace(text, '\P{{Lu}}', '', 'g')) AS capitals, length(regexp_replace(text, '\P{{L}}', '', 'g')) AS letters
    FROM d LEFT JOIN hit USING (k)),
rated AS (
    SELECT *, coalesce(chars, 0) AS word_chars, len(lines) - len(list_distinct(lines)) AS n_dup_lines, len(lines) AS n_lines,
           n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
    FROM counted),
failed AS (
    SELECT *, list_filter([
        CASE WHEN n_words < 10 THEN 'n_words' END,
        CASE WHEN coalesce(word_chars / nullif(n_words, 0), 0) NOT BETWEEN 2 AND 15 THEN 'mean_word_length' END,
        CASE WHEN coalesce(n_symbols / nullif(n_words, 0), 0) > 0.1 THEN 'symbol_ratio' END,
        CASE WHEN coalesce(stops / nullif(n_words, 0), 0) < 0.04 THEN 'stop_word_ratio' END,
        CASE WHEN coalesce(n_dup_lines / nullif(n_lines, 0), 0) > 0.5 THEN 'duplicate_line_ratio' END,
        CASE WHEN coalesce(capitals / nullif(letters, 0), 0) > 0.3 THEN 'shout_ratio' END], lambda x: x IS NOT NULL) AS out_of
    FROM rated)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       NOT base_failed AND len(out_of) = 0 AS kept, array_to_string(out_of, ',') AS failed
FROM failed
"""

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)(\?[^#]*)?"


def _plain(url: str) -> str:
    host = f"regexp_replace({_FOLD.format(f"regexp_extract({url}, '{_ADDRESS}', 1)")}, '^(www|m)\\.([^.]+\\.)', '\\2')"
    path = f"regexp_replace(regexp_extract({url}, '{_ADDRESS}', 2), '/?(index)?(\\.html?)?/?$', '')"
    query = (
        f"array_to_string(list_filter(string_split(substr(regexp_extract({url}, '{_ADDRESS}', 3), 2), '&'), "
        "lambda x: NOT regexp_full_match(x, '(utm_[^=&]*|ref|fbclid|gclid)(=.*)?')), '&')"
    )
    return f"CASE WHEN {host} <> '' THEN {host} || {path} || CASE WHEN {query} <> '' THEN '?' || {query} ELSE '' END END"


URLS = rf"""
WITH RECURSIVE p AS (
    SELECT row_number() OVER () AS k, page_id, coalesce({_FOLD.format(f"regexp_extract(url, '{_ADDRESS}', 1)")}, '') AS host,
           coalesce(regexp_extract(url, '{_ADDRESS}', 2), '') AS path, {_plain("url")} AS plain, url, html
    FROM pages),
links AS (
    SELECT plain, url, unnest([
        regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*?\bhref\s*=\s*["'']?([^"''>\s]+)', 1),
        regexp_extract(html, '(?is)<link\b[^>]*?\bhref\s*=\s*["'']?([^"''>\s]+)[^>]*\brel\s*=\s*["'']?canonical\b', 1),
        regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*?\burl\s*=\s*([^"''>\s]+)', 1)]) AS link
    FROM p),
targets AS (
    SELECT plain, CASE WHEN contains(link, '://') THEN link
                       WHEN starts_with(link, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || link
                       WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || link END AS target
    FROM links WHERE link <> ''),
one_way AS (SELECT plain AS a, {_plain("target")} AS b FROM targets),
edges AS (SELECT a, b FROM one_way WHERE a <> b UNION SELECT b, a FROM one_way WHERE a <> b),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
class AS (SELECT a AS plain, least(a, min(b)) AS top FROM reach GROUP BY a),
rules(rule, verdict, rhost, rpath) AS (VALUES
    ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
    ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'), ('com/de/', 'block', 'com', '/de/')),
ruled AS (
    SELECT p.*, coalesce(class.top, p.plain) AS page_class, arg_max(r.rule, length(r.rule)) AS rule, arg_max(r.verdict, length(r.rule)) AS own
    FROM p LEFT JOIN class ON class.plain = p.plain
    LEFT JOIN rules r ON (p.host = r.rhost OR ends_with(p.host, '.' || r.rhost)) AND starts_with(p.path, r.rpath)
    GROUP BY ALL),
taken AS (
    SELECT page_class, CASE WHEN bool_or(own = 'allow') THEN 'allow' ELSE 'block' END AS taken
    FROM ruled WHERE own IS NOT NULL AND page_class IS NOT NULL GROUP BY page_class)
SELECT page_id, host, path, rule, coalesce(own, taken, 'allow') AS verdict, own IS NULL AND taken IS NOT NULL AS inherited
FROM ruled LEFT JOIN taken USING (page_class)
"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_SPACE}') AS w FROM documents),
s AS (
    SELECT DISTINCT doc_id, list_aggregate(w[i:i + 4], 'string_agg', ' ') AS g
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
edges AS (
    SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * n_both >= 75 * (p.n + q.n - n_both)),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, least(d.doc_id, min(reach.b)) AS component_id,
       d.doc_id = least(d.doc_id, min(reach.b)) AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN reach ON reach.a = d.doc_id GROUP BY d.doc_id, n.n
"""

TOOL_CALLS = r"""
WITH calls AS (SELECT conv_id, turn, text FROM conversations WHERE role = 'user'),
results AS (SELECT conv_id, turn - 1 AS turn, text AS content FROM conversations WHERE role = 'assistant'),
both_ AS (
    SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.turn, r.turn) AS k, c.turn AS called, c.text, r.turn AS answered, r.content,
           c.turn >= 2 AS needy, EXISTS (SELECT 1 FROM calls x WHERE x.conv_id = c.conv_id AND x.turn = c.turn - 2) AS met
    FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.turn = r.turn),
stated AS (
    SELECT *, CASE WHEN called IS NULL THEN 'orphan' WHEN answered IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
           coalesce(called, answered + 1) AS own_turn
    FROM both_)
SELECT conv_id, 'c' || k AS call_id, own_turn AS turn, status, own_turn AS rank_turn, 0::BIGINT AS rank_step,
       array_to_string(list_filter([
           CASE WHEN called IS NOT NULL AND text IS NULL THEN '$.query: missing' WHEN called IS NOT NULL AND text = '' THEN '$.query: bounds' END,
           CASE WHEN needy AND NOT met THEN 'needs c' || (called - 2) END], lambda x: x IS NOT NULL), ';') AS errors,
       '{"arguments":' || CASE WHEN called IS NULL THEN 'null' WHEN text IS NULL THEN '{"turn":' || called || '}'
                               ELSE '{"query":' || to_json(text) || ',"turn":' || called || '}' END
       || ',"id":"c' || k || '","name":' || CASE WHEN called IS NULL THEN 'null' ELSE '"reply"' END
       || ',"needs":[' || CASE WHEN needy THEN '"c' || (called - 2) || '"' ELSE '' END || '],"result":'
       || CASE WHEN content IS NULL THEN 'null' ELSE to_json(content)::VARCHAR END || ',"status":"' || status || '"}' AS record
FROM stated
"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = rf"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_WORDS}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_FOLD.format("coalesce(text, '')")}, '{_WORDS}') AS w FROM benchmark),
windows AS (
    SELECT DISTINCT item_id, w[i:i + 9] AS g FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
places AS (SELECT k, w, unnest(generate_series(1, len(w))) AS i FROM d),
sizes AS (SELECT DISTINCT len(g) AS n FROM windows),
grams AS (SELECT k, i, n, w[i:i + n - 1] AS g FROM places, sizes WHERE i + n - 1 <= len(w)),
hits AS (SELECT DISTINCT k, i, n, item_id FROM grams JOIN windows USING (g)),
words AS (SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(generate_series(i, i + n - 1)) AS p FROM hits) GROUP BY k),
named AS (SELECT k, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM hits GROUP BY k)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (k) LEFT JOIN named USING (k)
"""

FILL_IN = rf"""
WITH d AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
           regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*{_SPACE}|[\x20\x09-\x0D]+') AS u
    FROM documents),
drawn AS (
    SELECT doc_id, text, u, len(u)::BIGINT AS n,
           list_transform([h[1:8], h[9:16], h[17:24], h[25:32]], lambda x: ('0x' || x)::BIGINT) AS h FROM d),
cut AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS lo, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS hi,
           CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h[3] % 100 >= 50 THEN 'plain'
                WHEN h[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
parts AS (
    SELECT *, coalesce(array_to_string(u[1:lo], ''), '') AS a, coalesce(array_to_string(u[lo + 1:hi], ''), '') AS b,
           coalesce(array_to_string(u[hi + 1:n], ''), '') AS c
    FROM cut)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(a) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(b) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || a || '<S>' || c || '<M>' || b
              ELSE '<S>' || c || '<P>' || a || '<M>' || b END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

ORACLES = {
    "op2_quality_rules": QUALITY,
    "op3_url_filters": URLS,
    "op4_near_duplicates": NEAR_DUPLICATES,
    "op8_tool_calls": TOOL_CALLS,
    "op9_decontamination": DECONTAMINATION,
    "op12_fill_in_middle": FILL_IN,
}
