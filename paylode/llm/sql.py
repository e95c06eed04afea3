"""DuckDB SQL of the queries that SQL can express; each works by brute force, without the operator's method."""

_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = "regexp_extract_all({}, '[^\\x20\\x09-\\x0D]+')"

NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
    SELECT doc_id, {_WORDS.format(_ASCII_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
s AS (
    SELECT doc_id, unnest(CASE
        WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))
        WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g
    FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
linked AS (
    SELECT x, y FROM shared JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM linked UNION ALL SELECT y, x FROM linked),
reach AS (SELECT x, y FROM edges UNION SELECT r.x, e.y FROM reach r JOIN edges e ON r.y = e.x),
lowest AS (SELECT x, least(x, min(y)) AS component_id FROM reach GROUP BY x)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       coalesce(component_id, d.doc_id) = d.doc_id AS kept
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN lowest ON x = d.doc_id"""

# Two hex digits are a byte; a window is 800 digits from an odd place on, cut from a piece of 1600.
REPEATS = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, len(h) // 2 AS n FROM documents),
pieces AS (
    SELECT doc_id, n, unnest(range(0, n // 400 + 1)) AS piece,
           unnest(list_transform(range(0, n // 400 + 1), lambda b: substr(h, 800 * b + 1, 1600))) AS c
    FROM d WHERE n >= 400),
w AS (
    SELECT doc_id, 400 * piece + unnest(range(0, least(400, n - 399 - 400 * piece))) AS p,
           unnest(list_transform(range(0, least(400, n - 399 - 400 * piece)), lambda i: md5(substr(c, 2 * i + 1, 800)))) AS k
    FROM pieces),
twice AS (SELECT k FROM w GROUP BY k HAVING count(*) > 1),
marks AS (SELECT w.doc_id, w.p FROM w JOIN twice USING (k)),
gaps AS (SELECT *, p - lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS gap FROM marks),
runs AS (SELECT *, sum(CASE WHEN gap <= 400 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM gaps),
spans AS (SELECT doc_id, min(p) AS a, max(p) + 400 AS b FROM runs GROUP BY doc_id, r),
cuts AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
whole AS (
    SELECT cuts.*, h, a + CASE WHEN {0} THEN 0 WHEN {1} THEN 1 WHEN {2} THEN 2 ELSE 3 END AS a2,
           b - CASE WHEN b = n OR {3} THEN 0 WHEN {4} THEN 1 WHEN {5} THEN 2 ELSE 3 END AS b2
    FROM cuts JOIN d USING (doc_id)),
rest AS (SELECT *, coalesce(lag(b2) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before2 FROM whole),
sums AS (
    SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, max(b2) AS last2,
           string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept,
           string_agg(substr(h, 2 * before2 + 1, 2 * (a2 - before2)), '' ORDER BY a) AS kept2,
           string_agg(a || '-' || b, ',' ORDER BY a) AS spans
    FROM rest GROUP BY doc_id)
SELECT d.doc_id, CAST(n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(kept, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256, coalesce(spans, '') AS spans,
       decode(unhex(coalesce(kept2, '') || substr(h, 2 * coalesce(last2, 0) + 1))) AS text
FROM d LEFT JOIN sums USING (doc_id)""".format(
    # Whether a character begins at the byte: its first digit is not 8, 9, A or B.
    *[f"substr(h, 2 * (a + {k}) + 1, 1) NOT IN ('8', '9', 'A', 'B')" for k in range(3)],
    *[f"substr(h, 2 * (b - {k}) + 1, 1) NOT IN ('8', '9', 'A', 'B')" for k in range(3)])

# A hex digit is four bits, a base32 digit five.
WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
s AS (SELECT page_id, html, sha1(html) AS h, max(page_id) OVER (PARTITION BY html) AS latest FROM p),
b AS (
    SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
        ['0000','0001','0010','0011','0100','0101','0110','0111','1000','1001','1010','1011','1100','1101','1110','1111'
        ][instr('0123456789abcdef', substr(h, i, 1))]), '') AS bits
    FROM s)
SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           1 + CAST(16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
             + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
             + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest,
       CASE WHEN page_id = latest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> latest THEN latest END AS refers_to
FROM b"""

VECTORS = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b
    ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.93),
reach AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
lowest AS (SELECT x, least(x, min(y)) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x, count(*) AS n_links FROM links GROUP BY x)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN degree ON degree.x = vec_id LEFT JOIN lowest ON lowest.x = vec_id"""

URLS = """
WITH u AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
    FROM pages),
r(rule_host, rule_path, rule_verdict) AS (VALUES
    ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
    ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
fits AS (
    SELECT page_id, max_by(rule_host || rule_path, len(rule_host || rule_path)) AS rule,
           max_by(rule_verdict, len(rule_host || rule_path)) AS rule_verdict
    FROM u JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
    GROUP BY page_id),
listed AS (
    SELECT DISTINCT host || regexp_replace(path, '/+$', '') AS canonical FROM u
    WHERE regexp_matches(host, '(^|[.])(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)[.]example[.]'))
SELECT u.page_id, host, path, rule,
       coalesce(rule_verdict, CASE WHEN host || regexp_replace(path, '/+$', '') IN (SELECT canonical FROM listed)
                              THEN 'block' ELSE 'allow' END) AS verdict
FROM u LEFT JOIN fits USING (page_id)"""

UNITS = f"""
WITH l AS (
    SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
           unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS k
    FROM documents),
o AS (
    SELECT doc_id, k, line, CAST(sum(len(line) + 1) OVER (PARTITION BY doc_id ORDER BY k) - len(line) - 1 AS BIGINT) AS a,
           {_WORDS.format(_ASCII_LOWER.format("line"))} AS w
    FROM l),
r AS (
    SELECT doc_id, a, a + len(line) AS b,
           row_number() OVER (PARTITION BY array_to_string(w, ' ') ORDER BY doc_id, k) AS place
    FROM o WHERE len(w) > 0),
gone AS (
    SELECT doc_id, count(*) AS n_removed, sum(b - a) AS removed_chars, string_agg(a || '-' || b, ',' ORDER BY a) AS removed_spans
    FROM r WHERE place > 1 GROUP BY doc_id),
n AS (SELECT doc_id, count_if(len(w) > 0) AS n_units FROM o GROUP BY doc_id)
SELECT doc_id, CAST(n_units AS BIGINT) AS n_units, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(removed_chars, 0) AS BIGINT) AS removed_chars, coalesce(removed_spans, '') AS removed_spans
FROM n LEFT JOIN gone USING (doc_id)"""


# crc32 over a list of bytes, by the table of its 256 single bytes.
_CRC_TABLE = """crc_table AS (
    SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                ORDER BY i) AS crc
    FROM range(256) r(i))"""


def _crc32(of_bytes: str) -> str:
    return f"""xor(list_reduce(list_concat([4294967295], {of_bytes}),
        lambda c, b: xor(crc[CAST(xor(c, b) & 255 AS INT) + 1], c >> 8)), 4294967295)"""


def _ascii(text: str) -> str:
    return f"list_transform(string_split({text}, ''), lambda c: CAST(ord(c) AS BIGINT))"


def _cheapest(state: int, *ways: str) -> str:
    return f"list_min([{', '.join(ways)}]) AS s{state}"


def _way(of: str, cost: str, letter: str, line: str = "''") -> str:
    return f"{{c: ({of}).c + {cost}, a: ({of}).a || '{letter}', t: ({of}).t || {line}}}"


def _with_inserts(source: str) -> str:
    """Insertions relaxed: into USER and ASSISTANT from the others, then between those two."""
    one = lambda s, role: _way(s, "3", "I", f"chr(10) || '{role}:'")
    return f"""(SELECT * REPLACE (list_min([s2, {one('s3', 'user')}]) AS s2, list_min([s3, {one('s2', 'assistant')}]) AS s3)
    FROM (SELECT * REPLACE (list_min([s2, {one('s0', 'user')}, {one('s1', 'user')}, {one('s3', 'user')}]) AS s2)
    FROM ({source})))"""


def _after_row() -> str:
    """Each state's cheapest edits after a row: deleted, kept, or under a new role."""
    keep = "CASE WHEN gone THEN 1000000 ELSE mend END"
    own = "chr(10) || role || ':' || text"
    kept = lambda s, initial: _way(s, f"CASE WHEN initial = '{initial}' THEN {keep} ELSE 1000000 END", "K", own)
    new = lambda s, role: _way(s, f"3 + {keep}", "R", f"chr(10) || '{role}:' || text")
    gone = [_way(f"s{s}", "4", "D") for s in range(4)]
    users = [w for s in ("s0", "s1", "s3") for w in (kept(s, "u"), new(s, "user"))]
    return ", ".join([
        _cheapest(0, gone[0]), _cheapest(1, gone[1], kept("s0", "s")), _cheapest(2, gone[2], *users),
        _cheapest(3, gone[3], kept("s2", "a"), new("s2", "assistant"))])


_STATES = ", ".join(f"s{s}" for s in range(4))
# Forwards, with the whole string of edits as part of what is compared; the operator works backwards on costs.
CONVERSATIONS = f"""
WITH RECURSIVE {_CRC_TABLE},
k AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           {_crc32(_ascii("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"))} % 20 AS kind
    FROM conversations, crc_table),
damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS twice
    FROM k WHERE kind <> 0),
o AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
           regexp_replace(text, '[\\x20\\x09-\\x0D]+$', '') AS body, substr(role, 1, 1) AS initial
    FROM damaged),
p AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS again FROM o),
f AS (
    SELECT *, body = '' AS blank, body <> '' AND again > 1 AS duplicate, body = '' OR again > 1 AS gone,
           body <> '' AND again = 1 AND right(body, 1) NOT IN ('.', '!', '?') AS truncated,
           CASE WHEN body <> '' AND again = 1 AND right(body, 1) NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS mend,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS previous
    FROM p),
counted AS (
    SELECT conv_id, max(i) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count_if(blank) AS blank,
           count_if(duplicate) AS duplicate, count_if(truncated) AS truncated,
           count_if(previous IS NOT NULL AND previous || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM f GROUP BY conv_id),
steps AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS i, {{c: 0, a: '', t: ''}} AS s0, {{c: 1000000, a: '', t: ''}} AS s1,
           {{c: 1000000, a: '', t: ''}} AS s2, {{c: 1000000, a: '', t: ''}} AS s3
    FROM counted
    UNION ALL
    SELECT conv_id, i, {_after_row()}
    FROM {_with_inserts(f"SELECT p.conv_id, f.i, {_STATES}, role, text, initial, gone, mend FROM steps p JOIN f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1")}),
ended AS (
    SELECT conv_id, list_min([s0, s3]) AS best
    FROM {_with_inserts("SELECT steps.* FROM steps JOIN counted ON counted.conv_id IS NOT DISTINCT FROM steps.conv_id AND n = i")}),
ids AS (SELECT DISTINCT conv_id FROM conversations)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(substr(best.t, 2), '')) AS repaired_sha256
FROM ids LEFT JOIN counted ON counted.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM ids.conv_id"""


# UTF-8 of the letters that words have: A-z in one byte, U+00C0 to U+00FF in two.
_WORD_BYTES = """flatten(list_transform(string_split(CAST({} AS VARCHAR), ''), lambda c:
    CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [195, CAST(ord(c) AS BIGINT) - 64] END))"""
SPELLING = f"""
WITH RECURSIVE {_CRC_TABLE},
runs AS (
    SELECT doc_id, unnest(regexp_extract_all({_ASCII_LOWER.format("coalesce(text, '')")}, '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run
    FROM documents),
each AS (SELECT doc_id, run, count(*) AS n FROM runs GROUP BY ALL),
hashed AS (
    SELECT run, n, {_crc32(_WORD_BYTES.format("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run"))} AS h
    FROM each, crc_table),
whole AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, CAST(h % len(run) AS INT)) || substr(run, CAST(h % len(run) AS INT) + 2)
                ELSE run END AS word, n
    FROM hashed),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM whole WHERE len(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
spots AS (SELECT word, unnest(range(1, len(word) + 1)) AS i FROM words),
holes AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM spots),
pairs AS (
    SELECT x.word, y.word AS near FROM holes x JOIN holes y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
    UNION SELECT h.word, w.word FROM holes h JOIN words w ON w.word = h.a || h.b
    UNION SELECT w.word, h.word FROM holes h JOIN words w ON w.word = h.a || h.b),
ranked AS (
    SELECT pairs.word, near, o.n AS near_n, count(*) OVER (PARTITION BY pairs.word) AS n_near,
           row_number() OVER (PARTITION BY pairs.word ORDER BY o.n DESC, near) AS place
    FROM pairs JOIN words o ON o.word = near),
formed AS (
    SELECT words.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * n THEN near END AS form,
           CASE WHEN near_n >= 5 * n THEN near_n END AS form_n
    FROM words LEFT JOIN ranked ON ranked.word = words.word AND place = 1),
up AS (
    SELECT word, word AS at, form AS next FROM formed
    UNION ALL SELECT up.word, up.next, f.form FROM up JOIN formed f ON f.word = up.next)
SELECT formed.word, n, CAST(n_near AS BIGINT) AS n_near, form, form_n, up.at AS root
FROM formed JOIN up ON up.word = formed.word AND up.next IS NULL"""
