"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from llm.licenses import PHRASES, TEMPLATES

_WORDS = r"list_filter(regexp_split_to_array({}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _either_case(words: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in words)


def _spans(kind: str, number: int, regex: str, group: int, least: int) -> str:
    """Spans of one rule: a match starts where the pieces and matches before it end."""
    regex = regex.replace("'", "''")
    return f"""
    SELECT rid, {number} AS k, '{kind}' AS kind, unnest(list_transform(range(1, len(m) + 1), lambda i: {{
        's': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0),
        'n': length(m[i]), 'g': length(g[i])}})) AS x, {least} AS least
    FROM (SELECT rid, regexp_extract_all(t, '{regex}') AS m, regexp_extract_all(t, '{regex}', {group}) AS g, regexp_split_to_array(t, '{regex}') AS p FROM d)"""


_RULES = [
    ("assign", "(" + _either_case("password|passwd|secret|token|api_?key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    ("access", "AKIA[A-Z0-9]+", 0, 20),
    ("hex", "[0-9a-f]+", 0, 24),
    ("host_token", "gh[pousr]_([A-Za-z0-9]+)", 1, 36),
    ("chat_token", "xox[abprs]-([A-Za-z0-9-]+)", 1, 20),
    ("web_token", "eyJ[A-Za-z0-9_.-]+", 0, 60),
]

_LISTED = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, k){}, '')"
OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
found AS ({" UNION ALL ".join(_spans(kind, i, regex, group, least) for i, (kind, regex, group, least) in enumerate(_RULES))}),
spans AS (SELECT rid, k, kind, x.s::BIGINT AS s, (x.s + x.n)::BIGINT AS e FROM found WHERE x.g >= least)
SELECT any_value(doc_id) AS doc_id, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
    sha256({_LISTED.format(" FILTER (k < 3)")}) AS base_sha256, {_LISTED.format(" FILTER (k IS NOT NULL)")} AS spans
FROM d LEFT JOIN spans USING (rid) GROUP BY rid
"""

OP3 = f"""
WITH RECURSIVE w AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format(_FOLDED)} AS w FROM documents),
sets AS (SELECT rid, doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
shingles AS (SELECT rid, unnest(s) AS x FROM sets),
shared AS (SELECT a.rid AS a, b.rid AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.x = b.x AND a.rid < b.rid GROUP BY ALL),
links AS (SELECT p.doc_id AS a, q.doc_id AS b FROM shared JOIN sets p ON p.rid = shared.a JOIN sets q ON q.rid = shared.b
    WHERE 100 * n >= 85 * (len(p.s) + len(q.s) - n)),
sides AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM sides UNION SELECT reach.a, sides.b FROM reach JOIN sides ON sides.a = reach.b),
low AS (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id <= coalesce(m, doc_id) AS kept
FROM sets LEFT JOIN low USING (doc_id)
"""

OP4 = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
placed AS (SELECT rid, unnest(range(0, length(h) // 2 - 199)) AS i, h FROM d),
windows AS (SELECT rid, i, md5(substr(h, 2 * i + 1, 400)) AS x FROM placed),
twice AS (SELECT rid, i FROM windows WHERE x IN (SELECT x FROM windows GROUP BY x HAVING count(*) > 1)),
steps AS (SELECT rid, i, i - lag(i) OVER (PARTITION BY rid ORDER BY i) AS step FROM twice),
numbered AS (SELECT rid, i, sum(CASE WHEN step <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY rid ORDER BY i) AS span FROM steps),
gone AS (SELECT rid, span, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY ALL),
kept AS (SELECT rid, coalesce(lag(b) OVER (PARTITION BY rid ORDER BY a), 0) AS s, a AS e FROM gone
    UNION ALL SELECT d.rid, coalesce(max(b), 0), max(length(h) // 2) FROM d LEFT JOIN gone USING (rid) GROUP BY d.rid),
texts AS (SELECT rid, coalesce(string_agg(substr(h, 2 * s + 1, 2 * (e - s)), '' ORDER BY s), '') AS k FROM kept JOIN d USING (rid) GROUP BY rid),
sums AS (SELECT rid, sum(b - a) AS r, count(*) AS n FROM gone GROUP BY rid)
SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(r, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans, sha256(unhex(k)) AS kept_sha256
FROM d JOIN texts USING (rid) LEFT JOIN sums USING (rid)
"""


def _covered(name: str, width: int) -> str:
    """Words of each text in windows of `width` words that stand in it twice or more."""
    return f"""
{name}_at AS (SELECT rid, unnest(range(1, len(w) - {width - 2})) AS i, w FROM d),
{name}_x AS (SELECT rid, i, md5(array_to_string(w[i:i + {width - 1}], ' ')) AS x FROM {name}_at),
{name}_again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, x) AS n FROM {name}_x) WHERE n > 1),
{name}_words AS (SELECT DISTINCT rid, i + j AS i FROM {name}_again, range({width}) r(j)),
{name} AS (SELECT rid, count(*) AS n FROM {name}_words GROUP BY rid)"""


OP6 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
{_covered("three", 3)},
{_covered("ten", 10)},
long_at AS (SELECT rid, unnest(range(1, len(w) - 199)) AS i, w FROM d),
long AS (SELECT DISTINCT rid FROM (SELECT rid, md5(array_to_string(w[i:i + 200], ' ')) AS x FROM long_at) GROUP BY rid, x HAVING count(*) > 1),
counted AS (SELECT rid, doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
failing AS (SELECT *, n_words < 50 OR 100 * coalesce(three.n, 0) > 50 * n_words AS base_failed, coalesce(three.n, 0) AS n3, coalesce(ten.n, 0) AS n10
    FROM counted LEFT JOIN three USING (rid) LEFT JOIN ten USING (rid) LEFT JOIN (SELECT rid, TRUE AS over FROM long) USING (rid))
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    n3::BIGINT AS n_repeat_words, base_failed, NOT base_failed AND 10 * n10 <= 3 * n_words AND over IS NULL AS kept
FROM failing
"""

OP8 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w FROM documents),
placed AS (SELECT rid, doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM d),
windows AS (SELECT rid, doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS x FROM placed),
firsts AS (SELECT x, min(doc_id) AS f FROM windows GROUP BY x),
gone AS (SELECT DISTINCT rid, i + j AS i FROM windows JOIN firsts USING (x), range(50) r(j) WHERE f < doc_id),
words AS (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM d),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS k, count(*) AS n FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (rid)
"""


# crc32 of a short text: a step for each bit, eight for each byte
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({0}) + 1), lambda k: [ascii({0}[k])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda x, y: xor(xor(x, y) >> 1, CASE WHEN xor(x, y) % 2 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("coalesce(text, '')")} AS w, {_CRC.format("(doc_id::VARCHAR)")} AS h FROM documents),
placed AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM d),
step AS (SELECT *, 1 + (n - a) // (3 + (h // 10) % 8) AS p FROM placed),
t AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(range(0, n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) END AS w FROM step),
words AS (SELECT rid, unnest(w) AS word, unnest(range(0, n)) AS i FROM t),
pairs AS (SELECT x.rid, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.rid = y.rid AND x.word = y.word AND x.i < y.i),
islands AS (SELECT rid, q, i, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS g FROM pairs),
same AS (SELECT rid, q, min(i) AS s, count(*) + q AS l FROM islands GROUP BY rid, q, g HAVING count(*) >= q AND count(*) + q >= 12),
runs AS (SELECT rid, s, l, min(q) AS q FROM same GROUP BY rid, s, l),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q) AS r FROM runs GROUP BY rid),
best AS (SELECT rid, s, l, q FROM runs QUALIFY row_number() OVER (PARTITION BY rid ORDER BY l DESC, s, q) = 1),
gone AS (SELECT DISTINCT rid, unnest(range(s + q, s + l)) AS i FROM runs),
kept AS (SELECT rid, string_agg(word, ' ' ORDER BY i) AS k FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, l::BIGINT AS length, q::BIGINT AS period, (1000 * l // q)::BIGINT AS exponent_milli,
    sha256(coalesce(r, '')) AS runs_sha256, sha256(coalesce(k, '')) AS collapsed_sha256
FROM t LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)
"""


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _license_sql() -> str:
    """Every block against every template, and every place against every phrase."""
    notices = ", ".join(f"({i}, '{t.label}', [{', '.join(map(_quoted, t.tokens))}], {t.least}, {t.width})" for i, t in enumerate(TEMPLATES))
    phrases = " UNION ALL ".join(
        f"SELECT rid, i, '{label}' AS label FROM (SELECT rid, w, unnest(range(0, len(w))) AS i FROM d) WHERE " + " AND ".join(f"w[i + {k}] = '{x}'" for k, x in enumerate(phrase.split(), 1))
        for phrase, label in PHRASES
    )
    return rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, list_filter(regexp_split_to_array({_FOLDED}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
notices AS (SELECT * FROM (VALUES {notices}) AS v(template, label, tokens, least, width)),
widths AS (SELECT DISTINCT width FROM notices),
placed AS (SELECT rid, w, width, unnest(range(0, len(w), width)) AS b FROM d, widths),
blocks AS (SELECT rid, width, list_distinct(w[b + 1:b + 2 * width]) AS held FROM placed),
met AS (SELECT rid, label, len(list_intersect(tokens, held)) AS n, least, len(tokens) AS m FROM blocks JOIN notices USING (width)),
found AS (SELECT rid, list(DISTINCT label) AS labels, max(n / m) AS best FROM met WHERE n >= least GROUP BY rid),
places AS ({phrases}),
base AS (SELECT rid, count(*) AS n, min(i) AS a, max(i) AS z, list(DISTINCT label) AS labels FROM places GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, a::BIGINT AS first_word, z::BIGINT AS last_word,
    coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
    coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ','), '') AS labels,
    CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0)::DOUBLE END AS score
FROM d LEFT JOIN found USING (rid) LEFT JOIN base USING (rid)
"""


OP12 = _license_sql()

OP13 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS e
    FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (SELECT a.r, a.vec_id AS anchor_id, a.label AS own, b.r AS other, b.vec_id AS id, b.label, coalesce(list_sum(list_transform(range(1, len(a.e) + 1), lambda i: a.e[i] * b.e[i])), 0)::BIGINT AS s
    FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.r <> b.r WHERE a.vec_id % 100 = 0),
positives AS (SELECT r, other, id, s FROM scores WHERE label = own QUALIFY row_number() OVER (PARTITION BY r ORDER BY s DESC, id, other) <= 5),
found AS (SELECT p.r, anchor_id, p.id AS positive_id, n.id AS negative_id, p.s AS positive_score, n.s AS negative_score, row_number() OVER (PARTITION BY p.r, p.other ORDER BY n.s DESC, n.id) AS rank
    FROM positives p JOIN scores n ON n.r = p.r AND n.label <> n.own AND 30 * p.s <= 100 * n.s AND 100 * n.s <= 90 * p.s)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM found WHERE rank <= 10
"""
