"""DuckDB SQL for the queries whose results SQL can express; it shares no code with the operators."""

from __future__ import annotations

_SQL: dict[str, str] = {}


def all_sql() -> dict[str, str]:
    return dict(_SQL)


# A-Z in lower case without touching other letters.
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_SQL["op6_minmax_near_duplicates"] = rf"""
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(string_split_regex({_LOWER.format("coalesce(text, '')")}, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
        WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s
    FROM words
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k
    FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
    SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * k >= 85 * (p.n + q.n - k)
), edges AS (
    SELECT a, b FROM links UNION SELECT b, a FROM links
), reach(doc_id, other) AS (
    SELECT doc_id, doc_id FROM documents
    UNION
    SELECT r.doc_id, e.b FROM reach r JOIN edges e ON e.a = r.other
)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id, d.doc_id = r.component_id AS kept
FROM documents d LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) r ON r.doc_id = d.doc_id
"""

_WORDS = "list_filter(string_split_regex({}, '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '')"

_SQL["op8_benchmark_phrases"] = f"""
WITH docs AS (
    SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents
), items AS (
    SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS k, unnest(list_transform(range(1, greatest(len(w) - 12, 1) + 1),
        lambda i: array_to_string(w[i:i + least(len(w), 13) - 1], ' '))) AS phrase
    FROM items WHERE len(w) > 0
), sizes AS (
    SELECT DISTINCT k FROM windows
), spans AS (
    SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM docs, sizes WHERE len(w) >= k
), phrases AS (
    SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM spans
), found AS (
    SELECT p.doc_id, p.k, p.i, x.item_id FROM phrases p JOIN windows x ON x.phrase = p.phrase AND x.k = p.k
), hit AS (
    SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + k)) AS place FROM found) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
    sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AND 20 * coalesce(h.n_hit, 0) >= len(d.w) AS contaminated
FROM docs d LEFT JOIN hit h ON h.doc_id = d.doc_id LEFT JOIN named n ON n.doc_id = d.doc_id
"""

# What the template adds to a text or role, counted rather than written: one sign before each control string.
_ESCAPED = "length({0}) + length(regexp_replace({0}, '\\\\|###|</turn>', 'X#', 'g')) - length(regexp_replace({0}, '\\\\|###|</turn>', 'X', 'g'))"

_SQL["op3_chat_format"] = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'
), sized AS (
    SELECT *, {_ESCAPED.format("text")} + {_ESCAPED.format("role")} + length(role) - length(replace(role, ':', '')) + 14 AS chars
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""

# Stretches of words equal q words further on, each with its smallest q; crc32 is made of bit operations.
_SQL["op11_periodic_runs"] = r"""
WITH crc_table AS (
    SELECT list(c ORDER BY n) AS t FROM (
        SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM (SELECT unnest(range(256))::BIGINT AS n))
), ids AS (
    SELECT doc_id, string_split_regex(trim(coalesce(text, ''), chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '[\x20\x09-\x0D]+') AS raw,
        xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
    FROM documents, crc_table
), split AS (
    SELECT doc_id, h, h // 10 AS g, list_filter(raw, lambda x: x <> '') AS w FROM ids
), placed AS (
    SELECT *, len(w) AS n, CASE WHEN len(w) > 0 THEN g % len(w) END AS a FROM split
), texts AS (
    SELECT doc_id, CASE WHEN h % 10 = 0 AND n > 0
        THEN list_transform(range(n), lambda i: CASE WHEN i < a THEN w[i + 1] ELSE w[a + (i - a) % (1 + (n - a) // (3 + g % 8)) + 1] END)
        ELSE w END AS w
    FROM placed
), words AS (
    SELECT doc_id, unnest(w) AS word, unnest(range(len(w)))::BIGINT AS i, len(w) AS n FROM texts
), equal_words AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.doc_id = y.doc_id AND x.word = y.word AND x.i < y.i
    WHERE 3 * (y.i - x.i) <= x.n
), islands AS (
    SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM equal_words
), stretches AS (
    SELECT doc_id, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY doc_id, q, island
), runs AS (
    SELECT doc_id, start, length, min(q) AS period FROM stretches WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length
), listed AS (
    SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY doc_id
), best AS (
    SELECT * FROM runs r WHERE NOT EXISTS (
        SELECT 1 FROM runs o WHERE o.doc_id = r.doc_id AND (o.length * r.period > r.length * o.period
            OR (o.length * r.period = r.length * o.period AND (o.start < r.start OR (o.start = r.start AND o.period < r.period)))))
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM runs
), left_over AS (
    SELECT w.doc_id, string_agg(w.word, ' ' ORDER BY w.i) AS collapsed FROM words w ANTI JOIN dropped d ON d.doc_id = w.doc_id AND d.i = w.i GROUP BY w.doc_id
)
SELECT d.doc_id, coalesce(l.n_runs, 0) AS n_runs, b.start, b.length, b.period, 1000 * b.length // b.period AS exponent_milli,
    sha256(coalesce(l.lines, '')) AS runs_sha256, sha256(coalesce(o.collapsed, '')) AS collapsed_sha256
FROM documents d LEFT JOIN listed l ON l.doc_id = d.doc_id LEFT JOIN best b ON b.doc_id = d.doc_id LEFT JOIN left_over o ON o.doc_id = d.doc_id
"""

_SQL["op12_warc_archive"] = r"""
WITH payloads AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h,
        max(page_id) OVER (PARTITION BY coalesce(html, '')) AS first_id
    FROM pages
)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
        substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h || '0', 1 + 5 * i // 4, 2))::INT >> (3 - (5 * i) % 4)) & 31), 1)), '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM payloads
"""


def _vector_codes(rounds: int = 4) -> str:
    """Every distance of every round, entries moved to the floor of their mean."""
    steps = [
        """kept AS (
    SELECT vec_id, label, embedding, len(embedding) // 4 AS w FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), places AS (
    SELECT vec_id, w, unnest(range(len(embedding))) AS i, unnest(embedding) AS value FROM kept
), x AS (
    SELECT vec_id, i // w AS part, i % w AS place, floor(1024 * value::DOUBLE)::BIGINT AS val FROM places
), first_ids AS (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT 256
), b0 AS (
    SELECT part, entry, place, val FROM x JOIN first_ids USING (vec_id)
)"""
    ]
    for r in range(rounds + 1):
        steps.append(f"""d{r} AS (
    SELECT x.vec_id, x.part, b.entry, sum((x.val - b.val) * (x.val - b.val))::BIGINT AS d FROM x JOIN b{r} b ON x.part = b.part AND x.place = b.place
    GROUP BY x.vec_id, x.part, b.entry
), a{r} AS (
    SELECT vec_id, part, min({{'d': d, 'e': entry}}) AS m FROM d{r} GROUP BY vec_id, part
), t{r} AS (
    SELECT x.part, x.place, a.m.e AS entry, sum(x.val)::BIGINT AS s, count(*) AS n FROM x JOIN a{r} a ON a.vec_id = x.vec_id AND a.part = x.part
    GROUP BY x.part, x.place, a.m.e
), b{r + 1} AS (
    SELECT b.part, b.entry, b.place, CASE WHEN t.n IS NULL THEN b.val ELSE (t.s - ((t.s % t.n) + t.n) % t.n) // t.n END AS val
    FROM b{r} b LEFT JOIN t{r} t ON t.part = b.part AND t.place = b.place AND t.entry = b.entry
)""")
    return f"""WITH {", ".join(steps)}, codes AS (
    SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id
)
SELECT k.vec_id, c.code, c.error, sum(c.error) OVER (PARTITION BY k.label)::BIGINT AS label_error,
    (SELECT sha256(string_agg(val::VARCHAR, ',' ORDER BY part, entry, place)) FROM b{rounds}) AS codebooks_sha256
FROM kept k JOIN codes c USING (vec_id)"""


_SQL["op13_vector_codes"] = _vector_codes()
