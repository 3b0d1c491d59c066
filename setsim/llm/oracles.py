"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = rf"""
WITH item_words AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
patterns AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS gram
  FROM item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i) WHERE len(w) > 0),
doc_words AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
hits AS (
  SELECT DISTINCT d.doc_id, d.i, p.n, p.item_id
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS gram
        FROM doc_words, unnest(range(1, len(w) + 1)) AS t(i), (SELECT DISTINCT n FROM patterns)
        WHERE i + n - 1 <= len(w)) AS d
  JOIN patterns AS p ON p.n = d.n AND p.gram = d.gram),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit FROM hits, unnest(range(0, n)) AS t(k) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
         string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hits GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(f.n_items, 0)::BIGINT AS n_items, sha256(coalesce(f.ids, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words AS d LEFT JOIN covered AS c USING (doc_id) LEFT JOIN found AS f USING (doc_id)
"""

#: Weight size ** 0.5, one epoch, seed 17.
OP2 = r"""
WITH sized AS (SELECT *, coalesce(strlen(text), 0) + 1 AS bytes,
    '17:' || coalesce(doc_id::VARCHAR, '') || ':' || md5(coalesce(text, '')) || CASE WHEN nth > 1 THEN ':' || nth ELSE '' END AS name
    FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, coalesce(text, '')) AS nth FROM documents)),
per_source AS (SELECT source, sum(bytes)::DOUBLE AS size FROM sized GROUP BY source),
rated AS (SELECT source, sqrt(size) / sum(sqrt(size)) OVER () * sum(size) OVER () / size AS rate FROM per_source),
stepped AS (
  SELECT source, list_transform(range(0, 200), lambda k: list_sum(list_transform(range(0, k + 1),
         lambda j: exp(j * ln(rate) - rate - lgamma(j + 1))))) AS steps FROM rated),
drawn AS (
  SELECT s.*, len(list_filter(t.steps, lambda c: c <= ('0x' || substr(md5(s.name), 1, 13))::BIGINT / 4503599627370496.0)) AS n
  FROM sized AS s JOIN stepped AS t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, text, lang, source, n_chars, c::INT AS copy,
       ('0x' || substr(md5(name || ':' || c), 1, 13))::BIGINT AS shuffle_key
FROM drawn, unnest(range(1, n + 1)) AS u(c)
"""

OP3 = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v::DOUBLE[], c.v::DOUBLE[])::BIGINT AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

OP4 = r"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS gram
  FROM words, unnest(range(1, len(w) - 11)) AS t(i)),
marked AS (
  SELECT doc_id, i FROM (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY gram) AS least FROM windows)
  WHERE doc_id > least),
gone AS (SELECT DISTINCT doc_id, i + k AS pos FROM marked, unnest(range(0, 13)) AS t(k)),
lost AS (SELECT doc_id, list(pos) AS ats, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
       sha256(coalesce(CASE WHEN n IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(
         [w[j] FOR j IN range(1, len(w) + 1) IF NOT list_contains(ats, j)], ' ') END, '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id)
"""


OP6 = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, coalesce(regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS gram
  FROM words, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS t(i) WHERE len(w) > 0),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams AS a JOIN grams AS b ON a.gram = b.gram AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id
  HAVING 100 * count(*) >= 85 * ((SELECT n FROM sizes WHERE doc_id = a.doc_id) + (SELECT n FROM sizes WHERE doc_id = b.doc_id) - count(*))),
reach AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach AS r JOIN links AS l ON r.b = l.a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, min(r.b)) AS component_id,
       (SELECT count(*) FROM links WHERE a = d.doc_id)::BIGINT AS n_links
FROM documents AS d LEFT JOIN sizes USING (doc_id) LEFT JOIN reach AS r ON r.a = d.doc_id GROUP BY d.doc_id, n
"""

_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
           "len(list_filter(string_split(v, '.'), lambda p: p::HUGEINT > 255)) = 0"),
    "card": (r"[0-9]([\x20-]?[0-9])+",
             "len(d) BETWEEN 14 AND 19 AND list_sum(list_transform(range(1, len(d) + 1), lambda i: "
             "CASE WHEN (len(d) - i) % 2 = 0 THEN d[i]::INT ELSE d[i]::INT * 2 - CASE WHEN d[i]::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", "len(d) BETWEEN 10 AND 15"),
}


#: The added kinds: pattern, check, prior and context.  The patterns' word
#: boundaries are those of ASCII.
_EDGE = "(^|[^A-Za-z0-9_])"
_MORE_KINDS = {
    "iban": (r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b",
             "length(replace(v, ' ', '')) BETWEEN 15 AND 34 AND list_reduce(list_prepend(0, list_transform("
             "string_split(substr(replace(v, ' ', ''), 5) || substr(v, 1, 4), ''), lambda c: "
             "CASE WHEN c BETWEEN '0' AND '9' THEN c::INT ELSE unicode(c) - 55 END)), "
             "lambda x, y: (x * CASE WHEN y > 9 THEN 100 ELSE 10 END + y) % 97) = 1", 0.8, "iban|bank|account|transfer|swift|bic"),
    "key": (r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b", "true", 0.8, "key|aws|access|credential|secret"),
    "secret": (r"[A-Za-z0-9+/_-]{16,}",
               "regexp_matches(v, '[0-9]') AND regexp_matches(v, '[A-Za-z]') AND len(list_distinct(string_split(v, ''))) >= 8",
               0.4, "token|password|passwd|pwd|secret|api.?key|auth|bearer|credential"),
    "national": (r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b",
                 "v[1:3] NOT IN ('000', '666') AND v[1] <> '9' AND v[5:6] <> '00' AND v[8:11] <> '0000'",
                 0.4, "ssn|social|security|taxpayer|tin"),
    "routing": (r"\b[0-9]{9}\b",
                "v <> '000000000' AND (3 * (v[1]::INT + v[4]::INT + v[7]::INT) + 7 * (v[2]::INT + v[5]::INT + v[8]::INT) "
                "+ v[3]::INT + v[6]::INT + v[9]::INT) % 10 = 0", 0.35, "routing|aba|rtn|bank|transit"),
}
_ALL_KINDS = [*_KINDS, *_MORE_KINDS]


def _found(kind: str, pattern: str, check: str, prior: float = 1.0, context: str = "") -> str:
    """Matches with their offsets: the pieces and matches before, and the piece between."""
    near = f"regexp_matches(right(p, 40) || ' ' || left(q, 40), '(?i){_EDGE}({context})')"
    scored = f" AND {prior} + CASE WHEN {near} THEN 0.2 ELSE 0 END >= 0.5" if context else ""
    return f"""
SELECT doc_id, {_ALL_KINDS.index(kind)} AS k, '{kind}' AS kind, s AS start, s + length(v) AS stop FROM (
  SELECT doc_id, v, p, q, regexp_replace(v, '[^0-9]', '', 'g') AS d,
         (sum(length(p) + length(v)) OVER (PARTITION BY doc_id ORDER BY i) - length(v))::BIGINT AS s
  FROM (SELECT doc_id, unnest(m) AS v, unnest(pieces[1:len(m)]) AS p, unnest(pieces[2:len(m) + 1]) AS q, generate_subscripts(m, 1) AS i
        FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS m, string_split_regex(text, '{pattern}') AS pieces
              FROM documents WHERE text IS NOT NULL)))
WHERE {check}{scored}"""


_COUNTS = "".join(f", coalesce(n_{k}, 0)::BIGINT AS n_{k}" for k in _MORE_KINDS)

OP7 = f"""
WITH found AS ({" UNION ALL ".join([*(_found(k, *v) for k, v in _KINDS.items()), *(_found(k, *v) for k, v in _MORE_KINDS.items())])}),
listed AS (
  SELECT doc_id, {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in _ALL_KINDS)},
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) FILTER (k < {len(_KINDS)}) AS base,
         string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, k) AS spans FROM found GROUP BY doc_id)
SELECT doc_id, coalesce(n_email, 0)::BIGINT AS n_email, coalesce(n_ip, 0)::BIGINT AS n_ip,
       coalesce(n_card, 0)::BIGINT AS n_card, coalesce(n_phone, 0)::BIGINT AS n_phone,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans{_COUNTS}
FROM documents LEFT JOIN listed USING (doc_id)
"""

_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP12 = f"""
WITH d AS (
  SELECT *, len(w) AS n FROM (SELECT doc_id, row_number() OVER () AS r, {_TERMS} AS w FROM documents) WHERE len(w) > 0),
total AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS ll FROM d),
asked AS (
  SELECT item_id, term, count(*) AS times
  FROM (SELECT item_id, unnest({_TERMS}) AS term FROM (SELECT DISTINCT item_id, text FROM benchmark WHERE item_id IS NOT NULL))
  GROUP BY ALL),
postings AS (
  SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, n, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (
  SELECT term, floor(1000 * ln((2 * nn + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM postings, total GROUP BY term, nn),
scored AS (
  SELECT item_id, r, doc_id,
         sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + (75 * n * nn) // ll))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), total GROUP BY ALL)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM scored WHERE score > 0 AND doc_id IS NOT NULL QUALIFY rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_decontamination": OP1, "op2_mixing": OP2, "op3_topk_search": OP3, "op4_substring_dedup": OP4,
            "op6_jaccard_join": OP6, "op6_jaccard_links": OP6, "op7_pii": OP7,
            "op12_ranked_search": OP12}
