"""DuckDB SQL for the queries whose results plain SQL can give."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(column: str, pattern: str) -> str:
    return f"regexp_extract_all({_LOWER.format(column)}, '{pattern}')"


def _components(nodes: str, links: str) -> str:
    """CTE ``comp`` (id, component_id) from ``links`` (a, b), both directions given."""
    return f"""
reach AS (SELECT id, id AS other FROM ({nodes}) UNION SELECT r.id, l.b FROM reach r JOIN ({links}) l ON l.a = r.other),
comp AS (SELECT id, min(other) AS component_id FROM reach GROUP BY id)"""


_NOT_WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"

DECONTAMINATE = f"""
WITH il AS (SELECT item_id, ws, least(13, len(ws)) AS n
            FROM (SELECT item_id, {_words('text', _NOT_WORD)} AS ws FROM benchmark) WHERE len(ws) > 0),
pat AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS k
        FROM (SELECT item_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM il)),
dw AS (SELECT doc_id, {_words('text', _NOT_WORD)} AS ws FROM documents),
win AS (SELECT doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS k
        FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
              FROM dw JOIN (SELECT DISTINCT n FROM pat) ON len(ws) >= n)),
hit AS (SELECT doc_id, i, p.n, item_id FROM win JOIN pat p ON p.n = win.n AND p.k = win.k),
hw AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(len(ws), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(ws), 0) AS contaminated
FROM dw d LEFT JOIN hw ON hw.doc_id = d.doc_id LEFT JOIN hi ON hi.doc_id = d.doc_id"""

_GROUPS = " || ".join(f"to_base(CAST('0x' || substr(h, {1 + 5 * i}, 5) AS BIGINT), 32, 4)" for i in range(8))

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body, sha1(coalesce(html, '')) AS h FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY body) AS first_id FROM p)
SELECT page_id, CAST(octet_length(encode(body)) AS BIGINT) AS payload_bytes,
       translate({_GROUPS}, '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest,
       CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM f"""

_LINKS = "SELECT a, b FROM links UNION ALL SELECT b, a FROM links"

VECTORS = f"""
WITH RECURSIVE v AS MATERIALIZED (
    SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0 AND len(list_filter(embedding, lambda e: e <> 0)) > 0),
links AS MATERIALIZED (SELECT p.id AS a, q.id AS b FROM v p JOIN v q ON p.id < q.id AND list_cosine_similarity(p.x, q.x) >= 0.95),
{_components('SELECT vec_id AS id FROM embeddings', _LINKS)},
cnt AS (SELECT a AS id, count(*) AS n FROM ({_LINKS}) GROUP BY a)
SELECT c.id AS vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, component_id, c.id = component_id AS kept
FROM comp c LEFT JOIN cnt ON cnt.id = c.id"""

_SPACED = r"[^\x{20}\x{09}-\x{0D}]+"

NGRAMS = f"""
WITH RECURSIVE w AS (SELECT doc_id AS id, coalesce({_words('text', _SPACED)}, []) AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g
    FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
n AS MATERIALIZED (SELECT id, count(*) AS n FROM s GROUP BY id),
links AS MATERIALIZED (SELECT a, b FROM (
    SELECT p.id AS a, q.id AS b, count(*) AS c FROM s p JOIN s q ON p.g = q.g AND p.id < q.id GROUP BY p.id, q.id) x
    JOIN n na ON na.id = a JOIN n nb ON nb.id = b WHERE 100 * c >= 75 * (na.n + nb.n - c)),
{_components('SELECT id FROM w', _LINKS)}
SELECT c.id AS doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id FROM comp c LEFT JOIN n ON n.id = c.id"""



def _codes(scale: int = 4096, parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds as one CTE each over (id, part, pos, x)."""
    floor = f"CAST(floor({scale} * CAST(e AS DOUBLE)) AS BIGINT)"
    sql = f"""
WITH v AS MATERIALIZED (SELECT vec_id AS id, label, list_transform(embedding, lambda e: {floor}) AS x, len(embedding) // {parts} AS w
    FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
p AS MATERIALIZED (SELECT id, i // w AS part, i % w AS pos, x[i + 1] AS x FROM (SELECT id, x, w, unnest(range(0, len(x))) AS i FROM v)),
s AS (SELECT id, row_number() OVER (ORDER BY id) - 1 AS entry FROM v ORDER BY id LIMIT {entries}),
b0 AS MATERIALIZED (SELECT part, entry, pos, x FROM p JOIN s USING (id))"""
    for r in range(rounds + 1):
        sql += f""",
d{r} AS (SELECT p.id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d FROM p JOIN b{r} b USING (part, pos) GROUP BY ALL),
a{r} AS MATERIALIZED (SELECT id, part, entry, d FROM d{r} QUALIFY row_number() OVER (PARTITION BY id, part ORDER BY d, entry) = 1)"""
        if r < rounds:
            sql += f""",
m{r} AS (SELECT part, entry, pos, sum(x) AS s, count(*) AS n FROM p JOIN a{r} USING (id, part) GROUP BY ALL),
b{r + 1} AS MATERIALIZED (SELECT part, entry, pos, CAST(CASE WHEN n IS NULL THEN b.x WHEN s >= 0 THEN s // n
    ELSE -((n - 1 - s) // n) END AS BIGINT) AS x FROM b{r} b LEFT JOIN m{r} m USING (part, entry, pos))"""
    return sql + f""",
r AS (SELECT id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{rounds} GROUP BY id),
h AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM b{rounds})
SELECT id AS vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN v USING (id), h"""


ORACLE_SQL = {
    "op2_decontaminate": DECONTAMINATE,
    "op4_warc": WARC,
    "op7_vector_join": VECTORS,
    "op8_ngram_join": NGRAMS,
    "op12_vector_codes": _codes(),
}
