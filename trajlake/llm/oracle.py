"""DuckDB SQL of the queries that SQL can express on whole tables."""

from __future__ import annotations

_WORDS = "list_filter(regexp_split_to_array({text}, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"

OP8 = f"""WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS ws FROM documents),
 s AS (SELECT doc_id, i, array_to_string(list_slice(ws, i, i + 34), ' ') AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 33)) AS i FROM w WHERE len(ws) >= 35)),
 r AS (SELECT doc_id, i FROM s WHERE win IN (SELECT win FROM s GROUP BY win HAVING count(*) > 1)),
 g AS (SELECT DISTINCT doc_id, i + k AS p FROM r, (SELECT unnest(range(0, 35)) AS k)),
 a AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS p FROM w),
 k AS (SELECT a.doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY a.p) AS kept FROM a LEFT JOIN g ON a.doc_id = g.doc_id AND a.p = g.p WHERE g.p IS NULL GROUP BY 1)
 SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM w LEFT JOIN k USING (doc_id)"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
OP6 = f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents),
 s AS (SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 4), ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i FROM w WHERE len(ws) > 0)),
 n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
 o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
 l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 75 * (a.n + b.n - o)),
 e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
 reach AS (SELECT doc_id AS d, doc_id AS r FROM documents UNION SELECT reach.d, e.y FROM reach JOIN e ON e.x = reach.r)
 SELECT d AS doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r) AS component_id FROM reach LEFT JOIN n ON n.doc_id = d GROUP BY d"""

_TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
OP11 = f"""WITH t AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents),
 f AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
 n AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM f GROUP BY 1),
 c AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
 w AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, c GROUP BY term, docs),
 q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark) GROUP BY ALL),
 s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // terms)))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN f USING (term) JOIN n USING (doc_id), c GROUP BY 1, 2),
 r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0)
 SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""


def _op13(rounds: int = 10, k: int = 8, dims: int = 64) -> str:
    """Rounds of assignment and mean, one after the other."""
    near = "SELECT v.vec_id, v.x, {c}.c, {c}.x AS cx, CAST(list_sum([(p[1] - p[2]) * (p[1] - p[2]) for p in list_zip(v.x, {c}.x)]) AS BIGINT) AS d FROM v, {c} QUALIFY row_number() OVER (PARTITION BY v.vec_id ORDER BY d, {c}.c) = 1"
    steps = [
        f"v AS MATERIALIZED (SELECT vec_id, [CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT) for e in embedding] AS x FROM embeddings WHERE len(embedding) = {dims} AND len([e for e in embedding if e IS NULL OR isnan(e) OR isinf(e)]) = 0)",
        f"c0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY h) - 1 AS INTEGER) AS c, x FROM (SELECT sha256('3:' || CAST(vec_id AS VARCHAR)) AS h, x FROM v ORDER BY h LIMIT {k}))",
    ]
    for r in range(rounds):
        steps.append(f"a{r} AS MATERIALIZED ({near.format(c=f'c{r}')})")
        mean = f"SELECT c, list(m ORDER BY i) AS x FROM (SELECT c, i, CAST(floor(sum(y) / count(*)) AS BIGINT) AS m FROM (SELECT c, unnest(x) AS y, unnest(range({dims})) AS i FROM a{r}) GROUP BY c, i) GROUP BY c"
        steps.append(f"c{r + 1} AS MATERIALIZED (SELECT c{r}.c, coalesce(m.x, c{r}.x) AS x FROM c{r} LEFT JOIN ({mean}) m USING (c))")
    steps.append(f"z AS MATERIALIZED ({near.format(c=f'c{rounds}')})")
    return f"WITH {', '.join(steps)} SELECT vec_id, c AS cluster, d AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(cx, ',')) AS centroid_sha256 FROM z"


_QUINTETS = "[CAST('0x' || substr(h, 1 + 5 * i, 5) AS INTEGER) for i in range(8)]"
OP12 = f"""WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h, min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first FROM pages)
 SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes, array_to_string(flatten([[substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((v >> s) & 31), 1) for s in [15, 10, 5, 0]] for v in {_QUINTETS}]), '') AS payload_digest,
 CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to, CAST(NULL AS VARCHAR) AS issue FROM p"""


SQL = {"op6_jaccard_join": OP6, "op8_substring_dedup": OP8, "op11_best_position": OP11, "op12_warc": OP12, "op13_drift_clusters": _op13()}
