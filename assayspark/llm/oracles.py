"""DuckDB SQL of the registered queries that SQL can express."""

from __future__ import annotations

from assayspark.llm.licenses import BASE_PHRASES, PASSAGES, PERCENT, word_list

#: Components as whole numbers, from the vectors that are kept.
_WHOLE = """kept AS MATERIALIZED (
    SELECT vec_id, label, [floor({factor} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0{more}
)"""
_PLAIN_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4, factor: int = 1024) -> str:
    steps = [
        _WHOLE.format(factor=factor, more=""),
        f"""cells AS MATERIALIZED (
    SELECT vec_id, (d - 1) // (len(v) // {parts}) AS part, (d - 1) % (len(v) // {parts}) AS place, v[d] AS x
    FROM (SELECT vec_id, v, unnest(range(1, len(v) + 1)) AS d FROM kept)
)""",
        f"""book0 AS MATERIALIZED (
    SELECT part, row_number() OVER (PARTITION BY part, place ORDER BY vec_id) - 1 AS entry, place, x FROM cells
    WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT {entries})
)""",
    ]
    for k in range(rounds + 1):
        steps.append(f"""near{k} AS MATERIALIZED (
    SELECT vec_id, part, min((dist, entry)) AS best FROM (
        SELECT c.vec_id, c.part, b.entry, sum((c.x - b.x) * (c.x - b.x))::BIGINT AS dist
        FROM cells c JOIN book{k} b ON c.part = b.part AND c.place = b.place GROUP BY ALL
    ) GROUP BY ALL
)""")
        if k < rounds:
            steps.append(f"""book{k + 1} AS MATERIALIZED (
    SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
        SELECT c.part, n.best[2] AS entry, c.place, floor(sum(c.x)::DOUBLE / count(*))::BIGINT AS x
        FROM cells c JOIN near{k} n ON c.vec_id = n.vec_id AND c.part = n.part GROUP BY ALL
    ) m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place
)""")
    return f"""WITH {", ".join(steps)}, coded AS (
    SELECT vec_id, string_agg(lpad(lower(to_hex(best[2])), 2, '0'), '' ORDER BY part) AS code, sum(best[1])::BIGINT AS error
    FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
    (SELECT sha256(string_agg(x::VARCHAR, ',' ORDER BY part, entry, place)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


def _centroid_clusters(centroids: int = 40, dimensions: int = 64, rounds: int = 5, factor: int = 256, seed: int = 2) -> str:
    steps = [
        _WHOLE.format(factor=factor, more=f" AND len(embedding) = {dimensions}"),
        "cells AS MATERIALIZED (SELECT vec_id, unnest(range(1, len(v) + 1)) AS place, unnest(v) AS x FROM kept)",
        f"""drawn AS MATERIALIZED (
    SELECT vec_id, row_number() OVER (ORDER BY sha256('{seed}:' || vec_id)) - 1 AS k FROM kept ORDER BY k LIMIT {centroids}
)""",
        "centre0 AS MATERIALIZED (SELECT k, place, x FROM drawn JOIN cells USING (vec_id))",
    ]
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
    SELECT vec_id, min((dist, k)) AS best FROM (
        SELECT c.vec_id, m.k, sum((c.x - m.x) * (c.x - m.x))::BIGINT AS dist
        FROM cells c JOIN centre{r} m ON c.place = m.place GROUP BY ALL
    ) GROUP BY ALL
)""")
        if r < rounds:
            steps.append(f"""centre{r + 1} AS MATERIALIZED (
    SELECT m.k, m.place, coalesce(n.x, m.x) AS x FROM centre{r} m LEFT JOIN (
        SELECT a.best[2] AS k, c.place, floor(sum(c.x)::DOUBLE / count(*))::BIGINT AS x
        FROM cells c JOIN near{r} a USING (vec_id) GROUP BY ALL
    ) n ON m.k = n.k AND m.place = n.place
)""")
    return f"""WITH {", ".join(steps)}, digests AS (
    SELECT k, sha256(string_agg(x::VARCHAR, ',' ORDER BY place)) AS centroid_sha256 FROM centre{rounds} GROUP BY k
)
SELECT vec_id, best[2]::INTEGER AS cluster, best[1] AS distance,
    (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia, (sum(best[1]) OVER ())::BIGINT AS inertia,
    centroid_sha256
FROM near{rounds} JOIN digests ON best[2] = k"""


def _license_scan() -> str:
    rows = []
    for number, (label, text, key, based) in enumerate(
        [(p.label, p.text, p.key, False) for p in PASSAGES] + [(b, p, p, True) for p, b in BASE_PHRASES.items()]
    ):
        found, wanted = word_list(text), word_list(key)
        at = next(k for k in range(len(found)) if found[k:k + len(wanted)] == wanted)
        need = len(found) if based else -(-len(found) * PERCENT // 100)
        rows += [
            f"({number}, '{label}', {based}, {len(found)}, {need}, {len(wanted)}, {k}, '{w}', {at <= k < at + len(wanted)})"
            for k, w in enumerate(found)
        ]
    return f"""WITH passages(number, label, based, size, need, keys, place, word, is_key) AS (VALUES {", ".join(rows)}),
split AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_LOWER}, '{_PLAIN_WORD}') AS w FROM documents),
words AS (SELECT doc_id, len(w) AS n_words, unnest(range(len(w))) AS at, unnest(w) AS word FROM split),
found AS (
    SELECT doc_id, label, based, w.at - p.place AS first, count(*) / size AS share
    FROM words w JOIN passages p USING (word)
    WHERE w.at - p.place >= 0 AND w.at - p.place + size <= n_words
    GROUP BY doc_id, number, label, based, size, need, keys, first
    HAVING count(*) >= need AND count(*) FILTER (is_key) = keys
),
summed AS (
    SELECT doc_id, count(*) FILTER (based) AS n_base, min(first) FILTER (based) AS first_word,
        max(first) FILTER (based) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) FILTER (based) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM found GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
    last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(score, 0)::DOUBLE AS score
FROM split LEFT JOIN summed USING (doc_id)"""


#: Nodes of ``edges (a, b)``, which has both directions, with the smallest node they reach.
_REACH = """reach(node, other) AS (
    SELECT DISTINCT a, a FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON e.a = r.other
), component AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)"""


def _near_vectors() -> str:
    return f"""WITH RECURSIVE usable AS MATERIALIZED (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        AND len([x FOR x IN embedding IF x <> 0]) > 0
), edges AS MATERIALIZED (
    SELECT l.vec_id AS a, r.vec_id AS b FROM usable l JOIN usable r ON l.label = r.label AND l.vec_id <> r.vec_id AND len(l.v) = len(r.v)
    WHERE list_cosine_similarity(l.v, r.v) >= 0.98
), {_REACH}
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
    coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN component ON node = vec_id LEFT JOIN (SELECT a, count(*) AS n FROM edges GROUP BY a) ON a = vec_id"""


def _jaccard_join(size: int = 3, percent: int = 90) -> str:
    word = "[^\\x20\\x09-\\x0D]+"
    return f"""WITH RECURSIVE split AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{word}') AS w FROM documents),
sets AS MATERIALIZED (
    SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + {size - 1}], ' ') FOR i IN range(1, len(w) - {size - 2})] END) AS s FROM split
), cells AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
edges AS MATERIALIZED (
    SELECT l.doc_id AS a, r.doc_id AS b FROM cells l JOIN cells r ON l.shingle = r.shingle AND l.doc_id <> r.doc_id
        AND 100 * l.n >= {percent} * r.n AND 100 * r.n >= {percent} * l.n
    GROUP BY l.doc_id, r.doc_id, l.n, r.n HAVING 100 * count(*) >= {percent} * (l.n + r.n - count(*))
), {_REACH}
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(n, 0)::BIGINT AS n_links, coalesce(component_id, doc_id) AS component_id
FROM sets LEFT JOIN component ON node = doc_id LEFT JOIN (SELECT a, count(*) AS n FROM edges GROUP BY a) ON a = doc_id"""


def _suffix_dedup(length: int = 50, chunk: int = 2000) -> str:
    return f"""WITH hexed AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
chunks AS (
    SELECT doc_id, c * {chunk} AS base, substr(h, 2 * c * {chunk} + 1, 2 * ({chunk} + {length - 1})) AS h
    FROM (SELECT doc_id, h, unnest(range(0, len(h) // {2 * chunk} + 1)) AS c FROM hexed)
), windows AS MATERIALIZED (
    SELECT doc_id, base + i AS start, substr(h, 2 * i + 1, {2 * length}) AS w
    FROM (SELECT doc_id, base, h, unnest(range(0, len(h) // 2 - {length - 1})) AS i FROM chunks)
), first AS (SELECT w, min(doc_id) AS least FROM windows GROUP BY w),
gone AS (SELECT doc_id, start FROM windows JOIN first USING (w) WHERE doc_id > least),
runs AS (
    SELECT doc_id, min(start) AS low, max(start) + {length} AS high FROM (
        SELECT doc_id, start, sum(fresh) OVER (PARTITION BY doc_id ORDER BY start) AS run FROM (
            SELECT doc_id, start,
                (coalesce(start > lag(start) OVER (PARTITION BY doc_id ORDER BY start) + {length}, TRUE))::INT AS fresh
            FROM gone))
    GROUP BY doc_id, run
), pieces AS (
    SELECT doc_id, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS a, low AS b FROM runs
    UNION ALL SELECT doc_id, max(high), NULL FROM runs GROUP BY doc_id
), kept AS (
    SELECT doc_id, string_agg(substr(h, 2 * a + 1, 2 * (coalesce(b, len(h) // 2) - a)), '' ORDER BY a) AS k
    FROM pieces JOIN hexed USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
    sha256(unhex(coalesce(k, h))) AS kept_sha256
FROM hexed LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, sum(high - low) AS n_removed, count(*) AS n_spans FROM runs GROUP BY doc_id) USING (doc_id)"""


ORACLES: dict[str, str] = {
    "op2_near_vectors": _near_vectors(),
    "op3_jaccard_join": _jaccard_join(),
    "op7_suffix_dedup": _suffix_dedup(),
    "op11_vector_codes": _vector_codes(),
    "op12_license_scan": _license_scan(),
    "op13_centroid_clusters": _centroid_clusters(),
}
