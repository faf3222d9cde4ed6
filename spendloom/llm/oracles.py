"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def clustering(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3) -> str:
    steps = [
        f"""v AS MATERIALIZED (
            SELECT row_number() OVER () AS r, vec_id,
                list_transform(embedding, lambda x: floor({scale}.0::DOUBLE * x::DOUBLE)::BIGINT) AS q
            FROM embeddings
            WHERE len(embedding) = {dims}
                AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"""c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('{seed}:' || vec_id), q) - 1 AS j, q
            FROM v QUALIFY j < {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (
            SELECT r, min(d * {k} + j) % {k} AS j, min(d * {k} + j) // {k} AS d
            FROM (SELECT v.r, c.j,
                    list_sum(list_transform(list_zip(v.q, c.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
                FROM v, c{i} AS c)
            GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (
            SELECT c.j, coalesce(m.q, c.q) AS q
            FROM c{i} AS c LEFT JOIN (
                SELECT j, list(floor_mean ORDER BY i) AS q
                FROM (SELECT j, i, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*))::BIGINT // count(*) AS floor_mean
                    FROM (SELECT a.j, unnest(v.q) AS x, unnest(range({dims})) AS i FROM a{i} AS a JOIN v USING (r))
                    GROUP BY j, i)
                GROUP BY j) AS m USING (j))"""
            )
    return f"""WITH {", ".join(steps)}
        SELECT vec_id, j AS cluster, d AS distance, (sum(d) OVER (PARTITION BY j))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c.q, ',')) AS centroid_sha256
        FROM a{rounds} JOIN v USING (r) JOIN c{rounds} AS c USING (j)"""


def resampling(percent: int = 10, least_words: int = 20, buckets: int = 10_000, seed: int = 2024) -> str:
    word = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    # The remainder of a byte by the reversed polynomial; then a word's bytes one after the other.
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"""WITH crc AS MATERIALIZED (
            SELECT list(list_reduce(list_prepend(b, range(8)), lambda c, i: {step}) ORDER BY b) AS t FROM range(256) AS x(b)),
        docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id,
                regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', lower('{UPPER}')), '{word}') AS words
            FROM documents),
        raw AS (SELECT r, unnest(words) AS w FROM docs),
        target AS (
            SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', lower('{UPPER}')), '{word}')) AS w
            FROM benchmark),
        bytes AS (
            SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM raw UNION SELECT w FROM target)),
        bucket AS MATERIALIZED (
            SELECT w, xor(list_reduce(
                list_prepend(4294967295, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::BIGINT)),
                lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % {buckets} AS b
            FROM bytes, crc),
        s AS (SELECT b, count(*) AS n FROM raw JOIN bucket USING (w) GROUP BY b),
        t AS (SELECT b, count(*) AS n FROM target JOIN bucket USING (w) GROUP BY b),
        gain AS MATERIALIZED (
            SELECT b, floor(1000 * ln((coalesce(t.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM s) + {buckets})
                / ((coalesce(s.n, 0) + 1)::DOUBLE * ((SELECT coalesce(sum(n), 0) FROM t) + {buckets}))))::BIGINT AS g
            FROM s FULL JOIN t USING (b)),
        weight AS (
            SELECT r, sum(g)::BIGINT AS weight FROM raw JOIN bucket USING (w) JOIN gain USING (b) GROUP BY r),
        scored AS (
            SELECT doc_id, len(words) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{seed}:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
                    / 4294967296.0::DOUBLE)))::BIGINT AS score
            FROM docs LEFT JOIN weight USING (r)),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY n_features >= {least_words} ORDER BY score DESC, doc_id, n_features) AS place
            FROM scored)
        SELECT doc_id, n_features, weight, score,
            CASE WHEN n_features >= {least_words}
                AND place <= {percent} * (SELECT count(*) FROM scored WHERE n_features >= {least_words}) // 100
                THEN place END AS rank
        FROM ranked"""


def near_duplicates(shingle: int = 4, percent: int = 80) -> str:
    return rf"""WITH RECURSIVE docs AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), '{UPPER}', lower('{UPPER}')), '[^\x20\x09-\x0D]+') AS words
            FROM documents),
        sets AS MATERIALIZED (
            SELECT r, doc_id, CASE WHEN len(words) = 0 THEN []
                WHEN len(words) < {shingle} THEN [array_to_string(words, ' ')]
                ELSE list_distinct(list_transform(range(1, len(words) - {shingle - 2}),
                    lambda i: array_to_string(words[i : i + {shingle - 1}], ' '))) END AS shingles
            FROM docs),
        cells AS MATERIALIZED (SELECT r, len(shingles) AS n, unnest(shingles) AS s FROM sets),
        links AS MATERIALIZED (
            SELECT x.r AS a, y.r AS b FROM cells AS x JOIN cells AS y ON x.s = y.s AND x.r <> y.r
            GROUP BY x.r, y.r, x.n, y.n HAVING 100 * count(*) >= {percent} * (x.n + y.n - count(*))),
        reach AS (
            SELECT r, r AS c FROM sets UNION SELECT reach.r, links.b FROM reach JOIN links ON links.a = reach.c),
        least AS (SELECT reach.r, min(sets.doc_id) AS component_id FROM reach JOIN sets ON sets.r = reach.c GROUP BY reach.r)
        SELECT doc_id, len(shingles) AS n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept
        FROM sets JOIN least USING (r)"""
