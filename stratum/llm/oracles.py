"""DuckDB SQL for the operators whose rows SQL can give; longer ones are put together from repeated parts."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

EXACT_DEDUP = f"""
    WITH d AS (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS h FROM documents),
    g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, h AS text_sha256 FROM d JOIN g USING (h)
"""


def crc32(text: str) -> str:
    """CRC-32 of an ASCII string, bit by bit."""
    codes = f"list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)"
    step = "list_reduce([xor(crc, code), 0, 0, 0, 0, 0, 0, 0, 0], lambda bits, turn: xor(bits >> 1, (bits & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda crc, code: {step}), 4294967295)"


def merkle(doc_levels: int = 8, lang_levels: int = 3) -> str:
    """Trees of up to 8**doc_levels documents per language and 8**lang_levels languages."""

    def field(column: str) -> str:
        return f"coalesce(strlen({column}::VARCHAR) || ':' || {column}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join([field('doc_id'), field('source'), field('lang'), field('n_chars'), field(text)])})"

    parts = [f"""
        n0 AS MATERIALIZED (
            SELECT doc_id, lang AS tree, leaf AS h, changed,
                row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n
            FROM (
                SELECT doc_id, lang, {leaf('text')} AS leaf,
                    CASE WHEN {crc32('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS changed
                FROM documents
            )
        )""", "d0 AS (SELECT doc_id, tree, i, h AS leaf, coalesce(changed, h) AS folded, '' AS proof FROM n0)"]

    def rise(nodes: str, docs: str, levels: int) -> None:
        for k in range(levels):
            parts.append(f"""
        {nodes}{k}s AS MATERIALIZED (
            SELECT tree, i, n,
                coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM {nodes}{k} WINDOW w AS (PARTITION BY tree, i // 8 ORDER BY i)
        )""")
            parts.append(f"""
        {nodes}{k + 1} AS MATERIALIZED (
            SELECT tree, i // 8 AS i, (max(n) + 7) // 8 AS n,
                CASE WHEN max(n) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY i)) END AS h
            FROM {nodes}{k} GROUP BY tree, i // 8
        )""")
            parts.append(f"""
        {docs}{k + 1} AS (
            SELECT d.* EXCLUDE (i, folded, proof), d.i // 8 AS i, proof || l || r AS proof,
                CASE WHEN n = 1 THEN folded ELSE sha256(l || folded || r) END AS folded
            FROM {docs}{k} d JOIN {nodes}{k}s s ON s.tree IS NOT DISTINCT FROM d.tree AND s.i = d.i
        )""")

    rise("n", "d", doc_levels)
    parts.append(f"""
        t0 AS MATERIALIZED (
            SELECT 'all' AS tree, tree AS name, h, row_number() OVER (ORDER BY tree NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM n{doc_levels}
        )""")
    parts.append(f"""
        u0 AS (
            SELECT doc_id, 'all' AS tree, leaf, t0.h AS subroot, t0.i AS i, folded, proof
            FROM d{doc_levels} d JOIN t0 ON t0.name IS NOT DISTINCT FROM d.tree
        )""")
    rise("t", "u", lang_levels)
    return "WITH " + ", ".join(parts) + f"""
        SELECT doc_id, leaf, subroot, t.h AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = t.h AS verified
        FROM u{lang_levels} JOIN t{lang_levels} t USING (tree)
    """


def clusters(k: int = 8, rounds: int = 10, dims: int = 64) -> str:
    """Integer k-means, every round spelt out; assignment compares each vector with each centroid."""
    parts = [f"""
        v AS MATERIALIZED (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dims}
        )""", f"""
        c0 AS MATERIALIZED (
            SELECT row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS cluster, v AS c FROM v
            QUALIFY row_number() OVER (ORDER BY sha256('3:' || vec_id), v) <= {k}
        )"""]
    for r in range(rounds + 1):
        parts.append(f"""
        a{r} AS MATERIALIZED (
            SELECT vec_id, v, (min(d * {k} + cluster) % {k})::INTEGER AS cluster, min(d) AS distance
            FROM (
                SELECT vec_id, v, cluster, list_sum(list_transform(list_zip(v, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
                FROM v CROSS JOIN c{r}
            ) GROUP BY vec_id, v
        )""")
        if r < rounds:
            parts.append(f"""
        m{r} AS (
            SELECT cluster, list((total - ((total % n + n) % n)) // n ORDER BY dim) AS c
            FROM (
                SELECT cluster, dim, sum(x)::BIGINT AS total, count(*) AS n
                FROM (SELECT cluster, unnest(v) AS x, unnest(range({dims})) AS dim FROM a{r}) GROUP BY cluster, dim
            ) GROUP BY cluster
        )""")
            parts.append(f"""
        c{r + 1} AS MATERIALIZED (SELECT cluster, coalesce(m.c, old.c) AS c FROM c{r} old LEFT JOIN m{r} m USING (cluster))""")
    return "WITH " + ", ".join(parts) + f"""
        SELECT vec_id, cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
            sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds} JOIN c{rounds} USING (cluster)
    """


#: The mix takes the first ``goal`` words of a source's shuffled line, repeated; here counted without a schedule.
MIXING = """
    WITH d AS MATERIALIZED (
        SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
            coalesce('0' || source, '1') AS s, substr(sha256('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS shuffle
        FROM documents
    ),
    source_sizes AS (SELECT s, sum(size)::BIGINT AS size, (row_number() OVER (ORDER BY s) - 1) % 3 + 1 AS weight FROM d GROUP BY s),
    -- filled up in the order in which sources reach three times their size
    ranked AS (
        SELECT s, size, weight, sum(size) OVER () AS whole,
            coalesce(sum(3 * size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_words,
            sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free_weights
        FROM source_sizes WINDOW w AS (ORDER BY 3 * size / weight, s)
    ),
    level AS (
        SELECT (whole - full_words)::DOUBLE AS words, free_weights::DOUBLE AS weights FROM ranked
        WHERE 3 * size * free_weights >= weight * (whole - full_words)
        ORDER BY 3 * size / weight, s LIMIT 1
    ),
    targets AS MATERIALIZED (
        SELECT s, size AS source_size, least(words * weight / weights, (3 * size)::DOUBLE) AS target,
            least(floor(least(words * weight / weights, (3 * size)::DOUBLE) + 0.5), 3 * size)::BIGINT AS goal
        FROM source_sizes CROSS JOIN level
    ),
    line AS (
        SELECT *, coalesce(sum(size) OVER (PARTITION BY s ORDER BY shuffle, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
        FROM d
    )
    SELECT doc_id, size, source_size, target,
        (sum(greatest(0, least(start + epoch * source_size + size, goal) - (start + epoch * source_size))))::BIGINT AS taken
    FROM line JOIN targets USING (s) CROSS JOIN (VALUES (0), (1), (2)) AS e (epoch)
    GROUP BY doc_id, s, shuffle, start, size, source_size, target
"""
