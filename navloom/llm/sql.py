"""The same results in SQL, where SQL can express them."""

EXACT_DEDUP = r"""
    WITH texts AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t
        FROM documents
    )
    SELECT
        doc_id,
        min(doc_id) OVER (PARTITION BY t) AS keep_id,
        count(*) OVER (PARTITION BY t) AS group_size,
        doc_id = min(doc_id) OVER (PARTITION BY t) AS kept,
        sha256(t) AS text_sha256
    FROM texts
"""

TOP_K = """
    WITH whole AS (
        SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) > 0
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    scored AS (
        SELECT
            q.vec_id AS query_id,
            c.vec_id,
            CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
        FROM whole AS q JOIN whole AS c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
    ),
    ranked AS (
        SELECT *, CAST(row_number() OVER (
            PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
        FROM scored
    )
    SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

URL_FILTER = r"""
    WITH RECURSIVE cut AS (
        SELECT page_id, CASE WHEN contains(url, '://')
            THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
        FROM pages
    ),
    parts AS (
        SELECT page_id,
            translate(regexp_extract(rest, '^[^/?#]*'),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
        FROM cut
    ),
    ruled AS (
        SELECT *,
            CASE WHEN host = 'example.net' OR host LIKE '%.example.net' THEN
                    CASE WHEN path LIKE '/en/%' THEN 'example.net/en/' WHEN path LIKE '/%' THEN 'net/' END
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%'
                    THEN 'example.com/de/'
                WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
                WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
            list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''),
                lambda s: regexp_replace(s, '[0-9]+', '*', 'g')) AS shape
        FROM parts
    ),
    rows_ AS (
        SELECT *, CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow' END AS by_rule
        FROM ruled
    ),
    shapes AS (
        SELECT host, shape, count(*) AS n, count(by_rule) AS l, count(*) FILTER (by_rule = 'block') AS b
        FROM rows_ GROUP BY ALL
    ),
    tree AS (
        SELECT host, shape, n, l, b, CAST([] AS VARCHAR[]) AS done, shape AS rest FROM shapes
        UNION ALL
        SELECT host, shape, n, l, b, done, rest FROM (
            WITH open_ AS (SELECT *, rest[1] AS own FROM tree WHERE len(rest) > 0),
            branch AS (
                SELECT host, done, own, sum(n) AS n, sum(l) AS l, sum(b) AS b FROM open_ GROUP BY ALL
            ),
            whole AS (
                SELECT *, count(*) OVER w > 16 AND n < 0.05 * sum(n) OVER w AS rare,
                    (b + 4.0 * (sum(b) OVER w / sum(l) OVER w)) / (l + 4.0) AS smoothed
                FROM branch WINDOW w AS (PARTITION BY host, done)
            ),
            pairs AS (
                SELECT *, lag(l) OVER w AS l0, lag(b) OVER w AS b0
                FROM whole WHERE NOT rare AND l > 0
                WINDOW w AS (PARTITION BY host, done ORDER BY smoothed, own)
            ),
            cuts AS (
                SELECT *, CASE WHEN abs(b / l - b0 / l0) > 2.0 * sqrt((b + b0) / (l + l0)
                    * (1 - (b + b0) / (l + l0)) * (1 / l + 1 / l0)) THEN 1 ELSE 0 END AS apart
                FROM pairs
            ),
            runs AS (
                SELECT *, sum(apart) OVER (PARTITION BY host, done ORDER BY smoothed, own) AS run FROM cuts
            ),
            named AS (
                SELECT host, done, own, CASE WHEN count(*) OVER w > 1 THEN min(own) OVER w || '/' ELSE own END AS new
                FROM runs WINDOW w AS (PARTITION BY host, done, run)
                UNION ALL
                SELECT host, done, own, CASE WHEN rare THEN '*' ELSE own END FROM whole WHERE rare OR l = 0
            )
            SELECT o.host, shape, n, l, b, list_append(done, new) AS done, rest[2:] AS rest
            FROM open_ AS o JOIN named USING (host, done, own)
        )
    ),
    judged AS (
        SELECT *,
            sum(l) OVER t AS tl, sum(b) OVER t AS tb, sum(l) OVER f AS fl, sum(b) OVER f AS fb,
            coalesce(sum(b) OVER () / nullif(sum(l) OVER (), 0), 0) AS overall
        FROM tree WHERE len(rest) = 0
        WINDOW t AS (PARTITION BY host, done), f AS (PARTITION BY shape[1])
    )
    SELECT r.page_id, r.host, r.path, r.rule,
        coalesce(r.by_rule, CASE WHEN (tb + 4.0 * ((fb + 4.0 * overall) / (fl + 4.0))) / (tl + 4.0) >= 0.5
            THEN 'block' ELSE 'allow' END) AS verdict
    FROM rows_ AS r JOIN judged AS j ON r.host = j.host AND r.shape = j.shape
"""

DECONTAMINATION = r"""
    WITH docs AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ),
    items AS (
        SELECT coalesce(CAST(item_id AS VARCHAR), '') AS name, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ),
    starts AS (SELECT name, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM items WHERE len(w) > 0),
    windows AS (SELECT DISTINCT name, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM starts),
    places AS (
        SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i
        FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m
    ),
    met AS (
        SELECT r, p.m, i, name FROM places AS p JOIN windows AS x
            ON p.m = x.m AND array_to_string(p.w[p.i:p.i + p.m - 1], ' ') = x.phrase
    ),
    hits AS (SELECT r, count(DISTINCT k) AS n FROM (SELECT r, unnest(range(i, i + m)) AS k FROM met) GROUP BY r),
    named AS (SELECT r, count(*) AS n, string_agg(name, ',' ORDER BY name) AS names
        FROM (SELECT DISTINCT r, name FROM met) GROUP BY r)
    SELECT doc_id, len(w) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(x.n, 0) AS n_items,
        sha256(coalesce(names, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
    FROM docs LEFT JOIN hits AS h USING (r) LEFT JOIN named AS x USING (r)
"""

CLUSTERS = """
    WITH kept AS MATERIALIZED (
        SELECT row_number() OVER () AS r, vec_id,
            list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(embedding) = 64
            AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    hashed AS (SELECT v, sha256('3:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept),
    centroids0 AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM (FROM hashed ORDER BY h, v LIMIT 8)
    ),
"""
CLUSTERS += "".join(
    f"""
    assigned{n} AS MATERIALIZED (
        SELECT r, vec_id, k.v, min({{'d': CAST(list_sum(list_transform(list_zip(k.v, c.v),
            lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS BIGINT), 'c': c.c}}) AS best
        FROM kept AS k, centroids{n} AS c GROUP BY ALL
    ),
    sums{n} AS (
        SELECT best.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM assigned{n}, range(1, 65) AS t(i) GROUP BY ALL
    ),
    centroids{n + 1} AS MATERIALIZED (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM sums{n} GROUP BY c
        UNION ALL SELECT c, v FROM centroids{n} WHERE c NOT IN (SELECT c FROM sums{n})
    ),"""
    for n in range(11)
)
CLUSTERS += """
    last AS (SELECT vec_id, best.c AS c, best.d AS d FROM assigned10)
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, d AS distance,
        CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
        sha256(array_to_string(v, ',')) AS centroid_sha256
    FROM last JOIN centroids10 USING (c)
"""

COLLOCATIONS = r"""
    WITH pieces AS (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    ),
    words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
    totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
    places AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM words, range(1, 6) AS t(k) WHERE len(w) >= k),
    counts AS (
        SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
        FROM places GROUP BY ALL HAVING count(*) >= 100
    ),
    cuts AS (
        SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM counts WHERE k > 1
    ),
    scored AS (
        SELECT c.lang, c.phrase, c.a, cut, l.a AS l, r.a AS r, n,
            CAST(CAST(1000 AS HUGEINT) * c.a * n // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
        FROM cuts AS c
        JOIN counts AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:cut], ' ')
        JOIN counts AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[cut + 1:], ' ')
        JOIN totals AS t ON t.lang = c.lang
    ),
    lowest AS (
        FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1
    ),
    left_ AS (
        FROM lowest AS s WHERE NOT EXISTS (
            FROM counts AS x WHERE x.lang = s.lang AND x.a >= s.a AND x.phrase <> s.phrase
                AND contains(' ' || x.phrase || ' ', ' ' || s.phrase || ' '))
    ),
    ranked AS (
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
            phrase, a, l, r, n, score
        FROM left_
    )
    FROM ranked WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op3_exact_dedup": EXACT_DEDUP,
    "op6_url_filter": URL_FILTER,
    "op9_top_k": TOP_K,
    "op11_decontamination": DECONTAMINATION,
    "op12_clusters": CLUSTERS,
    "op13_collocations": COLLOCATIONS,
}
