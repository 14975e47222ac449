"""DuckDB statements for the queries that SQL can express, written as brute force."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# every string of 200 bytes (in hex, cut from chunks of 250 starts), those that start at two places, the bytes they cover
REPEATS = """
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
    chunk AS (SELECT r, base, substr(x, 2 * base + 1, 900) AS part, length(x) // 2 AS n
              FROM (SELECT *, unnest(range(0, length(x) // 2, 250)) AS base FROM d)),
    place AS (SELECT r, base + j AS p, md5_number(substr(part, 2 * j + 1, 400)) AS name
              FROM (SELECT *, unnest(range(250)) AS j FROM chunk) WHERE base + j + 200 <= n),
    again AS (SELECT name FROM place GROUP BY name HAVING count(*) > 1),
    start AS (SELECT r, p, lag(p) OVER (PARTITION BY r ORDER BY p) AS q FROM place SEMI JOIN again USING (name)),
    run AS (SELECT r, p, sum(CASE WHEN q IS NULL OR p > q + 200 THEN 1 ELSE 0 END) OVER (PARTITION BY r ORDER BY p) AS k FROM start),
    span AS (SELECT r, min(p) AS s, max(p) + 200 AS e FROM run GROUP BY r, k),
    gap AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) AS s, s AS e, false AS tail FROM span
            UNION ALL SELECT r, max(e), NULL, true FROM span GROUP BY r),
    kept AS (SELECT r, string_agg(CASE WHEN tail THEN substr(x, 2 * s + 1) ELSE substr(x, 2 * s + 1, 2 * (e - s)) END, '' ORDER BY s, tail) AS x
             FROM gap JOIN d USING (r) GROUP BY r),
    total AS (SELECT r, sum(e - s) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
    SELECT doc_id, CAST(length(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.x, d.x))) AS kept_sha256
    FROM d LEFT JOIN kept USING (r) LEFT JOIN total USING (r)"""

# every run of as many words as a window has, against the windows
LEAKS = rf"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS low FROM documents),
    cut AS (SELECT r, doc_id, regexp_extract_all(low, '{WORD}') AS words, string_split_regex(low, '{WORD}') AS gaps FROM d),
    w AS (SELECT r, unnest(words) AS word, unnest(range(len(words))) AS k, unnest(gaps[1:len(words)]) AS gap FROM cut),
    placed AS (SELECT r, k, word, sum(length(gap) + length(word)) OVER (PARTITION BY r ORDER BY k) AS e FROM w),
    item AS (SELECT CAST(item_id AS VARCHAR) AS i, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS words
             FROM benchmark WHERE item_id IS NOT NULL),
    win AS (SELECT DISTINCT i, least(len(words), 10) AS n, array_to_string(words[k + 1:k + 10], ' ') AS t
            FROM (SELECT *, unnest(range(greatest(1, len(words) - 9))) AS k FROM item WHERE len(words) > 0)),
    size AS (SELECT DISTINCT n FROM win),
    seen AS (SELECT r, k, n, string_agg(word, ' ') OVER (PARTITION BY r, n ORDER BY k ROWS BETWEEN CURRENT ROW AND n - 1 FOLLOWING) AS t
             FROM w CROSS JOIN size),
    found AS (SELECT r, k, n, i FROM seen JOIN win USING (n, t)),
    ids AS (SELECT r, count(DISTINCT i) AS n_items, sha256(string_agg(DISTINCT i, ',' ORDER BY i)) AS items_sha256 FROM found GROUP BY r),
    hit AS (SELECT DISTINCT r, k + j AS k FROM (SELECT r, k, unnest(range(n)) AS j FROM found)),
    run AS (SELECT r, k, word, e, k - row_number() OVER (PARTITION BY r ORDER BY k) AS island FROM hit JOIN placed USING (r, k)),
    span AS (SELECT r, count(*) AS n, min(e - length(word)) AS s, max(e) AS e FROM run GROUP BY r, island),
    spans AS (SELECT r, sum(n) AS n_hit, string_agg(s || ':' || e, ',' ORDER BY s) AS hit_spans FROM span GROUP BY r)
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, coalesce(n_items, 0) AS n_items,
           coalesce(items_sha256, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(hit_spans, '') AS hit_spans
    FROM cut LEFT JOIN ids USING (r) LEFT JOIN spans USING (r)"""

# texts with their white space as single blanks
COPIES = r"""
    WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
         g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
    SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
    FROM n JOIN g ON n.t = g.t"""

# every document at every step of every order
AUDIT = r"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d),
    f AS (SELECT r, part, doc_id, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
                 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
                 coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e,
                 doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM w),
    fails AS (SELECT *, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END)
                        || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS failed FROM f),
    letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
    orders AS (SELECT v.l || w.l || x.l || y.l || z.l AS o FROM letter v, letter w, letter x, letter y, letter z
               WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5),
    steps AS (SELECT o, s, substr(o, s, 1) AS l, substr(o, 1, s - 1) AS before FROM orders, range(1, 6) AS t(s)),
    seen AS (SELECT part, o, s, l, failed, contains(failed, l) AS fails, good, toxic,
                    len(list_intersect(string_split(before, ''), string_split(failed, ''))) > 0 AND before <> '' AND failed <> '' AS gone
             FROM fails, steps),
    counts AS (SELECT part, o AS filter_order, CAST(s AS INTEGER) AS step, l, count(*) FILTER (NOT gone AND NOT fails) AS kept,
                      count(*) FILTER (NOT gone AND fails) AS removed, count(*) FILTER (gone AND fails) AS redundant,
                      count(*) FILTER (failed = l) AS unique_fails, count(*) FILTER (NOT gone AND fails AND good) AS good_lost,
                      count(*) FILTER (NOT gone AND fails AND toxic) AS toxic_lost FROM seen GROUP BY ALL)
    SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
           CAST(sum(removed) OVER (PARTITION BY part, l) AS BIGINT) AS shapley FROM counts"""



def clusters(k: int = 16, rounds: int = 3) -> str:
    """Every distance in every round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
    far{r} AS (SELECT x.r, c.c, sum((x.x - c.x) * (x.x - c.x)) AS d FROM x JOIN c{r} AS c USING (i) GROUP BY x.r, c.c),
    near{r} AS (SELECT r, c, d FROM far{r} QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1),
    mean{r} AS (SELECT c, i, sum(x) AS s, count(*) AS n FROM near{r} JOIN x USING (r) GROUP BY c, i),
    c{r + 1} AS (SELECT c, i, coalesce((s - ((s % n) + n) % n) // n, c{r}.x) AS x FROM c{r} LEFT JOIN mean{r} USING (c, i))""")
    return f"""
    WITH v AS (SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings),
    e AS (SELECT r, vec_id, unnest(embedding) AS y, unnest(range(len(embedding))) AS i FROM v WHERE len(embedding) = 64),
    kept AS (SELECT r, vec_id FROM e GROUP BY r, vec_id HAVING count(y) = 64 AND bool_and(isfinite(y))),
    x AS (SELECT r, i, CAST(floor(64 * CAST(y AS DOUBLE)) AS HUGEINT) AS x FROM e WHERE r IN (SELECT r FROM kept)),
    lists AS (SELECT r, list(x ORDER BY i) AS l FROM x GROUP BY r),
    start AS (SELECT r, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), '')), l) - 1 AS c FROM kept JOIN lists USING (r)
              QUALIFY c < {k}),
    c0 AS (SELECT c, i, x FROM x JOIN start USING (r)),{",".join(steps)},
    name AS (SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY c)
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM near{rounds} JOIN kept USING (r) JOIN name USING (c)"""


SQL = {"op2_repeats": REPEATS, "op7_decontamination": LEAKS, "op8_exact_dedup": COPIES, "op11_filter_audit": AUDIT,
       "op12_centroids": clusters()}
