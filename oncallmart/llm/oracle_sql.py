"""DuckDB statements for the corpus queries, written from the contracts."""

# Words of a text, A-Z in lower case, and its distinct shingles of five words.
SHINGLES = r"""
    {name}_words AS (
        SELECT {id}, [x FOR x IN regexp_split_to_array(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[\x20\x09-\x0D]+') IF x <> ''] AS w
        FROM {name}),
    {name}_sets AS (
        SELECT {id}, list_distinct([array_to_string(w[i:i + 4], ' ')
            FOR i IN range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)]) AS s
        FROM {name}_words)"""

STATEMENTS = {
    "op3_near_dedup": "WITH RECURSIVE" + SHINGLES.format(name="documents", id="doc_id") + """,
    each AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM documents_sets),
    pairs AS (
        SELECT a.doc_id AS a, b.doc_id AS b FROM each a JOIN each b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
    reach(a, b) AS (
        SELECT doc_id, doc_id FROM documents
        UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
    parts AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
    SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents_sets JOIN parts USING (doc_id)""",
    "op4_token_rollup": r"""
    WITH counted AS (
        SELECT source, lang, text,
            len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS words,
            len(regexp_extract_all(coalesce(text, ''),
                '[^\x20-\x2F\x3A-\x40\x09-\x0D]+|[\x21-\x2F\x3A-\x40]')) AS pieces,
            doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS is_copy
        FROM documents)
    SELECT source, lang, 'words/1' AS tokenizer, 0::BIGINT AS docs, 0::BIGINT AS tokens
    FROM counted GROUP BY source, lang
    UNION ALL
    SELECT source, lang, 'words/2', sum((NOT is_copy)::INT)::BIGINT,
        sum(CASE WHEN is_copy THEN 0 ELSE pieces END)::BIGINT
    FROM counted GROUP BY source, lang""",
    "op8_decontamination": "WITH" + SHINGLES.format(name="documents", id="doc_id") + ","
    + SHINGLES.format(name="benchmark", id="item_id") + """,
    found AS (
        SELECT doc_id, unnest(s) AS g FROM documents_sets
        UNION SELECT doc_id, array_to_string(w[i:i + k - 1], ' ')
        FROM documents_words, (SELECT DISTINCT len(w) AS k FROM benchmark_words WHERE len(w) BETWEEN 1 AND 4),
            range(1, len(w) - k + 2) AS t(i)),
    wanted AS (SELECT item_id, len(s) AS n_item, unnest(s) AS g FROM benchmark_sets)
    SELECT doc_id, item_id, n_item::BIGINT AS n_item, count(*)::BIGINT AS n_shared,
        count(*)::DOUBLE / n_item AS containment
    FROM found JOIN wanted USING (g) GROUP BY doc_id, item_id, n_item
    HAVING 100 * count(*) >= 80 * n_item""",
    "op9_url_verdicts": r"""
    WITH parts AS (
        SELECT page_id,
            translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path
        FROM (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) END AS rest
              FROM pages)),
    judged AS (
        SELECT *, CASE
            WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/' END AS rule
        FROM parts)
    SELECT page_id, host, path, rule, CASE
        WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
        WHEN rule IS NOT NULL THEN 'allow'
        WHEN host LIKE 'spam-farm.%' OR host LIKE '%.spam-farm.%' THEN 'block'
        ELSE 'allow' END AS verdict
    FROM judged""",
}

# Every part of every whole vector as integers, and the first codebooks.
VECTOR_PARTS = """
    whole AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: NOT coalesce(isfinite(x), false))) = 0),
    parts AS MATERIALIZED (
        SELECT vec_id, label, p, v[p * len(v) // 4 + 1:(p + 1) * len(v) // 4] AS x FROM whole, range(4) AS t(p)),
    book0 AS MATERIALIZED (
        SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, x AS c
        FROM parts QUALIFY row_number() OVER (PARTITION BY p ORDER BY vec_id) <= 256)"""
NEAREST = """,
    near{r} AS MATERIALIZED (
        SELECT vec_id, label, p, x, min({{'d': d, 'k': k}}) AS best
        FROM (SELECT vec_id, label, p, x, k,
                  list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) AS d
              FROM parts JOIN book{r} USING (p))
        GROUP BY ALL)"""
MOVED = """,
    book{n} AS MATERIALIZED (
        SELECT b.p, b.k, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
            SELECT p, k, list(mean ORDER BY i) AS c FROM (
                SELECT p, best.k AS k, i, floor(sum(x[i])::DOUBLE / count(*))::BIGINT AS mean
                FROM near{r}, unnest(range(1, len(x) + 1)) AS u(i) GROUP BY ALL)
            GROUP BY ALL) m USING (p, k))"""
STATEMENTS["op11_vector_codes"] = (
    "WITH" + VECTOR_PARTS + "".join(NEAREST.format(r=r) + MOVED.format(r=r, n=r + 1) for r in range(4))
    + NEAREST.format(r=4) + """,
    coded AS (
        SELECT vec_id, label, string_agg(printf('%02x', best.k), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
        FROM near4 GROUP BY vec_id, label)
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
        (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, k)) FROM book4) AS codebooks_sha256
    FROM coded"""
)

STATEMENTS["op12_filter_audit"] = r"""
    WITH marked AS (
        SELECT coalesce(lang, '') AS part, coalesce(text, '') AS t,
            regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
            coalesce(doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')), false) AS is_copy,
            coalesce(doc_id IN (SELECT doc_id FROM labels WHERE quality = 1), false) AS good,
            coalesce(doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1), false) AS toxic
        FROM documents),
    failed AS (
        SELECT part, good, toxic,
            (CASE WHEN len(w) < 200 THEN 'A' ELSE '' END)
            || (CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END)
            || (CASE WHEN 100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * len(t) THEN 'C' ELSE '' END)
            || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
            || (CASE WHEN is_copy THEN 'E' ELSE '' END) AS fails
        FROM marked),
    counted AS (
        SELECT part, fails, count(*) AS n, sum(good::INT) AS good, sum(toxic::INT) AS toxic FROM failed GROUP BY ALL),
    letter(f) AS (SELECT unnest(['A', 'B', 'C', 'D', 'E'])),
    orders AS (
        SELECT a.f || b.f || c.f || d.f || e.f AS o FROM letter a, letter b, letter c, letter d, letter e
        WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5),
    steps AS (SELECT o, s::INT AS s, o[s:s] AS f, o[1:s - 1] AS earlier FROM orders, range(1, 6) AS t(s)),
    each AS (
        SELECT part, o, s, f,
            coalesce(sum(n) FILTER (late AND NOT fails_f), 0) AS kept, coalesce(sum(n) FILTER (late AND fails_f), 0) AS removed,
            coalesce(sum(n) FILTER (NOT late AND fails_f), 0) AS redundant, coalesce(sum(n) FILTER (fails = f), 0) AS unique_fails,
            coalesce(sum(good) FILTER (late AND fails_f), 0) AS good_lost,
            coalesce(sum(toxic) FILTER (late AND fails_f), 0) AS toxic_lost
        FROM (SELECT *, contains(fails, f) AS fails_f,
                  translate(fails, earlier, '') = fails AS late FROM counted, steps)
        GROUP BY part, o, s, f)
    SELECT part, o AS filter_order, s AS step, kept::BIGINT AS kept, removed::BIGINT AS removed,
        redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost,
        toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
    FROM each"""
