"""DuckDB SQL of the training-data queries that SQL can state: plain definitions, of quadratic work where the operators' is not."""

_WORD = r"[^\x20\x09-\x0D]+"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# links(a, b) in both directions, of(id) -> the smallest id within reach
_COMPONENT = """reach(id, r) AS (SELECT id, id FROM own UNION SELECT l.b, r FROM reach JOIN links l ON l.a = reach.id),
    root AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)"""

SUBSTRING_DEDUP = rf"""WITH t AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{_WORD}'), []) AS w FROM documents),
    win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM t, range(1, len(w) - 18) r(i)),
    dup AS (SELECT doc_id, i FROM win QUALIFY row_number() OVER (PARTITION BY md5(g), g ORDER BY doc_id, i) > 1),
    gone AS (SELECT DISTINCT doc_id, i + k AS p FROM dup, range(0, 20) r(k)),
    word AS (SELECT doc_id, p, w[p] AS x FROM t, range(1, len(w) + 1) r(p)),
    kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS x, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
    SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(x, '')) AS kept_sha256 FROM t LEFT JOIN kept USING (doc_id)"""

NGRAM_JOIN = rf"""WITH RECURSIVE t AS (SELECT doc_id AS id, coalesce(regexp_extract_all({_LOWER}, '{_WORD}'), []) AS w FROM documents),
    s AS (SELECT id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM t),
    own AS (SELECT id, len(s) AS n FROM s), g AS (SELECT id, unnest(s) AS g FROM s), shared AS (SELECT x.id AS a, y.id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.id <> y.id GROUP BY ALL),
    links AS (SELECT a, b FROM shared JOIN own x ON x.id = a JOIN own y ON y.id = b WHERE 100 * c >= 85 * (x.n + y.n - c)), {_COMPONENT}
    SELECT id AS doc_id, n AS n_shingles, (SELECT count(*) FROM links WHERE a = own.id) AS n_links, component_id FROM own JOIN root USING (id)"""

EMBEDDINGS = f"""WITH RECURSIVE own AS (SELECT vec_id AS id FROM embeddings), v AS (SELECT vec_id AS id, label, embedding::DOUBLE[] AS e FROM embeddings
      WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
    links AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.label = y.label AND x.id <> y.id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.98), {_COMPONENT}
    SELECT id AS vec_id, (SELECT count(*) FROM links WHERE a = own.id) AS n_links, component_id, id = component_id AS kept FROM own JOIN root USING (id)"""

ORACLES = {"op3_embedding_near_dedup": EMBEDDINGS, "op5_ngram_jaccard_join": NGRAM_JOIN, "op7_substring_dedup": SUBSTRING_DEDUP}
