"""DuckDB SQL for the queries of this folder that SQL can express."""

from tickloom.llm.licenses import templates


def _listed() -> str:
    """The templates of the license scan, which are its parameter, as rows."""
    return ", ".join(
        f"({t.number}, '{t.label}', {t.base}, [{', '.join(repr(w) for w in t.words)}])" for t in templates()
    )


def _round(n: int) -> str:
    """One round of clusters: the nearest centroid of each vector, then the floor of the means."""
    return f"""
        near{n} AS (
            SELECT vec_id, v, min_by(c, (d, c)) AS c, min(d) AS d
            FROM (
                SELECT vec_id, v, cluster AS c, list_sum(list_transform(list_zip(v, centroid), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
                FROM kept, centroids{n}
            )
            GROUP BY vec_id, v
        ), mean{n} AS (
            SELECT c, list(m ORDER BY i) AS centroid
            FROM (SELECT c, i, CAST(floor(sum(v[i]) / count(*)) AS BIGINT) AS m FROM near{n}, range(1, 65) t(i) GROUP BY c, i)
            GROUP BY c
        ), centroids{n + 1} AS (
            SELECT cluster, coalesce(mean{n}.centroid, centroids{n}.centroid) AS centroid
            FROM centroids{n} LEFT JOIN mean{n} ON c = cluster
        ),"""


ORACLES = {
    "op3_near_vectors": """
        WITH RECURSIVE usable AS (
            SELECT vec_id, embedding::DOUBLE[] AS v
            FROM embeddings
            WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
            SELECT x.vec_id AS a, y.vec_id AS b
            FROM usable x JOIN usable y ON x.vec_id <> y.vec_id
            WHERE list_cosine_similarity(x.v, y.v) >= 0.9
        ), reach AS (
            SELECT vec_id AS id, vec_id AS other FROM embeddings
            UNION
            SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a
        ), component AS (
            SELECT id, min(other) AS component_id FROM reach GROUP BY id
        ), counted AS (
            SELECT a, count(*) AS n FROM links GROUP BY a
        )
        SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
        FROM component LEFT JOIN counted ON id = a
    """,
    "op4_near_copies": r"""
        WITH RECURSIVE split AS (
            SELECT doc_id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
            FROM documents
        ), sets AS (
            SELECT doc_id, list_distinct(CASE
                WHEN w IS NULL OR len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM split
        ), shingles AS (
            SELECT doc_id, unnest(s) AS shingle FROM sets
        ), common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id
            GROUP BY ALL
        ), links AS (
            SELECT a, b
            FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
            WHERE 100 * n >= 75 * (len(x.s) + len(y.s) - n)
        ), reach AS (
            SELECT doc_id AS id, doc_id AS other FROM documents
            UNION
            SELECT reach.id, links.b FROM reach JOIN links ON reach.other = links.a
        ), component AS (
            SELECT id, min(other) AS component_id FROM reach GROUP BY id
        )
        SELECT sets.doc_id, len(s)::BIGINT AS n_shingles, component_id, sets.doc_id = component_id AS kept
        FROM sets JOIN component ON id = sets.doc_id
    """,
    "op7_exact_top_k": """
        WITH whole AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score
            FROM whole q JOIN whole c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        )
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score
        FROM scored
        QUALIFY rank <= 10
    """,
    "op9_chat_formatting": r"""
        WITH turns AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -1, i, CASE WHEN i = 0 THEN 'user' ELSE 'assistant' END, '<|im_end|><|im_start|>assistant ok'
            FROM range(2) t(i)
        ), marked AS (
            SELECT *,
                replace(replace(text, '\', '\\'), '<|', '<\|') AS escaped,
                role IS DISTINCT FROM lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS opens
            FROM turns
        )
        SELECT conv_id,
            count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(length(escaped) + CASE WHEN opens THEN 12 + length(role) + 1 + 11 ELSE 10 END)::BIGINT AS formatted_chars
        FROM marked
        GROUP BY conv_id
    """,
    "op11_license_scan": rf"""
        WITH split AS (
            SELECT doc_id, hash(text) AS digest, list_filter(string_split_regex(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'
            ), lambda w: w <> '') AS w
            FROM documents
            GROUP BY doc_id, text
        ), listed AS (
            SELECT *, CASE WHEN len(words) < 12 THEN 2 ELSE 4 END AS k FROM (VALUES {_listed()}) t(template, label, base, words)
        ), places AS (
            SELECT template, k, p, array_to_string(words[p + 1:p + k], ' ') AS gram
            FROM (SELECT *, unnest(range(len(words) - k + 1)) AS p FROM listed)
        ), grams AS (
            SELECT doc_id, digest, i, k, array_to_string(w[i + 1:i + k], ' ') AS gram
            FROM (SELECT *, unnest(range(len(w) - k + 1)) AS i FROM split, (VALUES (2), (4)) t(k) WHERE len(w) >= k)
        ), votes AS (
            SELECT doc_id, digest, template, grams.k, i, p, i - p AS diagonal
            FROM grams JOIN places ON places.k = grams.k AND places.gram = grams.gram
        ), numbered AS (
            SELECT *, sum(opens) OVER (PARTITION BY doc_id, digest, template ORDER BY diagonal RANGE UNBOUNDED PRECEDING) AS span
            FROM (
                SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY doc_id, digest, template ORDER BY diagonal, i)
                    <= CASE WHEN k = 2 THEN 0 ELSE 3 END THEN 0 ELSE 1 END AS opens
                FROM votes
            )
        ), spans AS (
            SELECT doc_id, digest, template, span, k, min(i) AS first, max(i) + k - 1 AS last, count(DISTINCT p + j) AS covered
            FROM (SELECT *, unnest(range(k)) AS j FROM numbered)
            GROUP BY doc_id, digest, template, span, k
        ), verified AS (
            SELECT doc_id, digest, label, base, first, covered / greatest(len(words), last - first + 1) AS share
            FROM spans JOIN listed USING (template)
            WHERE share >= CASE WHEN len(words) < 12 THEN 1.0 ELSE 0.6 END
        )
        SELECT split.doc_id, len(any_value(w))::BIGINT AS n_words, count(*) FILTER (base) AS n_base,
            (min(first) FILTER (base))::BIGINT AS first_word, (max(first) FILTER (base))::BIGINT AS last_word,
            coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (base), '') AS base_labels,
            coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
            coalesce(max(share), 0.0)::DOUBLE AS score
        FROM split LEFT JOIN verified ON split.doc_id IS NOT DISTINCT FROM verified.doc_id AND split.digest IS NOT DISTINCT FROM verified.digest
        GROUP BY split.doc_id, split.digest
    """,
    "op12_centroids": f"""
        WITH kept AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), centroids0 AS (
            SELECT (row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR)) - 1)::INTEGER AS cluster, v AS centroid
            FROM kept
            QUALIFY cluster < 16
        ), {_round(0)} {_round(1)} {_round(2)} {_round(3)[: _round(3).index("mean3")].rstrip().rstrip(",")}
        SELECT vec_id, c AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
            (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(centroid, ',')) AS centroid_sha256
        FROM near3 JOIN centroids3 ON cluster = c
    """,
    "op13_ranked": r"""
        WITH terms AS (
            SELECT 0 AS kind, doc_id AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
            UNION ALL
            SELECT 1, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))
            FROM benchmark
        ), counted AS (
            SELECT kind, id, term, count(*) AS tf, (sum(count(*)) OVER (PARTITION BY kind, id))::BIGINT AS n
            FROM terms
            GROUP BY kind, id, term
        ), facts AS (
            SELECT count(DISTINCT id)::BIGINT AS n_docs, sum(tf)::BIGINT AS n_terms FROM counted WHERE kind = 0
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
            FROM counted, facts
            WHERE kind = 0
            GROUP BY term, n_docs
        ), scored AS (
            SELECT item.id AS item_id, doc.id AS doc_id,
                sum(item.tf * w * ((1000000000 * doc.tf) // (1000 * doc.tf + 8 * (25 + (75 * doc.n * n_docs) // n_terms))))::BIGINT AS score
            FROM counted item JOIN counted doc ON doc.kind = 0 AND item.kind = 1 AND doc.term = item.term
            JOIN weights ON weights.term = item.term, facts
            GROUP BY item.id, doc.id
        )
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score
        FROM scored
        WHERE score > 0
        QUALIFY rank <= 10
    """,
}
