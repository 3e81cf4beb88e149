"""The queries that SQL can express, for DuckDB."""

_FINITE = """embedding IS NOT NULL AND list_count(embedding) = len(embedding)
            AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0"""


def _lloyd(rounds: int = 10) -> str:
    """Rounds of assignment and update, one after the other."""
    nearest = """SELECT k.vec_id, any_value(k.v) AS v, arg_min(c.cluster, 8 * {d} + c.cluster) AS cluster, min({d}) AS distance
            FROM kept k, c{r} c GROUP BY k.vec_id"""
    gap = "(list_dot_product(k.v, k.v) - 2 * list_dot_product(k.v, c.v) + list_dot_product(c.v, c.v))::BIGINT"
    steps = []
    for r in range(rounds + 1):
        steps.append(f"a{r} AS MATERIALIZED ({nearest.format(d=gap, r=r)})")
        if r < rounds:
            steps.append(f"""c{r + 1} AS MATERIALIZED (
              SELECT o.cluster, coalesce(m.v, o.v) AS v FROM c{r} o LEFT JOIN (
                SELECT cluster, list(((s - ((s % n) + n) % n) // n)::DOUBLE ORDER BY i) AS v FROM (
                  SELECT cluster, i, sum(x::BIGINT) AS s, count(*) AS n
                  FROM (SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{r}) GROUP BY cluster, i
                ) GROUP BY cluster
              ) m USING (cluster))""")
    return f"""
        WITH kept AS MATERIALIZED (
          SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
          WHERE {_FINITE} AND len(embedding) = 64
        ), c0 AS MATERIALIZED (
          SELECT (row_number() OVER h - 1)::INT AS cluster, v FROM kept
          WINDOW h AS (ORDER BY sha256('3:' || vec_id::VARCHAR)) QUALIFY row_number() OVER h <= 8
        ), {", ".join(steps)}
        SELECT vec_id, a.cluster, distance, (sum(distance) OVER (PARTITION BY a.cluster))::BIGINT AS cluster_inertia,
               (sum(distance) OVER ())::BIGINT AS inertia,
               sha256(array_to_string(list_transform(c.v, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256
        FROM a{rounds} a JOIN c{rounds} c USING (cluster)
    """


STATEMENTS = {
    "op12_centroid_clustering": _lloyd(),
    "op13_hard_negatives": f"""
        WITH kept AS MATERIALIZED (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                 list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
          FROM embeddings WHERE label IS NOT NULL AND {_FINITE}
        ), scored AS MATERIALIZED (
          SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
          FROM kept a JOIN kept b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
        ), positive AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, (row_number() OVER w)::INT AS rank, s.vec_id AS negative_id, positive_score, s.score AS negative_score
        FROM positive p JOIN scored s USING (anchor_id)
        WHERE NOT s.same AND 80 * positive_score <= 100 * s.score AND s.score <= positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) QUALIFY row_number() OVER w <= 5
    """,
    # the input is stored in the order of doc_id, which stands for the place in it here
    "op3_sharding": """
        WITH sized AS (
          SELECT doc_id, text, octet_length(encode(coalesce(text, ''))) + 16 AS size FROM documents
        ), bytes AS (
          SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x], range(8)), lambda c, k:
                   CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps
        ), summed AS (
          SELECT *, hex(encode(coalesce(text, ''))) AS digits, sum(size) OVER (ORDER BY doc_id ROWS UNBOUNDED PRECEDING) - size AS start, sum(size) OVER () AS total
          FROM sized
        ), cut AS (
          SELECT *, least(39, ((2 * start + size) * 40) // (2 * total))::INT AS shard FROM summed
        )
        SELECT doc_id, size::BIGINT AS size, xor(4294967295, list_reduce(
                 list_concat([4294967295], list_transform(range(len(digits) // 2), lambda k: ('0x' || substr(digits, 2 * k + 1, 2))::BIGINT)),
                 lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]))) AS text_crc32, 'bytes' AS law, shard,
               row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INT AS grown_shard
        FROM cut, bytes
    """,
    "op10_line_dedup": r"""
        WITH lines AS (
          SELECT doc_id, unnest(l) AS line, generate_subscripts(l, 1) AS i
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents)
        ), filled AS (
          SELECT doc_id, i, line, lead(i, 2) OVER w AS last, lead(i, 1) OVER w AS mid,
                 line || chr(10) || lead(line, 1) OVER w || chr(10) || lead(line, 2) OVER w AS body
          FROM lines WHERE regexp_matches(line, '\S') WINDOW w AS (PARTITION BY doc_id ORDER BY i)
        ), later AS (
          SELECT * FROM filled WHERE body IS NOT NULL
          QUALIFY row_number() OVER (PARTITION BY body ORDER BY doc_id, i) > 1
        ), gone AS (
          SELECT DISTINCT doc_id, unnest([i, mid, last]) AS i FROM later
        )
        SELECT d.doc_id, CASE WHEN d.text IS NULL THEN 0 ELSE count(*) END AS n_lines, count(g.i) AS n_removed,
               sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
        FROM documents d JOIN lines l USING (doc_id) LEFT JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i
        GROUP BY d.doc_id, d.text
    """,
    "op2_substring_dedup": r"""
        WITH listed AS (
          SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
        ), windows AS (
          SELECT doc_id, i, sha256(array_to_string(w[i:i + 34], ' ')) AS body
          FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM listed WHERE len(w) >= 35)
        ), repeated AS (
          SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY body) > 1
        ), gone AS (
          SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS i FROM repeated
        ), words AS (
          SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM listed
        )
        SELECT l.doc_id, any_value(len(l.w))::BIGINT AS n_words, count(g.i) AS n_removed,
               sha256(coalesce(string_agg(x.word, ' ' ORDER BY x.i) FILTER (WHERE g.i IS NULL), '')) AS kept_sha256
        FROM listed l LEFT JOIN words x USING (doc_id) LEFT JOIN gone g ON g.doc_id = x.doc_id AND g.i = x.i
        GROUP BY l.doc_id
    """,
    "op7_jaccard_join": r"""
        WITH RECURSIVE listed AS (
          SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
          FROM documents
        ), sets AS (
          SELECT doc_id, CASE WHEN len(w) >= 5
                   THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                   WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
          FROM listed
        ), shingles AS (
          SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets
        ), common AS (
          SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS c
          FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id
        ), links AS (
          SELECT a, b FROM common WHERE 100 * c >= 80 * (na + nb - c)
        ), reach(doc_id, other) AS (
          SELECT doc_id, doc_id FROM documents UNION SELECT l.b, r.other FROM reach r JOIN links l ON l.a = r.doc_id
        )
        SELECT doc_id, len(s)::BIGINT AS n_shingles, (SELECT min(other) FROM reach r WHERE r.doc_id = sets.doc_id) AS component_id
        FROM sets
    """,
    "op9_embedding_dedup": """
        WITH RECURSIVE usable AS (
          SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL AND list_count(embedding) = len(embedding)
            AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
            AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS (
          SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
            ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93
        ), reach(vec_id, other) AS (
          SELECT vec_id, vec_id FROM embeddings UNION SELECT l.b, r.other FROM reach r JOIN links l ON l.a = r.vec_id
        ), least AS (
          SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id
        )
        SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id) AS n_links, component_id, e.vec_id = component_id AS kept
        FROM embeddings e JOIN least USING (vec_id)
    """,
}
