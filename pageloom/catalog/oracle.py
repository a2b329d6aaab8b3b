"""The registered queries as plain SQL over the same tables (DuckDB dialect).

Each text is the naive form of its query: all pairs, recursive closures and
unrolled rounds.
"""

from __future__ import annotations

from pageloom.catalog.queries import (
    ANY_OVERLAP,
    BATCHES,
    CLUSTERS,
    FREQUENT,
    KMEANS_ROUNDS,
    LONG_ROUNDS,
    MATRIX_WORDS,
    MIN_OVERLAP,
    ROUNDS,
    SEARCHED,
    SEEDS,
    START_CENTRES,
    THRESHOLD,
    TOPIC_WORDS,
    WIDE_THRESHOLD,
)

ASCII = "list_transform(regexp_extract_all(text, '[a-zA-Z]+'), lambda x: lower(x))"
WS = r"list_filter(regexp_split_to_array(text, '\s+'), lambda x: x <> '')"
LONG = "list_filter(string_split(lower(text), ' '), lambda x: length(x) >= 3)"
ONE_LINE = r"trim(regexp_replace(text, '\s+', ' ', 'g'))"
TITLE = "source || '/' || doc_id"
NS = "CASE WHEN lang = 'en' THEN '0' ELSE '4' END"


def _counts(words: str, where: str = "true") -> str:
    """CTEs: words per page, counts, lengths, document frequencies, N."""
    return f"""
    pw AS (SELECT doc_id AS page_id, {words} AS w FROM documents WHERE {where}),
    tf AS (SELECT page_id, word, count(*) AS n
           FROM (SELECT page_id, unnest(w) AS word FROM pw) GROUP BY ALL),
    dl AS (SELECT page_id, sum(n) AS len FROM tf GROUP BY ALL),
    df AS (SELECT word, count(*) AS df FROM tf GROUP BY ALL),
    al AS (SELECT count(*) AS n_all FROM documents)"""


RATIO = """
    ra AS (SELECT page_id, word, n / len * ln(n_all / df) AS weight
           FROM tf JOIN dl USING (page_id) JOIN df USING (word), al)"""
LOG2 = """
    ra AS (SELECT page_id, word, n / len * log2(n_all / df) AS weight
           FROM tf JOIN dl USING (page_id) JOIN df USING (word), al)"""
SMOOTH = """
    sm AS (SELECT page_id, word, n * ln((n_all + 1) / (df + 1)) AS weight
           FROM tf JOIN df USING (word), al)"""


def _tokens(words: str) -> str:
    return f"""
    SELECT page_id, unnest(range(len(w)))::INTEGER AS pos, unnest(w) AS word
    FROM (SELECT doc_id AS page_id, {words} AS w FROM documents)"""


def _hashed(buckets: str) -> str:
    return f"""
    bt AS (SELECT page_id, ('0x' || substr(md5(word), 1, 8))::BIGINT % {buckets} AS bucket,
                  sum(n) AS n
           FROM tf GROUP BY ALL),
    bd AS (SELECT bucket, count(*) AS df FROM bt GROUP BY ALL),
    hw AS (SELECT page_id, bucket, n * ln((n_all + 1) / (df + 1)) AS weight
           FROM bt JOIN bd USING (bucket), al)"""


def _grams(n: int) -> str:
    return f"""
    gr AS (SELECT unnest(list_transform(range(1, len(w) - {n - 2}),
                  lambda i: array_to_string(w[i:i + {n - 1}], ','))) AS gram
           FROM (SELECT {ASCII} AS w FROM documents) WHERE len(w) >= {n})"""


_TOP5 = "SELECT gram, n::BIGINT AS n FROM gc ORDER BY n DESC, gram LIMIT 5"

# -- pairs -----------------------------------------------------------------

COPIES = f"""
    pw AS (SELECT doc_id AS page_id, {ASCII} AS w FROM documents),
    co AS (SELECT page_id, min(page_id) OVER (PARTITION BY list_sort(w)) AS rep
           FROM pw WHERE len(w) > 0)"""

NORMS = """
    nr AS (SELECT page_id, sum(weight * weight) AS nn FROM ra GROUP BY ALL)"""


def _all_pairs(metric: str, threshold: float) -> str:
    """CTE ``pr``: every pair of pages within the threshold."""
    product = (
        "2 * a.weight * b.weight"
        if metric == "euclid"
        else "a.weight * a.weight + b.weight * b.weight"
    )
    return f"""
    WITH RECURSIVE {_counts(ASCII)}, {RATIO}, {NORMS},
    sh AS (SELECT a.page_id AS a, b.page_id AS b, sum({product}) AS shared
           FROM ra a JOIN ra b ON a.word = b.word AND a.page_id < b.page_id GROUP BY ALL),
    pr AS (SELECT page_a, page_b, na, nb,
                  round(sqrt(greatest(na + nb - coalesce(shared, 0), 0)), 6) AS dist
           FROM (SELECT x.page_id AS page_a, y.page_id AS page_b, x.nn AS na, y.nn AS nb
                 FROM nr x JOIN nr y ON x.page_id < y.page_id)
           LEFT JOIN sh ON sh.a = page_a AND sh.b = page_b
           WHERE round(sqrt(greatest(na + nb - coalesce(shared, 0), 0)), 6) <= {threshold})"""


def _found(metric: str, threshold: float) -> str:
    """CTE ``fo``: pairs of lowest copies that their norms alone do not decide."""
    reach = threshold + 5e-7
    return f"""{_all_pairs(metric, threshold)},
    rp AS (SELECT min(page_id) AS rep
           FROM (SELECT page_id, w FROM pw WHERE len(w) > 0) GROUP BY list_sort(w)),
    fo AS (SELECT page_a, page_b, dist FROM pr
           WHERE page_a IN (FROM rp) AND page_b IN (FROM rp)
             AND na + nb > {reach} * {reach})"""


def _labels(threshold: float) -> str:
    """CTE ``lb``: component labels from every pair, by closure."""
    return f"""{_all_pairs('euclid', threshold)},
    ed AS (SELECT page_a AS u, page_b AS v FROM pr UNION SELECT page_b, page_a FROM pr),
    re AS (SELECT u AS page_id, u AS seen FROM ed
           UNION SELECT re.page_id, ed.v FROM re JOIN ed ON ed.u = re.seen),
    lb AS (SELECT page_id, min(seen) AS component FROM re GROUP BY ALL),
    sz AS (SELECT component, count(*) AS n_pages FROM lb GROUP BY ALL)"""


# -- links -----------------------------------------------------------------

LINKS = """
    li AS (SELECT DISTINCT a.l_partkey AS src, b.l_partkey AS dst
           FROM lineitem a JOIN lineitem b
           ON a.l_orderkey = b.l_orderkey AND a.l_linenumber + 1 = b.l_linenumber)"""


PAGE_LINKS = """
    li AS (SELECT DISTINCT doc_id AS src, unnest([(doc_id + 1) % m, (doc_id * 3 + 1) % m,
                  (doc_id * 7 + 5) % m]) AS dst
           FROM documents, (SELECT max(doc_id) + 1 AS m FROM documents))"""


def _ranks(links: str = "li", rounds: int = ROUNDS) -> str:
    """CTEs ``r0`` .. ``r<rounds>``."""
    parts = [
        f"od AS (SELECT src, count(*) AS n_links FROM {links} GROUP BY ALL)",
        "r0 AS (SELECT src AS page, 1.0::DOUBLE AS rank FROM od)",
    ]
    parts += [
        f"""r{i} AS (SELECT dst AS page, 0.2::DOUBLE + 0.8::DOUBLE * sum(rank / n_links) AS rank
               FROM {links} l JOIN r{i - 1} r ON r.page = l.src JOIN od USING (src)
               GROUP BY dst)"""
        for i in range(1, rounds + 1)
    ]
    return ", ".join(parts)


# -- k-means ---------------------------------------------------------------


def _lloyd() -> str:
    parts = [
        """em AS (SELECT vec_id, unnest(range(len(embedding))) AS dim,
                         unnest(embedding)::DOUBLE AS v FROM embeddings)""",
        f"""c0 AS (SELECT vec_id AS cluster, dim, v FROM em WHERE vec_id < {START_CENTRES})""",
    ]
    for i in range(1, ROUNDS + 1):
        parts.append(
            f"""d{i} AS (SELECT vec_id, cluster, round(sum((em.v - c.v) * (em.v - c.v)), 9) AS d
                 FROM em JOIN c{i - 1} c USING (dim) GROUP BY ALL)"""
        )
        parts.append(
            f"""a{i} AS (SELECT vec_id, cluster FROM d{i}
                 QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, cluster) = 1)"""
        )
        parts.append(
            f"""c{i} AS (SELECT o.cluster, o.dim, coalesce(n.v, o.v) AS v FROM c{i - 1} o
                 LEFT JOIN (SELECT cluster, dim, avg(v) AS v FROM em JOIN a{i} USING (vec_id)
                            GROUP BY ALL) n USING (cluster, dim))"""
        )
    return "WITH " + ", ".join(parts)


# -- topics ----------------------------------------------------------------

def _sparse_kmeans(points: str) -> str:
    """All runs of k-means over ``pt`` (page_id, word, weight); ``be`` is the best run's number.

    ``points`` defines ``pt`` and ``pg``, all pages with their squared norms.
    """
    runs = ", ".join(f"({s})" for s in SEEDS)
    parts = [
        points,
        f"""
    st AS MATERIALIZED (
        SELECT run, page_id, c FROM (
            SELECT run, page_id, row_number() OVER (
                PARTITION BY run ORDER BY md5(run || ':' || page_id), page_id) - 1 AS c
            FROM pg, (VALUES {runs}) r(run)) WHERE c < {CLUSTERS}),
    c0 AS MATERIALIZED (SELECT run, c, word, weight FROM st JOIN pt USING (page_id))""",
    ]
    for i in range(KMEANS_ROUNDS + 1):
        parts.append(f"""
    n{i} AS (SELECT run, st.c, coalesce(s, 0) AS norm FROM st LEFT JOIN
             (SELECT run, c, sum(weight * weight) AS s FROM c{i} GROUP BY ALL) USING (run, c)),
    a{i} AS MATERIALIZED (
        SELECT run, page_id, min({{'d': d, 'c': c}}) AS m FROM (
            SELECT n.run, p.page_id, n.c, round(p.norm + n.norm - 2 * coalesce(dot, 0), 6) AS d
            FROM pg p CROSS JOIN n{i} n LEFT JOIN
                 (SELECT run, page_id, c, sum(pt.weight * o.weight) AS dot
                  FROM pt JOIN c{i} o USING (word) GROUP BY ALL) t
                 ON t.run = n.run AND t.page_id = p.page_id AND t.c = n.c) GROUP BY ALL)""")
        if i < KMEANS_ROUNDS:
            parts.append(f"""
    z{i} AS (SELECT run, m.c AS c, count(*) AS n FROM a{i} GROUP BY ALL),
    c{i + 1} AS MATERIALIZED (
        SELECT run, c, word, s / n AS weight FROM
            (SELECT run, m.c AS c, word, sum(weight) AS s FROM a{i} JOIN pt USING (page_id) GROUP BY ALL)
            JOIN z{i} USING (run, c)
        UNION ALL SELECT * FROM c{i} ANTI JOIN z{i} USING (run, c))""")
    parts.append(f"""
    be AS (SELECT run FROM (SELECT run, round(sum(greatest(m.d, 0)), 3) AS cost
                            FROM a{KMEANS_ROUNDS} GROUP BY run) ORDER BY cost, run LIMIT 1)""")
    return "WITH " + ",".join(parts)


def _topics(min_overlap: int, below: str) -> str:
    return f"""
    WITH {_counts(WS)}, {SMOOTH},
    asg AS (SELECT doc_id AS page_id, source AS cluster, {TITLE} AS title FROM documents),
    cs AS (SELECT cluster, count(*) AS n_pages FROM asg GROUP BY ALL),
    ce AS (SELECT cluster, word, sum(weight) / any_value(n_pages) AS weight
           FROM sm JOIN asg USING (page_id) JOIN cs USING (cluster) GROUP BY cluster, word),
    tw AS (SELECT cluster, word, rank FROM
           (SELECT cluster, word, row_number() OVER
                   (PARTITION BY cluster ORDER BY round(weight, 9) DESC, word)::INTEGER AS rank
            FROM ce) WHERE rank <= 100),
    ov AS (SELECT page_id, cluster, sum(n)::BIGINT AS n_tokens FROM tf JOIN tw USING (word)
           GROUP BY page_id, cluster),
    me AS (SELECT page_id, cluster FROM ov WHERE n_tokens >= {min_overlap}),
    ke AS (SELECT cluster, count(*) AS n_pages FROM me GROUP BY ALL
           HAVING count(*) > 1 {below}),
    ti AS (SELECT me.cluster, a.title FROM me JOIN ke USING (cluster)
           JOIN asg a ON a.page_id = me.page_id),
    pa AS (SELECT word AS topic, title FROM tw JOIN ti USING (cluster)),
    tl AS (SELECT cluster, count(*) AS n_titles,
                  string_agg(title, ' | ' ORDER BY title) AS titles FROM ti GROUP BY cluster),
    ca AS (SELECT cluster, words, n_titles, titles FROM tl JOIN
           (SELECT cluster, string_agg(word, ',' ORDER BY rank) AS words FROM tw
            WHERE rank <= 5 GROUP BY cluster) USING (cluster))"""


TOPICS = _topics(MIN_OVERLAP, "AND count(*) < 50")
ANY = _topics(ANY_OVERLAP, "")

_MATRIX = ", ".join(
    f"round(coalesce(sum(CASE WHEN word = '{w}' THEN weight END), 0), 9) AS w_{w}"
    for w in MATRIX_WORDS
)


KMEANS_WORDS = _sparse_kmeans(f"""{_counts(WS)}, {SMOOTH},
    pt AS MATERIALIZED (SELECT page_id, word, weight FROM sm),
    pg AS MATERIALIZED (SELECT doc_id AS page_id, coalesce(s, 0) AS norm FROM documents LEFT JOIN
        (SELECT page_id, sum(weight * weight) AS s FROM pt GROUP BY page_id) ON doc_id = page_id)""")
KMEANS_UNIT = _sparse_kmeans("""
    pv AS (SELECT vec_id AS page_id, unnest(range(len(embedding))) AS word,
                  unnest(embedding)::DOUBLE AS v FROM embeddings),
    pt AS MATERIALIZED (SELECT page_id, word, v / sqrt(s) AS weight FROM pv JOIN
        (SELECT page_id, sum(v * v) AS s FROM pv GROUP BY page_id) USING (page_id)),
    pg AS MATERIALIZED (SELECT DISTINCT page_id, 1.0::DOUBLE AS norm FROM pt)""")


def all_sql() -> dict[str, str]:
    smooth = f"WITH {_counts(WS)}, {SMOOTH}"
    ratio = f"WITH {_counts(ASCII)}, {RATIO}"
    labels = _labels(THRESHOLD)
    digest = "length(t)::BIGINT AS text_chars, md5(t) AS text_md5"
    sql = {
        "line_chars": "SELECT doc_id AS page_id, length(text)::BIGINT AS n_chars FROM documents",
        "xml_pages": f"""
            SELECT reader, page_id, title, ns, {digest} FROM
            (SELECT doc_id AS page_id, {TITLE} AS title, {NS} AS ns, {ONE_LINE} AS t,
                    unnest(['line', 'chunk']) AS reader FROM documents)""",
        "page_headers": f"""
            SELECT doc_id AS page_id, 'title' AS kind, {TITLE} AS value FROM documents
            UNION ALL SELECT doc_id, 'id', doc_id::VARCHAR FROM documents
            UNION ALL SELECT doc_id, 'id', (doc_id + 1000000)::VARCHAR FROM documents
            UNION ALL SELECT doc_id, 'id', n_chars::VARCHAR FROM documents
            UNION ALL SELECT doc_id, 'id', (doc_id + 2000000)::VARCHAR FROM documents
            UNION ALL SELECT doc_id, 'id', (n_chars + 1)::VARCHAR FROM documents""",
        "ns_filter": f"""
            SELECT doc_id AS page_id, {TITLE} AS title, '0' AS ns FROM documents
            WHERE lang = 'en'""",
        "tsv_corpus": f"""
            SELECT doc_id AS page_id, {TITLE} AS title, {digest}
            FROM (SELECT *, {ONE_LINE} AS t FROM documents)""",
        "topic_table_csv": f"SELECT lang AS topic, {TITLE} AS title FROM documents",
        "edge_list": f"WITH {LINKS} SELECT src::VARCHAR AS src, dst::VARCHAR AS dst FROM li",
        "kv_reduce": f"WITH {_grams(5)} SELECT gram, count(*) AS n FROM gr GROUP BY ALL",
        "sink_roundtrip": f"""
            WITH {_counts(ASCII)}
            SELECT page_id, len::BIGINT AS n_words, unnest(['text', 'csv', 'parquet']) AS sink
            FROM dl""",
        "tokens_ascii": _tokens(ASCII),
        "tokens_ws": _tokens(WS),
        "tokens_space": _tokens("string_split(text, ' ')"),
        "scalar_functions": f"""
            SELECT doc_id AS page_id,
              len(string_split(text, ',')) AS n_comma_fields,
              string_split(text, ' ')[1] AS before_space,
              lang || chr(9) || source AS joined,
              length(trim(text))::BIGINT AS trimmed_chars,
              starts_with(text, 'The') AS starts_with_the,
              regexp_matches(lang, '^[a-zA-Z]+$') AS lang_is_alpha,
              regexp_matches(source, '^[a-zA-Z]+$') AS source_is_alpha,
              lower(source) AS source_lower,
              length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g'))::BIGINT AS ascii_chars,
              TRY_CAST(substr(source, 4, 10) AS BIGINT) AS source_number,
              TRY_CAST(source AS BIGINT) AS not_a_number,
              round(ln(n_chars), 9) AS ln_chars,
              round(pow(n_chars, 2.0), 3) AS squared,
              round(sqrt(n_chars), 9) AS root,
              round(n_chars / greatest(len(w), 1), 9) AS chars_per_word,
              greatest(n_chars, 1000) AS at_least_1000,
              len(w)::BIGINT AS n_words,
              w[1] AS first_word,
              array_to_string(w[1:3], ',') AS head,
              list_contains(w, 'the') AS has_the,
              array_to_string(list_transform(list_filter(range(1, len(w) + 1),
                  lambda i: w[i] = 'the'), lambda i: (i - 1)::VARCHAR), ',') AS the_at
            FROM (SELECT *, {ASCII} AS w FROM documents)""",
        "term_freq": f"WITH {_counts(ASCII)} SELECT page_id, word, n FROM tf",
        "doc_len": f"WITH {_counts(ASCII)} SELECT page_id, len::BIGINT AS n_words FROM dl",
        "doc_freq": f"WITH {_counts(ASCII)} SELECT word, df FROM df",
        "corpus_stats": f"""
            WITH {_counts(ASCII)}
            SELECT any_value(n_all) AS n_pages, sum(n)::BIGINT AS n_tokens,
                   count(DISTINCT word) AS n_words FROM tf, al""",
        "ngram5_top": f"""
            WITH {_grams(5)}, gc AS (SELECT gram, count(*) AS n FROM gr GROUP BY ALL) {_TOP5}""",
        "ngram3_top": f"""
            WITH {_grams(3)}, gc AS (SELECT gram, count(*) AS n FROM gr GROUP BY ALL) {_TOP5}""",
        "ngram5_revisions": f"""
            WITH documents AS (SELECT text FROM main.documents
                UNION ALL SELECT substr(text, 1, length(text) // 2) FROM main.documents),
            {_grams(5)}, gc AS (SELECT gram, count(*) AS n FROM gr GROUP BY ALL) {_TOP5}""",
        "ngram5_compat": f"""
            WITH gr AS (SELECT len(w) AS times, unnest(list_transform(range(2, len(w) - 4),
                     lambda i: array_to_string(w[i:i + 3], ',') || w[i + 4])) AS gram
                 FROM (SELECT {ASCII} AS w FROM documents) WHERE len(w) >= 7),
            gc AS (SELECT gram, sum(times) AS n FROM gr GROUP BY ALL) {_TOP5}""",
        "tfidf_ratio": f"{ratio} SELECT page_id, word, round(weight, 9) AS weight FROM ra",
        "tfidf_ratio_articles": f"""
            WITH {_counts(ASCII, "lang = 'en'")}, {RATIO}
            SELECT page_id, word, round(weight, 9) AS weight FROM ra""",
        "tfidf_smoothed": f"{smooth} SELECT page_id, word, round(weight, 9) AS weight FROM sm",
        "tfidf_log2": f"""
            WITH {_counts(LONG)}, {LOG2}
            SELECT page_id, word, round(weight, 9) AS weight FROM ra""",
        "tfidf_hashed": f"""
            WITH {_counts(WS)}, {_hashed('(SELECT count(*) FROM df)')}
            SELECT page_id, bucket, round(weight, 9) AS weight FROM hw""",
        "term_weights": f"""
            WITH {_counts(WS)}, {_hashed('1048576')}, tk AS ({_tokens(WS)})
            SELECT tk.page_id, pos, word, round(weight, 9) AS weight FROM
            (SELECT *, ('0x' || substr(md5(word), 1, 8))::BIGINT % 1048576 AS bucket FROM tk) tk
            LEFT JOIN hw ON hw.page_id = tk.page_id AND hw.bucket = tk.bucket""",
        "doc_weight_list": f"""
            {smooth}
            SELECT page_id, array_to_string(list_sort(list(
                     word || ':' || round(weight * 1000000)::BIGINT)), ' ') AS weights,
                   count(*) AS n_words FROM sm GROUP BY page_id""",
        "tfidf_top": f"""
            {ratio} SELECT page_id, word, round(weight, 9) AS weight FROM ra
            ORDER BY weight DESC, page_id, word LIMIT 1""",
        "tfidf_first": f"""
            {ratio} SELECT page_id, word, round(weight, 9) AS weight FROM ra
            ORDER BY page_id, word LIMIT 1""",
        "doc_top_terms": f"""
            WITH {_counts(LONG)}, {LOG2}
            SELECT page_id, word, weight, rank FROM
            (SELECT page_id, word, round(weight, 9) AS weight,
                    rank() OVER (PARTITION BY page_id ORDER BY round(weight, 9) DESC)::INTEGER
                      AS rank FROM ra)
            WHERE rank <= 100""",
        "doc_term_matrix": f"""
            WITH {_counts(LONG)}, {LOG2}
            SELECT page_id, source AS section, word, round(weight, 9) AS weight
            FROM ra JOIN documents ON doc_id = page_id""",
        "doc_term_columns": f"""
            WITH {_counts(LONG)}, {LOG2}
            SELECT doc_id AS page_id, source AS section, {_MATRIX}
            FROM documents LEFT JOIN ra ON ra.page_id = doc_id GROUP BY ALL""",
        "page_copies": f"WITH {COPIES} SELECT page_id, rep FROM co",
        "pair_euclid": f"{_all_pairs('euclid', THRESHOLD)} SELECT page_a, page_b, dist FROM pr",
        "pair_cover": f"{_found('euclid', THRESHOLD)} SELECT page_a, page_b FROM fo",
        "pair_euclid_wide": f"""
            {_all_pairs('euclid', WIDE_THRESHOLD)} SELECT page_a, page_b, dist FROM pr""",
        "pair_symdiff": f"{_all_pairs('symdiff', THRESHOLD)} SELECT page_a, page_b, dist FROM pr",
        "light_pages": f"""
            {ratio}, {NORMS}, {COPIES.replace('pw AS', 'pw2 AS').replace('FROM pw', 'FROM pw2')},
            li AS (SELECT rep, count(*) AS n_pages, any_value(nn) AS nn FROM co
                   JOIN nr ON nr.page_id = co.rep GROUP BY rep)
            SELECT rep, n_pages, round(nn, 12) AS norm_sq FROM li a
            WHERE EXISTS (SELECT 1 FROM li b WHERE b.rep <> a.rep
                          AND a.nn + b.nn <= pow({WIDE_THRESHOLD} + 5e-7, 2))""",
        "light_pages_narrow": f"""
            {ratio}, {NORMS}, {COPIES.replace('pw AS', 'pw2 AS').replace('FROM pw', 'FROM pw2')},
            li AS (SELECT rep, count(*) AS n_pages, any_value(nn) AS nn FROM co
                   JOIN nr ON nr.page_id = co.rep GROUP BY rep)
            SELECT rep, n_pages, round(nn, 12) AS norm_sq FROM li a
            WHERE EXISTS (SELECT 1 FROM li b WHERE b.rep <> a.rep
                          AND a.nn + b.nn <= pow({THRESHOLD} + 5e-7, 2))""",
        "similar_pages": f"""
            {_all_pairs('euclid', THRESHOLD)}
            SELECT page_a AS page_id, page_b AS similar_id, dist FROM pr
            UNION ALL SELECT page_b, page_a, dist FROM pr""",
        "cc_labels": f"{labels} SELECT page_id, component FROM lb",
        "cc_labels_cover": f"{labels} SELECT page_id, component FROM lb",
        "cc_labels_wide": f"{_labels(WIDE_THRESHOLD)} SELECT page_id, component FROM lb",
        "cc_count": f"""
            {labels} SELECT count(*) AS n_components, sum(n_pages)::BIGINT AS n_pages FROM sz""",
        "cc_summary": f"{labels} SELECT component, n_pages FROM sz",
        "cc_members": f"""
            {labels} SELECT (SELECT count(*) FROM sz) AS n_components, component, n_pages, page_id
            FROM lb JOIN sz USING (component)""",
        "cc_titles": f"""
            {labels} SELECT component, page_id, {TITLE} AS title
            FROM lb JOIN documents ON doc_id = page_id""",
        "cc_shortest": f"""
            {labels} SELECT component, page_id, len::BIGINT AS n_words
            FROM lb JOIN dl USING (page_id)
            QUALIFY rank() OVER (PARTITION BY component ORDER BY len) = 1""",
        "out_degree": f"WITH {LINKS} SELECT src, count(*) AS n_links FROM li GROUP BY src",
        "pagerank_ranks": f"""
            WITH {LINKS}, {_ranks()} SELECT page, round(rank, 6) AS rank FROM r{ROUNDS}""",
        "pagerank_long": f"""
            WITH {LINKS}, {_ranks(rounds=LONG_ROUNDS)}
            SELECT page, round(rank, 6) AS rank FROM r{LONG_ROUNDS}""",
        "pagerank_chain": f"""
            {labels}, {PAGE_LINKS},
            ch AS (SELECT page_id AS page FROM lb JOIN dl USING (page_id)
                   QUALIFY rank() OVER (PARTITION BY component ORDER BY len) = 1),
            lf AS (SELECT src, dst FROM li WHERE src IN (FROM ch) OR dst IN (FROM ch)),
            {_ranks('lf')} SELECT page, round(rank, 6) AS rank FROM r{ROUNDS}""",
        "pagerank_top5": f"""
            WITH {LINKS}, {_ranks()}
            SELECT page, round(rank, 6) AS rank, p_name AS title FROM r{ROUNDS}
            LEFT JOIN part ON p_partkey = page ORDER BY round(r{ROUNDS}.rank, 9) DESC, page LIMIT 5""",
        "pagerank_filtered": f"""
            WITH {LINKS},
            ch AS (SELECT p_partkey AS page FROM part
                   QUALIFY rank() OVER (PARTITION BY p_brand, p_size ORDER BY p_retailprice) = 1),
            lf AS (SELECT src, dst FROM li WHERE src IN (FROM ch) AND dst IN (FROM ch)),
            {_ranks('lf')} SELECT page, round(rank, 6) AS rank FROM r{ROUNDS}""",
        "kmeans_lloyd": f"""
            {_lloyd()} SELECT vec_id AS id, cluster::INTEGER AS cluster FROM a{ROUNDS}""",
        "kmeans_ml": f"""
            {KMEANS_WORDS} SELECT page_id, m.c::INTEGER AS cluster
            FROM a{KMEANS_ROUNDS} JOIN be USING (run)""",
        "kmeans_unit": f"""
            {KMEANS_UNIT} SELECT page_id, m.c::INTEGER AS cluster
            FROM a{KMEANS_ROUNDS} JOIN be USING (run)""",
        "kmeans_topics": f"""
            {KMEANS_WORDS} SELECT cluster, word, rank FROM (
                SELECT c::INTEGER AS cluster, word, row_number() OVER (
                    PARTITION BY c ORDER BY round(weight, 9) DESC, word)::INTEGER AS rank
                FROM c{KMEANS_ROUNDS} JOIN be USING (run)) WHERE rank <= {TOPIC_WORDS}""",
        "l2_normalize": """
            SELECT page_id, dim::INTEGER AS dim, round(v / norm, 6) AS value FROM
            (SELECT vec_id AS page_id, unnest(range(len(embedding))) AS dim,
                    unnest(embedding)::DOUBLE AS v FROM embeddings)
            JOIN (SELECT vec_id AS page_id, sqrt(list_sum(list_transform(embedding,
                         lambda x: x::DOUBLE * x::DOUBLE))) AS norm FROM embeddings)
            USING (page_id)""",
        "cluster_centroids": f"{TOPICS} SELECT cluster, word, round(weight, 9) AS weight FROM ce",
        "cluster_top_terms": f"{TOPICS} SELECT cluster, word, rank FROM tw",
        "cluster_freq_terms": f"""
            WITH {_counts(ASCII)}
            SELECT source AS cluster, word, sum(n)::BIGINT AS n FROM tf
            JOIN documents ON doc_id = page_id GROUP BY source, word
            HAVING sum(n) >= {FREQUENT}""",
        "cluster_members": """
            SELECT doc_id AS page_id, source AS cluster FROM documents""",
        "doc_topic_overlap": f"{TOPICS} SELECT page_id, cluster, n_tokens FROM ov",
        "doc_topics": f"{TOPICS} SELECT page_id, cluster FROM me",
        "topic_size_band": f"{TOPICS} SELECT cluster, n_pages FROM ke",
        "topic_titles": f"{TOPICS} SELECT cluster, n_titles, titles FROM tl",
        "topic_catalog": f"{TOPICS} SELECT cluster, words, n_titles, titles FROM ca",
        "topic_title_pairs": f"{TOPICS} SELECT topic, title FROM pa",
        "topic_search_sql": f"""
            {TOPICS} SELECT DISTINCT topic, title FROM pa WHERE topic = '{SEARCHED}'""",
        "topic_label": f"{TOPICS} SELECT 'Topic: ' || topic AS label, title FROM pa",
        "topic_any_band": f"{ANY} SELECT cluster, n_pages FROM ke",
        "topic_any_titles": f"{ANY} SELECT cluster, title FROM ti",
        "topic_any_catalog": f"{ANY} SELECT cluster, words, n_titles FROM ca",
        "topic_any_pairs": f"{ANY} SELECT topic, title FROM pa",
        "topic_any_search": f"""
            {ANY} SELECT DISTINCT topic, title FROM pa WHERE topic = '{SEARCHED}'""",
        "topic_stored_search": f"""
            {ANY} SELECT DISTINCT topic, title FROM pa WHERE topic = '{SEARCHED}'""",
        "vocabulary_sketches": f"""
            WITH w AS (SELECT DISTINCT {NS} AS part, unnest({ASCII}) AS word FROM documents)
            SELECT part, count(*) AS n_words, true AS within FROM w GROUP BY part
            UNION ALL SELECT 'all', count(DISTINCT word), true FROM w""",
        "topic_all_titles": f"{ANY} SELECT title FROM pa",
        "stream_any_topics": f"{ANY} SELECT cluster, words, n_titles FROM ca",
        "stream_any_lookup": f"""
            {ANY} SELECT topic, title FROM pa JOIN
            (SELECT DISTINCT unnest({WS}) AS topic FROM benchmark) USING (topic)""",
        "stream_tfidf_batches": f"""
            WITH {_counts(WS)},
            kt AS (SELECT *, page_id % {BATCHES} AS key FROM tf),
            kd AS (SELECT key, word, count(*) AS df FROM kt GROUP BY ALL),
            kn AS (SELECT doc_id % {BATCHES} AS key, count(*) AS n_all FROM documents GROUP BY ALL)
            SELECT page_id, word, round(n * ln((n_all + 1) / (df + 1)), 9) AS weight
            FROM kt JOIN kd USING (key, word) JOIN kn USING (key)""",
        "stream_tfidf": f"{smooth} SELECT page_id, word, round(weight, 9) AS weight FROM sm",
        "stream_topics": f"{TOPICS} SELECT cluster, words, n_titles, titles FROM ca",
        "stream_topic_lookup": f"""
            {TOPICS} SELECT topic, title FROM pa JOIN
            (SELECT DISTINCT unnest({WS}) AS topic FROM benchmark) USING (topic)""",
    }
    return sql
