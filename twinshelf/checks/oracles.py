"""The same results in plain SQL, for an independent engine."""

from __future__ import annotations


def _rounded(raw: str) -> str:
    return f"CASE WHEN {raw} <= 1 THEN round_even({raw}, 5) ELSE round_even({raw}, 1) END"


def _unit(values: str) -> str:
    """Unit-length FLOAT[] of a DOUBLE[] expression; null for a zero vector."""
    squares = f"list_sum(list_transform({values}, lambda x: x * x))"
    return (f"CASE WHEN {squares} > 0 THEN "
            f"list_transform({values}, lambda x: x / sqrt({squares}))::FLOAT[] END")


def _knn(vectors: str, k: int, category: str | None = "category", guard: int = 1,
         condition: str = "true", ctes: str = "") -> str:
    """Ranked hits among rows of ``vectors`` (id, category, vec).

    Ends inside a WITH list, with the hits in ``hits``.
    """
    group = f"{category}, " if category else ""
    join = "q.category = d.category" if category else "true"
    enough = (f"AND q.category IN (SELECT category FROM v GROUP BY 1 HAVING count(*) >= {guard})"
              if category else "")
    return f"""
    WITH {ctes} v AS (SELECT id, category, vec::DOUBLE[] AS vec FROM ({vectors})
                      WHERE vec IS NOT NULL),
    raw AS (
        SELECT q.category, q.id AS q_id, d.id AS db_id, list_dot_product(q.vec, d.vec) AS raw
        FROM v q JOIN v d ON {join} WHERE {condition} {enough}
    ),
    scored AS (SELECT {group} q_id, db_id, {_rounded('raw')} AS score FROM raw),
    hits AS (
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY {group} q_id ORDER BY score DESC, db_id) AS INTEGER) AS rank
            FROM scored
        ) WHERE rank <= {k}
    )
    """


EMBEDDINGS = "SELECT vec_id AS id, label AS category, embedding AS vec FROM embeddings"
BY_CATEGORY = _knn(EMBEDDINGS, 10, guard=2)
EXACT = BY_CATEGORY + "SELECT * FROM hits"
GLOBAL = _knn(EMBEDDINGS, 10, category=None) + "SELECT * FROM hits"

_STRETCHED = "list_transform(embedding, lambda x: x::DOUBLE * (label + 2))"
COSINE = _knn(
    f"SELECT vec_id AS id, label AS category, {_unit('stretched')} AS vec "
    f"FROM (SELECT *, {_STRETCHED} AS stretched FROM embeddings)", 5, category=None,
) + "SELECT * FROM hits"

def _lsh(tables: int, bits: int, probes: int, category: str) -> str:
    """CTEs up to ``lsh``: in each table a query probes the buckets of least cost, the sum of
    squared margins of the bits in which they differ from its own.

    Row order of the hyperplane signs follows the place in the vector.
    """
    return f"""
    WITH planes AS (
        SELECT t, b, list(CASE WHEN substr(md5(t || ':' || b || ':' || i), 1, 1) < '8'
                               THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END ORDER BY i) AS plane
        FROM range({tables}) t(t), range({bits}) b(b), range(64) i(i) GROUP BY t, b
    ),
    v AS (SELECT vec_id AS id, {category} AS category, embedding::DOUBLE[] AS vec FROM embeddings),
    buckets AS (
        SELECT id, category, t, sum(CASE WHEN side > 0 THEN 1 << b ELSE 0 END)::BIGINT AS bucket,
               list(side * side ORDER BY b) AS margins
        FROM (SELECT id, category, t, b, list_dot_product(vec, plane) AS side FROM v, planes)
        GROUP BY id, category, t
    ),
    costs AS (
        SELECT id, category, t, code, list_sum([
            margins[b + 1] * ((xor(bucket, code) >> b) & 1) FOR b IN range({bits})]) AS cost
        FROM buckets, range({1 << bits}) c(code)
    ),
    probed AS (
        SELECT id, category, t, code FROM costs
        QUALIFY row_number() OVER (PARTITION BY id, category, t ORDER BY cost) <= {probes}
    ),
    near AS (
        SELECT DISTINCT q.category, q.id AS q_id, d.id AS db_id
        FROM probed q JOIN buckets d ON q.category = d.category AND q.t = d.t AND q.code = d.bucket
    ),
    enough AS (
        SELECT q_id, category
        FROM (SELECT q_id, category, count(*) AS n FROM near GROUP BY q_id, category)
        JOIN (SELECT category, count(*) AS size FROM v GROUP BY category) USING (category)
        WHERE n >= least(10, size)
    ),
    pairs AS (
        SELECT category, q_id, db_id FROM near SEMI JOIN enough USING (category, q_id)
        UNION ALL
        SELECT q.category, q.id, d.id FROM v q JOIN v d USING (category)
        ANTI JOIN enough ON enough.category = q.category AND enough.q_id = q.id
    ),
    scored AS (
        SELECT p.category, q_id, db_id, list_dot_product(q.vec, d.vec) AS raw
        FROM pairs p JOIN v q ON q.id = q_id JOIN v d ON d.id = db_id
    ),
    lsh AS (
        SELECT * FROM (
            SELECT category, q_id, db_id, {_rounded('raw')} AS score,
                   CAST(row_number() OVER (PARTITION BY category, q_id
                        ORDER BY {_rounded('raw')} DESC, db_id) AS INTEGER) AS rank
            FROM scored
        ) WHERE rank <= 10
    )
    """


LSH_HITS = _lsh(6, 8, 60, "label")
LSH_GLOBAL = _lsh(6, 10, 130, "0")


def _half_ctes(first: int, last: int, name: str) -> str:
    part = f"list_transform(embedding[{first}:{last}], lambda x: x::DOUBLE)"
    return f"""
    {name}_v AS (
        SELECT vec_id AS id, label AS category, ({_unit('part')})::DOUBLE[] AS vec
        FROM (SELECT *, {part} AS part FROM embeddings)
    ),
    {name}_hits AS (
        SELECT * FROM (
            SELECT *, CAST(row_number() OVER (
                PARTITION BY category, q_id ORDER BY score DESC, db_id) AS INTEGER) AS rank
            FROM (
                SELECT CAST(q.category AS VARCHAR) AS category, q.id AS q_id, d.id AS db_id,
                       {_rounded('list_dot_product(q.vec, d.vec)')} AS score
                FROM {name}_v q JOIN {name}_v d ON q.category = d.category
                WHERE q.category IN
                      (SELECT category FROM {name}_v GROUP BY 1 HAVING count(*) >= 2)
            )
        ) WHERE rank <= 10
    )
    """


HALVES = f"WITH {_half_ctes(1, 32, 'text')}, {_half_ctes(33, 64, 'image')}"


def _fused(text_category: str, image_category: str) -> str:
    return HALVES + f""",
    scored AS (
        SELECT {text_category} AS category, q_id, db_id, score AS text, NULL AS image
        FROM text_hits
        UNION ALL
        SELECT {image_category}, q_id, db_id, NULL, score FROM image_hits
    ),
    fused AS (
        SELECT category, q_id AS q_item_id, 'item ' || q_id AS q_item_name,
               db_id AS db_item_id, 'item ' || db_id AS db_item_name,
               sum(image) AS score_image, sum(text) AS score_text,
               coalesce((score_text + score_image) / 2, score_text, score_image) AS score_mean
        FROM scored GROUP BY category, q_id, db_id
    )
    """


_RANKED = """
    SELECT *, CAST(row_number() OVER (PARTITION BY category, q_item_id
                   ORDER BY score_mean DESC, db_item_id) AS INTEGER) AS rank FROM fused
"""
FUSED = _fused("category", "category") + _RANKED
_TEXT_CATEGORY = "CASE WHEN category = '0' THEN 'text only' ELSE category END"
_IMAGE_CATEGORY = "CASE WHEN category = '1' THEN 'image only' ELSE category END"
EXPORT = _fused("category", "category") + """
    SELECT q_item_id, q_item_name, q_item_id + 7 AS q_shop_id,
           'https://shop.example/product/' || (q_item_id + 7) || '/' || q_item_id AS q_url,
           db_item_id, db_item_name,
           '=IMAGE("http://images.example/file/' || q_item_id || '", 1)' AS q_image_url,
           '=IMAGE("http://images.example/file/' || db_item_id || '", 1)' AS db_image_url,
           score_image, score_mean, score_text
    FROM fused
"""
_COMPARED = HALVES + """,
    compared AS (
        SELECT category, q_id AS q_item_id, db_id AS db_item_id,
               a.score AS a_score, a.rank AS a_rank, b.score AS b_score, b.rank AS b_rank
        FROM text_hits a FULL OUTER JOIN image_hits b USING (category, q_id, db_id)
    )
"""


def _channel(byte: str, mean: float, std: float) -> str:
    """Standardised colour channel in single precision."""
    return (f"list_transform(bytes, lambda b: (({byte} / 255.0::DOUBLE)::FLOAT "
            f"- {mean}::FLOAT) / {std}::FLOAT)")


_PIXELS = " || ".join((
    _channel("b", 0.485, 0.229), _channel("(255 - b)", 0.456, 0.224),
    _channel("(b * 0 + 64)", 0.406, 0.225),
))
_PICTURES = f"""
    SELECT id, category, {_unit('pixels')} AS vec FROM (
        SELECT id, category, list_transform({_PIXELS}, lambda x: x::DOUBLE) AS pixels FROM (
            SELECT vec_id AS id, label::VARCHAR AS category, list_transform(embedding,
                       lambda x: floor((x::DOUBLE + 1) * 127.5)) AS bytes FROM embeddings))
"""

_CLEAN = (
    "trim(lower(regexp_replace(regexp_replace(regexp_replace({0}, 'https?://\\S+', ' ', 'g'), "
    "'[^\\p{{L}}\\p{{M}}\\p{{N}}\\s]', ' ', 'g'), '\\s+', ' ', 'g')))"
)


def _clean(column: str) -> str:
    return _CLEAN.format(column)


CATALOGUE = """
    SELECT p_partkey AS item_id, p_name AS item_name, p_size AS shop_id,
           p_type AS level1_global_be_category,
           CASE WHEN p_brand <> 'Brand#3' THEN replace(p_name, ' ', ',') END AS images
    FROM part
"""

_BUCKET = "('0x' || substr(md5({0}), 1, 7))::INTEGER % {1}"


def _hash_vectors(units: str, dim: int) -> str:
    """id, category, vec from a query of (id, category, list of units)."""
    return f"""
        SELECT id, any_value(category) AS category, {_unit('counts')} AS vec FROM (
            SELECT id, any_value(category) AS category,
                   list_transform(range({dim}), lambda i:
                       len(list_filter(any_value(buckets), lambda b: b = i))::DOUBLE) AS counts
            FROM (SELECT id, category, list_transform(units, lambda u:
                      {_BUCKET.format('u', dim)}) AS buckets FROM ({units}))
            GROUP BY id
        ) GROUP BY id, counts
    """


_DOC_WORDS = f"""
    SELECT doc_id AS id, lang AS category,
           list_filter(string_split_regex({_clean('text')}, '\\s+'), lambda w: w <> '') AS units
    FROM documents
"""
_NAME_GRAMS = f"""
    SELECT p_partkey AS id, p_type AS category, flatten(list_transform(
        list_filter(string_split_regex({_clean('p_name')}, '\\s+'), lambda w: w <> ''),
        lambda w: list_transform(range(1, greatest(length(w), 1) + 1),
                                 lambda i: substr('<' || w || '>', i, 3)))) AS units
    FROM part
"""
_DOC_VECTORS = _hash_vectors(_DOC_WORDS, 64)
_NAMES = _knn(_hash_vectors(_NAME_GRAMS, 256), 10, guard=2)

_LEVELS = """
    p_type AS level1_global_be_category, p_brand AS level2_global_be_category,
    p_size AS level3_global_be_category, string_split(p_name, ' ')[1] AS level4_global_be_category,
    string_split(p_name, ' ')[2] AS level5_global_be_category
"""
_CAT = """
    cat AS (
        SELECT DISTINCT p_type AS level1_global,
               CASE WHEN p_type IN ('ECONOMY', 'SMALL', 'STANDARD') THEN 'FMCG'
                    WHEN p_type <> 'PROMO' THEN 'ELHA' END AS cluster
        FROM part WHERE p_size IN (SELECT max(p_size) FROM part)
    )
"""


def _level_names(n: int) -> str:
    return ", ".join(f"o.level{i}_global_be_category" for i in range(1, n + 1))


def _coverage(n: int) -> str:
    counts = ", ".join(
        f"count(DISTINCT item_id) FILTER (grass_date >= DATE '2001-11-04' - {d}) "
        f"AS total_items_{d}d" for d in (30, 60, 90)
    )
    return f"""
    WITH {_CAT},
    o AS (SELECT l_partkey AS item_id, l_shipdate::DATE AS grass_date, {_LEVELS}
          FROM lineitem JOIN part ON l_partkey = p_partkey),
    counted AS (
        SELECT cat.cluster, {_level_names(n)}, {counts}
        FROM o LEFT JOIN cat ON cat.level1_global = o.level1_global_be_category
        WHERE o.grass_date >= DATE '2001-11-04' - 90
        GROUP BY ALL
    )
    """


def _stats(n: int) -> str:
    return _coverage(n) + """
    SELECT * FROM (
        SELECT *, total_items_90d / sum(total_items_90d) OVER () AS pct_90d,
               total_items_60d / nullif(total_items_30d, 0) AS dif_60,
               total_items_90d / nullif(total_items_30d, 0) AS dif_90
        FROM counted
    ) WHERE cluster IS NOT NULL
    """


_GRAINS = f"""
    SELECT 3 AS grain, cluster, level1_global_be_category, level2_global_be_category,
           level3_global_be_category, NULL::VARCHAR AS level4_global_be_category,
           NULL::VARCHAR AS level5_global_be_category,
           total_items_30d, total_items_60d, total_items_90d
    FROM ({_coverage(3)} SELECT * FROM counted)
    UNION ALL
    SELECT 5, cluster, level1_global_be_category, level2_global_be_category,
           level3_global_be_category, level4_global_be_category, level5_global_be_category,
           total_items_30d, total_items_60d, total_items_90d
    FROM ({_coverage(5)} SELECT * FROM counted)
"""


def _extract(clusters: str) -> str:
    return f"""
    WITH {_CAT},
    o AS (
        SELECT l_partkey AS item_id, p_name AS item_name, l_suppkey AS shop_id,
               s_name AS shop_name, p_type AS level1_global_be_category,
               date_trunc('year', l_shipdate)::DATE AS grass_date,
               l_returnflag, l_linestatus, s_acctbal
        FROM lineitem JOIN part ON l_partkey = p_partkey
        JOIN supplier ON l_suppkey = s_suppkey
    ),
    p AS (
        SELECT p_partkey AS item_id, replace(p_name, ' ', ',') AS images,
               DATE '2001-01-02' - (CASE WHEN p_size <= 40 THEN 2 ELSE 3 END) AS grass_date
        FROM part
    )
    SELECT DISTINCT o.item_id, o.item_name, o.shop_id, o.shop_name,
           o.level1_global_be_category, cat.cluster, p.images
    FROM o JOIN cat ON cat.level1_global = o.level1_global_be_category
    LEFT JOIN p ON o.item_id = p.item_id AND p.grass_date = DATE '2001-01-02' - 2
    WHERE o.grass_date = DATE '2001-01-02' - 1 AND cat.cluster IN ({clusters})
      AND o.l_returnflag <> 'R' AND o.l_linestatus = 'F' AND o.s_acctbal > 0
    """


_ONE_ROW = "(SELECT count(*) FROM embeddings)"
# categories that a folder name could turn into something else
ODD_CATEGORIES = ["01", "", "1e3", "a/b", "2021-01-01", "1.0", "c_1", " x", "%41", "é"]
_ODD = "[" + ", ".join(f"'{c}'" for c in ODD_CATEGORIES) + "][label % 10 + 1]"
_STORED_WHOLE = _knn(
    f"SELECT vec_id AS id, {_ODD} AS category, embedding AS vec FROM embeddings", 10, guard=2
) + """
    SELECT category, q_id AS q_item_id, db_id AS db_item_id, score AS score_text_embed, rank FROM hits
"""

MATCHED_TEXT = f"WITH {_half_ctes(1, 64, 'text')}" + """
    SELECT category, q_id AS q_item_id, 'item ' || q_id AS q_item_name,
           category AS q_category, db_id AS db_item_id, 'item ' || db_id AS db_item_name,
           category AS db_category, score AS score_text_embed, rank
    FROM text_hits"""

ORACLES = {
    "knn_exact_by_category": EXACT,
    "knn_small_blocks": EXACT,
    "knn_global": GLOBAL,
    "knn_self": _knn(EMBEDDINGS, 5, category=None) + "SELECT * FROM hits",
    "knn_exclude_self": _knn(EMBEDDINGS, 5, condition="q.id <> d.id") + "SELECT * FROM hits",
    "knn_cosine": COSINE,
    "knn_payload": BY_CATEGORY + """
        SELECT hits.*, p_name, p_brand FROM hits LEFT JOIN part ON db_id = p_partkey""",
    "knn_nested": BY_CATEGORY + """
        SELECT category, q_id, string_agg(db_id::VARCHAR, ',' ORDER BY rank) AS db_id,
               string_agg((round_even(score * 100000, 0)::BIGINT)::VARCHAR, ',' ORDER BY rank)
               AS points
        FROM hits GROUP BY category, q_id""",
    "exploded_hits": BY_CATEGORY + """
        SELECT category, q_id, db_id, score, rank AS score_rank FROM hits""",
    "ivf_totals": """
        SELECT count(*) AS n_rows, max(len(embedding)) AS dim,
               CAST(sum(len(embedding)) * 4 AS BIGINT) AS n_bytes FROM embeddings""",
    "ivf_reused": f"SELECT {_ONE_ROW} AS n_rows",
    "knn_ivf": GLOBAL,
    "knn_ivf_all_cells": EXACT,
    "knn_ivf_bounded": EXACT,
    "code_totals": "SELECT count(*) AS n_rows, 16::BIGINT AS parts, 16 * count(*) AS n_bytes FROM embeddings",
    "knn_codes_by_category": EXACT,
    "knn_codes_reached": f"SELECT count(*) AS n_exact, true AS reached FROM ({GLOBAL})",
    "knn_tree_all_cells": EXACT,
    "knn_tree_tuned": f"SELECT count(*) AS n_exact, true AS reached FROM ({GLOBAL})",
    "tree_facts": "SELECT count(*) AS n_rows, 0::BIGINT AS misplaced FROM embeddings",
    "knn_ivf_recall": f"SELECT count(*) AS n_exact, count(*) AS n_found, 1.0::DOUBLE AS recall FROM ({GLOBAL})",
    "knn_ivf_tuned": f"SELECT count(*) AS n_exact, true AS reached FROM ({GLOBAL})",
    "knn_lsh_global": LSH_GLOBAL + "SELECT q_id, db_id, score, rank FROM lsh",
    "knn_lsh": LSH_HITS + "SELECT * FROM lsh",
    "knn_lsh_recall": LSH_HITS + f"""
        SELECT count(*) AS n_exact, count(l.db_id) AS n_found,
               count(l.db_id) / count(*) AS recall
        FROM ({EXACT}) e LEFT JOIN lsh l USING (category, q_id, db_id)""",
    "match_by_text": MATCHED_TEXT,
    "match_by_cells": MATCHED_TEXT,
    "rerank_fusion": FUSED,
    "rerank_one_modality": _fused(_TEXT_CATEGORY, _IMAGE_CATEGORY) + _RANKED,
    "rerank_written": FUSED,
    "category_union": HALVES + f"""
        SELECT {_TEXT_CATEGORY} AS category FROM text_hits
        UNION SELECT {_IMAGE_CATEGORY} FROM image_hits""",
    "encoder_hits": _COMPARED + "SELECT * FROM compared",
    "encoder_overlap": _COMPARED + """
        SELECT category, q_item_id, count(a_rank) AS n_a, count(b_rank) AS n_b,
               count(CASE WHEN a_rank IS NOT NULL AND b_rank IS NOT NULL THEN 1 END) AS n_both,
               n_both / greatest(n_a, n_b) AS overlap
        FROM compared GROUP BY category, q_item_id""",
    "category_list": """
        SELECT DISTINCT p_type AS category FROM part WHERE p_type IS NOT NULL ORDER BY 1""",
    "category_guard": """
        SELECT c_nationkey AS category, n_q, n_db
        FROM (SELECT c_nationkey, count(*) AS n_q FROM customer GROUP BY 1)
        JOIN (SELECT s_nationkey, count(*) AS n_db FROM supplier GROUP BY 1)
          ON c_nationkey = s_nationkey
        WHERE n_q >= 2 AND n_db >= 2""",
    "one_category": "SELECT p_partkey, p_name FROM part WHERE p_type = 'ECONOMY'",
    "clean_text": f"SELECT doc_id, {_clean('text')} AS text_clean FROM documents",
    "truncate_tokens": """
        SELECT doc_id, array_to_string(string_split_regex(text, '\\s+')[1:50], ' ') AS first_words
        FROM documents""",
    "prepare_side": f"""
        SELECT item_id AS q_item_id, item_name AS q_item_name, shop_id AS q_shop_id,
               level1_global_be_category AS q_level1_global_be_category, images AS q_images,
               {_clean('item_name')} AS q_item_name_clean
        FROM ({CATALOGUE}) WHERE images IS NOT NULL""",
    "row_index": """
        SELECT doc_id, lang, row_number() OVER (ORDER BY lang, doc_id) - 1 AS id FROM documents""",
    "asset_manifest_join": f"""
        SELECT page_id AS q_page_id, url AS q_image_url, url AS q_item_name,
               '/img/' || n || '_' || regexp_extract(url, '[^/]*$') || '.jpg' AS q_file_path,
               {_clean('url')} AS q_item_name_clean
        FROM (SELECT *, row_number() OVER (ORDER BY page_id) - 1 AS n FROM pages)
        WHERE url NOT LIKE '%example.net%' AND url LIKE 'https%'""",
    "image_scan": """
        SELECT vec_id || '_picture' AS path_idx,
               label || '/' || vec_id || '_picture.jpg' AS file_path,
               true AS file_exists, vec_id AS number
        FROM embeddings""",
    "image_embed": f"""
        WITH pixels AS (
            SELECT vec_id, unnest(list_transform(embedding, lambda x:
                       floor((x::DOUBLE + 1) * 127.5)::INTEGER)) AS b FROM embeddings
        ),
        levels AS (
            SELECT vec_id, b // 32 AS dim FROM pixels
            UNION ALL SELECT vec_id, 8 + (255 - b) // 32 FROM pixels
            UNION ALL SELECT vec_id, 16 + 64 // 32 FROM pixels
        ),
        counts AS (SELECT vec_id, dim, count(*)::DOUBLE AS n FROM levels GROUP BY ALL),
        norms AS (SELECT vec_id, sqrt(sum(n * n)) AS norm FROM counts GROUP BY vec_id)
        SELECT e.vec_id, CAST(d.dim AS INTEGER) AS dim,
               round_even((coalesce(n, 0) / norm)::FLOAT::DOUBLE, 5) AS weight
        FROM embeddings e CROSS JOIN range(24) d(dim)
        JOIN norms USING (vec_id)
        LEFT JOIN counts c ON c.vec_id = e.vec_id AND c.dim = d.dim""",
    "match_by_image": _knn(_PICTURES, 5, guard=2) + """
        SELECT category, q_id AS q_item_id, category AS q_category, db_id AS db_item_id,
               category AS db_category, score AS score_image_embed, rank
        FROM hits""",
    "first_image_url": f"""
        SELECT item_id, item_name, shop_id, level1_global_be_category, images,
               'http://images.example/file/' || string_split(images, ',')[1] AS image_url
        FROM (
            SELECT shop_id::BIGINT AS item_id, item_name, item_id AS shop_id,
                   level1_global_be_category, images,
                   row_number() OVER (PARTITION BY shop_id ORDER BY images, item_name, item_id) AS n
            FROM ({CATALOGUE}) WHERE images IS NOT NULL
        ) WHERE n = 1""",
    "duplicate_keys": """
        SELECT p_name, count(*) AS n_rows FROM part GROUP BY 1 HAVING count(*) > 1""",
    "distinct_columns": """
        SELECT *, row_number() OVER (ORDER BY p_type, p_brand, p_name) - 1 AS id
        FROM (SELECT DISTINCT p_type, p_brand, p_name FROM part)""",
    "category_leaf": """
        SELECT p_partkey, leaf, replace(leaf, '/', '') AS file_name
        FROM (SELECT p_partkey, string_split(p_type || '__' || p_brand || '__' ||
                     replace(p_name, ' ', '/'), '__')[-1] AS leaf FROM part)""",
    "path_rewrite": """
        SELECT page_id, replace(url, 'example.', 'mirror.') AS file_path,
               upper(regexp_extract(url, '[^/]*$')) AS segment FROM pages""",
    "export_columns": EXPORT,
    "csv_round_trip": EXPORT,
    "latest_snapshot": """
        SELECT event_id, event_type, user_id, ts::DATE AS day FROM events
        WHERE ts::DATE IN (SELECT max(ts::DATE) FROM events)""",
    "catalogue_extract": _extract("'FMCG'"),
    "sample_limit": _extract("'FMCG', 'ELHA'") + """
        ORDER BY o.item_id, o.shop_id, cat.cluster LIMIT 1500""",
    "extract_materialised": f"""
        WITH {_CAT}
        SELECT cluster, p_brand AS final_brand, count(*) AS n_items
        FROM part JOIN cat ON p_type = level1_global WHERE cluster = 'FMCG' GROUP BY ALL""",
    "coverage_stats_l3": _stats(3),
    "coverage_stats_l5": _stats(5),
    "coverage_grouping_sets": _GRAINS,
    "coverage_estimated": _coverage(3) + """
    SELECT level1_global_be_category, level2_global_be_category, level3_global_be_category, total_items_30d,
           total_items_60d, total_items_90d, true AS within_30d, true AS within_60d, true AS within_90d
    FROM counted""",
    "brand_list": """
        SELECT DISTINCT p_type AS level1_global_be_category, p_brand AS final_brand
        FROM part
        WHERE p_size <= 40 AND p_brand <> 'Brand#1' AND p_brand <> 'Brand#2'
          AND p_name NOT LIKE 'small%'""",
    "ratio_to_min_report": """
        WITH report AS (
            SELECT event_type AS name,
                   sum(round_even(value * 100, 0)::BIGINT) / count(*) / 100 AS time_index,
                   max(value) AS time_query, count(*)::VARCHAR AS data_size
            FROM events GROUP BY 1
            UNION ALL
            SELECT 'no index, ' || event_type, NULL, min(value), count(*)::VARCHAR
            FROM events GROUP BY 1
        )
        SELECT *, time_index / nullif((SELECT min(time_index) FROM report), 0) AS time_index_pct,
               time_query / nullif((SELECT min(time_query) FROM report), 0) AS time_query_pct
        FROM report""",
    "text_hash_vectors": f"""
        SELECT id AS doc_id, CAST(dim - 1 AS INTEGER) AS dim, round_even(w::DOUBLE, 5) AS weight
        FROM (SELECT id, unnest(vec) AS w, generate_subscripts(vec, 1) AS dim
              FROM ({_DOC_VECTORS}))
        WHERE w <> 0""",
    "text_knn": _knn(_DOC_VECTORS, 10, guard=2) + "SELECT * FROM hits",
    "match_names": _NAMES + f"""
        SELECT category, q_id AS q_item_id, q.p_name AS q_item_name, category AS q_category,
               {_clean('q.p_name')} AS q_item_name_clean, db_id AS db_item_id,
               d.p_name AS db_item_name, category AS db_category,
               {_clean('d.p_name')} AS db_item_name_clean, score AS score_text_embed, rank
        FROM hits JOIN part q ON q.p_partkey = q_id JOIN part d ON d.p_partkey = db_id""",
    "embed_once_documents": f"""
        WITH entries AS (
            SELECT id AS doc_id, CAST(unnest(range(len(vec))) AS INTEGER) AS dim, unnest(vec)::DOUBLE AS weight
            FROM ({_DOC_VECTORS})
        )
        SELECT doc_id, dim, round_even(weight, 5) AS weight FROM entries WHERE weight <> 0""",
    "match_resume": _STORED_WHOLE,
    "match_resume_queries": _STORED_WHOLE,
    "batch_assign": """
        SELECT vec_id, id, id // 50 AS batch
        FROM (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS id FROM embeddings)""",
    "pca_rotation": EXACT,
    "ivf_facts": "SELECT count(*) AS n_rows, 0::BIGINT AS misplaced, 0::BIGINT AS lost FROM embeddings",
    "shard_concat": """
        SELECT vec_id, shard, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim,
               unnest(embedding)::DOUBLE AS value
        FROM (SELECT *, (row_number() OVER (ORDER BY vec_id) - 1) // 40 AS shard FROM embeddings)""",
    "overwrite_target": """
        SELECT vec_id, CAST(unnest(range(len(embedding))) AS INTEGER) AS dim,
               unnest(embedding)::DOUBLE AS value
        FROM embeddings""",
    "stream_match_db": _knn(EMBEDDINGS, 10) + "SELECT * FROM hits",
    "stream_match": _knn(EMBEDDINGS, 10) + "SELECT * FROM hits",
    "peek_head": "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 5",
    "peek_tail": "SELECT vec_id, label FROM embeddings ORDER BY vec_id DESC LIMIT 5",
    "format_score": "SELECT event_id, format('{:,.3f}', value * 100) AS shown FROM events",
    "round_scores": f"""
        SELECT event_id, round_even(value / 37, 6) AS six, {_rounded('(value / 37)')} AS score
        FROM events""",
    "stage_counts": f"""
        SELECT 'base' AS stage, count(*) AS n_rows, true AS written FROM part
        UNION ALL
        SELECT 'cleaned', count(images), true FROM ({CATALOGUE})""",
}
